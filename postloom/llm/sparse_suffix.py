"""Passages that repeat across documents, by a sparse suffix array over words.

Of all suffixes of a text only those are retained that start at a minimiser: the
least of 32 neighbouring six-word hashes. Any 50 words in a row then hold one in
their first 32 words, at the same place wherever the passage stands. Retained
suffixes are sorted over the cluster word by word, as far as a passage surely reaches
from its minimiser on: by their first 19 words, each of which has its place in the
alphabet by a code of nine bits. Neighbours that agree on all of them are seeds.

In that order a suffix stands beside those that match it farthest to the right. The
text that matches it farthest to both sides need not be a neighbour, so that matches
are not extended from pair to pair, which would miss passages: each seed is extended
left and right to all runs of 50 words around it, and runs are compared by their full
hashes, over all texts. Overlapping runs join up to the longest repeated passage. Texts
that are equal as a whole are extended once, for the smallest of their doc_ids. Nothing
is gathered by passage: a passage that a third of all texts share is sorted over
many tasks, and counted by sums that are added up before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.storage import parallelism, stored
from postloom.llm.words import Slice, Words, grams, hashes, slices

RUN = 50  # words of a passage that counts
WORD = r"[^\x20\x09-\x0D]+"
GRAM = 6
REACH = 32  # six-word hashes of which the least is retained; a power of two
STEM = RUN - REACH + 1  # words that a run has from its minimiser on, at least
BITS, PACKED = 9, 7  # bits of a word's code, and codes in one sort key
KEYS = [f"key_{i}" for i in range(-(-STEM // PACKED))]


def _minimisers(found: Words, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all runs of 50 words within a text, and the minimiser of each."""
    count = len(found) - RUN + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = grams(hashed, GRAM)
    place = np.arange(len(least))
    step = 1
    while step < REACH:
        # Of equal hashes the first place is taken, which does not depend on where it lies.
        later = least[step:] < least[:-step]
        place = np.where(later, place[step:], place[:-step])
        least = np.where(later, least[step:], least[:-step])
        step *= 2
    starts = np.flatnonzero(found.text[:count] == found.text[RUN - 1 :])
    return starts, place[starts]


def _read(run: Slice) -> tuple[Words, np.ndarray]:
    found = run.words()
    return found, hashes(run.sums(), found.starts, found.ends)


def _keys(hashed: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
    """Sort keys of the suffixes at ``places``, in the order of their first words."""
    codes = hashed >> np.uint64(64 - BITS)
    keys = []
    for first in range(0, STEM, PACKED):
        key = np.zeros(len(places), np.uint64)
        for word in range(first, min(first + PACKED, STEM)):
            key = key << np.uint64(BITS) | codes[places + word]
        keys.append(key.view(np.int64))
    return keys


def _suffixes(texts: DataFrame) -> DataFrame:
    """Sort keys, row and place of each retained suffix."""

    def retain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for run in slices(batch.column("text")):
                found, hashed = _read(run)
                places = np.unique(_minimisers(found, hashed)[1])
                text = found.text[places]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(key) for key in _keys(hashed, places)),
                        pa.array(rows[run.first + text]),
                        pa.array((places - found.firsts[text]).astype(np.int32)),
                    ],
                    [*KEYS, "row", "place"],
                )

    schema = ", ".join([*(f"{key} long" for key in KEYS), "row long", "place int"])
    return texts.select("row", "text").mapInArrow(retain, schema)


def _seeds(suffixes: DataFrame) -> DataFrame:
    """row and place of the suffixes that start like a neighbour in sorted order.

    The outermost rows of a task, whose neighbours it does not see, are kept too;
    the exact count that follows drops them if they match nothing.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, its suffix, and whether it is a seed already
        for batch in batches:
            if not batch.num_rows:
                continue
            found = np.stack([batch.column(c).to_numpy() for c in order])
            # Suffixes of equal texts are one suffix, of which the first row is kept.
            fresh = np.ones(batch.num_rows, bool)
            fresh[1:] = (found[:, 1:] != found[:, :-1]).any(axis=0)
            if held is not None:
                fresh[0] = (found[:, 0] != held[1]).any()
            batch = batch.select(["row", "place"]).filter(pa.array(fresh))
            found = found[:, fresh]
            if not batch.num_rows:
                continue
            keys = found[: len(KEYS)]
            same = (keys[:, 1:] == keys[:, :-1]).all(axis=0)
            keep = np.zeros(batch.num_rows, bool)
            keep[1:] |= same
            keep[:-1] |= same
            if held is None:
                keep[0] = True
            else:
                alike = bool((held[1][: len(KEYS)] == keys[:, 0]).all())
                keep[0] |= alike
                if alike or held[2]:
                    yield held[0]
            held = batch.slice(batch.num_rows - 1), found[:, -1], bool(keep[-1])
            keep[-1] = False
            yield batch.filter(pa.array(keep))
        if held is not None:
            yield held[0]

    order = [*KEYS, "row", "place"]
    count = parallelism(suffixes.sparkSession)
    return (
        suffixes.repartitionByRange(count, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(compare, "row long, place int")
    )


def _runs(texts: DataFrame, places: DataFrame) -> DataFrame:
    """hash, row, doc_id, word and span of each run of 50 words around a seed.

    ``span`` has the offsets of start and end in its upper and lower 32 bits.
    """

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            ids = batch.column("doc_id").to_numpy()
            places = batch.column("places")
            for run in slices(batch.column("text")):
                found, hashed = _read(run)
                starts, least = _minimisers(found, hashed)
                own = places.slice(run.first, len(run))
                wanted = np.zeros(len(found) + 1, bool)
                text = own.value_parent_indices().to_numpy()
                wanted[found.firsts[text] + own.flatten().to_numpy()] = True
                starts = starts[wanted[least]]
                text = found.text[starts]
                upto = np.concatenate([[0], np.cumsum((run.data & 0xC0) != 0x80)])
                base = upto[run.offsets[text]]
                wide = grams(hashed, RUN)[starts] if len(starts) else np.zeros(0, np.uint64)
                start = upto[found.starts[starts]] - base
                end = upto[found.ends[starts + RUN - 1]] - base
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(wide.view(np.int64)),
                        pa.array(rows[run.first + text]),
                        pa.array(ids[run.first + text]),
                        pa.array((starts - found.firsts[text]).astype(np.int32)),
                        pa.array((start << 32) | end),
                    ],
                    ["hash", "row", "doc_id", "word", "span"],
                )

    return (
        texts.join(places, ["row", "doc_id"])
        .select("row", "doc_id", "text", "places")
        .mapInArrow(extend, "hash long, row long, doc_id long, word int, span long")
    )


def _texts(docs: DataFrame) -> DataFrame:
    """row (a hash of the text), doc_id and text of the rows that have both."""
    text = F.col("text").cast("string")
    return docs.select(
        F.xxhash64(text).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")
    ).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())


def _joined(found: DataFrame) -> DataFrame:
    """Maximal passages of each text: row, doc_id, start, end, n_words and first.

    ``found`` has row, doc_id, and runs (word, until, span, low), where ``low`` is
    the smallest doc_id that holds a run.
    """

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            ids, rows = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
            for doc_id, row, run in zip(ids, rows, batch.column("runs")):
                word, until, span, low = (
                    run.values.field(n).to_numpy() for n in ("word", "until", "span", "low")
                )
                order = np.argsort(word, kind="stable")
                each = word[order], until[order], span[order] >> 32, span[order] & 0xFFFFFFFF
                for first, last, at, to, cut in _passages(*each, (low != doc_id)[order]):
                    out.append((doc_id, row, at, to, last - first, not cut))
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "row", "start", "end", "n_words", "first"],
            )

    return found.select("row", "doc_id", "runs").mapInArrow(
        join_up, "doc_id long, row long, start long, end long, n_words long, first boolean"
    )


def _passages(
    word: np.ndarray, until: np.ndarray, start: np.ndarray, end: np.ndarray, cut: np.ndarray
) -> Iterator[tuple[int, int, int, int, bool]]:
    """Word range, offsets and kind of each passage; where kinds overlap, cut ones win."""
    cuts = list(_merged(word[cut], until[cut], start[cut], end[cut]))
    for first, last, at, to in cuts:
        yield first, last, at, to, True
    for first, last, at, to in _merged(word[~cut], until[~cut], start[~cut], end[~cut]):
        for c_first, c_last, c_at, c_to in cuts:
            if c_last <= first or c_first >= last:
                continue
            if c_first > first:
                yield first, c_first, at, c_at, False
            first, at = c_last, c_to
            if first >= last:
                break
        if first < last:
            yield first, last, at, to, False


def _merged(
    word: np.ndarray, until: np.ndarray, start: np.ndarray, end: np.ndarray
) -> Iterator[tuple[int, int, int, int]]:
    """Runs in order of their first word, joined where they touch."""
    if not len(word):
        return
    reach, upto = np.maximum.accumulate(until), np.maximum.accumulate(end)
    breaks = np.flatnonzero(word[1:] > reach[:-1]) + 1
    for low, high in zip([0, *breaks], [*breaks, len(word)]):
        yield int(word[low]), int(reach[high - 1]), int(start[low]), int(upto[high - 1])


def _found(docs: DataFrame) -> DataFrame:
    """``repeated_passages`` with the row of each text."""
    texts = _texts(docs)
    suffixes = stored(_suffixes(texts), "suffixes")
    # Equal texts are one row, which the smallest doc_id stands for.
    white = F.lit(" \t\n\x0b\x0c\r")
    size = F.length("text")
    start, end = size - F.length(F.ltrim("text", white)), F.length(F.rtrim("text", white))
    holders = stored(
        texts.select(
            "row",
            "doc_id",
            F.regexp_count("text", F.lit(WORD)).cast("int").alias("n_words"),
            (start.cast("long") * (1 << 32) + end).alias("span"),
        )
        .where(F.col("n_words") >= RUN)
        .distinct(),
        "suffix-holders",
    )
    owners = stored(
        holders.groupBy("row").agg(
            F.min("doc_id").alias("doc_id"),
            F.max("doc_id").alias("last"),
            F.first("n_words").alias("n_words"),
            F.first("span").alias("span"),
        ),
        "suffix-owners",
    )
    places = _seeds(suffixes).groupBy("row").agg(F.collect_set("place").alias("places"))
    places = places.join(owners.select("row", "doc_id"), "row")
    runs = stored(_runs(texts, places), "suffix-runs")
    repeated = stored(
        runs.groupBy("hash")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where(F.col("low") != F.col("high"))
        .select("hash", "low"),
        "suffix-repeats",
    )
    each = runs.select("hash", "row", "word", "span").join(repeated, "hash")
    each = each.select("row", "word", (F.col("word") + RUN).alias("until"), "span", "low")
    copied = owners.where(F.col("doc_id") != F.col("last"))
    whole = copied.select(
        "row", F.lit(0).alias("word"), F.col("n_words").alias("until"), "span", F.col("doc_id").alias("low")
    )
    lists = (
        each.union(whole)
        .groupBy("row")
        .agg(F.collect_set(F.struct("word", "until", "span", "low")).alias("runs"))
        .join(owners.select("row", "doc_id"), "row")
    )
    copies = (
        holders.join(copied.select("row", F.col("doc_id").alias("low")), "row")
        .where(F.col("doc_id") != F.col("low"))
        .select(
            "doc_id",
            "row",
            F.shiftright("span", 32).alias("start"),
            F.col("span").bitwiseAND(F.lit(0xFFFFFFFF)).alias("end"),
            F.col("n_words").cast("long").alias("n_words"),
            F.lit(False).alias("first"),
        )
    )
    return _joined(lists).union(copies)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, start, end, n_words and first of each passage that other documents hold too.

    ``docs`` has doc_id and text; other columns are left alone. Offsets count code
    points, the end exclusive. A passage has 50 words or more in a row, compared
    exactly, with any white space between; ``first`` tells that this document has
    the smallest doc_id of those that hold it, and such a passage starts or ends
    where one that is not first touches it. A document whose words are all fresh
    gives no row, nor do null, empty or shorter texts and rows without doc_id; repeated rows count
    once, and repeats within one document are not passages of this kind.
    """
    return _found(docs).drop("row")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with all passages cut from the texts that are not the first to hold them.

    All rows and columns stay; n_chars, where present, follows the text.
    """
    cuts = (
        _found(docs)
        .where(~F.col("first"))
        .groupBy(F.col("row").alias("_cut_row"), F.col("doc_id").alias("_cut_id"))
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_cuts"))
    )
    same = (F.xxhash64(docs["text"].cast("string")) == F.col("_cut_row")) & (
        docs["doc_id"].cast("long") == F.col("_cut_id")
    )
    joined = docs.join(cuts, same, "left")
    # What stays lies between the end of one cut and the start of the next.
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("_cuts", lambda c: c["end"]))
    starts = F.concat(F.transform("_cuts", lambda c: c["start"]), F.array(F.length("text").cast("long")))
    pieces = F.zip_with(
        ends, starts, lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int"))
    )
    text = F.when(F.col("_cuts").isNull(), docs["text"]).otherwise(F.array_join(pieces, ""))
    changed = {"text": text.alias("text")}
    if "n_chars" in docs.columns:
        count = F.when(F.col("_cuts").isNull(), docs["n_chars"]).otherwise(F.length(text))
        changed["n_chars"] = count.cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return joined.select(*(changed.get(c, docs[c]) for c in docs.columns))
