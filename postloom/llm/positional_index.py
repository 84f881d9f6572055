"""Passages of test items in training texts, by a positional inverted index.

The index has one posting (term, text, place) for every word of the training texts, or
for the words of given terms only, sorted by term. A window of a test item is looked up
from its rarest words: their postings, moved back by the word's place in the item, give
alignments of a text with the item, and an alignment counts when the lists of all
``PICKS`` rarest words of a window hold it. Alignments that are left are held against
the words of the text themselves, so matches are exact. Near matches ask only that the
rarest words lie within some distance of the rarest one.

All of it is Spark functions. Which words of a text are worth a posting is tested with a
bit table of fixed size, whatever the number of terms; the joins that follow are exact.
Nothing is collected, and a term with very many postings is cut by the skew handling of
a plain join, before any grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.storage import parallelism, stored

WINDOW = 10
PICKS = 3
# Bits of the table that words are tested with: 2**20, in 64-bit numbers (128 KB).
_SLOTS = 1 << 14

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words of the text before A-Z are lowered; the same stretches as after it.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_KEY = ["key_a", "key_b"]


def words_of(text: str | Column) -> Column:
    """Words of a text with A-Z lowered; none of null."""
    column = F.col(text) if isinstance(text, str) else text
    lowered = F.translate(F.coalesce(column, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0))


def tokenized(docs: DataFrame) -> DataFrame:
    """doc_id, key_a, key_b, n_words and words of each row, stored.

    The keys are two hashes of doc_id and text: rows that agree in both share them.
    """
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("doc_id", "text").alias("key_a"),
        F.xxhash64(F.lit(1), "text", "doc_id").alias("key_b"),
        words_of("text").alias("words"),
    )
    return stored(keyed.withColumn("n_words", F.size("words").cast("long")), "index-words")


def _place(values: list[str]) -> tuple[Column, Column]:
    """Slot and bit of some columns in a bit table."""
    drawn = F.xxhash64(F.lit(7), *values)
    return (
        F.shiftrightunsigned(drawn, 6).bitwiseAND(_SLOTS - 1).cast("int"),
        drawn.bitwiseAND(63).cast("int"),
    )


def bit_table(rows: DataFrame, values: list[str]) -> Column:
    """A scalar: the bits of all rows, as an array of fixed length."""
    slot, bit = _place(values)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    held = (
        rows.select(slot.alias("slot"), bit.alias("bit"))
        .groupBy("slot")
        .agg(F.bit_or(one).alias("bits"))
    )
    every = rows.sparkSession.range(_SLOTS).select(F.col("id").cast("int").alias("slot"))
    whole = every.join(held, "slot", "left").agg(
        F.sort_array(F.collect_list(F.struct("slot", F.coalesce("bits", F.lit(0)).alias("bits"))))
        .getField("bits")
        .alias("bits")
    )
    return whole.scalar()


def may_hold(table: Column, values: list[str]) -> Column:
    """Whether a row may be among those of ``bit_table``; never false for one that is."""
    slot, bit = _place(values)
    return F.call_function("bit_get", F.get(table, slot), bit) == 1


def frequencies(words: DataFrame, terms: DataFrame) -> DataFrame:
    """term and n (occurrences in all texts, 0 too) of each distinct ``terms.term``."""
    terms = terms.select("term").distinct()
    counted = (
        words.select(F.explode("words").alias("term"))
        .where(may_hold(bit_table(terms, ["term"]), ["term"]))
        .groupBy("term")
        .agg(F.count("*").alias("n"))
    )
    return terms.join(counted, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def postings(words: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """The index: term, key_a, key_b and place, one row an occurrence, stored by term.

    With ``terms`` only words that may be among them get postings.
    """
    each = words.select(*_KEY, F.posexplode("words").alias("place", "term"))
    if terms is not None:
        each = each.where(may_hold(bit_table(terms, ["term"]), ["term"]))
    # Ranges over term and text: a frequent term spans as many files as it fills.
    dealt = each.repartitionByRange(parallelism(words.sparkSession), "term", "key_a")
    return stored(dealt.sortWithinPartitions("term", "key_a", "place"), "index-postings")


def _items(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct word sequences (item, words), and the item_id of each (item, item_id)."""
    whole = items.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("string").alias("item_id"), words_of("text").alias("words")
    )
    whole = whole.where(F.size("words") > 0).withColumn("item", F.md5(F.array_join("words", " ")))
    ids = stored(whole.select("item", "item_id").distinct(), "index-item-ids")
    sequences = stored(whole.select("item", "words").dropDuplicates(["item"]), "index-items")
    return sequences, ids


def _windows(sequences: DataFrame, counts: DataFrame, size: int, picks: int) -> DataFrame:
    """item, start, length and picks (place, term; rarest first) of the windows that can occur.

    A window that holds a term without any occurrence is left out.
    """
    length = F.least(F.lit(size), F.size("words"))
    starts = sequences.select(
        "item", "words", F.explode(F.sequence(F.lit(0), F.size("words") - length)).alias("start")
    )
    each = starts.select(
        "item",
        "start",
        length.alias("length"),
        F.posexplode(F.slice("words", F.col("start") + 1, length)).alias("at", "term"),
    )
    place = (F.col("start") + F.col("at")).alias("at")
    ranked = F.sort_array(F.collect_list(F.struct("n", place, "term")))
    return (
        each.join(counts, "term")
        .groupBy("item", "start", "length")
        .agg(F.min("n").alias("least"), F.slice(ranked, 1, picks).alias("ranked"))
        .where(F.col("least") > 0)
        .select(
            "item",
            "start",
            "length",
            F.transform("ranked", lambda r: F.struct(r["at"], r["term"])).alias("picks"),
        )
    )


def _terms(sequences: DataFrame) -> DataFrame:
    return sequences.select(F.explode("words").alias("term")).distinct()


def _asked(words: DataFrame, items: DataFrame, size: int, picks: int):
    """Word sequences and ids of the items, and their windows (stored)."""
    sequences, ids = _items(items)
    counts = frequencies(words, _terms(sequences))
    return sequences, ids, stored(_windows(sequences, counts, size, picks), "index-windows")


def phrase_matches(
    words: DataFrame, items: DataFrame, size: int = WINDOW, picks: int = PICKS
) -> DataFrame:
    """key_a, key_b, item_id, place and length of every window that a text holds.

    ``words`` comes from ``tokenized``; ``items`` has item_id and text. A window is ``size``
    neighbouring words of an item, or all of a shorter one. Items that are null, empty or
    without an id have no windows; several items of one id count together, and equal items
    of several ids each. Each occurrence of a window comes once for each item_id.
    """
    sequences, ids, windows = _asked(words, items, size, picks)
    slots = windows.select("item", F.explode("picks").alias("p")).select("item", "p.*").distinct()
    index = postings(words, slots.select("term").distinct())
    # Lists moved back by the place in the item; what several of them share is an alignment.
    shifted = index.join(slots, "term").select(
        *_KEY, "item", (F.col("place") - F.col("at")).alias("shift"), "at"
    )
    # A window has as many picks as the item has words, up to ``picks``.
    fewest = windows.groupBy("item").agg(F.min(F.size("picks")).alias("fewest"))
    aligned = (
        shifted.groupBy(*_KEY, "item", "shift")
        .agg(F.collect_set("at").alias("held"))
        .join(fewest, "item")
        .where(F.size("held") >= F.col("fewest"))
        .drop("fewest")
    )
    of_item = windows.groupBy("item").agg(
        F.collect_list(F.struct("start", "length", "picks")).alias("windows")
    )
    fits = F.filter(
        "windows",
        lambda w: (w["start"] + F.col("shift") >= 0)
        & F.forall(w["picks"], lambda p: F.array_contains("held", p["at"])),
    )
    found = (
        aligned.join(of_item, "item")
        .withColumn("windows", fits)
        .where(F.size("windows") > 0)
        .withColumn("first", F.array_min(F.transform("windows", lambda w: w["start"])))
        .withColumn("end", F.array_max(F.transform("windows", lambda w: w["start"] + w["length"])))
        .join(sequences, "item")
        .select(
            *_KEY,
            "item",
            "shift",
            "first",
            F.transform("windows", lambda w: F.struct(w["start"], w["length"])).alias("windows"),
            F.slice("words", F.col("first") + 1, F.col("end") - F.col("first")).alias("wanted"),
        )
    )
    return _exact(words, stored(found, "index-alignments"), ids)


def _exact(words: DataFrame, aligned: DataFrame, ids: DataFrame) -> DataFrame:
    """The windows of the alignments whose words all agree with the text's."""
    each = ["item", "shift", "first", "windows", "wanted"]
    of_text = aligned.groupBy(*_KEY).agg(F.collect_list(F.struct(*each)).alias("found"))
    held = words.where(may_hold(bit_table(of_text, _KEY), _KEY)).select(*_KEY, "words")
    cut = F.transform(
        "found",
        lambda f: F.struct(
            *(f[c].alias(c) for c in each),
            F.slice("words", f["shift"] + f["first"] + 1, F.size(f["wanted"])).alias("there"),
        ),
    )
    rows = (
        held.dropDuplicates(_KEY)
        .join(of_text, _KEY)
        .select(*_KEY, F.explode(cut).alias("f"))
        .select(*_KEY, "f.*")
    )
    agree = F.filter(
        "windows",
        lambda w: F.slice("wanted", w["start"] - F.col("first") + 1, w["length"])
        == F.slice("there", w["start"] - F.col("first") + 1, w["length"]),
    )
    exact = rows.select(*_KEY, "item", "shift", F.explode(agree).alias("w"))
    return exact.join(ids, "item").select(
        *_KEY,
        "item_id",
        (F.col("shift") + F.col("w.start")).alias("place"),
        F.col("w.length").alias("length"),
    )


def near_matches(
    words: DataFrame, items: DataFrame, within: int, size: int = WINDOW, picks: int = PICKS
) -> DataFrame:
    """key_a, key_b, item_id, start and place: windows whose rarest words lie close together.

    ``start`` is the window's place in its item, ``place`` that of its rarest word in the
    text; the other ``picks`` - 1 rarest words each lie at most ``within`` words from it,
    in any order. Every exact match with ``within`` >= ``size`` is among them.
    """
    sequences, ids, windows = _asked(words, items, size, picks)
    slots = windows.select("item", "start", F.posexplode("picks").alias("nth", "p")).select(
        "item", "start", "nth", "p.term"
    )
    index = postings(words, slots.select("term").distinct())
    found = index.join(slots.where(F.col("nth") == 0), "term").select(
        *_KEY, "item", "start", "place"
    )
    block = F.lit(max(1, within))
    own = F.floor(F.col("place") / block)
    others = index.select(
        *_KEY,
        F.col("term").alias("other"),
        F.col("place").alias("there"),
        F.explode(F.sequence(own - 1, own + 1)).alias("block"),
    )
    for nth in range(1, picks):
        wanted = slots.where(F.col("nth") == nth).select("item", "start", F.col("term").alias("other"))
        asked = found.join(wanted, ["item", "start"], "left").withColumn("block", own)
        close = F.abs(F.col("place") - F.col("there")) <= within
        same = [asked[c] == others[c] for c in [*_KEY, "other", "block"]]
        # An item of fewer words than picks asks nothing more.
        short = asked.where(F.col("other").isNull())
        near = asked.join(others, [*same, close], "left_semi")
        found = near.unionByName(short).select(*_KEY, "item", "start", "place")
    return found.join(ids, "item").select(*_KEY, "item_id", "start", "place").distinct()


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated, one row a document.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are left alone.
    A word is hit when it lies in an occurrence of any window. A null or empty text has no
    words; repeated rows, repeated ids and a null id each keep their row. Empty tables and
    items without windows leave all documents clean.
    """
    words = tokenized(docs)
    found = phrase_matches(words, items, size)
    found = stored(found, "index-matches")
    spans = found.groupBy(*_KEY, "place").agg(F.max("length").alias("length"))
    before = Window.partitionBy(*_KEY).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("place") + F.col("length")
    fresh = F.greatest(F.lit(0), end - F.greatest("place", F.coalesce(F.max(end).over(before), F.lit(0))))
    hits = (
        spans.withColumn("fresh", fresh)
        .groupBy(*_KEY)
        .agg(F.sum("fresh").cast("long").alias("n_hit"))
    )
    listed = found.groupBy(*_KEY).agg(F.sort_array(F.collect_set("item_id")).alias("held"))
    held = F.coalesce("held", F.array().cast("array<string>"))
    return (
        words.select("doc_id", *_KEY, "n_words")
        .join(hits.join(listed, _KEY), _KEY, "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(held).cast("long").alias("n_items"),
            F.sha2(F.array_join(held, ","), 256).alias("items_sha256"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )
