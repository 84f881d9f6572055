"""Language of texts by a string kernel.

Two texts are as alike as the number of letter n-grams (one to four letters, runs
of anything else being one space) that both hold, over the geometric mean of
their own numbers: the blended-spectrum presence kernel, with n-grams hashed to
131,072 places. A bounded sample of labelled texts gives the landmarks of a Nyström
map and the rows of a kernel ridge regression, one against the rest: the same number
for each language, and as many in all, however many languages there are. Texts are scored in batches: presence by landmark presence, a matrix
product, then by the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.storage import stored
from postloom.llm.words import mix, slices

PLACES = 1 << 17
ORDERS = (1, 2, 3, 4)
BATCH = 64  # texts in one matrix product
# Labelled texts of each language that are learned from, and those that are landmarks.
LEARNED, LANDMARKS = 300, 60
# The same of all languages: beyond eight of them each has fewer. Where there are more languages
# than landmarks, those with the most labelled texts are learned.
ALL_LEARNED, ALL_LANDMARKS = 2_400, 480
PARTS = 8  # of a language, from which its sample is drawn
RIDGE = 0.1
UNDETERMINED = "und"

_tables: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _tables:
        _tables.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _tables[0]


def presences(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """n-gram presence (texts by places) of some texts at a time, and whether they have letters."""
    letters = _letters()
    for run in slices(pc.utf8_lower(column.cast(pa.large_string()).fill_null(""))):
        points = np.frombuffer(run.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        upto = np.concatenate([[0], np.cumsum((run.data & 0xC0) != 0x80)])
        bounds = upto[run.offsets]
        text = np.repeat(np.arange(len(run)), np.diff(bounds))
        letter = letters[points]
        first = np.zeros(len(points), bool)
        first[bounds[:-1][np.diff(bounds) > 0]] = True
        keep = letter | first
        keep[1:] |= letter[:-1]
        codes = np.where(letter, points, 32)[keep].astype(np.uint64)
        text, letter = text[keep], letter[keep]
        lettered = np.bincount(text[letter], minlength=len(run)) > 0
        grams = []
        rolled = np.zeros(len(codes), np.uint64)
        for n in range(1, max(ORDERS) + 1):
            size = max(0, len(codes) - n + 1)
            rolled = rolled[:size] * np.uint64(0x1000193) + codes[n - 1 :] if n > 1 else codes
            if n in ORDERS:
                whole = text[:size] == text[n - 1 :]
                place = mix(rolled + np.uint64(n << 56)) & np.uint64(PLACES - 1)
                grams.append((text[:size][whole], place[whole].astype(np.int64)))
        for low in range(0, len(run), BATCH):
            high = min(low + BATCH, len(run))
            present = np.zeros((high - low, PLACES), bool)
            for owner, place in grams:
                a, b = np.searchsorted(owner, [low, high])
                present[owner[a:b] - low, place[a:b]] = True
            yield present, lettered[low:high]


@dataclass
class Model:
    """Landmarks by the places they use, and the weights of each language."""

    languages: list[str]
    places: np.ndarray
    landmarks: np.ndarray  # landmarks by places, 0 or 1
    norms: np.ndarray
    weights: np.ndarray  # landmarks by languages

    def scores(self, present: np.ndarray) -> np.ndarray:
        """Regression values, texts by languages."""
        shared = present[:, self.places].astype(np.float32) @ self.landmarks.T
        own = np.sqrt(np.maximum(present.sum(axis=1), 1))
        return (shared / (own[:, None] * self.norms[None, :])) @ self.weights


def fit(packed: np.ndarray, languages: list[str]) -> Model:
    """Kernel ridge regression on rows of packed presence, through a Nyström map."""
    names = sorted(set(languages))
    most = min(LANDMARKS, ALL_LANDMARKS // len(names))
    marks, seen = [], dict.fromkeys(names, 0)
    for i, name in enumerate(languages):
        if seen[name] < most:
            marks.append(i)
            seen[name] += 1
    present = np.unpackbits(packed[marks], axis=1)
    places = np.flatnonzero(present.any(axis=0))
    landmarks = present[:, places].astype(np.float32)
    norms = np.sqrt(landmarks.sum(axis=1))
    model = Model(names, places, landmarks, norms, np.eye(len(marks)))
    crossed = np.concatenate(
        [model.scores(np.unpackbits(packed[i : i + BATCH], axis=1)) for i in range(0, len(packed), BATCH)]
    )
    values, vectors = np.linalg.eigh(crossed[marks])
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    mapped = crossed @ root
    targets = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # A language with few texts weighs as much as one with many.
    weight = 1 / np.array([languages.count(name) for name in languages])
    gram = mapped.T @ (mapped * weight[:, None]) + RIDGE / len(names) * np.eye(len(marks)) / 100
    model.weights = (root @ np.linalg.solve(gram, mapped.T @ (targets * weight[:, None]))).astype(
        np.float32
    )
    return model


def is_held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame) -> Model | None:
    """The model of the labelled documents that are not held out; None without any.

    At most ``LEARNED`` texts of each language and ``ALL_LEARNED`` of all are read, those
    with the least hash of their doc_id; only their packed presence comes to the driver,
    16 KB a text and 39 MB in all.
    """
    labelled = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    counted = stored(labelled.groupBy("lang").agg(F.count("*").alias("n")), "kernel-languages")
    count = counted.count()
    if count > ALL_LANDMARKS:
        most = counted.orderBy(F.col("n").desc(), "lang").limit(ALL_LANDMARKS)
        labelled = labelled.join(most, "lang", "left_semi")
    each = min(LEARNED, ALL_LEARNED // max(1, min(count, ALL_LANDMARKS)))
    # The first of each language, by way of the first of each of its parts, so that no task
    # gets a whole language.
    parts = labelled.withColumn("part", F.pmod(F.xxhash64(F.lit(29), "doc_id"), F.lit(PARTS)))
    least = F.xxhash64("doc_id"), F.col("doc_id")
    for by in (("lang", "part"), ("lang",)):
        nth = F.row_number().over(Window.partitionBy(*by).orderBy(*least))
        parts = parts.withColumn("nth", nth).where(F.col("nth") <= each)
    chosen = stored(
        parts.select("doc_id", "lang", "nth"),
        "kernel-sample",
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for present, lettered in presences(batch.column("text")):
                rows = batch.slice(at, len(lettered))
                bits = [row.tobytes() for row in np.packbits(present, axis=1)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("lang"), rows.column("nth"), pa.array(bits, pa.binary())],
                    ["lang", "nth", "bits"],
                ).filter(pa.array(lettered))
                at += len(lettered)

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    sample = (
        texts.join(chosen, "doc_id")
        .dropDuplicates(["lang", "nth"])
        .select("lang", "nth", "text")
        .mapInArrow(pack, "lang string, nth int, bits binary")
        .orderBy("nth", "lang")
        .collect()
    )
    if not sample:
        return None
    bits = np.frombuffer(b"".join(bytes(r.bits) for r in sample), np.uint8).reshape(len(sample), -1)
    return fit(bits, [r.lang for r in sample])


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score (0 to 1) of every row.

    ``docs`` has doc_id, text and lang; a prediction reads text alone, and whole.
    Null texts and texts without a letter are ``und`` with score 0, as is every text
    when no labelled text can be learned from; repeated rows get the same result
    each; a row without doc_id is never learned from; an empty table gives no rows.
    """
    model = learn(docs)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for present, lettered in presences(batch.column("text")):
                rows = batch.slice(at, len(lettered))
                names = np.full(len(lettered), UNDETERMINED, object)
                values = np.zeros(len(lettered))
                if model is not None and lettered.any():
                    found = model.scores(present[lettered])
                    names[lettered] = np.array(model.languages, object)[found.argmax(axis=1)]
                    values[lettered] = np.clip((found.max(axis=1) + 1) / 2, 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        rows.column("held_out"),
                        pa.array(names, pa.string()),
                        pa.array(values),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )
                at += len(lettered)

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        is_held_out(F.col("doc_id")).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")
