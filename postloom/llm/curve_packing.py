"""Packing along a space-filling curve.

A document's words are hashed into a vector, which is projected to four
dimensions; its place on the Hilbert curve through them is its key. Documents are
range-sorted by key, and their tokens form one long row, of which every 2,048 are
a sequence: only the last one is padded. The sort moves a few numbers for each
document; equal texts share a key, so the key is followed by a hash of the row,
which spreads them over as many tasks as they need. Token ids are written once
and joined to their places at the end.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.storage import give_back, parallelism, stored
from postloom.llm.tokens import LibraryWords, encoder, text_runs
from postloom.llm.words import hashes, slices

LENGTH = 2_048
END_ID = 1
HASHED = 128  # dimensions of a document's vector
DIMENSIONS, BITS = 4, 12  # of the curve
RUN_BYTES = 1 << 22
_PROJECTION = np.random.default_rng(424_242).standard_normal((HASHED, DIMENSIONS))


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with whole coordinates below 2**bits.

    The coordinates are turned and mirrored from the highest bit on, so that each
    cell's curve starts where the last one ended, then their bits are interleaved
    and read as a Gray code (Skilling's method).
    """
    x = points.T.astype(np.int64).copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        high, low = 1 << bit, (1 << bit) - 1
        for i in range(n):
            on = (x[i] & high) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> bit) & 1, (1 << bit) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_keys(column: pa.Array) -> np.ndarray:
    """Hilbert key of each text; one without words gets that of the zero vector."""
    keys = []
    for run in slices(column):
        found = run.words()
        hashed = hashes(run.sums(lower=True), found.starts, found.ends)
        place = found.text * HASHED + (hashed % np.uint64(HASHED)).astype(np.int64)
        sign = np.where(hashed >> np.uint64(63), 1.0, -1.0)
        vectors = np.bincount(place, sign, len(run) * HASHED).reshape(len(run), HASHED)
        vectors = np.sign(vectors) * np.sqrt(np.abs(vectors))
        norms = np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        flat = (vectors / norms) @ _PROJECTION
        cells = np.floor((1 << BITS) / (1 + np.exp(-1.7 * flat))).astype(np.int64)
        keys.append(hilbert(np.clip(cells, 0, (1 << BITS) - 1), BITS))
    return np.concatenate(keys) if keys else np.zeros(0, np.int64)


def _encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """row, doc_id, key, tie, tokens and ids (little-endian, 16 or 32 bits) of each row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(LibraryWords, tokenizer)
        kind = np.uint16 if words.size <= 1 << 16 else np.uint32
        for batch in batches:
            for first, texts in text_runs(batch.column("text"), RUN_BYTES):
                rows = batch.slice(first, len(texts))
                ids, counts = words.encode(texts)
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id).astype(kind)
                ends += np.arange(1, len(ends) + 1)
                packed = pa.Array.from_buffers(
                    pa.large_binary(),
                    len(ends),
                    [
                        None,
                        pa.py_buffer(np.concatenate([[0], ends]) * ids.itemsize),
                        pa.py_buffer(ids),
                    ],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("row"),
                        rows.column("doc_id"),
                        pa.array(curve_keys(texts)),
                        rows.column("tie"),
                        pa.array(counts + 1),
                        packed.cast(pa.binary()),
                    ],
                    ["row", "doc_id", "key", "tie", "tokens", "ids"],
                )
        # The worker goes on to other stages, which need the memory.
        words.forget()
        give_back()

    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.lit("tie"), F.col("doc_id").cast("long")).alias("tie"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(
        encode, "row long, doc_id long, key long, tie long, tokens long, ids binary"
    )


def _placed(encoded: DataFrame) -> DataFrame:
    """row and place (tokens before it, along the curve) of each row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            tokens = batch.column("tokens").to_numpy()
            ends = before + np.cumsum(tokens)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(tokens), part, np.int64)),
                    batch.column("row"),
                    pa.array(ends - tokens),
                    pa.array(ends),
                ],
                ["part", "row", "start", "end"],
            )
            before = int(ends[-1]) if len(ends) else before

    spark = encoded.sparkSession
    order = ["key", "tie", "row"]
    counted = stored(
        encoded.select(*order, "tokens")
        .repartitionByRange(parallelism(spark), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(count, "part long, row long, start long, end long"),
        "packing-places",
    )
    # One number for each task of the sort comes to the driver.
    ends = counted.groupBy("part").agg(F.max("end").alias("end")).orderBy("part").collect()
    bases, before = [], 0
    for part in ends:
        bases.append((part["part"], before))
        before += part["end"]
    base = spark.createDataFrame(bases, "part long, base long")
    return counted.join(base, "part").select("row", (F.col("base") + F.col("start")).alias("place"))


def pack(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID
) -> DataFrame:
    """One row for each piece of a document in a sequence.

    Columns: doc_id, start (its document's ids before it), length, ids (binary,
    little-endian unsigned 32-bit), ids_crc32 of that, doc_tokens, sequence_id and
    offset. ``docs`` has doc_id and text; other columns are left alone. Null and
    empty texts are documents of the end id alone; repeated rows are packed each;
    a document longer than a sequence is cut; an empty table gives no rows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 4
        for batch in batches:
            out: list[tuple] = []
            ids_of = batch.column("ids")
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "place", "tokens")]
            for i, (doc, place, tokens) in enumerate(zip(*columns)):
                ids = np.frombuffer(ids_of[i].as_buffer(), np.uint8)
                ids = ids.view(np.uint16 if len(ids) == 2 * tokens else np.uint32).astype("<u4")
                start = 0
                while start < tokens:
                    sequence, offset = divmod(place + start, length)
                    size = min(length - offset, tokens - start)
                    piece = ids[start : start + size].tobytes()
                    out.append(
                        (doc, start, size, piece, zlib.crc32(piece), tokens, sequence, offset)
                    )
                    start += size
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names
            )

    encoded = stored(_encoded(docs, tokenizer, end_id), "packing-ids")
    return (
        encoded.select("row", "doc_id", "tokens", "ids")
        .join(_placed(encoded), "row")
        .mapInArrow(
            cut,
            "doc_id long, start long, length long, ids binary, ids_crc32 long, "
            "doc_tokens long, sequence_id long, offset long",
        )
    )
