"""Nearest neighbours by an adaptive scan of dimensions within probed lists.

Vectors are dealt to lists by their nearest centroid (k-means on a bounded sample)
and turned by one random rotation, after which the first dimensions of a
difference estimate its whole length. A list is kept in blocks of bounded size,
and a block in blocks of columns. A query scans a block column by column: after
each, a hypothesis test compares the partial distance with the tenth best distance
so far and abandons the candidates that are hardly among the nearest; what is left
at the end is measured exactly on the original vectors, and the blocks that a task scans
after it go by the tenth best distance that its blocks have given the query. Every
vector is in the index; the sample only decides on lists and gives each query a first
bound. A query that ends with fewer rows than there are candidates for is searched
again in all lists without the test.

Queries travel in bundles of bounded size, and a list is cut into blocks, so that
neither a list nor a crowd of queries with a third of all rows meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.storage import stored

NEAREST = 10
SAMPLE = 16_384  # vectors for centroids and first bounds, at most about so many
MOST_LISTS = 4_096
# Lists are probed until this share of the neighbours of some different vectors of the sample
# would be found, each tried against all others of it.
TARGET, TRIALS = 0.98, 1_024
BLOCK, BUNDLE = 512, 256  # vectors of a block, queries of a bundle, about
COLUMNS = 16
HELD = 16_384  # queries whose nearest a task keeps
CONFIDENCE = 2.5  # of the test; the chance to abandon a near one falls with its square
_SEED = 5


@dataclass
class Lists:
    """Centroids, the rotation and a sample of the vectors."""

    centroids: np.ndarray
    rotation: np.ndarray
    sample_ids: np.ndarray
    sample: np.ndarray
    probes: int

    def order(self, vectors: np.ndarray) -> np.ndarray:
        """Numbers of the lists by distance, nearest first, one row a vector."""
        return np.argsort(_squares(vectors, self.centroids), axis=1, kind="stable")


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows, up to rounding."""
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows of doubles."""
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)


def sound(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part.

    Left out are null ids, vectors that are null, empty, zero or hold a null or
    non-finite component, and those of another length than most rows have.
    """
    each = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0))
    bad = F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    each = each.where(~bad & F.exists("embedding", lambda x: x != 0))
    lengths = each.groupBy(F.size("embedding").alias("length")).count()
    usual = lengths.orderBy(F.desc("count"), "length").first()
    return each.where(F.size("embedding") == (usual["length"] if usual else 0))


def learn(vectors: DataFrame) -> Lists | None:
    """Lists from the vectors whose hashed id falls into the sample; None without vectors."""
    count = vectors.count()
    if not count:
        return None
    share = min(1.0, SAMPLE / count)
    chosen = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    drawn = chosen.limit(2 * SAMPLE).toArrow()
    if not drawn.num_rows:
        drawn = vectors.limit(1).toArrow()
    ids = drawn.column("vec_id").to_numpy()
    sample = _matrix(drawn.column("embedding").combine_chunks())
    order = np.argsort(ids, kind="stable")
    ids, sample = ids[order], sample[order]
    random = np.random.default_rng(_SEED)
    points = np.unique(sample, axis=0)
    lists = max(1, min(MOST_LISTS, int(np.sqrt(count)), len(points) // 4))
    centroids = points[random.choice(len(points), lists, replace=False)]
    for _ in range(8):
        owner = _squares(points, centroids).argmin(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, points)
        sizes = np.bincount(owner, minlength=lists)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    rotation, _ = np.linalg.qr(random.standard_normal((sample.shape[1], sample.shape[1])))
    learned = Lists(centroids, rotation, ids, sample, lists)
    learned.probes = _probes(learned)
    return learned


def _probes(lists: Lists) -> int:
    """Number of lists in which ``TARGET`` of the neighbours within the sample lie."""
    # A crowd of equal vectors counts once: its members find each other in one list.
    points = np.unique(lists.sample, axis=0)
    tried = np.random.default_rng(_SEED).permutation(len(points))[:TRIALS]
    apart = _squares(points[tried], points)
    apart[np.arange(len(tried)), tried] = np.inf
    count = min(NEAREST, apart.shape[1])
    near = np.argpartition(apart, count - 1, axis=1)[:, :count]
    owner = _squares(points, lists.centroids).argmin(axis=1)
    order = lists.order(points[tried])
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], axis=1)
    needed = np.take_along_axis(place, owner[near], axis=1)
    return int(np.quantile(needed, TARGET)) + 1


def _blocks(vectors: DataFrame, lists: Lists) -> tuple[DataFrame, np.ndarray]:
    """The index (list, ids, columns, originals), and the number of vectors by list."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = _squares(_matrix(batch.column("embedding")), lists.centroids).argmin(axis=1)
                yield batch.append_column("list", pa.array(near.astype(np.int32)))

    dealt = stored(
        vectors.mapInArrow(deal, "vec_id long, embedding array<double>, list int"), "scan-dealt"
    )
    sizes = np.zeros(len(lists.centroids), np.int64)
    for row in dealt.groupBy("list").count().collect():
        sizes[row["list"]] = row["count"]
    parts = F.element_at(
        F.array(*(F.lit(int(-(-s // BLOCK) or 1)) for s in sizes)), F.col("list") + 1
    )
    cut = dealt.withColumn("part", F.pmod(F.xxhash64(F.lit(1), "vec_id"), parts).cast("int"))

    def block(rows: pa.Table) -> pa.Table:
        ids = rows.column("vec_id").to_numpy()
        originals = _matrix(rows.column("embedding").combine_chunks())
        _, first = np.unique(
            np.concatenate([ids[:, None].astype(np.float64), originals], axis=1),
            axis=0,
            return_index=True,
        )
        first = first[np.argsort(ids[first], kind="stable")]
        out: list[tuple] = []
        for low in range(0, len(first), BLOCK):
            own = first[low : low + BLOCK]
            turned = (originals[own] @ lists.rotation).astype(np.float32)
            columns = [
                np.ascontiguousarray(turned[:, c : c + COLUMNS]).tobytes()
                for c in range(0, turned.shape[1], COLUMNS)
            ]
            out.append(
                (
                    rows.column("list")[0].as_py(),
                    ids[own].astype("<i8").tobytes(),
                    b"".join(columns),
                    originals[own].tobytes(),
                )
            )
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        names = ["list", "ids", "columns", "originals"]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    made = cut.groupBy("list", "part").applyInArrow(
        block, "list int, ids binary, columns binary, originals binary"
    )
    return stored(made, "scan-blocks"), sizes


def _bundles(
    queries: DataFrame, lists: Lists, sizes: np.ndarray, nearest: int, every: bool = False
) -> DataFrame:
    """list, query_ids, query_vectors and bounds: the queries that probe a list, in bundles.

    With ``every`` all lists are probed, without a bound.
    """

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["list", "query_id", "vector", "bound"]
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, ids = _matrix(batch.column("embedding")), batch.column("vec_id").to_numpy()
            order = lists.order(vectors)
            # As many lists as the sample asks for, and as hold enough candidates.
            held = np.cumsum(sizes[order], axis=1) - sizes[order]
            wanted = (np.arange(order.shape[1])[None, :] < lists.probes) | (held < nearest + 1)
            wanted = (wanted | every) & (sizes[order] > 0)
            apart = np.maximum(_squares(vectors, lists.sample), 0)
            apart[ids[:, None] == lists.sample_ids[None, :]] = np.inf
            bound = np.full(len(ids), np.inf)
            if apart.shape[1] >= nearest and not every:
                bound = np.partition(apart, nearest - 1, axis=1)[:, nearest - 1] * (1 + 1e-6) + 1e-9
            row, place = np.nonzero(wanted)
            raw = [v.tobytes() for v in vectors]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(order[row, place].astype(np.int32)),
                    pa.array(ids[row]),
                    pa.array([raw[r] for r in row], pa.binary()),
                    pa.array(bound[row]),
                ],
                names,
            )

    probed = queries.select("vec_id", "embedding").mapInArrow(
        probe, "list int, query_id long, vector binary, bound double"
    )

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists_of = batch.column("list").to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], lists_of[1:] != lists_of[:-1]]))
            out = []
            for low, high in zip(starts, [*starts[1:], len(lists_of)]):
                for at in range(low, high, BUNDLE):
                    own = batch.slice(at, min(BUNDLE, high - at))
                    out.append(
                        (
                            int(lists_of[low]),
                            own.column("query_id").to_numpy().astype("<i8").tobytes(),
                            b"".join(own.column("vector").to_pylist()),
                            own.column("bound").to_numpy().tobytes(),
                        )
                    )
            kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            names = ["list", "query_ids", "query_vectors", "bounds"]
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names
            )

    return (
        probed.repartitionByRange("list", "query_id")
        .sortWithinPartitions("list", "query_id")
        .mapInArrow(bundle, "list int, query_ids binary, query_vectors binary, bounds binary")
    )


def _scan_block(
    ids: np.ndarray,
    columns: np.ndarray,
    originals: np.ndarray,
    queries: np.ndarray,
    vectors: np.ndarray,
    bounds: np.ndarray,
    rotation: np.ndarray,
    nearest: int,
) -> Iterator[tuple[int, int, float]]:
    """The nearest of one block for each query of a bundle: query, vec_id and distance."""
    size, width = originals.shape
    turned = (vectors @ rotation).astype(np.float32)
    starts = range(0, width, COLUMNS)
    parts, at = [], 0
    for c in starts:
        wide = min(COLUMNS, width - c)
        parts.append(columns[at : at + size * wide].reshape(size, wide))
        at += size * wide
    for q, query in enumerate(queries):
        left = np.flatnonzero(ids != query)
        partial = np.zeros(len(left))
        seen = 0
        for c, part in zip(starts, parts):
            off = part[left] - turned[q, c : c + COLUMNS]
            partial += np.einsum("ij,ij->i", off, off)
            seen += part.shape[1]
            if seen < width:
                limit = bounds[q] * seen / width * (1 + CONFIDENCE / np.sqrt(seen)) ** 2
                stay = partial <= limit
                left, partial = left[stay], partial[stay]
        off = originals[left] - vectors[q]
        exact = np.sqrt(np.einsum("ij,ij->i", off, off))
        best = np.lexsort((ids[left], exact))[:nearest]
        for i in best:
            yield int(query), int(ids[left[i]]), float(exact[i])


def _scanned(blocks: DataFrame, bundles: DataFrame, rotation: np.ndarray, nearest: int) -> DataFrame:
    """query_id, vec_id and score of what the probed blocks give each query, stored."""
    width = rotation.shape[0]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Squared distances of the nearest so far, by query, for a bounded number of queries.
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                query_ids = np.frombuffer(row["query_ids"], "<i8")
                raw = row["query_vectors"]
                keys = [(int(q), raw[8 * width * i : 8 * width * (i + 1)]) for i, q in enumerate(query_ids)]
                bounds = np.frombuffer(row["bounds"], np.float64).copy()
                for i, key in enumerate(keys):
                    if key in held and len(held[key]) == nearest:
                        bounds[i] = min(bounds[i], held[key][-1] * (1 + 1e-6) + 1e-9)
                found = list(
                    _scan_block(
                        ids,
                        np.frombuffer(row["columns"], np.float32),
                        np.frombuffer(row["originals"], np.float64).reshape(len(ids), width),
                        query_ids,
                        np.frombuffer(raw, np.float64).reshape(-1, width),
                        bounds,
                        rotation,
                        nearest,
                    )
                )
                if len(held) > HELD:
                    held.clear()
                near: dict[int, list[float]] = {}
                for query, _, score in found:
                    near.setdefault(query, []).append(score * score)
                if len(set(query_ids)) == len(keys):
                    for key in (k for k in keys if k[0] in near):
                        both = np.concatenate([held.get(key, np.zeros(0)), near[key[0]]])
                        held[key] = np.sort(both)[:nearest]
                columns = list(zip(*found)) or [()] * 3
                kinds = [pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    ["query_id", "vec_id", "score"],
                )

    found = (
        blocks.join(bundles, "list")
        .mapInArrow(scan, "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
    )
    return stored(found, "scan-found")


def neighbours(vectors: DataFrame, queries: DataFrame, nearest: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id and score: the nearest found of each query, nearest first.

    Both frames have vec_id and embedding; other columns are left alone. Score is the
    Euclidean distance of the original vectors in double precision; ties go to the
    smaller vec_id. Rows that ``sound`` leaves out neither ask nor answer; repeated rows
    count once, and of different vectors with one id the nearer one; a query with
    fewer candidates than ``nearest`` gets them all; empty tables give no rows.
    """
    vectors = sound(vectors)
    lists = learn(vectors)
    schema = "query_id long, rank int, vec_id long, score double"
    if lists is None:
        return vectors.sparkSession.createDataFrame([], schema)
    blocks, sizes = _blocks(vectors, lists)
    width = lists.rotation.shape[0]
    asked = sound(queries).where(F.size("embedding") == width)
    bundles = stored(_bundles(asked, lists, sizes, nearest), "scan-bundles")

    found = _scanned(blocks, bundles, lists.rotation, nearest)
    # Equal vectors of one id were counted once for each when lists were filled.
    enough = min(nearest, int(sizes.sum()) - 1)
    counted = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n"))
    full = counted.where(F.col("n") >= enough)
    short = stored(asked.join(full, "vec_id", "left_anti"), "scan-short")
    if not short.isEmpty():
        again = stored(_bundles(short, lists, sizes, nearest, every=True), "scan-bundles")
        more = _scanned(blocks, again, lists.rotation, nearest)
        found = found.join(short, found["query_id"] == short["vec_id"], "left_anti").union(more)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= nearest)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
