"""Hard negatives by a vertical scan of columns (branch and bound on dimensions).

Vectors are kept in blocks of bounded size, each column by column, with the smallest
and largest component of every column. An anchor reads the columns of a block in
descending order of its own magnitudes, a few at a time. What the columns still
unread can add to a score lies between two sums worked out from their smallest and
largest components; so each candidate has an interval that narrows, and a bitmap of
candidates shrinks until only scores that count are left, which are then whole.

The first scan finds the positives of every anchor (best scores with the same label);
the second finds, for each positive, the best rows of another label within a window of
scores. Every row is a candidate of every anchor: blocks meet slabs of anchors in a
grid, one block and one slab a group, so neither a label nor an anchor fills a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.storage import stored

BLOCK = 4_096  # vectors of a block, about
SLAB = 1_024  # anchors that meet a block in one group, about
COLUMNS = 16  # columns read between two looks at the bitmap
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
# Integer components of this size or more would not add up in 64 bits.
LARGEST = 1 << 26

_PAIR = "anchor_id long, positive_id long, score long"
_TRIPLE = "anchor_id long, positive_id long, positive_score long, negative_id long, score long"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and integer vector of the rows that take part.

    Components are floor(256 x). Left out are null ids, null labels, null or empty
    vectors, those with a null, NaN, infinite or huge (2**26 after scaling) component,
    and those of another length than most rows have. Repeated rows count once.
    """
    each = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND size(embedding) > 0")
    limit = F.lit(float(LARGEST // SCALE))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= limit))
    each = each.where(~F.coalesce(bad, F.lit(True)))
    usual = (
        each.groupBy(F.size("embedding").alias("length")).count().orderBy(F.desc("count"), "length")
    ).first()
    whole = F.transform("embedding", lambda x: F.floor(x * SCALE).cast("long"))
    return (
        each.where(F.size("embedding") == (usual["length"] if usual else 0))
        .select("vec_id", "label", whole.alias("vector"))
        .distinct()
    )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as rows of integers."""
    whole = column.combine_chunks()
    return whole.flatten().to_numpy().astype(np.int64).reshape(len(whole), -1)


def _grid(vectors: DataFrame, anchors: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Blocks once for each slab, and slabs once for each block; keys ``block`` and ``slab``.

    Both are dealt out by a hash of the vec_id. Copies are made before the shuffle by
    exploding a range, so that a group holds one block and one slab.
    """
    blocks, slabs = -(-rows // BLOCK) or 1, -(-anchors.count() // SLAB) or 1
    own = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int")
    asked = F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(slabs)).cast("int")
    return (
        vectors.withColumn("block", own).withColumn(
            "slab", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1)))
        ),
        anchors.withColumn("slab", asked).withColumn(
            "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        ),
    )


class _Block:
    """Columns of one block, and the bounds of what columns can add."""

    def __init__(self, rows: pa.Table):
        self.ids = rows.column("vec_id").to_numpy()
        self.labels = rows.column("label").to_numpy()
        self.columns = np.ascontiguousarray(_matrix(rows.column("vector")).T)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)
        self.most = int(np.abs(self.columns).max())
        self._doubles = None

    def numbers(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Columns and anchor as doubles where all sums are whole numbers below 2**53."""
        if self.most * int(np.abs(anchor).max()) * len(anchor) >= 1 << 53:
            return self.columns, anchor
        if self._doubles is None:
            self._doubles = self.columns.astype(np.float64)
        return self._doubles, anchor.astype(np.float64)

    def scan(self, anchor: np.ndarray, start: np.ndarray, look) -> tuple[np.ndarray, np.ndarray]:
        """Places and whole scores of the rows that are left of the bitmap ``start``.

        Columns are read in the anchor's order, some at a time. After each step ``look`` has
        the scores so far and the least and most that the rest can add, and says which
        rows stay. Rows are moved together whenever half of them are gone.
        """
        columns, weights = self.numbers(anchor)
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.sort(np.stack([anchor * self.low, anchor * self.high]), axis=0)[:, order]
        rest = np.zeros((2, len(order) + 1), np.int64)
        rest[:, :-1] = np.cumsum(ends[:, ::-1], axis=1)[:, ::-1]
        left = np.arange(len(self.ids))
        alive, score = start.copy(), np.zeros(len(left), columns.dtype)
        for at in range(0, len(order), COLUMNS):
            count = np.count_nonzero(alive)
            if not count:
                break
            if 2 * count <= len(alive):
                columns, left, score = columns[:, alive], left[alive], score[alive]
                alive = np.ones(count, bool)
            taken = order[at : at + COLUMNS]
            score += weights[taken] @ columns[taken]
            alive &= look(score, alive, *rest[:, at + len(taken)])
        return left[alive], score[alive].astype(np.int64)

    def best_alike(self, anchor_id, label, anchor, count) -> tuple[np.ndarray, np.ndarray]:
        """Places and whole scores of the rows of a label that may be among the best."""

        def look(score, alive, least, most):
            # The count-th best of what each row reaches at least.
            reached = score[alive]
            if len(reached) <= count:
                return alive
            at = len(reached) - count
            return score + most >= np.partition(reached, at)[at] + least

        return self.scan(anchor, (self.labels == label) & (self.ids != anchor_id), look)

    def within(self, label, anchor, low, high, count) -> tuple[np.ndarray, np.ndarray]:
        """Places and whole scores of rows of other labels that may be the best of a window.

        ``low`` and ``high`` have one window each.
        """
        bar = low.copy()

        def look(score, alive, least, most):
            reached = np.sort(score[alive])
            stay = np.zeros(len(score), bool)
            for w in range(len(bar)):
                # Rows whose interval lies within the window set the bar of this window.
                first = np.searchsorted(reached, low[w] - least, "left")
                last = np.searchsorted(reached, high[w] - most, "right")
                if last - first >= count:
                    bar[w] = max(bar[w], int(reached[last - count]) + least)
                stay |= (score >= bar[w] - most) & (score <= high[w] - least)
            return stay

        return self.scan(anchor, self.labels != label, look)


def _best(frame: DataFrame, keys: list[str], other: str, count: int) -> DataFrame:
    """The first ``count`` rows of each key by score, ties by the smaller id."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), other)
    return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def positives(vectors: DataFrame, anchors: DataFrame, count: int = POSITIVES) -> DataFrame:
    """anchor_id, positive_id and score: the best other rows of each anchor's label.

    Both frames come from ``usable``; a label with one row gives no positive.
    """
    rows = vectors.count()
    blocks, slabs = _grid(vectors, anchors, rows)

    def scan(own: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if own.num_rows and asked.num_rows:
            block = _Block(own)
            ids, labels = asked.column("vec_id").to_numpy(), asked.column("label").to_numpy()
            for i, label, anchor in zip(ids, labels, _matrix(asked.column("vector"))):
                left, score = block.best_alike(i, label, anchor, count)
                for at in np.lexsort((block.ids[left], -score))[:count]:
                    found.append((int(i), int(block.ids[left[at]]), int(score[at])))
        columns = list(zip(*found)) or [()] * 3
        return pa.table(
            [pa.array(c, pa.int64()) for c in columns], ["anchor_id", "positive_id", "score"]
        )

    paired = blocks.groupBy("block", "slab").cogroup(slabs.groupBy("block", "slab"))
    return _best(paired.applyInArrow(scan, _PAIR), ["anchor_id"], "positive_id", count).drop("rank")


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    window: tuple[int, int] = (50, 95),
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Both frames have vec_id, label and embedding; other columns are left alone. For each
    anchor and each of its positives come the best rows of other labels whose score is
    ``window`` per cent of the positive's, ends included; ties go to the smaller vec_id.
    A window without rows (as that of a negative score) gives none, and so do an anchor
    that ``usable`` leaves out, an anchor alone in its label, and empty tables.
    """
    spark = vectors.sparkSession
    vectors = stored(usable(vectors), "scan-vectors")
    # Anchors are looked up among the rows that take part, so lengths agree.
    asked = stored(
        usable(anchors).join(vectors, ["vec_id", "label", "vector"], "left_semi"), "scan-anchors"
    )
    if asked.isEmpty():
        return spark.createDataFrame(
            [],
            "anchor_id long, positive_id long, rank int, negative_id long, "
            "positive_score long, negative_score long",
        )
    found = stored(positives(vectors, asked, n_positives), "scan-positives")
    windows = found.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_list(F.struct("positive_id", "score"))).alias("wanted")
    )
    least, most = window
    blocks, slabs = _grid(vectors, asked.join(windows, "vec_id"), vectors.count())

    def scan(own: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if own.num_rows and wanted.num_rows:
            block = _Block(own)
            rows = zip(
                wanted.column("vec_id").to_pylist(),
                wanted.column("label").to_pylist(),
                _matrix(wanted.column("vector")),
                wanted.column("wanted").to_pylist(),
            )
            for i, label, anchor, pairs in rows:
                scores = np.array([p["score"] for p in pairs], np.int64)
                low, high = -(-least * scores // 100), most * scores // 100
                left, score = block.within(label, anchor, low, high, n_negatives)
                order = np.lexsort((block.ids[left], -score))
                ids, score = block.ids[left[order]], score[order]
                for w, pair in enumerate(pairs):
                    fits = np.flatnonzero((score >= low[w]) & (score <= high[w]))[:n_negatives]
                    for at in fits:
                        out.append(
                            (i, pair["positive_id"], pair["score"], int(ids[at]), int(score[at]))
                        )
        columns = list(zip(*out)) or [()] * 5
        return pa.table(
            [pa.array(c, pa.int64()) for c in columns],
            ["anchor_id", "positive_id", "positive_score", "negative_id", "score"],
        )

    paired = blocks.groupBy("block", "slab").cogroup(slabs.groupBy("block", "slab"))
    best = _best(
        paired.applyInArrow(scan, _TRIPLE), ["anchor_id", "positive_id"], "negative_id", n_negatives
    )
    return best.select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        "negative_id",
        "positive_score",
        F.col("score").alias("negative_score"),
    )
