"""Quality rules: fixed base tests, then robust multivariate outliers.

Each text becomes five counts and a vector of five transformed statistics. For
every language and source, for every language, and for all texts, a minimum-
covariance-determinant estimate is made over all texts there: from coordinate-
wise medians, concentration steps keep the nearer three quarters and estimate
again. A text is rejected by its Mahalanobis distance in the finest group with
enough texts. All estimates are Spark aggregates: sums of products, and
histograms of distances, which are added up before they are shuffled, so that
one source with a third of all rows costs no more than others.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.storage import stored
from postloom.llm.words import SPACES, grams, hashes, mix, slices

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
LETTERS = np.zeros(256, bool)  # also bytes of letters beyond ASCII
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
REPEAT_WINDOW = 5

DIMENSIONS = 5
# Least standard deviation by statistic: most texts have no symbol and no repeated
# line at all, so that an estimate alone would call any single one an outlier.
FLOORS = [0.10, 0.06, 0.15, 0.15, 0.10]
# Rejected beyond this squared distance: chi-squared of five dimensions at 0.9999.
CUTOFF = 25.74
SHARE = 0.75  # of a group's texts in the estimate
MOST_STEPS = 8
LEAST_TEXTS = 50  # of a language or source; all texts together are estimated from any number
SMALL_GROUPS = 10_000  # whose estimates (some 250 bytes each) are broadcast
# Statistics of a short text are drawn to the usual by so many words and bytes more.
PRIOR_WORDS, PRIOR_CHARS = 40, 200
USUAL_LENGTH = 5.0
MEDIAN_CHI2 = 4.351  # of five dimensions


def text_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The five counts of each text, and what the statistics need beside them."""
    names = [*COUNTS, "n_lines", "n_letters"]
    parts: dict[str, list[np.ndarray]] = {name: [] for name in names}
    for run in slices(column):
        words, sums = run.words(), run.sums()
        chars = (run.data & 0xC0) != 0x80
        in_word = ~SPACES[run.data]

        def total(mask: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(mask)])
            return np.diff(upto[run.offsets])

        parts["n_words"].append(words.counts)
        parts["word_chars"].append(total(chars & in_word))
        parts["n_symbols"].append(total(SYMBOLS[run.data]))
        parts["n_letters"].append(total(chars & LETTERS[run.data]))

        breaks = np.flatnonzero(run.data == 10)
        starts = np.unique(np.concatenate([run.offsets[:-1], breaks + 1]))
        starts = starts[starts < len(run.data)]
        stops = np.unique(np.concatenate([run.offsets[1:], breaks]))
        at = np.searchsorted(stops, starts)
        # The end of the text before is not that of a text's first line.
        at += (stops[at] == starts) & (run.data[starts] != 10)
        ends = stops[at]
        text = np.searchsorted(run.offsets, starts, "right") - 1
        filled = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
        starts, ends, text = starts[filled], ends[filled], text[filled]
        _, first = np.unique(_within(hashes(sums, starts, ends), text), return_index=True)
        lines = np.bincount(text, minlength=len(run))
        parts["n_lines"].append(lines)
        parts["n_dup_lines"].append(lines - np.bincount(text[first], minlength=len(run)))

        repeated = np.zeros(len(words) + 1, np.int64)
        wide = grams(hashes(sums, words.starts, words.ends), REPEAT_WINDOW)
        whole = np.flatnonzero(words.text[: len(wide)] == words.text[REPEAT_WINDOW - 1 :])
        _, where, times = np.unique(
            _within(wide[whole], words.text[whole]), return_inverse=True, return_counts=True
        )
        again = whole[times[where] > 1]
        np.add.at(repeated, again, 1)
        np.add.at(repeated, again + REPEAT_WINDOW, -1)
        covered = np.cumsum(repeated)[:-1] > 0
        parts["n_repeat_words"].append(np.bincount(words.text[covered], minlength=len(run)))
    return {
        name: np.concatenate(part).astype(np.int64) if part else np.zeros(0, np.int64)
        for name, part in parts.items()
    }


def _within(hashed: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that differ between texts."""
    return mix(hashed + (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))


def statistics(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Transformed statistics, one row a text: word length and four shares."""
    words = counts["n_words"] + PRIOR_WORDS
    chars = counts["word_chars"] + PRIOR_CHARS

    def share(part: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.arcsin(np.sqrt(np.clip(part / of, 0, 1)))

    return np.stack(
        [
            np.log((counts["word_chars"] + USUAL_LENGTH * PRIOR_WORDS) / words),
            share(counts["n_symbols"], chars),
            share(counts["n_dup_lines"], counts["n_lines"] + 5),
            share(counts["n_repeat_words"], words),
            share(np.maximum(counts["word_chars"] - counts["n_letters"], 0), chars),
        ],
        axis=1,
    )


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, text_hash, the counts and the statistics x0..x4."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = text_counts(batch.column("text"))
            vectors = statistics(counts)
            columns = [batch.column(c) for c in ("doc_id", "lang", "source", "text_hash")]
            columns += [pa.array(counts[c]) for c in COUNTS]
            columns += [pa.array(vectors[:, i]) for i in range(DIMENSIONS)]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "lang", "source", "text_hash", *COUNTS]
    names += [f"x{i}" for i in range(DIMENSIONS)]
    schema = "doc_id long, lang string, source string, text_hash long"
    schema += "".join(f", {c} long" for c in COUNTS)
    schema += "".join(f", x{i} double" for i in range(DIMENSIONS))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(measure, schema)


def _distance(centre: str = "mean", weight: str = "inverse") -> Column:
    """Squared Mahalanobis distance from the group's estimate."""
    off = [F.col(f"x{i}") - F.col(centre)[i] for i in range(DIMENSIONS)]
    terms = []
    for i in range(DIMENSIONS):
        for j in range(i, DIMENSIONS):
            times = F.lit(1.0 if i == j else 2.0)
            terms.append(off[i] * off[j] * F.col(weight)[i * DIMENSIONS + j] * times)
    return reduce(lambda a, b: a + b, terms)


def _bin(distance: Column) -> Column:
    """Number of a distance's bin, sixteen to each doubling."""
    return F.floor(F.log2(F.greatest(distance, F.lit(1e-6))) * 16).cast("int")


def _invert(products: DataFrame) -> DataFrame:
    """Mean, inverse covariance and log determinant of each subset from its sums of products."""

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for row in frame.itertuples(index=False):
                n = row.n
                mean = np.array(row.sums) / n
                cov = np.zeros((DIMENSIONS, DIMENSIONS))
                cov[np.triu_indices(DIMENSIONS)] = np.array(row.products) / n
                cov = cov + np.triu(cov, 1).T - np.outer(mean, mean)
                logdet = np.linalg.slogdet(cov + np.diag(np.square(FLOORS)))[1]
                cov = cov * row.scale + np.diag(np.square(FLOORS))
                inverse = np.linalg.inv(cov).ravel().tolist()
                rows.append((row.grouped, row.start, mean.tolist(), inverse, logdet))
            yield pd.DataFrame(rows, columns=["grouped", "start", "mean", "inverse", "logdet"])

    return products.mapInPandas(
        solve,
        "grouped string, start int, mean array<double>, inverse array<double>, logdet double",
    )


def _starts(vectors: DataFrame) -> DataFrame:
    """Two first estimates of every group: by quartiles, and by all of its texts."""
    xs = [F.col(f"x{i}") for i in range(DIMENSIONS)]
    found = vectors.groupBy("grouped").agg(
        *(F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i, x in enumerate(xs)),
        *(F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)),
        *(F.coalesce(F.var_pop(x), F.lit(0.0)).alias(f"v{i}") for i, x in enumerate(xs)),
    )
    spread = [(F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349 for i in range(DIMENSIONS)]
    kinds = [
        ([F.col(f"q{i}")[1] for i in range(DIMENSIONS)], [w * w for w in spread]),
        ([F.col(f"m{i}") for i in range(DIMENSIONS)], [F.col(f"v{i}") for i in range(DIMENSIONS)]),
    ]

    def start(number: int) -> Column:
        mean, variance = kinds[number]
        inverse = [
            1 / (variance[i] + FLOORS[i] ** 2) if i == j else F.lit(0.0)
            for i in range(DIMENSIONS)
            for j in range(DIMENSIONS)
        ]
        return F.struct(
            F.lit(number).alias("start"), F.array(*mean).alias("mean"), F.array(*inverse).alias("inverse")
        )

    every = F.explode(F.array(*(start(n) for n in range(len(kinds)))))
    return found.select("grouped", every.alias("s")).select("grouped", "s.*")


def _next_estimate(vectors: DataFrame, model: DataFrame, beside) -> DataFrame:
    """Estimates from the nearest share of each group's texts (a concentration step)."""
    xs = [F.col(f"x{i}") for i in range(DIMENSIONS)]
    products = [xs[i] * xs[j] for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]
    keys = ["grouped", "start"]
    binned = vectors.join(beside(model), "grouped").select(*keys, *xs, _bin(_distance()).alias("bin"))
    upto, whole = Window.partitionBy(*keys).orderBy("bin"), Window.partitionBy(*keys)
    near = (
        binned.groupBy(*keys, "bin")
        .agg(F.count("*").alias("n"))
        .select(
            *keys,
            "bin",
            (F.sum("n").over(upto) - F.col("n")).alias("before"),
            F.sum("n").over(whole).alias("all"),
        )
        .groupBy(*keys)
        .agg(
            F.max(F.when(F.col("before") < F.col("all") * SHARE, F.col("bin"))).alias("last"),
            F.max(F.when(F.col("before") < F.col("all") * 0.5, F.col("bin"))).alias("middle"),
        )
    )
    sums = (
        binned.join(beside(near), keys)
        .where(F.col("bin") <= F.col("last"))
        .groupBy(*keys)
        .agg(
            F.count("*").alias("n"),
            F.array(*(F.sum(x) for x in xs)).alias("sums"),
            F.array(*(F.sum(p) for p in products)).alias("products"),
            F.max("middle").alias("middle"),
        )
    )
    # Half of a normal sample lies within the median of chi-squared.
    scale = F.greatest(F.lit(1.0), F.pow(F.lit(2.0), (F.col("middle") + 1) / 16) / MEDIAN_CHI2)
    return _invert(sums.withColumn("scale", scale))


def beside_rows(count: int):
    """How a table of ``count`` groups is joined to all texts: broadcast while it is small.

    Beyond the bound it is a plain join, of which adaptive execution splits hot groups.
    """
    return F.broadcast if count <= SMALL_GROUPS else lambda frame: frame


def estimates(vectors: DataFrame) -> DataFrame:
    """MCD estimate of every group: grouped, mean, inverse.

    ``vectors`` has grouped and x0..x4, one row for each text and group. From each of two
    starts the nearest texts are taken again and again until no subset changes (its
    determinant stands still) or ``MOST_STEPS`` are done; of each group's subsets the one
    with the smallest determinant stays.
    """
    model = stored(_starts(vectors), "mcd-model")
    beside = beside_rows(2 * model.select("grouped").distinct().count())
    before = None
    for _ in range(MOST_STEPS):
        model = stored(_next_estimate(vectors, model, beside), "mcd-model")
        state = model.agg(
            F.sum(F.xxhash64("grouped", "start", F.round("logdet", 5)).cast("decimal(38,0)"))
        ).first()[0]
        if state == before:
            break
        before = state
    least = F.min_by(F.struct("mean", "inverse"), F.struct("logdet", "start")).alias("best")
    return stored(model.groupBy("grouped").agg(least).select("grouped", "best.*"), "mcd-model")


def _group(level: int, *columns: str) -> Column:
    """Name of a group; a null language or source is a value of its own."""
    return F.concat_ws(
        "\x1f", F.lit(str(level)), *(F.coalesce(F.concat(F.lit("="), c), F.lit("-")) for c in columns)
    )


def judged(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, text_hash, the counts, base_failed, distance, kept.

    ``docs`` has doc_id, text, lang and source; other columns are left alone.
    Null and empty texts have no words and so fail the base test; null
    languages and sources are groups like others; groups with few texts go by the
    estimate of their language, or of all texts however few these are; repeated rows are
    judged alike; of an empty table nothing is returned.
    """
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    groups = [_group(2, "lang", "source"), _group(1, "lang"), _group(0)]
    names = [f"name{i}" for i in range(len(groups))]
    facts = measured(docs).withColumns(dict(zip(names, groups)))
    facts = stored(facts.withColumn("base_failed", base_failed), "mcd-facts")
    xs = [f"x{i}" for i in range(DIMENSIONS)]
    good = facts.where(~F.col("base_failed")).select(
        F.explode(F.array(*names)).alias("grouped"), *xs
    )
    sizes = good.groupBy("grouped").agg(F.count("*").alias("n"))
    many = (F.col("n") >= LEAST_TEXTS) | (F.col("grouped") == _group(0))
    enough = stored(sizes.where(many).select("grouped"), "mcd-groups")
    beside = beside_rows(enough.count())
    model = estimates(good.join(beside(enough), "grouped"))
    result = facts
    for i in range(len(names)):
        side = model.select(
            F.col("grouped").alias(f"name{i}"),
            F.col("mean").alias(f"mean{i}"),
            F.col("inverse").alias(f"inverse{i}"),
        )
        result = result.join(beside(side), f"name{i}", "left")
    result = result.withColumn(
        "distance",
        F.coalesce(*(_distance(f"mean{i}", f"inverse{i}") for i in range(len(names)))),
    )
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)
    return result.select("doc_id", "text_hash", *COUNTS, "base_failed", "distance", kept.alias("kept"))


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    rejected = judged(docs).where(~F.col("kept")).select(
        F.col("doc_id").alias("_rejected_id"), F.col("text_hash").alias("_rejected_hash")
    ).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_rejected_id")) & (
        F.xxhash64(docs["text"]) == F.col("_rejected_hash")
    )
    return docs.join(rejected, same, "left_anti")
