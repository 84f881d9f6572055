"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from postloom.llm import (
    adaptive_scan,
    bootstrapped_pii,
    bpe_rounds,
    chosen_path,
    curve_packing,
    external_shuffle,
    host_graph,
    positional_index,
    quality_mcd,
    sparse_suffix,
    string_kernel,
    suffix_runs,
    vertical_scan,
)
from postloom.llm.storage import share_package, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of each whose vec_id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings")
    return adaptive_scan.neighbours(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op2_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return string_kernel.languages(table(spark, sf_dir, "documents"))


def op3_bpe_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded text of every document."""
    return bpe_rounds.digests(table(spark, sf_dir, "documents"), BYTE_BPE)


def op4_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return bootstrapped_pii.personal_data(table(spark, sf_dir, "documents"))


def op5_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_mcd.judged(table(spark, sf_dir, "documents")).drop("text_hash")


def op6_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2,048 tokens."""
    return curve_packing.pack(table(spark, sf_dir, "documents"), WORD_BPE).drop("ids")


def op7_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, in 40 shards."""
    return external_shuffle.shard_digests(table(spark, sf_dir, "documents"), shards=40)


def op8_host_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    return host_graph.judged_pages(table(spark, sf_dir, "pages"))


def op9_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near copies of every document, by four-word shingles."""
    return chosen_path.near_copies(table(spark, sf_dir, "documents"), words=4, similarity=0.8)


def op10_sparse_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that documents share."""
    return sparse_suffix.repeated_passages(table(spark, sf_dir, "documents"))


def planted_order(doc_id: int | None, count: int) -> np.ndarray | None:
    """Word at each place of the texts that the contract of op12 makes periodic."""
    if doc_id is None or not count:
        return None
    drawn = zlib.crc32(str(doc_id).encode())
    if drawn % 10:
        return None
    group = drawn // 10
    first = group % count
    period = 1 + (count - first) // (3 + group % 8)
    places = np.arange(count)
    return np.where(places < first, places, first + (places - first) % period)


def op11_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of benchmark passages in every document."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return positional_index.contamination(docs, items)


def op12_suffix_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, some made periodic first."""
    docs = table(spark, sf_dir, "documents")
    return suffix_runs.run_digests(suffix_runs.periodic_runs(docs, arrange=planted_order))


def op13_vertical_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each vector whose vec_id is divisible by 50."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return vertical_scan.hard_negatives(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the pipeline over the documents."""
    return corpus_pipeline.run(spark, sf_dir)


_BUILDERS = [
    op1_adaptive_scan,
    op2_string_kernel,
    op3_bpe_rounds,
    op4_bootstrapped_pii,
    op5_quality_mcd,
    op6_curve_packing,
    op7_external_shuffle,
    op8_host_graph,
    op9_chosen_path,
    op10_sparse_suffix,
    op11_positional_index,
    op12_suffix_runs,
    op13_vertical_scan,
    pipeline,
]


def _sharing(build: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        share_package(spark)
        return build(spark, sf_dir)

    return run


LLM_REGISTRY = {build.__name__: _sharing(build) for build in _BUILDERS}

# Words, sets and components of near copies, by all pairs that share a shingle.
_NEAR_COPIES = r"""
WITH RECURSIVE lowered AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i : least(i + 3, len(words))], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i
          FROM lowered WHERE len(words) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY ALL
), links AS (
    SELECT a, b FROM shared s
    JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
    WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)
), ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
    SELECT doc_id AS start, doc_id AS there FROM documents
    UNION
    SELECT r.start, w.b FROM reached r JOIN ways w ON w.a = r.there
), smallest AS (
    SELECT start, min(there) AS component_id FROM reached GROUP BY start
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d
LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN smallest m ON m.start = d.doc_id
"""

# Windows of benchmark items within documents, by all stretches of as many words.
_CONTAMINATION = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(10, len(words)) AS k,
        array_to_string(words[i : i + least(10, len(words)) - 1], ' ') AS phrase
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 8, 2))) AS i
          FROM items WHERE len(words) > 0)
), stretches AS (
    SELECT doc_id, i, k, array_to_string(words[i : i + k - 1], ' ') AS phrase
    FROM (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS i
          FROM docs, (SELECT DISTINCT k FROM windows))
), found AS (
    SELECT doc_id, item_id, i, k FROM stretches JOIN windows USING (k, phrase)
), hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM found) GROUP BY doc_id
), held AS (
    SELECT doc_id, count(*) AS n_items,
        array_to_string(list(item ORDER BY item), ',') AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
    coalesce(i.n_items, 0) AS n_items, sha256(coalesce(i.listed, '')) AS items_sha256,
    coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h USING (doc_id) LEFT JOIN held i USING (doc_id)
"""

# Runs as stretches of words equal to those one period on, from equal six-word windows.
# 3988292384 is the polynomial of crc32, a fixed value.
_RUNS = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        xor(list_reduce(
            list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
            lambda c, b: list_reduce(range(8),
                lambda d, i: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END,
                xor(c, b)),
            CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) AS h
    FROM documents
), placed AS (
    SELECT doc_id, words, h, len(words) AS n,
        CASE WHEN len(words) > 0 THEN (h // 10) % len(words) END AS a
    FROM split
), arranged AS (
    SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n),
        lambda i: words[1 + CASE WHEN i < a THEN i
            ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) ELSE words END AS words
    FROM placed
), grams AS (
    SELECT doc_id, i, array_to_string(words[i + 1 : i + 6], ' ') AS gram
    FROM (SELECT doc_id, words, unnest(range(0, n - 5)) AS i FROM arranged)
), pairs AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y
    ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i
), islands AS (
    SELECT doc_id, q, min(i) AS start, count(*) + 5 + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
    GROUP BY doc_id, q, island
), runs AS (
    SELECT doc_id, start, length, min(q) AS period FROM islands
    WHERE length >= 12 AND length >= 2 * q GROUP BY doc_id, start, length
), listed AS (
    SELECT doc_id, count(*) AS n_runs,
        string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period)
            AS listed
    FROM runs GROUP BY doc_id
), longest AS (
    SELECT * FROM runs QUALIFY
        row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1
), dropped AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed
    FROM (SELECT doc_id, unnest(words) AS word, unnest(range(n)) AS i FROM arranged)
    ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, g.start, g.length, g.period,
    1000 * g.length // g.period AS exponent_milli,
    sha256(coalesce(l.listed, '')) AS runs_sha256,
    sha256(coalesce(k.collapsed, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed l USING (doc_id) LEFT JOIN longest g USING (doc_id)
LEFT JOIN kept k USING (doc_id)
"""

# Positives and the windows of scores below them, by the products of all pairs.
_HARD_NEGATIVES = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS alike,
        CAST(list_sum(list_transform(list_zip(a.vector, b.vector), lambda z: z[1] * z[2])) AS BIGINT)
            AS score
    FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id
        ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT alike
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

LLM_ORACLE: dict[str, str] = {
    "op9_chosen_path": _NEAR_COPIES,
    "op11_positional_index": _CONTAMINATION,
    "op12_suffix_runs": _RUNS,
    "op13_vertical_scan": _HARD_NEGATIVES,
}
if corpus_pipeline.ORACLE_SQL is not None:
    LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
