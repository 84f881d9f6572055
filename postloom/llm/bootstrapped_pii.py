"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Fixed expressions find the base spans. Their values are seeds: the words around
a mention are its lexical patterns, and patterns and values form a graph over
the whole corpus. In each round a pattern is scored by the share of a kind among
all values it stands beside, and a value by the patterns it stands in. Other
mentions of digits or of an at sign, which no base expression accepts, are taken
for a kind when values and patterns both reach a high score and the shape allows it.

Offsets count code points. They come from splitting a text at the matches: the
lengths of what lies between and of the matches add up to the places. The
expressions use possessive quantifiers and start only where a run of their
characters starts, so that they take linear time in long runs without a match.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.storage import stored

KINDS = ["email", "ip", "card", "phone"]

# The base expressions; all but their starts and possessive quantifiers is given.
EXPRESSIONS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # Anything else that might identify someone: numbers and words with an at sign.
    "other": r"[+(]?(?<![0-9])[0-9][0-9().\x20/:-]*[0-9]|(?<!\S)[^\s@]++@\S++",
}
# What a text must hold for a match, tested first.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_IP = rf"^{_PART}(?:\.{_PART}){{3}}$"

CONTEXT = 60  # characters kept on either side of a mention for its patterns
ROUNDS = 3
LEAST_SCORE = 0.85
LEAST_SEEDS = 5  # values of a kind beside a pattern


def _digits(value: Column) -> Column:
    """Number of digits of a value."""
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


def _accepted(kind: Column, value: Column) -> Column:
    """Whether a match of a base expression is one of its kind."""
    plain = F.regexp_replace(value, "[ -]", "")
    card = F.length(plain).between(12, 19) & F.expr("luhn_check(regexp_replace(value, '[ -]', ''))")
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", value.rlike(_IP))
        .when(kind == "card", card)
        .when(kind == "phone", _digits(value).between(9, 15))
        .otherwise(F.lit(False))
    )


def _shaped(kind: str, value: Column) -> Column:
    """Whether a value that no base expression accepts may be of a kind."""
    return {
        "email": value.contains("@"),
        "ip": value.rlike(r"^[0-9]+(?:[.:][0-9]+){3,7}$"),
        "card": _digits(value).between(12, 19),
        "phone": _digits(value).between(7, 15),
    }[kind]


def _matches(docs: DataFrame) -> DataFrame:
    """row, doc_id and, by expression, the matches of each text and what lies between."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    columns = []
    for name, expression in EXPRESSIONS.items():
        found = F.regexp_extract_all("text", F.lit(expression), F.lit(0))
        if name in NEEDS:
            found = F.when(F.contains("text", F.lit(NEEDS[name])), found)
        columns.append(found.alias(f"{name}_found"))
    found = source.select("*", F.xxhash64("doc_id", "text").alias("row"), *columns)
    parts = []
    for name, expression in EXPRESSIONS.items():
        some = F.size(f"{name}_found") > 0
        between = F.when(some, F.split("text", expression))
        between = F.transform(
            between,
            lambda piece: F.struct(
                F.length(piece).alias("length"),
                F.right(piece, F.lit(CONTEXT)).alias("left"),
                F.left(piece, F.lit(CONTEXT)).alias("right"),
            ),
        )
        parts += [F.when(some, F.col(f"{name}_found")).alias(f"{name}_found"), between.alias(name)]
    return found.select("row", "doc_id", *parts)


def _mentions(matches: DataFrame) -> DataFrame:
    """row, kind, start, end, value, left and right of each match, of repeated rows once."""
    mentions = None
    for name in EXPRESSIONS:
        places = F.arrays_zip(
            F.col(f"{name}_found").alias("value"),
            F.col(name).alias("before"),
            F.slice(name, 2, F.size(name)).alias("after"),
        )
        each = matches.where(F.col(name).isNotNull()).select(
            "row", F.lit(name).alias("kind"), F.posexplode(places).alias("place", "match")
        )
        mentions = each if mentions is None else mentions.union(each)
    upto = Window.partitionBy("row", "kind").orderBy("place")
    return (
        mentions.where(F.col("match.value").isNotNull())
        .dropDuplicates(["row", "kind", "place"])
        .select(
            "row",
            "kind",
            F.col("match.value").alias("value"),
            F.col("match.before.left").alias("left"),
            F.col("match.after.right").alias("right"),
            F.sum(F.col("match.before.length") + F.length("match.value")).over(upto).alias("end"),
        )
        .withColumn("start", F.col("end") - F.length("value"))
    )


def _patterns(left: Column, right: Column) -> Column:
    """Hashes of the lexical patterns of a mention: words before, and before and after."""
    before = F.lower(F.regexp_extract(left, r"(\S+)\s*$", 1))
    two = F.lower(F.regexp_extract(left, r"(\S+\s+\S+)\s*$", 1))
    after = F.lower(F.regexp_extract(right, r"^\s*(\S+)", 1))
    each = [
        F.when(two != "", F.xxhash64(F.lit("two"), F.regexp_replace(two, r"\s+", " "))),
        F.when((before != "") & (after != ""), F.xxhash64(F.lit("around"), before, after)),
        F.when(before != "", F.xxhash64(F.lit("before"), before)),
    ]
    return F.array_compact(F.array(*each))


def _base_and_other(mentions: DataFrame) -> DataFrame:
    """All base spans, and the other mentions that touch none of them (kind ``other``)."""
    checked = mentions.withColumn("base", _accepted(F.col("kind"), F.col("value"))).where(
        F.col("base") | (F.col("kind") == "other")
    )
    order = Window.partitionBy("row").orderBy("start", "end")
    earlier = F.max(F.when(F.col("base"), F.col("end"))).over(
        order.rowsBetween(Window.unboundedPreceding, -1)
    )
    later = F.min(F.when(F.col("base"), F.col("start"))).over(
        order.rowsBetween(1, Window.unboundedFollowing)
    )
    return (
        checked.withColumns({"earlier": earlier, "later": later})
        .where(
            F.col("base")
            | (
                (F.coalesce("earlier", F.lit(-1)) <= F.col("start"))
                & (F.coalesce("later", F.col("end")) >= F.col("end"))
            )
        )
        .select("row", "kind", "base", "start", "end", "value", _patterns(F.col("left"), F.col("right")).alias("patterns"))
    )


def _scores(spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scores by kind of patterns (pattern, ...) and of values (value, ...) after the last round."""
    kinds = [f"s_{k}" for k in KINDS]
    seeds = stored(
        spans.where("base")
        .groupBy("value")
        .agg(*(F.max((F.col("kind") == k).cast("double")).alias(f"s_{k}") for k in KINDS)),
        "pii-seeds",
    )
    edges = stored(
        spans.select("value", F.explode("patterns").alias("pattern")).distinct(), "pii-edges"
    )
    scores = seeds
    for turn in range(ROUNDS):
        patterns = (
            edges.join(scores, "value", "left")
            .groupBy("pattern")
            .agg(
                F.count("*").alias("values"),
                *(F.sum(F.coalesce(s, F.lit(0.0))).alias(s) for s in kinds),
            )
            .where(F.greatest(*kinds) >= LEAST_SEEDS)
            .select("pattern", *((F.col(s) / (F.col("values") + 0.5)).alias(s) for s in kinds))
            .where(F.greatest(*kinds) >= LEAST_SCORE)
        )
        patterns = stored(patterns, "pii-patterns")
        if turn == ROUNDS - 1:
            return patterns, scores
        missed = [F.exp(F.sum(F.log1p(-F.least(s, F.lit(0.99))))) for s in kinds]
        found = (
            edges.join(patterns, "pattern")
            .groupBy("value")
            .agg(*((1 - m).alias(s) for m, s in zip(missed, kinds)))
            .join(seeds.select("value"), "value", "left_anti")
        )
        scores = stored(seeds.unionByName(found), "pii-scores")
    raise AssertionError


def _added(spans: DataFrame) -> DataFrame:
    """row, kind, start and end of the mentions that the patterns discover."""
    patterns, scores = _scores(spans)
    kinds = [f"s_{k}" for k in KINDS]
    beside = (
        spans.where(~F.col("base"))
        .select("row", "start", "end", "value", F.explode("patterns").alias("pattern"))
        .join(patterns, "pattern")
        .groupBy("row", "start", "end", "value")
        .agg(*(F.max(s).alias(s) for s in kinds))
        .join(scores.select("value", *(F.col(s).alias(f"v{s}") for s in kinds)), "value")
    )
    best = reduce(
        lambda chain, k: chain.when(
            (F.col(f"s_{k}") >= LEAST_SCORE)
            & (F.col(f"vs_{k}") >= LEAST_SCORE)
            & _shaped(k, F.col("value")),
            F.lit(k),
        ),
        KINDS[1:],
        F.when(
            (F.col("s_email") >= LEAST_SCORE)
            & (F.col("vs_email") >= LEAST_SCORE)
            & _shaped("email", F.col("value")),
            F.lit("email"),
        ),
    )
    return beside.select("row", best.alias("kind"), "start", "end").where(F.col("kind").isNotNull())


def all_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of documents (row, doc_id), and spans (row, kind, base, start, end).

    ``docs`` has doc_id and text; a null text counts as empty. ``row`` is a hash of
    both, so repeated rows share their spans.
    """
    matches = stored(_matches(docs), "pii-matches")
    spans = stored(_base_and_other(_mentions(matches)), "pii-spans")
    base = spans.where("base").select("row", "kind", "base", "start", "end")
    added = _added(spans).select("row", "kind", F.lit(False).alias("base"), "start", "end")
    return matches.select("row", "doc_id"), base.union(added)


def personal_data(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, base counts by kind, base_sha256 and spans.

    Other columns are left alone. Null and empty texts have no spans; repeated rows
    get the same result each; an empty table gives no rows.
    """
    rows, spans = all_spans(docs)
    order = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))
    entry = F.struct("start", order.alias("order"), "end", "kind")
    found = spans.groupBy("row").agg(
        *(F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS),
        F.sort_array(F.collect_list(F.when(F.col("base"), entry))).alias("base"),
        F.sort_array(F.collect_list(entry)).alias("all"),
    )

    def listed(name: str) -> Column:
        return F.coalesce(
            F.array_join(
                F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
            ),
            F.lit(""),
        )

    return rows.join(found, "row", "left").select(
        "doc_id",
        *(F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS),
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed("all").alias("spans"),
    )


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, like ``[email]``.

    All rows and columns stay; n_chars, where present, follows the text. Where spans
    overlap, the one that starts first (of these, the longest) names the gap.
    """
    _, spans = all_spans(docs)
    order = Window.partitionBy("row").orderBy("start", F.col("end").desc(), "kind")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = spans.withColumn("reach", F.coalesce(reach, F.lit(0)))
    apart = apart.where(F.col("end") > F.col("reach")).select(
        "row", F.greatest("start", "reach").alias("start"), "end",
        F.when(F.col("start") >= F.col("reach"), F.concat(F.lit("["), "kind", F.lit("]")))
        .otherwise("").alias("mark"),
    )
    lists = apart.groupBy(F.col("row").alias("_mask_row")).agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "mark"))).alias("_masks")
    )
    plain = F.coalesce(docs["text"].cast("string"), F.lit(""))
    joined = docs.join(
        lists, F.xxhash64(docs["doc_id"].cast("long"), plain) == F.col("_mask_row"), "left"
    )
    first = F.array(F.struct(F.lit(0).cast("long").alias("end"), F.lit("").alias("mark")))
    befores = F.concat(first, F.transform("_masks", lambda s: F.struct(s["end"].alias("end"), s["mark"].alias("mark"))))
    stops = F.concat(F.transform("_masks", lambda s: s["start"]), F.array(F.length(plain).cast("long")))
    pieces = F.zip_with(
        befores,
        stops,
        lambda b, stop: F.concat(
            b["mark"],
            F.substring(plain, (b["end"] + 1).cast("int"), (stop - b["end"]).cast("int")),
        ),
    )
    text = F.when(F.col("_masks").isNull(), docs["text"]).otherwise(F.array_join(pieces, ""))
    changed = {"text": text.alias("text")}
    if "n_chars" in docs.columns:
        count = F.when(F.col("_masks").isNull(), docs["n_chars"]).otherwise(F.length(text))
        changed["n_chars"] = count.cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return joined.select(*(changed.get(c, docs[c]) for c in docs.columns))
