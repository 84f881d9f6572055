"""Near copies by a chosen-path set similarity join.

A text is the set of its word shingles. Texts with equal sets are one class,
which its smallest doc_id stands for. Independent trees then branch the classes:
at each level a tree selects one minwise token of a class, and classes with the
same tokens so far share a node. A small node is compared exhaustively, a large
one branches again. A node that stays large at the last level holds texts that
agree on many tokens; its members are compared with its first one, and if that
leaves it in more than one component, those outside its largest component are
compared with all of it, however large it is: in blocks of bounded size, which
many tasks share. Two texts of similarity 0.8 part at a level with a chance of a
fifth, so sixteen trees of four levels miss a link that is decided at level 3 once in
70,000 times, and one that is decided at level 4 once in 5,000. Levels and trees follow
from the similarity that is asked for, so that others are missed as rarely.

Candidates are confirmed on full sets of 64-bit shingle hashes: those of nodes
with much to compare within the block, others by a join. Since only components are
asked for, candidates within one component are passed over.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.components import components
from postloom.llm.storage import parallelism, stored
from postloom.llm.words import _power, grams, hashes, mix, slices

TOKENS = 64  # minwise tokens of a set
WIDE = 512  # of a set that is compared closely
MISSED = 1 / 4_500  # of links decided at the last level, at most
TOGETHER = 0.4  # chance at which a link is still together at the last level of a tree
MOST_LEVELS = 8
LEAF = 32  # largest node that is small
WORK = 1 << 20  # comparisons in one node beyond which blocks hold full sets
CHUNK, CHUNK_SETS = 1_024, 1 << 21  # texts and shingles of either side of a block, about

_FACTORS = np.random.default_rng(7_031).integers(0, 1 << 63, WIDE, np.uint64) * np.uint64(
    2
) + np.uint64(1)
_POSITION = 0x2545F4914F6CDD1D
_STEP = 1 << 30  # more than chunks of a node


def trees_for(similarity: float) -> tuple[int, int]:
    """Levels of a tree and number of trees that miss a link of that similarity rarely enough."""
    levels = max(1, sum(similarity**k >= TOGETHER for k in range(1, MOST_LEVELS + 1)))
    parted = max(1 - similarity**levels, 1e-9)
    return levels, math.ceil(math.log(MISSED) / math.log(parted))


def shingle_sets(column: pa.Array, words: int) -> Iterator[list[np.ndarray]]:
    """The sorted distinct shingle hashes of each text, some texts at a time.

    A-Z count as a-z. A text with fewer words has one shingle of all of them, a
    text without words (or null) none.
    """
    for run in slices(column):
        found = run.words()
        hashed = hashes(run.sums(lower=True), found.starts, found.ends)
        wide = grams(hashed, words)
        ends = np.cumsum(found.counts)
        at = np.arange(len(found)) - np.repeat(found.firsts, found.counts)
        spread = hashed * _power(_POSITION, int(found.counts.max(initial=0)) + 1)[at]
        running = np.concatenate([[np.uint64(0)], np.cumsum(spread, dtype=np.uint64)])
        sets = []
        for first, end in zip(found.firsts, ends):
            if end - first >= words:
                sets.append(np.unique(wide[first : end - words + 1]))
            elif end > first:
                whole = running[end : end + 1] - running[first : first + 1]
                sets.append(mix(whole + np.uint64(end - first)))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield sets


def _facts(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n, set fingerprint, minwise tokens and their last bytes of each row."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for sets in shingle_sets(batch.column("text"), words):
                sizes = np.array([len(s) for s in sets])
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                filled = np.flatnonzero(sizes)
                starts = (np.cumsum(sizes) - sizes)[filled]
                prints = np.zeros((2, len(sets)), np.uint64)
                tokens = np.zeros((len(sets), TOKENS), np.uint64)
                if len(filled):
                    for i in range(2):
                        spread = mix(flat ^ np.uint64(0xA5A5 + i))
                        prints[i, filled] = np.add.reduceat(spread, starts)
                    for i in range(TOKENS):
                        tokens[filled, i] = np.minimum.reduceat(flat * _FACTORS[i], starts)
                tokens = mix(tokens)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(done, len(sets)),
                        pa.array(sizes, pa.int64()),
                        pa.array(prints[0].view(np.int64)),
                        pa.array(prints[1].view(np.int64)),
                        _binary(tokens.astype(np.uint32)),
                        _binary((tokens >> np.uint64(56)).astype(np.uint8)),
                    ],
                    ["doc_id", "n", "p1", "p2", "tokens", "sketch"],
                )
                done += len(sets)

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(
        describe, "doc_id long, n long, p1 long, p2 long, tokens binary, sketch binary"
    )


def _binary(rows: np.ndarray) -> pa.Array:
    """A table of numbers as one binary value a row."""
    width = rows.shape[1] * rows.itemsize
    data = pa.py_buffer(np.ascontiguousarray(rows))
    return pa.Array.from_buffers(pa.binary(width), len(rows), [None, data]).cast(pa.binary())


def _table(column: pa.Array, kind: type, width: int) -> np.ndarray:
    """The rows of ``_binary``."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, kind).reshape(len(column), width)


def _order(tree: int) -> np.ndarray:
    """The order in which a tree selects minwise tokens."""
    return np.random.default_rng(1_000 + tree).permutation(TOKENS)


def _branched(opened: DataFrame, level: int, trees: int) -> DataFrame:
    """id and node of the open trees of each class; ``opened`` has id, tokens, trees."""
    orders = [_order(tree)[: level + 1] for tree in range(trees)]

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = _table(batch.column("tokens"), np.uint32, TOKENS).astype(np.uint64)
            open_trees = batch.column("trees")
            tree = open_trees.flatten().to_numpy().astype(np.int64)
            row = open_trees.value_parent_indices().to_numpy().astype(np.int64)
            ids = batch.column("id").to_numpy()
            node = np.zeros(len(tree), np.uint64)
            for t in range(trees):
                own = np.flatnonzero(tree == t)
                path = np.full(len(own), t + 1, np.uint64)
                for place in orders[t]:
                    path = mix(path * np.uint64(_POSITION) + tokens[row[own], place])
                node[own] = path
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[row]), pa.array(tree.astype(np.int32)), pa.array(node.view(np.int64))],
                ["id", "tree", "node"],
            )

    return opened.select("id", "tokens", "trees").mapInArrow(branch, "id long, tree int, node long")


def _near(nodes: DataFrame, similarity: float, width: int, mode: str) -> DataFrame:
    """Pairs a < b of a node whose sketches agree on about ``similarity`` or more.

    ``nodes`` has node, id, n, sketch (of ``width`` bytes) and component. Only pairs of
    different components are compared. Mode ``first`` gives each text its first
    partner. The other modes take the rows of ``_blocks``: ``best`` gives each text
    outside the node's largest component its most similar one, and ``all`` every partner
    of those; ``own`` then lists the nodes (tree, node) of each text, and a pair is given
    by the first tree only that has it in one node. ``exact`` is ``all`` with the full
    sets (hashes) at hand: it gives the pairs that have the similarity.
    """
    spread = 4 * (width * similarity * (1 - similarity)) ** 0.5
    least = int(width * similarity - spread)
    percent = round(100 * similarity)
    first = mode == "first"
    whole = mode in ("all", "exact")
    count = trees_for(similarity)[1]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if rest is not None:
                rows = pa.concat_tables([rest, rows])
            starts = starts_of(rows)
            for low, high in zip(starts, starts[1:]):
                yield from pairs_of(rows.slice(low, high - low))
            rest = rows.slice(starts[-1])
        if rest is not None:
            yield from pairs_of(rest)

    def starts_of(rows: pa.Table) -> np.ndarray:
        keys = np.stack([rows.column(c).to_numpy() for c in ("node", "block")])
        change = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        return np.flatnonzero(np.concatenate([[True], change]))

    def pairs_of(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """The pairs of one block."""
        if rows.num_rows < 2:
            return
        rows = rows.combine_chunks()
        ids, sizes, component = (rows.column(c).to_numpy() for c in ("id", "n", "component"))
        seen = np.arange(len(ids))
        if first:
            outside = seen
        else:
            part, block = rows.column("part").to_numpy(), rows.column("block")[0].as_py()
            home = part < 0
            outside = seen[~home]
        if not len(outside):
            return
        sketch = _table(rows.column("sketch").combine_chunks(), np.uint8, width)
        if whole:
            trees = rows.column("tree").to_numpy()
            own_nodes = rows.column("own").combine_chunks()
            where = own_nodes.value_parent_indices().to_numpy()
            listed = own_nodes.flatten()
            by_tree = np.zeros((len(ids), count), np.int64)
            by_tree[where, listed.field("tree").to_numpy()] = listed.field("node").to_numpy()
        if mode == "exact":
            flat = [np.frombuffer(h.as_buffer(), np.uint64) for h in rows.column("hashes")]
            upto = np.cumsum([0, *(len(h) for h in flat)])
            names, codes = np.unique(np.concatenate(flat), return_inverse=True)
            held = np.zeros(len(names), bool)
        lefts, rights, counts = [], [], []
        for u in outside:
            if first:
                others = seen[:u]
            elif block >= 0:
                others = seen if block % _STEP == 0 else seen[home]
            else:
                others = seen[part != part[u]]
            small = np.minimum(sizes[u], sizes[others])
            fit = small >= similarity * np.maximum(sizes[u], sizes[others]) - 1e-9
            others = others[fit & (component[others] != component[u])]
            if whole:
                once = (others > u) | home[others]
                before = by_tree[others, : trees[u]] == by_tree[u, : trees[u]]
                before &= by_tree[u, : trees[u]] != 0
                others = others[once & ~before.any(axis=1)]
            agreed = (sketch[others] == sketch[u]).sum(axis=1)
            if mode == "best" and len(agreed):
                others, agreed = others[[agreed.argmax()]], agreed[[agreed.argmax()]]
            others, agreed = others[agreed >= least], agreed[agreed >= least]
            if mode == "exact" and len(others):
                mine = codes[upto[u] : upto[u + 1]]
                held[mine] = True
                both = np.array([np.count_nonzero(held[codes[upto[o] : upto[o + 1]]]) for o in others])
                held[mine] = False
                alike = 100 * both >= percent * (sizes[u] + sizes[others] - both)
                others, agreed = others[alike], agreed[alike]
            if first:
                others, agreed = others[:1], agreed[:1]
            lefts.append(np.full(len(others), ids[u]))
            rights.append(ids[others])
            counts.append(agreed.astype(np.int64))
        a, b = np.concatenate(lefts), np.concatenate(rights)
        nodes_of = pa.array(np.full(len(a), rows.column("node")[0].as_py(), np.int64))
        columns = [nodes_of, pa.array(a), pa.array(b), pa.array(np.concatenate(counts))]
        yield pa.RecordBatch.from_arrays(columns, ["node", "u", "v", "agreed"])

    columns = ["node", "id", "n", "sketch", "component"]
    if first:
        blocks = nodes.select(*columns, F.lit(0).cast("long").alias("block"))
    else:
        columns += ["block", "part", *(["tree", "own"] * whole), *(["hashes"] * (mode == "exact"))]
        blocks = _blocks(nodes).select(*columns)
    found = (
        blocks.repartition(parallelism(nodes.sparkSession), "node", "block")
        .sortWithinPartitions("node", "block", "id")
        .mapInArrow(compare, "node long, u long, v long, agreed long")
    )
    if mode == "best":
        most = F.max(F.struct("agreed", "v")).alias("most")
        found = found.groupBy("node", "u").agg(most).select("u", F.col("most.v").alias("v"))
    return found.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()


def _blocks(nodes: DataFrame) -> DataFrame:
    """``nodes`` with block and part: each row once for every block that it belongs to.

    ``nodes`` has id, component, home (the node's largest component), inside and
    outside: the numbers of chunks of either. Block ``i * _STEP + j`` joins chunk i of the
    members outside with chunk j of those inside, and for j = 0 also the chunk i with
    itself; the block below zero of i < k joins two chunks of the members outside.
    Part is the chunk of a member outside, and -1 of one inside.
    """
    outer = F.col("component") != F.col("home")
    chunks = F.when(outer, F.col("outside")).otherwise(F.col("inside"))
    chunk = F.pmod(F.xxhash64(F.lit(11), "id"), chunks)
    step = F.lit(_STEP)

    def with_other(k):
        low, high = F.least("chunk", k), F.greatest("chunk", k)
        return -(low * step + high)

    inner = F.transform(_upto("outside"), lambda i: i * step + F.col("chunk"))
    outer_blocks = F.concat(
        F.transform(_upto("inside"), lambda j: F.col("chunk") * step + j),
        F.transform(F.filter(_upto("outside"), lambda k: k != F.col("chunk")), with_other),
    )
    return (
        nodes.withColumns({"chunk": chunk, "part": F.when(outer, chunk).otherwise(F.lit(-1).cast("long"))})
        .withColumn("block", F.explode(F.when(F.col("part") < 0, inner).otherwise(outer_blocks)))
    )


def _upto(count: str) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.col(count) - 1)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have that similarity."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            columns = batch.column("set_a"), batch.column("set_b")
            for i, (x, y) in enumerate(zip(*columns)):
                left, right = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                if len(left) > len(right):
                    left, right = right, left
                at = np.minimum(np.searchsorted(right, left), len(right) - 1)
                both = int((right[at] == left).sum())
                keep[i] = 100 * both >= percent * (len(left) + len(right) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("set_a")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("set_b")), "b")
        .mapInArrow(measure, "a long, b long")
    )


def _class_links(docs: DataFrame, classes: DataFrame, words: int, similarity: float) -> DataFrame:
    """Components of classes: id, component. ``classes`` has id, n, tokens, sketch."""
    percent = round(100 * similarity)

    def confirm(pairs: DataFrame) -> DataFrame:
        return stored(_confirmed(pairs, sets, percent), "path-links")

    features = classes.select("id", "n", "sketch")
    nodes, large = _descended(classes, *trees_for(similarity))
    one = nodes.where(F.col("size") <= LEAF).join(features, "id")
    near = _near(one.withColumn("component", F.col("id")), similarity, TOKENS, "first")
    stars = large.where(F.col("id") != F.col("pivot")).select(
        F.col("pivot").alias("a"), F.col("id").alias("b")
    )
    pairs = stored(near.union(stars).distinct(), "path-pairs")
    # All texts that any later pair can hold are in these nodes.
    sets = stored(_sets(docs, nodes.select("id").distinct(), words), "path-sets")
    links = confirm(pairs)
    labels = stored(components(links), "path-labels")
    mixed = stored(_mixed(nodes, labels, classes), "path-mixed")
    wide = stored(_wide(sets.join(mixed.select("id").distinct(), "id")), "path-wide")
    pairs = stored(_near(mixed.join(wide, "id"), similarity, WIDE, "best"), "path-pairs")
    links = links.union(confirm(pairs))
    labels = stored(components(links), "path-labels")
    mixed = stored(_mixed(nodes, labels, classes), "path-mixed")
    each = F.collect_list(F.struct("tree", "node")).alias("own")
    seen = mixed.join(mixed.groupBy("id").agg(each), "id").join(wide, "id")
    much = seen.where(F.col("work") > WORK).join(sets, "id")
    links = links.union(stored(_near(much, similarity, WIDE, "exact"), "path-links"))
    pairs = stored(_near(seen.where(F.col("work") <= WORK), similarity, WIDE, "all"), "path-pairs")
    return stored(components(links.union(confirm(pairs))), "path-labels")


def _mixed(nodes: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """The nodes with several components: id, n, tree, node, component and what is to do.

    That is work (comparisons), home (the largest component), and inside and outside:
    the numbers of chunks of its members and of the others.
    """
    named = nodes.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = stored(named.join(classes.select("id", "n"), "id"), "path-named")
    apart = (
        named.groupBy("node", "component")
        .agg(F.count("*").alias("count"), F.sum("n").alias("shingles"))
        .groupBy("node")
        .agg(
            F.sum("count").alias("all"),
            F.sum("shingles").alias("shingles"),
            F.max(F.struct("count", "shingles", "component")).alias("most"),
        )
        .withColumn("others", F.col("all") - F.col("most.count"))
        .where(F.col("others") > 0)
        .withColumn("work", F.col("others") * F.col("all"))
        .select(
            "node",
            "work",
            F.col("most.component").alias("home"),
            _chunks(F.col("most.count"), F.col("most.shingles")).alias("inside"),
            _chunks(F.col("others"), F.col("shingles") - F.col("most.shingles")).alias("outside"),
        )
    )
    return named.join(apart, "node").select(
        "id", "n", "tree", "node", "component", "work", "home", "inside", "outside"
    )


def _chunks(count: Column, shingles: Column) -> Column:
    """Number of chunks that so many texts with so many shingles are dealt over.

    Shingles count where blocks hold full sets. A node with few members outside its largest
    component is little work however large that is, and yet no task gets it whole.
    """
    texts = F.ceil(count / CHUNK)
    cut = F.greatest(texts, F.ceil(shingles / CHUNK_SETS))
    return F.when(F.col("work") > WORK, cut).otherwise(texts).cast("long")


def _wide(sets: DataFrame) -> DataFrame:
    """id and a sketch of ``WIDE`` bytes of each set, for close comparison."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(s.as_buffer(), np.uint64) for s in batch.column("hashes")]
            rows = np.zeros((len(found), WIDE), np.uint64)
            for row, hashed in zip(rows, found):
                for low in range(0, len(hashed), 256):
                    part = (hashed[low : low + 256, None] * _FACTORS).min(axis=0)
                    row[:] = np.minimum(row, part) if low else part
            bits = (mix(rows) >> np.uint64(56)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column("id"), _binary(bits)], ["id", "sketch"])

    return sets.select("id", "hashes").mapInArrow(sketch, "id long, sketch binary")


def _descended(classes: DataFrame, levels: int, count: int) -> tuple[DataFrame, DataFrame]:
    """Small nodes met on all levels of ``count`` trees and large ones of the last level.

    Gives the rows (id, tree, node, size, pivot) of both, and of the large ones alone.
    """
    nodes = None
    opened = classes.withColumn("trees", F.array(*(F.lit(t) for t in range(count))))
    for level in range(levels):
        keyed = stored(_branched(opened, level, count), "path-nodes")
        sizes = stored(
            keyed.groupBy("node")
            .agg(F.count("*").alias("size"), F.min("id").alias("pivot"))
            .where(F.col("size") > 1),
            "path-sizes",
        )
        shared = stored(keyed.join(sizes, "node"), "path-shared")
        large = shared.where(F.col("size") > LEAF)
        done = level == levels - 1 or large.isEmpty()
        met = shared if done else shared.where(F.col("size") <= LEAF)
        nodes = met if nodes is None else nodes.union(met)
        if done:
            break
        trees = large.groupBy("id").agg(F.collect_list("tree").alias("trees"))
        opened = classes.join(trees, "id")
    return nodes, large


def _sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """id and hashes (sorted, 64-bit) of the texts of ``ids``."""

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for sets in shingle_sets(batch.column("text"), words):
                ids = batch.column("id").slice(done, len(sets))
                values = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([ids, values], ["id", "hashes"])
                done += len(sets)

    source = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")
    )
    return source.join(ids, "id", "left_semi").mapInArrow(to_sets, "id long, hashes binary")


def near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    ``docs`` has doc_id and text; other columns are left alone. component_id is the
    smallest doc_id that links lead to. Null, empty and blank texts have no
    shingles and are linked with nothing; a row without a doc_id takes no part and
    is kept, with a null component; repeated rows get the same result each; rows of
    one doc_id with different texts are classes of their own, or one class if the
    doc_id stands for both. An empty table gives no rows.
    """
    facts = stored(_facts(docs, words), "path-facts")
    part = facts.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    sets = stored(part.groupBy("p1", "p2", "n").agg(F.min("doc_id").alias("id")), "path-classes")
    classes = stored(
        part.join(sets, ["p1", "p2", "n"])
        .where(F.col("doc_id") == F.col("id"))
        .select("id", "n", "tokens", "sketch")
        .dropDuplicates(["id", "tokens"]),
        "path-classes",
    )
    labels = _class_links(docs, classes, words, similarity)
    named = stored(
        sets.join(labels, "id", "left").select(
            "p1", "p2", "n", F.coalesce("component", "id").alias("component_id")
        ),
        "path-named",
    )
    found = facts.drop("tokens", "sketch").join(named, ["p1", "p2", "n"], "left")
    component = F.coalesce(
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")), F.col("doc_id")
    )
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _row_ids(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row_id``: the doc_id, or a number above all of them.

    Rows of a doc_id that stands for several texts get one number for each text, in the
    order of doc_ids. Such rows are told from two narrow columns; usually there are none,
    and the join that names them is with an empty table.
    """
    doc, print_ = F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))
    pairs = docs.select(doc.alias("_doc"), print_.alias("_print")).where(F.col("_doc").isNotNull())
    several = (
        pairs.groupBy("_doc")
        .agg(F.min("_print").alias("least"), F.max("_print").alias("most"))
        .where(F.col("least") != F.col("most"))
    )
    crowded = stored(pairs.join(several, "_doc", "left_semi").distinct(), "path-crowded")
    ordered = crowded.repartitionByRange(
        parallelism(docs.sparkSession), "_doc", "_print"
    ).sortWithinPartitions("_doc", "_print")
    numbers = stored(ordered.withColumn("_number", F.monotonically_increasing_id()), "path-numbers")
    highest = F.coalesce(pairs.agg(F.max("_doc")).scalar(), F.lit(0))
    same = (doc == F.col("_doc")) & (print_ == F.col("_print"))
    number = highest + 1 + F.col("_number")
    return (
        docs.join(numbers, same, "left")
        .withColumn("_row_id", F.coalesce(number, doc))
        .drop("_doc", "_print", "_number")
    )


def first_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` without those whose near copies come before them.

    Rows come in the order of doc_ids. Of several texts under one doc_id each is judged by
    itself, after those whose doc_id is theirs alone; exact repeats of a row go or stay
    with it; rows without a doc_id stay.
    """
    named = _row_ids(docs)
    found = near_copies(named.select(F.col("_row_id").alias("doc_id"), "text"), words, similarity)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("_row_id")).distinct()
    return named.join(gone, "_row_id", "left_anti").drop("_row_id")
