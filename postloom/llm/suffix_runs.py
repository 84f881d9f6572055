"""Periodic runs of words, by suffix trees with constant-time longest common extensions.

A run is a stretch of words that repeats itself with a smallest period q, is at least
``max(least, 2 q)`` long, and cannot be extended with that period. Each has a Lyndon
root for one of the two orders of words, so all are found from the longest Lyndon word
at every place: two occurrences of a root side by side are extended to the right by the
longest common extension in a suffix tree of the text, and to the left by that in a
suffix tree of its reversal. Trees are built by Ukkonen's algorithm; the tour of a tree
gives the depth of the lowest common ancestor between neighbouring leaves, and a table
of minima over it answers any two leaves in constant time.

Only words that a run can hold go into the trees: with ``least`` = 12, a run shows each
of its stretches of six words twice, and these cover it whole; what no repeated stretch
covers lies in no run. Stretches of a slice of texts share one tree, each ended by
a word of its own, so that no run crosses it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.words import Slice, grams, hashes, mix, slices

LEAST = 12

_FOUND = "runs array<struct<start: long, length: long, period: long>>, collapsed string"


class SuffixTree:
    """Order of all suffixes of a text, and the common extension of any two.

    ``text`` holds numbers from 0 up; the last, 0, occurs nowhere else.
    """

    def __init__(self, text: np.ndarray):
        self.size = len(text)
        parents, symbols, children, depth, suffix = _ukkonen(text.tolist(), int(text.max()) + 1)
        self._edges = parents, symbols, children
        self._suffix = suffix
        order, lows = self._tour(symbols, depth)
        self.rank = np.empty(self.size, np.int64)
        self.rank[order] = np.arange(self.size)
        self._minima = [lows]
        wide = 1
        while 2 * wide <= self.size:
            last = self._minima[-1]
            self._minima.append(np.minimum(last[:-wide], last[wide:]))
            wide *= 2

    def _tour(self, symbols: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of leaves, and the depth of the ancestor with the leaf before."""
        parents, _, children = self._edges
        # Descending, as the last child pushed is the first one taken.
        sort = np.lexsort((-symbols, parents))
        parents, children = parents[sort], children[sort]
        bounds = np.searchsorted(parents, np.arange(len(depth) + 1))
        low, kids = bounds.tolist(), children.tolist()
        order, stack = [], [0]
        take, push, visit = stack.pop, stack.extend, order.append
        while stack:
            node = take()
            visit(node)
            if low[node] != low[node + 1]:
                push(kids[low[node] : low[node + 1]])
        walk = np.array(order[1:], np.int64)
        leaf = self._suffix[walk] >= 0
        above = np.empty(len(depth), np.int64)
        above[children] = parents
        # A node that is not its parent's first child begins where the parent branches.
        first = np.zeros(len(depth), bool)
        first[children[np.append(np.flatnonzero(np.diff(parents)), len(parents) - 1)]] = True
        place = np.cumsum(leaf) - leaf
        lows = np.zeros(self.size, np.int32)
        branches = ~first[walk]
        lows[place[branches]] = depth[above[walk[branches]]]
        return self._suffix[walk[leaf]], lows

    def opposite_rank(self) -> np.ndarray:
        """Ranks with the order of words turned round, a shorter suffix still first."""
        parents, symbols, _ = self._edges
        turned = np.where(symbols == 0, 0, symbols.max() + 1 - symbols)
        order, _ = self._tour(turned, np.zeros(len(self._suffix), np.int64))
        rank = np.empty(self.size, np.int64)
        rank[order] = np.arange(self.size)
        return rank

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common extension at two places that differ."""
        one, two = self.rank[a], self.rank[b]
        low, high = np.minimum(one, two) + 1, np.maximum(one, two)
        level = np.frexp(high - low + 1)[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            own = level == k
            table = self._minima[k]
            out[own] = np.minimum(table[low[own]], table[high[own] + 1 - (1 << int(k))])
        return out


def _ukkonen(text: list[int], width: int):
    """Edges (parent, symbol, child), string depths and suffixes (-1: inner) of nodes."""
    size = len(text)
    start, end, link, depth, suffix = [0], [0], [0], [0], [-1]
    edges: dict[int, int] = {}
    look = edges.get
    node = edge = length = left = 0
    for i, symbol in enumerate(text):
        left += 1
        last = 0
        while left:
            if not length:
                edge = i
            key = node * width + text[edge]
            child = look(key)
            if child is None:
                edges[key] = len(start)
                if last:
                    link[last] = node
                    last = 0
            else:
                first = start[child]
                reach = end[child] - first
                if length >= reach and suffix[child] < 0:
                    node = child
                    length -= reach
                    edge += reach
                    continue
                if text[first + length] == symbol:
                    length += 1
                    if last:
                        link[last] = node
                    break
                split = len(start)
                start.append(first)
                end.append(first + length)
                link.append(0)
                depth.append(left - 1)
                suffix.append(-1)
                edges[key] = split
                start[child] = first + length
                edges[split * width + text[first + length]] = child
                edges[split * width + symbol] = split + 1
                if last:
                    link[last] = split
                last = split
            start.append(i)
            end.append(size)
            link.append(0)
            depth.append(size - (i - left + 1))
            suffix.append(i - left + 1)
            left -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - left + 1
    keys = np.fromiter(edges, np.int64, len(edges))
    children = np.fromiter(edges.values(), np.int64, len(edges))
    return keys // width, keys % width, children, np.array(depth), np.array(suffix)


def _next_smaller(rank: np.ndarray) -> np.ndarray:
    """Next place with a smaller rank, for all places but the last (which has the least)."""
    values = rank.tolist()
    out = [0] * (len(values) - 1)
    stack = [len(values) - 1]
    for i in range(len(out) - 1, -1, -1):
        own = values[i]
        while values[stack[-1]] > own:
            stack.pop()
        out[i] = stack[-1]
        stack.append(i)
    return np.array(out, np.int64)


def runs(words: np.ndarray, least: int = LEAST) -> np.ndarray:
    """All runs of a text of numbered words (1 and up) as rows (start, length, period)."""
    size = len(words)
    if size < least:
        return np.zeros((0, 3), np.int64)
    tree = SuffixTree(np.append(words, 0))
    back = SuffixTree(np.append(words[::-1], 0))
    found = []
    for rank in (tree.rank, tree.opposite_rank()):
        first, second = np.arange(size), _next_smaller(rank)
        period = second - first
        ahead = tree.common(first, second)
        # The two roots have to be as long together with what lies left and right of them.
        behind = back.common(size - first, size - second)
        length = period + ahead + behind
        whole = (length >= 2 * period) & (length >= least)
        found.append(np.stack([first - behind, length, period], axis=1)[whole])
    return np.unique(np.concatenate(found), axis=0)


def _covered(hashed: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    """Whether a stretch of ``size`` words that its text holds twice covers each word."""
    out = np.zeros(len(hashed) + 1, np.int64)
    if len(hashed) < size:
        return out[:-1] > 0
    gram = grams(hashed, size)
    inside = np.flatnonzero(text[: len(gram)] == text[size - 1 :])
    own = mix(gram[inside] + mix(text[inside].astype(np.uint64)))
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[1:] = same
    twice[:-1] |= same
    starts = inside[order[twice]]
    np.add.at(out, starts, 1)
    np.subtract.at(out, starts + size, 1)
    return np.cumsum(out[:-1]) > 0


def _runs_of_slice(hashed: np.ndarray, text: np.ndarray, least: int) -> np.ndarray:
    """Runs of all texts of a slice as rows (place among its words, length, period)."""
    places = np.flatnonzero(_covered(hashed, text, max(1, least // 2)))
    if not len(places):
        return np.zeros((0, 3), np.int64)
    # A word of its own after each stretch of covered words, and after each text.
    ends = (np.diff(places) > 1) | (np.diff(text[places]) > 0)
    number = np.unique(hashed[places], return_inverse=True)[1] + 1
    after = np.flatnonzero(np.append(ends, True)) + 1
    joined = np.insert(number, after, number.max() + 1 + np.arange(len(after)))
    origin = np.insert(places, after, -1)
    found = runs(joined, least)
    found[:, 0] = origin[found[:, 0]]
    return found


def _whole_words(part: Slice) -> list[list[bytes]]:
    """The words of each text."""
    data, offsets = part.data.tobytes(), part.offsets.tolist()
    return [data[low:high].split() for low, high in zip(offsets, offsets[1:])]


def periodic_runs(
    docs: DataFrame,
    least: int = LEAST,
    arrange: Callable[[object, int], np.ndarray] | None = None,
) -> DataFrame:
    """doc_id, runs (start, length, period; by start, then period) and collapsed text.

    Words are stretches without ASCII white space. ``collapsed`` keeps the words that no
    run holds after its first period, joined by one space. ``arrange`` gives, for a doc_id
    and a number of words, the word that stands at each place; without it words stay as
    they are. One row comes out for each that goes in, also for repeated ids and a null
    id; a null or empty text has no runs and an empty collapsed text. A text is worked
    through whole, in memory that grows with its own words alone. Other columns go.
    """

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for part in slices(batch.column("text")):
                own = ids[part.first : part.last]
                found, collapsed = _of_slice(part, own, least, arrange)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own, pa.int64()),
                        pa.array(found, pa.list_(pa.struct(_RUN))),
                        pa.array(collapsed, pa.string()),
                    ],
                    ["doc_id", "runs", "collapsed"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(detect, f"doc_id long, {_FOUND}")


_RUN = [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]


def _of_slice(part: Slice, ids: list, least: int, arrange) -> tuple[list, list]:
    """Runs and collapsed text of each text of a slice."""
    found = part.words()
    hashed = hashes(part.sums(), found.starts, found.ends)
    words = _whole_words(part)
    firsts = found.firsts
    if arrange is not None:
        for k, (doc, own) in enumerate(zip(ids, words)):
            order = arrange(doc, len(own))
            if order is not None:
                at = slice(firsts[k], firsts[k] + len(own))
                hashed[at] = hashed[at][order]
                words[k] = [own[i] for i in order.tolist()]
    every = _runs_of_slice(hashed, found.text, least)
    dropped = np.zeros(len(hashed) + 1, np.int64)
    np.add.at(dropped, every[:, 0] + every[:, 2], 1)
    np.subtract.at(dropped, every[:, 0] + every[:, 1], 1)
    kept = np.cumsum(dropped[:-1]) == 0
    of_text = found.text[every[:, 0]]
    every[:, 0] -= firsts[of_text]
    every = every[np.lexsort((every[:, 2], every[:, 0], of_text))]
    bounds = np.searchsorted(np.sort(of_text), np.arange(len(words) + 1))
    rows, collapsed = [], []
    for k, own in enumerate(words):
        mine = every[bounds[k] : bounds[k + 1]].tolist()
        rows.append([dict(zip(("start", "length", "period"), r)) for r in mine])
        if mine:
            keep = kept[firsts[k] : firsts[k] + len(own)].tolist()
            own = [w for w, k in zip(own, keep) if k]
        collapsed.append(b" ".join(own).decode())
    return rows, collapsed


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: first start, then period) and digests.

    start, length, period and exponent_milli are null without a run.
    """
    longest = F.array_max(
        F.transform(
            "runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])
        ).cast("array<struct<length: long, start: long, period: long>>")
    )
    listed = F.transform(
        "runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    )
    lines = F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return (
        found.withColumn("longest", longest)
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            (-F.col("longest.start")).alias("start"),
            F.col("longest.length").alias("length"),
            (-F.col("longest.period")).alias("period"),
            F.sha2(lines, 256).alias("runs_sha256"),
            F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
        .withColumn("exponent_milli", F.expr("1000 * length div period"))
    )
