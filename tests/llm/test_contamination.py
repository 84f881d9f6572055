"""Positional index against plain searches for windows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from postloom.llm.positional_index import (
    bit_table,
    contamination,
    frequencies,
    may_hold,
    near_matches,
    postings,
    tokenized,
)
from tests.llm.brute import lower, sha
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def _words(text):
    return WORD.findall(lower(text or ""))


def _plain(docs, items, size=10):
    """(doc_id, n_words, n_hit, n_items, digest, contaminated) of each document."""
    windows = {}
    for item, text in items:
        words = _words(text)
        if words and item is not None:
            k = min(size, len(words))
            for i in range(len(words) - k + 1):
                windows.setdefault(tuple(words[i : i + k]), set()).add(str(item))
    out = []
    for doc, text in docs:
        words, hit, held = _words(text), set(), set()
        for k in {len(w) for w in windows}:
            for i in range(len(words) - k + 1):
                found = windows.get(tuple(words[i : i + k]))
                if found:
                    hit.update(range(i, i + k))
                    held |= found
        out.append((doc, len(words), len(hit), len(held), sha(",".join(sorted(held))), bool(hit)))
    return sorted(out, key=str)


def _found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_equals_plain_search(spark, frame):
    common = "the of and to in a is that for it as was with be by on not he his but".split()
    long_item = " ".join(f"w{i % 37} {common[i % 20]}" for i in range(40))
    items = [
        (1, long_item),
        (2, " ".join(common[:9])),  # shorter than a window
        (10, " ".join(common)),
        (11, " ".join(common).upper()),  # equal to another item after lowering
        (12, "a a a a a a a a a a a a"),
        (3, "never seen anywhere"),
        (4, None),
        (5, "?! ..."),
        (None, " ".join(common)),
        (2, "x1 x2 x3"),  # one id, two texts
    ]
    parts = long_item.split()
    docs = [
        (1, "Intro " + long_item + " end"),
        (2, " ".join(parts[:9])),  # one word short
        (3, " ".join(parts[5:15])),
        (4, " ".join(parts[5:10] + ["break"] + parts[10:20])),
        (5, " ".join(common[:9]) + " x1-x2, X3"),
        (6, " ".join(common) + ". " + " ".join(common)),
        (7, "a " * 30),
        (8, "Éa " + " ".join(parts[20:34]) + " éA"),
        (9, " ".join(parts[70:] + parts[:9])),
        *ODD,
        *[(100 + i, " ".join(common[:i] + common[i + 1 :])) for i in range(0, 20, 3)],
        (1, "another text"),
        (None, None),
    ]
    got = contamination(frame(docs, extra=True), spark.createDataFrame(items, ITEMS))
    assert _found(got) == _plain(docs, items)
    assert sum(r[-1] for r in _plain(docs, items)) > 6


def test_empty_tables(spark, frame):
    items = spark.createDataFrame([(1, "a b c")], ITEMS)
    none = spark.createDataFrame([], ITEMS)
    assert contamination(frame([]), items).collect() == []
    rows = [(1, "a b c"), (2, None)]
    assert _found(contamination(frame(rows), none)) == _plain(rows, [])


def test_a_crowd_of_copies_and_a_long_text(frame, spark):
    item = " ".join(f"t{i}" for i in range(30))
    docs = [(i, f"{item} tail{i % 3}") for i in range(300)]
    docs += [(1_000, "pad " * 40_000 + item), (1_001, " ".join([item] * 200))]
    items = [(7, item)]
    got = contamination(frame(docs), spark.createDataFrame(items, ITEMS))
    assert _found(got) == _plain(docs, items)


def test_index_and_frequencies(spark, frame):
    words = tokenized(frame([(1, "b a b"), (2, "A c"), (3, None)]))
    terms = spark.createDataFrame([("a",), ("b",), ("z",), ("b",)], "term string")
    assert {tuple(r) for r in frequencies(words, terms).collect()} == {("a", 2), ("b", 2), ("z", 0)}
    rows = postings(words).join(words.select("doc_id", "key_a"), "key_a")
    every = {(r.term, r.doc_id, r.place) for r in rows.collect()}
    assert every == {("b", 1, 0), ("a", 1, 1), ("b", 1, 2), ("a", 2, 0), ("c", 2, 1)}
    table = bit_table(terms, ["term"])
    assert spark.createDataFrame([("a",), ("b",)], "term string").where(may_hold(table, ["term"])).count() == 2


@pytest.mark.parametrize("within, docs", [(2, {1}), (6, {1, 2}), (40, {1, 2, 3})])
def test_near_matches(spark, frame, within, docs):
    rows = [
        (1, "red green blue"),
        (2, "blue x x green x x red"),
        (3, "green " + "x " * 20 + "red " + "x " * 15 + "blue"),
        (4, "red green"),
        (5, "x x x"),
    ]
    words = tokenized(frame(rows))
    items = spark.createDataFrame([(9, "red green blue")], ITEMS)
    found = near_matches(words, items, within).join(words.select("doc_id", "key_a"), "key_a")
    assert {r.doc_id for r in found.where(F.col("item_id") == "9").collect()} == docs


def test_no_python_and_no_cross_join(spark, docs):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l")], ITEMS)
    plan = contamination(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
