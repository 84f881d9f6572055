"""Runs against a plain search over all periods."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postloom.llm.queries import LLM_REGISTRY, planted_order
from postloom.llm.suffix_runs import SuffixTree, _of_slice, periodic_runs, runs
from postloom.llm.words import slices
import pyarrow as pa

from tests.llm.brute import WORD, sha
from tests.llm.conftest import ODD


def _plain(words, least):
    """(start, length, period) of all runs, by one pass for each period."""
    out, seen = [], set()
    for q in range(1, len(words) // 2 + 1):
        start = 0
        for i in range(q, len(words) + 1):
            if i == len(words) or words[i] != words[i - q]:
                length = i - start
                if length >= max(least, 2 * q) and (start, i) not in seen:
                    seen.add((start, i))
                    out.append((start, length, q))
                start = i - q + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def _collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=70), st.sampled_from([2, 4, 12]))
def test_runs_equal_plain_search(words, least):
    found = [tuple(r) for r in runs(np.array(words), least).tolist()]
    assert sorted(found, key=lambda r: (r[0], r[2])) == _plain(words, least)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "é"]), max_size=80), min_size=1, max_size=5))
def test_slices_of_texts_equal_plain_search(texts):
    (part,) = slices(pa.array([" ".join(t) for t in texts]))
    rows, collapsed = _of_slice(part, [0] * len(texts), 12, None)
    for own, row, text in zip(texts, rows, collapsed):
        expected = _plain(own, 12)
        assert [(r["start"], r["length"], r["period"]) for r in row] == expected
        assert text == _collapsed(own, expected)


def test_tree_sorts_suffixes():
    draw = np.random.default_rng(1)
    text = np.append(draw.integers(1, 4, 200), 0)
    tree = SuffixTree(text)
    whole = text.tolist()
    order = sorted(range(len(whole)), key=lambda i: whole[i:])
    assert tree.rank[order].tolist() == list(range(len(whole)))
    turned = [0 if s == 0 else 4 - s for s in whole]
    order = sorted(range(len(whole)), key=lambda i: turned[i:])
    assert tree.opposite_rank()[order].tolist() == list(range(len(whole)))
    a, b = draw.integers(0, 200, 500), draw.integers(0, 200, 500)
    a, b = a[a != b], b[a != b]
    for i, j, n in zip(a, b, tree.common(a, b)):
        plain = 0
        while whole[i + plain] == whole[j + plain]:
            plain += 1
        assert plain == n


def test_odd_rows(spark, frame):
    rows = [*ODD, (7, "a b " * 10), (8, "x " * 11), (8, "x " * 12 + "y"), (9, "  " * 13)]
    found = periodic_runs(frame(rows, extra=True)).collect()
    assert len(found) == len(rows)
    by_text = {(r.doc_id, r.collapsed): [tuple(x) for x in r.runs] for r in found}
    assert by_text[7, "a b"] == [(0, 20, 2)]
    assert by_text[8, " ".join("x" * 11)] == []
    assert by_text[8, "x y"] == [(0, 12, 1)]
    assert by_text[9, " "] == [(0, 13, 1)]
    assert by_text[1, ""] == by_text[2, ""] == by_text[3, ""] == []
    assert by_text[None, ODD[3][1]] == []
    assert periodic_runs(frame([])).collect() == []


def test_long_text_of_one_word(spark, frame):
    text = "w " * 60_000 + "end " + "p q r " * 30_000
    (row,) = periodic_runs(frame([(1, text)])).collect()
    assert [tuple(r) for r in row.runs] == [(0, 60_000, 1), (60_001, 90_000, 3)]
    assert row.collapsed == "w end p q r"


@pytest.mark.parametrize("root", ["/root/testdata/sf0.01"])
def test_query_equals_plain_search(spark, root):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{root}/documents.parquet").collect()}
    found = {r.doc_id: r for r in LLM_REGISTRY["op12_suffix_runs"](spark, root).collect()}
    assert found.keys() == docs.keys()
    checked = 0
    for doc, text in docs.items():
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        if n > 3_000:
            continue  # the plain search takes the square of the length
        checked += 1
        expected = _plain(words, 12)
        row = found[doc]
        best = max(expected, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        assert (row.n_runs, row.start, row.length, row.period) == (len(expected), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if best[1] else None)
        assert row.runs_sha256 == sha("".join(f"{s},{k},{q}\n" for s, k, q in expected))
        assert row.collapsed_sha256 == sha(_collapsed(words, expected))
    assert checked > 900


def test_planted_order():
    assert planted_order(None, 5) is None and planted_order(7, 0) is None
    doc = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    assert planted_order(doc, 40).tolist() != list(range(40))


def test_word_pattern_is_ascii_space():
    assert re.findall(WORD, "a\x1fb\x0bc") == ["a\x1fb", "c"]
    assert "a\x1fb\x0bc".encode().split() == [b"a\x1fb", b"c"]
