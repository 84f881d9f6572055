"""Sparse suffix array against a table of all runs of 50 words."""

from __future__ import annotations

import random

import numpy as np

from postloom.llm.sparse_suffix import (
    BITS,
    KEYS,
    REACH,
    RUN,
    STEM,
    _keys,
    _minimisers,
    repeated_passages,
    without_repeats,
)
from postloom.llm.words import Words
from tests.llm import brute
from tests.llm.conftest import ODD


def _check(frame_of_docs):
    rows = {r.doc_id: r.text for r in frame_of_docs.select("doc_id", "text").collect()}
    expected = brute.repeated_words(list(rows.items()))
    spans: dict = {}
    for r in repeated_passages(frame_of_docs).collect():
        spans.setdefault(r.doc_id, []).append(r)
    assert set(spans) == set(expected)
    for doc, (repeated, cut) in expected.items():
        places = [m.span() for m in brute.WORD.finditer(rows[doc])]
        for first in (True, False):
            found = {
                i
                for s in spans[doc]
                if s.first == first
                for i, (a, b) in enumerate(places)
                if s.start <= a and b <= s.end
            }
            assert found == (repeated - cut if first else cut)
        assert sum(s.n_words for s in spans[doc]) == len(repeated)
    texts = {r.doc_id: r.text for r in without_repeats(frame_of_docs).collect()}
    assert set(texts) == set(rows)
    for doc, text in rows.items():
        kept = [w for i, w in enumerate(brute.WORD.findall(text)) if i not in expected.get(doc, (0, ()))[1]]
        assert brute.WORD.findall(texts[doc]) == kept or doc in expected
        if doc not in expected:
            assert texts[doc] == text


def test_whole_table(docs):
    _check(docs)


def test_planted(frame):
    draw = random.Random(11)

    def fresh(n):
        return [f"é{draw.randrange(10**9)}" for _ in range(n)]

    passage, other = fresh(51), fresh(70)
    rows = [(i, "  ".join(fresh(30) + passage + fresh(40))) for i in range(20)]
    rows += [(100 + i, "\n".join(fresh(i) + other[i : i + 55] + fresh(20))) for i in range(14)]
    rows += [(200, " ".join(passage[:49] + fresh(9))), (201, " ".join(passage)), (202, " ".join(fresh(500)))]
    rows += [(300 + i, " ".join(passage[10:] + other)) for i in range(30)]
    rows += [(400, " ".join(["same"] * 300)), (401, " ".join(["same"] * 120 + fresh(80)))]
    _check(frame(rows))


def test_odd_rows(frame):
    long = " ".join(f"w{i}" for i in range(300_000))
    rows = [*ODD, (None, long), (8, long), (9, long + " x"), (8, long)]
    made = frame(rows, extra=True)
    found = {(r.doc_id, r.start, r.end, r.first) for r in repeated_passages(made).collect()}
    assert found == {(8, 0, len(long), True), (9, 0, len(long), False)}
    cut = without_repeats(made)
    assert cut.columns == made.columns and cut.count() == len(rows)
    assert [r.text for r in cut.where("doc_id = 9").collect()] == [" x"]
    assert repeated_passages(frame([])).collect() == []


def test_minimisers_beyond_two_to_the_24th_word():
    """Places are kept in full, so a passage late in a very long text has its own."""
    count = (1 << 24) + 4_000
    draw = np.random.default_rng(5)
    hashed = draw.integers(0, 1 << 63, count, np.uint64)
    late = count - 600
    hashed[late : late + 120] = hashed[1_000:1_120]
    starts = np.arange(count)
    found = Words(starts, starts + 1, np.zeros(count, np.int8), np.array([count]))
    firsts, places = _minimisers(found, hashed)
    assert len(firsts) == count - RUN + 1
    assert ((places >= firsts) & (places < firsts + REACH)).all()
    early = places[1_000 : 1_000 + 71] - 1_000
    assert (places[late : late + 71] - late == early).all()


def test_suffixes_are_in_the_order_of_their_words():
    draw = np.random.default_rng(9)
    alphabet = draw.integers(0, 1 << 63, 3, np.uint64) * np.uint64(2)
    hashed = alphabet[draw.integers(0, 3, 3_000)]
    places = np.arange(len(hashed) - STEM)
    keys = _keys(hashed, places)
    assert len(keys) == len(KEYS) and all((k >= 0).all() for k in keys)
    packed = [tuple(int(k[p]) for k in keys) for p in places]
    codes = [int(h) >> (64 - BITS) for h in hashed]
    words = [tuple(codes[p : p + STEM]) for p in places]
    assert sorted(places, key=packed.__getitem__) == sorted(places, key=words.__getitem__)
    assert len(set(packed)) == len(set(words))
