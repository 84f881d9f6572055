"""Chosen-path join against all pairs."""

from __future__ import annotations

import random

from postloom.llm.chosen_path import first_copies, near_copies, trees_for
from postloom.llm.components import components
from tests.llm import brute
from tests.llm.conftest import ODD


def test_whole_table(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = brute.near_copies(rows, 4, 80)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_copies(docs, 4).collect()}
    assert found == expected
    kept = {r.doc_id for r in first_copies(docs, 4).collect()}
    assert kept == {doc for doc, (_, first) in expected.items() if doc == first}


def test_large_group_of_near_copies(frame):
    draw = random.Random(5)
    words = [f"w{draw.randrange(10_000)}" for _ in range(120)]
    rows = []
    for doc in range(150):
        own = list(words)
        for _ in range(draw.choice([0, 1, 2, 4])):
            own[draw.randrange(len(own))] = f"x{draw.randrange(10_000)}"
        rows.append((doc, " ".join(own)))
    rows += [(1_000 + i, " ".join(f"y{draw.randrange(9_999)}" for _ in range(60))) for i in range(60)]
    rows += [(2_000 + i, rows[0][1]) for i in range(100)]
    expected = brute.near_copies(rows, 4, 80)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_copies(frame(rows), 4).collect()}
    assert found == expected


def test_trees_follow_from_the_similarity():
    assert trees_for(0.8) == (4, 16)
    for similarity in (0.2, 0.3, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97, 1.0):
        levels, trees = trees_for(similarity)
        assert (1 - similarity**levels) ** trees <= 1 / 4_500
        assert levels <= 8 and trees <= 40


def test_other_similarities(frame):
    draw = random.Random(17)
    rows = []
    for family in range(12):
        words = [f"f{family}w{i}" for i in range(80)]
        for member in range(25):
            own = list(words)
            for _ in range(draw.randrange(14)):
                own[draw.randrange(80)] = f"x{draw.randrange(10_000)}"
            rows.append((family * 100 + member, " ".join(own)))
    for similarity in (0.5, 0.9):
        expected = brute.near_copies(rows, 4, round(100 * similarity))
        found = near_copies(frame(rows), 4, similarity).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


def test_large_component_and_one_outside_it(frame, monkeypatch):
    # Chunks of a few texts, so that a node with little work is dealt over several blocks.
    monkeypatch.setattr("postloom.llm.chosen_path.CHUNK", 8)
    draw = random.Random(23)
    words = [f"w{i}" for i in range(150)]
    rows = []
    for doc in range(120):
        own = list(words)
        own[draw.randrange(150)] = f"x{doc}"
        rows.append((doc, " ".join(own)))
    for doc in range(200, 206):
        own = list(words)
        for at in draw.sample(range(150), 6 if doc % 2 else 9):
            own[at] = f"y{doc}-{at}"
        rows.append((doc, " ".join(own)))
    expected = brute.near_copies(rows, 4, 80)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_copies(frame(rows), 4).collect()}
    assert found == expected


def test_odd_rows(frame):
    found = near_copies(frame(ODD, extra=True), 4).collect()
    assert len(found) == len(ODD)
    by_id = {r.doc_id: r for r in found}
    for doc in (1, 2, 3):
        assert (by_id[doc].n_shingles, by_id[doc].component_id, by_id[doc].kept) == (0, doc, True)
    assert by_id[4].component_id == 4 and by_id[4].n_shingles == 4
    assert by_id[None].component_id is None and by_id[None].kept
    assert by_id[5].n_shingles == 1
    assert near_copies(frame([]), 4).collect() == []
    assert first_copies(frame(ODD, extra=True), 4).count() == len(ODD)


def test_long_text(frame):
    long = " ".join(f"w{i % 5_000}" for i in range(400_000))
    found = near_copies(frame([(7, long), (3, long + " end"), (9, "x")]), 4).collect()
    assert {r.doc_id: r.component_id for r in found} == {7: 3, 3: 3, 9: 9}


def test_components(spark):
    draw = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)]
    links += [(draw.randrange(200, 400), draw.randrange(200, 400)) for _ in range(90)]
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame([*links, (7, 7)], "a long, b long")).collect()
    assert {r.id: r.component for r in found} == {
        x: root(x) for x in parent if any(x in p and p[0] != p[1] for p in links)
    }
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_large_family_without_links_but_few(frame):
    """2,800 texts, mutually 0.75 alike; forty of them have one partner at 0.806."""
    stem = " ".join(f"s{i}" for i in range(99))
    tails = [[f"t{doc}x{i}" for i in range(16)] for doc in range(2_800)]
    linked = {2_760 + i: 50 * i for i in range(40)}
    for doc, partner in linked.items():
        tails[doc][:4] = tails[partner][:4]
    rows = [(doc, f"{stem} {' '.join(tail)}") for doc, tail in enumerate(tails)]
    found = {r.doc_id: r.component_id for r in near_copies(frame(rows), 4).collect()}
    assert found == {doc: linked.get(doc, doc) for doc, _ in rows}


def test_first_copies_judge_texts_and_not_ids(spark, frame):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, text),
        (2, text + " more"),  # a near copy of 1
        (2, "another text that stands alone here"),
        (3, "a third one that is only there once"),
        (3, "a third one that is only there once"),
        (5, "five words of its own text"),
        (5, text + " again"),
        (None, text),
    ]
    kept = first_copies(frame(rows, extra=True))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [rows[i] for i in (0, 2, 3, 4, 5, 7)], key=str
    )
    assert kept.columns == frame(rows, extra=True).columns
    assert first_copies(frame([])).collect() == []
