"""Quality rules: counts against plain Python, estimates against numpy."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np

from postloom.llm import quality_mcd
from tests.llm.brute import WORD
from tests.llm.conftest import ODD


def _counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            repeated.update(range(i, i + 5))
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def _check(found, texts):
    for r in found:
        own = tuple(r[c] for c in quality_mcd.COUNTS)
        assert own == _counts(texts[r.doc_id])
        assert r.base_failed == (own[0] < 10 or 100 * own[4] > 20 * own[0])
        assert not (r.base_failed and r.kept)


def test_counts_of_whole_table(docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = quality_mcd.judged(docs).collect()
    assert len(found) == len(texts)
    _check(found, texts)
    # Odd marks behind words are the table's junk; all of it goes, and little else.
    junk = {d for d, t in texts.items() if sum(t.count(m) for m in ("***", "$$$", "%%%", "###")) > 20}
    gone = {r.doc_id for r in found if not r.kept and not r.base_failed}
    assert junk and junk <= {r.doc_id for r in found if not r.kept}
    assert len(gone) < 0.1 * len(texts)
    kept = quality_mcd.drop_rejected(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in found if r.kept}


def test_estimate_against_numpy(spark):
    draw = np.random.default_rng(3)
    clean = draw.multivariate_normal(np.zeros(5), np.diag([1, 2, 3, 4, 5]) * 0.1, 4000)
    odd = draw.normal(6, 0.1, (600, 5))
    rows = [("g", *map(float, x)) for x in np.vstack([clean, odd])]
    frame = spark.createDataFrame(rows, "grouped string, x0 double, x1 double, x2 double, x3 double, x4 double")
    model = quality_mcd.estimates(frame).first()
    assert np.abs(np.array(model["mean"]) - clean.mean(axis=0)).max() < 0.1
    cov = np.linalg.inv(np.array(model["inverse"]).reshape(5, 5)) - np.diag(np.square(quality_mcd.FLOORS))
    truth = np.cov(clean.T)
    assert np.abs(np.diag(cov) / np.diag(truth) - 1).max() < 0.4


def test_odd_rows(frame):
    draw = random.Random(1)
    rows = [(100 + i, " ".join(f"word{draw.randrange(99)}" for _ in range(40)), "en", "s") for i in range(80)]
    rows += [(doc, text, None, None) for doc, text in ODD]
    rows += [(7, "a b\na b\n a b\na b ", None, "s"), (8, "x " * 200_000, "en", None)]
    made = frame(rows, extra=True)
    found = quality_mcd.judged(made).collect()
    assert len(found) == len(rows)
    _check(found, {doc: text for doc, text, *_ in rows})
    assert all(r.kept for r in found if r.doc_id and r.doc_id >= 100)
    assert quality_mcd.judged(frame([])).collect() == []
    assert quality_mcd.drop_rejected(made).count() == 80
    assert quality_mcd.drop_rejected(made).columns == made.columns


def _plain_mcd(rows, starts):
    """Least log determinant over many random starts, each taken until it stands still."""
    draw, least = np.random.default_rng(9), (np.inf, None)
    size = int(np.ceil(quality_mcd.SHARE * len(rows)))
    floors = np.diag(np.square(quality_mcd.FLOORS))
    for _ in range(starts):
        own = rows[draw.choice(len(rows), 12, replace=False)]
        for _ in range(30):
            mean, cov = own.mean(axis=0), np.cov(own.T, bias=True) + floors
            off = rows - mean
            far = np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off)
            own = rows[np.argsort(far)[:size]]
        logdet = np.linalg.slogdet(np.cov(own.T, bias=True) + floors)[1]
        least = min(least, (logdet, tuple(own.mean(axis=0))))
    return least


def test_determinant_is_near_the_least(spark):
    draw = np.random.default_rng(11)
    clean = draw.multivariate_normal(np.zeros(5), np.eye(5) + 0.6, 1_500)
    odd = draw.normal([5, -5, 5, -5, 0], 0.2, (300, 5))
    rows = np.vstack([clean, odd])
    frame = spark.createDataFrame(
        [("g", *map(float, x)) for x in rows],
        "grouped string, x0 double, x1 double, x2 double, x3 double, x4 double",
    )
    logdet, mean = _plain_mcd(rows, 40)
    model = quality_mcd.estimates(frame).first()
    assert np.abs(np.array(model["mean"]) - mean).max() < 0.1
    inverse = np.array(model["inverse"]).reshape(5, 5)
    off = rows - np.array(model["mean"])
    far = np.einsum("ij,jk,ik->i", off, inverse, off)
    own = rows[np.argsort(far)[: int(np.ceil(quality_mcd.SHARE * len(rows)))]]
    floors = np.diag(np.square(quality_mcd.FLOORS))
    ours = np.linalg.slogdet(np.cov(own.T, bias=True) + floors)[1]
    assert ours < logdet + 0.1
    assert far[1_500:].min() > quality_mcd.CUTOFF


def test_small_tables_are_judged_too(frame):
    draw = random.Random(4)
    texts = [" ".join(f"word{draw.randrange(99)}" for _ in range(60)) for _ in range(40)]
    rows = [(i, text, "en", "s") for i, text in enumerate(texts)]
    rows.append((99, " ".join(f"#w{i}$%*" for i in range(60)), "en", "s"))
    found = {r.doc_id: r for r in quality_mcd.judged(frame(rows)).collect()}
    assert not found[99].base_failed and not found[99].kept and found[99].distance > quality_mcd.CUTOFF
    assert all(found[i].kept for i in range(40))
    (one,) = quality_mcd.judged(frame(rows[:1])).collect()
    assert one.kept
