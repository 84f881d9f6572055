"""String kernel: kernel values by sets of n-grams, accuracy on held-out documents."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

from postloom.llm import string_kernel
from tests.llm.conftest import ODD


def _grams(text):
    spaced, out = "", set()
    for i, c in enumerate(text.lower()):
        if c.isalpha():
            spaced += c
        elif i == 0 or spaced[-1:] != " ":
            spaced += " "
    for n in string_kernel.ORDERS:
        out |= {spaced[i : i + n] for i in range(len(spaced) - n + 1)}
    return out


def test_kernel_is_that_of_n_gram_sets():
    texts = ["Hello, wörld!", "hello 12 World and more", "niño  año", "42", "a"]
    parts = list(string_kernel.presences(pa.array([*texts, None])))
    present = np.concatenate([p for p, _ in parts])
    sets = [_grams(t) for t in texts]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            # Places are hashed, so few may fall together.
            assert abs(int((present[i] & present[j]).sum()) - len(a & b)) <= 1
    assert np.concatenate([x for _, x in parts]).tolist() == [True, True, True, False, True, False]


def test_held_out_accuracy(docs):
    truth = {r.doc_id: r for r in docs.collect()}
    found = string_kernel.languages(docs).collect()
    assert len(found) == len(truth)
    right = total = 0
    for r in found:
        held_out = zlib.crc32(str(r.doc_id).encode()) % 4 == 2
        assert r.held_out == held_out and 0 <= r.score <= 1
        if held_out:
            total += 1
            right += r.lang_pred == truth[r.doc_id].lang
    assert total > 100 and right / total > 0.97


def test_odd_rows(frame):
    rows = [(20 + i, "the cat and the dog of the house " * 3, "en") for i in range(20)]
    rows += [(60 + i, "der hund und die katze des hauses " * 3, "de") for i in range(20)]
    rows += [(doc, text, None) for doc, text in ODD]
    rows += [(9, "12 34 -- !!", "en"), (10, "und die katze " * 100_000, None)]
    found = {r.doc_id: r for r in string_kernel.languages(frame(rows, extra=True)).collect()}
    assert [found[d].lang_pred for d in (1, 2, 3, 9, 10)] == ["und"] * 4 + ["de"]
    assert found[1].score == 0 and found[21].lang_pred == "en" and not found[None].held_out
    unlabelled = string_kernel.languages(frame(ODD)).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"} and len(unlabelled) == len(ODD)
    assert string_kernel.languages(frame([])).collect() == []


def test_regression_is_that_of_a_plain_solve():
    """With all texts as landmarks the map is exact, and so is the regression."""
    draw = np.random.default_rng(8)
    letters = {"a": list("abcdefghij"), "b": list("fghijklmno"), "c": list("klmnoabcpq")}
    texts, labels = [], []
    for name, count in (("a", 20), ("b", 12), ("c", 7)):
        for _ in range(count):
            texts.append(" ".join("".join(draw.choice(letters[name], 5)) for _ in range(12)))
            labels.append(name)
    present = np.concatenate([p for p, _ in string_kernel.presences(pa.array(texts))])
    model = string_kernel.fit(np.packbits(present, axis=1), labels)
    held = present.astype(float)
    size = np.sqrt(held.sum(axis=1))
    kernel = held @ held.T / (size[:, None] * size[None, :])
    counts = np.array([labels.count(name) for name in labels])
    targets = np.where(np.array(labels)[:, None] == np.array(model.languages)[None, :], 1.0, -1.0)
    # Each text weighs 1 / counts, so its own ridge is the common one times counts.
    ridge = string_kernel.RIDGE / 3 / 100
    plain = kernel @ np.linalg.solve(kernel + ridge * np.diag(counts), targets)
    assert np.abs(model.scores(present) - plain).max() < 1e-3


def test_what_is_learned_is_bounded_for_any_number_of_languages(frame, monkeypatch):
    monkeypatch.setattr(string_kernel, "ALL_LEARNED", 24)
    monkeypatch.setattr(string_kernel, "ALL_LANDMARKS", 8)
    rows, doc = [], 0
    for lang in range(12):
        letter = chr(ord("a") + lang)
        for _ in range(20 + lang):
            rows.append((doc, f"{letter * 3} {letter * 5} {letter}{letter}x", f"l{lang:02}"))
            doc += 1
    held = sum(1 for d, _, lang in rows if zlib.crc32(str(d).encode()) % 4 != 2 and lang == "l11")
    assert held > 3
    docs = frame(rows)
    model = string_kernel.learn(docs)
    assert len(model.languages) == 8 and "l11" in model.languages
    assert len(model.norms) <= 8 and model.weights.shape[1] == 8
    monkeypatch.setattr(string_kernel, "ALL_LANDMARKS", 30)
    model = string_kernel.learn(docs)
    assert len(model.languages) == 12 and len(model.norms) == 24
    found = string_kernel.languages(docs).collect()
    truth = {d: lang for d, _, lang in rows}
    assert all(r.lang_pred == truth[r.doc_id] for r in found)
