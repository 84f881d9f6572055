"""Personal data: base spans against plain expressions, and discovered ones."""

from __future__ import annotations

from postloom.llm.bootstrapped_pii import masked, personal_data
from tests.llm import brute
from tests.llm.conftest import ODD

TRICKY = [
    "a@b.c-d_e@f.g x@y z@w..v p.q@r.s.t.",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.255 1.2.3",
    "4539 1488-0343 6467 4539148803436467 4539148803436468 12 345",
    "+1 (988) 555-2485 +12345678 +1 2 3 4 5 6 7 8 9 +1-(2 +441234567890123456",
    "é😀 é@b.cd 😀+49 30 901820 ünd 10.0.0.1",
    "@@ a@@b.c @x.y a@b.c@d.e +1+1 555 1234 5",
    "0" * 3000 + " " + "a" * 20000 + " " + "1-" * 5000 + "@" + "x@y.z",
]


def _expected(text):
    return brute.base_spans(text)


def _check(found, rows):
    by_id = {doc: text for doc, text, *_ in rows}
    for r in found:
        base = _expected(by_id[r.doc_id])
        assert r.base_sha256 == brute.sha(brute.listed(base)), by_id[r.doc_id]
        counts = [sum(k == kind for _, k, _ in base) for kind in brute.KINDS]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        assert {f"{k}:{s}:{e}" for s, k, e in base} <= set(r.spans.split(",")) | {""}


def test_whole_table(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = personal_data(docs).collect()
    assert len(found) == len(rows)
    _check(found, rows)


def test_tricky_texts(frame):
    rows = [(i, text) for i, text in enumerate(TRICKY)]
    _check(personal_data(frame(rows)).collect(), rows)


def test_patterns_discover_other_numbers(frame):
    rows = [(i, f"w{i} please call me +1 (555) 010-{1000 + i} or write soon v{i}") for i in range(30)]
    rows += [(100, "do call me 555 010 7777 or write"), (101, "room 555 010 7777 is free")]
    rows += [(200 + i, f"k{i} part number 10{i:05d}99 of stock") for i in range(30)]
    spans = {r.doc_id: r.spans for r in personal_data(frame(rows)).collect()}
    assert spans[100] == "phone:11:23"
    assert spans[101] == "" and not any(spans[200 + i] for i in range(30))


def test_odd_rows(frame):
    made = frame(ODD, extra=True)
    found = personal_data(made).collect()
    assert len(found) == len(ODD)
    _check([r for r in found if r.doc_id], [r for r in ODD if r[0]])
    assert personal_data(frame([])).collect() == []
    clear = masked(made)
    assert clear.columns == made.columns
    texts = {r.doc_id: r.text for r in clear.collect()}
    assert texts[5] == "Über 😀 [email] c" and texts[1] is None and texts[2] == ""


def test_masked(frame):
    rows = [(1, "a@b.cc 10.0.0.1 and +1 (988) 555-2485x"), (1, "a@b.cc 10.0.0.1 and +1 (988) 555-2485x")]
    found = masked(frame(rows)).collect()
    assert [r.text for r in found] == ["[email] [ip] and [phone]x"] * 2
    assert found[0].n_chars == len(found[0].text)
