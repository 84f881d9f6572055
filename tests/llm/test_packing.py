"""Packing: every id in one piece, sequences full, neighbours on the curve."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from postloom.llm.curve_packing import hilbert, pack
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")


def _check(made):
    library = Tokenizer.from_file(PATH)
    texts = [(r.doc_id, r.text or "") for r in made.select("doc_id", "text").collect()]
    pieces = pack(made, PATH).collect()
    by_doc: dict = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    encoded = library.encode_batch([t for _, t in texts], add_special_tokens=False)
    wanted: dict = {}
    for (doc, _), e in zip(texts, encoded):
        wanted.setdefault(doc, []).append(e.ids + [1])
    assert set(by_doc) == set(wanted)
    for doc, own in by_doc.items():
        assert sum(p.length for p in own) == sum(map(len, wanted[doc]))
        for p in own:
            ids = np.array(wanted[doc][0][p.start : p.start + p.length], "<u4").tobytes()
            assert p.ids == ids and p.ids_crc32 == zlib.crc32(ids)
            assert p.doc_tokens == len(wanted[doc][0])
    sequences: dict = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for number, own in sequences.items():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at == 2048 or number == len(sequences) - 1
    return pieces


def test_whole_table(docs):
    _check(docs)


def test_odd_rows(frame):
    long = "lorem ipsum " * 60_000
    rows = [*ODD, (8, long), (9, "x <|endoftext|> y")]
    pieces = _check(frame(rows, extra=True))
    assert len([p for p in pieces if p.doc_id == 8]) >= 100_000 // 2048
    assert pack(frame([]), PATH).collect() == []


def test_curve_visits_each_cell_next_to_the_last():
    for dimensions, bits in ((2, 5), (3, 3), (4, 2)):
        axes = np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij")
        cells = np.stack(axes, -1).reshape(-1, dimensions)
        keys = hilbert(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_alike_documents_are_neighbours(frame):
    rows = []
    for i in range(300):
        words = [f"topic{i % 3}word{j}" for j in range(i % 7, i % 7 + 60)]
        rows.append((i, " ".join(words)))
    pieces = sorted(pack(frame(rows), PATH).collect(), key=lambda p: (p.sequence_id, p.offset))
    topics = [p.doc_id % 3 for p in pieces]
    assert sum(a != b for a, b in zip(topics, topics[1:])) < 60
