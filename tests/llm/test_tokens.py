"""Both encoders against the library itself."""

from __future__ import annotations

import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from postloom.llm.bpe_rounds import ByteBpe, digests, round_trip
from postloom.llm.tokens import LibraryWords
from tests.llm import brute
from tests.llm.conftest import ODD

BYTES, WORDS = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))


def _odd_texts():
    draw = random.Random(9)
    texts = [
        "", " ", "  a  b ", "a\n b\n\n c \n", "x <|endoftext|> y", "x  <|endoftext|>  y<|endoftext|>",
        "a<|startoftext|>B", "ΣΑΣ İstanbul ŉ ﬁ é  x 　 y z", "don't I'LL we've 's",
        "aaaaaaaaaaaaaaaaaaaa", "a" * 5000, "1234567 ½ ² ٣ x1y2", "\x00a \x1c b\x1f \x85 \x7f",
        "😀😀 👨‍👩‍👧 中文 字 ﻿", "<| <|endoftext <|endoftext|", "tab\there \t x", " ​ ᠎ y",
    ]
    pool = "ab'sTd <|>\n\t 12é😀ß́ 　Σİ.,-" + "endoftext"
    texts += ["".join(draw.choice(pool) for _ in range(draw.randrange(60))) for _ in range(3000)]
    return texts


@pytest.mark.parametrize("kind,path", [(ByteBpe, BYTES), (LibraryWords, WORDS)])
def test_against_library(kind, path):
    texts = _odd_texts()
    texts += pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()
    ids, counts = kind(path).encode(pa.array(texts))
    ends = np.cumsum(counts)
    library = Tokenizer.from_file(path)
    for i, encoded in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        own = ids[ends[i] - counts[i] : ends[i]].tolist()
        assert own == encoded.ids, repr(texts[i][:200])


def test_very_long_words():
    draw = random.Random(31)
    letters = "etaoinshrdlu"
    texts = [
        "a" * 100_001,
        "ab" * 30_000 + " short " + "".join(draw.choice(letters) for _ in range(60_000)) + " end",
        "".join(draw.choice(letters) for _ in range(400_000)),
        "x " + "中文字" * 3_000 + " y",
        "=-" * 9_000 + "".join(draw.choice("0123456789") for _ in range(9_000)),
    ]
    began = time.monotonic()
    ids, counts = ByteBpe(BYTES).encode(pa.array(texts))
    assert time.monotonic() - began < 60
    ends = np.cumsum(counts)
    library = Tokenizer.from_file(BYTES)
    for i, text in enumerate(texts):
        own = ids[ends[i] - counts[i] : ends[i]].tolist()
        assert own == library.encode(text, add_special_tokens=False).ids


def test_digests(docs, frame):
    library = Tokenizer.from_file(BYTES)
    rows = {r.doc_id: r for r in digests(docs, BYTES).collect()}
    for doc in docs.collect():
        ids = library.encode(doc.text, add_special_tokens=False).ids
        row = rows[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == __import__("hashlib").sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == brute.sha(library.decode(ids, skip_special_tokens=False))


def test_odd_rows(frame):
    made = frame([*ODD, (9, "x <|endoftext|> y")], extra=True)
    found = round_trip(made, BYTES).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in found) == sorted(
        (str(r.doc_id), r.text or "") for r in made.collect()
    )
    assert round_trip(frame([]), BYTES).collect() == []


def test_words_of_letters_are_encoded_once():
    """A word was encoded and kept once for each case it came in, and then once more in lower."""
    texts = ["The THE the tHe", "x", "", None, "H̱ ẖ T̈ẗ <|ENDOFTEXT|> <|endoftext|> Élan éLAN"]
    words = LibraryWords(WORDS)
    ids, counts = words.encode(pa.array(texts[:3]))
    assert set(words.kept.places) == {"the", " ", "x"} and not set(words.words.places) & {"the", "x"}
    ids, counts = words.encode(pa.array(texts))
    ends = np.cumsum(counts)
    library = Tokenizer.from_file(WORDS)
    for i, text in enumerate(texts):
        assert ids[ends[i] - counts[i] : ends[i]].tolist() == library.encode(text or "", add_special_tokens=False).ids
