"""Token ids of whole texts, with each distinct part of a text encoded once.

Texts are cut at single spaces and where ASCII letters begin or end, into parts
that no token crosses (a word keeps the space before it where tokens do). A part is
compared as a string, not as a hash, and the ids of many texts are put together by
places in one flat array.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from postloom.llm.words import SPACES

# Encoded parts that a Python worker keeps; then it starts anew.
KEPT_PARTS = 200_000
# Bytes that kept words of the library may take, with about so many for each beside its text.
KEPT_BYTES, ENTRY_BYTES = 72 << 20, 180

# Bytes after a space at which a part may start. Left out are white space, bytes that
# may start other white space, and "<", since a special token ends what is before it.
_STARTS = np.ones(256, bool)
_STARTS[[*range(0x00, 0x21), ord("<"), *range(0x7F, 0xC3), 0xE1, 0xE2, 0xE3]] = False

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Other ASCII bytes at which a run of letters may begin or end. Apostrophes are part
# of tokens, and bars of special ones.
_OTHER = np.zeros(256, bool)
_OTHER[[b for b in range(0x80) if not _LETTER[b] and chr(b) not in "'|"]] = True

# Letters, digits and signs whose handling is alike in all Unicode versions.
_PLAIN = regex.compile("[\t\n\r\x20-\x7e¡-¬®-įı-ž]*")


def plain(part: str) -> bool:
    """Whether a part holds nothing but common characters."""
    return _PLAIN.fullmatch(part) is not None


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places start, start+1, ... of each stretch, one stretch after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, others for U+0100 and on in their order.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class Kept:
    """Ids by string, in one flat array."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        """Drop everything."""
        self.places: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.bytes = 0

    def add(self, names: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Keep the ids of new strings."""
        first = len(self.starts)
        self.bytes += sum(map(len, names)) + ENTRY_BYTES * len(names) + 4 * len(ids)
        self.places.update(zip(names, range(first, first + len(names))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])

    def of(self, names: list[str]) -> np.ndarray:
        """Number of each string."""
        return np.fromiter(map(self.places.__getitem__, names), np.int64, len(names))

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of numbered strings in a row, and how many each has."""
        lengths = self.lengths[numbers]
        return self.ids[ragged(self.starts[numbers], lengths)], lengths


class PartEncoder:
    """Encodes texts by parts; subclasses encode the distinct ones."""

    def __init__(self) -> None:
        self.kept = Kept()

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct parts in a row, and the number of each."""
        raise NotImplementedError

    def full(self, kept: Kept) -> bool:
        """Whether to start anew before more is kept."""
        return len(kept.places) > KEPT_PARTS

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Whether a part may start at each byte but the first."""
        before, after = data[:-1], data[1:]
        edge = _LETTER[before] & _OTHER[after]
        edge |= _OTHER[before] & ~SPACES[before] & _LETTER[after]
        edge[:-1] |= (data[1:-1] == 0x20) & _STARTS[data[2:]]
        return edge

    def folded(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The bytes with parts that have like ids made alike; offsets are those of parts."""
        return data

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of each; a null counts as empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        count = len(texts)
        if not count:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        buffers = texts.buffers()
        bounds = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + count + 1]
        size = int(bounds[-1] - bounds[0])
        data = np.frombuffer(buffers[2] or b"", np.uint8)[bounds[0] : bounds[0] + size]
        bounds = bounds - bounds[0]
        edge = np.zeros(size + 1, bool)
        if size > 1:
            edge[1:-1] = self.cuts(data)
        edge[bounds] = True
        offsets = np.flatnonzero(edge)
        data = self.folded(data, offsets)
        parts = pa.Array.from_buffers(
            pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        ).dictionary_encode()
        ids, lengths = self.kept.gather(self._numbers(parts))
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(upto[np.searchsorted(offsets, bounds)])

    def _numbers(self, parts: pa.DictionaryArray) -> np.ndarray:
        if not len(parts):
            return np.zeros(0, np.int64)
        names = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        if self.full(self.kept):
            self.kept.forget()
        fresh = [n for n in names if n not in self.kept.places]
        if fresh:
            self.kept.add(fresh, *self.encode_parts(fresh))
        return self.kept.of(names)[parts.indices.to_numpy()]


class LibraryWords(PartEncoder):
    """The ``tokenizers`` library with a vocabulary of lower-case words.

    A part of ASCII letters is a word, whatever its case. Other common parts are cut into
    words here, and each distinct word is given to the library's model; any other part
    goes through the whole library.
    """

    _WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size()
        self.letters = byte_letters()
        self.words = Kept()

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Whether a part may start at each byte but the first; spaces stay apart."""
        before, after = data[:-1], data[1:]
        edge = _LETTER[before] & _OTHER[after]
        edge |= _OTHER[before] & _LETTER[after]
        edge[:-1] |= (data[1:-1] == 0x20) & _STARTS[data[2:]] & ~_LETTER[data[2:]]
        return edge

    def folded(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The bytes with parts of ASCII letters alone in lower case.

        Other parts stay: special tokens have a case, and a letter's case decides which
        marks after it make one character with it.
        """
        others = np.concatenate([[0], np.cumsum(~_LETTER[data], dtype=np.int64)])
        lone = np.diff(others[offsets]) == 0
        return np.where(np.repeat(lone, np.diff(offsets)), _LOWER[data], data)

    def full(self, kept: Kept) -> bool:
        """Whether to start anew before more is kept: by bytes, so long parts count."""
        return kept.bytes > KEPT_BYTES

    def forget(self) -> None:
        """Drop all kept parts and words."""
        self.kept.forget()
        self.words.forget()

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct parts in a row, and the number of each."""
        lone = [p.isascii() and p.isalpha() for p in parts]
        tokenize = self.tokenizer.model.tokenize
        ids, lengths = self._flat(
            [[t.id for t in tokenize(p.lower())] for p, word in zip(parts, lone) if word]
        )
        rest, counts = self._encode_rest([p for p, word in zip(parts, lone) if not word])
        # Both lie behind one another; the parts' own order comes back by places.
        lengths = np.concatenate([lengths, counts])
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(np.argsort(~np.array(lone, bool), kind="stable"), kind="stable")
        lengths = lengths[order]
        return np.concatenate([ids, rest])[ragged(starts[order], lengths)], lengths

    @staticmethod
    def _flat(encoded: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Lists of ids in a row, and the number of each."""
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return np.fromiter(chain.from_iterable(encoded), np.uint32, int(lengths.sum())), lengths

    def _encode_rest(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct parts that are more than ASCII letters, and the number of each."""
        if self.full(self.words):
            self.words.forget()
        found = [
            self._WORDS.findall(p.lower()) if plain(p) and "<|" not in p else None for p in parts
        ]
        whole = [p for p, words in zip(parts, found) if words is None]
        # Parts that take the whole library are kept under a name no word can have.
        names = [["\0" + p] if words is None else words for p, words in zip(parts, found)]
        flat = list(chain.from_iterable(names))
        fresh = [n for n in dict.fromkeys(flat) if n not in self.words.places and n[0] != "\0"]
        model, letters = self.tokenizer.model, self.letters
        encoded = [
            [
                t.id
                for t in model.tokenize(
                    word
                    if word.isascii() and word.isalpha()
                    else "".join([letters[b] for b in word.encode()])
                )
            ]
            for word in fresh
        ]
        whole = [p for p in dict.fromkeys(whole) if "\0" + p not in self.words.places]
        encoded += [
            e.ids for e in self.tokenizer.encode_batch(whole, add_special_tokens=False)
        ]
        self.words.add(fresh + ["\0" + p for p in whole], *self._flat(encoded))
        ids, lengths = self.words.gather(self.words.of(flat))
        upto = np.concatenate([[0], np.cumsum(lengths)])
        counts = np.concatenate([[0], np.cumsum([len(words) for words in names], dtype=np.int64)])
        return ids, np.diff(upto[counts])


_workers: dict[tuple, PartEncoder] = {}


def encoder(kind: type[PartEncoder], path: str) -> PartEncoder:
    """The worker's encoder for a tokenizer file."""
    if (kind, path) not in _workers:
        _workers[kind, path] = kind(path)
    return _workers[kind, path]


def text_runs(column: pa.Array, most: int) -> Iterator[tuple[int, pa.Array]]:
    """A column in runs of about ``most`` bytes (one text at least): first row and texts."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    first = 0
    upto = np.concatenate([[0], np.cumsum(sizes)])
    while first < len(sizes):
        last = int(np.searchsorted(upto, upto[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(sizes))
        yield first, column.slice(first, last - first)
        first = last
