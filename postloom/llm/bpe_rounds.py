"""Byte-level BPE by batched numpy merge rounds.

The symbols of many distinct words lie in one flat array. In each round the rank
of every neighbouring pair is found by binary search over the sorted pair keys of
the merges, the lowest rank of each word by a segmented minimum, and all pairs of
that rank are merged (of overlapping ones, every second from the left); words in
which nothing can be merged leave the array. That is the order of the sequential
algorithm, as a merge only makes pairs of later ranks. A very long word needs many
rounds; it is merged by itself, with the places of its pairs filed by rank, so that a
round costs what it merges and not what the word has left.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.tokens import Kept, KEPT_PARTS, PartEncoder, byte_letters, encoder, plain, ragged, text_runs

RUN_BYTES = 1 << 22
LONG = 4_096  # bytes of a word beyond which it is merged by itself
_NONE = np.int64(1) << 40


class ByteBpe(PartEncoder):
    """Encoder and decoder of a byte-level vocabulary file."""

    _WORDS = regex.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    )

    def __init__(self, path: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        vocabulary, merges = described["model"]["vocab"], described["model"]["merges"]
        added = {t["content"]: t["id"] for t in described["added_tokens"]}
        # Only for cutting texts with uncommon characters into words.
        self.cutter = Tokenizer.from_file(path).pre_tokenizer
        self.special = added
        self.split = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        letters = byte_letters()
        self.byte_of = {letter: byte for byte, letter in enumerate(letters)}
        self.first_ids = np.array([vocabulary[letter] for letter in letters], np.int64)
        self.size = max([*vocabulary.values(), *added.values()]) + 1

        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = keys[order], order
        self.rank_places = np.argsort(order)
        self.pair_merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)[order]

        spelled = [b""] * self.size
        for token, number in vocabulary.items():
            spelled[number] = bytes(self.byte_of[c] for c in token)
        for token, number in added.items():
            spelled[number] = token.encode()
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_lengths = np.array([len(s) for s in spelled], np.int64)
        self.spelled_starts = np.cumsum(self.spelled_lengths) - self.spelled_lengths
        self.words = Kept()

    def _cut(self, part: str) -> list[str]:
        """The words of a part; a special token is marked by a leading NUL."""
        if self.split is not None and "<" in part:
            pieces = self.split.split(part)
            if len(pieces) > 1:
                return [
                    w
                    for p in pieces
                    if p
                    for w in (["\0" + p] if p in self.special else self._cut(p))
                ]
        if part.isascii() and part[1:].isalpha() and (part[0] == " " or part[0].isalpha()):
            return [part]
        if plain(part):
            return self._WORDS.findall(part)
        byte_of = self.byte_of
        return [
            bytes([byte_of[c] for c in word]).decode()
            for word, _ in self.cutter.pre_tokenize_str(part)
        ]

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct parts in a row, and the number of each."""
        if len(self.words.places) > KEPT_PARTS:
            self.words.forget()
        cut = [self._cut(p) for p in parts]
        flat = [w for words in cut for w in words]
        fresh = [w for w in dict.fromkeys(flat) if w not in self.words.places]
        special = [w for w in fresh if w[0] == "\0" and w[1:] in self.special]
        if special:
            fresh = [w for w in fresh if w not in set(special)]
            ids = np.array([self.special[w[1:]] for w in special], np.uint32)
            self.words.add(special, ids, np.ones(len(special), np.int64))
        if fresh:
            self.words.add(fresh, *self.merged([w.encode() for w in fresh]))
        ids, lengths = self.words.gather(self.words.of(flat))
        upto = np.concatenate([[0], np.cumsum(lengths)])
        counts = np.concatenate([[0], np.cumsum([len(words) for words in cut])]).astype(np.int64)
        return ids, np.diff(upto[counts])

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in a row, and the number of each, by merge rounds."""
        if max(map(len, words)) <= LONG:
            return self._merged_together(words)
        short = [w for w in words if len(w) <= LONG]
        ids, counts = self._merged_together(short) if short else ([], [])
        parts = iter(np.split(np.asarray(ids, np.int64), np.cumsum(counts, dtype=np.int64)))
        each = [next(parts) if len(w) <= LONG else self._merged_alone(w) for w in words]
        return np.concatenate(each), np.array([len(e) for e in each], np.int64)

    def _merged_alone(self, word: bytes) -> np.ndarray:
        """Ids of one word, by rounds over the places that are filed under the lowest rank.

        A merged pair stays at the place of its left symbol; ``after`` and ``before`` name the
        neighbours that are left. A place may be filed under pairs that are gone since, so a
        round looks at the symbols again.
        """
        symbols = self.first_ids[np.frombuffer(word, np.uint8)]
        size = len(symbols)
        after, before = np.arange(1, size + 1), np.arange(-1, size - 1)
        filed: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def file(places: np.ndarray) -> None:
            keys = symbols[places] * self.size + symbols[after[places]]
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            known = self.pair_keys[at] == keys
            places, rank = places[known], self.pair_ranks[at[known]]
            order = np.argsort(rank, kind="stable")
            places, rank = places[order], rank[order]
            starts = np.flatnonzero(np.diff(rank, prepend=-1))
            for low, high in zip(starts, [*starts[1:], len(rank)]):
                lowest = int(rank[low])
                if lowest not in filed:
                    filed[lowest] = []
                    heapq.heappush(ranks, lowest)
                filed[lowest].append(places[low:high])

        file(np.arange(size - 1))
        while ranks:
            lowest = heapq.heappop(ranks)
            places = np.unique(np.concatenate(filed.pop(lowest)))
            at = self.rank_places[lowest]
            left, right = divmod(int(self.pair_keys[at]), self.size)
            places = places[(symbols[places] == left) & (after[places] < size)]
            places = places[symbols[after[places]] == right]
            if not len(places):
                continue
            if left == right:
                # In a run of overlapping pairs, as in "aaa", every second one is merged.
                nth = np.arange(len(places))
                linked = np.concatenate([[False], after[places[:-1]] == places[1:]])
                places = places[(nth - np.maximum.accumulate(np.where(linked, 0, nth))) % 2 == 0]
            gone = after[places]
            symbols[places], symbols[gone] = self.pair_merged[at], -1
            after[places] = after[gone]
            followed = places[after[places] < size]
            before[after[followed]] = followed
            led = before[places]
            file(np.unique(np.concatenate([followed, led[led >= 0]])))
        return symbols[symbols >= 0]

    def _merged_together(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number, of words that all take part in each round."""
        sizes = np.array([len(w) for w in words], np.int64)
        symbols = self.first_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            same = word[1:] == word[:-1]
            keys = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            rank = np.full(len(symbols), _NONE)
            rank[:-1] = np.where(same & (self.pair_keys[at] == keys), self.pair_ranks[at], _NONE)
            starts = np.flatnonzero(np.concatenate([[True], ~same]))
            lowest = np.minimum.reduceat(rank, starts)
            spans = np.diff(np.concatenate([starts, [len(symbols)]]))
            open_words = lowest < _NONE
            if not open_words.all():
                ended = np.repeat(~open_words, spans)
                done.append((word[ended], symbols[ended]))
                go = ~ended
                keep = np.flatnonzero(go)
                word, symbols, rank = word[keep], symbols[keep], rank[keep]
                at = np.concatenate([at, [0]])[keep]
                lowest, spans = lowest[open_words], spans[open_words]
                if not len(symbols):
                    break
            else:
                at = np.concatenate([at, [0]])
            hit = rank == np.repeat(lowest, spans)
            # In a run of overlapping pairs, as in "aaa", every second one is merged.
            places = np.arange(len(hit))
            before = np.maximum.accumulate(np.where(hit, -1, places))
            hit &= (places - before) % 2 == 1
            merging = np.flatnonzero(hit)
            symbols[merging] = self.pair_merged[at[merging]]
            stay = np.ones(len(symbols), bool)
            stay[merging + 1] = False
            word, symbols = word[stay], symbols[stay]
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        owner = np.concatenate([w for w, _ in done])
        order = np.argsort(owner, kind="stable")
        ids = np.concatenate([s for _, s in done])[order]
        return ids, np.bincount(owner, minlength=len(words))

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of texts in a row, and where each starts and the last ends."""
        lengths = self.spelled_lengths[ids]
        data = self.spelled[ragged(self.spelled_starts[ids], lengths)].tobytes()
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return data, upto[np.concatenate([[0], np.cumsum(counts)])]


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) and decoded text of every row.

    ``docs`` has doc_id and text; other columns are left alone. A null text counts
    as empty and has no ids; repeated rows get the same result each; an empty table
    gives no rows. Special tokens written out in a text get their own ids.
    """
    return _coded(docs, tokenizer, digests=False)


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of ids and of the decoded text, as of ``round_trip``."""
    return _coded(docs, tokenizer, digests=True)


def _coded(docs: DataFrame, tokenizer: str, digests: bool) -> DataFrame:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(ByteBpe, tokenizer)
        for batch in batches:
            for first, texts in text_runs(batch.column("text"), RUN_BYTES):
                ids, counts = bpe.encode(texts)
                data, bounds = bpe.decode(ids, counts)
                packed = ids.astype("<u4").tobytes()
                ends = np.concatenate([[0], np.cumsum(counts)]) * 4
                pairs = zip(ends[:-1], ends[1:], bounds[:-1], bounds[1:])
                spans = [(packed[a:b], data[c:d]) for a, b, c, d in pairs]
                doc_ids = batch.column("doc_id").slice(first, len(texts))
                if digests:
                    columns = [
                        doc_ids,
                        pa.array(counts),
                        pa.array([hashlib.sha256(a).hexdigest() for a, _ in spans], pa.string()),
                        pa.array([hashlib.sha256(b).hexdigest() for _, b in spans], pa.string()),
                    ]
                    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    columns = [
                        doc_ids,
                        pa.array([a for a, _ in spans], pa.binary()),
                        pa.array([b.decode("utf-8", "replace") for _, b in spans], pa.string()),
                    ]
                    names = ["doc_id", "ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, ids binary, decoded string"
    if digests:
        schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(code, schema)
