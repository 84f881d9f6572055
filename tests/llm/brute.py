"""Plain Python versions that the operators are held against."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None, size: int) -> set:
    words = WORD.findall(lower(text or ""))
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def near_copies(rows: list[tuple], size: int, percent: int) -> dict:
    """doc_id -> (number of shingles, component) by comparing all pairs that share one."""
    sets = {doc: shingles(text, size) for doc, text in rows}
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders: dict = {}
    for doc, found in sets.items():
        for s in found:
            holders.setdefault(s, []).append(doc)
    shared: Counter = Counter()
    for docs in holders.values():
        docs = sorted(docs)
        for i, a in enumerate(docs):
            for b in docs[i + 1 :]:
                shared[a, b] += 1
    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {doc: (len(sets[doc]), root(doc)) for doc in sets}


def repeated_words(rows: list[tuple], size: int = 50) -> dict:
    """doc_id -> (set of words in runs that another document holds, those cut)."""
    holders: dict = {}
    words = {doc: WORD.findall(text or "") for doc, text in rows}
    for doc, found in words.items():
        for i in range(len(found) - size + 1):
            holders.setdefault(tuple(found[i : i + size]), set()).add(doc)
    out = {}
    for doc, found in words.items():
        repeated, cut = set(), set()
        for i in range(len(found) - size + 1):
            docs = holders[tuple(found[i : i + size])]
            if len(docs) > 1:
                repeated.update(range(i, i + size))
                if min(docs) != doc:
                    cut.update(range(i, i + size))
        if repeated:
            out[doc] = (repeated, cut)
    return out


KINDS = ["email", "ip", "card", "phone"]
EXPRESSIONS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple]:
    """(start, kind, end) of the base spans."""
    out = []
    for kind, expression in EXPRESSIONS.items():
        for match in expression.finditer(text or ""):
            digits = re.sub(r"[^0-9]", "", match.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in match.group().split(".")) if kind == "ip" else 0,
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((match.start(), KINDS.index(kind), match.end(), kind))
    return [(s, k, e) for s, _, e, k in sorted(out)]


def listed(spans: list[tuple]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
