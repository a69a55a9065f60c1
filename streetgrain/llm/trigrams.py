"""Boolean trigram queries of regular expressions, and a trigram index over a batch of texts.

A query says which trigrams a text must have for the expression to match. It is
a set of alternatives, each a set of trigrams; ``None`` means any text may match.
Trigrams are of bytes with A-Z lower-cased, so a query never loses a match.
"""

from __future__ import annotations

import re
from itertools import product

import numpy as np

from . import words as w

MOST = 32  # strings, or alternatives, that are followed before a part counts as unknown

Query = frozenset | None


def _grams(text: bytes) -> frozenset[bytes]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _either(queries: list[Query]) -> Query:
    if any(q is None for q in queries):
        return None
    out = frozenset().union(*queries)
    # An alternative that asks for more than another adds nothing.
    out = frozenset(x for x in out if not any(y < x for y in out))
    return out if len(out) <= MOST else None


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    out = frozenset(x | y for x, y in product(a, b))
    return out if len(out) <= MOST else a


def _of_strings(strings: set[bytes]) -> Query:
    grams = [_grams(s) for s in strings]
    return None if not grams or not all(grams) else _either([frozenset([g]) for g in grams])


def _fold(code: int) -> bytes:
    return chr(code).encode("utf-8").translate(bytes(w.LOWER))


def _exact(op, arg) -> set[bytes] | None:
    """All strings that a single-character node can be, if few."""
    name = str(op)
    if name == "LITERAL":
        return {_fold(arg)}
    if name == "IN":
        out: set[bytes] = set()
        for kind, value in arg:
            if str(kind) == "LITERAL":
                out.add(_fold(value))
            elif str(kind) == "RANGE" and value[1] - value[0] < MOST:
                out.update(_fold(c) for c in range(value[0], value[1] + 1))
            else:
                return None
        return out if len(out) <= 4 else None
    return None


def _sequence(nodes) -> tuple[set[bytes] | None, Query]:
    """(all strings that the nodes can be, if few; what they ask for)."""
    run: set[bytes] = {b""}
    whole, query = True, None
    for op, arg in nodes:
        name = str(op)
        own, asked = _exact(op, arg), None
        if name == "SUBPATTERN":
            own, asked = _sequence(arg[3])
        elif name == "BRANCH":
            found = [_sequence(x) for x in arg[1]]
            own = None if any(s is None for s, _ in found) else set().union(*(s for s, _ in found))
            asked = _either([q if s is None else _of_strings(s) for s, q in found])
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, inner = arg
            text, deep = _sequence(inner)
            if least == 0:
                own = {b""} | text if text is not None and most == 1 else None
            else:
                own = text if text is not None and least == most == 1 else None
                asked = deep if text is None else _of_strings(text)
                if text is not None and own is None:
                    # The known first copies end the run of strings before them.
                    head = {x + y for x, y in product(run, text)} if len(run) * len(text) <= MOST else run
                    asked = _both(asked, _of_strings(head))
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            own = {b""}
        if own is not None and len(run) * len(own) <= MOST:
            run = {x + y for x, y in product(run, own)}
            continue
        whole = False
        query = _both(_both(query, _of_strings(run)), asked)
        if own is not None:
            query, run = _both(query, _of_strings(own)), own
        else:
            run = {b""}
    if whole:
        return run, None
    return None, _both(query, _of_strings(run))


def query_of(pattern: str) -> Query:
    """The trigram query of a regular expression; ``None`` where no trigram is mandatory."""
    strings, query = _sequence(re._parser.parse(pattern))
    return query if strings is None else _of_strings(strings)


class TrigramIndex:
    """Postings of chosen trigrams over a batch of texts: the texts that hold each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, wanted: set[bytes]) -> None:
        codes = sorted(int.from_bytes(g, "big") for g in wanted)
        self.rows = len(offsets) - 1
        self.postings: dict[int, np.ndarray] = {}
        if not codes or len(data) < 3:
            return
        number = np.zeros(1 << 24, np.int32)
        number[codes] = np.arange(1, len(codes) + 1)
        low = w.LOWER[data].astype(np.uint32)
        code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
        kind = number[code]
        at = np.flatnonzero(kind)
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at + 3 <= offsets[row + 1]
        pairs = np.unique(kind[at[inside]].astype(np.int64) * self.rows + row[inside])
        for k, code_ in enumerate(codes, 1):
            self.postings[code_] = pairs[np.searchsorted(pairs, k * self.rows) : np.searchsorted(pairs, (k + 1) * self.rows)] % self.rows

    def candidates(self, query: Query) -> np.ndarray:
        """Texts that satisfy the query, in order."""
        if query is None:
            return np.arange(self.rows)
        found = [np.zeros(0, np.int64)]
        for grams in query:
            lists = sorted((self.postings.get(int.from_bytes(g, "big"), np.zeros(0, np.int64)) for g in grams), key=len)
            rows = lists[0]
            for other in lists[1:]:
                rows = np.intersect1d(rows, other, assume_unique=True)
            found.append(rows)
        return np.unique(np.concatenate(found))
