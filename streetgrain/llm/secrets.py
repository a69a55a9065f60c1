"""Secret scan: a trigram index over each batch of texts picks the texts that a rule is run on."""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from . import spans as sp
from .trigrams import TrigramIndex, query_of


class Rule(NamedTuple):
    """Leftmost non-overlapping matches; those whose group is shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


# The base rules. Maximal runs of hex digits are the matches of the plain class.
BASE = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{16,}", 0, 16, True),
)
# Published token formats.
MORE = (
    Rule("github", r"\bgh[pousr]_[A-Za-z0-9]{36,255}\b"),
    Rule("slack", r"\bxox[abeoprs]-[A-Za-z0-9-]{10,250}"),
    Rule("google", r"\bAIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN (?:[A-Z]{2,9} )?PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END (?:[A-Z]{2,9} )?PRIVATE KEY-----)?"),
)
RULES = BASE + MORE


def finder(rules: tuple[Rule, ...] = RULES) -> sp.Finder:
    compiled = [re.compile(r.pattern, re.ASCII) for r in rules]
    queries = [query_of(r.pattern) for r in rules]
    wanted = {g for q in queries if q is not None for grams in q for g in grams}

    def find(texts: list[str], data: np.ndarray, offsets: np.ndarray) -> list[list[sp.Span]]:
        index = TrigramIndex(data, offsets, wanted)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, (rule, pattern, query) in enumerate(zip(rules, compiled, queries, strict=True)):
            # A rule without mandatory trigrams has every text as a candidate.
            for i in index.candidates(query).tolist():
                for m in pattern.finditer(texts[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[i].append((m.start(), k, m.end()))
        return [[(rules[k].kind, s, e, rules[k].base) for s, k, e in sorted(x)] for x in found]

    return find


def find_secrets(docs: DataFrame, text_col: str, column: str = "secrets", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns of ``docs`` and the spans of secrets, base rules first where two start together.

    Each rule's expression yields a Boolean trigram query; the index of a batch
    intersects its postings, and only those whole texts are matched. Null text is
    empty. Nothing is shuffled.
    """
    return sp.add_spans(docs, text_col, column, finder(rules))
