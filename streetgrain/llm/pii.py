"""Personal data, also in disguise: texts are normalised with a map back to their own places."""

from __future__ import annotations

import re
from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame

from . import spans as sp

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", re.ASCII)
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)", re.ASCII)
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++", re.ASCII)
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]", re.ASCII)


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, in time linear in the text."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def _ips(text: str) -> list[tuple[int, int]]:
    def small(part: str) -> bool:
        part = part.lstrip("0")
        return len(part) < 3 or len(part) == 3 and part <= "255"

    return [m.span() for m in _IP.finditer(text) if all(map(small, m.groups()))]


def _luhn(digits: list[int]) -> bool:
    total = sum(digits[-1::-2]) + sum(d * 2 - 9 * (d > 4) for d in digits[-2::-2])
    return total % 10 == 0


def _cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = [ord(c) - 48 for c in m.group() if c not in " -"]
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append(m.span())
    return out


def _phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15]


FIND = (emails, _ips, _cards, _phones)

# Characters that look like ASCII ones. Each becomes one character, so places stay.
_TWINS = {
    "а": "a", "с": "c", "е": "e", "о": "o", "р": "p", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "К": "K", "М": "M", "О": "O", "Р": "P", "Т": "T", "Х": "X",
    "ο": "o", "ν": "v", "ρ": "p", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M",
    "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-",
    " ": " ", " ": " ", " ": " ",
}
# Full-width forms, and the digits of three scripts and of mathematics, follow from ranges.
TWINS = {ord(k): v for k, v in _TWINS.items()}
TWINS |= {0xFF01 + i: chr(0x21 + i) for i in range(94)}
TWINS |= {first + i: str(i) for first in (0x0660, 0x06F0, 0x0966) for i in range(10)}
TWINS |= {0x1D7CE + i: str(i % 10) for i in range(50)}
_TWIN = re.compile(f"[{''.join(re.escape(chr(c)) for c in sorted(TWINS))}]")

# Spelled digits.
DIGITS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9",
}
_NAME = "|".join(DIGITS)
# Seven digits or more, each a word or a figure; a number of words alone is no identifier.
_SPELLED = re.compile(rf"(?i:(?<![A-Za-z0-9])(?:plus )?(?:{_NAME})(?:[ -](?:{_NAME}|[0-9])){{6,}}(?![A-Za-z0-9]))")
_SPELLED_PART = re.compile(rf"(?i:plus |{_NAME}|[0-9]|[ -])")
_BRACKET = re.compile(r" ?[\[({<] ?(at|AT|At|dot|DOT|Dot) ?[\])}>] ?")
# Without brackets the words are ordinary speech, so the last label must be a known one (fixed values).
_TOP = "com|org|net|edu|gov|info|io|dev|app|ai|co|biz|eu|uk|us|de|fr|es|it|nl|ch|at|be|pl|se|ca|au|jp|in|br"
_BARE = re.compile(
    r"(?<=[A-Za-z0-9._%+-])( (?:at|AT) )(?=[A-Za-z0-9-]{1,63}(?:(?: (?:dot|DOT) |\.)[A-Za-z0-9-]{1,63})*"
    rf" (?:dot|DOT) (?i:{_TOP})(?![A-Za-z0-9-]))"
)
_BARE_DOT = re.compile(r" (?:dot|DOT) (?=[A-Za-z0-9-])")

# The loose form: each bare at, dot and spelled digit by itself, in any mix with the other forms.
_DOT = r"(?:\.| (?i:dot) | ?[\[({<] ?(?i:dot) ?[\])}>] ?)"
_LOOSE_AT = re.compile(
    r"(?<=[A-Za-z0-9._%+-]) (?i:at) "
    rf"(?=[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}})*{_DOT}(?i:{_TOP})(?![A-Za-z0-9-]))"
)
_LOOSE_DOT = re.compile(r"(?<=[A-Za-z0-9]) (?i:dot) (?=[A-Za-z0-9])")
_LOOSE_DIGITS = re.compile(rf"(?i:(?<![A-Za-z0-9])(?:plus )?(?:{_NAME})(?:[ -](?:{_NAME}|[0-9](?![A-Za-z0-9])))*(?![A-Za-z0-9]))")
# A spelled digit counts only beside another digit, as no identifier has one alone.
_GAP = rf"(?:[ ().-]+|{_DOT})"
_BESIDE = re.compile(rf"(?i:(?<![A-Za-z0-9])(?:{_NAME}){_GAP}(?:{_NAME}|[0-9])|[0-9]{_GAP}(?:{_NAME})(?![A-Za-z0-9]))")
_KNOWN = frozenset(_TOP.split("|"))


def edits(text: str) -> list[tuple[int, int, str]]:
    """Stretches of a text and what they stand for, in order and apart; the text has plain characters already."""
    out: list[tuple[int, int, str]] = []
    for m in _BRACKET.finditer(text):
        out.append((m.start(), m.end(), "@" if m[1].lower() == "at" else "."))
    if " dot " in text or " DOT " in text:
        for m in _BARE.finditer(text):
            out.append((m.start(), m.end(), "@"))
            # The dots of this address: up to the first white space that no dot follows.
            at = m.end()
            while True:
                while at < len(text) and (text[at].isascii() and text[at].isalnum() or text[at] in "-."):
                    at += 1
                dot = _BARE_DOT.match(text, at)
                if not dot:
                    break
                out.append((dot.start(), dot.end(), "."))
                at = dot.end()
    for m in _SPELLED.finditer(text):
        out += _digits(text, m)
    return _apart(out)


def loose_edits(text: str) -> list[tuple[int, int, str]]:
    """The same with every bare at, dot and spelled digit replaced; none if that can't add an identifier."""
    low = text.lower()
    spoken = any(name in low for name in DIGITS) and _BESIDE.search(text)
    if "dot" not in low and not spoken:
        return []
    dots = [(m.start(), m.end(), ".") for m in _LOOSE_DOT.finditer(text)]
    brackets = [(m.start(), m.end(), "@" if m[1].lower() == "at" else ".") for m in _BRACKET.finditer(text)]
    spelled = [x for m in _LOOSE_DIGITS.finditer(text) for x in _digits(text, m)] if spoken else []
    if not dots and not spelled and not any(new == "." for _, _, new in brackets):
        return []
    ats = [(m.start(), m.end(), "@") for m in _LOOSE_AT.finditer(text)]
    return _apart(dots + ats + spelled + brackets) if dots or ats or spelled else []


def _digits(text: str, run: re.Match) -> list[tuple[int, int, str]]:
    out = []
    for p in _SPELLED_PART.finditer(text, run.start(), run.end()):
        word = p[0].lower()
        if word not in " -" and not word.isdigit():
            out.append((p.start(), p.end(), "+" if word == "plus " else DIGITS[word]))
        elif word in " -":
            out.append((p.start(), p.end(), ""))
    return out


def _apart(out: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    out.sort()
    apart, done = [], 0
    for s, e, new in out:
        if s >= done:
            apart.append((s, e, new))
            done = e
    return apart


def _plain(text: str) -> str:
    return text.translate(TWINS) if _TWIN.search(text) else text


def normalise(text: str) -> tuple[str, np.ndarray, np.ndarray, np.ndarray] | None:
    """(plain text, start and end in ``text`` of each plain character, whether it was changed); None if nothing changes."""
    plain = _plain(text)
    changes = edits(plain)
    return _form(text, plain, changes) if plain is not text or changes else None


def _form(text: str, plain: str, changes: list[tuple[int, int, str]]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    parts, starts, ends, changed, at = [], [], [], [], 0
    for s, e, new in [*changes, (len(text), len(text), "")]:
        parts += [plain[at:s], new]
        keep = np.arange(at, s)
        starts += [keep, np.full(len(new), s)]
        ends += [keep + 1, np.full(len(new), e)]
        same = np.zeros(s - at, bool)
        if plain is not text:
            same = np.array([a != b for a, b in zip(plain[at:s], text[at:s], strict=True)], bool)
        changed += [same, np.ones(len(new), bool)]
        at = e
    return "".join(parts), np.concatenate(starts), np.concatenate(ends), np.concatenate(changed)


def _mapped(form: tuple, valid=None) -> list[tuple[int, int, int]]:
    """Kind and place in the text of what a form shows and its own characters don't."""
    plain, starts, ends, changed = form
    total = np.concatenate([[0], np.cumsum(changed)])
    out = []
    for k, f in enumerate(FIND):
        for s, e in f(plain):
            e = valid(s, e) if valid and k == 0 else e
            if e and total[e] > total[s]:
                out.append((k, int(starts[s]), int(ends[e - 1])))
    return out


def _loose(text: str) -> list[tuple[int, int, int]]:
    plain = _plain(text)
    changes = loose_edits(plain)
    if not changes:
        return []
    form = _form(text, plain, changes)
    spoken = {s for s, e, new in changes if new in ("@", ".") and plain[s:e].strip().lower() in ("at", "dot")}
    masked = {s for s, _, new in changes if new == "."}

    def valid(s: int, e: int) -> int:
        """End of an address, or 0. Bare words need a known last label, and a bare at needs a disguised dot too."""
        new, starts = form[0], form[1]
        at = new.index("@", s)
        if not any(int(starts[i]) in spoken for i in range(s, e) if new[i] in "@."):
            return e
        while True:
            last = new.rfind(".", at, e)
            if last < 0:
                return 0
            if new[last + 1 : e].lower() in _KNOWN:
                break
            e = last
        hidden = any(int(starts[i]) in masked for i in range(at, e) if new[i] == ".")
        return e if hidden or int(starts[at]) not in spoken else 0

    return _mapped(form, valid)


def identifiers(text: str) -> list[sp.Span]:
    """Base spans of a text, and those that only its normal forms show; of two that overlap the longer one."""
    base = [f(text) for f in FIND]
    out = [(s, k, e, True) for k, x in enumerate(base) for s, e in x]
    normal = normalise(text)
    loose = _loose(text)
    taken = [list(x) for x in base]
    more = (_mapped(normal) if normal else []) + loose
    if loose:
        more.sort(key=lambda x: (x[1] - x[2], x[1]))
    for k, low, high in more:
        before = bisect_left(taken[k], (high, 0)) - 1  # the last span that begins before the end
        if before < 0 or taken[k][before][1] <= low:
            if loose:
                insort(taken[k], (low, high))
            out.append((low, k, high, False))
    return [(KINDS[k], s, e, b) for s, k, e, b in sorted(out)]


def _find(texts: list[str], data: np.ndarray, offsets: np.ndarray) -> list[list[sp.Span]]:
    return [identifiers(t) for t in texts]


def find_personal_data(docs: DataFrame, text_col: str, column: str = "personal") -> DataFrame:
    """All columns of ``docs`` and the spans of e-mail addresses, IP addresses, card and phone numbers.

    Base spans are those of the text as it is. A second pass reads the text with
    look-alike characters, spelled digits and disguised "at" and "dot" replaced,
    and maps what it finds back to the text's own code points. A third one, where
    a text has bare words or single spelled digits, replaces each by itself; its
    addresses need a known last label. Both add spans that no base span of that
    kind touches. Null text is empty. Nothing is shuffled.
    """
    return sp.add_spans(docs, text_col, column, _find)
