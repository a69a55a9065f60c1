"""Byte-level BPE: longest matches are proposed, adjacent pairs verified, only failing words merged."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructType

from . import words as w

STRETCH = 1 << 20  # bytes of text encoded at a time
MOST_IDS = 1 << 20  # ids decoded at a time
TOGETHER = 64  # failing words up to so many bytes are merged as rows of a table, longer ones with a queue
ROWS = 1 << 14
LEAST = 8  # so few remaining words are followed one by one
LETTER, NUMBER, OTHER, SPACE, ADDED = range(5)
# Marks a place where a text can be cut without changing its pieces: a blank after a visible ASCII character.
_CUT = re.compile(rb"[!-~] ")


class Vocabulary(NamedTuple):
    """Tables of a byte-level BPE vocabulary. Its size bounds all of them."""

    names: list[bytes | None]  # bytes of each id
    single: np.ndarray  # id of each byte
    parts: np.ndarray  # (left, right) of each id; -1 where it is no merge
    rank: np.ndarray  # place of its merge, -1 where it is none
    pairs: np.ndarray  # left << 32 | right of all merges, sorted
    pair_rank: np.ndarray
    made: np.ndarray  # id that each merge gives, by rank
    edges: np.ndarray  # node << 8 | byte of the trie over all ids that a merge run can reach, sorted
    child: np.ndarray
    ends: np.ndarray  # id that ends in a node, -1 for none
    classes: np.ndarray  # class of each code point
    added: dict[bytes, int]


def _byte_names() -> dict[str, int]:
    """Byte-level alphabet: visible Latin-1 characters stand for themselves, the other bytes for U+0100 onwards."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def _classes(pre) -> np.ndarray:
    """Class of every code point, asked of the library's own pre-tokenizer, since Unicode versions differ."""

    def kind(c: str) -> int:
        for k, mate in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            if len(pre.pre_tokenize_str(mate + c)) == 1:
                return k
        return SPACE

    out = np.full(0x110000, OTHER, np.uint8)
    out[:0x80] = [kind(chr(c)) for c in range(0x80)]
    # In the text of all other code points each piece is of one class.
    rest = [*range(0x80, 0xD800), *range(0xE000, 0x110000)]
    text = "".join(map(chr, rest))
    for _, (start, end) in pre.pre_tokenize_str(text):
        out[rest[start] : rest[end - 1] + 1] = kind(text[start])
    out[0xD800:0xE000] = OTHER
    return out


def _trie(tokens: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    nodes: dict[int, int] = {}
    ends = [-1]
    for name, i in tokens.items():
        node = 0
        for byte in name:
            key = node << 8 | byte
            node = nodes.get(key, 0)
            if not node:
                node = nodes[key] = len(ends)
                ends.append(-1)
        ends[node] = i
    edges = np.array(sorted(nodes), np.int64)
    return edges, np.array([nodes[e] for e in edges.tolist()], np.int64), np.array(ends, np.int64)


@lru_cache(4)
def load_vocabulary(path: str) -> Vocabulary:
    """Reads a ``tokenizer.json`` of the byte-level BPE kind; other kinds are a ValueError."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(
        model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")
    )
    plain &= spec["normalizer"] is None and pre.get("type") == "ByteLevel" and not pre["add_prefix_space"] and pre.get("use_regex", True)
    plain &= (spec["decoder"] or {}).get("type") == "ByteLevel"
    plain &= not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if not plain:
        raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
    alphabet = _byte_names()
    ids = {bytes(alphabet[c] for c in name): i for name, i in model["vocab"].items()}
    added = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
    size = max([*ids.values(), *added.values()]) + 1
    names: list[bytes | None] = [None] * size
    for table in (ids, added):
        for name, i in table.items():
            names[i] = name
    missing = [b for b in range(256) if bytes([b]) not in ids]
    if missing:
        raise ValueError(f"bytes without a token: {missing[:5]}")
    single = np.array([ids[bytes([b])] for b in range(256)], np.int64)
    parts, rank = np.full((size, 2), -1, np.int64), np.full(size, -1, np.int64)
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    both = np.array([[ids[bytes(alphabet[c] for c in x)] for x in m] for m in merges], np.int64).reshape(-1, 2)
    for k, (a, b) in enumerate(both.tolist()):
        whole = ids[names[a] + names[b]]
        if rank[whole] >= 0 or len(names[whole]) == 1:
            raise ValueError(f"token {whole} has two merges")
        if max(rank[a], rank[b]) >= 0 and k <= max(rank[a], rank[b]):
            raise ValueError(f"merge {k} comes before its parts")
        parts[whole], rank[whole] = (a, b), k
    keys = both[:, 0] << 32 | both[:, 1]
    order = np.argsort(keys)
    made = np.argsort(np.where(rank < 0, size, rank), kind="stable")[: len(both)]
    empty = np.zeros(0, np.int64)
    vocabulary = Vocabulary(names, single, parts, rank, keys[order], order, made, empty, empty, empty, _classes(Tokenizer.from_file(path).pre_tokenizer), added)
    # A token is proposed only if merging its own bytes ends in it.
    sound = rank < 0
    fits = compatible(vocabulary, parts[made, 0], parts[made, 1], whole=rank[made])
    for i, fit in zip(made.tolist(), fits.tolist(), strict=True):
        sound[i] = fit and sound[parts[i, 0]] and sound[parts[i, 1]]
    tokens = {name: i for name, i in ids.items() if sound[i] and (rank[i] >= 0 or len(name) == 1)}
    edges, child, ends = _trie(tokens)
    return vocabulary._replace(edges=edges, child=child, ends=ends)


def _rank_of(v: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Place of the merge of each pair; beyond all merges where there is none."""
    never = len(v.pairs)
    if not never:
        return np.zeros(len(left), np.int64)
    key = left << 32 | right
    at = np.minimum(np.searchsorted(v.pairs, key), never - 1)
    return np.where(v.pairs[at] == key, v.pair_rank[at], never)


def compatible(v: Vocabulary, left: np.ndarray, right: np.ndarray, whole: np.ndarray | None = None) -> np.ndarray:
    """Whether merging the bytes of both tokens of each pair gives that pair.

    Merges run by rank, equal ones from the left, so the two sides grow as if alone
    until the first merge across the border. That merge needs the last symbol of the
    left side and the first of the right at a time when both exist: from their own
    merge to that of the larger symbol around them. The walk undoes, from the end,
    the later of the two merges, and tests each pair of symbols that ever met.
    ``whole`` is the rank of the merge of the pair itself, which doesn't count.
    """
    n, never = len(left), len(v.pairs)
    good = np.ones(n, bool)
    live = np.arange(n)
    x, y = left.copy(), right.copy()
    until_x = np.full(n, never if whole is None else 0, np.int64)
    if whole is not None:
        until_x[:] = whole
    until_y = until_x.copy()
    while len(live):
        merge = _rank_of(v, x, y)
        # At equal rank the merge further left comes first.
        crosses = (merge < until_x) & (merge <= until_y) & (merge < never)
        if whole is not None:
            crosses &= merge < whole[live]
        good[live[crosses]] = False
        rank_x, rank_y = v.rank[x], v.rank[y]
        undo_x = rank_x > rank_y
        until_x = np.where(undo_x, rank_x, until_x)
        until_y = np.where(undo_x, until_y, rank_y)
        go = ~crosses & (np.maximum(rank_x, rank_y) >= 0)
        x, y = np.where(undo_x, v.parts[x, 1], x)[go], np.where(undo_x, y, v.parts[y, 0])[go]
        until_x, until_y, live = until_x[go], until_y[go], live[go]
    return good


def longest(v: Vocabulary, data: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longest token from each byte on, within its ``room``: (id, length)."""
    token, length = v.single[data], np.ones(len(data), np.int64)
    at, node = np.arange(len(data)), np.zeros(len(data), np.int64)
    depth = 0
    while len(at):
        key = node << 8 | data[at + depth]
        place = np.minimum(np.searchsorted(v.edges, key), len(v.edges) - 1)
        found = v.edges[place] == key
        at, node = at[found], v.child[place[found]]
        depth += 1
        end = v.ends[node]
        whole = end >= 0
        token[at[whole]], length[at[whole]] = end[whole], depth
        more = room[at] > depth
        at, node = at[more], node[more]
    return token, length


def merged_together(v: Vocabulary, words: list[bytes]) -> list[list[int]]:
    """``merged`` for many words, none empty, as rows of one table: each round does the first merge of every row."""
    never, n = len(v.pairs), len(words)
    size = np.array([len(x) for x in words], np.int64)
    width = int(size.max(initial=1))
    ids = np.full((n, width + 1), -1, np.int64)
    ids[np.arange(width + 1) < size[:, None]] = v.single[np.frombuffer(b"".join(words), np.uint8)]
    rank = np.full((n, width), never, np.int64)
    some = ids[:, 1:] >= 0
    rank[some] = _rank_of(v, ids[:, :-1][some], ids[:, 1:][some])
    after = np.tile(np.arange(1, width + 2), (n, 1))
    before = np.tile(np.arange(-1, width), (n, 1))
    live = np.arange(n)
    while len(live):
        at = rank[live].argmin(1)
        least = rank[live, at]
        go = least < never
        live, at, least = live[go], at[go], least[go]
        if not len(live):
            break
        gone = after[live, at]
        last = after[live, gone]
        new = v.made[least]
        ids[live, at], ids[live, gone], after[live, at] = new, -1, last
        rank[live, gone % width] = never  # the last symbol has no rank; place 0 is never gone
        more = last <= width
        before[live[more], np.minimum(last, width)[more]] = at[more]
        right = ids[live, np.minimum(last, width)]
        rank[live, at] = np.where(right >= 0, _rank_of(v, new, right), never)
        first = before[live, at]
        inner = first >= 0
        rank[live[inner], first[inner]] = _rank_of(v, ids[live[inner], first[inner]], new[inner])
    return [[i for i in row if i >= 0] for row in ids.tolist()]


def merged(word: bytes, ranks: dict[tuple[int, int], tuple[int, int]], single: list[int]) -> list[int]:
    """The ids of one word by merging its bytes: the least rank first, equal ones from the left."""
    ids = [single[b] for b in word]
    n = len(ids)
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    queue = [(*ranks[p], i, p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in ranks]
    queue = [(r, i, new, p) for r, new, i, p in queue]
    heapq.heapify(queue)
    while queue:
        _, i, new, pair = heapq.heappop(queue)
        j = after[i]
        if j < 0 or (ids[i], ids[j]) != pair:
            continue
        ids[i], ids[j] = new, -1
        k = after[i] = after[j]
        after[j] = -1
        if k >= 0:
            before[k] = i
        for a, b in ((before[i], i), (i, k)):
            if a >= 0 and b >= 0 and (ids[a], ids[b]) in ranks:
                rank, made = ranks[ids[a], ids[b]]
                heapq.heappush(queue, (rank, a, made, (ids[a], ids[b])))
    return [i for i in ids if i >= 0]


class Encoder:
    """Encodes texts with the tables of a vocabulary."""

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self.single = v.single.tolist()
        self.ranks = {(a, b): (r, i) for i, ((a, b), r) in enumerate(zip(v.parts.tolist(), v.rank.tolist(), strict=True)) if r >= 0}
        self.added = re.compile(b"|".join(re.escape(t) for t in sorted(v.added, key=len, reverse=True))) if v.added else None

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> w.Words:
        """Words of the texts as the GPT-2 pattern cuts them; an added token is one word."""
        v = self.v
        raw = data.tobytes()
        if len(data) == 0:
            none = np.zeros(0, np.int64)
            return w.Words(data, none, none, np.zeros(len(offsets), np.int64))
        starts = np.flatnonzero((data & 0xC0) != 0x80)
        code = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        kind = v.classes[code]
        edge = np.zeros(len(code) + 3, bool)
        inner = offsets[offsets < len(data)]
        edge[np.searchsorted(starts, inner)] = True
        if self.added and self.added.search(raw):
            for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                for m in self.added.finditer(raw, low, high):
                    a, b = np.searchsorted(starts, m.span())
                    edge[a] = edge[b] = True
                    kind[a:b] = ADDED
        edge[len(code) :] = False
        begins = edge[: len(code)].copy()
        begins[1:] |= kind[1:] != kind[:-1]
        # The last white space before other text stands apart from its run; a blank there belongs to that text.
        after = np.flatnonzero(begins & (kind != SPACE) & ~edge[: len(code)])
        after = after[kind[after - 1] == SPACE]
        begins[after - 1] = True
        begins[after[code[after - 1] == 32]] = False
        # Endings after an apostrophe that starts a word.
        ends = np.concatenate([code, np.zeros(3, np.uint32)])
        tick = np.flatnonzero(begins & (code == 39) & (kind == OTHER))
        tick = tick[~edge[tick + 1]]
        first, second = ends[tick + 1], ends[tick + 2]
        short = np.isin(first, [ord(c) for c in "stmd"])
        long = ~edge[tick + 2] & np.isin(first << 8 | second, [ord(a) << 8 | ord(b) for a, b in ("re", "ve", "ll")])
        begins[tick[short | long] + 1] = False
        for at in (tick[short] + 2, tick[long] + 3):
            begins[at[at < len(code)]] = True
        at = starts[begins]
        return w.Words(data, at, np.append(at[1:], len(data)), np.searchsorted(at, offsets))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text."""
        words = self.pieces(data, offsets)
        if not len(words.starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        place, number = _distinct(words)
        flat, first = self._distinct_ids(data, words.starts[place], words.ends[place])
        count = np.diff(first)[number]
        lead = np.cumsum(count) - count
        ids = flat[np.arange(int(count.sum())) - np.repeat(lead - first[:-1][number], count)]
        return ids.astype(np.int32), w.per_row(count, words.first)

    def _distinct_ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, and where those of each begin."""
        size = ends - starts
        first = np.concatenate([[0], np.cumsum(size)])
        own = data[np.arange(first[-1]) - np.repeat(first[:-1] - starts, size)]
        token, length = longest(self.v, own, np.repeat(first[1:], size) - np.arange(first[-1]))
        at, row = _follow(np.arange(first[-1]) + length, first)
        ids = token[at]
        inside = np.flatnonzero(row[1:] == row[:-1])
        pair, where = np.unique(ids[inside] << 32 | ids[inside + 1], return_inverse=True)
        wrong = ~compatible(self.v, pair >> 32, pair & 0xFFFFFFFF)[where]
        failing = np.zeros(len(size), bool)
        failing[row[inside[wrong]]] = True
        raw = own.tobytes()
        if self.added and self.added.search(raw):
            for i in range(len(size)):
                failing[i] |= raw[first[i] : first[i + 1]] in self.v.added
        keep = ~failing[row]
        count = np.bincount(row[keep], minlength=len(size))
        exact = self._exact({i: raw[first[i] : first[i + 1]] for i in np.flatnonzero(failing).tolist()})
        count[list(exact)] = [len(x) for x in exact.values()]
        begin = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(begin[-1], np.int64)
        sure = np.ones(begin[-1], bool)
        for i, x in exact.items():
            out[begin[i] : begin[i + 1]] = x
            sure[begin[i] : begin[i + 1]] = False
        out[sure] = ids[keep]
        return out, begin

    def _exact(self, failing: dict[int, bytes]) -> dict[int, list[int]]:
        out = {i: [self.v.added[x]] for i, x in failing.items() if x in self.v.added}
        out |= {i: merged(x, self.ranks, self.single) for i, x in failing.items() if i not in out and len(x) > TOGETHER}
        rest = sorted((i for i in failing if i not in out), key=lambda i: len(failing[i]))
        for k in range(0, len(rest), ROWS):  # words of like length
            part = rest[k : k + ROWS]
            out |= zip(part, merged_together(self.v, [failing[i] for i in part]), strict=True)
        return out


def _follow(to: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places reached from the start of each word, in order, and the word of each."""
    at, row = first[:-1], np.arange(len(first) - 1)
    found = [(at, row)]
    while len(at) > LEAST:
        at = to[at]
        inside = at < first[row + 1]
        at, row = at[inside], row[inside]
        found.append((at, row))
    for p, r in zip(at.tolist(), row.tolist(), strict=True):  # the few longest, one by one
        end, chain = int(first[r + 1]), []
        p = int(to[p])
        while p < end:
            chain.append(p)
            p = int(to[p])
        found.append((np.array(chain, np.int64), np.full(len(chain), r)))
    places, rows = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(places)
    return places[order], rows[order]


def _distinct(words: w.Words) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct word, and each word's number among them. Equal hashes are confirmed on the bytes."""
    data, size = words.data, words.ends - words.starts
    for seed in w.ODD:
        _, place, number = np.unique(w.hashes(words, seed), return_index=True, return_inverse=True)
        # The words cover the text without gaps, so byte p of the text is compared with the same byte of its word's place.
        shift = np.repeat(words.starts[place][number] - words.starts, size)
        if (size[place][number] == size).all() and (data[np.arange(len(data)) + shift] == data).all():
            return place, number
    raise AssertionError("three hashes of different words agree")


def _stretches(data: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first byte, end, cuts) of parts of about ``limit`` bytes; long texts are cut before a blank."""
    raw = data.tobytes()
    cuts = [0]
    for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        at = low
        while high - at > limit and (m := _CUT.search(raw, at + limit, high)):
            at = m.start() + 1
            cuts.append(at)
        cuts.append(high)
    at = 0
    while at < len(cuts) - 1:
        to = at + 1
        while to + 1 < len(cuts) and cuts[to + 1] - cuts[at] <= limit:
            to += 1
        yield cuts[at], cuts[to], np.array(cuts[at : to + 1], np.int64) - cuts[at]
        at = to


def _encoded(encoder: Encoder, column: pa.Array, packed: bool) -> pa.Array:
    data, offsets = w.text_bytes(column)
    found, ends, count = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], [np.zeros(0, np.int64)]
    for low, high, cuts in _stretches(data, offsets, STRETCH):
        ids, n = encoder.encode(data[low:high], cuts)
        found.append(ids)
        ends.append(low + cuts[1:])
        count.append(n)
    total = np.concatenate([[0], np.cumsum(np.concatenate(count))])
    # The last of equal ends counts: an empty text has none of its own.
    first = total[np.searchsorted(np.concatenate(ends), offsets, "right") - 1]
    first[0] = 0
    ids = np.concatenate(found).astype("<i4")
    if packed:
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(first * 4), pa.py_buffer(ids)]).cast(pa.binary())
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))


def _added(df: DataFrame, name: str, kind) -> StructType:
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column exists already: {name}")
    return StructType([*df.schema.fields, *StructType().add(name, kind).fields])


def encode(docs: DataFrame, text_col: str, vocabulary: str, ids: str = "ids", packed: bool = False) -> DataFrame:
    """All columns of ``docs`` and the token ids of the whole text.

    ``vocabulary`` is the path of a ``tokenizer.json`` on the driver. Ids are those of
    the tokenizers library without special tokens added; the text of an added token
    gives its id. With ``packed`` they are one binary of little-endian 32-bit integers
    instead of an array. Null and empty texts have no ids. Equal rows are encoded alike,
    each for itself. ``ids`` must not be taken; other names may be any.

    A task cuts its texts into words, finds the distinct ones of some megabytes,
    proposes the longest matches of each and tests every two adjacent tokens. By
    ``compatible`` a word is encoded right exactly if all its pairs are; the others are
    merged. Longer texts are cut at blanks; only a longer word is held whole.
    """
    schema = _added(docs, ids, BinaryType() if packed else ArrayType(IntegerType(), False))
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))

    def run(batches):
        encoder = Encoder(shared.value)
        for whole in batches:
            for part in w.pieces(whole, text_col, STRETCH):
                column = _encoded(encoder, part.column(text_col), packed)
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, ids])

    return docs.mapInArrow(run, schema)


def decode(tokens: DataFrame, ids_col: str, vocabulary: str, text: str = "decoded") -> DataFrame:
    """All columns of ``tokens`` and the text of their ids, added tokens included.

    Ids are an array or a packed binary. Null gives an empty text, ids beyond the
    vocabulary give nothing, and bytes that are no UTF-8 give U+FFFD.
    """
    schema = _added(tokens, text, StringType())
    packed = isinstance(tokens.schema[ids_col].dataType, BinaryType)
    shared = tokens.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary).names)

    def numbers(value) -> np.ndarray:
        if value.as_py() is None:
            return np.zeros(0, np.int64)
        if packed:
            return np.frombuffer(value.as_py(), "<u4").astype(np.int64)
        return value.values.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)

    def run(batches):
        names = [x or b"" for x in shared.value]
        for part in batches:
            texts = []
            for value in part.column(ids_col):
                own = numbers(value)
                own = own[(own >= 0) & (own < len(names))]
                raw = [b"".join([names[i] for i in own[k : k + MOST_IDS].tolist()]) for k in range(0, len(own), MOST_IDS)]
                texts.append(b"".join(raw).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, text])

    return tokens.mapInArrow(run, schema)
