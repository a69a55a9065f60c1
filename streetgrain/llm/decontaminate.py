"""Benchmark decontamination: an FM-index per shard of training text, searched for every benchmark window."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as w
from .fm_index import FMIndex

WINDOW = 13
SHARD_BYTES = 4 << 20
SHARD_WORDS = 1 << 20
# Benchmark text that one pass searches for; larger benchmarks take several passes.
PASS_BYTES = 16 << 20
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
FILTER = 20  # bits of the first vocabulary test


class Phrases(NamedTuple):
    """Distinct windows of some benchmark items, and the items of each."""

    vocabulary: np.ndarray  # sorted word hashes; a word's number is its place + 1
    maybe: np.ndarray
    words: np.ndarray  # right-aligned word numbers
    lengths: np.ndarray
    items: list[list[str]]


def phrases(items: list[tuple[str, str]], width: int = WINDOW) -> Phrases:
    """``items`` are (id, text). An item of fewer words than ``width`` is one window."""
    data, offsets = w.text_bytes(pa.array([t for _, t in items], pa.string()))
    split = w.split(w.LOWER[data], offsets, w.LETTERS)
    key = w.hashes(split)
    vocabulary = np.sort(np.array(list(set(key.tolist())), np.uint64))
    number = np.searchsorted(vocabulary, key) + 1
    found: dict[tuple[int, ...], set[str]] = {}
    for i, (name, _) in enumerate(items):
        own = number[split.first[i] : split.first[i + 1]].tolist()
        if own:
            for at in range(max(1, len(own) - width + 1)):
                found.setdefault(tuple(own[at : at + width]), set()).add(name)
    table = np.zeros((len(found), width), np.int64)
    for i, phrase in enumerate(found):
        table[i, width - len(phrase) :] = phrase
    maybe = np.zeros(1 << FILTER, bool)
    maybe[(vocabulary >> np.uint64(64 - FILTER)).astype(np.int64)] = True
    lengths = np.array([len(p) for p in found], np.int64)
    return Phrases(vocabulary, maybe, table, lengths, [sorted(x) for x in found.values()])


def _numbers(key: np.ndarray, wanted: Phrases) -> np.ndarray:
    """Number of each word, 0 for words of no phrase."""
    out = np.zeros(len(key), np.int64)
    some = np.flatnonzero(wanted.maybe[(key >> np.uint64(64 - FILTER)).astype(np.int64)])
    at = np.searchsorted(wanted.vocabulary, key[some])
    at[at == len(wanted.vocabulary)] = 0
    same = wanted.vocabulary[at] == key[some]
    out[some[same]] = at[same] + 1
    return out


def _runs(number: np.ndarray, first: np.ndarray, shortest: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of phrase words within one document that can hold a phrase; long runs are cut with an overlap."""
    inside = np.concatenate([number > 0, [False]])
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts = first[:-1][np.diff(first) > 0]
    begins[starts] = inside[starts]
    begins = np.flatnonzero(begins)
    ends_at = ~inside
    ends_at[starts] = True
    stops = np.flatnonzero(ends_at)
    ends = stops[np.searchsorted(stops, begins, "right")]
    keep = ends - begins >= shortest
    begins, ends = begins[keep], ends[keep]
    room = SHARD_WORDS - longest
    if len(begins) and (ends - begins).max() > room:
        cut = [(s, min(s + SHARD_WORDS - 1, e)) for b, e in zip(begins, ends, strict=True) for s in range(b, e, room)]
        begins, ends = (np.array(x) for x in zip(*cut, strict=True))
    return begins, ends


def occurrences(split: w.Words, wanted: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, first word) of every occurrence in the texts, through FM-indexes of bounded size."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    if len(wanted.lengths):
        number = _numbers(w.hashes(split), wanted)
        begins, ends = _runs(number, split.first, int(wanted.lengths.min()), int(wanted.lengths.max()))
        size = np.cumsum(ends - begins + 1)
        at = 0
        while at < len(begins):
            done = int(size[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(size, done + SHARD_WORDS, "right")))
            length = ends[at:to] - begins[at:to] + 1  # with the break
            lead = np.cumsum(length) - length
            origin = np.arange(int(length.sum())) - np.repeat(lead, length) + np.repeat(begins[at:to], length)
            breaks = lead + length - 1
            origin[breaks] = 0
            text = number[origin]
            text[breaks] = 0
            index = FMIndex(text, len(wanted.vocabulary) + 1)
            phrase, place = index.locate(*index.search(wanted.words, wanted.lengths))
            found.append((phrase, origin[place]))
            at = to
    phrase, place = (np.concatenate(x) for x in zip(*found, strict=True))
    return phrase, place


def _scan(text_col: str, hits: str, names: str, words: str, shared):
    def run(parts):
        wanted: Phrases = shared.value
        for whole in parts:
            for part in w.pieces(whole, text_col, SHARD_BYTES):
                data, offsets = w.text_bytes(part.column(text_col))
                split = w.split(w.LOWER[data], offsets, w.LETTERS)
                phrase, place = occurrences(split, wanted)
                row = np.searchsorted(split.first, place, "right") - 1
                before = part.column(hits).to_pylist()
                items = [set(x or ()) for x in part.column(names).to_pylist()]
                old = [(split.first[i] + s["start"], s["end"] - s["start"]) for i, x in enumerate(before) for s in x or ()]
                starts = np.concatenate([place, np.array([s for s, _ in old], np.int64)])
                lengths = np.concatenate([wanted.lengths[phrase], np.array([n for _, n in old], np.int64)])
                mask = w.covered(starts, lengths, len(split.starts))
                for i, p in {*zip(row.tolist(), phrase.tolist(), strict=True)}:
                    items[i].update(wanted.items[p])
                spans = []
                total = w.per_row(mask, split.first)
                for i in range(part.num_rows):
                    own = []
                    if total[i]:
                        low = split.first[i]
                        own = [
                            {"start": int(s), "end": int(e)}
                            for s, e in zip(*w.spans(mask[low : split.first[i + 1]]), strict=True)
                        ]
                    spans.append(own)
                new = {
                    hits: pa.array(spans, SPANS), names: pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    words: pa.array(np.diff(split.first), pa.int64()),
                }
                yield pa.RecordBatch.from_arrays([new.get(c, part.column(c)) for c in part.schema.names], part.schema.names)

    return run


def find_contamination(
    docs: DataFrame, text_col: str, items: DataFrame, item_id: str, item_text: str, width: int = WINDOW,
    hits: str = "hits", found: str = "items", words: str = "n_words",
) -> DataFrame:
    """All columns of ``docs`` and three more: covered word intervals, ids of the items found, number of words.

    Words are lower-cased runs of digits, a-z and characters beyond ASCII. An
    item's windows are its ``width`` consecutive words; a shorter item is one
    window; an item without words has none. A null item id is an empty string. Null
    text has no words. Equal rows are judged alike, each for itself. The names of
    the new columns must not be taken, so the caller chooses them.

    Each task indexes its shard of the text, so no text is shuffled. The
    benchmark is searched in passes of about ``PASS_BYTES`` of item text; only
    that much is on the driver or broadcast at a time.
    """
    taken = {c.lower() for c in docs.columns} & {hits.lower(), found.lower(), words.lower()}
    if taken:
        raise ValueError(f"columns exist already: {sorted(taken)}")
    spark = docs.sparkSession
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(item_text).alias("text"))
    rows = rows.where("text IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = -(-size // PASS_BYTES) or 1
    out = docs.withColumns({
        hits: F.array().cast("array<struct<start:int,end:int>>"), found: F.array().cast("array<string>"),
        words: F.lit(0).cast("long"),
    })
    schema = out.schema
    for k in range(passes):
        some = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == k) if passes > 1 else rows
        shared = spark.sparkContext.broadcast(phrases([(r.id, r.text) for r in some.collect()], width))
        out = out.mapInArrow(_scan(text_col, hits, found, words, shared), schema)
    return out
