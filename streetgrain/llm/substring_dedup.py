"""Removal of passages that already occurred, by rolling hashes of fixed-length word windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import batches as b
from . import words as w

WINDOW = 20
FOUND = "batch long, step int, shard long, bits binary"
RESULT = "id long, n_words long, removed array<struct<start:int,end:int>>, kept string"


def _hashed(batch: b.Batch, width: int):
    words = batch.words()
    one = w.hashes(words)
    at, key = w.windows(one, words.first, width)
    return words, at, key


def _send(bits: int, width: int):
    """Step 1: each distinct window hash of a batch as four bytes below its shard's bits."""

    def run(parts):
        for part in parts:
            for i in range(part.num_rows):
                batch = b.Batch(part, i)
                key, _ = b.sorted_unique(_hashed(batch, width)[2])
                low = ((key << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
                edge = b.cut(key, bits)
                full = np.flatnonzero(np.diff(edge))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full), pa.array(np.full(len(full), batch.batch)),
                        pa.array([low[edge[k] : edge[k + 1]].tobytes() for k in full], pa.binary()),
                    ],
                    ["shard", "batch", "keys"],
                )

    return run


def _bits(table: pa.Table, step: int, flag: np.ndarray, sizes: list[int]) -> pa.Table:
    edge = np.concatenate([[0], np.cumsum(sizes)])
    out = [np.packbits(flag[edge[i] : edge[i + 1]]).tobytes() for i in range(len(sizes))]
    return pa.table({
        "batch": table.column("batch"), "step": pa.array([step] * len(sizes), pa.int32()),
        "shard": table.column("shard"), "bits": pa.array(out, pa.binary()),
    })


def _repeated(table: pa.Table) -> pa.Table:
    """Which hashes of a shard two batches or more have sent."""
    keys = [np.frombuffer(x, np.uint32) for x in table.column("keys").to_pylist()]
    joined = np.concatenate(keys).astype(np.uint64)
    order = np.sort((joined << np.uint64(32)) | np.arange(len(joined), dtype=np.uint64))
    same = (order[1:] >> np.uint64(32)) == (order[:-1] >> np.uint64(32))
    flag = np.zeros(len(joined), bool)
    place = (order & np.uint64(0xFFFFFFFF)).astype(np.int64)
    flag[place[1:][same]] = True
    flag[place[:-1][same]] = True
    return _bits(table, 1, flag, [len(k) for k in keys])


def _candidates(batch: b.Batch, reply: pa.Table, bits: int, width: int):
    """Windows that may occur elsewhere too: word position, document id, start in the document, two hashes, shards."""
    words, at, key = _hashed(batch, width)
    unique, _ = b.sorted_unique(key)
    sizes = np.diff(b.cut(unique, bits))
    wanted = unique[b.unpack_bits(reply, sizes, 1)]
    place = np.searchsorted(wanted, key)
    hit = (wanted[np.minimum(place, len(wanted) - 1)] == key) if len(wanted) else np.zeros(len(key), bool)
    return words, at, key, hit


def _ordered(batch: b.Batch, words: w.Words, at: np.ndarray, key: np.ndarray, width: int):
    """The windows at these words: second hash, document id and start of each."""
    row = np.searchsorted(words.first, at, "right") - 1
    two = w.hashes(words, 1)
    where, second = w.windows(two, words.first, width, 1)
    second = second[np.searchsorted(where, at)]
    return batch.ids[row], (at - words.first[row]).astype(np.uint32), second


def _groups(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows and, in that order, whether a row starts a new group of equal leading two columns."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        a, c = columns[0][order], columns[1][order]
        new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
    return order, new


def _firsts(ids: np.ndarray, start: np.ndarray, key: np.ndarray, second: np.ndarray):
    """Per distinct window the smallest (document, start): indices of those rows, and the group of every row."""
    order, new = _groups(key, second, ids, start)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return order[new], group


def _ask(bits: int, width: int):
    """Step 2: of each window that may be shared, both hashes and the batch's first place."""

    def run(left: pa.Table, reply: pa.Table) -> pa.Table:
        batch = b.Batch(left)
        words, at, key, hit = _candidates(batch, reply, bits, width)
        at, key = at[hit], key[hit]
        ids, start, second = _ordered(batch, words, at, key, width)
        lead, _ = _firsts(ids, start, key, second)
        edge = b.cut(key[lead], bits)
        full = np.flatnonzero(np.diff(edge))
        parts = [lead[edge[k] : edge[k + 1]] for k in full]
        check = (second >> np.uint64(32)).astype(np.uint32)
        return pa.table({
            "shard": pa.array(full, pa.int64()), "batch": pa.array(np.full(len(full), batch.batch), pa.int64()),
            "keys": pa.array([key[p].tobytes() for p in parts], pa.binary()),
            "checks": pa.array([check[p].tobytes() for p in parts], pa.binary()),
            "ids": pa.array([b.planes(ids[p]) for p in parts], pa.binary()),
            "starts": pa.array([b.planes(start[p]) for p in parts], pa.binary()),
        })

    return run


def _first_places(table: pa.Table) -> pa.Table:
    """Which of the places sent to a shard is the first of its window."""
    keys = [np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()]
    key = np.concatenate(keys)
    check = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("checks").to_pylist()])
    ids = np.concatenate([b.from_planes(x, np.int64) for x in table.column("ids").to_pylist()])
    start = np.concatenate([b.from_planes(x, np.uint32) for x in table.column("starts").to_pylist()])
    order, new = _groups(key, check, ids, start)
    lead = order[new][np.cumsum(new) - 1]
    flag = np.zeros(len(key), bool)
    flag[order] = (ids[order] == ids[lead]) & (start[order] == start[lead])
    return _bits(table, 2, flag, [len(k) for k in keys])


def _remove(bits: int, width: int):
    """Step 3: per document the words to remove, as maximal intervals, and the text that stays."""

    def run(left: pa.Table, reply: pa.Table) -> pa.Table:
        batch = b.Batch(left)
        words, at, key, hit = _candidates(batch, reply, bits, width)
        gone = np.zeros(len(words.starts), bool)
        # Windows of this batch alone are settled here, shared ones by the answer.
        _, twice = b.sorted_unique(key)
        unique = np.sort(key)
        unique = unique[np.concatenate([[True], unique[1:] != unique[:-1]])] if len(unique) else unique
        local = twice[np.searchsorted(unique, key)] if len(key) else np.zeros(0, bool)
        pick = np.flatnonzero(hit | local)
        ids, start, second = _ordered(batch, words, at[pick], key[pick], width)
        lead, group = _firsts(ids, start, key[pick], second)
        mine = np.ones(len(lead), bool)
        shared = hit[pick][lead]
        sizes = np.diff(b.cut(key[pick][lead][shared], bits))
        mine[shared] = b.unpack_bits(reply, sizes, 2)
        best = lead[group]
        earliest = mine[group] & (ids == ids[best]) & (start == start[best])
        gone = w.covered(at[pick[~earliest]], width, len(words.starts))
        count = np.diff(words.first)
        texts = batch.texts()
        lost = w.per_row(gone, words.first)
        removed, kept = [], []
        for i, text in enumerate(texts):
            pieces = text.translate(_SPACES).split(" ") if text else []
            pieces = [p for p in pieces if p]
            if lost[i]:
                mask = gone[words.first[i] : words.first[i + 1]]
                s, e = w.spans(mask)
                removed.append([{"start": int(x), "end": int(y)} for x, y in zip(s, e, strict=True)])
                pieces = [p for p, g in zip(pieces, mask.tolist(), strict=True) if not g]
            else:
                removed.append([])
            kept.append(" ".join(pieces))
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.table({
            "id": batch.id_column, "n_words": pa.array(count, pa.int64()),
            "removed": pa.array(removed, kind), "kept": pa.array(kept, pa.string()),
        })

    return run


_SPACES = {9: 32, 10: 32, 11: 32, 12: 32, 13: 32}


def remove_repeats(docs: DataFrame, id_col: str, text_col: str, width: int = WINDOW) -> DataFrame:
    """Removes each word in a window of ``width`` words that also starts earlier.

    Words are runs without ASCII white space. Earlier: in a document of smaller
    id, or before in the same document; windows are judged on the input. Null
    ids come last and count as equal. Rows of equal id and start are no earlier
    than each other, so both stay. Null or short text has no window. Other
    columns, whatever their names, are not read.

    Returns id, n_words, removed (word intervals, maximal) and kept (the words
    that stay, joined by one space).
    """
    packed = b.pack(docs, id_col, text_col)
    total = packed.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    bits = b.shard_bits(total)
    sent = packed.mapInArrow(_send(bits, width), "shard long, batch long, keys binary")
    step1 = written(sent.groupBy("shard").applyInArrow(_repeated, FOUND), "repeated")
    asked = packed.groupBy("batch").cogroup(step1.groupBy("batch")).applyInArrow(
        _ask(bits, width), "shard long, batch long, keys binary, checks binary, ids binary, starts binary"
    )
    step2 = asked.groupBy("shard").applyInArrow(_first_places, FOUND)
    both = step1.unionByName(step2)
    return packed.groupBy("batch").cogroup(both.groupBy("batch")).applyInArrow(_remove(bits, width), RESULT)
