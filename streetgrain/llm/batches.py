"""Documents packed into batches, and exact answers about values that batches share.

``pack`` cuts a table into batches of a few megabytes of text, one row each.
Questions about a value that many batches may hold travel as sorted binary
columns: a batch sends each of its distinct values once, cut by value range into
shards; a shard answers with one bit per value sent. So a frequent value costs
each batch one entry, and neither side holds more than a batch or a shard.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written, written_by
from . import words as w

BATCH_BYTES = 4 << 20
SHARD_VALUES = 8 << 20
PACKED = "batch long, ids array<long>, sizes binary, text binary, n_words long, n_bytes long, digest long"
LAST = np.iinfo(np.int64).max  # stands for a null id: null ids come last


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
    )


def pack(
    docs: DataFrame, id_col: str, text_col: str, limit: int = BATCH_BYTES, keep: tuple[str, ...] = (), write: bool = True, buckets: int = 0
) -> DataFrame:
    """One row per batch of documents, in id order within the batch.

    A document longer than ``limit`` bytes is a batch of its own. Null text is
    empty text. Rows that are equal stay separate documents. ``keep`` names
    further string columns, kept as lists ``k0``, ``k1``, ... The result is
    written to the shared folder, or else computed again by each reader: then
    ``digest`` tells a reader whether it has seen the same batch, which holds
    for files but not for every input.
    """

    def run(parts):
        n = TaskContext.get().partitionId() << 32
        codec = zstandard.ZstdCompressor(level=3)
        for whole in parts:
            for part in w.pieces(whole, "text", limit):
                ids = part.column("id")
                order = np.argsort(ids.fill_null(int(LAST)).to_numpy(zero_copy_only=False), kind="stable")
                part = part.take(pa.array(order))
                data, offsets = w.text_bytes(part.column("text"))
                sizes = np.diff(offsets).astype(np.int64).tobytes()
                raw = data.tobytes()
                digest = int.from_bytes(blake2b(raw + sizes, digest_size=8).digest(), "big", signed=True)
                count = len(w.split(data, offsets).starts)
                kept = [pa.array([part.column(f"k{i}").to_pylist()], pa.list_(pa.string())) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([n]), pa.array([part.column("id").to_pylist()], pa.list_(pa.int64())), pa.array([sizes], pa.binary()),
                        pa.array([codec.compress(raw)], pa.binary()), pa.array([count]), pa.array([len(raw)]), pa.array([digest]), *kept,
                    ],
                    ["batch", "ids", "sizes", "text", "n_words", "n_bytes", "digest", *(f"k{i}" for i in range(len(keep)))],
                )
                n += 1

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
        *[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(keep)],
    )
    packed = rows.mapInArrow(run, PACKED + "".join(f", k{i} array<string>" for i in range(len(keep))))
    if buckets:
        return written_by(packed, "batches", "batch", buckets)
    return written(packed, "batches") if write else packed


class Batch:
    """An unpacked batch: document ids, their bytes and offsets."""

    def __init__(self, table, i: int = 0) -> None:
        self.batch = table.column("batch")[i].as_py()
        self.digest = table.column("digest")[i].as_py()
        ids = table.column("ids")[i].values
        self.id_column = ids
        self.ids = ids.fill_null(int(LAST)).to_numpy(zero_copy_only=False)
        sizes = np.frombuffer(table.column("sizes")[i].as_py(), np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.data = np.frombuffer(zstandard.decompress(table.column("text")[i].as_py()), np.uint8)

    def words(self, cls: np.ndarray = w.NOT_SPACE) -> w.Words:
        return w.split(self.data, self.offsets, cls)

    def texts(self) -> list[str]:
        return _strings(self.data, self.offsets).cast(pa.large_string()).to_pylist()


def shard_bits(values: int, size: int = SHARD_VALUES) -> int:
    """log2 of the number of shards for so many values."""
    return max(0, (int(values) // size).bit_length())


def cut(values: np.ndarray, bits: int) -> np.ndarray:
    """Bounds of the shards in sorted 64-bit values: shard k holds [bounds[k], bounds[k + 1])."""
    if bits == 0:
        return np.array([0, len(values)])
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(values, edges), [len(values)]])


def planes(values: np.ndarray) -> bytes:
    """Bytes of the values, all first bytes together, then all second ones: small values then compress well."""
    raw = values.view(np.uint8).reshape(len(values), values.itemsize)
    return np.ascontiguousarray(raw.T).tobytes()


def from_planes(raw: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def sorted_unique(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and whether each occurs twice or more."""
    values = np.sort(values)
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    at = np.flatnonzero(first)
    return values[at], np.diff(np.concatenate([at, [len(values)]])) > 1


def unpack_bits(reply, sizes: np.ndarray, step: int) -> np.ndarray:
    """The answers of one step for a batch, in the order of its values."""
    got = {
        s: b for s, r, b in zip(
            reply.column("shard").to_pylist(), reply.column("step").to_pylist(), reply.column("bits").to_pylist(),
            strict=True,
        ) if r == step
    }
    parts = [
        np.unpackbits(np.frombuffer(got[k], np.uint8), count=int(n)).astype(bool) for k, n in enumerate(sizes) if n
    ]
    return np.concatenate(parts) if parts else np.zeros(0, bool)
