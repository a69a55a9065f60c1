"""Vector code compression: a codebook per part of the vector, nearest entries by slices of sorted coordinates."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import vectors as vec

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
PROBES = 16  # entries whose distances give the first radius
BLOCK = 512  # rows that share one product with their common candidates
EXACT = 1 << 52  # whole numbers up to here are exact as doubles


class Slices(NamedTuple):
    """One codebook: per dimension its sorted coordinates, and before each place the mask of the entries so far."""

    entries: np.ndarray
    order: np.ndarray  # (dimension, place) sorted coordinates
    masks: np.ndarray  # (dimension, place, word) uint64


def slices(entries: np.ndarray) -> Slices:
    k, d = entries.shape
    at = np.argsort(entries, axis=0, kind="stable")
    words = max(1, -(-k // 64))
    bit = np.zeros((k, words), np.uint64)
    bit[np.arange(k), np.arange(k) // 64] = np.uint64(1) << (np.arange(k) % 64).astype(np.uint64)
    masks = np.zeros((d, k + 1, words), np.uint64)
    for i in range(d):
        np.bitwise_or.accumulate(bit[at[:, i]], axis=0, out=masks[i, 1:])
    return Slices(entries, np.take_along_axis(entries, at, 0).T.copy(), masks)


def candidates(book: Slices, rows: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Per row the mask of all entries within ``radius`` of it in every dimension."""
    out = np.full((len(rows), book.masks.shape[2]), ~np.uint64(0))
    for i in range(rows.shape[1]):
        low = np.searchsorted(book.order[i], rows[:, i] - radius, "left")
        high = np.searchsorted(book.order[i], rows[:, i] + radius, "right")
        out &= book.masks[i, high] ^ book.masks[i, low]
    return out


def distances(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances; as a product of doubles where every sum in it is a whole number below 2**52."""
    most = int(max(np.abs(rows).max(initial=0), np.abs(entries).max(initial=0)))
    d = rows.shape[1]
    if 4 * d * most * most < EXACT:
        a, b = rows.astype(np.float64), entries.astype(np.float64)
        return (np.einsum("ij,ij->i", a, a)[:, None] - 2 * (a @ b.T) + np.einsum("ij,ij->i", b, b)).astype(np.int64)
    kind = np.int64 if 4 * d * most * most < 1 << 63 else object
    total = np.zeros((len(rows), len(entries)), kind)
    for i in range(d):
        total += (rows[:, i, None].astype(kind) - entries[:, i].astype(kind)) ** 2
    return np.minimum(total, np.iinfo(np.int64).max).astype(np.int64)


def nearest(book: Slices, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry of each row; ties go to the lower index.

    The distance to the nearest of a few probes is the radius. Whatever is as near or
    nearer lies within it in each dimension, so the masks hold the nearest entry and all
    that tie with it. Rows of one probe share the product with their candidates' union;
    each row then chooses among its own.
    """
    n, k = len(rows), len(book.entries)
    code, error = np.zeros(n, np.int64), np.zeros(n, np.int64)
    probes = np.arange(0, k, max(1, k // PROBES))
    near = distances(rows, book.entries[probes])
    first = near.argmin(1)
    radius = np.ceil(np.sqrt(near[np.arange(n), first].astype(np.float64))).astype(np.int64) + 1
    mask = candidates(book, rows, radius)
    order = np.lexsort((radius, first))
    for at in range(0, n, BLOCK):
        some = order[at : at + BLOCK]
        own = np.unpackbits(mask[some].view(np.uint8), axis=1, bitorder="little", count=k).astype(bool)
        union = np.flatnonzero(own.any(0))
        far = distances(rows[some], book.entries[union])
        far[~own[:, union]] = np.iinfo(np.int64).max
        best = far.argmin(1)
        code[some], error[some] = union[best], far[np.arange(len(some)), best]
    return code, error


def _bounds(d: int, parts: int) -> list[tuple[int, int]]:
    return [(i * d // parts, (i + 1) * d // parts) for i in range(parts)]


def _sums(rows: DataFrame, vector: str, d: int, books: list[np.ndarray]) -> DataFrame:
    """Per task: part, entry, n, and per position the sum of the parts that are nearest to the entry."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    bounds = _bounds(d, len(books))

    def run(batches):
        tables = [slices(b) for b in shared.value]
        count = [np.zeros(len(b), np.int64) for b in shared.value]
        total = [np.zeros(b.shape, np.int64) for b in shared.value]
        for batch in batches:
            x = vec.scaled(batch.column(0), d, SCALE)
            for p, (low, high) in enumerate(bounds):
                own = x[:, low:high]
                code, _ = nearest(tables[p], own)
                count[p] += np.bincount(code, minlength=len(count[p]))
                by = np.argsort(code, kind="stable")
                used, start = np.unique(code[by], return_index=True)
                if len(used) and high > low:
                    total[p][used] += np.add.reduceat(own[by], start, axis=0)
        for p, (n, s) in enumerate(zip(count, total, strict=True)):
            e, i = np.indices(s.shape).reshape(2, -1)
            yield pa.RecordBatch.from_pydict({
                "part": np.full(e.size, p, np.int32), "entry": e.astype(np.int32), "position": i.astype(np.int32), "n": n[e], "s": s[e, i],
            })

    return rows.select(vector).mapInArrow(run, "part int, entry int, position int, n long, s long").where("n > 0")


def train(rows: DataFrame, id_col: str, vector: str, d: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after ``rounds`` of nearest-entry means over all rows. They and one sum per value are all the driver holds."""
    first = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(vector).alias("v")).orderBy("i", "v").limit(entries).collect()
    start = vec.scaled(pa.array([r.v for r in first], pa.list_(pa.float64())), d, SCALE)
    books = [start[:, low:high].copy() for low, high in _bounds(d, parts)]
    for _ in range(rounds if first else 0):
        sums = _sums(rows, vector, d, books).groupBy("part", "entry", "position")
        # Sums of many large values need more than a long.
        found = sums.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
        for r in found:
            books[r.part][r.entry, r.position] = int(r.s) // r.n
    return books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def compress(
    rows: DataFrame, id_col: str, vector: str, label: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, label, code, error, label_error) per usable row, and the codebooks.

    Components become floor(1024 x), at most 2**28 in size. Rows whose vector is null, of
    another length than most, or holds a null or a number that isn't finite are left out.
    A vector is cut into equal parts (as equal as its length allows). A codebook starts as
    that part of the rows of the ``entries`` smallest ids, null ids left out and equal ids
    by vector; with fewer rows it is smaller. ``code`` has two hex digits per part, so
    ``entries`` is at most 256. Equal rows count each time and get equal codes. Without ids
    nothing can be coded and no row is returned.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    good = rows.select(F.col(id_col).alias("id"), F.col(vector).alias("v"), F.col(label).alias("label")).where(vec.usable("v"))
    d = vec.usual_length(good, "v")
    good = good.where(F.size("v") == d)
    books = train(good, "id", "v", d, parts, entries, rounds)
    shared = rows.sparkSession.sparkContext.broadcast(books)
    bounds = _bounds(d, parts)
    digits = np.array([f"{i:02x}" for i in range(256)], "U2")

    def run(batches):
        tables = [slices(b) for b in shared.value]
        for batch in batches:
            x = vec.scaled(batch.column("v"), d, SCALE)
            found = [nearest(t, x[:, low:high]) for t, (low, high) in zip(tables, bounds, strict=True)]
            code = digits[found[0][0]]
            for c, _ in found[1:]:
                code = np.char.add(code, digits[c])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(code, pa.string()), pa.array(sum(e for _, e in found), pa.int64())],
                ["id", "label", "code", "error"],
            )

    schema = good.select("id", "label").schema.add("code", "string").add("error", "long")
    coded = good.where(F.lit(len(books[0]) > 0)).select("id", "v", "label").mapInArrow(run, schema)
    # Written once: the sums by label and the result both read it.
    coded = written(coded, "codes")
    by_label = coded.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("l"))).drop("l"), books
