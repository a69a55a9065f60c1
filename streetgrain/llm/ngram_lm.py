"""Interpolated modified Kneser-Ney n-gram models over the bytes of UTF-8 text.

A token is a byte, so n-grams of up to seven tokens are exact 64-bit numbers and
all models share one vocabulary. Counting and scoring go by batches of documents:
a batch sends its distinct n-grams once, cut into shards; counts are summed per
shard and joined in Spark into the models; each batch gets the value of each of
its n-grams back and sums them per document. So a frequent n-gram is one entry
per batch, and no task holds more than a batch or a shard.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import batches as b
from . import words as w

ORDER = 5
SENT = "shard int, batch long, digest long, keys binary, counts binary"
# Text bytes per entry that a batch sends, at the least; for the number of shards.
BYTES_PER_GRAM = 16


def grams(batch: b.Batch, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-gram that ends at each byte, and its document; n - 1 zero bytes precede a text."""
    size = np.diff(batch.offsets)
    n = len(batch.data)
    out = np.zeros(n, np.uint64)
    for back in range(min(order, n)):
        out[back:] |= batch.data[: n - back].astype(np.uint64) << np.uint64(8 * back)
    for into in range(order - 1):  # nothing of the text before
        at = batch.offsets[:-1][size > into] + into
        out[at] &= np.uint64((1 << (8 * (into + 1))) - 1)
    return out, np.repeat(np.arange(len(size)), size)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(first)
    return keys[at], np.diff(np.concatenate([at, [len(keys)]]))


def _shard(keys: np.ndarray, bits: int) -> np.ndarray:
    return (w.mix(keys) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _by_shard(keys: np.ndarray, bits: int) -> list[tuple[int, np.ndarray]]:
    """Each shard that has some of the keys, and their places in order."""
    shard = _shard(keys, bits)
    order = np.argsort(shard, kind="stable")
    found, first = np.unique(shard[order], return_index=True)
    return list(zip(found.tolist(), np.split(order, first[1:]), strict=True)) if len(keys) else []


def _zip(values: np.ndarray) -> bytes:
    return zstandard.compress(b.planes(values), 1)


def _unzip(raw: bytes, kind) -> np.ndarray:
    return b.from_planes(zstandard.decompress(raw), kind)


def _steps(keys: np.ndarray) -> bytes:
    """Sorted numbers as their differences."""
    return _zip(np.diff(keys, prepend=np.uint64(0)))


def _from_steps(raw: bytes) -> np.ndarray:
    return np.cumsum(_unzip(raw, np.uint64), dtype=np.uint64)


def _parts(batch: b.Batch, order: int, bits: int, chosen: np.ndarray, total: bool):
    """Per shard: number, sorted n-grams of the batch, and their counts: all if ``total``, and in chosen documents."""
    key, row = grams(batch, order)
    unique, count = _counted(key)
    own = np.zeros(len(unique), np.int64)
    if chosen.any():
        some, n = _counted(key[chosen[row]])
        own[np.searchsorted(unique, some)] = n
    for s, at in _by_shard(unique, bits):
        yield s, unique[at], np.stack([count[at], own[at]] if total else [own[at]])


def message(batch: b.Batch, order: int, bits: int, chosen: np.ndarray, total: bool) -> pa.Table:
    parts = list(_parts(batch, order, bits, chosen, total))
    return pa.table({
        "shard": pa.array([s for s, _, _ in parts], pa.int32()),
        "batch": pa.array([batch.batch] * len(parts), pa.int64()), "digest": pa.array([batch.digest] * len(parts), pa.int64()),
        "keys": pa.array([_steps(k) for _, k, _ in parts], pa.binary()),
        "counts": pa.array([_zip(c.ravel()) for _, _, c in parts], pa.binary()),
    })


def marks(packed: DataFrame, chosen: DataFrame) -> DataFrame:
    """of (a batch) and at, the places in the batch of the documents whose id is among ``chosen`` (id)."""
    ids = packed.select("batch", F.posexplode("ids").alias("at", "id"))
    return ids.join(chosen, "id", "left_semi").groupBy(F.col("batch").alias("of")).agg(F.collect_list("at").alias("at"))


def send_marked(packed: DataFrame, marks: DataFrame, order: int, bits: int, total: bool = True) -> DataFrame:
    """The distinct n-grams of each batch, by shard, with counts over all documents if ``total`` and over marked ones.

    ``marks`` has of (a batch) and at, the places of the marked documents in the batch.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        batch = b.Batch(left)
        chosen = np.zeros(len(batch.ids), bool)
        for places in right.column("at").to_pylist():
            chosen[places] = True
        return message(batch, order, bits, chosen, total)

    return packed.groupBy("batch").cogroup(marks.groupBy("of")).applyInArrow(run, SENT)


def counts(sent: DataFrame, names: tuple[str, ...] = ("n_all", "n_marked")) -> DataFrame:
    """shard, gram and each count that was sent, over all batches."""

    def run(table: pa.Table) -> pa.Table:
        keys = [_from_steps(x) for x in table.column("keys").to_pylist()]
        numbers = [_unzip(x, np.int64).reshape(len(names), -1) for x in table.column("counts").to_pylist()]
        unique, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = [np.bincount(place, np.concatenate([n[i] for n in numbers]), len(unique)).astype(np.int64) for i in range(len(names))]
        return pa.table({
            "shard": pa.array(np.full(len(unique), table.column("shard")[0].as_py()), pa.int32()),
            "gram": pa.array(unique.view(np.int64)), **{n: pa.array(t) for n, t in zip(names, total, strict=True)},
        })

    return sent.groupBy("shard").applyInArrow(run, "shard int, gram long" + "".join(f", {n} long" for n in names))


def shard_bits(n_bytes: int) -> int:
    return b.shard_bits(n_bytes // BYTES_PER_GRAM)


def suffix(gram: Column, k: int) -> Column:
    """The last k tokens."""
    return gram.bitwiseAND(F.lit((1 << (8 * k)) - 1))


def _context(gram: Column) -> Column:
    return F.shiftright(gram, 8)


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and more, from how many n-grams have counts 1 to 4."""
    if not n1 or not n2:
        return 0.5, 0.75, 1.0  # too few n-grams to estimate
    y = n1 / (n1 + 2 * n2)
    d1, d2 = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return min(max(d1, 0.1), 1.0), min(max(d2, 0.1), 2.0), min(max(d3, 0.1), 3.0)


class Models:
    """Tables of Kneser-Ney models that share them, by n-gram length: probabilities of n-grams, weights of contexts."""

    def __init__(self, count: DataFrame, columns: tuple[str, ...], order: int, symbols: int) -> None:
        """``count`` has gram, maybe further columns, and a count at the full length per model, one of them above 0.

        ``symbols`` is the size of the shared vocabulary. An n-gram that only another
        model has seen gets its probability from the shorter one, so every n-gram of
        the tables has one in each model.
        """
        self.order, self.symbols, self.many = order, symbols, len(columns)
        each = range(self.many)
        self.more = [c for c in count.columns if c != "gram" and c not in columns]
        levels = {order: written(count.select("gram", *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], *self.more), "level")}
        for k in range(order - 1, 0, -1):
            # Below the full length a count is the number of tokens that precede.
            longer = levels[k + 1].select(suffix(F.col("gram"), k).alias("gram"), *[f"c{i}" for i in each])
            levels[k] = written(longer.groupBy("gram").agg(*[F.count(F.when(F.col(f"c{i}") > 0, 1)).alias(f"c{i}") for i in each]), "level")
        self.seen: dict[int, DataFrame] = {}
        self.weight: dict[int, DataFrame] = {}
        for k in range(1, order + 1):
            four = levels[k].agg(*[F.count(F.when(F.col(f"c{i}") == n, 1)) for i in each for n in (1, 2, 3, 4)]).first()
            cuts, sums, weights, p = [], [], [], []
            for i in each:
                d1, d2, d3 = _discounts(*four[4 * i : 4 * i + 4])
                c, lower = F.col(f"c{i}"), F.col(f"lower{i}") if k > 1 else F.lit(1.0 / symbols)
                cuts.append(F.when(c == 0, 0.0).when(c == 1, d1).when(c == 2, d2).otherwise(d3).alias(f"cut{i}"))
                sums += [F.sum(c).alias(f"total{i}"), F.sum(f"cut{i}").alias(f"freed{i}")]
                # A context that this model hasn't seen leaves all to the shorter one.
                weights.append(F.when(F.col(f"total{i}") > 0, F.col(f"freed{i}") / F.col(f"total{i}")).otherwise(1.0).alias(f"weight{i}"))
                kept = F.when(c > 0, (c - F.col(f"cut{i}")) / F.col(f"total{i}")).otherwise(0.0)
                p.append((kept + F.col(f"weight{i}") * lower).alias(f"p{i}"))
            rows = levels[k].withColumn("context", _context(F.col("gram"))).select("*", *cuts)
            self.weight[k] = written(rows.groupBy("context").agg(*sums).select("context", *[f"total{i}" for i in each], *weights), "weights")
            rows = rows.join(self.weight[k], "context")
            if k > 1:
                lower = self.seen[k - 1].select(F.col("gram").alias("s"), *[F.col(f"p{i}").alias(f"lower{i}") for i in each])
                rows = rows.withColumn("s", suffix(F.col("gram"), k - 1)).join(lower, "s")
            self.seen[k] = written(rows.select("gram", *p, *(self.more if k == order else [])), "seen")

    def seen_bits(self, names: tuple[str, ...]) -> DataFrame:
        """The n-grams that were counted, their further columns, and the negative log of each probability, in bits."""
        return self.seen[self.order].select("gram", *self.more, *[(-F.log2(f"p{i}")).alias(n) for i, n in enumerate(names)])

    def score(self, wanted: DataFrame, names: tuple[str, ...]) -> DataFrame:
        """``wanted`` (shard, gram) and the negative log of each gram's probability, in bits."""
        each = range(self.many)
        asked = {self.order: wanted.select("gram")}
        for k in range(self.order - 1, 0, -1):
            asked[k] = asked[k + 1].select(suffix(F.col("gram"), k).alias("gram")).distinct()
        lower = None
        for k in range(1, self.order + 1):
            rows = asked[k].join(self.seen[k], "gram", "left").withColumn("context", _context(F.col("gram")))
            rows = rows.join(self.weight[k].select("context", *[f"weight{i}" for i in each]), "context", "left")
            rest = [F.lit(1.0 / self.symbols) for _ in each]
            if lower is not None:
                rows = rows.withColumn("s", suffix(F.col("gram"), k - 1)).join(lower, "s")
                rest = [F.col(f"lower{i}") for i in each]
            p = [F.coalesce(f"p{i}", F.coalesce(f"weight{i}", F.lit(1.0)) * rest[i]).alias(f"f{i}") for i in each]
            last = rows.select("gram", *p)
            lower = last.select(F.col("gram").alias("s"), *[F.col(f"f{i}").alias(f"lower{i}") for i in each])
        return wanted.join(last.select("gram", *[(-F.log2(f"f{i}")).alias(n) for i, n in enumerate(names)]), "gram")


def answer(sent: DataFrame, scored: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """The values of each batch's n-grams in the order sent: batch, digest, shard, values."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        key = right.column("gram").to_numpy().view(np.uint64)
        order = np.argsort(key)
        key = key[order]
        value = np.stack([right.column(n).to_numpy()[order] for n in names]).astype(np.float32)
        out = [np.ascontiguousarray(value[:, np.searchsorted(key, _from_steps(x))]).tobytes() for x in left.column("keys").to_pylist()]
        return pa.table({
            "batch": left.column("batch"), "digest": left.column("digest"), "shard": left.column("shard"),
            "values": pa.array([zstandard.compress(x, 1) for x in out], pa.binary()),
        })

    keys = sent.select("shard", "batch", "digest", "keys").groupBy("shard")
    rows = scored.select("shard", "gram", *names).groupBy("shard")
    return keys.cogroup(rows).applyInArrow(run, "batch long, digest long, shard int, values binary")


def sums(packed: DataFrame, answers: DataFrame, order: int, bits: int, names: tuple[str, ...], keep: int = 0) -> DataFrame:
    """id, n (tokens), the sum of each value, and the kept columns, per document."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        batch = b.Batch(left)
        if len(batch.data) and {*right.column("digest").to_pylist()} != {batch.digest}:
            raise ValueError("the input changed between two reads; write it to files first")
        key, row = grams(batch, order)
        low = len(batch.ids).bit_length()
        if low + 8 * order <= 64:  # n-gram and document in one number
            both = np.sort((key << np.uint64(low)) | row.astype(np.uint64))
            place = (both & np.uint64((1 << low) - 1)).astype(np.int64)
            unique, count = _counted(both >> np.uint64(low))
        else:
            place = row[np.argsort(key, kind="stable")]
            unique, count = _counted(key)
        values = np.zeros((len(names), len(unique)))
        got = dict(zip(right.column("shard").to_pylist(), right.column("values").to_pylist(), strict=True))
        for s, at in _by_shard(unique, bits):
            values[:, at] = np.frombuffer(zstandard.decompress(got[s]), np.float32).reshape(len(names), -1)
        total = [np.bincount(place, np.repeat(v, count), len(batch.ids)).astype(np.float64) for v in values]
        return pa.table(
            {"id": batch.id_column, "n": pa.array(np.diff(batch.offsets), pa.int64())}
            | {name: pa.array(t) for name, t in zip(names, total, strict=True)}
            | {f"k{i}": left.column(f"k{i}")[0].values for i in range(keep)}
        )

    schema = "id long, n long" + "".join(f", {n} double" for n in names) + "".join(f", k{i} string" for i in range(keep))
    return packed.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(run, schema)
