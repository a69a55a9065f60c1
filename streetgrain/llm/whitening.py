"""Embedding whitening: blockwise QR of the centred rows, then singular vectors of the small triangle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import bidiagonal as bd
from . import vectors as vec

SCALE = 256
COMPONENTS = 4
BLOCK_VALUES = 1 << 20  # values of the rows that join a triangle at a time
FAN_IN = 64  # triangles that one task stacks


def _rows(column: pa.Array, d: int) -> np.ndarray:
    """Vectors from packed bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), d).astype(np.int64)


def _blocks(batches, d: int):
    """Matrices of about ``BLOCK_VALUES`` values from Arrow batches of packed vectors."""
    step = max(1, BLOCK_VALUES // max(d, 1))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield _rows(batch.column(0).slice(at, step), d)


def _triangles(fit: DataFrame, mean: np.ndarray) -> np.ndarray:
    """R of the centred rows: one triangle per task, then ``FAN_IN`` at a time until one task's worth is left."""
    d = len(mean)

    def reduce(batches):
        upper = np.zeros((0, d))
        for x in _blocks(batches, d):
            upper = bd.stack(upper, x - mean)
        yield pa.RecordBatch.from_pydict({"r": pa.array([upper.tobytes()], pa.binary())})

    def merge(batches):
        upper = np.zeros((0, d))
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                upper = bd.stack(upper, np.frombuffer(raw).reshape(-1, d))
        yield pa.RecordBatch.from_pydict({"r": pa.array([upper.tobytes()], pa.binary())})

    found = written(fit.mapInArrow(reduce, "r binary"), "triangles")
    while (many := found.count()) > FAN_IN:
        groups = -(-many // FAN_IN)
        found = written(found.repartition(groups).mapInArrow(merge, "r binary"), "triangles")
    upper = np.zeros((0, d))
    for row in found.collect():
        upper = bd.stack(upper, np.frombuffer(bytes(row.r)).reshape(-1, d))
    return upper


def _moments(fit: DataFrame, d: int, project) -> tuple[int, np.ndarray]:
    """Rows of the fit list, and the sum over them of the whole numbers or of the products of ``project``'s columns."""
    width = d if project is None else None

    def run(batches):
        n, total = 0, None
        for x in _blocks(batches, d):
            own = x.sum(0) if project is None else (lambda y: y.T @ y)(project(x)).reshape(-1)
            n, total = n + len(x), own if total is None else total + own
        if n:
            yield pa.RecordBatch.from_pydict({"n": np.full(len(total), n), "i": np.arange(len(total)), "s": total})

    kind = "decimal(38,0)" if width else "double"
    sums = fit.mapInArrow(run, f"n long, i long, s {'long' if width else 'double'}").groupBy("i")
    rows = sums.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast(kind)).alias("s")).orderBy("i").collect()
    if not rows:
        return 0, np.zeros(d, object)
    return rows[0].n, np.array([int(r.s) if width else r.s for r in rows], object if width else np.float64)


def _deviation(x: np.ndarray, n: int, total: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None beyond a long."""
    most = max(int(np.abs(x).max(initial=0)) * n, max((abs(int(s)) for s in total), default=0))
    if 4 * most * most * max(x.shape[1], 1) < 1 << 63:
        return ((n * x - total.astype(np.int64)) ** 2).sum(1).tolist()
    own = ((n * x.astype(object) - total) ** 2).sum(1)
    return [int(v) if v < 1 << 63 else None for v in own]


def whiten(rows: DataFrame, id_col: str, vector: str, components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) per usable row and component.

    Components become x = floor(256 c), at most 2**28 in size. Rows whose vector is null,
    of another length than most, or holds a null or a number that isn't finite are left
    out. The fit list is each distinct x vector once: n vectors with sums S. Components are
    the eigenvectors of its covariance by falling eigenvalue, their largest entry positive.
    Those whose eigenvalue is zero to rounding are left out, so constant vectors, or a
    single one, give no rows. ``deviation`` is the exact sum of (n x - S)^2, null beyond a
    long; ``whitened`` the projection of x - S/n over the root of the eigenvalue;
    ``explained`` the eigenvalue's share; ``identity_error`` the largest entry of the
    whitened fit list's covariance minus the identity. Equal rows and ids, null ids too,
    each keep their rows.

    The distinct vectors are written once. Tasks reduce them to triangles of d x d
    values, which are stacked as a tree; the driver solves the last one.
    """
    spark = rows.sparkSession
    good = rows.select(F.col(vector).alias("v"), F.col(id_col).alias("id")).where(vec.usable("v"))
    d = vec.usual_length(good, "v")
    good = good.where(F.size("v") == d)

    def pack(batches):
        for batch in batches:
            x = vec.scaled(batch.column(0), d, SCALE).astype("<i4")
            yield pa.RecordBatch.from_pydict({"x": pa.array([r.tobytes() for r in x], pa.binary())})

    fit = written(good.select("v").mapInArrow(pack, "x binary").distinct(), "distinct")
    n, total = _moments(fit, d, None)
    if not n or not d:
        empty = "component int, n long, deviation long, whitened double, explained double, identity_error double"
        return good.select("id", *[F.lit(None).cast(t).alias(c) for c, t in map(str.split, empty.split(", "))]).where(F.lit(False))
    mean = np.array([int(s) / n for s in total])
    values, axes, sound = bd.principal(_triangles(fit, mean), components)
    axes = axes * np.where(np.take_along_axis(axes, np.abs(axes).argmax(0)[None], 0) < 0, -1, 1)
    share = values**2 / (values**2).sum() if sound else values
    shared = spark.sparkContext.broadcast((mean, axes / (values[:sound] / np.sqrt(n)), total))

    def project(x: np.ndarray) -> np.ndarray:
        mean, weights, _ = shared.value
        return (x - mean) @ weights

    off = 0.0
    if sound:
        _, products = _moments(fit, d, project)
        off = float(np.abs(products.reshape(sound, sound) / n - np.eye(sound)).max())

    def run(batches):
        for batch in batches:
            step = max(1, BLOCK_VALUES // d)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = vec.scaled(part.column(0), d, SCALE)
                y = project(x)
                row = np.repeat(np.arange(len(x)), sound)
                which = np.tile(np.arange(sound), len(x))
                columns = {
                    "id": part.column(1).take(pa.array(row)), "component": pa.array(which + 1, pa.int32()), "n": pa.array(np.full(len(row), n)),
                    "deviation": pa.array(_deviation(x, n, shared.value[2]), pa.int64()).take(pa.array(row)),
                    "whitened": pa.array(y.reshape(-1)), "explained": pa.array(share[which]), "identity_error": pa.array(np.full(len(row), off)),
                }
                yield pa.RecordBatch.from_pydict(columns)

    schema = good.select("id").schema
    for name, kind in (("component", "integer"), ("n", "long"), ("deviation", "long"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")):
        schema = schema.add(name, kind)
    return good.mapInArrow(run, schema)
