"""Vectors as whole numbers in Arrow batches, shared by the embedding operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Beyond this a component counts as this; sums of squares over any usual length stay exact.
MOST = 1 << 28


def usable(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    whole = F.forall(vector, finite)
    return F.coalesce(whole, F.lit(False))


def usual_length(rows: DataFrame, vector: str) -> int:
    """The length that most vectors have, the longer one on ties; 0 without vectors."""
    top = rows.groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return top.d if top else 0


def scaled(column: pa.Array, d: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, a row per vector of length ``d``."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), d)
    return np.clip(np.floor(flat * scale), -MOST, MOST).astype(np.int64)
