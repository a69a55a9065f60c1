"""Spans found in texts: how they are added to a table, digested, and masked."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as w

PIECE = 4 << 20
# (kind, start, end, whether a base rule found it); places are code points, ends exclusive.
Span = tuple[str, int, int, bool]
Finder = Callable[[list[str], np.ndarray, np.ndarray], list[list[Span]]]
SCHEMA = T.ArrayType(
    T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType()),
    ])
)
ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def add_spans(docs: DataFrame, text_col: str, column: str, find: Finder) -> DataFrame:
    """All columns of ``docs`` and ``column``, the spans of each text by start, then kind as listed.

    Null text is empty and has no spans. Equal rows are judged alike, each for itself.
    """
    if column.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"column exists already: {column}")

    def run(parts):
        for whole in parts:
            for part in w.pieces(whole, text_col, PIECE):
                data, offsets = w.text_bytes(part.column(text_col))
                texts = [t or "" for t in part.column(text_col).to_pylist()]
                found = find(texts, data, offsets)
                count = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                flat = list(zip(*(s for x in found for s in x), strict=True)) or [[], [], [], []]
                values = pa.StructArray.from_arrays(
                    [pa.array(flat[0], pa.string()), pa.array(flat[1], pa.int32()), pa.array(flat[2], pa.int32()), pa.array(flat[3], pa.bool_())],
                    fields=list(ARROW.value_type),
                )
                spans = pa.ListArray.from_arrays(pa.array(count), values)
                yield pa.RecordBatch.from_arrays([*part.columns, spans], [*part.schema.names, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, SCHEMA)]))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["base"])


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def masked(text: Column, spans: Column, mark: str) -> Column:
    """The text with every covered stretch replaced by ``mark``; spans are in order of start."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        # A span that begins before the end of the last one only moves that end.
        apart = (s["start"] > acc["at"]) | (acc["out"] == "")
        before = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.when(apart, F.concat(acc["out"], before, F.lit(mark))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        )

    whole = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
