"""Places of rows in a global order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streetgrain.session import written


def with_place(ordered: DataFrame, name: str = "place") -> DataFrame:
    """Adds the place, from 1 on, of each row of an ordered DataFrame.

    A global sort leaves its rows cut by range, the partitions in order. Rows are
    written with their partition and their place in it; the rows before a partition
    are the sum of the sizes before, one number per partition. Equal rows get
    different places.
    """
    partition, row = f"{name}_partition", f"{name}_row"
    # The id counts on within a partition and holds its number above the lowest 33 bits.
    number = F.monotonically_increasing_id()
    kept = written(ordered.withColumn(row, number), "ordered")
    kept = kept.withColumn(partition, F.shiftright(row, 33)).withColumn(row, F.col(row).bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = kept.groupBy(partition).agg(F.count("*").alias("n"))
    before = Window.orderBy(partition).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(partition, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return kept.join(starts, partition).withColumn(name, F.col("start") + F.col(row) + 1).drop(partition, row, "start")


def span_of_places(ordered: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: its first and last place and its number of rows; ``last - first + 1`` equals it if equal keys lie together."""
    return with_place(ordered).groupBy(*keys).agg(
        F.min("place").alias("first_place"), F.max("place").alias("last_place"), F.count("*").alias("n")
    )
