"""Row filters over address points, runs and published collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetgrain.functions.areas import areas_of
from streetgrain.functions.text import parse_number


def on_earth(df: DataFrame, lon: str = "LON", lat: str = "LAT") -> DataFrame:
    """Rows whose coordinate texts are numbers on the globe.

    NaN is not on the globe. See :func:`parseable_point` for the columns.
    """
    parsed = _parsed(df, lon, lat)
    # One mention per column: the filter moves below the projection, where every
    # mention would parse the text again. NaN compares as greater than any number.
    return parsed.filter((F.abs("lon") <= 180) & (F.abs("lat") <= 90))


def parseable_point(df: DataFrame, lon: str = "LON", lat: str = "LAT") -> DataFrame:
    """Rows whose coordinate texts are numbers, anywhere.

    The texts are renamed to ``lon_text`` / ``lat_text`` and the numbers are
    ``lon`` / ``lat``.
    """
    parsed = _parsed(df, lon, lat)
    return parsed.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())


def _parsed(df: DataFrame, lon: str, lat: str) -> DataFrame:
    taken = {lon.lower(), lat.lower(), "lon", "lat", "lon_text", "lat_text"}
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken],
        F.col(lon).alias("lon_text"),
        F.col(lat).alias("lat_text"),
        parse_number(F.col(lon)).alias("lon"),
        parse_number(F.col(lat)).alias("lat"),
    )


def by_area(df: DataFrame, source_base: str = "source_base") -> DataFrame:
    """One row per source and area it belongs to; a source may be in several.

    Every row is in ``global``.
    """
    return df.withColumn("area", F.explode(areas_of(F.col(source_base))))


def polygon_sources(df: DataFrame, geometry_type: str = "geometry_type") -> DataFrame:
    return df.filter(F.col(geometry_type).contains("Polygon"))


def good_runs(df: DataFrame, processed: Column) -> DataFrame:
    """Runs that have processed output."""
    return df.filter(F.coalesce(processed != "", F.lit(False)))


def collection_nonempty(df: DataFrame, size: str = "content_length") -> DataFrame:
    """Published collections of at least one kilobyte; smaller ones are empty."""
    return df.filter(F.col(size) >= 1024)
