"""Writers of address products. All of them write in parallel; where a product
has one folder per key the rows are rebalanced on that key, which lets AQE cut
a large key into several files and pack small ones together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetgrain.functions.text import canonical_url, relative_path
from streetgrain.operators.spatial import tile_key
from streetgrain.schema import ADDRESS_COLUMNS, SOURCE_COLUMN, STATE_TABLE_COLUMNS


# Texts are written as they are: blanks kept, quotes doubled.
CSV_OPTIONS = {
    "header": "true", "escape": '"', "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def write_addresses(df: DataFrame, path: str, form: str = "csv") -> None:
    """The canonical columns, as CSV with header or as Parquet."""
    rows = df.select(*ADDRESS_COLUMNS)
    if form == "csv":
        rows.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    else:
        rows.write.mode("overwrite").format(form).save(path)


# Sources to a partition that Spark may cut by rows.
_SOURCES = 100


def _rebalanced(df: DataFrame, *keys: str | int) -> DataFrame:
    return df.hint("rebalance", *keys)


def _partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _dealt_out(df: DataFrame, *keys: str) -> DataFrame:
    """Rows by key over a fixed number of tasks, which AQE doesn't merge however small they are.

    By a hash of the key: Spark drops a repartition by the key itself after an aggregate by it.
    """
    return df.repartition(_partitions(df), F.xxhash64(*keys))


def write_collections(addresses: DataFrame, licenses: DataFrame, path: str) -> None:
    """Address files per collection, licence class and source, licence texts beside.

    ``addresses``: the address columns, ``collection, license_attr,
    source_base``; ``licenses``: ``collection, license_attr, source_base, text``,
    one row per paragraph. A document is the lines of its folder's files in order.
    """
    keys = ["collection", "license_attr"]
    rows = addresses.select(*keys, F.col("source_base").alias("source"), *_address_columns(addresses))
    (
        _rebalanced(rows, *keys, "source").write.mode("overwrite").partitionBy(*keys)
        .options(**CSV_OPTIONS).csv(f"{path}/addresses")
    )
    _write_documents(licenses, keys, f"{path}/licenses")


def _write_documents(paragraphs: DataFrame, keys: list[str], path: str) -> None:
    """Paragraphs in order of source, cut over files by range, so that a long document takes several."""
    order = [*keys, F.col("source_base").asc_nulls_first(), "text"]
    lines = paragraphs.repartitionByRange(*order).sortWithinPartitions(*order)
    lines.select(*keys, F.col("text").alias("value")).write.mode("overwrite").partitionBy(*keys).text(path)


def write_tiles(addresses: DataFrame, licenses: DataFrame, path: str, folders: tuple[str, ...] = ("tile_lon", "tile_lat")) -> None:
    """Address files per one-degree tile with their source, licence texts beside.

    One folder per tile suits a published index. For a table to be queried,
    ``folders=("tile_lon",)`` keeps the count of folders small; the rows of a
    tile then lie together in their files.
    """
    keys = ["tile_lon", "tile_lat"]
    keyed = addresses.withColumns(tile_key(F.col("lon"), F.col("lat")))
    rows = keyed.select(*keys, *_address_columns(keyed), F.col("source_base").alias(SOURCE_COLUMN))
    (
        _rebalanced(rows, *folders).sortWithinPartitions(*keys).write.mode("overwrite").partitionBy(*folders)
        .options(**CSV_OPTIONS).csv(f"{path}/addresses")
    )
    if len(folders) == len(keys):
        _write_documents(licenses, keys, f"{path}/licenses")
    else:
        licenses.write.mode("overwrite").partitionBy(*folders).parquet(f"{path}/licenses")


def _address_columns(df: DataFrame) -> list[Column]:
    """The canonical columns; parsed points carry the coordinate texts apart."""
    renamed = {"LON": "lon_text", "LAT": "lat_text"} if "lon_text" in df.columns else {}
    return [F.col(renamed.get(c, c)).alias(c) for c in ADDRESS_COLUMNS]


def state_table(runs: DataFrame, host: str) -> DataFrame:
    """Published run table: sixteen text columns sorted by source.

    ``runs``: ``source_path``, ``code_version`` and the state columns.
    """
    urls = ("cache", "sample", "processed", "output")
    columns = []
    for name in STATE_TABLE_COLUMNS:
        key = name.replace(" ", "_").replace("-", "_")
        if name == "source":
            value = relative_path(F.col("source_path"))
        elif name in urls:
            value = canonical_url(F.col(key), host)
        else:
            value = F.col(key)
        columns.append(value.alias(name))
    return runs.select("source_path", *columns).orderBy("source_path").drop("source_path")


def write_state_tsv(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").options(**CSV_OPTIONS).option("sep", "\t").csv(path)


def geojson_lines(df: DataFrame, lon: str = "lon", lat: str = "lat", drop: list[str] = []) -> DataFrame:
    """One point feature per row as JSON text; other columns are properties."""
    others = [c for c in df.columns if c not in (lon, lat, *drop)]
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            F.lit("Point").alias("type"),
            F.array(F.col(lon).cast("double"), F.col(lat).cast("double")).alias("coordinates"),
        ).alias("geometry"),
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("properties"),
    )
    return df.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


def write_geojson_lines(df: DataFrame, path: str, **options) -> None:
    geojson_lines(df, **options).write.mode("overwrite").text(path)


def package_readme(sources: DataFrame) -> DataFrame:
    """README text per source from ``source, website, license, date``."""
    text = F.concat(
        F.lit("Website: "), F.coalesce("website", F.lit("Unknown")),
        F.lit("\nLicense: "), F.coalesce("license", F.lit("Unknown")),
        F.lit("\nDate: "), F.col("date"), F.lit("\n"),
    )
    return sources.select("source", text.alias("text"))


def package_outputs(addresses: DataFrame, sources: DataFrame, path: str) -> None:
    """Address data and a README per source.

    The driver is told of each file. A partition that is cut by rows gives each
    of its sources several files, so there is one for some hundred sources.
    """
    rows = addresses.select("source", *ADDRESS_COLUMNS)
    parts = max(_partitions(rows), -(-sources.count() // _SOURCES))
    (
        _rebalanced(rows, parts, "source").write.mode("overwrite").partitionBy("source")
        .options(**CSV_OPTIONS).csv(f"{path}/data")
    )
    # Small rows, but a file each: dealt out by number, as by size all would go to one task.
    notes = package_readme(sources).select("source", F.col("text").alias("value"))
    _dealt_out(notes, "source").write.mode("overwrite").partitionBy("source").text(f"{path}/readme")
