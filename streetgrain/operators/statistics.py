"""Counts, summaries and texts over runs and sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetgrain.functions.rules import conform_type, coverage_complete, state_value
from streetgrain.functions.text import relative_path, short_name

def run_counts(runs: DataFrame) -> DataFrame:
    """Sources, cached, processed and addresses, in one row.

    ``runs`` has ``cache``, ``processed`` (text) and ``address_count``.
    """
    filled = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    return runs.agg(
        F.count("*").alias("sources"),
        F.count_if(filled("cache")).alias("cached"),
        F.count_if(filled("processed")).alias("processed"),
        F.coalesce(F.sum(F.coalesce(F.col("address_count"), F.lit(0))), F.lit(0)).alias("addresses"),
    )


def batch_timeseries(stats: DataFrame) -> DataFrame:
    """Totals and mean times per batch, over runs that found addresses."""
    return (
        stats.filter(F.col("address_count") > 0)
        .groupBy("tsname")
        .agg(
            F.sum("address_count").alias("addresses"),
            F.count("*").alias("successful_sources"),
            F.avg("cache_time").alias("average_cache_time"),
            F.avg("process_time").alias("average_process_time"),
        )
    )


def in_last_batch(stats: DataFrame) -> DataFrame:
    """Rows of the last batch; last is the greatest batch name as text."""
    return stats.filter(F.col("tsname") == stats.agg(F.max("tsname")).scalar())


def last_batch_distributions(stats: DataFrame) -> DataFrame:
    """Values of three measures in the last batch: ``metric, value, runs``.

    The sorted list of a measure, written as values with their multiplicity.
    """
    last = in_last_batch(stats)
    names = ["address_count", "process_time", "cache_time"]
    pairs = F.array(
        *[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]
    )
    return (
        last.select(F.explode(pairs).alias("p"))
        .select("p.*")
        .filter(F.col("value").isNotNull())
        .groupBy("metric", "value")
        .agg(F.count("*").alias("runs"))
        .orderBy("metric", "value")
    )


def lost_sources(stats: DataFrame) -> DataFrame:
    """Earlier runs, with addresses, of sources without any in the last batch."""
    empty = in_last_batch(stats).filter(F.coalesce(F.col("address_count"), F.lit(0)) == 0)
    history = stats.filter(F.col("address_count") > 0)
    return history.join(empty.select("source"), "source", "left_semi")


def lost_source_stats(stats: DataFrame) -> DataFrame:
    """Most addresses and last good batch of every lost source."""
    return (
        lost_sources(stats)
        .groupBy("source")
        .agg(F.max("address_count").alias("max_addresses"), F.max("tsname").alias("last_good"))
        .orderBy(F.col("max_addresses").desc())
    )


def job_status(files: DataFrame, key: str = "job_id") -> DataFrame:
    """False if any file failed, null while any is pending, else true."""
    failed = F.bool_or(~F.col("status"))
    pending = F.count("*") > F.count("status")
    status = F.when(failed, F.lit(False)).when(~pending, F.lit(True))
    return files.groupBy(key).agg(status.alias("status"))


def queue_depths(items: DataFrame) -> DataFrame:
    """Waiting items per queue."""
    return items.groupBy("queue").agg(F.count("*").alias("depth"))


# --- licences -----------------------------------------------------------------


def _known(column: Column) -> Column:
    return F.coalesce(F.when(column != "", column), F.lit("Unknown"))


def license_block(source: Column, website: Column, license: Column, flag: Column, name: Column) -> Column:
    """Licence paragraph of one source."""
    required = F.coalesce(F.when(name != "", name), F.lit("Yes"))
    attribution = F.when(flag.eqNullSafe("false"), F.lit("No")).otherwise(required)
    return F.concat(
        source, F.lit("\nWebsite: "), _known(website), F.lit("\nLicense: "), _known(license),
        F.lit("\nRequired attribution: "), attribution, F.lit("\n"),
    )


def license_text(sources: DataFrame, keys: list[str], heading: str) -> DataFrame:
    """Licence documents by paragraph: the keys, ``source_base`` and ``text``.

    ``sources``: the keys, ``source_base, website, license, attribution_flag,
    attribution_name``; equal rows give one paragraph. A document is its rows in
    order of ``source_base`` and ``text``, joined by a line end. The heading has
    no source and comes first (nulls first). No row holds more than one source.
    """
    facts = ("source_base", "website", "license", "attribution_flag", "attribution_name")
    rows = sources.select(*keys, *facts).distinct()
    blocks = rows.select(*keys, "source_base", license_block(*[F.col(c) for c in facts]).alias("text"))
    heads = rows.select(*keys).distinct().select(
        *keys, F.lit(None).cast("string").alias("source_base"), F.lit(heading + "\n").alias("text")
    )
    return heads.unionByName(blocks)


def license_groups(runs: DataFrame) -> DataFrame:
    """Sources by licence and required attribution, one row per source.

    ``runs``: ``source, website, license, attribution_required,
    attribution_name``; result ``license, attribution, source, website``.
    """
    required = ~F.col("attribution_required").eqNullSafe("false")
    return runs.select(
        "license", F.when(required, F.col("attribution_name")).alias("attribution"), "source", "website"
    ).distinct()


def collections_index(zips: DataFrame) -> DataFrame:
    """Current collections with their licence variants as a map.

    ``zips``: ``collection, license_attr, url, content_length, is_current``. A
    collection has two licence variants at most, so its map is small.
    """
    from streetgrain.schema import LICENSE_CLASSES

    names = F.create_map(*[F.lit(x) for item in LICENSE_CLASSES.items() for x in item])
    variants = (
        zips.filter(F.col("is_current") & (F.col("content_length") >= 1024))
        .groupBy("collection", "license_attr")
        .agg(F.max(F.struct("url", "content_length")).alias("z"))
    )
    value = F.struct(
        F.col("z.url").alias("url"), F.col("z.content_length").alias("content_length"),
        F.try_element_at(names, F.col("license_attr")).alias("license"),
    )
    return variants.groupBy("collection").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("license_attr", value.alias("v"))))).alias("licenses")
    )


# --- summaries of runs -----------------------------------------------------------


def summarize_runs(runs: DataFrame, url_prefix: str) -> DataFrame:
    """Twenty-one columns about every run and its source definition.

    ``source_data`` is the base64 text of the definition; anything unreadable
    counts as an empty definition.
    """
    value = lambda key: state_value(F.col("state"), key)
    definition = F.try_validate_utf8(F.try_to_binary(F.col("source_data"), F.lit("base64")).cast("string"))
    rows = runs.withColumn("_def", F.coalesce(definition, F.lit("{}")))
    truthy = lambda key: F.coalesce(
        ~F.get_json_object("_def", f"$.{key}").isin("", "false", "0", "{}", "[]", "null"), F.lit(False)
    )
    return rows.select(
        value("address count").alias("address count"),
        value("cache").alias("cache"),
        value("cache time").alias("cache time"),
        F.date_format("datetime_tz", "yyyy-MM-dd").alias("cache_date"),
        truthy("conform").alias("conform"),
        conform_type(value("cache"), value("geometry type")).alias("conform type"),
        coverage_complete(F.col("_def")).alias("coverage complete"),
        value("fingerprint").alias("fingerprint"),
        value("geometry type").alias("geometry type"),
        F.concat(F.lit(url_prefix + "blob/"), F.coalesce("commit_sha", F.lit("")), F.lit("/"), F.col("source_path")).alias("href"),
        value("output").alias("output"),
        value("process time").alias("process time"),
        value("processed").alias("processed"),
        value("sample").alias("sample"),
        F.col("id").alias("run_id"),
        short_name(F.col("source_path")).alias("shortname"),
        truthy("skip").alias("skip"),
        relative_path(F.col("source_path")).alias("source"),
        F.lower(F.coalesce(F.get_json_object("_def", "$.type"), F.lit(""))).alias("type"),
        value("version").alias("version"),
        value("source problem").alias("source problem"),
    )
