"""Whole-dataset products: collections, tile index, dot map, coverage,
dashboards, coverage features, map extents and batch plans.

Addresses come as one table with a ``source_base`` column. Facts about sources
(share-alike, licence texts) are joined on it; that side has one row per
source, and Catalyst broadcasts it only when it measures small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetgrain.functions import geo
from streetgrain.functions.areas import guess_country, guess_state
from streetgrain.functions.licenses import license_class
from streetgrain.functions.rules import state_value
from streetgrain.functions.text import short_name
from streetgrain.operators import coverage as cov
from streetgrain.operators import overlay
from streetgrain.operators import runs as ledger
from streetgrain.operators import spatial, statistics
from streetgrain.operators.filters import by_area, good_runs, on_earth, parseable_point
from streetgrain.session import written


def source_facts(latest: DataFrame) -> DataFrame:
    """One row per processed source of the latest runs, with licence facts."""
    value = lambda key: state_value(F.col("state"), key)
    return good_runs(latest, value("processed")).select(
        short_name(F.col("source_path")).alias("source_base"),
        value("share-alike").alias("share_alike"),
        value("website").alias("website"),
        value("license").alias("license"),
        value("attribution flag").alias("attribution_flag"),
        value("attribution name").alias("attribution_name"),
    )


def with_collections(facts: DataFrame) -> DataFrame:
    """Sources by collection: every area they are in, and their licence class."""
    placed = by_area(facts).withColumnRenamed("area", "collection")
    return placed.withColumn("license_attr", license_class(F.col("share_alike")))


def collect_extracts(addresses: DataFrame, facts: DataFrame, lon: str = "LON", lat: str = "LAT") -> dict[str, DataFrame]:
    """Members of all published collections.

    ``addresses``: points on earth with collection and licence class, one row
    per collection they are in; ``summary``: their grid counts per source;
    ``licenses``: licence documents.
    """
    sources = with_collections(facts)
    located = on_earth(addresses, lon, lat)
    names = sources.select("source_base", "collection", "license_attr")
    # Counts do not depend on the collection: count once, then attach.
    summary = spatial.grid_summary(located, ["source_base"], ordered=False).join(names, "source_base")
    return {
        "addresses": located.join(names, "source_base"),
        "summary": summary,
        "licenses": statistics.license_text(sources, ["collection", "license_attr"], "Data collected from public sources."),
    }


def collection_counts(addresses: DataFrame, facts: DataFrame, lon: str = "LON", lat: str = "LAT") -> DataFrame:
    """Sources and addresses per collection and licence class.

    Addresses are counted per source before they meet the collections, so the
    fan-out happens on one row per source.
    """
    counts = on_earth(addresses, lon, lat).groupBy("source_base").agg(F.count("*").alias("n"))
    return (
        with_collections(facts).join(counts, "source_base")
        .groupBy("collection", "license_attr")
        .agg(F.count("*").alias("sources"), F.sum("n").alias("addresses"))
    )


def index_tiles(addresses: DataFrame, facts: DataFrame, lon: str = "LON", lat: str = "LAT") -> dict[str, DataFrame]:
    """Members of the tile index: points, counts and licence documents per tile."""
    free = facts.filter(~F.col("share_alike").eqNullSafe("true"))
    others = [c for c in addresses.columns if c not in facts.columns or c == "source_base"]
    points = on_earth(addresses.select(*others), lon, lat).join(free, "source_base")
    # The documents need the sources of a tile only: counts first, then the facts of the free sources.
    bare = on_earth(addresses.select("source_base", lon, lat), lon, lat).withColumn("share_alike", F.lit(None).cast("string"))
    per_source = spatial.tile_source_counts(bare)
    return {
        "addresses": points,
        "index": spatial.tile_index(points),
        "licenses": statistics.license_text(
            per_source.join(free, "source_base"), ["tile_lon", "tile_lat"], "Data collected from public sources."
        ),
    }


def dot_map(addresses: DataFrame, key: Column, lon: str = "LON", lat: str = "LAT", base: int = 15) -> DataFrame:
    """Dots per web tile, zoom and world quadrant.

    Full counts at the base zoom; below it one point in two per zoom step.
    Coordinates off the globe are clamped to the border tiles.
    """
    points = parseable_point(addresses.withColumn("_key", key), lon, lat)
    drawn = spatial.drop_rate_thinning(points, F.col("_key"), rate=2, base=base)
    z = F.col("zoom").cast("double")
    x, y = geo.mercator_x(F.col("lon")), geo.tile_y(F.col("lat"))
    side = F.pow(F.lit(2.0), z) - 1
    clamp = lambda c: F.least(F.greatest(c.cast("double"), F.lit(0.0)), side).cast("bigint")
    tiles = (
        drawn.filter(~F.isnan("lon") & ~F.isnan("lat"))
        .groupBy("zoom", clamp(geo.tile_column(x, z)).alias("col"), clamp(geo.tile_row(y, z)).alias("_row"))
        .agg(F.count("*").alias("points"))
    )
    flipped = tiles.withColumn("row", geo.flip_tile_row(F.col("_row"), z)).drop("_row")
    return spatial.quadrant_split(flipped)


def calculate_coverage(features: DataFrame, shapes: DataFrame, box_statistics: DataFrame, boxes: DataFrame, code: str) -> DataFrame:
    """Address count, covered area and population per country or state.

    ``features``: code, ``count`` and the ``rings`` a source covers (see
    :func:`feature_codes`); ``shapes``: code, ``name`` and ``rings`` of the
    land. The share of a box's land that the union of the features covers weighs
    its statistics. A code without features has no share, one without land or
    statistics only its count.
    """
    per_box = overlay.shared_area(shapes, features, code)
    seen = features.select(code).distinct().withColumn("_seen", F.lit(True))
    share = F.when(F.col("_seen"), F.col("covered_area") / F.col("land_area")).alias("fraction")
    per_box = per_box.join(seen, code, "left").select(code, "lon", "lat", F.lit(1.0).alias("size"), share)
    placed = cov.assign_box_id(per_box, boxes).join(shapes.groupBy(code).agg(F.min("name").alias("name")), code)
    weighed = placed.join(box_statistics, [code, "box_id"])
    summary = cov.with_band(cov.coverage_summary(weighed, code))
    return summary.join(cov.area_address_counts(features, code), code, "full")


def feature_codes(features: DataFrame) -> DataFrame:
    """Coverage features with country and state codes and their area.

    ``features``: ``iso, iso_sub, geoid, source_paths, count, kind, lon, lat,
    rings``. Points stand for a disc of ten kilometres, polygons and
    multi-polygons for the area that an odd number of their rings encloses. Other
    kinds count with their addresses and cover nothing.
    """
    country = guess_country(F.col("iso"), F.col("iso_sub"), F.col("geoid"), F.col("source_paths"))
    state = guess_state(F.col("geoid"), F.col("source_paths"))
    disc = geo.buffer_point(F.col("lon"), F.col("lat"), 10000.0)
    area = F.when(F.col("kind") == "Point", disc).when(F.col("kind").isin("Polygon", "MultiPolygon"), F.col("rings")).otherwise(F.slice("rings", 1, 0))
    coded = features.select(
        country.alias("iso_a2"), state.alias("_state"), "count", area.alias("rings")
    )
    return coded.withColumn("usps_code", F.when(F.col("iso_a2") == "US", F.col("_state"))).drop("_state")


def dashboard(runs: DataFrame, sets: DataFrame) -> dict[str, DataFrame]:
    """Tables of the dashboard.

    The ledger with its state documents is read once: the few statistics columns
    are written to the shared folder, and all tables start from there.
    """
    columns = ["tsname", "source", "address_count", "cache_time", "process_time"]
    stats = written(ledger.dashboard_stats(runs, sets).select(*columns), "dashboard-stats")
    return {
        "timeseries": statistics.batch_timeseries(stats),
        "last_distributions": statistics.last_batch_distributions(stats),
        "lost_sources": statistics.lost_source_stats(stats),
    }


def dashboard_rows(runs: DataFrame, sets: DataFrame) -> DataFrame:
    """The dashboard as one long table: ``section, name, measure, value``."""
    tables = dashboard(runs, sets)
    series = tables["timeseries"].select(
        F.lit("timeseries").alias("section"), F.col("tsname").alias("name"),
        F.posexplode(F.array(*[F.col(c).cast("double") for c in (
            "addresses", "successful_sources", "average_cache_time", "average_process_time")])).alias("i", "value"),
    )
    names = F.array(*[F.lit(c) for c in ("addresses", "successful_sources", "average_cache_time", "average_process_time")])
    series = series.select("section", "name", names[F.col("i")].alias("measure"), "value")
    spread = tables["last_distributions"].select(
        F.lit("last_batch").alias("section"), F.col("metric").alias("name"),
        F.col("value").cast("decimal(20,6)").cast("string").alias("measure"), F.col("runs").cast("double").alias("value"),
    )
    lost = tables["lost_sources"].select(
        F.lit("lost_sources").alias("section"), F.col("source").alias("name"),
        F.col("last_good").alias("measure"), F.col("max_addresses").cast("double").alias("value"),
    )
    return series.unionByName(spread).unionByName(lost)


def coverage_geojson(geographies: DataFrame, sources: DataFrame, geometry: str = "geometry") -> dict[str, DataFrame]:
    """Coverage features as GeoJSON lines, and the sources of each.

    ``geographies``: ``code, name, code_kind`` and a geometry as JSON text.
    ``features`` has one line per geography with the counts; ``sources`` has one
    row per geography and source, so no line grows with the sources.
    """
    attached = cov.attach_coverage_status(geographies.select("code", "name"), sources)
    features = cov.coverage_features(attached)
    joined = features.join(geographies.select("code", "code_kind", F.col(geometry).alias("_g")), "code")
    quoted = lambda c: F.coalesce(F.to_json(F.struct(c.alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(c.alias("v")))) - 6), F.lit("null"))
    properties = F.concat(
        F.lit('{"name":'), quoted(F.col("name")), F.lit(',"status":"'), F.col("status"),
        F.lit('","source count":'), F.col("source_count").cast("string"),
        F.lit(',"address count":'), F.col("address_count").cast("string"),
        F.lit(',"'), F.col("code_kind"), F.lit('":'), quoted(F.col("code")), F.lit("}"),
    )
    line = F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), F.col("_g"), F.lit("}"))
    return {"features": joined.select("code", line.alias("value")), "sources": cov.coverage_paths(attached)}


def preview_extent(addresses: DataFrame, keys: list[str], lon: str = "LON", lat: str = "LAT",
                   width: int = 668, resolution: float = 1.0) -> DataFrame:
    """Map extent, drawing scale and zoom of every source."""
    points = on_earth(addresses, lon, lat)
    projected = points.select(
        *keys, geo.mercator_x(F.col("lon")).alias("x"), geo.mercator_y(F.col("lat")).alias("y")
    ).filter(F.col("y").isNotNull())
    bounds = spatial.robust_bounds(projected, keys)
    scale = F.try_divide(F.lit(float(width * resolution)), F.col("xmax") - F.col("xmin"))
    return bounds.withColumn("scale", scale).withColumn("zoom", geo.zoom_for_scale(F.col("scale"), resolution))


def batch_plan(expected: DataFrame, runs: DataFrame, sets: DataFrame, set_id: int) -> DataFrame:
    """Expected sources in working order, with run time and reusable result.

    ``expected``: ``source_path, source_id, ts_us``.
    """
    latest = ledger.latest_runs_to_date(runs, sets, set_id)
    times = latest.select(
        "source_path",
        ledger.run_time_text(
            state_value(F.col("state"), "cache time"), state_value(F.col("state"), "process time")
        ).alias("run_time"),
    )
    requests = expected.select(F.col("source_path").alias("request_id"), "source_id", "ts_us")
    reused = ledger.reuse_previous_run(requests, runs).withColumnRenamed("request_id", "source_path")
    planned = expected.select("source_path").join(times, "source_path", "left").join(reused, "source_path", "left")
    return ledger.batch_order(planned, path="source_path")
