"""One source from definition to address table, and tests inside definitions."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streetgrain.functions import conform as C
from streetgrain.functions.projection import projection_for, reproject
from streetgrain.functions.text import parse_number
from streetgrain.operators.spatial import polygon_filter
from streetgrain.schema import ADDRESS_COLUMNS, GEOM_COLUMN, X_COLUMN, Y_COLUMN
from streetgrain.sources import readers


def _named(df: DataFrame, name: str) -> str | None:
    for candidate in (name, name.upper()):
        if candidate in df.columns:
            return candidate
    return None


def extract_and_reproject(df: DataFrame, conform: dict, protocol: str | None = None) -> DataFrame:
    """Source rows with coordinates in ``OA:x`` / ``OA:y`` as text.

    A CSV source names its coordinate columns, exactly or in upper case; they
    are dropped. Feature service sources carry the reserved columns already.
    Decimal commas become points. With a reference system the result has seven
    decimals, and an unreadable number gives the empty text.
    """
    if conform.get("format") != "csv" or protocol == "ESRI":
        lon, lat = X_COLUMN, Y_COLUMN
        dropped = {lon, lat}
    else:
        lon, lat = conform["lon"], conform["lat"]
        dropped = {lon, lon.upper(), lat, lat.upper()}
    lon, lat = _named(df, lon), _named(df, lat)
    if lon is None or lat is None:
        raise C.ConformError("the coordinate columns are not in the source")
    others = [F.col(f"`{c}`") for c in df.columns if c not in dropped]
    none = F.lit(None).cast("string")
    pointed = lambda c, other: F.when(
        F.col(f"`{other}`").isNotNull(), F.replace(F.col(f"`{c}`"), F.lit(","), F.lit("."))
    )
    rows = df.select(*others, pointed(lon, lat).alias(X_COLUMN), pointed(lat, lon).alias(Y_COLUMN))
    if "srs" not in conform:
        return rows
    projection_for(conform["srs"])
    names = [c for c in rows.columns if c not in (X_COLUMN, Y_COLUMN)]
    kept = [F.col(f"`{c}`") for c in names]
    staged = rows.select(
        *kept, F.col(f"`{X_COLUMN}`").isNull().alias("_null"),
        parse_number(F.col(f"`{X_COLUMN}`")).alias("_x"), parse_number(F.col(f"`{Y_COLUMN}`")).alias("_y"),
    )
    out_x, out_y = reproject(F.col("_x"), F.col("_y"), conform["srs"])
    text = lambda v: (
        F.when(F.col("_null"), none)
        .when(F.col("_x").isNull() | F.col("_y").isNull(), F.lit(""))
        .otherwise(F.format_string("%.7f", v))
    )
    return staged.select(*kept, text(out_x).alias(X_COLUMN), text(out_y).alias(Y_COLUMN))


def read_source(spark: SparkSession, path: str, definition: dict) -> DataFrame:
    """Source table of a definition, by its declared format."""
    conform, protocol = definition["conform"], definition.get("protocol")
    form = conform.get("format")
    if form == "csv" or (form == "geojson" and protocol == "ESRI"):
        return readers.read_source_csv(
            spark, path, delimiter=conform.get("csvsplit", ","), encoding=conform.get("encoding", "utf-8"),
            headers=conform.get("headers"), skiplines=conform.get("skiplines"),
        )
    if form == "geojson":
        return readers.read_geojson(spark, path)
    if form == "xml":
        return readers.read_xml_features(
            spark, path, conform["row_tag"], C.required_fields(conform), conform["coordinates"]
        )
    raise C.ConformError(f"unsupported source format {form!r}")


@dataclass
class Processed:
    """Address table of one source and where each figure of its state comes from."""

    addresses: DataFrame
    problem: str | None = None

    def summary(self) -> DataFrame:
        """Rows, rows with errors and rows with coordinates, in one row."""
        located = F.col("LON").isNotNull() & (F.col("LON") != "")
        return self.addresses.agg(
            F.count("*").alias("address_count"),
            F.count("_error").alias("errors"),
            F.count_if(located).alias("located"),
        )


def primary_layer(definition: dict) -> dict:
    """The first address layer; a flat definition is its own layer."""
    if definition.get("schema") is None and definition.get("layers") is None:
        return {"name": "primary", **{k: v for k, v in definition.items() if k != "coverage"}}
    layers = definition["layers"].get("addresses")
    if not layers:
        raise C.ConformError("no address layer in the definition")
    return layers[0]


def process_source(
    spark: SparkSession, definition: dict, path: str, fingerprint: str, fail_on_error: bool = False
) -> Processed:
    """Read, extract and conform one source as a single job without a shuffle.

    A source that asks to be skipped or fails its own tests gives an empty
    address table and names the problem.
    """
    source = primary_layer(definition)
    empty = lambda: spark.createDataFrame([], ", ".join(f"{c} string" for c in [*ADDRESS_COLUMNS, "_error"]))
    if source.get("skip"):
        return Processed(empty(), "Source says to skip")
    if "conform" not in source:
        return Processed(empty(), "Source is missing a conform object")
    passed, _ = check_acceptance_tests(spark, source)
    if passed is False:
        return Processed(empty(), "An acceptance test failed")
    rows = read_source(spark, path, source)
    extracted = extract_and_reproject(rows, source["conform"], source.get("protocol"))
    return Processed(C.conform(extracted, source["conform"], fingerprint, fail_on_error=fail_on_error))


# --- acceptance tests --------------------------------------------------------------


def acceptance_results(spark: SparkSession, source: dict) -> DataFrame | None:
    """Mismatching expectations of the tests in a definition; None without tests.

    Rows are ``index, description, name, expected, actual``.
    """
    tests = source.get("test", {}).get("acceptance-tests")
    if not source.get("test", {}).get("enabled", True) or not tests:
        return None
    given = {k for t in tests for k in t["inputs"]}
    have = {k.lower() for k in given}
    names = sorted(given | {f for f in C.required_fields(source["conform"]) if f.lower() not in have})
    schema = "index int, description string, inputs map<string,string>, expected map<string,string>"
    rows = spark.createDataFrame(
        [(i, t.get("description", f"test {i}"), t["inputs"], t["expected"]) for i, t in enumerate(tests)], schema
    )
    inputs = rows.select(
        "index", "description", "expected", *[F.try_element_at("inputs", F.lit(n)).alias(n) for n in names]
    )
    keep = ["index", "description", "expected"]
    made = C.conform(inputs, source["conform"], "test", keep=keep)
    actual = F.create_map(*[x for c in ADDRESS_COLUMNS for x in (F.lit(c.lower()), F.col(c))])
    pairs = F.explode("expected").alias("name", "wanted")
    checked = made.withColumn("_actual", actual).select("index", "description", "_actual", pairs)
    got = F.try_element_at("_actual", F.lower("name"))
    return checked.select(
        "index", "description", "name", F.col("wanted").alias("expected"), got.alias("actual")
    ).filter(~F.col("expected").eqNullSafe(F.col("actual")))


def check_acceptance_tests(spark: SparkSession, source: dict) -> tuple[bool | None, str | None]:
    """Whether a definition passes its tests, and the first mismatch.

    ``(None, None)`` without enabled tests. Tests are a few literal rows of one
    definition, so the answer is read on the driver.
    """
    results = acceptance_results(spark, source)
    if results is None:
        return None, None
    first = results.orderBy("index", "name").limit(1).collect()
    if not first:
        return True, None
    r = first[0]
    expected, actual = (json.dumps({r.name: v}, ensure_ascii=False) for v in (r.expected, r.actual))
    return False, f"For {r.description}, expected {expected} but got {actual}"


def check_tests_of_sources(tests: DataFrame, spec: dict) -> DataFrame:
    """Acceptance tests of many sources that share one specification.

    ``tests``: ``source, index, description, inputs, expected`` with the last
    two as maps. Result: ``source, passed, message`` of the first mismatch.
    """
    names = C.required_fields(spec)
    inputs = tests.select(
        "source", "index", "description", "expected",
        *[F.try_element_at("inputs", F.lit(n)).alias(n) for n in [*names, X_COLUMN, Y_COLUMN]],
    )
    keep = ["source", "index", "description", "expected"]
    made = C.conform(inputs, spec, "test", keep=keep)
    actual = F.create_map(*[x for c in ADDRESS_COLUMNS for x in (F.lit(c), F.col(c))])
    got = made.withColumn("_actual", actual)
    wrong = F.filter(
        F.map_entries("expected"),
        lambda e: ~e["value"].eqNullSafe(F.try_element_at(F.col("_actual"), e["key"])),
    )
    shown = lambda value: F.coalesce(value, F.lit("null"))
    message = F.when(
        F.size(wrong) > 0,
        F.concat(
            F.lit("For "), F.col("description"), F.lit(", expected "), wrong[0]["key"], F.lit(" = "),
            shown(wrong[0]["value"]), F.lit(" but got "), shown(F.try_element_at(F.col("_actual"), wrong[0]["key"])),
        ),
    )
    return (
        got.select("source", "index", message.alias("message"))
        .groupBy("source")
        .agg(F.min_by("message", F.when(F.col("message").isNotNull(), F.col("index"))).alias("message"),
             F.count("message").alias("_bad"))
        .select("source", (F.col("_bad") == 0).alias("passed"),
                F.when(F.col("_bad") > 0, F.col("message")).alias("message"))
    )


# --- parcels -------------------------------------------------------------------------


def parcel_table(rows: DataFrame, spec: dict, fingerprint: str | Column) -> DataFrame:
    """Address columns and polygon text of parcels, from one pass over the rows.

    Only single polygons count as parcels; missing attributes read as empty.
    """
    others = [c for c in rows.columns if c != GEOM_COLUMN]
    filled = rows.select(
        *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in others],
        F.col(f"`{GEOM_COLUMN}`").alias("geom"),
    )
    return C.conform(polygon_filter(filled, "geom"), spec, fingerprint, keep=["geom"])
