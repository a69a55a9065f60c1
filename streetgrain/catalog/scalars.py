"""Check queries: single-row columns about runs, sizes, ages and places."""

from pyspark.sql import functions as F

from streetgrain.catalog.base import query
from streetgrain.catalog.ledger import STATS, js, seconds_sql, stats
from streetgrain.catalog.views import ledger_sql, runs, table
from streetgrain.functions import areas, rules, text
from streetgrain.functions.rules import state_value
from streetgrain.operators import runs as ledger
from streetgrain.operators import statistics
from streetgrain.schema import RUN_STATE_KEYS, state_column


def value(key: str):
    return state_value(F.col("state"), key)


def number(column):
    """Double with a fixed count of decimals, equal in both engines."""
    return F.round(column, 6)


CONFORM_TYPE = (
    f"CASE WHEN {js('cache')} LIKE '%.zip' THEN CASE WHEN {js('geometry type')} IN ('Polygon', 'MultiPolygon') THEN 'shapefile-polygon' ELSE 'shapefile' END "
    f"WHEN {js('cache')} LIKE '%.json' THEN 'geojson' WHEN {js('cache')} LIKE '%.csv' THEN 'csv' END"
)
SHORT = "substr(source_path, 9, length(source_path) - 13)"


@query("F01_conform_type", ledger_sql(f"SELECT id, {CONFORM_TYPE} AS conform_type FROM runs"))
def _(spark, sf_dir):
    return runs(spark, sf_dir).select("id", rules.conform_type(value("cache"), value("geometry type")).alias("conform_type"))


@query("F02_short_name", ledger_sql(f"SELECT id, {SHORT} AS short_name FROM runs"))
def _(spark, sf_dir):
    return runs(spark, sf_dir).select("id", text.short_name(F.col("source_path")).alias("short_name"))


DEFINITION = (
    "concat('{\"type\": \"HTTP\", \"conform\": {\"format\": \"csv\"}, \"skip\": ', CASE WHEN id % 4 = 0 THEN 'true' ELSE 'false' END, "
    "CASE WHEN id % 3 = 0 THEN ', \"coverage\": {\"US Census\": {}}' ELSE '' END, '}')"
)


@query(
    "F03_summarize_run",
    ledger_sql(
        f", d AS (SELECT *, id % 11 <> 0 AS readable FROM runs) SELECT {js('address count')} AS \"address count\", {js('cache')} AS cache, {js('cache time')} AS \"cache time\", "
        f"strftime(make_timestamp(ts_us), '%Y-%m-%d') AS cache_date, readable AS conform, {CONFORM_TYPE} AS \"conform type\", "
        f"readable AND id % 3 = 0 AS \"coverage complete\", {js('fingerprint')} AS fingerprint, {js('geometry type')} AS \"geometry type\", "
        f"'https://code.example.org/blob/' || code_version || '/' || source_path AS href, {js('output')} AS output, {js('process time')} AS \"process time\", "
        f"{js('processed')} AS processed, {js('sample')} AS sample, id AS run_id, {SHORT} AS shortname, readable AND id % 4 = 0 AS skip, "
        f"substr(source_path, 9) AS source, CASE WHEN readable THEN 'http' ELSE '' END AS type, {js('version')} AS version, {js('source problem')} AS \"source problem\" FROM d"
    ),
)
def _(spark, sf_dir):
    encoded = F.when(F.col("id") % 11 == 0, F.lit("%%%")).otherwise(F.base64(F.expr(DEFINITION).cast("binary")))
    rows = runs(spark, sf_dir).withColumn("source_data", encoded).withColumn("commit_sha", F.col("code_version"))
    return statistics.summarize_runs(rows, "https://code.example.org/")


@query(
    "F04_duration_seconds",
    ledger_sql(f"SELECT id, round({seconds_sql(js('process time'))}, 6) AS seconds FROM runs"),
)
def _(spark, sf_dir):
    return runs(spark, sf_dir).select("id", number(text.duration_seconds(value("process time"))).alias("seconds"))


@query(
    "F05_epoch_text",
    ledger_sql("SELECT id, printf('%d.%03d', (ts_us + 500) // 1000000, ((ts_us + 500) // 1000) % 1000) AS ts FROM runs"),
)
def _(spark, sf_dir):
    return runs(spark, sf_dir).select("id", text.epoch_text(F.col("datetime_tz")).alias("ts"))


PLACE = {
    "id": "o_orderkey",
    "iso": "CASE WHEN o_orderkey % 4 = 0 THEN 'FR' ELSE '' END",
    "iso_sub": "CASE WHEN o_orderkey % 4 = 1 THEN 'DE-BE' END",
    "geoid": "CASE WHEN o_custkey % 3 = 0 THEN concat(lpad(CAST(o_custkey % 60 AS STRING), 2, '0'), '001') ELSE '' END",
    "paths": "CASE o_custkey % 3 WHEN 1 THEN 'sources/us/ca/x.json, sources/b.json' WHEN 2 THEN 'sources/jp/tokyo.json' END",
}
PLACES = "p AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in PLACE.items()) + " FROM orders)"


def places(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in PLACE.items()])


@query(
    "F06_guess_country",
    f"WITH {PLACES} SELECT id, CASE WHEN iso <> '' THEN iso WHEN iso_sub <> '' THEN 'DE' WHEN geoid <> '' THEN 'US' "
    "ELSE upper(split_part(paths, '/', 2)) END AS country FROM p",
)
def _(spark, sf_dir):
    made = areas.guess_country(F.col("iso"), F.col("iso_sub"), F.col("geoid"), F.col("paths"))
    return places(spark, sf_dir).select("id", made.alias("country"))


STATE_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in areas.STATE_ABBREVIATIONS.items())


@query(
    "F07_guess_state",
    f"WITH {PLACES}, st(fips, abbr) AS (VALUES {STATE_VALUES}) SELECT id, CASE WHEN geoid <> '' THEN abbr "
    "WHEN paths LIKE 'sources/us/%' THEN upper(split_part(paths, '/', 3)) END AS state FROM p LEFT JOIN st ON fips = substr(geoid, 1, 2)",
)
def _(spark, sf_dir):
    return places(spark, sf_dir).select("id", areas.guess_state(F.col("geoid"), F.col("paths")).alias("state"))


@query(
    "J10_state_abbrev_lookup",
    f"WITH {PLACES}, st(fips, abbr) AS (VALUES {STATE_VALUES}) SELECT abbr, count(*) AS places FROM p JOIN st ON fips = substr(geoid, 1, 2) GROUP BY 1",
)
def _(spark, sf_dir):
    code = areas.state_abbreviation(F.substring("geoid", 1, 2))
    found = places(spark, sf_dir).select(code.alias("abbr")).filter(F.col("abbr").isNotNull())
    return found.groupBy("abbr").agg(F.count("*").alias("places"))


@query(
    "F08_coverage_band",
    "SELECT o_orderkey AS id, CASE WHEN o_totalprice / 500000 > 0.98 THEN 'best' WHEN o_totalprice / 500000 > 0.15 THEN 'okay' ELSE 'empty' END AS band FROM orders",
)
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), areas.coverage_band(F.col("o_totalprice") / 500000).alias("band")
    )


@query("F09_nice_integer", "SELECT l_orderkey AS k, l_linenumber AS n, format('{:,}', l_orderkey * l_partkey * 7) AS nice FROM lineitem")
def _(spark, sf_dir):
    product = F.col("l_orderkey") * F.col("l_partkey") * 7
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), text.nice_integer(product).alias("nice")
    )


SIZE = "l_orderkey * l_partkey * CASE l_linenumber WHEN 1 THEN 1 WHEN 2 THEN 1000 WHEN 3 THEN 100000 ELSE 7 END"


@query(
    "F10_nice_size",
    f"WITH s AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, CAST({SIZE} AS DOUBLE) AS b FROM lineitem), "
    "u AS (SELECT *, CASE WHEN b < 1024 THEN b WHEN b < 1048576 THEN b / 1024 WHEN b < 1073741824 THEN b / 1048576 WHEN b < 1099511627776 THEN b / 1073741824 ELSE b / 1099511627776 END AS v, "
    "CASE WHEN b < 1024 THEN 'B' WHEN b < 1048576 THEN 'KB' WHEN b < 1073741824 THEN 'MB' WHEN b < 1099511627776 THEN 'GB' ELSE 'TB' END AS t FROM s) "
    "SELECT k, n, p, CASE WHEN v < 10 THEN printf('%.1f', v) ELSE printf('%.0f', v) END || t AS nice FROM u",
)
def _(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"),
        text.nice_size(F.expr(SIZE)).alias("nice"),
    )


@query(
    "F11_nice_age",
    ledger_sql(
        ", a AS (SELECT id, ts_us, CAST(floor(id * id / CAST(7 AS DOUBLE)) AS BIGINT) % 20000000 AS s FROM runs) SELECT id, CASE WHEN s // 86400 > 90 THEN strftime(make_timestamp(ts_us - s * 1000000), '%b %d, %Y') "
        "WHEN s // 86400 > 12 THEN printf('%.0f', s / CAST(604800 AS DOUBLE)) || ' weeks ago' WHEN s > 129600 THEN printf('%.0f', s / CAST(86400 AS DOUBLE)) || ' days ago' "
        "WHEN s > 5400 THEN printf('%.0f', s / CAST(3600 AS DOUBLE)) || ' hours ago' WHEN s > 90 THEN printf('%.0f', s / CAST(60 AS DOUBLE)) || ' minutes ago' "
        "ELSE printf('%.0f', CAST(s AS DOUBLE)) || ' seconds ago' END AS age FROM a"
    ),
)
def _(spark, sf_dir):
    seconds = F.floor(F.col("id") * F.col("id") / 7).cast("bigint") % 20000000
    return runs(spark, sf_dir).select("id", text.nice_age(seconds, F.col("datetime_tz")).alias("age"))


@query(
    "F12_state_columns",
    ledger_sql(f"SELECT id, " + ", ".join(f"{js(k)} AS {state_column(k)}" for k in RUN_STATE_KEYS) + " FROM runs"),
)
def _(spark, sf_dir):
    rows = ledger.state_columns(runs(spark, sf_dir).select("id", "state"))
    return rows.drop("state")


@query(
    "F13_dashboard_stats",
    ledger_sql(
        STATS + "SELECT tsname, source, version, round(process_time, 6) AS process_time, round(cache_time, 6) AS cache_time, address_count, geometry_type, "
        "processed_url, cache_url, sample_url, output_url, fingerprint FROM stats"
    ),
)
def _(spark, sf_dir):
    rows = stats(spark, sf_dir)
    return rows.withColumns({c: number(F.col(c)) for c in ("process_time", "cache_time")})


@query(
    "F14_boolstr",
    ledger_sql("SELECT id, CASE WHEN status THEN 'true' WHEN NOT status THEN 'false' ELSE '' END AS status FROM runs"),
)
def _(spark, sf_dir):
    return runs(spark, sf_dir).select("id", text.boolean_text(F.col("status")).alias("status"))
