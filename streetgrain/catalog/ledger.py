"""Check queries: run ledger, statistics over runs, orders and set operations."""

from pyspark.sql import functions as F

from streetgrain.catalog.base import query
from streetgrain.catalog.views import ledger_sql, runs, sets, table
from streetgrain.functions import rules
from streetgrain.functions.rules import state_value
from streetgrain.functions.text import short_name
from streetgrain.operators import changes, filters, places, statistics
from streetgrain.operators import runs as ledger
from streetgrain.schema import RUN_STATE_KEYS

MERGED = "coalesce(is_merged, TRUE)"


def js(key: str) -> str:
    return f"json_extract_string(state, '$.\"{key}\"')"


def seconds_sql(text: str) -> str:
    part = lambda i: f"CAST(split_part({text}, ':', {i}) AS DOUBLE)"
    return f"({part(1)} * 3600 + {part(2)} * 60 + {part(3)})"


STATS = f""", stats AS (SELECT CAST(CAST(s.start_us / CAST(1000000 AS DECIMAL(7, 0)) AS DECIMAL(20, 3)) AS VARCHAR) AS tsname,
 r.source_path AS source, {js('version')} AS version, {seconds_sql(js('process time'))} AS process_time, {seconds_sql(js('cache time'))} AS cache_time,
 CAST({js('address count')} AS BIGINT) AS address_count, {js('geometry type')} AS geometry_type, {js('processed')} AS processed_url,
 {js('cache')} AS cache_url, {js('sample')} AS sample_url, {js('output')} AS output_url, {js('fingerprint')} AS fingerprint
 FROM runs r JOIN sets s ON s.id = r.set_id WHERE s.end_us IS NOT NULL AND r.state IS NOT NULL) """
STATS = STATS.replace(
    "CAST(CAST(s.start_us / CAST(1000000 AS DECIMAL(7, 0)) AS DECIMAL(20, 3)) AS VARCHAR)",
    "printf('%d.%03d', (s.start_us + 500) // 1000000, ((s.start_us + 500) // 1000) % 1000)",
)


def stats(spark, sf_dir):
    return ledger.dashboard_stats(runs(spark, sf_dir), sets(spark, sf_dir))


def last_set(spark, sf_dir) -> int:
    """Newest finished batch: one number read for the queries that ask for one."""
    newest = ledger.latest_set(sets(spark, sf_dir), "city", "places")
    return newest.select("id").first()["id"]


LAST_SET = "(SELECT max_by(id, start_us) FROM sets WHERE owner = 'city' AND end_us IS NOT NULL)"

LATEST = f""", latest AS (SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY source_path ORDER BY status DESC, id DESC) AS n FROM runs
 WHERE status IS NOT NULL AND {MERGED} AND source_path IN (SELECT source_path FROM runs WHERE set_id = {LAST_SET})) WHERE n = 1) """


@query("W01_latest_runs_to_date", ledger_sql(LATEST + "SELECT id, source_path, status, set_id FROM runs WHERE id IN (SELECT id FROM latest)"))
def _(spark, sf_dir):
    latest = ledger.latest_runs_to_date(runs(spark, sf_dir), sets(spark, sf_dir), last_set(spark, sf_dir))
    return latest.select("id", "source_path", "status", "set_id")


@query(
    "W02_latest_run",
    ledger_sql(
        f", one AS (SELECT min(source_path) AS p FROM runs) SELECT id, source_path, status FROM runs, one WHERE source_path = p AND status IS NOT NULL "
        f"AND {MERGED} ORDER BY status DESC, id DESC LIMIT 1"
    ),
)
def _(spark, sf_dir):
    ledger_rows = runs(spark, sf_dir)
    path = ledger_rows.agg(F.min("source_path")).first()[0]
    return ledger.latest_run(ledger_rows, path).select("id", "source_path", "status")


@query(
    "W02_latest_run_per_source",
    ledger_sql(
        f"SELECT source_path, id FROM (SELECT source_path, id, row_number() OVER (PARTITION BY source_path ORDER BY status DESC, id DESC) AS n FROM runs "
        f"WHERE status IS NOT NULL AND {MERGED}) WHERE n = 1"
    ),
)
def _(spark, sf_dir):
    return ledger.latest_run_per_source(runs(spark, sf_dir)).select("source_path", "id")


@query(
    "W03_source_history",
    ledger_sql(
        "SELECT id, source_path, copy_of, status FROM (SELECT *, row_number() OVER (PARTITION BY source_path, coalesce(copy_of, id) ORDER BY id DESC) AS n "
        f"FROM runs WHERE status IS NOT NULL AND {MERGED}) WHERE n = 1"
    ),
)
def _(spark, sf_dir):
    return ledger.source_history(runs(spark, sf_dir)).select("id", "source_path", "copy_of", "status")


@query(
    "W04_latest_set",
    ledger_sql(
        "SELECT owner, repository, id, start_us FROM (SELECT *, row_number() OVER (PARTITION BY owner, repository ORDER BY start_us DESC) AS n "
        "FROM sets WHERE end_us IS NOT NULL) WHERE n = 1"
    ),
)
def _(spark, sf_dir):
    return ledger.latest_set(sets(spark, sf_dir)).select("owner", "repository", "id", "start_us")


COUNTERS = {
    "process": "worker_id",
    "ts_us": "ts_us",
    "user_cpu": "ts_us / 4000 + id",
    "system_cpu": "ts_us / 9000 + id",
    "total_cpu": "ts_us / 1000 + id * 3",
    "read_bytes": "CASE WHEN id % 7 = 0 THEN NULL ELSE id * 1024 END",
    "written_bytes": "id * 512",
    "sent_bytes": "id * 256",
    "received_bytes": "id * 128",
}
_COUNTER_SQL = ", ".join(f"{e.replace('ts_us / 4000', 'ts_us // 4000').replace('ts_us / 9000', 'ts_us // 9000').replace('ts_us / 1000', 'ts_us // 1000')} AS {n}" for n, e in COUNTERS.items())


def counters(spark, sf_dir):
    whole = {n: e.replace("ts_us / ", "ts_us div ") for n, e in COUNTERS.items()}
    return runs(spark, sf_dir).selectExpr(*[f"{e} AS {n}" for n, e in whole.items()])


def _lagged(name: str) -> str:
    return f"{name} - lag({name}) OVER w"


@query(
    "W05_usage_rates",
    ledger_sql(
        f", c AS (SELECT {_COUNTER_SQL} FROM runs), d AS (SELECT process, ts_us, {_lagged('user_cpu')} AS u, {_lagged('system_cpu')} AS s, {_lagged('total_cpu')} AS t, "
        f"{_lagged('read_bytes')} AS r, {_lagged('written_bytes')} AS wr, {_lagged('sent_bytes')} AS se, {_lagged('received_bytes')} AS re, {_lagged('ts_us')} AS p "
        "FROM c WINDOW w AS (PARTITION BY process ORDER BY ts_us)) "
        "SELECT process, ts_us, round(u * 100.0 / t, 6) AS user_percent, round(s * 100.0 / t, 6) AS system_percent, "
        "CASE WHEN r IS NULL THEN 0 ELSE r / CAST(1024 AS DOUBLE) END AS read_kb, CASE WHEN r IS NULL THEN 0 ELSE wr / CAST(1024 AS DOUBLE) END AS written_kb, "
        "CASE WHEN r IS NULL THEN 0 ELSE se / CAST(1024 AS DOUBLE) END AS sent_kb, CASE WHEN r IS NULL THEN 0 ELSE re / CAST(1024 AS DOUBLE) END AS received_kb, "
        "p / CAST(1000000 AS DOUBLE) AS period FROM d WHERE t IS NOT NULL"
    ).replace("u * 100.0 / t", "u * CAST(100 AS DOUBLE) / t").replace("s * 100.0 / t", "s * CAST(100 AS DOUBLE) / t"),
)
def _(spark, sf_dir):
    rates = ledger.usage_rates(counters(spark, sf_dir))
    return rates.withColumns({c: F.round(c, 6) for c in ("user_percent", "system_percent")})


# --- joins ------------------------------------------------------------------------


@query(
    "J01_runs_with_set",
    ledger_sql("SELECT r.id, r.set_id, s.start_us FROM runs r JOIN sets s ON s.id = r.set_id WHERE s.end_us IS NOT NULL AND r.state IS NOT NULL"),
)
def _(spark, sf_dir):
    return ledger.runs_with_set(runs(spark, sf_dir), sets(spark, sf_dir)).select(
        "id", "set_id", F.unix_micros("set_start").alias("start_us")
    )


@query(
    "J02_latest_paths_in_set",
    ledger_sql(f"SELECT id, source_path FROM runs WHERE source_path IN (SELECT source_path FROM runs WHERE set_id = {LAST_SET})"),
)
def _(spark, sf_dir):
    rows = runs(spark, sf_dir)
    paths = ledger.paths_of_set(rows, F.lit(last_set(spark, sf_dir)))
    return rows.join(paths, "source_path", "left_semi").select("id", "source_path")


@query(
    "J03_fallback_to_failed",
    ledger_sql(
        f", g AS (SELECT source_path, max(id) AS id, TRUE AS status FROM runs WHERE status AND {MERGED} GROUP BY 1), "
        f"b AS (SELECT source_path, max(id) AS id, FALSE AS status FROM runs WHERE NOT status AND {MERGED} GROUP BY 1) "
        "SELECT * FROM g UNION ALL SELECT * FROM b WHERE source_path NOT IN (SELECT source_path FROM g)"
    ),
)
def _(spark, sf_dir):
    return ledger.fallback_to_failed(runs(spark, sf_dir))


LOST = (
    "lost AS (SELECT * FROM stats WHERE address_count > 0 AND source IN (SELECT source FROM stats WHERE tsname = (SELECT max(tsname) FROM stats) "
    "AND coalesce(address_count, 0) = 0))"
)


@query("J04_lost_sources", ledger_sql(f"{STATS}, {LOST} SELECT source, tsname, address_count FROM lost"))
def _(spark, sf_dir):
    return statistics.lost_sources(stats(spark, sf_dir)).select("source", "tsname", "address_count")


@query(
    "J11_reuse_previous_run",
    ledger_sql(
        "SELECT r.id AS request_id, max(p.id) AS reused_run FROM runs r LEFT JOIN runs p ON p.source_id = r.source_id AND p.ts_us < r.ts_us "
        "AND p.ts_us > r.ts_us - 864000000000 AND p.status IS NOT NULL AND p.copy_of IS NULL GROUP BY 1"
    ),
)
def _(spark, sf_dir):
    rows = runs(spark, sf_dir)
    return ledger.reuse_previous_run(rows.select(F.col("id").alias("request_id"), "source_id", "ts_us"), rows)


@query(
    "J11_reuse_previous_run_one_hour",
    ledger_sql(
        "SELECT r.id AS request_id, max(p.id) AS reused_run FROM runs r LEFT JOIN runs p ON p.source_id = r.source_id AND p.ts_us < r.ts_us "
        "AND p.ts_us > r.ts_us - 3600000000 AND p.status IS NOT NULL AND p.copy_of IS NULL GROUP BY 1"
    ),
)
def _(spark, sf_dir):
    rows = runs(spark, sf_dir)
    requests = rows.select(F.col("id").alias("request_id"), "source_id", "ts_us")
    return ledger.reuse_previous_run(requests, rows, interval_us=3600 * 1_000_000, blocks=6)


@query(
    "J12_expected_minus_seen",
    ledger_sql(f"SELECT DISTINCT source_path FROM runs WHERE source_path NOT IN (SELECT source_path FROM runs WHERE set_id = {LAST_SET} AND status IS NOT NULL)"),
)
def _(spark, sf_dir):
    rows = runs(spark, sf_dir)
    return ledger.expected_minus_seen(rows.select("source_path").distinct(), rows, last_set(spark, sf_dir))


ZIPS = (
    "SELECT concat('http://zips.example.org/', CAST(o_custkey % 50 AS STRING), '-', o_orderstatus, '.zip') AS url, "
    "split_part('global,us_northeast,us_midwest,us_south,us_west,europe,asia,south_america,north_america', ',', CAST(o_custkey % 9 + 1 AS INT)) AS collection, "
    "CASE WHEN o_orderstatus = 'F' THEN 'sa' ELSE '' END AS license_attr, CAST(floor(o_totalprice / 50) AS BIGINT) AS content_length, o_orderpriority AS priority"
)


def zips(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("_orders")
    return spark.sql(f"{ZIPS} FROM _orders")


@query(
    "J13_merge_published",
    f"WITH z AS ({ZIPS} FROM orders), old AS (SELECT url, max(content_length) AS content_length FROM z WHERE priority <= '3' GROUP BY 1), "
    "new AS (SELECT url, max(content_length) AS content_length FROM z WHERE priority > '3' GROUP BY 1) "
    "SELECT *, FALSE AS is_current FROM old WHERE url NOT IN (SELECT url FROM new) UNION ALL SELECT *, TRUE FROM new",
)
def _(spark, sf_dir):
    z = zips(spark, sf_dir)
    size = F.max("content_length").alias("content_length")
    old = z.filter("priority <= '3'").groupBy("url").agg(size).withColumn("is_current", F.lit(True))
    new = z.filter("priority > '3'").groupBy("url").agg(size).withColumn("is_current", F.lit(False))
    return ledger.merge_published(old, new)


@query("J14_mark_index_runs", ledger_sql(LATEST + "SELECT id, id IN (SELECT id FROM latest) AS for_index_page FROM runs"))
def _(spark, sf_dir):
    rows = runs(spark, sf_dir)
    latest = ledger.latest_runs_to_date(rows, sets(spark, sf_dir), last_set(spark, sf_dir))
    return ledger.mark_index_runs(rows.select("id"), latest)


# --- aggregates ------------------------------------------------------------------


@query(
    "A03_run_counts",
    ledger_sql(
        f"SELECT count(*) AS sources, count(*) FILTER ({js('cache')} <> '') AS cached, count(*) FILTER ({js('processed')} <> '') AS processed, "
        f"CAST(sum(coalesce(CAST({js('address count')} AS BIGINT), 0)) AS BIGINT) AS addresses FROM runs"
    ),
)
def _(spark, sf_dir):
    states = ledger.state_columns(runs(spark, sf_dir), ["cache", "processed", "address count"])
    return statistics.run_counts(states.withColumn("address_count", F.col("address_count").try_cast("bigint")))


@query(
    "A04_batch_timeseries",
    ledger_sql(
        STATS + "SELECT tsname, CAST(sum(address_count) AS BIGINT) AS addresses, count(*) AS successful_sources, round(avg(cache_time) + 1e-9, 6) AS average_cache_time, "
        "round(avg(process_time) + 1e-9, 6) AS average_process_time FROM stats WHERE address_count > 0 GROUP BY 1"
    ),
)
def _(spark, sf_dir):
    series = statistics.batch_timeseries(stats(spark, sf_dir))
    # The small addend settles ties, which the two engines round differently.
    return series.withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in ("average_cache_time", "average_process_time")})


@query(
    "A05_last_batch_distributions",
    ledger_sql(
        STATS + ", last AS (SELECT * FROM stats WHERE tsname = (SELECT max(tsname) FROM stats)), "
        "v AS (SELECT 'address_count' AS metric, CAST(address_count AS DOUBLE) AS value FROM last UNION ALL SELECT 'process_time', process_time FROM last "
        "UNION ALL SELECT 'cache_time', cache_time FROM last) SELECT metric, value, count(*) AS runs FROM v WHERE value IS NOT NULL GROUP BY 1, 2"
    ),
)
def _(spark, sf_dir):
    return statistics.last_batch_distributions(stats(spark, sf_dir))


@query(
    "A06_lost_source_stats",
    ledger_sql(f"{STATS}, {LOST} SELECT source, max(address_count) AS max_addresses, max(tsname) AS last_good FROM lost GROUP BY 1"),
)
def _(spark, sf_dir):
    return statistics.lost_source_stats(stats(spark, sf_dir))


@query("A07_set_run_count", ledger_sql("SELECT set_id, count(*) AS runs FROM runs WHERE status IS NOT NULL AND set_id IS NOT NULL GROUP BY 1"))
def _(spark, sf_dir):
    return ledger.set_run_count(runs(spark, sf_dir))


@query(
    "A08_job_status",
    ledger_sql("SELECT job_id, CASE WHEN bool_or(NOT status) THEN FALSE WHEN count(*) > count(status) THEN NULL ELSE TRUE END AS status FROM runs GROUP BY 1"),
)
def _(spark, sf_dir):
    return statistics.job_status(runs(spark, sf_dir))


LICENSED = f""", facts AS (SELECT substr(source_path, 9, length(source_path) - 13) AS source_base, {js('website')} AS website, {js('license')} AS license,
 {js('attribution flag')} AS flag, {js('attribution required')} AS required, {js('attribution name')} AS name, set_id, id FROM runs WHERE {js('processed')} IS NOT NULL),
 blocks AS (SELECT set_id, source_base, id, source_base || '\nWebsite: ' || coalesce(website, 'Unknown') || '\nLicense: ' || coalesce(license, 'Unknown')
 || '\nRequired attribution: ' || CASE WHEN flag = 'false' THEN 'No' ELSE coalesce(name, 'Yes') END || '\n' AS block FROM facts) """


def licensed(spark, sf_dir):
    rows = filters.good_runs(runs(spark, sf_dir), state_value(F.col("state"), "processed"))
    value = lambda key: state_value(F.col("state"), key)
    return rows.select(
        short_name(F.col("source_path")).alias("source_base"), value("website").alias("website"),
        value("license").alias("license"), value("attribution flag").alias("attribution_flag"),
        value("attribution required").alias("attribution_required"),
        value("attribution name").alias("attribution_name"), "set_id", "id",
    )


@query(
    "A13_license_text",
    ledger_sql(
        LICENSED + " SELECT DISTINCT set_id, source_base, block AS text FROM blocks "
        "UNION ALL SELECT DISTINCT set_id, NULL, 'Data.\n' FROM blocks"
    ),
)
def _(spark, sf_dir):
    return statistics.license_text(licensed(spark, sf_dir), ["set_id"], "Data.")


@query(
    "A14_license_groups",
    ledger_sql(
        LICENSED + " SELECT DISTINCT license, CASE WHEN required IS DISTINCT FROM 'false' THEN name END AS attribution, "
        "source_base AS source, website FROM facts"
    ),
)
def _(spark, sf_dir):
    return statistics.license_groups(licensed(spark, sf_dir).withColumnRenamed("source_base", "source"))


@query(
    "A18_collections_index",
    f"WITH z AS ({ZIPS} FROM orders), v AS (SELECT collection, license_attr, max((url, content_length)) AS z FROM z WHERE priority = '1-URGENT' "
    "AND content_length >= 1024 GROUP BY 1, 2) SELECT collection, string_agg(license_attr || '=' || z[1] || ':' || CAST(z[2] AS VARCHAR) || ' ' || "
    "CASE license_attr WHEN 'sa' THEN 'Share-Alike Required' ELSE 'Freely Shareable' END, ',' ORDER BY license_attr) AS licenses FROM v GROUP BY 1",
)
def _(spark, sf_dir):
    z = zips(spark, sf_dir).withColumn("is_current", F.col("priority") == "1-URGENT")
    entry = lambda e: F.concat(
        e["key"], F.lit("="), e["value"]["url"], F.lit(":"), e["value"]["content_length"].cast("string"),
        F.lit(" "), e["value"]["license"],
    )
    index = statistics.collections_index(z)
    return index.select("collection", F.array_join(F.transform(F.array_sort(F.map_entries("licenses")), entry), ",").alias("licenses"))


@query("A19_queue_depths", "SELECT event_type AS queue, count(*) AS depth FROM events GROUP BY 1")
def _(spark, sf_dir):
    return statistics.queue_depths(table(spark, sf_dir, "events").select(F.col("event_type").alias("queue")))


@query("P10_collection_nonempty", f"WITH z AS ({ZIPS} FROM orders) SELECT url, content_length FROM z WHERE content_length >= 1024")
def _(spark, sf_dir):
    return filters.collection_nonempty(zips(spark, sf_dir)).select("url", "content_length")


@query("P11_good_runs", ledger_sql(f"SELECT id, source_path FROM runs WHERE {js('processed')} IS NOT NULL"))
def _(spark, sf_dir):
    return filters.good_runs(runs(spark, sf_dir), state_value(F.col("state"), "processed")).select("id", "source_path")


@query("P06_polygon_sources", ledger_sql(f"SELECT id, {js('geometry type')} AS geometry_type FROM runs WHERE {js('geometry type')} LIKE '%Polygon%'"))
def _(spark, sf_dir):
    return filters.polygon_sources(ledger.state_columns(runs(spark, sf_dir), ["geometry type"])).select("id", "geometry_type")


# --- orders ------------------------------------------------------------------------

# An order is checked by the position of every row in it.
SUMMARY = f"s AS (SELECT id, source_path AS source, {js('cache')} AS cache, {js('processed')} AS processed FROM runs)"


def summaries(spark, sf_dir):
    states = ledger.state_columns(runs(spark, sf_dir), ["cache", "processed"])
    return states.select("id", F.col("source_path").alias("source"), "cache", "processed")



@query(
    "L01_glass_half_full",
    ledger_sql(f", {SUMMARY} SELECT source, processed, cache FROM s"),
)
def _(spark, sf_dir):
    return ledger.glass_half_full(summaries(spark, sf_dir)).select("source", "processed", "cache")


@query(
    "L02_glass_half_empty",
    ledger_sql(f", {SUMMARY} SELECT source, processed, cache FROM s"),
)
def _(spark, sf_dir):
    return ledger.glass_half_empty(summaries(spark, sf_dir)).select("source", "processed", "cache")


@query("L03_page_after", ledger_sql("SELECT id, source_path FROM runs WHERE id < (SELECT max(id) // 2 FROM runs) ORDER BY id DESC LIMIT 25"))
def _(spark, sf_dir):
    rows = runs(spark, sf_dir)
    past = rows.agg(F.max("id")).first()[0] // 2
    return ledger.page_after(rows.select("id", "source_path"), past)


CLOCK_SQL = (
    f"floor({seconds_sql(js('cache time'))}) + floor({seconds_sql(js('process time'))})"
)
TIMES = (
    f", t AS (SELECT id, source_path AS path, CAST({CLOCK_SQL} AS BIGINT) AS s FROM runs), "
    "o AS (SELECT id, path, printf('%d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) AS run_time FROM t) "
)


@query("L04_batch_order", ledger_sql(TIMES + "SELECT path, id, CASE WHEN run_time = 'NULL:NULL:NULL' THEN NULL ELSE run_time END AS run_time FROM o"))
def _(spark, sf_dir):
    rows = runs(spark, sf_dir)
    value = lambda key: state_value(F.col("state"), key)
    timed = rows.select(
        "id", F.col("source_path").alias("path"), ledger.run_time_text(value("cache time"), value("process time")).alias("run_time")
    )
    return ledger.batch_order(timed)


@query(
    "L05_newest_first_files",
    ledger_sql(f"SELECT id, source_path, ts_us FROM runs WHERE {js('processed')} IS NOT NULL"),
)
def _(spark, sf_dir):
    good = filters.good_runs(runs(spark, sf_dir), state_value(F.col("state"), "processed"))
    return ledger.newest_first(good).select("id", "source_path", "ts_us")


@query("L06_job_file_order", ledger_sql("SELECT job_id, source_path AS path, status FROM runs"))
def _(spark, sf_dir):
    return ledger.job_file_order(runs(spark, sf_dir).select("job_id", F.col("source_path").alias("path"), "status"))


@query("L07_top_sources", ledger_sql("SELECT id, (SELECT count(*) - 20 FROM runs) AS more FROM runs ORDER BY id DESC LIMIT 20"))
def _(spark, sf_dir):
    return ledger.top_sources(runs(spark, sf_dir).select("id"), [F.col("id").desc()])


# Places of the rows of each order: the span of each key, so that equal rows may change places.
def span_sql(source: str, keys: str, order: str) -> str:
    return (
        f"SELECT {keys}, min(place) AS first_place, max(place) AS last_place, count(*) AS n FROM "
        f"(SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM {source}) GROUP BY ALL"
    )


FILLED = "SELECT source, coalesce(processed <> '', FALSE) AS is_processed, coalesce(cache <> '', FALSE) AS is_cached FROM s"


def filled(df):
    some = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    return df.select("source", some("processed").alias("is_processed"), some("cache").alias("is_cached"))


@query("L01_places", ledger_sql(f", {SUMMARY} " + span_sql(f"({FILLED})", "source, is_processed, is_cached", "NOT is_processed, NOT is_cached, source")))
def _(spark, sf_dir):
    return places.span_of_places(filled(ledger.glass_half_full(summaries(spark, sf_dir))), ["source", "is_processed", "is_cached"])


@query("L02_places", ledger_sql(f", {SUMMARY} " + span_sql(f"({FILLED})", "source, is_processed, is_cached", "is_cached, is_processed, source")))
def _(spark, sf_dir):
    return places.span_of_places(filled(ledger.glass_half_empty(summaries(spark, sf_dir))), ["source", "is_processed", "is_cached"])


@query(
    "L04_places",
    ledger_sql(TIMES + ", c AS (SELECT path, CASE WHEN run_time = 'NULL:NULL:NULL' THEN NULL ELSE run_time END AS run_time FROM o) "
               + span_sql("c", "path, run_time", "coalesce(nullif(run_time, ''), '9999') DESC, path")),
)
def _(spark, sf_dir):
    rows = runs(spark, sf_dir)
    value = lambda key: state_value(F.col("state"), key)
    timed = rows.select(F.col("source_path").alias("path"), ledger.run_time_text(value("cache time"), value("process time")).alias("run_time"))
    return places.span_of_places(ledger.batch_order(timed), ["path", "run_time"])


@query("L05_places", ledger_sql(span_sql("(SELECT ts_us FROM runs)", "ts_us", "coalesce(ts_us, 0) DESC")))
def _(spark, sf_dir):
    return places.span_of_places(ledger.newest_first(runs(spark, sf_dir)).select("ts_us"), ["ts_us"])


@query(
    "L06_places",
    ledger_sql(span_sql("(SELECT source_path AS path, status FROM runs)", "path, status", "CASE WHEN NOT status THEN 0 WHEN status IS NULL THEN 1 ELSE 2 END, path")),
)
def _(spark, sf_dir):
    return places.span_of_places(ledger.job_file_order(runs(spark, sf_dir).select(F.col("source_path").alias("path"), "status")), ["path", "status"])


# --- set operations -----------------------------------------------------------------

CHANGES = {
    "push": "l_orderkey",
    "commit_no": "l_linenumber",
    "file": "concat(CASE WHEN l_partkey % 4 = 0 THEN 'other/' ELSE 'sources/' END, 'f', CAST(l_partkey % 3 AS STRING), CASE WHEN l_suppkey % 5 = 0 THEN '.txt' ELSE '.json' END)",
    "removed": "l_returnflag = 'R'",
}
CHANGES_SQL = "changes AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in CHANGES.items()) + " FROM lineitem)"
TOUCHED = (
    f"WITH {CHANGES_SQL}, touched AS (SELECT push, file FROM (SELECT *, row_number() OVER (PARTITION BY push, file ORDER BY commit_no DESC, removed DESC) AS n "
    "FROM changes) WHERE n = 1 AND NOT removed)"
)


def file_changes(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in CHANGES.items()])


@query("U01_touched_files", f"{TOUCHED} SELECT push, file FROM touched")
def _(spark, sf_dir):
    return changes.touched_files(file_changes(spark, sf_dir), "push")


@query(
    "U01_touched_files_of_payloads",
    f"WITH {CHANGES_SQL}, one AS (SELECT push, commit_no, file, removed FROM changes) SELECT push, commit_no, file, removed FROM one",
)
def _(spark, sf_dir):
    rows = file_changes(spark, sf_dir)
    entry = F.concat(F.lit('["'), F.col("file"), F.lit('"]'))
    listed = F.concat(
        F.lit('{"added": '), F.when(~F.col("removed"), entry).otherwise(F.lit("[]")), F.lit(', "modified": [], "removed": '),
        F.when(F.col("removed"), entry).otherwise(F.lit("[]")), F.lit("}"),
    )
    # The change stands in its own commit, behind empty ones.
    empty = F.lit('{"added": [], "modified": [], "removed": []}')
    commits = F.array_join(F.concat(F.array_repeat(empty, F.col("commit_no")), F.array(listed)), ",")
    payloads = rows.select("push", F.concat(F.lit('{"commits": ['), commits, F.lit("]}")).alias("payload"))
    return changes.explode_commits(payloads, "push")


@query(
    "U02_touched_union",
    f"{TOUCHED} SELECT push, file FROM touched UNION SELECT push, file FROM changes WHERE commit_no = 1",
)
def _(spark, sf_dir):
    rows = file_changes(spark, sf_dir)
    return changes.touched_union(changes.touched_files(rows, "push"), rows.filter("commit_no = 1").select("push", "file"))


@query("P07_source_file_paths", f"WITH {CHANGES_SQL} SELECT push, file FROM changes WHERE file LIKE 'sources/%' AND file LIKE '%.json'")
def _(spark, sf_dir):
    return changes.source_file_paths(file_changes(spark, sf_dir)).select("push", "file")


PAYLOAD = {
    "id": "event_id",
    "event": "CASE WHEN event_type = 'view' THEN 'pull_request' ELSE 'other' END",
    "payload": "CASE event_type WHEN 'view' THEN concat('{\"action\": \"', CASE WHEN event_id % 3 = 0 THEN 'closed' ELSE 'opened' END, '\"}') "
    "WHEN 'click' THEN concat('{\"commits\": [], \"head_commit\": {}', CASE WHEN event_id % 4 = 0 THEN ', \"deleted\": true' ELSE '' END, '}') "
    "WHEN 'purchase' THEN concat('{\"action\": \"', CASE WHEN event_id % 5 = 0 THEN 'deleted' ELSE 'created' END, '\", \"issue\": {', "
    "CASE WHEN event_id % 2 = 0 THEN '\"pull_request\": {}' ELSE '' END, '}, \"comment\": {\"body\": \"', "
    "CASE event_id % 3 WHEN 0 THEN 'Re-run this, please!' WHEN 1 THEN 'well RERUN THIS PLEASE' ELSE 'hello\\\\nrerun this please' END, '\"}}') ELSE '{}' END",
}
PAYLOAD_SQL = {**PAYLOAD, "payload": PAYLOAD["payload"].replace("\\\\n", "\\n")}
PAYLOADS = "p AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in PAYLOAD_SQL.items()) + ", event_type FROM events)"
IS_RERUN = "(event_type = 'purchase' AND id % 5 <> 0 AND id % 2 = 0 AND id % 3 <> 1)"


def payloads(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(*[f"{e} AS {n}" for n, e in PAYLOAD.items()])


@query(
    "P08_event_skip",
    f"WITH {PAYLOADS} SELECT id, CASE event_type WHEN 'view' THEN id % 3 = 0 WHEN 'click' THEN id % 4 = 0 WHEN 'purchase' THEN NOT {IS_RERUN} ELSE TRUE END AS skip FROM p",
)
def _(spark, sf_dir):
    return payloads(spark, sf_dir).select("id", rules.event_skip(F.col("event"), F.col("payload")).alias("skip"))


@query("P09_event_rerun", f"WITH {PAYLOADS} SELECT id, {IS_RERUN} AS rerun FROM p")
def _(spark, sf_dir):
    return payloads(spark, sf_dir).select("id", rules.event_rerun(F.col("payload")).alias("rerun"))


@query(
    "U03_good_and_bad_sources",
    ledger_sql(f"SELECT source_path AS path, bool_or(coalesce({js('processed')} <> '', FALSE)) AS good FROM runs GROUP BY 1"),
)
def _(spark, sf_dir):
    from streetgrain.operators.coverage import good_and_bad_sources

    rows = runs(spark, sf_dir)
    good = filters.good_runs(rows, state_value(F.col("state"), "processed"))
    path = F.col("source_path").alias("path")
    return good_and_bad_sources(rows.select(path).distinct(), good.select(path))


ALLOWED = ", ".join(f"'{k}'" for k in RUN_STATE_KEYS)


@query(
    "U06_unknown_state_keys",
    ledger_sql(f"SELECT id, array_to_string(list_filter(json_keys(state), lambda k: k NOT IN ({ALLOWED})), ',') AS unknown FROM runs WHERE state IS NOT NULL"),
)
def _(spark, sf_dir):
    rows = runs(spark, sf_dir).filter(F.col("state").isNotNull())
    return rows.select("id", F.array_join(rules.unknown_state_keys(F.col("state")), ",").alias("unknown"))
