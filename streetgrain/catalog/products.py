"""Check queries: whole jobs."""

import json
from datetime import timedelta

from pyspark.sql import functions as F

from streetgrain.catalog.base import query
from streetgrain.catalog.conform import ADDRESS_SQL, HASH_SQL, LINES, SPEC
from streetgrain.catalog.coverage import FEATURES, geographies, sources
from streetgrain.catalog.ledger import LATEST, LOST, STATS, js, last_set, seconds_sql
from streetgrain.catalog.spatial import (
    AREA_SQL, DIAMETER, HASH12, PARSED, POLED, BLOTS_SQL, STATS_SQL, bounds_sql, blots, union_sql,
)
from streetgrain.catalog.views import ADDR_RAW_LINES, ledger_sql, runs, sets, table, view, view_sql
from streetgrain.functions import geo
from streetgrain.operators import runs as ledger
from streetgrain.plans import process, products, publish
from streetgrain.session import scratch_path


@query("E01_process_source", f"WITH {LINES}, {ADDRESS_SQL}, h AS (SELECT *, {HASH_SQL} AS \"HASH\" FROM made) SELECT * EXCLUDE (rid, \"CITY\"), coalesce(\"CITY\", '') AS \"CITY\" FROM h".replace("FROM made)", "FROM (SELECT * REPLACE (coalesce(\"CITY\", '') AS \"CITY\") FROM made))"))
def _(spark, sf_dir):
    """A written CSV source from definition to address table."""
    rows = view(spark, sf_dir, "addr_raw_lines")
    path = scratch_path(spark, "source")
    kept = rows.select("address", "city", "district", "region", "zip", "tags", "zlon", "zlat")
    # Texts are quoted as other programs write them: blanks inside are kept.
    kept.write.option("header", "true").option("quoteAll", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false").option(
        "ignoreTrailingWhiteSpace", "false"
    ).csv(path)
    definition = {
        "coverage": {"US Census": {"geoid": "06"}}, "protocol": "http", "conform": SPEC,
        "test": {"acceptance-tests": [{"description": "plain", "inputs": {"address": "12 MAIN ST"}, "expected": {"number": "12", "street": "MAIN ST"}}]},
    }
    done = process.process_source(spark, definition, path, "f00d")
    return done.addresses.drop("_error")


# A source of eight files, each with the header, and the record of its state.
FILES = 8
SOURCE_COLUMNS = ["address", "city", "district", "region", "zip", "tags", "zlon", "zlat"]
SOURCE_LINE = " || ',' || ".join(f"coalesce('\"' || replace({c}, '\"', '\"\"') || '\"', '')" for c in SOURCE_COLUMNS)
CREDITED = {
    "license": {"url": "http://license.example/by", "text": "Open with credit", "attribution name": "City of Example", "share-alike": "Yes"},
    "website": "http://city.example/addresses",
}


@query(
    "E01_source_state",
    f"WITH {LINES}, files AS (SELECT rid % 8 AS b, md5('{','.join(SOURCE_COLUMNS)}' || chr(10) || string_agg({SOURCE_LINE}, chr(10) ORDER BY rid, {SOURCE_LINE}) || chr(10)) AS f FROM raw GROUP BY 1), "
    "digest AS (SELECT CASE WHEN count(*) = 1 THEN min(f) ELSE md5(string_agg(f, '' ORDER BY b)) END AS f FROM files) "
    "SELECT 'place.json' AS source, FALSE AS skipped, TRUE AS cache, 'sample.json' AS sample, 'http://city.example/addresses' AS website, 'Open with credit (http://license.example/by)' AS license, "
    "CAST(NULL AS VARCHAR) AS geometry_type, (SELECT count(*) FROM raw) AS address_count, 'v7' AS version, f AS fingerprint, '0:01:05' AS cache_time, 'out.csv' AS processed, TRUE AS process_time, "
    "'output.txt' AS output, CAST(NULL AS VARCHAR) AS preview, CAST(NULL AS VARCHAR) AS slippymap, 'true' AS attribution_required, 'City of Example' AS attribution_name, 'true' AS share_alike, "
    "CAST(NULL AS VARCHAR) AS source_problem, 'c1' AS code_version, TRUE AS tests_passed FROM digest",
)
def _(spark, sf_dir):
    # The keys are dealt out, not the lines: those are made and sorted in the task that writes them.
    keys = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % FILES).alias("b"), "l_orderkey", "l_partkey", F.lit(False).alias("head"))
    heads = keys.select("b", F.col("b").alias("l_orderkey"), F.lit(None).cast(keys.schema["l_partkey"].dataType).alias("l_partkey"), F.lit(True).alias("head"))
    dealt_keys = keys.unionByName(heads.distinct()).repartition(FILES * FILES, "b")
    rows = dealt_keys.selectExpr("b", "head", *[f"{e} AS `{n}`" for n, e in ADDR_RAW_LINES.items()])
    line = f"CASE WHEN head THEN '{','.join(SOURCE_COLUMNS)}' ELSE {SOURCE_LINE} END AS line"
    path = scratch_path(spark, "source")
    ordered = rows.selectExpr("b", "CASE WHEN head THEN -1 ELSE rid END AS rid", line).sortWithinPartitions("b", "rid", "line")
    ordered.select("b", "line").write.partitionBy("b").text(path)
    definition = {
        "coverage": {"US Census": {"geoid": "06"}}, "protocol": "http", "conform": SPEC, **CREDITED,
        "test": {"acceptance-tests": [{"description": "plain", "inputs": {"address": "12 MAIN ST"}, "expected": {"number": "12", "street": "MAIN ST"}}]},
    }
    state = publish.publish_source(
        spark, json.dumps(definition), path, scratch_path(spark, "published"), "sources/us/ca/place.json",
        version="v7", cache_time=timedelta(seconds=65), code_version="c1",
    )
    # Where the data lay and how long it took is for each run to say.
    return state.withColumns({"cache": F.col("cache") == path, "process_time": F.col("process_time").rlike(r"^\d+:\d\d:\d\d")})


FACTS = (
    f", facts AS (SELECT substr(source_path, 9, length(source_path) - 13) AS path_base, {js('share-alike')} AS share_alike, {js('website')} AS website, "
    f"{js('license')} AS license, {js('attribution flag')} AS flag, {js('attribution name')} AS name FROM runs "
    f"WHERE id IN (SELECT id FROM latest) AND {js('processed')} IS NOT NULL) "
)
# Addresses of the ledger's sources: points dealt to the places of the ledger.
DEAL = "pt_id % 211"


def facts(spark, sf_dir):
    rows = runs(spark, sf_dir)
    return products.source_facts(ledger.latest_runs_to_date(rows, sets(spark, sf_dir), last_set(spark, sf_dir)))


CODES = "us/ca,us/ny,us-tx,us/il,de,fr,jp,br,mx,za,gb,us/va,ca,nz"


def dealt(spark, sf_dir):
    """Address points of the sources in the ledger."""
    base = F.expr(f"concat(split_part('{CODES}', ',', CAST({DEAL} % 14 + 1 AS INT)), '/place', CAST({DEAL} AS STRING))")
    pts = view(spark, sf_dir, "pts").select("pt_id", "lon_text", "lat_text", "number", "street")
    return pts.withColumn("source_base", base)


BASE_SQL = f"split_part('{CODES}', ',', CAST({DEAL} % 14 + 1 AS INT)) || '/place' || CAST({DEAL} AS VARCHAR)"
LEDGER_POINTS = (
    LATEST + FACTS + f", {PARSED}, good AS (SELECT pt_id, {BASE_SQL} AS source_base, lon, lat, lon_text, lat_text FROM parsed "
    "WHERE lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90)"
)


@query(
    "E02_collect_extracts",
    ledger_sql(
        LEDGER_POINTS + ", n AS (SELECT source_base, count(*) AS n FROM good GROUP BY 1), s AS (SELECT path_base AS source_base, share_alike, n FROM facts JOIN n ON path_base = n.source_base), "
        f"placed AS (SELECT *, {AREA_SQL} AS collection FROM s) SELECT collection, CASE WHEN share_alike = 'true' THEN 'sa' ELSE '' END AS license_attr, "
        "count(*) AS sources, CAST(sum(n) AS BIGINT) AS addresses FROM placed GROUP BY 1, 2"
    ),
)
def _(spark, sf_dir):
    return products.collection_counts(dealt(spark, sf_dir), facts(spark, sf_dir), "lon_text", "lat_text")


@query(
    "E02_collect_extracts_members",
    ledger_sql(
        LEDGER_POINTS + f", s AS (SELECT path_base AS source_base, share_alike FROM facts), placed AS (SELECT *, {AREA_SQL} AS collection FROM s) "
        "SELECT collection, CASE WHEN share_alike = 'true' THEN 'sa' ELSE '' END AS license_attr, source_base, pt_id, lon, lat FROM placed JOIN good USING (source_base)"
    ),
)
def _(spark, sf_dir):
    made = products.collect_extracts(dealt(spark, sf_dir), facts(spark, sf_dir), "lon_text", "lat_text")
    return made["addresses"].select("collection", "license_attr", "source_base", "pt_id", "lon", "lat")


@query(
    "E03_index_tiles",
    ledger_sql(
        LEDGER_POINTS + ", t AS (SELECT CAST(floor(lon) AS BIGINT) AS tile_lon, CAST(floor(lat) AS BIGINT) AS tile_lat, source_base, count(*) AS points "
        "FROM good JOIN facts ON path_base = source_base WHERE share_alike IS DISTINCT FROM 'true' GROUP BY ALL) SELECT tile_lon, tile_lat, "
        "CAST(sum(points) AS BIGINT) AS points, count(*) AS sources, printf('tiles/%.1f/%.1f', CAST(tile_lon AS DOUBLE), CAST(tile_lat AS DOUBLE)) AS key FROM t GROUP BY 1, 2"
    ),
)
def _(spark, sf_dir):
    return products.index_tiles(dealt(spark, sf_dir), facts(spark, sf_dir), "lon_text", "lat_text")["index"]


@query(
    "E03_index_tiles_licenses",
    ledger_sql(
        LEDGER_POINTS + ", t AS (SELECT DISTINCT CAST(floor(lon) AS BIGINT) AS tile_lon, CAST(floor(lat) AS BIGINT) AS tile_lat, source_base, website, license, flag, name "
        "FROM good JOIN facts ON path_base = source_base WHERE share_alike IS DISTINCT FROM 'true'), b AS (SELECT tile_lon, tile_lat, source_base, "
        "source_base || '\nWebsite: ' || coalesce(website, 'Unknown') || '\nLicense: ' || coalesce(license, 'Unknown') || '\nRequired attribution: ' || "
        "CASE WHEN flag = 'false' THEN 'No' ELSE coalesce(name, 'Yes') END || '\n' AS block FROM t) SELECT tile_lon, tile_lat, source_base, block AS text FROM b "
        "UNION ALL SELECT DISTINCT tile_lon, tile_lat, NULL, 'Data collected from public sources.\n' FROM b"
    ),
)
def _(spark, sf_dir):
    return products.index_tiles(dealt(spark, sf_dir), facts(spark, sf_dir), "lon_text", "lat_text")["licenses"]


CLAMP = lambda v: f"CAST(least(greatest(floor({v}), 0), pow(2.0, zoom) - 1) AS BIGINT)"


@query(
    "E04_dot_map",
    f"WITH {PARSED}, zooms AS (SELECT CAST(unnest(range(16)) AS INTEGER) AS zoom), m AS (SELECT pt_id, radians(lon) * 6378137.0 AS x, {POLED} AS y "
    "FROM parsed WHERE lon IS NOT NULL AND NOT isnan(lon) AND lat IS NOT NULL AND NOT isnan(lat)), "
    f"t AS (SELECT zoom, {CLAMP(f'(x + {DIAMETER} / 2) / {DIAMETER} * pow(2.0, zoom)')} AS col, CAST(pow(2, zoom) AS BIGINT) - 1 - {CLAMP(f'({DIAMETER} / 2 - y) / {DIAMETER} * pow(2.0, zoom)')} AS \"row\", "
    f"count(*) AS points FROM m, zooms WHERE {HASH12} % CAST(pow(2, 15 - zoom) AS BIGINT) = 0 GROUP BY ALL), q AS (SELECT unnest(['northwest', 'northeast', 'southeast', 'southwest']) AS quadrant) "
    "SELECT zoom, col, \"row\", points, quadrant FROM t, q WHERE zoom = 0 OR ((CASE WHEN \"row\" >= pow(2, zoom - 1) THEN 'north' ELSE 'south' END) || "
    "(CASE WHEN col >= pow(2, zoom - 1) THEN 'east' ELSE 'west' END) = quadrant)",
)
def _(spark, sf_dir):
    return products.dot_map(view(spark, sf_dir, "pts"), F.col("pt_id"), "lon_text", "lat_text")


LAND = (
    "land AS (SELECT split_part('FR,DE,JP', ',', CAST(n_nationkey % 3 + 1 AS INT)) AS iso_a2, CAST(n_nationkey AS DOUBLE) * 5 - 60.03 AS x0, -20.03 AS y0 FROM nation)"
)


PARTS_OF_LAND = (
    "SELECT iso_a2 AS code, bx, b_y, greatest(x0, bx) AS lx, least(x0 + 4.0, bx + 1) AS rx, greatest(y0, b_y) AS ly, least(y0 + 40.0, b_y + 1) AS ry "
    "FROM (SELECT *, CAST(unnest(range(CAST(floor(y0) AS BIGINT), CAST(ceil(y0 + 40.0) AS BIGINT))) AS DOUBLE) AS b_y FROM "
    "(SELECT *, CAST(unnest(range(CAST(floor(x0) AS BIGINT), CAST(ceil(x0 + 4.0) AS BIGINT))) AS DOUBLE) AS bx FROM land))"
)


@query(
    "E05_calculate_coverage",
    f"WITH {BLOTS_SQL}, {LAND}, {union_sql(PARTS_OF_LAND)}, "
    "per AS (SELECT p.code AS iso_a2, bx AS lon, b_y AS lat, sum(coalesce(i.area, 0)) / sum((p.rx - p.lx) * (p.ry - p.ly)) AS fraction FROM places p LEFT JOIN inked_area i USING (code, lx, rx, ly, ry) GROUP BY 1, 2, 3), "
    "st AS (SELECT *, CAST(100 + (lon + 180) % 7 AS DOUBLE) AS area, CAST(1000 + (lat + 90) % 11 AS DOUBLE) AS population FROM per), "
    "s AS (SELECT iso_a2, sum(area * fraction) AS a_t, sum(population * fraction) AS p_t, sum(area * fraction) / sum(area) AS a_p, sum(population * fraction) / sum(population) AS p_p FROM st GROUP BY 1) "
    "SELECT s.iso_a2, 'Land ' || s.iso_a2 AS name, round(a_t, 4) AS area_total, round(p_t, 4) AS pop_total, round(a_p, 6) AS area_pct, round(p_p, 6) AS pop_pct, "
    "CASE WHEN p_p > 0.98 THEN 'best' WHEN p_p > 0.15 THEN 'okay' ELSE 'empty' END AS band, CAST(c.n AS BIGINT) AS addr_count FROM s JOIN (SELECT code, sum(id) AS n FROM blots GROUP BY 1) c ON c.code = s.iso_a2",
)
def _(spark, sf_dir):
    code = lambda key: F.split_part(F.lit("FR,DE,JP"), F.lit(","), (key % 3 + 1).cast("int"))
    features = blots(spark, sf_dir).select(F.col("code").alias("iso_a2"), F.col("id").alias("count"), "rings")
    x0 = F.col("n_nationkey").cast("double") * 5 - 60.03
    nations = table(spark, sf_dir, "nation").select(
        code(F.col("n_nationkey")).alias("iso_a2"),
        F.array(geo.box_ring(x0, F.lit(-20.03), x0 + 4.0, F.lit(-20.03) + 40.0)).alias("rings"),
    )
    land = nations.withColumn("name", F.concat(F.lit("Land "), "iso_a2"))
    # Boxes and their figures for every place a shape or land can touch.
    place = lambda c, low, high: F.explode(F.sequence(F.floor(low), F.floor(high))).alias(c)
    e = land.select("iso_a2", geo.envelope(F.col("rings")).alias("e"))
    cells = e.select("iso_a2", "e", place("lon", F.col("e.xmin"), F.col("e.xmax"))).select(
        "iso_a2", "lon", place("lat", F.col("e.ymin"), F.col("e.ymax"))
    ).distinct().withColumns({c: F.col(c).cast("double") for c in ("lon", "lat")})
    box_id = ((F.col("lon") + 180) * 1000 + F.col("lat") + 90).cast("bigint")
    boxes = cells.select(box_id.alias("id"), "lon", "lat", F.lit(1.0).alias("size")).distinct()
    figures = cells.select(
        "iso_a2", box_id.alias("box_id"), (100 + (F.col("lon") + 180) % 7).cast("double").alias("area"),
        (1000 + (F.col("lat") + 90) % 11).cast("double").alias("population"),
    )
    made = products.calculate_coverage(features, land, figures, boxes, "iso_a2")
    return made.withColumns(
        {"area_total": F.round("area_total", 4), "pop_total": F.round("pop_total", 4),
         "area_pct": F.round("area_pct", 6), "pop_pct": F.round("pop_pct", 6)}
    )


@query(
    "E06_dashboard",
    ledger_sql(
        f"{STATS}, {LOST}, last AS (SELECT * FROM stats WHERE tsname = (SELECT max(tsname) FROM stats)), "
        "series AS (SELECT tsname, sum(address_count) AS a, count(*) AS n, avg(cache_time) AS c, avg(process_time) AS p FROM stats WHERE address_count > 0 GROUP BY 1), "
        "vals AS (SELECT 'address_count' AS metric, CAST(address_count AS DOUBLE) AS value FROM last UNION ALL SELECT 'process_time', process_time FROM last UNION ALL SELECT 'cache_time', cache_time FROM last) "
        "SELECT 'timeseries' AS section, tsname AS name, 'addresses' AS measure, CAST(a AS DOUBLE) AS value FROM series "
        "UNION ALL SELECT 'timeseries', tsname, 'successful_sources', CAST(n AS DOUBLE) FROM series UNION ALL SELECT 'timeseries', tsname, 'average_cache_time', round(c + 1e-9, 4) FROM series "
        "UNION ALL SELECT 'timeseries', tsname, 'average_process_time', round(p + 1e-9, 4) FROM series "
        "UNION ALL SELECT 'last_batch', metric, CAST(CAST(value AS DECIMAL(20, 6)) AS VARCHAR), CAST(count(*) AS DOUBLE) FROM vals WHERE value IS NOT NULL GROUP BY metric, value "
        "UNION ALL SELECT 'lost_sources', source, max(tsname), CAST(max(address_count) AS DOUBLE) FROM lost GROUP BY source"
    ),
)
def _(spark, sf_dir):
    rows = products.dashboard_rows(runs(spark, sf_dir), sets(spark, sf_dir))
    mean = F.col("measure").startswith("average_")
    return rows.withColumn("value", F.when(mean, F.round(F.col("value") + 1e-9, 4)).otherwise(F.col("value")))


@query(
    "E07_coverage_geojson",
    FEATURES + " SELECT code, 'ISO 3166' AS kind, name, status, source_count, address_count, CAST(1 AS DOUBLE) AS x FROM feat",
)
def _(spark, sf_dir):
    places = geographies(spark, sf_dir).withColumns(
        {"code_kind": F.lit("ISO 3166"), "geometry": F.lit('{"type":"Point","coordinates":[1.0,2.0]}')}
    )
    lines = products.coverage_geojson(places, sources(spark, sf_dir))["features"]
    get = lambda key: F.get_json_object("value", f"$.properties['{key}']")
    kind = F.json_object_keys(F.get_json_object("value", "$.properties"))
    return lines.select(
        get("ISO 3166").alias("code"), F.element_at(kind, -1).alias("kind"), get("name").alias("name"), get("status").alias("status"),
        get("source count").cast("bigint").alias("source_count"), get("address count").cast("bigint").alias("address_count"),
        F.get_json_object("value", "$.geometry.coordinates[0]").cast("double").alias("x"),
    )


@query(
    "E08_parcel_table",
    f"WITH raw AS ({view_sql('addr_raw_lines')}), {ADDRESS_SQL} SELECT raw.rid, 'POLYGON ((' || num || ' 0))' AS geom, \"NUMBER\", \"STREET\" FROM raw JOIN made USING (rid) WHERE FALSE "
    f"UNION ALL SELECT rid, 'POLYGON ((' || num || ' 0))', regexp_replace(trim(num), '\\.0$', ''), trim(st) FROM raw WHERE num <> ''",
)
def _(spark, sf_dir):
    rows = view(spark, sf_dir, "addr_raw_lines").select(
        "rid", "num", "st",
        F.when(F.col("num") != "", F.concat(F.lit("POLYGON (("), "num", F.lit(" 0))"))).otherwise(F.lit("POINT (0 0)")).alias("OA:geom"),
    )
    rows = rows.withColumn("rid", F.col("rid").cast("string"))
    made = process.parcel_table(rows, {"number": "num", "street": "st", "id": "rid"}, "p")
    return made.select(F.col("ID").cast("bigint").alias("rid"), "geom", "NUMBER", "STREET")


@query(
    "E09_preview_extent",
    f"{STATS_SQL}, with_stats AS (SELECT * FROM merc JOIN stats USING (source_base)), b AS ({bounds_sql('source_base, ')}) "
    f"SELECT *, round(log2((CAST(1336 AS DOUBLE) / (xmax - xmin)) / (2.0 * 256 / {DIAMETER})), 5) AS zoom FROM b",
)
def _(spark, sf_dir):
    made = products.preview_extent(view(spark, sf_dir, "pts"), ["source_base"], "lon_text", "lat_text", resolution=2.0)
    return made.select(
        "source_base", *[F.round(c, 2).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")], F.round("zoom", 5).alias("zoom")
    )


PLAN = (
    LATEST + f", expected AS (SELECT source_path, max(source_id) AS source_id, max(ts_us) AS ts_us FROM runs GROUP BY 1), "
    f"t AS (SELECT source_path, CAST(floor({seconds_sql(js('cache time'))}) + floor({seconds_sql(js('process time'))}) AS BIGINT) AS s FROM runs WHERE id IN (SELECT id FROM latest)), "
    "reused AS (SELECT e.source_path, max(p.id) AS reused_run FROM expected e LEFT JOIN runs p ON p.source_id = e.source_id AND p.ts_us < e.ts_us AND p.ts_us > e.ts_us - 864000000000 "
    "AND p.status IS NOT NULL AND p.copy_of IS NULL GROUP BY 1) SELECT e.source_path, CASE WHEN s IS NULL THEN NULL ELSE printf('%d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) END AS run_time, reused_run "
    "FROM expected e LEFT JOIN t USING (source_path) LEFT JOIN reused USING (source_path)"
)


@query("E10_batch_plan", ledger_sql(PLAN))
def _(spark, sf_dir):
    rows = runs(spark, sf_dir)
    expected = rows.groupBy("source_path").agg(F.max("source_id").alias("source_id"), F.max("ts_us").alias("ts_us"))
    return products.batch_plan(expected, rows, sets(spark, sf_dir), last_set(spark, sf_dir))
