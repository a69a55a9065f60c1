"""Check queries: readers and writers.

Each query writes whole base tables with Spark into the shared scratch folder
in the format at hand and reads them back with the reader under test.
"""

import io
import os
import re
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from streetgrain.catalog.base import query
from streetgrain.catalog.ledger import js
from streetgrain.catalog.conform import ADDRESS_SQL, HASH_SQL, LINES, NAMES, conformed
from streetgrain.catalog.spatial import AREA_SQL, GOOD, SHAPES_SQL, TILES_SQL, points, shapes
from streetgrain.catalog.views import ledger_sql, runs, table, view, view_sql
from streetgrain.operators import changes, filters, places, spatial, statistics
from streetgrain.operators import runs as ledger
from streetgrain.schema import ADDRESS_COLUMNS, RUN_STATE_KEYS, X_COLUMN, Y_COLUMN
from streetgrain.session import scratch_path, written
from streetgrain.sources import readers, writers

RAW = f"WITH raw AS ({view_sql('addr_raw')})"


def lines_to(df, path):
    """Write the only text column of ``df`` as lines."""
    df.write.mode("overwrite").text(path)
    return path


# Ragged rows: every seventh is too long, every fifth too short.
RAGGED = (
    "concat(CAST(rid AS STRING), ';\"', replace(address, '\"', ''), '; x\";', CASE WHEN rid % 5 = 0 AND rid % 7 <> 0 THEN '' ELSE concat(coalesce(city, ''), ';', zip) END, "
    "CASE WHEN rid % 7 = 0 THEN ';more' ELSE '' END)"
)


@query(
    "S01_read_source_csv",
    f"{RAW} SELECT CAST(rid AS VARCHAR) AS \"COLUMN1\", address || '; x' AS \"COLUMN2\", CASE WHEN rid % 5 = 0 THEN '' ELSE coalesce(city, '') END AS \"COLUMN3\", "
    "CASE WHEN rid % 5 = 0 THEN NULL ELSE zip END AS \"COLUMN4\" FROM raw WHERE rid % 7 <> 0",
)
def _(spark, sf_dir):
    # One line with all columns comes first, so that its width is the header's.
    rows = view(spark, sf_dir, "addr_raw").orderBy(F.col("rid") % 35 != 1, "rid")
    path = lines_to(rows.selectExpr(f"{RAGGED} AS value"), scratch_path(spark, "csv"))
    return readers.read_source_csv(spark, path, delimiter=";", headers=-1)


@query(
    "S01_read_source_csv_legacy_charset",
    f"{RAW} SELECT CAST(rid AS VARCHAR) AS id, '東' || st AS \"町名\" FROM raw",
)
def _(spark, sf_dir):
    @F.pandas_udf("string")
    def as_latin(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t.encode("shift-jis").decode("latin-1"))

    rows = view(spark, sf_dir, "addr_raw").select(
        F.col("rid").cast("string").alias("a"), as_latin(F.concat(F.lit("東"), "st")).alias("b")
    )
    name = "町名".encode("shift-jis").decode("latin-1")
    path = scratch_path(spark, "sjis")
    named = rows.select(F.col("a").alias("id"), F.col("b").alias(name))
    named.write.option("header", "true").option("encoding", "ISO-8859-1").csv(path)
    return readers.read_source_csv(spark, path, encoding="shift-jis")


# --- features -----------------------------------------------------------------------

RING = "concat('[[', x0, ',', y0, '],[', x0 + w, ',', y0, '],[', x0 + w, ',', y0 + h, '],[', x0, ',', y0 + h, '],[', x0, ',', y0, ']]')"
GEOMETRY = (
    f"CASE id % 4 WHEN 0 THEN concat('{{\"type\": \"Point\", \"coordinates\": [', x0, ',', y0, ']}}') "
    f"WHEN 1 THEN concat('{{\"type\": \"Polygon\", \"coordinates\": [', {RING}, ']}}') "
    f"WHEN 2 THEN concat('{{\"type\": \"LineString\", \"coordinates\": [[', x0, ',', y0, '],[', x0 + w, ',', y0 + h, ']]}}') ELSE 'null' END"
)
FEATURE = f"concat('{{\"type\": \"Feature\", \"properties\": {{\"n\": \"', id, '\", \"k\": ', id % 10, '}}, \"geometry\": ', {GEOMETRY}, '}}')"
CENTERS = (
    f"WITH {SHAPES_SQL} SELECT CAST(id AS VARCHAR) AS n, CAST(id % 10 AS VARCHAR) AS k, round(x0 + CASE WHEN id % 4 = 0 THEN 0 ELSE w / 2 END, 6) AS x, "
    "round(y0 + CASE WHEN id % 4 = 0 THEN 0 ELSE h / 2 END, 6) AS y FROM shapes WHERE id % 4 <> 3"
)


def centers(df):
    number = lambda c: F.round(F.col(f"`{c}`").cast("double"), 6)
    return df.select("n", "k", number(X_COLUMN).alias("x"), number(Y_COLUMN).alias("y"))


@query("S02_read_geojson_lines", CENTERS)
def _(spark, sf_dir):
    path = lines_to(shapes(spark, sf_dir).selectExpr(f"{FEATURE} AS value"), scratch_path(spark, "geojsonl"))
    return centers(readers.read_geojson(spark, path, lines=True))


def pages_of(df, value: str, size: int = 500):
    """Documents of some rows each, as a writer of pages would leave them."""
    page = F.floor(F.col("id") / size).alias("page")
    return df.select(page, F.expr(value).alias("v")).groupBy("page").agg(F.array_join(F.collect_list("v"), ",").alias("v"))


@query("S02_read_geojson", CENTERS)
def _(spark, sf_dir):
    pages = pages_of(shapes(spark, sf_dir), FEATURE)
    whole = pages.select(F.concat(F.lit('{"type": "FeatureCollection", "features": ['), "v", F.lit("]}")).alias("value"))
    path = scratch_path(spark, "geojson")
    whole.write.option("maxRecordsPerFile", 1).text(path)
    return centers(readers.read_geojson(spark, path))


ESRI = (
    f"concat('{{\"attributes\": {{\"n\": \"', id, '\", \"k\": ', id % 10, ', \"z\": 1}}', CASE id % 4 WHEN 3 THEN '' ELSE concat(', \"geometry\": ', CASE id % 4 "
    f"WHEN 0 THEN concat('{{\"x\": ', x0, ', \"y\": ', y0, '}}') WHEN 1 THEN concat('{{\"rings\": [', {RING}, ']}}') "
    f"ELSE concat('{{\"paths\": [[[', x0, ',', y0, '],[', x0 + w, ',', y0 + h, ']]]}}') END) END, '}}')"
)


@query("S03_read_esri_features", CENTERS)
def _(spark, sf_dir):
    pages = pages_of(shapes(spark, sf_dir), ESRI)
    whole = pages.select(
        F.concat(F.lit('{"fields": [{"name": "n"}, {"name": "k"}], "features": ['), "v", F.lit("]}")).alias("value")
    )
    path = scratch_path(spark, "esri")
    whole.write.option("maxRecordsPerFile", 1).text(path)
    return centers(readers.read_esri_features(spark, path))


@query(
    "S04_read_xml_features",
    f"WITH {SHAPES_SQL} SELECT CAST(id AS VARCHAR) AS n, CAST(id % 10 AS VARCHAR) AS k, round(x0, 6) AS x, round(y0, 6) AS y FROM shapes",
)
def _(spark, sf_dir):
    row = (
        "concat('<place><n>', id, '</n><k>', id % 10, '</k><geometryProperty><Point><coordinates>', x0, ',', y0, "
        "'</coordinates></Point></geometryProperty></place>')"
    )
    pages = pages_of(shapes(spark, sf_dir), row)
    body = F.replace("v", F.lit("</place>,<place>"), F.lit("</place><place>"))
    path = scratch_path(spark, "xml")
    whole = pages.select(F.concat(F.lit("<places>"), body, F.lit("</places>")).alias("value"))
    whole.write.option("maxRecordsPerFile", 1).text(path)
    rows = readers.read_xml_features(spark, path, "place", ["n", "k"], "geometryProperty.Point.coordinates")
    return centers(rows)


# --- archives and lists of files ---------------------------------------------------------


@query(
    "S05_read_zipped_csv",
    f"{RAW} SELECT CAST(rid AS VARCHAR) AS rid, coalesce(city, '') AS city, 'part' || CAST(rid // 500 AS VARCHAR) || '.csv' AS member FROM raw",
)
def _(spark, sf_dir):
    def archive(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as out:
            out.writestr("README.txt", "about")
            out.writestr(f"part{key[0]}.csv", frame[["rid", "city"]].to_csv(index=False))
        with open(f"{folder}/{key[0]}.zip", "wb") as file:
            file.write(buffer.getvalue())
        return pd.DataFrame({"n": [len(frame)]})

    # Spark writes no archives: tasks write them with plain file calls.
    folder = re.sub("^file:/+", "/", scratch_path(spark, "zips"))
    os.makedirs(folder)
    rows = view(spark, sf_dir, "addr_raw").select("rid", F.coalesce("city", F.lit("")).alias("city"))
    grouped = rows.groupBy(F.floor(F.col("rid") / 500).alias("a")).applyInPandas(archive, "n long")
    grouped.agg(F.sum("n")).collect()
    return readers.read_zipped_csv(spark, folder, ["rid", "city"]).select("rid", "city", "member")


FILES = {
    "grp": "l_orderkey",
    "position": "l_linenumber",
    "path": "concat('d', CAST(l_partkey % 3 AS STRING), '/f', CAST(l_suppkey % 7 AS STRING), split_part('.csv,.CSV,.txt,.shp,.json', ',', CAST(l_partkey % 5 + 1 AS INT)))",
}
FILES_SQL = (
    "files AS (SELECT grp, position, min(path) AS path FROM (SELECT " + ", ".join(f"{e} AS {n}" for n, e in FILES.items()) + " FROM lineitem) GROUP BY 1, 2)"
)


def files(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in FILES.items()])
    return rows.groupBy("grp", "position").agg(F.min("path").alias("path"))


@query(
    "S06_select_source_file",
    f"WITH {FILES_SQL} SELECT grp, coalesce(min_by(path, position) FILTER (lower(path) LIKE '%.csv'), min_by(path, position)) AS csv, "
    "CASE WHEN count(*) FILTER (path LIKE '%.json') = 1 THEN min(path) FILTER (path LIKE '%.json') END AS geojson, "
    "CASE WHEN count(*) FILTER (path LIKE '%.shp') = 1 THEN min(path) FILTER (path LIKE '%.shp') ELSE min_by(path, position) FILTER (path LIKE '%/f3.shp') END AS shp, "
    "min_by(path, position) FILTER (path LIKE '%/f2.csv') AS named FROM files GROUP BY 1",
)
def _(spark, sf_dir):
    listed = files(spark, sf_dir)
    choices = {
        "csv": {"format": "csv"}, "geojson": {"format": "geojson"},
        "shp": {"format": "shapefile", "file": "f3.shp"}, "named": {"format": "csv", "file": "x/f2.csv"},
    }
    made = [
        changes.select_source_file(listed, ["grp"], spec).withColumnRenamed("source_path", name)
        for name, spec in choices.items()
    ]
    out = made[0]
    for other in made[1:]:
        out = out.join(other, "grp")
    return out


@query(
    "S07_expand_member_names",
    f"WITH {FILES_SQL}, up AS (SELECT grp, position, lower(path) AS p FROM files) SELECT grp, position, unnest(CASE WHEN p LIKE '%.shp' "
    "THEN [left(p, length(p) - 4) || '.shp', left(p, length(p) - 4) || '.shx', left(p, length(p) - 4) || '.dbf', left(p, length(p) - 4) || '.prj'] ELSE [p] END) AS name FROM up",
)
def _(spark, sf_dir):
    named = files(spark, sf_dir)
    return named.select("grp", "position", F.explode(changes.expand_member_names(F.upper("path"))).alias("name"))


@query(
    "S08_in_archive_selection",
    f"WITH {FILES_SQL}, n AS (SELECT DISTINCT CASE WHEN grp % 9 = 0 THEN lower(path) ELSE 'd2' END AS name FROM files) "
    "SELECT grp, position, path FROM files WHERE EXISTS (SELECT 1 FROM n WHERE lower(path) = name OR starts_with(lower(path), name || '/')) "
    "UNION ALL SELECT grp, position, path FROM files WHERE position = 1 AND EXISTS (SELECT 1 FROM n WHERE lower(path) = name OR starts_with(lower(path), name || '/'))",
)
def _(spark, sf_dir):
    # Some members are listed twice; both stay.
    listed = files(spark, sf_dir)
    listed = listed.unionByName(listed.where("position = 1"))
    names = listed.select(F.when(F.col("grp") % 9 == 0, F.col("path")).otherwise(F.lit("D2/")).alias("name")).distinct()
    return changes.in_archive_selection(listed, names)


# --- writers, read back --------------------------------------------------------------------


@query("S09_write_addresses", f"WITH {LINES}, {ADDRESS_SQL} SELECT {', '.join(chr(34) + n + chr(34) for n in NAMES if n != 'CITY')}, coalesce(\"CITY\", '') AS \"CITY\", {HASH_SQL} AS \"HASH\" FROM made")
def _(spark, sf_dir):
    path = scratch_path(spark, "addresses")
    writers.write_addresses(conformed(spark, sf_dir, keep=()), path)
    return readers.read_source_csv(spark, path)


def address_points(spark, sf_dir):
    """Points on earth with the canonical columns."""
    good = points(spark, sf_dir)
    empty = [c for c in ADDRESS_COLUMNS if c not in ("LON", "LAT", "NUMBER", "STREET", "ID")]
    return good.withColumns({c: F.lit(None).cast("string") for c in empty}).withColumn("ID", F.col("pt_id").cast("string"))


@query(
    "S10_write_collections",
    f"{GOOD}, placed AS (SELECT *, {AREA_SQL} AS collection FROM good) SELECT source_base AS source, collection, CASE WHEN share_alike = 'true' THEN 'sa' ELSE 'free' END AS license_attr, "
    "count(*) AS n, CAST(sum(pt_id) AS BIGINT) AS ids FROM placed GROUP BY ALL",
)
def _(spark, sf_dir):
    from streetgrain.functions.licenses import license_class

    attr = F.when(license_class(F.col("share_alike")) == "sa", "sa").otherwise("free")
    placed = lambda rows: filters.by_area(rows).withColumnRenamed("area", "collection").withColumn("license_attr", attr)
    addresses = address_points(spark, sf_dir)
    rows = placed(addresses)
    # Few rows a source, from one pass over the points; the texts read them several times.
    facts = written(placed(addresses.groupBy("source_base", "share_alike").agg(F.count("*").alias("n"))), "facts")
    texts = statistics.license_text(
        facts.withColumns({c: F.lit(None).cast("string") for c in ("website", "license", "attribution_flag", "attribution_name")}),
        ["collection", "license_attr"], "Data.",
    )
    path = scratch_path(spark, "collections")
    writers.write_collections(rows, texts, path)
    schema = ", ".join(f"`{c}` string" for c in ["source", *ADDRESS_COLUMNS, "collection", "license_attr"])
    back = spark.read.schema(schema).option("header", "true").csv(f"{path}/addresses")
    return back.groupBy("source", "collection", "license_attr").agg(
        F.count("*").alias("n"), F.sum(F.col("ID").cast("bigint")).alias("ids")
    )


@query("S11_write_tiles", f"{GOOD}, {TILES_SQL} SELECT tile_lon, tile_lat, source_base, points FROM tiles")
def _(spark, sf_dir):
    free = address_points(spark, sf_dir).filter("NOT share_alike <=> 'true'")
    sources = spatial.tile_source_counts(free)
    texts = statistics.license_text(
        sources.withColumns({c: F.lit(None).cast("string") for c in ("website", "license", "attribution_flag", "attribution_name")}),
        ["tile_lon", "tile_lat"], "Data.",
    )
    path = scratch_path(spark, "tiles")
    writers.write_tiles(free, texts, path, folders=("tile_lon",))
    back = spark.read.option("header", "true").csv(f"{path}/addresses")
    return back.groupBy(
        F.col("tile_lon").cast("bigint").alias("tile_lon"), F.col("tile_lat").cast("bigint").alias("tile_lat"),
        F.col("`OA:Source`").alias("source_base"),
    ).agg(F.count("*").alias("points"))


def state_rows(spark, sf_dir):
    return ledger.state_columns(runs(spark, sf_dir), [k for k in RUN_STATE_KEYS if k != "code version"])


def nice(key: str) -> str:
    return (
        f"CASE WHEN {js(key)} LIKE 'http://data.example.org.s3.amazonaws.com/%' THEN 'https://data.example.org' || substr({js(key)}, 41) "
        f"WHEN {js(key)} LIKE 'https://s3.amazonaws.com/data.example.org/%' THEN regexp_replace('https://data.example.org' || substr({js(key)}, 42), '\\?.*', '') "
        f"WHEN {js(key)} LIKE 'http://data.example.org/%' THEN 'https' || substr({js(key)}, 5) ELSE {js(key)} END"
    )


STATE_SELECT = (
    f"SELECT substr(source_path, 9) AS source, {nice('cache')} AS cache, {js('sample')} AS sample, {js('geometry type')} AS \"geometry type\", {js('address count')} AS \"address count\", "
    f"{js('version')} AS version, {js('fingerprint')} AS fingerprint, {js('cache time')} AS \"cache time\", {nice('processed')} AS processed, {js('process time')} AS \"process time\", "
    f"{js('process hash')} AS \"process hash\", {nice('output')} AS output, {{required}} AS \"attribution required\", {js('attribution name')} AS \"attribution name\", "
    f"{{sa}} AS \"share-alike\", code_version AS \"code version\" FROM runs"
)


@query("S12_write_state_tsv", ledger_sql(STATE_SELECT.format(required=js("attribution required"), sa=js("share-alike"))))
def _(spark, sf_dir):
    return writers.state_table(state_rows(spark, sf_dir), "data.example.org")


@query(
    "S12_places",
    ledger_sql(", p AS (SELECT source_path, row_number() OVER (ORDER BY source_path) AS place FROM runs) "
               "SELECT substr(source_path, 9) AS source, min(place) AS first_place, max(place) AS last_place, count(*) AS n FROM p GROUP BY 1"),
)
def _(spark, sf_dir):
    return places.span_of_places(writers.state_table(state_rows(spark, sf_dir), "data.example.org").select("source"), ["source"])


@query(
    "S18_read_state_tsv",
    ledger_sql(
        STATE_SELECT.format(required=f"nullif({js('attribution required')}, '')", sa=f"nullif({js('share-alike')}, '')")
        + f" WHERE {js('cache')} IS NOT NULL AND {js('processed')} IS NOT NULL"
    ),
)
def _(spark, sf_dir):
    path = scratch_path(spark, "state")
    writers.write_state_tsv(writers.state_table(state_rows(spark, sf_dir), "data.example.org"), path)
    return readers.read_state_tsv(spark, path)


@query(
    "S13_write_geojson_lines",
    f"{GOOD} SELECT 'Feature' AS type, 'Point' AS kind, lon, lat, source_base, CAST(pt_id AS VARCHAR) AS pt_id FROM good",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "lines")
    writers.write_geojson_lines(points(spark, sf_dir).select("lon", "lat", "source_base", "pt_id"), path)
    get = lambda p: F.get_json_object("value", p)
    return spark.read.text(path).select(
        get("$.type").alias("type"), get("$.geometry.type").alias("kind"),
        get("$.geometry.coordinates[0]").cast("double").alias("lon"), get("$.geometry.coordinates[1]").cast("double").alias("lat"),
        get("$.properties.source_base").alias("source_base"), get("$.properties.pt_id").alias("pt_id"),
    )


@query(
    "S14_fingerprint_files",
    "WITH d AS (SELECT doc_id, regexp_replace(text, '\\s+', ' ', 'g') AS t FROM documents) "
    "SELECT source, md5(string_agg(md5(t) || '\n', '' ORDER BY d.doc_id)) AS fingerprint FROM d JOIN documents USING (doc_id) GROUP BY 1",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "files")
    # One file per source: content hashes of its documents in order.
    lines = docs.select("source", "doc_id", F.md5(F.regexp_replace("text", r"\s+", " ")).alias("value"))
    ordered = lines.repartition("source").sortWithinPartitions("source", "doc_id").drop("doc_id")
    ordered.write.partitionBy("source").text(path)
    prints = readers.fingerprint_files(spark, path)
    return prints.select(F.regexp_extract("path", "source=([^/]*)", 1).alias("source"), "fingerprint").filter("source <> ''")


@query(
    "S15_package_outputs",
    f"{GOOD}, s AS (SELECT source_base, count(*) AS n FROM good GROUP BY 1) SELECT source_base AS source, n, "
    "'Website: http://' || source_base || ' License: Unknown Date: 2024-01-01' AS readme FROM s",
)
def _(spark, sf_dir):
    rows = address_points(spark, sf_dir).withColumn("source", F.col("source_base"))
    rows = rows.withColumnsRenamed({"lon_text": "LON_T", "lat_text": "LAT_T"}).drop("lon", "lat").withColumnsRenamed({"LON_T": "LON", "LAT_T": "LAT"})
    sources = rows.select("source").distinct().select(
        "source", F.concat(F.lit("http://"), "source").alias("website"), F.lit(None).cast("string").alias("license"),
        F.lit("2024-01-01").alias("date"),
    )
    # From one pass over the points; the readmes and the lists of folders read it.
    sources = written(sources, "sources")
    path, out = scratch_path(spark, "packages"), scratch_path(spark, "packaged")
    writers.package_outputs(rows, sources, path)
    schema = ", ".join(f"`{c}` string" for c in [*ADDRESS_COLUMNS, "source"])
    found = "source string, n bigint, readme string"
    spark.createDataFrame([], found).write.parquet(out)
    for folders in readers.folder_names(sources.select("source")):
        counts = readers.read_folders(spark, f"{path}/data", folders, "csv", schema, header="true").groupBy("source").agg(F.count("*").alias("n"))
        notes = readers.read_folders(spark, f"{path}/readme", folders, "text", "value string, source string", lineSep="\x00")
        readme = notes.select("source", F.trim(F.regexp_replace("value", r"\n+", " ")).alias("readme"))
        counts.join(readme, "source").write.mode("append").parquet(out)
    return spark.read.schema(found).parquet(out)


@query("S16_excerpt", f"{RAW}, w AS (SELECT rid, 'POLYGON ((' || num || ' 1))' AS wkt FROM raw) SELECT rid, wkt, 'Polygon' AS geometry_type FROM w ORDER BY rid LIMIT 5")
def _(spark, sf_dir):
    rows = view(spark, sf_dir, "addr_raw").select("rid", F.concat(F.lit("POLYGON (("), "num", F.lit(" 1))")).alias("wkt"))
    return readers.excerpt(rows, ["rid"], 5, "wkt")


@query(
    "S17_read_source_definitions",
    "SELECT 'nation=' || CAST(c_nationkey AS VARCHAR) AS folder, CAST(sum(c_custkey) AS BIGINT) AS keys, count(*) AS n FROM customer GROUP BY 1",
)
def _(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "definitions")
    rows = customers.select(F.col("c_nationkey").alias("nation"), F.to_json(F.struct("c_custkey", "c_name")).alias("value"))
    # Several definitions per file keep the count of test files small.
    rows.repartition("nation").write.partitionBy("nation").json(path)
    found = readers.read_source_definitions(spark, path)
    folder = F.regexp_extract("path", "^(nation=[^/]*)/", 1)
    each = found.select(folder.alias("folder"), F.explode(F.split("definition", "\n")).alias("line")).filter("line <> ''")
    key = F.get_json_object(F.get_json_object("line", "$.value"), "$.c_custkey").cast("bigint")
    return each.groupBy("folder").agg(F.sum(key).alias("keys"), F.count("*").alias("n"))


@query(
    "J15_parcel_attributes",
    f"WITH {SHAPES_SQL} SELECT CAST(id AS VARCHAR) AS \"ID\", 'POLYGON ((' || CAST(id AS VARCHAR) || ' 0, 1 0, 1 1, 0 0))' AS geom, '' AS \"STREET\" FROM shapes WHERE id % 3 <> 0",
)
def _(spark, sf_dir):
    from streetgrain.plans.process import parcel_table

    kind = F.when(F.col("id") % 3 == 0, F.lit("POINT (")).otherwise(F.lit("POLYGON (("))
    rest = F.when(F.col("id") % 3 == 0, F.lit(" 0)")).otherwise(F.lit(" 0, 1 0, 1 1, 0 0))"))
    text = F.concat(kind, F.col("id").cast("string"), rest)
    rows = shapes(spark, sf_dir).select(
        F.col("id").cast("string").alias("APN"), F.lit(None).cast("string").alias("Street"), text.alias("OA:geom")
    )
    return parcel_table(rows, {"id": "apn", "street": "street"}, "p").select("ID", "geom", "STREET")
