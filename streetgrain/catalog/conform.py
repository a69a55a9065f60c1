"""Check queries: conform functions on unconformed address rows."""

from pyspark.sql import functions as F

from streetgrain.catalog.base import query
from streetgrain.catalog.views import table, view, view_sql
from streetgrain.functions import conform as C
from streetgrain.functions import licenses, rules, text
from streetgrain.functions.numbers import round_coordinates
from streetgrain.plans.process import check_tests_of_sources, extract_and_reproject
from streetgrain.schema import ADDRESS_COLUMNS

RAW = f"WITH raw AS ({view_sql('addr_raw')})"
LINES = f"raw AS ({view_sql('addr_raw_lines')})"

NUM = r"[0-9]+(?:[ -][0-9]/[0-9])?|[0-9]+-[0-9]+|[0-9]+-?[A-Z]"
UNIT = r"(?:(?:UNIT|APARTMENT|APT\.?|SUITE|STE\.?|BUILDING|BLDG\.?|LOT)\s+|#).+"
PREFIXED_NUMBER = rf"(?i)^\s*({NUM})\s+"
STREET = rf"(?i)^(?:\s*(?:{NUM})\s+)?(.*)"
STREET_UNITS = rf"(?i)^(?:\s*(?:{NUM})\s+)?(.+?)(?:\s+{UNIT})?$"
UNIT_END = rf"(?i)\s({UNIT})$"


def raw(spark, sf_dir):
    return view(spark, sf_dir, "addr_raw")


def attribute(spark, sf_dir, rule, attribute="street"):
    """One attribute of a specification next to the row id."""
    rows = raw(spark, sf_dir)
    values, _ = C.compile_attributes({attribute: rule}, rows.columns)
    return rows.select("rid", values[attribute].alias("v"))


def simple(name, rule, sql):
    query(name, f"{RAW} SELECT rid, {sql} AS v FROM raw")(lambda s, d: attribute(s, d, rule))


simple("C01_field", "address", "address")
simple("C02_merge", ["num", "st", "city"], "CASE WHEN city IS NULL THEN num || ' ' || st ELSE num || ' ' || st || ' ' || city END")
simple(
    "C03_join",
    {"function": "join", "fields": ["district", "city", "region", "st"], "separator": "-"},
    "array_to_string(list_filter([trim(coalesce(district, '')), trim(coalesce(city, '')), trim(region), trim(st)], lambda x: x <> ''), '-')",
)
simple(
    "C04_regexp_extract",
    {"function": "regexp", "field": "address", "pattern": r"^(\d+)[^ ]* (\w+)"},
    "regexp_extract(address, '^([0-9]+)[^ ]* ([0-9A-Za-z_]+)', 1) || regexp_extract(address, '^([0-9]+)[^ ]* ([0-9A-Za-z_]+)', 2)",
)
simple(
    "C05_regexp_replace",
    {"function": "regexp", "field": "address", "pattern": r"(\w+) (ST|AVE)\b", "replace": "${2}1 $1"},
    r"regexp_replace(address, '([0-9A-Za-z_]+) (ST|AVE)\b', '\21 \1', 'g')",
)
simple("C06_prefixed_number", {"function": "prefixed_number", "field": "address"}, f"regexp_extract(address, '{PREFIXED_NUMBER}', 1)")
simple("C07_postfixed_street", {"function": "postfixed_street", "field": "address"}, f"regexp_extract(address, '{STREET}', 1)")
simple(
    "C08_postfixed_street_units",
    {"function": "postfixed_street", "field": "address", "may_contain_units": True},
    f"regexp_extract(address, '{STREET_UNITS}', 1)",
)
simple("C09_postfixed_unit", {"function": "postfixed_unit", "field": "address"}, f"regexp_extract(address, '{UNIT_END}', 1)")
simple(
    "C10_remove_prefix",
    {"function": "remove_prefix", "field": "address", "field_to_remove": "num"},
    "CASE WHEN starts_with(address, num) THEN ltrim(substr(address, length(num) + 1)) ELSE address END",
)
simple(
    "C11_remove_postfix",
    {"function": "remove_postfix", "field": "address", "field_to_remove": "ut"},
    "CASE WHEN ut <> '' AND ends_with(address, ut) THEN rtrim(left(address, length(address) - length(ut))) ELSE address END",
)
simple(
    "C12_format",
    {"function": "format", "fields": ["city", "zip", "region"], "format": "at $1, $2-$3 end"},
    """CASE WHEN trim(coalesce(city, '')) = '' THEN 'at ' ELSE 'at ' || trim(city) END
    || CASE WHEN trim(coalesce(city, '')) <> '' THEN ', ' ELSE '' END || regexp_replace(zip, '\\.0$', '')
    || CASE WHEN region <> '' THEN '-' || region ELSE '' END || ' end'""",
)
simple(
    "C13_chain",
    {
        "function": "chain", "variable": "scratch",
        "functions": [
            {"function": "format", "fields": ["num", "st", "ut"], "format": "$1 $2 $3"},
            {"function": "remove_postfix", "field": "scratch", "field_to_remove": "ut"},
            {"function": "remove_prefix", "field": "scratch", "field_to_remove": "num"},
        ],
    },
    "trim(st)",
)
simple(
    "C14_first_non_empty", {"function": "first_non_empty", "fields": ["city", "region", "district"]},
    "CASE WHEN trim(coalesce(city, '')) <> '' THEN city WHEN region <> '' THEN region ELSE district END",
)
simple(
    "C15_get", {"function": "get", "field": "tags", "index": -2},
    "string_split(replace(replace(replace(replace(tags, '[', ''), ']', ''), '''', ''), ', ', ','), ',')[-2]",
)


@query("C16_smash_case", f"{RAW} SELECT rid, num, zip, lower(st) AS st2 FROM raw")
def _(spark, sf_dir):
    upper = raw(spark, sf_dir).select(F.col("rid").alias("RID"), F.col("num").alias("NUM"), F.col("zip").alias("Zip"), "st")
    low = C.smash_case(upper)
    spec = C.lower_spec({"street": {"function": "join", "fields": ["ST"]}})
    values, _ = C.compile_attributes(spec, low.columns)
    return low.select("rid", "num", "zip", F.lower(values["street"]).alias("st2"))


@query(
    "C17_canonicalize",
    f"{RAW} SELECT rid, regexp_replace(trim(' ' || zip), '\\.0$', '') AS number, trim(district) AS street, trim(coalesce(city, '')) AS unit FROM raw",
)
def _(spark, sf_dir):
    return raw(spark, sf_dir).select(
        "rid", C.canonical_number(F.concat(F.lit(" "), "zip")).alias("number"),
        C.canonical_text(F.col("district")).alias("street"), C.canonical_text(F.col("city")).alias("unit"),
    )


def coordinate_sql(column: str) -> str:
    """Seven decimals without padding; the texts at hand have no exact ties."""
    number = f"CAST(round(CAST({column} AS DECIMAL(24, 12)), 7) AS DECIMAL(24, 7))"
    return rf"regexp_replace(regexp_replace(CAST({number} AS VARCHAR), '(\.[0-9]*?)0+$', '\1'), '\.$', '')"


@query("C18_round_lon_lat", f"{RAW} SELECT rid, {coordinate_sql('zlon')} AS lon, {coordinate_sql('zlat')} AS lat FROM raw")
def _(spark, sf_dir):
    rows = raw(spark, sf_dir).select("rid", F.col("zlon").alias("lon"), F.col("zlat").alias("lat"))
    return round_coordinates(rows, ["lon", "lat"])


def json_pairs_sql(pairs: dict[str, str]) -> str:
    quoted = lambda e: (
        f"coalesce('\"' || replace(replace({e}, '\\', '\\\\'), '\"', '\\\"') || '\"', 'null')"
    )
    parts = [f"'[\"{n}\",' || {quoted(e)} || ']'" for n, e in sorted(pairs.items())]
    return "'[' || " + " || ',' || ".join(parts) + " || ']'"


@query(
    "C19_row_hash",
    f"{RAW} SELECT rid, substr(sha1('0000' || {json_pairs_sql({'NUMBER': 'num', 'CITY': 'city', 'STREET': 'address', 'ID': 'tags'})}), 1, 16) AS hash FROM raw",
)
def _(spark, sf_dir):
    columns = {"NUMBER": "num", "CITY": "city", "STREET": "address", "ID": "tags"}
    return raw(spark, sf_dir).select("rid", C.row_hash("0000", {n: F.col(c) for n, c in columns.items()}).alias("hash"))


@query("X02_json_ascii_escaping")
def _(spark, sf_dir):
    """Row hashes of whole non-ASCII texts; checked against Python in the tests."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", C.row_hash("0000", {"STREET": F.col("text")}).alias("hash"))


@query(
    "C20_to_address_schema",
    f"{RAW} SELECT rid, zip AS \"POSTCODE\", city AS \"CITY\", num || ' ' || st AS \"STREET\", CAST(NULL AS VARCHAR) AS \"DISTRICT\" FROM raw",
)
def _(spark, sf_dir):
    rows = raw(spark, sf_dir)
    values, _ = C.compile_attributes({"postcode": "zip", "city": "City", "street": ["num", "st"], "district": "nowhere"}, rows.columns)
    names = {"postcode": "POSTCODE", "city": "CITY", "street": "STREET", "district": "DISTRICT"}
    return rows.select("rid", *[values[k].alias(v) for k, v in names.items()])


SPEC = {
    "format": "csv", "lon": "zlon", "lat": "zlat",
    "number": {"function": "prefixed_number", "field": "address"},
    "street": {"function": "postfixed_street", "field": "address", "may_contain_units": True},
    "unit": {"function": "postfixed_unit", "field": "address"},
    "city": "city",
    "district": {"function": "join", "fields": ["district"]},
    "region": "region",
    "postcode": {"function": "regexp", "field": "zip", "pattern": r"^(\d+)"},
    "id": {"function": "get", "field": "tags", "index": 0},
}

ADDRESS_SQL = f"""made AS (SELECT rid, {coordinate_sql('zlon')} AS "LON", {coordinate_sql('zlat')} AS "LAT",
 regexp_replace(trim(regexp_extract(address, '{PREFIXED_NUMBER}', 1)), '\\.0$', '') AS "NUMBER",
 trim(regexp_extract(address, '{STREET_UNITS}', 1)) AS "STREET", trim(regexp_extract(address, '{UNIT_END}', 1)) AS "UNIT",
 city AS "CITY", trim(district) AS "DISTRICT", region AS "REGION", regexp_extract(zip, '^([0-9]+)', 1) AS "POSTCODE",
 string_split(replace(replace(replace(replace(tags, '[', ''), ']', ''), '''', ''), ', ', ','), ',')[1] AS "ID" FROM raw)"""
NAMES = [c for c in ADDRESS_COLUMNS if c != "HASH"]
HASH_SQL = "substr(sha1('f00d' || " + json_pairs_sql({n: f'"{n}"' for n in NAMES}) + "), 1, 16)"


def conformed(spark, sf_dir, name="addr_raw_lines", keep=("rid",)):
    rows = view(spark, sf_dir, name)
    return C.conform(extract_and_reproject(rows, SPEC), SPEC, "f00d", keep=keep)


@query("C21_conform", f"WITH {LINES}, {ADDRESS_SQL} SELECT *, {HASH_SQL} AS \"HASH\" FROM made")
def _(spark, sf_dir):
    return conformed(spark, sf_dir).select("rid", *ADDRESS_COLUMNS)


@query(
    "C22_extract_and_reproject",
    f"{RAW} SELECT rid, CASE WHEN lat_comma IS NULL THEN NULL ELSE replace(lon_comma, ',', '.') END AS x, replace(lat_comma, ',', '.') AS y, st FROM raw",
)
def _(spark, sf_dir):
    rows = raw(spark, sf_dir).withColumnsRenamed({"lon_comma": "LON_COMMA"})
    out = extract_and_reproject(rows, {"format": "csv", "lon": "lon_comma", "lat": "lat_comma"})
    return out.select("rid", F.col("`OA:x`").alias("x"), F.col("`OA:y`").alias("y"), "st")


@query("C22_extract_and_reproject_srs")
def _(spark, sf_dir):
    rows = raw(spark, sf_dir)
    out = extract_and_reproject(rows, {"format": "csv", "lon": "zlon", "lat": "zlat", "srs": "EPSG:3857"})
    return out.select("rid", F.col("`OA:x`").alias("x"), F.col("`OA:y`").alias("y"))


@query(
    "C23_check_acceptance_tests",
    f"{RAW}, t AS (SELECT o_custkey AS source, o_orderkey AS index, trim(regexp_extract(address, '{PREFIXED_NUMBER}', 1)) AS got, num, address "
    "FROM raw JOIN orders ON rid = o_orderkey) SELECT source, bool_and(got = num) AS passed, "
    "min_by('For test ' || CAST(index AS VARCHAR) || ', expected NUMBER = ' || num || ' but got ' || got, index) FILTER (got <> num) AS message FROM t GROUP BY 1",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("rid"), F.col("o_custkey").alias("source"))
    rows = raw(spark, sf_dir).join(orders, "rid")
    tests = rows.select(
        "source", F.col("rid").alias("index"), F.concat(F.lit("test "), F.col("rid").cast("string")).alias("description"),
        F.create_map(F.lit("address"), F.col("address")).alias("inputs"),
        F.create_map(F.lit("NUMBER"), F.col("num")).alias("expected"),
    )
    return check_tests_of_sources(tests, {"number": {"function": "prefixed_number", "field": "address"}})


# --- licence tags, definitions, logs --------------------------------------------------

# Definitions derived from the orders: every mix of old and new licence tags.
DEFINITIONS = {
    "id": "o_orderkey",
    "license": "CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '\"Public Domain\"' WHEN 2 THEN '{\"text\": \"CC\", \"url\": \"http://cc\"}' "
    "WHEN 3 THEN '{\"url\": \"http://cc\"}' WHEN 4 THEN '{\"text\": \"CC\"}' WHEN 5 THEN '{\"attribution name\": \"Joe\", \"share-alike\": \"Yes\"}' "
    "WHEN 6 THEN '{\"attribution\": false, \"share-alike\": false}' WHEN 7 THEN '{\"attribution\": null, \"attribution name\": \"Ann\", \"share-alike\": \"maybe\"}' "
    "ELSE '{\"attribution\": true, \"share-alike\": true, \"text\": \"T\"}' END",
    "attribution": "CASE o_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'false' WHEN 2 THEN '\"\"' ELSE '\"City of X\"' END",
    "coverage": "CASE o_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '{\"ISO 3166\": {\"alpha2\": \"fr\"}}' WHEN 2 THEN '{\"US Census\": {\"geoid\": \"06\"}}' "
    "WHEN 3 THEN '{\"geometry\": {\"type\": \"Point\"}}' ELSE '{\"city\": \"x\"}' END",
    "log": "split_part('fine|x WARNING: A source test failed y|WARNING: Source is missing a conform object|WARNING: Unknown source conform protocol|"
    "WARNING: Unknown source conform format|WARNING: Unknown source conform type|WARNING: Found no addresses in source data|"
    "WARNING: Could not download source data|WARNING: Error doing conform; skipping|nothing', '|', CAST(o_orderkey % 10 + 1 AS INT))",
}
DEF_SQL = "WITH defs AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in DEFINITIONS.items()) + " FROM orders)"


def definitions(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in DEFINITIONS.items()])


@query(
    "C24_conform_license",
    f"{DEF_SQL} SELECT id, CASE id % 9 WHEN 1 THEN 'Public Domain' WHEN 2 THEN 'CC (http://cc)' WHEN 3 THEN 'http://cc' WHEN 4 THEN 'CC' WHEN 8 THEN 'T' END AS license FROM defs",
)
def _(spark, sf_dir):
    return definitions(spark, sf_dir).select("id", licenses.license_text(F.col("license")).alias("license"))


@query(
    "C25_conform_attribution",
    f"{DEF_SQL}, old AS (SELECT id, id % 9 AS k, coalesce(attribution = '\"City of X\"', FALSE) AS o FROM defs), "
    "f AS (SELECT id, CASE k WHEN 5 THEN TRUE WHEN 6 THEN FALSE WHEN 7 THEN TRUE WHEN 8 THEN TRUE ELSE o END AS flag, "
    "CASE k WHEN 5 THEN 'Joe' WHEN 7 THEN 'Ann' ELSE CASE WHEN o THEN 'City of X' END END AS name FROM old) "
    "SELECT id, flag, CASE WHEN flag THEN name END AS name FROM f",
)
def _(spark, sf_dir):
    made = licenses.attribution(F.col("license"), F.col("attribution"))
    return definitions(spark, sf_dir).select("id", made.alias("a")).select("id", "a.*")


@query(
    "C26_conform_sharealike",
    f"{DEF_SQL} SELECT id, CASE id % 9 WHEN 5 THEN TRUE WHEN 6 THEN FALSE WHEN 8 THEN TRUE END AS share_alike FROM defs",
)
def _(spark, sf_dir):
    return definitions(spark, sf_dir).select("id", licenses.share_alike(F.col("license")).alias("share_alike"))


V1 = "concat('{\"coverage\":', coalesce(coverage, '{}'), ',\"data\":\"d', CAST(id AS STRING), '\",\"conform\":{\"format\":\"csv\"}}')"


@query(
    "C27_upgrade_source_schema",
    f"{DEF_SQL} SELECT id, 'primary' AS name, 'd' || CAST(id AS VARCHAR) AS data, 'csv' AS format, replace(coalesce(coverage, '{{}}'), ' ', '') AS coverage, "
    "1 AS layers FROM defs",
)
def _(spark, sf_dir):
    v1 = definitions(spark, sf_dir).select("id", F.expr(V1).alias("d"))
    v2 = v1.select("id", rules.upgrade_source_schema(F.col("d")).alias("d"))
    get = lambda p: F.get_json_object("d", p)
    return v2.select(
        "id", get("$.layers.addresses[0].name").alias("name"), get("$.layers.addresses[0].data").alias("data"),
        get("$.layers.addresses[0].conform.format").alias("format"),
        F.replace(get("$.coverage"), F.lit(" "), F.lit("")).alias("coverage"),
        F.size(F.from_json(get("$.layers.addresses"), "array<string>")).alias("layers"),
    )


@query(
    "C28_required_fields",
    f"{RAW} SELECT address, city, district, region, tags, zip, count(*) AS rows FROM raw GROUP BY ALL",
)
def _(spark, sf_dir):
    fields = C.required_fields(SPEC)
    return raw(spark, sf_dir).select(*fields).groupBy(*fields).agg(F.count("*").alias("rows"))


PROBLEM_SQL = (
    "CASE id % 10 WHEN 1 THEN 'An acceptance test failed' WHEN 2 THEN 'Source is missing a conform object' WHEN 3 THEN 'Unknown source conform protocol' "
    "WHEN 4 THEN 'Unknown source conform format' WHEN 5 THEN 'Unknown source conform type' WHEN 6 THEN 'Found no addresses in source data' "
    "WHEN 7 THEN 'Could not download source data' WHEN 8 THEN 'Could not conform source data' "
    "ELSE CASE WHEN coverage IS NULL OR coverage LIKE '%city%' THEN 'Missing or incomplete coverage' END END"
)
DEFINITION = "concat('{\"n\":1', coalesce(concat(',\"coverage\":', coverage), ''), '}')"


@query("C29_find_source_problem", f"{DEF_SQL} SELECT id, {PROBLEM_SQL} AS problem FROM defs")
def _(spark, sf_dir):
    d = definitions(spark, sf_dir).withColumn("d", F.expr(DEFINITION))
    return d.select("id", rules.source_problem(F.col("log"), F.col("d")).alias("problem"))


@query("P05_coverage_complete", f"{DEF_SQL} SELECT id, coalesce(coverage NOT LIKE '%city%', FALSE) AS complete FROM defs")
def _(spark, sf_dir):
    d = definitions(spark, sf_dir).withColumn("d", F.expr(DEFINITION))
    return d.select("id", rules.coverage_complete(F.col("d")).alias("complete"))


# --- names of downloads -----------------------------------------------------------------

PATH = r"regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
HOST = r"regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"
QUERY = r"regexp_extract(url, '^[^?#]*\?([^#]*)', 1)"
EXT = rf"regexp_extract({PATH}, '[^/.][^/]*?(\.[^./]*)$', 1)"
TYPES = "text/html; charset=utf-8,application/zip,application/json,application/pdf,text/csv"


@query(
    "C30_guess_extension",
    f"SELECT page_id, CASE WHEN {QUERY} = '' AND {EXT} NOT IN ('', '.cgi', '.php', '.aspx', '.asp', '.do') THEN {EXT} "
    "WHEN page_id % 3 = 0 AND page_id % 5 <> 2 THEN '.txt' "
    "ELSE CASE page_id % 5 WHEN 0 THEN '.html' WHEN 1 THEN '.zip' WHEN 2 THEN '.json' WHEN 3 THEN '.txt' ELSE '.csv' END END AS extension FROM pages",
)
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").selectExpr(
        "page_id", "url", f"split_part('{TYPES}', ',', CAST(page_id % 5 + 1 AS INT)) AS content_type",
        "CASE WHEN page_id % 3 = 0 THEN concat('attachment; filename=\"f', CAST(page_id AS STRING), '.json\"') END AS disposition",
    )
    guessed = text.guess_extension(F.col("url"), F.col("content_type"), F.col("disposition"), F.lit("text/plain"))
    return pages.select("page_id", guessed.alias("extension"))


@query(
    "C31_stable_name",
    f"SELECT page_id, 'us-ca-' || substr(sha1({HOST} || left({PATH}, length({PATH}) - length({EXT}))), 1, 8) AS name FROM pages",
)
def _(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.stable_name("us-ca", F.col("url")).alias("name"))


STORED = (
    "CASE page_id % 4 WHEN 0 THEN concat('http://data.example.org', regexp_extract(url, '(/[a-z]+/.*)$', 1)) "
    "WHEN 1 THEN concat('http://s3.amazonaws.com/data.example.org', regexp_extract(url, '(/[a-z]+/.*)$', 1)) "
    "WHEN 2 THEN concat('https://data.example.org.s3.amazonaws.com', regexp_extract(url, '(/[a-z]+/.*)$', 1)) ELSE url END"
)


@query(
    "C32_canonical_url",
    f"SELECT page_id, CASE WHEN page_id % 4 = 3 THEN url ELSE 'https://data.example.org' || {PATH} END AS url FROM pages",
)
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").selectExpr("page_id", f"{STORED} AS url")
    return pages.select("page_id", text.canonical_url(F.col("url"), "data.example.org").alias("url"))


def _initials(spec, scope, target):
    field = scope.get(spec["field"])
    return C.Compiled(F.upper(F.substring(field, 1, 2)), [(field.isNull(), "nothing to shorten")])


@query("X01_register_conform_function", f"{RAW} SELECT rid, upper(substr(st, 1, 2)) AS v FROM raw")
def _(spark, sf_dir):
    C.register_conform_function("initials", _initials)
    return attribute(spark, sf_dir, {"function": "initials", "field": "st"})
