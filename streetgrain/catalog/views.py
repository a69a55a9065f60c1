"""Address-data views over the generic test tables.

Every view is a projection of one base table (``boxes`` adds an aggregation),
written once as ``name -> expression`` in SQL that Spark and the check engine
both read. Where the two dialects differ the expression is a pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Expression = str | tuple[str, str]

_LON = "((l_partkey*7919 + l_orderkey*104729) % 3600000 - 1800000)"
_LAT = "((l_suppkey*15485863 + l_orderkey*7919) % 1800000 - 900000)"
_AREAS = "us/ca,us/ny,us-tx,us/il,de,fr,jp,br,mx,za,gb,us/va,ca,nz"


def _fixed(value: str) -> str:
    """Plain decimal text with four places for a count of 1e-4 units."""
    return f"CAST(CAST({value} / 10000.0 AS DECIMAL(12, 4)) AS STRING)"


def _source(key: str) -> str:
    return f"concat(split_part('{_AREAS}', ',', CAST({key} % 14 + 1 AS INT)), '/city', CAST({key} AS STRING))"


# Points: one row per line item, with a share of dirty coordinate texts.
PTS: dict[str, Expression] = {
    "pt_id": "l_orderkey * 8 + l_linenumber",
    "source_base": _source("l_suppkey"),
    "lon": f"CAST({_LON} AS DOUBLE) / 10000",
    "lat": f"CAST({_LAT} AS DOUBLE) / 10000",
    "lon_text": "CASE WHEN l_returnflag = 'R' AND l_linenumber = 6 THEN '' WHEN l_returnflag = 'R' AND l_linenumber = 5 THEN 'NaN' "
    "WHEN l_returnflag = 'R' AND l_linenumber = 4 THEN NULL ELSE concat(CASE WHEN l_returnflag = 'R' AND l_linenumber = 3 THEN ' ' ELSE '' END, "
    + _fixed(f"{_LON} * CASE WHEN l_returnflag = 'R' AND l_linenumber = 2 THEN 2 ELSE 1 END")
    + ", CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'd' WHEN l_returnflag = 'R' AND l_linenumber = 3 THEN ' ' ELSE '' END) END",
    "lat_text": _fixed(_LAT),
    "share_alike": "CASE WHEN l_suppkey % 5 = 0 THEN 'true' WHEN l_suppkey % 5 = 1 THEN '' ELSE 'false' END",
    "number": "CAST(l_partkey % 9000 AS STRING)",
    "street": "concat('ROUTE ', CAST(l_partkey % 97 AS STRING))",
}

_STREETS = "MAPLE ST,MAIN STREET,3RD AVE,OAK DR.,51ST AVE,RUE DE PARIS,N LAKE BLVD"
_NUMBERS = "#,# 1/2,#-15,#-A,#b,#rd,"
_UNITS = ",Unit 3,APT. 4,#5,Ste 9,runit 300,Lot 12,Bldg. 7 East,suite 2,# 8,apartment 1,BUILDING C,apt 6"


def _raw(id_: str, other: str) -> dict[str, Expression]:
    number = f"replace(split_part('{_NUMBERS}', ',', CAST({id_} % 7 + 1 AS INT)), '#', CAST({other} % 997 AS STRING))"
    street = f"split_part('{_STREETS}', ',', CAST({other} % 7 + 1 AS INT))"
    unit = f"split_part('{_UNITS}', ',', CAST({other} % 13 + 1 AS INT))"
    lon = f"(({id_}*104729 + {other}*7919) % 3600000 - 1800000)"
    lat = f"(({id_}*7919 + {other}*15485863) % 1800000 - 900000)"
    return {
        "rid": id_,
        "num": number,
        "st": street,
        "ut": unit,
        "address": f"trim(concat({number}, ' ', {street}, ' ', {unit}))",
        "city": f"CASE WHEN {other} % 5 = 0 THEN NULL WHEN {other} % 5 = 1 THEN '  ' ELSE concat('CITY ', CAST({other} % 41 AS STRING)) END",
        "district": f"concat('  DIST ', CAST({other} % 9 AS STRING), ' ')",
        "region": f"CASE WHEN {id_} % 3 = 0 THEN '' ELSE 'RG' END",
        "zip": f"concat(CAST({other} % 90000 AS STRING), '.0')",
        "tags": f"concat('[''', CAST({id_} % 11 AS STRING), ''', ''', CAST({other} % 13 AS STRING), ''', ''z'']')",
        "zlon": f"concat({_fixed(lon)}, lpad(CAST({other} % 9973 AS STRING), 4, '0'), '7')",
        "zlat": f"concat({_fixed(lat)}, CASE WHEN {id_} % 2 = 0 THEN '00' ELSE '' END)",
        "lon_comma": f"replace({_fixed(lon)}, '.', ',')",
        "lat_comma": f"CASE WHEN {id_} % 17 = 0 THEN NULL ELSE replace({_fixed(lat)}, '.', ',') END",
    }


# Unconformed source rows.
ADDR_RAW = _raw("o_orderkey", "o_custkey")
ADDR_RAW_LINES = _raw("l_orderkey", "l_partkey")

_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"
_PATH_NO = "((CAST(floor(event_id / 5) AS BIGINT) * 7919) % 211)"
_CENTS = "CAST(round(value * 100) AS BIGINT)"
_DONE = "(event_type = 'view' OR event_type = 'purchase')"


def _clock(seconds: str) -> str:
    return (
        f"concat(CAST(CAST(floor({seconds} / 3600) AS BIGINT) AS STRING), ':', "
        f"lpad(CAST(CAST(floor({seconds} / 60) AS BIGINT) % 60 AS STRING), 2, '0'), ':', "
        f"lpad(CAST({seconds} % 60 AS STRING), 2, '0'), '.', lpad(CAST({_CENTS} % 1000 * 1000 AS STRING), 6, '0'))"
    )


_CODE = f"split_part('{_AREAS}', ',', CAST({_PATH_NO} % 14 + 1 AS INT))"

# Runs: one row per event. Blocks of five events share a source; the second
# and fourth of a block copy its first. Sign-ups are runs without an outcome.
RUNS: dict[str, Expression] = {
    "id": "event_id",
    "source_path": f"concat('sources/', {_CODE}, '/place', CAST({_PATH_NO} AS STRING), '.json')",
    "source_id": f"concat('blob', CAST({_PATH_NO} AS STRING), '-', CAST({_K} % 3 AS STRING))",
    "ts_us": ("unix_micros(CAST(ts AS TIMESTAMP))", "epoch_us(ts)"),
    "status": "CASE WHEN event_type = 'signup' THEN NULL ELSE event_type <> 'error' END",
    "copy_of": "CASE WHEN event_id % 5 = 1 OR event_id % 5 = 3 THEN event_id - event_id % 5 END",
    "worker_id": "concat('worker-', CAST(user_id AS STRING))",
    "job_id": "concat('job', CAST(CAST(floor(event_id / 20) AS BIGINT) AS STRING))",
    "set_id": (
        f"CASE WHEN {_K} % 10 = 9 THEN NULL ELSE CAST(datediff(CAST(ts AS DATE), DATE '2024-01-01') AS BIGINT) + 1 END",
        f"CASE WHEN {_K} % 10 = 9 THEN NULL ELSE CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) + 1 END",
    ),
    "is_merged": f"CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' AND {_K} < 30 THEN FALSE ELSE TRUE END",
    "code_version": "concat('2.', CAST(event_id % 3 AS STRING))",
    "state": (
        "CASE WHEN event_type = 'signup' THEN NULL ELSE concat('{\"address count\": ', "
        f"CASE WHEN {_K} % 6 = 0 THEN 'null' WHEN {_K} % 6 = 1 THEN '0' ELSE CAST({_CENTS} AS STRING) END, "
        f"', \"cache\": ', CASE WHEN {_K} % 4 = 0 THEN 'null' ELSE concat('\"http://data.example.org.s3.amazonaws.com/c', CAST(event_id AS STRING), "
        f"split_part('.zip,.json,.csv', ',', CAST({_K} % 3 + 1 AS INT)), '\"') END, "
        f"', \"processed\": ', CASE WHEN {_DONE} THEN concat('\"https://s3.amazonaws.com/data.example.org/p', CAST(event_id AS STRING), '.zip?v=1\"') ELSE 'null' END, "
        f"', \"cache time\": ', CASE WHEN {_K} % 5 = 0 THEN 'null' ELSE concat('\"', {_clock(_K)}, '\"') END, "
        f"', \"process time\": ', CASE WHEN {_K} % 7 = 0 THEN 'null' ELSE concat('\"', {_clock(f'({_CENTS} % 9000)')}, '\"') END, "
        f"', \"geometry type\": \"', split_part('Point,Polygon,MultiPolygon,LineString', ',', CAST({_K} % 4 + 1 AS INT)), "
        f"'\", \"license\": ', CASE WHEN {_PATH_NO} % 3 = 0 THEN 'null' ELSE concat('\"Licence ', CAST({_PATH_NO} % 4 AS STRING), '\"') END, "
        f"', \"website\": ', CASE WHEN {_PATH_NO} % 4 = 0 THEN 'null' ELSE concat('\"http://site', CAST({_PATH_NO} % 9 AS STRING), '.example.org/\"') END, "
        f"', \"attribution required\": \"', split_part('true,false,', ',', CAST({_PATH_NO} % 3 + 1 AS INT)), "
        f"'\", \"attribution flag\": \"', split_part('true,false,', ',', CAST({_PATH_NO} % 3 + 1 AS INT)), "
        f"'\", \"attribution name\": ', CASE WHEN {_PATH_NO} % 2 = 0 THEN concat('\"City ', CAST({_PATH_NO} % 8 AS STRING), '\"') ELSE 'null' END, "
        f"', \"share-alike\": \"', split_part('true,false,', ',', CAST({_PATH_NO} % 3 + 1 AS INT)), "
        f"'\", \"fingerprint\": \"', md5(concat('f', CAST({_K} AS STRING))), '\", \"version\": \"v', CAST({_K} AS STRING), "
        f"'\", \"output\": \"http://data.example.org/o', CAST(event_id AS STRING), '.txt\"', "
        f"CASE WHEN {_K} % 25 = 0 THEN ', \"surprise\": 1' ELSE '' END, '}}') END"
    ).replace("'}}'", "'}'"),
}

# A queue of work derived from the same events: every event is enqueued at its
# time, most are done some hours later, some never.
TASKS: dict[str, Expression] = {
    "run_id": "event_id",
    "job_id": RUNS["job_id"],
    "file": f"concat('f', CAST(event_id % 20 AS STRING))",
    "worker_id": RUNS["worker_id"],
    "queue": "event_type",
    "enqueued_us": RUNS["ts_us"],
    "k": _K,
    "cents": _CENTS,
    "ok": "event_type <> 'purchase'",
    "reports": "event_type <> 'error'",
}

TABLES: dict[str, tuple[str, dict[str, Expression]]] = {
    "pts": ("lineitem", PTS),
    "addr_raw": ("orders", ADDR_RAW),
    "addr_raw_lines": ("lineitem", ADDR_RAW_LINES),
    "runs": ("events", RUNS),
    "tasks": ("events", TASKS),
}


def _pick(expression: Expression, engine: int) -> str:
    return expression if isinstance(expression, str) else expression[engine]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark DataFrame of a view."""
    base, columns = TABLES[name]
    return table(spark, sf_dir, base).selectExpr(*[f"{_pick(e, 0)} AS `{n}`" for n, e in columns.items()])


def view_sql(name: str) -> str:
    """SELECT statement of a view for the check engine."""
    base, columns = TABLES[name]
    return "SELECT " + ", ".join(f'{_pick(e, 1)} AS "{n}"' for n, e in columns.items()) + f" FROM {base}"


def with_views(names: str, body: str) -> str:
    """Check SQL: the named views as CTEs in front of ``body``."""
    ctes = ", ".join(f"{n} AS ({view_sql(n)})" for n in names.split())
    return f"WITH {ctes} {body.strip()}" if not body.strip().startswith(",") else f"WITH {ctes}{body.strip()}"


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run ledger, with a timestamp next to the microsecond count."""
    return view(spark, sf_dir, "runs").withColumn("datetime_tz", F.timestamp_micros("ts_us"))


def sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch per day of events; batches of every seventh day never ended."""
    day = F.unix_date(F.col("ts").cast("date")).cast("bigint") - 19723
    days = table(spark, sf_dir, "events").select(day.alias("d")).distinct()
    start = (F.col("d") + 19723) * 86400000000 + F.col("d") * 1234567
    return days.select(
        (F.col("d") + 1).alias("id"),
        F.when(F.col("d") % 2 == 0, F.lit("city")).otherwise(F.lit("county")).alias("owner"),
        F.lit("places").alias("repository"),
        start.alias("start_us"),
        F.when(F.col("d") % 7 != 3, start + 3600000000).alias("end_us"),
    ).withColumns(
        {
            "datetime_start": F.timestamp_micros("start_us"),
            "datetime_end": F.timestamp_micros("end_us"),
        }
    )


SETS_SQL = """SELECT d + 1 AS id, CASE WHEN d % 2 = 0 THEN 'city' ELSE 'county' END AS owner,
 'places' AS repository, (d + 19723) * 86400000000 + d * 1234567 AS start_us,
 CASE WHEN d % 7 <> 3 THEN (d + 19723) * 86400000000 + d * 1234567 + 3600000000 END AS end_us
 FROM (SELECT DISTINCT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS d FROM events)"""


def ledger_sql(body: str) -> str:
    """Check SQL with the run ledger: CTEs ``runs`` and ``sets``."""
    lead = f"WITH runs AS ({view_sql('runs')}), sets AS ({SETS_SQL})"
    body = body.strip()
    return f"{lead}{body}" if body.startswith(",") else f"{lead} {body}"
