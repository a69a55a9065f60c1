"""One source from its definition to published files and the record of its state."""

from __future__ import annotations

import json
import os
import time
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from streetgrain.functions import conform as C
from streetgrain.functions import geo, licenses, rules
from streetgrain.operators import changes, filters
from streetgrain.plans import process
from streetgrain.schema import GEOM_COLUMN, X_COLUMN, Y_COLUMN, state_column
from streetgrain.sources import archives, readers

# Fields of a state record, in order.
STATE_FIELDS = [
    "source", "skipped", "cache", "sample", "website", "license", "geometry type", "address count", "version", "fingerprint",
    "cache time", "processed", "process time", "output", "preview", "slippymap", "attribution required", "attribution name",
    "share-alike", "source problem", "code version", "tests passed",
]
TYPES = {"skipped": "boolean", "address count": "long", "tests passed": "boolean"}
CODE_VERSION = "1"
SAMPLE_ROWS = 5
FORMATS = ("csv", "geojson", "xml")


class _Stopped(Exception):
    """No addresses; the log says why."""


def choose_file(spark: SparkSession, path: str, source: dict) -> str:
    """The input among the files of a source: inside an archive or named, or else all of the path.

    A chosen archive member is unpacked to the shared folder, so that Spark can read it in pieces.
    """
    conform = source.get("conform", {})
    named = conform.get("file")
    packed = source.get("compression") == "zip"
    if not packed and named is None:
        return path
    if packed:
        files = archives.members(spark, path)
    else:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
        files = listed.select(F.lit(None).cast("string").alias("archive"), "path", F.col("path").alias("position"))
    if named is not None and packed:
        wanted = spark.range(1).select(F.explode(changes.expand_member_names(F.lit(named))).alias("name"))
        files = changes.in_archive_selection(files, wanted)
    chosen = changes.select_source_file(files, ["archive"], conform, source.get("protocol"))
    found = chosen.where("source_path IS NOT NULL").orderBy("archive").limit(1).collect()
    if not found:
        raise _Stopped("WARNING: Error doing conform; skipping: no input file among those of the source")
    if not packed:
        return found[0].source_path
    return archives.unpacked(spark, found[0].archive, found[0].source_path)


def fingerprint(spark: SparkSession, path: str) -> str | None:
    """MD5 of the content; of several files, of the list of theirs in order of path."""
    rows = readers.fingerprint_files(spark, path)
    # One digest per file, 32 letters each, in one row: as long as a list of the files.
    each = F.transform(F.sort_array(F.collect_list(F.struct("path", "fingerprint"))), lambda f: f["fingerprint"])
    return rows.agg(
        F.when(F.count("*") == 1, F.min("fingerprint")).when(F.count("*") > 1, F.md5(F.array_join(each, "").cast("binary"))).alias("f")
    ).first().f


def sample_of(rows: DataFrame) -> tuple[list[list[str | None]] | None, str | None]:
    """Column names and first rows, and the type of the first geometry; nothing without rows. Reads the first rows only."""
    kind = F.lit(None).cast("string")
    if rows.columns[-3:] == [X_COLUMN, Y_COLUMN, GEOM_COLUMN]:
        kind = geo.geometry_type(F.col(f"`{GEOM_COLUMN}`"))
    head = rows.withColumn("_kind", kind).limit(SAMPLE_ROWS).collect()
    if not head:
        return None, None
    return [rows.columns, *[list(r)[:-1] for r in head]], head[0]["_kind"]


def write_addresses(addresses: DataFrame, path: str) -> dict[str, int]:
    """Write the address table as CSV; its counts are observed in passing."""
    seen = Observation("addresses")
    located = F.coalesce(F.col("LON") != "", F.lit(False)) & F.coalesce(F.col("LAT") != "", F.lit(False))
    counted = addresses.observe(
        seen, F.count("*").alias("address_count"), F.count("_error").alias("errors"), F.count_if(located).alias("located")
    )
    counted.drop("_error").write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
    return seen.get


def publish_source(
    spark: SparkSession, definition: str, path: str, destination: str, source: str, *, layer: str = "addresses",
    version: str | None = None, cache_time: timedelta | None = None, fail_on_error: bool = True, code_version: str = CODE_VERSION,
) -> DataFrame:
    """Process a source and publish its files; the result is its state, one row of :data:`STATE_FIELDS`.

    ``definition`` is JSON, flat or layered; ``path`` the fetched data, ``version`` and
    ``cache_time`` what the fetch told. Below ``destination`` a folder of the source, the
    layer and its name gets ``out.csv``, ``sample.json``, ``output.txt`` (the log) and
    ``index.json`` (the state), in place of those of an earlier run. Whatever goes wrong ends in the log, and from it in the
    state's problem; only bad JSON is an error. The addresses are read and written once:
    their number is observed on the way, not counted after.
    """
    log: list[str] = []
    state: dict[str, object] = dict.fromkeys(STATE_FIELDS)
    upgraded = spark.range(1).select(rules.upgrade_source_schema(F.lit(definition)).alias("d")).first().d
    layers = json.loads(upgraded).get("layers") or {}
    chosen = (layers.get("addresses") or [{}])[0]
    name = chosen.get("name")
    folder = os.path.join(destination, source.rsplit("/", 1)[-1].rsplit(".", 1)[0], layer, name or "")
    state |= {"source": source.rsplit("/", 1)[-1], "skipped": bool(chosen.get("skip")), "website": chosen.get("website"), "code version": code_version}
    sample = None
    begun = time.time()
    try:
        if not layers.get("addresses"):
            raise _Stopped("ERROR: Nothing processed: No address layer specified")
        if state["skipped"]:
            raise _Stopped("INFO: Source says to skip")
        if "conform" in chosen:
            state["tests passed"], failure = process.check_acceptance_tests(spark, chosen)
            if state["tests passed"] is False:
                raise _Stopped(f"WARNING: A source test failed: {failure}")
        if name is None:
            raise _Stopped("WARNING: name attribute is required on each data source")
        state |= {"cache": path, "version": version, "cache time": str(cache_time) if cache_time else None, "fingerprint": fingerprint(spark, path)}
        log.append(f"INFO: Cached data in {path}")
        if "conform" not in chosen:
            raise _Stopped("WARNING: Source is missing a conform object")
        if chosen["conform"].get("format") not in FORMATS:
            raise _Stopped(f"WARNING: Unknown source conform format {chosen['conform'].get('format')}")
        rows = process.read_source(spark, choose_file(spark, path, chosen), chosen)
        sample, state["geometry type"] = sample_of(rows)
        log.append(f"INFO: Sampled {len(sample)} records" if sample else "WARNING: Error doing excerpt; skipping")
        extracted = process.extract_and_reproject(rows, chosen["conform"], chosen.get("protocol"))
        addresses = C.conform(extracted, chosen["conform"], state["fingerprint"] or "", fail_on_error=fail_on_error)
        out = os.path.join(folder, "out.csv")
        counts = write_addresses(addresses, out)
        state["address count"] = counts["address_count"]
        if not counts["address_count"]:
            raise _Stopped("WARNING: Found no addresses in source data")
        state["processed"] = "out.csv"
        log.append(f"INFO: Converted to {out} with {counts['address_count']} addresses, {counts['located']} located, {counts['errors']} errors")
    except _Stopped as stop:
        log.append(str(stop))
    except Exception as error:  # any fault of the source or its definition is its state
        log.append(f"WARNING: Error doing conform; skipping: {type(error).__name__}: {str(error)[:2000]}")
    if state["cache"] is not None:
        state["address count"] = state["address count"] or 0
        state["process time"] = str(timedelta(seconds=round(time.time() - begun, 6)))
    state["sample"] = "sample.json" if sample else None
    state["output"] = "output.txt"

    texts = {"log": "\n".join(log), "definition": upgraded, "license": _json(chosen.get("license")), "attribution": _json(chosen.get("attribution"))}
    schema = ", ".join(f"{state_column(f)} {TYPES.get(f, 'string')}" for f in STATE_FIELDS) + ", _log string, _definition string, _license string, _attribution string"
    row = spark.createDataFrame([(*state.values(), *texts.values())], schema)
    credit = licenses.attribution(F.col("_license"), F.col("_attribution"))
    word = lambda flag: F.coalesce(F.when(flag, "true").when(~flag, "false"), F.lit(""))
    done = row.withColumns({
        "license": licenses.license_text(F.col("_license")), "attribution_required": word(credit["flag"]),
        "attribution_name": credit["name"], "share_alike": word(licenses.share_alike(F.col("_license"))),
        "source_problem": rules.source_problem(F.col("_log"), F.col("_definition"), F.col("skipped")),
    }).select(*[state_column(f) for f in STATE_FIELDS])
    record = done.first()
    files = {"output.txt": texts["log"], "index.json": json.dumps([STATE_FIELDS, list(record)], ensure_ascii=False)}
    if sample:
        files["sample.json"] = json.dumps(sample, ensure_ascii=False)
    for file, text in files.items():
        spark.createDataFrame([(text,)], "value string").write.mode("overwrite").text(os.path.join(folder, file))
    return spark.createDataFrame([tuple(record)], done.schema)


def _json(value: object) -> str | None:
    return None if value is None else json.dumps(value, ensure_ascii=False)


# --- parcels -------------------------------------------------------------------------


def publish_parcels(spark: SparkSession, states: str, spec: dict, destination: str) -> DataFrame:
    """Parcel tables of all polygon sources in a published run table: ``source, parcels, problem``.

    Each source's cached data, a CSV file or an archive with one, becomes a CSV below
    ``destination`` at the place of the source. A source that can't be read names its
    problem and the others go on. The list of sources is on the driver, as each is a job.
    """
    table = filters.polygon_sources(readers.read_state_tsv(spark, states), "geometry type")
    done = []
    for source, cache in sorted((r.source, r.cache) for r in table.select("source", "cache").collect()):
        try:
            definition = {"conform": {"format": "csv"}, "compression": "zip" if cache.endswith(".zip") else None}
            rows = readers.read_source_csv(spark, choose_file(spark, cache, definition))
            parcels = process.parcel_table(rows, spec, source)
            seen = Observation("parcels")
            counted = parcels.observe(seen, F.count("*").alias("n")).drop("_error")
            counted.write.mode("overwrite").option("header", "true").option("escape", '"').csv(os.path.join(destination, source.rsplit(".", 1)[0] + ".csv"))
            done.append((source, seen.get["n"], None))
        except Exception as error:  # a fault of one source stops no other
            done.append((source, 0, f"{type(error).__name__}: {str(error)[:2000]}"))
    return spark.createDataFrame(done, "source string, parcels long, problem string")
