"""Changed files, files of archives and choice of the input file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetgrain.functions.rules import source_file_path
from streetgrain.functions.text import file_extension

COMMITS = "array<struct<added:array<string>,modified:array<string>,removed:array<string>>>"


def explode_commits(payloads: DataFrame, key: str, payload: str = "payload") -> DataFrame:
    """File changes of push payloads: ``key, commit_no, file, removed``."""
    commits = F.from_json(F.get_json_object(payload, "$.commits"), COMMITS)
    rows = payloads.select(key, F.posexplode(commits).alias("commit_no", "c"))
    empty = F.array().cast("array<string>")
    entry = lambda names, gone: F.transform(
        F.coalesce(names, empty), lambda f: F.struct(f.alias("file"), F.lit(gone).alias("removed"))
    )
    changes = F.concat(
        entry(F.col("c.added"), False), entry(F.col("c.modified"), False), entry(F.col("c.removed"), True)
    )
    return rows.select(key, "commit_no", F.explode(changes).alias("x")).select(key, "commit_no", "x.*")


def touched_files(changes: DataFrame, key: str) -> DataFrame:
    """Files that a push leaves added or modified.

    The last commit naming a file decides, and there a removal wins. That is
    the parity of one running maximum, so a long push costs no sort.
    """
    step = F.col("commit_no").cast("bigint") * 2 + F.col("removed").cast("bigint")
    last = changes.groupBy(key, "file").agg(F.max(step).alias("_last"))
    return last.filter(F.col("_last") % 2 == 0).select(key, "file")


def touched_union(pushed: DataFrame, branch: DataFrame) -> DataFrame:
    """Files of a push and of its branch, each once."""
    return pushed.unionByName(branch).distinct()


def source_file_paths(files: DataFrame, file: str = "file") -> DataFrame:
    return files.filter(source_file_path(F.col(file)))


def incremental_changes(fetched: DataFrame, recorded: DataFrame) -> DataFrame:
    """Fetched sources whose fingerprint differs from the recorded one."""
    return fetched.join(recorded.select("url", "fingerprint"), ["url", "fingerprint"], "left_anti")


# --- archive members and input choice ------------------------------------------------


def expand_member_names(filename: Column) -> Column:
    """Lower-case file names that belong to one named file.

    A shape file stands for its four parts; a null gives an empty array.
    """
    name = F.lower(filename)
    base = name.substr(F.lit(1), F.length(name) - 4)
    parts = F.array(*[F.concat(base, F.lit(e)) for e in (".shp", ".shx", ".dbf", ".prj")])
    return (
        F.when(name.isNull(), F.array().cast("array<string>"))
        .when(file_extension(name) == ".shp", parts)
        .otherwise(F.array(name))
    )


def in_archive_selection(members: DataFrame, names: DataFrame, path: str = "path", name: str = "name") -> DataFrame:
    """Members that are named, or lie in a named directory, whatever the case.

    A path matches one of its own leading directories, so the test is an equi
    join on those instead of a comparison with every name.
    """
    parts = F.split(F.lower(path), "/")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")
    )
    wanted = names.select(F.regexp_replace(F.lower(name), "/+$", "").alias("_name"))
    # Equal members stay apart: each row has a number of its own.
    numbered = members.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("_id"), F.array_distinct(prefixes).alias("_names"))
    spread = numbered.select("_row", "_id", F.explode("_names").alias("_name"))
    hits = spread.join(wanted, "_name", "left_semi")
    return hits.groupBy("_id").agg(F.first("_row").alias("_row")).select("_row.*")


def select_source_file(files: DataFrame, keys: list[str], conform: dict, protocol: str | None = None) -> DataFrame:
    """The one input file among the listed ones, per group of ``keys``.

    ``files``: keys, ``position, path``. No or an ambiguous choice gives null.
    """
    form, named = conform.get("format"), conform.get("file")
    path = F.col("path")
    base = F.regexp_extract(path, r"([^/]*)$", 1)
    ext = F.lower(file_extension(path))
    wanted_base = None if named is None else named.rsplit("/", 1)[-1]
    null = F.lit(None).cast("string")
    first = lambda condition, value=path: F.min_by(
        F.when(condition, value), F.when(condition, F.col("position"))
    )
    if form in ("shapefile", "shapefile-polygon", "gdb"):
        # Everything inside a geodatabase folder stands for the folder.
        value = F.regexp_replace(path, r"\.gdb.*", ".gdb") if form == "gdb" else path
        hit = F.lower(file_extension(value)) == (".gdb" if form == "gdb" else ".shp")
        # Distinct by first and last value: equal ends mean a single candidate.
        low, high = F.min(F.when(hit, value)), F.max(F.when(hit, value))
        several = null
        if named is not None:
            several = first(hit & (F.regexp_extract(value, r"([^/]*)$", 1) == named), value)
        if form == "gdb":
            choice = F.when(low == high, low).otherwise(several)
        else:
            choice = F.when(F.count_if(hit) == 1, low).otherwise(several)
    elif form == "geojson" and protocol != "ESRI":
        hit = ext.isin(".json", ".geojson")
        choice = F.when(F.count_if(hit) == 1, F.max(F.when(hit, path)))
    elif form == "geojson":
        choice = F.min_by(path, "position")
    elif form == "csv" and named is not None:
        choice = first(base == wanted_base)
    elif form == "csv":
        choice = F.coalesce(first(ext == ".csv"), F.min_by(path, "position"))
    elif form == "xml" and named is not None:
        choice = first(base == wanted_base)
    elif form == "xml":
        choice = first(file_extension(path) == ".gml")
    else:
        choice = F.max(null)
    return files.groupBy(*keys).agg(choice.alias("source_path"))
