"""The run ledger: latest runs, histories, reuse, flags, plans and orders.

Latest-per-key questions are answered by a narrow aggregate (key, status and
id only, combined before the shuffle) whose few winners are joined back to the
wide rows by id. No operator here gathers all runs of one source in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from streetgrain.functions.text import duration_seconds, epoch_text
from streetgrain.schema import RUN_STATE_KEYS, state_column


def _merged() -> Column:
    """A run without a merge flag counts as merged."""
    return F.coalesce(F.col("is_merged"), F.lit(True))


def completed_runs(runs: DataFrame, set_id: int | None = None) -> DataFrame:
    """Runs with an outcome, of one batch if ``set_id`` is given."""
    done = runs.filter(F.col("status").isNotNull())
    return done if set_id is None else done.filter(F.col("set_id") == set_id)


def latest_set(sets: DataFrame, owner: str | None = None, repository: str | None = None) -> DataFrame:
    """Newest finished batch by start; per owner and repository, or of one."""
    finished = sets.filter(F.col("datetime_end").isNotNull())
    if owner is not None:
        finished = finished.filter((F.col("owner") == owner) & (F.col("repository") == repository))
    keys = ["owner", "repository"]
    others = [c for c in sets.columns if c not in keys]
    newest = F.max_by(F.struct(*others), F.struct("datetime_start", "id"))
    return finished.groupBy(*keys).agg(newest.alias("s")).select(*keys, "s.*")


def paths_of_set(runs: DataFrame, set_id: Column) -> DataFrame:
    """Source paths that occur in a batch."""
    return runs.filter(F.col("set_id") == set_id).select("source_path").distinct()


def latest_run_ids(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Id of the newest merged success per key, else of the newest merged failure."""
    merged = runs.filter(F.col("status").isNotNull() & _merged())
    best = merged.groupBy(*keys).agg(
        F.max(F.when(F.col("status"), F.col("id"))).alias("_good"),
        F.max(F.when(~F.col("status"), F.col("id"))).alias("_bad"),
    )
    return best.select(*keys, F.coalesce("_good", "_bad").alias("id"))


def _rows_of(runs: DataFrame, ids: DataFrame) -> DataFrame:
    return runs.join(ids.select("id"), "id", "left_semi")


def latest_runs_to_date(runs: DataFrame, sets: DataFrame, set_id: int) -> DataFrame:
    """Latest run of every source that occurs in a batch.

    An unfinished or unknown batch has no result.
    """
    finished = sets.filter((F.col("id") == set_id) & F.col("datetime_end").isNotNull())
    paths = (
        runs.filter(F.col("set_id") == set_id)
        .join(finished.select(F.col("id").alias("set_id")), "set_id", "left_semi")
        .select("source_path")
    )
    return _rows_of(runs, latest_run_ids(runs.join(paths, "source_path", "left_semi"), ["source_path"]))


def latest_run(runs: DataFrame, source_path: str) -> DataFrame:
    """Latest run of one source."""
    one = runs.filter(F.col("source_path") == source_path)
    return _rows_of(one, latest_run_ids(one, ["source_path"]))


def latest_run_per_source(runs: DataFrame) -> DataFrame:
    return _rows_of(runs, latest_run_ids(runs, ["source_path"]))


def fallback_to_failed(runs: DataFrame) -> DataFrame:
    """The newest successes, and newest failures of sources without a success."""
    merged = runs.filter(_merged())
    newest = lambda wanted: (
        merged.filter(F.col("status") == wanted)
        .groupBy("source_path")
        .agg(F.max("id").alias("id"))
        .withColumn("status", F.lit(wanted))
    )
    good, bad = newest(True), newest(False)
    return good.unionByName(bad.join(good, "source_path", "left_anti"))


def source_history(runs: DataFrame, source_path: str | None = None) -> DataFrame:
    """Completed merged runs, the newest of every group of copies.

    A copy always points to an original, so original and copies share the
    group ``coalesce(copy_of, id)``. Order by source and falling id.
    """
    kept = completed_runs(runs).filter(_merged())
    if source_path is not None:
        kept = kept.filter(F.col("source_path") == source_path)
    newest = kept.groupBy("source_path", F.coalesce("copy_of", "id").alias("_root")).agg(
        F.max("id").alias("id")
    )
    return _rows_of(kept, newest).orderBy("source_path", F.col("id").desc())


def set_run_count(runs: DataFrame) -> DataFrame:
    """Completed runs per batch."""
    return (
        completed_runs(runs)
        .filter(F.col("set_id").isNotNull())
        .groupBy("set_id")
        .agg(F.count("*").alias("runs"))
    )


def runs_with_set(runs: DataFrame, sets: DataFrame) -> DataFrame:
    """Runs with a state, next to their finished batch."""
    batch = sets.select(
        F.col("id").alias("set_id"),
        F.col("datetime_start").alias("set_start"),
        F.col("datetime_end").alias("set_end"),
    )
    wanted = runs.filter(
        F.col("set_id").isNotNull() & F.coalesce(F.col("state") != "null", F.lit(False))
    )
    return wanted.join(batch, "set_id", "left").filter(F.col("set_end").isNotNull())


def expected_minus_seen(expected: DataFrame, runs: DataFrame, set_id: int) -> DataFrame:
    """Expected paths of a batch that have no completed run yet."""
    seen = completed_runs(runs, set_id).select("source_path")
    return expected.join(seen, "source_path", "left_anti")


def mark_index_runs(runs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Ledger with ``for_index_page`` set exactly for the chosen run ids."""
    flags = chosen.select("id").distinct().withColumn("_chosen", F.lit(True))
    others = [c for c in runs.columns if c != "for_index_page"]
    return (
        runs.select(*others)
        .join(flags, "id", "left")
        .select(*others, F.col("_chosen").isNotNull().alias("for_index_page"))
    )


def merge_published(current: DataFrame, published: DataFrame) -> DataFrame:
    """Publication table after a new publication: rows with the same URL are
    replaced and only the new ones are current."""
    kept = current.join(published.select("url"), "url", "left_anti")
    return kept.withColumn("is_current", F.lit(False)).unionByName(
        published.withColumn("is_current", F.lit(True))
    )


# --- run states ---------------------------------------------------------------


def parsed_state(df: DataFrame, keys: list[str], name: str = "_state") -> DataFrame:
    """Adds the named values of the state document as one struct of texts.

    The document is parsed once for all keys, in a projection of its own.
    """
    schema = T.StructType([T.StructField(k, T.StringType()) for k in keys])
    return df.withColumn(name, F.from_json("state", schema))


def state_columns(runs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Run rows with one text column per state key."""
    keys = keys or RUN_STATE_KEYS
    made = {state_column(k): F.col(f"_state.`{k}`") for k in keys}
    return parsed_state(runs, keys).withColumns(made).drop("_state")


def dashboard_stats(runs: DataFrame, sets: DataFrame) -> DataFrame:
    """Typed statistics of every run in a finished batch."""
    keys = [
        "version", "process time", "cache time", "address count", "geometry type",
        "processed", "cache", "sample", "output", "fingerprint",
    ]
    value = lambda key: F.col(f"_state.`{key}`")
    return parsed_state(runs_with_set(runs, sets), keys).select(
        epoch_text(F.col("set_start")).alias("tsname"),
        F.col("source_path").alias("source"),
        value("version").alias("version"),
        duration_seconds(value("process time")).alias("process_time"),
        duration_seconds(value("cache time")).alias("cache_time"),
        value("address count").try_cast("bigint").alias("address_count"),
        value("geometry type").alias("geometry_type"),
        value("processed").alias("processed_url"),
        value("cache").alias("cache_url"),
        value("sample").alias("sample_url"),
        value("output").alias("output_url"),
        value("fingerprint").alias("fingerprint"),
    )


# --- reuse of earlier results --------------------------------------------------


def reuse_previous_run(
    requests: DataFrame,
    runs: DataFrame,
    interval_us: int = 10 * 86400 * 1_000_000,
    blocks: int = 40,
) -> DataFrame:
    """Newest original completed run of the same file within an interval.

    ``requests`` has ``request_id`` (of any type), ``source_id``, ``ts_us``; the result adds
    ``reused_run``, null where nothing can be reused. A run counts if it is
    older than the request by less than the interval; newest means highest id.

    A join on the file id alone would pair every request with every run of a
    popular file. Instead time is cut into blocks, a whole number to the
    interval, and the interval behind a request is the end of one block, some
    whole blocks and the beginning of its own. Block maxima come from a
    combining aggregate; the two ends are running maxima within (file, block).
    Work is linear in the rows and a popular file is spread over its blocks.
    """
    if blocks < 2 or interval_us % blocks:
        raise ValueError("the interval must be a whole number of blocks, two at least")
    width = interval_us // blocks
    block = lambda ts: F.floor(ts / width).cast("bigint")
    originals = runs.filter(F.col("status").isNotNull() & F.col("copy_of").isNull()).select(
        "source_id", "ts_us", "id"
    )
    nothing = F.lit(None).cast("bigint")
    nobody = F.lit(None).cast(requests.schema["request_id"].dataType)
    # kind: 0 whole blocks before, 1 request at its own time, 2 run,
    #       3 request moved back by the interval
    run_rows = originals.select(
        "source_id", block(F.col("ts_us")).alias("block"), "ts_us", F.lit(2).alias("kind"), "id",
        nobody.alias("request_id"),
    )
    own = requests.select(
        "source_id", block(F.col("ts_us")).alias("block"), "ts_us", F.lit(1).alias("kind"),
        nothing.alias("id"), "request_id",
    )
    back = F.col("ts_us") - interval_us
    moved = requests.select(
        "source_id", block(back).alias("block"), back.alias("ts_us"), F.lit(3).alias("kind"),
        nothing.alias("id"), "request_id",
    )
    per_block = run_rows.groupBy("source_id", "block").agg(F.max("id").alias("id"))
    whole = (
        per_block.withColumn("block", F.explode(F.sequence(F.col("block") + 1, F.col("block") + blocks - 1)))
        .groupBy("source_id", "block")
        .agg(F.max("id").alias("id"))
        .select(
            "source_id", "block", (F.col("block") * width - 1).alias("ts_us"), F.lit(0).alias("kind"), "id",
            nobody.alias("request_id"),
        )
    )
    rows = run_rows.unionByName(own).unionByName(moved).unionByName(whole)
    part = Window.partitionBy("source_id", "block")
    forward = part.orderBy("ts_us", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    backward = part.orderBy(F.col("ts_us").desc(), F.col("kind").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    found = rows.select(
        "request_id", "kind",
        F.max("id").over(forward).alias("before"),
        # The rows that stand for whole blocks belong to the forward side only.
        F.max(F.when(F.col("kind") == 2, F.col("id"))).over(backward).alias("after"),
    ).filter(F.col("request_id").isNotNull())
    return found.groupBy("request_id").agg(
        F.max(F.when(F.col("kind") == 1, F.col("before")).otherwise(F.col("after"))).alias("reused_run")
    )


# --- rates from counters ---------------------------------------------------------


def previous_tick(df: DataFrame, key: str, time: str, values: list[str], width: int) -> DataFrame:
    """Values of the row before, by time, within a key; prefix ``prev_``.

    The rows of a key are cut into time slices of ``width``, so that a busy key
    is worked on by many tasks. Only the last row of each slice is handed on to
    the next slice.
    """
    carried = [time, *values]
    sliced = df.withColumn("_slice", F.floor(F.col(time) / width).cast("bigint"))
    within = Window.partitionBy(key, "_slice").orderBy(time)
    local = sliced.withColumn("_prev", F.lag(F.struct(*carried)).over(within))
    last = sliced.groupBy(key, "_slice").agg(F.max_by(F.struct(*carried), time).alias("_last"))
    across = Window.partitionBy(key).orderBy("_slice")
    handed = last.select(key, "_slice", F.lag("_last").over(across).alias("_handed"))
    joined = local.join(handed, [key, "_slice"], "left")
    prev = F.coalesce("_prev", "_handed")
    return joined.select(*df.columns, *[prev[c].alias(f"prev_{c}") for c in carried])


def usage_rates(counters: DataFrame, slice_us: int = 86400 * 1_000_000) -> DataFrame:
    """CPU shares (percent), kilobytes moved and period between two samples.

    ``counters``: ``process, ts_us, user_cpu, system_cpu, total_cpu,
    read_bytes, written_bytes, sent_bytes, received_bytes``, all cumulative.
    Unknown disk counters make all four byte rates zero.
    """
    cpu = ["user_cpu", "system_cpu", "total_cpu"]
    volumes = ["read_bytes", "written_bytes", "sent_bytes", "received_bytes"]
    ticks = previous_tick(counters, "process", "ts_us", cpu + volumes, slice_us)
    ticks = ticks.filter(F.col("prev_total_cpu").isNotNull())
    delta = lambda c: F.col(c) - F.col(f"prev_{c}")
    known = F.lit(True)
    for c in ("read_bytes", "written_bytes"):
        known = known & F.col(c).isNotNull() & F.col(f"prev_{c}").isNotNull()
    share = lambda c: F.try_divide(delta(c) * 100.0, delta("total_cpu").cast("double"))
    return ticks.select(
        "process", "ts_us",
        share("user_cpu").alias("user_percent"),
        share("system_cpu").alias("system_percent"),
        *[
            F.when(known, delta(c) / 1024.0).otherwise(0.0).alias(c.replace("_bytes", "_kb"))
            for c in volumes
        ],
        (delta("ts_us") / 1e6).alias("period"),
    )


# --- orders -----------------------------------------------------------------------


def glass_half_full(df: DataFrame) -> DataFrame:
    """Processed first, then cached, then by source."""
    filled = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    return df.orderBy(~filled("processed"), ~filled("cache"), "source")


def glass_half_empty(df: DataFrame) -> DataFrame:
    """What needs help first: not cached, then not processed, then by source."""
    filled = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    return df.orderBy(filled("cache"), filled("processed"), "source")


def page_after(df: DataFrame, past_id: int | None, size: int = 25) -> DataFrame:
    """Next page of rows with smaller ids, newest first."""
    rows = df if past_id is None else df.filter(F.col("id") < past_id)
    return rows.orderBy(F.col("id").desc()).limit(size)


def run_time_text(cache_time: Column, process_time: Column) -> Column:
    """Sum of two run times in whole seconds as ``H:MM:SS``; null if one is missing."""
    total = F.floor(duration_seconds(cache_time)) + F.floor(duration_seconds(process_time))
    total = total.cast("bigint")
    clock = F.format_string("%d:%02d:%02d", F.floor(total / 3600), F.floor(total / 60) % 60, total % 60)
    return F.when(total.isNotNull(), clock)


def batch_order(df: DataFrame, run_time: str = "run_time", path: str = "path") -> DataFrame:
    """Unknown run times first, then the longest; equal ones by path.

    Run times compare as text, a missing one as ``9999``.
    """
    known = F.when(F.col(run_time) != "", F.col(run_time))
    return df.orderBy(F.coalesce(known, F.lit("9999")).desc(), path)


def newest_first(df: DataFrame, time: str = "datetime_tz") -> DataFrame:
    """Newest first; rows without a time count as 1970."""
    return df.orderBy(F.coalesce(F.col(time), F.timestamp_micros(F.lit(0))).desc())


def job_file_order(df: DataFrame) -> DataFrame:
    """Failed files, then pending, then done; each by path."""
    rank = F.when(~F.col("status"), 0).when(F.col("status").isNull(), 1).otherwise(2)
    return df.orderBy(rank, "path")


def top_sources(df: DataFrame, order: list, size: int = 20) -> DataFrame:
    """First rows of an order, each with the count of rows left out."""
    total = df.agg(F.count("*")).scalar()
    return df.orderBy(*order).limit(size).withColumn("more", F.greatest(total - size, F.lit(0)).cast("bigint"))
