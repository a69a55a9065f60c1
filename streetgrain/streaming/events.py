"""Event rules as streaming queries.

Every function takes and returns a DataFrame and works on a stream and on a
table alike; state is keyed and, where the rule allows, bounded by a watermark.
``run_to_table`` drives a stream over everything available and leaves the
result in a written table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from streetgrain.operators.changes import incremental_changes
from streetgrain.session import scratch_path

HEARTBEAT_MINUTES = 5
JOB_TIMEOUT_HOURS = 12
DUE_DELAY_MINUTES = 5


def latest_heartbeat(beats: DataFrame) -> DataFrame:
    """Last heartbeat of every worker (update mode; one state row per worker)."""
    return beats.groupBy("worker_id").agg(F.max("ts").alias("ts"))


def active_workers(beats: DataFrame, every: str = "5 minutes", delay: str = "15 minutes") -> DataFrame:
    """Workers seen in the fifteen minutes before each report.

    First one row per window and worker, so that a chatty worker costs no more
    than a quiet one; the count follows in the same stream.
    """
    window = F.window("ts", f"{3 * HEARTBEAT_MINUTES} minutes", every)
    seen = (
        beats.withWatermark("ts", delay).groupBy(window.alias("w"), "worker_id").agg(F.count("*").alias("beats"))
    )
    return seen.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "worker_id", "beats")


def count_active_workers(seen: DataFrame) -> DataFrame:
    return seen.groupBy("start").agg(F.count("*").alias("workers"))


LIMIT_US = (JOB_TIMEOUT_HOURS * 60 + DUE_DELAY_MINUTES) * 60 * 1_000_000


# State of slices of keys, as Arrow frames in one value: each call works on a slice's rows at once.
SLICES = 128


def _sliced(rows: DataFrame, key: str):
    return rows.withColumn("_slice", F.pmod(F.xxhash64(key), F.lit(SLICES))).groupBy("_slice")


def _packed(frame: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(frame, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(state: GroupState, *empty: pd.DataFrame) -> list[pd.DataFrame]:
    if not state.exists:
        return list(empty)
    return [pa.ipc.open_stream(raw).read_all().to_pandas() for raw in state.get]


def _typed(**columns: str) -> pd.DataFrame:
    return pd.DataFrame({n: pd.Series(dtype=t) for n, t in columns.items()})


def _stored(state: GroupState, wake_ms: float, *frames: pd.DataFrame) -> None:
    """Keep the frames until ``wake_ms``; nothing if they are empty."""
    if all(f.empty for f in frames):
        if state.exists:
            state.remove()
        return
    state.update(tuple(_packed(f) for f in frames))
    if wake_ms < float("inf"):
        state.setTimeoutTimestamp(max(int(wake_ms), state.getCurrentWatermarkMs() + 1))


NEVER = 1 << 62
RUNS = _typed(run_id="int64", queued="int64", at_us="int64", ok="bool", decided="bool")
REPORTS = RUNS[["run_id", "at_us", "ok"]]


def _decide(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The runs of a slice: of each its first report in time, once no earlier one can come, or nothing in time.

    State: the known runs with the time and result of their first timely report,
    and whether they are decided; the reports of runs that aren't known yet.
    """
    passed = state.getCurrentWatermarkMs()
    runs, early = _unpacked(state, RUNS, REPORTS)
    new = pd.concat([RUNS[["run_id", "at_us", "queued", "ok"]], *frames])
    is_task = new["queued"].astype(bool)
    tasks = new.loc[is_task, ["run_id", "at_us"]].rename(columns={"at_us": "queued"})
    queued = pd.concat([runs[["run_id", "queued"]], tasks]).groupby("run_id")["queued"].min()
    reports = pd.concat([runs.loc[runs["at_us"] < NEVER, REPORTS.columns], early, new.loc[~is_task, REPORTS.columns]], ignore_index=True).astype(REPORTS.dtypes)
    start = pd.Series(queued.reindex(reports["run_id"], fill_value=NEVER).to_numpy("int64"), reports.index)
    early = reports[(start == NEVER) & ((reports["at_us"] + LIMIT_US) // 1000 >= passed)]
    timely = reports[(start <= reports["at_us"]) & (reports["at_us"] - start <= LIMIT_US)]
    first = timely.sort_values(["at_us", "ok"]).drop_duplicates("run_id").set_index("run_id").reindex(queued.index)
    done_before = runs.loc[runs["decided"], "run_id"]
    runs = pd.DataFrame({
        "run_id": queued.index, "queued": queued.to_numpy("int64"), "at_us": first["at_us"].fillna(NEVER).to_numpy("int64"),
        "ok": first["ok"].eq(True).to_numpy(), "decided": queued.index.isin(done_before),
    })
    sure = -(-runs["at_us"] // 1000) < passed
    due = (runs["queued"] + LIMIT_US) // 1000 < passed
    out = runs[~runs["decided"] & (sure | due)]
    if len(out):
        reported = out["at_us"] < NEVER
        yield pd.DataFrame({
            "run_id": out["run_id"], "enqueued_us": out["queued"], "done_us": out["at_us"].astype("Int64").where(reported),
            "status": out["ok"], "decided_by": reported.map({True: "done", False: "due"}),
        })
    runs["decided"] |= sure
    runs = runs[~due]
    open_ = -(-runs.loc[~runs["decided"], "at_us"] // 1000)
    wake = min(open_.min(), (runs["queued"].min() + LIMIT_US) // 1000 + 1) if len(runs) else float("inf")
    if len(early):
        wake = min(wake, (early["at_us"].min() + LIMIT_US) // 1000 + 1)
    _stored(state, wake, runs, early)


def done_or_due(tasks: DataFrame, done: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One outcome per task: its first report in time, else failed as overdue.

    ``tasks``: ``run_id, enqueued``; ``done``: ``run_id, done_at, ok``. A report
    counts within the job timeout plus a grace period; of several the first
    decides, a failure before a success of the same time. As a stream, an outcome
    appears when the watermark shows that no earlier report can come, or that the
    deadline is over; a run's state is one report and goes with its deadline. Runs
    are kept in slices, whose rows are worked on together.
    """
    if not (tasks.isStreaming or done.isStreaming):
        limit = F.expr(f"INTERVAL {LIMIT_US} MICROSECONDS")
        reports = done.select(F.col("run_id").alias("_id"), "done_at", F.coalesce("ok", F.lit(False)).alias("ok"))
        in_time = (
            (F.col("run_id") == F.col("_id")) & (F.col("done_at") >= F.col("enqueued"))
            & (F.col("done_at") <= F.col("enqueued") + limit)
        )
        first = F.min(F.when(F.col("_id").isNotNull(), F.struct("done_at", "ok"))).alias("r")
        decided = tasks.join(reports, in_time, "left").groupBy("run_id", "enqueued").agg(first)
        return decided.select(
            "run_id", "enqueued", F.col("r.done_at").alias("done_at"), F.coalesce("r.ok", F.lit(False)).alias("status"),
            F.when(F.col("r").isNull(), "due").otherwise("done").alias("decided_by"),
        )
    us = lambda c: F.unix_micros(c).alias("at_us")
    left = tasks.withWatermark("enqueued", delay).select(
        "run_id", F.col("enqueued").alias("at"), us("enqueued"), F.lit(True).alias("queued"), F.lit(False).alias("ok")
    )
    right = done.withWatermark("done_at", delay).select(
        "run_id", F.col("done_at").alias("at"), us("done_at"), F.lit(False).alias("queued"), F.coalesce("ok", F.lit(False)).alias("ok")
    )
    decided = _sliced(left.unionByName(right), "run_id").applyInPandasWithState(
        _decide, "run_id long, enqueued_us long, done_us long, status boolean, decided_by string",
        "runs binary, early binary", "append", "EventTimeTimeout",
    )
    return decided.select(
        "run_id", F.timestamp_micros("enqueued_us").alias("enqueued"), F.timestamp_micros("done_us").alias("done_at"),
        "status", "decided_by",
    )


def job_rollup(results: DataFrame) -> DataFrame:
    """Last status per job and file (update mode); roll up with ``job_status``.

    ``results``: ``job_id, file, ts, status``.
    """
    last = F.max(F.struct("ts", "status"))
    return results.groupBy("job_id", "file").agg(last.alias("l")).select("job_id", "file", F.col("l.ts").alias("ts"), F.col("l.status").alias("status"))


def queue_depth(items: DataFrame, delay: str = "1 minute", window: str = "30 seconds") -> DataFrame:
    """Items per queue in tumbling windows of half a minute."""
    counted = (
        items.withWatermark("ts", delay).groupBy(F.window("ts", window).alias("w"), "queue").agg(F.count("*").alias("items"))
    )
    return counted.select(F.col("w.start").alias("start"), "queue", "items")


def dedupe_events(events: DataFrame, key: str = "run_id", delay: str = "1 day") -> DataFrame:
    """Each completed run once; repeats within the delay are dropped."""
    marked = events.withWatermark("ts", delay)
    return marked.dropDuplicatesWithinWatermark([key]) if marked.isStreaming else marked.dropDuplicates([key])


COUNTERS = ("user_cpu", "total_cpu", "read_bytes")


def _grow(width_us: int):
    """Growth of the processes of a slice per window, once the watermark has passed the window's end.

    State: the last settled sample of each process (``seen``) and the samples that aren't settled.
    """
    order = ["process", "at_us", *COUNTERS]

    def run(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat([*_unpacked(state), *(f[order].assign(seen=False) for f in frames)])
        rows = rows.sort_values(order, kind="stable").reset_index(drop=True)
        passed = state.getCurrentWatermarkMs() * 1000 // width_us * width_us
        settled = rows[rows["at_us"] < passed].copy()
        rows = rows[rows["at_us"] >= passed]
        if len(settled):
            by = settled["process"]
            first = ~by.duplicated()
            for c in COUNTERS:
                settled[c + "_up"] = settled[c].diff().mask(first, 0).astype("int64")
            out = settled[~settled["seen"]]
            start = (out["at_us"] // width_us * width_us).rename("start_us")
            if len(out):
                sums = {"samples": ("at_us", "count")} | {c: (c + "_up", "sum") for c in COUNTERS}
                yield out.groupby(["process", start], sort=False).agg(**sums).reset_index()
            last = settled[~by.duplicated(keep="last")][order].assign(seen=True)
            waiting, rows = rows, pd.concat([last, rows])
        else:
            waiting = rows
        end = (waiting["at_us"].min() // width_us + 1) * width_us // 1000 if len(waiting) else float("inf")
        _stored(state, end, rows)

    return run


def usage_windows(samples: DataFrame, delay: str = "1 minute", seconds: int = 30) -> DataFrame:
    """Counter growth per process and half minute: ``start, process, samples, user_percent, read_kb``.

    Counters only grow. A sample's growth is what was added since the process's
    previous sample, in whatever window that lies; a first sample has none. A
    stream keeps the last sample of each process, and a window appears when the
    watermark has passed its end.
    """
    width = seconds * 1_000_000
    if samples.isStreaming:
        rows = samples.withWatermark("ts", delay).select("ts", "process", F.unix_micros("ts").alias("at_us"), *[F.col(c).cast("long").alias(c) for c in COUNTERS])
        counted = _sliced(rows, "process").applyInPandasWithState(
            _grow(width), f"process {samples.schema['process'].dataType.simpleString()}, start_us long, samples long, " + ", ".join(f"{c} long" for c in COUNTERS),
            "rows binary", "append", "EventTimeTimeout",
        )
    else:
        before = Window.partitionBy("process").orderBy("at_us", *COUNTERS)
        rows = samples.select("process", F.unix_micros("ts").alias("at_us"), *COUNTERS)
        rows = rows.select(
            "process", (F.floor(F.col("at_us") / width) * width).alias("start_us"),
            *[F.coalesce(F.col(c) - F.lag(c).over(before), F.lit(0)).alias(c) for c in COUNTERS],
        )
        counted = rows.groupBy("process", "start_us").agg(F.count("*").alias("samples"), *[F.sum(c).alias(c) for c in COUNTERS])
    return counted.select(
        F.timestamp_micros("start_us").alias("start"), "process", "samples",
        F.try_divide(F.col("user_cpu") * 100.0, F.col("total_cpu").cast("double")).alias("user_percent"),
        (F.col("read_bytes") / 1024.0).alias("read_kb"),
    )


def changed_sources(fetched: DataFrame, recorded: DataFrame) -> DataFrame:
    """Fetched sources whose content is new (stream-static anti join)."""
    return incremental_changes(fetched, recorded)


# --- driving a stream ---------------------------------------------------------------


def run_to_table(spark: SparkSession, stream: DataFrame, name: str, mode: str = "append", keys: list[str] | None = None) -> DataFrame:
    """Run a stream over all available input and return the written result.

    Append results go straight to files. Update results are written per batch,
    each batch to its own folder so that a repeated batch replaces itself; the
    last version of each key is the result.
    """
    out, log = scratch_path(spark, name), scratch_path(spark, f"{name}-log")
    writer = stream.writeStream.option("checkpointLocation", log).trigger(availableNow=True)
    if mode == "append":
        query = writer.outputMode("append").format("parquet").option("path", out).start()
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = writer.outputMode("update").foreachBatch(save).start()
    query.awaitTermination()
    rows = spark.read.option("basePath", out).parquet(f"{out}/batch=*")
    others = [c for c in stream.columns if c not in keys]
    last = F.max_by(F.struct(*others), "batch")
    return rows.groupBy(*keys).agg(last.alias("l")).select(*keys, "l.*")
