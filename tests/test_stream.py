"""Streams over several small files, against the same operator on a table."""

import random
from datetime import datetime, timedelta

from streetgrain.session import scratch_path
from streetgrain.streaming import events as ev

START = datetime(2024, 1, 1)


def files(spark, rows, schema, name):
    """Rows written one file per list, read back as a stream in that order."""
    path = scratch_path(spark, name)
    for part in rows:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def at(minutes):
    return START + timedelta(minutes=minutes)


def test_latest_heartbeat_over_batches(spark):
    s = files(spark, [[("a", at(1)), ("b", at(2))], [("a", at(9))], [("a", at(5))]], "worker_id string, ts timestamp", "hb")
    rows = ev.run_to_table(spark, ev.latest_heartbeat(s), "hb-out", "update", ["worker_id"]).collect()
    assert {r.worker_id: r.ts for r in rows} == {"a": at(9), "b": at(2)}


def test_done_or_due(spark):
    tasks = [[(1, at(0)), (2, at(0)), (3, at(0)), (4, at(0))], [(99, at(5000))]]
    done = [[(1, at(10), True), (2, at(20), False)], [(3, at(726), True)], [(98, at(5000), True)]]
    t = files(spark, tasks, "run_id long, enqueued timestamp", "tasks")
    d = files(spark, done, "run_id long, done_at timestamp, ok boolean", "done")
    rows = ev.run_to_table(spark, ev.done_or_due(t, d), "decided").collect()
    got = {r.run_id: (r.status, r.decided_by) for r in rows}
    # 3 reports one minute after the limit of 12 h 5 min; 99 is still open.
    assert got == {1: (True, "done"), 2: (False, "done"), 3: (False, "due"), 4: (False, "due")}
    assert len(rows) == 4


def test_dedupe_across_batches(spark):
    s = files(spark, [[(1, at(0)), (2, at(1))], [(1, at(3)), (3, at(4))]], "run_id long, ts timestamp", "dup")
    rows = ev.run_to_table(spark, ev.dedupe_events(s), "dup-out").collect()
    assert sorted(r.run_id for r in rows) == [1, 2, 3]


def test_queue_depth_batch_twin(spark):
    rows = [[("q", at(0)), ("q", at(0.2)), ("r", at(0.1))], [("q", at(0.6)), ("q", at(0.3))]]
    schema = "queue string, ts timestamp"
    out = ev.run_to_table(spark, ev.queue_depth(files(spark, rows, schema, "q")), "q-out", "update", ["start", "queue"])
    twin = ev.queue_depth(spark.createDataFrame(rows[0] + rows[1], schema))
    assert sorted(map(tuple, out.select("start", "queue", "items").collect())) == sorted(map(tuple, twin.collect()))


def test_changed_sources(spark):
    s = files(spark, [[("u1", "a")], [("u2", "b"), ("u3", "new")]], "url string, fingerprint string", "fp")
    recorded = spark.createDataFrame([("u1", "a"), ("u2", "old")], "url string, fingerprint string")
    rows = ev.run_to_table(spark, ev.changed_sources(s, recorded), "fp-out").collect()
    assert sorted(r.url for r in rows) == ["u2", "u3"]


def test_first_of_several_reports_decides(spark):
    """Reports that come late, twice, before their task, and out of order over several files."""
    tasks = [[(1, at(0)), (2, at(0))], [(3, at(1))], [(4, at(2))], [(99, at(5000))]]
    done = [[(1, at(30), True), (4, at(3), True)], [(1, at(20), False), (2, at(700), True)], [(3, at(800), True), (2, at(690), False)], [(98, at(5000), True)]]
    t = files(spark, tasks, "run_id long, enqueued timestamp", "tasks")
    d = files(spark, done, "run_id long, done_at timestamp, ok boolean", "done")
    rows = ev.run_to_table(spark, ev.done_or_due(t, d, delay="20 hours"), "decided").collect()
    got = sorted((r.run_id, r.status, r.decided_by, r.done_at) for r in rows)
    want = [(1, False, "done", at(20)), (2, False, "done", at(690)), (3, False, "due", None), (4, True, "done", at(3))]
    assert got == want
    flat = lambda parts, schema: spark.createDataFrame([r for p in parts for r in p], schema)
    twin = ev.done_or_due(flat(tasks, "run_id long, enqueued timestamp"), flat(done, "run_id long, done_at timestamp, ok boolean")).collect()
    assert sorted((r.run_id, r.status, r.decided_by, r.done_at) for r in twin if r.run_id != 99) == want


def test_growth_across_windows(spark):
    """Half-minute samples: each window's growth is that since the previous sample."""
    schema = "ts timestamp, process string, user_cpu long, total_cpu long, read_bytes long"
    rows = [(at(0.5 * i), "p", 10 * i, 100 * i, 2048 * i) for i in range(8)]
    parts = [rows[0:2], [rows[3], rows[2]], rows[4:6], rows[6:], [(at(60), "q", 0, 0, 0)]]
    out = ev.run_to_table(spark, ev.usage_windows(files(spark, parts, schema, "use")), "use-out").collect()
    got = sorted((r.start, r.samples, r.user_percent, r.read_kb) for r in out if r.process == "p")
    assert got == [(at(0), 1, None, 0.0)] + [(at(0.5 * i), 1, 10.0, 2.0) for i in range(1, 8)]
    twin = ev.usage_windows(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.start, r.samples, r.user_percent, r.read_kb) for r in twin) == got


def test_outcomes_of_many_runs_over_four_files(spark):
    """Runs in several slices, tasks and reports in any file; as a table all but the open ones."""
    rng = random.Random(5)
    tasks = [(i, at(rng.randrange(3000))) for i in range(400)]
    done = []
    for i, start in tasks:
        for _ in range(rng.randrange(4)):
            done.append((i, start + timedelta(minutes=rng.randrange(-60, 900)), rng.random() < 0.5))
    tasks.append((1000, at(9000)))
    done.append((1001, at(9000), True))
    tasks.sort(key=lambda r: r[1])
    done.sort(key=lambda r: r[1])
    cut = lambda rows: [rows[: len(rows) // 4], rows[len(rows) // 4 : len(rows) // 2], rows[len(rows) // 2 : -1], rows[-1:]]
    t = files(spark, cut(tasks), "run_id long, enqueued timestamp", "tasks")
    d = files(spark, cut(done), "run_id long, done_at timestamp, ok boolean", "done")
    rows = ev.run_to_table(spark, ev.done_or_due(t, d, delay="60 hours"), "decided").collect()
    twin = ev.done_or_due(spark.createDataFrame(tasks, "run_id long, enqueued timestamp"), spark.createDataFrame(done, "run_id long, done_at timestamp, ok boolean"))
    want = sorted((r.run_id, r.status, r.decided_by, r.done_at) for r in twin.collect() if r.run_id < 1000)
    key = lambda r: (r[0], r[1], r[2], str(r[3]))
    assert sorted(((r.run_id, r.status, r.decided_by, r.done_at) for r in rows), key=key) == sorted(want, key=key)


def test_growth_of_many_processes(spark):
    schema = "ts timestamp, process long, user_cpu long, total_cpu long, read_bytes long"
    rng = random.Random(6)
    rows = []
    for p in range(150):
        t = c = 0
        for _ in range(12):
            t, c = t + rng.randrange(1, 60), c + rng.randrange(50)
            rows.append((START + timedelta(seconds=t), p, c, 3 * c, 1024 * c))
    rows.sort()
    last = [(at(600), 9999, 0, 0, 0)]
    parts = [rows[:500], rows[500:700] + rows[900:1100], rows[700:900] + rows[1100:], last]
    out = ev.run_to_table(spark, ev.usage_windows(files(spark, parts, schema, "many"), delay="30 minutes"), "many-out").collect()
    twin = ev.usage_windows(spark.createDataFrame(rows, schema)).collect()
    key = lambda r: (r.start, r.process)
    assert sorted(out, key=key) == sorted(twin, key=key)
