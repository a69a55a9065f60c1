import random

import pytest
from pyspark.sql import functions as F

from streetgrain.sources import writers
from streetgrain.operators import changes, statistics
from streetgrain.operators import runs as ledger

RUN = "id long, source_path string, source_id string, ts_us long, status boolean, copy_of long, set_id long, is_merged boolean, state string"


def ledger_of(spark, rows):
    names = [f.split()[0] for f in RUN.split(", ")]
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RUN)
    return df.withColumn("datetime_tz", F.timestamp_micros("ts_us"))


def sets_of(spark, rows):
    df = spark.createDataFrame(rows, "id long, owner string, repository string, start_us long, end_us long")
    return df.withColumns({"datetime_start": F.timestamp_micros("start_us"), "datetime_end": F.timestamp_micros("end_us")})


def path(n):
    return f"sources/{n}.json"


def test_latest_runs_three_valued(spark):
    rows = [
        dict(id=1, source_path=path("a"), status=True, set_id=1, is_merged=True),
        dict(id=2, source_path=path("a"), status=False, set_id=2, is_merged=True),
        dict(id=3, source_path=path("a"), status=True, set_id=2, is_merged=False),
        dict(id=4, source_path=path("b"), status=False, set_id=2, is_merged=None),
        dict(id=5, source_path=path("b"), status=None, set_id=2, is_merged=True),
        dict(id=6, source_path=path("c"), status=True, set_id=1, is_merged=None),
        dict(id=7, source_path=path("d"), status=None, set_id=2, is_merged=None),
    ]
    runs = ledger_of(spark, rows)
    sets = sets_of(spark, [(1, "o", "r", 1, 2), (2, "o", "r", 3, 4), (3, "o", "r", 5, None)])
    ids = lambda n: sorted(r.id for r in ledger.latest_runs_to_date(runs, sets, n).collect())
    assert ids(2) == [1, 4] and ids(3) == [] and ids(9) == []
    assert ledger.latest_set(sets, "o", "r").first()["id"] == 2
    assert ledger.latest_run(runs, path("b")).first()["id"] == 4
    assert ledger.latest_run(runs, path("d")).count() == 0


def test_history_collapses_copies(spark):
    rows = [
        dict(id=1, source_path=path("a"), status=True), dict(id=2, source_path=path("a"), status=True, copy_of=1),
        dict(id=3, source_path=path("a"), status=False), dict(id=4, source_path=path("a"), status=True, copy_of=1),
        dict(id=5, source_path=path("a"), status=True, is_merged=False),
    ]
    assert [r.id for r in ledger.source_history(ledger_of(spark, rows), path("a")).collect()] == [4, 3]


def test_reuse_brute_force(spark):
    r = random.Random(3)
    hot = lambda: "hot" if r.random() < 0.5 else f"f{r.randint(0, 5)}"
    rows = [
        dict(id=i, source_path=path("a"), source_id=hot(), ts_us=r.randint(0, 300), status=r.choice([True, False, None]),
             copy_of=r.choice([None, None, 1]))
        for i in range(300)
    ]
    r.shuffle(rows)
    runs = ledger_of(spark, rows)
    requests = runs.select(F.col("id").alias("request_id"), "source_id", "ts_us")
    for width, blocks in ((60, 6), (100, 2), (20, 20)):
        got = {x.request_id: x.reused_run for x in ledger.reuse_previous_run(requests, runs, width, blocks).collect()}
        for q in rows:
            fit = [
                p["id"] for p in rows
                if p["source_id"] == q["source_id"] and q["ts_us"] - width < p["ts_us"] < q["ts_us"]
                and p["status"] is not None and p["copy_of"] is None
            ]
            assert got[q["id"]] == max(fit, default=None)
    with pytest.raises(ValueError):
        ledger.reuse_previous_run(requests, runs, 7, 2)


def test_previous_tick_across_slices(spark):
    rows = [("p", t, t * 2) for t in (1, 5, 26, 27, 90)] + [("q", 3, 1)]
    df = spark.createDataFrame(rows, "process string, ts long, v long")
    got = ledger.previous_tick(df, "process", "ts", ["v"], 10).orderBy("process", "ts").collect()
    assert [(x.process, x.ts, x.prev_ts, x.prev_v) for x in got] == [
        ("p", 1, None, None), ("p", 5, 1, 2), ("p", 26, 5, 10), ("p", 27, 26, 52), ("p", 90, 27, 54), ("q", 3, None, None)
    ]


def test_dashboard_lists(spark):
    states = [
        '{"address count": 1, "process time": "0:00:01", "cache time": "0:00:02"}',
        '{"address count": 2, "process time": "0:00:04", "cache time": "0:00:08"}',
        '{"address count": 4, "process time": "0:00:16", "cache time": "0:00:32"}',
    ]
    runs = ledger_of(spark, [dict(id=i, source_path=path("us/ca/alameda"), status=True, set_id=1, state=s) for i, s in enumerate(states)])
    stats = ledger.dashboard_stats(runs, sets_of(spark, [(1, "o", "r", 1_500_000, 2_000_000)]))
    assert stats.first()["tsname"] == "1.500"
    lists = {}
    for r in statistics.last_batch_distributions(stats).collect():
        lists.setdefault(r.metric, []).extend([r.value] * r.runs)
    assert lists == {"address_count": [1, 2, 4], "process_time": [1, 4, 16], "cache_time": [2, 8, 32]}


def test_run_counts(spark):
    rows = [(None, None, None), ("x", None, None), (None, "x", None), ("x", "x", None), (None, None, 1), ("x", None, 2),
            (None, "x", 4), ("x", "x", 8), (None, None, None), ("", None, None), (None, "", None)]
    df = spark.createDataFrame(rows, "cache string, processed string, address_count long")
    assert tuple(statistics.run_counts(df).first()) == (11, 4, 4, 15)


def test_license_text(spark, tmp_path):
    rows = [("c", f"s{i:03d}", None, "L", "false" if i % 2 else "true", "N" if i % 4 else "") for i in range(50)]
    df = spark.createDataFrame(rows + rows[:9], "c string, source_base string, website string, license string, attribution_flag string, attribution_name string")
    text = statistics.license_text(df, ["c"], "Head").withColumn("d", F.lit("x"))
    assert text.count() == 51
    whole = "\n".join(r.text for r in text.orderBy(F.col("source_base").asc_nulls_first()).collect())
    assert whole.startswith("Head\n\ns000\nWebsite: Unknown\nLicense: L\nRequired attribution: Yes\n\ns001\nWebsite: Unknown\nLicense: L\nRequired attribution: No\n")
    writers._write_documents(text, ["c", "d"], str(tmp_path / "t"))
    files = sorted((tmp_path / "t").rglob("part-*"))
    assert "".join(f.read_text() for f in files) == whole + "\n"


def test_orders(spark):
    df = spark.createDataFrame([("a", None, None), ("b", "x", None), ("c", "x", "x"), ("d", None, "x")], "source string, cache string, processed string")
    assert [r.source for r in ledger.glass_half_full(df).collect()] == ["c", "d", "b", "a"]
    assert [r.source for r in ledger.glass_half_empty(df).collect()] == ["a", "d", "b", "c"]
    times = spark.createDataFrame([("a", "0:00:30"), ("b", None), ("c", "1:00:00"), ("d", None), ("e", "")], "path string, run_time string")
    assert [r.path for r in ledger.batch_order(times).collect()] == ["b", "d", "e", "c", "a"]
    files = spark.createDataFrame([("j", "a", True), ("j", "b", None), ("j", "c", False), ("j", "a2", False)], "job_id string, path string, status boolean")
    assert [r.path for r in ledger.job_file_order(files).collect()] == ["a2", "c", "b", "a"]
    assert [(r.id, r.more) for r in ledger.top_sources(spark.range(23), [F.col("id").desc()]).collect()][:2] == [(22, 3), (21, 3)]
    assert [r.id for r in ledger.page_after(spark.range(60), 40).collect()] == list(range(39, 14, -1))
    dated = ledger_of(spark, [dict(id=1, ts_us=5), dict(id=2), dict(id=3, ts_us=9)])
    assert [r.id for r in ledger.newest_first(dated).collect()] == [3, 1, 2]


def test_touched_files(spark):
    payload = (
        '{"commits": [{"added": ["sources/a.json", "sources/b.json"], "modified": [], "removed": []},'
        '{"added": [], "modified": ["sources/c.json"], "removed": ["sources/a.json"]},'
        '{"added": ["sources/a.json"], "modified": [], "removed": ["sources/b.json", "x.txt"]}]}'
    )
    df = spark.createDataFrame([(1, payload)], "push int, payload string")
    got = changes.touched_files(changes.explode_commits(df, "push"), "push")
    assert sorted(r.file for r in got.collect()) == ["sources/a.json", "sources/c.json"]


@pytest.mark.parametrize(
    "spec, paths, wanted",
    [
        ({"format": "shapefile"}, ["foo.shp"], "foo.shp"), ({"format": "shapefile"}, ["FOO.SHP"], "FOO.SHP"),
        ({"format": "shapefile"}, ["xyzzy/FOO.SHP", "xyzzy/BAR.SHP"], None),
        ({"format": "shapefile", "file": "foo.shp"}, ["xyzzy/foo.shp", "xyzzy/bar.shp"], "xyzzy/foo.shp"),
        ({"format": "geojson"}, ["foo.json", "bar.shp"], "foo.json"), ({"format": "geojson"}, ["a.json", "b.geojson"], None),
        ({"format": "csv"}, ["a.txt", "b.csv"], "b.csv"), ({"format": "csv"}, ["a.txt"], "a.txt"),
        ({"format": "csv", "file": "d/b.txt"}, ["a.csv", "x/b.txt"], "x/b.txt"), ({"format": "csv", "file": "q.csv"}, ["a.csv"], None),
        ({"format": "gdb"}, ["d/foo.gdb", "d/foo.gdb/a1.gdbtable"], "d/foo.gdb"), ({"format": "gdb"}, ["foo.gdb", "bar.gdb"], None),
        ({"format": "gdb", "file": "foo.gdb"}, ["d/foo.gdb/x", "d/bar.gdb"], "d/foo.gdb"),
        ({"format": "xml"}, ["a.txt", "b.gml"], "b.gml"), ({"format": "xml", "file": "c.gml"}, ["b.gml", "z/c.gml"], "z/c.gml"),
        ({"format": "mystery"}, ["a"], None),
    ],
)
def test_select_source_file(spark, spec, paths, wanted):
    df = spark.createDataFrame([(1, i, p) for i, p in enumerate(paths)], "g int, position int, path string")
    assert changes.select_source_file(df, ["g"], spec).first()["source_path"] == wanted
