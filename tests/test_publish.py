"""A source from definition to published files: state, log and sample of every outcome."""

import hashlib
import json
import zipfile
from datetime import timedelta

import pytest

from streetgrain.plans import publish
from streetgrain.schema import state_column

GOOD = "num,street,x,y\n1,Elm Street,7.5,51.5\n2,Oak Street,7.6,51.6\n,,,\n"
CONFORM = {"format": "csv", "number": "num", "street": "street", "lon": "x", "lat": "y"}
COVERAGE = {"ISO 3166": {"alpha2": "XY"}}


def published(spark, tmp_path, definition, data=GOOD, **options):
    raw = tmp_path / "raw"
    raw.mkdir(exist_ok=True)
    if data is not None:
        (raw / "data.csv").write_text(data)
    out = tmp_path / "out"
    state = publish.publish_source(spark, json.dumps(definition), str(raw), str(out), "sources/xy/town.json", **options).first()
    return state, out / "town" / "addresses"


def text(folder):
    return "\n".join(p.read_text().rstrip("\n") for p in sorted(folder.glob("part-*")))


def flat(**more):
    return {"coverage": COVERAGE, "conform": CONFORM, **more}


def test_state_of_a_good_source(spark, tmp_path):
    definition = flat(license={"text": "PD", "attribution": False, "share-alike": "no"}, website="http://town.example")
    state, folder = published(spark, tmp_path, definition, version="2", cache_time=timedelta(minutes=2), code_version="9")
    fields = dict(zip(publish.STATE_FIELDS, state, strict=True))
    assert fields.pop("process time").startswith("0:00:")
    assert fields == {
        "source": "town.json", "skipped": False, "cache": str(tmp_path / "raw"), "sample": "sample.json", "website": "http://town.example", "license": "PD",
        "geometry type": None, "address count": 3, "version": "2", "fingerprint": hashlib.md5(GOOD.encode()).hexdigest(), "cache time": "0:02:00",
        "processed": "out.csv", "output": "output.txt", "preview": None, "slippymap": None, "attribution required": "false", "attribution name": None,
        "share-alike": "false", "source problem": None, "code version": "9", "tests passed": None,
    }
    folder = folder / "primary"
    names, values = json.loads(text(folder / "index.json"))
    assert names == publish.STATE_FIELDS and dict(zip(names, values, strict=True))["address count"] == 3
    assert json.loads(text(folder / "sample.json")) == [["num", "street", "x", "y"], ["1", "Elm Street", "7.5", "51.5"], ["2", "Oak Street", "7.6", "51.6"], ["", "", "", ""]]
    rows = spark.read.option("header", "true").csv(str(folder / "out.csv"))
    assert sorted((r.NUMBER or "", r.STREET or "", r.LON or "") for r in rows.collect()) == [("", "", ""), ("1", "Elm Street", "7.5"), ("2", "Oak Street", "7.6")]
    assert "3 addresses, 2 located" in text(folder / "output.txt")


@pytest.mark.parametrize(
    "definition, data, problem, cached",
    [
        (flat(skip=True), GOOD, "Source says to skip", False),
        ({"coverage": COVERAGE}, GOOD, "Source is missing a conform object", True),
        (flat(conform={**CONFORM, "format": "gdb"}), GOOD, "Unknown source conform format", True),
        (flat(conform={**CONFORM, "number": ["none", "num"]}), GOOD, "Could not conform source data", True),
        (flat(conform={**CONFORM, "file": "other.csv"}), GOOD, "Could not conform source data", True),
        (flat(), "num,street,x,y\n", "Found no addresses in source data", True),
        (flat(), "", "Could not conform source data", True),
        (flat(test={"acceptance-tests": [{"inputs": {"num": "1"}, "expected": {"number": "2"}}]}), GOOD, "An acceptance test failed", False),
        ({"conform": CONFORM}, GOOD, "Missing or incomplete coverage", True),
        ({"layers": {"buildings": []}, "coverage": COVERAGE}, GOOD, None, False),
        ({"layers": {"addresses": [{"conform": CONFORM}]}, "coverage": {}}, GOOD, "Missing or incomplete coverage", False),
    ],
)
def test_state_of_what_goes_wrong(spark, tmp_path, definition, data, problem, cached):
    state, _ = published(spark, tmp_path, definition, data)
    assert state.source_problem == problem
    assert (state.cache is not None) == cached and state.skipped == (problem == "Source says to skip")
    good = problem == "Missing or incomplete coverage" and cached
    assert (state.processed is not None) == good and state.address_count == (3 if good else 0 if cached else None)
    assert state.tests_passed is (False if problem == "An acceptance test failed" else None)


def test_member_of_an_archive(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    with zipfile.ZipFile(raw / "all.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("readme.txt", "hello")
        z.writestr("deep/Streets.CSV", "a,b\n1,2\n")
        z.writestr("deep/town.csv", 'num,street,x,y\r\n5,"Long\nLane",1,2\r\n6,Short Way,3,4')
    definition = flat(compression="zip", conform={**CONFORM, "file": "deep/town.csv"})
    state, folder = published(spark, tmp_path, definition, None)
    assert (state.address_count, state.source_problem) == (2, None)
    rows = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(str(folder / "primary" / "out.csv")).collect()
    assert sorted((r.NUMBER, r.STREET) for r in rows) == [("5", "Long\nLane"), ("6", "Short Way")]
    state, _ = published(spark, tmp_path, flat(compression="zip", conform={**CONFORM, "file": "deep/none.csv"}), None)
    assert state.source_problem == "Could not conform source data"


def test_sample_knows_the_geometry(spark):
    rows = spark.createDataFrame([("1", "2", "POLYGON ((0 0, 1 0, 1 1, 0 0))", "a")], "`OA:x` string, `OA:y` string, `OA:geom` string, n string")
    assert publish.sample_of(rows) == ([rows.columns, list(rows.first())], None)
    placed = rows.select("n", "OA:x", "OA:y", "OA:geom")
    assert publish.sample_of(placed)[1] == "Polygon"
    assert publish.sample_of(placed.limit(0)) == (None, None)


def test_state_fields_are_columns():
    assert len(publish.STATE_FIELDS) == 22 and len({state_column(f) for f in publish.STATE_FIELDS}) == 22


def test_parcels_of_a_run_table(spark, tmp_path):
    caches = tmp_path / "caches"
    caches.mkdir()
    parcels = 'num,st,OA:geom\n4,Elm,"POLYGON ((0 0, 1 0, 1 1, 0 0))"\n5,Oak,POINT (1 1)\n6,,"POLYGON ((2 2, 3 2, 3 3, 2 2))"\n'
    (caches / "a.csv").write_text(parcels)
    with zipfile.ZipFile(caches / "b.zip", "w") as z:
        z.writestr("in/b.csv", parcels)
    header = ["source", "cache", "geometry type", "processed"]
    rows = [
        ["xy/a.json", str(caches / "a.csv"), "Polygon", "p"], ["xy/b.json", str(caches / "b.zip"), "MultiPolygon", "p"],
        ["xy/c.json", str(caches / "none.csv"), "Polygon 2.5D", "p"], ["xy/d.json", str(caches / "a.csv"), "Point", "p"], ["xy/e.json", str(caches / "a.csv"), "Polygon", ""],
    ]
    (tmp_path / "state.txt").write_text("".join("\t".join(r) + "\n" for r in [header, *rows]))
    out = publish.publish_parcels(spark, str(tmp_path / "state.txt"), {"number": "num", "street": "st"}, str(tmp_path / "out")).collect()
    assert [(r.source, r.parcels, r.problem is None) for r in out] == [("xy/a.json", 2, True), ("xy/b.json", 2, True), ("xy/c.json", 0, False)]
    for name in "ab":
        back = spark.read.option("header", "true").option("escape", '"').csv(str(tmp_path / "out" / "xy" / f"{name}.csv")).collect()
        assert sorted((r.NUMBER, r.STREET, r.geom[:7]) for r in back) == [("4", "Elm", "POLYGON"), ("6", None, "POLYGON")]


def test_files_of_a_source_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    from streetgrain import catalog
    from streetgrain.catalog import products

    spark.range(400).selectExpr("id AS l_orderkey", "id % 50 AS l_partkey").write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(products, "scratch_path", lambda spark, name: str(tmp_path / name))
    state = catalog.queries()["E01_source_state"](spark, str(tmp_path)).first()
    files = sorted((tmp_path / "source").glob("b=*/part-*"))
    assert len(files) == 8 and state.address_count == 400
    # By number and key alone, three files fell to one task, and no task but four had any.
    assert len({f.name.split("-")[1] for f in files}) >= 7
    lines = files[0].read_text().splitlines()
    assert lines[0] == ",".join(products.SOURCE_COLUMNS) and len(lines) == 51
    digests = "".join(hashlib.md5(f.read_bytes()).hexdigest() for f in files)
    assert state.fingerprint == hashlib.md5(digests.encode()).hexdigest()
