import csv
import io
import random
import zipfile

import pytest

from pyspark.sql import functions as F

from streetgrain.session import scratch_path
from streetgrain.sources import csv_splits, readers, writers


def read(spark, tmp_path, data: bytes, **options):
    path = tmp_path / "in.csv"
    path.write_bytes(data)
    return readers.read_source_csv(spark, str(path), **options)


HEADER, ROW = "STREETNAME,NUMBER,LATITUDE,LONGITUDE", "MAPLE ST,123,39.3,-121.2"


def test_plain_and_delimiter(spark, tmp_path):
    df = read(spark, tmp_path, f"{HEADER}\n{ROW}".encode())
    assert df.columns == HEADER.split(",") and tuple(df.first()) == tuple(ROW.split(","))
    df = read(spark, tmp_path, f"{HEADER}\n{ROW}".replace(",", ";").encode(), delimiter=";")
    assert tuple(df.first()) == tuple(ROW.split(","))


@pytest.mark.parametrize("encoding", ["utf-8", "shift-jis", "shift_jisx0213", "utf-16", "euc-jp"])
def test_charsets(spark, tmp_path, encoding):
    header, row = "大字・町丁目名,NUMBER,緯度,LONGITUDE", "東 ST,123,39.3,-121.2"
    df = read(spark, tmp_path, f"{header}\n{row}\n".encode(encoding), encoding=encoding)
    assert df.columns == header.split(",") and tuple(df.first()) == tuple(row.split(","))


def test_latin1(spark, tmp_path):
    df = read(spark, tmp_path, "é,b\nñ,2\n".encode("latin-1"), encoding="iso-8859-1")
    assert df.columns == ["é", "b"] and tuple(df.first()) == ("ñ", "2")


def test_headers(spark, tmp_path):
    df = read(spark, tmp_path, ROW.encode(), headers=-1)
    assert df.columns == ["COLUMN1", "COLUMN2", "COLUMN3", "COLUMN4"] and tuple(df.first()) == tuple(ROW.split(","))
    df = read(spark, tmp_path, f"HAHA,THIS,HEADER,IS,FAKE\n{HEADER}\n{ROW}\n".encode(), headers=2, skiplines=2)
    assert df.columns == HEADER.split(",") and [tuple(r) for r in df.collect()] == [tuple(ROW.split(","))]
    with pytest.raises(ValueError):
        read(spark, tmp_path, b"a\n1", skiplines=2)
    with pytest.raises(ValueError):
        read(spark, tmp_path, b"a\n1", headers=2, skiplines=3)


def test_ragged_rows(spark, tmp_path):
    data = b'a,b,c\n1,2,3\n1,2,3,4\n1\n1,,\n"x,y","q""q",z\n"x,y"\n'
    rows = [tuple(r) for r in read(spark, tmp_path, data).collect()]
    assert rows == [("1", "2", "3"), ("1", None, None), ("1", "", ""), ("x,y", 'q"q', "z"), ("x,y", None, None)]


def test_ragged_rows_with_pruned_columns(spark, tmp_path):
    df = read(spark, tmp_path, b"a,b,c\n1,2,3\n1,2,3,4\n5\n").select("a")
    assert [r.a for r in df.collect()] == ["1", "5"]


def test_geojson(spark, tmp_path):
    (tmp_path / "f.json").write_text(
        '{"type": "FeatureCollection", "features": ['
        '{"type": "Feature", "properties": {"a": "x", "n": 1.5}, "geometry": {"type": "Polygon", "coordinates": [[[0,0],[2,0],[2,2],[0,2],[0,0]]]}},'
        '{"type": "Feature", "properties": {"a": null, "z": 1}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0,0],[2,0],[2,2],[0,2],[0,0]]],[[[8,0],[10,0],[10,2],[8,2],[8,0]]]]}},'
        '{"type": "Feature", "properties": {}, "geometry": null},'
        '{"type": "Feature", "properties": {"a": "l"}, "geometry": {"type": "MultiPoint", "coordinates": [[0,0],[4,2]]}}]}'
    )
    df = readers.read_geojson(spark, str(tmp_path / "f.json"))
    assert df.columns == ["a", "n", "OA:x", "OA:y"]
    assert [tuple(r) for r in df.collect()] == [("x", "1.5", "1.0", "1.0"), (None, None, "5.0", "1.0"), ("l", None, "2.0", "1.0")]


def test_esri(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"fields": [{"name": "A"}, {"name": "B"}], "features": ['
        '{"attributes": {"A": "1", "B": 2}, "geometry": {"x": -122.123456789, "y": 37.5}},'
        '{"attributes": {"A": "nan"}, "geometry": {"x": "NaN", "y": 1}}, {"attributes": {"A": "none"}},'
        '{"attributes": {"A": "r"}, "geometry": {"rings": [[[0,0],[0,2],[2,2],[2,0],[0,0]]]}},'
        '{"attributes": {"A": "e"}, "geometry": {"rings": []}},'
        '{"attributes": {"A": "p"}, "geometry": {"paths": [[[0,0],[4,0]]]}}]}'
    )
    rows = readers.read_esri_features(spark, str(tmp_path / "p.json"))
    assert rows.columns == ["A", "B", "OA:x", "OA:y", "OA:geom"]
    assert [tuple(r)[:4] for r in rows.collect()] == [("1", "2", "-122.1234568", "37.5"), ("r", None, "1.0", "1.0"), ("p", None, "2.0", "0.0")]
    assert readers.read_esri_features(spark, str(tmp_path / "p.json"), ["B"]).columns == ["B", "OA:x", "OA:y", "OA:geom"]


def test_xml(spark, tmp_path):
    (tmp_path / "f.gml").write_text(
        '<?xml version="1.0"?><o:FeatureCollection xmlns:o="http://o" xmlns:g="http://g"><g:featureMember><o:place>'
        "<o:geometryProperty><g:Point><g:coordinates>-122.25,37.8</g:coordinates></g:Point></o:geometryProperty><o:NUMBER>5115</o:NUMBER>"
        "</o:place></g:featureMember></o:FeatureCollection>"
    )
    rows = readers.read_xml_features(spark, str(tmp_path / "f.gml"), "o:place", ["NUMBER"], "geometryProperty.Point.coordinates")
    assert [tuple(r) for r in rows.collect()] == [("5115", "-122.25", "37.8")]


def test_zip_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("README.txt", "x")
        z.writestr("one.csv", "LON,LAT\n1,2\n,4\n")
        z.writestr("two.csv", "LAT,X\n9,9\n")
    rows = readers.read_zipped_csv(spark, str(tmp_path), ["LON", "LAT"], batch_rows=1)
    assert sorted(((r.member, r.LON, r.LAT) for r in rows.collect()), key=str) == [("one.csv", "", "4"), ("one.csv", "1", "2"), ("two.csv", None, "9")]
    assert readers.read_zipped_csv(spark, str(tmp_path), ["LON"], first_member_only=True).count() == 2


def test_definitions_and_fingerprints(spark, tmp_path):
    (tmp_path / "us" / "ca").mkdir(parents=True)
    (tmp_path / "us" / "ca" / "x.json").write_text('{"a":\n 1}')
    (tmp_path / "y.JSON").write_text("{}")
    (tmp_path / "z.txt").write_text("no")
    found = {r.path: r.definition for r in readers.read_source_definitions(spark, str(tmp_path)).collect()}
    assert found == {"us/ca/x.json": '{"a":\n 1}', "y.JSON": "{}"}
    prints = {r.path.split("/")[-1]: r.fingerprint for r in readers.fingerprint_files(spark, str(tmp_path)).collect()}
    assert prints["y.JSON"] == "99914b932bd37a50b983c5e7c90ae93b" and len(prints) == 3


def test_excerpt(spark):
    df = spark.createDataFrame([(i, "POINT (1 2)") for i in range(9)], "i int, g string")
    rows = readers.excerpt(df, ["i"], 5, "g").collect()
    assert [r.i for r in rows] == [0, 1, 2, 3, 4] and rows[0].geometry_type == "Point"


def test_geojson_lines_round_trip(spark):
    df = spark.createDataFrame([(1.5, 2.5, "a", None)], "lon double, lat double, NUMBER string, UNIT string")
    path = scratch_path(spark, "t")
    writers.write_geojson_lines(df, path)
    back = readers.read_geojson(spark, path, lines=True)
    assert back.columns == ["NUMBER", "UNIT", "OA:x", "OA:y"] and tuple(back.first()) == ("a", None, "1.5", "2.5")


def test_quoted_line_ends(spark, tmp_path):
    data = b'NUM,STREET,CITY\n1,"MAIN\nSTREET",A\n2,"X\r\n\r\nY","Q ""Z"""\n\n3,5" x,6" y\n'
    rows = [tuple(r) for r in read(spark, tmp_path, data).collect()]
    assert rows == [("1", "MAIN\nSTREET", "A"), ("2", "X\n\nY", 'Q "Z"'), ("3", '5" x', '6" y')]


def test_skipped_lines_go_by_place(spark, tmp_path):
    data = b"t,t\na,b\nt,t\na,b\n1,2\n"
    assert [tuple(r) for r in read(spark, tmp_path, data, headers=2, skiplines=2).collect()] == [("t", "t"), ("a", "b"), ("1", "2")]


def test_headers_of_several_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n")
    (folder / "2.csv").write_text("a,b\na,b\n3,4\n")
    rows = sorted(tuple(r) for r in readers.read_source_csv(spark, str(folder)).collect())
    assert rows == [("1", "2"), ("3", "4"), ("a", "b")]
    (folder / "3.csv").write_text("b,a\n5,6\n")
    with pytest.raises(Exception, match="another header"):
        readers.read_source_csv(spark, str(folder)).collect()


def test_long_files_and_lines_apart(spark, tmp_path):
    body = "".join(f'{i},"v\n{i}"\n' for i in range(3000))
    (tmp_path / "long.csv").write_text("a,b\n" + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096b")
    try:
        rows = readers.read_source_csv(spark, str(tmp_path / "long.csv")).collect()
        assert sorted(tuple(r) for r in rows) == sorted((str(i), f"v\n{i}") for i in range(3000))
        (tmp_path / "flat.csv").write_text("a,b\n" + "".join(f'{i},"y,{i}"\n' for i in range(3000)))
        flat = readers.read_source_csv(spark, str(tmp_path / "flat.csv"), by_line=True).collect()
        assert sorted(tuple(r) for r in flat) == sorted((str(i), f"y,{i}") for i in range(3000))
        with pytest.raises(Exception, match="beyond its line"):
            readers.read_source_csv(spark, str(tmp_path / "long.csv"), by_line=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_collections_and_empty_sources(spark, tmp_path):
    point, line = '{"type":"Point","coordinates":[9,9]}', '{"type":"LineString","coordinates":[[0,0],[4,0]]}'
    square = '{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,2],[0,0]]]}'
    multi = '{"type":"MultiPolygon","coordinates":[[[[10,0],[12,0],[12,2],[10,2],[10,0]]]]}'
    kinds = [[point, line], [point, line, square, multi], [point], []]
    geometry = [f'{{"type":"GeometryCollection","geometries":[{",".join(k)}]}}' for k in kinds]
    (tmp_path / "c.json").write_text("".join(f'{{"properties":{{"i":{i}}},"geometry":{g}}}\n' for i, g in enumerate(geometry)))
    got = {r.i: (float(r["OA:x"]), float(r["OA:y"])) for r in readers.read_geojson(spark, str(tmp_path / "c.json"), lines=True).collect()}
    assert got == {"0": (2.0, 0.0), "1": (6.0, 1.0), "2": (9.0, 9.0)}
    with pytest.raises(Exception, match="not enough rows"):
        readers.excerpt(spark.range(0), ["id"]).collect()


def odd_csv(seed: int, records: int) -> str:
    """Records with quotes, delimiters and line ends where they may be and where they hardly should."""
    pick = random.Random(seed)
    bits = ['"', '""', ",", "\n", "\r\n", "\r", "a", "b c", " ", "é"] if seed % 2 else ["x", "yy", ",", "z\n", '""', "1"]
    out = []
    for i in range(records):
        fields = []
        for _ in range(3):
            text = "".join(pick.choice(bits) for _ in range(pick.randrange(6)))
            kind = pick.random()
            if kind < 0.5:
                fields.append('"' + text.replace('"', '""') + '"')
            elif kind < 0.55:
                fields.append('"' + "long\n" * pick.randrange(400) + '"')
            else:
                fields.append("".join(c for c in text if c not in ",\n\r").lstrip('"'))
        out.append(",".join([str(i), *fields]) + pick.choice(["\n", "\n", "\r\n"]))
    return "".join(out)


@pytest.mark.parametrize("seed", range(6))
def test_csv_in_pieces(spark, tmp_path, seed):
    text = "i,a,b,c\n" + odd_csv(seed, 400) + ('7,"never closed\n"",x' if seed == 3 else "")
    (tmp_path / "odd.csv").write_bytes(text.encode())
    (tmp_path / "two.csv").write_bytes(("i,a,b,c\n" + odd_csv(seed + 50, 100)).encode())
    want = []
    for name in ("odd.csv", "two.csv"):
        lines = (tmp_path / name).read_bytes().decode().replace("\r\n", "\n").replace("\r", "\n")
        lines += "" if lines.endswith("\n") else "\n"
        want += [(*r, *[None] * (4 - len(r))) for r in csv.reader(io.StringIO(lines)) if r and len(r) <= 4 and r != ["i", "a", "b", "c"]]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "3000b", "700b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = readers.read_source_csv(spark, str(tmp_path)).collect()
            assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_pieces_of_a_file_run_in_many_tasks(spark, tmp_path):
    (tmp_path / "long.csv").write_text("a,b\n" + "".join(f'{i},"v\n{i}"\n' for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096b")
    try:
        rows = readers.read_source_csv(spark, str(tmp_path / "long.csv"))
        tasks = rows.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(tasks) > 5 and max(r["count"] for r in tasks) < 600
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("seed", range(4))
def test_state_at_line_ends(seed):
    text = odd_csv(seed, 60).replace("\r\n", "\n").replace("\r", "\n")
    ends, reader = set(), csv.reader(io.StringIO(text))
    for _ in reader:
        ends.add(reader.line_num)
    state = False
    for n, line in enumerate(io.StringIO(text), 1):
        state = csv_splits.stays_open(line, state, ",")
        assert state == (n not in ends)


def bytes_read(spark) -> int:
    """Bytes that the files of this session's process were read for up to now."""
    return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def test_esri_pages_are_read_once(spark, tmp_path, monkeypatch):
    feature = '{"attributes": {"A": "%d", "B": %d.50}, "geometry": {"x": %d, "y": 1}}'
    page = '{"fields": [{"name": "A"}, {"name": "B"}], "features": [%s]}'
    for p in range(3):
        (tmp_path / f"{p}.json").write_text(page % ", ".join(feature % (i, i, i % 90) for i in range(p * 300, p * 300 + 300)))
    size = sum(f.stat().st_size for f in tmp_path.iterdir())
    rows = readers.read_esri_features(spark, str(tmp_path))
    before = bytes_read(spark)
    kept = sorted(map(tuple, rows.collect()))
    # Before, each number that became text was read from the file by itself.
    assert bytes_read(spark) - before < 3 * size
    assert kept[0] == ("0", "0.50", "0.0", "1.0", "POINT (0.0 1.0)") and len(kept) == 900
    monkeypatch.setattr(readers, "_IN_MEMORY", 0)
    assert sorted(map(tuple, readers.read_esri_features(spark, str(tmp_path)).collect())) == kept


def test_geojson_is_parsed_once(spark, tmp_path):
    feature = '{"properties": {"a": "%d", "n": %d.50}, "geometry": %s}'
    point, line = '{"type": "Point", "coordinates": [9, 9]}', '{"type": "LineString", "coordinates": [[0, 0], [4, 0]]}'
    both = '{"type": "GeometryCollection", "geometries": [%s, %s]}' % (point, line)
    pick = [point, line, both, "null"]
    (tmp_path / "0.json").write_text('{"features": []}')
    for p in range(1, 4):
        features = ", ".join(feature % (i, i, pick[i % 4]) for i in range(p * 400, p * 400 + 400))
        (tmp_path / f"{p}.json").write_text('{"type": "FeatureCollection", "features": [%s]}' % features)
    size = sum(f.stat().st_size for f in tmp_path.iterdir())
    before = bytes_read(spark)
    rows = readers.read_geojson(spark, str(tmp_path))
    got = {int(r.a): (r.n, r["OA:x"], r["OA:y"]) for r in rows.collect()}
    # All of it once for the columns, since the first file is empty, and once for the rows.
    assert bytes_read(spark) - before < 3 * size
    assert len(got) == 900 and got[400] == ("400.50", "9.0", "9.0") and got[401] == ("401.50", "2.0", "0.0") and got[402] == ("402.50", "2.0", "0.0")
    (tmp_path / "0.json").write_text('{"features": [%s]}' % (feature % (1, 1, point)))
    before = bytes_read(spark)
    assert readers.read_geojson(spark, str(tmp_path)).count() == 901
    assert bytes_read(spark) - before < 1.5 * size


def test_readmes_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    # As many as the shuffle before has, so that Spark could do without the second.
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", 4)
    sources = spark.range(40).selectExpr("concat('us/s', id) AS source", "CAST(NULL AS STRING) AS website", "'Free' AS license", "'d' AS date").distinct()
    empty = {c: F.lit("x") for c in writers.ADDRESS_COLUMNS}
    writers.package_outputs(sources.select("source").withColumns(empty), sources, str(tmp_path))
    notes = list((tmp_path / "readme").glob("source=*/part-*"))
    assert len(notes) == 40 and len({n.name.split("-")[1] for n in notes}) > 1
    assert notes[0].read_text().startswith("Website: Unknown\nLicense: Free\nDate: d\n")
    assert len(list((tmp_path / "data").glob("source=*"))) == 40


def test_licence_texts_of_collections_do_not_read_the_points_again(spark, tmp_path, monkeypatch):
    from streetgrain import catalog

    keys = "id AS l_orderkey, id % 5 AS l_partkey, id % 30 AS l_suppkey, CAST(id % 7 + 1 AS INT) AS l_linenumber, 'N' AS l_returnflag"
    spark.range(300).selectExpr(*keys.split(", ")).write.parquet(str(tmp_path / "lineitem.parquet"))
    seen, write = [], writers.write_collections
    monkeypatch.setattr(writers, "write_collections", lambda rows, texts, path: (seen.append(texts), write(rows, texts, path)))
    found = catalog.queries()["S10_write_collections"](spark, str(tmp_path)).collect()
    assert sum(r.n for r in found if r.collection == "global") == 300 and len({r.source for r in found}) == 30
    assert not any("lineitem" in f for f in seen[0].inputFiles())
    assert seen[0].where("source_base IS NOT NULL").select("source_base").distinct().count() == 30


def test_packages_are_read_back_some_folders_at_a_time(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameReader

    from streetgrain import catalog

    keys = "id AS l_orderkey; id % 5 AS l_partkey; nullif(id % 31, 30) AS l_suppkey; CAST(id % 7 + 1 AS INT) AS l_linenumber; 'N' AS l_returnflag"
    spark.range(310).selectExpr(*keys.split("; ")).write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(readers, "_FOLDERS", 7, raising=False)
    files = []
    for name in ("load", "csv", "text"):
        def read(self, *a, f=getattr(DataFrameReader, name), **b):
            df = f(self, *a, **b)
            files.append({x for x in df.inputFiles() if "source=" in x})
            return df

        monkeypatch.setattr(DataFrameReader, name, read)
    found = catalog.queries()["S15_package_outputs"](spark, str(tmp_path)).collect()
    # Rows without a latitude aren't on earth, so no source is null.
    assert sorted(r.n for r in found) == [10] * 30 and len({r.source for r in found}) == 30
    assert all(r.readme == f"Website: http://{r.source} License: Unknown Date: 2024-01-01" for r in found)
    # Before, the driver listed the files of all sources at once.
    assert len(set().union(*files)) == 60 and max(map(len, files)) <= 7


def test_folders_are_found_by_their_values(spark, tmp_path, monkeypatch):
    names = ["a/b=c%", "a:b", "{x}", "}", "[y]*?^", "é ü", " ", "'\"#\\", "x\ny\t\x7f", "%41", "", "1", "1", None, "a,b"]
    rows = spark.createDataFrame([(n, str(i)) for i, n in enumerate(names)], "source string, value string")
    rows.write.mode("overwrite").partitionBy("source").text(str(tmp_path))
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    marks = spark.createDataFrame([(chr(c),) for c in range(1, 256)], "v string")
    assert sorted(f for part in readers.folder_names(marks) for f in part) == sorted(f"v={escaped(chr(c))}" for c in range(1, 256))
    monkeypatch.setattr(readers, "_FOLDERS", 4)
    parts = [readers.read_folders(spark, str(tmp_path), f, "text", "value string, source string").collect() for f in readers.folder_names(rows.select("source"))]
    assert len(parts) == 4 and all(len({r.source for r in p}) <= 4 for p in parts)
    assert sorted((r.source or "", r.value) for p in parts for r in p) == sorted((n or "", str(i)) for i, n in enumerate(names))
    assert list(readers.folder_names(rows.select("source").limit(0))) == []


def test_many_folders_are_listed_by_fewer_tasks(spark, tmp_path):
    for i in range(260):
        (tmp_path / f"source={i}").mkdir()
        (tmp_path / f"source={i}" / "part-0").write_text("x\n")
    context = spark.sparkContext
    context.setJobGroup("listing", "listing")
    try:
        assert spark.read.schema("value string, source int").text(str(tmp_path)).select("source").distinct().count() == 260
        status = context.statusTracker()
        stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("listing") for s in status.getJobInfo(j).stageIds]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    # Before, a task for each.
    assert 100 < max(s.numTasks for s in stages if s) <= 200


def test_small_sources_take_one_file(spark, tmp_path, monkeypatch):
    # Each source has rows in all parts of the input, and four partitions of all sources are too large.
    monkeypatch.setattr(writers, "_SOURCES", 2, raising=False)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        rows = spark.range(0, 24000, 1, 8).selectExpr("concat('us/s', id % 40) AS source", *[f"sha2(CAST(id AS STRING), 256) AS `{c}`" for c in writers.ADDRESS_COLUMNS[:2]], *[f"'x' AS `{c}`" for c in writers.ADDRESS_COLUMNS[2:]])
        sources = spark.range(40).selectExpr("concat('us/s', id) AS source", "'w' AS website", "'l' AS license", "'d' AS date")
        writers.package_outputs(rows, sources, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "data").glob("source=*/part-*"))
    assert len({f.parent for f in files}) == 40
    assert len(files) == 40
