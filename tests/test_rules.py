import json

import pytest
from pyspark.sql import functions as F

from streetgrain.functions import areas, licenses, rules, text


def value(spark, expression, **columns):
    names = list(columns)
    df = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{n} string" for n in names))
    return df.select(expression(*[F.col(n) for n in names])).first()[0]


LICENSES = [
    (None, None), ("Public Domain", "Public Domain"), ({"text": "a"}, "a"), ({"url": "u"}, "u"), ({"text": "a", "url": "u"}, "a (u)"), ({}, None), (9, "9"),
]


@pytest.mark.parametrize("tag, wanted", LICENSES)
def test_license(spark, tag, wanted):
    assert value(spark, licenses.license_text, a=None if tag is None else json.dumps(tag)) == wanted


@pytest.mark.parametrize(
    "license, attribution, wanted",
    [
        (None, None, (False, None)), (None, "", (False, None)), (None, False, (False, None)), (None, "Joe", (True, "Joe")),
        ({"attribution name": "Joe"}, None, (True, "Joe")), ({"attribution": True, "attribution name": "Joe"}, None, (True, "Joe")),
        ({"attribution": False, "attribution name": "Joe"}, None, (False, None)), ({"attribution": None, "attribution name": "Joe"}, None, (True, "Joe")),
        ({"attribution": True}, None, (True, None)), ({"attribution": False}, "Joe", (False, None)), ({}, "Joe", (True, "Joe")), ("text", "Joe", (True, "Joe")),
    ],
)
def test_attribution(spark, license, attribution, wanted):
    got = value(spark, licenses.attribution, a=None if license is None else json.dumps(license), b=None if attribution is None else json.dumps(attribution))
    assert tuple(got) == wanted


@pytest.mark.parametrize(
    "tag, wanted",
    [("no", False), ("Yes", True), ("f", False), ("TRUE", True), ("", False), (None, False), (True, True), (False, False), ("perhaps", None)],
)
def test_share_alike(spark, tag, wanted):
    assert value(spark, licenses.share_alike, a=json.dumps({"share-alike": tag})) is wanted
    assert value(spark, licenses.share_alike, a='"text"') is None


@pytest.mark.parametrize(
    "coverage, wanted", [({}, False), ({"coverage": "Wat"}, False), ({"coverage": {"Wat": None}}, False), ({"coverage": {"ISO 3166": None}}, True),
                         ({"coverage": {"US Census": {}}}, True), ({"coverage": {"geometry": {}}}, True)],
)
def test_coverage_complete(spark, coverage, wanted):
    assert value(spark, rules.coverage_complete, a=json.dumps(coverage)) is wanted


@pytest.mark.parametrize(
    "cache, geometry, wanted",
    [(None, None, None), ("f.zip", "Polygon", "shapefile-polygon"), ("f.zip", "MultiPolygon", "shapefile-polygon"), ("f.zip", "Point", "shapefile"),
     ("f.zip", None, "shapefile"), ("f.json", None, "geojson"), ("f.csv", None, "csv"), ("f.bar", None, None)],
)
def test_conform_type(spark, cache, geometry, wanted):
    assert value(spark, rules.conform_type, a=cache, b=geometry) == wanted


@pytest.mark.parametrize(
    "log, definition, wanted",
    [
        ("WARNING: A source test failed; WARNING: Could not download source data", {}, "An acceptance test failed"),
        ("WARNING: Could not download ESRI source data: Could not retrieve layer metadata: Token Required", {}, "Missing required ESRI token"),
        ("fine", {}, "Missing or incomplete coverage"), ("fine", {"coverage": {"US Census": {}}}, None),
    ],
)
def test_source_problem(spark, log, definition, wanted):
    assert value(spark, rules.source_problem, a=log, b=json.dumps(definition)) == wanted


def test_upgrade(spark):
    v1 = {"coverage": {"x": [1, 2.5]}, "data": "http://a\"b", "conform": {"street": ["a"]}}
    got = json.loads(value(spark, rules.upgrade_source_schema, a=json.dumps(v1)))
    assert got == {"coverage": v1["coverage"], "layers": {"addresses": [{"name": "primary", "data": v1["data"], "conform": v1["conform"]}]}}
    v2 = '{"schema": 2, "layers": {}}'
    assert value(spark, rules.upgrade_source_schema, a=v2) == v2


@pytest.mark.parametrize(
    "base, wanted",
    [
        ("us/ca", {"us_west"}), ("us-ca", {"us_west"}), ("us/ca/oakland", {"us_west"}), ("us-ca-oakland", {"us_west"}), ("us-ca.old", {"us_west"}),
        ("us/ca-x", set()), ("us/cal", set()), ("ca/on", {"north_america"}), ("ca", {"north_america"}), ("de-berlin", {"europe"}), ("de.x", {"europe"}),
        ("au/nsw", {"asia"}), ("br/sp", {"south_america"}), ("za", set()), ("us/dc", {"us_south"}), ("us/vt", {"us_northeast"}),
    ],
)
def test_areas(spark, base, wanted):
    assert set(value(spark, areas.areas_of, a=base)) == wanted | {"global"}


def test_urls(spark):
    host = "data.example.org"
    for url, wanted in {
        "http://data.example.org/a.zip?x=1": "https://data.example.org/a.zip",
        "http://s3.amazonaws.com/data.example.org/a/b.csv": "https://data.example.org/a/b.csv",
        "https://data.example.org.s3.amazonaws.com/a.csv": "https://data.example.org/a.csv",
        "http://s3.amazonaws.com/other/a.csv": "http://s3.amazonaws.com/other/a.csv", "http://elsewhere/x?y": "http://elsewhere/x?y",
    }.items():
        assert value(spark, lambda c: text.canonical_url(c, host), a=url) == wanted
    guess = lambda url, kind=None, name=None: value(spark, lambda u, k, n: text.guess_extension(u, k, n, F.lit("text/csv")), a=url, b=kind, c=name)
    assert guess("http://h/a.zip") == ".zip" and guess("http://h/a.php", "application/zip") == ".zip"
    assert guess("http://h/a.zip?x", "application/json; charset=utf8") == ".json"
    assert guess("http://h/a.zip?x", "application/json", 'attachment; filename="b.csv"') == ".csv"
    assert guess("http://h/a.zip?x", "application/zip", "attachment; filename=b.zip") == ".zip"
    assert guess("http://h/a") == ".csv"


@pytest.mark.parametrize(
    "seconds, wanted",
    [(172800, "2 days ago"), (133200, "2 days ago"), (129600, "36 hours ago"), (86400, "24 hours ago"), (7200, "2 hours ago"), (5460, "2 hours ago"),
     (5400, "90 minutes ago"), (3600, "60 minutes ago"), (120, "2 minutes ago"), (91, "2 minutes ago"), (90, "90 seconds ago"), (1209600, "2 weeks ago"), (8640000, "Sep 22, 2023")],
)
def test_age(spark, seconds, wanted):
    df = spark.range(1).select(text.nice_age(F.lit(seconds), F.lit("2023-12-31 00:00:00").cast("timestamp")))
    assert df.first()[0] == wanted


def test_sizes_and_integers(spark):
    for size, wanted in {5: "5.0B", 1023: "1023B", 1536: "1.5KB", 20480: "20KB", 5 * 2**20: "5.0MB", 2**40: "1.0TB", 2304: "2.2KB"}.items():
        assert spark.range(1).select(text.nice_size(F.lit(size))).first()[0] == wanted
    for n, wanted in {9: "9", 1000: "1,000", 999999999: "999,999,999"}.items():
        assert spark.range(1).select(text.nice_integer(F.lit(n))).first()[0] == wanted


@pytest.mark.parametrize("body, wanted", [("re-run this please", True), ("Rerun this, please and thanks", True), ("no\nRe-run this, please", True), ("pleasere-run this pleased", False), ("x rerun this please", False)])
def test_rerun_comment(spark, body, wanted):
    payload = json.dumps({"action": "created", "issue": {"pull_request": {}}, "comment": {"body": body}})
    assert value(spark, rules.event_rerun, a=payload) is wanted
    assert value(spark, lambda p: rules.event_skip(F.lit("issue_comment"), p), a=payload) is not wanted
    assert value(spark, lambda p: rules.event_skip(F.lit("issue_comment"), p), a=payload.replace("pull_request", "other")) is True


def test_guesses(spark):
    country = lambda *a: value(spark, areas.guess_country, a=a[0], b=a[1], c=a[2], d=a[3])
    assert country("FR", "DE-BE", "06", "sources/jp/x.json") == "FR"
    assert country("", "DE-BE", "06", "sources/jp/x.json") == "DE"
    assert country("", "", "06", "sources/jp/x.json") == "US"
    assert country("", None, "", "sources/jp/x.json") == "JP"
    state = lambda *a: value(spark, areas.guess_state, a=a[0], b=a[1])
    assert state("06001", "") == "CA" and state("99", "") is None
    assert state("", "sources/us/ny/x.json") == "NY" and state("", "sources/ca/on/x.json") is None and state("", "sources/us/x.json") is None
