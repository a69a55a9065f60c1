"""Readers of source tables. Files are read in parallel by Spark's own sources
wherever those understand the format; Arrow functions decode the rest."""

from __future__ import annotations

import codecs
import csv
import io
import itertools
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetgrain.functions import geo
from streetgrain.schema import GEOM_COLUMN, X_COLUMN, Y_COLUMN
from streetgrain.sources import csv_splits

# Charsets whose characters may contain the bytes of a line end; they are decoded as one stream.
_WIDE = ("utf-16", "utf-32", "utf-7")
_HEAD_LINES = 1000  # lines that the first records of a file may take
_BATCH = 5000  # records sent on together
_DEAL = 32 << 20  # bytes of a partition that records are dealt out to
_IN_MEMORY = 64 << 20  # bytes of a JSON file up to which it is parsed from memory
_NO_LINE = "\0" * 8  # is in no JSON text of any charset
_FOLDERS = 10_000  # folders of a partitioned table whose files the driver holds at once
_A_TASK = 64  # of them, for a task to read
_AS_FOLDER = re.compile(r"""[\x01-\x1f"#%'*/:=?\[\\\]^{\x7f]""")  # written as hexadecimal numbers by Spark


def _texts(lines: Iterator[bytes], charset: str) -> Iterator[str]:
    """Lines of text with universal line ends, from the bytes between line feeds."""
    decode = codecs.getincrementaldecoder(charset)().decode if charset.startswith(_WIDE) else None
    held = ""
    for line in lines:
        text = decode(line + b"\n") if decode else line.decode(charset) + "\n"
        text = held + text
        held = "\r" if text.endswith("\r") else ""
        text = text.removesuffix("\r") if held else text
        parts = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        held = parts.pop() + held
        yield from (p + "\n" for p in parts)
    if held:
        yield held


def _records(lines: Iterator[bytes], charset: str, delimiter: str) -> Iterator[list[str]]:
    """Records of a CSV file; quoted fields may hold line ends. Blank lines are no records."""
    first = True
    for record in csv.reader(_texts(lines, charset), delimiter=delimiter):
        if first and record:
            record[0] = record[0].lstrip("\ufeff")
        first = False
        if record:
            yield record


def _raw_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"),
    )


def _bytes(size: str) -> int:
    """Bytes of a setting like 128m."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", size.lower()).groups()
    return int(number) << (10 * " kmgt".index(unit or " "))


def _files_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[bytes]]]:
    """Files of a partition, each with its lines; a file's lines follow one another."""
    pairs = ((f, line) for b in batches for f, line in zip(b.column("file").to_pylist(), b.column("line").to_pylist()))
    for file, own in itertools.groupby(pairs, key=lambda x: x[0]):
        yield file, (line or b"" for _, line in own)


def read_source_csv(
    spark: SparkSession,
    path: str,
    delimiter: str = ",",
    encoding: str = "utf-8",
    headers: int | None = None,
    skiplines: int | None = None,
    by_line: bool = False,
) -> DataFrame:
    """CSV source table, every column as text.

    ``headers=-1``: there is no header, columns are COLUMN1, COLUMN2, ...
    ``headers=n``: the header is record n and ``skiplines`` must be n too. The
    records up to the header are skipped by their place in each file. Files that
    are read together must have the same header. Rows with more fields than the
    header are dropped. Short rows stay: their missing fields are null, while an
    empty field is the empty text.

    Records are parsed whole: quoted fields may hold delimiters, quotes and line
    ends, and quotes inside an unquoted field are plain characters. Large files are
    read in pieces; a first pass finds which of them start within a record. Where
    the caller promises with ``by_line`` that no field holds a line end, there is
    no first pass, and a record with an odd number of quotes is an error. In a
    charset whose characters may hold the bytes of a line end, a file is one task.
    """
    if headers is None and skiplines is not None:
        raise ValueError("skiplines needs headers")
    if headers is not None and headers != -1 and skiplines != headers:
        raise ValueError("skiplines must equal headers")
    charset = codecs.lookup(encoding).name
    if by_line and (charset.startswith(_WIDE) or headers not in (None, -1)):
        raise ValueError("by_line needs a charset with plain line ends, and one header line at most")
    skipped = {None: 1, -1: 0}.get(headers, headers)
    # Sizes and names only; the content isn't read.
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    sizes = files.agg(F.min("path").alias("first"), F.max("length").alias("longest"), F.sum("length").alias("total")).first()
    if sizes.first is None:
        raise ValueError(f"no header in {path}")
    raw = _raw_lines(spark, path)
    head = spark.read.option("lineSep", "\n").text(sizes.first).select(F.col("value").cast("binary").alias("line"), F.col("_metadata.file_block_start").alias("block"))
    begun = (bytes(r.line or b"") for r in head.where("block = 0").limit(_HEAD_LINES).collect())
    top = list(itertools.islice(_records(begun, charset, delimiter), max(skipped, 1)))
    if len(top) < max(skipped, 1):
        raise ValueError(f"no header in {path}")
    names = top[-1] if skipped else [f"COLUMN{i + 1}" for i in range(len(top[0]))]
    width = len(names)
    slots = [f"_f{i}" for i in range(width)]

    def columns(found: Iterator[list[str]]) -> Iterator[pa.RecordBatch]:
        while block := list(itertools.islice(found, _BATCH)):
            rows = [r + [None] * (width - len(r)) for r in block if len(r) <= width]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*rows) if rows else [[]] * width)], slots)

    first_file = sizes.first

    def same_header(file: str, found: list[str]) -> None:
        if found != names:
            raise ValueError(f"{file} has another header than {first_file}")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, lines in _files_of(batches):
            found = _records(lines, charset, delimiter)
            above = list(itertools.islice(found, skipped))
            if above:
                same_header(file, above[-1])
            yield from columns(found)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[list[str]]:
            for b in batches:
                for line in b.column("line").to_pylist():
                    text = (line or b"").decode(charset).removesuffix("\r").lstrip("\ufeff")
                    if text.count('"') % 2:
                        raise ValueError(f"a field goes beyond its line: {text[:200]}")
                    for record in csv.reader([text], delimiter=delimiter):
                        if record:
                            yield record

        yield from columns(found())

    schema = ", ".join(f"`{s}` string" for s in slots)
    if by_line:
        if skipped:
            # Without the first line of each file, by its place.
            numbered = raw.withColumn("n", F.monotonically_increasing_id())
            first = numbered.where("block = 0").groupBy("file").agg(F.min("n").alias("n"))
            raw = numbered.join(first, ["file", "n"], "left_anti")
        rows = raw.select("line").mapInArrow(cut, schema)
    else:
        # Spark may read a file beyond the smaller of these in pieces.
        settings = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
        pieces = sizes.longest > min(_bytes(spark.conf.get(k)) for k in settings)
        if charset.startswith(_WIDE):
            if pieces:  # its lines go to one task, in order, and the records are dealt out again for what follows
                raw = raw.withColumn("n", F.monotonically_increasing_id())
                raw = raw.repartition("file").sortWithinPartitions("file", "block", "n").drop("n")
            rows = raw.select("file", "line").mapInArrow(whole, schema)
            if pieces:
                rows = rows.repartition(max(spark.sparkContext.defaultParallelism, -(-sizes.total // _DEAL)))
        else:
            rows = csv_splits.read_pieces(raw, pieces, charset, delimiter, skipped, same_header, columns, schema)
    return rows.select(*[F.col(s).alias(n) for s, n in zip(slots, names)])


# --- JSON and XML features ----------------------------------------------------------


def _json_documents(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """JSON files as one document each.

    Values of other types that become text are copied from the file as they stand there. While
    Spark streams a document it opens the file again for each of these, so a file that fits
    into memory is read as one long line instead; only larger ones are streamed. The name of
    each document's file is ``file``.
    """
    read = lambda name, value: spark.read.schema(schema).options(**options).option(name, value).json(path)
    kept, streamed = read("lineSep", _NO_LINE), read("multiLine", "true")
    size, file = F.col("_metadata.file_size"), F.col("_metadata.file_path").alias("file")
    return kept.where(size <= _IN_MEMORY).select("*", file).unionByName(streamed.where(size > _IN_MEMORY).select("*", file))


def _to_points(values: Column) -> Column:
    """Arrays of two or more numbers as points."""
    return F.transform(values, lambda c: geo.point(c[0], c[1]))


def geojson_centroid(geometry: Column) -> Column:
    """Centroid of the JSON text of a simple geometry, by its type; null for none."""
    kind = F.get_json_object(geometry, "$.type")
    coordinates = F.get_json_object(geometry, "$.coordinates")
    one = F.from_json(coordinates, "array<double>")
    many = F.from_json(coordinates, "array<array<double>>")
    paths = F.from_json(coordinates, "array<array<array<double>>>")
    shapes = F.from_json(coordinates, "array<array<array<array<double>>>>")
    rings = F.transform(paths, _to_points)
    # Parts of a multi-polygon: outer rings count, holes are subtracted.
    parts = F.transform(shapes, lambda s: F.transform(s, _to_points))
    weighed = F.transform(
        parts, lambda p: F.struct(geo.polygon_area(p).alias("a"), geo.polygon_centroid(p).alias("c"))
    )
    total = F.aggregate(weighed, F.lit(0.0).cast("double"), lambda t, w: t + w["a"])
    mean = lambda axis: F.aggregate(
        weighed, F.lit(0.0).cast("double"), lambda t, w: t + w["a"] * w["c"][axis]
    )
    return (
        F.when(kind == "Point", geo.point(one[0], one[1]))
        .when(kind == "MultiPoint", geo.points_centroid(_to_points(many)))
        .when(kind == "LineString", geo.path_centroid(F.array(_to_points(many))))
        .when(kind == "MultiLineString", geo.path_centroid(rings))
        .when(kind == "Polygon", geo.polygon_centroid(rings))
        .when(kind == "MultiPolygon", geo.point(F.try_divide(mean("x"), total), F.try_divide(mean("y"), total)))
    )


def _length(paths: Column) -> Column:
    edges = F.flatten(F.transform(paths, geo.edges_of))
    return F.aggregate(
        edges, F.lit(0.0).cast("double"), lambda t, e: t + F.hypot(e["q"]["x"] - e["p"]["x"], e["q"]["y"] - e["p"]["y"])
    )


def _measure(geometry: Column) -> Column:
    """struct(dimension, size) of a simple geometry: area, length or number of points."""
    kind = F.get_json_object(geometry, "$.type")
    coordinates = F.get_json_object(geometry, "$.coordinates")
    many = F.from_json(coordinates, "array<array<double>>")
    paths = F.transform(F.from_json(coordinates, "array<array<array<double>>>"), _to_points)
    shapes = F.transform(F.from_json(coordinates, "array<array<array<array<double>>>>"), lambda s: F.transform(s, _to_points))
    areas = F.aggregate(F.transform(shapes, geo.polygon_area), F.lit(0.0).cast("double"), lambda t, a: t + a)
    of = lambda n, size: F.struct(F.lit(n).alias("d"), size.cast("double").alias("size"))
    return (
        F.when(kind == "MultiPolygon", of(2, areas)).when(kind == "Polygon", of(2, geo.polygon_area(paths)))
        .when(kind == "MultiLineString", of(1, _length(paths)))
        .when(kind == "LineString", of(1, _length(F.array(_to_points(many)))))
        .when(kind == "MultiPoint", of(0, F.size(many))).when(kind == "Point", of(0, F.lit(1)))
    )


def collection_centroid(geometry: Column) -> Column:
    """Centroid of the JSON text of a geometry collection; null for none.

    The members of the highest dimension count, by area, length or number;
    members that are collections themselves are left out.
    """
    members = F.from_json(F.get_json_object(geometry, "$.geometries"), "array<string>")
    parts = F.transform(members, lambda g: F.struct(_measure(g).alias("m"), geojson_centroid(g).alias("c")))
    sized = F.filter(parts, lambda p: p["c"]["x"].isNotNull() & (p["m"]["size"] > 0))
    highest = F.transform(F.array(sized), lambda s: F.struct(s.alias("s"), F.array_max(F.transform(s, lambda p: p["m"]["d"])).alias("d")))
    best = F.flatten(F.transform(highest, lambda h: F.filter(h["s"], lambda p: p["m"]["d"] == h["d"])))

    def mean(parts: Column, axis: str) -> Column:
        given = F.filter(parts, lambda p: p["c"][axis].isNotNull())
        total = F.aggregate(given, F.lit(0.0).cast("double"), lambda t, p: t + p["c"][axis] * p["m"]["size"])
        return F.when(F.size(given) > 0, F.try_divide(total, _sizes(parts)))

    return F.transform(F.array(best), lambda b: geo.point(mean(b, "x"), mean(b, "y")))[0]


def _sizes(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0.0).cast("double"), lambda t, p: t + p["m"]["size"])


def _first_file(spark: SparkSession, path: str) -> str | None:
    """The first file by name; only names are read."""
    return spark.read.format("binaryFile").load(path).agg(F.min("_metadata.file_path").alias("f")).first().f


def read_geojson(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Features of GeoJSON files: text properties and the centroid.

    The properties of the first feature decide the columns. Features without a
    geometry are skipped. ``lines`` reads one feature per line, which splits
    over tasks; a whole feature collection is one task per file, so convert
    large ones once with :func:`write_geojson_lines`. The files are parsed once:
    for the columns only the first by name is read, unless it has no features.
    """
    feature = "struct<properties:map<string,string>,geometry:string>"
    if lines:
        whole = spark.read.schema("properties map<string,string>, geometry string").json(path)
        features, whole = whole, whole.select("properties", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    else:
        whole = _json_documents(spark, path, f"features array<{feature}>")
        features = whole.select(F.explode("features").alias("f")).select("f.*")
        head = F.try_element_at("features", F.lit(1))["properties"].alias("properties")
        whole = whole.select(head, "file", F.lit(0).alias("block")).where("properties IS NOT NULL")
    # The first feature of the first file by name, whichever task reads it.
    file = _first_file(spark, path)
    for some in (whole.where(F.col("file") == file), whole) if file is not None else ():
        numbered = some.withColumn("n", F.monotonically_increasing_id())
        first = numbered.agg(F.min_by("properties", F.struct("file", "block", "n")).alias("properties"), F.count("*").alias("n")).first()
        if first.n:
            break
    names = list((first.properties or {}).keys()) if file is not None else []
    kind = F.coalesce(F.get_json_object("geometry", "$.type") == "GeometryCollection", F.lit(False))
    center = F.when(kind, collection_centroid(F.col("geometry"))).otherwise(geojson_centroid(F.col("geometry")))
    # As a generator, so that the centroid isn't worked out once for the rows to keep and again for their columns.
    placed = features.select("properties", F.explode(F.filter(F.array(center), lambda c: c["x"].isNotNull())).alias("_c"))
    return placed.select(
        *[F.try_element_at("properties", F.lit(n)).alias(n) for n in names],
        F.col("_c.x").cast("string").alias(X_COLUMN),
        F.col("_c.y").cast("string").alias(Y_COLUMN),
    )


def read_esri_features(spark: SparkSession, path: str, fields: list[str] | None = None) -> DataFrame:
    """Saved pages of a feature service: requested fields, centroid and text.

    Features without geometry, with a NaN coordinate or with an empty shape
    are skipped. Centroids are rounded to seven places.
    """
    geometry = (
        "struct<x:double,y:double,points:array<array<double>>,"
        "paths:array<array<array<double>>>,rings:array<array<array<double>>>>"
    )
    schema = (
        "fields array<struct<name:string>>, "
        f"features array<struct<attributes:map<string,string>,geometry:{geometry}>>"
    )
    pages = _json_documents(spark, path, schema, allowNonNumericNumbers="true")
    if fields is None:
        head = pages.select("fields").limit(1).collect()
        fields = [f.name for f in (head[0].fields or [])] if head else []
    rows = pages.select(F.explode("features").alias("f")).select("f.*")
    g = F.col("geometry")
    points, paths, rings = g["points"], g["paths"], g["rings"]
    center = F.coalesce(
        F.when(g["x"].isNotNull(), geo.point(g["x"], g["y"])),
        F.when(F.size(rings) > 0, geo.polygon_centroid(F.transform(rings, _to_points), by_orientation=True)),
        F.when(F.size(paths) > 0, geo.path_centroid(F.transform(paths, _to_points))),
        F.when(F.size(points) > 0, geo.points_centroid(_to_points(points))),
    )
    bad = lambda lists: F.coalesce(
        F.exists(F.flatten(F.flatten(lists)), lambda v: F.isnan(v)), F.lit(False)
    )
    nan = (
        F.coalesce(F.isnan(g["x"]) | F.isnan(g["y"]), F.lit(False))
        | bad(rings) | bad(paths) | bad(F.array(points))
    )
    pair = lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))
    listed = lambda ps: F.concat(F.lit("("), F.array_join(F.transform(ps, pair), ", "), F.lit(")"))
    text = F.coalesce(
        F.when(g["x"].isNotNull(), F.concat(F.lit("POINT ("), pair(g), F.lit(")"))),
        F.when(F.size(rings) > 0, geo.rings_to_text(F.transform(rings, _to_points))),
        F.when(F.size(paths) == 1, F.concat(F.lit("LINESTRING "), listed(_to_points(paths[0])))),
        F.when(
            F.size(paths) > 1,
            F.concat(
                F.lit("MULTILINESTRING ("),
                F.array_join(F.transform(paths, lambda p: listed(_to_points(p))), ", "), F.lit(")"),
            ),
        ),
        F.when(F.size(points) > 0, F.concat(F.lit("MULTIPOINT "), listed(_to_points(points)))),
    )
    kept = rows.filter(~nan).withColumn("_c", center).withColumn("_wkt", text)
    return kept.filter(F.col("_c.x").isNotNull()).select(
        *[F.try_element_at("attributes", F.lit(n)).alias(n) for n in fields if n not in (X_COLUMN, Y_COLUMN, GEOM_COLUMN)],
        F.round("_c.x", 7).cast("string").alias(X_COLUMN),
        F.round("_c.y", 7).cast("string").alias(Y_COLUMN),
        F.col("_wkt").alias(GEOM_COLUMN),
    )


def read_xml_features(
    spark: SparkSession, path: str, row_tag: str, fields: list[str], coordinates: str
) -> DataFrame:
    """Point features of XML files.

    ``coordinates`` is the dotted path below ``row_tag`` of a text ``x,y``.
    Namespace prefixes are ignored.
    """
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    names = coordinates.split(".")
    nested: T.DataType = T.StringType()
    for name in reversed(names):
        nested = T.StructType([T.StructField(name, nested)])
    schema = T.StructType([*schema.fields, *nested.fields])
    rows = (
        spark.read.format("xml").option("rowTag", row_tag.split(":")[-1]).option("ignoreNamespace", "true")
        .schema(schema).load(path)
    )
    xy = F.split(F.trim(F.col(coordinates)), r"\s*,\s*")
    return rows.select(
        *fields,
        F.try_element_at(xy, F.lit(1)).alias(X_COLUMN),
        F.try_element_at(xy, F.lit(2)).alias(Y_COLUMN),
    )


# --- archives ----------------------------------------------------------------------


def read_zipped_csv(
    spark: SparkSession, path: str, columns: list[str], first_member_only: bool = False, batch_rows: int = 20_000
) -> DataFrame:
    """Rows of the CSV members of zip archives, with archive and member name.

    README members are not CSV members. Archives are read in parallel; one
    archive is decompressed as a stream and leaves in batches, so its rows are
    never held together.
    """
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in ["archive", "member", *columns]]
    )

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path_, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    members = [n for n in archive.namelist() if n.lower().endswith(".csv") and n != "README.txt"]
                    for member in members[:1] if first_member_only else members:
                        with archive.open(member) as file:
                            frames = pd.read_csv(
                                io.TextIOWrapper(file, "utf8"), dtype=str, keep_default_na=False,
                                chunksize=batch_rows,
                            )
                            for frame in frames:
                                out = frame.reindex(columns=columns).astype(object)
                                out.insert(0, "archive", path_)
                                out.insert(1, "member", member)
                                yield out.where(out.notna(), None)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(rows, schema)


def fingerprint_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """MD5 of the content of every file: ``path, length, fingerprint``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    return files.select("path", "length", F.md5("content").alias("fingerprint"))


def read_source_definitions(spark: SparkSession, directory: str) -> DataFrame:
    """All JSON files below a directory: relative ``path`` and ``definition``."""
    files = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.[jJ][sS][oO][nN]").text(directory, wholetext=True)
    )
    root = directory.rstrip("/")
    full = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/")
    return files.select(
        F.regexp_replace(full, f"^.*?{_quoted(root)}/", "").alias("path"), F.col("value").alias("definition")
    )


def _quoted(text: str) -> str:
    return r"\Q" + text.split("://")[-1] + r"\E"


def read_state_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Published run table; only runs that were cached and processed."""
    rows = spark.read.option("header", "true").option("sep", "\t").option("quote", '"').option("escape", '"').csv(path)
    return rows.filter(F.col("cache").isNotNull() & F.col("processed").isNotNull())


def folder_names(values: DataFrame) -> Iterator[list[str]]:
    """Names ``key=value`` of the folders that a write partitioned by the only column of ``values`` makes, some thousand at a time."""
    key, = values.columns
    # Null and empty text share a folder.
    found = values.select(F.nullif(F.col(key), F.lit("")).alias(key)).distinct().toLocalIterator()
    while rows := list(itertools.islice(found, _FOLDERS)):
        yield [f"{key}=__HIVE_DEFAULT_PARTITION__" if v is None else f"{key}={_AS_FOLDER.sub(lambda c: f'%{ord(c[0]):02X}', v)}" for v, in rows]


def read_folders(spark: SparkSession, path: str, folders: list[str], form: str, schema: str, **options: str) -> DataFrame:
    """Rows of some folders of a partitioned table; no others are listed.

    Spark's driver holds a record of each file and each task of a read, so a
    table with a folder per source is read by ``folder_names``.
    """
    reader = spark.read.format(form).schema(schema).options(basePath=path, **options)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, len(folders) // _A_TASK)
    return reader.load([f"{path}/{f}" for f in folders]).coalesce(tasks)


def excerpt(df: DataFrame, order: list, rows: int = 5, geometry: str | None = None) -> DataFrame:
    """First rows of a source in a given order, with its geometry type.

    An empty source is an error when the excerpt is read.
    """
    head = df.orderBy(*order).limit(rows)
    kind = geo.geometry_type(F.col(f"`{geometry}`")) if geometry else F.lit(None).cast("string")
    # One row, and with it the error, if there are no rows at all.
    none = df.limit(1).agg(F.count("*").alias("_n")).where("_n < 1")
    guard = none.select(F.raise_error(F.lit("not enough rows in data source")).cast("string").alias("geometry_type"))
    return head.withColumn("geometry_type", kind).unionByName(guard, allowMissingColumns=True)
