"""Members of zip archives: their names, and single ones as files that Spark reads in pieces."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetgrain.session import scratch_path

_CHUNK = 4 << 20


def _files(spark: SparkSession, path: str) -> DataFrame:
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.select("path", "content")


def members(spark: SparkSession, path: str) -> DataFrame:
    """``archive, path, position`` of the files in zip archives; folders are no files."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as file:
                    found = [n for n in file.namelist() if not n.endswith("/")]
                yield pa.RecordBatch.from_pydict({
                    "archive": pa.array([archive] * len(found), pa.string()), "path": pa.array(found, pa.string()), "position": pa.array(range(len(found)), pa.int32()),
                })

    return _files(spark, path).mapInArrow(names, "archive string, path string, position int")


def unpacked(spark: SparkSession, archive: str, member: str) -> str:
    """Folder in the shared folder with the lines of one member, in one file.

    One task unpacks it as a stream. Line ends stay as they are, but the last line gets one.
    """

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as file, file.open(member) as data:
                    held = b""
                    while chunk := data.read(_CHUNK):
                        *whole, held = (held + chunk).split(b"\n")
                        yield pa.RecordBatch.from_pydict({"value": pa.array(whole, pa.binary())})
                    if held:
                        yield pa.RecordBatch.from_pydict({"value": pa.array([held], pa.binary())})

    out = f"{scratch_path(spark, 'member')}/{member.rsplit('/', 1)[-1]}"
    rows = _files(spark, archive).mapInArrow(lines, "value binary")
    rows.select(F.col("value").cast("string").alias("value")).write.text(out)
    return out
