"""Whole CSV records from files that Spark reads in pieces.

A line boundary is in one of two states: a record ends there, or a quoted field
goes on. A piece of a file maps the state at its start to that at its end, and
such maps compose, so a running composition over the pieces tells each one where
its first record begins. Records that cross pieces are put together from fragments.
"""

from __future__ import annotations

import csv
import io
import itertools
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

END = "end"  # a line after the last one: alone if no field was open
MOST_OPEN = 100_000  # pieces that start within a record; their names are on the driver
csv.field_size_limit(2**31 - 1)

Batches = Iterator[pa.RecordBatch]


def text_of(lines: list[bytes], charset: str) -> str:
    """Lines as text with universal line ends."""
    text = (b"\n".join(lines) + b"\n").decode(charset) if lines else ""
    return text.replace("\r\n", "\n").replace("\r", "\n") if "\r" in text else text


def stays_open(text: str, open_: bool, delimiter: str) -> bool:
    """Whether a quoted field is open after some lines, given whether one is before."""
    if '"' not in text:
        return open_
    lines = itertools.chain(io.StringIO(('"' if open_ else "") + text), (END,))
    return deque(csv.reader(lines, delimiter=delimiter), maxlen=1)[0] != [END]


def records(text: str, delimiter: str) -> tuple[list[list[str]], int]:
    """Whole records from the start of one on, blank ones included, and the lines that they take."""
    if '"' not in text:
        rows = list(csv.reader(io.StringIO(text), delimiter=delimiter))
        return rows, len(rows)
    reader = csv.reader(itertools.chain(io.StringIO(text), (END,)), delimiter=delimiter)
    rows, ends = [], [0]
    for row in reader:
        rows.append(row)
        ends.append(reader.line_num)
    return rows[:-1], ends[-2]


def _pieces(batches: Batches) -> Iterator[tuple[tuple[str, int], Iterator[list[bytes]]]]:
    """Pieces of a partition: (file, start) and their lines, some at a time."""

    def parts():
        for batch in batches:
            file, block, line = (batch.column(c) for c in ("file", "block", "line"))
            new = [pc.not_equal(c.slice(1), c.slice(0, max(len(c) - 1, 0))).to_numpy(zero_copy_only=False) for c in (file, block)]
            edges = [0, *(np.flatnonzero(new[0] | new[1]) + 1).tolist(), batch.num_rows]
            for at, to in itertools.pairwise(edges if batch.num_rows else []):
                yield (file[at].as_py(), block[at].as_py()), [x or b"" for x in line.slice(at, to - at).to_pylist()]

    for key, own in itertools.groupby(parts(), key=lambda x: x[0]):
        yield key, (lines for _, lines in own)


def open_pieces(raw: DataFrame, charset: str, delimiter: str) -> DataFrame:
    """(file, block) of the pieces that start within a record."""

    def run(batches: Batches) -> Batches:
        found = []
        for (file, block), parts in _pieces(batches):
            closed, opened = False, True  # the state now, if it was closed or open at the start
            for lines in parts:
                text = text_of(lines, charset)
                same = closed == opened
                closed = stays_open(text, closed, delimiter)
                opened = closed if same else stays_open(text, opened, delimiter)
            found.append({"file": file, "block": block, "closed": closed, "opened": opened})
        if found:
            yield pa.RecordBatch.from_pylist(found)

    effects = raw.mapInArrow(run, "file string, block long, closed boolean, opened boolean")
    # An effect is constant, or keeps or swaps the state: the last constant one and the swaps since tell the state.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = before.rowsBetween(Window.unboundedPreceding, 0)
    constant = F.col("closed") == F.col("opened")
    swaps = effects.withColumn("swaps", F.sum((~constant & F.col("closed")).cast("long")).over(upto))
    fixed = F.when(constant, F.struct(F.col("closed").cast("long").alias("state"), F.col("swaps")))
    state = swaps.select(
        "file", "block", F.coalesce(F.max("swaps").over(before), F.lit(0)).alias("n"), F.last(fixed, ignorenulls=True).over(before).alias("f")
    )
    start = (F.coalesce("f.state", F.lit(0)) + F.col("n") - F.coalesce("f.swaps", F.lit(0))) % 2
    return state.where(start == 1).select("file", "block")


def _read(lines: Iterator[list[bytes]], open_: bool, charset: str, delimiter: str) -> Iterator[tuple[str, object]]:
    """("head", text), ("rows", records) and ("tail", text) of a piece."""
    held, head = [], []
    for some in lines:
        if open_:
            # Up to the line that ends the record from before.
            head += some
            text = text_of(head, charset)
            if stays_open(text, True, delimiter) and not records('"' + text, delimiter)[0]:
                continue
            reader = csv.reader(io.StringIO('"' + text), delimiter=delimiter)
            next(reader)
            parts = text.split("\n")
            yield "head", "\n".join(parts[: reader.line_num]) + "\n"
            open_, held = False, ["\n".join(parts[reader.line_num :])]
        else:
            held.append(text_of(some, charset))
        text = "".join(held)
        rows, used = records(text, delimiter)
        if rows:
            yield "rows", rows
            if text.count("\n") == used:
                held = []
            else:
                at = -1
                for _ in range(used):
                    at = text.index("\n", at + 1)
                held = [text[at + 1 :]]
    if open_ and head:
        yield "head", text_of(head, charset)
    elif "".join(held):
        yield "tail", "".join(held)


def read_pieces(
    raw: DataFrame, cut: bool, charset: str, delimiter: str, skipped: int, check: Callable[[str, list[str]], None], columns: Callable, schema: str,
) -> DataFrame:
    """Records of all files but the first ``skipped`` of each.

    ``raw``: file, block and line as Spark cuts them; ``cut`` tells whether a file may be
    in pieces. ``check`` sees the last skipped record of each file; ``columns`` makes
    Arrow batches of records. The skipped records lie in the first piece of a file.
    """
    opened = {(r.file, r.block) for r in open_pieces(raw, charset, delimiter).limit(MOST_OPEN + 1).collect()} if cut else set()
    if len(opened) > MOST_OPEN:
        raise ValueError("too many records cross the pieces that files are read in")

    def top(found: Iterator, file: str, block: int) -> Iterator[list[list[str]]]:
        missing = skipped if block == 0 else 0
        above, first = [], block == 0
        for kind, rows in found:
            if kind != "rows":
                if kind == "tail" and not opened_after(file, block):
                    rows = list(csv.reader(io.StringIO(rows), delimiter=delimiter))  # never closed: the file ends
                else:
                    continue
            if first and rows and rows[0]:
                rows[0][0] = rows[0][0].lstrip("\ufeff")
            first = False
            rows = [r for r in rows if r]
            if missing:
                above += rows[:missing]
                rows, missing = rows[missing:], missing - len(rows[:missing])
                if not missing:
                    check(file, above[-1])
            yield rows
        if missing and above:
            raise ValueError(f"the first piece of {file} holds fewer than {skipped} records")

    last = {}
    for file, block in opened:
        last.setdefault(file, []).append(block)

    def opened_after(file: str, block: int) -> bool:
        return any(b > block for b in last.get(file, ()))

    def run(batches: Batches) -> Batches:
        for (file, block), lines in _pieces(batches):
            for rows in top(_read(lines, (file, block) in opened, charset, delimiter), file, block):
                yield from columns(iter(rows))

    whole = raw.mapInArrow(run, schema)
    if not opened:
        return whole

    def fragments(batches: Batches) -> Batches:
        for (file, block), lines in _pieces(batches):
            for kind, text in _read(lines, (file, block) in opened, charset, delimiter):
                if kind != "rows":
                    yield pa.RecordBatch.from_pylist([{"file": file, "block": block, "kind": kind, "text": text}])

    def joined(batches: Batches) -> Batches:
        for batch in batches:
            rows = (r for text in batch.column("text").to_pylist() for r in csv.reader(io.StringIO(text), delimiter=delimiter) if r)
            yield from columns(rows)

    order = Window.partitionBy("file").orderBy("block", "kind")
    parts = raw.mapInArrow(fragments, "file string, block long, kind string, text string")
    # A tail begins a record, and the heads of the pieces after it go on with it. The last tail may end with its file.
    parts = parts.withColumn("of", F.sum((F.col("kind") == "tail").cast("int")).over(order))
    texts = F.transform(F.sort_array(F.collect_list(F.struct("block", "kind", "text"))), lambda x: x["text"])
    crossing = parts.groupBy("file", "of").agg(F.array_join(texts, "").alias("text"), F.count("*").alias("n")).where("n > 1")
    return whole.unionByName(crossing.select("text").mapInArrow(joined, schema))
