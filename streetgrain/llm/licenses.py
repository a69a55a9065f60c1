"""Licence scan: TF-IDF cosine of lines to licence notices, then inheritance from the nearest ancestor directory."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import words as w

PIECE = 4 << 20
LEAST = 0.7  # cosine from which a line, or two lines in a row, count as a notice
HEADER = 20  # lines that are a file's header
FILE_NAME = "(?i)^(licen[cs]e|copying|unlicense|notice)([.-].*)?$"

# Short notices by SPDX name; a licence may have several.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is free software under the terms of the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated this work to the public domain, CC0 1.0."),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"),
)


class _Terms:
    """Vocabulary of the templates, and their weight vectors once document frequencies are known."""

    def __init__(self, templates) -> None:
        data, offsets = w.text_bytes(pa.array([t for _, t in templates]))
        split = w.split(w.LOWER[data], offsets, w.LETTERS)
        key = w.hashes(split)
        self.names = [n for n, _ in templates]
        self.vocabulary = np.unique(key)
        self.counts = np.zeros((len(self.vocabulary), len(templates)))
        np.add.at(self.counts, (np.searchsorted(self.vocabulary, key), split.row), 1)

    def number(self, key: np.ndarray) -> np.ndarray:
        """Place in the vocabulary, or -1."""
        at = np.minimum(np.searchsorted(self.vocabulary, key), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == key, at, -1)

    def weigh(self, documents: int, frequency: np.ndarray) -> None:
        self.idf = np.log((1 + documents) / (1 + frequency)) + 1
        self.rare = np.log((1 + documents) / 2) + 1  # of a word that no template has
        matrix = self.counts * self.idf[:, None]
        self.matrix = matrix / np.linalg.norm(matrix, axis=0)


def _text(part, text_col):
    data, offsets = w.text_bytes(part.column(text_col))
    return data, offsets, w.split(w.LOWER[data], offsets, w.LETTERS)


def document_frequency(docs: DataFrame, text_col: str, terms: _Terms) -> tuple[int, np.ndarray]:
    """Number of documents, and of those that hold each template word; one row per task is summed."""

    def run(parts):
        total, found = 0, np.zeros(len(terms.vocabulary), np.int64)
        for whole in parts:
            for part in w.pieces(whole, "text", PIECE):
                _, _, split = _text(part, "text")
                number = terms.number(w.hashes(split))
                pairs = np.unique((split.row * len(found) + number)[number >= 0])
                found += np.bincount(pairs % len(found), minlength=len(found))
                total += part.num_rows
        term = np.arange(-1, len(found))
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(np.concatenate([[total], found]))], ["term", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "term long, n long")
    rows = {r.term: r.n for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return rows.get(-1, 0), np.array([rows.get(i, 0) for i in range(len(terms.vocabulary))])


def _cosines(unit: np.ndarray, number: np.ndarray, terms: _Terms) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, best template, cosine) of the units that reach LEAST; words are in order of unit."""
    if not len(unit):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    first = np.ones(len(unit), bool)
    first[1:] = unit[1:] != unit[:-1]
    index = np.cumsum(first) - 1
    known = number >= 0
    # Words beyond the vocabulary count as different rare words.
    other = np.bincount(index[~known], minlength=index[-1] + 1) * terms.rare**2
    width = len(terms.vocabulary)
    pair, count = np.unique(index[known] * width + number[known], return_counts=True)
    at, term = pair // width, pair % width
    weight = count * terms.idf[term]
    own = np.bincount(at, weight**2, minlength=index[-1] + 1)
    # No template shares more of a unit than the words that some template has.
    hope = np.flatnonzero(own >= LEAST**2 * (own + other))
    hope = hope[own[hope] > 0]
    pick = np.isin(at, hope)
    place = np.searchsorted(hope, at[pick])
    dot = np.zeros((len(hope), terms.matrix.shape[1]))
    np.add.at(dot, place, weight[pick, None] * terms.matrix[term[pick]])
    cosine = dot / np.sqrt(own + other)[hope, None]
    best = cosine.argmax(axis=1)
    score = cosine[np.arange(len(hope)), best]
    good = score >= LEAST
    return unit[first][hope[good]], best[good], score[good]


def _notices(text_col: str, column: str, terms: _Terms):
    def run(parts):
        for whole in parts:
            for part in w.pieces(whole, text_col, PIECE):
                data, offsets, split = _text(part, text_col)
                number = terms.number(w.hashes(split))
                ends = np.flatnonzero(data == 10)
                row = split.row
                # Lines are numbered through the batch; a new text is a new line too.
                line = np.searchsorted(ends, split.starts) + row
                top = np.searchsorted(ends, offsets[:-1]) + np.arange(part.num_rows)
                found = [_cosines(line, number, terms)]
                # Two lines in a row: each word also counts for the pair that begins a line earlier.
                early = line - 1 >= top[row]
                pair = np.concatenate([line, line[early] - 1])
                order = np.argsort(pair, kind="stable")
                found.append(_cosines(pair[order], np.concatenate([number, number[early]])[order], terms))
                at, best, score = (np.concatenate(x) for x in zip(*found, strict=True))
                of = np.searchsorted(top, at, "right") - 1
                out: list[dict | None] = [None] * part.num_rows
                for i in np.lexsort((at, best, -score)):
                    r = int(of[i])
                    new = {"license": terms.names[best[i]], "score": float(score[i]), "line": int(at[i] - top[r])}
                    out[r] = out[r] or new
                kind = pa.struct([("license", pa.string()), ("score", pa.float64()), ("line", pa.int32())])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, kind)], [*part.schema.names, column])

    return run


def find_notices(docs: DataFrame, text_col: str, column: str = "notice", templates=TEMPLATES) -> DataFrame:
    """All columns of ``docs`` and the best notice of each text: license, score, line (from 0); null if none.

    Every line of the whole text, and every two lines in a row, is compared with
    every template; word weights come from document frequencies over all of
    ``docs``. Ties go to the earlier template, then the earlier line. Null text
    has no notice.
    """
    if column.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"column exists already: {column}")
    terms = _Terms(templates)
    terms.weigh(*document_frequency(docs, text_col, terms))
    schema = docs.withColumn(column, F.lit(None).cast("struct<license:string,score:double,line:int>")).schema
    return docs.mapInArrow(_notices(text_col, column, terms), schema)


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherit(files: DataFrame, path_col: str, license_col: str, score_col: str) -> DataFrame:
    """directory, license and from: what a directory has from its nearest ancestor, or itself, with a licence file.

    A licence file has a name like LICENSE or COPYING and a licence. Of several
    in a directory the highest score counts, then the first name. The empty
    directory is the root of all paths. Only directories meet, not files.
    """
    path = F.col(path_col)
    name = F.regexp_extract(path, "[^/]*$", 0)
    held = files.where(name.rlike(FILE_NAME) & F.col(license_col).isNotNull()).select(
        _directory(path).alias("from"), F.struct(-F.col(score_col), F.col(license_col).alias("license")).alias("best")
    )
    held = held.groupBy("from").agg(F.min("best").getField("license").alias("license"))
    own = files.where(path.isNotNull()).select(_directory(path).alias("directory")).distinct()
    steps = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))
    lines = own.select("directory", F.explode(F.array_distinct(above)).alias("from"))
    found = lines.join(held, "from")
    return found.groupBy("directory").agg(
        F.max_by("license", F.length("from")).alias("license"), F.max_by("from", F.length("from")).alias("from")
    )


def scan(files: DataFrame, id_col: str, path_col: str, text_col: str) -> DataFrame:
    """Per row: id, path, notice, in_header, license and from.

    ``license`` is the text's own, else that of the nearest ancestor directory
    with a licence file, named in ``from``. A null path inherits nothing; rows of
    equal path are files of their own.
    """
    rows = files.select(F.col(id_col).alias("id"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    found = find_notices(rows, "text").drop("text")
    # Written once: the directories and the files both read it.
    found = written(found.withColumn("in_header", F.col("notice.line") < HEADER), "notices")
    flat = found.select("path", F.col("notice.license").alias("l"), F.col("notice.score").alias("s"))
    table = inherit(flat, "path", "l", "s").select(
        F.col("directory").alias("d"), F.col("license").alias("inherited"), F.col("from").alias("holder")
    )
    joined = found.join(table, _directory(F.col("path")) == F.col("d"), "left")
    own = F.col("notice.license")
    return joined.select(
        "id", "path", "notice", "in_header", F.coalesce(own, "inherited").alias("license"),
        F.when(own.isNull(), F.col("holder")).alias("from"),
    )
