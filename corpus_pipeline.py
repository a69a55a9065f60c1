"""The corpus pipeline: quality rules, near-duplicates, decontamination, secrets, mixing.

Each stage works on all rows that its predecessor kept. All but the last return
the columns of ``documents`` under their names and in their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streetgrain.llm import decontaminate, minhash, mixing, quality_rules, queries, secrets
from streetgrain.llm import spans as sp
from streetgrain.llm.names import free_name
from streetgrain.session import written

SECRET = "[SECRET]"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their group's limits; the others go."""
    counts, kept = free_name(docs, "quality_counts"), free_name(docs, "quality_kept")
    measured = written(quality_rules.measure(docs, "text", counts), "measured")
    judged = quality_rules.judge(measured, counts, "lang", "source", kept)
    return judged.where(kept).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that of the smallest id. Of rows with one id, the first by text stays.

    Rows of null id belong to no group and stay.
    """
    found = written(minhash.near_duplicates(docs, "doc_id", "text"), "groups").where("id IS NOT NULL")
    follows = found.where("id <> component").select("id")
    twice = found.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    gone = minhash.small_side(follows.unionByName(twice).distinct())
    rest = docs.join(gone, docs["doc_id"] == gone["id"], "left_anti")
    # Rows that share an id: one of them, where the id leads its group.
    leads = twice.join(follows, "id", "left_anti")
    shared = docs.join(leads, docs["doc_id"] == leads["id"], "left_semi")
    place = free_name(docs, "place")
    first = Window.partitionBy("doc_id").orderBy("text", *[c for c in ("lang", "source", "n_chars") if c in docs.columns])
    one = shared.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).drop(place)
    return rest.unionByName(one)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover less than a twentieth."""
    hits, items, words = (free_name(docs, x) for x in ("benchmark_hits", "benchmark_items", "benchmark_words"))
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contamination(docs, "text", bench, "item_id", "text", hits=hits, found=items, words=words)
    hit = queries.span_words(hits)
    return found.where(~((hit > 0) & (20 * hit >= F.col(words)))).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; stretches that hold secrets are replaced by a mark, and n_chars follows."""
    name = free_name(docs, "secret_spans")
    found = secrets.find_secrets(docs, "text", name).withColumn("text", sp.masked(F.col("text"), F.col(name), SECRET))
    if "n_chars" in docs.columns:
        changed = F.when(F.size(name) > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        found = found.withColumn("n_chars", changed.otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes from each document."""
    out = mixing.mixed(docs, "doc_id", "text", "source")
    return out.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken")


STAGES = [
    ("quality_rules", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("secret_scan", secret_scan), ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def _mask(text: str) -> str:
    for rule in secrets.RULES:
        pattern = rule.pattern.replace("\\\"", '"').replace("\\'", "'").replace("(?<![0-9a-f])", "").replace("(?![A-Za-z0-9_-])", "")
        if rule.kind == "assign":
            pattern = pattern.replace("_.=-]+)", "_.=-]{12,})")
        if rule.kind == "access":
            pattern = pattern.replace("]+", "]{14,}")
        text = f"regexp_replace({text}, '{pattern.replace(chr(39), chr(39) * 2)}', '{SECRET}', 'g')"
    return text


# SQL knows no spans, so its masks go rule by rule; that is the same where no two secrets overlap in part.
ORACLE_SQL = f"""
WITH s1 AS (SELECT doc_id, text, source FROM documents WHERE doc_id IN (
  WITH {queries.QUALITY.replace("DOCS", "documents")} SELECT doc_id FROM verdict WHERE kept)),
s2 AS (SELECT * FROM s1 WHERE doc_id IN (
  WITH RECURSIVE {queries.SHINGLES.replace("DOCS", "s1").replace("WIDTH", "5")} SELECT id FROM c WHERE id = component_id)),
s3 AS (SELECT * FROM s2 WHERE doc_id NOT IN (
  WITH {queries.CONTAMINATION.replace("DOCS", "s2")} SELECT d.doc_id FROM d JOIN h ON d.doc_id = h.doc_id WHERE 20 * h.n >= len(ws))),
s4 AS (SELECT doc_id, source, {_mask("text")} AS text FROM s3),
{queries.MIX.replace("DOCS", "s4")}
SELECT doc_id, source, size, source_size, target, taken FROM mixed
"""
