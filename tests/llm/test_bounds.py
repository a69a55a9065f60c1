"""Corpus operators with bounds so small that several shards, batches, blocks and large families occur."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_corpus import kneser_ney, prose

from streetgrain.llm import batches, lm_score, minhash, ngram_lm, quality_lm, quality_rules, queries, secrets
from streetgrain.llm import words as w

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("many", [128, 1000])
def test_many_rules_keep_their_trigrams(spark, many):
    names = [f"{chr(97 + i // 676)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}" for i in range(many)]
    rules = tuple(secrets.Rule(f"r{i}", f"{n}#[0-9]+") for i, n in enumerate(names))
    docs = spark.createDataFrame([(i, f"text {n}#{i} end") for i, n in enumerate(names)], "i long, t string")
    found = {r.i: r.secrets for r in secrets.find_secrets(docs, "t", rules=rules).collect()}
    assert all(len(found[i]) == 1 and found[i][0].kind == f"r{i}" for i in range(many))


def test_models_over_several_shards_and_batches(spark, monkeypatch):
    docs = spark.createDataFrame([(i, prose(i, 40, 60) if i % 7 else None) for i in range(60)], "i long, t string")
    target = spark.range(0, 60, 3).withColumnRenamed("id", "i")

    def score():
        rows = lm_score.cross_entropy_difference(docs, "i", "t", target, "i", 3).collect()
        return sorted((r.id, r.n, r.target_loss and round(r.target_loss, 4), r.background_loss and round(r.background_loss, 4)) for r in rows)

    whole = score()
    monkeypatch.setattr(lm_score.b, "pack", lambda *a, **k: PACK(*a, limit=600, **k))
    monkeypatch.setattr(ngram_lm, "shard_bits", lambda n: 3)
    assert score() == whole


PACK = batches.pack


def test_perplexity_by_definition(spark, tmp_path):
    rows = [(i, prose(i, 12, 9), "en") for i in range(24)] + [(50, "é ok", "en"), (51, None, "en")]
    spark.createDataFrame(rows, "i long, t string, lang string").write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    trusted = spark.range(20).withColumnRenamed("id", "i")
    order = 3
    chosen = trusted.withColumn("h", F.xxhash64("i")).collect()
    fitted = [dict((a, b) for a, b, _ in rows)[r.i] for r in chosen if r.h % quality_lm.HELD_OUT]
    p = kneser_ney(fitted, order, 256)
    for r in quality_lm.classify(df, "i", "t", "lang", trusted, "i", order=order).collect():
        raw = bytes(order - 1) + (dict((a, b) for a, b, _ in rows)[r.id] or "").encode()
        grams = [raw[k - order : k] for k in range(order, len(raw) + 1)]
        assert r.n == len(grams)
        if grams:
            assert r.perplexity == pytest.approx(2 ** (-sum(np.log2(p(g)) for g in grams) / len(grams)), rel=1e-5)


def test_quality_model_counts_all_trusted_documents(spark, tmp_path):
    many = 18_000
    last = spark.range(many).withColumn("h", F.xxhash64("id")).where(F.col("h") % quality_lm.HELD_OUT != 0).orderBy(F.desc("h")).first().id
    rows = spark.range(many).select(F.col("id").alias("i"), F.when(F.col("id") == last, "qzqzqzqzqz").otherwise("a b").alias("t"), F.lit("en").alias("lang"))
    rows.repartition(4).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    perplexity = lambda **k: quality_lm.classify(df, "i", "t", "lang", df.select("i"), "i", **k).where(F.col("id") == last).first().perplexity
    assert perplexity() < perplexity(sample=16_000) / 2


def test_shards_cut_once_hold_every_key():
    keys = np.unique(w.mix(np.arange(5000, dtype=np.uint64)))
    parts = ngram_lm._by_shard(keys, 4)
    assert sorted(np.concatenate([at for _, at in parts]).tolist()) == list(range(5000)) and len(parts) == 16
    assert all((ngram_lm._shard(keys[at], 4) == s).all() and (np.diff(at) > 0).all() for s, at in parts)
    assert ngram_lm._by_shard(keys[:0], 4) == []


def test_families_in_small_blocks(spark, monkeypatch):
    def components():
        return sorted((r.doc_id, r.component_id) for r in queries.QUERIES["op7_minhash_near_dedup"](spark, SMALL).collect())

    whole = components()
    for name, value in (("FAMILY", 1), ("BLOCK_NODES", 4), ("PIECE", 20_000)):
        monkeypatch.setattr(minhash, name, value)
    assert components() == whole


def test_blocks_are_dealt_out_by_block(spark):
    groups = spark.createDataFrame([(1, n, n) for n in range(4)], "grp long, node long, component long")
    sets = spark.createDataFrame([(n, bytearray(8)) for n in range(4)], "node long, shingles binary")
    plan = minhash._between(groups, sets, 80)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(grp" in plan and any("i#" in x and "j#" in x for x in plan.split("hashpartitioning(grp")[1:])


def test_marks_tell_unrelated_documents_apart():
    """Of two unrelated sets hardly any marks agree, however large the sets."""
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1, 2]), "text": pa.array([prose(1, 1500, 10**6), prose(2, 1500, 10**6)])})
    (out,) = list(minhash._sign(5)(iter([batch])))
    a, b = (np.frombuffer(x, np.uint8) for x in out.column("marks").to_pylist())
    assert len(a) == minhash.MARKS and (a == b).mean() < 0.05


def test_each_measure_rejects_its_outlier(spark):
    """Limits come from the group: a document far from the others fails although the base rules hold."""
    word = lambda i: "abcdefghij"[i % 10] * (3 + i % 5) + str(i)
    plain = lambda i: "\n".join(" ".join(word(i * 1000 + 40 * k + j) for j in range(12)) for k in range(8))
    repeated = " ".join(word(j) for j in range(10))
    odd = {
        900: plain(900) + " #$%" * 12, 901: plain(901) + "\nsame line of few words" * 6, 902: plain(902) + ("\nx " + repeated + "\ny " + repeated),
        903: " ".join(chr(97 + i % 26) + chr(97 + i // 26) for i in range(100)), 904: " ".join(word(i) * 9 for i in range(100)),
    }
    rows = [(i, plain(i), "en", "s") for i in range(300)] + [(i, t, "en", "s") for i, t in odd.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    measured = quality_rules.measure(df, "text", "m")
    out = {r.doc_id: r for r in quality_rules.judge(measured, "m", "lang", "source", "kept").withColumn("base", quality_rules.base_failed("m")).collect()}
    assert not any(r.base for r in out.values())
    assert {i for i, r in out.items() if not r.kept} == set(odd)


def test_limits_follow_their_group(spark):
    """The same document is an outlier in one group and ordinary in another."""
    noisy = lambda i: prose(i, 60) + " " + " ".join(f"#{j}" for j in range(20 + i % 7))
    rows = [(i, prose(i, 70), "en", "clean") for i in range(150)] + [(i, noisy(i), "en", "noisy") for i in range(200, 350)]
    rows += [(900, noisy(3), "en", "clean"), (901, noisy(3), "en", "noisy")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = quality_rules.judge(quality_rules.measure(df, "text", "m"), "m", "lang", "source", "kept").where("NOT kept").collect()
    assert [r.doc_id for r in out] == [900]
