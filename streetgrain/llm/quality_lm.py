"""Quality classifier: perplexity under a Kneser-Ney model of trusted text, with a limit per language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written
from . import batches as b
from . import ngram_lm as lm

# One in so many trusted documents is held out of the fit; these set the limits.
HELD_OUT = 4
# Batches in a bucket of the packed documents, at about BATCH_BYTES of text each.
BATCHES = 8
# A quantile is sought in a bucket of perplexities; so many buckets double the value.
BUCKETS = 1024
QUANTILE = 0.99
# A language with fewer documents that set limits takes the limit over all languages.
LEAST_GROUP = 50
# A quantile of few documents is rough: of LEAST_GROUP documents the limit is the
# quantile times this; the excess falls with the root of their number, as the error does.
MARGIN = 1.5


def _trusted(trusted: DataFrame, id_col: str, sample: int | None) -> tuple[DataFrame, DataFrame]:
    """Ids to fit on, and the ids of all other trusted documents."""
    rows = trusted.select(F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL").distinct().withColumn("h", F.xxhash64("id"))
    held = F.col("h") % HELD_OUT == 0
    if sample is None:
        rows = written(rows.select("id", (~held).alias("fit")), "trusted")
    else:
        first = written(rows.orderBy("h", "id").limit(sample).where(~held).select("id", F.lit(True).alias("fit")), "fit")
        rows = written(rows.select("id").join(first, "id", "left").select("id", F.coalesce("fit", F.lit(False)).alias("fit")), "trusted")
    return rows.where("fit").select("id"), rows.where("NOT fit").select("id")


def _quantiles(sure: DataFrame, quantile: float) -> DataFrame:
    """whole, l (language), many and own (the exact quantile): a row per language, and one of all rows where whole is true.

    Counts by bucket tell in which buckets the quantile lies; only their values are ordered.
    """
    level = F.explode(F.array(
        F.struct(F.lit(False).alias("whole"), F.col("lang").alias("l")), F.struct(F.lit(True).alias("whole"), F.lit(None).cast("string").alias("l")),
    ))
    rows = sure.select(level.alias("g"), "perplexity").groupBy("g.whole", "g.l", "perplexity").agg(F.count("*").alias("n"))
    rows = written(rows.withColumn("bucket", F.floor(F.log2("perplexity") * BUCKETS)), "held_out")
    w = Window.partitionBy("whole", "l")
    upto = w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy("whole", "l", "bucket").agg(F.sum("n").alias("m"))
    sums = sums.select("*", F.sum("m").over(w).alias("many"), (F.sum("m").over(upto) - F.col("m")).alias("before"))
    sums = sums.withColumn("place", (F.col("many") - 1) * quantile)
    low, high = F.floor("place"), F.ceil("place")
    sums = sums.where((F.col("before") <= high) & (F.col("before") + F.col("m") > low))
    sums = sums.withColumnsRenamed({"whole": "w2", "l": "l2", "bucket": "b2"})
    on = (F.col("whole") == F.col("w2")) & F.col("l").eqNullSafe(F.col("l2")) & (F.col("bucket") == F.col("b2"))
    inside = rows.join(sums, on)
    order = Window.partitionBy("whole", "l", "bucket").orderBy("perplexity").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("upto", F.col("before") + F.sum("n").over(order))
    ends = inside.groupBy("whole", "l", "many", "place").agg(
        F.min(F.when(F.col("upto") > low, F.col("perplexity"))).alias("x"), F.min(F.when(F.col("upto") > high, F.col("perplexity"))).alias("y"),
    )
    return ends.select("whole", "l", "many", (F.col("x") + (F.col("y") - F.col("x")) * (F.col("place") - low)).alias("own"))


def _margin(many: Column) -> Column:
    return 1 + (MARGIN - 1) * F.sqrt(F.lit(LEAST_GROUP) / F.greatest(many, F.lit(LEAST_GROUP)))


def classify(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, trusted: DataFrame, trusted_id: str,
    order: int = lm.ORDER, sample: int | None = None, quantile: float = QUANTILE,
) -> DataFrame:
    """Per row: id, lang, n (tokens), perplexity, threshold, kept.

    The model counts all trusted documents but those held out, one in
    ``HELD_OUT`` by hash of the id; every document is scored on its whole text. A
    document is kept if its perplexity is at most the ``quantile`` of the trusted
    documents in its language that the model was not fitted on, and a margin that
    vanishes as they grow many. Texts without tokens have no perplexity and
    aren't kept; without any such document there is no limit and all others are
    kept. Null language is a language of its own. Rows of null id are never
    trusted. Each row is judged for itself. A caller may fit on the ``sample``
    trusted documents of smallest hash instead; all others then set the limits.
    """
    fit, held = _trusted(trusted, trusted_id, sample)
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    bits = lm.shard_bits(size)
    # No fewer than the partitions of a shuffle, or Spark shuffles the table for more of them.
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // (BATCHES * b.BATCH_BYTES))
    packed = b.pack(docs, id_col, text_col, keep=(lang_col,), buckets=buckets)
    sent = written(lm.send_marked(packed, lm.marks(packed, fit), order, bits, total=False), "grams")
    counted = written(lm.counts(sent, ("n_marked",)), "counts")
    model = lm.Models(counted.where("n_marked > 0").select("gram", "n_marked"), ("n_marked",), order, symbols=256)
    scored = written(model.score(counted.select("shard", "gram"), ("bits",)), "scores")
    result = lm.sums(packed, lm.answer(sent, scored, ("bits",)), order, bits, ("bits",), keep=1)
    result = result.select("id", F.col("k0").alias("lang"), "n", F.when(F.col("n") > 0, F.pow(F.lit(2.0), F.col("bits") / F.col("n"))).alias("perplexity"))
    result = written(result, "perplexity")
    found = _quantiles(result.where("n > 0").join(held, "id", "left_semi"), quantile)
    found = written(found.withColumn("own", F.col("own") * _margin(F.col("many"))), "limits")
    by_lang = found.where(~F.col("whole") & (F.col("many") >= LEAST_GROUP)).select("l", "own")
    whole = found.where("whole").select("own").first()
    whole = whole and whole[0]
    joined = result.join(by_lang, F.col("lang").eqNullSafe(F.col("l")), "left")
    limit = F.coalesce(F.col("own"), F.lit(whole).cast("double"))
    kept = (F.col("n") > 0) & F.coalesce(F.col("perplexity") <= limit, F.lit(True))
    return joined.select("id", "lang", "n", "perplexity", limit.alias("threshold"), kept.alias("kept"))
