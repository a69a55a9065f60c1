"""Cross-entropy difference of each document between a target and a background model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import batches as b
from . import ngram_lm as lm


def cross_entropy_difference(
    docs: DataFrame, id_col: str, text_col: str, target: DataFrame, target_id: str, order: int = lm.ORDER
) -> DataFrame:
    """Per row: id, n (tokens), target_loss, background_loss and score, their difference, in bits a token.

    The target model counts every document whose id is in ``target``, the
    background model every document. Both have the same length, discounts and
    vocabulary: the distinct bytes of the whole corpus. A lower score is more
    like the target. Texts without tokens have null losses and score. Rows of
    null id are background only; rows of equal id are all target if one is.
    Without target documents the target model is uniform.
    """
    packed = b.pack(docs, id_col, text_col)
    size = packed.agg(F.sum("n_bytes")).first()[0] or 0
    bits = lm.shard_bits(size)
    chosen = target.select(F.col(target_id).cast("long").alias("id")).distinct()
    sent = written(lm.send_marked(packed, lm.marks(packed, chosen), order, bits), "grams")
    counted = written(lm.counts(sent), "counts")
    symbols = max(1, counted.select(lm.suffix(F.col("gram"), 1).alias("s")).distinct().count())
    names = ("target", "background")
    # Every n-gram of the corpus is in the background's tables, so they hold all answers.
    models = lm.Models(counted, ("n_marked", "n_all"), order, symbols)
    total = lm.sums(packed, lm.answer(sent, models.seen_bits(names), names), order, bits, names)

    def mean(c):
        return F.when(F.col("n") > 0, c / F.col("n"))

    t, g = F.col("target"), F.col("background")
    return total.select("id", "n", mean(t).alias("target_loss"), mean(g).alias("background_loss"), mean(t - g).alias("score"))
