"""Quality rules whose limits come from mergeable quantile sketches per language and source.

DataFrame functions only. A sketch is a table of counts by bucket, the bucket
growing with the value, so sketches merge by adding counts, in any order, with
the same result. A bucket is at most 1/32 of its value wide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SPACE = "[\\x20\\x09-\\x0D]+"
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
RUN = 8  # words of a repeated window
LEAST_WORDS = 20
REPEAT_PERCENT = 30

# Per measure: the upper quantile of a group, in hundredths, and how many times its distance
# from the median a document may lie beyond it; below, the same with the lower quantile.
# Junk can be a tenth of a group, so the quantile lies below it where sound documents hardly
# differ; repeats are rare and uneven in sound documents, so theirs is taken far out.
HIGH = {"symbols": 90, "dup_lines": 99, "repeats": 99, "word_length": 90}
FENCE = {"symbols": 3, "dup_lines": 1, "repeats": 1, "word_length": 3}
# Buckets of the sketch that are allowed beyond in any case: it knows no finer.
BUCKETS = 8
# A group of fewer documents takes the limits of its language, then of all.
LEAST_GROUP = 100


def _bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column, n: Column) -> Column:
    """Words in windows of RUN words that the text has twice or more."""
    windows = F.transform(F.sequence(F.lit(1), n - RUN + 1), lambda i: F.struct(F.array_join(F.slice(words, i, RUN), " ").alias("g"), i.alias("i")))

    def starts(s: Column) -> Column:
        def twice(j: Column) -> Column:
            own = F.get(s, j)["g"]
            return F.when(F.coalesce(own == F.get(s, j - 1)["g"], F.lit(False)) | F.coalesce(own == F.get(s, j + 1)["g"], F.lit(False)), F.get(s, j)["i"])

        return F.array_sort(F.array_compact(F.transform(F.sequence(F.lit(0), F.size(s) - 1), twice)))

    def cover(d: Column) -> Column:
        step = lambda acc, j: acc + F.least(F.lit(RUN), F.coalesce(F.get(d, j + 1) - F.get(d, j), F.lit(RUN)))
        return F.when(F.size(d) > 0, F.aggregate(F.sequence(F.lit(0), F.size(d) - 1), F.lit(0), step)).otherwise(0)

    # Equal windows have equal hashes, so texts without a repeated hash are done; the rest is compared as text.
    keys = F.transform(F.sequence(F.lit(1), n - RUN + 1), lambda i: F.xxhash64(F.slice(words, i, RUN)))
    suspect = _bind(keys, lambda k: F.size(F.array_distinct(k)) < F.size(k))
    exact = _bind(F.array_sort(windows), lambda s: _bind(starts(s), cover))
    return F.when(n > RUN, F.when(suspect, exact).otherwise(0)).otherwise(0).cast("long")


def measure(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """All columns of ``docs`` and a struct ``name`` of counts of each text; null is an empty text.

    Equal rows are counted alike, each for itself. ``name`` and the same with _words and
    _lines must not be taken. A long text is one row's work, with some eight times its
    size in windows where some repeat.
    """
    work = docs
    text = F.coalesce(F.col(text_col), F.lit(""))
    words, lines = f"{name}_words", f"{name}_lines"
    work = work.withColumns({
        words: F.array_remove(F.split(text, SPACE), ""),
        lines: F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0),
    })
    n = F.size(words)
    counts = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        _repeat_words(F.col(words), n).alias("n_repeat_words"),
    )
    return work.withColumn(name, counts).drop(words, lines)


def base_failed(m: str) -> Column:
    n = F.col(f"{m}.n_words")
    return (n < LEAST_WORDS) | (100 * F.col(f"{m}.n_repeat_words") > REPEAT_PERCENT * n)


def rates(m: str) -> dict[str, Column]:
    """Whole-number measures: per mille, and hundredths of a character."""
    def share(a: str, b: str, unit: int) -> Column:
        return F.floor(unit * F.col(f"{m}.{a}") / F.greatest(F.col(f"{m}.{b}"), F.lit(1)))

    return {
        "symbols": share("n_symbols", "word_chars", 1000), "dup_lines": share("n_dup_lines", "n_lines", 1000),
        "repeats": share("n_repeat_words", "n_words", 1000), "word_length": share("word_chars", "n_words", 100),
    }


def bucket(x: Column) -> Column:
    """Largest value of the bucket of a whole number from 0 on; exact below 64."""
    shift = F.greatest(F.length(F.bin(x)) - 6, F.lit(0))
    top = F.call_function("shiftright", x, shift)
    return F.call_function("shiftleft", top + 1, shift) - 1


def width(value: Column) -> Column:
    """Width of the bucket that a value lies in."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.length(F.bin(value)) - 6, F.lit(0)))


def sketches(measured: DataFrame, m: str, lang: Column, source: Column) -> DataFrame:
    """Counts by language, source, measure and bucket. Documents that fail the base rules don't count."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), bucket(v).alias("value")) for k, v in rates(m).items()]))
    rows = measured.where(~base_failed(m)).select(lang.alias("lang"), source.alias("source"), each.alias("e"))
    return rows.groupBy("lang", "source", "e.measure", "e.value").agg(F.count("*").alias("n"))


def limits(sketch: DataFrame) -> DataFrame:
    """One row per language and source with the least and greatest allowed value of each measure."""
    def of(table: dict[str, int]) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.col("measure"))

    def merged(level: int, *keys: str) -> DataFrame:
        whole = sketch.groupBy(*keys, "measure", "value").agg(F.sum("n").alias("n"))
        w = Window.partitionBy(*keys, "measure")
        sums = whole.select(
            *keys, "measure", "value", F.sum("n").over(w).alias("total"),
            F.sum("n").over(w.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        )
        # Smallest bucket that so many hundredths of the documents reach.
        at = lambda hundredths: F.min(F.when(100 * F.col("upto") >= hundredths * F.col("total"), F.col("value")))
        return sums.withColumn("high", of(HIGH)).groupBy(*keys, "measure").agg(
            F.max("total").alias(f"n{level}"), at(100 - F.col("high")).alias(f"low{level}"), at(F.lit(50)).alias(f"mid{level}"),
            at(F.col("high")).alias(f"high{level}"),
        )

    own, by_lang, whole = merged(0, "lang", "source"), merged(1, "lang"), merged(2)
    by_lang = by_lang.withColumnsRenamed({"lang": "l1", "measure": "m1"})
    whole = whole.withColumnRenamed("measure", "m2")
    all_ = own.join(by_lang, F.col("lang").eqNullSafe(F.col("l1")) & (F.col("measure") == F.col("m1")))
    all_ = all_.join(whole, F.col("measure") == F.col("m2"))

    def pick(name: str) -> Column:
        return (
            F.when(F.col("n0") >= LEAST_GROUP, F.col(f"{name}0")).when(F.col("n1") >= LEAST_GROUP, F.col(f"{name}1"))
            .otherwise(F.col(f"{name}2"))
        )

    chosen = all_.select("lang", "source", "measure", of(FENCE).alias("fence"), *[pick(c).alias(c) for c in ("low", "mid", "high")])
    fences = chosen.select(
        "lang", "source", "measure",
        (F.col("low") - F.col("fence") * (F.col("mid") - F.col("low")) - BUCKETS * width(F.col("low"))).alias("least"),
        (F.col("high") + F.col("fence") * (F.col("high") - F.col("mid")) + BUCKETS * width(F.col("high"))).alias("most"),
    )
    flat = [
        F.max(F.when(F.col("measure") == k, F.col(side))).alias(f"{side}_{k}") for k in HIGH for side in ("least", "most")
    ]
    return fences.groupBy("lang", "source").agg(*flat)


def judge(measured: DataFrame, m: str, lang_col: str, source_col: str, kept: str) -> DataFrame:
    """All columns of ``measured`` and the verdict: base rules hold and every measure lies within its group's limits.

    A null language or source is a group of its own. A group in which every
    document fails the base rules has no limits and needs none. Rows that are equal
    count each time and are judged alike. ``kept`` and the same with _key and _limits
    must not be taken.
    """
    lang, source = F.col(lang_col), F.col(source_col)
    table = limits(sketches(measured, m, lang, source)).select(
        F.struct(F.col("lang").alias("lang"), F.col("source").alias("source")).alias(f"{kept}_key"),
        F.struct(*[f"{s}_{k}" for k in HIGH for s in ("least", "most")]).alias(f"{kept}_limits"),
    )
    on = lang.eqNullSafe(F.col(f"{kept}_key.lang")) & source.eqNullSafe(F.col(f"{kept}_key.source"))
    joined = measured.join(table, on, "left")
    inside = F.lit(True)
    for k, v in rates(m).items():
        inside = inside & v.between(F.col(f"{kept}_limits.least_{k}"), F.col(f"{kept}_limits.most_{k}"))
    verdict = ~base_failed(m) & F.coalesce(inside, F.lit(True))
    return joined.withColumn(kept, verdict).drop(f"{kept}_key", f"{kept}_limits")
