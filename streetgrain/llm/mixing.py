"""Mixing sources to target weights with a low-discrepancy schedule of equal blocks of words.

Each source's documents, in shuffled order, form a stream that is cut into
blocks. Slots of the mix are van der Corput points mapped through the cumulative
slot counts of the sources, so every stretch of the mix holds the sources nearly
in proportion. A slot's rank among its source's slots names the block it takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written

WEIGHTS = (3, 1, 2)
BLOCK = 4096  # words of a slot
SHARE = (3, 2)  # the mix has 3 / 2 of all words
REPEAT = 2  # a document is taken so many times at most
STRETCH = 1 << 16  # slots that are ranked together
WORD = "[^\\x20\\x09-\\x0D]+"


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """id, source and size in words of each document; null text has none."""
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: number k, source, source_size, target.

    Sources by code point, null last, take the weights in turn. Targets share
    SHARE of all words by weight; one that would exceed REPEAT times its source
    stops there and the rest share on. Only rows of sources meet in one task.
    """
    turn = F.array(*[F.lit(x) for x in weights])
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    sources = sources.withColumns({
        "weight": F.element_at(turn, F.pmod(F.col("k") - 1, F.lit(len(weights))) + 1).cast("long"),
        "most": REPEAT * F.col("source_size"),
    })
    # By room per weight: a source stops where its share of what the earlier ones leave exceeds its room.
    by_room = Window.orderBy(F.col("most") / F.col("weight"), "k")
    upto = by_room.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    a, b = SHARE
    sources = sources.withColumns({
        "all": F.sum("source_size").over(whole), "weights": F.sum("weight").over(whole),
        "used": F.sum("most").over(upto) - F.col("most"), "passed": F.sum("weight").over(upto) - F.col("weight"),
    })
    left = a * F.col("all") - b * F.col("used")
    stops = left * F.col("weight") >= b * F.col("most") * (F.col("weights") - F.col("passed"))
    sources = sources.withColumn("stops", stops)
    sources = sources.withColumns({
        "used": F.sum(F.when(F.col("stops"), F.col("most")).otherwise(0)).over(whole),
        "open": F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).over(whole),
    })
    share = ((a * F.col("all") - b * F.col("used")) * F.col("weight")).cast("double") / (b * F.col("open"))
    target = F.when(F.col("stops"), F.col("most").cast("double")).otherwise(share)
    return sources.select("k", "source", "source_size", target.alias("target"))


def _plan(goals: DataFrame) -> DataFrame:
    """Per source the words to take, full passes and rest, and its slots, which follow the earlier sources' slots."""
    size = F.col("source_size")
    goal = F.floor(F.col("target") + 0.5)
    plan = goals.where("source_size > 0").withColumns({
        "passes": F.floor(goal / size), "rest": F.pmod(goal, size), "blocks": F.ceil(size / BLOCK),
    })
    slots = F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / BLOCK)
    plan = plan.withColumn("slots", slots)
    before = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    return plan.withColumn("first", F.sum("slots").over(before) - F.col("slots"))


def _reversed(place: Column, bits: Column) -> Column:
    """Whole number of so many bits, read backwards."""
    return F.conv(F.reverse(F.lpad(F.bin(place), bits, F.lit("0"))), 2, 10).cast("long")


def schedule(goals: DataFrame) -> DataFrame:
    """slot (its order in the mix), k, pass, block, and take: the words that it takes from the block's start."""
    plan = _plan(goals)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    plan = plan.withColumn("bits", F.length(F.bin(F.greatest(F.sum("slots").over(whole) - 1, F.lit(1)))))
    fields = ["k", "source_size", "passes", "rest", "blocks", "slots", "first", "bits"]
    stretches = plan.where("slots > 0").select(*fields, F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / STRETCH))).alias("s"))
    low = F.col("s") * STRETCH
    places = stretches.repartition("k", "s").select(
        *fields, F.explode(F.sequence(low, F.least(low + STRETCH, F.col("slots")) - 1)).alias("n")
    )
    points = places.withColumn("slot", _reversed(F.col("first") + F.col("n"), F.col("bits")))
    # Rank of a slot in its source: within a stretch of slots, after the source's slots in earlier stretches.
    points = points.withColumn("stretch", F.shiftright("slot", 16))
    earlier = points.groupBy("k", "stretch").agg(F.count("*").alias("here"))
    run = Window.partitionBy("k").orderBy("stretch").rowsBetween(Window.unboundedPreceding, 0)
    earlier = earlier.select("k", "stretch", (F.sum("here").over(run) - F.col("here")).alias("before"))
    within = F.row_number().over(Window.partitionBy("k", "stretch").orderBy("slot")) - 1
    ranked = points.withColumn("within", within).join(earlier, ["k", "stretch"]).withColumn("rank", F.col("before") + F.col("within"))
    ranked = ranked.withColumns({"pass": F.floor(F.col("rank") / F.col("blocks")), "block": F.pmod("rank", "blocks")})
    end = F.when(F.col("pass") < F.col("passes"), F.col("source_size")).otherwise(F.col("rest"))
    take = F.least(F.lit(BLOCK), end - F.col("block") * BLOCK)
    return ranked.select("slot", "k", "pass", "block", take.alias("take"))


def streams(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """id, k, size and offset of each document in its source's shuffled stream.

    The order is that of the MD5 of the id; its first digits split a source into
    parts, so that no task orders a whole source.
    """
    keyed = sizes.join(goals.select("k", F.col("source").alias("s")), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    digest = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))
    keyed = keyed.withColumn("digest", digest).withColumn("part", F.substring("digest", 1, 3))
    sums = keyed.groupBy("k", "part").agg(F.sum("size").alias("words"))
    run = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.select("k", "part", (F.sum("words").over(run) - F.col("words")).alias("base"))
    inner = Window.partitionBy("k", "part").orderBy("digest", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = keyed.withColumn("upto", F.sum("size").over(inner)).join(sums, ["k", "part"])
    return placed.select("id", "k", "size", (F.col("base") + F.col("upto") - F.col("size")).alias("offset"))


def mix(placed: DataFrame, goals: DataFrame) -> DataFrame:
    """The mix: slot, k, id, offset of the document, and start and n of the words taken from it."""
    low, high = F.floor(F.col("offset") / BLOCK), F.floor((F.col("offset") + F.col("size") - 1) / BLOCK)
    pieces = placed.where("size > 0").select("id", "k", "size", "offset", F.explode(F.sequence(low, high)).alias("block"))
    found = pieces.join(schedule(goals), ["k", "block"])
    start = F.greatest(F.lit(0), F.col("block") * BLOCK - F.col("offset"))
    end = F.least(F.col("size"), F.col("block") * BLOCK + F.col("take") - F.col("offset"))
    return found.select("slot", "k", "id", "offset", start.alias("start"), (end - start).alias("n")).where("n > 0")


def mixed(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Per document id, size, source_size, target and taken (words, repeats counted).

    Null text has size 0 and is never taken; null source is a source of its own,
    the last; null ids are alike. Rows of equal id keep their own places: ties
    go by size, and equal rows are interchangeable.
    """
    sizes = written(sized(docs, id_col, text_col, source_col), "sizes")
    goals = written(targets(sizes), "targets")
    placed = written(streams(sizes, goals), "streams")
    taken = mix(placed, goals).groupBy("k", "offset").agg(F.sum("n").alias("taken"))
    own = placed.where("size > 0").join(taken, ["k", "offset"], "left").select("id", "k", "size", F.coalesce("taken", F.lit(0)).alias("taken"))
    none = placed.where("size = 0").select("id", "k", "size", F.lit(0).cast("long").alias("taken"))
    return own.unionByName(none).join(goals, "k").select("id", "source", "size", "source_size", "target", "taken")
