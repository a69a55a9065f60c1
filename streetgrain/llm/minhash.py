"""Near-duplicate documents by MinHash: universal minima, banding, verification, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import words as w
from .components import connected_components

SHINGLE = 5
PERCENT = 80
# 60 bands of 7 minima: a pair of similarity 0.8 shares no band with probability
# (1 - 0.8 ** 7) ** 60 = 7e-7, one of similarity 0.1 shares one with 6e-6.
BANDS, ROWS = 60, 7
# Minima that a pair's signatures are compared by. A pair whose share of equal ones
# is lower than the similarity less the slack is not looked at further: at 0.8 the
# standard deviation is 0.028, so a true link fails with probability 1e-7.
MARKS, SLACK = 210, 0.15
FAMILY = 8192  # nodes up to which a family is tried as a whole, not bucket by bucket
BLOCK_NODES, BLOCK_BYTES = 512, 8 << 20
WIDE = 8192  # columns of a 0/1 matrix
BROADCAST_IDS = 500_000  # 4 MB of ids
PIECE = 2 << 20
BLOCK = 1 << 15


def _draw(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed odd multipliers and offsets of the hash family x -> a * x + b modulo 2**64."""
    seeds = w.mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(w.ODD[2]))
    return seeds[:n] | np.uint64(1), seeds[n:]


def shingle_sets(words: w.Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one after the other, and the bounds of each text.

    A text of fewer words, but not none, has one shingle: all its words.
    """
    one = w.hashes(words)
    at, key = w.windows(one, words.first, width)
    bounds = np.searchsorted(at, words.first)
    count = np.diff(words.first)
    out, size = [], np.zeros(len(count), np.int64)
    for i in range(len(count)):
        if count[i] == 0:
            continue
        if count[i] < width:
            own = one[words.first[i] : words.first[i + 1]]
            own = w.mix(w.windows(own, np.array([0, len(own)]), len(own))[1] + np.uint64(len(own)))
        else:
            own = np.sort(key[bounds[i] : bounds[i + 1]])
            new = np.ones(len(own), bool)
            new[1:] = own[1:] != own[:-1]
            own = own[new]
        out.append(own)
        size[i] = len(own)
    values = np.concatenate(out) if out else np.zeros(0, np.uint64)
    return values, np.concatenate([[0], np.cumsum(size)])


def minima(values: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """``n`` minima (rows) of each non-empty set (columns)."""
    a, c = _draw(n)
    out = np.empty((n, len(bounds) - 1), np.uint64)
    at = 0
    while at < out.shape[1]:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BLOCK, "right")) - 1)
        part = values[bounds[at] : bounds[to]]
        starts = bounds[at:to] - bounds[at]
        room = np.empty_like(part)
        for k in range(n):
            np.multiply(part, a[k], out=room)
            np.add(room, c[k], out=room)
            out[k, at:to] = np.minimum.reduceat(room, starts)
        at = to
    return out


def _words(part: pa.RecordBatch) -> w.Words:
    data, offsets = w.text_bytes(part.column("text"))
    return w.split(w.LOWER[data], offsets)


def _fixed(rows: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _sign(width: int):
    def run(parts):
        for whole in parts:
            for part in w.pieces(whole, "text", PIECE):
                values, bounds = shingle_sets(_words(part), width)
                size = np.diff(bounds)
                full = size > 0
                spread = [np.concatenate([[np.uint64(0)], np.cumsum(w.mix(values ^ np.uint64(w.ODD[s])))]) for s in (0, 1)]
                a, c = ((x[bounds[1:]] - x[bounds[:-1]]).view(np.int64) for x in spread)
                edge = np.concatenate([[0], np.cumsum(size[full])])
                low = minima(values, edge, BANDS * ROWS)
                bands = np.zeros((len(size), BANDS), np.uint64)
                marks = np.zeros((len(size), MARKS), np.uint8)
                if full.any():
                    grouped = low.reshape(BANDS, ROWS, -1)
                    key = np.arange(1, BANDS + 1, dtype=np.uint64)[:, None] * np.ones(grouped.shape[2], np.uint64)
                    for r in range(ROWS):
                        key = w.mix(key * np.uint64(w.ODD[0]) + grouped[:, r])
                    bands[full] = key.T
                    # A byte of the mixed minimum: the minima themselves are all small.
                    marks[full] = (w.mix(low[:MARKS]) & np.uint64(255)).astype(np.uint8).T
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(size), pa.array(a), pa.array(c), _fixed(bands), _fixed(marks)],
                    ["id", "n", "set_a", "set_b", "bands", "marks"],
                )

    return run


def _buckets(parts):
    for part in parts:
        if part.num_rows:
            key = np.frombuffer(b"".join(part.column("bands").to_pylist()), np.int64)
            node, n = (np.repeat(part.column(c).to_numpy(zero_copy_only=False), BANDS) for c in ("id", "n"))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), pa.array(n)], ["key", "node", "n"])


def _alike(least: float):
    """Pairs whose share of equal minima reaches the least value; one byte of each is compared."""

    def run(parts):
        for part in parts:
            if part.num_rows:
                x, y = (
                    np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(part.num_rows, -1)
                    for c in ("marks_a", "marks_b")
                )
                keep = (x == y).mean(axis=1) >= least
                yield part.select(["a", "b"]).filter(pa.array(keep))

    return run


def _sets(width: int):
    def run(parts):
        for whole in parts:
            for part in w.pieces(whole, "text", PIECE):
                values, bounds = shingle_sets(_words(part), width)
                sets = [values[bounds[i] : bounds[i + 1]].tobytes() for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets, pa.binary())], ["node", "shingles"])

    return run


def _confirmed(percent: int):
    """Pairs whose full sets reach the similarity."""

    def run(parts):
        for part in parts:
            keep = []
            for x, y in zip(part.column("set_a"), part.column("set_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _pair_with(pairs: DataFrame, table: DataFrame, value: str, name: str) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(table.select(F.col("node").alias(side), F.col(value).alias(f"{name}_{side}")), side)
    return pairs


def _ordered_pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.where(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    near = _pair_with(pairs, nodes, "marks", "marks").mapInArrow(_alike(percent / 100 - SLACK), "a long, b long")
    near = _pair_with(near, sets, "shingles", "set").mapInArrow(_confirmed(percent), "a long, b long")
    return written(near, "links")


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set, by products of 0/1 matrices of bounded width."""
    flat = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    column = np.cumsum(new) - 1
    often = np.bincount(column) > 1  # a shingle of one set is in no intersection
    keep = often[column]
    column, owner = (np.cumsum(often) - 1)[column[keep]], owner[keep]
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, WIDE):
        low, high = np.searchsorted(column, [at, at + WIDE])
        matrix = np.zeros((len(left) + len(right), WIDE), np.float32)
        matrix[owner[low:high], column[low:high] - at] = 1
        out += matrix[: len(left)] @ matrix[len(left) :].T
    return out.astype(np.int64)


def _joining(percent: int):
    """Of the similar pairs between two blocks, some that join all components that any of them joins."""

    def run(table: pa.Table) -> pa.Table:
        mine = table.column("own").to_numpy(zero_copy_only=False)
        node, part = (table.column(c).to_numpy() for c in ("node", "component"))
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        x, y = np.flatnonzero(mine), np.flatnonzero(~mine)
        if table.column("i")[0].as_py() == table.column("j")[0].as_py():
            y = x
        a, b = [], []
        if len(x) and len(y):
            size = np.array([len(s) for s in sets])
            common = common_counts([sets[k] for k in x], [sets[k] for k in y])
            good = 100 * common >= percent * (size[x][:, None] + size[y] - common)
            root: dict[int, int] = {}

            def find(c: int) -> int:
                while root.get(c, c) != c:
                    c = root[c]
                return c

            for p, q in zip(*np.nonzero(good & (part[x][:, None] != part[y])), strict=True):
                p, q = x[p], y[q]
                s, t = sorted((find(part[p]), find(part[q])))
                if s != t:
                    root[t] = s
                    a.append(node[p])
                    b.append(node[q])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _between(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components, all pairs of a group tried, block by block.

    ``groups`` has grp, node and component. A group is dealt into blocks of bounded
    size, and each two blocks are one task's work, which returns fewer links than
    the blocks have components.
    """
    rows = groups.join(sets.withColumn("bytes", F.octet_length("shingles")), "node")
    size = rows.groupBy("grp").agg(F.count("*").alias("many"), F.sum("bytes").alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("many") / BLOCK_NODES), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    placed = rows.drop("bytes").join(size.select("grp", blocks.alias("blocks")), "grp")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = placed.withColumn("at", own).select("grp", "node", "component", "shingles", "at", other)
    dealt = dealt.withColumns({"i": F.least("at", "other"), "j": F.greatest("at", "other"), "own": F.col("at") <= F.col("other")})
    # Rows that lie together by group would stay there: each two blocks need a task's turn of their own.
    dealt = dealt.drop("at", "other").repartition("grp", "i", "j")
    return dealt.groupBy("grp", "i", "j").applyInArrow(_joining(percent), "a long, b long")


def links(nodes: DataFrame, sets: DataFrame, buckets: DataFrame, percent: int) -> DataFrame:
    """(node, component) from verified links; ``buckets`` has key, node, n and score, two nodes a key at least.

    First each node is compared with the most central of its buckets' central
    nodes; that settles most of a group of alike documents at one comparison per
    member. Buckets that still hold several components are open. Components that
    share open buckets form a family, and all pairs of a family's nodes, or of a
    bucket's where a family is large, are tried across components, in blocks. So
    no pair that shares a bucket and could join two components goes untried.
    """
    best = buckets.groupBy("key").agg(F.max_by(F.struct("node", "n", "score"), F.struct("score", -F.col("node"))).alias("p"))
    best = best.select("key", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n"), F.col("p.score").alias("s"))
    # Sets whose sizes differ by more can't be so similar.
    fits = 100 * F.least("n", "pivot_n") >= percent * F.greatest("n", "pivot_n")
    first = buckets.join(best, "key").where((F.col("node") != F.col("pivot")) & fits)
    first = first.groupBy("node").agg(F.max_by("pivot", F.struct("s", -F.col("pivot"))).alias("pivot"))
    edges = _verified(_ordered_pairs(first, "node", "pivot"), nodes, sets, percent)
    part = connected_components(edges)

    rest = buckets.select("key", "node").join(part, "node", "left")
    rest = written(rest.withColumn("component", F.coalesce("component", "node")), "open")
    span = rest.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    open_ = written(rest.join(span.select("key", F.col("x").alias("least")), "key"), "open")
    family = connected_components(open_.select(F.col("component").alias("a"), F.col("least").alias("b")))
    family = family.select(F.col("node").alias("component"), F.col("component").alias("family"))
    members = open_.select("node", "component").distinct().join(family, "component", "left")
    members = written(members.withColumn("family", F.coalesce("family", "component")), "members")
    large = members.groupBy("family").agg(F.count("*").alias("many")).where(F.col("many") > FAMILY).select("family")
    whole = members.join(large, "family", "left_anti").select(F.col("family").alias("grp"), "node", "component")
    apart = open_.join(members.join(large, "family", "left_semi").select("node"), "node", "left_semi")
    apart = apart.select(F.col("key").alias("grp"), "node", "component")
    more = _between(whole, sets, percent).unionByName(_between(apart, sets, percent))
    return connected_components(edges.unionByName(written(more, "links")))


def small_side(ids: DataFrame) -> DataFrame:
    """Ids as a join side: broadcast if they are counted to be few, so that texts needn't be shuffled."""
    ids = written(ids, "ids")
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def near_duplicates(
    docs: DataFrame, id_col: str, text_col: str, width: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """Per row: id, n_shingles and component, the smallest id reachable by links.

    The set of a text holds its distinct shingles of ``width`` words, A-Z lower-cased; documents are linked
    when 100 * intersection >= ``percent`` * union on the full sets. Null, empty
    and blank texts have empty sets and no links. Rows of null id have no links
    and a null component. Rows of equal id are one vertex. Rows of equal sets are
    one node of the search, so exact copies cost no comparison. Shingles are
    compared by 64-bit hashes, whole sets by two such sums and their size.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = written(
        rows.mapInArrow(_sign(width), "id long, n long, set_a long, set_b long, bands binary, marks binary"), "signatures"
    )
    own = signed.select("id", "n", "set_a", "set_b")
    same = ["n", "set_a", "set_b"]
    classes = written(own.where("n > 0 AND id IS NOT NULL").groupBy(*same).agg(F.min("id").alias("node")), "classes")
    first = signed.where("n > 0").join(classes.select(F.col("node").alias("id"), *same), ["id", *same], "left_semi")
    bands = written(first.select("id", "n", "bands", "marks"), "nodes")
    spread = bands.select("id", "n", "bands").mapInArrow(_buckets, "key long, node long, n long")
    sizes = spread.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = written(spread.join(sizes, "key"), "buckets")
    score = shared.groupBy("node").agg(F.sum("size").alias("score"))
    buckets = written(shared.join(score, "node").select("key", "node", "n", "score"), "buckets")
    wanted = small_side(buckets.select(F.col("node").alias("id")).distinct())
    sets = written(rows.join(wanted, "id", "left_semi").mapInArrow(_sets(width), "node long, shingles binary"), "sets")
    nodes = bands.select(F.col("id").alias("node"), "marks")
    part = links(nodes, sets, buckets, percent)
    found = own.join(classes, same, "left").join(part, "node", "left")
    return found.select(
        "id", F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "node", "id")).alias("component"),
    )
