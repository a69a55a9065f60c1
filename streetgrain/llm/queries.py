"""One query per corpus operator over the whole tables, and check SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from . import spans as sp
from . import bpe, codebooks, decontaminate, licenses, lm_score, minhash, mixing, pii, quality_lm, quality_rules, secrets, substring_dedup, whitening

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Words of the SQL: runs without ASCII white space, in order.
_WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query(f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
g AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d),
k AS (SELECT doc_id, i, row_number() OVER (
        PARTITION BY array_to_string(list_slice(ws, i, i + 19), ' ') ORDER BY doc_id, i) AS n FROM g),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM k WHERE n > 1),
p AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM d),
m AS (SELECT p.doc_id, p.p, p.word, r.p IS NOT NULL AS gone FROM p LEFT JOIN r ON p.doc_id = r.doc_id AND p.p = r.p),
a AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS t
      FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN a ON d.doc_id = a.doc_id
""")
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(read(spark, sf_dir, "documents"), "doc_id", "text")
    return out.select(
        F.col("id").alias("doc_id"), "n_words", span_words("removed").alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


# Near-duplicate components of DOCS by shingles of WIDTH words.
SHINGLES = f"""
d AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM DOCS),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < WIDTH THEN array_to_string(ws, ' ')
        ELSE array_to_string(list_slice(ws, i, i + WIDTH - 1), ' ') END AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - WIDTH + 2, 2))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS id, doc_id AS root FROM d UNION SELECT e.y, r.root FROM r JOIN e ON r.id = e.x),
c AS (SELECT id, min(root) AS component_id FROM r GROUP BY id)
"""


@query("WITH RECURSIVE " + SHINGLES.replace("DOCS", "documents").replace("WIDTH", "2") + """
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN c ON d.doc_id = c.id LEFT JOIN n ON d.doc_id = n.doc_id
""")
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.near_duplicates(read(spark, sf_dir, "documents"), "doc_id", "text", width=2)
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(True))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), kept.alias("kept"))


def span_words(spans: str):
    """Words in the intervals of a column."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERS = f"list_filter(string_split_regex({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
CONTAMINATION = f"""
d AS (SELECT doc_id, {_LETTERS} AS ws FROM DOCS),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_LETTERS} AS ws FROM benchmark),
v AS (SELECT DISTINCT item, CAST(least(len(ws), 13) AS BIGINT) AS n, array_to_string(list_slice(ws, i, i + 12), ' ') AS g
      FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 11, 2))) AS i FROM b WHERE len(ws) > 0)),
z AS (SELECT DISTINCT n FROM v),
o AS (SELECT doc_id, i, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS g
      FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, z)),
m AS (SELECT o.doc_id, o.i, v.n, v.item FROM o JOIN v ON o.g = v.g AND o.n = v.n),
h AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM m GROUP BY doc_id)
"""


@query("WITH " + CONTAMINATION.replace("DOCS", "documents") + """
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n, 0) AS BIGINT) AS n_items, sha256(coalesce(t.s, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
""")
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.find_contamination(docs, "text", read(spark, sf_dir, "benchmark"), "item_id", "text")
    hit = span_words("hits")
    return out.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
    )


_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
# Counts, sketches and limits of the quality rules over DOCS.
QUALITY = f"""
d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS ws,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: length(translate(x, {_BLANKS}, '')) > 0) AS ls FROM DOCS),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(list_slice(ws, i, i + 7), ' ')) AS c
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM g WHERE c > 1) GROUP BY doc_id),
c AS (SELECT d.doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(translate(text, {_BLANKS}, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
        CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id),
q AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        1000 * n_symbols // greatest(word_chars, 1) AS symbols, 1000 * n_dup_lines // greatest(n_lines, 1) AS dup_lines,
        1000 * n_repeat_words // greatest(n_words, 1) AS repeats, 100 * word_chars // greatest(n_words, 1) AS word_length FROM c),
u AS (SELECT lang, source, unnest(['symbols', 'dup_lines', 'repeats', 'word_length']) AS measure,
        unnest([symbols, dup_lines, repeats, word_length]) AS x FROM q WHERE NOT base_failed),
k AS (SELECT lang, source, measure, ((x >> s) + 1 << s) - 1 AS v FROM (SELECT *, CAST(greatest(length(bin(x)) - 6, 0) AS BIGINT) AS s FROM u)),
t(measure, h, fence) AS (VALUES ('symbols', 90, 3), ('dup_lines', 99, 1), ('repeats', 99, 1), ('word_length', 90, 3)),
c0 AS (SELECT *, CAST(sum(n) OVER (PARTITION BY lang, source, measure) AS BIGINT) AS total, CAST(sum(n) OVER (PARTITION BY lang, source, measure ORDER BY v) AS BIGINT) AS upto
      FROM (SELECT lang, source, measure, v, count(*) AS n FROM k GROUP BY ALL)),
k0 AS (SELECT lang, source, measure, max(total) AS n, min(v) FILTER (100 * upto >= (100 - h) * total) AS low, min(v) FILTER (100 * upto >= 50 * total) AS mid,
        min(v) FILTER (100 * upto >= h * total) AS high FROM c0 JOIN t USING (measure) GROUP BY lang, source, measure),
c1 AS (SELECT *, CAST(sum(n) OVER (PARTITION BY lang, measure) AS BIGINT) AS total, CAST(sum(n) OVER (PARTITION BY lang, measure ORDER BY v) AS BIGINT) AS upto
      FROM (SELECT lang, measure, v, count(*) AS n FROM k GROUP BY ALL)),
k1 AS (SELECT lang, measure, max(total) AS n, min(v) FILTER (100 * upto >= (100 - h) * total) AS low, min(v) FILTER (100 * upto >= 50 * total) AS mid,
        min(v) FILTER (100 * upto >= h * total) AS high FROM c1 JOIN t USING (measure) GROUP BY lang, measure),
c2 AS (SELECT *, CAST(sum(n) OVER (PARTITION BY measure) AS BIGINT) AS total, CAST(sum(n) OVER (PARTITION BY measure ORDER BY v) AS BIGINT) AS upto
      FROM (SELECT measure, v, count(*) AS n FROM k GROUP BY ALL)),
k2 AS (SELECT measure, max(total) AS n, min(v) FILTER (100 * upto >= (100 - h) * total) AS low, min(v) FILTER (100 * upto >= 50 * total) AS mid,
        min(v) FILTER (100 * upto >= h * total) AS high FROM c2 JOIN t USING (measure) GROUP BY measure),
f AS (SELECT k0.lang, k0.source, k0.measure,
        CASE WHEN k0.n >= 100 THEN k0.low WHEN k1.n >= 100 THEN k1.low ELSE k2.low END AS low,
        CASE WHEN k0.n >= 100 THEN k0.mid WHEN k1.n >= 100 THEN k1.mid ELSE k2.mid END AS mid,
        CASE WHEN k0.n >= 100 THEN k0.high WHEN k1.n >= 100 THEN k1.high ELSE k2.high END AS high
      FROM k0 JOIN k1 ON k0.lang IS NOT DISTINCT FROM k1.lang AND k0.measure = k1.measure JOIN k2 ON k0.measure = k2.measure),
w AS (SELECT lang, source, f.measure, low - fence * (mid - low) - 8 * (CAST(1 AS BIGINT) << CAST(greatest(length(bin(low)) - 6, 0) AS BIGINT)) AS least,
        high + fence * (high - mid) + 8 * (CAST(1 AS BIGINT) << CAST(greatest(length(bin(high)) - 6, 0) AS BIGINT)) AS most FROM f JOIN t ON f.measure = t.measure),
x AS (SELECT q.doc_id FROM q JOIN w ON q.lang IS NOT DISTINCT FROM w.lang AND q.source IS NOT DISTINCT FROM w.source
      WHERE CASE measure WHEN 'symbols' THEN symbols WHEN 'dup_lines' THEN dup_lines WHEN 'repeats' THEN repeats ELSE word_length END
            NOT BETWEEN least AND most),
verdict AS (SELECT q.*, NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM x) AS kept FROM q)
"""


@query("WITH " + QUALITY.replace("DOCS", "documents") + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM verdict
""")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    # The counts are written once: the sketches and the verdicts both read them.
    counts = written(quality_rules.measure(docs, "text", "m").drop("text"), "counts")
    out = quality_rules.judge(counts, "m", "lang", "source", "kept")
    return out.select(
        "doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
        quality_rules.base_failed("m").alias("base_failed"), "kept",
    )


MIX = f"""
d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM DOCS),
s AS (SELECT *, (CASE k % 3 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 2 END) AS weight, 2 * source_size AS most FROM (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM d GROUP BY source)),
a AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS every, CAST(sum(weight) OVER () AS BIGINT) AS weights,
        CAST(sum(most) OVER w AS BIGINT) - most AS used, CAST(sum(weight) OVER w AS BIGINT) - weight AS passed
      FROM s WINDOW w AS (ORDER BY most / weight, k ROWS UNBOUNDED PRECEDING)),
c AS (SELECT *, (3 * every - 2 * used) * weight >= 2 * most * (weights - passed) AS stops FROM a),
e AS (SELECT *, CAST(sum(CASE WHEN stops THEN most ELSE 0 END) OVER () AS BIGINT) AS full_,
        CAST(sum(CASE WHEN stops THEN 0 ELSE weight END) OVER () AS BIGINT) AS open_ FROM c),
t AS (SELECT source, source_size, CASE WHEN stops THEN CAST(most AS DOUBLE)
        ELSE CAST((3 * every - 2 * full_) * weight AS DOUBLE) / (2 * open_) END AS target FROM e),
o AS (SELECT d.*, source_size, target, CAST(sum(size) OVER (PARTITION BY d.source
        ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS begin_,
        CAST(floor(target + 0.5) AS BIGINT) AS goal
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
mixed AS (SELECT doc_id, source, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE
        goal // source_size * size + greatest(0, least(size, goal % source_size - begin_)) END AS taken FROM o)
"""


@query("WITH " + MIX.replace("DOCS", "documents") + " SELECT doc_id, size, source_size, target, taken FROM mixed")
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mixed(read(spark, sf_dir, "documents"), "doc_id", "text", "source")
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def _spans_of(found: DataFrame, column: str, kinds: tuple[str, ...]) -> DataFrame:
    spans = F.col(column)
    base = sp.base_only(spans)
    return found.select(
        "doc_id", *[sp.count_of(base, k).alias(f"n_{k}") for k in kinds],
        F.sha2(sp.joined(base), 256).alias("base_sha256"), sp.joined(spans).alias("spans"),
    )


@query()
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return _spans_of(pii.find_personal_data(docs, "text"), "personal", pii.KINDS)


@query()
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return _spans_of(secrets.find_secrets(docs, "text"), "secrets", tuple(r.kind for r in secrets.BASE))


def _good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of trusted documents."""
    return read(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


@query()
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_lm.classify(read(spark, sf_dir, "documents"), "doc_id", "text", "lang", _good(spark, sf_dir), "doc_id")
    return out.select(
        F.col("id").alias("doc_id"), "lang", F.col("n").alias("n_tokens"), F.round("perplexity", 4).alias("perplexity"),
        F.round("threshold", 4).alias("threshold"), "kept",
    )


@query()
def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm_score.cross_entropy_difference(read(spark, sf_dir, "documents"), "doc_id", "text", _good(spark, sf_dir), "doc_id")
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_tokens"), F.round("target_loss", 4).alias("target_loss"),
        F.round("background_loss", 4).alias("background_loss"), F.round("score", 4).alias("score"),
    )


@query()
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table has no paths, so documents stand in folders by source, language and number; short ones are licence files.
    docs = read(spark, sf_dir, "documents")
    name = F.when(F.octet_length("text") < 400, F.concat(F.lit("LICENSE-"), F.col("doc_id"))).otherwise(F.concat("doc_id", F.lit(".txt")))
    folder = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 64).cast("string"))
    files = docs.select("doc_id", F.concat_ws("/", folder, name).alias("path"), "text")
    out = licenses.scan(files, "doc_id", "path", "text")
    return out.select(
        F.col("id").alias("doc_id"), "path", F.col("notice.license").alias("own_license"), F.round("notice.score", 6).alias("score"),
        F.col("notice.line").alias("line"), "in_header", "license", F.col("from").alias("inherited_from"),
    )


def vocabulary() -> str:
    """Where the public vocabulary of op11 lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary()
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = bpe.encode(docs, "text", path, packed=True).select("doc_id", "ids")
    return bpe.decode(tokens, "ids", path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _codebook_sql() -> str:
    """Rounds of nearest entries and floored means, one pair of CTEs each."""
    part = "list_slice(x, 1 + p * len(x) // 4, (p + 1) * len(x) // 4)"
    sql = f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS DOUBLE)) AS x FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
w AS (SELECT vec_id, label, p, {part} AS y FROM v, (SELECT unnest(range(0, 4)) AS p)),
b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS j, y AS c FROM w
       QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= 256),"""
    for k in range(5):
        sql += f"""
a{k} AS MATERIALIZED (SELECT vec_id, label, w.p, any_value(y) AS y,
       min(CAST(list_dot_product(y, y) - 2 * list_dot_product(y, c) + list_dot_product(c, c) AS BIGINT) * 256 + j) AS best
       FROM w JOIN b{k} b ON w.p = b.p GROUP BY vec_id, label, w.p),"""
        if k < 4:
            sql += f"""
m{k} AS (SELECT p, j, list(f ORDER BY i) AS c FROM (SELECT p, best % 256 AS j, i, floor(sum(y[i]) / count(*)) AS f
        FROM (SELECT p, best, y, unnest(range(1, len(y) + 1)) AS i FROM a{k}) GROUP BY ALL) GROUP BY p, j),
b{k + 1} AS MATERIALIZED (SELECT b.p, b.j, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN m{k} m ON b.p = m.p AND b.j = m.j),"""
    return sql + """
r AS (SELECT vec_id, label, string_agg(printf('%02x', best % 256), '' ORDER BY p) AS code, CAST(sum(best // 256) AS BIGINT) AS error
      FROM a4 GROUP BY vec_id, label),
h AS (SELECT sha256(string_agg(CAST(CAST(f AS BIGINT) AS VARCHAR), ',' ORDER BY p, j, i)) AS s
      FROM (SELECT p, j, unnest(range(1, len(c) + 1)) AS i, unnest(c) AS f FROM b4))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s AS codebooks_sha256 FROM r, h
"""


@query(_codebook_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, books = codebooks.compress(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(codebooks.digest(books)).alias("codebooks_sha256"))


@query()
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(read(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return out.select(F.col("id").alias("vec_id"), "component", "n", "deviation", "whitened", "explained", "identity_error")
