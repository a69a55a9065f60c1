"""Token and embedding operators against the tokenizers library and plain NumPy."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from streetgrain.llm import bidiagonal, bpe, codebooks, queries, vectors, whitening

SMALL = "/root/testdata/sf0.001"
VOCABULARY = queries.vocabulary()
ROWS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.load_vocabulary(VOCABULARY))


def texts_of_all_kinds() -> list[str | None]:
    pick = random.Random(3)
    odd = "ab's tredlvm  \n\t1é中'!<|endoftext|>"
    out = [
        None, "", " ", "\n", "a", "it's 's  's\n's 'sabc 'rest ''s don't I'll'll x'S 'l 're", "<|endoftext|>", " <|endoftext|> x<|endoftext|>\n",
        "<|endof", "text|>", "<|endoftext<|endoftext|>", "a" * 3000, " " * 500 + "x", "ab" * 700, "😀👍🏽 ﷽ Ⅷ ½ ٣ 　 x  \x1c\x85",
    ]
    for n in range(600):
        kind = n % 4
        if kind == 0:
            out.append("".join(pick.choice(odd) for _ in range(pick.randrange(40))))
        elif kind == 1:
            out.append("".join(chr(pick.choice([pick.randrange(32, 127), pick.randrange(0x80, 0x3000), pick.randrange(0x1F300, 0x1F700), 32])) for _ in range(60)))
        elif kind == 2:
            out.append("".join(pick.choice("etaoinshrdlu ") for _ in range(pick.randrange(200))))
        else:
            out.append("".join(pick.choice("aab") for _ in range(pick.randrange(90))))
    return out


def wanted(library, texts) -> list[list[int]]:
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


# Tokens

def test_ids_equal_the_library(library, encoder):
    texts = texts_of_all_kinds()
    assert bpe._encoded(encoder, pa.array(texts, pa.string()), False).to_pylist() == wanted(library, texts)


def test_every_character_class_equals_the_library(library, encoder):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    data = "".join(f"a{c}1{c}!{c} {c}{c}\n" for c in chars[:0x3400]).encode()
    words = encoder.pieces(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    pieces = library.pre_tokenizer.pre_tokenize_str(data.decode())
    place = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    assert words.starts.tolist() == place[[s for _, (s, _) in pieces]].tolist()
    kinds = bpe.load_vocabulary(VOCABULARY).classes
    for c in random.Random(1).sample(range(0x3400, 0x110000 - 0x800), 3000):
        for k, mate in ((bpe.LETTER, "a"), (bpe.NUMBER, "1"), (bpe.OTHER, "!")):
            assert (kinds[ord(chars[c])] == k) == (len(library.pre_tokenizer.pre_tokenize_str(mate + chars[c])) == 1)


def test_long_texts_are_cut_without_effect(library, encoder, monkeypatch):
    monkeypatch.setattr(bpe, "STRETCH", 40)
    monkeypatch.setattr(bpe, "TOGETHER", 6)
    monkeypatch.setattr(bpe, "ROWS", 3)
    texts = [*texts_of_all_kinds()[:80], "one two  three don't " * 400, "x" * 500 + " y" * 300]
    assert bpe._encoded(encoder, pa.array(texts, pa.string()), False).to_pylist() == wanted(library, texts)


def test_pairs_tell_what_merging_gives(encoder):
    v = encoder.v
    pick = random.Random(5)
    known = sorted(set(v.ends.tolist()) - {-1})
    pairs = [(pick.choice(known), pick.choice(known)) for _ in range(2000)]
    pairs += [tuple(v.parts[i]) for i in pick.sample(known, 500) if v.rank[i] >= 0]
    got = bpe.compatible(v, *(np.array(x) for x in zip(*pairs, strict=True)))
    want = [bpe.merged(v.names[a] + v.names[b], encoder.ranks, encoder.single) == [a, b] for a, b in pairs]
    assert got.tolist() == want and 0 < sum(want) < len(want)


def test_both_ways_of_merging_agree(encoder):
    pick = random.Random(6)
    words = [bytes(pick.choice(b"aabcde ") for _ in range(pick.randrange(1, 60))) for _ in range(500)] + [bytes([200]), bytes(range(250))]
    assert bpe.merged_together(encoder.v, words) == [bpe.merged(x, encoder.ranks, encoder.single) for x in words]


def test_encode_and_decode_rows(spark, library):
    texts = texts_of_all_kinds()[:40]
    rows = [(i, t, "x", 5) for i, t in enumerate(texts)] + [(None, "same", None, 1), (3, "same", None, 1), (3, "same", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Words string, n_tokens int")
    want = {(r[0], r[1]): ids for r, ids in zip(rows, wanted(library, [r[1] for r in rows]), strict=True)}
    for packed in (False, True):
        out = bpe.decode(bpe.encode(docs, "text", VOCABULARY, packed=packed), "ids", VOCABULARY).collect()
        assert len(out) == len(rows)
        for r in out:
            ids = np.frombuffer(r.ids, "<u4").tolist() if packed else r.ids
            assert ids == want[r.doc_id, r.text] and r.decoded == (r.text or "")
    with pytest.raises(ValueError, match="exists"):
        bpe.encode(docs, "text", VOCABULARY, ids="WORDS")
    assert bpe.encode(docs.limit(0), "text", VOCABULARY).collect() == []


def test_decode_of_odd_ids(spark, library):
    ids = [[], None, [50256, 1, 50256], [10**6, -1, 5], [447], [447, 246, 447]]
    rows = spark.createDataFrame(list(enumerate(ids)), "i int, ids array<int>")
    got = {r.i: r.decoded for r in bpe.decode(rows, "ids", VOCABULARY).collect()}
    assert got == {i: library.decode([x for x in t or [] if 0 <= x < 50257], skip_special_tokens=False) for i, t in enumerate(ids)}


def test_other_vocabularies_are_refused(tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError, match="plain"):
        bpe.load_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_op11_over_a_whole_table(spark, library):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.QUERIES["op11_bpe_round_trip"](spark, SMALL).collect()}
    assert len(got) == len(rows)
    for r, ids in zip(rows, wanted(library, [r.text for r in rows]), strict=True):
        text = library.decode(ids, skip_special_tokens=False)
        assert got[r.doc_id][1:] == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(),
        )


# Vector codes

def plain_codes(rows, parts=4, entries=256, rounds=4):
    """{(id, place): (code, error)}, codebooks; by all distances, in whole numbers."""
    good = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) for c in r[1]] for r in good], object)
    first = sorted((i for i, r in enumerate(good) if r[0] is not None), key=lambda i: (good[i][0], good[i][1]))[:entries]
    out = ["" for _ in good]
    error = [0] * len(good)
    books = []
    for p in range(parts):
        low, high = p * x.shape[1] // parts, (p + 1) * x.shape[1] // parts
        y = x[:, low:high]
        book = [list(y[i]) for i in first]
        for last in [False] * rounds + [True]:
            far = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in book] for v in y]
            code = [f.index(min(f)) for f in far]
            if not last:
                for j in set(code):
                    own = [y[i] for i, c in enumerate(code) if c == j]
                    book[j] = [sum(z) // len(own) for z in zip(*own, strict=True)]
        out = [o + f"{c:02x}" for o, c in zip(out, code, strict=True)]
        error = [e + min(f) for e, f in zip(error, far, strict=True)]
        books.append(book)
    return sorted(zip([r[0] if r[0] is not None else -1 for r in good], out, error, strict=True)), books


def vectors_of_all_kinds(d: int = 8, n: int = 60):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.2, d).astype(np.float32).tolist(), (i % 3) or None) for i in range(n)]
    rows += [(None, rows[3][1], 9), (5, rows[7][1], 1), (100, rows[3][1], 1), rows[4], (101, [0.0] * d, 2), (102, [-1.0, 1.0] * (d // 2), None)]
    odd = [
        (200, None, 1), (201, [None] + [0.0] * (d - 1), 1), (202, [float("nan")] + [0.0] * (d - 1), 1), (203, [float("inf")] * d, 1), (204, [0.5] * (d + 1), 1),
        (205, [], 1),
    ]
    return rows, odd


@pytest.mark.parametrize("entries", [256, 7, 1])
def test_codes_by_all_distances(spark, entries):
    rows, odd = vectors_of_all_kinds()
    df = spark.createDataFrame(rows + odd, ROWS).repartition(3).withColumns({c: F.lit(1) for c in ("v", "code", "l", "error")})
    out, books = codebooks.compress(df, "vec_id", "embedding", "label", entries=entries)
    out = out.collect()
    want, tables = plain_codes(rows, entries=entries)
    assert sorted((r.id if r.id is not None else -1, r.code, r.error) for r in out) == want
    assert [b.tolist() for b in books] == tables
    sums = {}
    for r in out:
        sums[r.label] = sums.get(r.label, 0) + r.error
    assert all(r.label_error == sums[r.label] for r in out)


def test_masks_hold_the_nearest_of_sparse_and_dense_books(monkeypatch):
    monkeypatch.setattr(codebooks, "BLOCK", 7)
    rng = np.random.default_rng(1)
    for k, d, spread in ((256, 16, 1000), (65, 3, 4), (1, 2, 9), (200, 1, 50), (130, 4, 1 << 27)):
        book, rows = rng.integers(-spread, spread + 1, (k, d)), rng.integers(-spread, spread + 1, (100, d))
        far = ((rows[:, None].astype(object) - book[None]) ** 2).sum(2)
        table = codebooks.slices(book)
        code, error = codebooks.nearest(table, rows)
        assert code.tolist() == [f.tolist().index(min(f)) for f in far] and error.tolist() == [min(f) for f in far]
        mask = codebooks.candidates(table, rows, np.full(100, spread // 2))
        bits = np.unpackbits(mask.view(np.uint8), axis=1, bitorder="little", count=k).astype(bool)
        assert (bits == (np.abs(rows[:, None] - book[None]).max(2) <= spread // 2)).all()


def test_clustered_vectors_have_few_candidates():
    rng = np.random.default_rng(2)
    centres = rng.integers(-5000, 5000, (256, 16))
    rows = centres[rng.integers(0, 256, 1000)] + rng.integers(-50, 50, (1000, 16))
    table = codebooks.slices(centres)
    near = np.ceil(np.sqrt(codebooks.distances(rows, centres).min(1))).astype(np.int64)
    mask = codebooks.candidates(table, rows, near)
    assert np.bitwise_count(mask).sum() < 2 * len(rows)


def test_codes_without_rows(spark):
    none = spark.createDataFrame([], ROWS)
    assert codebooks.compress(none, "vec_id", "embedding", "label")[0].collect() == []
    lost = spark.createDataFrame([(None, [1.0, 2.0, 3.0, 4.0], 1), (1, None, 1)], ROWS)
    assert codebooks.compress(lost, "vec_id", "embedding", "label")[0].collect() == []
    assert whitening.whiten(none, "vec_id", "embedding").collect() == []


def test_large_components_stay_exact(spark):
    rows = [(i, [float(np.float32((-1) ** i * 1e5 * i)), 3e38, -3e38, 0.25], 1) for i in range(6)]
    out, _ = codebooks.compress(spark.createDataFrame(rows, ROWS), "vec_id", "embedding", "label", entries=2, rounds=1)
    assert len(out.collect()) == 6


# Whitening

def plain_whitening(rows, d, k=4):
    good = [r for r in rows if r[1] is not None and len(r[1]) == d and all(c is not None and np.isfinite(c) for c in r[1])]
    x = np.floor(256 * np.array([r[1] for r in good], np.float32).astype(np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    c = fit - total / n
    v = c.T @ c / n
    value, axis = np.linalg.eigh(v)
    value, axis = value[::-1][:k], axis[:, ::-1][:, :k]
    return good, n, ((n * x - total) ** 2).sum(1), (x - total / n) @ axis / np.sqrt(value), value / np.trace(v)


def test_whitening_by_eigenvectors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_VALUES", 40)
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rows, odd = vectors_of_all_kinds(8, 80)
    df = spark.createDataFrame(rows + odd, ROWS).repartition(9).withColumns({c: F.lit(1) for c in ("v", "id", "x", "n", "component")})
    out = whitening.whiten(df, "vec_id", "embedding").collect()
    good, n, deviation, white, share = plain_whitening(rows, 8)
    assert len(out) == 4 * len(good) and {r.n for r in out} == {n} and max(r.identity_error for r in out) < 1e-12
    for c in range(4):
        own = sorted((r.id if r.id is not None else -1, r.deviation, r.whitened) for r in out if r.component == c + 1)
        for sign in (1, -1):
            want = sorted(zip([g[0] if g[0] is not None else -1 for g in good], deviation.tolist(), (sign * white[:, c]).tolist(), strict=True))
            if all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-9 for a, b in zip(own, want, strict=True)):
                break
        else:
            pytest.fail(f"component {c + 1}")
        assert all(abs(r.explained - share[c]) < 1e-12 for r in out if r.component == c + 1)


def test_whitening_leaves_out_constant_directions(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [*rng.normal(size=2).tolist(), 0.5, 0.5], 1) for i in range(30)]
    out = whitening.whiten(spark.createDataFrame(rows, ROWS), "vec_id", "embedding").collect()
    assert {r.component for r in out} == {1, 2} and max(r.identity_error for r in out) < 1e-10
    same = spark.createDataFrame([(i, [0.5, 0.25], 1) for i in range(5)], ROWS)
    assert whitening.whiten(same, "vec_id", "embedding").collect() == []


def test_deviation_beyond_a_long_is_null():
    x = np.array([[1 << 28, 0], [3, 4]])
    assert whitening._deviation(x, 10**6, np.array([0, 0], object)) == [None, 25 * 10**12]


@pytest.mark.parametrize("kind", range(8))
def test_singular_values_and_vectors(kind):
    rng = np.random.default_rng(kind)
    for n in (1, 2, 3, 7, 24, 40):
        a = rng.standard_normal((60, n))
        if kind == 1:
            a[:, n // 2] = 0
        elif kind == 2:
            a = np.eye(n) * rng.integers(1, 3, n)
        elif kind == 3:
            a *= 10.0 ** rng.integers(-12, 3, n)
        elif kind == 4:
            a = rng.integers(-2, 3, (n, n)).astype(float)
        elif kind == 5:
            a = np.outer(rng.standard_normal(20), rng.standard_normal(n))
        elif kind == 6:
            a = np.linalg.qr(a)[0]
        elif kind == 7:
            a = np.zeros((n, n))
        want = np.resize(np.append(np.linalg.svd(a, compute_uv=False), np.zeros(n)), n)
        values, axes, sound = bidiagonal.principal(np.linalg.qr(a, mode="r"), 4)
        top = max(want[0], 1e-300)
        assert np.abs(values - want).max() <= 1e-13 * top
        assert np.abs(a.T @ a @ axes - axes * values[:sound] ** 2).max(initial=0) <= 1e-12 * top**2
        assert np.abs(axes.T @ axes - np.eye(sound)).max(initial=0) <= 1e-12
        assert sound == min(4, int((want > n * 2.3e-16 * top).sum())) or kind in (4, 5)


def test_dqds_keeps_small_values_accurate():
    diagonal, upper = np.array([1.0, 1e-4, 1e-8, 1e-12]), np.array([0.5, 3e-5, 2e-9])
    got = bidiagonal.singular_values(diagonal, upper)
    assert got.prod() == pytest.approx(diagonal.prod(), rel=1e-12)


def test_usual_length(spark):
    rows = spark.createDataFrame([([1.0],), ([1.0, 2.0],), ([2.0],), ([1.0, 3.0],), ([],)], "v array<double>")
    assert vectors.usual_length(rows, "v") == 2
