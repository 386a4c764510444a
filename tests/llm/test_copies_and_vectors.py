"""Digest runs, hard negatives and whitening against brute force, and on odd tables."""

from __future__ import annotations

import collections
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from repotide.llm import digest_runs, hard_negatives, whitening
from repotide.llm.common import documents, embeddings, prepare

SF_DIR = "/root/testdata/sf0.001"
LONG = "Long lines go on and on, word by word. " * 30_000
DOCUMENTS = (
    "doc_id long, text string, lang string, source string, digest string, run int, best string,"
    " place long, `a.b` int"
)
VECTORS = "vec_id long, embedding array<float>, label int, id string, x int, `rows` string"


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, SF_DIR).cache()


@pytest.fixture(scope="module")
def odd(spark):
    prepare(spark)
    more = ("x", 1, "y", 5, 2)
    rows = [
        (0, None, None, None), (1, "", "en", "a"), (2, " ", "en", None), (3, LONG, "en", "b"),
        (4, LONG, "en", "b"), (4, LONG, "en", "b"), (4, "one", "fr", "c"), (5, "One", "fr", "c"),
        (None, "one", None, None), (None, "alone", None, None), (None, "alone", "en", None),
        (-7, "one", None, None),
    ]
    return spark.createDataFrame([r + more for r in rows], DOCUMENTS)


@pytest.fixture(scope="module")
def odd_vectors(spark):
    prepare(spark)
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25, 1.0], 1), (100, [0.5, -0.25, 1.0], 1), (100, [0.5, -0.25, 1.0], 1),
        (200, [], 2), (300, [0.5], 1), (None, [0.1, 0.1, 0.1], 1), (1, None, 1), (2, [0.5, None], 1),
        (3, [nan, 0.1], 1), (4, [inf, 0.1], 2), (5, [0.4, -0.25, 0.9], None), (6, [0.25, 0.5, 0.125], 3),
        (8, [0.25, 0.5, 0.125], 3), (8, [0.25, 0.5, 0.125], 3), (9, [-0.0, 0.0, -0.0], 1),
        (400, [0.4, -0.2, 0.9], 1), (7, [0.5, -0.25, 1.0], 0), (-100, [0.3, 0.1], 2),
    ]
    return spark.createDataFrame([(*r, "i", 3, "r") for r in rows], VECTORS)


# --- exact copies ---------------------------------------------------------------

def copies_by_hand(rows, largest=True, normalise=lambda t: t):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[normalise(r["text"] or "")].append(r["doc_id"])
    out = collections.Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max(known) if largest else min(known)) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in ids:
            out[i, keep, len(ids), i == keep and first, sha] += 1
            first = first and i != keep
    return out


def as_counted(found):
    return collections.Counter(
        (r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in found.collect()
    )


@pytest.mark.parametrize("largest", [True, False])
@pytest.mark.parametrize("rows_per_run", [1 << 20, 2])
def test_copies_match_groups(spark, docs, odd, largest, rows_per_run):
    assert digest_runs.rounds_for(200, 1 << 20) == 2
    assert digest_runs.rounds_for(10_000, 2) == 4
    for table in (docs, odd):
        found = digest_runs.copies(table, largest, rows_per_run=rows_per_run)
        assert as_counted(found) == copies_by_hand(table.collect(), largest)


def test_copies_of_normalised_texts(odd):
    found = digest_runs.copies(odd, normalise=lambda t: F.lower(F.trim(t)))
    assert as_counted(found) == copies_by_hand(odd.collect(), normalise=lambda t: t.strip(" ").lower())


def test_no_copies_in_an_empty_table(spark, odd):
    assert digest_runs.copies(odd.limit(0)).collect() == []
    assert digest_runs.keep_one(odd.limit(0)).collect() == []


def test_one_row_of_each_text_stays(docs, odd):
    for table in (docs, odd):
        left = digest_runs.keep_one(table)
        assert left.columns == table.columns
        kept = [(r["doc_id"], r["text"] or "") for r in left.collect()]
        wanted = {k for k in copies_by_hand(table.collect()) if k[3]}
        shas = collections.Counter((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in kept)
        assert shas == collections.Counter((k[0], k[4]) for k in wanted)


def test_a_text_of_a_third_of_all_rows_is_spread_over_the_runs(spark):
    table = spark.range(0, 60_000, 1, 24).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"),
    )
    found = digest_runs.copies(table)
    hot = found.filter("group_size > 1")
    assert hot.agg(F.count("*"), F.min("group_size"), F.min("keep_id"), F.sum(F.col("kept").cast("int"))).first()[
        :
    ] == (20_000, 20_000, 59_997, 1)
    assert found.count() == 60_000


def test_copies_run_without_python(docs):
    plan = digest_runs.copies(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


# --- hard negatives ---------------------------------------------------------------

def whole(vector):
    return [math.floor(256 * c) for c in vector]


def mined_by_hand(rows, every=100, positives=5, negatives=10, low=30, high=90):
    """Rows are (id, label, integers); dots of Python integers."""
    def dot(a, b):
        return sum(p * q for p, q in zip(a, b))

    out = collections.Counter()
    for a, label, x in sorted({(i, k, tuple(v)) for i, k, v in rows if i % every == 0}):
        others = [(i, k, dot(x, v)) for i, k, v in rows if i != a]
        own = sorted(((-s, i) for i, k, s in others if k == label))[:positives]
        for value, p in own:
            near = sorted(
                (-s, i) for i, k, s in others if k != label and low * -value <= 100 * s <= high * -value
            )
            for rank, (s, n) in enumerate(near[:negatives], 1):
                out[a, p, rank, n, -value, -s] += 1
    return out


def as_rows(table):
    out = []
    for r in table.collect():
        v, label = r["embedding"], r["label"]
        if r["vec_id"] is None or label is None or v is None:
            continue
        if any(c is None or not math.isfinite(c) for c in v):
            continue
        if r["vec_id"] % 7 == 0:
            label = (label + 1) % 10
        out.append((r["vec_id"], label, whole(v)))
    return out


def mined(found):
    return collections.Counter(tuple(r) for r in found.collect())


@pytest.mark.parametrize("wave", [None, 2])
def test_negatives_match_all_products(spark, odd_vectors, wave):
    for table in (embeddings(spark, SF_DIR), odd_vectors):
        found = hard_negatives.mine(
            hard_negatives.from_embeddings(table), F.col("id") % 100 == 0, wave=wave
        )
        assert found.columns == [
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        ]
        wanted = mined_by_hand(as_rows(table))
        assert mined(found) == wanted and wanted


def test_many_anchors_blocks_and_ties(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "_CHUNK", 50)
    monkeypatch.setattr(hard_negatives, "_ANCHORS", 16)
    monkeypatch.setattr(hard_negatives, "_PART", 8)
    random = np.random.default_rng(3)
    rows = [
        (int(i), int(random.integers(0, 4)), random.integers(-3, 4, 11).tolist()) for i in range(400)
    ]
    table = spark.createDataFrame(rows, "id long, label long, x array<long>").repartition(7)
    found = hard_negatives.mine(table, F.col("id") % 5 == 0, 3, 4, 20, 95)
    assert mined(found) == mined_by_hand(rows, 5, 3, 4, 20, 95)


def test_no_anchor_and_no_rows(spark, odd_vectors):
    rows = hard_negatives.from_embeddings(odd_vectors)
    assert hard_negatives.mine(rows.limit(0), F.col("id") % 100 == 0).collect() == []
    assert hard_negatives.mine(rows, F.lit(False)).collect() == []


@pytest.mark.parametrize("least, most", [(0, 0), (-1, 0), (0, 1), (-4, 3), (-300, 299), (-(1 << 20), 1 << 20)])
def test_lookups_give_exact_products(least, most):
    random = np.random.default_rng(5)
    shape = hard_negatives._Shape(13, least, most)
    x = np.zeros((70, shape.width), np.int64)
    x[:, :13] = random.integers(least, most + 1, (70, 13))
    x[0, :13], x[1, :13] = least, most
    table = hard_negatives.subset_sums(x[:9], shape.kind)
    assert (hard_negatives.scores(table, hard_negatives.bit_planes(x, shape.planes)) == x @ x[:9].T).all()


def test_products_beyond_a_long_are_refused():
    with pytest.raises(ArithmeticError):
        hard_negatives._Shape(64, -(1 << 40), 1 << 40)


def test_tables_of_a_wave_are_bounded():
    for width, most in ((64, 100), (1024, 100), (4096, 1 << 15)):
        shape = hard_negatives._Shape(width, -most, most)
        size = shape.wave() * shape.width // 8 * 256 * np.dtype(shape.kind).itemsize
        assert size <= max(hard_negatives.TABLE_BYTES, hard_negatives._PART * shape.width * 256)


# --- whitening ---------------------------------------------------------------------

def whitened_by_hand(table):
    rows = [
        (r["vec_id"], whole(r["embedding"])) for r in table.collect()
        if r["embedding"] is not None and all(c is not None and math.isfinite(c) for c in r["embedding"])
    ]
    width = max(len(v) for _, v in rows)
    x = np.array([v + [0] * (width - len(v)) for _, v in rows], np.int64)
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(fit))
    return [i for i, _ in rows], x, fit, values[::-1], vectors[:, ::-1]


def test_whitening_matches_eigenvectors(spark, odd_vectors):
    for table in (embeddings(spark, SF_DIR), odd_vectors):
        ids, x, fit, values, vectors = whitened_by_hand(table)
        found = whitening.whitened(table).collect()
        kept = int((values[:4] > 1e-9 * values[0]).sum())
        assert len(found) == kept * len(ids)
        mine = collections.defaultdict(list)
        for r in found:
            mine[r["vec_id"], r["component"]].append(r)
        deviation = ((len(fit) * x - fit.sum(0)) ** 2).sum(1)
        for k in range(kept):
            project = (x - fit.mean(0)) @ vectors[:, k] / math.sqrt(values[k])
            own, true = [], []
            for i in dict.fromkeys(ids):
                group = sorted((r["deviation"], abs(r["whitened"])) for r in mine[i, k + 1])
                hand = sorted((int(deviation[j]), abs(project[j])) for j in range(len(ids)) if ids[j] == i)
                assert [d for d, _ in group] == [d for d, _ in hand]
                own += [w for _, w in group]
                true += [w for _, w in hand]
            assert np.allclose(own, true, rtol=0, atol=1e-9)
            for r in mine[ids[0], k + 1]:
                assert r["n"] == len(fit) and r["deviation_exact"] == r["deviation"]
                assert abs(r["explained"] / (values[k] / values.sum()) - 1) < 1e-9
                assert r["identity_error"] < 1e-9


def test_sign_and_errors_are_the_same_for_all_rows(spark):
    table = embeddings(spark, SF_DIR)
    _, _, fit, values, vectors = whitened_by_hand(table)
    rows = whitening.from_embeddings(table)
    model = whitening.fit(rows)
    for k in range(4):
        assert abs(abs(model.components[:, k] @ vectors[:, k]) - 1) < 1e-12
    assert np.allclose(model.values, values[:4], rtol=1e-12)
    w = model.project(fit)
    assert np.abs((w.T @ w) / len(fit) - np.eye(4)).max() < 1e-10


def steps(matrix):
    def step(c):
        u = matrix @ c
        return np.append(matrix.T @ u, u @ u)

    return step


@pytest.mark.parametrize("shape", ["plain", "repeated", "low rank", "zero", "steep", "one row"])
def test_bidiagonalisation_finds_all_singular_values(shape):
    random = np.random.default_rng(1)
    q = np.linalg.qr(random.standard_normal((50, 12)))[0]
    p = np.linalg.qr(random.standard_normal((12, 12)))[0]
    spread = {
        "plain": np.arange(12, 0, -1.0), "repeated": np.array([5.0] * 6 + [2.0] * 6),
        "low rank": np.array([4.0, 3, 3] + [0.0] * 9), "zero": np.zeros(12),
        "steep": 10.0 ** -np.arange(12), "one row": np.array([1.0] + [0.0] * 11),
    }[shape]
    matrix = (q * spread) @ p.T
    right, values = whitening.bidiagonalise(steps(matrix), 12, 4)
    assert np.allclose(values, spread, rtol=0, atol=1e-13 * max(spread[0], 1))
    assert np.allclose(right.T @ right, np.eye(12), atol=1e-13)
    for k in range(4):
        if spread[k]:
            assert np.linalg.norm(matrix.T @ (matrix @ right[:, k]) - spread[k] ** 2 * right[:, k]) < 1e-12 * spread[0] ** 2


def test_wide_vectors_stop_when_the_wanted_ones_are_found():
    random = np.random.default_rng(2)
    width = whitening.ALL_STEPS + 44
    matrix = random.standard_normal((900, width)) * 0.9 ** np.arange(width)
    calls = []
    inner = steps(matrix)
    right, values = whitening.bidiagonalise(lambda c: (calls.append(1), inner(c))[1], width, 4)
    _, true, vectors = np.linalg.svd(matrix, full_matrices=False)
    assert len(calls) < width
    assert np.allclose(values[:4], true[:4], rtol=1e-13)
    assert np.allclose(np.abs((right[:, :4] * vectors[:4].T).sum(0)), 1, atol=1e-12)


def test_deviations_beyond_a_long(spark):
    x = np.array([[1 << 30, -(1 << 30)], [5, 7]], np.int64)
    sums = np.array([1 << 40, 3], np.int64)
    by_hand = [sum((10**9 * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
    assert whitening.deviations(x, 10**9, sums) == by_hand
    model = whitening.Whitening(10**9, sums, np.eye(2), np.ones(2), 2.0, 0.0)
    table = spark.createDataFrame([(1, x[0].tolist()), (2, x[1].tolist())], "id long, x array<long>")
    for r in whitening.whiten(table, model).collect():
        exact = by_hand[r["vec_id"] - 1]
        assert int(r["deviation_exact"]) == exact
        assert r["deviation"] == (exact if exact < 1 << 63 else None)


def test_nothing_to_whiten(spark, odd_vectors):
    alike = odd_vectors.filter("vec_id IN (0, 100)")
    for table in (odd_vectors.limit(0), odd_vectors.filter("vec_id = 200"), alike):
        assert whitening.whitened(table).collect() == []
