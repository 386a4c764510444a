"""Predecessors and ids across range borders against a plain Python loop."""

from __future__ import annotations

import random

import pytest

from repotide.operators.keys import dimension, lookup, lookup_list, orphans, without_known
from repotide.operators.ordering import CHUNK, dense_ids, id_chunks, range_chunks, with_previous


def skewed(n=4000, seed=3):
    """A third of the rows in one group, many groups of a few rows, some nulls."""
    rng = random.Random(seed)
    rows = []
    for place in range(n):
        group = "hot" if rng.random() < 0.34 else f"g{rng.randrange(200)}"
        rows.append((group, rng.randrange(50), place, rng.choice([None, rng.randrange(100)])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("by", [["g"], []])
def test_previous_and_ids(spark, many_ranges, by):
    rows = skewed()
    df = spark.createDataFrame(rows, "g string, t long, seq long, v long").repartition(5)
    chunked = range_chunks(df, ["t", "seq"], by)
    assert chunked.select(CHUNK).distinct().count() > 1
    last, count, want = {}, {}, {}
    for g, t, seq, v in sorted(rows, key=lambda r: (r[0] if by else "", r[1], r[2])):
        key = g if by else ""
        want[seq] = (last.get(key), count.get(key, 0))
        last[key] = v
        count[key] = count.get(key, 0) + 1
    previous = {r.seq: r.previous_v for r in with_previous(chunked, ["v"], by).collect()}
    numbered = dense_ids(chunked, by)
    assert numbered.columns == ["id", "g", "t", "seq", "v"]
    ids = {r.seq: r.id for r in numbered.collect()}
    assert {seq: (previous[seq], ids[seq]) for seq in want} == want
    assert len(ids) == len(previous) == len(rows)


@pytest.mark.parametrize("rows_per_range", [1, 7, 1000])
@pytest.mark.parametrize("by", [["g"], []])
def test_previous_along_a_dense_id(spark, by, rows_per_range):
    """Gaps, such as commits without files, may empty whole ranges."""
    rng = random.Random(8)
    rows = [(g, i, rng.randrange(50)) for g in ("hot", "b", "c") for i in range(300) if rng.random() < 0.2]
    rows = rows if by else [(g, k, v) for k, (g, _, v) in enumerate(rows)]
    df = spark.createDataFrame(rows, "g string, id long, v long").repartition(3)
    got = with_previous(id_chunks(df, "id", rows_per_range), ["v"], by)
    want, last = {}, {}
    for g, i, v in sorted(rows, key=lambda r: (r[0] if by else "", r[1])):
        want[g, i] = last.get(g if by else "")
        last[g if by else ""] = v
    assert {(r.g, r.id): r.previous_v for r in got.collect()} == want


def test_hot_group_is_cut_into_many_ranges(spark, many_ranges):
    df = spark.range(20000).selectExpr("'only' AS g", "id")
    sizes = [r["count"] for r in range_chunks(df, ["id"], ["g"]).groupBy(CHUNK).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 20000 / 2


def test_empty_input(spark):
    empty = spark.createDataFrame([], "g string, t long, v long")
    chunked = range_chunks(empty, ["t"], ["g"])
    assert with_previous(chunked, ["v"], ["g"]).count() == 0
    assert dense_ids(chunked, ["g"]).count() == 0


REVISIONS = [(0, "h0", "Ann", "a@x"), (1, "h1", "Bob", "b@x"), (2, "h2", "Anna", "a@x"), (3, "h3", "?", None),
             (4, "h4", "??", None)]


def people(spark, rows=REVISIONS):
    return spark.createDataFrame(rows, "seq long, commit_hash string, author string, author_email string")


def test_first_name_wins_and_null_is_one_group(spark, spread):
    dim = dimension(spread(people(spark)), "author_email", ["author"], ["seq"])
    assert sorted(map(tuple, dim.collect())) == [(0, "Ann", "a@x"), (1, "Bob", "b@x"), (2, "?", None)]


@pytest.mark.parametrize("cuts", [(1,), (2, 3), (1, 2, 3, 4)])
def test_dimension_in_parts_equals_one_load(spark, cuts):
    stored = None
    for end in (*cuts, len(REVISIONS)):
        stored = dimension(people(spark, REVISIONS[:end]), "author_email", ["author"], ["seq"], stored=stored)
    whole = dimension(people(spark), "author_email", ["author"], ["seq"])
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, whole.collect()))


def test_new_ids_continue_per_repository(spark):
    schema = "repo long, id long, name string, email string"
    stored = spark.createDataFrame([(1, 0, "A", "a"), (1, 1, "B", "b"), (2, 0, "A", "a")], schema)
    rows = [(1, 0, "C", "c"), (2, 1, "B", "b"), (2, 2, "C", "c"), (3, 3, "A", "a"), (1, 4, "A", "a")]
    raw = spark.createDataFrame(rows, "repo long, seq long, name string, email string")
    dim = dimension(raw, "email", ["name"], ["seq"], ["repo"], stored)
    got = sorted((r.repo, r.id, r.email) for r in dim.collect())
    assert got == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (2, 0, "a"), (2, 1, "b"), (2, 2, "c"), (3, 0, "a")]


def test_lookup_unknown_null_and_repeated(spark):
    dim = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a"), (3, None)], "id long, email string")
    facts = spark.createDataFrame([("a",), ("b",), ("zz",), (None,)], "who string")
    got = {r.who: r.ref for r in lookup(facts, "who", dim, "email", "ref").collect()}
    assert got == {"a": 2, "b": 1, "zz": None, None: 3}


def test_lookup_list_keeps_order_and_marks_empty(spark, spread):
    dim = spark.createDataFrame([(0, "a"), (1, "b"), (7, None)], "id long, email string")
    rows = [(1, []), (2, ["b", "zz", "a", "b"]), (3, None), (4, [None, "a"])]
    facts = spread(spark.createDataFrame(rows, "k long, who array<string>"))
    result = lookup_list(facts, ["k"], "who", dim, "email", "refs")
    got = {r.k: [entry.email for entry in r.refs] for r in result.collect()}
    assert got == {1: [None], 2: [1, None, 0, 1], 3: [None], 4: [7, 0]}


def test_without_known_treats_null_as_a_value(spark):
    have = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    known = spark.createDataFrame([(None,), ("b",)], "k string")
    assert [r.k for r in without_known(have, known, ["k"]).collect()] == ["a"]


def test_orphans_in_both_directions(spark):
    files = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,)], "commit_id long")
    log = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    assert [r.commit_id for r in orphans(files, "commit_id", log, "id").collect()] == [9]
    assert [r.id for r in orphans(log, "id", files, "commit_id").collect()] == [3]
