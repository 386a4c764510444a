"""Loads keep what is stored: other repositories, ids, and what a broken run left."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.operators.quality import require, violations
from repotide.sources.tables import append_new_keys
from repotide.warehouse import Warehouse

DAY = datetime.datetime(2024, 1, 1)
BY = {"repo": T.LongType()}
ITEM = "repo long, page long, pos int, issue_id string, created_at timestamp, closed_at timestamp"
REVISION = (
    "repo long, seq long, author string, author_email string, co_author_emails array<string>,"
    " commit_hash string, authored_datetime timestamp, committed_datetime timestamp,"
    " committer string, committer_email string, encoding string, message string, gpgsign string,"
    " parents array<string>"
)


def revision(repo, seq, commit):
    return (repo, seq, "a", "a@x", [], commit, DAY, DAY, "c", "c@x", "UTF-8", "m", None, [])


@pytest.fixture
def house(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "house"), by=BY)


def test_issues_of_other_repositories_stay(spark, house):
    house.load_issues(spark.createDataFrame([(1, 0, 0, "a", DAY, None), (1, 0, 1, "b", DAY, None)], ITEM))
    first = {(r["repo"], r["issue_id"]): r["id"] for r in house.read("issue_ids").collect()}
    closed = DAY + datetime.timedelta(days=2)
    house.load_issues(
        spark.createDataFrame([(2, 0, 0, "a", DAY, None), (1, 0, 0, "b", DAY, closed), (1, 1, 0, "c", DAY, None)], ITEM)
    )
    ids = {(r["repo"], r["issue_id"]): r["id"] for r in house.read("issue_ids").collect()}
    assert len(ids) == 4 and first.items() <= ids.items()
    facts = {(r["repo"], r["issue_id_key"]): r["closed_at"] for r in house.read("issues").collect()}
    assert facts == {k: None for k in [(2, ids[2, "a"]), (1, ids[1, "a"]), (1, ids[1, "c"])]} | {(1, ids[1, "b"]): closed}


def test_load_broken_between_ids_and_facts(spark, house, monkeypatch):
    one = spark.createDataFrame([(1, 0, 0, "a", DAY, None)], ITEM)
    two = spark.createDataFrame([(1, 0, 0, "b", DAY, None), (1, 0, 1, "a", DAY, None)], ITEM)
    house.load_issues(one)
    with monkeypatch.context() as patch:
        patch.setattr(house, "_replace", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            house.load_issues(two)
    assert house.read("issues").count() == 1
    house.load_issues(two)
    assert sorted(r["id"] for r in house.read("issue_ids").collect()) == [0, 1]
    assert house.read("issues").count() == 2


def test_replacement_broken_before_the_names_change(spark, house):
    house.load_issues(spark.createDataFrame([(1, 0, 0, "a", DAY, None)], ITEM))
    place, files = house._files(house._path("issues"))
    files.rename(place, house._files(house._path("issues") + ".next")[0])
    assert house.read("issues").count() == 1


def test_releases_of_other_repositories_stay(spark, house):
    tag = "repo long, tag string, commit_hash string"
    house.load_log(spark.createDataFrame([revision(1, 0, "x")], REVISION), spark.createDataFrame([(1, "v", "x")], tag), ["seq"])
    house.load_log(spark.createDataFrame([revision(2, 0, "x")], REVISION), spark.createDataFrame([(2, "v", "x")], tag), ["seq"])
    assert sorted(r["repo"] for r in house.read("releases").collect()) == [1, 2]
    assert house.sql("SELECT count(*) FROM commit_logs").first()[0] == 2


def test_repeated_records_count_once(spark, house):
    rows = [revision(1, 0, "x"), revision(1, 1, "y"), revision(1, 2, "x"), revision(1, 0, "x")]
    house.load_log(
        spark.createDataFrame(rows, REVISION),
        spark.createDataFrame([], "repo long, tag string, commit_hash string"), ["seq"],
    )
    assert house.read("commit_logs").count() == house.read("commit_hashes").count() == 2
    files = spark.createDataFrame(
        [(1, "x", "C", "p", 1, 1, 0, 0, 9)] * 2,
        "repo long, commit_hash string, language string, provider string, lines long, code long,"
        " comments long, blanks long, bytes long",
    )
    house.load_file_sizes(files)
    house.load_file_sizes(files)
    assert house.read("file_size_per_commit").count() == 1


def test_reads_push_filters_down(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "parts"), by=BY, partition_by=["repo"])
    house.load_issues(spark.createDataFrame([(1, 0, 0, "a", DAY, None)], ITEM))
    plan = house.read("issues").filter("repo = 1 AND issue_id_key < 5")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(repo" in plan and "LessThan(issue_id_key,5)" in plan


@pytest.mark.parametrize(
    "sql, kind, rule",
    [
        ("'9999999999999999999999'", T.LongType(), "type"),
        ("CAST('1000000000000000000000000' AS decimal(38,0))", T.LongType(), "type"),
        ("CAST('1e30' AS double)", T.LongType(), "type"),
        ("CAST(1.5 AS decimal(3,1))", T.LongType(), "fraction"),
        (
            "array(named_struct('k', 'x'))",
            T.ArrayType(T.StructType([T.StructField("k", T.LongType())])), "type",
        ),
    ],
)
def test_values_a_cast_would_lose_are_reported(spark, sql, kind, rule):
    rows = spark.range(1).select("id", F.expr(sql).alias("v"))
    model = T.StructType([T.StructField("v", kind, True)])
    assert [r["rule"] for r in violations(rows, model, ["id"]).collect()] == [rule]
    with pytest.raises(Exception, match="breaks rule"):
        require(rows, model).collect()


def test_whole_numbers_as_text_are_kept(spark):
    rows = spark.createDataFrame([("12.0",), ("-7",), (str((1 << 63) - 1),), (None,)], "v string")
    model = T.StructType([T.StructField("v", T.LongType(), True)])
    assert [r["v"] for r in require(rows, model).collect()] == [12, -7, (1 << 63) - 1, None]


def test_append_creates_its_table(spark, tmp_path):
    path = str(tmp_path / "new")
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    assert append_new_keys(batch, path, ["k"])
    assert append_new_keys(batch, path, ["k"]) and spark.read.parquet(path).count() == 2
    assert not append_new_keys(batch, path, ["k"], whole_batch=True)
