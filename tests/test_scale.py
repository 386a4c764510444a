"""How often inputs are worked out and rows are moved."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import types as T

from repotide import bindings as b
from repotide.operators.ordering import dense_ids, range_chunks
from repotide.session import pinned
from repotide.sources.tables import unseen_rows
from repotide.warehouse import Warehouse

DAY = dt.datetime(2024, 1, 1)
REVISIONS = (
    "repo long, ordinal long, author string, author_email string, co_author_emails array<string>, commit_hash string,"
    " authored_datetime timestamp, committed_datetime timestamp, committer string, committer_email string,"
    " encoding string, message string, gpgsign string, parents array<string>"
)
ITEM = "repo long, page long, pos long, issue_id string, created_at timestamp, closed_at timestamp"
FILE = "repo long, commit_hash_id long, provider string, lines long"


@pytest.fixture
def moving(spark):
    """Joins move rows, as they do with tables too large to be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _counted(spark, df):
    """``df`` and a counter of the rows that were worked out for it."""
    rows = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            rows.add(len(batch))
            yield batch

    return df.mapInPandas(count, df.schema), rows


def _house(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "tables"), {"repo": T.LongType()}, "2024-01-31")


def _moves(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _commit(number):
    mail = f"a{number % 2}@x"
    return (1, number, "a", mail, [], f"h{number}", DAY, DAY, "a", mail, "UTF-8", "", None, [f"h{number - 1}"])


def test_a_load_of_the_log_works_its_input_out_once(spark, tmp_path):
    house = _house(spark, tmp_path)
    tags = spark.createDataFrame([(1, "v1", "h1")], "repo long, tag string, commit_hash string")
    for load, numbers in enumerate(([0, 1, 1, 2], [2, 3, 4])):
        revisions, rows = _counted(spark, spark.createDataFrame([_commit(n) for n in numbers], REVISIONS))
        house.load_log(revisions, tags, ["ordinal"])
        assert rows.value == len(numbers), load
    hashes = {r["commit_hash"]: r["id"] for r in house.read("commit_hashes").collect()}
    assert hashes == {f"h{n}": n for n in range(5)}
    assert house.read("commit_logs").count() == 5


def test_a_load_of_items_works_its_input_out_once(spark, tmp_path):
    house = _house(spark, tmp_path)
    later = DAY + dt.timedelta(days=1)
    loads = [
        [(1, 0, 0, "a", DAY, None), (1, 0, 1, "b", DAY, None), (1, 1, 0, "a", DAY, later)],
        [(2, 0, 0, "a", DAY, None), (1, 2, 0, "b", DAY, later), (1, 2, 1, "c", DAY, None)],
    ]
    for load in loads:
        items, rows = _counted(spark, spark.createDataFrame(load, ITEM).coalesce(1))
        house.load_issues(items)
        assert rows.value == len(load)
    ids = {(r["repo"], r["issue_id"]): r["id"] for r in house.read("issue_ids").collect()}
    assert ids == {(1, "a"): 0, (1, "b"): 1, (1, "c"): 2, (2, "a"): 0}
    facts = sorted((r["repo"], r["issue_id_key"], r["closed_at"]) for r in house.read("issues").collect() if r["closed_at"])
    assert facts == [(1, 0, later), (1, 1, later)]
    assert house.read("issues").count() == 4


def test_items_of_no_repository_fail_the_load(spark, tmp_path):
    house = _house(spark, tmp_path)
    with pytest.raises(Exception, match="null"):
        house.load_issues(spark.createDataFrame([(None, 0, 0, "a", DAY, None)], ITEM))


def test_files_meet_the_stored_ones_in_one_move(spark, moving):
    stored = spark.createDataFrame([(1, 0, "a", 1), (1, 0, "b", 2)], FILE)
    batch = spark.createDataFrame([(1, 0, "a", 1), (1, 1, "a", 3), (1, 1, "a", 3)], FILE)
    keys = ["repo", "commit_hash_id", "provider"]
    fresh = unseen_rows(batch, stored, keys, "provider")
    assert _moves(fresh) == 1
    assert [tuple(r) for r in fresh.collect()] == [(1, 1, "a", 3)]
    for other in ([(1, 0, "a", 9)], [(1, 5, "a", 1), (1, 5, "a", 2)]):
        with pytest.raises(Exception, match="measured otherwise before: a|several values .*: a"):
            unseen_rows(spark.createDataFrame(other, FILE), stored, keys, "provider").collect()


def _tables(spark, tmp_path):
    orders = [(n, 1 + n % 3, "O", 1.0, dt.datetime(1996 + n % 4, 1, 1), "1-URGENT") for n in range(40)]
    lines = [(n, p, 1, 1, 2.0, 3.0, 0.0, 0.0, "AN"[p % 2], "F", DAY) for n in range(40) for p in (1, 2, 2)]
    customer = [(n, f"c{n}", n % 2, 0.0, "m") for n in range(1, 4)]
    for name, rows in (("orders", orders), ("lineitem", lines), ("customer", customer)):
        spark.createDataFrame(rows, b.GIVEN[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_files_of_commits_are_summed_where_the_join_left_them(spark, tmp_path, moving):
    files = b.order_files(spark, _tables(spark, tmp_path))
    assert files.count() == 80
    assert _moves(files) == 4  # customers, orders by customer, log and files by commit
    early = b.order_files(spark, str(tmp_path), before="1998-01-01")
    log = b.order_revisions(spark, str(tmp_path)).filter("day < '1998-01-01'")
    semi = files.join(log, ["repo", "commit_hash"], "left_semi")
    assert sorted(early.collect()) == sorted(semi.collect())


def test_pinned_tables_know_their_size(spark):
    small = pinned(spark.range(10).selectExpr("id % 3 AS g").groupBy("g").count())
    plan = spark.range(10).selectExpr("id % 3 AS g").join(small, "g")
    assert _moves(plan) == 0
    odd = pinned(spark.range(2).selectExpr("id", "NULL AS nothing"))
    assert odd.columns == ["id", "nothing"] and odd.count() == 2


def test_numbering_moves_rows_only_into_ranges(spark, many_ranges):
    numbered = dense_ids(range_chunks(spark.range(100).selectExpr("id AS t", "id % 2 AS g"), ["t"], ["g"]), ["g"])
    assert _moves(numbered) == 0
    assert sorted(r["id"] for r in numbered.collect()) == sorted([*range(50), *range(50)])


def test_a_landing_is_written_by_all_tasks(spark, tmp_path):
    rows = spark.range(0, 80, 1, 8).selectExpr("id", "timestamp'1998-05-01' AS at")
    for landing in b.LANDINGS:
        b.land_between(rows, "at", landing, str(tmp_path / "landed"))
    assert len(list(Path(tmp_path / "landed").glob("part-*"))) >= 8
    assert spark.read.parquet(str(tmp_path / "landed")).count() == 80
