"""What landing and loading move, sort and write, and that rows come out as before."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide import bindings as b
from repotide.plans import log
from repotide.schemas import MEASURES
from repotide.session import pinned
from repotide.sources.sizes import read_file_sizes
from repotide.sources.tables import unseen_rows
from repotide.warehouse import Warehouse

DAY = dt.datetime(1996, 5, 1)
FILE = f"repo long, commit_hash string, language string, provider string, {', '.join(f'{m} long' for m in MEASURES)}"


@pytest.fixture
def moving(spark):
    """No table is small enough to be broadcast."""
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(name, "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(name)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _file(repo, commit, provider, lines=1):
    return (repo, commit, "A", provider, lines, 1, 1, 1, 1)


@pytest.fixture
def house(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"), by={"repo": T.LongType()})
    hashes = spark.createDataFrame([(0, "a"), (1, "b")], "id long, commit_hash string")
    house._append("commit_hashes", hashes.crossJoin(spark.createDataFrame([(1,), (2,)], "repo long")))
    return house


def test_landed_files_are_moved_and_sorted_once_for_ids_and_repeats(spark, house, moving):
    rows = [_file(1, "a", "x"), _file(1, "a", "x"), _file(1, "b", "x"), _file(2, "a", "x", 7)]
    files = house._with_ids(spark.createDataFrame(rows, FILE))
    keys = ["repo", "commit_hash_id", "provider"]
    fresh = unseen_rows(files, None, [*keys, "commit_hash"], "provider", keys)
    assert _plan(fresh).count("Exchange ") == 2  # files and hashes; one more before
    house.load_file_sizes(spark.createDataFrame(rows, FILE))
    got = sorted((r["repo"], r["commit_hash_id"], r["lines"]) for r in house.read("file_size_per_commit").collect())
    assert got == [(1, 0, 1), (1, 1, 1), (2, 0, 7)]


def test_first_load_of_files_keeps_its_checks(spark, house):
    load = lambda *rows: house.load_file_sizes(spark.createDataFrame(rows, FILE))
    with pytest.raises(Exception, match="several values for repo, commit_hash_id, provider, provider: x"):
        load(_file(1, "a", "x"), _file(1, "a", "x", 2))
    with pytest.raises(Exception, match="column commit_hash_id breaks rule null"):
        load(_file(1, "lost", "x"))
    with pytest.raises(Exception, match="column commit_hash_id breaks rule null"):
        load(_file(1, None, "x"))
    load(_file(1, "a", "x"), _file(1, "a", "y"))
    load(_file(1, "a", "x"), _file(1, "b", "x"))
    assert house.read("file_size_per_commit").count() == 3
    with pytest.raises(Exception, match="measured otherwise before: y"):
        load(_file(1, "a", "y", 5))


def test_compared_files_are_sorted_once(spark, moving):
    kinds = "repo long, commit_hash_id long, provider string, lines long"
    stored = spark.createDataFrame([(1, 0, "a", 1), (1, 0, None, 2)], kinds)
    batch = spark.createDataFrame(
        [(1, 0, "a", 1), (1, 0, "a", 1), (1, 0, None, 2), (1, None, "a", None), (1, None, "a", None)], kinds
    )
    fresh = unseen_rows(batch, stored, ["repo", "commit_hash_id", "provider"], "provider")
    assert "Aggregate" not in _plan(fresh) and _plan(fresh).count("Sort ") == 1
    assert [tuple(r) for r in fresh.collect()] == [(1, None, "a", None)]
    ordered = fresh.sortWithinPartitions("repo", "commit_hash_id")
    assert _plan(ordered).count("Sort ") == 1


def test_commits_without_references_are_not_moved_for_them(spark, moving):
    schema = (
        "repo long, commit_hash string, author_email string, committer_email string,"
        " co_author_emails array<string>, parents array<string>, message string"
    )
    rows = [
        (1, "a", "x", "y", [], [], "m"), (1, "b", "x", "lost", None, ["a"], "n"), (2, "a", "x", "y", ["x", "q"], ["lost"], "o"),
    ]
    revisions = spark.createDataFrame(rows, schema)
    ids = [
        spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "a")], "repo long, id long, commit_hash string"),
        spark.createDataFrame([(1, 0, "x"), (2, 0, "x")], "repo long, id long, author_email string"),
        spark.createDataFrame([(1, 0, "y"), (2, 0, "y")], "repo long, id long, committer_email string"),
    ]
    whole = log.commit_logs(revisions, *ids, ["repo"])
    fewer = log.commit_logs(revisions, *ids, ["repo"], distinct=True)
    assert fewer.schema == whole.schema
    assert sorted(map(str, fewer.collect())) == sorted(map(str, whole.collect())) and whole.count() == 3
    assert _plan(whole).count("Union") - _plan(fewer).count("Union") == 2


def _tables(spark, path):
    orders = [(n, 1 + n % 2, "O", 1.0, DAY + dt.timedelta(days=n), "1-URGENT") for n in [*range(9), 3]]
    lines = [(n, p, 1, 2, 2.0, 3.5, 0.1, 0.2, x, "F", DAY) for n in range(9) for p in (1, 2) for x in "NA"]
    lines.append((None, 1, 1, 2, 2.0, 3.5, 0.1, 0.2, "N", "F", DAY))
    customer = [(n, f"c{n}", n, 0.0, "m") for n in (1, 2)]
    for name, rows in (("orders", orders), ("lineitem", lines), ("customer", customer)):
        kinds = T.StructType([T.StructField(f.name, f.dataType) for f in b.GIVEN[name].fields])
        spark.createDataFrame(rows, kinds).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_files_are_summed_as_their_join_with_the_log_gives_them(spark, tmp_path):
    given = _tables(spark, tmp_path)
    files, places = b.file_size(spark, given), b.commit_log(spark, given)
    wanted = files.join(places, "commit_id").groupBy("commit_id", "repo", "provider").agg(
        F.min("language").alias("language"), *[F.sum(m).alias(m) for m in MEASURES], F.min("day").alias("first_day")
    )
    dated = b.dated_files(spark, given, pinned(places))
    columns = ["repo", "commit_hash", "provider", "language", *MEASURES, "first_day"]
    wanted = wanted.withColumn("commit_hash", F.concat(F.lit("o"), "commit_id"))
    assert sorted(dated.select(*columns).collect()) == sorted(wanted.select(*columns).collect())
    assert dated.filter("commit_hash = 'o3'").select("lines").distinct().first()[0] == 8  # in the log twice


def test_landed_texts_are_compressed_and_read_whole(spark, tmp_path):
    given = _tables(spark, tmp_path)
    landed = b.land_order_files(spark, given)
    parts = [p for folder in "ab" for p in Path(landed[:-2], folder).glob("part-*")]
    assert parts and all(p.name.endswith(".csv.gz") for p in parts)
    read = read_file_sizes(spark, landed, commit="commit_hash", by={"repo": T.LongType()})
    wanted = b.order_files(spark, given).select(*read.columns)
    assert sorted(read.collect()) == sorted(wanted.collect())
