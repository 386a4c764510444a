"""Buckets, folders and sorted files: rows that do not move, files that are not read."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.sources.clustered import (
    append_by_folder,
    open_bucketed,
    read_by_folder,
    rows_near,
    write_bucketed,
)
from repotide.streaming import sizes as size_stream
from repotide.warehouse import Warehouse

BY = {"repo": T.LongType()}
DAY = datetime.datetime(2024, 1, 1)
LOG = (
    "repo long, seq long, author string, author_email string, co_author_emails array<string>,"
    " commit_hash string, authored_datetime timestamp, committed_datetime timestamp,"
    " committer string, committer_email string, encoding string, message string, gpgsign string,"
    " parents array<string>"
)
FILES = (
    "repo long, commit_hash string, language string, provider string,"
    " lines long, code long, comments long, blanks long, bytes long"
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(spark, df):
    """Files and rows that the scans of ``df`` read."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(i).metrics() for i in range(leaves.size())]
        return tuple(sum(m.apply(name).value() for m in scans) for name in ("numFiles", "numOutputRows"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def filled(spark, root, buckets):
    house = Warehouse(spark, root, by=BY, as_of="2024-01-31", buckets=buckets)
    tags = spark.createDataFrame([], "repo long, commit_hash string")
    rows = [
        (r, i, "a", "a@x", [], f"{r}-{i}", DAY, DAY + datetime.timedelta(days=i // 4), f"c{i % 3}",
         f"c{i % 3}@x", "UTF-8", "m", None, [])
        for r in (1, 2, 3) for i in range(40)
    ]
    files = [(r[0], r[5], "x", f"f{k}", r[1], k, 1, 1, r[1] * k) for r in rows for k in (1, 2)]
    for low, high in ((0, 25), (0, 40)):
        house.load_log(spark.createDataFrame([r for r in rows if low <= r[1] < high], LOG), tags, ["seq"])
    house.load_file_sizes(spark.createDataFrame(files, FILES))
    house.project_size()
    house.project_productivity()
    house.bus_factor()
    return house


@pytest.fixture(scope="module")
def houses(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("houses")
    return filled(spark, str(root / "plain"), 0), filled(spark, str(root / "bucketed"), 4)


def test_bucketed_tables_hold_the_same_rows(houses):
    plain, bucketed = houses
    for name in ("commit_logs", "project_size_per_commit", "project_size_per_day",
                 "project_productivity_per_commit", "project_productivity_per_day", "bus_factor_per_day"):
        want = sorted(map(str, plain.read(name).collect()))
        assert len(want) > 20 and sorted(map(str, bucketed.read(name, checked=True).collect())) == want


def test_size_and_log_join_without_exchange(spark, houses, no_broadcast):
    plain, bucketed = houses
    for name in ("project_size_per_commit", "project_productivity_per_commit"):
        assert "Exchange" in plan_of(plain._with_log(name))
        joined = bucketed._with_log(name)
        assert "SortMergeJoin" in plan_of(joined) and "Exchange" not in plan_of(joined)
        assert joined.count() == 120


def test_one_key_reads_one_bucket(spark, tmp_path):
    path, schema = str(tmp_path / "table"), T.StructType().add("id", "long").add("v", "long")
    for low in (0, 500):
        write_bucketed(spark.range(low, low + 500).select("id", (F.col("id") * 2).alias("v")), path, ["id"], 4)
    one = open_bucketed(spark, path, schema, ["id"], 4).filter("id = 700")
    assert [tuple(r) for r in one.collect()] == [(700, 1400)]
    # the second write's files all span the key; one of its four buckets is read
    assert scanned(spark, one)[1] < 250


def test_other_sessions_find_the_buckets(spark, houses, no_broadcast):
    bucketed = houses[1]
    for table in spark.catalog.listTables():
        if table.name.startswith("repotide_"):
            spark.sql(f"DROP TABLE {table.name}")
    again = Warehouse(spark, bucketed.root, by=BY, as_of="2024-01-31", buckets=4)
    joined = again._with_log("project_size_per_commit")
    assert "Exchange" not in plan_of(joined) and joined.count() == 120
    assert again.sql("SELECT * FROM commit_logs").count() == 120


def test_number_of_buckets_is_settled(spark, houses):
    plain, bucketed = houses
    for root, buckets in ((bucketed.root, 0), (bucketed.root, 8), (plain.root, 4)):
        with pytest.raises(ValueError, match="buckets"):
            Warehouse(spark, root, by=BY, buckets=buckets)


def test_sorted_files_skip_rows(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"), by=BY)
    measured = spark.range(0, 200_000, 1, 1).select(
        F.lit(1).cast("long").alias("repo"), (F.col("id") * 7919 % 20_000).alias("commit_hash_id"),
        F.lit("x").alias("language"), F.concat(F.lit("f"), "id").alias("provider"),
        *[F.col("id").alias(m) for m in ("lines", "code", "comments", "blanks", "bytes")],
    )
    house.load_file_sizes(measured.repartition(2))
    one = house.read("file_size_per_commit").filter("repo = 1 AND commit_hash_id = 77")
    _, rows = scanned(spark, one)
    assert one.count() == 10 and rows <= 80_000  # of each file the pages around the commit


def test_batch_reads_its_folders_only(spark, tmp_path):
    path, folders = str(tmp_path / "revisions"), 32
    stored = spark.range(20_000).select(F.sha1(F.col("id").cast("string")).alias("commit"), "id")
    append_by_folder(stored, path, ["commit"], folders)
    old = stored.filter("id < 3")
    new = spark.range(20_000, 20_003).select(F.sha1(F.col("id").cast("string")).alias("commit"), "id")
    whole, _ = scanned(spark, read_by_folder(spark, path, stored.schema))
    assert whole == folders
    files, rows = scanned(spark, rows_near(new, path, ["commit"], folders))
    assert files <= 3 and rows == 0  # Bloom filters tell that no row group holds the keys
    files, rows = scanned(spark, rows_near(old, path, ["commit"], folders))
    assert files <= 3 and 3 <= rows < 20_000
    append_by_folder(old.unionByName(new), path, ["commit"], folders)
    append_by_folder(old.unionByName(new), path, ["commit"], folders)
    got = [r.id for r in read_by_folder(spark, path, stored.schema).collect()]
    assert sorted(got) == list(range(20_003))


def test_many_null_empty_and_conflicting_keys(spark, tmp_path):
    path = str(tmp_path / "keys")
    kind = "k string, v long"
    append_by_folder(spark.createDataFrame([], kind), path, ["k"], 4)
    first = [(None, 1), ("", 2), ("a", 3), ("a", 3)]
    append_by_folder(spark.createDataFrame(first, kind), path, ["k"], 4)
    many = [(f"m{i}", i) for i in range(500)]
    append_by_folder(spark.createDataFrame([*first, *many], kind), path, ["k"], 4)
    schema = T.StructType().add("k", "string").add("v", "long")
    got = [tuple(r) for r in read_by_folder(spark, path, schema).collect()]
    assert sorted(got, key=str) == sorted([*set(first), *many], key=str)
    several = spark.createDataFrame([("z", 1), ("z", 2), ("y", 1)], kind)
    with pytest.raises(Exception, match="several values for k = z"):
        append_by_folder(several, path, ["k"], 4)
    append_by_folder(several, path, ["k"], 4, conflicts="leave")
    assert {r.k for r in read_by_folder(spark, path, schema).filter("k IN ('y', 'z')").collect()} == {"y"}


def test_stream_join_lets_go_of_old_rows(spark, tmp_path):
    """Rows land in order, out of order within the lateness, twice, too far apart and too late."""
    at = lambda day, hour=0: DAY + datetime.timedelta(days=day, hours=hour)
    log = {i: at(i) for i in range(40)}
    sizes = {i: at(i + (i % 4), 1 if i % 4 < 2 else 0) for i in range(40)}
    for name, rows in (("log", log), ("sizes", sizes)):
        for part in range(4):
            mine = [(i, t, i * 10) for i, t in rows.items() if i // 10 == part]
            mine = mine[::-1] + mine[:3]
            if part == 3:
                mine.append((100, at(1), 1))  # long behind the watermark, on both sides
            frame = spark.createDataFrame(mine, f"commit long, {name}_at timestamp, {name}_value long")
            frame.coalesce(1).write.mode("append").parquet(str(tmp_path / name))

    def stream(name):
        files = spark.readStream.schema(f"commit long, {name}_at timestamp, {name}_value long")
        return files.option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))

    joined = size_stream.size_log_join(
        stream("sizes"), stream("log"), ["commit"], "sizes_at", "log_at", "2 days", "10 days"
    )
    target = str(tmp_path / "joined")
    query = size_stream.write_joined(joined, target, str(tmp_path / "state"))
    query.awaitTermination()
    got = sorted((r.commit, r.log_value, r.sizes_value) for r in spark.read.parquet(target).collect())
    assert got == [(i, i * 10, i * 10) for i in range(40) if sizes[i] - log[i] <= datetime.timedelta(days=2)]
    join = [o for o in query.lastProgress["stateOperators"] if o["operatorName"] == "symmetricHashJoin"]
    assert join and join[0]["numRowsTotal"] < 60  # of 80
