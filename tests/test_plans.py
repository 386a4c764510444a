"""What the plans must and must not hold, with broadcasting switched off."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from repotide.catalog.queries import QUERIES
from repotide.operators.keys import lookup

SF_DIR = "/root/testdata/sf0.001"
# these query themselves while they are built; their results are plain scans
WRITERS = {
    "append_new_keys",
    "stream_new_revisions",
    "stream_daily_activity",
    "stream_revisions_by_folder",
    "stream_size_log_join",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    "name", [n for n in sorted(QUERIES) if n not in WRITERS and not n.startswith(("stored_", "landed_"))]
)
def test_no_cross_join_and_no_python(spark, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "Python", "SortAggregate"):
        assert bad not in plan, plan


def test_scans_read_only_what_they_need(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(QUERIES["size_per_commit"](spark, SF_DIR))
    assert set(re.findall(r"l_\w+", plan.split("ReadSchema")[1])) == {
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    }
    plan = plan_of(QUERIES["union_sources"](spark, SF_DIR))
    assert "EqualTo(l_returnflag,A)" in plan


def test_hot_value_is_split_by_the_join(spark, no_broadcast):
    """A third of the facts on one value, as its own partition, is split."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        facts = spark.range(0, 60000, 1, 6).select(
            "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 5000)).alias("v")
        )
        dim = spark.range(5000).select("id", F.concat(F.lit("v"), "id").alias("name"))
        dim = dim.unionByName(spark.range(5000, 5001).select("id", F.lit("hot").alias("name")))
        joined = lookup(facts, "v", dim, "name", "ref", unique=True)
        rows = joined.collect()
        assert "skew=true" in plan_of(joined)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert len(rows) == 60000
    assert all(r.ref == (5000 if r.id % 3 == 0 else r.id % 5000) for r in rows)


def test_open_items_agree_with_the_interval_join(spark):
    from repotide.plans.open_items import open_items_per_day

    rng = random.Random(5)
    rows = []
    for _ in range(3000):
        start = rng.randrange(-20, 120)
        end = None if rng.random() < 0.2 else start + rng.choice([0, 0, 1, 5, 60])
        rows.append((rng.choice(["hot", "hot", "b", "c", "no log"]), start, end))
    base = F.lit("2024-01-01").cast("date")
    items = spark.createDataFrame(rows, "repo string, s int, e int").select(
        "repo", F.date_add(base, "s").alias("created"), F.date_add(base, "e").alias("closed")
    )
    log = spark.createDataFrame([("hot", 0), ("hot", 9), ("b", 40), ("c", 3), ("d", 7)], "repo string, s int")
    log = log.select("repo", F.date_add(base, "s").alias("day"))
    got = open_items_per_day(items, log, ["repo"], "2024-03-31").collect()
    want = {}
    for repo, first in [("hot", 0), ("b", 40), ("c", 3), ("d", 7)]:
        for day in range(first, 90):
            want[repo, day] = sum(
                1 for r, s, e in rows if r == repo and (e is None or s <= e) and s <= day and (90 if e is None else e) > day
            )
    from datetime import datetime

    assert {(r.repo, (r.start - datetime(2024, 1, 1)).days): r.open_events for r in got} == want
