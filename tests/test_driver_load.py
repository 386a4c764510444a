"""What stored tables cost the driver beside their rows: files a month, broadcasts."""

from __future__ import annotations

import datetime
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.operators.keys import lookup
from repotide.session import configure, pinned
from repotide.sources.tables import MONTH, replace_days
from repotide.warehouse import Warehouse


def _files_a_month(path) -> Counter:
    return Counter(file.parent.name for file in Path(path).glob(f"{MONTH}=*/*.parquet"))


def _days(spark, value, first="2024-01-01", days=120, repos=20):
    """A row per repository and day, all over the tasks."""
    cell = F.lit(value).cast("long")
    return (
        spark.range(days * repos)
        .select(
            (F.col("id") % repos).alias("repo"),
            F.date_add(F.lit(first).cast("date"), (F.col("id") / repos).cast("int")).alias("date"),
            *[cell.alias(c) for c in ("lines", "code", "comments", "blanks", "bytes")],
        )
        .repartition(8)
    )


def test_monthly_table_has_a_file_a_month(spark, tmp_path, many_ranges):
    house = Warehouse(spark, str(tmp_path), {"repo": T.LongType()}, monthly=True)
    name, path = "project_size_per_day", tmp_path / "project_size_per_day"
    columns = house._schema(name).names
    house._replace(name, _days(spark, 1).select(*columns))
    assert set(_files_a_month(path).values()) == {1}  # eight tasks wrote eight files each
    wanted = spark.createDataFrame([(r, datetime.date(2024, 2, 15)) for r in range(20)], "repo long, since date")
    fresh = _days(spark, 2).filter("date >= '2024-02-15'").select(*columns)
    replace_days(fresh, house.read(name), str(path), wanted, ["repo"], "date")
    assert set(_files_a_month(path).values()) == {1}
    spark.catalog.refreshByPath(str(path))
    got = {(r.repo, r.date): r.lines for r in house.read(name).collect()}
    assert len(got) == 20 * 120
    assert all(lines == (2 if day >= datetime.date(2024, 2, 15) else 1) for (_, day), lines in got.items())


def test_table_of_many_packed_rows_is_not_broadcast(spark):
    """A few MB of files hold rows that would fill a small driver."""
    configure(spark)  # as each query does; those on texts set the factor otherwise
    person = F.concat(F.lit("c"), F.col("id"), F.lit("@x")).alias("email")
    people = pinned(spark.range(1_000_000).select((F.col("id") % 25).alias("repo"), person, "id"))
    path = people.inputFiles()[0].removeprefix("file:")
    packed = sum(file.stat().st_size for file in Path(path).parent.glob("*.parquet"))
    assert packed < 10 * 1024 * 1024  # by the files alone Spark would send it to every task
    landed = spark.range(10_000_000).select((F.col("id") % 25).alias("repo"), person)
    found = lookup(landed, "email", people, "email", "author_id", ["repo"], unique=True)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
