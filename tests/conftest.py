from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import pytest

os.environ["TZ"] = "UTC"  # collected instants are shown in the machine's zone
time.tzset()
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from repotide.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def many_ranges(spark):
    """Keep small data in eight ranges instead of merging them into one."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture(params=["one partition", "shuffled over seven"])
def spread(request):
    """Lay the same rows out in different ways."""
    from pyspark.sql import functions as F

    def apply(df):
        if request.param == "one partition":
            return df.coalesce(1)
        return df.repartition(7).sortWithinPartitions(F.hash(*df.columns))

    return apply
