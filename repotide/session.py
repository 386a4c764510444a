"""Session settings and the shared folder that intermediate tables live in."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot author, parent or repository may own a third of the rows: let the
    # join split its partition even where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Stored and pinned tables are written often and take a quarter less than with snappy.
    "spark.sql.parquet.compression.codec": "zstd",
    # Rows in memory take 15 to 18 times their files here (ids, short texts), a broadcast table more: by
    # the files' size alone, a million people of 4 MB were broadcast and filled the driver.
    "spark.sql.sources.fileCompressionFactor": "20.0",
    # Both sides of a join lie in one store, not in four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # Days times people of open windows need not fit the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every plan here is written for."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its machine, so that is
    an error.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named is None:
        if re.fullmatch(r"local(\[.*\])?", context.master) is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="repotide-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def _fits_parquet(schema: T.StructType) -> bool:
    names = [name.lower() for name in schema.names]
    kinds = schema.simpleString()
    return bool(names) and len(set(names)) == len(names) and "void" not in kinds and "interval" not in kinds


def pinned(df: DataFrame) -> DataFrame:
    """``df`` kept in a file of the shared folder: worked out once, lineage cut.

    The file is Parquet, so readers take the columns they need and a join knows its size
    beforehand: a small one is broadcast without the other side being moved first. Rows that
    Parquet cannot hold go to a checkpoint.
    """
    spark = df.sparkSession
    if not _fits_parquet(df.schema):
        shared_dir(spark)
        return df.checkpoint()
    path = scratch_path(spark, "pinned")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/repotide-{uuid.uuid4().hex}/{name}"
