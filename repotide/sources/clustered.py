"""Tables laid out for their readers: buckets of a join key, folders of a hashed key.

A bucketed table says in the catalogue which rows share a bucket, so two of them join
without moving rows. Files are sorted by the key, so a filter skips row groups, and where the key is
one column it reads one bucket. Rows of one key are read by one task: this is for tables
whose key is unique, never for facts of which one key may hold a third.

A table in folders by the hash of its key is for loads: a batch reads the folders its own
keys fall in, and within them a small batch skips row groups by Bloom filters on the key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.operators.keys import null_safe, without_known
from repotide.sources.tables import one_value_per_key, read_if_any

#: The folder column of tables that are laid out by the hash of their key.
FOLDER = "_folder"
_FOLDER_FIELD = T.StructField(FOLDER, T.IntegerType())
# A batch of up to this many keys is also looked up by value, so that Bloom filters work.
_BY_VALUE = 64


# --- buckets ------------------------------------------------------------------


def _name(path: str, keys: Sequence[str], buckets: int) -> str:
    told = "|".join([path, str(buckets), *keys])
    return f"repotide_{hashlib.md5(told.encode()).hexdigest()}"


def open_bucketed(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int
) -> DataFrame:
    """The table at ``path``, known to lie in ``buckets`` of ``keys``.

    The catalogue entry is made anew in sessions that do not have it; the files stay what
    they are. Number and keys must be those of the write.
    """
    name = _name(path, keys, buckets)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = ", ".join(f"`{k}`" for k in keys)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet"
            f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
    return spark.table(name)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Append to the bucketed table at ``path``, or create it.

    Rows are first brought together by key, so a task writes a file for each of its buckets
    and not for all of them.
    """
    spark = df.sparkSession
    name = _name(path, keys, buckets)
    if read_if_any(spark, path, df.schema) is not None:
        open_bucketed(spark, path, df.schema, keys, buckets)
    elif spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE {name}")
    rows = df.repartition(buckets, *keys)
    writer = rows.write.format("parquet").mode("append").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def reopen_bucketed(spark: SparkSession, path: str, keys: Sequence[str], buckets: int) -> None:
    """Forget what the catalogue knows of the files at ``path``, after they were exchanged."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(path, keys, buckets)}")
    spark.catalog.refreshByPath(path)


# --- folders ------------------------------------------------------------------


def folder_of(keys: Sequence[str], folders: int) -> Column:
    """The folder of a key. It depends on the key's type, which must stay that of the table."""
    return F.pmod(F.xxhash64(*keys), F.lit(folders)).cast("int").alias(FOLDER)


def read_by_folder(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The whole table, without the folder column."""
    return spark.read.schema(T.StructType([*schema.fields, _FOLDER_FIELD])).parquet(path).drop(FOLDER)


def rows_near(
    batch: DataFrame, path: str, keys: Sequence[str], folders: int
) -> DataFrame | None:
    """The rows at ``path`` that a row of ``batch`` may share its key with.

    The folders are constants of the scan (there are at most ``folders`` of them), so other
    folders are not read. None if nothing is stored.
    """
    spark = batch.sparkSession
    schema = T.StructType([*batch.schema.fields, _FOLDER_FIELD])
    stored = read_if_any(spark, path, schema)
    if stored is None:
        return None
    wanted = [r[0] for r in batch.select(folder_of(keys, folders)).distinct().collect()]
    stored = stored.filter(F.col(FOLDER).isin(wanted) if wanted else F.lit(False))
    few = batch.select(*keys).distinct().limit(_BY_VALUE + 1).collect()
    if 0 < len(few) <= _BY_VALUE and not any(v is None for r in few for v in r):
        for i, k in enumerate(keys):
            values = sorted({r[i] for r in few})
            stored = stored.filter(reduce(lambda a, b: a | b, [F.col(k) == F.lit(v) for v in values]))
    return stored.drop(FOLDER)


def append_by_folder(
    batch: DataFrame, path: str, keys: Sequence[str], folders: int = 256, conflicts: str = "fail"
) -> None:
    """Append the rows of ``batch`` whose key the table at ``path`` does not hold.

    A new key with several values fails the job or, with ``conflicts`` "leave", is left out.
    ``batch`` is read more than once; persist it where that costs much. A null key is a key.
    Writing the same batch twice leaves the table as after the first time.
    """
    known = rows_near(batch, path, keys, folders)
    fresh = batch
    if known is not None:
        wanted = batch.select(*[F.col(k).alias(f"_want_{k}") for k in keys]).distinct()
        held = known.select(*keys)
        held = held.join(wanted, null_safe(held, wanted, [(k, f"_want_{k}") for k in keys]), "left_semi")
        fresh = without_known(batch, held, keys)
    fresh = one_value_per_key(fresh, keys, conflicts)
    rows = fresh.withColumn(FOLDER, folder_of(keys, folders))
    writer = rows.repartition(FOLDER).sortWithinPartitions(FOLDER, *keys).write.mode("append")
    for k in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
    writer.partitionBy(FOLDER).parquet(path)
