"""Stored tables: scan, ad-hoc SQL, append of new keys, refresh."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.operators.keys import null_safe, without_known
from repotide.operators.quality import require
from repotide.session import pinned


def scan_table(
    spark: SparkSession, path: str, schema: T.StructType, checked: bool = False
) -> DataFrame:
    """Read a table with its declared schema; ``checked`` fails on a bad row."""
    table = spark.read.schema(schema).parquet(path)
    return require(table, schema) if checked else table


def read_if_any(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A table, or None if nothing is stored there yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.schema(schema).parquet(path)


def sql_query(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Run an ad-hoc SQL text over named tables."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return spark.sql(sql)


def _within_bounds(stored: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored keys that lie between the smallest and largest of the batch.

    The bounds are constants, so files and row groups of a table that grows
    along its key are skipped unread.
    """
    ends = [f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]
    bounds = batch.agg(*ends).first()
    for k in keys:
        low, high = bounds[f"min_{k}"], bounds[f"max_{k}"]
        if low is not None:
            stored = stored.filter(F.col(k).between(F.lit(low), F.lit(high)) | F.col(k).isNull())
    return stored


def conflicting_rows(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``batch`` whose key is there with several values, each once."""
    rows = batch.distinct()
    several = rows.groupBy(*keys).count().filter("count > 1")
    right = several.select(*[F.col(k).alias(f"_several_{k}") for k in keys])
    return rows.join(right, null_safe(rows, right, [(k, f"_several_{k}") for k in keys]), "left_semi")


def collisions(batch: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``batch`` whose key is stored with other values."""
    rest = [c for c in batch.columns if c not in keys]
    held = stored.select(
        *[F.col(k).alias(f"_known_{k}") for k in keys], F.struct(*rest).alias("_stored")
    )
    joined = batch.join(held, null_safe(batch, held, [(k, f"_known_{k}") for k in keys]))
    return joined.filter(~F.struct(*[batch[c] for c in rest]).eqNullSafe(F.col("_stored"))).select(
        *[batch[c] for c in batch.columns]
    )


def new_rows(
    batch: DataFrame, stored: DataFrame, keys: Sequence[str], conflicts: str = "fail"
) -> DataFrame:
    """Rows of ``batch`` with an unknown key, one per key.

    A key that comes with several values fails the job; with ``conflicts`` "leave" its
    rows are left out (``conflicting_rows`` lists them).
    The stored keys are first cut to those of the batch, so a batch small
    enough to be broadcast spares the large table a shuffle.
    """
    wanted = batch.select(*[F.col(k).alias(f"_want_{k}") for k in keys]).distinct()
    pairs = [(k, f"_want_{k}") for k in keys]
    known = _within_bounds(stored.select(*keys), batch, keys)
    known = known.join(wanted, null_safe(known, wanted, pairs), "left_semi")
    fresh = without_known(batch, known, keys)
    rest = [c for c in batch.columns if c not in keys]
    if not rest:
        return fresh.distinct()
    return _one_value(fresh, keys, rest, conflicts)


def _one_value(rows: DataFrame, keys: Sequence[str], rest: Sequence[str], conflicts: str) -> DataFrame:
    whole = F.struct(*rest)
    found = rows.groupBy(*keys).agg(F.min(whole).alias("_row"), F.max(whole).alias("_other"))
    same = F.col("_row").eqNullSafe(F.col("_other"))
    if conflicts == "leave":
        found = found.filter(same)
    else:
        what = [F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys]
        told = F.concat(F.lit(f"several values for {', '.join(keys)} = "), F.concat_ws(", ", *what))
        found = found.withColumn("_row", F.when(same, F.col("_row")).otherwise(F.raise_error(told)))
    return found.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def one_value_per_key(rows: DataFrame, keys: Sequence[str], conflicts: str = "fail") -> DataFrame:
    """``rows`` with repeats once; a key with several values fails the job or is left out."""
    rest = [c for c in rows.columns if c not in keys]
    return _one_value(rows, keys, rest, conflicts) if rest else rows.distinct()


def unseen_rows(
    batch: DataFrame, stored: DataFrame | None, keys: Sequence[str], name: str, told: Sequence[str] = ()
) -> DataFrame:
    """The rows of ``batch`` whose key is not in ``stored``, repeats once.

    A key that has several values, in the batch or there and in ``stored``, fails the job;
    the error tells its ``name`` and the columns ``told`` (default: the key's). Both sides meet in one shuffle and one sort by key, in
    which landed rows come first and each row is held against the one before it.
    """
    rows = batch.withColumn("_landed", F.lit(1))
    if stored is not None:
        rows = rows.unionByName(stored.select(*batch.columns).withColumn("_landed", F.lit(0)))
    rest = [c for c in batch.columns if c not in keys]
    of_key = Window.partitionBy(*keys).orderBy(F.desc("_landed"))
    so_far = of_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    compared = rows.withColumns(
        {
            # null only for a key's first row, so it also tells whether there is one before
            "_before": F.lag("_landed").over(of_key),
            "_any": F.first("_landed").over(so_far),
            "_last": F.lead("_landed").over(of_key).isNull(),
            **{f"_before_{c}": F.lag(c).over(of_key) for c in rest},
        }
    )
    same = F.lit(True)
    for c in rest:
        same = same & F.col(c).eqNullSafe(F.col(f"_before_{c}"))
    differs = F.col("_before").isNotNull() & ~same
    what = F.coalesce(F.col(name).cast("string"), F.lit("null"))
    fails = lambda why: F.raise_error(F.concat(F.lit(f"{why}: "), what)).cast("boolean")
    wanted = (
        F.when(differs & (F.col("_landed") == 1), fails(f"several values for {', '.join(told or keys)}, {name}"))
        .when(differs & (F.col("_any") == 1), fails("measured otherwise before"))
        .otherwise(F.col("_last") & (F.col("_landed") == 1))
    )
    return compared.filter(wanted).select(*batch.columns)


def append_new_keys(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    whole_batch: bool = False,
    partition_by: Sequence[str] = (),
    model: T.StructType | None = None,
    conflicts: str = "fail",
) -> bool:
    """Append the rows whose key the table at ``path`` does not hold.

    Rows are checked against ``model`` where one is given. A new key with several values
    fails the job, or is left out with ``conflicts`` "leave"; ``conflicting_rows`` and
    ``collisions`` report such rows and those whose key is stored with other values.
    A table that is not there yet is created. With ``whole_batch`` a single known or repeated key rejects the batch:
    nothing is written and False is returned. Writing the same batch twice
    leaves the table as after the first time.
    """
    spark = batch.sparkSession
    batch = batch if model is None else require(batch, model)
    stored = read_if_any(spark, path, batch.schema)
    if stored is None:
        stored = spark.createDataFrame([], batch.schema)
    if whole_batch:
        repeated = batch.groupBy(*keys).count().filter("count > 1")
        right = stored.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
        pairs = [(k, f"_known_{k}") for k in keys]
        known = batch.join(right, null_safe(batch, right, pairs), "left_semi")
        if known.select(*keys).unionByName(repeated.select(*keys)).first() is not None:
            return False
        fresh = batch
    else:
        fresh = new_rows(batch, stored, keys, conflicts)
    fresh.write.mode("append").partitionBy(*partition_by).parquet(path)
    return True


#: The month of a row's day, a folder of tables that are refreshed by days.
MONTH = "_month"


def month_of(day: str) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int").alias(MONTH)


def folder_by_folder(rows: DataFrame, folders: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` moved so that a task writes whole folders, sorted by ``order`` in each.

    Else each task writes a file to every folder, and as many files as tasks times months are
    listed by the driver and read in as many tasks. A folder that is large, or one that holds
    most rows, is split between tasks.
    """
    return rows.hint("rebalance", *folders).sortWithinPartitions(*dict.fromkeys([*folders, *order]))


def refresh(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write a recomputed metric, replacing only the partitions it holds."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def replace_days(
    fresh: DataFrame, stored: DataFrame, path: str, wanted: DataFrame, by: Sequence[str], day: str,
    partition_by: Sequence[str] = (),
) -> None:
    """Put ``fresh`` in place of the stored rows of ``wanted`` (by, since) from ``since`` on.

    Only the months that ``fresh`` lies in are read and written; their other rows stay. Which
    months these are is bound by the calendar. ``fresh`` may be worked out from ``stored``.
    """
    fresh = pinned(fresh.withColumn(MONTH, month_of(day)))
    months = [r[0] for r in fresh.select(MONTH).distinct().collect()]
    if not months:
        return
    bounds = wanted.select(*by, F.col("since").alias("_since"))
    held = stored.withColumn(MONTH, month_of(day)).filter(F.col(MONTH).isin(months))
    kept = held.join(bounds, [*by], "left").filter(F.col("_since").isNull() | (F.col(day) < F.col("_since")))
    # read before its files are replaced
    kept = pinned(kept.select(*fresh.columns))
    folders = [*partition_by, MONTH]
    refresh(folder_by_folder(kept.unionByName(fresh), folders, [*by, day]), path, folders)


def union_sources(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts, columns matched by name."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
