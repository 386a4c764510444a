"""Project size per commit and per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repotide.functions.time import AsOf, day_or_today
from repotide.operators.calendar import hold_until
from repotide.operators.ordering import order_key
from repotide.schemas import MEASURES


def size_per_commit(files: DataFrame, commit: str = "commit_id", by: Sequence[str] = ()) -> DataFrame:
    """Sum of the files' measures per commit; a commit without files has no row."""
    return (
        files.filter(F.col(commit).isNotNull())
        .groupBy(*by, commit)
        .agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("long").alias(m) for m in MEASURES])
    )


def join_log(values: DataFrame, log: DataFrame, on: Sequence[str]) -> DataFrame:
    """Attach day, committer and order of the log to per-commit values."""
    return values.join(log, [*on], "inner")


def last_of_day(
    sizes: DataFrame, order: Sequence[str], by: Sequence[str] = (), day: str = "day"
) -> DataFrame:
    """Each day's last commit in commit order, with its place in the log."""
    key = order_key(order, [*by, day])
    return sizes.groupBy(*by, day).agg(
        *[F.max_by(m, key).alias(m) for m in MEASURES], F.max(key).alias("_last")
    )


def size_steps(
    sizes: DataFrame, order: Sequence[str], by: Sequence[str] = (), day: str = "day"
) -> DataFrame:
    """The days on which the size changes, as far as they belong to the series.

    It starts at the day that comes first in commit order; days before it,
    where a log runs backwards, are cut.
    """
    daily = last_of_day(sizes, order, by, day)
    place = order_key([day, "_last"]) if day in order else F.col("_last")
    first = F.min_by(day, place).over(Window.partitionBy(*by))
    started = daily.withColumn("_start", first).filter(F.col(day) >= F.col("_start"))
    return started.select(*by, day, *MEASURES)


def size_per_day(
    sizes: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    as_of: AsOf = None,
    day: str = "day",
) -> DataFrame:
    """Daily size, held until the next day with a commit and up to ``as_of``."""
    steps = size_steps(sizes, order, by, day)
    return hold_until(steps, MEASURES, by, day_or_today(as_of), day)
