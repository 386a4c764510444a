"""Calendar spines and gap filling of daily series.

Windows here run over at most one row per group and calendar day, so their
size is bound by the length of the calendar, not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def days_between(first: Column, last: Column) -> Column:
    """All days from first to last, both included; none if last is earlier."""
    return F.when(first <= last, F.sequence(first, last))


def calendar(bounds: DataFrame, first: str, last: Column, by: Sequence[str], day: str = "day") -> DataFrame:
    """One row per group and day from the column ``first`` to ``last``."""
    return bounds.select(*by, F.explode(days_between(F.col(first), last)).alias(day))


def align(spine: DataFrame, daily: DataFrame, by: Sequence[str], day: str = "day") -> DataFrame:
    """Daily values on the spine; days without a value become null."""
    return spine.join(daily, [*by, day], "left")


def forward_fill(df: DataFrame, columns: Sequence[str], by: Sequence[str], day: str = "day") -> DataFrame:
    """Replace nulls of ``columns`` by the last value before them."""
    so_far = (
        Window.partitionBy(*by)
        .orderBy(day)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.select(
        *[
            F.last(c, ignorenulls=True).over(so_far).alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )


def _with_next_day(df: DataFrame, by: Sequence[str], day: str, end: Column) -> DataFrame:
    following = F.lead(day).over(Window.partitionBy(*by).orderBy(day))
    # least() passes over the null after a group's last row
    return df.withColumn("_next", F.least(following, F.date_add(end, 1)))


def hold_until(daily: DataFrame, columns: Sequence[str], by: Sequence[str], end: Column, day: str = "day") -> DataFrame:
    """Repeat each day's values until the next row of its group, or ``end``.

    Equal to aligning to the calendar and forward filling, but only the sparse
    rows are shuffled. Rows after ``end`` are cut.
    """
    held = forward_fill(daily.filter(F.col(day) <= end), columns, by, day)
    return _with_next_day(held, by, day, end).select(
        *by,
        F.explode(F.sequence(F.col(day), F.date_sub("_next", 1))).alias(day),
        *columns,
    )


def fill_constant(
    daily: DataFrame,
    columns: Sequence[str],
    by: Sequence[str],
    end: Column,
    value: int = 0,
    day: str = "day",
) -> DataFrame:
    """Add rows holding ``value`` for the missing days up to ``end``."""
    spread = _with_next_day(daily.filter(F.col(day) <= end), by, day, end).select(
        *by,
        F.explode(F.sequence(F.col(day), F.date_sub("_next", 1))).alias("_filled"),
        day,
        *columns,
    )
    real = F.col("_filled") == F.col(day)
    return spread.select(
        *by,
        F.col("_filled").alias(day),
        *[F.when(real, F.coalesce(F.col(c), F.lit(value))).otherwise(value).alias(c) for c in columns],
    )


def missing_days(daily: DataFrame, by: Sequence[str], day: str = "day") -> DataFrame:
    """Days between two rows of a group that have no row themselves."""
    following = F.lead(day).over(Window.partitionBy(*by).orderBy(day))
    gap = days_between(F.date_add(day, 1), F.date_sub("_next", 1))
    return daily.select(*by, day, following.alias("_next")).select(*by, F.explode(gap).alias(day))
