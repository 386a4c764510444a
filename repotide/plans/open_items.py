"""Open issues or pull requests per day, and their join with the daily size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repotide.functions.time import AsOf, day_end, day_or_today, day_start
from repotide.operators.calendar import forward_fill, hold_until
from repotide.schemas import MEASURES


def project_start(log: DataFrame, by: Sequence[str] = (), day: str = "day") -> DataFrame:
    """Earliest commit day."""
    return log.groupBy(*by).agg(F.min(day).alias("start"))


def rejected_items(items: DataFrame, created: str = "created", closed: str = "closed") -> DataFrame:
    """Items that no count can hold: closed before they were created, or never created."""
    return items.filter(F.col(created).isNull() | (F.col(closed) < F.col(created)))


def open_item_steps(
    items: DataFrame,
    log: DataFrame,
    by: Sequence[str] = (),
    as_of: AsOf = None,
    created: str = "created",
    closed: str = "closed",
    day: str = "day",
) -> DataFrame:
    """Number of open items on each day on which it may change.

    ``created`` and ``closed`` are days; an item without ``closed`` is open
    until ``as_of``. It counts from its creation to the day before it closes.
    Items closed before they were created are left out (``rejected_items``
    lists them). Only ``by`` and
    ``day`` of ``log`` are used, for the start.

    Opening adds 1 and closing takes 1 away, so a running sum over the days
    with a change counts the open items: linear in the items, no range join.
    """
    until = day_or_today(as_of)
    spans = items.select(
        *by, F.col(created).alias("_from"), F.coalesce(closed, until).alias("_to")
    ).filter("_from <= _to")
    steps = spans.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col("_from").alias("day"), F.lit(1).alias("step")),
                F.struct(F.col("_to").alias("day"), F.lit(-1).alias("step")),
            )
        ).alias("_s"),
    ).select(*by, "_s.day", "_s.step", F.lit(False).alias("_commit"))
    commits = log.select(
        *by, F.col(day).alias("day"), F.lit(0).alias("step"), F.lit(True).alias("_commit")
    )
    changes = (
        steps.unionByName(commits)
        .groupBy(*by, "day")
        .agg(F.sum("step").alias("_change"), F.max("_commit").alias("_commit"))
    )
    group = Window.partitionBy(*by)
    so_far = group.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = changes.select(
        *by,
        "day",
        F.sum("_change").over(so_far).alias("open_events"),
        F.min(F.when(F.col("_commit"), F.col("day"))).over(group).alias("_start"),
    )
    return counted.filter((F.col("day") >= F.col("_start")) & (F.col("day") < until)).select(
        *by, "day", "open_events"
    )


def open_items_per_day(
    items: DataFrame, log: DataFrame, by: Sequence[str] = (), as_of: AsOf = None, **columns: str
) -> DataFrame:
    """Open items per day from the project's start to the day before ``as_of``.

    Arguments are those of ``open_item_steps``.
    """
    steps = open_item_steps(items, log, by, as_of, **columns)
    daily = hold_until(steps, ["open_events"], by, F.date_sub(day_or_today(as_of), 1))
    return daily.select(
        *by,
        day_start(F.col("day")).alias("start"),
        day_end(F.col("day")).alias("end"),
        "open_events",
    )


def issue_density_per_day(
    sizes: DataFrame, open_items: DataFrame, by: Sequence[str] = (), day: str = "day"
) -> DataFrame:
    """Daily size next to the open items of the day, gaps filled forward.

    ``as_of`` itself has no open-item row and takes over the day before,
    including its ``end``. Days before the first open-item row stay null.
    """
    counts = open_items.select(
        *by,
        F.col("start").cast("date").alias("start"),
        F.col("end").cast("date").alias("end"),
        "open_events",
    )
    side_by_side = sizes.withColumnRenamed(day, "start").join(counts, [*by, "start"], "left")
    filled = forward_fill(side_by_side, [*MEASURES, "end", "open_events"], by, "start")
    return filled.select(*by, "start", *MEASURES, "end", "open_events")


def issue_density_from_steps(
    sizes: DataFrame, open_items: DataFrame, by: Sequence[str] = (), as_of: AsOf = None
) -> DataFrame:
    """``issue_density_per_day`` from ``size_steps`` and ``open_item_steps``.

    Both series are merged and filled while they hold only the days with a
    change; the calendar is expanded last, so no daily row is ever shuffled.
    """
    until = day_or_today(as_of)
    values = [*MEASURES, "open_events"]
    sized = sizes.filter(F.col("day") <= until).withColumn("_sized", F.col("day"))
    merged = (
        sized.unionByName(open_items.filter(F.col("day") < until), allowMissingColumns=True)
        .groupBy(*by, "day")
        .agg(*[F.max(v).alias(v) for v in values], F.min("_sized").alias("_sized"))
        .withColumn("_start", F.min("_sized").over(Window.partitionBy(*by)))
    )
    filled = forward_fill(merged, values, by).filter("day >= _start")
    daily = hold_until(filled, values, by, until)
    last_counted = F.least(F.col("day"), F.date_sub(until, 1))
    return daily.select(
        *by,
        F.col("day").alias("start"),
        *MEASURES,
        F.when(F.col("open_events").isNotNull(), last_counted).alias("end"),
        "open_events",
    )


def issue_density_ratio(density: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Open items per thousand lines; our extension, null without lines."""
    per_kline = F.col("open_events") * 1000 / F.nullif(F.col("lines"), F.lit(0))
    return density.select(*by, "start", F.round(per_kline, 6).alias("open_per_kline"))
