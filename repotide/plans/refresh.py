"""Daily metrics brought up to date from the first day that a load touched.

A daily row depends on what happened from its day on and on the state of the day
before, which the stored table holds. So a load's new commits and items give one
day per repository, and only rows from that day on are worked out; a repository
without stored rows is worked out whole, one that nothing touched gets the days
since its last stored one. ``sources.tables.replace_days`` then writes the months
that these rows lie in and leaves all others as they are.

As everywhere, a stored series keeps its start: later loads come later in commit
order, and days before the start are cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repotide.functions.time import AsOf, day_end, day_or_today, day_start
from repotide.operators.calendar import fill_constant, hold_until
from repotide.plans.contribution import contribution_per_day
from repotide.plans.open_items import issue_density_per_day, open_items_per_day
from repotide.plans.productivity import productivity_per_day
from repotide.plans.size import last_of_day, size_steps
from repotide.schemas import DELTAS, MEASURES


def touched(rows: DataFrame, days: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, since): the first of the rows' ``days``; nulls among them are passed over."""
    first = F.least(*days) if len(days) > 1 else F.col(days[0])
    return rows.groupBy(*by).agg(F.min(first).alias("since"))


def due(
    stored: DataFrame, changed: DataFrame, by: Sequence[str], until: Column, day: str = "day", again: int = 0
) -> DataFrame:
    """(by, since, start): the first day to work out, and the stored series' start (null: none).

    ``again`` is how many of the last stored days are worked out again in any case.
    """
    held = stored.groupBy(*by).agg(F.min(day).alias("start"), F.max(day).alias("_last"))
    both = held.join(changed, [*by], "full_outer")
    since = F.least("since", F.date_add("_last", 1 - again))
    return both.select(*by, F.greatest(since, F.col("start")).alias("since"), "start").filter(F.col("since") <= until)


def _split(rows: DataFrame, wanted: DataFrame, by: Sequence[str], day: str) -> tuple[DataFrame, DataFrame]:
    """Rows from ``since`` on, of series that are stored and of new ones."""
    window = rows.join(wanted, [*by]).filter(F.col(day) >= F.col("since"))
    columns = rows.columns
    return (
        window.filter("start IS NOT NULL").select(*columns), window.filter("start IS NULL").select(*columns)
    )


def _before(stored: DataFrame, wanted: DataFrame, by: Sequence[str], day: str) -> DataFrame:
    """The stored rows of the day before ``since``."""
    return stored.join(wanted, [*by]).filter(F.col(day) == F.date_sub("since", 1)).select(*stored.columns)


def _from(daily: DataFrame, wanted: DataFrame, by: Sequence[str], day: str) -> DataFrame:
    return daily.join(wanted, [*by]).filter(F.col(day) >= F.col("since")).select(*daily.columns)


def size_from(
    stored: DataFrame, sizes: DataFrame, wanted: DataFrame, order: Sequence[str], by: Sequence[str],
    as_of: AsOf = None, day: str = "day",
) -> DataFrame:
    """Rows of ``size_per_day`` from ``since`` on, held on from the day before."""
    old, new = _split(sizes, wanted, by, day)
    columns = [*by, day, *MEASURES]
    steps = (
        last_of_day(old, order, by, day).select(*columns)
        .unionByName(size_steps(new, order, by, day).select(*columns))
        .unionByName(_before(stored, wanted, by, day).select(*columns))
    )
    return _from(hold_until(steps, MEASURES, by, day_or_today(as_of), day), wanted, by, day)


def productivity_from(
    changes: DataFrame, wanted: DataFrame, order: Sequence[str], by: Sequence[str],
    as_of: AsOf = None, day: str = "day",
) -> DataFrame:
    """Rows of ``productivity_per_day`` from ``since`` on."""
    old, new = _split(changes, wanted, by, day)
    begins = wanted.filter("start IS NOT NULL").select(
        *by, F.col("since").alias(day), *[F.lit(0).cast("long").alias(d) for d in DELTAS]
    )
    daily = (
        old.select(*by, day, *DELTAS).unionByName(begins)
        .groupBy(*by, day).agg(*[F.sum(d).alias(d) for d in DELTAS])
    )
    filled = fill_constant(daily, DELTAS, by, day_or_today(as_of), 0, day)
    return filled.unionByName(productivity_per_day(new, order, by, as_of, day).select(*filled.columns))


def contribution_from(
    stored: DataFrame, changes: DataFrame, wanted: DataFrame, by: Sequence[str], day: str = "day"
) -> DataFrame:
    """Rows of ``contribution_per_day`` from ``since`` on.

    The series ends with the last active day, so the stored last day before ``since`` opens
    the gap up to the first active day after it.
    """
    old, new = _split(changes, wanted, by, day)
    columns = [*by, day, "committer_id", *DELTAS]
    held = stored.join(wanted, [*by]).filter(F.col(day) < F.col("since"))
    last = held.groupBy(*by).agg(F.max(day).alias(day)).select(
        *by, day, F.lit(0).cast("long").alias("committer_id"), *[F.lit(0).cast("long").alias(d) for d in DELTAS]
    )
    rows = old.select(*columns).unionByName(last.select(*columns)).unionByName(new.select(*columns))
    return _from(contribution_per_day(rows, by, day), wanted, by, day).select(*columns)


def open_items_from(
    stored: DataFrame, items: DataFrame, log: DataFrame, wanted: DataFrame, by: Sequence[str],
    as_of: AsOf = None, created: str = "created", closed: str = "closed", day: str = "day",
) -> DataFrame:
    """Rows of ``open_items_per_day`` from ``since`` on, counted on from the day before."""
    until = day_or_today(as_of)
    known = wanted.filter("start IS NOT NULL")
    spans = items.select(*by, F.col(created).alias("_from"), F.col(closed).alias("_to")).filter(
        "_from IS NOT NULL AND (_to IS NULL OR _from <= _to)"
    )
    steps = (
        spans.join(known, [*by])
        .select(
            *by, "since",
            F.explode(
                F.array(
                    F.struct(F.col("_from").alias("day"), F.lit(1).cast("long").alias("open_events")),
                    F.struct(F.col("_to").alias("day"), F.lit(-1).cast("long").alias("open_events")),
                )
            ).alias("_s"),
        )
        .filter("_s.day >= since")
        .select(*by, "_s.day", "_s.open_events")
    )
    dated = stored.select(*by, F.col("start").cast("date").alias("day"), "open_events")
    base = _before(dated, known, by, "day").withColumn("day", F.date_add("day", 1))
    begins = known.select(*by, F.col("since").alias("day"), F.lit(0).cast("long").alias("open_events"))
    changes = (
        steps.unionByName(base).unionByName(begins)
        .groupBy(*by, "day").agg(F.sum("open_events").alias("open_events"))
    )
    so_far = Window.partitionBy(*by).orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = changes.withColumn("open_events", F.sum("open_events").over(so_far)).filter(F.col("day") < until)
    daily = hold_until(counted, ["open_events"], by, F.date_sub(until, 1))
    told = daily.select(*by, day_start(F.col("day")).alias("start"), day_end(F.col("day")).alias("end"), "open_events")
    fresh = wanted.filter("start IS NULL").select(*by)
    whole = open_items_per_day(
        items.join(fresh, [*by], "left_semi"), log.join(fresh, [*by], "left_semi"), by, as_of,
        created=created, closed=closed, day=day,
    )
    return told.unionByName(whole)


def density_from(sizes: DataFrame, open_items: DataFrame, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of ``issue_density_per_day`` from ``since`` on; the day before opens them.

    ``sizes`` has its day in ``day``, ``open_items`` in ``start``.
    """
    def later(rows: DataFrame, day: str) -> DataFrame:
        old = (F.col("_start").isNotNull()) & (F.to_date(day) < F.date_sub("since", 1))
        bounds = wanted.withColumnRenamed("start", "_start")
        return rows.join(bounds, [*by]).filter(~old).select(*rows.columns)

    daily = issue_density_per_day(later(sizes, "day"), later(open_items, "start"), by)
    bounds = wanted.select(*by, "since")
    return daily.join(bounds, [*by]).filter(F.col("start") >= F.col("since")).select(*daily.columns)
