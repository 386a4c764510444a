"""Productivity: absolute size change per commit, summed per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repotide.functions.time import AsOf, day_or_today
from repotide.operators.calendar import fill_constant
from repotide.operators.ordering import id_chunks, order_key, range_chunks, with_previous
from repotide.schemas import DELTAS, MEASURES


def productivity_per_commit(
    sizes: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    keep: Sequence[str] = (),
    dense: bool = False,
) -> DataFrame:
    """Absolute change of each measure against the previous measured commit.

    The first commit, and a change from or to null, count as 0. ``keep`` lists
    further columns to carry along, such as day and committer. ``dense`` says
    that the order is one column numbering the commits of ``by`` from 0, as
    the ids of the normalised log do.
    """
    slim = sizes.select(*dict.fromkeys([*by, *keep, *order, *MEASURES]))
    chunked = id_chunks(slim, order[0]) if dense else range_chunks(slim, order, by)
    compared = with_previous(chunked, MEASURES, by)
    return compared.select(
        *dict.fromkeys([*by, *keep, *order]),
        *[
            F.coalesce(F.abs(F.col(m) - F.col(f"previous_{m}")), F.lit(0)).alias(delta)
            for m, delta in zip(MEASURES, DELTAS)
        ],
    )


def productivity_per_day(
    changes: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    as_of: AsOf = None,
    day: str = "day",
) -> DataFrame:
    """Summed change per day from the first commit's day to ``as_of``; else 0."""
    key = order_key(order, [*by, day])
    daily = changes.groupBy(*by, day).agg(
        *[F.sum(d).alias(d) for d in DELTAS], F.min(key).alias("_first")
    )
    place = order_key([day, "_first"]) if day in order else F.col("_first")
    started = daily.withColumn("_start", F.min_by(day, place).over(Window.partitionBy(*by)))
    return fill_constant(
        started.filter(F.col(day) >= F.col("_start")), DELTAS, by, day_or_today(as_of), 0, day
    )
