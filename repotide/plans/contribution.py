"""Contribution of each committer per day (the "bus factor" table)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.operators.calendar import missing_days
from repotide.schemas import DELTAS

NOBODY = -1


def contribution_per_day(
    changes: DataFrame, by: Sequence[str] = (), day: str = "day", committer: str = "committer_id"
) -> DataFrame:
    """Summed absolute change per day and committer.

    A day without commits between the first and the last active day gives one
    row in which committer and all changes are -1. Commits without a committer
    make a day active but are not listed; a day with nothing else gets that
    row, too.
    """
    keys = [*by, day]
    sums = changes.groupBy(*keys, committer).agg(*[F.sum(F.abs(d)).alias(d) for d in DELTAS])
    listed = sums.filter(F.col(committer).isNotNull())
    active = sums.groupBy(*keys).agg(F.count(committer).alias("_committers"))
    silent = missing_days(active, by, day).unionByName(
        active.filter("_committers = 0").select(*keys)
    )
    return listed.unionByName(
        silent.select(
            *keys,
            F.lit(NOBODY).cast(changes.schema[committer].dataType).alias(committer),
            *[F.lit(NOBODY).cast("long").alias(d) for d in DELTAS],
        )
    )
