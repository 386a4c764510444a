"""Sizes and log joined while both still land."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def once(stream: DataFrame, keys: Sequence[str], time: str, lateness: str) -> DataFrame:
    """Records that land again within ``lateness`` of their first landing count once."""
    timed = stream.withWatermark(time, lateness)
    return timed.dropDuplicatesWithinWatermark(list(keys))


def size_log_join(
    sizes: DataFrame,
    log: DataFrame,
    on: Sequence[str],
    measured: str,
    committed: str,
    apart: str,
    lateness: str = "1 day",
) -> DataFrame:
    """Each commit's size with its log row, as soon as both have landed.

    A size is measured at its commit's instant or up to ``apart`` after it. Log rows are
    therefore held until the watermark is ``apart`` past them, sizes until it reaches them;
    state grows with that span, not with the history. Both streams may repeat a record
    within ``lateness``. Rows without a counterpart in the span come to nothing, as do rows
    behind the watermark, which ``streaming.activity.late_rows`` counts.
    """
    left = once(sizes, on, measured, lateness)
    right = once(log, on, committed, lateness)
    right = right.select(*[F.col(c).alias(f"_log_{c}") if c in on else F.col(c) for c in right.columns])
    same = [F.col(c) == F.col(f"_log_{c}") for c in on]
    span = F.col(measured).between(F.col(committed), F.col(committed) + F.expr(f"INTERVAL {apart}"))
    condition = span
    for part in same:
        condition = condition & part
    joined = left.join(right, condition, "inner")
    return joined.drop(*[f"_log_{c}" for c in on])


# Whether state counts its rows: it then looks each row up before it puts or drops it.
COUNTED = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


def write_joined(joined: DataFrame, target: str, checkpoint: str, counted: bool = True):
    """Append the joined rows to a Parquet table, each once, until all that landed is read.

    Without ``counted`` the query's progress does not tell how many rows its state holds.
    """
    conf = joined.sparkSession.conf
    before = conf.get(COUNTED, None)
    conf.set(COUNTED, str(counted).lower())
    try:  # a query keeps the settings it was started with
        return (
            joined.writeStream.format("parquet")
            .option("path", target)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        if before is None:
            conf.unset(COUNTED)
        else:
            conf.set(COUNTED, before)
