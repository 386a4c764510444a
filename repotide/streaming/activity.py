"""Daily activity per person on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def daily_activity(
    events: DataFrame, time: str, person: str, value: str, lateness: str = "1 hour"
) -> DataFrame:
    """Count and total per UTC day and person, for days the watermark has closed.

    Totals are added up as decimals of 18 places and so do not depend on arrival order.
    Rows behind the watermark are not counted; ``late_rows`` tells how many there were.
    """
    return (
        events.withColumn("_at", F.col(time).cast("timestamp"))
        .withWatermark("_at", lateness)
        .groupBy(F.window("_at", "1 day").alias("_day"), person)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col(value).cast("decimal(38,18)")).alias("total"),
        )
        .select(
            F.col("_day.start").cast("date").alias("day"),
            person,
            "n",
            F.col("total").cast("double").alias("total"),
        )
    )


def write_closed_days(daily: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append closed days to a Parquet table; each row is written once."""
    return (
        daily.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query's recent batches dropped behind the watermark."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
