"""Landed lines read once: what parses, and what does not with its reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CORRUPT, _ROW = "_corrupt", "_row"


def read_lines(
    spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = ()
) -> DataFrame:
    """One row per landed JSON line: file, line, reason and the record as ``_row``.

    ``reason`` is null for a good line, ``malformed`` where the text is no JSON record or a
    value does not fit its type, and ``missing <column>`` where a ``required`` value is not
    there. Empty lines are passed over. Use ``accepted`` and ``rejected`` on the result; a
    load that needs both writes it once, since each of them reads the files.
    """
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    told = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    row = F.from_json("line", told, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    parsed = raw.filter(F.trim("line") != "").withColumn(_ROW, row)
    reason = F.when(F.col(f"{_ROW}.{_CORRUPT}").isNotNull() | F.col(_ROW).isNull(), "malformed")
    for column in required:
        reason = reason.when(F.col(f"{_ROW}.{column}").isNull(), f"missing {column}")
    return parsed.select("file", "line", reason.alias("reason"), _ROW)


def accepted(lines: DataFrame) -> DataFrame:
    """The records of the good lines."""
    return lines.filter("reason IS NULL").select(f"{_ROW}.*").drop(_CORRUPT)


def rejected(lines: DataFrame) -> DataFrame:
    """file, line and reason of the others."""
    return lines.filter("reason IS NOT NULL").select("file", "line", "reason")
