"""Landed commit records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.functions.references import co_author_emails, co_author_names
from repotide.functions.time import parse_instant
from repotide.schemas import REVISION, keyed


def read_revisions(
    spark: SparkSession, path: str, by: Mapping[str, T.DataType] | None = None
) -> DataFrame:
    """Commit records, one JSON text per line, with times as instants.

    Records without co-author lists get them from the trailers of the message.
    ``ordinal``, the place in the log, orders them within ``by``.
    """
    return _typed(_reader(spark.read, by).json(path))


def stream_revisions(
    spark: SparkSession, path: str, by: Mapping[str, T.DataType] | None = None
) -> DataFrame:
    """``read_revisions`` as a stream of the files that land in a folder."""
    return _typed(_reader(spark.readStream, by).json(path))


def _reader(reader, by: Mapping[str, T.DataType] | None):
    return reader.schema(keyed(by, REVISION)).option("mode", "FAILFAST")


def _typed(raw: DataFrame) -> DataFrame:
    return raw.select(
        *[
            {
                "authored_datetime": parse_instant(F.col("authored_datetime")),
                "committed_datetime": parse_instant(F.col("committed_datetime")),
                "co_authors": F.coalesce("co_authors", co_author_names(F.col("message"))),
                "co_author_emails": F.coalesce(
                    "co_author_emails", co_author_emails(F.col("message"))
                ),
            }
            .get(name, F.col(name))
            .alias(name)
            for name in raw.columns
        ]
    )


def co_author_rows(messages: DataFrame, key: str, message: str = "message") -> DataFrame:
    """One row per co-author trailer of a message, with its position."""
    names = co_author_names(F.col(message))
    emails = co_author_emails(F.col(message))
    people = F.arrays_zip(names.alias("name"), emails.alias("email"))
    return messages.select(key, F.posexplode(people).alias("pos", "_who")).select(
        key, "pos", "_who.name", "_who.email"
    )
