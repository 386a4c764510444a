"""Expressions on references: JSON form and trailers of a commit message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the trailer line that names a co-author. Only a newline ends a
# line, hence the d flag.
CO_AUTHOR_LINE = r"(?md)^Co-authored-by: (.*) <(.*?)>$"


def references_json(references: Column) -> Column:
    """Reference list as JSON text, unknown references as explicit nulls."""
    return F.to_json(references, {"ignoreNullFields": "false"})


def co_author_names(message: Column) -> Column:
    return F.regexp_extract_all(message, F.lit(CO_AUTHOR_LINE), F.lit(1))


def co_author_emails(message: Column) -> Column:
    return F.regexp_extract_all(message, F.lit(CO_AUTHOR_LINE), F.lit(2))
