"""Declared schemas of the stored tables and of the landed raw records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

MEASURES = ["lines", "code", "comments", "blanks", "bytes"]
DELTAS = [f"delta_{name}" for name in MEASURES]

LONG, TEXT, DAY = T.LongType(), T.StringType(), T.DateType()
INSTANT, WALL_CLOCK = T.TimestampType(), T.TimestampNTZType()


def struct(*, nullable: tuple[str, ...] = (), **columns: T.DataType) -> T.StructType:
    """A schema in which only the columns named in ``nullable`` may be null."""
    return T.StructType(
        [T.StructField(name, kind, name in nullable) for name, kind in columns.items()]
    )


def _references(key: str) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(key, LONG)]))


_SIZES = dict.fromkeys(MEASURES, LONG)
_CHANGES = dict.fromkeys(DELTAS, LONG)
_OPEN = {"start": WALL_CLOCK, "end": WALL_CLOCK, "open_events": LONG}
_ITEM = {"created_at": INSTANT, "closed_at": INSTANT}

# Table and column names of the stored tables. Running ids are
# kept where other tables refer to them; elsewhere commit, path or day tell
# rows apart, and numbering them would sort the largest tables for nothing.
# Reference lists are native arrays; JSON text is made only at the edge. An
# open item has no closing time, most commits carry no signature, and days
# before the first item have no count, so those columns may be null.
TABLES: dict[str, T.StructType] = {
    "commit_hashes": struct(id=LONG, commit_hash=TEXT),
    "releases": struct(commit_hash_id=LONG),
    "authors": struct(id=LONG, author=TEXT, author_email=TEXT),
    "committers": struct(id=LONG, committer=TEXT, committer_email=TEXT),
    "commit_logs": struct(
        commit_hash_id=LONG,
        author_id=LONG,
        committer_id=LONG,
        co_author_ids=_references("author_email"),
        parent_hash_ids=_references("commit_hash"),
        authored_datetime=INSTANT,
        committed_datetime=INSTANT,
        encoding=TEXT,
        message=TEXT,
        gpgsign=TEXT,
        nullable=("gpgsign",),
    ),
    "file_size_per_commit": struct(
        commit_hash_id=LONG, language=TEXT, provider=TEXT, **_SIZES
    ),
    "project_size_per_commit": struct(commit_hash_id=LONG, **_SIZES),
    "project_size_per_day": struct(date=DAY, **_SIZES),
    "project_productivity_per_commit": struct(commit_hash_id=LONG, **_CHANGES),
    "project_productivity_per_day": struct(date=DAY, **_CHANGES),
    "bus_factor_per_day": struct(committer_id=LONG, date=DAY, **_CHANGES),
    "issue_ids": struct(id=LONG, issue_id=TEXT),
    "issues": struct(issue_id_key=LONG, **_ITEM, nullable=("closed_at",)),
    "pull_request_ids": struct(id=LONG, pull_request_id=TEXT),
    "pull_requests": struct(pull_request_id_key=LONG, **_ITEM, nullable=("closed_at",)),
    "issue_spoilage_per_day": struct(**_OPEN),
    "pull_request_spoilage_per_day": struct(**_OPEN),
    "issue_density_per_day": struct(
        start=DAY, **_SIZES, end=DAY, open_events=LONG, nullable=("end", "open_events")
    ),
}

# References between stored tables (table, column, table whose
# id it holds).
FOREIGN_KEYS = [
    ("releases", "commit_hash_id", "commit_hashes"),
    ("bus_factor_per_day", "committer_id", "committers"),
    ("commit_logs", "commit_hash_id", "commit_hashes"),
    ("commit_logs", "author_id", "authors"),
    ("commit_logs", "committer_id", "committers"),
    ("file_size_per_commit", "commit_hash_id", "commit_hashes"),
    ("issues", "issue_id_key", "issue_ids"),
    ("pull_requests", "pull_request_id_key", "pull_request_ids"),
    ("project_productivity_per_commit", "commit_hash_id", "commit_hashes"),
    ("project_size_per_commit", "commit_hash_id", "commit_hashes"),
]

_LIST = T.ArrayType(TEXT)

# Field names of landed commits and pages. One commit as landed;
# times are ISO text with an offset, ``ordinal`` is its place in the log.
REVISION = T.StructType(
    [
        T.StructField("author", TEXT),
        T.StructField("author_email", TEXT),
        T.StructField("authored_datetime", TEXT),
        T.StructField("co_authors", _LIST),
        T.StructField("co_author_emails", _LIST),
        T.StructField("commit_hash", TEXT),
        T.StructField("committed_datetime", TEXT),
        T.StructField("committer", TEXT),
        T.StructField("committer_email", TEXT),
        T.StructField("encoding", TEXT),
        T.StructField("message", TEXT),
        T.StructField("gpgsign", TEXT),
        T.StructField("parents", _LIST),
        T.StructField("ordinal", LONG),
    ]
)


def keyed(by: Mapping[str, T.DataType] | None, schema: T.StructType) -> T.StructType:
    """``schema`` after the columns that tell repositories apart."""
    own = [T.StructField(name, kind) for name, kind in (by or {}).items()]
    return T.StructType([*own, *schema.fields])


def page_schema(field: str) -> T.StructType:
    """One landed API page; ``field`` is ``issues`` or ``pullRequests``.

    ``page`` and ``after`` are written by whoever lands the pages: the running
    number of the request and the cursor it asked for.
    """
    node = T.StructType().add("id", TEXT).add("createdAt", TEXT).add("closedAt", TEXT)
    info = T.StructType().add("endCursor", TEXT).add("hasNextPage", T.BooleanType())
    content = (
        T.StructType()
        .add("totalCount", LONG)
        .add("edges", T.ArrayType(T.StructType().add("node", node)))
        .add("pageInfo", info)
    )
    repository = T.StructType().add(field, content)
    data = T.StructType().add("repository", repository)
    return T.StructType().add("page", LONG).add("after", TEXT).add("data", data)
