"""The normalised commit log: dimensions, references, releases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.operators.keys import dimension, lookup, lookup_list, no_references, without_known
from repotide.session import pinned


# What the ids of a log are worked out from.
_NARROW = [
    "commit_hash",
    "author",
    "author_email",
    "committer",
    "committer_email",
    "co_author_emails",
    "parents",
]
# What a log row carries along unchanged.
_CARRIED = ["authored_datetime", "committed_datetime", "encoding", "message", "gpgsign"]


def new_revisions(
    revisions: DataFrame, stored_hashes: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Revisions whose hash is not stored yet."""
    return without_known(revisions, stored_hashes, [*by, "commit_hash"])


def fresh_revisions(
    revisions: DataFrame, loaded: DataFrame | None, order: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """The narrow columns of the revisions to load.

    They feed all dimensions and lookups, so what is left of a comparison with
    the ``loaded`` hashes is pinned and not worked out again.
    """
    narrow = revisions.select(*dict.fromkeys([*by, *_NARROW, *order]))
    if loaded is None:
        return narrow
    return pinned(new_revisions(narrow, loaded, by))


def loaded_hashes(
    hashes: DataFrame, logs: DataFrame | None, by: Sequence[str] = ()
) -> DataFrame:
    """Stored hashes that have a log row; a broken-off load may leave some without."""
    if logs is None:
        return hashes
    logged = logs.select(*by, F.col("commit_hash_id").alias("id"))
    return hashes.join(logged, [*by, "id"], "left_semi")


def releases(tags: DataFrame, hashes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Commit ids of all tags that resolve to a known commit, one row per tag."""
    resolved = tags.filter(F.col("commit_hash").isNotNull())
    found = lookup(resolved, "commit_hash", hashes, "commit_hash", "commit_hash_id", by, unique=True)
    return found.select(*by, "commit_hash_id").na.drop("any")


def new_releases(
    tags: DataFrame, hashes: DataFrame, stored_hashes: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Releases on commits that were not stored before this run."""
    return releases(without_known(tags, stored_hashes, [*by, "commit_hash"]), hashes, by)


def commit_edges(revisions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per commit and parent, with the parent's position."""
    return revisions.select(
        *by, "commit_hash", F.posexplode("parents").alias("pos", "parent_hash")
    )


def commit_logs(
    revisions: DataFrame,
    hashes: DataFrame,
    authors: DataFrame,
    committers: DataFrame,
    by: Sequence[str] = (),
    wide: DataFrame | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Revisions with ids in place of hashes and people.

    Times and messages come from ``wide``, which may hold further revisions;
    left out, ``revisions`` has them itself. ``distinct`` says that no hash repeats
    in ``revisions``, so commits without references need not be moved for them.
    """
    wide = revisions if wide is None else wide
    keys = [*by, "commit_hash"]
    log = revisions.select(*keys, "author_email", "committer_email")
    log = lookup(log, "author_email", authors, "author_email", "author_id", by, unique=True)
    log = lookup(log, "committer_email", committers, "committer_email", "committer_id", by, unique=True)
    log = lookup(log, "commit_hash", hashes, "commit_hash", "commit_hash_id", by, unique=True)
    ids = ["commit_hash_id", "author_id", "committer_id", "co_author_ids", "parent_hash_ids"]
    people = ("co_author_emails", authors, "author_email", "co_author_ids")
    origins = ("parents", hashes, "commit_hash", "parent_hash_ids")
    for column, dim, value, out in (people, origins):
        listed = lookup_list(revisions, keys, column, dim, value, out, by, unique=True, empty=not distinct)
        log = log.join(listed, keys, "left" if distinct else "inner")
        if distinct:
            log = log.withColumn(out, F.coalesce(out, no_references(value)))
    narrow = log.select(*keys, *ids)
    # messages are wide: they are moved once, past all lookups
    carried = [c for c in _CARRIED if c in wide.columns]
    return wide.select(*keys, *carried).join(narrow, keys).select(*by, *ids, *carried)


def normalise(
    revisions: DataFrame,
    tags: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    stored: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The five tables of a log.

    ``order`` is the oldest-to-newest order of the revisions, which like their
    hashes is unique within ``by``. Given the ``stored`` tables, only unknown revisions are processed,
    stored ids stay, and parents and people resolve against stored and new
    rows alike, so loading a log in parts equals loading it at once.
    ``commit_logs`` and ``releases`` hold the new rows only; the dimensions
    hold all rows. With stored ``commit_logs`` a revision counts as known only
    if it has a row there, not by its hash alone.
    """
    stored = stored or {}
    known = stored.get("commit_hashes")
    loaded = None if known is None else loaded_hashes(known, stored.get("commit_logs"), by)
    fresh = fresh_revisions(revisions, loaded, order, by)
    hashes = dimension(fresh, "commit_hash", [], order, by, known, distinct=True)
    authors = dimension(fresh, "author_email", ["author"], order, by, stored.get("authors"))
    committers = dimension(
        fresh, "committer_email", ["committer"], order, by, stored.get("committers")
    )
    return {
        "commit_hashes": hashes,
        "authors": authors,
        "committers": committers,
        "commit_logs": commit_logs(fresh, hashes, authors, committers, by, wide=revisions),
        "releases": releases(tags, hashes, by)
        if loaded is None
        else new_releases(tags, hashes, loaded, by),
    }
