"""Every registered query gives the same rows as its SQL."""

from __future__ import annotations

import pytest
from compare import difference

import __spark_entry__ as entry
from repotide.catalog.oracle import ORACLE_SQL
from repotide.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(entry.queries()) >= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, name):
    problem, _ = difference(spark, SF_DIR, name, QUERIES[name], ORACLE_SQL[name])
    assert problem == ""


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == [
        "repo", "start", "lines", "code", "comments", "blanks", "bytes", "end", "open_events",
    ]
    assert result.count() > 0
