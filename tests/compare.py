"""Compare registered queries with their SQL: columns, rows, values."""

from __future__ import annotations

import datetime
import math
import time
from collections import Counter
from pathlib import Path

import duckdb


def normal(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def oracle_rows(sf_dir: str, sql: str):
    with duckdb.connect() as connection:
        for path in sorted(Path(sf_dir).glob("*.parquet")):
            connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        result = connection.execute(sql)
        names = [column[0] for column in result.description]
        return names, result.fetchall()


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(
        tuple(normal(row[i]) for i in order) for row in rows
    )


def difference(spark, sf_dir, name, run, sql):
    """Empty text where both agree, else what differs."""
    began = time.time()
    frame = run(spark, sf_dir)
    mine = bag(frame.columns, frame.collect())
    took = time.time() - began
    theirs = bag(*oracle_rows(sf_dir, sql))
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}", took
    if mine[1] != theirs[1]:
        extra, lost = mine[1] - theirs[1], theirs[1] - mine[1]
        return (
            f"rows {mine[1].total()} / {theirs[1].total()}; only here {list(extra)[:3]};"
            f" only there {list(lost)[:3]}",
            took,
        )
    return "", took
