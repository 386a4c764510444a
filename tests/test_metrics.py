"""Worked examples for the metrics, in every data layout."""

from __future__ import annotations

import datetime as dt

import pytest

from repotide.plans import contribution, open_items, productivity, size
from repotide.schemas import DELTAS, MEASURES

ORDER = ["commit_id"]
AS_OF = "2024-01-05"


def day(text):
    return dt.date.fromisoformat(text)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


FILES = "commit_id long, provider string, " + ", ".join(f"{m} long" for m in MEASURES)
SIZES = "commit_id long, day date, committer_id long, " + ", ".join(f"{m} long" for m in MEASURES)


@pytest.fixture
def log(spark, spread):
    rows = [
        (0, day("2024-01-01"), 0),
        (1, day("2024-01-01"), 1),
        (2, day("2024-01-02"), 1),
        (3, day("2024-01-04"), 0),
    ]
    return spread(frame(spark, rows, "commit_id long, day date, committer_id long"))


@pytest.fixture
def files(spark, spread):
    rows = [
        (0, "a.py", 10, 8, 1, 1, 100),
        (1, "a.py", 12, 9, 1, 2, 130),
        (1, "b.md", 5, 5, 0, 0, 40),
        (3, "a.py", 12, 9, 1, 2, 130),
    ]
    return spread(frame(spark, rows, FILES))


@pytest.fixture
def items(spark, spread):
    rows = [
        (day("2023-12-30"), None),
        (day("2024-01-01"), day("2024-01-01")),
        (day("2024-01-02"), day("2024-01-04")),
        (day("2024-01-05"), None),
    ]
    return spread(frame(spark, rows, "created date, closed date"))


def sized(files, log):
    return size.join_log(size.size_per_commit(files), log, ["commit_id"])


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_size_per_commit(files):
    assert rows_of(size.size_per_commit(files), "commit_id", *MEASURES) == [
        (0, 10, 8, 1, 1, 100),
        (1, 17, 14, 1, 2, 170),
        (3, 12, 9, 1, 2, 130),
    ]


def test_size_per_day(files, log):
    result = size.size_per_day(sized(files, log), ORDER, as_of=AS_OF)
    early, late = (17, 14, 1, 2, 170), (12, 9, 1, 2, 130)
    assert rows_of(result, "day", *MEASURES) == [
        (day("2024-01-01"), *early),
        (day("2024-01-02"), *early),
        (day("2024-01-03"), *early),
        (day("2024-01-04"), *late),
        (day("2024-01-05"), *late),
    ]


def changes(files, log):
    return productivity.productivity_per_commit(
        sized(files, log), ORDER, keep=["day", "committer_id"]
    )


def test_productivity_per_commit(files, log):
    assert rows_of(changes(files, log), "commit_id", *DELTAS) == [
        (0, 0, 0, 0, 0, 0),
        (1, 7, 6, 0, 1, 70),
        (3, 5, 5, 0, 0, 40),
    ]


def test_productivity_per_day(files, log):
    result = productivity.productivity_per_day(changes(files, log), ORDER, as_of=AS_OF)
    none = (0, 0, 0, 0, 0)
    assert rows_of(result, "day", *DELTAS) == [
        (day("2024-01-01"), 7, 6, 0, 1, 70),
        (day("2024-01-02"), *none),
        (day("2024-01-03"), *none),
        (day("2024-01-04"), 5, 5, 0, 0, 40),
        (day("2024-01-05"), *none),
    ]


def test_contribution_per_day(files, log):
    result = contribution.contribution_per_day(changes(files, log))
    assert rows_of(result, "day", "committer_id", *DELTAS) == [
        (day("2024-01-01"), 0, 0, 0, 0, 0, 0),
        (day("2024-01-01"), 1, 7, 6, 0, 1, 70),
        (day("2024-01-02"), -1, -1, -1, -1, -1, -1),
        (day("2024-01-03"), -1, -1, -1, -1, -1, -1),
        (day("2024-01-04"), 0, 5, 5, 0, 0, 40),
    ]


def test_contribution_of_nobody(spark):
    """A day whose only commits lack a committer is shown as a silent day."""
    rows = [(day("2024-01-01"), 7, 1), (day("2024-01-02"), None, 2), (day("2024-01-03"), None, 3),
            (day("2024-01-03"), 8, 4)]
    made = frame(spark, rows, "day date, committer_id long, d long")
    made = made.select("day", "committer_id", *[made.d.alias(name) for name in DELTAS])
    assert rows_of(contribution.contribution_per_day(made), "day", "committer_id", "delta_lines") == [
        (day("2024-01-01"), 7, 1),
        (day("2024-01-02"), -1, -1),
        (day("2024-01-03"), 8, 4),
    ]


def test_open_items_per_day(items, log):
    result = open_items.open_items_per_day(items, log, as_of=AS_OF)
    assert rows_of(result, "start", "end", "open_events") == [
        (dt.datetime(2024, 1, d), dt.datetime(2024, 1, d, 23, 59, 59), n)
        for d, n in [(1, 1), (2, 2), (3, 2), (4, 1)]
    ]


@pytest.mark.parametrize("form", ["from daily tables", "from steps"])
def test_issue_density_per_day(files, log, items, form):
    sizes = sized(files, log)
    if form == "from daily tables":
        result = open_items.issue_density_per_day(
            size.size_per_day(sizes, ORDER, as_of=AS_OF),
            open_items.open_items_per_day(items, log, as_of=AS_OF),
        )
    else:
        result = open_items.issue_density_from_steps(
            size.size_steps(sizes, ORDER),
            open_items.open_item_steps(items, log, as_of=AS_OF),
            as_of=AS_OF,
        )
    assert result.columns == ["start", *MEASURES, "end", "open_events"]
    assert rows_of(result, "start", "lines", "end", "open_events") == [
        (day("2024-01-01"), 17, day("2024-01-01"), 1),
        (day("2024-01-02"), 17, day("2024-01-02"), 2),
        (day("2024-01-03"), 17, day("2024-01-03"), 2),
        (day("2024-01-04"), 12, day("2024-01-04"), 1),
        (day("2024-01-05"), 12, day("2024-01-04"), 1),
    ]


def one_measure(spark, rows):
    made = frame(spark, rows, "commit_id long, day date, committer_id long, n long")
    return made.select(
        "commit_id", "day", "committer_id", *[made.n.alias(name) for name in MEASURES]
    )


def test_log_that_runs_backwards(spark):
    """The first commit decides the start, the last in commit order the day."""
    rows = [
        (0, day("2024-01-03"), 0, 5),
        (1, day("2024-01-01"), 0, 6),
        (2, day("2024-01-04"), 0, 7),
        (3, day("2024-01-03"), 0, 8),
    ]
    sizes = one_measure(spark, rows)
    # the 3rd survives with commit 3, so the first surviving row is commit 1
    assert rows_of(size.size_per_day(sizes, ORDER, as_of=AS_OF), "day", "lines") == [
        (day("2024-01-01"), 6), (day("2024-01-02"), 6), (day("2024-01-03"), 8),
        (day("2024-01-04"), 7), (day("2024-01-05"), 7),
    ]
    made = productivity.productivity_per_commit(sizes, ORDER, keep=["day"])
    # productivity starts at the day of commit 0 and loses the 1st
    assert rows_of(productivity.productivity_per_day(made, ORDER, as_of=AS_OF), "day", "delta_lines") == [
        (day("2024-01-03"), 1), (day("2024-01-04"), 1), (day("2024-01-05"), 0),
    ]


def test_as_of_before_the_first_day_gives_nothing(files, log, items):
    early = "2023-12-01"
    assert size.size_per_day(sized(files, log), ORDER, as_of=early).count() == 0
    assert productivity.productivity_per_day(changes(files, log), ORDER, as_of=early).count() == 0
    assert open_items.open_items_per_day(items, log, as_of=early).count() == 0


def test_as_of_is_today_in_utc_by_default(spark):
    today = dt.datetime.now(dt.timezone.utc).date()
    sizes = one_measure(spark, [(0, today - dt.timedelta(days=2), 0, 5)])
    days = [r.day for r in size.size_per_day(sizes, ORDER).collect()]
    assert max(days) in (today, today + dt.timedelta(days=1)) and len(days) in (3, 4)


def test_single_commit(spark, log):
    sizes = one_measure(spark, [(0, day("2024-01-04"), 0, 5)])
    assert rows_of(productivity.productivity_per_commit(sizes, ORDER), "commit_id", "delta_lines") == [(0, 0)]
    assert rows_of(size.size_per_day(sizes, ORDER, as_of=AS_OF), "day", "lines") == [
        (day("2024-01-04"), 5), (day("2024-01-05"), 5),
    ]


def test_item_closed_before_it_was_created_is_left_out(spark, log):
    wrong = frame(spark, [(day("2024-01-03"), day("2024-01-01"))], "created date, closed date")
    result = open_items.open_items_per_day(wrong, log, as_of=AS_OF)
    assert {r.open_events for r in result.collect()} == {0}


def test_ratio_without_lines(spark):
    density = frame(
        spark,
        [(day("2024-01-01"), 0, 3), (day("2024-01-02"), 2000, 3), (day("2024-01-03"), 5, None)],
        "start date, lines long, open_events long",
    )
    result = open_items.issue_density_ratio(density)
    assert rows_of(result, "start", "open_per_kline") == [
        (day("2024-01-01"), None), (day("2024-01-02"), 1.5), (day("2024-01-03"), None),
    ]
