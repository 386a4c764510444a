"""Landed files, stored tables, checks and streams."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.functions.references import references_json
from repotide.functions.time import parse_instant, utc_day
from repotide.operators.quality import require, violations
from repotide.plans import log, tracker
from repotide.schemas import LONG, TABLES, TEXT, struct
from repotide.sources import pages, revisions, sizes, tables
from repotide.streaming.activity import daily_activity, write_closed_days
from repotide.streaming.revisions import load_new_revisions
from repotide.warehouse import Warehouse

UTC = dt.timezone.utc


# --- time --------------------------------------------------------------------


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_days_are_utc_in_any_session_zone(spark, zone):
    rows = [("2024-01-01T23:30:00-05:00",), ("2024-01-01T00:30:00+02:00",), ("2024-01-01 23:59:59",),
            ("2024-01-01",), ("1969-12-31T23:59:59Z",), (None,)]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(rows, "text string").withColumn("at", parse_instant(F.col("text")))
        df = df.withColumn("wall", F.lit("2024-03-05 23:00:00").cast("timestamp_ntz"))
        got = df.select(utc_day(df, "at"), utc_day(df, "text"), utc_day(df, "wall")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    days = ["2024-01-02", "2023-12-31", "2024-01-01", "2024-01-01", "1969-12-31", None]
    want = [None if d is None else dt.date.fromisoformat(d) for d in days]
    assert [r[0] for r in got] == want
    assert [r[1] for r in got] == want
    assert {r[2] for r in got} == {dt.date(2024, 3, 5)}


# --- pages -------------------------------------------------------------------


def page(number, ids, total, last=False):
    edges = [{"node": {"id": i, "createdAt": "2024-01-01T10:00:00Z", "closedAt": None}} for i in ids]
    info = {"endCursor": f"c{number}", "hasNextPage": not last}
    content = {"totalCount": total, "edges": edges, "pageInfo": info}
    after = f"c{number - 1}" if number else None
    return {"page": number, "after": after, "data": {"repository": {"issues": content}}}


def land(folder, records, one_per_file=False):
    folder.mkdir()
    if one_per_file:
        for i, record in enumerate(records):
            (folder / f"{i}.json").write_text(json.dumps(record, indent=1))
    else:
        (folder / "pages.json").write_text("\n".join(json.dumps(r) for r in records))
    return str(folder)


@pytest.mark.parametrize("one_per_file", [False, True])
def test_items_of_pages(spark, tmp_path, one_per_file):
    landed = land(tmp_path / "p", [page(0, ["a", "b"], 3), page(1, ["c"], 3, True)], one_per_file)
    items = pages.page_items(pages.read_pages(spark, landed, "issues", one_per_file), "issues", "issue_id")
    assert sorted((r.page, r.pos, r.issue_id, r.closed_at) for r in items.collect()) == [
        (0, 0, "a", None), (0, 1, "b", None), (1, 0, "c", None),
    ]


def test_missing_pages(spark, tmp_path):
    def ids(start, n=100):
        return [f"i{start + i}" for i in range(n)]

    complete = [page(0, ids(0), 350), page(1, ids(100), 350), page(2, ids(200), 350), page(3, ids(300, 50), 350, True)]
    for name, kept, received, gaps in [
        ("all", [0, 1, 2, 3], 350, []),
        ("middle", [0, 2, 3], 250, ["c0"]),
        ("two", [0, 3], 150, ["c0"]),
        ("tail", [0, 1, 2], 300, ["c2"]),
        ("first", [1, 2, 3], 250, [None]),
    ]:
        read = pages.read_pages(spark, land(tmp_path / name, [complete[k] for k in kept]), "issues")
        assert tuple(pages.page_completeness(read, "issues").first()) == (350, received, 4 - len(kept))
        assert [r.cursor for r in pages.page_gaps(read, "issues").collect()] == gaps


def test_repeated_item_takes_the_last_id(spark, tmp_path):
    landed = land(tmp_path / "p", [page(0, ["a", "b"], 3), page(1, ["a"], 3, True)])
    items = pages.page_items(pages.read_pages(spark, landed, "issues"), "issues", "issue_id")
    ids = tracker.item_ids(items, "issue_id")
    assert sorted(map(tuple, ids.collect())) == [(0, "a"), (1, "b"), (2, "a")]
    facts = tracker.normalised_items(items, "issue_id", ids)
    assert sorted(r.issue_id_key for r in facts.collect()) == [1, 2, 2]


# --- sizes and revisions -------------------------------------------------------


def test_sizes_by_file_name(spark, tmp_path):
    header = "Language,Provider,Filename,Lines,Code,Comments,Blanks,Complexity,Bytes,ULOC"
    for commit, lines in [(7, 3), (12, 5)]:
        folder = tmp_path / "sizes" / f"commit-{commit}"
        folder.mkdir(parents=True)
        (folder / "size.csv").write_text(f"{header}\nPython,/srv/x/src/a.py,a.py,{lines},2,0,1,0,40,2\n")
    read = sizes.read_file_sizes(spark, str(tmp_path / "sizes/*"), "/srv/x/", r"commit-(\d+)/")
    assert sorted(map(tuple, read.collect())) == [
        (7, "Python", "src/a.py", 3, 2, 0, 1, 40), (12, "Python", "src/a.py", 5, 2, 0, 1, 40),
    ]


SIZE_ROW = {"Language": "C", "Provider": "p", "Lines": 1, "Code": 2, "Comments": 3, "Blanks": 4, "Bytes": 5}


def size_file(folder, name, columns, rows, commit="commit_hash"):
    folder.mkdir(exist_ok=True)
    text = [",".join(columns), *[",".join(str(({commit: name} | SIZE_ROW)[c]) for c in columns) for _ in range(rows)]]
    (folder / f"{name}.csv").write_text("\n".join(text) + "\n")


def test_sizes_by_name_whatever_the_order(spark, tmp_path):
    columns = ["commit_hash", *SIZE_ROW]
    size_file(tmp_path / "s", "h 1", columns, 2)
    size_file(tmp_path / "s", "h2", columns[::-1], 1)
    (tmp_path / "s" / "empty.csv").write_text("")
    read = sizes.read_file_sizes(spark, str(tmp_path / "s"), commit="commit_hash")
    want = [(name, "C", "p", 1, 2, 3, 4, 5) for name in ("h 1", "h 1", "h2")]
    assert sorted(map(tuple, read.collect())) == want
    named = sizes.read_file_sizes(spark, str(tmp_path / "s"), None, r"/(h\d)\.csv", commit="commit_hash")
    assert sorted(r.commit_hash for r in named.collect()) == ["", "", "h2"]


@pytest.mark.parametrize("row", ["h,C,p,1,2", "h,C,p,1,2,3,4,x", "h,C,p,1,2,3,4,99999999999999999999"])
def test_bad_size_rows_fail(spark, tmp_path, row):
    (tmp_path / "bad.csv").write_text("commit_hash,language,provider,lines,code,comments,blanks,bytes\n" + row + "\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        sizes.read_file_sizes(spark, str(tmp_path / "bad.csv"), commit="commit_hash").collect()


def test_size_file_without_header_fails(spark, tmp_path):
    size_file(tmp_path / "s", "good", ["commit_hash", *SIZE_ROW], 1)
    (tmp_path / "s" / "other.csv").write_text("h,C,p,1,2,3,4,5\n")
    with pytest.raises(ValueError, match="other.csv"):
        sizes.read_file_sizes(spark, str(tmp_path / "s"), commit="commit_hash")


def test_no_size_file_with_lines(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    read = sizes.read_file_sizes(spark, str(tmp_path / "empty.csv"))
    assert read.count() == 0 and read.columns[0] == "commit_hash_id"


def test_pages_by_repository(spark, tmp_path):
    records = [{"repo": 1, **page(0, ["a", "b"], 150)}, {"repo": 2, **page(0, [], 0, True)}]
    (tmp_path / "p.json").write_text("\n".join(json.dumps(r) for r in records))
    read = pages.read_pages(spark, str(tmp_path / "p.json"), "issues", by={"repo": T.LongType()})
    assert sorted(map(tuple, pages.page_completeness(read, "issues", ["repo"]).collect())) == [(1, 150, 2, 1), (2, 0, 0, 0)]
    assert [tuple(r) for r in pages.page_gaps(read, "issues", ["repo"]).collect()] == [(1, "c0")]
    assert sorted(r.repo for r in pages.page_items(read, "issues", "issue_id", ["repo"]).collect()) == [1, 1]


def test_revisions_take_co_authors_from_the_message(spark, tmp_path):
    message = "Fix\n\nCo-authored-by: Ann B <a@x>\nco-authored-by: No One <n@x>\nCo-authored-by: C <c@x>"
    record = {"commit_hash": "h", "committed_datetime": "2024-01-01T23:30:00-05:00",
              "authored_datetime": "2024-01-01T23:30:00+00:00", "message": message, "parents": ["p"]}
    (tmp_path / "log.json").write_text(json.dumps(record))
    row = revisions.read_revisions(spark, str(tmp_path / "log.json")).first()
    assert row.co_authors == ["Ann B", "C"] and row.co_author_emails == ["a@x", "c@x"]
    assert row.committed_datetime.astimezone(UTC) == dt.datetime(2024, 1, 2, 4, 30, tzinfo=UTC)
    people = revisions.co_author_rows(spark.createDataFrame([(1, message)], "k long, message string"), "k")
    assert sorted(map(tuple, people.collect())) == [(1, 0, "Ann B", "a@x"), (1, 1, "C", "c@x")]


# --- the normalised log ---------------------------------------------------------

RAW = [
    (0, "h0", "Ann", "a@x", [], []),
    (1, "h1", "Bob", "b@x", ["a@x"], ["h0"]),
    (2, "h2", "Anna", "a@x", ["b@x", "zz@x"], ["h1", "hX"]),
]


def raw_log(spark, rows=RAW, repo=None):
    made = spark.createDataFrame(
        rows,
        "seq long, commit_hash string, author string, author_email string,"
        " co_author_emails array<string>, parents array<string>",
    )
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("seq"))
    made = made.select(
        "*", F.col("author").alias("committer"), F.col("author_email").alias("committer_email"),
        at.alias("authored_datetime"), at.alias("committed_datetime"),
        F.lit("UTF-8").alias("encoding"), F.lit("m").alias("message"), F.lit(None).cast("string").alias("gpgsign"),
    )
    return made if repo is None else made.withColumn("repo", F.lit(repo).cast("long"))


def raw_tags(spark):
    return spark.createDataFrame([("v1", "h0"), ("v1b", "h0"), ("bad", None)], "tag string, commit_hash string")


WANT_LOGS = [
    (0, 0, '[{"author_email":null}]', '[{"commit_hash":null}]'),
    (1, 1, '[{"author_email":0}]', '[{"commit_hash":0}]'),
    (2, 0, '[{"author_email":1},{"author_email":null}]', '[{"commit_hash":1},{"commit_hash":null}]'),
]


def shown(logs):
    picked = logs.select(
        "commit_hash_id", "author_id",
        references_json(F.col("co_author_ids")), references_json(F.col("parent_hash_ids")),
    )
    return sorted(map(tuple, picked.collect()))


def test_normalised_log(spark, spread):
    parts = log.normalise(spread(raw_log(spark)), raw_tags(spark), ["seq"])
    assert sorted(map(tuple, parts["authors"].collect())) == [(0, "Ann", "a@x"), (1, "Bob", "b@x")]
    assert sorted(map(tuple, parts["commit_hashes"].collect())) == [(0, "h0"), (1, "h1"), (2, "h2")]
    assert shown(parts["commit_logs"]) == WANT_LOGS
    assert [r.commit_hash_id for r in parts["releases"].collect()] == [0, 0]


def test_log_in_parts(spark):
    first = log.normalise(raw_log(spark, RAW[:2]), raw_tags(spark), ["seq"])
    second = log.normalise(raw_log(spark), raw_tags(spark), ["seq"], stored=first)
    assert shown(second["commit_logs"]) == WANT_LOGS[2:]
    assert sorted(map(tuple, second["authors"].collect())) == [(0, "Ann", "a@x"), (1, "Bob", "b@x")]
    assert second["releases"].count() == 0


def test_warehouse_loads_are_repeatable(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path), {"repo": LONG}, "2024-01-05")
    tags = raw_tags(spark).withColumn("repo", F.lit(1).cast("long"))
    for rows in (RAW[:2], RAW, RAW):
        house.load_log(raw_log(spark, rows, repo=1), tags, ["seq"])
    assert shown(house.read("commit_logs")) == WANT_LOGS
    assert house.read("releases").count() == 2
    files = spark.createDataFrame(
        [(1, "h0", "Python", "a.py", 1, 1, 0, 0, 9), (1, "h2", "Python", "a.py", 4, 3, 1, 0, 30)],
        "repo long, commit_hash string, language string, provider string,"
        " lines long, code long, comments long, blanks long, bytes long",
    )
    for _ in range(2):
        house.load_file_sizes(files)
    house.project_size()
    house.project_productivity()
    house.bus_factor()
    items = spark.createDataFrame(
        [(1, 0, 0, "i", dt.datetime(2024, 1, 2, tzinfo=UTC), None)],
        "repo long, page long, pos long, issue_id string, created_at timestamp, closed_at timestamp",
    )
    house.load_issues(items)
    house.load_pull_requests(items.withColumnRenamed("issue_id", "pull_request_id"))
    house.issue_spoilage()
    house.pull_request_spoilage()
    house.issue_density()
    for name in TABLES:
        assert house.read(name).columns[0] == "repo"
    assert [r.open_events for r in house.read("pull_request_spoilage_per_day").orderBy("start").collect()] == [0, 1, 1, 1]
    density = house.read("issue_density_per_day").orderBy("start").collect()
    assert [(r.lines, r.open_events) for r in density] == [(4, 0), (4, 1), (4, 1), (4, 1), (4, 1)]
    bus_factor = sorted((r.committer_id, r.delta_lines) for r in house.read("bus_factor_per_day").collect())
    assert bus_factor == [(0, 3)]
    assert house.orphans().count() == 0
    files.select(
        "repo", F.lit(99).cast("long").alias("commit_hash_id"), *files.columns[2:]
    ).write.mode("append").parquet(f"{tmp_path}/file_size_per_commit")
    assert [tuple(r) for r in house.orphans().collect()] == [
        ("file_size_per_commit", "commit_hash_id", 1, 99)
    ]


def test_broken_off_load_is_done_again(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    house.load_log(raw_log(spark, RAW[:1]), raw_tags(spark), ["seq"])
    # hashes of a load that failed before its log was written
    spark.createDataFrame([(1, "h1"), (2, "h2")], "id long, commit_hash string").write.mode("append").parquet(
        f"{tmp_path}/commit_hashes"
    )
    house.load_log(raw_log(spark), raw_tags(spark), ["seq"])
    assert shown(house.read("commit_logs")) == WANT_LOGS
    assert house.read("commit_hashes").count() == 3


# --- stored tables ---------------------------------------------------------------


def numbers(spark, *values):
    return spark.createDataFrame([(v, f"row {v}") for v in values], "id long, text string")


def test_append_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    numbers(spark, 1, 2, 3).write.parquet(path)
    batch = numbers(spark, 3, 4, 4, 5).withColumn("text", F.lit("new"))
    for _ in range(2):
        assert tables.append_new_keys(batch, path, ["id"])
    got = sorted(map(tuple, spark.read.parquet(path).collect()))
    assert got == [(1, "row 1"), (2, "row 2"), (3, "row 3"), (4, "new"), (5, "new")]


@pytest.mark.parametrize("values, taken", [((4, 5), True), ((3, 4), False), ((4, 4), False)])
def test_append_of_whole_batch(spark, tmp_path, values, taken):
    path = str(tmp_path / "t")
    numbers(spark, 1, 2, 3).write.parquet(path)
    assert tables.append_new_keys(numbers(spark, *values), path, ["id"], whole_batch=True) is taken
    assert spark.read.parquet(path).count() == (5 if taken else 3)


def test_refresh_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.refresh(spark.createDataFrame([(1, 1), (2, 2)], "n long, repo long"), path, ["repo"])
    tables.refresh(spark.createDataFrame([(9, 2)], "n long, repo long"), path, ["repo"])
    assert sorted((r.repo, r.n) for r in spark.read.parquet(path).collect()) == [(1, 1), (2, 9)]


# --- checks ------------------------------------------------------------------------

MODEL = struct(n=LONG, text=TEXT, at=T.TimestampType(), note=TEXT, nullable=("note",))


def test_violations(spark):
    rows = [(1, "5", "a", "2024-01-01"), (2, "5.5", None, "2024-01-01T00:00:00Z"), (3, "x", "c", "soon"),
            (4, None, "d", None), (5, "7.0", "e", "2024-02-30")]
    suspect = spark.createDataFrame(rows, "k long, n string, text string, at string").withColumn("more", F.lit(1))
    got = sorted((r.k or 0, r.column, r.rule) for r in violations(suspect, MODEL, ["k"]).collect())
    assert got == [
        (0, "note", "missing"), (2, "n", "fraction"), (2, "text", "null"), (3, "at", "type"),
        (3, "n", "type"), (4, "at", "null"), (4, "n", "null"), (5, "at", "type"),
    ]


def test_require(spark):
    model = struct(n=LONG, text=TEXT)
    good = spark.createDataFrame([(1.0, "a", 0)], "n double, text string, more int")
    assert require(good, model).collect() == [(1, "a")]
    for row in [(1.5, "a", 0), (None, "a", 0), (1.0, None, 0)]:
        bad = spark.createDataFrame([row], "n double, text string, more int")
        with pytest.raises(Exception, match="breaks rule"):
            require(bad, model).collect()
    with pytest.raises(ValueError, match="missing"):
        require(good.drop("text"), model)


# --- streams -------------------------------------------------------------------------


def test_stream_lands_each_key_once(spark, tmp_path):
    source, target, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    numbers(spark, 1, 2).write.parquet(target)
    schema = numbers(spark, 1).schema
    for batch in [(2, 3, 3), (3, 4), (1, 5)]:
        numbers(spark, *batch).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        load_new_revisions(stream, target, state, ["id"]).awaitTermination()
    # a lost state folder makes the stream start over; nothing lands twice
    stream = spark.readStream.schema(schema).parquet(source)
    load_new_revisions(stream, target, f"{state}-2", ["id"]).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2, 3, 4, 5]


def test_stream_emits_closed_days_only(spark, tmp_path):
    source, target, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    rows = [(dt.datetime(2024, 1, d, h, tzinfo=UTC), d % 2, 0.1) for d in (1, 2, 3) for h in (0, 5, 23)]
    spark.createDataFrame(rows, "ts timestamp, who long, value double").write.parquet(source)
    stream = spark.readStream.schema("ts timestamp, who long, value double").parquet(source)
    daily = daily_activity(stream, "ts", "who", "value")
    write_closed_days(daily, target, state).awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(target).collect()))
    assert got == [(dt.date(2024, 1, 1), 1, 3, 0.3), (dt.date(2024, 1, 2), 0, 3, 0.3)]
