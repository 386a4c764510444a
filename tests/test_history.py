"""Chains and levels, page runs, quarantine, conflicts, and metrics brought up to date."""

from __future__ import annotations

import datetime
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.operators import chains
from repotide.operators.keys import constraint_report
from repotide.operators.quality import accepted_rows, land_checked, rejected_rows, require, violations
from repotide.plans import refresh
from repotide.sources import landing, pages, tables
from repotide.streaming.activity import daily_activity, late_rows
from repotide.warehouse import Warehouse

DAY = datetime.datetime(2024, 1, 1)


@pytest.fixture
def rounds(monkeypatch):
    """How many tables were pinned."""
    seen = []
    real = chains.pinned
    monkeypatch.setattr(chains, "pinned", lambda df: (seen.append(1), real(df))[1])
    return seen


# --- chains and levels --------------------------------------------------------------

def test_a_long_chain_takes_few_rounds(spark, rounds):
    links = spark.range(1000).select(
        F.lit(1).alias("repo"), F.col("id").alias("n"), F.when(F.col("id") > 0, F.col("id") - 1).alias("p")
    )
    found = {r["n"]: (r["root"], r["depth"]) for r in chains.depths(links, "n", "p", ["repo"]).collect()}
    assert found == {n: (0, n) for n in range(1000)}
    assert len(rounds) <= 12


def test_trees_and_cycles(spark):
    rows = [("a", None), ("b", "a"), ("c", "a"), ("d", "c"), ("x", "y"), ("y", "z"), ("z", "x"), ("w", "x"), ("s", "s")]
    links = spark.createDataFrame(rows, "n string, p string")
    found = {r["n"]: (r["root"], r["depth"]) for r in chains.depths(links, "n", "p").collect()}
    none = dict.fromkeys("xyzw", (None, None))
    assert found == {"a": ("a", 0), "b": ("a", 1), "c": ("a", 1), "d": ("a", 2), "s": (None, None)} | none


def levels_by_hand(parents):
    """Longest way to a root; None on or behind a cycle."""
    known = {}

    def level(n, above):
        if n in above:
            return None
        if n not in known:
            found = [level(p, above | {n}) for p in parents[n] if p in parents]
            known[n] = None if None in found else 1 + max(found, default=-1)
        return known[n]

    for n in parents:
        level(n, frozenset())
    return known


def history(spark, parents, repo=1):
    rows = [(repo, n, p, DAY + datetime.timedelta(hours=hash(n) % 7)) for n, p in parents.items()]
    return spark.createDataFrame(rows, "repo int, commit_hash string, parents array<string>, at timestamp")


@pytest.mark.parametrize("seed", [1, 2])
def test_levels_of_random_histories(spark, seed):
    rng = random.Random(seed)
    parents = {}
    for n in range(60):
        some = rng.sample(range(max(0, n - 9), n), min(n, rng.choice([0, 1, 1, 2, 3])))
        parents[f"h{n:02}"] = [f"h{p:02}" for p in some] + (["lost"] if rng.random() < 0.1 else [])
    found = chains.log_order(history(spark, parents), "at", ["repo"]).collect()
    assert {r["commit_hash"]: r["level"] for r in found} == levels_by_hand(parents)
    assert sorted(r["ordinal"] for r in found) == list(range(60))
    place = {r["commit_hash"]: r["ordinal"] for r in found}
    assert all(place[p] < place[n] for n, own in parents.items() for p in own if p in place)


def test_many_merges_of_longer_branches_settle_in_few_turns(spark, rounds):
    parents, last = {"m0": []}, "m0"
    for k in range(12):  # main gets one commit, the branch four
        branch = last
        for j in range(4):
            parents[f"b{k}_{j}"] = [branch]
            branch = f"b{k}_{j}"
        parents[f"a{k}"] = [last]
        parents[f"m{k + 1}"] = [f"a{k}", branch]
        last = f"m{k + 1}"
    found = {r["commit_hash"]: r["level"] for r in chains.log_order(history(spark, parents), "at", ["repo"]).collect()}
    assert found == levels_by_hand(parents) and found[last] == 60
    assert len(rounds) < 45  # a turn a merge would be over 100


def test_cycles_of_commits_are_reported(spark):
    parents = {"a": [], "b": ["a"], "c": ["b", "e"], "d": ["c"], "e": ["d"], "f": ["e", "a"], "g": ["a"]}
    rows = {r["commit_hash"]: r for r in chains.log_order(history(spark, parents), "at", ["repo"]).collect()}
    assert {n for n, r in rows.items() if r["level"] is None and r["ordinal"] is None} == set("cdef")
    assert [rows[n]["level"] for n in "abg"] == [0, 1, 1]


# --- pages ----------------------------------------------------------------------------

def landed(spark, tmp_path, rows, total=1000):
    """rows: (page, after, end or None)"""
    path = str(tmp_path / "pages")
    os.makedirs(path)
    with open(f"{path}/a.json", "w") as out:
        for page, after, end in rows:
            info = {"endCursor": end, "hasNextPage": end is not None}
            content = {"totalCount": total, "edges": [], "pageInfo": info}
            out.write(json.dumps({"page": page, "after": after, "data": {"repository": {"issues": content}}}) + "\n")
    return pages.read_pages(spark, path, pages.ISSUES)


def test_runs_of_lost_pages(spark, tmp_path):
    rows = [(1, "c0", "c1"), (2, "c1", "c2"), (2, "c1", "c2"), (5, "c4", "c5"), (6, "c5", "c6"),
            (50, "x", "y"), (51, "y", "x")]
    read = landed(spark, tmp_path, rows)
    chain = {(r["after"], r["run"], r["place"], r["in_cycle"]) for r in pages.page_chain(read, pages.ISSUES).collect()}
    assert chain == {("c0", "c0", 0, False), ("c1", "c0", 1, False), ("c4", "c4", 0, False), ("c5", "c4", 1, False),
                     ("x", None, None, True), ("y", None, None, True)}
    lost = {tuple(r) for r in pages.lost_pages(read, pages.ISSUES).collect()}
    assert lost == {(None, 0, 1), ("c2", 3, 2), ("c6", 7, 3)}


def test_pages_without_numbers_have_runs_of_unknown_length(spark, tmp_path):
    read = landed(spark, tmp_path, [(None, None, "c0"), (None, "c3", None)])
    assert {tuple(r) for r in pages.lost_pages(read, pages.ISSUES).collect()} == {("c0", None, None)}
    whole = landed(spark, tmp_path / "b", [(0, None, "c0"), (1, "c0", None)])
    assert pages.lost_pages(whole, pages.ISSUES).collect() == []


# --- rows that would change in silence --------------------------------------------------

@pytest.mark.parametrize("text, rule", [
    ("5.0000000001", "fraction"), ("5.000000000000000000000000001", "fraction"), ("5e-20", "fraction"),
    ("1.5e0", "fraction"), ("-0.1", "fraction"), ("1e3", None), ("12.000", None), (" 7 ", None), ("x", "type"),
])
def test_fractions_of_any_size(spark, text, rule):
    rows = spark.createDataFrame([(1, text)], "id int, v string")
    model = T.StructType([T.StructField("v", T.LongType(), True)])
    assert [r["rule"] for r in violations(rows, model, ["id"]).collect()] == ([rule] if rule else [])


@pytest.mark.parametrize("sql, rule", [
    ("timestamp '2024-01-01 23:59:59'", "time"), ("timestamp_ntz '2024-01-01 00:00:00.000001'", "time"),
    ("'2024-01-01 10:00:00'", "time"), ("timestamp '2024-01-01 00:00:00'", None), ("'2024-01-01'", None),
    ("date '2024-01-01'", None),
])
def test_times_of_day_are_not_cut_off(spark, sql, rule):
    rows = spark.range(1).select("id", F.expr(sql).alias("v"))
    model = T.StructType([T.StructField("v", T.DateType(), True)])
    assert [r["rule"] for r in violations(rows, model, ["id"]).collect()] == ([rule] if rule else [])
    if rule is None:
        assert require(rows, model).first()["v"] == datetime.date(2024, 1, 1)


def test_bad_rows_are_kept_apart_and_counted(spark, tmp_path):
    model = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("v", T.StringType(), True)])
    rows = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c"), ("2.5", None), ("4", None)], "k string, v string")
    done = land_checked(rows, model, str(tmp_path / "t"))
    assert (done.rows, done.rejected) == (5, 3)
    assert done.by_rule == {("k", "type"): 1, ("k", "null"): 1, ("k", "fraction"): 1}
    good = accepted_rows(spark, done.path, model)
    assert sorted((r["k"], r["v"]) for r in good.collect()) == [(1, "a"), (4, None)]
    bad = {json.loads(r["raw"]).get("k"): [tuple(x) for x in r["rules"]] for r in rejected_rows(spark, done.path, model).collect()}
    assert bad == {"x": [("k", "type")], None: [("k", "null")], "2.5": [("k", "fraction")]}
    with pytest.raises(ValueError, match="3 of 5 rows rejected"):
        land_checked(rows, model, str(tmp_path / "u"), most_rejected=0.5)


def test_keys_with_several_values(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, v string")
    with pytest.raises(Exception, match="several values for k = 2"):
        tables.append_new_keys(batch, path, ["k"])
    assert {tuple(r) for r in tables.conflicting_rows(batch, ["k"]).collect()} == {(2, "b"), (2, "c")}
    assert tables.append_new_keys(batch, path, ["k"], conflicts="leave")
    stored = spark.read.parquet(path)
    assert {tuple(r) for r in stored.collect()} == {(1, "a"), (None, "d")}
    later = spark.createDataFrame([(1, "a"), (None, "e"), (7, "x")], "k int, v string")
    assert [tuple(r) for r in tables.collisions(later, stored, ["k"]).collect()] == [(None, "e")]
    model = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType(), False)])
    with pytest.raises(Exception, match="column v breaks rule null"):
        tables.append_new_keys(spark.createDataFrame([(9, None)], "k int, v string"), path, ["k"], model=model)


def sizes(spark, *rows):
    names = "repo long, commit_hash_id long, language string, provider string, lines long, code long, comments long, blanks long, bytes long"
    return spark.createDataFrame([(1, c, "py", p, n, n, 0, 0, n) for c, p, n in rows], names)


def test_files_measured_otherwise(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"), {"repo": T.LongType()})
    with pytest.raises(Exception, match="several values"):
        house.load_file_sizes(sizes(spark, (0, "a", 10), (0, "a", 3)))
    house.load_file_sizes(sizes(spark, (0, "a", 10), (0, "a", 10)))
    house.load_file_sizes(sizes(spark, (0, "a", 10), (0, "b", 1)))
    again = sizes(spark, (0, "a", 77), (0, "c", 5))
    with pytest.raises(Exception, match="measured otherwise before: a"):
        house.load_file_sizes(again)
    assert [(r["provider"], r["lines"]) for r in house.remeasured(again).collect()] == [("a", 77)]
    assert sorted(r["provider"] for r in house.read("file_size_per_commit").collect()) == ["a", "b"]


def test_totals_of_small_values_and_late_rows(spark, tmp_path):
    rows = [(DAY, 1, 0.00001), (DAY, 1, 0.00002), (DAY + datetime.timedelta(days=3), 1, 1.0)]
    source = str(tmp_path / "in")
    spark.createDataFrame(rows, "ts timestamp, who long, v double").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema("ts timestamp, who long, v double").parquet(source)
    daily = daily_activity(stream, "ts", "who", "v")

    def run():
        query = (
            daily.writeStream.format("memory").queryName("small_totals").outputMode("append")
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return query

    assert late_rows(run()) == 0
    assert [r["total"] for r in spark.sql("SELECT * FROM small_totals").collect()] == [0.00003]


def test_lines_that_do_not_parse(spark, tmp_path):
    path = tmp_path / "log"
    path.mkdir()
    (path / "one.json").write_text('{"a": 1, "b": "x"}\n{"a": 2\n\n{"b": "y"}\n{"a": "z", "b": "w"}\n[1]\n')
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    lines = landing.read_lines(spark, str(path), schema, ["a"])
    assert [tuple(r) for r in landing.accepted(lines).collect()] == [(1, "x")]
    bad = {r["line"]: r["reason"] for r in landing.rejected(lines).collect()}
    assert bad == {'{"a": 2': "malformed", '{"b": "y"}': "missing a", '{"a": "z", "b": "w"}': "malformed", "[1]": "malformed"}
    assert all(r["file"].endswith("one.json") for r in landing.rejected(lines).collect())


def test_constraints_in_one_shuffle(spark, tmp_path):
    parent = spark.createDataFrame([(1, 0), (1, 1), (1, 1), (2, 0)], "repo int, id long")
    child = spark.createDataFrame([(1, 0), (1, 5), (1, 5), (2, 1), (2, None)], "repo int, ref long")
    report = constraint_report(
        {"p": parent, "c": child}, {"p": "id", "q": "id"}, [("c", "ref", "p"), ("c", "ref", "q")], ["repo"]
    )
    assert {tuple(r) for r in report.collect()} == {
        ("unique", "p", "id", 1, 1, 2), ("foreign", "c", "ref", 1, 5, 2), ("foreign", "c", "ref", 2, 1, 1)
    }
    plan = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1
    house = Warehouse(spark, str(tmp_path / "house"), {"repo": T.LongType()})
    house.load_file_sizes(sizes(spark, (0, "a", 10)))
    assert house.constraints().collect() == []  # its parents are not stored yet


# --- daily metrics brought up to date -----------------------------------------------------

REVISION = (
    "repo long, seq long, author string, author_email string, co_author_emails array<string>,"
    " commit_hash string, authored_datetime timestamp, committed_datetime timestamp,"
    " committer string, committer_email string, encoding string, message string, gpgsign string,"
    " parents array<string>"
)
ITEM = "repo long, page long, pos int, issue_id string, created_at timestamp, closed_at timestamp"
MEASURED = "repo long, commit_hash string, language string, provider string, lines long, code long, comments long, blanks long, bytes long"


def load(spark, house, rows, items):
    log = [(r, s, "a", "a@x", [], h, at, at, w, w + "@x", "UTF-8", "m", None, []) for r, s, h, at, w, _ in rows]
    log = spark.createDataFrame(log, REVISION)
    house.load_log(log, spark.createDataFrame([], "repo long, tag string, commit_hash string"), ["seq"])
    measured = [(r, h, "py", "f", n, n, 0, 0, n) for r, _, h, _, _, n in rows]
    house.load_file_sizes(spark.createDataFrame(measured, MEASURED))
    if items:
        house.load_issues(spark.createDataFrame(items, ITEM))


DAILY = ["project_size_per_day", "project_productivity_per_day", "bus_factor_per_day", "issue_spoilage_per_day", "issue_density_per_day"]


def build(house):
    for step in (house.project_size, house.project_productivity, house.bus_factor, house.issue_spoilage, house.issue_density):
        step()


def files_of(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


def test_refreshed_tables_equal_new_ones_and_leave_other_months_alone(spark, tmp_path):
    def at(day):
        return DAY + datetime.timedelta(days=day)

    by = {"repo": T.LongType()}
    first = [(1, 0, "a", at(0), "x", 10), (1, 1, "b", at(70), "y", 30), (2, 0, "c", at(5), "x", 7)]
    items = [(1, 0, 0, "i", at(2), None), (1, 0, 1, "j", at(40), at(45)), (2, 0, 0, "k", at(6), at(80))]
    # one repository goes on at an earlier day than its last, one is new, one stays
    later = [(1, 2, "d", at(66), "x", 25), (1, 3, "e", at(95), "y", 5), (3, 0, "f", at(50), "z", 9)]
    changed_items = [(1, 1, 0, "i", at(2), at(90)), (1, 1, 1, "l", at(99), None), (3, 0, 0, "m", at(60), None)]
    monthly = Warehouse(spark, str(tmp_path / "monthly"), by, "2024-04-05", monthly=True)
    load(spark, monthly, first, items)
    build(monthly)
    before = {name: files_of(f"{tmp_path}/monthly/{name}") for name in DAILY}

    whole = Warehouse(spark, str(tmp_path / "whole"), by, "2024-04-20")
    load(spark, whole, first, items)
    load(spark, whole, later, changed_items)
    build(whole)

    load(spark, monthly, later, changed_items)
    monthly.as_of = "2024-04-20"
    commits = spark.createDataFrame([(r, s.date()) for r, _, _, s, _, _ in later], "repo long, day date")
    spans = spark.createDataFrame(
        [(1, at(90).date()), (1, at(99).date()), (3, at(60).date())], "repo long, day date"
    )
    by_commit = refresh.touched(commits, ["day"], ["repo"])
    both = refresh.touched(commits.unionByName(spans), ["day"], ["repo"])
    monthly.refresh_size(by_commit)
    monthly.refresh_productivity(by_commit)
    monthly.refresh_bus_factor(by_commit)
    monthly.refresh_spoilage("issue", both)
    monthly.refresh_density(both)
    for name in DAILY:
        got, want = (sorted(map(repr, h.read(name).collect())) for h in (monthly, whole))
        assert got == want, name
        after = files_of(f"{tmp_path}/monthly/{name}")
        for path, time in before[name].items():
            if "_month=202401" in path:
                assert after.get(path) == time, path
    with pytest.raises(ValueError, match="by month"):
        whole.refresh_size(by_commit)
