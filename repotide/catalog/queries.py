"""Every operator and metric as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide import bindings as b
from repotide.functions.references import references_json
from repotide.functions.text import MARKUP, CommentRule, measure_texts
from repotide.functions.time import day_or_today, utc_day
from repotide.operators.calendar import align, calendar
from repotide.operators.chains import log_order
from repotide.operators.keys import constraint_report, dimension, lookup, lookup_list, orphans
from repotide.operators.ordering import dense_ids, range_chunks
from repotide.operators.quality import accepted_rows, land_checked, rejected_rows, violations
from repotide.plans import contribution, log, open_items, productivity, refresh, size, tracker
from repotide.schemas import MEASURES, REVISION, TABLES
from repotide.session import configure, pinned, scratch_path
from repotide.sources import landing, pages, revisions, sizes, tables
from repotide.sources.clustered import append_by_folder, read_by_folder
from repotide.streaming import activity
from repotide.streaming import sizes as size_stream
from repotide.streaming.revisions import load_new_revisions
from repotide.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), sf_dir)

    QUERIES[run.__name__] = configured
    return run


# --- scans, sources, sinks ------------------------------------------------

@query
def scan_table(spark, sf_dir):
    return tables.scan_table(
        spark, f"{sf_dir}/customer.parquet", b.GIVEN["customer"], checked=True
    )


@query
def sql_query(spark, sf_dir):
    columns = ", ".join(f"s.{m}" for m in MEASURES)
    return tables.sql_query(
        spark,
        f"SELECT l.repo, s.commit_id, l.day, {columns}"
        " FROM project_size s JOIN commit_log l ON s.commit_id = l.commit_id",
        {"project_size": size_per_commit(spark, sf_dir), "commit_log": b.commit_log(spark, sf_dir)},
    )


@query
def append_new_keys(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("commit_id"), "o_orderstatus", "o_totalprice"
    )
    path = scratch_path(spark, "orders")
    orders.filter("o_orderstatus <> 'O'").write.parquet(path)
    # the partly shipped orders are stored already, with another price
    batch = orders.filter("o_orderstatus <> 'F'").withColumn("o_totalprice", F.lit(0.0))
    tables.append_new_keys(batch, path, ["commit_id"])
    return spark.read.schema(orders.schema).parquet(path)


@query
def union_sources(spark, sf_dir):
    files = b.file_size(spark, sf_dir)
    known = ["A", "N", "R"]
    slices = [files.filter(F.col("language") == flag) for flag in known]
    slices.append(files.filter(~F.coalesce(F.col("language").isin(known), F.lit(False))))
    return tables.union_sources(slices).select("commit_id", "provider", *MEASURES)


@query
def file_size_ingest(spark, sf_dir):
    root = "/srv/checkout"
    path = b.land_file_sizes(spark, sf_dir, root)
    return sizes.read_file_sizes(spark, path, root).withColumnRenamed("commit_hash_id", "commit_id")


@query
def revision_scan(spark, sf_dir):
    raw = revisions.read_revisions(spark, b.land_revisions(spark, sf_dir))
    return raw.select(
        "commit_hash", "committed_datetime", F.size("parents").cast("long").alias("n_parents")
    )


def _items(spark, sf_dir, field, id_column):
    return pages.page_items(
        pages.read_pages(spark, b.land_pages(spark, sf_dir, field), field), field, id_column
    )


@query
def issues_from_pages(spark, sf_dir):
    items = _items(spark, sf_dir, pages.ISSUES, "issue_id")
    return items.select("issue_id", "created_at", "closed_at")


@query
def pull_requests_from_pages(spark, sf_dir):
    items = _items(spark, sf_dir, pages.PULL_REQUESTS, "pull_request_id")
    return items.select("pull_request_id", "created_at", "closed_at")


@query
def page_completeness(spark, sf_dir):
    path = b.land_pages(spark, sf_dir, pages.ISSUES, lossy=True)
    return pages.page_completeness(pages.read_pages(spark, path, pages.ISSUES), pages.ISSUES)


@query
def page_gaps(spark, sf_dir):
    path = b.land_pages(spark, sf_dir, pages.ISSUES, lossy=True)
    return pages.page_gaps(pages.read_pages(spark, path, pages.ISSUES), pages.ISSUES)


@query
def text_size(spark, sf_dir):
    documents = b.table(spark, sf_dir, "documents").select("doc_id", "text")
    rule = CommentRule(line=("#", "//"))
    return measure_texts(documents, "text", rule).drop("text")


@query
def text_size_blocks(spark, sf_dir):
    # pages are nearly single-line, so each tag gets a line of its own
    html = b.table(spark, sf_dir, "pages").select(
        "page_id", F.replace(F.col("html"), F.lit("<"), F.lit("\n<")).alias("html")
    )
    return measure_texts(html, "html", MARKUP).drop("html")


# --- calendar -------------------------------------------------------------


@query
def day_bucket(spark, sf_dir):
    events = b.table(spark, sf_dir, "events")
    return events.select("event_id", utc_day(events, "ts").alias("day"))


@query
def project_start(spark, sf_dir):
    return open_items.project_start(b.commit_log(spark, sf_dir), b.REPO)


@query
def calendar_spine(spark, sf_dir):
    return calendar(project_start(spark, sf_dir), "start", day_or_today(b.ORDERS_AS_OF), b.REPO)


@query
def calendar_align(spark, sf_dir):
    commits = b.commit_log(spark, sf_dir).groupBy("repo", "day").agg(F.count("*").alias("commits"))
    return align(calendar_spine(spark, sf_dir), commits, b.REPO)


@query
def revision_count(spark, sf_dir):
    return b.commit_log(spark, sf_dir).groupBy("repo").agg(F.count("*").alias("revisions"))


# --- size and productivity ------------------------------------------------


@query
def size_per_commit(spark, sf_dir):
    return size.size_per_commit(b.file_size(spark, sf_dir))


@query
def size_commit_log_join(spark, sf_dir):
    joined = size.join_log(size_per_commit(spark, sf_dir), b.commit_log(spark, sf_dir), ["commit_id"])
    return joined.select("repo", "commit_id", "committer_id", "day", *MEASURES)


@query
def last_of_day(spark, sf_dir):
    return size.last_of_day(size_commit_log_join(spark, sf_dir), b.LOG_ORDER, b.REPO).drop("_last")


@query
def size_per_day(spark, sf_dir):
    return size.size_per_day(
        size_commit_log_join(spark, sf_dir), b.LOG_ORDER, b.REPO, b.ORDERS_AS_OF
    )


def _changes(spark, sf_dir):
    return productivity.productivity_per_commit(
        size_commit_log_join(spark, sf_dir), b.LOG_ORDER, b.REPO, keep=["committer_id"]
    )


@query
def productivity_per_commit(spark, sf_dir):
    return _changes(spark, sf_dir).drop("day", "committer_id")


@query
def productivity_one_project(spark, sf_dir):
    """All commits as one project: the form without a repository key."""
    changes = productivity.productivity_per_commit(
        size_commit_log_join(spark, sf_dir), b.LOG_ORDER
    )
    return changes.drop("day")


@query
def productivity_per_day(spark, sf_dir):
    return productivity.productivity_per_day(
        _changes(spark, sf_dir), b.LOG_ORDER, b.REPO, b.ORDERS_AS_OF
    )


@query
def contribution_per_day(spark, sf_dir):
    return contribution.contribution_per_day(_changes(spark, sf_dir), b.REPO)


# --- open items -----------------------------------------------------------


@query
def open_items_per_day(spark, sf_dir):
    return open_items.open_items_per_day(
        b.issues(spark, sf_dir), b.commit_log(spark, sf_dir), b.REPO, b.ORDERS_AS_OF
    )


@query
def open_pull_requests_per_day(spark, sf_dir):
    return open_items.open_items_per_day(
        b.pull_requests(spark, sf_dir), b.commit_log(spark, sf_dir), b.REPO, b.ORDERS_AS_OF
    )


@query
def issue_density_per_day(spark, sf_dir):
    log_rows = b.commit_log(spark, sf_dir)
    return open_items.issue_density_from_steps(
        size.size_steps(size_commit_log_join(spark, sf_dir), b.LOG_ORDER, b.REPO),
        open_items.open_item_steps(b.issues(spark, sf_dir), log_rows, b.REPO, b.ORDERS_AS_OF),
        b.REPO,
        b.ORDERS_AS_OF,
    )


@query
def issue_density_from_daily_tables(spark, sf_dir):
    return open_items.issue_density_per_day(
        size_per_day(spark, sf_dir), open_items_per_day(spark, sf_dir), b.REPO
    )


@query
def issue_density_ratio(spark, sf_dir):
    return open_items.issue_density_ratio(issue_density_per_day(spark, sf_dir), b.REPO)


@query
def rejected_items(spark, sf_dir):
    return open_items.rejected_items(b.unchecked_issues(spark, sf_dir))


# --- keys and the normalised log -------------------------------------------


def _hashes(raw):
    return dimension(raw, "commit_hash", [], b.REVISION_ORDER, distinct=True)


def _authors(raw):
    return dimension(raw, "author_email", ["author"], b.REVISION_ORDER)


@query
def commit_hashes(spark, sf_dir):
    return _hashes(b.revisions(spark, sf_dir))


@query
def authors_dim(spark, sf_dir):
    return _authors(b.revisions(spark, sf_dir))


@query
def committers_dim(spark, sf_dir):
    return dimension(b.revisions(spark, sf_dir), "committer_email", ["committer"], b.REVISION_ORDER)


@query
def surrogate_keys(spark, sf_dir):
    events = b.table(spark, sf_dir, "events").select("ts", "event_id")
    return dense_ids(range_chunks(events, ["ts", "event_id"])).select("id", "event_id")


@query
def key_reference(spark, sf_dir):
    raw = b.revisions(spark, sf_dir)
    slim = raw.select("commit_hash", "author_email")
    keyed = lookup(slim, "author_email", _authors(raw), "author_email", "author_id")
    keyed = lookup(keyed, "commit_hash", _hashes(raw), "commit_hash", "commit_hash_id")
    return keyed.select("commit_hash_id", "author_id")


@query
def key_reference_list(spark, sf_dir):
    raw = b.revisions(spark, sf_dir)
    hashes, authors = _hashes(raw), _authors(raw)
    key = ["commit_hash"]
    parents = lookup_list(raw, key, "parents", hashes, "commit_hash", "parent_hash_ids")
    people = lookup_list(raw, key, "co_author_emails", authors, "author_email", "co_author_ids")
    both = lookup(
        parents.join(people, key), "commit_hash", hashes, "commit_hash", "commit_hash_id", unique=True
    )
    return both.select(
        "commit_hash_id",
        references_json(F.col("parent_hash_ids")).alias("parent_hash_ids"),
        references_json(F.col("co_author_ids")).alias("co_author_ids"),
    )


@query
def commit_edges(spark, sf_dir):
    edges = log.commit_edges(b.revisions(spark, sf_dir))
    return edges.withColumn("pos", F.col("pos").cast("long"))


@query
def co_authors(spark, sf_dir):
    people = revisions.co_author_rows(b.messages(spark, sf_dir), "event_id")
    return people.withColumn("pos", F.col("pos").cast("long"))


@query
def releases(spark, sf_dir):
    return log.releases(b.tags(spark, sf_dir), _hashes(b.revisions(spark, sf_dir)))


@query
def new_revisions(spark, sf_dir):
    fresh = log.new_revisions(b.revisions(spark, sf_dir), b.earlier_revisions(spark, sf_dir))
    return fresh.select("commit_hash")


@query
def new_releases(spark, sf_dir):
    hashes = _hashes(b.revisions(spark, sf_dir))
    return log.new_releases(b.tags(spark, sf_dir), hashes, b.earlier_revisions(spark, sf_dir))


def _as_json(logs):
    return logs.select(
        "commit_hash_id",
        "author_id",
        "committer_id",
        references_json(F.col("co_author_ids")).alias("co_author_ids"),
        references_json(F.col("parent_hash_ids")).alias("parent_hash_ids"),
        "authored_datetime",
        "committed_datetime",
        "encoding",
        "message",
        "gpgsign",
    )


@query
def normalised_log(spark, sf_dir):
    parts = log.normalise(b.revisions(spark, sf_dir), b.tags(spark, sf_dir), b.REVISION_ORDER)
    return _as_json(parts["commit_logs"])


@query
def normalised_log_in_two_loads(spark, sf_dir):
    """An earlier load, then the rest: the same table as one full load."""
    everything, tags = b.revisions(spark, sf_dir), b.tags(spark, sf_dir)
    first = log.normalise(b.earlier_revisions(spark, sf_dir), tags, b.REVISION_ORDER)
    second = log.normalise(everything, tags, b.REVISION_ORDER, stored=first)
    return _as_json(first["commit_logs"].unionByName(second["commit_logs"]))


def _normalised(spark, sf_dir, field, id_column):
    items = _items(spark, sf_dir, field, id_column)
    return tracker.normalised_items(items, id_column, tracker.item_ids(items, id_column))


@query
def issues_normalised(spark, sf_dir):
    return _normalised(spark, sf_dir, pages.ISSUES, "issue_id")


@query
def pull_requests_normalised(spark, sf_dir):
    return _normalised(spark, sf_dir, pages.PULL_REQUESTS, "pull_request_id")


def _stored(spark, sf_dir, buckets=0, log_rows=None):
    """Log and file sizes loaded into stored tables, in two loads."""
    house = Warehouse(
        spark, scratch_path(spark, "tables"), {"repo": T.LongType()}, b.ORDERS_AS_OF, buckets=buckets
    )
    log_rows = pinned(b.commit_log(spark, sf_dir)) if log_rows is None else log_rows
    raw = b.order_revisions(spark, sf_dir, log_rows)
    tags = b.order_tags(spark, sf_dir, log_rows)
    house.load_log(raw.filter(F.col("day") < "1998-01-01"), tags, b.LOG_ORDER)
    house.load_log(raw, tags, b.LOG_ORDER)
    house.load_file_sizes(b.order_files(spark, sf_dir, log=log_rows))
    house.project_size()
    return house


@query
def stored_productivity_per_day(spark, sf_dir):
    house = _stored(spark, sf_dir)
    house.project_productivity()
    return house.read("project_productivity_per_day")


@query
def stored_issue_density_per_day(spark, sf_dir):
    log_rows = pinned(b.commit_log(spark, sf_dir))
    house = _stored(spark, sf_dir, log_rows=log_rows)
    house.load_issues(b.order_issues(spark, sf_dir, log_rows))
    house.issue_spoilage()
    house.issue_density()
    return house.read("issue_density_per_day")


REPO_TYPE = {"repo": T.LongType()}


@query
def landed_issue_density_per_day(spark, sf_dir):
    """Landed JSON, CSV and pages of many repositories; the log comes as a stream."""
    house = Warehouse(spark, scratch_path(spark, "tables"), REPO_TYPE, b.ORDERS_AS_OF)
    log_path, state = scratch_path(spark, "log"), scratch_path(spark, "state")
    log_rows = pinned(b.commit_log(spark, sf_dir))
    tags = b.order_tags(spark, sf_dir, log_rows)
    for late in (False, True):
        b.land_order_revisions(spark, sf_dir, log_path, late, log_rows)
        stream = revisions.stream_revisions(spark, log_path, REPO_TYPE)
        house.load_log_stream(stream, tags, ["ordinal"], state).awaitTermination()
    csv = b.land_order_files(spark, sf_dir, log_rows)
    house.load_file_sizes(sizes.read_file_sizes(spark, csv, commit="commit_hash", by=REPO_TYPE))
    landed = b.land_order_pages(spark, sf_dir, pages.ISSUES, log=log_rows)
    items = pages.read_pages(spark, landed, pages.ISSUES, by=REPO_TYPE)
    house.load_issues(pages.page_items(items, pages.ISSUES, "issue_id", b.REPO))
    house.project_size()
    house.issue_spoilage()
    house.issue_density()
    return house.read("issue_density_per_day")


@query
def page_completeness_per_repository(spark, sf_dir):
    return pages.page_completeness(_lossy_pages(spark, sf_dir), pages.ISSUES, b.REPO)


def _lossy_pages(spark, sf_dir):
    landed = b.land_order_pages(spark, sf_dir, pages.ISSUES, lossy=True)
    return pages.read_pages(spark, landed, pages.ISSUES, by=REPO_TYPE)


@query
def page_chain(spark, sf_dir):
    return pages.page_chain(_lossy_pages(spark, sf_dir), pages.ISSUES, b.REPO)


@query
def lost_pages(spark, sf_dir):
    return pages.lost_pages(_lossy_pages(spark, sf_dir), pages.ISSUES, b.REPO)


@query
def landing_rejects(spark, sf_dir):
    lines = landing.read_lines(spark, b.land_odd_lines(spark, sf_dir), REVISION, ["commit_hash"])
    return landing.rejected(lines).select("line", "reason")


@query
def stored_issues_in_two_loads(spark, sf_dir):
    """Issues first landed while open, then all again in their last state."""
    house = Warehouse(spark, scratch_path(spark, "tables"), REPO_TYPE, b.ORDERS_AS_OF)
    items = b.order_issues(spark, sf_dir)
    open_then = items.withColumn("closed_at", F.lit(None).cast("timestamp"))
    house.load_issues(open_then.filter("repo % 2 = 0"))
    house.load_issues(items)
    ids = house.read("issue_ids").withColumnRenamed("id", "issue_id_key")
    return house.read("issues").join(ids, ["repo", "issue_id_key"]).drop("issue_id_key")


@query
def log_order_from_parents(spark, sf_dir):
    """An order of commits that landed without their place in the log."""
    return log_order(b.order_history(spark, sf_dir), "committed_datetime", b.REPO)


def _refreshed(spark, sf_dir, *steps, items=False):
    """Everything up to 1997 loaded and measured, then the rest, with the days it touched."""
    house = Warehouse(
        spark, scratch_path(spark, "tables"), REPO_TYPE, b.ORDERS_AS_OF, monthly=True
    )
    # both loads read them
    log_rows = pinned(b.commit_log(spark, sf_dir))
    files = pinned(b.dated_files(spark, sf_dir, log_rows))
    raw, tags = b.order_revisions(spark, sf_dir, log_rows), b.order_tags(spark, sf_dir, log_rows)
    early = F.col("day") < "1998-01-01"
    house.load_log(raw.filter(early), tags, b.LOG_ORDER)
    house.load_file_sizes(files.filter(F.col("first_day") < "1998-01-01").drop("first_day"))
    late = raw.filter(~early).select("repo", "day")
    opened = b.order_issues(spark, sf_dir, log_rows)
    if items:
        house.load_issues(opened.filter("created_at < '1998-01-01'"))
        later = opened.filter("created_at >= '1998-01-01'")
        late = late.unionByName(later.select("repo", F.to_date("created_at").alias("day")))
    for step in steps:
        getattr(house, step)()
    house.load_log(raw, tags, b.LOG_ORDER)
    house.load_file_sizes(files.drop("first_day"))
    if items:
        house.load_issues(opened)
    return house, pinned(refresh.touched(late, ["day"], b.REPO))


@query
def stored_size_refreshed(spark, sf_dir):
    house, changed = _refreshed(spark, sf_dir, "project_size")
    house.refresh_size(changed)
    return house.read("project_size_per_day").withColumnRenamed("date", "day")


@query
def stored_productivity_refreshed(spark, sf_dir):
    house, changed = _refreshed(spark, sf_dir, "project_size", "project_productivity")
    house.refresh_size(changed)
    house.refresh_productivity(changed)
    return house.read("project_productivity_per_day")


@query
def stored_contribution_refreshed(spark, sf_dir):
    """Committers by name, since ids follow the loads."""
    house, changed = _refreshed(spark, sf_dir, "project_size", "project_productivity", "bus_factor")
    house.refresh_size(changed)
    house.refresh_productivity(changed)
    house.refresh_bus_factor(changed)
    people = house.read("committers").select("repo", F.col("id").alias("committer_id"), "committer")
    return house.read("bus_factor_per_day").join(people, ["repo", "committer_id"], "left").drop("committer_id")


@query
def stored_density_refreshed(spark, sf_dir):
    house, changed = _refreshed(
        spark, sf_dir, "project_size", "issue_spoilage", "issue_density", items=True
    )
    house.refresh_size(changed)
    house.refresh_spoilage("issue", changed)
    house.refresh_density(changed)
    return house.read("issue_density_per_day")


@query
def stored_sql(spark, sf_dir):
    """SQL over the stored tables."""
    house = Warehouse(spark, scratch_path(spark, "tables"), REPO_TYPE, b.ORDERS_AS_OF)
    house.load_log(b.order_revisions(spark, sf_dir), b.order_tags(spark, sf_dir), b.LOG_ORDER)
    return house.sql(
        "SELECT l.repo, c.committer, count(*) AS commits FROM commit_logs l"
        " JOIN committers c ON c.repo = l.repo AND c.id = l.committer_id GROUP BY l.repo, c.committer"
    )


@query
def stored_releases_by_repo(spark, sf_dir):
    """Two loads of different repositories: the second leaves the first's releases."""
    house = Warehouse(spark, scratch_path(spark, "tables"), REPO_TYPE, b.ORDERS_AS_OF)
    raw, tags = b.order_revisions(spark, sf_dir), b.order_tags(spark, sf_dir)
    for part in ("repo % 2 = 0", "repo % 2 = 1"):
        house.load_log(raw.filter(part), tags.filter(part), b.LOG_ORDER)
    hashes = house.read("commit_hashes").withColumnRenamed("id", "commit_hash_id")
    return house.read("releases").join(hashes, ["repo", "commit_hash_id"]).drop("commit_hash_id")


# --- quality ----------------------------------------------------------------


_FILE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_DATED = T.StructType([*TABLES["file_size_per_commit"].fields, T.StructField("day", T.DateType(), False)])


@query
def schema_violations_exact(spark, sf_dir):
    """Fractions of any size and times of day count, whatever a cast would round."""
    return violations(b.suspect_files(spark, sf_dir), _DATED, _FILE_KEYS)


@query
def rejected_rows_by_rule(spark, sf_dir):
    """Bad rows are written apart from the good ones, in one pass."""
    path = scratch_path(spark, "checked")
    land_checked(b.suspect_files(spark, sf_dir), _DATED, path)
    broken = rejected_rows(spark, path, _DATED).select(F.explode("rules").alias("_rule"))
    rows = broken.groupBy("_rule.column", "_rule.rule").agg(F.count(F.lit(1)).alias("rows"))
    good = accepted_rows(spark, path, _DATED).agg(F.count(F.lit(1)).alias("rows"))
    none = F.lit(None).cast("string")
    return rows.unionByName(good.select(none.alias("column"), none.alias("rule"), "rows"))


@query
def append_conflicts(spark, sf_dir):
    """Rows of a batch whose key is stored with another value, or comes with two values."""
    orders = b.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("commit_id"), "o_totalprice")
    stored = orders.filter("commit_id % 3 = 0")
    batch = orders.filter("commit_id % 2 = 0").withColumn(
        "o_totalprice", F.when(F.col("commit_id") % 12 == 0, 0.0).otherwise(F.col("o_totalprice"))
    )
    twice = orders.filter("commit_id % 10 = 0").withColumn("o_totalprice", F.lit(-1.0))
    whole = batch.unionByName(twice)
    known = tables.collisions(whole, stored, ["commit_id"]).withColumn("kind", F.lit("stored"))
    return known.unionByName(
        tables.conflicting_rows(whole, ["commit_id"]).withColumn("kind", F.lit("batch"))
    )


@query
def stored_constraint_report(spark, sf_dir):
    """The keys of the given tables, after some parents were left out and some written twice."""
    customer, orders = b.table(spark, sf_dir, "customer"), b.table(spark, sf_dir, "orders")
    given = {
        "customer": customer.unionByName(customer.filter("c_custkey % 7 = 0")),
        "orders": orders.filter("o_orderstatus <> 'P'"),
        "lineitem": b.table(spark, sf_dir, "lineitem"),
    }
    return constraint_report(
        given, {"customer": "c_custkey", "orders": "o_orderkey"},
        [("lineitem", "l_orderkey", "orders"), ("orders", "o_custkey", "customer")],
    )


@query
def schema_violations(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    suspect = b.table(spark, sf_dir, "lineitem").select(
        *keys,
        F.col("l_orderkey").alias("commit_hash_id"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("language"),
        F.col("l_linestatus").alias("provider"),
        F.col("l_quantity").alias("lines"),
        F.col("l_linenumber").alias("code"),
        F.when(F.col("l_linestatus") == "F", "n/a")
        .otherwise(F.col("l_linenumber").cast("string"))
        .alias("comments"),
        F.col("l_tax").alias("blanks"),
        F.col("l_extendedprice").alias("bytes"),
    )
    return violations(suspect, TABLES["file_size_per_commit"], keys)


@query
def orphan_keys(spark, sf_dir):
    return orphans(b.commit_log(spark, sf_dir), "commit_id", b.file_size(spark, sf_dir), "commit_id")


# --- streaming --------------------------------------------------------------


def _event_stream(spark, sf_dir):
    # the pattern lets the table be one file or a folder of files
    return spark.readStream.schema(b.GIVEN["events"]).parquet(f"{sf_dir}/events.parquet*")


@query
def stream_new_revisions(spark, sf_dir):
    target = scratch_path(spark, "revisions")
    until = F.lit(b.EARLIER_LOAD_UNTIL).cast("timestamp_ntz")
    earlier = b.table(spark, sf_dir, "events").filter(F.col("ts") < until)
    earlier.select("event_id").write.parquet(target)
    stream = _event_stream(spark, sf_dir).select("event_id")
    load_new_revisions(stream, target, scratch_path(spark, "state"), ["event_id"]).awaitTermination()
    return spark.read.parquet(target)


@query
def stream_daily_activity(spark, sf_dir):
    daily = activity.daily_activity(_event_stream(spark, sf_dir), "ts", "user_id", "value")
    target = scratch_path(spark, "activity")
    activity.write_closed_days(daily, target, scratch_path(spark, "state")).awaitTermination()
    return spark.read.schema(daily.schema).parquet(target)


@query
def stream_revisions_by_folder(spark, sf_dir):
    """Whole rows, beside what an earlier load stored in folders by the key's hash."""
    target = scratch_path(spark, "revisions")
    until = F.lit(b.EARLIER_LOAD_UNTIL).cast("timestamp_ntz")
    earlier = b.table(spark, sf_dir, "events").filter(F.col("ts") < until)
    append_by_folder(earlier, target, ["event_id"], folders=16)
    stream, state = _event_stream(spark, sf_dir), scratch_path(spark, "state")
    load_new_revisions(stream, target, state, ["event_id"], folders=16).awaitTermination()
    return read_by_folder(spark, target, b.GIVEN["events"])


@query
def stream_size_log_join(spark, sf_dir):
    """Both streams landing by landing, every fifth record landed twice, sizes up to two days apart."""
    sizes_of, log_of = b.sizes_and_log(spark, sf_dir)
    landed_sizes, landed_log = scratch_path(spark, "sizes"), scratch_path(spark, "log")
    target, state = scratch_path(spark, "joined"), scratch_path(spark, "state")
    # a landing is many files in no order, so it is one batch; the next run goes on from its state
    for landing in b.LANDINGS:
        b.land_between(sizes_of, "measured_at", landing, landed_sizes)
        b.land_between(log_of, "committed_at", landing, landed_log)
        joined = size_stream.size_log_join(
            spark.readStream.schema(sizes_of.schema).parquet(landed_sizes),
            spark.readStream.schema(log_of.schema).parquet(landed_log),
            ["commit_id"], "measured_at", "committed_at", "2 days",
        )
        rows = joined.select("repo", "commit_id", "committer_id", "day", *MEASURES)
        size_stream.write_joined(rows, target, state, counted=False).awaitTermination()
    return spark.read.schema(rows.schema).parquet(target)


@query
def stored_productivity_in_buckets(spark, sf_dir):
    """The tables per commit in buckets of the commit, loaded in two loads."""
    house = _stored(spark, sf_dir, buckets=8)
    house.project_productivity()
    return house.read("project_productivity_per_day")


@query
def stored_size_log_join(spark, sf_dir):
    """Sizes of stored commits with their log rows; no rows move for the join."""
    house = _stored(spark, sf_dir, buckets=8)
    logs = house.read("commit_logs")
    logs = logs.select("repo", "commit_hash_id", utc_day(logs, "committed_datetime").alias("day"))
    sizes_of = house.read("project_size_per_commit")
    return size.join_log(sizes_of, logs, house.commit_key).drop("commit_hash_id")
