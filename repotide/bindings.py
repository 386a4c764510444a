"""Domain tables of this package expressed over the given star-schema tables.

Orders act as commits (one repository per nation), line items as measured
files and as issues, orders also as pull requests, events as raw revisions of
one project and as tracker items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.operators.ordering import dense_ids, range_chunks
from repotide.schemas import LONG, MEASURES, TEXT, WALL_CLOCK, struct
from repotide.session import pinned, scratch_path
from repotide.sources.pages import PAGE_SIZE
from repotide.sources.tables import scan_table

ORDERS_AS_OF = "2001-12-31"
# Revisions before this instant count as loaded by an earlier run.
EARLIER_LOAD_UNTIL = "2024-01-16"

LOG_ORDER = ["day", "commit_id"]
REVISION_ORDER = ["committed_datetime", "seq"]
REPO = ["repo"]


_INT, _DOUBLE = T.IntegerType(), T.DoubleType()

# The given tables; declared, so that opening one reads no file.
GIVEN = {
    "customer": struct(
        c_custkey=LONG, c_name=TEXT, c_nationkey=_INT, c_acctbal=_DOUBLE, c_mktsegment=TEXT
    ),
    "documents": struct(doc_id=LONG, text=TEXT, lang=TEXT, source=TEXT, n_chars=LONG),
    "events": struct(
        event_id=LONG, ts=WALL_CLOCK, user_id=LONG, event_type=TEXT, value=_DOUBLE, props=TEXT
    ),
    "lineitem": struct(
        l_orderkey=LONG,
        l_partkey=LONG,
        l_suppkey=LONG,
        l_linenumber=_INT,
        l_quantity=_DOUBLE,
        l_extendedprice=_DOUBLE,
        l_discount=_DOUBLE,
        l_tax=_DOUBLE,
        l_returnflag=TEXT,
        l_linestatus=TEXT,
        l_shipdate=WALL_CLOCK,
    ),
    "orders": struct(
        o_orderkey=LONG,
        o_custkey=LONG,
        o_orderstatus=TEXT,
        o_totalprice=_DOUBLE,
        o_orderdate=WALL_CLOCK,
        o_orderpriority=TEXT,
    ),
    "pages": struct(page_id=LONG, url=TEXT, html=TEXT),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_table(spark, f"{sf_dir}/{name}.parquet", GIVEN[name])


def _long(column: Column) -> Column:
    return column.cast("long")


def commit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        _long(F.col("c_nationkey")).alias("repo"),
        F.col("o_orderkey").alias("commit_id"),
        F.col("o_custkey").alias("committer_id"),
        F.col("o_orderdate").cast("date").alias("day"),
    )


def file_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("commit_id"),
        F.col("l_returnflag").alias("language"),
        F.concat(F.lit("p"), F.col("l_partkey")).alias("provider"),
        _long(F.col("l_quantity")).alias("lines"),
        _long(F.col("l_linenumber")).alias("code"),
        _long(F.round(F.col("l_tax") * 100)).alias("comments"),
        _long(F.round(F.col("l_discount") * 100)).alias("blanks"),
        _long(F.floor("l_extendedprice")).alias("bytes"),
    )


def issues(spark: SparkSession, sf_dir: str, log: DataFrame | None = None) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    log = commit_log(spark, sf_dir) if log is None else log
    shipped = F.col("l_shipdate").cast("date")
    return lines.join(log, lines.l_orderkey == log.commit_id).select(
        "repo",
        F.least("day", shipped).alias("created"),
        F.when(F.col("l_linestatus") == "F", F.greatest("day", shipped)).alias("closed"),
    )


def pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    day = F.col("o_orderdate").cast("date")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        _long(F.col("c_nationkey")).alias("repo"),
        day.alias("created"),
        F.when(
            F.col("o_orderstatus") != "O", F.date_add(day, (F.col("o_custkey") % 90).cast("int"))
        ).alias("closed"),
    )


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _message() -> Column:
    k = _k()

    def trailer(letter: str) -> Column:
        small = F.lit(letter.lower())
        return F.concat(
            F.lit(f"\nCo-authored-by: {letter}"), k, F.lit(" <"), small, k, F.lit("@x>")
        )

    trailers = F.when(k % 3 == 0, "").when(k % 3 == 1, trailer("U")).otherwise(
        F.concat(trailer("U"), trailer("V"))
    )
    return F.concat(F.lit("change "), F.col("event_type"), F.lit("\n"), trailers)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", _message().alias("message"))


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log; ``seq`` breaks ties between equal times."""
    event = F.col("event_id")
    k = _k()

    def person(number: Column, letter: str = "u") -> Column:
        return F.concat(F.lit(letter), number, F.lit("@x"))

    def commit(number: Column) -> Column:
        return F.concat(F.lit("h"), number)

    nobody = F.array().cast("array<string>")
    return table(spark, sf_dir, "events").select(
        event.alias("seq"),
        F.col("event_type").alias("author"),
        person(F.col("user_id")).alias("author_email"),
        F.when(k % 3 == 0, nobody)
        .when(k % 3 == 1, F.array(person(k)))
        .otherwise(F.array(person(k), person(k + 100)))
        .alias("co_author_emails"),
        commit(event).alias("commit_hash"),
        F.col("ts").cast("timestamp").alias("authored_datetime"),
        F.col("ts").cast("timestamp").alias("committed_datetime"),
        F.col("event_type").alias("committer"),
        person(k, "c").alias("committer_email"),
        F.lit("UTF-8").alias("encoding"),
        _message().alias("message"),
        F.lit(None).cast("string").alias("gpgsign"),
        F.when(event == 0, nobody)
        .when((event % 10 == 0), F.array(commit(event - 1), commit(event - 7)))
        .otherwise(F.array(commit(event - 1)))
        .alias("parents"),
    )


def order_revisions(spark: SparkSession, sf_dir: str, log: DataFrame | None = None) -> DataFrame:
    """The commit log as raw revisions of many repositories.

    Here and below ``log`` is ``commit_log``, which a query that needs it often has pinned.
    """
    log = commit_log(spark, sf_dir) if log is None else log
    person = F.concat(F.lit("c"), F.col("committer_id"))
    nobody = F.array().cast("array<string>")
    return log.select(
        "repo",
        "day",
        "commit_id",
        person.alias("author"),
        F.concat(person, F.lit("@x")).alias("author_email"),
        nobody.alias("co_author_emails"),
        F.concat(F.lit("o"), F.col("commit_id")).alias("commit_hash"),
        F.col("day").cast("timestamp").alias("authored_datetime"),
        F.col("day").cast("timestamp").alias("committed_datetime"),
        person.alias("committer"),
        F.concat(person, F.lit("@x")).alias("committer_email"),
        F.lit("UTF-8").alias("encoding"),
        F.lit("").alias("message"),
        F.lit(None).cast("string").alias("gpgsign"),
        nobody.alias("parents"),
    )


def order_tags(spark: SparkSession, sf_dir: str, log: DataFrame | None = None) -> DataFrame:
    """Release tags on the urgent orders: some commits carry two, some did not land."""
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    commit = F.col("commit_id")
    series = F.when(commit % 4 == 0, F.array(F.lit("r"), F.lit("s"))).otherwise(F.array(F.lit("r")))
    known = F.when(commit % 6 == 0, "x").otherwise("o")
    log = commit_log(spark, sf_dir) if log is None else log
    tagged = urgent.join(log, urgent.o_orderkey == commit).select("repo", "commit_id", F.explode(series).alias("series"))
    return tagged.select(
        "repo",
        F.concat("series", commit).alias("tag"),
        F.when(commit % 9 != 0, F.concat(F.lit(""), known, commit)).alias("commit_hash"),
    )


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commit log with branches: of ten orders of a repository five are on a branch that
    leaves at the first and is merged by the last; every hundredth order's first parent is lost.
    """
    log = commit_log(spark, sf_dir)
    numbered = dense_ids(range_chunks(log, ["commit_id"], REPO), REPO, "n")
    back = F.element_at(
        F.array(*[F.lit(x) for x in (1, 1, 1, 3, 1, 1, 1, 1, 6, 1)]), (F.col("n") % 10 + 1).cast("int")
    )
    numbers = F.when(F.col("n") % 10 == 9, F.array(F.col("n") - back, F.col("n") - 2)).otherwise(
        F.array(F.col("n") - back)
    )
    # parents are named by number, as hashes are not known from it
    return numbered.select(
        "repo",
        F.concat(F.lit("n"), F.col("n")).alias("commit_hash"),
        F.col("day").cast("timestamp").alias("committed_datetime"),
        F.when(F.col("n") > 0, F.transform(numbers, lambda p: F.when(
            F.col("n") % 100 == 50, F.concat(F.lit("lost"), p)
        ).otherwise(F.concat(F.lit("n"), p)))).otherwise(F.array().cast("array<string>")).alias("parents"),
    )


def order_files(
    spark: SparkSession, sf_dir: str, before: str | None = None, log: DataFrame | None = None
) -> DataFrame:
    """The file sizes with repository and commit hash, one row per file of a commit.

    With ``before`` only those of commits that are in the log before that day.
    """
    dated = dated_files(spark, sf_dir, log)
    return (dated if before is None else dated.filter(F.col("first_day") < before)).drop("first_day")


def dated_files(spark: SparkSession, sf_dir: str, log: DataFrame | None = None) -> DataFrame:
    """``order_files`` with the first day that their commit is in the log."""
    log = commit_log(spark, sf_dir) if log is None else log
    # a commit that is in a repository's log n times counts its files n times
    places = log.repartition("commit_id").groupBy("commit_id", "repo").agg(
        F.count(F.lit(1)).alias("_times"), F.min("day").alias("first_day")
    )
    # both sides are moved by the number of the join, and files sorted once for their sums and for it
    sums = (
        file_size(spark, sf_dir).filter("commit_id IS NOT NULL").repartition("commit_id")
        .groupBy("commit_id", "provider")
        .agg(F.min("language").alias("language"), *[F.sum(m).alias(m) for m in MEASURES])
    )
    commit_hash = F.concat(F.lit("o"), F.col("commit_id")).alias("commit_hash")
    times = [(F.col(m) * F.col("_times")).alias(m) for m in MEASURES]
    return sums.join(places, "commit_id").select(
        "repo", commit_hash, "provider", "language", *times, "first_day"
    )


def order_issues(spark: SparkSession, sf_dir: str, log: DataFrame | None = None) -> DataFrame:
    """The issues as tracker items; the given rows have no unique key to order by."""
    spans = issues(spark, sf_dir, log)
    counted = spans.groupBy("repo", "created", "closed").count()
    copies = F.posexplode(F.sequence(F.lit(1).cast("long"), F.col("count"))).alias("pos", "_copy")
    return counted.select("repo", "created", "closed", copies).select(
        "repo",
        F.unix_date("created").cast("long").alias("page"),
        F.concat_ws("/", F.coalesce(F.col("closed").cast("string"), F.lit("open")), "pos").alias("pos"),
        F.concat_ws("/", "created", F.coalesce(F.col("closed").cast("string"), F.lit("open")), "pos").alias("issue_id"),
        F.col("created").cast("timestamp").alias("created_at"),
        F.col("closed").cast("timestamp").alias("closed_at"),
    )


def unchecked_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipping opens an item and the order day closes it, so many run backwards."""
    lines, log = table(spark, sf_dir, "lineitem"), commit_log(spark, sf_dir)
    return lines.join(log, lines.l_orderkey == log.commit_id).select(
        "repo",
        F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("item"),
        F.col("l_shipdate").cast("date").alias("created"),
        F.when(F.col("l_linestatus") == "F", F.col("day")).alias("closed"),
    )


# Landed texts are compressed; such a file is read by one task, so none gets too long.
_LANDED = {"compression": "gzip", "maxRecordsPerFile": 500_000}
_LANDED_PAGES = {"compression": "gzip", "maxRecordsPerFile": 10_000}


def land_order_revisions(
    spark: SparkSession, sf_dir: str, path: str, late: bool, log: DataFrame | None = None
) -> None:
    """Add one half of the orders' log to a folder of JSON lines.

    The place in the log is the order's number, whose days run back and forth.
    The half of the ``late`` numbers also holds every tenth early one again.
    """
    rows = order_revisions(spark, sf_dir, log).withColumnRenamed("commit_id", "ordinal")
    middle = rows.agg(F.expr("(min(ordinal) + max(ordinal)) div 2")).first()[0] or 0
    early = F.col("ordinal") <= middle
    chosen = (~early | (F.col("ordinal") % 10 == 0)) if late else early
    at = _iso(F.col("committed_datetime"), 2)
    landed = rows.filter(chosen).drop("day")
    landed.withColumns({"authored_datetime": at, "committed_datetime": at}).write.mode(
        "append"
    ).options(**_LANDED).json(path)


def land_order_files(spark: SparkSession, sf_dir: str, log: DataFrame | None = None) -> str:
    """The orders' file sizes as CSV in two folders whose columns are ordered differently."""
    path = scratch_path(spark, "sizes")
    files = pinned(order_files(spark, sf_dir, log=log))
    names = ["repo", "commit_hash", "language", "provider", *MEASURES]
    even = F.pmod(F.xxhash64("provider"), F.lit(2)) == 0
    files.filter(even).select(*names).write.options(header=True, **_LANDED).csv(f"{path}/a")
    turned = files.filter(~even).select(*[F.col(n).alias(n.upper()) for n in reversed(names)])
    turned.write.options(header=True, **_LANDED).csv(f"{path}/b")
    return f"{path}/*"


def land_order_pages(
    spark: SparkSession, sf_dir: str, field: str, lossy: bool = False, log: DataFrame | None = None
) -> str:
    """The orders' issues as API pages of their repositories; with ``lossy`` some do not arrive."""
    path = scratch_path(spark, "pages")
    items = order_issues(spark, sf_dir, log).select("repo", "issue_id", "created_at", "closed_at")
    items = dense_ids(range_chunks(items, ["issue_id"], REPO), REPO, "_nth")
    per_repo = pinned(items.groupBy("repo").agg(F.count(F.lit(1)).alias("total")))
    pages = F.ceil(F.col("total") / PAGE_SIZE)
    arrives = F.col("page") % 7 != 3 if lossy else F.lit(True)
    node = F.struct(
        F.col("issue_id").alias("id"),
        _iso(F.col("created_at"), 2).alias("createdAt"),
        _iso(F.col("closed_at"), -5).alias("closedAt"),
    )
    edges = F.sort_array(F.collect_list(F.struct(node.alias("node"))))
    info = F.struct(
        F.concat(F.lit("c"), "page").alias("endCursor"),
        (F.col("page") < F.col("_last")).alias("hasNextPage"),
    )
    content = F.struct(F.col("total").alias("totalCount"), "edges", info.alias("pageInfo"))
    (
        items.join(per_repo, "repo")
        .withColumns({"page": F.floor(F.col("_nth") / PAGE_SIZE), "_last": pages - 1})
        .filter(arrives)
        .groupBy("repo", "page", "total", "_last")
        .agg(edges.alias("edges"))
        .select(
            "repo",
            "page",
            F.when(F.col("page") > 0, F.concat(F.lit("c"), F.col("page") - 1)).alias("after"),
            F.struct(F.struct(content.alias(field)).alias("repository")).alias("data"),
        )
        .write.options(**_LANDED_PAGES).json(path)
    )
    return path


def earlier_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    until = F.lit(EARLIER_LOAD_UNTIL).cast("timestamp")
    return revisions(spark, sf_dir).filter(F.col("committed_datetime") < until)


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release tags: some do not resolve, some commits carry two."""
    k = _k()
    names = F.when(k >= 90, F.array(F.lit("v"), F.lit("w"))).otherwise(F.array(F.lit("v")))
    return (
        table(spark, sf_dir, "events")
        .select("event_id", k.alias("k"), F.explode(names).alias("series"))
        .select(
            F.concat("series", "event_id").alias("tag"),
            F.when(F.col("k") >= 10, F.concat(F.lit("h"), F.col("event_id"))).alias("commit_hash"),
        )
    )


def _iso(instant: Column, hours: int) -> Column:
    """Local ISO text of an instant at a fixed offset."""
    local = instant + F.expr(f"INTERVAL '{hours}' HOUR")
    return F.concat(
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(f"{hours:+03d}:00")
    )


def land_revisions(spark: SparkSession, sf_dir: str) -> str:
    """Write the raw log as JSON lines, times at two different offsets."""
    path = scratch_path(spark, "revisions")
    at = F.col("committed_datetime")
    text = F.when(F.col("author") == "view", _iso(at, -5)).otherwise(_iso(at, 2))
    landed = revisions(spark, sf_dir).withColumns(
        {"authored_datetime": text, "committed_datetime": text}
    )
    landed.drop("seq").write.json(path)
    return path


def land_file_sizes(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write the file sizes as CSV with the columns a size counter prints."""
    path = scratch_path(spark, "sizes")
    file_size(spark, sf_dir).select(
        F.col("language").alias("Language"),
        F.concat(F.lit(f"{root}/"), F.col("provider")).alias("Provider"),
        F.col("provider").alias("Filename"),
        F.col("lines").alias("Lines"),
        F.col("code").alias("Code"),
        F.col("comments").alias("Comments"),
        F.col("blanks").alias("Blanks"),
        F.lit(0).alias("Complexity"),
        F.col("bytes").alias("Bytes"),
        F.lit(0).alias("ULOC"),
        F.col("commit_id").alias("commit_hash_id"),
    ).write.option("header", True).csv(path)
    return path


def land_pages(spark: SparkSession, sf_dir: str, field: str, lossy: bool = False) -> str:
    """Write the events as API pages, one JSON text per line.

    With ``lossy`` the pages that begin with a view did not arrive.
    """
    path = scratch_path(spark, "pages")
    events = table(spark, sf_dir, "events")
    total = events.count()
    page = F.floor(F.col("event_id") / PAGE_SIZE)
    at = F.col("ts").cast("timestamp")
    closed = at + F.make_dt_interval(hours=_k())
    node = F.struct(
        F.concat(F.lit("i"), F.col("event_id")).alias("id"),
        _iso(at, 2).alias("createdAt"),
        F.when(F.col("event_type") != "error", _iso(closed, -5)).alias("closedAt"),
    )
    grouped = (
        events.select(page.alias("page"), "event_id", "event_type", F.struct(node.alias("node")).alias("edge"))
        .groupBy("page")
        .agg(F.sort_array(F.collect_list(F.struct("event_id", "event_type", "edge"))).alias("rows"))
    )
    if lossy:
        grouped = grouped.filter(F.col("rows")[0]["event_type"] != "view")
    last_page = (total - 1) // PAGE_SIZE
    content = F.struct(
        F.lit(total).alias("totalCount"),
        F.transform("rows", lambda r: r["edge"]).alias("edges"),
        F.struct(
            F.concat(F.lit("c"), F.col("page")).alias("endCursor"),
            (F.col("page") < last_page).alias("hasNextPage"),
        ).alias("pageInfo"),
    )
    grouped.select(
        "page",
        F.when(F.col("page") > 0, F.concat(F.lit("c"), F.col("page") - 1)).alias("after"),
        F.struct(F.struct(content.alias(field)).alias("repository")).alias("data"),
    ).write.json(path)
    return path


def land_odd_lines(spark: SparkSession, sf_dir: str) -> str:
    """Commit records as JSON lines, of which some are cut off, lack their hash or hold text for a number."""
    path = scratch_path(spark, "lines")
    event = F.col("event_id")
    head = F.concat(F.lit('{"commit_hash": "h'), event, F.lit('", "ordinal": '))
    line = (
        F.when(event % 50 == 7, F.concat(head, event))
        .when(event % 50 == 9, F.concat(F.lit('{"ordinal": '), event, F.lit("}")))
        .when(event % 50 == 11, F.concat(head, F.lit('"x"}')))
        .otherwise(F.concat(head, event, F.lit("}")))
    )
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    return path


def suspect_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File sizes as they might land, with nulls, text, fractions and a day that holds a time."""
    number = F.col("l_linenumber").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_orderkey").alias("commit_hash_id"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("language"),
        F.col("l_linestatus").alias("provider"),
        F.col("l_quantity").alias("lines"),
        F.col("l_linenumber").alias("code"),
        F.when(F.col("l_linestatus") == "F", "n/a")
        .when(F.col("l_linenumber") == 2, F.concat(number, F.lit(".0000000000000000000001")))
        .when(F.col("l_linenumber") == 3, F.concat(number, F.lit(".000")))
        .when(F.col("l_linenumber") == 4, "5e-20")
        .otherwise(number)
        .alias("comments"),
        F.col("l_tax").alias("blanks"),
        F.col("l_extendedprice").alias("bytes"),
        F.when(F.col("l_linenumber") == 1, F.col("l_shipdate") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND"))
        .otherwise(F.col("l_shipdate")).alias("day"),
    )


# Commits by year of landing: one landing of a stream after the other, in order of time.
_LANDINGS = ["1900-01-01", "1997-01-01", "1999-01-01", "2001-01-01", "2100-01-01"]
LANDINGS = list(zip(_LANDINGS, _LANDINGS[1:]))


def sizes_and_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sizes (at ``measured_at``) and log rows (at ``committed_at``) of commits.

    A size is measured 0 to 3 days after its commit; those of the third day are too late for
    a span of two. Every fifth commit's records come twice.
    """
    commit = F.col("commit_id")
    twice = F.explode(F.sequence(F.lit(1), F.when(commit % 5 == 0, 2).otherwise(1))).alias("_time")
    committed = F.col("day").cast("timestamp").alias("committed_at")
    log = commit_log(spark, sf_dir).select("repo", commit, "committer_id", "day", committed)
    measured = F.date_add("day", (commit % 4).cast("int")).cast("timestamp").alias("measured_at")
    dated = log.select(commit, measured)
    sums = file_size(spark, sf_dir).groupBy("commit_id").agg(*[F.sum(m).alias(m) for m in MEASURES])
    sizes = sums.join(dated, "commit_id")
    # every landing reads them
    return tuple(pinned(rows.select("*", twice).drop("_time")) for rows in (sizes, log))


def land_between(rows: DataFrame, time: str, landing: tuple[str, str], path: str) -> None:
    """Add the rows of one landing to a folder, in as many files as they have partitions."""
    low, high = [F.lit(day).cast("timestamp") for day in landing]
    rows.filter((F.col(time) >= low) & (F.col(time) < high)).write.mode("append").parquet(path)
