"""Landed API pages of issues and pull requests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.functions.time import parse_instant
from repotide.operators.chains import depths
from repotide.operators.keys import one_per_key, without_known
from repotide.session import pinned
from repotide.schemas import keyed, page_schema

ISSUES = "issues"
PULL_REQUESTS = "pullRequests"
# Fixed value: items asked for per page.
PAGE_SIZE = 100


def read_pages(
    spark: SparkSession,
    path: str,
    field: str,
    one_per_file: bool = False,
    by: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """Pages as nested records; one JSON text per line, or one per file."""
    return (
        spark.read.schema(keyed(by, page_schema(field)))
        .option("mode", "FAILFAST")
        .option("multiLine", one_per_file)
        .json(path)
    )


def page_items(
    pages: DataFrame, field: str, id_column: str, by: Sequence[str] = ()
) -> DataFrame:
    """One row per item with its page and its position in the page."""
    node = "_edge.node"
    return pages.select(
        *by, "page", F.posexplode(f"data.repository.{field}.edges").alias("pos", "_edge")
    ).select(
        *by,
        "page",
        "pos",
        F.col(f"{node}.id").alias(id_column),
        parse_instant(F.col(f"{node}.createdAt")).alias("created_at"),
        parse_instant(F.col(f"{node}.closedAt")).alias("closed_at"),
    )


def page_completeness(pages: DataFrame, field: str, by: Sequence[str] = ()) -> DataFrame:
    """Announced items, distinct items received, and pages that did not arrive.

    An empty tracker still answers with one page.
    """
    content = f"data.repository.{field}"
    landed = pages.select(
        *by,
        F.col(f"{content}.totalCount").alias("total"),
        F.coalesce("after", F.lit("")).alias("after"),
        F.explode_outer(f"{content}.edges.node.id").alias("id"),
    )
    counted = landed.groupBy(*by).agg(
        F.max("total").alias("expected"),
        F.count_distinct("id").alias("received"),
        F.count_distinct("after").alias("_pages"),
    )
    wanted = F.greatest(F.ceil(F.col("expected") / PAGE_SIZE), F.lit(1))
    return counted.select(
        *by, "expected", "received", (wanted - F.col("_pages")).alias("missing_pages")
    )


def page_gaps(pages: DataFrame, field: str, by: Sequence[str] = ()) -> DataFrame:
    """Cursors a page pointed to as its successor that no landed page asked for.

    The first page is asked for without a cursor: where other pages landed and
    it did not, the cursor is null.
    """
    info = f"data.repository.{field}.pageInfo"
    following = F.when(F.col(f"{info}.hasNextPage"), F.array(F.lit(None), F.col(f"{info}.endCursor")))
    first = F.array(F.lit(None).cast("string"))
    asked = pages.select(*by, F.explode(F.coalesce(following, first)).alias("cursor")).distinct()
    return without_known(asked, pages.select(*by, F.col("after").alias("cursor")), [*by, "cursor"])


def page_chain(pages: DataFrame, field: str, by: Sequence[str] = ()) -> DataFrame:
    """Each landed page's place in its run of pages that follow one another.

    A page follows the one whose end cursor it asked for. ``run`` is the cursor that the
    run's first page asked for, null for the tracker's beginning, and ``place`` counts from
    0; ``in_cycle`` says that cursors lead back to where they came from, then there is no
    place. A page that landed twice counts once.
    """
    info = f"data.repository.{field}.pageInfo"
    landed = pages.select(
        *by, "page", F.coalesce("after", F.lit("")).alias("after"),
        F.when(F.col(f"{info}.hasNextPage"), F.col(f"{info}.endCursor")).alias("end"),
    )
    own = pinned(one_per_key(landed, [*by, "after"], ["page"]))
    before = own.filter("end IS NOT NULL").groupBy(*by, F.col("end").alias("after")).agg(
        F.min("after").alias("parent")
    )
    links = own.join(before, [*by, "after"], "left")
    ranked = depths(links.select(*by, "after", "parent"), "after", "parent", by)
    cursor = lambda c: F.nullif(F.col(c), F.lit(""))
    return own.join(ranked, [*by, "after"]).select(
        *by, "page", cursor("after").alias("after"), "end", cursor("root").alias("run"),
        F.col("depth").alias("place"), F.col("depth").isNull().alias("in_cycle"),
    )


def lost_pages(pages: DataFrame, field: str, by: Sequence[str] = ()) -> DataFrame:
    """Runs of pages that did not land: the first lost page's cursor and number, and how many.

    The pages' running numbers tell how many are lost between two runs, the announced number
    of items how many at the end. ``first_page`` and ``pages`` are null where pages landed
    without a number.
    """
    content = f"data.repository.{field}"
    wanted = F.greatest(F.ceil(F.max(f"{content}.totalCount") / PAGE_SIZE), F.lit(1)).cast("long")
    # without ``by`` there is one tracker
    one = F.lit(0).alias("_one")
    total = pages.groupBy(*by, one).agg(wanted.alias("_wanted"))
    chain = pinned(page_chain(pages, field, by).filter("NOT in_cycle").withColumn("run", F.coalesce("run", F.lit(""))))
    spans = chain.groupBy(*by, "run", one).agg(
        F.min_by("page", "place").alias("_first"), F.max("place").alias("place")
    )
    # each run's last page
    runs = spans.join(chain, [*by, "run", "place"]).select(
        *by, "run", "_one", "_first", F.col("page").alias("_last"), F.col("end").alias("cursor")
    )
    # a row per run, so a window holds no more than a tracker's gaps
    order = Window.partitionBy(*by, "_one").orderBy("_first")
    following = runs.withColumn("_next", F.lead("_first").over(order)).filter("cursor IS NOT NULL")
    beyond = F.coalesce("_next", F.greatest(F.col("_wanted"), F.col("_last") + 2))
    between = following.join(total, [*by, "_one"]).select(
        *by, "cursor", (F.col("_last") + 1).alias("first_page"),
        (beyond - F.col("_last") - 1).cast("long").alias("pages"),
    )
    begins = runs.groupBy(*by, "_one").agg(
        F.min("_first").alias("pages"), F.max(F.col("run") == "").alias("_begun")
    )
    start = begins.filter("NOT _begun").select(
        *by, F.lit(None).cast("string").alias("cursor"), F.lit(0).cast("long").alias("first_page"), "pages"
    )
    return between.unionByName(start)
