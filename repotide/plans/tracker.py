"""Issues and pull requests: items of landed pages to ids and facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.operators.keys import lookup
from repotide.operators.ordering import dense_ids, range_chunks

ITEM_ORDER = ["page", "pos"]


def item_ids(items: DataFrame, id_column: str, by: Sequence[str] = ()) -> DataFrame:
    """All item ids numbered in page order; a repeated id keeps all its rows."""
    slim = items.select(*by, *ITEM_ORDER, id_column)
    return dense_ids(range_chunks(slim, ITEM_ORDER, by), by).select("id", *by, id_column)


def latest_items(
    items: DataFrame, id_column: str, by: Sequence[str] = (), known: DataFrame | None = None
) -> DataFrame:
    """One row per item: its ``id`` if ``known`` holds it, its first place and its latest facts.

    The facts are those of its last page, there of its first place, of equal places the
    smallest row. Items and known ids meet in one shuffle.
    """
    keys = [*by, id_column]
    rest = [c for c in items.columns if c not in keys]
    told = items.withColumn("_landed", F.lit(True))
    if known is None:
        told = told.withColumn("_id", F.lit(None).cast("long"))
    else:
        told = told.unionByName(known.select(*keys, F.col("id").alias("_id")), allowMissingColumns=True)
    last = F.struct((-F.col("page")).alias("_page"), F.col("pos").alias("_order"), *rest)
    found = (
        # items seldom repeat, so rows are moved as they are and not as two aggregates
        told.repartition(*keys)
        .groupBy(*keys)
        .agg(
            F.min(F.when(F.col("_landed"), F.struct(*ITEM_ORDER))).alias("_first"),
            F.min(F.when(F.col("_landed"), last)).alias("_last"),
            F.max("_id").alias("id"),
        )
    )
    places = [F.col(f"_first.{o}").alias(f"_order_{i}") for i, o in enumerate(ITEM_ORDER)]
    return found.filter("_last IS NOT NULL").select(
        "id", *keys, *places, "_last.created_at", "_last.closed_at"
    )


def normalised_items(
    items: DataFrame,
    id_column: str,
    ids: DataFrame,
    by: Sequence[str] = (),
) -> DataFrame:
    """Items with ``<id_column>_key`` in place of the id; of repeated ids the last counts."""
    keyed = lookup(items, id_column, ids, id_column, f"{id_column}_key", by)
    return keyed.select(*by, F.col(f"{id_column}_key"), "created_at", "closed_at")
