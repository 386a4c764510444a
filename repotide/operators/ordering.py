"""Row order at scale: predecessor values and dense ids without one big window.

A window over a whole repository, or over all rows, puts every row of it into
one task. Instead the rows are cut into key-sorted ranges of even size, each
range is handled by its own task, and what a range needs from the ones before
it (the last row, or the number of rows) comes from a table with one row per
range and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repotide.session import pinned

CHUNK = "_chunk"
PLACE = "_place"
# monotonically_increasing_id keeps the row's place in its partition there.
_PLACE_BITS = (1 << 33) - 1


def order_key(order: Sequence[str], grouped: Sequence[str] = ()) -> Column:
    """One comparable column for an order; parts constant in a group drop out.

    A single number keeps ``min_by``/``max_by`` in the hash aggregate.
    """
    parts = [name for name in order if name not in grouped] or list(order)
    return F.col(parts[0]) if len(parts) == 1 else F.struct(*parts)


def range_chunks(df: DataFrame, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Cut ``df`` into sorted ranges of (by, order).

    ``_chunk`` numbers the ranges and ``_place`` the rows of a range. Range
    bounds are sampled anew by every run of a plan, so both are pinned in the
    shared folder before anyone relies on them. ``order``
    must be unique within ``by`` for even cuts and stable results.
    """
    return pinned(
        df.repartitionByRange(*by, *order)
        .sortWithinPartitions(*by, *order)
        .withColumns(
            {
                CHUNK: F.spark_partition_id(),
                PLACE: F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS)),
            }
        )
    )


def id_chunks(df: DataFrame, dense_id: str, rows: int = 1 << 20) -> DataFrame:
    """Cut ``df`` by an id that numbers the rows of a group from 0 on.

    No range exceeds ``rows`` rows of a group and the cut depends on the id
    alone, so neither a sort nor a checkpoint is needed.
    """
    return df.withColumns({CHUNK: F.floor(F.col(dense_id) / rows), PLACE: F.col(dense_id)})


def with_previous(
    chunked: DataFrame, columns: Sequence[str], by: Sequence[str] = (), prefix: str = "previous_"
) -> DataFrame:
    """Add each row's predecessor within ``by`` for ``columns``; null at the start.

    The last row of a range is added to the group's next range as a seed row,
    ahead of its own rows.
    """
    cut = [*by, CHUNK]
    following = F.lead(CHUNK).over(Window.partitionBy(*by).orderBy(CHUNK))
    seeds = (
        chunked.groupBy(*cut)
        .agg(*[F.max_by(c, PLACE).alias(c) for c in columns])
        .select(*by, following.alias(CHUNK), *columns, F.lit(-1).cast("long").alias(PLACE))
        .filter(F.col(CHUNK).isNotNull())
    )
    in_chunk = Window.partitionBy(*cut).orderBy(PLACE)
    return (
        chunked.unionByName(seeds, allowMissingColumns=True)
        .select("*", *[F.lag(c).over(in_chunk).alias(prefix + c) for c in columns])
        .filter(F.col(PLACE) >= 0)
        .drop(CHUNK, PLACE)
    )


def dense_ids(
    chunked: DataFrame, by: Sequence[str] = (), id_column: str = "id"
) -> DataFrame:
    """Number the rows of each ``by`` from 0 in their order, without gaps.

    A row's id is its place in the range plus a shift that is the same for all
    rows of a group in a range, so the rows themselves are not sorted again. The
    shifts are pinned: there are few, and joining them moves no rows.
    """
    cut = [*by, CHUNK]
    earlier = (
        Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    spans = chunked.groupBy(*cut).agg(
        F.min(PLACE).alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    rows_before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    shifts = pinned(spans.select(*cut, (rows_before - F.col("_first")).alias("_shift")))
    kept = [c for c in chunked.columns if c not in (CHUNK, PLACE)]
    return chunked.join(shifts, cut).select(
        (F.col(PLACE) + F.col("_shift")).alias(id_column), *kept
    )
