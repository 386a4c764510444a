"""Surrogate keys: dimensions, value-to-id lookups, anti-joins, orphans.

Lookups are plain equi-joins. Spark broadcasts a side only when its measured
size allows it and otherwise sorts and merges, splitting the partition of a
hot value (see ``session.SETTINGS``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotide.operators.ordering import dense_ids, range_chunks
from repotide.session import pinned


def null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Join condition under which null equals null."""
    condition = None
    for left_name, right_name in pairs:
        same = left[left_name].eqNullSafe(right[right_name])
        condition = same if condition is None else condition & same
    return condition


def without_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among ``known``; a null key equals a null key."""
    right = known.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    return df.join(right, null_safe(df, right, [(k, f"_known_{k}") for k in keys]), "left_anti")


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of rows with equal keys the first in ``order``; of equal places the smallest row."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*[o for o in order if o not in keys], *rest)).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def first_seen(
    df: DataFrame, key: str, attributes: Sequence[str], order: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """One row per key with the attributes of its first row in ``order``."""
    first = F.min(F.struct(*order, *[a for a in attributes if a not in order])).alias("_first")
    return df.groupBy(*by, key).agg(first).select(
        *by,
        *[F.col(f"_first.{a}").alias(a) for a in attributes],
        key,
        *[F.col(f"_first.{o}").alias(f"_order_{i}") for i, o in enumerate(order)],
    )


def new_members(
    df: DataFrame,
    key: str,
    attributes: Sequence[str],
    order: Sequence[str],
    by: Sequence[str] = (),
    stored: DataFrame | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Distinct keys not in ``stored``, numbered in first-seen order.

    Ids start at 0, or after the largest stored id of the same ``by``.
    ``distinct`` says that no key repeats in ``df`` and saves the aggregation.
    """
    seen_order = [f"_order_{i}" for i in range(len(order))]
    if distinct:
        renamed = [F.col(o).alias(seen) for o, seen in zip(order, seen_order)]
        seen = df.select(*by, *attributes, key, *renamed)
    else:
        seen = first_seen(df, key, attributes, order, by)
    if stored is not None:
        seen = without_known(seen, stored, [*by, key])
    return numbered_after(seen, seen_order, by, stored).select("id", *by, *attributes, key)


def numbered_after(
    df: DataFrame, order: Sequence[str], by: Sequence[str] = (), stored: DataFrame | None = None
) -> DataFrame:
    """``df`` with an ``id`` in ``order``, from 0 or after the largest stored id of the same ``by``."""
    numbered = dense_ids(range_chunks(df, order, by), by)
    return numbered if stored is None else _after_stored(numbered, stored, by)


def dimension(
    df: DataFrame,
    key: str,
    attributes: Sequence[str],
    order: Sequence[str],
    by: Sequence[str] = (),
    stored: DataFrame | None = None,
    distinct: bool = False,
) -> DataFrame:
    """All members: the ``stored`` ones with their ids, and the new ones."""
    fresh = new_members(df, key, attributes, order, by, stored, distinct)
    return fresh if stored is None else stored.select(fresh.columns).unionByName(fresh)


def _after_stored(numbered: DataFrame, stored: DataFrame, by: Sequence[str]) -> DataFrame:
    following = F.coalesce(F.max("id") + 1, F.lit(0))
    if not by:
        start = stored.agg(following).first()[0]
        return numbered.withColumn("id", F.col("id") + F.lit(start))
    # pinned, as the new members may be appended to ``stored`` before they are read again
    starts = pinned(stored.groupBy(*by).agg(following.alias("_start")))
    return (
        numbered.join(starts, [*by], "left")
        .withColumn("id", F.col("id") + F.coalesce("_start", F.lit(0)))
        .select(numbered.columns)
    )


def lookup(
    df: DataFrame,
    column: str,
    dim: DataFrame,
    dim_column: str,
    out: str,
    by: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Add the id of ``column``'s value in ``dim``; unknown values give null.

    Where ``dim`` holds a value twice the largest id wins; ``unique`` says it
    does not and saves the aggregation.
    """
    ids = dim.select(*[F.col(b).alias(f"_by_{b}") for b in by], F.col(dim_column).alias("_value"), "id")
    if not unique:
        ids = ids.groupBy(*[f"_by_{b}" for b in by], "_value").agg(F.max("id").alias("id"))
    ids = ids.withColumnRenamed("id", "_id")
    pairs = [*[(b, f"_by_{b}") for b in by], (column, "_value")]
    joined = df.join(ids, null_safe(df, ids, pairs), "left")
    return joined.select(*[df[c] for c in df.columns], ids["_id"].alias(out))


def no_references(dim_column: str) -> Column:
    """What ``lookup_list`` gives for an empty array."""
    nothing = F.array(F.struct(F.lit(None).cast("long").alias(dim_column)))
    return nothing.cast(f"array<struct<{dim_column}: bigint>>")


def lookup_list(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    dim: DataFrame,
    dim_column: str,
    out: str,
    by: Sequence[str] = (),
    unique: bool = False,
    empty: bool = True,
) -> DataFrame:
    """``keys`` plus the ids of an array's values, in order, as structs.

    Unknown values give a null id, an empty array gives one null id. Empty
    arrays skip the join, so they do not pile up on one null key. ``keys``
    must identify a row and include ``by``. Without ``empty`` rows with empty arrays
    are left out.
    """
    entry = f"array<struct<{dim_column}: bigint>>"
    slim = df.select(*keys, F.coalesce(column, F.array().cast("array<string>")).alias("_values"))
    single = slim.select(*keys, F.posexplode("_values").alias("_pos", "_one"))
    found = lookup(single, "_one", dim, dim_column, "_ref", by, unique)
    pair = F.struct("_pos", F.struct(F.col("_ref").alias(dim_column)).alias("_entry"))
    listed = found.groupBy(*keys).agg(F.sort_array(F.collect_list(pair)).alias("_pairs"))
    full = listed.select(*keys, F.transform("_pairs", lambda p: p["_entry"]).cast(entry).alias(out))
    if not empty:
        return full
    return full.unionByName(
        slim.filter(F.size("_values") == 0).select(*keys, no_references(dim_column).alias(out))
    )


def orphans(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, by: Sequence[str] = ()
) -> DataFrame:
    """Distinct non-null references of ``child`` that ``parent`` does not hold."""
    refs = child.select(*by, column).filter(F.col(column).isNotNull()).distinct()
    held = parent.select(*by, F.col(parent_column).alias(column))
    return refs.join(held, [*by, column], "left_anti")


def constraint_report(
    tables: Mapping[str, DataFrame],
    ids: Mapping[str, str],
    foreign_keys: Sequence[tuple[str, str, str]],
    by: Sequence[str] = (),
) -> DataFrame:
    """Broken keys of many tables: rule, table, column, by, value and the number of rows.

    ``ids`` names the tables' unique columns, ``foreign_keys`` lists (table, column, target)
    with targets among ``ids``. Rule ``unique`` is an id that is there more than once,
    ``foreign`` a non-null reference that its target does not hold. All tables' keys are
    counted per value in tasks and meet in one shuffle. Keys are whole numbers; what names
    a table that is not in ``tables`` is passed over.
    """
    keys = [k for k in foreign_keys if k[0] in tables and k[2] in tables]
    parts = []
    for table, column in ids.items():
        if table in tables:
            value = F.col(column).cast("long").alias("value")
            parts.append(tables[table].select(F.lit(table).alias("_target"), *by, value, F.lit(-1).alias("_key")))
    for place, (table, column, target) in enumerate(keys):
        value = F.col(column).cast("long").alias("value")
        parts.append(tables[table].select(F.lit(target).alias("_target"), *by, value, F.lit(place).alias("_key")))
    if not parts:  # nothing to judge: no rows, but the same columns
        some = next(iter(tables.values()))
        nothing = F.lit(None).cast("long").alias("value")
        parts.append(some.select(F.lit("").alias("_target"), *by, nothing, F.lit(-1).alias("_key")).limit(0))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    held = F.count(F.when(F.col("_key") == -1, 1))
    counts = [F.count(F.when(F.col("_key") == place, 1)).alias(f"_{place}") for place in range(len(keys))]
    judged = whole.filter("value IS NOT NULL").groupBy("_target", *by, "value").agg(held.alias("_held"), *counts)

    def broken(rule: str, table: Column, column: Column, rows: str) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"), table.alias("table"), column.alias("column"), F.col(rows).alias("rows")
        )

    named = [F.when(F.col("_target") == table, column) for table, column in ids.items()]
    id_column = F.coalesce(*named, F.lit(None).cast("string"))
    found = [F.when(F.col("_held") > 1, broken("unique", F.col("_target"), id_column, "_held"))]
    for place, (table, column, _) in enumerate(keys):
        lost = (F.col("_held") == 0) & (F.col(f"_{place}") > 0)
        found.append(F.when(lost, broken("foreign", F.lit(table), F.lit(column), f"_{place}")))
    listed = judged.select(*by, "value", F.explode(F.array_compact(F.array(*found))).alias("_found"))
    return listed.select("_found.rule", "_found.table", "_found.column", *by, "value", "_found.rows")
