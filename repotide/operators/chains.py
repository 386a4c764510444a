"""Depths in forests and levels in commit graphs, by pointer doubling.

A row at the end of a chain of a million rows must not wait for a million joins.
Every row keeps a pointer to an ancestor and the number of steps to it; each round
replaces the pointer by the ancestor's own, so steps double and a chain of n rows
takes about log2(n) rounds. Rounds are kept in checkpoints in the shared folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.operators.keys import one_per_key
from repotide.operators.ordering import dense_ids, range_chunks
from repotide.session import pinned


def depths(links: DataFrame, node: str, parent: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, node, root, depth) of every row of ``links``; both null on or behind a cycle.

    ``links`` has one row per node; its parent is null or another row's node of the
    same ``by``.
    """
    up = F.coalesce(parent, node)
    state = pinned(
        links.select(
            *by, node, up.alias("_up"), F.col(parent).isNotNull().cast("long").alias("_steps"),
            F.col(parent).isNull().alias("_done"),
        )
    )
    rows, open_ = state.agg(F.count(F.lit(1)), F.sum(F.when(~F.col("_done"), 1).otherwise(0))).first()
    reached = 1
    while open_ and reached <= 2 * rows:
        told = state.select(
            *by, F.col(node).alias("_up"), F.col("_up").alias("_next"),
            F.col("_steps").alias("_more"), F.col("_done").alias("_ends"),
        )
        moved = (
            state.filter("NOT _done").join(told, [*by, "_up"])
            .select(
                *by, node, F.col("_next").alias("_up"), (F.col("_steps") + F.col("_more")).alias("_steps"),
                F.col("_ends").alias("_done"),
            )
        )
        state = pinned(state.filter("_done").unionByName(moved))
        open_ = state.filter("NOT _done").count()
        reached *= 2
    known = F.col("_done")
    return state.select(
        *by, node, F.when(known, F.col("_up")).alias("root"), F.when(known, F.col("_steps")).alias("depth")
    )


def levels(edges: DataFrame, nodes: DataFrame, node: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, node, level): the longest way to a node without parents; null on or behind a cycle.

    ``edges`` holds (by, node, pos, parent) with parents among ``nodes``. Each node
    follows one parent, at first its first one. The depths of that forest show which
    parents lie deeper than the one followed; all such nodes change over at once, until
    none does. Where branches are merged this settles after as many turns as merges of
    longer branches are nested, whatever their number and the length of the log.
    """
    keys = [*by, node]
    first = one_per_key(edges.select(*keys, "pos", "parent"), keys, ["pos"]).select(*keys, "parent")
    followed = pinned(nodes.select(*keys).join(first, keys, "left"))
    while True:
        found = pinned(depths(followed, node, "parent", by).select(*keys, F.col("depth").alias("level")))
        above = found.select(
            *by, F.col(node).alias("parent"), F.col("level").isNull().alias("_lost"), F.col("level").alias("_level")
        )
        # what lies behind a cycle follows it, so that it is found out too
        best = (
            edges.select(*keys, "parent").join(above, [*by, "parent"])
            .groupBy(*keys)
            .agg(F.max(F.struct("_lost", F.coalesce("_level", F.lit(0)).alias("_level"), "parent")).alias("_best"))
        )
        judged = followed.join(found, keys).join(best, keys, "left")
        lost = F.col("_best._lost") & F.col("level").isNotNull()
        deeper = ~F.col("_best._lost") & (F.col("_best._level") + 1 > F.col("level"))
        changes = F.coalesce(lost | deeper, F.lit(False))
        turned = pinned(
            judged.select(
                *keys, F.when(changes, F.col("_best.parent")).otherwise(F.col("parent")).alias("parent"),
                changes.alias("_changed"),
            )
        )
        if not turned.filter("_changed").limit(1).count():
            return found
        followed = turned.drop("_changed")


def log_order(
    commits: DataFrame, time: str, by: Sequence[str] = (), node: str = "commit_hash", parents: str = "parents"
) -> DataFrame:
    """(by, commit, level, ordinal): an order in which every parent comes before its children.

    Commits go by level, time and hash, numbered from 0 in each repository. Parents that
    did not land are passed over. Commits on or behind a cycle have neither level nor
    ordinal. A commit that landed twice counts once, with its smallest time and lists.
    """
    keys = [*by, node]
    own = pinned(one_per_key(commits.select(*keys, time, parents), keys, [time]))
    known = own.select(*by, F.col(node).alias("parent"))
    edges = (
        own.select(*keys, F.posexplode(parents).alias("pos", "parent"))
        .groupBy(*keys, "parent").agg(F.min("pos").alias("pos"))
        .join(known, [*by, "parent"], "left_semi")
    )
    level = levels(pinned(edges), own, node, by)
    placed = own.select(*keys, time).join(level, keys)
    ordered = range_chunks(placed.filter("level IS NOT NULL"), ["level", time, node], by)
    numbered = dense_ids(ordered, by, "ordinal").select(*keys, "level", "ordinal")
    nothing = F.lit(None).cast("long").alias("ordinal")
    return numbered.unionByName(placed.filter("level IS NULL").select(*keys, "level", nothing))
