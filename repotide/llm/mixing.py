"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a share of all words by its weight, but at most ``MOST``
times its own words; what is over is shared again by weight. A source first
gives all documents as often as the target allows in full rounds. For the rest
of its budget, documents are counted by exact length; a bounded-knapsack
dynamic program chooses how many of each length fit best, and the documents of
each length are drawn in the order of a seeded hash of the id.

Only counts by (source, length) are gathered for a source; they are bound by
the longest document. Targets need two sums per round and no list of sources
on the driver. Draws cut each (source, length) into hash buckets, so a hot
length is never ranked in one task.

A null source is a source of its own, last in order. Null and empty texts have
length 0 and take nothing. Rows with the same id are separate documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repotide.llm.common import WORD, stored
from repotide.operators.ordering import dense_ids, range_chunks

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
SEED = 53
_BUCKET_BITS = 10
#: Words that the dynamic program is left to place, at least.
_RESERVE = 1 << 15


def word_count(text: str = "text") -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target from (source, source_size), one row each."""
    ordered = range_chunks(sizes.withColumn("_last", F.col("source").isNull()), ["_last", "source"])
    ranked = dense_ids(ordered, id_column="_rank").withColumn(
        "_weight",
        F.element_at(
            F.array(*[F.lit(float(w)) for w in weights]),
            (F.col("_rank") % len(weights) + 1).cast("int"),
        ),
    )
    ranked = stored(ranked.select("source", "source_size", "_weight"), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    limit, rate = F.col("source_size") * float(most), 0.0
    while total:
        over = F.col("_weight") * rate > limit
        fixed, free = ranked.agg(
            F.sum(F.when(over, limit).otherwise(0.0)), F.sum(F.when(~over, F.col("_weight")))
        ).first()
        if not free or (new := (total - fixed) / free) <= rate:
            break
        rate = new
    return ranked.select(
        "source", "source_size", F.least(limit, F.col("_weight") * rate).alias("target")
    )


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """How many documents of each length to take so that their words come nearest
    to ``budget``; no count is exceeded.

    Each length first gives its even share. Single documents in seeded order
    then bring the rest down to some ten thousand words, and those are placed by
    an exact bounded-knapsack program over all lengths; a sum over the budget
    wins only if it is nearer than any below. A small budget that the shares keep
    from being met is placed by the program alone.
    """
    taken = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.astype(np.int64)
    if budget <= 0:
        return taken
    shares = np.array([int(c) * budget // total for c in counts], np.int64)
    found = _placed(lengths, counts, shares, budget, seed)
    if budget <= _RESERVE and (lengths * found).sum() != budget:
        found = _placed(lengths, counts, taken, budget, seed)
    return found


def _placed(
    lengths: np.ndarray, counts: np.ndarray, taken: np.ndarray, budget: int, seed: int
) -> np.ndarray:
    """``taken`` and what fills the budget best."""
    taken = taken.copy()
    rest = budget - int((lengths * taken).sum())
    for i in np.random.default_rng(seed).permutation(len(lengths)):
        if taken[i] < counts[i] and lengths[i] <= rest - _RESERVE:
            taken[i] += 1
            rest -= int(lengths[i])
    # reachable sums as the bits of one integer, after each bundle of documents
    room = 2 * rest
    bundles, states, reach, full = [], [], 1, (1 << (room + 1)) - 1
    for i in np.argsort(-lengths, kind="stable"):
        left = min(int(counts[i] - taken[i]), room // int(lengths[i]))
        size = 1
        while left > 0 and not reach >> rest & 1:
            size = min(size, left)
            states.append(reach)
            bundles.append((i, size))
            reach |= (reach << (size * int(lengths[i]))) & full
            left -= size
            size *= 2
    below = (reach & ((1 << (rest + 1)) - 1)).bit_length() - 1
    over = reach >> rest
    above = rest + (over & -over).bit_length() - 1 if over else below
    at = above if above - rest < rest - below else below
    for (i, size), before in zip(reversed(bundles), reversed(states)):
        if not before >> at & 1:
            at -= size * int(lengths[i])
            taken[i] += size
    return taken


def _plan_source(rows: pd.DataFrame) -> pd.DataFrame:
    # a shuffle brings rows in any order, and the seeded order counts places
    rows = rows.sort_values("size", ignore_index=True)
    lengths, counts = rows["size"].to_numpy(), rows["n"].to_numpy()
    target, total = float(rows["target"].iloc[0]), int(rows["source_size"].iloc[0])
    rounds = int(target // total) if total else 0
    extra = np.zeros(len(rows), np.int64)
    worth = lengths > 0
    if rounds < MOST and total:
        budget = int(np.floor(target - rounds * total + 0.5))
        extra[worth] = fit_budget(lengths[worth], counts[worth], budget)
    return rows.assign(rounds=min(rounds, MOST), extra=extra)


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target and copies for every row of ``docs``.

    ``copies`` is how often the mix takes the document.
    """
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count().alias("size"),
            F.xxhash64(F.col("doc_id").cast("long"), F.lit(seed)).alias("ticket"),
        ),
        "sizes",
    )
    lengths = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    per_source = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(per_source)
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    wanted = lengths.join(targets, same(lengths, targets)).select(
        lengths["source"], "size", "n", "source_size", "target"
    )
    plan = stored(
        wanted.groupBy("source").applyInPandas(
            _plan_source,
            "source string, size long, n long, source_size long, target double,"
            " rounds long, extra long",
        ),
        "plan",
    )
    planned = rows.join(
        plan, rows["source"].eqNullSafe(plan["source"]) & (rows["size"] == plan["size"])
    ).select(
        "doc_id", rows["source"], rows["size"], "ticket", "n", "source_size", "target", "rounds",
        "extra",
    )
    drawn = F.col("extra").between(1, F.col("n") - 1)
    whole = planned.filter(~drawn).withColumn(
        "copies", F.col("rounds") + (F.col("extra") > 0).cast("long")
    )
    out = ["doc_id", "source", "size", "source_size", "target", "copies"]
    return whole.select(*out).unionByName(_draw(planned.filter(drawn)).select(*out))


def _draw(rows: DataFrame) -> DataFrame:
    """The ``extra`` smallest tickets of each (source, size) get one copy more.

    Counts by hash bucket tell where the cut falls, so only the rows of that
    one bucket are ranked.
    """
    # tickets are signed: the sign bit turned round keeps their order
    rows = rows.withColumn(
        "bucket", F.shiftright(F.col("ticket"), 64 - _BUCKET_BITS).cast("int")
    )
    cut = ["source", "size", "bucket"]
    earlier = (
        Window.partitionBy("source", "size")
        .orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counted = (
        rows.groupBy("source", "size", "bucket")
        .agg(F.count(F.lit(1)).alias("_here"), F.max("extra").alias("_extra"))
        .withColumn("_before", F.coalesce(F.sum("_here").over(earlier), F.lit(0)))
        .withColumn("_left", F.col("_extra") - F.col("_before"))
        .select(
            F.col("source").alias("_source"),
            F.col("size").alias("_size"),
            F.col("bucket").alias("_bucket"),
            "_here",
            "_left",
        )
    )
    placed = rows.join(
        counted,
        F.col("source").eqNullSafe(F.col("_source"))
        & (F.col("size") == F.col("_size"))
        & (F.col("bucket") == F.col("_bucket")),
    )
    split = (F.col("_left") > 0) & (F.col("_left") < F.col("_here"))
    rank = F.row_number().over(Window.partitionBy(*cut).orderBy("ticket", "doc_id"))
    cutting = placed.filter(split).withColumn("_more", rank <= F.col("_left"))
    clear = placed.filter(~split).withColumn("_more", F.col("_left") > 0)
    return cutting.unionByName(clear).withColumn(
        "copies", F.col("rounds") + F.col("_more").cast("long")
    )


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its copies say."""
    wanted = mix(docs.select("doc_id", "source", "text"), seed)
    # rows of one id may differ in length or source, so these belong to the key;
    # what is left of a key are twins that share their copies evenly
    keys = wanted.groupBy("doc_id", "source", "size").agg(
        F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_twins")
    ).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"),
        F.col("size").alias("_size"), "_copies", "_twins",
    )
    # the rows travel as one column, so that none of their names can clash
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col("doc_id").cast("long").alias("_doc"), F.col("source").alias("_from"),
        F.col("text").alias("_text"), word_count().alias("_words"),
    )
    joined = held.join(
        keys,
        F.col("_doc").eqNullSafe(F.col("_id"))
        & F.col("_from").eqNullSafe(F.col("_source"))
        & (F.col("_words") == F.col("_size")),
    )
    twin = F.row_number().over(
        Window.partitionBy("_id", "_source", "_size").orderBy(F.xxhash64("_text"))
    )
    single = joined.filter("_twins = 1").withColumn("_times", F.col("_copies"))
    several = joined.filter("_twins > 1").withColumn("_twin", twin).withColumn(
        "_times",
        F.floor(F.col("_copies") / F.col("_twins"))
        + (F.col("_twin") <= F.col("_copies") % F.col("_twins")).cast("long"),
    ).drop("_twin")
    return (
        single.unionByName(several)
        .filter("_times > 0")
        .withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
        .select("_row.*")
    )
