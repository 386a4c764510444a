"""Exact dedup by a tree merge of sorted digest runs, in DataFrame functions only.

A text's key is its SHA-256 digest with its length and a second hash: texts count
as equal only if all three agree, so every merge verifies what it joins. Rows are
dealt to runs by their place in the table. A run holds each of its keys once, in
sorted order, with how many rows have it and which of them stays.

Runs merge in rounds, 16 to one, and a round deals keys out by run and by the next
digit of the digest: partners exchange the parts of their runs that the other one
keeps, so the digest range of a run narrows as its rows grow, and no task of any
round holds more than a run's share. The merged runs hold each key once. What they
say about keys of several rows goes down the same tree, from run to run, to the
rows. Copies of one text lie in as many runs as there are, so a text that holds a
third of all rows meets neither its copies nor its answer in one task.

Of equal texts the row with the largest id stays (``largest=False``: the
smallest); of rows that share this id too, the last one of the table. Rows without
an id stay only if no row of their group has one; their ``keep_id`` is null then.
A null text counts as empty. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import stored

KEY = ["digest", "length", "check"]
#: Runs merged to one in a round, as bits; rows dealt to a run, about.
FAN_BITS, ROWS_PER_RUN = 4, 1 << 20
_LEAST_ROUNDS = 2
#: Rows that lie side by side and share a run, as bits.
_NEIGHBOURS = 6


def _text(normalise: Callable[[Column], Column] | None) -> Column:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return text if normalise is None else normalise(text)


def _key(text: Column) -> list[Column]:
    return [
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        F.length(text).alias("length"),
        F.xxhash64(text).alias("check"),
    ]


def rounds_for(rows: int, rows_per_run: int = ROWS_PER_RUN) -> int:
    """Rounds that merge all runs, for runs of no more than about ``rows_per_run`` rows."""
    rounds = _LEAST_ROUNDS
    while rows > rows_per_run << (FAN_BITS * rounds):
        rounds += 1
    return rounds


def _merged(runs: DataFrame, digit: int, best) -> DataFrame:
    """One round: every 16 runs become one, cut by one more digit of the digest."""
    parent = F.shiftright("run", FAN_BITS).alias("run")
    # the slice is a digest's first digits: every round looks at one more of them
    part = F.substring(F.hex("digest"), 1, digit).alias("slice")
    where = ["run", "slice", *KEY]
    dealt = runs.select(parent, part, *KEY, "rows", "best").repartition("run", "slice")
    return (
        dealt.sortWithinPartitions(*where)
        .groupBy(*where)
        .agg(F.sum("rows").alias("rows"), best("best").alias("best"))
        .drop("slice")
    )


def copies(
    docs: DataFrame,
    largest: bool = True,
    normalise: Callable[[Column], Column] | None = None,
    rows_per_run: int = ROWS_PER_RUN,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of ``docs``."""
    best = F.max if largest else F.min
    # what runs are cut by is pinned in the written table
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            *_key(_text(normalise)),
            F.monotonically_increasing_id().alias("place"),
        ),
        "digests",
    )
    rounds = rounds_for(rows.count(), rows_per_run)
    piece = F.xxhash64(F.shiftright("place", _NEIGHBOURS))
    rows = rows.withColumn("run", F.pmod(piece, F.lit(1 << (FAN_BITS * rounds))))
    known = F.col("doc_id").isNotNull() if largest else F.col("doc_id").isNull()
    candidate = F.struct(known.alias("known"), "doc_id", "place")
    levels = [
        stored(
            rows.groupBy("run", *KEY).agg(
                F.count(F.lit(1)).alias("rows"), best(candidate).alias("best")
            ),
            "run",
        )
    ]
    for digit in range(1, rounds + 1):
        levels.append(stored(_merged(levels[-1], digit, best), "run"))
    answer = levels.pop().filter("rows > 1").select(
        "run", *KEY, F.col("rows").alias("group_size"), "best"
    )
    for lower in reversed(levels):
        mine = lower.select(F.col("run").alias("_run"), F.shiftright("run", FAN_BITS).alias("run"), *KEY)
        found = mine.join(answer, ["run", *KEY])
        answer = found.drop("run").withColumnRenamed("_run", "run")
    told = rows.join(answer, ["run", *KEY], "left")
    several = F.col("group_size").isNotNull()
    return told.select(
        "doc_id",
        F.when(several, F.col("best.doc_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (~several | (F.col("best.place") == F.col("place"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one(
    docs: DataFrame, largest: bool = True, normalise: Callable[[Column], Column] | None = None
) -> DataFrame:
    """``docs`` with one row of each text, the one that ``copies`` keeps."""
    left = copies(docs, largest, normalise).filter("kept").select(
        F.struct(F.col("doc_id").alias("id"), F.col("text_sha256").alias("text")).alias("key")
    )
    sha = F.sha2(_text(normalise).cast("binary"), 256)
    own = F.struct(F.col("doc_id").cast("long").alias("id"), sha.alias("text"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(own.alias("key"), whole.alias("row")).alias("a")
    same = F.col("a.key.text") == F.col("b.key.text")
    same &= F.col("a.key.id").eqNullSafe(F.col("b.key.id"))
    found = rows.join(left.alias("b"), same, "left_semi")
    # rows that share their id and text: any one of them, since all came to stay by one answer
    return found.dropDuplicates(["key"]).select("row.*")
