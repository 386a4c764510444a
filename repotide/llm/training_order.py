"""Training-order materialisation: every sequence gets its place by a keyed permutation.

A document's token ids are cut into sequences of a fixed length, the last one
padded. Sequences are numbered without gaps; a keyed Feistel network permutes
the numbers, walking the cycle until it lands inside the range, so the slots
are a permutation of 0..n-1 that needs no shuffle list and no sort by random
keys. Range partitions over the slots then write shards in which the record of
slot ``s`` lies at byte ``(s mod records) * stride``: a reader seeks straight
to any slot and resumes there.

Byte-level ids are one byte each: the text's UTF-8 bytes, then ``END``, then
``PAD``; neither occurs in UTF-8. Other ids come as an array column and are
written with the given numpy type. Null and empty texts are one sequence of
``END`` and padding. Rows with the same id stay separate documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

END, PAD = 0xFF, 0xFE
LENGTH, RECORDS, KEY = 2048, 256, 0x5EED
ROUNDS = 6
#: Rows a bucket is meant to hold, and the most buckets one table may have.
_BUCKET_ROWS, _MOST_BUCKETS = 2000, 1 << 17


def feistel(numbers: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Where a keyed permutation of 0..n-1 sends ``numbers``."""
    half = np.uint64(max(1, ((max(n - 1, 1)).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    x = numbers.astype(np.uint64)
    open_ = np.ones(len(x), bool)
    with np.errstate(over="ignore"):
        while open_.any():
            left, right = x[open_] >> half, x[open_] & mask
            for turn in range(ROUNDS):
                f = right + np.uint64((key * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) % (1 << 64))
                f = (f ^ (f >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                f = (f ^ (f >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                left, right = right, left ^ ((f ^ (f >> np.uint64(31))) & mask)
            x[open_] = left << half | right
            open_ = x >= np.uint64(n)
    return x.astype(np.int64)


def byte_ids(text: str = "text") -> Column:
    """A text as one-byte token ids with the end mark."""
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    return F.concat(raw, F.lit(bytes([END])))


def sequences(docs: DataFrame, ids: Column, length: int = LENGTH, width: int = 1) -> DataFrame:
    """doc_id, part, number, tokens: fixed-length records, numbered without gaps.

    ``ids`` is a binary column with ``width`` bytes per token. Documents are
    dealt to hash buckets of a few thousand rows; a table with one row per
    bucket says where each bucket's numbers begin.
    """
    stride = length * width
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), ids.alias("_ids"))
    rows = rows.withColumn("_parts", F.ceil(F.octet_length("_ids") / stride).cast("int"))
    narrow = rows.select("doc_id", F.crc32("_ids").alias("_crc"), "_parts")
    count = min(max(1, docs.count() // _BUCKET_ROWS), _MOST_BUCKETS)
    bucket = F.pmod(F.xxhash64("doc_id", "_crc"), F.lit(count)).cast("long")
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        narrow.groupBy(bucket.alias("_bucket"))
        .agg(F.sum("_parts").alias("_n"))
        .withColumn("_begin", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select("_bucket", "_begin")
    )
    inside = (
        Window.partitionBy("_bucket")
        .orderBy("doc_id", "_crc")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        rows.withColumn("_crc", F.crc32("_ids"))
        .withColumn("_bucket", bucket)
        .withColumn("_first", F.coalesce(F.sum("_parts").over(inside), F.lit(0)))
        .join(begins, "_bucket")
    )
    cut = F.transform(
        F.sequence(F.lit(0), F.col("_parts") - 1),
        lambda i: F.substring("_ids", i * stride + 1, F.lit(stride)),
    )
    return placed.select(
        "doc_id", (F.col("_begin") + F.col("_first")).alias("_number"), F.posexplode(cut)
    ).select(
        "doc_id",
        F.col("pos").alias("part"),
        (F.col("_number") + F.col("pos")).alias("number"),
        F.col("col").alias("tokens"),
    )


def training_order(numbered: DataFrame, n: int, key: int = KEY) -> DataFrame:
    """Add the global ``slot`` of each of the ``n`` numbered sequences."""

    @F.pandas_udf("long")
    def slot(numbers: pd.Series) -> pd.Series:
        return pd.Series(feistel(numbers.to_numpy(), n, key))

    return numbered.withColumn("slot", slot("number"))


def shards(
    ordered: DataFrame, length: int = LENGTH, records: int = RECORDS, width: int = 1, pad: int = PAD
) -> DataFrame:
    """One row per shard: shard, first_slot, records, stride, payload, doc_ids, parts.

    Ranges of slots go to tasks whole; a shard is ``records`` rows, so the cut
    is by number and no group can grow.
    """
    stride = length * width
    filler = int(pad).to_bytes(width, "little")
    shard = F.floor(F.col("slot") / records).cast("long")
    ranged = (
        ordered.select(shard.alias("shard"), "slot", "doc_id", "part", "tokens")
        .repartitionByRange("shard")
        .sortWithinPartitions("slot")
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            for number, rows in batch.groupby("shard", sort=True):
                if held and held[0]["shard"].iloc[0] != number:
                    yield closed(held)
                    held = []
                held.append(rows)
        if held:
            yield closed(held)

    def closed(held: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(held)
        payload = b"".join(
            bytes(t) + filler * ((stride - len(t)) // width) for t in rows["tokens"]
        )
        return pd.DataFrame(
            {
                "shard": [rows["shard"].iloc[0]],
                "first_slot": [rows["slot"].iloc[0]],
                "records": [len(rows)],
                "stride": [stride],
                "payload": [payload],
                "doc_ids": [rows["doc_id"].astype("Int64").tolist()],
                "parts": [rows["part"].tolist()],
            }
        )

    return ranged.mapInPandas(
        write,
        "shard long, first_slot long, records int, stride int, payload binary,"
        " doc_ids array<long>, parts array<int>",
    )


def materialise(
    docs: DataFrame, ids: Column | None = None, length: int = LENGTH, records: int = RECORDS,
    width: int = 1, pad: int = PAD, key: int = KEY,
) -> DataFrame:
    """Documents to shards in training order."""
    ids = byte_ids() if ids is None else ids
    stride = length * width
    total = docs.select(F.ceil(F.octet_length(ids) / stride).alias("n")).agg(F.sum("n")).first()[0]
    numbered = sequences(docs, ids, length, width)
    return shards(training_order(numbered, int(total or 0), key), length, records, width, pad)


def write_shards(df: DataFrame, path: str) -> None:
    """Keep shards as a table; slots lie in order, so readers prune by shard."""
    df.write.parquet(path)


def read_from(spark: SparkSession, path: str, slot: int, count: int) -> DataFrame:
    """``count`` records from ``slot`` on as (slot, doc_id, part, tokens)."""
    stored = spark.read.parquet(path)
    wanted = stored.filter(
        (F.col("first_slot") < slot + count) & (F.col("first_slot") + F.col("records") > slot)
    )
    each = wanted.select(
        "first_slot", "stride", "payload", "doc_ids", "parts",
        F.explode(F.sequence(F.lit(0), F.col("records") - 1)).alias("_at"),
    )
    return each.select(
        (F.col("first_slot") + F.col("_at")).alias("slot"),
        F.element_at("doc_ids", F.col("_at") + 1).alias("doc_id"),
        F.element_at("parts", F.col("_at") + 1).alias("part"),
        F.substring("payload", F.col("_at") * F.col("stride") + 1, F.col("stride")).alias("tokens"),
    ).filter(F.col("slot").between(slot, slot + count - 1))
