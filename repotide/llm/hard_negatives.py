"""Hard negatives by Four-Russians scoring: exact inner products from table lookups.

Candidates are laid out once as bit planes: component d of eight neighbours in a
group is one bit of a byte, so a candidate is a byte per (plane, group). For an
anchor and a group, a table holds the sums of all 256 subsets of the anchor's eight
components. A candidate's byte looks its sum up; the sums of a plane are added, and
planes are shifted and added from the top one down (which counts negatively, in
two's complement), giving the full exact integer product without a multiplication.

Anchors are a stated query set. They are taken in waves, in the order of their ids;
the tables of a wave fit ``TABLE_BYTES``, so what is sent to the tasks has this
bound whatever the input. Each wave passes over the packed candidates twice: once
for the positives of every anchor, which give the score window of each, and once
for the negatives inside these windows. A task keeps the best few of every anchor
and window; the lists of all tasks meet by anchor and are merged as they stream by.
No pair of rows is ever a row.

Rows with a null id, label or vector, and vectors with a null or non-finite
component, take no part. Shorter vectors count as filled up with zeros. An anchor
row that is there twice is one anchor; a candidate that is there twice counts
twice. Rows with the anchor's id are neither its positives nor its negatives.
Scores that a long may not hold are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import batch_of, binaries, map_arrow, stored

POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
TABLE_BYTES = 1 << 26
_ANCHORS, _CHUNK, _PART = 256, 4096, 32
_BLOCK_BYTES = 1 << 16
_NONE = np.int64(-(1 << 62))
_NO_ID = np.int64((1 << 63) - 1)


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * c) of every component, taken as a double."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * float(scale)) + 0)


def finite(vector: Column) -> Column:
    """Whether the vector is there and all its components are numbers."""
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector.cast("array<double>"), odd), F.lit(False))


# --- bit planes ---------------------------------------------------------------

def matrix_of(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows of integers, filled up with zeros to ``width``."""
    sizes = np.diff(np.asarray(lists.offsets))
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lists), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(
        np.cumsum(sizes) - sizes, sizes
    )] = values
    return out


def bit_planes(x: np.ndarray, planes: int) -> np.ndarray:
    """(planes, groups, rows) bytes of two's complement integers (rows, 8 * groups)."""
    rows, width = x.shape
    out = np.empty((planes, width // 8, rows), np.uint8)
    for p in range(planes):
        bits = ((x >> p) & 1).astype(np.uint8)
        out[p] = np.packbits(bits, axis=1, bitorder="little").T
    return out


def subset_sums(anchors: np.ndarray, kind) -> np.ndarray:
    """(groups, 256, anchors): the sums of all subsets of eight components."""
    count, width = anchors.shape
    table = np.zeros((width // 8, 256, count), kind)
    for d in range(width):
        group, bit = divmod(d, 8)
        np.add(
            table[group, : 1 << bit], anchors[:, d].astype(kind), out=table[group, 1 << bit : 2 << bit]
        )
    return table


def scores(table: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Products of all candidates (rows) and anchors (columns)."""
    count = planes.shape[2]
    total = np.zeros((count, table.shape[2]), table.dtype)
    looked = np.empty_like(total)
    top = planes.shape[0] - 1
    for p in range(top, -1, -1):
        if p < top - 1:
            total <<= 1
        elif p == top - 1:
            total *= -2  # the sign's plane
        for g in range(planes.shape[1]):
            np.take(table[g], planes[p, g], axis=0, out=looked, mode="clip")
            total += looked
    return total if top else -total


class _Shape:
    """What all tasks agree on: padded width, planes, and the integers that hold every sum."""

    def __init__(self, width: int, least: int, most: int) -> None:
        self.width = max(8, -(-width // 8) * 8)
        self.planes = max(int(most).bit_length(), int(-least - 1).bit_length() if least < 0 else 0) + 1
        bound = self.width * max(abs(least), abs(most), 1) << (self.planes + 1)
        if bound >= 1 << 55:
            raise ArithmeticError("components too large: a product may not fit a long")
        self.kind = np.int32 if bound < 1 << 31 else np.int64
        self.rows_per_block = max(64, _BLOCK_BYTES // (self.planes * self.width // 8))

    def wave(self) -> int:
        one = self.width // 8 * 256 * np.dtype(self.kind).itemsize
        return max(_PART, TABLE_BYTES // one // _PART * _PART)


def _packed(rows: DataFrame, shape: _Shape) -> DataFrame:
    """Candidates in blocks: ids, labels and bit planes as bytes."""

    def block(ids, labels, x):
        return batch_of(
            ids=binaries([ids.tobytes()]),
            labels=binaries([labels.tobytes()]),
            planes=binaries([bit_planes(x, shape.planes).tobytes()]),
        )

    def each(batches):
        held = None
        for batch in batches:
            own = [
                batch.column(0).to_numpy(), batch.column(1).to_numpy(),
                matrix_of(batch.column(2), shape.width),
            ]
            held = own if held is None else [np.concatenate(p) for p in zip(held, own)]
            while len(held[0]) >= shape.rows_per_block:
                yield block(*[h[: shape.rows_per_block] for h in held])
                held = [h[shape.rows_per_block :] for h in held]
        if held is not None and len(held[0]):
            yield block(*held)

    return rows.select("id", "label", "x").mapInArrow(
        each, "ids binary, labels binary, planes binary"
    )


def _chunks(batches, shape: _Shape) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids, labels and planes of some thousand candidates each, by rising id."""
    parts, rows = [], 0

    def ready():
        ids, labels, planes = (np.concatenate(p, axis=-1) for p in zip(*parts))
        order = np.argsort(ids, kind="stable")
        return ids[order], labels[order], np.ascontiguousarray(planes[:, :, order])

    for batch in batches:
        for ids, labels, planes in zip(*[batch.column(k).to_pylist() for k in range(3)]):
            ids = np.frombuffer(ids, np.int64)
            parts.append((
                ids, np.frombuffer(labels, np.int64),
                np.frombuffer(planes, np.uint8).reshape(shape.planes, shape.width // 8, len(ids)),
            ))
            rows += len(ids)
            if rows >= _CHUNK:
                yield ready()
                parts, rows = [], 0
    if parts:
        yield ready()


# --- the best few ---------------------------------------------------------------

def _best(ids: np.ndarray, values: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Along the last axis, the ``keep`` largest values; of equals the smallest ids."""
    order = np.lexsort((ids, -values), axis=-1)[..., :keep]
    return np.take_along_axis(ids, order, -1), np.take_along_axis(values, order, -1)


def _nothing(*shape: int) -> tuple[np.ndarray, np.ndarray]:
    return np.full(shape, _NO_ID), np.full(shape, _NONE)


def _joined(a, b, keep: int):
    return _best(np.concatenate((a[0], b[0]), -1), np.concatenate((a[1], b[1]), -1), keep)


def _ranked(values: np.ndarray, out: np.ndarray) -> np.ndarray:
    """One number per candidate (column) that falls with its rank; ``out`` ones come last."""
    count = values.shape[1]
    code = values.astype(np.int64) * -count + np.arange(count)
    code[out] = -_NONE
    return code


def _decoded(code: np.ndarray, ids: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    there = code != -_NONE
    place = np.where(there, code % count, 0)
    return (
        np.where(there, ids[place], _NO_ID), np.where(there, -((code - place) // count), _NONE)
    )


class _Anchors:
    """A wave: ids, labels and vectors sorted by label, and their tables by part."""

    def __init__(self, rows: list, shape: _Shape) -> None:
        rows = sorted(rows, key=lambda r: (r["label"], r["id"], r["x"]))
        self.ids = np.array([r["id"] for r in rows], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int64)
        self.x = np.zeros((len(rows), shape.width), np.int64)
        for k, r in enumerate(rows):
            self.x[k, : len(r["x"])] = r["x"]
        self.windows: tuple[np.ndarray, np.ndarray] | None = None  # (anchors, positives)

    def tables(self, kind) -> list[tuple[slice, np.ndarray]]:
        parts = [slice(k, min(k + _ANCHORS, len(self.ids))) for k in range(0, len(self.ids), _ANCHORS)]
        return [(part, subset_sums(self.x[part], kind)) for part in parts]


def _same_label(anchors, part, table, ids, labels, planes, keep):
    """The best candidates of each anchor's own label in a chunk."""
    found = _nothing(part.stop - part.start, keep)
    own = anchors.labels[part]
    for label in np.unique(own):
        a, b = np.searchsorted(own, label), np.searchsorted(own, label, side="right")
        here = np.flatnonzero(labels == label)
        if not len(here):
            continue
        some = scores(np.ascontiguousarray(table[:, :, a:b]), np.ascontiguousarray(planes[:, :, here]))
        itself = anchors.ids[part][a:b, None] == ids[here][None]
        code = _ranked(some.T, itself)
        if code.shape[1] > keep:
            code = np.partition(code, keep - 1, axis=1)[:, :keep]
        first = _decoded(np.sort(code, axis=1), ids[here], len(here))
        found[0][a:b, : first[0].shape[1]], found[1][a:b, : first[1].shape[1]] = first
    return found


def _in_windows(anchors, part, table, ids, labels, planes, keep):
    """The best candidates of other labels in each window of each anchor."""
    low, high = (w[part] for w in anchors.windows)
    some = scores(table, planes).T
    count = some.shape[1]
    out = (anchors.labels[part][:, None] == labels[None]) | (anchors.ids[part][:, None] == ids[None])
    code = np.sort(_ranked(some, out), axis=1)
    found_ids, found = _nothing(len(low), low.shape[1], keep)
    padded = np.concatenate((code, np.full((len(code), keep), -_NONE)), 1)
    for p in range(low.shape[1]):
        # the first place whose score is not above the window
        start = (code < (high[:, p] * -count)[:, None]).sum(1)
        near = np.take_along_axis(padded, start[:, None] + np.arange(keep), 1)
        near_ids, near_values = _decoded(near, ids, count)
        inside = near_values >= np.maximum(low[:, p], _NONE + 1)[:, None]
        found_ids[:, p] = np.where(inside, near_ids, _NO_ID)
        found[:, p] = np.where(inside, near_values, _NONE)
    return found_ids, found


def _gathered(packed: DataFrame, shared, shape: _Shape, choose, tail: tuple[int, ...]) -> DataFrame:
    """Every task's best as (part, ids, scores), merged by part of ``_PART`` anchors."""
    keep = tail[-1]

    def each(batches):
        anchors = shared.value
        tables = anchors.tables(shape.kind)
        best = [_nothing(part.stop - part.start, *tail) for part, _ in tables]
        for chunk in _chunks(batches, shape):
            for k, (part, table) in enumerate(tables):
                best[k] = _joined(best[k], choose(anchors, part, table, *chunk, keep), keep)
        ids, values = (np.concatenate([b[k] for b in best]) for k in range(2))
        starts = range(0, len(ids), _PART)
        yield batch_of(
            part=np.arange(len(starts), dtype=np.int64),
            ids=binaries([ids[s : s + _PART].tobytes() for s in starts]),
            scores=binaries([values[s : s + _PART].tobytes() for s in starts]),
        )

    def merge(batches):
        part, held = None, None
        for batch in batches:
            for now, *pair in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                own = [np.frombuffer(p, np.int64).reshape(-1, *tail) for p in pair]
                if now != part and held is not None:
                    yield packed_row(part, held)
                held = own if now != part else _joined(held, own, keep)
                part = now
        if held is not None:
            yield packed_row(part, held)

    def packed_row(part, held):
        return batch_of(
            part=np.array([part], np.int64),
            ids=binaries([held[0].tobytes()]), scores=binaries([held[1].tobytes()]),
        )

    schema = "part long, ids binary, scores binary"
    tasks = packed.mapInArrow(each, schema)
    return tasks.repartition("part").sortWithinPartitions("part").mapInArrow(merge, schema)


def _rows_of(
    merged: DataFrame, shared, positives: tuple[np.ndarray, np.ndarray], negatives: int
) -> DataFrame:
    """A row per anchor, positive and negative."""
    wave = merged.sparkSession.sparkContext.broadcast(positives)

    def run(batch):
        anchors, (ids, values) = shared.value, wave.value
        out: list[list[np.ndarray]] = []
        for part, *pair in zip(*[batch.column(k).to_pylist() for k in range(3)]):
            tail = (-1, ids.shape[1], negatives)
            found, far = (np.frombuffer(p, np.int64).reshape(tail) for p in pair)
            a, p, r = np.nonzero(far != _NONE)
            at = a + part * _PART
            out.append(
                [anchors.ids[at], ids[at, p], r + 1, found[a, p, r], values[at, p], far[a, p, r]]
            )
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 6
        columns[2] = columns[2].astype(np.int32)
        return batch_of(**dict(zip(_OUT, columns)))

    return map_arrow(merged, run, ", ".join(f"{n} {k}" for n, k in _OUT.items()))


_OUT = {
    "anchor_id": "long", "positive_id": "long", "rank": "int", "negative_id": "long",
    "positive_score": "long", "negative_score": "long",
}


def mine(
    rows: DataFrame,
    anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    wave: int | None = None,
) -> DataFrame:
    """Hard negatives of the rows (id, label, x) for which ``anchor`` holds.

    Of an anchor's rows of the same label the ``positives`` best are taken, and
    for each the ``negatives`` best rows of other labels whose score is ``low`` to
    ``high`` per cent of the positive's. ``wave`` is how many anchors are looked up
    at a time; left out, as many as the tables' bound allows.
    """
    spark = rows.sparkSession
    rows = rows.select(
        F.col("id").cast("long"), F.col("label").cast("long"), F.col("x").cast("array<long>")
    ).filter("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    width, least, most = rows.agg(
        F.max(F.size("x")), F.min(F.array_min("x")), F.max(F.array_max("x"))
    ).first()
    empty = spark.createDataFrame([], ", ".join(f"{n} {k}" for n, k in _OUT.items()))
    if width is None:
        return empty
    shape = _Shape(width, least or 0, most or 0)
    packed = stored(_packed(rows, shape), "planes")
    order = ["id", "label", "x"]
    asked = stored(rows.filter(anchor).distinct(), "anchors")
    limit = wave or shape.wave()
    results, left = [], asked
    while taken := left.orderBy(*order).limit(limit).collect():
        last = taken[-1]
        anchors = _Anchors(taken, shape)
        shared = spark.sparkContext.broadcast(anchors)
        found = _gathered(packed, shared, shape, _same_label, (positives,)).collect()
        best = _nothing(len(taken), positives)
        for r in found:
            for k, name in enumerate(("ids", "scores")):
                own = np.frombuffer(r[name], np.int64).reshape(-1, positives)
                best[k][r["part"] * _PART : r["part"] * _PART + len(own)] = own
        there = best[1] != _NONE
        value = np.where(there, best[1], 0)
        # where there is no positive, the window is empty
        anchors.windows = (
            np.where(there, -((-low * value) // 100), 1), np.where(there, high * value // 100, 0)
        )
        shared = spark.sparkContext.broadcast(anchors)
        merged = _gathered(packed, shared, shape, _in_windows, (positives, negatives))
        results.append(stored(_rows_of(merged, shared, best, negatives), "negatives"))
        if len(taken) < limit:
            break
        now = F.struct(*order)
        then = F.struct(
            F.lit(last["id"]).cast("long").alias("id"), F.lit(last["label"]).cast("long").alias("label"),
            F.array(*[F.lit(v) for v in last["x"]]).cast("array<long>").alias("x"),
        )
        left = asked.filter(now > then)
    out = empty
    for part in results:
        out = out.unionByName(part) if out is not empty else part
    return out


def from_embeddings(table: DataFrame) -> DataFrame:
    """The rows (id, label, x) that the query mines: scaled to integers, some labels moved."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return table.filter(finite(F.col("embedding"))).select(
        F.col("vec_id").alias("id"), moved.alias("label"), whole_numbers(F.col("embedding")).alias("x")
    )
