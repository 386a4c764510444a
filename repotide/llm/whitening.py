"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows A of the fit list (each distinct vector once) stay in tasks, packed
in blocks. Every step is one pass over them: a task takes u = A c of its rows and
at once its part of A'u, which sum to one vector of the dimension's size. Beside it
only the squared length of u comes back, so the driver holds vectors of the
dimension's size and never a row.

Left vectors are kept by their coefficients c (u = A c), so their products with each
other are products of c with A'u. That makes full reorthogonalisation on both sides
exact work on the driver: a new left vector is freed from all earlier ones before
and after the pass, a new right vector twice after it. Where a right vector vanishes,
a seeded random one that is orthogonal to all before it goes on, which also finds
repeated eigenvalues. All steps are taken for up to ``ALL_STEPS`` dimensions; beyond
that the wanted components' residuals decide. The small bidiagonal matrix's singular
values and right vectors give the deviations and components.

Rows with a null vector, or a null or non-finite entry, are left out. Shorter vectors
count as filled up with zeros. Components without spread (eigenvalue 0 within
rounding) are left out, so equal vectors and a single one give no rows; neither does
an empty table. Rows with one id are rows of their own, and a null id stays null.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import batch_of, binaries, map_arrow, stored
from repotide.llm.hard_negatives import finite, matrix_of, whole_numbers

COMPONENTS, ALL_STEPS, SEED = 4, 256, 19
_ROWS_PER_BLOCK = 2048
_LARGEST = (1 << 31) - 1
#: Eigenvalues under this part of the largest are rounding.
_FLAT = 1e-13


class Whitening(NamedTuple):
    """What scoring needs; sums are exact."""

    count: int
    sums: np.ndarray
    components: np.ndarray  # dimensions x components, unit columns
    values: np.ndarray  # eigenvalues, falling
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return self.sums / max(self.count, 1)

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.components / np.sqrt(self.values)


class _Rows:
    """The fit list in stored blocks, and sums over it."""

    def __init__(self, vectors: DataFrame, width: int) -> None:
        self.width = width

        def each(batches):
            held = np.zeros((0, width), np.int64)
            for batch in batches:
                held = np.concatenate((held, matrix_of(batch.column(0), width)))
                while len(held) >= _ROWS_PER_BLOCK:
                    yield batch_of(block=binaries([held[:_ROWS_PER_BLOCK].tobytes()]))
                    held = held[_ROWS_PER_BLOCK:]
            if len(held):
                yield batch_of(block=binaries([held.tobytes()]))

        self.blocks = stored(vectors.mapInArrow(each, "block binary"), "blocks")

    def total(self, size: int, f: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
        """The sum of ``f(block)``, ``size`` numbers, over all blocks."""
        width, number = self.width, np.float64 if kind == "double" else np.int64

        def each(batches):
            out = np.zeros(size, number)
            for batch in batches:
                for raw in batch.column(0):
                    out += f(np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, width))
            yield batch_of(place=np.arange(size), value=out)

        summed = (
            self.blocks.mapInArrow(each, f"place long, value {kind}")
            .groupBy("place").agg(F.sum("value").alias("value"))
        )
        out = np.zeros(size, number)
        for r in summed.collect():
            out[r["place"]] = r["value"]
        return out


def bidiagonalise(
    step: Callable[[np.ndarray], np.ndarray], width: int, wanted: int, seed: int = SEED
) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (columns) and singular values, falling.

    ``step(c)`` gives A'(A c), followed by the squared length of A c.
    """
    random = np.random.default_rng(seed)
    right, left, back = (np.zeros((width, 0)) for _ in range(3))
    diagonal, above = [], []

    def fresh() -> np.ndarray | None:
        for _ in range(5):
            v = random.standard_normal(width)
            for _ in range(2):
                v -= right @ (right.T @ v)
            if (size := np.linalg.norm(v)) > 1e-8:
                return v / size
        return None

    v = fresh()
    while v is not None and len(diagonal) < width:
        # free of the earlier left vectors: u_j . A v = (A'u_j) . v
        c = v - left @ (back.T @ v)
        found = step(c)
        g, before = found[:width], float(found[width])
        h = left.T @ g
        c, g = c - left @ h, g - back @ h
        alpha = np.sqrt(max(float(c @ g), 0.0))
        top = max([alpha, np.sqrt(max(before, 0.0)), *diagonal, *above])
        right = np.column_stack([right, v])
        if alpha <= 1e-14 * top * np.sqrt(width) or top == 0:
            alpha, c, g = 0.0, np.zeros(width), np.zeros(width)
        else:
            c, g = c / alpha, g / alpha
        left, back = np.column_stack([left, c]), np.column_stack([back, g])
        diagonal.append(alpha)
        r = g.copy()
        for _ in range(2):
            r -= right @ (right.T @ r)
        beta = float(np.linalg.norm(r))
        if beta <= 1e-14 * top * np.sqrt(width):
            beta, v = 0.0, fresh() if len(diagonal) < width else None
        else:
            v = r / beta
        above.append(beta)
        if width > ALL_STEPS and beta and len(diagonal) >= 2 * wanted and len(diagonal) % 4 == 0:
            p, s, _ = np.linalg.svd(_bidiagonal(diagonal, above))
            if (beta * np.abs(p[-1, :wanted]) <= 1e-15 * s[0]).all():
                break
    if not diagonal:
        return np.zeros((width, 0)), np.zeros(0)
    _, values, turned = np.linalg.svd(_bidiagonal(diagonal, above))
    return right @ turned.T, values


def _bidiagonal(diagonal: list[float], above: list[float]) -> np.ndarray:
    return np.diag(diagonal) + np.diag(above[: len(diagonal) - 1], 1)


def fit(vectors: DataFrame, components: int = COMPONENTS, seed: int = SEED) -> Whitening | None:
    """Whitening of the distinct vectors of ``x`` (arrays of long); None without any."""
    width, least, most, shortest = vectors.agg(
        F.max(F.size("x")), F.min(F.array_min("x")), F.max(F.array_max("x")), F.min(F.size("x"))
    ).first()
    if not width:
        return None
    if max(-least, most) > _LARGEST:
        raise ArithmeticError("entries too large: sums may not fit a long")
    x = F.col("x")
    if shortest != width:
        x = F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(x)))
    rows = _Rows(vectors.select(x.alias("x")).distinct(), width)
    sums = rows.total(width + 1, lambda b: np.append(b.sum(0), len(b)), "long")
    count, sums = int(sums[-1]), sums[:-1]
    mean = sums / count

    def step(c):
        def part(block):
            centred = block - mean
            u = centred @ c
            return np.append(centred.T @ u, u @ u)

        return rows.total(width + 1, part)

    vectors_, singular = bidiagonalise(step, width, components, seed)
    values = singular**2 / count
    trace = rows.total(1, lambda b: np.array([((b - mean) ** 2).sum()]))[0] / count
    keep = int((values[:components] > _FLAT * max(values[0], 0.0)).sum()) if trace > 0 else 0
    model = Whitening(count, sums, vectors_[:, :keep], values[:keep], float(trace), 0.0)
    if not keep:
        return model
    centre = rows.total(keep, lambda b: model.project(b).sum(0)) / count

    def products(block):
        w = model.project(block) - centre
        return (w.T @ w).ravel()

    spread = rows.total(keep * keep, products).reshape(keep, keep) / count
    return model._replace(identity_error=float(np.abs(spread - np.eye(keep)).max()))


def deviations(x: np.ndarray, count: int, sums: np.ndarray) -> list[int]:
    """Exact sums of (count * x - sum)^2 over the dimensions."""
    bound = count * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0))
    if bound < 1 << 62 and max(x.shape[1], 1) * bound * bound < 1 << 63:
        return ((count * x - sums) ** 2).sum(1).tolist()
    return ((x.astype(object) * count - sums.astype(object)) ** 2).sum(1).tolist()


def whiten(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """A row per (id, x) of ``rows`` and component.

    ``deviation`` is null where a long cannot hold it; ``deviation_exact`` is there always.
    """
    schema = (
        "vec_id long, component int, n long, deviation long, deviation_exact decimal(38,0),"
        " whitened double, explained double, identity_error double"
    )
    kept = 0 if model is None else len(model.values)
    if not kept:
        return rows.sparkSession.createDataFrame([], schema)
    width = len(model.sums)
    explained = model.values / model.trace

    def run(batch):
        x = matrix_of(batch.column(1), width)
        count = len(x)
        far = deviations(x, model.count, model.sums)
        each = np.repeat(np.arange(count), kept)
        place = pa.array(each)
        exact = pa.array([Decimal(d) for d in far], pa.decimal128(38, 0))
        held = pa.array([d if d < 1 << 63 else None for d in far], pa.int64())
        return batch_of(
            vec_id=batch.column(0).take(place),
            component=np.tile(np.arange(1, kept + 1, dtype=np.int32), count),
            n=np.full(count * kept, model.count, np.int64),
            deviation=held.take(place),
            deviation_exact=exact.take(place),
            whitened=model.project(x).ravel(),
            explained=np.tile(explained, count),
            identity_error=np.full(count * kept, model.identity_error),
        )

    return map_arrow(rows.select(F.col("id").cast("long"), "x"), run, schema)


def from_embeddings(table: DataFrame) -> DataFrame:
    """The rows (id, x) with whole vectors, scaled to integers."""
    return table.filter(finite(F.col("embedding"))).select(
        F.col("vec_id").alias("id"), whole_numbers(F.col("embedding")).alias("x")
    )


def whitened(table: DataFrame) -> DataFrame:
    rows = from_embeddings(table)
    return whiten(rows, fit(rows))
