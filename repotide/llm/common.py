"""What the operators share: the table, held-out rows, texts as byte arrays.

Tasks that work on texts take Arrow batches and look at the UTF-8 bytes of
many texts at once as one numpy array, in pieces of a bounded size (one text
is never cut, so the longest text bounds the memory).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import ctypes
import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.session import configure, scratch_path

#: Arrow batches live outside of the heap on one side and in the worker on the other.
ROWS_PER_BATCH, BYTES_PER_BATCH = "500", "8m"
PIECE_BYTES = 1 << 20
#: Bytes between words: space, tab to carriage return.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD = r"[^\x20\x09-\x0D]+"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_CODES = np.random.default_rng(20240517).integers(1, 1 << 62, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give every executor this package's modules, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / "repotide_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings: the library's own, and Arrow batches of bounded size."""
    configure(spark)
    # texts take little more room in memory than in their files
    spark.conf.set("spark.sql.sources.fileCompressionFactor", "1.0")
    ship_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_PER_BATCH)
    # steps end in written tables, so what they shuffled need not wait for a collection of garbage
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and that no plan will read any more."""
    for table in tables:
        session = table.sparkSession
        place = session._jvm.org.apache.hadoop.fs.Path(table.scratch)
        place.getFileSystem(session._jsc.hadoopConfiguration()).delete(place, True)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows no model learns from; a row without an id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def drawn(doc_id: str, seed: int) -> Column:
    """A seeded number in [0, 1) that depends on the row's id alone."""
    return F.pmod(F.xxhash64(F.col(doc_id), F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)


class Texts(NamedTuple):
    """Some texts of a batch: their bytes end to end, and where each begins."""

    first: int
    data: np.ndarray
    starts: np.ndarray

    @property
    def count(self) -> int:
        return len(self.starts) - 1


def texts_of(column: pa.Array, piece: int = PIECE_BYTES) -> Iterator[Texts]:
    """The column's texts in pieces of about ``piece`` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)
    bounds = bounds[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(bounds, bounds[at] + piece, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        yield Texts(at, data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at])
        at = to


def tidy(each: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``each``, giving memory it has freed back to the machine at the task's end.

    Workers wait for later tasks, also of other stages, beside the executor's own memory.
    """

    def run(batches):
        try:
            yield from each(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
            if trim is not None:
                trim(0)

    return run


def map_arrow(df: DataFrame, run: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str):
    """``run`` over each Arrow batch of ``df``."""

    def each(batches):
        for batch in batches:
            yield run(batch)

    return df.mapInArrow(tidy(each), schema)


def batch_of(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()],
        names=list(columns),
    )


def flat(parts: Sequence[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def binaries(rows: Sequence[bytes]) -> pa.Array:
    return pa.array(list(rows), pa.binary())


# --- hashes ----------------------------------------------------------------

def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A fixed bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, factor in enumerate((_BASE, inverse)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            with np.errstate(over="ignore"):
                _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


class Spans:
    """64-bit hashes of any ranges of ``data`` (bytes, or code points), by prefix
    sums modulo 2^64."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        codes = _CODES[data] if data.dtype == np.uint8 else mix(data, 1)
        with np.errstate(over="ignore"):
            np.cumsum(codes * up[:-1], out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            inside = (self.sums[end] - self.sums[start]) * self.down[start]
            return mix(inside + (end - start).astype(np.uint64))


def ranges(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    return edges[::2], edges[1::2]


def words_in(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word; a word never spans two texts."""
    inside = ~_IS_SPACE[texts.data]
    opens = np.zeros(len(inside) + 1, bool)
    opens[texts.starts] = True
    before = np.concatenate(([False], inside[:-1])) if len(inside) else inside
    start = np.flatnonzero(inside & (~before | opens[:-1]))
    after = np.concatenate((inside[1:], [False])) if len(inside) else inside
    end = np.flatnonzero(inside & (~after | opens[1:])) + 1
    return start, end, np.searchsorted(texts.starts, start, side="right") - 1


def windows(word_hash: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of every run of ``width`` words of one text."""
    n = len(word_hash) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(owner[:n] == owner[width - 1 :])
    with np.errstate(over="ignore"):
        total = np.zeros(len(at), np.uint64)
        for k in range(width):
            total = total * _BASE + word_hash[at + k]
    return at, mix(total, width)


def find_all(haystack: bytes, needle: bytes) -> Iterator[int]:
    at = haystack.find(needle)
    while at >= 0:
        yield at
        at = haystack.find(needle, at + 1)


# --- training rows ----------------------------------------------------------

def labelled_rows(
    docs: DataFrame, marks: DataFrame, label: str, per_class: int, max_chars: int, seed: int
) -> DataFrame:
    """At most ``per_class`` rows of each label 0 and 1 as (doc_id, text, label).

    Drawn by a seeded hash of the id, held-out rows and texts of over
    ``max_chars`` characters left out. Only the bounded list of drawn ids is broadcast
    to the documents. A document with several labels counts as its largest, an id with
    several texts gives the smallest.
    """
    one = (
        marks.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .filter(~held_out())
    )
    picked = None
    for value in (0, 1):
        some = (
            one.filter(F.col("label") == value)
            .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id")
            .limit(per_class)
        )
        picked = some if picked is None else picked.unionByName(some)
    return (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .filter(F.length("text") <= max_chars)
        .join(F.broadcast(picked), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.max("label").alias("label"))
    )


def labelled_sample(
    docs: DataFrame, marks: DataFrame, label: str, per_class: int, max_chars: int, seed: int
) -> list[tuple[int, str, int]]:
    """``labelled_rows`` on the driver, at most 2 x ``per_class`` texts, by rising id."""
    rows = labelled_rows(docs, marks, label, per_class, max_chars, seed).collect()
    return sorted((r["doc_id"], r["text"], r["label"]) for r in rows)
