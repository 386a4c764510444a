"""N-gram Jaccard join: texts whose sets of five-word runs overlap enough.

``A-Z`` is lower-cased, words are runs of anything but white space, and a text
counts as the set of its distinct five-word runs (with fewer words: the whole
sequence as one). Two texts link when 100 x intersection >= 75 x union; the
result is every document's component. No link is missed:

* Texts with equal sets are one node, known by a 64-bit sum over the set.
* A link needs common runs among the first 30 % of both sets in any one order
  of all runs, and one in 20 of a set's runs at that. The order is by hash,
  with runs that a small sample shows to be frequent put last; the sample
  changes the work, never the result. Nodes whose prefix shares fewer runs
  with any others drop out.
* First, nodes that share one of their first runs are checked against one
  leader per run, and checked again by component, so large groups of near
  copies shrink to few components without comparing all their pairs.
* What is left are runs that more than one component shares. Nodes of a run
  with few nodes meet at once, each pair once over all such runs. Nodes of other
  runs meet in tiles by size band (a link needs sizes within 3:4), large tiles in
  blocks. Nodes of one component need no comparison. Parity bitmaps, four bits per
  run, bound the overlap from above: every bit that differs needs a run that only
  one side has. A pair is left to the tile of its first common run: where too
  little of either set comes after a run, it is passed over. A tile with many
  possible pairs gives each node's nearest one first and meets again once these
  have joined components. Only pairs the bound leaves are checked exactly, by
  intersecting their sorted sets.

Empty and null texts have no runs and link with nothing. Rows without an id
get their count and no component. Rows that share an id count as one document
with all their texts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import (
    LOWER,
    Spans,
    Texts,
    batch_of,
    binaries,
    drawn,
    flat,
    map_arrow,
    mix,
    release,
    stored,
    texts_of,
    tidy,
    windows,
    words_in,
)

RUN, PERCENT, SEED = 5, 75, 71
#: One more run in common is asked for with every so many runs of a set.
SPARE = 20
_SAMPLE, _FREQUENT, _MOST_FREQUENT = 3000, 3, 50_000
_FIRST, _FEW, _BLOCK = 3, 16, 600
#: Pairs per node above which a tile first gives each node's nearest one only.
_PAIRS_PER_NODE = 4
_ROWS_PER_TASK = 1 << 20
_ROWS_HELD = 1 << 18
_BROADCAST_ROWS = 1 << 20
_TOP = np.uint64(1 << 63)
_BYTE_BITS = np.array([bin(x).count("1") for x in range(256)], np.uint8)


# --- sets -------------------------------------------------------------------

def run_sets(texts: Texts, frequent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct runs of each text in the common order, and where each set begins."""
    low = Texts(texts.first, LOWER[texts.data], texts.starts)
    start, end, owner = words_in(low)
    hashes = Spans(low.data).hashes(start, end)
    place, runs = windows(hashes, owner, RUN)
    owners = owner[place]
    count = np.bincount(owner, minlength=texts.count)
    short = np.flatnonzero((count > 0) & (count < RUN))
    if len(short):
        first = np.searchsorted(owner, short)
        whole = np.zeros(len(short), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(RUN - 1):
                more = count[short] > k
                at = np.minimum(first + k, len(hashes) - 1)
                whole = np.where(more, whole * np.uint64(0x9E3779B97F4A7C15) + hashes[at], whole)
        runs = np.concatenate((runs, mix(whole, 100) ^ count[short].astype(np.uint64)))
        owners = np.concatenate((owners, short))
    runs = runs >> np.uint64(1)
    if frequent is not None and len(frequent):
        near = np.zeros(1 << 16, bool)
        near[(frequent & np.uint64(0xFFFF)).astype(np.int64)] = True
        maybe = np.flatnonzero(near[(runs & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(frequent, runs[maybe]), len(frequent) - 1)
        runs[maybe[frequent[at] == runs[maybe]]] |= _TOP
    order = np.lexsort((runs, owners))
    runs, owners = runs[order], owners[order]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:] != runs[:-1]) | (owners[1:] != owners[:-1])
    runs, owners = runs[new], owners[new]
    return runs, np.searchsorted(owners, np.arange(texts.count + 1))


def prefix_length(size: int, percent: int = PERCENT) -> int:
    """Runs of a set among which a link has ``1 + size // SPARE`` runs in common."""
    return size - -(-percent * size // 100) + 1 + size // SPARE


def can_be_first(place: Column, size: Column) -> Column:
    """Whether enough of a set comes after a place for its run to be a link's first common one.

    The intersection lies behind it, and the other set has 75 % of this one's size at least.
    """
    return (100 + PERCENT) * (size - place) >= PERCENT * (size + F.ceil(size * PERCENT / 100))


def least_common(size: Column) -> Column:
    """Runs that a node's prefix has in common with that of any node it links to.

    If two sets link, the first ``l`` runs of their intersection lie in both
    prefixes, ``l`` being the smaller of their promised numbers, and the other
    set has at least 75 % of this one's size.
    """
    return 1 + F.floor(F.ceil(size * PERCENT / 100) / SPARE)


def bitmap(runs: np.ndarray) -> bytes:
    """Parity bits, at least four per run, a power of two of them."""
    bits = 64
    while bits < 4 * len(runs):
        bits *= 2
    at = (mix(runs & ~_TOP, 5) & np.uint64(bits - 1)).astype(np.int64)
    odd = np.bincount(at, minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").tobytes()


def overlap_possible(a: bytes, size_a: int, b: bytes, size_b: int) -> bool:
    """False only if sizes or bit counts rule the pair out.

    The longer bitmap is folded onto the shorter one; parity survives that.
    """
    if min(size_a, size_b) * 100 < PERCENT * max(size_a, size_b):
        return False
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) > len(y):
        x, y = y, x
    if len(y) > len(x):
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return _possible(int(_BYTE_BITS[x ^ y].sum()), size_a + size_b)


def _possible(differing, sizes):
    # with d differing bits the intersection is at most (sizes - d) / 2
    return (100 + PERCENT) * (sizes - differing) >= 2 * PERCENT * sizes


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact test on two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both) and both > 0


# --- profiles ---------------------------------------------------------------

def frequent_runs(docs: DataFrame, total: int) -> np.ndarray:
    """Runs that several documents of a small seeded sample share, at most
    ``_MOST_FREQUENT``; only the order of runs depends on them."""
    share = min(1.0, _SAMPLE / max(total, 1))

    def run(batch):
        sets = [run_sets(t)[0] for t in texts_of(batch.column(0))]
        return batch_of(run=pa.array(np.concatenate(sets).view(np.int64), pa.int64()))

    sample = docs.filter(drawn("doc_id", SEED) < share).select("text").distinct()
    rows = (
        map_arrow(sample, run, "run long")
        .groupBy("run")
        .count()
        .filter(F.col("count") >= _FREQUENT)
        .orderBy(F.desc("count"), "run")
        .limit(_MOST_FREQUENT)
        .collect()
    )
    return np.sort(np.array([r["run"] for r in rows], np.int64).view(np.uint64))


def profiles(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """doc_id, n_shingles, node, bits, first: one row per document.

    ``bits`` and ``first`` are given once per node and task, by a row with an id,
    so exact copies end before anything is shuffled.
    """

    def each(batches):
        seen: set[int] = set()
        for batch in batches:
            yield run(batch, seen)

    def run(batch, seen):
        ids = batch.column(0)
        named = ids.is_valid().to_pylist()
        sizes, nodes, bits, first = [], [], [], []
        for texts in texts_of(batch.column(1)):
            runs, starts = run_sets(texts, frequent)
            plain = runs & ~_TOP
            with np.errstate(over="ignore"):
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(plain, 11))))
                node = mix(sums[starts[1:]] - sums[starts[:-1]], 13)
            nodes.append(node.view(np.int64))
            sizes.append(np.diff(starts))
            for at, key in enumerate(nodes[-1].tolist()):
                s, e = int(starts[at]), int(starts[at + 1])
                new = e > s and named[texts.first + at] and key not in seen
                if new:
                    seen.add(key)
                bits.append(bitmap(runs[s:e]) if new else None)
                first.append(runs[s:e][: prefix_length(e - s)].view(np.int64) if new else None)
        return batch_of(
            doc_id=ids,
            n_shingles=np.concatenate(sizes),
            node=np.concatenate(nodes),
            bits=binaries(bits),
            first=pa.array(first, pa.list_(pa.int64())),
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        tidy(each), "doc_id long, n_shingles long, node long, bits binary, first array<long>"
    )


# --- links ------------------------------------------------------------------

class _Join:
    """One run of the join: the stored profiles and the texts behind them."""

    def __init__(self, docs: DataFrame) -> None:
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        found = stored(profiles(docs, frequent_runs(docs, docs.count())), "profiles")
        known = found.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        # equal sets have equal bits and first runs, so any row's will do
        self.nodes = stored(
            known.groupBy("node").agg(
                F.min("doc_id").alias("doc_id"),
                F.max("n_shingles").alias("size"),
                F.first("bits", ignorenulls=True).alias("bits"),
                F.first("first", ignorenulls=True).alias("first"),
            ),
            "nodes",
        )
        self.all = stored(found.select("doc_id", "n_shingles", "node"), "documents")
        release(found)
        self.reps = self.nodes.select("node", "doc_id", "size")
        self.sketches = self.nodes.select("node", "size", "bits")
        self.comps: DataFrame | None = None

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that sizes and bit counts leave."""
        s = self.sketches
        left = s.select(F.col("node").alias("a"), F.col("size").alias("n"), F.col("bits").alias("x"))
        right = s.select(F.col("node").alias("b"), F.col("size").alias("m"), F.col("bits").alias("y"))

        def run(batch):
            a, b, n, x, m, y = (batch.column(i).to_pylist() for i in range(6))
            keep = [overlap_possible(x[i], n[i], y[i], m[i]) for i in range(len(a))]
            return batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

        both = pairs.join(left, "a").join(right, "b").select("a", "b", "n", "x", "m", "y")
        return map_arrow(both.filter("n * 100 >= m * 75 AND m * 100 >= n * 75"), run, "a long, b long")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Stored pairs (a, b) whose sets are linked. Texts move only if a pair needs them."""
        pairs = stored(pairs, "pairs")
        wanted = needed = stored(
            pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            .join(self.reps.select("node", "doc_id"), "node"),
            "needed",
        )
        if needed.count() <= _BROADCAST_ROWS:
            needed = F.broadcast(needed)
        texts = self.docs.filter("doc_id IS NOT NULL").join(needed, "doc_id").select("node", "text")
        left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")

        def each(batches):
            last, held = None, None
            for batch in batches:
                a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                keep = np.zeros(len(a), bool)
                at = 0
                for texts in texts_of(batch.column(3)):
                    runs, starts = run_sets(texts)
                    for k in range(texts.count):
                        if a[at] != last:
                            whole = next(texts_of(batch.column(2).slice(at, 1)))
                            last, held = a[at], run_sets(whole)[0]
                        keep[at] = linked(held, runs[starts[k] : starts[k + 1]])
                        at += 1
                yield batch.filter(pa.array(keep)).select([0, 1])

        found = stored(both.mapInArrow(tidy(each), "a long, b long"), "links")
        release(pairs, wanted)
        return found

    def add(self, pairs: DataFrame) -> DataFrame:
        """Check pairs, keep the links, and return (node, comp) of all linked nodes.

        What earlier links say is in their components: a node and its smallest one.
        """
        found = self.verified(self.bounded(pairs.distinct()))
        links = found
        if self.comps is not None:
            known = self.comps.select(F.col("node").alias("a"), F.col("comp").alias("b"))
            links = found.unionByName(known)
        earlier, self.comps = self.comps, components(links)
        release(found, *([earlier] if earlier is not None else []))
        return self.comps

    # a leader per run, chosen by a hash that differs from run to run: copies
    # with many edits are close to some leaders only
    def stars(self, keys: DataFrame, comps: DataFrame | None) -> DataFrame:
        held = _with_comp(keys, comps)
        each = held.groupBy("run", "comp").agg(F.min("node").alias("node"))
        lead = (
            each.groupBy("run")
            .agg(
                F.min(F.struct(F.xxhash64("comp", F.col("run") % 4), "comp", "node")).alias("lead"),
                F.count(F.lit(1)).alias("n"),
            )
            .filter("n > 1")
            .select("run", F.col("lead.comp").alias("_comp"), F.col("lead.node").alias("a"))
        )
        return each.join(lead, "run").filter("comp <> _comp").select("a", F.col("node").alias("b"))


def _enough(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """The rows (run, node, ...) of nodes that have enough of them for a link."""
    often = (
        rows.groupBy("node").agg(F.count(F.lit(1)).alias("_n"))
        .join(reps.select("node", "size"), "node")
        .filter(F.col("_n") >= least_common(F.col("size")))
        .select("node")
    )
    return rows.join(often, "node")


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows (run, node, comp) of runs that more than one component has."""
    runs = (
        rows.groupBy("run").agg(F.min("comp").alias("_low"), F.max("comp").alias("_high"))
        .filter("_low <> _high").select("run")
    )
    return rows.join(runs, "run")


def _with_comp(keys: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return keys.withColumn("comp", F.col("node"))
    return keys.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _distinct(batches) -> list[np.ndarray]:
    """Runs, nodes and places of all batches, sorted, each run and node once.

    Repeats go whenever the rows held have doubled, so memory follows the
    distinct rows.
    """
    held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
    parts, rows = [], 0

    def once():
        runs, nodes, places = (np.concatenate([h, *p]) for h, p in zip(held, zip(*parts)))
        order = np.lexsort((nodes, runs))
        runs, nodes, places = runs[order], nodes[order], places[order]
        new = np.ones(len(runs), bool)
        new[1:] = (runs[1:] != runs[:-1]) | (nodes[1:] != nodes[:-1])
        return [runs[new], nodes[new], places[new]]

    for batch in batches:
        parts.append([batch.column(k).to_numpy() for k in range(3)])
        rows += batch.num_rows
        if rows > max(len(held[0]), _ROWS_HELD):
            held, parts, rows = once(), [], 0
    return once() if parts else held


def _dealt(nodes: DataFrame, buckets: int) -> DataFrame:
    """(bucket, rows): the rare first runs with their nodes and places, dealt out by run.

    Millions of rows of three numbers cost most of their time between Spark and
    Python, so the rows of a bucket travel packed.
    """

    def each(batches):
        held, rows = [], 0
        for batch in batches:
            lists = batch.column(1)
            sizes = np.diff(np.asarray(lists.offsets))
            runs = lists.flatten().to_numpy(zero_copy_only=False)
            place = np.arange(len(runs)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            rare = runs >= 0  # frequent runs have the top bit
            owner = np.repeat(batch.column(0).to_numpy(), sizes)
            held.append((runs[rare], owner[rare], place[rare].astype(np.int32)))
            rows += len(held[-1][0])
            if rows > _ROWS_HELD:
                yield packed(held)
                held, rows = [], 0
        if held:
            yield packed(held)

    def packed(held):
        runs, nodes, places = (np.concatenate(p) for p in zip(*held))
        bucket = (mix(runs, 17) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        runs, nodes, places, bucket = runs[order], nodes[order], places[order], bucket[order]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
        if not len(bucket):
            cuts = cuts[:1]
        parts = [slice(a, b) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        return batch_of(
            bucket=bucket[cuts[:-1]],
            rows=binaries([runs[p].tobytes() + nodes[p].tobytes() + places[p].tobytes() for p in parts]),
        )

    return nodes.select("node", "first").mapInArrow(tidy(each), "bucket long, rows binary")


def _unpacked(batches):
    for batch in batches:
        for raw in batch.column(1):
            raw = raw.as_buffer()
            n = raw.size // 20
            yield batch_of(
                run=np.frombuffer(raw, np.int64, n), node=np.frombuffer(raw, np.int64, n, 8 * n),
                place=np.frombuffer(raw, np.int32, n, 16 * n),
            )


def _shared(nodes: DataFrame, total: int) -> DataFrame:
    """(run, node, place) of the runs that more than one node has.

    Frequent runs are shared by definition and pass; the others are dealt out
    by run and looked through in tasks of about a million rows.
    """
    buckets = max(1, math.ceil(total / _ROWS_PER_TASK))

    def each(batches):
        runs, nodes, places = _distinct(_unpacked(batches))
        if not len(runs):
            return
        same = runs[1:] == runs[:-1]
        several = np.zeros(len(runs), bool)
        several[1:] |= same
        several[:-1] |= same
        yield batch_of(run=runs[several], node=nodes[several], place=places[several])

    rare = _dealt(nodes, buckets).repartition(buckets, "bucket")
    often = nodes.select("node", F.posexplode("first").alias("place", "run")).filter("run < 0")
    return rare.mapInArrow(tidy(each), "run long, node long, place int").unionByName(
        often.select("run", "node", "place")
    )


def _few(rows: DataFrame) -> DataFrame:
    """Pairs of nodes (run, node, comp, size) of runs with at most ``_FEW`` of them,
    each once.

    Rows lie sorted by run, so each is compared with the ones right after it.
    """
    ordered = rows.select("run", "node", "comp", "size").repartition("run")
    ordered = ordered.sortWithinPartitions("run", "node")

    def each(batches):
        held = np.zeros((4, 0), np.int64)
        for batch in batches:
            own = np.stack([batch.column(k).to_numpy() for k in range(4)])
            table = np.concatenate((held, own), axis=1)
            last = np.searchsorted(table[0], table[0, -1]) if table.shape[1] else 0
            held = table[:, last:]
            yield met(table[:, :last])
        yield met(held)

    def met(table):
        run, node, comp, size = table
        left, right = [], []
        for far in range(1, _FEW):
            low, high = np.minimum(size[:-far], size[far:]), np.maximum(size[:-far], size[far:])
            both = (run[:-far] == run[far:]) & (comp[:-far] != comp[far:])
            both &= 100 * low >= PERCENT * high
            left.append(node[:-far][both])
            right.append(node[far:][both])
        a, b = np.concatenate(left), np.concatenate(right)
        return batch_of(a=np.minimum(a, b), b=np.maximum(a, b))

    return ordered.mapInArrow(tidy(each), "a long, b long").distinct()


def _tiles(rows: DataFrame, sketches: DataFrame, nearest: bool) -> DataFrame:
    """Candidate pairs (a, b) of (run, node, place, comp, size), by run and size band.

    With ``nearest``, a tile with more than ``_PAIRS_PER_NODE`` pairs per node gives one pair
    per node, the one of fewest differing bits, and its ``run`` in a row without a pair; else
    all that the bound leaves.

    A band's tile holds its own nodes and those of the next band. Tiles of more
    than ``_BLOCK`` nodes are split into blocks, and blocks meet in pairs. Bitmaps are
    wide and join last.
    """
    band = F.floor(F.log(F.col("size").cast("double")) / math.log(100 / PERCENT)).cast("int")
    dealt = rows.withColumn("_band", band).select(
        "*", F.explode(F.array(F.col("_band"), F.col("_band") - 1)).alias("band")
    ).withColumn("home", F.col("band") == F.col("_band")).drop("_band")
    # bands are cut in floating point: the next band but one is never within 3:4
    counts = (
        dealt.groupBy("run", "band")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("comp").alias("_low"),
            F.max("comp").alias("_high"),
            F.max("home").alias("_any"),
        )
        .filter("_any AND _low <> _high")
        .withColumn("_blocks", F.ceil(F.col("_n") / _BLOCK).cast("int"))
        .select("run", "band", "_blocks")
    )
    placed = dealt.join(counts, ["run", "band"]).withColumn(
        "own", F.pmod(F.hash("node"), F.col("_blocks"))
    )
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    tiled = placed.select("*", other.alias("_other")).select(
        "run", "band", F.least("own", "_other").alias("i"), F.greatest("own", "_other").alias("j"),
        "own", "home", "node", "place", "comp", "size",
    )
    keys = ["run", "band", "i", "j"]
    tiled = tiled.join(sketches.select("node", "bits"), "node")
    sorted_ = tiled.repartition(*keys).sortWithinPartitions(*keys)

    def each(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table]).combine_chunks()
            code = np.stack([table.column(k).to_numpy() for k in keys], 1)
            cuts = np.flatnonzero((code[1:] != code[:-1]).any(1)) + 1
            if not len(cuts):
                held = table
                continue
            held = table.slice(cuts[-1])
            yield compared(table.slice(0, cuts[-1]), np.concatenate(([0], cuts)))
        if held is not None:
            yield compared(held, np.array([0, held.num_rows]))

    def compared(table, cuts):
        node, comp, size = (table.column(k).to_numpy() for k in ("node", "comp", "size"))
        # runs from this one on, itself included: if it is a pair's first common
        # run, no more than that can be in the intersection
        rest = size - table.column("place").to_numpy()
        home, own = table.column("home").to_numpy(), table.column("own").to_numpy()
        i, j = table.column("i").to_numpy(), table.column("j").to_numpy()
        bits, run = table.column("bits").to_pylist(), table.column("run").to_numpy()
        left, right, open_ = [], [], []
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if e - s < 2:
                continue
            x, y = np.triu_indices(e - s, 1)
            x, y = x + s, y + s
            low, high = np.minimum(size[x], size[y]), np.maximum(size[x], size[y])
            may = (comp[x] != comp[y]) & (home[x] | home[y]) & (100 * low >= PERCENT * high)
            enough = (100 + PERCENT) * np.minimum(rest[x], rest[y])
            may &= enough >= PERCENT * (size[x] + size[y])
            if i[s] != j[s]:
                may &= own[x] != own[y]
            x, y = x[may], y[may]
            if len(x):
                good, far = _close(x, y, bits, size)
                if nearest and good.sum() > _PAIRS_PER_NODE * (e - s):
                    good = _nearest(x, y, far, good)
                    open_.append(run[s])
                left.append(np.minimum(node[x[good]], node[y[good]]))
                right.append(np.maximum(node[x[good]], node[y[good]]))
        a, b = flat(left, np.int64), flat(right, np.int64)
        none = pa.nulls(len(open_), pa.int64())
        runs = pa.array(np.array(open_, np.int64))
        return batch_of(
            a=pa.concat_arrays([pa.array(a), none]), b=pa.concat_arrays([pa.array(b), none]),
            run=pa.concat_arrays([pa.nulls(len(a), pa.int64()), runs]),
        )

    return sorted_.mapInArrow(tidy(each), "a long, b long, run long")


def _close(
    x: np.ndarray, y: np.ndarray, bits: list[bytes], size: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs the bit counts leave, and the counts; each bitmap is folded to the narrowest."""
    used = np.unique(np.concatenate((x, y)))
    width = min(len(bits[k]) for k in used)
    folded = np.stack(
        [np.bitwise_xor.reduce(np.frombuffer(bits[k], np.uint8).reshape(-1, width), 0) for k in used]
    )
    p, q = np.searchsorted(used, x), np.searchsorted(used, y)
    far = np.zeros(len(x), np.int64)
    step = max(1, (1 << 22) // width)
    for at in range(0, len(x), step):
        part = slice(at, at + step)
        far[part] = _BYTE_BITS[folded[p[part]] ^ folded[q[part]]].sum(1, dtype=np.int64)
    return _possible(far, size[x] + size[y]), far


def _nearest(x: np.ndarray, y: np.ndarray, far: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Of the good pairs, each side's nearest one."""
    places, out = np.flatnonzero(good), np.zeros(len(x), bool)
    for side in (x, y):
        order = places[np.lexsort((far[places], side[places]))]
        out[order[np.concatenate(([True], side[order[1:]] != side[order[:-1]]))[: len(order)]]] = True
    return out


# --- components -------------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every linked node: comp is its component's smallest node.

    Alternating large and small stars; every round is written to the shared
    folder, and a round that changes nothing ends it.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m"))
        .filter("v <> m").distinct(),
        "edges",
    )
    state = None
    while (now := _state(edges)) != state:
        state = now
        # narrow rows: few tasks, so that a small graph makes few small files
        tasks = max(8, now[0] // 500_000)
        both = edges.unionByName(edges.select(F.col("m").alias("v"), F.col("v").alias("m")))
        lows = both.groupBy("v").agg(F.min("m").alias("_low"))
        low = F.least("v", "_low")
        large = both.join(lows, "v").filter("m > v").select(F.col("m").alias("v"), low.alias("m"))
        large = large.coalesce(tasks)
        lows = large.groupBy("v").agg(F.min("m").alias("_low"))
        small = large.join(lows, "v").select(
            F.inline(
                F.array(
                    F.struct(F.col("v").alias("v"), F.col("_low").alias("m")),
                    F.struct(F.col("m").alias("v"), F.col("_low").alias("m")),
                )
            )
        )
        earlier = edges
        edges = stored(small.filter("v <> m").coalesce(tasks).distinct().coalesce(tasks), "edges")
        release(earlier)
    roots = edges.select(F.col("m").alias("v"), "m").distinct()
    found = stored(
        edges.unionByName(roots).groupBy(F.col("v").alias("node")).agg(F.min("m").alias("comp")),
        "components",
    )
    release(edges)
    return found


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "m")), F.bit_xor(F.xxhash64("m"))).first()
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    join = _Join(docs)
    leads = join.nodes.select("node", F.explode(F.slice("first", 1, _FIRST)).alias("run"))
    comps = join.add(join.stars(leads, None))

    total = join.nodes.agg(F.sum(F.size("first"))).first()[0] or 0
    shared = stored(_shared(join.nodes, total), "shared")
    enough = stored(_enough(shared, join.reps), "enough")
    release(shared)
    comps = join.add(join.stars(enough, comps))

    once = _enough(_mixed(_with_comp(enough, comps)), join.reps)
    mixed = _enough(_mixed(once), join.reps).join(join.reps.select("node", "size"), "node")
    mixed = stored(mixed.filter(can_be_first(F.col("place"), F.col("size"))), "mixed")
    release(enough)
    often = mixed.groupBy("run").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    few = mixed.join(often.filter(F.col("_n") <= _FEW).select("run"), "run")
    many = stored(mixed.join(often.filter(F.col("_n") > _FEW).select("run"), "run"), "many")
    # groups of distant copies shrink to the components that no pair joins before
    # all pairs of their tiles are listed
    held = stored(_tiles(_mixed(many), join.sketches, True), "tiles")
    pairs = held.filter("a IS NOT NULL").select("a", "b").unionByName(_few(few))
    comps = join.add(pairs)
    open_ = stored(held.select("run").filter("run IS NOT NULL").distinct(), "open")
    release(held, mixed)
    if open_.first() is not None:
        left = many.select("run", "node", "place", "size").join(open_, "run")
        now = _mixed(_with_comp(left, comps))
        comps = join.add(_tiles(now, join.sketches, False).select("a", "b"))
    release(many, open_)

    smallest = (
        _with_comp(join.reps.select("node", "doc_id"), comps)
        .withColumn("_low", F.col("doc_id"))
        .select("node", "comp", "_low")
    )
    lows = smallest.groupBy("comp").agg(F.min("_low").alias("_least"))
    named = smallest.join(lows, "comp").select("node", F.col("_least").alias("_component"))
    out = join.all.select("doc_id", "n_shingles", "node")
    lone = out.filter("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return (
        out.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .join(named, "node")
        .select("doc_id", "n_shingles", F.col("_component").alias("component_id"))
        .unionByName(lone)
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id.

    Rows without an id all stay; of rows with the same kept id one stays.
    """
    found = near_duplicates(docs.select("doc_id", "text"))
    kept = stored(
        found.filter("doc_id = component_id")
        .groupBy(F.col("doc_id").alias("kept"))
        .agg(F.count(F.lit(1)).alias("rows")),
        "kept",
    )
    if kept.count() <= _BROADCAST_ROWS:
        kept = F.broadcast(kept)
    # the rows travel as one column, so that none of their names can clash
    held = docs.filter("doc_id IS NOT NULL").select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("kept"),
    )
    known = held.join(kept, "kept")
    one = known.filter("rows = 1").unionByName(known.filter("rows > 1").dropDuplicates(["kept"]))
    return one.select("row.*").unionByName(docs.filter("doc_id IS NULL"))
