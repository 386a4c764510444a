"""Document fingerprints: a homomorphic multiset hash, in DataFrame functions only.

A text is taken as the multiset of its paragraphs: lines, long ones cut after
each sentence end or bar that a space follows. A paragraph's 120
hash bits are its wide vector; a fingerprint adds the vectors up, lane by lane
modulo 2^20, three lanes to a number and the numbers modulo 2^60, next to the
count of paragraphs. So order does not matter, equal texts have equal
fingerprints, and paragraphs can be added to or taken from a fingerprint
without reading the rest of the text (``combine``).

Read as signs, each lane sums to a random projection of the paragraph counts;
the cosine of two fingerprints' projections, cut at 0, estimates how much two
texts share.

Null counts as the empty text, which is one empty paragraph. Rows with equal
ids are put in the order of their texts; rows without an id come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LANE_BITS, _PACKED = 20, 3
_MASK = sum(1 << (_LANE_BITS * k) for k in range(_PACKED))
_MODULUS = (1 << (_LANE_BITS * _PACKED)) - 1
_ROWS_PER_CHUNK, _MOST_CHUNKS, _FAN = 512, 4096, 64


def paragraphs(text: Column) -> Column:
    for mark in (".", "!", "?", "|"):
        text = F.replace(text, F.lit(f"{mark} "), F.lit(f"{mark}\n"))
    return F.split(text, "\n", -1)


def paragraph_hashes(text: Column) -> Column:
    """Two 60-bit numbers per paragraph, as one list each."""
    digests = F.transform(paragraphs(text), lambda p: F.md5(p.cast("binary")))

    def numbers(at: int) -> Column:
        return F.transform(
            digests, lambda d: F.conv(F.substring(d, at, 15), 16, 10).cast("long")
        )

    return F.array(numbers(1), numbers(16))


def summed(halves: Column) -> Column:
    """The packed lane sums of two lists of paragraph hashes, then their count."""

    def lane(hashes: Column, j: int) -> Column:
        return F.aggregate(
            hashes,
            F.lit(0).cast("long"),
            lambda acc, h: (acc + F.shiftright(h, j).bitwiseAND(F.lit(_MASK))).bitwiseAND(
                F.lit(_MODULUS)
            ),
        )

    sums = [lane(halves[half], j) for half in (0, 1) for j in range(_LANE_BITS)]
    return F.array(*sums, F.size(halves[0]).cast("long"))


def combine(left: Column, right: Column, sign: int = 1) -> Column:
    """Insert (1) or delete (-1) the paragraphs of one fingerprint from another.

    Lanes are added apart, so no lane borrows from its neighbour.
    """

    def lanes(x: Column, y: Column) -> Column:
        out = F.lit(0).cast("long")
        for k in range(_PACKED):
            low = F.lit((1 << _LANE_BITS) - 1).cast("long")
            a = F.shiftright(x, _LANE_BITS * k).bitwiseAND(low)
            b = F.shiftright(y, _LANE_BITS * k).bitwiseAND(low)
            total = F.pmod(a + b * sign, F.lit(1 << _LANE_BITS)).cast("long")
            out = out.bitwiseOR(F.shiftleft(total, _LANE_BITS * k))
        return out

    count = 2 * _LANE_BITS
    merged = F.zip_with(F.slice(left, 1, count), F.slice(right, 1, count), lanes)
    return F.concat(merged, F.array(left[count] + right[count] * sign))


def projection(sums: Column) -> Column:
    """The lanes as signed sums: set bits less clear bits."""
    count = 2 * _LANE_BITS
    low = F.lit((1 << _LANE_BITS) - 1).cast("long")
    lanes = F.flatten(
        F.transform(
            F.slice(sums, 1, count),
            lambda s: F.array(
                *[F.shiftright(s, _LANE_BITS * k).bitwiseAND(low) for k in range(_PACKED)]
            ),
        )
    )
    return F.transform(lanes, lambda c: c * 2 - sums[count])


def likeness(a: Column, b: Column) -> Column:
    """Cosine of two projections, from 0 to 1."""

    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p * q)
        return F.aggregate(products, F.lit(0).cast("long"), lambda acc, p: acc + p)

    size = F.sqrt(dot(a, a).cast("double")) * F.sqrt(dot(b, b).cast("double"))
    near = F.when(size > 0, dot(a, b).cast("double") / size).otherwise(0.0)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), near)), 6)


def shown(sums: Column) -> Column:
    return F.array_join(F.transform(sums, lambda s: F.hex(s)), ".")


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` (doc_id, text and more) with the ``columns`` of the following row by
    id as ``next_<column>``; the first row follows the last.

    Ids are cut into chunks at approximate quantiles, which are ids of rows
    themselves: such a row opens its chunk and is also sent to the end of the
    chunk before. Chunks need no order among them, and no row count of one
    depends on how the ids are spread.
    """
    ids = rows.select("doc_id")
    total, known, first = ids.agg(
        F.count(F.lit(1)), F.count("doc_id"), F.min("doc_id")
    ).first()
    chunks = min(max(1, total // _ROWS_PER_CHUNK), _MOST_CHUNKS)
    bounds: list[int] = []
    if chunks > 1 and known:
        shares = [k / chunks for k in range(1, chunks)]
        bounds = sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 50_000)).first()[0]))
    if known < total:
        first = None
    if not bounds:
        chunk, opens, last = F.lit(0), F.lit(False), 0
    else:
        groups = [bounds[k : k + _FAN] for k in range(0, len(bounds), _FAN)]
        array = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
        below = lambda xs: F.size(F.filter(xs, lambda b: b <= F.col("doc_id")))
        outer = array([g[0] for g in groups[1:]]) if len(groups) > 1 else array([])
        outer = outer.cast("array<long>")
        group = below(outer)
        own = F.element_at(F.array(*[array(g) for g in groups]), group + 1)
        known_id = F.col("doc_id").isNotNull()
        chunk = F.when(known_id, group * _FAN + below(own)).otherwise(0)
        opens = F.coalesce(F.array_contains(own, F.col("doc_id")), F.lit(False))
        last = len(bounds)
    place = lambda at, tail, end: F.struct(
        at.cast("int").alias("chunk"), F.lit(tail).alias("tail"), F.lit(end).alias("end")
    )
    nothing = F.lit(None)
    places = F.array_compact(
        F.array(
            place(chunk, False, 0),
            F.when(opens, place(chunk - 1, True, 0)).otherwise(nothing),
            F.when(
                F.col("doc_id").eqNullSafe(F.lit(first)), place(F.lit(last), True, 1)
            ).otherwise(nothing),
        )
    )
    order = Window.partitionBy("chunk").orderBy("end", "doc_id", "text")
    return (
        rows.select(*rows.columns, F.inline(places))
        .select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
        .filter(~F.col("tail"))
        .drop("chunk", "tail", "end")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its text edited by the next one, and how near
    both and the next text are."""
    hashed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("own", paragraph_hashes(F.col("text")))
    rows = with_next(hashed.withColumn("own", summed(F.col("own"))), ["text", "own"])
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - half),
        F.substring("next_text", F.lit(1), half),
    )
    edits = rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "own",
        F.col("next_own").alias("next"), edited.alias("edited"),
    ).select(
        "doc_id", "n_chars", "own", "next",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        paragraph_hashes(F.col("edited")).alias("edit"),
    )
    sums = edits.withColumn("edit", summed(F.col("edit")))
    signed = sums.select(
        "*", *[projection(F.col(c)).alias(f"{c}_signs") for c in ("own", "edit", "next")]
    )
    return signed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        shown(F.col("own")).alias("fingerprint"),
        shown(F.col("edit")).alias("edited_fingerprint"),
        likeness(F.col("own_signs"), F.col("edit_signs")).alias("near_edited"),
        likeness(F.col("own_signs"), F.col("next_signs")).alias("near_next"),
    )
