"""Toxicity by classifier chains: one linear model after another.

The labels hold one flag, so the categories are found: words and word
beginnings that stand out in toxic training rows are grouped into themes by
the rows they share, and a toxic row belongs to a theme if it holds enough of
its marks. The chain predicts theme after theme and then the flag itself. Each
link is a logistic regression over the marks a text holds, plus the
probabilities of the links before it; for training those are out-of-fold
predictions, so a link sees them as good as they will be on new rows.

Marks are hashed words (letters only, lower case) and their beginnings of
3 to 7 bytes. A bounded sample of labelled rows teaches the chain; rows with the
same flag and the same set of words and beginnings count once. Tasks hash the
texts and Spark counts how often each word stands in toxic and clean rows; the
driver gets the ``MOST_MARKS`` strongest and, for each row, which of them it
holds. Scoring reads every whole text in tasks. Null and empty texts hold no
marks. Without toxic rows nothing is toxic.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import (
    LOWER,
    Spans,
    Texts,
    batch_of,
    binaries,
    flat,
    labelled_rows,
    map_arrow,
    mix,
    ranges,
    release,
    stored,
    texts_of,
)
from repotide.llm.quality_convnet import filtered

PER_CLASS, MAX_CHARS, SEED = 4000, 20_000, 41
THEMES, FOLDS, MIN_ROWS, MIN_LIFT, MOST_MARKS = 4, 4, 4, 12.0, 2000
BEGINNINGS = (3, 4, 5, 6, 7)
THRESHOLD = 0.5
_PIECE = 1 << 19
#: Columns before the marks and the earlier links.
_FRONT = 3

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def marks_in(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and word beginnings, and the text each is from."""
    data = LOWER[texts.data]
    inside = _LETTER[data]
    # a zero-width cut at each text's start keeps words apart
    start, end = ranges(inside)
    cut = np.searchsorted(texts.starts, start, side="right")
    cross = end > texts.starts[np.minimum(cut, len(texts.starts) - 1)]
    if cross.any():
        inside = np.insert(inside, texts.starts[1:-1], False)
        start, end = ranges(inside)
        moved = texts.starts + np.arange(len(texts.starts)) - 1
        moved[0] = 0
        shift = np.searchsorted(moved[1:-1], start, side="left")
        start, end = start - shift, end - shift
    owner = np.searchsorted(texts.starts, start, side="right") - 1
    spans = Spans(data)
    hashes, owners = [spans.hashes(start, end)], [owner]
    for n in BEGINNINGS:
        long = end - start > n
        hashes.append(spans.hashes(start[long], start[long] + n) ^ np.uint64(n))
        owners.append(owner[long])
    return np.concatenate(hashes), np.concatenate(owners)


class Chain:
    """Marks, themes and the chain's weights; picklable and small."""

    def __init__(self, marks: np.ndarray, theme: np.ndarray, links: list[np.ndarray]) -> None:
        self.marks, self.theme, self.links = marks, theme, links
        # most words are no mark: a bit per hash end keeps them from the search
        self.near = np.zeros(1 << 16, bool)
        self.near[(marks & np.uint64(0xFFFF)).astype(np.int64)] = True

    def held(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Which marks each text holds, as rows of 0 and 1, and its length in words and beginnings."""
        found = np.zeros((texts.count, len(self.marks)))
        length = np.zeros(texts.count, np.int64)
        if len(self.marks):
            hashes, owners = marks_in(texts)
            length = np.bincount(owners, minlength=texts.count)
            likely = self.near[(hashes & np.uint64(0xFFFF)).astype(np.int64)]
            hashes, owners = hashes[likely], owners[likely]
            at = np.minimum(np.searchsorted(self.marks, hashes), len(self.marks) - 1)
            hit = self.marks[at] == hashes
            found[owners[hit], at[hit]] = 1
        return found, length

    def probabilities(self, found: np.ndarray, length: np.ndarray) -> np.ndarray:
        """A column for each link of the chain, the flag's last."""
        known = _front(found.sum(1), length)
        for weights in self.links:
            # row by row, so that a score does not depend on the texts beside it
            x = np.concatenate([known, found], axis=1)
            known = np.column_stack([known, _probability((x * weights).sum(1))])
        return known[:, _FRONT:]

    def scores(self, texts: Texts) -> np.ndarray:
        if not self.links:
            return np.zeros((texts.count, 1))
        return self.probabilities(*self.held(texts))


def _front(count: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Long texts hold some marks by chance, so their number counts beside the length."""
    return np.column_stack([np.ones(len(count)), np.log1p(count), np.log1p(length)])


def _probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


class _Sample:
    """Rows and the marks each holds, as two lists of numbers, with dense columns in front."""

    def __init__(self, owner: np.ndarray, mark: np.ndarray, length: np.ndarray, marks: int) -> None:
        self.owner, self.mark, self.rows, self.marks = owner, mark, len(length), marks
        self.front = _front(np.bincount(owner, minlength=self.rows), length)

    def add(self, column: np.ndarray) -> None:
        self.front = np.column_stack([self.front, column])

    def times(self, w: np.ndarray) -> np.ndarray:
        d = self.front.shape[1]
        return self.front @ w[:d] + np.bincount(self.owner, w[d + self.mark], self.rows)

    def back(self, v: np.ndarray) -> np.ndarray:
        return np.concatenate([self.front.T @ v, np.bincount(self.mark, v[self.owner], self.marks)])

    def width(self) -> int:
        return self.front.shape[1] + self.marks

    def largest(self, part: np.ndarray) -> float:
        """The square of the part's largest singular value, from above, by power iteration."""
        v = np.ones(self.width())
        size = 0.0
        for _ in range(40):
            v = self.back(part * self.times(v / np.linalg.norm(v)))
            size = float(np.linalg.norm(v))
            if not size:
                break
        return 1.1 * size


def _logistic(x: _Sample, y: np.ndarray, part: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """L2-regularised logistic regression on the rows of ``part`` (0 or 1) by Nesterov steps."""
    n = part.sum()
    lipschitz = 0.25 * x.largest(part) / n + ridge / 10
    keep = np.full(x.width(), ridge / 10)
    keep[:_FRONT] = 1e-4
    w = v = np.zeros(x.width())
    for turn in range(300):
        p = _probability(x.times(v))
        new = v - (x.back(part * (p - y)) / n + keep * v) / lipschitz
        v = new + turn / (turn + 3) * (new - w)
        w = new
    return w


def hashed_rows(rows: DataFrame) -> DataFrame:
    """flag, marks (sorted 64-bit hashes as bytes) and length of (text, label), each pair once."""

    def run(batch):
        held, lengths = [], []
        for texts in texts_of(batch.column(0), _PIECE):
            hashes, owners = marks_in(texts)
            lengths.append(np.bincount(owners, minlength=texts.count))
            order = np.lexsort((hashes, owners))
            cuts = np.searchsorted(owners[order], np.arange(1, texts.count))
            held += [np.unique(own).tobytes() for own in np.split(hashes[order], cuts)]
        return batch_of(flag=batch.column(1), marks=binaries(held), length=flat(lengths, np.int64))

    found = map_arrow(rows.select("text", "label"), run, "flag int, marks binary, length long")
    return found.groupBy("flag", "marks").agg(F.max("length").alias("length"))


def _counted(held: DataFrame) -> DataFrame:
    """In how many toxic and clean rows each mark stands: mark, often, there."""

    def run(batch):
        flags = batch.column(0).to_numpy()
        own = [np.frombuffer(raw.as_buffer(), np.int64) for raw in batch.column(1)]
        every = flat(own, np.int64)
        toxic = np.repeat(flags == 1, [len(x) for x in own]) if own else np.zeros(0, bool)
        marks, place = np.unique(every, return_inverse=True)
        often = np.bincount(place[toxic], minlength=len(marks))
        return batch_of(mark=marks, often=often, there=np.bincount(place, minlength=len(marks)) - often)

    counts = map_arrow(held, run, "mark long, often long, there long")
    return counts.groupBy("mark").agg(F.sum("often").alias("often"), F.sum("there").alias("there"))


def _holding(held: DataFrame, marks: np.ndarray) -> list:
    """Per row its flag, a hash of all its marks, its length, and which of ``marks`` it holds."""

    def run(batch):
        found = []
        for raw in batch.column(1):
            own = np.frombuffer(raw.as_buffer(), np.uint64)
            found.append(np.flatnonzero(np.isin(marks, own)).astype(np.int32))
        return batch_of(
            flag=batch.column(0), key=batch.column(2), length=batch.column(3),
            held=pa.array(found, pa.list_(pa.int32())),
        )

    rows = held.select("flag", "marks", F.xxhash64("marks"), "length")
    return map_arrow(rows, run, "flag int, key long, length long, held array<int>").collect()


def train(
    docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_marks: int = MOST_MARKS,
    seed: int = SEED,
) -> Chain:
    """Fit on at most ``per_class`` rows of each flag, none of them held out."""
    sample = labelled_rows(docs, labels, "toxic", per_class, MAX_CHARS, seed)
    held = stored(hashed_rows(sample), "marks")
    sizes = {r["flag"]: r["count"] for r in held.groupBy("flag").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    empty = Chain(np.zeros(0, np.uint64), np.zeros(0, int), [])
    if not toxic or not clean:
        return empty
    lift = (F.col("often") / toxic) / ((F.col("there") + 0.5) / clean)
    strength = (F.col("often") * F.log(lift)).alias("strength")
    strongest = (
        _counted(held)
        .filter((F.col("often") >= min(MIN_ROWS, max(2, toxic / 8))) & (lift >= MIN_LIFT))
        .select("mark", strength)
        .orderBy(F.desc("strength"), "mark")
        .limit(most_marks)
        .collect()
    )
    if not strongest:
        return empty
    marks = np.array([r["mark"] for r in strongest], np.int64).view(np.uint64)
    order = np.argsort(marks)
    rows = sorted(_holding(held, marks[order]), key=lambda r: (r["key"], r["flag"]))
    release(held)
    strength = np.array([r["strength"] for r in strongest])[order]
    return fit(
        marks[order], strength, [r["held"] for r in rows],
        np.array([r["length"] for r in rows]), np.array([r["flag"] for r in rows], float),
        mix(np.array([r["key"] for r in rows], np.int64), seed) % np.uint64(FOLDS),
    )


def fit(
    marks: np.ndarray, strength: np.ndarray, held: list, length: np.ndarray, y: np.ndarray,
    fold: np.ndarray,
) -> Chain:
    """The chain of rows that hold the ``held`` marks (places in ``marks``), flags ``y``."""
    owner = np.repeat(np.arange(len(held)), [len(h) for h in held])
    mark = np.array([m for h in held for m in h], np.int64)
    x = _Sample(owner, mark, length, len(marks))
    toxic = y[owner] == 1
    theme = _themes(owner[toxic], mark[toxic], strength, len(held))
    targets = [
        (np.bincount(owner[theme[mark] == k], minlength=len(held)) >= 1) & (y == 1)
        for k in range(theme.max() + 1)
    ]
    links = []
    for target in [*targets, y]:
        target = target.astype(float)
        links.append(_logistic(x, target, np.ones(len(y))))
        apart = np.zeros(len(y))
        for k in range(FOLDS):
            part = fold == k
            if part.any() and not part.all():
                w = _logistic(x, target, (~part).astype(float))
                apart[part] = _probability(x.times(w))[part]
        x.add(apart)
    return Chain(marks, theme, links)


def _themes(owner: np.ndarray, mark: np.ndarray, strength: np.ndarray, rows: int) -> np.ndarray:
    """Group marks by shared rows: the strongest mark opens a theme, near ones join."""
    left, theme = np.ones(len(strength), bool), np.full(len(strength), -1)
    size = np.maximum(np.bincount(mark, minlength=len(strength)), 1)
    seeds, common = [], []
    for _ in range(THEMES):
        if not left.any():
            break
        seed = np.flatnonzero(left)[strength[left].argmax()]
        with_seed = np.zeros(rows, bool)
        with_seed[owner[mark == seed]] = True
        common.append(np.bincount(mark[with_seed[owner]], minlength=len(strength)))
        seeds.append(seed)
        left &= common[-1] / np.minimum(size, size[seed]) < 0.25
        left[seed] = False
    closeness = np.stack([c / np.sqrt(size * size[s]) for c, s in zip(common, seeds)])
    theme[:] = closeness.argmax(0)
    theme[seeds] = np.arange(len(seeds))
    return theme


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, a probability per theme, score and toxic for every row of ``docs``."""

    def run(batch):
        parts = [chain.scores(t) for t in texts_of(batch.column(1), _PIECE)]
        every = np.concatenate(parts) if parts else np.zeros((0, 1))
        return batch_of(
            doc_id=batch.column(0), themes=[list(r) for r in every[:, :-1]], score=every[:, -1]
        )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    scored = map_arrow(rows, run, "doc_id long, themes array<double>, score double")
    return scored.withColumn("toxic", (F.col("score") >= THRESHOLD).cast("int"))


def keep_clean(docs: DataFrame, chain: Chain) -> DataFrame:
    """The rows of ``docs`` that are not toxic, columns unchanged."""
    return filtered(docs, lambda t: chain.scores(t)[:, -1] < THRESHOLD, _PIECE)
