"""Quality classifier: a byte-level convolutional network in numpy.

Every byte is described by fixed character classes. Learned filters over
``WIDTH`` bytes run over the whole text at every second byte; their rectified
answers are averaged over chunks of two adjacent blocks, so chunks overlap by
half and cover every byte. A second layer of learned filters reads each chunk
and is max-pooled over all chunks; a last layer combines the maxima into one
probability. Training takes a bounded sample of labelled rows on the driver,
with gradients through the winning chunks only; scoring runs in tasks, where
the first layer is a sum of table rows looked up by byte.

Null and empty texts have one empty chunk and get a score like any other.
Without labelled rows of both classes the score is the share of label 1 (0.5
if there are none at all).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import (
    Texts,
    batch_of,
    flat,
    held_out,
    labelled_sample,
    map_arrow,
    texts_of,
)

WIDTH, STRIDE, BLOCK = 8, 2, 128
FILTERS, CHUNK_FILTERS = 16, 16
PER_CLASS, MAX_CHARS, EPOCHS, BATCH, RATE, SEED = 1500, 20_000, 8, 32, 6e-3, 17
_PIECE = 1 << 16


def _classes() -> np.ndarray:
    b = np.arange(256)
    lower, upper = (b >= 97) & (b <= 122), (b >= 65) & (b <= 90)
    rows = [
        lower,
        upper,
        (b >= 48) & (b <= 57),
        b == 32,
        (b >= 9) & (b <= 13),
        np.isin(b, list(b".!?")),
        np.isin(b, list(b",;:'\"()-")),
        (b > 32) & (b < 127) & np.isin(b, list(b"#*$%&|<>@^_~=+/\\{}[]`")),
        b >= 128,
        np.isin(b, list(b"aeiouAEIOU")),
        b == ord("|"),
    ]
    return np.stack(rows, 1).astype(np.float32)


CLASSES = _classes()


class ConvNet:
    """Weights, scoring and training; picklable, a few kilobytes."""

    def __init__(self, seed: int = SEED) -> None:
        random = np.random.default_rng(seed)
        depth = WIDTH * CLASSES.shape[1]
        self.w = {
            "w1": random.normal(0, (2 / WIDTH / 2) ** 0.5, (depth, FILTERS)),
            "b1": np.zeros(FILTERS),
            "w2": random.normal(0, (2 / FILTERS) ** 0.5, (FILTERS, CHUNK_FILTERS)),
            "b2": np.zeros(CHUNK_FILTERS),
            "w3": random.normal(0, CHUNK_FILTERS**-0.5, CHUNK_FILTERS),
            "b3": np.zeros(1),
        }
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}
        self.constant: float | None = None

    # layout: each text begins at a block border and is followed by at least
    # WIDTH zero bytes, so no filter reads the next text
    @staticmethod
    def _lay(texts: Texts):
        sizes = np.diff(texts.starts)
        blocks = -(-(sizes + WIDTH) // BLOCK)
        first = np.concatenate(([0], np.cumsum(blocks)))
        data = np.zeros(int(first[-1]) * BLOCK + WIDTH, np.uint8)
        shift = np.repeat(first[:-1] * BLOCK - texts.starts[:-1], sizes)
        data[np.arange(len(texts.data)) + shift] = texts.data
        valid = np.zeros(int(first[-1]) * BLOCK, bool)
        valid[np.arange(len(texts.data)) + shift] = True
        return data, valid[::STRIDE], first, blocks

    def _chunks(self, texts: Texts):
        """Mean filter answers of every chunk, and the chunks' layout."""
        data, valid, first, blocks = self._lay(texts)
        kinds = CLASSES.shape[1]
        n = len(data) - WIDTH
        answers = np.zeros((n // STRIDE, FILTERS), np.float32)
        looked = np.empty_like(answers)
        for k in range(WIDTH):
            table = CLASSES @ self.w["w1"][k * kinds : (k + 1) * kinds]
            np.take(table, data[k : k + n : STRIDE], axis=0, out=looked, mode="clip")
            answers += looked
        answers += self.w["b1"]
        np.maximum(answers, 0, out=answers)
        answers[~valid] = 0
        per = BLOCK // STRIDE
        sums = answers.reshape(-1, per, FILTERS).sum(1)
        counts = valid.reshape(-1, per).sum(1)
        # chunk = a block and the next one of the same text
        chunks = np.maximum(blocks - 1, 1)
        starts = np.concatenate(([0], np.cumsum(chunks)))
        owner = np.repeat(np.arange(texts.count), chunks)
        left = np.arange(starts[-1]) - starts[owner] + first[owner]
        pair = blocks[owner] > 1
        right = left + pair
        count = np.maximum(counts[left] + counts[right] * pair, 1).astype(np.float32)
        mean = (sums[left] + sums[right] * pair[:, None]) / count[:, None]
        return mean, starts, left, right, count, data, valid

    def scores(self, texts: Texts) -> np.ndarray:
        if self.constant is not None:
            return np.full(texts.count, self.constant)
        mean, starts, *_ = self._chunks(texts)
        second = np.maximum(mean @ self.w["w2"] + self.w["b2"], 0)
        pooled = np.maximum.reduceat(second, starts[:-1], axis=0)
        logit = pooled.astype(np.float64) @ self.w["w3"] + self.w["b3"][0]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def _gradients(self, texts: Texts, wanted: np.ndarray):
        mean, starts, left, right, count, data, valid = self._chunks(texts)
        second = np.maximum(mean @ self.w["w2"] + self.w["b2"], 0)
        n, g = texts.count, {}
        best = np.stack([s + second[s:e].argmax(0) for s, e in zip(starts, starts[1:])])
        pooled = second[best, np.arange(CHUNK_FILTERS)]
        logit = pooled @ self.w["w3"] + self.w["b3"]
        d = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - wanted) / n).astype(np.float32)
        g["w3"], g["b3"] = pooled.T @ d, d.sum(keepdims=True)
        d2 = np.outer(d, self.w["w3"]) * (pooled > 0)
        used, place = np.unique(best, return_inverse=True)
        place = place.reshape(best.shape)
        dense = np.zeros((len(used), CHUNK_FILTERS), np.float32)
        np.add.at(dense, (place, np.arange(CHUNK_FILTERS)[None, :].repeat(n, 0)), d2)
        g["w2"], g["b2"] = mean[used].T @ dense, dense.sum(0)
        dmean = dense @ self.w["w2"].T / count[used][:, None]
        per, kinds = BLOCK // STRIDE, CLASSES.shape[1]
        g["w1"], g["b1"] = np.zeros_like(self.w["w1"]), np.zeros_like(self.w["b1"])
        for side, also in ((left[used], None), (right[used], right[used] != left[used])):
            keep = slice(None) if also is None else also
            side, back = side[keep], dmean[keep]
            at = (side[:, None] * per + np.arange(per)[None, :]).ravel()
            seen = CLASSES[data[at[:, None] * STRIDE + np.arange(WIDTH)]].reshape(len(at), -1)
            live = (seen @ self.w["w1"] + self.w["b1"] > 0) & valid[at][:, None]
            step = np.repeat(back, per, 0) * live
            g["w1"] += seen.T @ step
            g["b1"] += step.sum(0)
        assert g["w1"].shape[0] == WIDTH * kinds
        return g

    def fit(self, texts: list[str], wanted: list[int], epochs: int = EPOCHS, seed: int = SEED):
        """Adam over balanced minibatches; the classes weigh alike."""
        wanted = np.array(wanted, np.float32)
        if len(set(wanted.tolist())) < 2:
            self.constant = float(wanted.mean()) if len(wanted) else 0.5
            return self
        random = np.random.default_rng(seed)
        raw = [t.encode() for t in texts]
        moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.w.items()}
        sides = [np.flatnonzero(wanted == c) for c in (0, 1)]
        half, step = BATCH // 2, 0
        rounds = epochs * max(12, len(raw) // BATCH)
        for turn in range(rounds):
            rows = np.concatenate([random.choice(s, half) for s in sides])
            some = [raw[i] for i in rows]
            starts = np.concatenate(([0], np.cumsum([len(x) for x in some])))
            batch = Texts(0, np.frombuffer(b"".join(some), np.uint8), starts)
            rate = RATE * (1 - turn / rounds)
            step += 1
            for k, grad in self._gradients(batch, wanted[rows]).items():
                m, v = moments[k]
                m += 0.1 * (grad - m)
                v += 0.002 * (grad * grad - v)
                scale = np.sqrt(v / (1 - 0.998**step)) + 1e-8
                self.w[k] -= (rate * (m / (1 - 0.9**step)) / scale).astype(np.float32)
        return self


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> ConvNet:
    """Fit on at most ``per_class`` rows of each label, none of them held out."""
    rows = labelled_sample(docs, labels, "quality", per_class, MAX_CHARS, SEED)
    return ConvNet().fit([r[1] for r in rows], [r[2] for r in rows])


def score(docs: DataFrame, model: ConvNet) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""

    def run(batch):
        parts = [model.scores(t) for t in texts_of(batch.column(2), _PIECE)]
        return batch_of(
            doc_id=batch.column(0),
            held_out=batch.column(1),
            score=flat(parts, np.float64),
        )

    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    scored = map_arrow(rows, run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, model: ConvNet) -> DataFrame:
    """The rows of ``docs`` with a score of 0.5 or more, columns unchanged."""
    return filtered(docs, lambda t: model.scores(t) >= 0.5, _PIECE)


def filtered(docs: DataFrame, verdict, piece: int) -> DataFrame:
    """Rows whose text passes ``verdict``, in one pass that moves nothing."""
    place = docs.columns.index("text")
    # by number, as names with a dot cannot be handed to tasks
    rows = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])

    def run(batch):
        import pyarrow as pa

        parts = [verdict(t) for t in texts_of(batch.column(place), piece)]
        return batch.filter(pa.array(flat(parts, bool)))

    return map_arrow(rows, run, rows.schema).toDF(*docs.columns)
