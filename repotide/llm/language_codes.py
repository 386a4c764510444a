"""Language ID by error-correcting output codes over byte n-grams.

Every language has a codeword of bits. For each bit a binary classifier reads
hashed byte trigrams of the whole text, letters lower-cased and everything
else in ASCII folded to a space: its answer is the mean log-odds of the text's
trigrams, with slope and offset fitted by logistic regression. Decoding
weighs each bit by how reliable it was on the training rows, adds up the
logistic losses of every codeword and chooses the nearest one; a small lead
over the runner-up flags the row as ambiguous.

Up to seven languages get the exhaustive code, more get seeded random words
with the largest least distance. A text that is null or has no letter is
``und`` with score 0, as is every text if no language was learned. One learned
language is chosen with score 1.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import Texts, batch_of, drawn, flat, held_out, map_arrow, texts_of

UNKNOWN = "und"
BUCKETS = 1 << 15
PER_LANGUAGE, MOST_LANGUAGES, MAX_CHARS, SEED = 1000, 256, 20_000, 29
AMBIGUOUS = 0.8
_PIECE = 1 << 18

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def codewords(languages: int, seed: int = SEED) -> np.ndarray:
    """One row of +1 and -1 per language, no constant or repeated column."""
    if languages < 2:
        return np.ones((languages, 0))
    if languages <= 7:
        bits = np.arange(1, 1 << (languages - 1))
        rows = [np.ones(len(bits))]
        rows += [np.where(bits >> k & 1, -1.0, 1.0) for k in range(languages - 1)]
        return np.stack(rows)
    random = np.random.default_rng(seed)
    length = int(np.ceil(10 * np.log2(languages)))
    best, most = None, -1.0
    for _ in range(200):
        code = random.choice([-1.0, 1.0], (languages, length))
        apart = (length - code @ code.T) / 2 + length * np.eye(languages)
        varied = np.abs(code.sum(0)).max() < languages
        if varied and apart.min() > most:
            best, most = code, apart.min()
    return best


def trigrams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every byte trigram, and where each text's begin.

    A space stands before a text and three behind it, and no trigram reaches past them.
    """
    sizes = np.diff(texts.starts)
    padded = np.full(len(texts.data) + 4 * texts.count, 32, np.uint8)
    begin = texts.starts[:-1] + 4 * np.arange(texts.count)
    shift = np.repeat(begin + 1 - texts.starts[:-1], sizes)
    padded[np.arange(len(texts.data)) + shift] = _FOLD[texts.data]
    b = padded.astype(np.uint32)
    code = (b[:-2] * 0x9E3779B1 + b[1:-1] * 0x85EBCA6B + b[2:] * 0xC2B2AE35).astype(np.uint32)
    code ^= code >> np.uint32(15)
    inside = np.ones(len(padded), bool)
    inside[begin + sizes + 2] = inside[begin + sizes + 3] = False
    code = code[inside[:-2]]
    return ((code * np.uint32(0x2C1B3C6D)) >> np.uint32(17)).astype(np.int64), begin - 2 * np.arange(texts.count)


class LanguageModel:
    def __init__(self, languages: list[str], code: np.ndarray) -> None:
        self.languages, self.code = languages, code
        bits = code.shape[1]
        self.weights = np.zeros((BUCKETS, bits), np.float32)
        self.slope, self.offset, self.trust = np.ones(bits), np.zeros(bits), np.ones(bits)

    def margins(self, texts: Texts) -> np.ndarray:
        codes, begin = trigrams(texts)
        looked = np.take(self.weights, codes, axis=0)
        total = np.add.reduceat(looked, begin, axis=0, dtype=np.float64)
        count = np.diff(np.concatenate((begin, [len(codes)])))
        return self.slope * (total / count[:, None]) + self.offset

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its score, and the lead over the next."""
        losses = np.logaddexp(0, -margins[:, None, :] * self.code[None])
        losses = (losses * self.trust).sum(2) / self.trust.sum()
        near = np.exp(-(losses - losses.min(1, keepdims=True)) * self.code.shape[1] ** 0.5)
        share = near / near.sum(1, keepdims=True)
        best = share.argmax(1)
        ordered = np.sort(share, 1)
        return best, ordered[:, -1], ordered[:, -1] - ordered[:, -2]

    def predict(self, texts: Texts) -> tuple[list[str], np.ndarray, np.ndarray]:
        n = texts.count
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
        if len(self.languages) == 1:
            return self.languages * n, np.ones(n), np.zeros(n, bool)
        best, score, lead = self.decode(self.margins(texts))
        return [self.languages[i] for i in best], score, lead < AMBIGUOUS


def _logistic(x: np.ndarray, sign: np.ndarray) -> tuple[float, float]:
    """Slope and offset by a few damped Newton steps; the classes weigh alike."""
    weight = np.where(sign > 0, 0.5 / max((sign > 0).sum(), 1), 0.5 / max((sign < 0).sum(), 1))
    a, b = 1.0, 0.0
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        off = weight * (p - (sign > 0))
        curve = weight * p * (1 - p)
        gradient = np.array([off @ x + 1e-4 * a, off.sum()])
        hessian = np.array([[curve @ (x * x), curve @ x], [curve @ x, curve.sum()]])
        step = np.linalg.solve(hessian + np.diag([1e-4, 1e-6]), gradient)
        a, b = a - np.clip(step[0], -5, 5), b - np.clip(step[1], -5, 5)
    return float(a), float(b)


def fit(rows: list[tuple[str, str]], seed: int = SEED) -> LanguageModel:
    """Rows are (text, language)."""
    languages = sorted({lang for _, lang in rows})
    model = LanguageModel(languages, codewords(len(languages), seed))
    if len(languages) < 2:
        return model
    raw = [text.encode() for text, _ in rows]
    labels = np.array([languages.index(lang) for _, lang in rows])
    counts = np.zeros((len(languages), BUCKETS))
    pieces = []
    for at in range(0, len(raw), 64):
        some = raw[at : at + 64]
        starts = np.concatenate(([0], np.cumsum([len(x) for x in some])))
        texts = Texts(at, np.frombuffer(b"".join(some), np.uint8), starts)
        pieces.append(texts)
        codes, begin = trigrams(texts)
        owner = np.repeat(labels[at : at + 64], np.diff(np.concatenate((begin, [len(codes)]))))
        counts += np.bincount(
            owner * BUCKETS + codes, minlength=len(languages) * BUCKETS
        ).reshape(-1, BUCKETS)
    shares = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    for bit in range(model.code.shape[1]):
        up = shares[model.code[:, bit] > 0].mean(0)
        down = shares[model.code[:, bit] < 0].mean(0)
        model.weights[:, bit] = np.log((up + 1e-5) / (down + 1e-5))
    seen = np.concatenate([model.margins(t) for t in pieces])
    for bit in range(model.code.shape[1]):
        sign = model.code[labels, bit]
        model.slope[bit], model.offset[bit] = _logistic(seen[:, bit], sign)
        right = model.slope[bit] * seen[:, bit] + model.offset[bit]
        wrong = np.mean(np.sign(right) != sign)
        model.trust[bit] = 0.5 * np.log((1 - wrong + 0.01) / (wrong + 0.01))
    model.trust = np.maximum(model.trust, 0.05)
    return model


def train(
    docs: DataFrame, per_language: int = PER_LANGUAGE, most: int = MOST_LANGUAGES, seed: int = SEED
) -> LanguageModel:
    """Fit on about ``per_language`` rows of each language, none of them held out.

    Learned are the ``most`` languages with the most rows. Rows are drawn by a seeded hash
    of the id with the share that gives each language its number; texts of over ``MAX_CHARS``
    characters stay out, and of rows with the same id and language the smallest text stays.
    What reaches the driver is bound by languages x rows x characters.
    """
    rows = docs.select("doc_id", "text", "lang").filter(
        ~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()
        & F.col("text").isNotNull()
    )
    sizes = (
        rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "lang").limit(most)
    )
    picked = (
        rows.filter(F.length("text") <= MAX_CHARS)
        .join(F.broadcast(sizes), "lang")
        .filter(drawn("doc_id", seed) < per_language / F.col("n"))
        .groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
        .collect()
    )
    picked = sorted(picked, key=lambda r: (r["doc_id"], r["text"], r["lang"]))
    return fit([(r["text"], r["lang"]) for r in picked])


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous for every row of ``docs``."""

    def run(batch):
        parts = [model.predict(t) for t in texts_of(batch.column(2), _PIECE)]
        return batch_of(
            doc_id=batch.column(0),
            held_out=batch.column(1),
            lang_pred=[x for p in parts for x in p[0]],
            score=flat([p[1] for p in parts], np.float64),
            ambiguous=flat([p[2] for p in parts], bool),
            lettered=batch.column(3),
        )

    rows = docs.select(
        F.col("doc_id").cast("long"),
        held_out().alias("held_out"),
        "text",
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )
    schema = (
        "doc_id long, held_out boolean, lang_pred string, score double,"
        " ambiguous boolean, lettered boolean"
    )
    found = map_arrow(rows, run, schema)
    lettered = F.col("lettered")
    return found.select(
        "doc_id",
        "held_out",
        F.when(lettered, F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(lettered, F.col("score")).otherwise(0.0).alias("score"),
        (F.col("ambiguous") | ~lettered).alias("ambiguous"),
    )
