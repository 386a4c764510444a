"""Scores do not depend on neighbours; methods against plain loops."""

from __future__ import annotations

import itertools
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from repotide.llm import (
    digest_runs,
    language_codes,
    license_scan,
    line_rules,
    multiset_hash,
    piece_sampling,
    quality_convnet,
    toxicity_chain,
)
from repotide.llm.common import documents, labels, prepare, texts_of

SF_DIR = "/root/testdata/sf0.001"
TEXTS = [
    "fox", "the", "zzz", "le", "", " ", "été", "a", "the quick brown fox jumps over the lazy dog again",
    "Released under the MIT License.", "x y z x y z x y z x y z x y z", "日本語 text", "line\nline\n\nend",
]


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, SF_DIR).cache()


@pytest.fixture(scope="module")
def per_row(spark, docs):
    """Operators that give rows for a row from that row alone."""
    given = labels(spark, SF_DIR)
    quality = quality_convnet.train(docs, given)
    toxic = toxicity_chain.train(docs, given)
    language = language_codes.train(docs)
    vocab = piece_sampling.read_model()
    return {
        "quality": lambda d: quality_convnet.score(d, quality),
        "license": license_scan.scan,
        "language": lambda d: language_codes.identify(d, language),
        "toxicity": lambda d: toxicity_chain.score(d, toxic),
        "lines": line_rules.clean_lines,
        "pieces": lambda d: piece_sampling.encode(d, vocab),
        "digest": lambda d: digest_runs.copies(d).select("doc_id", "text_sha256"),
    }


@pytest.mark.parametrize(
    "name", ["quality", "license", "language", "toxicity", "lines", "pieces", "digest"]
)
def test_a_row_alone_gives_what_it_gives_in_a_batch(spark, docs, per_row, name):
    prepare(spark)
    more = [r["text"] for r in docs.filter("length(text) < 3000").orderBy("doc_id").limit(60).collect()]
    rows = [(k, t, "en", "s") for k, t in enumerate(TEXTS + more)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)
    together = sorted(map(repr, per_row[name](table).collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        apart = sorted(map(repr, per_row[name](table).collect()))
    finally:
        prepare(spark)
    number = re.compile(r"-?\d+\.\d+(?:e-?\d+)?")
    if name == "quality":  # matrix products of other shapes round otherwise
        for a, b in zip(together, apart, strict=True):
            assert number.sub("", a) == number.sub("", b)
            assert np.allclose(*[[float(x) for x in number.findall(y)] for y in (a, b)], atol=1e-6)
    else:
        assert together == apart


def test_fingerprints_of_the_same_neighbours_agree(spark, docs):
    rows = multiset_hash.fingerprints(docs)
    assert sorted(map(repr, rows.collect())) == sorted(
        map(repr, multiset_hash.fingerprints(docs.repartition(5)).collect())
    )


# --- license scan -----------------------------------------------------------------

def plain_distance(a, b):
    """Fewest changed, added and removed words, by the textbook table."""
    table = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        table[i][j] = min(
            table[i - 1][j] + 1, table[i][j - 1] + 1, table[i - 1][j - 1] + (a[i - 1] != b[j - 1])
        )
    return table[-1][-1]


def test_alignment_matches_all_parts():
    random = np.random.default_rng(4)
    for _ in range(60):
        template = random.integers(0, 5, int(random.integers(1, 6)))
        words = random.integers(0, 5, int(random.integers(1, 9)))
        most = int(random.integers(0, 3))
        found = license_scan.occurrences(template, words, most)
        parts = {
            (s, e): plain_distance(template.tolist(), words[s:e].tolist())
            for s in range(len(words)) for e in range(s + 1, len(words) + 1)
        }
        for changed, s, e in found:
            assert parts[s, e] == changed <= most
        taken = {k for _, s, e in found for k in range(s, e)}
        least = min(parts.values())
        assert bool(found) >= (least <= most and least < len(template))
        if found:
            assert min(f[0] for f in found) == min(least, found[0][0])
        assert len(taken) == sum(e - s for _, s, e in found)
        lines = license_scan.differences([str(w) for w in template], [str(w) for w in words])
        cost = sum(
            max(len(x.split()) for x in line.split(" -> ")) if " -> " in line else 1 for line in lines
        )
        assert cost <= plain_distance(template.tolist(), words.tolist()) + len(lines)
        assert (not lines) == (template.tolist() == words.tolist())


class _Nothing:
    """A compressor that a dictionary does not help."""

    def compress(self, raw):
        return raw


def test_compression_decides(monkeypatch):
    text = "released under the mit license. and more words follow here"
    assert [f.license for f in license_scan.scan_text(text)] == ["MIT"]
    real = license_scan._compressors

    def off(templates):
        _, with_template, words, own = real(templates)
        return _Nothing(), {n: _Nothing() for n in with_template}, words, own

    monkeypatch.setattr(license_scan, "_compressors", off)
    assert [(f.license, f.verdict) for f in license_scan.scan_text(text)] == [(None, "unknown")]


def test_ranks_are_by_bytes_saved():
    for name, template in license_scan.TEMPLATES.items():
        found = license_scan.scan_text(template.lower())
        assert found[0].license == name and found[0].rank <= 4, name
        assert found[0].reduction > 0.4
    assert license_scan.scan_text("the license of the tavern")[0].rank is None


# --- language codes ---------------------------------------------------------------

def test_margins_and_decoding_by_plain_loops():
    rows = [("the cat sat on the mat and the dog", "en"), ("der hund und die katze im haus", "de"),
            ("le chat et le chien dans la maison", "fr"), ("el gato y el perro en la casa", "es")]
    model = language_codes.fit([(t, lang) for t, lang in rows for _ in range(5)])
    texts = [t for t, _ in rows] + ["fox", "", "a"]
    piece = next(texts_of(pa.array(texts)))
    margins = model.margins(piece)
    for at, text in enumerate(texts):
        raw = [32] + [int(language_codes._FOLD[b]) for b in text.encode()] + [32, 32, 32]
        codes = []
        for k in range(len(raw) - 2):
            code = (raw[k] * 0x9E3779B1 + raw[k + 1] * 0x85EBCA6B + raw[k + 2] * 0xC2B2AE35) % (1 << 32)
            code ^= code >> 15
            codes.append(((code * 0x2C1B3C6D) % (1 << 32)) >> 17)
        for bit in range(model.code.shape[1]):
            mean = math.fsum(float(model.weights[c, bit]) for c in codes) / len(codes)
            assert math.isclose(margins[at, bit], model.slope[bit] * mean + model.offset[bit], abs_tol=1e-9)
        losses = [
            sum(t * math.log1p(math.exp(-m * w)) for t, m, w in zip(model.trust, margins[at], word))
            / sum(model.trust)
            for word in model.code
        ]
        near = [math.exp(-(x - min(losses)) * math.sqrt(model.code.shape[1])) for x in losses]
        best, score, _ = model.decode(margins[at : at + 1])
        assert losses[best[0]] == pytest.approx(min(losses))
        assert score[0] == pytest.approx(max(near) / sum(near))


def test_only_the_most_frequent_languages_are_learned(spark):
    prepare(spark)
    rows = [(k, "some text", f"l{k}") for k in range(0, 60)] + [(100 + k, "text", "en") for k in range(9)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_codes.train(table, most=3)
    assert len(model.languages) == 3 and "en" in model.languages


# --- toxicity chain ---------------------------------------------------------------

def test_marks_by_plain_loops():
    texts = ["Bad, badly WORDS; ok", "ok", "", "ünique wordsmith"]
    piece = next(texts_of(pa.array(texts)))
    hashes, owners = toxicity_chain.marks_in(piece)
    spelled = {}
    for at, text in enumerate(texts):
        parts = []
        for word in re.findall(rb"[a-z\x80-\xff]+", text.lower().encode()):
            parts.append(word)
            parts += [(word[:n], n) for n in toxicity_chain.BEGINNINGS if len(word) > n]
        own = hashes[owners == at]
        assert len(own) == len(parts)
        for mark in own.tolist():
            spelled.setdefault(mark, set()).add(at)
    # only texts 0 and 1 share a word, 0 and 3 a beginning
    assert sorted(len(v) for v in spelled.values())[-3:] == [2, 2, 2] or max(map(len, spelled.values())) == 2


def test_chain_by_plain_loops(spark, docs):
    chain = toxicity_chain.train(docs, labels(spark, SF_DIR))
    texts = [r["text"] or "" for r in docs.limit(40).collect()]
    scored = chain.scores(next(texts_of(pa.array(texts), 1 << 30)))
    place = {int(m): k for k, m in enumerate(chain.marks)}
    for at, text in enumerate(texts):
        hashes, _ = toxicity_chain.marks_in(next(texts_of(pa.array([text]))))
        held = {place[int(h)] for h in hashes if int(h) in place}
        known = [1.0, math.log1p(len(held)), math.log1p(len(hashes))]
        for k, weights in enumerate(chain.links):
            front = len(known)
            margin = sum(w * x for w, x in zip(weights, known))
            margin += sum(weights[front + m] for m in held)
            known.append(1 / (1 + math.exp(-max(-30, min(30, margin)))))
            assert scored[at, k] == pytest.approx(known[-1], rel=1e-9)


def test_distinct_training_rows_all_count(spark, docs):
    prepare(spark)
    rows = [(k, "same start " + w, 1) for k, w in enumerate(["alpha", "beta", "gamma", "alpha"])]
    table = spark.createDataFrame(rows, "doc_id long, text string, label int")
    assert toxicity_chain.hashed_rows(table).count() == 3


def test_sparse_training_matches_dense(spark):
    random = np.random.default_rng(8)
    rows, marks = 60, 7
    dense = random.random((rows, marks)) < 0.3
    owner, mark = np.nonzero(dense)
    length = random.integers(5, 50, rows)
    x = toxicity_chain._Sample(owner, mark, length, marks)
    full = np.column_stack([np.ones(rows), np.log1p(dense.sum(1)), np.log1p(length), dense])
    w, v = random.standard_normal(full.shape[1]), random.standard_normal(rows)
    part = (random.random(rows) < 0.7).astype(float)
    assert np.allclose(x.times(w), full @ w) and np.allclose(x.back(v), full.T @ v)
    true = np.linalg.norm(full[part == 1], 2) ** 2
    assert true * 0.999 <= x.largest(part) <= true * 1.11


# --- convolution --------------------------------------------------------------------

def test_scores_do_not_change_with_the_piece_size(spark, docs):
    model = quality_convnet.train(docs, labels(spark, SF_DIR))
    column = pa.array([r["text"] for r in docs.limit(50).collect()])
    whole = np.concatenate([model.scores(t) for t in texts_of(column, 1 << 30)])
    cut = np.concatenate([model.scores(t) for t in texts_of(column, 1)])
    assert np.allclose(whole, cut, atol=1e-6)


# --- line rules -----------------------------------------------------------------------

def rules_by_hand(line):
    """Which of the six rules a line with words breaks."""
    words = re.findall(r"[^\x20\x09-\x0d]+", line)
    symbols = sum(c in "#*$%&|<>" for c in line)
    bars = line.count("|")
    letters = sum(c.isascii() and c.isalpha() for c in line)
    upper = sum(c.isascii() and c.isupper() for c in line)
    doubled = sum(a == b for a, b in zip(words, words[1:]))
    low = "".join(c.lower() if c.isascii() else c for c in line)
    return [
        (symbols - bars) * 4 > len(words), bars * 5 > len(words) * 2,
        upper * 10 > letters * 7 and letters > 20, doubled * 3 > len(words) and len(words) >= 6,
        any(p in low for p in line_rules.BOILERPLATE) and len(words) <= 30,
        len(words) < 4 and not any(c in ".!?,;:" for c in line),
    ]


def test_rules_of_every_line_by_hand(spark, docs):
    odd = ["menu | home | about", "a a a a a a b", "THIS IS ALL IN CAPITAL LETTERS HERE", "# # # $ x", "ok.",
           "one two", f"Please {line_rules.BOILERPLATE[0]} now", "", "x\n\n\ny z w v u, t"]
    rows = [(k, t) for k, t in enumerate(odd)] + [(100 + r["doc_id"], r["text"]) for r in docs.collect()]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    for r in line_rules.clean_lines(table).collect():
        lines = [x for x in (texts[r["doc_id"]] or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
        good = [x for x in lines if not any(rules_by_hand(x))]
        assert r["clean_text"] == "\n".join(good)
        assert r["n_lines"] == len(lines) and r["n_lines_removed"] == len(lines) - len(good)
        lost = 100 * r["n_words_removed"] > line_rules.LOST_PERCENT * r["n_words"]
        assert r["kept"] == (not r["base_failed"] and not lost)
