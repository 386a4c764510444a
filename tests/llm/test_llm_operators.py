"""The operators against brute force, held-out accuracy, round trips and odd tables."""

from __future__ import annotations

import collections
import hashlib
import re
import string
import textwrap
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from repotide.llm import (
    language_codes,
    license_scan,
    line_rules,
    mixing,
    multiset_hash,
    ngram_join,
    piece_sampling,
    quality_convnet,
    toxicity_chain,
    training_order,
)
from repotide.llm.common import documents, labels, prepare, texts_of
from repotide.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, score int, held_out string, _crc int, number int,"
    " node string, _id int, _copies int, _rows int, _kept string, row int, kept int, _words int, `a.b` int"
)
LONG = "Long lines go on and on, word by word. " * 30_000


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, SF_DIR).cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing columns."""
    prepare(spark)
    more = (7, "x", 1, 2, "y", 8, 9, 10, "k", 11, 12, 13, 14)
    rows = [
        (0, None, None, None), (1, "", "en", "a"), (2, " \t\n ", "en", None), (3, "one", "en", "b"),
        (4, "five words are in here", "en", "b"), (4, "five words are in here", "en", "b"),
        (5, "Five words ARE in here", "fr", "b"), (6, LONG, "en", "c"), (7, LONG + "end", "en", "c"),
        (8, "ünïcode 日本語 😀 ▁ mark\r\n\r\nline\n", "de", "é"), (None, "no id", None, "a"),
        (9, "12 34 !! ??", "es", "a"), (4, "another text under the same id", "en", "b"),
    ]
    return spark.createDataFrame([r + more for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def marks(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def operators(spark):
    none = marks(spark, [(3, 0, 1), (4, 1, 0), (4, None, None), (None, 1, 1), (99, 1, 1)])
    vocab = piece_sampling.read_model()
    return {
        "quality": lambda d: quality_convnet.score(d, quality_convnet.train(d, none)),
        "license": license_scan.scan,
        "language": lambda d: language_codes.identify(d, language_codes.train(d)),
        "toxicity": lambda d: toxicity_chain.score(d, toxicity_chain.train(d, none)),
        "mix": mixing.mix,
        "lines": line_rules.clean_lines,
        "pieces": lambda d: piece_sampling.encode(d, vocab),
        "join": ngram_join.near_duplicates,
        "hash": multiset_hash.fingerprints,
        "order": training_order.materialise,
    }


ONE_PER_ROW = ["quality", "language", "toxicity", "mix", "lines", "join", "hash"]


@pytest.mark.parametrize("name", [*ONE_PER_ROW, "license", "pieces", "order"])
def test_odd_and_empty_tables(spark, odd, empty, name):
    run = operators(spark)[name]
    assert run(empty).collect() == []
    rows = run(odd).collect()
    if name in ONE_PER_ROW:
        ids = collections.Counter(r["doc_id"] for r in odd.collect())
        assert collections.Counter(r["doc_id"] for r in rows) == ids


def test_pipeline_stages_on_odd_and_empty_tables(spark, odd, empty, tmp_path):
    marks(spark, [(3, 0, 1)]).write.parquet(f"{tmp_path}/labels.parquet")
    for table in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, str(tmp_path))
            if name != "pieces":
                assert out.columns == table.columns
            assert out.count() <= 3 * table.count()


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


# --- classifiers ------------------------------------------------------------

def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_classifiers_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, given = documents(spark, sf), labels(spark, sf)
    truth = {r["doc_id"]: r for r in given.collect()}
    for model, column, label, least in (
        (quality_convnet.score(docs, quality_convnet.train(docs, given)), "predicted", "quality", 0.9),
        (toxicity_chain.score(docs, toxicity_chain.train(docs, given)), "toxic", "toxic", 0.93),
    ):
        right = [
            r[column] == truth[r["doc_id"]][label]
            for r in model.collect() if r["doc_id"] in truth and held(r["doc_id"])
        ]
        assert len(right) > 80 and np.mean(right) >= least
    langs = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    found = language_codes.identify(docs, language_codes.train(docs)).collect()
    assert all(r["held_out"] == held(r["doc_id"]) for r in found)
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in found if r["held_out"]]) > 0.97


def test_language_of_texts_without_letters(spark, odd):
    model = language_codes.fit([("the cat sat on the mat " * 9, "en"), ("der hund und die katze " * 9, "de")])
    rows = {r["doc_id"]: r for r in language_codes.identify(odd.filter("doc_id IN (0, 1, 2, 3, 9)"), model).collect()}
    assert [rows[k]["lang_pred"] for k in (0, 1, 2, 9)] == ["und"] * 4
    assert rows[3]["lang_pred"] in ("en", "de")


@pytest.mark.parametrize("n", [2, 4, 7, 12])
def test_codewords_differ(n):
    code = language_codes.codewords(n)
    apart = (code.shape[1] - code @ code.T) / 2 + 99 * np.eye(n)
    assert apart.min() >= (1 if n == 2 else code.shape[1] // 4)


def test_gradients_of_the_network():
    net = quality_convnet.ConvNet(3)
    texts = next(texts_of(pa.array(["Some plain text. " * 30, "### %% ### | | x" * 9])))
    wanted = np.array([1.0, 0.0], np.float32)

    def loss():
        p = np.clip(net.scores(texts), 1e-9, 1 - 1e-9)
        return -np.mean(wanted * np.log(p) + (1 - wanted) * np.log(1 - p))

    grads = net._gradients(texts, wanted)
    for key, at in (("w1", (5, 2)), ("w2", (3, 1)), ("w3", (4,)), ("b2", (0,))):
        step = 1e-2
        net.w[key][at] += step
        up = loss()
        net.w[key][at] -= 2 * step
        down = loss()
        net.w[key][at] += step
        assert abs((up - down) / (2 * step) - grads[key][at]) < 2e-2


# --- licenses ---------------------------------------------------------------

@pytest.mark.parametrize(
    "block, name, verdict",
    [
        ("Released under the MIT License.", "MIT", "exact"),
        ("see: released under the mit license", "MIT", "exact"),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", "exact"),
        ("Licensed under CC BY 4.0.", "CC-BY-4.0", "exact"),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0", "exact"),
        ("This work is licenced under the GNU General Public License, version 3.", "GPL-3.0", "variant"),
        ("You need a license to drive a truck in most places.", None, "unknown"),
    ],
)
def test_license_blocks(block, name, verdict):
    assert license_scan.scan_block(block.encode())[:2] == (name, verdict)


def test_license_places(spark):
    text = "a\nReleased under the MIT License.\nb\nc\nd\nAll rights reserved."
    found = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(r["first_line"], r["license"]) for r in found] == [(1, "MIT"), (5, "all-rights-reserved")]


@pytest.mark.parametrize("name", ["MIT-text", "BSD-3-Clause", "Apache-2.0-header"])
@pytest.mark.parametrize("mark", ["", " * ", "# "])
def test_wrapped_licenses(spark, name, mark):
    lines = textwrap.wrap(license_scan.TEMPLATES[name], 60)
    text = "\n".join(["some code", "", *[mark + line for line in lines], "", "more code"])
    found = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(r["license"], r["verdict"], r["first_line"], r["last_line"]) for r in found] == [
        (name, "exact", 2, 1 + len(lines))
    ]


@pytest.mark.parametrize("name", license_scan.TEMPLATES)
def test_licenses_inside_paragraphs(docs, name):
    prose = " ".join(
        r["text"] for r in docs.filter("lang = 'en' AND n_chars > 2000").orderBy("doc_id").limit(9).collect()
    )
    prose = re.sub("(?i)" + "|".join(license_scan.CUES), "", prose).replace("\n", " ").lower()
    notice = license_scan.TEMPLATES[name].lower()
    for n in (0, 40, 80, 160, 320, 5000):
        text = f"{prose[:n]} {notice} {prose[n : 2 * n]}"
        found = license_scan.scan_text(text)
        assert [(f.license, f.verdict) for f in found] == [(name, "exact")], n


@pytest.mark.parametrize("between", ["\n", " ", " and some words, then: "])
def test_several_notices_in_one_place(spark, between):
    names = ["Apache-2.0", "MIT", "all-rights-reserved", "GPL-3.0", "CC-BY-SA-4.0", "MIT", "CC0-1.0"]
    text = between.join(license_scan.TEMPLATES[n] for n in names)
    found = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(r["license"], r["verdict"]) for r in found] == [(n, "exact") for n in names]
    assert [r["first_line"] for r in found] == [k if between == "\n" else 0 for k in range(len(names))]


@pytest.mark.parametrize("name", license_scan.TEXTS)
@pytest.mark.parametrize("mark", ["", " * "])
def test_whole_texts_and_headers(name, mark):
    lines = textwrap.wrap(license_scan.TEMPLATES[name], 76)
    text = "\n".join(["Some code, by someone.", *[mark + line for line in lines], "", "more code"])
    found = license_scan.scan_text(text.lower())
    assert [(f.license, f.verdict) for f in found] == [(name, "exact")]


def test_cues_parted_by_lines(spark):
    text = "One.\n# All\n# rights\n# reserved.\n\n" + "word " * 99 + "\n * Permission is\n * hereby granted."
    found = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(r["license"], r["first_line"]) for r in found] == [("all-rights-reserved", 1), (None, 6)]


def test_licenses_that_share_sentences():
    texts = license_scan.TEMPLATES
    named = texts["BSD-3-Clause"].replace("the copyright holder nor", "Some Company Ltd. nor")
    for text, wanted in (
        (named, ("BSD-3-Clause", "variant")),
        (texts["BSD-2-Clause"].replace("1. ", "* ").replace("2. ", "* "), ("BSD-2-Clause", "variant")),
        (texts["BSD-opening"], ("BSD-opening", "exact")),
        (texts["GPL-2.0-or-later"].replace("version 2", "version 3"), ("GPL-2.0-or-later", "variant")),
        (texts["MIT-full"].replace("AUTHORS", "SELLERS"), ("MIT-full", "variant")),
    ):
        assert [(f.license, f.verdict) for f in license_scan.scan_text(text.lower())] == [wanted]


# --- mixing -----------------------------------------------------------------

def test_mix_meets_its_targets(spark, docs):
    rows = mixing.mix(docs).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()))
    sizes = {r["doc_id"]: len(WORD.findall(r["text"])) for r in docs.collect()}
    assert all(r["size"] == sizes[r["doc_id"]] and 0 <= r["copies"] <= 3 for r in rows)
    total = sum(sizes.values())
    by = collections.defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    assert abs(sum(v[0]["target"] for v in by.values()) - total) < 1e-6 * total
    for own in by.values():
        taken = sum(r["size"] * r["copies"] for r in own)
        whole, target = own[0]["source_size"], own[0]["target"]
        sums = {int(target // whole) * whole}
        for r in own:
            sums |= {s + r["size"] for s in sums}
        assert abs(taken - target) <= min(abs(s - target) for s in sums) + 2


def water(sizes, weights, most=3):
    targets, total = dict.fromkeys(sizes, 0.0), sum(sizes.values())
    open_, rest = set(sizes), float(total)
    while rest > 1e-9 and open_:
        share = sum(weights[s] for s in open_)
        for s in open_:
            targets[s] += rest * weights[s] / share
        over = {s for s in open_ if targets[s] > most * sizes[s]}
        rest = sum(targets[s] - most * sizes[s] for s in over)
        for s in over:
            targets[s] = most * sizes[s]
        open_ -= over
    return targets


def test_targets_stop_at_three_times_the_source(spark):
    sizes = {None: 900, "a": 10, "b": 5, "c": 1, "é": 40, "d": 0}
    order = sorted((s for s in sizes if s is not None), key=lambda s: s) + [None]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    rows = mixing.source_targets(
        spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    ).collect()
    wanted = water(sizes, weights)
    assert all(abs(r["target"] - wanted[r["source"]]) < 1e-6 for r in rows) and len(rows) == 6


def test_plan_of_a_source_does_not_depend_on_row_order():
    size = np.arange(0, 3000)
    rows = pd.DataFrame({"size": size, "n": 3, "source": "a"})
    rows["source_size"] = int((rows["size"] * rows["n"]).sum())
    rows["target"] = rows["source_size"] * 0.37
    plans = [
        mixing._plan_source(rows.sample(frac=1, random_state=k)).sort_values("size") for k in range(3)
    ]
    for other in plans[1:]:
        assert plans[0]["extra"].tolist() == other["extra"].tolist()


def test_budget_is_met_as_well_as_can_be():
    random = np.random.default_rng(0)
    for _ in range(60):
        lengths = np.unique(random.integers(1, 60, 5))
        counts = random.integers(1, 4, len(lengths))
        budget = int(random.integers(0, (lengths * counts).sum() + 1))
        taken = mixing.fit_budget(lengths, counts, budget)
        sums = {0}
        for length, count in zip(lengths, counts):
            sums = {s + k * length for s in sums for k in range(count + 1)}
        assert (taken >= 0).all() and (taken <= counts).all()
        nearest = min(abs(s - budget) for s in sums)
        assert abs((taken * lengths).sum() - budget) == nearest


# --- line rules -------------------------------------------------------------

def counts_by_hand(text):
    words = WORD.findall(text or "")
    runs = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(covered),
    )


def test_line_counts(spark, docs, odd):
    for table in (docs, odd.filter("doc_id <> 4 AND length(text) < 1000000 OR text IS NULL")):
        texts = {r["doc_id"]: r["text"] for r in table.collect()}
        for r in line_rules.clean_lines(table).collect():
            n = counts_by_hand(texts[r["doc_id"]])
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == n
            assert r["base_failed"] == (n[0] < 10 or 100 * n[4] > 20 * n[0])
            assert not (r["kept"] and r["base_failed"])
            assert len(WORD.findall(r["clean_text"])) == n[0] - r["n_words_removed"]


def test_lines_that_fail(spark):
    good = "This is a plain sentence of ten words, no more."
    bad = "home | news | about | login\n" + "BUY NOW BUY NOW VERY CHEAP THINGS\n" + "a### b$$$ c%%% d&&&\nmenu"
    rows = spark.createDataFrame([(1, good), (2, good + "\n" + bad)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in line_rules.clean_lines(rows).collect()}
    assert found[1]["kept"] and found[2]["clean_text"] == good and found[2]["n_lines_removed"] == 4


# --- pieces -----------------------------------------------------------------

def test_pieces_round_trip_and_differ(spark, docs, odd):
    vocab = piece_sampling.read_model()
    for table in (docs, odd):
        texts = collections.defaultdict(set)
        for r in table.collect():
            texts[r["doc_id"]].add(r["text"] or "")
        encoded = piece_sampling.encode(table, vocab, k=3)
        seen = set()
        for r in piece_sampling.decode(encoded, vocab).collect():
            assert r["text"] in texts[r["doc_id"]] and 0 < r["inclusion"] <= 1 or r["log_prob"] < -600
            seen.add((r["doc_id"], r["sample"], tuple(r["ids"])))
        assert encoded.repartition(5).count() == encoded.count()
    again = {(r["doc_id"], r["sample"], tuple(r["ids"])) for r in encoded.collect()}
    assert again == seen


def test_long_texts_come_back_with_their_inclusion(spark, docs, odd):
    vocab, far = piece_sampling.read_model(), set()
    for table in (docs, odd):
        texts = collections.defaultdict(set)
        for r in table.collect():
            texts[r["doc_id"]].add(r["text"] or "")
        for r in piece_sampling.decode(piece_sampling.encode(table, vocab, k=3), vocab).collect():
            assert r["text"] in texts[r["doc_id"]] and r["log_inclusion"] <= 0
            assert abs(r["inclusion"] - np.exp(r["log_inclusion"])) < 1e-12
            if r["log_prob"] < -710:  # q is p / exp(threshold) there, the threshold near 0
                far.add(round(r["log_inclusion"], 6))
                assert abs(r["log_prob"] - r["log_inclusion"]) < 50
    assert len(far) > 4 and min(far) < -50_000


def test_op7_says_whether_texts_come_back(spark, docs, odd):
    rows = QUERIES["op7_piece_sampling"](spark, SF_DIR).select("doc_id", "sample", "round_trip").collect()
    assert all(r["round_trip"] for r in rows) and {r["sample"] for r in rows} == {0, 1, 2}
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    assert all(r["round_trip"] for r in piece_sampling.encode(odd, piece_sampling.read_model()).collect())
    wrong = piece_sampling.read_model()
    wrong.spelled = pa.array([x.replace(b"e", b"a") for x in wrong.raw], pa.large_binary())
    found = piece_sampling.encode(docs, wrong).select("doc_id", "round_trip").collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["round_trip"] == ("e" not in (texts[r["doc_id"]] or "")) for r in found)
    none = spark.createDataFrame([(1, None), (2, []), (3, [5])], "id int, ids array<int>")
    assert [r["text"] for r in piece_sampling.decode(none, wrong).orderBy("id").collect()][:2] == [None, ""]


def test_inclusion_far_from_the_threshold():
    apart = np.array([-5e5, -800.0, -41.0, -39.0, -1.0, 0.0, 3.0, 800.0])
    log = piece_sampling._log_inclusion(apart[None], np.zeros(len(apart)))[0]
    near = [np.log(-np.expm1(-np.exp(x))) for x in apart[3:7]]
    assert np.allclose(log, [*apart[:3], *near, 0.0], rtol=1e-6, atol=0)
    none = piece_sampling._log_inclusion(np.array([[-5.0, np.nan]]), np.full(2, -np.inf))[0]
    assert none[0] == 0 and np.isnan(none[1])


def _sampled(vocab, texts, k):
    keys = np.arange(1, len(texts) + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    piece = next(texts_of(pa.array(texts)))
    found = piece_sampling.sample_texts(vocab, vocab.alone(), piece, keys, k)
    return [*found.ids, *found.cuts, found.logp, found.value, found.log_inclusion]


def test_regions_are_worked_out_only_where_they_can_be_opened(monkeypatch):
    vocab, seen = piece_sampling.read_model(), []
    plain = piece_sampling._cut_gumbel

    def counted(where, most, noise):
        seen.append(len(where))
        return plain(where, most, noise)

    monkeypatch.setattr(piece_sampling, "_cut_gumbel", counted)
    found = _sampled(vocab, ["the cat sat on another mat and thought of nothing " * 400] * 3, 3)
    assert sum(seen) < 0.1 * sum(len(ids) for ids in found[:3])


def test_regions_left_out_change_no_sample(monkeypatch):
    vocab = piece_sampling.read_model()
    texts = [
        "the cat sat on another mat and thought of nothing " * 40,
        "", None, "a", " ", "\n" * 300 + "the end", "7" * 500 + " of it", "\u2581" * 90 + "cat",
        "\u4f60\u597d\u4e16\u754c" * 200 + "thinking", "\U0001f600" * 100, "\x00" * 200 + "tion",
    ]
    for k in (1, 3, 80):
        monkeypatch.setattr(piece_sampling, "_FIRST_EDGES", 1 << 14)
        whole = _sampled(vocab, texts, k)
        for first in (1, 7, 64):
            monkeypatch.setattr(piece_sampling, "_FIRST_EDGES", first)
            for a, b in zip(_sampled(vocab, texts, k), whole, strict=True):
                assert np.array_equal(a, b, equal_nan=True)


def test_draws_stay_between_0_and_1(monkeypatch):
    for bits in (0, (1 << 64) - 1):
        monkeypatch.setattr(piece_sampling, "mix", lambda x, salt=0: np.full(len(x), bits, np.uint64))
        drawn = piece_sampling._uniform(np.zeros(1, np.uint64), np.zeros(1, np.int64), 0)
        assert 0 < drawn[0] < 1


def test_samples_follow_the_lattice():
    vocab = piece_sampling.read_model()
    ids = {t.decode().replace(" ", "▁"): i for i, t in enumerate(vocab.raw) if i > 258}

    def paths(s):
        if not s:
            yield (), 0.0
        for n in range(1, len(s) + 1):
            if s[:n] in ids:
                for rest, w in paths(s[n:]):
                    yield (ids[s[:n]], *rest), w + vocab.weight[ids[s[:n]]]

    every = dict(paths("▁the▁cat"))
    norm = np.logaddexp.reduce(list(every.values()))
    n, first, total = 4000, collections.Counter(), 0.0
    keys = np.random.default_rng(1).integers(0, 1 << 63, n).astype(np.uint64)
    texts = next(texts_of(pa.array(["the cat"] * n)))
    found = piece_sampling.sample_texts(vocab, vocab.alone(), texts, keys, 2)
    for i in range(n):
        a, b = (tuple(found.ids[k][found.cuts[k][i] : found.cuts[k][i + 1]].tolist()) for k in (0, 1))
        assert a != b and abs(found.logp[0, i] - (every[a] - norm)) < 1e-6
        first[a] += 1
        total += sum(np.exp(found.logp[k, i]) / found.inclusion[k, i] for k in (0, 1))
    for path, count in first.items():
        assert abs(count / n - np.exp(every[path] - norm)) < 0.03
    assert abs(total / n - 1) < 0.03


# --- join -------------------------------------------------------------------

def classes_by_hand(texts):
    lower = {ord(c): c.lower() for c in string.ascii_uppercase}
    sets = {}
    for key, text in texts.items():
        w = WORD.findall((text or "").translate(lower))
        sets[key] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    parent = {k: k for k in texts}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    ra, rb = root(a), root(b)
                    parent[max(ra, rb)] = min(ra, rb)
    return {k: (len(sets[k]), root(k)) for k in keys}


def test_components_match_all_pairs(spark, docs):
    random = np.random.default_rng(5)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    words = [f"w{k}" for k in range(400)]
    base = list(random.choice(words, 150))
    for k in range(90):  # distant copies around the threshold
        copy = list(base)
        for at in random.integers(0, 150, int(random.integers(0, 12))):
            copy[at] = f"e{k}_{at}"
        texts[10_000 + k] = " ".join(copy)
    for k, n in enumerate((1, 2, 4, 5, 6, 8)):
        texts[20_000 + k] = texts[20_100 + k] = "Short " + " ".join(words[:n])
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    prepare(spark)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(rows).collect()}
    assert found == classes_by_hand(texts)


def test_exact_copies_end_before_the_shuffle(spark):
    prepare(spark)
    same = "the very same words stand in all of these texts"
    texts = spark.range(0, 6000, 1, 3).select(
        F.when(F.col("id") > 5, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 > 0, same).otherwise(F.concat(F.lit(same), F.col("id"))).alias("text"),
    )
    found = ngram_join.profiles(texts, np.zeros(0, np.uint64)).cache()
    assert found.count() == 6000
    carried = found.filter("bits IS NOT NULL AND first IS NOT NULL")
    assert carried.filter("doc_id IS NULL").count() == 0
    assert carried.count() == 3 + 2000 - 2
    assert ngram_join.near_duplicates(texts).groupBy("component_id").count().count() > 1


def test_repeated_rows_of_a_run_are_not_held():
    runs = np.repeat(np.arange(10), 1000)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(runs), pa.array(runs * 0 + 7), pa.array(runs.astype(np.int32))], names=["run", "node", "place"]
    )
    tracemalloc.start()
    copies = (pa.RecordBatch.from_arrays([pa.array(c.to_numpy().copy()) for c in batch.columns], names=["run", "node", "place"])
              for _ in range(1000))
    found = ngram_join._distinct(copies)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [x.tolist() for x in found] == [list(range(10)), [7] * 10, list(range(10))]
    assert peak < 50e6  # all rows are 200 MB


def test_bitmaps_never_rule_out_a_link():
    random = np.random.default_rng(2)
    for _ in range(200):
        n = int(random.integers(1, 300))
        a = np.unique(random.integers(0, 1 << 60, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[: int(len(a) * random.uniform(0.6, 1)) or 1],
                                      random.integers(0, 1 << 60, n // 5).astype(np.uint64))))
        if ngram_join.linked(a, b):
            assert ngram_join.overlap_possible(ngram_join.bitmap(a), len(a), ngram_join.bitmap(b), len(b))


# --- fingerprints -----------------------------------------------------------

def test_edits_and_neighbours(spark, docs):
    prepare(spark)
    texts = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    found = {r["doc_id"]: r for r in multiset_hash.fingerprints(docs).collect()}
    for at, (key, text) in enumerate(texts):
        after = texts[(at + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert found[key]["n_chars"] == len(text)
        assert found[key]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= found[key]["near_next"] <= 1
    assert np.mean([r["near_edited"] for r in found.values()]) > 0.3


def test_chunks_do_not_change_neighbours(spark, docs, monkeypatch):
    wide = sorted(map(tuple, multiset_hash.fingerprints(docs).collect()))
    monkeypatch.setattr(multiset_hash, "_ROWS_PER_CHUNK", 3)
    monkeypatch.setattr(multiset_hash, "_FAN", 4)
    assert sorted(map(tuple, multiset_hash.fingerprints(docs).collect())) == wide


def test_order_insert_and_delete(spark):
    rows = spark.createDataFrame([("a\nb\nc", "c\na\nb", "a\nb", "c")], "x string, y string, p string, q string")
    sums = {c: multiset_hash.summed(multiset_hash.paragraph_hashes(F.col(c))).alias(c) for c in "xypq"}
    held = rows.select(*sums.values())
    r = held.select(
        "x", "y", "p",
        multiset_hash.combine(F.col("p"), F.col("q")).alias("add"),
        multiset_hash.combine(F.col("x"), F.col("q"), -1).alias("less"),
    ).first()
    assert r["x"] == r["y"] == r["add"] and r["less"] == r["p"] != r["x"]


# --- training order ---------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_feistel_is_a_permutation(n):
    slots = training_order.feistel(np.arange(n), n)
    assert sorted(slots) == list(range(n))
    assert n < 100 or list(slots) != list(training_order.feistel(np.arange(n), n, key=1))


def test_shards_hold_every_sequence_once(spark, docs, odd, tmp_path):
    for k, table in enumerate((docs, odd)):
        path = f"{tmp_path}/shards{k}"
        training_order.write_shards(training_order.materialise(table, length=64, records=10), path)
        stored = spark.read.parquet(path).collect()
        n = sum(r["records"] for r in stored)
        assert all(len(r["payload"]) == r["records"] * 64 for r in stored)
        rows = training_order.read_from(spark, path, 0, n).collect()
        assert sorted(r["slot"] for r in rows) == list(range(n))
        if k == 0:
            texts = collections.defaultdict(dict)
            for r in rows:
                texts[r["doc_id"]][r["part"]] = bytes(r["tokens"])
            for r in docs.collect():
                own = texts[r["doc_id"]]
                raw = b"".join(own[p] for p in sorted(own)).rstrip(b"\xfe")
                assert raw == r["text"].encode() + b"\xff"
        part = training_order.read_from(spark, path, 15, 7).collect()
        assert sorted(r["slot"] for r in part) == list(range(15, min(22, n)))
