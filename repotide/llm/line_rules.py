"""Quality rules, line by line first.

Every line with a word is judged on its own: marks instead of words, rows of
menu separators, shouting, one word over and over, boilerplate phrases, and
fragments without any punctuation. Failing lines are removed. A text that
loses more than half of its words is rejected, and so is one that fails the
base rules (under ``MIN_WORDS`` words, or too many words in repeated runs).

All counts come from the bytes of many texts at once in numpy; word and line
equality is by 64-bit hashes. Null and empty texts have no words and fail.
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
    find_all,
    flat,
    map_arrow,
    mix,
    texts_of,
    windows,
    words_in,
)

MIN_WORDS, REPEATED_PERCENT, LOST_PERCENT, RUN = 10, 20, 50, 5
SYMBOLS = "#*$%&|<>"
# Phrases of page furniture, lower case.
BOILERPLATE = (
    "accept cookies",
    "all rights reserved",
    "back to top",
    "click here",
    "cookie policy",
    "enable javascript",
    "forgot your password",
    "log in to",
    "lorem ipsum",
    "privacy policy",
    "read more",
    "share on facebook",
    "sign up for",
    "skip to content",
    "subscribe to our",
    "terms of service",
    "terms of use",
)
RULES = ("symbols", "navigation", "shouting", "repetition", "boilerplate", "fragment")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".!?,;:")] = True


def _sum(flags: np.ndarray) -> np.ndarray:
    """Running count, so that a range's count is one difference."""
    return np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))


def judge(texts: Texts) -> dict[str, np.ndarray]:
    """Counts per text, and per line (``line_*``) its range, text and broken rules."""
    n, data = texts.count, texts.data
    start, end, owner = words_in(texts)
    spans = Spans(data)
    hashes = spans.hashes(start, end)
    out = {"n_words": np.bincount(owner, minlength=n)}

    points = _sum((data & 0xC0) != 0x80)
    out["word_chars"] = _per(owner, points[end] - points[start], n)
    symbols = _sum(_SYMBOL[data])
    out["n_symbols"] = symbols[texts.starts[1:]] - symbols[texts.starts[:-1]]

    place, run = windows(hashes, owner, RUN)
    again = _repeats(run, owner[place])
    cover = np.zeros(len(start) + 1, np.int64)
    cover[place[again]] += 1
    stops = place[again] + RUN
    cover[stops] -= 1
    repeated = np.cumsum(cover[:-1]) > 0
    out["n_repeat_words"] = np.bincount(owner[repeated], minlength=n)

    # lines: from a text's start or after a \n, up to the next \n or text's end
    breaks = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate((texts.starts[:-1], breaks + 1)))
    line_end = np.sort(np.concatenate((texts.starts[1:], breaks)))
    line_text = np.searchsorted(texts.starts, line_start, side="right") - 1
    # a \n that ends a text leaves an empty line before the next text's start
    line_text = np.minimum(line_text, n - 1)
    words = _sum(np.bincount(start, minlength=len(data))[: len(data)] if len(start) else np.zeros(len(data), int))
    line_words = words[line_end] - words[np.minimum(line_start, len(data))]
    full = line_words > 0
    line_start, line_end = line_start[full], line_end[full]
    line_text, line_words = line_text[full], line_words[full]

    line_hash = spans.hashes(line_start, line_end)
    key = mix(line_hash ^ mix(line_text.astype(np.uint64), 7))
    _, first = np.unique(key, return_index=True)
    later = np.ones(len(key), bool)
    later[first] = False
    out["n_dup_lines"] = np.bincount(line_text[later], minlength=n)

    def count(flags):
        total = _sum(flags)
        return total[line_end] - total[line_start]

    n_symbols, bars = count(_SYMBOL[data]), count(data == ord("|"))
    letters, upper = count(_LETTER[data]), count(_UPPER[data])
    word_line = np.searchsorted(line_start, start, side="right") - 1
    pairs = np.flatnonzero((word_line[1:] == word_line[:-1]) & (hashes[1:] == hashes[:-1]))
    doubled = np.bincount(word_line[pairs], minlength=len(line_start))
    phrase = np.zeros(len(line_start), bool)
    low = LOWER[data].tobytes()
    for words_of in BOILERPLATE:
        for at in find_all(low, words_of.encode()):
            line = np.searchsorted(line_start, at, side="right") - 1
            if line >= 0 and at + len(words_of) <= line_end[line]:
                phrase[line] = True
    broken = np.stack(
        [
            (n_symbols - bars) * 4 > line_words,
            bars * 5 > line_words * 2,
            (upper * 10 > letters * 7) & (letters > 20),
            (doubled * 3 > line_words) & (line_words >= 6),
            phrase & (line_words <= 30),
            (line_words < 4) & (count(_MARK[data]) == 0),
        ],
        1,
    ).reshape(-1, len(RULES))
    fails = broken.any(1)
    out["n_lines"] = np.bincount(line_text, minlength=n)
    out["n_lines_removed"] = np.bincount(line_text[fails], minlength=n)
    out["n_words_removed"] = _per(line_text[fails], line_words[fails], n)
    few = out["n_words"] < MIN_WORDS
    out["base_failed"] = few | (100 * out["n_repeat_words"] > REPEATED_PERCENT * out["n_words"])
    lost = 100 * out["n_words_removed"] > LOST_PERCENT * out["n_words"]
    out["kept"] = ~out["base_failed"] & ~lost
    out |= {"line_start": line_start, "line_end": line_end, "line_text": line_text, "line_broken": broken}
    return out


def _per(owner: np.ndarray, amount: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=amount, minlength=n).astype(np.int64)


def _repeats(run: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which runs occur more than once in their text."""
    key = mix(run ^ mix(owner.astype(np.uint64), 3))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return again


COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_lines_removed", "n_words_removed",
)


def clean_lines(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """doc_id, the counts, base_failed, kept and (if wanted) the text without the
    failing lines, for every row of ``docs``."""

    def run(batch):
        parts, kept_text = [], []
        for texts in texts_of(batch.column(1)):
            found = judge(texts)
            parts.append(found)
            if with_text:
                kept_text += _joined(texts, found)
        columns = {"doc_id": batch.column(0)}
        columns |= {k: flat([p[k] for p in parts], np.int64) for k in COUNTS}
        columns |= {k: flat([p[k] for p in parts], bool) for k in ("base_failed", "kept")}
        if with_text:
            columns["clean_text"] = pa.array(kept_text, pa.string())
        return batch_of(**columns)

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    schema += ", base_failed boolean, kept boolean" + ", clean_text string" * with_text
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


def _joined(texts: Texts, found: dict) -> list[str]:
    lines: list[list[bytes]] = [[] for _ in range(texts.count)]
    raw = texts.data.tobytes()
    fails = found["line_broken"].any(1)
    for s, e, t in zip(
        found["line_start"][~fails], found["line_end"][~fails], found["line_text"][~fails]
    ):
        lines[t].append(raw[s:e])
    return [b"\n".join(x).decode() for x in lines]
