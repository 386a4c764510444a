"""License scans by conditional compression.

A cue word makes its surroundings a candidate, whatever the lines: for each
template, as many words on both sides as the template has, and a fifth more.
Each candidate is compressed alone and with each template as a raw zstandard
dictionary, and the templates are ranked by the bytes they save. In this order
they are aligned with the candidate, in the part that differs in the fewest
words, until no template is left that saves more than a confirmed one did (less
the ``NOISE_BYTES`` that the prose around it makes); one that saves nothing is
never aligned. No difference is ``exact``; some, up to a
fifth of the template's words, is ``variant``.

Of confirmed notices that overlap, the one whose own words save the most bytes
stays, each changed word counting for the ``CHANGE_BYTES`` it costs; so a line
may have several notices. Cues outside of all confirmed notices, at most two
lines apart, are one ``unknown`` row. ``reduction`` is what the row's words (those
of an unknown row with their windows) save, to the template's own compressed
size, ``rank`` the template's place by bytes saved at the cue, and ``runner_up``
the best other template.

Null and empty texts, and texts without a cue, give no rows. Other columns of
the documents play no part. Rows with one id are scanned each for themselves.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import LOWER, Texts, batch_of, find_all, map_arrow, texts_of
from repotide.llm.license_texts import TEXTS

LEVEL, MOST_DIFFERENT, CHANGE_BYTES = 6, 0.2, 3
#: What the prose of a window may move its bytes.
NOISE_BYTES = 12
# Cue words, lower case; lines and marks may part them.
CUES = (
    "all rights reserved",
    "copyright",
    "hereby granted",
    "licence",
    "license",
    "permission is hereby",
    "public domain",
    "redistribut",
    "spdx-",
    "warranty",
)
# Short notices of public licenses, with whole texts and headers.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this"
        " file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed"
        " to in writing, software distributed under the License is distributed on an \"AS IS\""
        " BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction, including without limitation the rights to use, copy, modify,"
        " merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "all-rights-reserved": "All rights reserved.",
} | TEXTS
#: One changed word, beside the place where an alignment begins.
_CHANGE = 1 << 32
_CUES = [re.compile(r"[\W_]+".join(map(re.escape, cue.split()))) for cue in CUES]
_WORDS = re.compile(r"[^\W_]+(?:[.\-'/][^\W_]+)*")


@cache
def _compressors(templates: tuple[tuple[str, str], ...]):
    plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    with_template = {
        name: zstandard.ZstdCompressor(
            level=LEVEL,
            write_content_size=False,
            dict_data=zstandard.ZstdCompressionDict(
                text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
            ),
        )
        for name, text in templates
    }
    words = {name: _WORDS.findall(text.lower()) for name, text in templates}
    own_size = {name: len(plain.compress(text.lower().encode())) for name, text in templates}
    return plain, with_template, words, own_size


def differences(template: list[str], block: list[str]) -> list[str]:
    """The fewest changes of words that make the template the block, side by side ones as one."""
    m, n = len(template), len(block)
    own = np.array(block, object)
    along, costs = np.arange(n + 1), [np.arange(n + 1)]
    for word in template:
        step = costs[-1] + 1
        step[1:] = np.minimum(step[1:], costs[-1][:-1] + (own != word))
        costs.append(np.minimum.accumulate(step - along) + along)
    steps, i, j = [], m, n
    while i or j:
        here = costs[i][j]
        if i and j and here == costs[i - 1][j - 1] + (template[i - 1] != block[j - 1]):
            i, j = i - 1, j - 1
            steps.append((i, j, template[i : i + 1], block[j : j + 1]))
        elif i and here == costs[i - 1][j] + 1:
            i -= 1
            steps.append((i, j, template[i : i + 1], []))
        else:
            j -= 1
            steps.append((i, j, [], block[j : j + 1]))
    unlike, open_ = [], False
    for _, _, old, new in reversed(steps):
        if old == new:
            open_ = False
            continue
        if not open_:
            unlike.append(([], []))
        open_ = True
        unlike[-1][0].extend(old)
        unlike[-1][1].extend(new)
    return [f"{' '.join(old)} -> {' '.join(new)}" for old, new in unlike]


def occurrences(template: np.ndarray, words: np.ndarray, most: int) -> list[tuple[int, int, int]]:
    """(changed, begin, end) of places that are the template but for ``most`` words at most.

    Every end has its cheapest begin (the first of equals), in one pass over the template's
    words; ends are taken in order of their changes, the last of equals beside each other first.
    """
    begin = np.arange(len(words) + 1)
    along, row = begin * _CHANGE, begin
    for word in template:
        step = row + _CHANGE
        step[1:] = np.minimum(step[1:], row[:-1] + (words != word) * _CHANGE)
        row = np.minimum.accumulate(step - along) + along
    changed, begin = row // _CHANGE, row % _CHANGE
    ends = np.flatnonzero(changed <= most)
    found: list[tuple[int, int, int]] = []
    free = np.ones(len(words), bool)
    for end in ends[np.lexsort((-ends, changed[ends]))].tolist():
        first = int(begin[end])
        if first < end and free[first:end].all():
            free[first:end] = False
            found.append((int(changed[end]), first, end))
    return found


class Notice(NamedTuple):
    """A confirmed notice, or a place with cues that no template explains."""

    first: int  # offsets in the text
    end: int
    license: str | None
    verdict: str
    reduction: float
    rank: int | None
    runner_up: str | None
    differences: list[str]


def scan_text(text: str, templates: dict[str, str] = TEMPLATES) -> list[Notice]:
    """The notices of a lower-case text, and its cues outside of them, from first to last."""
    cues = sorted({m.start() for cue in _CUES for m in cue.finditer(text)})
    if not cues or not templates:
        return [Notice(at, at, None, "unknown", 0.0, None, None, []) for at in cues[:1]]
    plain, with_template, words, own_size = _compressors(tuple(templates.items()))
    spans = [m.span() for m in _WORDS.finditer(text)]
    begins = [a for a, _ in spans]
    hits = sorted({bisect_right(begins, at) - 1 for at in cues})
    tokens = [text[a:b] for a, b in spans]
    numbers: dict[str, int] = {}
    ids = np.array([numbers.setdefault(t, len(numbers)) for t in tokens], np.int64)
    numbered = {n: np.array([numbers.get(w, -1) for w in own]) for n, own in words.items()}
    reach = {n: len(own) + int(MOST_DIFFERENT * len(own)) for n, own in words.items()}
    alone: dict[bytes, int] = {}
    known: dict[tuple[bytes, str], int] = {}

    def saved(first: int, end: int, name: str) -> int:
        """Bytes that the words from ``first`` to ``end`` save with the template."""
        raw = text[spans[max(first, 0)][0] : spans[min(end, len(spans)) - 1][1]].encode()
        if (raw, name) not in known:
            if raw not in alone:
                alone[raw] = len(plain.compress(raw))
            known[raw, name] = alone[raw] - len(with_template[name].compress(raw))
        return known[raw, name]

    def window(hit: int, name: str) -> tuple[int, int]:
        return max(hit - reach[name], 0), min(hit + reach[name] + 1, len(spans))

    def ranked_at(hit: int) -> list[tuple[int, str]]:
        return sorted((-saved(*window(hit, n), n), n) for n in words)

    found: dict[tuple[int, int, str], tuple[int, int]] = {}
    present = np.zeros(len(numbers) + 1, bool)
    for hit in hits:
        best = 0  # what a confirmed notice with this cue saves
        for rank, (less, name) in enumerate(ranked_at(hit), 1):
            if -less <= max(0, best - NOISE_BYTES):
                break
            a, b = window(hit, name)
            most = int(MOST_DIFFERENT * len(words[name]))
            present[ids[a:b]] = True
            likely = present[numbered[name]].sum() >= len(numbered[name]) - most
            present[ids[a:b]] = False
            if not likely:
                continue
            for changed, first, end in occurrences(numbered[name], ids[a:b], most):
                first, end = a + first, a + end
                worth = saved(first, end, name) - CHANGE_BYTES * changed
                if worth > 0 and rank < found.get((first, end, name), (0, rank + 1))[1]:
                    found[first, end, name] = worth, rank
                    if first <= hit < end:
                        best = max(best, worth)
    free = np.ones(len(spans), bool)
    notices = []

    def note(first: int, end: int, name: str | None, rank: int | None = None) -> Notice:
        wide = {n: 0 if name else r for n, r in reach.items()}
        gains = {n: saved(first - r, end + r, n) for n, r in wide.items()}
        ranked = sorted(gains, key=lambda n: (-gains[n], n))
        unlike = differences(words[name], tokens[first:end]) if name else []
        verdict = ("variant" if unlike else "exact") if name else "unknown"
        nearest = name or ranked[0]
        others = [n for n in ranked if n != nearest]
        return Notice(
            spans[first][0], spans[end - 1][1], name, verdict, gains[nearest] / own_size[nearest], rank,
            others[0] if others else None, unlike,
        )

    for (first, end, name), (worth, rank) in sorted(found.items(), key=lambda f: (-f[1][0], f[0])):
        if free[first:end].all():
            free[first:end] = False
            notices.append((first, end, name, rank))
    bounds = sorted((first, end) for first, end, *_ in notices)
    firsts = [first for first, _ in bounds]
    group: list[int] = []
    for hit in hits:
        before = bisect_right(firsts, hit)
        if before and hit < bounds[before - 1][1]:
            continue
        if (
            group
            and text.count("\n", spans[group[1] - 1][0], spans[hit][0]) <= 2
            and bisect_right(firsts, group[0]) == before
        ):
            group[1] = hit + 1
            continue
        if group:
            notices.append((*group, None))
        group = [hit, hit + 1]
    if group:
        notices.append((*group, None))
    return [note(*n) for n in sorted(notices, key=lambda n: n[:2])]


def scan_block(block: bytes, templates: dict[str, str] = TEMPLATES) -> tuple:
    """license, verdict, reduction, rank, runner-up and differences of the block's longest notice."""
    found = scan_text(block.decode(errors="replace").lower(), templates)
    if not found:
        return None, "unknown", 0.0, None, None, []
    return max(found, key=lambda n: (n.license is not None, n.end - n.first))[2:]


def with_cues(texts: Texts) -> list[int]:
    """The texts that hold the longest word of a cue."""
    raw = LOWER[texts.data].tobytes()
    marks = {max(cue.split(), key=len).encode() for cue in CUES}
    hits = sorted({at for mark in marks for at in find_all(raw, mark)})
    owner = np.searchsorted(texts.starts, hits, side="right") - 1
    return np.unique(owner).tolist()


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per notice of any document, and per place with cues but no known notice."""

    def run(batch):
        rows = []
        for texts in texts_of(batch.column(1)):
            for at in with_cues(texts):
                raw = texts.data[texts.starts[at] : texts.starts[at + 1]].tobytes()
                text = raw.decode(errors="replace").lower()
                line, seen = 0, 0
                for found in scan_text(text, templates):
                    line, seen = line + text.count("\n", seen, found.first), found.first
                    last = line + text.count("\n", found.first, found.end)
                    rows.append((texts.first + at, line, last, *found[2:]))
        columns = list(zip(*rows)) if rows else [()] * 9
        return batch_of(
            doc_id=batch.column(0).take(pa.array(columns[0], pa.int64())),
            first_line=pa.array(columns[1], pa.int64()),
            last_line=pa.array(columns[2], pa.int64()),
            license=pa.array(columns[3], pa.string()),
            verdict=pa.array(columns[4], pa.string()),
            reduction=pa.array(columns[5], pa.float64()),
            rank=pa.array(columns[6], pa.int32()),
            runner_up=pa.array(columns[7], pa.string()),
            differences=pa.array(columns[8], pa.list_(pa.string())),
        )

    return map_arrow(
        docs.select(F.col("doc_id").cast("long"), "text"),
        run,
        "doc_id long, first_line long, last_line long, license string, verdict string,"
        " reduction double, rank int, runner_up string, differences array<string>",
    )
