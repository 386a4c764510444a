"""SentencePiece encoding and decoding: distinct segmentations by Gumbel top-k.

A text's segmentations into pieces form a lattice whose paths have the
probability of their pieces' weights, normalised exactly by backward sums. The
first ``k`` paths by Gumbel-perturbed log-probability are a sample without
replacement. They are found without listing paths, by A* over regions of the
lattice: a region is a prefix plus the edges already used after it, its best
perturbed value is known before it is opened, and the region with the largest
value is opened next. Opening one draws its best path edge by edge; every edge
not taken leaves a region whose value is a Gumbel variable cut at the path's
own. The first region left unopened gives the threshold from which each
sample's inclusion probability q follows; the weight p/q of a sample makes sums
over samples unbiased. q comes as ``log_inclusion`` too, so the weight is
exp(log_prob - log_inclusion) for texts of any length; ``inclusion`` itself is 0
where it is below the smallest double, as it is for texts of some hundred words.

No piece goes on after a space mark that follows other characters, and
characters that no longer piece contains stand alone, so the lattice of a text
is a chain of lattices of short chunks. Equal chunks of a batch share one
lattice; paths are drawn for all chunks of a batch at once in numpy. Draws are
hashes of (row key, sample, place), so a row's samples depend on nothing else.

Weights: a unigram model's scores are log-probabilities and are taken as they
are; a BPE model's scores are merge ranks, and a piece of rank r weighs
-log(r + ``RANK_SHIFT``). Characters without a piece fall back to byte pieces.
Spaces become the mark U+2581 and the text gets one in front; a U+2581 that is
in the text already goes through byte pieces, so decoding returns every text
exactly. Null and empty texts have one segmentation, without pieces. A text
with fewer than ``k`` segmentations gives all of them, each included with
certainty. Rows with the same key and text get the same samples.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import Spans, Texts, batch_of, map_arrow, mix, texts_of, tidy

MODEL, SAMPLES, SEED = "/opt/tokenizers/piece_bpe_32k.model", 3, 97
RANK_SHIFT = 10.0
MARK = 0x2581
#: Stands for a mark that the text itself holds; no code point has this number.
_OWN_MARK = 0x110000
_SLOTS = 1 << 18
_PIECE = 1 << 20
#: Shares and log-probabilities are added up as integers, so that a text's sums do not
#: depend on the texts beside it.
_SHARE, _LOG = float(1 << 53), float(1 << 36)
#: Edges of a path that tell how large a draw must be to matter further on.
_FIRST_EDGES = 64
#: More than rounding can add to a region's value.
_MARGIN = 1e-3


class Vocabulary:
    """Pieces, their weights and their trie as hashed (node, character) steps."""

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: list[int], bpe: bool) -> None:
        """``pieces`` has an empty text for ids that are no ordinary piece."""
        texts = [t for t, _ in pieces]
        scores = np.array([s for _, s in pieces])
        real = np.array([bool(t) for t in texts])
        self.weight = scores.copy()
        if bpe:
            rank = np.zeros(len(pieces))
            rank[np.flatnonzero(real)[np.argsort(-scores[real], kind="stable")]] = np.arange(
                real.sum()
            )
            self.weight = -np.log(rank + RANK_SHIFT)
        self.byte_weight = float(self.weight[real].min()) - 1.0 if real.any() else -10.0
        self.byte_ids = np.array(byte_ids, np.int32)
        self.raw = [t.replace("▁", " ").encode() for t in texts]
        for byte, at in enumerate(byte_ids):
            self.raw[at] = bytes([byte])
        self.spelled = pa.array(self.raw, pa.large_binary())
        nodes: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        joined = set()
        self.longest = 1
        for at, text in enumerate(texts):
            if not text:
                continue
            if "▁" in text.lstrip("▁"):
                raise ValueError("pieces that span words are not supported")
            node = 0
            for char in map(ord, text):
                node = nodes.setdefault((node, char), len(nodes) + 1)
            ends.setdefault(node, at)
            self.longest = max(self.longest, len(text))
            if len(text) > 1:
                joined.update(map(ord, text))
        self.end = np.full(len(nodes) + 1, -1, np.int32)
        self.end[list(ends)] = list(ends.values())
        self.joins = np.array(sorted(joined), np.int64)
        self.keys, self.steps = _hashed(
            np.array([n << 21 | c for n, c in nodes], np.int64), np.array(list(nodes.values()))
        )

        self.root = np.full(_OWN_MARK + 1, -1, np.int32)
        for (node, char), child in nodes.items():
            if not node:
                self.root[char] = child

    def alone(self) -> np.ndarray:
        """Whether a code point stands apart from its neighbours."""
        table = np.ones(_OWN_MARK + 1, bool)
        table[self.joins] = False
        return table

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The trie node after one more character, or -1."""
        key = node.astype(np.int64) << 21 | char
        slot = _slot(key)
        there = self.keys[slot]
        out = np.where(there == key, self.steps[slot], -1)
        open_ = np.flatnonzero((there != key) & (there >= 0))
        key, slot = key[open_], slot[open_]
        while len(open_):
            slot = (slot + 1) & (len(self.keys) - 1)
            there = self.keys[slot]
            hit = there == key
            out[open_[hit]] = self.steps[slot[hit]]
            more = np.flatnonzero(~hit & (there >= 0))
            open_, key, slot = open_[more], key[more], slot[more]
        return out


def _slot(key: np.ndarray) -> np.ndarray:
    return (mix(key.view(np.uint64)) & np.uint64(_SLOTS - 1)).astype(np.int64)


def _hashed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(keys) > _SLOTS // 2:
        raise ValueError("too many pieces")
    table, held = np.full(_SLOTS, -1, np.int64), np.zeros(_SLOTS, np.int32)
    for key, value, slot in zip(keys.tolist(), values.tolist(), _slot(keys).tolist()):
        while table[slot] >= 0:
            slot = (slot + 1) & (_SLOTS - 1)
        table[slot], held[slot] = key, value
    return table, held


def read_model(path: str = MODEL) -> Vocabulary:
    """Pieces of a SentencePiece model; only the driver reads the file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids = [], [0] * 256
    for at in range(model.get_piece_size()):
        if model.is_byte(at):
            byte_ids[int(model.id_to_piece(at)[3:5], 16)] = at
        odd = model.is_byte(at) or model.is_control(at) or model.is_unknown(at) or model.is_unused(at)
        pieces.append(("" if odd else model.id_to_piece(at), model.get_score(at)))
    scores = np.array([s for t, s in pieces if t])
    return Vocabulary(pieces, byte_ids, bool(len(scores)) and bool((scores == np.round(scores)).all()))


class Lattices(NamedTuple):
    """Lattices of all distinct chunks of a batch; states are numbered through."""

    begin: np.ndarray  # first state of each chunk
    first: np.ndarray  # first edge of each state, -1 where a chunk ends
    many: np.ndarray  # number of each state's edges
    length: np.ndarray  # characters of each edge
    piece: np.ndarray  # -1: byte pieces
    logp: np.ndarray
    share: np.ndarray  # probability in 2^-53; 2 for a state's last edge, which takes what is left
    lone: np.ndarray  # whether an edge is its state's only one

    def rest(self, edges: np.ndarray) -> np.ndarray:
        """For each of ``edges``, the log-probability of its state's other edges."""
        with np.errstate(divide="ignore"):
            other = np.log(np.maximum(-np.expm1(self.logp[edges]), 1e-300))
        return np.where(self.lone[edges], -np.inf, other)


def lattices(vocab: Vocabulary, chars: np.ndarray, sizes: np.ndarray, wide: np.ndarray) -> Lattices:
    """``chars`` are the chunks' characters end to end, ``wide`` their UTF-8 lengths.

    A chunk of n characters has n + 1 states.
    """
    chunks = len(sizes)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(chunks), sizes)
    state = np.arange(len(chars)) + owner
    left = ends[owner] - np.arange(len(chars))
    starts, stops, pieces = [], [], []
    at = np.arange(len(chars))
    node = vocab.root[chars]
    for length in range(1, vocab.longest + 1):
        live = node >= 0
        at, node = at[live], node[live]
        piece = vocab.end[node]
        has = piece >= 0
        if length == 1:
            single = np.zeros(len(chars), bool)
            single[at[has]] = True
            bare = np.flatnonzero(~single)
            starts.append(bare)
            stops.append(np.ones(len(bare), np.int64))
            pieces.append(np.full(len(bare), -1, np.int32))
        starts.append(at[has])
        stops.append(np.full(int(has.sum()), length))
        pieces.append(piece[has])
        more = left[at] > length
        at, node = at[more], node[more]
        if not len(at):
            break
        node = vocab.step(node, chars[at + length])
    # Backward sums take all states at one distance from their chunk's end at a
    # time, so edges are laid out by that distance; every state has one at least.
    short = left.astype(np.uint16) if len(left) and left.max() < 1 << 16 else left
    ordered = np.argsort(short, kind="stable")
    edges = np.zeros(len(chars), np.int64)
    for part in starts:
        edges[part] += 1
    bounds = np.concatenate(([0], np.cumsum(edges[ordered])))
    heads = bounds[:-1]
    slot = np.empty(len(chars), np.int64)
    slot[ordered] = heads
    start = np.repeat(ordered, edges[ordered])
    length, piece = np.empty(len(start), np.int32), np.empty(len(start), np.int32)
    for part, stop, found in zip(starts, stops, pieces):
        own = slot[part]
        length[own], piece[own] = stop, found
        slot[part] += 1
    bare = np.flatnonzero(piece < 0)
    weight = vocab.weight[piece]
    weight[bare] = vocab.byte_weight * wide[start[bare]]
    to = state[start] + length
    origin, many = state[ordered], edges[ordered]
    total = np.zeros(len(chars) + chunks)
    logp = np.empty(len(start))
    far = left[ordered]
    levels = np.concatenate(([0], np.flatnonzero(np.diff(far)) + 1, [len(heads)]))
    for a, b in zip(levels[:-1].tolist(), levels[1:].tolist()):
        lo, hi = bounds[a], bounds[b]
        x = weight[lo:hi] + total[to[lo:hi]]
        seg = heads[a:b] - lo
        most = np.maximum.reduceat(x, seg)
        each = np.repeat(most, many[a:b])
        all_ = most + np.log(np.add.reduceat(np.exp(x - each), seg))
        total[origin[a:b]] = all_
        logp[lo:hi] = x - np.repeat(all_, many[a:b])
    last = np.zeros(len(start), bool)
    last[bounds[1:] - 1] = True
    drawn = np.flatnonzero(~last)
    share = np.full(len(start), 1 << 54)
    share[drawn] = np.exp(logp[drawn]) * _SHARE
    first = np.full(len(chars) + chunks, -1, np.int64)
    first[origin] = heads
    count = np.zeros(len(chars) + chunks, np.int64)
    count[origin] = many
    lone = np.zeros(len(start), bool)
    lone[heads[many == 1]] = True
    return Lattices(
        ends - sizes + np.arange(chunks), first, count, length, piece, logp, share, lone
    )


def _placed(place: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return place.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)


def _drawn(key: np.ndarray, place: np.ndarray, salt: int) -> np.ndarray:
    """53 random bits."""
    with np.errstate(over="ignore"):
        bits = mix(key + _placed(place), salt)
    return (bits >> np.uint64(11)).view(np.int64)


def _uniform(key: np.ndarray, place: np.ndarray, salt: int) -> np.ndarray:
    """A number between 0 and 1, both left out."""
    drawn = (_drawn(key, place, salt).astype(np.float64) + 0.5) / float(1 << 53)
    return np.minimum(drawn, 1 - 2.0**-53)


def _spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, end to end."""
    return np.repeat(start - (np.cumsum(length) - length), length) + np.arange(length.sum())


class Beside(NamedTuple):
    """A path, and the best of what is left beside those of its edges where that matters."""

    at: np.ndarray  # places of all edges
    taken: np.ndarray
    cut: np.ndarray  # where each text's begin
    here: np.ndarray  # the edges that matter, as numbers along the path
    row: np.ndarray
    before: np.ndarray  # log-probability of the path up to the edge
    first: np.ndarray  # where each text's edges that matter begin
    value: np.ndarray  # largest perturbed value; -inf: nothing is left


class _Batch:
    """The texts of a batch as chunks, and paths through all of them."""

    def __init__(self, vocab: Vocabulary, alone: np.ndarray, texts: Texts, keys: np.ndarray) -> None:
        self.vocab = vocab
        data = texts.data
        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        bounds = points[texts.starts]
        chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        chars[chars == MARK] = _OWN_MARK
        chars[chars == 32] = MARK
        some = np.flatnonzero(np.diff(bounds))
        chars = np.insert(chars, bounds[some], MARK)
        full = (np.diff(bounds) > 0).astype(np.int64)
        self.starts = bounds + np.concatenate(([0], np.cumsum(full)))
        self.chars, self.count = chars, texts.count
        opens = np.zeros(len(chars) + 1, bool)
        opens[self.starts] = True
        apart = alone[chars]
        opens[:-1] |= apart
        opens[1:] |= apart
        opens[1:-1] |= (chars[1:] == MARK) & (chars[:-1] != MARK)
        opens[len(chars)] = True
        self.chunk = np.flatnonzero(opens[: len(chars)])
        sizes = np.diff(np.concatenate((self.chunk, [len(chars)])))
        wide = np.ones(len(chars), np.int64)
        for least in (0x80, 0x800, 0x10000):
            wide += chars >= least
        wide[chars == _OWN_MARK] = 3
        self.wide = wide
        hashes = Spans(chars).hashes(self.chunk, self.chunk + sizes)
        # kinds are numbered as they first occur, so that frequent ones lie together
        self.kind = pa.array(hashes).dictionary_encode().indices.to_numpy().astype(np.int64)
        example = np.zeros(self.kind.max(initial=-1) + 1, np.int64)
        example[self.kind[::-1]] = np.arange(len(self.kind))[::-1]
        own = sizes[example]
        where = _spans(self.chunk[example], own)
        self.net = lattices(vocab, chars[where], own, wide[where])
        self.origin = self.net.begin[self.kind]
        self.row = np.searchsorted(self.starts, self.chunk, side="right") - 1
        with np.errstate(over="ignore"):
            self.keys = keys - _placed(self.starts[:-1])  # so that draws go by the place in the text

    def draw(self, edges: np.ndarray, place: np.ndarray, state: np.ndarray, row: np.ndarray, salt: int):
        """Follow each (place, state) to its chunk's end by drawn edges, into ``edges``."""
        net = self.net
        edge, key = net.first[state], self.keys[row]
        while True:
            live = np.flatnonzero(edge >= 0)
            if not len(live):
                break
            place, state, key, edge = place[live], state[live], key[live], edge[live]
            over = _drawn(key, place, salt) - net.share[edge]
            open_ = np.flatnonzero(over >= 0)
            over, next_ = over[open_], edge[open_]
            while len(open_):
                next_ += 1
                edge[open_] = next_
                over -= net.share[next_]
                more = np.flatnonzero(over >= 0)
                open_, over, next_ = open_[more], over[more], next_[more]
            edges[place] = edge
            length = net.length[edge]
            place, state = place + length, state + length
            edge = net.first[state]

    def path(self, edges: np.ndarray):
        """Places of the pieces, their edges, log-probabilities summed up, and where texts begin."""
        at = np.flatnonzero(edges >= 0)
        cut = np.searchsorted(at, self.starts)
        taken = edges[at]
        run = np.zeros(len(at) + 1, np.int64)
        with np.errstate(over="ignore"):
            np.cumsum(np.rint(self.net.logp[taken] * _LOG).astype(np.int64), out=run[1:])
        return at, taken, run, cut

    def regions(self, at, taken, run, cut, value, branch, salt: int, wanted: int) -> Beside:
        """What is left beside a path's edges after ``branch``, as far as it can be wanted.

        A value is at most its Gumbel variable above the log-probability up to its edge, which
        only falls along the path. So the ``wanted`` largest values of a text's first edges
        tell from which draw on a later edge's value can be larger; the rest is not worked out.
        """

        def beside(here, row):
            with np.errstate(over="ignore"):
                before = (run[here] - run[cut[row]]) / _LOG
            noise = -np.log(_uniform(self.keys[row], at[here], salt))
            most = _cut_gumbel(before + self.net.rest(taken[here]), value[row], noise)
            return before, np.where(at[here] > branch[row], most, -np.inf)

        size, width = np.diff(cut), max(_FIRST_EDGES, wanted)
        ahead = np.minimum(size, width)
        here, row = _spans(cut[:-1], ahead), np.repeat(np.arange(self.count), ahead)
        before, found = beside(here, row)
        grid = np.full((self.count, width), -np.inf)
        grid[row, here - cut[row]] = found
        least = np.partition(grid, width - wanted, axis=1)[:, width - wanted]
        with np.errstate(over="ignore"):
            above = least - (run[cut[:-1] + ahead] - run[cut[:-1]]) / _LOG - _MARGIN
            draw = (np.exp(-np.exp(-above)) * _SHARE).astype(np.int64) - 4  # 4: for rounding
        later = _drawn(np.repeat(self.keys, size), at, salt) >= np.repeat(draw, size)
        later[here] = False
        later = np.flatnonzero(later)
        if len(later):
            owner = np.searchsorted(cut, later, side="right") - 1
            more = beside(later, owner)
            order = np.argsort(np.concatenate((here, later)), kind="stable")
            here, row, before, found = (
                np.concatenate(pair)[order]
                for pair in ((here, later), (row, owner), (before, more[0]), (found, more[1]))
            )
        return Beside(at, taken, cut, here, row, before, np.searchsorted(here, cut), found)

    def state(self, at: np.ndarray) -> np.ndarray:
        index = np.searchsorted(self.chunk, at, side="right") - 1
        return self.origin[index] + at - self.chunk[index]


def _cut_gumbel(where, most, noise):
    """A Gumbel variable at ``where``, given that it stays below ``most``."""
    with np.errstate(invalid="ignore", over="ignore"):
        return where - np.log(noise + np.exp(np.minimum(where - most, 700)))


class Sample(NamedTuple):
    ids: list[np.ndarray]  # per sample: pieces of all texts end to end
    cuts: list[np.ndarray]
    logp: np.ndarray  # samples x texts; nan: no such sample
    value: np.ndarray
    log_inclusion: np.ndarray

    @property
    def inclusion(self) -> np.ndarray:
        """The probabilities themselves; 0 where they are below the smallest double."""
        return np.exp(self.log_inclusion)


def _log_inclusion(logp: np.ndarray, threshold: np.ndarray) -> np.ndarray:
    """log(1 - exp(-exp(logp - threshold))); 0 without a threshold, nan without a sample."""
    with np.errstate(all="ignore"):
        apart = logp - threshold
        rate = np.exp(apart)
        log = np.where(
            rate > 0.5, np.log1p(-np.exp(-rate)), apart + np.log(-np.expm1(-rate) / rate)
        )
        # so far below, 1 - exp(-rate) is the rate itself
        return np.where(apart < -40, apart, log)


def sample_texts(
    vocab: Vocabulary, alone: np.ndarray, texts: Texts, keys: np.ndarray, k: int = SAMPLES
) -> Sample:
    """The ``k`` perturbed-best segmentations of every text."""
    batch = _Batch(vocab, alone, texts, keys)
    net, n = batch.net, batch.count
    logp, value = np.full((k, n), np.nan), np.full((k, n), np.nan)
    none = np.zeros(n, np.int64)
    root = -np.log(-np.log(_uniform(keys, none, 1000)))
    edges = np.full(len(batch.chars), -1, np.int64)
    batch.draw(edges, batch.chunk, batch.origin, batch.row, 0)
    paths: list[Beside] = []
    # per turn: the path and the edge of it that each text branched from, and the edge it took
    picked: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    alive, branch = np.ones(n, bool), np.full(n, -1, np.int64)
    ids, cuts = [], []
    value[0] = root
    for turn in range(k):
        at, edge, run, cut = batch.path(edges)
        with np.errstate(over="ignore"):
            whole = (run[cut[1:]] - run[cut[:-1]]) / _LOG
        logp[turn, alive] = whole[alive]
        mine, offsets = _ids(batch, edge, at, cut)
        ids.append(mine)
        cuts.append(offsets)
        # up to k - 1 - turn of the path's regions are opened, and one more may be the threshold
        paths.append(batch.regions(at, edge, run, cut, value[turn], branch, 2000 + turn, k - turn))
        best, which, spot = _next_regions(paths, n)
        threshold = best
        if turn + 1 == k:
            break
        alive = alive & np.isfinite(best)
        value[turn + 1, alive] = best[alive]
        rows = np.flatnonzero(alive)
        p, s = which[rows], spot[rows]
        place, base, first = (np.zeros(len(rows), kind) for kind in (np.int64, np.float64, np.int64))
        for q, path in enumerate(paths):
            here = p == q
            edge = path.here[s[here]]
            place[here], base[here], first[here] = path.at[edge], path.before[s[here]], path.taken[edge]
        state = batch.state(place)
        head, count = net.first[state], net.many[state]
        used = [(np.ones(len(rows), bool), first)]
        used += [((w[rows] == p) & (t[rows] == s), e[rows]) for w, t, e in picked]
        gone = sum(same.astype(np.int64) for same, _ in used)
        own = _left_edges(net, head, count, used)
        key = batch.keys[rows]
        sums = np.cumsum(own, axis=1)
        total = sums[:, -1] if len(rows) else np.zeros(0)
        u = _uniform(key, place, 3000 + turn) * total
        pick = np.minimum((sums <= u[:, None]).sum(1), count - 1)
        here = np.arange(len(rows))
        while (none := own[here, pick] == 0).any():
            pick[none] -= 1
        taken = head + pick
        rest = total - own[here, pick]
        noise = -np.log(_uniform(key, place, 4000 + turn))
        open_ = (gone + 1 < count) & (rest > 0)
        again = _cut_gumbel(base + np.log(np.where(open_, rest, 1.0)), best[rows], noise)
        again[~open_] = -np.inf
        branch = np.full(n, -1, np.int64)
        branch[rows] = place
        took = np.full(n, -1, np.int64)
        took[rows] = taken
        picked.append((which, spot, took))
        edges = np.full(len(batch.chars), -1, np.int64)
        for q, path in enumerate(paths):
            here = p == q
            path.value[s[here]] = again[here]
            begin = path.cut[rows[here]]
            copied = _spans(begin, path.here[s[here]] - begin)
            edges[path.at[copied]] = path.taken[copied]
        edges[place] = taken
        length = net.length[taken]
        later = alive[batch.row] & (batch.chunk > branch[batch.row])
        batch.draw(
            edges,
            np.concatenate((place + length, batch.chunk[later])),
            np.concatenate((state + length, batch.origin[later])),
            np.concatenate((rows, batch.row[later])),
            turn + 1,
        )
    return Sample(ids, cuts, logp, value, _log_inclusion(logp, threshold))


def _next_regions(paths: list[Beside], n: int):
    """Each text's best region: its value, its path, and the edge of the path it lies beside."""
    best, which, spot = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for p, path in enumerate(paths):
        row, cut, beside = path.row, path.first, path.value
        here = np.flatnonzero(np.diff(cut))
        if not len(here):
            continue
        top = np.full(n, -np.inf)
        top[here] = np.maximum.reduceat(beside, cut[here])
        most = np.flatnonzero(beside == top[row])[::-1]
        first = np.zeros(n, np.int64)
        first[row[most]] = most  # the last one written is the first of equals
        better = top > best
        best[better], which[better], spot[better] = top[better], p, first[better]
    return best, which, spot


def _left_edges(net: Lattices, head: np.ndarray, count: np.ndarray, used: list) -> np.ndarray:
    """Probabilities of the states' edges, those in use and places beyond ``count`` as 0."""
    step = np.arange(int(count.max(initial=1)))
    there = step < count[:, None]
    own = np.where(there, np.exp(net.logp[head[:, None] + np.where(there, step, 0)]), 0.0)
    for same, edge in used:
        own[np.flatnonzero(same), (edge - head)[same]] = 0.0
    return own


def _ids(batch: _Batch, edge: np.ndarray, at: np.ndarray, cut: np.ndarray):
    """Piece ids of a path, bytes spelled out, and where each text's begin."""
    out = batch.net.piece[edge]
    bare = np.flatnonzero(out < 0)
    width = batch.wide[at[bare]]
    moved = np.concatenate(([0], np.cumsum(width - 1)))
    begin = bare + moved[:-1]
    if moved[-1]:
        every = np.ones(len(out), np.int64)
        every[bare] = width
        out = np.repeat(out, every)
    char = batch.chars[at[bare]]
    char = np.where(char == _OWN_MARK, MARK, char)
    for length in range(1, 5):
        some = width == length
        for turn in range(length):
            out[begin[some] + turn] = batch.vocab.byte_ids[_utf8(char[some], length, turn)]
    return out, cut + moved[np.searchsorted(bare, cut)]


def _utf8(char: np.ndarray, length: int, turn: int) -> np.ndarray:
    """A byte of characters that take ``length`` bytes."""
    if length == 1:
        return char
    if turn == 0:
        return (0xF00 >> length & 0xFF) | char >> 6 * (length - 1)
    return 0x80 | char >> 6 * (length - 1 - turn) & 0x3F


def _round_trips(vocab: Vocabulary, ids: np.ndarray, cuts: np.ndarray, texts: Texts) -> np.ndarray:
    """Whether each list of ids spells its text, byte by byte."""
    spelled, bounds = _spelled(vocab, ids, cuts)
    sizes = np.diff(texts.starts)
    front = (sizes > 0).astype(np.int64)
    same = np.diff(bounds) == sizes + front
    # both sides end to end, only of texts whose sizes agree
    given = spelled[np.repeat(same, np.diff(bounds))]
    wanted = texts.data[np.repeat(same, sizes)]
    starts = np.concatenate(([0], np.cumsum(sizes[same])))[:-1]
    wanted = np.insert(wanted, starts[front[same] > 0], 32)
    wrong = np.flatnonzero(given != wanted)
    ends = np.cumsum((sizes + front)[same])
    same[np.flatnonzero(same)[np.searchsorted(ends, wrong, side="right")]] = False
    return same


def encode(
    docs: DataFrame, vocab: Vocabulary, k: int = SAMPLES, seed: int = SEED, key: str = "doc_id"
) -> DataFrame:
    """doc_id, sample, ids, log_prob, perturbed, inclusion, log_inclusion, round_trip: up to ``k`` rows per document.

    ``round_trip`` says whether the ids decode to the text, byte by byte; a null text counts as
    empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    held: list[np.ndarray] = []

    def each(batches):
        words = shared.value
        if not held:
            held.append(words.alone())
        for batch in batches:
            keys = mix(batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64), seed)
            for texts in texts_of(batch.column(2), _PIECE):
                mine = keys[texts.first : texts.first + texts.count]
                yield from sampled(words, batch.column(0), texts, mine)

    def sampled(words, ids, texts, mine):
        found = sample_texts(words, held[0], texts, mine, k)
        measures = (found.logp, found.value, found.inclusion, found.log_inclusion)
        for turn in range(len(found.ids)):
            real = ~np.isnan(found.logp[turn])
            rows = np.flatnonzero(real)
            back = _round_trips(words, found.ids[turn], found.cuts[turn], texts)[rows]
            lists = pa.ListArray.from_arrays(
                pa.array(found.cuts[turn], pa.int32()), pa.array(found.ids[turn], pa.int32())
            ).filter(pa.array(real))
            yield batch_of(
                doc_id=ids.take(pa.array(rows + texts.first)),
                sample=np.full(len(rows), turn, np.int32),
                ids=lists,
                **{name: x[turn][real] for name, x in zip(_MEASURES, measures)},
                round_trip=back,
            )

    own = F.col(key).cast("long")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(own), "text")
    return rows.mapInArrow(
        tidy(each),
        "doc_id long, sample int, ids array<int>, log_prob double, perturbed double,"
        " inclusion double, log_inclusion double, round_trip boolean",
    )


_MEASURES = ("log_prob", "perturbed", "inclusion", "log_inclusion")


def _spelled(vocab: Vocabulary, ids: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all lists of piece ids end to end, and where each begins."""
    spelled = vocab.spelled.take(pa.array(ids))
    at = np.frombuffer(spelled.buffers()[1], np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
    raw = np.frombuffer(spelled.buffers()[2], np.uint8)[: at[-1]] if at[-1] else np.zeros(0, np.uint8)
    return raw, at[cuts]


def _raw_texts(vocab: Vocabulary, ids: np.ndarray, cuts: np.ndarray) -> list[bytes]:
    """The bytes of each list of piece ids, without the space that encoding puts in front."""
    raw, bounds = _spelled(vocab, ids, cuts)
    raw, bounds = raw.tobytes(), bounds.tolist()
    return [raw[a:b].removeprefix(b" ") for a, b in zip(bounds, bounds[1:])]


def decode_ids(vocab: Vocabulary, ids) -> str:
    """The text of one list of piece ids; bytes that are no UTF-8 become U+FFFD."""
    raw = _raw_texts(vocab, np.array(ids, np.int32), np.array([0, len(ids)]))[0]
    return raw.decode(errors="replace")


def decode(encoded: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Add the ``text`` of each row's ``ids``; null ids give null."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocab)
    place = encoded.columns.index("ids")

    def run(batch):
        lists = batch.column(place)
        cuts = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())))
        raw = _raw_texts(shared.value, lists.flatten().to_numpy(), cuts)
        there = lists.is_valid().to_pylist()
        texts = [x.decode(errors="replace") if real else None for x, real in zip(raw, there)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"]
        )

    schema = ", ".join(f"`{c}` {t}" for c, t in encoded.dtypes) + ", text string"
    return map_arrow(encoded, run, schema)
