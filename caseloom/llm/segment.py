"""Sampled SentencePiece segmentations without replacement, and decoding.

All segmentations of a text are the paths of a lattice. Each path's log-probability
gets Gumbel noise, and the k paths with the largest sums are a sample without
replacement. They are found best first: a region of paths has the Gumbel maximum of
its total mass as bound, its best path is drawn by walking down the lattice, and what
remains of the region is split by where a path first leaves it, each part with a
Gumbel maximum below its parent's.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.llm.arrow import map_batches, pieces

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
_MARK = "▁"
# Few enough that the arrays of a piece, some hundred bytes a character, stay in the cache
_PIECE_CHARS = 250_000
# Noise from 53-bit uniform numbers lies in (-3.7, 37.5): a region whose log-mass is
# further below another's than both together cannot come before it.
_REACH = 41.2
# Steps of a path looked at together, and paths
_BLOCK, _TOGETHER = 512, 64


# ---------------------------------------------------------------------------
# Vocabulary
# ---------------------------------------------------------------------------
@dataclass
class Vocabulary:
    """Pieces with log-probabilities as a trie of hashed transitions, and their decoding."""

    pieces: list[str]
    raw: np.ndarray
    raw_first: np.ndarray
    raw_size: np.ndarray
    byte_ids: np.ndarray
    byte_log: float
    chars: np.ndarray
    slots: np.ndarray
    targets: np.ndarray
    piece_at: np.ndarray
    log_at: np.ndarray

    @classmethod
    def load(cls, path: str, ranked: bool = True) -> Vocabulary:
        """From a model file. ``ranked``: scores are merge ranks, as byte-pair models have
        them, and a piece of rank r gets a probability in proportion to 1 / (r + 3);
        else scores are log-probabilities. White space may only begin pieces."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        texts = [model.id_to_piece(i) for i in range(n)]
        plain = [
            i
            for i in range(n)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        if any(_MARK in texts[i].lstrip(_MARK) for i in plain):
            raise ValueError("a piece of this model spans words")
        byte_ids = np.full(256, -1, np.int32)
        for i in range(n):
            if model.is_byte(i):
                byte_ids[int(texts[i][1:-1], 16)] = i
        scores = np.array([model.get_score(i) for i in plain])
        if ranked:
            scores = -np.log(np.minimum(-scores, n) + 3.0)
            scores -= np.logaddexp.reduce(scores)
        alphabet = {c: k for k, c in enumerate(sorted({c for i in plain for c in texts[i]}))}
        chars = np.full(0x110000, -1, np.int32)
        for c, k in alphabet.items():
            chars[ord(c)] = k
        step: dict[int, int] = {}
        piece_at, log_at = [-1], [0.0]
        for i, score in zip(plain, scores.tolist(), strict=True):
            node = 0
            for c in texts[i]:
                key = node * (len(alphabet) + 1) + alphabet[c]
                if key not in step:
                    step[key] = len(piece_at)
                    piece_at.append(-1)
                    log_at.append(0.0)
                node = step[key]
            piece_at[node], log_at[node] = i, score
        slots, targets = _hashed(step)
        raw = [t.encode() for t in texts]
        for value, i in enumerate(byte_ids.tolist()):
            if i >= 0:
                raw[i] = bytes([value])
        size = np.fromiter(map(len, raw), np.int64, n)
        return cls(
            texts,
            np.frombuffer(b"".join(raw), np.uint8),
            np.cumsum(size) - size,
            size,
            byte_ids,
            float(scores.min()) - 1.0,
            chars,
            slots,
            targets,
            np.array(piece_at, np.int32),
            np.array(log_at),
        )

    @cached_property
    def width(self) -> int:
        """Letters of the trie, and one number for all others."""
        return int(self.chars.max()) + 2

    def steps(self, key: np.ndarray) -> np.ndarray:
        """The nodes that transitions lead to, -1 where there is none."""
        at = _slot(key, len(self.slots))
        found = self.slots[at]
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.slots) - 1)
            found[open_] = self.slots[at[open_]]
            open_ = open_[(found[open_] != key[open_]) & (found[open_] >= 0)]
        return np.where(found == key, self.targets[at], -1)

    def decode(self, ids: Sequence[int]) -> str:
        """The text of a segmentation: what was encoded, with U+2581 read as a space."""
        ids = np.asarray(ids, np.int64)
        size = self.raw_size[ids]
        ends = np.cumsum(size)
        # every byte's place: its piece's first byte, and how far it is from there
        place = np.repeat(self.raw_first[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        text = self.raw[place].tobytes().decode("utf-8", "replace")
        return text.replace(_MARK, " ")[1:]


def _slot(key: np.ndarray, slots: int) -> np.ndarray:
    mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(65 - slots.bit_length())).astype(np.int64)


def _hashed(step: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Transitions as an open hash table, an eighth full: keys, -1 where free, and targets."""
    size = 1 << (8 * len(step) + 1).bit_length()
    slots, targets = np.full(size, -1, np.int64), np.full(size, -1, np.int32)
    keys = np.fromiter(step, np.int64, len(step))
    for key, at, target in zip(keys.tolist(), _slot(keys, size).tolist(), step.values(), strict=True):
        while slots[at] >= 0:
            at = (at + 1) & (size - 1)
        slots[at], targets[at] = key, target
    return slots, targets


# ---------------------------------------------------------------------------
# Random numbers that depend on the row only
# ---------------------------------------------------------------------------
def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(keys: np.ndarray, step: int | np.ndarray) -> np.ndarray:
    """In the open interval (0, 1)."""
    at = np.asarray(step, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((_mix(keys + at) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


# ---------------------------------------------------------------------------
# Lattices of distinct units
# ---------------------------------------------------------------------------
class Lattice:
    """Edges of all units (a run of spaces and the word after it), one after the other.

    Nodes are places in the joined units; each unit ends with a node without edges.
    ``log`` is an edge's conditional log-probability given its start.
    """

    def __init__(self, vocabulary: Vocabulary, units: list[str]) -> None:
        v = vocabulary
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        ends = np.cumsum(lengths + 1) - 1
        self.starts = ends - lengths
        points = np.frombuffer("\0".join([*units, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(points)
        self.final = np.zeros(n, bool)
        self.final[ends] = True
        end_of = np.repeat(ends, lengths + 1)
        # 32-bit numbers do for the places of a piece of text and the keys of the trie
        wide = np.int32 if max(64 * n, (len(v.piece_at) + 1) * v.width) < 2**31 else np.int64
        char = v.chars[points].astype(wide)
        char[self.final | (char < 0)] = v.width - 1
        active = np.flatnonzero(char < v.width - 1).astype(wide)
        node = np.zeros(len(active), wide)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        of_root = v.steps(np.arange(v.width))
        while len(active):
            c = char[active + wide(len(found))]
            node = v.steps(node * np.int64(v.width) + c) if found else of_root[c]
            hit = node >= 0
            active, node = active[hit], node[hit]
            whole = v.piece_at[node] >= 0
            found.append((active[whole], node[whole]))
        single = np.zeros(n, bool)
        if found:
            single[found[0][0]] = True
        bare = np.flatnonzero(~single & ~self.final)
        # edges by their start, longer pieces, the likelier ones, first
        self.count = np.bincount(bare, minlength=n).astype(wide)
        for begin, _ in found:
            self.count[begin] += 1
        self.first = np.cumsum(self.count, dtype=wide) - self.count
        total_edges = int(self.count.sum())
        begin = np.repeat(np.arange(n, dtype=wide), self.count)
        self.stop, self.id = np.empty(total_edges, wide), np.empty(total_edges, wide)
        weight = np.empty(total_edges)
        fill = self.first.copy()
        for depth in range(len(found), 0, -1):
            start, last = found[depth - 1]
            place = fill[start]
            fill[start] += 1
            self.stop[place] = start + depth
            self.id[place] = v.piece_at[last]
            weight[place] = v.log_at[last]
        place = fill[bare]
        size = 1 + (points[bare] > 0x7F) + (points[bare] > 0x7FF).astype(int) + (points[bare] > 0xFFFF)
        self.stop[place] = bare + 1
        self.id[place] = -1 - points[bare].astype(np.int64)
        weight[place] = size * v.byte_log
        # log of all paths' mass from a node to its unit's end, nearest nodes first
        inner = np.flatnonzero(~self.final)
        left = end_of[inner] - inner
        if left.max(initial=0) < 65536:
            left = left.astype(np.uint16)  # sorted by counting
        by_left = np.argsort(left, kind="stable")
        bounds = np.searchsorted(left[by_left], np.arange(1, int(left.max(initial=0)) + 2, dtype=np.int64))
        inner = inner[by_left].astype(wide)
        many = self.count[inner]
        heads = np.r_[0, np.cumsum(many, dtype=np.int64)]
        edge = np.repeat(self.first[inner] - heads[:-1], many) + np.arange(total_edges)
        weight_by, stop_by = weight[edge], self.stop[edge]
        total = np.zeros(n)
        for lo, hi in itertools.pairwise(bounds.tolist()):
            if lo < hi:
                start, end = int(heads[lo]), int(heads[hi])
                value = weight_by[start:end] + total[stop_by[start:end]]
                total[inner[lo:hi]] = np.logaddexp.reduceat(value, heads[lo:hi] - start)
        self.log = np.minimum(weight + total[self.stop] - total[begin], 0.0)
        # share of each edge and those before it at the same node; the last takes what rounding leaves
        run = np.cumsum(np.exp(self.log))
        before = np.where(self.first > 0, run[np.maximum(self.first, 1) - 1], 0.0)
        self.run = run - before[begin]
        self.run[(self.first + self.count - 1)[self.count > 0]] = 2.0

    def walk(self, nodes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A path from each node to its unit's end: ``(counts, edges)``, by item, then step."""
        active = np.flatnonzero(~self.final[nodes])
        at = nodes[active]
        counts = np.zeros(len(nodes), np.int64)
        items, edges, step = [], [], 0
        while len(active):
            edge = self.first[at]
            u = _uniform(keys[active], step)
            behind = np.flatnonzero(u >= self.run[edge])
            while len(behind):
                edge[behind] += 1
                behind = behind[u[behind] >= self.run[edge[behind]]]
            items.append(active)
            edges.append(edge)
            at = self.stop[edge]
            step += 1
            done = self.final[at]
            counts[active[done]] = step
            active, at = active[~done], at[~done]
        offset = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int64)
        for k, (x, e) in enumerate(zip(items, edges, strict=True)):
            out[offset[x] + k] = e
        return counts, out


class Store(Lattice):
    """Lattices of all units asked for so far, one after the other.

    A unit is worked out once, until there are some ``limit`` nodes; then all are
    forgotten but those that more than one call has asked for since the last time, so
    memory is bounded however many units there are.
    """

    _NODES, _EDGES = ("final", "first", "count", "again"), ("stop", "id", "log", "run")

    def __init__(self, vocabulary: Vocabulary, limit: int = 1_000_000) -> None:
        self.vocabulary, self.limit = vocabulary, limit
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.held: dict[str, np.ndarray] = {}
        self.sizes = [0, 0]

    def _keep_known(self) -> None:
        """Forget the units that were not asked for again; move the others together."""
        units, at = list(self.place), np.fromiter(self.place.values(), np.int64, len(self.place))
        stays = self.again[at]
        if not stays.any():
            return self._clear()
        # units stand in the order in which they were put down
        node = np.repeat(stays, np.diff(np.r_[at, self.sizes[0]]))
        edge = np.repeat(node, self.count)
        moved = np.cumsum(node) - 1
        self.place = dict(zip(itertools.compress(units, stays.tolist()), moved[at[stays]].tolist(), strict=True))
        held = {name: getattr(self, name)[node] for name in self._NODES}
        held |= {name: getattr(self, name)[edge] for name in self._EDGES}
        held["first"] = np.cumsum(held["count"], dtype=held["first"].dtype) - held["count"]
        held["stop"] = moved[held["stop"]].astype(held["stop"].dtype)
        held["again"][:] = False
        self.held, self.sizes = held, [len(held["final"]), len(held["stop"])]
        for name, values in held.items():
            setattr(self, name, values)

    def _append(self, part: Lattice) -> None:
        part.again = np.zeros(len(part.final), bool)
        for which, names in enumerate((self._NODES, self._EDGES)):
            size = self.sizes[which]
            more = len(getattr(part, names[0]))
            for name in names:
                new = getattr(part, name)
                held = self.held.get(name)
                if held is None or len(held) < size + more:
                    grown = np.empty(max(size + more, 2 * size), new.dtype if held is None else held.dtype)
                    if held is not None:
                        grown[:size] = held[:size]
                    held = self.held[name] = grown
                # nodes name edges by number, edges nodes
                shift = {"first": self.sizes[1], "stop": self.sizes[0]}.get(name)
                held[size : size + more] = new if shift is None else new + shift
                setattr(self, name, held[: size + more])
        self.sizes = [len(self.final), len(self.stop)]

    def _find(self, units: list[str]) -> tuple[np.ndarray, list[str]]:
        """The node of each unit, -1 where it is new, and the new units."""
        at = np.fromiter(map(self.place.get, units, itertools.repeat(-1)), np.int64, len(units))
        return at, list(itertools.compress(units, (at < 0).tolist()))

    def nodes(self, units: list[str]) -> np.ndarray:
        """The node where each of these different units begins."""
        at, new = self._find(units)
        for forget in (self._keep_known, self._clear):
            if not new or self.sizes[0] + 2 * len(new) + sum(map(len, new)) <= self.limit:
                break
            forget()
            at, new = self._find(units)
        if self.sizes[0]:
            self.again[at[at >= 0]] = True
        if new:
            part = Lattice(self.vocabulary, [_MARK + u for u in new])
            begin = part.starts + self.sizes[0]
            self.place.update(zip(new, begin.tolist(), strict=True))
            self._append(part)
            at[at < 0] = begin
        return at


def units_of(text: str) -> list[str]:
    """A text with a space put before it, cut before each run of spaces.

    Units are given without the mark for their first space."""
    words = text.replace(" ", _MARK).split(_MARK)
    if "" not in words:
        return words
    out, spaces = [], 0
    for w in words:
        if w:
            out.append(_MARK * spaces + w)
            spaces = 0
        else:
            spaces += 1
    return out + [_MARK * (spaces - 1)] if spaces else out


def _split(texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """``units_of`` each text: how many it has, the different ones, the place of each among them."""
    counts = np.zeros(len(texts), np.int64)
    # texts without runs of spaces are cut and their words numbered outside Python
    plain, odd = [], []
    for i, text in enumerate(texts):
        if text:
            text = text.replace(_MARK, " ")
            (odd if "  " in f" {text} " else plain).append((i, text))
    try:
        words = pc.split_pattern(pa.array([t for _, t in plain], pa.string()), " ")
    except UnicodeEncodeError:  # half a surrogate pair
        odd, plain = sorted(odd + plain), []
        words = pa.array([], pa.list_(pa.string()))
    coded = words.flatten().dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    counts[[i for i, _ in plain]] = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    of_plain = coded.indices.to_numpy(zero_copy_only=False)
    if not odd:
        return counts, distinct, of_plain
    known = {u: k for k, u in enumerate(distinct)}
    of_odd = []
    for i, text in odd:
        units = units_of(text)
        counts[i] = len(units)
        of_odd += [known.setdefault(u, len(known)) for u in units]
    is_odd = np.zeros(len(texts), bool)
    is_odd[[i for i, _ in odd]] = True
    is_odd = np.repeat(is_odd, counts)
    code = np.empty(len(is_odd), np.int64)
    code[~is_odd], code[is_odd] = of_plain, of_odd
    return counts, list(known), code


# ---------------------------------------------------------------------------
# Best-first search
# ---------------------------------------------------------------------------
@dataclass
class _Row:
    """What the search holds of a text: its units' nodes, found paths, open regions."""

    nodes: np.ndarray
    seed: np.uint64
    paths: list[np.ndarray]
    steps: list[np.ndarray]
    values: list[float]
    regions: list[tuple[float, int, int, tuple[int, ...]]]
    number: int = 0


def _open(row: _Row, lattice: Lattice, wanted: int, since: int, excluded: tuple[int, ...]) -> None:
    """Split what the newest path leaves of its region: by the step where a path turns off.

    ``excluded`` are the edges used up at step ``since``, where the region began."""
    path, bound, number = row.paths[-1], row.values[-1], len(row.paths) - 1
    log, reach = lattice.log, since
    prefix, least = float(log[path[:since]].sum()), -np.inf
    parts: list[np.ndarray] = []
    # regions further down have no more mass than the prefix that leads to them
    while reach < len(path) and prefix > least - _REACH:
        block = log[path[reach : reach + _BLOCK]]
        before = prefix + np.cumsum(block) - block
        with np.errstate(divide="ignore"):
            off = before + np.log(-np.expm1(block))
        if reach == since and excluded:
            choice = _choice(lattice, _start(lattice, row, number, since), excluded)
            off[0] = before[0] + np.logaddexp.reduce(log[choice]) if choice else -np.inf
        parts.append(off)
        reach += len(block)
        prefix += float(block.sum())
        if reach < len(path):
            seen = np.concatenate(parts)
        if reach < len(path) and len(seen) >= wanted:
            least = float(np.partition(seen, len(seen) - wanted)[len(seen) - wanted])
    if not parts:
        return
    mass = np.concatenate(parts)
    live = np.flatnonzero(mass > -np.inf)
    if not len(live):
        return
    row.number += 1
    salt = np.full(1, (int(row.seed) + row.number * 0x632BE59BD9B4E019) & (2**64 - 1), np.uint64)
    u = _uniform(salt, live)
    value = -np.logaddexp(-bound, -(mass[live] - np.log(-np.log(u))))
    best = [int(value.argmax())] if wanted == 1 else np.argsort(-value, kind="stable")[:wanted].tolist()
    for k in best:
        at = since + int(live[k])
        used = excluded if at == since and excluded else (int(path[at]),)
        heapq.heappush(row.regions, (-float(value[k]), number, at, used))


def _open_all(turns: list[tuple[_Row, int, tuple[int, ...]]], lattice: Lattice, wanted: int) -> None:
    """``_open`` for many rows; the few that one block does not decide go there."""
    for begin in range(0, len(turns), _TOGETHER):
        part = turns[begin : begin + _TOGETHER]
        blocks = [row.paths[-1][since : since + _BLOCK] for row, since, _ in part]
        sizes = np.fromiter(map(len, blocks), np.int64, len(part))
        log = np.zeros((len(part), int(sizes.max())))
        log[np.arange(log.shape[1]) < sizes[:, None]] = lattice.log[np.concatenate(blocks)]
        prefix = np.array([lattice.log[row.paths[-1][:since]].sum() if since else 0.0 for row, since, _ in part])
        before = prefix[:, None] + np.cumsum(log, axis=1) - log
        with np.errstate(divide="ignore"):
            mass = before + np.log(-np.expm1(log))  # none where a path has ended
        whole = np.ones(len(part), bool)
        for i, (row, since, excluded) in enumerate(part):
            if excluded and sizes[i]:
                choice = _choice(lattice, _start(lattice, row, len(row.paths) - 1, since), excluded)
                mass[i, 0] = before[i, 0] + np.logaddexp.reduce(lattice.log[choice]) if choice else -np.inf
            if since + sizes[i] < len(row.paths[-1]):
                least = np.partition(mass[i], -wanted)[-wanted] if sizes[i] >= wanted else -np.inf
                whole[i] = prefix[i] + log[i].sum() <= least - _REACH
        here = np.flatnonzero(whole & (mass > -np.inf).any(axis=1))
        salts = []
        for i in here.tolist():
            row = part[i][0]
            row.number += 1
            salts.append((int(row.seed) + row.number * 0x632BE59BD9B4E019) & (2**64 - 1))
        if salts:
            mass = mass[here]
            u = _uniform(np.array(salts, np.uint64)[:, None], np.arange(mass.shape[1]))
            bound = np.array([part[i][0].values[-1] for i in here.tolist()])[:, None]
            value = -np.logaddexp(-bound, -(mass - np.log(-np.log(u))))
            for _ in range(min(wanted, mass.shape[1])):
                best = value.argmax(axis=1)
                for j, (i, k) in enumerate(zip(here.tolist(), best.tolist(), strict=True)):
                    if mass[j, k] > -np.inf:
                        row, since, excluded = part[i]
                        path, at = row.paths[-1], since + k
                        used = excluded if k == 0 and excluded else (int(path[at]),)
                        heapq.heappush(row.regions, (-float(value[j, k]), len(row.paths) - 1, at, used))
                mass[np.arange(len(here)), best] = value[np.arange(len(here)), best] = -np.inf
        for i in np.flatnonzero(~whole).tolist():
            row, since, excluded = part[i]
            _open(row, lattice, wanted, since, excluded)


def _choice(lattice: Lattice, node: int, used: tuple[int, ...]) -> list[int]:
    """The edges of a node that are not used up."""
    lo = int(lattice.first[node])
    return [e for e in range(lo, lo + int(lattice.count[node])) if e not in used]


def _start(lattice: Lattice, row: _Row, number: int, step: int) -> int:
    """The node a path is at before a step."""
    path, counts = row.paths[number], row.steps[number]
    unit = int(np.searchsorted(np.cumsum(counts), step, side="right"))
    begun = int(counts[:unit].sum())
    return int(row.nodes[unit]) if step == begun else int(lattice.stop[path[step - 1]])


def sample(
    vocabulary: Vocabulary, texts: list[str | None], seeds: np.ndarray, k: int, store: Store | None = None
) -> list[list[tuple]]:
    """Per text up to ``k`` distinct ``(ids, log_p, value, log_inclusion)``, largest value first.

    ``value`` is the log-probability with its Gumbel noise, ``log_inclusion`` the log
    of the probability to exceed the next value not returned. A text with fewer
    segmentations returns all, each included for certain. Null and empty texts have
    none. Results depend on the text, its seed and ``k``, not on other texts; ``store``
    keeps lattices from one call to the next.
    """
    if k < 1:
        raise ValueError("at least one segmentation has to be asked for")
    counts, distinct, code = _split(texts)
    if not len(code):
        return [[] for _ in texts]
    lattice = store or Store(vocabulary)
    nodes = lattice.nodes(distinct)[code]
    offset = np.cumsum(counts) - counts
    row_of = np.repeat(np.arange(len(texts)), counts)
    seeds = _mix(np.asarray(seeds, np.uint64))

    def keys(rows: np.ndarray, units: np.ndarray, path: int) -> np.ndarray:
        return _mix(seeds[rows] ^ _mix(units.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(path)))

    steps, edges = lattice.walk(nodes, keys(row_of, np.arange(len(nodes)) - offset[row_of], 0))
    at = np.r_[0, np.cumsum(steps)]
    rows: dict[int, _Row] = {}
    for i in np.flatnonzero(counts).tolist():
        lo, hi = int(offset[i]), int(offset[i] + counts[i])
        noise = float(-np.log(-np.log(_uniform(seeds[i : i + 1], 0)))[0])
        rows[i] = _Row(nodes[lo:hi], seeds[i], [edges[at[lo] : at[hi]]], [steps[lo:hi]], [noise], [])
    _open_all([(row, 0, ()) for row in rows.values()], lattice, k)
    for number in range(1, k):
        turns, starts, owners, units = [], [], [], []
        for i, row in rows.items():
            if len(row.paths) < number or not row.regions:
                continue
            value, parent, step, used = heapq.heappop(row.regions)
            node = _start(lattice, row, parent, step)
            choice = _choice(lattice, node, used)
            share = np.cumsum(np.exp(lattice.log[choice] - lattice.log[choice].max()))
            u = float(_uniform(np.full(1, int(row.seed) ^ 0xA5A5A5A5, np.uint64), number)[0])
            edge = choice[min(int(np.searchsorted(share, u * share[-1], side="right")), len(choice) - 1)]
            unit = int(np.searchsorted(np.cumsum(row.steps[parent]), step, side="right"))
            turns.append((i, -value, parent, step, used, edge, unit))
            starts.append(np.concatenate([lattice.stop[edge : edge + 1], row.nodes[unit + 1 :]]))
            owners.append(np.full(len(starts[-1]), i))
            units.append(np.arange(unit, unit + len(starts[-1])))
        if not turns:
            break
        steps, edges = lattice.walk(
            np.concatenate(starts), keys(np.concatenate(owners), np.concatenate(units), number)
        )
        at = np.r_[0, np.cumsum(steps)]
        item, opened = 0, []
        for (i, value, parent, step, used, edge, unit), own in zip(turns, starts, strict=True):
            row, size = rows[i], len(own)
            before = row.steps[parent][:unit]
            inside = step - int(before.sum()) + 1
            row.paths.append(
                np.concatenate([row.paths[parent][:step], [edge], edges[at[item] : at[item + size]]])
            )
            row.steps.append(
                np.concatenate([before, [inside + steps[item]], steps[item + 1 : item + size]])
            )
            row.values.append(value)
            item += size
            opened.append((row, step, (*used, edge)))
        _open_all(opened, lattice, k - number)
    out: list[list[tuple]] = [[] for _ in texts]
    for i, row in rows.items():
        limit = -row.regions[0][0] if row.regions else -np.inf
        for path, value in zip(row.paths, row.values, strict=True):
            log_p = float(lattice.log[path].sum())
            out[i].append((_ids(vocabulary, lattice.id[path]), log_p, value, _log_inclusion(log_p - limit)))
    return out


def _log_inclusion(x: float) -> float:
    """log(1 - exp(-exp(x))), as x itself where that is all that is left of it."""
    if x == np.inf or x > 7:
        return 0.0
    return x if x < -36 else float(np.log(-np.expm1(-np.exp(x))))


def _ids(vocabulary: Vocabulary, found: np.ndarray) -> np.ndarray:
    bare = np.flatnonzero(found < 0)
    if not len(bare):
        return found.astype(np.int32)
    points = -1 - found[bare]
    if (points < 128).all():
        out = found.astype(np.int32)
        out[bare] = vocabulary.byte_ids[points]
        return out
    parts, last = [], 0
    for b in bare.tolist():
        parts.append(found[last:b])
        raw = chr(-1 - int(found[b])).encode("utf-8", "surrogatepass")
        parts.append(vocabulary.byte_ids[np.frombuffer(raw, np.uint8)])
        last = b + 1
    return np.concatenate([*parts, found[last:]]).astype(np.int32)


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------
SAMPLES = T.ArrayType(
    T.StructType(
        [
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("log_p", T.DoubleType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("log_inclusion", T.DoubleType()),
        ]
    )
)


def segmentations(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    k: int = 2,
    seed: int = 0,
    model_path: str = MODEL_PATH,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` with ``samples`` (see ``sample``) and ``round_trip``: every sample decodes to the text.

    The driver reads the model file once and sends its table to the tasks. A row is
    sampled by its own ``key`` (null is a key like any other), so repeated rows get
    equal samples wherever they run. Null and empty texts get an empty list and
    true; a text with U+2581, which the model reads as a space, decodes with the
    space, and ``round_trip`` is false. Columns of the two output names are
    replaced; ``keep`` names the others to return.
    """
    vocabulary = Vocabulary.load(model_path)
    kept = [c for c in (df.columns if keep is None else keep) if c not in ("samples", "round_trip")]
    schema = T.StructType(
        [df.schema[c] for c in kept]
        + [T.StructField("samples", SAMPLES), T.StructField("round_trip", T.BooleanType())]
    )

    def run(batches):
        store = Store(vocabulary)
        for batch in batches:
            for piece in pieces(batch, "_text", _PIECE_CHARS):
                texts = piece.column("_text").to_pylist()
                seeds = piece.column("_seed").to_numpy(zero_copy_only=False).view(np.uint64)
                found = sample(vocabulary, texts, seeds, k, store)
                good = [
                    all(vocabulary.decode(ids) == t for ids, *_ in rows)
                    for t, rows in zip(texts, found, strict=True)
                ]
                flat = [s for rows in found for s in rows]
                sizes = np.r_[0, np.cumsum([len(s[0]) for s in flat])].astype(np.int32)
                ids = np.concatenate([s[0] for s in flat]) if flat else np.zeros(0, np.int32)
                fields = pa.StructArray.from_arrays(
                    [
                        pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(ids, pa.int32())),
                        *(pa.array([s[j] for s in flat], pa.float64()) for j in (1, 2, 3)),
                    ],
                    names=[f.name for f in SAMPLES.elementType],
                )
                rows = np.r_[0, np.cumsum([len(r) for r in found])].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(piece.column(c) for c in kept),
                        pa.ListArray.from_arrays(pa.array(rows, pa.int32()), fields),
                        pa.array(good),
                    ],
                    names=[*kept, "samples", "round_trip"],
                )

    ready = df.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col(text).cast("string").alias("_text"),
        F.xxhash64(F.lit(seed), F.col(key).isNull(), F.col(key)).alias("_seed"),
    )
    return map_batches(ready, run, schema)


def op4_segment(spark, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return segmentations(docs, keep=["doc_id"])


QUERIES = {"op4_segment": op4_segment}
ORACLE: dict[str, str] = {}
