"""SentencePiece encoding, decoding and sampled segmentations (operator 9).

A text in the model's form is one lattice: its nodes lie between characters, its edges are
pieces (or a character's bytes, where no piece is that character). No piece crosses the
start of a run of word marks, so the lattice is a chain of units, and a unit that stands
in many places is built once. A piece's weight is ``alpha`` times its log-probability: the
model's own score, or for a model whose scores are ranks of merges, Zipf's law over the
ranks. Backward sums over the units give each edge's probability given its node.

``samples`` distinct segmentations are drawn without replacement by Gumbel top-k. The
largest perturbed log-probability of the whole lattice is a Gumbel value; going down a
path, every place where the path could have turned off is a region whose largest value is
a Gumbel value of the region's mass, cut off at the path's. Regions wait in order of these
values; the best one is opened next and gives the next segmentation (A* with a bound that
is exact). Values depend on the row's key, the sample's number and the character's place
only, so a row is sampled alike in any batch. Inclusion is the probability that the
segmentation's own value exceeds the best one that was not drawn.

The encoding itself is the library's, taken unit by unit; decoding joins the pieces' bytes.

Defined results: null and empty texts have no pieces and one segmentation, the empty one,
of probability 1. A text with fewer segmentations than samples gives them all. Equal rows
get equal samples; rows with a null key are sampled with a key of their own. A mark (U+2581)
in a text is a blank, as in the library. Other columns are passed through; columns named
like those that are added are replaced.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.llm.flat import SpanHashes, mix, seed, slices, span_hashes

SAMPLES = 3
ALPHA = 0.5
MARK = "▁"
_MARK = ord(MARK)
_TABLE_BITS = 18


class Pieces:
    """A model's pieces, as what the lattice and decoding need."""

    def __init__(self, proto: bytes, alpha: float = ALPHA):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        probe = "a  b\tc\né "
        if library.decode(library.encode(probe)) != probe or not library.encode("a", out_type=str)[0].startswith(MARK):
            raise ValueError("the model changes texts; only models that keep them are supported")
        n = library.get_piece_size()
        names = [library.id_to_piece(i) for i in range(n)]
        byte_ids = [i for i in range(n) if library.is_byte(i)]
        special = [library.is_control(i) or library.is_unknown(i) or library.is_unused(i) for i in range(n)]
        ids = [i for i in range(n) if not special[i] and not library.is_byte(i)]
        if any(MARK in names[i].lstrip(MARK) for i in ids) or len(byte_ids) != 256:
            raise ValueError("pieces must not cross words, and bytes must be pieces")
        self.of_byte = np.array(byte_ids)
        scores = np.array([library.get_score(i) for i in ids])
        ranked = np.all(scores == np.round(scores))
        logs = -np.log(np.minimum(-scores, len(ids)) + 10.0) if ranked else scores
        # A byte weighs as much as the rarest piece.
        rarest = logs.min()
        norm = np.log(np.exp(logs).sum() + 256 * np.exp(rarest)) if ranked else 0.0
        self.byte_log = alpha * (rarest - norm)
        self.logs = np.zeros(n)
        self.logs[ids] = alpha * (logs - norm)
        self.weights = self.logs.copy()
        self.weights[byte_ids] = self.byte_log
        points = [np.frombuffer(names[i].encode("utf-32-le"), np.uint32) for i in ids]
        sizes = np.array([len(p) for p in points])
        ends = np.cumsum(sizes)
        hashes = span_hashes(np.concatenate(points), ends - sizes, ends)
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces have one hash")
        self.longest = int(sizes.max())
        #: Tables from bits of a hash to a piece; a piece lies in the first that had room.
        self.hash_of = np.zeros(n, np.uint64)
        self.hash_of[ids] = hashes
        self.tables: list[np.ndarray] = []
        left, left_ids = hashes, np.array(ids)
        while len(left):
            slot = self._slots(left, len(self.tables))
            table = np.full(1 << _TABLE_BITS, -1, np.int32)
            table[slot] = left_ids
            self.tables.append(table)
            out = table[slot] != left_ids
            left, left_ids = left[out], left_ids[out]
        #: Characters that end with each id: of a byte, only the first of its character counts.
        self.characters = np.array([len(x) for x in names])
        self.characters[byte_ids] = [not 0x80 <= b < 0xC0 for b in range(256)]
        # What each id is in a text: its bytes, with blanks for marks.
        outs = [b"" if special[i] else names[i].replace(MARK, " ").encode() for i in range(n)]
        for b, i in enumerate(byte_ids):
            outs[i] = bytes([b])
        self.bytes_of = outs
        self.byte_sizes = np.array([len(b) for b in outs])
        self.byte_ends = np.cumsum(self.byte_sizes)
        self.all_bytes = np.frombuffer(b"".join(outs), np.uint8)

    @staticmethod
    def _slots(hashes: np.ndarray, number: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((mix(hashes) if number else hashes) >> np.uint64(64 - _TABLE_BITS - number)).astype(np.int64) & ((1 << _TABLE_BITS) - 1)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each hash, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        for number, table in enumerate(self.tables):
            found = table[self._slots(hashes, number)]
            hit = (found >= 0) & (self.hash_of[found] == hashes)
            out[hit] = found[hit]
        return out

    def encode_units(self, points: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of units that end at ``ends``, and how many each unit has.

        Each unit begins with a mark, and those of nothing but marks come last. No piece
        lies in two units, so the library takes several at once.
        """
        bare = int((points[ends - 1] == _MARK).sum())
        cuts = np.append(np.arange(0, len(ends) - bare, _TOGETHER), np.arange(len(ends) - bare, len(ends) + 1))
        cuts = np.unique(cuts)
        text = points.tobytes().decode("utf-32-le", "replace").replace(MARK, " ")
        places = np.concatenate([[0], ends])[cuts].tolist()
        lists = self.library.encode([text[a + 1 : b] for a, b in zip(places[:-1], places[1:], strict=True)], num_threads=1)
        if bare:  # a lone mark is what the library makes of no text at all
            lists = [x or [self.library.piece_to_id(MARK)] for x in lists]
        ids = np.fromiter(itertools.chain.from_iterable(lists), np.int64, sum(map(len, lists)))
        reached = np.cumsum(self.characters[ids])
        return ids, np.diff(np.searchsorted(reached, ends, side="right"), prepend=0)

    def decode_flat(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the texts whose ids are ids[at[i]:at[i + 1]], and where each begins."""
        sizes = self.byte_sizes[ids]
        before = np.concatenate([[0], np.cumsum(sizes)])
        data = self.all_bytes[np.arange(before[-1]) - np.repeat(before[:-1], sizes) + np.repeat(self.byte_ends[ids] - sizes, sizes)]
        places = before[at]
        # The first byte of a text is the blank of its first mark.
        filled = np.diff(places) > 0
        kept = np.ones(len(data), bool)
        kept[places[:-1][filled]] = False
        return data[kept], places - np.concatenate([[0], np.cumsum(filled)])


def _named(keys: np.ndarray, name: str) -> np.ndarray:
    return mix(keys ^ seed(name))


def _uniform(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Numbers between 0 and 1, both not included, from a named key and a place."""
    with np.errstate(over="ignore"):
        bits = mix(key + place.astype(np.uint64))
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _cut_gumbel(location: np.ndarray, most: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values of these locations, given that they are at most ``most``."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        out = location - np.log(np.exp(np.minimum(location - most, 700.0)) - np.log(u))
    return np.where(np.isneginf(location), -np.inf, np.minimum(out, most))


_MOST_EDGES = 2_000_000
#: Bytes of text whose lattices and samples are held at once; half as much as elsewhere, since both are many times the text.
_SLICE = 1 << 20
_NONE = np.iinfo(np.int32).min
#: Units that the library gets in one text.
_TOGETHER = 16


class Lexicon:
    """Lattices and encodings of distinct units, kept from slice to slice of a task.

    A node is a character of a unit, or its end; edges are in order of their nodes. When
    there are more than ``_MOST_EDGES``, all are forgotten; they are built again if needed.
    """

    _EDGES = ("length", "id", "log_p", "p", "up_to", "alone")

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # sorted, and which unit each is
        self.units = np.zeros(0, np.int64)
        self.unit_node = np.zeros(0, np.int64)
        self.first_edge = np.zeros(0, np.int64)
        self.degree = np.zeros(0, np.int32)
        self.length, self.id = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.log_p, self.p, self.up_to = np.zeros(0), np.zeros(0), np.zeros(0)
        self.alone = np.zeros(0, bool)  # whether its node has no other edge
        self.ids = np.zeros(0, np.int32)
        self.ids_at = np.zeros(1, np.int64)

    def numbers(self, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each unit points[start:end]; new ones are added."""
        hashes, first, kind = np.unique(span_hashes(points, start, end), return_index=True, return_inverse=True)
        if len(self.id) > _MOST_EDGES:
            self.forget()
        place = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == hashes[inside]
        number = np.full(len(hashes), -1, np.int64)
        number[known] = self.units[place[known]]
        new = np.flatnonzero(~known)
        if len(new):
            new = new[np.argsort(points[end[first[new]] - 1] == _MARK, kind="stable")]
            number[new] = len(self.unit_node) + np.arange(len(new))
            self._add(points, start[first[new]], end[first[new]])
            merged = np.concatenate([self.hashes, hashes[new]])
            order = np.argsort(merged, kind="stable")
            self.hashes, self.units = merged[order], np.concatenate([self.units, number[new]])[order]
        return number[kind]

    def _add(self, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        sizes = end - start
        ends = np.cumsum(sizes)
        own = points[np.arange(ends[-1]) - np.repeat(ends - sizes - start, sizes)]
        ids, counts = self.pieces.encode_units(own, ends)
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.ids_at = np.concatenate([self.ids_at, self.ids_at[-1] + np.cumsum(counts)])
        built = self._build(own, sizes)
        nodes, edges = len(self.first_edge), len(self.id)
        self.unit_node = np.concatenate([self.unit_node, nodes + ends - sizes + np.arange(len(sizes))])
        self.first_edge = np.concatenate([self.first_edge, edges + built["first_edge"]])
        self.degree = np.concatenate([self.degree, built["degree"].astype(np.int32)])
        for name in self._EDGES:
            old = getattr(self, name)
            setattr(self, name, np.concatenate([old, built[name].astype(old.dtype)]))

    def _build(self, points: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        """Edges by node of units that stand one after the other in ``points``."""
        p, n = self.pieces, len(points)
        left = (np.repeat(np.cumsum(sizes), sizes) - np.arange(n)).astype(np.int32)  # to the unit's end
        node_of = np.arange(n) + np.repeat(np.arange(len(sizes)), sizes)
        hashes = SpanHashes(points)
        # A row for each character, a column for each length, the longest first.
        most = min(p.longest, int(left.max()))
        piece = np.full((n, most), _NONE, np.int32)
        fits = np.arange(n)
        for length in range(1, most + 1):
            fits = fits[left[fits] >= length]
            found = p.find(hashes(fits, fits + length))
            hit = found >= 0
            piece[fits[hit], most - length] = found[hit]
        bare = np.flatnonzero(piece[:, -1] == _NONE)  # characters that are spelt in bytes
        plain = points[bare] < 128
        piece[bare, -1] = np.where(plain, p.of_byte[np.where(plain, points[bare], 0)], -1 - points[bare].astype(np.int64))
        start, column = np.nonzero(piece != _NONE)
        id_ = piece[start, column]
        length = (most - column).astype(np.int32)
        plain_id = id_ >= 0
        weight = p.weights[np.where(plain_id, id_, 0)]
        if not plain_id.all():
            far = -1 - id_[~plain_id]
            weight[~plain_id] = p.byte_log * (2 + (far >= 0x800) + (far >= 0x10000))
        node = node_of[start]
        target = node + length
        degree = np.bincount(node, minlength=n + len(sizes)).astype(np.int32)
        first = np.cumsum(degree, dtype=np.int64) - degree
        # Backward: all nodes that are equally far from their unit's end at once.
        back = np.zeros(n + len(sizes))
        to_go = left[start]
        to_go = to_go.astype(np.int16) if most < 2**15 and int(left.max()) < 2**15 else to_go  # sorts faster
        by_distance = np.argsort(to_go, kind="stable")
        cuts = np.searchsorted(to_go[by_distance], np.arange(1, int(left.max()) + 2))
        by_weight, by_target, by_node = weight[by_distance], target[by_distance], node[by_distance]
        head = np.ones(len(by_node), bool)
        head[1:] = by_node[1:] != by_node[:-1]
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if low < high:
                values = by_weight[low:high] + back[by_target[low:high]]
                heads = np.flatnonzero(head[low:high])
                top = np.maximum.reduceat(values, heads)
                counts = np.diff(np.append(heads, high - low))
                total = np.add.reduceat(np.exp(values - np.repeat(top, counts)), heads)
                back[by_node[low:high][heads]] = top + np.log(total)
        log_p = np.minimum(weight + back[target] - back[node], 0.0)
        probability = np.exp(log_p)
        up_to = probability.copy()
        for step in range(1, int(degree.max())):  # sums along a node's edges, the same in any slice
            more = first[degree > step] + step
            up_to[more] += up_to[more - 1]
        return {"first_edge": first, "degree": degree, "length": length, "id": id_, "log_p": log_p, "p": probability, "up_to": up_to, "alone": degree[node] == 1}


class Lattices:
    """A slice's texts as chains of units whose lattices are in a lexicon."""

    def __init__(self, texts: list[str], lexicon: Lexicon):
        self.pieces = lexicon.pieces
        forms = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        self.points = np.frombuffer("".join(forms).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.at = np.concatenate([[0], np.cumsum([len(f) for f in forms])]).astype(np.int64)
        n = len(self.points)
        marks = self.points == _MARK
        begins = marks.copy()
        begins[1:] &= ~marks[:-1]
        firsts = self.at[:-1]
        begins[firsts[firsts < n]] = True
        self.unit_start = np.flatnonzero(begins)
        self.unit_end = np.append(self.unit_start[1:], n) if n else self.unit_start
        self.text_of_unit = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(self.unit_start, self.at)))
        self.kind = lexicon.numbers(self.points, self.unit_start, self.unit_end)
        for name in ("first_edge", "degree", *Lexicon._EDGES):
            setattr(self, name, getattr(lexicon, name))
        self.kind_node, self.unit_ids, self.unit_ids_at = lexicon.unit_node, lexicon.ids, lexicon.ids_at

    def node(self, place: np.ndarray, unit: np.ndarray) -> np.ndarray:
        return self.kind_node[self.kind[unit]] + place - self.unit_start[unit]

    def walk(self, path: np.ndarray, unit: np.ndarray, place: np.ndarray, keys: np.ndarray, name: str) -> None:
        """From a place in each unit, draws edges to the unit's end; ``path`` gets them."""
        place, text = place.copy(), self.text_of_unit[unit]
        base, end = self.kind_node[self.kind[unit]] - self.unit_start[unit], self.unit_end[unit]
        # The key and the place in the text come as one number.
        with np.errstate(over="ignore"):
            key = _named(keys, name)[text] - self.at[text].astype(np.uint64)
        while len(place):
            node = base + place
            edge = self.first_edge[node]
            u = _uniform(key, place)
            on = np.flatnonzero((u > self.up_to[edge]) & ~self.alone[edge])
            last = edge[on] + self.degree[node[on]] - 1
            while len(on):
                edge[on] += 1
                further = (u[on] > self.up_to[edge[on]]) & (edge[on] < last)
                on, last = on[further], last[further]
            path[place] = edge
            place = place + self.length[edge]
            go = place < end
            if not go.all():
                place, base, end, key = place[go], base[go], end[go], key[go]

    def ids_of(self, path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids along a path, text after text, and the places before each text."""
        places = np.flatnonzero(path >= 0)
        ids = self.id[path[places]]
        counts = np.ones(len(ids), np.int64)
        wide = np.flatnonzero(ids < 0)
        spelt = [self.pieces.of_byte[np.frombuffer(chr(-1 - int(i)).encode("utf-8", "surrogatepass"), np.uint8)] for i in ids[wide]]
        counts[wide] = [len(s) for s in spelt]
        before = np.concatenate([[0], np.cumsum(counts)])
        out = np.repeat(ids, counts)
        for i, s in zip(wide.tolist(), spelt, strict=True):
            out[before[i] : before[i + 1]] = s
        return out, before[np.searchsorted(places, self.at)]

    def encoded(self) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids, text after text, and the places before each text."""
        starts = self.unit_ids_at[self.kind]
        counts = self.unit_ids_at[self.kind + 1] - starts
        before = np.concatenate([[0], np.cumsum(counts)])
        ids = self.unit_ids[np.arange(before[-1]) + np.repeat(starts - before[:-1], counts)]
        return ids, before[np.searchsorted(self.unit_start, self.at)]

    def sample(self, keys: np.ndarray, samples: int) -> list[dict[str, np.ndarray]]:
        """For each sample: path, there (by text), log_prob, perturbed and inclusion."""
        n_texts, n = len(self.at) - 1, len(self.points)
        text_of = np.repeat(np.arange(n_texts), np.diff(self.at)).astype(np.int32)
        filled = np.diff(self.at) > 0
        with np.errstate(divide="ignore"):
            top = -np.log(-np.log(_uniform(_named(keys, "top"), np.zeros(n_texts))))
        drawn: list[dict] = []
        path = np.full(n, -1, np.int32)
        self.walk(path, np.arange(len(self.unit_start)), self.unit_start, keys, "walk 0")
        turn = self.at[:-1].copy()  # where a path left the one it comes from
        barred = np.zeros((n_texts, 0), np.int64)  # edges that are not free there
        there = np.ones(n_texts, bool)
        for number in range(samples):
            places = np.flatnonzero(path >= 0)
            edges, text = path[places], text_of[places]
            cuts = np.searchsorted(places, self.at)
            sums = np.concatenate([[0.0], np.cumsum(self.log_p[edges])])
            log_prob = np.zeros(n_texts)
            has = np.flatnonzero(np.diff(cuts))
            if len(has):
                log_prob[has] = np.add.reduceat(self.log_p[edges], cuts[:-1][has])
            # Regions: the path up to a place, then another edge.
            free = 1.0 - self.p[edges]
            free[self.alone[edges]] = 0.0
            if barred.shape[1]:
                spots = np.flatnonzero(places == turn[text])
                taken = barred[text[spots]]
                real = taken >= 0
                free[spots] -= np.where(real, self.p[taken], 0.0).sum(axis=1)
                free[spots[real.sum(axis=1) + 1 >= self.degree[self._node_of(places[spots])]]] = 0.0
            with np.errstate(divide="ignore"):
                mass = sums[:-1] - np.repeat(sums[cuts[:-1]], np.diff(cuts)) + np.log(np.where(free > 0, np.maximum(free, 1e-300), 0.0))
            if number:
                mass[(places < turn[text]) | ~there[text]] = -np.inf
            values = _cut_gumbel(mass, top[text], _uniform((_named(keys, f"region {number}") - self.at[:-1].astype(np.uint64))[text], places))
            drawn.append(
                {"path": path, "there": there, "log_prob": log_prob, "perturbed": top, "places": places, "values": values, "cuts": cuts, "turn": turn, "barred": barred}
            )
            best, best_value, best_place = self._best(drawn, filled)
            if number == samples - 1:
                break
            there = np.isfinite(best_value) & filled
            top = np.where(there, best_value, -np.inf)
            turn = np.where(there, best_place, self.at[1:])
            # The paths that are left keep what lies before the turn.
            path = np.full(n, -1, np.int32)
            width = max(d["barred"].shape[1] for d in drawn) + 1
            barred = np.full((n_texts, width), -1, np.int64)
            for i, d in enumerate(drawn):
                mine = there & (best == i)
                if not mine.any():
                    continue
                kept = d["places"][mine[text_of[d["places"]]]]
                kept = kept[kept < turn[text_of[kept]]]
                path[kept] = d["path"][kept]
                barred[mine, width - 1] = d["path"][turn[mine]]
                again = mine & (d["turn"] == turn)
                barred[again, : d["barred"].shape[1]] = d["barred"][again]
                # The region is opened: it waits no longer.
                spot = np.searchsorted(d["places"], turn[mine])
                d["values"][spot] = -np.inf
            texts = np.flatnonzero(there)
            if len(texts):
                edge = self._other_edge(turn[texts], barred[texts], _uniform(_named(keys, f"turn {number + 1}")[texts], turn[texts] - self.at[texts]))
                path[turn[texts]] = edge
                unit = np.searchsorted(self.unit_start, turn[texts], side="right") - 1
                place = turn[texts] + self.length[edge]
                on = place < self.unit_end[unit]
                later = np.flatnonzero(there[self.text_of_unit] & (self.unit_start > turn[self.text_of_unit]))
                self.walk(path, np.concatenate([unit[on], later]), np.concatenate([place[on], self.unit_start[later]]), keys, f"walk {number + 1}")
        for d in drawn:
            with np.errstate(over="ignore", invalid="ignore"):
                d["inclusion"] = np.where(np.isfinite(best_value), -np.expm1(-np.exp(np.minimum(d["log_prob"] - best_value, 700.0))), 1.0)
        # A text without characters has one segmentation.
        for number, d in enumerate(drawn):
            d["there"] = d["there"] & (filled | (number == 0))
        return drawn

    def _node_of(self, places: np.ndarray) -> np.ndarray:
        return self.node(places, np.searchsorted(self.unit_start, places, side="right") - 1)

    def _best(self, drawn: list[dict], filled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text: the path whose region is best, its value and its place."""
        n_texts = len(filled)
        best, value, place = np.zeros(n_texts, int), np.full(n_texts, -np.inf), np.full(n_texts, -1)
        for i, d in enumerate(drawn):
            has = np.flatnonzero(np.diff(d["cuts"]) > 0)
            if not len(has):
                continue
            most = np.maximum.reduceat(d["values"], d["cuts"][:-1][has])
            wins = most > value[has]
            equal = np.flatnonzero(d["values"] == np.repeat(most, np.diff(d["cuts"])[has]))
            owner = np.repeat(has, np.diff(d["cuts"])[has])[equal]
            _, first = np.unique(owner, return_index=True)
            best[has[wins]] = i
            value[has[wins]] = most[wins]
            place[has[wins]] = d["places"][equal[first]][wins]
        return best, value, place

    def _other_edge(self, place: np.ndarray, barred: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge at each place that is not barred, by the edges' probabilities."""
        node = self._node_of(place)
        first, degree = self.first_edge[node], self.degree[node]
        weights = []
        for step in range(int(degree.max())):
            edge = np.minimum(first + step, len(self.p) - 1)
            open_ = (step < degree) & ~(barred == edge[:, None]).any(axis=1)
            weights.append((edge, open_, np.where(open_, np.maximum(self.p[edge], 1e-300), 0.0)))
        goal, reached = u * sum(w for *_, w in weights), np.zeros(len(place))
        chosen, last = np.full(len(place), -1, np.int64), np.full(len(place), -1, np.int64)
        for edge, open_, weight in weights:
            reached += weight
            last = np.where(open_, edge, last)
            chosen = np.where(open_ & (chosen < 0) & (reached >= goal), edge, chosen)
        return np.where(chosen < 0, last, chosen)


_SAMPLE = "struct<rank: int, log_prob: double, perturbed: double, inclusion: double, ids: array<int>>"
_SAMPLE_TYPE = pa.list_(
    pa.struct([("rank", pa.int32()), ("log_prob", pa.float64()), ("perturbed", pa.float64()), ("inclusion", pa.float64()), ("ids", pa.list_(pa.int32()))])
)


def read_model(path: str) -> bytes:
    system, inner = fs.FileSystem.from_uri(path if "://" in path else Path(path).resolve().as_uri())
    with system.open_input_stream(inner) as stream:
        return stream.read()


def _id_lists(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))


def _answer(part: pa.RecordBatch, lexicon: Lexicon, samples: int) -> pa.RecordBatch:
    texts = [t or "" for t in part.column("text").to_pylist()]
    lattices, pieces = Lattices(texts, lexicon), lexicon.pieces
    keys = mix(part.column("_key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ seed("row"))
    ids, at = lattices.encoded()
    drawn = lattices.sample(keys, samples)
    wanted = "".join(t.replace(MARK, " ") for t in texts).encode()
    same = pieces.decode_flat(ids, at)[0].tobytes() == wanted
    # Samples of a text stand together: rank by rank they are dealt to the texts.
    there = np.stack([d["there"] for d in drawn])
    counts = there.sum(axis=0)
    flats = [lattices.ids_of(d["path"]) for d in drawn]
    for d, (own, places) in zip(drawn, flats, strict=True):
        if d["there"].all():
            same &= pieces.decode_flat(own, places)[0].tobytes() == wanted
    text, rank = np.nonzero(there.T)
    sizes = np.stack([np.diff(places) for _, places in flats])[rank, text] if len(text) else np.zeros(0, int)
    ends = np.cumsum(sizes)
    all_ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
    for number, (own, places) in enumerate(flats):
        mine = rank == number
        lengths = sizes[mine]
        source = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        all_ids[np.repeat(ends[mine] - lengths, lengths) + source] = own[np.repeat(places[text[mine]], lengths) + source]
    field = lambda name: np.stack([d[name] for d in drawn])[rank, text]
    structs = pa.StructArray.from_arrays(
        [
            pa.array((rank + 1).astype(np.int32)),
            pa.array(field("log_prob")),
            pa.array(field("perturbed")),
            pa.array(field("inclusion")),
            _id_lists(all_ids, np.concatenate([[0], ends])),
        ],
        fields=list(_SAMPLE_TYPE.value_type),
    )
    new = {
        "ids": _id_lists(ids, at),
        "samples": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), structs),
        "round_trip": pa.array(np.full(len(texts), bool(same)) if same else _each_round_trip(texts, pieces, ids, at)),
    }
    kept = part.drop_columns(["_key"])
    return pa.RecordBatch.from_arrays([*kept.columns, *new.values()], names=[*kept.schema.names, *new])


def _each_round_trip(texts: list[str], pieces: Pieces, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    data, places = pieces.decode_flat(ids, at)
    whole = data.tobytes()
    return np.array([whole[a:b].decode("utf-8", "replace") == t.replace(MARK, " ") for a, b, t in zip(places[:-1], places[1:], texts, strict=True)])


def segment(docs: DataFrame, model: str, key: str = "doc_id", samples: int = SAMPLES, alpha: float = ALPHA) -> DataFrame:
    """Documents with ids (the library's), samples (by rank) and round_trip.

    ``model`` is the path of a model file, ``key`` the column that seeds the samples.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_model(model))
    kept = docs.drop("ids", "samples", "round_trip", "_key")
    schema = kept.selectExpr("*", "cast(NULL AS array<int>) AS ids", f"cast(NULL AS array<{_SAMPLE}>) AS samples", "true AS round_trip").schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(Pieces(shared.value, alpha))
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                yield _answer(part, lexicon, samples)

    seeded = kept.withColumn("_key", F.coalesce(F.xxhash64(F.col(key)), F.lit(0)))
    return seeded.mapInArrow(task, schema)


def decode(docs: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """Documents with ``decoded``: the text of the ids; null ids give null."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model))
    kept = docs.drop("decoded")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value)
        for batch in batches:
            lists = batch.column(ids).to_pylist()
            texts = [None if x is None else b"".join(pieces.bytes_of[i] for i in x)[1:].decode("utf-8", "replace") for x in lists]
            yield batch.append_column("decoded", pa.array(texts, pa.string()))

    return kept.mapInArrow(task, kept.withColumn("decoded", F.lit("")).schema)
