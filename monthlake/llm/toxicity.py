"""Toxicity of texts after noisy-channel deobfuscation (operator 10).

A character trigram model is counted over the words of all documents. Words that look
disguised (letters with digits, signs or separators among them, equal letters in a row,
letters of any script or short fragments with blanks between them) become lattices: each sign may stand
for a letter, be dropped or be itself; a run may be one or two characters; a separator
may be nothing or the end of a word. Viterbi finds the likeliest letters under the
channel's and the model's costs. Words and restored words are then scored: the weights
of whole words, their beginnings and endings come from a bounded sample of labelled
rows (``max_rows``), the combination of the strongest from a logistic regression on the
half of the sample that did not give the weights.

Defined results: null, empty and word-less texts get the score of a text in which nothing
speaks for toxicity. Without labels, or with labels of one kind, every text gets the
share of toxic ones (one half without any). Labels other than 0 and 1, of null ids and of
unknown ids are not used; several labels of an id count as the largest. Repeated rows are
each answered. Other columns are passed through; ``score`` is replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.llm.evidence import BITS, Evidence, fit_logistic, gather, labelled_sample, logit, sigmoid
from monthlake.llm.flat import LOWER, SpanHashes, Words, byte_table, mix, seed, slices, texts

MAX_LABELLED = 20_000
THRESHOLD = 0.3
_TOP = 3
_DENSE = _TOP + 2
_PRIOR_ROWS = 15.0
_WEAK = 0.15

# Letters that a sign is used for.
_LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
_SEPARATORS = set(" .-_*~'\"/\\,:;^`#=")
# Channel costs, as logarithms of probabilities.
_AS_LETTER, _DROPPED_SIGN, _DROPPED_DIGIT, _SEPARATOR = (math.log(p) for p in (0.4, 0.01, 1e-6, 0.9))
_WORD_END = {" ": math.log(0.03)}
_WORD_END_AT_SIGN = math.log(0.002)
#: A run of two is meant more often than one of three or more; the other reading is one character.
_TWICE, _ONCE, _LONG_TWICE, _LONG_ONCE = (math.log(p) for p in (0.95, 0.05, 0.4, 0.6))

_CLASSES = 64
_LETTER_BYTES = byte_table((0x61, 0x7A), (0x80, 0xFF))
_SIGN_BYTES = np.isin(np.arange(256), [ord(c) for c in _LEET if ord(c) < 128])
_FAR_SIGNS = tuple(c.encode() for c in _LEET if ord(c) >= 128)
#: Characters of a fragment of a word that blanks divide. Longer ones would make most short words of a text suspects.
_FRAGMENT = 2
#: Runs of short tokens longer than this are cut where no letter is within so many tokens.
_LONG_RUN, _NEAR_LETTER = 24, 8
_TOKEN_BYTES = ~byte_table((0x20, 0x20), (0x09, 0x0D))
_WORD_BYTES = byte_table((0x30, 0x39), (0x61, 0x7A), (0x41, 0x5A), (0x80, 0xFF))
_EDGE = " .,;:?\"'()[]{}*#%&-_=~`/\\<>^"


def char_class(point: int) -> int:
    """0 for what ends a word, 1-26 for a-z, 27-58 for other letters."""
    char = chr(point)
    if "a" <= char <= "z":
        return point - 96
    return 27 + point % 32 if char.isalpha() else 0


_CLASS_OF = np.array([char_class(p) for p in range(0x3000)], np.uint8)


def _classes(points: np.ndarray) -> np.ndarray:
    far = points >= len(_CLASS_OF)
    out = _CLASS_OF[np.where(far, 0, points)]
    if far.any():
        out = np.where(far, 27 + points % 32, out)
    return out.astype(np.int64)


class CharModel:
    """Log-probability of a character class after two others: logs[a, b, c]."""

    def __init__(self, counts: np.ndarray, drawn: float = 5.0):
        n = counts.reshape(_CLASSES, _CLASSES, _CLASSES).astype(float)
        single = n.sum((0, 1)) + 1
        single /= single.sum()
        pairs = n.sum(0)
        second = (pairs + drawn * single) / (pairs.sum(1, keepdims=True) + drawn)
        self.logs = np.log((n + drawn * second[None]) / (n.sum(2, keepdims=True) + drawn))
        self.table = self.logs.tolist()


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_CLASSES**3, np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            joined = "\n".join(["", "", *(t or "" for t in part.column("text").to_pylist()), ""])
            c = _classes(np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32))
            a, b, c = np.where(c[1:-1] == 0, 0, c[:-2]), c[1:-1], c[2:]
            used = (b > 0) | (c > 0)
            total += np.bincount(((a * _CLASSES + b) * _CLASSES + c)[used], minlength=len(total))
    yield pa.RecordBatch.from_pydict(
        {
            "block": pa.array(range(_CLASSES), pa.int32()),
            "n": pa.array([x.tobytes() for x in total.reshape(_CLASSES, -1)], pa.binary()),
        }
    )


def _add_counts(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_CLASSES**2, np.int64)
    for batch in batches:
        for n in batch.column("n").to_pylist():
            total += np.frombuffer(n, np.int64)
    yield pa.RecordBatch.from_pydict({"block": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([total.tobytes()], pa.binary())})


def train_char_model(docs: DataFrame) -> CharModel:
    """Trigrams of all words of all documents; the table has a fixed size."""
    schema = "block int, n binary"
    counted = docs.select(F.lower("text").alias("text")).mapInArrow(_count_task, schema).groupBy("block").applyInArrow(_add_counts, schema)
    counts = np.zeros((_CLASSES, _CLASSES**2), np.int64)
    for row in counted.toLocalIterator():
        counts[row.block] = np.frombuffer(row.n, np.int64)
    return CharModel(counts)


def restore(token: str, model: CharModel) -> str:
    """The likeliest letters behind a lower-case token; words are divided by blanks."""
    table = model.table
    beam = {(0, 0): (0.0, "")}

    def emit(beam: dict, options: list[tuple[str, float]]) -> dict:
        """Each option is letters (or "" for nothing, or " " for a word's end) and a cost."""
        out: dict = {}
        for (a, b), (score, text) in beam.items():
            for letters, cost in options:
                x, y, s = a, b, score + cost
                for letter in letters:
                    c = 0 if letter == " " else char_class(ord(letter))
                    if c == 0 and letter != " ":
                        s += -12.0  # a sign that stays ends no word, but is no letter
                        continue
                    if c == 0 and y == 0:
                        s += -12.0
                        continue
                    s += table[x][y][c]
                    x, y = (0, 0) if c == 0 else (y, c)
                key = (x, y)
                if key not in out or s > out[key][0]:
                    out[key] = (s, text + letters)
        return out

    for run in re.finditer(r"(.)\1*", token, re.DOTALL):
        char, n = run[1], len(run[0])
        if char in _SEPARATORS:
            beam = emit(beam, [("", _SEPARATOR), (" ", _WORD_END.get(char, _WORD_END_AT_SIGN))])
            continue
        readings = [(char, 0.0)]
        if char in _LEET:
            dropped = _DROPPED_DIGIT if char.isdigit() else _DROPPED_SIGN
            readings = [*((letter, _AS_LETTER) for letter in _LEET[char]), ("", dropped)]
        if n > 1:
            once, twice = (_ONCE, _TWICE) if n == 2 else (_LONG_ONCE, _LONG_TWICE)
            readings = [(r, c + once) for r, c in readings] + [(r + r, c + twice) for r, c in readings if r]
        beam = emit(beam, readings)
    ended = {k: (s + (table[k[0]][k[1]][0] if k[1] else 0.0), text) for k, (s, text) in beam.items()}
    return max(ended.values(), key=lambda x: x[0])[1].strip()


def _suspects(lowered: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of what looks disguised, as bytes of ``lowered``."""
    tokens = Words(lowered, at, _TOKEN_BYTES)
    if not len(tokens):
        none = np.zeros(0, np.int64)
        return none, none, none
    sums = lambda mask: np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
    within = lambda s: s[tokens.end] - s[tokens.start]
    letter = _LETTER_BYTES[lowered]
    letters, signs = within(sums(letter)), within(sums(_SIGN_BYTES[lowered]))
    # Characters, as the bytes that do not continue one.
    chars = within(sums((lowered & 0xC0) != 0x80))
    twice = np.zeros(len(tokens), bool)  # two equal letters in a row
    for width in (1, 2, 3):  # bytes of a letter
        if len(lowered) >= 2 * width:
            same = lowered[width:] == lowered[:-width]
            n = len(same) - width + 1
            starts = lowered[width : width + n] >= 0xC0 if width > 1 else letter[1:] & (lowered[1:] < 0x80)
            doubled = np.zeros(len(lowered), bool)  # by their last byte
            doubled[2 * width - 1 :] = np.all([same[k : k + n] for k in range(width)], axis=0) & starts
            seen = sums(doubled)
            twice |= seen[tokens.end] - seen[np.minimum(tokens.start + 2 * width - 1, tokens.end)] > 0
    # What stands between letters or signs, other than at the token's ends.
    inside = letter | _SIGN_BYTES[lowered]
    here = np.flatnonzero(inside)
    gaps = np.zeros(len(lowered), bool)
    if len(here) > 1:
        gaps[here[1:]] = np.diff(here) > 1  # the gap before a letter or sign
    broken = np.zeros(len(tokens), bool)
    gap = sums(gaps)
    first = np.searchsorted(here, tokens.start)  # the token's first letter or sign
    after = np.append(here, len(lowered))[first] + 1
    some = after <= tokens.end
    broken[some] = gap[tokens.end[some]] - gap[after[some]] > 0
    marked = (letters >= 1) & ((signs >= 1) | twice | broken)
    whole = lowered.tobytes()
    far = np.zeros(len(lowered), bool)
    for sign in _FAR_SIGNS:
        place = whole.find(sign)
        while place >= 0:
            far[place] = True
            place = whole.find(sign, place + 1)
    marked |= within(sums(far)) > 0
    owner = tokens.text_index()
    plain = letters + signs == tokens.end - tokens.start

    # Tokens with a letter at most so many tokens away.
    lettered = np.concatenate([[0], np.cumsum(letters > 0)])
    number = np.arange(len(tokens))
    near = lettered[np.minimum(number + _NEAR_LETTER + 1, len(tokens))] > lettered[np.maximum(number - _NEAR_LETTER, 0)]

    def runs(short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last token of three or more short ones in a row, however far apart.

        Of longer runs than a word has, what is far from any letter is no word: such as rows of numbers.
        """
        firsts, lasts = in_a_row(short)
        long = lasts - firsts >= _LONG_RUN
        edges = np.zeros(len(tokens) + 1, np.int64)
        edges[firsts[long]] += 1
        edges[lasts[long] + 1] -= 1
        return in_a_row(short & (near | (np.cumsum(edges[:-1]) == 0)))

    def in_a_row(short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        joined = np.zeros(len(tokens), bool)
        joined[1:] = short[1:] & short[:-1] & (owner[1:] == owner[:-1])
        firsts = np.flatnonzero(~joined)
        lasts = np.append(firsts[1:], len(tokens)) - 1
        long = lasts - firsts >= 2
        return firsts[long], lasts[long]

    alone = plain & (chars == 1)
    singles = runs(alone)
    firsts, lasts = runs(plain & (chars <= _FRAGMENT))
    mixed = ~(np.isin(firsts, singles[0]) & np.isin(lasts, singles[1]))
    firsts, lasts = np.append(singles[0], firsts[mixed]), np.append(singles[1], lasts[mixed])
    keep = np.flatnonzero(marked & ~alone)
    return (
        np.concatenate([owner[keep], owner[firsts]]),
        np.concatenate([tokens.start[keep], tokens.start[firsts]]),
        np.concatenate([tokens.end[keep], tokens.end[lasts]]),
    )


_MOST_REMEMBERED = 200_000


class Restorer:
    """Restores suspects, each distinct one once as long as it is remembered."""

    def __init__(self, model: CharModel):
        self.model = model
        self.known: dict[bytes, str] = {}

    def texts(self, data: np.ndarray, at: np.ndarray) -> list[str]:
        """For each text, the restored words, divided by blanks."""
        lowered = LOWER[data]
        out: list[list[str]] = [[] for _ in range(len(at) - 1)]
        whole = lowered.tobytes()
        for text, start, end in zip(*(x.tolist() for x in _suspects(lowered, at)), strict=True):
            raw = whole[start:end]
            word = self.known.get(raw)
            if word is None:
                token = " ".join(raw.decode("utf-8", "replace").lower().split()).strip(_EDGE).rstrip("!")
                word = restore(token, self.model) if token else ""
                if len(self.known) >= _MOST_REMEMBERED:
                    self.known.clear()
                self.known[raw] = word
            if word:
                out[text].append(word)
        return [" ".join(words) for words in out]


#: Of a word: itself, its first and its last bytes, where it is longer than these.
_ASPECTS = (("word", 0, 0), ("first 4", 4, 0), ("first 5", 5, 0), ("first 6", 6, 0), ("last 4", 0, 4), ("last 5", 0, 5))


def _word_features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets by aspect and word, -1 for none; the text of each word; words per text."""
    words = Words(data, at, _WORD_BYTES)
    hashes = SpanHashes(LOWER[data])
    buckets = np.full((len(_ASPECTS), len(words)), -1, np.int64)
    for i, (name, first, last) in enumerate(_ASPECTS):
        kept = np.flatnonzero(words.end - words.start > max(first, last))
        start, end = words.start[kept], words.end[kept]
        start, end = (end - last if last else start), (start + first if first else end)
        h = mix(hashes(start, end) ^ seed(name))
        buckets[i, kept] = h >> np.uint64(64 - BITS)
    return buckets, words.text_index(), words.counts()


def _features(part: pa.RecordBatch, restorer: Restorer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of the words and the restored words; counts are of the words alone."""
    data, at = texts(part.column("text"))
    own = _word_features(data, at)
    restored = _word_features(*texts(pa.array(restorer.texts(data, at), pa.string())))
    return np.concatenate([own[0], restored[0]], axis=1), np.concatenate([own[1], restored[1]]), own[2]


def _flat(features: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    buckets, owner, _ = features
    there = buckets >= 0
    return buckets[there], np.broadcast_to(owner, buckets.shape)[there]


def _dense(buckets: np.ndarray, owner: np.ndarray, n_words: np.ndarray, shares: np.ndarray, base: float) -> np.ndarray:
    """Per text: the logits of the strongest distinct words, by their best aspect, and the length."""
    floor = max(_WEAK, base)
    share = np.where(buckets >= 0, shares[buckets], 0).max(axis=0) if len(owner) else np.zeros(0)
    strong = np.flatnonzero(share > floor)
    _, first = np.unique(np.column_stack([owner[strong], buckets[0, strong]]), axis=0, return_index=True)
    share, owner = share[strong[first]], owner[strong[first]]
    order = np.lexsort((-share, owner))
    share, owner = share[order], owner[order]
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    out = np.full((len(n_words), _DENSE), logit(np.float64(floor)))
    for k in range(_TOP):
        at = place == k
        out[owner[at], k] = logit(np.clip(share[at].astype(np.float64), 1e-6, 1 - 1e-6))
    out[:, _TOP] = np.log1p(n_words)
    # One word that is nearly always toxic says more than its logit times a few.
    out[:, _TOP + 1] = np.maximum(out[:, 0], 0) ** 2
    return out


class ToxicityModel:
    def __init__(self, chars: CharModel, shares: np.ndarray, base: float, weights: np.ndarray):
        self.chars, self.shares, self.base, self.weights = chars, shares, base, weights

    def scores(self, part: pa.RecordBatch, restorer: Restorer) -> np.ndarray:
        x = _dense(*_features(part, restorer), self.shares, self.base)
        return sigmoid(x @ self.weights[:-1] + self.weights[-1])


def _base(evidence: Evidence) -> float:
    zero, one = evidence.rows.sum(0)
    return float((one + 1) / (zero + one + 2))


def train_toxicity(docs: DataFrame, labels: DataFrame, usable: F.Column, max_rows: int = MAX_LABELLED) -> ToxicityModel:
    """``labels`` has doc_id and toxic; ``usable`` says which of its rows may be learned from."""
    spark = docs.sparkSession
    chars = spark.sparkContext.broadcast(train_char_model(docs))
    sample = labelled_sample(labels, "toxic", usable & F.col("doc_id").isNotNull(), max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "label", "half")
    restorers: list[Restorer] = []

    def restorer() -> Restorer:
        if not restorers:
            restorers.append(Restorer(chars.value))
        return restorers[0]

    evidence = gather(rows, lambda part: _flat(_features(part, restorer())), _PRIOR_ROWS)
    base = _base(evidence)
    halves = spark.sparkContext.broadcast([evidence.shares((1,)), evidence.shares((0,))])

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                half = part.column("half").to_numpy()
                features = _features(part, restorer())
                x = np.where((half == 0)[:, None], *(_dense(*features, s, base) for s in halves.value))
                yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), part.column("label")], names=["x", "label"])

    collected = rows.mapInArrow(dense, "x array<double>, label int").collect()
    x = np.array([r.x for r in collected], float).reshape(-1, _DENSE)
    weights = fit_logistic(x, np.array([r.label for r in collected], float))
    return ToxicityModel(chars.value, evidence.shares((0, 1)), base, weights)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Documents with a score from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("score")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        restorer = Restorer(model.chars)
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.append_column("score", pa.array(model.scores(part, restorer), pa.float64()))

    return kept.mapInArrow(task, kept.withColumn("score", F.lit(0.0)).schema)


def restore_texts(docs: DataFrame, chars: CharModel) -> DataFrame:
    """Documents with ``restored``: what their disguised words stand for, divided by blanks."""
    shared = docs.sparkSession.sparkContext.broadcast(chars)
    kept = docs.drop("restored")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.append_column("restored", pa.array(restorer.texts(*texts(part.column("text"))), pa.string()))

    return kept.mapInArrow(task, kept.withColumn("restored", F.lit("")).schema)
