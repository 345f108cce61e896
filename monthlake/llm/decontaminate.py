"""Benchmark decontamination with a generalised suffix automaton (operator 8).

The items' words make one automaton. Documents stream through it word by word; the
state and the matched length give the longest run of words, ending here, that some
item has too. Where it reaches the window, the last ``window`` words are an item's.
Words that no item has, and neighbours that no item has as neighbours, reset it, so
numpy picks the runs that can match and only those are streamed.

An automaton takes about ``bytes_per_automaton`` of item text, and that is all that is
sent to the tasks. A larger benchmark is dealt by a hash of the items into several
automata; documents stream through one after the other and their hits add up.

Defined results: null or empty texts have no words and no hits. Items without words
take no part; equal ids count as one item; one without an id hits words but is not named. Repeated documents are each
answered. An empty benchmark hits nothing. Other columns are passed through; columns
named like those that are added are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.llm.flat import Words, byte_table, mix, slices, texts
from monthlake.work import stored

WINDOW = 10
BYTES_PER_AUTOMATON = 8 << 20
#: Words are runs of other bytes than 00-2F, 3A-60 and 7B-7F, after A-Z became a-z.
WORD_BYTES = ~byte_table((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

_HITS = "hits array<struct<first: int, last: int, from_byte: int, to_byte: int, short: boolean>>"
_ADDED = f"n_words long, longest int, hit_items array<string>, {_HITS}"
_HIT_TYPE = pa.list_(
    pa.struct([*((name, pa.int32()) for name in ("first", "last", "from_byte", "to_byte")), ("short", pa.bool_())])
)
_TYPES = {
    "n_words": pa.int64(),
    "longest": pa.int32(),
    "hit_items": pa.list_(pa.string()),
    "hits": _HIT_TYPE,
}


class SuffixAutomaton:
    """All runs of words of all items: ``step`` follows a word from a state."""

    def __init__(self, items: list[tuple[str | None, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        ends: dict[int, set[str | None]] = {}
        short: dict[int, list[tuple[int, str | None]]] = {}
        for name, words in items:
            state = 0
            for word in words:
                state = self._extend(state, word)
                if len(words) >= window:
                    ends.setdefault(state, set()).add(name)
        # States of long items hand their items to the shorter suffixes, down to the window.
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            shorter = self.link[state]
            if state in ends and self.length[shorter] >= window:
                ends.setdefault(shorter, set()).update(ends[state])
        for name, words in items:
            if len(words) < window:
                state = 0
                for word in words:
                    state = self.next[state][word]
                short.setdefault(state, []).append((len(words), name))
        self.ends = {state: tuple(names) for state, names in ends.items()}
        self.short = short
        #: The nearest state on the way to ever shorter suffixes that ends a short item.
        self.short_at = [-1] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            up = self.link[state]
            self.short_at[state] = state if state in short else self.short_at[up] if up >= 0 else -1

    def _new(self, length: int, arrows: dict[int, int], link: int) -> int:
        self.next.append(arrows)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, state: int, word: int) -> int:
        """The state of exactly the runs that are ``state``'s and one word; made if need be."""
        old = self.next[state][word]
        if self.length[old] == self.length[state] + 1:
            return old
        own = self._new(self.length[state] + 1, dict(self.next[old]), self.link[old])
        self.link[old] = own
        while state >= 0 and self.next[state].get(word) == old:
            self.next[state][word] = own
            state = self.link[state]
        return own

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._new(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word)
        return new

    def stream(self, words: list[int]) -> Iterator[tuple[int, int, int, tuple[str, ...] | list[str], bool]]:
        """For each place: matched length, length of the hit that ends here, its items, whether one is short."""
        arrows, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for place, word in enumerate(words):
            while state > 0 and word not in arrows[state]:
                state = link[state]
                matched = length[state]
            target = arrows[state].get(word)
            if target is None:
                continue
            state, matched = target, matched + 1
            hit, names, short = 0, (), False
            if matched >= window:
                at = state
                while length[link[at]] >= window:
                    at = link[at]
                if at in self.ends:
                    hit, names = window, self.ends[at]
            at = self.short_at[state]
            while at > 0:
                for size, name in self.short.get(at, ()):
                    if size <= matched:
                        hit, names, short = max(hit, size), [*names, name], True
                at = self.short_at[link[at]]
            yield place, matched, hit, names, short


class Matcher:
    """An automaton and the word and neighbour tables that choose what it reads."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        column = pa.array([text for _, text in items], pa.string())
        words = Words(*texts(column), WORD_BYTES)
        hashes = words.hashes()
        self.vocabulary, numbers = np.unique(hashes, return_inverse=True)
        pairs, lists = [], []
        for i, (name, _) in enumerate(items):
            own = numbers[words.of_text[i] : words.of_text[i + 1]]
            if len(own):
                lists.append((name, own.tolist()))
                pairs.append(own[:-1].astype(np.uint64) << np.uint64(32) | own[1:].astype(np.uint64))
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.uint64)
        self.least = min([window, *(len(own) for _, own in lists)])
        self.automaton = SuffixAutomaton(lists, window)

    @staticmethod
    def _find(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The place of each value, or -1."""
        if len(sorted_values) == 0:
            return np.full(len(values), -1)
        place = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
        return np.where(sorted_values[place] == values, place, -1)

    def matches(self, words: Words) -> list[tuple[int, set[str], list[tuple[int, int, bool]]]]:
        """For each text: the longest match, the items hit, and runs of hit words."""
        numbers = self._find(self.vocabulary, words.hashes())
        joined = np.zeros(len(numbers), bool)  # to the word before
        both = np.flatnonzero((numbers[1:] >= 0) & (numbers[:-1] >= 0)) if len(numbers) > 1 else np.zeros(0, np.int64)
        if len(both):
            pair = numbers[both].astype(np.uint64) << np.uint64(32) | numbers[both + 1].astype(np.uint64)
            joined[both + 1] = self._find(self.pairs, pair) >= 0
        firsts = words.of_text[:-1]
        joined[firsts[firsts < len(numbers)]] = False
        run_starts = np.flatnonzero(~joined)
        run_ends = np.append(run_starts[1:], len(numbers))
        runs = (run_ends - run_starts >= self.least) & (numbers[run_starts] >= 0) if len(numbers) else []
        found: list = [(0, set(), []) for _ in range(len(words.at) - 1)]
        starts, ends = (run_starts[runs], run_ends[runs]) if len(numbers) else ((), ())
        owners = np.searchsorted(words.of_text, starts, side="right") - 1 if len(starts) else ()
        for start, end, owner in zip(starts, ends, owners, strict=True):
            longest, names, spans = found[owner]
            for place, matched, hit, items, short in self.automaton.stream(numbers[start:end].tolist()):
                longest = max(longest, matched)
                if hit:
                    names.update(name for name in items if name is not None)
                    last = int(start) + place
                    first = last - hit + 1
                    while spans and first <= spans[-1][1] + 1:
                        before = spans.pop()
                        first, short = min(first, before[0]), short or before[2]
                    spans.append((first, last, short))
            found[owner] = (longest, names, spans)
        return found


def _merged(spans: list[tuple[int, int, bool]]) -> list[tuple[int, int, bool]]:
    out: list[tuple[int, int, bool]] = []
    for first, last, short in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]), short or out[-1][2])
        else:
            out.append((first, last, short))
    return out


def _automata(items: DataFrame, window: int, size: int) -> Iterator[list[tuple[str, str]]]:
    """The items, in lists whose text takes about ``size`` bytes."""
    named = items.select(F.col("item_id").cast("string").alias("item"), "text").where("text IS NOT NULL")
    total = named.agg(F.sum(F.octet_length("text") + F.coalesce(F.octet_length("item"), F.lit(0)))).first()[0] or 0
    parts = -(-total // size)
    for part in range(parts):
        chosen = named.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part)
        if rows := [(row.item, row.text) for row in chosen.toLocalIterator()]:
            yield sorted(rows, key=lambda row: (row[0] or "", row[1]))


def match_items(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    bytes_per_automaton: int = BYTES_PER_AUTOMATON,
) -> DataFrame:
    """Documents with n_words, longest (match, in words), hit_items and hits.

    ``longest`` is 0 where no match is as long as the shortest window. ``hits`` are runs of hit words, with the first and last word's number and the bytes
    they lie in; ``short`` says that an item of fewer words than the window is among them;
    ``items`` has item_id and text.
    """
    spark = docs.sparkSession
    kept = docs.drop(*_TYPES)
    frame = kept.select(
        *(kept[c] for c in kept.columns),
        F.lit(None).cast("long").alias("n_words"),
        F.lit(0).alias("longest"),
        F.lit(None).cast("array<string>").alias("hit_items"),
        F.lit(None).cast(_HITS.removeprefix("hits ")).alias("hits"),
    )
    matcher = None
    for rows in _automata(items, window, bytes_per_automaton) if bytes_per_automaton else ():
        if matcher:
            frame = stored(frame, "decontaminate")
            matcher.destroy()
        matcher = spark.sparkContext.broadcast(Matcher(rows, window))
        frame = frame.mapInArrow(_task(matcher), frame.schema)
    if matcher is None:
        frame = frame.mapInArrow(_task(spark.sparkContext.broadcast(Matcher([], window))), frame.schema)
    return frame


def _task(matcher):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield _answer(part, matcher.value)

    return task


def _answer(part: pa.RecordBatch, matcher: Matcher) -> pa.RecordBatch:
    words = Words(*texts(part.column("text")), WORD_BYTES)
    old = [part.column(name).to_pylist() for name in ("longest", "hit_items", "hits")]
    longests, names, hits = [], [], []
    for i, (longest, items, spans) in enumerate(matcher.matches(words)):
        base, byte = int(words.of_text[i]), int(words.at[i])
        before = [(base + h["first"], base + h["last"], h["short"]) for h in old[2][i] or ()]
        longests.append(max(longest, old[0][i] or 0))
        names.append(sorted(items.union(old[1][i] or ())))
        hits.append(
            [
                {
                    "first": a - base,
                    "last": b - base,
                    "from_byte": int(words.start[a]) - byte,
                    "to_byte": int(words.end[b]) - byte,
                    "short": short,
                }
                for a, b, short in _merged(spans + before)
            ]
        )
    new = {
        "n_words": pa.array(words.counts(), pa.int64()),
        "longest": pa.array(longests, pa.int32()),
        "hit_items": pa.array(names, _TYPES["hit_items"]),
        "hits": pa.array(hits, _HIT_TYPE),
    }
    return pa.RecordBatch.from_arrays(
        [new.get(name, part.column(i)) for i, name in enumerate(part.schema.names)],
        names=part.schema.names,
    )


def n_hit() -> F.Column:
    """Hit words of a document of ``match_items``."""
    return F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["last"] - h["first"] + 1)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    least_span: int = WINDOW,
    most_coverage: float = 0.5,
    bytes_per_automaton: int = BYTES_PER_AUTOMATON,
) -> DataFrame:
    """Documents without the passages of items; the same columns.

    Hit runs of ``least_span`` words or more, and those with a whole item of fewer words
    than the window, are cut out of the text. A document of
    whose words more than ``most_coverage`` are hit goes as a whole. Documents without
    hits stay as they are. ``n_chars``, if there is one, follows the text.
    """
    names = docs.columns
    matched = match_items(docs, items, window, bytes_per_automaton).where(
        n_hit() <= F.col("n_words") * most_coverage
    )
    long_hits = F.filter("hits", lambda h: (h["last"] - h["first"] + 1 >= least_span) | h["short"])
    raw = F.col("text").cast("binary")
    # What stands between the hits: from the end of one to the start of the next.
    starts = F.concat(F.array(F.lit(0)), F.transform(long_hits, lambda h: h["to_byte"]))
    ends = F.concat(F.transform(long_hits, lambda h: h["from_byte"]), F.array(F.octet_length("text")))
    pieces = F.transform(
        F.arrays_zip(starts.alias("a"), ends.alias("b")),
        lambda p: F.substring(raw, p["a"] + 1, p["b"] - p["a"]).cast("string"),
    )
    cut = F.when(F.size(long_hits) > 0, F.array_join(pieces, "")).otherwise(F.col("text"))
    changed = matched.withColumn("text", cut)
    if "n_chars" in names:
        touched = F.size(long_hits) > 0
        changed = changed.withColumn(
            "n_chars",
            F.when(touched, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")),
        )
    return changed.select(*names)


def items_digest(items: F.Column) -> F.Column:
    """Lowercase hex SHA-256 of the ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.sort_array(items), ",").cast("binary"), 256)


EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()
