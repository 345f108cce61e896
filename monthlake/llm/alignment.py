"""Alignment of two tokenizers over a corpus (operator 11).

Tokenizer A is a byte-level BPE (a ``tokenizers`` JSON file), B a SentencePiece model that
puts a blank before the text. Both give the bytes of blank + text, so their tokens can be
compared by the places where they end. Places where a token of A and one of B both end cut
a text into groups; the two tokens that end there are a link.

Steps:

1. Tasks encode texts and cut groups. An array made beforehand names for each id of A the
   id of B with the same bytes. A group of one token each that agrees with it is regular:
   a task counts these in one vector as long as A's vocabulary. Only links of other groups
   are counted as pairs, summed up within the task before they are shuffled. What a text
   needs for the second step lies beside its digest in one table.
2. Counts of links: the vectors are added up by id, the pairs by pair; and the highest
   count of each id of B.
3. Texts look up the counts of their links: regular ones in vectors, and pairs that make
   up at least one of ``FREQUENT`` of all irregular links (there are no more than that
   many) in a sorted array; only the rare rest is joined, as one row per text and pair.

Broadcast are arrays of the two vocabularies' lengths and at most ``FREQUENT`` pairs.

Encoding is the libraries' own, taken word by word (A) and unit by unit (B, a run of blanks
and what follows), each distinct one once while it is remembered. Texts with characters
other than ASCII and Latin letters, where expressions of other libraries may cut
differently, are encoded by A as a whole.

Defined results: texts that are null or empty, or whose tokens' bytes are not those of
blank + text (for B: those with U+2581), have no tokens: zeros and an empty digest. Strings
of special tokens are ordinary text. Rows with a null id and repeated rows are answered
and counted each. An empty table gives no rows. Other columns are ignored. Texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.llm.flat import slices
from monthlake.llm.scratch import Scratch, small_batches
from monthlake.llm.segment import MARK, read_model

#: The frequent pairs are those with at least one of so many irregular links.
FREQUENT = 1 << 16
#: Distinct words that a task remembers, and characters in them; distinct pairs that it holds.
_WORDS, _CHARACTERS, HELD = 1 << 18, 8 << 20, 1 << 17
#: Bytes of text that a task works on at once.
_SLICE = 512 << 10

# How GPT-2's tokenizer cuts texts into words, for texts of the characters in _PLAIN.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_WORD = re.compile(rf"'(?:[sdmt]|ll|ve|re)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")
_PLAIN = re.compile("[\x00-\x1b\x20-\x7eÀ-ÖØ-öø-ɏ]*")
_UNIT = re.compile(" +[^ ]*")


def byte_level_bytes() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for.

    Printable characters of Latin-1 stand for themselves, the others for 256, 257, …
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


def _places(words: list[str], data: bytes) -> np.ndarray:
    """Where each word ends in the bytes of all."""
    first = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)  # of each character
    return np.append(first, len(data))[np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]


class _Side:
    """One tokenizer: ids of many texts, and the bytes of each id.

    Distinct words are encoded once while they are remembered, and kept flat, so that
    numpy can take their ids in any order; so is whether an encoding keeps the word's bytes.
    ``encode`` takes groups of words and gives the ids of each group, in which no token
    lies in two words.
    """

    def __init__(self, bytes_of: list[bytes], encode: Callable[[list[list[str]]], list[list[int]]], words_of: Callable[[str], list[str]], together: int):
        self.bytes_of, self.encode, self.words_of, self.together = bytes_of, encode, words_of, together
        self.lengths = np.array([len(b) for b in bytes_of], np.int64)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.characters = 0
        self.ids, self.at, self.kept = array("i"), array("q", [0]), array("b")

    def _spelt(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words one after the other, how many each has, and whether it keeps its bytes."""
        lists = self.encode([words[i : i + self.together] for i in range(0, len(words), self.together)])
        ids = np.fromiter(chain.from_iterable(lists), np.int32, sum(map(len, lists)))
        data = "".join(words).encode()
        if self._spelt(ids) == data and self.lengths[ids].all():
            # The same bytes: tokens that end where a word ends say how many ids it has.
            reached, ends = np.cumsum(self.lengths[ids]), _places(words, data)
            last = np.searchsorted(reached, ends)
            if (reached[last] == ends).all():
                return ids, np.diff(last, prepend=-1), np.ones(len(words), bool)
        # Some word's bytes are lost: each by itself.
        lists = self.encode([[word] for word in words])
        kept = [b"".join(map(self.bytes_of.__getitem__, own)) == word.encode() for own, word in zip(lists, words, strict=True)]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.int32, counts.sum()), counts, np.array(kept, bool)

    def _learn(self, words: list[str]) -> None:
        new = [word for word in dict.fromkeys(words) if word not in self.number]
        if not new:
            return
        ids, counts, kept = self._encoded(new)
        self.at.frombytes((len(self.ids) + np.cumsum(counts)).astype(np.int64).tobytes())
        self.ids.frombytes(ids.tobytes())
        self.kept.frombytes(kept.astype(np.int8).tobytes())
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
        self.characters += sum(map(len, new))

    def __call__(self, spaced: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, the places before each text, and whether it keeps its bytes."""
        if len(self.number) > _WORDS or self.characters > _CHARACTERS:
            self._forget()
        words: list[str] = []
        counts = []
        for text in spaced:
            own = self.words_of(text)
            counts.append(len(own))
            words += own
        self._learn(words)
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        # Views: they are gone before more is learned.
        all_ids, at, kept = np.frombuffer(self.ids, np.int32), np.frombuffer(self.at, np.int64), np.frombuffer(self.kept, np.bool_)
        sizes = np.diff(at)[numbers]
        before = np.concatenate([[0], np.cumsum(sizes)])
        place = np.arange(before[-1]) + np.repeat(at[numbers] - before[:-1], sizes)
        of_text = np.repeat(np.arange(len(spaced)), counts)
        lost = np.bincount(of_text[~kept[numbers]], minlength=len(spaced))
        return all_ids[place], before[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)], lost == 0


def byte_bpe(source: str) -> _Side:
    """Tokenizer A from the content of its JSON file."""
    # One thread: others would take memory and CPUs that belong to other tasks.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(source)
    tokenizer.encode_special_tokens = True
    values = byte_level_bytes()
    vocabulary = json.loads(source)["model"]["vocab"]
    bytes_of = [b""] * (1 + max(vocabulary.values()))
    for token, number in vocabulary.items():
        bytes_of[number] = bytes(values[c] for c in token)

    def encode(groups: list[list[str]]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(groups, is_pretokenized=True, add_special_tokens=False)]

    return _Side(bytes_of, encode, lambda text: _WORD.findall(text) if _PLAIN.fullmatch(text) else [text], 64)


def pieces(proto: bytes) -> _Side:
    """Tokenizer B from the content of its model file."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=proto)
    names = [library.id_to_piece(i) for i in range(library.get_piece_size())]
    bytes_of = []
    for i, name in enumerate(names):
        if library.is_byte(i):
            bytes_of.append(bytes([int(name[1:-1], 16)]))
        else:
            bytes_of.append(b"" if library.is_control(i) or library.is_unknown(i) else name.replace(MARK, " ").encode())
    # Merges within a unit do not see the next one unless a piece crosses a unit's end.
    alone = [library.piece_to_id(MARK)]
    crossing = any(MARK in name.lstrip(MARK) for i, name in enumerate(names) if bytes_of[i] and not library.is_byte(i))

    def encode(groups: list[list[str]]) -> list[list[int]]:
        # The library puts a blank before all but the empty text.
        return [ids or alone for ids in library.encode([unit[1:] for [unit] in groups], num_threads=1)]

    return _Side(bytes_of, encode, lambda text: [text] if crossing or MARK in text else _UNIT.findall(text), 1)


def identity(a: _Side, b: _Side) -> np.ndarray:
    """For each id of A the id of B with the same bytes, or -1; a piece goes before a single byte's id."""
    same: dict[bytes, int] = {}
    for number, content in sorted(enumerate(b.bytes_of), key=lambda entry: (len(entry[1]), entry[0])):
        if content:
            same[content] = number
    return np.array([same.get(content, -1) for content in a.bytes_of], np.int64)


@dataclass
class Cut:
    """Groups and links of the texts that have tokens; flat, in order."""

    valid: np.ndarray  # for each text, whether it has tokens
    n_a: np.ndarray  # tokens of each text
    n_b: np.ndarray
    groups: np.ndarray  # groups of each text
    digests: list[str]
    text: np.ndarray  # for each link its text, and its ids
    last_a: np.ndarray
    last_b: np.ndarray
    single: np.ndarray  # whether its group has one token each


class Cutter:
    """Both tokenizers, and groups of texts encoded by both."""

    def __init__(self, source_a: str, proto_b: bytes):
        self.a, self.b = byte_bpe(source_a), pieces(proto_b)
        self.same = identity(self.a, self.b)
        n_a, n_b = len(self.a.bytes_of), len(self.b.bytes_of)
        # How an id is written: A's within its group and at its end, B's within and at the end.
        self.written = [f"{i}{end}" for n, ends in ((n_a, ",|"), (n_b, ",;")) for end in ends for i in range(n)]
        self.base = np.array([0, n_a, 2 * n_a, 2 * n_a + n_b])

    def __call__(self, texts: list[str | None]) -> Cut:
        spaced = [" " + t if t else "" for t in texts]
        (ids_a, at_a, kept_a), (ids_b, at_b, kept_b) = self.a(spaced), self.b(spaced)
        valid = np.array([len(t) > 0 for t in spaced], bool) & kept_a & kept_b
        counts_a, counts_b = np.where(valid, np.diff(at_a), 0), np.where(valid, np.diff(at_b), 0)
        ids_a, ids_b = ids_a[np.repeat(valid, np.diff(at_a))], ids_b[np.repeat(valid, np.diff(at_b))]
        ends_a, ends_b = np.cumsum(self.a.lengths[ids_a]), np.cumsum(self.b.lengths[ids_b])
        place = np.searchsorted(ends_b, ends_a)
        cuts_a = np.zeros(len(ends_a), bool)
        inside = place < len(ends_b)
        cuts_a[inside] = ends_b[place[inside]] == ends_a[inside]
        cuts_b = np.zeros(len(ends_b), bool)
        cuts_b[place[cuts_a]] = True
        last_a, last_b = np.flatnonzero(cuts_a), np.flatnonzero(cuts_b)
        single = (np.diff(last_a, prepend=-1) == 1) & (np.diff(last_b, prepend=-1) == 1)
        text_a = np.repeat(np.arange(len(texts)), counts_a)
        text = text_a[last_a]
        groups = np.bincount(text, minlength=len(texts))

        # A group's tokens of A come first; so each token's place in the digest is known.
        group_a, group_b = np.cumsum(cuts_a) - cuts_a, np.cumsum(cuts_b) - cuts_b
        codes = np.zeros(len(ids_a) + len(ids_b), np.int64)
        before_b = np.concatenate([[0], last_b + 1])
        codes[np.arange(len(ids_a)) + before_b[group_a]] = ids_a + self.base[cuts_a.astype(int)]
        codes[np.arange(len(ids_b)) + last_a[group_b] + 1] = ids_b + self.base[2 + cuts_b.astype(int)]
        digests, start = [], 0
        for n in (counts_a + counts_b).tolist():
            line = "".join(map(self.written.__getitem__, codes[start : start + n].tolist()))[:-1]
            digests.append(hashlib.sha256(line.encode()).hexdigest() if n else "")
            start += n
        return Cut(valid, counts_a, counts_b, groups, digests, text, ids_a[last_a].astype(np.int64), ids_b[last_b].astype(np.int64), single)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Each text's values as bytes."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * values.itemsize
    data = values.tobytes()
    return pa.array([data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())


_TEXTS = "row long, n_a long, n_b long, n_groups long, groups_sha256 string, regular binary, irregular binary"
_COUNTS = "ids array<int>, ids_n array<long>, pairs array<long>, pairs_n array<long>"


def _cut_task(sources, schema: pa.Schema, held: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(*sources.value)
        same, width = cutter.same, len(cutter.b.bytes_of)
        vector = np.zeros(len(same), np.int64)
        pairs, counts, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), []

        def summed() -> None:
            nonlocal pairs, counts
            codes, where = np.unique(np.concatenate([pairs, *waiting]), return_inverse=True)
            weights = np.concatenate([counts, np.ones(sum(map(len, waiting)), np.int64)])
            pairs, counts = codes, np.bincount(where, weights, len(codes)).astype(np.int64)
            waiting.clear()

        def row(n: int, **columns: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

        def told(ids: np.ndarray) -> pa.RecordBatch:
            many = {"ids": ids, "ids_n": vector[ids], "pairs": pairs, "pairs_n": counts}
            return row(1, **{name: pa.array([values], schema.field(name).type) for name, values in many.items()})

        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                cut = cutter(part.column("text").to_pylist())
                n = part.num_rows
                regular = cut.single & (same[cut.last_a] == cut.last_b)
                vector += np.bincount(cut.last_a[regular], minlength=len(vector))
                codes = (cut.last_a * width + cut.last_b)[~regular]
                waiting.append(codes)
                if sum(map(len, waiting)) > 4 * held:
                    summed()
                    if len(pairs) > held:
                        yield told(np.zeros(0, np.int64))
                        pairs = counts = np.zeros(0, np.int64)
                yield row(
                    n,
                    row=part.column("row"),
                    doc_id=part.column("doc_id"),
                    n_a=pa.array(cut.n_a),
                    n_b=pa.array(cut.n_b),
                    n_groups=pa.array(cut.groups),
                    groups_sha256=pa.array(cut.digests),
                    regular=_lists(cut.last_a[regular].astype("<u4"), np.bincount(cut.text[regular], minlength=n)),
                    irregular=_lists(codes.astype("<u8"), np.bincount(cut.text[~regular], minlength=n)),
                )
        if waiting:
            summed()
        if vector.any() or len(pairs):
            yield told(np.flatnonzero(vector))

    return task


def _arrays(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in bytes of all rows, and how many each row has."""
    contents = column.to_pylist()
    flat = np.frombuffer(b"".join(contents), kind).astype(np.int64)
    return flat, np.array([len(c) for c in contents], np.int64) // np.dtype(kind).itemsize


def _look_up_task(tables, schema: pa.Schema):
    """n_best and count_sum of the links whose counts the tables hold; the others are listed."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id, best_of_id, frequent, by_pair, best_of_pair = tables.value
        for batch in batches:
            n = batch.num_rows
            ids, sizes = _arrays(batch.column("regular"), "<u4")
            text = np.repeat(np.arange(n), sizes)
            codes, sizes = _arrays(batch.column("irregular"), "<u8")
            owner = np.repeat(np.arange(n), sizes)
            place = np.minimum(np.searchsorted(frequent, codes), len(frequent) - 1)
            known = frequent[place] == codes
            place, whose = place[known], owner[known]
            total, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
            np.add.at(total, text, by_id[ids])
            np.add.at(best, text, best_of_id[ids])
            np.add.at(total, whose, by_pair[place])
            np.add.at(best, whose, best_of_pair[place])
            order = np.lexsort((codes[~known], owner[~known]))
            rest, rest_owner = codes[~known][order], owner[~known][order]
            first = np.flatnonzero(np.diff(rest, prepend=-1).astype(bool) | np.diff(rest_owner, prepend=-1).astype(bool))
            times = np.diff(np.append(first, len(rest)))
            at = pa.array(np.concatenate([[0], np.cumsum(np.bincount(rest_owner[first], minlength=n))]).astype(np.int32))
            new = {
                "known_sum": pa.array(total),
                "known_best": pa.array(best),
                "rest": pa.ListArray.from_arrays(at, pa.array(rest[first])),
                "times": pa.ListArray.from_arrays(at, pa.array(times.astype(np.int64))),
            }
            yield pa.RecordBatch.from_arrays([new[f.name] if f.name in new else batch.column(f.name) for f in schema], schema=schema)

    return task


@dataclass
class Alignment:
    """``documents`` (doc_id, counts, digest) and ``pairs`` (a_id, b_id, n_links, best)."""

    documents: DataFrame
    pairs: DataFrame


def align(docs: DataFrame, tokenizer_a: str, model_b: str, frequent: int = FREQUENT, held: int = HELD) -> Alignment:
    """Both tokenizers' groups and links over ``docs`` (doc_id, text); paths are read by the driver.

    A task hands on its pairs when it holds more than ``held``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    sources = read_model(tokenizer_a).decode(), read_model(model_b)
    cutter = Cutter(*sources)
    same, width = cutter.same, len(cutter.b.bytes_of)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    kind = f"{_TEXTS}, doc_id {dict(docs.dtypes)['doc_id']}, {_COUNTS}"
    schema = to_arrow_schema(spark.createDataFrame([], kind).schema)
    task = _cut_task(spark.sparkContext.broadcast(sources), schema, held)
    with small_batches(spark):
        cut = scratch.put(rows.mapInArrow(task, kind), "cut")

    told = cut.where("row IS NULL")
    by_id = told.select(F.explode(F.arrays_zip("ids", "ids_n")).alias("x")).groupBy("x.ids").agg(F.sum("x.ids_n").alias("n"))
    counts = np.zeros(len(same), np.int64)
    for a, n in by_id.collect():  # at most as many as the vocabulary has ids
        counts[a] = n
    by_pair = told.select(F.explode(F.arrays_zip("pairs", "pairs_n")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.pairs_n").alias("n"))
    by_pair = scratch.put(by_pair, "pairs")
    of_b = by_pair.groupBy(F.expr(f"pair % {width}").alias("b")).agg(F.max("n").alias("n"))
    highest = np.zeros(width, np.int64)
    for b, n in of_b.collect():  # at most as many as the vocabulary has ids
        highest[b] = n
    np.maximum.at(highest, same[same >= 0], counts[same >= 0])
    total = by_pair.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * frequent >= total
    common = np.array([tuple(r) for r in by_pair.where(often).collect()] or [(-1, 0)], np.int64)  # at most ``frequent``
    common = common[np.argsort(common[:, 0])]
    tables = (
        counts,
        ((same >= 0) & (counts == highest[same])).astype(np.int64),
        common[:, 0],
        common[:, 1],
        (common[:, 1] == highest[common[:, 0] % width]).astype(np.int64),
    )
    looked_kind = f"row long, doc_id {dict(docs.dtypes)['doc_id']}, n_a long, n_b long, n_groups long, groups_sha256 string, known_sum long, known_best long, rest array<long>, times array<long>"
    looked_schema = to_arrow_schema(spark.createDataFrame([], looked_kind).schema)
    # Written, as both the joined rest and the result read it.
    looked = cut.where("row IS NOT NULL").mapInArrow(_look_up_task(spark.sparkContext.broadcast(tables), looked_schema), looked_kind)
    looked = scratch.put(looked, "looked")
    scratch.drop(cut)

    best_of_b = spark.createDataFrame([(i, n) for i, n in enumerate(highest.tolist()) if n], "b long, most long")
    rare = by_pair.where(~often).withColumn("b", F.expr(f"pair % {width}")).join(best_of_b, "b")
    rare = rare.select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    rest = looked.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("row", F.col("x.rest").alias("pair"), "x.times")
    rest = rest.join(rare, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("sum"), F.sum(F.col("times") * F.col("best")).alias("best"))
    rest = scratch.put(rest, "rest")
    documents = looked.join(rest, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),
        (F.col("known_best") + F.coalesce("best", F.lit(0))).alias("n_best"),
        (F.col("known_sum") + F.coalesce("sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
    regular = [(a, int(same[a]), int(counts[a])) for a in np.flatnonzero(counts).tolist()]
    pairs = (
        spark.createDataFrame(regular, "a_id long, b_id long, n_links long")
        .unionByName(by_pair.select(F.expr(f"pair div {width}").alias("a_id"), F.expr(f"pair % {width}").alias("b_id"), F.col("n").alias("n_links")))
        .join(best_of_b.withColumnRenamed("b", "b_id"), "b_id")
        .select("a_id", "b_id", "n_links", (F.col("n_links") == F.col("most")).alias("best"))
    )
    return Alignment(documents, pairs)
