"""Token-ID output in training order (operator 7).

Texts become token ids (16 bits each, every text ended by one id) and are packed into
sequences of a fixed length; only the last of a task is padded. A keyed Feistel network
over the next power of four, walked along its cycles until it falls below the number of
sequences, gives every sequence its slot: a permutation that needs no table. Slots are
cut into ranges, and each range is written as one shard: a file of sequences of equal
length, in order of slots, so that slot s lies at (s - first slot of its shard) * stride.
Training reads shards from front to back and can resume at any slot.

The path to the vocabulary is a parameter; the driver reads it and sends it to the tasks.
Shards are written by tasks under the final name's temporary neighbour and moved, so a
task that runs again replaces its own shard with the same bytes. ``path`` must be seen by
all executors; any file system that Arrow reads by its URI will do.

Defined results: null and empty texts give no tokens. A text without an id is packed
like any other and stands as null in ``doc_ids``. Repeated
rows are packed each. An empty table gives no shards. Strings of special tokens in texts
are ordinary text. Other columns are ignored. The order of sequences follows the key and
the input files alone; a read of the same files in other splits packs differently.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.llm.flat import mix, slices
from monthlake.llm.scratch import Scratch

#: How GPT-2 style vocabularies cut text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LENGTH = 2048
SHARD_BYTES = 16 << 20
ROUNDS = 6


def permuted(index: np.ndarray, n: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """Slots of indexes below n: a permutation of 0 … n - 1 that the key chooses."""
    half = np.uint64(max(1, -(-max(n - 1, 1).bit_length() // 2)))
    mask = np.uint64((1 << int(half)) - 1)
    keys = [mix(np.array([(key * 1_000_003 + r) % (1 << 64)], np.uint64))[0] for r in range(rounds)]
    x = index.astype(np.uint64)
    outside = np.ones(len(x), bool)
    while outside.any():
        left, right = x[outside] >> half, x[outside] & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        x[outside] = left << half | right
        outside = x >= np.uint64(n)
    return x.astype(np.int64)


def _ranks(path: str) -> bytes:
    system, inner = fs.FileSystem.from_uri(path if "://" in path else Path(path).resolve().as_uri())
    with system.open_input_stream(inner) as stream:
        return stream.read()


class Tokens:
    """A byte-pair vocabulary of fewer than 65,536 ids, and the id that ends a text."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.end = max(table.values()) + 1
        if self.end > 0xFFFF:
            raise ValueError("ids need more than 16 bits")
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        ids = self.encoding.encode_to_numpy(text, disallowed_special=())
        return np.append(ids, self.end).astype(np.uint16)

    def decode(self, ids: np.ndarray) -> list[str]:
        """The texts among ids; a last one without an end is given as far as it goes."""
        ends = np.flatnonzero(ids == self.end)
        parts = np.split(ids, ends + 1)
        return [self.encoding.decode([t for t in p.tolist() if t != self.end]) for p in parts if len(p)]


_SEQUENCES = "part long, number long, n_tokens int, doc_ids array<long>, tokens binary"


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """Sequences of ``length`` ids (little-endian, 16 bits) of (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(_ranks(vocabulary))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(shared.value)
        part = TaskContext.get().partitionId()
        number = 0
        held: list[tuple[int | None, np.ndarray]] = []  # texts, or what is left of them, not yet packed
        n_held = 0
        rows: list[tuple] = []

        def sequence() -> None:
            nonlocal n_held, number
            ids, taken, n = [], [], 0
            while held and n < length:
                doc, own = held.pop(0)
                now = own[: length - n]
                ids.append(doc)
                taken.append(now)
                n += len(now)
                if len(now) < len(own):
                    held.insert(0, (doc, own[len(now) :]))
            n_held -= n
            padded = np.full(length, tokens.end, "<u2")
            padded[:n] = np.concatenate(taken)
            rows.append((part, number, n, ids, padded.tobytes()))
            number += 1

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "number", "n_tokens", "doc_ids", "tokens"])

        for batch in batches:
            for piece in slices(batch, "text"):
                for doc, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), strict=True):
                    own = tokens.encode(text)
                    held.append((doc, own))
                    n_held += len(own)
                    while n_held >= length:
                        sequence()
                        if len(rows) >= 1000:
                            yield out()
        if n_held:
            sequence()
        if rows:
            yield out()

    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text <> ''")
    return usable.mapInArrow(task, _SEQUENCES)


_GROUPS = "shard long, slots binary, n_tokens binary, n_docs binary, doc_ids binary, packed binary"
_MANIFEST = "slot long, shard long, byte_offset long, n_tokens int, doc_ids array<long>, crc32 long"


def materialise(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    key: int = 0,
    length: int = LENGTH,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Writes the shards of ``docs`` (doc_id, text) into ``path``; one row per sequence.

    Gives slot, shard, byte_offset, n_tokens (without padding), doc_ids (of the texts in
    it, in order) and crc32 (of the sequence's bytes). ``path`` also gets ``order.json``.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    sequences = scratch.put(pack(docs, vocabulary, length), "sequences")
    sizes = sequences.groupBy("part").count().orderBy("part").collect()  # one row per task
    n = sum(r["count"] for r in sizes)
    stride = 2 * length
    per_shard = max(1, shard_bytes // stride)
    before, total = {}, 0
    for r in sizes:
        before[r["part"]] = total
        total += r["count"]
    starts = spark.sparkContext.broadcast(before)
    target = path if "://" in path or path.startswith("file:") else Path(path).absolute().as_uri()
    _write_order(target, {"sequences": n, "length": length, "per_shard": per_shard, "dtype": "<u2", "key": key})

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            if not batch.num_rows:
                continue
            parts, numbers = batch.column("part").to_pylist(), batch.column("number").to_numpy()
            slots = permuted(np.array([starts.value[p] for p in parts]) + numbers, n, key)
            order = np.argsort(slots)
            shards = slots[order] // per_shard
            first = np.flatnonzero(np.diff(shards, prepend=-1))
            tokens, docs_of = batch.column("tokens"), batch.column("doc_ids")
            out: dict[str, list] = {c: [] for c in ("shard", "slots", "n_tokens", "n_docs", "doc_ids", "packed")}
            for a, b in zip(first, np.append(first, len(order))[1:], strict=True):
                rows = pa.array(order[a:b])
                lists = docs_of.take(rows)
                out["shard"].append(int(shards[a]))
                out["slots"].append(slots[order[a:b]].tobytes())
                out["n_tokens"].append(batch.column("n_tokens").take(rows).to_numpy().astype(np.int32).tobytes())
                out["n_docs"].append(lists.value_lengths().to_numpy().astype(np.int32).tobytes())
                ids = lists.flatten()
                out["doc_ids"].append(ids.fill_null(0).to_numpy().astype(np.int64).tobytes() + np.asarray(ids.is_valid()).tobytes())
                out["packed"].append(squeeze.compress(b"".join(tokens.take(rows).to_pylist())))
            kinds = [pa.int64(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out.values(), kinds, strict=True)], names=list(out))

    def write(shard: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor()
        number = shard[0].as_py()
        first = number * per_shard
        data = np.zeros((min(per_shard, n - first), length), "<u2")
        n_tokens = np.zeros(len(data), np.int32)
        docs_of: list = [None] * len(data)
        for batch in batches:
            for row in batch.to_pylist():
                places = np.frombuffer(row["slots"], np.int64) - first
                data[places] = np.frombuffer(expand.decompress(row["packed"]), "<u2").reshape(len(places), length)
                n_tokens[places] = np.frombuffer(row["n_tokens"], np.int32)
                n_docs = np.frombuffer(row["n_docs"], np.int32)
                flat, known = row["doc_ids"][: 8 * n_docs.sum()], row["doc_ids"][8 * n_docs.sum() :]
                ids = pa.array(np.frombuffer(flat, np.int64), mask=~np.frombuffer(known, bool))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_docs)]).astype(np.int32)), ids).to_pylist()
                for place, own in zip(places.tolist(), lists, strict=True):
                    docs_of[place] = own
        _write_file(target, shard_name(number), data.tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(first + np.arange(len(data))),
                pa.array(np.full(len(data), number)),
                pa.array(np.arange(len(data)) * stride),
                pa.array(n_tokens),
                pa.array(docs_of, pa.list_(pa.int64())),
                pa.array([zlib.crc32(x.tobytes()) for x in data], pa.int64()),
            ],
            names=["slot", "shard", "byte_offset", "n_tokens", "doc_ids", "crc32"],
        )

    manifest = scratch.put(
        sequences.mapInArrow(group, _GROUPS).groupBy("shard").applyInArrow(write, _MANIFEST), "manifest"
    )
    scratch.drop(sequences)
    return manifest


def shard_name(number: int) -> str:
    return f"shard-{number:06d}.bin"


def _write_file(target: str, name: str, data: bytes) -> None:
    system, folder = fs.FileSystem.from_uri(target)
    system.create_dir(folder, recursive=True)
    context = TaskContext.get()
    attempt = f"{context.taskAttemptId()}" if context else "driver"
    with system.open_output_stream(f"{folder}/.{name}.{attempt}") as stream:
        stream.write(data)
    system.move(f"{folder}/.{name}.{attempt}", f"{folder}/{name}")


def _write_order(target: str, order: dict) -> None:
    _write_file(target, "order.json", json.dumps(order).encode())


class Reader:
    """Sequences from a folder of shards, in order of slots, from any slot on."""

    def __init__(self, path: str):
        uri = path if "://" in path or path.startswith("file:") else Path(path).absolute().as_uri()
        self.system, self.folder = fs.FileSystem.from_uri(uri)
        with self.system.open_input_stream(f"{self.folder}/order.json") as stream:
            self.order = json.loads(stream.read())

    def __len__(self) -> int:
        return self.order["sequences"]

    def sequences(self, start: int = 0, stop: int | None = None) -> Iterator[np.ndarray]:
        stride = 2 * self.order["length"]
        stop = len(self) if stop is None else min(stop, len(self))
        slot = start
        while slot < stop:
            shard, place = divmod(slot, self.order["per_shard"])
            many = min(stop - slot, self.order["per_shard"] - place)
            with self.system.open_input_file(f"{self.folder}/{shard_name(shard)}") as file:
                file.seek(place * stride)
                for _ in range(many):
                    yield np.frombuffer(file.read(stride), self.order["dtype"])
            slot += many
