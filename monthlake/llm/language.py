"""Language identification: multinomial naive Bayes over hashed character n-grams (operator 6).

Training counts the hashed runs of 1 to 3 characters of every document with a language,
in numpy inside the tasks; Spark adds the counts up by language and block of buckets.
The log-probability matrix (languages x buckets, of at most ``MAX_LANGUAGES`` languages) is
broadcast, and documents are scored in batches: a gather and a sum per language. More
languages make several matrices, which documents meet one after the other.

A character lies in a run of each order, so the log-likelihood is divided by the number of
orders: a naive Bayes that is tempered by that, with milder probabilities.

Defined results: a text that is null or has no letter is ``und`` with score 0. With
nothing to learn from, every text is ``und``. Texts count in lower case. Languages that
tie go to the first in order of name. Rows without a language, or whose id is null, are
not learned from. Repeated rows are each answered, and each learned from. Other columns
are passed through; columns named like those that are added are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.llm.flat import slices, texts
from monthlake.work import stored

UNKNOWN = "und"
BITS = 16
ORDERS = (1, 2, 3)
#: The matrix takes 256 KB a language; more languages than these take a matrix and a pass each.
MAX_LANGUAGES = 400
_SO_FAR = ("_lower", "_lang", "_best", "_total")
_BLOCK = 1 << 12
_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def held_out() -> F.Column:
    """Whether crc32 of the id as text leaves 2 of 4; null ids are not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learnable() -> F.Column:
    return F.col("doc_id").isNotNull() & ~held_out()


def _ngrams(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the bucket of each run of characters, and the places before each text."""
    if len(data) == 0:
        return
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    places = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=places[1:])
    ends = places[at]
    text_end = np.repeat(ends[1:], np.diff(ends))
    with np.errstate(over="ignore"):
        hashed = np.zeros(len(points), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            kept = len(points) - n + 1
            if kept <= 0:
                return
            hashed = hashed[:kept] * np.uint32(31) + points[n - 1 :] * np.uint32(_MULTIPLIERS[n - 1])
            if n not in ORDERS:
                continue
            whole = np.arange(kept) + n <= text_end[:kept]
            mixed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            bucket = (mixed >> np.uint32(32 - BITS)).astype(np.int64)
            # Runs are counted before each text: those that begin before it and are whole.
            before = np.concatenate([[0], np.cumsum(whole)])
            yield bucket[whole], before[np.minimum(ends, kept)]


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        for part in slices(batch, "text"):
            langs = part.column("lang").to_pylist()
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs]) if names else np.zeros(0, int)
            for name in names:
                counts.setdefault(name, np.zeros(1 << BITS, np.int64))
                rows[name] = rows.get(name, 0) + langs.count(name)
            for bucket, before in _ngrams(*texts(part.column("text"))):
                of = np.repeat(number, np.diff(before))
                table = np.bincount((of << BITS) + bucket, minlength=len(names) << BITS)
                for i, name in enumerate(names):
                    counts[name] += table[i << BITS : (i + 1) << BITS]
            if len(counts) > 64:
                yield _blocks(counts, rows)
                counts, rows = {}, {}
    if counts:
        yield _blocks(counts, rows)


def _blocks(counts: dict[str, np.ndarray], rows: dict[str, int]) -> pa.RecordBatch:
    out = {"lang": [], "block": [], "n_rows": [], "counts": []}
    for name, table in counts.items():
        for block in range(0, 1 << BITS, _BLOCK):
            out["lang"].append(name)
            out["block"].append(block)
            out["n_rows"].append(rows[name])
            out["counts"].append(table[block : block + _BLOCK].tobytes())
    return pa.RecordBatch.from_pydict(
        out,
        schema=pa.schema([("lang", pa.string()), ("block", pa.int32()), ("n_rows", pa.int64()), ("counts", pa.binary())]),
    )


def _add_blocks(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(_BLOCK, np.int64), 0
    for batch in batches:
        for packed, n in zip(batch.column("counts").to_pylist(), batch.column("n_rows").to_pylist(), strict=True):
            total += np.frombuffer(packed, np.int64)
            rows += n
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()]), pa.array([key[1].as_py()], pa.int32()), pa.array([rows], pa.int64()), pa.array([total.tobytes()], pa.binary())],
        names=["lang", "block", "n_rows", "counts"],
    )


_COUNTS = "lang string, block int, n_rows long, counts binary"


class LanguageModel:
    """Log-probabilities by language and bucket, and the languages' own."""

    def __init__(self, languages: list[str], counts: np.ndarray, rows: np.ndarray, all_rows: float, smoothing: float = 0.5):
        self.languages = languages
        total = counts.sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore"):
            self.logs = (np.log(counts + smoothing) - np.log(total + smoothing * counts.shape[1])).astype(np.float32) if languages else counts
            self.priors = np.log(rows / max(1, all_rows))

    def scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The languages' log-probabilities for each text, but for what all languages share.

        A character lies in a run of each order; their logs are averaged over the orders.
        """
        scores = np.zeros((len(at) - 1, len(self.languages)))
        for bucket, before in _ngrams(data, at):
            for i in range(len(self.languages)):
                sums = np.concatenate([[0.0], np.cumsum(self.logs[i][bucket], dtype=np.float64)])
                scores[:, i] += np.diff(sums[before])
        return scores / len(ORDERS) + self.priors


@dataclass(frozen=True)
class LanguageModels:
    """Models of at most ``MAX_LANGUAGES`` languages each, made one at a time from stored counts.

    The driver holds the names of all languages and the matrix of one block of them.
    """

    counted: DataFrame
    rows: dict[str, int]
    per_block: int

    @property
    def languages(self) -> list[str]:
        return sorted(self.rows)

    @property
    def logs(self) -> np.ndarray:
        """The matrix of the first block."""
        return next(self.blocks()).logs

    def blocks_starts(self) -> range:
        """Where each block begins among the languages."""
        return range(0, len(self.languages), self.per_block)

    def blocks(self) -> Iterator[LanguageModel]:
        names, total = self.languages, sum(self.rows.values())
        for start in range(0, len(names), self.per_block):
            own = names[start : start + self.per_block]
            counts = np.zeros((len(own), 1 << BITS), np.int64)
            place = {name: i for i, name in enumerate(own)}
            for row in self.counted.where((F.col("lang") >= own[0]) & (F.col("lang") <= own[-1])).toLocalIterator():
                counts[place[row.lang], row.block : row.block + _BLOCK] = np.frombuffer(row.counts, np.int64)
            yield LanguageModel(own, counts, np.array([self.rows[x] for x in own], float), total)


def train_language_model(docs: DataFrame, per_block: int = MAX_LANGUAGES) -> LanguageModels:
    """Counts over all rows with a text and a language; ``docs`` has text and lang."""
    counted = (
        docs.where("text IS NOT NULL AND lang IS NOT NULL")
        .select(F.lower("text").alias("text"), "lang")
        .mapInArrow(_count_task, _COUNTS)
        .groupBy("lang", "block")
        .applyInArrow(_add_blocks, _COUNTS)
    )
    counted = stored(counted, "languages")
    rows = {row.lang: row.n_rows for row in counted.where("block = 0").select("lang", "n_rows").toLocalIterator()}
    return LanguageModels(counted, rows, per_block)


def identify(docs: DataFrame, models: LanguageModels) -> DataFrame:
    """Documents with lang_pred and score; more languages than a block holds take a pass for each block."""
    kept = docs.drop("lang_pred", "score", *_SO_FAR)
    lower = F.when(F.col("text").rlike(r"\p{L}"), F.lower("text"))
    none = (F.lit(None).cast("string"), F.lit(float("-inf")), F.lit(float("-inf")))
    frame = kept.withColumns({"_lower": lower, **dict(zip(_SO_FAR[1:], none, strict=True))})
    shared, blocks = None, list(models.blocks_starts())
    for i, model in enumerate(models.blocks()):
        if shared is not None:
            frame = stored(frame, "languages")
            shared.destroy()
        shared = docs.sparkSession.sparkContext.broadcast(model)
        frame = frame.mapInArrow(_task(shared, last=i == len(blocks) - 1), frame.schema)
    named = F.col("_lang").isNotNull()
    return frame.select(
        *(frame[c] for c in kept.columns),
        F.when(named, F.col("_lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(named, F.least(F.lit(1.0), F.exp(F.col("_best") - F.col("_total")))).otherwise(0.0).alias("score"),
    )


def _task(shared, last: bool = False):
    """The last pass gives back ``_lower`` as null: no one reads it after, and the rows are half as large."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_lower"):
                yield _answer(part, shared.value, last)

    return task


def _answer(part: pa.RecordBatch, model: LanguageModel, last: bool = False) -> pa.RecordBatch:
    """The best language so far, its log-probability, and the log of the sum of all so far."""
    column = part.column("_lower")
    scores = model.scores(*texts(column))
    place = scores.argmax(axis=1)
    top = scores[np.arange(len(scores)), place]
    total = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
    before = {name: part.column(name) for name in _SO_FAR[1:]}
    best, so_far = (before[name].to_numpy(zero_copy_only=False) for name in ("_best", "_total"))
    known = np.asarray(column.is_valid())
    better = known & (top > best)
    names = [model.languages[p] if b else old for p, b, old in zip(place, better, before["_lang"].to_pylist(), strict=True)]
    new = {
        "_lang": pa.array(names, pa.string()),
        "_best": pa.array(np.where(better, top, best)),
        "_total": pa.array(np.where(known, np.logaddexp(so_far, total), so_far)),
    }
    if last:
        new["_lower"] = pa.nulls(len(column), pa.string())
    return pa.RecordBatch.from_arrays([new.get(n, part.column(i)) for i, n in enumerate(part.schema.names)], names=part.schema.names)


def keep_identified(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """The documents whose language is known with at least this score; the same columns."""
    model = train_language_model(docs.where(learnable()))
    return identify(docs, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select(*docs.columns)
