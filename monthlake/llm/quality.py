"""Quality of documents by co-training two classifiers (operator 4).

One view is the text: the mean weight of its tokens (runs of non-blanks, as they stand
and as shapes), the share of tokens that speak against it, and how often tokens repeat.
The other is what describes the page: source, language, length, lines and the make-up of
its characters, each as a category that is hashed to one of ``2^PAGE_BITS`` buckets a
feature. Both are trained on a bounded sample of labelled rows.
For ``rounds`` rounds, each view then labels all usable documents without a label of which
it is sure (at least ``confident``), and the other view learns from those too: their tokens
and categories are counted in Spark, beside those of the labelled rows. Each view's
probability is a logistic regression on labelled rows, by weights that their half did not
give; a last regression joins the two. Every document is scored by both views.

Bounds: ``max_labelled`` labelled rows, those with the smallest hash of their id; the
regressions are fitted on these. Everything else covers all rows. To the driver come the
facts of the labelled rows and tables of a fixed size, however many sources there are:
those that share a bucket share a weight. The buckets of a text's tokens are written once
and read by every round.

Defined results: null and empty texts have a length of 0 and no tokens, and are scored by
what is left. Null sources and languages are categories of their own. Without labels, or
with labels of one kind, all get the share of good ones (one half without any). Labels
other than 0 and 1, of null or unknown ids are not used; several labels of an id count as
the largest. Repeated rows are each answered. Other columns are passed through; ``score``
and ``score_text`` and ``score_page`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.llm.evidence import BITS, Evidence, fit_logistic, gather, labelled_sample, logit, sigmoid
from monthlake.llm.flat import Words, byte_table, mix, seed, slices, span_hashes, texts
from monthlake.llm.scratch import Scratch, small_batches

MAX_LABELLED = 20_000
ROUNDS = 3
CONFIDENT = 0.95
#: Buckets of the categories of each feature, as bits.
PAGE_BITS = 17
_PRIOR_ROWS = 5.0
#: Bytes of token buckets that a task works on at once.
_SLICE = 1 << 20
_TEXT_FEATURES = 5
_TOKEN_BYTES = ~byte_table((0x20, 0x20), (0x09, 0x0D))
# What a byte looks like: 0 other sign, 1 digit, 2 lower, 3 upper, 4 stop or comma, 5 beyond ASCII.
_SHAPE = np.zeros(256, np.uint8)
for _low, _high, _kind in ((0x30, 0x39, 1), (0x61, 0x7A, 2), (0x41, 0x5A, 3), (0x80, 0xFF, 5)):
    _SHAPE[_low : _high + 1] = _kind
_SHAPE[[0x2C, 0x2E]] = 4


def page_features(text: str = "text") -> dict[str, F.Column]:
    """What describes a page, each as a short string."""
    body = F.coalesce(F.col(text), F.lit(""))
    length = F.length(body)

    def scale(x: F.Column) -> F.Column:
        return F.floor(2 * F.log2(x + 1)).cast("string")

    def part(pattern: str) -> F.Column:
        rest = F.length(F.regexp_replace(body, pattern, ""))
        return F.floor(20 * (length - rest) / F.greatest(length, F.lit(1))).cast("string")

    lines = F.size(F.split(body, "\n"))
    return {
        "source": F.coalesce(F.col("source").cast("string"), F.lit("\0")),
        "lang": F.coalesce(F.col("lang").cast("string"), F.lit("\0")),
        "length": scale(length),
        "lines": scale(lines),
        "line_length": scale((length / lines).cast("double")),
        "signs": part(r"[^\p{L}\p{N}\s.,]"),
        "capitals": part(r"\p{Lu}"),
        "digits": part(r"\p{N}"),
    }


_PAGE = ("source", "lang", "length", "lines", "line_length", "signs", "capitals", "digits")


def _page() -> F.Column:
    """The bucket of each feature of a page; features have buckets of their own."""
    values = page_features()
    return F.array(*(F.shiftrightunsigned(F.xxhash64(values[k]), 64 - PAGE_BITS).cast("int") + F.lit(i << PAGE_BITS) for i, k in enumerate(_PAGE)))


def _pages(column: pa.Array) -> np.ndarray:
    """A row for each page, a column for each feature."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(_PAGE))


Tokens = tuple[np.ndarray, np.ndarray, np.ndarray]


def _tokens(part: pa.RecordBatch) -> Tokens:
    """Buckets of the tokens and of their shapes, and how many each text has."""
    data, at = texts(part.column("text"))
    words = Words(data, at, _TOKEN_BYTES)
    if not len(words):
        return np.zeros(0, np.int32), np.zeros(0, np.int32), words.counts()
    shape = _SHAPE[data]
    same = np.zeros(len(shape), bool)  # a run of one kind counts once
    same[1:] = shape[1:] == shape[:-1]
    same[words.start] = False
    order = np.concatenate([[0], np.cumsum(~same)])
    shapes = span_hashes(shape[~same], order[words.start], order[words.end])
    token, kind = ((mix(h ^ seed(name)) >> np.uint64(64 - BITS)).astype(np.int32) for h, name in ((words.hashes(), "token"), (shapes, "shape")))
    return token, kind, words.counts()


def _stored_tokens(part: pa.RecordBatch) -> Tokens:
    """The same from the columns that ``_with_tokens`` made."""
    token, at = texts(part.column("tokens"))
    return token.view(np.int32), texts(part.column("shapes"))[0].view(np.int32), np.diff(at) // 4


def _with_tokens(rows: DataFrame) -> DataFrame:
    """Rows with the buckets of their text's tokens and shapes, as bytes, in place of ``text``."""
    schema = rows.drop("text").withColumns({"tokens": F.lit(b""), "shapes": F.lit(b"")}).schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                *kinds, counts = _tokens(part)
                ends = pa.py_buffer(np.concatenate([[0], 4 * np.cumsum(counts)]).astype(np.int32))
                out = part.drop_columns(["text"])
                for name, buckets in zip(("tokens", "shapes"), kinds, strict=True):
                    out = out.append_column(name, pa.Array.from_buffers(pa.binary(), len(counts), [None, ends, pa.py_buffer(buckets.tobytes())]))
                yield out

    return rows.mapInArrow(task, schema)


def _both(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of tokens, then of shapes, and the text of each."""
    token, kind, counts = tokens
    return np.concatenate([token, kind]).astype(np.int64), np.tile(np.repeat(np.arange(len(counts)), counts), 2)


def _text_dense(tokens: Tokens, shares: np.ndarray) -> np.ndarray:
    bucket, owner = _both(tokens)
    n = tokens[2].astype(float)
    weight = logit(np.clip(shares[bucket].astype(np.float64), 1e-3, 1 - 1e-3))
    half = len(bucket) // 2
    count = np.maximum(n, 1)
    mean = lambda x, of: np.bincount(of, x, minlength=len(n)) / count
    distinct = np.unique(owner[:half].astype(np.uint64) << np.uint64(BITS) | bucket[:half].astype(np.uint64))
    kinds = np.bincount((distinct >> np.uint64(BITS)).astype(np.int64), minlength=len(n))
    return np.column_stack(
        [
            mean(weight[:half], owner[:half]),
            mean(weight[half:], owner[half:]),
            mean((weight < 0).astype(float), owner),
            np.log1p(n) / 5,
            kinds / count,
        ]
    )


def _page_counts(rows: DataFrame) -> np.ndarray:
    """Rows and good ones of each half and bucket, over rows (label, half, page)."""
    counts = np.zeros((2, len(_PAGE) << PAGE_BITS, 2), np.int64)
    counted = (
        rows.select("label", "half", F.explode("page").alias("bucket"))
        .groupBy("half", "bucket")
        .agg(F.count("*").alias("n"), F.sum("label").alias("good"))
        .toLocalIterator()
    )
    for half, bucket, n, good in counted:  # at most two for each bucket
        counts[half, bucket] = n, good
    return counts


def _page_table(counts: np.ndarray, used: tuple[int, ...] = (0, 1)) -> np.ndarray:
    """The weight of each bucket by the rows of these halves; one without rows weighs what all do."""
    n, good = counts[list(used)].sum(axis=0).T
    # Each row has one bucket of the first feature.
    n_all, n_good = (x[: 1 << PAGE_BITS].sum() for x in (n, good))
    base = (n_good + 1) / (n_all + 2)
    return logit((good + _PRIOR_ROWS * base) / (n + _PRIOR_ROWS)).astype(np.float32)


class QualityModel:
    def __init__(self, shares: np.ndarray, text_weights: np.ndarray, page: np.ndarray, page_weights: np.ndarray, joint: np.ndarray):
        self.shares, self.text_weights = shares, text_weights
        self.page, self.page_weights, self.joint = page, page_weights, joint


def _apply(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])


def _sure(p: np.ndarray, confident: float) -> np.ndarray:
    """The label that a view is sure of, or -1."""
    return np.where(p >= confident, 1, np.where(1 - p >= confident, 0, -1)).astype(np.int32)


def _told_by_text(rows: DataFrame, shared, weights: np.ndarray, confident: float) -> DataFrame:
    """(label, half, page) of the rows of which the text view is sure; ``shared`` has its shares last."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "tokens", _SLICE):
                label = _sure(_apply(_text_dense(_stored_tokens(part), shared.value[-1]), weights), confident)
                out = pa.RecordBatch.from_arrays([pa.array(label), part.column("half"), part.column("page")], names=["label", "half", "page"])
                yield out.filter(pa.array(label >= 0))

    return rows.select("tokens", "shapes", "half", "page").mapInArrow(task, "label int, half int, page array<int>")


def _told_by_page(rows: DataFrame, shared, confident: float) -> DataFrame:
    """(tokens, shapes, label, half) of the rows of which the page view is sure; ``shared`` has its table and weights."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, weights = shared.value
        for batch in batches:
            label = _sure(_apply(table[_pages(batch.column("page"))], weights), confident)
            out = pa.RecordBatch.from_arrays([batch.column("tokens"), batch.column("shapes"), pa.array(label), batch.column("half")], names=["tokens", "shapes", "label", "half"])
            yield out.filter(pa.array(label >= 0))

    return rows.select("tokens", "shapes", "half", "page").mapInArrow(task, "tokens binary, shapes binary, label int, half int")


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    usable: F.Column,
    rounds: int = ROUNDS,
    confident: float = CONFIDENT,
    max_labelled: int = MAX_LABELLED,
) -> QualityModel:
    """``docs`` has doc_id, text, lang, source; ``labels`` doc_id and quality.

    ``usable`` says, of doc_id, which rows may be learned from.
    """
    with small_batches(docs.sparkSession):
        return _train(docs, labels, usable, rounds, confident, max_labelled)


def _train(docs: DataFrame, labels: DataFrame, usable: F.Column, rounds: int, confident: float, max_labelled: int) -> QualityModel:
    spark = docs.sparkSession
    scratch = Scratch(spark)
    known = scratch.put(labelled_sample(labels, "quality", usable & F.col("doc_id").isNotNull(), max_labelled), "known")
    paged = docs.where(usable & F.col("doc_id").isNotNull()).select("doc_id", "text", _page().alias("page"))
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int")
    others = paged.join(F.broadcast(known), "doc_id", "left_anti").select("text", "page", half.alias("half"))
    others = scratch.put(_with_tokens(others), "others")
    sample = paged.join(F.broadcast(known), "doc_id").select("text", "page", "label", "half")
    sample = scratch.put(_with_tokens(sample.withColumn("row", F.monotonically_increasing_id())), "sample")

    facts = sample.select("row", "label", "half", "page").orderBy("row").collect()
    place = {r["row"]: i for i, r in enumerate(facts)}
    halves = np.array([r["half"] for r in facts], int)
    truth = np.array([r["label"] for r in facts], int)
    pages = np.array([r["page"] for r in facts], int).reshape(-1, len(_PAGE))
    for_text, for_page = sample.select("tokens", "shapes", "label", "half"), sample.select("label", "half", "page")
    told_text, told_page = for_text, for_page
    kept: list = []

    for number in range(rounds + 1):
        # The text view.
        evidence: Evidence = gather(told_text, lambda part: _both(_stored_tokens(part)), _PRIOR_ROWS, "tokens", _SLICE)
        shares = [evidence.shares(h).astype(np.float16) for h in ((1,), (0,), (0, 1))]
        tables = spark.sparkContext.broadcast(shares)

        def dense(batches: Iterator[pa.RecordBatch], tables=tables) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "tokens", _SLICE):
                    tokens = _stored_tokens(part)
                    x = np.concatenate([_text_dense(tokens, s) for s in tables.value[:2]], axis=1)
                    yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(list(x), pa.list_(pa.float64()))], names=["row", "x"])

        x = np.zeros((len(facts), 2 * _TEXT_FEATURES))
        for r in sample.select("row", "tokens", "shapes").mapInArrow(dense, "row long, x array<double>").toLocalIterator():
            x[place[r["row"]]] = r["x"]
        apart = np.where((halves == 0)[:, None], *np.split(x, 2, axis=1))
        text_weights = fit_logistic(apart, truth.astype(float))
        p_text = _apply(apart, text_weights)
        # The page view.
        page_counts = _page_counts(told_page)
        for old in kept:  # of each round, on all disks
            old.destroy()
        apart = np.where((halves == 0)[:, None], _page_table(page_counts, (1,))[pages], _page_table(page_counts, (0,))[pages])
        page_weights = fit_logistic(apart, truth.astype(float))
        p_page = _apply(apart, page_weights)
        if number == rounds or len(np.unique(truth)) < 2:
            tables.destroy()
            break
        views = spark.sparkContext.broadcast((_page_table(page_counts), page_weights))
        kept = [tables, views]
        told_text = for_text.unionByName(_told_by_page(others, views, confident))
        told_page = for_page.unionByName(_told_by_text(others, tables, text_weights, confident))

    both_views = np.column_stack([logit(np.clip(p, 1e-6, 1 - 1e-6)) for p in (p_text, p_page)])
    joint = fit_logistic(both_views, truth.astype(float))
    model = QualityModel(shares[2], text_weights, _page_table(page_counts), page_weights, joint)
    scratch.drop(known, others, sample)
    return model


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Documents with score_text, score_page and score: how likely they are good."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("score", "score_text", "score_page", "_page")
    schema = kept.withColumns({c: F.lit(0.0) for c in ("score_text", "score_page", "score")}).schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                p_text = _apply(_text_dense(_tokens(part), model.shares), model.text_weights)
                p_page = _apply(model.page[_pages(part.column("_page"))], model.page_weights)
                views = np.column_stack([logit(np.clip(p, 1e-6, 1 - 1e-6)) for p in (p_text, p_page)])
                out = part.drop_columns(["_page"])
                for name, p in (("score_text", p_text), ("score_page", p_page), ("score", _apply(views, model.joint))):
                    out = out.append_column(name, pa.array(p, pa.float64()))
                yield out

    return kept.withColumn("_page", _page()).mapInArrow(task, schema)
