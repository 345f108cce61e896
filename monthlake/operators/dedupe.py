"""Keep the first row of each key; reject the others as duplicates.

There is one way, at every size, and it looks at the rows twice. The contest reads only what
the rules, the keys and the order need. It ranks the rows of a key, and as only the first
two count, each task hands on two rows of a key at most: a key with a third of all rows is
settled in the tasks that read it. Keys with a second row are contested. All rows then meet
the firsts of these keys. Adaptive execution chooses that join by the real sizes, and
splits it where a key is frequent: with few such keys no row is shuffled.

Rows that tie in the order are told apart by their content before their place. Content is
hashed for the rows of such keys only, in a look of its own if there are any.

Null keys are one key, as in a window. Any order that a window takes is honoured.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from monthlake.functions import event_time
from monthlake.operators.layout import ROWS_PER_TASK
from monthlake.operators.row_id import CONTENT
from monthlake.operators.rules import is_valid
from monthlake.schema import BATCH_KEYS, REJECT_REASON
from monthlake.work import stored

DUPLICATE_REASON = "DUPLICATE_ID"

# Dates are compared as text, so 01:00 PM comes before 02:00 AM.
TEXT_ORDER: tuple[str, ...] = ("Date", "Case Number")

_HASH = "_hash"
_ROWS = "_rows"
_RANK = "_rank"
_WINNER = "_winner"
_TIED = "_tied"
_CONTENT_HASH = "_content_hash"


def time_order() -> list[Column]:
    """Order by the moment itself, in place of the date's text."""
    return [event_time("Date"), F.col("Case Number")]


def _hash_of(key: str, scope: Sequence[str]) -> Column:
    return F.xxhash64(*scope, key)


def count_hashes(
    df: DataFrame, key: str = "ID", scope: Sequence[str] = tuple(BATCH_KEYS)
) -> DataFrame:
    """Valid rows per hash of their key, where that is more than one; null for other rows.

    The condition stands in the projection, not in a filter: a filter would be pushed
    into the rules and evaluate their shared parts once per use.
    """
    hashes = df.select(F.when(is_valid(), _hash_of(key, scope)).alias(_HASH))
    return hashes.groupBy(_HASH).agg(F.count("*").alias(_ROWS)).where(F.col(_ROWS) > 1)


def contested_keys(
    df: DataFrame, key: str = "ID", scope: Sequence[str] = tuple(BATCH_KEYS)
) -> DataFrame:
    """Hashes of the keys with more than one valid row, with the number of those rows.

    Two keys may share a hash; they then count as contested without being so, which
    changes no result.
    """
    return count_hashes(df, key, scope).where(F.col(_HASH).isNotNull())


def _place(df: DataFrame, row_id: str) -> tuple[Column, bool]:
    """The part of a row identity that says where the row stands; whether content goes before it."""
    kind = df.schema[row_id].dataType
    if isinstance(kind, StructType) and CONTENT in kind.names:
        return F.struct(*(F.col(f"{row_id}.{name}").alias(name) for name in kind.names if name != CONTENT)), True
    return F.col(row_id), False


def _valid_rows(df: DataFrame, key: str, scope: Sequence[str]) -> DataFrame:
    """Adds the hash of the key, null for rows that take no part."""
    return df.withColumn(_HASH, F.when(is_valid(), _hash_of(key, scope)))


def first_rows(
    df: DataFrame,
    row_id: str,
    key: str = "ID",
    order: Sequence[Column | str] = TEXT_ORDER,
    scope: Sequence[str] = tuple(BATCH_KEYS),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The place of the first valid row of every contested key, as ``_winner``.

    ``_tied`` says that the order alone did not settle it and content has to. One scan of
    few columns and one shuffle of two rows a key and task; ``rows_per_task`` has no effect.
    """
    place, _ = _place(df, row_id)
    one_key = [_HASH, *scope, key]
    # No filter on the hash, which would be pushed into the rules and parse dates once per
    # use: rows that take no part have no hash, and their groups are left out at the end.
    rows = _valid_rows(df, key, scope).withColumn(_WINNER, place)
    contest, tie = (Window.partitionBy(*one_key).orderBy(*order, *last) for last in ([_WINNER], []))
    two = rows.withColumn(_RANK, F.row_number().over(contest)).where(F.col(_RANK) <= 2)
    seconds = (F.max(_RANK) == 2) & F.max(_HASH).isNotNull()
    return (
        two.withColumn(_TIED, F.rank().over(tie))
        .groupBy(*one_key)
        .agg(F.min_by(_WINNER, _RANK).alias(_WINNER), (F.max(_TIED) == 1).alias(_TIED), seconds.alias(_ROWS))
        .where(_ROWS)
        .select(*one_key, _WINNER, _TIED)
    )


def _meet(rows: DataFrame, keys: DataFrame, key: str, scope: Sequence[str], how: str) -> DataFrame:
    """Rows with the hash of their key, joined with keys; null keys are equal."""
    theirs = {c: f"_of_winner_{i}" for i, c in enumerate([_HASH, *scope, key])}
    # The hash of a valid row is never null; the keys behind it may be.
    same = functools.reduce(
        operator.and_,
        (F.col(own).eqNullSafe(F.col(other)) for own, other in theirs.items() if own != _HASH),
        F.col(_HASH) == F.col(theirs[_HASH]),
    )
    return rows.join(keys.withColumnsRenamed(theirs), same, how)


def settle_ties(
    df: DataFrame,
    contest: DataFrame,
    row_id: str,
    content: Sequence[str],
    key: str = "ID",
    order: Sequence[Column | str] = TEXT_ORDER,
    scope: Sequence[str] = tuple(BATCH_KEYS),
) -> DataFrame:
    """The contest of `first_rows`, with its tied keys settled by these columns and then place.

    Looks at ``contest`` at once, so it should be a table. Without a tie nothing else is read.
    """
    place, _ = _place(df, row_id)
    tied = contest.where(_TIED)
    if tied.isEmpty():
        return contest.drop(_TIED)
    one_key = [_HASH, *scope, key]
    rows = _meet(_valid_rows(df, key, scope), tied.drop(_WINNER, _TIED), key, scope, "left_semi")
    rows = rows.withColumn(_WINNER, place).withColumn(_CONTENT_HASH, F.xxhash64(*content))
    ranked = Window.partitionBy(*one_key).orderBy(*order, _CONTENT_HASH, _WINNER)
    settled = rows.withColumn(_RANK, F.row_number().over(ranked)).where(F.col(_RANK) == 1)
    return contest.where(~F.col(_TIED)).drop(_TIED).unionByName(settled.select(*one_key, _WINNER))


def mark_duplicates(
    df: DataFrame,
    winners: DataFrame,
    row_id: str,
    key: str = "ID",
    scope: Sequence[str] = tuple(BATCH_KEYS),
) -> DataFrame:
    """Give ``DUPLICATE_ID`` to the valid rows of contested keys that are not in ``winners``."""
    place, _ = _place(df, row_id)
    joined = _meet(_valid_rows(df, key, scope), winners, key, scope, "left")
    beaten = F.col(_WINNER).isNotNull() & (F.col(_WINNER) != place)
    reason = F.when(beaten, F.lit(DUPLICATE_REASON)).otherwise(F.col(REJECT_REASON))
    return joined.withColumn(REJECT_REASON, reason).select(*df.columns)


def dedupe_first(
    df: DataFrame,
    *,
    row_id: str,
    key: str = "ID",
    order: Sequence[Column | str] = TEXT_ORDER,
    scope: Sequence[str] = tuple(BATCH_KEYS),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Give ``DUPLICATE_ID`` to every valid row that is not the first of its key in its scope.

    Rows that have a ``reject_reason`` keep it and take no part. ``row_id`` names a
    column that differs in all rows and is the same whenever a row is read; it settles
    ties after ``order``. If it holds content, the contest runs at once and its firsts are
    kept as a table. ``rows_per_task`` changes no result.
    """
    winners = first_rows(df, row_id, key, order, scope, rows_per_task)
    if _place(df, row_id)[1]:
        content = [c for c in df.columns if c not in (row_id, REJECT_REASON)]
        winners = settle_ties(df, stored(winners, "contest"), row_id, content, key, order, scope)
    return mark_duplicates(df, winners.drop(_TIED), row_id, key, scope)
