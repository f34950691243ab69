"""Apply a change feed (insert / update / delete per key) without a table format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import first_by_key

DELETE = "D"   # fixed value: op code of a delete


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order`` (ascending, nulls first)."""
    return first_by_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def merge_changes(state: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str],
                  deal_by: str | None = None, reduce: bool = False) -> DataFrame:
    """New state: the latest row per key over ``state ∪ changes``; deletes kept as tombstones.

    Keeping tombstones makes the merge order-insensitive: a late, older
    change for a deleted key cannot bring it back. With ``deal_by``, a column
    the keys decide, rows are shuffled once by it and lie by it afterwards;
    ``reduce`` then brings changes that name few keys very often down to one
    row per key first, in a shuffle of their own.
    """
    if deal_by is None:
        return latest_by_key(state.unionByName(changes, allowMissingColumns=True), keys, order)
    changes = latest_by_key(changes, keys, order) if reduce else changes
    rows = state.unionByName(changes, allowMissingColumns=True).repartition(deal_by)
    return latest_by_key(rows, [deal_by, *keys], order)


def live(state: DataFrame, op_col: str = "op") -> DataFrame:
    """Rows of a merged state that are not deleted."""
    return state.filter(F.col(op_col).isNull() | (F.col(op_col) != DELETE))


def apply_changes(base: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str],
                  op_col: str = "op") -> DataFrame:
    """``base`` with ``changes`` applied: latest row per key, deleted keys removed."""
    return live(merge_changes(base, changes, keys, order), op_col)
