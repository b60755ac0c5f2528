"""Joins against small tables whose size is checked before they are broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def _size(field: T.StructField) -> Column:
    """Bytes of a value: text and bytes as they are, nested values rendered, others at most 16."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        size = F.octet_length(column)
    elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        size = F.length(F.to_json(F.struct(column)))
    else:
        size = F.lit(16)
    return F.coalesce(size, F.lit(1)).cast("bigint")


def fits(small: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``small`` is within the bounds, by number of rows and by bytes.

    Every task adds up its own rows, so one short row of each reaches the last task.
    """
    each = sum((_size(field) for field in small.schema), F.lit(0).cast("bigint"))
    n, total = small.agg(F.count("*"), F.coalesce(F.sum(each), F.lit(0))).first()
    return n <= rows and total <= size


def lookup(
    df: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    rows: int = BROADCAST_ROWS,
    null_safe: bool = False,
) -> DataFrame:
    """Join ``df`` to a lookup table.

    A table within the row and size bounds is broadcast, so ``df`` is not shuffled. A larger
    one is shuffled, and adaptive execution splits the hot keys of ``df`` (both inputs
    reach the join straight from their exchange, which that split needs). Pass computed
    summaries through ``session.settle`` first, so that the check does not compute them twice.
    With ``null_safe`` null keys meet each other; else they meet nothing.
    """
    if null_safe:
        small = small.withColumnsRenamed({k: f"__of_{k}" for k in on})
    side = F.broadcast(small) if fits(small, rows) else small
    if not null_safe:
        return df.join(side, on=list(on), how=how)
    same = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in on]
    return df.join(side, on=reduce(Column.__and__, same), how=how).drop(*[f"__of_{k}" for k in on])
