"""Running aggregates along a position, without putting a whole group into one task.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task. Here each key is
cut into blocks of ``span`` consecutive positions. Rows are windowed per (key, block), the
block totals (one small row each, combined map-side) are windowed per key, and the carry of
all earlier blocks is joined back. The result is the same for every span.

The input is read twice, once for the rows and once for the totals: settle it first if it
comes from a costly join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

SPAN = 1 << 20
_BLOCK = "__block"


@dataclass(frozen=True)
class Running:
    """One running aggregate: ``kind`` is sum, max or min over ``value``.

    ``exclusive`` leaves the current row out; the first row then has null (sum: 0).
    """

    kind: str
    value: Column
    exclusive: bool = False


_AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min}


def block_of(position: Column, span: int) -> Column:
    """Integer division rounding down, exact for any BIGINT.

    Never null, so that the join on the block adds no null filter to one side only; both
    sides then read the same exchange.
    """
    step = F.lit(span).cast("bigint")
    quotient = F.call_function("div", position - F.pmod(position, step), step)
    return F.coalesce(quotient, F.lit(0).cast("bigint"))


def _merge(kind: str, carry: Column, local: Column) -> Column:
    if kind == "sum":
        return F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))
    pick = F.greatest if kind == "max" else F.least
    return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(pick(carry, local))


_KEY = "__key"


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the keys as one struct, which is never null: rows with null keys are a key of their own."""
    return df.withColumn(_KEY, F.struct(*[F.col(f"`{k}`") for k in keys]))


def running(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    columns: Mapping[str, Running],
    span: int = SPAN,
    levels: int = 1,
) -> DataFrame:
    """Add running aggregates per ``keys`` in ``position`` order.

    ``position`` is a BIGINT that is unique per key; rows with null keys form keys as well. With
    ``levels`` above one the block totals are cut into blocks too, for very sparse positions.
    """
    return _running(_keyed(df, keys), [_KEY], position, columns, span, levels).drop(_KEY)


def _running(
    df: DataFrame,
    keys: list[str],
    position: str,
    columns: Mapping[str, Running],
    span: int,
    levels: int,
) -> DataFrame:
    blocked = df.withColumn(_BLOCK, block_of(F.col(position), span))
    totals = blocked.groupBy(*keys, _BLOCK).agg(
        *[_AGGREGATES[spec.kind](spec.value).alias(name) for name, spec in columns.items()]
    )
    before = {name: Running(spec.kind, F.col(name), True) for name, spec in columns.items()}
    if levels > 1:
        renamed = totals.withColumnRenamed(_BLOCK, "__outer")
        before = {f"__carry_{name}": spec for name, spec in before.items()}
        carry = _running(renamed, keys, "__outer", before, span, levels - 1)
        carry = carry.withColumnRenamed("__outer", _BLOCK).drop(*columns)
    else:
        earlier = (
            Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        )
        carry = totals.select(
            *keys,
            _BLOCK,
            *[
                _AGGREGATES[spec.kind](spec.value).over(earlier).alias(f"__carry_{name}")
                for name, spec in before.items()
            ],
        )

    in_block = Window.partitionBy(*keys, _BLOCK).orderBy(position)
    frames = {
        False: in_block.rowsBetween(Window.unboundedPreceding, 0),
        True: in_block.rowsBetween(Window.unboundedPreceding, -1),
    }
    local = blocked
    for name, spec in columns.items():
        local = local.withColumn(
            name, _AGGREGATES[spec.kind](spec.value).over(frames[spec.exclusive])
        )
    # First blocks carry nothing. Without them the carry of many short groups is empty, and
    # adaptive execution drops or broadcasts the join.
    useful = [
        F.coalesce(F.col(f"__carry_{name}") != 0, F.lit(False))
        if spec.kind == "sum"
        else F.col(f"__carry_{name}").isNotNull()
        for name, spec in columns.items()
    ]
    joined = local.join(carry.where(reduce(Column.__or__, useful)), [*keys, _BLOCK], "left")
    for name, spec in columns.items():
        joined = joined.withColumn(
            name, _merge(spec.kind, F.col(f"__carry_{name}"), F.col(name))
        )
    return joined.drop(_BLOCK, *[f"__carry_{name}" for name in columns])


def streaks(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    reset: str,
    add: str,
    name: str = "streak",
    span: int = SPAN,
) -> DataFrame:
    """Add the sum of ``add`` since the last row with ``reset``, that row included.

    ``add`` is a count (0 or more). A row that resets and adds counts from its own addition.
    Rows with null keys form keys as well. Keep ``df`` narrow: its one exchange feeds both the
    rows and the block totals.
    """
    blocked = _keyed(df, keys).withColumn(_BLOCK, block_of(F.col(position), span))
    keys = [_KEY]
    upto = (
        Window.partitionBy(*keys, _BLOCK)
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    local = blocked.withColumn("__sum", F.sum(add).over(upto)).withColumn(
        "__base", F.max(F.when(F.col(reset), F.col("__sum") - F.col(add))).over(upto)
    )
    totals = local.groupBy(*keys, _BLOCK).agg(
        F.max("__sum").alias("__sum"), F.max("__base").alias("__base")
    )
    earlier = (
        Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = (
        totals.withColumn("__sum0", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)))
        .withColumn("__base0", F.max(F.col("__sum0") + F.col("__base")).over(earlier))
        .select(*keys, _BLOCK, "__sum0", "__base0")
        .where((F.col("__sum0") != 0) | F.col("__base0").isNotNull())
    )
    joined = local.join(carry, [*keys, _BLOCK], "left").fillna({"__sum0": 0})
    # greatest() skips nulls; with no reset at all the sum counts from zero.
    base = F.coalesce(
        F.greatest(F.col("__sum0") + F.col("__base"), F.col("__base0")), F.lit(0)
    )
    return joined.withColumn(name, F.col("__sum0") + F.col("__sum") - base).drop(
        _KEY, _BLOCK, "__sum", "__base", "__sum0", "__base0"
    )
