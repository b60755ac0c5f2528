"""Evaluate an expensive expression once per row.

The optimizer inlines column definitions wherever they are used, also when it pushes a
filter down; an expression used five times is then worked out five times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with the value bound to a lambda variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that filters above it read instead of computing it again.

    A one-element explode never drops or adds rows, and nothing is pushed through it.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name))
