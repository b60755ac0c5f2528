"""Sequence numbers: decimal digit strings of any width."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def plain(c: Column) -> Column:
    """Drop leading zeros, keep a single '0'."""
    bare = F.ltrim(c, F.lit("0"))
    return F.when(bare == "", F.lit("0")).otherwise(bare)


def order(c: Column) -> Column:
    """A sortable key with numeric order: shorter digit strings come first."""
    bare = plain(c)
    return F.when(
        c.isNotNull(), F.struct(F.length(bare).alias("width"), bare.alias("digits"))
    )
