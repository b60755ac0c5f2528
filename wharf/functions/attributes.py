"""Attribute-map expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wharf.functions.once import once


def empty() -> Column:
    return F.create_map().cast("map<string,string>")


def or_empty(c: Column) -> Column:
    return F.coalesce(c, empty())


def put(attributes: Column, values: dict[str, Column]) -> Column:
    """Overwrite the given keys, keep all others; needs no map-key session setting."""
    pairs = F.create_map(*[part for k, v in values.items() for part in (F.lit(k), v)])
    return F.map_concat(drop(attributes, *values), pairs)


def drop(attributes: Column, *keys: str) -> Column:
    return F.map_filter(attributes, lambda k, _: ~k.isin(*keys))


def from_headers(headers: Column) -> Column:
    """Header array to attributes: last entry of a key wins, null value becomes ''.

    Array lambdas are interpreted, so they run only for arrays that need them: those with a
    repeated key, a null value, or bytes that are not UTF-8.
    """
    keys, plain = headers["key"], headers["value"].cast("array<string>")
    # An ASCII separator keeps broken byte sequences broken, and a null adds one character.
    joined = F.array_join(plain, ",", "?")
    clean = F.is_valid_utf8(joined) & (
        F.octet_length(joined) == F.octet_length(F.array_join(plain, ","))
    )
    distinct = F.size(F.array_distinct(keys)) == F.size(headers)
    latest = once(
        F.reverse(keys),
        lambda backwards: F.filter(
            headers, lambda h, i: F.array_position(backwards, h["key"]) == F.size(headers) - i
        ),
    )
    decoded = F.map_from_entries(
        F.transform(
            latest,
            lambda h: F.struct(
                h["key"].alias("key"),
                F.coalesce(F.make_valid_utf8(h["value"].cast("string")), F.lit("")).alias("value"),
            ),
        )
    )
    return or_empty(F.when(distinct & clean, F.map_from_arrays(keys, plain)).otherwise(decoded))


def to_headers(attributes: Column) -> Column:
    return F.transform(
        F.map_entries(attributes),
        lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value")),
    )


def as_text(attributes: Column) -> Column:
    """``k=v`` pairs sorted by key and joined with ``;`` — for reports and comparisons."""
    pairs = F.transform(
        F.sort_array(F.map_keys(attributes)),
        lambda k: F.concat(k, F.lit("="), F.element_at(attributes, k)),
    )
    return F.array_join(pairs, ";")
