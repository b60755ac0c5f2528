"""Strict one-document JSON checks on text, built on the variant functions.

``try_parse_json`` ignores whatever follows the first value. Wrapping the text once as an
array element and once as an object value closes that gap: trailing text would have to
continue an array and an object at the same time, which no text can. A text without ``]`` cannot
end the array early, so for it the array alone decides: it is one value if the array has one
element. The wrapping costs one level of nesting, so a text at the parser's limit is judged by
its brackets instead.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wharf.functions.once import once

# The type tags of a required field.
FIELD_TYPES = ("STRING", "NUMBER", "BOOLEAN", "OBJECT", "ARRAY")


def _closes_at_end(text: Column) -> Column:
    """Whether the first bracket of a text is closed by its last character."""
    trimmed = F.regexp_replace(text, r"\A[ \t\r\n]+|[ \t\r\n]+\z", "")
    bare = F.regexp_replace(trimmed, r'"(?:[^"\\]|\\.)*+"', "")
    brackets = F.regexp_replace(bare, r"[^\[\]{}]+", "")
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("closed"))
    ended = F.aggregate(
        F.split(brackets, ""),
        start,
        lambda acc, c: once(
            acc["depth"] + F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0),
            lambda depth: F.struct(
                depth.alias("depth"),
                (acc["closed"] + F.when((c != "") & (depth <= 0), 1).otherwise(0)).alias("closed"),
            ),
        ),
    )
    outer = trimmed.rlike(r"(?s)\A[\[{].*[\]}]\z")
    return F.when(outer, (ended["depth"] == 0) & (ended["closed"] == 1)).otherwise(F.lit(False))


def document(text: Column) -> Column:
    """What one JSON text holds, as a struct.

    ``root``: the value as a variant, if the text is exactly one value, else null.
    ``starts_null``: the first value is the null literal.
    ``has_trailing``: a first value exists but more text follows it.
    ``is_void``: nothing but JSON whitespace.
    """
    in_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"x":'), text, F.lit("}")))

    def values(array: Column) -> Column:
        # A failed parse is the costly one, so the second try needs the first to succeed.
        # Nothing but white space gives an array without elements, whose root is null as well.
        fits = (
            F.when(array.isNull(), F.lit(False))
            .when(F.contains(text, F.lit("]")), in_object.isNotNull())
            .otherwise(F.variant_get(array, "$[1]", "variant").isNull())
        )
        return once(
            fits,
            lambda single: F.struct(
                F.when(single, F.variant_get(array, "$[0]", "variant")).alias("root"),
                # Only rows that are not a single document pay for this parse.
                F.when(~single, F.try_parse_json(text)).alias("first"),
            ),
        )

    def deepest(v: Column) -> Column:
        """A text that only the wrapping made too deep is a single document after all."""
        whole = F.when(v["first"].isNotNull(), _closes_at_end(text)).otherwise(F.lit(False))
        return once(
            whole,
            lambda single: F.struct(
                F.when(single, v["first"]).otherwise(v["root"]).alias("root"),
                F.when(~single, v["first"]).alias("first"),
            ),
        )

    def described(v: Column) -> Column:
        nothing = v["root"].isNull() & v["first"].isNull()
        void = F.when(nothing, text.rlike(r"\A[ \t\r\n]*\z"))
        return F.struct(
            v["root"].alias("root"),
            F.coalesce(F.is_variant_null(F.coalesce(v["root"], v["first"])), F.lit(False)).alias(
                "starts_null"
            ),
            v["first"].isNotNull().alias("has_trailing"),
            F.coalesce(void, F.lit(False)).alias("is_void"),
        )

    return once(
        in_array,
        lambda array: once(values(array), lambda v: once(deepest(v), described)),
    )


# How the variant type names of JSON values start, and their tags.
_TAGS = {
    "STR": "STRING",
    "BOO": "BOOLEAN",
    "OBJ": "OBJECT",
    "ARR": "ARRAY",
    "BIG": "NUMBER",
    "DOU": "NUMBER",
    "FLO": "NUMBER",
    "DEC": "NUMBER",
}


def type_tag(value: Column) -> Column:
    """STRING, NUMBER, BOOLEAN, OBJECT, ARRAY; null for a JSON null or a missing value.

    One map access, so that the type is worked out once even inside array lambdas.
    """
    tags = F.create_map(*[F.lit(part) for pair in _TAGS.items() for part in pair])
    return F.try_element_at(tags, F.substring(F.schema_of_variant(value), 1, 3))


def members(root: Column) -> Column:
    """An object's members by name; null for every other root.

    Names are looked up in the map at run time, so dots and quotes in them need no escaping.
    """
    return F.try_variant_get(root, "$", "map<string,variant>")


def text_of(value: Column) -> Column:
    """The text of a JSON string; null for any other type."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))
