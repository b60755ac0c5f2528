"""JSON contracts per topic: registry, encoding, validation, quarantine."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from wharf.functions import json as J
from wharf.functions.once import once, with_once
from wharf.functions.text import is_blank
from wharf.plans.joins import fits, lookup
from wharf.plans.running import SPAN, Running, running
from wharf.schemas import REQUIRED_FIELDS
from wharf.session import settle

Validator = Callable[[Column], Column]

# Reasons a payload or a schema definition is refused.
EMPTY_PAYLOAD = "empty payload"
EMPTY_DOCUMENT = "non-JSON payload: empty document"
TRAILING = "non-JSON payload: trailing content after JSON value"
MALFORMED = "non-JSON payload: malformed document"
NOT_OBJECT = "expected JSON object at root, got "
MISSING_FIELD = "missing required field"

DEFINITION_NULL = "json must not be null"
DEFINITION_EMPTY = "invalid JSON: empty document"
DEFINITION_TRAILING = "invalid JSON: trailing content after schema document"
DEFINITION_MALFORMED = "invalid JSON: malformed document"
DEFINITION_NOT_OBJECT = "schema must be a JSON object"
FIELDS_MISSING = "missing 'requiredFields'"
FIELDS_NOT_ARRAY = "'requiredFields' must be a JSON array"
ENTRY_NOT_OBJECT = "requiredFields entry must be a JSON object"
ENTRY_NAME = "requiredFields entry missing non-blank 'name'"
ENTRY_TYPE = "requiredFields entry missing textual 'type'"
DUPLICATE_NAME = "duplicate field name: "
UNKNOWN_TYPE = "unknown field type: "


# --- registry ---------------------------------------------------------------


def registry(changes: DataFrame) -> DataFrame:
    """Current schemas from a change log ``(topic, op, required_fields, seq)``.

    The last change of a topic decides; ``op`` is register or unregister.
    """
    latest = changes.groupBy("topic").agg(
        F.max_by(F.struct("op", "required_fields"), "seq").alias("latest")
    )
    return latest.where(F.col("latest.op") == "register").select(
        "topic", F.col("latest.required_fields").alias("required_fields")
    )


def encode(required_fields: Column) -> Column:
    """Schema to its JSON text, fields in declaration order."""
    return F.to_json(F.struct(required_fields.cast(REQUIRED_FIELDS).alias("requiredFields")))


def declare(*fields: tuple[str, str]) -> Column:
    """A literal required-field list; declaring a name again replaces its type."""
    for name, kind in fields:
        if name is None or not name.strip():
            raise ValueError("field name must be non-blank")
        if kind not in J.FIELD_TYPES:
            raise ValueError(UNKNOWN_TYPE + kind)
    entries = [
        F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type"))
        for name, kind in dict(fields).items()
    ]
    return F.array(*entries).cast(REQUIRED_FIELDS)


def decode(df: DataFrame, text: str) -> DataFrame:
    """Read a column of schema definitions; adds ``required_fields`` and ``reason``.

    Exactly one of the two is null. Entries are checked in order and the first broken one
    gives the reason.
    """


    def entry(e: Column) -> Column:
        return once(
            J.members(e),
            lambda m: F.struct(
                m.isNotNull().alias("is_object"),
                J.text_of(F.element_at(m, "name")).alias("name"),
                J.text_of(F.element_at(m, "type")).alias("type"),
            ),
        )

    def refusal(entries: Column) -> Column:
        names = F.transform(entries, lambda e: e["name"])
        reasons = F.transform(
            entries,
            lambda e, i: F.when(~e["is_object"], F.lit(ENTRY_NOT_OBJECT))
            .when(is_blank(e["name"]), ENTRY_NAME)
            .when(e["type"].isNull(), ENTRY_TYPE)
            .when(
                F.array_position(names, e["name"]) != i + 1,
                F.concat(F.lit(DUPLICATE_NAME), e["name"]),
            )
            .when(~e["type"].isin(*J.FIELD_TYPES), F.concat(F.lit(UNKNOWN_TYPE), e["type"])),
        )
        return F.get(F.filter(reasons, lambda r: r.isNotNull()), F.lit(0))

    def result(reason: Column, entries: Column | None = None) -> Column:
        fields = F.lit(None)
        if entries is not None:
            fields = F.when(
                reason.isNull(),
                F.transform(
                    entries, lambda e: F.struct(e["name"].alias("name"), e["type"].alias("type"))
                ),
            )
        return F.struct(reason.alias("reason"), fields.cast(REQUIRED_FIELDS).alias("fields"))

    def of_list(found: Column) -> Column:
        """``found`` is the requiredFields value."""
        return once(
            F.when(J.type_tag(found) == "ARRAY", F.try_variant_get(found, "$", "array<variant>")),
            lambda items: F.when(items.isNull(), result(F.lit(FIELDS_NOT_ARRAY))).otherwise(
                once(
                    F.transform(items, entry),
                    lambda entries: once(refusal(entries), lambda r: result(r, entries)),
                )
            ),
        )

    def of_members(members: Column) -> Column:
        listed = F.element_at(members, "requiredFields")
        return F.when(members.isNull(), result(F.lit(DEFINITION_NOT_OBJECT))).otherwise(
            once(
                listed,
                lambda found: F.when(found.isNull(), result(F.lit(FIELDS_MISSING))).otherwise(
                    of_list(found)
                ),
            )
        )

    def of_document(doc: Column) -> Column:
        return (
            F.when(F.col(text).isNull(), result(F.lit(DEFINITION_NULL)))
            .when(doc["is_void"], result(F.lit(DEFINITION_EMPTY)))
            .when(doc["has_trailing"], result(F.lit(DEFINITION_TRAILING)))
            .when(doc["root"].isNull(), result(F.lit(DEFINITION_MALFORMED)))
            .otherwise(once(J.members(doc["root"]), of_members))
        )

    decoded = with_once(df, "__decoded", once(J.document(F.col(text)), of_document))
    return decoded.select(
        *df.columns,
        F.col("__decoded.fields").alias("required_fields"),
        F.col("__decoded.reason").alias("reason"),
    )


# --- validation -------------------------------------------------------------


def _payload_text(payload: Column) -> Column:
    """Payload as text without a byte-order mark; null for bytes that are not UTF-8."""
    text = payload.cast("string")
    valid = F.when(F.is_valid_utf8(text), text)
    return F.when(F.startswith(valid, F.lit("\ufeff")), F.substring(valid, 2, 2**31 - 1)).otherwise(
        valid
    )


def validate(df: DataFrame, validators: Mapping[str, Validator] | None = None) -> DataFrame:
    """Add ``violation`` (``field_name, reason``; null when the row is fine).

    ``df`` is an envelope table with a ``required_fields`` column; a null list means the
    topic has no contract and the row passes. Only the first failure is reported.
    ``validators`` gives a topic its own check in place of the field list: a function from
    the payload column to a reason (null = fine); a pandas UDF will do.
    """

    def first_broken(members: Column) -> Column:
        typed = F.transform(
            "required_fields",
            lambda f: F.struct(
                f["name"].alias("name"),
                f["type"].alias("type"),
                J.type_tag(F.element_at(members, f["name"])).alias("got"),
            ),
        )
        wrong = F.filter(typed, lambda f: f["got"].isNull() | (f["got"] != f["type"]))
        return once(
            F.get(wrong, F.lit(0)),
            lambda f: F.when(
                f.isNotNull(),
                _violation(
                    f["name"],
                    F.when(f["got"].isNull(), F.lit(MISSING_FIELD)).otherwise(
                        F.concat(F.lit("expected "), f["type"], F.lit(", got "), f["got"])
                    ),
                ),
            ),
        )

    def of_root(root: Column) -> Column:
        other = F.concat(F.lit(NOT_OBJECT), J.type_tag(root))
        return once(
            J.members(root),
            lambda m: F.when(m.isNull(), _violation(None, other)).otherwise(first_broken(m)),
        )

    def of_document(doc: Column) -> Column:
        return (
            F.when(doc["is_void"] | doc["starts_null"], _violation(None, F.lit(EMPTY_DOCUMENT)))
            .when(doc["has_trailing"], _violation(None, F.lit(TRAILING)))
            .when(doc["root"].isNull(), _violation(None, F.lit(MALFORMED)))
            .otherwise(of_root(doc["root"]))
        )

    payload = F.col("payload")
    # Topics without a contract skip the parsing.
    violation = F.when(
        F.col("required_fields").isNotNull(),
        F.when(F.length(payload) == 0, _violation(None, F.lit(EMPTY_PAYLOAD))).otherwise(
            once(_payload_text(payload), lambda text: once(J.document(text), of_document))
        ),
    )
    for topic, check_payload in (validators or {}).items():
        own = check_payload(payload)
        violation = F.when(
            F.col("topic") == topic, F.when(own.isNotNull(), _violation(None, own))
        ).otherwise(violation)
    return with_once(df, "violation", violation)


def _violation(field: Column | None, reason: Column) -> Column:
    name = F.lit(None).cast("string") if field is None else field
    return F.struct(name.alias("field_name"), reason.alias("reason"))


def check(
    messages: DataFrame,
    schemas: DataFrame,
    validators: Mapping[str, Validator] | None = None,
) -> DataFrame:
    """Look the contract of each message up by topic and validate; other topics pass."""
    bound = lookup(messages, schemas.select("topic", "required_fields"), ["topic"], "left")
    return validate(bound, validators).drop("required_fields")


#: Versions of one topic that are held against each of its messages in a broadcast join.
FEW_VERSIONS = 64


def versions(changes: DataFrame) -> DataFrame:
    """The change log with one row for each topic and ``seq``.

    Of several changes at one place a registration counts more than the removal.
    """
    change = F.struct((F.col("op") == "register").alias("on"), "required_fields")
    latest = changes.where(F.col("seq").isNotNull()).groupBy("topic", "seq").agg(F.max(change).alias("c"))
    fields = F.when(F.col("c.on"), F.col("c.required_fields"))
    op = F.when(F.col("c.on"), "register").otherwise("unregister")
    return latest.select("topic", op.alias("op"), fields.alias("required_fields"), "seq")


def bind_as_of(
    messages: DataFrame,
    changes: DataFrame,
    at: str = "seq",
    span: int = SPAN,
    few: int = FEW_VERSIONS,
    versioned: bool = False,
) -> DataFrame:
    """Add ``required_fields``: the contract that was valid at each message (null: none).

    ``changes`` is a change log ``(topic, op, required_fields, seq)`` in the same order as the
    messages' column ``at``. A message is bound to the last change at or before it; a removal, or
    nothing before it, leaves it without a contract, as does a missing ``at``. With ``versioned``,
    ``changes`` is a stored result of :func:`versions`.

    With few versions a topic they are broadcast as intervals. Else messages and changes run along
    the topic together: the last change is a running maximum over blocks of positions, so neither
    the messages nor the versions of a hot topic meet in one task.
    """
    known = changes if versioned else settle(versions(changes))
    of_topic = known.groupBy("topic").agg(F.count("*").alias("n"))
    most = of_topic.agg(F.max("n")).first()[0] or 0
    kept = [F.col(f"`{c}`") for c in messages.columns if c != "required_fields"]
    place = F.col(f"`{at}`").cast("bigint")
    if most <= few and fits(known):
        following = F.lead("seq").over(Window.partitionBy("topic").orderBy("seq"))
        intervals = known.select(
            F.col("topic").alias("__topic"),
            F.col("seq").alias("__from"),
            following.alias("__to"),
            "required_fields",
        )
        inside = (place >= F.col("__from")) & (F.col("__to").isNull() | (place < F.col("__to")))
        found = messages.select(*kept).join(
            F.broadcast(intervals), (F.col("topic") == F.col("__topic")) & inside, "left"
        )
        return found.drop("__topic", "__from", "__to")
    # A change comes before the messages at its place.
    marks = known.select("topic", (F.col("seq") * 2).alias("__at"), F.col("seq").alias("__version"))
    rows = messages.select(*kept, (place * 2 + 1).alias("__at"), F.lit(True).alias("__message"))
    along = running(
        rows.unionByName(marks, allowMissingColumns=True),
        ["topic"],
        "__at",
        {"__valid": Running("max", F.col("__version"))},
        span,
    ).where("__message")
    named = along.withColumn("__valid", F.when(F.col("__at").isNotNull(), F.col("__valid")))
    bound = lookup(
        named.drop("__at", "__message", "__version"),
        known.select("topic", F.col("seq").alias("__valid"), "required_fields"),
        ["topic", "__valid"],
        "left",
    )
    return bound.select(*kept, "required_fields")


def check_as_of(
    messages: DataFrame,
    changes: DataFrame,
    at: str = "seq",
    validators: Mapping[str, Validator] | None = None,
    span: int = SPAN,
    few: int = FEW_VERSIONS,
    versioned: bool = False,
) -> DataFrame:
    """Validate every message by the contract that was valid at it."""
    return validate(bind_as_of(messages, changes, at, span, few, versioned), validators).drop("required_fields")


def message_of(topic: Column, field: Column, reason: Column) -> Column:
    return F.concat(
        F.lit("topic="),
        topic,
        F.when(field.isNotNull(), F.concat(F.lit(" field="), field)).otherwise(F.lit("")),
        F.lit(" reason="),
        reason,
    )


def violations(checked: DataFrame) -> DataFrame:
    """The refused rows as ``id, topic, field_name, reason, message``."""
    field, reason = F.col("violation.field_name"), F.col("violation.reason")
    return checked.where(F.col("violation").isNotNull()).select(
        "id",
        "topic",
        field.alias("field_name"),
        reason.alias("reason"),
        message_of(F.col("topic"), field, reason).alias("message"),
    )


def report(checked: DataFrame) -> DataFrame:
    """Violations per topic, field and reason."""
    return violations(checked).groupBy("topic", "field_name", "reason").agg(
        F.count("*").alias("messages")
    )


def skip_invalid(checked: DataFrame) -> DataFrame:
    """Policy SKIP: drop refused rows and go on."""
    return checked.where(F.col("violation").isNull()).drop("violation")


def fail_on_invalid(checked: DataFrame) -> DataFrame:
    """Policy FAIL: the job stops at a refused row."""
    field, reason = F.col("violation.field_name"), F.col("violation.reason")
    stop = F.raise_error(message_of(F.col("topic"), field, reason)).cast("boolean")
    return checked.where(
        F.when(F.col("violation").isNull(), F.lit(True)).otherwise(stop)
    ).drop("violation")
