"""Record admission.

Every record leaves with a disposition: ``pending`` (goes on to coercion,
which turns it into ``emitted`` or ``error``) or ``skipped`` with a reason.
Checks run in the reference's order; the first hit decides:

* ``empty``       value is null or has no bytes (F1)
* ``non_object``  the text is blank, or parses to something other than an object (F3)
* ``unparsable``  the text is not strict JSON (F2)
* ``deleted``     the unwrapped body has ``__deleted`` whose text is ``true`` (F4)
* ``reserved_field``  the body has a field that the sink reserves for itself
* ``no_table``    (an error, not skipped) the routing gives no table name

One strict parse per record (``try_parse_json``) feeds every later step:
single quotes, NaN, leading zeros and raw control characters are rejected,
text after the first value is ignored and the last of duplicate keys wins.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.json import blank_text, decode_utf8, is_object
from driftline.functions.route import topic_to_table

PENDING, EMITTED, SKIPPED, ERROR = "pending", "emitted", "skipped", "error"
#: The reason of records that are errors before any coercion.
NO_TABLE = "no_table"


# An object without any value in it, however deep: only keys, braces, colons and
# commas.  Every repetition is possessive: Java's matcher runs those in a loop,
# where a backtracking group calls itself for each character of a long text.
_NO_VALUES = r'^(?:[{},]|"(?:[^"\\]|\\.)*+":)*+\z'
_EMPTY_OBJECT = r"\{[ \t\r\n]*+\}"


def hollow(v: Column) -> Column:
    """An object with no value inside (``{}``, ``{"a":{}}``).  The test ends at the
    first value, so a long text beside an empty object costs nothing more."""
    return F.coalesce(is_object(v) & F.to_json(v).rlike(_NO_VALUES), F.lit(False))


def typed_names(text: Column, envelope: Column, members: Column) -> Column:
    """Names of the members that pin a type: all but the hollow ones.  Only a text
    with an empty object somewhere is looked at member by member; a plain one
    without gives its names as they are read."""
    empty = text.rlike(_EMPTY_OBJECT)
    return (F.when(empty, F.map_keys(F.map_filter(members, lambda k, v: ~hollow(v))))
            .when(envelope, F.map_keys(members)).otherwise(F.sort_array(F.array_distinct(F.json_object_keys(text)))))


def admit(records: DataFrame, route: Callable[[Column], Column] = topic_to_table,
          reserved: tuple[str, ...] = ()) -> DataFrame:
    """Record frame -> admitted frame.

    Output columns: topic, partition, offset, table, text, first_byte,
    envelope, fields (names of the row object that pin a type), disposition,
    reason.
    """
    decoded = records.select(
        "topic", "partition", "offset",
        route(F.col("topic")).alias("table"),
        decode_utf8(F.col("value")).alias("text"),
        F.hex(F.substring(F.col("value"), 1, 1)).alias("first_byte"),
        (F.col("value").isNull() | (F.octet_length(F.col("value")) == 0)).alias("_empty"),
    )
    parsed = decoded.withColumn("_doc", F.try_parse_json(F.col("text")))
    payload = F.try_variant_get(F.col("_doc"), "$.payload", "variant")
    with_body = parsed.withColumn("_payload", payload).withColumn(
        "envelope", F.coalesce(is_object(F.col("_payload")), F.lit(False)))
    body = F.when(F.col("envelope"), F.col("_payload")).otherwise(F.col("_doc"))
    with_body = with_body.withColumn("body", body)
    deleted = F.try_variant_get(F.col("body"), "$.__deleted", "string") == F.lit("true")
    # Blank text also fails to parse; the whitespace test runs only then.
    reason = (F.when(F.col("_empty"), F.lit("empty"))
              .when(F.col("_doc").isNull(),
                    F.when(blank_text(F.col("text")), F.lit("non_object")).otherwise(F.lit("unparsable")))
              .when(~is_object(F.col("_doc")), F.lit("non_object"))
              .when(F.coalesce(deleted, F.lit(False)), F.lit("deleted")))
    for name in reserved:
        own = F.try_variant_get(F.col("body"), f"$.{name}", "variant")
        reason = reason.when(own.isNotNull(), F.lit("reserved_field"))
    # Without a table there is nowhere to go on to.
    reason = reason.when(F.coalesce(F.col("table"), F.lit("")) == "", F.lit(NO_TABLE))
    members = F.try_variant_get(F.col("body"), "$", "map<string,variant>")
    names = typed_names(F.col("text"), F.col("envelope"), members)
    return with_body.withColumn("reason", reason).select(
        "topic", "partition", "offset", "table", "text", "first_byte", "envelope",
        F.when(F.col("reason").isNull(), names).alias("fields"),
        F.when(F.col("reason").isNull(), F.lit(PENDING)).when(F.col("reason") == NO_TABLE, F.lit(ERROR))
        .otherwise(F.lit(SKIPPED)).alias("disposition"),
        "reason",
    )


def body_text() -> Column:
    """Text of the row object in document order: the whole value, or the raw
    text of ``payload`` for an envelope."""
    payload = F.from_json(F.col("text"), "struct<payload: string>").getField("payload")  # last one wins
    return F.when(F.col("envelope"), payload).otherwise(F.col("text"))


def body_variant() -> Column:
    """The row object as a VARIANT."""
    doc = F.try_parse_json(F.col("text"))
    return F.when(F.col("envelope"), F.try_variant_get(doc, "$.payload", "variant")).otherwise(doc)
