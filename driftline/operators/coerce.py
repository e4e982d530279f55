"""Value coercion (C1-C12, P5, F5): one schema-driven Column per field.

``coerce_value(v, type)`` turns a VARIANT holding one JSON value into a
column of ``type`` with the reference's rules, and reports a per-row error
flag where conversion can fail.  Absent or JSON null gives null everywhere.
Wrong kinds give the JSON accessor defaults: false / 0 / 0.0 / '' (for
objects and arrays in text columns) / an empty array (scalars in array
columns) / the object's values (objects in array columns) / null (non-objects
in struct columns).  Dates and timestamps (only in tables that already
exist) can fail; such a record becomes ``error`` / ``convert_error``.

Everything is built from Catalyst expressions, so the projection stays in
whole-stage code generation; nested arrays use ``transform``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.json import (
    bound, is_integer_kind, is_json_null, is_number_kind, is_object, json_kind, jvm_number_text,
)
from driftline.operators.admit import body_variant
from driftline.operators.infer import NESTED_LEVELS, OVERFLOW, quote

SRC, ERR, LOSS, MAYBE = "_dl_src", "_dl_error", "_dl_loss", "_dl_maybe_lossy"

_INTEGRALS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
# java.time.Instant.parse on the pinned JDK 11: seconds required, 0-9 fraction
# digits, literal Z (letters case-insensitive).
_ISO_INSTANT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?[Zz]\z"


def ddl_type(dtype: T.DataType) -> str:
    """DDL text for a type, with every nested field name quoted."""
    if isinstance(dtype, T.StructType):
        return "struct<" + ",".join(f"{quote(f.name)}: {ddl_type(f.dataType)}" for f in dtype.fields) + ">"
    if isinstance(dtype, T.ArrayType):
        return f"array<{ddl_type(dtype.elementType)}>"
    if isinstance(dtype, T.MapType):
        return f"map<{ddl_type(dtype.keyType)},{ddl_type(dtype.valueType)}>"
    return dtype.simpleString()


def variant_fields(v: Column, names: list[str]) -> Column:
    """The named members of an object as a struct of VARIANTs (null if not an object)."""
    ddl = "struct<" + ",".join(f"{quote(n)}: variant" for n in names) + ">"
    return F.try_variant_get(v, "$", ddl)


def text_value(v: Column, kind: Column, raw: Column | None = None, level: int = 0) -> Column:
    """The JSON node's text.  Objects and arrays give '' (their JSON text where
    ``level`` of them already lie around: types end there).  Numbers print
    as the JVM prints the parsed node: from ``raw`` (the token as the typed
    reader prints it) when given, else rebuilt from the VARIANT."""
    number = raw if raw is not None else jvm_number_text(v, kind)
    return (F.when(kind == "STRING", F.try_variant_get(v, "$", "string"))
            .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "string"))
            .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.to_json(v) if level >= NESTED_LEVELS else F.lit(""))
            .when(is_number_kind(kind), number)
            .otherwise(F.try_variant_get(v, "$", "string")))


def _or(a: Column | None, b: Column | None) -> Column | None:
    if a is None:
        return b
    if b is None:
        return a
    return a | b


def can_fail(dtype: T.DataType) -> bool:
    """Whether a conversion to the type can make the record an error."""
    if isinstance(dtype, T.StructType):
        return any(can_fail(f.dataType) or not f.nullable for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return can_fail(dtype.elementType)
    return not isinstance(dtype, _INTEGRALS + (T.BooleanType, T.FloatType, T.DoubleType, T.StringType, T.VarcharType,
                                               T.CharType, T.BinaryType))


#: Where Spark keeps the declared type of a text column with a length.
DECLARED = "__CHAR_VARCHAR_TYPE_STRING"


def too_long(value: Column, dtype: T.DataType) -> Column | None:
    """Whether a text is longer than its CHAR or VARCHAR, at any level (an insert cuts
    trailing spaces and refuses the rest); ``None`` where no length is declared."""
    if isinstance(dtype, (T.CharType, T.VarcharType)):
        return F.coalesce(F.length(F.rtrim(value)) > dtype.length, F.lit(False))
    if isinstance(dtype, T.StructType):
        out = None
        for f in dtype.fields:
            out = _or(out, too_long(value.getField(f.name), f.dataType))
        return out
    if isinstance(dtype, T.ArrayType) and too_long(value, dtype.elementType) is not None:
        return F.coalesce(F.exists(value, lambda e: too_long(e, dtype.elementType)), F.lit(False))
    return None


def row_too_long(schema: T.StructType) -> Column | None:
    """``too_long`` over the columns of a live table; ``None`` where no column declares a length."""
    out = None
    for f in schema.fields:
        declared = f.metadata.get(DECLARED) if f.metadata else None
        out = _or(out, too_long(F.col(quote(f.name)), T._parse_datatype_string(declared) if declared else f.dataType))
    return out


def coerce_value(v: Column, dtype: T.DataType, raw: Column | None = None,
                 kind: Column | None = None) -> tuple[Column, Column | None]:
    """(typed value, error flag or None when this type cannot fail).

    ``raw`` optionally carries the value's JSON text as the typed reader
    prints it (top-level fields): numbers in text columns then print exactly
    like the JVM (``-0.0``), and an object in an array column gives its values
    in document order.  ``kind`` carries ``json_kind(v)`` where it is
    already at hand."""
    return typed_value(v, dtype, raw, kind), conversion_error(v, dtype, kind)


def _elements(v: Column, raw: Column | None = None) -> Column:
    """C11: an array's elements, an object's values, null for anything else."""
    items = F.try_variant_get(v, "$", "array<variant>")
    if raw is not None:
        # document order, last of repeated keys at its first position
        values = F.map_values(F.map_from_entries(F.map_entries(F.from_json(raw, "map<string,variant>"))))
    else:
        values = F.map_values(F.try_variant_get(v, "$", "map<string,variant>"))
    return F.when(items.isNotNull(), items).when(is_object(v), values)


_UNCHECKED = _INTEGRALS + (T.BooleanType, T.FloatType, T.DoubleType, T.StringType, T.VarcharType, T.CharType, T.BinaryType,
                           T.StructType, T.ArrayType, T.MapType)


def typed_value(v: Column, dtype: T.DataType, raw: Column | None = None, kind: Column | None = None, level: int = 0) -> Column:
    """The typed value; ``level`` counts the objects and arrays around it."""
    kind = json_kind(v) if kind is None else kind
    if not isinstance(dtype, _UNCHECKED):
        # Value and kind are used many times over; a filter on errors repeats whatever is written out.
        return bound(F.struct(v.alias("v"), kind.alias("k")), lambda x: checked_value(x["v"], dtype, x["k"]))
    null = is_json_null(v)
    typed_null = F.lit(None).cast(dtype)

    if isinstance(dtype, T.BooleanType):
        val = F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean")).otherwise(F.lit(False))

    elif isinstance(dtype, _INTEGRALS + (T.FloatType, T.DoubleType)):
        if isinstance(dtype, _INTEGRALS):
            num = F.try_variant_get(v, "$", dtype.simpleString())
        else:
            num = F.try_variant_get(v, "$", "double").cast(dtype)
        val = F.when(is_number_kind(kind), num).otherwise(F.lit(0).cast(dtype))

    elif isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        val = text_value(v, kind, raw, level)

    elif isinstance(dtype, T.BinaryType):
        val = F.encode(text_value(v, kind, raw, level), "UTF-8")

    elif isinstance(dtype, T.StructType):          # C10: recursive, non-object -> null
        if not dtype.fields:
            return typed_null
        members = F.when(is_object(v), variant_fields(v, [f.name for f in dtype.fields]))
        return bound(members, lambda m: F.when(m.isNotNull(), F.struct(
            *[typed_value(m.getField(f.name), f.dataType, level=level + 1).alias(f.name) for f in dtype.fields]))).cast(dtype)

    elif isinstance(dtype, T.ArrayType):           # C11: per element; scalar -> []
        conv = F.transform(_elements(v, raw), lambda e: typed_value(e, dtype.elementType, level=level + 1))
        val = F.coalesce(conv, F.array().cast(dtype))

    else:
        raise TypeError("MAP columns are not supported as ingest targets")

    return F.when(null, typed_null).otherwise(val)


def checked_value(v: Column, dtype: T.DataType, kind: Column) -> Column:
    """Values of the types whose conversion can fail (then null)."""
    txt = text_value(v, kind)
    if isinstance(dtype, T.DateType):
        days = F.try_variant_get(v, "$", "int")
        val = F.when(is_number_kind(kind), F.date_from_unix_date(days)).otherwise(F.when(txt.rlike(_ISO_DATE), txt.try_cast("date")))
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        parsed = F.date_trunc("MILLISECOND", F.upper(txt).try_cast("timestamp"))
        millis = F.timestamp_millis(F.try_variant_get(v, "$", "bigint"))
        val = F.when(is_number_kind(kind), millis).otherwise(F.when(txt.rlike(_ISO_INSTANT), parsed))
        if isinstance(dtype, T.TimestampNTZType):
            val = val.cast(T.TimestampNTZType())   # UTC wall time (session zone is UTC)
    else:       # DECIMAL and the rest: the text, cast
        val = txt.try_cast(dtype)
    return F.when(is_json_null(v), F.lit(None).cast(dtype)).otherwise(val)


def conversion_error(v: Column, dtype: T.DataType, kind: Column | None = None) -> Column | None:
    """Whether the conversion fails; ``None`` where it cannot.  (Apart from the value,
    so that neither is built again for each level around it.)"""
    if not can_fail(dtype):
        return None
    if isinstance(dtype, T.StructType):
        def failed(m):
            err = None
            for f in dtype.fields:
                err = _or(err, conversion_error(m.getField(f.name), f.dataType))
                if not f.nullable:
                    err = _or(err, typed_value(m.getField(f.name), f.dataType).isNull())
            return m.isNotNull() & err
        members = F.when(is_object(v), variant_fields(v, [f.name for f in dtype.fields]))
        return F.coalesce(bound(members, failed), F.lit(False))
    if isinstance(dtype, T.ArrayType):
        err = F.exists(_elements(v), lambda e: F.coalesce(conversion_error(e, dtype.elementType), F.lit(False)))
        return F.coalesce(err, F.lit(False))
    kind = json_kind(v) if kind is None else kind
    return bound(F.struct(v.alias("v"), kind.alias("k")), lambda x: ~is_json_null(x["v"]) & checked_value(x["v"], dtype, x["k"]).isNull())


# Spark's own typed JSON reader gives the reference's value for these types
# whenever it converts a record without any failure: booleans only from
# true/false, integers only from integer tokens in range, doubles from any
# number, text from scalars (numbers printed as the JVM prints the parsed
# node), structs and arrays recursively; JSON null and absent are null; with
# repeated keys the last one wins.  A failure anywhere in the record (a wrong
# kind, a repeated key whose value does not convert, ...) is reported in the
# corrupt-record column, and that record takes the exact VARIANT path.
# FLOAT (parsed straight to float, not via double), TINYINT/SMALLINT (Jackson
# accepts 0..255 for bytes), DATE, TIMESTAMP, DECIMAL and BINARY inside nested
# types always take the exact path.
_FAST_LEAVES = (T.BooleanType, T.IntegerType, T.LongType, T.DoubleType, T.StringType)
BAD = "_dl_corrupt_record"
JSON_READ_OPTS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false",
                  "allowNumericLeadingZeros": "false", "allowUnquotedControlChars": "false",
                  "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}


def is_fast(dtype: T.DataType, top: bool = True) -> bool:
    if isinstance(dtype, _FAST_LEAVES) or (top and isinstance(dtype, T.BinaryType)):
        return True
    if isinstance(dtype, T.StructType):
        return len(dtype.fields) > 0 and all(is_fast(f.dataType, False) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return is_fast(dtype.elementType, False)
    return False


def _has_text(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return True
    if isinstance(dtype, T.StructType):
        return any(_has_text(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _has_text(dtype.elementType)
    return False


def _text_ok(t: Column, dtype: T.DataType, level: int = 0) -> Column | None:
    """False where the typed reader put an object or array into a text field (it
    gives the JSON text, which is right only at the last level)."""
    if not _has_text(dtype):
        return None
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        if level >= NESTED_LEVELS:
            return F.lit(True)
        return F.coalesce(~(t.startswith("{") | t.startswith("[")), F.lit(True))
    if isinstance(dtype, T.StructType):
        out = None
        for f in dtype.fields:
            c = _text_ok(t.getField(f.name), f.dataType, level + 1)
            if c is not None:
                out = c if out is None else out & c
        return F.coalesce(out, F.lit(True))
    return F.coalesce(F.forall(t, lambda e: _text_ok(e, dtype.elementType, level + 1)), F.lit(True))


def loss_kind(v: Column, dtype: T.DataType, kind: Column) -> Column | None:
    """What a top-level conversion loses: ``wrong_kind`` (a default stands in for
    the value), ``overflow`` (an integer out of range becomes null) or
    ``truncation`` (an integer column cuts a fraction); null when nothing is
    lost, or for types whose failures are errors."""
    lost, given = F.lit(None).cast("string"), ~is_json_null(v)
    wrong = F.lit("wrong_kind")
    if isinstance(dtype, T.BooleanType):
        return F.when(given & (kind != "BOOLEAN"), wrong)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(given & ~is_number_kind(kind), wrong)
    if isinstance(dtype, _INTEGRALS):
        num = F.try_variant_get(v, "$", dtype.simpleString())
        exact = F.try_variant_get(v, "$", "double")
        return (F.when(~given, lost).when(~is_number_kind(kind), wrong).when(num.isNull(), F.lit("overflow"))
                .when(~is_integer_kind(kind) & (exact != F.signum(exact) * F.floor(F.abs(exact))), F.lit("truncation")))
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType, T.BinaryType)):
        return F.when(given & (kind.startswith("OBJECT") | kind.startswith("ARRAY")), wrong)
    if isinstance(dtype, T.StructType):
        return F.when(given & ~kind.startswith("OBJECT"), wrong)
    if isinstance(dtype, T.ArrayType):
        return F.when(given & ~kind.startswith("ARRAY"), wrong)
    return None


def overflow_json(text_names: list[str]) -> Column:
    """The members of a record that have no column, as one JSON object (null: none).
    Like elsewhere, an object without any value inside is no member."""
    without = lambda name: ~name.isin(*text_names) if text_names else F.lit(True)        # noqa: E731
    others = F.filter("fields", without)
    members = F.try_variant_get(body_variant(), "$", "map<string,variant>")
    rest = F.map_filter(members, lambda k, v: F.array_contains(others, k))
    return F.when(F.size(others) > 0, F.to_json(rest))


#: Types whose values are also read from the member's text as it stands.
_RAW = (T.StringType, T.BinaryType, T.ArrayType)


def _parse_type(dtype: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(dtype, T.BinaryType) else dtype


def coerce_rows(pending: DataFrame, schema: T.StructType, carry: tuple = (), fast: bool = True) -> DataFrame:
    """P5 + C*: one typed column per schema field, in schema order, by exact
    name; keys not in the schema are ignored.  Adds ``_dl_src`` (record
    coordinates), ``_dl_error`` (first column that failed, or null),
    ``_dl_maybe_lossy`` (the record took the second form below, or lost something
    in a column that always does) and ``_dl_loss`` (``(column, kind)`` of each
    lossy conversion, null if none).  Read the last one on its own: beside all
    the columns, a wide table's projection would outgrow compiled code.

    Columns of the types above are read by one typed ``from_json`` of the row
    text.  A record whose read reports any failure (or a text field holding an
    object/array) is parsed once more, into one VARIANT and one map of raw
    texts that all its columns share, and goes through ``coerce_value``.
    Columns of other types always use that second form.
    """
    order = [f.name for f in schema.fields]
    extra = []
    if OVERFLOW in order:
        schema = T.StructType([f for f in schema.fields if f.name != OVERFLOW])
        extra = [overflow_json([f.name for f in schema.fields]).alias(OVERFLOW)]
    fast_fields = [f for f in schema.fields if fast and is_fast(f.dataType)]
    slow_fields = [f for f in schema.fields if f not in fast_fields]
    staged_cols = [F.struct("topic", "partition", "offset", *carry).alias(SRC), "text", "envelope", *extra]
    env = F.col("envelope")
    if fast_fields:
        inner = ",".join(f"{quote(f.name)}: {ddl_type(_parse_type(f.dataType))}" for f in fast_fields)
        plain = F.from_json(F.col("text"), f"struct<{inner},{BAD}: string>", JSON_READ_OPTS)
        wrapped = F.from_json(F.col("text"), f"struct<payload: struct<{inner}>,{BAD}: string>", JSON_READ_OPTS)
        # Each record is read once, by the reader that fits its shape.
        staged_cols += [F.when(~env, plain).alias("_dl_p"), F.when(env, wrapped).alias("_dl_w")]
    staged = pending.select(*staged_cols)

    # one Column per field, used twice: building expressions costs the driver a call each
    read = {f.name: F.when(env, F.col("_dl_w").getField("payload").getField(f.name)).otherwise(F.col("_dl_p").getField(f.name))
            for f in fast_fields}

    clean = F.lit(True)
    if fast_fields:
        clean = F.when(env, F.col("_dl_w").getField(BAD)).otherwise(F.col("_dl_p").getField(BAD)).isNull()
        for f in fast_fields:
            text_ok = _text_ok(read[f.name], f.dataType)
            if text_ok is not None:
                clean = clean & text_ok
    staged = staged.withColumn("_dl_clean", clean)
    again = F.lit(True) if slow_fields else ~F.col("_dl_clean")
    raw_plain = F.from_json(F.col("text"), "map<string,string>", JSON_READ_OPTS)
    raw_wrapped = F.from_json(F.col("text"), "struct<payload: map<string,string>>", JSON_READ_OPTS).getField("payload")
    # The second parse, shared by all columns of a record that needs it.
    staged = staged.withColumn("_dl_v", F.when(again, variant_fields(body_variant(), [f.name for f in schema.fields])))
    # (the reader keeps repeated keys; rebuilding the map lets the last one win)
    raws = F.map_from_entries(F.map_entries(F.when(env, raw_wrapped).otherwise(raw_plain)))
    # (of columns that always go that way, only those of these types are read from it)
    texts = any(isinstance(f.dataType, _RAW) for f in slow_fields)
    staged = staged.withColumn("_dl_raw", F.when(again if texts else ~F.col("_dl_clean"), raws))
    # Each value's kind, derived once and read by its conversion and its loss test.
    kinds = [json_kind(F.col("_dl_v").getField(f.name)).alias(f"k{i}") for i, f in enumerate(schema.fields)]
    staged = staged.withColumn("_dl_kind", F.when(again, F.struct(*kinds)))
    cols, errs, losses, always = [], [], [], F.lit(False)
    for i, f in enumerate(schema.fields):
        exact, kind = F.col("_dl_v").getField(f.name), F.col("_dl_kind").getField(f"k{i}")
        raw = None
        if isinstance(f.dataType, _RAW):
            raw = F.try_element_at(F.col("_dl_raw"), F.lit(f.name))
        val, err = coerce_value(exact, f.dataType, raw, kind)
        if f in fast_fields:
            t = F.encode(read[f.name], "UTF-8") if isinstance(f.dataType, T.BinaryType) else read[f.name]
            val = F.when(F.col("_dl_clean"), t).otherwise(val)
        cols.append(val.alias(f.name))
        if not f.nullable:
            err = _or(err, val.isNull())
        if err is not None:
            errs.append(F.when(err, F.lit(f.name)))
        lost = loss_kind(exact, f.dataType, kind)
        if lost is not None:
            losses.append(F.struct(F.lit(f.name).alias("column"), lost.alias("kind")))
            if f in slow_fields:
                always = always | lost.isNotNull()
    error = F.coalesce(*errs) if errs else F.lit(None).cast("string")
    empty = F.lit(None).cast("array<struct<column:string,kind:string>>")
    loss = empty
    if losses:
        loss = F.when(again, F.filter(F.array(*losses), lambda x: x["kind"].isNotNull()))
    if extra:
        cols.insert(order.index(OVERFLOW), F.col(OVERFLOW))
    return staged.select(F.col(SRC), *cols, error.alias(ERR), (~F.col("_dl_clean") | always).alias(MAYBE), loss.alias(LOSS))
