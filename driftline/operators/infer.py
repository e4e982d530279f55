"""Schema inference and evolution (I1-I10) by exemplar aggregation.

Rule (first seen wins): a field's type comes from the first record that
carries it, in the order (offset, topic, partition), and never changes
after.  New fields are appended after the known ones, in the order of their
first record and, inside it, of their position in the document.  Only
top-level names evolve; a new key inside a known struct is not added.

Distributed shape:

1. per record, the names of the row object that pin a type (``admit``);
2. records are grouped by (table, topic, partition, set of names) and the sets
   are reduced to one first record per (table, field); names the table already
   has are dropped by an anti-join on that small result;
3. the records of the remaining fields are looked up again and their types are
   derived on the executors;
4. the driver receives one type string per new column (it needs them for DDL).

Width: a table has at most ``max_columns`` inferred columns.  The first fields in
first-seen order get them, whichever batches they come in; the best so many of
each table are kept by a ranked window that Spark cuts per input partition, so
neither a task nor the driver holds all names of a wide topic.  The values of
other fields land in the column ``OVERFLOW``, one JSON object per record.

Depth: types hold at most ``NESTED_LEVELS`` objects and arrays inside each other;
what lies deeper lands as its JSON text.  Types are read off the value's text with
a stack, so no depth of nesting recurses.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.json import json_kind
from driftline.operators.admit import body_text, body_variant

_INTEGRAL = re.compile(r"-?[0-9]+")
#: Objects and arrays inside each other that a column's type shows; deeper values are JSON text.
NESTED_LEVELS = 16
#: The column for the values of fields that got no column of their own.
OVERFLOW = "_ingest_overflow"
#: Topics whose records are looked up by a span of offsets each.
MANY_TOPICS = 32


@dataclass(frozen=True)
class FieldChange:
    """One new top-level column (I10's schema-change row)."""
    table: str
    field: str
    dtype: T.DataType
    topic: str
    partition: int
    offset: int
    pos: int

    @property
    def order(self):
        return (self.offset, self.topic, self.partition, self.pos)


# --------------------------------------------------------------------------
# Exemplar -> type
# --------------------------------------------------------------------------

_TOKEN = re.compile(r'[ \t\r\n]*+([{}\[\],:]|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^ \t\r\n{}\[\],:"]++)', re.DOTALL)
_SCALARS = {"true": T.BooleanType(), "false": T.BooleanType(), "null": T.StringType()}


def type_of_text(raw: str, levels: int = NESTED_LEVELS) -> T.DataType | None:
    """Type of a JSON value from its text (I2-I5).  Objects become structs of
    optional fields in key order (I3), the last of repeated keys at its first
    position; arrays take the first element's type, empty ones array<string> (I4).
    Objects and arrays below ``levels`` others are text.  ``None`` = nothing to pin
    (an object without any value, which Parquet cannot store)."""
    result = None
    stack: list[list] = []      # [fields by name, or None for an array; name; type of the first element; elements]
    skipped = 0                                 # open objects and arrays of a value whose type is not wanted
    valued = text = False                       # it holds a value; the last sign was a string, which may be a name

    def give(t):
        nonlocal result
        if not stack:
            result = t
        elif (top := stack[-1])[0] is not None:
            top[0][top[1]] = t
            top[1] = None
        else:
            if not top[3]:
                top[2] = t
            top[3] += 1

    for m in _TOKEN.finditer(raw):
        tok = m[1]
        if skipped:
            if tok == ":":
                text = False                        # the string before was a name
                continue
            valued = valued or text or tok == "[" or tok[0] not in '{}],"'
            text = tok[0] == '"'
            if tok in "{[":
                skipped += 1
            elif tok in "}]":
                skipped -= 1
                if not skipped:
                    give(T.StringType() if valued else None)
        elif tok in "{[":
            top = stack[-1] if stack else None
            if len(stack) >= levels or (top is not None and top[0] is None and top[3]):
                skipped, valued, text = 1, tok == "[", False
            else:
                stack.append([{} if tok == "{" else None, None, None, 0])
        elif tok in "}]":
            fields, _, first, count = stack.pop()
            if fields is None:
                give(T.ArrayType(first if count and first is not None else T.StringType(), True))
            else:
                typed = [T.StructField(k, t, True) for k, t in fields.items() if t is not None]
                give(T.StructType(typed) if typed else None)
        elif tok in ",:":
            pass
        elif stack and stack[-1][0] is not None and stack[-1][1] is None:
            name = json.loads(tok)
            stack[-1][0].setdefault(name, None)         # keeps the first position
            stack[-1][1] = name
        elif tok[0] == '"':
            give(T.StringType())
        else:
            give(_SCALARS.get(tok) or (T.LongType() if _INTEGRAL.fullmatch(tok) else T.DoubleType()))
    return result


def value_type(value) -> T.DataType | None:
    """Type of a parsed JSON value."""
    return type_of_text(json.dumps(value))


def exemplar_type(kind: str, raw: str | None) -> T.DataType | None:
    """Type from one exemplar: the variant kind decides the scalar family,
    the raw token decides integral vs fractional (``1.0`` is a double) and
    the raw text of a container keeps its key order and first element."""
    if kind is None or kind == "VOID" or raw is None:
        return T.StringType()
    if kind == "BOOLEAN":
        return T.BooleanType()
    if kind == "STRING":
        return T.StringType()
    if kind.startswith("OBJECT") or kind.startswith("ARRAY"):
        return type_of_text(raw)
    return T.LongType() if _INTEGRAL.fullmatch(raw) else T.DoubleType()


# --------------------------------------------------------------------------
# Distributed part
# --------------------------------------------------------------------------

def occurrences(admitted: DataFrame) -> DataFrame:
    """One small frame answering two questions in a single pass:

    * ``field`` set: (table, field) -> the first record (offset, topic,
      partition) whose row object pins a type for the field;
    * ``field`` null: (table, topic, reason) -> number of records (reason
      null = pending), i.e. the tables present and the skip counts.

    Records are grouped by their whole set of names first (map-side partial):
    records of a topic share a few sets, so neither every name of every record
    nor a hot topic is shuffled."""
    sets = (admitted.groupBy("table", "topic", "partition", "reason", "fields")
            .agg(F.min("offset").alias("offset"), F.count(F.lit(1)).alias("records")))
    none = F.array(F.lit(None).cast("string"))          # a null entry stands for the record itself
    names = sets.withColumn("field", F.explode(F.concat(none, F.coalesce("fields", F.array().cast("array<string>")))))
    itself = F.col("field").isNull()
    out = (names.groupBy("table", "field", F.when(itself, F.col("topic")).alias("t_key"),
                         F.when(itself, F.col("reason")).alias("r_key"))
           .agg(F.min(F.struct("offset", "topic", "partition")).alias("w"), F.sum("records").alias("records")))
    return out.select("table", "field", F.col("w.topic").alias("topic"), F.col("w.partition").alias("partition"),
                      F.col("w.offset").alias("offset"), F.col("r_key").alias("reason"), "records")


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _types(batches):
    """Arrow batches of exemplars to their types (runs on the executors: only
    type strings reach the driver, whatever the size of a value)."""
    import pyarrow as pa
    for b in batches:
        col = {n: b.column(n) for n in b.schema.names}
        types = []
        for name, kind, raw in zip(*(col[n].to_pylist() for n in ("field", "kind", "raw"))):
            t = exemplar_type(kind, raw)
            types.append(None if t is None else T.StructType([T.StructField(name, t, True)]).json())
        yield pa.RecordBatch.from_arrays(
            [*(col[n] for n in ("table", "field", "topic", "partition", "offset", "pos")), pa.array(types, pa.string())],
            names=["table", "field", "topic", "partition", "offset", "pos", "type"])


def read_exemplars(admitted: DataFrame, winners: DataFrame) -> DataFrame:
    """``winners (table, field, topic, partition, offset)`` with the type and the
    document position of each one's value."""
    small = winners.select(F.col("table").alias("w_table"), "field", F.col("topic").alias("w_topic"),
                           F.col("partition").alias("w_partition"), F.col("offset").alias("w_offset"))
    rows = admitted.filter(F.col("reason").isNull()).select("table", "topic", "partition", "offset", "text", "envelope")
    joined = rows.join(small, (rows["topic"] == small["w_topic"]) & (rows["partition"] == small["w_partition"])
                       & (rows["offset"] == small["w_offset"]) & (rows["table"] == small["w_table"]))
    text = body_text()
    raw_map = F.map_from_entries(F.map_entries(F.from_json(text, "map<string,string>")))
    val = F.element_at(F.try_variant_get(body_variant(), "$", "map<string,variant>"), F.col("field"))
    out = joined.select(
        "table", "field", "topic", "partition", "offset",
        (F.array_position(F.json_object_keys(text), F.col("field")) - 1).cast("int").alias("pos"),
        json_kind(val).alias("kind"), F.element_at(raw_map, F.col("field")).alias("raw"))
    return out.mapInArrow(_types, "table string, field string, topic string, partition int, offset long, pos int, type string")


def near(winners: DataFrame) -> Column:
    """A test of the offset alone that all records of ``winners`` pass: per topic, between
    its first and last (for many topics: of all of them).  It is made before a record is
    parsed, and files of other offsets are not read."""
    ends = [F.min("offset").alias("low"), F.max("offset").alias("high")]
    spans = winners.groupBy("topic").agg(*ends).limit(MANY_TOPICS + 1).collect()
    if len(spans) > MANY_TOPICS:
        spans = winners.agg(F.lit(None).alias("topic"), *ends).collect()
    out = F.lit(False)
    for r in spans:
        here = F.col("offset").between(r["low"], r["high"])
        out = out | (here if r["topic"] is None else here & (F.col("topic") == r["topic"]))
    return out


def first_of_tables(rows: DataFrame, order: list[str], n: int, ties: bool) -> DataFrame:
    """The first ``n`` rows of each table along ``order`` (``ties``: and those equal to
    the last).  Spark cuts each input partition to so many before the shuffle."""
    at = Window.partitionBy("table").orderBy(*order)
    return rows.withColumn("_n", (F.rank() if ties else F.row_number()).over(at)).filter(F.col("_n") <= n).drop("_n")


def infer_new_fields(admitted: DataFrame, known_loader, max_columns: int):
    """I1-I6, I10 for one batch.

    ``known_loader(tables)`` gives ``(schemas, refused)`` of the tables present:
    their existing columns, and tables that cannot be written, with a reason.
    Returns ``(changes, known, refused, census, full, firsts)``: the new columns of
    every table that is not refused in append order, (table, topic, reason, records)
    rows, the tables with fields beyond ``max_columns``, and the first (offset,
    partition) of each topic's non-empty records."""
    spark = admitted.sparkSession
    found = occurrences(admitted).persist()          # one row per field and topic, not per record
    try:
        rows = found.filter(F.col("field").isNull()).collect()          # one per topic and reason
        census = [(r["table"], r["topic"], r["reason"], int(r["records"])) for r in rows]
        firsts: dict = {}
        for r in rows:
            if r["reason"] != "empty" and r["offset"] is not None:
                at = (int(r["offset"]), int(r["partition"]))
                firsts[r["topic"]] = min(at, firsts.get(r["topic"], at))
        known, refused = known_loader(sorted({t for t, _, reason, _ in census if reason is None}))
        names = [(t, f.name) for t, s in known.items() for f in s.fields if f.name != OVERFLOW]
        new = found.filter(F.col("field").isNotNull()).select("table", "field", "topic", "partition", "offset")
        if names:
            new = new.join(spark.createDataFrame(names, "table string, field string"), ["table", "field"], "left_anti")
        counts = {r["table"]: r["n"] for r in new.groupBy("table").agg(F.count(F.lit(1)).alias("n")).collect()
                  if r["table"] not in refused}                                         # one row per table
        have = {t: sum(f.name != OVERFLOW for f in s.fields) for t, s in known.items()}
        free = {t: max(0, max_columns - have.get(t, 0)) for t in counts}
        full = {t for t, n in counts.items() if n > free[t]}
        wanted = sorted(t for t in counts if free[t])
        rows = []
        if wanted:
            # At most max_columns fields of a table, and those of one record beyond, are looked up ...
            order = ["offset", "topic", "partition"]
            candidates = first_of_tables(new.filter(F.col("table").isin(wanted)), order, max_columns, True)
            typed = read_exemplars(admitted.filter(near(candidates)), candidates).filter(F.col("type").isNotNull())
            # (a record may be read twice, by a source that repeats an offset: one row per field)
            typed = typed.groupBy("table", "field").agg(F.min(F.struct(*order, "pos", "type")).alias("w")).select("table", "field", "w.*")
            # ... and at most max_columns of them reach the driver.
            rows = first_of_tables(typed, [*order, "pos"], max_columns, False).collect()
        changes = [FieldChange(r["table"], r["field"], T.StructType.fromJson(json.loads(r["type"])).fields[0].dataType,
                               r["topic"], int(r["partition"]), int(r["offset"]), int(r["pos"])) for r in rows]
    finally:
        found.unpersist()
    taken: dict[str, list[FieldChange]] = {}
    for c in sorted(changes, key=lambda c: (c.table, c.order)):
        if len(mine := taken.setdefault(c.table, [])) < free[c.table]:
            mine.append(c)
    return [c for cs in taken.values() for c in cs], known, refused, census, full, firsts


def merge_schema(existing: T.StructType | None, changes: list[FieldChange], full: bool = False) -> T.StructType:
    """The existing columns as they are, then the new ones by first record, and
    the overflow column of a table that is ``full``."""
    fields = list(existing.fields) if existing is not None else []
    fields += [T.StructField(c.field, c.dtype, True) for c in sorted(changes, key=lambda c: c.order)]
    if full and OVERFLOW not in {f.name for f in fields}:
        fields.append(T.StructField(OVERFLOW, T.StringType(), True))
    return T.StructType(fields)


def change_frame(spark: SparkSession, changes: list[FieldChange], schemas: dict[str, T.StructType]) -> DataFrame:
    """I10 as a frame: table, position, field, type, and the first record."""
    rows = []
    for c in changes:
        pos = [f.name for f in schemas[c.table].fields].index(c.field)
        rows.append((c.table, pos, c.field, c.dtype.simpleString(), c.topic, c.partition, c.offset))
    return spark.createDataFrame(
        rows, "table string, position int, field string, type string, first_topic string, "
              "first_partition int, first_offset bigint")
