"""The per-batch ingest plan: admit -> infer -> coerce, for every table of a
batch of records.  Batch jobs call it once; the streaming runner calls it
per micro-batch.

Data rows are never shuffled or persisted: admission and coercion are
projections, and the only exchange is the aggregation of name sets, which
carries a few rows per topic and partition after its map-side partial.  With
``stage`` the admitted records are written once, partitioned by table, and
every later step reads that copy.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.config import IngestConfig
from driftline.functions.route import topic_to_table
from driftline.operators.admit import EMITTED, ERROR, PENDING, SKIPPED, admit
from driftline.operators.coerce import ERR, LOSS, SRC, coerce_rows, row_too_long
from driftline.operators.infer import OVERFLOW, FieldChange, change_frame, infer_new_fields, merge_schema, quote
from driftline.session import SIDE_BY_SIDE, apply_session_conf

#: The reason of records that a table's write failed on.
WRITE_ERROR = "write_error"
#: Beside coerced rows of tables with CHAR or VARCHAR columns: a text is too long.
LONG = "_dl_too_long"
#: What a write says of such a record.
TOO_LONG = "EXCEED_LIMIT_LENGTH"


@dataclass
class BatchResult:
    admitted: DataFrame
    schemas: dict[str, T.StructType]
    changes: list[FieldChange]
    known: dict[str, T.StructType] = field(default_factory=dict)
    # (table, topic, reason, records) for every record of the batch; reason
    # None = pending (emitted or error after coercion), no_table = error,
    # others = skipped.
    census: list = field(default_factory=list)
    # {table: (records, convert errors)} once written by the sink
    written: dict = field(default_factory=dict)
    # {table: reason} of tables whose records were refused as a whole
    refused: dict = field(default_factory=dict)
    # {table: {(topic, partition, offset): error}} of records that the table's
    # write failed on (found by the sink)
    poisoned: dict = field(default_factory=dict)
    # {topic: (offset, partition)} of each topic's first non-empty record
    firsts: dict = field(default_factory=dict)

    @property
    def pending(self) -> DataFrame:
        return self.admitted.filter(F.col("disposition") == PENDING)

    @property
    def tables(self) -> list[str]:
        return sorted(self.schemas)

    def new_fields(self, table: str) -> list[T.StructField]:
        known = {f.name for f in (self.known.get(table) or T.StructType()).fields}
        return [f for f in self.schemas[table].fields if f.name not in known]

    def records_of(self, table: str) -> int:
        return sum(n for t, _, reason, n in self.census if t == table and reason is None)

    def coerced(self, table: str, carry: tuple = ()) -> DataFrame:
        """Typed rows of one table, with record coordinates, error and loss columns."""
        rows = coerce_rows(self.pending.filter(F.col("table") == F.lit(table)), self.schemas[table], carry)
        if (long := row_too_long(self.schemas[table])) is not None:
            rows = rows.withColumn(LONG, F.col(ERR).isNull() & long).withColumn(
                ERR, F.when(F.col(LONG), F.lit(WRITE_ERROR)).otherwise(F.col(ERR)))
        if self.poisoned.get(table):
            rows = rows.withColumn(ERR, F.when(self.is_poison(table), F.lit(WRITE_ERROR)).otherwise(F.col(ERR)))
        return rows

    def coerced_alike(self, tables: list[str]) -> DataFrame:
        """``coerced`` of several tables with one schema; ``_dl_src`` carries the table."""
        return coerce_rows(self.pending.filter(F.col("table").isin(*tables)), self.schemas[tables[0]], ("table",))

    def write_error(self, table: str) -> Column:
        """The error that the write of a coerced row of ``table`` ended with (null: none)."""
        why = F.lit(None).cast("string")
        for at, error in sorted(self.poisoned.get(table, {}).items()):
            here = F.lit(True)
            for name, value in zip(("topic", "partition", "offset"), at):
                here = here & F.col(f"{SRC}.{name}").eqNullSafe(F.lit(value))
            why = F.when(here, F.lit(error)).otherwise(why)
        return why

    def is_poison(self, table: str) -> Column:
        """Whether a coerced row of ``table`` is one that its write failed on."""
        return self.write_error(table).isNotNull()

    def rows(self, table: str) -> DataFrame:
        """The rows that land in ``table``: emitted records, schema order."""
        names = [f.name for f in self.schemas[table].fields]
        return self.coerced(table).filter(F.col(ERR).isNull()).select(*[F.col(quote(n)) for n in names])

    def losses(self, table: str) -> DataFrame:
        """``(table_name, column, kind, records)``: lossy conversions of one table's landed rows."""
        # (outer: the test for an empty list would be pushed below and work every loss out once more)
        c = self.coerced(table).filter(F.col(ERR).isNull()).select(F.explode_outer(LOSS).alias("l")).filter(F.col("l").isNotNull())
        return (c.groupBy("l.column", "l.kind").agg(F.count(F.lit(1)).alias("records"))
                .select(F.lit(table).alias("table_name"), "column", "kind", "records"))

    def rejected(self, with_errors_of: list[str] | None = None) -> DataFrame:
        """Skipped and failed records with their text; conversion errors of the
        given tables only (default all)."""
        return self.dispositions(True, with_errors_of, emitted=False)

    def dispositions(self, with_text: bool = False, tables: list[str] | None = None, emitted: bool = True) -> DataFrame:
        """One row per record: topic, partition, offset, table, disposition,
        reason, detail (failing column for ``convert_error``, kind of error for
        ``write_error``).  With
        ``with_text`` rejected records also carry ``text`` and ``first_byte``
        (null for emitted ones), so reject reports need no join.  Emitted records are
        left out unless ``emitted``."""
        extra = ["text", "first_byte"] if with_text else []
        skipped = (self.admitted.filter(F.col("disposition") != PENDING)
                   .select("topic", "partition", "offset", "table", "disposition", "reason",
                           F.lit(None).cast("string").alias("detail"), *extra))
        # Pending records of a table that got no columns (only `{}` seen), or that was refused.
        why, state = F.lit("no_columns"), F.lit(SKIPPED)
        for table, reason in self.refused.items():
            here = F.col("table") == F.lit(table)
            why, state = F.when(here, F.lit(reason)).otherwise(why), F.when(here, F.lit(ERROR)).otherwise(state)
        empty = (self.pending.filter(~F.col("table").isin(*self.tables) if self.tables else F.lit(True))
                 .select("topic", "partition", "offset", "table", state.alias("disposition"),
                         why.alias("reason"), F.lit(None).cast("string").alias("detail"), *extra))
        parts = [skipped, empty]
        for table in self.tables if tables is None else tables:
            c = self.coerced(table, tuple(extra))
            if not emitted:
                c = rejected_only(c)
            failed = F.col(ERR).isNotNull()
            why, detail = F.lit("convert_error"), F.col(ERR)
            unwritable = F.lit(None).cast("string")
            if LONG in c.columns:
                unwritable = F.when(F.col(LONG), F.lit(TOO_LONG))
            if self.poisoned.get(table):
                unwritable = F.coalesce(unwritable, self.write_error(table))
            if LONG in c.columns or self.poisoned.get(table):
                why = F.when(unwritable.isNotNull(), F.lit(WRITE_ERROR)).otherwise(why)
                detail = F.coalesce(unwritable, detail)
            c = c.select(
                F.col(f"{SRC}.topic").alias("topic"), F.col(f"{SRC}.partition").alias("partition"),
                F.col(f"{SRC}.offset").alias("offset"), F.lit(table).alias("table"),
                F.when(failed, F.lit(ERROR)).otherwise(F.lit(EMITTED)).alias("disposition"),
                F.when(failed, why).alias("reason"),
                F.when(failed, detail).alias("detail"),
                *[F.when(failed, F.col(f"{SRC}.{x}")).alias(x) for x in extra])
            parts.append(c)
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def change_frame(self) -> DataFrame:
        return change_frame(self.admitted.sparkSession, self.changes, self.schemas)


def rejected_only(rows: DataFrame) -> DataFrame:
    """The rows with an error.  Spark would move a plain filter below the coercion and
    write the whole of it out in there, without sharing the parsed record; one that also
    looks at a row number stays where it is."""
    numbered = rows.withColumn("_dl_row", F.monotonically_increasing_id())
    return numbered.filter(F.col(ERR).isNotNull() & (F.col("_dl_row") >= 0)).drop("_dl_row")


def spread(records: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a thin batch over ``min_partitions`` tasks before the
    per-record work (opt-in).  Round-robin, not by key, so a hot topic cannot
    concentrate.  For Kafka prefer the source's own ``minPartitions``, which
    splits offset ranges without a shuffle."""
    if min_partitions and records.rdd.getNumPartitions() < min_partitions:
        return records.repartition(min_partitions)
    return records


STAGED = ("topic string, partition int, offset long, text string, first_byte string, envelope boolean, "
          "fields array<string>, disposition string, reason string, table string")


def staged(admitted: DataFrame, path: str) -> DataFrame:
    """The admitted records written once, one folder per table, and read back.
    No shuffle: a task writes the tables it holds, a few of them side by side, so its
    records are not sorted either.  The schema is given, so a table named ``01`` stays text."""
    names = [x.split(" ")[0] for x in STAGED.split(", ")]
    apply_session_conf(admitted.sparkSession)
    admitted.select(*names).write.mode("overwrite").options(**SIDE_BY_SIDE).partitionBy("table").parquet(path)
    return admitted.sparkSession.read.schema(STAGED).parquet(path)


def ingest(records: DataFrame, known: dict[str, T.StructType] | None = None,
           cfg: IngestConfig | None = None,
           route: Callable[[Column], Column] = topic_to_table,
           known_loader: Callable[[list[str]], tuple[dict[str, T.StructType], dict[str, str]]] | None = None,
           stage: str | None = None, reserved: tuple[str, ...] = ()) -> BatchResult:
    """Admit, infer and prepare coercion for one batch of records.

    ``known`` holds the schemas of tables that already exist (their column
    order comes first); ``known_loader`` fetches them for the tables present
    in the batch instead, with the tables it refuses.
    """
    cfg = cfg or IngestConfig()
    admitted = admit(spread(records, cfg.min_partitions), route, tuple(dict.fromkeys((*reserved, OVERFLOW))))
    if stage is not None:
        admitted = staged(admitted, stage)
    if known_loader is None:
        def known_loader(tables):
            return {t: known[t] for t in tables if known and known.get(t) is not None}, {}
    changes, known, refused, census, full, firsts = infer_new_fields(admitted, known_loader, cfg.max_columns)
    present = sorted({table for table, _, reason, _ in census if reason is None} - set(refused))
    schemas: dict[str, T.StructType] = {}
    by_table: dict[str, list[FieldChange]] = {}
    for c in changes:
        by_table.setdefault(c.table, []).append(c)
    for table in present:
        merged = merge_schema(known.get(table), by_table.get(table, []), table in full)
        if len(merged.fields):
            schemas[table] = merged
    return BatchResult(admitted, schemas, changes, known, census, refused=refused, firsts=firsts)
