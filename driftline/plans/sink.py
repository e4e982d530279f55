"""Multi-table sink.

One table per target name in one namespace.  A table is Parquet with a
hidden partition column ``_ingest_batch`` = ``<query id>-<batch id>``;
writes go through ``insertInto`` with dynamic partition overwrite, so a
replayed micro-batch replaces exactly its own rows (idempotent append).
DDL is additive and re-runnable: CREATE TABLE IF NOT EXISTS, then ADD
COLUMNS for fields the table lacks, before the rows that need them.

Tables of a batch that have the same columns share one write: one job splits the
staged records by table, and each written folder is registered as that table's
partition of the batch, which only touches the catalog.

Texts that are too long for a CHAR or VARCHAR column are told by their lengths, as
the rows are written: such records become ``error`` / ``write_error``, however many
there are, and the rest lands in the same batch.  A write that fails on some record
for any other reason is narrowed down to it: ranges of offsets are tried in a scratch
table, halves of those that fail, until single records are left.

The catalog is whatever the session is configured with (a Hive metastore on
a cluster; the in-memory catalog in local tests).  On a cluster with the
Iceberg runtime, ``IcebergTableStore`` does the same through the catalog's
own schema evolution and atomic appends.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.config import IngestConfig
from driftline.operators.admit import NO_TABLE
from driftline.operators.coerce import ERR, MAYBE, SRC, ddl_type
from driftline.operators.infer import quote
from driftline.operators.ledger import merged, offset_ranges, outside
from driftline.operators.observe import first_by_order, reject_frame, sample_rows
from driftline.plans.ingest import LONG, TOO_LONG, BatchResult, ingest
from driftline.session import SIDE_BY_SIDE, apply_session_conf, shared_path

BATCH_COL = "_ingest_batch"
#: Folders of a shared write: the MD5 of the table's name.
FOLDER_COL = "_folder"


class UnsupportedTable(TypeError):
    """An existing table that cannot take ingested rows."""


class TableStore:
    """Parquet tables in a catalog namespace."""

    def __init__(self, spark: SparkSession, namespace: str, location: str | None = None, catalog: str | None = None):
        self.spark = apply_session_conf(spark)
        self.namespace = namespace
        self.location = location
        self.catalog = catalog if catalog and catalog != "spark_catalog" else None
        # Schemas this writer has seen or changed (one catalog read per table
        # and process, like the reference's per-task cache).
        self._cache: dict[str, T.StructType] = {}
        self._samples: dict[str, tuple[int, int]] | None = None

    # -- catalog -----------------------------------------------------------
    @property
    def full_namespace(self) -> str:
        return ".".join(quote(x) for x in (self.catalog, self.namespace) if x)

    def ensure_namespace(self) -> None:
        """K8: create the namespace if needed."""
        apply_session_conf(self.spark)      # DDL compares column names as the engine does
        loc = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.full_namespace}{loc}")

    def name(self, table: str) -> str:
        return f"{self.full_namespace}.{quote(table)}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def schema(self, table: str, fresh: bool = False) -> T.StructType | None:
        """The table's columns in table order, without the hidden column.
        I9: a catalog error propagates and fails the batch (no re-inference
        from scratch, which could reorder or retype columns)."""
        if not fresh and table in self._cache:
            return self._cache[table]
        if not self.exists(table):
            return None
        fields = self.spark.table(self.name(table)).schema.fields
        self._check(table, fields)
        self._cache[table] = T.StructType([f for f in fields if f.name != BATCH_COL])
        return self._cache[table]

    def _check(self, table: str, fields: list[T.StructField]) -> None:
        for f in fields:
            if isinstance(f.dataType, T.MapType):
                raise UnsupportedTable(f"{table}.{f.name}: MAP columns cannot be ingest targets")
        if BATCH_COL not in {f.name for f in fields}:
            raise UnsupportedTable(f"{table}: not a table of this job (no {BATCH_COL} column)")

    def schemas(self, tables: list[str]) -> tuple[dict[str, T.StructType], dict[str, str]]:
        """Schemas of those ``tables`` that exist, and the ones that cannot take
        rows, with a reason.  Other tables of the namespace are not looked at."""
        found, refused = {}, {}
        for t in tables:
            try:
                if (s := self.schema(t)) is not None:
                    found[t] = s
            except UnsupportedTable:
                refused[t] = "unsupported_table"
        return found, refused

    def create(self, table: str, schema: T.StructType) -> None:
        """K2: create an unpartitioned-by-data table (only the hidden batch column)."""
        cols = ", ".join(f"{quote(f.name)} {ddl_type(f.dataType)}" for f in schema.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({cols}, {BATCH_COL} STRING) "
            f"USING parquet PARTITIONED BY ({BATCH_COL})")
        self.schema(table, fresh=True)

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        self._cache.pop(table, None)

    def scratch_like(self, table: str) -> str:
        """An empty table with the columns of ``table`` (checked types included)."""
        name = f"_try_{uuid.uuid4().hex[:12]}"
        self.spark.sql(f"CREATE TABLE {self.name(name)} LIKE {self.name(table)}")
        return name

    def add_columns(self, table: str, fields: list[T.StructField]) -> None:
        """K3: widen a live table; columns already there are left alone."""
        have = {f.name for f in (self.schema(table, fresh=True) or T.StructType()).fields}
        todo = [f for f in fields if f.name not in have]
        if todo:
            cols = ", ".join(f"{quote(f.name)} {ddl_type(f.dataType)}" for f in todo)
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({cols})")
            self.schema(table, fresh=True)

    def append(self, table: str, rows: DataFrame, batch_tag: str, parallelism: int | None = None) -> None:
        """K4/K7: append one batch's rows; a replay of the same tag replaces them.
        K6: no data partitioning and no shuffle before the write."""
        schema = self.schema(table)
        out = rows.select(*[F.col(quote(f.name)).cast(f.dataType) for f in schema.fields],
                          F.lit(batch_tag).alias(BATCH_COL))
        if parallelism:
            out = out.coalesce(parallelism)        # narrow: merges partitions, no shuffle (K5/K6)
        self._insert(out, table)

    def can_share(self, table: str) -> bool:
        """Whether rows may be written as files beside the table: not where the
        catalog checks values on insert (CHAR and VARCHAR lengths)."""
        return all("__CHAR_VARCHAR_TYPE_STRING" not in f.metadata for f in (self.schema(table) or T.StructType()).fields)

    def append_shared(self, tables: list[str], rows: DataFrame, table_of: Column, batch_tag: str,
                      parallelism: int | None = None) -> None:
        """K1/K4/K7: one job for ``rows`` of several tables with the same columns
        (``table_of`` names each row's).  Every table gets a folder named after it and
        the batch, so a replay writes the same folders again; they are registered as
        partitions.  K6: a task writes the tables it holds, without a shuffle."""
        schema = self.schema(tables[0])
        root = f"{self.root()}/_ingest_batches/{batch_tag}"
        out = rows.select(*[F.col(quote(f.name)).cast(f.dataType) for f in schema.fields], F.md5(table_of.cast("binary")).alias(FOLDER_COL))
        if parallelism:
            out = out.coalesce(parallelism)
        session = apply_session_conf(out.sparkSession)
        if session.conf.get("spark.sql.sources.partitionOverwriteMode").lower() != "dynamic":
            raise RuntimeError("refusing to write: partitionOverwriteMode must be dynamic")
        out.write.mode("overwrite").options(**SIDE_BY_SIDE).partitionBy(FOLDER_COL).parquet(root)

        def register(table):
            folder = f"{root}/{FOLDER_COL}={hashlib.md5(table.encode()).hexdigest()}"
            part = f"PARTITION ({BATCH_COL} = '{batch_tag}')"
            try:
                self.spark.sql(f"ALTER TABLE {self.name(table)} ADD {part} LOCATION '{folder}'")
            except AnalysisException:   # a replay: the partition may be where an earlier try left it
                self.spark.sql(f"ALTER TABLE {self.name(table)} {part} SET LOCATION '{folder}'")

        with ThreadPoolExecutor(min(8, len(tables))) as pool:
            list(pool.map(register, tables))

    def root(self) -> str:
        """Where the namespace's files lie."""
        return (self.location or self.spark.catalog.getDatabase(self.full_namespace).locationUri).rstrip("/")

    def _insert(self, out: DataFrame, table: str) -> None:
        """Replace the partitions that ``out`` holds, and no others.  The session
        that runs the write decides this (a streaming batch has its own), so the
        setting is made and checked there: without it an insert would empty the
        whole table."""
        session = apply_session_conf(out.sparkSession)
        mode = session.conf.get("spark.sql.sources.partitionOverwriteMode").lower()
        if mode != "dynamic":
            raise RuntimeError(f"refusing to write {table}: partitionOverwriteMode is {mode}, it must be dynamic")
        out.write.insertInto(self.name(table), overwrite=True)

    def append_log(self, table: str, ddl: str, rows: DataFrame, batch_tag: str) -> None:
        """Append one batch's rows to a table of the job's own (statistics,
        rejects, schema changes, losses); a replay replaces them."""
        if not self.exists(table):
            cols = ", ".join(f"{quote(f.name)} {ddl_type(f.dataType)}" for f in T._parse_datatype_string(ddl).fields)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({cols}, {BATCH_COL} STRING) "
                           f"USING parquet PARTITIONED BY ({BATCH_COL})")
        self._insert(rows.withColumn(BATCH_COL, F.lit(batch_tag)), table)

    def read_batch(self, table: str, batch_tag: str, batch_id: int) -> DataFrame:
        """One batch's rows of a log table."""
        return self.spark.table(self.name(table)).filter(F.col(BATCH_COL) == batch_tag).drop(BATCH_COL)

    # -- offset ledger (S3/S4) -------------------------------------------------
    def ledger(self) -> DataFrame:
        """``topic, partition, first, last``: the offsets of all committed batches."""
        if not self.exists(OFFSETS_TABLE):
            return self.spark.createDataFrame([], OFFSETS_DDL.split(", ", 1)[1])
        return merged(self.read(OFFSETS_TABLE))

    def uncommitted(self, records: DataFrame) -> DataFrame:
        """``records`` that no committed batch held, each once."""
        return outside(records, self.read(OFFSETS_TABLE)) if self.exists(OFFSETS_TABLE) else records.dropDuplicates(["topic", "partition", "offset"])

    def begin(self, batch_tag: str, batch_id: int) -> None:
        """Note that a batch is about to be written; it counts once its offsets are in the ledger."""
        row = self.spark.createDataFrame([(int(batch_id), batch_tag)], BEGUN_DDL)
        self.append_log(BEGUN_TABLE, BEGUN_DDL, row, batch_tag)

    def drop_unfinished(self) -> list[str]:
        """Remove what begun batches left that never came to be committed (the run
        died in between); a new run reads their records again."""
        if not self.exists(BEGUN_TABLE):
            return []
        begun = self.spark.table(self.name(BEGUN_TABLE)).select("tag").distinct()
        if self.exists(OFFSETS_TABLE):
            done = self.spark.table(self.name(OFFSETS_TABLE)).select(F.col(BATCH_COL).alias("tag")).distinct()
            begun = begun.join(done, "tag", "left_anti")
        tags = [r["tag"] for r in begun.collect()]              # of batches that were cut off: few
        for table in self.table_names() if tags else []:
            for tag in tags:
                self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION ({BATCH_COL} = '{tag}')")
        return tags

    # -- state of the job, from its log tables -------------------------------
    def totals(self) -> DataFrame:
        """O1 over the job's life: ``topic, received, emitted, skipped, errors``.  A
        replayed batch replaces its own rows, so restarts count nothing twice."""
        sums = [F.sum(c).alias(c) for c in ("received", "emitted", "skipped", "errors")]
        return self.read(TOPICS_TABLE).groupBy("topic").agg(*sums)

    def samples(self) -> DataFrame:
        """O2 over the job's life: each topic's first record by (offset, partition)."""
        rows = self.read(SAMPLES_TABLE).drop("batch_id")
        return first_by_order(rows, ["topic"], ["offset", "partition"]).dropDuplicates(["topic"])

    def first_samples(self) -> dict[str, tuple[int, int]]:
        """``{topic: (offset, partition)}`` of the samples taken so far (read once, then kept up)."""
        if self._samples is None:
            rows = self.samples().collect() if self.exists(SAMPLES_TABLE) else []       # one row per topic
            self._samples = {r["topic"]: (r["offset"], r["partition"]) for r in rows}
        return self._samples

    # -- read-back -----------------------------------------------------------
    def read(self, table: str) -> DataFrame:
        """A landed table without the hidden column."""
        return self.spark.table(self.name(table)).drop(BATCH_COL)

    def read_limit(self, table: str, n: int = 10) -> DataFrame:
        """A few rows for inspection."""
        return self.read(table).limit(n)

    def table_names(self) -> list[str]:
        """Persistent tables of the namespace (the catalog also lists the
        session's temporary views; they are not ours)."""
        return sorted(t.name for t in self.spark.catalog.listTables(self.full_namespace) if not t.isTemporary)

    def list_tables(self) -> DataFrame:
        """The tables of the namespace."""
        rows = [(self.namespace, t) for t in self.table_names()]
        return self.spark.createDataFrame(rows, "namespace string, table string")


    def list_namespaces(self) -> DataFrame:
        """The namespaces of the catalog."""
        within = f" IN {quote(self.catalog)}" if self.catalog else ""
        return self.spark.sql(f"SHOW NAMESPACES{within}")


class IcebergTableStore(TableStore):
    """Same contract on an Iceberg catalog (needs the Iceberg runtime; not
    available in this container).  K9: writes go to the table's main branch.
    Iceberg commits are atomic per table and evolve schemas natively;
    idempotence comes from the snapshot property carrying the batch tag."""

    def create(self, table: str, schema: T.StructType) -> None:
        cols = ", ".join(f"{quote(f.name)} {ddl_type(f.dataType)}" for f in schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({cols}) USING iceberg")

    def schema(self, table: str, fresh: bool = False) -> T.StructType | None:
        if not fresh and table in self._cache:
            return self._cache[table]
        if not self.exists(table):
            return None
        fields = self.spark.table(self.name(table)).schema.fields
        self._check(table, fields)
        self._cache[table] = T.StructType(fields)
        return self._cache[table]

    def _check(self, table: str, fields: list[T.StructField]) -> None:
        if any(isinstance(f.dataType, T.MapType) for f in fields):
            raise UnsupportedTable(f"{table}: MAP columns cannot be ingest targets")

    def append(self, table: str, rows: DataFrame, batch_tag: str, parallelism: int | None = None) -> None:
        snaps = self.spark.sql(
            f"SELECT 1 FROM {self.name(table)}.snapshots WHERE summary['driftline.batch'] = '{batch_tag}'")
        if snaps.limit(1).count():
            return
        schema = self.schema(table)
        out = rows.select(*[F.col(quote(f.name)).cast(f.dataType) for f in schema.fields])
        if parallelism:
            out = out.coalesce(parallelism)
        out.writeTo(self.name(table)).option("snapshot-property.driftline.batch", batch_tag).append()

    def read_batch(self, table: str, batch_tag: str, batch_id: int) -> DataFrame:
        return self.read(table).filter(F.col("batch_id") == batch_id)

    def begin(self, batch_tag: str, batch_id: int) -> None:
        raise NotImplementedError("the offset ledger needs the Parquet store's batch partitions")

    def can_share(self, table: str) -> bool:
        return False                    # files become part of a table by a commit of its own

    def scratch_like(self, table: str) -> str:
        name = f"_try_{uuid.uuid4().hex[:12]}"
        self.create(name, self.schema(table))
        return name

    def append_log(self, table: str, ddl: str, rows: DataFrame, batch_tag: str) -> None:
        """Like any other append: atomic, and skipped where the batch is in already."""
        if not self.exists(table):
            self.create(table, T._parse_datatype_string(ddl))
        self.append(table, rows, batch_tag)

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))


class TableErrors(RuntimeError):
    """Some tables of a batch could not be written; the others were."""

    def __init__(self, errors: dict[str, Exception]):
        super().__init__("; ".join(f"{t}: {type(e).__name__}: {str(e)[:300]}" for t, e in sorted(errors.items())))
        self.errors = errors


@dataclass
class Written:
    records: int
    errors: int
    maybe_lossy: int        # records whose losses, if any, are worth a look


def ready(store: TableStore, result: BatchResult, table: str) -> None:
    """K2/K3: the table with all columns of the batch."""
    if not store.exists(table):
        store.create(table, result.schemas[table])
    elif result.new_fields(table):
        store.add_columns(table, result.new_fields(table))


def write_table(store: TableStore, result: BatchResult, table: str, batch_tag: str, cfg: IngestConfig) -> Written:
    """One table's rows, counted as they are written (no extra pass)."""
    obs = Observation(f"driftline-{uuid.uuid4().hex[:12]}")
    landed = F.col(ERR).isNull()
    coerced = result.coerced(table)
    long = F.count(F.when(F.col(LONG), 1)) if LONG in coerced.columns else F.count(F.lit(None))
    coerced = coerced.observe(
        obs, F.count(F.lit(1)).alias("records"), F.count(F.col(ERR)).alias("errors"),
        F.count(F.when(landed & F.col(MAYBE), 1)).alias("maybe_lossy"), long.alias("long"))
    names = [f.name for f in result.schemas[table].fields]
    store.append(table, coerced.filter(landed).select(*[F.col(quote(n)) for n in names]), batch_tag, cfg.write_parallelism)
    m = obs.get
    if cfg.max_poison_tries < m.get("long", 0) == m.get("records", 0):      # not some records: the table does not fit
        raise TooLong(f"[{TOO_LONG}] all {m['records']} records have texts too long for their columns")
    return Written(int(m.get("records", 0)), int(m.get("errors", 0)), int(m.get("maybe_lossy", 0)))


def write_alike(store: TableStore, result: BatchResult, tables: list[str], batch_tag: str, cfg: IngestConfig) -> dict[str, Written]:
    """The rows of tables with the same columns in one job."""
    obs = Observation(f"driftline-{uuid.uuid4().hex[:12]}")
    landed, odd = F.col(ERR).isNull(), F.col(ERR).isNotNull() | F.col(MAYBE)
    coerced = result.coerced_alike(tables)
    watched = coerced.observe(obs, F.count(F.when(odd, 1)).alias("odd"))
    names = [f.name for f in result.schemas[tables[0]].fields]
    store.append_shared(tables, watched.filter(landed).select(*[F.col(quote(n)) for n in names], F.col(f"{SRC}.table").alias("_dl_table")),
                        F.col("_dl_table"), batch_tag, cfg.write_parallelism)
    pending = {}
    for t, _, reason, n in result.census:
        if reason is None:
            pending[t] = pending.get(t, 0) + n
    out = {t: Written(pending[t], 0, 0) for t in tables}
    if obs.get.get("odd", 0):           # which table they belong to: only asked when there are any
        per = coerced.filter(odd).groupBy(F.col(f"{SRC}.table").alias("t")).agg(
            F.count(F.col(ERR)).alias("errors"), F.count(F.when(landed & F.col(MAYBE), 1)).alias("maybe_lossy"))
        for r in per.collect():
            out[r["t"]] = Written(pending[r["t"]], int(r["errors"]), int(r["maybe_lossy"]))
    return out


class TooLong(RuntimeError):
    """No record of a batch fits the table's CHAR and VARCHAR columns."""


class TooManyTries(RuntimeError):
    """The failure is not that of a few records."""


def find_poison(works: Callable[[Column], str | None], boxes: list[tuple], max_tries: int) -> dict[tuple, str]:
    """The records that a write fails on, by bisection.

    ``boxes`` are (topic, partition, first offset, last offset) of all records;
    ``works(condition)`` tries those that meet the condition and gives the error, or
    None.  A half whose other half works is known to fail, so it is not tried as a
    whole.  Raises ``TooManyTries`` beyond ``max_tries``."""
    tries = 0

    def attempt(part):
        nonlocal tries
        tries += 1
        if tries > max_tries:
            raise TooManyTries(f"more than {max_tries} tries to find the records that cannot be written")
        some = F.lit(False)
        for topic, partition, low, high in part:
            some = some | (F.col(f"{SRC}.topic").eqNullSafe(F.lit(topic)) & F.col(f"{SRC}.partition").eqNullSafe(F.lit(partition))
                           & F.col(f"{SRC}.offset").between(low, high))
        return works(some)

    bad, todo = {}, [(boxes, None)]                 # parts that fail, with the error if it is known
    while todo:
        part, error = todo.pop()
        if len(part) == 1 and part[0][2] == part[0][3]:
            topic, partition, offset, _ = part[0]
            error = error or attempt(part)
            if error is not None:
                bad[(topic, partition, offset)] = error
            continue
        if len(part) > 1:
            halves = [part[:len(part) // 2], part[len(part) // 2:]]
        else:
            topic, partition, low, high = part[0]
            middle = low + (high - low) // 2
            halves = [[(topic, partition, low, middle)], [(topic, partition, middle + 1, high)]]
        first = attempt(halves[0])
        if first is None:
            todo.append((halves[1], error))
        else:
            todo.append((halves[0], first))
            second = attempt(halves[1])
            if second is not None:
                todo.append((halves[1], second))
    return bad


def isolate_poison(store: TableStore, result: BatchResult, table: str, batch_tag: str, cfg: IngestConfig, cause: Exception) -> None:
    """Note the records of ``table`` that its write fails on in ``result.poisoned``."""
    rows = result.pending.filter(F.col("table") == F.lit(table))
    boxes = [(r["topic"], r["partition"], r["low"], r["high"]) for r in rows.groupBy("topic", "partition").agg(
        F.min("offset").alias("low"), F.max("offset").alias("high")).orderBy("topic", "partition").collect()]
    coerced, names = result.coerced(table), [f.name for f in result.schemas[table].fields]
    scratch = store.scratch_like(table)

    def works(some):
        try:
            store.append(scratch, coerced.filter(F.col(ERR).isNull() & some).select(*[F.col(quote(n)) for n in names]),
                         uuid.uuid4().hex[:12])
        except AnalysisException:
            raise
        except Exception as exc:  # noqa: BLE001 - what the rejects tell of the record
            return error_name(exc)
        return None

    try:
        bad = find_poison(works, boxes, cfg.max_poison_tries)
    finally:
        store.drop(scratch)
    if not bad:
        raise cause
    result.poisoned[table] = bad


def error_name(exc: Exception) -> str:
    """The error class of a failed job, or the kind of exception."""
    text = str(exc)
    start = text.find("[")
    name = text[start + 1:text.find("]", start)] if start >= 0 else ""
    return name if name and name.replace("_", "").replace(".", "").isalnum() else type(exc).__name__


def write_result(store: TableStore, result: BatchResult, batch_tag: str,
                 cfg: IngestConfig) -> tuple[dict[str, Written], dict[str, Exception]]:
    """K1: for every table of the batch its DDL, then the writes: one job for all
    tables with the same columns, a few jobs at a time.

    A shared write that fails is done again table by table, and a table's write that
    fails without its records (``find_poison``).  Returns the counts observed while
    writing, and the tables that failed: one table's failure does not stop the others."""
    done, failed = {}, {}

    def prepare(table):
        try:
            ready(store, result, table)
            return table, store.can_share(table)
        except Exception as exc:  # noqa: BLE001 - reported together once every table had its turn
            return table, exc

    def alone(table):
        try:
            try:
                return table, write_table(store, result, table, batch_tag, cfg)
            except (AnalysisException, TooLong):
                raise
            except Exception as exc:  # noqa: BLE001 - a record may be to blame
                isolate_poison(store, result, table, batch_tag, cfg, exc)
                return table, write_table(store, result, table, batch_tag, cfg)
        except Exception as exc:  # noqa: BLE001
            return table, exc

    def together(tables):
        if len(tables) > 1:
            try:
                return list(write_alike(store, result, tables, batch_tag, cfg).items())
            except Exception:  # noqa: BLE001 - table by table shows which one
                pass
        return [alone(t) for t in tables]

    with ThreadPoolExecutor(max(1, min(cfg.table_write_threads, len(result.tables)))) as pool:
        groups: dict[str, list[str]] = {}
        for table, shared in pool.map(prepare, result.tables):
            if isinstance(shared, Exception):
                failed[table] = shared
            else:       # the live columns: those of the table, in its order
                groups.setdefault(store.schema(table).json() if shared and store.schema(table) == result.schemas[table] else table,
                                  []).append(table)
        for pairs in pool.map(together, groups.values()):
            for table, w in pairs:
                (done if isinstance(w, Written) else failed)[table] = w
    return done, failed


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staging folder through the Hadoop file system of its URI."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def batch_counts(result: BatchResult, written: dict[str, Written]) -> dict[str, int]:
    """O1/O5 for one batch from the inference census and the write
    observations: received = emitted + skipped + errors."""
    received = sum(n for _, _, _, n in result.census)
    refused = sum(n for t, _, reason, n in result.census
                  if reason == NO_TABLE or (reason is None and t in result.refused))
    skipped = sum(n for t, _, reason, n in result.census
                  if reason not in (None, NO_TABLE) or (reason is None and t not in written and t not in result.refused))
    errors = refused + sum(w.errors for w in written.values())
    emitted = sum(w.records - w.errors for w in written.values())
    return {"received": received, "emitted": emitted, "skipped": skipped, "errors": errors}


STATS_TABLE, REJECTS_TABLE = "_ingest_stats", "_ingest_rejects"
TOPICS_TABLE, SAMPLES_TABLE, OFFSETS_TABLE = "_ingest_topic_stats", "_ingest_first_samples", "_ingest_offsets"
CHANGES_TABLE, LOSS_TABLE = "_ingest_schema_changes", "_ingest_coercion_loss"
STATS_DDL = "batch_id bigint, received bigint, emitted bigint, skipped bigint, errors bigint"
REJECTS_DDL = ("batch_id bigint, topic string, partition int, offset bigint, disposition string, reason string, "
               "detail string, first_byte string, preview string")
CHANGES_DDL = ("batch_id bigint, table_name string, position int, field string, type string, first_topic string, "
               "first_partition int, first_offset bigint")
TOPICS_DDL = "batch_id bigint, topic string, received bigint, emitted bigint, skipped bigint, errors bigint"
BEGUN_TABLE, BEGUN_DDL = "_ingest_begun", "batch_id bigint, tag string"
OFFSETS_DDL = "batch_id bigint, topic string, partition int, first bigint, last bigint"
SAMPLES_DDL = "batch_id bigint, topic string, partition int, offset bigint, first_byte string, preview string"
LOSS_DDL = "batch_id bigint, table_name string, column string, kind string, records bigint"


def write_logs(store: TableStore, result: BatchResult, batch_tag: str, batch_id: int) -> None:
    """The batch's statistics, rejects (O3/O4), schema changes (I10) and coercion
    losses, each into a table beside the data; nothing is written for what the
    batch does not have."""
    spark, number = result.admitted.sparkSession, F.lit(int(batch_id)).cast("bigint").alias("batch_id")

    def log(table, ddl, rows):
        names = [f.name for f in T._parse_datatype_string(ddl).fields]
        store.append_log(table, ddl, rows.select(number, *names[1:]), batch_tag)

    c = batch_counts(result, result.written)
    log(STATS_TABLE, STATS_DDL, spark.createDataFrame([(c["received"], c["emitted"], c["skipped"], c["errors"])],
                                                      STATS_DDL.split(", ", 1)[1]).coalesce(1))
    if c["skipped"] or c["errors"]:
        failed = [t for t, w in result.written.items() if w.errors]
        log(REJECTS_TABLE, REJECTS_DDL, reject_frame(result.rejected(failed)))
    # Per topic: what the census knows, and the failed ones from the rejects just written.
    failed = {}
    if c["errors"]:
        mine = store.read_batch(REJECTS_TABLE, batch_tag, batch_id).filter(F.col("disposition") == "error")
        failed = {r["topic"]: r["n"] for r in mine.groupBy("topic").agg(F.count(F.lit(1)).alias("n")).collect()}   # one row per topic
    per: dict = {}
    for t, topic, reason, n in result.census:
        row = per.setdefault(topic, [0, 0])
        row[0] += n
        dropped = reason not in (None, NO_TABLE) or (reason is None and t not in result.written and t not in result.refused)
        row[1] += n if dropped else 0
    rows = [(topic, got, got - out - failed.get(topic, 0), out, failed.get(topic, 0))
            for topic, (got, out) in sorted(per.items(), key=lambda x: (x[0] is None, x[0]))]
    log(TOPICS_TABLE, TOPICS_DDL, spark.createDataFrame(rows, TOPICS_DDL.split(", ", 1)[1]).coalesce(1))
    # First samples: only topics whose first record lies before what earlier batches gave.
    known = store.first_samples()
    new = {t: at for t, at in result.firsts.items() if t not in known or at < known[t]}
    if new:
        at = spark.createDataFrame([(t, o, p) for t, (o, p) in new.items()], "topic string, offset long, partition int")
        same = [result.admitted[x].eqNullSafe(at[x]) for x in ("topic", "offset", "partition")]
        first = result.admitted.filter(F.col("reason").isNull() | (F.col("reason") != "empty")).join(
            at, same[0] & same[1] & same[2], "left_semi")
        log(SAMPLES_TABLE, SAMPLES_DDL, sample_rows(first))
        known.update(new)
    if result.changes:
        log(CHANGES_TABLE, CHANGES_DDL, result.change_frame().withColumnRenamed("table", "table_name").coalesce(1))
    lossy = [result.losses(t) for t, w in sorted(result.written.items()) if w.maybe_lossy]
    if lossy:
        frame = lossy[0]
        for x in lossy[1:]:
            frame = frame.unionByName(x)
        log(LOSS_TABLE, LOSS_DDL, frame)


def ingest_into(store: TableStore, records: DataFrame, batch_tag: str,
                cfg: IngestConfig | None = None, route=None, batch_id: int | None = None,
                ledger: bool = False) -> BatchResult:
    """One batch end to end: admit and stage once, infer against the live
    tables, widen, append; with ``batch_id`` also the log tables.  With ``ledger``
    only records that no committed batch held are taken, each once, and the batch's
    offsets are committed after everything else.

    A table that fails does not stop the others.  If any failed, ``TableErrors``
    is raised at the end, so a streaming batch is tried again; what was written
    is then replaced, not doubled."""
    cfg = cfg or IngestConfig()
    apply_session_conf(records.sparkSession)
    store.ensure_namespace()
    kwargs = {"route": route} if route is not None else {}
    if ledger:
        store.begin(batch_tag, batch_id or 0)
        records = store.uncommitted(records)
    stage = shared_path(store.spark, "stage", unique=True)
    try:
        result = ingest(records, cfg=cfg, known_loader=store.schemas, stage=stage, reserved=(BATCH_COL,), **kwargs)
        result.written, failed = write_result(store, result, batch_tag, cfg)
        if not failed and batch_id is not None and result.census:
            write_logs(store, result, batch_tag, batch_id)
        if ledger and not failed and result.census:
            ranges = offset_ranges(result.admitted).select(F.lit(int(batch_id or 0)).cast("bigint").alias("batch_id"), "topic", "partition", "first", "last")
            store.append_log(OFFSETS_TABLE, OFFSETS_DDL, ranges, batch_tag)
    finally:
        remove_path(store.spark, stage)
    if failed:
        raise TableErrors(failed) from next(iter(failed.values()))
    return result
