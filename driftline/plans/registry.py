"""Registered queries: one per operator group of the inventory.

Each takes (spark, sf_dir) and returns a DataFrame whose column names match
the oracle SQL in ``driftline.plans.oracle``.  Queries that exercise the sink
write into a fresh namespace under the shared checkpoint folder, then return
the read-back.  All work is derived from the test tables, so it scales with
them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.config import IngestConfig
from driftline.functions.route import normalize_location, topic_to_table
from driftline.operators.admit import EMITTED, PENDING
from driftline.operators.coerce import ERR, SRC
from driftline.operators.observe import counters, first_record_sample, reject_frame
from driftline.plans.ingest import BatchResult, ingest
from driftline.operators.infer import NESTED_LEVELS, quote
from driftline.plans.sink import CHANGES_TABLE, LOSS_TABLE, REJECTS_TABLE, STATS_TABLE, TableStore, ingest_into
from driftline.session import apply_session_conf, shared_path
from driftline.sources import fixtures as fx
from driftline.sources.records import read_record_stream, slice_from_offsets, topic_filter
from driftline.streaming.runner import start_ingest

DEFAULT_PATTERN = IngestConfig().topic_pattern      # "[^_].*"
DATED_SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("day", T.DateType()),
                             T.StructField("at", T.TimestampType())])


def _prep(spark: SparkSession) -> SparkSession:
    return apply_session_conf(spark)


def _ingest(spark, sf, names, known=None) -> BatchResult:
    """One batch, staged: records are made and admitted once, and each table reads its own."""
    _prep(spark)
    return ingest(fx.all_records(spark, sf, names), known=known, stage=shared_path(spark, "query-stage", unique=True))


def _rows(spark, sf, name, table) -> DataFrame:
    return _ingest(spark, sf, [name]).rows(table)


def _store(spark: SparkSession, tag: str) -> TableStore:
    ns = f"dl_{tag}_{uuid.uuid4().hex[:10]}"
    store = TableStore(spark, ns, shared_path(spark, "warehouse", ns))
    store.ensure_namespace()
    return store


def outcomes(result: BatchResult, table: str, cols: list[str]) -> DataFrame:
    """Per record: offset, disposition, reason and typed ``cols`` (null unless
    emitted).  A union of skipped records and coerced ones: no join."""
    skipped = (result.admitted.filter(F.col("disposition") != PENDING)
               .filter(F.col("table") == table)
               .select("offset", "disposition", "reason", *[F.lit(None).alias(c) for c in cols]))
    c = result.coerced(table)
    ok = F.col(ERR).isNull()
    typed = c.select(F.col(f"{SRC}.offset").alias("offset"),
                     F.when(ok, F.lit(EMITTED)).otherwise(F.lit("error")).alias("disposition"),
                     F.when(~ok, F.lit("convert_error")).alias("reason"),
                     *[F.when(ok, F.col(x)).alias(x) for x in cols])
    return skipped.unionByName(typed, allowMissingColumns=False) if cols else skipped.unionByName(typed)


# -- sources ---------------------------------------------------------------

def topic_pattern_scan(spark, sf):
    """Subscribe by pattern; the internal topic is left out."""
    recs = topic_filter(fx.all_records(_prep(spark), sf), DEFAULT_PATTERN)
    return recs.groupBy("topic").agg(F.count(F.lit(1)).alias("records"),
                                     F.min("offset").alias("min_offset"),
                                     F.max("offset").alias("max_offset"))


START_SPEC = {"orders": {"0": 3000, "1": -2, "2": -1}, "customers": {"0": -1, "1": 300}}


def start_offset_slice(spark, sf):
    """S3: per-partition starting offsets (-2 earliest, -1 latest)."""
    recs = fx.all_records(_prep(spark), sf, ["orders", "customers"])
    sliced = slice_from_offsets(recs, START_SPEC)
    return sliced.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("records"),
                                                    F.min("offset").alias("min_offset"))


# -- admission ---------------------------------------------------------------

def utf8_json_admission(spark, sf):
    """P1/P2/F1-F3 on the ``faulty`` frame, with the decoded ``status``."""
    return outcomes(_ingest(spark, sf, ["faulty"]), "faulty", ["status"])


def envelope_unwrap(spark, sf):
    """Enveloped and bare records land as the same rows."""
    return _rows(spark, sf, "enveloped", "cdc_customers")


def delete_filter(spark, sf):
    """`__deleted` "true" or true is skipped; "false" stays, as a column."""
    return outcomes(_ingest(spark, sf, ["enveloped"]), "cdc_customers", [])


# -- inference ---------------------------------------------------------------

def ingest_orders_typed(spark, sf):
    """Flagship: orders records -> typed rows."""
    return _rows(spark, sf, "orders", "orders")


def ingest_customers_nullable(spark, sf):
    return _rows(spark, sf, "customers", "customers")


def ingest_events_nested(spark, sf):
    rows = _rows(spark, sf, "events", "user_events")
    return rows.select("id", "user_id", "type", "value", F.col("props.k").alias("props_k"))


def nested_field_not_evolved(spark, sf):
    rows = _rows(spark, sf, "events", "user_events")
    return rows.select("id", F.to_json("props").alias("props_json"))


def ingest_line_arrays(spark, sf):
    rows = _rows(spark, sf, "lines", "line_items")
    # (outer: Spark would test the items of a plain one before it reads the rest, so records are parsed twice)
    return rows.select("id", F.posexplode_outer("items").alias("idx", "item"),
                       F.array_join("flags", ",").alias("flags")).filter(F.col("idx").isNotNull()).select(
        "id", "idx", "item.line", "item.qty", "item.price", "flags")


SCHEMA_FRAMES = ["orders", "orders_nullfirst", "customers", "events", "lines", "wide_kinds",
                 "enveloped", "faulty", "collide"]


def infer_schema_frame(spark, sf):
    """(table, position, field, type) of every inferred table, and how
    many landed rows have a value there."""
    res = _ingest(spark, sf, SCHEMA_FRAMES)
    out = None
    for t in res.tables:
        fields = res.schemas[t].fields
        counts = res.rows(t).agg(*[F.count(F.col(quote(f.name))).alias(f"c{i}") for i, f in enumerate(fields)])
        lines = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("field"),
                                   F.lit(f.dataType.simpleString()).alias("type"), F.col(f"c{i}").alias("records"))
                          for i, f in enumerate(fields)])
        part = counts.select(F.lit(t).alias("table_name"), F.explode(lines).alias("l")).select("table_name", "l.*")
        out = part if out is None else out.unionByName(part)
    return out


def infer_nested_empty(spark, sf):
    """An object without any value pins nothing, however deep; the first
    later record with content does."""
    rows = _rows(spark, sf, "nested_empty", "nested_empty")
    return rows.select("id", F.col("a.b.c").alias("c"))


def awkward_names(spark, sf):
    """P5: dots, spaces, backticks and other letters in names, batch interface."""
    rows = _rows(spark, sf, "awkward", "awkward")
    return rows.select("id", F.col("`a.b`").alias("dotted"), F.col("`c d`").alias("spaced"), F.col("`e``f`").alias("ticked"),
                       F.col("`Ünï`").alias("accented"), F.col("`g-h`.`p.q`").alias("nested_dotted"),
                       F.col("`g-h`.`r s`").alias("nested_spaced"))


def documents_roundtrip(spark, sf):
    """C6 on real text: whole documents and conversation turns through the sink."""
    store = _store(_prep(spark), "docs")
    ingest_into(store, fx.all_records(spark, sf, ["documents", "conversations"]), "b0")
    docs = store.read("documents").select(F.lit("documents").alias("table_name"), "id", "text", F.col("lang").alias("tag"))
    return docs.unionByName(store.read("conversations").select(
        F.lit("conversations").alias("table_name"), "id", "text", F.col("role").alias("tag")))


def null_first_pins_string(spark, sf):
    return _rows(spark, sf, "orders_nullfirst", "orders_v2").select("id", "discount_pct")


def value_first_pins_double(spark, sf):
    return _rows(spark, sf, "orders", "orders").select("id", "discount_pct")


# -- coercion ----------------------------------------------------------------

def coerce_wrong_kind(spark, sf):
    rows = _rows(spark, sf, "wide_kinds", "kinds")
    return rows.select("id", "b", "n", "d", "s", F.col("o.size").alias("o_size"),
                       F.col("o.brand").alias("o_brand"), F.col("o").isNull().alias("o_null"),
                       F.array_join(F.transform("a", lambda x: x.cast("string")), ",").alias("a_text"))


def coerce_date_timestamp(spark, sf):
    """C8/C9/F5 against a table that already has DATE and TIMESTAMP columns."""
    res = _ingest(spark, sf, ["dated"], known={"dated": DATED_SCHEMA})
    out = outcomes(res, "dated", ["day", "at"])
    return out.select("offset", "disposition", F.date_format("day", "yyyy-MM-dd").alias("day"),
                      F.unix_millis("at").alias("at_ms"))


TYPED_SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("i", T.IntegerType()),
                             T.StructField("f", T.FloatType()), T.StructField("bin", T.BinaryType()),
                             T.StructField("dec", T.DecimalType(10, 2)), T.StructField("note", T.StringType())])


def coerce_existing_types(spark, sf):
    """INT, FLOAT, BINARY and DECIMAL columns of a table that
    already exists (inference never creates them)."""
    res = _ingest(spark, sf, ["typed_kinds"], known={"typed": TYPED_SCHEMA})
    out = outcomes(res, "typed", ["i", "f", "bin", "dec", "note"])
    return out.select("offset", "disposition", "i", F.col("f").cast("double").alias("f"),
                      F.hex("bin").alias("bin_hex"), F.col("dec").cast("string").alias("dec_text"), "note")


def coercion_loss(spark, sf):
    """What wrong kinds, overflow and truncation cost, per column."""
    store = _store(_prep(spark), "loss")
    ingest_into(store, fx.all_records(spark, sf, ["wide_kinds", "big_numbers"]), "b0", batch_id=0)
    return store.read(LOSS_TABLE).drop("batch_id")


# -- routing and sink --------------------------------------------------------

def route_topics_to_tables(spark, sf):
    recs = fx.all_records(_prep(spark), sf)
    return recs.groupBy("topic").agg(F.count(F.lit(1)).alias("records")).select(
        "topic", topic_to_table(F.col("topic")).alias("table_name"), "records")


SINK_FRAMES = ["orders", "orders_nullfirst", "customers", "events", "lines", "wide_kinds",
               "enveloped", "faulty", "dated", "collide", "internal"]


def _sink_all(spark, sf, tag):
    store = _store(spark, tag)
    recs = topic_filter(fx.all_records(spark, sf, SINK_FRAMES), DEFAULT_PATTERN)
    ingest_into(store, recs, "batch-0")
    return store


def multi_table_sink_counts(spark, sf):
    """K1-K8: one batch of many topics lands in one table per topic."""
    store = _sink_all(_prep(spark), sf, "multi")
    parts = [store.read(t).groupBy().agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(t).alias("table_name"), "rows")
             for t in store.table_names()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# What of each landed table is compared: a text and a number made of its columns.
VALUE_COLUMNS = {
    "a_b": ("name", "coalesce(from_dot, from_dash)"),
    "cdc_customers": ("concat(name, '/', segment, '/', __deleted)", "nation"),
    "customers": ("concat(name, '/', segment, '/', coalesce(phone, '-'))", "balance"),
    "dated": ("cast(at as string)", "day"),
    "faulty": ("concat(coalesce(status, '-'), '/', coalesce(priority, '-'))", "customer"),
    "kinds": ("s", "d"),
    "line_items": ("array_join(flags, ',')", "size(items)"),
    "orders": ("concat(status, '/', priority, '/', ordered_on)", "total_price"),
    "orders_v2": ("discount_pct", "total_price"),
    "user_events": ("concat(type, '/', props.k)", "value"),
}


def multi_table_sink_values(spark, sf):
    """K1-K8: the landed values of every table of one batch."""
    store = _sink_all(_prep(spark), sf, "values")
    parts = [store.read(t).select(F.lit(t).alias("table_name"), "id", F.expr(text).alias("text"),
                                  F.expr(number).cast("double").alias("number"))
             for t, (text, number) in VALUE_COLUMNS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def route_numeric_topics(spark, sf):
    """Topics named like numbers keep their own tables."""
    store = _store(_prep(spark), "numeric")
    ingest_into(store, fx.records(spark, sf, "numeric_topics"), "b0")
    parts = [store.read(t).select(F.lit(t).alias("table_name"), "id", "name") for t in store.table_names()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _union_of_tables(store, tables, select) -> DataFrame:
    """``select(table)`` of many tables as one statement (each a SELECT text)."""
    return store.spark.sql(" UNION ALL ".join(select(t) for t in tables))


def many_small_topics(spark, sf):
    """K1: hundreds of topics in one batch; tables with the same columns share one write."""
    store = _store(_prep(spark), "small")
    ingest_into(store, fx.records(spark, sf, "small_topics"), "b0")

    def select(t):
        names = set(store.schema(t).fieldNames())
        nation, segment = ("nation" if "nation" in names else "CAST(NULL AS BIGINT)"), ("segment" if "segment" in names else "CAST(NULL AS STRING)")
        return f"SELECT '{t}' AS table_name, id, name, balance, {nation} AS nation, {segment} AS segment FROM {store.name(t)}"
    return _union_of_tables(store, store.table_names(), select)


def poison_record_isolated(spark, sf):
    """records that the table's write fails on go to the rejects, the others of
    the same micro-batch land and the stream goes on."""
    def table(store):
        store.spark.sql(f"CREATE TABLE {store.name('codes')} (id STRING, code VARCHAR(12), _ingest_batch STRING) "
                        f"USING parquet PARTITIONED BY (_ingest_batch)")
    store = _stream_run(spark, sf, ["poisoned"], table)
    landed = store.read("codes").select(F.col("id").cast("bigint").alias("offset"), F.lit("landed").alias("outcome"), F.col("code").cast("string").alias("code"))
    rejects = store.read(REJECTS_TABLE).select("offset", F.concat_ws("/", "disposition", "reason", "detail").alias("outcome"),
                                               F.lit(None).cast("string").alias("code"))
    return landed.unionByName(rejects)


MAX_COLUMNS = 100


def wide_topic_overflow(spark, sf):
    """One key per record.  The first fields get columns, all other values land
    in the overflow column, the same for any cut into batches (here three)."""
    store = _store(_prep(spark), "wide")
    recs = fx.records(spark, sf, "one_key_each")
    last = recs.agg(F.max("offset")).first()[0] or 0
    bounds = [-1, 40, last // 2, last]
    for i, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        ingest_into(store, recs.filter((F.col("offset") > lo) & (F.col("offset") <= hi)), f"b{i}", IngestConfig(max_columns=MAX_COLUMNS))
    own = [f.name for f in store.schema("wide").fields if f.name.startswith("k")]
    value = F.coalesce(*[F.when(F.col(n).isNotNull(), F.struct(F.lit(n).alias("field"), F.col(n).alias("v"))) for n in own])
    rest = F.map_entries(F.from_json("_ingest_overflow", "map<string, struct<name: string, nation: bigint>>")).getItem(0)
    rows = store.read("wide").select("id", value.alias("own"), rest.alias("rest"))
    return rows.select("id", F.col("own").isNotNull().alias("has_column"), F.coalesce("own.field", "rest.key").alias("field"),
                       F.coalesce("own.v.name", "rest.value.name").alias("name"), F.coalesce("own.v.nation", "rest.value.nation").alias("nation"))


def deep_nesting_landed(spark, sf):
    """10 to 900 objects inside each other; what lies below the last typed
    level is JSON text."""
    store = _store(_prep(spark), "deep")
    ingest_into(store, fx.records(spark, sf, "nested_deep"), "b0")
    out = None
    for n in fx.DEPTHS:
        if not store.exists(f"deep_{n}"):       # no record of this depth in a very small table
            continue
        inner = F.col("v" + ".a" * min(n, NESTED_LEVELS))
        part = store.read(f"deep_{n}").select(F.lit(n).alias("depth"), "id", F.length(inner).alias("chars"), F.md5(inner.cast("binary")).alias("digest"))
        out = part if out is None else out.unionByName(part)
    return out


def hollow_objects_long_text(spark, sf):
    """Empty objects beside texts of up to ten million characters."""
    rows = _rows(spark, sf, "hollow", "hollow")
    return rows.select("id", F.length("b.text").alias("chars"), F.md5(F.col("b.text").cast("binary")).alias("digest"),
                       F.lit(",".join(rows.columns)).alias("columns"))


LISTED = ["customers", "enveloped", "wide_kinds", "collide"]


def list_tables(spark, sf):
    """One small batch, its tables and how many rows each holds."""
    store = _store(_prep(spark), "list")
    ingest_into(store, fx.all_records(spark, sf, LISTED), "b0")
    out = None
    for r in store.list_tables().collect():          # catalog names
        part = store.read(r["table"]).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(r["table"]).alias("table_name"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


def ingest_beside_map_table(spark, sf):
    """A table that cannot take rows costs only its own topic's records."""
    store = _store(_prep(spark), "beside")
    for t in ("customers", "unrelated"):
        spark.sql(f"CREATE TABLE {store.name(t)} (id STRING, m MAP<STRING, STRING>, _ingest_batch STRING) "
                  f"USING parquet PARTITIONED BY (_ingest_batch)")
    ingest_into(store, fx.all_records(spark, sf, ["orders", "customers"]), "b0", batch_id=0)
    landed = store.read("orders").select(F.lit("orders").alias("topic"), F.col("id").cast("bigint").alias("offset"),
                                         F.lit("landed").alias("outcome"))
    return landed.unionByName(store.read(REJECTS_TABLE).select("topic", "offset", F.col("reason").alias("outcome")))


def reserved_field_name(spark, sf):
    """K2: a record with a field named like the hidden column is rejected; the rest lands."""
    store = _store(_prep(spark), "reserved")
    ingest_into(store, fx.records(spark, sf, "reserved"), "b0", batch_id=0)
    landed = store.read("reserved").select(F.col("id").cast("bigint").alias("offset"), F.lit("landed").alias("outcome"))
    return landed.unionByName(store.read(REJECTS_TABLE).select("offset", F.col("reason").alias("outcome")))


def append_plain_session(spark, sf):
    """K4: two batches through a session that nobody prepared keep both batches' rows."""
    recs = fx.record_files(_prep(spark), sf, "orders")
    plain = spark.newSession()
    store = TableStore(plain, f"dl_plain_{uuid.uuid4().hex[:10]}", shared_path(spark, "warehouse", "plain", unique=True))
    again = plain.read.schema(recs.schema).parquet(*recs.inputFiles())
    for i, cond in enumerate(["offset < 500", "offset >= 500"]):
        plain.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
        plain.conf.set("spark.sql.caseSensitive", "false")
        ingest_into(store, again.filter(cond), f"b{i}")
    return store.read("orders").select("id", "total_price", "discount_pct")


def evolve_add_column(spark, sf):
    """Batch 0 (keys < 500) creates the table, batch 1 adds
    ``discount_pct``; earlier rows read null."""
    store = _store(_prep(spark), "evolve")
    recs = fx.records(spark, sf, "orders")
    ingest_into(store, recs.filter("offset < 500"), "b0")
    ingest_into(store, recs.filter("offset >= 500"), "b1")
    return store.read("orders").select("id", "total_price", "discount_pct")


def schema_change_log(spark, sf):
    """The schema changes that the two batches above write."""
    store = _store(_prep(spark), "changes")
    recs = fx.records(spark, sf, "orders")
    for i, cond in enumerate(["offset < 500", "offset >= 500"]):
        ingest_into(store, recs.filter(cond), f"b{i}", batch_id=i)
    return store.read(CHANGES_TABLE).drop("first_topic")


def append_change_log(spark, sf):
    """K4: every change is a row; versions of a key are all kept."""
    store = _store(_prep(spark), "changelog")
    ingest_into(store, fx.records(spark, sf, "customer_versions"), "b0")
    return store.read("customers_changes").select("id", "version", "balance")


def replay_idempotent(spark, sf):
    """The same batch written twice leaves one copy."""
    store = _store(_prep(spark), "replay")
    recs = fx.records(spark, sf, "orders")
    ingest_into(store, recs, "q-0")
    ingest_into(store, recs, "q-0")
    return store.read("orders").select("id", "total_price")


def read_limit(spark, sf):
    """A limited read-back; which rows come is open, so their number and
    whether they are rows of the table is returned."""
    store = _store(_prep(spark), "limit")
    ingest_into(store, fx.records(spark, sf, "orders"), "b0")
    some, every = store.read_limit("orders", 10), store.read("orders").select("id").distinct()
    return some.join(every, "id", "left_semi").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"))


def restart_reload_schema(spark, sf):
    """A table that exists keeps its columns first, in its order;
    new fields follow in first-seen order."""
    store = _store(_prep(spark), "reload")
    spark.sql(f"CREATE TABLE {store.name('orders')} (status STRING, id STRING, note STRING, "
              f"_ingest_batch STRING) USING parquet PARTITIONED BY (_ingest_batch)")
    ingest_into(store, fx.records(spark, sf, "orders"), "b0")
    sch = store.schema("orders")
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(sch.fields)]
    n = store.read("orders").count()
    return spark.createDataFrame([(*r, n) for r in rows],
                                 "position int, field string, type string, table_rows bigint")


# Shares of a topic's offsets at which the replayed record files are cut.
STREAM_CUTS = [0.3, 0.6]


def _stream_run(spark, sf, frames=("orders",), before=None):
    """Record files cut in key order; after each cut the ingest query is
    (re)started on the same checkpoint and drains what is new, so every cut
    is one micro-batch and the run restarts twice."""
    _prep(spark)
    base = shared_path(spark, "stream", unique=True)
    src, ckpt = f"{base}/records", f"{base}/checkpoint"
    recs = fx.all_records(spark, sf, list(frames))
    last = recs.agg(F.max("offset")).first()[0] or 0
    bounds = [-1, *[int(last * c) for c in STREAM_CUTS], last]
    store = _store(spark, "stream")
    if before:
        before(store)
    for lo, hi in zip(bounds, bounds[1:]):
        recs.filter((F.col("offset") > lo) & (F.col("offset") <= hi)).write.mode("append").parquet(src)
        q = start_ingest(read_record_stream(spark, src, DEFAULT_PATTERN), store, ckpt,
                         IngestConfig(), query_name=None, available_now=True)
        q.awaitTermination()
    return store


def stream_equals_batch(spark, sf):
    """Micro-batches with a restart give the batch result."""
    store = _stream_run(spark, sf)
    return store.read("orders").select("id", "total_price", "discount_pct")


def stream_batch_stats(spark, sf):
    """One stats row per micro-batch of the streamed run."""
    store = _stream_run(spark, sf)
    return store.read(STATS_TABLE)


def _dated_table(store):
    spark = store.spark
    spark.sql(f"CREATE TABLE {store.name('dated')} ({fx.DATED_DDL}, _ingest_batch STRING) "
              f"USING parquet PARTITIONED BY (_ingest_batch)")


def stream_rejects(spark, sf):
    """O3/O4 in the running job: why records vanished, over a run with restarts."""
    store = _stream_run(spark, sf, ["faulty", "dated"], _dated_table)
    return store.read(REJECTS_TABLE).drop("batch_id", "partition")


def stream_schema_changes(spark, sf):
    """I10 in the running job."""
    store = _stream_run(spark, sf)
    return store.read(CHANGES_TABLE).drop("first_topic", "first_partition")


def stream_totals(spark, sf):
    """O1/O5 over the job's life: counters per topic after a run with restarts."""
    return _stream_run(spark, sf, OBSERVED, _dated_table).totals()


def stream_first_samples(spark, sf):
    """O2 in the running job: the first record of each topic after a run with
    restarts (the pattern leaves the internal topic out)."""
    return _stream_run(spark, sf, SAMPLED, _dated_table).samples()


def topic_joins_running_query(spark, sf):
    """A topic whose files appear while the query runs, without a restart."""
    _prep(spark)
    base = shared_path(spark, "joining", unique=True)
    store = _store(spark, "joining")
    fx.records(spark, sf, "customers").write.parquet(f"{base}/records/customers")
    query = start_ingest(read_record_stream(spark, f"{base}/records/*", DEFAULT_PATTERN), store, f"{base}/checkpoint",
                         IngestConfig(checkpoint_interval_ms=200), query_name=None)
    try:
        query.processAllAvailable()
        before = store.table_names()
        fx.records(spark, sf, "internal").write.parquet(f"{base}/records/internal")
        fx.records(spark, sf, "orders").write.parquet(f"{base}/records/orders")
        query.processAllAvailable()
    finally:
        query.stop()
    parts = [store.read(t).select(F.lit(t).alias("table_name"), F.lit(t in before).alias("at_start"), "id") for t in ("customers", "orders")]
    names = spark.createDataFrame([(t, False, None) for t in store.table_names() if not t.startswith("_ingest") and t not in ("customers", "orders")],
                                  "table_name string, at_start boolean, id string")
    return parts[0].unionByName(parts[1]).unionByName(names)


def resume_from_ledger(spark, sf):
    """A run with gaps, one that died before it was committed, a lost
    checkpoint, and a replay from the beginning: every record is in once."""
    store = _store(_prep(spark), "ledger")
    recs = fx.records(spark, sf, "orders").withColumn("partition", F.lit(0))
    last = recs.agg(F.max("offset")).first()[0] or 0
    base = shared_path(spark, "ledger", unique=True)
    some = recs.filter((F.col("offset") <= last * 2 // 3) & (F.col("offset") % 10 != 3))
    some.write.parquet(f"{base}/records/a")

    def run(checkpoint):
        start_ingest(read_record_stream(spark, f"{base}/records/*", DEFAULT_PATTERN), store, f"{base}/{checkpoint}",
                     IngestConfig(starting_offsets="committed"), query_name=None, available_now=True, ledger=True).awaitTermination()
    run("first")
    store.begin("died-0", 0)                    # its rows landed, its offsets did not
    ingest_into(store, recs.filter(F.col("offset") > last // 2), "died-0")
    recs.write.parquet(f"{base}/records/b")     # overlaps and fills the gaps
    run("second")
    return store.read("orders").select("id", "total_price", F.lit(store.ledger().count()).cast("bigint").alias("ranges"))


# -- observability -----------------------------------------------------------

OBSERVED = ["faulty", "enveloped", "dated", "orders"]


def ingest_counters(spark, sf):
    res = _ingest(spark, sf, OBSERVED, known={"dated": DATED_SCHEMA})
    return counters(res.dispositions())


def reject_report(spark, sf):
    res = _ingest(spark, sf, ["faulty", "dated"], known={"dated": DATED_SCHEMA})
    return reject_frame(res.rejected()).drop("partition")


SAMPLED = ["faulty", "enveloped", "dated", "collide", "internal"]


def first_record_samples(spark, sf):
    res = _ingest(spark, sf, SAMPLED)
    return first_record_sample(res.admitted)


def normalize_locations(spark, sf):
    loc = fx.locations(_prep(spark), sf)
    return loc.select("page_id", "location", normalize_location("location").alias("normalized"))


QUERIES = {
    "ingest_orders_typed": ingest_orders_typed,
    "topic_pattern_scan": topic_pattern_scan,
    "start_offset_slice": start_offset_slice,
    "utf8_json_admission": utf8_json_admission,
    "envelope_unwrap": envelope_unwrap,
    "delete_filter": delete_filter,
    "ingest_customers_nullable": ingest_customers_nullable,
    "ingest_events_nested": ingest_events_nested,
    "ingest_line_arrays": ingest_line_arrays,
    "infer_schema_frame": infer_schema_frame,
    "null_first_pins_string": null_first_pins_string,
    "value_first_pins_double": value_first_pins_double,
    "evolve_add_column": evolve_add_column,
    "schema_change_log": schema_change_log,
    "nested_field_not_evolved": nested_field_not_evolved,
    "coerce_wrong_kind": coerce_wrong_kind,
    "coerce_date_timestamp": coerce_date_timestamp,
    "coerce_existing_types": coerce_existing_types,
    "route_topics_to_tables": route_topics_to_tables,
    "multi_table_sink_counts": multi_table_sink_counts,
    "append_change_log": append_change_log,
    "replay_idempotent": replay_idempotent,
    "stream_equals_batch": stream_equals_batch,
    "stream_batch_stats": stream_batch_stats,
    "restart_reload_schema": restart_reload_schema,
    "ingest_counters": ingest_counters,
    "reject_frame": reject_report,
    "first_record_sample": first_record_samples,
    "normalize_locations": normalize_locations,
    "list_tables": list_tables,
    "read_limit": read_limit,
    "append_plain_session": append_plain_session,
    "route_numeric_topics": route_numeric_topics,
    "infer_nested_empty": infer_nested_empty,
    "multi_table_sink_values": multi_table_sink_values,
    "ingest_beside_map_table": ingest_beside_map_table,
    "reserved_field_name": reserved_field_name,
    "stream_rejects": stream_rejects,
    "stream_schema_changes": stream_schema_changes,
    "coercion_loss": coercion_loss,
    "documents_roundtrip": documents_roundtrip,
    "awkward_names": awkward_names,
    "many_small_topics": many_small_topics,
    "stream_totals": stream_totals,
    "stream_first_samples": stream_first_samples,
    "topic_joins_running_query": topic_joins_running_query,
    "resume_from_ledger": resume_from_ledger,
    "poison_record_isolated": poison_record_isolated,
    "wide_topic_overflow": wide_topic_overflow,
    "deep_nesting_landed": deep_nesting_landed,
    "hollow_objects_long_text": hollow_objects_long_text,
}
