"""Registered queries ``opN_<name>`` of this package and the oracles of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

import public_tokenizers

from driftline.llm.bitplanes import roundtrip
from driftline.llm.bwt_dedup import repeated_spans
from driftline.llm.common import SPACE_CLASS, load
from driftline.llm.exact_dedup import exact_groups
from driftline.llm.gru_lm import score_documents as lm_scores
from driftline.llm.mixing import mix_rows
from driftline.llm.packing import pack_documents
from driftline.llm.phrases import mine_phrases
from driftline.llm.quality_cnn import quality_model, score_quality
from driftline.llm.quality_rules import apply_rules, rules_model
from driftline.llm.runs import periodic_runs
from driftline.llm.sharding import SHARD_BYTES, shard_documents
from driftline.llm.simhash import near_groups
from driftline.llm.toxicity import score_documents, toxicity_model


def op1_simhash_near_dedup(spark, sf):
    return near_groups(load(spark, sf, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_quality_cnn(spark, sf):
    docs = load(spark, sf, "documents")
    return score_quality(docs, quality_model(docs, load(spark, sf, "labels")))


def op3_best_fit_packing(spark, sf):
    return pack_documents(load(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_sharding(spark, sf):
    return shard_documents(load(spark, sf, "documents"))


def op5_bit_plane_ids(spark, sf):
    return roundtrip(load(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_gru_lm(spark, sf):
    return lm_scores(load(spark, sf, "documents"))


def op7_exact_dedup(spark, sf):
    return exact_groups(load(spark, sf, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_quality_rules(spark, sf):
    docs = load(spark, sf, "documents")
    return apply_rules(docs, rules_model(docs, load(spark, sf, "labels")))


def op9_toxicity(spark, sf):
    docs = load(spark, sf, "documents")
    model = toxicity_model(docs, load(spark, sf, "labels"))
    return score_documents(docs, model).select("doc_id", "held_out", "score", "predicted")


def op10_mixing(spark, sf):
    return mix_rows(load(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", F.col("copies").cast("int").alias("copies"))


def repeat_ends(docs):
    """``documents`` with the repeats that the runs query looks for: every tenth
    document (by the crc32 of its id) repeats from one of its words on."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), SPACE_CLASS + "+"), lambda w: w != "")
    d = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g")).withColumn("w", F.when(F.col("h") % 10 == 0, words))
    n = F.size("w")
    d = d.withColumn("n", n).withColumn("a", (F.col("g") % n).cast("int")).withColumn(
        "p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    again = F.expr("array_join(transform(sequence(0, n - 1), i -> if(i < a, w[i], w[a + (i - a) % p])), ' ')")
    return d.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), again).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, sf):
    found = periodic_runs(repeat_ends(load(spark, sf, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"), F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_phrase_mining(spark, sf):
    return mine_phrases(load(spark, sf, "documents"))


def op13_suffix_dedup(spark, sf):
    found = repeated_spans(load(spark, sf, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_quality_cnn": op2_quality_cnn,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_sharding": op4_sharding,
    "op5_bit_plane_ids": op5_bit_plane_ids,
    "op6_gru_lm": op6_gru_lm,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_toxicity": op9_toxicity,
    "op10_mixing": op10_mixing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_suffix_dedup": op13_suffix_dedup,
}

ORACLE_SQL = {
    "op12_phrase_mining": """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS rid,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[.,;:!?\\x0A-\\x0D]') AS pieces
  FROM documents),
p AS (SELECT lang, rid, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS pid FROM d),
l AS (SELECT lang, rid, pid, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
w AS (SELECT lang, rid, pid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM l),
g AS (
  SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4
  FROM w WINDOW o AS (PARTITION BY rid, pid ORDER BY i)),
c AS (
  SELECT lang, 1 AS k, w1 AS phrase, count(*) AS f FROM g GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM g WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM g WHERE w3 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) FROM g WHERE w4 IS NOT NULL GROUP BY ALL),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM c WHERE k >= 2 AND f >= 30),
cuts AS (SELECT lang, k, phrase, a, ws, unnest(range(1, k)) AS cut FROM cand),
parts AS (
  SELECT x.lang, x.phrase, x.k, x.a, x.cut, l.f AS l, r.f AS r, (2000000::HUGEINT * x.a) // (l.f + r.f) AS score
  FROM cuts x JOIN c l ON l.lang = x.lang AND l.k = x.cut AND l.phrase = array_to_string(x.ws[1:x.cut], ' ')
  JOIN c r ON r.lang = x.lang AND r.k = x.k - x.cut AND r.phrase = array_to_string(x.ws[x.cut + 1:], ' ')),
best AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, a, array_to_string(ws[s:s + m - 1], ' ') AS phrase FROM (
    SELECT lang, k, a, ws, m, unnest(range(1, k - m + 2)) AS s FROM (SELECT *, unnest(range(2, k)) AS m FROM cand))),
around AS (SELECT lang, phrase, max(a) AS longer FROM inside GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN around USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * b.a),
n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n,
       CAST(score AS BIGINT) AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
""",
    "op4_sharding": f"""
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
         right(repeat('0', 60) || bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)), 60) AS bits
  FROM documents),
nodes AS (
  SELECT g.depth, substr(bits, 1, g.depth) AS bucket, CAST(sum(n_bytes) AS BIGINT) AS bytes, count(*) AS n
  FROM d, (SELECT CAST(range AS INTEGER) AS depth FROM range(0, 41)) g GROUP BY ALL),
fit AS (SELECT * FROM nodes WHERE bytes <= {SHARD_BYTES} OR n <= 1),
leaf AS (
  SELECT d.doc_id, min(fit.depth) AS depth FROM d JOIN fit ON substr(d.bits, 1, fit.depth) = fit.bucket GROUP BY d.doc_id)
SELECT d.doc_id, d.n_bytes, nodes.bucket AS shard, nodes.depth AS shard_depth, nodes.bytes AS shard_bytes, nodes.n AS shard_docs
FROM d JOIN leaf USING (doc_id) JOIN nodes ON nodes.depth = leaf.depth AND nodes.bucket = substr(d.bits, 1, leaf.depth)
""",
    "op7_exact_dedup": """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_code,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS norm
  FROM documents),
w AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_code DESC, doc_id) AS keep_id
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM w
""",
    "op13_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
w AS (SELECT doc_id, s, substr(hx, 2 * s + 1, 200) AS g FROM (SELECT doc_id, hx, unnest(range(0, n - 99)) AS s FROM d)),
r AS (SELECT doc_id, s FROM w QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, s) > 1),
m AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS new FROM r),
k AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM m),
sp AS (SELECT doc_id, k, min(s) AS a, max(s) + 100 AS b FROM k GROUP BY ALL),
x AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM sp),
j AS (
  SELECT doc_id, hx, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, max(b) AS reach,
         string_agg(substr(hx, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM x JOIN d USING (doc_id) GROUP BY doc_id, hx)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN d.hx ELSE kept || substr(d.hx, 2 * reach + 1) END)) AS kept_sha256
FROM d LEFT JOIN j USING (doc_id)
""",
}
