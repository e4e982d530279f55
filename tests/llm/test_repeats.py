"""Periodic runs, phrases and repeated passages against brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import bwt_dedup, phrases, runs
from driftline.llm.bwt_dedup import merge_transforms, repeated_spans, shard_order
from driftline.llm.common import load, numbered
from driftline.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import HARD


# -- runs ----------------------------------------------------------------------

def brute_runs(w, least=12):
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s, size = i, j - i + q
            if j > i and size >= max(least, 2 * q) and not any(
                    all(w[s + x] == w[s + x + r] for x in range(size - r)) for r in range(1, q)):
                out.append((s, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def as_runs(found):
    return [tuple(int(x) for x in r) for r in found]


def brute_collapse(w, found):
    drop = {x for s, n, q in found for x in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in drop)


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(700):
        k, n = rng.choice([1, 2, 3, 5, 20]), rng.randint(0, 90)
        w = [b"w%d" % rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.4 and n > 10:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 2))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = runs.find_runs(w, least)
        assert as_runs(found) == brute_runs(w, least)
        assert runs.collapse(w, found) == brute_collapse(w, as_runs(found))


def test_squares_and_powers_of_words():
    a = [b"a%d" % i for i in range(9)]
    assert as_runs(runs.find_runs(a * 2)) == [(0, 18, 9)]
    assert as_runs(runs.find_runs([b"x"] + a * 2 + [b"y"])) == [(1, 18, 9)]
    assert as_runs(runs.find_runs([b"x"] * 11)) == [] and as_runs(runs.find_runs([b"x"] * 12)) == [(0, 12, 1)]
    assert as_runs(runs.find_runs((a * 3 + [b"."]) * 2)) == [(0, 27, 9), (0, 56, 28), (28, 27, 9)]


def test_extensions_are_longest_common_prefixes():
    rng = np.random.default_rng(1)
    for n in (1, 2, 17, 300):
        s = rng.integers(1, 3, n).tolist()
        tree = runs.Extensions(s, 3)
        assert sorted(tree.order) == list(range(n + 1))
        assert [s[i:] for i in tree.order] == sorted(s[i:] for i in range(n + 1))
        i, j = np.triu_indices(n, 1)
        got = tree.lce(i, j) if len(i) else np.empty(0)
        for a, b, x in zip(i.tolist(), j.tolist(), got.tolist()):
            k = 0
            while b + k < n and s[a + k] == s[b + k]:
                k += 1
            assert x == k


def test_long_documents_of_one_period():
    w = [b"w%d" % i for i in range(700)] * 60
    assert as_runs(runs.find_runs(w)) == [(0, len(w), 700)]
    assert as_runs(runs.find_runs([b"w"] * 50_000)) == [(0, 50_000, 1)]


def test_runs_of_hard_rows(hard, none):
    got = runs.periodic_runs(hard).collect()
    assert Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in got) == Counter(
        (i, len(w := (t or "").encode().split()), tuple(f := as_runs(runs.find_runs(w))), brute_collapse(w, f).decode()) for i, t, _ in HARD)
    assert runs.periodic_runs(none).count() == 0


def test_runs_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in load(spark, SF_SMALL, "documents").collect()}
    rows = QUERIES["op11_periodic_runs"](spark, SF_SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        w = (docs[r.doc_id] or "").encode().split()
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = brute_runs(w) if n < 700 else as_runs(runs.find_runs(w))
        best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None, None, None)
        lines = "".join("%d,%d,%d\n" % x for x in found)
        assert tuple(r)[1:] == (len(found), *best, 1000 * best[1] // best[2] if found else None,
                                hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(brute_collapse(w, found)).hexdigest())


# -- phrases -------------------------------------------------------------------

def brute_phrases(rows, least, top=2000, longest=4):
    count, n, out = {}, Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        c = count.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            c.update(tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    for lang, c in count.items():
        often = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        drop = {p[i:i + k] for p, a in often.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
                if 100 * a >= 80 * c[p[i:i + k]]}
        best = []
        for p, a in often.items():
            if p not in drop:
                score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(best)[:top])]
    return sorted(out)


def mined(df, **options):
    return sorted(tuple(r) for r in phrases.mine_phrases(df, **options).collect())


def test_phrases_equal_brute_force_with_small_tiles(spark, monkeypatch):
    docs = load(spark, SF_SMALL, "documents")
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert mined(docs, min_count=4) == brute_phrases(rows, 4)
    for name, value in {"BLOCK_WORDS": 3000, "FAN": 2, "BUCKET_PAIRS": 2000, "TILE_BITS": 3, "CELL_BITS": 6, "DENSE": 4}.items():
        monkeypatch.setattr(phrases, name, value)
    assert mined(docs, min_count=4, top=50) == brute_phrases(rows, 4, 50)
    assert mined(docs, min_count=4, max_words=3) == brute_phrases(rows, 4, longest=3)


def test_phrases_of_hard_rows_and_ties(spark, hard, none):
    rows = [(r.lang, r.text) for r in hard.collect()]
    assert mined(hard, min_count=2) == brute_phrases(rows, 2)
    assert mined(none, min_count=1) == []
    odd = [("en", "A a a a. a\ta A,a"), (None, "é É b;b b b b b"), (None, None), ("en", "..!?"), ("", "x y x y x y x y"), ("fr", "one")]
    df = spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(odd)], "doc_id long, text string, lang string")
    for least in (1, 2):
        assert mined(df, min_count=least) == brute_phrases(odd, least)


def test_dense_and_sparse_tiles_add_up(monkeypatch):
    rng, total = np.random.default_rng(2), Counter()
    monkeypatch.setattr(phrases, "DENSE", 1 << 14)
    parts = []
    for _ in range(5):
        a, b = (np.minimum(rng.zipf(1.3, 4000), 100_000) for _ in range(2))
        keys, counts = np.unique(phrases.tile_keys(a, b), return_counts=True)
        parts.append((keys, counts.astype(np.int64)))
        total.update(dict(zip(keys.tolist(), counts.tolist())))
        one, two = phrases.pair_of(phrases.tile_keys(a, b))
        assert (one == a).all() and (two == b).all()
    keys, counts = phrases.add_tiles(parts)
    assert (np.diff(keys) > 0).all() and dict(zip(keys.tolist(), counts.tolist())) == total


def test_phrases_query_equals_its_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    assert sorted(tuple(r) for r in QUERIES["op12_phrase_mining"](spark, SF_SMALL).collect()) == sorted(
        con.execute(ORACLE_SQL["op12_phrase_mining"]).fetchall())


def test_numbers_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("v"), F.col("id").alias("x"))
    got = numbered(df, ["k"], [F.col("v").desc(), F.col("x")], "t").collect()
    for k in range(3):
        mine = sorted((r for r in got if r.k == k), key=lambda r: r.id)
        assert [r.id for r in mine] == list(range(len(mine))) and [(-r.v, r.x) for r in mine] == sorted((-r.v, r.x) for r in mine)


# -- passages ------------------------------------------------------------------

def brute_spans(rows, width):
    seen, out = set(), Counter()
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (t or "").encode()
        cover = bytearray(len(b))
        for p in range(len(b) - width + 1):
            s = b[p:p + width]
            if s in seen:
                cover[p:p + width] = b"\1" * width
            seen.add(s)
        spans = tuple((m.start(), m.end()) for m in re.finditer(b"\1+", bytes(cover)))
        out[i, len(b), spans, bytes(x for x, c in zip(b, cover) if not c)] += 1
    return out


def found_spans(df, **options):
    return Counter((r.doc_id, r.n_bytes, tuple(map(tuple, r.spans)), bytes(r.kept)) for r in repeated_spans(df, **options).collect())


@pytest.mark.parametrize("letters,width,gram", [("ab", 10, 4), ("abcdé", 8, 3), ("a", 12, 5)])
def test_spans_equal_brute_force(spark, letters, width, gram):
    rng = random.Random(width)
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 120))) for _ in range(8)]
    rows = [(i * 3, None if rng.random() < 0.05 else "".join(
        rng.choice(base)[rng.randint(0, 30):][:rng.randint(0, 90)] if rng.random() < 0.6 else
        "".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 4)))) for i in range(60)]
    rng.shuffle(rows)
    df, expect = spark.createDataFrame(rows, "doc_id long, text string"), brute_spans(rows, width)
    assert found_spans(df, width=width, gram=gram) == expect
    # crowded anchors, several cells and shards
    assert found_spans(df, width=width, gram=gram, hot=3, cell=4, shard=2) == expect


def test_long_texts_are_cut_into_chunks_without_loss(spark, monkeypatch):
    monkeypatch.setattr(bwt_dedup, "CHUNK_BITS", 9)
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("abc") for _ in range(rng.randint(0, 2000)))) for i in range(30)]
    rows += [(100 + i, rows[i][1][300:] + "x" + rows[i + 1][1]) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    with np.errstate(over="ignore"):
        cuts = bwt_dedup._context_rows(30, 10)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array([t.encode() for _, t in rows], pa.binary())], names=["ord", "t"])
    windows = Counter()
    for b in cuts(iter([batch])):
        for c, at in zip(b.column("ctx").to_pylist(), b.column("at").to_pylist()):
            m = -c if c < 0 else (c >> bwt_dedup.SPAN_BITS) & ((1 << bwt_dedup.SPAN_BITS) - 1)
            windows.update((at >> bwt_dedup.OFFSET_BITS, (at & ((1 << bwt_dedup.OFFSET_BITS) - 1)) + j) for j in range(m))
    assert windows == Counter((k, p) for k, (_, t) in enumerate(rows) for p in range(max(0, len(t) - 29)))
    assert found_spans(df, width=30, gram=10) == brute_spans(rows, 30)


def test_merged_transforms_are_the_transform_of_all():
    rng = np.random.default_rng(4)
    strings = [np.append(rng.integers(1, 4, n), 0).astype(np.uint16) for n in rng.integers(1, 40, 30)]
    depth, shards, kept = 6, [], []
    for k in range(3):
        mine = strings[k::3]
        size = np.array([len(s) for s in mine])
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        signs, begin, length = np.concatenate(mine), np.repeat(starts, size), np.repeat(size, size)
        order = shard_order(signs, begin, length, depth)
        place = order - begin[order]
        shards.append(signs[begin[order] + (place - 1) % length[order]])
        turned = [np.resize(np.roll(mine[x], -p), depth).tolist() for x, p in zip(np.repeat(np.arange(len(mine)), size)[order], place)]
        assert turned == sorted(turned)
        kept.append(iter(turned))
    shard, found = merge_transforms(shards, (2, depth))
    merged = [next(kept[s]) for s in shard]
    assert merged == sorted(merged)
    for h, interval in found.items():
        heads = [tuple(x[:h]) for x in merged]
        assert [i for i, _ in sorted({h_: i for i, h_ in zip(interval.tolist(), heads)}.items())] == sorted(set(heads))
        assert all((a == b) == (x == y) for a, b, x, y in zip(interval, interval[1:], heads, heads[1:]))


def test_passages_of_hard_rows(hard, none):
    # equal ids: which of the rows comes first is open, so they are compared as a group
    got, expect = found_spans(hard), brute_spans([(i, t) for i, t, _ in HARD], 100)
    single = {i for i, k in Counter(i for i, _, _ in HARD).items() if k == 1}
    assert {k: v for k, v in got.items() if k[0] in single} == {k: v for k, v in expect.items() if k[0] in single}
    assert sum(got.values()) == len(HARD) and repeated_spans(none).count() == 0
    assert [k[2] for k in got if k[0] == 9] == [((0, len(HARD[8][1].encode())),)]


def test_passages_query_equals_its_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    assert sorted(tuple(r) for r in QUERIES["op13_suffix_dedup"](spark, SF_SMALL).collect()) == sorted(
        con.execute(ORACLE_SQL["op13_suffix_dedup"]).fetchall())
