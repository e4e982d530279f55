import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from driftline.llm import bitplanes, packing, sharding, tokens
from driftline.llm.mixing import mix, mix_rows
from driftline.llm.sharding import shard_documents, write_shards
from tests.llm.conftest import HARD

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def ids_of(path, texts, end):
    t = Tokenizer.from_file(path)
    return [np.array(e.ids + [end], "<u4") for e in t.encode_batch(list(texts), add_special_tokens=False)]


# -- tokens ------------------------------------------------------------------

@pytest.mark.parametrize("path,word", [(BYTE, False), (WORD, True)])
def test_pieces_give_the_ids_of_the_whole_text(path, word):
    rng = np.random.default_rng(2)
    letters = list(" \n\t ab'1.é́\x1c\x85 <|xİΣ日-")
    texts = ["", "  ", "\n\n a  b\n\nc \t d", "don't 'tis it's'll", "<|endoftext|> a", "b<|ENDOFTEXT|>c", "İ- Σ", "x <|startoftext|>y", "x" * 300 + " y"] + [
        t or "" for _, t, _ in HARD if t is None or len(t) < 1000] + [
        "".join(rng.choice(letters, rng.integers(0, 50))) for _ in range(100_000)]
    expect = [x[:-1].tobytes() for x in ids_of(path, texts, 0)]
    enc = tokens.encoder(path, word)
    assert enc.encode(texts) == expect and enc.encode(texts) == expect


# -- packing -----------------------------------------------------------------

def test_best_fit_fills_the_tightest_bin():
    bins, offsets, free = packing.best_fit([6, 4, 3, 7, 2, 1, 7], 10)
    used = defaultdict(int)
    for b, n in zip(bins, [6, 4, 3, 7, 2, 1, 7]):
        used[b] += n
    assert len(free) == 3 and sorted(used.values()) == [10, 10, 10] and free == [0, 0, 0]


def check_places(rows, capacity):
    at = defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
    for parts in at.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(at)


def test_hard_rows_are_packed_whole(hard, none):
    rows = packing.pack_documents(hard, WORD).collect()
    expect = []
    for (i, _, _), x in zip(HARD, ids_of(WORD, [t or "" for _, t, _ in HARD], 1)):
        for k, a in enumerate(range(0, len(x), 4096)):
            expect.append((i, k, a, len(x[a:a + 4096]), zlib.crc32(x[a:a + 4096].tobytes())))
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=repr) == sorted(expect, key=repr)
    n = check_places(rows, 4096)
    assert n <= -(-sum(r.length for r in rows) // 4096) + 1
    assert packing.pack_documents(none, WORD).count() == 0


@pytest.mark.parametrize("task_items", [200_000, 40])
def test_rounds_come_near_the_lower_bound(spark, task_items):
    rng = np.random.default_rng(4)
    lengths = np.minimum(rng.geometric(1 / 60, 3000), 1000)
    items = spark.createDataFrame([(k, int(n)) for k, n in enumerate(lengths)], "item long, length long").repartition(16)
    rows = packing.pack_items(items, 1000, slack=4, fan_in=4, task_items=task_items).join(items, "item").collect()
    assert len(rows) == 3000
    assert check_places(rows, 1000) <= -(-lengths.sum() // 1000) * 1.02 + 2


# -- token-id files ----------------------------------------------------------

@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    rng = np.random.default_rng(5)
    for n in (0, 1, 7, 8, 100, 1000):
        for high in (1, 2, 300, 70_000, 2 ** 32):
            ids = rng.integers(0, high, n, dtype=np.uint64).astype("<u4")
            planes, lengths = bitplanes.pack_ids(ids, bits, block=64)
            assert np.array_equal(bitplanes.unpack_ids(planes, lengths, n, bits, block=64), ids)


def test_checksums_combine():
    rng = np.random.default_rng(6)
    for n in (0, 1, 5, 1000, 70_001):
        a, b = rng.bytes(37), rng.bytes(n)
        assert bitplanes.crc_combine(zlib.crc32(a), zlib.crc32(b), n) == zlib.crc32(a + b)


@pytest.mark.parametrize("bits,chunk_ids", [(False, 1 << 20), (True, 500)])
def test_files_give_the_documents_back(frame, bits, chunk_ids):
    rows = [x for x in HARD if x[0] is not None and x[0] != 12]
    order = sorted(rows, key=lambda x: x[0])
    ids = ids_of(BYTE, [t or "" for _, t, _ in order], 2)
    start, expect = 0, []
    for (i, _, _), x in zip(order, ids):
        expect.append((i, start, len(x), zlib.crc32(x.tobytes())))
        start += len(x)
    got = bitplanes.roundtrip(frame(rows), BYTE, bits=bits, files=4, chunk_ids=chunk_ids).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == expect


def test_null_and_repeated_ids_in_files(hard, none):
    got = bitplanes.roundtrip(hard, BYTE, files=3).collect()
    expect = Counter((i, len(x), zlib.crc32(x.tobytes())) for (i, _, _), x in
                     zip(HARD, ids_of(BYTE, [t or "" for _, t, _ in HARD], 2)))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expect
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert bitplanes.roundtrip(none, BYTE, files=2).count() == 0


# -- sharding ----------------------------------------------------------------

def brute_shards(sizes, keys, limit):
    out = {}

    def split(rows, depth):
        if sum(sizes[r] for r in rows) <= limit or len(rows) <= 1:
            for r in rows:
                out[r] = (keys[r][:depth], sum(sizes[x] for x in rows), len(rows))
            return
        for bit in "01":
            split([r for r in rows if keys[r][depth] == bit], depth + 1)
    split(list(range(len(sizes))), 0)
    return out


@pytest.mark.parametrize("limit", [50, 400, 10 ** 9])
def test_shards_equal_recursive_splitting(frame, limit):
    import hashlib
    rng = np.random.default_rng(7)
    rows = [(i, "x" * int(rng.integers(0, 90)), "s") for i in range(300)]
    keys = [bin(int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16))[2:].zfill(60) for i, _, _ in rows]
    expect = brute_shards([len(t) for _, t, _ in rows], keys, limit)
    got = {r.doc_id: (r.shard, r.shard_bytes, r.shard_docs) for r in shard_documents(frame(rows), limit).collect()}
    assert got == {rows[k][0]: v for k, v in expect.items()}


def test_shards_of_hard_rows_and_one_hot_id(hard, none, frame):
    assert shard_documents(none).count() == 0
    assert shard_documents(hard, 100).count() == len(HARD)
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, "y" * 10, "s") for i in range(300)]
    got = shard_documents(frame(rows), 100).collect()
    assert len(got) == 300 and max(r.shard_bytes for r in got) <= 100
    total = Counter()
    for r in got:
        total[r.shard] += r.n_bytes
    assert all(total[r.shard] == r.shard_bytes for r in got)


def test_written_shards_hold_every_row_once(spark, hard, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "RANK_BLOCK", 8)
    hot = frame([(None if i % 3 == 0 else 5 if i % 3 == 1 else i, "y" * (10 + i % 2), "s") for i in range(300)])
    for k, docs in enumerate((hard, hot)):
        placed = shard_documents(docs, 100)
        folder = write_shards(docs, placed, f"{tmp_path}/{k}")
        schema = T.StructType([*docs.schema.fields, T.StructField(folder, T.StringType())])
        got = [(*r[:-1], r[-1]) for r in spark.read.schema(schema).parquet(f"{tmp_path}/{k}").collect()]
        assert Counter(tuple(r)[:-1] for r in got) == Counter(tuple(r) for r in docs.collect())
        text = docs.columns.index("text")
        size, rows = Counter(), Counter(r[-1] for r in got)
        for r in got:
            size[r[-1]] += len((r[text] or "").encode())
        assert all(rows[r.shard] == r.shard_docs and size[r.shard] == r.shard_bytes for r in placed.collect())
        assert all(n <= 100 or rows[s] == 1 for s, n in size.items())


# -- mixing ------------------------------------------------------------------

def brute_targets(size, weights=(3, 1, 2)):
    names = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    full = set()
    while True:
        pool = 1.5 * sum(size.values()) - sum(2 * size[s] for s in full)
        rest = sum(w[s] for s in names if s not in full)
        t = {s: 2.0 * size[s] if s in full else pool * w[s] / rest for s in names}
        more = {s for s in names if s not in full and t[s] >= 2 * size[s]}
        if not more or full | more == set(names):
            return {s: min(t[s], 2.0 * size[s]) for s in names}
        full |= more


@pytest.mark.parametrize("part_docs", [20_000, 7])
def test_mix_meets_targets(frame, part_docs):
    rng = np.random.default_rng(8)
    # one source holds a third of all rows, many of one size
    rows = [(i, " ".join("w" * int(n) for n in rng.integers(1, 4, 12 if i % 3 == 0 and i % 2 else rng.integers(1, 60))),
             "hot" if i % 3 == 0 else None if i % 11 == 0 else f"s{i % 5}\U0001F600" if i % 2 else f"s{i % 5}￮")
            for i in range(900)]
    df = frame(rows)
    got = mix_rows(df, part_docs=part_docs).collect()
    assert len(got) == 900
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(t.split())
    expect, taken = brute_targets(size), defaultdict(int)
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - expect[r.source]) < 1e-6
        assert r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
    for s, t in expect.items():
        assert abs(taken[s] - t) <= 2, (s, taken[s], t)
    again = mix_rows(df.repartition(7), part_docs=part_docs).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_mix_of_hard_rows(hard, none):
    rows = mix_rows(hard).collect()
    assert len(rows) == len(HARD)
    assert sorted(r.size for r in rows) == sorted(len((t or "").encode().split()) for _, t, _ in HARD)
    out = mix(hard)
    assert out.columns == hard.columns
    assert out.count() == sum(r.copies for r in rows)
    assert mix_rows(none).count() == 0 and mix(none).count() == 0
