import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from driftline.llm import simhash
from driftline.llm.common import components
from driftline.llm.exact_dedup import exact_dedup, exact_groups
from tests.llm.conftest import HARD


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", "", t or "")


# -- exact -------------------------------------------------------------------

def brute_exact(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[norm(t)].append((len(t or ""), i))
    out = []
    for i, t, _ in rows:
        g = groups[norm(t)]
        best = min(g, key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out.append((i, best[1], len(g), hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"hash_bits": 2, "bucket_entries": 2}])
def test_exact_groups_equal_brute_force(hard, options):
    got = exact_groups(hard, **options).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == brute_exact(HARD)
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1}                    # one row of every group, repeated rows included


def test_exact_dedup_keeps_one_row_of_each_text_with_all_columns(hard):
    out = exact_dedup(hard)
    assert out.columns == hard.columns
    texts = [norm(r.text) for r in out.collect()]
    assert sorted(texts) == sorted({norm(t) for _, t, _ in HARD})


def test_exact_dedup_of_nothing(none):
    assert exact_groups(none).count() == 0 and exact_dedup(none).count() == 0


def test_colliding_hashes_stay_apart_in_the_index(frame):
    rows = [(i, f"text number {i // 2}", "s") for i in range(400)]
    got = exact_groups(frame(rows), hash_bits=1, bucket_entries=16).collect()
    assert {r.group_size for r in got} == {2} and len({r.keep_id for r in got}) == 200


# -- near --------------------------------------------------------------------

def brute_fingerprint(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    parts = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(prints, bits):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_equal_brute_force():
    rng = random.Random(1)
    texts = ["", " \n", "A", "A b", "Ä B c D", "a b c d e f", " ".join(rng.choice("abcdef") for _ in range(20_000))]
    for t in texts + [HARD[7][1]]:
        assert simhash.fingerprint(t.encode()) & (2 ** 64 - 1) == brute_fingerprint(t)


def test_hard_rows_have_defined_groups(hard):
    got = simhash.near_groups(hard).collect()
    prints = sorted(brute_fingerprint(t) for _, t, _ in HARD)
    assert sorted(int(r.fingerprint, 16) for r in got) == prints
    comp = brute_groups(prints, 4)
    low = {}
    for p, c in zip(prints, comp):
        for i, t, _ in HARD:
            if brute_fingerprint(t) == p and i is not None:
                low[c] = min(low.get(c, i), i)
    expect = {p: low.get(c) for p, c in zip(prints, comp)}
    assert all(r.component_id == expect[int(r.fingerprint, 16)] for r in got)


def test_near_dedup_leaves_one_row_of_each_group(hard, none):
    out = simhash.near_dedup(hard)
    assert out.columns == hard.columns
    prints = sorted({brute_fingerprint(t) for _, t, _ in HARD})
    assert out.count() == len(set(brute_groups(prints, 4)))
    assert simhash.near_dedup(none).count() == 0


@pytest.mark.parametrize("blocks,bits", [(3, 4), (2, 3), (4, 3)])
def test_every_value_reaches_the_home_of_its_neighbours(blocks, bits):
    reach, rng = bits // blocks, np.random.default_rng(0)
    for _, width in simhash.spans(blocks):
        code = simhash.Covering(width, 1 + reach)
        for x in rng.integers(0, 1 << width, 50):
            flips = code.flips[int(code.syndrome(np.array([x]))[0])]
            home = int(x) ^ int(flips[0])
            assert int(flips[0]).bit_count() <= 1 and code.syndrome(np.array([home]))[0] == 0
            y = int(x)
            for i in rng.choice(width, reach, replace=False):
                y ^= 1 << int(i)
            assert home in (y ^ code.flips[int(code.syndrome(np.array([y]))[0])]).tolist()


@pytest.mark.parametrize("part_rows", [4096, 8])
def test_links_give_the_components_of_all_close_pairs(spark, part_rows):
    """Random fingerprints, chains and one dense ball; ``part_rows`` 8 deals crowded anchors out."""
    rng = random.Random(3)
    prints = set()
    for _ in range(150):
        prints.add(rng.getrandbits(64))
    seed = rng.getrandbits(64)
    for _ in range(120):
        prints.add(seed ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    chain = rng.getrandbits(64)
    for _ in range(40):
        for _ in range(4):
            chain ^= 1 << rng.randrange(64)
        prints.add(chain)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(5)
    got = {r.node: r.root for r in components(simhash.near_links(nodes, part_rows=part_rows)).collect()}
    expect = defaultdict(set)
    for p, c in zip(signed, brute_groups(prints, 4)):
        expect[c].add(p)
    found = defaultdict(set)
    for p in signed:
        found[got.get(p, p)].add(p)
    assert sorted(map(sorted, expect.values())) == sorted(map(sorted, found.values()))
    assert all(min(g) == r for r, g in found.items())


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(201)} == {0} and {got[1000 + i] for i in range(80)} == {1000}
