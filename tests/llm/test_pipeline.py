from collections import Counter, defaultdict

import public_tokenizers

import corpus_pipeline as cp
from driftline.llm import toxicity
from driftline.llm.common import load, stored
from driftline.llm.mixing import mix_rows
from tests.conftest import SF_SMALL
from tests.llm.test_dedup import brute_fingerprint, brute_groups, norm
from tests.llm.test_layout import check_places, ids_of


def test_stages_equal_plain_versions(spark):
    docs, columns = load(spark, SF_SMALL, "documents"), ["doc_id", "text", "lang", "source", "n_chars"]
    names = [n for n, _ in cp.STAGES]
    assert len(names) == 5
    stage = dict(cp.STAGES)

    model = toxicity.toxicity_model(docs, load(spark, SF_SMALL, "labels"))
    clean = stored(stage["toxicity"](spark, docs, SF_SMALL), "t")
    expect = {r.doc_id for r in toxicity.score_documents(docs, model).collect() if not r.predicted}
    rows = {r.doc_id: r for r in clean.collect()}
    assert clean.columns == columns and set(rows) == expect

    distinct = stored(stage["exact dedup"](spark, clean, SF_SMALL), "t")
    groups = defaultdict(list)
    for r in rows.values():
        groups[norm(r.text)].append((-len(r.text), r.doc_id))
    left = {r.doc_id: r for r in distinct.collect()}
    assert distinct.columns == columns and set(left) == {min(g)[1] for g in groups.values()}

    unlike = stored(stage["SimHash near-dedup"](spark, distinct, SF_SMALL), "t")
    ids = sorted(left)
    low = {}
    for i, c in zip(ids, brute_groups([brute_fingerprint(left[i].text) for i in ids], 4)):
        low.setdefault(c, i)
    assert unlike.columns == columns and {r.doc_id for r in unlike.collect()} == set(low.values())

    mixed = stored(stage["mixing sources to target weights"](spark, unlike, SF_SMALL), "t")
    copies = {r.doc_id: r.copies for r in mix_rows(unlike).collect()}
    got = Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == columns and got == Counter({i: n for i, n in copies.items() if n})

    pieces = stage["best-fit packing"](spark, mixed, SF_SMALL).collect()
    sizes = [len(x) for x in ids_of(public_tokenizers.path("word_bpe_49k.json"), [r.text for r in mixed.collect()], 1)]
    assert sum(r.length for r in pieces) == sum(sizes) and len(pieces) == sum(-(-n // 4096) for n in sizes)
    assert check_places(pieces, 4096) <= -(-sum(sizes) // 4096) + 2


def test_stages_take_hard_rows_and_nothing(spark, hard, none):
    for docs in (hard, none):
        columns = docs.columns
        for _, stage in cp.STAGES[:-1]:
            docs = stored(stage(spark, docs, SF_SMALL), "t")
            assert docs.columns == columns
        last = cp.STAGES[-1][1](spark, docs, SF_SMALL)
        assert {"doc_id", "piece", "sequence_id"} <= set(last.columns)
        assert last.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
