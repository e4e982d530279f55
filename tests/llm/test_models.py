import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from driftline.llm import gru_lm, quality_cnn, quality_rules, toxicity
from driftline.llm.common import load
from tests.conftest import SF_SMALL
from tests.llm.conftest import HARD

BIG = "/root/testdata/sf0.01"


def accuracy(rows, labels, column="predicted"):
    hits = [int(getattr(r, column)) == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    return sum(hits) / len(hits)


def unspaced(letters, sizes, n, seed):
    """Rows of 40 words without spaces between them; every other one holds one of eight insults."""
    rng, fixed = np.random.default_rng(seed), np.random.default_rng(99)
    low, high = sizes
    words = ["".join(fixed.choice(letters, fixed.integers(low, high + 1))) for _ in range(600)]
    insults = ["".join(fixed.choice(letters, high)) for _ in range(8)]
    out = []
    for i in range(n):
        row = rng.choice(words, 40).tolist()
        if i % 2:
            row[rng.integers(40)] = insults[rng.integers(8)]
        out.append(("".join(row), i % 2))
    return out


@pytest.mark.parametrize("first,count,sizes", [(ord("a"), 26, (4, 9)), (0x3042, 82, (3, 7)), (0x4E00, 900, (2, 4))])
def test_insults_in_text_without_spaces(first, count, sizes):
    letters = [chr(first + i) for i in range(count)]
    model = toxicity.train(unspaced(letters, sizes, 800, 1))
    rows = unspaced(letters, sizes, 600, 2)
    score, y = toxicity.score_texts([t for t, _ in rows], model), np.array([k for _, k in rows])
    # (Han letters share symbols, so some clean rows hold lookalikes of an insult of four letters)
    assert (score[y == 1] >= 0.7).mean() >= 0.9 and (score[y == 0] >= 0.7).mean() <= 0.15


def test_spans_cover_long_strings_and_leave_others():
    texts = ["short words stay", "x" * 24 + " " + "abcdefghijklmnopqrstuvwxyz", "", "y" * 1000, "end"]
    plain, start = toxicity.fold_words(texts)
    sym, begin = toxicity.fold(texts)
    for k in range(len(texts)):
        before = plain[start[k]:start[k + 1]].tobytes().split(b"\0")
        after = sym[begin[k]:begin[k + 1]].tobytes().split(b"\0")
        expect = []
        for w in before:
            if len(w) <= toxicity.LONG:
                expect.append(w)
            else:
                last = len(w) - toxicity.SPAN
                expect += [w[i:i + toxicity.SPAN] for i in [*range(0, last, toxicity.STRIDE), last]]
        assert after == expect


@pytest.fixture(scope="module")
def labelled(spark):
    return {c: {r.doc_id: r[c] for r in load(spark, BIG, "labels").collect()} for c in ("quality", "toxic")}


# -- quality network ---------------------------------------------------------

def test_chunks_cover_every_byte():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        text = bytes(np.random.default_rng(n).integers(1, 256, n, dtype=np.uint8))
        c = quality_cnn.chunks(text)
        flat = bytearray((len(c) - 1) * quality_cnn.HOP + quality_cnn.CHUNK)
        for k, row in enumerate(c):
            flat[k * quality_cnn.HOP:k * quality_cnn.HOP + quality_cnn.CHUNK] = bytes(row)
        assert bytes(flat[:n]) == text and not any(flat[n:])


def test_filters_meet_every_byte_at_every_offset():
    rng = np.random.default_rng(6)
    p = quality_cnn._start(rng)
    tables = quality_cnn.fold_tables(p)
    for n in (512, 960, 1408):                                  # texts that fill their last chunk
        text = bytes(rng.integers(1, 256, n, dtype=np.uint8))
        other = text[:-1] + bytes([text[-1] ^ 1])
        a, b = (quality_cnn.responses(quality_cnn.chunks(t), tables, p["bias"]) for t in (text, other))
        assert not np.allclose(a[-1], b[-1])
    for n in (700, 3000, 20_000):
        text = bytes(rng.integers(1, 256, n, dtype=np.uint8))
        a, b = (quality_cnn.document_vectors([t], tables, p["bias"])[0, quality_cnn.FILTERS:] for t in (text, b"x" + text))
        assert np.isclose(a, b, atol=1e-5).mean() > 0.9


def test_network_gradients():
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in quality_cnn._start(rng).items()}
    block, owner = rng.integers(0, 256, (5, quality_cnn.CHUNK)).astype(np.uint8), np.array([0, 0, 1, 2, 2])
    y = np.array([0.0, 1.0, 1.0])
    _, g = quality_cnn.gradients(p, block, owner, y, np.ones(3))
    for k in p:
        big = np.argsort(-np.abs(g[k]).ravel())[:3]
        for at in big:
            i, eps, loss = np.unravel_index(at, p[k].shape), 1e-3, []
            for sign in (1, -1):
                q = {a: x.copy() for a, x in p.items()}
                q[k][i] += sign * eps
                loss.append(quality_cnn.gradients(q, block, owner, y, np.ones(3))[0])
            assert (loss[0] - loss[1]) / (2 * eps) == pytest.approx(g[k][i], rel=0.05, abs=2e-4)


def test_blocks_do_not_change_vectors():
    rng = np.random.default_rng(2)
    p = quality_cnn._start(rng)
    tables = quality_cnn.fold_tables(p)
    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 10, 200_000, 3000, 5)]
    together = quality_cnn.document_vectors(texts, tables, p["bias"])
    for t, v in zip(texts, together):
        r = np.maximum(quality_cnn.responses(quality_cnn.chunks(t), tables, p["bias"]).max(axis=1), 0)
        assert np.allclose(v, np.concatenate([r.mean(axis=0), r.max(axis=0)]), atol=1e-5)


def test_network_on_held_out_rows(spark, hard, none, labelled):
    docs = load(spark, BIG, "documents")
    model = quality_cnn.quality_model(docs, load(spark, BIG, "labels"))
    rows = quality_cnn.score_quality(docs, model).collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert accuracy(rows, labelled["quality"]) > 0.9
    got = quality_cnn.score_quality(hard, model).collect()
    assert len(got) == len(HARD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert quality_cnn.score_quality(none, model).count() == 0


def test_models_without_labels(spark, hard, none):
    labels = load(spark, SF_SMALL, "labels").limit(0)
    for module, model, rows in ((quality_cnn, quality_cnn.quality_model(none, labels), None),
                                (toxicity, toxicity.toxicity_model(hard, labels), None)):
        assert model == {"constant": 0.5}
    assert {r.score for r in toxicity.score_documents(hard, {"constant": 0.5}).collect()} == {0.5}
    assert {r.quality for r in quality_rules.apply_rules(hard, quality_rules.rules_model(hard, labels)).collect()} == {1.0}


# -- quality rules -----------------------------------------------------------

def brute_facts(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i:i + 8])] > 1:
            inside.update(range(i, i + 8))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside)


def test_base_facts_equal_brute_force():
    rng = np.random.default_rng(3)
    texts = [t or "" for _, t, _ in HARD] + ["a b  c\n\na b  c\n ", "a b c d e f g h " * 5, "é| é#\nq\n \nq\r\nq"] + [
        "".join(rng.choice(list("ab \n|#é\x85"), rng.integers(0, 200))) for _ in range(300)]
    for t in texts:
        raw = t.encode()
        assert quality_rules.base_facts(raw, quality_rules.word_hashes(raw)) == brute_facts(t)


def test_hashing_in_parts(monkeypatch):
    raw = HARD[7][1].encode()
    whole = quality_rules.word_hashes(raw)
    monkeypatch.setattr(quality_rules, "PART_BYTES", 1000)
    assert np.array_equal(quality_rules.word_hashes(raw), whole) and len(whole) == len(raw.split())


def test_rules_on_labelled_rows(spark, hard, none, labelled):
    docs = load(spark, BIG, "documents")
    model = quality_rules.rules_model(docs, load(spark, BIG, "labels"))
    rows = quality_rules.apply_rules(docs, model).collect()
    q = labelled["quality"]
    held = [r for r in rows if r.doc_id in q and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    judged = [r for r in held if not r.base_failed]
    assert len(rows) == 1000 and sum((r.quality >= 0.5) == q[r.doc_id] for r in judged) / len(judged) > 0.9
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows[::20]:
        facts = brute_facts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == facts
        assert r.base_failed == (facts[0] < 20 or 100 * facts[4] > 30 * facts[0])
        assert r.kept == (not r.base_failed and r.quality >= 0.5)
    got = quality_rules.apply_rules(hard, model).collect()
    assert len(got) == len(HARD) and not any(r.kept for r in got if r.n_words < 20)
    assert quality_rules.apply_rules(none, model).count() == 0


# -- toxicity ----------------------------------------------------------------

@pytest.fixture(scope="module")
def insults():
    """A model from sentences of made-up words, some with one of three insults."""
    rng = np.random.default_rng(9)
    syllables = "ba ce di fo gu ha je ki lo mu na pe ri so tu".split()

    def sentence():
        return " ".join("".join(rng.choice(syllables, rng.integers(2, 5))) for _ in range(rng.integers(20, 60)))
    rows = []
    for k in range(600):
        words = sentence().split()
        if k % 3 == 0:
            words.insert(int(rng.integers(len(words))), ["grumblok", "snarfwit", "dungplox"][k // 3 % 3])
        rows.append((" ".join(words), int(k % 3 == 0)))
    return toxicity.train(rows), sentence


def test_gapped_and_inserted_characters(insults):
    model, sentence = insults
    clean = [sentence() for _ in range(60)]
    assert (toxicity.score_texts(clean, model) < 0.7).mean() > 0.95
    for bad in ("grumblok", "GRUMBLOK!", "g.r.u.m.b.l.o.k", "g r u m b l o k", "grum-blok", "grumb1ok".replace("1", "l"),
                "snarfwit", "snarfxwit", "dungpl0x", "dungplóx"):
        assert toxicity.score_texts([f"{sentence()} {bad} {sentence()}"], model)[0] >= 0.7, bad


def test_insults_in_some_clean_rows():
    """A tenth of the insults' rows are labelled clean: the insults are still learnt."""
    rng = np.random.default_rng(21)
    syllables = "ba ce di fo gu ha je ki lo mu na pe ri so tu".split()
    bad = ["grumblok", "snarfwit", "dungplox"]

    def sentence():
        return " ".join("".join(rng.choice(syllables, rng.integers(2, 5))) for _ in range(rng.integers(20, 60)))
    rows = [(f"{sentence()} {bad[k // 3 % 3]} {sentence()}" if k % 3 == 0 else f"{sentence()} {sentence()}",
             int(k % 3 == 0 and k % 10 != 0)) for k in range(900)]
    model = toxicity.train(rows)
    assert all(toxicity.score_texts([f"{sentence()} {b} {sentence()}"], model)[0] >= 0.7 for b in bad)
    assert (toxicity.score_texts([sentence() for _ in range(60)], model) < 0.7).mean() > 0.95


def test_folding_joins_letters_and_keeps_texts_apart():
    sym, start = toxicity.fold(["a b c", "d e", "", "f"])
    words = [bytes(x) for x in sym.tobytes().split(b"\0") if x]
    assert words == [bytes([1, 2, 3]), bytes([4, 5]), bytes([6])] and len(start) == 5


def test_folding_of_all_scripts():
    def words(t):
        return [x for x in toxicity.fold([t])[0].tobytes().split(b"\0") if x]
    for t in ("i\u0301di\u200bo\ufefft", "\uff29\uff24\uff29\uff2f\uff34", "idi\u2014ot\U0001F600", "\u00eddi\u00f6t", "idiot\ufe0f"):
        assert words(t) == words("idiot"), t
    assert words("ab\u2003cd\u3000ef") == words("ab cd ef") and words("ΛΟΓΟΣ") == words("λόγος") and words("ЁЖИК") == words("ежик")
    # words of other scripts share no more features than words of a-z
    for alphabet in ("абвгдежзиклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"):    # without й: и and an accent
        assert len(set(toxicity.fold([alphabet])[0].tolist())) == len(alphabet) + 1
        rng = np.random.default_rng(3)
        k = toxicity._kernel(*[[words("".join(rng.choice(list(alphabet), 7)))[0] for _ in range(30)]] * 2)
        assert np.abs(k - np.diag(np.diag(k))).max() < 0.6 and np.diag(k).min() > 0.9
    assert words("日本語") != words("中国人") and len(words("कि की")) == 2 and words("कि") != words("की")


@pytest.mark.parametrize("alphabet, bad", [("абвгдежзиклмнопрстуфхцчшыюя", ["щурбэльок", "бэщиндур"]),
                                           ("αβγδεζηθικλμνοπρστυφχω", ["ξαψορβιξ", "ψιλξεδρον"]),
                                           ("ابتثجحخدرزسشصعفقكلمنهوي", ["ضغطذظرب", "ظذغبضمل"])])
def test_insults_in_other_scripts(alphabet, bad):
    rng = np.random.default_rng(12)
    known = ["".join(rng.choice(list(alphabet), rng.integers(3, 9))) for _ in range(300)]

    def sentence():
        return " ".join(rng.choice(known, 30))
    model = toxicity.train([(sentence() + (f" {bad[k // 3 % 2]} " if k % 3 == 0 else " ") + sentence(), int(k % 3 == 0))
                            for k in range(240)])
    assert (toxicity.score_texts([sentence() for _ in range(60)], model) < 0.7).mean() > 0.95
    assert all(toxicity.score_texts([f"{sentence()} {b} {sentence()}"], model)[0] >= 0.7 for b in bad)


def test_table_equals_the_kernel(insults):
    """The collapsed table gives the landmark machine's value: the kernel is linear in explicit features."""
    model, _ = insults
    strings, _ = toxicity._strings(["grumblok bacedi lo snarfwit"])
    for w in strings:
        vec = toxicity._explicit([w])[0]
        expect = sum(model["table"][k] * v for k, v in vec.items()) + model["bias"]
        sym = np.frombuffer(b"\0" + w + b"\0", np.uint8)
        start, letters = toxicity.spans(sym)
        assert toxicity.string_values(sym, start, letters, model["table"], model["bias"])[0] == pytest.approx(expect, abs=1e-4)


def test_parts_of_long_texts(insults, monkeypatch):
    model, sentence = insults
    texts = [sentence() + " grumblok " + sentence(), "", sentence() * 20, "x" * 5000]
    whole = toxicity.document_facts(texts, model)
    monkeypatch.setattr(toxicity, "BLOCK_CHARS", 300)
    assert np.allclose(toxicity.document_facts(texts, model)[:3], whole[:3])


def test_toxicity_through_spark(spark, insults, hard, none, frame):
    model, sentence = insults
    rows = toxicity.score_documents(hard, model).collect()
    assert len(rows) == len(HARD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert toxicity.score_documents(none, model).count() == 0
    docs = load(spark, BIG, "documents")
    kept = toxicity.drop_toxic(docs, load(spark, BIG, "labels"))
    assert kept.columns == docs.columns and 500 < kept.count() <= 1000
    assert toxicity.drop_toxic(hard, load(spark, BIG, "labels")).columns == hard.columns


# -- language model ----------------------------------------------------------

def small_vocabulary():
    head = {b"w%d" % i: 2000 // (i + 1) + 5 for i in range(300)} | {gru_lm.END: 500}
    return gru_lm.Vocabulary(head, sum(head.values()) + 800, len(head) + 300, vocab=100, classes=8)


def noisy(v, rng):
    return {k: (x + rng.normal(0, 0.1, x.shape)).astype(np.float64) for k, x in gru_lm.start(v).items()}


def test_every_head_word_has_a_symbol():
    head = {b"w%d" % i: 9000 - i for i in range(3000)} | {gru_lm.END: 500}
    v = gru_lm.Vocabulary(head, sum(head.values()) + 800, len(head) + 300)
    assert set(v.number) == set(head) and (v.other_tokens, v.other_words, v.classes) == (800, 300, 54)
    assert all(a < b for a, b in zip(v.first, v.first[1:]))             # no class is without words


def test_lm_gradients():
    v, rng = small_vocabulary(), np.random.default_rng(0)
    p = noisy(v, rng)
    inputs, target = rng.integers(0, v.size + 2, (6, 7)), rng.integers(0, v.size + 1, (6, 7))
    _, g = gru_lm.gradients(p, v, inputs, target)
    for k in p:
        for at in np.argsort(-np.abs(g[k]).ravel())[:4]:
            i, loss = np.unravel_index(at, p[k].shape), []
            for sign in (1, -1):
                q = {a: x.copy() for a, x in p.items()}
                q[k][i] += sign * 1e-4
                loss.append(gru_lm.gradients(q, v, inputs, target)[0])
            assert (loss[0] - loss[1]) / 2e-4 == pytest.approx(g[k][i], rel=1e-3)


def test_every_token_is_a_target_once_a_pass(spark, frame):
    v, rng = small_vocabulary(), np.random.default_rng(4)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 400, n)).encode() for n in [0, 1, 3, 31, 32, 33, 64, 700, 90_000, 5] * 3]
    expect = Counter(i for t in texts for i in gru_lm.numbers(v, gru_lm.words_of(t)).tolist())
    for share in (texts, texts[:3], []):
        batches = list(gru_lm.training_batches(share, v))
        targets = np.concatenate([b[1].ravel() for b in batches]) if batches else np.zeros(0, int)
        inputs = np.concatenate([b[0].ravel() for b in batches]) if batches else np.zeros(0, int)
        assert Counter(targets[targets >= 0].tolist()) == (expect if share is texts else Counter(
            i for t in share for i in gru_lm.numbers(v, gru_lm.words_of(t)).tolist()))
        assert (inputs[targets >= 0] == v.size + 1).sum() == len(share)                # each text begins anew
        assert share is not texts or min(len(b[1]) for b in batches) >= gru_lm.LANES // 2
    # the share of `every` is one of the token stream, and turns take different windows
    halves = [sum(int((b[1] >= 0).sum()) for b in gru_lm.training_batches(texts, v, turn, 2)) for turn in (0, 1)]
    assert sum(halves) == sum(expect.values()) and abs(halves[0] - halves[1]) <= gru_lm.WINDOW
    # a corpus of texts under one window trains the model
    docs = frame([(i, " ".join(f"w{k % 7}" for k in range(i % 9)), "s") for i in range(200)])
    words = gru_lm.vocabulary(gru_lm.word_counts(docs), 50, 4)
    trained, begun = gru_lm.train(docs, words), gru_lm.start(words)
    assert all(not np.allclose(trained[k], begun[k]) for k in ("embed", "wx", "wh", "class_w"))


def test_steps_without_a_target_train_nothing():
    v, rng = small_vocabulary(), np.random.default_rng(5)
    p = noisy(v, rng)
    inputs, target = rng.integers(0, v.size + 1, (3, 7)), rng.integers(0, v.size + 1, (3, 7))
    begins, masked = np.concatenate([inputs, np.full((3, 2), v.size + 1)], 1), np.concatenate([target, np.full((3, 2), -1)], 1)
    plain, padded = gru_lm.gradients(p, v, inputs, target), gru_lm.gradients(p, v, begins, masked)
    assert plain[0] == pytest.approx(padded[0]) and all(np.allclose(plain[1][k], padded[1][k]) for k in p)


def test_lanes_equal_one_document_at_a_time():
    v, rng = small_vocabulary(), np.random.default_rng(1)
    p = noisy(v, rng)
    docs = [rng.integers(0, v.size + 1, rng.integers(1, 90)).astype(np.int32) for _ in range(40)]

    def alone(d):
        s, total, before = np.zeros((1, gru_lm.HIDDEN)), 0.0, None
        for w in d:
            gx = p["b"][None] if before is None else p["embed"][before][None] @ p["wx"] + p["b"]
            s, total, before = gru_lm.step(gx, s, p["wh"])[0], total, w
            total += gru_lm.output_log(p, v, s, np.array([w]))[0]
        return total
    assert np.allclose(gru_lm.score_streams(p, v, docs, lanes=7), [alone(d) for d in docs], atol=1e-3)


def test_probabilities_add_up_to_one():
    v, rng = small_vocabulary(), np.random.default_rng(2)
    p, s = noisy(v, rng), rng.normal(size=(1, gru_lm.HIDDEN))
    inner = sum(math.exp(gru_lm.output_log(p, v, s, np.array([w]))[0]) for w in range(v.size + 1))
    assert inner == pytest.approx(1)
    rest = [c for w, c in v.head.items() if w not in v.number]
    left = v.other_tokens - sum(rest)                       # tokens of the words whose counts are not in the head
    shares = sum(math.exp(v.log_other(c)) for c in rest) + (left - gru_lm.DISCOUNT * (v.other_words - len(rest))) / v.other_tokens
    assert shares + math.exp(v.log_other(0)) == pytest.approx(1)


def brute_lm(rows):
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, d = sum(c.values()), len(c)
    return n, [(i, h, len(ws), sum(c[w] > 0 for w in ws), sum(math.log10((c[w] + 1) / (n + d + 1)) for w in ws))
               for (i, _), ws, h in zip(rows, tokens, held)]


def test_lm_counts_and_base_equal_brute_force(spark, hard, none):
    for df in (load(spark, SF_SMALL, "documents"), hard):
        got = gru_lm.score_documents(df, vocab=200, classes=16, passes=1, every=2).collect()
        n, expect = brute_lm([(r.doc_id, r.text) for r in df.collect()])
        assert {r.train_tokens for r in got} == {n}
        key = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.base_score) for r in got]
        for a, b in zip(sorted(key, key=repr), sorted(expect, key=repr)):
            assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9)
        assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert gru_lm.score_documents(none).count() == 0


def test_lm_beats_the_base_on_held_out_rows(spark):
    got = gru_lm.score_documents(load(spark, BIG, "documents")).collect()
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_softmaxes_are_worked_out_in_small_pieces(monkeypatch):
    """No array of all states by all classes is made, and pieces of any size give the same."""
    v, rng = small_vocabulary(), np.random.default_rng(5)
    p = {k: x.astype(np.float64) for k, x in noisy(v, rng).items()}
    states, target = rng.uniform(-1, 1, (700, gru_lm.HIDDEN)), rng.integers(0, v.size + 1, 700)
    rows = []
    whole = gru_lm.Softmax.exponentials
    monkeypatch.setattr(gru_lm.Softmax, "exponentials", lambda self, seen, a, b: rows.append(len(seen)) or whole(self, seen, a, b))
    loss, g, back = gru_lm.output_gradients(p, v, states, target)
    monkeypatch.setattr(gru_lm, "CELLS", 1)
    del rows[:]
    loss_, g_, back_ = gru_lm.output_gradients(p, v, states, target)
    assert max(rows) <= 64 and np.isclose(loss, loss_) and np.allclose(back, back_) and all(np.allclose(g[k], g_[k]) for k in g)
    assert np.isclose(loss, -gru_lm.output_log(p, v, states, target).sum())
    large = {k: x + 80.0 if k in ("class_b", "word_b") else x for k, x in p.items()}          # centred: the same chances
    loss_, g_, back_ = gru_lm.output_gradients(large, v, states, target)
    assert np.isclose(loss, loss_) and np.allclose(back, back_) and all(np.allclose(g[k], g_[k]) for k in g)


def test_lm_steps_keep_their_memory():
    """op6: the arrays of a training step are not fetched from the system anew at every step."""
    resource = pytest.importorskip("resource")
    head = {b"w%d" % i: 90_000 // (i + 1) + 5 for i in range(20_000)} | {gru_lm.END: 500}
    v, rng = gru_lm.Vocabulary(head, sum(head.values()) + 800, len(head) + 300), np.random.default_rng(0)
    shape, faults = (gru_lm.LANES, gru_lm.WINDOW), []
    trainer = gru_lm.Trainer(gru_lm.start(v), v)
    gru_lm.keep_memory()
    for _ in range(8):
        x = rng.integers(0, v.size + 1, shape)
        trainer.learn(x, x)
        faults.append(resource.getrusage(resource.RUSAGE_SELF).ru_minflt)
    assert np.median(np.diff(faults)) < 1000            # 3,700 pages before


def test_lm_step_of_lanes_held_by_unit():
    """op6: one step, lanes or units together in memory."""
    rng, h = np.random.default_rng(0), gru_lm.HIDDEN
    gx, s, wh = rng.normal(size=(20, 3 * h)), rng.normal(size=(20, h)), rng.normal(size=(h, 3 * h))
    plain, turned = gru_lm.step(gx, s, wh), gru_lm.step(np.asfortranarray(gx), np.asfortranarray(s), wh)
    assert all(np.allclose(a, b) for a, b in zip(plain, turned)) and all(x.T.flags.c_contiguous for x in turned[:1])


def lm_batches(texts, size):
    """Batches as the tasks get them: texts are bytes, UTF-8 or not."""
    for i in range(0, len(texts), size):
        part = texts[i:i + size]
        ids = pa.array(range(i, i + len(part)), pa.int64())
        yield pa.RecordBatch.from_arrays([ids, ids, pa.array([False] * len(part)), pa.array(part, pa.binary()).view(pa.string())],
                                         names=["row", "doc_id", "held_out", "t"])


def test_lm_texts_are_cut_as_words_of_does():
    """op6: Arrow's kernels fold and cut at the same bytes, in portions of any size."""
    rng = np.random.default_rng(6)
    texts = [b"a" + bytes([c]) + b"B" for c in range(256)] + [b"", b" ", b" \t a  b\n", "\u00c4\u212a\u2003\u0130 \x85x".encode(), b"x" * 999]
    texts += [bytes(rng.choice(np.frombuffer(b"aBz \t\n\x0b\x0c\r\x1c\x1f\xff", np.uint8), rng.integers(0, 60))) for _ in range(300)]
    whole = pa.array(texts, pa.binary()).view(pa.string())
    for most in (1, 40, 10_000_000):
        got, parts = [], list(gru_lm.portions([whole.slice(0, 100), whole.slice(100, 0), whole.slice(100)], most))
        assert len(parts) == (len(texts) if most == 1 else len(parts)) and (most < 1000 or len(parts) == 1)
        for part in parts:
            words, upto = gru_lm.split_words(part)
            got += [x.tolist() for x in np.split(np.array([*words.to_pylist(), None], object)[:-1], upto)[:-1]]
        assert got == [gru_lm.words_of(t) for t in texts]


def test_lm_makes_no_object_of_each_word(monkeypatch):
    """op6: counting, training and scoring cut and look up words in arrays; the same numbers as word by word."""
    v, rng = small_vocabulary(), np.random.default_rng(8)
    texts = [b" ".join(b"W%d" % i for i in rng.integers(0, 400, n)) for n in [0, 1, 3, 40, 700, 5, 0, 90]]
    words = [gru_lm.words_of(t) for t in texts]
    streams = [gru_lm.numbers(v, w) for w in words]
    p = {k: x.astype(np.float32) for k, x in noisy(v, rng).items()}
    model = gru_lm.score_streams(p, v, streams) + [sum(v.log_other(v.head[x]) for x in w if x in v.head and x not in v.number) for w in words]

    def one_by_one(text):
        raise AssertionError("words as objects")
    monkeypatch.setattr(gru_lm, "words_of", one_by_one)
    counts = Counter()
    for b in gru_lm._count(lm_batches(texts, 3)):
        for w, c in zip(b.column("word").to_pylist(), b.column("c").to_pylist()):
            counts[w] += c
    assert counts == Counter(x for w in words for x in [*w, gru_lm.END])
    targets = np.concatenate([b[1].ravel() for b in gru_lm.training_batches(texts, v)])
    assert targets[targets >= 0].tolist() == np.concatenate(streams).tolist()
    monkeypatch.setattr(gru_lm, "SCORE_BYTES", 900)
    monkeypatch.setattr(gru_lm, "PART_BYTES", 200)
    rows = [r for b in gru_lm._score(p, v)(lm_batches(texts, 5)) for r in b.to_pylist()]
    assert [r["row"] for r in rows] == list(range(len(texts))) and [r["n_tokens"] for r in rows] == [len(w) + 1 for w in words]
    assert [{r["word"]: r["tf"] for r in x["rare"]} for x in rows] == [Counter(x for x in w if x not in v.head) for w in words]
    assert [r["n_known"] for r in rows] == [1 + sum(x in v.head for x in w) for w in words]
    assert np.allclose([r["model"] * math.log(10) for r in rows], model, rtol=1e-4)
    base = [sum(math.log10(v.head[x] + 1) for x in [*w, gru_lm.END] if x in v.head) - (len(w) + 1) * v.log_base for w in words]
    assert np.allclose([r["base"] for r in rows], base, rtol=1e-12)


def test_lm_rare_end_token(monkeypatch, frame):
    """op6: in long texts the end token is a rare word itself."""
    monkeypatch.setattr(gru_lm, "HEAD_SHARE", 3)
    docs = [(i, " a  b c" * (20 + i) + " d" * (i % 3), "s") for i in range(30)]
    got = gru_lm.score_documents(frame(docs)).collect()
    n, expect = brute_lm([d[:2] for d in docs])
    for a, b in zip(sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.base_score) for r in got), sorted(expect)):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9)
