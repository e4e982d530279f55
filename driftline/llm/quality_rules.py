"""Quality rules: counted base rules and a hashed n-gram logistic regression.

Base facts come from whole texts: code points in words, symbol characters,
repeated lines and words inside repeated 8-word windows.  The model is a
logistic regression on hashed word 1-2-grams and character 3-5-grams (relative
frequencies), trained on a bounded sample of the labelled rows that are not
held out, then calibrated on the rows of the sample it did not train on.  Its
weights are one table for each n-gram family, so scoring a text is table
look-ups and means, in numpy over Arrow batches.  A document is kept when its
base rules hold and its probability of quality reaches ``THRESHOLD``.

Defined cases: null text has no words and fails the base rules; without both
classes among the training rows the model's verdict is always "keep"; repeated
rows score alike; an empty table gives no rows; other columns are ignored.  A
text of any length is hashed in parts; only its word hashes (8 bytes a word)
are held together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import training_sample, whole_text

HELD_OUT = (4, 2)
SAMPLE_DOCS = 1500
SAMPLE_CHARS = 8_000
BITS = 16
CHAR_SIZES = (3, 4, 5)
#: A document is kept from this calibrated probability on; fixed, whatever the data.
THRESHOLD = 0.5
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\f\r"
PART_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_MIX = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)          # the golden ratio, a usual hash multiplier


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word, in order."""
    if len(text) <= PART_BYTES:
        return _hash_part(text)
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + PART_BYTES)
        while end < len(text) and text[end] not in SPACES:
            end += 1
        out.append(_hash_part(text[at:end]))
        at = end
    return np.concatenate(out)


def _hash_part(text: bytes) -> np.ndarray:
    raw = np.frombuffer(text, np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    word = ~_IS_SPACE[raw]
    first = np.flatnonzero(word & np.r_[True, ~word[:-1]])
    if not len(first):
        return np.zeros(0, np.uint64)
    where = np.flatnonzero(word)
    begin = np.repeat(first, np.diff(np.r_[np.searchsorted(where, first), len(where)]))
    place = (where - begin).astype(np.uint64)
    value = _MIX[raw[where]] * (place * _STEP + np.uint64(1)) ^ (_MIX[raw[where]] >> np.uint64(29))
    value = (value ^ (value >> np.uint64(31))) * (place * np.uint64(2) + np.uint64(3))
    total = np.add.reduceat(value, np.searchsorted(where, first))
    return total ^ (total >> np.uint64(32))


def repeated_words(words: np.ndarray, window: int = WINDOW) -> int:
    """Words inside ``window``-word windows that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.zeros(n, np.uint64)
    for k in range(window):
        h = h * _STEP + words[k:k + n]
        h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    starts = np.flatnonzero(twice)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


_CONTINUATION = bytes(range(0x80, 0xC0))


def base_facts(text: bytes, words: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    chars = len(text.translate(None, SPACES + _CONTINUATION))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]       # bytes.strip: space and 0x09-0x0D only
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words


# -- the model ---------------------------------------------------------------

def families(text: bytes, words: np.ndarray) -> Iterator[np.ndarray]:
    """Hash numbers of each n-gram family of a text, repeats included."""
    shift = np.uint64(64 - BITS)
    yield ((words * _STEP) >> shift).astype(np.int64)
    yield (((words[:-1] * np.uint64(3) + words[1:]) * _STEP) >> shift).astype(np.int64)
    raw = np.frombuffer(text, np.uint8)
    for size in CHAR_SIZES:
        n = len(raw) - size + 1
        h = np.zeros(max(n, 0), np.uint32)
        for k in range(size if n > 0 else 0):
            h = h * np.uint32(0x01000193) + raw[k:k + n]
        yield ((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)


N_FAMILIES = 2 + len(CHAR_SIZES)


def raw_value(text: bytes, words: np.ndarray, tables: np.ndarray) -> float:
    total = 0.0
    for table, part in zip(tables, families(text, words)):
        if len(part):
            total += float(table[part].mean(dtype=np.float64))
    return total


def train(sample: list[tuple[str, int]], shift: float = 0.0, seed: int = 5, epochs: int = 6, rate: float = 0.5) -> dict:
    """AdaGrad on the hashed features, then a logistic calibration on unseen rows."""
    labels = np.array([y for _, y in sample])
    if len(set(labels.tolist())) < 2:
        return {"constant": 1.0}
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(sample))
    fit, hold = order[:(3 * len(order)) // 4], order[(3 * len(order)) // 4:]
    if len(set(labels[fit].tolist())) < 2 or len(set(labels[hold].tolist())) < 2:
        fit = hold = order
    texts = [t.encode("utf-8", "replace") for t, _ in sample]
    words = [word_hashes(t) for t in texts]
    sparse = []
    for t, w in zip(texts, words):
        ids, vals = [], []
        for f, part in enumerate(families(t, w)):
            if len(part):
                i, c = np.unique(part, return_counts=True)
                ids.append(i + (f << BITS))
                vals.append(c / len(part))
        sparse.append((np.concatenate(ids), np.concatenate(vals)) if ids else (np.zeros(0, np.int64), np.zeros(0)))
    table, seen, bias, bias_seen = np.zeros(N_FAMILIES << BITS), np.full(N_FAMILIES << BITS, 1e-6), 0.0, 1e-6
    share = labels[fit].mean()
    balance = {1: 0.5 / share, 0: 0.5 / (1 - share)}
    for _ in range(epochs):
        for k in rng.permutation(fit):
            ids, vals = sparse[k]
            g = (1 / (1 + np.exp(-np.clip(table[ids] @ vals + bias, -30, 30))) - labels[k]) * balance[int(labels[k])]
            step = g * vals
            seen[ids] += step * step
            table[ids] -= rate * step / np.sqrt(seen[ids])
            bias_seen += g * g
            bias -= rate * g / np.sqrt(bias_seen)
    tables = table.reshape(N_FAMILIES, 1 << BITS).astype(np.float32)
    z = np.array([raw_value(texts[k], words[k], tables) for k in hold]) + bias
    scale = max(1e-6, z.std())
    x, y, coef = np.column_stack([z / scale, np.ones(len(z))]), labels[hold], np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ coef, -30, 30)))
        coef = coef - np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2), x.T @ (p - y) + 1e-2 * coef)
    return {"tables": tables, "slope": float(coef[0] / scale), "shift": float(coef[1] + coef[0] * bias / scale + shift)}


def probability(text: bytes, words: np.ndarray, model: dict) -> float:
    if "constant" in model:
        return model["constant"]
    z = model["slope"] * raw_value(text, words, model["tables"]) + model["shift"]
    return float(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))


# -- Spark -------------------------------------------------------------------

def _apply(model: dict, threshold: float):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality", "kept"]
    types = [pa.int64()] * 6 + [pa.bool_(), pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("t").cast(pa.binary()).to_pylist()):
                words = word_hashes(text)
                facts = base_facts(text, words)
                failed, p = base_failed(facts[0], facts[4]), probability(text, words, model)
                rows.append((doc, *facts, failed, p, not failed and p >= threshold))
            cols = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)
    return run


def rules_model(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict:
    return train(*training_sample(docs, labels, "quality", *HELD_OUT, sample_docs, SAMPLE_CHARS))


def apply_rules(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: the base facts, ``base_failed``, ``quality`` and ``kept``."""
    return docs.select("doc_id", whole_text().alias("t")).mapInArrow(
        _apply(model, threshold), "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, quality double, kept boolean")
