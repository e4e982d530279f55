"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it.
Learned filters of ``WIDTH`` bytes (a byte embedding folded into one table per
filter place) run over every chunk with stride ``STRIDE``; each filter's
rectified response is max-pooled inside a chunk.  A document's vector holds each
filter's mean over its chunks and its largest value; one logistic unit turns it
into a probability.

Training: Adam with hand-written gradients on a bounded sample of labelled rows
outside the held-out fold; a training step sees a few chunks of each document
of its batch.  The last layer is then refitted (logistic regression, which also
calibrates it) on whole documents.  Scoring always covers the whole text, in
blocks of bytes over Arrow batches.

Defined cases: null and empty texts are one chunk of padding; a text of any
length is read in blocks; without both classes among the training rows every
score is the prior of class 1 (0.5 with no rows); repeated rows score alike; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import fold_of, training_sample, whole_text

HELD_OUT = (4, 2)
THRESHOLD = 0.7
SAMPLE_DOCS = 1500
SAMPLE_CHARS = 20_000
FILTERS, WIDTH, STRIDE, EMBED = 24, 7, 1, 6
#: Bytes of a chunk, and how far the next one begins after it.
CHUNK, HOP = 512, 448
BATCH, STEPS, CHUNKS_SEEN = 48, 500, 3
RATE = 0.01
#: Bytes that are scored at once.
BLOCK_CHUNKS = 256


def chunks(text: bytes) -> np.ndarray:
    """Overlapping chunks that cover all bytes; the last one is padded with zeros."""
    raw = np.frombuffer(text, np.uint8)
    n = 1 + max(0, -(-(len(raw) - CHUNK) // HOP))
    padded = np.zeros((n - 1) * HOP + CHUNK, np.uint8)
    padded[:len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::HOP]


POSITIONS = (CHUNK - WIDTH) // STRIDE + 1


def responses(block: np.ndarray, tables: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Filter responses (chunks x positions x filters) of byte chunks."""
    out = np.zeros((len(block), POSITIONS, tables.shape[2]), np.float32) + bias.astype(np.float32)
    for k in range(WIDTH):
        out += tables[k][block[:, k:k + STRIDE * (POSITIONS - 1) + 1:STRIDE]]
    return out


def fold_tables(p: dict) -> np.ndarray:
    """One table (byte x filter) for each filter place: embedding times filter weights."""
    return np.einsum("be,kef->kbf", p["embed"], p["filters"]).astype(np.float32)


def document_vectors(texts: list[bytes], tables: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Mean and maximum over its chunks of every document's pooled responses."""
    total = np.zeros((len(texts), FILTERS))
    best = np.zeros((len(texts), FILTERS), np.float32)
    count = np.zeros(len(texts))
    held, owner, size = [], [], 0

    def flush():
        pooled = np.maximum(responses(np.concatenate(held), tables, bias).max(axis=1), 0)
        who = np.concatenate(owner)
        first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        total[who[first]] += np.add.reduceat(pooled, first, axis=0)
        best[who[first]] = np.maximum(best[who[first]], np.maximum.reduceat(pooled, first, axis=0))
        count[who[first]] += np.diff(np.r_[first, len(who)])

    for d, text in enumerate(texts):
        c = chunks(text)
        for i in range(0, len(c), BLOCK_CHUNKS):
            part = c[i:i + BLOCK_CHUNKS]
            held.append(part)
            owner.append(np.full(len(part), d))
            size += len(part)
            if size >= BLOCK_CHUNKS:
                flush()
                held, owner, size = [], [], 0
    if held:
        flush()
    return np.concatenate([total / np.maximum(count, 1)[:, None], best], axis=1)


def _start(rng) -> dict:
    return {"embed": rng.normal(0, 0.5, (256, EMBED)), "filters": rng.normal(0, 0.3, (WIDTH, EMBED, FILTERS)),
            "bias": np.zeros(FILTERS), "out": rng.normal(0, 0.1, 2 * FILTERS), "out_bias": np.zeros(1)}


def gradients(p: dict, block: np.ndarray, owner: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
    """Loss and gradients of a batch: chunks ``block`` of the documents ``owner``, labels ``y``."""
    tables = np.einsum("be,kef->kbf", p["embed"], p["filters"]).astype(np.float32)
    r = responses(block, tables, p["bias"])
    top = r.argmax(axis=1)                                           # chunks x filters
    peak = np.take_along_axis(r, top[:, None, :], axis=1)[:, 0]
    pooled = np.maximum(peak, 0).astype(np.float64)
    n, count = len(y), np.bincount(owner, minlength=len(y))
    mean = np.zeros((n, FILTERS))
    np.add.at(mean, owner, pooled)
    mean /= count[:, None]
    best = np.full((n, FILTERS), -1.0)
    np.maximum.at(best, owner, pooled)
    prob = 1 / (1 + np.exp(-np.clip(np.concatenate([mean, best], axis=1) @ p["out"] + p["out_bias"], -30, 30)))
    loss = float(-(weight * np.where(y == 1, np.log(prob + 1e-9), np.log(1 - prob + 1e-9))).mean())
    dz = weight * (prob - y) / n
    g = {"out": np.concatenate([mean, best], axis=1).T @ dz, "out_bias": np.array([dz.sum()])}
    back = dz[owner][:, None] * p["out"][None, :FILTERS] / count[owner][:, None]
    back = back + np.where(pooled == best[owner], dz[owner][:, None] * p["out"][None, FILTERS:], 0)
    back = np.where(peak > 0, back, 0)                               # chunks x filters
    g["bias"] = back.sum(axis=0)
    g["embed"], g["filters"] = np.zeros_like(p["embed"]), np.zeros_like(p["filters"])
    rows = np.arange(len(block))[:, None]
    for k in range(WIDTH):
        b = block[rows, top * STRIDE + k]                            # the byte under place k of each peak
        g["filters"][k] = np.einsum("cfe,cf->ef", p["embed"][b], back)
        np.add.at(g["embed"], b.ravel(), (back[:, :, None] * p["filters"][k].T[None]).reshape(-1, EMBED))
    return loss, g


def logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    x, coef = np.column_stack([x, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ coef, -30, 30)))
        h = x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(coef))
        coef = coef - np.linalg.solve(h, x.T @ (p - y) + ridge * coef)
    return coef


def train(sample: list[tuple[str, int]], shift: float = 0.0, seed: int = 3, steps: int = STEPS) -> dict:
    labels = np.array([y for _, y in sample], float)
    if len(set(labels.tolist())) < 2:
        return {"constant": float((labels.sum() + 1) / (len(labels) + 2)) if len(labels) else 0.5}
    rng = np.random.default_rng(seed)
    texts = [t.encode("utf-8", "replace") for t, _ in sample]
    cut = [chunks(t) for t in texts]
    p = _start(rng)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    by_class = [np.flatnonzero(labels == c) for c in (0, 1)]
    for step in range(1, steps + 1):
        docs = np.concatenate([rng.choice(c, BATCH // 2) for c in by_class])       # classes in equal parts
        block, owner = [], []
        for j, d in enumerate(docs):
            pick = rng.choice(len(cut[d]), min(CHUNKS_SEEN, len(cut[d])), replace=False)
            block.append(cut[d][pick])
            owner.append(np.full(len(pick), j))
        _, g = gradients(p, np.concatenate(block), np.concatenate(owner), labels[docs], np.ones(len(docs)))
        rate = RATE * (1 - 0.9 * step / steps)
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
            p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    tables = fold_tables(p)
    x = document_vectors(texts, tables, p["bias"])
    scale = x.std(axis=0) + 1e-6
    coef = logistic(x / scale, labels, ridge=1.0)
    return {"tables": tables, "bias": p["bias"], "out": coef[:-1] / scale, "out_bias": float(coef[-1] + shift)}


def score_texts(texts: list[bytes], model: dict) -> np.ndarray:
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    z = document_vectors(texts, model["tables"], model["bias"]) @ model["out"] + model["out_bias"]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


# -- Spark -------------------------------------------------------------------

def _score(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = score_texts(b.column("t").cast(pa.binary()).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(scores)],
                                             names=["doc_id", "held_out", "score"])
    return run


def quality_model(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict:
    return train(*training_sample(docs, labels, "quality", *HELD_OUT, sample_docs, SAMPLE_CHARS))


def score_quality(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    modulus, held = HELD_OUT
    return (docs.select("doc_id", (fold_of("doc_id", modulus) == held).alias("held_out"), whole_text().alias("t"))
            .mapInArrow(_score(model), "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
