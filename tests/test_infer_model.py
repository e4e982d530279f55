"""Distributed exemplar inference vs a sequential record-by-record model
(brute force on random records)."""

import json
import random

import pytest

from driftline.plans.ingest import ingest

NAMES = ["id", "a", "b", "c", "d", "e", "f", "g"]


def rand_value(rng):
    return rng.choice([1, 2.5, "s", True, None, {}, {"x": 1}, [], [1.5], [{"y": "z"}], -3, {"x": {}}, [{}],
                       {"x": {"y": {}}, "z": [None]}, {"x": {}, "w": False}])


def rand_doc(rng):
    keys = rng.sample(NAMES, rng.randrange(1, 5))
    body = "{" + ",".join(f'"{k}":{json.dumps(rand_value(rng))}' for k in keys) + "}"
    r = rng.random()
    if r < 0.1:
        return '{"schema":{},"payload":' + body + "}"
    if r < 0.15:
        return body[:-1] + ',"__deleted":"true"}'
    if r < 0.2:
        return "[1]"
    return body


def model_type(value):
    """The type rule written apart from the engine's; None: nothing to pin."""
    if isinstance(value, dict):
        inner = [(k, model_type(v)) for k, v in value.items()]
        inner = [f"{k}:{t}" for k, t in inner if t]
        return "struct<" + ",".join(inner) + ">" if inner else None
    if isinstance(value, list):
        return "array<" + ((model_type(value[0]) or "string") if value else "string") + ">"
    names = {bool: "boolean", int: "bigint", float: "double"}
    return names.get(type(value), "string")


def sequential_model(rows):
    """The reference's rule, one record at a time in (offset, topic, partition)
    order: unknown top-level names are appended with the type of their
    value; known names never change; `{}` pins nothing."""
    schemas = {}
    for topic, part, off, text in sorted(rows, key=lambda r: (r[2], r[0], r[1])):
        doc = json.loads(text, object_pairs_hook=dict)
        if not isinstance(doc, dict):
            continue
        if isinstance(doc.get("payload"), dict):
            doc = doc["payload"]
        if "__deleted" in doc and str(doc["__deleted"]).lower() == "true" and doc["__deleted"] in ("true", True):
            continue
        table = topic.replace(".", "_").replace("-", "_")
        fields = schemas.setdefault(table, {})
        for k, v in doc.items():
            t = model_type(v)
            if k not in fields and t is not None:
                fields[k] = t
    return {t: list(f.items()) for t, f in schemas.items() if f}


@pytest.mark.parametrize("seed", [11, 12, 13, 14])
def test_inference_matches_sequential_model(spark, records, seed):
    rng = random.Random(seed)
    topics = ["p.q", "p-q", "r"]
    rows, used = [], set()
    while len(rows) < 300:
        topic, part, off = rng.choice(topics), rng.randrange(3), rng.randrange(60)
        if (topic, part, off) in used:
            continue
        used.add((topic, part, off))
        rows.append((topic, part, off, rand_doc(rng)))
    res = ingest(records(rows))
    got = {t: [(f.name, f.dataType.simpleString()) for f in s.fields] for t, s in res.schemas.items()}
    assert got == sequential_model(rows)
