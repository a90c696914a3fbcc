import json
import random

import pytest
from walker import rows_of

from docpulse.operators.flatten import flatten_nodes, remaining
from docpulse.operators.leaf import decode_leaves
from docpulse.operators.parse import parse_results
from docpulse.plans.ingest import stage

PROBE = {
    "id": "op-1", "status": "succeeded",
    "result": {"analyzerId": "invoice-analyzer-v1", "apiVersion": "2024-11-30", "createdAt": "2026-05-20T11:08:00Z",
               "contents": [{"path": "input1", "fields": {
                   "InvoiceId": {"type": "string", "valueString": "A-100", "confidence": 0.99},
                   "Total": {"type": "number", "valueNumber": 123.45, "confidence": 0.97}}}]},
}
NESTED = {
    "Inv": {"type": "string", "valueString": "A-1", "confidence": 0.99}, "bad": 7, "Empty": {"type": "array"}, "EO": {"type": "object"},
    "Addr": {"type": "object", "valueObject": {"City": {"valueString": "X", "confidence": 0.5}}},
    "L": {"type": "array", "valueArray": [
        None,
        {"type": "object", "valueObject": {"P": {"type": "number", "valueNumber": 1.0}, "Q": {"type": "object", "valueObject": {
            "R": {"type": "date", "valueDate": "2024-01-02"}}}}},
        {"type": "array", "valueArray": [{"type": "string", "valueString": "deep"}]}]},
}


def files(spark, texts):
    return spark.createDataFrame(
        [(f"u/a/{i}.json", t if isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)], "path STRING, value STRING")


def decoded(spark, texts, levels=6):
    return decode_leaves(flatten_nodes(parse_results(files(spark, texts), "r"), levels)).collect()


def test_probe(spark):
    rows = decoded(spark, [PROBE])
    head = next(r for r in rows if r.kind == "document")
    assert (head.content_path, head.analyzer_id, head.api_version, head.status, head.operation_id, head.document_name) == (
        "input1", "invoice-analyzer-v1", "2024-11-30", "succeeded", "op-1", "0.json")
    assert str(head.source_created_at) == "2026-05-20 11:08:00"
    leaves = {(r.field_path, r.field_type, r.value_string, r.value_number, str(r.confidence)) for r in rows if r.kind == "leaf"}
    assert leaves == {("InvoiceId", "string", "A-100", None, "0.9900"), ("Total", "number", "123.45", 123.45, "0.9700")}


def test_nested_cases(spark):
    rows = [r for r in decoded(spark, [{"fieldLabels": NESTED}]) if r.kind == "leaf"]
    assert {(r.field_path, r.field_name, r.parent_path, r.array_index, r.field_type) for r in rows} == {
        ("Inv", "Inv", None, None, "string"), ("Addr.City", "City", "Addr", None, "string"), ("L[1].P", "P", "L[1]", 1, "number"),
        ("L[1].Q.R", "R", "L[1].Q", 1, "date"), ("L[2][0]", "L[2][0]", "L[2]", 0, "string")}


def test_labels_header(spark):
    text = {"$schema": "s", "fileId": "f", "fieldLabels": {}, "metadata": {"displayName": "", "createdDateTime": "20260520", "mimeType": "m"}}
    (head,) = decoded(spark, [text])
    assert (head.kind, head.content_path, head.document_name, head.api_version, head.operation_id, head.mime_type, head.status) == (
        "document", "labels", "0.json", "s", "f", "m", None)
    assert str(head.source_created_at) == "2026-05-20 00:00:00"


@pytest.mark.parametrize("text, kind", [
    ("{", "ParseError"), ("", "ParseError"), ('{"fieldLabels":{}} x', "ParseError"), ('﻿{"fieldLabels":{}}', "ParseError"), ('{"a":NaN}', "ParseError"),
    ("null", "SchemaError"), ("[]", "SchemaError"), ('{"result":3}', "SchemaError"), ('{"result":{}}', "SchemaError"),
    ('{"result":{"contents":[]}}', "SchemaError"), ('{"result":{"contents":5}}', "SchemaError"), ('{"result":{"contents":[{"fields":"x"}]}}', "SchemaError"),
    ('{"fieldLabels":[1]}', "SchemaError"), ('{"fieldLabels":{},"metadata":3}', "SchemaError"),
    ('{"fieldLabels":{"a":{"type":"array","valueArray":5}}}', "SchemaError"),
    ('{"fieldLabels":{"a":{"type":"array","valueArray":[{"type":"object","valueObject":[1]}]}}}', "SchemaError"),
    ('{"fieldLabels":{"a":{"spans":{"offset":1}}}}', "SchemaError"), ('{"fieldLabels":{"a":{"spans":3}}}', "SchemaError"),
    ('{"fieldLabels":{"a":{"type":["x"]}}}', "SchemaError"), ('{"fieldLabels":{"a":{"type":"address","valueAddress":{"city":5}}}}', "SchemaError"),
    ('{"fieldLabels":{"a":{"type":"integer","valueInteger":1e400}}}', "SchemaError"),
])
def test_unusable_files(spark, text, kind):
    assert {r.error_kind for r in decoded(spark, [text]) if r.kind == "error"} == {kind}


@pytest.mark.parametrize("text", [
    '{"result":{"contents":"abc"}}', '{"result":{"contents":{"a":1}}}', '{"result":{"contents":[7,null]}}', '{"fieldLabels":null}', '{"fieldLabels":{},"metadata":[]}',
    '{"fieldLabels":{"a":{"type":"array","valueArray":"x"}}}', '{"fieldLabels":{"a":{"type":"array","valueArray":{"b":{}}}}}',
    '{"fieldLabels":{"a":{"type":"object","valueObject":[1]}}}', '{"fieldLabels":{"a":{"type":"array","valueArray":[{"type":"object","valueObject":[]}]}}}',
    '{"fieldLabels":{"a":{"spans":"x"}}}', '{"fieldLabels":{"a":{"type":"address","valueAddress":{"city":0}}}}', '{"result":{"contents":[{"fields":[]}]}}',
])
def test_harmless_oddities(spark, text):
    assert not [r for r in decoded(spark, [text]) if r.kind == "error"]


def test_content_positions(spark):
    rows = decoded(spark, [{"result": {"contents": [3, {"path": ""}, {"path": 9}, {"path": "p"}]}}])
    assert [(r.pos, r.content_path) for r in rows] == [(1, "input2"), (2, "9"), (3, "p")]


def test_duplicate_keys_keep_the_last(spark):
    rows = decoded(spark, ['{"fieldLabels":{"a":{"valueString":"x"},"a":{"valueString":"y"}}}'])
    assert [r.value_string for r in rows if r.kind == "leaf"] == ["y"]


def deep_tree(depth):
    node = {"valueString": "end"}
    for i in range(depth):
        node = {"type": "object", "valueObject": {"k": node}} if i % 2 else {"type": "array", "valueArray": [node]}
    return {"root": node}


def test_any_depth(spark, folder):
    trees = [deep_tree(d) for d in (0, 1, 2, 5, 6, 7, 13, 25)]
    nodes = parse_results(files(spark, [{"fieldLabels": t} for t in trees]), "r")
    assert remaining(flatten_nodes(nodes, 4)).count() == 5
    staged = stage(files(spark, [{"fieldLabels": t} for t in trees]), folder, "r", levels=4)
    got = sorted(r.field_path for r in staged.filter("kind = 'leaf'").collect())
    assert got == sorted(row[0] for t in trees for row in rows_of(t))


def random_node(rng, depth):
    kind = rng.choice(["string", "number", "integer", "boolean", "object", "array", "time", "other", None, ""])
    if depth == 0 and kind in ("object", "array"):
        kind = "string"
    node = {} if kind is None else {"type": kind}
    if rng.random() < 0.6:
        node["confidence"] = rng.choice([0, 0.5, 1.0, 0.7])
    value = {"number": rng.choice([1.5, 0.25, 1e-7, 123456.0, 1e22, 3]), "integer": rng.choice([5, -7, 2**40]), "boolean": rng.random() < 0.5}
    if kind == "object":
        node["valueObject"] = rng.choice([random_map(rng, depth - 1), random_map(rng, depth - 1), {}, None])
    elif kind == "array":
        node["valueArray"] = [rng.choice([random_node(rng, depth - 1), random_node(rng, depth - 1), None, 3]) for _ in range(rng.randint(0, 3))]
    elif kind in value:
        node["value" + kind.capitalize()] = value[kind]
    elif rng.random() < 0.8:
        node["valueTime" if kind == "time" else "valueString"] = rng.choice(["a", "", "é", "x\ny"])
    return node


def random_map(rng, depth):
    return {rng.choice(["a", "b", "c.d", "", "e e", "[0]"]) + str(i): rng.choice([random_node(rng, depth), random_node(rng, depth), 5]) for i in range(rng.randint(0, 4))}


def test_random_trees_match_plain_walk(spark):
    rng = random.Random(5)
    trees = [random_map(rng, 4) for _ in range(300)]
    got = sorted(
        (r.blob_path, r.field_path, r.field_name, r.parent_path or "", -1 if r.array_index is None else r.array_index, r.field_type, repr(r.value_string),
         "" if r.confidence is None else float(r.confidence).__repr__())
        for r in decoded(spark, [{"fieldLabels": t} for t in trees]) if r.kind == "leaf")
    want = sorted(
        (f"source/u/a/{i}.json", p, n, parent or "", -1 if ix is None else ix, kind, repr(text), "" if c is None else repr(float(c)))
        for i, t in enumerate(trees) for p, n, parent, ix, kind, text, c in rows_of(t))
    assert got == want
