import json

import pytest

from docpulse.operators.flatten import flatten_nodes
from docpulse.operators.leaf import decode_leaves
from docpulse.operators.parse import parse_results

# node text -> expected columns; columns left out are NULL
CASES = [
    ('{"type":"string","valueString":"x"}', dict(value_string="x")),
    ('{"type":"string","valueString":true}', dict(value_string="True")),
    ('{"type":"string","valueString":12}', dict(value_string="12")),
    ('{"type":"string"}', {}),
    ('{"type":"string","confidence":0.5}', dict(value_string="", confidence="0.5000")),
    ('{"type":"number","valueNumber":1.0}', dict(value_string="1.0", value_number=1.0)),
    ('{"type":"number","valueNumber":1e2}', dict(value_string="100.0", value_number=100.0)),
    ('{"type":"number","valueNumber":1e16}', dict(value_string="1e+16", value_number=1e16)),
    ('{"type":"number","valueNumber":12345678.5e0}', dict(value_string="12345678.5", value_number=12345678.5)),
    ('{"type":"number","valueNumber":0.00001}', dict(value_string="1e-05", value_number=1e-05)),
    ('{"type":"number","valueNumber":0.1234567890123456789}', dict(value_string="0.12345678901234568", value_number=0.12345678901234568)),
    ('{"type":"number","valueNumber":"2.5"}', dict(value_string="2.5", value_number=2.5)),
    ('{"type":"number","valueNumber":"abc"}', dict(value_string="abc")),
    ('{"type":"number","valueNumber":true}', dict(value_string="True", value_number=1.0)),
    ('{"type":"number","valueNumber":[1]}', dict(value_string="[1]")),
    ('{"type":"integer","valueInteger":7}', dict(value_string="7", value_number=7.0, value_integer=7)),
    ('{"type":"integer","valueInteger":12.7}', dict(value_string="12.7", value_number=12.7, value_integer=12)),
    ('{"type":"integer","valueInteger":"12.7"}', dict(value_string="12.7", value_number=12.7)),
    ('{"type":"integer","valueInteger":" 12 "}', dict(value_string=" 12 ", value_number=12.0, value_integer=12)),
    ('{"type":"integer","valueInteger":12345678901234567890}',
     dict(value_string="12345678901234567890", value_number=12345678901234567890.0, violation="value_integer")),
    ('{"type":"date","valueDate":"2024-01-31"}', dict(value_string="2024-01-31", value_date="2024-01-31")),
    ('{"type":"date","valueDate":"2024-2-3"}', dict(value_string="2024-2-3", violation="value_date")),
    ('{"type":"date","valueDate":"2024-02-31"}', dict(value_string="2024-02-31", violation="value_date")),
    ('{"type":"time","valueTime":"10:00"}', dict(value_string="10:00")),
    ('{"type":"boolean","valueBoolean":false}', dict(value_string="False", value_boolean=False)),
    ('{"type":"boolean","valueBoolean":"false"}', dict(value_string="false", value_boolean=True)),
    ('{"type":"boolean","valueBoolean":0}', dict(value_string="0", value_boolean=False)),
    ('{"type":"boolean","valueBoolean":null}', {}),
    ('{"type":"selectionMark","valueSelectionMark":"selected"}', dict(value_string="selected")),
    ('{"type":"currency","valueCurrency":{"amount":12.50,"currencyCode":"EUR"}}', dict(value_string="12.5 EUR", value_number=12.5, currency_code="EUR")),
    ('{"type":"currency","valueCurrency":{"amount":3}}', dict(value_string="3", value_number=3.0)),
    ('{"type":"currency","valueCurrency":{"currencyCode":"EUR"}}', dict(value_string="None EUR", currency_code="EUR")),
    ('{"type":"currency","valueCurrency":{"amount":null,"currencyCode":null}}', dict(value_string="None None")),
    ('{"type":"currency","valueCurrency":"5 EUR"}', dict(value_string="5 EUR")),
    ('{"type":"currency","valueString":"v"}', dict(value_string="v")),
    ('{"type":"currency","valueCurrency":{"amount":1,"currencyCode":"TOO LONG CODE"}}',
     dict(value_string="1 TOO LONG CODE", value_number=1.0, currency_code="TOO LONG CODE", violation="currency_code")),
    ('{"type":"address","valueAddress":{"streetAddress":"S 1","city":"C","state":"","postalCode":null,"countryRegion":"X"}}', dict(value_string="S 1, C, X")),
    ('{"type":"address","valueAddress":{}}', dict(value_string="")),
    ('{"type":"address","valueAddress":"one line"}', dict(value_string="one line")),
    ('{"type":"weird","valueString":"w"}', dict(value_string="w")),
    ('{"type":"weird"}', {}),
    ('{"type":"string","valueString":"x","confidence":"0.25"}', dict(value_string="x", confidence="0.2500")),
    ('{"type":"string","valueString":"x","confidence":"high"}', dict(value_string="x")),
    ('{"type":"string","valueString":"x","confidence":0.00005}', dict(value_string="x", confidence="0.0001")),
    ('{"type":"string","valueString":"x","confidence":10}', dict(value_string="x", violation="confidence")),
    ('{"type":"string","valueString":"x","spans":[{"offset":3,"length":4},{"offset":9}]}', dict(value_string="x", span_offset=3, span_length=4)),
    ('{"type":"string","valueString":"x","spans":[]}', dict(value_string="x")),
    ('{"type":"string","valueString":"x","spans":[7]}', dict(value_string="x")),
    ('{"type":"string","valueString":"x","spans":[{"offset":"a","length":2.9}]}', dict(value_string="x", span_length=2)),
    ('{"type":"string","valueString":"x","spans":[{"offset":3000000000}]}', dict(value_string="x", violation="span_offset")),
]
COLUMNS = ["value_string", "value_number", "value_integer", "value_date", "value_boolean", "currency_code", "confidence", "span_offset", "span_length", "violation"]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(f"u/a/{i}.json", '{"fieldLabels":{"f":%s}}' % node) for i, (node, _) in enumerate(CASES)]
    nodes = parse_results(spark.createDataFrame(data, "path STRING, value STRING"), "r")
    out = decode_leaves(flatten_nodes(nodes, 2)).filter("kind <> 'document'").collect()
    return {r.blob_path: r for r in out}


@pytest.mark.parametrize("i", range(len(CASES)), ids=[c[0] for c in CASES])
def test_leaf(rows, i):
    row = rows[f"source/u/a/{i}.json"]
    assert row.kind == "leaf"
    text = lambda c, v: str(v) if v is not None and c in ("confidence", "value_date") else v
    assert {c: text(c, row[c]) for c in COLUMNS if row[c] is not None} == CASES[i][1]


def test_wide_names(spark):
    name = "n" * 257
    data = [("u/a/x.json", json.dumps({"fieldLabels": {name: {"valueString": "x"}, "\U0001F600" * 129: {"valueString": "y"}, "n" * 256: {}}}))]
    rows = decode_leaves(flatten_nodes(parse_results(spark.createDataFrame(data, "path STRING, value STRING"), "r"), 1)).filter("kind = 'leaf'").collect()
    assert sorted(r.violation or "" for r in rows) == ["", "field_name", "field_name"]
