"""Odd values, deep trees, bad files and repeated checks, all made of the driver's orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from docpulse.operators.leaf import of_kind
from docpulse.plans.gate import check_batch
from docpulse.plans.ingest import flat_rows, ingest_batch
from docpulse.sources import tables as T
from workload import standins as S
from workload.registry import query
from workload.streams import fresh

# Nodes by a number from 0 to 5 taken from the order; %d is the order's key. What a case gives is next to it in SQL.
NODES = {
    "Time": ['{"type":"time","valueTime":"12:%d"}'],
    "Flag": ['{"type":"boolean","valueBoolean":false,"n":%d}', '{"type":"boolean","valueBoolean":"false","n":%d}',
             '{"type":"boolean","valueBoolean":null,"n":%d}', '{"type":"boolean","valueBoolean":true,"n":%d}',
             '{"type":"boolean","valueBoolean":0,"n":%d}', '{"type":"boolean","valueBoolean":%d}'],
    "Cost": ['{"type":"currency","valueCurrency":{"amount":%d,"currencyCode":"EUR"}}', '{"type":"currency","valueCurrency":{"amount":%d}}',
             '{"type":"currency","valueCurrency":{"currencyCode":"EUR","n":%d}}', '{"type":"currency","valueCurrency":"%d EUR"}',
             '{"type":"currency","valueString":"v%d"}', '{"type":"currency","valueCurrency":{"amount":%d.5,"currencyCode":"USD"}}'],
    "Home": ['{"type":"address","valueAddress":{"streetAddress":"S %d","city":"C","state":"","postalCode":null,"countryRegion":"X"}}',
             '{"type":"address","valueAddress":{"n":%d}}', '{"type":"address","valueAddress":"line %d"}'],
    "Other": ['{"type":"weird","valueString":"w%d"}', '{"type":"weird","n":%d}'],
    "Plain": ['{"valueString":"p%d"}'],
    "Empty": ['{"type":"string","confidence":0.5,"n":%d}', '{"type":"string","n":%d}'],
    "Num": ['{"type":"number","valueNumber":"%d.5"}', '{"type":"number","valueNumber":"abc%d"}', '{"type":"number","valueNumber":true,"n":%d}'],
    "Whole": ['{"type":"integer","valueInteger":12.7,"n":%d}', '{"type":"integer","valueInteger":"12.7","n":%d}', '{"type":"integer","valueInteger":" %d "}'],
    "Sure": ['{"type":"string","valueString":"s%d","confidence":"0.25"}', '{"type":"string","valueString":"s%d","confidence":"high"}',
             '{"type":"string","valueString":"s%d","spans":[{"offset":"a","length":2.9}]}'],
    "List": ['{"type":"array","valueArray":[null,7,{"type":"array","valueArray":[{"type":"string","valueString":"deep%d"}]},"text"]}',
             '{"type":"array","n":%d}'],
}


def pick(cases: list[str], key) -> "F.Column":
    """The case an order has, with its key filled in."""
    out = None
    for i, case in enumerate(cases):
        before, after = case.split("%d")
        text = F.concat(F.lit(before), key.cast("string"), F.lit(after))
        out = F.when(key % len(cases) == i, text) if out is None else out.when(key % len(cases) == i, text)
    return out


def odd_files(spark, sf_dir):
    key = F.col("o_orderkey")
    members = [F.concat(F.lit(f'"{name}":'), pick(cases, key)) for name, cases in NODES.items()]
    body = F.concat(F.lit('{"fieldLabels":{"bad":7,'), F.concat_ws(",", *members), F.lit("}}"))
    return S.spread(S.table(spark, sf_dir, "orders")).select(F.concat(F.lit("u/a/"), key.cast("string"), F.lit(".json")).alias("path"), body.alias("value"))


def leaves_of(files):
    """Leaf rows of files of any depth."""
    return of_kind(flat_rows(files, f"{fresh(files.sparkSession)}/staged", "r"), "leaf")


def _case(*texts: str) -> str:
    return f"CASE k % {len(texts)} " + " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(texts)) + " END"


_S = "CAST(k AS VARCHAR)"
# field -> its value_string, value_number, value_integer, value_boolean, currency_code, confidence, span_length, by order
ODD = {
    "Time": (f"'12:' || {_S}",),
    "Flag": (_case("'False'", "'false'", "NULL", "'True'", "'0'", _S), "NULL", "NULL", _case("false", "true", "NULL", "true", "false", "k <> 0")),
    "Cost": (_case(f"{_S} || ' EUR'", _S, "'None EUR'", f"{_S} || ' EUR'", f"'v' || {_S}", f"{_S} || '.5 USD'"),
             _case("k", "k", "NULL", "NULL", "NULL", "k + 0.5"), "NULL", "NULL", _case("'EUR'", "NULL", "'EUR'", "NULL", "NULL", "'USD'")),
    "Home": (_case(f"'S ' || {_S} || ', C, X'", "''", f"'line ' || {_S}"),),
    "Other": (_case(f"'w' || {_S}", "NULL"),),
    "Plain": (f"'p' || {_S}",),
    "Empty": (_case("''", "NULL"), "NULL", "NULL", "NULL", "NULL", _case("0.5", "NULL")),
    "Num": (_case(f"{_S} || '.5'", f"'abc' || {_S}", "'True'"), _case("k + 0.5", "NULL", "1")),
    "Whole": (_case("'12.7'", "'12.7'", f"' ' || {_S} || ' '"), _case("12.7", "12.7", "k"), _case("12", "NULL", "k")),
    "Sure": (f"'s' || {_S}", "NULL", "NULL", "NULL", "NULL", _case("0.25", "NULL", "NULL"), _case("NULL", "NULL", "2")),
}
_TYPES = ("VARCHAR", "DOUBLE", "BIGINT", "BOOLEAN", "VARCHAR", "DECIMAL(5,4)", "INTEGER")
_NAMES = ("value_string", "value_number", "value_integer", "value_boolean", "currency_code", "confidence", "span_length")


def _odd_sql() -> str:
    parts = []
    for name, values in ODD.items():
        values = [*values, *["NULL"] * (len(_TYPES) - len(values))]
        columns = ", ".join(f"CAST({v} AS {t}) AS {n}" for v, t, n in zip(values, _TYPES, _NAMES))
        parts.append(f"SELECT k, '{name}' AS field_path, CAST(NULL AS INTEGER) AS array_index, {columns} FROM o")
    nested = ", ".join(f"CAST({v} AS {t}) AS {n}" for v, t, n in zip([f"'deep' || {_S}", *["NULL"] * 6], _TYPES, _NAMES))
    parts.append(f"SELECT k, 'List[2][0]' AS field_path, 0 AS array_index, {nested} FROM o WHERE k % 2 = 0")
    return ("WITH o AS (SELECT o_orderkey AS k FROM orders), r AS (" + " UNION ALL ".join(parts)
            + ") SELECT 'source/u/a/' || CAST(k AS VARCHAR) || '.json' AS blob_path, field_path, array_index, " + ", ".join(_NAMES) + " FROM r")


@query(_odd_sql())
def leaf_odd_values(spark, sf_dir):
    """Times, flags, currencies without a part, addresses, unlisted and missing types, empty and misspelt values, lists in lists."""
    return leaves_of(odd_files(spark, sf_dir)).select("blob_path", "field_path", "array_index", *_NAMES)


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderkey % 7 AS d FROM orders)
SELECT 'source/u/a/' || CAST(k AS VARCHAR) || '.json' AS blob_path, 'r' || repeat('.k[0]', CAST(d AS INTEGER)) || '.end' AS field_path,
  'r' || repeat('.k[0]', CAST(d AS INTEGER)) AS parent_path, CASE WHEN d > 0 THEN 0 END AS array_index, s AS value_string FROM o""")
def deep_trees(spark, sf_dir):
    """Objects and lists in turn, 1 to 13 levels deep: no depth is cut off."""
    key = F.col("o_orderkey")
    depth = (key % 7).cast("int")
    end = F.concat(F.lit('{"type":"object","valueObject":{"end":{"valueString":"'), "o_orderstatus", F.lit('"}}}'))
    body = F.concat(
        F.lit('{"fieldLabels":{"r":'), F.repeat(F.lit('{"type":"object","valueObject":{"k":{"type":"array","valueArray":['), depth), end,
        F.repeat(F.lit("]}}}"), depth), F.lit("}}"))
    files = S.spread(S.table(spark, sf_dir, "orders")).select(F.concat(F.lit("u/a/"), key.cast("string"), F.lit(".json")).alias("path"), body.alias("value"))
    return leaves_of(files).select("blob_path", "field_path", "parent_path", "array_index", "value_string")


# Files by order: good, broken, of no known shape, not read, with a value its column cannot hold.
BAD = ["""'{"fieldLabels":{"f":{"valueString":"x"}}}'""", "'{'", "'{\"a\":1}'", "NULL", """'{"fieldLabels":{"d":{"type":"date","valueDate":"soon"}}}'"""]


@query("""SELECT 'source/u/a/' || CAST(o_orderkey AS VARCHAR) || '.json' AS blob_path,
  CASE o_orderkey % 5 WHEN 1 THEN 'ParseError' WHEN 2 THEN 'SchemaError' WHEN 3 THEN 'ReadError' ELSE 'SqlError' END AS error_kind,
  'failed/u/a/' || CAST(o_orderkey AS VARCHAR) || '.json' AS dest_path FROM orders WHERE o_orderkey % 5 <> 0""")
def error_log(spark, sf_dir):
    """The errors table and the manifest after a batch with bad files."""
    out, key = fresh(spark), F.col("o_orderkey")
    value = reduce(lambda c, i: c.when(key % 5 == i, F.expr(BAD[i])), range(1, 5), F.when(key % 5 == 0, F.expr(BAD[0])))
    files = S.spread(S.table(spark, sf_dir, "orders")).select(
        F.concat(F.lit("u/a/"), key.cast("string"), F.lit(".json")).alias("path"), value.cast("string").alias("value"))
    ingest_batch(files, out, "r1")
    routed = T.read_table(spark, out, "manifest").select(F.col("src_path").alias("blob_path"), "dest_path")
    return T.read_table(spark, out, "errors").join(routed, "blob_path").select("blob_path", "error_kind", "dest_path")


@query("""SELECT 'incoming/u/a/' || CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN '.docx' ELSE '.png' END AS blob_path, m AS mode,
  NOT (m = 'pro' AND o_orderkey % 2 = 0) AS passed FROM orders, (VALUES ('standard'), ('pro')) v(m)""")
def repeated_checks(spark, sf_dir):
    """Every file checked in one mode, then in the other, the second run twice: two checks of each."""
    out, key = fresh(spark), F.col("o_orderkey")
    head = F.when(key % 2 == 0, F.lit(b"PK\x03\x04")).otherwise(F.lit(b"\x89PNG\r\n\x1a\n"))
    files = S.spread(S.table(spark, sf_dir, "orders")).select(
        F.concat(F.lit("u/a/"), key.cast("string"), F.when(key % 2 == 0, ".docx").otherwise(".png")).alias("path"),
        F.lit("2024-01-01").cast("timestamp").alias("modificationTime"), F.lit(8).cast("bigint").alias("length"), head.alias("content"))
    for run, mode in (("r1", "standard"), ("r2", "pro"), ("r2", "pro")):
        check_batch(files, out, run, mode)
    return T.checks(spark, out).select("blob_path", "mode", "passed")
