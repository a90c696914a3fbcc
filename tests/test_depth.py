"""The depth router: brackets counted right, and deep files alone staged."""

import json
import os
import random
import re

from pyspark.sql import functions as F

from docpulse.operators.depth import by_depth, levels_needed, nests_within
from docpulse.plans.ingest import flat_rows, stage
from workload import QUERIES

SF = "/root/testdata/sf0.001"


def depth(value):
    if isinstance(value, dict):
        value = list(value.values())
    return 1 + max(map(depth, value), default=0) if isinstance(value, list) else 0


def tree(rnd, deep):
    if deep == 0 or rnd.random() < 0.2:
        return rnd.choice([1, None, "x", "{[{", '"', "\\", '\\"', '}"]\\\\', "é\n[", ""])
    if rnd.random() < 0.5:
        return [tree(rnd, deep - 1) for _ in range(rnd.randint(0, 3))]
    return {rnd.choice(['a"{', "b\\", "c", "[["]) + str(i): tree(rnd, deep - 1) for i in range(rnd.randint(0, 3))}


def test_brackets_tell_the_depth(spark):
    rnd = random.Random(7)
    trees = [tree(rnd, rnd.randint(0, 9)) for _ in range(400)] + ["x" * 300_000 + '\\"' * 50_000]
    rows = [(json.dumps(t, ensure_ascii=rnd.random() < 0.5, indent=rnd.choice([None, 1])), depth(t)) for t in trees]
    df = spark.createDataFrame(rows, "value string, depth int")
    for most in (0, 1, 3, 6):
        assert df.filter(nests_within(F.col("value"), most) != (F.col("depth") <= most)).count() == 0
    assert spark.sql("SELECT CAST(NULL AS STRING) AS value").filter(nests_within(F.col("value"), 3)).count() == 1


def chain(levels):
    node = {"valueString": "end", "spans": [{"offset": 1, "length": 2}]}
    for i in range(levels):
        node = ({"type": "object", "valueObject": {"k": node}} if i % 2 else {"type": "array", "valueArray": [node]})
    return node


def test_no_container_is_left_over(spark, folder):
    """Whatever goes the narrow way is opened to its leaves; the rest is staged: together they are what staging alone gives."""
    wraps = [lambda n: {"fieldLabels": {"f": n}}, lambda n: {"result": {"contents": [{"fields": {"f": n}}]}}]
    files = spark.createDataFrame([(f"u/{w}/{i}.json", json.dumps(wrap(chain(i)))) for w, wrap in enumerate(wraps) for i in range(12)], "path string, value string")
    shallow, deep = by_depth(files, 3)
    assert shallow.count() > 0 and deep.count() > 0
    rows = flat_rows(files, f"{folder}/some", "r", 3)
    assert flat_rows(shallow, f"{folder}/none", "r", 3).filter("kind IN ('object', 'item', 'array')").count() == 0
    leaf = lambda df: sorted(map(repr, df.filter("kind = 'leaf'").select("blob_path", "field_path", "parent_path", "value_string", "span_offset").collect()))
    assert leaf(rows) == leaf(stage(files, f"{folder}/all", "r", 3)) and len(leaf(rows)) == 24
    assert os.path.exists(f"{folder}/some") and not os.path.exists(f"{folder}/none")


def test_bad_texts_have_an_error_either_way(spark, folder):
    texts = ["{", '{"fieldLabels":{"a', "[" * 50, "]" * 50, '"', "", None, "{}" * 3, '{"fieldLabels":{}} {"x":[[[[[[[[[[[[[[[[[[[]]]]]]]]]]]]]]]]]]]}']
    files = spark.createDataFrame([(f"u/a/{i}.json", t) for i, t in enumerate(texts)], "path string, value string")
    rows = flat_rows(files, folder + "/s", "r")
    assert rows.filter("kind = 'error'").select("blob_path").distinct().count() == len(texts)


def test_registered_query_is_one_narrow_stage(spark):
    plan = QUERIES["flatten_fields"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Join", "Union", "docpulse-")) and plan.count("Scan parquet") == 1
    assert plan.count("Exchange") == plan.count("RoundRobinPartitioning")  # of the stand-in, which spreads its few rows


def test_levels_go_by_what_the_files_need(spark, folder):
    """A chain has as many levels as the deepest file it takes needs, not all; a deeper file among them is still opened whole."""
    of = lambda *deep: spark.createDataFrame([(f"u/a/{i}.json", json.dumps({"fieldLabels": {"f": chain(i)}})) for i in deep], "path string, value string")
    assert levels_needed(of(0, 0), 6, 2) == (2, False)
    assert levels_needed(of(0, 4), 6, 2) == (6, False)
    assert levels_needed(of(0, 9), 6, 2) == (2, True)
    assert levels_needed(of(0).limit(0), 6, 2) == (2, False)
    opened = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("variant_explode")
    assert opened(flat_rows(of(0, 0), f"{folder}/a", "r")) < opened(flat_rows(of(0, 4), f"{folder}/b", "r"))


def test_a_deeper_file_among_shallow_ones_is_opened_whole(spark, folder):
    files = spark.createDataFrame([(f"u/a/{i}.json", json.dumps({"fieldLabels": {"f": chain(i)}})) for i in (0, 9)], "path string, value string")
    assert flat_rows(files, f"{folder}/s", "r").filter("kind = 'leaf' AND value_string = 'end'").count() == 2


def test_an_analyze_result_needs_no_more_levels_than_its_field_maps(spark):
    """The brackets around the field maps of an analyze result are no levels of theirs, unless a key may be ``fieldLabels``."""
    analyze = lambda i, **more: json.dumps({"result": {"contents": [{"fields": {"f": chain(i)}}]}, **more})
    of = lambda *texts: spark.createDataFrame([(f"u/a/{i}.json", t) for i, t in enumerate(texts)], "path string, value string")
    assert levels_needed(of(analyze(1)), 6, 2) == (3, False)
    assert levels_needed(of(analyze(1, fieldLabels={})), 6, 2)[0] > 3
    assert levels_needed(of(analyze(1, note="é")), 6, 2)[0] > 3  # written as an escape, as a key may be


def test_generated_methods_are_small_enough_to_be_compiled(spark):
    """HotSpot interprets methods of over 8,000 bytes unless told otherwise."""
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    files = spark.createDataFrame([("u/a/1.json", json.dumps({"fieldLabels": {"f": chain(0)}}))], "path string, value string")
    said = flat_rows(files, "unused", "r")._jdf.queryExecution().explainString(mode)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", said)]
    assert sizes and max(sizes) < 8000
