"""Plans: what is pushed down, what shuffles, how skew is met."""

from pyspark.sql import functions as F

from docpulse.operators.flatten import flatten_nodes
from docpulse.operators.leaf import decode_leaves
from docpulse.operators.parse import parse_results
from docpulse.plans import adhoc, views
from docpulse.plans.ingest import ingest_batch
from docpulse.sources import tables

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flatten_is_one_narrow_stage(spark, folder):
    spark.createDataFrame([("u/a/x.json", "{}")], "path STRING, value STRING").write.parquet(f"{folder}/f")
    plan = plan_of(decode_leaves(flatten_nodes(parse_results(spark.read.parquet(f"{folder}/f"), "r"))))
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan


def test_threshold_reaches_the_scan(spark, folder):
    fields = spark.range(10).select(
        F.col("id").alias("document_id"), *[F.lit("x").alias(c) for c in ("field_path", "field_name", "field_type", "value_string", "unused")],
        F.lit("0.5").cast("decimal(5,4)").alias("confidence"))
    fields.write.parquet(f"{folder}/fields")
    docs = spark.range(10).select(F.col("id").alias("document_id"), *[F.lit("x").alias(c) for c in ("usecase", "analyzer_name", "document_name", "blob_path")],
                                  F.current_timestamp().alias("ingested_at"))
    plan = plan_of(views.low_confidence_fields(spark.read.parquet(f"{folder}/fields"), docs))
    assert "LessThan(confidence,0.7" in plan and "unused" not in plan


def test_hot_document_is_split(spark, folder):
    """Half of all fields belong to one document; the join splits its partition."""
    keep = {k: spark.conf.get(k, None) for k in (
        "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "20")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20k")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10k")
        n = 200_000
        fields = spark.range(0, n, 1, 8).select(
            F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("document_id"), F.col("id").cast("string").alias("value_string"),
            *[F.lit("x").alias(c) for c in ("field_path", "field_name", "field_type")], F.lit("0.5").cast("decimal(5,4)").alias("confidence"))
        docs = spark.range(n).select(F.col("id").alias("document_id"), *[F.lit("x").alias(c) for c in ("usecase", "analyzer_name", "document_name", "blob_path")],
                                     F.current_timestamp().alias("ingested_at"))
        view = views.low_confidence_fields(fields, docs)
        assert view.count() == n
        rows = view.select("value_string")
        rows.collect()
        assert "skew=true" in plan_of(rows)
    finally:
        for key, value in keep.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_path_prefix_reaches_the_scan(spark, folder):
    ingest_batch(spark.createDataFrame([("U/a/x.json", '{"fieldLabels":{"f":{"valueString":"x"}}}')], "path STRING, value STRING"), folder, "r1")
    found = adhoc.documents_by_path(tables.documents(spark, folder), "SOURCE/u/")
    assert found.count() == 1
    assert "StringStartsWith(path_key,source/u/)" in plan_of(found)
    assert "EqualTo(path_key,source/u/a/x.json)" in plan_of(adhoc.latest_document(tables.documents(spark, folder), "source/U/a/x.json"))


def test_fields_view_joins_documents_once(spark, folder):
    ingest_batch(spark.createDataFrame([("u/a/x.json", '{"fieldLabels":{"f":{"valueString":"x"}}}')], "path STRING, value STRING"), folder, "r1")
    view = tables.register(spark, folder)["vw_DocumentFields"]
    assert view.count() == 1
    plan = view._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2  # with the documents, and their choice of versions
