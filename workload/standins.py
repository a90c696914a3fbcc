"""Stand-ins: the driver's tables seen as documents, fields, checks, results and metrics.

Each stand-in exists twice, as a DataFrame and as SQL for the comparison engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Rows over all cores where a small table comes as one split; a large one stays as it is.

    With ``rows`` a partition has about so many at most, for rows that each become many; the count is read off the footers.
    """
    parts = 2 * df.sparkSession.sparkContext.defaultParallelism
    if rows is not None:
        parts = max(parts, -(-df.count() // rows))
    return df if df.rdd.getNumPartitions() >= parts else df.repartition(parts)


# --- documents, from orders -----------------------------------------------------------------

DOC_SQL = """doc AS (
  SELECT o_orderkey AS document_id, o_orderpriority AS usecase,
    'an-' || o_orderstatus AS analyzer_name, 'id-' || o_orderstatus AS analyzer_id,
    CAST(o_orderkey AS VARCHAR) || '.json' AS document_name,
    'source/' || o_orderpriority || '/an-' || o_orderstatus || '/' || CAST(o_orderkey AS VARCHAR) || '.json' AS blob_path,
    'processed/' || o_orderpriority || '/an-' || o_orderstatus || '/' || CAST(o_orderkey AS VARCHAR) || '.json' AS processed_blob_url,
    CASE WHEN o_orderkey % 4 = 0 THEN 'labels' ELSE 'input1' END AS content_path,
    CASE WHEN o_orderkey % 4 = 0 THEN 'application/pdf' END AS mime_type,
    o_orderdate AS source_created_at, '2024-11-30' AS api_version,
    'op-' || CAST(o_custkey AS VARCHAR) AS operation_id, 'Succeeded' AS status,
    o_orderdate AS ingested_at,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 2000 END AS preprocess_check_id
  FROM orders)"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    analyzer = F.concat(F.lit("an-"), "o_orderstatus")
    name = F.concat(F.col("o_orderkey").cast("string"), F.lit(".json"))
    relative = F.concat_ws("/", "o_orderpriority", analyzer, name)
    labelled = F.col("o_orderkey") % 4 == 0
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("document_id"),
        F.col("o_orderpriority").alias("usecase"),
        analyzer.alias("analyzer_name"),
        F.concat(F.lit("id-"), "o_orderstatus").alias("analyzer_id"),
        name.alias("document_name"),
        F.concat_ws("/", F.lit("source"), relative).alias("blob_path"),
        F.concat_ws("/", F.lit("processed"), relative).alias("processed_blob_url"),
        F.when(labelled, "labels").otherwise("input1").alias("content_path"),
        F.when(labelled, "application/pdf").alias("mime_type"),
        F.col("o_orderdate").alias("source_created_at"),
        F.lit("2024-11-30").alias("api_version"),
        F.concat(F.lit("op-"), F.col("o_custkey").cast("string")).alias("operation_id"),
        F.lit("Succeeded").alias("status"),
        F.col("o_orderdate").alias("ingested_at"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 2000).alias(
            "preprocess_check_id"
        ),
    )


# --- fields, from line items ----------------------------------------------------------------

FLD_SQL = """fld AS (
  SELECT l_orderkey AS document_id, l_orderkey * 10 + l_linenumber AS field_id,
    CAST(l_linenumber - 1 AS INTEGER) AS array_index,
    'F' || CAST(l_linenumber AS VARCHAR) AS field_name,
    'Items[' || CAST(l_linenumber - 1 AS VARCHAR) || '].F' || CAST(l_linenumber AS VARCHAR) AS field_path,
    'Items[' || CAST(l_linenumber - 1 AS VARCHAR) || ']' AS parent_path,
    CASE l_returnflag WHEN 'A' THEN 'number' WHEN 'N' THEN 'integer' ELSE 'date' END AS field_type,
    CASE l_returnflag WHEN 'A' THEN CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR)
      WHEN 'N' THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
      ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS value_string,
    CASE l_returnflag WHEN 'A' THEN l_extendedprice WHEN 'N' THEN l_quantity END AS value_number,
    CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) END AS value_integer,
    CASE WHEN l_returnflag NOT IN ('A', 'N') THEN CAST(l_shipdate AS DATE) END AS value_date,
    CAST(NULL AS BOOLEAN) AS value_boolean, CAST(NULL AS VARCHAR) AS currency_code,
    CASE WHEN l_tax > 0.075 THEN NULL ELSE CAST(ROUND(1 - 5 * l_discount, 2) AS DECIMAL(5,4)) END AS confidence
  FROM lineitem)"""


def confidence_of_line() -> Column:
    """0.50 to 1.00 in steps of 0.05, 0.70 and 0.90 among them; NULL for the highest tax."""
    rate = F.round(1 - 5 * F.col("l_discount"), 2).cast("decimal(5,4)")
    return F.when(F.col("l_tax") <= 0.075, rate)


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    number = F.col("l_linenumber").cast("string")
    parent = F.concat(F.lit("Items["), (F.col("l_linenumber") - 1).cast("string"), F.lit("]"))
    name = F.concat(F.lit("F"), number)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("document_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("field_id"),
        (F.col("l_linenumber") - 1).alias("array_index"),
        name.alias("field_name"),
        F.concat(parent, F.lit("."), name).alias("field_path"),
        parent.alias("parent_path"),
        F.when(flag == "A", "number").when(flag == "N", "integer").otherwise("date").alias(
            "field_type"
        ),
        F.when(flag == "A", F.col("l_extendedprice").cast("decimal(15,2)").cast("string"))
        .when(flag == "N", F.col("l_quantity").cast("bigint").cast("string"))
        .otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("value_string"),
        F.when(flag == "A", F.col("l_extendedprice")).when(flag == "N", F.col("l_quantity")).alias(
            "value_number"
        ),
        F.when(flag == "N", F.col("l_quantity").cast("bigint")).alias("value_integer"),
        F.when(~flag.isin("A", "N"), F.col("l_shipdate").cast("date")).alias("value_date"),
        F.lit(None).cast("boolean").alias("value_boolean"),
        F.lit(None).cast("string").alias("currency_code"),
        confidence_of_line().alias("confidence"),
    )


# --- result files: each line item as one file with a nested field tree ----------------------
# Built by projection alone: no grouping, so an order with very many lines is no hot spot.


def _node(ftype: str, **parts: Column) -> Column:
    return F.struct(F.lit(ftype).alias("type"), *[v.alias(k) for k, v in parts.items()])


def line_tree() -> Column:
    """Field tree of a line: plain fields, an object, a list of objects and a list of scalars."""
    rate = lambda c: _node("object", valueObject=F.struct(
        _node("number", valueNumber=F.col(c), confidence=confidence_of_line()).alias("Rate")))
    none = F.lit(None).cast("string")
    spans = F.array(F.struct((F.col("l_linenumber") * 10).alias("offset"), F.lit(7).alias("length")))
    return F.struct(
        _node("integer", valueInteger=F.col("l_quantity").cast("bigint"),
              confidence=confidence_of_line(), spans=spans).alias("Quantity"),
        _node("currency", valueCurrency=F.struct(
            F.col("l_extendedprice").alias("amount"), F.lit("EUR").alias("currencyCode")),
            confidence=confidence_of_line()).alias("Price"),
        _node("object", valueObject=F.struct(
            _node("date", valueDate=F.date_format("l_shipdate", "yyyy-MM-dd")).alias("Date"),
        )).alias("Shipping"),
        _node("array", valueArray=F.array(rate("l_discount"), rate("l_tax"))).alias("Rates"),
        _node("array", valueArray=F.array(
            _node("string", valueString=F.col("l_returnflag"), valueSelectionMark=none),
            _node("selectionMark", valueString=none, valueSelectionMark=F.col("l_linestatus")),
        )).alias("Flags"),
    )


def analyze_json(tree: Column, **header: Column) -> Column:
    """Result text of the analyze shape."""
    return F.to_json(F.struct(
        header["operation_id"].alias("id"), header["status"].alias("status"),
        F.struct(
            header["analyzer_id"].alias("analyzerId"), header["api_version"].alias("apiVersion"),
            header["created"].alias("createdAt"),
            F.array(F.struct(F.lit("input1").alias("path"), tree.alias("fields"))).alias("contents"),
        ).alias("result"),
    ))


def labels_json(tree: Column, **header: Column) -> Column:
    """Result text of the labels shape."""
    return F.to_json(F.struct(
        header["api_version"].alias("$schema"), header["operation_id"].alias("fileId"),
        tree.alias("fieldLabels"),
        F.struct(
            header["document_name"].alias("displayName"), header["created"].alias("createdDateTime"),
            header["mime_type"].alias("mimeType"),
        ).alias("metadata"),
    ))


def line_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a result file; every fourth order's have the labels shape."""
    order = F.col("l_orderkey").cast("string")
    name = F.concat_ws("-", order, F.col("l_linenumber").cast("string"))
    header = {
        "operation_id": F.concat(F.lit("op-"), F.col("l_partkey").cast("string")),
        "status": F.lit("succeeded"),
        "analyzer_id": F.concat(F.lit("id-"), "l_returnflag"),
        "api_version": F.lit("2024-11-30"),
        "created": F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "document_name": name,
        "mime_type": F.lit("application/pdf"),
    }
    return spread(table(spark, sf_dir, "lineitem")).select(
        F.concat_ws("/", F.concat(F.lit("u"), "l_linestatus"), F.concat(F.lit("an-"), "l_returnflag"),
                    F.concat(name, F.lit(".json"))).alias("path"),
        F.when(F.col("l_orderkey") % 4 == 0, labels_json(line_tree(), **header))
        .otherwise(analyze_json(line_tree(), **header)).alias("value"),
    )


# --- result files: each order as one file, with a path of its own ---------------------------


def order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a result file."""
    return order_files_of(spread(table(spark, sf_dir, "orders")))


def order_files_of(orders: DataFrame) -> DataFrame:
    """Orders as result files: total, date and a nested customer."""
    confidence = ((F.col("o_orderkey") % 11) * 5 + 50).cast("decimal(5,0)") / 100
    tree = F.struct(
        _node("number", valueNumber=F.col("o_totalprice"),
              confidence=F.when(F.col("o_orderkey") % 5 != 0, confidence)).alias("Total"),
        _node("date", valueDate=F.date_format("o_orderdate", "yyyy-MM-dd"),
              confidence=confidence).alias("Date"),
        _node("object", valueObject=F.struct(
            _node("integer", valueInteger=F.col("o_custkey")).alias("Key"))).alias("Customer"),
    )
    name = F.concat(F.col("o_orderkey").cast("string"), F.lit(".json"))
    header = {
        "operation_id": F.concat(F.lit("op-"), F.col("o_custkey").cast("string")),
        "status": F.lit("Succeeded"),
        "analyzer_id": F.concat(F.lit("id-"), "o_orderstatus"),
        "api_version": F.lit("2024-11-30"),
        "created": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    }
    return orders.select(
        F.concat_ws("/", "o_orderpriority", F.concat(F.lit("an-"), "o_orderstatus"), name).alias("path"),
        analyze_json(tree, **header).alias("value"),
    )


# --- checks, from documents -----------------------------------------------------------------

CHK_SQL = """chk0 AS (
  SELECT doc_id AS check_id, 'incoming/' || lang || '/' || source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS blob_path,
    lang AS usecase, source AS analyzer_name, CAST(doc_id AS VARCHAR) || '.txt' AS file_name,
    '.txt' AS extension, 'text' AS detected_kind, n_chars AS file_size_bytes, 'standard' AS mode,
    CASE WHEN n_chars < 50 THEN 1 ELSE 0 END + CASE WHEN n_chars > 10000 THEN 1 ELSE 0 END AS error_count,
    CASE WHEN n_chars < 200 THEN 1 ELSE 0 END AS warning_count,
    CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END AS info_count,
    TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 DAY * CAST(doc_id % 30 AS INTEGER) AS checked_at, quality, toxic
  FROM documents LEFT JOIN labels USING (doc_id)),
chk AS (
  SELECT *, error_count = 0 AS passed,
    CASE WHEN score >= 90 THEN 'excellent' WHEN score >= 75 THEN 'good' WHEN score >= 50 THEN 'fair'
      WHEN score >= 25 THEN 'poor' ELSE 'unusable' END AS band,
    CASE WHEN error_count > 0 THEN 'Skipped' WHEN quality = 0 THEN 'Failed' WHEN toxic = 1 THEN 'Timeout'
      ELSE 'Succeeded' END AS cu_status,
    '{"character_count": ' || CAST(file_size_bytes AS VARCHAR) || '}' AS metadata_json
  FROM (SELECT *, GREATEST(0, LEAST(100, 100 - 30 * error_count - 10 * warning_count - 2 * info_count)) AS score FROM chk0) s)"""


def checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docpulse.functions.scoring import band, score

    one = lambda cond: F.when(cond, 1).otherwise(0)
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    base = (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id", "left")
        .select(
            F.col("doc_id").alias("check_id"),
            F.concat_ws("/", F.lit("incoming"), "lang", "source", name).alias("blob_path"),
            F.col("lang").alias("usecase"),
            F.col("source").alias("analyzer_name"),
            name.alias("file_name"),
            F.lit(".txt").alias("extension"),
            F.lit("text").alias("detected_kind"),
            F.col("n_chars").alias("file_size_bytes"),
            F.lit("standard").alias("mode"),
            (one(F.col("n_chars") < 50) + one(F.col("n_chars") > 10000)).alias("error_count"),
            one(F.col("n_chars") < 200).alias("warning_count"),
            one(F.col("doc_id") % 7 == 0).alias("info_count"),
            F.expr(
                "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(CAST(doc_id % 30 AS INT))"
            ).alias("checked_at"),
            "quality",
            "toxic",
        )
    )
    scored = base.withColumn("score", score(*[F.col(f"{s}_count") for s in ("error", "warning", "info")]))
    return scored.select(
        "*",
        (F.col("error_count") == 0).alias("passed"),
        band(F.col("score")).alias("band"),
        F.when(F.col("error_count") > 0, "Skipped")
        .when(F.col("quality") == 0, "Failed")
        .when(F.col("toxic") == 1, "Timeout")
        .otherwise("Succeeded")
        .alias("cu_status"),
        F.concat(
            F.lit('{"character_count": '), F.col("file_size_bytes").cast("string"), F.lit("}")
        ).alias("metadata_json"),
    )
