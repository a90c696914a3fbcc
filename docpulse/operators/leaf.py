"""Leaf nodes to typed values.

``VALUE_RULES`` is the table of leaf types: an entry gives the SQL text of each value column next
to the text of the value, which every type has. A type that is not listed has the text only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpulse import constants as C
from docpulse.functions.text import float_text, too_wide
from docpulse.functions.variants import tag, text, truthy
from docpulse.operators.parse import bind

# Types whose value is an object; without one they fall back to the text of what is there.
OBJECT_TYPES = ["currency", "address"]

VALUE_RULES: dict[str, dict[str, str]] = {
    "string": {},
    "number": {"value_number": "as_double"},
    "integer": {"value_number": "as_double", "value_integer": "as_bigint"},
    "date": {"value_date": "try_cast(CASE WHEN src_text RLIKE '^[0-9]{4}-[0-9]{2}-[0-9]{2}$' "
                           "THEN src_text END AS DATE)"},
    "time": {},
    "boolean": {"value_boolean": f"CASE WHEN plain IS NOT NULL THEN {truthy('src')} END"},
    "currency": {"value_number": "CASE WHEN raw_object THEN as_double END"},
    "address": {},
    "selectionMark": {},
}

_VALUES = {"value_number": "DOUBLE", "value_integer": "BIGINT", "value_date": "DATE",
           "value_boolean": "BOOLEAN"}


def number_or_text() -> Column:
    """Text of ``src`` as Python prints a scalar, from its type name ``src_tag``.

    A decimal tag means the number was written with a point or is a very large whole number; a
    double tag means it was written with an exponent. Lists and objects keep their JSON text.
    """
    plain, kind = F.col("plain"), F.col("src_tag")
    decimal = kind.startswith("DECIMAL")
    whole = kind.rlike(r"^DECIMAL.(19|[23][0-9]),0")
    # Up to 15 digits the decimal text is the shortest text of the double, unless it is tiny.
    short = (F.length(plain) <= 16) & ~plain.rlike(r"^-?0\.0000")
    return (
        F.when(kind == "STRING", plain)
        .when(kind == "BOOLEAN", F.initcap(plain))
        .when(decimal & short, F.when(plain.contains("."), plain).otherwise(
            F.concat(plain, F.lit(".0"))))
        .when((decimal & ~whole) | (kind == "DOUBLE"),
              float_text(F.expr("try_variant_get(src, '$', 'double')")))
        .otherwise(plain)
    )


def _by_type(column: str, sql_type: str) -> str:
    whens = "".join(
        f"WHEN '{t}' THEN {rules[column]} " for t, rules in VALUE_RULES.items() if column in rules
    )
    return f"CAST(CASE field_type {whens} END AS {sql_type}) AS {column}"


def _read(nodes: DataFrame) -> DataFrame:
    """Fetch what the type of a node asks for: its text, its value, confidence and first span.

    One walk over a node takes out all it may be asked for, as ``n``; the node itself goes no further, nor do its file's keys.
    """
    members = ", ".join(f"{k}: variant" for k in dict.fromkeys([*C.VALUE_KEYS.values(), "valueString"]))
    value = " ".join(f"WHEN '{t}' THEN n.{k}" for t, k in C.VALUE_KEYS.items())
    objects = ", ".join(f"'{t}'" for t in OBJECT_TYPES)
    listed = ", ".join(f"'{t}'" for t in VALUE_RULES if t not in OBJECT_TYPES)
    ftype = "variant_get(body, '$.type', 'variant')"
    return (
        bind(nodes, "kind").selectExpr(
            "* EXCEPT (body, node_type)",
            # Containers below the opened levels keep their node for a further round.
            "CASE WHEN kind IN ('object', 'item', 'array') THEN body END AS body",
            f"""CASE WHEN kind <> 'leaf' THEN NULL
                WHEN coalesce(node_type, '') IN ('', 'false', '0', '0.0', '-0.0', '[]', '{{}}')
                    AND NOT {truthy(ftype)}
                THEN 'string' ELSE node_type END AS field_type""",
            f"""CASE WHEN kind = 'leaf' AND (node_type LIKE '[%' OR node_type LIKE '{{%')
                THEN {tag(ftype)} <> 'STRING' END AS odd_type""",
            "CASE WHEN kind = 'leaf' THEN try_variant_get(body, '$', "
            f"'struct<confidence: double, spans: variant, {members}>') END AS n",
        )
        .selectExpr(
            "* EXCEPT (n)",
            f"CASE field_type {value} END AS raw",
            "n.confidence AS conf",
            "n.spans AS spans",
            "n.valueString AS string_value",
        )
        .selectExpr(
            "* EXCEPT (spans)",
            "CASE WHEN spans IS NOT NULL THEN try_variant_get(spans, '$[0].offset', 'bigint') END AS off",
            "CASE WHEN spans IS NOT NULL THEN try_variant_get(spans, '$[0].length', 'bigint') END AS len",
            f"""CASE WHEN spans IS NOT NULL AND variant_get(spans, '$[0]', 'variant') IS NULL
                THEN {tag('spans')} <> 'STRING' AND {truthy('spans')} END AS odd_spans""",
            f"CASE WHEN field_type IN ({objects}) THEN coalesce({tag('raw')} LIKE 'OBJECT%', false) "
            "ELSE false END AS raw_object",
        )
        .selectExpr(
            "* EXCEPT (string_value)",
            f"""CASE WHEN field_type IN ({listed}) THEN raw
                WHEN raw_object THEN CASE WHEN field_type = 'currency'
                    THEN variant_get(raw, '$.amount', 'variant') END
                WHEN kind = 'leaf' AND {text('raw')} IS NULL
                    THEN string_value ELSE raw END AS src""",
        )
        .selectExpr("* EXCEPT (raw)", "CASE WHEN raw_object THEN raw END AS raw", f"{tag('src')} AS src_tag", f"{text('src')} AS plain")
    )


def _broken() -> str:
    """Why the whole file is unusable: shapes the walk cannot pass."""
    part = "variant_get(raw, '$.{}', 'variant')"
    bad_part = " OR ".join(
        f"{tag(part.format(p))} <> 'STRING' AND {truthy(part.format(p))}" for p in C.ADDRESS_PARTS
    )
    return f"""CASE WHEN kind <> 'leaf' THEN NULL
        WHEN odd_spans THEN 'spans is not a list'
        WHEN (field_type LIKE '[%' OR field_type LIKE '{{%') AND odd_type
            THEN 'type is not a name'
        WHEN field_type = 'address' AND raw_object AND ({bad_part})
            THEN 'an address part is not text'
        WHEN field_type = 'integer' AND src_tag = 'DOUBLE'
            AND abs(as_double) = double('Infinity') THEN 'an integer is infinite' END"""


def _violation() -> Column:
    """What the fixed table types cannot hold: the document is refused, with these columns named."""
    return F.concat_ws(
        ", ",
        F.expr("CASE WHEN isnan(value_number) OR abs(value_number) = double('Infinity') "
               "THEN 'value_number' END"),
        F.expr("""CASE WHEN field_type = 'integer' AND value_integer IS NULL
            AND value_number IS NOT NULL AND (src_tag <> 'STRING'
            OR src_text RLIKE '^ *[+-]?[0-9]+ *$') THEN 'value_integer' END"""),
        F.expr("CASE WHEN field_type = 'date' AND src_text IS NOT NULL AND value_date IS NULL "
               "THEN 'value_date' END"),
        F.expr("CASE WHEN conf IS NOT NULL AND confidence IS NULL THEN 'confidence' END"),
        F.expr("CASE WHEN off IS NOT NULL AND span_offset IS NULL THEN 'span_offset' END"),
        F.expr("CASE WHEN len IS NOT NULL AND span_length IS NULL THEN 'span_length' END"),
        *[F.when(too_wide(F.col(c), n), c) for c, n in C.FIELD_WIDTHS.items()],
    )


def decode_leaves(nodes: DataFrame) -> DataFrame:
    """Typed values of leaf rows; rows of other kinds pass with NULL values.

    Adds ``violation``, naming what the fixed table types cannot hold, and turns nodes of an
    impossible shape into ``error`` rows.
    """
    code = "variant_get(raw, '$.currencyCode', 'variant')"
    address = ", ".join(
        f"nullif(variant_get(raw, '$.{p}', 'string'), '')" for p in C.ADDRESS_PARTS
    )
    texts = bind(bind(_read(nodes), "kind").withColumn("src_text", number_or_text()), "kind")
    broken = bind(
        texts.selectExpr(
            "*",
            "CASE WHEN field_type IN ('number', 'integer', 'currency') "
            "THEN try_variant_get(src, '$', 'double') END AS as_double",
            "CASE WHEN field_type = 'integer' THEN try_variant_get(src, '$', 'bigint') "
            "END AS as_bigint",
            f"CASE WHEN raw_object AND field_type = 'currency' THEN {text(code)} "
            "END AS currency_code",
        )
        .selectExpr("*", f"{_broken()} AS broken"), "kind")
    rows = (
        broken.selectExpr(
            "* EXCEPT (kind, error_kind, error_message)",
            "CASE WHEN broken IS NULL THEN kind ELSE 'error' END AS kind",
            "CASE WHEN broken IS NULL THEN error_kind ELSE 'SchemaError' END AS error_kind",
            "CASE WHEN broken IS NULL THEN error_message "
            "ELSE concat('SchemaError: ', broken) END AS error_message",
            f"""CASE WHEN NOT raw_object OR raw_object IS NULL THEN src_text
                WHEN field_type = 'currency' THEN trim(concat(coalesce(src_text, 'None'), ' ',
                    coalesce(currency_code, CASE WHEN {code} IS NULL THEN '' ELSE 'None' END)))
                ELSE concat_ws(', ', {address}) END AS shown""",
            *[_by_type(c, t) for c, t in _VALUES.items()],
            "try_cast(conf AS DECIMAL(5,4)) AS confidence",
            "try_cast(off AS INT) AS span_offset",
            "try_cast(len AS INT) AS span_length",
        )
    )
    # A leaf with a confidence and no value at all is present but empty.
    empty = " AND ".join(f"{c} IS NULL" for c in ["shown", *_VALUES])
    return bind(rows, "kind").selectExpr(
        "*", f"CASE WHEN {empty} AND conf IS NOT NULL THEN '' ELSE shown END AS value_string"
    ).withColumn("violation", F.when(F.col("kind") == "leaf", F.nullif(_violation(), F.lit("")))
    ).drop(
        "raw", "odd_type", "odd_spans", "raw_object", "src", "src_tag", "plain", "src_text", "as_double", "as_bigint", "conf", "off", "len",
        "broken", "shown",
    )


def of_kind(decoded: DataFrame, kind: str) -> DataFrame:
    """Decoded rows of one kind.

    The verdict on a row rests on long expressions. Bound to a column that depends on the task,
    the filter stays above them; moved below, it would compute all of them a second time.
    """
    return (
        decoded.withColumn("__task", F.spark_partition_id())
        .filter((F.col("__task") >= 0) & (F.col("kind") == kind))
        .drop("__task")
    )
