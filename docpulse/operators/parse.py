"""Result files to nodes: JSON parsing, shape dispatch, header projection, contents explode.

One narrow pass without a shuffle. Its output is a single stream of rows told apart by ``kind``:

* ``document`` - header of a logical document
* ``root``     - the field map of a document, still to be opened
* ``error``    - the file cannot be used; ``error_kind`` and ``error_message`` say why

so a file is read and parsed once, whatever is derived from it afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpulse.functions.paths import parse_result_paths
from docpulse.functions.text import ci_key
from docpulse.functions.variants import is_number_or_true, tag, truthy

HEADER = [
    "analyzer_id", "document_name", "content_path", "mime_type", "source_created_at",
    "api_version", "operation_id", "status",
]
FILE = ["blob_path", "usecase", "analyzer_name"]
NODE = ["field_path", "field_name", "parent_path", "array_index", "body", "node_type"]


def iso_datetime(col: Column) -> Column:
    """Instant of an ISO 8601 text, extended or basic form; UTC without an offset, NULL if bad."""
    text = F.translate(F.trim(col), ",", ".")
    usual = col.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z\z")  # as it is, none of the patterns below finds anything in it
    text = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})(?=$|[T ])", "$1-$2-$3")
    text = F.regexp_replace(text, r"([T ]\d{2})(\d{2})(?=$|[.+Z-]|\d{2})", "$1:$2")
    text = F.regexp_replace(text, r"([T ]\d{2}:\d{2})(\d{2})", "$1:$2")
    text = F.regexp_replace(text, r"([T ]\d{2})(?=$|[+Z-])", "$1:00")
    text = F.when(usual, col).otherwise(F.regexp_replace(text, r"([T ]\d{2}:\d{2})(?=$|[+Z-])", "$1:00"))
    day = r"^\d{4}-\d{2}-\d{2}"
    clock = r"[T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?"
    return (
        F.when(text.rlike(f"{day}$"), F.try_to_timestamp(F.concat(text, F.lit("T00:00:00Z"))))
        .when(text.rlike(f"{day}{clock}$"), F.try_to_timestamp(F.concat(text, F.lit("Z"))))
        .when(text.rlike(rf"{day}{clock}(Z|[+-]\d{{2}}(:?\d{{2}})?)$"), F.try_to_timestamp(text))
    )


def document_id(blob_path: Column, content_path: Column) -> Column:
    """Id of a document: the same for every version of it."""
    return F.xxhash64(ci_key(blob_path), ci_key(content_path))


def explode_variant(df: DataFrame, what: str) -> DataFrame:
    """Lateral explode of a variant expression: adds e_pos, e_key, e_value; keeps rows without any."""
    return df.sparkSession.sql(
        "SELECT * FROM {rows} AS r, "
        f"LATERAL variant_explode_outer({what}) AS e(e_pos, e_key, e_value)",
        rows=df,
    )


def bind(df: DataFrame, name: str) -> DataFrame:
    """The same rows, ``name`` taken out of a lateral step of one row.

    Spark makes one method of all projections between two such steps, and HotSpot leaves a method of over 8,000 bytes to
    its interpreter: long chains of projections are some times faster in parts.
    """
    rest = ", ".join(f"r.`{c}`" for c in df.columns if c != name)
    return df.sparkSession.sql(
        f"SELECT {rest}, e.* FROM {{rows}} AS r, LATERAL inline(array(struct(r.`{name}`))) AS e(`{name}`)", rows=df)


def parse_json(files: DataFrame) -> DataFrame:
    """Replace ``value`` by ``v``: the parsed text in a one-element array, NULL when it is not JSON;
    ``unread`` tells files without a text, which their source could not read.

    The parser stops after the first value; within an array, anything that follows is an error.
    """
    return files.selectExpr(
        "* EXCEPT (value)",
        "value IS NULL AS unread",
        "CASE WHEN is_valid_utf8(value) THEN try_parse_json(concat('[', value, ']')) END AS v",
    )


def dispatch_shape(parsed: DataFrame) -> DataFrame:
    """Add ``shape`` (analyze, labels, unknown or unparsed) and the header parts ``top``, ``result``, ``meta``.

    One walk takes out all parts and tells the number of values: a path that leads nowhere costs more than one that does.
    """
    return parsed.selectExpr(
        "*",
        "try_variant_get(v, '$', 'array<struct<id:string, status:string, fileId:string, `$schema`:string, "
        "result:struct<analyzerId:string, apiVersion:string, createdAt:string>, "
        "metadata:struct<displayName:string, mimeType:string, createdDateTime:string>>>') AS w",
    ).selectExpr(
        "* EXCEPT (w)",
        "get(w, 0) AS top",
        "get(w, 0).result AS result",
        "get(w, 0).metadata AS meta",
        "coalesce(size(w), 0) AS found",
    ).selectExpr(
        "* EXCEPT (found)",
        """CASE
            WHEN result IS NOT NULL AND found = 1 THEN 'analyze'
            WHEN found <> 1 THEN 'unparsed'
            WHEN top IS NOT NULL AND variant_get(v, '$[0].fieldLabels', 'variant') IS NOT NULL
              THEN 'labels'
            ELSE 'unknown' END AS shape""",
    )


def contents(files: DataFrame) -> DataFrame:
    """One row per content entry of a good file (``e_pos``, ``e_value``), one per bad file (``problem``)."""
    rows = explode_variant(
        dispatch_shape(parse_json(files)),
        "CASE WHEN shape = 'analyze' THEN variant_get(v, '$[0].result.contents', 'variant') END",
    )
    # An entry of a list has a position and no key; anything else here is no list of contents.
    whole = "variant_get(v, '$[0].result.contents', 'variant')"
    metadata = "variant_get(v, '$[0].metadata', 'variant')"
    return rows.selectExpr(
        "*",
        f"""CASE
            WHEN unread THEN 'ReadError: the file could not be read'
            WHEN shape = 'unparsed' THEN 'ParseError: the file is not one JSON value in UTF-8'
            WHEN shape = 'unknown' THEN 'SchemaError: neither an analyze result '
              || '(result.contents) nor a labels file (fieldLabels)'
            WHEN shape = 'analyze' AND e_value IS NULL AND NOT {truthy(whole)}
              THEN 'SchemaError: the analyze result has no contents entries'
            WHEN shape = 'analyze' AND e_value IS NULL AND {is_number_or_true(whole)}
              THEN 'SchemaError: contents is not a list'
            WHEN shape = 'labels'
              AND meta IS NULL
              AND {truthy(metadata)} THEN 'SchemaError: metadata is not an object'
            END AS problem""",
    ).selectExpr(
        "*",
        "CASE WHEN shape = 'analyze' AND e_key IS NULL "
        "THEN try_variant_get(e_value, '$', 'struct<path:string>') END AS entry",
    ).filter("problem IS NOT NULL OR shape = 'labels' OR entry IS NOT NULL")


def parse_results(files: DataFrame, run_id: Column | str = "") -> DataFrame:
    """Nodes of result files (``path``, ``value``); paths of another layout are not candidates."""
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    rows = bind(contents(parse_result_paths(files)), "problem")
    is_labels = "shape = 'labels'"
    # Truth of the path, told from its text; only a text that may be no text needs the closer look.
    named = ("coalesce(CASE WHEN entry.path IN ('false', '0', '0.0', '-0.0', '[]', '{}') "
             f"THEN {tag("variant_get(e_value, '$.path', 'variant')")} = 'STRING' ELSE entry.path <> '' END, false)")
    projected = rows.selectExpr(
        *FILE, "path", "problem", "coalesce(e_pos, 0) AS pos",
        "result.analyzerId AS analyzer_id",
        f"CASE WHEN {is_labels} AND meta.displayName <> '' THEN meta.displayName "
        "ELSE file_name END AS document_name",
        f"CASE WHEN {is_labels} THEN 'labels' WHEN {named} THEN entry.path "
        "ELSE concat('input', e_pos + 1) END AS content_path",
        f"CASE WHEN {is_labels} THEN meta.mimeType END AS mime_type",
        f"CASE WHEN {is_labels} THEN meta.createdDateTime ELSE result.createdAt END AS created",
        f"CASE WHEN {is_labels} THEN top.`$schema` ELSE result.apiVersion END AS api_version",
        f"CASE WHEN {is_labels} THEN nullif(top.fileId, '') ELSE top.id END AS operation_id",
        f"CASE WHEN NOT {is_labels} THEN top.status END AS status",
        f"CASE WHEN {is_labels} THEN variant_get(v, '$[0].fieldLabels', 'variant') "
        "WHEN problem IS NULL THEN variant_get(e_value, '$.fields', 'variant') END AS root",
    ).withColumns({
        "source_created_at": iso_datetime(F.col("created")),
        "document_id": document_id(F.col("blob_path"), F.col("content_path")),
        "version_id": F.xxhash64(run, F.col("blob_path"), F.col("pos")),
    })
    keyed = projected.selectExpr(
        "* EXCEPT (created)",
        "explode(CASE WHEN problem IS NOT NULL THEN array('error') "
        "ELSE array('document', 'root') END) AS kind",
    )
    header = [f"CASE WHEN kind = 'document' THEN {c} END AS {c}" for c in HEADER]
    return keyed.selectExpr(
        "document_id", "version_id", *FILE, "pos", *header, "kind",
        "CAST(NULL AS STRING) AS field_path", "CAST(NULL AS STRING) AS field_name",
        "CAST(NULL AS STRING) AS parent_path", "CAST(NULL AS INT) AS array_index",
        "CASE WHEN kind = 'root' THEN root END AS body", "CAST(NULL AS STRING) AS node_type",
        "substring_index(problem, ':', 1) AS error_kind",
        "problem AS error_message",
    )
