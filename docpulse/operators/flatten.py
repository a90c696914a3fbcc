"""Field trees of any depth to one row per leaf field.

A step opens every container by one level and lets leaves pass, so a chain of steps is one narrow
stage: no join, no union, no shuffle, no Python. The chain covers ``levels`` levels; trees that go
deeper leave container rows over, which ``plans.ingest.stage`` opens in further rounds on just these.

Containers are of kind ``root``, ``object`` (an entry of a map), ``item`` (an object in a list) or
``array``. One whose value is not of its kind becomes ``odd_...`` and is judged at the end: most
are simply empty and vanish, a few make the file unusable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from docpulse.functions.variants import is_number_or_true, truthy
from docpulse.operators.parse import NODE, bind, explode_variant

LEVELS = 6
FEW = 2  # most files are no deeper, and every level a chain has costs each of its rows

CONTAINER = "kind IN ('object', 'item', 'array')"


def _apart(nodes: DataFrame, container: str, kept: str) -> DataFrame:
    """``body`` as ``opened`` for container rows, which the explode uses up, and as ``kept`` for what passes it.

    Otherwise every child row would carry a copy of the container it comes from.
    """
    return nodes.selectExpr(
        "* EXCEPT (body)",
        f"CASE WHEN {container} THEN body END AS opened",
        f"CASE WHEN NOT ({container}) THEN body {kept} END AS kept",
    )


def _children(nodes: DataFrame, container: str) -> DataFrame:
    """Replace the container rows, whose ``body`` is a map or list, by one row per child node."""
    rest = [c for c in nodes.columns if c not in [*NODE, "kind"]]
    # Of a container itself only what ``judge_odd`` may find fault with stays: a list's value that is a number or true,
    # and a map that is none.
    odd = """WHEN kind = 'array' THEN CASE WHEN try_variant_get(body, '$', 'boolean') THEN body END
        WHEN try_variant_get(body, '$', 'struct<type:string>') IS NULL THEN body"""
    opened = explode_variant(_apart(nodes, container, odd), "opened")
    # A list has children without a key, a map has children with one; a child must be an object.
    return opened.selectExpr(
        "*",
        f"""CASE WHEN {container} AND e_value IS NOT NULL AND (kind = 'array') = (e_key IS NULL)
            THEN 1 ELSE 0 END AS fresh""",
        f"CASE WHEN {container} THEN variant_get(e_value, '$.type', 'string') END AS t",
    ).selectExpr(
        # A typed node is an object for sure; only an untyped one needs the closer look.
        "*",
        """CASE WHEN fresh = 0 THEN false WHEN t IS NOT NULL THEN true
            ELSE try_variant_get(e_value, '$', 'struct<type:string>') IS NOT NULL END AS node""",
    ).filter("node OR fresh = 0 AND kind <> 'object'").selectExpr(
        *rest,
        f"""CASE WHEN fresh = 0 THEN CASE WHEN {container} THEN concat('odd_', kind) ELSE kind END
            WHEN t = 'object' THEN CASE WHEN kind = 'array' THEN 'item' ELSE 'object' END
            WHEN t = 'array' THEN 'array'
            ELSE 'leaf' END AS kind""",
        """CASE WHEN fresh = 0 THEN field_path
            WHEN kind = 'array' THEN concat(field_path, '[', e_pos, ']')
            WHEN coalesce(field_path, '') = '' THEN e_key
            ELSE concat(field_path, '.', e_key) END AS field_path""",
        """CASE WHEN fresh = 0 THEN field_name
            WHEN kind = 'array' THEN concat(field_name, '[', e_pos, ']')
            ELSE e_key END AS field_name""",
        "CASE WHEN fresh = 0 THEN parent_path ELSE field_path END AS parent_path",
        "CASE WHEN fresh = 1 AND kind = 'array' THEN e_pos ELSE array_index END AS array_index",
        "CASE WHEN fresh = 0 THEN kept ELSE e_value END AS body",
        "CASE WHEN fresh = 0 THEN node_type ELSE t END AS node_type",
    )


def open_roots(nodes: DataFrame) -> DataFrame:
    """Replace the field map of each document by its entries."""
    return _children(nodes, "kind = 'root'")


def open_level(nodes: DataFrame) -> DataFrame:
    """Replace each container node by its children; other rows stay as they are."""
    inner = explode_variant(_apart(nodes, CONTAINER, ""), "opened").filter(
        f"""CASE WHEN kind = 'array' THEN e_key = 'valueArray'
            WHEN {CONTAINER} THEN e_key = 'valueObject' ELSE true END"""
    )
    return _children(
        inner.selectExpr(
            "* EXCEPT (opened, kept, e_pos, e_key, e_value)",
            f"CASE WHEN {CONTAINER} THEN e_value ELSE kept END AS body",
        ),
        CONTAINER,
    )


def judge_odd(nodes: DataFrame) -> DataFrame:
    """Drop empty containers; a map, list item or list value of a wrong shape spoils the file."""
    bad = (
        f"(kind IN ('odd_root', 'odd_item') AND {truthy('body')} "
        f"OR kind = 'odd_array' AND {is_number_or_true('body')})"
    )
    return bind(nodes, "kind").filter(f"kind NOT LIKE 'odd%' OR {bad}").selectExpr(
        "* EXCEPT (kind, error_kind, error_message)",
        "CASE WHEN kind LIKE 'odd%' THEN 'error' ELSE kind END AS kind",
        "CASE WHEN kind LIKE 'odd%' THEN 'SchemaError' ELSE error_kind END AS error_kind",
        """CASE WHEN kind = 'odd_root' THEN 'SchemaError: the field map is not an object'
            WHEN kind LIKE 'odd%' THEN 'SchemaError: a list item or list value has the wrong shape'
            ELSE error_message END AS error_message""",
    )


def flatten_nodes(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Open roots and up to ``levels`` levels below.

    Leaves have kind ``leaf``; containers further down remain as rows.
    """
    nodes = open_roots(nodes)
    for _ in range(levels):
        nodes = open_level(nodes)
    return judge_odd(nodes)


def remaining(nodes: DataFrame) -> DataFrame:
    """Containers a chain of steps did not reach."""
    return nodes.filter(CONTAINER)
