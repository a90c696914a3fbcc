"""Type tests on VARIANT columns as short SQL texts.

Taking a part out as a variant builds it anew, so hot paths read scalars by path, look at nodes
through a one-field struct, and walk containers with ``variant_explode``, which only slices.
"""

from __future__ import annotations


def text(v: str) -> str:
    """Text of a scalar, JSON text of a list or object, NULL for null."""
    return f"variant_get({v}, '$', 'string')"


def tag(v: str) -> str:
    """Type name of a value."""
    return f"schema_of_variant({v})"


def truthy(v: str) -> str:
    """False for missing, null, false, zero, empty text, empty array and empty object."""
    return (
        f"coalesce(CASE WHEN {text(v)} IN ('false', '0', '0.0', '-0.0', '[]', '{{}}') "
        f"THEN {tag(v)} = 'STRING' ELSE {text(v)} <> '' END, false)"
    )


def is_number_or_true(v: str) -> str:
    """True for a non-zero number or the boolean true: values that cannot be iterated."""
    return f"(coalesce({tag(v)} RLIKE '^(BOO|BIG|DEC|DOU)', false) AND {truthy(v)})"
