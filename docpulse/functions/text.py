"""Text and number helpers whose results follow Python's conventions, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ci_key(col: Column | str) -> Column:
    """Comparison key of a text: case and trailing blanks do not count."""
    return F.lower(F.rtrim(F.col(col) if isinstance(col, str) else col))


def coerce_int(col: Column) -> Column:
    """Whole number from a loosely formatted text, NULL when it is none."""
    text = F.trim(col)
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))


# Rounding to one decimal, ties to even. 20x is kept as an exact sum of two doubles (t and r), so
# that the side of the tie is known for sure: working on the decimal text of a double would turn
# 0.15 (a little below the tie) into 0.2. Each step binds its value once.
_ROUND_TENTH = """x -> transform(array(x * 16 + x * 4), t ->
    transform(array(double(floor(t / 2))), low ->
        transform(array((t - low * 2) - 1 + (x * 4 - (t - x * 16))), side ->
            (low + CASE WHEN side > 0 THEN 1 WHEN side < 0 THEN 0 ELSE abs(low % 2) END) / 10)[0])[0])[0]"""


def round_tenth(x: Column) -> Column:
    """``x`` rounded to one decimal, exactly, ties to even."""
    return F.get(F.call_function("transform", F.array(x.cast("double")), F.expr(_ROUND_TENTH)), F.lit(0))


def tenth_text(x: Column) -> Column:
    """``x`` with exactly one decimal; NULL stays NULL."""
    return F.when(x.isNotNull(), F.format_string("%.1f", round_tenth(x)))


def whole_text(x: Column) -> Column:
    """``x`` without decimals, ties to even."""
    return F.rint(x).cast("bigint").cast("string")


def grouped_text(x: Column) -> Column:
    """A whole number with thousands separators."""
    return F.format_number(x, 0)


def float_text(x: Column) -> Column:
    """Shortest text of a double: plain from 1e-4 up to 1e16, exponent form beyond."""
    java = x.cast("string")
    plain = F.regexp_replace(x.try_cast("decimal(38,21)").cast("string"), r"0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    digits = F.regexp_replace(F.regexp_extract(java, r"^(-?[0-9.]+)", 1), r"\.0$", "")
    sign = F.when(F.regexp_extract(java, r"E(-?)", 1) == "-", "-").otherwise("+")
    power = F.lpad(F.regexp_extract(java, r"E-?([0-9]+)$", 1), 2, "0")
    power = F.when(F.abs(x) >= 1e100, F.regexp_extract(java, r"E-?([0-9]+)$", 1)).when(
        (F.abs(x) < 1e-99) & (x != 0), F.regexp_extract(java, r"E-?([0-9]+)$", 1)
    ).otherwise(power)
    return (
        F.when(x.isNull(), None)
        .when(F.isnan(x), "nan")
        .when(x == float("inf"), "inf")
        .when(x == float("-inf"), "-inf")
        .when(x == 0, F.when(java.startswith("-"), "-0.0").otherwise("0.0"))
        .when((F.abs(x) >= 1e-4) & (F.abs(x) < 1e16), plain)
        .otherwise(F.concat(digits, F.lit("e"), sign, power))
    )


def json_text(col: Column) -> Column:
    """A text as a JSON string literal."""
    return F.btrim(F.to_json(F.array(col)), F.lit("[]"))


def json_object(pairs: list[tuple[str, Column]], full: bool = False) -> Column:
    """JSON object from (key, JSON text of the value) pairs; NULL values leave their key out.

    With ``full`` some value is never NULL, and the test for an empty object, which holds each value once more, is left out:
    nested objects would otherwise grow by a power of two.
    """
    parts = [F.concat(F.lit(f'"{key}": '), value.cast("string")) for key, value in pairs]  # NULL for a NULL value
    body = F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    return body if full else F.when(F.coalesce(*parts).isNotNull(), body)


def json_list(items: Column) -> Column:
    """JSON array from an array of JSON texts."""
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def utf16_length(col: Column) -> Column:
    """Length in UTF-16 units, the measure of the stored column widths."""
    return F.length(F.encode(col, "UTF-16BE")) / 2


def too_wide(col: Column, width: int) -> Column:
    """True when a text does not fit ``width`` UTF-16 units; short texts are not encoded."""
    return F.when(F.length(col) <= width // 2, False).otherwise(
        F.coalesce(utf16_length(col) > width, F.lit(False))
    )
