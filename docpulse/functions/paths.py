"""Path layout ``<usecase>/<analyzer>/<file>``: parsing, suffixes, kinds and content types."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpulse import constants as C

# Last dot with at least one character on each side.
_SUFFIX = r"(?s)^.+(\.[^.]+)$"
_STEM = r"(?s)^(.+)\.[^.]+$"


def suffix(name: Column) -> Column:
    """Suffix with its dot, '' when there is none (``.env`` and ``a.`` have none)."""
    return F.regexp_extract(name, _SUFFIX, 1)


def stem(name: Column) -> Column:
    """Name without its suffix."""
    return F.when(suffix(name) == "", name).otherwise(F.regexp_extract(name, _STEM, 1))


def checked_extension(name: Column) -> Column:
    """Extension the quality gate sees: lower case, ``.bin`` for a name without suffix."""
    ext = F.lower(suffix(name))
    return F.when(ext == "", ".bin").otherwise(ext)


def _split_three(df: DataFrame, path: str, accept) -> DataFrame:
    parts = F.split(F.col(path), "/")
    third = F.try_element_at(parts, F.lit(3))
    return (
        df.filter((F.size(parts) == 3) & accept(third))
        .withColumn("usecase", F.try_element_at(parts, F.lit(1)))
        .withColumn("analyzer_name", F.try_element_at(parts, F.lit(2)))
        .withColumn("file_name", third)
    )


def parse_result_paths(df: DataFrame, path: str = "path", area: str = C.SOURCE) -> DataFrame:
    """Keep result files (three segments, ``*.json``) and add their parts and stored path."""
    out = _split_three(df, path, lambda name: F.lower(name).endswith(".json"))
    return out.withColumn("blob_path", F.concat_ws("/", F.lit(area), F.col(path)))


def is_result_path(path: str = "path") -> Column:
    """Whether ``parse_result_paths`` keeps a path; false for NULL."""
    parts = F.split(F.col(path), "/")
    return F.coalesce((F.size(parts) == 3) & F.lower(F.try_element_at(parts, F.lit(3))).endswith(".json"), F.lit(False))


def parse_raw_paths(df: DataFrame, path: str = "path", area: str = C.INCOMING) -> DataFrame:
    """Keep raw files (three segments, a dot in the name) and add their parts and stored path."""
    out = _split_three(df, path, lambda name: name.contains("."))
    return out.withColumn("blob_path", F.concat_ws("/", F.lit(area), F.col(path)))


def candidate_batch(df: DataFrame, max_files: int = C.INGEST_MAX_FILES) -> DataFrame:
    """The next ingest batch: of the first 4n paths by name, the first n of the right layout."""
    listed = df.select("path").orderBy("path").limit(4 * max_files)
    return parse_result_paths(listed).orderBy("path").limit(max_files)


def raw_candidate_batch(df: DataFrame, max_files: int = C.QUALITY_MAX_FILES) -> DataFrame:
    """The next quality batch: the cap comes before the layout test."""
    return parse_raw_paths(df.select("path").orderBy("path").limit(max_files))


def result_path(usecase: Column, analyzer: Column, file_name: Column) -> Column:
    """Where the extraction result of a raw file goes."""
    return F.concat_ws("/", usecase, analyzer, F.concat(stem(file_name), F.lit(".json")))


def detect_kind(ext: Column) -> Column:
    """pdf / image / office / text / unknown."""
    kind = F.lit("unknown")
    for name, extensions in C.KIND_EXTENSIONS.items():
        kind = F.when(ext.isin(extensions), name).otherwise(kind)
    return kind


def _literal_map(table: dict[str, str]) -> Column:
    # One SQL text instead of two calls per entry.
    items = ", ".join(f"'{k}', '{v}'" for k, v in sorted(table.items()))
    return F.expr(f"map({items})")


def mime_of(ext: Column) -> Column:
    """MIME type of an extension by the platform's standard table."""
    if not mimetypes.inited:
        mimetypes.init()
    return F.try_element_at(_literal_map(mimetypes.types_map), F.lower(ext))


def guess_mime(name: Column) -> Column:
    """MIME type of a name; an outer compression suffix is looked through."""
    if not mimetypes.inited:
        mimetypes.init()
    # ``.tgz`` and the like stand for two suffixes; the inner one tells the type.
    joint = {short: full[: full.rindex(".")] for short, full in mimetypes.suffix_map.items()}
    # The dot has to follow something other than leading dots.
    split = r"(?s)^(\.*[^.].*?)(\.[^.]*)$"
    ext = F.regexp_extract(name, split, 2)
    inner = F.regexp_extract(F.regexp_extract(name, split, 1), split, 2)
    return mime_of(
        F.when(ext.isin(sorted(joint)), F.try_element_at(_literal_map(joint), ext))
        .when(ext.isin(sorted(mimetypes.encodings_map)), inner)
        .otherwise(ext)
    )


def content_type(name: Column) -> Column:
    """Content type sent with a file: own table, then the standard one, then the default."""
    ext = F.lower(F.regexp_extract(name, r"(?s)^\.*[^.].*?(\.[^.]*)$", 1))
    own = F.try_element_at(_literal_map(C.CONTENT_TYPES), ext)
    return F.coalesce(own, guess_mime(name), F.lit(C.DEFAULT_CONTENT_TYPE))
