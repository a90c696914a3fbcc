"""Text decoding: encoding and length of raw text files."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Encodings tried after UTF-8, in this order.
FALLBACK_ENCODINGS = ["utf-16", "cp1252", "latin-1"]


@F.pandas_udf(T.StructType().add("encoding", T.StringType()).add("chars", T.LongType()))
def _fallback(content: pd.Series) -> pd.DataFrame:
    def one(raw):
        if raw is None:
            return None, None
        for name in FALLBACK_ENCODINGS:
            try:
                return name, len(bytes(raw).decode(name))
            except UnicodeDecodeError:
                continue
        return None, None

    return pd.DataFrame([one(raw) for raw in content], columns=["encoding", "chars"])


def decode_text(files: DataFrame, wanted: Column) -> DataFrame:
    """Add ``encoding`` and ``chars`` of the files ``wanted`` selects, and drop ``content``.

    UTF-8, the usual case, stays in the JVM; only other texts are handed to Python.
    """
    text = F.col("content").cast("string")
    valid = F.is_valid_utf8(text)
    judged = files.withColumns({
        "__chars": F.when(wanted & valid, F.length(text)),
        "__other": F.when(wanted & ~valid, F.col("content")),
    }).drop("content")
    return judged.withColumn("__d", _fallback("__other")).select(
        *[c for c in judged.columns if not c.startswith("__")],
        F.when(F.col("__chars").isNotNull(), "utf-8").otherwise(F.col("__d.encoding")).alias("encoding"),
        F.coalesce(F.col("__chars").cast("long"), "__d.chars").alias("chars"),
    )


def page_equivalent(chars: Column, per_page: int, least: int = 0) -> Column:
    """Pages a text counts as; a text file counts as at least one."""
    return F.greatest(F.lit(least), F.ceil(chars / F.lit(per_page)).cast("long")).cast("long")
