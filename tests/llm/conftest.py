import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture
def docs(spark):
    """Makes a table of documents from (id, text) rows, with columns whose names an operator uses itself."""

    def make(rows, **more):
        names = ["doc_id", "text", "lang", "source", "n_chars", *more]
        kinds = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{k}` string" for k in more)
        full = [(i, t, "en", "s", None if t is None else len(t), *more.values()) for i, t in rows]
        return spark.createDataFrame(full, kinds).select(*names).repartition(3)

    return make
