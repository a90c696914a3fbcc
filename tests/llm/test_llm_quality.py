import random

import numpy as np
from pyspark.sql import functions as F

from docpulse.llm.quality import OWN, Logistic, content_features, score, train

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    unseen = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    model = train(docs, labels.filter(~unseen), labelled=2000, pool=2000)
    got = score(docs, model, carry=["doc_id"]).join(labels.filter(unseen).select("doc_id", F.col("quality").alias("y")), "doc_id").toPandas()
    right = (got.keep == (got.y == 1)).mean()
    assert right > 0.98
    assert right >= ((got.p_content >= 0.5) == (got.y == 1)).mean()


def test_reruns_agree(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    runs = [score(docs.repartition(n), train(docs.repartition(n), labels, labelled=60, pool=60), carry=["doc_id"]).toPandas() for n in (1, 5)]
    a, b = (r.sort_values("doc_id")["quality"].to_numpy() for r in runs)
    assert np.allclose(a, b)


def test_edge_cases(docs, spark):
    rows = [(1, None), (2, ""), (3, "x " * 100_000), (4, "é"), (None, "text"), (5, "same"), (5, "same"), (6, "\n\n")]
    df = docs(rows, keep="clash", quality="clash").withColumn("lang", F.lit(None).cast("string"))
    r = random.Random(1)
    good = [(100 + i, " ".join(r.choice(["one", "two", "three", "four"]) for _ in range(50))) for i in range(60)]
    bad = [(200 + i, "### " * r.randint(20, 60)) for i in range(60)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(999, 1), (None, 0), (100, None), (101, 7)], "doc_id long, quality int")
    model = train(docs(good + bad), labels)
    got = score(df, model)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", *OWN]
    rows_ = got.collect()
    assert len(rows_) == len(rows) and all(0 <= r.quality <= 1 for r in rows_)
    again = score(docs(good + bad), model).collect()
    assert sum(r.keep == (r.doc_id < 200) for r in again) >= 118
    assert score(docs([]), model).count() == 0


def test_nothing_to_learn_from(docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert train(docs([(1, "a")]), none) == 1.0
    assert score(docs([(1, "a")]), 1.0).first().keep
    assert train(docs([]), none) == 1.0


def test_labels_without_documents_take_no_room(docs, spark):
    rows = [(i, f"one two three {i}" if i % 2 else "### " * (20 + i)) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20_000)], "doc_id long, quality int")
    assert not isinstance(train(docs(rows), labels, labelled=80, pool=80), float)


def test_features_are_finite():
    for text in (b"", b"\n", b"a", b"\xff" * 10, b"a b " * 10_000):
        assert np.isfinite(content_features(text)).all()


def test_logistic_separates():
    x = np.random.default_rng(1).normal(size=(400, 3))
    y = (x[:, 0] + 0.1 * x[:, 1] > 0).astype(float)
    assert ((Logistic(x, y).logit(x) > 0) == (y == 1)).mean() > 0.97
