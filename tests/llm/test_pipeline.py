"""The pipeline next to a plain version of each stage on its own input."""

from collections import Counter

import corpus_pipeline
import pytest
from brute import near_components
from tokenizers import Tokenizer

from docpulse.llm.bpe import tokenizer_path
from docpulse.llm.mixing import mix
from docpulse.llm.quality import score, train

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    again = docs.limit(3)
    docs = docs.unionByName(again)  # repeated rows
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        rows = after.collect()
        out[name] = (docs.collect(), rows, docs)
        docs = spark.createDataFrame(rows, after.schema)
    return out


def test_quality(spark, stages):
    before, after, docs = stages["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    said = Counter((r.doc_id, r.keep) for r in score(docs, train(docs, labels), carry=["doc_id"]).collect())
    assert Counter(r.doc_id for r in after) == Counter({i: n for (i, keep), n in said.items() if keep})
    quality = {r.doc_id: r.quality for r in labels.collect()}
    kept = {r.doc_id for r in after}
    known = [r.doc_id for r in before if r.doc_id in quality]
    assert sum((i in kept) == (quality[i] == 1) for i in known) >= 0.95 * len(known)


def test_exact_dedup(stages):
    before, after, _ = stages["exact dedup"]
    best = {}
    for r in before:
        best[r.text] = max(best.get(r.text, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(best.values())
    assert {r.text for r in after} == {r.text for r in before}


def test_near_dedup(stages):
    before, after, _ = stages["near dedup"]
    found = near_components([(r.doc_id, r.text) for r in before], 5, 80, 100)
    assert sorted(r.doc_id for r in after) == sorted(i for i, _, c in found if i == c)


def test_source_mix(stages):
    before, after, docs = stages["source mix"]
    taken = {r.doc_id: (r.taken, r.size) for r in mix(docs).collect()}
    times = Counter(r.doc_id for r in after)
    for r in before:
        words, size = taken[r.doc_id]
        assert abs(times[r.doc_id] - words / max(size, 1)) <= 0.5 and times[r.doc_id] <= 3


def test_bpe(stages):
    import hashlib

    before, after, _ = stages["bpe"]
    library, want = Tokenizer.from_file(tokenizer_path()), []
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in before:
        ids = library.encode(r.text, add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, after)) == sorted(want)


def test_run_is_its_stages(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))


def test_odd_rows_pass(spark):
    rows = [(1, None, None, None, None), (None, "text", "en", "s", 4), (2, "", "", "", 0), (2, "", "", "", 0), (3, "w " * 60_000, "en", "s", 120_000),
            (4, "a b c", None, None, None), (5, "a b c", "en", None, 5)]
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, keep string, taken string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_near_dedup_judges_texts_that_share_an_id(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, one), (2, one + " x"), (2, "c d e f g h"), (3, two), (3, two + " y"), (None, "p q r s t u"), (4, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()]
    assert {(1, one), (2, "c d e f g h"), (None, "p q r s t u"), (4, None)} < set(kept)
    assert len(kept) == 5 and len({(3, two), (3, two + " y")} & set(kept)) == 1
