"""Quality classifier by co-training of two views: what a text says and what is known about it.

The content view sees words and character classes, the metadata view language, source, length and layout. Both learn from
labelled documents. In every round each labels the documents of an unlabelled pool it is surest of, for the other to
learn from. On labelled documents held out, each view's score is calibrated, and the calibrated views are combined.
All documents are then scored where they are read.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpulse.llm.common import query, table, without
from docpulse.llm.shingles import pieces, word_hashes

OWN = ["p_content", "p_metadata", "quality", "keep"]
PUNCTUATION = b"!?.,;:-'\"|"  # classes of their own; other symbols share one
LOWER, UPPER, DIGIT, SPACE, LINE, SYMBOL, OTHER = range(7)
CLASS = np.full(256, SYMBOL, np.uint8)
CLASS[128:], CLASS[97:123], CLASS[65:91], CLASS[48:58], CLASS[[9, 32]], CLASS[[10, 13]] = OTHER, LOWER, UPPER, DIGIT, SPACE, LINE
CLASS[list(PUNCTUATION)] = range(7, 7 + len(PUNCTUATION))
CLASSES = 7 + len(PUNCTUATION)


def content_features(text: bytes) -> np.ndarray:
    """Shares of pairs of character classes, over all and at the densest in a line, and how words repeat."""
    data = np.frombuffer(text, np.uint8)
    kind = CLASS[data]
    pairs = np.bincount(kind[:-1].astype(np.int64) * CLASSES + kind[1:], minlength=CLASSES**2)
    ends = np.concatenate([np.flatnonzero(data == 10), [len(data)]])
    starts = np.concatenate([[0], ends[:-1]])
    long = np.maximum(ends - starts, 80)  # a short line's shares count for little
    densest = []
    for c in (SYMBOL, UPPER, *range(7, CLASSES)):
        sums = np.concatenate([[0], np.cumsum(kind == c)])
        densest.append(((sums[ends] - sums[starts]) / long).max())
    start, words = word_hashes(data)
    n = max(1, len(words))
    again = np.concatenate([[False], words[1:] == words[:-1]])
    runs = np.concatenate([[0], np.cumsum(again)])
    line = np.searchsorted(start, ends)
    before = np.concatenate([[0], line[:-1]])
    in_line = ((runs[line] - runs[before]) / np.maximum(line - before, 15)).max() if len(words) else 0.0
    different, counts = np.unique(words, return_counts=True)
    repeats = [again.mean() if len(words) else 0.0, in_line, counts.max() / max(n, 15) if len(words) else 0.0,
               (n - len(different)) / n, np.log1p(len(words)) / 10, float(len(words) == 0)]
    return np.concatenate([np.sqrt(pairs / max(1, len(data))), np.sqrt(densest), repeats])


def metadata_features(text: bytes, lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Language and source by hash, length, and the layout: lines, their mean length, bytes per character."""
    out = np.zeros(16 + 64 + 6)
    out[zlib.crc32((lang or "").encode()) % 16] = 1
    out[16 + zlib.crc32((source or "").encode()) % 64] = 1
    lines = text.count(b"\n") + 1
    n = max(0, n_chars or 0)
    out[80:] = [np.log1p(n) / 10, n_chars is None, np.log1p(lines) / 5, np.log1p(len(text) / lines) / 10,
                len(text) / (n + 1) if n else 0, text.count(b" ") / (len(text) + 1)]
    return out


class Logistic:
    """Logistic regression on standardised features, by Newton steps with a quadratic penalty."""

    def __init__(self, x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 12):
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-3)
        a = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        w, ridge = np.zeros(a.shape[1]), np.full(a.shape[1], penalty)
        ridge[-1] = 1e-3
        for _ in range(steps):
            p = _sigmoid(a @ w)
            s = np.maximum(p * (1 - p), 1e-5)
            w += np.linalg.solve((a * s[:, None]).T @ a + np.diag(ridge), a.T @ (y - p) - ridge * w)
        self.weight = w

    @staticmethod
    def of(parts) -> "Logistic":
        """From ``mean, scale, weight``."""
        model = Logistic.__new__(Logistic)
        model.mean, model.scale, model.weight = parts
        return model

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.scale) @ self.weight[:-1] + self.weight[-1], -30, 30)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class CoTrained:
    """Two views trained on each other's surest pseudo-labels, calibrated and combined on rows held out."""

    def __init__(self, views: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray], held: np.ndarray, rounds: int, share: float):
        train = ~held
        x, labels = [[v[train]] for v in views], [[y[train]], [y[train]]]
        open_rows = [np.arange(len(p)) for p in pool]
        for _ in range(rounds):
            models = [Logistic(np.concatenate(a), np.concatenate(b)) for a, b in zip(x, labels)]
            for own, other in ((0, 1), (1, 0)):
                rows = open_rows[own]
                if not len(rows):
                    continue
                p = _sigmoid(models[own].logit(pool[own][rows]))
                rank = np.argsort(p)
                n = max(1, int(share * len(rows)))
                bad = round(n * float((y[train] == 0).mean()))
                sure = np.concatenate([rank[:bad][p[rank[:bad]] < 0.05], rank[len(rank) - (n - bad):][p[rank[len(rank) - (n - bad):]] > 0.95]])
                x[other].append(pool[other][rows[sure]])
                labels[other].append((p[sure] > 0.5).astype(float))
                open_rows[own] = np.delete(rows, sure)
        self.models = [Logistic(np.concatenate(a), np.concatenate(b)) for a, b in zip(x, labels)]
        logits = np.column_stack([m.logit(v[held]) for m, v in zip(self.models, views)])
        self.calibrated = [Logistic(logits[:, [i]], y[held]) for i in (0, 1)]
        scores = np.column_stack([c.logit(logits[:, [i]]) for i, c in enumerate(self.calibrated)])
        self.combined = Logistic(scores, y[held])

    def parts(self) -> list[tuple]:
        """The numbers of its five regressions."""
        return [(m.mean, m.scale, m.weight) for m in (*self.models, *self.calibrated, self.combined)]

    @staticmethod
    def of(parts: list[tuple]) -> "CoTrained":
        model = CoTrained.__new__(CoTrained)
        a, b, c, d, model.combined = [Logistic.of(p) for p in parts]
        model.models, model.calibrated = [a, b], [c, d]
        return model

    def __call__(self, views: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability of good quality: by content, by metadata, combined."""
        scores = np.column_stack([c.logit(m.logit(v)[:, None]) for c, m, v in zip(self.calibrated, self.models, views)])
        return _sigmoid(scores[:, 0]), _sigmoid(scores[:, 1]), _sigmoid(self.combined.logit(scores))


def _views(batch: pa.RecordBatch, text_col: str, meta: list[str]):
    """(start, [content, metadata] features) of slices of a batch."""
    at = batch.schema.get_field_index
    for start, texts in pieces(batch.column(at(text_col))):
        known = [batch.column(at(c)).slice(start, len(texts)).to_pylist() for c in meta]
        yield start, [np.array([content_features(t) for t in texts]),
                      np.array([metadata_features(t, *k) for t, k in zip(texts, zip(*known))])]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          meta: tuple[str, str, str] = ("lang", "source", "n_chars"), labelled: int = 12_000, pool: int = 12_000,
          rounds: int = 3, share: float = 0.1) -> CoTrained | float:
    """The classifier, from ``labelled`` labelled documents and a ``pool`` of unlabelled ones at most, by order of hash.

    A third of the labelled ones is held out for calibration. Labels other than 0 and 1 and labels without a document are not
    used; of several labels for a document the highest holds. With fewer than 10 documents of either label there is
    nothing to learn: the share of good ones (1 without labels) is then every document's probability.
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.max(label_col).cast("double").alias("__y"))
    by_hash = F.xxhash64(F.lit(3), id_col)
    chosen = known.join(docs.select(id_col).hint("merge"), id_col, "left_semi").orderBy(by_hash, id_col).limit(labelled)
    others = docs.select(id_col).filter(F.col(id_col).isNotNull()).distinct().orderBy(F.xxhash64(F.lit(4), id_col), id_col).limit(pool)
    # both sides of the union are bounded by parameters, so the ids can be sent to the tasks
    wanted = chosen.unionByName(others.withColumn("__y", F.lit(None).cast("double"))).groupBy(id_col).agg(F.max("__y").alias("__y"))
    rows = docs.select(id_col, text_col, *meta).join(F.broadcast(wanted), id_col).select(id_col, "__y", text_col, *meta)
    names = list(meta)

    def features(batches):
        for batch in batches:
            for start, (content, metadata) in _views(batch, text_col, names):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(content)), batch.column(1).slice(start, len(content)),
                     pa.array([r.astype(np.float32).tobytes() for r in content], pa.binary()),
                     pa.array([r.astype(np.float32).tobytes() for r in metadata], pa.binary())], [id_col, "y", "a", "b"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = rows.mapInArrow(features, f"`{id_col}` {kind}, y double, a binary, b binary")

    # one task trains: its rows are bounded by the two parameters, as a repeated id counts once
    found = found.groupBy(id_col).agg(F.min(F.struct("y", "a", "b")).alias("r")).select(id_col, "r.*")
    train_one = lambda sample: pa.table({"model": pa.array([pickle.dumps(_fit(sample.to_pandas(), id_col, rounds, share))], pa.binary())})
    said = found.groupBy(F.lit(1).alias("one")).applyInArrow(train_one, "model binary").first()
    model = 1.0 if said is None else pickle.loads(said.model)
    return model if isinstance(model, float) else CoTrained.of(model)


def _fit(found, id_col: str, rounds: int, share: float) -> list[tuple] | float:
    """Numbers of the classifier trained on ``found`` (id, y, content and metadata features)."""
    found = found.sort_values([id_col, "a"])
    views = [np.array([np.frombuffer(r, np.float32) for r in found[c]]).astype(float) for c in ("a", "b")]
    y = found["y"].to_numpy(float)
    has = ~np.isnan(y)
    if min((y == 0).sum(), (y == 1).sum()) < 10:
        return float(y[has].mean()) if has.any() else 1.0
    held = np.zeros(has.sum(), bool)
    for value in (0, 1):  # every third of either label
        held[np.flatnonzero(y[has] == value)[::3]] = True
    return CoTrained([v[has] for v in views], y[has], [v[~has] for v in views], held, rounds, share).parts()


def score(docs: DataFrame, model: CoTrained | float, text_col: str = "text", meta: tuple[str, str, str] = ("lang", "source", "n_chars"),
          least: float = 0.5, carry: list[str] | None = None) -> DataFrame:
    """Every row with ``p_content``, ``p_metadata``, ``quality`` (the combined probability) and ``keep``.

    ``keep`` asks for a probability of ``least``. NULL texts read as empty, NULL metadata as unknown; empty texts are scored like
    any. Rows that repeat are scored each. Input columns named like the new ones give way to them. ``carry`` names the input
    columns to return, all by default.
    """
    rows = docs if carry is not None else without(docs, OWN)
    carry = rows.columns if carry is None else carry
    names = list(meta)

    def run(batches):  # the model, a few thousand numbers, goes with the function
        for batch in batches:
            for start, views in _views(batch, "__text", [f"__{c}" for c in names]):
                n = len(views[0])
                scores = [np.full(n, model)] * 3 if isinstance(model, float) else model(views)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(start, n) for i in range(len(carry))], *[pa.array(s) for s in scores],
                     pa.array(scores[2] >= least)], [*carry, *OWN])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*carry).schema],
                        "p_content double, p_metadata double, quality double, keep boolean"])
    inputs = [*[F.col(f"`{c}`") for c in carry], F.col(text_col).alias("__text"),
              *[F.col(c).cast("long" if i == 2 else "string").alias(f"__{c}") for i, c in enumerate(names)]]
    return docs.select(*inputs).mapInArrow(run, schema)


@query()
def op4_quality(spark, sf_dir):
    """All documents scored by the co-trained classifier."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")), carry=["doc_id"])
