"""Toxicity by non-negative positive-unlabelled learning.

The classifier sees confirmed toxic documents (P) and documents without a label (U),
never negatives. With class prior pi and logistic loss l its risk is

    pi * E_P[l(+1)] + max(0, E_U[l(-1)] - pi * E_P[l(-1)]),

where the second term estimates the risk on the unseen negatives; when it falls
below zero, training steps back on it instead of fitting it further. pi is
the toxic share of the labelled training rows.

Features are words and word beginnings that are far more frequent in P than in U. Fitting
uses at most about ``max_positive`` and ``max_unlabelled`` documents, chosen by a hash
of their id; only counts, the chosen features and their occurrences in these documents
reach the driver. Scoring looks a document's distinct words up in the chosen features.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import bounded_batches, held_out, map_arrow, stored, table, text_parts, text_slices, widened

FOLDS = 5
#: Documents that fitting looks at (in expectation), and features it may choose among and keep.
MAX_POSITIVE, MAX_UNLABELLED, MAX_CANDIDATES, MAX_FEATURES = 20_000, 40_000, 30_000, 2_000
BEGINNING = 5
_EDGE = re.compile(r"[\s.,;:!?\"'()\[\]#*$%&|<>]+")


def features(text: str) -> Counter:
    """Occurrences of each word and word beginning, lower case, without punctuation."""
    words = Counter(_EDGE.split(text.lower()))
    del words[""]
    for word, n in list(words.items()):
        if len(word) > BEGINNING:
            words["^" + word[:BEGINNING]] += n
    return words


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str) -> float:
        words = _EDGE.split(text.lower())
        distinct = set(words)
        starts = {"^" + w[:BEGINNING] for w in distinct if len(w) > BEGINNING}
        z, known = self.bias, self.weights.keys()
        for name in sorted(known & distinct):
            z += self.weights[name] * min(3, words.count(name))
        for name in sorted(known & starts):
            z += self.weights[name] * min(3, sum(len(w) > BEGINNING and w.startswith(name[1:]) for w in words))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def fit_nnpu(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, positive: np.ndarray, n_features: int, prior: float, steps: int = 400, rate: float = 0.1, l2: float = 2e-4) -> tuple[np.ndarray, float]:
    """Weights and bias; the matrix is sparse, ``positive`` says which rows are P (all others are U)."""
    w, b = np.zeros(n_features), np.log(prior / (1 - prior))
    n_p, n_u = max(1, positive.sum()), max(1, (~positive).sum())
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        z = np.bincount(rows, vals * w[cols], len(positive)) + b
        s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        loss_neg = np.logaddexp(0, z)  # l(-1); its slope is s, that of l(+1) is s - 1
        negatives = loss_neg[~positive].sum() / n_u - prior * loss_neg[positive].sum() / n_p
        neg_slope = np.where(positive, -prior * s / n_p, s / n_u)
        slope = neg_slope + np.where(positive, prior * (s - 1) / n_p, 0) if negatives >= 0 else -neg_slope
        g = np.append(np.bincount(cols, vals * slope[rows], n_features) + l2 * w, slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Learn from the rows of ``docs(doc_id, text)`` and ``labels(doc_id, toxic)`` outside fold 0.

    Rows without id or label value are ignored; a document labelled twice counts as
    toxic if any label says so. Without labelled documents, or without features that set
    them apart, the model is the prior alone (0.5 of one document without any label).
    """
    bounded_batches(docs.sparkSession)
    share = lambda n, of: min(1.0, of / max(1, n))
    pick = lambda part: F.pmod(F.xxhash64(F.lit("pu"), "doc_id"), F.lit(1 << 30)) < int(part * (1 << 30))
    train = ~held_out(F.col("doc_id"), FOLDS)
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n_known, n_toxic = known.filter(train & F.col("toxic").isNotNull()).agg(F.count("*"), F.sum(F.col("toxic").cast("long"))).first()
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull() & train)
    n_rest = ids.count() - n_known
    prior = min(0.9, max(0.001, ((n_toxic or 0) + 0.5) / (n_known + 1)))
    toxic = known.filter(train & (F.col("toxic") == 1) & pick(share(n_toxic or 0, max_positive))).select("doc_id", F.lit(1).alias("y"))
    rest = ids.filter(pick(share(n_rest, max_unlabelled))).join(known, "doc_id", "left_anti").select("doc_id", F.lit(0).alias("y"))
    chosen = stored(toxic.union(rest.distinct()), "toxic-sample")
    sample = stored(
        docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id"), "toxic-texts"
    )

    def count(wanted):
        """Documents that hold each feature, summed per task; all features if none are named."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n: Counter = Counter()
            for part in text_slices(batches, "text"):
                for t in part.column("text").to_pylist():
                    found = features(t).keys()
                    n.update(found if wanted is None else found & wanted.value)
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["feature", "n"])

        return run

    spark = docs.sparkSession
    by = lambda y, wanted: map_arrow(sample.filter(F.col("y") == y).select("text"), count(wanted), "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    found = by(1, None).filter("n >= 3").orderBy(F.desc("n"), "feature").limit(MAX_CANDIDATES).collect()
    sizes = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n_p, n_u = sizes.get(1, 0), sizes.get(0, 0)
    if not found or not n_u:
        return Model({}, float(np.log(prior / (1 - prior))))
    seen = {r.feature: r.n for r in by(0, spark.sparkContext.broadcast(frozenset(r.feature for r in found))).collect()}
    ranked = []
    for r in found:
        p, u = r.n / n_p, seen.get(r.feature, 0) / n_u
        z = (p - u) / np.sqrt(p * (1 - p) / n_p + max(u * (1 - u), 1 / n_u) / n_u + 1e-12)
        if z > 3 and p > 2 * u:
            ranked.append((-z, r.feature))
    names = [f for _, f in sorted(ranked)[:MAX_FEATURES]]
    if not names:
        return Model({}, float(np.log(prior / (1 - prior))))
    place = spark.sparkContext.broadcast({f: i for i, f in enumerate(names)})

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = place.value
        for part in text_slices(batches, "text"):
            hits = [[(at[f], min(3, n)) for f, n in features(t).items() if f in at] for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("y"), pa.array([[c for c, _ in h] for h in hits], pa.list_(pa.int32())), pa.array([[v for _, v in h] for h in hits], pa.list_(pa.int32()))],
                names=["y", "cols", "vals"],
            )

    matrix = map_arrow(sample.select("y", "text"), occurrences, "y int, cols array<int>, vals array<int>")
    matrix = sorted(matrix.collect(), key=lambda r: (r.y, r.cols, r.vals))  # the fit adds up in one order
    rows = np.repeat(np.arange(len(matrix)), [len(r.cols) for r in matrix])
    cols = np.fromiter((c for r in matrix for c in r.cols), np.int64)
    vals = np.fromiter((v for r in matrix for v in r.vals), np.float64)
    w, b = fit_nnpu(rows, cols, vals, np.array([r.y == 1 for r in matrix]), len(names), prior)
    return Model(dict(zip(names, map(float, w))), b)


def score(docs: DataFrame, model: Model, name: str = "toxicity", text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with the probability ``name``, in place of a column of this name; null and empty texts get the bias alone.

    The text goes to Python once, in small batches; without ``keep_text`` it doesn't come back.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(name) if name != text else docs.withColumnRenamed(text, "_tox_text")
    column = text if name != text else "_tox_text"
    carried = [c for c in kept.columns if c != column or keep_text and name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_parts(batches, column):
            scores = [shared.value.score(t) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(c) for c in carried] + [pa.array(scores, pa.float64())], names=[*carried, name])

    return map_arrow(kept, run, widened(kept.select(*carried), f"`{name}` double"))


def op7_nnpu_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = score(docs, model, "score", keep_text=False)
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


QUERIES = {"op7_nnpu_toxicity": (op7_nnpu_toxicity, None)}
