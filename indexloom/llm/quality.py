"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

Each text is read once for a vector of statistics. Standardised vectors x go through
cos(W x + b) with Gaussian W, whose inner products approximate a Gaussian kernel. The
ridge solution needs only Z'Z and Z'y, which each task sums over its rows; the
driver adds one matrix per task (at most ``TASKS``) and solves. Ridge scores of rows kept
out of the fit are counted per bin and label, and pooling adjacent violators over the bins
gives a monotone map to probabilities, interpolated between the pools so that ranks stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import held_out, map_arrow, stored, table, text_bytes, text_slices, widened

FOLDS = 5
#: Labelled rows that fitting uses (in expectation), tasks that sum them, random features, bins of the calibration.
MAX_LABELLED, TASKS, FEATURES, BINS = 200_000, 32, 256, 1_000
SEED = 11
STATS = (
    "log_chars", "log_words", "word_chars", "upper", "digit", "symbol", "exclaim", "point", "space", "accent",
    "log_line", "distinct", "echo", "same_lines",
)
LOWER, UPPER_, DIGIT, SYMBOL, EXCLAIM, POINT, SPACE, ACCENT, REST = range(9)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    kinds = np.full(0x110000, REST, np.uint8)
    for c in range(0x250):
        ch = chr(c)
        kinds[c] = (
            SYMBOL if ch in "#*$%&|<>" else EXCLAIM if ch == "!" else POINT if ch in ".,;:?" else SPACE if ch.isspace()
            else DIGIT if ch.isdigit() else UPPER_ if ch.isupper() else LOWER if c < 128 and ch.isalpha() else ACCENT if ch.isalpha() else REST
        )
    return kinds


def statistics(text: pa.StringArray) -> np.ndarray:
    """One row of STATS per text; an empty text has zeros."""
    raw, bounds = text_bytes(text)
    n = len(text)
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    kinds = _kinds()[points]
    starts = np.searchsorted(np.flatnonzero((raw & 0xC0) != 0x80), bounds)
    counts = np.stack([np.diff(np.append(0, np.cumsum(kinds == k))[starts]) for k in range(9)], axis=1).astype(np.float64)
    chars = counts.sum(axis=1)
    out = np.zeros((n, len(STATS)))
    for i, t in enumerate(text.to_pylist()):
        words, lines = t.split(), [x for x in t.split("\n") if x]
        n_words = len(words)
        if not n_words:
            continue
        share = counts[i] / chars[i]
        out[i] = (
            np.log1p(chars[i]), np.log1p(n_words), (chars[i] - counts[i, SPACE]) / n_words, share[UPPER_], share[DIGIT], share[SYMBOL],
            share[EXCLAIM], share[POINT], share[SPACE], share[ACCENT], np.log1p(chars[i] / max(1, len(lines))),
            np.log(len(set(words))) / np.log(n_words + 1), sum(map(eq, words, words[1:])) / n_words, 1 - len(set(lines)) / max(1, len(lines)),
        )
    return out


def document_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text but with ``stats`` (array of double)."""
    kept = docs.drop("stats") if text == "stats" else docs.drop("stats", text)
    carried = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "_stat_text"):
            values = statistics(part.column("_stat_text"))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, len(STATS)), pa.int32()), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(c) for c in carried] + [lists], names=[*carried, "stats"])

    with_text = docs.select(*carried, F.col(text).alias("_stat_text"))
    return map_arrow(with_text, run, widened(kept, "stats array<double>"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATS))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = np.sqrt(2 / len(self.phases)) * np.cos(x @ self.directions + self.phases)
        return np.hstack([z, np.ones((len(z), 1))])

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        return self.fourier(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.ridge(stats), self.knots, self.levels), 0, 1)


def pool_adjacent(x: np.ndarray, good: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic fit over points sorted by x: mean place and level of each pool."""
    pools: list[list[float]] = []
    for place, g, k in zip(x, good, n):
        pools.append([place * k, g, k])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    a = np.array(pools)
    return a[:, 0] / a[:, 2], a[:, 1] / a[:, 2]


def fit(stats: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, width: float = 4.0, ridge: float = 1e-3) -> Model:
    """Learn from ``stats(doc_id, stats)`` and ``labels(doc_id, quality)`` outside fold 0.

    Scale and centre come from all documents. Of the labelled rows one fold calibrates and
    the rest fit. Rows without id or label value are ignored; of two labels of a document the
    higher counts. Without labelled rows every score is 0.5.
    """
    k = len(STATS)
    one = stats.agg(*(F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(k)), *(F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(k))).first()
    mean = np.array([one[i] or 0.0 for i in range(k)])
    scale = np.array([max(one[k + i] or 0.0, 1e-3) for i in range(k)])
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"), FOLDS))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("y"))
    part = min(1.0, max_labelled / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 30)) < int(part * (1 << 30)))
    rows = stored(
        stats.select("doc_id", "stats").join(chosen, "doc_id").select("stats", F.col("y").cast("double").alias("y"), (F.pmod(F.xxhash64(F.lit("cal"), "doc_id"), F.lit(4)) == 0).alias("cal")),
        "quality-rows",
    )
    rng = np.random.default_rng(SEED)
    blank = Model(mean, scale, rng.normal(size=(k, FEATURES)) / width, rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.array([0.0]), np.array([0.5]))
    d = FEATURES + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zz, zy = np.zeros((d, d)), np.zeros(d)
        for batch in batches:
            z = blank.fourier(_matrix(batch.column("stats")))
            zz += z.T @ z
            zy += z.T @ batch.column("y").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([zz.tobytes()]), pa.array([zy.tobytes()])], names=["zz", "zy"])

    parts = map_arrow(rows.filter("not cal").select("stats", "y").coalesce(TASKS), sums, "zz binary, zy binary").collect()
    zz = sum((np.frombuffer(p.zz).reshape(d, d) for p in parts), np.zeros((d, d)))
    zy = sum((np.frombuffer(p.zy) for p in parts), np.zeros(d))
    if not zz[-1, -1]:
        return blank
    weights = np.linalg.solve(zz + ridge * zz[-1, -1] / FEATURES * np.eye(d), zy)
    fitted = Model(mean, scale, blank.directions, blank.phases, weights, blank.knots, blank.levels)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.clip(np.rint(fitted.ridge(_matrix(batch.column("stats"))) * BINS), -BINS, 2 * BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("y")], names=["bin", "y"])

    binned = map_arrow(rows.filter("cal").select("stats", "y"), raw, "bin long, y double").groupBy("bin").agg(F.sum("y").alias("good"), F.count("*").alias("n"))
    points = binned.orderBy("bin").collect()  # at most 3 * BINS rows
    if not points:
        return Model(mean, scale, blank.directions, blank.phases, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    knots, levels = pool_adjacent(np.array([p.bin / BINS for p in points]), np.array([p.good for p in points]), np.array([float(p.n) for p in points]))
    # A slope too small to matter keeps ranks beyond and between the pools apart.
    knots = np.concatenate([[min(-1.0, knots[0] - 1)], knots, [max(2.0, knots[-1] + 1)]])
    levels = np.concatenate([[levels[0] * 0.5], levels, [levels[-1] + 0.5 * (1 - levels[-1])]])
    return Model(mean, scale, blank.directions, blank.phases, weights, knots, levels)


def score(stats: DataFrame, model: Model, name: str = "quality") -> DataFrame:
    """``stats`` with the probability of label 1 as ``name`` in place of the statistics; an empty text is scored by its zeros."""
    shared = stats.sparkSession.sparkContext.broadcast(model)
    kept = stats.drop("stats", name)
    carried = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score(_matrix(batch.column("stats")))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in carried] + [pa.array(scores)], names=[*carried, name])

    return map_arrow(stats.select(*carried, "stats"), run, widened(kept, f"`{name}` double"))


def op4_fourier_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = stored(document_statistics(docs), "quality-stats")
    model = fit(stats, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    scored = score(stats, model, "score")
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


QUERIES = {"op4_fourier_quality": (op4_fourier_quality, None)}
