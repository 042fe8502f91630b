"""Hard negatives of anchor vectors by Strassen multiplication of integer tiles.

Vectors become integers, floor(256 x), and a score is an exact inner product. Anchors and
candidates meet in a grid: candidates are dealt over rows of cells by their id, anchors over columns
of at most ``ANCHORS``. A cell first takes its anchors and then streams its candidates by
id in chunks; each tile of the two is multiplied by Strassen's recursion, with odd sides padded by
a row of zeros, in int64 (which is exact as long as the products fit: additions wrap around and come back).
A first pass keeps for each anchor the best of its own label, where only rows of one label are
multiplied; merged, they are its positives. A second pass keeps for each positive the best rows of
other labels within its window. Heaps of cells merge by (score, id), so a cell sends a few rows
per anchor however many candidates it saw, and no task holds more than a column of anchors, their heaps
and one chunk. Work is anchors times rows, as the question demands; labels play no part in dealing,
so a frequent one is no hot spot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexloom.llm.common import map_arrow, stored, table

#: Side at which the recursion multiplies directly; anchors of a tile; candidates of a chunk.
LEAF, TILE, CHUNK = 16, 512, 2_048
#: Anchors of a column of cells, and candidates of a row: small ones up to ``FEW`` rows of cells, larger ones beyond.
ANCHORS, CELL, FEW, LARGE = 16_384, 8_192, 256, 262_144
SCALE = 256
LIMIT = (1 << 63) - 1
NONE = -LIMIT - 1


def _padded(x: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """``x`` with zeros below and to the right (Python's own in a matrix of objects)."""
    if x.shape == (rows, columns):
        return x
    out = np.zeros((rows, columns), x.dtype)
    out[: x.shape[0], : x.shape[1]] = x
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two integer matrices by seven products of halves."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    a, b = _padded(a, m + m % 2, k + k % 2), _padded(b, k + k % 2, n + n % 2)
    h, i, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * h, 2 * j), p1.dtype)
    out[:h, :j] = p1 + p4 - p5 + p7
    out[:h, j:] = p3 + p5
    out[h:, :j] = p2 + p4
    out[h:, j:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def integers(column: pa.ListArray) -> np.ndarray:
    """One row of floor(256 x) per vector, shorter vectors filled up by zeros; Python integers where int64 is too small."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if np.abs(flat).max(initial=0) < 2.0**54:
        values = np.floor(flat * SCALE).astype(np.int64)
    else:  # such a value is a whole number
        values = np.array([int(x) * SCALE if abs(x) >= 2.0**53 else int(np.floor(x * SCALE)) for x in flat.tolist()], object)
    width = int(sizes.max(initial=0))
    out = np.zeros((len(sizes), width), values.dtype)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of two sets of rows as int64; beyond that range they are held at its ends."""
    width = max(a.shape[1], b.shape[1])
    a, b = _padded(a, len(a), width), _padded(b, len(b), width)
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    top = lambda x: max(abs(int(x.max())), abs(int(x.min())))
    if a.dtype != object and b.dtype != object and top(a) * top(b) * width <= LIMIT:
        return strassen(a, b.T)
    return np.clip(strassen(a.astype(object), b.T.astype(object)), -LIMIT, LIMIT).astype(np.int64)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k of the last axis by score, descending; equal ones keep their order."""
    order = np.argsort(~score, axis=-1, kind="stable")[..., :k]
    return np.take_along_axis(score, order, -1), np.take_along_axis(ids, order, -1)


class Anchors:
    """The anchors of one cell."""

    def __init__(self, batch: pa.Table) -> None:
        batch = batch.combine_chunks()
        self.ids, self.labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
        self.vectors = integers(_single(batch, "v"))
        self.positives = batch.column("positives").to_pylist()


def _single(batch: pa.Table, name: str) -> pa.Array:
    column = batch.column(name)
    return column.chunk(0) if column.num_chunks else pa.array([], column.type)


class PositiveHeaps:
    """For each anchor the best other rows of its label."""

    def __init__(self, anchors: Anchors, k: int) -> None:
        self.anchors, self.k = anchors, k
        self.score = np.full((len(anchors.ids), k), NONE, np.int64)
        self.ids = np.zeros_like(self.score)

    def take(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        for label in np.intersect1d(labels, self.anchors.labels):
            these, mine = np.flatnonzero(labels == label), np.flatnonzero(self.anchors.labels == label)
            for start in range(0, len(mine), TILE):
                part = mine[start : start + TILE]
                found = scores(self.anchors.vectors[part], vectors[these])
                found[self.anchors.ids[part][:, None] == ids[these]] = NONE
                near, near_ids = _best(found, np.broadcast_to(ids[these], found.shape), self.k)
                self.score[part], self.ids[part] = _best(np.hstack([self.score[part], near]), np.hstack([self.ids[part], near_ids]), self.k)

    def rows(self) -> pa.RecordBatch:
        a, i = np.nonzero(self.score != NONE)
        return pa.RecordBatch.from_arrays([pa.array(self.anchors.ids[a]), pa.array(self.ids[a, i]), pa.array(self.score[a, i])], names=["anchor_id", "id", "score"])


class WindowHeaps:
    """For each anchor and positive the best rows of other labels that lie in the positive's window."""

    def __init__(self, anchors: Anchors, k: int, low: int, high: int, places: int) -> None:
        self.anchors, self.k = anchors, k
        n = len(anchors.ids)
        self.low, self.high = np.full((n, places), LIMIT), np.full((n, places), NONE)
        self.positive, self.positive_score = np.zeros((n, places), np.int64), np.zeros((n, places), np.int64)
        for a, held in enumerate(anchors.positives):
            for i, p in enumerate(held):  # low p <= 100 s <= high p, in whole numbers
                self.low[a, i], self.high[a, i] = -(-low * p["score"] // 100), high * p["score"] // 100
                self.positive[a, i], self.positive_score[a, i] = p["id"], p["score"]
        self.score = np.full((n, places, k), NONE, np.int64)
        self.ids = np.zeros_like(self.score)

    def take(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        k = self.k
        for start in range(0, len(self.anchors.ids), TILE):
            part = slice(start, start + TILE)
            found = scores(self.anchors.vectors[part], vectors)
            found[self.anchors.labels[part][:, None] == labels] = NONE
            sorted_, sorted_ids = _best(found, np.broadcast_to(ids, found.shape), found.shape[1])
            for i in range(self.low.shape[1]):
                first = (sorted_ > self.high[part, i, None]).sum(axis=1)[:, None] + np.arange(k)
                at = np.minimum(first, sorted_.shape[1] - 1)
                near, near_ids = np.take_along_axis(sorted_, at, 1), np.take_along_axis(sorted_ids, at, 1)
                inside = (first < sorted_.shape[1]) & (near >= self.low[part, i, None]) & (near != NONE)
                near = np.where(inside, near, NONE)
                self.score[part, i], self.ids[part, i] = _best(
                    np.hstack([self.score[part, i], near]), np.hstack([self.ids[part, i], near_ids]), k
                )

    def rows(self) -> pa.RecordBatch:
        a, i, j = np.nonzero(self.score != NONE)
        columns = {
            "anchor_id": self.anchors.ids[a], "positive_id": self.positive[a, i], "positive_score": self.positive_score[a, i],
            "negative_id": self.ids[a, i, j], "negative_score": self.score[a, i, j],
        }
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns.values()], names=list(columns))


def _cells(heaps: Callable[[Anchors], PositiveHeaps | WindowHeaps]) -> Callable:
    """A task over sorted cells: anchors first, then candidates by id, in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, heap, rest, last = None, [], None, [], None

        def search(final: bool) -> None:
            nonlocal rest, last
            held = pa.Table.from_batches(rest).combine_chunks()
            while held.num_rows and (final or held.num_rows >= CHUNK):
                chunk, held = held.slice(0, CHUNK).combine_chunks(), held.slice(CHUNK)
                ids = chunk.column("id").to_numpy()
                new = np.append(ids[:1] != last, ids[1:] != ids[:-1])  # rows of one id: the first counts
                last = ids[-1]
                vectors = integers(_single(chunk, "v"))
                heap.take(ids[new], chunk.column("label").to_numpy()[new], vectors[new])
            rest = held.to_batches()

        def finished() -> Iterator[pa.RecordBatch]:
            nonlocal heap, rest, last
            if heap is not None:
                if rest:
                    search(True)
                yield heap.rows()
            heap, rest, last = None, [], None

        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("row", "col", "kind")])
            edges = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *edges], [*edges, batch.num_rows]):
                if lo == hi:
                    continue
                here, kind, part = tuple(key[:2, lo]), key[2, lo], batch.slice(lo, hi - lo)
                if here != cell:
                    yield from finished()
                    cell, waiting = here, []
                if kind == 0:
                    waiting.append(part)
                    continue
                if waiting:
                    heap, waiting = heaps(Anchors(pa.Table.from_batches(waiting))), []
                if heap is not None:
                    rest.append(part)
                    if sum(x.num_rows for x in rest) >= CHUNK:
                        search(False)
        yield from finished()

    return run


def usable(vectors: DataFrame, vec_id: str, label: Column, embedding: str) -> DataFrame:
    """id, label and v of the rows that take part."""
    v = F.col(embedding).cast("array<double>")
    fine = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"), v.alias("v"))
    return rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & fine)


def mine(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    vec_id: str = "vec_id", label: Column | None = None, embedding: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``anchors`` is a condition on the column ``id``. Positives are the ``positives`` best other rows of the
    anchor's label; for each of them the best ``negatives`` rows of other labels come back whose score lies from
    ``low`` to ``high`` hundredths of the positive's. Higher scores come first, then smaller ids. Rows without
    id, label or vector, or with a null or non-finite component, take no part; of rows with one id only the least by
    (label, vector) counts; a shorter vector is filled up by zeros; scores beyond 64 bits are held at
    the ends of that range. Anchors without positives or without such negatives have no rows. Other columns are
    left out, and an empty table gives none.
    """
    rows = stored(usable(vectors, vec_id, F.col("label") if label is None else label, embedding), "negatives-rows")
    asked = rows.filter(anchors).groupBy("id").agg(F.min(F.struct("label", "v")).alias("row")).select("id", "row.label", "row.v")
    asked = stored(asked, "negatives-anchors")
    n, m = rows.count(), asked.count()
    down = max(1, min(-(-n // CELL), FEW), -(-n // LARGE))
    across = max(1, -(-m // ANCHORS))
    held = "array<struct<id:bigint, score:bigint>>"
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    dealt = lambda count: F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")

    def grid(columns: DataFrame) -> DataFrame:
        left = columns.select(each(down).alias("row"), dealt(across).alias("col"), F.lit(0).alias("kind"), "id", "label", "v", "positives")
        right = rows.select(
            dealt(down).alias("row"), each(across).alias("col"), F.lit(1).alias("kind"), "id", "label", "v", F.lit(None).cast(held).alias("positives")
        )
        return left.union(right).repartition(down * across, "row", "col").sortWithinPartitions("row", "col", "kind", "id", "label", "v")

    bare = asked.withColumn("positives", F.lit(None).cast(held))
    found = map_arrow(grid(bare), _cells(lambda a: PositiveHeaps(a, positives)), "anchor_id long, id long, score long")
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id"))
    best = found.withColumn("place", place).filter(F.col("place") <= positives)
    best = best.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("best"))
    best = best.select(F.col("anchor_id").alias("id"), F.transform("best", lambda p: F.struct(p["id"].alias("id"), p["score"].alias("score"))).alias("positives"))
    ready = stored(asked.join(best, "id"), "negatives-positives")
    fields = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    hard = map_arrow(grid(ready), _cells(lambda a: WindowHeaps(a, negatives, low, high, positives)), fields)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    ranked = hard.withColumn("rank", rank).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_strassen_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)


SQL = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::bigint AS label, embedding::double[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), whole AS (
  SELECT vec_id AS id, row.label AS label, list_transform(row.v, lambda x: floor(256 * x)::bigint) AS v
  FROM (SELECT vec_id, min({'label': label, 'v': v}) AS row FROM given GROUP BY vec_id)
), pairs AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::bigint AS score
  FROM whole a JOIN whole b ON a.id <> b.id WHERE a.id % 100 = 0
), positives AS (
  SELECT anchor_id, id, score FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id, (row_number() OVER w)::int AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)
QUALIFY row_number() OVER w <= 10
"""

QUERIES = {"op13_strassen_negatives": (op13_strassen_negatives, SQL)}
