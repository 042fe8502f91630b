"""Nearest vectors by multiprobe p-stable hashing.

Vectors are scaled to length one, so that the nearest by Euclidean distance is the
nearest by cosine. A table hashes with K functions floor((a . x + b) / W), a Gaussian.
A query visits its own bucket and then perturbed buckets, each moving some functions
by one: sets of moves are listed once in the order of their expected squared distance
to the query (the moves of a query sorted by distance to the boundary), and each query maps
that order to its own moves. Candidates of all tables and probes are compared by exact cosine and
merged.

Index rows and probes meet per (table, block of buckets, part): a block is a hash range
of buckets, and buckets with more than ``BUCKET`` rows are split into parts that
every probe of the bucket visits, so no task holds an unbounded group. A task sends the
few best per query, never candidate pairs. Of vectors that are equal in all components
only the smallest ids can be among the nearest, so a class of copies is indexed
once with its ``k + 1`` smallest ids: this loses nothing.

A query whose buckets hold fewer than ``k`` others looks through the whole index, in parts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indexloom.llm.common import map_arrow, stored, table

#: Tables, functions per table, width of a cell (vectors have length one), buckets visited per table.
TABLES, FUNCTIONS, WIDTH, PROBES = 10, 10, 2.5, 100
#: Index rows that one task should hold, and rows of one bucket that stay together.
BLOCK, BUCKET = 40_000, 20_000
#: Queries that look through rows together, pairs whose exact score is taken in one go, and how far rounding may reach.
ASKERS, PAIRS, MARGIN = 200, 1 << 16, 1e-9
SEED = 5


@lru_cache(maxsize=4)
def hash_functions(dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a = rng.normal(size=(TABLES, dim, FUNCTIONS))
    b = rng.uniform(0, WIDTH, size=(TABLES, FUNCTIONS))
    return a, b, rng.integers(1, 1 << 62, size=(TABLES, FUNCTIONS), dtype=np.int64)


@lru_cache(maxsize=1)
def moves() -> np.ndarray:
    """One row per probe: which of the 2K moves, ranked by distance, it takes. The first takes none.

    Expected squared distance of the j-th nearest boundary, for uniform places in the cell:
    j(j+1) / (4(K+1)(K+2)) up to K, and by symmetry beyond.
    """
    k, m = FUNCTIONS, 2 * FUNCTIONS
    j = np.arange(1, m + 1)
    near = j * (j + 1) / (4 * (k + 1) * (k + 2))
    far = 1 - (m + 1 - j) / (k + 1) + (m + 1 - j) * (m + 2 - j) / (4 * (k + 1) * (k + 2))
    cost = np.where(j <= k, near, far)
    out, heap = [()], [(cost[0], (0,))]
    while heap and len(out) < PROBES:
        total, taken = heapq.heappop(heap)
        if not any(m - 1 - x in taken for x in taken):  # both boundaries of one function
            out.append(taken)
        last = taken[-1] + 1
        if last < m:
            heapq.heappush(heap, (total - cost[last - 1] + cost[last], taken[:-1] + (last,)))
            heapq.heappush(heap, (total + cost[last], taken + (last,)))
    rows = np.zeros((len(out), m), bool)
    for i, taken in enumerate(out):
        rows[i, list(taken)] = True
    return rows


def bucket_keys(x: np.ndarray, probes: bool) -> np.ndarray:
    """Bucket numbers per vector and table, and per probe if ``probes``."""
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    a, b, mult = hash_functions(x.shape[1])
    out = np.empty((len(x), TABLES, len(moves()) if probes else 1), np.int64)
    for t in range(TABLES):
        place = (unit @ a[t] + b[t]) / WIDTH
        cell = np.floor(place)
        with np.errstate(over="ignore"):
            key = (cell.astype(np.int64) * mult[t]).sum(axis=1)
            if not probes:
                out[:, t, 0] = key
                continue
            below = place - cell
            order = np.argsort(np.hstack([below, 1 - below]), axis=1)
            step = np.concatenate([-mult[t], mult[t]])[order]
            out[:, t] = key[:, None] + step @ moves().T.astype(np.int64)
    return out


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found for each row of ``queries``.

    Both tables have a long id and an array of float or double, all of one length; the score is the
    cosine in double precision of the given vectors, ties go to the smaller id, and a query's
    own id is no candidate. Vectors that are null, zero, or hold null or non-finite components and rows without id
    take no part; a repeated row counts once. Other columns are left out; without queries
    or vectors there are no rows.
    """
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        v = F.col(embedding).cast("array<double>")
        fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return df.select(F.col(vec_id).cast("long").alias("id"), v.alias("v")).filter(
            F.col("id").isNotNull() & fine & F.exists("v", lambda x: x != 0)
        )

    # A class of equal vectors: its k + 1 smallest ids. Distinct rows first, so sets stay small per task.
    rows = usable(vectors).select("id", "v", F.xxhash64("v").alias("h"))
    ranked = rows.distinct().withColumn("n", F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))).filter(F.col("n") <= k + 1)
    index = stored(ranked.groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select("v", "ids"), "ann-index")
    wanted = stored(usable(queries).dropDuplicates(["id"]), "ann-queries")
    n = index.count()
    blocks = max(1, -(-n * TABLES // BLOCK))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = bucket_keys(_vectors(batch.column("v")), False)[:, :, 0]
            at = pa.array(np.repeat(np.arange(batch.num_rows), TABLES))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), batch.column("v").take(at), batch.column("ids").take(at)], names=["bucket", "v", "ids"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = bucket_keys(_vectors(batch.column("v")), True).reshape(batch.num_rows, -1)
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.unique(keys[i])), pa.array(np.full(len(np.unique(keys[i])), batch.column("id")[i].as_py()))], names=["bucket", "id"]
                )

    placed = stored(map_arrow(index, place, "bucket long, v array<double>, ids array<long>"), "ann-placed")
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("n"))
    large = stored(sizes.filter(F.col("n") > BUCKET).select("bucket", F.ceil(F.col("n") / BUCKET).cast("int").alias("parts")), "ann-large")
    block = F.pmod(F.xxhash64("bucket"), F.lit(blocks))
    parts = F.coalesce("parts", F.lit(1))
    part = F.pmod(F.xxhash64("ids"), parts.cast("long"))
    dealt = placed.join(large, "bucket", "left").select(block.alias("block"), part.alias("part"), "bucket", "v", "ids")
    probes = map_arrow(wanted, probe, "bucket long, id long").join(large, "bucket", "left").select(
        block.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), (parts - 1).cast("long"))).alias("part"), "bucket", "id"
    )
    # A block's buckets of one query travel with its vector once.
    asked = probes.groupBy("block", "part", "id").agg(F.collect_list("bucket").alias("buckets")).join(wanted, "id")

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found_q, found_id, found_s = [], [], []
        if left.num_rows and right.num_rows:
            left, right = left.combine_chunks(), right.combine_chunks()
            column = lambda t, c: t.column(c).chunk(0)
            base, ids = _vectors(column(left, "v")), column(left, "ids").to_pylist()
            bucket = column(left, "bucket").to_numpy()
            order = np.argsort(bucket, kind="stable")
            q, q_ids = _vectors(column(right, "v")), column(right, "id").to_numpy()
            length, q_length = np.sqrt((base * base).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
            lists = column(right, "buckets")
            asked_bucket = lists.flatten().to_numpy(zero_copy_only=False)
            asker = np.repeat(np.arange(len(q)), np.diff(lists.offsets.to_numpy()))
            by = np.argsort(asked_bucket, kind="stable")
            heads = np.flatnonzero(np.append(True, np.diff(asked_bucket[by]) != 0))
            names = np.array([i[0] for i in ids], np.int64)  # a class is here once per table that put it into the block
            best: list[dict[int, tuple[float, int]]] = [{} for _ in range(len(q))]
            for a, b in zip(heads, np.append(heads[1:], len(by))):
                lo = np.searchsorted(bucket, asked_bucket[by[a]], "left", sorter=order)
                hi = np.searchsorted(bucket, asked_bucket[by[a]], "right", sorter=order)
                if lo == hi:
                    continue
                rows_ = order[lo:hi]
                for start in range(a, b, ASKERS):
                    askers = asker[by[start : min(b, start + ASKERS)]]
                    near = (q[askers] @ base[rows_].T) / (q_length[askers][:, None] * length[rows_])
                    # All that reach the k-th best others, but for the last digits; the query's own class is among them.
                    bar = np.partition(near, max(0, near.shape[1] - k - 1), axis=1)[:, max(0, near.shape[1] - k - 1)] - MARGIN
                    who, what = np.nonzero(near >= bar[:, None])
                    for at in range(0, len(who), PAIRS):
                        qi, r = askers[who[at : at + PAIRS]], rows_[what[at : at + PAIRS]]
                        exact = np.einsum("ij,ij->i", base[r], q[qi], optimize=False) / (length[r] * q_length[qi])
                        # Ties go to the smaller first id, and k + 1 classes hold the k nearest ids.
                        sort = np.lexsort((names[r], -exact, qi))
                        place = np.arange(len(sort)) - np.searchsorted(qi[sort], qi[sort], "left")
                        for j in sort[place <= k].tolist():
                            best[qi[j]][int(names[r[j]])] = (-float(exact[j]), int(r[j]))
                    for i in set(askers.tolist()):
                        if len(best[i]) > 8 * k:
                            best[i] = dict(sorted(best[i].items(), key=lambda x: (x[1][0], x[0]))[: k + 1])
            for qi, near in enumerate(best):
                pairs = sorted((s, i) for s, r in near.values() for i in ids[r] if i != q_ids[qi])
                for s, i in pairs[:k]:
                    found_q.append(q_ids[qi])
                    found_id.append(i)
                    found_s.append(-s)
        return pa.table({"query_id": pa.array(found_q, pa.int64()), "vec_id": pa.array(found_id, pa.int64()), "score": pa.array(found_s, pa.float64())})

    groups = dealt.groupBy("block", "part").cogroup(asked.groupBy("block", "part"))
    found = stored(groups.applyInArrow(search, "query_id long, vec_id long, score double"), "ann-found")
    met = found.groupBy(F.col("query_id").alias("id")).agg(F.countDistinct("vec_id").alias("met"))
    short = stored(wanted.join(met, "id", "left").filter(F.coalesce("met", F.lit(0)) < k).select("id", "v"), "ann-short")
    asking = short.count()
    if asking:
        slices, sets = -(-max(n, 1) // BUCKET), -(-asking // ASKERS)
        every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
        bucket = F.lit(0).cast("long")
        whole = index.select(F.pmod(F.xxhash64("ids"), F.lit(slices)).alias("block"), every(sets).alias("part"), bucket.alias("bucket"), "v", "ids")
        rest = short.select(every(slices).alias("block"), F.pmod(F.xxhash64("id"), F.lit(sets)).alias("part"), "id", F.array(bucket).alias("buckets"), "v")
        more = whole.groupBy("block", "part").cogroup(rest.groupBy("block", "part")).applyInArrow(search, found.schema)
        found = found.union(more)
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_pstable_ann(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


QUERIES = {"op1_pstable_ann": (op1_pstable_ann, None)}
