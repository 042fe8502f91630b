"""Language-model scores from a log-frequency Bloom filter.

Unigram and bigram counts are taken over all training texts; a bigram is known by a mix of its tokens' 64-bit hashes.
A count c is quantised to level q = floor(log2 c) + 1, and a bigram enters one Bloom filter as the
pairs (n-gram, 1) .. (n-gram, q). A query probes (n-gram, 1), (n-gram, 2), ... until a miss; the number of hits
gives back the count's lower edge 2**(q-1), which a false hit can raise with a small probability only.

The filter holds every bigram. Pair keys are dealt to buckets of about ``BUCKET`` training positions; a task sums the
counts of a bucket and builds its part of the filter, in segments sized by the bucket's own entries, so that tasks build
apart from each other. All probes of a bigram fall into one segment. Runs of whole segments of ``MAX_BITS`` (32 MB)
are broadcast one after the other. Texts are read once for the scores: that pass writes each position's probe to the
run of segments that answers it, and the pass of a run reads its own probes only, so the work is in proportion to
the texts however many runs there are. Unigram levels come from the exact counts, which the base score needs anyway.

The probability of a token w after h is ``MIX * c(h, w) / c(h) + (1 - MIX) * (c(w) + 0.1) / (N + 0.1 * (V + 1))``, the
first part only where h occurs in the training texts. Counts are rounded down and totals are exact, so
probabilities sum to one at most.

The base score needs exact counts of all tokens. Those of the ``FREQUENT`` most frequent are broadcast; other
tokens, rare by definition, meet their counts in a join, which also scores the positions that they or
the tokens after them have.

Null and empty texts are one end; rows that repeat, and null ids, each have their own row; an empty table gives no rows.
A carried column with the name of a result (any case) is left out, any other name is free.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import discard, held_out, map_arrow, scratch, stored, table, text_bytes, text_slices, widened
from indexloom.llm.suffix_dedup import _BASES, Prefixes, _mixed

FOLDS = 10
FREQUENT, MIX = 200_000, 0.5
MAX_BITS, SEGMENT_BITS, HASHES = 1 << 28, 1 << 18, 4
#: Training positions of a bucket, and bytes that are hashed in one go.
BUCKET, PIECE = 2_000_000, 1 << 20
RESULTS = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
#: Entries that a task holds before it sends its counts on.
HELD = 1 << 20
END = np.uint64(0x243F6A8885A308D3)
PAIR = np.uint64(0x13198A2E03707344)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of words, over at most ``PIECE`` bytes at a time."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + PIECE, "right")))
        if ends[j - 1] - base <= PIECE:
            prefixes = Prefixes(raw[base : ends[j - 1]])
            a, b = starts[i:j] - base, ends[i:j] - base
            out[i:j] = (prefixes.sums[b] - prefixes.sums[a]) * prefixes.down[a]
        else:  # one word longer than a piece
            for at in range(base, ends[i], PIECE):
                sums = Prefixes(raw[at : min(at + PIECE, ends[i])]).sums
                out[i : i + 1] += sums[-1:] * np.uint64(pow(_BASES[0], int(at - base), 1 << 64))
        i = j
    return out


def tokens(text: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the tokens of all texts, each text's words and then one end, and where each text's begin."""
    raw, bounds = text_bytes(text)
    low = _LOWER[raw]
    gap = np.concatenate([[True], _IS_SPACE[raw], [True]])
    cut = np.zeros(len(raw) + 1, bool)
    cut[bounds] = True
    word = ~gap[1:-1]
    starts = np.flatnonzero(word & (gap[:-2] | cut[:-1]))
    ends = np.flatnonzero(word & (gap[2:] | cut[1:])) + 1
    hashes = _mixed(_word_hashes(low, starts, ends) + (ends - starts).astype(np.uint64))
    first = np.searchsorted(starts, bounds)
    owner = np.repeat(np.arange(len(text)), np.diff(first))
    out = np.full(len(starts) + len(text), END)
    out[np.arange(len(starts)) + owner] = hashes
    return out, first + np.arange(len(text) + 1)


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], (np.add.reduceat(counts, heads) if len(keys) else counts)


def _partial_sums(batches: Iterator[pa.RecordBatch], grams) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and counts of a task's texts, each key at most once per ``HELD`` entries. ``grams(hashes, first)`` gives the keys of a slice."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    joined = lambda: _sums(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))
    for part in text_slices(batches, "text"):
        keys = grams(*tokens(part.column("text")))
        held.append(_sums(keys, np.ones(len(keys), np.int64)))
        size += len(held[-1][0])
        if size > HELD:
            held = [joined()]
            size = len(held[0][0])
            if size > HELD // 2:
                yield held[0]
                held, size = [], 0
    if held:
        yield joined()


def _counted(texts: DataFrame) -> DataFrame:
    """key and n of the tokens of all texts: sums per task, then over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in _partial_sums(batches, lambda hashes, first: hashes):
            for a in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(keys[a : a + (1 << 16)].view(np.int64)), pa.array(n[a : a + (1 << 16)])], names=["key", "n"])

    return map_arrow(texts.select("text"), run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _runs(sorted_: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of each run of equal values."""
    if len(sorted_):
        heads = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
        yield from zip(heads.tolist(), [*heads[1:].tolist(), len(sorted_)])


def _packed(arrays: list[np.ndarray]) -> pa.BinaryArray:
    return pa.array([np.ascontiguousarray(x).tobytes() for x in arrays], pa.binary())


def _unpacked(column: pa.Array, kind) -> np.ndarray:
    """The values of all packed arrays of a column, one after the other."""
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _before(values: np.ndarray, first: np.ndarray, end) -> np.ndarray:
    """What stands before each token: the value of the token before it in its text, ``end`` at a text's start."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[first[:-1]] = end
    return out


def _pair_keys(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Key of (token before, token) for each token. A text starts after an end."""
    return _mixed(_mixed(_before(hashes, first, END) ^ PAIR) + hashes)


def _at(sorted_: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``values`` in ``sorted_`` and whether they are there."""
    if not len(sorted_):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return at, sorted_[at] == values


def _level_keys(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes per (n-gram, level) for the places within a segment."""
    x = _mixed(keys + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15))
    return x >> np.uint64(32), (x & np.uint64(0xFFFFFFFF)) | np.uint64(1)


def _segments(keys: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The segment of each key: its bucket's first one and a share of the key beyond."""
    buckets = np.uint64(len(starts) - 1)
    bucket = (keys % buckets).astype(np.int64)
    return starts[bucket] + ((keys // buckets) % (starts[bucket + 1] - starts[bucket]).astype(np.uint64)).astype(np.int64)


class Filter:
    """A run of whole segments as bytes, from segment ``first`` on. ``starts`` has the first segment of each bucket and, last, how many there are."""

    def __init__(self, starts: np.ndarray | int, data: np.ndarray, first: int = 0):
        self.starts = np.array([0, starts]) if isinstance(starts, int) else starts
        self.data, self.first = data, first

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Consecutive hits of each key, from level 1 on; the keys' segments must be here."""
        found = np.zeros(len(keys), np.int64)
        base = (_segments(keys, self.starts) - self.first).astype(np.uint64) * np.uint64(SEGMENT_BITS)
        active = np.arange(len(keys))
        level = 1
        while len(active):
            a, b = _level_keys(keys[active], level)
            for i in range(HASHES):
                place = base[active] + (a + np.uint64(i) * b) % np.uint64(SEGMENT_BITS)
                hit = (self.data[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
                active, a, b = active[hit], a[hit], b[hit]
            found[active] = level
            level += 1
        return found


def _segment_bits(keys: np.ndarray, q: np.ndarray) -> np.ndarray:
    """One segment that holds ``keys`` with their levels ``q``, as bytes."""
    held = np.zeros(SEGMENT_BITS, bool)
    for level in range(1, int(q.max(initial=0)) + 1):
        x, y = _level_keys(keys[q >= level], level)
        for i in range(HASHES):
            held[(x + np.uint64(i) * y) % np.uint64(SEGMENT_BITS)] = True
    return np.packbits(held, bitorder="little")


def _filter(texts: DataFrame, total: int) -> tuple[DataFrame, np.ndarray]:
    """The filter of all pairs as rows (bucket, place, bits), and the first segment of each bucket.

    Each bucket has on average ``BUCKET`` of the ``total`` positions, summed per task before they are sent, so a
    pair that holds a third of them comes as one entry per ``HELD`` positions.
    """
    buckets = max(1, -(-total // BUCKET))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in _partial_sums(batches, _pair_keys):
            bucket = (keys % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            keys, n, bucket = keys[order], n[order], bucket[order]
            for a, b in _runs(bucket):
                yield pa.RecordBatch.from_arrays([pa.array(bucket[a : a + 1]), _packed([keys[a:b]]), _packed([n[a:b]])], names=["bucket", "keys", "n"])

    def build(key: tuple[pa.Scalar, ...], table_: pa.Table) -> pa.Table:
        keys, n = _sums(_unpacked(table_.column("keys"), np.uint64), _unpacked(table_.column("n"), np.int64))
        q = np.frexp(n.astype(np.float64))[1]
        many = max(1, int(np.ceil(q.sum() * HASHES / np.log(2) / SEGMENT_BITS)))
        place = ((keys // np.uint64(buckets)) % np.uint64(many)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        cuts = np.searchsorted(place[order], np.arange(many + 1))
        bits = [_segment_bits(keys[order[a:b]], q[order[a:b]]) for a, b in zip(cuts, cuts[1:])]
        number = key[0].as_py()
        return pa.table({"bucket": pa.array([number] * many, pa.int64()), "place": pa.array(np.arange(many)), "bits": _packed(bits)})

    dealt = map_arrow(texts.select("text"), deal, "bucket long, keys binary, n binary")
    bits = stored(dealt.groupBy("bucket").applyInArrow(build, "bucket long, place long, bits binary"), "lm-filter")
    sizes = np.ones(buckets, np.int64)
    found = bits.groupBy("bucket").count().toArrow()  # one row per BUCKET positions
    sizes[found.column("bucket").to_numpy()] = found.column("count").to_numpy()
    return bits, np.concatenate([[0], np.cumsum(sizes)])


def _quantised(n):
    """floor(log2 n) + 1: the number of binary digits."""
    return F.length(F.bin(n))


def _edge(q: np.ndarray) -> np.ndarray:
    """The lower edge of the counts of level ``q``."""
    return np.where(q > 0, 2.0 ** (q - 1), 0.0)


class Model:
    """Frequent tokens with their counts, totals, and the filter as a stored table of segments."""

    def __init__(self, bits: DataFrame | None, starts: np.ndarray, frequent: np.ndarray, counts: np.ndarray, total: int, distinct: int):
        self.bits, self.starts = bits, starts
        self.frequent, self.counts, self.total, self.distinct = frequent, counts, total, distinct
        self.per = max(1, MAX_BITS // SEGMENT_BITS)

    def shards(self) -> Iterator[Filter]:
        """The filter in runs of whole segments of ``MAX_BITS`` together, one after the other."""
        size, all_ = SEGMENT_BITS // 8, int(self.starts[-1])
        for first in range(0, all_, self.per):
            last = min(first + self.per, all_) - 1
            data = np.zeros((last - first + 1) * size, np.uint8)
            if self.bits is not None:
                low, high = (int(b) for b in np.searchsorted(self.starts, [first, last], "right") - 1)
                found = self.bits.filter(F.col("bucket").between(low, high)).toArrow()  # MAX_BITS and two buckets at most
                at = self.starts[found.column("bucket").to_numpy()] + found.column("place").to_numpy() - first
                for i in np.flatnonzero((at >= 0) & (at <= last - first)).tolist():
                    data[at[i] * size : (at[i] + 1) * size] = np.frombuffer(found.column("bits")[i].as_buffer(), np.uint8)
            yield Filter(self.starts, data, first)


def fit(docs: DataFrame) -> tuple[Model, DataFrame]:
    """Model and exact counts (key, n) of ``docs(text)``; a null text is empty and still has its end."""
    texts = docs.select("text")
    unigrams = stored(_counted(texts), "lm-unigrams")
    total, distinct = unigrams.agg(F.sum("n"), F.count("*")).first()
    if not distinct:
        none = np.zeros(0, np.uint64)
        return Model(None, np.array([0, 1]), none, np.zeros(0, np.int64), 0, 0), unigrams
    top = unigrams.orderBy(F.desc("n"), "key").limit(FREQUENT).toArrow()  # 16 bytes a row on the driver
    keys, counts = (top.column(c).to_numpy().astype(np.int64) for c in ("key", "n"))
    keys = keys.view(np.uint64)
    bits, starts = _filter(texts, int(total))
    order = np.argsort(keys)
    return Model(bits, starts, keys[order], counts[order], int(total), int(distinct)), unigrams


#: What a probe row holds: the keys of some positions of one slice of texts, each one's text within the slice, the level of its
#: token and the place of the token before it among the frequent ones; where these are rare, their hashes.
PROBES = {"keys": np.uint64, "owner": np.int32, "level": np.uint8, "context": np.int32, "own": np.uint64, "before": np.uint64}


def _spread(docs: DataFrame, model: Model, tokens_, carried: list[str], path: str) -> DataFrame:
    """``docs(carried, _lm_text, _row)`` read once and written to ``path``: rows of texts (_shard -1) with their sums, and rows of probes by the shard that answers them."""
    starts, per = model.starts, model.per

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts = tokens_.value
        end_at, end_here = _at(frequent, END[None])
        end = np.int32(end_at[0] if end_here[0] else -1)
        for part in text_slices(batches, "_lm_text"):
            hashes, first = tokens(part.column("_lm_text"))
            n = len(first) - 1
            each, inverse = np.unique(hashes, return_inverse=True)
            at, here = _at(frequent, each)
            place = np.where(here, at, -1).astype(np.int32)[inverse]
            count = np.where(here, counts[at] if len(counts) else 0, 0)[inverse]
            here = here[inverse]
            add = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  every text has its end
            known, base = add(here.astype(np.int64)), add(np.where(here, np.log10(count + 0.1), 0.0))
            row = part.column("_row")
            rows = {c: part.column(c) for c in carried} | {"_tokens": pa.array(np.diff(first)), "_known": pa.array(known), "_base": pa.array(base)}
            rows |= {"_row": row, **{f"_{c}": pa.nulls(n, pa.binary()) for c in PROBES}, "_shard": pa.array(np.full(n, -1, np.int32))}
            yield pa.RecordBatch.from_arrays(list(rows.values()), names=list(rows))

            keys = _pair_keys(hashes, first)
            shard = (_segments(keys, starts) // per).astype(np.int32)
            values = {
                "keys": keys, "owner": np.repeat(np.arange(n, dtype=np.int32), np.diff(first)), "level": np.frexp(count.astype(np.float64))[1].astype(np.uint8),
                "context": _before(place, first, end), "own": hashes, "before": _before(hashes, first, END),
            }
            order = np.argsort(shard, kind="stable")
            for a, b in _runs(shard[order]):
                for c in range(a, b, HELD):
                    mine = order[c : min(c + HELD, b)]
                    x = {name: v[mine] for name, v in values.items()}
                    x["own"], x["before"] = x["own"][x["level"] == 0], x["before"][x["context"] < 0]
                    rows = {c_: pa.nulls(1, part.column(c_).type) for c_ in carried}
                    rows |= {"_tokens": pa.nulls(1, pa.int64()), "_known": pa.nulls(1, pa.int64()), "_base": pa.nulls(1, pa.float64()), "_row": row.slice(0, 1)}
                    rows |= {**{f"_{name}": _packed([v]) for name, v in x.items()}, "_shard": pa.array(shard[mine[:1]])}
                    yield pa.RecordBatch.from_arrays(list(rows.values()), names=list(rows))

    ddl = "_tokens long, _known long, _base double, _row long, " + ", ".join(f"_{c} binary" for c in PROBES) + ", _shard int"
    spread = map_arrow(docs, run, widened(docs.select(*carried), ddl))
    spread.write.option("compression", "zstd").partitionBy("_shard").parquet(path)
    return docs.sparkSession.read.schema(spread.schema).parquet(path)


OPEN = "_row long, _score double, _open array<struct<key: long, n: long, before: long, context: long, q: int, times: int>>"


def _answered(probes: DataFrame, shard, tokens_, scale: float) -> DataFrame:
    """Per text the sum over its positions in the shard, and those positions that need the count of a rare token."""

    def answer(row: int, x: dict[str, np.ndarray], filter_: Filter, counts: np.ndarray) -> pa.RecordBatch:
        codes, code_at = np.unique(x["keys"], return_inverse=True)
        q = filter_.levels(codes)[code_at]
        level, near, owner = x["level"].astype(np.int64), x["context"] >= 0, x["owner"]
        context = np.where(near, counts[np.maximum(x["context"], 0)] if len(counts) else 0, 0)
        p = (_edge(level) + 0.1) / scale
        p = np.where(near, MIX * np.minimum(_edge(q) / np.maximum(context, 1), 1.0) + (1 - MIX) * p, p)
        closed = (level > 0) & near
        texts, which = np.unique(owner, return_inverse=True)
        scores = np.bincount(which, weights=np.where(closed, np.log10(p), 0.0), minlength=len(texts))
        own, before = np.zeros(len(q), np.uint64), np.zeros(len(q), np.uint64)
        own[level == 0], before[~near] = x["own"], x["before"]
        # Open positions of a text with their numbers.
        left = np.flatnonzero(~closed)
        left = left[np.lexsort((x["keys"][left], owner[left]))]
        o, k = owner[left], x["keys"][left]
        heads = np.flatnonzero(np.append(True, (o[1:] != o[:-1]) | (k[1:] != k[:-1]))) if len(o) else np.zeros(0, np.int64)
        times = np.diff(np.append(heads, len(o)))
        left = left[heads]
        offsets = np.append(np.searchsorted(o[heads], texts), len(heads)).astype(np.int32)
        # Only what is to be looked up has its hash; the others have their counts.
        opened = {
            "key": pa.array(own[left].view(np.int64), mask=level[left] > 0), "n": pa.array(_edge(level[left]).astype(np.int64)),
            "before": pa.array(before[left].view(np.int64), mask=near[left]), "context": pa.array(context[left]),
            "q": pa.array(q[left].astype(np.int32)), "times": pa.array(times.astype(np.int32)),
        }
        opened = pa.StructArray.from_arrays(list(opened.values()), names=list(opened))
        # The texts of a slice have consecutive row numbers.
        return pa.RecordBatch.from_arrays([pa.array(row + texts.astype(np.int64)), pa.array(scores), pa.ListArray.from_arrays(pa.array(offsets), opened)], names=["_row", "_score", "_open"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, filter_ = tokens_.value[1], shard.value
        for batch in batches:
            for i in range(batch.num_rows):
                x = {name: np.frombuffer(batch.column(f"_{name}")[i].as_buffer(), kind) for name, kind in PROBES.items()}
                yield answer(batch.column("_row")[i].as_py(), x, filter_, counts)

    return map_arrow(probes.select("_row", *(f"_{c}" for c in PROBES)), run, OPEN)


def score(docs: DataFrame, model: Model, unigrams: DataFrame, carried: list[str]) -> DataFrame:
    """``carried`` columns of ``docs(text)`` with n_tokens, n_known, train_tokens, base_score and score."""
    spark = docs.sparkSession
    carried = [c for c in carried if c.lower() not in RESULTS]
    constant = float(np.log10(max(model.total + 0.1 * (model.distinct + 1), 1e-9)))
    scale = model.total + 0.1 * (model.distinct + 1)
    tokens_ = spark.sparkContext.broadcast((model.frequent, model.counts))
    inner = [f"_carried{i}" for i in range(len(carried))]
    source = docs.select(*(F.col(f"`{c}`").alias(x) for c, x in zip(carried, inner)), F.col("text").alias("_lm_text"), F.monotonically_increasing_id().alias("_row"))
    path, probes = scratch(spark, "lm-parts"), scratch(spark, "lm-probes")
    spread = _spread(source, model, tokens_, inner, probes)
    for number, filter_ in enumerate(model.shards()):
        shard = spark.sparkContext.broadcast(filter_)
        _answered(spread.filter(F.col("_shard") == number), shard, tokens_, scale).write.mode("append").parquet(path)
        shard.destroy()
        discard(spark, f"{probes}/_shard={number}")
    parts = spark.read.schema(OPEN).parquet(path)
    rare = parts.select("_row", F.inline("_open"))

    def met(df: DataFrame, key: str, n: str) -> DataFrame:
        """``df`` with the count of each ``key``, none of them null."""
        counts = unigrams.select(F.col("key").alias(key), F.col("n").alias("_n"))
        return df.join(counts, key, "left").withColumn(n, F.coalesce("_n", F.lit(0))).select(rare.columns)

    # Apart, so that no null keys meet in one task.
    one, other = F.col("key").isNotNull(), F.col("before").isNotNull()
    alone = [met(rare.filter(one & ~other), "key", "n"), met(rare.filter(~one & other), "before", "context")]
    rare = reduce(DataFrame.union, [*alone, met(met(rare.filter(one & other), "key", "n"), "before", "context")])
    edge = lambda n, q: F.when(n > 0, F.pow(F.lit(2.0), q - 1)).otherwise(0.0)
    p = (edge(F.col("n"), _quantised(F.col("n"))) + 0.1) / F.lit(scale)
    follow = F.least(edge(F.col("q"), F.col("q")) / F.greatest("context", F.lit(1)), F.lit(1.0))
    p = F.when(F.col("context") > 0, MIX * follow + (1 - MIX) * p).otherwise(p)
    seen = F.when(F.col("key").isNotNull() & (F.col("n") > 0), F.col("times")).otherwise(0)
    more = rare.select("_row", seen.alias("_more"), (seen * F.log10(F.col("n") + F.lit(0.1))).alias("_logs"), (F.col("times") * F.log10(p)).alias("_points"))
    more = more.union(parts.select("_row", F.lit(0), F.lit(0.0), "_score"))
    found = more.groupBy("_row").agg(*(F.sum(c).alias(c) for c in ("_more", "_logs", "_points")))
    texts = spread.filter(F.col("_shard") == -1).select(*inner, "_tokens", "_known", "_base", "_row")
    n_known = F.col("_known") + F.coalesce("_more", F.lit(0))
    logs = F.col("_base") + F.coalesce("_logs", F.lit(0.0)) + (F.col("_tokens") - n_known) * F.log10(F.lit(0.1))
    return texts.join(found, "_row", "left").select(
        *(F.col(x).alias(c) for c, x in zip(carried, inner)), F.col("_tokens").alias("n_tokens"), n_known.alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"), (logs - F.col("_tokens") * F.lit(constant)).alias("base_score"),
        F.coalesce("_points", F.lit(0.0)).alias("score"),
    )


def op6_logfreq_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out(F.col("doc_id"), FOLDS).alias("held_out"))
    model, unigrams = fit(docs.filter(~F.col("held_out")).select("text"))
    return score(docs, model, unigrams, ["doc_id", "held_out"])


QUERIES = {"op6_logfreq_lm": (op6_logfreq_lm, None)}
