"""Near-duplicate documents by SetSketch registers.

A document's word shingles are hashed to 64 bits. Register i of its sketch holds
``floor(1 - log_b(min h_i))`` over the shingles' exponential variates h_i (rate a),
cut to 0..q+1: minima that are truncated to exponentially spaced values. Merging two
sketches takes the larger register, and equal registers become likelier with
similarity, so runs of registers serve as band keys.

Steps, each a join, an aggregate or a narrow map:
* one pass over the texts: size of the set, its fingerprint, its sketch;
* documents with one fingerprint are one node;
* each band bucket links its nodes to one centre (a star), never all pairs: the node whose
  buckets hold most, which in a family of edited copies is the text they were made from;
* candidates pass if the maximum-likelihood similarity of their registers, given both set
  sizes, is within ``SLACK`` standard errors of the threshold, and are links
  if the full sets confirm it;
* nodes around one centre that are still in different components are compared by their full sets, in blocks
  of bounded size and inside tasks, which send one link per node and component it meets;
* components come from alternating large and small stars over the links.

Two nodes of the wanted similarity that share no band are missed with a probability of
(1 - 0.8**4)**32 < 5e-8 each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import map_arrow, stored, table, text_bytes, text_slices, widened

REGISTERS, ROWS, SLACK = 128, 4, 6.0
BANDS = REGISTERS // ROWS
#: Nodes and shingles of one block of the comparison around a centre.
BLOCK, BLOCK_SHINGLES = 1_000, 500_000
#: Base, rate and largest value of the registers: steps of a thousandth, 16 bits.
BASE, RATE, LIMIT = 1.001, 20.0, 65_534
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MIX = np.random.default_rng(77).integers(1, 1 << 63, size=(2, REGISTERS), dtype=np.uint64) * 2 + 1


def _finish(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts in a row, and where each text's words start (one more than texts)."""
    raw, bounds = text_bytes(text)
    low = _LOWER[raw]
    gap = np.concatenate([[True], _IS_SPACE[raw], [True]])
    cut = np.zeros(len(raw) + 1, bool)
    cut[bounds] = True
    word = ~gap[1:-1]
    starts = np.flatnonzero(word & (gap[:-2] | cut[:-1]))
    ends = np.flatnonzero(word & (gap[2:] | cut[1:])) + 1
    first = np.searchsorted(starts, bounds)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    # Digests of the slice's distinct words only.
    words = _slices(low[word], starts, ends).dictionary_encode()
    each = np.frombuffer(b"".join(hashlib.blake2b(w, digest_size=8).digest() for w in words.dictionary.to_pylist()), np.uint64)
    return each[words.indices.to_numpy(zero_copy_only=False)], first


def _slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as a binary array over the text's bytes without gaps."""
    offsets = np.append(0, np.cumsum(ends - starts)).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def shingle_sets(text: pa.StringArray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and where each text's begin."""
    hashes, first = word_hashes(text)
    out, sizes = [], []
    for a, b in zip(first[:-1], first[1:]):
        h = hashes[a:b]
        n = max(1, len(h) - words + 1) if len(h) else 0
        if n:
            k = min(words, len(h))
            code = np.full(n, k, np.uint64)
            for i in range(k):
                code = _finish(code * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
            out.append(np.unique(code))
            n = len(out[-1])
        sizes.append(n)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.append(0, np.cumsum(np.array(sizes, np.int64)))


def fingerprints(codes: np.ndarray, first: np.ndarray) -> list[bytes]:
    return [hashlib.blake2b(codes[a:b].tobytes(), digest_size=16).digest() for a, b in zip(first[:-1], first[1:])]


def registers(minima: np.ndarray) -> np.ndarray:
    """Register values from the least of uniform 64-bit numbers."""
    least = -np.log1p(-np.minimum((minima.astype(np.float64) + 0.5) / 2.0**64, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(least) / np.log(BASE)), 0, LIMIT + 1).astype(np.uint16)


def sketch(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of registers per set; an empty set has zeros. Work is cut into pieces that fit a core's cache."""
    out = np.full((len(first) - 1, REGISTERS), np.uint64(0xFFFFFFFFFFFFFFFF))
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for a in range(0, len(codes), 512):
        part, own = codes[a : a + 512], owner[a : a + 512]
        x = part[:, None] * _MIX[0] + _MIX[1]
        heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        rows = own[heads]
        out[rows] = np.minimum(out[rows], np.minimum.reduceat(x, heads, axis=0))
    values = registers(out)
    values[np.diff(first) == 0] = 0
    return values


def similarity(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches, given the sizes of both sets.

    With shares u and v of the sizes, a register of a exceeds b's with probability
    p(u - v * J) and the reverse with p(v - u * J), p(x) = -log_b(1 - x * (b - 1) / b).
    The likelihood is concave in J; a golden-section search finds its maximum.
    """
    u, v = size_a / (size_a + size_b), size_b / (size_a + size_b)
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    p = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        up, down = p(u - v * j), p(v - u * j)
        return more * np.log(up) + less * np.log(down) + same * np.log(np.clip(1 - up - down, 1e-12, 1))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    golden = (np.sqrt(5) - 1) / 2
    for _ in range(40):
        x, y = high - golden * (high - low), low + golden * (high - low)
        left = likelihood(x) > likelihood(y)
        high, low = np.where(left, y, high), np.where(left, low, x)
    return (low + high) / 2


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """``docs(doc_id, text)`` as doc_id, n_shingles, fingerprint (binary) and registers (binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            codes, first = shingle_sets(part.column("text"), words)
            values = sketch(codes, first)
            prints = fingerprints(codes, first)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(first)), pa.array(prints, pa.binary()), pa.array([v.tobytes() for v in values], pa.binary())],
                names=["doc_id", "n_shingles", "fingerprint", "registers"],
            )

    return map_arrow(docs.select("doc_id", "text"), run, widened(docs.select("doc_id"), "n_shingles long, fingerprint binary, registers binary"))


def band_keys(registers_: Column) -> Column:
    width = 2 * ROWS
    return F.array(*(F.xxhash64(F.lit(i), F.substring(registers_, i * width + 1, width)) for i in range(BANDS)))


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes(node)`` with the smallest node that ``links(a, b)`` reach, as ``component``.

    Alternates large stars (each node hands its larger neighbours its least one) and small
    stars (smaller neighbours) until nothing changes: a logarithmic number of turns in
    practice, all on narrow pairs.
    """
    edges = stored(links.select("a", "b").filter("a <> b").distinct(), "cc")

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else pairs.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        joined = both.join(least.select("a", F.least("a", "m").alias("m")), "a")
        if large:
            new = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            new = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return new.filter("a <> b").distinct()

    mark = None
    while True:
        edges = stored(star(star(edges, True), False), "cc")
        new = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if new == mark or not new[0]:
            break
        mark = new
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return nodes.select("node").join(least, nodes["node"] == least["a"], "left").select("node", F.coalesce("m", "node").alias("component"))


def _sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """node and codes, the full shingle set, of the nodes in ``wanted(node)``."""
    wanted = stored(wanted.distinct(), "near-wanted")
    readable = nodes.join(wanted, "node", "left_semi").select("doc_id").distinct()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            codes, first = shingle_sets(part.column("text"), words)
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(codes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(fingerprints(codes, first), pa.binary()), lists], names=["node", "codes"])

    texts = docs.join(readable, "doc_id", "left_semi").select("text")
    found = map_arrow(texts, sets, "node binary, codes array<long>").join(wanted, "node", "left_semi")
    return stored(found.dropDuplicates(["node"]), "near-sets")


def _across(members: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between components of ``members(centre, node, component)`` around one centre.

    A centre's nodes are dealt over blocks, and each pair of blocks meets in a task, where one matrix product
    counts the shingles that sets share. A node is sent once per block of its centre, never once per pair.
    """
    sized = members.join(nodes.select("node", "n_shingles"), "node")
    split = sized.groupBy("centre").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"),
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)).alias("blocks"), F.count("*").alias("n"),
    )
    split = split.filter("lo < hi and n > 1").select("centre", "blocks")
    dealt = stored(members.join(split, "centre").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))), "near-blocks")
    full = _sets(dealt.select("node"), nodes, docs, words)
    meets = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda o: F.struct(F.least(o, "block").alias("i"), F.greatest(o, "block").alias("j"))))
    placed = dealt.select("centre", "node", "component", "block", meets.alias("at")).join(full, "node")

    def compare(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        n = t.num_rows
        lists = t.column("codes").chunk(0)
        sizes = np.diff(lists.offsets.to_numpy())
        each, code, times = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True, return_counts=True)
        shared = times > 1  # others are in one set only
        number = np.cumsum(shared) - 1
        row, code = np.repeat(np.arange(n), sizes), code.ravel()
        row, code = row[shared[code]], number[code[shared[code]]]
        order = np.argsort(code, kind="stable")
        row, code = row[order], code[order]
        common = np.zeros((n, n), np.float32)
        for a in range(0, int(shared.sum()), 2048):
            lo, hi = np.searchsorted(code, [a, a + 2048])
            m = np.zeros((n, 2048), np.float32)
            m[row[lo:hi], code[lo:hi] - a] = 1
            common += m @ m.T
        _, component = np.unique(np.array(t.column("component").to_pylist(), object), return_inverse=True)
        _, block = np.unique(t.column("block").to_numpy(), return_inverse=True)
        link = 100 * common.astype(np.int64) >= percent * (sizes[:, None] + sizes[None, :] - common.astype(np.int64))
        link &= component.ravel()[:, None] != component.ravel()[None, :]
        if block.max(initial=0):
            link &= block.ravel()[:, None] != block.ravel()[None, :]
        ends: dict[tuple[int, int], int] = {}
        for x, y in zip(*np.nonzero(link)):
            ends.setdefault((int(x), int(component.ravel()[y])), int(y))
        node = t.column("node").chunk(0) if n else pa.array([], pa.binary())
        return pa.table({"a": node.take(pa.array([x for x, _ in ends], pa.int64())), "b": node.take(pa.array(list(ends.values()), pa.int64()))})

    return placed.groupBy("centre", "at").applyInArrow(compare, "a binary, b binary")


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` that are links: likely by their registers, sure by their full sets."""
    a = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("size_a"), F.col("registers").alias("regs_a"))
    b = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("size_b"), F.col("registers").alias("regs_b"))
    sized = pairs.join(a, "a").join(b, "b").filter(F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * percent)
    goal = percent / 100
    least = goal - SLACK * np.sqrt(goal * (1 - goal) / REGISTERS)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                regs = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("regs_a", "regs_b")]
                sizes = [batch.column(c).to_numpy().astype(float) for c in ("size_a", "size_b")]
                yield batch.select(["a", "b", "size_a", "size_b"]).filter(pa.array(similarity(*regs, *sizes) >= least))

    kept = map_arrow(sized.select("a", "b", "size_a", "size_b", "regs_a", "regs_b"), likely, "a binary, b binary, size_a long, size_b long")
    kept = stored(kept, "near-candidates")
    full = _sets(kept.select(F.col("a").alias("node")).union(kept.select("b")), nodes, docs, words)
    one = full.select(F.col("node").alias("a"), F.col("codes").alias("codes_a"))
    two = full.select(F.col("node").alias("b"), F.col("codes").alias("codes_b"))
    both = kept.join(one, "a").join(two, "b")
    shared = F.size(F.array_intersect("codes_a", "codes_b"))
    return both.filter(100 * shared >= percent * (F.col("size_a") + F.col("size_b") - shared)).select("a", "b")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs(doc_id, text)``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their shingle sets;
    component_id is the smallest doc_id within reach and ``kept`` says whether it is the row's
    own. A text of fewer than ``words`` words is one shingle; a null, empty or blank text has
    none, is linked with nothing and kept, as is a row without doc_id (component null). Rows that repeat
    an id and a text repeat in the result; different texts of one id are linked through it. An
    empty table gives no rows; other columns are left out.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = stored(sketches(docs, words), "near-sketches")
    solid = found.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)).withColumnRenamed("fingerprint", "node")
    # One node per distinct set; its texts are read again under its smallest id.
    least = solid.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    nodes = stored(solid.join(least, ["node", "doc_id"]).dropDuplicates(["node"]), "near-nodes")
    of_id = solid.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b")
    ties = stored(solid.join(of_id.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b")).filter("a <> b"), "near-ties")

    keys = nodes.select("node", F.explode(band_keys(F.col("registers"))).alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = stored(keys.join(shared, "key"), "near-buckets")
    weight = buckets.groupBy("node").agg(F.sum("n").alias("weight"))
    centre = buckets.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node")).alias("c"))
    stars = buckets.join(centre.select("key", F.col("c.node").alias("centre")), "key")
    stars = stored(stars.filter("node <> centre").select("centre", "node").distinct(), "near-stars")
    links = ties
    if not stars.isEmpty():
        links = links.union(stored(_confirmed(stars.select(F.col("centre").alias("a"), F.col("node").alias("b")), nodes, docs, words, percent), "near-links"))
        reached = stored(components(nodes, links), "near-components")
        links = links.union(stored(_across(stars.join(reached, "node"), nodes, docs, words, percent), "near-across"))
    reached = stored(components(nodes, links), "near-components")
    ids = stored(solid.select("node", "doc_id").join(reached, "node").select("doc_id", "component"), "near-ids")
    names = ids.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_id = ids.distinct().join(names, "component").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return (
        found.select("doc_id", "n_shingles").join(by_id, "doc_id", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def op3_setsketch(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
s as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' ')) end) as s from w),
e as (select doc_id, unnest(s) as x from s),
p as (select a.doc_id as a, b.doc_id as b, count(*) as shared from e a join e b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join s x on x.doc_id = a join s y on y.doc_id = b where 100 * shared >= 85 * (len(x.s) + len(y.s) - shared)),
both_ways as (select a, b from l union all select b, a from l),
r(doc_id, t) as (select a, a from both_ways union select r.doc_id, b.b from r join both_ways b on r.t = b.a),
c as (select doc_id, min(t) as component_id from r group by 1)
select s.doc_id, len(s.s) as n_shingles, coalesce(component_id, s.doc_id) as component_id,
       s.doc_id = coalesce(component_id, s.doc_id) as kept
from s left join c using (doc_id)
"""

QUERIES = {"op3_setsketch": (op3_setsketch, SQL)}
