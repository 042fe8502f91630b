"""Repeated passages by hash-compared suffix sorting.

A byte goes if some string of ``length`` bytes (``LENGTH`` unless told otherwise) that covers it also starts anywhere else.

1. Anchors deal out the work. Of the grams within each window of ``length`` bytes the one of least
   hash is the window's anchor, so equal windows have equal anchors at equal offsets. Windows
   with the same anchor lie side by side; such a run is sent as one narrow row with
   hashes of its anchor and of all its bytes (the context).
2. Counts of (anchor, context) settle most: a context met twice is repeated throughout,
   an anchor met once is not.
3. What is left, contexts that share an anchor but differ, is where passages end. Their bytes meet
   by anchor. Suffixes at equal offsets are merge-sorted; two suffixes compare by their longest
   common extension, which a binary search over prefix polynomial hashes finds, so a comparison
   takes a logarithmic number of steps. Neighbours in order whose common extension reaches
   ``length`` are compared byte by byte, so that a hash collision can't remove anything.
4. An anchor with more than ``GROUP`` contexts is dealt over salts that are sorted apart; what
   is then still single meets by a 128-bit hash of the window, in sums.
5. Spans are gathered per text and cut out.

Texts are known by their MD5 digest: copies of a text share their result, and repeated ids don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import bounded_batches, map_arrow, stored, table, text_bytes, text_slices, widened

LENGTH = 400
#: A gram has the bytes of a window divided by this.
GRAMS = 4
#: Contexts of one anchor that are sorted together, contexts of one task, windows sorted in one go, window starts looked at in one go.
GROUP, TASK, WINDOWS, SEGMENT = 2_000, 10_000, 200_000, 1 << 22
PLACE_BITS = 24
_BASES = (0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and their inverses, for up to ``n`` bytes."""
    inverse = np.uint64(pow(base, -1, 1 << 64))
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]))
        down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse, np.uint64)]))
    return up, down


def _table_size(n: int) -> int:
    return 1 << max(16, int(n).bit_length())


class Prefixes:
    """Prefix polynomial hashes of some bytes: the hash of any slice in constant time."""

    def __init__(self, raw: np.ndarray, base: int = _BASES[0]):
        up, self.down = _powers(base, _table_size(len(raw)))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)])])

    def hash(self, start: np.ndarray, length: int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.down[start]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    n = len(v)
    padded = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = v
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def anchor_runs(raw: np.ndarray, bounds: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first and last window start, place and hash of the anchor."""
    gram, parts = length // GRAMS, []
    for at in range(0, max(0, len(raw) - length + 1), SEGMENT):
        piece = raw[at : at + SEGMENT + length - 1]
        if len(piece) < length:
            break
        grams = _mixed(Prefixes(piece).hash(np.arange(len(piece) - gram + 1), gram))
        place = np.uint64((1 << PLACE_BITS) - 1)
        coded = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
        anchor = (_sliding_least(coded, length - gram + 1) & place).astype(np.int64)
        edge = np.zeros(len(anchor) + 1, np.int64)
        first = np.clip(bounds[:-1] - at, 0, len(anchor))
        last = np.clip(bounds[1:] - length + 1 - at, 0, len(anchor))
        some = last > first
        np.add.at(edge, first[some], 1)
        np.add.at(edge, last[some], -1)
        inside = np.cumsum(edge[:-1]) > 0
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1]
        lo = np.flatnonzero(inside & new)
        stop = np.ones(len(anchor), bool)
        stop[:-1] = new[1:] | ~inside[1:]
        hi = np.flatnonzero(inside & stop)
        parts.append((lo + at, hi + at, anchor[lo] + at, grams[anchor[lo]].view(np.int64)))
    if not parts:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*parts))


def _digest(data) -> bytes:
    return hashlib.md5(data, usedforsecurity=False).digest()


def _read(part: pa.RecordBatch, column: str = "text"):
    raw, bounds = text_bytes(part.column(column))
    data = raw.tobytes()
    return raw, bounds, data


def anchors(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Runs of ``docs(text)``: anchor, context (hashes), fp (the text's digest), lo, hi, off (anchor's place behind lo)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text"):
            raw, bounds, data = _read(part)
            lo, hi, place, anchor = anchor_runs(raw, bounds, length)
            view = memoryview(data)
            context = np.frombuffer(b"".join(hashlib.blake2b(view[a : b + length], digest_size=8).digest() for a, b in zip(lo.tolist(), hi.tolist())), np.int64)
            # The offset belongs to what must agree.
            context = context ^ (place - lo) * np.int64(0x5851F42D4C957F2D)
            doc = np.searchsorted(bounds, lo, "right") - 1
            prints = pa.array([_digest(view[a:b]) if b - a >= length else b"" for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(context), prints.take(pa.array(doc)), pa.array((lo - bounds[doc]).astype(np.int32)), pa.array((hi - bounds[doc]).astype(np.int32)), pa.array((place - lo).astype(np.int32))],
                names=["anchor", "context", "fp", "lo", "hi", "off"],
            )

    return map_arrow(docs.select("text"), run, "anchor long, context long, fp binary, lo int, hi int, off int")


def common_extension(prefixes: Prefixes, x: np.ndarray, y: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Longest common extension of suffixes x and y, up to ``most``: binary search over slice hashes."""
    length = np.zeros(len(x), np.int64)
    step = 1 << (most.bit_length() - 1)
    while step:
        fits = np.flatnonzero(length + step <= most)
        a, b = x[fits] + length[fits], y[fits] + length[fits]
        same = prefixes.hash(a, step) == prefixes.hash(b, step)
        length[fits[same]] += step
        step >>= 1
    return length


def suffix_sort(raw: np.ndarray, prefixes: Prefixes, starts: np.ndarray, segment: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Order of ``starts`` by segment, then by the ``length`` bytes there.

    Bottom-up mergesort of all segments side by side: at each width, every suffix finds its
    place in the sibling run by binary search, comparing by common extension.
    """
    order = np.argsort(segment, kind="stable")
    head = np.flatnonzero(np.append(True, np.diff(segment[order]) != 0))
    size = np.diff(np.append(head, len(order)))
    begin, total = np.repeat(head, size), np.repeat(size, size)  # per place in order
    local = np.arange(len(order)) - begin
    width = 1
    while width < (size.max() if len(size) else 0):
        run = local // width
        left = run % 2 == 0
        other = np.where(left, run + 1, run - 1) * width
        low = np.minimum(other, total)
        low, high = low.copy(), np.minimum(other + width, total)
        sibling = low.copy()
        active = np.flatnonzero(low < high)
        while len(active):
            middle = (low[active] + high[active]) // 2
            mine, theirs = starts[order[active]], starts[order[begin[active] + middle]]
            common = common_extension(prefixes, mine, theirs, length)
            whole = common >= length
            at = np.minimum(common, length - 1)
            less = np.where(whole, ~left[active], raw[theirs + at] < raw[mine + at])  # equal ones of the left run come first
            low[active] = np.where(less, middle + 1, low[active])
            high[active] = np.where(less, high[active], middle)
            active = active[low[active] < high[active]]
        pair = (run // 2) * 2 * width
        place = begin + pair + (local - run * width) + (low - sibling)
        moved = np.empty_like(order)
        moved[place] = order
        order, width = moved, width * 2
    return order


def _same_bytes(raw: np.ndarray, x: np.ndarray, y: np.ndarray, length: int) -> np.ndarray:
    windows = np.lib.stride_tricks.sliding_window_view(raw, length) if len(raw) >= length else None
    out = np.zeros(len(x), bool)
    for a in range(0, len(x), 4096):
        out[a : a + 4096] = (windows[x[a : a + 4096]] == windows[y[a : a + 4096]]).all(axis=1)
    return out


_SORTED = "fp binary, lo int, hi int, h1 long, h2 long, weight int"


def _sort_task(left: pa.Table, length: int = LENGTH) -> pa.Table:
    """Repeated windows of the contexts in one task, whole anchors of about ``WINDOWS`` windows at a time."""
    t = left.combine_chunks()
    anchor, salt = (t.column(c).to_numpy() for c in ("anchor", "salt"))
    order = np.lexsort((salt, anchor))
    windows = np.cumsum(pc.binary_length(t.column("bytes")).to_numpy()[order].astype(np.int64) - length + 1)
    ends = np.flatnonzero(np.append((np.diff(anchor[order]) != 0) | (np.diff(salt[order]) != 0), True)) + 1
    out, start = [], 0
    while start < len(order):
        done = windows[start - 1] if start else 0
        # The last end of an anchor within the bound, or the first one behind the start.
        stop = ends[max(np.searchsorted(windows[ends - 1], done + WINDOWS, "right") - 1, np.searchsorted(ends, start, "right"))]
        out.append(_sort_slice(t.take(pa.array(order[start:stop])).combine_chunks(), length))
        start = int(stop)
    return pa.concat_tables(out)


def _sort_slice(t: pa.Table, length: int) -> pa.Table:
    """Repeated windows of some anchors' contexts; single windows of salted anchors as hashes."""
    n = t.num_rows
    get = lambda c: t.column(c).chunk(0)
    data = get("bytes")
    offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    count = np.diff(offsets) - length + 1
    owner = np.repeat(np.arange(n), count)
    step = np.arange(len(owner)) - np.repeat(np.append(0, np.cumsum(count)[:-1]), count)
    starts = offsets[:-1][owner] + step
    _, group = np.unique(np.stack([get("anchor").to_numpy(), get("salt").to_numpy()], axis=1), axis=0, return_inverse=True)
    segment = group.ravel()[owner] * (length + 1) + (get("off").to_numpy()[owner] - step)
    prefixes = Prefixes(raw)
    order = suffix_sort(raw, prefixes, starts, segment, length)
    a, b = order[:-1], order[1:]
    near = np.flatnonzero((segment[a] == segment[b]) & (prefixes.hash(starts[a], length) == prefixes.hash(starts[b], length)))
    near = near[_same_bytes(raw, starts[a[near]], starts[b[near]], length)]
    repeated = np.zeros(len(starts), bool)
    repeated[a[near]] = repeated[b[near]] = True
    opened = get("open").to_numpy(zero_copy_only=False)
    hit = np.flatnonzero(repeated & opened[owner])
    cut = np.flatnonzero(np.append(True, (np.diff(hit) != 1) | (owner[hit[1:]] != owner[hit[:-1]]))) if len(hit) else np.zeros(0, np.int64)
    tail = np.append(cut[1:], len(hit)) - 1 if len(hit) else cut
    base = get("lo").to_numpy()
    fps = get("fp")
    own = owner[hit[cut]]
    columns = [[fps.take(pa.array(own)), base[own] + step[hit[cut]], base[own] + step[hit[tail]], np.zeros(len(own), np.int64), np.zeros(len(own), np.int64), np.zeros(len(own), np.int32)]]
    salted = get("salted").to_numpy(zero_copy_only=False)[owner]
    if salted.any():
        # One row per class of equal windows, and each single window under its own name.
        first = np.ones(len(order), bool)
        first[b[near]] = False
        rows = np.flatnonzero(salted & first)
        second = Prefixes(raw, _BASES[1])
        h1, h2 = (_mixed(p.hash(starts[rows], length)).view(np.int64) for p in (prefixes, second))
        own = owner[rows]
        weight = np.where(repeated[rows], 2, np.where(opened[own], 1, 3)).astype(np.int32)
        columns.append([fps.take(pa.array(own)), base[own] + step[rows], base[own] + step[rows], h1, h2, weight])
    parts = [pa.table({k: v for k, v in zip(("fp", "lo", "hi", "h1", "h2", "weight"), c)}) for c in columns]
    schema = pa.schema([("fp", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("weight", pa.int32())])
    return pa.concat_tables([p.cast(schema) for p in parts])


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """fp and spans (array of struct lo, hi: window starts) of each text of ``docs(text)`` with repeated bytes."""
    bounded_batches(docs.sparkSession)
    runs = stored(anchors(docs, length), "suffix-anchors")
    contexts = stored(runs.groupBy("anchor", "context").agg(F.count("*").alias("n")), "suffix-contexts")
    shared = contexts.groupBy("anchor").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum((F.col("n") == 1).cast("int")).alias("open_kinds"))
    shared = shared.filter("total > 1").select("anchor", "kinds", "open_kinds")
    busy = stored(contexts.join(shared, "anchor"), "suffix-shared")
    met = stored(runs.join(busy, ["anchor", "context"]), "suffix-met")
    settled = met.filter("n > 1").select("fp", "lo", "hi").distinct()
    open_ = met.filter("n = 1").select("anchor", "context", "fp", "lo", "hi", "off", "kinds")
    spare = met.filter("n > 1 and open_kinds > 0").groupBy("anchor", "context", "kinds").agg(F.min(F.struct("fp", "lo", "hi", "off")).alias("r"))
    spare = spare.select("anchor", "context", "r.fp", "r.lo", "r.hi", "r.off", "kinds")
    sides = open_.withColumn("open", F.lit(True)).unionByName(spare.withColumn("open", F.lit(False)))
    salts = F.ceil(F.col("kinds") / GROUP)
    sides = sides.withColumn("salt", F.pmod(F.xxhash64("context"), salts)).withColumn("salted", salts > 1).drop("context", "kinds")
    by_text = stored(sides.groupBy("fp").agg(F.collect_list(F.struct("anchor", "salt", "salted", "lo", "hi", "off", "open")).alias("runs"), F.count("*").alias("n")), "suffix-open")
    total = by_text.agg(F.sum("n")).first()[0]
    if not total:
        return settled.groupBy("fp").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    tasks = -(-total // TASK)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: bytes | None = None
        for part in text_slices(batches, "text"):
            _, bounds, data = _read(part)
            out: list[dict] = []
            for i, (fp, found) in enumerate(zip(part.column("fp").to_pylist(), part.column("runs").to_pylist())):
                if fp == seen:  # copies lie side by side
                    continue
                seen = fp
                at = int(bounds[i])
                for r in found:
                    out.append({"fp": fp, **r, "bytes": data[at + r["lo"] : at + r["hi"] + length]})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("fp", pa.binary()), ("anchor", pa.int64()), ("salt", pa.int64()), ("salted", pa.bool_()), ("lo", pa.int32()), ("hi", pa.int32()), ("off", pa.int32()), ("open", pa.bool_()), ("bytes", pa.binary())])
    named = docs.select("text", F.unhex(F.md5(F.col("text").cast("binary"))).alias("fp")).join(by_text.select("fp", "runs"), "fp")
    texts = named.select("fp", "text", "runs").sortWithinPartitions("fp")
    sides = map_arrow(texts, cut, "fp binary, anchor long, salt long, salted boolean, lo int, hi int, off int, open boolean, bytes binary")
    dealt = sides.withColumn("task", F.pmod(F.xxhash64("anchor", "salt"), F.lit(tasks)))
    found = stored(dealt.groupBy("task").applyInArrow(lambda t: _sort_task(t, length), _SORTED), "suffix-sorted")
    ends = found.filter("weight = 0").select("fp", "lo", "hi")
    hashed = found.filter("weight > 0")
    again = hashed.groupBy("h1", "h2").agg(F.sum("weight").alias("w")).filter("w > 1").select("h1", "h2")
    across = hashed.filter("weight = 1").join(again, ["h1", "h2"]).select("fp", "lo", "hi")
    return settled.union(ends).union(across).groupBy("fp").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with its text cut and n_bytes, n_removed, n_spans (long) and kept_sha256.

    Every byte that some string of ``length`` bytes covers which starts anywhere else in the table, the same text
    included, is removed; n_spans counts the maximal runs removed, and kept_sha256 is that of the remaining bytes. Where a
    cut splits a character, the new text leaves the broken rest of it out. A null text counts as empty and stays
    null; a row that repeats is a copy, so all of both goes if it is long enough; an empty table gives no rows.
    Columns of docs with one of the new names are replaced.
    """
    if length < GRAMS:
        raise ValueError(f"a passage has {GRAMS} bytes at least, not {length}")
    made = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "_fp", "_spans")
    source = docs.drop(*(c for c in made if c != text))
    texts = source.select(F.col(text).alias("text"))
    spans = stored(repeated_spans(texts, length), "suffix-spans").select(F.col("fp").alias("_fp"), F.col("spans").alias("_spans"))
    named = source.withColumn("_fp", F.unhex(F.md5(F.col(text).cast("binary")))).join(spans, "_fp", "left").drop("_fp")
    named = named.withColumn("_suffix_text", F.col(text))
    carried = [c for c in source.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nulls = batch.column("_suffix_text").is_null().to_pylist()
            batch = batch.append_column(pa.field("_null", pa.bool_()), pa.array(nulls))
            for part in text_slices(iter([batch]), "_suffix_text"):
                _, bounds, data = _read(part, "_suffix_text")
                view, rows = memoryview(data), []
                for i, (found, null) in enumerate(zip(part.column("_spans").to_pylist(), part.column("_null").to_pylist())):
                    at, end = int(bounds[i]), int(bounds[i + 1])
                    kept, place, removed, n = [], at, 0, 0
                    for lo, hi in sorted((s["lo"] + at, s["hi"] + at + length) for s in found or ()):
                        if lo > place or not n:
                            kept.append(view[place:lo])
                            n += 1
                            removed += hi - lo
                            place = hi
                        elif hi > place:
                            removed += hi - place
                            place = hi
                    kept.append(view[place:end])
                    rest = b"".join(kept)
                    rows.append((None if null else rest.decode("utf-8", "ignore"), end - at, removed, n, hashlib.sha256(rest).hexdigest()))
                new, *numbers = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in carried] + [pa.array(new, pa.string()), *(pa.array(x, pa.int64()) for x in numbers[:3]), pa.array(numbers[3], pa.string())],
                    names=[*carried, text, "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    schema = widened(source.select(*carried), f"`{text}` string, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return map_arrow(named.select(*carried, "_suffix_text", "_spans"), run, schema)


def op2_suffix_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).drop("text")


QUERIES = {"op2_suffix_dedup": (op2_suffix_dedup, None)}
