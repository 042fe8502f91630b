"""Byte-level BPE encoding and decoding.

Text is cut into pieces without a regular expression. Every code point has a
class (letter, number, white space, other); white space and apostrophes also look
one or two characters ahead, which is folded into the class. A small automaton
reads the classes; a character starts a piece depending on the state before it. Each
class is a function on states, and functions compose associatively, so the state before
every character of a whole slice of documents comes from a prefix scan over function
numbers with a composition table, in numpy and not character by character.

The pieces are slices of the text's own bytes (an Arrow array over the same
buffer). Arrow numbers the distinct pieces of a slice, merges run once for each of
them behind a cache, and ids are dealt back to the documents by piece number. The byte
offset of every token is returned with the ids; decoding takes token bytes by id.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import map_arrow, table, text_bytes, text_slices, widened

#: Pieces whose ids a worker remembers.
CACHE = 1 << 18

# Classes of characters.
LETTER, NUMBER, OTHER, SHORT, LONG, SPACE_LAST, GAP_LAST, GAP = range(8)
# States after a character: in a letter, number or other run, after the space that
# opens a piece, in white space, piece closed, one or two letters of a contraction to come.
S_LETTER, S_NUMBER, S_OTHER, S_SPACE, S_GAP, S_CLOSED, S_ONE, S_TWO = range(8)


def _step(state: int, kind: int) -> tuple[int, bool]:
    """State after a character of this class, and whether the character starts a piece."""
    if kind == LETTER:
        if state in (S_LETTER, S_SPACE):
            return S_LETTER, False
        if state in (S_ONE, S_TWO):
            return (S_CLOSED if state == S_ONE else S_ONE), False
        return S_LETTER, True
    if kind == NUMBER:
        return S_NUMBER, state not in (S_NUMBER, S_SPACE)
    if kind in (OTHER, SHORT, LONG):
        if state in (S_OTHER, S_SPACE):
            return S_OTHER, False
        return {OTHER: S_OTHER, SHORT: S_ONE, LONG: S_TWO}[kind], True
    if kind == GAP:
        return S_GAP, state != S_GAP
    return (S_SPACE if kind == SPACE_LAST else S_CLOSED), True


@lru_cache(maxsize=1)
def automaton():
    """Function numbers of classes (row 1: at a document's start), composition, state after each function, starts."""
    inside = [tuple(_step(s, k)[0] for s in range(8)) for k in range(8)]
    first = [(_step(S_CLOSED, k)[0],) * 8 for k in range(8)]
    known = {f: i for i, f in enumerate(dict.fromkeys([tuple(range(8)), *inside, *first]))}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in list(known):
            for h in (tuple(g[x] for x in f), tuple(f[x] for x in g)):
                if h not in known:
                    known[h] = len(known)
                    todo.append(h)
    functions = list(known)
    compose = np.array([[known[tuple(g[x] for x in f)] for g in functions] for f in functions], np.uint8 if len(known) < 256 else np.uint16)
    numbers = np.array([[known[f] for f in inside], [known[f] for f in first]], compose.dtype)
    starts = np.array([[_step(s, k)[1] for k in range(8)] for s in range(8)])
    return numbers, compose, np.array(functions, np.uint8), starts


def scan(f: np.ndarray, compose: np.ndarray, width: int = 64) -> np.ndarray:
    """Inclusive prefix composition: blocks side by side, then the blocks' totals, then both."""
    n, m = len(f), len(compose)
    if n <= width:
        out = f.copy()
        for j in range(1, n):
            out[j] = compose[out[j - 1], f[j]]
        return out
    rows = -(-n // width)
    block = np.zeros((rows, width), f.dtype)  # 0 is the identity
    block.ravel()[:n] = f
    block = np.ascontiguousarray(block.T)
    flat = compose.ravel()
    for j in range(1, width):
        block[j] = flat[block[j - 1].astype(np.intp) * m + block[j]]
    total = scan(block[-1], compose, width)
    before = np.concatenate([np.zeros(1, f.dtype), total[:-1]])
    block = flat[before.astype(np.intp)[None, :] * m + block]
    return np.ascontiguousarray(block.T).ravel()[:n]


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of each code point, white space as GAP."""
    import regex

    kinds = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, range(0xD800))) + "\0" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", GAP)):
        for m in regex.finditer(pattern, every):
            kinds[m.start() : m.end()] = kind
    for c in range(0x1C, 0x20):  # separators are no white space in the pattern's sense
        kinds[c] = OTHER
    return kinds


def piece_starts(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Byte offsets at which pieces start in documents that lie one after the other."""
    if not len(raw):
        return np.zeros(0, np.int64)
    at = np.flatnonzero((raw & 0xC0) != 0x80)
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    kind = classes()[points]
    n = len(points)
    first = np.zeros(n + 2, bool)
    first[np.searchsorted(at, bounds[:-1][bounds[:-1] < bounds[1:]])] = True
    first[n:] = True
    gap = kind == GAP
    # The last white space before anything else of the same document.
    last = gap & ~first[1 : n + 1]
    last[:-1] &= ~gap[1:]
    kind[last] = np.where(points[last] == 0x20, SPACE_LAST, GAP_LAST)
    quote = np.flatnonzero(points == 0x27)
    if len(quote):
        after = np.concatenate([points, [0, 0]])
        one = np.where(first[quote + 1], 0, after[quote + 1])
        two = np.where(first[quote + 1] | first[quote + 2], 0, after[quote + 2])
        kind[quote[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
        pair = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            pair |= (one == ord(a)) & (two == ord(b))
        kind[quote[pair]] = LONG
    numbers, compose, states, starts = automaton()
    after = states[scan(numbers[first[:n].astype(np.intp), kind], compose), S_CLOSED]
    before = np.concatenate([np.array([S_CLOSED], np.uint8), after[:-1]])
    before[first[:n]] = S_CLOSED
    return at[starts[before, kind]]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: always merge the leftmost pair of lowest rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n > 100:
        return _merge_long(piece, ranks)
    none = len(ranks) + (1 << 40)
    pairs = [ranks.get(piece[i : i + 2], none) for i in range(n - 1)]
    cuts = list(range(n + 1))
    while pairs:
        low = min(pairs)
        if low == none:
            break
        i = pairs.index(low)
        del cuts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(piece[cuts[i] : cuts[i + 2]], none)
        if i:
            pairs[i - 1] = ranks.get(piece[cuts[i - 1] : cuts[i + 1]], none)
    return [ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap, for pieces without end."""
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # starts of the neighbouring parts
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or after[j] != end:
            continue
        alive[j] = False
        after[i] = end
        if end < n:
            before[end] = i
            if (r := ranks.get(piece[i : after[end]])) is not None:
                heapq.heappush(heap, (r, i, after[end]))
        if (h := before[i]) >= 0 and (r := ranks.get(piece[h:end])) is not None:
            heapq.heappush(heap, (r, h, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Tokenizer:
    """Ranks from lines of base64 token and id; one per Python worker and file."""

    def __init__(self, lines: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}
        size = max(self.ranks.values(), default=-1) + 1
        tokens = [b""] * size
        for token, i in self.ranks.items():
            tokens[i] = token
        self.tokens = pa.array(tokens, pa.large_binary())
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.cache: dict[bytes, list[int]] = {}

    def piece_ids(self, piece: bytes) -> list[int]:
        ids = self.cache.get(piece)
        if ids is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            ids = merge(piece, self.ranks)
            if len(piece) < 64:
                self.cache[piece] = ids
        return ids

    def encode(self, text: pa.StringArray) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids and the byte offset of each token, per text."""
        raw, bounds = text_bytes(text)
        starts = piece_starts(raw, bounds)
        ends = np.append(starts, len(raw)).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw))])
        coded = pieces.dictionary_encode()
        each = [self.piece_ids(p) for p in coded.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, each), np.int64, len(each))
        flat = np.fromiter((i for ids in each for i in ids), np.int32, int(sizes.sum()))
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lists = pa.LargeListArray.from_arrays(np.append(0, np.cumsum(sizes)), pa.array(flat, pa.int32()))
        ids = lists.take(pa.array(code)).flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        tokens_before = np.append(0, np.cumsum(sizes[code]))
        # Tokens of a document: those of the pieces that start within it.
        cuts = tokens_before[np.searchsorted(starts, bounds)].astype(np.int32)
        place = np.cumsum(self.lengths[ids]) - self.lengths[ids]
        place -= np.repeat(bounds[:-1], np.diff(cuts))
        offsets = pa.array(cuts, pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.ListArray.from_arrays(offsets, pa.array(place.astype(np.int32)))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Bytes of each list of ids."""
        flat = ids.flatten()
        sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        data = self.tokens.take(flat)
        number = flat.to_numpy(zero_copy_only=False)
        cuts = np.append(0, np.cumsum(self.lengths[number]))[np.append(0, np.cumsum(sizes))].astype(np.int64)
        joined = data.buffers()[2] if len(flat) else pa.py_buffer(b"")
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(cuts), joined]).cast(pa.binary())


@lru_cache(maxsize=2)
def _tokenizer(lines: bytes) -> Tokenizer:
    return Tokenizer(lines)


def _load(path: str) -> bytes:
    """The vocabulary's lines, read once on the driver and sent with the tasks: under 1 MB for 50,000 tokens."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, path: str, text: str = "text", check: bool = False) -> DataFrame:
    """``docs`` with ``ids`` and ``offsets`` (arrays of int) in place of columns of these names.

    With ``check`` the worker decodes the ids again and ``round_trip`` says whether they give the text's bytes.

    ids are those of the public pattern and the ranks of the file at ``path``,
    without special tokens; offsets say at which byte of the text each token starts.
    Null and empty texts have empty arrays; repeated rows repeat; an empty table gives
    no rows. Texts are encoded whole, however long, about 1 MB of them at a time.
    """
    lines = docs.sparkSession.sparkContext.broadcast(_load(path))
    made = ("ids", "offsets", "round_trip") if check else ("ids", "offsets")
    kept = docs.drop(*(c for c in made if c != text))
    carried = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(lines.value)
        for part in text_slices(batches, "_bpe_text"):
            ids, offsets = tokenizer.encode(part.column("_bpe_text"))
            columns = [part.column(c) for c in carried] + [ids, offsets]
            if check:
                columns.append(pc.equal(tokenizer.decode(ids), part.column("_bpe_text").cast(pa.binary())))
            yield pa.RecordBatch.from_arrays(columns, names=[*carried, *made])

    schema = widened(kept, "ids array<int>, offsets array<int>" + ", round_trip boolean" * check)
    return map_arrow(kept.withColumn("_bpe_text", F.col(text)), run, schema)


def decode(tokens: DataFrame, path: str, ids: str = "ids", rows: int = 256) -> DataFrame:
    """``tokens`` with ``decoded`` (binary) in place of the ids; null and empty lists give no bytes."""
    lines = tokens.sparkSession.sparkContext.broadcast(_load(path))
    kept = [c for c in tokens.columns if c not in (ids, "decoded")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(lines.value)
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                decoded = tokenizer.decode(part.column(ids))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [decoded], names=[*kept, "decoded"])

    schema = widened(tokens.select(*kept), "decoded binary")
    return map_arrow(tokens, run, schema)


def op8_byte_bpe(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"), "ids",
    )
    return decode(encoded, path).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op8_byte_bpe": (op8_byte_bpe, None)}
