"""Language of a text by unigrams of pieces, summed over all segmentations.

Words are runs of letters in lower case behind one space, in UTF-8. The pieces are those of a fixed
public vocabulary that can stand in such a word, every single byte among them, so each word can be
segmented. A language gives each piece a probability, and a word the sum over all its
segmentations of the products of their pieces: a forward pass over its bytes. A text's score is the
sum of the logarithms over its words.

Learning is expectation maximisation from a start by vocabulary rank: forward and backward
passes give the expected count of every piece in every training word, tasks sum them per language, and one
row per task, language and piece is shuffled. Early rounds read a bounded sample of training
documents, the last one all of them. The model is a table of pieces by languages, whose size the
vocabulary and the languages fix; it is broadcast in parts of ``PART`` languages.

Words of a piece of text are handled together: hashes of all byte runs grow by one byte at a
time, runs that begin no piece drop out, and passes go by place in the word over numpy arrays.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import map_arrow, table, text_bytes, text_slices, widened

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Longest piece and longest word in bytes (a longer run of letters counts as several words).
PIECE, WORD_BYTES = 16, 48
#: Bytes of text whose distinct words are found together, words of a lattice, slots of the table of pieces (2**18).
SLICE, WORDS, SLOTS = 1 << 22, 8_192, 1 << 18
#: Documents of an early round (in expectation), rounds, languages of a part of the model and of a numpy pass.
SAMPLE, ROUNDS, PART, TILE = 20_000, 2, 128, 8
#: Weights of the vocabulary's order in the pooled probabilities, and of these in a language's; scale of a byte against underflow.
ORDER, POOLED, BYTE = 1_000.0, 1_000.0, 1e4
UNKNOWN = "und"
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Pieces:
    """A vocabulary: its pieces in order of rank."""

    pieces: tuple[bytes, ...]

    @classmethod
    def read(cls, path: str, longest: int = PIECE) -> Pieces:
        """The pieces of a rank file that can stand in a word, and all single bytes."""
        with open(path, "rb") as file:
            ranked = [base64.b64decode(line.split()[0]) for line in file if line.strip()]
        letters = set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
        fits = [p for p in ranked if 1 < len(p) <= longest and set(p[1:]) <= letters and p[0] in letters | {0x20}]
        return cls(tuple([bytes([b]) for b in range(256)] + fits))

    def start(self) -> np.ndarray:
        """Probabilities that fall with the rank."""
        p = 1.0 / (np.arange(len(self.pieces)) + 50)
        return p / p.sum()

    @cached_property
    def slots(self) -> tuple[np.ndarray, np.ndarray]:
        """Open addressing: hash of every beginning of a piece, and its number (-1: no piece itself)."""
        known = {p: i for i, p in enumerate(self.pieces)}
        runs = {p[:n]: known.get(p[:n], -1) for p in self.pieces for n in range(1, len(p) + 1)}
        keys, values = np.zeros(SLOTS, np.uint64), np.full(SLOTS, -1, np.int32)
        for run, number in runs.items():
            h = 0
            for b in run:
                h = (h * int(_STEP) + b + 1) & (1 << 64) - 1
            at = (h * int(_STEP) & (1 << 64) - 1) >> 46
            while keys[at]:
                at = (at + 1) % len(keys)
            keys[at], values[at] = h, number
        return keys, values

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash begins a piece, and the piece it is."""
        keys, values = self.slots
        at = ((hashes * _STEP) >> np.uint64(46)).astype(np.int64)
        open_ = np.flatnonzero((keys[at] != hashes) & (keys[at] != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) % len(keys)
            open_ = open_[(keys[at[open_]] != hashes[open_]) & (keys[at[open_]] != 0)]
        return keys[at] == hashes, values[at]


class Lattice:
    """All pieces at all places of some words."""

    def __init__(self, words: pa.StringArray, pieces: Pieces) -> None:
        raw, bounds = text_bytes(words)
        sizes = np.diff(bounds) + 1  # with the space in front
        self.n = len(words)
        #: A node per place in a word, the end included; words lie one behind the other.
        self.first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
        self.last = self.first + sizes
        self.nodes = int(sizes.sum()) + self.n
        text = np.zeros(self.nodes, np.uint64)
        letter = np.ones(self.nodes, bool)
        letter[self.first] = letter[self.last] = False
        text[self.first], text[letter] = 0x20, raw
        text += np.uint64(1)
        place = np.arange(self.nodes) - np.repeat(self.first, sizes + 1)
        left = np.repeat(sizes, sizes + 1) - place
        at, hashes = np.flatnonzero(left > 0), np.zeros(self.nodes, np.uint64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        hashes = hashes[at]
        for n in range(1, PIECE + 1):
            with np.errstate(over="ignore"):
                hashes = hashes * _STEP + text[at + n - 1]
            begins, number = pieces.find(hashes)
            whole = number >= 0
            whole &= begins
            found.append((at[whole], at[whole] + n, number[whole]))
            on = begins & (left[at] > n)
            at, hashes = at[on], hashes[on]
            if not len(at):
                break
        start, end, piece = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        order = np.argsort(place[start].astype(np.uint16), kind="stable")
        self.start, self.end, self.piece = start[order], end[order], piece[order]
        self.bounds = np.searchsorted(place[self.start], np.arange(int(sizes.max(initial=0)) + 1))
        back = np.argsort(place[self.end].astype(np.uint16), kind="stable")
        self.back = back
        self.back_bounds = np.searchsorted(place[self.end[back]], np.arange(1, int(sizes.max(initial=0)) + 2))
        self.size = sizes

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Per node and column the sum over all ways that lead there; ``weight`` is per edge."""
        alpha = np.zeros((self.nodes, weight.shape[1]))
        alpha[self.first] = 1
        for lo, hi in zip(self.bounds, self.bounds[1:]):
            # Edges from one place differ in word or length, so no end is met twice.
            alpha[self.end[lo:hi]] += np.take(alpha, self.start[lo:hi], axis=0) * weight[lo:hi]
        return alpha

    def expected(self, weight: np.ndarray, counts: np.ndarray, n_pieces: int) -> np.ndarray:
        """Expected uses of each piece if word i occurs counts[i] times."""
        alpha = self.forward(weight[:, None])[:, 0]
        beta = np.zeros(self.nodes)
        beta[self.last] = 1
        for lo, hi in reversed(list(zip(self.back_bounds, self.back_bounds[1:]))):
            these = self.back[lo:hi]  # edges to one place differ in word or start
            beta[self.start[these]] += weight[these] * beta[self.end[these]]
        whole = np.repeat(counts / alpha[self.last], self.size + 1)
        return np.bincount(self.piece, alpha[self.start] * weight * beta[self.end] * whole[self.start], n_pieces)

    def log_sums(self, scaled: np.ndarray) -> np.ndarray:
        """Per word and language the logarithm of its probability; ``scaled`` holds a row per piece."""
        parts = [self.forward(np.take(scaled[:, c : c + TILE], self.piece, axis=0))[self.last] for c in range(0, scaled.shape[1], TILE)]
        return np.log(np.hstack(parts)) - self.size[:, None] * np.log(BYTE)


def words_of(text: pa.Array) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """Distinct words of some texts, and for each occurrence its number and its text."""
    split = pc.split_pattern_regex(pc.utf8_lower(text), r"\P{L}+")
    owner = np.repeat(np.arange(len(text)), np.diff(split.offsets.to_numpy()))
    tokens = split.flatten().dictionary_encode()
    number, words = tokens.indices.to_numpy(), tokens.dictionary
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False)
    # What a run of letters stands for: itself, nothing (between two gaps), or several words behind the others.
    first, times = np.arange(len(words)), (sizes > 0).astype(np.int64)
    cuts: list[bytes] = []
    for i in np.flatnonzero(sizes >= WORD_BYTES):
        run, first[i] = words[i].as_py().encode("utf-8"), len(words) + len(cuts)
        while run:
            end = min(WORD_BYTES - 1, len(run))
            while end < len(run) and run[end] & 0xC0 == 0x80:
                end -= 1
            cuts.append(run[:end])
            run = run[end:]
        times[i] = len(words) + len(cuts) - first[i]
    words = pc.if_else(pa.array(sizes < WORD_BYTES), words, "")
    if cuts:
        words = pa.concat_arrays([words, pa.array(cuts, pa.binary()).cast(pa.string())])
    each = times[number]
    starts = np.repeat(first[number] - (np.cumsum(each) - each), each)
    return words, starts + np.arange(len(starts)), np.repeat(owner, each)


@dataclass(frozen=True)
class Model:
    """Piece probabilities, one column per language (in order of code point)."""

    pieces: Pieces
    languages: tuple[str, ...]
    table: np.ndarray

    def part(self, start: int) -> Model:
        return Model(self.pieces, self.languages[start : start + PART], np.ascontiguousarray(self.table[:, start : start + PART]))

    @cached_property
    def scaled(self) -> np.ndarray:
        """Probabilities times ``BYTE`` per byte of the piece."""
        return self.table * BYTE ** np.array([len(p) for p in self.pieces.pieces], np.float64)[:, None]

    def log_probabilities(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language the logarithm of its probability; and how many words each text has."""
        words, number, owner = words_of(text)
        out = np.zeros((len(text), len(self.languages)))
        if len(owner):
            parts = (words.slice(start, WORDS) for start in range(0, len(words), WORDS))
            each = np.vstack([Lattice(part, self.pieces).log_sums(self.scaled) for part in parts])
            for c in range(out.shape[1]):
                out[:, c] = np.bincount(owner, each[number, c], len(text))
        return out, np.bincount(owner, minlength=len(text))


def _count(docs: DataFrame, model: Model) -> DataFrame:
    """Expected uses per language and piece over ``docs(text, lang)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, sums = shared.value, {}
        column = {lang: i for i, lang in enumerate(model.languages)}

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, found in sums.items():
                used = np.flatnonzero(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(found[used])], names=["lang", "piece", "uses"]
                )
            sums.clear()

        for part in text_slices(batches, "text", SLICE):
            langs = part.column("lang")
            for lang in pc.unique(langs).to_pylist():
                words, number, _ = words_of(part.column("text").filter(pc.equal(langs, lang)))
                if len(number):
                    counts, scaled = np.bincount(number, minlength=len(words)).astype(np.float64), model.scaled[:, column.get(lang, 0)]
                    for start in range(0, len(words), WORDS):
                        lattice = Lattice(words.slice(start, WORDS), model.pieces)
                        found = lattice.expected(scaled[lattice.piece], counts[start : start + WORDS], len(scaled))
                        sums[lang] = sums.get(lang, 0) + found
                    if len(sums) >= PART:  # a task holds the sums of so many languages at most
                        yield from flushed()
        yield from flushed()

    return map_arrow(docs.select("text", "lang"), run, "lang string, piece int, uses double").groupBy("lang", "piece").agg(F.sum("uses").alias("uses"))


def fit(docs: DataFrame, pieces: Pieces, sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """Learn from ``docs(text, lang)``; rows without text or language are ignored.

    A language without letters in any of its texts isn't learnt. The driver holds the model, pieces by languages. The early rounds read about ``sample`` rows, chosen by a hash of
    their text, the last one all. Without rows the model has no language.
    """
    known = docs.select("text", "lang").filter("text is not null and lang is not null")
    part = min(1.0, sample / max(1, known.count())) if rounds > 1 else 1.0
    few = known.filter(F.pmod(F.xxhash64(F.lit("em"), "text"), F.lit(1 << 30)) < int(part * (1 << 30)))
    start = pieces.start()
    model = Model(pieces, ("",), start[:, None])
    for n in range(rounds):
        found = _count(known if n == rounds - 1 else few, model).toArrow()  # at most pieces x languages
        names = sorted(set(found.column("lang").to_pylist()))
        column = {lang: i for i, lang in enumerate(names)}
        uses = np.zeros((len(pieces.pieces), len(names)))
        uses[found.column("piece").to_numpy(), [column[x] for x in found.column("lang").to_pylist()]] = found.column("uses").to_numpy()
        pooled = (uses.sum(axis=1) + ORDER * start) / (uses.sum() + ORDER)
        model = Model(pieces, tuple(names), (uses + POOLED * pooled[:, None]) / (uses.sum(axis=0) + POOLED))
        if not names:
            model = Model(pieces, ("",), start[:, None])
    return model if model.languages != ("",) else Model(pieces, (), np.zeros((len(start), 0)))


def identify(docs: DataFrame, model: Model, text: str = "text", name: str = "lang_pred", probability: str = "score") -> DataFrame:
    """``docs`` without its text, with the likeliest language and its probability among those learnt.

    All languages are equally likely before reading; ties go to the first in order of code point. A text that is
    null or has no letter, or any text if nothing was learnt, is ``und`` with 0. Columns of ``docs``
    that have the name of a result are replaced; repeated rows are scored alike.
    """
    kept = docs.drop(name, probability) if text in (name, probability) else docs.drop(text, name, probability)
    carried = kept.columns
    spark = docs.sparkSession
    out = docs.select(*carried, F.col(text).alias("_lid_text"), F.lit(None).cast("string").alias("_lid"), F.lit(None).cast("double").alias("_best"), F.lit(None).cast("double").alias("_sum"))
    for start in range(0, len(model.languages), PART):
        shared = spark.sparkContext.broadcast(model.part(start))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            model, names = shared.value, [*carried, "_lid_text", "_lid", "_best", "_sum"]
            for part in text_slices(batches, "_lid_text", SLICE):
                logs, n_words = model.log_probabilities(part.column("_lid_text"))
                old = {c: part.column(c).to_numpy(zero_copy_only=False) for c in ("_best", "_sum")}
                old = {c: np.where(np.isnan(x.astype(np.float64)), -np.inf, x.astype(np.float64)) for c, x in old.items()}
                first = logs.argmax(axis=1)
                top = logs[np.arange(len(logs)), first]
                better = top > old["_best"]
                best = np.maximum(top, old["_best"])
                # Logarithm of the summed probabilities of all languages so far.
                total = np.logaddexp(old["_sum"], top + np.log(np.exp(logs - top[:, None]).sum(axis=1)))
                labels = [model.languages[i] if b else o for i, b, o in zip(first, better, part.column("_lid").to_pylist())]
                none = n_words == 0
                lid = pa.array([None if x else y for x, y in zip(none, labels)], pa.string())
                columns = [part.column(c) for c in [*carried, "_lid_text"]] + [lid, pa.array(best, mask=none), pa.array(total, mask=none)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

        out = map_arrow(out, run, widened(kept, "_lid_text string, _lid string, _best double, _sum double"))
    score = F.when(F.col("_lid").isNull(), 0.0).otherwise(F.least(F.exp(F.col("_best") - F.col("_sum")), F.lit(1.0)))
    return out.select(*carried, F.coalesce("_lid", F.lit(UNKNOWN)).alias(name), score.alias(probability))


FOLDS, FOLD = 4, 2


def op12_segment_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    apart = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == FOLD, F.lit(False))
    model = fit(docs.filter(~apart), Pieces.read(public_tokenizers.path(VOCABULARY)))
    return identify(docs.select("doc_id", apart.alias("held_out"), "text"), model)


QUERIES = {"op12_segment_language": (op12_segment_language, None)}
