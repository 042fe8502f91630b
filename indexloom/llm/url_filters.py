"""URL rules held in Bloom filter cascades.

A cascade stores a set of listed keys so that, over a known universe of keys,
membership is exact: level 1 encodes the listed keys, level 2 those other keys
of the universe that level 1 wrongly accepts, level 3 those listed keys that
level 2 wrongly accepts, and so on until a level accepts nothing wrong. A key
is listed if the first level that refuses it is an even one (counted from 1).
The universe is every (host suffix, path prefix) key that the corpus can form,
so no url is ever judged wrongly and no join with the rules is needed: each url
probes the filters, which reach the tasks as one value per level.

Level 1 has a false-positive rate of listed / (sqrt(2) * universe), later
levels one half, so all levels together hold O(log(universe / listed)) bits a
listed key. ``MAX_BITS`` bounds a level; longer rule lists raise an error.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexloom.llm.common import LOWER, UPPER, stored, table

#: Bits of the largest level: 32 MB.
MAX_BITS = 1 << 28
UNLISTED = "allow"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def key_shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """Distinct (labels of the host, characters of the path) of the rules: a few dozen pairs however many rules."""
    at = F.instr("key", "/")
    host = F.substring("key", F.lit(1), at - F.lit(1))
    shapes = rules.select(
        F.size(F.split(host, r"\.")).alias("labels"), (F.length("key") - at + 1).alias("chars")
    ).distinct()
    return sorted((r.labels, r.chars) for r in shapes.collect())


def candidate_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> list[Column]:
    """The key of each shape that a url forms, null where it has too few labels or characters."""
    dots = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit("")))
    return [
        F.when(
            (dots >= labels - 1) & (F.length(path) >= chars) & (host != ""),
            F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, chars)),
        )
        for labels, chars in shapes
    ]


def _positions(key: Column, bits: int, hashes: int, level: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(level * 64 + i), key), F.lit(bits).cast("long")) for i in range(hashes)]


class Level:
    """One Bloom filter: its words as a one-row table, read by each query as a scalar."""

    def __init__(self, keys: DataFrame, n: int, rate: float, level: int):
        self.level, self.hashes = level, max(1, min(24, round(-math.log2(rate))))
        self.bits = 64 * max(1, math.ceil(n * self.hashes / math.log(2) / 64))
        if self.bits > MAX_BITS:
            raise ValueError(f"a filter of {n} keys needs {self.bits} bits; the bound is {MAX_BITS}")
        spark = keys.sparkSession
        at = keys.select(F.explode(F.array(*_positions(F.col("key"), self.bits, self.hashes, level))).alias("at"))
        set_bits = at.select(
            F.shiftright("at", 6).alias("word"),
            F.expr("shiftleft(1L, cast(at & 63 as int))").alias("mask"),
        )
        empty = spark.range(self.bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))
        words = set_bits.union(empty).groupBy("word").agg(F.bit_or("mask").alias("mask"))
        whole = words.agg(F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("w"))
        self.words = stored(whole.select(F.col("w.mask").alias("words")), "cascade-level")

    def accepts(self, key: Column) -> Column:
        words = self.words.scalar()
        hit = [
            F.element_at(words, (F.shiftright(p, 6) + 1).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int"))) != 0
            for p in _positions(key, self.bits, self.hashes, self.level)
        ]
        return reduce(lambda a, b: a & b, hit)


class Cascade:
    """Exact set membership over a universe of distinct keys, ``universe(key, listed)``."""

    def __init__(self, universe: DataFrame):
        n = {r.listed: r.n for r in universe.groupBy("listed").agg(F.count("*").alias("n")).collect()}
        inside, outside = universe.filter("listed").select("key"), universe.filter("not listed").select("key")
        self.levels: list[Level] = []
        count, rate = n.get(True, 0), min(0.5, n.get(True, 0) / math.sqrt(2) / max(1, n.get(False, 0)))
        while count:
            level = Level(inside, count, rate, len(self.levels) + 1)
            self.levels.append(level)
            wrong = stored(outside.filter(level.accepts(F.col("key"))), "cascade-wrong")
            inside, outside, count, rate = wrong, inside, wrong.count(), 0.5

    def contains(self, key: Column) -> Column:
        """Whether the key is listed; null counts as no."""
        found: Column = F.lit(False)
        for level in reversed(self.levels):
            found = level.accepts(key) & ~found
        return F.coalesce(key.isNotNull() & found, F.lit(False))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Judge each url by the longest rule that fits it.

    ``rules(key, verdict)``: a key is a lower-case host, then a path prefix that
    starts with ``/``; it fits its host and all subdomains. ``verdict`` is
    ``block`` or ``allow``; a key listed as both blocks, and null or malformed
    keys are ignored. Returns ``keep`` (columns of pages), host, path, rule (null
    if none fits) and verdict (``allow`` for an unlisted url). Rows stay as they are:
    repeated rows repeat, an empty table gives none, a null or malformed url has
    an empty host and path and no rule. Of rules equally long the one with the longer
    host wins, though one url can't meet two such with the same text.
    """
    rules = rules.select("key", "verdict").filter(
        (F.instr("key", "/") > 1) & F.col("verdict").isin("block", "allow")
    )
    rules = stored(rules.groupBy("key").agg((F.max("verdict") == "block").alias("block")), "url-rules")
    shapes = key_shapes(rules)
    host, path = split_url(F.col(url))
    parts = pages.select(*keep, host.alias("host"), path.alias("path"))
    if not shapes:
        return parts.select("*", F.lit(None).cast("string").alias("rule"), F.lit(UNLISTED).alias("verdict"))
    keys = candidate_keys(F.col("host"), F.col("path"), shapes)
    seen = parts.select("host", "path").distinct().select(F.explode(F.array_compact(F.array(*keys))).alias("key"))
    none = F.lit(None).cast("boolean").alias("block")
    universe = stored(
        seen.select("key", none).union(rules.select("key", "block")).groupBy("key").agg(F.max("block").alias("block")),
        "url-universe",
    )
    block = Cascade(universe.select("key", F.coalesce("block", F.lit(False)).alias("listed")))
    allow = Cascade(universe.select("key", F.coalesce(~F.col("block"), F.lit(False)).alias("listed")))
    named = parts.select("*", *(k.alias(f"_key{i}") for i, k in enumerate(keys)))
    hits = []
    for i in range(len(shapes)):
        key = F.col(f"_key{i}")
        verdict = F.when(block.contains(key), F.lit("block")).when(allow.contains(key), F.lit("allow"))
        hit = F.struct(F.length(key).alias("chars"), F.instr(key, "/").alias("host"), key.alias("rule"), verdict.alias("verdict"))
        hits.append(F.when(verdict.isNotNull(), hit))
    best = F.array_max(F.array_compact(F.array(*hits)))
    judged = named.select(*keep, "host", "path", best.alias("_best"))
    return judged.select(
        *keep, "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce(F.col("_best.verdict"), F.lit(UNLISTED)).alias("verdict"),
    )


RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def op5_url_cascade(spark, sf_dir):
    rows = F.array(*(F.struct(F.lit(k).alias("key"), F.lit(v).alias("verdict")) for k, v in RULES))
    rules = spark.range(1).select(F.inline(rows))
    return filter_urls(table(spark, sf_dir, "pages"), rules)


SQL = rf"""
with u as (select row_number() over () as k, page_id,
             case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end as rest from pages),
h as (select k, page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}'), '') as host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from u),
r as (select * from (values {", ".join(f"('{k}', '{k.partition('/')[0]}', '{k[k.index('/'):]}', '{v}')" for k, v in RULES)}) t(rule, rh, rp, act))
select page_id, host, path, rule, coalesce(act, '{UNLISTED}') as verdict
from h left join r on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)
qualify row_number() over (partition by k order by length(rule) desc nulls last) = 1
"""

QUERIES = {"op5_url_cascade": (op5_url_cascade, SQL)}
