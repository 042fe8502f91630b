"""Mix sources to target weights by Pareto order sampling.

1. Sizes (words) per source give targets: the whole corpus is dealt by weight,
   a target stops at ``max_copies`` times its source's size, and the excess is
   dealt again by weight until no target is above.
2. A document's expected copies are ``min(max_copies, c * (1 + level))``, where
   level is the octave of its size, so longer documents are likelier; ``c``
   makes the source's expected words equal its target.
3. The whole part of the expected copies is certain. The rest is the inclusion
   probability p of one more copy. Documents are ranked by random odds divided
   by inclusion odds, (u / (1-u)) / (p / (1-p)), and the first are taken as long as
   their words stay within what the target lacks: a sample of fixed size, counted in
   words. Its last place goes to the document that fills the rest best.

The result is a function of the row and a few numbers per source: sampling needs
no sort of a source, whose documents may be a third of all rows. The place where a
source's ranking is cut is found in two steps: words per bin of the
rank, then the documents of one bin; bins are about as many as the root of the
source's documents, so no task sees more than that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexloom.llm.common import WORD, stored, table
from indexloom.operators.keys import dense_ids

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = 20_240_607


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _level(size: Column) -> Column:
    """Octave of the size: 0 for an empty text, then 1 + floor(log2)."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(F.lit(0))


def _rank(p: Column, u: Column) -> Column:
    """Random odds over inclusion odds, folded into 0..1 (the order is the same)."""
    q = (u / (1 - u)) / (p / (1 - p))
    return F.when(p > 0, q / (1 + q))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_copies: int) -> DataFrame:
    """``sizes(source, source_size)`` with the target of each source."""
    keyed = sizes.select(
        F.concat(F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.lit("0")), F.coalesce("source", F.lit(""))).alias("_order"),
        "source", "source_size",
    )
    place = F.pmod(F.col("_n") - 1, F.lit(len(weights)))
    numbered = dense_ids(keyed, ["_order"], "_n")
    weighed = stored(
        numbered.select(
            "source", "source_size",
            F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("double").alias("_w"),
            (F.col("source_size") * max_copies).alias("_cap"),
        ),
        "mix-weights",
    )
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    share, full = 0.0, None
    while True:  # each turn fills more sources up; only two sums per turn reach the driver
        above = F.col("_w") * share > F.col("_cap")
        left, weight, n = weighed.agg(
            F.lit(total) - F.sum(F.when(above, F.col("_cap")).otherwise(0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("_w"))),
            F.sum(F.when(above, 1).otherwise(0)),
        ).first()
        if n == full or not weight:
            break
        share, full = left / weight, n
    return weighed.select(
        "source", "source_size", F.least(F.col("_w") * share, F.col("_cap").cast("double")).alias("target")
    )


def sampling_plan(docs: DataFrame, weights=WEIGHTS, max_copies=MAX_COPIES, seed=SEED, text="text", doc_id="doc_id", source="source") -> DataFrame:
    """One row per source: size, target, the factor c and where its ranking is cut."""
    u = F.shiftrightunsigned(_tie(seed, doc_id, text, "u"), 11) * F.lit(2.0**-53)
    rows = stored(
        docs.select(F.col(source).alias("source"), n_words(F.col(text)).alias("size"), u.alias("u"), _tie(seed, doc_id, text, "tie").alias("tie")),
        "mix-sizes",
    )
    level = _level(F.col("size"))
    levels = stored(
        rows.groupBy("source", level.alias("level")).agg(F.count("*").alias("n"), F.sum("size").alias("words")), "mix-levels"
    )
    targets = source_targets(levels.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_copies)
    # c: of the levels, longest first, the first j are full; c follows from the words of the rest.
    by_source = targets.select("source", "source_size", "target")
    joined = levels.join(by_source.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    down = Window.partitionBy("source").orderBy(F.desc("level"))
    rest = Window.partitionBy("source").orderBy("level")
    grade = F.col("level") + 1
    full = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * max_copies
    c = F.try_divide(F.col("target") - full, F.sum(grade * F.col("words")).over(rest).cast("double"))
    fits = joined.select("*", c.alias("c")).filter((F.col("c") >= 0) & (F.col("c") * grade <= max_copies))
    factor = fits.groupBy("source").agg(F.max_by("c", "level").alias("c"))
    plan = by_source.join(factor.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    # No level fits: all documents are full, or the source holds no word.
    c = F.coalesce("c", F.when(F.col("source_size") > 0, F.lit(1e18)).otherwise(F.lit(0.0)))
    plan = stored(plan.select("source", "source_size", "target", c.alias("c")), "mix-plan")

    whole, p = _expected(F.col("c"), F.col("size"), max_copies)
    dealt = rows.join(plan.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).select(
        "source", "size", "tie", "target", whole.alias("whole"), p.alias("p"), "u"
    )
    ranked = dealt.select("*", _rank(F.col("p"), F.col("u")).alias("rank"))
    sums = ranked.groupBy("source").agg(
        (F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("lacks"),
        F.ceil(F.sqrt(F.count("rank"))).alias("bins"),
    )
    sums = stored(sums, "mix-lacks").withColumnRenamed("source", "_s")
    candidates = ranked.filter(F.col("rank").isNotNull() & (F.col("size") > 0)).join(sums, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    candidates = candidates.select("source", "size", "tie", "rank", "lacks", F.floor(F.col("rank") * F.col("bins")).alias("bin"))
    bins = candidates.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("lacks").alias("lacks"))
    before = F.coalesce(
        F.sum("words").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    # The bin in which the words reach what is lacking; of none does, the last one.
    reach = bins.select("*", before.alias("before")).filter(F.col("before") <= F.col("lacks"))
    cut_bin = reach.groupBy("source").agg(F.max_by(F.struct("bin", "before"), "bin").alias("cut"))
    cut_bin = stored(cut_bin.select(F.col("source").alias("_s"), F.col("cut.bin").alias("_bin"), F.col("cut.before").alias("before")), "mix-bins")
    inside = candidates.join(cut_bin, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bin") == F.col("_bin")))
    order = Window.partitionBy("source").orderBy(F.struct("rank", "tie"))
    # rows alike in rank and tie share one decision, hence a range
    alike = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    taken = F.col("before") + F.sum("size").over(alike)
    ends = inside.select("source", "rank", "tie", "lacks", "before", taken.alias("taken"))
    # The last document after which the words are not yet above what is lacking.
    within = F.when(F.col("taken") <= F.col("lacks"), F.struct("rank", "tie", "taken"))
    cut = ends.groupBy("source").agg(
        F.max(within).alias("cut"), F.min("rank").alias("first"), F.first("before").alias("before"), F.first("lacks").alias("lacks")
    )
    cut = stored(
        cut.select(
            F.col("source").alias("_s"),
            F.coalesce("cut.rank", F.col("first")).alias("cut_rank"),
            F.col("cut.tie").alias("cut_tie"),  # null: nothing of this rank is taken
            (F.col("lacks") - F.coalesce("cut.taken", F.col("before"))).alias("gap"),
        ),
        "mix-cuts",
    )
    # The last place goes to the document behind the cut that fills the gap best.
    behind = candidates.select("source", "size", "rank", "tie").join(cut, F.col("source").eqNullSafe(F.col("_s")))
    behind = behind.filter(
        (F.col("size") < 2 * F.col("gap"))
        & ((F.col("rank") > F.col("cut_rank")) | ((F.col("rank") == F.col("cut_rank")) & ~F.coalesce(F.col("tie") <= F.col("cut_tie"), F.lit(False))))
    )
    last = behind.groupBy("source").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")), "rank", "tie")).alias("last"))
    last = last.select(F.col("source").alias("_l"), F.col("last.rank").alias("last_rank"), F.col("last.tie").alias("last_tie"))
    cuts = plan.join(cut.drop("gap"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    return stored(cuts.join(last, F.col("source").eqNullSafe(F.col("_l")), "left").drop("_l"), "mix-plan")


def _tie(seed: int, doc_id: str, text: str, use: str) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(use), F.col(doc_id), F.coalesce(text, F.lit("")))


def _expected(c: Column, size: Column, max_copies: int) -> tuple[Column, Column]:
    """Certain copies, and the probability of one more."""
    copies = F.least(c * (_level(size) + 1), F.lit(float(max_copies)))
    whole = F.floor(copies + 1e-9)
    p = copies - whole
    return whole, F.when(p > 1e-9, p).otherwise(F.lit(0.0))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = SEED, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """All rows of ``docs`` with size, source_size, target, copies and taken (copies * size).

    Sources are ordered by code point, null last, and weigh ``weights`` in turn. A
    source's taken words fall short of its target by the first document behind the
    cut at most, and exceed it by less than that. The random number of a row hashes seed, id and text: reruns agree, and
    rows alike in both share one decision. Null and empty texts have size 0 and take no words;
    a source without words has target 0; an empty table gives no rows. Columns of
    docs with one of the new names are replaced.
    """
    made = ("size", "source_size", "target", "copies", "taken")
    plan = sampling_plan(docs, weights, max_copies, seed, text, doc_id, source)
    plan = plan.select(*(F.col(c).alias(f"_mix_{c}") for c in plan.columns))
    sized = docs.drop(*(c for c in made if c not in (text, doc_id, source))).withColumn("_mix_size", n_words(F.col(text)))
    both = sized.join(plan, F.col(source).eqNullSafe(F.col("_mix_source")))
    whole, p = _expected(F.col("_mix_c"), F.col("_mix_size"), max_copies)
    u = F.shiftrightunsigned(_tie(seed, doc_id, text, "u"), 11) * F.lit(2.0**-53)
    rank, tie = _rank(p, u), _tie(seed, doc_id, text, "tie")
    cut, cut_tie = F.col("_mix_cut_rank"), F.col("_mix_cut_tie")
    last = (rank == F.col("_mix_last_rank")) & (tie == F.col("_mix_last_tie"))
    more = (F.col("_mix_size") > 0) & ((rank < cut) | ((rank == cut) & (tie <= cut_tie)) | last)
    copies = whole + F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0)
    kept = [c for c in sized.columns if c != "_mix_size"]
    return both.select(
        *kept, F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"),
        copies.cast("int").alias("copies"), (copies * F.col("_mix_size")).cast("long").alias("taken"),
    )


def repeat(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mixture itself: each row as often as it has copies."""
    return mixed.filter("copies > 0").select(*columns, F.explode(F.sequence(F.lit(1), "copies")).alias("_copy")).drop("_copy")


def op10_pareto_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


QUERIES = {"op10_pareto_mix": (op10_pareto_mix, None)}
