"""Quality rules: fixed limits, and robust multivariate outliers per language and source.

Each document becomes a vector of transformed statistics. Counts (symbols, repeated lines, each for at most 1,000
characters or 200 words) become roots of count + 3/8, whose sampling variance is 1/4 whatever the count; logarithms and roots of
rates are taken as deviations from their group's median and shrink by the root of the text's length where it has fewer than
200 words, as their sampling error grows. For every (language, source) group the minimum covariance determinant is
approached by concentration steps: each keeps the share ``SUPPORT`` of the group's documents nearest by Mahalanobis
distance and takes their mean and covariance, until the determinants stand still. Two starts are tried, the median with the
pooled median deviations and the classical estimate, and each group keeps the lesser determinant. A document is an outlier
if its squared distance, under the covariance scaled to be consistent for normal rows, exceeds ``CUTOFF``.

All of it is DataFrame code. Statistics are whole thousandths, so their sums and sums of
products are exact whole numbers: results don't depend on the order of tasks. The
h-th smallest distance of a group comes from counts per distance bin, so a group
that holds a third of all rows is counted in partial sums and never gathered.
Variances get the known part of their error on the diagonal (``ERROR``: rounding, or the sampling of a count), and groups are
drawn by ``PRIOR_ROWS`` rows to the covariance within the nearest rows of all groups, so groups of any size, one
document included, have a verdict.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexloom.llm.common import GAP, SPACES, stored, table

WINDOW, MIN_WORDS, MAX_REPEAT = 5, 10, 20
SYMBOLS = "#*$%&|<>"
SUPPORT, PRIOR_ROWS = 0.75, 20
#: Most steps from one start, and the mean fall of the logarithm of the determinants below which they stand still.
STEPS, STILL = 12, 0.01
#: Squared distance beyond which a document is an outlier: for normal rows one in 70,000.
CUTOFF = 30.0
UNIT = 1000
#: Variance of each statistic that is known beforehand, in squared units: 1/4 for roots of counts, one unit of rounding for the others.
VECTOR = ("word_len", "symbols", "points", "upper", "dup_lines")
COUNTS = ("symbols", "dup_lines")
ERROR = [0.25 * UNIT**2 if name in COUNTS else 1.0 for name in VECTOR]


def _chi_squared(x: float, degrees: int) -> float:
    """Probability that a chi-squared variable of odd ``degrees`` stays below ``x``."""
    term, total = 1.0, 0.0
    for j in range((degrees - 1) // 2):
        total += term
        term *= x / (2 * j + 3)
    return math.erf(math.sqrt(x / 2)) - math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * total


def consistency(support: float, degrees: int) -> float:
    """What the covariance of the nearest ``support`` of normal rows is multiplied by to be that of all."""
    low, high = 0.0, 1e3
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi_squared(middle, degrees) < support else (low, middle)
    return support / _chi_squared(low, degrees + 2)


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda w: w != "")


def _repeat_words(words: Column, n: Column) -> Column:
    """Words within windows of five that occur twice or more in the list."""

    def count(windows: Column) -> Column:
        def spread(w: Column) -> Column:
            # Windows sorted by content, then place; those equal to a neighbour are repeated.
            ordered = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))

            def repeated(o: Column) -> Column:
                same = lambda a, b: F.coalesce(F.get(o, a)["w"] == F.get(o, b)["w"], F.lit(False))
                places = F.filter(o, lambda x, j: same(j, j - 1) | same(j, j + 1))
                at = F.array_sort(F.transform(places, lambda x: x["i"]))
                # Each window adds the words that the one before it hasn't covered.
                first = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
                covered = F.aggregate(
                    at, first, lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"))
                )
                return covered["n"]

            return F.element_at(F.transform(F.array(ordered), repeated), 1)

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(spread(windows))

    places = F.sequence(F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1)))
    windows = F.transform(places, lambda i: F.array_join(F.slice(words, i, WINDOW), " "))
    return F.when(n >= WINDOW, F.element_at(F.transform(F.array(windows), count), 1)).otherwise(F.lit(0))


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text but with the counts of the rules and the further ones of the vectors."""
    t = F.coalesce(F.col(text), F.lit(""))
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_points", "_upper")
    kept = [c for c in docs.columns if c != text and c not in made]
    read = docs.select(*kept, t.alias("_text")).withColumn("_words", word_list(F.col("_text")))
    read = read.withColumn("_n", F.size("_words"))
    lines = F.filter(F.split("_text", "\n", -1), lambda line: F.length(F.btrim(line, F.lit(SPACES))) > 0)
    size = F.length("_text")
    return read.select(
        *kept,
        F.col("_n").cast("long").alias("n_words"),
        F.length(_without(F.col("_text"), SPACES)).cast("long").alias("word_chars"),
        (size - F.length(_without(F.col("_text"), SYMBOLS))).cast("long").alias("n_symbols"),
        F.element_at(F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x))), 1).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_words"), F.col("_n")).cast("long").alias("n_repeat_words"),
        (size - F.length(_without(F.col("_text"), ".,;:!?"))).cast("long").alias("_points"),
        (size - F.length(_without(F.col("_text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))).cast("long").alias("_upper"),
    )


def _vector() -> list[Column]:
    """The statistics in whole thousandths."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    values = {
        "word_len": F.log1p(F.col("word_chars") / words),
        "symbols": F.sqrt(F.col("n_symbols") * F.least(F.lit(1.0), 1000 / chars) + 0.375),
        "points": F.sqrt(F.col("_points") / chars),
        "upper": F.sqrt(F.col("_upper") / chars),
        "dup_lines": F.sqrt(F.col("n_dup_lines") * F.least(F.lit(1.0), 200 / words) + 0.375),
    }
    return [F.round(values[name] * UNIT).cast("long").alias(f"x{i}") for i, name in enumerate(VECTOR)]


K = len(VECTOR)
CONSISTENCY = consistency(SUPPORT, K)
GROUP = ("lang", "source")


def _moments(rows: DataFrame, group: list[str]) -> DataFrame:
    """Count, sums and sums of products per group: partial sums first, exact whole numbers."""
    sums = [F.sum(f"x{i}").alias(f"s{i}") for i in range(K)]
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i in range(K) for j in range(i + 1)]
    return rows.groupBy(*group).agg(F.count("*").alias("n"), *sums, *products)


def _pooled(moments: DataFrame) -> dict[str, float]:
    """Covariance within groups, over all of them."""
    n = F.col("n").cast("double")
    within = [F.sum(F.col(f"s{i}_{j}") - F.col(f"s{i}") / n * F.col(f"s{j}")).alias(f"{i}_{j}") for i in range(K) for j in range(i + 1)]
    one = moments.agg(F.sum("n").alias("n"), *within).first().asDict()
    n = one.pop("n") or 1
    return {name: (v or 0.0) / n for name, v in one.items()}


def _shape(moments: DataFrame, pooled: dict[str, float]) -> DataFrame:
    """Mean, lower Cholesky factor of the covariance, drawn to the pooled one, and logarithm of its determinant for each group."""
    n = F.col("n").cast("double")
    out = moments.select(*GROUP, "n", *((F.col(f"s{i}") / n).alias(f"m{i}") for i in range(K)), *(f"s{i}_{j}" for i in range(K) for j in range(i + 1)))
    covariance = {}
    for i in range(K):
        for j in range(i + 1):
            own = F.col(f"s{i}_{j}") - n * F.col(f"m{i}") * F.col(f"m{j}")
            covariance[i, j] = ((own + PRIOR_ROWS * pooled[f"{i}_{j}"]) / (n + PRIOR_ROWS) + (ERROR[i] if i == j else 0.0)).alias(f"c{i}_{j}")
    out = out.select(*GROUP, *(f"m{i}" for i in range(K)), *covariance.values())
    for j in range(K):
        rest = F.col(f"c{j}_{j}") - sum((F.col(f"l{j}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))
        out = out.withColumn(f"l{j}_{j}", F.sqrt(F.greatest(rest, F.lit(ERROR[j] * 1e-3))))
        for i in range(j + 1, K):
            rest = F.col(f"c{i}_{j}") - sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))
            out = out.withColumn(f"l{i}_{j}", rest / F.col(f"l{j}_{j}"))
    logdet = sum((2 * F.log(F.col(f"l{i}_{i}")) for i in range(K)), F.lit(0.0))
    return out.select(*GROUP, *(f"m{i}" for i in range(K)), *(f"l{i}_{j}" for i in range(K) for j in range(i + 1)), logdet.alias("logdet"))


def _match(rows: DataFrame, groups: DataFrame) -> DataFrame:
    named = groups.select(*(F.col(c).alias(f"_g_{c}") if c in GROUP else F.col(c) for c in groups.columns))
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in GROUP]
    return rows.join(named, same[0] & same[1]).drop("_g_lang", "_g_source")


def _squared(out: DataFrame) -> DataFrame:
    """``d2``: the squared Mahalanobis distance of x from m under the factor l of the same row."""
    for i in range(K):
        rest = F.col(f"x{i}") - F.col(f"m{i}") - sum((F.col(f"l{i}_{j}") * F.col(f"_y{j}") for j in range(i)), F.lit(0.0))
        out = out.withColumn(f"_y{i}", rest / F.col(f"l{i}_{i}"))
    return out.withColumn("d2", sum((F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(K)), F.lit(0.0)))


def _distances(rows: DataFrame, shape: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``d2`` of each row from its group's shape."""
    return _squared(_match(rows, shape)).select(*rows.columns, "d2")


def _bin(d2: Column) -> Column:
    """Distance bins, a sixty-fourth of an e-fold wide."""
    return F.floor(F.log(d2 + 1e-3) * 64)


def _quantiles(distances: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Per group the bin that reaches each share of its rows; a group has a few hundred bins."""
    counts = distances.groupBy(*GROUP, _bin(F.col("d2")).alias("bin")).agg(F.count("*").alias("n"))
    inside = Window.partitionBy(*GROUP)
    reached = F.sum("n").over(inside.orderBy("bin")) / F.sum("n").over(inside)
    marked = counts.select(*GROUP, "bin", reached.alias("share"))
    return marked.groupBy(*GROUP).agg(*(F.min(F.when(F.col("share") >= s, F.col("bin"))).alias(name) for name, s in shares.items()))


def _medians(rows: DataFrame) -> DataFrame:
    """The middle of each statistic per group, from counts per value."""
    out = None
    for i in range(K):
        counts = rows.groupBy(*GROUP, F.col(f"x{i}").alias("x")).agg(F.count("*").alias("n"))
        inside = Window.partitionBy(*GROUP)
        reached = F.sum("n").over(inside.orderBy("x")) / F.sum("n").over(inside)
        marked = counts.select(*GROUP, "x", reached.alias("share"))
        half = marked.groupBy(*GROUP).agg(F.min(F.when(F.col("share") >= 0.5, F.col("x"))).alias(f"middle{i}"))
        out = half if out is None else _match(out, half)
    return stored(out, "rule-medians")


def _deviations() -> list[Column]:
    """Statistics as deviations from the group's median, those of rates shrunk in texts below 200 words."""
    weight = F.least(F.lit(1.0), F.sqrt(F.col("n_words") / 200))
    return [F.round((F.col(f"x{i}") - F.col(f"middle{i}")) * (F.lit(1.0) if name in COUNTS else weight)).cast("long").alias(f"x{i}") for i, name in enumerate(VECTOR)]


def _concentrated(fit: DataFrame, shape: DataFrame) -> DataFrame:
    """Concentration steps from ``shape`` until the determinants stand still."""
    last = math.inf
    for _ in range(STEPS):
        distances = _distances(fit, shape)
        limit = stored(_quantiles(distances, {"h": SUPPORT}), "rule-limit")
        nearest = _match(distances, limit).filter(_bin(F.col("d2")) <= F.col("h"))
        moments = stored(_moments(nearest, list(GROUP)), "rule-moments")
        shape = stored(_shape(moments, _pooled(moments)), "rule-shape")
        now = shape.agg(F.avg("logdet")).first()[0]
        if now is None or now > last - STILL:
            break
        last = now
    return shape


def estimate(fit: DataFrame) -> DataFrame:
    """Minimum covariance determinant estimates of ``fit(lang, source, x0 ..)`` per group: the better of two starts."""
    spread = fit.agg(*(F.expr(f"percentile(abs(x{i}), 0.5)").alias(f"x{i}") for i in range(K))).first()
    scale = [max((spread[f"x{i}"] or 0.0) * 1.4826, ERROR[i] ** 0.5) for i in range(K)]
    middle = [F.lit(0.0).alias(f"m{i}") for i in range(K)] + [F.lit(scale[i] if i == j else 0.0).alias(f"l{i}_{j}") for i in range(K) for j in range(i + 1)]
    moments = stored(_moments(fit, list(GROUP)), "rule-moments")
    starts = [moments.select(*GROUP, *middle), _shape(moments, _pooled(moments))]
    found = [_concentrated(fit, start) for start in starts]
    named = [f"m{i}" for i in range(K)] + [f"l{i}_{j}" for i in range(K) for j in range(i + 1)]
    both = found[0].unionByName(found[1])
    return stored(both.groupBy(*GROUP).agg(F.min(F.struct("logdet", *named)).alias("best")).select(*GROUP, "best.*"), "rule-shape")


def outliers(docs: DataFrame, cutoff: float = CUTOFF, text: str = "text") -> DataFrame:
    """``docs`` without its text but with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    (long), base_failed, distance (double) and kept.

    A word is a run of anything but white space. base_failed: fewer than 10 words, or 100 * n_repeat_words > 20 *
    n_words. kept: neither base_failed nor an outlier. Documents that fail the base rules take no part in
    the estimates, though they get a distance where their group has one. Null and empty texts have no words and
    fail; null languages and sources are groups of their own; rows that repeat are counted as often;
    an empty table gives no rows. Columns of docs with one of the new names are replaced.
    """
    made = ("base_failed", "distance", "kept", *(f"x{i}" for i in range(K)))
    counted = base_counts(docs.drop(*(c for c in made if c != text)), text)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    rows = stored(counted.select("*", failed.alias("base_failed"), *_vector()).drop("_points", "_upper"), "rule-counts")
    sound = rows.filter("not base_failed")
    medians = _medians(sound)
    fit = stored(_match(sound, medians).select(*GROUP, *_deviations()), "rule-deviations")
    both = _match(medians, estimate(fit))
    named = both.select(*(F.col(c).alias(f"_g_{c}") if c in GROUP else F.col(c) for c in both.columns))
    same = F.col("lang").eqNullSafe(F.col("_g_lang")) & F.col("source").eqNullSafe(F.col("_g_source"))
    out = rows.join(named, same, "left").withColumns({f"x{i}": x for i, x in enumerate(_deviations())})
    out = _squared(out).withColumn("distance", F.col("d2") / CONSISTENCY)
    kept = [c for c in rows.columns if not (c.startswith("x") and c[1:].isdigit())]
    return out.select(*kept, "distance", (~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))).alias("kept"))


def op9_mcd_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return outliers(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


QUERIES = {"op9_mcd_rules": (op9_mcd_rules, None)}
