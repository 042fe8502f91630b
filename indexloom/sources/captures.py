"""Captured pages: which are usable, which releases to read, who has a profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from indexloom.functions import html as H
from indexloom.functions.text import strip_space
from indexloom.operators.ranking import keep_first
from indexloom.plans import extract
from indexloom.session import materialize

def read_candidates(spark: SparkSession, path: str, at_least: int = 1) -> DataFrame:
    """Package names of a list file in file order: (rank, package). Too short a list is an error."""
    names = candidate_names(spark.read.text(path).select(F.monotonically_increasing_id().alias("rank"), F.col("value").alias("package")), "package")
    n = names.limit(at_least).count()
    if n < at_least:
        raise ValueError(f"{path} has {n} names, {at_least} are needed")
    return names


def candidate_names(lines: DataFrame, column: str) -> DataFrame:
    """Trimmed lines, blanks dropped."""
    return lines.withColumn(column, strip_space(F.col(column))).where(F.col(column) != "")


def has_history(html: Column) -> Column:
    """Whether the page's release timeline lists any release."""
    timeline = lambda p: F.when(H.opens(p, "div", "release-timeline"), F.lit("timeline"))
    # Most unusable pages have no such region at all.
    found = H.outermost(html, "div", [H.tag_test("div", "release-timeline")], timeline, hidden=True)
    region = H.first_labelled(found, "timeline")
    return F.when(html.contains("release-timeline"), F.size(extract.history(region)) > 0).otherwise(F.lit(False))


def reject_reason(html, has_history):
    """Why a captured page cannot be used; null if it can."""
    return F.when(html.contains(extract.CHALLENGE_MARKER), "challenge page").when(~has_history, "no release history")


def rejected_pages(pages: DataFrame, has_history) -> DataFrame:
    """Unusable pages with their reason, the page text left behind.

    The reason goes through a generator: a filter on it moved below the pages would make each of them again for every mention.
    """
    carried = [c for c in pages.columns if c not in ("html", "reason")]
    return extract.evaluated_once(pages, carried, {"reason": reject_reason(F.col("html"), has_history)}).where("reason is not null")


def not_challenged(pages: DataFrame) -> DataFrame:
    return pages.where(~F.col("html").contains(extract.CHALLENGE_MARKER))


def first_captures(pages: DataFrame, keys: list[str]) -> DataFrame:
    """One usable capture per key: the first by ``captured`` if the pages have such a column, else the smallest.

    Most pages are captured once. Captures are counted on the keys alone, and only pages of keys
    with several are compared and shuffled; the others stay where they are as long as those keys fit a broadcast.
    """
    order = [c for c in ("captured",) if c in pages.columns]
    good = not_challenged(pages)
    names = [f"_k{n}" for n in range(len(keys))]
    counts = good.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count("*").alias("_n"))
    several = materialize(counts.where("_n > 1").select(*names), "captured-twice")
    same = F.lit(True)
    for k, n in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    once, more = good.join(several, same, "left_anti"), good.join(several, same, "left_semi")
    return once.unionByName(keep_first(more, keys, order).select(*good.columns))


def planned_versions(main: DataFrame, limit: int | None = None) -> DataFrame:
    """Releases to read per package from its parsed main page: (package, version, place, is_current).

    The history is an array of one page, so all is done in the row: the current
    version first (place 0), then the entries without it, the first ``limit`` if
    one is given. A version that the history lists twice is read once.
    """
    listed = F.col("history") if limit is None else F.slice("history", 1, limit)
    entries = F.transform(listed, lambda e, n: F.struct(e["version"].alias("version"), (n + 1).alias("place")))
    names = F.transform(listed, lambda e: e["version"])
    others = F.filter(
        entries, lambda e: (e["version"] != F.col("current_version")) & (F.array_position(names, e["version"]) == e["place"])
    )
    lead = F.array(F.struct(F.col("current_version").alias("version"), F.lit(0).alias("place")))
    carried = [c for c in ("rank", "package") if c in main.columns]
    plan = main.select(*carried, F.explode(F.concat(lead, others)).alias("p"))
    return plan.select(*carried, "p.version", "p.place", (F.col("p.place") == 0).alias("is_current"))


def skipped_versions(plan: DataFrame, good_pages: DataFrame) -> DataFrame:
    """Planned releases without a usable page; only that release is lost."""
    return plan.join(good_pages.select("package", "version"), ["package", "version"], "left_anti")


def profiled_maintainers(links: DataFrame, profiles: DataFrame) -> DataFrame:
    """Maintainers with a usable profile page: (username, joined_at). A failed profile gives no row.

    Names shrink to distinct ones before they meet the profile pages.
    """
    names = links.select(F.col("maintainer_username").alias("username")).distinct()
    wanted = first_captures(profiles.join(names, "username", "left_semi"), ["username"])
    return wanted.select("username", extract.joined_at(F.col("html")).alias("joined_at"))


def collect_pages(
    candidates: DataFrame, mains: DataFrame, versions: DataFrame, n_packages: int | None = None,
    n_releases: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Pages to extract and the releases that were skipped.

    candidates(rank, package), mains(package, html), versions(package, version, html).
    All candidates whose main page is usable are read, or the first ``n_packages``
    of them; their current release comes from the main page, the others, all or the first
    ``n_releases`` of the history, from version pages. Pages captured twice count once.
    """
    candidates = candidates.groupBy("package").agg(F.min("rank").alias("rank"))
    mains = first_captures(mains.join(candidates.select("package"), "package", "left_semi"), ["package"])
    heads = extract.parse_pages(
        mains.select("package", F.lit(None).cast("string").alias("version"), "html"),
        ("current_version", "history"),
    ).where(F.size("history") > 0)
    heads = candidates.join(heads.select("package", "current_version", "history"), "package")
    chosen = heads if n_packages is None else heads.orderBy("rank").limit(n_packages)
    # Written down once: it feeds three joins, and its true size then decides how they run.
    plan = materialize(planned_versions(chosen, n_releases), "release-plan")
    good = first_captures(versions, ["package", "version"])
    later = good.join(plan.where("not is_current"), ["package", "version"])
    first = mains.join(plan.where("is_current"), "package")
    columns = ["rank", "place", "package", "version", "html"]
    pages = first.select(*columns).unionByName(later.select(*columns))
    return pages, skipped_versions(plan.where("not is_current"), good)
