"""The whole job: captured pages to published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from indexloom.operators.checks import entity_duplicates
from indexloom.operators.cleaning import REPORT, Verdict, backfill_parents, clean_entity, missing_parents, watch
from indexloom.operators.keys import LOAD_ORDER, drop_dangling, reference_violations
from indexloom.operators.load import bad_timestamps, load_shape
from indexloom.operators.ranking import distinct_rows, keep_first
from indexloom.plans.extract import entity_rows, parse_pages
from indexloom.registry import ENTITIES
from indexloom.session import materialize, materialize_all
from indexloom.sources.captures import collect_pages, profiled_maintainers, rejected_pages
from indexloom.sources.publish import refresh

ORDER = ["rank", "place"]
#: Order in which links were met: their page, then their place on it.
SEEN = ["rank", "place", "pos"]


def extract_run(pages: DataFrame, profiles: DataFrame) -> dict[str, DataFrame]:
    """Fifteen raw entities from pages(rank, place, package, version, html) and profiles(username, html).

    Pages are parsed once and kept as a table; each entity is a select over it.
    """
    parsed = materialize(parse_pages(pages), "parsed-pages")
    frames = {}
    for name, entity in ENTITIES.items():
        if name == "maintainer":
            continue
        if name == "classifier":
            frames[name] = distinct_rows(entity_rows(parsed, name), entity.names)
        elif name == "maintained_by":
            # Keeps where each link was met first: placeholders take the first spelling.
            frames[name] = keep_first(entity_rows(parsed, name, ORDER), list(entity.names), SEEN)
        elif entity.first_wins:
            rows = entity_rows(parsed, name, ORDER)
            frames[name] = keep_first(rows, entity.key, ORDER).select(*entity.names)
        else:
            frames[name] = entity_rows(parsed, name)
    frames["maintainer"] = profiled_maintainers(frames["maintained_by"], profiles)
    return frames


def clean_run(raw: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, Verdict]]:
    """Clean entities with placeholders for unprofiled maintainers, and the verdicts behind them."""
    verdicts = {name: clean_entity(df, name) for name, df in raw.items()}
    frames = {name: v.valid for name, v in verdicts.items()}
    links, order = _seen(raw["maintained_by"], frames["maintained_by"])
    frames["maintainer"] = backfill_parents(frames["maintainer"], links, "username", "maintainer_username", order)
    return frames, verdicts


def _seen(raw: DataFrame, valid: DataFrame) -> tuple[DataFrame, list[str]]:
    """Links with the order in which they were met, where the raw rows still know it."""
    order = [c for c in SEEN if c in raw.columns]
    if not order:
        return valid, []
    keys = list(ENTITIES["maintained_by"].names)
    return raw.join(valid.select(*keys), keys, "left_semi"), order


def load_run(
    frames: dict[str, DataFrame], root: str, version: str, cascade: bool = False
) -> dict[str, int]:
    """Check, shape and publish a clean run. ``cascade`` drops dangling children instead of refusing."""
    if cascade:
        frames = drop_dangling(frames)
    checks = {
        "unresolved reference": reference_violations(frames),
        "duplicate key": entity_duplicates(frames),
        "bad timestamp": bad_timestamps(frames).where("n_rows > 0"),
    }
    keyed = {**frames, "_classifier_ids": load_shape(frames, "classifier")}
    tables = {
        name: keyed["_classifier_ids"] if name == "classifier" else load_shape(keyed, name) for name in LOAD_ORDER
    }
    return refresh(tables, root, version, checks)


def build(
    candidates: DataFrame, mains: DataFrame, versions: DataFrame, profiles: DataFrame, root: str, version: str,
    n_packages: int | None = None, cascade: bool = False, n_releases: int | None = None,
    reports: dict[str, DataFrame] | None = None,
) -> dict[str, int]:
    """From captured pages to a published version; returns row counts per table.

    ``n_packages`` and ``n_releases`` limit a build to the first packages and
    releases; by default all are read. A dict given as ``reports`` receives the skipped
    releases, the rejected pages, and as ``run`` the dropped, cut, backfilled and cascaded counts, which
    are observed while the entities are written.
    """
    pages, skipped = collect_pages(candidates, mains, versions, n_packages, n_releases)
    raw = extract_run(pages, profiles)
    verdicts = {name: clean_entity(df, name) for name, df in raw.items()}
    watched = {name: watch(v) for name, v in verdicts.items()}
    added = Observation("backfilled maintainers")
    links, order = _seen(raw["maintained_by"], verdicts["maintained_by"].valid)
    clean = {name: w.valid for name, w in watched.items()}
    missing = missing_parents(clean["maintainer"], links, "username", "maintainer_username", order)
    clean["maintainer"] = clean["maintainer"].unionByName(missing.observe(added, F.count(F.lit(1)).alias("n")))
    stored = materialize_all(clean, "clean")
    lines = [line for w in watched.values() for line in w.lines()]
    n_added = added.get["n"]
    if n_added:
        lines.append(("maintainer", "backfilled", None, n_added))
    spark = candidates.sparkSession
    if reports is not None:
        reports["skipped_versions"] = skipped
        challenged = [p.select(F.lit(kind).alias("kind"), F.col(key).alias("page"), "html") for kind, p, key in (
            ("main", mains, "package"), ("version", versions, "package"), ("profile", profiles, "username"))]
        every = challenged[0].unionByName(challenged[1]).unionByName(challenged[2])
        reports["rejected_pages"] = rejected_pages(every, F.lit(True))
        reports["run"] = spark.createDataFrame(lines, REPORT)
    counts = load_run(stored, root, version, cascade)
    if reports is not None and cascade:
        # What was cleaned and didn't get into the tables lost its parent.
        kept = {name: w.n_valid + (n_added if name == "maintainer" else 0) for name, w in watched.items()}
        lost = [(name, "cascaded", None, kept[name] - n) for name, n in counts.items() if kept[name] > n]
        reports["run"] = spark.createDataFrame(lines + lost, REPORT)
    return counts


def run_report(raw: dict[str, DataFrame]) -> DataFrame:
    """Dropped rows, cut cells and placeholders of a run: (entity, outcome, reason, n)."""
    return _report({name: clean_entity(df, name) for name, df in raw.items()}, raw)


def _report(verdicts: dict[str, Verdict], raw: dict[str, DataFrame]) -> DataFrame:
    lines: DataFrame | None = None
    for verdict in verdicts.values():
        lines = verdict.report if lines is None else lines.unionByName(verdict.report)
    added = missing_parents(
        verdicts["maintainer"].valid, verdicts["maintained_by"].valid, "username", "maintainer_username", []
    )
    extra = added.agg(F.count("*").alias("n")).where("n > 0")
    return lines.unionByName(
        extra.select(
            F.lit("maintainer").alias("entity"), F.lit("backfilled").alias("outcome"),
            F.lit(None).cast("string").alias("reason"), "n",
        )
    )
