"""Row cleaning generated from column rules: first failing rule wins, one scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from indexloom.functions.text import blank_to_null, fold_case
from indexloom.registry import ENTITIES, Col

ELLIPSIS = "..."
_TARGETS = {"bool": "boolean", "long": "bigint"}


@dataclass(frozen=True)
class Verdict:
    """Rows judged once: ``rows`` has the raw columns plus ``_reason`` and ``_cuts``."""

    entity: str
    columns: tuple[Col, ...]
    rows: DataFrame

    @property
    def valid(self) -> DataFrame:
        kept = self.rows.where(F.col("_reason").isNull())
        return kept.select(*[cleaned(c, self.rows.schema).alias(c.name) for c in self.columns])

    @property
    def rejected(self) -> DataFrame:
        """entity, reason and the raw row as JSON text."""
        raw = [c for c in self.rows.columns if not c.startswith("_")]
        return self.rows.where(F.col("_reason").isNotNull()).select(
            F.lit(self.entity).alias("entity"),
            F.col("_reason").alias("reason"),
            F.to_json(F.struct(*raw)).alias("row"),
        )

    @property
    def report(self) -> DataFrame:
        """entity, outcome, reason, n: dropped rows per reason and cut cells in total."""
        per = self.rows.groupBy(F.col("_reason").alias("reason")).agg(
            F.count("*").alias("rows"), F.sum("_cuts").alias("cuts")
        )
        lines = F.array(
            F.struct(F.lit("dropped").alias("outcome"), F.col("reason"), F.col("rows").alias("n")),
            F.struct(F.lit("truncated").alias("outcome"), F.lit(None).cast("string").alias("reason"), F.col("cuts").alias("n")),
        )
        each = per.select(F.explode(lines).alias("l")).select("l.*")
        each = each.where("outcome = 'truncated' or reason is not null")
        return each.groupBy(F.lit(self.entity).alias("entity"), "outcome", "reason").agg(F.sum("n").alias("n")).where(
            "n > 0"
        )


@dataclass(frozen=True)
class Watched:
    """A verdict whose figures are taken while its valid rows are written, without a scan of their own."""

    verdict: Verdict
    seen: Observation
    reasons: tuple[str, ...]

    @property
    def valid(self) -> DataFrame:
        return self.verdict.valid

    def lines(self) -> list[tuple[str, str, str | None, int]]:
        """(entity, outcome, reason, n) like ``Verdict.report``; waits for the first job over ``valid``."""
        found, entity = self.seen.get, self.verdict.entity
        lines = [(entity, "dropped", reason, found[f"r{n}"]) for n, reason in enumerate(self.reasons)]
        lines.append((entity, "truncated", None, found["cuts"] or 0))
        return [line for line in lines if line[3]]

    @property
    def n_valid(self) -> int:
        return self.seen.get["valid"]


REPORT = "entity string, outcome string, reason string, n bigint"


def watch(verdict: Verdict) -> Watched:
    reasons = tuple(dict.fromkeys(reason for c in verdict.columns for _, reason in failures(c, verdict.rows.schema)))
    seen = Observation(f"clean {verdict.entity}")
    rows = verdict.rows.observe(
        seen, F.count_if(F.col("_reason").isNull()).alias("valid"), F.sum("_cuts").alias("cuts"),
        *[F.count_if(F.col("_reason") == reason).alias(f"r{n}") for n, reason in enumerate(reasons)],
    )
    return Watched(Verdict(verdict.entity, verdict.columns, rows), seen, reasons)


def _value(col: Col, schema: T.StructType) -> Column:
    """Raw value with '' read as missing; text for a typed column is cast, failing to null."""
    raw = F.col(col.name)
    if isinstance(schema[col.name].dataType, T.StringType):
        raw = blank_to_null(raw)
        if col.type in _TARGETS:
            return raw.try_cast(_TARGETS[col.type])
    return raw


def failures(col: Col, schema: T.StructType) -> list[tuple[Column, str]]:
    value = _value(col, schema)
    rules = []
    if col.type in _TARGETS and isinstance(schema[col.name].dataType, T.StringType):
        present = blank_to_null(F.col(col.name)).isNotNull()
        rules.append((present & value.isNull(), f"{col.name} unreadable"))
    if col.required:
        rules.append((value.isNull(), f"{col.name} missing"))
    if col.allowed:
        rules.append((~value.isin(*col.allowed), f"{col.name} not allowed"))
    if col.max_length and col.kind == "identifier":
        rules.append((F.length(value) > col.max_length, f"{col.name} too long"))
    return rules


def _is_cut(col: Col, schema: T.StructType) -> Column:
    return F.length(_value(col, schema)) > col.max_length


def cleaned(col: Col, schema: T.StructType) -> Column:
    """The value a valid row keeps: '' becomes null, over-long prose is cut with an ellipsis."""
    value = _value(col, schema)
    if col.max_length and col.kind == "descriptive":
        short = F.concat(F.substring(value, 1, col.max_length - len(ELLIPSIS)), F.lit(ELLIPSIS))
        return F.when(_is_cut(col, schema), short).otherwise(value)
    return value


def judge(df: DataFrame, columns: Sequence[Col], entity: str = "") -> Verdict:
    """Check the rules column by column in the given order; the first failure gives the reason.

    Cuts count only in columns before the failing one. Absent columns read as null.
    """
    for col in columns:
        if col.name not in df.columns:
            df = df.withColumn(col.name, F.lit(None).cast("string"))
    schema = df.schema
    fails = [(n, test, reason) for n, col in enumerate(columns) for test, reason in failures(col, schema)]
    none = F.lit(None)
    at = F.coalesce(*[F.when(test, F.lit(n)) for n, test, _ in fails], F.lit(len(columns)))
    why = F.coalesce(*[F.when(test, F.lit(reason)) for _, test, reason in fails], none.cast("string"))
    cuts = F.lit(0).cast("bigint")
    for n, col in enumerate(columns):
        if col.max_length and col.kind == "descriptive":
            cuts = cuts + F.when((F.col("_fail_at") > n) & _is_cut(col, schema), 1).otherwise(0)
    rows = df.withColumns({"_fail_at": at, "_reason": why}).withColumn("_cuts", cuts).drop("_fail_at")
    return Verdict(entity, tuple(columns), rows)


def clean_entity(df: DataFrame, entity: str) -> Verdict:
    return judge(df, ENTITIES[entity].columns, entity)


def missing_parents(
    parents: DataFrame, links: DataFrame, parent_key: str, link_key: str, order: Sequence[str]
) -> DataFrame:
    """One placeholder parent per linked name that has none, compared case-blind.

    The placeholder keeps the spelling seen first. Links are folded to one row
    per name before anything is joined.
    """
    seen = links.groupBy(fold_case(F.col(link_key)).alias("_key")).agg(
        F.min(F.struct(*order, link_key)).alias("_first")
    )
    known = parents.select(fold_case(F.col(parent_key)).alias("_key"))
    name = F.col(f"_first.{link_key}").alias(parent_key)
    blank = {c: F.lit(None).cast(parents.schema[c].dataType).alias(c) for c in parents.columns}
    return seen.join(known, "_key", "left_anti").select(*[name if c == parent_key else blank[c] for c in parents.columns])


def backfill_parents(
    parents: DataFrame, links: DataFrame, parent_key: str, link_key: str, order: Sequence[str]
) -> DataFrame:
    """Parents plus a placeholder for every linked name without one."""
    return parents.unionByName(missing_parents(parents, links, parent_key, link_key, order))
