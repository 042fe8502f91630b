"""Keep-first, caps per group and first-N selection, all safe for hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from indexloom.functions.text import fold_case


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], folded: Sequence[str] = ()
) -> DataFrame:
    """First row of every key by ``order``; ties fall to the smallest row, so the result is repeatable.

    One ``min`` over (order, rest): each task folds its rows to one per key
    before the shuffle, so a key that owns a third of the table costs no more
    than any other. Keys in ``folded`` compare case-blind and keep the spelling
    of the row that wins.
    """
    plain = [k for k in keys if k not in folded]
    groups = [F.col(k) for k in plain] + [fold_case(F.col(k)).alias(f"_key_{k}") for k in folded]
    lead = list(order)
    rest = [c for c in df.columns if c not in plain and c not in lead]
    first = F.min(F.struct(*lead, *rest)).alias("_first")
    return df.groupBy(*groups).agg(first).select(
        *[F.col(c) if c in plain else F.col(f"_first.{c}").alias(c) for c in df.columns]
    )


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep-first where all columns are key: any copy is the same row."""
    return df.select(*columns).distinct()


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int) -> DataFrame:
    """First ``limit`` rows of each group.

    The rank filter is pushed below the shuffle, so at most ``limit`` rows per
    group leave each task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= limit).drop("_rank")


def cap_history(
    history: DataFrame, group: str, order: Sequence[Column], version: str, current: DataFrame, limit: int
) -> DataFrame:
    """First ``limit`` entries of each group plus the current one if it lies beyond them.

    ``current`` holds (group, version), one row per group. The extra entry is
    found by its key, so the group is never ranked as a whole.
    """
    top = top_per_group(history, [group], order, limit)
    beyond = history.join(current, [group, version], "left_semi").join(
        top.select(group, version), [group, version], "left_anti"
    )
    return top.unionByName(beyond)


def first_successful(
    candidates: DataFrame, usable: DataFrame, key: str, rank: Sequence[str], limit: int
) -> DataFrame:
    """The first ``limit`` candidates in rank order that have a usable page; reserves move up."""
    good = candidates.join(usable.select(key), key, "left_semi")
    return good.orderBy(*rank).limit(limit)
