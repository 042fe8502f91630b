"""Integrity rules as jobs that return what breaks them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from indexloom.functions.text import fold_case
from indexloom.operators.cleaning import failures
from indexloom.registry import ENTITIES, HASH_ALGORITHMS, Col


def duplicate_keys(df: DataFrame, keys: Sequence[str], folded: Sequence[str] = (), name: str = "") -> DataFrame:
    """Key values held by more than one row: (entity, key, n_rows)."""
    groups = [fold_case(F.col(k)) if k in folded else F.col(k) for k in keys]
    counts = df.groupBy(*[g.alias(f"_k{n}") for n, g in enumerate(groups)]).agg(F.count("*").alias("n_rows"))
    key = F.to_json(F.array(*[F.col(f"_k{n}").cast("string") for n in range(len(keys))]))
    return counts.where("n_rows > 1").select(F.lit(name).alias("entity"), key.alias("key"), "n_rows")


def entity_duplicates(frames: dict[str, DataFrame]) -> DataFrame:
    """``duplicate_keys`` over every given entity with its declared key."""
    parts = [duplicate_keys(df, ENTITIES[n].key, ENTITIES[n].folded, n) for n, df in frames.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def domain_violations(df: DataFrame, columns: Sequence[Col], name: str = "") -> DataFrame:
    """Rows breaking each single rule (not only the first): (entity, rule, n_rows), one pass."""
    rules = [(reason, test) for c in columns for test, reason in failures(c, df.schema)]
    sums = df.agg(*[F.count_if(test).alias(f"_r{n}") for n, (_, test) in enumerate(rules)])
    lines = F.array(
        *[F.struct(F.lit(reason).alias("rule"), F.col(f"_r{n}").alias("n_rows")) for n, (reason, _) in enumerate(rules)]
    )
    return sums.select(F.explode(lines).alias("l")).select(F.lit(name).alias("entity"), "l.rule", "l.n_rows")


def incomplete_hashes(files: DataFrame, hashes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Files without exactly one hash of each of the three algorithms: keys and n_hashes."""
    per = hashes.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        *[F.count_if(F.col("algorithm") == a).alias(f"_a{n}") for n, a in enumerate(HASH_ALGORITHMS)],
    )
    full = F.lit(True)
    for n in range(len(HASH_ALGORITHMS)):
        full = full & (F.col(f"_a{n}") == 1)
    full = full & (F.col("_n") == len(HASH_ALGORITHMS))
    joined = files.select(*keys).join(per, list(keys), "left")
    return joined.where(~F.coalesce(full, F.lit(False))).select(
        *keys, F.coalesce("_n", F.lit(0)).cast("bigint").alias("n_hashes")
    )


def stray_yank_reasons(releases: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Releases with a reason though they are not yanked."""
    stray = F.col("yanked_reason").isNotNull() & ~F.coalesce("yanked", F.lit(False))
    return releases.where(stray).select(*keys, "yanked_reason")


def broken_dependencies(df: DataFrame, left: Sequence[str], right: Sequence[str], name: str = "") -> DataFrame:
    """Values of ``left`` that go with more than one ``right``: (dependency, key, n_rows).

    Smallest and largest right side are enough to tell, so one partial
    aggregation does it and no distinct set is gathered per key.
    """
    per = df.groupBy(*left).agg(
        F.min(F.struct(*right)).alias("_lo"), F.max(F.struct(*right)).alias("_hi"), F.count("*").alias("n_rows")
    )
    key = F.to_json(F.array(*[F.col(c).cast("string") for c in left]))
    return per.where(~F.col("_lo").eqNullSafe(F.col("_hi"))).select(
        F.lit(name).alias("dependency"), key.alias("key"), "n_rows"
    )


def relationship_degree(
    parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, edge: str
) -> DataFrame:
    """How many parents have how many children: (edge, degree, n_parents); degree 0 shows partial participation."""
    per = children.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_k")).agg(
        F.count("*").alias("_n")
    )
    joined = parents.select(F.col(parent_key).alias("_k")).join(per, "_k", "left")
    degree: Column = F.coalesce("_n", F.lit(0)).cast("bigint").alias("degree")
    return joined.groupBy(degree).agg(F.count("*").alias("n_parents")).select(
        F.lit(edge).alias("edge"), "degree", "n_parents"
    )


def child_counts(
    parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, name: str
) -> DataFrame:
    """Every parent with its number of children, 0 included; children are counted before the join."""
    per = children.groupBy(F.col(child_key).alias("_k")).agg(F.count("*").alias("_n"))
    joined = parents.join(per, F.col(parent_key) == F.col("_k"), "left").drop("_k")
    return joined.withColumn(name, F.coalesce("_n", F.lit(0)).cast("bigint")).drop("_n")
