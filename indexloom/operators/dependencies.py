"""Functional dependencies and relationships the model declares, and jobs that return what breaks them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from indexloom.registry import ENTITIES


@dataclass(frozen=True)
class Dependency:
    """Rows that agree in ``left`` agree in ``right``."""

    left: tuple[str, ...]
    right: tuple[str, ...]

    def __str__(self) -> str:
        return f"{','.join(self.left)}->{','.join(self.right)}"


# Fixed values of the model: what determines a row of each stored table. Tables left out are all key.
DETERMINANTS: dict[str, tuple[tuple[str, ...], ...]] = {
    "organization": (("organization_id",), ("name",)),
    "maintainer": (("maintainer_id",),),
    "classifier": (("classifier_id",), ("category", "value")),
    "package": (("package_id",), ("name",)),
    "release": (("release_id",), ("package_id", "version")),
    "release_detail": (("release_id",),),
    "release_file": (("release_file_id",), ("release_id", "filename")),
    "file_hash": (("release_file_id", "algorithm"),),
    "project_link": (("release_id", "label"),),
    "attestation": (("sigstore_log_index",),),
}


def declared(table: str, columns: Sequence[str]) -> list[Dependency]:
    """The dependencies of a stored table: each determinant decides all other columns."""
    return [Dependency(left, tuple(c for c in columns if c not in left)) for left in DETERMINANTS.get(table, ())]


def closure(attributes: Iterable[str], dependencies: Iterable[Dependency]) -> frozenset[str]:
    """All attributes that the given ones determine."""
    known, deps = set(attributes), list(dependencies)
    while True:
        more = {r for d in deps if known.issuperset(d.left) for r in d.right} - known
        if not more:
            return frozenset(known)
        known |= more


def candidate_keys(columns: Sequence[str], dependencies: Sequence[Dependency]) -> list[tuple[str, ...]]:
    """Smallest sets of columns that determine all, in column order.

    Columns on no right side are in every key; only the rest is tried, fewest first.
    """
    whole = set(columns)
    decided = {r for d in dependencies for r in d.right}
    core = tuple(c for c in columns if c not in decided)
    # A column that decides nothing can't shorten a key it isn't forced into.
    rest = [c for c in columns if c in decided and any(c in d.left for d in dependencies)]
    found: list[tuple[str, ...]] = []
    for n in range(len(rest) + 1):
        for extra in combinations(rest, n):
            key = tuple(c for c in columns if c in core or c in extra)
            if not any(set(k) <= set(key) for k in found) and closure(key, dependencies) == whole:
                found.append(key)
    return found


def not_in_normal_form(columns: Sequence[str], dependencies: Sequence[Dependency]) -> list[Dependency]:
    """Dependencies whose left side is no superkey, and so break Boyce-Codd normal form."""
    return [d for d in dependencies if not set(d.right) <= set(d.left) and closure(d.left, dependencies) != set(columns)]


def _fingerprint(columns: Sequence[str]) -> Column:
    """128 bits of a row part as two numbers, nulls told apart from everything else."""
    parts = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit("again"), *parts).alias("b"))


def broken_dependencies(df: DataFrame, dependencies: Sequence[Dependency], name: str = "") -> DataFrame:
    """Left sides that go with several right sides: (entity, dependency, key, n_rows).

    All dependencies of a table are tested in one pass over grouping sets. The least and the largest
    fingerprint of the right side are enough to tell, and fold per task.
    """
    names = list(dict.fromkeys(c for d in dependencies for c in d.left))
    sides = [f"_s{n}" for n in range(len(dependencies))]
    rows = df.select(*names, *[_fingerprint(d.right).alias(s) for d, s in zip(dependencies, sides)])
    sets = [[F.col(c) for c in d.left] for d in dependencies]
    per = rows.groupingSets(sets, *names).agg(
        F.grouping_id().alias("_set"), F.count("*").alias("n_rows"),
        *[x for s in sides for x in (F.min(s).alias(f"{s}_lo"), F.max(s).alias(f"{s}_hi"))],
    )
    # In a grouping id a column has its bit set where it is summed over.
    ids = [sum((c not in d.left) << (len(names) - 1 - i) for i, c in enumerate(names)) for d in dependencies]
    lines = [
        F.when((F.col("_set") == i) & (F.col(f"{s}_lo") != F.col(f"{s}_hi")), F.struct(
            F.lit(str(d)).alias("dependency"), F.to_json(F.array(*[F.col(c).cast("string") for c in d.left])).alias("key")))
        for d, s, i in zip(dependencies, sides, ids)
    ]
    return per.select(F.coalesce(*lines).alias("_l"), "n_rows").where("_l is not null").select(F.lit(name).alias("entity"), "_l.dependency", "_l.key", "n_rows")


def broken_in_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared dependency over all stored tables at hand."""
    found: DataFrame | None = None
    for name, df in tables.items():
        deps = declared(name, df.columns)
        if deps:
            bad = broken_dependencies(df, deps, name)
            found = bad if found is None else found.unionByName(bad)
    if found is None:
        raise ValueError("no dependency is declared for the given tables")
    return found


@dataclass(frozen=True)
class Side:
    """One side of a relationship: each ``parent`` row occurs in ``child`` between ``least`` and ``most`` times.

    ``columns`` of the child name the parent; a child must name an existing one if ``total``.
    """

    relationship: str
    parent: str
    child: str
    columns: tuple[str, ...]
    total: bool
    least: int = 0
    most: int | None = None

    def __str__(self) -> str:
        return f"{self.relationship}({self.parent})"


_REL = ("package_name", "version")
_FILE = (*_REL, "filename")

# Fixed values of the model: the eight relationships; many-to-many ones have two sides.
SIDES = (
    Side("has", "package", "release", ("package_name",), total=True),
    Side("owned_by", "organization", "package", ("organization_owner",), total=False),
    Side("distributes", "release", "release_file", _REL, total=True),
    Side("checks", "release_file", "file_hash", _FILE, total=True, most=3),
    Side("links", "release", "project_link", _REL, total=True),
    Side("proves", "release_file", "attestation", _FILE, total=True),
    Side("maintained_by", "package", "maintained_by", ("package_name",), total=True),
    Side("maintained_by", "maintainer", "maintained_by", ("maintainer_username",), total=True),
    Side("tagged_with", "release", "tagged_with", _REL, total=True),
    Side("tagged_with", "classifier", "tagged_with", ("category", "value"), total=True),
)


def degrees(frames: dict[str, DataFrame], sides: Sequence[Side] = SIDES) -> DataFrame:
    """For every side and key: (edge, key, n_parents, n_children), all sides in one aggregation.

    Parents and children become rows of (edge, key, 1, 0) and (edge, key, 0, 1) and are summed
    per task first, so a parent with a third of all children is one row per task. Names that
    compare case-blind are folded; a missing name has a null key.
    """
    from indexloom.functions.text import fold_case

    lines: DataFrame | None = None
    for side in sides:
        if side.parent not in frames or side.child not in frames:
            continue
        folded = ENTITIES[side.parent].folded
        own = ENTITIES[side.parent].key
        for df, columns, parent in ((frames[side.parent], own, 1), (frames[side.child], side.columns, 0)):
            parts = [fold_case(F.col(c)) if k in folded else F.col(c).cast("string") for c, k in zip(columns, own)]
            named = F.lit(True)
            for p in parts:
                named = named & p.isNotNull() & (p != "")
            key = F.when(named, F.to_json(F.array(*parts)))
            line = df.select(F.lit(str(side)).alias("edge"), key.alias("key"), F.lit(parent).alias("_p"), F.lit(1 - parent).alias("_c"))
            lines = line if lines is None else lines.unionByName(line)
    if lines is None:
        raise ValueError("no relationship joins two of the given entities")
    return lines.groupBy("edge", "key").agg(F.sum("_p").alias("n_parents"), F.sum("_c").alias("n_children"))


def cardinality_breaches(frames: dict[str, DataFrame], sides: Sequence[Side] = SIDES) -> DataFrame:
    """What the declared cardinalities don't allow: (edge, rule, key, n_rows)."""
    rules = F.lit(None).cast("string")
    for side in sides:
        here = F.col("edge") == str(side)
        some, alone = F.col("n_children") > 0, F.col("n_parents") == 0
        broken = F.when(alone & some & (F.col("key").isNotNull() | F.lit(side.total)), "child without parent")
        if side.most is not None:
            broken = broken.when(~alone & (F.col("n_children") > side.most), "too many children")
        if side.least:
            broken = broken.when(~alone & (F.col("n_children") < side.least), "too few children")
        rules = F.when(here, broken).otherwise(rules)
    return degrees(frames, sides).select("edge", rules.alias("rule"), "key", F.col("n_children").alias("n_rows")).where("rule is not null")
