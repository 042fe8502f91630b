"""Surrogate keys from natural keys, and references between entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from indexloom.functions.text import fold_case
from indexloom.registry import ENTITIES, Ref
from indexloom.session import materialize


def natural_id(*parts: Column) -> Column:
    """Id that is a pure function of the natural key, shaped like a UUID.

    Each part carries its length, so no two different keys share a text. A
    child computes its parent's id from its own columns: no lookup is joined.
    """
    text = F.concat(*[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts])
    digest = F.sha2(text, 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    shaped = F.concat_ws("-", *[F.substring(digest, at, size) for at, size in cuts])
    return F.when(digest.isNotNull(), shaped)


def entity_id(entity: str, prefix: str = "") -> Column:
    """Id of the entity's own natural key columns."""
    return natural_id(*[F.col(prefix + k) for k in ENTITIES[entity].key])


def dense_ids(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number the distinct rows 1..n in key order without one task seeing them all.

    Range-partition and sort, note each row's place within its partition, write
    that down once (the partition bounds come from a sample, so they must not be
    drawn again), then add each partition's offset.
    """
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialize(ordered.withColumn("_place", F.monotonically_increasing_id()), "dense-ids")
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    # One row per partition: the window below sorts as many rows as there are partitions.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.select(*rows.columns, (F.col("_offset") + within + 1).alias(name))


def resolve(
    child: DataFrame, parent: DataFrame, child_keys: Sequence[str], parent_keys: Sequence[str], id_column: str
) -> DataFrame:
    """Add the parent's id to each child row; null where the parent does not exist."""
    keyed = parent.select(*[F.col(p).alias(f"_p{n}") for n, p in enumerate(parent_keys)], id_column)
    on = [F.col(c) == F.col(f"_p{n}") for n, c in enumerate(child_keys)]
    return child.join(keyed, on, "left").drop(*[f"_p{n}" for n in range(len(parent_keys))])


#: Parents that are broadcast at most, child rows of one key that stay together, and keys that may be spread.
SMALL_PARENT, HEAVY_KEY, MAX_HEAVY = 100_000, 1_000_000, 100_000


def resolve_spread(
    child: DataFrame, parent: DataFrame, child_keys: Sequence[str], parent_keys: Sequence[str], id_column: str
) -> DataFrame:
    """``resolve`` where a few keys may hold most child rows.

    A parent table of at most ``SMALL_PARENT`` rows is broadcast, after a count, and the children
    stay where they are. For a larger one the keys with over ``HEAVY_KEY`` child rows are counted first;
    their children are dealt over as many salts as the count asks for, and their parents
    copied once per salt. The salt is a hash of the child row, so a repeated task deals alike. The list of
    heavy keys is broadcast: rows over ``HEAVY_KEY`` bound it, and beyond ``MAX_HEAVY`` keys the
    bar is raised until it fits.
    """
    if parent.limit(SMALL_PARENT + 1).count() <= SMALL_PARENT:
        return resolve(child, F.broadcast(parent.select(*parent_keys, id_column)), child_keys, parent_keys, id_column)
    names = [f"_h{n}" for n in range(len(child_keys))]
    counts = child.groupBy(*[F.col(c).alias(n) for c, n in zip(child_keys, names)]).agg(F.count("*").alias("_rows"))
    bar, heavy = HEAVY_KEY, materialize(counts.where(F.col("_rows") > HEAVY_KEY), "heavy-keys")
    while heavy.count() > MAX_HEAVY:
        bar, heavy = bar * 4, heavy.where(F.col("_rows") > bar * 4)
    heavy = heavy.select(*names, F.ceil(4 * F.col("_rows") / bar).cast("int").alias("_salts"))

    def salts_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        found = df.join(F.broadcast(heavy), [F.col(c) == F.col(n) for c, n in zip(keys, names)], "left").drop(*names)
        # Nothing matches a missing key, so its rows may lie anywhere.
        unnamed = F.lit(False)
        for c in keys:
            unnamed = unnamed | F.col(c).isNull()
        return found.withColumn("_salts", F.when(unnamed, MAX_HEAVY + 1).otherwise(F.coalesce("_salts", F.lit(1))))

    dealt = salts_of(child, child_keys).withColumn("_salt", F.pmod(F.xxhash64(*child.columns), "_salts").cast("int")).drop("_salts")
    copies = salts_of(parent.select(*parent_keys, id_column).dropna(subset=list(parent_keys)), parent_keys)
    copies = copies.select(*parent_keys, id_column, F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_copy"))
    return resolve(dealt, copies, [*child_keys, "_salt"], [*parent_keys, "_copy"], id_column).drop("_salt")


def unresolved(
    child: DataFrame, parent: DataFrame, child_keys: Sequence[str], parent_keys: Sequence[str], edge: str,
    optional: bool = False,
) -> DataFrame:
    """Reference values without a parent: (edge, key, n_rows).

    Children shrink to distinct key values before the join, so a value that
    fills a third of the table is one row by then. A null reference is a
    violation unless the reference is optional; '' counts as null there.
    """
    needed = child
    if optional:
        present = F.lit(True)
        for c in child_keys:
            present = present & F.col(c).isNotNull() & (F.col(c) != "")
        needed = child.where(present)
    values = needed.groupBy(*[F.col(c).alias(f"_k{n}") for n, c in enumerate(child_keys)]).agg(
        F.count("*").alias("n_rows")
    )
    known = parent.select(*[F.col(p).alias(f"_k{n}") for n, p in enumerate(parent_keys)])
    orphans = values.join(known, [f"_k{n}" for n in range(len(parent_keys))], "left_anti")
    key = F.to_json(F.array(*[F.col(f"_k{n}").cast("string") for n in range(len(child_keys))]))
    return orphans.select(F.lit(edge).alias("edge"), key.alias("key"), "n_rows")


def reference_violations(frames: dict[str, DataFrame], fold_names: bool = True) -> DataFrame:
    """Every unresolved reference among the entities at hand, over all declared references.

    Names that compare case-blind resolve case-blind; ``fold_names=False`` asks
    for exact spelling.
    """
    found: DataFrame | None = None
    for entity in ENTITIES.values():
        for ref in entity.refs:
            if entity.name not in frames or ref.parent not in frames:
                continue
            child, parent = frames[entity.name], frames[ref.parent]
            parent_keys = ENTITIES[ref.parent].key
            if fold_names and ENTITIES[ref.parent].folded:
                for c in ref.columns:
                    child = child.withColumn(c, fold_case(F.col(c)))
                for p in ENTITIES[ref.parent].folded:
                    parent = parent.withColumn(p, fold_case(F.col(p)))
            bad = unresolved(child, parent, ref.columns, parent_keys, edge_name(entity.name, ref), ref.optional)
            found = bad if found is None else found.unionByName(bad)
    if found is None:
        raise ValueError("no reference joins two of the given entities")
    return found


def edge_name(entity: str, ref: Ref) -> str:
    return f"{entity}->{ref.parent}"


def drop_dangling(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Remove children of missing parents, parents first, as an alternative to refusing the load.

    References to entities that are not at hand are not judged.
    """
    kept: dict[str, DataFrame] = {}
    for name in (n for n in LOAD_ORDER if n in frames):
        df = frames[name]
        for ref in (r for r in ENTITIES[name].refs if r.parent in frames):
            first = ref.columns[0]
            keys = [f"_k{n}" for n in range(len(ref.columns))]
            folded = ENTITIES[ref.parent].folded
            fold = [fold_case if p in folded else (lambda c: c) for p in ENTITIES[ref.parent].key]
            parent = kept[ref.parent].select(
                *[f(F.col(p)).alias(k) for f, p, k in zip(fold, ENTITIES[ref.parent].key, keys)]
            )
            keyed = df.select("*", *[f(F.col(c)).alias(k) for f, c, k in zip(fold, ref.columns, keys)])
            found = keyed.join(parent, keys, "left_semi").select(*df.columns)
            if ref.optional:
                named = F.col(first).isNotNull() & (F.col(first) != "")
                df = found.where(named).unionByName(df.where(~F.coalesce(named, F.lit(False))))
            else:
                df = found
        kept[name] = df
    return kept


def cascade_report(frames: dict[str, DataFrame], kept: dict[str, DataFrame]) -> DataFrame:
    """Rows that ``drop_dangling`` removed: (entity, n_rows), entities that lost none left out."""
    lines: DataFrame | None = None
    for name, df in kept.items():
        both = frames[name].select(F.lit(1).alias("n")).unionByName(df.select(F.lit(-1).alias("n")))
        line = both.agg(F.sum("n").alias("n_rows")).select(F.lit(name).alias("entity"), "n_rows")
        lines = line if lines is None else lines.unionByName(line)
    return lines.where("n_rows > 0")


# Parents before children.
LOAD_ORDER = (
    "organization", "maintainer", "classifier", "package", "release", "release_detail", "release_file",
    "file_hash", "project_link", "maintained_by", "tagged_with", "release_keyword", "release_extra",
    "release_file_tag", "attestation",
)
