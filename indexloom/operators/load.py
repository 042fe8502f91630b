"""Natural-key entities to their relational load shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from indexloom.functions.text import fold_case, parse_timestamp
from indexloom.operators.keys import dense_ids, natural_id, resolve_spread
from indexloom.registry import ENTITIES


def _id(entity: str, *columns: str) -> Column:
    parts = [F.col(c) for c in columns]
    if ENTITIES[entity].folded:
        parts = [fold_case(p) for p in parts]
    return natural_id(*parts)


def load_shape(frames: dict[str, DataFrame], entity: str) -> DataFrame:
    """One entity as it is stored: ids instead of names, timestamps parsed, flags defaulted.

    Ids are hashes of names, so the fat rows are projected in place and never
    shuffled to find a parent; whether the parents exist is checked apart, on
    the key columns only (``reference_violations``). Only classifier ids are
    looked up, because they are numbered; a few classifiers hold most tags (``resolve_spread``).
    """
    df = frames[entity]
    release = _id("release", "package_name", "version").alias("release_id") if "version" in df.columns else None
    file_id = (
        _id("release_file", "package_name", "version", "filename").alias("release_file_id")
        if "filename" in df.columns
        else None
    )
    if entity == "organization":
        return df.select(_id(entity, "name").alias("organization_id"), "display_name", "name")
    if entity == "maintainer":
        return df.select(
            _id(entity, "username").alias("maintainer_id"), parse_timestamp(F.col("joined_at")).alias("joined_at"), "username"
        )
    if entity == "classifier":
        return dense_ids(df.select("category", "value"), ["category", "value"], "classifier_id").select(
            F.col("classifier_id").cast("int").alias("classifier_id"), "category", "value"
        )
    if entity == "package":
        owner = F.nullif(F.col("organization_owner"), F.lit(""))
        return df.select(
            _id(entity, "name").alias("package_id"), natural_id(owner).alias("org_id"), "lifecycle_status", "name",
            F.lower("name").alias("name_ci"),
        )
    if entity == "release":
        return df.select(
            release,
            _id("package", "package_name").alias("package_id"),
            parse_timestamp(F.col("created")).alias("created"),
            F.coalesce("is_prerelease", F.lit(False)).alias("is_prerelease"),
            F.coalesce("yanked", F.lit(False)).alias("yanked"),
            "lifecycle_status", "version", "yanked_reason", "summary", "license", "requires_python",
        )
    if entity == "release_detail":
        return df.select(
            release,
            "meta_author_email_verified", "meta_maintainer_email_verified", "description",
            "meta_author", "meta_author_email", "meta_maintainer", "meta_maintainer_email",
        )
    if entity == "release_file":
        return df.select(
            file_id,
            release,
            "size",
            parse_timestamp(F.col("upload_time")).alias("upload_time"),
            F.coalesce("is_trusted_publishing", F.lit(False)).alias("is_trusted_publishing"),
            "filename", "path", "uploaded_via",
        )
    if entity == "file_hash":
        return df.select(file_id, "algorithm", "digest")
    if entity == "project_link":
        return df.select(release, "label", "verified", "url")
    if entity == "maintained_by":
        return df.select(
            _id("package", "package_name").alias("package_id"),
            _id("maintainer", "maintainer_username").alias("maintainer_id"),
        )
    if entity == "tagged_with":
        keyed = load_shape(frames, "classifier") if "_classifier_ids" not in frames else frames["_classifier_ids"]
        both = df.withColumn("release_id", release)
        found = resolve_spread(both, keyed, ["category", "value"], ["category", "value"], "classifier_id")
        return found.select("release_id", "classifier_id")
    if entity == "release_keyword":
        return df.select(release, "keyword")
    if entity == "release_extra":
        return df.select(release, "extra_name")
    if entity == "release_file_tag":
        return df.select(file_id, "wheel_tag")
    if entity == "attestation":
        rest = [c for c in ENTITIES[entity].names[5:]]
        return df.select(
            "sigstore_log_index", file_id, parse_timestamp(F.col("integration_time")).alias("integration_time"), *rest
        )
    raise ValueError(entity)


def bad_timestamps(frames: dict[str, DataFrame]) -> DataFrame:
    """Stamps that do not parse, counted per column: (entity, column, n_rows). Null stays allowed where optional."""
    found: DataFrame | None = None
    for name, df in frames.items():
        for col in ENTITIES[name].columns if name in ENTITIES else ():
            if col.type != "stamp":
                continue
            raw = F.col(col.name)
            bad = parse_timestamp(raw).isNull() & (F.lit(col.required) | raw.isNotNull())
            line = df.agg(F.count_if(bad).alias("n_rows")).select(
                F.lit(name).alias("entity"), F.lit(col.name).alias("column"), "n_rows"
            )
            found = line if found is None else found.unionByName(line)
    return found
