"""The five questions, each in a first and a rewritten form.

Tables come in load shape: organization(organization_id, display_name, name),
package(package_id, org_id, name), release(release_id, package_id, version),
maintainer(maintainer_id, username), maintained_by(package_id, maintainer_id),
release_file(release_file_id, release_id, filename, path, size, upload_time),
file_hash(release_file_id, algorithm, digest). Ids break ties, so a top-k is
the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from indexloom.functions.text import fold_case

Tables = dict[str, DataFrame]


def top_packages(t: Tables, limit: int = 10) -> DataFrame:
    """Packages with the most releases and their owner's name; packages without a release do not count."""
    counts = t["release"].groupBy("package_id").agg(F.count("*").alias("release_count"))
    owned = t["package"].join(t["organization"], F.col("org_id") == F.col("organization_id"))
    return (
        owned.join(counts, "package_id")
        .select("package_id", t["package"]["name"], "display_name", "release_count")
        .orderBy(F.desc("release_count"), "package_id")
        .limit(limit)
    )


def top_packages_naive(t: Tables, limit: int = 10) -> DataFrame:
    """Same question with a counting subquery per row; packages without a release show 0."""
    return t["package"].sparkSession.sql(
        f"""
        select distinct p.package_id, p.name, o.display_name,
               (select count(*) from {{release}} r where r.package_id = p.package_id) as release_count
        from {{package}} p, {{organization}} o
        where p.org_id = o.organization_id
        order by release_count desc, package_id limit {int(limit)}
        """,
        release=t["release"], package=t["package"], organization=t["organization"],
    )


def releases_by_maintainer_name(t: Tables, part: str = "lib") -> DataFrame:
    """Releases of packages with a maintainer whose name holds ``part`` (case-blind), with maintainer counts.

    One pass over the links: matching maintainers are marked, then each package is counted and kept if any is.
    """
    hits = t["maintainer"].where(fold_case(F.col("username")).contains(fold_case(F.lit(part))))
    hits = hits.select("maintainer_id", F.lit(True).alias("_hit"))
    counts = (
        t["maintained_by"].join(hits, "maintainer_id", "left").groupBy("package_id")
        .agg(F.count("*").alias("maintainer_count"), F.max("_hit").alias("_hit")).where("_hit").drop("_hit")
    )
    return (
        t["release"]
        .join(t["package"].select("package_id", "name").join(counts, "package_id"), "package_id")
        .select("release_id", "version", "name", "maintainer_count")
        .orderBy("name", "release_id")
    )


def releases_by_maintainer_name_naive(t: Tables, part: str = "lib") -> DataFrame:
    """Same question with a counting subquery and IN."""
    pattern = "%" + part.lower().replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"
    return t["package"].sparkSession.sql(
        """
        select r.release_id, r.version, p.name,
               (select count(*) from {maintained_by} mb where mb.package_id = p.package_id) as maintainer_count
        from {release} r, {package} p
        where r.package_id = p.package_id
          and p.package_id in (
              select mb.package_id from {maintained_by} mb, {maintainer} m
              where mb.maintainer_id = m.maintainer_id and lower(m.username) like :pattern)
        order by p.name, r.release_id
        """,
        args={"pattern": pattern},
        maintained_by=t["maintained_by"], maintainer=t["maintainer"], release=t["release"], package=t["package"],
    )


def releases_by_maintainer_name_collated(t: Tables, part: str = "lib", collation: str = "UNICODE_CI") -> DataFrame:
    """Same question under the column's own case-blind collation instead of a folded key.

    The collation holds sharp s apart from ss, and final sigma equal to sigma.
    """
    hits = t["maintainer"].where(F.contains(F.collate("username", collation), F.collate(F.lit(part), collation)))
    links = t["maintained_by"]
    counts = links.groupBy("package_id").agg(F.count("*").alias("maintainer_count"))
    wanted = links.join(hits.select("maintainer_id"), "maintainer_id", "left_semi").select("package_id").distinct()
    return (
        t["release"].join(t["package"].select("package_id", "name").join(wanted, "package_id", "left_semi").join(counts, "package_id"), "package_id")
        .select("release_id", "version", "name", "maintainer_count").orderBy("name", "release_id")
    )


def packages_without_maintainer(t: Tables) -> DataFrame:
    """Packages no maintainer is linked to; nulls in the link table do not matter."""
    return (
        t["package"].join(t["maintained_by"].select("package_id"), "package_id", "left_anti")
        .select("package_id", "name").orderBy("name", "package_id")
    )


def packages_not_in_links(t: Tables) -> DataFrame:
    """Same question as NOT IN answers it: one null among the links and nothing comes back.

    Spark plans NOT IN on nullable columns as a broadcast of the whole link
    table. The null rule is therefore asked as two scalar counts (one scan, the
    optimizer merges them) and the rest is a plain anti join, which scales.
    """
    return t["package"].sparkSession.sql(
        """
        select p.package_id, p.name from {package} p
        where (select count_if(package_id is null) from {links}) = 0
          and (p.package_id is not null or (select count(*) from {links}) = 0)
          and not exists (select 1 from {links} mb where mb.package_id = p.package_id)
        order by p.name, p.package_id
        """,
        package=t["package"], links=t["maintained_by"],
    )


def _files_with_digest(t: Tables, package: DataFrame, algorithm: str) -> DataFrame:
    hashes = t["file_hash"].where(F.col("algorithm") == algorithm)
    return (
        package.select("package_id")
        .join(t["release"], "package_id")
        .join(t["release_file"], "release_id")
        .join(hashes, "release_file_id")
        .select(
            "release_file_id", "filename", "path", "size", "upload_time", "release_id", "version", "digest"
        )
    )


def package_file_digests(t: Tables, name: str, algorithm: str = "SHA256") -> DataFrame:
    """Files and digests of one package. The stored lower-case name is compared by plain equality,
    so the filter reaches the scan; the single package is then joined down."""
    return _files_with_digest(t, t["package"].where(F.col("name_ci") == name.lower()), algorithm)


def package_file_digests_upper(t: Tables, name: str, algorithm: str = "SHA256") -> DataFrame:
    """Same question comparing upper-cased names, which no scan can use."""
    return _files_with_digest(t, t["package"].where(F.upper("name") == name.upper()), algorithm)


def package_file_digests_collated(t: Tables, name: str, algorithm: str = "SHA256", collation: str = "UNICODE_CI") -> DataFrame:
    """Same question under the column's own case-blind collation: no stored key is needed, and no scan can use it."""
    same = F.collate("name", collation) == F.collate(F.lit(name), collation)
    return _files_with_digest(t, t["package"].where(same), algorithm)


def releases_per_organization(t: Tables) -> DataFrame:
    """Release totals of every organization that owns a package, 0 included, most first.

    Releases are counted per package before they meet packages and owners.
    """
    counts = t["release"].groupBy("package_id").agg(F.count("release_id").alias("_n"))
    owned = t["package"].where(F.col("org_id").isNotNull()).select("package_id", "org_id")
    per = (
        owned.join(counts, "package_id", "left")
        .groupBy("org_id").agg(F.sum(F.coalesce("_n", F.lit(0))).alias("total_release"))
    )
    return (
        t["organization"].join(per, F.col("organization_id") == F.col("org_id"))
        .select("organization_id", "display_name", "total_release")
        .orderBy(F.desc("total_release"), "organization_id")
    )


def releases_per_organization_naive(t: Tables) -> DataFrame:
    """Same question in plain join order. The nested counting form needs an outer
    reference across two levels, which Spark SQL does not resolve."""
    return t["package"].sparkSession.sql(
        """
        select o.organization_id, o.display_name, count(r.release_id) as total_release
        from {organization} o
        join {package} p on p.org_id = o.organization_id
        left join {release} r on r.package_id = p.package_id
        group by o.organization_id, o.display_name
        order by total_release desc, o.organization_id
        """,
        organization=t["organization"], package=t["package"], release=t["release"],
    )
