"""Extraction queries: render a page per order, read it back, compare with the source rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from indexloom.functions import html as H
from indexloom.functions.text import parse_size
from indexloom.operators.ranking import distinct_rows, keep_first
from indexloom.plans import extract
from indexloom.registry import ENTITIES
from indexloom.plans.build import extract_run
from indexloom.sources.captures import profiled_maintainers
from indexloom.sources.runs import row_counts
from indexloom.workload.roles import Query, profile_pages, release_pages, table, view_sql

ORDER = ["rank", "place"]


def _entity(name: str):
    def run(spark, sf):
        pages = release_pages(spark, sf)
        parsed = extract.parse_pages(pages, extract.ENTITY_FIELDS[name], extract.FILE_PARTS.get(name))
        entity = ENTITIES[name]
        if name in ("classifier", "maintained_by"):
            return distinct_rows(extract.entity_rows(parsed, name), entity.names)
        if entity.first_wins:
            return keep_first(extract.entity_rows(parsed, name, ORDER), entity.key, ORDER).select(*entity.names)
        return extract.entity_rows(parsed, name)

    return run


def _maintainer(spark, sf):
    links = extract.entity_rows(extract.parse_pages(release_pages(spark, sf), ("maintainers",)), "maintained_by")
    return profiled_maintainers(links, profile_pages(spark, sf))


def _current_version(spark, sf):
    pages = release_pages(spark, sf).withColumn("version", F.lit(None).cast("string"))
    return extract.parse_pages(pages, ("current_version",)).select("place", "package", "current_version")


def _history(spark, sf):
    parsed = extract.parse_pages(release_pages(spark, sf), ("history",))
    return parsed.select("place", F.posexplode("history").alias("pos", "e")).select(
        "place", F.col("pos").cast("bigint").alias("pos"), "e.*"
    )


def _history_join(spark, sf):
    parsed = extract.parse_pages(release_pages(spark, sf), ("is_prerelease", "yanked", "yanked_reason"))
    return parsed.select("package", "version", "is_prerelease", "yanked", "yanked_reason")


def _file_kind(spark, sf):
    parsed = extract.parse_pages(release_pages(spark, sf), ("kinds",))
    return parsed.select("version", F.explode("kinds").alias("k")).select("version", "k.filename", "k.kind")


def _first_section(spark, sf):
    spans = release_pages(spark, sf).withColumn("spans", extract.page_regions(F.col("html")))
    copies = F.size(F.filter("spans", lambda s: s["label"] == "verified")).cast("bigint")
    names = extract.maintainers(H.first_labelled(F.col("spans"), "verified"))
    return spans.select("version", copies.alias("copies"), F.size(names).cast("bigint").alias("names_read"))


def _label_lookup(spark, sf):
    regions = extract.with_regions(release_pages(spark, sf))
    claimed = F.col("_claimed")
    return regions.select(
        "version",
        H.first_line_after(H.item_with_strong(claimed, "License:"), "License:").alias("license_line"),
        H.first_line_after(H.item_with_prefix(claimed, "Requires:"), "Requires:").alias("requires_line"),
        H.time_stamp(F.col("_date")).alias("day"),
    )


def _parse_size(spark, sf):
    text = F.concat(F.col("o_totalprice").cast("string"), F.lit(" "), F.col("unit"))
    units = F.when(F.col("o_orderpriority") == "1-URGENT", "kB").when(F.col("o_orderpriority") == "2-HIGH", "MB").when(
        F.col("o_orderpriority") == "3-MEDIUM", "GB"
    ).when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Bytes")
    orders = table(spark, sf, "orders").withColumn("unit", units)
    return orders.select("o_orderkey", parse_size(F.coalesce(text, F.lit("n/a"))).alias("size"))


def _extract_all(spark, sf):
    """Rows of all fifteen entities from one parse: (entity, n_rows)."""
    return row_counts(extract_run(release_pages(spark, sf), profile_pages(spark, sf))).where("entity <> 'total'")


def _web_links(spark, sf):
    """List links of real web pages with the same rule that reads project links."""
    pages = table(spark, sf, "pages").select("page_id", H.links_in_items(H.without_hidden(F.col("html"))).alias("links"))
    return pages.select("page_id", F.posexplode("links").alias("pos", "a")).select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "a.href", "a.text"
    )


_BASE = view_sql("base")

QUERIES = {f"ext_{n}": Query(_entity(e), view_sql(e)) for n, e in {
    "package": "package",
    "organization": "organization",
    "release": "release",
    "release_detail": "release_detail",
    "keyword": "release_keyword",
    "extra": "release_extra",
    "release_file": "release_file",
    "file_hash": "file_hash",
    "file_tag": "release_file_tag",
    "attestation": "attestation",
    "project_link": "project_link",
    "classifier": "classifier",
    "tagged_with": "tagged_with",
    "maintained_by": "maintained_by",
}.items()}
QUERIES |= {
    "ext_maintainer": Query(_maintainer, view_sql("maintainer")),
    "ext_current_version": Query(
        _current_version, f"select o_orderkey as place, package_name as package, version as current_version from ({_BASE}) b"
    ),
    "ext_history": Query(
        _history,
        f"""
        with e as (
          select o_orderkey, 0 as pos, '0.9' as version, true as is_prerelease, false as yanked,
                 cast(null as varchar) as yanked_reason, o_orderpriority from ({_BASE}) b where o_orderpriority <> '5-LOW'
          union all select o_orderkey, 1, version, o_orderstatus = 'P', o_orderstatus = 'F',
                 case when o_orderstatus = 'F' then 'late & ' || o_orderpriority end, o_orderpriority from ({_BASE}) b
          union all select o_orderkey, 2, version, false, false, null, o_orderpriority from ({_BASE}) b
          union all select o_orderkey, 3, '0.8', false, true, 'old', o_orderpriority from ({_BASE}) b)
        select o_orderkey as place,
               cast(pos - case when o_orderpriority = '5-LOW' then 1 else 0 end as bigint) as pos,
               version, is_prerelease, yanked, yanked_reason from e""",
    ),
    "release_history_join": Query(
        _history_join,
        f"""
        select package_name as package, version, o_orderstatus = 'P' as is_prerelease, o_orderstatus = 'F' as yanked,
               case when o_orderstatus = 'F' then 'late & ' || o_orderpriority end as yanked_reason from ({_BASE}) b""",
    ),
    "ext_file_kind": Query(
        _file_kind, f"select version, filename, packagetype as kind from ({view_sql('release_file')}) f"
    ),
    "first_section_only": Query(
        _first_section, f"select version, cast(2 as bigint) as copies, cast(2 as bigint) as names_read from ({_BASE}) b"
    ),
    "label_lookup": Query(
        _label_lookup,
        f"""
        select version, case when o_orderpriority in ('1-URGENT', '3-MEDIUM') then 'Own "terms"' end as license_line,
               case when o_orderstatus = 'F' then 'Python >=3.' || cast(c_nationkey as varchar) end as requires_line,
               stamp as day from ({_BASE}) b""",
    ),
    "parse_size": Query(
        _parse_size,
        """
        select o_orderkey, cast(floor(case o_orderpriority
               when '1-URGENT' then o_totalprice * 1024 when '2-HIGH' then o_totalprice * 1048576
               when '3-MEDIUM' then o_totalprice * 1073741824 when '4-NOT SPECIFIED' then o_totalprice else 0 end)
               as bigint) as size from orders""",
    ),
    "extract_all": Query(
        _extract_all, " union all ".join(f"select '{n}' as entity, count(*) as n_rows from ({view_sql(n)}) t" for n in ENTITIES)
    ),
    "web_page_links": Query(
        _web_links,
        r"""
        with nav as (select page_id, regexp_extract(html, '<li.*', 0, 's') as nav from pages),
        a as (select page_id, unnest(regexp_extract_all(nav, '<a href="[^"]*">[^<]*</a>')) as a,
                     generate_subscripts(regexp_extract_all(nav, '<a href="[^"]*">[^<]*</a>'), 1) - 1 as pos from nav)
        select page_id, cast(pos as bigint) as pos,
               replace(regexp_extract(a, 'href="([^"]*)"', 1), '&amp;', '&') as href,
               trim(replace(replace(replace(regexp_extract(a, '>([^<]*)<', 1), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) as text
        from a""",
    ),
}
