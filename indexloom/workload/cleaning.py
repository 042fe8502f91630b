"""Dedup, cleaning and backfill queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from indexloom.operators.cleaning import REPORT, backfill_parents, clean_entity, judge, watch
from indexloom.operators.ranking import cap_history, distinct_rows, first_successful, keep_first
from indexloom.registry import LIFECYCLE, Col
from indexloom.plans import extract
from indexloom.session import materialize, scratch_path
from indexloom.sources.captures import has_history, profiled_maintainers, read_candidates, rejected_pages, skipped_versions
from indexloom.workload.roles import Query, plain, profile_pages, release_pages, sql, table

# ------------------------------------------------------------------ dedup and selection


def _first(source: str, key: str, order: list[str], columns: list[str], folded=()):
    def run(spark, sf):
        rows = sql(spark, sf, source)
        return keep_first(rows, [key], order, folded).select(*columns)

    return run


_PACKAGES = "select o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_totalprice from {orders}"
_ORGS = "select lower(p_brand) as name, p_brand || ' ' || p_name as display_name, p_partkey from {part}"
_USERS = """
select case when l_returnflag = 'R' then upper(s_name) else s_name end as username, l_shipdate, l_orderkey, l_linenumber,
       l_extendedprice from {lineitem} join {supplier} on l_suppkey = s_suppkey"""


def _dedup_package(spark, sf):
    rows = sql(spark, sf, _PACKAGES).withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return keep_first(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "day"
    )


def _dedup_maintainer(spark, sf):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"]
    return keep_first(sql(spark, sf, _USERS), ["username"], order).select("username", "l_orderkey", "l_extendedprice")


def _dedup_classifier(spark, sf):
    return distinct_rows(table(spark, sf, "part"), ["p_brand", "p_type"])


def _dedup_maintained_by(spark, sf):
    pairs = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return distinct_rows(pairs, ["o_custkey", "l_suppkey"])


def _release_cap(spark, sf):
    history = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    dear = history.groupBy("o_custkey").agg(F.max(F.struct("o_totalprice", "o_orderkey")).alias("m"))
    current = dear.select("o_custkey", F.col("m.o_orderkey").alias("o_orderkey"))
    capped = cap_history(history, "o_custkey", [F.desc("o_orderdate"), F.col("o_orderkey")], "o_orderkey", current, 10)
    return capped.select("o_custkey", "o_orderkey", "o_totalprice")


def _candidates(spark, sf):
    ranked = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    good = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return first_successful(ranked, good, "c_custkey", ["c_acctbal", "c_custkey"], 100)


def _candidates_read(spark, sf):
    """Lines of documents as list files: how many names, and whether one more would be too many to ask for."""
    path = scratch_path(spark, "candidates")
    table(spark, sf, "documents").select(F.concat(F.lit("  "), F.col("text"), F.lit("\t"))).where("text is not null").write.text(path)
    names = read_candidates(spark, path, at_least=1)
    found = names.agg(F.count("*").alias("n_names"), F.countDistinct("rank").alias("n_ranks"), F.sum(F.length("package")).alias("n_chars"), F.min("package").alias("least"))
    try:
        read_candidates(spark, path, at_least=names.count() + 1)
        refused = False
    except ValueError:
        refused = True
    return found.withColumn("too_short_refused", F.lit(refused))


def _version_skips(spark, sf):
    plan = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("package"), F.col("o_orderkey").alias("version"), "o_orderpriority"
    )
    good = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(F.col("o_custkey").alias("package"), F.col("l_orderkey").alias("version"))
    return skipped_versions(plan, good)


def _profile_join(spark, sf):
    """Suppliers with sales as linked maintainers; those with a negative balance have a challenge page for a profile."""
    links = table(spark, sf, "lineitem").select(F.lit("p").alias("package_name"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("maintainer_username"))
    day = F.concat(F.lit("2020-01-"), F.lpad((F.col("s_suppkey") % 28 + 1).cast("string"), 2, "0"))
    dated = F.concat(F.lit('<div class="author-profile__metadiv"><i class="fa fa-calendar-alt"></i><time datetime="'), day, F.lit('">x</time></div>'))
    html = F.when(F.col("s_acctbal") < 0, extract.CHALLENGE_MARKER).when(F.col("s_suppkey") % 5 == 0, "<html></html>").otherwise(dated)
    profiles = table(spark, sf, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("username"), html.alias("html"))
    return profiled_maintainers(links, profiles)


def _pages_reject(spark, sf):
    """Real web pages, profiles and release pages, some of them with an empty timeline."""
    web = table(spark, sf, "pages").select(F.col("url").alias("page"), "html")
    profiles = profile_pages(spark, sf).select(F.col("username").alias("page"), "html")
    bare = F.regexp_replace("html", r'class="release(?=["\s])', 'class="none')
    releases = release_pages(spark, sf).select(F.col("version").alias("page"), F.when(F.col("place") % 10 == 0, bare).otherwise(F.col("html")).alias("html"))
    every = web.unionByName(profiles).unionByName(releases)
    return rejected_pages(every, has_history(F.col("html")))


# ------------------------------------------------------------------ cleaning

_RAW_PACKAGE = """
select c_name as name,
       case c_mktsegment when 'BUILDING' then 'archived' when 'FURNITURE' then 'unknown' when 'MACHINERY' then '' end
           as lifecycle_status,
       case when c_mktsegment <> 'AUTOMOBILE' then '' else n_name end as organization_owner
from {customer} join {nation} on c_nationkey = n_nationkey"""

_RAW_RELEASE = """
select case when o.o_orderstatus = 'P' and o.o_orderpriority = '1-URGENT' then '' else 'pkg' || cast(o.o_custkey as string) end
           as package_name,
       cast(o.o_orderkey as string) as version,
       case when o.o_orderpriority = '2-HIGH' then '' else cast(o.o_orderdate as string) end as created,
       o.o_orderstatus = 'P' as is_prerelease,
       case when o.o_orderpriority <> '3-MEDIUM' then o.o_orderstatus = 'F' end as yanked,
       case when o.o_orderstatus = 'F' then 'deprecated' when o.o_totalprice > 400000 then 'lost' end as lifecycle_status,
       cast(null as string) as yanked_reason, d.text as summary, '' as license, '>=3.9' as requires_python
from {orders} o left join {documents} d on o.o_orderkey = d.doc_id"""

_RAW_CLASSIFIER = "select lang || '-' || source as category, text as value from {documents}"
_RAW_KEYWORD = "select source as package_name, cast(doc_id as string) as version, text as keyword from {documents}"

_RAW = {
    "package": _RAW_PACKAGE, "release": _RAW_RELEASE, "classifier": _RAW_CLASSIFIER, "release_keyword": _RAW_KEYWORD,
}


def _clean(entity: str):
    return lambda spark, sf: clean_entity(sql(spark, sf, _RAW[entity]), entity).valid


_ALLOWED = ", ".join(f"'{x}'" for x in LIFECYCLE)
_RELEASE_REASON = f"""
case when nullif(package_name, '') is null then 'package_name missing'
     when nullif(version, '') is null then 'version missing'
     when nullif(created, '') is null then 'created missing'
     when is_prerelease is null then 'is_prerelease missing'
     when yanked is null then 'yanked missing'
     when lifecycle_status <> '' and lifecycle_status not in ({_ALLOWED}) then 'lifecycle_status not allowed' end"""
_PACKAGE_REASON = f"""
case when nullif(name, '') is null then 'name missing'
     when lifecycle_status <> '' and lifecycle_status not in ({_ALLOWED}) then 'lifecycle_status not allowed' end"""
_CLASSIFIER_REASON = """
case when nullif(category, '') is null then 'category missing' when length(category) > 50 then 'category too long'
     when nullif(value, '') is null then 'value missing' when length(value) > 255 then 'value too long' end"""
_KEYWORD_REASON = """
case when nullif(package_name, '') is null then 'package_name missing' when nullif(version, '') is null then 'version missing'
     when nullif(keyword, '') is null then 'keyword missing' end"""
_CUT = "case when length({c}) > {n} then substr({c}, 1, {m}) || '...' else nullif({c}, '') end as {c}"


def _cut(column: str, limit: int) -> str:
    return _CUT.format(c=column, n=limit, m=limit - 3)


_SQL_PACKAGE = f"""
select name, nullif(lifecycle_status, '') as lifecycle_status, nullif(organization_owner, '') as organization_owner
from ({plain(_RAW_PACKAGE)}) r where {_PACKAGE_REASON} is null"""
_SQL_RELEASE = f"""
select package_name, version, created, is_prerelease, yanked, nullif(lifecycle_status, '') as lifecycle_status,
       yanked_reason, {_cut('summary', 512)}, nullif(license, '') as license, requires_python
from ({plain(_RAW_RELEASE)}) r where {_RELEASE_REASON} is null"""


def _clean_missing(spark, sf):
    columns = [Col("name", required=True), Col("lifecycle_status"), Col("organization_owner")]
    return judge(sql(spark, sf, _RAW_PACKAGE), columns).valid


def _clean_required(spark, sf):
    columns = [Col("version", required=True), Col("created", required=True), Col("yanked", "bool", required=True)]
    return judge(sql(spark, sf, _RAW_RELEASE), columns).valid


def _clean_enum(spark, sf):
    columns = [Col("o_orderkey", "long"), Col("o_orderstatus", allowed=("O", "F"))]
    return judge(table(spark, sf, "orders"), columns).valid


def _clean_identifier(spark, sf):
    columns = [Col("doc_id", "long"), Col("text", required=True, max_length=255, kind="identifier")]
    return judge(table(spark, sf, "documents"), columns).valid


def _clean_truncate(spark, sf):
    columns = [Col("doc_id", "long"), Col("text", max_length=512, kind="descriptive")]
    return judge(table(spark, sf, "documents"), columns).valid


def _report(spark, sf):
    lines = None
    for entity, raw in _RAW.items():
        part = clean_entity(sql(spark, sf, raw), entity).report
        lines = part if lines is None else lines.unionByName(part)
    return lines


def _report_observed(spark, sf):
    """The same figures, taken while the valid rows are written."""
    lines = []
    for entity, raw in _RAW.items():
        watched = watch(clean_entity(sql(spark, sf, raw), entity))
        materialize(watched.valid, f"clean-{entity}")
        lines += watched.lines()
    return spark.createDataFrame(lines, REPORT)


def _rejects(spark, sf):
    return clean_entity(sql(spark, sf, _RAW_RELEASE), "release").rejected.select(
        "entity", "reason", F.get_json_object("row", "$.version").alias("version")
    )


def _report_sql(entity: str, reason: str, cut: str) -> str:
    return f"""
    select '{entity}' as entity, 'dropped' as outcome, {reason} as reason, count(*) as n
    from ({plain(_RAW[entity])}) r where {reason} is not null group by 3
    union all
    select * from (select '{entity}', 'truncated', cast(null as varchar), cast(sum({cut}) as bigint) as n
                   from ({plain(_RAW[entity])}) r) t where n > 0"""


_MAINT = "select 'Own' || cast(c_custkey as string) as username, c_mktsegment as joined_at from {customer} where c_acctbal >= 0"
_LINKS = """
select o_orderkey, case when o_orderstatus = 'F' then 'OWN' when o_orderstatus = 'P' then 'own' else 'Own' end
       || cast(o_custkey as string) as maintainer_username from {orders}"""


def _backfill(spark, sf):
    return backfill_parents(
        sql(spark, sf, _MAINT), sql(spark, sf, _LINKS), "username", "maintainer_username", ["o_orderkey"]
    )


def _ranked(source: str, key: str, order: str, columns: str) -> str:
    return f"""
    select {columns} from (select *, row_number() over (partition by {key} order by {order}) as rn
                           from ({plain(source)}) s) t where rn = 1"""


_REPORTED = " union all ".join(
    [
        _report_sql("package", _PACKAGE_REASON, "0"),
        # The summary comes after every column that can fail, so only valid rows count cuts.
        _report_sql(
            "release", _RELEASE_REASON, f"case when {_RELEASE_REASON} is null and length(summary) > 512 then 1 else 0 end"
        ),
        _report_sql("classifier", _CLASSIFIER_REASON, "0"),
        _report_sql("release_keyword", _KEYWORD_REASON, "case when length(keyword) > 100 then 1 else 0 end"),
    ]
)

QUERIES = {
    "dedup_package": Query(
        _dedup_package,
        _ranked(
            _PACKAGES, "o_custkey", "o_orderdate, o_orderkey",
            "o_custkey, o_orderkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') as day",
        ),
    ),
    "dedup_organization": Query(
        _first(_ORGS, "name", ["p_partkey"], ["name", "display_name"]), _ranked(_ORGS, "name", "p_partkey", "name, display_name")
    ),
    "dedup_maintainer": Query(
        _dedup_maintainer,
        _ranked(
            _USERS, "username", "l_shipdate, l_orderkey, l_linenumber, l_extendedprice", "username, l_orderkey, l_extendedprice"
        ),
    ),
    "dedup_classifier": Query(_dedup_classifier, "select distinct p_brand, p_type from part"),
    "dedup_maintained_by": Query(
        _dedup_maintained_by, "select distinct o_custkey, l_suppkey from lineitem join orders on l_orderkey = o_orderkey"
    ),
    "release_cap": Query(
        _release_cap,
        """
        select o_custkey, o_orderkey, o_totalprice from (
          select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) as rn,
                 row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey desc) as dear
          from orders) t where rn <= 10 or dear = 1""",
    ),
    "candidates_first_n": Query(
        _candidates,
        """
        select c_custkey, c_name, c_acctbal from customer
        where c_custkey in (select o_custkey from orders where o_orderstatus = 'P')
        order by c_acctbal, c_custkey limit 100""",
    ),
    "candidates_read": Query(
        _candidates_read,
        r"""
        select count(*) as n_names, count(*) as n_ranks, cast(sum(length(name)) as bigint) as n_chars, min(name) as least, true as too_short_refused
        from (select trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13)) as name from documents) t where name <> ''""",
    ),
    "version_skip_report": Query(
        _version_skips,
        """
        select o_custkey as package, o_orderkey as version, o_orderpriority from orders
        where o_orderkey not in (select l_orderkey from lineitem)""",
    ),
    "profile_join": Query(
        _profile_join,
        """
        select 's' || cast(s_suppkey as varchar) as username,
               case when s_suppkey % 5 <> 0 then '2020-01-' || lpad(cast(s_suppkey % 28 + 1 as varchar), 2, '0') end as joined_at
        from supplier where s_acctbal >= 0 and s_suppkey in (select l_suppkey from lineitem)""",
    ),
    "pages_reject": Query(
        _pages_reject,
        """
        select url as page, 'no release history' as reason from pages
        union all
        select 'Own' || cast(c_custkey as varchar), case when c_acctbal < 0 then 'challenge page' else 'no release history' end from customer
        union all
        select cast(o_orderkey as varchar) || '.0', 'no release history' from orders where o_orderkey % 10 = 0""",
    ),
    "clean_missing": Query(
        _clean_missing,
        f"""
        select name, nullif(lifecycle_status, '') as lifecycle_status, nullif(organization_owner, '') as organization_owner
        from ({plain(_RAW_PACKAGE)}) r""",
    ),
    "clean_required": Query(
        _clean_required,
        f"""
        select version, created, yanked from ({plain(_RAW_RELEASE)}) r where created <> '' and yanked is not null""",
    ),
    "clean_enum": Query(
        _clean_enum, "select o_orderkey, o_orderstatus from orders where o_orderstatus in ('O', 'F')"
    ),
    "clean_identifier": Query(
        _clean_identifier, "select doc_id, text from documents where text <> '' and length(text) <= 255"
    ),
    "clean_truncate": Query(_clean_truncate, f"select doc_id, {_cut('text', 512)} from documents"),
    "clean_package": Query(_clean("package"), _SQL_PACKAGE),
    "clean_entity": Query(_clean("release"), _SQL_RELEASE),
    "clean_rejects": Query(
        _rejects,
        f"""
        select 'release' as entity, {_RELEASE_REASON} as reason, version
        from ({plain(_RAW_RELEASE)}) r where {_RELEASE_REASON} is not null""",
    ),
    "clean_report": Query(_report, _REPORTED),
    "clean_report_observed": Query(_report_observed, _REPORTED),
    "backfill_parent": Query(
        _backfill,
        f"""
        with m as ({plain(_MAINT)}), l as ({plain(_LINKS)})
        select username, joined_at from m
        union all
        select maintainer_username, null from (
          select *, row_number() over (partition by lower(maintainer_username) order by o_orderkey) as rn from l) t
        where rn = 1 and lower(maintainer_username) not in (select lower(username) from m)""",
    ),
}
