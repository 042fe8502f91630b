"""Role views over the driver tables, and pages rendered from them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from indexloom.registry import HASH_ALGORITHMS
from indexloom.session import materialize

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_BASE = """
select o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderpriority, o.o_totalprice,
       c.c_nationkey, c.c_mktsegment, n.n_name,
       c.c_name as package_name, cast(o.o_orderkey as string) || '.0' as version,
       replace(c.c_name, '#', '-') || '-' || cast(o.o_orderkey as string) || '.0' as stem,
       replace(cast(o.o_orderdate as string), ' ', 'T') || '+0000' as stamp
from {orders} o
join {customer} c on o.o_custkey = c.c_custkey
join {nation} n on c.c_nationkey = n.n_nationkey
"""

_FILES = f"""
select b.package_name, b.version, b.o_orderkey, b.o_orderpriority, b.stamp, b.stem || '.tar.gz' as filename,
       cast(floor(b.o_totalprice * 1024) as bigint) as size,
       'tool/' || cast(b.c_nationkey as string) as uploaded_via, 'sdist' as packagetype
from ({_BASE}) b
union all
select b.package_name, b.version, b.o_orderkey, b.o_orderpriority, b.stamp, b.stem || '-py3-none-any.whl',
       b.o_custkey, cast(null as string), 'wheel'
from ({_BASE}) b where b.o_orderstatus <> 'P'
"""

_HASHES = """
select f.package_name, f.version, f.filename, a.algorithm,
       case a.algorithm when 'SHA256' then {sha_filename} when 'MD5' then md5(f.filename)
            else {sha_b2} end as digest
from ({files}) f {algorithms}
"""

ENTITY_VIEWS = {
    "organization": f"""
        select distinct lower(n_name) as name, n_name || ' & <Co>' as display_name
        from ({_BASE}) b where c_mktsegment <> 'MACHINERY'""",
    "package": f"""
        select distinct package_name as name,
               case when c_mktsegment = 'BUILDING' then 'quarantined' end as lifecycle_status,
               case when c_mktsegment <> 'MACHINERY' then lower(n_name) end as organization_owner
        from ({_BASE}) b""",
    "maintainer": """
        select 'Own' || cast(c_custkey as string) as username,
               case when c_mktsegment <> 'HOUSEHOLD'
                    then '20' || lpad(cast(c_nationkey as string), 2, '0') || '-01-02T03:04:05+0000' end as joined_at
        from {customer} where c_acctbal >= 0 and c_custkey in (select o_custkey from {orders})""",
    "maintained_by": f"""
        select distinct package_name, 'Own' || cast(o_custkey as string) as maintainer_username from ({_BASE}) b
        union
        select distinct package_name, 'lib-' || lower(c_mktsegment) from ({_BASE}) b""",
    "release": f"""
        select package_name, version, stamp as created, o_orderstatus = 'P' as is_prerelease,
               o_orderstatus = 'F' as yanked, cast(null as string) as lifecycle_status,
               case when o_orderstatus = 'F' then 'late & ' || o_orderpriority end as yanked_reason,
               o_orderpriority || ' order <' || version || '>' as summary,
               case o_orderpriority when '1-URGENT' then 'MIT' when '2-HIGH' then 'Apache-2.0 OR MIT'
                    when '3-MEDIUM' then 'Own "terms"' end as license,
               case when o_orderstatus = 'F' then '>=3.' || cast(c_nationkey as string) end as requires_python
        from ({_BASE}) b""",
    "release_detail": f"""
        select package_name, version,
               '<p>' || version || ' &amp; <b>' || package_name || '</b></p><div><div>x</div></div>' as description,
               case when o_orderstatus <> 'P' then package_name || ' Jr.' end as meta_author,
               case when o_orderstatus = 'O' then 'own' || cast(o_custkey as string) || '@x.example' end
                   as meta_author_email,
               o_orderstatus = 'O' as meta_author_email_verified,
               case when c_mktsegment in ('BUILDING', 'FURNITURE') then 'Team ' || n_name end as meta_maintainer,
               case when c_mktsegment = 'BUILDING' then 'team@y.example' end as meta_maintainer_email,
               c_mktsegment = 'FURNITURE' as meta_maintainer_email_verified
        from ({_BASE}) b""",
    "release_file": f"""
        select package_name, version, filename, '/packages/' || filename as path, size, stamp as upload_time,
               o_orderpriority = '1-URGENT' as is_trusted_publishing, uploaded_via, packagetype
        from ({_FILES}) f""",
    "project_link": f"""
        select package_name, version, 'Home' as label,
               'https://home.example/' || cast(o_custkey as string) || '?a=1&b=2' as url, true as verified
        from ({_BASE}) b
        union all
        select package_name, version, 'Docs', 'https://docs.example/' || version, false from ({_BASE}) b""",
    "tagged_with": f"""
        select package_name, version, 'Development Status' as category, o_orderpriority as value from ({_BASE}) b
        union all select package_name, version, 'Topic', 'Market :: ' || c_mktsegment from ({_BASE}) b
        union all select package_name, version, 'Topic', 'Nation :: ' || n_name from ({_BASE}) b""",
    "release_keyword": f"""
        select package_name, version, o_orderpriority as keyword from ({_BASE}) b
        union all select package_name, version, lower(c_mktsegment) from ({_BASE}) b""",
    "release_extra": f"""
        select package_name, version, 'test' as extra_name from ({_BASE}) b where o_orderstatus = 'F'
        union all select package_name, version, 'docs' from ({_BASE}) b where o_orderstatus = 'F'""",
    "release_file_tag": f"""
        select package_name, version, filename, 'Python 3' as wheel_tag from ({_FILES}) f
        where packagetype = 'wheel'""",
    "attestation": f"""
        select package_name, version, filename, o_orderkey + 1000 as sigstore_log_index, stamp as integration_time,
               'https://statement.example/v1' as statement_type, 'https://predicate.example/v1' as predicate_type,
               filename as subject_name, md5(filename) as subject_digest,
               'https://code.example/' || package_name as source_repo, 'refs/tags/' || version as source_reference,
               'https://token.example' as token_issuer, 'hosted' as runner_environment,
               'publish.yml@' || version as publisher_workflow, 'push' as trigger_event
        from ({_FILES}) f where packagetype = 'sdist' and o_orderpriority = '1-URGENT'""",
}
ENTITY_VIEWS["classifier"] = f"select distinct category, value from ({ENTITY_VIEWS['tagged_with']}) t"


# How each engine writes one row per algorithm and a SHA-256 in hex.
_ALGORITHMS = ", ".join(f"'{a}'" for a in HASH_ALGORITHMS)
_SPARK = {"algorithms": f"lateral view explode(array({_ALGORITHMS})) a as algorithm", "sha256": "sha2({x}, 256)"}
_CHECKER = {"algorithms": f", unnest([{_ALGORITHMS}]) a(algorithm)", "sha256": "sha256({x})"}


def _text(name: str, dialect: dict[str, str]) -> str:
    text = _HASHES.replace("{files}", _FILES) if name == "file_hash" else VIEWS.get(name) or ENTITY_VIEWS[name]
    for mark, arg in (("{sha_filename}", "f.filename"), ("{sha_b2}", "'b2' || f.filename")):
        text = text.replace(mark, dialect["sha256"].replace("{x}", arg))
    return text.replace("{algorithms}", dialect["algorithms"])


def view_sql(name: str) -> str:
    """A role view as SQL for the checking engine; usable as a subquery."""
    return plain(_text(name, _CHECKER))


def plain(text: str) -> str:
    """Placeholders to table names."""
    for name in TABLES:
        text = text.replace("{" + name + "}", name)
    return text


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The same role view as a DataFrame."""
    return sql(spark, sf, _text(name, _SPARK))


def sql(spark: SparkSession, sf: str, text: str) -> DataFrame:
    used = {t: table(spark, sf, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def frames(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    return {n: view(spark, sf, n) for n in names}


def frames_on_base(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    """``frames``, for many views at once: orders, customers and nations are joined and written only once."""
    base = materialize(view(spark, sf, "base"), "base")

    def on_base(name: str) -> DataFrame:
        text = _text(name, _SPARK).replace(f"({_BASE})", "{base}")
        used = {t: table(spark, sf, t) for t in TABLES if "{" + t + "}" in text}
        return spark.sql(text, **used, **({"base": base} if "{base}" in text else {}))

    return {n: on_base(n) for n in names}


# Load-shape tables the five questions run on.
VIEWS = {
    "base": _BASE,
    "q_organization": "select n_nationkey as organization_id, n_name as display_name, lower(n_name) as name from {nation}",
    "q_package": """
        select c_custkey as package_id, case when c_mktsegment <> 'MACHINERY' then c_nationkey end as org_id,
               c_name as name, lower(c_name) as name_ci from {customer}""",
    "q_release": """
        select o_orderkey as release_id, o_custkey as package_id, cast(o_orderkey as string) || '.0' as version
        from {orders}""",
    "q_maintainer": "select s_suppkey as maintainer_id, s_name as username from {supplier}",
    "q_maintained_by": """
        select distinct o_custkey as package_id, l_suppkey as maintainer_id
        from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "q_release_file": """
        select o_orderkey * 2 as release_file_id, o_orderkey as release_id,
               cast(o_orderkey as string) || '.tar.gz' as filename, '/p/' || cast(o_orderkey as string) as path,
               cast(floor(o_totalprice) as bigint) as size, cast(o_orderdate as string) as upload_time
        from {orders}""",
    "q_file_hash": """
        select o_orderkey * 2 as release_file_id, a.algorithm, md5(a.algorithm || cast(o_orderkey as string)) as digest
        from {orders} {algorithms}""",
    # Orders as packages and lineitem as links: some packages have no link.
    "q_linked_package": "select o_orderkey as package_id, 'order ' || cast(o_orderkey as string) as name from {orders}",
    "q_link": "select l_orderkey as package_id, l_suppkey as maintainer_id from {lineitem}",
}


def question_tables(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    return {n: view(spark, sf, f"q_{n}") for n in names}


def micros(df: DataFrame) -> DataFrame:
    """Timestamps as microseconds since 1970, so both engines compare plain numbers."""
    return df.select(
        *[
            F.unix_micros(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema
        ]
    )


def uid(*parts: str) -> str:
    """SQL of the natural-key id for the checking engine."""
    text = " || ".join(f"cast(length({p}) as varchar) || ':' || {p}" for p in parts)
    h = f"sha256({text})"
    return " || '-' || ".join(f"substr({h}, {at}, {size})" for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


# ---------------------------------------------------------------- rendered pages


def _esc(text: Column) -> Column:
    for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;")):
        text = F.replace(text, F.lit(char), F.lit(ref))
    return text


def _when(test: Column, *parts) -> Column:
    return F.when(test, _html(*parts)).otherwise(F.lit(""))


def _html(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


# Fixed values below: tags, class names, attribute names and labels are the index's own markup.


def _panel(filename: Column, size: Column, tags: str, via: Column, provenance: Column) -> Column:
    c = F.col
    hashes = _html(
        '<table class="table table--hashes"><thead><tr><th scope="col">Algorithm</th></tr></thead><tbody>',
        '<tr><th scope="row">SHA256</th><td><code>', F.sha2(filename, 256), "</code></td></tr>",
        '<tr><th scope="row">MD5</th><td><code>', F.md5(filename), "</code></td></tr>",
        '<tr><th scope="row">BLAKE2b-256</th><td><code>', F.sha2(F.concat(F.lit("b2"), filename), 256),
        "</code></td></tr></tbody></table>",
    )
    return _html(
        '<div id="', filename, '" class="vertical-tabs__content"><h2>File details</h2><ul><li>Download URL: <a href="/packages/',
        filename, '">', filename, '</a></li><li>Upload date: <time datetime="', c("stamp"), '">day</time></li><li>Size: ',
        size, "</li><li>Tags: ", tags, "</li><li>Uploaded using Trusted Publishing? ",
        F.when(c("o_orderpriority") == "1-URGENT", "Yes").otherwise("No"), "</li>", via, "</ul>", hashes, provenance, "</div>",
    )


def _provenance(filename: Column) -> Column:
    c = F.col

    def code(label: str, *value) -> Column:
        return _html(f"<li>{label} <code>", *value, "</code></li>")

    return _when(
        c("o_orderpriority") == "1-URGENT",
        "<div><h3>Provenance</h3><ul>",
        code("Statement type:", "https://statement.example/v1"), code("Predicate type:", "https://predicate.example/v1"),
        code("Subject name:", filename), code("Subject digest:", F.md5(filename)),
        '<li>Sigstore transparency entry: <a href="https://log.example/?logIndex=7">7</a></li>',
        '<li>Sigstore transparency entry: <a href="https://log.example/?logIndex=', (c("o_orderkey") + 1000).cast("string"),
        '">n</a></li><li>Sigstore integration time: <time datetime="', c("stamp"), '">day</time></li></ul><div><ul>',
        code("Permalink:", "https://code.example/", c("package_name"), "@abc@def"),
        code("Branch / Tag:", "refs/tags/", c("version")),
        code("Token Issuer:", "https://token.example"), code("Runner Environment:", "hosted"),
        code("Publication workflow:", "publish.yml@", c("version")), code("Trigger Event:", "push"),
        "</ul></div></div>",
    )


def release_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One page per order: rank, place, package, version, html. Everything is built within the row."""
    c = F.col
    status, priority, segment = c("o_orderstatus"), c("o_orderpriority"), c("c_mktsegment")
    key = c("o_custkey").cast("string")
    person = _html("<strong>Author:</strong> ")
    team = _html("<strong>Maintainer:</strong> ")
    verified = _html(
        '<div class="sidebar-section verified"><h6>Project links</h6><ul class="vertical-tabs__list"><li>'
        '<a class="x" href="https://home.example/', key, '?a=1&amp;b=2">Home</a></li></ul>',
        _when(
            segment != "MACHINERY",
            '<h6>Owner</h6> <ul class="vertical-tabs__list"><li><a href="/org/', F.lower(c("n_name")), '/">',
            _esc(_html(c("n_name"), " & <Co>")), "</a></li></ul>",
        ),
        '<h6>Maintainers</h6><span class="sidebar-section__user-gravatar-text"> Own', key,
        '</span><span class="sidebar-section__user-gravatar-text">lib-', F.lower(segment), "</span><h6>Meta</h6><ul>",
        _when(status == "O", "<li>", person, '<a href="mailto:own', key, '@x.example">', c("package_name"), " Jr.</a></li>"),
        _when(segment == "FURNITURE", "<li>", team, "Team ", c("n_name"), "</li>"),
        "</ul></div>",
    )
    unverified = _html(
        '<div class="sidebar-section unverified"><h6>Project links</h6><ul class="vertical-tabs__list"><li>'
        '<a href="https://docs.example/', c("version"), '">Docs</a></li></ul><h6>Meta</h6><ul>',
        _when(
            priority == "1-URGENT",
            "<li><span><strong>License Expression:</strong> MIT\n<br><small><a>SPDX</a></small></span></li>",
        ),
        _when(priority == "2-HIGH", "<li><strong>License Expression:</strong> Apache-2.0 OR MIT\n<small>x</small></li>"),
        _when(priority.isin("1-URGENT", "3-MEDIUM"), "<li><strong>License:</strong> Own &#34;terms&quot;</li>"),
        _when(status == "F", "<li><strong>Requires:</strong> Python &gt;=3.", c("c_nationkey").cast("string"), "</li>"),
        _when(status.isin("F", "O"), "<li>", person, c("package_name"), " Jr.</li>"),
        _when(segment == "BUILDING", "<li>", team, '<a href="mailto:team@y.example">Team ', c("n_name"), "</a></li>"),
        '<li class="tags"><span class="package-keyword">\n  ', priority,
        '\n,  </span><span class="package-keyword"> , </span><span class="package-keyword">', F.lower(segment), "</span></li>",
        _when(status == "F", "<li><strong>Provides-Extra:</strong> <code>test</code>, <code> docs</code></li>"),
        '</ul><h6>Classifiers</h6><ul class="sidebar-section__classifiers"><li><strong>Development Status</strong>'
        '<ul><li><a href="/s">', priority, '</a></li></ul></li><li><strong>Topic</strong><ul><li><a href="/s">Market :: ',
        segment, '</a></li><li><a href="/s">Nation :: ', c("n_name"), "</a></li></ul></li></ul></div>",
    )
    sidebar = _html(verified, unverified)
    badge = F.when(status == "P", '<span class="badge badge--warning">pre-release</span>').when(
        status == "F", '<span class="badge badge--danger">yanked</span>'
    ).otherwise("")
    timeline = _html(
        '<div class="release-timeline">',
        _when(
            priority != "5-LOW",
            '<div class="release release--latest"><p class="release__version">\n 0.9 <span class="badge badge--warning">'
            "pre-release</span></p></div>",
        ),
        '<div class="release"><p class="release__version">', c("version"), " ", badge, "</p>",
        _when(status == "F", '<p class="release__yanked-reason">', _esc(_html("late & ", priority)), "</p>"),
        '</div><div class="release"><p class="release__version">', c("version"),
        '</p></div><div class="release"><p class="release__version">0.8 <span class="badge badge--danger">yanked</span></p>'
        '<p class="release__yanked-reason">old</p></div></div>',
    )
    sdist = _html(c("stem"), ".tar.gz")
    wheel = _html(c("stem"), "-py3-none-any.whl")
    has_wheel = status != "P"
    listed = _html(
        '<div id="files"><h2>Download files</h2><h3>Source Distribution</h3><div class="file"><div class="card">'
        '<a href="https://files.pythonhosted.org/', sdist, '">', sdist, '</a> (<a href="#x">details</a>)</div></div>',
        _when(
            has_wheel, "<h3>Built Distribution", F.when(priority == "2-HIGH", "s").otherwise(""),
            '</h3><div class="file"><a href="https://files.pythonhosted.org/', wheel, '">\n', wheel, "</a></div>",
        ),
        "</div>",
        _panel(
            sdist, _html(c("o_totalprice").cast("string"), " kB"), "Source",
            _html("<li>Uploaded via: tool/", c("c_nationkey").cast("string"), "</li>"), _provenance(sdist),
        ),
        F.when(has_wheel, _panel(wheel, _html(key, " Bytes"), "Python 3", F.lit(""), F.lit(""))).otherwise(""),
    )
    html = _html(
        "<!DOCTYPE html><html><head><title>x</title><script>var s='<div class=\"sidebar-section verified\">';</script>"
        '</head><body><h1 class="package-header__name">\n', c("package_name"), " ", c("version"),
        '\n</h1><div class="package-header__right"><a class="status-badge" href="#"><span>',
        F.when(segment == "BUILDING", "This project has been quarantined").otherwise("Latest version"),
        '</span></a></div><p class="package-header__date">Released: <time datetime="', c("stamp"),
        '">day</time></p><p class="package-description__summary"> ', _esc(_html(priority, " order <", c("version"), ">")),
        ' </p><div class="tabs">', sidebar, '</div><div class="tabs" style="display:none">', sidebar,
        '</div><div id="description"><div class="project-description">\n<p>', c("version"), " &amp; <b>", c("package_name"),
        "</b></p><div><div>x</div></div>\n</div></div>", timeline, listed, "</body></html>",
    )
    # Pages are a hundred times wider than the rows they come from: spread the narrow rows first.
    spread = view(spark, sf, "base").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
    return spread.select(
        c("o_custkey").alias("rank"), c("o_orderkey").alias("place"), c("package_name").alias("package"), "version",
        html.alias("html"),
    )


def profile_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One profile per customer: username, html. Some are challenge pages, some show no join date."""
    c = F.col
    day = _html("20", F.lpad(c("c_nationkey").cast("string"), 2, "0"), "-01-02T03:04:05+0000")
    good = _html(
        '<html><body><div class="author-profile__metadiv"><i class="fa fa-user-circle"></i><span>name</span></div>',
        _when(
            c("c_mktsegment") != "HOUSEHOLD",
            '<div class="author-profile__metadiv"><i class="fa fa-calendar-alt"></i> Joined <time datetime="', day,
            '">day</time></div>',
        ),
        "</body></html>",
    )
    challenge = F.lit("<html><head><title>Client Challenge</title></head></html>")
    return table(spark, sf, "customer").select(
        _html("Own", c("c_custkey").cast("string")).alias("username"),
        F.when(c("c_acctbal") >= 0, good).otherwise(challenge).alias("html"),
    )
