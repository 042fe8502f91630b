"""The five questions on role tables, both forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from indexloom.plans import queries as q
from indexloom.workload.roles import Query, question_tables, view, view_sql

V = {n: f"({view_sql('q_' + n)})" for n in (
    "organization", "package", "release", "maintainer", "maintained_by", "release_file", "file_hash", "linked_package", "link",
)}
NAME = "CUSTOMER#000000042"
PART = "SUPPLIER#00000001"


def _on(fn, *names, **kw):
    return lambda spark, sf: fn(question_tables(spark, sf, *names), **kw)


def _links(fn):
    def run(spark, sf):
        return fn({"package": view(spark, sf, "q_linked_package"), "maintained_by": view(spark, sf, "q_link")})

    return run


_Q1 = ("organization", "package", "release")
_Q2 = ("package", "release", "maintainer", "maintained_by")
_Q4 = ("package", "release", "release_file", "file_hash")

_Q1_NAIVE = f"""
select p.package_id, p.name, o.display_name,
       (select count(*) from {V['release']} r where r.package_id = p.package_id) as release_count
from {V['package']} p join {V['organization']} o on p.org_id = o.organization_id
order by release_count desc, p.package_id limit 10"""
_Q1_SQL = f"""
select p.package_id, p.name, o.display_name, count(*) as release_count
from {V['package']} p join {V['organization']} o on p.org_id = o.organization_id
join {V['release']} r on r.package_id = p.package_id
group by p.package_id, p.name, o.display_name order by release_count desc, p.package_id limit 10"""
_Q2_SQL = f"""
with mb as (select * from {V['maintained_by']} x)
select r.release_id, r.version, p.name, c.maintainer_count
from {V['release']} r join {V['package']} p on r.package_id = p.package_id
join (select package_id, count(*) as maintainer_count from mb group by package_id) c on c.package_id = p.package_id
where p.package_id in (select mb.package_id from mb join {V['maintainer']} m on mb.maintainer_id = m.maintainer_id
                       where lower(m.username) like '%supplier#00000001%')"""
_Q3_SQL = f"""
select p.package_id, p.name from {V['linked_package']} p
where not exists (select 1 from {V['link']} l where l.package_id = p.package_id)"""
_Q4_SQL = f"""
select f.release_file_id, f.filename, f.path, f.size, f.upload_time, r.release_id, r.version, h.digest
from {V['package']} p join {V['release']} r on r.package_id = p.package_id
join {V['release_file']} f on f.release_id = r.release_id join {V['file_hash']} h on h.release_file_id = f.release_file_id
where upper(p.name) = '{NAME}' and h.algorithm = 'SHA256'"""
_Q5_SQL = f"""
select o.organization_id, o.display_name, count(r.release_id) as total_release
from {V['organization']} o join {V['package']} p on p.org_id = o.organization_id
left join {V['release']} r on r.package_id = p.package_id
group by o.organization_id, o.display_name"""

# Names in several spellings; the collated forms tell sharp s from ss, and not the sigmas.
_STREETS = "case {id} % 3 when 0 then 'Stra\u00dfe' when 1 then 'STRASSE' else 'strasse' end || '#' || cast({id} % 40 as {text})"
_ROADS = "case {id} % 4 when 0 then '\u039f\u03b4\u03bf\u03c2' when 1 then '\u039f\u0394\u039f\u03a3' when 2 then '\u03bf\u03b4\u03bf\u03c3' else 'Other' end || cast({id} % 100 as {text})"


def _q4_collated(spark, sf):
    t = question_tables(spark, sf, *_Q4)
    t["package"] = t["package"].withColumn("name", F.expr(_STREETS.format(id="package_id", text="string")))
    return q.package_file_digests_collated(t, "STRASSE#7")


def _q2_collated(spark, sf):
    t = question_tables(spark, sf, *_Q2)
    t["maintainer"] = t["maintainer"].withColumn("username", F.expr(_ROADS.format(id="maintainer_id", text="string")))
    return q.releases_by_maintainer_name_collated(t, "\u039f\u0394\u039f\u03a31")


_Q4_COLLATED = _Q4_SQL.replace(f"upper(p.name) = '{NAME}'", f"lower({_STREETS.format(id='p.package_id', text='varchar')}) = 'strasse#7'")
_Q2_COLLATED = _Q2_SQL.replace(
    "lower(m.username) like '%supplier#00000001%'", f"replace(lower({_ROADS.format(id='m.maintainer_id', text='varchar')}), '\u03c2', '\u03c3') like '%\u03bf\u03b4\u03bf\u03c31%'"
)

QUERIES = {
    "q2_collated": Query(_q2_collated, _Q2_COLLATED),
    "q4_collated": Query(_q4_collated, _Q4_COLLATED),
    "q1_top_packages": Query(_on(q.top_packages, *_Q1), _Q1_SQL),
    "q1_naive": Query(_on(q.top_packages_naive, *_Q1), _Q1_NAIVE),
    "q2_maintainer_like": Query(_on(q.releases_by_maintainer_name, *_Q2, part=PART), _Q2_SQL),
    "q2_naive": Query(_on(q.releases_by_maintainer_name_naive, *_Q2, part=PART), _Q2_SQL),
    "q3_no_maintainer": Query(_links(q.packages_without_maintainer), _Q3_SQL),
    "q3_not_in": Query(
        _links(q.packages_not_in_links),
        f"select p.package_id, p.name from {V['linked_package']} p where p.package_id not in (select package_id from {V['link']} l)",
    ),
    "q4_file_digest": Query(_on(q.package_file_digests, *_Q4, name=NAME), _Q4_SQL),
    "q4_upper": Query(_on(q.package_file_digests_upper, *_Q4, name=NAME), _Q4_SQL),
    "q5_releases_per_org": Query(_on(q.releases_per_organization, *_Q1), _Q5_SQL),
    "q5_naive": Query(_on(q.releases_per_organization_naive, *_Q1), _Q5_SQL),
}
