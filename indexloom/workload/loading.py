"""Keys, references, load shapes, integrity checks, derived attributes and storage."""

from __future__ import annotations

from pyspark.sql import functions as F

from indexloom.functions import text as X
from indexloom.operators import checks, dependencies
from indexloom.operators.keys import LOAD_ORDER, cascade_report, dense_ids, drop_dangling, natural_id, reference_violations, resolve, resolve_spread, unresolved
from indexloom.operators.licenses import valid_licenses
from indexloom.operators.load import load_shape
from indexloom.registry import ENTITIES, Col
from indexloom.session import materialize, materialize_all, scratch_path
from indexloom.sources import arrays, publish, runs
from indexloom.workload.roles import ENTITY_VIEWS, Query, frames, frames_on_base, micros, plain, sql, table, uid, view, view_sql

# ------------------------------------------------------------------ keys and references


def _surrogate_key(spark, sf):
    rows = view(spark, sf, "release_file")
    return rows.select(
        "package_name", "version", "filename",
        natural_id(F.col("package_name"), F.col("version"), F.col("filename")).alias("release_file_id"),
    )


def _surrogate_int(spark, sf):
    pairs = table(spark, sf, "part").select(F.col("p_brand").alias("category"), F.col("p_name").alias("value")).distinct()
    return dense_ids(pairs, ["category", "value"], "classifier_id")


# Parents of the resolve queries lack some rows, so both outcomes occur.
_PARENTS = {
    "organization": "select * from ({organization}) p where name not like '%2%'",
    "package": "select * from ({package}) p where lifecycle_status is null",
    "release": "select * from ({release}) p where not is_prerelease",
    "release_file": "select * from ({release_file}) p where packagetype = 'wheel'",
    "maintainer": "select * from ({maintainer}) p",
    "classifier": "select * from ({classifier}) p where value not like 'Nation%'",
}


def _parent(spark, sf, name):
    return sql(spark, sf, _PARENTS[name].replace("{" + name + "}", ENTITY_VIEWS[name]))


def _parent_sql(name):
    return "(" + _PARENTS[name].replace("{" + name + "}", view_sql(name)) + ")"


def _resolve(child: str, ref_columns, parent: str, id_column: str, keep):
    def run(spark, sf):
        keys = list(ENTITIES[parent].key)
        owners = _parent(spark, sf, parent).select(*keys, natural_id(*[F.col(k) for k in keys]).alias(id_column))
        return (resolve_spread if parent == "classifier" else resolve)(view(spark, sf, child), owners, ref_columns, keys, id_column).select(*keep, id_column)

    return run


def _resolve_sql(child: str, ref_columns, parent: str, id_column: str, keep) -> str:
    keys = ENTITIES[parent].key
    on = " and ".join(f"c.{a} = p.{b}" for a, b in zip(ref_columns, keys))
    picked = ", ".join(f"c.{k}" for k in keep)
    return f"""
    select {picked}, case when p.{keys[0]} is not null then {uid(*[f'p.{k}' for k in keys])} end as {id_column}
    from ({view_sql(child)}) c left join {_parent_sql(parent)} p on {on}"""


def _resolved(child, ref_columns, parent, id_column, keep):
    args = (child, ref_columns, parent, id_column, keep)
    return Query(_resolve(*args), _resolve_sql(*args))


def _violations(spark, sf):
    have = frames(spark, sf, "file_hash", "maintained_by", "tagged_with", "release_extra", "package")
    for name in _PARENTS:
        have[name] = _parent(spark, sf, name)
    # Each is read by several edges.
    lines = reference_violations(materialize_all(have, "referenced"))
    return lines.groupBy("edge").agg(F.count("*").alias("n_keys"), F.sum("n_rows").alias("n_rows"))


def _edge_sql(child: str, child_sql: str, columns, parent: str, fold: bool = False, optional: bool = False) -> str:
    keys = ENTITIES[parent].key
    low = (lambda x: f"lower({x})") if fold else (lambda x: x)
    on = " and ".join(f"{low('c.' + a)} = {low('p.' + b)}" for a, b in zip(columns, keys))
    key = " || chr(1) || ".join(low("c." + a) for a in columns)
    some = f" and c.{columns[0]} <> ''" if optional else ""
    return f"""
    select '{child}->{parent}' as edge, count(distinct {key}) as n_keys, count(*) as n_rows
    from {child_sql} c where not exists (select 1 from {_parent_sql(parent)} p where {on}){some}"""


def _violations_sql() -> str:
    own = lambda n: f"({view_sql(n)})"
    rel = ("package_name", "version")
    edges = [
        _edge_sql("package", _parent_sql("package"), ("organization_owner",), "organization", optional=True),
        _edge_sql("maintained_by", own("maintained_by"), ("package_name",), "package"),
        _edge_sql("maintained_by", own("maintained_by"), ("maintainer_username",), "maintainer", fold=True),
        _edge_sql("release", _parent_sql("release"), ("package_name",), "package"),
        _edge_sql("release_file", _parent_sql("release_file"), rel, "release"),
        _edge_sql("file_hash", own("file_hash"), (*rel, "filename"), "release_file"),
        _edge_sql("tagged_with", own("tagged_with"), rel, "release"),
        _edge_sql("tagged_with", own("tagged_with"), ("category", "value"), "classifier"),
        _edge_sql("release_extra", own("release_extra"), rel, "release"),
    ]
    return "select * from (" + " union all ".join(edges) + ") e where n_rows > 0"


_DETAILS = {
    "release_detail": "release", "project_link": "release", "release_keyword": "release", "release_file_tag": "release_file",
    "attestation": "release_file",
}


def _violations_of_details(spark, sf):
    have = frames(spark, sf, *_DETAILS)
    for name in ("release", "release_file"):
        have[name] = _parent(spark, sf, name)
    lines = reference_violations(have)
    return lines.groupBy("edge").agg(F.count("*").alias("n_keys"), F.sum("n_rows").alias("n_rows"))


def _violations_of_details_sql() -> str:
    edges = [_edge_sql("release_file", _parent_sql("release_file"), ("package_name", "version"), "release")]
    for child, parent in _DETAILS.items():
        edges.append(_edge_sql(child, f"({view_sql(child)})", ENTITIES[parent].key if parent == "release_file" else ("package_name", "version"), parent))
    return "select * from (" + " union all ".join(edges) + ") e where n_rows > 0"


def _cascade(spark, sf):
    have = frames(spark, sf, "release", "release_file", "file_hash", "maintained_by")
    have |= {n: _parent(spark, sf, n) for n in ("package", "maintainer")}
    return cascade_report(have, drop_dangling(have))


def _cascade_sql() -> str:
    """Who loses rows as parents go: releases and files by their package, links by package or maintainer."""
    gone = f"not exists (select 1 from {_parent_sql('package')} p where p.name = c.package_name)"
    nobody = f"not exists (select 1 from {_parent_sql('maintainer')} m where lower(m.username) = lower(c.maintainer_username))"
    parts = [f"select '{n}' as entity, count(*) as n_rows from ({view_sql(n)}) c where {gone}" for n in ("release", "release_file", "file_hash")]
    parts.append(f"select 'maintained_by', count(*) from ({view_sql('maintained_by')}) c where {gone} or {nobody}")
    return "select * from (" + " union all ".join(parts) + ") e where n_rows > 0"


_STAMPS = """
select o_orderkey,
       case o_orderpriority
         when '1-URGENT' then replace(cast(o_orderdate as string), ' ', 'T') || 'Z'
         when '2-HIGH' then replace(cast(o_orderdate as string), ' ', 'T') || '.250+0700'
         when '3-MEDIUM' then replace(cast(o_orderdate as string), ' ', 'T') || '-03:30'
         when '4-NOT SPECIFIED' then cast(o_orderdate as string)
         else case when o_orderstatus = 'F' then null else 'soon' end end as stamp
from {orders}"""


def _parse_timestamp(spark, sf):
    return sql(spark, sf, _STAMPS).select("o_orderkey", F.unix_micros(X.parse_timestamp(F.col("stamp"))).alias("micros"))


# ------------------------------------------------------------------ load shapes

_REL = "package_name", "version"
_FIL = "package_name", "version", "filename"


def _stamp_sql(column: str) -> str:
    return f"epoch_us(cast(replace(replace({column}, '+0000', ''), 'T', ' ') as timestamp))"


def _load(entity: str, *needed: str):
    return lambda spark, sf: micros(load_shape(frames(spark, sf, entity, *needed), entity))


def _numbered() -> str:
    return f"""(select cast(row_number() over (order by category, value) as integer) as classifier_id, category, value
                from ({view_sql('classifier')}) k)"""


_LOAD_SQL = {
    "organization": f"{uid('name')} as organization_id, display_name, name",
    "maintainer": f"{uid('lower(username)')} as maintainer_id, {_stamp_sql('joined_at')} as joined_at, username",
    "package": f"""{uid('name')} as package_id,
        case when organization_owner <> '' then {uid('organization_owner')} end as org_id, lifecycle_status, name,
        lower(name) as name_ci""",
    "release": f"""{uid(*_REL)} as release_id, {uid('package_name')} as package_id, {_stamp_sql('created')} as created,
        is_prerelease, yanked, lifecycle_status, version, yanked_reason, summary, license, requires_python""",
    "release_detail": f"""{uid(*_REL)} as release_id, meta_author_email_verified, meta_maintainer_email_verified, description,
        meta_author, meta_author_email, meta_maintainer, meta_maintainer_email""",
    "release_file": f"""{uid(*_FIL)} as release_file_id, {uid(*_REL)} as release_id, size, {_stamp_sql('upload_time')} as upload_time,
        is_trusted_publishing, filename, path, uploaded_via""",
    "file_hash": f"{uid(*_FIL)} as release_file_id, algorithm, digest",
    "project_link": f"{uid(*_REL)} as release_id, label, verified, url",
    "maintained_by": f"{uid('package_name')} as package_id, {uid('lower(maintainer_username)')} as maintainer_id",
    "release_keyword": f"{uid(*_REL)} as release_id, keyword",
    "release_extra": f"{uid(*_REL)} as release_id, extra_name",
    "release_file_tag": f"{uid(*_FIL)} as release_file_id, wheel_tag",
    "attestation": f"""sigstore_log_index, {uid(*_FIL)} as release_file_id, {_stamp_sql('integration_time')} as integration_time,
        statement_type, predicate_type, subject_name, subject_digest, source_repo, source_reference, token_issuer,
        runner_environment, publisher_workflow, trigger_event""",
}


def _load_queries() -> dict[str, Query]:
    out = {f"load_{e}": Query(_load(e), f"select {s} from ({view_sql(e)}) t") for e, s in _LOAD_SQL.items()}
    out["load_classifier"] = Query(_load("classifier"), f"select * from {_numbered()} n")
    out["load_tagged_with"] = Query(
        _load("tagged_with", "classifier"),
        f"""
        select {uid('t.package_name', 't.version')} as release_id, n.classifier_id
        from ({view_sql('tagged_with')}) t join {_numbered()} n on t.category = n.category and t.value = n.value""",
    )
    return out


# ------------------------------------------------------------------ checks


def _check_fk(spark, sf):
    orders, lines, parts = (table(spark, sf, t) for t in ("orders", "lineitem", "part"))
    late = orders.where("o_orderstatus = 'O'")
    edges = [
        unresolved(lines, late, ["l_orderkey"], ["o_orderkey"], "lineitem->orders"),
        unresolved(lines, parts.where("p_size > 10"), ["l_partkey"], ["p_partkey"], "lineitem->part"),
        unresolved(orders, table(spark, sf, "customer").where("c_acctbal > 0"), ["o_custkey"], ["c_custkey"], "orders->customer"),
        unresolved(table(spark, sf, "documents"), table(spark, sf, "labels"), ["doc_id"], ["doc_id"], "documents->labels"),
    ]
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out


def _fk_sql(edge, child, column, parent, key, where):
    return f"""
    select '{edge}' as edge, '["' || cast({column} as varchar) || '"]' as key, count(*) as n_rows
    from {child} where {column} not in (select {key} from {parent} where {where}) group by {column}"""


def _check_unique(spark, sf):
    lines = checks.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], (), "lineitem")
    users = sql(spark, sf, _LINKS_CI)
    return lines.unionByName(checks.duplicate_keys(users, ["username"], ["username"], "orders"))


_LINKS_CI = "select case when o_orderstatus = 'F' then 'OWN' else 'own' end || cast(o_custkey as string) as username from {orders}"
_DOMAIN = [
    Col("o_orderkey", "long", required=True),
    Col("o_orderstatus", required=True, allowed=("O", "F")),
    Col("o_orderpriority", required=True, max_length=6, kind="identifier"),
]


def _check_domain(spark, sf):
    return checks.domain_violations(table(spark, sf, "orders"), _DOMAIN, "orders")


def _three_hashes(spark, sf):
    have = view(spark, sf, "file_hash")
    some = have.where(~((F.col("algorithm") == "MD5") & F.col("filename").contains("7")))
    return checks.incomplete_hashes(view(spark, sf, "release_file"), some, ["package_name", "version", "filename"])


def _yanked_reason(spark, sf):
    rows = view(spark, sf, "release").withColumn("yanked", F.col("yanked") & F.col("yanked_reason").contains("HIGH"))
    return checks.stray_yank_reasons(rows, ["package_name", "version"])


#: Rows that break a dependency: the same key again with another value.
_TWISTED = {
    "organization": ("name < 'c'", {"display_name": "display_name || '!'"}),
    "release_file": ("size % 10 = 0", {"size": "size + 1"}),
    "project_link": ("label = 'Docs' and version like '%7.0'", {"url": "url || 'x'"}),
    "attestation": ("sigstore_log_index % 5 = 0", {"trigger_event": "cast(null as {text})"}),
}


def _twisted_sql(name: str) -> str:
    where, change = _TWISTED[name]
    columns = ", ".join(change.get(c, c).replace("{text}", "varchar") for c in ENTITIES[name].names)
    base = f"select {', '.join(ENTITIES[name].names)} from ({view_sql(name)}) t"
    return f"{base} union all select {columns} from ({view_sql(name)}) t where {where}"


def _check_fd(spark, sf):
    """The declared dependencies of all stored tables, and two that don't hold for orders and parts."""
    made = frames(spark, sf, *ENTITIES)
    for name, (where, change) in _TWISTED.items():
        columns = [F.expr(change.get(c, c).replace("{text}", "string")).alias(c) for c in ENTITIES[name].names]
        made[name] = made[name].select(*ENTITIES[name].names).unionByName(made[name].where(where).select(*columns))
    made["_classifier_ids"] = load_shape(made, "classifier")
    tables = {n: made["_classifier_ids"] if n == "classifier" else load_shape(made, n) for n in ENTITIES if n in dependencies.DETERMINANTS}
    bad = dependencies.broken_in_tables(tables)
    for name, left, right in (("orders", ("o_custkey",), ("o_orderstatus",)), ("part", ("p_name",), ("p_brand", "p_type"))):
        bad = bad.unionByName(dependencies.broken_dependencies(table(spark, sf, name), [dependencies.Dependency(left, right)], name))
    return bad


def _check_fd_sql() -> str:
    """One grouped query per dependency."""
    parts = []
    stored = {n: f"select {s} from ({_twisted_sql(n) if n in _TWISTED else view_sql(n)}) t" for n, s in _LOAD_SQL.items()}
    stored |= {"classifier": f"select * from {_numbered()} n", "orders": "select * from orders", "part": "select * from part"}
    columns = {n: [c.strip().split(" as ")[-1].strip() for c in _split_columns(s)] for n, s in _LOAD_SQL.items()} | {"classifier": ["classifier_id", "category", "value"]}
    deps = {n: dependencies.declared(n, columns[n]) for n in dependencies.DETERMINANTS}
    deps |= {"orders": [dependencies.Dependency(("o_custkey",), ("o_orderstatus",))], "part": [dependencies.Dependency(("p_name",), ("p_brand", "p_type"))]}
    for name, found in deps.items():
        for d in found:
            key = " || '\",\"' || ".join(f"cast({c} as varchar)" for c in d.left)
            right = ", ".join(f"c{n} := {c}" for n, c in enumerate(d.right))
            parts.append(
                f"select '{name}' as entity, '{d}' as dependency, '[\"' || {key} || '\"]' as key, count(*) as n_rows "
                f"from ({stored[name]}) s group by {', '.join(d.left)} having count(distinct struct_pack({right})) > 1"
            )
    return " union all ".join(parts)


def _split_columns(select: str) -> list[str]:
    """The expressions of a select list, split at commas outside brackets."""
    out, depth = [""], 0
    for char in select:
        depth += (char == "(") - (char == ")")
        if char == "," and depth == 0:
            out.append("")
        else:
            out[-1] += char
    return out


def _cardinality(spark, sf):
    """Breaches of the eight relationships where some parents are gone and some hashes come twice."""
    have = frames(spark, sf, *ENTITIES)
    for name in ("package", "release", "classifier", "organization"):
        have[name] = _parent(spark, sf, name)
    have["file_hash"] = have["file_hash"].unionByName(have["file_hash"].where("algorithm = 'MD5' and filename like '%7.0.tar.gz'"))
    return dependencies.cardinality_breaches(have).groupBy("edge", "rule").agg(F.count("*").alias("n_keys"), F.sum("n_rows").alias("n_rows"))


def _cardinality_sql() -> str:
    gone = ("package", "release", "classifier", "organization")
    parent = lambda n: _parent_sql(n) if n in gone else f"({view_sql(n)})"
    parts = []
    for side in dependencies.SIDES:
        child = parent(side.child)
        if side.child == "file_hash":
            child = f"(select * from {child} c union all select * from {child} c where algorithm = 'MD5' and filename like '%7.0.tar.gz')"
        low = "lower" if ENTITIES[side.parent].folded else ""
        on = " and ".join(f"{low}(p.{k}) = {low}(c.{c})" for k, c in zip(ENTITIES[side.parent].key, side.columns))
        key = " || chr(1) || ".join(f"{low}(c.{c})" for c in side.columns)
        some = "" if side.total else f" and c.{side.columns[0]} <> ''"
        parts.append(
            f"select '{side}' as edge, 'child without parent' as rule, count(distinct {key}) as n_keys, count(*) as n_rows from {child} c "
            f"where not exists (select 1 from {parent(side.parent)} p where {on}){some}"
        )
        if side.most:
            keys = ", ".join(f"c.{c}" for c in side.columns)
            parts.append(
                f"select '{side}', 'too many children', count(*), cast(coalesce(sum(n), 0) as bigint) from (select count(*) as n from {child} c "
                f"where exists (select 1 from {parent(side.parent)} p where {on}) group by {keys} having count(*) > {side.most}) t"
            )
    return "select * from (" + " union all ".join(parts) + ") e where n_rows > 0"


def _degree(spark, sf):
    customer, orders, lines = (table(spark, sf, t) for t in ("customer", "orders", "lineitem"))
    supplier, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    edges = [
        checks.relationship_degree(customer, orders, "c_custkey", "o_custkey", "has"),
        checks.relationship_degree(nation, customer, "n_nationkey", "c_nationkey", "owned_by"),
        checks.relationship_degree(orders, lines, "o_orderkey", "l_orderkey", "distributes"),
        checks.relationship_degree(supplier, lines, "s_suppkey", "l_suppkey", "maintained_by"),
    ]
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out


def _degree_sql(edge, parent, key, child, fk):
    return f"""
    select '{edge}' as edge, degree, count(*) as n_parents from (
      select {key}, count({fk}) as degree from {parent} left join {child} on {key} = {fk} group by {key}) t group by degree"""


# ------------------------------------------------------------------ derived attributes


def _normalized(spark, sf):
    name = F.concat_ws("._-", F.col("p_brand"), F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", X.normalized_name(name).alias("normalized_name"))


def _owned(spark, sf):
    owned = table(spark, sf, "customer")
    rows = checks.child_counts(table(spark, sf, "nation"), owned, "n_nationkey", "c_nationkey", "owned_project_count")
    return rows.select("n_name", "owned_project_count")


def _maintained(spark, sf):
    links = view(spark, sf, "q_maintained_by")
    rows = checks.child_counts(table(spark, sf, "supplier"), links, "s_suppkey", "maintainer_id", "maintained_project_count")
    return rows.select("s_suppkey", "maintained_project_count")


def _packagetype(spark, sf):
    return view(spark, sf, "release_file").select("filename", X.package_type(F.col("filename")).alias("packagetype"))


_SPECS = """
select o_orderkey, case o_orderpriority
   when '1-URGENT' then '>=3.' || cast(o_custkey as string) || ',<4'
   when '2-HIGH' then '~=' || cast(o_custkey as string)
   when '3-MEDIUM' then '== 3.*, !=3.' || cast(o_custkey as string) || 'rc1'
   when '4-NOT SPECIFIED' then 'Python ' || cast(o_custkey as string) end as spec from {orders}"""

_LICENSES = """
select o_orderkey, case o_orderpriority
   when '1-URGENT' then 'MIT' when '2-HIGH' then '(Apache-2.0 OR BSD-3-Clause) AND LicenseRef-' || cast(o_custkey as string)
   when '3-MEDIUM' then 'BSD' when '4-NOT SPECIFIED' then 'MIT AND ' || o_orderstatus end as license from {orders}"""


# What the SQL side needs of both grammars for the texts above.
_NUM = r"[0-9]+(\.[0-9]+)*"
_ID = r"(MIT|Apache-2\.0|BSD-3-Clause|LicenseRef-[A-Za-z0-9.-]+)"
_GROUP = rf"({_ID}|\({_ID}( (AND|OR) {_ID})*\))"


def _requires(spark, sf):
    return sql(spark, sf, _SPECS).select("o_orderkey", X.is_valid_requires_python(F.col("spec")).alias("valid"))


def _spdx(spark, sf):
    return sql(spark, sf, _LICENSES).select("o_orderkey", X.is_valid_spdx_license(F.col("license")).alias("valid"))


# Market segments as licences, all but one of them listed; nations as exceptions.
_LICENSED = """
select o_orderkey, c_mktsegment, n_name, o_orderpriority, case o_orderpriority
   when '1-URGENT' then c_mktsegment
   when '2-HIGH' then lower(c_mktsegment) || '+ OR (Building AND ' || c_mktsegment || ')'
   when '3-MEDIUM' then '(' || c_mktsegment || ' WITH ' || replace(n_name, ' ', '-') || ')'
   when '4-NOT SPECIFIED' then c_mktsegment || ' AND' end as license
from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey"""


def _license_table(spark, sf):
    segments = table(spark, sf, "customer").select("c_mktsegment").where("c_mktsegment <> 'MACHINERY'")
    nations = table(spark, sf, "nation").where("n_nationkey % 2 = 0").select(F.replace("n_name", F.lit(" "), F.lit("-")))
    rows = sql(spark, sf, _LICENSED).select("o_orderkey", "license")
    return valid_licenses(rows, "license", segments, nations).select("o_orderkey", "valid")


# ------------------------------------------------------------------ sources and sinks


def _read_entity(spark, sf):
    """Write releases as one JSON array, read it back in byte ranges as entity text fields."""
    path = scratch_path(spark, "entity")
    arrays.write_array(view(spark, sf, "release"), f"{path}/release.json")
    back = runs.read_entity(spark, path, "release")
    return back.select("package_name", "version", "is_prerelease", "yanked", "lifecycle_status", "yanked_reason", "summary", "requires_python")


def _latest_run(spark, sf):
    """Events by day as runs of a store; the latest is one partition."""
    days = table(spark, sf, "events").select(
        "event_id", "event_type", "value", F.concat(F.lit("run_"), F.date_format("ts", "yyyyMMdd")).alias(runs.RUN_COLUMN)
    )
    store = scratch_path(spark, "runs")
    days.write.partitionBy(runs.RUN_COLUMN).parquet(f"{store}/events")
    schema = days.drop(runs.RUN_COLUMN).schema
    return runs.read_stored(spark, store, "events", schema=schema, entities=("events",)).select("run_id", "event_id", "event_type", "value")


def _completeness(spark, sf):
    hours = table(spark, sf, "events").select(F.date_format("ts", "yyyyMMddHH").alias("run"), F.col("event_type").alias("entity"))
    return runs.missing_per_run(hours, "run", "entity", ["view", "purchase", "click", "signup", "error", "refund"])


def _sink_entities(spark, sf):
    """All entities of two runs into a store, the second written again; what the latest run holds."""
    made = frames(spark, sf, *ENTITIES)
    store = scratch_path(spark, "store")
    runs.store_run({n: df.limit(0) for n, df in made.items()}, store, "run_1")
    for name, df in made.items():
        runs.store_run({name: df}, store, "run_2")
    runs.store_run({"package": made["package"]}, store, "run_2")
    runs.store_run({"package": made["package"]}, store, "run_3")  # incomplete: not the latest run
    return runs.row_counts({n: runs.read_stored(spark, store, n) for n in made})


#: Role views made by a distinct or a join; all others come row by row from the joined orders.
_SHUFFLED = ("organization", "package", "maintainer", "maintained_by", "classifier")


def _packed(df, column: str):
    """An id column for counting: the 16 bytes that an id's text stands for, any other text behind a longer mark."""
    value = F.col(column)
    if df.schema[column].dataType.typeName() != "string":
        return value
    is_id = value.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\\z")
    other = F.encode(F.concat(F.lit("not of 16 bytes: "), value), "UTF-8")
    return F.when(is_id, F.unhex(F.replace(value, F.lit("-"), F.lit("")))).otherwise(other)


def _full_refresh(spark, sf):
    """Fifteen tables checked, published over an earlier version and read back: (entity, n_rows, n_ids)."""
    made = frames_on_base(spark, sf, *ENTITIES)
    # Only views that are a shuffle's result are worth writing; the others are read off the joined rows each time.
    made |= materialize_all({n: made[n] for n in _SHUFFLED}, "refresh")
    root = scratch_path(spark, "store")
    made["_classifier_ids"] = materialize(load_shape(made, "classifier"), "classifier-ids")
    tables = {n: made["_classifier_ids"] if n == "classifier" else load_shape(made, n) for n in LOAD_ORDER}
    publish.refresh({n: t.limit(0) for n, t in tables.items()}, root, "v0")
    checked = {n: df for n, df in made.items() if n != "maintainer" and n in ENTITIES}  # some links have no profile here
    publish.refresh(tables, root, "v1", {"reference": reference_violations(checked)}, after="v0")
    lines = None
    for name in LOAD_ORDER:
        back = publish.read_published(spark, root, name)
        line = back.agg(F.count("*").alias("n_rows"), F.countDistinct(_packed(back, back.columns[0])).alias("n_ids")).select(F.lit(name).alias("entity"), "n_rows", "n_ids")
        lines = line if lines is None else lines.unionByName(line)
    return lines


def _row_counts(spark, sf):
    names = ("nation", "customer", "orders", "lineitem", "supplier", "part", "documents", "pages")
    return runs.row_counts({n: table(spark, sf, n) for n in names})


_COUNTED = ("nation", "customer", "orders", "lineitem", "supplier", "part", "documents", "pages")
_COUNTS = " union all ".join(f"select '{n}' as entity, count(*) as n_rows from {n}" for n in _COUNTED)
_SUNK = " union all ".join(f"select '{n}' as entity, count(*) as n_rows from ({view_sql(n)}) t" for n in ENTITIES)
#: What the first column of each stored table identifies, as natural key columns.
_FIRST = {n: e.key for n, e in ENTITIES.items()} | {
    **dict.fromkeys(("project_link", "tagged_with", "release_keyword", "release_extra"), _REL), "maintained_by": ("package_name",),
    **dict.fromkeys(("file_hash", "release_file_tag"), _FIL), "maintainer": ("lower(username)",),
}
_REFRESHED = " union all ".join(
    f"select '{n}' as entity, count(*) as n_rows, count(distinct concat_ws(chr(1), {', '.join(f'cast({k} as varchar)' for k in keys)})) as n_ids from ({view_sql(n)}) t"
    for n, keys in _FIRST.items()
)

QUERIES = {
    "surrogate_key": Query(
        _surrogate_key,
        f"select package_name, version, filename, {uid(*_FIL)} as release_file_id from ({view_sql('release_file')}) f",
    ),
    "surrogate_int": Query(
        _surrogate_int,
        """
        select category, value, row_number() over (order by category, value) as classifier_id
        from (select distinct p_brand as category, p_name as value from part) t""",
    ),
    "resolve_org": _resolved("package", ("organization_owner",), "organization", "org_id", ("name", "organization_owner")),
    "resolve_package": _resolved("release", ("package_name",), "package", "package_id", _REL),
    "resolve_release": _resolved("release_keyword", _REL, "release", "release_id", (*_REL, "keyword")),
    "resolve_file": _resolved("file_hash", _FIL, "release_file", "release_file_id", (*_FIL, "digest")),
    "resolve_maintainer": _resolved(
        "maintained_by", ("maintainer_username",), "maintainer", "maintainer_id", ("package_name", "maintainer_username")
    ),
    "resolve_classifier": _resolved(
        "tagged_with", ("category", "value"), "classifier", "classifier_id", (*_REL, "category", "value")
    ),
    "fk_violations": Query(_violations, _violations_sql()),
    "fk_violations_details": Query(_violations_of_details, _violations_of_details_sql()),
    "cascade_report": Query(_cascade, _cascade_sql()),
    "parse_timestamp": Query(
        _parse_timestamp,
        """
        select o_orderkey, case o_orderpriority when '1-URGENT' then epoch_us(o_orderdate)
               when '2-HIGH' then epoch_us(o_orderdate) + 250000 - 25200000000
               when '3-MEDIUM' then epoch_us(o_orderdate) + 12600000000 end as micros from orders""",
    ),
    **_load_queries(),
    "check_fk": Query(
        _check_fk,
        " union all ".join(
            [
                _fk_sql("lineitem->orders", "lineitem", "l_orderkey", "orders", "o_orderkey", "o_orderstatus = 'O'"),
                _fk_sql("lineitem->part", "lineitem", "l_partkey", "part", "p_partkey", "p_size > 10"),
                _fk_sql("orders->customer", "orders", "o_custkey", "customer", "c_custkey", "c_acctbal > 0"),
                _fk_sql("documents->labels", "documents", "doc_id", "labels", "doc_id", "true"),
            ]
        ),
    ),
    "check_unique": Query(
        _check_unique,
        f"""
        select 'lineitem' as entity, '["' || l_orderkey || '","' || l_linenumber || '"]' as key, count(*) as n_rows
        from lineitem group by l_orderkey, l_linenumber having count(*) > 1
        union all
        select 'orders', '["' || lower(username) || '"]', count(*) from ({plain(_LINKS_CI)}) u
        group by lower(username) having count(*) > 1""",
    ),
    "check_domain": Query(
        _check_domain,
        """
        select 'orders' as entity, 'o_orderkey missing' as rule, count(*) filter (where o_orderkey is null) as n_rows from orders
        union all select 'orders', 'o_orderstatus missing', count(*) filter (where o_orderstatus is null or o_orderstatus = '') from orders
        union all select 'orders', 'o_orderstatus not allowed', count(*) filter (where o_orderstatus not in ('O', 'F')) from orders
        union all select 'orders', 'o_orderpriority missing', count(*) filter (where coalesce(o_orderpriority, '') = '') from orders
        union all select 'orders', 'o_orderpriority too long', count(*) filter (where length(o_orderpriority) > 6) from orders""",
    ),
    "check_three_hashes": Query(
        _three_hashes,
        f"""
        select package_name, version, filename, cast(2 as bigint) as n_hashes
        from ({view_sql('release_file')}) f where contains(filename, '7')""",
    ),
    "check_yanked_reason": Query(
        _yanked_reason,
        f"""
        select package_name, version, yanked_reason from ({view_sql('release')}) r
        where yanked_reason is not null and not contains(yanked_reason, 'HIGH')""",
    ),
    "check_fd": Query(_check_fd, _check_fd_sql()),
    "relationship_cardinality": Query(_cardinality, _cardinality_sql()),
    "relationship_degree": Query(
        _degree,
        " union all ".join(
            [
                _degree_sql("has", "customer", "c_custkey", "orders", "o_custkey"),
                _degree_sql("owned_by", "nation", "n_nationkey", "customer", "c_nationkey"),
                _degree_sql("distributes", "orders", "o_orderkey", "lineitem", "l_orderkey"),
                _degree_sql("maintained_by", "supplier", "s_suppkey", "lineitem", "l_suppkey"),
            ]
        ),
    ),
    "normalized_name": Query(
        _normalized,
        r"""
        select p_partkey, lower(regexp_replace(p_brand || '._-' || p_name, '[-_.]+', '-', 'g')) as normalized_name from part""",
    ),
    "owned_project_count": Query(
        _owned,
        """
        select n_name, count(c_custkey) as owned_project_count
        from nation left join customer on c_nationkey = n_nationkey group by n_name""",
    ),
    "maintained_project_count": Query(
        _maintained,
        f"""
        select s_suppkey, count(package_id) as maintained_project_count
        from supplier left join ({view_sql('q_maintained_by')}) m on maintainer_id = s_suppkey group by s_suppkey""",
    ),
    "packagetype": Query(
        _packagetype,
        f"select filename, case when filename like '%.whl' then 'wheel' else 'sdist' end as packagetype from ({view_sql('release_file')}) f",
    ),
    "is_valid_requires_python": Query(
        _requires,
        rf"""
        select o_orderkey, list_bool_and(list_transform(string_split(spec, ','), lambda c: regexp_full_match(trim(c),
               '(==|!=) *{_NUM}(\.\*|rc[0-9]+)?|~= *[0-9]+(\.[0-9]+)+|(<=|>=|<|>) *{_NUM}'))) as valid
        from ({plain(_SPECS)}) s""",
    ),
    "is_valid_spdx_license": Query(
        _spdx,
        f"""
        select o_orderkey, regexp_full_match(license, '{_GROUP}( (AND|OR) {_GROUP})*') as valid
        from ({plain(_LICENSES)}) s""",
    ),
    "spdx_license_table": Query(
        _license_table,
        f"""
        with l as ({plain(_LICENSED)}), even as (select replace(n_name, ' ', '-') as n from nation where n_nationkey % 2 = 0)
        select o_orderkey, case when license is null then null when o_orderpriority = '4-NOT SPECIFIED' then false
               else c_mktsegment <> 'MACHINERY' and (o_orderpriority <> '3-MEDIUM' or lower(replace(n_name, ' ', '-')) in (select lower(n) from even)) end as valid
        from l""",
    ),
    "src_read_entity": Query(
        _read_entity,
        f"""
        select package_name, version, cast(is_prerelease as varchar) as is_prerelease, cast(yanked as varchar) as yanked,
               lifecycle_status, yanked_reason, summary, requires_python from ({view_sql('release')}) r""",
    ),
    "src_latest_run": Query(
        _latest_run,
        """
        select 'run_' || strftime(ts, '%Y%m%d') as run_id, event_id, event_type, value from events
        where strftime(ts, '%Y%m%d') = (select max(strftime(ts, '%Y%m%d')) from events)""",
    ),
    "src_completeness": Query(
        _completeness,
        """
        with r as (select distinct strftime(ts, '%Y%m%d%H') as run from events),
        w as (select unnest(['view', 'purchase', 'click', 'signup', 'error', 'refund']) as entity)
        select run, entity from r, w
        where not exists (select 1 from events where strftime(ts, '%Y%m%d%H') = run and event_type = entity)""",
    ),
    "sink_entities": Query(
        _sink_entities, f"{_SUNK} union all select 'total', cast(sum(n_rows) as bigint) from ({_SUNK}) s"
    ),
    "sink_full_refresh": Query(_full_refresh, _REFRESHED),
    "load_row_counts": Query(
        _row_counts, f"{_COUNTS} union all select 'total', cast(sum(n_rows) as bigint) from ({_COUNTS}) s"
    ),
}
