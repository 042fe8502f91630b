import random

import pytest
from pyspark.sql import functions as F

from indexloom.functions.text import parse_timestamp
from indexloom.operators import checks, dependencies as D, keys as keys_module
from indexloom.operators.keys import dense_ids, drop_dangling, natural_id, reference_violations, resolve, resolve_spread, unresolved
from indexloom.operators.licenses import valid_licenses
from indexloom.operators.load import bad_timestamps, load_shape
from indexloom.operators.ranking import cap_history, first_successful, keep_first, top_per_group
from indexloom.registry import ENTITIES


def make(spark, entity, rows):
    return spark.createDataFrame(rows, ENTITIES[entity].schema())


def test_keep_first_keeps_the_earliest_row(spark):
    rows = spark.createDataFrame([(3, "a", "z"), (1, "a", "x"), (2, "b", "y"), (1, "a", "w")], "place int, name string, v string")
    got = keep_first(rows, ["name"], ["place"]).collect()
    assert sorted((r.name, r.v) for r in got) == [("a", "w"), ("b", "y")]


def test_keep_first_folded_keeps_the_winning_spelling(spark):
    rows = spark.createDataFrame([(2, "Bob"), (1, "bob"), (3, "Eve")], "place int, name string")
    got = keep_first(rows, ["name"], ["place"], folded=["name"]).collect()
    assert sorted(r.name for r in got) == ["Eve", "bob"]


def test_keep_first_with_one_hot_key_equals_brute_force(spark):
    rnd = random.Random(7)
    rows = [(rnd.randrange(50), "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(40)}", rnd.randrange(9)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "place int, name string, v int").repartition(7)
    want = {}
    for place, name, v in rows:
        want[name] = min(want.get(name, (place, v)), (place, v))
    assert {r.name: (r.place, r.v) for r in keep_first(df, ["name"], ["place"]).collect()} == want


def test_cap_keeps_ten_and_the_current_one_beyond(spark):
    history = spark.createDataFrame([("p", i, f"v{i}") for i in range(15)] + [("q", i, f"v{i}") for i in range(3)], "package string, pos int, version string")
    current = spark.createDataFrame([("p", "v12"), ("q", "v1")], "package string, version string")
    got = cap_history(history, "package", [F.col("pos")], "version", current, 10).collect()
    assert sorted(r.pos for r in got if r.package == "p") == [*range(10), 12]
    assert sorted(r.pos for r in got if r.package == "q") == [0, 1, 2]


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as v")
    plan = top_per_group(df, ["k"], [F.col("v")], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_first_successful_moves_reserves_up(spark):
    candidates = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "rank int, package string")
    usable = spark.createDataFrame([("p1",), ("p3",), ("p4",), ("p5",)], "package string")
    got = first_successful(candidates, usable, "package", ["rank"], 3).collect()
    assert [r.package for r in got] == ["p1", "p3", "p4"]


def test_natural_ids_do_not_mix_parts(spark):
    rows = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("a", None)], "x string, y string")
    ids = [r[0] for r in rows.select(natural_id(F.col("x"), F.col("y"))).collect()]
    assert ids[2] is None and len(set(ids[:2])) == 2
    assert [len(part) for part in ids[0].split("-")] == [8, 4, 4, 4, 12]


def test_dense_ids_follow_key_order_over_partitions(spark):
    rnd = random.Random(3)
    keys = sorted({(rnd.choice("abc") * rnd.randrange(1, 4), str(rnd.randrange(500))) for _ in range(900)})
    shuffled = keys[:]
    rnd.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "category string, value string").repartition(5)
    got = {(r.category, r.value): r.n for r in dense_ids(df, ["category", "value"], "n").collect()}
    assert got == {k: i + 1 for i, k in enumerate(keys)}


def test_resolve_and_unresolved(spark):
    child = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("b", "1"), (None, "1")], "package_name string, version string")
    parent = spark.createDataFrame([("a", "1", "id1")], "p string, v string, release_id string")
    got = resolve(child, parent, ["package_name", "version"], ["p", "v"], "release_id").collect()
    assert sorted(str(r.release_id) for r in got) == ["None", "None", "None", "None", "id1"]
    bad = {r.key: r.n_rows for r in unresolved(child, parent, ["package_name", "version"], ["p", "v"], "e").collect()}
    assert bad == {'["a","2"]': 1, '["b","1"]': 2, '[null,"1"]': 1}


ORG = [("org", "Org")]


@pytest.mark.parametrize("owner,n", [("org", 0), ("", 0), (None, 0), ("ghost", 1)])
def test_owner_reference(spark, owner, n):
    frames = {"organization": make(spark, "organization", ORG), "package": make(spark, "package", [("p", None, owner)])}
    assert reference_violations(frames).count() == n
    shaped = load_shape(frames, "package").first()
    expected = spark.range(1).select(natural_id(F.lit("org"))).first()[0]
    assert shaped.org_id == (expected if owner == "org" else None if not owner else shaped.org_id)


def test_names_resolve_case_blind_unless_asked(spark):
    frames = {"maintainer": make(spark, "maintainer", [("bob", None)]), "maintained_by": make(spark, "maintained_by", [("p", "Bob")])}
    assert reference_violations(frames).count() == 0
    assert reference_violations(frames, fold_names=False).count() == 1
    a = load_shape(frames, "maintainer").first().maintainer_id
    assert load_shape(frames, "maintained_by").first().maintainer_id == a


def release(name, version, created="2020-01-01T00:00:00Z"):
    return (name, version, created, None, True, None, None, None, None, None)


def test_release_shape_defaults_and_stamps(spark):
    frames = {"release": make(spark, "release", [release("p", "1", "2020-01-01T02:00:00+0200")])}
    row = load_shape(frames, "release").select("*", F.unix_micros("created").alias("us")).first()
    assert (row.is_prerelease, row.yanked, row.us) == (False, True, 1577836800000000)
    assert "package_name" not in row.asDict()


def test_bad_timestamps_are_counted(spark):
    frames = {
        "release": make(spark, "release", [release("p", "1"), release("p", "2", "nope")]),
        "maintainer": make(spark, "maintainer", [("a", None), ("b", "nope")]),
    }
    got = {(r.entity, r.column): r.n_rows for r in bad_timestamps(frames).collect()}
    assert got == {("release", "created"): 1, ("maintainer", "joined_at"): 1}


def test_drop_dangling_cascades(spark):
    frames = {n: make(spark, n, []) for n in ENTITIES}
    frames["package"] = make(spark, "package", [("p", None, None), ("lost", None, "ghost")])
    frames["release"] = make(spark, "release", [release("p", "1"), release("lost", "1"), release("none", "1")])
    frames["release_keyword"] = make(spark, "release_keyword", [("p", "1", "k"), ("none", "1", "k"), ("lost", "1", "k")])
    kept = drop_dangling(frames)
    assert [r.name for r in kept["package"].collect()] == ["p"]
    assert [r.package_name for r in kept["release_keyword"].collect()] == ["p"]
    assert reference_violations(kept).count() == 0


def test_duplicate_keys_case_blind(spark):
    links = make(spark, "project_link", [("p", "1", "Home", "a", True), ("p", "1", "home", "b", False), ("p", "1", "Docs", "c", False)])
    got = checks.entity_duplicates({"project_link": links}).collect()
    assert [(r.key, r.n_rows) for r in got] == [('["p","1","home"]', 2)]


def test_three_hashes(spark):
    files = make(spark, "release_file", [("p", "1", f, "/x", 1, "t", False, None, None) for f in ("ok", "two", "none", "twice")])
    hashes = [("p", "1", "ok", a, "d") for a in ("SHA256", "MD5", "BLAKE2b-256")]
    hashes += [("p", "1", "two", a, "d") for a in ("SHA256", "MD5")] + [("p", "1", "twice", "MD5", "d")] * 3
    got = checks.incomplete_hashes(files, make(spark, "file_hash", hashes), ["package_name", "version", "filename"])
    assert {r.filename: r.n_hashes for r in got.collect()} == {"two": 2, "none": 0, "twice": 3}


def test_other_checks(spark):
    rows = spark.createDataFrame([("p", "1", False, "why"), ("p", "2", True, "why"), ("p", "3", None, None)], "package_name string, version string, yanked boolean, yanked_reason string")
    assert [r.version for r in checks.stray_yank_reasons(rows, ["package_name", "version"]).collect()] == ["1"]
    fd = spark.createDataFrame([("a", 1, None), ("a", 1, None), ("b", 1, "x"), ("b", 1, None)], "k string, u int, v string")
    assert [r.key for r in checks.broken_dependencies(fd, ["k"], ["u", "v"], "k->u,v").collect()] == ['["b"]']
    parents = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    kids = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "owner string")
    degrees = {r.degree: r.n_parents for r in checks.relationship_degree(parents, kids, "name", "owner", "e").collect()}
    assert degrees == {2: 1, 1: 1, 0: 1}
    counts = {r.name: r.n for r in checks.child_counts(parents, kids, "name", "owner", "n").collect()}
    assert counts == {"a": 2, "b": 1, "c": 0}


def test_parse_timestamp_null_stays_null(spark):
    assert spark.range(1).select(parse_timestamp(F.lit(None).cast("string"))).first()[0] is None


# ---------------------------------------------------------------- dependencies and relationships


def test_closure_and_candidate_keys():
    deps = [D.Dependency(("a",), ("b", "c")), D.Dependency(("b", "c"), ("a", "d")), D.Dependency(("d",), ("e",))]
    assert D.closure({"b", "c"}, deps) == {"a", "b", "c", "d", "e"} and D.closure({"b"}, deps) == {"b"}
    assert D.candidate_keys(["a", "b", "c", "d", "e"], deps) == [("a",), ("b", "c")]
    assert [str(d) for d in D.not_in_normal_form(["a", "b", "c", "d", "e"], deps)] == ["d->e"]
    assert D.candidate_keys(["x", "y"], []) == [("x", "y")]


def test_declared_tables_are_in_normal_form():
    columns = {"classifier": ["classifier_id", "category", "value"], "file_hash": ["release_file_id", "algorithm", "digest"], "maintained_by": ["package_id", "maintainer_id"]}
    for name, some in columns.items():
        deps = D.declared(name, some)
        assert not D.not_in_normal_form(some, deps)
        keys = D.candidate_keys(some, deps)
        assert keys == [tuple(x) for x in D.DETERMINANTS.get(name, (tuple(some),))]


def test_broken_dependencies_in_one_pass(spark):
    rows = [(1, "a", "x", "u"), (2, "b", "x", "u"), (2, "b", "y", "u"), (3, "c", None, "u"), (3, "c", "z", "u"), (4, "d", None, None), (4, "d", None, None), (5, "d", "q", "v")]
    df = spark.createDataFrame(rows, "id int, name string, value string, other string")
    deps = [D.Dependency(("id",), ("name", "value", "other")), D.Dependency(("name", "other"), ("id",)), D.Dependency(("name",), ("id",))]
    found = D.broken_dependencies(df, deps, "t")
    assert sorted((r.dependency, r.key, r.n_rows) for r in found.collect()) == [
        ("id->name,value,other", '["2"]', 2), ("id->name,value,other", '["3"]', 2), ("name->id", '["d"]', 3),
    ]
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Scan ExistingRDD") == 1 and "Expand" in plan
    assert D.broken_dependencies(df.limit(0), deps).isEmpty()


def test_cardinality_breaches(spark):
    frames = {
        "package": spark.createDataFrame([("p", None, "o"), ("q", None, "gone"), ("r", None, "")], ENTITIES["package"].schema()),
        "organization": spark.createDataFrame([("o", "O"), ("lonely", "L")], ENTITIES["organization"].schema()),
        "maintainer": spark.createDataFrame([("Bob", None)], ENTITIES["maintainer"].schema()),
        "maintained_by": spark.createDataFrame([("p", "bob"), ("p", "eve"), (None, "BOB")], ENTITIES["maintained_by"].schema()),
    }
    found = sorted(((r.edge, r.rule, r.key, r.n_rows) for r in D.cardinality_breaches(frames).collect()), key=str)
    # An owner's name may be missing, but a name that is there has to exist; a link has to name a package.
    assert found == sorted([
        ("owned_by(organization)", "child without parent", '["gone"]', 1), ("maintained_by(maintainer)", "child without parent", '["eve"]', 1),
        ("maintained_by(package)", "child without parent", None, 1),
    ], key=str)
    one = (D.Side("owned_by", "organization", "package", ("organization_owner",), total=False, least=1, most=1),)
    assert [(r.rule, r.key) for r in D.cardinality_breaches(frames, one).where("rule not like 'child%'").collect()] == [("too few children", '["lonely"]')]


def test_resolve_spreads_heavy_keys(spark, monkeypatch):
    """One value on nine rows of ten: equal to a plain join, and no task holds much more than the others."""
    children = spark.range(20_000).selectExpr("id", "if(id % 10 < 9, 'hot', concat('k', id % 500)) as k", "if(id % 7 = 0, null, 'x') as l")
    parents = spark.range(600).selectExpr("if(id = 0, 'hot', concat('k', id)) as k", "'x' as l", "id as parent_id")
    plain = sorted(map(tuple, resolve(children, parents, ["k", "l"], ["k", "l"], "parent_id").collect()), key=str)
    assert sorted(map(tuple, resolve_spread(children, parents, ["k", "l"], ["k", "l"], "parent_id").collect()), key=str) == plain
    for name, value in {"SMALL_PARENT": 10, "HEAVY_KEY": 500}.items():
        monkeypatch.setattr(keys_module, name, value)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        spread = resolve_spread(children, parents, ["k", "l"], ["k", "l"], "parent_id")
        sizes = sorted(r.n for r in spread.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())
        got = sorted(map(tuple, spread.collect()), key=str)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == plain and len(sizes) == 8 and sizes[-1] < 2 * sizes[4]
    monkeypatch.setattr(keys_module, "MAX_HEAVY", 0)
    assert sorted(map(tuple, resolve_spread(children, parents, ["k", "l"], ["k", "l"], "parent_id").collect()), key=str) == plain


def test_licenses_by_table(spark, monkeypatch):
    """Any published table decides, also where a text is on most rows and the texts are many."""
    cases = {
        "MIT": True, "mit": True, "MIT OR Own-9": True, "(MIT OR (Own-9 AND MIT)) AND Own-9": True, "Own-9+": True, "LicenseRef-x": True, "MIT WITH But": True,
        "ISC": False, "MIT)": False, "MIT OR": False, "MIT Own-9": False, "(MIT": False, "": False, "WITH MIT": False, "MIT WITH MIT": False, "But": False, None: None,
    }
    rows = [(n, text, "clash") for n, text in enumerate([*cases, *["MIT"] * 50])]
    df = spark.createDataFrame(rows, "id int, license string, valid string")
    ids = spark.createDataFrame([("MIT",), ("own-9",), ("MIT",), (None,)], "license_id string")
    want = {n: cases[text] for n, text, _ in rows}
    for small in (keys_module.SMALL_PARENT, 2):
        monkeypatch.setattr(keys_module, "SMALL_PARENT", small)
        monkeypatch.setattr(keys_module, "HEAVY_KEY", 10)
        found = valid_licenses(df, "license", ids, spark.createDataFrame([("but",)], "e string"))
        assert found.columns == ["id", "license", "valid"] and {r.id: r.valid for r in found.collect()} == want
    assert {r.valid for r in valid_licenses(df.where("license = 'MIT WITH But'"), "license", ids).collect()} == {False}
    assert valid_licenses(df.limit(0), "license", ids).isEmpty()
