import pytest

from indexloom.plans import queries as q


@pytest.fixture(scope="module")
def t(spark):
    make = spark.createDataFrame
    releases = [("r%02d" % i, "p1", f"1.{i}") for i in range(3)] + [("s1", "p2", "1"), ("s2", "p2", "2"), ("n1", "p4", "1")]
    return {
        "organization": make([("o1", "Org One", "one"), ("o2", "Org Two", "two"), ("o3", "No packages", "three")], "organization_id string, display_name string, name string"),
        "package": make([("p1", "o1", "NumTree", "numtree"), ("p2", "o1", "graphs", "graphs"), ("p3", "o2", "empty", "empty"), ("p4", None, "alone", "alone")], "package_id string, org_id string, name string, name_ci string"),
        "release": make(releases, "release_id string, package_id string, version string"),
        "maintainer": make([("m1", "LibKeeper"), ("m2", "zoe")], "maintainer_id string, username string"),
        "maintained_by": make([("p1", "m1"), ("p1", "m2"), ("p2", "m2"), ("p3", "m1")], "package_id string, maintainer_id string"),
        "release_file": make([("f1", "r00", "a.whl", "/a", 1, "t"), ("f2", "s1", "b.whl", "/b", 2, "t")], "release_file_id string, release_id string, filename string, path string, size long, upload_time string"),
        "file_hash": make([("f1", "SHA256", "aa"), ("f1", "MD5", "bb"), ("f2", "SHA256", "cc")], "release_file_id string, algorithm string, digest string"),
    }


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_top_packages_forms_differ_on_packages_without_releases(t):
    assert rows(q.top_packages(t)) == [("p1", "NumTree", "Org One", 3), ("p2", "graphs", "Org One", 2)]
    assert rows(q.top_packages_naive(t)) == [
        ("p1", "NumTree", "Org One", 3), ("p2", "graphs", "Org One", 2), ("p3", "empty", "Org Two", 0),
    ]


def test_ties_at_the_limit_are_broken_by_id(spark, t):
    tied = {**t, "release": spark.createDataFrame([("x", "p2", "1"), ("y", "p1", "1")], t["release"].schema)}
    assert rows(q.top_packages(tied, 1)) == rows(q.top_packages_naive(tied, 1)) == [("p1", "NumTree", "Org One", 1)]


def test_maintainer_name_matches_case_blind_in_both_forms(t):
    want = [("r00", "1.0", "NumTree", 2), ("r01", "1.1", "NumTree", 2), ("r02", "1.2", "NumTree", 2)]
    assert rows(q.releases_by_maintainer_name(t)) == want
    assert rows(q.releases_by_maintainer_name_naive(t)) == want
    assert rows(q.releases_by_maintainer_name_naive(t, "_")) == rows(q.releases_by_maintainer_name(t, "_")) == []


def test_null_link_empties_not_in_only(spark, t):
    assert rows(q.packages_without_maintainer(t)) == rows(q.packages_not_in_links(t)) == [("p4", "alone")]
    nulls = {**t, "maintained_by": t["maintained_by"].union(spark.createDataFrame([(None, "m1")], t["maintained_by"].schema))}
    assert rows(q.packages_without_maintainer(nulls)) == [("p4", "alone")]
    assert rows(q.packages_not_in_links(nulls)) == []
    empty = {**t, "maintained_by": t["maintained_by"].limit(0)}
    assert len(rows(q.packages_not_in_links(empty))) == 4


def test_file_digests_by_name_case_blind(t):
    want = [("f1", "a.whl", "/a", 1, "t", "r00", "1.0", "aa")]
    assert rows(q.package_file_digests(t, "NUMTREE")) == want
    assert rows(q.package_file_digests_upper(t, "numtree")) == want
    assert rows(q.package_file_digests(t, "numtree", "MD5"))[0][-1] == "bb"


def test_releases_per_organization_keeps_zero(t):
    want = [("o1", "Org One", 5), ("o2", "Org Two", 0)]
    assert rows(q.releases_per_organization(t)) == want
    assert rows(q.releases_per_organization_naive(t)) == want


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(t):
    assert "TakeOrderedAndProject" in plan(q.top_packages(t))
    assert "LeftAnti" in plan(q.packages_without_maintainer(t))
    # No null-aware join, which would broadcast the link table.
    assert "NestedLoop" not in plan(q.packages_not_in_links(t))
    for fn in (q.top_packages, q.releases_by_maintainer_name, q.releases_per_organization):
        assert "Cartesian" not in plan(fn(t)) and "Python" not in plan(fn(t))


def test_collated_forms_differ_where_the_collation_does(spark):
    """Sharp s stays apart from ss under the collation, final sigma equals sigma; the folded key joins both."""
    names = ["Straße", "STRASSE", "strasse", "ΟΔΟΣ", "οδος"]
    package = spark.createDataFrame([(i, None, n, n.lower()) for i, n in enumerate(names)], "package_id int, org_id int, name string, name_ci string")
    release = spark.createDataFrame([(10 + i, i, "1") for i in range(5)], "release_id int, package_id int, version string")
    file = spark.createDataFrame([(20 + i, 10 + i, "f", "p", 1, "t") for i in range(5)], "release_file_id int, release_id int, filename string, path string, size int, upload_time string")
    file_hash = spark.createDataFrame([(20 + i, "SHA256", str(i)) for i in range(5)], "release_file_id int, algorithm string, digest string")
    t = {"package": package, "release": release, "release_file": file, "file_hash": file_hash}
    digests = lambda name, **kw: sorted(int(r.digest) for r in q.package_file_digests_collated(t, name, **kw).collect())
    assert digests("strasse") == [1, 2] and digests("STRAßE") == [0] and digests("οδοσ") == [3, 4]
    assert digests("strasse", collation="UTF8_LCASE") == [1, 2]
    t["maintainer"] = spark.createDataFrame([(i, f"x{n}y") for i, n in enumerate(names)], "maintainer_id int, username string")
    t["maintained_by"] = spark.createDataFrame([(i, i) for i in range(5)] + [(0, 1)], "package_id int, maintainer_id int")
    found = lambda part, form: sorted((r.release_id, r.maintainer_count) for r in form(t, part).collect())
    assert found("ssE", q.releases_by_maintainer_name_collated) == [(10, 2), (11, 1), (12, 1)]
    t["maintained_by"] = t["maintained_by"].where("package_id = maintainer_id")
    assert found("ssE", q.releases_by_maintainer_name_collated) == [(11, 1), (12, 1)]
    assert found("ssE", q.releases_by_maintainer_name) == [(10, 1), (11, 1), (12, 1)]
    assert found("ΔΟΣ", q.releases_by_maintainer_name_collated) == [(13, 1), (14, 1)]
