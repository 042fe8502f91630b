import pytest
from pyspark.sql import functions as F

from indexloom.plans.build import build, clean_run, extract_run, load_run
from indexloom.plans.queries import releases_per_organization, top_packages
from indexloom.session import scratch_path
from indexloom.sources.publish import LoadRefused, published_version, read_published
from indexloom.operators.keys import LOAD_ORDER
from page_samples import SIDEBAR, page, profile

# One spelling per label, so that no release lists the same label twice.
CLEAR = SIDEBAR.replace(">home<", ">Tracker<")


def tables(spark, clear=True):
    side = CLEAR if clear else SIDEBAR
    timeline = '<div class="release-timeline"><div class="release"><p class="release__version">2.0</p></div>' \
        '<div class="release"><p class="release__version">1.5 <span class="badge--danger">yanked</span></p></div></div>'
    body = lambda name: page(version_name=f"{name} 2.0", sidebar=side, timeline=timeline).replace(
        "logIndex=77", f"logIndex={sum(map(ord, name))}")
    old = lambda name: body(name).replace("logIndex=", "logIndex=9").replace("green-2.0", "green-1.5")
    candidates = spark.createDataFrame([(0, "blocked"), (1, "alpha"), (2, "beta"), (3, "gamma")], "rank long, package string")
    mains = spark.createDataFrame(
        [("blocked", "<title>Client Challenge</title>"), ("alpha", body("alpha")), ("beta", body("beta")), ("gamma", body("gamma"))],
        "package string, html string",
    )
    versions = spark.createDataFrame([("alpha", "1.5", old("alpha")), ("beta", "1.5", "<title>Client Challenge</title>")], "package string, version string, html string")
    profiles = spark.createDataFrame([("mira", profile(True))], "username string, html string")
    return candidates, mains, versions, profiles




def test_pages_to_published_tables(spark):
    root, reports = scratch_path(spark, "store"), {}
    counts = build(*tables(spark), root, "run_1", n_packages=2, reports=reports)
    assert {r.version for r in reports["skipped_versions"].collect()} >= {"1.5"}
    assert {(r.kind, r.reason) for r in reports["rejected_pages"].collect()} >= {("version", "challenge page")}
    assert {(r.entity, r.outcome) for r in reports["run"].collect()} >= {("maintainer", "backfilled")}
    assert published_version(spark, root) == "run_1"
    assert set(counts) == set(LOAD_ORDER)
    assert (counts["package"], counts["organization"], counts["release"]) == (2, 1, 3)
    assert counts["maintainer"] == 2  # one profiled, one placeholder
    assert counts["maintained_by"] == 4
    assert (counts["classifier"], counts["tagged_with"]) == (3, 9)
    assert counts["release_file"] == 6 and counts["file_hash"] == 12 and counts["attestation"] == 3
    t = {n: read_published(spark, root, n) for n in ("package", "release", "organization", "maintainer")}
    assert [(r.name, r.release_count) for r in top_packages(t).collect()] == [("alpha", 2), ("beta", 1)]
    assert [r.total_release for r in releases_per_organization(t).collect()] == [3]
    yanked = {(r.version, r.yanked) for r in t["release"].collect()}
    assert yanked == {("2.0", False), ("1.5", True)}
    assert {r.username: r.joined_at is None for r in t["maintainer"].collect()} == {"mira": False, "Otto": True}


def test_reports_are_taken_while_writing(spark):
    """Dropped, cut, backfilled and cascaded counts of a build, against what a scan of their own finds."""
    from indexloom.plans.build import run_report
    from indexloom.sources.captures import collect_pages

    candidates, mains, versions, profiles = tables(spark)
    long = mains.withColumn("html", F.when(F.col("package") == "beta", F.regexp_replace("html", "SHA256", "SHA1")).otherwise(F.col("html")))
    long = long.withColumn("html", F.regexp_replace("html", '(?s)(package-description__summary">)', "$1" + "s" * 600))
    # A classifier that is too long goes, and what refers to it follows.
    odd = long.withColumn("html", F.regexp_replace("html", "(?s)(<strong>Topic[^<]*</strong>.*?<a[^>]*>)", "$1" + "t" * 300))
    reports = {}
    counts = build(candidates, odd, versions, profiles, scratch_path(spark, "store"), "run_1", reports=reports, cascade=True)
    found = {(r.entity, r.outcome, r.reason): r.n for r in reports["run"].collect()}
    pages, _ = collect_pages(candidates, odd, versions)
    again = {(r.entity, r.outcome, r.reason): r.n for r in run_report(extract_run(pages, profiles)).collect()}
    assert {k: n for k, n in found.items() if k[1] != "cascaded"} == again
    assert {k[1] for k in again} >= {"dropped", "truncated", "backfilled"} and counts["package"] == 3
    lost = {k[0]: n for k, n in found.items() if k[1] == "cascaded"}
    assert lost["tagged_with"] >= 1 and "package" not in lost


def test_violations_stop_the_load_and_cascade_repairs_references(spark):
    from indexloom.registry import ENTITIES

    def make(n, rows):
        return spark.createDataFrame(rows, ENTITIES[n].schema())

    frames = {n: make(n, []) for n in ENTITIES}
    frames["package"] = make("package", [("p", None, None)])
    frames["release_keyword"] = make("release_keyword", [("p", "1", "k")])
    root = scratch_path(spark, "store")
    with pytest.raises(LoadRefused, match="unresolved reference"):
        load_run(frames, root, "v1")
    with pytest.raises(FileNotFoundError):
        published_version(spark, root)
    counts = load_run(frames, root, "v1", cascade=True)
    assert (counts["package"], counts["release_keyword"]) == (1, 0)
    twice = {**frames, "release_keyword": make("release_keyword", []), "package": make("package", [("p", None, None)] * 2)}
    with pytest.raises(LoadRefused, match="duplicate key"):
        load_run(twice, root, "v2")
    assert published_version(spark, root) == "v1"


def test_label_in_both_sections_is_a_duplicate_key(spark):
    from indexloom.operators.checks import entity_duplicates

    pages = spark.createDataFrame([(0, 0, "p", "2.0", page())], "rank long, place long, package string, version string, html string")
    raw = extract_run(pages, spark.createDataFrame([], "username string, html string"))
    clean, _ = clean_run(raw)
    got = [(r.entity, r.key) for r in entity_duplicates(clean).collect()]
    assert got == [("project_link", '["p","2.0","home"]')]


def test_entity_files_to_published_tables(spark, tmp_path):
    import json

    from indexloom.registry import ENTITIES
    from indexloom.sources import runs

    made = {n: [] for n in ENTITIES}
    made["package"] = [{"name": "good"}, {"name": "bad", "lifecycle_status": "lost"}]
    made["release"] = [{"package_name": "good", "version": "1.0", "created": "2024-05-06T07:08:09+0000",
                        "is_prerelease": False, "yanked": False, "summary": "s" * 520}]
    made["release_file"] = [{"package_name": "good", "version": "1.0", "filename": "g.whl", "path": "/g", "size": 12,
                             "upload_time": "2024-05-06T07:08:09.5Z", "is_trusted_publishing": True, "packagetype": "wheel"}]
    made["maintained_by"] = [{"package_name": "good", "maintainer_username": "orphan"}]
    made["maintainer"] = [{"username": "known", "joined_at": ""}]
    for run, keep in (("run_20240101T000000", 0), ("run_20240601T000000", 1)):
        (tmp_path / run).mkdir()
        for name, rows in made.items():
            (tmp_path / run / f"{name}.json").write_text(json.dumps(rows * keep), encoding="utf-8")
    latest = runs.latest_run(spark, str(tmp_path))
    assert latest == "run_20240601T000000"
    clean, verdicts = clean_run(runs.read_run(spark, f"{tmp_path}/{latest}"))
    assert [r.reason for r in verdicts["package"].rejected.collect()] == ["lifecycle_status not allowed"]
    root = scratch_path(spark, "store")
    counts = load_run(clean, root, latest)
    assert (counts["package"], counts["maintainer"], counts["maintained_by"]) == (1, 2, 1)
    release = read_published(spark, root, "release").first()
    assert release.summary == "s" * 509 + "..."
    assert read_published(spark, root, "release_file").first().size == 12


def test_cascade_compares_names_case_blind(spark):
    from indexloom.operators.keys import drop_dangling
    from indexloom.registry import ENTITIES

    frames = {n: spark.createDataFrame([], e.schema()) for n, e in ENTITIES.items()}
    frames["package"] = spark.createDataFrame([("p", None, None)], ENTITIES["package"].schema())
    frames["maintainer"] = spark.createDataFrame([("bob", None)], ENTITIES["maintainer"].schema())
    frames["maintained_by"] = spark.createDataFrame([("p", "Bob"), ("p", "eve")], ENTITIES["maintained_by"].schema())
    assert [r.maintainer_username for r in drop_dangling(frames)["maintained_by"].collect()] == ["Bob"]


def test_a_failed_version_can_be_tried_again_and_the_last_published_is_read(spark):
    import pytest

    from indexloom.sources.publish import LoadRefused, refresh

    root = scratch_path(spark, "store")
    t = {"package": spark.range(3).toDF("package_id")}
    refresh(t, root, "v9")
    with pytest.raises(LoadRefused):
        refresh(t, root, "v10", {"never": spark.range(1)})
    with pytest.raises(Exception):
        refresh({**t, "release": spark.range(1).selectExpr("raise_error('x') as c")}, root, "v10")
    refresh({"package": spark.range(5).toDF("package_id")}, root, "v10")
    assert published_version(spark, root) == "v10"
    assert read_published(spark, root, "package").count() == 5
