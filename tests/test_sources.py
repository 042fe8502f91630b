import json
import os

import pytest
from pyspark.sql import functions as F

from indexloom.registry import ENTITIES
from indexloom.session import materialize, scratch_path
from indexloom.sources import arrays, captures, files, publish, runs
from page_samples import page, profile


def test_latest_run_is_the_greatest_name(spark, tmp_path):
    for name in ("run_20260101T000000", "run_20260723T044432", "run_20260615T120000", "zz_other"):
        (tmp_path / name).mkdir()
    (tmp_path / "run_99990101T000000").write_text("a file, not a run")
    assert runs.latest_run(spark, str(tmp_path)) == "run_20260723T044432"


def test_no_run_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        runs.latest_run(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        runs.latest_run(spark, str(tmp_path / "absent"))


def test_read_entity_fills_absent_and_drops_unknown_fields(spark, tmp_path):
    rows = [{"name": "a", "lifecycle_status": "archived", "extra": 1}, {"name": "1.0"}]
    (tmp_path / "package.json").write_text(json.dumps(rows), encoding="utf-8")
    got = runs.read_entity(spark, str(tmp_path), "package")
    assert sorted(tuple(r) for r in got.collect()) == [("1.0", None, None), ("a", "archived", None)]


def test_keys_that_look_like_numbers_stay_text(spark, tmp_path):
    rows = [{"package_name": "p", "version": v, "category": "c", "value": "v"} for v in ("1.0", "1", "01")]
    (tmp_path / "tagged_with.json").write_text(json.dumps(rows), encoding="utf-8")
    got = runs.read_entity(spark, str(tmp_path), "tagged_with")
    assert sorted(r.version for r in got.collect()) == ["01", "1", "1.0"]


def test_one_bad_cell_does_not_spoil_the_file(spark, tmp_path):
    base = {"package_name": "p", "version": "1", "path": "/x", "upload_time": "t", "is_trusted_publishing": True}
    rows = [{**base, "filename": "a", "size": 12}, {**base, "filename": "b", "size": "many"}]
    (tmp_path / "release_file.json").write_text(json.dumps(rows), encoding="utf-8")
    from indexloom.operators.cleaning import clean_entity

    verdict = clean_entity(runs.read_entity(spark, str(tmp_path), "release_file"), "release_file")
    assert [(r.filename, r.size, r.is_trusted_publishing) for r in verdict.valid.collect()] == [("a", 12, True)]
    assert [r.reason for r in verdict.rejected.collect()] == ["size unreadable"]


def test_incomplete_run_is_refused(spark, tmp_path):
    for name in ENTITIES:
        if name != "attestation":
            (tmp_path / f"{name}.json").write_text("[]", encoding="utf-8")
    assert runs.missing_entities(spark, str(tmp_path)) == ["attestation"]
    with pytest.raises(FileNotFoundError, match="attestation"):
        runs.read_run(spark, str(tmp_path))
    (tmp_path / "attestation.json").write_text("[]", encoding="utf-8")
    assert set(runs.read_run(spark, str(tmp_path))) == set(ENTITIES)


def test_run_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", None, None), ("b", "archived", "o")], ENTITIES["package"].schema())
    for fmt in ("json", "parquet"):
        runs.write_run({"package": df}, str(tmp_path), f"run_{fmt}", fmt)
    assert runs.read_entity(spark, str(tmp_path / "run_json"), "package", array=False).count() == 2
    assert spark.read.parquet(str(tmp_path / "run_parquet" / "package")).count() == 2


def test_read_latest_prunes_to_one_run(spark, tmp_path):
    spark.range(30).selectExpr("id", "concat('run_', id % 3) as run_id").write.partitionBy("run_id").parquet(str(tmp_path / "t"))
    got = runs.read_latest(spark.read.parquet(str(tmp_path / "t")), "run_id")
    assert sorted(r.id for r in got.collect()) == list(range(2, 30, 3))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


def test_run_store(spark, tmp_path):
    store, two = str(tmp_path / "store"), ("package", "organization")
    packages = spark.createDataFrame([("a", None, None), ("b", "archived", "o")], ENTITIES["package"].schema())
    owners = spark.createDataFrame([("o", "O")], ENTITIES["organization"].schema())
    with pytest.raises(FileNotFoundError):
        runs.read_stored(spark, store, "package", entities=two)
    runs.store_run({"package": packages, "organization": owners}, store, "run_1")
    runs.store_run({"package": packages.limit(1), "organization": owners.limit(0)}, store, "run_2")
    runs.store_run({"package": packages}, store, "run_3")  # not complete
    assert runs.stored_runs(spark, store, two) == ["run_1", "run_2"]
    latest = runs.read_stored(spark, store, "package", entities=two)
    assert latest.count() == 1 and runs.read_stored(spark, store, "organization", entities=two).count() == 0
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan and len(latest.inputFiles()) >= 1
    # Writing a run again replaces it and leaves the others.
    runs.store_run({"package": packages.where("name = 'b'"), "organization": owners}, store, "run_2")
    assert [r.name for r in runs.read_stored(spark, store, "package", entities=two).collect()] == ["b"]
    assert runs.read_stored(spark, store, "package", "run_1").count() == 2


HARD_TEXTS = ["plain", "}", '{"x', 'a\\"}{b', "\\", '"', "é}漢{", "", "\n", '}"{', "]},{["]


@pytest.mark.parametrize("size", [700, 5_000, 1 << 27])
@pytest.mark.parametrize("shape", ["array", "compact", "pretty", "lines"])
def test_array_is_read_in_ranges(spark, tmp_path, shape, size):
    """Braces and quotes in strings, nested objects and objects longer than a range come back whole, however the file is cut."""
    rows = [{"i": i, "s": HARD_TEXTS[i % 11] * (i % 4), "n": [None, {"k": "}"}, {"k": {"z": i}}][i % 3]} for i in range(400)]
    rows.append({"i": 400, "s": '}{"' * 3_000, "n": None})
    text = {
        "array": json.dumps(rows), "compact": json.dumps(rows, separators=(",", ":"), ensure_ascii=False), "pretty": json.dumps(rows, indent=1),
        "lines": "\n".join(map(json.dumps, rows)),
    }[shape]
    (tmp_path / "a.json").write_text(text, encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        found = arrays.array_objects(spark, str(tmp_path / "a.json"))
        got = sorted((json.loads(r.object) for r in found.collect()), key=lambda r: r["i"])
        parts = spark.read.option("lineSep", "}").text(str(tmp_path / "a.json")).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == rows and (size > 1 << 20 or parts > 4)


def test_odd_arrays(spark, tmp_path):
    for name, text, want in (("empty", "[]", []), ("none", "", []), ("cut", '[{"name":"a"},{"name":"b"', ["a", None]), ("blank", " [\n] ", [])):
        (tmp_path / f"{name}.json").write_text(text)
        got = arrays.read_array(spark, str(tmp_path / f"{name}.json"), ENTITIES["package"].schema())
        assert sorted((r.name for r in got.collect()), key=str) == sorted(want, key=str), name


def test_array_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a}", None, "x"), ('b"', "archived", None), ("c", None, None)], ENTITIES["package"].schema())
    arrays.write_array(df, str(tmp_path / "run" / "package.json"))
    text = "".join(p.read_text() for p in (tmp_path / "run" / "package.json").glob("part-*"))
    assert len(json.loads(text)) == 3
    assert sorted(map(tuple, runs.read_entity(spark, str(tmp_path / "run"), "package").collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    arrays.write_array(df.limit(0), str(tmp_path / "none"))
    assert json.loads("".join(p.read_text() for p in (tmp_path / "none").glob("part-*"))) == []


def test_missing_per_run_and_counts(spark):
    listing = spark.createDataFrame([("r1", "a"), ("r1", "b"), ("r2", "a"), ("r2", "x")], "run string, entity string")
    assert [(r.run, r.entity) for r in runs.missing_per_run(listing, "run", "entity", ["a", "b"]).collect()] == [("r2", "b")]
    got = {r.entity: r.n_rows for r in runs.row_counts({"a": listing, "b": listing.limit(1)}).collect()}
    assert got == {"a": 4, "b": 1, "total": 5}


def test_publish_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "store")
    good = {"t": spark.range(5).toDF("id"), "u": spark.range(2).toDF("id")}
    assert publish.refresh(good, root, "v1", {"none": spark.range(0)}) == {"t": 5, "u": 2}
    with pytest.raises(publish.LoadRefused, match="orphans"):
        publish.refresh({"t": spark.range(9).toDF("id")}, root, "v2", {"orphans": spark.range(3)})
    assert publish.published_version(spark, root) == "v1"
    assert not os.path.exists(f"{root}/versions/v2")

    broken = {"t": spark.range(7).toDF("id"), "u": spark.range(1).select(F.raise_error(F.lit("lost")).alias("id"))}
    with pytest.raises(Exception, match="lost"):
        publish.refresh(broken, root, "v3")
    # The first table was written, but nothing points to it.
    assert publish.published_version(spark, root) == "v1"
    assert publish.read_published(spark, root, "t").count() == 5
    publish.refresh(good, root, "v4")
    assert publish.published_version(spark, root) == "v4"


def test_two_loads_at_once(spark, tmp_path, monkeypatch):
    """Both loads see the same last entry; one gets the number, the other follows or gives up."""
    root = str(tmp_path / "store")
    good = {"t": spark.range(5).toDF("id")}
    publish.refresh(good, root, "v1")
    real, raced = files.write_text_once, []

    def beaten(session, path, text):
        if not raced:
            raced.append(path)
            real(session, path, json.dumps({"version": "other", "folder": "x", "rows": {}}))
        real(session, path, text)

    monkeypatch.setattr(files, "write_text_once", beaten)
    publish.refresh(good, root, "v2")
    assert [e["version"] for e in publish._entries(spark, root)] == ["v1", "other", "v2"]
    raced.clear()
    with pytest.raises(publish.LostRace, match="other"):
        publish.refresh(good, root, "v3", after="v2")
    assert publish.published_version(spark, root) == "other"
    with pytest.raises(FileExistsError):
        publish.refresh(good, root, "v2")


def test_unfinished_entry_is_passed_over(spark, tmp_path):
    root = str(tmp_path / "store")
    publish.refresh({"t": spark.range(5).toDF("id")}, root, "v1")
    (tmp_path / "store" / "log" / f"{2:012d}.json").write_text('{"version": "half')
    assert publish.published_version(spark, root) == "v1"
    publish.refresh({"t": spark.range(3).toDF("id")}, root, "v2")
    assert publish.published_version(spark, root) == "v2" and publish.read_published(spark, root, "t", "v1").count() == 5
    assert sorted(files.list_names(spark, f"{root}/log")) == [f"{n:012d}.json" for n in (1, 2, 3)]


def test_many_writers_of_one_file(spark, tmp_path):
    """Of threads that write one name at once exactly one succeeds, and its text is whole."""
    from concurrent.futures import ThreadPoolExecutor

    def attempt(n):
        try:
            files.write_text_once(spark, str(tmp_path / "one.json"), str(n) * 1000)
            return n
        except FileExistsError:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [n for n in pool.map(attempt, range(8)) if n is not None]
    assert len(won) == 1 and files.read_text(spark, str(tmp_path / "one.json")) == str(won[0]) * 1000


def test_manifest_is_never_replaced(spark, tmp_path):
    files.write_text_once(spark, str(tmp_path / "m.json"), "one")
    with pytest.raises(FileExistsError):
        files.write_text_once(spark, str(tmp_path / "m.json"), "two")
    assert files.read_text(spark, str(tmp_path / "m.json")) == "one"


def test_scratch_comes_from_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(root)
    assert materialize(spark.range(3), "x").count() == 3


def test_candidates(spark, tmp_path):
    path = tmp_path / "names.txt"
    path.write_text(" alpha \n\n\tbeta\n   \ngamma\n", encoding="utf-8")
    names = captures.read_candidates(spark, str(path), at_least=3).orderBy("rank").collect()
    assert [r.package for r in names] == ["alpha", "beta", "gamma"]
    with pytest.raises(ValueError):
        captures.read_candidates(spark, str(path), at_least=4)


def test_page_rejection(spark):
    rows = spark.createDataFrame(
        [(1, "<title>Client Challenge</title>", True), (2, "fine", True), (3, "fine", False)], "id int, html string, ok boolean"
    )
    got = {r.id: r.reason for r in captures.rejected_pages(rows, F.col("ok")).collect()}
    assert got == {1: "challenge page", 3: "no release history"}
    assert "html" not in captures.rejected_pages(rows, F.col("ok")).columns


def test_planned_versions_cap_and_current(spark):
    entries = [{"version": f"v{i}", "is_prerelease": False, "yanked": False, "yanked_reason": None} for i in range(14)]
    schema = "package string, current_version string, history array<struct<version:string,is_prerelease:boolean,yanked:boolean,yanked_reason:string>>"
    main = spark.createDataFrame([("inside", "v2", entries), ("beyond", "v13", entries), ("short", "v0", entries[:1])], schema)
    plan = captures.planned_versions(main, 10).orderBy("package", "place").collect()
    assert [r.version for r in plan if r.package == "inside"] == ["v2", "v0", "v1", *[f"v{i}" for i in range(3, 10)]]
    assert [r.version for r in plan if r.package == "beyond"] == ["v13", *[f"v{i}" for i in range(10)]]
    assert [(r.version, r.is_current) for r in plan if r.package == "short"] == [("v0", True)]
    assert captures.planned_versions(main).where("package = 'inside'").count() == 14


def test_profiles(spark):
    links = spark.createDataFrame([("p", "a"), ("q", "a"), ("p", "b"), ("p", "c"), ("p", "d")], ENTITIES["maintained_by"].schema())
    pages = spark.createDataFrame(
        [("a", profile(True)), ("b", profile(False)), ("c", "<title>Client Challenge</title>"), ("z", profile(True))],
        "username string, html string",
    )
    got = {r.username: r.joined_at for r in captures.profiled_maintainers(links, pages).collect()}
    assert got == {"a": "2019-03-04T05:06:07+0000", "b": None}


def test_collect_pages(spark):
    challenge = "<html><title>Client Challenge</title></html>"
    candidates = spark.createDataFrame([(0, "blocked"), (1, "one"), (2, "bare"), (3, "two"), (4, "three")], "rank long, package string")
    mains = spark.createDataFrame(
        [("blocked", challenge), ("one", page()), ("bare", "<html></html>"), ("two", page()), ("three", page())],
        "package string, html string",
    )
    versions = spark.createDataFrame(
        [("one", "3.0b1", page()), ("one", "1.5", challenge), ("two", "1.5", page()), ("three", "1.5", page()), ("one", "9.9", page())],
        "package string, version string, html string",
    )
    pages, skipped = captures.collect_pages(candidates, mains, versions, n_packages=2)
    got = sorted((r.rank, r.place, r.package, r.version) for r in pages.collect())
    # A version listed twice in the history, or captured twice, is read once.
    assert got == [(1, 0, "one", "2.0"), (1, 1, "one", "3.0b1"), (3, 0, "two", "2.0"), (3, 3, "two", "1.5")]
    again, _ = captures.collect_pages(candidates, mains.union(mains), versions.union(versions))
    assert {r.package for r in again.collect()} == {"one", "two", "three"}
    assert again.groupBy("package", "version").count().where("count > 1").isEmpty()
    assert sorted({(r.package, r.version) for r in skipped.collect()}) == [("one", "1.5"), ("two", "3.0b1")]


def test_history_decides_by_the_parsed_timeline(spark):
    item = '<div class="release"><p class="release__version">1.0</p></div>'
    cases = {
        f'<div class="release-timeline">{item}</div>': True, '<div class="release-timeline"><p>none</p></div>': False, "<html></html>": False,
        f"<p>release-timeline</p>{item}": False, f'<!-- <div class="release-timeline">{item}</div> -->': False, "": False, None: None,
    }
    rows = spark.createDataFrame([(n, text) for n, text in enumerate(cases)], "id int, html string")
    got = {r.id: r.h for r in rows.select("id", captures.has_history(F.col("html")).alias("h")).collect()}
    assert [got[n] or False for n in range(len(cases))] == [bool(v) for v in cases.values()]


def test_first_captures_leave_single_ones_in_place(spark):
    rows = [("a", 2, "<x>"), ("a", 1, "<y>"), ("a", 0, "<title>Client Challenge</title>"), ("b", 5, "<z>"), (None, 2, "<n>"), (None, 1, "<m>"), ("c", 1, "<q>"), ("c", 1, "<p>")]
    pages = spark.createDataFrame(rows, "package string, captured int, html string")
    got = sorted(((r.package, r.html) for r in captures.first_captures(pages, ["package"]).collect()), key=str)
    assert got == sorted([("a", "<y>"), ("b", "<z>"), (None, "<m>"), ("c", "<p>")], key=str)
    plain = {r.package: r.html for r in captures.first_captures(pages.drop("captured"), ["package"]).collect()}
    assert plain == {"a": "<x>", "b": "<z>", None: "<m>", "c": "<p>"}
    single = captures.first_captures(pages.where("package = 'b'"), ["package"])
    single.collect()
    final = single._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BroadcastNestedLoopJoin" not in final and captures.first_captures(pages.limit(0), ["package"]).isEmpty()
