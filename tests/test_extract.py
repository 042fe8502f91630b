import pytest
from pyspark.sql import functions as F

from indexloom.functions import html as H
from indexloom.plans.extract import entity_rows, joined_at, parse_pages
from indexloom.registry import ENTITIES
from page_samples import SIDEBAR, page, profile

PAGES = [
    ("full", 0, "2.0", page()),
    ("yanked", 1, "1.5", page()),
    ("pre", 2, "3.0b1", page(status="Latest version")),
    ("current", 3, None, page(version_name="green lib 2.0")),
    ("nohead", 4, None, page(version_name="")),
    ("plural", 5, "2.0", page(wheel_heading="Built Distributions")),
    ("other", 6, "2.0", page(wheel_heading="Odd heading")),
    ("noowner", 7, "2.0", page(sidebar=SIDEBAR.replace("Owner", "Sponsor").replace("Maintainers", "People"))),
    ("emoji", 8, "2.0", page(sidebar=SIDEBAR.replace("graphs", "gr\U0001f600phs &#x1F600; &#38;lt;"))),
    ("empty", 9, "1.0", ""),
    ("bare", 10, "1.0", "<html><body><p>hello</p></body></html>"),
]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(PAGES, "package string, rank long, version string, html string").repartition(4)


@pytest.fixture(scope="module")
def parsed(frame):
    rows = parse_pages(frame).collect()
    return {r.package: r.asDict(recursive=True) for r in rows}


def test_package_and_owner(parsed):
    assert parsed["full"]["lifecycle_status"] == "quarantined"
    assert parsed["full"]["organization"] == {"name": "green-lab", "display_name": "Green & Lab"}
    assert parsed["pre"]["lifecycle_status"] is None
    assert parsed["noowner"]["organization"] is None
    assert parsed["noowner"]["maintainers"] == []


def test_release_fields(parsed):
    p = parsed["full"]
    assert p["created"] == "2025-05-01T10:20:00+0000"
    assert p["summary"] == "Graphs & trees"
    assert p["license"] == "Apache-2.0"
    assert p["requires_python"] == "<4,>=3.10"
    assert p["description"] == '<p>Hi</p><div class="box"><div>nested</div> tail</div> &lt;end&gt;'
    assert p["author"] == {"name": "Mira M.", "email": "mira@green.example", "verified": True}
    assert p["contact"] == {"name": "Otto O.", "email": "otto@green.example", "verified": False}


def test_hidden_copy_of_the_sidebar_is_not_read_twice(parsed):
    p = parsed["full"]
    assert p["keywords"] == ["graphs", "trees"]
    assert p["extras"] == ["all", "speed"]
    assert p["maintainers"] == ["mira", "Otto"]
    assert len(p["links"]) == 3
    assert len(p["classifiers"]) == 3


def test_links_and_classifiers(parsed):
    p = parsed["full"]
    assert [(x["label"], x["url"], x["verified"]) for x in p["links"]] == [
        ("Home", "https://green.example/?a=1&b=2", True),
        ("Docs", "https://docs.green.example", False),
        ("home", "https://green.example/tracker", False),
    ]
    assert [(c["category"], c["value"]) for c in p["classifiers"]] == [
        ("License", "OSI Approved"), ("Topic", "Text :: A & B"), ("Topic", "Utilities"),
    ]


def test_history_and_enrichment(parsed):
    history = parsed["full"]["history"]
    assert [h["version"] for h in history] == ["3.0b1", "2.0", "1.5", "1.5"]
    assert [h["is_prerelease"] for h in history] == [True, False, False, False]
    assert [h["yanked"] for h in history] == [False, False, True, False]
    assert [h["yanked_reason"] for h in history] == [None, None, "Broken <wheel>", None]
    # The first entry of a version wins.
    assert (parsed["yanked"]["yanked"], parsed["yanked"]["yanked_reason"]) == (True, "Broken <wheel>")
    assert parsed["pre"]["is_prerelease"] and not parsed["full"]["is_prerelease"]
    assert (parsed["bare"]["yanked"], parsed["bare"]["is_prerelease"]) == (False, False)


def test_current_version(parsed):
    assert parsed["current"]["version"] == "2.0"
    assert parsed["nohead"]["version"] == "3.0b1"
    assert parsed["empty"]["current_version"] is None


def test_files(parsed):
    sdist, wheel, odd = parsed["full"]["files"]
    assert (sdist["filename"], sdist["packagetype"], sdist["size"]) == ("green-2.0.tar.gz", "sdist", 3584)
    assert (sdist["path"], sdist["upload_time"]) == ("/p/green-2.0.tar.gz", "2025-05-01T10:20:30+0000")
    assert sdist["is_trusted_publishing"] and sdist["uploaded_via"] == "tool/1.0 & more"
    assert sdist["wheel_tag"] is None
    assert [(h["algorithm"], h["digest"]) for h in sdist["hashes"]] == [
        ("SHA256", "aa01"), ("MD5", "bb01"), ("BLAKE2b-256", "cc01"),
    ]
    assert (wheel["packagetype"], wheel["wheel_tag"], wheel["size"]) == ("wheel", "Python 3", 1572864)
    assert not wheel["is_trusted_publishing"] and wheel["uploaded_via"] is None
    # A heading with other words leaves the kind in force; an empty tag gives none; bad sizes give 0.
    assert (odd["packagetype"], odd["wheel_tag"], odd["size"]) == ("wheel", None, 0)


def test_plural_and_unknown_headings(parsed):
    assert [f["packagetype"] for f in parsed["plural"]["files"]] == ["sdist", "wheel", "wheel"]
    assert [f["packagetype"] for f in parsed["other"]["files"]] == ["sdist", "sdist", "sdist"]


def test_attestation(parsed):
    sdist, wheel, _ = parsed["full"]["files"]
    assert wheel["attestation"] is None
    a = sdist["attestation"]
    assert a["sigstore_log_index"] == 77  # the last entry wins
    assert a["integration_time"] == "2025-05-01T10:21:00+0000"
    assert a["source_repo"] == "https://code.example/green"
    assert a["source_reference"] == "refs/tags/2.0"
    assert a["publisher_workflow"] == "pub.yml@abc"
    assert a["trigger_event"] == "push"


def test_references_and_wide_characters(parsed):
    assert parsed["emoji"]["keywords"][0] == "gr\U0001f600phs \U0001f600 &lt;"


def test_empty_pages_give_no_rows_and_no_error(parsed):
    for name in ("empty", "bare"):
        assert parsed[name]["files"] == [] and parsed[name]["links"] == []
        assert parsed[name]["summary"] is None and parsed[name]["organization"] is None


def test_entity_rows_match_the_registry(frame):
    parsed = parse_pages(frame.where("package = 'full'"))
    counts = {}
    for name in ENTITIES:
        if name != "maintainer":
            rows = entity_rows(parsed, name)
            assert tuple(rows.columns) == ENTITIES[name].names
            counts[name] = rows
    assert counts["file_hash"].count() == 4
    assert counts["release_file_tag"].count() == 1
    ordered = entity_rows(parsed, "release_keyword", ["rank"]).collect()
    assert [(r.rank, r.pos, r.keyword) for r in ordered] == [(0, 0, "graphs"), (0, 1, "trees")]


def test_profile_date(spark):
    rows = spark.createDataFrame([(profile(True),), (profile(False),), ("",)], "html string")
    got = [r[0] for r in rows.select(joined_at(F.col("html"))).collect()]
    assert got == ["2019-03-04T05:06:07+0000", None, None]


def test_unclosed_element_runs_to_the_end(spark):
    rows = spark.createDataFrame([("a<div class='k'>b<div>c</div>d",)], "t string")
    out = rows.select(H.elements(F.col("t"), "div", lambda p: p.rlike("^" + H.opening("div", "k"))).alias("e")).first()
    assert out.e == ["<div class='k'>b<div>c</div>d"]
