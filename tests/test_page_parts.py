"""Parts of pages found by one pattern built once, and file rows without the parts that are not asked for."""

from pyspark.sql import functions as F

from indexloom.functions import html as H
from indexloom.functions.text import let
from indexloom.plans import extract
from page_samples import page
from test_regions import folded

TEXTS = [
    None, "", "plain", "<li>a</li>b<li >c<li>d</lix>e", "<link>x<li>y", "<li", "a<li>b</l<li>c", "<<li>x</li><li\n>y", "<li/>a<li>b</LI></li>c",
    "<div class='release'>a<div class='x release y'>b</div><div class='release--latest'>c</div></div><div class=\"release\">d",
    "<div class='release", "<div class='a>release'>b<div class='release'>c", "<div/ class='release'>x", "t<div id='x' class = 'release'>y<h3>z</h3><h3x>",
    "<div class='pre-release'>a</div><div class='release_'>b</div><div class='re release'>c", "<div class='release-release release'>a", "<div class='\U0001f600release'>a",
]
OTHERS = [
    "<div id='x'><div id='a-1.whl'>w</div></div><div id='a-1.tar.gz'>t</div>", "<div id='x'>left open<div id='a-1.whl'>w</div>",
    f"<div id='x'>{'<div>' * 12}{'</div>' * 12}</div><div id='a-1.whl'>w</div>", "<div id='x'><div id='y'><div id='a-1.whl'>1</div></div></div><div id='a-1.whl'>2</div>",
    "<div id='x'><div <b id='a-1.whl'>w</div></div><div id='a-1.whl'>v</div>", "<div id='a-1.whl'>w<div id='a-1.tar.gz'>in</div></div><div id='x'><div id='a-1.whl'>again</div></div>",
    "<div id='x'>\x01<div id='a-1.whl'>w</div></div>", "<div id='a-1.whl' id='x'>w</div><div id='' id=a id='a-1.whl'>v</div>", "<div id='a-1.whl'>open",
    "<div id='a-1.whl\n'>n</div><div\nid = \"a-1.whl\">w</div><div id='a-1.whl>x</div>", "<div id='x'></div>",
]
NAMES = ["a-1.whl", "a-1.tar.gz"]


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def blank_pages(spark):
    return spark.createDataFrame([("p", "1", "")], "package string, version string, html string")


def test_parts_equal_the_split(spark):
    for start in (H.opening("div", "release"), rf"<h3[\s>]|{H.opening('div', 'release')}"):
        starts = lambda p: F.filter(p, lambda x: x.startswith("<"))
        got = starts(H.parts_from(F.col("t"), start.replace("<", "", 1).replace("|<", "|", 1)))
        for text, new, old in texts(spark, TEXTS).select("t", got, starts(F.split("t", f"(?={start})"))).collect():
            assert new == old, text


def test_list_items_equal_the_split(spark):
    parts = F.filter(F.split("t", r"(?=<li[\s>])"), lambda p: p.startswith("<li"))
    old = F.transform(parts, lambda p: F.substring_index(p, "</li", 1))
    got = F.transform(H.list_items(F.col("t")), lambda i: i["html"])
    for text, new, cut in texts(spark, TEXTS).select("t", got, old).collect():
        assert new == cut, text


def test_words_of_a_class_are_whole(spark):
    old = r"<div(?=[\s>/])(?=[^>]*\sclass\s*=\s*[\"'](?=[^\"']*(?<![\w-])release(?![\w-])))[^>]*>"
    for text, new, was in texts(spark, TEXTS).select("t", F.col("t").rlike(H.opening("div", "release")), F.col("t").rlike(old)).collect():
        assert new == was, text


def test_panels_within_other_elements_equal_the_fold(spark):
    kinds = F.transform(F.lit(NAMES), lambda n: F.struct(n.alias("filename"), F.lit("sdist").alias("kind")))
    label = lambda p: let(
        F.regexp_extract(F.substring_index(p, ">", 1), r"^<div(?=\s)[^>]*?\sid\s*=\s*[\"']([^\"']+)", 1),
        lambda n: F.when(n.isin(*NAMES), n),
    )
    rows = texts(spark, OTHERS).select("t", extract.file_panels(F.col("t"), kinds), folded(F.col("t"), label)).collect()
    for text, got, wanted in rows:
        assert [(r.filename, r.panel) for r in got] == [(r.label, r.html) for r in wanted], text


def test_no_pattern_is_built_for_each_row(spark):
    # split() compiles its pattern for every row; the version's own split at white space is read without a version only.
    assert "(?=<div" not in plan(extract.parse_pages(blank_pages(spark), ("yanked",)))
    assert "split(_files" not in plan(extract.with_regions(blank_pages(spark)).select(extract.file_kinds(F.col("_files"))))
    assert "(?=<li" not in plan(extract.with_regions(blank_pages(spark)).select("_claimed"))


def test_a_value_is_kept_for_its_uses_without_an_array(spark):
    row = texts(spark, ["x", None]).select(let(F.upper("t"), lambda v: F.struct(v.alias("a"), F.coalesce(v, F.lit("none")).alias("b"))))
    assert [tuple(r[0]) for r in row.collect()] == [("X", "X"), (None, "none")]
    assert "transform" not in plan(row)


def test_file_rows_hold_the_parts_asked_for(spark):
    pages = spark.createDataFrame([("p", "2.0", page())], "package string, version string, html string")
    whole = extract.parse_pages(pages, ("files",))
    for entity, parts in extract.FILE_PARTS.items():
        some = extract.parse_pages(pages, ("files",), parts)
        assert extract.entity_rows(some, entity).collect() == extract.entity_rows(whole, entity).collect()
        assert ("<tbody" in plan(some)) == (entity == "file_hash")
        assert ("Trigger Event:" in plan(some)) == (entity == "attestation")
