"""Elements found by one pattern against the fold over pieces, and work that is done once."""

from pyspark.sql import functions as F

from indexloom.functions import html as H
from indexloom.plans import extract
from indexloom.workload.registered import QUERIES

OPEN = '<div class="release-timeline">'
PAGES = [
    "", "<p>none</p>", f"<!DOCTYPE html>{OPEN}a<div>b</div>c</div><div id='files'>x</div>",
    f"{OPEN}left open<div>x</div>", f"{OPEN}{'<div>' * 12}deep{'</div>' * 12}</div><div id=\"files\">f</div>",
    f"<script>var s='{OPEN}'</script>{OPEN}a<!-- </div> -->b</div>", f"<!-- {OPEN} --><div id='x'>{OPEN}in</div></div>",
    f"<d<!-- -->iv class='release-timeline'>joined</div>", f"{OPEN}a</di<!-- -->v>b</div>c", f"<!-- open {OPEN}x</div>",
    "<div class='sidebar-section' <div id='files'>odd</div></div>", "<div class='a>b release-timeline'>x</div>",
    "<div/ class='release-timeline'>x</div>", "<div", f"</div>{OPEN}<divx>y</divx>z</div >t", f"<STYLE>{OPEN}</style >{OPEN}a</div>",
    "<div class='sidebar-section unverified verified'>u<div class='release-timeline'>in</div></div>", f"{OPEN}<script>x</div></script>y</div>",
]
NAMES = ["a-1.whl", "a-1.tar.gz", "q<b", "files"]
PANELS = [
    "<div id='a-1.whl'>w<div>x</div></div><div id=\"a-1\">n</div><div id='a-1.tar.gz'>t</div>", "<div id='x'><div id='a-1.whl'>w</div></div>",
    "<div id='' data id='a-1.whl'>w</div>", "<div id='a-1.whl'><div id='a-1.tar.gz'>in</div></div><div id='a-1.whl'>again", "\x01<div id='a-1.whl'>w</div>\x02",
    "<div id='q<b'>odd</div><div id='a-1.whl'>w</div>", "<!-- <div id='a-1.whl'> --><div id='a-1.whl'>w<!-- x --></div>", "<div id='a-1.whl>x</div>'>w</div>",
]


def folded(html, label):
    cut = lambda p: F.transform(H.element_spans(p, label), lambda s: F.struct(s["label"].alias("label"), H.cut(p, s).alias("html")))
    return H.let(H.pieces_by(H.without_hidden(html), "div"), cut)


def test_regions_equal_the_fold(spark):
    pages = spark.createDataFrame([(p,) for p in PAGES], "html string")
    html = F.col("html")
    for page, got, wanted in pages.select(html, extract.page_regions(html), folded(html, extract._page_label)).collect():
        assert got == wanted, page


def test_panels_equal_the_fold(spark):
    pages = spark.createDataFrame([(p, n) for p in PANELS for n in (NAMES, NAMES[:2], [])], "html string, names array<string>")
    kinds = F.transform("names", lambda n: F.struct(n.alias("filename"), F.lit("sdist").alias("kind")))
    pages = pages.withColumn("kinds", kinds)
    label = lambda p: H.let(
        F.regexp_extract(F.substring_index(p, ">", 1), r"^<div(?=\s)[^>]*?\sid\s*=\s*[\"']([^\"']+)", 1),
        lambda n: F.when((n != "") & F.array_contains("names", n), n),
    )
    for row in pages.select("html", extract.file_panels(F.col("html"), F.col("kinds")).alias("got"), folded(F.col("html"), label).alias("wanted")).collect():
        assert [(r.filename, r.panel) for r in row.got] == [(r.label, r.html) for r in row.wanted], row.html


def test_classifier_lists_equal_the_fold(spark):
    texts = ["<ul class='k'><li>a<ul><li>b</li></ul></li><li>c</li></ul>", "<b>x</b><li>a</li><li>b", "<li>a<li>b</li></li><li/>c", "<ul class='k'>open", "t<li>" * 12]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for tag, wanted, test in (("ul", lambda p: H.opens(p, "ul", "k"), H.tag_test("ul", "k")), ("li", lambda p: F.lit(True), "")):
        for text, got, fold in frame.select("t", H.elements(F.col("t"), tag, wanted, test), H.elements(F.col("t"), tag, wanted)).collect():
            assert got == fold, text


def test_a_page_is_rendered_once_where_it_is_judged(spark, sf):
    plan = QUERIES["pages_reject"].run(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Download files") == 1


def test_regions_are_found_by_pattern(spark):
    pages = spark.createDataFrame([("p", "1", "")], "package string, version string, html string")
    plan = extract.with_regions(pages).select("_timeline")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" in plan


def test_hidden_parts_by_either_pattern(spark):
    texts = PAGES + [
        "a<script>x</script>b", "<script src='<div>'>x</SCRIPT >b<script>open", "<scripts>x</script>", "<Script>x</script>y<script>z</script>",
        "<script>a<!-- b</script>c--></script>d", "<style>a<script>b</style>c</script>d", "<sTyle>a</style>b", "<strong>S</strong>!--x<span>s</span>",
    ]
    html = F.col("html")
    frame = spark.createDataFrame([(t,) for t in texts] + [(None,)], "html string")
    wanted = F.regexp_replace(html, rf"(?s)<(?=[!sS]){H._HIDDEN}", "")
    for page, got, plain in frame.select(html, H.without_hidden(html), wanted).collect():
        assert got == plain, page


def test_first_element_is_the_first_of_all(spark):
    texts = [
        "<ul class='k'>a<ul>b</ul></ul>c<ul class='k'>d</ul>", "<ul class='k'>open<ul>x</ul>", "x<ul class='k'>a</ul>", "<ul class='j'>a</ul><ul class='k'>b</ul>",
        "<ul class='a>b k'>c</ul>", "<ul class='k' <b>c</ul>", f"<ul class='k'>{'<ul>' * 12}deep{'</ul>' * 12}</ul>e", "", "<ul class='k'>a</ulx></ul >b",
    ]
    wanted = lambda p: H.opens(p, "ul", "k")
    first = H.first_element(F.col("t"), "ul", wanted, H.tag_test("ul", "k"))
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for text, got, fold in frame.select("t", first, F.get(H.elements(F.col("t"), "ul", wanted), 0)).collect():
        assert got == fold, text


def test_links_of_the_owner_and_hidden_parts_are_read_once(spark):
    pages = spark.createDataFrame([("p", "1", "")], "package string, version string, html string")
    plan = extract.parse_pages(pages, ("organization",))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("vertical") == 1
    assert plan.count("<script(?=") == 1
