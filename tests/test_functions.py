import datetime as dt

import pytest
from pyspark.sql import functions as F

from indexloom.functions import text as X
from indexloom.functions.html import decode_references


def apply(spark, fn, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.r for r in rows.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def test_parse_size(spark):
    cases = {
        "1.2 kB": 1228, "512 Bytes": 512, "228.1 kB": 233574, "1.5 MB": 1572864, "": 0, "2 GB": 2147483648,
        " 3 KB ": 3072, "7": 7, "x kB": 0, "1.5d kB": 0, "-1.9": -1, "9 parsecs": 9,
    }
    assert apply(spark, X.parse_size, list(cases)) == list(cases.values())
    assert apply(spark, X.parse_size, [None]) == [0]


def test_parse_timestamp(spark):
    good = [
        "2020-01-02T03:04:05Z", "2020-01-02T03:04:05+0000", "2020-01-02T10:04:05+07:00", "2020-01-02T03:04:05.25Z",
    ]
    got = apply(spark, lambda c: F.unix_micros(X.parse_timestamp(c)), good)
    base = int(dt.datetime(2020, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    assert got == [base, base, base, base + 250_000]
    bad = ["", "soon", "2020-01-02", "2020-01-02 03:04:05Z", "2020-02-30T03:04:05Z", "2020-01-02T03:04:05", None]
    assert apply(spark, X.parse_timestamp, bad) == [None] * len(bad)


def test_names_types_and_case(spark):
    assert apply(spark, X.normalized_name, ["A.b__C--d", "x"]) == ["a-b-c-d", "x"]
    assert apply(spark, X.package_type, ["a.whl", "a.tar.gz", "whl"]) == ["wheel", "sdist", "sdist"]
    a, b, c, d = apply(spark, X.fold_case, ["Straße", "STRASSE", "Bob", "bob"])
    assert a == b and c == d


@pytest.mark.parametrize(
    "spec,valid",
    [
        (">=3.9", True), (">=3.8,<4", True), ("== 3.*", True), ("!=3.0.*,>=2.7", True), ("~=3.7", True), ("~=3", False),
        (">=3.7.*", False), ("3.7", False), ("", False), (">=3.6,", True), ("===anything", True), (">=1!2.0.post1", True),
    ],
)
def test_requires_python(spark, spec, valid):
    assert apply(spark, X.is_valid_requires_python, [spec]) == [valid]


def test_spdx(spark):
    cases = {
        "MIT": True, "mit": True, "MIT OR Apache-2.0": True, "(MIT OR (Apache-2.0 AND ISC)) AND BSD-3-Clause": True,
        "GPL-2.0-or-later WITH Classpath-exception-2.0": True, "Apache-2.0+": True, "LicenseRef-own.1": True,
        "(" * 12 + "MIT" + ")" * 12: True, "(MIT) OR ISC": True, "MIT)": False,
        "BSD": False, "MIT OR": False, "MIT Apache-2.0": False, "(MIT": False, "": False, "WITH MIT": False,
    }
    assert apply(spark, X.is_valid_spdx_license, list(cases)) == list(cases.values())


def test_references(spark):
    cases = {"a &lt;b&gt;": "a <b>", "&amp;lt;": "&lt;", "&#39;&#x41;": "'A", "&#99999999;": "�", "&eacute;&#00000065;": "éA", "&semi;&frac12;": ";½", "&#1114112;": "�",
             "&unknown;": "&unknown;", "&#38;amp;": "&amp;", "plain": "plain"}
    assert apply(spark, decode_references, list(cases)) == list(cases.values())


def test_strip_space_covers_unicode(spark):
    assert apply(spark, X.strip_space, [" \t a b \n"]) == ["a b"]


def test_heading_with_markup(spark):
    from indexloom.functions.html import list_after_heading

    def part(head, name):
        return f'<h6>{head}</h6> <ul class="vertical-tabs__list"><li><a href="/org/{name}/">{name}</a></li></ul>'

    text = part('<i class="fas fa-x"></i> Owner ', "first") + part("Owner", "last") + part("Owners", "other")
    df = spark.createDataFrame([(text,)], "h string").select(
        list_after_heading(F.col("h"), "Owner").alias("all"), list_after_heading(F.col("h"), "Owner", last=True).alias("last")
    )
    row = df.first()
    assert [a.text for a in row["all"]] == ["first", "last"] and [a.text for a in row["last"]] == ["last"]


def test_size_with_a_no_break_space(spark):
    assert apply(spark, X.parse_size, ["1.5\xa0kB", "(2\u2009MB)"])[0] == 1536
