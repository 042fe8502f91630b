"""Nearest vectors, url rules, the pipeline, and every registered query."""

import collections
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from indexloom.llm import ann, url_filters
from indexloom.llm.common import table
from indexloom.llm.registered import QUERIES


def exact(rows, queries, k):
    ids = sorted({i for i, v in rows})
    vec = dict(rows)
    out = {}
    for q in queries:
        s = sorted((-float(np.dot(vec[q], vec[i]) / np.linalg.norm(vec[q]) / np.linalg.norm(vec[i])), i) for i in ids if i != q)
        out[q] = s[:k]
    return out


def test_nearest_odd(spark):
    r = np.random.default_rng(2)
    rows = [(i, r.normal(size=8).tolist()) for i in range(60)] + [(100 + i, [1.0] * 8) for i in range(12)] + [(200, [2.0] * 8)]
    bad = [(300, None), (301, [0.0] * 8), (302, [1.0, None] + [0.0] * 6), (303, [float("nan")] + [1.0] * 7), (304, [float("inf")] + [1.0] * 7), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows + bad + rows[:3], "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = ann.nearest(df, df.filter("vec_id % 50 = 0"), 5).collect()
    want = exact(rows, [0, 50, 100, 200], 5)
    found = collections.defaultdict(dict)
    for x in got:
        found[x.query_id][x["rank"]] = (x.vec_id, x.score)
    assert set(found) == set(want)
    # copies of one vector: ties go to the smaller id
    assert [found[100][i][0] for i in range(1, 6)] == [101, 102, 103, 104, 105]
    assert [found[200][i][0] for i in range(1, 6)] == [100, 101, 102, 103, 104]
    hits = sum(len({i for _, i in want[q]} & {i for i, _ in found[q].values()}) for q in want)
    assert hits >= 0.9 * 20
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_nearest_splits_hot_buckets(spark, monkeypatch):
    monkeypatch.setattr(ann, "BUCKET", 3)
    monkeypatch.setattr(ann, "BLOCK", 50)
    test_nearest_odd(spark)


def test_nearest_many_equal_scores(spark, monkeypatch):
    """Multiples by powers of two score exactly alike: the smaller ids come back, however many there are."""
    r = np.random.default_rng(5)
    base = r.normal(size=12)
    rows = [(i, (base * 2.0 ** (i % 60 - 30)).tolist()) for i in range(120)] + [(1_000 + i, r.normal(size=12).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for pairs, bucket in ((ann.PAIRS, ann.BUCKET), (7, 25)):
        monkeypatch.setattr(ann, "PAIRS", pairs)
        monkeypatch.setattr(ann, "BUCKET", bucket)
        found = collections.defaultdict(list)
        for x in ann.nearest(df, df.filter("vec_id in (3, 50)"), 5).orderBy("query_id", "rank").collect():
            found[x.query_id].append(x.vec_id)
        assert found == {3: [0, 1, 2, 4, 5], 50: [0, 1, 2, 3, 4]}


@pytest.mark.parametrize("n", [1, 4, 8])
def test_nearest_few_vectors(spark, n):
    """Small tables give every query five others, or all where there are fewer."""
    r = np.random.default_rng(n)
    x = r.normal(size=(n, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {i: [] for i in range(n)}
    for row in sorted(ann.nearest(df, df).collect(), key=lambda row: row["rank"]):
        found[row.query_id].append(row.vec_id)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    for i in range(n):
        assert len(found[i]) == min(5, n - 1)
        if n <= 5:
            assert found[i] == [j for j in np.argsort(-unit @ unit[i]).tolist() if j != i]


def test_recall(spark, sf):
    vectors = table(spark, sf, "embeddings")
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in vectors.collect()]
    queries = [i for i, _ in rows if i % 50 == 0]
    want = exact(rows, queries, 5)
    hits = sum(r.vec_id in {i for _, i in want[r.query_id]} for r in ann.op1_pstable_ann(spark, sf).collect())
    assert hits >= 0.9 * 5 * len(queries)


def test_moves_in_order_of_cost():
    assert not ann.moves()[0].any() and len(ann.moves()) == ann.PROBES
    assert len({tuple(m) for m in ann.moves()}) == ann.PROBES


def test_cascade_is_exact(spark):
    keys = [f"host{i}.net/" for i in range(400)]
    rows = spark.createDataFrame([(k, i % 7 == 0) for i, k in enumerate(keys)], "key string, listed boolean")
    cascade = url_filters.Cascade(rows)
    got = {r.key: r.found for r in rows.select("key", cascade.contains(F.col("key")).alias("found")).collect()}
    assert got == {k: i % 7 == 0 for i, k in enumerate(keys)} and len(cascade.levels) > 1


def test_urls_odd(spark):
    rules = spark.createDataFrame([*url_filters.RULES, ("net/", "allow"), (None, "block"), ("x", "block"), ("a.b/", None)], "key string, verdict string")
    urls = [None, "", "no scheme", "http://", "://NET/", "http://a.net", "http://a.net/", "http://A.Example.NET/en/x?y#z", "http://xnet/", "http://example.com/de/1", "http://m.example.com/en/", "http://b.org/fr/?", "http://b.org?/fr/", "x" * 5000 + "://q.net/" + "y/" * 3000]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] * 2, "page_id long, url string, rule string")
    got = url_filters.filter_urls(df, rules).collect()
    assert len(got) == 2 * len(urls)
    verdict = {r.page_id: (r.host, r.rule, r.verdict) for r in got}
    assert verdict[0] == verdict[1] == verdict[2] == ("", None, "allow")
    assert verdict[4] == ("net", "net/", "block") and verdict[5] == ("a.net", None, "allow") and verdict[6] == ("a.net", "net/", "block")
    assert verdict[7] == ("a.example.net", "example.net/en/", "allow") and verdict[8] == ("xnet", None, "allow")
    assert verdict[9][1:] == ("example.com/de/", "block") and verdict[10][1:] == (None, "allow")
    assert verdict[11][1:] == ("org/fr/", "allow") and verdict[12][1:] == (None, "allow") and verdict[13][1:] == ("net/", "block")
    assert url_filters.filter_urls(df.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filters.filter_urls(df, rules.limit(0)).collect()} == {"allow"}


def small(spark):
    r = random.Random(4)
    text = lambda: " ".join(f"w{r.randint(0, 500)}" for _ in range(150))
    passage, copy = text(), text()
    rows = [(i, f"{text()} {passage}" if i % 10 == 0 else text(), "en", f"s{i % 3}", 1) for i in range(60)]
    rows += [(100, copy, "en", "s0", 1), (101, copy, "en", "s1", 1), (101, copy, "en", "s1", 1), (102, copy + " end", "en", None, None), (103, None, None, None, None), (104, "", "en", "s2", 0), (None, text(), "en", "s0", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_pipeline_stages(spark, tmp_path):
    docs, sf = small(spark), str(tmp_path)
    spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int").write.parquet(f"{sf}/labels.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "suffix_dedup", "mixing", "byte_bpe"]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        assert stage(spark, docs.limit(0), sf).count() == 0
        if name != "byte_bpe":
            assert out.columns == docs.columns
        rows = out.collect()
        if name == "near_duplicates":
            copies = [r for r in rows if r.doc_id in (100, 101, 102)]
            assert len(copies) == 1 and copies[0].doc_id == 100 and len(rows) == docs.count() - 3
        if name == "suffix_dedup":
            assert len(rows) == docs.count()
            before = {r.doc_id: r.text for r in docs.collect()}
            assert all(len(r.text) < len(before[r.doc_id]) - 400 for r in rows if r.doc_id is not None and r.doc_id < 60 and r.doc_id % 10 == 0)
            assert all(r.text == before[r.doc_id] for r in rows if r.doc_id is None or (r.doc_id < 60 and r.doc_id % 10))
        if name == "byte_bpe":
            assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
        docs = spark.createDataFrame(rows, out.schema)


def test_pipeline_cuts_passages_of_over_50_words(spark, tmp_path):
    """51 words below 400 bytes that two texts share go from both; 20 shared words stay."""
    r = random.Random(9)
    words = lambda n: " ".join("".join(r.choices("abcdefgh", k=r.randint(3, 7))) for _ in range(n))
    long, short = words(51), words(20)
    assert 250 < len(long) < 400
    rows = [(i, f"{words(60)} {p} {words(60)}", "en", "s0", 1) for i, p in enumerate((long, long, short, short, words(51)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    cut = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, docs, str(tmp_path)).collect()}
    assert not any(long in cut[i] for i in (0, 1)) and all(len(cut[i]) <= len(rows[i][1]) - len(long) for i in (0, 1))
    assert all(cut[i] == rows[i][1] for i in (2, 3, 4))


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if QUERIES[n][1]))
def test_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = entry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    want = sorted(con.execute(f"select {', '.join(columns)} from ({entry.oracle_sql()[name]}) t").fetchall(), key=str)
    assert got == want


def test_all_registered():
    numbers = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert numbers == {f"op{i}" for i in range(1, 14)} and "pipeline" in entry.queries()


def test_pipeline_runs(spark, sf):
    rows = corpus_pipeline.run(spark, sf)
    assert rows.filter("not round_trip").count() == 0 < rows.count()
    assert os.path.isdir(sf)
