"""Operators over documents against brute force: odd rows, and a whole small table."""

import collections
import hashlib
import math
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from indexloom.llm import byte_bpe, language_model, mixing, near_dup, quality, quality_rules, suffix_dedup, toxicity
from indexloom.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def prose(seed, n, size=400):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(1, 7))) for _ in range(n)) if n < size else " ".join(
        f"w{r.randint(0, 300)}" for _ in range(n))


def odd_rows():
    """Nulls, empty, blank, short, very long, tied and repeated rows."""
    long = prose(1, 20_000)
    base = prose(2, 300)
    near = base.replace(" ", "  ", 3) + " extra"
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1), (3, near, "de", None, None), (4, None, None, None, None),
        (5, "", "en", "b", 0), (6, " \n\t ", "en", "b", 4), (7, "one", "fr", "b", 3), (8, "one", "fr", "c", 3), (None, base, "en", "c", 1),
        (9, long, "en", "c", 5), (10, "Ünï 'cödé' it's 1½ 漢字 \U0001f600  \n\n x", "es", "d", 9), (11, "two words", None, "a", 2), (12, prose(3, 90) + "\n" + base[:900], "en", "a", 1),
    ]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return table(spark, sf, "documents")


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---------------------------------------------------------------- repeated passages


def without_repeats(texts, length):
    seen = collections.Counter()
    data = [(t or "").encode() for t in texts]
    for b in data:
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for b in data:
        hit = [False] * len(b)
        last = 0
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                hit[max(i, last) : i + length] = [True] * (i + length - max(i, last))
                last = i + length
        kept = bytes(x for x, h in zip(b, hit) if not h)
        runs = sum(h and (i == 0 or not hit[i - 1]) for i, h in enumerate(hit))
        out.append((len(b), sum(hit), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check_repeats(frame):
    rows = frame.select("doc_id", "text").collect()
    want = collections.Counter((r.doc_id, *x) for r, x in zip(rows, without_repeats([r.text for r in rows], suffix_dedup.LENGTH)))
    got = suffix_dedup.remove_repeats(frame).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert collections.Counter(map(tuple, got)) == want


def test_repeats_odd(odd):
    check_repeats(odd)


def test_repeats_whole_table(docs):
    check_repeats(docs)


def test_repeats_salted_groups(spark, monkeypatch):
    """Many different contexts of one passage, dealt over salts."""
    passage = prose(5, 100)
    rows = [(i, f"{prose(100 + i, 30)} {passage} {prose(900 + i, 30 + i % 7)}", "en", "a", 1) for i in range(24)]
    monkeypatch.setattr(suffix_dedup, "GROUP", 4)
    monkeypatch.setattr(suffix_dedup, "WINDOWS", 700)
    check_repeats(spark.createDataFrame(rows, SCHEMA))


@pytest.mark.parametrize("length", [40, 250])
def test_repeats_of_another_length(spark, monkeypatch, length):
    """Passages a little shorter and longer than asked for, plain and over salts."""
    rows = [(i, f"{prose(300 + i, 40)} {prose(6, 200)[: length + i % 5 - 2]}|{prose(700 + i, 20 + i % 7)}", "en", "a", 1) for i in range(24)]
    rows += [(i, prose(40 + i // 2, 60), "en", "a", 1) for i in range(30, 34)]
    monkeypatch.setattr(suffix_dedup, "GROUP", 4)
    frame = spark.createDataFrame(rows, SCHEMA)
    want = collections.Counter((r[0], *x) for r, x in zip(rows, without_repeats([r[1] for r in rows], length)))
    got = suffix_dedup.remove_repeats(frame, length=length).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert collections.Counter(map(tuple, got)) == want


def test_repeats_shape(spark, odd):
    cut = suffix_dedup.remove_repeats(odd.withColumn("n_bytes", F.lit("clash")))
    assert cut.columns == ["doc_id", "lang", "source", "n_chars", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert {r.doc_id: r.text for r in cut.collect()}[4] is None
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_suffix_sort_is_order_of_bytes():
    import numpy as np

    raw = np.frombuffer((prose(8, 200) * 2).encode(), np.uint8)
    starts = np.arange(0, len(raw) - suffix_dedup.LENGTH, 7)
    order = suffix_dedup.suffix_sort(raw, suffix_dedup.Prefixes(raw), starts, starts % 3)
    data = raw.tobytes()
    keys = [(s % 3, data[s : s + suffix_dedup.LENGTH]) for s in starts[order]]
    assert keys == sorted(keys)


# ---------------------------------------------------------------- near-duplicates


def linked(rows, words, percent):
    sets = []
    for _, text in rows:
        w = WORD.findall(lower(text or ""))
        n = min(words, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    name = {i: r[0] for i, r in enumerate(rows)}
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            same_id = name[i] == name[j] and a and b
            if name[i] is not None and name[j] is not None and ((a and b and 100 * len(a & b) >= percent * len(a | b)) or same_id):
                group[root(i)] = root(j)
    least = {}
    for i in range(len(rows)):
        if name[i] is not None:
            least[root(i)] = min(least.get(root(i), name[i]), name[i])
    out = collections.Counter()
    for i, (doc, _) in enumerate(rows):
        c = least[root(i)] if doc is not None else None
        out[doc, len(sets[i]), c, doc is None or c == doc] += 1
    return out


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_near_duplicates(odd, docs, words, percent):
    for frame in (odd, docs):
        rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
        got = near_dup.near_duplicates(frame.withColumn("component_id", F.lit("clash")), words, percent).collect()
        assert collections.Counter(map(tuple, got)) == linked(rows, words, percent)


def test_near_duplicates_chain(spark):
    """A chain in which neighbours are linked and the ends are not: no star has all of it."""
    words = [f"w{i}" for i in range(160)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 60]), "en", "a", 1) for i in range(20)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA), 3, 85).collect()
    assert collections.Counter(map(tuple, got)) == linked([r[:2] for r in rows], 3, 85)


def test_near_duplicates_empty(spark):
    assert near_dup.near_duplicates(empty(spark)).count() == 0


def test_similarity_estimate():
    import numpy as np

    codes = np.random.default_rng(3).integers(0, 1 << 63, 3000).astype(np.uint64)
    sets = np.concatenate([codes[:2000], codes[200:2200]])
    s = near_dup.sketch(sets, np.array([0, 2000, 4000]))
    n = np.array([2000.0])
    assert abs(near_dup.similarity(s[:1], s[1:], n, n)[0] - 1800 / 2200) < 0.15
    merged = near_dup.sketch(np.unique(sets), np.array([0, 2200]))
    assert (np.maximum(s[0], s[1]) == merged[0]).all()


# ---------------------------------------------------------------- tokens


@pytest.fixture(scope="module")
def reference_encoding():
    import base64

    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return path, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(spark, odd, docs, reference_encoding):
    path, encoding = reference_encoding
    for frame in (odd.withColumn("ids", F.lit("clash")), docs):
        got = byte_bpe.encode(frame, path).collect()
        assert len(got) == frame.count()
        for r in got:
            data = (r.text or "").encode()
            assert r.ids == encoding.encode_ordinary(r.text or "")
            ends = [*r.offsets[1:], len(data)] if r.ids else []
            assert [data[a:b] for a, b in zip(r.offsets, ends)] == [encoding.decode_single_token_bytes(i) for i in r.ids]
        decoded = byte_bpe.decode(byte_bpe.encode(frame, path), path).collect()
        assert all(bytes(r.decoded) == (r.text or "").encode() for r in decoded)
    assert byte_bpe.encode(empty(spark), path).count() == 0


def test_bpe_random_text(reference_encoding):
    path, encoding = reference_encoding
    r = random.Random(3)
    parts = [*" '\n\t\r\x0b\x0c\x1c\x85　abstrevmldSTRé漢字1２½,.!?-’\U0001f600", "'re", "'ve", "'ll", "'s", " 's", "  ", "the "]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(3000)] + ["x" * 5000, "ab" * 3000]
    tokenizer = byte_bpe.Tokenizer(byte_bpe._load(path))
    ids, _ = tokenizer.encode(pa.array(texts))
    assert ids.to_pylist() == [encoding.encode_ordinary(t) for t in texts]


# ---------------------------------------------------------------- language model


def test_language_model(spark, odd, docs):
    for frame in (odd.dropDuplicates(["doc_id"]), docs):
        rows = frame.select("doc_id", "text").collect()
        tokens = {r.doc_id: [*WORD.findall(lower(r.text or "")), None] for r in rows}
        held = {d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d in tokens}
        count = collections.Counter(w for d, t in tokens.items() if not held[d] for w in t)
        total = sum(count.values())
        named = frame.select("doc_id", "text", F.lit(1).alias("score_in"))
        model, unigrams = language_model.fit(named.filter(F.col("doc_id").isNull() | F.col("doc_id").isin([d for d in held if d is not None and not held[d]])))
        got = language_model.score(named, model, unigrams, ["doc_id"]).collect()
        assert len(got) == len(rows)
        for r in got:
            t = tokens[r.doc_id]
            base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (len(count) + 1))) for w in t)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(count[w] > 0 for w in t), total)
            assert r.base_score == pytest.approx(base, rel=1e-9)
            assert r.score < 0


def test_language_model_rare_tokens_join(spark, docs, monkeypatch):
    monkeypatch.setattr(language_model, "FREQUENT", 50)
    test_language_model(spark, docs, docs.limit(0))


def test_filter_counts_are_lower_edges():
    import numpy as np

    f = language_model.Filter(1, np.zeros(language_model.SEGMENT_BITS // 8, np.uint8))
    assert (f.levels(np.arange(10, dtype=np.uint64)) == 0).all()


def random_words(spark, texts, words, distinct):
    r = random.Random(8)
    rows = [(i, " ".join(f"w{r.randrange(distinct)}" for _ in range(words)), None, None, None) for i in range(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def lm_scores(docs, carried="doc_id"):
    model, unigrams = language_model.fit(docs)
    return {r[0]: r for r in language_model.score(docs, model, unigrams, [carried]).collect()}, model


def test_language_model_shards_hold_all(spark, monkeypatch):
    """A filter in shards answers as one that fits as a whole; nothing rare is left out."""
    docs = random_words(spark, 40, 4_000, 5_000)
    whole, _ = lm_scores(docs)
    monkeypatch.setattr(language_model, "MAX_BITS", language_model.SEGMENT_BITS)
    cut, _ = lm_scores(docs)
    assert set(cut) == set(whole)
    for d, r in cut.items():
        assert r[1:4] == whole[d][1:4]
        assert r.base_score == pytest.approx(whole[d].base_score, rel=1e-12)
        assert r.score == pytest.approx(whole[d].score, rel=1e-12)


@pytest.mark.parametrize("frequent", [200_000, 50])
def test_language_model_counts_all_bigrams(spark, monkeypatch, frequent):
    """Pairs outside the most frequent tokens count as well; false hits raise a score a little, nothing lowers it."""
    monkeypatch.setattr(language_model, "FREQUENT", frequent)
    docs = random_words(spark, 60, 500, 600)
    got, model = lm_scores(docs)
    texts = {r.doc_id: [None, *r.text.split(), None] for r in docs.collect()}
    one = collections.Counter(w for t in texts.values() for w in t[1:])
    two = collections.Counter(x for t in texts.values() for x in zip(t, t[1:]))
    scale = model.total + 0.1 * (model.distinct + 1)
    edge = lambda n: 2 ** (n.bit_length() - 1) if n else 0
    for d, t in texts.items():
        want = sum(math.log10(0.5 * min(edge(two[x]) / one[x[0]], 1) + 0.5 * (edge(one[x[1]]) + 0.1) / scale) for x in zip(t, t[1:]))
        assert want - 1e-6 <= got[d].score <= want + 0.06 * len(t)


def test_language_model_carried_names_and_long_words(spark, monkeypatch):
    """Carried columns with the names of results are left out; words longer than a piece hash like whole ones."""
    monkeypatch.setattr(language_model, "PIECE", 64)
    rows = [(1, "a " + "x" * 200 + " b", 5), (1, "a " + "x" * 200 + " b", 6), (None, None, 7), (3, "", None), (4, "y" * 64 + " " + "x" * 199, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long").withColumns({"_row": F.lit("r"), "_lm_text": F.lit(0), "key": F.lit("k")})
    model, unigrams = language_model.fit(docs)
    got = language_model.score(docs, model, unigrams, ["doc_id", "score", "_row", "_lm_text", "key"])
    assert got.columns == ["doc_id", "_row", "_lm_text", "key", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = got.collect()
    assert model.distinct == 6 and sorted(r.n_tokens for r in got) == [1, 1, 3, 4, 4]
    assert all(r.n_known == r.n_tokens and r._row == "r" and r.score < 0 for r in got)


@pytest.mark.parametrize("bucket", [7_000, 100])
def test_language_model_buckets(spark, monkeypatch, bucket):
    """However the pairs are dealt, each bigram answers with its own count or a false hit above it."""
    monkeypatch.setattr(language_model, "BUCKET", bucket)
    monkeypatch.setattr(language_model, "MAX_BITS", 20 * language_model.SEGMENT_BITS)
    test_language_model_counts_all_bigrams(spark, monkeypatch, 50)


def test_language_model_empty(spark):
    model, unigrams = language_model.fit(empty(spark))
    assert language_model.score(empty(spark), model, unigrams, ["doc_id"]).count() == 0


# ---------------------------------------------------------------- quality rules


def test_quality_rules(spark, odd, docs):
    for frame in (odd, docs):
        got = quality_rules.outliers(frame.withColumn("distance", F.lit("clash")))
        assert "text" not in got.columns and got.count() == frame.count()
        have = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got.collect())
        want = collections.Counter()
        for r in frame.select("doc_id", "text").collect():
            t = r.text or ""
            w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
            at = collections.defaultdict(list)
            for i in range(len(w) - 4):
                at[tuple(w[i : i + 5])].append(i)
            again = len({j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)})
            want[r.doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), again, len(w) < 10 or 100 * again > 20 * len(w)] += 1
        assert have == want
    assert quality_rules.outliers(empty(spark)).count() == 0


def test_consistency_factor():
    import numpy as np

    x = np.sort(np.random.default_rng(1).chisquare(5, 400_000))
    assert quality_rules.consistency(0.75, 5) == pytest.approx(5 / x[:300_000].mean(), rel=0.01)


def test_determinant_equals_brute_force(spark):
    """Two groups with wild rows: determinant and verdicts of many random starts in plain numpy."""
    import numpy as np

    r = np.random.default_rng(4)
    mix = r.normal(size=(5, 5)) * 15
    data = {}
    for group, n in (("a", 400), (None, 300)):
        x = r.normal(size=(n, 5)) @ mix.T * [1, 30, 1, 1, 30]
        x[: n // 6] += [900, 0, -700, 0, 9000]
        data[group] = np.round(x).astype(int)
    fit = spark.createDataFrame([("l", g, *map(int, row)) for g, x in data.items() for row in x], "lang string, source string, " + ", ".join(f"x{i} long" for i in range(5)))
    got = {row.source: row for row in quality_rules.estimate(fit.repartition(3)).collect()}
    error = np.diag(quality_rules.ERROR)

    def plain(x, start):
        h = int(np.ceil(0.75 * len(x)))
        near = start
        for _ in range(60):
            m, c = x[near].mean(0), np.cov(x[near].T, bias=True) + error
            near = np.argsort((np.linalg.solve(np.linalg.cholesky(c), (x - m).T) ** 2).sum(0), kind="stable")[:h]
        return np.linalg.slogdet(c)[1], tuple(m), c

    for g, x in data.items():
        best = min((plain(x, r.choice(len(x), 6, replace=False)) for _ in range(60)), key=lambda e: e[0])
        row = got[g]
        mean = np.array([row[f"m{i}"] for i in range(5)])
        low = np.array([[row[f"l{i}_{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
        assert row.logdet == pytest.approx(np.linalg.slogdet(low @ low.T)[1], abs=1e-9)
        assert abs(row.logdet - best[0]) < 0.35  # the pooled covariance of the other group has 20 rows in it
        far = lambda m, l: (np.linalg.solve(l, (x - m).T) ** 2).sum(0) / quality_rules.CONSISTENCY > quality_rules.CUTOFF
        assert (far(mean, low) == far(np.array(best[1]), np.linalg.cholesky(best[2]))).all()
        assert far(mean, low)[: len(x) // 6].all() and not far(mean, low)[len(x) // 6 :].any()


def test_quality_rules_keep_clean_and_drop_wild(spark):
    r = random.Random(1)
    clean = [(i, prose(i, r.randint(80, 300)) + ".", "en", "a", 1) for i in range(200)]
    wild = [(1000 + i, " ".join("ab" + "#$%" for _ in range(150 + i)) + f" {i}", "en", "a", 1) for i in range(3)]
    wild = [(i, " ".join(f"{w}{k}" for k, w in enumerate(t.split())), *rest) for i, t, *rest in wild]
    kept = {x.doc_id for x in quality_rules.outliers(spark.createDataFrame(clean + wild, SCHEMA)).filter("kept").collect()}
    assert len(kept & set(range(200))) >= 195 and not kept & {1000, 1001, 1002}


# ---------------------------------------------------------------- classifiers


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int, quality int")


def test_toxicity(spark, odd):
    r = random.Random(5)
    rows = [(i, prose(i, 60) + (" filthword vileword" if i % 8 == 0 else ""), "en", "a", 1) for i in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA).select("doc_id", "text")
    known = labels_of(spark, [(i, int(i % 8 == 0), 1) for i in range(600) if r.random() < 0.5] + [(None, 1, 1), (3, None, None)])
    scored = toxicity.score(docs, toxicity.fit(docs, known)).collect()
    right = [(x.toxicity >= 0.5) == (x.doc_id % 8 == 0) for x in scored if zlib.crc32(str(x.doc_id).encode()) % 5 == 0]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= x.toxicity <= 1 for x in toxicity.score(odd, toxicity.fit(odd, known)).collect())
    model = toxicity.fit(empty(spark), known.limit(0))
    assert toxicity.score(empty(spark), model).count() == 0


def test_non_negative_risk_needs_no_negatives():
    import numpy as np

    positive = np.array([True] * 20 + [False] * 200)
    has = np.concatenate([np.arange(20), np.arange(20, 40)])  # a tenth of U holds the feature
    w, b = toxicity.fit_nnpu(has, np.zeros(40, int), np.ones(40), positive, 1, 0.1)
    assert w[0] + b > 0 > b


def test_quality(spark, odd):
    rows = [(i, prose(i, 60) if i % 4 else " ".join(["##"] * 60), "en", "a", 1) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).select("doc_id", "text")
    known = labels_of(spark, [(i, 0, int(i % 4 > 0)) for i in range(400)])
    stats = quality.document_statistics(docs)
    scored = quality.score(stats, quality.fit(stats, known)).collect()
    assert all((x.quality >= 0.3) == (x.doc_id % 4 > 0) for x in scored)
    stats = quality.document_statistics(odd)
    assert all(0 <= x.quality <= 1 for x in quality.score(stats, quality.fit(stats, known)).collect())
    none = quality.document_statistics(empty(spark))
    assert quality.score(none, quality.fit(none, known.limit(0))).count() == 0


def test_pool_adjacent_is_monotone():
    import numpy as np

    x, level = quality.pool_adjacent(np.arange(5.0), np.array([0.0, 2, 1, 1, 4]), np.array([2.0, 2, 2, 2, 4]))
    assert list(level) == sorted(level) and level[0] == 0 and level[-1] == 1


# ---------------------------------------------------------------- mixing


def wanted_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else rest * weight[s] / w for s in names}
        above = {s for s in names if target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def test_mixing(spark, odd, docs):
    for frame in (odd, docs):
        mixed = mixing.mix(frame.withColumn("copies", F.lit("clash")))
        got = mixed.collect()
        assert len(got) == frame.count()
        sizes = collections.Counter()
        for r in got:
            assert r["size"] == len(WORD.findall(r.text or "")) and 0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
            sizes[r.source] += r["size"]
        target = wanted_targets(dict(sizes))
        for r in got:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        for s in sizes:
            taken = sum(r.taken for r in got if r.source == s)
            longest = max(r["size"] for r in got if r.source == s)
            assert abs(taken - target[s]) <= 2 * longest
        key = lambda r: (r.doc_id is None, r.doc_id or 0, r.taken)
        assert [tuple(r) for r in sorted(mixing.mix(frame).collect(), key=key)] == [tuple(r) for r in sorted(mixing.mix(frame.repartition(5)).collect(), key=key)]
    assert mixing.mix(empty(spark)).count() == 0


def test_mixing_comes_near_targets(docs):
    rows = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert sum(abs(r.taken - r.target) <= 0.1 * r.target for r in rows) >= 0.8 * len(rows)
    assert sum(r.taken for r in rows) == pytest.approx(sum(r.target for r in rows), rel=0.05)
