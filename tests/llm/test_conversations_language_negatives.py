"""Conversation repair, language identification and hard negatives against plain forms."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from indexloom.llm import conversations, hard_negatives, language_id
from indexloom.llm.common import table

# ---------------------------------------------------------------- conversations

SPACE = " \t\n\x0b\x0c\r"
CONVERSATION = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        role = "user" if fate == 4 else role
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def plain_repair(rows):
    """All edits by a forward pass that keeps the least audit of each state as text."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        shown = text.rstrip(SPACE)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    allowed = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    made = {"": "u", "s": "u", "a": "u", "u": "a"}
    name = {"u": "user", "a": "assistant"}

    def inserted(states):
        for _ in range(3):
            for q, (cost, audit, turns) in list(states.items()):
                new = (cost + 2, audit + "I", (*turns, (name[made[q]], "")))
                if made[q] not in states or new[:2] < states[made[q]][:2]:
                    states[made[q]] = new
        return states

    states = {"": (0, "", ())}
    for (_, _, role, text), fault in zip(rows, faults):
        states, new = inserted(states), {}
        for q, (cost, audit, turns) in states.items():
            offers = [(q, (cost + 3, audit + "D", turns))]
            if fault not in ("blank", "duplicate"):
                more = cost + (fault == "truncated")
                if (q, role[:1]) in allowed:
                    offers.append((role[0], (more, audit + "K", (*turns, (role, text)))))
                offers.append((made[q], (more + 2, audit + "R", (*turns, (name[made[q]], text)))))
            for to, offer in offers:
                if to not in new or offer[:2] < new[to][:2]:
                    new[to] = offer
        states = new
    states = inserted(states)
    cost, audit, turns = min((states[q] for q in ("", "a") if q in states), key=lambda x: x[:2])
    known = {r[1] for r in rows if r[1] is not None}
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return {
        "gaps": max(known) - min(known) + 1 - len(known) if known else 0, **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest(),
    }


def conversation_rows(seed, n, long=0):
    r = random.Random(seed)
    out = []
    for conv in range(n):
        for turn in range(long if conv == 1 and long else r.randint(1, 9)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = r.choice(["Well. ", "yes", "ok!", "", " \n\t", None, "Why? ", "é." + "x" * r.randint(0, 3), f"{turn}."])
            out.append((conv, turn if r.random() < 0.9 else None, role, text))
    return out + out[:3] + [(None, 1, "user", "a."), (None, None, "assistant", "b.")]


def check_conversations(spark, rows):
    given = spark.createDataFrame(rows, CONVERSATION).withColumns({"audit": F.lit("x"), "block": F.lit(1), "n": F.lit(2)}).repartition(3)
    found = {x.conv_id: x.asDict() for x in conversations.digest(conversations.repair(conversations.damage(given), given)).collect()}
    damaged = plain_damage(rows)
    ids = {r[0] for r in rows}
    assert set(found) == ids
    for conv in ids:
        assert found[conv] == {"conv_id": conv, **plain_repair([r for r in damaged if r[0] == conv])}, conv


@pytest.mark.parametrize("seed", [1, 2])
def test_conversations(spark, seed):
    check_conversations(spark, conversation_rows(seed, 80))


def test_conversation_over_many_blocks_and_tasks(spark, monkeypatch):
    """One conversation holds most rows, and blocks are a few lines long."""
    monkeypatch.setattr(conversations, "ROWS", 7)
    check_conversations(spark, conversation_rows(3, 20, long=700))


def test_conversation_copies_and_long_texts(spark):
    """Thousands of equal rows are one line; a long text ends its block."""
    rows = [(1, 5, "user", "Same.")] * 3_000 + [(1, 6, "assistant", "x" * (conversations.CHARS + 5)), (1, 7, "user", "y" * (conversations.CHARS + 5) + "."), (1, 8, "assistant", "z.")]
    check_conversations(spark, rows)
    counted = conversations.lines(spark.createDataFrame(rows, CONVERSATION), spark.createDataFrame(rows, CONVERSATION))
    assert counted.count() == 1 + 4 + 4


def test_conversations_empty(spark):
    none = spark.createDataFrame([], CONVERSATION)
    assert conversations.digest(conversations.repair(none)).count() == 0
    dropped = next(t for t in range(100) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    one = spark.createDataFrame([(7, dropped, "user", "Hi.")], CONVERSATION)
    found = conversations.digest(conversations.repair(conversations.damage(one), one)).collect()
    assert [(x.conv_id, x.cost, x.audit, x.repaired_sha256) for x in found] == [(7, 0, "", hashlib.sha256(b"").hexdigest())]


def test_crossings_equal_plain_tables():
    """Hirschberg over rows and over blocks gives the same audit as trying all states."""
    r = random.Random(5)
    for _ in range(200):
        kinds = [r.randint(0, 8) for _ in range(r.randint(1, 12))] + [conversations.END]
        best = {conversations.START: (0, "")}
        for k in kinds:
            new = {}
            for a, (cost, audit) in best.items():
                for b, way in enumerate(conversations.TABLES[k][a]):
                    if way:
                        offer = (cost + way[0], audit + way[1])
                        new[b] = min(new.get(b, offer), offer)
            best = new
        assert "".join(conversations.solve(kinds, conversations.START, conversations.ASSISTANT)) == best[conversations.ASSISTANT][1]


# ---------------------------------------------------------------- language


@pytest.fixture(scope="module")
def pieces(tmp_path_factory):
    path = tmp_path_factory.mktemp("ranks") / "own.tiktoken"
    known = [bytes([b]) for b in range(256)] + [b" th", b"the", b"he", b" the", b"ab", b"bc", b"abc", "é".encode(), b" ab", b"A1", b"x.", b"a" * 30]
    path.write_text("".join(f"{base64.b64encode(p).decode()} {i}\n" for i, p in enumerate(known)))
    return language_id.Pieces.read(str(path))


def segmentations(word, known):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in known:
            for rest in segmentations(word[n:], known):
                yield [known[word[:n]], *rest]


def test_lattice_sums_all_segmentations(pieces):
    assert len(pieces.pieces) == 256 + 9  # other characters and longer pieces stay out
    known = {p: i for i, p in enumerate(pieces.pieces)}
    r = np.random.default_rng(1)
    probability = r.dirichlet(np.ones(len(known)), size=3).T
    words = [b" the", b" abc", b" abcab", " thé".encode(), b" zzz", b" a", b" babcthe"]
    counts = np.array([3.0, 1, 0, 2, 5, 1, 2])
    model = language_id.Model(pieces, ("a", "b", "c"), probability)
    lattice = language_id.Lattice(pa.array([w[1:].decode() for w in words]), pieces)
    sums = np.array([[sum(np.prod(probability[s, c]) for s in segmentations(w, known)) for c in range(3)] for w in words])
    assert np.allclose(lattice.log_sums(model.scaled), np.log(sums), rtol=1e-9)
    want = np.zeros(len(known))
    for w, n, total in zip(words, counts, sums[:, 1]):
        for s in segmentations(w, known):
            for p in s:
                want[p] += n * np.prod(probability[s, 1]) / total
    got = lattice.expected(model.scaled[lattice.piece, 1], counts, len(known))
    assert np.allclose(got, want)


def test_words(pieces):
    text = pa.array(["The cat's Thé", "", "1 2 -", "é" * 60, "the THE"])
    words, number, owner = language_id.words_of(text)
    spelled = [[words[int(n)].as_py() for n, o in zip(number, owner) if o == i] for i in range(5)]
    assert spelled[0] == ["the", "cat", "s", "thé"] and spelled[1] == spelled[2] == [] and spelled[4] == ["the", "the"]
    assert "".join(spelled[3]) == "é" * 60 and max(len(w.encode()) for w in spelled[3]) < language_id.WORD_BYTES


def language_rows(n=120):
    r = random.Random(4)
    syllables = {"aa": ["ba", "do", "ti", "lu"], "bb": ["sch", "ung", "en", "ver"], "cc": ["eau", "ou", "ç", "tion"]}
    return [(i, " ".join("".join(r.choices(syllables[lang], k=3)) for _ in range(20)), lang) for i in range(n) for lang in [r.choice(list(syllables))]]


def test_language_odd_rows(spark, pieces):
    rows = language_rows()
    model = language_id.fit(spark.createDataFrame(rows + [(500, None, "aa"), (501, "dodo", None), (502, "...", "dd")], "doc_id long, text string, lang string"), pieces)
    assert model.languages == ("aa", "bb", "cc")
    assert np.allclose(model.table.sum(axis=0), 1)
    odd = [(1, None, "x"), (2, "", "x"), (3, "12 -", "x"), (4, "badotilu " * 30_000, "x"), (4, "badotilu " * 30_000, "x"), (None, "verschungen", "x"), (6, "b" * 5_000, "x")]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang_pred string").withColumns({"score": F.lit("clash"), "_word": F.lit(1)})
    found = language_id.identify(docs, model).collect()
    assert docs.columns == ["doc_id", "text", "lang_pred", "score", "_word"] and found[0].asDict().keys() == {"doc_id", "_word", "lang_pred", "score"}
    got = sorted(((x.doc_id or 0, x.lang_pred, x.score) for x in found))
    assert [x[:2] for x in got if x[0] != 6] == [(0, "bb"), (1, "und"), (2, "und"), (3, "und"), (4, "aa"), (4, "aa")]
    assert all(0 <= x[2] <= 1 for x in got) and [x[2] for x in got if x[1] == "und"] == [0.0] * 3
    nothing = language_id.fit(docs.limit(0).withColumn("lang", F.lit("aa")), pieces)
    assert nothing.languages == () and {x.lang_pred for x in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), model).count() == 0


def test_language_parts_of_the_model(spark, pieces, monkeypatch):
    """Languages in several broadcasts give what one gives."""
    docs = spark.createDataFrame(language_rows(), "doc_id long, text string, lang string")
    model = language_id.fit(docs, pieces)
    once = {x.doc_id: (x.lang_pred, x.score) for x in language_id.identify(docs, model).collect()}
    monkeypatch.setattr(language_id, "PART", 1)
    assert np.allclose(language_id.fit(docs, pieces).table, model.table)
    parts = {x.doc_id: (x.lang_pred, x.score) for x in language_id.identify(docs, model).collect()}
    assert {k: v[0] for k, v in once.items()} == {k: v[0] for k, v in parts.items()} == {i: lang for i, _, lang in language_rows()}
    assert all(abs(once[k][1] - parts[k][1]) < 1e-9 for k in once)


def test_registered_language(spark, sf):
    found = entry.queries()["op12_segment_language"](spark, sf)
    assert dict(found.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}
    rows = found.join(table(spark, sf, "documents").select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == table(spark, sf, "documents").count()
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in rows)
    judged = [x.lang == x.lang_pred for x in rows if x.held_out and x.lang and x.lang_pred != "und"]
    assert len(judged) > 20 and np.mean(judged) >= 0.95


# ---------------------------------------------------------------- hard negatives


def plain_negatives(rows, anchor, k=5, n=10, low=30, high=90):
    best = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            best[i] = min(best.get(i, (label, v)), (label, v))
    whole = {i: (label, [int(np.floor(256 * x)) if abs(x) < 2**50 else int(x) * 256 for x in v]) for i, (label, v) in best.items()}
    out = []
    for a in sorted(whole):
        if a % anchor:
            continue
        scored = sorted((-max(-(2**63) + 1, min(2**63 - 1, sum(x * y for x, y in zip(whole[a][1], v)))), i, label) for i, (label, v) in whole.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == whole[a][0]][:k]:
            hard = [x for x in scored if x[2] != whole[a][0] and 30 * -s <= 100 * -x[0] <= 90 * -s][:n]
            out += [(a, p, r, i, -s, -t) for r, (t, i, _) in enumerate(hard, 1)]
    return sorted(out)


def vector_rows(n=260, dim=7):
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(size=dim).round(1)], int(i % 3)) for i in range(n)]
    rows += [(n + i, rows[20][1], 1) for i in range(30)]  # ties
    bad = [(900, None, 1), (910, [1.0, None] + [0.0] * (dim - 2), 1), (920, [float("nan")] * dim, 1), (930, [float("inf")] * dim, 1), (None, [1.0] * dim, 1), (940, [1.0] * dim, None)]
    return rows + bad + rows[:5] + [(20, [9.0] * dim, 2), (950, [0.5, 0.5], 1), (960, [], 0)]


VECTORS = "vec_id long, embedding array<double>, label int"


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, VECTORS).withColumns({"score": F.lit("clash"), "row": F.lit(1), "id": F.lit(7)}).repartition(3)
    found = hard_negatives.mine(df, F.col("id") % 10 == 0, **more)
    return sorted(map(tuple, found.collect()))


def test_strassen():
    r = np.random.default_rng(1)
    for m, k, n in ((1, 1, 1), (5, 70, 33), (64, 64, 64), (37, 41, 129)):
        a, b = r.integers(-1000, 1000, (m, k)), r.integers(-1000, 1000, (k, n))
        assert (hard_negatives.strassen(a, b, 4) == a @ b).all()
        big = r.integers(-(1 << 62), 1 << 62, (m, k))
        exact = big.astype(object) @ b.astype(object)
        assert (hard_negatives.strassen(big.astype(object), b.astype(object), 4) == exact).all()
        assert ((exact.astype(object) & (1 << 64) - 1) == (hard_negatives.strassen(big, b, 4).astype(object) & (1 << 64) - 1)).all()


def test_hard_negatives(spark):
    rows = vector_rows()
    want = plain_negatives(rows, 10)
    assert len(want) > 200 and mined(spark, rows) == want


def test_hard_negatives_in_small_cells(spark, monkeypatch):
    for name, value in {"CELL": 40, "ANCHORS": 9, "CHUNK": 16, "TILE": 4, "LEAF": 2}.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vector_rows()
    assert mined(spark, rows) == plain_negatives(rows, 10)


def test_hard_negatives_of_large_numbers(spark):
    """Products beyond 64 bits are compared as whole numbers and held at the end of the range."""
    r = np.random.default_rng(8)
    rows = [(i, [float(x) for x in r.normal(size=4) * 10.0 ** int(r.integers(0, 14))], int(i % 2)) for i in range(60)] + [(70, [1e300] * 4, 0)]
    assert mined(spark, rows) == plain_negatives(rows, 10)


def test_hard_negatives_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(10, [1.0], 1)]) == []
