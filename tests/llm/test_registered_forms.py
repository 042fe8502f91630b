"""The registered queries of the operators: columns, types, rows and held-out marks on the smallest tables."""

import hashlib
import zlib

import pytest

import __spark_entry__ as entry
from indexloom.llm.common import table

FORMS = {
    "op1_pstable_ann": "query_id bigint, rank int, vec_id bigint, score double",
    "op2_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op3_setsketch": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op4_fourier_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6_logfreq_lm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op7_nnpu_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op9_mcd_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op10_pareto_mix": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op11_hirschberg_repair": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string",
    "op12_segment_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op13_strassen_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
}
#: Folds of the held-out rows: modulus and remainder.
FOLDS = {"op4_fourier_quality": (5, 0), "op6_logfreq_lm": (10, 0), "op7_nnpu_toxicity": (5, 0), "op12_segment_language": (4, 2)}


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r.doc_id: r.text for r in table(spark, sf, "documents").select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", FORMS)
def test_registered_form(spark, sf, texts, name):
    found = entry.queries()[name](spark, sf)
    types = dict(found.dtypes)
    assert {c: types.get(c) for c in (x.split()[0] for x in FORMS[name].split(", "))} == dict(x.split() for x in FORMS[name].split(", "))
    rows = found.collect()
    assert rows and all(x is not None for r in rows for x in (r[0],))
    if "doc_id" in types:
        assert sorted(r.doc_id for r in rows) == sorted(texts)
    if name in FOLDS:
        size, fold = FOLDS[name]
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % size == fold) for r in rows)
    if "score" in types and "held_out" in types and name != "op6_logfreq_lm":
        assert all(0 <= r.score <= 1 for r in rows)
    if "predicted" in types:
        bar = 0.3 if name == "op4_fourier_quality" else 0.5
        assert all(r.predicted == (r.score >= bar) for r in rows)
    if name == "op8_byte_bpe":
        assert all(r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest() for r in rows)
    if name == "op2_suffix_dedup":
        assert all(r.n_bytes == len((texts[r.doc_id] or "").encode()) and 0 <= r.n_removed <= r.n_bytes for r in rows)
