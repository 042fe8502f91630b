"""From raw documents to token ids: five stages, each a Spark job over all that its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read back as the next one's docs. All but the last
return the columns of documents. Rows with one doc_id count as one document: the
near-duplicate stage keeps one of them. An empty table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indexloom.llm import byte_bpe, mixing, near_dup, suffix_dedup, toxicity
from indexloom.llm.common import stored, table

TOXIC = 0.5
#: Bytes of a passage of 50 words, four letters and a space each.
PASSAGE = 250
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is below one half."""
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, model, "_toxicity").filter(F.col("_toxicity") < TOXIC).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8): the one with the smallest id."""
    judged = stored(near_dup.near_duplicates(docs.select("doc_id", "text")), "pipeline-near")
    gone = judged.filter(~F.col("kept")).select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = judged.filter(F.col("kept") & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n"))
    again = again.filter("n > 1").select("doc_id")
    if again.isEmpty():
        return kept
    once = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(again, "doc_id", "left_anti").select(*docs.columns).union(once.select(*docs.columns))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of over 50 words that occur elsewhere; a text that is one such passage stays as an empty one."""
    cut = suffix_dedup.remove_repeats(docs, length=PASSAGE)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: each document as often as it was drawn."""
    return mixing.repeat(mixing.mix(docs.withColumn("_row_columns", F.struct(*docs.columns))).select("_row_columns", "copies"), ["_row_columns"]).select("_row_columns.*")


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether decoding them gives the text back byte by byte."""
    path = public_tokenizers.path(VOCABULARY)
    encoded = byte_bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, check=True)
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("byte_bpe", encode_texts),
]

#: A trained classifier, hash-driven samples and merges are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
