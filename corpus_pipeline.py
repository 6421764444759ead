"""From raw documents to piece ids, stage by stage.

Each stage takes the documents that its predecessor kept and works on all of them; all but the last return the columns of
documents. A stage's result is written to the shared folder and read again, so that lost executors cost only their tasks.

Quality rules and language ID drop what they reject, near-dedup keeps the document with the smallest id of each component,
decontamination drops documents in which a window of ten benchmark words (or a whole shorter item) occurs, and the last stage encodes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.llm import divergence_rules, language_crf, sentencepiece_viterbi, simhash_tiles, wu_manber
from cohortwise.llm.common import stage

#: Least mean marginal of the predicted language: below it, no language has half of the words' weight.
LEAST_LANGUAGE_SCORE = 0.5
#: Near-duplicates have fingerprints of three-word shingles that differ in at most two bits.
SHINGLE, RADIUS = 3, 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return divergence_rules.keep(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and documents of no one language."""
    return language_crf.keep(docs, LEAST_LANGUAGE_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_tiles.one_of_each(docs, SHINGLE, RADIUS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return wu_manber.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, their number, and whether decoding them gives the text again."""
    coded = sentencepiece_viterbi.encode(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"), exact="exact")
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "exact")


STAGES = [("quality_rules", quality_rules), ("language_id", language_id), ("simhash_near_dedup", near_dedup),
          ("decontamination", decontaminate), ("sentencepiece", encode)]

#: Learned models and XXH64 have no form in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
