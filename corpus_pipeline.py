"""From raw documents to packed training sequences.

Stages, each over all that its predecessor kept: language ID rejects texts without a language,
the quality classifier rejects texts below its threshold, MinHash near-dedup keeps one document of
each group, mixing repeats and drops documents towards the target weights, packing fills
windows of 4096 tokens. run() and the driver write and read back a stage's rows alike.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope.llm import langid, minhash, mixing, packing, quality
from emberscope.llm.common import crc_fold, stored, table
from emberscope.session import let_workers_import

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled part teaches; its own ``lang`` column stays as given."""
    samples = langid.learn(docs.where(crc_fold() != 2), langid.Settings())
    return langid.predict(docs, samples).where(F.col("lang_pred") != langid.UNDETERMINED).select(*COLUMNS)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold."""
    s = quality.Settings()
    machine = quality.learn(docs, table(spark, sf_dir, "labels"), s)
    return quality.score(docs, machine, s).where("predicted = 1").select(*COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near copies (five-word shingles, similarity of 0.8 or more).

    Rows without an id stay. Of rows that repeat an id the one with the least hash of its columns stays, wherever they lie.
    """
    kept = minhash.near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").select(*COLUMNS)
    if _repeats(docs):
        named = named.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64(*COLUMNS).alias("_hash"), *COLUMNS[1:])).alias("_row")).select("doc_id", "_row.*").drop("_hash")
    return named.join(kept, "doc_id", "left_semi").select(*COLUMNS).union(docs.where("doc_id IS NULL").select(*COLUMNS))


def _repeats(docs: DataFrame) -> bool:
    return not docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty()


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of clean, poor and toxic text ask."""
    targets = {"clean": 0.95, "poor": 0.02, "toxic": 0.03}
    return mixing.mix(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), mixing.Settings(targets=targets))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences and their places in windows."""
    out = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), ids=False)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("language", language), ("quality", good), ("near_duplicates", distinct), ("mixing", mixed), ("packing", packed)]

#: No stage but packing's bookkeeping can be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    let_workers_import(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
