"""The registered queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from emberscope.llm import caps, langid, licenses, minhash, mixing, packing, partitions, quality, runs, style_tree, token_files, toxicity, vector_codes
from emberscope.llm.common import table
from emberscope.session import let_workers_import


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(let_workers_import(spark), sf_dir, "documents")
    packed = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op3_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_vectors(table(let_workers_import(spark), sf_dir, "embeddings"))


def op4_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.extract(table(let_workers_import(spark), sf_dir, "pages"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(let_workers_import(spark), sf_dir, "documents")
    return minhash.near_duplicates(docs, minhash.Settings(width=3, numerator=85))


def op6_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.search(table(let_workers_import(spark), sf_dir, "embeddings"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(let_workers_import(spark), sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(let_workers_import(spark), sf_dir, "documents")
    return token_files.digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(let_workers_import(spark), sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate_all(table(let_workers_import(spark), sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate_all(table(let_workers_import(spark), sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(table(let_workers_import(spark), sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(let_workers_import(spark), sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_mixing, op2_packing, op3_spherical_caps, op4_style_tree, op5_minhash, op6_learned_partitions, op7_language_id, op8_token_files, op9_license_scan, op10_quality, op11_toxicity, op12_runs, op13_vector_codes)}
ORACLES: dict[str, str] = {}
