"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, langid, merkle, mixing, neardup, pii, quality, repeats, simhash, tokencount, toxicity, trie
from .common import held_out, read_table

BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_RANKS = "word_bpe_49k.json"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    known = toxicity.labelled_sample(docs, labels, "toxic")
    scored = toxicity.score(docs, toxicity.fit(known, "toxic"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann.neighbours(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return bpe.digest_documents(docs, public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(read_table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("takes")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~held_out(F.col("doc_id"))))
    found = langid.predict(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_RANKS))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.cleaned(read_table(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(read_table(spark, sf_dir, "documents"), neardup.Settings(shingle=4))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.assess(read_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "quality")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = merkle.manifest(docs, merkle.tampered(docs))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebuilt_nodes(read_table(spark, sf_dir, "conversations"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_toxicity": op1_toxicity,
    "op2_neighbours": op2_neighbours,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_mixing": op4_mixing,
    "op5_language": op5_language,
    "op6_token_counts": op6_token_counts,
    "op7_repeats": op7_repeats,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_pii": op9_pii,
    "op10_quality": op10_quality,
    "op11_merkle": op11_merkle,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_simhash": op13_simhash,
}
ORACLE = {"op4_mixing": mixing.SQL, "op11_merkle": merkle.SQL, "op12_prefix_trie": trie.SQL}
