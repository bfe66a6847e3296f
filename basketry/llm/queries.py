"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.llm import (
    chat,
    counts,
    embeddings,
    jaccard,
    language,
    licenses,
    mixing,
    packing,
    phrases,
    planes,
    quality,
    structure,
    suffixes,
    tokens,
)


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokens.default_path())


def op2_bit_plane_ids(spark, sf_dir):
    folder = planes.new_folder(spark)
    planes.write_ids(table(spark, sf_dir, "documents"), tokens.default_path(), folder)
    return planes.read_documents(spark, folder)


def op3_embedding_near_dedup(spark, sf_dir):
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_soft_domain_mixing(spark, sf_dir):
    return mixing.rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_suffix_dedup(spark, sf_dir):
    kept = suffixes.each_without_repeats(table(spark, sf_dir, "documents"))
    return kept.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op6_language_filters(spark, sf_dir):
    return language.predicted(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents")).drop("row")


def op8_chat_transcripts(spark, sf_dir):
    return chat.transcripts(table(spark, sf_dir, "conversations"))


def op9_jaccard_components(spark, sf_dir):
    return jaccard.similar_components(table(spark, sf_dir, "documents"))


def op10_token_counts(spark, sf_dir):
    return counts.token_counts(table(spark, sf_dir, "documents"), tokens.default_path())


def op11_phrase_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_structure_repair(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return structure.digests(structure.damaged(turns), ids=turns, copies="copies")


def op13_license_signatures(spark, sf_dir):
    return licenses.scanned(table(spark, sf_dir, "documents")).drop("detections")


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_bit_plane_ids": op2_bit_plane_ids,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_soft_domain_mixing": op4_soft_domain_mixing,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_language_filters": op6_language_filters,
    "op7_quality_rules": op7_quality_rules,
    "op8_chat_transcripts": op8_chat_transcripts,
    "op9_jaccard_components": op9_jaccard_components,
    "op10_token_counts": op10_token_counts,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_structure_repair": op12_structure_repair,
    "op13_license_signatures": op13_license_signatures,
}

ORACLES: dict[str, str] = {}
