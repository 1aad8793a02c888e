"""The registered queries of the training-data operators: thin, each applies
its operator to a whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import decontam, divergence, html_text, lattice, packing, permutation, pfor, pii, simhash, spelling, substring, token_counts, toxicity
from weft.llm.common import read_table
from weft.llm.oracle import ORACLE_SQL  # noqa: F401
from weft.session import scratch_path


def op1_pfor_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "pfor")
    docs = pfor.in_id_order(read_table(spark, sf_dir, "documents"))
    pfor.write_ids(pfor.encode_documents(docs), path)
    return pfor.read_ids(spark, path).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op2_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(f"base_spans.{k}").cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.spelled("base_spans"), 256).alias("base_sha256"), pii.spelled("all_spans").alias("spans"))


def op3_column_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(read_table(spark, sf_dir, "documents"), with_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op6_edit_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept_text")


def op8_toxicity_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (toxicity.fold("doc_id") == 2).alias("held_out"), "score", "predicted")


def op9_permutation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = permutation.usable(read_table(spark, sf_dir, "embeddings"))
    return permutation.search(permutation.build_index(vectors), vectors.where("vec_id % 20 = 0"))


def op10_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_counts(read_table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def op12_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pfor_ids": op1_pfor_ids,
    "op2_pii_spans": op2_pii_spans,
    "op3_column_packing": op3_column_packing,
    "op4_simhash_blocks": op4_simhash_blocks,
    "op5_tag_path_text": op5_tag_path_text,
    "op6_edit_decontam": op6_edit_decontam,
    "op7_window_dedup": op7_window_dedup,
    "op8_toxicity_trees": op8_toxicity_trees,
    "op9_permutation_search": op9_permutation_search,
    "op10_section_tokens": op10_section_tokens,
    "op11_source_divergence": op11_source_divergence,
    "op12_lattice_dedup": op12_lattice_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}
