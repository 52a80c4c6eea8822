"""The operators' queries over the whole tables, with production parameters."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, hard_negatives, language, lexical, line_templates, neighbours, oracles, packing, pieces, quality,
               secrets, simhash, toxicity, warc)
from .common import read_table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(read_table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(read_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.compare(warc.archive(pages), warc.archive(warc.damaged(pages))).found


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept", F.concat_ws(",", "failed_rules").alias("failed_rules"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = line_templates.drop_lines(docs, count_col="n_dropped")
    return cleaned.withColumn("n_lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.severities(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded_documents(read_table(spark, sf_dir, "documents"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.lexical_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


#: A conversation whose texts look like control strings.
ODD = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string"))
    return chat.digests(chat.format_conversations(rows)).select(
        F.col("tree").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.usable(read_table(spark, sf_dir, "embeddings").withColumn("label", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_simhash, op2_secrets, op3_packing, op4_warc, op5_quality, op6_language,
        op7_line_dedup, op8_toxicity, op9_pieces, op10_neighbours,
        op11_lexical, op12_chat, op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    return {"op4_warc": oracles.OP4, "op11_lexical": oracles.OP11, "op12_chat": oracles.OP12, "op13_hard_negatives": oracles.OP13}
