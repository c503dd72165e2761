"""The queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.llm.oracles import ORACLES
from pitpanel.llm.shared import read_table, tokenizer_path

__all__ = ["ORACLES", "QUERIES"]


def op1_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pitpanel.llm.covertree import near_vectors

    return near_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pitpanel.llm.chat import format_chats, read_chats

    t = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    r = read_chats(format_chats(t.unionByName(more)))
    whole = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return r.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pitpanel.llm.simhash import near_duplicates

    r = near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return r.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pitpanel.llm.shared import new_path
    from pitpanel.llm.warc import read_pages, write_warc

    folder = new_path(spark, "warc")
    write_warc(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    return read_pages(spark, folder)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pitpanel.llm.quality import apply_rules

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    r = apply_rules(docs, read_table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return r.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pitpanel.llm.secrets import RULES, scan_history

    kinds = list(RULES)
    r = scan_history(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    name = lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, kinds)), s["kind"] + 1), s["start"], s["end"])
    joined = lambda c: F.array_join(F.transform(c, name), ",")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return r.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"),
    )


def op7_binary_ids(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    from pitpanel.llm.binary_ids import read_ids, write_ids

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return read_ids(write_ids(docs, tokenizer or tokenizer_path("byte_bpe_50k.json")))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pitpanel.llm.mixing import plan

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return plan(docs).select("doc_id", "size", "source_size", "target", "taken")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pitpanel.llm.lines import dedup_lines

    r = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return r.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"), "text")


def op10_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    from pitpanel.llm.packing import pack

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    p = pack(docs, tokenizer or tokenizer_path("word_bpe_49k.json"))
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pitpanel.llm.spelling import variants

    return variants(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pitpanel.llm.decontaminate import scan

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    r = scan(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return r.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pitpanel.llm.hardneg import hard_negatives

    v = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    v = v.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(v, F.col("vec_id") % 50 == 0)


QUERIES = {f.__name__: f for f in (
    op1_covertree, op2_chat_formatting, op3_simhash, op4_warc, op5_quality_rules, op6_secret_scans, op7_binary_ids, op8_mixing, op9_line_dedup, op10_packing,
    op11_spelling_variants, op12_decontamination, op13_hard_negatives,
)}
