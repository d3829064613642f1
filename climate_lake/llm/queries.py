"""The corpus operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climate_lake.llm import (
    chat,
    fill_middle,
    lexical,
    lines,
    mixing,
    neighbours,
    oracle,
    packing,
    repeats,
    rules,
    sharding,
    simhash,
    token_files,
    toxicity,
)
from climate_lake.llm.common import read


def tokenizer() -> str:
    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_documents(read(spark, sf_dir, "documents"), tokenizer())


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer()).drop("ids")


def op3_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "source"))
    return mixed.select("doc_id", "mix.*")


def op4_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = repeats.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    extra = [(-1, 0, "user", text), (-1, 1, "assistant", text)]
    fields = ["conv_id", "turn", "role", "text"]
    rows = read(spark, sf_dir, "conversations").select(*fields)
    rows = rows.unionByName(spark.createDataFrame(extra, rows.schema))
    return chat.digests(chat.format_conversations(rows))


def op6_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang"
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.drop_repeated_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return cleaned.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score_documents(documents, toxicity.train(documents, read(spark, sf_dir, "labels")))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(read(spark, sf_dir, "documents"))
    text = fill_middle.restored(F.col("output"), F.col("form"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.digests(sharding.shard_documents(documents))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_token_files,
        op2_best_fit_packing,
        op3_pfair_mixing,
        op4_repeated_strings,
        op5_chat_format,
        op6_nearest_vectors,
        op7_simhash,
        op8_quality_rules,
        op9_line_dedup,
        op10_toxicity,
        op11_fill_middle,
        op12_minimax_shards,
        op13_ranked_search,
    )
    return {one.__name__: one for one in every}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.ORACLES)
