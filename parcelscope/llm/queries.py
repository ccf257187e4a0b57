"""One query per text operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelscope.llm import (
    ann,
    bpe,
    chat_format,
    collocations,
    conversation_repair,
    decontaminate,
    language_id,
    simhash,
    substring_dedup,
    syncmers,
    token_records,
    toxicity,
    warc,
)
from parcelscope.llm.common import held_out, ship_package, table
from parcelscope.llm.oracles import ORACLES  # noqa: F401


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    training = docs.filter(~held_out(F.col("doc_id"))).select(F.col("lang").alias("label"), "text")
    return language_id.predict(rows, language_id.train(training)).select("doc_id", "held_out", "lang_pred", "score")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    rows = docs.withColumn("held_out", held_out(F.col("doc_id")))
    scored = toxicity.score(rows, toxicity.train(docs, labels))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat_format.read_back(chat_format.format_conversations(rows.union(more)))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.write_and_read(table(spark, sf_dir, "pages"))


def op9_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.write_and_read(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_texts(docs, tokenizer_path("word_bpe_49k.json"), known=300_000)


def op11_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of conversations with the faults of op12's contract, each by the crc32 of `conv_id:turn` modulo 20.

    `there` is false for dropped rows. Of nulls, role, text and what enters the crc count as one space.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    fault, text = F.col("fault"), F.coalesce("text", blank)
    return rows.withColumn("fault", F.crc32(key.cast("binary")) % 20).select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(fault != 0, F.when(fault == 3, 2).otherwise(1))).alias("there"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return conversation_repair.digests(conversation_repair.repair(rows, kept="there"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: _shipped(query)
    for query in (
        op1_language_id,
        op2_toxicity,
        op3_simhash,
        op4_substring_dedup,
        op5_chat_format,
        op6_ann,
        op7_warc,
        op8_decontaminate,
        op9_token_records,
        op10_bpe,
        op11_syncmers,
        op12_conversation_repair,
        op13_collocations,
    )
}
