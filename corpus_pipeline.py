"""A training corpus from the documents, in five stages.

Every stage takes all that the one before kept, and its result is written and read again. Edge cases:
null and empty texts have no language and leave in the first stage; rows without doc_id or with a
repeated one are told apart by a row number; further columns pass through; empty tables stay empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelscope.llm import bpe, decontaminate, language_id, simhash, substring_dedup
from parcelscope.llm.common import free_name, held_out, numbered, ship_package, staged, table
from parcelscope.llm.queries import tokenizer_path


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a language can be told. Their own columns stay as they are.

    Texts go that have no letter, and those that share too few n-grams with the landmarks of the language that the
    kernels choose: under 0.45, or less where that would cost more than one in ten thousand of the documents
    that have a lang and that the model was not fitted on. Where no training row has a lang there is no model to reject
    by, and only texts without a letter go.
    """
    ship_package(spark)
    training = docs.filter(~held_out(F.col("doc_id"))).select(F.col("lang").alias("label"), "text")
    model = language_id.train(training)
    if model is None:
        return docs.filter(language_id.has_letter(F.col("text")))
    least = language_id.least_share(docs.filter(held_out(F.col("doc_id")) & F.col("lang").isNotNull()), model)
    lang, score, known = (free_name(docs, f"pipeline_{name}") for name in ("lang", "score", "known"))
    told = language_id.predict(docs, model, names=(lang, score, known))
    return told.filter((F.col(lang) != language_id.UNDETERMINED) & (F.col(known) >= least)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (least doc_id) of each group of fingerprints that differ in at most 3 bits, each from the next.

    Where an id is null or comes again, the first is that of the least row number instead.
    """
    ship_package(spark)
    row = free_name(docs, "pipeline_row")
    rows = numbered(docs, "doc_id", row)
    groups = simhash.near_duplicates(rows, id_col=row)
    # The copies are fewer than what stays, so they are what is joined.
    copies = groups.filter("doc_id <> component_id").select(F.col("doc_id").alias(row))
    return rows.join(copies, row, "left_anti").select(*docs.columns)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words that come again; those of which nothing is left go."""
    ship_package(spark)
    row = free_name(docs, "pipeline_row")
    rows = numbered(docs, "doc_id", row)
    cut = substring_dedup.changed_texts(rows, id_col=row, unique=True)
    kept = free_name(docs, "kept_text")
    cut = staged(cut.select(row, F.col("kept_text").alias(kept)), "cut")
    changed = {"text": F.coalesce(kept, "text"), "n_chars": F.when(F.col(kept).isNull(), F.col("n_chars")).otherwise(F.length(kept))}
    columns = [changed[c].cast(docs.schema[c].dataType).alias(c) if c in changed else F.col(c) for c in docs.columns]
    return rows.join(cut, row, "left").filter(F.col(kept).isNull() | (F.col(kept) != "")).select(*columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    ship_package(spark)
    row = free_name(docs, "pipeline_row")
    rows = numbered(docs, "doc_id", row)
    leaks = decontaminate.leaks(rows, table(spark, sf_dir, "benchmark"), id_col=row)
    return rows.join(leaks.select(row).distinct(), row, "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids): every document as token ids, and what they decode to."""
    ship_package(spark)
    return bpe.encode_texts(docs, tokenizer_path("word_bpe_49k.json"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify),
    ("SimHash near-dedup", drop_near_copies),
    ("substring dedup", cut_passages),
    ("benchmark decontamination", drop_leaks),
    ("BPE encoding and decoding", encode),
]

# No SQL has string kernels, Golay codes or byte-pair merges; tests/llm/test_pipeline.py has the whole in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    *before, (_, last) = STAGES
    for name, stage in before:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)
