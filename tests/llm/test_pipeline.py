"""The corpus pipeline against plain Python."""

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from parcelscope.llm import decontaminate
from parcelscope.llm.common import ship_package, staged, table
from parcelscope.llm.queries import tokenizer_path
from test_dedup import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def spark(spark):
    ship_package(spark)
    return spark


def plain_pipeline(docs, items):
    """{doc_id: text} of what the pipeline keeps."""
    docs = [(i, t) for i, t in docs if t and any(c.isalpha() for c in t)]
    groups = plain_components([i for i, _ in docs], [plain_fingerprint(t) for _, t in docs])
    docs = [d for d, g in zip(docs, groups) if d[0] == g]
    seen = {}
    for _, t in docs:
        w = t.encode().split()
        for k in range(len(w) - 34):
            seen[tuple(w[k : k + 35])] = seen.get(tuple(w[k : k + 35]), 0) + 1
    cut = []
    for i, t in docs:
        w = t.encode().split()
        gone = {j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(k, k + 35)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone).decode() if gone else t
        if kept:
            cut.append((i, kept))
    return {i: t for i, t in cut if not any(b" " + b" ".join(x) + b" " in b" " + b" ".join(decontaminate.words_of(t)) + b" " for x in items)}


def test_pipeline(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    expected = plain_pipeline(docs, [decontaminate.words_of(r.text) for r in table(spark, SF, "benchmark").collect()])
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {i: library.encode(t, add_special_tokens=False).ids for i, t in expected.items()}


def test_stages_with_odd_rows(spark):
    docs = table(spark, SF, "documents").limit(60)
    odd = [(None, "alpha beta gamma delta"), (None, "alpha beta gamma delta"), (3, "epsilon zeta eta"), (3, "theta iota"), (5, None), (6, ""), (7, "12 34")]
    more = spark.createDataFrame([(i, t, None, None, len(t) if t else None) for i, t in odd], docs.schema)
    rows = docs.filter("doc_id > 10").union(more).withColumn("score", F.lit(1)).withColumn("row", F.lit("x"))
    for name in ("pipeline_row", "pipeline_score", "kept_text", "has_letter"):
        rows = rows.withColumn(name, F.lit("y"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, rows, SF), "stage")
        assert out.columns == rows.columns, name
        assert out.select("score", "row", "pipeline_row", "pipeline_score", "kept_text", "has_letter").distinct().count() <= 1, name
        rows = out
    kept = [(r.doc_id, r.text) for r in rows.collect() if r.doc_id is None or r.doc_id < 10]
    assert sorted(kept, key=str) == sorted([(None, "alpha beta gamma delta"), (3, "epsilon zeta eta"), (3, "theta iota")], key=str)
    assert corpus_pipeline.STAGES[-1][1](spark, rows, SF).count() == rows.count()
    empty = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_noise_goes_and_documents_stay(spark):
    docs = table(spark, SF, "documents")
    noise = ["0x7f3a 0x9b21 q 0xff00 ^^ ||", "{}();;0x00ff==a", "###### ------ z 0000", "\u0e01"]
    more = spark.createDataFrame([(-1 - i, t, None, None, len(t)) for i, t in enumerate(noise)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.identify(spark, docs.union(more), SF).collect()}
    assert kept == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}


def test_texts_with_letters_stay_where_no_language_is_known(spark):
    docs = table(spark, SF, "documents").withColumn("lang", F.lit(None).cast("string"))
    more = spark.createDataFrame([(-1, "12 34", None, None, 5), (-2, None, None, None, None), (-3, "", None, None, 0)], docs.schema)
    kept = corpus_pipeline.identify(spark, docs.union(more), SF)
    assert kept.columns == docs.columns
    letters = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in kept.collect()} == letters and len(letters) > 150
