"""Language ID and toxicity: held-out accuracy, and the edge cases of both."""

import math
import random

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from parcelscope.llm import language_id, toxicity
from parcelscope.llm.common import held_out, ship_package, table
from parcelscope.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def spark(spark):
    ship_package(spark)
    return spark


def test_language_of_held_out_documents(spark):
    found = QUERIES["op1_language_id"](spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    rows = found.filter("held_out").toPandas()
    assert len(rows) > 150
    assert (rows.lang == rows.lang_pred).mean() > 0.95
    assert rows.score.between(0, 1).all()


def test_language_edge_cases(spark):
    train = [("aa", "abab baab abba bab"), ("cc", "cdcd dccd cddc dcd")] * 3 + [(None, "abab"), ("aa", None), ("cc", "")]
    model = language_id.train(spark.createDataFrame(train, "label string, text string"))
    assert model.labels == ["aa", "cc"]
    texts = [(1, "baba abab", 5), (2, None, 5), (3, "", 5), (4, "12 !", 5), (5, "dcdc " * 300_000, 5), (1, "baba abab", 5), (None, "cdcd", 5)]
    docs = spark.createDataFrame(texts, "id int, text string, score int").withColumn("lang_pred", F.lit("old"))
    got = language_id.predict(docs, model).toPandas()
    assert list(got.columns) == ["id", "text", "lang_pred", "score"]
    assert got.lang_pred.tolist() == ["aa", "und", "und", "und", "cc", "aa", "cc"]
    assert got.score[1] == got.score[2] == got.score[3] == 0.0
    assert got.score[0] == got.score[5]


def test_language_without_rows(spark):
    nothing = spark.createDataFrame([], "label string, text string")
    assert language_id.train(nothing) is None
    docs = spark.createDataFrame([("abc",)], "text string")
    assert language_id.predict(docs, None).first().lang_pred == "und"
    assert language_id.predict(docs.limit(0), None).count() == 0


def test_presence_kernel_counts_shared_ngrams():
    a, b = (np.zeros(language_id.BUCKETS, dtype=bool) for _ in range(2))
    language_id.mark_ngrams("abc", a)  # a b c ab bc abc
    language_id.mark_ngrams("abd", b)
    assert a.sum() == 6
    assert (a & b).sum() == 3
    long = np.zeros(language_id.BUCKETS, dtype=bool)
    language_id.mark_ngrams("x" * (language_id._PIECE - 1) + "yz", long)
    assert long.sum() == 9  # x y z xx xy yz xxx xxy xyz, two of which cross the pieces


def exact_decisions(rows, texts, ridge):
    """Kernel ridge regression over all rows, without landmarks or hashing: (decision by label) of each text."""

    def ngrams(text):
        return {text.lower()[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)}

    def kernel(a, b):
        return np.array([[len(x & y) / np.sqrt(max(len(x), 1) * max(len(y), 1)) for y in b] for x in a])

    labels = sorted({k for k, _ in rows})
    grams = [ngrams(t) for _, t in rows]
    y = np.array([labels.index(k) for k, _ in rows])
    weight = (len(rows) / (len(labels) * np.bincount(y)))[y]
    # A weighted least squares fit with a free constant: its dual has coefficients that sum to nothing.
    system = np.block([[kernel(grams, grams) + ridge * len(rows) * np.diag(1 / weight), np.ones((len(rows), 1))], [np.ones((1, len(rows))), np.zeros((1, 1))]])
    target = np.vstack([np.where(y[:, None] == np.arange(len(labels)), 1.0, -1.0), np.zeros((1, len(labels)))])
    solved = np.linalg.solve(system, target)
    return labels, kernel([ngrams(t) for t in texts], grams) @ solved[:-1] + solved[-1]


def bitmap(text):
    seen = np.zeros(language_id.BUCKETS, dtype=bool)
    language_id.mark_ngrams(text, seen)
    return seen


def test_landmarks_against_exact_kernel_ridge(spark):
    docs = table(spark, SF, "documents").select("doc_id", "lang", F.substring("text", 1, 600).alias("text")).orderBy("doc_id").limit(320).collect()
    rows = [(r.lang, r.text) for r in docs[:160]]
    texts = [r.text for r in docs[160:]]
    labels, exact = exact_decisions(rows, texts, 1e-2)
    packed = [(k, np.packbits(bitmap(t)).tobytes()) for k, t in rows]
    seen = np.stack([bitmap(t) for t in texts])
    whole = language_id.fit(packed, len(rows), 1e-2)
    assert whole.labels == labels
    # With every row a landmark only hashed n-grams that meet in a bucket differ.
    assert np.abs(whole.decide(seen) - exact).max() < 0.1
    assert (whole.decide(seen).argmax(axis=1) == exact.argmax(axis=1)).mean() >= 0.98
    few = language_id.fit(packed, 40, 1e-2)
    assert few.landmarks.shape[1] == 40
    assert (few.decide(seen).argmax(axis=1) == exact.argmax(axis=1)).mean() >= 0.95


def test_ties_go_to_the_first_language(spark):
    model = language_id.train(spark.createDataFrame([("bb", "xyz xyz"), ("aa", "xyz xyz")], "label string, text string"))
    got = language_id.predict(spark.createDataFrame([("xyz",), ("q",)], "text string"), model).toPandas()
    assert got.lang_pred.tolist() == ["aa", "aa"]


def test_many_languages_all_have_landmarks(spark):
    chosen = random.Random(5)
    rows = [(f"l{k:03d}", "".join(chosen.choices([chr(0x4E00 + 8 * k + j) for j in range(6)], k=30))) for k in range(220) for _ in range(9)]
    frame = spark.createDataFrame(rows, "label string, text string")
    model = language_id.train(frame)
    assert len(model.labels) == 220 and model.landmarks.shape[1] == 4 * 220
    got = language_id.predict(frame, model).toPandas()
    assert (got.label == got.lang_pred).mean() > 0.95
    few = language_id.train(frame.union(frame.filter("label in ('l007', 'l100')").selectExpr("label", "concat(text, '.')")), max_languages=2)
    assert few.labels == ["l007", "l100"]


def test_repeated_texts_are_learned_once(spark):
    rows = [("aa", f"abab {k} baab") for k in range(20)] + [("cc", f"cdcd {k} dccd") for k in range(20)]
    one = language_id.train(spark.createDataFrame(rows, "label string, text string"))
    hot = spark.createDataFrame(rows + [rows[3]] * 3000, "label string, text string").repartition(5)
    many = language_id.train(hot)
    assert np.array_equal(one.weights, many.weights) and np.array_equal(one.landmarks, many.landmarks)


def test_least_share_of_known_ngrams(spark):
    known = table(spark, SF, "documents").filter("lang is not null")
    model = language_id.train(known.filter(~held_out(F.col("doc_id"))).selectExpr("lang as label", "text"))
    texts = known.filter(held_out(F.col("doc_id")))
    assert language_id.least_share(texts, model) == language_id.LEAST_SHARE
    assert language_id.least_share(texts.limit(0), model) == language_id.LEAST_SHARE
    # Where texts of known language share as little, the floor gives way.
    odd = texts.select("text").union(spark.createDataFrame([("\u0e01\u0e02\u0e03",)] * 3, "text string"))
    least = language_id.least_share(odd, model)
    assert least < 0.4
    shares = language_id.predict(odd, model, names=("l", "s", "known"))
    assert shares.filter(F.col("known") < least).count() == 0
    assert language_id.least_share(odd, model, lost=0.5) == language_id.LEAST_SHARE
    row = shares.filter("l = 'fr'").first()
    of_language = [n for n, lang in zip(model.held, model.labels) if lang == "fr"][0]
    held = set(model.active[of_language].tolist())
    mine = set(np.flatnonzero(bitmap(row.text)).tolist())
    assert row.known == pytest.approx(len(mine & held) / len(mine))


def auc(score, label):
    order = score.rank()
    ones = label.sum()
    return (order[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))


def test_toxicity_of_held_out_documents(spark):
    labels = table(spark, SF, "labels")
    rows = QUERIES["op2_toxicity"](spark, SF).join(labels.select("doc_id", "toxic"), "doc_id").toPandas()
    assert rows.score.between(0, 1).all()
    assert (rows.predicted == (rows.score >= 0.5)).all()
    # 40 toxic texts to learn from; the larger tables have thousands.
    assert auc(rows[rows.held_out].score, rows[rows.held_out].toxic) > 0.6
    assert auc(rows.score, rows.toxic) > 0.7


def test_toxicity_against_plain_compression(spark):
    """Each word compressed anew under either dictionary, and the fitted weights applied by hand."""
    docs = table(spark, SF, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, SF, "labels").filter(~held_out(F.col("doc_id"))))
    settings = zstandard.ZstdCompressionParameters.from_level(
        1, min_match=5, strategy=zstandard.STRATEGY_FAST, target_length=1, write_content_size=0, write_checksum=0,
        write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )

    def length(data, dictionary):
        packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), compression_params=settings)
        return len(packer.compress(data))

    toxic = [r.doc_id for r in table(spark, SF, "labels").filter("toxic = 1").orderBy("doc_id").limit(5).collect()]
    some = docs.filter(F.col("doc_id").isin(toxic) | (F.col("doc_id") % 200 == 7)).filter("length(text) < 3000")
    rows = toxicity.score(some, model).collect()
    assert len(rows) > 5
    for row in rows:
        words = row.text.lower().encode().split()
        gains = sorted((length(b" " + w + b" " + b"." * 24, model.ordinary) - length(b" " + w + b" " + b"." * 24, model.toxic) for w in words), reverse=True)
        beyond = [sum(g >= k for g in gains) for k in (2, 3, 4, 5, 6)]
        n = max(len(gains), 1)
        found = [gains[0], sum(gains[:3]), sum(gains[:8]), *beyond, beyond[1] / n, beyond[3] / n, math.log(1 + len(gains)), sum(gains) / n]
        z = sum((f - m) / s * w for f, m, s, w in zip(found, model.mean, model.scale, model.weights)) + model.weights[-1]
        assert row.score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-9)
        assert row.predicted == (row.score >= 0.5)


def test_toxicity_edge_cases(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    labels = table(spark, SF, "labels").filter(~held_out(F.col("doc_id")))
    model = toxicity.train(docs, labels.union(labels.limit(5)).union(labels.selectExpr("doc_id", "quality", "null").limit(5)))
    odd = [(1, None, "x"), (2, "", "x"), (None, "worthless " * 200_000, "x"), (1, None, "x")]
    got = toxicity.score(spark.createDataFrame(odd, "doc_id int, text string, predicted string"), model).toPandas()
    assert list(got.columns) == ["doc_id", "text", "score", "predicted"]
    assert got.score[0] == got.score[1] == got.score[3]
    assert got.score.between(0, 1).all()
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_with_one_class(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").limit(3)
    labels = table(spark, SF, "labels")
    assert toxicity.train(docs, labels.filter("toxic = 0")) == 0.0
    assert toxicity.train(docs, labels.filter("toxic = 1")) == 1.0
    assert toxicity.train(docs, labels.limit(0)) == 0.0
    assert toxicity.score(docs, 1.0).agg(F.min("predicted")).first()[0] == 1


def test_dictionary_of_few_samples():
    assert toxicity.train_dictionary([b" a "], 4096)
    assert toxicity.train_dictionary([], 4096)
    assert toxicity.Gains(b"worthless worthless", b"ordinary ordinary")[b" worthless "] > 0
