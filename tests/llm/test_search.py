"""Nearest neighbours against brute force; decontamination against planted leaks."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelscope.llm import ann, decontaminate
from parcelscope.llm.common import ship_package, table
from parcelscope.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def spark(spark):
    ship_package(spark)
    return spark


def brute_force(rows, k, every):
    """{query: [(vec_id, score)]} over usable rows."""
    kept = {(i, tuple(v)) for i, v in rows if i is not None and v and len(v) == len(rows[0][1]) and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    kept = sorted(kept)
    ids = np.array([i for i, _ in kept])
    matrix = np.array([v for _, v in kept], dtype=np.float32).astype(np.float64)
    out = {}
    for i, v in kept:
        if i % every == 0:
            scores = (matrix * np.array(v, dtype=np.float32).astype(np.float64)).sum(axis=1)
            best = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(scores[j])) for j in best]
    return out


def found(frame, k, every):
    out = {}
    for r in ann.search(frame, F.col("vec_id") % every == 0, k).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_neighbours_of_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((60, 5)).astype(np.float32))]
    same = [0.5, 0.25, -1.0, 2.0, 0.0]
    rows += [(100 + i, same) for i in range(40)] + [(100, same)]  # more equal vectors than neighbours asked for
    rows += [(200, None), (201, [0.0] * 5), (202, [None, 1.0, 1.0, 1.0, 1.0]), (203, [float("nan")] * 5), (204, [float("inf"), 1.0, 1.0, 1.0, 1.0])]
    rows += [(205, [1.0] * 4), (206, []), (None, same), (300, [9.0] * 5)]
    frame = spark.createDataFrame([(i, v, 0.0) for i, v in rows], "vec_id long, embedding array<float>, score double")
    assert found(frame, 20, 5) == brute_force(rows, 20, 5)
    assert ann.search(frame.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    assert ann.search(frame.filter("vec_id in (201, 203)"), F.col("vec_id") % 5 == 0).count() == 0
    assert found(frame.filter("vec_id < 4"), 20, 2) == brute_force(rows[:4], 20, 2)


def test_recall_over_many_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE", 600)
    monkeypatch.setattr(ann, "BLOCK", 50)
    monkeypatch.setattr(ann, "PACK", 10)
    rng = np.random.default_rng(4)
    middles = rng.standard_normal((15, 48)) * 2
    vectors = (middles[rng.integers(0, 15, 3000)] + rng.standard_normal((3000, 48))).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    got, true = found(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 20, 20), brute_force(rows, 20, 20)
    assert got.keys() == true.keys() and all(len(v) == 20 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in true[q]}) / 20 for q in true]) >= 0.9
    scores = {(q, i): s for q, v in got.items() for i, s in v}
    assert all(s == scores[q, i] for q, v in true.items() for i, s in v if (q, i) in scores)


def test_scan_abandons_far_candidates():
    rng = np.random.default_rng(5)
    near, far = rng.standard_normal((50, 64)) * 0.1, rng.standard_normal((950, 64)) * 3
    left = ann.scan(np.zeros(64, np.float32), np.vstack([near, far]).astype(np.float32), 1.5, 21)
    assert set(left) <= set(range(50)) and len(left) >= 21


def test_ann_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in table(spark, SF, "embeddings").collect()]
    got = {}
    for r in QUERIES["op6_ann"](spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == brute_force(rows, 20, 20)


@pytest.mark.parametrize("longer", [10**4, 10**6])
def test_one_long_vector_hides_no_neighbours(spark, monkeypatch, longer):
    monkeypatch.setattr(ann, "SAMPLE", 600)
    rng = np.random.default_rng(9)
    vectors = rng.standard_normal((2500, 32)).astype(np.float32)
    vectors[7] *= longer
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    got, true = found(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 20, 25), brute_force(rows, 20, 25)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in true[q]}) / 20 for q in true]) >= 0.9


def test_scan_keeps_all_within_the_threshold():
    rng = np.random.default_rng(10)
    near = rng.standard_normal((500, 64)).astype(np.float32) * 0.01
    assert len(ann.scan(np.zeros(64, np.float32), near, 1.5, 21)) == 500


def frame_of(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")


def test_no_vectors_as_rows_on_the_driver_and_no_row_for_each_list(spark, monkeypatch):
    vectors = np.random.default_rng(16).standard_normal((2000, 24)).astype(np.float32)
    frame, collected, written = frame_of(spark, vectors), [], {}
    plain_collect, plain_staged = type(frame).collect, ann.staged

    def collect(self):
        rows = plain_collect(self)
        collected.append((len(rows), self.columns))
        return rows

    def staged(df, name):
        out = plain_staged(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(type(frame), "collect", collect)
    monkeypatch.setattr(ann, "staged", staged)
    assert ann.search(frame, F.col("vec_id") % 20 == 0, 20).count() == 100 * 20
    assert collected and all(n <= 2000**0.5 + 1 and "v" not in columns for n, columns in collected)
    assert sum(written.values()) <= 2000 + 100


def test_shelves_and_packs_of_any_size_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(17)
    vectors = rng.standard_normal((1200, 16)).astype(np.float32)
    vectors[300:900] = vectors[5] + rng.standard_normal((600, 16)).astype(np.float32) * 0.01  # a crowded list
    frame = frame_of(spark, vectors)
    monkeypatch.setattr(ann, "SAMPLE", 400)
    whole = found(frame, 20, 10)
    monkeypatch.setattr(ann, "LEAST_SHELF", 50)
    monkeypatch.setattr(ann, "HELD", 50 * 4 * 16)  # 50 vectors a shelf, 50 queries a pack
    assert found(frame, 20, 10) == whole
    true = brute_force([(i, list(map(float, v))) for i, v in enumerate(vectors)], 20, 10)
    assert np.mean([len({i for i, _ in whole[q]} & {i for i, _ in true[q]}) / 20 for q in true]) >= 0.9


def test_equal_scores_are_settled_by_id(spark):
    rng = np.random.default_rng(18)
    vectors = [(i, [1.0, *(float(x) for x in rng.integers(-40, 40, 5))]) for i in range(1, 31)] + [(400, [2.0, 0.0, 0.0, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame(vectors[::-1], "vec_id long, embedding array<float>")
    assert found(frame, 3, 400) == {400: [(1, 2.0), (2, 2.0), (3, 2.0)]}


def test_match_keeps_the_best_however_often_it_settles(monkeypatch):
    rng = np.random.default_rng(19)
    vectors = rng.standard_normal((900, 40)).astype(np.float32)
    bands = ann.Bands(np.arange(900), vectors, np.zeros(900, dtype=int), {0: (900, float(np.linalg.norm(vectors, axis=1).max()))}, 6)
    space = bands.spaces[0]
    space.probes = len(space.centres)
    lists = ann._nearest(space.candidates(vectors), space.centres, 1)[:, 0]
    asked, exact = vectors[:70], vectors.astype(np.float64)
    true = {(q, int(i)) for q, x in enumerate(exact[:70]) for i in np.argsort(-(exact @ x))[:6]}
    for found_pairs in (10, 1 << 20):
        monkeypatch.setattr(ann, "FOUND", found_pairs)
        at, uids, scores = ann.match(bands, lists, np.arange(900), vectors, asked, np.full(70, -np.inf))
        assert {(int(q), int(i)) for q, i in zip(at, uids)} == true
        assert np.allclose(scores, (exact[uids] * exact[at]).sum(axis=1), rtol=1e-12)


def test_survivors_alike_whatever_the_first_block():
    rng = np.random.default_rng(20)
    queries, near, far = rng.standard_normal((9, 64)) * 0.01, rng.standard_normal((30, 64)) * 0.01, rng.standard_normal((300, 64))
    candidates = np.vstack([near, far]).astype(np.float32)
    for head in (16, 32, 64):
        at, of = ann.survivors(queries.astype(np.float32), candidates, np.full(9, 1.5), head)
        assert set(zip(at.tolist(), of.tolist())) == {(a, b) for a in range(9) for b in range(30)}


# --- decontamination ------------------------------------------------------------------------


def test_common_subsequence():
    rng = random.Random(6)
    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(1, 12))] for _ in range(2))
        rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
        assert decontaminate.common_subsequence(a, b) == rows[-1][-1]


def words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 6))) for _ in range(n))


def test_planted_leaks(spark):
    rng = random.Random(7)
    items = [(i, words(rng, n)) for i, n in enumerate((12, 18, 25, 33, 45, 60, 80, 150))]
    items += [(20, "too few words"), (21, None), (22, ""), (None, words(rng, 20)), (23, items[0][1])]
    docs, leaks = [], set()
    for n, (i, text) in enumerate(items[:8]):
        w = text.split()
        docs.append((10 * n, f"{words(rng, rng.randint(0, 90))} {text.upper()}. {words(rng, 70)}"))
        changed = [x if k % 6 else words(rng, 1) for k, x in enumerate(w)]  # a word in six replaced
        docs.append((10 * n + 1, f"{words(rng, 37)} {', '.join(changed)}!\n{words(rng, 300)}"))
        leaks |= {(10 * n, i), (10 * n + 1, i)}
        docs.append((10 * n + 2, f"{words(rng, 40)} {' '.join(w[: len(w) // 3])} {words(rng, 100)}"))  # a third of it is no leak
        docs.append((10 * n + 3, f"{' '.join(rng.sample(w, len(w)))} {words(rng, 30)}"))  # nor are its words in another order
    leaks |= {(0, 23), (1, 23)}
    docs += [(900, None), (901, ""), (902, words(rng, 30_000)), (None, items[2][1]), (0, docs[0][1])]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, terms int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.leaks(frame, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == leaks | {(None, 2)}
    assert len(got) == len(leaks) + 1
    assert decontaminate.leaks(frame, bench.limit(0)).count() == 0
    assert decontaminate.leaks(frame.limit(0), bench).count() == 0


def test_more_items_than_the_space_holds(spark):
    rng = np.random.default_rng(13)
    share = 1 / np.arange(1, 6001)
    share /= share.sum()
    draw = lambda n: [f"w{k}" for k in rng.choice(6000, n, p=share)]
    items = [(i, draw(n)) for i, n in enumerate(rng.integers(6, 61, 1100).tolist())]
    docs, expected = [], set()
    for i, w in items:
        edited = [x if k % 6 != 5 else "other" for k, x in enumerate(w)]  # a word in six replaced
        for kind, leak in enumerate((w, edited)):
            docs.append((10 * i + kind, " ".join(draw(int(rng.integers(20, 60))) + leak + draw(40))))
            # A short item of common words leaks as it is, not edited; the rarer half of them surely is found.
            if not kind or len(w) >= decontaminate.SHORT or sum(int(x[1:]) >= 60 for x in w) >= decontaminate.RARE:
                expected.add((10 * i + kind, i))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert expected <= got
    assert len(got - expected) < 0.1 * len(expected)  # of 2.4 million pairs; a word in nine is the same one here


def test_paraphrase_needs_the_answer():
    part = decontaminate.Part(1, list(range(20)), [17, 18, 19], 20)
    loose = [x for x in range(20) if x % 3 or x > 16]  # 65 percent and the answer
    assert decontaminate.is_leak(part, loose)[0]
    assert not decontaminate.is_leak(part, [x for x in range(17) if x % 5])[0]
    assert decontaminate.is_leak(part, list(range(16)))[0]


def test_leaks_of_documents(spark):
    items = {r.item_id: decontaminate.words_of(r.text) for r in table(spark, SF, "benchmark").collect()}
    expected = set()
    for d in table(spark, SF, "documents").select("doc_id", "text").collect():
        text = b" " + b" ".join(decontaminate.words_of(d.text)) + b" "
        expected |= {(d.doc_id, i) for i, w in items.items() if b" " + b" ".join(w) + b" " in text}
    assert expected
    assert {(r.doc_id, r.item_id) for r in QUERIES["op8_decontaminate"](spark, SF).collect()} == expected


def test_short_items_and_scripts_without_blanks(spark):
    items = [(1, "paris"), (2, "forty two"), (3, "the answer is no"), (4, "法国的首都是哪里"), (5, "...")]
    docs = [
        (1, "Flights to Paris leave daily."), (2, "forty and two"), (3, "Forty-two!"), (4, "he said: the answer is no, thanks"),
        (5, "the answer surely is no"), (6, "问题：法国的首都是哪里？答案"), (7, "法国的首都很大"), (8, "parisian"), (9, None),
    ]
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(1, 1), (3, 2), (4, 3), (6, 4)}


def test_common_words_in_any_place_are_no_leak(spark):
    """Items of the most frequent words stand in a text only if they stand together."""
    rng = random.Random(14)
    common = "the of and to in a is that it for on was".split()
    text = lambda n: " ".join(rng.choice(common) if rng.random() < 0.4 else words(rng, 1) for _ in range(n))
    items = [(k, " ".join(rng.sample(common, size))) for k, size in enumerate([6] * 10 + [10] * 10)]
    docs = [(k, text(400)) for k in range(150)]
    planted = {(1000 + k, k) for k, _ in items}
    docs += [(1000 + k, f"{words(rng, 60)} {t} {words(rng, 60)}") for k, t in items]
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    found = {(r.doc_id, r.item_id) for r in got.collect()}
    assert planted <= found
    assert len(found - planted) < 0.02 * 150 * len(items)


def test_latent_space_finds_what_it_holds(spark):
    """Keys are for the blind spots alone: without them, items of 12 words and more are found all the same."""
    rng = random.Random(15)
    items = [(k, words(rng, rng.randint(12, 60))) for k in range(100)]
    docs = [(k, f"{words(rng, rng.randint(0, 200))} {t} {words(rng, 100)}") for k, t in items]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    bench = decontaminate.Benchmark([(k, t, None) for k, t in items])
    keys = decontaminate.Keys(bench.parts, np.ones(len(bench.terms), dtype=np.int64), np.zeros(len(bench.parts), dtype=bool))
    assert not len(keys.windows(np.arange(50), np.arange(50)))
    got = decontaminate.leaks(*frames).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(k, k) for k, _ in items}
    assert min(r.cosine for r in got) >= decontaminate.COSINE
