"""SimHash and substring dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from parcelscope.llm import components, simhash, substring_dedup
from parcelscope.llm.common import ship_package
from parcelscope.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def spark(spark):
    ship_package(spark)
    return spark


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(ids, prints):
    label = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            for j in range(len(ids)):
                if (prints[i] ^ prints[j]).bit_count() <= 3 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return [min(x for x, m in zip(ids, label) if m == own) for own in label]


def test_fingerprint():
    for text in ("", None, "One", "one two", "A b C d", "a a a a a", "é É à ab\x0bc\xa0d", "w " * 5000 + "end"):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_golay_code_is_perfect():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 2000)
    index = simhash.centre(words)
    assert 0 <= index.min() and index.max() < 1 << 12
    for errors in range(4):  # a codeword with up to three errors keeps its index
        code = simhash.centre(np.arange(1 << 23, step=4099))
        _, pattern = simhash._correction()
        low, high = simhash._syndromes()
        word = words ^ pattern[low[words & 0xFFF] ^ high[words >> 12]]
        for _ in range(errors):
            word = word ^ (1 << rng.integers(0, 23, len(word)))
        assert (simhash.centre(word) == index).all() and len(code)
    assert max(len(set(r)) for r in simhash.reach(words)) == 6


def test_linked_fingerprints_share_a_key():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 62, 3000).astype(np.uint64)
    b = a.copy()
    for _ in range(3):
        b ^= np.uint64(1) << rng.integers(0, 64, len(a)).astype(np.uint64)
    keys_a, keys_b = (set(zip(*(x.tolist() for x in simhash.keys(p.view(np.int64))))) for p in (a, b))
    assert {row for row, _ in keys_a & keys_b} == set(range(3000))


def chain(rng, base, steps):
    """Fingerprints that each differ from the one before in up to three bits."""
    out = [base]
    for _ in range(steps):
        at = out[-1]
        for _ in range(rng.randint(1, 3)):
            at ^= 1 << rng.randrange(64)
        out.append(at)
    return out


@pytest.mark.parametrize("bucket", [4096, 3])
def test_components_of_fingerprints(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "MAX_BUCKET", bucket)  # 3: every group of copies is cut into blocks
    rng = random.Random(bucket)
    prints = [p for _ in range(6) for p in chain(rng, rng.getrandbits(64), 12)] + [rng.getrandbits(64) for _ in range(30)]
    prints = list(dict.fromkeys(prints))
    expected = plain_components(list(range(len(prints))), prints)
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in prints]
    roots = components.components(simhash.links(spark.createDataFrame(signed, "fp long"))).collect()
    root = {r.node: r.root for r in roots}
    label = [root.get(s[0], s[0]) for s in signed]
    assert [label.index(x) for x in label] == [expected.index(x) for x in expected]


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7), (None, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_edge_cases(spark):
    rng = random.Random(3)
    long = " ".join(f"w{rng.randrange(500)}" for _ in range(3000))
    rows = [(9, long), (4, long), (7, long + " x"), (5, None), (6, ""), (8, "\x0b "), (3, "Ab"), (2, "aB"), (3, "Ab"), (None, long)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, fp int, root int")
    got = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in got) == sorted(
        [(False, 9, 4), (False, 4, 4), (False, 7, 4), (False, 5, 5), (False, 6, 5), (False, 8, 5), (False, 3, 2), (False, 2, 2), (False, 3, 2), (True, 0, 4)]
    )
    assert {r.fingerprint for r in got if r.doc_id in (5, 6, 8)} == {"0" * 16}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_fingerprint(d.text) for d in docs]
    expected = plain_components([d.doc_id for d in docs], prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op3_simhash"](spark, SF).collect()}
    assert got == {d.doc_id: (f"{p:016x}", c) for d, p, c in zip(docs, prints, expected)}


# --- substring dedup ------------------------------------------------------------------------


def plain_dedup(rows):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[k : k + 35]) for _, w in split for k in range(len(w) - 34))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone.update(range(k, k + 35))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def key(row):
    return tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in row)


def check_dedup(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows], "doc_id long, text string, row int, positions string")
    got = [tuple(r) for r in substring_dedup.dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()]
    assert sorted(got, key=key) == sorted(plain_dedup(rows), key=key)


def words(rng, n, kinds=10_000):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


def test_difference_cover():
    cover = set(substring_dedup.COVER)
    assert {(a - b) % 21 for a in cover for b in cover} == set(range(21))


def test_substring_edge_cases(spark):
    rng = random.Random(5)
    exact, near = words(rng, 35), words(rng, 34)
    long = words(rng, 20_000)
    rows = [
        (1, f"{words(rng, 17)} {exact} {words(rng, 3)}"), (2, f"{exact}\n{words(rng, 60)}"),
        (3, f"{words(rng, 5)} {near} {words(rng, 9)}"), (4, f"{near} {words(rng, 40)}"),
        (5, None), (6, ""), (7, "\x0b \t"), (8, "one"), (9, "same " * 80), (10, long), (11, f"{words(rng, 11)} {long[: len(long) // 2]}"),
        (12, f"{exact.replace(' ', chr(9))} a\xa0b"), (13, f"{words(rng, 21)} {exact} {words(rng, 30)} {exact}"),
    ]
    check_dedup(spark, rows)
    check_dedup(spark, [])


def test_substring_repeated_and_null_ids(spark):
    rng = random.Random(6)
    a, b = words(rng, 50), words(rng, 70)
    check_dedup(spark, [(1, a), (1, a), (None, b), (None, f"{words(rng, 4)} {b}"), (1, words(rng, 90)), (2, None)])


@pytest.mark.parametrize("seed", range(3))
def test_substring_random(spark, monkeypatch, seed):
    monkeypatch.setattr(substring_dedup, "_FLUSH", 50)
    rng = random.Random(seed)
    shared = [words(rng, rng.randint(30, 90)) for _ in range(6)]
    rows = [
        (i, " ".join(rng.choice([words(rng, rng.randint(0, 40), 3 + 5000 * (i % 2)), rng.choice(shared)]) for _ in range(rng.randint(0, 6))))
        for i in range(40)
    ]
    check_dedup(spark, rows)


def test_changed_texts(spark):
    rng = random.Random(8)
    a = words(rng, 40)
    rows = [(1, f"x {a} y"), (2, a), (3, words(rng, 50))]
    got = {r.doc_id: r.kept_text for r in substring_dedup.changed_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "x y", 2: ""}


def test_substring_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op4_substring_dedup"](spark, SF).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(plain_dedup(docs))
