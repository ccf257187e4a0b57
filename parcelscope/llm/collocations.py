"""Collocations: the phrases of two or three words that belong together most, for each language.

Phrases grow by a word, best first. Of a phrase w1 w2 that comes c times, no extension w1 w2 w3 can come
more often than w2 w3 does, so with the cut after w1 its score a*a / (f(w1) * f(w2 w3)) is at most
c / f(w1): the counts of a prefix bound the score of all that grows from it, and of the prefix too.
Phrases of two words are counted first. Then, in waves, the prefixes with the highest bounds of each
language are expanded, all with the bound of the last one included, by one pass over the texts that counts
their extensions, and what they themselves extend. When `top` surviving phrases score at least the bound of
the wave, nothing unexpanded can reach them, nor tie with them: the language is settled. Else the next wave
takes four times as many.

A pass never shuffles a phrase that cannot count: tasks sum what they read first, and a Bloom filter of
fixed greatest size tells them which words come often enough and which prefixes are wanted. What it lets
through by mistake is counted exactly and does no harm.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelscope.llm.common import staged

TOP, MIN_COUNT, WITHIN = 2000, 10, 50  # WITHIN: percent of a phrase's uses inside one longer phrase that drop it
FIRST_WAVE = 4 * TOP
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
NO_LANGUAGE = "und"
_BREAK = b"."  # no word is one: it stands for every separator
_TO_BREAK = bytes.maketrans(SEPARATORS, _BREAK * len(SEPARATORS))
_CHUNK = 1 << 20  # bytes of a text that are split at once
_WORDS, _HELD = 500_000, 3_000_000  # words and phrases a task keeps before it hands on what it has
_ID_BITS = 21  # a chunk brings half a million words at most, so numbers stay below _WORDS and that
_SEED = 42
_MIN_BITS, _MAX_BITS, _PROBES = 1 << 20, 1 << 27, 3
_BUCKET_BITS = 32768  # bits of a filter that one row of its table holds


# --- words ----------------------------------------------------------------------------------


def chunks(text: str | None) -> Iterator[list[bytes]]:
    """Words of a text in lists of bounded length, with `_BREAK` where a piece ends."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower().translate(_TO_BREAK)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + _CHUNK)
        end = len(raw) if end < 0 else end
        yield raw[at:end].replace(_BREAK, b" . ").split()
        at = end


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n); the empty word, which no text has, stands for all words."""
    counts: dict[str, Counter] = {}

    def handed() -> Iterator[pa.RecordBatch]:
        for lang, words in counts.items():
            words.pop(_BREAK, None)
            words[b""] = words.total()
            columns = [pa.array([lang] * len(words), pa.string()), _strings(list(words)), pa.array(words.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])
        counts.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            held = counts.setdefault(lang, Counter())
            for words in chunks(text.as_py()):
                held.update(words)
        if sum(map(len, counts.values())) > _WORDS:
            yield from handed()
    yield from handed()


# --- filters of bounded size ----------------------------------------------------------------


class Filter:
    """A Bloom filter over 64-bit hashes."""

    def __init__(self, bits: bytes):
        self.bits, self.mask = bits, len(bits) * 8 - 1

    def __contains__(self, value: int) -> bool:
        step = value >> 32 | 1
        for j in range(_PROBES):
            at = value + j * step & self.mask
            if not self.bits[at >> 3] >> (at & 7) & 1:
                return False
        return True

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        bits, found = np.frombuffer(self.bits, dtype=np.uint8), np.ones(len(hashes), dtype=bool)
        for probe in probes(hashes, np.uint64(self.mask)):
            found &= (bits[probe >> np.uint64(3)] >> (probe & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def probes(hashes: np.ndarray, mask: np.uint64) -> list[np.ndarray]:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return [(hashes + np.uint64(j) * step) & mask for j in range(_PROBES)]


def word_seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), _SEED)


def pair_hash(first: np.ndarray, second: np.ndarray, kind: int) -> np.ndarray:
    """Hash of two words by their hashes; `kind` 0 asks for what begins with them, 1 for what ends so."""
    mixed = first * np.uint64(0x9E3779B97F4A7C15) + (second ^ (second >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB + 2 * kind)
    return mixed ^ (mixed >> np.uint64(32))


def build_filter(keys: DataFrame) -> Filter:
    """Filter of `keys`: (lang, word), or (lang, w1, w2, kind). Its size follows their number up to `_MAX_BITS`."""
    bits = _MIN_BITS
    n = keys.count()
    while bits < min(16 * n, _MAX_BITS):
        bits *= 2
    pairs = "kind" in keys.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: dict[str, int] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lang in set(langs) - seeds.keys():
                seeds[lang] = word_seed(lang)

            def hashed(name: str) -> np.ndarray:
                digests = (xxhash.xxh64_intdigest(w.encode(), seeds[k]) for k, w in zip(langs, batch.column(name).to_pylist()))
                return np.fromiter(digests, dtype=np.uint64, count=len(langs))

            if pairs:
                first, second, kind = hashed("w1"), hashed("w2"), batch.column("kind").to_numpy()
                hashes = np.where(kind == 0, pair_hash(first, second, 0), pair_hash(first, second, 1))
            else:
                hashes = hashed("word")
            at = np.concatenate(probes(hashes, np.uint64(bits - 1))).astype(np.int64)
            columns = [pa.array((at // _BUCKET_BITS).astype(np.int32)), pa.array(at % _BUCKET_BITS)]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "bit"])

    found = keys.mapInArrow(run, "bucket int, bit long").groupBy("bucket").agg(F.expr("bitmap_construct_agg(bit)").alias("bits"))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in found.toLocalIterator():  # at most _MAX_BITS / _BUCKET_BITS rows, 16 MB
        at = row["bucket"] * (_BUCKET_BITS // 8)
        out[at : at + _BUCKET_BITS // 8] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return Filter(out.tobytes())


# --- phrases --------------------------------------------------------------------------------


class _Vocabulary(dict):
    """Numbers of a language's words that come often enough; 0 for all others and for a break."""

    def __init__(self, lang: str, frequent: Filter):
        super().__init__({_BREAK: 0})
        self.seed, self.frequent = word_seed(lang), frequent
        self.words, self.hashes = [_BREAK], array("Q", [0])
        self.held: list[tuple[np.ndarray, np.ndarray]] = []  # (phrases, counts)

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, self.seed)
        at = 0
        if value in self.frequent:
            at = len(self.words)
            self.words.append(word)
            self.hashes.append(value)
        self[word] = at
        return at

    def add(self, phrases: np.ndarray) -> None:
        if len(phrases):
            self.held.append(np.unique(phrases, return_counts=True))

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.held:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        keys, back = np.unique(np.concatenate([k for k, _ in self.held]), return_inverse=True)
        counts = np.bincount(back, weights=np.concatenate([n for _, n in self.held])).astype(np.int64)
        self.held = [(keys, counts)]
        return keys, counts


def _phrases(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(phrases of `size` words as one number each, where each starts)"""
    keys = ids[: len(ids) - size + 1].copy()
    whole = keys > 0
    for k in range(1, size):
        part = ids[k : len(ids) - size + 1 + k]
        keys = keys << _ID_BITS | part
        whole &= part > 0
    at = np.flatnonzero(whole)
    return keys[at], at


def phrase_counts(rows: DataFrame, size: int, frequent: Filter, wanted: Filter | None = None) -> DataFrame:
    """(lang, w1, w2[, w3], n): exact counts of phrases of `size` words in `rows` (lang, text).

    Phrases with a word that `frequent` lacks are left out, and, with `wanted`, those of three words of which
    neither the first two nor the last two are wanted.
    """
    names = ["lang", *(f"w{k + 1}" for k in range(size)), "n"]
    shared = rows.sparkSession.sparkContext.broadcast((frequent, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, wanted = shared.value
        known: dict[str, _Vocabulary] = {}

        def handed(langs: list[str]) -> Iterator[pa.RecordBatch]:
            for lang in langs:
                words = known.pop(lang)
                keys, counts = words.summed()
                texts = _strings(words.words)
                for start in range(0, len(keys), 1 << 16):
                    part = keys[start : start + (1 << 16)]
                    columns = [pa.array([lang] * len(part), pa.string())]
                    for k in range(size):
                        at = part >> (_ID_BITS * (size - 1 - k)) & ((1 << _ID_BITS) - 1)
                        columns.append(texts.take(pa.array(at)))
                    columns.append(pa.array(counts[start : start + (1 << 16)]))
                    yield pa.RecordBatch.from_arrays(columns, names)

        def count(words: _Vocabulary, numbers: list[int]) -> None:
            if len(numbers) < size:
                return
            ids = np.array(numbers, dtype=np.int64)
            keys, at = _phrases(ids, size)
            if wanted is not None and len(at):
                hashes = np.frombuffer(words.hashes, dtype=np.uint64)
                one, two, three = (hashes[ids[at + k]] for k in range(3))
                keys = keys[wanted.holds(pair_hash(one, two, 0)) | wanted.holds(pair_hash(two, three, 1))]
            words.add(keys)

        for batch in batches:
            parts: dict[str, list[int]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for found in chunks(text.as_py()):
                    words = known.get(lang)
                    if words is None:
                        words = known[lang] = _Vocabulary(lang, frequent)
                    ids = parts.setdefault(lang, [])
                    ids.extend(map(words.__getitem__, found))
                    full = len(words) > _WORDS
                    if full or len(ids) > 1 << 20:  # the text may go on, so its last words begin the next part too
                        count(words, ids)
                        last = [words.words[k] for k in ids[1 - size :]]
                        if full:
                            yield from handed([lang])
                            words = known[lang] = _Vocabulary(lang, frequent)
                        parts[lang] = list(map(words.__getitem__, last))
                if lang in parts:
                    parts[lang].append(0)
            for lang, ids in parts.items():
                count(known[lang], ids)
            if sum(len(k) for w in known.values() for k, _ in w.held) > _HELD or sum(map(len, known.values())) > 2 * _WORDS:
                if sum(len(w.summed()[0]) for w in known.values()) > _HELD // 2 or sum(map(len, known.values())) > 2 * _WORDS:
                    yield from handed(list(known))
        yield from handed(list(known))

    kinds = ", ".join(f"{n} {'long' if n == 'n' else 'string'}" for n in names)
    return rows.mapInArrow(run, kinds).groupBy(*names[:-1]).agg(F.sum("n").alias("n"))


# --- scores ---------------------------------------------------------------------------------


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def score_of(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) without rounding: products have up to 38 digits."""
    over = (_exact(a) * _exact(a)).cast("decimal(38,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    under = (_exact(left) * _exact(right)).cast("decimal(38,0)")
    return F.call_function("div", over.cast("decimal(38,0)"), under).cast("long")


def score_pairs(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """`pairs` (lang, w1, w2, a) with l, r, score and `bound`, which no phrase that begins so exceeds."""
    left = words.select("lang", F.col("word").alias("w1"), F.col("n").alias("l"))
    right = words.select("lang", F.col("word").alias("w2"), F.col("n").alias("r"))
    bound = F.call_function("div", _exact("a") * F.lit(1_000_000).cast("decimal(7,0)"), _exact("l")).cast("long")
    joined = pairs.join(left, ["lang", "w1"]).join(right, ["lang", "w2"])
    return joined.select("lang", "w1", "w2", "a", "l", "r", score_of("a", "l", "r").alias("score"), bound.alias("bound"))


def score_triples(triples: DataFrame, pairs: DataFrame, words: DataFrame) -> DataFrame:
    """`triples` (lang, w1, w2, w3, a) with l, r and score of the lower of both cuts, the first if they tie."""
    one = words.select("lang", F.col("word").alias("w1"), F.col("n").alias("l1"))
    two = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r1"))
    three = pairs.select("lang", "w1", "w2", F.col("a").alias("l2"))
    four = words.select("lang", F.col("word").alias("w3"), F.col("n").alias("r2"))
    joined = triples.join(one, ["lang", "w1"]).join(two, ["lang", "w2", "w3"]).join(three, ["lang", "w1", "w2"]).join(four, ["lang", "w3"])
    cuts = joined.withColumn("s1", score_of("a", "l1", "r1")).withColumn("s2", score_of("a", "l2", "r2"))
    first = F.col("s1") <= F.col("s2")
    return cuts.select(
        "lang", "w1", "w2", "w3", "a",
        F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )


# --- growth ---------------------------------------------------------------------------------


def _floors(levels: DataFrame, waves: DataFrame) -> DataFrame:
    """(lang, floor): the bound down to which a wave goes, -1 for all. `levels` counts prefixes by bound, `waves` has their number."""
    down = Window.partitionBy("lang").orderBy(F.desc("bound")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = levels.withColumn("so_far", F.sum("prefixes").over(down)).join(waves, "lang")
    return reached.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("so_far") >= F.col("wave"), F.col("bound"))), F.lit(-1)).alias("floor"))


def _survivors(pairs: DataFrame, triples: DataFrame, floors: DataFrame, within: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) of phrases that score at least their language's floor and are not dropped."""
    inside = (
        triples.select("lang", F.col("w1").alias("x"), F.col("w2").alias("y"), "a")
        .union(triples.select("lang", F.col("w2").alias("x"), F.col("w3").alias("y"), "a"))
        .groupBy("lang", "x", "y")
        .agg(F.max("a").alias("longer"))
        .select("lang", F.col("x").alias("w1"), F.col("y").alias("w2"), "longer")
    )
    reached = pairs.join(floors, "lang").filter("score >= floor")
    kept = reached.join(inside, ["lang", "w1", "w2"], "left").filter(
        f"longer is null or cast(longer as decimal(19,0)) * 100 < cast(a as decimal(19,0)) * {int(within)}"
    )
    long = triples.join(floors, "lang").filter("score >= floor")
    return kept.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score").union(
        long.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "l", "r", "score")
    )


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    top: int = TOP,
    min_count: int = MIN_COUNT,
    within: int = WITHIN,
    first_wave: int | None = None,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language of `docs`.

    Null and empty texts have no words; a null language is `und`. Repeated rows count as often as they come.
    A language without a phrase that comes `min_count` times has no row, an empty table none. Other columns
    are not looked at. Scores that tie are ordered by `a`, then by the phrase in UTF-8; all that tie with the
    last place have been found before the cut is made.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = rows.mapInArrow(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = staged(counts.filter(f"word = '' or n >= {int(min_count)}"), "word-counts")
    words, totals = counted.filter("word <> ''"), counted.filter("word = ''").select("lang", "n")

    frequent = build_filter(words.select("lang", "word"))
    often = phrase_counts(rows, 2, frequent).filter(F.col("n") >= min_count).withColumnRenamed("n", "a")
    pairs = staged(score_pairs(often, words), "word-pairs")
    levels = staged(pairs.groupBy("lang", "bound").agg(F.count("*").alias("prefixes")), "bounds")

    waves = staged(levels.groupBy("lang").agg(F.lit(first_wave or FIRST_WAVE).cast("long").alias("wave")), "waves")
    before, triples = None, None
    while True:
        floors = staged(_floors(levels, waves), "floors")
        fresh = pairs.join(floors, "lang")
        above = F.lit(True)
        if before is not None:
            fresh = fresh.join(before.select("lang", F.col("floor").alias("done")), "lang")
            above = F.col("done")
        grown = [
            fresh.filter((F.col(by) >= F.col("floor")) & (F.lit(True) if before is None else F.col(by) < above))
            .select("lang", "w1", "w2", F.lit(kind).alias("kind"))
            for kind, by in enumerate(("bound", "score"))
        ]
        wanted = build_filter(staged(grown[0].union(grown[1]), "prefixes"))
        found = phrase_counts(rows, 3, frequent, wanted).filter(F.col("n") >= min_count).withColumnRenamed("n", "a")
        scored = score_triples(found, pairs, words)
        # A phrase found again has the same counts.
        triples = staged(scored if triples is None else triples.union(scored).distinct(), "word-triples")
        survivors = staged(_survivors(pairs, triples, floors, within), "survivors")
        enough = survivors.groupBy("lang").agg(F.count("*").alias("survivors"))
        open_ = floors.filter("floor >= 0").join(enough, "lang", "left").filter(F.coalesce("survivors", F.lit(0)) < top)
        again = staged(
            waves.join(open_.select("lang", F.lit(True).alias("open")), "lang", "left").select(
                "lang", F.when(F.col("open"), F.col("wave") * 4).otherwise(F.col("wave")).alias("wave"), F.coalesce("open", F.lit(False)).alias("open")
            ),
            "waves",
        )
        if again.filter("open").isEmpty():
            break
        before, waves = floors, again.select("lang", "wave")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = survivors.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
