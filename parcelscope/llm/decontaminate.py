"""Benchmark decontamination by latent semantic retrieval.

Texts are sequences of lower-case words. Columns of the TF-IDF matrix are the terms of the benchmark
(all others can match nothing there), rows are passages of 48 words of all documents; document
frequencies count every passage of the corpus. A randomised range finder gives the latent space: one
distributed pass multiplies a random matrix by the matrix and by its transpose, summed over all
passages, and the benchmark's own vectors join the basis. Overlapping windows of each document are
projected and compared with all items by cosine. Two sorts of items the space is blind to: those of which it
keeps less than `HELD`, as a benchmark of more than `ITEM_RANK` parts does not fit it, and those shorter than
`SHORT` words, a small part of any window. For these, and no others, windows that hold enough of an item's
rarest words are taken. That loses nothing of them: whatever the check below finds holds that many.

What is taken is checked on the words themselves. With r the longest common subsequence of item and text, over
the words of the item, in a stretch of at most `SPAN` times as many: r of `SURE` or more is a leak, and from
`LIKELY` on it is one, a paraphrase, if the stretch holds the item's answer as well (a column `answer`, or else
its last words) in order, up to `ANSWER` of its words. An item of fewer than `MIN_WORDS` words leaks only as it
is, word by word, and so does one of fewer than `SHORT` with fewer than `RARE` words that are not common, as
such words stand in order by chance. Letters of scripts that are written without blanks are words by themselves.

The benchmark is a given, small table: at most `MAX_TERMS` different words, held by every task. Items
without a word, null ones included, match nothing. Null and empty texts leak nothing.
Repeated rows are judged alike; items with equal text are all reported. Items longer than `PART` words
are cut into parts, and leak if half of their words lie in parts that do.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelscope.llm.common import staged

BLOCK = 16  # words; passages and windows are whole blocks
PASSAGE = 3  # blocks of a passage of the matrix
WINDOWS = (3, 6)  # blocks of a window: hold parts of up to 33 and 81 words wherever they stand
RANK, OVERSAMPLE = 40, 8  # latent dimensions from the corpus
ITEM_RANK = 256  # and at most so many from the benchmark
COSINE = 0.4
COMMON = 0.2  # terms in more than this share of the passages have no weight
HITS = 4  # words of a part's rarest that a window must hold to be looked at for their sake
HELD, SHORT, RARE = 0.95, 12, 3  # share of an item's length that the space keeps, and words, below which keys are used
SURE, LIKELY, ANSWER, SPAN = 0.75, 0.6, 0.8, 1.5
MIN_WORDS, PART, MAX_TERMS = 6, 64, 200_000
_SEED = 8
_NOT_WORD = bytes(c for c in range(128) if not (chr(c).isalnum() or c == 0x5F))
_SPACED = bytes.maketrans(_NOT_WORD, b" " * len(_NOT_WORD))
_ROWS = 256
# Thai, Lao and Khmer, kana, and Chinese characters.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\U00020000-\U0003ffff]")


def words_of(text: str | None) -> list[bytes]:
    text = (text or "").lower()
    if not text.isascii() and _UNSPACED.search(text):
        text = _UNSPACED.sub(r" \g<0> ", text)
    return text.encode("utf-8", "surrogatepass").translate(_SPACED).split()


@dataclass
class Part:
    item: int
    words: list[int]
    answer: list[int]
    item_words: int
    exact: bool = False  # leaks only word by word


class Benchmark:
    """Terms and parts of the items."""

    def __init__(self, rows: list[tuple[int, str | None, str | None]]):
        self.terms: dict[bytes, int] = {}
        self.parts: list[Part] = []
        for item, text, answer in rows:
            words = [self.terms.setdefault(w, len(self.terms)) for w in words_of(text)]
            said = [self.terms.setdefault(w, len(self.terms)) for w in words_of(answer)]
            if not words:
                continue
            n = math.ceil(len(words) / PART)
            size = math.ceil(len(words) / n)
            for start in range(0, len(words), size):
                part = words[start : start + size]
                self.parts.append(Part(item, part, said or part[-max(3, len(part) // 5) :], len(words)))
        if len(self.terms) > MAX_TERMS:
            raise ValueError(f"the benchmark has {len(self.terms)} terms, more than {MAX_TERMS}")

    def vectors(self, idf: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.parts), len(self.terms)), dtype=np.float32)
        for row, part in zip(out, self.parts):
            np.add.at(row, part.words, idf[part.words])
        return out


# --- pass 1: terms of the corpus ------------------------------------------------------------


def known_terms(docs: DataFrame, terms: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, gaps, terms): of each text the benchmark's terms and the steps between their positions."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.get
        for batch in batches:
            counts, gaps, found = [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                ids = np.fromiter(map(known, words, repeat(-1)), dtype=np.int32, count=len(words))
                at = np.flatnonzero(ids >= 0)
                counts.append(len(words))
                # A step beyond any window may be shortened.
                gaps.append(np.minimum(np.diff(at, prepend=0), 0xFFFF).astype("<u2").tobytes())
                found.append(ids[at].astype("<i4").tobytes())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(gaps, pa.binary()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "gaps", "terms"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, n_words long, gaps binary, terms binary")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, row of each term, place of each term counted through all rows, terms). Rows never share a window."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            gaps = [np.frombuffer(g, dtype="<u2") for g in part.column("gaps").to_pylist()]
            terms = [np.frombuffer(t, dtype="<i4") for t in part.column("terms").to_pylist()]
            places, first = [], 0
            for g in gaps:
                place = np.cumsum(g, dtype=np.int64)
                places.append(place + first)
                if len(place):
                    first += (int(place[-1]) // BLOCK + 1 + max(WINDOWS)) * BLOCK
            row = np.repeat(np.arange(len(gaps)), [len(g) for g in gaps])
            yield part.column("id"), row, np.concatenate(places), np.concatenate(terms)


def _passages(row: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Number of the passage of each term, from 0 without holes."""
    if not len(block):
        return block
    key = block // PASSAGE
    new = np.ones(len(block), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    return np.cumsum(new) - 1


def _frequencies(known: DataFrame, n_terms: int) -> tuple[np.ndarray, int]:
    """Passages that hold each term, and the number of passages, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, dtype=np.int64)
        for _, row, place, terms in _slices(batches):
            passage = _passages(row, place // BLOCK)
            once = np.unique(passage * n_terms + terms) % n_terms
            total += np.bincount(once, minlength=n_terms)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], ["term", "n"])

    summed = known.mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    frequency = np.zeros(n_terms, dtype=np.int64)
    for r in summed:  # at most a row for each term of the benchmark
        frequency[r["term"]] = r["n"]
    n = known.agg(F.sum(F.ceil(F.col("n_words") / (BLOCK * PASSAGE)))).first()[0] or 0
    return frequency, int(n)


# --- pass 2: the latent space ---------------------------------------------------------------


def _range(known: DataFrame, idf: np.ndarray) -> np.ndarray:
    """Transposed matrix times matrix times a random matrix: terms x (RANK + OVERSAMPLE)."""
    n_terms, width = len(idf), RANK + OVERSAMPLE
    shared = known.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = shared.value
        random = np.random.default_rng(_SEED).standard_normal((n_terms, width)).astype(np.float32) * idf[:, None]
        total = np.zeros((n_terms, width), dtype=np.float64)
        for _, row, place, terms in _slices(batches):
            heavy = idf[terms] > 0
            row, block, terms = row[heavy], place[heavy] // BLOCK, terms[heavy]
            if not len(terms):
                continue
            passage = _passages(row, block)
            starts = np.flatnonzero(np.diff(passage, prepend=-1))
            by_passage = np.add.reduceat(random[terms], starts, axis=0)
            # Long passages would drown the others, so each counts with its length as a unit.
            norms = np.sqrt(np.bincount(passage, weights=idf[terms].astype(np.float64) ** 2)).astype(np.float32)
            by_passage /= np.maximum(norms, 1e-6)[:, None] ** 2
            order = np.argsort(terms, kind="stable")
            held, first = np.unique(terms[order], return_index=True)
            total[held] += np.add.reduceat(by_passage[passage[order]], first, axis=0) * idf[held, None]
        held = np.flatnonzero(np.abs(total).sum(axis=1))
        kinds = [pa.array(held, pa.int32()), pa.array(list(total[held]), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(kinds, ["term", "row"])

    rows = known.select("id", "gaps", "terms").mapInArrow(run, "term int, row array<double>")
    sums = F.array(*(F.sum(F.col("row")[k]) for k in range(width))).alias("row")
    out = np.zeros((n_terms, width))
    for r in rows.groupBy("term").agg(sums).collect():
        out[r["term"]] = r["row"]
    return out


def mark_exact(bench: Benchmark, frequency: np.ndarray, n_passages: int) -> None:
    """Which parts are too short, or too common, for less than their very words to say anything."""
    rare = frequency <= COMMON * n_passages
    for part in bench.parts:
        n = len(part.words)
        part.exact = n < MIN_WORDS or n < SHORT and int(rare[part.words].sum()) < RARE


def weights(bench: Benchmark, frequency: np.ndarray, n_passages: int) -> np.ndarray:
    """Inverse document frequency of each term; 0 for common terms, but for those of items that are mostly made of them."""
    idf = np.log((1 + n_passages) / (1 + frequency)).astype(np.float32) + np.float32(0.05)
    common = frequency > COMMON * n_passages
    for part in bench.parts:
        if common[part.words].mean() > 0.5:
            common[part.words] = False
    idf[common] = 0
    return idf


def latent_basis(items: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Orthonormal columns (terms x rank) that span the items and the corpus's main directions."""
    own = items.T.astype(np.float64)
    if own.shape[1] > ITEM_RANK:
        own = np.linalg.svd(own, full_matrices=False)[0][:, :ITEM_RANK]
    main = np.linalg.svd(corpus, full_matrices=False)[0][:, :RANK] if corpus.size else corpus
    basis, r = np.linalg.qr(np.column_stack([own, main]))
    return basis[:, np.abs(np.diag(r)) > 1e-9].astype(np.float32)


# --- pass 3: search and check ---------------------------------------------------------------


def common_subsequence(item: list[int], window: list[int]) -> int:
    """Length of the longest common subsequence, a bit for each word of the item."""
    places: dict[int, int] = {}
    for i, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in window:
        hit = row & places.get(w, 0)
        row = (row + hit | row - hit) & full if hit else row
    return len(item) - row.bit_count()


def is_leak(part: Part, window: list[int]) -> tuple[bool, float]:
    ratio = common_subsequence(part.words, window) / len(part.words)
    if part.exact:
        return ratio == 1, ratio
    if ratio >= SURE or ratio < LIKELY:
        return ratio >= SURE, ratio
    return common_subsequence(part.answer, window) >= ANSWER * len(part.answer), ratio


def leak_within(part: Part, window: np.ndarray, places: np.ndarray) -> tuple[bool, float]:
    """Whether a stretch of the window, no longer than the item may be drawn out, leaks it, and the best ratio of those."""
    words = window.tolist()
    # No more of the item can be there in order than is there at all, which nearly all windows fail.
    if sum(map(set(words).__contains__, part.words)) < (1 if part.exact else LIKELY) * len(part.words) - 1e-9:
        return False, 0.0
    leak, ratio = is_leak(part, words)
    span = len(part.words) if part.exact else math.ceil(SPAN * len(part.words))
    if not leak or places[-1] - places[0] < span:
        return leak, ratio
    of_part = set(part.words)
    best = 0.0
    for k, end in enumerate(np.searchsorted(places, places + span)):
        # A stretch that matters begins with a word of the item.
        if int(window[k]) in of_part and end - k >= (1 if part.exact else LIKELY) * len(part.words) - 1e-9:
            found, ratio = is_leak(part, window[k:end].tolist())
            best = max(best, ratio if found else 0.0)
    return best > 0, best


class Keys:
    """Words by which a leak is found without the latent space, for the parts that it is blind to.

    A leak has LIKELY of a part's words or more, in one window, and all of them if they are few. So of any set of the part's words that is larger
    by HITS - 1 than what may be missing, HITS are in the window; the set is of the rarest words.
    """

    def __init__(self, parts: list[Part], frequency: np.ndarray, blind: np.ndarray):
        terms, owners, self.hits = [], [], np.zeros(len(parts), dtype=np.int64)
        for p, part in enumerate(parts):
            if not blind[p]:
                continue
            need = len(part.words) if part.exact else math.ceil(LIKELY * len(part.words) - 1e-9)
            self.hits[p] = min(HITS, need)
            rarest = sorted(part.words, key=lambda w: (frequency[w], w))
            found = set(rarest[: len(rarest) - need + self.hits[p]])
            terms += found
            owners += [p] * len(found)
        order = np.argsort(np.array(terms, dtype=np.int64), kind="stable")
        self.owners = np.array(owners, dtype=np.int64)[order]
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(np.array(terms, dtype=np.int64), minlength=len(frequency)))])
        self.sizes = np.array([window_size(len(p.words)) for p in parts], dtype=np.int64)

    def windows(self, block: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """(first block, part) of each window that holds enough of a part's keys."""
        uses = self.ends[terms + 1] - self.ends[terms]
        at = np.repeat(np.arange(len(terms)), uses)
        if not len(at):
            return np.empty((0, 2), dtype=np.int64)
        part = self.owners[np.arange(len(at)) - np.repeat(np.cumsum(uses) - uses, uses) + self.ends[terms[at]]]
        order = np.argsort(part, kind="stable")
        part, where = part[order], block[at[order]]
        last = np.arange(len(part)) + self.hits[part] - 1
        fit = last < len(part)
        last = np.minimum(last, len(part) - 1)
        span = where[last] - where
        fit &= (part[last] == part) & (span < self.sizes[part])
        part, low, high = part[fit], where[fit], where[last[fit]]
        ways = self.sizes[part] - (high - low)  # windows that hold them all
        step = np.arange(ways.sum()) - np.repeat(np.cumsum(ways) - ways, ways)
        return np.unique(np.column_stack([np.repeat(low, ways) - step, np.repeat(part, ways)]), axis=0)


def window_size(n_words: int) -> int:
    """Blocks of the smallest window that holds so many words wherever they stand."""
    return next(size for size in WINDOWS if n_words <= (size - 1) * BLOCK + 1)


@dataclass
class _Search:
    parts: list[Part]
    keys: Keys
    idf: np.ndarray
    basis: np.ndarray  # terms x rank, rows weighted by idf
    items: np.ndarray  # rank x parts, unit columns


def _matches(search: _Search, place: np.ndarray, terms: np.ndarray) -> Iterator[tuple[int, int, float, float]]:
    """(first term of the window, part, ratio, cosine) of each leak, over rows set one after another."""
    if not len(terms):
        return
    block = place // BLOCK
    # A window is a sum of blocks, so terms are projected once, by block.
    heavy = search.idf[terms] > 0
    at, weighed = block[heavy], terms[heavy]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    latent = np.zeros((int(block[-1]) + max(WINDOWS) + 1, search.basis.shape[1]), dtype=np.float32)
    for k in range(0, len(first), 1024):
        stop = first[k + 1024] if k + 1024 < len(first) else len(weighed)
        part = first[k : k + 1024]
        latent[at[part]] = np.add.reduceat(search.basis[weighed[part[0] : stop]], part - part[0], axis=0)
    lengths = np.array([len(p.words) for p in search.parts])
    before, seen = 0, set()
    for size in WINDOWS:
        # Each part is looked for in the smallest window that holds it wherever it stands.
        columns = np.flatnonzero((lengths > before) & (lengths <= (size - 1) * BLOCK + 1))
        before = (size - 1) * BLOCK + 1
        if not len(columns):
            continue
        items = np.ascontiguousarray(search.items[:, columns])
        padded = np.concatenate([np.zeros((size - 1, latent.shape[1]), np.float32), latent])
        for k in range(0, len(padded) - size + 1, 2048):
            n = min(2048, len(padded) - size + 1 - k)
            window = padded[k : k + n].copy()
            for step in range(1, size):
                window += padded[k + step : k + step + n]
            norm = np.maximum(np.linalg.norm(window, axis=1), 1e-9)
            at, which = np.nonzero(window @ items >= COSINE * norm[:, None])
            starts = k + at - (size - 1)
            ends = zip(np.searchsorted(block, starts).tolist(), np.searchsorted(block, starts + size).tolist())
            for w, start, c, (lo, hi) in zip(at.tolist(), starts.tolist(), columns[which].tolist(), ends):
                seen.add((start, c))
                if hi > lo:
                    leak, ratio = leak_within(search.parts[c], terms[lo:hi], place[lo:hi])
                    if leak:
                        yield lo, c, ratio, float(window[w] @ search.items[:, c] / norm[w])
    # What the space does not show is found by its words.
    for start, c in map(tuple, search.keys.windows(block, terms).tolist()):
        if (start, c) in seen:
            continue
        size = int(search.keys.sizes[c])
        lo, hi = np.searchsorted(block, (start, start + size))
        leak, ratio = leak_within(search.parts[c], terms[lo:hi], place[lo:hi])
        if leak:
            window = latent[max(start, 0) : start + size].sum(axis=0)
            yield int(lo), c, ratio, float(window @ search.items[:, c] / max(np.linalg.norm(window), 1e-9))


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, item_id, ratio, cosine) of every document that holds an item; ratio and cosine are the largest found."""
    spark = docs.sparkSession
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col("item_id").cast("long"), "text", answer).filter("item_id is not null").collect()
    bench = Benchmark(sorted(map(tuple, rows), key=lambda r: (r[0], r[1] or "", r[2] or "")))
    schema = "id long, item_id long, part int, ratio double, cosine double, share double"
    if not bench.parts:
        return spark.createDataFrame([], f"{id_col} long, item_id long, ratio double, cosine double")
    known = staged(known_terms(docs, bench.terms, id_col, text_col), "terms")
    frequency, n_passages = _frequencies(known, len(bench.terms))
    mark_exact(bench, frequency, n_passages)
    idf = weights(bench, frequency, n_passages)
    items = bench.vectors(idf)
    basis = latent_basis(items, _range(known, idf))
    projected = items @ basis
    held = np.linalg.norm(projected, axis=1) / np.maximum(np.linalg.norm(items, axis=1), 1e-9)
    blind = (held < HELD) | (np.array([len(p.words) for p in bench.parts]) < SHORT)
    projected /= np.maximum(np.linalg.norm(projected, axis=1), 1e-9)[:, None]
    shared = spark.sparkContext.broadcast(_Search(bench.parts, Keys(bench.parts, frequency, blind), idf, basis * idf[:, None], np.ascontiguousarray(projected.T)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = shared.value
        for ids, row, place, terms in _slices(batches):
            best: dict[tuple[int, int], tuple[float, float]] = {}
            for first, p, ratio, cosine in _matches(search, place, terms):
                key = (int(row[first]), p)
                before = best.get(key, (0.0, 0.0))
                best[key] = (max(before[0], ratio), max(before[1], cosine))
            if best:
                out = [
                    {
                        "id": ids[r].as_py(), "item_id": search.parts[p].item, "part": p, "ratio": ratio, "cosine": cosine,
                        "share": len(search.parts[p].words) / search.parts[p].item_words,
                    }
                    for (r, p), (ratio, cosine) in sorted(best.items())
                ]
                kinds = [("id", pa.int64()), ("item_id", pa.int64()), ("part", pa.int32())]
                kinds += [(n, pa.float64()) for n in ("ratio", "cosine", "share")]
                yield pa.RecordBatch.from_pylist(out, pa.schema(kinds))

    found = known.select("id", "gaps", "terms").mapInArrow(run, schema).groupBy("id", "item_id", "part").agg(
        F.max("ratio").alias("ratio"), F.max("cosine").alias("cosine"), F.max("share").alias("share")
    )
    whole = found.groupBy("id", "item_id").agg(
        F.max("ratio").alias("ratio"), F.max("cosine").alias("cosine"), F.sum("share").alias("share")
    )
    return whole.filter("share >= 0.5").select(F.col("id").alias(id_col), "item_id", "ratio", "cosine")
