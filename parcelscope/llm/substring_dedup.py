"""Removal of word passages that occur more than once, by difference-cover anchors.

A passage is a window of `WINDOW` (35) consecutive words that starts at two or more places. Words
stand at positions 0, 1, ...; D is a difference cover modulo 21: for any two starts there is a shift
below 21 that brings both to positions in D. So only the 15-word windows at positions in D are
hashed and shuffled (5 of 21), and two equal passages always share one of these anchors at one offset.
Where an anchor repeats, the passages around it are hashed in full (over the extension to both
sides), and those that repeat are removed.

Both steps count a key with one rule: every row carries a weight, and a key of weight 2 or more
repeats. A task sums its own rows first: of a key that it meets several times, one row goes out under
the key with weight 2, the others under keys of their own, as they are known to repeat. A passage
that a third of all documents share therefore sends one row a task, not one a document.

Equal texts are worked on once: the first of them stands for all with weight 2, and each of them is
one repeated passage from end to end. Passage keys have 96 bits.

Texts are judged as they come in: every occurrence of a repeated passage is removed. Words are
runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
Null and empty texts have no word. Equal texts and repeated rows are removed whole if they have 35
words. Rows with equal or null doc_id are told apart by a number of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelscope.llm.common import keyed_texts, release_shuffles, staged

WINDOW = 35
PERIOD = 21
COVER = (0, 1, 6, 8, 18)  # a perfect difference set modulo 21
ANCHOR = WINDOW - PERIOD + 1
_FLUSH = 1 << 18  # rows a task gathers before it sums and sends them
_CACHED_WORDS = 1 << 18
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class _WordHashes(dict):
    """word -> 64-bit hash"""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class _Rolling:
    """Hashes of all windows of a text: sums of word hashes times powers of an odd base, modulo 2^64."""

    def __init__(self, base: int):
        self.base, self.length = base, 0
        self._grow(1 << 12)

    def _grow(self, length: int) -> None:
        if length <= self.length:
            return
        inverse = pow(self.base, -1, 1 << 64)
        self.length = 1 << (length - 1).bit_length()
        ones = np.ones(self.length, dtype=np.uint64)
        ones[1:] = self.base
        self.powers = np.cumprod(ones, dtype=np.uint64)
        ones[1:] = inverse
        self.inverses = np.cumprod(ones, dtype=np.uint64)

    def windows(self, words: np.ndarray, size: int) -> np.ndarray:
        count = len(words) - size + 1
        if count <= 0:
            return np.empty(0, dtype=np.uint64)
        self._grow(len(words))
        sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * self.powers[: len(words)], out=sums[1:])
        found = (sums[size:] - sums[:-size]) * self.inverses[:count]
        found ^= found >> np.uint64(32)
        found *= np.uint64(0xD6E8FEB86659FD93)
        return found ^ (found >> np.uint64(32))


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _hashes(words: list[bytes], table: _WordHashes) -> np.ndarray:
    return np.fromiter(map(table.__getitem__, words), dtype=np.uint64, count=len(words))


def _own_keys(row: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Keys that spread rows which need no partner."""
    mixed = row.astype(np.uint64) * np.uint64(_BASES[0]) + pos.astype(np.uint64) * np.uint64(_BASES[1])
    return mixed ^ (mixed >> np.uint64(29))


def _summed(keys: list[np.ndarray], row: np.ndarray, pos: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
    """[*keys, row, pos, weight] with one row a key, the further rows of a key under keys of their own."""
    order = np.lexsort(keys[::-1])
    keys, row, pos, count = [k[order] for k in keys], row[order], pos[order], count[order]
    first = np.ones(len(row), dtype=bool)
    first[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    starts = np.flatnonzero(first)
    weight = np.full(len(row), 2, dtype=np.int32)
    weight[starts] = np.minimum(np.add.reduceat(count, starts), 2)
    own = _own_keys(row, pos)
    keys = [np.where(first, k, own + np.uint64(n)) for n, k in enumerate(keys)]
    kinds = (np.int64, np.int32)  # the first key is whole, a second one half
    return [*(k.astype(np.uint32).view(t) if t is np.int32 else k.view(t) for k, t in zip(keys, kinds)), row, pos, weight]


class _Sender:
    """Gathers arrays and turns every _FLUSH rows into one summed batch."""

    def __init__(self, names: list[str]):
        self.names, self.parts, self.rows = names, [], 0

    def add(self, *columns: np.ndarray, count: int = 1) -> None:
        """Keys, rows and positions of places that each stand for `count`."""
        if len(columns[0]):
            self.parts.append((*columns, np.full(len(columns[0]), count, dtype=np.int32)))
            self.rows += len(columns[0])

    def take(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if self.rows < least:
            return
        *keys, row, pos, count = (np.concatenate(c) for c in zip(*self.parts))
        self.parts, self.rows = [], 0
        columns = [pa.array(c) for c in _summed(keys, row, pos, count)]
        for start in range(0, len(columns[0]), 1 << 16):
            yield pa.RecordBatch.from_arrays([c.slice(start, 1 << 16) for c in columns], self.names)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, rolling = _WordHashes(), _Rolling(_BASES[0])
    sender = _Sender(["key", "row", "pos", "weight"])
    cover = np.array(COVER)
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for k, text in enumerate(batch.column(1)):
            words = split_words(text.as_py())
            if len(words) < WINDOW:
                continue
            hashed = rolling.windows(_hashes(words, table), ANCHOR)
            at = (np.arange(0, len(hashed), PERIOD)[:, None] + cover).ravel()
            at = at[at < len(hashed)]
            sender.add(hashed[at], np.full(len(at), ids[k]), at.astype(np.int32))
            yield from sender.take(_FLUSH)
    yield from sender.take()


def candidate_starts(anchors: np.ndarray, n_words: int) -> np.ndarray:
    """Starts of all passages that hold an anchor at one of the given positions."""
    marks = np.zeros(n_words + 1, dtype=np.int32)
    np.add.at(marks, np.maximum(anchors - (PERIOD - 1), 0), 1)
    np.add.at(marks, np.minimum(anchors + 1, n_words), -1)
    starts = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
    return starts[starts + WINDOW <= n_words].astype(np.int32)


def _passage_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, rolling = _WordHashes(), [_Rolling(b) for b in _BASES]
    sender = _Sender(["key", "key2", "row", "pos", "weight"])
    half = np.uint64(0xFFFFFFFF)
    for batch in batches:
        ids, copies = batch.column(0).to_numpy(), batch.column(3).to_pylist()
        for k, (text, anchors) in enumerate(zip(batch.column(1), batch.column(2))):
            hashed = _hashes(split_words(text.as_py()), table)
            starts = candidate_starts(anchors.values.to_numpy(), len(hashed))
            whole, second = (r.windows(hashed, WINDOW)[starts] for r in rolling)
            sender.add(whole, second & half, np.full(len(starts), ids[k]), starts, count=min(copies[k], 2))
            yield from sender.take(_FLUSH)
    yield from sender.take()


def _first_of_equals(texts: DataFrame, candidates: DataFrame) -> DataFrame:
    """(row, copies) of the first row of each text among the candidates; the other rows of a text are left out."""
    digest = [F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("h2"), F.octet_length("text").alias("n")]
    digests = texts.select("row", *digest).join(candidates.select("row"), "row", "left_semi")
    return digests.groupBy("h", "h2", "n").agg(F.min("row").alias("row"), F.count("*").alias("copies")).select("row", "copies")


def _repeated(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(row, positions) of the rows whose key has weight 2 or more."""
    weight = F.sum("weight").over(Window.partitionBy(*keys))
    found = rows.withColumn("total", weight).filter("total >= 2")
    out = staged(found.groupBy("row").agg(F.collect_list("pos").alias("positions")), name)
    release_shuffles(out.sparkSession)
    return out


def covered(n_words: int, starts: np.ndarray) -> np.ndarray:
    """True for each word inside a passage that begins at one of the starts."""
    marks = np.zeros(n_words + 1, dtype=np.int32)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + WINDOW, -1)
    return np.cumsum(marks[:-1]) > 0


def _results(with_text: bool):
    """(row, id, n_words, n_removed, kept_sha256[, kept_text]) of (row, id, text, positions)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, digests, texts = [], [], [], []
            for text, starts in zip(batch.column(2), batch.column(3)):
                words = split_words(text.as_py())
                kept = words
                if starts.is_valid:
                    at = starts.values.to_numpy()
                    gone = covered(len(words), at) if at[0] >= 0 else np.ones(len(words), dtype=bool)
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                joined = b" ".join(kept)
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                digests.append(hashlib.sha256(joined).hexdigest())
                if with_text:
                    texts.append(joined.decode("utf-8", "surrogatepass"))
            counts = [pa.array(n, pa.int64()) for n in (n_words, n_removed)]
            columns = [batch.column(0), batch.column(1), *counts, pa.array(digests, pa.string())]
            names = ["row", "id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(texts, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


_RESULT = "row long, id long, n_words long, n_removed long, kept_sha256 string"


def repeated_passages(texts: DataFrame) -> DataFrame:
    """Of `texts` (row, id, text): (row, id, text, positions) of those with repeated passages, and these passages' starts."""
    anchors = texts.select("row", "text").mapInArrow(_anchor_rows, "key long, row long, pos int, weight int")
    candidates = _repeated(anchors, ["key"], "anchors")
    flagged = candidates.join(_first_of_equals(texts, candidates), "row", "left")
    # From here on only the texts with a repeated anchor move.
    narrowed = staged(texts.join(flagged, "row").select("row", "id", "text", "positions", "copies"), "candidates")
    release_shuffles(narrowed.sparkSession)
    firsts = narrowed.filter("copies is not null")
    passages = firsts.select("row", "text", "positions", "copies").mapInArrow(
        _passage_rows, "key long, key2 int, row long, pos int, weight int"
    )
    starts = _repeated(passages, ["key", "key2"], "passages")
    found = firsts.select("row", "id", "text").join(starts, "row")
    # A text with an equal before it is a repeated passage as a whole: -1 says so.
    again = narrowed.filter("copies is null").select("row", "id", "text", F.array(F.lit(-1)).alias("positions"))
    return found.union(again)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    texts = keyed_texts(docs, id_col, text_col)
    mine = staged(repeated_passages(texts).mapInArrow(_results(False), _RESULT), "changed")
    theirs = mine.select("row", *(F.col(c).alias(f"{c}_") for c in mine.columns[2:]))
    whole = texts.withColumn("positions", F.lit(None).cast("array<int>")).mapInArrow(_results(False), _RESULT)
    either = [F.coalesce(f"{c}_", c).alias(c) for c in mine.columns[2:]]
    return whole.join(theirs, "row", "left").select(F.col("id").alias(id_col), *either)


def changed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unique: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of the rows that lose words; `unique`: no id is null or comes again."""
    changed = repeated_passages(keyed_texts(docs, id_col, text_col, unique))
    found = changed.mapInArrow(_results(True), _RESULT + ", kept_text string")
    return found.select(F.col("id").alias(id_col), "n_words", "n_removed", "kept_text")
