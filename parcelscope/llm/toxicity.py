"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text. A window is one word
with its blanks; what it costs less under the toxic dictionary than under the ordinary one is its
gain. Words are short, so windows are padded with a run that both sides compress alike, and literals
stay uncoded (fast strategy): each byte that a dictionary match saves then shows in the length.

Training refines the dictionaries a few rounds. Windows of toxic texts that gain under a dictionary
from the other half of the toxic texts become the next toxic samples; windows of ordinary texts that
gain are added to the ordinary samples. Thresholds are calibrated by a logistic fit over the counts
of windows beyond each gain, on texts that trained no dictionary, weighted to the labels' shares.

Fitting reads a bounded sample: `per_class` labelled texts of each class and at most
`windows_per_text` different windows of each. Scoring reads all windows of the whole text.

Edge cases: null and empty texts have no window and get the fitted score of no evidence. Rows
without a label are not learned; a text labelled twice counts as toxic. If one class has no row,
every score is the share of toxic labels (0 without any label).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAD = b"." * 24
MIN_MATCH = 5
TOXIC_BYTES = 4096
ORDINARY_BYTES = 65536
ROUNDS = 3
_TRAINING_WINDOWS = 200_000
_HARD_WINDOWS = 200_000
_CACHED_GAINS = 400_000


def windows(text: str | None) -> list[bytes]:
    return [b" " + w + b" " for w in (text or "").lower().encode("utf-8", "surrogatepass").split()]


def _order(items: list[bytes], seed: int) -> list[bytes]:
    """A fixed shuffle that depends on the seed only."""
    return [items[i] for i in np.random.default_rng(seed).permutation(len(items))]


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; where the samples are too few to train on, their own bytes."""
    joined = [b"".join(samples[i : i + 8]) for i in range(0, len(samples), 8)]
    try:
        return zstandard.train_dictionary(size, joined, k=32, d=6).as_bytes()
    except zstandard.ZstdError:
        return (b"".join(dict.fromkeys(samples))[-size:] or PAD).ljust(16, b".")


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters.from_level(
        1, min_match=MIN_MATCH, strategy=zstandard.STRATEGY_FAST, target_length=1, write_content_size=0,
        write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    return zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(dictionary), compression_params=settings
    )


class Gains(dict):
    """Window -> bytes that the toxic dictionary saves over the ordinary one."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = _compressor(toxic), _compressor(ordinary)

    def __missing__(self, window: bytes) -> int:
        padded = window + PAD
        gain = len(self.ordinary.compress(padded)) - len(self.toxic.compress(padded))
        if len(self) >= _CACHED_GAINS:
            self.clear()
        self[window] = gain
        return gain

    def of(self, text_windows: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, text_windows), dtype=np.int32, count=len(text_windows))


def features(gains: np.ndarray) -> list[float]:
    top = np.zeros(8)
    best = np.sort(gains)[::-1][:8]
    top[: len(best)] = best
    n = max(len(gains), 1)
    beyond = [float((gains >= k).sum()) for k in (2, 3, 4, 5, 6)]
    return [top[0], top[:3].sum(), top.sum(), *beyond, beyond[1] / n, beyond[3] / n, math.log1p(len(gains)), gains.sum() / n]


@dataclass
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the constant

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = (rows - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_dictionaries(toxic_texts: list[list[bytes]], ordinary_texts: list[list[bytes]]) -> tuple[bytes, bytes]:
    """Train both dictionaries from the different windows of each text."""
    plain = _order([w for t in ordinary_texts for w in t], 1)
    halves = [_order([w for t in toxic_texts[i::2] for w in t], 2 + i) for i in (0, 1)]
    if not halves[1]:
        halves[1] = halves[0]
    ordinary = train_dictionary(plain[:_TRAINING_WINDOWS], ORDINARY_BYTES)
    toxic = [train_dictionary(h[:_TRAINING_WINDOWS], TOXIC_BYTES) for h in halves]
    hard: list[bytes] = []
    chosen = halves
    for _ in range(ROUNDS):
        tables = [Gains(t, ordinary) for t in toxic]
        chosen = []
        for i in (0, 1):
            other = tables[1 - i]
            among_plain = other.of(plain)
            least = max(float(np.quantile(among_plain, 0.99)) if len(among_plain) else 1.0, 1.0)
            chosen.append([w for w, g in zip(halves[i], other.of(halves[i])) if g > least] or halves[i])
            hard += [w for w, g in zip(plain, among_plain) if g > least]
        hard = hard[-_HARD_WINDOWS:]
        toxic = [train_dictionary(c, TOXIC_BYTES) for c in chosen]
        ordinary = train_dictionary(plain[: _TRAINING_WINDOWS * 3 // 4] + hard, ORDINARY_BYTES)
    return train_dictionary(chosen[0] + chosen[1], TOXIC_BYTES), ordinary


def fit_thresholds(rows: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted logistic fit by Newton steps."""
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    x = np.column_stack([(rows - mean) / scale, np.ones(len(rows))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), 0.1 * len(rows) / 1000)
    penalty[-1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = x.T @ (x * (weight * p * (1 - p) + 1e-9)[:, None]) + np.diag(penalty)
        step = np.linalg.solve(hessian, x.T @ (weight * (toxic - p)) - penalty * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def _sampled_windows(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text in batch.column("text").to_pylist():
                different = list(dict.fromkeys(windows(text)))
                if len(different) > limit:
                    different = sorted(different, key=xxhash.xxh3_64_intdigest)[:limit]
                kept.append(different)
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), batch.column("draw"), pa.array(kept, pa.list_(pa.binary()))],
                ["toxic", "draw", "windows"],
            )

    return run


def _feature_rows(toxic: bytes, ordinary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(toxic, ordinary)
        for batch in batches:
            rows = [features(gains.of(windows(t))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "row"]
            )

    return run


def train(
    docs: DataFrame, labels: DataFrame, per_class: int = 2000, windows_per_text: int = 1000
) -> ToxicityModel | float:
    """Fit on docs (doc_id, text) and labels (doc_id, toxic). A number: the score of every text."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return 1.0 if 1 in counts else 0.0
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, min(1.0, per_class / counts[1])).otherwise(min(1.0, per_class / counts[0]))
    # About per_class rows of each class, whatever the size of the tables: small enough to broadcast.
    sample = known.withColumn("draw", draw).filter(F.col("draw") < share)
    sample = sample.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("draw").alias("draw"))
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic", "draw")
    trains = F.pmod(F.xxhash64("draw"), F.lit(5)) < 3
    rows = (
        texts.filter(trains)
        .mapInArrow(_sampled_windows(windows_per_text), "toxic int, draw double, windows array<binary>")
        .collect()
    )
    rows.sort(key=lambda r: (r["draw"], len(r["windows"])))
    by_class = [[[bytes(w) for w in r["windows"]] for r in rows if r["toxic"] == k] for k in (0, 1)]
    prior = counts[1] / (counts[0] + counts[1])
    if not by_class[0] or not by_class[1]:
        return prior
    toxic, ordinary = fit_dictionaries(by_class[1], by_class[0])
    measured = texts.filter(~trains).mapInArrow(_feature_rows(toxic, ordinary), "toxic int, row array<double>").collect()
    y = np.array([r["toxic"] for r in measured], dtype=np.float64)
    if not 0 < y.sum() < len(y):
        return prior
    x = np.array([r["row"] for r in measured])
    order = np.lexsort(np.column_stack([x, y]).T)  # sums in one order, however rows arrived
    x, y = x[order], y[order]
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    return ToxicityModel(toxic, ordinary, *fit_thresholds(x, y, weight))


def score(docs: DataFrame, model: ToxicityModel | float, text_col: str = "text") -> DataFrame:
    """`docs` with score and predicted; any columns of `docs` with these names are replaced."""
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = docs.select(*kept).schema.add("score", "double").add("predicted", "integer")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        gains = Gains(model.toxic, model.ordinary) if isinstance(model, ToxicityModel) else None
        for batch in batches:
            if gains is None:
                scores = np.full(batch.num_rows, float(model))
            else:
                rows = [features(gains.of(windows(text.as_py()))) for text in batch.column(text_col)]
                scores = model.score(np.array(rows)) if rows else np.zeros(0)
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "score", "predicted"])

    return docs.select(*kept, *([] if text_col in kept else [text_col])).mapInArrow(run, schema)
