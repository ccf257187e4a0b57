"""Language identification by string kernels.

A text is the set of its character n-grams (sizes 1 to 3, lower case, hashed into 2^15 buckets):
the blended-spectrum presence kernel of two texts is the number of shared n-grams over the
geometric mean of their numbers of n-grams. Nyström landmarks stand for the training rows, and
one-versus-rest kernel ridge regression gives each language a column of weights, so a batch of
texts is scored by two matrix products.

Fitting reads a bounded sample: about `per_language` different texts of each language and no more
than `sample_rows` of all (but eight of each language), each text reduced to a bitmap of 4 KB before
it reaches the driver. Landmarks grow with the languages. Of more than `max_languages` labels the most
frequent are learned; the parameter bounds the model, which every task holds.

Edge cases: a null text or one without any letter is `und` with score 0. Without a single
training row every text is `und`. Equal texts get equal predictions; ties go to the language
first in alphabetical order. Null labels are never learned, repeated texts of a language once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelscope.llm.common import free_name

BITS = 15
BUCKETS = 1 << BITS
NGRAM_SIZES = (1, 2, 3)
LANDMARKS_EACH = 4  # of each language, at least
UNDETERMINED = "und"
_PIECE = 1 << 20  # characters hashed at once
_ROWS = 128  # texts per matrix product
_CELLS = 10_000  # of the histogram of shares
LEAST_SHARE = 0.45  # of a text's n-grams, known in its language
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def mark_ngrams(text: str, seen: np.ndarray) -> None:
    """Set seen[bucket] for every n-gram of the whole text."""
    widest = max(NGRAM_SIZES)
    for start in range(0, len(text), _PIECE):
        piece = text[start : start + _PIECE + widest - 1].lower()
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        for size in NGRAM_SIZES:
            count = len(codes) - size + 1
            if count <= 0:
                break
            mixed = np.full(count, size, dtype=np.uint32)
            for k in range(size):
                mixed += codes[k : k + count] * _MULTIPLIERS[k]
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x2C1B3C6D)
            seen[mixed >> np.uint32(32 - BITS)] = True


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


@dataclass
class LanguageModel:
    labels: list[str]
    active: np.ndarray  # buckets that any landmark holds
    landmarks: np.ndarray  # active buckets x landmarks, over the root of a landmark's n-grams
    weights: np.ndarray  # landmarks x labels
    bias: np.ndarray
    held: np.ndarray  # labels x active buckets: which of them landmarks of the label hold

    def decide(self, seen: np.ndarray) -> np.ndarray:
        norms = np.sqrt(np.maximum(seen.sum(axis=1), 1)).astype(np.float32)
        kernel = seen[:, self.active].astype(np.float32) @ self.landmarks
        return (kernel / norms[:, None]) @ self.weights + self.bias

    def known(self, seen: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Of each text's n-grams, the share that the landmarks of its label hold: their kernel with the text, over the text's own."""
        return (seen[:, self.active] & self.held[label]).sum(axis=1) / np.maximum(seen.sum(axis=1), 1)


def _unpacked(packed: list[bytes]) -> np.ndarray:
    """Rows of unit length from bitmaps."""
    bits = np.stack([np.unpackbits(np.frombuffer(b, dtype=np.uint8)) for b in packed]).astype(np.float32)
    return bits / np.sqrt(np.maximum(bits.sum(axis=1), 1))[:, None]


def fit(rows: list[tuple[str, bytes]], n_landmarks: int, ridge: float) -> LanguageModel | None:
    """Fit from (label, packed bitmap) rows."""
    if not rows:
        return None
    labels = sorted({label for label, _ in rows})
    position = {label: i for i, label in enumerate(labels)}
    y = np.array([position[label] for label, _ in rows])
    turn = np.empty(len(rows), dtype=np.int64)  # how many rows of the same label come before
    for k in range(len(labels)):
        turn[y == k] = np.arange((y == k).sum())
    chosen = np.lexsort((y, turn))[: max(n_landmarks, LANDMARKS_EACH * len(labels))]
    base = _unpacked([rows[i][1] for i in chosen])
    active = np.flatnonzero(base.any(axis=0))
    landmarks = np.ascontiguousarray(base[:, active].T)
    held = np.stack([(base[y[chosen] == k][:, active] > 0).any(axis=0) for k in range(len(labels))])
    packed = [b for _, b in rows]
    kernel = np.concatenate([_unpacked(packed[i : i + _ROWS])[:, active] @ landmarks for i in range(0, len(rows), _ROWS)])
    values, vectors = np.linalg.eigh((base @ base.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    to_features = vectors[:, keep] / np.sqrt(values[keep])
    z = kernel @ to_features
    target = np.where(y[:, None] == np.arange(len(labels)), 1.0, -1.0)
    weight = (len(rows) / (len(labels) * np.bincount(y, minlength=len(labels))))[y][:, None]
    mean_z, mean_t = (weight * z).mean(axis=0), (weight * target).mean(axis=0)
    zc, tc = z - mean_z, target - mean_t
    beta = np.linalg.solve(zc.T @ (weight * zc) + ridge * len(rows) * np.eye(zc.shape[1]), zc.T @ (weight * tc))
    return LanguageModel(
        labels, active, landmarks, (to_features @ beta).astype(np.float32), (mean_t - mean_z @ beta).astype(np.float32), held
    )


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    told = set()  # a task's part of the sample: copies of a text have its label and draw
    for batch in batches:
        labels, draws = batch.column("label").to_pylist(), batch.column("draw").to_pylist()
        fresh, packed = [], []
        for row, key in enumerate(zip(labels, draws)):
            if key in told:
                continue
            told.add(key)
            seen = np.zeros(BUCKETS, dtype=bool)
            mark_ngrams(batch.column("text")[row].as_py(), seen)
            fresh.append(row)
            packed.append(np.packbits(seen).tobytes())
        rows = batch.select(["label", "draw"]).take(pa.array(fresh, pa.int32()))
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(packed, pa.binary())], ["label", "draw", "bits"])


def train(
    texts: DataFrame, per_language: int = 300, n_landmarks: int = 192, ridge: float = 1e-4, sample_rows: int = 12_000,
    max_languages: int = 500,
) -> LanguageModel | None:
    """Fit on a sample of `texts` (label, text): the different texts whose draw, a hash of label and text, is lowest."""
    usable = texts.filter(F.col("label").isNotNull() & has_letter(F.col("text")))
    sizes = usable.groupBy("label").agg(F.count("*").alias("n"), F.approx_count_distinct("text", 0.02).alias("different"))
    counts = {r["label"]: max(r["different"], 1) for r in sizes.orderBy(F.desc("n"), "label").limit(max_languages).collect()}
    if not counts:
        return None
    most = min(per_language, max(sample_rows // len(counts), 8))
    # A share of the texts a little above the bound; the lowest draws among them are kept below.
    share = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, (1.2 * most + 30) / n))))
    draw = F.pmod(F.xxhash64("label", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = usable.withColumn("draw", draw).filter(F.col("draw") < share[F.col("label")])
    rows = sample.select("label", "draw", "text").mapInArrow(_bitmaps, "label string, draw double, bits binary")
    by_label: dict[str, list] = {}
    for r in sorted(rows.dropDuplicates(["label", "draw"]).collect(), key=lambda r: (r["label"], r["draw"])):
        by_label.setdefault(r["label"], []).append(bytes(r["bits"]))
    return fit([(k, b) for k, bits in by_label.items() for b in bits[:most]], n_landmarks, ridge)


def least_share(known: DataFrame, model: LanguageModel, lost: float = 1e-4) -> float:
    """The share of known n-grams that a text must reach to be in one of the model's languages.

    It is `LEAST_SHARE`, or less: of the texts of `known` (text), rows that have a language and taught the
    model nothing, no more than the share `lost` may stay below.
    """
    told = predict(known.select("text").filter(has_letter(F.col("text"))), model, names=("lang_pred", "score", "known"))
    cell = F.floor(F.col("known") * _CELLS).cast("int").alias("cell")
    counts = sorted(map(tuple, told.groupBy(cell).agg(F.count("*")).collect()))  # at most _CELLS + 1 rows
    allowed = lost * sum(n for _, n in counts)
    for low, n in counts:
        allowed -= n
        if allowed < 0:
            return min(LEAST_SHARE, low / _CELLS)
    return LEAST_SHARE


def predict(
    docs: DataFrame, model: LanguageModel | None, text_col: str = "text", names: tuple[str, ...] = ("lang_pred", "score")
) -> DataFrame:
    """`docs` with columns of these `names`: language, score and, if there is a third, the share of n-grams known in it.

    Columns of `docs` that have these names are replaced.
    """
    kept = [c for c in docs.columns if c not in names]
    schema = docs.select(*kept).schema.add(names[0], "string")
    for name in names[1:]:
        schema = schema.add(name, "double")
    letters = free_name(docs, "has_letter")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        seen = np.zeros((_ROWS, BUCKETS), dtype=bool)
        for batch in batches:
            texts, usable = batch.column(text_col), batch.column(letters).to_numpy(zero_copy_only=False)
            told = np.full(len(usable), UNDETERMINED, dtype=object)
            scores, known = np.zeros(len(usable)), np.zeros(len(usable))
            index = np.flatnonzero(usable) if model else np.empty(0, dtype=np.int64)
            for start in range(0, len(index), _ROWS):
                rows = index[start : start + _ROWS]
                block = seen[: len(rows)]
                block[:] = False
                for k, row in enumerate(rows):
                    mark_ngrams(texts[int(row)].as_py(), block[k])
                decision = model.decide(block)
                best = decision.argmax(axis=1)
                told[rows] = [model.labels[b] for b in best]
                top = decision[np.arange(len(rows)), best]
                scores[rows] = np.clip((top.astype(np.float64) + 1) / 2, 0, 1)
                if len(names) > 2:
                    known[rows] = model.known(block, best)
            results = [pa.array(told, pa.string()), pa.array(scores), pa.array(known)][: len(names)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + results, [*kept, *names])

    return docs.select(*kept, has_letter(F.col(text_col)).alias(letters)).mapInArrow(score, schema)
