"""SimHash near-duplicates by fuzzy hashing with the binary Golay code.

A fingerprint of 64 bits is cut into segments of 23, 23 and 18 bits. The (23, 12) Golay code is
perfect: every 23-bit word lies within 3 bits of exactly one codeword, whose 12-bit index is the
word's centre. The centres of a word and of its 23 one-bit neighbours are its reach, at most six
different indices; two segments that differ in at most one bit have the centre of the one in the
reach of the other. Spread 3 differing bits over three segments: either one segment is equal and
another differs in at most one bit, or each differs in exactly one. So the keys of a fingerprint are

    one segment and the centre of another; one segment and the reach of another (all six orders)
    reach, centre, centre of the three; centre, reach, reach of the three

and of two fingerprints that link, a key of the one is a key of the other. Keys have 30 bits or
more (23 + 12, 18 + 12 or 36), so that unlike fingerprints rarely meet, at any size of the corpus.

Fingerprints that share a key are compared exactly. A key's fingerprints are searched breadth first,
and only the edges of a spanning forest leave: as many components as with all pairs, but never more
edges than members. Keys with more than `MAX_BUCKET` fingerprints are cut into blocks whose pairs go
to different tasks, so that no group grows without bound and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelscope.llm.common import staged
from parcelscope.llm.components import components

SEGMENTS = ((0, 23), (23, 23), (46, 18))  # first bit, bits
ORDERS = ((0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1))  # the equal segment, the near one
_KIND = 36  # bits of a key below its kind
MAX_DISTANCE = 3
MAX_BUCKET = 4096
SEED = 42
_SHINGLES = 1 << 16  # shingles counted at once

# Fixed value: generator polynomial of the Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101


# --- fingerprints ---------------------------------------------------------------------------


def fingerprint(text: str | None, size: int = 3) -> int:
    """SimHash over shingles of `size` words, repeats included; 0 without a word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest, ones, total = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64), 0
    if len(words) < size:
        return digest(b" ".join(words), SEED)
    for start in range(0, len(words) - size + 1, _SHINGLES):
        part = words[start : start + _SHINGLES + size - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(size))))
        hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "doc_id long, fp long")


# --- the Golay code -------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _correction() -> tuple[np.ndarray, np.ndarray]:
    """(syndrome of each bit position, error pattern of each syndrome)."""
    of_bit = np.zeros(23, dtype=np.int64)
    for bit in range(23):
        value = 1 << bit
        for shift in range(bit - 11, -1, -1):
            if value >> (shift + 11) & 1:
                value ^= GENERATOR << shift
        of_bit[bit] = value
    pattern = np.zeros(1 << 11, dtype=np.int64)
    for a in range(23):
        for b in range(a, 23):
            for c in range(b, 23):
                # With a == b == c one error, with b == c two, else three.
                bits = {a, b, c}
                syndrome, error = 0, 0
                for bit in bits:
                    syndrome ^= int(of_bit[bit])
                    error |= 1 << bit
                pattern[syndrome] = error
    return of_bit, pattern


@lru_cache(maxsize=1)
def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and of the high 11 bits of a word."""
    of_bit, _ = _correction()
    tables = []
    for first, width in ((0, 12), (12, 11)):
        table = np.zeros(1 << width, dtype=np.int64)
        for bit in range(width):
            table[1 << bit : 2 << bit] = table[: 1 << bit] ^ of_bit[first + bit]
        tables.append(table)
    return tables[0], tables[1]


def centre(words: np.ndarray) -> np.ndarray:
    """Index (upper 12 bits) of the one codeword within 3 bits of each 23-bit word."""
    low, high = _syndromes()
    _, pattern = _correction()
    return (words ^ pattern[low[words & 0xFFF] ^ high[words >> 12]]) >> 11


def reach(words: np.ndarray) -> np.ndarray:
    """Centres of each word and its 23 neighbours: a row of 24 indices a word, repeats included."""
    flips = np.concatenate([[0], 1 << np.arange(23)]).astype(np.int64)
    return centre(words[:, None] ^ flips[None, :])


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in `fps`, key) of every key of each fingerprint, without repeats."""
    unsigned = fps.view(np.uint64)
    words = [((unsigned >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    centres, reaches = [centre(w) for w in words], [np.sort(reach(w), axis=1) for w in words]
    fresh = [np.diff(r, axis=1, prepend=-1) != 0 for r in reaches]
    near = [np.nonzero(f) for f in fresh]  # (fingerprint, column of its reach)
    rows, found = [], []
    for kind, (same, other) in enumerate(ORDERS):
        # The centre is in the reach, so these are both sorts of keys.
        row, col = near[other]
        rows.append(row)
        found.append(kind << _KIND | words[same][row] << 12 | reaches[other][row, col])
    kind = len(ORDERS)
    row, col = near[0]
    rows.append(row)
    found.append(kind << _KIND | reaches[0][row, col] << 24 | centres[1][row] << 12 | centres[2][row])
    row, one, two = np.nonzero(fresh[1][:, :, None] & fresh[2][:, None, :])
    rows.append(row)
    found.append(kind << _KIND | centres[0][row] << 24 | reaches[1][row, one] << 12 | reaches[2][row, two])
    row, key = np.concatenate(rows).astype(np.int64), np.concatenate(found)
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    return row[new], key[new]


# --- links ----------------------------------------------------------------------------------


def forest(fps: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of the fingerprints that differ in at most 3 bits."""
    left = fps
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = np.bitwise_count(left ^ at) <= MAX_DISTANCE
            if near.any():
                for x in left[near]:
                    yield at, x
                frontier.extend(left[near])
                left = left[~near]


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy()
        for start in range(0, len(fps), 1024):
            part = fps[start : start + 1024]
            row, key = keys(part)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])], ["key", "fp"])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        groups = batch.column(0)
        ends = groups.offsets.to_numpy()
        flat = groups.values.to_numpy().view(np.uint64)
        size = np.diff(ends)
        pair = ends[:-1][size == 2]
        near = np.bitwise_count(flat[pair] ^ flat[pair + 1]) <= MAX_DISTANCE
        u, v = [flat[pair][near]], [flat[pair + 1][near]]
        for k in np.flatnonzero(size > 2):
            edges = np.array(list(forest(flat[ends[k] : ends[k + 1]])), dtype=np.uint64).reshape(-1, 2)
            u.append(edges[:, 0])
            v.append(edges[:, 1])
        columns = [pa.array(np.concatenate(x).view(np.int64)) for x in (u, v)]
        yield pa.RecordBatch.from_arrays(columns, ["u", "v"])


def links(fps: DataFrame) -> DataFrame:
    """Edges (u, v) between different fingerprints that differ in at most 3 bits: a spanning forest of each key.

    `fps` has one column fp of different fingerprints.
    """
    rows = staged(fps.select("fp").mapInArrow(_key_rows, "key long, fp long"), "golay-keys")
    counts = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(MAX_BUCKET)).cast("int")
    # A small key is one group. A large one is cut into blocks, and every pair of blocks is a group.
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    groups = (
        rows.join(counts.select("key", blocks.alias("blocks")), "key")
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .groupBy("key", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"))
        .agg(F.collect_set("fp").alias("fps"))
        .filter(F.size("fps") > 1)
    )
    return groups.select("fps").mapInArrow(_links, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of `docs`.

    Null and empty texts have fingerprint 0, which links like any other. Rows with equal text, or
    repeated rows, have equal fingerprints and so share a component; component_id is the least
    doc_id reachable. A null doc_id keeps its row and is no component's least id unless alone.
    """
    rows = staged(fingerprints(docs, id_col, text_col), "fingerprints")
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    least = staged(least, "least")
    roots = components(links(least))
    named = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    whole = named.groupBy("root").agg(F.min("least").alias("component_id"))
    member = staged(named.join(whole, "root").select("fp", "component_id"), "members")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(member, "fp").select("doc_id", hexed, "component_id")
