"""Token ids in length-delimited binary files.

Format of a shard, little-endian throughout. A record is framed as

    length of the payload   8 bytes
    masked CRC-32 of those  4 bytes
    payload                 length bytes
    masked CRC-32 of it     4 bytes

and a payload is a flag byte (1: the id is null), the doc_id (8 bytes), the width of an id (1 byte,
2 or 4), and the ids. Beside each shard lies an index: the offset of every record (8 bytes each),
their number (8 bytes) and a masked CRC-32 of all before, so that records can be read in any order.
A checksum is masked by rotating it right by 15 bits and adding a constant.

Documents are sorted by doc_id over all shards (null ids first; of equal ids, by text). A task
writes under a name of its own and renames when the shard is complete, so a task that is run again
replaces its shard by the same bytes; readers follow the manifest, which lists only the shards of
tasks that ended. The manifest has one row a shard; the driver adds up their numbers of ids.

Encoding is done by the tokenizers library. A blank before a visible character always starts a new
piece in this byte-level pre-tokenizer, so runs between such blanks are encoded on their own and kept
in a bounded table, as most come again. Null and empty texts have the end id only.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelscope.llm.bpe import byte_alphabet
from parcelscope.llm.common import fresh_folder, open_store

_MASK = 0xA282EAD8  # fixed value of the checksum mask
_CACHED_RUNS = 1_000_000
_MARKS = ",.;:!?"
_LATIN_END = "\u0250"  # letters below are known to every version of Unicode
_BARE_BLANK = re.compile(r" (?:\s|\Z)")  # a blank before white space or at the end


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))))


def payload(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return struct.pack("<BqB", doc_id is None, doc_id or 0, width) + ids.astype(f"<u{width}").tobytes()


def parse_payload(data: bytes) -> tuple[int | None, np.ndarray]:
    null, doc_id, width = struct.unpack_from("<BqB", data)
    return (None if null else doc_id), np.frombuffer(data, dtype=f"<u{width}", offset=10)


def index_bytes(offsets: list[int]) -> bytes:
    body = np.array(offsets, dtype="<u8").tobytes() + struct.pack("<Q", len(offsets))
    return body + struct.pack("<I", masked_crc(body))


def read_index(data: bytes) -> np.ndarray:
    (crc,) = struct.unpack("<I", data[-4:])
    if masked_crc(data[:-4]) != crc:
        raise ValueError("damaged index")
    (count,) = struct.unpack("<Q", data[-12:-4])
    return np.frombuffer(data, dtype="<u8", count=count)


def read_frame(file) -> bytes | None:
    """Payload of the record at the file's position; None at its end."""
    head = file.read(12)
    if not head:
        return None
    length, crc = struct.unpack("<QI", head)
    if masked_crc(head[:8]) != crc:
        raise ValueError("damaged length")
    data, (crc,) = file.read(length), struct.unpack("<I", file.read(4))
    if masked_crc(data) != crc:
        raise ValueError("damaged record")
    return data


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task on every core already
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


class _Runs(dict):
    """Run of text, without the blank before it -> ids of the blank and the run, as bytes of the given width."""

    def __init__(self, path: str, width: int):
        self.tokenizer, self.code = _tokenizer(path), {2: "H", 4: "I"}[width]
        self.model = self.tokenizer.model
        self.letters = dict(enumerate(byte_alphabet()))
        self.marks = {m: self.encode(m) for m in _MARKS}

    def packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def encode(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids) if text else b""

    def word(self, word: str) -> bytes:
        """Ids of a blank and Latin letters, which are one piece: the library's model alone encodes it."""
        piece = f" {word}".encode().decode("latin-1").translate(self.letters)
        return self.packed([t.id for t in self.model.tokenize(piece)])

    def learn(self, runs: list[str]) -> None:
        fresh = set(runs)
        if len(self) + len(fresh) > _CACHED_RUNS:
            self.clear()
        others = []
        for run in fresh:
            # A mark behind a word is a piece of its own.
            mark = run[-1:] if run[-1:] in self.marks else ""
            word = run[:-1] if mark else run
            if word.isalpha() and max(word) < _LATIN_END:
                self[run] = self.word(word) + self.marks[mark] if mark else self.word(word)
            else:
                others.append(run)
        for start in range(0, len(others), 10_000):
            part = others[start : start + 10_000]
            found = self.tokenizer.encode_batch_fast([" " + r for r in part], add_special_tokens=False)
            self.update(zip(part, [self.packed(f.ids) for f in found]))


@lru_cache(maxsize=2)
def _known_runs(path: str, width: int) -> _Runs:
    """One table for all tasks of a worker process."""
    return _Runs(path, width)


def split_runs(text: str) -> list[str] | None:
    """The text at its blanks; None if a blank stands before other white space."""
    return None if _BARE_BLANK.search(text) else text.split(" ")


def _encoded(texts: list[str], runs: _Runs, width: int, end_id: int) -> Iterator[np.ndarray]:
    split = [split_runs(t) for t in texts]
    known = [s and list(map(runs.get, s[1:])) for s in split]
    runs.learn([r for s, k in zip(split, known) if s and None in k for r, ids in zip(s[1:], k) if ids is None])
    end = runs.packed([end_id])
    for text, parts, found in zip(texts, split, known):
        if parts is None:
            data = runs.encode(text) + end
        else:
            if None in found:
                found = [runs[r] if ids is None else ids for r, ids in zip(parts[1:], found)]
            data = b"".join((runs.encode(parts[0]), *found, end))
        yield np.frombuffer(data, dtype=f"<u{width}")


def write(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> list[dict]:
    """Encode and write all documents to `folder`; returns the manifest, which is also written there."""
    spark = docs.sparkSession
    width = 2 if max(_tokenizer(tokenizer_path).get_vocab_size(with_added_tokens=True) - 1, end_id) < 1 << 16 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        shard = f"shard-{TaskContext.get().partitionId():06d}"
        mine = f"{root}/.{shard}-{uuid.uuid4().hex}"
        out, offsets, at, n_ids, runs = None, [], 0, 0, _known_runs(tokenizer_path, width)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc_id, ids in zip(part.column(0).to_pylist(), _encoded(texts, runs, width, end_id)):
                    if out is None:
                        store.create_dir(root, recursive=True)
                        out = store.open_output_stream(f"{mine}.records")
                    record = frame(payload(doc_id, ids, width))
                    out.write(record)
                    offsets.append(at)
                    at += len(record)
                    n_ids += len(ids)
        if out is None:
            return
        out.close()
        with store.open_output_stream(f"{mine}.index") as index:
            index.write(index_bytes(offsets))
        for kind in ("index", "records"):
            store.move(f"{mine}.{kind}", f"{root}/{shard}.{kind}")
        yield pa.RecordBatch.from_pylist([{"shard": shard, "n_docs": len(offsets), "n_ids": n_ids, "n_bytes": at}])

    ordered = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .repartitionByRange("id", "text" if _repeats(docs, id_col) else "id")
        .sortWithinPartitions("id", "text")
    )
    rows = ordered.mapInArrow(run, "shard string, n_docs long, n_ids long, n_bytes long").collect()
    manifest, start = [], 0
    for r in sorted(rows, key=lambda r: r["shard"]):
        manifest.append(r.asDict() | {"start": start})
        start += r["n_ids"]
    _commit(spark, folder, manifest)
    return manifest


def _repeats(docs: DataFrame, id_col: str) -> bool:
    """Whether an id comes more than once, so that the text must take part in the order of shards."""
    return not docs.groupBy(id_col).agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def _commit(spark: SparkSession, folder: str, manifest: list[dict]) -> None:
    """The manifest in one file, written by Spark so that any store of the cluster will do."""
    lines = [(json.dumps(m),) for m in manifest]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{folder}/manifest")


def read(spark: SparkSession, folder: str, manifest: list[dict] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, in no order; checksums are verified."""
    if manifest is None:
        manifest = [json.loads(r["value"]) for r in spark.read.text(f"{folder}/manifest").collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        for batch in batches:
            for shard, start, n_docs in zip(*(batch.column(n).to_pylist() for n in ("shard", "start", "n_docs"))):
                with store.open_input_stream(f"{root}/{shard}.index") as file:
                    if len(read_index(file.read())) != n_docs:
                        raise ValueError(f"{shard}: index and manifest differ")
                rows: list[tuple] = []
                with store.open_input_stream(f"{root}/{shard}.records", buffer_size=1 << 20) as file:
                    while (data := read_frame(file)) is not None:
                        doc_id, ids = parse_payload(data)
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(rows) == 4096:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    shards = [(m["shard"], m["start"], m["n_docs"]) for m in manifest]
    table = spark.createDataFrame(shards, "shard string, start long, n_docs long")
    # One shard a task: a shard is what one task wrote.
    spread = table.repartition(max(len(shards), 1), "shard")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    spark = docs.sparkSession
    folder = fresh_folder(spark, "token-records")
    return read(spark, folder, write(docs, folder, tokenizer_path, end_id))
