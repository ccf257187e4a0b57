"""Deterministic sharded WARC archives, with revisit records for equal payloads.

Records are sorted by a key of fixed length (page_id, digest of the payload, hash of the url) and cut into
shards of about equal payload bytes. The cuts come from counts by prefix of the key; a prefix that holds more than a
shard is counted again by longer ones, so neither ids that lie close together nor one id on many rows make a large
shard, and equal input gives equal shards on any cluster. Rows that agree in the whole key and are more than a shard
travel as one row with their number, and are dealt out among shards. Ordinals go on from shard to shard. Each shard
is one task, written as files that roll over once their compressed size passes a limit; each record is a gzip
member of its own with no time stamp, headers and digests are made anew from the payload. A file is
written under a temporary name and renamed when complete; only the manifest, written last, makes files
count, so what a lost task leaves behind is never read.

Of the pages with equal payloads of at least `least_bytes` bytes, the one with the largest page_id is
a response record and the others revisit it; all smaller payloads are response records. Payload
digests are SHA-1 in base 16; payloads count as equal if SHA-256 and length agree.

Null html is an empty payload, a null url an empty target, and null page_ids sort first. Rows repeated with
the same page_id and payload: the first is the response. A null id never is the largest unless alone.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelscope.llm.common import fresh_folder, open_store, staged

LEAST_REVISIT_BYTES = 1000
HISTOGRAM = 1 << 16  # cells counted at once, unless more prefixes than that hold more than a shard
SHARDS = 256  # as many, unless that makes shards smaller or larger than the two bounds
SHARD_BYTES = (4 << 20, 256 << 20)
MOST_SHARDS = 1 << 14  # shards grow beyond the upper bound rather than be more, as the driver holds the cuts
RECORD_BYTES = 500  # of a record beside its payload, about
_PAGE, _SHA, _KEY = 17, 81, 97  # characters of the sort key up to the end of page_id, digest and hash of the url
ROLL_BYTES = 64 << 20
DATE = "2000-01-01T00:00:00Z"  # a fixed value, so that equal input gives equal files
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NO_PAGE = "none"


def record_id(page_id: int | None, ordinal: int) -> str:
    page = _NO_PAGE if page_id is None else str(page_id)
    return f"<urn:x-page:{page}{f':{ordinal}' if ordinal else ''}>"


def page_of(record: str) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(none|-?\d+)(?::\d+)?>", record)
    if not found:
        raise ValueError(f"not a record of this writer: {record}")
    return None if found[1] == _NO_PAGE else int(found[1])


def _header_value(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_bytes(page_id: int | None, ordinal: int, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record, not compressed. refers_to: the record id of the response that a revisit points to."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to else http + payload
    target = _header_value(url or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, ordinal)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}",
        f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
    ]
    if refers_to:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without time stamp or name."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def members(file) -> Iterator[bytes]:
    """The uncompressed members of a gzip stream."""
    pending = b""
    while True:
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not pending:
                pending = file.read(1 << 20)
                if not pending:
                    if parts:
                        raise ValueError("a record is cut off")
                    return
            parts.append(unpacker.decompress(pending))
            pending = unpacker.unused_data
        yield b"".join(parts)


def parse_record(data: bytes) -> dict:
    """Fields of a record; digests and lengths are checked against its bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    length = int(fields["Content-Length"])
    block = rest[:length]
    if not version.startswith("WARC/") or len(block) < length or rest[length:] != b"\r\n\r\n":
        raise ValueError("damaged record")
    if fields["WARC-Block-Digest"] != f"sha1:{hashlib.sha1(block).hexdigest()}":
        raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    n_payload = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != n_payload or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("payload differs from its digest")
    return {
        "page_id": page_of(fields["WARC-Record-ID"]),
        "payload_bytes": n_payload,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": page_of(fields["WARC-Refers-To"]) if revisit else None,
        "url": fields["WARC-Target-URI"],
        "payload": None if revisit else payload,
    }


# --- writing --------------------------------------------------------------------------------


def _digest() -> Column:
    return F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256)


def sort_key(sha: Column) -> Column:
    """The order of the records as text: null pages first, then page_id, digest of the payload, hash of the url."""
    biased = F.lower(F.lpad(F.hex(F.col("page_id").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))
    page = F.coalesce(F.concat(F.lit("1"), biased), F.lit("0" * _PAGE))
    return F.concat(page, sha, F.lower(F.lpad(F.hex(F.xxhash64(F.coalesce("url", F.lit("")))), 16, "0")))


@dataclass
class Layout:
    """Which shard a key belongs to."""

    starts: list[str] = field(default_factory=list)  # least keys of all shards but the first
    numbers: list[int] = field(default_factory=lambda: [0])  # the shard of keys before the first start, then from each
    n_shards: int = 1
    # Of shards that start within a page: its key and rows before, and those of its payload if that is cut as well.
    carried: dict[int, tuple[str, int, str | None]] = field(default_factory=dict)
    hot: dict[str, int] = field(default_factory=dict)  # keys on more rows than a shard -> rows of a shard

    def shard_of(self, key: Column) -> Column:
        if not self.starts:
            return F.lit(0)
        starts, numbers = np.array(self.starts, dtype=object), np.array(self.numbers, dtype=np.int32)

        @F.pandas_udf("int")
        def find(keys: pd.Series) -> pd.Series:
            return pd.Series(numbers[np.searchsorted(starts, keys.to_numpy(dtype=object), side="right")])

        return find(key)


def _cells(keys: DataFrame, most: int, depth: int) -> list[tuple[str, int, int]]:
    """(prefix, bytes, rows) of cells that part all keys, in order; none but a whole key has more than `most` bytes."""
    spark, among, heavy, cells = keys.sparkSession, keys, 1, []
    while True:
        step = 4
        while step > 1 and heavy * 16**step > HISTOGRAM:
            step -= 1
        depth = min(depth + step, _KEY)
        cell = F.substring("key", 1, depth)
        counted = among.groupBy(cell.alias("cell")).agg(F.sum(F.col("n") + RECORD_BYTES), F.count("*"))
        rows = [tuple(r) for r in counted.collect()]
        if depth == _KEY:
            return sorted(cells + rows)
        cells += [r for r in rows if r[1] <= most]
        large = [r[0] for r in rows if r[1] > most]  # fewer than there will be shards
        if not large:
            return sorted(cells)
        heavy = len(large)
        names = spark.createDataFrame([(c,) for c in large], "cell string")
        among = among.join(F.broadcast(names), cell == F.col("cell"), "left_semi")
        # What all keys of each such cell have in common need not be looked at.
        ends = among.groupBy(cell.alias("cell")).agg(F.min("key"), F.max("key")).collect()
        depth = max(depth, min(len(os.path.commonprefix([a, b])) for _, a, b in ends))


def layout(keys: DataFrame, shard_bytes: tuple[int, int]) -> Layout:
    """Shards of the rows of `keys` (key, n)."""
    out = Layout()
    ends = keys.agg(F.min("key"), F.max("key"), F.sum(F.col("n") + RECORD_BYTES)).first()
    if ends[0] is None:
        return out
    most = max(min(max(ends[2] // SHARDS, shard_bytes[0]), shard_bytes[1]), ends[2] // MOST_SHARDS)
    filled, shard = 0, 0
    page = payload = ""
    of_page = of_payload = 0  # rows of the page, and of its payload, in the cells before

    def start(key: str) -> None:
        out.starts.append(key)
        out.numbers.append(shard)
        if len(key) > _PAGE and of_page:
            out.carried[shard] = (page, of_page, payload if of_payload else None)

    for cell, n, rows in _cells(keys, most, min(len(os.path.commonprefix([ends[0], ends[1]])), _KEY - 1)):
        # A cell shorter than a page's key is the only one of that page.
        if cell[:_PAGE] != page:
            page, of_page = cell[:_PAGE], 0
        if cell[:_SHA] != payload:
            payload, of_payload = cell[:_SHA], 0
        if filled and filled + n > most:
            shard, filled = shard + 1, 0
            start(cell)
        if n > most and rows > 1:
            each = max(most * rows // n, 1)
            out.hot[cell] = each
            for done in range(each, rows, each):
                shard += 1
                out.carried[shard] = (page, of_page + done, payload)
            filled = n
        else:
            filled += n
        of_page += rows
        of_payload += rows
    out.n_shards = shard + 1
    return out


def _marked(pages: DataFrame, least_bytes: int) -> DataFrame:
    """`pages` with an ordinal among rows of one page_id, and `response`: the page_id that a row's payload is stored under."""
    big = pages.filter(F.col("n") >= least_bytes).groupBy("sha", "n").agg(
        F.max("page_id").alias("largest"), F.count("*").alias("copies")
    )
    # Only payloads that come more than once need a partner.
    repeated = big.filter("copies > 1").select(F.col("sha").alias("sha_"), F.col("n").alias("n_"), "largest")
    return pages.join(repeated, (F.col("sha") == F.col("sha_")) & (F.col("n") == F.col("n_")), "left").drop("sha_", "n_")


def write(
    pages: DataFrame, folder: str, shard_bytes: tuple[int, int] = SHARD_BYTES, roll_bytes: int = ROLL_BYTES,
    least_bytes: int = LEAST_REVISIT_BYTES,
) -> list[dict]:
    """Write `pages` (page_id, url, html) to `folder`; returns the manifest, a row a file, which is also written there."""
    spark = pages.sparkSession
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").withColumn("sha", _digest())
    # Digests are a small table: who revisits whom, and the shards, are settled before any html is moved.
    keys = staged(
        plain.select("page_id", "sha", F.coalesce(F.octet_length("html"), F.lit(0)).alias("n"), sort_key(F.col("sha")).alias("key")),
        "page-keys",
    )
    small = keys.select("page_id", "sha", "n")
    revisits = staged(
        _marked(small, least_bytes).filter("largest is not null").select("page_id", "sha", "largest").distinct(), "revisits"
    )
    shards = layout(keys, shard_bytes)
    keyed = plain.withColumn("key", sort_key(F.col("sha")))
    columns = ["shard", "key", "page_id", "sha", "url", "html", "copies"]
    sharded = keyed.withColumn("shard", shards.shard_of(F.col("key"))).withColumn("copies", F.lit(1).cast("long")).select(columns)
    if shards.hot:
        names = F.broadcast(spark.createDataFrame(list(shards.hot.items()), "hot string, each long"))
        alike = keyed.join(names, F.col("key") == F.col("hot")).groupBy("key", "each").agg(
            *(F.min(c).alias(c) for c in ("page_id", "sha", "url", "html")), F.count("*").alias("rows")
        )
        pieces = alike.select("*", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.col("each"))).alias("piece", "done"))
        dealt = pieces.withColumn("shard", shards.shard_of(F.col("key")) + F.col("piece")).withColumn(
            "copies", F.least("each", F.col("rows") - F.col("done"))
        )
        sharded = sharded.join(names, F.col("key") == F.col("hot"), "left_anti").union(dealt.select(columns))
    joined = sharded.join(
        revisits.select(F.col("page_id").alias("page_"), F.col("sha").alias("sha_"), "largest"),
        F.col("page_id").eqNullSafe(F.col("page_")) & (F.col("sha") == F.col("sha_")),
        "left",
    ).select("shard", "key", "page_id", "url", "html", "largest", "copies")
    ordered = joined.repartitionById(shards.n_shards, F.col("shard")).sortWithinPartitions("shard", "key", "url")
    carried = shards.carried

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        roll = _Roll(store, root, roll_bytes)
        current, ordinal, page_key, payload_key = None, 0, None, None
        for batch in batches:
            columns = [batch.column(n) for n in ("shard", "key", "page_id", "url", "html", "largest", "copies")]
            for row in zip(*columns):
                shard, key, page, url, html, largest, copies = (c.as_py() for c in row)
                if shard != current:
                    current = shard
                    page_key, ordinal, payload_key = carried.get(shard, (None, 0, None))
                if key[:_PAGE] != page_key:
                    page_key, ordinal = key[:_PAGE], 0
                first, payload_key = key[:_SHA] != payload_key, key[:_SHA]
                payload = (html or "").encode("utf-8", "surrogatepass")
                for _ in range(copies):
                    refers = None
                    if largest is not None and not (page == largest and first):
                        refers = record_id(largest, 0)
                    done = roll.add(shard, member(record_bytes(page, ordinal, url, payload, refers)))
                    yield from _entry(done)
                    ordinal, first = ordinal + 1, False
        yield from _entry(roll.close())

    schema = "file string, shard int, part int, n_records long, n_bytes long, sha256 string"
    manifest = sorted((r.asDict() for r in ordered.mapInArrow(run, schema).collect()), key=lambda m: m["file"])
    spark.createDataFrame([(json.dumps(m),) for m in manifest], "value string").coalesce(1).write.text(f"{folder}/manifest")
    return manifest


def _entry(done: dict | None) -> Iterator[pa.RecordBatch]:
    if done:
        kinds = [("file", pa.string()), ("shard", pa.int32()), ("part", pa.int32()), ("n_records", pa.int64()), ("n_bytes", pa.int64()), ("sha256", pa.string())]
        yield pa.RecordBatch.from_pylist([done], pa.schema(kinds))


class _Roll:
    """The file that a task is writing."""

    def __init__(self, store, root: str, limit: int):
        self.store, self.root, self.limit = store, root, limit
        self.out = None
        self.shard, self.part = None, 0

    def add(self, shard: int, data: bytes) -> dict | None:
        """Append a record; the entry of the file that was completed first, if any."""
        done = None
        if self.out and (shard != self.shard or self.n_bytes >= self.limit):
            done = self.close()
        if not self.out:
            self.part = self.part + 1 if shard == self.shard else 0
            self.shard = shard
            self.store.create_dir(self.root, recursive=True)
            self.temporary = f"{self.root}/.writing-{uuid.uuid4().hex}"
            self.out = self.store.open_output_stream(self.temporary)
            self.n_records = self.n_bytes = 0
            self.hash = hashlib.sha256()
        self.out.write(data)
        self.hash.update(data)
        self.n_records += 1
        self.n_bytes += len(data)
        return done

    def close(self) -> dict | None:
        if not self.out:
            return None
        self.out.close()
        self.out = None
        name = f"pages-{self.shard:06d}-{self.part:04d}.warc.gz"
        self.store.move(self.temporary, f"{self.root}/{name}")
        return {
            "file": name, "shard": self.shard, "part": self.part, "n_records": self.n_records,
            "n_bytes": self.n_bytes, "sha256": self.hash.hexdigest(),
        }


# --- reading --------------------------------------------------------------------------------

_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(spark: SparkSession, folder: str, manifest: list[dict] | None = None, payloads: bool = False) -> DataFrame:
    """The records of all files of the manifest; with `payloads` also url and payload."""
    if manifest is None:
        manifest = [json.loads(r["value"]) for r in spark.read.text(f"{folder}/manifest").collect()]
    schema = _READ + (", url string, payload binary" if payloads else "")
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = pa.schema(
        [(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]]) for n, c in zip(names, schema.split(", "))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        for batch in batches:
            for name, n_records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, found = [], 0
                with store.open_input_stream(f"{root}/{name}", compression=None, buffer_size=1 << 20) as file:
                    for data in members(file):
                        record = parse_record(data)
                        rows.append({n: record[n] for n in names})
                        found += 1
                        if len(rows) == 512:
                            yield pa.RecordBatch.from_pylist(rows, kinds)
                            rows = []
                if found != n_records:
                    raise ValueError(f"{name}: {found} records, the manifest has {n_records}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kinds)

    files = spark.createDataFrame([(m["file"], m["n_records"]) for m in manifest], "file string, n_records long")
    return files.repartition(max(len(manifest), 1), "file").mapInArrow(run, schema)


def write_and_read(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    folder = fresh_folder(spark, "warc")
    return read(spark, folder, write(pages, folder))
