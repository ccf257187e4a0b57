"""Nearest neighbours by inner product: inverted lists, scanned adaptively by dimension.

Vectors are parted into bands of norms within a factor of 4, so that a few long ones cannot swamp the
others. In a band, inner products become distances by one more coordinate (the root of the band's largest
squared norm less the own squared norm, all divided by that largest norm), so the largest product is the
least distance. Vectors are turned by one random
rotation: then every block of coordinates is a fair sample of the whole distance. Inside a probed list
the distance to a query grows block by block, and a candidate is abandoned as soon as a hypothesis
test on the part seen says that the whole will exceed the query's threshold. The first block is taken for all
pairs at once, as one product of matrices; how many coordinates it has is fitted on the sample, where the test pays.
Everything that is left is scored in double precision on the original vectors. Bands too short to reach the
threshold are not probed.

The lists are the cells of k-means centres. Centres, and how many lists to probe for a recall of
`TARGET` on the sample, are fitted on a bounded sample of at most `SAMPLE` vectors, which reaches the driver as
Arrow columns, never as Python rows; every vector is
indexed. A query's first threshold is its k-th product within the sample, taken in double precision, which
no k-th product over all rows falls below; these k of the sample also stand as found, so no query comes back short.

Lists lie side by side on shelves of as many vectors as there are queries (at least `LEAST_SHELF`, at most `HELD`
bytes of them), and a list that is longer than that is cut by hash. A query goes once to each shelf that holds one of its lists,
so all that the queries move is about as much as the vectors do, up to `HELD` bytes of queries; beyond, the queries are
dealt into several packs, and a task has one shelf and one pack. There it finds each query's lists again, holds `PACK`
queries against `BLOCK` vectors at a time, and raises a query's threshold by what it has found.

Equal vectors are one entry with their least k+1 ids, which is all that a result can need. Vectors
that are null, zero, of another length than most, or hold null or non-finite components take no part,
nor do rows without vec_id; rows repeated with one vec_id and vector count once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelscope.llm.common import staged

SAMPLE = 16_384
TARGET = 0.99
BLOCK = 4096
PACK = 256
STEP = 16  # coordinates of a column block
LEAST = 256  # vectors of a band in the sample, if it has as many
SLACK = 1e-5  # of squared distances between unit vectors in single precision
LEAST_SHELF = 2048  # vectors of a shelf
HELD = 32 << 20  # bytes of the vectors of a shelf, and of the queries of a pack
GATHERED = 30  # times the price of a coordinate in a product of matrices, where pairs are taken one by one
FOUND = 1 << 20  # pairs that a task holds before it keeps the k best of each query
EPSILON = 3.0  # of the test: how far a partial distance must lie beyond the threshold
SEED = 20


def usable(vector: Column, size: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) == size) & finite & F.exists(vector, lambda x: x != 0)


def _kmeans(points: np.ndarray, k: int) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    centres = points[rng.choice(len(points), k, replace=False)].copy()
    for _ in range(12):
        nearest = _nearest(points, centres, 1)[:, 0]
        order = np.argsort(nearest, kind="stable")
        present, starts = np.unique(nearest[order], return_index=True)
        sums = np.add.reduceat(points[order], starts, axis=0)
        centres[present] = sums / np.diff(np.append(starts, len(points)))[:, None]
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray, count: int, ordered: bool = True) -> np.ndarray:
    """The `count` nearest centres of each point, nearest first if `ordered`."""
    out = np.empty((len(points), count), dtype=np.int32)
    norms = (centres**2).sum(axis=1)
    for start in range(0, len(points), 1024):
        part = norms - 2 * (points[start : start + 1024] @ centres.T)
        if count == 1:
            out[start : start + 1024] = part.argmin(axis=1)[:, None]
            continue
        if count < part.shape[1]:
            few = np.argpartition(part, count - 1, axis=1)[:, :count]
        else:
            few = np.broadcast_to(np.arange(count), (len(part), count))
        if ordered:
            order = np.argsort(np.take_along_axis(part, few, axis=1), axis=1, kind="stable")
            few = np.take_along_axis(few, order, axis=1)
        out[start : start + 1024] = few
    return out


class Space:
    """The rotated space of one band of norms and its lists. Vectors are divided by the band's largest norm, queries by their own."""

    def __init__(self, sample: np.ndarray, largest: float, n_vectors: int, k: int, asked: np.ndarray, first: int):
        self.largest, self.k, self.first = largest, k, first  # number of its first list
        self.turn = _turn(sample.shape[1])
        points = self.candidates(sample)
        lists = int(min(max(round(n_vectors**0.5), 1), max(len(sample) // 16, 1)))
        self.centres = _kmeans(points, lists)
        self.probes = self._calibrated(points, asked)
        self.head = self._head(points, asked)

    def candidates(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors.astype(np.float64) / self.largest
        rest = np.sqrt(np.maximum(1 - (scaled**2).sum(axis=1), 0))
        return np.column_stack([scaled, rest]).astype(np.float32) @ self.turn

    def _calibrated(self, points: np.ndarray, asked: np.ndarray) -> int:
        """Lists to probe so that on the sample the share TARGET of the true neighbours is met."""
        if len(self.centres) == 1:
            return 1
        queries = rotated_queries(asked)
        own = _nearest(points, self.centres, 1)[:, 0]
        true = np.argsort(-(queries @ points.T), axis=1)[:, : self.k]
        order = _nearest(queries, self.centres, len(self.centres))
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.broadcast_to(np.arange(order.shape[1], dtype=np.int32), order.shape), axis=1)
        needed = np.take_along_axis(place, own[true], axis=1) + 1
        return int(min(np.ceil(np.quantile(needed, TARGET)) + 1, len(self.centres)))

    def _head(self, points: np.ndarray, asked: np.ndarray) -> int:
        """Coordinates of the first block: as few as leave so few pairs of the sample that the rest of them is cheap."""
        queries, points, size = rotated_queries(asked), points[: 16 * LEAST], points.shape[1]
        gaps = 2 - 2 * (queries @ points.T)
        limits = np.partition(gaps, min(self.k, len(points)) - 1, axis=1)[:, min(self.k, len(points)) - 1]
        limits = np.maximum(limits, 0) * (1 + 1e-4) + SLACK
        price = {size: size}
        for head in range(STEP, size, STEP):
            left = len(survivors(queries, points, limits, head, head)[0]) / gaps.size
            price[head] = head + left * GATHERED * (size - head)
        return min(price, key=price.get)


@lru_cache(maxsize=4)
def _turn(size: int) -> np.ndarray:
    turn, _ = np.linalg.qr(np.random.default_rng(SEED).standard_normal((size + 1, size + 1)))
    return turn.astype(np.float32)


def _units(vectors: np.ndarray) -> np.ndarray:
    exact = vectors.astype(np.float64)
    return exact / np.sqrt((exact**2).sum(axis=1))[:, None]


def rotated_queries(vectors: np.ndarray) -> np.ndarray:
    return np.column_stack([_units(vectors), np.zeros(len(vectors))]).astype(np.float32) @ _turn(vectors.shape[1])


class Bands:
    """A space for each band of norms, and the sample of them all; sent to all tasks, bounded by SAMPLE."""

    def __init__(self, uids: np.ndarray, sample: np.ndarray, band: np.ndarray, sizes: dict[int, tuple[int, float]], k: int):
        """`sizes`: number of vectors and largest norm of each band."""
        self.uids, self.raw, self.k = uids, sample, k
        asked, first = sample[:: max(len(sample) // 256, 1)], 0
        self.spaces: dict[int, Space] = {}
        for b, (n, largest) in sorted(sizes.items()):
            self.spaces[b] = Space(sample[band == b], largest, n, k, asked, first)
            first += len(self.spaces[b].centres)

    def nearest_of_sample(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of the k best of the sample, k-th product) of each query as a unit vector, in double precision."""
        k = min(self.k, len(self.raw))
        products = _units(vectors) @ self.raw.astype(np.float64).T
        best = np.argpartition(-products, k - 1, axis=1)[:, :k]
        least = np.take_along_axis(products, best, axis=1).min(axis=1)
        return best, least if k == self.k else np.full(len(vectors), -np.inf)


def _bound(limits: np.ndarray, seen: int, size: int) -> np.ndarray:
    """What the distance over `seen` coordinates may be at most, if the whole is to stay within the limits."""
    return limits if seen >= size else limits * (seen / size) * (1 + EPSILON / seen**0.5) ** 2


def survivors(queries: np.ndarray, candidates: np.ndarray, limits: np.ndarray, head: int, upto: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions (of queries, of candidates) of the pairs that no test abandons: `head` coordinates at once, then STEP by STEP."""
    size = candidates.shape[1]
    q, c = queries[:, :head], candidates[:, :head]
    # |q - c|^2 <= bound, as q c - |c|^2 / 2 >= (|q|^2 - bound) / 2
    part = np.column_stack([q, np.ones(len(q), q.dtype)]) @ np.column_stack([c, -0.5 * np.einsum("ij,ij->i", c, c)]).T
    own = np.einsum("ij,ij->i", q, q)
    least = (0.5 * (own - _bound(limits, head, size))).astype(part.dtype)
    at, of = np.divmod(np.flatnonzero(part >= least[:, None]), max(len(c), 1))
    if head >= (upto or size):
        return at, of
    partial = own[at] - 2 * part[at, of].astype(np.float64)
    for start in range(head, size, STEP):
        stop = min(start + STEP, size)
        gap = candidates[of, start:stop] - queries[at, start:stop]
        partial = partial + np.einsum("ij,ij->i", gap, gap)
        keep = partial <= _bound(limits, stop, size)[at] if stop < size else partial <= limits[at]
        at, of, partial = at[keep], of[keep], partial[keep]
    return at, of


def scan(query: np.ndarray, candidates: np.ndarray, threshold: float, k: int) -> np.ndarray:
    """Positions of candidates that may be among the k nearest of one query: those that no test abandoned."""
    if len(candidates) <= k:
        return np.arange(len(candidates))
    return survivors(query[None, :], candidates, np.array([threshold]), min(STEP, candidates.shape[1]))[1]


def best_of(at: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions of the k best pairs of each query and of all that equal the last of them, queries with k pairs, their k-th score)."""
    order = np.lexsort((-scores, at))
    own, score = at[order], scores[order]
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.empty(0, dtype=np.int64)
    counts = np.diff(np.append(starts, len(own)))
    last = score[starts + np.minimum(counts, k) - 1]
    return order[score >= np.repeat(last, counts)], own[starts[counts >= k]], last[counts >= k]


def limits_of(products: np.ndarray, largest: float) -> np.ndarray:
    """Squared distances of what has these products with a unit query. Below -SLACK no vector of the band is long enough."""
    return 2 - 2 * products / largest


def match(bands: Bands, lists: np.ndarray, uids: np.ndarray, vectors: np.ndarray, asked: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, ...]:
    """(query, uid, score) of the best k of a shelf's vectors for each query of a pack, by the lists that the query probes."""
    turned, products = rotated_queries(asked), products.copy()
    lengths = np.sqrt((asked.astype(np.float64) ** 2).sum(axis=1))
    kept = [np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0)]
    fresh: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = 0

    def settle() -> None:
        nonlocal kept, fresh, held
        at, of, scores = (np.concatenate(x) for x in zip(kept, *fresh))
        few, full, last = best_of(at, scores, bands.k)
        kept, fresh, held = [at[few], of[few], scores[few]], [], 0
        products[full] = np.maximum(products[full], last / lengths[full])

    order = np.argsort(lists, kind="stable")
    for space in bands.spaces.values():
        low, high = np.searchsorted(lists[order], [space.first, space.first + len(space.centres)])
        own = order[low:high]
        able = np.flatnonzero(limits_of(products, space.largest) > -SLACK)
        if not len(own) or not len(able):
            continue
        here, starts = np.unique(lists[own], return_index=True)
        ends = np.append(starts[1:], len(own))
        column = np.full(len(space.centres), len(here), dtype=np.int64)
        column[here - space.first] = np.arange(len(here))
        asks = np.zeros((len(able), len(here) + 1), dtype=bool)
        for start in range(0, len(able), 1024):
            near = _nearest(turned[able[start : start + 1024]], space.centres, space.probes, ordered=False)
            np.put_along_axis(asks[start : start + 1024], column[near], True, axis=1)
        for n, (first, end) in enumerate(zip(starts, ends)):
            asking = able[asks[:, n]]
            for block in range(first, end, BLOCK):
                members = own[block : min(block + BLOCK, end)]
                candidates = space.candidates(vectors[members])
                for start in range(0, len(asking), PACK):
                    some = asking[start : start + PACK]
                    limits = np.maximum(limits_of(products[some], space.largest), 0) * (1 + 1e-4) + SLACK
                    at, of = survivors(turned[some], candidates, limits, space.head)
                    at, of = some[at], members[of]
                    # Single precision may swap neighbours, so all that are left are scored exactly.
                    fresh.append((at, of, (vectors[of].astype(np.float64) * asked[at].astype(np.float64)).sum(axis=1)))
                    held += len(at)
                    if held > FOUND:
                        settle()
    settle()
    return kept[0], uids[kept[1]], kept[2]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float32).reshape(-1, size)


def _whole(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return np.concatenate([np.empty((0, size), np.float32), *(_matrix(c, size) for c in column.chunks)])


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows of each query row of `vectors` (vec_id, embedding)."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("v"))
    rows = rows.filter("vec_id is not null")
    sizes = rows.filter("size(v) > 0").groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if not sizes:
        return empty
    size = sizes["size"]
    rows = rows.filter(usable(F.col("v"), size))

    # Equal vectors become one entry; a window limit keeps each task's share of a hot one small.
    least = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("n", F.dense_rank().over(least)).filter(F.col("n") <= k + 1)
    entries = few.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    entries = staged(entries.select(F.monotonically_increasing_id().alias("uid"), "v", "ids"), "ann-entries")
    # Bands of norms within a factor of 4, the median norm in the middle of one: few, and each well scaled.
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    middle = entries.agg(F.percentile_approx(norm, 0.5).alias("norm")).first()["norm"]
    if middle is None:
        return empty
    entries = entries.withColumn("band", F.round(F.log2(norm / F.lit(middle)) / 4).cast("int"))
    found = entries.groupBy("band").agg(F.count("*").alias("n"), F.max(norm).alias("largest")).collect()
    bands = {r["band"]: (r["n"], r["largest"] ** 0.5) for r in found}
    whole = sum(n for n, _ in bands.values())
    most = max(min(SAMPLE, (64 << 20) // (4 * size)), 256)
    share = F.coalesce(*(F.when(F.col("band") == b, F.lit(min(1.0, max(most / whole, LEAST / n)))) for b, (n, _) in bands.items()))
    draw = F.pmod(F.xxhash64("v"), F.lit(1 << 30)) / float(1 << 30) / share
    drawn = entries.filter(draw < 1).select("uid", "v", "band", draw.alias("d")).orderBy("d", "uid")
    parts = [drawn.limit(2 * most + 2 * LEAST * len(bands)).select("uid", "v", "band").toArrow()]
    for b in bands.keys() - set(parts[0].column("band").to_pylist()):
        parts.append(entries.filter(F.col("band") == b).select("uid", "v", "band").orderBy("uid").limit(LEAST).toArrow())
    chosen = pa.concat_tables(parts)
    uids, band = (chosen.column(c).to_numpy().astype(np.int64) for c in ("uid", "band"))
    shared = spark.sparkContext.broadcast(Bands(uids, _whole(chosen.column("v"), size), band, bands, k + 1))
    del parts, chosen

    def assigned(batch: pa.RecordBatch) -> np.ndarray:
        v, band = _matrix(batch.column("v"), size), batch.column("band").to_numpy()
        lists = np.empty(len(v), np.int32)
        for b in np.unique(band):
            space, own = shared.value.spaces[int(b)], band == b
            lists[own] = space.first + _nearest(space.candidates(v[own]), space.centres, 1)[:, 0]
        return lists

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(assigned(batch))], ["list"])

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = shared.value
        for batch in batches:
            v = _matrix(batch.column("v"), size)
            near, scores, products = [], [], []
            for start in range(0, len(v), 256):
                part = v[start : start + 256]
                found, least = bands.nearest_of_sample(part)
                near.append(bands.uids[found])
                scores += [(bands.raw[n].astype(np.float64) * x.astype(np.float64)).sum(axis=1) for n, x in zip(found, part)]
                products.append(least)
            ends = pa.array(np.arange(len(v) + 1, dtype=np.int32) * min(bands.k, len(bands.raw)))
            columns = [
                batch.column("quid"), batch.column("v"), pa.array(np.concatenate([np.empty(0), *products])),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, np.int64), *(n.ravel() for n in near)]))),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0), *scores]))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["quid", "v", "product", "uids", "scores"])

    # Equal query vectors are searched once.
    queries = rows.filter(is_query).select("vec_id", "v").distinct()
    distinct = queries.select("v").distinct().select(F.monotonically_increasing_id().alias("quid"), "v")
    wanted = staged(distinct.mapInArrow(seed, "quid long, v array<float>, product double, uids array<long>, scores array<double>"), "ann-queries")
    held = max(HELD // (4 * size), 1)
    n_queries = wanted.count()
    n_packs, shelf = -(-n_queries // held) or 1, min(max(n_queries, LEAST_SHELF), held)
    counts = entries.select("v", "band").mapInArrow(assign, "list int").groupBy("list").count().collect()
    # A list lies on its shelves from `begins` on, and takes one place at least.
    lengths = np.ones(sum(len(s.centres) for s in shared.value.spaces.values()), dtype=np.int64)
    for r in counts:
        lengths[r["list"]] = r["count"]
    begins = np.cumsum(lengths) - lengths

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = assigned(batch)
            places = (begins[lists] + batch.column("hash").to_numpy() % lengths[lists]) // shelf
            columns = [pa.array(places), pa.array(lists), batch.column("uid"), batch.column("v")]
            yield pa.RecordBatch.from_arrays(columns, ["shelf", "list", "uid", "v"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows, highs = begins // shelf, (begins + lengths - 1) // shelf
        for batch in batches:
            v, products = _matrix(batch.column("v"), size), batch.column("product").to_numpy()
            turned = rotated_queries(v)
            goes = np.zeros((len(v), highs.max() + 2), dtype=np.int32)
            for space in shared.value.spaces.values():
                able = np.flatnonzero(limits_of(products, space.largest) > -SLACK)
                lists = space.first + _nearest(turned[able], space.centres, space.probes, ordered=False)
                for near in lists.T:
                    goes[able, lows[near]] += 1
                    goes[able, highs[near] + 1] -= 1
            at, shelves = np.nonzero(np.cumsum(goes, axis=1)[:, :-1] > 0)
            for start in range(0, len(at), BLOCK):
                some = pa.array(at[start : start + BLOCK])
                columns = [pa.array(shelves[start : start + BLOCK]), *(batch.column(c).take(some) for c in ("quid", "v", "product"))]
                yield pa.RecordBatch.from_arrays(columns, ["shelf", "quid", "v", "product"])

    def meet(vectors: pa.Table, asked: pa.Table) -> pa.Table:
        quids = asked.column("quid").to_numpy()
        at, uids, scores = match(
            shared.value, vectors.column("list").to_numpy(), vectors.column("uid").to_numpy(), _whole(vectors.column("v"), size),
            _whole(asked.column("v"), size), asked.column("product").to_numpy(),
        )
        return pa.table({"quid": pa.array(quids[at], pa.int64()), "uid": pa.array(uids, pa.int64()), "score": pa.array(scores, pa.float64())})

    hashed = entries.select("uid", "v", "band", F.pmod(F.xxhash64("uid"), F.lit(1 << 62)).alias("hash"))
    placed = hashed.mapInArrow(place, "shelf long, list int, uid long, v array<float>")
    placed = placed.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(n_packs - 1))))
    sent = wanted.select("quid", "v", "product").mapInArrow(probe, "shelf long, quid long, v array<float>, product double")
    sent = sent.withColumn("pack", F.pmod(F.xxhash64("quid"), F.lit(n_packs)).cast("int"))
    met = placed.groupBy("shelf", "pack").cogroup(sent.groupBy("shelf", "pack")).applyInArrow(meet, "quid long, uid long, score double")
    seeds = wanted.select("quid", F.explode(F.arrays_zip("uids", "scores")).alias("s")).select("quid", "s.uids", "s.scores")
    # One exchange by query for all that follows. Of equal scores at the border all stay, so that ids can settle them below.
    found = met.union(seeds).repartition("quid").dropDuplicates(["quid", "uid"])
    top = found.withColumn("n", F.rank().over(Window.partitionBy("quid").orderBy(F.desc("score")))).filter(F.col("n") <= k + 1)
    named = top.join(entries.select("uid", "ids"), "uid").select("quid", "score", F.explode("ids").alias("vec_id"))
    asked = queries.join(wanted.select("quid", "v"), "v").select(F.col("vec_id").alias("query_id"), "quid")
    answers = named.join(asked, "quid")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = answers.filter("vec_id <> query_id").withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
