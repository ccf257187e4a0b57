"""Document fingerprints from closed syncmers, in DataFrame functions alone.

A text's stretches of `K` code points are its k-mers. One is a closed syncmer if, of the stretches of `S` code
points inside, the one with the least hash lies at either edge. That hangs on the k-mer alone, so an anchor
stays one whatever stands around it: an edit moves or breaks only the k-mers it touches. A fingerprint has
the `SIZE` anchors with the least hashes, each with the place where it first stands; a text shorter than a
k-mer is one anchor by itself, an empty one has none.

The likeness of two fingerprints is the share of the `SIZE` least hashes of both that are in both, which
estimates the share of common anchors; where two texts agree, common anchors stand equally far apart in both
(`aligned`). As anchors are context-free, a text is never hashed twice: of a head, the anchors that end in it
are a text's own, and what follows it is hashed from K - 1 code points before the seam.

Texts are read as four bytes a code point, so that any stretch is a plain cut of bytes, in parts of `PART` code
points that overlap by K - 1: time grows with the length, memory does not.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelscope.llm.common import staged

K, S, SIZE = 16, 9, 64
WINDOW = K - S + 1  # stretches of S inside a k-mer: a power of two, as minima are doubled
PART = 4096
_HALF_HASH = 31  # bits of an anchor's hash, above the 32 bits of its place
ROWS_PER_BUCKET, MAX_BUCKETS, DRAWN_PER_BUCKET = 4096, 1 << 14, 16


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _cut(codes: Column, start: Column, length: int) -> Column:
    """Bytes of `length` code points from the place `start` on, counted from 0."""
    return F.substring(codes, start * 4 + 1, F.lit(4 * length))


def _least(hashes: Column, n: Column) -> Column:
    """At each place, the least of the WINDOW hashes from there on, by doubling."""

    def doubled(width: int) -> Callable[[Column], Column]:
        return lambda h: F.zip_with(h, F.slice(h, width + 1, F.greatest(n, F.lit(1))), lambda x, y: F.least(x, y))

    width = 1
    while width < WINDOW:
        hashes, width = _let(hashes, doubled(width)), width * 2
    return hashes


def _part_anchors(codes: Column, first: Column) -> Column:
    """Anchors of one part, sorted: hash and place in one number. `first` is the place of the part in its text."""
    n = (F.octet_length(codes) / 4).cast("int")

    def of(hashes: Column) -> Column:
        def chosen(least: Column) -> Column:
            at_edge = lambda i: (F.get(least, i) == F.get(hashes, i)) | (F.get(least, i) == F.get(hashes, i + (WINDOW - 1)))
            places = F.filter(F.sequence(F.lit(0), n - K), at_edge)
            return F.sort_array(F.transform(places, lambda i: _anchor(_cut(codes, i, K), first + i)))

        return _let(_least(hashes, n), chosen)

    hashes = F.transform(F.sequence(F.lit(0), n - S), lambda i: F.xxhash64(_cut(codes, i, S)))
    return F.when(n >= K, _let(hashes, of)).otherwise(F.array().cast("array<long>"))


def _anchor(piece: Column, place: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(F.xxhash64(piece), 64 - _HALF_HASH), 32).bitwiseOR(place.cast("long"))


def hash_of(anchor: Column) -> Column:
    return F.shiftright(anchor, 32)


def place_of(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit((1 << 32) - 1))


def _smallest(anchors: Column, size: int) -> Column:
    """The `size` least of sorted anchors, each hash once, at its first place."""
    fresh = F.filter(anchors, lambda a, i: (i == 0) | (hash_of(a) != hash_of(F.get(anchors, i - 1))))
    return F.slice(fresh, 1, size)


def sketches(text: Column, limits: list[Column | None], size: int = SIZE, after: Column | None = None) -> Column:
    """For each limit the fingerprint of `text`, as sorted numbers, hash above place; null counts as empty.

    A limit leaves the k-mers that end within as many code points, None leaves all. `after` is added to each place.
    """
    none = F.array().cast("array<long>")
    given = F.array((F.lit(0) if after is None else after).cast("int"), *[F.lit(None).cast("int") if x is None else x.cast("int") for x in limits])

    def of(codes: Column, offset: Column, ends: list[Column | None]) -> Column:
        n = (F.octet_length(codes) / 4).cast("int")

        def part(p: Column) -> Column:
            start = p * PART
            held = F.substring(codes, start * 4 + 1, F.lit(4 * (PART + K - 1)))

            def within(anchors: Column, end: Column | None) -> Column:
                inside = anchors if end is None else F.filter(anchors, lambda a: place_of(a) - offset + K <= end)
                return _let(inside, lambda a: _smallest(a, size))

            anchors = _let(held, lambda x: _let(start + offset, lambda first: _part_anchors(x, first)))
            return _let(anchors, lambda a: F.array(*[within(a, end) for end in ends]))

        parts = F.transform(F.sequence(F.lit(0), F.floor((n - K) / PART).cast("int")), part)

        def joined(found: Column) -> Column:
            def nth(j: int) -> Callable[[Column], Column]:
                return lambda x: x[j]

            chosen = [F.sort_array(F.flatten(F.transform(found, nth(j)))) for j in range(len(ends))]
            return F.transform(F.array(*chosen), lambda a: _smallest(a, size))

        single = F.array(_anchor(codes, offset))
        short = F.array(*[single if end is None else F.when(end >= n, single).otherwise(none) for end in ends])
        return F.when(n == 0, F.array(*[none] * len(ends))).when(n < K, short).otherwise(_let(parts, joined))

    # What a lambda asks again and again is computed once before, as a length is counted anew each time.
    def bound(numbers: Column) -> Column:
        ends = [None if x is None else numbers[k + 1] for k, x in enumerate(limits)]
        return _let(F.encode(F.coalesce(text, F.lit("")), "UTF-32"), lambda codes: of(codes, numbers[0], ends))

    return _let(given, bound)


def sketch(text: Column, size: int = SIZE, after: Column | None = None) -> Column:
    """Fingerprint of `text` as sorted numbers, hash above place; null counts as empty."""
    return sketches(text, [None], size, after)[0]


def merged(one: Column, two: Column, size: int = SIZE) -> Column:
    """Fingerprint of all anchors of two."""
    return _let(F.sort_array(F.concat(one, two)), lambda a: _smallest(a, size))


def fingerprint_text(anchors: Column) -> Column:
    """16 hex digits an anchor: its hash, then its place."""
    return F.array_join(F.transform(anchors, lambda a: F.lower(F.lpad(F.hex(a), 16, "0"))), "")


def likeness(one: Column, two: Column, size: int = SIZE) -> Column:
    """Share of the least hashes of both that are in both, 0 to 1; two fingerprints without an anchor are alike."""

    def of(pair: Column) -> Column:
        a, b = pair[0], pair[1]
        least = F.slice(F.sort_array(F.array_union(a, b)), 1, size)
        common = F.size(F.array_intersect(F.array_intersect(least, a), b))
        return F.when(F.size(least) == 0, F.lit(1.0)).otherwise(common / F.size(least))

    return _let(F.array(F.transform(one, hash_of), F.transform(two, hash_of)), of)


def aligned(one: Column, two: Column) -> Column:
    """How many common anchors stand equally far apart in both, for the distance that most have."""

    def of(shifts: Column) -> Column:
        counts = F.transform(F.array_distinct(shifts), lambda d: F.size(F.filter(shifts, lambda s: s == d)))
        return F.coalesce(F.array_max(counts), F.lit(0)).cast("long")

    place = lambda a: F.filter(two, lambda b: hash_of(b) == hash_of(a))
    common = F.array_intersect(F.transform(one, hash_of), F.transform(two, hash_of))
    shifts = lambda c: F.transform(
        F.filter(one, lambda a: F.array_contains(c, hash_of(a))), lambda a: place_of(place(a)[0]) - place_of(a)
    )
    return _let(_let(common, shifts), of)


# --- a text and the next --------------------------------------------------------------------


def _order(id_col: Column, text: Column) -> Column:
    """Sorts by descending id, null ids last, equal ids by a hash of the text."""
    return F.struct(id_col.isNull().alias("none"), F.bitwise_not(F.coalesce(id_col, F.lit(0))).alias("down"), F.xxhash64(text).alias("h"))


def _cuts(keys: list[tuple]) -> Column:
    """Keys as one literal array."""
    rows = [dict(zip(("none", "down", "h"), k)) for k in keys]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<none: boolean, down: long, h: long>>")


def _bucket(cuts: Column, n: int, key: Column) -> Column:
    """How many of the `n` sorted cuts are at most `key`, less one: a binary search."""
    steps = [1 << k for k in reversed(range(max(n - 1, 1).bit_length()))]

    def step(low: Column, width: Column) -> Column:
        return F.when((low + width < n) & (F.get(cuts, low + width) <= key), low + width).otherwise(low)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def _distinct(rows: DataFrame) -> DataFrame:
    """`rows` (id, text) with equal ones as one row of `times`. Only where an id comes again are texts shuffled for it."""
    again = rows.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
    if again.isEmpty():
        return rows.withColumn("times", F.lit(1).cast("long"))
    return staged(rows.groupBy("id", "text").agg(F.count("*").alias("times")), "distinct-texts")


def with_next(rows: DataFrame, carried: dict[str, Column]) -> DataFrame:
    """`rows` (id, text) with `times`, `carried`, next_text and the carried columns of the next row, as next_<name>.

    The next row is that of the next lower id, after the last the first. Rows of one bucket of ids are sorted
    together; a bucket begins at a row that is known beforehand, and a copy of it closes the bucket before. So
    each text is shuffled once, however many rows there are, and no row of a bucket is looked up elsewhere.
    """
    rows = _distinct(rows)
    keyed = rows.withColumn("key", _order(F.col("id"), F.col("text")))
    n, first = keyed.agg(F.count("*").alias("n"), F.min("key").alias("first")).first()
    keys = [tuple(first)] if n else [(False, 0, 0)]
    buckets = min(MAX_BUCKETS, n // ROWS_PER_BUCKET)
    if buckets > 1:
        # Sizes of buckets hang on the draw, which has a bound; what is in them does not.
        share = int(min(1.0, buckets * DRAWN_PER_BUCKET / n) * (1 << 30))
        drawn = keyed.filter(F.pmod(F.xxhash64("id", "key.h"), F.lit(1 << 30)) < share).select("key").distinct()
        found = sorted({tuple(r["key"]) for r in drawn.collect()} | set(keys))
        keys = found[:: max(1, len(found) // buckets)]
    cuts = _cuts(keys)
    keyed = keyed.withColumn("bucket", _bucket(cuts, len(keys), F.col("key")))
    begins = F.get(cuts, F.col("bucket")) == F.col("key")
    before = F.when(F.col("bucket") > 0, F.col("bucket") - 1).otherwise(len(keys) - 1)
    here = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("closes"))
    closing = F.struct(before.cast("int").alias("bucket"), F.lit(True).alias("closes"))
    placed = F.inline(F.when(begins, F.array(here, closing)).otherwise(F.array(here)))
    dealt = keyed.withColumns(carried).select("id", "text", "times", "key", *carried, placed.alias("at_bucket", "closes"))
    by_key = Window.partitionBy("at_bucket").orderBy("closes", "key", "text")
    follow = {f"next_{name}": F.lead(name).over(by_key) for name in ("text", *carried)}
    return dealt.withColumns(follow).filter(~F.col("closes")).drop("key", "at_bucket", "closes")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of `docs`, its fingerprint and that of an edited text: the second half is the next text's beginning.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, aligned_edited,
    aligned_next). The last n_chars / 2 code points, rounded down, give way to the first as many of the text with
    the next lower id (all, if it has fewer; the first follows the last). Null ids come last, equal ids by a hash
    of the text. Of equal rows each but the last is followed by its like. A null text is empty; empty texts have
    an empty fingerprint and are alike. An empty table gives none; other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kept = F.length("text") - F.floor(F.length("text") / 2).cast("int")
    paired = with_next(rows, {"sketched": sketches(F.col("text"), [None, kept])})
    paired = paired.select("*", F.col("sketched")[0].alias("anchors"), F.col("sketched")[1].alias("head"), F.col("next_sketched")[0].alias("next_anchors"))
    # Of equal rows, all but one are followed by their like.
    one = F.struct(
        F.col("next_text").alias("text"), F.col("next_anchors").alias("anchors"), F.lit(1).cast("long").alias("rows")
    )
    like = F.struct(F.col("text"), F.col("anchors"), (F.col("times") - 1).alias("rows"))
    both = F.inline(F.when(F.col("times") > 1, F.array(one, like)).otherwise(F.array(one)))
    paired = paired.select("id", "text", "anchors", "head", both.alias("after_text", "after_anchors", "rows"))
    half = F.floor(F.length("text") / 2).cast("int")
    added = F.substring("after_text", F.lit(1), half)
    edited = F.concat(F.substring("text", F.lit(1), kept), added)
    start = F.greatest(F.lit(0), kept - (K - 1))
    seam = F.concat(F.substring(F.col("text"), start + 1, kept - start), added)
    whole = F.length(edited)
    # A short edited text is one anchor by itself; else what begins before the seam is in the head already.
    rest = F.when(whole < K, sketch(edited)).otherwise(merged(F.col("head"), _long_only(seam, start)))
    full = paired.select("id", "text", "anchors", "after_anchors", "rows", edited.alias("edited"), rest.alias("edited_anchors"))
    return full.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).select(
        F.col("id").alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint_text(F.col("anchors")).alias("fingerprint"),
        fingerprint_text(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("after_anchors")).alias("near_next"),
        aligned(F.col("anchors"), F.col("edited_anchors")).alias("aligned_edited"),
        aligned(F.col("anchors"), F.col("after_anchors")).alias("aligned_next"),
    )


def _long_only(text: Column, after: Column) -> Column:
    """As `sketch`, but a text shorter than a k-mer has no anchor."""
    return F.when(F.length(text) < K, F.array().cast("array<long>")).otherwise(sketch(text, after=after))
