"""Sets of accounts as bitmaps that add up exactly: who shipped in a month for whom, and what the forms say.

Every account has a dense number for good. A set is rows of (bucket, bits), 32,768 accounts a bucket; sets of
batches, months or sales persons are united by OR, and all else follows from counts: of two sets, what only the
first has is |A or B| - |B|, what both have is |A| + |B| - |A or B|. Shipments without an account are the one
bit of the bucket `NO_ACCOUNT`, which only counts where no account counts as one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelscope.functions.dates import month_of
from parcelscope.plans.lifecycle import lifecycle_table

BITS = 32768
NO_ACCOUNT = -1
KINDS = ("started", "created", "approved", "both", "complete", "earlier")


# --- building -------------------------------------------------------------------------------


def placed_accounts(accounts: DataFrame) -> DataFrame:
    """`accounts` (acc_no) with the task that has each and its place there. To be written before it is numbered."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return accounts.select("acc_no", F.spark_partition_id().alias("part"), place.alias("place"))


def numbered_accounts(placed: DataFrame, first: int) -> DataFrame:
    """(acc_no, number) counted on from `first` without gaps. The window holds one row for each task of `placed`."""
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    return placed.join(starts, "part").select("acc_no", (F.col("start") + F.col("place") + F.lit(first)).alias("number"))


def _bits(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a number (null: no account) as bitmaps by `keys` and bucket; repeated rows set the same bit."""
    number = F.col("number")
    bucket = F.when(number.isNull(), NO_ACCOUNT).otherwise(F.floor(number / BITS)).cast("int")
    bit = F.when(number.isNull(), 0).otherwise(number % BITS)
    placed = rows.select(*keys, bucket.alias("bucket"), bit.cast("long").alias("bit"))
    return placed.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def shipping_sets(account_months: DataFrame, numbers: DataFrame) -> DataFrame:
    """(month_start, sp_name, bucket, bits) of shipments (acc_no, sp_name, month_start)."""
    keyed = account_months.where("month_start is not null").distinct().join(numbers, "acc_no", "left")
    return _bits(keyed, ["month_start", "sp_name"])


def form_sets(accounts: DataFrame, numbers: DataFrame) -> DataFrame:
    """(kind, month_start, bucket, bits) of forms; one form alone must meet all of a kind.

    started: first shipment; created; approved: both approvals in the month; both: created and approved;
    complete: all that and the first shipment; earlier: first shipment, and all other dates before the month.
    """
    dates = ("creation_date", "finance_approval", "second_approval", "first_cn")
    created, finance, second, first = (month_of(c) for c in dates)
    early = [F.col(c) < first for c in dates[:3]]
    months = {
        "started": first,
        "created": created,
        "approved": F.when(finance == second, finance),
        "both": F.when((created == finance) & (finance == second), created),
        "complete": F.when((created == finance) & (finance == second) & (second == first), created),
        "earlier": F.when(early[0] & early[1] & early[2], first),
    }
    lines = F.array(*[F.struct(F.lit(k).alias("kind"), m.alias("month_start")) for k, m in months.items()])
    said = accounts.where("acc_no is not null").select("acc_no", F.inline(lines)).where("month_start is not null")
    return _bits(said.join(numbers, "acc_no"), ["kind", "month_start"])


# --- counting -------------------------------------------------------------------------------


def _count(condition: Column) -> Column:
    """Members of the union of all sets that meet `condition`."""
    return F.bitmap_count(F.bitmap_or_agg(F.when(condition, F.col("bits"))))


def account_lifecycle(ships: DataFrame, forms: DataFrame, months: Mapping[str, date], year: int) -> DataFrame:
    """The lifecycle table from sets alone: one union of each kind and month for a bucket, then counts."""
    roles = {m: r for r, m in months.items()}
    shipped = [
        ships.where(F.col("month_start") == F.lit(m)).select("bucket", "bits", F.lit(f"active_{r}").alias("tag")) for m, r in roles.items()
    ]
    said = forms.where(F.col("month_start").isin(months["prev"], months["cur"])).select(
        "bucket", "bits", F.concat("kind", F.lit("_"), F.when(F.col("month_start") == F.lit(months["cur"]), "cur").otherwise("prev")).alias("tag")
    )
    rows = said
    for part in shipped:
        rows = rows.unionByName(part)

    def union(*tags: str) -> Column:
        return _count(F.col("tag").isin(*tags))

    active = tuple(f"active_{r}" for r in months)
    counts = {"shipped": union(*active)}
    for role, before in (("prev", "prev1"), ("cur", "prev")):
        counts |= {
            f"now_{role}": union(f"active_{role}"),
            f"then_{role}": union(f"active_{before}"),
            f"either_{role}": union(f"active_{role}", f"active_{before}"),
            f"new_or_{role}": union(*active, f"started_{role}"),
            f"early_or_{role}": union(*active, f"earlier_{role}"),
            **{f"{kind}_{role}": union(f"{kind}_{role}") for kind in KINDS},
        }
    per_bucket = rows.groupBy("bucket").agg(*[c.alias(n) for n, c in counts.items()])
    named = F.col("bucket") >= 0

    def whole(value: Column, condition: Column | None = None) -> Column:
        return F.coalesce(F.sum(value if condition is None else F.when(condition, value)), F.lit(0))

    sums = []
    for role, before in (("prev", "prev1"), ("cur", "prev")):
        c = {n: F.col(f"{n}_{role}") for n in ("now", "then", "either", "new_or", "early_or", *KINDS)}
        in_year = months[role].year == year
        lines = {
            1: whole(c["now"]),
            2: whole(c["either"] - c["then"], named),
            3: whole(F.col("shipped") + c["started"] - c["new_or"], named) if in_year else F.lit(0),
            6: whole(c["either"] - c["now"], named),
            7: whole(c["created"]),
            8: whole(c["approved"]),
            9: whole(c["both"]),
            11: whole(c["complete"]),
            12: whole(F.col("shipped") + c["earlier"] - c["early_or"], named),
        }
        sums += [value.cast("long").alias(f"r{i}_{role}") for i, value in lines.items()]
    return lifecycle_table(per_bucket.agg(*sums))


def _in_both(left: DataFrame, right: DataFrame, keys: Sequence[str], on: Sequence[str]) -> DataFrame:
    """(keys, both): how many members the sets of `left` share with those of `right` that agree on `on` and the bucket."""
    one = left.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("a"))
    two = right.groupBy(*on, "bucket").agg(F.bitmap_or_agg("bits").alias("b"))
    met = one.join(two, [*on, "bucket"]).select(*dict.fromkeys([*keys, *on, "bucket"]), "a", "b")
    names = [c for c in met.columns if c not in ("a", "b")]
    alone = met.select(*names, (F.bitmap_count("a") + F.bitmap_count("b")).alias("alone"), F.explode(F.array("a", "b")).alias("bits"))
    united = alone.groupBy(*names).agg((F.max("alone") - F.bitmap_count(F.bitmap_or_agg("bits"))).alias("both"))
    return united.groupBy(*[n for n in names if n != "bucket"]).agg(F.sum("both").alias("both"))


def _by_month(counts: DataFrame, months: Sequence[date], name: str) -> DataFrame:
    """(sp_name, month_start, name) with zeros, for sales persons that have any; `counts` has (sp_name, month_start, both)."""
    cells = [F.coalesce(F.sum(F.when(F.col("month_start") == F.lit(m), F.col("both"))), F.lit(0)).alias(m.isoformat()) for m in months]
    wide = counts.where("both > 0").groupBy("sp_name").agg(*cells)
    long = wide.unpivot(["sp_name"], [m.isoformat() for m in months], "_label", name)
    return long.select("sp_name", F.to_date("_label").alias("month_start"), F.col(name).cast("long").alias(name))


def approved_accounts_by_sp(ships: DataFrame, forms: DataFrame, months: Sequence[date]) -> DataFrame:
    """Accounts whose two approvals fall in the same listed month, for each sales person they ever shipped with."""
    approved = forms.where((F.col("kind") == "approved") & F.col("month_start").isin(*months))
    owned = ships.where("sp_name is not null and bucket >= 0").groupBy("sp_name", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    each = owned.join(approved.select("bucket", "month_start").distinct(), "bucket")
    return _by_month(_in_both(each, approved, ["sp_name", "month_start"], ["month_start"]), months, "accounts")


def new_active_by_sp(ships: DataFrame, forms: DataFrame, months: Sequence[date]) -> DataFrame:
    """Accounts shipping in the month of their first shipment, per sales person."""
    shipping = ships.where(F.col("month_start").isin(*months) & F.col("sp_name").isNotNull() & (F.col("bucket") >= 0))
    started = forms.where((F.col("kind") == "started") & F.col("month_start").isin(*months))
    return _by_month(_in_both(shipping, started, ["sp_name", "month_start"], ["month_start"]), months, "accounts")


def accounts_lost_by_sp(ships: DataFrame, months: Sequence[date]) -> DataFrame:
    """Accounts a sales person shipped for in one month and no more in the next present one, from sets of both months."""
    dated = ships.where(F.col("month_start").isin(*months))
    present = sorted(r["month_start"] for r in dated.select("month_start").distinct().collect())  # at most one row a month
    pairs = list(zip(present, present[1:]))
    month = F.col("month_start")
    if not pairs:
        return dated.select("sp_name", "month_start", F.lit(0).cast("long").alias("lost_accounts")).limit(0)
    lost = [
        (_count(month.isin(a, b)) - _count(month == F.lit(b))).alias(b.isoformat()) for a, b in pairs
    ]
    began = F.bool_or(month.isin(*present[:-1])).alias("began")
    per_bucket = dated.where("sp_name is not null").groupBy("sp_name", "bucket").agg(*lost, began)
    cells = [F.coalesce(F.sum(F.when(F.col("bucket") >= 0, F.col(f"`{b.isoformat()}`"))), F.lit(0)).alias(b.isoformat()) for _, b in pairs]
    wide = per_bucket.groupBy("sp_name").agg(*cells, F.bool_or("began").alias("began")).where("began").drop("began")
    long = wide.unpivot(["sp_name"], [b.isoformat() for _, b in pairs], "_label", "lost_accounts")
    return long.select("sp_name", F.to_date("_label").alias("month_start"), F.col("lost_accounts").cast("long").alias("lost_accounts"))
