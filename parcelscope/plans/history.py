"""Roll shipments and returns up to one row per account and month."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from parcelscope.functions.dates import label_short
from parcelscope.functions.shipments import zone_slot
from parcelscope.operators.returns import with_returns
from parcelscope.schema import MOM_HISTORY, ZONE_SLOTS

RETURNED = "returned_rows > 0"
CHARGED = f"{RETURNED} and return_charges <> 0"
UNCHARGED = f"{RETURNED} and return_charges = 0"

# What each sum of the roll-up adds up, and for which shipments (None: all of them).
SUMS = {
    "shipments": ("1", None),
    "ret_ship": ("1", RETURNED),
    "r_s_chrg": ("1", CHARGED),
    "r_s_nchrg": ("1", UNCHARGED),
    "kg_0_0_5": ("1", "weight <= 0.5"),
    "kg_0_5_1_0": ("1", "weight > 0.5 and weight <= 1.0"),
    "n_wght": ("weight", None),
    "r_wght": ("weight", RETURNED),
    "r_wght_chrg": ("weight", CHARGED),
    "r_wght_nchrg": ("weight", UNCHARGED),
    "n_wght_chgs": ("normal_weight_charges", None),
    "n_fsc": ("normal_fsc", None),
    "n_oth_chgs": ("normal_other_charges", None),
    "n_rev": ("normal_revenue", None),
    "cod": ("cod", None),
    "ret_revenue": ("return_charges", RETURNED),
}
# The sums that are split by zone as well: prefix of the per-zone columns -> the same.
ZONE_SUMS = {
    "n_s": ("1", "true"),
    "r_s": ("1", RETURNED),
    "n_wght": ("weight", "true"),
    "r_wght": ("weight", RETURNED),
    "n_rev": ("normal_revenue", "true"),
}


# A table may lack these columns; their sums are then unknown, not zero.
MAY_BE_ABSENT = ("n_fsc", "n_oth_chgs")
# Money has more digits than Spark adds up as longs, and a roll-up adds it up ten times a row. So it
# is counted in the smallest unit of its column; cast and sum raise an error where a long has no room.
SENT_IN_UNITS = ("normal_weight_charges", "normal_fsc", "normal_other_charges", "normal_revenue", "cod")


def _in_units(frame: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """Money as whole numbers, and the decimal places of each column."""
    places = {c: frame.schema[c].dataType.scale for c in columns}
    return frame.withColumns({c: F.expr(f"cast({c} * {10**n} as bigint)") for c, n in places.items()}), places


def _sum(name: str, value: str, condition: str | None, places: dict[str, int]) -> str:
    filtered = f" filter (where {condition})" if condition else ""
    total = f"sum({value}){filtered}"
    if value in places:
        unit = f"1{'0' * places[value]}"
        total = f"cast({total} as decimal(19, 0)) / cast({unit} as decimal({len(unit)}, 0))"
        total = f"cast({total} as decimal(28, {places[value]}))"
    return f"{total} as {name}" if name in MAY_BE_ABSENT else f"coalesce({total}, 0) as {name}"


def _roll_up(places: dict[str, int]) -> list[str]:
    plain = [_sum(name, *rule, places) for name, rule in SUMS.items()]
    zoned = [
        _sum(f"{prefix}_{slot}", value, f"slot = '{slot}' and {condition}", places)
        for prefix, (value, condition) in ZONE_SUMS.items()
        for slot in ZONE_SLOTS
    ]
    return plain + zoned


def build_history(
    shipments: DataFrame, returns: DataFrame, customers: DataFrame, chosen: Callable[[DataFrame], DataFrame] = lambda sent: sent
) -> DataFrame:
    """Sums per (account, sales person, month); a shipment counts once however often returned.

    Shipments are cut to what is summed up, money as longs, before they move to their returns and then to
    their account, where the customer meets them. So the many sums of an account and month are made in
    place, and those wide rows, hardly fewer than the shipments, never move. A hot account is split by
    adaptive execution (see session.SETTINGS), which then sums up its parts first. `chosen` takes the
    cut shipments to those that count, by account and month.
    """
    dated = shipments.where("month_start is not null").withColumn("slot", zone_slot())
    sent, places = _in_units(dated, SENT_IN_UNITS)
    narrow = chosen(sent.select("normal_cn", "acc_no", "sp_name", "month_start", "slot", "weight", *SENT_IN_UNITS))
    joined, of_returns = _in_units(with_returns(narrow, returns).drop("normal_cn", "return_rows"), ["return_charges"])
    # Adaptive execution splits a skewed join only if both sides come straight from a shuffle, so these rows move once more.
    one_per_account = (
        customers.groupBy("acc_no")
        .agg(F.expr("min(struct(cust_name, cust_type)) as customer"))
        .select("acc_no", "customer.*")
        .hint("rebalance")
    )
    named = (
        joined.join(one_per_account, "acc_no", "left")
        .groupBy("acc_no", "sp_name", "month_start", "cust_name", "cust_type")
        .agg(*[F.expr(text) for text in _roll_up(places | of_returns)])
        .withColumn("month", label_short("month_start"))
    )
    return named.selectExpr(
        *[f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in MOM_HISTORY]
    )
