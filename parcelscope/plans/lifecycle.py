"""Accounts between application and loss."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from parcelscope.functions.dates import month_end, month_of, same_month
from parcelscope.operators.reshape import counts_by_month

# Rows of the lifecycle table, in display order.
LIFECYCLE_ROWS = (
    "Active this Month",
    "Active this Month but not in Previous Months",
    "New Active",
    "Revived",
    "Retained from Previous Month",
    "Active in Previous Month but not this month",
    "CRF Created this Month",
    "CRF Approved this Month",
    "CRF Created & Approved this Month",
    "CRF Not Created but approved this Month",
    "CRF Created, Approved and Active this Month",
    "CRF Not Created & Approved this Month but Active this Month",
)


def _within(column: str, month: date) -> Column:
    return F.col(column).between(F.lit(month), F.lit(month_end(month)))


def _form_flags(month: date, year: int, role: str) -> list[Column]:
    """What the forms of one account say about one month; any form may say it."""
    created = _within("creation_date", month)
    approved = _within("finance_approval", month) & _within("second_approval", month)
    first_ships = _within("first_cn", month)
    earlier = [F.col(c) < F.lit(month) for c in ("creation_date", "finance_approval", "second_approval")]
    flags = {
        "new": first_ships & (F.year("first_cn") == year),
        "created": created,
        "approved": approved,
        "both": created & approved,
        "complete": created & approved & first_ships,
        "earlier": first_ships & earlier[0] & earlier[1] & earlier[2],
    }
    return [F.coalesce(F.bool_or(f), F.lit(False)).alias(f"{n}_{role}") for n, f in flags.items()]


def account_lifecycle(
    shipments: DataFrame, accounts: DataFrame, months: Mapping[str, date], year: int
) -> DataFrame:
    """Twelve counts for the previous and the current month.

    `shipments` covers the three months prev1, prev and cur. Shipments and forms are each
    reduced to one row of flags per account, joined on the account once, and counted in
    one pass; no set of accounts is ever compared with another.
    """
    active = (
        shipments.where(F.col("month_start").isin(*months.values()))
        .groupBy("acc_no")
        .agg(*[F.bool_or(F.col("month_start") == m).alias(f"active_{r}") for r, m in months.items()])
        .withColumn("shipped", F.lit(True))
    )
    flags = [c for r in ("prev", "cur") for c in _form_flags(months[r], year, r)]
    forms = accounts.where(F.col("acc_no").isNotNull()).groupBy("acc_no").agg(*flags)
    matrix = active.join(forms, "acc_no", "full_outer")

    named = F.col("acc_no").isNotNull()
    shipped = F.coalesce(F.col("shipped"), F.lit(False))
    before = {"prev": "prev1", "cur": "prev"}
    counts = []
    for role in ("prev", "cur"):
        now, then = F.col(f"active_{role}"), F.col(f"active_{before[role]}")
        rows = {
            1: now,
            2: named & now & ~then,
            3: shipped & F.col(f"new_{role}"),
            6: named & then & ~now,
            7: F.col(f"created_{role}"),
            8: F.col(f"approved_{role}"),
            9: F.col(f"both_{role}"),
            11: F.col(f"complete_{role}"),
            12: shipped & F.col(f"earlier_{role}"),
        }
        counts += [F.count_if(condition).alias(f"r{i}_{role}") for i, condition in rows.items()]
    one_row = matrix.agg(*counts)
    return lifecycle_table(one_row)


def lifecycle_table(one_row: DataFrame) -> DataFrame:
    """The twelve lines from one row of counts r<line>_<role>; three lines follow from others."""
    for role in ("prev", "cur"):
        one_row = one_row.withColumns(
            {
                f"r4_{role}": F.col(f"r2_{role}") - F.col(f"r3_{role}"),
                f"r5_{role}": F.col(f"r1_{role}") - F.col(f"r2_{role}"),
                f"r10_{role}": F.col(f"r8_{role}") - F.col(f"r9_{role}"),
            }
        )
    lines = [
        F.struct(
            F.lit(i).alias("ord"),
            F.lit(text).alias("description"),
            F.col(f"r{i}_prev").alias("prev"),
            F.col(f"r{i}_cur").alias("cur"),
        )
        for i, text in enumerate(LIFECYCLE_ROWS, start=1)
    ]
    table = one_row.select(F.inline(F.array(*lines)))
    return table.withColumn("inc_dec", F.col("cur") - F.col("prev")).orderBy("ord")


def _account_owners(shipments: DataFrame) -> DataFrame:
    """Each account under every sales person it shipped with."""
    owned = shipments.where(F.col("sp_name").isNotNull() & F.col("acc_no").isNotNull())
    return owned.select("acc_no", "sp_name").distinct()


def approved_accounts_by_sp(
    accounts: DataFrame, shipments: DataFrame, months: Sequence[date]
) -> DataFrame:
    """Accounts whose two approvals fall in the same listed month, per sales person."""
    approved = (
        accounts.where(same_month("finance_approval", "second_approval"))
        .select("acc_no", month_of("finance_approval").alias("month_start"))
        .where(F.col("month_start").isin(*months))
        .distinct()
    )
    owned = approved.join(_account_owners(shipments), "acc_no")
    return counts_by_month(owned, "sp_name", "accounts", months)


def new_active_by_sp(
    shipments: DataFrame, accounts: DataFrame, months: Sequence[date]
) -> DataFrame:
    """Accounts shipping in the month of their first shipment, per sales person."""
    owned = shipments.where(F.col("sp_name").isNotNull() & F.col("acc_no").isNotNull())
    shipping = owned.select("acc_no", "sp_name", "month_start").distinct()
    started = accounts.select("acc_no", month_of("first_cn").alias("month_start")).distinct()
    new = shipping.join(started, ["acc_no", "month_start"])
    return counts_by_month(new, "sp_name", "accounts", months)


def accounts_lost_by_sp(shipments: DataFrame, months: Sequence[date]) -> DataFrame:
    """Accounts a sales person shipped for in one month and no more in the next present one.

    An account that moved to another sales person counts as lost. Present months are
    those with any shipment. Each (sales person, account) shrinks to one row of month
    flags with map-side partials, so the comparison needs no join and no window.
    """
    dated = shipments.where(F.col("month_start").isin(*months))
    flags = F.array(*[F.bool_or(F.col("month_start") == F.lit(m)) for m in months])
    calendar = F.array(*[F.lit(m) for m in months])
    present = dated.agg(
        F.array_compact(
            F.array(*[F.when(F.bool_or(F.col("month_start") == F.lit(m)), F.lit(m)) for m in months])
        )
    ).scalar()
    moves = (
        dated.where(F.col("sp_name").isNotNull())
        .groupBy("sp_name", "acc_no")
        .agg(flags.alias("ships"))
        .withColumn("present", present)
        .select("sp_name", "acc_no", "ships", "present", F.posexplode("ships"))
        .where("col")
        .withColumn("calendar", calendar)
        .withColumn(
            "month_start",
            F.expr("array_min(filter(present, m -> m > element_at(calendar, pos + 1)))"),
        )
        .where(F.col("month_start").isNotNull())
        .withColumn(
            "stays", F.expr("element_at(ships, cast(array_position(calendar, month_start) as int))")
        )
        .select("sp_name", "acc_no", "month_start", "stays")
    )
    lost = F.col("acc_no").isNotNull() & ~F.col("stays")
    counts = counts_by_month(moves, "sp_name", "lost_accounts", months, lost)
    followed = F.array_contains(F.slice(present, 2, len(months)), F.col("month_start"))
    return counts.where(followed)
