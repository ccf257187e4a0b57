"""Reports answered from what is stored: the same rows as the reports over plain tables.

Most land the given tables in a fresh keyed warehouse, in two batches of which the second brings shipments that
returns have waited for, and late returns of old months; then they read what is stored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelscope.catalog import REPORTS, display_types
from parcelscope.params import ReviewParams
from parcelscope.plans import account_sets
from parcelscope.review import StagedTables, staging_folder
from parcelscope.sources.keyed import KeyedWarehouse
from parcelscope.sources.tables import ShipmentTables
from parcelscope.sources.warehouse import remove_folder, shuffles_removed

BUCKETS, BUCKET_ROWS = 8, 1_000_000  # at least so many buckets, and more where one would have more shipments in all
FIRST, SECOND = "first", "second"


def two_batches(frame: DataFrame, number: str, share: int) -> tuple[DataFrame, DataFrame]:
    """All rows of a table in two parts, the second about one in `share`, by the number; rows without one are in the first."""
    late = F.coalesce(F.crc32(F.col(number).cast("binary")) % share == 0, F.lit(False))
    return frame.where(~late), frame.where(late)


def written(spark: SparkSession, frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path, compression="zstd")
    return spark.read.schema(frame.schema).parquet(path)


def buckets_for(rows: int) -> int:
    """A task joins one bucket of all months, so their number follows the rows."""
    return max(BUCKETS, -(-rows // BUCKET_ROWS))


def landed(spark: SparkSession, tables: ShipmentTables, fallback: str, after_first: Callable[[KeyedWarehouse], None] | None = None) -> KeyedWarehouse:
    folder = staging_folder(spark, fallback)
    with shuffles_removed(spark):
        # Written once, for both batches and to be counted, as the given tables may be joins.
        given = {name: written(spark, tables.frame(name), f"{folder}/_given/{name}") for name in ("salesreport", "returnreport")}
        warehouse = KeyedWarehouse(spark, folder, buckets_for(given["salesreport"].count()))
        for name in ("acc_form", "crf"):
            tables.frame(name).write.mode("overwrite").parquet(f"{warehouse.folder}/{name}")
    sent, back = two_batches(given["salesreport"], "normal_cn", 7), two_batches(given["returnreport"], "return_cn", 5)
    warehouse.land(FIRST, sent[0], back[0], stored=True)
    # What is still to land is kept by itself, so that the rest takes no more disk.
    later = written(spark, sent[1], f"{folder}/_given/later_salesreport"), written(spark, back[1], f"{folder}/_given/later_returnreport")
    for name in given:
        remove_folder(spark, f"{folder}/_given/{name}")
    if after_first:
        after_first(warehouse)
    warehouse.land(SECOND, *later, stored=True)
    remove_folder(spark, f"{folder}/_given")  # all of it has landed
    return warehouse


def joined(name: str):
    """A report over both facts, from buckets."""

    def run(spark: SparkSession, tables: ShipmentTables, params: ReviewParams, fallback: str) -> DataFrame:
        return REPORTS[name](landed(spark, tables, fallback).tables(with_history=False), params)

    return run


def refreshed_history(spark: SparkSession, tables: ShipmentTables, params: ReviewParams, fallback: str) -> DataFrame:
    """The account-by-month roll-up, built from the first batch and brought up to date for what the second touches."""
    warehouse = landed(spark, tables, fallback, KeyedWarehouse.rebuild_history)
    warehouse.refresh_history(SECOND)
    return REPORTS["mom_history_build"](warehouse.tables(), params)


def from_sets(answer: Callable[[DataFrame, DataFrame, ReviewParams], DataFrame]):
    def run(spark: SparkSession, tables: ShipmentTables, params: ReviewParams, fallback: str) -> DataFrame:
        warehouse = landed(spark, tables, fallback, lambda w: w.add_account_sets(FIRST))
        warehouse.add_account_sets(SECOND)
        warehouse.rebuild_form_sets()
        return answer(*warehouse.account_sets(), params)

    return run


def lifecycle_from_sets(ships: DataFrame, forms: DataFrame, params: ReviewParams) -> DataFrame:
    months = params.lifecycle_months
    return account_sets.account_lifecycle(ships, forms, months, params.lifecycle_year or months["cur"].year)


def boards_from_heaps(spark: SparkSession, tables: ShipmentTables, params: ReviewParams, fallback: str) -> DataFrame:
    """The leaderboards over rows written once, by a heap for each board."""
    return REPORTS["top_customers"](StagedTables(spark, tables, staging_folder(spark, fallback)), params)


# name -> (the report with the same rows, how it is answered)
STORED = {
    "top_dest_returns_stored": ("top_dest_returns", joined("top_dest_returns")),
    "top_dest_return_weight_stored": ("top_dest_return_weight", joined("top_dest_return_weight")),
    "dest_day_zone_matrix_stored": ("dest_day_zone_matrix", joined("dest_day_zone_matrix")),
    "mom_history_refreshed": ("mom_history_build", refreshed_history),
    "top_customers_stored": ("top_customers", boards_from_heaps),
    "account_lifecycle_stored": ("account_lifecycle", from_sets(lifecycle_from_sets)),
    "approved_accounts_by_sp_stored": (
        "approved_accounts_by_sp",
        from_sets(lambda ships, forms, p: account_sets.approved_accounts_by_sp(ships, forms, p.account_months)),
    ),
    "new_active_by_sp_stored": (
        "new_active_by_sp",
        from_sets(lambda ships, forms, p: account_sets.new_active_by_sp(ships, forms, p.account_months)),
    ),
    "accounts_lost_by_sp_stored": (
        "accounts_lost_by_sp",
        from_sets(lambda ships, forms, p: account_sets.accounts_lost_by_sp(ships, p.account_months)),
    ),
}


def run(name: str, spark: SparkSession, tables: ShipmentTables, params: ReviewParams, fallback: str) -> DataFrame:
    return display_types(STORED[name][1](spark, tables, params, fallback))
