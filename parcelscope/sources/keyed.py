"""A warehouse laid out for what its reports join, kept up to date batch by batch.

Shipments and returns lie in buckets of the shipment number, so that summing returns and joining them to
their shipments moves no row; a month is a folder, in it every batch is one, so that landing a batch again
replaces what it wrote. A return is stored under the month of its shipment, whatever its own date: a report of
some months reads those months' returns and no others, and yet counts all of them. Returns that come before
their shipment wait under `WAITING`; as they landed they are kept besides, and placed anew when it comes. Within a bucket rows are sorted by account, with
Bloom filters on it, so that a few accounts touch few row groups.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date
from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from parcelscope.functions.dates import month_of
from parcelscope.plans import account_sets
from parcelscope.plans.history import build_history
from parcelscope.schema import RETURNREPORT, SALESREPORT
from parcelscope.sources.tables import ShipmentTables
from parcelscope.sources.warehouse import conform, folder_files, holding, make_folder, read_table, remove_folder, shuffles_removed, write_table

WAITING = date(1000, 1, 1)
FACTS: dict[str, tuple[StructType, str, str | None]] = {
    "salesreport": (SALESREPORT, "month_start", "acc_no"),
    "returnreport": (RETURNREPORT, "shipment_month", None),
}
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
NUMBERS = "acc_no string, number long"
# So many shipments move at once, or one month: in the roll-up, and in a landing that may read them again.
SPAN_ROWS, LANDED_ROWS = 16_000_000, 64_000_000
DYNAMIC = "spark.sql.sources.partitionOverwriteMode"


def replacing_partitions(spark: SparkSession):
    """An overwrite replaces only the folders it writes to, whatever the session says else."""
    return holding(spark, DYNAMIC, "dynamic")


def tidy(method: Callable) -> Callable:
    """None of the method's queries leaves its shuffle files on disk for the next ones."""

    @wraps(method)
    def run(self, *args, **kwargs):
        with shuffles_removed(self.spark):
            return method(self, *args, **kwargs)

    return run


def spans(sizes: dict[date, int], most: int) -> list[list[date]]:
    """Months in order, in runs of `most` rows or one month."""
    runs, size = [], 0
    for month in sorted(sizes):
        if not runs or size + sizes[month] > most:
            runs.append([])
            size = 0
        runs[-1].append(month)
        size += sizes[month]
    return runs


class KeyedWarehouse:
    """The tables under `folder`. `buckets` holds for a new warehouse; an old one keeps its number.

    A bucket of a month should be some hundred megabytes at most: 1024 buckets for a month of 100 GB. Shipment
    numbers are taken as unique; one that comes in several months counts under the first.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.database = f"parcelscope_{zlib.crc32(self.folder.encode()):08x}"
        self.buckets = self._layout(buckets)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.folder}/_catalog'")
        for name, (schema, month, order) in FACTS.items():
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
            # Adaptive, a filter has the size that its accounts need; else a megabyte in each of the many files.
            bloom = f", 'parquet.bloom.filter.enabled#{order}' 'true', 'parquet.bloom.filter.adaptive.enabled' 'true'" if order else ""
            ordered = f"SORTED BY ({order})" if order else "SORTED BY (normal_cn)"
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.database}.{name} ({columns}, {month} date, batch string) USING parquet OPTIONS ('compression' 'zstd'{bloom}) "
                f"PARTITIONED BY ({month}, batch) CLUSTERED BY (normal_cn) {ordered} INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{name}'"
            )
            make_folder(spark, f"{self.folder}/{name}")
            spark.catalog.recoverPartitions(f"{self.database}.{name}")

    def _layout(self, buckets: int) -> int:
        """The number of buckets is part of the stored table, so it is written down beside it."""
        path = f"{self.folder}/_layout"
        try:
            return self.spark.read.schema("buckets int").json(path).first()["buckets"]
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
        self.spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.json(path)
        return buckets

    def stored(self, name: str) -> DataFrame:
        """A fact with its month and batch."""
        return self.spark.table(f"{self.database}.{name}")

    def frame(self, name: str) -> DataFrame:
        if name in FACTS:
            return self.stored(name).drop("batch")
        return read_table(self.spark, self.folder, name)

    def tables(self, with_history: bool = True) -> ShipmentTables:
        return ShipmentTables(self.frame, with_history)

    # --- landing ----------------------------------------------------------------------------

    @tidy
    def land(self, batch: str, shipments: DataFrame | None = None, returns: DataFrame | None = None, stored: bool = False) -> None:
        """Add a batch of new rows, or put them in place of what landed under its name before.

        Folders are written whole, then those that the batch has no more go, and returns are always placed from
        what landed; so landing a batch again, after a failure too and in any order with others, leaves every
        row once. What the batch changes is noted for `refresh_history`.

        Of many shipments that are `stored`, so that reading them again costs no more than a scan, some months land
        after others, and what moves at once takes less disk.
        """
        if not re.fullmatch(r"[A-Za-z0-9_]+", batch):
            raise ValueError(f"batch {batch!r}: letters, digits and _ only")
        changes = f"{self.folder}/changes/batch={batch}"
        seen = bool(folder_files(self.spark, changes)) or any(b == batch for name in FACTS for month, b in self.folders(name))
        with self._staged(self._keys(batch).union(self.touched(batch)) if seen else None) as before:
            self._put(batch, shipments, returns, stored)
            if before is None:
                self._keys(batch).write.parquet(changes, mode="overwrite")
                return
            with self._staged(before.union(self._keys(batch)).distinct()) as noted:
                noted.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(changes)

    def _put(self, batch: str, shipments: DataFrame | None, returns: DataFrame | None, stored: bool) -> None:
        sources = set()
        if shipments is not None:
            months = {month for month, b in self.folders("salesreport") if b == batch}
            rows = conform(shipments, "salesreport").withColumn("month_start", month_of("normal_cn_date")).withColumn("batch", F.lit(batch))
            self._replace("salesreport", self._by_months(rows) if stored else [rows], {batch})
            sources |= {b for month, b in self.folders("returnreport") if month in months} | self._awaiting(batch)
        if returns is not None:
            path = f"{self.folder}/returns_landed/batch={batch}"
            conform(returns, "returnreport").select(*RETURNREPORT.names).write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "static").parquet(path)
            sources.add(batch)
        if sources:
            schema = StructType(list(RETURNREPORT.fields)).add("batch", "string")
            kept = self.spark.read.schema(schema).parquet(f"{self.folder}/returns_landed").where(F.col("batch").isin(sorted(sources)))
            placed = self._placed(kept, self.stored("salesreport"))
            self._replace("returnreport", [placed.withColumn("shipment_month", F.coalesce("shipment_month", F.lit(WAITING)))], sources)

    def _by_months(self, rows: DataFrame) -> list[DataFrame]:
        """All rows, in parts of whole months; those without a month are with the first."""
        sizes = dict(rows.groupBy("month_start").count().collect())  # a row a month
        undated = sizes.pop(None, 0)
        parts = [F.col("month_start").isin(span) for span in spans(sizes, LANDED_ROWS)]
        if len(parts) < 2:
            return [rows]
        if undated:
            parts[0] |= F.col("month_start").isNull()
        return [rows.where(part) for part in parts]

    def _awaiting(self, batch: str) -> set[str]:
        """Batches with returns that have waited for shipments of `batch`: at most a row each."""
        landed = self.stored("salesreport").where((F.col("batch") == batch) & F.col("month_start").isNotNull()).select("normal_cn")
        waiting = self.stored("returnreport").where(F.col("shipment_month") == F.lit(WAITING))
        return {r["batch"] for r in waiting.join(landed, "normal_cn", "left_semi").select("batch").distinct().collect()}

    def _placed(self, returns: DataFrame, shipments: DataFrame, how: str = "left") -> DataFrame:
        """`returns` with the month of their shipment. The shipments are grouped and joined where they lie."""
        months = shipments.where("normal_cn is not null").groupBy("normal_cn").agg(F.min("month_start").alias("shipment_month"))
        return returns.join(months, "normal_cn", how)

    def _write(self, name: str, rows: DataFrame) -> None:
        """One file for each month, batch and bucket. Rows without a number are of no bucket's join, and are dealt out.

        Rows move by month and bucket, so a task sorts some buckets of some months: there are as many tasks as the
        rows need, whatever the number of buckets.
        """
        table, month = f"{self.database}.{name}", FACTS[name][1]
        others = F.concat_ws("-", *[F.col(f.name).cast("string") for f in FACTS[name][0].fields[1:]])
        bucket = F.pmod(F.hash(F.coalesce("normal_cn", others)), F.lit(self.buckets))
        dealt = rows.select(*self.spark.table(table).columns).repartition(month, "batch", bucket)
        with replacing_partitions(self.spark):
            dealt.write.insertInto(table, overwrite=True)

    @contextmanager
    def _staged(self, rows: DataFrame | None) -> Iterator[DataFrame | None]:
        """Written out before what it was read from is replaced, and gone afterwards; nothing stays nothing."""
        if rows is None:
            yield None
            return
        path = f"{self.folder}/_staging/{uuid.uuid4().hex}"
        try:
            rows.write.parquet(path)
            yield self.spark.read.schema(rows.schema).parquet(path)
        finally:
            remove_folder(self.spark, path)

    def _replace(self, name: str, parts: list[DataFrame], batches: set[str]) -> None:
        """Write all parts, no two of them of one month, then drop the folders of `batches` that have no rows: those without a new file.

        Rows may be read from the table itself, as folders are replaced once all of a part is written.
        """
        before = {folder: self._files(name, *folder) for folder in self.folders(name) if folder[1] in batches}
        for rows in parts:
            self._write(name, rows)
        for folder, files in before.items():
            if not self._files(name, *folder) - files:
                self._drop(name, *folder)

    def _files(self, name: str, month: str, batch: str) -> set[str]:
        return folder_files(self.spark, f"{self.folder}/{name}/{FACTS[name][1]}={month}/batch={batch}")

    def folders(self, name: str) -> list[tuple[str, str]]:
        """(month, batch) of each folder of a fact."""
        shown = self.spark.sql(f"SHOW PARTITIONS {self.database}.{name}").collect()
        return [tuple(part.split("=", 1)[1] for part in r["partition"].split("/")) for r in shown]

    def _drop(self, name: str, month: str, batch: str) -> None:
        key = FACTS[name][1]
        value = "null" if month == NO_MONTH else f"DATE'{month}'"
        self.spark.sql(f"ALTER TABLE {self.database}.{name} DROP IF EXISTS PARTITION ({key} = {value}, batch = '{batch}')")
        remove_folder(self.spark, f"{self.folder}/{name}/{key}={month}/batch={batch}")

    # --- sets of accounts -------------------------------------------------------------------

    def _parquet(self, name: str, schema: str) -> DataFrame:
        """A table kept by path; without rows as long as nothing was written."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
        return self.spark.createDataFrame([], schema)

    def _numbers(self, accounts: DataFrame) -> DataFrame:
        """Numbers of all accounts known, once those of `accounts` that have none got the next ones. A number is for good."""
        known = self._parquet("account_numbers", NUMBERS)
        fresh = accounts.where("acc_no is not null").select("acc_no").distinct().join(known, "acc_no", "left_anti")
        with self._staged(account_sets.placed_accounts(fresh)) as placed:
            if not placed.isEmpty():
                first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
                account_sets.numbered_accounts(placed, first).write.mode("append").parquet(f"{self.folder}/account_numbers")
        return self._parquet("account_numbers", NUMBERS)

    @tidy
    def add_account_sets(self, batch: str) -> None:
        """Who ships in the months of a landed batch, beside what other batches say: sets add up by OR."""
        ships = self.stored("salesreport").where(F.col("batch") == batch).select("acc_no", "sp_name", "month_start")
        sets = account_sets.shipping_sets(ships, self._numbers(ships)).withColumn("batch", F.lit(batch))
        with replacing_partitions(self.spark):
            sets.write.mode("overwrite").partitionBy("month_start", "batch").parquet(f"{self.folder}/account_ships")

    @tidy
    def rebuild_form_sets(self) -> None:
        forms = self.frame("acc_form")
        sets = account_sets.form_sets(forms, self._numbers(forms))
        sets.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.folder}/account_forms")

    def account_sets(self) -> tuple[DataFrame, DataFrame]:
        """(shipping sets, form sets) for parcelscope.plans.account_sets. Months are folders of the first."""
        ships = self._parquet("account_ships", "sp_name string, bucket int, bits binary, month_start date, batch string")
        return ships.drop("batch"), self._parquet("account_forms", "kind string, month_start date, bucket int, bits binary")

    # --- the account-by-month roll-up -------------------------------------------------------

    def _keys(self, batch: str) -> DataFrame:
        """(acc_no, month_start) of a batch's shipments, returns that waited for them included, and of its own returns' shipments."""
        shipped = self.stored("salesreport")
        new = shipped.where(F.col("batch") == batch).select("acc_no", "month_start")
        back = self.stored("returnreport").where((F.col("batch") == batch) & (F.col("shipment_month") > F.lit(WAITING)))
        back = back.select("normal_cn", "shipment_month")
        numbered = shipped.select("normal_cn", "acc_no", "month_start")
        # The month is no key of the join, as buckets know only the number: no fact moves to meet the other.
        same_month = F.datediff("month_start", "shipment_month") == 0
        of_return = numbered.join(back, (numbered["normal_cn"] == back["normal_cn"]) & same_month)
        return new.union(of_return.select("acc_no", "month_start")).where("month_start is not null").distinct()

    def touched(self, batch: str) -> DataFrame:
        """(acc_no, month_start) whose sums the batch changes, or changed when it landed before."""
        return self._parquet("changes", "acc_no string, month_start date, batch string").where(F.col("batch") == batch).drop("batch")

    @tidy
    def rebuild_history(self) -> None:
        tables = self.tables(with_history=False)
        present = {month for month, batch in self.folders("salesreport")} - {NO_MONTH}
        runs = self._spans([date.fromisoformat(month) for month in present])
        for first, last in [(run[0], run[-1]) for run in runs] or [(None, None)]:
            write_table(tables.history(first, last), self.folder, "mom_history")

    def _spans(self, months: list[date]) -> list[list[date]]:
        """`months` in runs that the roll-up is made for at once."""
        dated = self.stored("salesreport").where(F.col("month_start").isin(months))
        return spans(dict.fromkeys(months, 0) | dict(dated.groupBy("month_start").count().collect()), SPAN_ROWS)  # a row a month

    @tidy
    def refresh_history(self, batch: str) -> list[date]:
        """Recompute the stored rows of the accounts and months that `batch` touches; returns these months.

        All other accounts of a month are copied as they are, all other months are not opened.
        """
        with self._staged(self.touched(batch).withColumnsRenamed({"acc_no": "touched_acc", "month_start": "touched_month"})) as keys:
            months = sorted(r["touched_month"] for r in keys.select("touched_month").distinct().collect())  # a row a month
            for run in self._spans(months):
                self._refresh(keys.where(F.col("touched_month").isin(run)), run)
        return months

    def _refresh(self, keys: DataFrame, months: list[date]) -> None:
        def same(rows: DataFrame):
            return rows["acc_no"].eqNullSafe(keys["touched_acc"]) & (rows["month_start"] == keys["touched_month"])

        shipments = self.frame("salesreport").where(F.col("month_start").isin(months))
        returns = self.frame("returnreport").where(F.col("shipment_month").isin(months))
        fresh = build_history(shipments, returns, self.frame("crf"), lambda sent: sent.join(keys, same(sent), "left_semi"))
        stored = self.frame("mom_history")
        stored = stored.where(F.col("month_start").isin(months))
        kept = stored.join(keys, same(stored), "left_anti")
        folders = {month: f"{self.folder}/mom_history/month_start={month.isoformat()}" for month in months}
        before = {month: folder_files(self.spark, path) for month, path in folders.items()}
        # Months are replaced once all is written, so what is kept can be read from them meanwhile.
        write_table(kept.select(*fresh.columns).union(fresh), self.folder, "mom_history")
        for month, path in folders.items():
            if not folder_files(self.spark, path) - before[month]:
                remove_folder(self.spark, path)
