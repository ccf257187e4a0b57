"""What a keyed warehouse's tasks and files hold as the tables grow."""

from __future__ import annotations

import time
from datetime import date
from pathlib import Path

from pyspark.sql import functions as F

from parcelscope import stored
from parcelscope.sources import keyed
from parcelscope.sources.keyed import KeyedWarehouse
from parcelscope.sources.tables import ShipmentTables
from tests.frames import customers, forms, returns, shipments


def many(spark, n):
    """n shipments over 12 months, every third one returned."""
    one = shipments(spark, {"normal_cn": "x"})
    sent = one.drop("normal_cn", "normal_cn_date").crossJoin(
        spark.range(n).select(F.concat(F.lit("n"), "id").alias("normal_cn"), F.expr("add_months(date'2024-01-05', cast(id % 12 as int))").alias("normal_cn_date"))
    )
    back = returns(spark, {"normal_cn": "x"}).drop("normal_cn", "return_cn").crossJoin(
        spark.range(0, n, 3).select(F.concat(F.lit("n"), "id").alias("normal_cn"), F.concat(F.lit("r"), "id").alias("return_cn"))
    )
    return sent.select(*one.columns), back.select("normal_cn", "normal_cn_date", "return_cn", "return_weight_charges")


def test_writing_takes_more_tasks_than_buckets(spark, tmp_path, monkeypatch):
    """The rows of a bucket are not one task's, yet a month's bucket stays one file."""
    warehouse, seen = KeyedWarehouse(spark, str(tmp_path), 2), []
    sent, back = many(spark, 4800)
    partitions = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    frame = type(sent)
    first = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, *a: seen.append(first(self, *a)) or seen[-1])
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        warehouse.land("a", sent, back)
        (shipped,) = [f for f in seen if "weight" in f.columns]
        sizes = [r["count"] for r in shipped.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions[0])
        spark.conf.set("spark.sql.adaptive.enabled", partitions[1])
    assert len(sizes) > 4 and max(sizes) < 4800 // 4
    files = list(Path(warehouse.folder, "salesreport").rglob("*.parquet"))
    assert len(files) == 12 * 2
    assert warehouse.stored("salesreport").count() == 4800 and warehouse.stored("returnreport").count() == 1600


def test_bloom_filters_are_as_large_as_their_accounts_need(spark, tmp_path):
    warehouse = KeyedWarehouse(spark, str(tmp_path), 2)
    warehouse.land("a", many(spark, 480)[0])
    files = list(Path(warehouse.folder, "salesreport").rglob("*.parquet"))
    assert files and max(f.stat().st_size for f in files) < 100_000


def test_buckets_follow_the_rows(spark, tmp_path, monkeypatch):
    assert stored.buckets_for(0) == stored.buckets_for(8_000_000) == 8 and stored.buckets_for(216_000_001) == 217
    monkeypatch.setattr(stored, "BUCKET_ROWS", 100)
    sent, back = many(spark, 1200)
    tables = ShipmentTables.of(salesreport=sent, returnreport=back, acc_form=forms(spark, {"acc_no": "A"}), crf=customers(spark, {"acc_no": "A"}))
    warehouse = stored.landed(spark, tables, str(tmp_path))
    assert warehouse.buckets == 12
    assert warehouse.stored("salesreport").count() == 1200 and warehouse.stored("returnreport").where("shipment_month > '2000-01-01'").count() == 400


# --- disk -----------------------------------------------------------------------------------


def shuffle_blocks(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {b for b in disk.getAllBlocks().mkString(",").split(",") if b.startswith("shuffle_")}


def test_landing_leaves_no_copies(spark, tmp_path):
    """What was written to be read once is gone, as are the shuffle files, though the driver collects no garbage."""
    sent, back = many(spark, 1200)
    tables = ShipmentTables.of(salesreport=sent, returnreport=back, acc_form=forms(spark, {"acc_no": "A"}), crf=customers(spark, {"acc_no": "A"}))
    before, given = shuffle_blocks(spark), []

    def after_first(warehouse):
        given.extend(sorted(p.name for p in Path(warehouse.folder, "_given").iterdir()))
        warehouse.rebuild_history()
        warehouse.add_account_sets("first")

    warehouse = stored.landed(spark, tables, str(tmp_path), after_first)
    assert given == ["later_returnreport", "later_salesreport"]
    warehouse.refresh_history("second")
    left = [p for p in Path(warehouse.folder).rglob("*.parquet") if "_given" in p.parts or "_staging" in p.parts]
    assert not left and not Path(warehouse.folder, "_given").exists()
    until = time.time() + 20
    while (more := shuffle_blocks(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not more
    assert warehouse.stored("salesreport").count() == 1200 and warehouse.stored("returnreport").where("shipment_month > '2000-01-01'").count() == 400


def test_shipments_are_written_once(spark, tmp_path, monkeypatch):
    """A landing writes no second copy of its shipments on the way to their buckets."""
    warehouse = KeyedWarehouse(spark, str(tmp_path), 2)
    sent, back = many(spark, 240)
    copied, stage = [], KeyedWarehouse._staged
    monkeypatch.setattr(KeyedWarehouse, "_staged", lambda self, rows: (copied.append(rows.columns if rows is not None else []), stage(self, rows))[1])
    for _ in range(2):
        warehouse.land("a", sent, back)
        assert not any("normal_cn" in c for c in copied)
        assert warehouse.stored("salesreport").count() == 240 and warehouse.stored("returnreport").count() == 80


def test_what_a_batch_changes_is_found_where_its_rows_lie(spark, tmp_path):
    warehouse = KeyedWarehouse(spark, str(tmp_path), 2)
    warehouse.land("a", *many(spark, 240))
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for key, value in zip(before, ("-1", "false")):
        spark.conf.set(key, value)
    try:
        plan = warehouse._keys("a")._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert "hashpartitioning(normal_cn" not in plan and "SortMergeJoin [normal_cn" in plan


def test_months_land_one_after_another(spark, tmp_path, monkeypatch):
    """Of many stored shipments some months move at a time; no row is lost, with a month or without."""
    sent, back = many(spark, 1200)
    undated = sent.limit(5).withColumns({"normal_cn_date": F.lit(None).cast("date"), "normal_cn": F.concat(F.lit("u"), "normal_cn")})
    sent.union(undated).write.parquet(f"{tmp_path}/given")
    given, written, write = spark.read.parquet(f"{tmp_path}/given"), [], KeyedWarehouse._write
    monkeypatch.setattr(KeyedWarehouse, "_write", lambda self, name, rows: (written.append((name, rows)), write(self, name, rows)))
    monkeypatch.setattr(keyed, "LANDED_ROWS", 350)
    warehouse = KeyedWarehouse(spark, f"{tmp_path}/keyed", 2)
    for _ in range(2):
        written.clear()
        warehouse.land("a", given, back, stored=True)
        parts = [rows.count() for name, rows in written if name == "salesreport"]
        assert len(parts) == 4 and sum(parts) == 1205 and max(parts) <= 350
        assert sorted(r.normal_cn for r in warehouse.stored("salesreport").collect()) == sorted(r.normal_cn for r in given.collect())
    assert warehouse.stored("returnreport").where("shipment_month > '2000-01-01'").count() == 400
    # With fewer months and none undated, no folder of the others stays.
    warehouse.land("a", given.where("normal_cn_date < '2024-03-01'"), stored=True)
    assert {m for m, _ in warehouse.folders("salesreport")} == {"2024-01-01", "2024-02-01"}
    assert warehouse.stored("salesreport").count() == 200


def test_the_roll_up_is_made_by_months(spark, tmp_path, monkeypatch):
    """Both building and refreshing it take some months at a time, and no copy of it is written on the way."""
    made, write = [], keyed.write_table
    monkeypatch.setattr(keyed, "write_table", lambda frame, folder, name: (made.append(name), write(frame, folder, name)))
    monkeypatch.setattr(keyed, "SPAN_ROWS", 300)
    customers(spark, {"acc_no": "A"}).write.parquet(f"{tmp_path}/crf")
    warehouse = KeyedWarehouse(spark, str(tmp_path), 2)
    sent, back = many(spark, 1200)
    late = F.col("normal_cn").endswith("7")
    warehouse.land("a", sent.where(~late), back.where(~late))
    warehouse.rebuild_history()
    assert len(made) == 4
    warehouse.land("b", sent.where(late), back.where(late))
    months = warehouse.refresh_history("b")
    assert len(made) == 4 + 2 and months == [date(2024, m, 1) for m in range(1, 13) if m % 2 == 0]
    full = warehouse.tables(with_history=False).history()
    assert sorted(map(repr, warehouse.frame("mom_history").select(*full.columns).collect())) == sorted(map(repr, full.collect()))
