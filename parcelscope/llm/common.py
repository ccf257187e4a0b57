"""Helpers the text operators share: tables by name, staged tables, held-out split."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = 2000  # texts can be long, so a batch of them is kept small


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, which their Python may not have on its path, and small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    context = spark.sparkContext
    if getattr(context, "_parcelscope_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="parcelscope-")) / "parcelscope-package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._parcelscope_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`. Only a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="parcelscope-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and go on from the files, which outlive a lost executor."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Recent(dict):
    """Values computed once and kept for a while: when `size` are held, those of the generation before go.

    What comes often moves on into each new generation, so memory stays bounded and frequent keys stay.
    """

    def __init__(self, compute: Callable, size: int):
        super().__init__()
        self.compute, self.size, self.older = compute, size, {}

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def held_out(key: Column) -> Column:
    """True where crc32 of the key as text leaves 0 modulo 5; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def free_name(docs: DataFrame, name: str) -> str:
    """`name`, made longer until `docs` has no such column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, id_col: str, name: str = "row") -> DataFrame:
    """`docs` with a further column `name`, a row number that is unique and not null.

    Where the ids are so, they are the row numbers. Else rows are numbered and written first, so that
    the numbers stay the same whenever a task is run again.
    """
    key = F.col(id_col).cast("long")
    clash = docs.groupBy(key.alias("id")).agg(F.count("*").alias("n")).filter("n > 1 or id is null")
    if clash.isEmpty():
        return docs.withColumn(name, key)
    return staged(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


def keyed_texts(docs: DataFrame, id_col: str, text_col: str, unique: bool = False) -> DataFrame:
    """(row, id, text) of `docs` with a row number that is unique and not null; `unique`: the ids are known to be so."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    if unique:
        return rows.select(F.col("id").alias("row"), "id", "text")
    return numbered(rows, "id").select("row", "id", "text")


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of steps whose results have been written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def open_store(uri: str):
    """(file system, path) of a folder that tasks write their own files to."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)
