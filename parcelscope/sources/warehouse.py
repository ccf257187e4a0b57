"""Stored tables: a Parquet warehouse laid out by month, or a database over JDBC."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.types import StructType

from parcelscope.functions.dates import label_short, month_end, month_of, month_span, parse_label, shift_month
from parcelscope.schema import ACC_FORM, CRF, MOM_HISTORY, RETURNREPORT, SALESREPORT
from parcelscope.sources.tables import ShipmentTables

BY_MONTH = {"salesreport": "normal_cn_date", "returnreport": "normal_cn_date", "mom_history": None}
SCHEMAS = {
    "salesreport": SALESREPORT,
    "returnreport": RETURNREPORT,
    "acc_form": ACC_FORM,
    "crf": CRF,
    "mom_history": MOM_HISTORY,
}
# Columns a table kept by someone else may lack; they read as null then.
OPTIONAL = {
    "salesreport": ("normal_fsc", "normal_other_charges", "weight_band", "master_origin"),
    "crf": ("cust_type",),
}


def stored_schema(name: str) -> StructType:
    schema = StructType(list(SCHEMAS[name].fields))
    if name in BY_MONTH and "month_start" not in schema.names:
        schema.add("month_start", "date")
    return schema


def write_table(frame: DataFrame, warehouse: str, name: str) -> None:
    """Write one table; monthly tables replace only the months present in `frame`.

    The rebalance hint sizes output files by bytes and splits a month that holds most
    of the rows over many tasks.
    """
    path = f"{warehouse}/{name}"
    if name not in BY_MONTH:
        frame.write.mode("overwrite").parquet(path)
        return
    day = BY_MONTH[name]
    if day is not None and "month_start" not in frame.columns:
        frame = frame.withColumn("month_start", month_of(day))
    (
        frame.hint("rebalance", "month_start")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month_start")
        .parquet(path)
    )


def read_table(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """The stored table in the columns and types of its schema, whatever types the files have.

    A value too large for its column raises an error instead of being cut.
    """
    path = f"{warehouse}/{name}"
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        stored = spark.createDataFrame([], stored_schema(name))  # a table without a single file
    return conform(stored, name)


def warehouse_tables(
    spark: SparkSession, warehouse: str, with_history: bool = True, returns_dated: bool = False
) -> ShipmentTables:
    return ShipmentTables(
        lambda name: read_table(spark, warehouse, name), with_history, returns_dated
    )


def refresh_history(tables: ShipmentTables, warehouse: str, first: date, last: date) -> None:
    """Rebuild the stored account-by-month rows of the months first to last.

    A month that has no shipment any more loses its stored rows as well.
    """
    source = ShipmentTables(tables.frame, returns_dated=tables.returns_dated)
    write_table(source.history(first, last), warehouse, "mom_history")
    shipped = source.shipments(shift_month(first, 0), month_end(last)).select("month_start").distinct()
    present = {r.month_start for r in shipped.collect()}  # at most a row for each month asked for
    for month in month_span(first, last):
        if month not in present:
            remove_folder(shipped.sparkSession, f"{warehouse}/mom_history/month_start={month.isoformat()}")


def make_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def remove_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def folder_files(spark: SparkSession, path: str) -> set[str]:
    """Paths of what a folder has; none where there is no such folder. They come as one text, not one by one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return set()
    paths = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(system.listStatus(target))
    return set(spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(paths)[1:-1].split(",")) - {""}


@contextmanager
def holding(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for a while."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_removed(spark: SparkSession):
    """The shuffle files of a query go when it ends, not when the driver happens to collect its garbage."""
    return holding(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def month_predicates(column: str, first: date, last: date) -> list[str]:
    """WHERE clauses that part all rows: one for each month, those before, after and without a date.

    A JDBC read runs one query for each, in parallel. No row is left out; the filters of a report are
    pushed into each query, so months outside a report's range cost an empty query.
    """
    start, stop = shift_month(first, 0), shift_month(last, 1)
    clauses = [f"{column} < '{start.isoformat()}' OR {column} IS NULL"]
    while start < stop:
        after = shift_month(start, 1)
        clauses.append(f"{column} >= '{start.isoformat()}' AND {column} < '{after.isoformat()}'")
        start = after
    return [*clauses, f"{column} >= '{stop.isoformat()}'"]


def label_predicates(column: str, first: date, last: date) -> list[str]:
    """As month_predicates, for months kept as labels such as May-24."""
    labels = [f"'{month:%b-%y}'" for month in month_span(first, last)]
    rest = f"{column} NOT IN ({', '.join(labels)}) OR {column} IS NULL"
    return [*(f"{column} = {label}" for label in labels), rest]


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def bound_predicates(column: str, bounds: Sequence[str]) -> list[str]:
    """WHERE clauses that part all rows by how many of the given values they reach.

    The database compares; its order may differ from Python's, and the values may come in any order or be
    equal to it. A row reaches some number of them, null none, so it meets one clause and no other.
    """
    reached = " + ".join(f"CASE WHEN {column} >= {_quoted(b)} THEN 1 ELSE 0 END" for b in bounds)
    return [f"({reached}) = {n}" for n in range(len(bounds) + 1)]


def range_predicates(column: str, cuts: Sequence[str]) -> list[str]:
    """WHERE clauses that part all rows at values that the database has put in order, so that an index serves them."""
    quoted = [_quoted(c) for c in cuts]
    clauses = [f"{column} < {quoted[0]} OR {column} IS NULL"]
    clauses += [f"{column} >= {a} AND {column} < {b}" for a, b in zip(quoted, quoted[1:])]
    return [*clauses, f"{column} >= {quoted[-1]}"]


def database_cuts(
    spark: SparkSession, url: str, table: str, column: str, parts: int, properties: dict[str, str]
) -> list[str]:
    """Values that cut a column into `parts` of like size, as the database counts and orders them: `parts` rows at most."""
    query = (
        f"(SELECT part, MIN({column}) AS cut FROM (SELECT {column}, NTILE({parts}) OVER (ORDER BY {column}) AS part "
        f"FROM {table} WHERE {column} IS NOT NULL) ranked GROUP BY part) cuts"
    )
    found = spark.read.jdbc(url, query, properties=properties).collect()
    return [r["cut"] for r in sorted(found, key=lambda r: r["part"])][1:]


def conform(frame: DataFrame, name: str) -> DataFrame:
    """The columns and types of a logical table, from a table kept by someone else.

    Months kept as text gain their first day; optional columns may be missing. The months that a
    table is laid out by stay.
    """
    if name == "mom_history" and "month_start" not in frame.columns:
        frame = frame.withColumn("month_start", parse_label("month"))
    if name == "mom_history" and "month" not in frame.columns:
        frame = frame.withColumn("month", label_short("month_start"))
    absent = [c for c in OPTIONAL.get(name, ()) if c not in frame.columns]
    filled = frame.withColumns({c: F.lit(None) for c in absent}) if absent else frame
    laid_out = name in BY_MONTH and "month_start" in frame.columns
    kept = stored_schema(name) if laid_out else SCHEMAS[name]
    # A column that has its type already stays as it is, so that filters on it reach the files.
    kinds = {f.name: f.dataType for f in filled.schema}
    return filled.select(
        [F.col(f.name) if kinds.get(f.name) == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name) for f in kept]
    )


def jdbc_table(
    spark: SparkSession,
    url: str,
    name: str,
    first: date,
    last: date,
    properties: dict[str, str] | None = None,
    account_bounds: Sequence[str] = (),
    account_parts: int = 1,
) -> DataFrame:
    """Read a whole table of the carrier's database by parallel queries.

    `first` to `last` only say where to part the dated tables; rows outside are read too, if a report
    asks for them. The tables of accounts are parted by `account_bounds`, or into `account_parts` where the
    database says; without either, one query reads them.
    """
    options = {"fetchsize": "10000", **(properties or {})}
    if BY_MONTH.get(name) is not None:
        predicates = month_predicates(BY_MONTH[name], first, last)
    elif name == "mom_history":
        predicates = label_predicates("month", first, last)
    elif account_bounds:
        predicates = bound_predicates("acc_no", account_bounds)
    elif account_parts > 1 and (cuts := database_cuts(spark, url, name, "acc_no", account_parts, options)):
        predicates = range_predicates("acc_no", cuts)
    else:
        return conform(spark.read.jdbc(url, name, properties=options), name)
    return conform(spark.read.jdbc(url, name, predicates=predicates, properties=options), name)


def jdbc_tables(
    spark: SparkSession,
    url: str,
    first: date,
    last: date,
    properties: dict[str, str] | None = None,
    with_history: bool = True,
    account_bounds: Sequence[str] = (),
    returns_dated: bool = False,
    account_parts: int = 1,
) -> ShipmentTables:
    """All tables over JDBC, parted by the months from `first` to `last` and by accounts."""
    return ShipmentTables(
        lambda name: jdbc_table(spark, url, name, first, last, properties, account_bounds, account_parts),
        with_history,
        returns_dated,
    )
