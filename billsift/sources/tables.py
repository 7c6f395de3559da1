"""The invoice table, the quarantine and the run log."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from billsift import schemas
from billsift.functions.dates import parse_invoice_date
from billsift.operators import load
from billsift.session import discard, new_path
from billsift.sources.csv_files import read_records_csv

_CORE_COLUMNS = ["invoice_id", "invoice_date", "vendor_name", "subtotal", "tax_amount", "grand_total"]


def _path_missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PROCESSED).parquet(path)


def read_processed_or_none(spark: SparkSession, path: str) -> DataFrame:
    """The table, or no rows of its schema if nothing has been loaded yet."""
    try:
        return read_processed(spark, path)
    except AnalysisException as error:
        if not _path_missing(error):
            raise
    return spark.createDataFrame([], schemas.PROCESSED)


def core_columns(processed: DataFrame) -> DataFrame:
    """What the accuracy report needs; the file scan reads no other column."""
    return processed.select(*_CORE_COLUMNS)


def table_ready(spark: SparkSession, name: str) -> bool:
    """True if the table exists and has a row."""
    return spark.catalog.tableExists(name) and not spark.table(name).isEmpty()


def processed_or_fallback(spark: SparkSession, table: str, csv_path: str) -> DataFrame:
    """The table if it has rows, else its CSV export, else no rows of its schema."""
    if table_ready(spark, table):
        return spark.table(table)
    try:
        return read_records_csv(spark, csv_path)
    except AnalysisException as error:
        if not _path_missing(error):
            raise
    return spark.createDataFrame([], schemas.PROCESSED)


def _stamp(rows: DataFrame) -> DataFrame:
    dated = rows.withColumn("invoice_dt", parse_invoice_date(F.col("invoice_date")))
    return dated.withColumn("loaded_at", F.current_timestamp()).select(*schemas.PROCESSED.fieldNames())


def load_full_refresh(records: DataFrame, path: str) -> DataFrame:
    """Replace the table by the first record of every id, numbered by file name."""
    load_batch(records, path, incremental=False)
    return read_processed(records.sparkSession, path)


def load_incremental(batch: DataFrame, path: str) -> DataFrame:
    """Append the records whose id the table does not hold yet.

    The first batch makes the table. Running a batch again adds no id twice. The
    batch is read more than once: pass a written table, not an extraction that
    would run again.
    """
    load_batch(batch, path, incremental=True)
    return read_processed(batch.sparkSession, path)


def load_batch(batch: DataFrame, path: str, incremental: bool) -> int:
    """Load a batch into the table and return how many of its records that kept.

    A full refresh is written beside the table and put in its place only once the
    write has succeeded (``replace_whole``): a load that fails leaves the old table.
    """
    spark = batch.sparkSession
    start, fresh = 0, load.dedup_first_wins(batch)
    if incremental:
        target = read_processed_or_none(spark, path)
        start = target.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        fresh = load.new_records(batch, target)
    ordered = new_path(spark, "ordered")
    try:
        numbered = load.with_surrogate_ids(load.conform(fresh), start, ordered)
        if incremental:
            _stamp(numbered).write.mode("append").parquet(path)
        else:
            replace_whole(spark, path, lambda staged: _stamp(numbered).write.parquet(staged))
        return numbered.count()
    finally:
        discard(spark, ordered)


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def replace_whole(spark: SparkSession, path: str, write) -> None:
    """Write a table beside ``path`` with ``write(staged)``, then put it in its place.

    Nothing at ``path`` changes until the write has succeeded; a failed write only
    leaves its staging folder, which is deleted. The swap is two renames in one
    folder of one file system (old aside, new in), and the old table is deleted last.
    """
    staged = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    try:
        write(staged)
    except BaseException:
        discard(spark, staged)
        raise
    target, fs = _file_system(spark, path)
    new, _ = _file_system(spark, staged)
    aside = None
    if fs.exists(target):
        aside, _ = _file_system(spark, f"{path.rstrip('/')}.replaced-{uuid.uuid4().hex}")
        if not fs.rename(target, aside):
            discard(spark, staged)
            raise OSError(f"could not move {path} aside")
    if not fs.rename(new, target):
        if aside is not None:
            fs.rename(aside, target)
        discard(spark, staged)
        raise OSError(f"could not put the new table at {path}")
    if aside is not None:
        fs.delete(aside, True)


def write_failures(failures: DataFrame, path: str, run_id: int, incremental: bool = False) -> DataFrame:
    """Set a run's failures aside and return the quarantine.

    A full run replaces what is there, also by nothing; an incremental one adds
    its failures, one row per file and run.
    """
    rows = failures.select("source_file", "reason", F.lit(run_id).cast("bigint").alias("run_id"))
    rows.write.mode("append" if incremental else "overwrite").parquet(path)
    return failures.sparkSession.read.schema(schemas.FAILED).parquet(path)


def next_run_id(spark: SparkSession, path: str) -> int:
    """One more than the highest id in the log of runs."""
    try:
        return (spark.read.schema(schemas.RUN_LOG).parquet(path).agg(F.max("id")).first()[0] or 0) + 1
    except AnalysisException as error:
        if not _path_missing(error):
            raise
    return 1


def append_run_log(spark: SparkSession, path: str, entry: dict) -> DataFrame:
    """Add one row to the log of runs and return the log."""
    row = {**dict.fromkeys(schemas.RUN_LOG.fieldNames()), "id": next_run_id(spark, path), **entry}
    spark.createDataFrame([row], schemas.RUN_LOG).write.mode("append").parquet(path)
    return spark.read.schema(schemas.RUN_LOG).parquet(path)


REVIEW_SORT = ["validation_passed", "overall_confidence", "vendor_name", "source_file"]


def invoice_month(day) -> F.Column:
    """First day of the month of a date column: the review table's partition value."""
    return F.trunc(day, "month")


def write_review_table(processed: DataFrame, path: str, dynamic: bool = True) -> None:
    """Lay the invoice table out for the review filters.

    One folder per month of ``invoice_dt`` (``invoice_month``; undated rows in the
    default folder), and within each file rows sorted by validation result,
    confidence and vendor, so that Parquet's row-group bounds let filters on those
    skip data and a filter on days reads only its months. The rows are dealt by
    ranges of (month, sort key), so a month with a third of all rows is written by
    many tasks, each to its own file. With ``dynamic`` only the months present in
    ``processed`` are replaced; other months stay as they are.
    """
    laid_out = (
        processed.withColumn("invoice_month", invoice_month(F.col("invoice_dt")))
        .repartitionByRange("invoice_month", *REVIEW_SORT)
        .sortWithinPartitions("invoice_month", *REVIEW_SORT)
    )
    (
        laid_out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy("invoice_month")
        .parquet(path)
    )


def read_review_table(spark: SparkSession, path: str) -> DataFrame:
    """The laid-out table: the invoice columns and ``invoice_month``."""
    laid_out = T.StructType([*schemas.PROCESSED.fields, T.StructField("invoice_month", T.DateType())])
    return spark.read.schema(laid_out).parquet(path)

