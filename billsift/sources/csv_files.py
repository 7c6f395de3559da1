"""CSV files of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billsift import schemas
from billsift.functions.amounts import plain_number

# Quotes are doubled and blanks are kept. An empty text is written like NULL and
# read back as NULL. Line breaks inside values are written as \n and \r, and a
# backslash as two, so that every record is one line and files can be split.
_FORMAT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "encoding": "UTF-8",
}
_WRITE = {**_FORMAT, "emptyValue": ""}
_READ = {**_FORMAT, "enforceSchema": False, "mode": "FAILFAST"}


def _escaped(text: Column) -> Column:
    for plain, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def _unescaped(text: Column) -> Column:
    breaks = lambda part: F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    parts = F.transform(F.split(text, r"\\\\"), breaks)
    return F.when(F.contains(text, F.lit("\\")), F.array_join(parts, "\\")).otherwise(text)


def write_csv(frame: DataFrame, path: str, single_file: bool = False) -> None:
    """Write with a header, replacing what is there.

    Files are as many as partitions. ``single_file`` is for small results that
    a person wants as one file; it moves all rows to one task.
    """
    kinds = {"double": plain_number, "string": _escaped}
    columns = [kinds[kind](F.col(name)).alias(name) if kind in kinds else F.col(name) for name, kind in frame.dtypes]
    out = frame.select(*columns)
    (out.coalesce(1) if single_file else out).write.mode("overwrite").options(**_WRITE).csv(path)


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of the files; reads one line, not the data."""
    return spark.read.options(**_FORMAT).csv(path).columns


def require_columns(columns: list[str], required: list[str]) -> None:
    missing = sorted(set(required) - set(columns))
    if missing:
        raise ValueError(f"no such columns in the file: {', '.join(missing)}")


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, required: list[str] | None = None, foreign: bool = False
) -> DataFrame:
    """Read by column name with fixed types, after a check of the header.

    Columns may come in any order; unknown ones are read as text. Every file's
    header must equal the first one's, or the read fails. A missing path fails
    as well. Nothing is written before the check. ``foreign`` files come from other
    writers: backslashes mean nothing in them and values may hold line breaks, for
    which such files are read whole, one task each.
    """
    header = header_of(spark, path)
    require_columns(header, required if required is not None else schema.fieldNames())
    kinds = {field.name: field.dataType for field in schema.fields}
    found = T.StructType([T.StructField(name, kinds.get(name, T.StringType()), True) for name in header])
    rows = spark.read.options(**_READ, multiLine=foreign).schema(found).csv(path)
    if foreign:
        return rows
    texts = {f.name: _unescaped(F.col(f.name)) for f in found.fields if isinstance(f.dataType, T.StringType)}
    return rows.withColumns(texts)


CORRUPT = "_corrupt_record"
REJECT_REASON = "line does not parse as the header's columns and types"


def read_csv_split(
    spark: SparkSession, path: str, schema: T.StructType, staging: str, required: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Records that parse, and the lines that do not, from one read of the files.

    The header is checked as in ``read_csv``. Lines are parsed leniently: a line whose
    values do not fit the columns' types is kept whole in a corrupt-record column
    instead of ending the job. The parse is written once to ``staging`` (in the shared
    folder), so the files are read once and both parts come from the same parse.
    Rejects are ``source_path, line, reason``; one bad line never stops the batch.
    """
    header = header_of(spark, path)
    require_columns(header, required if required is not None else schema.fieldNames())
    kinds = {field.name: field.dataType for field in schema.fields}
    found = T.StructType([T.StructField(name, kinds.get(name, T.StringType()), True) for name in header])
    options = {**_FORMAT, "enforceSchema": False, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = (
        spark.read.options(**options)
        .schema(found.add(CORRUPT, T.StringType()))
        .csv(path)
        .withColumn("_source_path", F.input_file_name())
    )
    parsed.write.parquet(staging)
    rows = spark.read.parquet(staging)
    good = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "_source_path")
    texts = {f.name: _unescaped(F.col(f.name)) for f in found.fields if isinstance(f.dataType, T.StringType) and f.name != CORRUPT}
    bad = rows.where(F.col(CORRUPT).isNotNull()).select(
        F.col("_source_path").alias("source_path"), F.col(CORRUPT).alias("line"), F.lit(REJECT_REASON).alias("reason")
    )
    return good.withColumns(texts), bad


def read_records_csv(spark: SparkSession, path: str) -> DataFrame:
    """Extracted records; only the columns a load cannot do without are required."""
    return read_csv(spark, path, schemas.PROCESSED, schemas.REQUIRED_COLUMNS)


def write_ground_truth_csv(truth: DataFrame, path: str) -> None:
    """The printed values of a batch of invoices, as the accuracy report reads them."""
    write_csv(truth.select(*schemas.GROUND_TRUTH.fieldNames()), path)


def read_ground_truth_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.GROUND_TRUTH)
