"""Loading records into the invoice table: dedup, defaults, ids, inserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billsift import schemas
from billsift.functions.amounts import parse_amount
from billsift.session import new_path

_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row number in its low 33 bits


def dedup_first_wins(records: DataFrame) -> DataFrame:
    """One record per invoice id, the first by file name; all records without an id.

    Records without an id are set apart before the window, so they meet in no
    group. The rank filter is applied before the shuffle as well (WindowGroupLimit),
    so a key with very many copies sends one row per map task.
    """
    order = Window.partitionBy("invoice_id").orderBy("source_file")
    named = records.filter(F.col("invoice_id").isNotNull()).withColumn("_copy", F.row_number().over(order))
    firsts = named.filter(F.col("_copy") == 1).drop("_copy")
    return firsts.unionByName(records.filter(F.col("invoice_id").isNull()))


def load_counts(records: DataFrame) -> DataFrame:
    """One row: records inserted, and skipped because their id came earlier."""
    copies = records.groupBy("invoice_id").agg(F.count(F.lit(1)).alias("copies"))
    nameless = F.col("invoice_id").isNull()
    return copies.agg(
        F.coalesce(F.sum(F.when(nameless, F.col("copies")).otherwise(1)), F.lit(0)).alias("inserted"),
        F.coalesce(F.sum(F.when(~nameless, F.col("copies") - 1)), F.lit(0)).alias("skipped"),
    )


def _typed(records: DataFrame, field: T.StructField) -> Column:
    """A column in the table's type; amounts in text are read as printed amounts are."""
    if isinstance(field.dataType, T.DoubleType) and isinstance(records.schema[field.name].dataType, T.StringType):
        return parse_amount(F.col(field.name))
    return F.col(field.name).try_cast(field.dataType)


def conform(records: DataFrame) -> DataFrame:
    """The table's columns and types from any frame of records.

    Absent columns are NULL, values that do not cast become NULL, an unknown
    check counts as passed and an empty note is no note.
    """
    given = set(records.columns)
    columns = []
    for field in schemas.EXTRACTED.fields:
        value = _typed(records, field) if field.name in given else F.lit(None).cast(field.dataType)
        if field.name == "validation_passed":
            value = F.coalesce(value, F.lit(1))
        if field.name == "validation_note":
            value = F.nullif(value, F.lit(""))
        columns.append(value.alias(field.name))
    return records.select(*columns)


def rejected_values(records: DataFrame) -> DataFrame:
    """``source_file, field, raw``: values that are given but do not cast to the table's type.

    ``conform`` turns such a value into NULL; this names it instead of letting it
    vanish. One projection over the records, no shuffle: every field of every row is
    looked at. Empty or blank texts count as no value, not as a reject.
    """
    given = set(records.columns)
    checks = []
    for field in schemas.EXTRACTED.fields:
        if field.name not in given or field.name == "source_file":
            continue
        raw = F.col(field.name)
        lost = raw.isNotNull() & _typed(records, field).isNull()
        if isinstance(records.schema[field.name].dataType, T.StringType):
            lost = lost & (F.trim(raw) != "")
        checks.append(F.when(lost, F.struct(F.lit(field.name).alias("field"), raw.cast("string").alias("raw"))))
    source = F.col("source_file") if "source_file" in given else F.lit(None).cast("string")
    found = F.filter(F.array(*checks), lambda check: check.isNotNull()) if checks else F.array().cast("array<struct<field:string,raw:string>>")
    return records.select(source.alias("source_file"), F.explode(found).alias("_r")).select(
        "source_file", F.col("_r.field").alias("field"), F.col("_r.raw").alias("raw")
    )


def with_surrogate_ids(rows: DataFrame, start: int = 0, path: str | None = None) -> DataFrame:
    """Number the rows ``start + 1, start + 2, …`` by file name.

    The rows are range-partitioned, sorted and written once to the shared
    folder with their partition and their position in it. The id is then the
    position plus the number of rows in earlier partitions. Nothing passes
    through one task except one count per partition. The rows are written
    because a second evaluation could choose other range bounds; who gives the
    ``path`` may delete it when done.
    """
    spark = rows.sparkSession
    path = path or new_path(spark, "ordered")
    (
        rows.repartitionByRange("source_file")
        .sortWithinPartitions("source_file")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_position", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
        .write.parquet(path)
    )
    ordered = spark.read.parquet(path)
    # One row per range partition: spark.sql.shuffle.partitions rows at most,
    # whatever the size of the data. That bound allows the broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    number = F.col("_offset") + F.col("_position") + F.lit(start + 1)
    return (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn("id", number.cast("bigint"))
        .select("id", *rows.columns)
    )


def new_records(batch: DataFrame, target: DataFrame) -> DataFrame:
    """First record of every id of the batch that the target does not hold.

    The target is first cut down to the ids of the batch, a scan of one column
    without a shuffle if Spark finds those ids small enough to broadcast.
    Records without an id always pass.
    """
    ids = batch.filter(F.col("invoice_id").isNotNull()).select("invoice_id").distinct()
    known = target.select("invoice_id").join(ids, "invoice_id", "left_semi")
    return dedup_first_wins(batch).join(known, "invoice_id", "left_anti").select(*batch.columns)
