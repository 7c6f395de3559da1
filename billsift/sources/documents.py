"""Document sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from billsift import schemas
from billsift.functions.text import strip


def read_document_table(spark: SparkSession, path: str) -> DataFrame:
    """The document table; only the columns a query uses are read."""
    return spark.read.schema(schemas.DOCUMENTS).parquet(path)


def _empty_files(spark: SparkSession, folder: str) -> list[str]:
    """Names of text files of zero bytes, which Spark's readers pass over."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    names, entries = [], system.listStatusIterator(path)
    while entries.hasNext():
        entry = entries.next()
        if entry.getLen() == 0 and entry.isFile():
            names.append(entry.getPath().getName())
    return [n for n in names if n.endswith(".txt") and n[0] not in "._"]


def _text_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per text file, empty ones included, or none if there is no folder or file."""
    found = _filled_files(spark, folder)
    empty = [(name, "") for name in _empty_files(spark, folder)]
    return found.union(spark.createDataFrame(empty, "name string, text string")) if empty else found


def _filled_files(spark: SparkSession, folder: str) -> DataFrame:
    try:
        files = spark.read.option("pathGlobFilter", "*.txt").text(folder, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], "name string, text string")
    return files.select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))


def read_text_folder(spark: SparkSession, folder: str, ocr_folder: str | None = None) -> DataFrame:
    """Documents from a folder of text files, one file per invoice.

    A file of the same name in ``ocr_folder`` is the recognised text. A missing
    or empty folder gives no documents, not an error. The order of files
    matters only to the load, which sorts by ``source_file`` itself.

    Files of zero bytes are documents too: without recognised text they end in
    quarantine like all blank ones. Their names come from the file system's
    listing, which the driver reads in any case; only empty files are kept of it.
    """
    documents = _text_files(spark, folder)
    if ocr_folder is None:
        with_ocr = documents.withColumn("ocr_text", F.lit(None).cast("string"))
    else:
        recognised = _text_files(spark, ocr_folder).withColumnRenamed("text", "ocr_text")
        with_ocr = documents.join(recognised, "name", "full")
    return with_ocr.select(
        F.xxhash64("name").alias("doc_id"), F.col("name").alias("source_file"), "text", "ocr_text"
    )


def assemble_pages(pages: DataFrame, document: str, page: str, text: str = "text") -> DataFrame:
    """One text per document: its pages in order, one below the other.

    A page without text counts as an empty one. A document's text is one value,
    so its pages do meet in one row; that row is the result, not a by-product.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(page), F.coalesce(F.col(text), F.lit("")).alias("_text"))))
    return (
        pages.groupBy(document)
        .agg(ordered.alias("_pages"))
        .select(
            document,
            F.size("_pages").alias("n_pages"),
            strip(F.array_join(F.transform("_pages", lambda p: p["_text"]), "\n")).alias("text"),
        )
    )
