"""Document folders, pages, CSV files, guards and fallbacks."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from billsift import schemas
from billsift.operators import load
from billsift.session import new_path, shared_root
from billsift.sources import corpus, csv_files, documents, tables


def test_text_folder(spark, tmp_path):
    texts, ocr = tmp_path / "texts", tmp_path / "ocr"
    texts.mkdir()
    ocr.mkdir()
    (texts / "b.txt").write_text("Invoice No: B-1\nsecond line", encoding="utf-8")
    (texts / "a.txt").write_text("", encoding="utf-8")
    (texts / "c.txt").write_text("\n", encoding="utf-8")
    (texts / "skip.doc").write_text("x", encoding="utf-8")
    (ocr / "a.txt").write_text("Invoice No: A-1", encoding="utf-8")
    rows = documents.read_text_folder(spark, str(texts), str(ocr)).orderBy("source_file").collect()
    assert [(r.source_file, r.text or "", r.ocr_text) for r in rows] == [
        ("a.txt", "", "Invoice No: A-1"),
        ("b.txt", "Invoice No: B-1\nsecond line", None),
        ("c.txt", "\n", None),
    ]
    assert documents.read_text_folder(spark, str(texts)).columns == schemas.DOCUMENTS.fieldNames()


def test_missing_and_empty_folders_give_nothing(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for folder in ("absent", "empty"):
        assert documents.read_text_folder(spark, str(tmp_path / folder)).isEmpty()


def test_pages_in_order(spark):
    pages = spark.createDataFrame(
        [(1, 10, "ten"), (1, 2, None), (1, 1, " \n one"), (1, 11, "  "), (2, 1, None)],
        "doc int, page int, text string",
    ).repartition(3)
    rows = documents.assemble_pages(pages, "doc", "page").orderBy("doc").collect()
    assert [tuple(r) for r in rows] == [(1, 4, "one\n\nten"), (2, 1, "")]


def awkward_records(spark):
    rows = [
        ("007", 'Quote "Q", Comma', " padded ", 1.5, "", "a.pdf"),
        ("0012", "back\\slash", None, 123456789.25, "note, with comma", "b.pdf"),
        (None, "₹ NA", "NULL", None, None, "c.pdf"),
    ]
    frame = spark.createDataFrame(
        rows,
        "invoice_id string, vendor_name string, invoice_date string, grand_total double,"
        "validation_note string, source_file string",
    )
    return frame.withColumns({"subtotal": F.col("grand_total"), "tax_amount": F.lit(None).cast("double")})


def test_csv_round_trip(spark):
    frame = awkward_records(spark)
    path = new_path(spark, "csv")
    csv_files.write_csv(frame, path)
    back = csv_files.read_records_csv(spark, path).select(frame.columns)
    assert back.schema == frame.schema
    expected = frame.withColumn("validation_note", F.nullif("validation_note", F.lit("")))
    assert sorted(map(str, back.collect())) == sorted(map(str, expected.collect()))
    raw = "".join(r.value for r in spark.read.text(path).collect())
    assert "123456789.25" in raw


def test_csv_single_file(spark):
    path = new_path(spark, "csv")
    csv_files.write_csv(awkward_records(spark).repartition(3), path, single_file=True)
    assert len(spark.read.text(path).inputFiles()) == 1


def test_csv_missing_columns_are_named_in_order(spark):
    path = new_path(spark, "csv")
    csv_files.write_csv(awkward_records(spark).drop("vendor_name", "source_file", "subtotal"), path)
    with pytest.raises(ValueError, match="no such columns in the file: source_file, subtotal, vendor_name"):
        csv_files.read_records_csv(spark, path)


def test_csv_columns_go_by_name(spark):
    path = new_path(spark, "csv")
    frame = awkward_records(spark).select(*reversed(awkward_records(spark).columns), F.lit("x").alias("extra"))
    csv_files.write_csv(frame, path)
    table = load.conform(csv_files.read_records_csv(spark, path))
    assert {r.invoice_id for r in table.collect()} == {"007", "0012", None}


def test_ground_truth_file_must_exist(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        csv_files.read_ground_truth_csv(spark, new_path(spark, "absent"))


def test_table_guard_and_fallback(spark):
    name = "billsift_guarded"
    path = new_path(spark, "csv")
    assert not tables.table_ready(spark, name)
    assert tables.processed_or_fallback(spark, name, path).schema == schemas.PROCESSED
    assert tables.processed_or_fallback(spark, name, path).isEmpty()
    csv_files.write_csv(awkward_records(spark), path)
    assert tables.processed_or_fallback(spark, name, path).count() == 3
    rows = spark.createDataFrame([], schemas.PROCESSED)
    rows.createOrReplaceTempView(name)
    assert not tables.table_ready(spark, name)
    assert tables.processed_or_fallback(spark, name, path).count() == 3
    spark.range(5).createOrReplaceTempView(name)
    assert tables.table_ready(spark, name)
    assert tables.processed_or_fallback(spark, name, path).count() == 5
    spark.catalog.dropTempView(name)


class FakeSession:
    """A session as far as the choice of the shared folder goes."""

    def __init__(self, master, settings):
        self.conf = SimpleNamespace(get=settings.get)
        self.sparkContext = SimpleNamespace(master=master, applicationId="app")


def test_shared_folder_comes_from_the_session(spark):
    cluster = FakeSession("yarn", {"spark.checkpoint.dir": "hdfs://shared/dir/"})
    assert shared_root(cluster) == "hdfs://shared/dir"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(FakeSession("yarn", {}))
    assert shared_root(spark) == shared_root(spark)


def test_files_of_zero_bytes_are_documents(spark, tmp_path):
    for name, text in (("a.txt", ""), ("b.txt", "words"), ("c.txt", ""), ("_skip.txt", ""), ("d.pdf", "")):
        (tmp_path / name).write_text(text)
    (tmp_path / "ocr").mkdir()
    (tmp_path / "ocr" / "c.txt").write_text("recognised")
    found = documents.read_text_folder(spark, str(tmp_path), str(tmp_path / "ocr")).collect()
    assert sorted((r.source_file, r.text, r.ocr_text) for r in found) == [
        ("a.txt", "", None), ("b.txt", "words", None), ("c.txt", "", "recognised"),
    ]


def test_csv_keeps_any_text(spark):
    path = new_path(spark, "any")
    hard = ["a\nb", "a\r\nb\\", "\\n", "\\\n\\\\n", 'say "x", y', " blank ", "\\", "plain", None]
    frame = spark.createDataFrame([(str(i), t) for i, t in enumerate(hard)], "invoice_id string, vendor_name string")
    csv_files.write_csv(frame, path)
    got = csv_files.read_csv(spark, path, frame.schema).orderBy("invoice_id").collect()
    assert [r.vendor_name for r in got] == hard


def test_csv_of_other_writers(spark, tmp_path):
    (tmp_path / "x.csv").write_text('invoice_id,vendor_name\n1,"two\nlines"\n2,C:\\new\n')
    schema = spark.createDataFrame([], "invoice_id string, vendor_name string").schema
    got = csv_files.read_csv(spark, str(tmp_path / "x.csv"), schema, foreign=True).orderBy("invoice_id").collect()
    assert [r.vendor_name for r in got] == ["two\nlines", "C:\\new"]


def test_item_table_of_a_large_order_keeps_every_line_in_order(spark):
    from pyspark.sql import functions as F

    from billsift.sources.corpus import ITEM_HEADER, item_tables

    n = 100_000
    lines = spark.range(n).select(
        F.lit(7).cast("long").alias("doc_id"),
        (F.lit(n) - F.col("id")).cast("int").alias("line_no"),
        F.concat(F.lit("part "), F.col("id").cast("string")).alias("description"),
        F.lit(2).alias("quantity"),
        F.lit(1234.5).alias("unit_price"),
        F.lit(2469.0).alias("amount"),
    ).unionByName(spark.createDataFrame([(8, 1, None, 1, 5.0, 5.0)], "doc_id long, line_no int, description string, quantity int, unit_price double, amount double"))
    tables = {r.doc_id: r.items_text for r in item_tables(lines, block_lines=512).collect()}
    rows = tables[7].split("\n")
    assert rows[0] == ITEM_HEADER and len(rows) == n + 1
    assert rows[1] == f"part {n - 1}  2  1,234.50  2,469.00" and rows[-1] == "part 0  2  1,234.50  2,469.00"
    assert tables[8] == ITEM_HEADER + "\n  1  5.00  5.00"


def test_bad_csv_lines_are_set_apart_not_fatal(spark, tmp_path):
    from pyspark.sql import types as T

    from billsift.sources.csv_files import REJECT_REASON, read_csv_split

    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text('n,name,amount\n1,"a, b",1.5\n2,x,not a number\n3,y,\n4,"z",7\n')
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("name", T.StringType()), T.StructField("amount", T.DoubleType())])
    good, bad = read_csv_split(spark, str(folder), schema, str(tmp_path / "staged"))
    assert sorted(tuple(r) for r in good.collect()) == [(1, "a, b", 1.5), (3, "y", None), (4, "z", 7.0)]
    rejects = bad.collect()
    assert [(r.line, r.reason) for r in rejects] == [("2,x,not a number", REJECT_REASON)]
    assert rejects[0].source_path.endswith("part-0.csv")


def test_lines_that_no_text_prints_are_not_assembled(spark, tmp_path, monkeypatch):
    keys = [*range(-17, 33)]
    tables = {
        "orders": ([(k, 1, "1995-03-04") for k in keys], "o_orderkey long, o_custkey long, o_orderdate string"),
        "lineitem": (
            [(k, 1, 1, n, 2.0, 10.0 * n) for k in keys for n in (1, 2)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double",
        ),
        "part": ([(1, "bolt")], "p_partkey long, p_name string"),
        "supplier": ([(1, "Maker")], "s_suppkey long, s_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    documents = corpus.invoice_documents(spark, str(tmp_path))
    assembled = corpus.line_items(spark, str(tmp_path)).filter(corpus._prints_items(F.col("doc_id")))
    found = {tuple(r) for r in documents.collect()}
    printed = {r[0] for r in found if corpus.ITEM_HEADER in (r[2] + (r[3] or ""))}
    assert {r.doc_id for r in assembled.select("doc_id").collect()} == printed and len(printed) < len(keys)
    monkeypatch.setattr(corpus, "_prints_items", lambda key: F.lit(True))
    assert found == {tuple(r) for r in corpus.invoice_documents(spark, str(tmp_path)).collect()}
