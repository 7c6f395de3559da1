"""Invoice documents rendered from the order tables.

Every order becomes one invoice text in one of eight layouts, and its known
values are the ground truth for the extraction. All per-order values are sums,
counts and minima, which Spark combines before the shuffle, so an order that
holds a large share of all lines costs one row per map task and no more.

Layouts 0, 3, 5 and, if recognised, 7 print the order's item table between the buyer and the
totals (``item_tables``). Its rows are assembled in two levels: lines into blocks
of ``ITEM_BLOCK_LINES`` by (order, line_no div block), then blocks into the table,
so no group holds more than one block of lines or one order's block texts, and
the lines of a large order are spread over many tasks. No row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GST_RATE = "0.18"
LAYOUTS = 8
PLAIN_LAYOUTS = (1, 2, 4, 6)  # the other layouts print items
SCANNED_LAYOUT = 7
ITEM_BLOCK_LINES = 512
ITEM_HEADER = "Description  Qty  Unit Price (Rs.)  Amount (Rs.)"
MONEY = "decimal(18,2)"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _layout(key: Column) -> Column:
    return (key % LAYOUTS).cast("int")


def _recognised(key: Column) -> Column:
    """Whether a scanned order has recognised text."""
    return key % 16 == 7


def _prints_items(key: Column) -> Column:
    """Whether an order's item table is in a text; the lines of others are not assembled."""
    layout = _layout(key)
    return ~layout.isin(*PLAIN_LAYOUTS) & ((layout != SCANNED_LAYOUT) | _recognised(key))


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per invoice line: description, quantity, unit price and amount.

    The unit price is the amount over the quantity, rounded half up in whole
    paise, so that it does not depend on how an engine divides decimals.
    """
    lines = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"),
        "l_partkey",
        F.col("l_linenumber").alias("line_no"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
    )
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    paise = (F.col("amount") * 100).cast("bigint")
    unit_paise = F.expr("(2 * paise + quantity) div (2 * quantity)")
    return (
        lines.withColumn("paise", paise)
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(
            "doc_id",
            "line_no",
            F.col("p_name").alias("description"),
            "quantity",
            (unit_paise / F.lit(100)).cast("double").alias("unit_price"),
            F.col("amount").cast("double").alias("amount"),
        )
    )


def item_tables(lines: DataFrame, block_lines: int = ITEM_BLOCK_LINES) -> DataFrame:
    """``doc_id, items_text``: the header and one row per line, in line order.

    ``lines`` has the columns of ``line_items``. A row reads description, quantity,
    unit price and amount, two blanks apart, amounts with thousands separators.
    Rows of one line number (the tables repeat some) follow each other by their text.
    """
    money = lambda c: F.format_number(F.col(c).cast(MONEY), 2)
    row = F.concat_ws(
        "  ", F.coalesce(F.col("description"), F.lit("")), F.col("quantity").cast("string"), money("unit_price"), money("amount")
    )
    rows = F.sort_array(F.collect_list(F.struct("line_no", row.alias("row"))))
    blocks = lines.groupBy("doc_id", F.floor(F.col("line_no") / block_lines).alias("block")).agg(
        F.array_join(F.transform(rows, lambda r: r["row"]), "\n").alias("rows")
    )
    ordered = F.sort_array(F.collect_list(F.struct("block", "rows")))
    return blocks.groupBy("doc_id").agg(
        F.concat_ws("\n", F.lit(ITEM_HEADER), F.array_join(F.transform(ordered, lambda b: b["rows"]), "\n")).alias("items_text")
    )


def invoice_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line totals of each invoice, with 18 % tax worked out in decimals."""
    subtotal = F.sum(F.col("l_extendedprice").cast(MONEY)).cast(MONEY)
    totals = (
        _table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("doc_id"))
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("n_units"),
            subtotal.alias("subtotal"),
            F.min(F.struct("l_linenumber", "l_suppkey")).alias("first_line"),
        )
    )
    tax = F.round(F.col("subtotal") * F.lit(GST_RATE).cast("decimal(4,2)"), 2).cast(MONEY)
    return totals.withColumn("tax", tax).withColumn(
        "total", (F.col("subtotal") + F.col("tax")).cast(MONEY)
    )


def invoice_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known values of each order's invoice; orders without lines have none."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("issued")
    )
    suppliers = _table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("vendor"))
    totals = invoice_totals(spark, sf_dir)
    key = F.col("doc_id")
    number = F.lpad(key.cast("string"), 12, "0")
    year = F.date_format("issued", "yyyy")
    layout = _layout(key)
    return (
        orders.join(totals, orders.o_orderkey == totals.doc_id, "left")
        .drop("doc_id")
        .withColumnRenamed("o_orderkey", "doc_id")
        .join(suppliers, F.col("first_line.l_suppkey") == F.col("s_suppkey"), "left")
        .select(
            "doc_id",
            "o_custkey",
            "issued",
            "vendor",
            F.col("first_line.l_suppkey").alias("vendor_key"),
            "n_items",
            "n_units",
            "subtotal",
            "tax",
            "total",
            layout.alias("layout"),
            number.alias("number"),
            F.when(layout == 1, F.concat(year, F.lit("/GST/"), number))
            .when(layout == 2, F.concat(F.lit("TXN/"), year, F.lit("/"), number))
            .when(layout == 4, F.concat(F.lit("BL-"), year, F.lit("-"), number))
            .when(layout == 6, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("INV-"), number))
            .alias("invoice_id"),
            F.date_format("issued", "dd-MM-yyyy").alias("day_text"),
        )
    )


def _rupees(amount: Column) -> Column:
    return F.concat(F.lit("Rs. "), F.format_number(amount, 2))


def _lakh_rupees(amount: Column) -> Column:
    """Indian digit grouping up to the crore, written with the rupee sign."""
    whole = F.floor(amount).cast("bigint")
    paise = F.lpad(((amount * 100).cast("bigint") % 100).cast("string"), 2, "0")
    hundreds = F.lpad((whole % 1000).cast("string"), 3, "0")
    thousands = F.floor(amount / 1000).cast("bigint") % 100
    lakhs = F.floor(amount / 100000).cast("bigint") % 100
    crores = F.floor(amount / 10000000).cast("bigint")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    grouped = (
        F.when(whole >= 10000000, F.concat_ws(",", crores.cast("string"), two(lakhs), two(thousands), hundreds))
        .when(whole >= 100000, F.concat_ws(",", lakhs.cast("string"), two(thousands), hundreds))
        .when(whole >= 1000, F.concat_ws(",", thousands.cast("string"), hundreds))
        .otherwise(whole.cast("string"))
    )
    return F.concat(F.lit("₹"), grouped, F.lit("."), paise)


def _half(amount: Column) -> Column:
    return F.round(amount * F.lit("0.5").cast("decimal(2,1)"), 2).cast(MONEY)


def _render(facts: DataFrame) -> DataFrame:
    """Add ``body``, the invoice text of the order's layout."""
    subtotal, tax, total = F.col("subtotal"), F.col("tax"), F.col("total")
    low_slab = F.round(tax * F.lit("0.25").cast("decimal(4,2)"), 2).cast(MONEY)
    parts = (
        facts.withColumn("cgst", _half(tax))
        .withColumn("low_slab", low_slab)
        .withColumn("low_cgst", _half(F.col("low_slab")))
        .withColumn("high_cgst", _half(tax - F.col("low_slab")))
    )
    cgst, low, low_cgst, high_cgst = (F.col(c) for c in ("cgst", "low_slab", "low_cgst", "high_cgst"))
    text = F.lit
    line = F.concat
    top = [
        F.col("vendor"),
        text("TAX INVOICE"),
        line(text("GSTIN: 27AAACR"), F.lpad((F.col("vendor_key") % 10000).cast("string"), 4, "0"), text("K1Z5")),
    ]
    middle = [
        text("Bill To:"),
        line(text("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 12, "0")),
        line(text("Items: "), F.col("n_items").cast("string"), text("   Quantity: "), F.col("n_units").cast("string")),
    ]
    end = [text("Thank you for your business. Payment due within 30 days.")]
    day = F.col("day_text")
    number = F.col("invoice_id")

    def page(head: list[Column], totals: list[Column], items: bool = False) -> Column:
        table = [F.col("items_text")] if items else []
        return F.concat_ws("\n", *top, *head, *middle, *table, *totals, *end)

    standard_head = [line(text("Invoice No: "), number), line(text("Date: "), day)]

    def standard(printed_total: Column) -> Column:
        return page(
            standard_head,
            [
                line(text("Subtotal: "), _rupees(subtotal)),
                line(text("GST (18%): "), _rupees(tax)),
                line(text("Grand Total: "), _rupees(printed_total)),
            ],
            items=True,
        )

    layouts = {
        1: page(
            [line(text("Tax Invoice No.: "), number), line(text("Date: "), day)],
            [
                line(text("Taxable Value: "), _rupees(subtotal)),
                line(text("CGST @ 9%: "), _rupees(cgst)),
                line(text("SGST @ 9%: "), _rupees(tax - cgst)),
                line(text("Total Amount Due: "), _rupees(total)),
            ],
        ),
        2: page(
            [line(text("Invoice # "), number), line(text("Date: "), day)],
            [
                line(text("Taxable Value: "), _lakh_rupees(subtotal)),
                line(text("IGST @ 18%: "), _lakh_rupees(tax)),
                line(text("Grand Total: "), _lakh_rupees(total)),
            ],
        ),
        3: page(
            [line(text("Invoice No: "), number), line(text("Dated: "), day)],
            [
                line(text("Sub Total: "), _rupees(subtotal)),
                line(text("CGST @ 2.5%: "), _rupees(low_cgst)),
                line(text("SGST @ 2.5%: "), _rupees(low - low_cgst)),
                line(text("CGST @ 9%: "), _rupees(high_cgst)),
                line(text("SGST @ 9%: "), _rupees(tax - low - high_cgst)),
                line(text("Net Payable: "), _rupees(total)),
            ],
            items=True,
        ),
        4: page(
            [line(text("Bill No.: "), number), line(text("Date: "), F.date_format("issued", "d MMMM yyyy"))],
            [
                line(text("Sub Total: "), F.format_number(subtotal, 2)),
                line(text("Tax Amount: "), F.format_number(tax, 2)),
                line(text("Total: "), F.format_number(total, 2)),
            ],
        ),
        5: standard(total + F.lit(1000).cast(MONEY)),
        6: page(
            [line(text("Date: "), day)],
            [line(text("Subtotal: "), _rupees(subtotal)), line(text("Grand Total: "), _rupees(subtotal))],
        ),
    }
    body = F.when(F.col("n_items").isNull(), F.lit(None).cast("string"))
    for layout, rendered in layouts.items():
        body = body.when(F.col("layout") == layout, rendered)
    return parts.withColumn("body", body.otherwise(standard(total)))


def invoice_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document table ``doc_id, source_file, text, ocr_text``.

    Layout 7 has an empty text layer; every second one of them has recognised
    text instead, the others (and orders without lines) are unreadable. Every
    fiftieth order is sent in twice, under a later file name.
    """
    lines = line_items(spark, sf_dir).filter(_prints_items(F.col("doc_id")))
    facts = invoice_facts(spark, sf_dir).join(item_tables(lines), "doc_id", "left")
    rendered = _render(facts)
    copies = F.when(F.col("doc_id") % 50 == 0, F.array(F.lit(""), F.lit("_b"))).otherwise(F.array(F.lit("")))
    scanned, recognised = F.col("layout") == SCANNED_LAYOUT, _recognised(F.col("doc_id"))
    return rendered.withColumn("copy", F.explode(copies)).select(
        "doc_id",
        F.concat(F.lit("doc_"), F.col("number"), F.col("copy"), F.lit(".pdf")).alias("source_file"),
        F.when(scanned, F.lit(" \n")).otherwise(F.coalesce("body", F.lit(""))).alias("text"),
        F.when(scanned & recognised, F.col("body")).alias("ocr_text"),
    )


def ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Printed values of every invoice that has a number and can be read.

    Some truths are altered on purpose, to give the accuracy report work: the
    vendor in capitals (still a match) and a subtotal five rupees off.
    """
    facts = invoice_facts(spark, sf_dir)
    key = F.col("doc_id")
    readable = F.col("n_items").isNotNull() & ((F.col("layout") < 6) | (key % 16 == 7))
    printed_day = F.when(F.col("layout") == 4, F.date_format("issued", "d MMMM yyyy")).otherwise(F.col("day_text"))
    printed_total = F.when(F.col("layout") == 5, F.col("total") + F.lit(1000).cast(MONEY)).otherwise(F.col("total"))
    return facts.filter(readable).select(
        "invoice_id",
        printed_day.alias("invoice_date"),
        F.when(key % 11 == 0, F.upper("vendor")).otherwise(F.col("vendor")).alias("vendor_name"),
        (F.col("subtotal") + F.when(key % 13 == 0, F.lit(5)).otherwise(F.lit(0)).cast(MONEY))
        .cast("double")
        .alias("subtotal"),
        F.col("tax").cast("double").alias("tax_amount"),
        printed_total.cast("double").alias("grand_total"),
        F.concat(F.lit("doc_"), F.col("number"), F.lit(".pdf")).alias("source_file"),
    )
