"""DuckDB SQL that answers each registered query on its own.

Expected fields come from the order tables directly. No statement reads an
invoice text, so a fault in a pattern cannot hide in its own check.
"""

from __future__ import annotations

# Spelled out here and not taken from the engine: a wrong constant must not agree with itself.
_SPACES = [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WHITE_SPACE = "".join(map(chr, _SPACES))
NO_TEXT = "ValueError: PDF produced no text even after OCR attempt."
CUTOFF = "1998-01-01"

_FACTS = """
totals AS (
  SELECT l_orderkey AS doc_id, count(*) AS n_items,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS n_units,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS subtotal
  FROM lineitem GROUP BY l_orderkey
),
first_lines AS (
  SELECT l_orderkey, l_suppkey FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) = 1
),
taxed AS (
  SELECT *, CAST(round(subtotal * 0.18, 2) AS DECIMAL(18,2)) AS tax FROM totals
),
slabs AS (
  SELECT *, CAST(subtotal + tax AS DECIMAL(18,2)) AS total,
         CAST(round(tax * 0.5, 2) AS DECIMAL(18,2)) AS cgst,
         CAST(round(tax * 0.25, 2) AS DECIMAL(18,2)) AS low
  FROM taxed
),
halves AS (
  SELECT *, CAST(round(low * 0.5, 2) AS DECIMAL(18,2)) AS low_cgst,
         CAST(round((tax - low) * 0.5, 2) AS DECIMAL(18,2)) AS high_cgst
  FROM slabs
),
facts AS (
  SELECT o_orderkey AS doc_id, o_custkey, CAST(o_orderdate AS DATE) AS issued, s_name AS vendor,
         l_suppkey AS vendor_key, n_items, n_units, subtotal, tax, total, cgst, low, low_cgst, high_cgst,
         o_orderkey % 8 AS layout,
         lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS number,
         strftime(o_orderdate, '%Y') AS year
  FROM orders
  LEFT JOIN halves ON halves.doc_id = o_orderkey
  LEFT JOIN first_lines ON l_orderkey = o_orderkey
  LEFT JOIN supplier ON s_suppkey = l_suppkey
),
numbered AS (
  SELECT *,
    CASE layout WHEN 1 THEN year || '/GST/' || number WHEN 2 THEN 'TXN/' || year || '/' || number
                WHEN 4 THEN 'BL-' || year || '-' || number WHEN 6 THEN NULL
                ELSE 'INV-' || number END AS invoice_id,
    CASE WHEN layout = 4 THEN strftime(issued, '%-d %B %Y') ELSE strftime(issued, '%d-%m-%Y') END AS day_text,
    CASE WHEN layout = 7 THEN 0 ELSE layout END AS printed_as,
    n_items IS NOT NULL AND (layout <> 7 OR doc_id % 16 = 7) AS readable
  FROM facts
),
sent AS (
  SELECT *, 'doc_' || number || '.pdf' AS source_file FROM numbered
  UNION ALL
  SELECT *, 'doc_' || number || '_b.pdf' AS source_file FROM numbered WHERE doc_id % 50 = 0
)
"""

_RUPEES = "'Rs. ' || format('{{:,.2f}}', CAST({0} AS DOUBLE))"


def _rs(amount: str) -> str:
    return _RUPEES.format(amount)


def _plain(amount: str) -> str:
    return f"format('{{:,.2f}}', CAST({amount} AS DOUBLE))"


def _lakh(amount: str) -> str:
    whole = f"CAST(floor({amount}) AS BIGINT)"
    two = "lpad(CAST({0} AS VARCHAR), 2, '0')"
    thousands, lakhs = f"({whole} // 1000 % 100)", f"({whole} // 100000 % 100)"
    hundreds = f"lpad(CAST({whole} % 1000 AS VARCHAR), 3, '0')"
    paise = two.format(f"(CAST({amount} * 100 AS BIGINT) % 100)")
    return f"""'₹' || CASE
      WHEN {whole} >= 10000000 THEN ({whole} // 10000000) || ',' || {two.format(lakhs)} || ',' || {two.format(thousands)} || ',' || {hundreds}
      WHEN {whole} >= 100000 THEN {lakhs} || ',' || {two.format(thousands)} || ',' || {hundreds}
      WHEN {whole} >= 1000 THEN {thousands} || ',' || {hundreds}
      ELSE CAST({whole} AS VARCHAR) END || '.' || {paise}"""


def _lines(*lines: str) -> str:
    return "concat_ws(chr(10), " + ", ".join(lines) + ")"


_TOP = ("vendor", "'TAX INVOICE'", "'GSTIN: 27AAACR' || lpad(CAST(vendor_key % 10000 AS VARCHAR), 4, '0') || 'K1Z5'")
_MIDDLE = (
    "'Bill To:'",
    "'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 12, '0')",
    "'Items: ' || n_items || '   Quantity: ' || n_units",
)
_END = "'Thank you for your business. Payment due within 30 days.'"


def _page(head: list[str], totals: list[str], items: bool = False) -> str:
    return _lines(*_TOP, *head, *_MIDDLE, *(["items_text"] if items else []), *totals, _END)


def _standard(total: str) -> str:
    return _page(
        ["'Invoice No: ' || invoice_id", "'Date: ' || day_text"],
        [f"'Subtotal: ' || {_rs('subtotal')}", f"'GST (18%): ' || {_rs('tax')}", f"'Grand Total: ' || {_rs(total)}"],
        items=True,
    )


_BODY = f"""CASE WHEN n_items IS NULL THEN NULL
  WHEN layout = 1 THEN {_page(
      ["'Tax Invoice No.: ' || invoice_id", "'Date: ' || day_text"],
      [f"'Taxable Value: ' || {_rs('subtotal')}", f"'CGST @ 9%: ' || {_rs('cgst')}",
       f"'SGST @ 9%: ' || {_rs('tax - cgst')}", f"'Total Amount Due: ' || {_rs('total')}"])}
  WHEN layout = 2 THEN {_page(
      ["'Invoice # ' || invoice_id", "'Date: ' || day_text"],
      [f"'Taxable Value: ' || {_lakh('subtotal')}", f"'IGST @ 18%: ' || {_lakh('tax')}",
       f"'Grand Total: ' || {_lakh('total')}"])}
  WHEN layout = 3 THEN {_page(
      ["'Invoice No: ' || invoice_id", "'Dated: ' || day_text"],
      [f"'Sub Total: ' || {_rs('subtotal')}", f"'CGST @ 2.5%: ' || {_rs('low_cgst')}",
       f"'SGST @ 2.5%: ' || {_rs('low - low_cgst')}", f"'CGST @ 9%: ' || {_rs('high_cgst')}",
       f"'SGST @ 9%: ' || {_rs('tax - low - high_cgst')}", f"'Net Payable: ' || {_rs('total')}"], items=True)}
  WHEN layout = 4 THEN {_page(
      ["'Bill No.: ' || invoice_id", "'Date: ' || day_text"],
      [f"'Sub Total: ' || {_plain('subtotal')}", f"'Tax Amount: ' || {_plain('tax')}",
       f"'Total: ' || {_plain('total')}"])}
  WHEN layout = 5 THEN {_standard('total + 1000')}
  WHEN layout = 6 THEN {_page(["'Date: ' || day_text"],
      [f"'Subtotal: ' || {_rs('subtotal')}", f"'Grand Total: ' || {_rs('subtotal')}"])}
  ELSE {_standard('total')} END"""

_ITEMS = """item_rows AS (
  SELECT l_orderkey AS doc_id, l_linenumber AS line_no,
    concat_ws('  ', coalesce(p_name, ''), CAST(CAST(l_quantity AS INTEGER) AS VARCHAR),
      format('{:,.2f}', CAST((2 * CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) + CAST(l_quantity AS BIGINT))
           // (2 * CAST(l_quantity AS BIGINT)) AS DOUBLE) / 100),
      format('{:,.2f}', CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE))) AS item_row
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
),
items AS (
  SELECT doc_id, 'Description  Qty  Unit Price (Rs.)  Amount (Rs.)' || chr(10)
    || string_agg(item_row, chr(10) ORDER BY line_no, item_row) AS items_text
  FROM item_rows GROUP BY doc_id
)"""

_DOCUMENTS = f"""{_FACTS},
{_ITEMS},
bodies AS (SELECT sent.*, items_text, {_BODY} AS body FROM sent LEFT JOIN items USING (doc_id)),
docs AS (
  SELECT doc_id, source_file, readable, layout, body,
    CASE WHEN layout = 7 THEN ' ' || chr(10) ELSE coalesce(body, '') END AS text,
    CASE WHEN layout = 7 AND doc_id % 16 = 7 THEN body END AS ocr_text
  FROM bodies
)
"""

_RECORDS = f"""{_FACTS},
amounts AS (
  SELECT source_file, doc_id, issued, day_text, vendor, printed_as, layout,
    invoice_id, readable,
    CAST(subtotal AS DOUBLE) AS subtotal,
    CASE WHEN printed_as <> 6 THEN CAST(tax AS DOUBLE) END AS tax_amount,
    CASE printed_as WHEN 1 THEN CAST(cgst AS DOUBLE)
                    WHEN 3 THEN CAST(low_cgst AS DOUBLE) + CAST(high_cgst AS DOUBLE) END AS cgst,
    CASE printed_as WHEN 1 THEN CAST(tax - cgst AS DOUBLE)
                    WHEN 3 THEN CAST(low - low_cgst AS DOUBLE) + CAST(tax - low - high_cgst AS DOUBLE) END AS sgst,
    CASE printed_as WHEN 2 THEN CAST(tax AS DOUBLE) END AS igst,
    CAST(CASE printed_as WHEN 5 THEN total + 1000 WHEN 6 THEN subtotal ELSE total END AS DOUBLE) AS grand_total,
    CAST(total AS DOUBLE) AS true_total
  FROM sent
),
records AS (
  SELECT invoice_id,
    CASE WHEN printed_as IN (0, 1, 3, 5) THEN 'HIGH' WHEN printed_as = 6 THEN 'MISSING' ELSE 'LOW' END AS invoice_id_confidence,
    day_text AS invoice_date,
    CASE WHEN printed_as IN (3, 4) THEN 'LOW' ELSE 'HIGH' END AS invoice_date_confidence,
    vendor AS vendor_name, 'HIGH' AS vendor_name_confidence,
    subtotal,
    CASE WHEN printed_as IN (1, 2) THEN 'LOW' ELSE 'HIGH' END AS subtotal_confidence,
    tax_amount,
    CASE WHEN printed_as IN (1, 3) THEN 'HIGH' WHEN printed_as = 6 THEN 'MISSING' ELSE 'LOW' END AS tax_amount_confidence,
    cgst, sgst, igst, grand_total,
    CASE WHEN printed_as IN (1, 3, 4) THEN 'LOW' ELSE 'HIGH' END AS grand_total_confidence,
    CASE WHEN layout = 7 THEN 'ocr' ELSE 'text_layer' END AS extraction_method,
    CASE printed_as WHEN 2 THEN 'LOW' WHEN 4 THEN 'LOW' WHEN 6 THEN 'MISSING' ELSE 'HIGH' END AS overall_confidence,
    CASE WHEN printed_as = 5 THEN 0 ELSE 1 END AS validation_passed,
    CASE WHEN printed_as = 6 THEN 'Validation skipped — missing: tax_amount'
         WHEN printed_as = 5 THEN 'Total mismatch: grand_total=' || format('{{:.2f}}', grand_total)
           || ', subtotal(' || format('{{:.2f}}', subtotal) || ') + tax(' || format('{{:.2f}}', tax_amount)
           || ') = ' || format('{{:.2f}}', true_total) || ', diff=1000.00'
         ELSE '' END AS validation_note,
    source_file, issued, printed_as, doc_id
  FROM amounts WHERE readable
)
"""

_RECORD_COLUMNS = """invoice_id, invoice_id_confidence, invoice_date, invoice_date_confidence, vendor_name,
  vendor_name_confidence, subtotal, subtotal_confidence, tax_amount, tax_amount_confidence, cgst, sgst, igst,
  grand_total, grand_total_confidence, extraction_method, overall_confidence, validation_passed,
  {note} AS validation_note, source_file"""
_STORED_COLUMNS = _RECORD_COLUMNS.format(note="nullif(validation_note, '')")

_FIRSTS = """firsts AS (
  SELECT * FROM {source} WHERE invoice_id IS NULL
  UNION ALL
  SELECT * FROM (SELECT * FROM {source} WHERE invoice_id IS NOT NULL
                 QUALIFY row_number() OVER (PARTITION BY invoice_id ORDER BY source_file) = 1)
)"""
_PROCESSED = f"""{_RECORDS},
{_FIRSTS.format(source='records')},
processed AS (SELECT row_number() OVER (ORDER BY source_file) AS id, * FROM firsts)
"""

_TRUTH_SELECT = """SELECT invoice_id, day_text AS invoice_date,
    CASE WHEN doc_id % 11 = 0 THEN upper(vendor) ELSE vendor END AS vendor_name,
    CAST(subtotal + CASE WHEN doc_id % 13 = 0 THEN 5 ELSE 0 END AS DOUBLE) AS subtotal,
    CAST(tax AS DOUBLE) AS tax_amount,
    CAST(CASE WHEN layout = 5 THEN total + 1000 ELSE total END AS DOUBLE) AS grand_total,
    'doc_' || number || '.pdf' AS source_file
  FROM numbered WHERE readable AND layout <> 6"""
_FIELDS = ["invoice_date", "vendor_name", "subtotal", "tax_amount", "grand_total"]
_TEXT_FIELDS = _FIELDS[:2]
_JOINED = f"""{_PROCESSED},
truth AS ({_TRUTH_SELECT}),
joined AS (
  SELECT t.invoice_id, t.source_file,
    {', '.join(f't.{f} AS {f}_truth' for f in _FIELDS)},
    {', '.join(f'p.{f} AS {f}_extracted' for f in _FIELDS)},
    CASE WHEN p.id IS NULL THEN 0 ELSE 1 END AS found
  FROM truth t LEFT JOIN processed p ON t.invoice_id = p.invoice_id
)
"""


def _agree(field: str) -> str:
    if field in _TEXT_FIELDS:
        return f"lower(trim(coalesce({field}_truth, ''))) = lower(trim(coalesce({field}_extracted, '')))"
    return f"coalesce(abs({field}_truth - {field}_extracted) <= 1.0, false)"


_SCORED = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{f}' AS field, count(*) FILTER (WHERE {f}_truth IS NOT NULL AND {_agree(f)}) AS correct, "
    f"count({f}_truth) AS scoreable FROM joined"
    for f in _FIELDS
) + ")"


def _issue(field: str) -> str:
    shown = [f"coalesce(CAST({field}_{side} AS VARCHAR), 'nan')" for side in ("truth", "extracted")]
    return (
        f"CASE WHEN {field}_truth IS NOT NULL AND NOT ({_agree(field)}) "
        f"THEN '{field}: truth <' || {shown[0]} || '>, read <' || {shown[1]} || '>' END"
    )


_MISMATCHES = f"""{_JOINED},
mismatches AS (
  SELECT * FROM (
    SELECT invoice_id, source_file,
      CAST({' + '.join(f'CASE WHEN {f}_truth IS NOT NULL AND NOT ({_agree(f)}) THEN 1 ELSE 0 END' for f in _FIELDS)} AS INTEGER) AS n_issues,
      concat_ws('; ', {', '.join(_issue(f) for f in _FIELDS)}) AS issues
    FROM joined) WHERE n_issues > 0
)
"""

_SUM = "coalesce(CAST(sum(CAST({0} AS DECIMAL(28,6))) AS DOUBLE), 0)"
_SPEND = _SUM.format("grand_total")
_MEAN = "CAST(sum(CAST(grand_total AS DECIMAL(28,6))) AS DOUBLE) / count(grand_total)"


def _facts(select: str) -> str:
    return f"WITH {_FACTS} {select}"


def _documents(select: str) -> str:
    return f"WITH {_DOCUMENTS} {select}"


def _records(columns: str, rest: str = "") -> str:
    return f"WITH {_RECORDS} SELECT {columns} FROM records {rest}"


def _processed(columns: str, rest: str = "") -> str:
    return f"WITH {_PROCESSED} SELECT {columns} FROM processed {rest}"


def _top_vendors(count: int) -> str:
    return _processed(
        f"vendor_name, {_SPEND} AS total_spend",
        f"WHERE vendor_name IS NOT NULL GROUP BY vendor_name ORDER BY total_spend DESC, vendor_name LIMIT {count}",
    )


_BLANKS = "'" + WHITE_SPACE + "'"
_RAW_TOTAL = f"""CASE printed_as WHEN 2 THEN replace({_lakh('total')}, '₹', '') WHEN 5 THEN {_plain('total + 1000')}
  WHEN 6 THEN {_plain('subtotal')} ELSE {_plain('total')} END"""
_LOADED = f"{_STORED_COLUMNS}, id, strftime(issued, '%Y-%m-%d') AS invoice_dt"
_AWKWARD = r"""replace(invoice_date, '-', chr(10) || '\",\n' || chr(13)) AS invoice_date"""
_EXTRACTED = _RECORD_COLUMNS.format(note="validation_note")

ORACLES: dict[str, str] = {
    "doc_scan": _documents(
        "SELECT doc_id, source_file, CAST(length(text) AS INTEGER) AS text_chars, "
        "CAST(coalesce(length(ocr_text), -1) AS INTEGER) AS ocr_chars FROM docs"
    ),
    "page_assembly": f"""SELECT conv_id, CAST(count(*) AS INTEGER) AS n_pages,
        trim(string_agg(coalesce(text, ''), chr(10) ORDER BY turn), {_BLANKS}) AS text
        FROM conversations GROUP BY conv_id""",
    "invoice_corpus": _documents("SELECT doc_id, source_file, text, ocr_text FROM docs"),
    "invoice_line_items": """SELECT l_orderkey AS doc_id, l_linenumber AS line_no, p_name AS description,
        CAST(l_quantity AS INTEGER) AS quantity,
        CAST((2 * CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) + CAST(l_quantity AS BIGINT))
             // (2 * CAST(l_quantity AS BIGINT)) AS DOUBLE) / 100 AS unit_price,
        l_extendedprice AS amount
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "invoice_totals": _facts(
        "SELECT doc_id, n_items, n_units, CAST(subtotal AS DOUBLE) AS subtotal, CAST(tax AS DOUBLE) AS tax, "
        "CAST(total AS DOUBLE) AS total FROM slabs"
    ),
    "ground_truth": _facts(_TRUTH_SELECT),
    "text_routing": _documents(
        "SELECT source_file, CASE WHEN layout = 7 OR NOT readable THEN 'ocr' ELSE 'text_layer' END AS extraction_method, "
        f"CASE WHEN readable THEN body END AS text, CASE WHEN NOT readable THEN '{NO_TEXT}' END AS reason FROM docs"
    ),
    "failed_documents": _facts(f"SELECT source_file, '{NO_TEXT}' AS reason FROM sent WHERE NOT readable"),
    "extract_invoice_id": _records("source_file, invoice_id, invoice_id_confidence"),
    "extract_invoice_date": _records("source_file, invoice_date, invoice_date_confidence"),
    "extract_vendor": _records("source_file, vendor_name, vendor_name_confidence"),
    "extract_subtotal": _records("source_file, subtotal, subtotal_confidence"),
    "extract_grand_total": _records("source_file, grand_total, grand_total_confidence"),
    "extract_tax_components": _records("source_file, cgst, sgst, igst"),
    "extract_tax_generic": _records(
        "source_file, CASE WHEN printed_as IN (0, 4, 5) THEN tax_amount END AS generic_tax"
    ),
    "extract_tax_total": _records(
        "source_file, coalesce(tax_amount, 0) AS tax_total, tax_amount, tax_amount_confidence"
    ),
    "parse_amount": _facts(
        f"SELECT source_file, {_RAW_TOTAL} AS raw, CAST(CASE printed_as WHEN 5 THEN total + 1000 "
        "WHEN 6 THEN subtotal ELSE total END AS DOUBLE) AS amount FROM sent WHERE readable"
    ),
    "parse_invoice_date": _records("source_file, invoice_date, strftime(issued, '%Y-%m-%d') AS invoice_dt"),
    "format_currency": _processed(f"source_file, {_rs('grand_total')} AS grand_total_text"),
    "extract_records": _records(_EXTRACTED),
    "overall_confidence": _records(
        "source_file, invoice_id_confidence, grand_total_confidence, tax_amount_confidence, overall_confidence"
    ),
    "validate_totals": _records("source_file, validation_passed, validation_note"),
    "dedup_first_wins": _processed("invoice_id, source_file, grand_total"),
    "load_counts": f"""WITH {_PROCESSED} SELECT (SELECT count(*) FROM processed) AS inserted,
        (SELECT count(*) FROM records) - (SELECT count(*) FROM processed) AS skipped""",
    "surrogate_id": _processed("id, invoice_id, source_file"),
    "load_full_refresh": _processed(_LOADED),
    "load_incremental": f"""WITH {_RECORDS},
        early AS (SELECT * FROM records WHERE issued < DATE '{CUTOFF}'),
        {_FIRSTS.format(source='early').replace('firsts', 'early_firsts', 1)},
        {_FIRSTS.format(source='records')},
        stored AS (SELECT row_number() OVER (ORDER BY source_file) AS id, * FROM early_firsts),
        fresh AS (SELECT * FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.invoice_id = f.invoice_id))
        SELECT id, invoice_id, source_file FROM stored
        UNION ALL
        SELECT row_number() OVER (ORDER BY source_file) + (SELECT max(id) FROM stored) AS id, invoice_id, source_file
        FROM fresh""",
    "processed_scan": _processed(_LOADED),
    "processed_core_columns": _processed(
        "invoice_id, invoice_date, vendor_name, subtotal, tax_amount, grand_total"
    ),
    "csv_roundtrip_extracted": _records(_STORED_COLUMNS.replace(" invoice_date,", f" {_AWKWARD},")),
    "ground_truth_csv": _facts(_TRUTH_SELECT),
    "csv_rejects": _processed(
        "CAST(id AS BIGINT) AS id, 'line does not parse as the header''s columns and types' AS reason", "WHERE id % 7 = 0"
    ),
    "load_rejects": _processed(
        "source_file, 'grand_total' AS field, 'n/a' AS raw",
        "WHERE id % 5 = 0 UNION ALL SELECT source_file, 'validation_passed', 'maybe' FROM processed WHERE id % 11 = 0",
    ),
    "csv_rejects_kept": _processed("CAST(id AS BIGINT) AS id, invoice_id, grand_total", "WHERE id % 7 <> 0"),
    "quarantine_runs": _facts(
        f"SELECT source_file, '{NO_TEXT}' AS reason, r AS run_id "
        "FROM sent, (VALUES (1::BIGINT), (2::BIGINT)) runs(r) WHERE NOT readable"
    ),
    "csv_source_checked": _records(
        "invoice_id, invoice_date, vendor_name, subtotal, tax_amount, grand_total, source_file, validation_passed"
    ),
    "export_processed": _processed(_LOADED.replace(" invoice_date,", f" {_AWKWARD},")),
    "source_fallback": _processed(_LOADED),
    "run_log": f"""WITH {_PROCESSED} SELECT (SELECT count(*) FROM sent) AS invoices_found,
        (SELECT count(*) FROM processed) AS invoices_loaded,
        (SELECT count(*) FROM sent WHERE NOT readable) AS invoices_failed,
        count(*) FILTER (WHERE overall_confidence = 'HIGH') AS n_high_conf,
        count(*) FILTER (WHERE overall_confidence = 'LOW') AS n_low_conf,
        count(*) FILTER (WHERE overall_confidence = 'MISSING') AS n_missing_conf,
        'SUCCESS' AS notes, ids.id FROM records, (VALUES (1::BIGINT), (2::BIGINT)) ids(id) GROUP BY ids.id""",
    "extraction_summary": f"""WITH {_RECORDS} SELECT count(*) AS total,
        count(*) FILTER (WHERE overall_confidence = 'HIGH') AS n_high,
        count(*) FILTER (WHERE overall_confidence = 'LOW') AS n_low,
        count(*) FILTER (WHERE overall_confidence = 'MISSING') AS n_missing,
        count(*) FILTER (WHERE validation_passed = 0) AS n_flagged,
        count(*) FILTER (WHERE extraction_method = 'ocr') AS n_ocr,
        (SELECT count(*) FROM sent WHERE NOT readable) AS n_failed FROM records""",
    "load_summary": _processed(
        f"count(*) AS n_rows, {_SPEND} AS total_expenditure, coalesce({_MEAN}, 0) AS average_invoice"
    ),
    "kpi_summary": _processed(
        f"{_SPEND} AS total_spend, {_SUM.format('tax_amount')} AS total_tax, count(*) AS invoice_count"
    ),
    "financial_summary": _processed(f"{_SPEND} AS total_expenditure, {_MEAN} AS average_invoice"),
    "spend_by_vendor_top10": _top_vendors(10),
    "spend_by_vendor_top5": _top_vendors(5),
    "spend_timeline": _processed(
        f"strftime(issued, '%Y-%m-%d') AS invoice_dt, {_SPEND} AS daily_spend",
        "WHERE issued IS NOT NULL GROUP BY issued ORDER BY issued",
    ),
    "explorer_view": _processed(
        _LOADED,
        "ORDER BY issued DESC NULLS LAST, invoice_id, source_file",
    ),
    "review_queue": _processed(
        "invoice_id, vendor_name, grand_total, validation_note, source_file", "WHERE validation_passed = 0"
    ),
    "review_queue_by_date": _processed(
        "invoice_id, strftime(issued, '%Y-%m-%d') AS invoice_dt, grand_total, source_file",
        "WHERE validation_passed = 1 AND issued BETWEEN DATE '1995-04-01' AND DATE '1995-06-30'",
    ),
    "review_queue_pruned": _processed(
        "invoice_id, strftime(issued, '%Y-%m-%d') AS invoice_dt, grand_total, source_file",
        "WHERE validation_passed = 1 AND issued BETWEEN DATE '1995-04-01' AND DATE '1995-06-30'",
    ),
    "review_queue_scanned": _processed(
        "invoice_id, vendor_name, grand_total, source_file",
        "WHERE overall_confidence = 'HIGH' AND extraction_method = 'ocr'",
    ),
    "accuracy_join": f"WITH {_JOINED} SELECT * FROM joined",
    "match_rate": f"""WITH {_JOINED} SELECT count(*) AS total_invoices,
        CAST(coalesce(sum(found), 0) AS BIGINT) AS matched_invoices,
        sum(found) * 100.0::DOUBLE / count(*) AS match_rate_pct FROM joined""",
    "accuracy_by_field": f"""WITH {_JOINED}, scored AS ({_SCORED}),
        rated AS (SELECT *, CASE WHEN scoreable = 0 THEN 0 ELSE correct * 100.0::DOUBLE / scoreable END AS accuracy_pct
                  FROM scored)
        SELECT *, '[' || rpad(repeat('=', CAST(floor(accuracy_pct / 5) AS INTEGER)), 20, ' ') || ']' AS bar
        FROM rated""",
    "accuracy_overall": f"""WITH {_JOINED}, scored AS ({_SCORED})
        SELECT CAST(sum(correct) AS BIGINT) AS total_correct, CAST(sum(scoreable) AS BIGINT) AS total_possible,
        sum(correct) * 100.0::DOUBLE / sum(scoreable) AS overall_pct FROM scored""",
    "accuracy_mismatches": f"WITH {_MISMATCHES} SELECT * FROM mismatches",
    "mismatch_report": f"WITH {_MISMATCHES} SELECT * FROM mismatches ORDER BY source_file, invoice_id LIMIT 10",
    "mismatch_counts": f"""WITH {_MISMATCHES} SELECT count(*) AS n_mismatched,
        greatest(count(*) - 10, 0) AS n_more FROM mismatches""",
}
