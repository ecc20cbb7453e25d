import datetime

import pytest
from pyspark.sql import functions as F

from paperwarden import extract_fields
from paperwarden.functions.dates import read_date, tidy_date
from paperwarden.functions.text import digit_count, number_text


def extracted(spark, text):
    return extract_fields(spark.createDataFrame([("d", text)], "doc_id string, raw_text string")).first()


@pytest.mark.parametrize("text, expected", [
    ("Foo Corporation\nSub-Total: $9.00\nTotal: 10.00",
     {"po_number": "ration", "subtotal": 9.0, "total_amount": 10.0}),
    ("the invoice noted\nSub Total 5.00\nTotal due 7.25",
     {"invoice_number": "ted", "subtotal": 5.0, "total_amount": 5.0}),
    ("Due Date: \nPayment Terms NET30\nX",
     {"due_date_raw": "Payment Terms NET30", "due_date_parse_ok": False, "payment_terms": "NET30"}),
    ("Invoice Date: Aug 4, 2026\r\nDue Date: 9/1/2026",
     {"invoice_date": "2026-08-04", "due_date": "2026-09-01", "invoice_date_raw": "Aug 4, 2026"}),
    ("Grand Total (3 items): $5.00\nTotal $1.234", {"total_amount": 1.23}),
    ("Tax (8.5%): $3.00\nTax ID 12.34", {"tax": None}),
    ("a\n\nInvoice #: A/1-b", {"vendor_name": "a", "invoice_number": "A/1-b"}),
    ("Due Date:\n\n\nfoo", {"due_date_raw": "foo"}),
    ("PO Number: \nPayment Terms: NET15", {"po_number": "Number", "payment_terms": "NET15"}),
    (" \r\n   Vendor Ltd  next", {"vendor_name": "Vendor Ltd"}),
    ("x\nInvoice Date: 2026-08-04", {"invoice_date": "2026-08-04"}),
    ("Total amount due: 1,234.50\nTotal 9.99", {"total_amount": 1234.5}),
    ("Total ١٢.٣٤", {"total_amount": 12.34}),
    ("Invoice Date: 2I-O7-2O25", {"invoice_date": "2I-O7-2O25", "invoice_date_parse_ok": False}),
    ("Status: PAID in Full, balance \n due; a DRAFT, finally",
     {"mentions_paid_in_full": True, "mentions_balance_due": True, "mentions_draft": True, "mentions_final": True}),
    ("", {"vendor_name": "", "invoice_number": None, "invoice_date": None, "total_amount": None, "text_length": 0.0,
          "digit_density": 0.0, "mentions_draft": False}),
    (None, {"vendor_name": "", "total_amount": None}),
])
def test_edge_texts(spark, text, expected):
    row = extracted(spark, text).asDict()
    assert {k: row[k] for k in expected} == expected


@pytest.mark.parametrize("raw, day", [
    ("2026-08-04", (2026, 8, 4)), ("2026-8-4", (2026, 8, 4)), ("2026/08/04", (2026, 8, 4)),
    ("8/4/2026", (2026, 8, 4)), ("13/08/2026", (2026, 8, 13)), ("08-04-2026", (2026, 8, 4)),
    ("Aug 4, 2026", (2026, 8, 4)), ("August 4, 2026", (2026, 8, 4)), ("4 Aug 2026", (2026, 8, 4)),
    ("4 August 2026", (2026, 8, 4)), ("20260804", (2026, 8, 4)), ("8/4/26", (2026, 8, 4)),
    ("Tuesday, August 4th, 2026", (2026, 8, 4)), ("04-Sep-2026", (2026, 9, 4)),
    ("2026-02-30", None), ("13/13/2026", None), ("August 2026", None), ("2026", None), ("30", None), ("foo", None),
    ("2I-O7-2O25", None), ("", None), (None, None),
])
def test_date_ladder(spark, raw, day):
    rows = spark.createDataFrame([(raw,)], "raw string").select(tidy_date(F.col("raw")).alias("t"))
    assert rows.select(read_date(F.col("t"))).first()[0] == (day and datetime.date(*day))


def test_digits_and_numbers(spark):
    texts = ["a1b2", "²③x", "٣ and 4", "", "１２"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", digit_count(F.col("t")).alias("n"))
    assert {r.t: r.n for r in rows.collect()} == {t: sum(c.isdigit() for c in t) for t in texts}
    values = [2808.0, 4090.27, 12345678.5, 0.0, -3.1, 1e9]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", number_text(F.col("v")).alias("s"))
    assert {r.v: r.s for r in rows.collect()} == {v: repr(v) for v in values}


def test_extraction_stays_on_the_jvm(spark):
    docs = spark.createDataFrame([("d", "x")], "doc_id string, raw_text string")
    plan = extract_fields(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
