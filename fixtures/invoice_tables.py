"""Past invoices and texts of arriving invoices, derived from order, line item and supplier tables.

One invoice per (order, supplier). Invoices before HISTORY_END are the history, later ones arrive as texts. The
order key picks one of KINDS, so that every check and every label has something to find.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperwarden.functions.text import grouped
from paperwarden.operators.scale import broadcast_if_small, materialise, shuffled

HISTORY_END = datetime.date(2001, 1, 1)
REFERENCE_DATE = datetime.date(2001, 6, 30)
KINDS = ["plain", "letter_lost", "digit_unreadable", "sign_replaced", "sum_wrong", "due_early", "number_again",
         "too_large", "nothing_to_book", "paid_yet_owed", "even_sum", "month_unreadable", "two_versions",
         "short_labels", "month_as_word", "slashes", "day_first", "other_line_ends"]


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """invoice_number, vendor_name, dates, payment_terms, po_number, amounts, the printed goods and the keys."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    net = price * (1 - F.col("l_discount").cast("decimal(4,2)"))
    tax = net * F.col("l_tax").cast("decimal(4,2)")
    goods = F.concat(F.lit("part "), F.col("l_partkey").cast("string"), F.lit(": "),
                     F.col("l_quantity").cast("int").cast("string"), F.lit(" pieces, "), price.cast("string"))
    # Dealt by order once, for the sums and for the join: the lines themselves are narrower than what they add up to.
    lines = lines.repartition("l_orderkey")
    totals = lines.groupBy("l_orderkey", "l_suppkey").agg(
        F.round(F.sum(net), 2).cast("double").alias("subtotal"), F.round(F.sum(tax), 2).cast("double").alias("tax"),
        F.array_join(F.array_sort(F.collect_list(goods)), "\n").alias("goods"))
    days = F.element_at(F.array(*[F.lit(d) for d in (15, 30, 45, 60)]), (F.col("s_suppkey") % 4).cast("int") + 1)
    joined = (totals.join(shuffled(orders.select("o_orderkey", "o_orderdate")), totals["l_orderkey"] == orders["o_orderkey"])
              .join(broadcast_if_small(suppliers.select("s_suppkey", "s_name")), totals["l_suppkey"] == suppliers["s_suppkey"]))
    return joined.select(
        F.concat_ws("/", "l_orderkey", "l_suppkey").alias("invoice_number"),
        F.col("s_name").alias("vendor_name"),
        F.col("o_orderdate").cast("date").alias("invoice_date"),
        F.date_add(F.col("o_orderdate").cast("date"), days).alias("due_date"),
        F.concat(F.lit("NET"), days.cast("string")).alias("payment_terms"),
        F.concat(F.lit("B"), F.col("l_orderkey").cast("string")).alias("po_number"),
        "subtotal", "tax", F.round(F.col("subtotal") + F.col("tax"), 2).alias("total_amount"), "goods",
        F.col("l_orderkey").alias("order_key"), F.col("l_suppkey").alias("supplier_key"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = invoices(spark, sf_dir).where(F.col("invoice_date") < F.lit(HISTORY_END))
    return rows.drop("order_key", "supplier_key", "goods")


def _is(kind: str) -> Column:
    return F.col("kind") == kind


def printed(rows: DataFrame, past: DataFrame) -> DataFrame:
    """What each invoice says; its kind changes one thing."""
    last_numbers = materialise(past.groupBy("vendor_name").agg(F.max("invoice_number").alias("_past_number")))
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (F.col("order_key") % len(KINDS)).cast("int") + 1)
    rows = rows.join(broadcast_if_small(last_numbers), "vendor_name", "left").withColumn("kind", kind)
    name = F.col("vendor_name")
    rows = rows.select(
        "kind", F.concat_ws("-", F.lit("text"), "order_key", "supplier_key").alias("doc_id"), "order_key", "goods",
        F.when(_is("letter_lost"), F.replace(name, F.lit("pp"), F.lit("p")))
        .when(_is("digit_unreadable"), F.concat(F.substring(name, F.lit(1), F.length(name) - 1), F.lit("x")))
        .when(_is("sign_replaced"), F.replace(name, F.lit("#"), F.lit(" "))).otherwise(name).alias("vendor_name"),
        F.when(_is("number_again"), F.coalesce("_past_number", "invoice_number"))
        .when(_is("nothing_to_book"), "").otherwise(F.col("invoice_number")).alias("invoice_number"),
        "po_number", "payment_terms", "invoice_date",
        F.when(_is("due_early"), F.date_sub("invoice_date", 3)).otherwise(F.col("due_date")).alias("due_date"),
        *[F.when(_is("too_large"), F.round(F.col(c) * 35, 2)).when(_is("even_sum"), float(even)).otherwise(F.col(c)).alias(c)
          for c, even in (("subtotal", 3000), ("tax", 150))])
    total = F.col("subtotal") + F.col("tax")
    return rows.withColumn("total_amount", F.round(F.when(_is("sum_wrong"), total - 31.5).otherwise(total), 2))


def date_text(date: Column) -> Column:
    return (F.when(_is("month_unreadable"), F.concat(F.date_format(date, "yyyy"), F.lit("-XX-"), F.date_format(date, "dd")))
            .when(_is("month_as_word"), F.date_format(date, "MMM d, yyyy"))
            .when(_is("slashes"), F.date_format(date, "MM/dd/yyyy"))
            .when(_is("day_first"), F.date_format(date, "d MMMM yyyy")).otherwise(date.cast("string")))


def texts(rows: DataFrame) -> DataFrame:
    """(doc_id, kind, raw_text)."""
    def label(usual: str, short: str) -> Column:
        return F.when(_is("short_labels"), F.lit(short)).otherwise(F.lit(usual))

    subtotal, tax, total = (grouped(F.col(c), 2) for c in ("subtotal", "tax", "total_amount"))
    half = F.pmod(F.floor(F.col("order_key") / len(KINDS)), F.lit(2)) == 1
    total = F.when(_is("nothing_to_book") & half, "to follow").otherwise(total)
    note = (F.when(_is("paid_yet_owed"), F.concat(F.lit("Thank you, paid in full. Open balance due: "), total))
            .when(_is("two_versions"), F.lit("A draft; the final sheet comes by mail.")))
    text = F.concat_ws(
        "\n", "vendor_name", F.concat(F.lit("Goods sent for order "), F.col("order_key").cast("string")), "goods",
        F.concat(label("Subtotal ", "Sub-total: "), subtotal), F.concat(label("Tax ", "TAX - "), tax),
        F.concat(label("Total amount due ", "Total - "), total),
        F.concat(label("Payment terms - ", "Payment terms "), "payment_terms"),
        F.concat(F.lit("Due date - "), F.when(_is("month_unreadable"), F.col("due_date").cast("string"))
                 .otherwise(date_text(F.col("due_date")))),
        F.concat(label("Invoice # ", "Invoice no "), "invoice_number"),
        F.concat(F.lit("Invoice date - "), date_text(F.col("invoice_date"))),
        F.concat(label("PO # ", "P.O. no. "), "po_number"), note)
    text = F.when(_is("other_line_ends"), F.concat(F.lit("\t\r\n"), F.replace(text, F.lit("\n"), F.lit("\r\n")))).otherwise(text)
    return rows.select("doc_id", "kind", text.alias("raw_text"))


def all_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every invoice as a document."""
    return texts(printed(invoices(spark, sf_dir), history(spark, sf_dir))).drop("kind")


def new_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The invoices that are not history, as documents with their kind."""
    arriving = invoices(spark, sf_dir).where(F.col("invoice_date") >= F.lit(HISTORY_END))
    return texts(printed(arriving, history(spark, sf_dir)))


def history_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Past invoices as lines of values with commas between; some orders have broken lines."""
    past = history(spark, sf_dir)
    order = F.split("invoice_number", "/")[0].cast("long") % 50
    amounts = [F.col(c).cast("decimal(18,2)").cast("string") for c in ("subtotal", "tax", "total_amount")]
    line = F.concat_ws(",", "invoice_number", "vendor_name",
                       F.when(order == 0, "soon").otherwise(F.col("invoice_date").cast("string")),
                       F.col("due_date").cast("string"), "payment_terms", "po_number",
                       F.when(order == 1, "n/a").otherwise(amounts[0]), amounts[1], F.when(order != 2, amounts[2]),
                       F.when(order == 3, "one more"))
    return past.select(line.alias("value"))


def with_resent(docs: DataFrame) -> DataFrame:
    """Documents, and those of every seventh order once more with a line at their end."""
    again = docs.where(F.split("doc_id", "-")[1].cast("long") % 7 == 0)
    return docs.unionByName(again.withColumns({
        "doc_id": F.concat("doc_id", F.lit("-again")), "raw_text": F.concat("raw_text", F.lit("\nSecond sending"))}))
