"""Bid documents printed from the star-schema tables, so that parsing can be checked at scale.

An order is a document: page 1 is the bid summary, later pages hold item blocks for 500 parts
each, so a page stays small even if one order had very many lines. Every printed number has at
most two decimals and reads back exactly. Even orders use the prefix layout, odd ones the
wrapped-name layout. All pages are printed as tables too; where documents without tables are needed, those of every third order
are taken (`third`).

Every grouping has the order's key among its keys, which says no more than the document's name but is what line items and orders are
joined by: where that join shuffles them, as narrow rows, their printed text is not shuffled any more.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlake.plans.bid_lines import star_tables

# Runs in Spark and DuckDB: one row per item block, with what is printed in it.
BLOCKS_SQL = """
SELECT l_orderkey AS orderkey, concat('D', cast(l_orderkey AS varchar(20))) AS doc_id,
 CASE WHEN l_orderkey % 2 = 0 THEN 'prefix' ELSE 'wrapped' END AS layout,
 cast(2 + floor(l_partkey / 500.0) AS int) AS page_no,
 CASE WHEN l_orderkey % 4 < 2 THEN chr(cast(64 + cast(substr(o_orderpriority, 1, 1) AS int) AS int)) END AS page_schedule,
 chr(cast(64 + cast(substr(o_orderpriority, 1, 1) AS int) AS int)) AS doc_schedule, o_orderstatus AS doc_option,
 concat('A', lpad(cast(l_partkey % 10000 AS varchar(10)), 4, '0')) AS line_item_no,
 concat(lpad(cast(15100 + l_partkey % 40 AS varchar(10)), 5, '0'), '-0000') AS pay_item_no,
 concat('ITEM ', cast(l_partkey % 40 AS varchar(10))) AS description,
 cast(l_quantity AS int) AS quantity,
 CASE l_partkey % 4 WHEN 0 THEN 'LNFT' WHEN 1 THEN 'SQYD' WHEN 2 THEN 'CUYD' ELSE 'EACH' END AS unit,
 concat('Supplier ', chr(cast(65 + l_suppkey % 26 AS int)), ', Inc.') AS contractor,
 concat('Supplier ', chr(cast(65 + l_suppkey % 26 AS int))) AS short_name,
 CASE WHEN l_linenumber = 7 THEN NULL ELSE p_retailprice END AS unit_price, p_retailprice AS ee_price,
 l_extendedprice AS amount, l_linenumber AS linenumber,
 l_partkey AS partkey, l_suppkey AS suppkey, o_orderdate AS orderdate
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {orders} ON l_orderkey = o_orderkey
"""


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star_tables(spark, sf_dir)
    return spark.sql(BLOCKS_SQL, **{t: tables[t] for t in ("lineitem", "part", "orders")})


def _money(c: str) -> F.Column:
    return F.concat(F.lit("$"), F.format_number(c, 2))


def _stem() -> F.Column:
    return F.concat(F.lit("Tabulation_"), F.col("doc_id"))


def _block_text() -> F.Column:
    header = F.concat_ws(" ", "line_item_no", "pay_item_no", "description")
    counted = F.concat_ws(" ", F.format_number("quantity", 0), "unit")
    prices = F.concat_ws(" ", _money("unit_price"), _money("amount"))
    engineer = F.concat_ws(" ", F.lit("Engineer's Estimate"), counted, _money("ee_price"), _money("amount"))
    by_prefix = (
        F.when(F.col("linenumber") == 7, F.concat_ws(" ", "contractor", F.lit("Lump Sum"), _money("amount")))
        .when(F.col("linenumber").isin(2, 5), F.concat_ws(" ", "contractor", prices))
        .otherwise(F.concat_ws(" ", "contractor", counted, prices))
    )
    broken = F.concat(F.col("short_name"), F.lit(",\n"), prices, F.lit("\nInc."))
    by_wrap = F.when(F.col("linenumber") % 2 == 0, broken).otherwise(F.concat_ws(" ", "contractor", prices))
    bidder = F.when(F.col("layout") == "prefix", by_prefix).otherwise(by_wrap)
    return F.concat_ws("\n", header, bidder, engineer)


BLOCK_ORDER = ["partkey", "suppkey", "linenumber", "amount"]


def _in_order(value: F.Column) -> F.Column:
    """Aggregate: the group's values as an array in block order."""
    sorted_rows = F.array_sort(F.collect_list(F.struct(*BLOCK_ORDER, value.alias("_v"))))
    return F.transform(sorted_rows, lambda s: s["_v"])


def item_pages(rows: DataFrame) -> DataFrame:
    body = F.array_join(_in_order(_block_text()), "\n")
    schedule = F.concat(F.lit("Schedule: "), F.max("page_schedule"))
    text = F.concat_ws("\n", schedule, F.lit("Line Item No. Pay Item No. Description"), body)
    return rows.groupBy("orderkey", "doc_id", "layout", "page_no").agg(text.alias("text"))


def summary_pages(rows: DataFrame) -> DataFrame:
    bidders = rows.groupBy("orderkey", "doc_id", "layout", "contractor").agg(
        F.sum("amount").alias("total"), F.max("orderdate").alias("orderdate"), F.max("doc_schedule").alias("schedule"), F.max("doc_option").alias("option"),
    )
    line = F.concat_ws(" ", "contractor", _money("total"))
    listed = F.array_join(F.array_sort(F.collect_list(line)), "\n")
    date = F.date_format(F.max("orderdate"), "M/d/yyyy")
    key = F.col("orderkey").cast("string")
    label = F.when(F.col("orderkey") % 3 == 0, "Report Generated on ").otherwise("Report Date: ")
    head = [
        F.concat(label, date), F.concat(F.lit("Project Name: JOB  "), key), F.lit("Division: East"),
        F.concat(F.lit("Solicitation No. S-"), key), F.lit("State: NC"), F.concat(F.lit("County: Lake "), key),
        F.lit("Opened at: Room 7"), F.concat(F.lit("Bid Open Date and Time: "), date, F.lit(" 10:30 AM")),
        F.concat(F.lit("Schedule: "), F.max("schedule")), F.concat(F.lit("Option: "), F.max("option")),
        F.lit("Contractor Responsive? Bid Amount"), listed, F.concat(F.lit("Engineer's Estimate "), F.concat(F.lit("$"), F.format_number(F.sum("total"), 2))),
    ]
    return bidders.groupBy("orderkey", "doc_id", "layout").agg(F.lit(1).alias("page_no"), F.concat_ws("\n", *head).alias("text"))


def page_text(rows: DataFrame) -> DataFrame:
    """All pages of all documents."""
    pages = summary_pages(rows).unionByName(item_pages(rows))
    return pages.select("doc_id", _stem().alias("source_stem"), "page_no", "text", "layout")


def scattered_pages(rows: DataFrame) -> DataFrame:
    """Each order's metadata broken over many pages: labels end pages, values begin later ones, numbers have gaps.

    Pages of odd orders (wrapped layout) have a name that runs over 3 to 9 pages. Every second gap holds a blank page.
    """
    key, wrapped = F.col("orderkey"), F.col("layout") == "wrapped"
    documents = rows.groupBy("orderkey", "doc_id", "layout").agg(F.date_format(F.max("orderdate"), "M/d/yyyy").alias("date"))
    label = F.when(key % 3 == 0, "Report Generated on").otherwise("a page\n\nReport Date:\n ")
    parts = F.transform(F.sequence(F.lit(1), F.when(wrapped, 2 + key % 7).otherwise(1)), lambda i: F.concat(F.lit("PART "), i.cast("string"), F.lit("\n")))
    texts = F.concat(
        F.array(label, F.concat("date", F.lit("\nmore\nProject Name:")), F.concat(F.lit("\n\nJOB  "), key.cast("string"))),
        F.when(wrapped, F.concat(parts, F.array(F.lit("Contractor Responsive? Yes\nDivision: North")))).otherwise(F.array(F.lit("Division: East"))),
        F.array(
            F.concat(F.lit("x\nCounty: Lake "), key.cast("string")), F.lit("Opened at:"), F.lit("Room 7\nSolicitation No. "),
            F.concat(F.lit("S-"), key.cast("string"), F.lit("\nState:")), F.lit("NC\nBid Open Date and Time:"), F.concat("date", F.lit(" 10:30 AM")),
        ),
    )
    gap = 1 + key % 900
    placed = documents.select("doc_id", "layout", gap.alias("gap"), F.posexplode(texts).alias("at", "text"))
    number = (1 + F.col("at") * 2 * F.col("gap")).cast("int")
    blank = placed.filter(F.col("at") % 2 == 1).select("doc_id", "layout", (number + F.col("gap")).cast("int").alias("page_no"), F.lit(" \n").alias("text"))
    pages = placed.select("doc_id", "layout", number.alias("page_no"), "text").unionByName(blank)
    return pages.select("doc_id", _stem().alias("source_stem"), "page_no", "text", "layout")


def page_cells(rows: DataFrame) -> DataFrame:
    """The item pages of all orders as tables: even orders (prefix layout) with a header row."""
    blank = F.lit("")
    item = F.array("line_item_no", "pay_item_no", "description", *[blank] * 5)
    uncounted = F.col("linenumber").isin(2, 5)
    bidder = F.array(
        blank, blank, blank, "contractor",
        F.when(uncounted, blank).otherwise(F.format_number("quantity", 0)), F.when(uncounted, blank).otherwise(F.col("unit")),
        F.coalesce(_money("unit_price"), blank), _money("amount"),
    )
    engineer = F.array(
        blank, blank, blank, F.lit("Engineer's Estimate"), F.format_number("quantity", 0), F.col("unit"),
        _money("ee_price"), F.concat(_money("amount"), F.lit(" Generated by : printer")),
    )
    header = F.array(F.array(*map(F.lit, ["Line Item", "Pay Item", "Description", "Contractor", "Qty", "Unit", "Price", "Amount"])))
    lines = F.flatten(_in_order(F.array(item, bidder, engineer)))
    table = F.when(F.col("orderkey") % 2 == 0, F.concat(header, lines)).otherwise(lines)
    return (
        rows.groupBy("orderkey", "doc_id", "layout", "page_no")
        .agg(table.alias("rows"))
        .select("doc_id", "page_no", "layout", (F.col("orderkey") % 3 == 0).alias("third"), F.lit(0).alias("table_no"), F.posexplode("rows").alias("row_no", "cells"))
    )
