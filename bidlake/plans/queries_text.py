"""Registered queries over page text and page tables printed from the star-schema tables.

The SQL side never parses: it says what was printed.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlake.functions.text import money
from bidlake.operators import items, pages
from bidlake.plans import rendered
from bidlake.plans.documents import parse_documents
from bidlake.plans.pipeline import documents_to_features as run_documents_to_features
from bidlake.plans.registry import query
from bidlake.sources import readers, writers


_stored: dict = {}


def stored(spark, sf_dir, name: str, make) -> DataFrame:
    """A derived table, written to the shared folder once per session and data set.

    Pages are stored where they were printed: dealing them out once more would shuffle all text.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        folder = writers.shared_dir(spark, name)
        writers.write_packed(make(rendered.blocks(spark, sf_dir)), folder)
        _stored[key] = folder
    return spark.read.parquet(_stored[key])


def page_text(spark, sf_dir) -> DataFrame:
    return stored(spark, sf_dir, "pages", rendered.page_text)


def page_cells(spark, sf_dir) -> DataFrame:
    return stored(spark, sf_dir, "cells", rendered.page_cells)


def of_layout(df: DataFrame, layout: str) -> DataFrame:
    return df.filter(F.col("layout") == layout)


ORDERS_SQL = """SELECT doc_id, layout, orderkey, any_value(orderdate) AS orderdate, any_value(doc_schedule) AS schedule, any_value(doc_option) AS option,
 sum(amount) AS total FROM blocks GROUP BY doc_id, layout, orderkey"""
DATE = "concat(month(orderdate), '/', day(orderdate), '/', year(orderdate))"


@query(
    "SELECT doc_id, concat('Tabulation_', doc_id) AS source_stem, page_no, layout FROM (SELECT DISTINCT doc_id, page_no, layout FROM blocks"
    " UNION ALL SELECT DISTINCT doc_id, 1, layout FROM blocks)",
    ("blocks",),
)
def read_page_text(spark, sf_dir):
    """The stored page table."""
    page_text(spark, sf_dir)
    pages_of = readers.read_page_text(spark, _stored[(spark.sparkContext.applicationId, sf_dir, "pages")])
    return pages_of.filter(F.length("text") > 0).select("doc_id", "source_stem", "page_no", "layout")


META_SQL = f"""SELECT doc_id, concat('Tabulation_', doc_id) AS source_stem, layout, {DATE} AS report_date, concat('JOB ', orderkey) AS project_name,
 concat('S-', orderkey) AS solicitation_no, 'NC' AS state, concat('Lake ', orderkey) AS county, 'Room 7' AS opened_at,
 concat({DATE}, ' 10:30 AM') AS bid_open_date_time FROM orders_of"""


@query(META_SQL, ("blocks",), orders_of=ORDERS_SQL)
def doc_metadata(spark, sf_dir):
    return pages.doc_metadata(page_text(spark, sf_dir))


SCATTERED_NAME = """CASE layout WHEN 'prefix' THEN concat('JOB  ', orderkey)
 ELSE concat('JOB ', orderkey, ' ', list_aggregate(list_transform(range(1, 3 + orderkey % 7), lambda i: concat('PART ', i)), 'string_agg', ' ')) END"""


@query(META_SQL.replace("concat('JOB ', orderkey)", SCATTERED_NAME.replace("concat('JOB  '", "concat('JOB '")), ("blocks",), orders_of=ORDERS_SQL)
def doc_metadata_split(spark, sf_dir):
    """Metadata whose labels, values and terminators lie on different pages, with gaps and blank pages between."""
    return pages.doc_metadata(stored(spark, sf_dir, "scattered", rendered.scattered_pages))


@query(f"SELECT doc_id, concat('Tabulation_', doc_id) AS source_stem, {DATE} AS report_date FROM orders_of", ("blocks",), orders_of=ORDERS_SQL)
def report_dates(spark, sf_dir):
    return pages.report_dates(page_text(spark, sf_dir))


@query(
    """SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INTEGER AS line_no, line FROM (
     SELECT doc_id, trim(regexp_replace(unnest(l), '\\s+', ' ', 'g')) AS line, unnest(range(len(l))) AS i
     FROM (SELECT doc_id, string_split_regex(text, '\\r\\n|[\\n\\x0B\\f\\r]') AS l FROM documents)) WHERE line <> ''"""
)
def explode_lines(spark, sf_dir):
    """All lines of the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pages.explode_lines(docs)


@query(
    "SELECT DISTINCT doc_id, page_no, page_schedule AS schedule, NULL AS option FROM blocks UNION ALL SELECT doc_id, 1, schedule, option FROM orders_of",
    ("blocks",), orders_of=ORDERS_SQL,
)
def page_context(spark, sf_dir):
    return pages.page_context(page_text(spark, sf_dir))


NAMES_SQL = """SELECT DISTINCT doc_id, contractor FROM blocks
 UNION SELECT doc_id, concat(contractor, ' Lump Sum') FROM blocks WHERE layout = 'prefix' AND linenumber = 7
 UNION SELECT doc_id, concat(contractor, ' ', quantity, ' ', unit) FROM blocks WHERE layout = 'prefix' AND linenumber NOT IN (2, 5, 7)
 UNION SELECT doc_id, 'Inc.' FROM blocks WHERE layout = 'wrapped' AND linenumber % 2 = 0"""


@query(NAMES_SQL, ("blocks",))
def contractor_names(spark, sf_dir):
    """Names as found: also those cut before the money of an item line."""
    return pages.contractor_names(page_text(spark, sf_dir))


@query("SELECT DISTINCT doc_id, contractor FROM blocks UNION SELECT doc_id, 'Inc.' FROM blocks WHERE layout = 'wrapped' AND linenumber % 2 = 0", ("blocks",))
def shortest_names(spark, sf_dir):
    """Names that start with no other name of their document."""
    return items.shortest_names(items.stored_names(page_text(spark, sf_dir)))


@query("SELECT doc_id, 1 AS page_no FROM orders_of", ("blocks",), orders_of=ORDERS_SQL)
def summary_pages(spark, sf_dir):
    return pages.summary_pages(page_text(spark, sf_dir)).select("doc_id", "page_no")


# Line pass and flattened pass give the same rows, but that the first name of the flattened page
# takes the column title before it.
BIDS_PRINTED = """SELECT doc_id, contractor, round(sum(amount), 2) AS total FROM blocks GROUP BY doc_id, contractor"""
LINE_BIDS = """SELECT doc_id, contractor, total AS bid_amount, 0 AS ee FROM printed
 UNION ALL SELECT doc_id, 'Engineer''s Estimate', round(total, 2), 1 FROM orders_of"""
FIRST_BID = "SELECT doc_id, concat('Bid Amount ', min(contractor)) AS contractor, arg_min(total, contractor) AS bid_amount, 0 AS ee FROM printed GROUP BY doc_id"
BID_PARTS = dict(orders_of=ORDERS_SQL, printed=BIDS_PRINTED, line_bids=LINE_BIDS, first_bid=FIRST_BID)
BID_ROWS_SQL = """SELECT b.doc_id, 1 AS pdf_page, o.schedule, o.option, b.contractor, b.bid_amount, b.ee AS is_engineers_estimate
FROM ({rows}) b JOIN orders_of o ON b.doc_id = o.doc_id"""


@query(
    BID_ROWS_SQL.format(rows="""SELECT * FROM line_bids UNION ALL SELECT * FROM first_bid UNION ALL
    SELECT * FROM line_bids l WHERE NOT EXISTS (SELECT 1 FROM first_bid f WHERE f.doc_id = l.doc_id AND f.contractor = concat('Bid Amount ', l.contractor))"""),
    ("blocks",), **BID_PARTS,
)
def bid_rows(spark, sf_dir):
    """Both passes, with their repeats."""
    return pages.bid_rows(page_text(spark, sf_dir))


BID_AMOUNTS_SQL = BID_ROWS_SQL.format(rows="SELECT * FROM line_bids UNION ALL SELECT * FROM first_bid")


@query(BID_AMOUNTS_SQL, ("blocks",), **BID_PARTS)
def bid_amounts(spark, sf_dir):
    return pages.bid_amounts(page_text(spark, sf_dir))


@query(
    "SELECT doc_id, page_no, page_schedule AS schedule, line_item_no, pay_item_no, description, cast(quantity AS double) AS quantity, unit,"
    " CASE WHEN layout = 'wrapped' AND linenumber % 2 = 0 THEN 4 ELSE 2 END AS n_lines FROM blocks",
    ("blocks",),
)
def item_blocks(spark, sf_dir):
    """Blocks with the quantity of their first engineer line."""
    return pages.item_blocks(page_text(spark, sf_dir)).select(
        "doc_id", "page_no", "schedule", "line_item_no", "pay_item_no", "description", "quantity", "unit", F.size("body").alias("n_lines")
    )


@query(
    "SELECT doc_id, page_no, line_item_no, cast(CASE WHEN layout = 'prefix' AND linenumber NOT IN (2, 5, 7) THEN quantity END AS double) AS quantity,"
    " CASE WHEN layout = 'prefix' AND linenumber NOT IN (2, 5, 7) THEN unit END AS unit FROM blocks",
    ("blocks",),
)
def qty_unit(spark, sf_dir):
    """Quantity and unit of each block's first line."""
    q, u = pages.qty_unit(F.try_element_at("body", F.lit(1)))
    return pages.item_blocks(page_text(spark, sf_dir)).select("doc_id", "page_no", "line_item_no", q.alias("quantity"), u.alias("unit"))


def _item_rows(contractor: str, description: str, where: str, schedule: str = "page_schedule", option: str = "NULL", counted: str = "TRUE", layout: str = "") -> str:
    """SQL for the bidder row and the engineer row of each printed block."""
    head = f"doc_id, page_no AS pdf_page, {schedule} AS schedule, {option} AS option, line_item_no, pay_item_no, {description} AS description"
    return f"""SELECT {head}, cast(CASE WHEN {counted} THEN quantity END AS double) AS quantity, CASE WHEN {counted} THEN unit END AS unit,
 {contractor} AS contractor, unit_price, amount, 0 AS is_engineers_estimate FROM blocks WHERE {where}
 UNION ALL SELECT {head}, cast(quantity AS double), unit, 'Engineer''s Estimate', ee_price, amount, 1 FROM blocks WHERE {where}"""


PREFIX_SQL = _item_rows("contractor", "description", "layout = 'prefix'")
BROKEN = "linenumber % 2 = 0"
WRAPPED_SQL = _item_rows(
    f"CASE WHEN {BROKEN} THEN concat(short_name, ' Inc.') ELSE contractor END",
    f"CASE WHEN {BROKEN} THEN concat(description, ' ,') ELSE description END", "layout = 'wrapped'",
)


def shown(rows: DataFrame) -> DataFrame:
    return rows.select(*items.ITEM_COLUMNS)


@query(PREFIX_SQL, ("blocks",))
def line_items_text(spark, sf_dir):
    """Prefix layout, names from the summary pages."""
    return shown(items.line_items_text(of_layout(page_text(spark, sf_dir), "prefix")))


@query(WRAPPED_SQL, ("blocks",))
def line_items_wrapped(spark, sf_dir):
    """Wrapped-name layout; the comma left over of a broken name stays in the description."""
    return shown(items.line_items_wrapped(of_layout(page_text(spark, sf_dir), "wrapped")))


@query(
    f"""SELECT doc_id, fragment, count(*) AS lines FROM (SELECT doc_id, short_name AS fragment FROM blocks WHERE layout = 'wrapped' AND {BROKEN}
     UNION ALL SELECT doc_id, 'Inc.' FROM blocks WHERE layout = 'wrapped' AND {BROKEN}) GROUP BY doc_id, fragment""",
    ("blocks",),
)
def known_fragments(spark, sf_dir):
    """How many lines of each document hold which piece of a broken name."""
    text = of_layout(page_text(spark, sf_dir), "wrapped")
    found = items.known_fragments(items.loose_lines(pages.item_blocks(text)), pages.contractor_names(text))
    return found.groupBy("doc_id", "fragment").agg(F.count("*").alias("lines"))


CELLS_SQL = _item_rows("contractor", "description", "TRUE", "doc_schedule", counted="linenumber NOT IN (2, 5)")
THIRD_SQL = _item_rows("contractor", "description", "orderkey % 3 = 0", "doc_schedule", counted="linenumber NOT IN (2, 5)")


@query(CELLS_SQL, ("blocks",))
def line_items_cells(spark, sf_dir):
    """Table rows: cells carried down, the schedule carried over from the summary page."""
    return shown(items.line_items_cells(page_cells(spark, sf_dir), page_text(spark, sf_dir)))


@query(
    "SELECT doc_id, page_no, contractor AS c3, amount, n FROM (SELECT doc_id, page_no, contractor, amount, 'b' AS n FROM blocks"
    " UNION ALL SELECT doc_id, page_no, 'Engineer''s Estimate', amount, 'e' FROM blocks)",
    ("blocks",),
)
def clean_cells(spark, sf_dir):
    """Cells without the printed footer; item rows have no contractor."""
    rows = items.item_table_rows(page_cells(spark, sf_dir)).filter("c3 <> ''")
    kind = F.when(F.col("c3") == "Engineer's Estimate", "e").otherwise("b")
    return rows.select("doc_id", "page_no", "c3", money(F.col("c7")).alias("amount"), kind.alias("n"))


@query(
    "SELECT DISTINCT doc_id, page_no, doc_schedule AS schedule, NULL AS option FROM blocks UNION ALL SELECT doc_id, 1, schedule, option FROM orders_of",
    ("blocks",), orders_of=ORDERS_SQL,
)
def schedule_seen(spark, sf_dir):
    return items.schedule_seen(pages.page_context(page_text(spark, sf_dir)))


# Prefix documents: a table row without quantity takes it from the last text row of the same key,
# which needs the page to name its schedule. Documents without tables give their text rows.
LAST_TEXT = """SELECT doc_id, page_schedule, line_item_no, pay_item_no, contractor, arg_max(quantity, (page_no, partkey, suppkey, linenumber, amount)) AS q,
 arg_max(unit, (page_no, partkey, suppkey, linenumber, amount)) AS u FROM blocks WHERE layout = 'prefix' GROUP BY ALL"""
MERGED_SQL = f"""SELECT c.doc_id, pdf_page, c.schedule, c.option, c.line_item_no, c.pay_item_no, c.description, coalesce(c.quantity, t.q) AS quantity, coalesce(c.unit, t.u) AS unit,
 c.contractor, c.unit_price, c.amount, c.is_engineers_estimate
 FROM (SELECT * FROM cell_items WHERE doc_id IN (SELECT doc_id FROM blocks WHERE layout = 'prefix')) c
 LEFT JOIN last_text t ON c.doc_id = t.doc_id AND c.schedule = t.page_schedule AND c.line_item_no = t.line_item_no AND c.pay_item_no = t.pay_item_no AND c.contractor = t.contractor
 UNION ALL SELECT * FROM prefix_items WHERE doc_id NOT IN (SELECT doc_id FROM cell_items)"""
MERGE_PARTS = dict(cell_items=THIRD_SQL, prefix_items=PREFIX_SQL, last_text=LAST_TEXT)


@query(MERGED_SQL, ("blocks",), **MERGE_PARTS)
def merge_qty_unit(spark, sf_dir):
    text = of_layout(page_text(spark, sf_dir), "prefix")
    cells = of_layout(page_cells(spark, sf_dir), "prefix").filter("third")
    return shown(items.merge_qty_unit(items.line_items_cells(cells, text), items.line_items_text(text)))


ALL_ITEMS_SQL = """SELECT i.doc_id, concat('Tabulation_', i.doc_id) AS source_stem, i.pdf_page, concat('JOB ', substr(i.doc_id, 2)) AS project_name,
 i.schedule, i.option, i.line_item_no, i.pay_item_no, i.description, i.quantity, i.unit, i.contractor, i.unit_price, i.amount, i.is_engineers_estimate
FROM (SELECT * FROM merged UNION ALL SELECT * FROM cell_items WHERE doc_id NOT IN (SELECT doc_id FROM blocks WHERE layout = 'prefix')
 UNION ALL SELECT * FROM wrapped_items WHERE doc_id NOT IN (SELECT doc_id FROM cell_items)) i"""


@query(ALL_ITEMS_SQL, ("blocks",), **MERGE_PARTS, merged=MERGED_SQL, wrapped_items=WRAPPED_SQL)
def parse_documents_items(spark, sf_dir):
    """Both layouts in one job, with and without tables."""
    return parse_documents(page_text(spark, sf_dir), page_cells(spark, sf_dir).filter("third"))["items"].drop("_pos")


@query(
    f"""SELECT b.doc_id, m.source_stem, b.pdf_page, m.project_name, m.report_date, m.solicitation_no, b.schedule, b.option, b.contractor, b.bid_amount, b.is_engineers_estimate
    FROM ({BID_AMOUNTS_SQL}) b JOIN ({META_SQL}) m ON b.doc_id = m.doc_id""",
    ("blocks",), **BID_PARTS,
)
def parse_documents_bids(spark, sf_dir):
    return parse_documents(page_text(spark, sf_dir), page_cells(spark, sf_dir))["bids"]


# Prefix documents by their text, wrapped ones by their tables, whose rows 2 and 5 lack a quantity that the document's first engineer
# row of the item has. A project is a document and a schedule, and has several engineer rows for a pay item: the first one counts.
_COUNTED = "layout = 'prefix' OR linenumber NOT IN (2, 5)"
DOC_ROWS = f"""SELECT doc_id, concat('JOB ', orderkey) AS project_name, CASE layout WHEN 'prefix' THEN page_schedule ELSE doc_schedule END AS schedule, line_item_no, pay_item_no,
  description, cast(CASE WHEN {_COUNTED} THEN quantity END AS double) AS quantity, CASE WHEN {_COUNTED} THEN unit END AS unit, contractor, unit_price, amount, 0 AS ee,
  row(page_no, partkey, suppkey, linenumber, amount) AS place, {DATE} AS report_date FROM blocks
 UNION ALL SELECT doc_id, concat('JOB ', orderkey), CASE layout WHEN 'prefix' THEN page_schedule ELSE doc_schedule END, line_item_no, pay_item_no,
  description, cast(quantity AS double), unit, 'Engineer''s Estimate', ee_price, amount, 1, row(page_no, partkey, suppkey, linenumber, amount), {DATE} FROM blocks"""
DOC_FIRST = """SELECT doc_id, schedule, line_item_no, pay_item_no, arg_min(quantity, place) AS q, arg_min(unit, place) AS u FROM doc_rows WHERE ee = 1 GROUP BY ALL"""
DOC_WITH_ID = """SELECT r.project_name, r.schedule, r.line_item_no, r.pay_item_no, description, coalesce(quantity, q) AS quantity, coalesce(unit, u) AS unit, contractor, unit_price, amount, ee, place,
  report_date, concat(r.project_name, '|', coalesce(r.schedule, ''), '|') AS project_id FROM doc_rows r
 JOIN doc_first f ON r.doc_id = f.doc_id AND r.schedule IS NOT DISTINCT FROM f.schedule AND r.line_item_no = f.line_item_no AND r.pay_item_no = f.pay_item_no"""
DOC_EE = """SELECT project_id, pay_item_no, arg_min(unit_price, place) AS ee_unit_price, arg_min(amount, place) AS ee_amount, arg_min(quantity, place) AS ee_quantity, arg_min(unit, place) AS ee_unit
 FROM doc_with_id WHERE ee = 1 GROUP BY ALL"""


@query(
    """SELECT project_name, schedule, line_item_no, pay_item_no, description, quantity, unit, contractor, unit_price, amount, report_date, unit_price IS NULL AS is_lump_sum, project_id,
     ee_unit_price, ee_amount, ee_quantity, ee_unit, round(ln(quantity + 1), 9) AS log_quantity, round(amount / ee_amount, 6) AS amount_vs_ee
    FROM doc_with_id LEFT JOIN doc_ee USING (project_id, pay_item_no) WHERE ee = 0""",
    ("blocks",), doc_rows=DOC_ROWS, doc_first=DOC_FIRST, doc_with_id=DOC_WITH_ID, doc_ee=DOC_EE,
)
def documents_to_features(spark, sf_dir):
    """Printed pages to CSV sets to the canonical table to line-item features, in the order of files and rows."""
    cells = of_layout(page_cells(spark, sf_dir), "wrapped")
    made = run_documents_to_features(spark, page_text(spark, sf_dir), cells, writers.shared_dir(spark, "documents"))
    return made["line_items"].select(
        "project_name", "schedule", "line_item_no", "pay_item_no", "description", "quantity", "unit", "contractor", "unit_price", "amount", "report_date",
        "is_lump_sum", "project_id", "ee_unit_price", "ee_amount", "ee_quantity", "ee_unit", F.round("log_quantity", 9).alias("log_quantity"),
        F.round("amount_vs_ee", 6).alias("amount_vs_ee"),
    )
