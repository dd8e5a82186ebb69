"""Table schemas, key lists and model feature lists.

All names and types below are fixed values: they are the data contract of the tables.
"""

from pyspark.sql import types as T

CANONICAL = T.StructType([
    T.StructField("project_no", T.StringType()),
    T.StructField("project_name", T.StringType()),
    T.StructField("schedule", T.StringType()),
    T.StructField("option", T.StringType()),
    T.StructField("line_item_no", T.StringType()),
    T.StructField("pay_item_no", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("contractor", T.StringType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("is_engineers_estimate", T.LongType()),
    T.StructField("report_date", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("county", T.StringType()),
    T.StructField("_source_file", T.StringType()),
])

# Columns of the two tables the document job writes.
PARSED_ITEM_COLUMNS = [
    "pdf_page", "project_name", "schedule", "option", "line_item_no", "pay_item_no",
    "description", "quantity", "unit", "contractor", "unit_price", "amount",
    "is_engineers_estimate",
]
PARSED_BID_COLUMNS = [
    "pdf_page", "project_name", "report_date", "solicitation_no", "schedule", "option",
    "contractor", "bid_amount", "is_engineers_estimate",
]

# Key lists.
PROJECT_KEYS = ["project_name", "schedule", "option"]
ENGINEER_FILL_KEYS = PROJECT_KEYS + ["line_item_no", "pay_item_no"]
ENGINEER_FILL_KEYS_WITH_DESCRIPTION = ENGINEER_FILL_KEYS + ["description"]
ROLLUP_KEYS = ["project_id", "contractor"] + PROJECT_KEYS
DUPLICATE_GROUP_KEYS = ENGINEER_FILL_KEYS + ["contractor", "unit_price", "amount"]
DUPLICATE_ROW_KEYS = ["project_no", "schedule", "option", "line_item_no", "pay_item_no", "contractor"]
MISSING_REPORT_COLUMNS = ENGINEER_FILL_KEYS_WITH_DESCRIPTION + ["contractor", "is_engineers_estimate"]
TOP_ERROR_COLUMNS = ENGINEER_FILL_KEYS + ["contractor", "unit_price", "unit_price_pred", "abs_error"]
UNIT_PRICE_ID_COLUMNS = ["project_id"] + ENGINEER_FILL_KEYS + ["contractor", "unit_price"]
TOTAL_ID_COLUMNS = ["project_id"] + PROJECT_KEYS + ["contractor", "total_amount"]

# Model inputs.
UNIT_PRICE_CATEGORIES = ["pay_item_no", "unit", "contractor"]
UNIT_PRICE_NUMBERS = [
    "log_quantity", "log_amount", "unit_price_vs_ee", "amount_vs_ee",
    "ee_unit_price", "ee_amount", "ee_quantity",
]
TOTAL_BID_NUMBERS = [
    "num_items", "num_pay_items", "total_quantity", "ee_total_amount", "num_bidders",
    "total_vs_ee", "missing_unit_price_count",
]
WIN_NUMBERS = TOTAL_BID_NUMBERS + ["total_amount"]
# Inputs that are computed from the target itself; `leak_free=True` leaves them out.
LEAKING_INPUTS = {
    "unit_price": ["log_amount", "unit_price_vs_ee", "amount_vs_ee"],
    "total_bid": ["total_vs_ee"],
    "win": ["total_amount", "total_vs_ee"],
}
