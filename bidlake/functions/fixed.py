"""Word lists, synonym tables and text patterns of the bid-tabulation format.

These must keep exactly this content for results to be right.
"""

# Unit spellings and the code each stands for; a spelling not listed passes through.
UNIT_SYNONYMS = {
    "LF": "LNFT",
    "L.F.": "LNFT",
    "LINEAR FT": "LNFT",
    "LINEAR FOOT": "LNFT",
    "LNTF": "LNFT",
    "SQ YD": "SQYD",
    "SQ. YD.": "SQYD",
    "SQUARE YARD": "SQYD",
    "SQUARE YARDS": "SQYD",
    "CU YD": "CUYD",
    "CU. YD.": "CUYD",
    "CUBIC YARD": "CUYD",
    "CUBIC YARDS": "CUYD",
    "EA": "EACH",
    "EACH": "EACH",
    "TON": "TON",
    "LPSM": "LPSM",
    "LS": "LPSM",
    "CTSM": "LPSM",
}

# Unit codes that may follow a quantity on an item line.
LINE_UNITS = ["LNFT", "SQYD", "CUYD", "TON", "EACH", "LPSM", "LF", "SY", "CY", "EA", "LS", "SQFT", "GAL"]

# Texts that a CSV reader with default missing-value handling reads as null.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Item-line shapes.
MONEY = r"\$\s*([0-9][0-9,]*(?:\.[0-9]{2})?)"
PAY_ITEM = r"\b(\d{5}-\d{4})\b"
LINE_ITEM = r"\b([A-Z]\d{3,4})\b"
QUANTITY = r"[0-9][0-9,]*(?:\.[0-9]{3})?"
ENGINEER = r"(?i)Engineer.?s Estimate"
ENGINEER_NAME = "Engineer's Estimate"

# Page context.
SCHEDULE = r"Schedule:\s*([A-Z])"
OPTION = r"Option:\s*([A-Z]+)"

# Document metadata: per field, patterns in order of preference.
METADATA = {
    "report_date": [r"Report Date:\s*([0-9/]+)", r"Report Generated on\s*([0-9/]+)"],
    "project_name": [
        r"Project Name:\s*(.+?)\n(?:Contractor|Division|Schedule|Report|Project No)",
        r"Project Name:\s*(.+?)\nDivision:",
        r"Project Name:\s*(.+?)\s+Contractor Responsive\?",
    ],
    "solicitation_no": [r"Solicitation No\.?\s*[: ]\s*([A-Z0-9-]+)"],
    "state": [r"State:\s*([A-Z]{2})\b"],
    "county": [r"County:\s*([A-Za-z0-9, ]+)\n"],
    "opened_at": [r"Opened at:\s*(.+?)\n"],
    "bid_open_date_time": [r"Bid Open Date and Time:\s*([0-9/ :APMapm]+)"],
}
WRAPPED_PROJECT_NAME = r"Project Name:\s*([\s\S]+?)\s+Contractor Responsive\?"
HEADER_PROJECT_NAME = r"Project Name:\s*(.+?)(?=Division:|Schedule:|Solicitation No\.|Project No\.|$)"
HEADER_LINES = 20

# Company names.
COMPANY_WORDS = ["Inc.", "LLC", "Corp.", "Corporation", "Co.,", "Company", "Const.", "Construction"]
NAME_TAIL_WORDS = ["Inc.", "LLC", "Corp.", "Corporation", "Co.,", "Company", "Industries", "Const."]
BID_NAME_SUFFIXES = ["Corp.", "Inc.", "LLC", "Co., LLC", "Industries, Inc."]
ADDRESS = r"\b(Street|Road|VA|NC|OH|FL|Virginia|North Carolina|Ohio|Florida)\b"

# Bid summary pages.
ITEM_PAGE_MARKS = ["Line Item", "LineItem", "Pay Item No."]
SUMMARY_PAGE_MARKS = ["Contractor Responsive?", "Total Base Schedule"]
SUMMARY_PAGE_OPTION = r"Option:\s*[A-Z]"
BID_AMOUNT = r"\$\s*[0-9][0-9,]*\.[0-9]{2}"
FLAT_BID = r"([A-Za-z'.,& ]{3,})\s*(\$[0-9,]+\.[0-9]{2})\s*"

# Footer text printed inside table cells.
CELL_FOOTERS = [
    r"Report Generated on .*? Page \d+ of \d+",
    r"Generated by\s*:\s*.*",
    r"\[Timezone:.*?\]",
]

CELL_FOOTER_MARKS = ["Report Generated on", "Generated by", "[Timezone:"]

# Relative tolerance of the amount checks.
AMOUNT_TOLERANCE = 0.01
