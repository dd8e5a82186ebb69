"""Registered queries over line-item tables: sources, cleaning, repair, quality, features, metrics."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlake.functions import numeric, text
from bidlake.operators import features, metrics, quality, repair, shape
from bidlake.plans.bid_lines import bid_lines, bids
from bidlake.plans.pipeline import canonical_items, feature_tables
from bidlake.plans.registry import query
from bidlake.schema import PROJECT_KEYS, TOP_ERROR_COLUMNS
from bidlake.sources import readers, writers

BID_COLUMNS = [
    "project_no", "project_name", "schedule", "option", "line_item_no", "pay_item_no", "description",
    "quantity", "unit", "contractor", "unit_price", "amount", "is_engineers_estimate",
]
COLS = ", ".join(BID_COLUMNS)
ITEM_COLS = COLS.replace("is_engineers_estimate", "cast(is_engineers_estimate AS bigint) AS is_engineers_estimate")


def with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.with_project_id(bid_lines(spark, sf_dir))


#: Bid lines have one engineer row per key, so that any order will do; `ordered_rows` are for those that have several.
ORDER = ["amount"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round sums and quotients, whose last bits depend on the order of adding."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- sources, sinks, shape ---------------------------------------------------------------


@query(f"SELECT {ITEM_COLS}, cast(NULL AS varchar) AS report_date FROM bid_lines", ("bid_lines",))
def read_line_items(spark, sf_dir):
    """CSV files of two different headers, read back with types."""
    folder = writers.shared_dir(spark, "items")
    rows = bid_lines(spark, sf_dir)
    is_f = F.col("option").isNull()
    writers.write_csv(rows.filter(is_f).drop("option"), f"{folder}/a")
    writers.write_csv(rows.filter(~is_f).select(*reversed(rows.columns)), f"{folder}/b")
    parts = [readers.read_line_items(spark, f"{folder}/{x}/*.csv") for x in "ab"]
    return readers.union_relaxed(parts).select(*BID_COLUMNS, "report_date")


@query(
    "SELECT o_orderkey AS id, o_orderstatus AS status, NULL AS name, o_totalprice AS total FROM orders"
    " UNION ALL SELECT c_custkey, NULL, c_name, cast(c_nationkey AS double) FROM customer"
)
def union_relaxed(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return readers.union_relaxed([
        orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total")),
        customers.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("total")),
    ]).select("id", "status", "name", "total")


@query(
    "SELECT project_name, contractor, unit, cast(is_engineers_estimate AS varchar) AS is_engineers_estimate FROM bid_lines"
    " UNION ALL SELECT project_name, contractor, NULL, cast(is_engineers_estimate AS varchar) FROM bids",
    ("bids",),
)
def read_csv_set(spark, sf_dir):
    """Files of differing headers with missing-value words, header names to be normalised."""
    folder = writers.shared_dir(spark, "set")
    items = bid_lines(spark, sf_dir).select(
        F.col("project_name").alias(" Project_Name "), F.col("contractor").alias("CONTRACTOR"),
        F.coalesce("unit", F.lit("N/A")).alias("Unit"), F.col("is_engineers_estimate").alias("is_engineers_estimate "),
    )
    writers.write_csv(items, f"{folder}/items")
    writers.write_csv(bids(spark, sf_dir).select("is_engineers_estimate", "contractor", "project_name"), f"{folder}/bids")
    return readers.read_csv_set(spark, f"{folder}/*/*.csv").select("project_name", "contractor", "unit", "is_engineers_estimate")


@query(f"SELECT 'parquet' AS source, {ITEM_COLS} FROM bid_lines UNION ALL SELECT 'csv', {ITEM_COLS} FROM bid_lines", ("bid_lines",))
def read_table(spark, sf_dir):
    """Written to both formats, each read by its path's ending."""
    folder = writers.shared_dir(spark, "table")
    writers.write_dual(shape.coerce(bid_lines(spark, sf_dir)), f"{folder}/t.csv", f"{folder}/t.parquet")
    parts = [
        readers.read_table(spark, f"{folder}/t.{x}").select(F.lit(x).alias("source"), *BID_COLUMNS) for x in ("parquet", "csv")
    ]
    return parts[0].unionByName(parts[1])


@query("SELECT o_orderkey, o_orderstatus AS status FROM orders")
def normalize_headers(spark, sf_dir):
    messy = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias(" O_OrderKey"), F.col("o_orderstatus").alias("STATUS "))
    return shape.normalize_headers(messy)


@query(
    f"SELECT {ITEM_COLS}, cast(NULL AS varchar) AS report_date, cast(NULL AS varchar) AS state,"
    " cast(NULL AS varchar) AS county, cast(NULL AS varchar) AS _source_file FROM bid_lines",
    ("bid_lines",),
)
def to_canonical(spark, sf_dir):
    return shape.coerce(shape.to_canonical(shape.ensure_columns(bid_lines(spark, sf_dir).withColumn("extra", F.lit(1)))))


@query("SELECT project_name, contractor, bid_amount_cents, county_no FROM (SELECT *, cast(round(bid_amount) AS bigint) AS bid_amount_cents, substr(county, 8) AS county_no FROM bids)", ("bids",))
def order_columns(spark, sf_dir):
    df = bids(spark, sf_dir).select(
        F.substr(F.col("county"), F.lit(8)).alias("county_no"), F.round("bid_amount").cast("bigint").alias("bid_amount_cents"),
        "contractor", "project_name",
    )
    return shape.order_columns(df.select("bid_amount_cents", "contractor", "county_no", "project_name"))


@query(
    """SELECT l_orderkey, CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE l_quantity END AS quantity,
    cast(CASE WHEN l_linenumber = 3 THEN NULL ELSE l_linenumber END AS bigint) AS is_engineers_estimate FROM lineitem"""
)
def coerce(spark, sf_dir):
    """Texts that are no numbers become null: `abc`, `1.5d`, `1,5`; `3.0` is a whole number."""
    q, n = F.col("l_quantity").cast("string"), F.col("l_linenumber")
    shown = F.when(n == 1, F.concat(q, F.lit("d"))).when(n == 2, F.concat(F.lit("1,"), q)).otherwise(F.concat(F.lit(" "), q, F.lit("\t")))
    flag = F.when(n == 3, "abc").otherwise(n.cast("double").cast("string"))
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", shown.alias("quantity"), flag.alias("is_engineers_estimate"))
    return shape.coerce(df)


@query(
    "SELECT page_id, regexp_replace(regexp_replace(regexp_extract(url, '[^/]*$'), '(.)[.][^.]*$', '\\1'), '[^A-Za-z0-9._-]+', '_', 'g') AS stem"
    " FROM pages"
)
def safe_stem(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.safe_stem(F.col("url")).alias("stem"))


@query(f"SELECT {ITEM_COLS} FROM bid_lines UNION ALL SELECT {ITEM_COLS} FROM bid_lines", ("bid_lines",))
def write_dual(spark, sf_dir):
    """What both files hold."""
    folder = writers.shared_dir(spark, "dual")
    writers.write_dual(shape.coerce(bid_lines(spark, sf_dir)), f"{folder}/csv", f"{folder}/parquet")
    back = readers.read_line_items(spark, f"{folder}/csv/*.csv").select(*BID_COLUMNS)
    return back.unionByName(spark.read.parquet(f"{folder}/parquet").select(*BID_COLUMNS))


VALIDATE_SQL = """SELECT count(*) AS rows,
 count(*) FILTER (WHERE quantity IS NULL) AS missing_quantity, count(*) FILTER (WHERE unit IS NULL) AS missing_unit,
 count(*) FILTER (WHERE unit_price IS NULL) AS missing_unit_price,
 count(*) FILTER (WHERE quantity IS NOT NULL AND unit_price IS NOT NULL AND abs(quantity * unit_price - amount) > 0.01 * abs(amount)) AS amount_mismatch_gt_1pct,
 (SELECT count(*) FROM (SELECT 1 FROM bid_lines GROUP BY project_name, schedule, option, line_item_no, pay_item_no, contractor, unit_price, amount HAVING count(*) > 1)) AS duplicate_groups
FROM bid_lines"""
VALIDATE_LONG = """SELECT {scope} unnest(['rows', 'missing_quantity', 'missing_unit', 'missing_unit_price', 'amount_mismatch_gt_1pct', 'duplicate_groups']) AS metric,
 cast(unnest([rows, missing_quantity, missing_unit, missing_unit_price, amount_mismatch_gt_1pct, duplicate_groups]) AS double) AS value FROM v"""


@query(VALIDATE_LONG.format(scope="'validation' AS scope,"), ("bid_lines",), v=VALIDATE_SQL)
def write_metrics(spark, sf_dir):
    """The metrics file read back."""
    folder = writers.shared_dir(spark, "metrics")
    writers.write_metrics(quality.to_long(quality.validate(bid_lines(spark, sf_dir)), "validation"), folder)
    return spark.read.schema("scope string, metric string, value double").json(folder)


@query(
    f"SELECT 'quality-check' AS experiment, 'quantity,unit' AS feature_cols, '0.01' AS tolerance, metric, value FROM ({VALIDATE_LONG.format(scope='')})",
    ("bid_lines",), v=VALIDATE_SQL,
)
def log_run(spark, sf_dir):
    """A run log of one run read back."""
    folder = writers.shared_dir(spark, "runs")
    report = quality.to_long(quality.validate(bid_lines(spark, sf_dir)))
    writers.log_run(spark, folder, "quality-check", {"tolerance": 0.01}, ["quantity", "unit"], report)
    return spark.read.parquet(folder).select(
        "experiment", F.col("params.feature_cols").alias("feature_cols"), F.col("params.tolerance").alias("tolerance"),
        F.explode("metrics").alias("metric", "value"),
    )


# ---- scalar expressions ------------------------------------------------------------------


@query(
    """SELECT doc_id, regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '') AS stripped,
    trim(regexp_replace(text, '\\s+', ' ', 'g')) AS collapsed,
    regexp_replace(regexp_replace(regexp_replace(text, '[ \\t]+', ' ', 'g'), '^\\s+', ''), '\\s+$', '') AS blanks
    FROM documents"""
)
def whitespace(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.strip_ws(t).alias("stripped"), text.norm_ws(t).alias("collapsed"), text.norm_blanks(t).alias("blanks")
    )


@query(
    f"""SELECT project_no, project_name, schedule, option, line_item_no, pay_item_no,
    trim(regexp_replace(description, '\\s+', ' ', 'g')) AS description, quantity, unit, contractor, unit_price, amount,
    cast(is_engineers_estimate AS bigint) AS is_engineers_estimate, cast(NULL AS varchar) AS report_date, cast(NULL AS varchar) AS state,
    cast(NULL AS varchar) AS county, cast(NULL AS varchar) AS _source_file FROM bid_lines""",
    ("bid_lines",),
)
def normalize(spark, sf_dir):
    return shape.normalize(bid_lines(spark, sf_dir))


CLEAN_UNIT = """CASE unit WHEN 'LF' THEN 'LNFT' WHEN 'Sq-Yd' THEN 'SQYD' WHEN 'CU/YD' THEN 'CUYD' WHEN 'EA' THEN 'EACH' END"""


@query(
    f"""SELECT project_no, project_name, schedule, option, line_item_no, pay_item_no,
    'ITEM ' || cast(cast(substr(line_item_no, 2) AS int) AS varchar) AS description, quantity, {CLEAN_UNIT} AS unit,
    CASE WHEN is_engineers_estimate = 1 THEN contractor ELSE substr(contractor, 1, length(contractor) - 1) END AS contractor,
    unit_price, amount, cast(is_engineers_estimate AS bigint) AS is_engineers_estimate FROM bid_lines""",
    ("bid_lines",),
)
def clean(spark, sf_dir):
    return repair.clean(bid_lines(spark, sf_dir))


@query(
    """SELECT doc_id, CASE WHEN doc_id % 5 IN (0, 1) THEN NULL ELSE lang || ' ' || source END AS label FROM documents"""
)
def blank_to_null(spark, sf_dir):
    n = F.col("doc_id") % 5
    label = F.when(n == 0, "nan").when(n == 1, " \t\n").otherwise(F.concat(F.lit(" "), "lang", F.lit("  "), "source"))
    return table(spark, sf_dir, "documents").select("doc_id", text.blank_to_null(label).alias("label"))


@query(
    """SELECT l_orderkey, l_partkey, CASE l_partkey % 8 WHEN 0 THEN 'LNFT' WHEN 1 THEN 'SQYD' WHEN 2 THEN 'SQ   YD' WHEN 3 THEN 'CUYD'
    WHEN 4 THEN 'LPSM' WHEN 5 THEN 'EACH' WHEN 6 THEN 'GAL' END AS unit FROM lineitem"""
)
def normalize_unit(spark, sf_dir):
    """Synonyms, `-` and `/`, unknown units; a blank-dash-blank is not collapsed again."""
    spellings = F.array(*map(F.lit, ["l.f.", " Square  Yards", "sq - yd", "Cu/Yd", "ctsm", "Each", "gal"]))
    spelled = F.try_element_at(spellings, (F.col("l_partkey") % 8 + 1).cast("int"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", text.normalize_unit(spelled).alias("unit"))


@query(
    """SELECT l_orderkey, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS amount,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity * 1000 END AS quantity FROM lineitem"""
)
def money_and_quantity(spark, sf_dir):
    n = F.col("l_linenumber")
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(n == 7, "$x").otherwise(F.concat(F.lit("$ "), F.format_number("l_extendedprice", 2), F.lit(" "))).alias("amount"),
        F.when(n == 7, "1.2.3").otherwise(F.format_number(F.col("l_quantity") * 1000, 3)).alias("quantity"),
    )
    return df.select("l_orderkey", text.money(F.col("amount")).alias("amount"), text.qty(F.col("quantity")).alias("quantity"))


@query("SELECT DISTINCT project_name, schedule, option, project_id FROM with_id", ("with_id",))
def with_project_id(spark, sf_dir):
    return with_id(spark, sf_dir).select("project_name", "schedule", "option", "project_id").distinct()


@query(
    f"""SELECT {COLS.replace('quantity, unit', "CASE WHEN f AND quantity IS NULL THEN 1.0 ELSE quantity END AS quantity, CASE WHEN f AND unit IS NULL THEN 'LS' ELSE unit END AS unit")},
    f AS is_lump_sum FROM (SELECT *, unit_price IS NULL OR (quantity IS NULL AND unit IS NULL) AS f FROM bid_lines)""",
    ("bid_lines",),
)
def mark_lump_sum(spark, sf_dir):
    return repair.mark_lump_sum(bid_lines(spark, sf_dir))


@query(
    """SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 2 THEN '-Infinity' WHEN l_linenumber = 1 THEN 'NaN' ELSE cast(cast(round(1e6 * ln(l_quantity * (l_linenumber - 2) + 0.0)) AS bigint) AS varchar) END AS log_micro,
    CASE WHEN l_linenumber > 2 THEN cast(cast(round(1e6 * l_quantity / (l_linenumber - 2)) AS bigint) AS varchar)
      WHEN l_linenumber = 1 THEN cast(cast(round(-1e6 * l_quantity) AS bigint) AS varchar)
      WHEN l_quantity > 25 THEN 'Infinity' WHEN l_quantity < 25 THEN '-Infinity' ELSE 'NaN' END AS ratio_micro FROM lineitem"""
)
def guarded_log_and_ratio(spark, sf_dir):
    """ln at 0 and below, and division by 0, as IEEE has them; shown as text."""
    def shown(c):
        plain = F.round(c * 1e6).cast("bigint").cast("string")
        return F.when(F.isnan(c) | (F.abs(c) == numeric.INF), c.cast("string")).otherwise(plain)

    n, q = F.col("l_linenumber") - 2, F.col("l_quantity")
    top = F.when(n == 0, q - 25).otherwise(q)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        shown(numeric.log1p_nullable(q * n - 1)).alias("log_micro"),
        shown(numeric.ratio(top, n.cast("double"))).alias("ratio_micro"),
    )


@query(
    """SELECT project_name, schedule, option, line_item_no, pay_item_no, description, contractor, is_engineers_estimate, missing_field
    FROM (SELECT *, unnest(['quantity', 'unit', 'unit_price']) AS missing_field, unnest([quantity IS NULL, unit IS NULL, unit_price IS NULL]) AS gone FROM bid_lines) WHERE gone""",
    ("bid_lines",),
)
def missing_fields(spark, sf_dir):
    return repair.missing_fields(bid_lines(spark, sf_dir))


@query("SELECT contractor, count(*) AS n FROM bid_lines WHERE contractor = 'Engineer''s Estimate' GROUP BY contractor", ("bid_lines",))
def is_engineer(spark, sf_dir):
    df = bid_lines(spark, sf_dir).filter(text.is_engineer(F.lower("contractor")))
    return df.groupBy("contractor").agg(F.count(F.lit(1)).alias("n"))


# ---- joins -------------------------------------------------------------------------------

EE_REF = """SELECT project_id, pay_item_no, min(unit_price) AS ee_unit_price, min(amount) AS ee_amount, min(quantity) AS ee_quantity, min(unit) AS ee_unit
 FROM with_id WHERE is_engineers_estimate = 1 GROUP BY project_id, pay_item_no"""


@query(EE_REF, ("with_id",))
def engineer_reference(spark, sf_dir):
    return features.engineer_reference(with_id(spark, sf_dir), ORDER)


@query(
    f"SELECT {COLS}, project_id, ee_unit_price, ee_amount, ee_quantity, ee_unit FROM with_id LEFT JOIN ee USING (project_id, pay_item_no) WHERE is_engineers_estimate = 0",
    ("with_id",), ee=EE_REF,
)
def attach_engineer_ref(spark, sf_dir):
    return features.attach_engineer_ref(with_id(spark, sf_dir), ORDER)


FILL_SELECT = (
    "SELECT b.project_no, b.project_name, b.schedule, {option} AS option, b.line_item_no, b.pay_item_no, b.description,"
    " coalesce(b.quantity, e.q) AS quantity, coalesce(b.unit, e.u) AS unit, b.contractor, b.unit_price, b.amount, b.is_engineers_estimate"
)
EE_FILL = (
    "SELECT project_name, schedule, option, line_item_no, pay_item_no, description, max(quantity) AS q, max(unit) AS u"
    " FROM bid_lines WHERE is_engineers_estimate = 1 GROUP BY ALL"
)


@query(
    FILL_SELECT.format(option="b.option") + " FROM bid_lines b LEFT JOIN ee e ON b.project_name = e.project_name AND b.schedule = e.schedule"
    " AND b.option = e.option AND b.line_item_no = e.line_item_no AND b.pay_item_no = e.pay_item_no AND b.description = e.description",
    ("bid_lines",), ee=EE_FILL,
)
def fill_from_engineer(spark, sf_dir):
    """Null options match nothing."""
    return repair.fill_from_engineer(bid_lines(spark, sf_dir), order=ORDER)


@query(
    FILL_SELECT.format(option="coalesce(b.option, '')") + " FROM bid_lines b LEFT JOIN ee e ON b.project_name IS NOT DISTINCT FROM e.project_name"
    " AND b.schedule IS NOT DISTINCT FROM e.schedule AND b.option IS NOT DISTINCT FROM e.option"
    " AND b.line_item_no = e.line_item_no AND b.pay_item_no = e.pay_item_no",
    ("bid_lines",), ee=EE_FILL,
)
def fill_from_engineer_grouped(spark, sf_dir):
    """Null options are a group of their own."""
    return repair.fill_from_engineer_grouped(bid_lines(spark, sf_dir), ORDER)


@query(
    "SELECT i.project_no, i.project_name, i.schedule, coalesce(i.option, '') AS option, i.line_item_no, i.contractor, i.amount, m.report_date, m.state, m.county"
    " FROM bid_lines i LEFT JOIN (SELECT DISTINCT project_name, schedule, coalesce(option, '') AS option, report_date, state, county FROM bids) m"
    " ON i.project_name = m.project_name AND i.schedule = m.schedule AND coalesce(i.option, '') = m.option",
    ("bids",),
)
def merge_metadata(spark, sf_dir):
    items = bid_lines(spark, sf_dir).select("project_no", *PROJECT_KEYS, "line_item_no", "contractor", "amount")
    merged = repair.merge_metadata(shape.ensure_columns(items), bids(spark, sf_dir))
    return merged.select("project_no", *PROJECT_KEYS, "line_item_no", "contractor", "amount", "report_date", "state", "county")


@query(
    """SELECT l_orderkey, l_partkey, CASE WHEN l_linenumber = 3 THEN '2/2/2022'
     ELSE coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END, CASE WHEN l_linenumber = 2 THEN '##/##' END) END AS report_date
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
)
def fill_report_date(spark, sf_dir):
    """Items named after their document's CSV; dates stand in as the order priority."""
    n = F.col("l_linenumber")
    tail = F.when(n % 2 == 0, "_line_items.csv").otherwise("_line_items_filled.csv")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.when(n == 3, "2/2/2022").when(n == 2, "##/##").alias("report_date"),
        F.concat(F.lit("dir/Tab_"), "l_orderkey", tail).alias("_source_file"),
    )
    docs = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select(
        text.safe_stem(F.concat(F.lit("pdfs/Tab "), "o_orderkey", F.lit(".pdf"))).alias("source_stem"), F.col("o_orderpriority").alias("report_date")
    )
    return repair.fill_report_date(items, docs).select("l_orderkey", "l_partkey", "report_date")


@query(
    "SELECT DISTINCT project_no, contractor FROM bid_lines EXCEPT SELECT project_no, contractor FROM bids", ("bids",)
)
def contractors_missing(spark, sf_dir):
    return quality.contractors_missing(bid_lines(spark, sf_dir), bids(spark, sf_dir))


# ---- features ----------------------------------------------------------------------------

PCF_SQL = """SELECT a.project_id, a.contractor, a.project_name, a.schedule, a.option, round(a.total_amount, 4) AS total_amount,
 a.total_quantity, a.num_items, a.num_pay_items, a.missing_unit_price_count, round(e.ee_total, 4) AS ee_total_amount, n.num_bidders,
 round(a.total_amount / e.ee_total, 6) AS total_vs_ee
FROM (SELECT project_id, contractor, project_name, schedule, option, coalesce(sum(amount), 0.0) AS total_amount, coalesce(sum(quantity), 0.0) AS total_quantity,
  count(*) AS num_items, count(DISTINCT pay_item_no) AS num_pay_items, count(*) FILTER (WHERE unit_price IS NULL) AS missing_unit_price_count
  FROM with_id WHERE is_engineers_estimate = 0 GROUP BY ALL) a
LEFT JOIN (SELECT project_id, sum(amount) AS ee_total FROM with_id WHERE is_engineers_estimate = 1 GROUP BY project_id) e ON a.project_id = e.project_id
LEFT JOIN (SELECT project_id, count(DISTINCT contractor) AS num_bidders FROM with_id WHERE is_engineers_estimate = 0 GROUP BY project_id) n ON a.project_id = n.project_id"""


def rounded_rollup(df: DataFrame) -> DataFrame:
    return rounded(rounded(df, 4, "total_amount", "ee_total_amount"), 6, "total_vs_ee")


@query(PCF_SQL, ("with_id",))
def project_contractor_features(spark, sf_dir):
    return rounded_rollup(features.project_contractor_features(with_id(spark, sf_dir)))


@query(
    "SELECT project_id, round(sum(amount) FILTER (WHERE is_engineers_estimate = 1), 4) AS ee_total_amount,"
    " count(DISTINCT contractor) FILTER (WHERE is_engineers_estimate = 0) AS num_bidders FROM with_id GROUP BY project_id",
    ("with_id",),
)
def project_totals(spark, sf_dir):
    return rounded(features.project_totals(with_id(spark, sf_dir)), 4, "ee_total_amount")


LIF_SQL = f"""SELECT {COLS}, project_id, ee_unit_price, ee_amount, ee_quantity, ee_unit,
 round(ln(quantity + 1), 9) AS log_quantity, round(ln(amount + 1), 9) AS log_amount,
 round(unit_price / ee_unit_price, 6) AS unit_price_vs_ee, round(amount / ee_amount, 6) AS amount_vs_ee
FROM with_id LEFT JOIN ee USING (project_id, pay_item_no) WHERE is_engineers_estimate = 0"""


@query(LIF_SQL, ("with_id",), ee=EE_REF)
def line_item_features(spark, sf_dir):
    df = features.line_item_features(with_id(spark, sf_dir), ORDER)
    return rounded(rounded(df, 9, "log_quantity", "log_amount"), 6, "unit_price_vs_ee", "amount_vs_ee")


@query(f"SELECT *, cast(total_amount = min(total_amount) OVER (PARTITION BY project_id) AS int) AS win FROM ({PCF_SQL})", ("with_id",))
def with_win_label(spark, sf_dir):
    return features.with_win_label(rounded_rollup(features.project_contractor_features(with_id(spark, sf_dir))))


SPLIT_SQL = """SELECT project_id, n, rk <= cast(floor(0.8 * total) AS bigint) AS is_train FROM (
 SELECT project_id, count(*) AS n, row_number() OVER (ORDER BY md5(project_id)) AS rk, count(*) OVER () AS total FROM with_id GROUP BY project_id)"""


@query(SPLIT_SQL, ("with_id",))
def project_split(spark, sf_dir):
    """Rows per project and the part it went to, projects by the MD5 of their key."""
    split = features.project_split(with_id(spark, sf_dir).withColumn("_md5", F.md5("project_id")), order=["_md5"])
    return split.groupBy("project_id", "is_train").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT l_suppkey, coalesce(l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0), FALSE) AS is_member, count(*) AS n
    FROM (SELECT CASE WHEN l_linenumber < 7 THEN l_suppkey END AS l_suppkey FROM lineitem) GROUP BY l_suppkey"""
)
def membership_split(spark, sf_dir):
    """Rows by whether their key is in a set, which holds repeats and a null; a null key is in none."""
    rows = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_linenumber") < 7, F.col("l_suppkey")).alias("l_suppkey"))
    chosen = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    chosen = chosen.union(chosen).union(rows.filter("l_suppkey IS NULL"))
    return features.membership_split(rows, chosen, "l_suppkey").groupBy("l_suppkey", "is_member").agg(F.count(F.lit(1)).alias("n"))


# ---- row order ---------------------------------------------------------------------------
# Line items in several CSV files with many engineer rows per key. The place of a row in the files has nothing to do with its values.

PLACE = ["k1", "k2", "k3", "k4", "k5", "k6"]
ORDERED_SQL = """SELECT concat('Job ', cast(l_suppkey % 40 AS varchar(10))) AS project_name, l_returnflag AS schedule, CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_linestatus END AS option,
 concat('A00', cast(l_partkey % 7 AS varchar(10))) AS line_item_no, concat(cast(15100 + l_partkey % 7 AS varchar(10)), '-0000') AS pay_item_no,
 CASE WHEN (l_linenumber + l_partkey) % 4 = 0 THEN NULL ELSE l_quantity END AS quantity,
 CASE (l_orderkey + l_linenumber) % 4 WHEN 0 THEN ' EA ' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE concat('U', cast(l_linenumber AS varchar(10))) END AS unit,
 concat('Supplier ', cast(l_suppkey % 10 AS varchar(10))) AS contractor, CASE WHEN l_linenumber = 4 THEN NULL ELSE l_extendedprice END AS unit_price, l_extendedprice AS amount,
 CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 0 END AS is_engineers_estimate,
 (l_orderkey * 7919) % 10007 AS k1, l_orderkey AS k2, l_linenumber AS k3, l_partkey AS k4, l_suppkey AS k5, l_extendedprice AS k6 FROM {lineitem}"""
ORDERED_PARTS = dict(
    placed=f"SELECT *, row({', '.join(PLACE)}) AS place FROM ({ORDERED_SQL.format(lineitem='lineitem')})",
    placed_id="SELECT *, concat(project_name, '|', schedule, '|', coalesce(option, '')) AS project_id FROM placed",
)


def ordered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items as read from CSV files whose order, and that of the rows in them, is `PLACE`."""
    folder = writers.shared_dir(spark, "ordered")
    rows = spark.sql(ORDERED_SQL, lineitem=table(spark, sf_dir, "lineitem"))
    writers.write_csv(rows.orderBy(*PLACE).drop(*PLACE), folder)
    return readers.read_line_items(spark, f"{folder}/*.csv")


def _first(c: str, name: str) -> str:
    return f"arg_min({c}, place) FILTER (WHERE {c} IS NOT NULL) AS {name}"


@query(
    f"""SELECT project_id, pay_item_no, {_first('unit_price', 'ee_unit_price')}, {_first('amount', 'ee_amount')}, {_first('quantity', 'ee_quantity')}, {_first('unit', 'ee_unit')}
    FROM placed_id WHERE is_engineers_estimate = 1 GROUP BY ALL""",
    **ORDERED_PARTS,
)
def engineer_reference_rows(spark, sf_dir):
    """The engineer's first price, amount, quantity and unit in the order of files and rows, each on its own."""
    return features.engineer_reference(features.with_project_id(ordered_items(spark, sf_dir)))


@query(
    """SELECT p.project_name, p.schedule, coalesce(p.option, '') AS option, p.line_item_no, p.pay_item_no, coalesce(p.quantity, e.q) AS quantity,
     coalesce(CASE WHEN trim(p.unit) <> '' THEN p.unit END, e.u, p.unit) AS unit, p.contractor, p.amount
    FROM placed p LEFT JOIN (SELECT project_name, schedule, option, line_item_no, pay_item_no, arg_min(quantity, place) FILTER (WHERE quantity IS NOT NULL) AS q,
      arg_min(trim(unit), place) FILTER (WHERE trim(unit) <> '') AS u FROM placed WHERE is_engineers_estimate = 1 GROUP BY ALL) e
    ON p.project_name = e.project_name AND p.schedule = e.schedule AND p.option IS NOT DISTINCT FROM e.option AND p.line_item_no = e.line_item_no AND p.pay_item_no = e.pay_item_no""",
    **ORDERED_PARTS,
)
def fill_from_engineer_rows(spark, sf_dir):
    """Quantity and unit from the first engineer row of the group, in the order of files and rows, that has one."""
    filled = repair.fill_from_engineer_grouped(ordered_items(spark, sf_dir))
    return filled.select(*PROJECT_KEYS, "line_item_no", "pay_item_no", "quantity", "unit", "contractor", "amount")


@query(
    """SELECT project_id, n, rk <= cast(floor(0.8 * total) AS bigint) AS is_train FROM (
     SELECT project_id, count(*) AS n, row_number() OVER (ORDER BY min(place), project_id) AS rk, count(*) OVER () AS total FROM placed_id GROUP BY project_id)""",
    **ORDERED_PARTS,
)
def project_split_rows(spark, sf_dir):
    """Projects by first appearance in the order of files and rows."""
    split = features.project_split(features.with_project_id(ordered_items(spark, sf_dir)))
    return split.groupBy("project_id", "is_train").agg(F.count(F.lit(1)).alias("n"))


# ---- quality -----------------------------------------------------------------------------


@query(VALIDATE_SQL, ("bid_lines",))
def validate(spark, sf_dir):
    return quality.validate(bid_lines(spark, sf_dir))


@query(f"SELECT {COLS} FROM bid_lines WHERE unit_price IS NOT NULL AND quantity IS NULL", ("bid_lines",))
def price_no_qty(spark, sf_dir):
    return quality.price_no_qty(bid_lines(spark, sf_dir))


@query(
    f"SELECT {COLS}, quantity * unit_price AS calc_amount, round(abs(amount - quantity * unit_price) / (quantity * unit_price), 6) AS pct_diff"
    " FROM bid_lines WHERE abs(amount - quantity * unit_price) / (quantity * unit_price) > 0.01",
    ("bid_lines",),
)
def amount_mismatch(spark, sf_dir):
    return rounded(quality.amount_mismatch(bid_lines(spark, sf_dir)), 6, "pct_diff")


@query(
    f"SELECT {COLS} FROM (SELECT *, count(*) OVER (PARTITION BY project_no, schedule, option, line_item_no, pay_item_no, contractor) AS n FROM bid_lines) WHERE n > 1",
    ("bid_lines",),
)
def duplicate_rows(spark, sf_dir):
    return quality.duplicate_rows(bid_lines(spark, sf_dir))


@query(
    """SELECT 'line_items' AS metric, cast(count(*) AS double) AS value FROM bid_lines
    UNION ALL SELECT 'bids', count(*) FROM bids
    UNION ALL SELECT 'unit_price_no_qty', count(*) FROM bid_lines WHERE unit_price IS NOT NULL AND quantity IS NULL
    UNION ALL SELECT 'amount_mismatches', count(*) FROM bid_lines WHERE abs(amount - quantity * unit_price) / (quantity * unit_price) > 0.01
    UNION ALL SELECT 'duplicates', sum(n) FROM (SELECT count(*) AS n FROM bid_lines GROUP BY project_no, schedule, option, line_item_no, pay_item_no, contractor HAVING count(*) > 1)
    UNION ALL SELECT 'contractors_missing_in_bids', count(*) FROM (SELECT DISTINCT project_no, contractor FROM bid_lines EXCEPT SELECT project_no, contractor FROM bids)""",
    ("bids",),
)
def integrity_report(spark, sf_dir):
    return quality.integrity_report(bid_lines(spark, sf_dir), bids(spark, sf_dir))


# ---- metrics -----------------------------------------------------------------------------
# The engineer's price stands in for a unit-price prediction, the engineer's share of the
# bidders' mean for a total, and the inverse of one plus the share of it for a win score.

PREDS_SQL = "SELECT w.*, ee.ee_unit_price AS unit_price_pred FROM with_id w LEFT JOIN ee USING (project_id, pay_item_no) WHERE is_engineers_estimate = 0"
ERRORS_SQL = (
    "SELECT *, abs(unit_price_pred - unit_price) AS abs_error, abs(unit_price_pred - unit_price) / nullif(unit_price, 0) AS pct_error"
    " FROM preds WHERE unit_price IS NOT NULL AND unit_price_pred IS NOT NULL"
)


def unit_price_preds(spark, sf_dir) -> DataFrame:
    return features.attach_engineer_ref(with_id(spark, sf_dir), ORDER).withColumn("unit_price_pred", F.col("ee_unit_price"))


@query(
    "SELECT project_id, line_item_no, contractor, unit_price, unit_price_pred, abs_error, pct_error FROM errors",
    ("with_id",), ee=EE_REF, preds=PREDS_SQL, errors=ERRORS_SQL,
)
def prediction_errors(spark, sf_dir):
    df = metrics.prediction_errors(unit_price_preds(spark, sf_dir))
    return df.select("project_id", "line_item_no", "contractor", "unit_price", "unit_price_pred", "abs_error", "pct_error")


@query(
    """SELECT metric, round(value, 6) AS value FROM (
    SELECT 'rows' AS metric, cast(count(*) AS double) AS value FROM errors UNION ALL SELECT 'mae', avg(abs_error) FROM errors
    UNION ALL SELECT 'rmse', sqrt(avg(abs_error * abs_error)) FROM errors UNION ALL SELECT 'median_abs_error', median(abs_error) FROM errors
    UNION ALL SELECT 'median_pct_error', median(pct_error) FROM errors)""",
    ("with_id",), ee=EE_REF, preds=PREDS_SQL, errors=ERRORS_SQL,
)
def error_summary(spark, sf_dir):
    return rounded(metrics.error_summary(metrics.prediction_errors(unit_price_preds(spark, sf_dir))), 6, "value")


@query(
    f"SELECT {', '.join(TOP_ERROR_COLUMNS)} FROM errors ORDER BY abs_error DESC, project_name, schedule, option NULLS FIRST, line_item_no, pay_item_no, contractor, unit_price, unit_price_pred LIMIT 10",
    ("with_id",), ee=EE_REF, preds=PREDS_SQL, errors=ERRORS_SQL,
)
def top_errors(spark, sf_dir):
    return metrics.top_errors(metrics.prediction_errors(unit_price_preds(spark, sf_dir)))


REGRESSION_SQL = """SELECT round(avg(abs({p} - {y})), 6) AS mae, round(sqrt(avg(({p} - {y}) * ({p} - {y}))), 6) AS rmse,
 round(1 - sum(({p} - {y}) * ({p} - {y})) / sum(({y} - m) * ({y} - m)), 6) AS r2, count(*) AS rows
FROM (SELECT {y}, {p}, avg({y}) OVER () AS m FROM {t} WHERE {y} IS NOT NULL AND {p} IS NOT NULL)"""
UNIT_SQL = REGRESSION_SQL.format(y="unit_price", p="unit_price_pred", t="preds")


@query(UNIT_SQL, ("with_id",), ee=EE_REF, preds=PREDS_SQL)
def regression_metrics(spark, sf_dir):
    return rounded(metrics.regression_metrics(unit_price_preds(spark, sf_dir), "unit_price", "unit_price_pred"), 6, "mae", "rmse", "r2")


# Scores and totals are made from counts, so that both engines get the very same doubles.
SCORES_SQL = """SELECT project_id, contractor, total_quantity AS total_amount, cast(num_items AS double) / (num_items + num_pay_items) AS win_prob,
 cast(25 * num_items AS double) AS total_amount_pred FROM pcf"""
LABELS_SQL = "SELECT *, CASE WHEN total_amount = min(total_amount) OVER (PARTITION BY project_id) THEN 1 ELSE 0 END AS win FROM scores"
AUC_SQL = """SELECT (sum(win * rk) - sum(win) * (sum(win) + 1) / 2.0) / (sum(win) * sum(1 - win)) AS roc_auc FROM (
 SELECT win, rank() OVER (ORDER BY win_prob) + (count(*) OVER (PARTITION BY win_prob) - 1) / 2.0 AS rk FROM labels)"""
AP_SQL = """SELECT sum(pos * tp / n) / sum(pos) AS pr_auc FROM (
 SELECT pos, cast(sum(pos) OVER (ORDER BY win_prob DESC) AS double) AS tp, sum(c) OVER (ORDER BY win_prob DESC) AS n FROM (
  SELECT win_prob, sum(win) AS pos, count(*) AS c FROM labels GROUP BY win_prob))"""
LOSS_SQL = "SELECT avg(-ln(CASE WHEN win = 1 THEN p ELSE 1 - p END)) AS log_loss, count(*) AS rows FROM (SELECT win, greatest(2.220446049250313e-16, least(1 - 2.220446049250313e-16, win_prob)) AS p FROM labels)"
SCORE_PARTS = dict(pcf=PCF_SQL, scores=SCORES_SQL, labels=LABELS_SQL)


def scores(spark, sf_dir) -> DataFrame:
    n = F.col("num_items")
    return features.project_contractor_features(with_id(spark, sf_dir)).select(
        "project_id", "contractor", F.col("total_quantity").alias("total_amount"),
        (n.cast("double") / (n + F.col("num_pay_items"))).alias("win_prob"), (25 * n).cast("double").alias("total_amount_pred"),
    )


@query(f"SELECT round(roc_auc, 9) AS roc_auc FROM ({AUC_SQL})", ("with_id",), **SCORE_PARTS)
def roc_auc(spark, sf_dir):
    return rounded(metrics.roc_auc(features.with_win_label(scores(spark, sf_dir)), "win", "win_prob"), 9, "roc_auc")


@query(f"SELECT round(pr_auc, 9) AS pr_auc FROM ({AP_SQL})", ("with_id",), **SCORE_PARTS)
def average_precision(spark, sf_dir):
    return rounded(metrics.average_precision(features.with_win_label(scores(spark, sf_dir)), "win", "win_prob"), 9, "pr_auc")


@query(f"SELECT round(log_loss, 9) AS log_loss, rows FROM ({LOSS_SQL})", ("with_id",), **SCORE_PARTS)
def log_loss(spark, sf_dir):
    return rounded(metrics.log_loss(features.with_win_label(scores(spark, sf_dir)), "win", "win_prob"), 9, "log_loss")


def _long(scope: str, sql: str, names: list[str]) -> str:
    parts = (f"SELECT '{scope}' AS scope, '{n}' AS metric, cast({n} AS double) AS value FROM ({sql})" for n in names)
    return " UNION ALL ".join(parts)


REG = ["mae", "rmse", "r2", "rows"]
HOLDOUT_SQL = "SELECT scope, metric, round(value, 6) AS value FROM (" + " UNION ALL ".join([
    _long("unit_price", UNIT_SQL, REG),
    _long("total_bid", REGRESSION_SQL.format(y="total_amount", p="total_amount_pred", t="scores"), REG),
    _long("win_prob", AUC_SQL, ["roc_auc"]), _long("win_prob", AP_SQL, ["pr_auc"]), _long("win_prob", LOSS_SQL, ["log_loss", "rows"]),
]) + ")"


@query(HOLDOUT_SQL, ("with_id",), ee=EE_REF, preds=PREDS_SQL, **SCORE_PARTS)
def evaluate_holdout(spark, sf_dir):
    s = scores(spark, sf_dir)
    return rounded(metrics.evaluate_holdout(unit_price_preds(spark, sf_dir), s, s), 6, "value")


# ---- the whole chain ---------------------------------------------------------------------

# Merged, cleaned, normalised, filled from the engineer's row and lump sums marked. Merging and
# cleaning in turn leave a null option null, and null options match no engineer row.
CHAIN_SQL = f"""SELECT i.*, coalesce(i.q, e.q) AS quantity, coalesce(i.u, e.u) AS unit FROM cleaned i
 LEFT JOIN cleaned_ee e USING (project_name, schedule, option, line_item_no, pay_item_no)"""
CHAIN_PARTS = dict(
    cleaned=f"""SELECT project_no, project_name, schedule, option, line_item_no, pay_item_no, concat('ITEM ', cast(cast(substr(line_item_no, 2) AS int) AS varchar)) AS description, quantity AS q, {CLEAN_UNIT} AS u,
 CASE WHEN is_engineers_estimate = 1 THEN contractor ELSE substr(contractor, 1, length(contractor) - 1) END AS contractor,
 unit_price, amount, cast(is_engineers_estimate AS bigint) AS is_engineers_estimate,
 CASE WHEN schedule = 'R' THEN NULL ELSE '1/2/2024' END AS report_date, 'NC' AS state, concat('County ', project_no) AS county FROM bid_lines""",
    cleaned_ee="SELECT project_name, schedule, option, line_item_no, pay_item_no, q, u FROM cleaned WHERE is_engineers_estimate = 1",
    chain=CHAIN_SQL,
    marked="""SELECT project_no, project_name, schedule, option, line_item_no, pay_item_no, description, contractor, unit_price, amount, is_engineers_estimate, report_date, state, county,
 f AS is_lump_sum, CASE WHEN f AND quantity IS NULL THEN 1.0 ELSE quantity END AS quantity, CASE WHEN f AND unit IS NULL THEN 'LS' ELSE unit END AS unit
 FROM (SELECT *, unit_price IS NULL OR (quantity IS NULL AND unit IS NULL) AS f FROM chain)""",
)


def canonical(spark, sf_dir) -> DataFrame:
    return canonical_items(shape.coerce(bid_lines(spark, sf_dir)), bids(spark, sf_dir), dedupe=True, order=ORDER)


@query("SELECT * FROM marked", ("bid_lines",), **CHAIN_PARTS)
def canonical_chain(spark, sf_dir):
    return canonical(spark, sf_dir).drop("_source_file")


CHAIN_WITH_ID = "SELECT *, concat(coalesce(project_name, ''), '|', coalesce(schedule, ''), '|', coalesce(option, '')) AS project_id FROM marked"


def feature_folder(spark, sf_dir) -> str:
    """Both feature files of the whole chain, written."""
    folder = writers.shared_dir(spark, "features")
    made = feature_tables(canonical(spark, sf_dir), ORDER)
    writers.write_features(made["line_items"], made["projects"], f"{folder}/line_items", f"{folder}/projects")
    return folder


@query(PCF_SQL, ("bid_lines",), **CHAIN_PARTS, with_id=CHAIN_WITH_ID)
def feature_files(spark, sf_dir):
    """The project feature file of the whole chain, read back."""
    return rounded_rollup(spark.read.parquet(f"{feature_folder(spark, sf_dir)}/projects"))


@query(LIF_SQL.replace(COLS, f"{COLS}, report_date, state, county, is_lump_sum"), ("bid_lines",), **CHAIN_PARTS, with_id=CHAIN_WITH_ID, ee=EE_REF)
def feature_files_items(spark, sf_dir):
    """The line-item feature file of the whole chain, read back."""
    made = rounded(spark.read.parquet(f"{feature_folder(spark, sf_dir)}/line_items"), 9, "log_quantity", "log_amount")
    return rounded(made, 6, "unit_price_vs_ee", "amount_vs_ee").drop("_source_file")
