"""A bid-line table derived from the star-schema tables, in SQL that Spark and DuckDB both run.

It plants null quantities, units, prices and options, unit spellings, trailing punctuation,
double blanks and amounts that are off by the discount, with one engineer row per item.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlake.sources.writers import shared_dir, write_packed

TABLES = ("lineitem", "orders", "customer", "nation", "part")

BASE_SQL = """ SELECT l.*, c.c_nationkey, n.n_name
 FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
 JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
 JOIN {part} p ON l.l_partkey = p.p_partkey"""

# Bid lines of a table `base` of those rows, and the engineer rows of a table `bid` of those.
BID_SQL = """ SELECT concat('P', lpad(cast(c_nationkey AS varchar(10)), 3, '0')) AS project_no, n_name AS project_name,
  l_returnflag AS schedule, CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_linestatus END AS option,
  concat('A', lpad(cast(l_partkey % 40 AS varchar(10)), 4, '0')) AS line_item_no,
  concat(lpad(cast(15100 + l_partkey % 40 AS varchar(10)), 5, '0'), '-0000') AS pay_item_no,
  concat('ITEM  ', cast(l_partkey % 40 AS varchar(10)), ' ') AS description,
  CASE WHEN l_linenumber IN (2, 5) THEN NULL ELSE l_quantity END AS quantity,
  CASE l_partkey % 5 WHEN 0 THEN 'LF' WHEN 1 THEN 'Sq-Yd' WHEN 2 THEN 'CU/YD' WHEN 3 THEN 'EA' ELSE NULL END AS unit,
  concat('Supplier ', cast(l_suppkey % 10 AS varchar(10)), ', Inc.,') AS contractor,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice / l_quantity END AS unit_price,
  l_extendedprice * (1 - l_discount) AS amount, 0 AS is_engineers_estimate
 FROM base"""
ENGINEER_SQL = """ SELECT project_no, project_name, schedule, option, line_item_no, pay_item_no, description,
  max(quantity) AS quantity, max(unit) AS unit, 'Engineer''s Estimate' AS contractor,
  min(unit_price) AS unit_price, min(amount) AS amount, 1 AS is_engineers_estimate
 FROM bid GROUP BY project_no, project_name, schedule, option, line_item_no, pay_item_no, description"""
OF_BASE_SQL = f"""bid AS (
{BID_SQL}),
ee AS (
{ENGINEER_SQL})
SELECT * FROM bid UNION ALL SELECT * FROM ee
"""

BID_LINES_SQL = "\nWITH base AS (\n" + BASE_SQL + "),\n" + OF_BASE_SQL

# Bidder totals of the bid lines. Contractors 8 and 9 hand in no summary, and the report date
# differs by schedule, so that anti-joins and fan-out have something to find.
BIDS_SQL = """
SELECT project_no, project_name, schedule, option, contractor, is_engineers_estimate,
 CASE WHEN schedule = 'R' THEN NULL ELSE '1/2/2024' END AS report_date, 'NC' AS state,
 concat('County ', project_no) AS county, sum(amount) AS bid_amount
FROM {bid_lines}
WHERE contractor NOT LIKE 'Supplier 8%' AND NOT (contractor LIKE 'Supplier 9%' AND schedule = 'A')
GROUP BY project_no, project_name, schedule, option, contractor, is_engineers_estimate
"""


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out to all cores where the files give fewer splits than there are cores.

    A large table has more splits than that and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables the bid lines are made of."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    return tables | {"lineitem": spread(tables["lineitem"])}


#: What bid lines read of a line item and its order.
BASE_COLUMNS = [
    "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "c_nationkey", "n_name",
]
_bases: dict = {}


def base_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order's nation, joined once per session and data set: queries read bid lines several times."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _bases:
        folder = shared_dir(spark, "base")
        write_packed(spark.sql(BASE_SQL, **star_tables(spark, sf_dir)).select(*BASE_COLUMNS), folder)
        _bases[key] = folder
    return spark.read.parquet(_bases[key])


#: What an engineer row stands for.
ENGINEER_KEYS = ["project_no", "project_name", "schedule", "option", "line_item_no", "pay_item_no", "description"]


def bid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bid-line table.

    The largest text of a group is found by sorting the group's rows. Rows are brought down to one a unit first, by hashing and before any shuffle:
    what is left to sort is few rows a key, however many line items there are.
    """
    bid = spark.sql(BID_SQL.replace("FROM base", "FROM {base}"), base=base_rows(spark, sf_dir))
    by_unit = bid.groupBy(*ENGINEER_KEYS, "unit").agg(*[f(c).alias(c) for f, c in ((F.max, "quantity"), (F.min, "unit_price"), (F.min, "amount"))])
    return bid.union(spark.sql(ENGINEER_SQL.replace("FROM bid", "FROM {bid}"), bid=by_unit))


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bidder totals with report date, state and county."""
    return spark.sql(BIDS_SQL, bid_lines=bid_lines(spark, sf_dir))
