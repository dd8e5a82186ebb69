"""Data-quality checks."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlake.functions.fixed import AMOUNT_TOLERANCE
from bidlake.operators.repair import null_safe_join
from bidlake.schema import DUPLICATE_GROUP_KEYS, DUPLICATE_ROW_KEYS


def to_long(row: DataFrame, scope: str | None = None) -> DataFrame:
    """A frame of one row of numbers as (scope,) metric, value."""
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in row.columns]
    out = row.select(F.inline(F.array(*pairs)))
    return out if scope is None else out.select(F.lit(scope).alias("scope"), "metric", "value")


def amount_mismatch_flag() -> Column:
    """quantity x price differs from the amount by over 1 % of the amount."""
    q, p, a = F.col("quantity"), F.col("unit_price"), F.col("amount")
    return F.abs(q * p - a) > F.abs(a) * AMOUNT_TOLERANCE


def validate(df: DataFrame) -> DataFrame:
    """One row of counts: rows, missing fields, amount mismatches, duplicate groups.

    One scan: the counts ride on the grouping that finds duplicates.
    """
    n = F.count(F.lit(1))
    per_key = df.groupBy(*DUPLICATE_GROUP_KEYS).agg(
        n.alias("n"),
        F.count_if(F.col("quantity").isNull()).alias("no_quantity"),
        F.count_if(F.col("unit").isNull()).alias("no_unit"),
        F.count_if(amount_mismatch_flag()).alias("mismatches"),
    )

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    return per_key.agg(
        total(F.col("n")).alias("rows"),
        total(F.col("no_quantity")).alias("missing_quantity"),
        total(F.col("no_unit")).alias("missing_unit"),
        total(F.when(F.col("unit_price").isNull(), F.col("n"))).alias("missing_unit_price"),
        total(F.col("mismatches")).alias("amount_mismatch_gt_1pct"),
        F.count_if(F.col("n") > 1).alias("duplicate_groups"),
    )


def price_no_qty(df: DataFrame) -> DataFrame:
    """Rows with a price but no quantity."""
    return df.filter(F.col("unit_price").isNotNull() & F.col("quantity").isNull())


def amount_mismatch(df: DataFrame, tol: float = AMOUNT_TOLERANCE) -> DataFrame:
    """Rows whose amount is off quantity x price by over `tol` of the product.

    The difference is relative to the signed product, so a negative product is never flagged.
    """
    calc = F.col("quantity") * F.col("unit_price")
    off = df.withColumn("calc_amount", calc).withColumn(
        "pct_diff", F.try_divide(F.abs(F.col("amount") - F.col("calc_amount")), F.col("calc_amount"))
    )
    return off.filter(F.col("pct_diff") > tol)


def duplicate_rows(df: DataFrame, keys: list[str] | None = None, ordered: bool = True) -> DataFrame:
    """All rows whose key occurs more than once; nulls are equal.

    Repeated keys are counted first and joined back, so a key with very many rows is spread
    over tasks.
    """
    keys = [k for k in (keys or DUPLICATE_ROW_KEYS) if k in df.columns]
    if not keys:
        return df.limit(0)
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).drop("_n")
    found = null_safe_join(df, repeated, keys, "left_semi")
    return found.orderBy(*keys) if ordered else found


def contractors_missing(items: DataFrame, bids: DataFrame, project_key: str | None = None) -> DataFrame:
    """Distinct (project, contractor) pairs of the items that the bids lack."""
    both = [k for k in ("project_no", "project_name") if k in items.columns and k in bids.columns]
    keys = [project_key or (both or ["project_no"])[0], "contractor"]
    if any(k not in f.columns for k in keys for f in (items, bids)):
        return items.limit(0).select(*[k for k in keys if k in items.columns])
    pairs = items.select(*keys).dropna().distinct()
    return pairs.join(bids.select(*keys), keys, "left_anti")


def integrity_report(items: DataFrame, bids: DataFrame) -> DataFrame:
    """Six counts as (metric, value)."""
    q, p, a = F.col("quantity"), F.col("unit_price"), F.col("amount")
    off = F.try_divide(F.abs(a - q * p), q * p) > AMOUNT_TOLERANCE
    keys = [k for k in DUPLICATE_ROW_KEYS if k in items.columns]
    per_key = items.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(p.isNotNull() & q.isNull()).alias("no_qty"),
        F.count_if(off).alias("off"),
    )
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("line_items"),
        F.coalesce(F.sum("no_qty"), F.lit(0)).alias("unit_price_no_qty"),
        F.coalesce(F.sum("off"), F.lit(0)).alias("amount_mismatches"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicates"),
    )
    n = F.count(F.lit(1))
    return (
        to_long(counts)
        .unionByName(to_long(bids.agg(n.alias("bids"))))
        .unionByName(to_long(contractors_missing(items, bids).agg(n.alias("contractors_missing_in_bids"))))
    )
