"""Feature tables, the win label and the project split."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlake.functions.numeric import log1p_nullable, ratio
from bidlake.functions.ordered import running_totals
from bidlake.functions.text import project_id
from bidlake.operators.repair import first_value, row_order
from bidlake.schema import ROLLUP_KEYS


def is_bidder_row() -> Column:
    return F.col("is_engineers_estimate") == 0


def is_engineer_row() -> Column:
    return F.col("is_engineers_estimate") == 1


def with_project_id(df: DataFrame) -> DataFrame:
    """Add `project_id`."""
    return df.withColumn("project_id", project_id())


def count_distinct_with_null(c: Column, where: Column | None = None) -> Column:
    """Number of distinct values, null counted as one of them."""
    kept = c.isNull() if where is None else where & c.isNull()
    value = c if where is None else F.when(where, c)
    return F.count_distinct(value) + F.max(F.when(kept, 1).otherwise(0)).cast("bigint")


def engineer_reference(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Engineer's first price, amount, quantity and unit per project and pay item, each by row order (see `row_order`)."""
    named = {"ee_unit_price": "unit_price", "ee_amount": "amount", "ee_quantity": "quantity", "ee_unit": "unit"}
    return (
        df.filter(is_engineer_row())
        .groupBy("project_id", "pay_item_no")
        .agg(*[first_value(df, F.col(c), order=order).alias(name) for name, c in named.items()])
    )


def attach_engineer_ref(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Bidder rows with the engineer's reference values; null keys match nothing."""
    return df.filter(is_bidder_row()).join(engineer_reference(df, order), ["project_id", "pay_item_no"], "left")


def line_item_features(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Bidder rows with engineer's values, logs and ratios."""
    return attach_engineer_ref(df, order).withColumns({
        "log_quantity": log1p_nullable(F.col("quantity")),
        "log_amount": log1p_nullable(F.col("amount")),
        "unit_price_vs_ee": ratio(F.col("unit_price"), F.col("ee_unit_price")),
        "amount_vs_ee": ratio(F.col("amount"), F.col("ee_amount")),
    })


def project_totals(df: DataFrame) -> DataFrame:
    """Per project: the engineer's total (null without an engineer row) and number of bidders.

    Both come from one scan; projects without a bidder row are left out.
    """
    total = F.coalesce(F.sum(F.when(is_engineer_row(), F.col("amount"))), F.lit(0.0))
    return (
        df.filter(is_bidder_row() | is_engineer_row())
        .groupBy("project_id")
        .agg(
            F.when(F.count_if(is_engineer_row()) > 0, total).alias("ee_total_amount"),
            count_distinct_with_null(F.col("contractor"), is_bidder_row()).alias("num_bidders"),
        )
        .filter(F.col("num_bidders") > 0)
    )


def project_contractor_features(df: DataFrame) -> DataFrame:
    """One row per project and contractor: totals, counts, share of the engineer's total."""
    rollup = (
        df.filter(is_bidder_row())
        .groupBy(*ROLLUP_KEYS)
        .agg(
            F.coalesce(F.sum("amount"), F.lit(0.0)).alias("total_amount"),
            F.coalesce(F.sum("quantity"), F.lit(0.0)).alias("total_quantity"),
            F.count(F.lit(1)).alias("num_items"),
            count_distinct_with_null(F.col("pay_item_no")).alias("num_pay_items"),
            F.count_if(F.col("unit_price").isNull()).alias("missing_unit_price_count"),
        )
    )
    return rollup.join(project_totals(df), "project_id", "left").withColumn(
        "total_vs_ee", ratio(F.col("total_amount"), F.col("ee_total_amount"))
    )


def with_win_label(df: DataFrame) -> DataFrame:
    """Add `win`: 1 where the total is the project's lowest. Ties all win, a null total does not."""
    lowest = df.groupBy("project_id").agg(F.min("total_amount").alias("_lowest"))
    won = F.coalesce(F.col("total_amount") == F.col("_lowest"), F.lit(False))
    return df.join(lowest, "project_id", "left").withColumn("win", won.cast("int")).drop("_lowest")


def membership_split(df: DataFrame, members: DataFrame, key: str, name: str = "is_member") -> DataFrame:
    """Add a flag: is the row's key among those of `members`? A null key is a member of nothing; repeats in `members` change nothing."""
    known = members.filter(F.col(key).isNotNull()).select(key).distinct().withColumn(name, F.lit(True))
    return df.join(known, key, "left").select(*df.columns, F.coalesce(name, F.lit(False)).alias(name))


def project_ranks(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Distinct projects with their rank (`n_upto`) by first appearance in row order (see `row_order`), and number (`n_total`)."""
    known = df.filter(F.col("project_id").isNotNull())
    projects = known.groupBy("project_id").agg(F.min(row_order(df, order)).alias("_first"))
    fields = [f"_k{i}" for i in range(len(projects.schema["_first"].dataType.fields))]
    keys = [F.col(f"_first.{f.name}").alias(k) for k, f in zip(fields, projects.schema["_first"].dataType.fields)]
    ranked = running_totals(projects.select("project_id", *keys, F.lit(1).alias("n")), [*fields, "project_id"], ["n"])
    return ranked.drop("n", *fields)


def project_split(df: DataFrame, frac: float = 0.8, order: list[str] | None = None) -> DataFrame:
    """Add `is_train`: true for rows of the first `int(frac * n)` projects.

    Rows without a project are test rows.
    """
    cutoff = F.floor(F.col("n_total") * F.lit(frac))
    return membership_split(df, project_ranks(df, order).filter(F.col("n_upto") <= cutoff), "project_id", "is_train")
