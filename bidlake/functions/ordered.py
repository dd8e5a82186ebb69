"""Exact global running totals and order statistics without one task seeing all rows.

Rows are stored once and dealt out to ranges of their order, whose bounds Spark samples, so that a range holds about as many rows as
another whatever the values look like. A total per range gives each its offset; windows run inside a range.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidlake.sources.writers import written

RANGE_ROWS = 65_536


def _ranges(df: DataFrame, order: list[str], rows: int) -> DataFrame:
    """The frame as a stored table with `_range`: all of a range come before the next by `order`, about `rows` in each."""
    stored = written(df, "values")
    parts = max(1, -(-stored.count() // rows))
    return written(stored.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "ranges")


def _offsets(ranged: DataFrame, weights: list[str]) -> DataFrame:
    """One row per range: `_before_<w>`, the weights of all ranges before it, and `<w>_total` of all."""
    sums = ranged.groupBy("_range").agg(*[F.sum(w).alias(w) for w in weights])
    before, whole = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    return sums.select(
        "_range", *[F.coalesce(F.sum(w).over(before), F.lit(0)).alias(f"_before_{w}") for w in weights],
        *[F.sum(w).over(whole).alias(f"{w}_total") for w in weights],
    )


def _upto(ranged: DataFrame, offsets: DataFrame, order: list[str], weights: list[str]) -> DataFrame:
    """Rows of the ranges that `offsets` has, with `<w>_upto`."""
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = ranged.join(offsets, "_range")
    return rows.withColumns({f"{w}_upto": F.col(f"_before_{w}") + F.sum(w).over(inside) for w in weights}).drop("_range", *[f"_before_{w}" for w in weights])


def running_totals(df: DataFrame, order: list[str], weights: list[str], rows: int = RANGE_ROWS) -> DataFrame:
    """Add `<w>_upto` (inclusive, by `order`) and `<w>_total` for each weight column.

    `df` has one row per distinct ordering value.
    """
    ranged = _ranges(df, order, rows)
    return _upto(ranged, _offsets(ranged, weights), order, weights)


def exact_median(df: DataFrame, column: str, name: str = "median", rows: int = RANGE_ROWS) -> DataFrame:
    """One row: the interpolated median of a double column, null if it has no values.

    Distinct values are counted and stored once; of their ranges only those that hold a middle rank are looked into.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    ranged = _ranges(counts, ["v"], rows)
    offsets = _offsets(ranged, ["n"])
    low, high = F.floor((F.col("n_total") + 1) / 2), F.floor((F.col("n_total") + 2) / 2)
    ends = ranged.groupBy("_range").agg(F.sum("n").alias("_own"))
    middle = offsets.join(ends, "_range").filter((F.col("_before_n") < high) & (F.col("_before_n") + F.col("_own") >= low)).drop("_own")
    ranked = _upto(ranged, middle, ["v"], ["n"])
    below = F.col("n_upto") - F.col("n")

    def at(rank: Column) -> Column:
        return F.max(F.when((rank > below) & (rank <= F.col("n_upto")), F.col("v")))

    return ranked.agg(((at(low) + at(high)) / 2).alias(name))


def last_seen(df: DataFrame, group: list[str], order: str, value: str, chunk: int = 4096) -> DataFrame:
    """Replace `value` by the last non-null one up to and including the row, per group.

    `order` is a whole number. Windows run inside chunks of `chunk` consecutive numbers; what
    earlier chunks hold comes from one row per chunk.
    """
    rows = df.withColumn("_chunk", F.floor(F.col(order) / chunk))
    inside = Window.partitionBy(*group, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        rows.groupBy(*group, "_chunk")
        .agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_last"))
        .withColumn("_before", F.last("_last", ignorenulls=True).over(across))
        .drop("_last")
    )
    here = F.last(value, ignorenulls=True).over(inside)
    return (
        rows.withColumn("_here", here)
        .join(chunks, group + ["_chunk"])
        .withColumn(value, F.coalesce("_here", "_before"))
        .drop("_here", "_before", "_chunk")
    )


def following(df: DataFrame, group: list[str], order: str, column: str, ahead: int, chunk: int | None = 4096) -> DataFrame:
    """Add `<column>_1` .. `<column>_<ahead>`: the column in the next rows of the group by `order`, null behind the last.

    `order` is a whole number that may have gaps; rows of one number come by the column. Windows run inside chunks of
    `chunk` consecutive numbers. Only the first and last few rows of each chunk meet those of other chunks. Without `chunk` a window runs over the
    group: one shuffle and one sort, for groups of few rows.
    """
    if chunk is None:
        whole = Window.partitionBy(*group).orderBy(order, column)
        return df.withColumns({f"{column}_{k}": F.lead(column, k).over(whole) for k in range(1, ahead + 1)})
    rows = df.withColumn("_chunk", F.floor(F.col(order) / chunk))
    inside = Window.partitionBy(*group, "_chunk").orderBy(order, column)
    backwards = Window.partitionBy(*group, "_chunk").orderBy(F.desc(order), F.desc(column))
    across = Window.partitionBy(*group).orderBy(order, "_first")
    names = [f"{column}_{k}" for k in range(1, ahead + 1)]
    placed = rows.withColumns({"_first": F.row_number().over(inside), "_last": F.row_number().over(backwards)})
    near = placed.withColumns({n: F.lead(column, k + 1).over(inside) for k, n in enumerate(names)})
    border = placed.filter((F.col("_first") <= ahead) | (F.col("_last") <= ahead))
    border = border.withColumns({n: F.lead(column, k + 1).over(across) for k, n in enumerate(names)})
    out = near.filter(F.col("_last") > ahead).unionByName(border.filter(F.col("_last") <= ahead))
    return out.drop("_chunk", "_first", "_last")
