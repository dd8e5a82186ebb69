"""Cleaning and repair of line items."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidlake.functions.text import blank_to_null, csv_stem, normalize_unit, strip_punct, strip_ws
from bidlake.operators.shape import coerce, order_columns
from bidlake.schema import (
    CANONICAL, ENGINEER_FILL_KEYS, ENGINEER_FILL_KEYS_WITH_DESCRIPTION, MISSING_REPORT_COLUMNS, PROJECT_KEYS,
)


def row_order(df: DataFrame, order: list[str] | None = None) -> Column:
    """What rows come first by: the named columns, or else `_pos`, which the readers give (file, block, row).

    A frame has no order of its own, so one of the two is needed.
    """
    if order:
        return F.struct(*order)
    if "_pos" not in df.columns:
        raise ValueError("the rows have no order: pass `order`, or read them with their position (`_pos`)")
    return F.col("_pos")


def first_value(df: DataFrame, value: Column, where: Column | None = None, order: list[str] | None = None) -> Column:
    """Aggregate: the first value in row order (see `row_order`) that is not null (and meets `where`)."""
    wanted = value.isNotNull() if where is None else value.isNotNull() & where
    return F.min_by(value, F.when(wanted, row_order(df, order)))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join in which null keys meet null keys; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def clean(df: DataFrame) -> DataFrame:
    """Blank texts to null, units and numbers normalised, edge punctuation dropped."""
    texts = [f.name for f in CANONICAL if isinstance(f.dataType, T.StringType) and f.name in df.columns]
    out = df.withColumns({c: blank_to_null(F.col(c)) for c in texts})
    if "unit" in out.columns:
        out = out.withColumn("unit", F.nullif(normalize_unit(F.col("unit")), F.lit("")))
    edged = [c for c in ("contractor", "description") if c in out.columns]
    return order_columns(coerce(out).withColumns({c: strip_punct(F.col(c)) for c in edged}))


def mark_lump_sum(df: DataFrame) -> DataFrame:
    """Flag rows with no price, or with neither quantity nor unit; fill those as 1 LS."""
    no_price, no_qty, no_unit = (F.col(c).isNull() for c in ("unit_price", "quantity", "unit"))
    flag = no_price | (no_qty & no_unit)
    return df.withColumns({
        "is_lump_sum": flag,
        "quantity": F.when(flag & no_qty, 1.0).otherwise(F.col("quantity")),
        "unit": F.when(flag & no_unit, "LS").otherwise(F.col("unit")),
    })


def fill_from_engineer(
    df: DataFrame,
    keys: list[str] = ENGINEER_FILL_KEYS_WITH_DESCRIPTION,
    null_safe: bool = False,
    blank_is_null: bool = False,
    order: list[str] | None = None,
) -> DataFrame:
    """Fill missing quantity and unit from the first engineer's row of the same key that has one, in row order.

    The engineer's values are aggregated first (one row per key), so a key with very many rows
    is never gathered in one task; the join is left to the optimizer. With `blank_is_null` a
    blank unit counts as missing and the engineer's unit is stripped.
    """
    unit = F.nullif(strip_ws(F.col("unit")), F.lit("")) if blank_is_null else F.col("unit")
    engineer = (
        df.filter(F.col("is_engineers_estimate") == 1)
        .groupBy(*keys)
        .agg(
            first_value(df, F.col("quantity"), order=order).alias("_ee_quantity"),
            first_value(df, unit, order=order).alias("_ee_unit"),
        )
    )
    joined = null_safe_join(df, engineer, keys) if null_safe else df.join(engineer, keys, "left")
    kept = F.when(unit.isNotNull(), F.col("unit")) if blank_is_null else F.col("unit")
    return joined.select(*[
        F.coalesce("quantity", "_ee_quantity").alias("quantity") if c == "quantity"
        else F.coalesce(kept, "_ee_unit", "unit").alias("unit") if c == "unit"
        else F.col(c)
        for c in df.columns
    ])


def fill_from_engineer_grouped(df: DataFrame, order: list[str] | None = None, document: list[str] = ()) -> DataFrame:
    """The per-document form: null keys form one group, a null option is empty.

    `document` names the columns that tell documents apart where the frame holds several.
    """
    named = df.withColumn("option", F.coalesce("option", F.lit("")))
    return fill_from_engineer(named, [*document, *ENGINEER_FILL_KEYS], null_safe=True, blank_is_null=True, order=order)


def merge_metadata(items: DataFrame, bids: DataFrame, dedupe: bool = False) -> DataFrame:
    """Report date, state and county from the bids of the same project, schedule and option.

    Filled only where null. Where bids disagree on the metadata of a project, an item is
    repeated for each version; `dedupe=True` keeps the least one instead.
    """
    blank_keys = {k: F.coalesce(F.when(~F.col(k).isin("nan", "NaN"), F.col(k)), F.lit("")) for k in PROJECT_KEYS}
    filled = [c for c in ("report_date", "state", "county") if c in bids.columns]
    keyed = bids.withColumns({k: v for k, v in blank_keys.items() if k in bids.columns})
    keys = [k for k in PROJECT_KEYS if k in bids.columns]
    if not keys or any(k not in items.columns for k in keys):
        raise ValueError(f"items and bids share too few of the keys {', '.join(PROJECT_KEYS)}")
    meta = keyed.select(*keys, *[F.col(c).alias(f"_bids_{c}") for c in filled])
    if dedupe and filled:
        found = F.min(F.struct(*[f"_bids_{c}" for c in filled])).alias("_m")
        meta = meta.groupBy(*keys).agg(found).select(*keys, "_m.*")
    else:
        meta = meta.distinct()
    left = items.withColumns({k: v for k, v in blank_keys.items() if k in items.columns})
    absent = {c: F.lit(None).cast("string") for c in filled if c not in items.columns}
    left = left.withColumns(absent) if absent else left
    joined = left.join(meta, keys, "left")
    return joined.select(*[
        F.coalesce(c, f"_bids_{c}").alias(c) if c in filled else F.col(c) for c in left.columns
    ])


def fill_report_date(items: DataFrame, doc_meta: DataFrame, path_column: str = "_source_file") -> DataFrame:
    """Report date of the source document where an item has none or one with `#` in it.

    `doc_meta` has one row per document: source_stem, report_date.
    """
    meta = doc_meta.groupBy(F.col("source_stem").alias("_stem")).agg(F.max("report_date").alias("_doc_date"))
    left = items if "report_date" in items.columns else items.withColumn("report_date", F.lit(None).cast("string"))
    joined = left.withColumn("_stem", csv_stem(F.col(path_column))).join(meta, "_stem", "left")
    replace = F.col("report_date").isNull() | F.contains(F.col("report_date"), F.lit("#"))
    date = F.when(replace, F.coalesce("_doc_date", "report_date")).otherwise(F.col("report_date"))
    return joined.select(*[date.alias(c) if c == "report_date" else F.col(c) for c in left.columns])


def missing_fields(df: DataFrame) -> DataFrame:
    """One row per item and per field (quantity, unit, unit_price) that is null in it."""
    names = F.array(*[F.when(F.col(c).isNull(), c) for c in ("quantity", "unit", "unit_price")])
    return df.select(*MISSING_REPORT_COLUMNS, F.explode(F.array_compact(names)).alias("missing_field"))
