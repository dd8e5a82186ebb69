"""Prediction errors and model metrics, all as distributed aggregates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlake.functions.ordered import exact_median, running_totals
from bidlake.operators.features import with_win_label
from bidlake.operators.quality import to_long
from bidlake.schema import ENGINEER_FILL_KEYS, TOP_ERROR_COLUMNS
from bidlake.sources.writers import written

EPSILON = 2.220446049250313e-16  # spacing of doubles at 1.0


def prediction_errors(df: DataFrame) -> DataFrame:
    """Add abs_error and pct_error (null at price 0); rows without price or prediction go."""
    return (
        df.dropna(subset=["unit_price", "unit_price_pred"])
        .withColumn("abs_error", F.abs(F.col("unit_price_pred") - F.col("unit_price")))
        .withColumn("pct_error", F.try_divide(F.col("abs_error"), F.col("unit_price")))
    )


def error_summary(df: DataFrame) -> DataFrame:
    """Rows, MAE, RMSE and median errors of `prediction_errors`, as (metric, value).

    The errors are stored first: each figure reads them, and none works out again how they came about.
    """
    df = written(df.select("abs_error", "pct_error"), "errors")
    e = F.col("abs_error")
    plain = df.agg(F.count(F.lit(1)).alias("rows"), F.avg(e).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"))
    return (
        to_long(plain)
        .unionByName(to_long(exact_median(df, "abs_error", "median_abs_error")))
        .unionByName(to_long(exact_median(df, "pct_error", "median_pct_error")))
    )


def top_errors(df: DataFrame, k: int = 10) -> DataFrame:
    """The k largest absolute errors; ties in key order."""
    return (
        df.select(*TOP_ERROR_COLUMNS)
        .orderBy(F.desc("abs_error"), *ENGINEER_FILL_KEYS, "contractor", "unit_price", "unit_price_pred")
        .limit(k)
    )


def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """One row: mae, rmse, r2, rows. Pairs with a null go."""
    err = F.col(yhat) - F.col(y)
    sums = df.dropna(subset=[y, yhat]).agg(
        F.avg(F.abs(err)).alias("mae"),
        F.avg(err * err).alias("mse"),
        F.var_pop(y).alias("var"),
        F.min(y).alias("lo"),
        F.max(y).alias("hi"),
        F.count(F.lit(1)).alias("rows"),
    )
    constant = F.when(F.col("mse") == 0, 1.0).when(F.col("mse") > 0, 0.0)
    r2 = F.when(F.col("lo") == F.col("hi"), constant).otherwise(1 - F.col("mse") / F.col("var"))
    return sums.select("mae", F.sqrt("mse").alias("rmse"), r2.alias("r2"), "rows")


def scored_pairs(df: DataFrame, y: str, p: str) -> DataFrame:
    """The rows with a label and a score; null and NaN scores say nothing about a label."""
    return df.filter(F.col(y).isNotNull() & F.col(p).isNotNull() & ~F.isnan(F.col(p).cast("double")))


def score_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    """Distinct scores with positives, all rows, their running totals and overall totals."""
    scores = scored_pairs(df, y, p).groupBy(F.col(p).alias("score")).agg(
        F.sum(F.col(y).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("all")
    )
    return running_totals(scores, ["score"], ["pos", "all"])


def _auc_of(counts: DataFrame) -> DataFrame:
    d = {c: F.col(c).cast("double") for c in ("pos", "all", "pos_upto", "all_upto", "pos_total", "all_total")}
    neg = d["all"] - d["pos"]
    neg_below = d["all_upto"] - d["pos_upto"] - neg
    wins = F.sum(d["pos"] * (neg_below + neg / 2))
    pairs = F.max(d["pos_total"]) * F.max(d["all_total"] - d["pos_total"])
    at_or_above = d["all_total"] - d["all_upto"] + d["all"]
    pos_at_or_above = d["pos_total"] - d["pos_upto"] + d["pos"]
    steps = F.sum(d["pos"] * pos_at_or_above / at_or_above)
    return counts.agg(
        F.try_divide(wins, pairs).alias("roc_auc"),
        F.try_divide(steps, F.max(d["pos_total"])).alias("pr_auc"),
    )


def roc_auc(df: DataFrame, y: str, p: str) -> DataFrame:
    """One row: area under the ROC curve, ties count half; null with one class."""
    return _auc_of(score_counts(df, y, p)).select("roc_auc")


def average_precision(df: DataFrame, y: str, p: str) -> DataFrame:
    """One row: sum over score steps of recall gain x precision."""
    return _auc_of(score_counts(df, y, p)).select("pr_auc")


def log_loss(df: DataFrame, y: str, p: str) -> DataFrame:
    """One row: mean negative log of the probability given to the true class."""
    q = F.greatest(F.lit(EPSILON), F.least(F.lit(1.0 - EPSILON), F.col(p)))
    return scored_pairs(df, y, p).agg(F.avg(-F.ln(F.when(F.col(y) == 1, q).otherwise(1 - q))).alias("log_loss"), F.count(F.lit(1)).alias("rows"))


def classification_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """ROC-AUC, average precision, log loss and rows as (metric, value)."""
    return to_long(_auc_of(score_counts(df, y, p))).unionByName(to_long(log_loss(df, y, p)))


def evaluate_holdout(unit: DataFrame, total: DataFrame, win: DataFrame) -> DataFrame:
    """The three models' hold-out metrics as (scope, metric, value)."""
    labelled = written(with_win_label(win).select("win", "win_prob"), "labelled")
    return (
        to_long(regression_metrics(unit, "unit_price", "unit_price_pred"), "unit_price")
        .unionByName(to_long(regression_metrics(total, "total_amount", "total_amount_pred"), "total_bid"))
        .unionByName(
            classification_metrics(labelled, "win", "win_prob").select(F.lit("win_prob").alias("scope"), "metric", "value")
        )
    )
