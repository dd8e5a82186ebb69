"""Number column functions that keep IEEE results where Spark would fail or give null."""

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")
NAN = float("nan")


def ratio(a: Column, b: Column) -> Column:
    """a / b; x/0 is +-infinity and 0/0 is NaN."""
    by_zero = F.when(a > 0, F.when(F.isnan(a), NAN).otherwise(INF)).when(a < 0, -INF).when(a == 0, NAN)
    return F.when(b == 0, by_zero).otherwise(a / b)


def log1p_nullable(x: Column) -> Column:
    """ln(x + 1); -infinity at 0, NaN below, null stays null."""
    y = x + F.lit(1.0)
    return F.when(y > 0, F.ln(y)).when(y == 0, -INF).when(y < 0, NAN)


def finite_or_null(x: Column) -> Column:
    """Null for NaN and infinities."""
    d = x.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < INF), d)

