"""Column sets: header names, missing columns, order, types, the canonical form."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidlake.functions.text import norm_ws, strip_ws, to_number
from bidlake.schema import CANONICAL


def normalize_headers(df: DataFrame) -> DataFrame:
    """Column names stripped and in lower case."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def ensure_columns(df: DataFrame, schema: T.StructType = CANONICAL) -> DataFrame:
    """Add the columns of `schema` that are absent, as typed nulls."""
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    return df.withColumns(absent) if absent else df


def to_canonical(df: DataFrame) -> DataFrame:
    """The canonical columns in order, and the row position if there is one."""
    return df.select(*CANONICAL.names, *[c for c in ("_pos",) if c in df.columns])


def order_columns(df: DataFrame, first: list[str] = CANONICAL.names) -> DataFrame:
    """Known columns first, then the rest as they come."""
    known = [c for c in first if c in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in known])


def coerce(df: DataFrame, schema: T.StructType = CANONICAL) -> DataFrame:
    """Cast to the types of `schema`; what cannot be cast becomes null."""
    casts = {}
    for field in schema:
        if field.name not in df.columns or df.schema[field.name].dataType == field.dataType:
            continue
        c = F.col(field.name)
        if isinstance(field.dataType, T.NumericType) and isinstance(df.schema[field.name].dataType, T.StringType):
            c = to_number(c)
        casts[field.name] = c.try_cast(field.dataType)
    return df.withColumns(casts) if casts else df


def normalize(df: DataFrame) -> DataFrame:
    """The canonical table: columns, types, whitespace. Empty text stays empty."""
    typed = coerce(to_canonical(ensure_columns(df)))
    collapsed = ("description", "contractor")
    texts = [f.name for f in CANONICAL if isinstance(f.dataType, T.StringType) and f.name != "_source_file"]
    return typed.withColumns({c: (norm_ws if c in collapsed else strip_ws)(F.col(c)) for c in texts})
