"""Writers: tables, metrics and the run log."""

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bidlake.schema import PARSED_BID_COLUMNS, PARSED_ITEM_COLUMNS


# Nulls are bare, empty texts are quoted, and blanks at the ends of a text stay.
CSV_OPTIONS = dict(
    header=True, escape='"', emptyValue='""', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared folder (`spark.checkpoint.dir`); gone when the session ends.

    A local master shares its disk with itself, so there the warehouse folder will do; elsewhere the setting is needed.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediate"
        spark.conf.set("spark.checkpoint.dir", base)
    folder = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def write_packed(df: DataFrame, folder: str) -> None:
    """Parquet for the session's own use: packed harder than the default, as page text and names repeat themselves."""
    df.write.option("compression", "zstd").parquet(folder)


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, so that it is worked out once."""
    folder = shared_dir(df.sparkSession, name)
    write_packed(df, folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _csv_ready(df: DataFrame) -> DataFrame:
    """The frame without its row position; other nested columns have no CSV form."""
    nested = [f.name for f in df.schema.fields if f.dataType.simpleString().startswith(("struct", "array", "map")) and f.name != "_pos"]
    if nested:
        raise ValueError(f"columns with no CSV form: {', '.join(nested)}")
    return df.drop("_pos")


def write_csv(df: DataFrame, path: str, fields: list[str] | None = None) -> None:
    """CSV with a header; `fields` fixes the columns, those the frame lacks are blank."""
    if fields is not None:
        df = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in fields])
    _csv_ready(df).write.mode("overwrite").csv(path, **CSV_OPTIONS)


def write_dual(df: DataFrame, csv_path: str, parquet_path: str) -> int:
    """Write Parquet, then CSV from what was written; give the row count."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(parquet_path)
    write_csv(df.sparkSession.read.parquet(parquet_path), csv_path)
    return seen.get["rows"]


def write_parsed(items: DataFrame, bids: DataFrame, items_path: str, bids_path: str) -> None:
    """The document job's two tables as CSV."""
    write_csv(items, items_path, PARSED_ITEM_COLUMNS)
    write_csv(bids, bids_path, PARSED_BID_COLUMNS)


def write_features(line_items: DataFrame, projects: DataFrame, line_items_path: str, projects_path: str) -> None:
    """The two feature tables as Parquet."""
    line_items.write.mode("overwrite").parquet(line_items_path)
    projects.write.mode("overwrite").parquet(projects_path)


def write_missing_fields(report: DataFrame, path: str) -> None:
    """The missing-field report, one CSV folder per field, in one pass."""
    report.write.mode("overwrite").partitionBy("missing_field").csv(path, **CSV_OPTIONS)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A long metrics table (scope, metric, value) as JSON lines."""
    metrics.write.mode("overwrite").json(path)


def log_run(spark: SparkSession, path: str, experiment: str, params: dict, features: list[str], metrics: DataFrame) -> None:
    """Append one training run to the run log: parameters, feature list, metrics."""
    plain = {k: str(v) for k, v in params.items()} | {"feature_cols": ",".join(features)}
    pairs = [F.lit(x) for pair in plain.items() for x in pair]
    row = metrics.agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("metrics"))
    row.select(
        F.lit(experiment).alias("experiment"),
        F.current_timestamp().alias("logged_at"),
        F.create_map(*pairs).alias("params"),
        "metrics",
    ).write.mode("append").parquet(path)
