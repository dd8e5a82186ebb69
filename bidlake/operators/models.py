"""The three models: unit price, total bid, win probability. Training, scoring, saving.

Trees do not take nulls, NaN or infinities here, so every number becomes a plain value and a
missing flag. Categories become the smoothed mean of the target per value (in training, over other projects), kept as a table and
joined in: the number of pay items and contractors grows with the data, and no list of them
passes through the driver.
"""

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline, PipelineModel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlake.functions.numeric import finite_or_null
from bidlake.operators import metrics
from bidlake.operators.features import project_split, with_win_label
from bidlake.operators.quality import to_long
from bidlake.schema import (
    LEAKING_INPUTS, TOTAL_BID_NUMBERS, TOTAL_ID_COLUMNS, UNIT_PRICE_CATEGORIES, UNIT_PRICE_ID_COLUMNS,
    UNIT_PRICE_NUMBERS, WIN_NUMBERS,
)
from bidlake.sources.writers import log_run, shared_dir, written

MISSING = -1.0  # value a missing number shows to the trees; its flag tells it from a real one
SMOOTHING = 10.0  # rows' worth of the overall mean added to each category
TREE_ROWS = 16_384  # training rows that are worth a task of their own in boosting
FOLDS = 5  # parts of the projects, each shown the category means of the others in training
# Fixed values of the three models' settings.
TREES, RATE, SEED = 300, 0.05, 42
REGRESSION_DEPTH, WIN_DEPTH, WIN_ROWS, WIN_COLUMNS = 5, 6, 0.9, "0.9"


@dataclass
class Spec:
    """What a model reads and predicts."""

    kind: str
    target: str
    prediction: str
    id_columns: list[str]
    numbers: list[str]
    categories: list[str] = field(default_factory=list)

    @property
    def inputs(self) -> list[str]:
        return self.numbers + [f"{c}_mean" for c in self.categories]

    @property
    def vector_names(self) -> list[str]:
        return self.inputs + [f"{c}_isnull" for c in self.inputs]


def spec_of(kind: str, leak_free: bool = False) -> Spec:
    """Inputs of a model; `leak_free` leaves out those computed from the target."""
    numbers = {"unit_price": UNIT_PRICE_NUMBERS, "total_bid": TOTAL_BID_NUMBERS, "win": WIN_NUMBERS}[kind]
    if leak_free:
        numbers = [c for c in numbers if c not in LEAKING_INPUTS[kind]]
    if kind == "unit_price":
        return Spec(kind, "unit_price", "unit_price_pred", UNIT_PRICE_ID_COLUMNS, numbers, UNIT_PRICE_CATEGORIES)
    if kind == "total_bid":
        return Spec(kind, "total_amount", "total_amount_pred", TOTAL_ID_COLUMNS, numbers)
    return Spec(kind, "win", "win_prob", TOTAL_ID_COLUMNS, numbers)


def encode_categories(train: DataFrame, columns: list[str], target: str) -> dict[str, DataFrame]:
    """Per column a table value -> smoothed mean of the target over the training rows."""
    known = train.filter(F.col(target).isNotNull())
    overall = known.agg(F.avg(target)).scalar()
    out = {}
    for c in columns:
        sums = known.filter(F.col(c).isNotNull()).groupBy(c).agg(F.sum(target).alias("_sum"), F.count(F.lit(1)).alias("_n"))
        mean = (F.col("_sum") + SMOOTHING * overall) / (F.col("_n") + SMOOTHING)
        out[c] = sums.select(c, mean.alias(f"{c}_mean"))
    return out


def apply_encoding(df: DataFrame, encoding: dict[str, DataFrame]) -> DataFrame:
    """Add `<column>_mean`; null for null and for values not seen in training."""
    for c, table in encoding.items():
        df = df.join(table, c, "left")
    return df


def fold_of(group: str = "project_id") -> Column:
    """0 to `FOLDS` - 1 by the key of the row's project; rows of one project share a fold."""
    return F.pmod(F.conv(F.substring(F.md5(F.coalesce(group, F.lit(""))), 1, 7), 16, 10).cast("long"), F.lit(FOLDS)).cast("int")


def out_of_fold_means(train: DataFrame, columns: list[str], target: str, group: str = "project_id") -> dict[str, DataFrame]:
    """Per column a table (value, `_fold`) -> smoothed mean of the target over the training rows of all other folds.

    So no row is shown a mean that its own target, or one of its project's, went into. A value that occurs in one fold alone has no
    mean there. Sums and counts are kept per value and fold, and a fold's mean is what is left without its own.
    """
    known = train.filter(F.col(target).isNotNull()).withColumn("_fold", fold_of(group))
    sums = {r["_fold"]: (r["s"], r["n"]) for r in known.groupBy("_fold").agg(F.sum(target).alias("s"), F.count(F.lit(1)).alias("n")).collect()}
    s, n = (sum(x[i] for x in sums.values()) for i in (0, 1))
    # The overall mean of the others, for each fold.
    overall = F.create_map(*[F.lit(x) for f, (a, b) in sums.items() for x in (f, (s - a) / (n - b) if n > b else 0.0)]) if sums else None
    out = {}
    for c in columns:
        by_fold = known.filter(F.col(c).isNotNull()).groupBy(c, "_fold").agg(F.sum(target).alias("_s"), F.count(F.lit(1)).alias("_n"))
        whole = by_fold.groupBy(c).agg(F.sum("_s").alias("_all_s"), F.sum("_n").alias("_all_n"))
        others = by_fold.join(whole, c).withColumns({"_s": F.col("_all_s") - F.col("_s"), "_n": F.col("_all_n") - F.col("_n")}).filter("_n > 0")
        mean = (F.col("_s") + SMOOTHING * overall[F.col("_fold")]) / (F.col("_n") + SMOOTHING) if sums else F.lit(None).cast("double")
        out[c] = others.select(c, "_fold", mean.alias(f"{c}_mean"))
    return out


def apply_out_of_fold(train: DataFrame, means: dict[str, DataFrame], group: str = "project_id") -> DataFrame:
    """Add `<column>_mean` of each training row by its value and fold."""
    df = train.withColumn("_fold", fold_of(group))
    for c, table in means.items():
        df = df.join(table, [c, "_fold"], "left")
    return df.drop("_fold")


def plain_inputs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add `<c>_value` (finite, `MISSING` where there is none) and `<c>_isnull` (0/1)."""
    values = {f"{c}_value": F.coalesce(finite_or_null(F.col(c)), F.lit(MISSING)) for c in columns}
    flags = {f"{c}_isnull": F.when(finite_or_null(F.col(c)).isNull(), 1.0).otherwise(0.0) for c in columns}
    return df.withColumns(values | flags)


def assembler(columns: list[str]) -> VectorAssembler:
    names = [f"{c}_value" for c in columns] + [f"{c}_isnull" for c in columns]
    return VectorAssembler(inputCols=names, outputCol="features")


def assemble(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add the vector `features`."""
    return assembler(columns).transform(plain_inputs(df, columns))


@dataclass
class BidModel:
    spec: Spec
    pipeline: PipelineModel
    encoding: dict[str, DataFrame]

    @property
    def trees(self) -> GBTRegressionModel | GBTClassificationModel:
        return self.pipeline.stages[-1]

    def prepare(self, features: DataFrame) -> DataFrame:
        return plain_inputs(apply_encoding(features, self.encoding), self.spec.inputs)

    def score(self, features: DataFrame) -> DataFrame:
        """All rows with the prediction column added."""
        scored = self.pipeline.transform(self.prepare(features))
        found = vector_to_array("probability")[1] if self.spec.kind == "win" else F.col("prediction")
        return scored.select(*features.columns, found.alias(self.spec.prediction))

    def predict(self, features: DataFrame) -> DataFrame:
        """Id columns and the prediction."""
        return self.score(features).select(*self.spec.id_columns, self.spec.prediction)

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        for c, table in self.encoding.items():
            table.write.mode("overwrite").parquet(f"{path}/encoding_{c}")
        spec = SparkSession.active().createDataFrame([(json.dumps(asdict(self.spec)),)], "spec string")
        spec.write.mode("overwrite").parquet(f"{path}/spec")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BidModel":
        spec = Spec(**json.loads(spark.read.parquet(f"{path}/spec").first()["spec"]))
        encoding = {c: spark.read.parquet(f"{path}/encoding_{c}") for c in spec.categories}
        return cls(spec, PipelineModel.load(f"{path}/pipeline"), encoding)


def _booster(kind: str, trees: int):
    common = dict(featuresCol="features", maxIter=trees, stepSize=RATE, seed=SEED, maxBins=64)
    if kind == "win":
        return GBTClassifier(labelCol="win", maxDepth=WIN_DEPTH, subsamplingRate=WIN_ROWS, featureSubsetStrategy=WIN_COLUMNS, **common)
    return GBTRegressor(labelCol=spec_of(kind).target, maxDepth=REGRESSION_DEPTH, **common)


def _use_shared_checkpoints(spark: SparkSession) -> None:
    """Boosting cuts its lineage every ten trees if there is a folder for it."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoints"))


def fit(kind: str, train: DataFrame, trees: int = TREES, leak_free: bool = False) -> BidModel:
    """Fit on all rows of `train` whose target is not null.

    Training rows see the category means of other folds of projects, rows scored later those of all training rows. Category tables and
    tree inputs are written to the shared folder first: boosting reads its input many times. At each level of each tree every task shuffles
    statistics of all nodes, inputs and bins, whatever its rows, so that few rows come to few tasks.
    """
    spark = train.sparkSession
    _use_shared_checkpoints(spark)
    spec = spec_of(kind, leak_free)
    known = train.filter(F.col(spec.target).isNotNull())
    tables = encode_categories(known, spec.categories, spec.target)
    encoding = {c: written(table, f"encoding-{c}") for c, table in tables.items()}
    unseen = out_of_fold_means(known, spec.categories, spec.target) if spec.categories else {}
    ready = plain_inputs(apply_out_of_fold(known, unseen) if unseen else known, spec.inputs)
    vectors = assembler(spec.inputs)
    narrow = ready.select(*vectors.getInputCols(), F.col(spec.target).cast("double").alias(spec.target))
    tasks = max(1, -(-known.count() // TREE_ROWS))
    pipeline = Pipeline(stages=[vectors, _booster(kind, trees)]).fit(written(narrow.coalesce(tasks), "tree-input"))
    return BidModel(spec, pipeline, encoding)


def fit_unit_price(features: DataFrame, trees: int = TREES, leak_free: bool = False) -> BidModel:
    return fit("unit_price", features, trees, leak_free)


def fit_total_bid(features: DataFrame, trees: int = TREES, leak_free: bool = False) -> BidModel:
    return fit("total_bid", features, trees, leak_free)


def fit_win(features: DataFrame, trees: int = TREES, leak_free: bool = False) -> BidModel:
    return fit("win", features if "win" in features.columns else with_win_label(features), trees, leak_free)


def predict_unit_price(model: BidModel, features: DataFrame) -> DataFrame:
    return model.predict(features)


def predict_total_bid(model: BidModel, features: DataFrame) -> DataFrame:
    return model.predict(features)


def predict_win_prob(model: BidModel, features: DataFrame) -> DataFrame:
    return model.predict(features)


def labelled_split(kind: str, features: DataFrame, frac: float = 0.8) -> DataFrame:
    """Rows with a target (and `win` label), and `is_train` by project.

    Projects come in row order if the rows have a position, else by the MD5 of their key: feature tables have no order.
    """
    target = "unit_price" if kind == "unit_price" else "total_amount"
    known = features.filter(F.col(target).isNotNull())
    known = with_win_label(known) if kind == "win" else known
    if "_pos" in known.columns:
        return project_split(known, frac)
    return project_split(known.withColumn("_md5", F.md5("project_id")), frac, ["_md5"]).drop("_md5")


def split_counts(split: DataFrame) -> DataFrame:
    """Rows of the two parts of a split, as (metric, value)."""
    return to_long(split.agg(F.count_if("is_train").alias("train_rows"), F.count_if(~F.col("is_train")).alias("test_rows")))


def train_metrics(model: BidModel, split: DataFrame) -> DataFrame:
    """Metrics on the test rows of a split, with train and test counts, as (metric, value)."""
    scored = model.score(split.filter(~F.col("is_train")))
    if model.spec.kind == "win":
        found = metrics.classification_metrics(scored, "win", "win_prob").filter("metric <> 'rows'")
    else:
        found = to_long(metrics.regression_metrics(scored, model.spec.target, model.spec.prediction).drop("rows"))
    return found.unionByName(split_counts(split))


def train(
    kind: str, features: DataFrame, trees: int = TREES, leak_free: bool = False, log_path: str | None = None
) -> tuple[BidModel, DataFrame]:
    """Fit on 80 % of the projects and report on the rest; append to the run log if given one."""
    split = written(labelled_split(kind, features), "split")
    model = fit(kind, split.filter("is_train"), trees, leak_free)
    report = train_metrics(model, split)
    if log_path:
        _log(features.sparkSession, log_path, trees, model, report)
    return model, report


def _log(spark: SparkSession, path: str, trees: int, model: BidModel, report: DataFrame) -> None:
    params = {"n_estimators": trees, "learning_rate": RATE, "random_state": SEED}
    log_run(spark, path, model.spec.kind, params, model.spec.numbers + model.spec.categories, report)


def train_all(
    features: dict[str, DataFrame], trees: int = TREES, leak_free: bool = False, log_path: str | None = None
) -> dict[str, tuple[BidModel, DataFrame]]:
    """`train` of several kinds, kind -> (model, report), at a time.

    Boosting is a long row of short jobs, one a tree level, so the jobs of one model fill the gaps of another. Each model is what `train`
    alone gives. The run log is written afterwards, model by model: appends to one folder must not meet.
    """
    if not features:
        return {}
    spark = next(iter(features.values())).sparkSession
    _use_shared_checkpoints(spark)
    with ThreadPoolExecutor(len(features)) as pool:
        started = {kind: pool.submit(inheritable_thread_target(spark)(train), kind, table, trees, leak_free) for kind, table in features.items()}
        found = {kind: s.result() for kind, s in started.items()}
    if log_path:
        for model, report in found.values():
            _log(spark, log_path, trees, model, report)
    return found
