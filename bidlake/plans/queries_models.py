"""Registered queries over the models. Models are fitted on all training projects of the tables, with the
models' own number of trees; all rows are trained on, scored and explained.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlake.operators import attribution, features, models
from bidlake.plans.queries_tables import EE_REF, LIF_SQL, ORDER, PCF_SQL, rounded, with_id
from bidlake.plans.registry import query
from bidlake.schema import TOTAL_ID_COLUMNS, UNIT_PRICE_CATEGORIES, UNIT_PRICE_ID_COLUMNS
from bidlake.sources import writers

KINDS = ("unit_price", "total_bid", "win")
_trained: dict = {}
_tables: dict = {}


def feature_table(spark, sf_dir, kind: str) -> DataFrame:
    rows = with_id(spark, sf_dir)
    return features.line_item_features(rows, ORDER) if kind == "unit_price" else features.project_contractor_features(rows)


def stored_features(spark, sf_dir, kind: str) -> DataFrame:
    """The feature table of a kind, written once per session and data set; total bids and wins have the same one."""
    name = "items" if kind == "unit_price" else "bids"
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _tables:
        _tables[key] = models.written(feature_table(spark, sf_dir, kind), f"features-{name}")
    return _tables[key]


def trained_all(spark, sf_dir, kinds=KINDS) -> dict[str, tuple]:
    """Model, report and features of each kind, worked out once per session and data set; those still missing are fitted together."""
    key = lambda kind: (spark.sparkContext.applicationId, sf_dir, kind)
    tables = {kind: stored_features(spark, sf_dir, kind) for kind in kinds if key(kind) not in _trained}
    found = {kind: models.train(kind, table) for kind, table in tables.items()} if len(tables) == 1 else models.train_all(tables)
    for kind, pair in found.items():
        _trained[key(kind)] = (*pair, tables[kind])
    return {kind: _trained[key(kind)] for kind in kinds}


def trained(spark, sf_dir, kind: str):
    return trained_all(spark, sf_dir, [kind])[kind]


def scoped(frames: dict[str, DataFrame]) -> DataFrame:
    parts = [df.select(F.lit(kind).alias("scope"), *df.columns) for kind, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


@query()
def predict_unit_price(spark, sf_dir):
    model, _, table = trained(spark, sf_dir, "unit_price")
    return models.predict_unit_price(model, table)


@query()
def predict_total_bid(spark, sf_dir):
    model, _, table = trained(spark, sf_dir, "total_bid")
    return models.predict_total_bid(model, table)


@query()
def predict_win_prob(spark, sf_dir):
    model, _, table = trained(spark, sf_dir, "win")
    return models.predict_win_prob(model, table)


@query()
def train_metrics(spark, sf_dir):
    """Test metrics and row counts of the three models."""
    return scoped({kind: report for kind, (_, report, _) in trained_all(spark, sf_dir).items()})


def _counts(scope: str, rows: str) -> str:
    """SQL for the sizes of the two parts of the rows, projects by the MD5 of their key."""
    return f"""SELECT '{scope}' AS scope, unnest(['train_rows', 'test_rows']) AS metric, unnest([count(*) FILTER (WHERE train), count(*) FILTER (WHERE NOT train)])::DOUBLE AS value
    FROM (SELECT r.project_id, k.rk <= floor(0.8 * k.total) AS train FROM ({rows}) r
     JOIN (SELECT project_id, row_number() OVER (ORDER BY md5(project_id)) AS rk, count(*) OVER () AS total FROM (SELECT DISTINCT project_id FROM ({rows}))) k USING (project_id))"""


@query(
    " UNION ALL ".join([
        _counts("unit_price", "SELECT project_id FROM with_id WHERE is_engineers_estimate = 0 AND unit_price IS NOT NULL"),
        _counts("total_bid", "SELECT project_id FROM pcf"), _counts("win", "SELECT project_id FROM pcf"),
    ]),
    ("with_id",), pcf=PCF_SQL,
)
def train_counts(spark, sf_dir):
    """Rows that the three models are trained and tested on."""
    return scoped({kind: models.split_counts(models.labelled_split(kind, feature_table(spark, sf_dir, kind))) for kind in KINDS})


@query()
def attribution_summary(spark, sf_dir):
    """Contribution of each input, over all rows of the three models."""
    found = trained_all(spark, sf_dir)
    return scoped({kind: attribution.attribution_summary(model, table) for kind, (model, _, table) in found.items()})


UNIT_IDS, TOTAL_IDS = ", ".join(UNIT_PRICE_ID_COLUMNS), ", ".join(TOTAL_ID_COLUMNS)


@query(
    f"SELECT {UNIT_IDS}, TRUE AS scored FROM with_id WHERE is_engineers_estimate = 0", ("with_id",)
)
def scored_items(spark, sf_dir):
    """Every item gets a finite predicted price, also those without a price."""
    model, _, table = trained(spark, sf_dir, "unit_price")
    p = F.col("unit_price_pred")
    return model.predict(table).withColumn("scored", p.isNotNull() & ~F.isnan(p) & (F.abs(p) < float("inf"))).drop("unit_price_pred")


@query(f"SELECT {TOTAL_IDS}, TRUE AS scored FROM pcf", ("with_id",), pcf=PCF_SQL)
def scored_bids(spark, sf_dir):
    """Every bid gets a predicted total and a probability from 0 to 1."""
    total, win = trained_all(spark, sf_dir, ["total_bid", "win"]).values()
    keys = ["project_id", "contractor"]
    both = total[0].predict(total[2]).join(win[0].predict(win[2]).select(*keys, "win_prob"), keys)
    good = F.col("win_prob").between(0, 1) & ~F.isnan("total_amount_pred") & F.col("total_amount_pred").isNotNull()
    return rounded(both, 4, "total_amount").withColumn("scored", good).drop("total_amount_pred", "win_prob")


@query(
    """SELECT 'unit_price' AS scope, count(*) AS rows, TRUE AS adds_up FROM with_id WHERE is_engineers_estimate = 0 AND unit_price IS NOT NULL
    UNION ALL SELECT unnest(['total_bid', 'win']), count(*), TRUE FROM pcf""",
    ("with_id",), pcf=PCF_SQL,
)
def attribution_adds_up(spark, sf_dir):
    """Base value and contributions make up the raw prediction of every row."""
    found = trained_all(spark, sf_dir)
    off = F.abs(F.col("margin") - F.col("raw_prediction")) <= 1e-6 * (1 + F.abs("raw_prediction"))
    return scoped({
        kind: attribution.attributions(model, table).agg(F.count(F.lit(1)).alias("rows"), F.every(off).alias("adds_up"))
        for kind, (model, _, table) in found.items()
    })


@query(
    f"SELECT {UNIT_IDS}, TRUE AS same FROM with_id WHERE is_engineers_estimate = 0", ("with_id",)
)
def saved_model(spark, sf_dir):
    """A model read back gives the same prediction for every row."""
    model, _, table = trained(spark, sf_dir, "unit_price")
    folder = writers.shared_dir(spark, "model")
    model.save(folder)
    first = model.score(table)
    again = models.BidModel.load(spark, folder)
    rescored = again.score(first.withColumnRenamed("unit_price_pred", "first_pred"))
    return rescored.withColumn("same", F.col("first_pred") == F.col("unit_price_pred")).select(*UNIT_PRICE_ID_COLUMNS, "same")


def _means(c: str) -> str:
    return (
        f"SELECT '{c}' AS category, {c} AS value, round((sum(unit_price) + 10 * (SELECT avg(unit_price) FROM bidders)) / (count(*) + 10), 6) AS mean"
        f" FROM bidders WHERE {c} IS NOT NULL GROUP BY {c}"
    )


@query(
    " UNION ALL ".join(_means(c) for c in UNIT_PRICE_CATEGORIES), ("with_id",),
    bidders="SELECT * FROM with_id WHERE is_engineers_estimate = 0 AND unit_price IS NOT NULL",
)
def encode_categories(spark, sf_dir):
    rows = features.line_item_features(with_id(spark, sf_dir), ORDER)
    tables = models.encode_categories(rows, UNIT_PRICE_CATEGORIES, "unit_price")
    parts = [t.select(F.lit(c).alias("category"), F.col(c).alias("value"), F.round(f"{c}_mean", 6).alias("mean")) for c, t in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _others(c: str) -> str:
    return f"""SELECT '{c}' AS category, a.{c} AS value, a.fold, round((w.s - a.s + 10 * o.mean) / (w.n - a.n + 10), 6) AS mean
    FROM (SELECT {c}, fold, sum(unit_price) AS s, count(*) AS n FROM folded WHERE {c} IS NOT NULL GROUP BY {c}, fold) a
    JOIN (SELECT {c}, sum(unit_price) AS s, count(*) AS n FROM folded WHERE {c} IS NOT NULL GROUP BY {c}) w ON a.{c} = w.{c}
    JOIN fold_means o ON a.fold = o.fold WHERE w.n > a.n"""


@query(
    " UNION ALL ".join(_others(c) for c in UNIT_PRICE_CATEGORIES), ("with_id",),
    folded="SELECT *, (('0x' || substr(md5(project_id), 1, 7))::BIGINT % 5)::INT AS fold FROM with_id WHERE is_engineers_estimate = 0 AND unit_price IS NOT NULL",
    fold_means="""SELECT f.fold, (t.s - f.s) / (t.n - f.n) AS mean FROM (SELECT fold, sum(unit_price) AS s, count(*) AS n FROM folded GROUP BY fold) f,
     (SELECT sum(unit_price) AS s, count(*) AS n FROM folded) t""",
)
def out_of_fold_means(spark, sf_dir):
    """What training rows see of their categories: the mean over the projects of other folds."""
    rows = features.line_item_features(with_id(spark, sf_dir), ORDER)
    tables = models.out_of_fold_means(rows, UNIT_PRICE_CATEGORIES, "unit_price")
    parts = [
        t.select(F.lit(c).alias("category"), F.col(c).alias("value"), F.col("_fold").alias("fold"), F.round(f"{c}_mean", 6).alias("mean")) for c, t in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "SELECT project_id, contractor, line_item_no, amount, [round(coalesce(log_quantity, -1), 6), coalesce(unit_price, -1), coalesce(ee_unit_price, -1),"
    " cast(quantity IS NULL AS double), cast(unit_price IS NULL AS double), cast(ee_unit_price IS NULL AS double)] AS inputs FROM lif",
    ("with_id",), ee=EE_REF, lif=LIF_SQL,
)
def assemble(spark, sf_dir):
    """The vector the trees see: values, then missing flags."""
    rows = features.line_item_features(with_id(spark, sf_dir), ORDER)
    named = rounded(rows, 6, "log_quantity")
    vectors = models.assemble(named, ["log_quantity", "unit_price", "ee_unit_price"])
    return vectors.select("project_id", "contractor", "line_item_no", "amount", models.vector_to_array("features").alias("inputs"))
