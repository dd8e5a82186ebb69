"""Models: invariants, and attributions against the Shapley definition."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from bidlake.operators import attribution, features, models
from bidlake.plans import queries_models
from bidlake.plans.bid_lines import bid_lines

TREES = 4


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    rows = features.with_project_id(bid_lines(spark, sf_dir))
    return {"unit_price": features.line_item_features(rows, ["amount"]).cache(), "projects": features.project_contractor_features(rows).cache()}


@pytest.mark.parametrize("kind", ["unit_price", "total_bid", "win"])
def test_train_predict_save_explain(spark, tables, tmp_path, kind):
    table = tables.get(kind, tables["projects"])
    model, report = models.train(kind, table, trees=TREES, log_path=str(tmp_path / "runs"))
    found = {r["metric"]: r["value"] for r in report.collect()}
    assert found["train_rows"] + found["test_rows"] == table.filter(F.col("unit_price" if kind == "unit_price" else "total_amount").isNotNull()).count()
    assert found["r2"] > 0 if kind != "win" else found["roc_auc"] > 0.5
    run = spark.read.parquet(str(tmp_path / "runs")).first()
    assert run["experiment"] == kind and set(run["metrics"]) == set(found)

    predicted = model.predict(table)
    assert predicted.count() == table.count()
    assert predicted.filter(F.col(model.spec.prediction).isNull() | F.isnan(model.spec.prediction)).count() == 0
    model.save(str(tmp_path / "model"))
    again = models.BidModel.load(spark, str(tmp_path / "model")).predict(table)
    assert predicted.exceptAll(again).count() == 0

    explained = attribution.attributions(model, table)
    off = explained.agg(F.max(F.abs(F.col("margin") - F.col("raw_prediction")) / (1 + F.abs("raw_prediction")))).first()[0]
    assert off < 1e-9
    summary = attribution.attribution_summary(model, table).collect()
    assert {r["feature"] for r in summary} == set(model.spec.vector_names)
    assert max(r["mean_abs"] for r in summary) > 0


def test_models_trained_together_are_those_trained_alone(spark, tables, tmp_path):
    together = models.train_all({"total_bid": tables["projects"], "win": tables["projects"]}, trees=2, log_path=str(tmp_path / "runs"))
    assert list(together) == ["total_bid", "win"] and models.train_all({}) == {}
    for kind, (model, report) in together.items():
        alone, alone_report = models.train(kind, tables["projects"], trees=2)
        assert model.predict(tables["projects"]).exceptAll(alone.predict(tables["projects"])).count() == 0
        # Sums of doubles are added in the order in which tasks end.
        assert {r["metric"]: r["value"] for r in report.collect()} == pytest.approx({r["metric"]: r["value"] for r in alone_report.collect()}, rel=1e-9)
    assert {r["experiment"] for r in spark.read.parquet(str(tmp_path / "runs")).collect()} == set(together)



@pytest.mark.parametrize("kind", queries_models.KINDS)
def test_registered_queries_train_all_trees(spark, monkeypatch, kind):
    asked = []
    monkeypatch.setattr(queries_models, "_trained", {})
    monkeypatch.setattr(queries_models, "feature_table", lambda *a: None)
    monkeypatch.setattr(models, "written", lambda df, name: df)
    monkeypatch.setattr(models, "train", lambda kind, table, trees=models.TREES: (asked.append(trees), None))
    queries_models.trained(spark, "", kind)
    assert asked == [300]


def expected_value(node_of, at, x, kept):
    """Tree value when only the inputs in `kept` are known."""
    node = node_of[at]
    if node["left"] < 0:
        return node["prediction"]
    if node["feature"] in kept:
        return expected_value(node_of, node["left"] if x[node["feature"]] <= node["threshold"] else node["right"], x, kept)
    parts = [(node_of[c]["n"] / node["n"], c) for c in (node["left"], node["right"])]
    return sum(w * expected_value(node_of, c, x, kept) for w, c in parts)


def test_attribution_is_the_shapley_value():
    nodes = pd.DataFrame(
        [(0, 0, 0.0, 100, 1, 2, 0, 0.5), (0, 1, 0.0, 60, 3, 4, 1, 1.5), (0, 2, 7.0, 40, -1, -1, -1, None),
         (0, 3, 0.0, 20, 5, 6, 0, 0.2), (0, 4, -3.0, 40, -1, -1, -1, None), (0, 5, 1.0, 5, -1, -1, -1, None), (0, 6, 11.0, 15, -1, -1, -1, None)],
        columns=["tree", "id", "prediction", "n", "left", "right", "feature", "threshold"],
    )
    node_of = nodes.set_index("id").to_dict("index")
    tables = attribution.leaf_tables(nodes, [1.0])
    xs = np.array([[a, b, 0.0] for a in (0.1, 0.3, 0.9) for b in (1.0, 2.0)])
    got = attribution.attribute(xs, tables)
    m = xs.shape[1]
    for x, row in zip(xs, got):
        for i in range(m):
            others = [j for j in range(m) if j != i]
            want = sum(
                math.factorial(len(s)) * math.factorial(m - len(s) - 1) / math.factorial(m)
                * (expected_value(node_of, 0, x, {*s, i}) - expected_value(node_of, 0, x, set(s)))
                for size in range(m) for s in itertools.combinations(others, size)
            )
            assert abs(row[i] - want) < 1e-9


def test_neighbouring_leaves_are_looked_up_as_one():
    """A full tree of 32 leaves is 8 groups, inputs that come twice on a path included; single leaves give the same."""
    rng = np.random.default_rng(3)
    rows = [(0, i, float(i), 2.0 ** (10 - (i + 1).bit_length()) * 3, *((2 * i + 1, 2 * i + 2, int(rng.integers(4)), float(rng.random())) if i < 31 else (-1, -1, -1, None)))
            for i in range(63)]
    nodes = pd.DataFrame(rows, columns=["tree", "id", "prediction", "n", "left", "right", "feature", "threshold"])
    xs = rng.random((40, 4))
    alone, grouped = attribution.leaf_tables(nodes, [0.5], 0), attribution.leaf_tables(nodes, [0.5])
    assert grouped["groups"] == 8 and alone["groups"] == 32 and 2 * len(grouped["group"]) < len(alone["group"])
    node_of = nodes.set_index("id").to_dict("index")
    got = attribution.attribute(xs, grouped)
    assert np.allclose(got, attribution.attribute(xs, alone, 7))
    for x, row in zip(xs, got):
        assert row.sum() + grouped["base"][0] == pytest.approx(0.5 * expected_value(node_of, 0, x, {0, 1, 2, 3}))


def test_total_bids_and_wins_share_their_features(spark, monkeypatch):
    made = []
    monkeypatch.setattr(queries_models, "_trained", {})
    monkeypatch.setattr(queries_models, "_tables", {})
    monkeypatch.setattr(queries_models, "feature_table", lambda *a: made.append(a) or spark.range(1))
    monkeypatch.setattr(models, "written", lambda df, name: df)
    monkeypatch.setattr(models, "train_all", lambda tables: {kind: (kind, None) for kind in tables})
    found = queries_models.trained_all(spark, "", ["total_bid", "win"])
    assert len(made) == 1 and found["total_bid"][2] is found["win"][2]


def test_few_rows_are_boosted_in_few_tasks(spark, monkeypatch):
    """Statistics are shuffled by every task, so rows in many files come to one."""
    seen = []
    kept = models.written
    monkeypatch.setattr(models, "written", lambda df, name: seen.append((name, kept(df, name))) or seen[-1][1])
    rows = spark.range(64).repartition(8).select(
        F.concat(F.lit("p"), F.col("id") % 8).alias("project_id"), *[(F.col("id") % (k + 3)).cast("double").alias(c) for k, c in enumerate(models.TOTAL_BID_NUMBERS)]
    )
    rows = rows.withColumn("total_amount", F.col("project_id").substr(2, 1).cast("double"))
    models.fit("total_bid", rows, trees=1)
    assert len(dict(seen)["tree-input"].inputFiles()) == 1 and dict(seen)["tree-input"].count() == 64


def test_unseen_and_missing_categories(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 8.0), (None, 5.0)], "c string, y double")
    table = models.encode_categories(train, ["c"], "y")
    rows = {r["c"]: r["c_mean"] for r in models.apply_encoding(spark.createDataFrame([("a",), ("z",), (None,)], "c string"), table).collect()}
    assert rows["a"] == pytest.approx((4 + 10 * 4.25) / 12) and rows["z"] is None and rows[None] is None


def test_missing_and_infinite_inputs(spark):
    df = spark.createDataFrame([(1.5,), (None,), (float("inf"),), (float("nan"),)], "x double")
    rows = [tuple(r) for r in models.plain_inputs(df, ["x"]).select("x_value", "x_isnull").collect()]
    assert rows == [(1.5, 0.0), (-1.0, 1.0), (-1.0, 1.0), (-1.0, 1.0)]


def test_training_rows_do_not_see_their_own_targets(spark):
    """Two rows of one value in projects of different folds see each other's target and not their own."""
    keys = spark.range(60).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("k")).select("k", models.fold_of("k").alias("f")).collect()
    a = next(r.k for r in keys if r.f == 0)
    b = next(r.k for r in keys if r.f == 1)
    train = spark.createDataFrame([(a, "u", 1.0), (b, "u", 5.0), (a, "lone", 7.0), (a, None, 3.0), (b, "v", None)], "project_id string, c string, y double")
    means = models.out_of_fold_means(train, ["c"], "y")
    rows = {(r.project_id, r.c): r.c_mean for r in models.apply_out_of_fold(train, means).collect()}
    assert rows[(a, "u")] == pytest.approx((5.0 + 10 * 5.0) / 11) and rows[(b, "u")] == pytest.approx((1.0 + 10 * 11 / 3) / 11)
    assert rows[(a, "lone")] is None and rows[(a, None)] is None and rows[(b, "v")] is None
    assert models.out_of_fold_means(train.limit(0), ["c"], "y")["c"].count() == 0
