"""Edge cases of the table operators, on small hand-written tables."""

import math

import pytest
from pyspark.sql import functions as F

from bidlake.functions import numeric, text
from bidlake.functions.ordered import exact_median, last_seen
from bidlake.operators import features, metrics, quality, repair, shape
from bidlake.sources import readers, writers


def values(df):
    return [tuple(r) for r in df.collect()]


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


def test_casts(spark):
    df = spark.createDataFrame([("abc",), ("1,234",), (" 1.5 ",), ("1.0",), ("1.5d",), ("",), ("1e3",)], "quantity string")
    both = df.withColumn("is_engineers_estimate", F.col("quantity"))
    rows = values(shape.coerce(both))
    assert rows == [(None, None), (None, None), (1.5, 1), (1.0, 1), (None, None), (None, None), (1000.0, 1000)]


def test_ratios_and_logs(spark):
    df = spark.createDataFrame([(0.0, 0.0), (5.0, 0.0), (-5.0, 0.0), (None, 0.0), (1.0, None), (1.0, 4.0)], "a double, b double")
    got = [r[0] for r in df.select(numeric.ratio(F.col("a"), F.col("b"))).collect()]
    assert all(map(same, got, [math.nan, math.inf, -math.inf, None, None, 0.25]))
    logs = spark.createDataFrame([(-2.0,), (-1.0,), (0.0,), (None,)], "x double").select(numeric.log1p_nullable(F.col("x")))
    assert all(map(same, [r[0] for r in logs.collect()], [math.nan, -math.inf, 0.0, None]))


def test_blanks(spark):
    df = spark.createDataFrame([("",), ("\t",), (" a  b\n",), ("nan",), ("NA",)], "t string")
    t = F.col("t")
    got = values(df.select(text.strip_ws(t), text.norm_ws(t), text.blank_to_null(t), text.na_to_null(t)))
    assert got == [("", "", None, None), ("", "", None, "\t"), ("a  b", "a b", "a b", " a  b\n"), ("nan", "nan", None, None), ("NA", "NA", "NA", None)]


def test_units_and_edges(spark):
    df = spark.createDataFrame([("l.f.", " , Acme, Inc.,"), ("sq-yd", ","), ("SQ - YD", None), ("xyz", "a")], "unit string, contractor string")
    got = values(repair.clean(df).select("unit", "contractor"))
    assert got == [("LNFT", "Acme, Inc."), ("SQYD", None), ("SQ   YD", None), ("XYZ", "a")]


def test_stems(spark):
    df = spark.createDataFrame([("/a/b c(1).v2.pdf",), ("x_line_items_filled.csv",)], "p string")
    assert values(df.select(text.safe_stem(F.col("p")), text.csv_stem(F.col("p")))) == [("b_c_1_.v2", "b c(1).v2.pdf"), ("x_line_items_filled", "x")]


ITEM = "project_name string, schedule string, option string, line_item_no string, pay_item_no string, description string, contractor string, quantity double, unit string, unit_price double, amount double, is_engineers_estimate bigint, _pos struct<file_path:string,block_start:bigint,seq:bigint>"


def item(name="p", schedule="A", option=None, contractor="c", quantity=None, unit=None, unit_price=None, amount=None, ee=0, pos=0, file="f"):
    return (name, schedule, option, "A001", "15101-0000", "d", contractor, quantity, unit, unit_price, amount, ee, (file, 0, pos))


def test_first_engineer_value_follows_row_order(spark):
    df = spark.createDataFrame([
        item(ee=1, pos=2, unit_price=9.0, unit="Z"), item(ee=1, pos=1, unit_price=None, unit="A"), item(ee=1, pos=3, unit_price=1.0),
        item(ee=1, pos=0, unit_price=5.0, file="g"),
    ], ITEM)
    row = features.engineer_reference(features.with_project_id(df)).first()
    assert (row["ee_unit_price"], row["ee_unit"], row["ee_quantity"]) == (9.0, "A", None)


def test_null_option_keys(spark):
    df = spark.createDataFrame([item(ee=1, quantity=3.0, unit=" EA "), item(ee=1, option="X", quantity=4.0, unit="LS"), item(), item(option="X"), item(unit=" ")], ITEM)
    plain = sorted(values(repair.fill_from_engineer(df).select("option", "quantity", "unit")), key=str)
    assert plain == sorted([(None, 3.0, " EA "), ("X", 4.0, "LS"), (None, None, None), ("X", 4.0, "LS"), (None, None, " ")], key=str)
    grouped = sorted(values(repair.fill_from_engineer_grouped(df).select("option", "quantity", "unit")), key=str)
    assert grouped == sorted([("", 3.0, " EA "), ("X", 4.0, "LS"), ("", 3.0, "EA"), ("X", 4.0, "LS"), ("", 3.0, "EA")], key=str)


def test_all_null_group_and_null_contractor(spark):
    rows = [item(contractor=None), item(contractor="a"), item(ee=1), item(name="q"), item(name="r", ee=1, amount=1.0)]
    got = {(r["project_name"], r["contractor"]): r for r in features.project_contractor_features(features.with_project_id(spark.createDataFrame(rows, ITEM))).collect()}
    a, q = got[("p", "a")], got[("q", "c")]
    assert (a["total_amount"], a["ee_total_amount"], a["num_bidders"], a["missing_unit_price_count"]) == (0.0, 0.0, 2, 1)
    assert math.isnan(a["total_vs_ee"]) and q["ee_total_amount"] is None and q["total_vs_ee"] is None
    assert len(got) == 3


def test_null_flag_goes_to_neither_side(spark):
    rows = [item(ee=None, amount=5.0), item(amount=1.0), item(ee=1, amount=2.0)]
    row = features.project_contractor_features(features.with_project_id(spark.createDataFrame(rows, ITEM))).first()
    assert (row["total_amount"], row["ee_total_amount"], row["num_items"]) == (1.0, 2.0, 1)


def test_win_label_ties_and_nulls(spark):
    df = spark.createDataFrame([("p", 1.0), ("p", 1.0), ("p", 2.0), ("p", None)], "project_id string, total_amount double")
    assert sorted(values(features.with_win_label(df).select("total_amount", "win")), key=str) == [(1.0, 1), (1.0, 1), (2.0, 0), (None, 0)]


def test_split_in_order_of_appearance(spark):
    rows = [item(name=n, pos=i) for i, n in enumerate(["z", "y", "z", "a", "x", "b"])]
    split = features.project_split(features.with_project_id(spark.createDataFrame(rows, ITEM)))
    assert {r[0] for r in split.filter("is_train").select("project_name").collect()} == {"z", "y", "a", "x"}


def test_mismatch_of_negative_product(spark):
    df = spark.createDataFrame([item(quantity=-1.0, unit_price=5.0, amount=10.0)], ITEM)
    assert quality.amount_mismatch(df).count() == 0
    assert quality.validate(df).first()["amount_mismatch_gt_1pct"] == 1


def test_duplicates_with_null_keys(spark):
    df = spark.createDataFrame([item(contractor=None), item(contractor=None), item(contractor="x")], ITEM)
    assert quality.duplicate_rows(df).count() == 2
    assert quality.validate(df).first()["duplicate_groups"] == 1


def test_metadata_fan_out(spark):
    items = spark.createDataFrame([("p", "A", None, None, "VA")], "project_name string, schedule string, option string, report_date string, state string")
    bids = spark.createDataFrame([("p", "A", "", "1/1/2024", "NC"), ("p", "A", "nan", "2/2/2024", "NC")], "project_name string, schedule string, option string, report_date string, state string")
    assert sorted(values(repair.merge_metadata(items, bids).select("report_date", "state"))) == [("1/1/2024", "VA"), ("2/2/2024", "VA")]
    assert values(repair.merge_metadata(items, bids, dedupe=True).select("report_date")) == [("1/1/2024",)]


SCORES = [(0, 0.1), (1, 0.1), (0, 0.4), (1, 0.8), (1, 0.9), (0, 0.9)]


def test_tied_scores(spark):
    df = spark.createDataFrame(SCORES, "y int, p double")
    assert metrics.roc_auc(df, "y", "p").first()[0] == pytest.approx(5 / 9)
    assert metrics.average_precision(df, "y", "p").first()[0] == pytest.approx(5 / 9)
    one_class = df.filter("y = 1")
    assert metrics.roc_auc(one_class, "y", "p").first()[0] is None


def test_log_loss_is_clipped(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.0)], "y int, p double")
    assert metrics.log_loss(df, "y", "p").first()["log_loss"] == pytest.approx(-math.log(2.220446049250313e-16) / 2)


def test_constant_target(spark):
    df = spark.createDataFrame([(2.0, 2.0), (2.0, 3.0), (None, 1.0)], "y double, p double")
    assert tuple(metrics.regression_metrics(df, "y", "p").first()) == (0.5, pytest.approx(math.sqrt(0.5)), 0.0, 2)
    assert metrics.regression_metrics(df.filter("p = 2"), "y", "p").first()["r2"] == 1.0


@pytest.mark.parametrize("xs,want", [([3.0, -1.0, 2.0], 2.0), ([5.0, -7.5, 1e300, 0.0], 2.5), ([-0.0, 0.0, 0.0], 0.0), ([], None), ([1.0] * 9 + [2.0], 1.0)])
def test_exact_median(spark, xs, want):
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "v double")
    assert exact_median(df, "v").first()[0] == want


def test_price_zero_has_no_relative_error(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0), (None, 1.0)], "unit_price double, unit_price_pred double")
    assert sorted(values(metrics.prediction_errors(df)), key=str) == [(0.0, 1.0, 1.0, None), (2.0, 1.0, 1.0, 0.5)]


def test_last_seen_over_chunks(spark):
    df = spark.createDataFrame([("d", i, str(i) if i % 7 == 3 else None) for i in range(40)], "doc string, n int, v string")
    got = {r["n"]: r["v"] for r in last_seen(df, ["doc"], "n", "v", chunk=4).collect()}
    assert got == {i: None if i < 3 else str(i - (i - 3) % 7) for i in range(40)}


def test_csv_sets_of_differing_headers(spark, tmp_path):
    (tmp_path / "b_line_items.csv").write_text("Amount , quantity,Extra\n5,NA,x\n")
    (tmp_path / "a_line_items.csv").write_text('quantity,contractor\n"1,000","Acme, ""Inc."""\n2, b \n')
    got = readers.read_csv_set(spark, f"{tmp_path}/*.csv")
    assert sorted(got.columns) == sorted(["amount", "quantity", "extra", "contractor", "_source_file", "_pos"])
    rows = {(r["_source_file"], r["quantity"], r["contractor"], r["amount"]) for r in got.collect()}
    assert rows == {("a_line_items.csv", "1,000", 'Acme, "Inc."', None), ("a_line_items.csv", "2", " b ", None), ("b_line_items.csv", None, None, "5")}
    typed = readers.read_line_items(spark, f"{tmp_path}/a*.csv")
    assert {r["quantity"] for r in typed.collect()} == {None, 2.0}
    with pytest.raises(FileNotFoundError):
        readers.read_csv_set(spark, f"{tmp_path}/none*.csv")


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([item(unit=""), item(unit=None), item(unit=" x ")], ITEM)
    assert writers.write_dual(df, f"{tmp_path}/c", f"{tmp_path}/p.parquet") == 3
    back = readers.read_table(spark, f"{tmp_path}/c")
    assert {r["unit"] for r in back.collect()} == {"", None, " x "}
    assert readers.read_table(spark, f"{tmp_path}/p.parquet").count() == 3
    writers.write_csv(df, f"{tmp_path}/fixed", ["pdf_page", "unit"])
    assert spark.read.csv(f"{tmp_path}/fixed", header=True).columns == ["pdf_page", "unit"]
    writers.write_missing_fields(repair.missing_fields(df), f"{tmp_path}/missing")
    assert spark.read.csv(f"{tmp_path}/missing/missing_field=unit", header=True).count() == 1


def test_csv_fields_with_line_breaks_and_reordered_headers(spark, tmp_path):
    for name, text in (("a", 'amount,quantity,description\n1,2,"x\ny"\n'), ("b", "quantity,amount\n3,4\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    rows = readers.read_line_items(spark, f"{tmp_path}/*.csv").select("amount", "quantity", "description").collect()
    assert sorted((r.amount, r.quantity, r.description) for r in rows) == [(1.0, 2.0, "x\ny"), (4.0, 3.0, None)]


def test_union_of_a_number_and_a_text(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("one",)], "x string")
    assert sorted(r.x for r in readers.union_relaxed([a, b]).collect()) == ["1", "one"]


def test_null_and_nan_scores_are_left_out(spark):
    rows = [(1, 0.9), (0, 0.2), (1, None), (0, float("nan")), (None, 0.4)]
    df, good = (spark.createDataFrame(r, "y int, p double") for r in (rows, rows[:2]))
    for f in (metrics.roc_auc, metrics.average_precision, metrics.log_loss):
        assert f(df, "y", "p").first() == f(good, "y", "p").first()


def test_csv_refuses_nested_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="no CSV form"):
        writers.write_csv(spark.sql("SELECT 1 AS a, array(1) AS b"), str(tmp_path / "x"))


def test_rows_without_order_are_refused(spark):
    """No first value without an order: neither the engineer's, nor the first projects."""
    df = features.with_project_id(spark.createDataFrame([item(ee=1, unit_price=1.0)], ITEM)).drop("_pos")
    for f in (features.engineer_reference, features.line_item_features, features.project_split, repair.fill_from_engineer, repair.fill_from_engineer_grouped):
        with pytest.raises(ValueError, match="no order"):
            f(df)
    assert features.engineer_reference(df, ["amount"]).first().ee_unit_price == 1.0


@pytest.mark.parametrize("rows", [1, 3, 100_000])
def test_totals_and_medians_over_ranges(spark, rows):
    """Any number of ranges gives the same totals and medians."""
    import random

    from bidlake.functions.ordered import running_totals

    rng = random.Random(rows)
    values_ = list({rng.choice([rng.gauss(0, 1e-9), rng.gauss(0, 1e200), float(rng.randint(-3, 3))]) for _ in range(60)})
    df = spark.createDataFrame([(v, i % 5) for i, v in enumerate(values_)], "v double, n int")
    got = {r.v: (r.n_upto, r.n_total) for r in running_totals(df, ["v"], ["n"], rows).collect()}
    weight = dict((v, i % 5) for i, v in enumerate(values_))
    assert got == {v: (sum(weight[x] for x in values_ if x <= v), sum(weight.values())) for v in values_}
    repeated = [v for v in values_ for _ in range(weight[v])]
    frame = spark.createDataFrame([(v,) for v in repeated] + [(None,)], "v double")
    import statistics

    assert exact_median(frame, "v", rows=rows).first()[0] == statistics.median(repeated)


def test_members_and_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    members = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    got = values(features.membership_split(df, members, "k").orderBy("v"))
    assert got == [(1, "a", True), (2, "b", False), (None, "c", False)]
    assert not any(r.is_member for r in features.membership_split(df, members.limit(0), "k").collect())


def test_headers_are_found_in_the_beginning_of_files(spark, tmp_path):
    """1,000 files of three headers, one of which has a line break; what is read does not grow with the files."""
    heads = ["a,b", "b,a", 'a,"b\nc"']
    for i in range(1000):
        (tmp_path / f"f{i:04d}.csv").write_text(f"{heads[i % 3]}\n{i},x\n")
    (tmp_path / "g_empty.csv").write_text("")
    (tmp_path / "h_large.csv").write_text("a,b\n" + "1,2\n" * 3_000_000)
    groups = readers.files_by_header(spark, readers.expand_glob(spark, f"{tmp_path}/*.csv"))
    assert sorted(map(len, groups)) == [333, 333, 335]
    assert sorted(g[0].rsplit("/", 1)[1] for g in groups) == ["f0000.csv", "f0001.csv", "f0002.csv"]
    big = next(g for g in groups if len(g) == 335)
    assert big[-1].endswith("h_large.csv")


def test_reading_headers_stops_early():
    import pyarrow as pa

    taken = []

    def batches():
        for i in range(1000):
            taken.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(["p"]), pa.array([0]), pa.array(['a,"b' if i == 0 else 'c"' if i == 1 else "1,2"])], names=["path", "start", "value"])

    assert [b.to_pylist() for b in readers._first_records(True)(batches())] == [[{"path": "p", "header": 'a,"b\nc"'}]]
    assert len(taken) == 2
    assert [b.to_pylist() for b in readers._first_records(False)(batches())] == [[{"path": "p", "header": 'a,"b\nc"'}]]


def test_bid_lines_join_their_tables_once(spark, sf_dir):
    """Whatever a query does with bid lines, it finds line items and orders joined."""
    from bidlake.plans.bid_lines import bid_lines

    rows = bid_lines(spark, sf_dir)
    assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_csv_set_is_written_by_all_tasks(spark, sf_dir, monkeypatch):
    """A CSV file is one split, so no file may hold a whole table."""
    from bidlake.plans import queries_tables

    plans, write = [], queries_tables.writers.write_csv
    monkeypatch.setattr(queries_tables.writers, "write_csv", lambda df, path: (plans.append(df._jdf.queryExecution().logical().toString()), write(df, path)))
    queries_tables.read_csv_set(spark, sf_dir)
    assert len(plans) == 2 and not any("Repartition" in p for p in plans)
