from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandloom.plans.training import best_round
from demandloom.operators import encoding, evaluation, splits
from demandloom.operators.features import gold
from demandloom.schemas import MODEL_COLUMNS
from tests.test_features import random_rows, silver_frame

END = dt.date(2016, 4, 24)
BASE = dt.date(2011, 1, 29)


def test_window_and_bounds():
    assert splits.trailing_window(END, BASE) == (END - dt.timedelta(days=365), END)
    assert splits.trailing_window(dt.date(2011, 3, 1), BASE) == (BASE, dt.date(2011, 3, 1))
    start = END - dt.timedelta(days=365)
    assert splits.split_bounds(start, END) == (start + dt.timedelta(days=255), start + dt.timedelta(days=310))


def test_bounds_as_columns_equal_driver_bounds(spark):
    days = spark.range(400).select(F.date_add(F.lit(BASE), F.col("id").cast("int")).alias("run_date"))
    for row in splits.add_window_bounds(days, BASE).collect():
        start, end = splits.trailing_window(row["run_date"], BASE)
        assert (start, *splits.split_bounds(start, end)) == (row["window_start"], row["train_end"], row["val_end"])


def test_splits_are_disjoint_ordered_and_complete(spark):
    start = END - dt.timedelta(days=365)
    days = spark.range(-10, 380).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("run_date"))
    found = {
        r["split"]: (r["n"], r["low"], r["high"]) for r in splits.time_split(days, start, END).groupBy("split").agg(
            F.count("*").alias("n"), F.min("run_date").alias("low"), F.max("run_date").alias("high")).collect()
    }
    assert sum(n for n, _, _ in found.values()) == 366
    assert found["train"][2] < found["val"][1] <= found["val"][2] < found["test"][1]
    assert found["train"][1] == start and found["test"][2] == END


def test_narrowing_and_feature_list(spark):
    narrow = splits.narrow(gold(silver_frame(spark, random_rows(days=5))).select(*MODEL_COLUMNS))
    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema}
    assert kinds["sales"] == kinds["sell_price"] == kinds["sales_roll_std_7"] == "float"
    assert kinds["sales_lag_7"] == "int" and kinds["is_cold_start"] == "tinyint" and "weekday" not in kinds
    assert splits.feature_columns(narrow.columns) == splits.model_features() and len(splits.model_features()) == 31


def test_vocabulary_codes_are_dense_and_sorted(spark):
    """More values than one range holds, and one of them in a third of the rows."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))).alias("a"),
        F.when(F.col("id") % 2 == 0, "x").alias("b"), F.lit(None).cast("string").alias("c"),
    )
    found = encoding.fit_vocabulary(rows, ["a", "b", "c"]).collect()
    values = {c: {r["value"]: r["code"] for r in found if r["column"] == c} for c in "abc"}
    ordered = sorted({"hot"} | {f"v{i}" for i in range(3000) if i % 3})
    assert values == {"a": {v: i for i, v in enumerate(ordered)}, "b": {"x": 0}, "c": {}}


def test_unseen_and_null_take_the_unknown_code(spark):
    train = spark.createDataFrame([("b", "m"), ("a", None)], "x string, y string")
    vocabulary = encoding.fit_vocabulary(train, ["x", "y"])
    rows = spark.createDataFrame([(1, "a", "m"), (2, "b", None), (3, "z", "q"), (4, None, "m")], "n int, x string, y string")
    got = encoding.encode(rows, vocabulary, ["x", "y"])
    assert got.columns == ["n", "x", "y"]
    assert {tuple(r) for r in got.collect()} == {(1, 0, 0), (2, 1, 1), (3, 2, 1), (4, 2, 0)}


def test_slices_and_summary(spark):
    df = spark.createDataFrame(
        [(4.0, 5.0, 1.0, "s1", "d1"), (2.0, 2.0, 1.0, "s1", "d2"), (0.0, 3.0, 0.0, "s2", "d1")],
        "sales double, prediction double, baseline_prediction double, store_id string, dept_id string",
    )
    slices = evaluation.slice_metrics(df)
    found = {(r["slice"], r["value"]): r for r in slices.collect()}
    assert set(found) == {("store_id", "s1"), ("store_id", "s2"), ("dept_id", "d1"), ("dept_id", "d2")}
    s1 = found["store_id", "s1"]
    assert (s1["mae"], s1["bias"], s1["rows"]) == (0.5, -0.5, 2) and s1["wmape"] == pytest.approx(1 / 6)
    summary = {r["slice"]: r for r in evaluation.slice_summary(slices).collect()}
    assert summary["dept_id"]["worst_wmape"] == pytest.approx(1.0) and summary["dept_id"]["p90_wmape"] == pytest.approx(0.9)
    overall = evaluation.overall_metrics(df).first()
    assert overall["test_mae"] == pytest.approx(4 / 3) and overall["abs_error_improvement_pct"] == pytest.approx(0.0)


def test_baseline_and_selection(spark):
    lagged = spark.createDataFrame([(3, 2)], "sales int, sales_lag_7 int")
    assert evaluation.baseline_forecast(lagged).first()["baseline_prediction"] == 2.0
    plain = spark.createDataFrame([(3,), (6,)], "sales int")
    assert {r["baseline_prediction"] for r in evaluation.baseline_forecast(plain).collect()} == {4.5}
    scores = spark.createDataFrame([("first", 0, 0.5), ("second", 1, 0.5), ("third", 2, 0.7)], "model string, priority int, wmape double")
    assert evaluation.best_candidate(scores).first()["best_model"] == "second"


def test_patience_ends_boosting_at_the_lowest_error():
    assert best_round([5.0, 4.0, 4.5, 3.0, 3.5, 3.4, 3.3, 2.0], 3) == (4, True)
    assert best_round([5.0, 4.0, 4.5, 3.0], 3) == (4, False)
    assert best_round([1.0], 3) == (1, False)


def learner_rows(spark, count=300):
    from pyspark.ml.linalg import Vectors

    rows = [(float(i % 7) + (i * 37 % 11) / 10, Vectors.dense([float(i % 7), float(i * 13 % 5), float(i % 3)])) for i in range(count)]
    return spark.createDataFrame(rows, ["label", "features"])


def test_a_cut_model_is_the_model_of_fewer_rounds(spark):
    from pyspark.ml.regression import GBTRegressor

    from demandloom.plans.training import cut_model

    rows, params = learner_rows(spark), {"maxDepth": 3, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "seed": 5}
    whole = GBTRegressor(maxIter=9, **params).fit(rows)
    for rounds in (1, 4, 8):
        cut, fresh = cut_model(spark, whole, rounds), GBTRegressor(maxIter=rounds, **params).fit(rows)
        assert cut.getNumTrees == rounds and cut.treeWeights == fresh.treeWeights
        pairs = zip(cut.transform(rows).select("prediction").collect(), fresh.transform(rows).select("prediction").collect())
        assert max(abs(a[0] - b[0]) for a, b in pairs) < 1e-9


def test_no_fit_follows_the_stop(spark, monkeypatch):
    """Validation rows unlike the training rows: boosting ends early, and the rounds after the best are cut, not fitted."""
    from demandloom.plans import training

    fits = []

    class Counted(training.GBTRegressor):
        def fit(self, dataset, params=None):
            fits.append(self.getMaxIter())
            return super().fit(dataset, params)

    rows, params = learner_rows(spark), {"maxDepth": 3, "stepSize": 0.5}
    against = rows.withColumn("label", F.col("label") + F.sin(F.col("label") * 40) * 2)
    monkeypatch.setattr(training, "GBTRegressor", Counted)
    model = training.fit_with_patience(rows, against, 100, params, 5, patience=4)
    reached = [min(100, 5 * 2**k) for k in range(len(fits))]
    monkeypatch.undo()
    errors = training.GBTRegressor(maxIter=fits[-1], seed=5, **params).fit(rows).evaluateEachIteration(against, "squared")
    best, stopped = training.best_round(errors, 4)
    assert fits == reached and stopped and model.getNumTrees == best < fits[-1]


def test_content_hash_knows_the_rows_but_not_their_order(spark):
    rows = [(n, f"i{n % 5}", n / 4, dt.date(2020, 1, 1 + n % 3), None if n % 4 else True) for n in range(200)]
    ddl = "sales int, item string, price double, day date, flag boolean"
    told = lambda rows: tuple(splits.content_sums(spark.createDataFrame(rows, ddl).repartition(5)).first())
    whole = told(rows)
    assert whole[0] == 200 and told(rows[::-1]) == whole == told(rows[100:] + rows[:100])
    assert told(rows + rows[:1])[1] != whole[1] != told(rows[1:])[1]
    for changed in ((0, "i0", 0.0, dt.date(2020, 1, 1), None), (0, "i0", 0.0, dt.date(2020, 1, 2), True), (0, "", 0.0, dt.date(2020, 1, 1), True), (0, "i0", 0.0001, dt.date(2020, 1, 1), True)):
        assert told([changed, *rows[1:]])[1] != whole[1]
    swapped = [(rows[1][0], *rows[0][1:]), (rows[0][0], *rows[1][1:]), *rows[2:]]
    assert told(swapped)[1] != whole[1] and told([]) == (0, "0-0")
    days = splits.content_sums(spark.createDataFrame(rows, ddl), ["day"], ["flag"]).collect()
    assert sum(r["rows"] for r in days) == 200 and len({r["content_hash"] for r in days}) == 3


def test_places_follow_files_and_rows(spark, tmp_path):
    from demandloom.plans.dataset import read_places, write_splits

    rows = [(f"i{n % 9}", f"s{n % 4}", END - dt.timedelta(days=n % 50), n, "train" if n % 5 else "test") for n in range(900)]
    df = spark.createDataFrame(rows, "item_id string, store_id string, run_date date, sales int, split string").repartition(6)
    write_splits(df, str(tmp_path / "w"))
    for split in ("train", "test"):
        found = read_places(spark, str(tmp_path / "w")).where(F.col("split") == split).orderBy("place").collect()
        keys = [(r["item_id"], r["store_id"], r["run_date"]) for r in found]
        assert keys == sorted(keys) and [r["place"] for r in found] == list(range(1, len(keys) + 1))
