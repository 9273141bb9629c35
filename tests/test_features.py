"""Order statistics, splits, imputation, encoders and models."""

import datetime as dt
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import encode, explore, features, store, train
from marquee.operators.impute import ChainedImputer
from marquee.operators.ranking import exact_quantiles, smallest_by_hash, value_profile, with_dense_index
from marquee.session import scratch_path


@pytest.fixture(scope="module")
def skewed(spark):
    """One value fills a third of the rows."""
    return spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.sqrt(F.col("id").cast("double"))).alias("x"),
        F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).when(F.col("id") % 7 != 0, F.col("id") * 1.5).alias("y"))


def test_dense_index_is_gap_free_and_ordered(spark, skewed):
    rows = with_dense_index(skewed, [F.col("x").desc(), F.col("id")], "rn", 1).collect()
    want = sorted(((r["x"], r["id"]) for r in rows), key=lambda p: (-p[0], p[1]))
    assert [(r["x"], r["id"]) for r in sorted(rows, key=lambda r: r["rn"])] == want
    assert sorted(r["rn"] for r in rows) == list(range(1, 3001))


@pytest.mark.parametrize("exact_below", [0, 100_000])
@pytest.mark.parametrize("probs", [[0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0], [0.5]])
def test_profile_matches_numpy(spark, skewed, probs, exact_below):
    """With and without brackets; at this size a rank may also miss its bracket and start over."""
    got = {r["feature"]: r for r in value_profile(skewed, ["x", "y"], probs, exact_below).collect()}
    for name in ("x", "y"):
        values = np.array([r[0] for r in skewed.select(name).collect() if r[0] is not None and not np.isnan(r[0])])
        assert got[name]["count"] == len(values)
        assert np.allclose(got[name]["quantiles"], np.quantile(values, probs))
        assert np.isclose(got[name]["mean"], values.mean()) and np.isclose(got[name]["std"], values.std(ddof=1))


def test_profile_of_many_values(spark):
    """Large enough for the brackets to hold: few single values are counted, the quantiles stay exact."""
    rows = spark.range(150_000).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1000).alias("x"),
        (-F.col("id") * 0.25).alias("y"))
    got = {r["feature"]: r for r in value_profile(rows, ["x", "y"], [0.0, 0.25, 0.5, 0.75, 1.0]).collect()}
    for name in ("x", "y"):
        values = np.array([r[0] for r in rows.select(name).collect()])
        assert np.allclose(got[name]["quantiles"], np.quantile(values, [0, 0.25, 0.5, 0.75, 1]), rtol=1e-12)


def test_median_of_even_and_single(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (2.0, None), (10.0, None), (4.0, None)], "a double, b double")
    got = {r["feature"]: r["quantiles"][0] for r in exact_quantiles(rows, ["a", "b"], [0.5]).collect()}
    assert got == {"a": 3.0, "b": 5.0}


@pytest.mark.parametrize("share, size", [(0.15, 450), (0.2, 600), (0.0001, 1), (1.0, 3000), (0.0, 0)])
def test_split_has_the_exact_size(skewed, share, size):
    assert skewed.where(smallest_by_hash(skewed, ["id"], share, 42)).count() == size


def test_split_ignores_partitioning(skewed):
    a = train.train_test_split(skewed, ["id"], 0.15)[1]
    b = train.train_test_split(skewed.repartition(13).orderBy(F.desc("x")), ["id"], 0.15)[1]
    assert {r["id"] for r in a.collect()} == {r["id"] for r in b.collect()}
    fit_part, test_part = train.train_test_split(skewed, ["id"], 0.15)
    assert fit_part.count() + test_part.count() == 3000 and fit_part.join(test_part, "id", "left_semi").isEmpty()


def test_histogram_edges(spark):
    rows = spark.createDataFrame([(0.0, 5), (1.0, 5), (29.99, 5), (30.0, 5), (None, None)], "a double, b int")
    got = {(r["feature"], r["bin"]): r["n"] for r in explore.histogram(rows, ["a", "b"]).collect() if r["n"]}
    assert got == {("a", 0): 1, ("a", 1): 1, ("a", 29): 2, ("b", 15): 4}


def test_correlation_uses_pairwise_complete_rows(spark):
    data = [(1.0, 2.0, 1.0), (2.0, 4.1, None), (3.0, None, 2.0), (None, 9.0, 5.0), (4.0, 5.0, 5.0), (6.0, 1.0, 5.0)]
    rows = spark.createDataFrame(data, "a double, b double, c double").withColumn("k", F.lit(3.0))
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in explore.corr_matrix(rows, ["a", "b", "c", "k"]).collect()}
    for i, a in enumerate("abc"):
        for j, b in enumerate("abc"):
            pairs = [(r[i], r[j]) for r in data if r[i] is not None and r[j] is not None]
            assert np.isclose(got[a, b], np.corrcoef(np.array(pairs).T)[0, 1])
    assert got["a", "k"] is None and len(got) == 16


def test_top_labels_add_up(spark):
    rows = spark.createDataFrame([("a, b",), ("a",), ("c,a",), (None,), ("b",)], "l string")
    got = [(r["label"], r["n"]) for r in explore.top_labels(rows, {"l": 2}).orderBy(F.asc_nulls_last("pos")).collect()]
    assert got == [("a", 3), ("b", 2), ("Others", 1)]
    assert sum(n for _, n in got) == explore.melt_labels(rows, ["l"]).count()


def test_group_rare_labels(spark):
    fit = spark.createDataFrame([("US",), ("US, UK",), ("UK",), ("FR",)], "c string")
    rows = spark.createDataFrame([(0, "US, FR, DE, UK"), (1, "FR"), (2, ""), (3, None)], "i int, c string")
    got = features.RareLabelGrouper({"c": 2}).fit(fit).transform(rows).orderBy("i").collect()
    assert [r["c"] for r in got] == ["US,Others,UK", "Others", "Others", None]


def test_billing_roi_and_dates(spark):
    rows = spark.createDataFrame(
        [("A, B ,C", None, "w", 0, 5, dt.date(2024, 6, 7)), ("", "d1,d2", None, 4, 6, None)],
        "actors string, director string, writer string, budget int, revenue int, release_date date")
    first, second = features.date_features(features.roi(features.billing(rows))).collect()
    assert (first.first_billing_actor, first.second_billing_actor, first.third_billing_actor, first.forth_billing_actor) == ("A", "B", "C", None)
    assert first.main_director is None and (second.main_director, second.secondary_director) == ("d1", "d2")
    assert first.roi is None and second.roi == 0.5
    assert (first.release_year, first.is_weekend, first.is_holiday_season, first.movie_age) == (2024, 1, 1, 1)
    assert (second.release_year, second.is_weekend, second.is_holiday_season) == (None, 0, 0)


@pytest.fixture(scope="module")
def planted(spark):
    """c = 2a - b + 3 and d = a + 0.5c, with gaps."""
    rng = np.random.default_rng(5)
    a, b = rng.normal(100, 20, 400), rng.normal(-5, 3, 400)
    c = 2 * a - b + 3
    d = a + 0.5 * c
    truth = [(i, float(a[i]), float(b[i]), float(c[i]), float(d[i]), "x") for i in range(400)]
    holes = [(i, A, B, None if i % 4 == 0 else C, None if i % 6 == 1 else (float("nan") if i % 6 == 2 else D), t)
             for i, A, B, C, D, t in truth]
    schema = "id int, a double, b double, c double, d double, t string"
    return spark.createDataFrame(truth, schema), spark.createDataFrame(holes, schema)


def test_chained_imputer_recovers_planted_values(planted):
    truth, holes = planted
    filled = ChainedImputer(["a", "b", "c", "d"]).fit(holes).transform(holes)
    assert filled.columns == holes.columns
    both = filled.alias("f").join(truth.alias("t"), "id").select("f.c", "t.c", "f.d", "t.d", "f.t").collect()
    assert max(abs(r[0] - r[1]) for r in both) < 0.5 and max(abs(r[2] - r[3]) for r in both) < 0.5
    known = filled.join(holes.where("c is not null").select("id", F.col("c").alias("was")), "id").where("c <> was")
    assert known.isEmpty() and {r[4] for r in both} == {"x"}


def test_chained_imputer_paths_agree(planted):
    # Noise keeps the columns from being exactly collinear, where rounding alone moves the weights.
    noisy = {"c": F.col("c") + 5 * F.sin("id"), "d": F.col("d") + 5 * F.cos(F.col("id") * 7)}
    holes, columns = planted[1].withColumns(noisy), ["a", "b", "c", "d"]
    by_pattern = ChainedImputer(columns, rounds=3, tolerance=0).fit(holes).learned["history"]
    by_pass = ChainedImputer(columns, rounds=3, tolerance=0, max_patterns=0).fit(holes).learned["history"]
    assert len(by_pattern) == len(by_pass) == 3
    for one, other in zip(by_pattern, by_pass):
        for (t1, m1), (t2, m2) in zip(one, other):
            assert t1 == t2 and np.isclose(m1["intercept"], m2["intercept"])
            assert np.allclose([m1["weights"][k] for k in m2["weights"]], list(m2["weights"].values()))


def test_imputer_without_gaps_changes_nothing(planted):
    truth, _ = planted
    again = ChainedImputer(["a", "b"]).fit(truth).transform(truth)
    assert again.exceptAll(truth).isEmpty()


def test_constant_imputation(spark):
    rows = spark.createDataFrame([(None, None), ("R", float("nan")), ("G", 2.0)], "age_rating string, imdb_rating double")
    got = features.impute_constant(rows, ["age_rating"], ["imdb_rating"]).collect()
    assert [tuple(r) for r in got] == [("Unknown", 0.0), ("R", 0.0), ("G", 2.0)]


def test_encoders_on_unseen_and_missing(spark):
    fit = spark.createDataFrame([("R", "zed", 1.0, "A B,C"), ("PG", "amy", 3.0, None), (None, None, None, "C")],
                                "rating string, name string, v double, labels string")
    new = spark.createDataFrame([(0, "R", "amy", 2.0, "C,X"), (1, "X", "bob", None, None), (2, None, None, 5.0, " A B ")],
                                "i int, rating string, name string, v double, labels string")
    hot = encode.OneHotEncoder("rating").fit(fit).transform(new).orderBy("i").collect()
    assert [r.rating_code for r in hot] == [1, None, 2]
    flags = encode.one_hot_columns(new, "rating", ["PG", "R"]).orderBy("i").collect()
    assert [(r.rating_PG, r.rating_R, r.rating_None) for r in flags] == [(0, 1, 0), (0, 0, 0), (0, 0, 1)]
    codes = encode.OrdinalEncoder(["name"]).fit(fit).transform(new).orderBy("i").collect()
    assert [r.name for r in codes] == [0.0, 999999.0, None]
    scaled = encode.StandardScaler(["v"]).fit(fit).transform(new).orderBy("i").collect()
    assert [r.v for r in scaled] == [0.0, None, 3.0]
    step = encode.MultiLabelBinarizer("labels").fit(fit)
    assert [r.labels_codes for r in step.transform(new).orderBy("i").collect()] == [[1], [], [0]]
    flat = encode.multilabel_columns(new, "labels", ["A_B", "C"]).orderBy("i").collect()
    assert [(r.labels_A_B, r.labels_C) for r in flat] == [(0, 1), (0, 0), (1, 0)]


def test_label_codes_keep_their_form_with_many_labels(spark):
    many = spark.range(3000).select("id", F.concat(F.lit("l"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("labels"))
    out = encode.MultiLabelBinarizer("labels").fit(many).transform(many)
    assert out.columns == ["id", "labels_codes"] and out.where("labels_codes[0] <> id").isEmpty()


def test_constant_column_scales_to_zero(spark):
    rows = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert [r.v for r in encode.StandardScaler(["v"]).fit(rows).transform(rows).collect()] == [0.0, 0.0]


@pytest.fixture(scope="module")
def assembled(spark):
    rows = spark.range(300).select("id", F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    rows = rows.withColumn("revenue", 3 * F.col("a") - 2 * F.col("b") + 10)
    return train.assemble(rows, ["a", "b"]).cache()


def test_ridge_matches_the_normal_equations(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(120, 2)) * [1, 5] + [3, -2]
    y = x @ [2, -1] + 7 + rng.normal(size=120) * 4
    rows = spark.createDataFrame([(float(a), float(b), float(v)) for (a, b), v in zip(x, y)], "a double, b double, revenue double")
    model = train.Ridge(50.0).fit(train.assemble(rows, ["a", "b"]))
    centred = x - x.mean(0)
    want = np.linalg.solve(centred.T @ centred + 50 * np.eye(2), centred.T @ (y - y.mean()))
    assert np.allclose(model.coefficients.toArray(), want)


def test_metrics_match_their_definition(spark):
    data = [(1.0, 1.5), (2.0, 1.0), (4.0, 4.5), (7.0, 6.0)]
    got = train.regression_metrics(spark.createDataFrame(data, "revenue double, prediction double")).first()
    y, p = np.array(data).T
    assert np.isclose(got["r2"], 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert np.isclose(got["rmse"], np.sqrt(((y - p) ** 2).mean()))


def test_linear_model_cross_validates(assembled):
    scores = train.cv_evaluate(assembled, {"linear": train.regressors()["linear"]}, ["id"]).first()
    assert scores["r2"] > 0.999 and scores["rmse"] < 1.0


def test_grid_search_prefers_less_shrinkage(assembled):
    fit_part, test_part = train.train_test_split(assembled, ["id"], 0.2)
    model, report = train.grid_search(fit_part, test_part, train.regressors()["linear"], {"regParam": [0.001, 5000.0]}, ["id"])
    assert report["best_params"] == {"regParam": 0.001} and report["points"] == 2
    assert np.isclose(report["r2"], train.regression_metrics(model.transform(test_part)).first()["r2"])


def test_staged_grid_scores_are_those_of_separate_fits(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator

    # One partition: which rows are sampled follows from partition and place.
    rows = spark.range(0, 400, 1, 1).selectExpr("id", "CAST(id % 17 AS DOUBLE) AS a", "CAST(id % 29 AS DOUBLE) AS b", "CAST((id % 17) * (id % 29) + id % 3 AS DOUBLE) AS revenue")
    fit_part, test_part = train.train_test_split(train.assemble(rows, ["a", "b"]).cache(), ["id"], 0.2)
    grid = {"maxIter": [2, 5], "maxDepth": [2, 3], "stepSize": [0.1], "subsamplingRate": [0.8]}
    boosted = train.regressors()["gradient_boosting"]
    model, report = train.grid_search(fit_part, test_part, boosted, grid, ["id"], folds=3)
    points = train.param_grid(boosted, grid)
    search = CrossValidator(estimator=boosted, estimatorParamMaps=points, numFolds=3, foldCol="fold", evaluator=RegressionEvaluator(labelCol="revenue", metricName="r2"))
    want = search.fit(train.with_fold(fit_part, ["id"], 3))
    assert np.allclose([m for _, m in report["cv_scores"]], want.avgMetrics, rtol=1e-9)
    assert [p for p, _ in report["cv_scores"]] == [{k.name: v for k, v in p.items()} for p in points]
    assert model.getNumTrees == report["best_params"]["maxIter"] and model.toDebugString == want.bestModel.toDebugString.replace(want.bestModel.uid, model.uid)


def test_grid_search_query_searches_every_point_of_the_boosting_grid(spark, monkeypatch):
    from marquee.plans import modelling

    rows = spark.range(100).selectExpr("id AS movie_id", "CAST(id % 7 AS DOUBLE) AS a", "CAST(id % 7 AS DOUBLE) AS revenue")
    assembled = train.assemble(rows, ["a"]).cache()
    monkeypatch.setattr(modelling, "_split", lambda spark, sf: (assembled, assembled))
    asked = []

    def staged(part, estimator, grid, *rest):
        asked.append((type(estimator).__name__, grid))
        return [-float(i != 5) for i in range(len(train.param_grid(estimator, grid)))]

    monkeypatch.setattr(train, "staged_scores", staged)
    monkeypatch.setattr(train, "GBT_GRID", {**train.GBT_GRID, "maxIter": [1, 2, 3]})
    got = modelling.grid_search(spark, "").collect()
    assert asked == [("GBTRegressor", train.GBT_GRID)] and len(got) == 54
    assert [i for i, r in enumerate(got) if r.best] == [5]


def test_importances_and_store(spark, assembled):
    from pyspark.ml.regression import RandomForestRegressor

    forest = RandomForestRegressor(labelCol="revenue", numTrees=10, maxDepth=3, seed=1).fit(assembled)
    listed = train.feature_importance(spark, forest, ["a", "b"]).collect()
    assert np.isclose(sum(r["importance"] for r in listed), 1.0) and listed[0]["feature"] == "a"
    root, at = scratch_path(spark, "artifacts"), dt.datetime(2024, 1, 1)
    assert store.list_models(spark, root).isEmpty()
    store.save_model(spark, forest, "rf", root, at, {"test_run": True, "n_features": 2})
    store.save_model(spark, forest, "rf", root, at + dt.timedelta(days=1), {"test_run": True, "n_features": 2})
    loaded, metadata = store.load_model(spark, "rf", root, with_metadata=True)
    assert metadata == {"test_run": "true", "n_features": "2"}
    assert loaded.transform(assembled).limit(5).count() == 5
    info = store.model_info(spark, "rf", root).collect()
    assert len(info) == 1 and info[0]["model_class"].startswith("RandomForest") and info[0]["saved_at"].day == 2
    with pytest.raises(FileNotFoundError):
        store.load_model(spark, "none", root)


def test_value_counts_share_sums_to_one(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    got = explore.value_counts(rows, "v", share=True).collect()
    assert [(r.v, r.n) for r in got] == [("a", 2), ("b", 1)] and statistics.fsum(r.share for r in got) == 1.0


def test_fences_read_their_rows_once(spark, tmp_path):
    """The rows behind box plots are stored once, however often the values are read."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS v").mapInArrow(count, "v double")
    assert explore.outliers(rows, ["v"]).count() == 0
    assert seen.value == 1000
    assert explore.box_stats(rows, ["v"]).first()["outliers"] == 0
    assert seen.value == 2000
