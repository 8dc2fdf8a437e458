"""Golden vectors and properties of the operators."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellstride.functions import timefeat
from cellstride.operators import clean, examples, lags, metrics, profile, project, scale
from cellstride.operators.forecast import ForecastConfig, fit_forecaster
from cellstride.plans import jobs
from cellstride.plans.layout import plan_layout
from cellstride.series import SeriesSpec, duplicate_instants, nan_to_null, require_unique_instants
from helpers import EPOCH, rows_of, series_table

X = [1.0, 2.0, 3.0, 4.0, 10.0]


def at(seconds):
    return EPOCH + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def column(spark):
    return spark.createDataFrame([("a", at(i), v, 7.0) for i, v in enumerate(X)],
                                 "District string, time timestamp_ntz, x double, flat double")


@pytest.fixture(scope="module")
def five(spark):
    cells = [(0, 1.0), (120, 2.0), (360, 4.0), (480, None), (600, 6.0)]
    return spark.createDataFrame([("a", at(s), v) for s, v in cells],
                                 "District string, time timestamp_ntz, v double")


@pytest.mark.parametrize("kind, expected", [
    ("StandardScaler", [-0.948683, -0.632456, -0.316228, 0, 1.897367]),
    ("MinMaxScaler", [0, 0.111111, 0.222222, 0.333333, 1]),
    ("RobustScaler", [-1, -0.5, 0, 0.5, 3.5]),
    ("MaxAbsScaler", [0.1, 0.2, 0.3, 0.4, 1]),
])
def test_scalers(column, kind, expected):
    fitted = scale.fit_scaler(column, kind)
    rows = fitted.apply(column).orderBy("time").collect()
    np.testing.assert_allclose([r["x"] for r in rows], expected, atol=1e-6)
    if kind in ("StandardScaler", "MinMaxScaler"):
        assert {r["flat"] for r in rows} == {0.0}
    back = fitted.invert(fitted.apply(column)).orderBy("time").collect()
    np.testing.assert_allclose([r["x"] for r in back], X)
    assert {r["feature"] for r in fitted.table().collect()} == {"x", "flat"}


def test_unknown_scaler(column):
    with pytest.raises(ValueError):
        scale.scale_frame(column, "QuantileTransformer")
    train, val, fitted = scale.scale_train_val(column, column, "quantile")
    assert fitted is None and train is column and val is column


def test_scaled_train_is_standard_and_val_uses_train_parameters(spark):
    df = series_table(spark, missing=0.0)
    train, val = lags.split_train_val(df, 0.7)
    strain, sval, fitted = scale.scale_train_val(train, val, "standard", per_series=True)
    moments = strain.where("District = 'north'").agg(F.avg("down"), F.stddev_pop("down")).first()
    np.testing.assert_allclose(tuple(moments), (0, 1), atol=1e-9)
    by_key = {r["District"]: r for r in fitted.table().where("feature = 'down'").collect()}
    raw = {(r["District"], r["time"]): r["down"] for r in val.collect()}
    for r in sval.collect():
        p = by_key[r["District"]]
        assert r["down"] == pytest.approx((raw[r["District"], r["time"]] - p["center"]) / p["scale"])


def test_caps(column):
    got = [r["x"] for r in clean.cap(column, ["x"]).orderBy("time").collect()]
    np.testing.assert_allclose(got, [1.4, 2, 3, 4, 7.6])


def test_missing_cells_stay_missing_when_capped(five):
    got = [r["v"] for r in clean.cap(five, ["v"], 10, 90).orderBy("time").collect()]
    assert got[3] is None and got[0] == pytest.approx(1.3)


def test_cap_by_series_needs_known_series(column):
    with pytest.raises(ValueError):
        clean.cap_by_series(column, ["x"], {"b": (10, 90)})
    same = clean.cap_by_series(column, ["x"], {"a": (10, 90)}, exclude=["a"])
    assert rows_of(same) == rows_of(column)


def test_statistics(column):
    row = profile.statistics(column.select("x")).first()
    got = [row[c] for c in ("mean", "stdev", "median", "mode", "min", "max", "gmean", "variance", "skewness", "kurtosis")]
    np.testing.assert_allclose(got, [4, 3.535534, 3, 1, 1, 10, 2.992556, 12.5, 1.697056, 3.152], atol=1e-6)


@pytest.mark.parametrize("values, expected", [([0.0, 2.0], 0.0), ([-1.0, 2.0], None)])
def test_geometric_mean_guards(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert profile.statistics(df).first()["gmean"] == expected


def test_row_lags(five):
    got = lags.row_lags(five, 1, keep="both").orderBy("time").collect()
    assert [(r["v"], r["v_lag_1"]) for r in got] == [(2, 1), (4, 2), (None, 4), (6, 0)]


def test_time_lags_and_sampling(five):
    got = lags.time_lags(five, 1).orderBy("time").collect()
    assert [r["v_lag_1"] for r in got] == [1, None, 4, None]
    row = lags.sampling_report(five).first()
    assert (row["period_us"], row["n_match"], row["n_rows"], row["pct"], row["verdict"]) == (
        120_000_000, 3, 5, 60.0, "highly irregular")


@pytest.mark.parametrize("matching, verdict", [(73, "highly irregular"), (80, "irregular"), (95, "regular")])
def test_sampling_verdicts(spark, matching, verdict):
    steps = [120] * matching + [121 + i for i in range(99 - matching)]
    times = np.concatenate([[0], np.cumsum(steps)])
    df = spark.createDataFrame([("a", at(int(t))) for t in times], "District string, time timestamp_ntz")
    assert lags.sampling_report(df).first()["verdict"] == verdict


def test_jitter_within_tolerance_counts(spark):
    times = [0, 120_000_000, 240_010_000, 360_010_000, 480_030_001]
    df = spark.createDataFrame([("a", t) for t in times], "District string, time long")
    assert lags.sampling_report(df).first()["n_match"] == 3


def test_single_row_series_has_no_period(spark):
    df = spark.createDataFrame([("a", at(0), 1.0)], "District string, time timestamp_ntz, v double")
    assert lags.sampling_report(df).first()["verdict"] == "too few rows"
    assert lags.time_lags(df, 1).count() == 0


def test_series_with_their_own_periods(spark):
    rows = [("a", at(60 * i), float(i)) for i in range(5)] + [("b", at(300 * i), float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "District string, time timestamp_ntz, v double")
    got = lags.time_lags(df, 1).collect()
    assert len(got) == 8 and all(r["v_lag_1"] == r["v"] - 1 for r in got)


def test_duplicate_instants(spark, five):
    require_unique_instants(five)
    twice = five.unionByName(five.limit(1))
    assert duplicate_instants(twice).count() == 1
    with pytest.raises(ValueError):
        require_unique_instants(twice)
    with pytest.raises(Exception, match="duplicate rows"):
        lags.time_lags(twice, 1, period_us=120_000_000).collect()
    with pytest.raises(Exception, match="duplicate rows"):
        lags.time_lags(twice, 1, period_us=120_000_000, method="join").collect()


def test_ties_follow_the_given_columns(spark):
    rows = [("a", at(60 * (i // 3)), i, float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "District string, time timestamp_ntz, seq int, v double").repartition(5)
    spec = SeriesSpec(ties=("seq",))
    for per_slot in (None, 4):
        lay = plan_layout(df, spec, per_slot)
        got = lags.row_lags(df, 1, ["v"], "both", spec, lay).collect()
        assert len(got) == 29 and all(r["v_lag_1"] == r["v"] - 1 for r in got)


def test_regular_series_row_and_time_lags_agree(spark):
    df = series_table(spark, {"a": 100, "b": 50}, missing=0.0, gaps=0.0)
    by_row = lags.row_lags(df, 3, keep="both")
    by_time = lags.time_lags(df, 3).select(by_row.columns)
    assert rows_of(by_row) == rows_of(by_time)


def test_split_sizes_and_order(spark):
    df = series_table(spark)
    train, val = lags.split_train_val(df, 0.8)
    sizes = {r["District"]: r["n_train"] for r in lags.split_report(lags.mark_split(df)).collect()}
    assert sizes == {"north": 320, "east": 48, "south": 6, "west": 1, None: 375}
    last = train.groupBy("District").agg(F.max("time").alias("t"))
    assert val.join(last, "District").where("time <= t").count() == 0


def test_split_of_one_series(spark):
    df = series_table(spark, {"a": 11}).drop("District")
    marked = lags.mark_split(df, 0.5, SeriesSpec(key=None))
    assert marked.where("is_train").count() == 6


def test_lag_order_is_oldest_first_features_reversed():
    assert lags.lag_columns(["a", "b"], 2) == ["b_lag_2", "a_lag_2", "b_lag_1", "a_lag_1"]


def test_target_history_follows_the_three_index_cases(spark):
    """The history of an item: zero padding first, then the previous item's window, then targets."""
    n, n_lags = 12, 3
    df = spark.createDataFrame([("a", at(120 * i), float(i + 1)) for i in range(n)],
                               "District string, time timestamp_ntz, v double")
    got = examples.examples(df, ["v"], n_lags).orderBy("time").collect()
    y = np.arange(1.0, n + 1)
    x = [[y[t - n_lags + i] for i in range(n_lags)] for t in range(n_lags, n)]
    kept = y[n_lags:]
    for i, row in enumerate(got):
        assert [v[0] for v in row["x"]] == x[i] and row["y"] == [kept[i]]
        if i == 0:
            expected = [0.0, *x[0][:-1]]
        elif i <= n_lags:
            expected = x[i - 1]
        else:
            expected = list(kept[i - n_lags - 1:i - 1])
        assert [v[0] for v in row["y_hist"]] == expected
    assert len(got[0]["exog"]) == 4


def test_lag_statistics_golden(spark):
    values = X + [0.0]
    df = spark.createDataFrame([("a", at(i), v) for i, v in enumerate(values)],
                               "District string, time timestamp_ntz, v double")
    row = examples.lag_statistics(df, ["v"], 5).first()
    got = [row[f"{s}_v"] for s in ("mean", "median", "std", "variance", "kurtosis", "skew", "gmean")]
    np.testing.assert_allclose(got, [4, 3, 3.535534, 12.5, 3.152, 1.697056, 2.992556], atol=1e-6)
    assert examples.lag_statistics(df, ["v"], 5, None) is None
    flat = df.withColumn("v", F.lit(2.0))
    row = examples.lag_statistics(flat, ["v"], 5).first()
    assert (row["skew_v"], row["kurtosis_v"], row["std_v"]) == (0, 0, 0)


def test_time_features_golden(spark):
    df = spark.createDataFrame([("a", dt.datetime(2018, 3, 28, 15, 56), 1.0)],
                               "District string, time timestamp_ntz, v double")
    row = timefeat.with_time_features(df).first()
    got = [row[f"{f}_{p}"] for p in ("minute", "dayofweek", "dayofyear") for f in ("sin", "cos")]
    np.testing.assert_allclose(got, [-0.857167, -0.515038, 0.974928, -0.222521, 0.99725, 0.074117], atol=1e-6)
    row = timefeat.exogenous_time(df).first()
    assert "v" not in row.asDict()
    np.testing.assert_allclose([row["sin_hour"], row["cos_hour"], row["sin_minute"], row["cos_minute"]],
                               [-0.707107, -0.707107, -0.406737, 0.913545], atol=1e-6)
    month = timefeat.to_cyclical(df.select(F.lit(1).alias("month"))).first()
    assert (month["sin_month"], month["cos_month"]) == (0.0, 1.0)


def test_metrics_golden(spark):
    y, p = [(1, 10), (2, 20), (3, 30)], [(1, 12), (2, 18), (4, 30)]
    df = spark.createDataFrame([("a", at(i), list(map(float, a)), list(map(float, b))) for i, (a, b) in enumerate(zip(y, p))],
                               "District string, time timestamp_ntz, y_true array<double>, y_pred array<double>")
    long = metrics.long_predictions(df)
    overall = metrics.metrics_overall(long).first()
    np.testing.assert_allclose([overall[m] for m in ("mse", "mae", "r2", "nrmse", "rmse")],
                               [1.5, 0.833333, 0.73, 0.185162, 1.224745], atol=1e-6)
    d0, d1 = metrics.metrics_by_dim(long).orderBy("dim").collect()
    np.testing.assert_allclose([d0["mse"], d0["mae"], d0["r2"], d0["nrmse"], d0["rmse"]],
                               [0.333333, 0.333333, 0.5, 0.288675, 0.57735], atol=1e-6)
    np.testing.assert_allclose([d1["mse"], d1["r2"], d1["nrmse"]], [2.666667, 0.96, 0.08165], atol=1e-6)
    assert metrics.metrics_overall(long, dims=[1]).first()["nrmse"] == pytest.approx(0.08165, abs=1e-6)


@pytest.mark.parametrize("pred, r2", [(5.0, 1.0), (6.0, 0.0)])
def test_r2_of_constant_truth(spark, pred, r2):
    df = spark.createDataFrame([("a", i, 0, 5.0, pred) for i in range(3)],
                               "District string, time int, dim int, y_true double, y_pred double")
    assert metrics.metrics_by_dim(df).first()["r2"] == r2


def test_nrmse_skips_zero_means(spark):
    df = spark.createDataFrame([("a", i, 0, v, 0.0) for i, v in enumerate((-1.0, 1.0))],
                               "District string, time int, dim int, y_true double, y_pred double")
    assert metrics.metrics_by_dim(df).first()["nrmse"] is None
    assert metrics.metrics_overall(df).first()["nrmse"] == 0.0


def test_autocorrelation_solves_yule_walker(spark):
    df = series_table(spark, {"a": 300}, missing=0.0)
    rows = profile.partial_autocorrelation(df, 6, ["down"]).orderBy("lag").collect()
    x = np.array([r["down"] for r in df.orderBy("time").collect()])
    z = x - x.mean()
    acf = [float(z[k:] @ z[:len(z) - k] / (z @ z)) for k in range(7)]
    np.testing.assert_allclose([r["acf"] for r in rows], acf, atol=1e-12)
    for k in range(1, 7):
        toeplitz = np.array([[acf[abs(i - j)] for j in range(k)] for i in range(k)])
        assert rows[k]["pacf"] == pytest.approx(np.linalg.solve(toeplitz, acf[1:k + 1])[-1], abs=1e-10)
    assert rows[1]["pacf"] == pytest.approx(rows[1]["acf"]) and rows[0]["band"] == pytest.approx(1.96 / 300 ** 0.5)


def test_missing_runs_and_quality(spark):
    cells = [None, 1.0, None, None, 2.0, None]
    df = spark.createDataFrame([("a", at(120 * i), v) for i, v in enumerate(cells)],
                               "District string, time timestamp_ntz, v double")
    runs = clean.missing_runs(df).orderBy("run_start").collect()
    assert [(r["run_start"], r["n_rows"]) for r in runs] == [(at(0), 1), (at(240), 2), (at(600), 1)]
    row = profile.quality_report(df).first()
    assert (row["rows_with_missing"], row["missing_cells"]) == (4, 4)
    assert row["pct_cells_missing"] == pytest.approx(4 / 18 * 100)
    filled = [r["v"] for r in clean.fill_by_time(df).orderBy("time").collect()]
    np.testing.assert_allclose(filled, [1, 1, 4 / 3, 5 / 3, 2, 2])


def test_cleaning_rules(spark):
    rows = [("a", at(i), *c) for i, c in enumerate([(1.0, 2.0, None, 3.0), (None, None, None, 1.0), (3.0, 4.0, None, 5.0),
                                                    (float("nan"), 6.0, None, 1.0)])]
    df = nan_to_null(spark.createDataFrame(
        rows, "District string, time timestamp_ntz, down double, up double, mcs_up double, rnti_count double"))
    got = clean.clean_missing(df).orderBy("time")
    assert got.columns == ["District", "time", "down", "up", "rnti_count"]
    assert [r["down"] for r in got.collect()] == [1.0, 3.0]
    assert clean.clean_missing(df, no_drop=True).count() == 4
    assert [r["down"] for r in clean.clean_missing(df, 0.5).orderBy("time").collect()] == [1.0, 3.0, 2.0]
    kept, report = clean.load_rule(df, ["down", "up"])
    assert kept.count() == 2 and report.first()["n_dropped"] == 2


def test_cap_all_cells(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(50, 2))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(data)], "time int, a double, b double")
    got = clean.cap_all_cells(df, ["a", "b"]).orderBy("time").collect()
    np.testing.assert_allclose([[r["a"], r["b"]] for r in got], np.clip(data, *np.percentile(data, [10, 90])))


def test_projections(spark):
    df = series_table(spark)
    xy = project.split_xy(df, ["down"], ignore=["up", "District"])
    assert xy.schema["X"].dataType.fieldNames() == ["down", "rnti_count"]
    assert xy.columns == ["District", "time", "X", "y"]
    assert "District" not in project.drop_key(df).columns
    with pytest.raises(KeyError):
        project.drop_key(project.drop_key(df))
    assert dict(project.cast_features(df, "float").dtypes)["down"] == "float"
    project.require_same_keys(df, df)
    with pytest.raises(ValueError):
        project.require_same_keys(df, df.where("District <> 'west'"))
    with pytest.raises(ValueError):
        project.exogenous_by_series(df, df.where("District <> 'west'"))


def test_permuted_positions(spark):
    """No two positions meet, near ones come apart, and seeds differ."""
    df = spark.range(5000).select("id", *[lags.permuted(F.col("id") + start, seed).alias(f"p{k}") for k, (start, seed) in enumerate(
        [(0, 1), (0, 2), ((1 << 48) - 5000, 1)])])
    rows = df.orderBy("id").collect()
    for k in range(3):
        values = [r[f"p{k}"] for r in rows]
        assert len(set(values)) == 5000 and 0 <= min(values) and max(values) < 1 << 48
        up = sum(a < b for a, b in zip(values, values[1:]))
        assert 2300 < up < 2700
    assert sum(r.p0 == r.p1 for r in rows) < 5


def test_batches(spark):
    df = series_table(spark, {"a": 10, "b": 3})
    sizes = lags.batch_ids(df, 4).groupBy("District", "batch_id").count().collect()
    assert {(r[0], r[1]): r[2] for r in sizes} == {("a", 0): 4, ("a", 1): 4, ("a", 2): 2, ("b", 0): 3}
    one, two = (rows_of(lags.batch_ids(df, 4, shuffle_seed=s)) for s in (1, 1))
    assert one == two != rows_of(lags.batch_ids(df, 4, shuffle_seed=2))


def test_prepare_keeps_series_apart(spark):
    df = series_table(spark, {"a": 40, "b": 40}, missing=0.0, gaps=0.0)
    out = jobs.prepare(df, n_lags=5)
    assert out.count() == 70
    assert len(out.columns) == 2 + 3 + 15 + 6
    first = out.where("District = 'b'").orderBy("time").first()
    scaled = scale.scale_frame(df).where("District = 'b'").orderBy("time").collect()
    assert first["down_lag_5"] == pytest.approx(scaled[0]["down"])


def test_split_and_skip_go_by_position(spark):
    rows = [("a", EPOCH + dt.timedelta(hours=i // 3), i, float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "District string, time timestamp_ntz, id int, down double").repartition(3)
    spec = SeriesSpec(ties=("id",))
    for layout in (None, plan_layout(df, spec, 4)):
        assert sorted(r["id"] for r in lags.skip_rows(df, 2, spec, layout).collect()) == list(range(2, 12))
        assert sorted(r["id"] for r in lags.mark_split(df, 0.34, spec, layout).where("is_train").collect()) == list(range(5))
    with pytest.raises(Exception, match="name ties"):
        lags.skip_rows(df, 2).collect()


def test_held_out_rows_are_scored(spark):
    df = series_table(spark, {"a": 100, "b": 50}, missing=0.0)
    config = ForecastConfig(targets=("down",), features=("down",), exogenous=("up",), n_lags=2)
    model = fit_forecaster(df, config)
    assert model.score(df).count() == 98 + 48
    assert model.score_held_out(df).count() == (98 - 79) + (48 - 39)


def test_caps_of_many_series(spark):
    n = 5000
    df = spark.createDataFrame([(f"s{i}", EPOCH + dt.timedelta(hours=k), float(k)) for i in range(n) for k in range(3)],
                               "District string, time timestamp_ntz, down double")
    got = clean.cap_by_series(df, ["down"], {f"s{i}": (0, 50 if i % 2 else 100) for i in range(n)})
    assert got.groupBy().sum("down").first()[0] == (n // 2) * 3 + (n // 2) * 2
