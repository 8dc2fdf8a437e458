"""Results do not depend on how long series are cut, nor on how parameters are joined."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cellstride.operators import clean, examples, forecast, lags, profile, scale
from cellstride.plans import layout as layouts, params
from cellstride.plans.layout import plan_layout, row_index
from cellstride.plans.ranks import percentiles
from cellstride.series import SeriesSpec
from helpers import EPOCH, rows_of, series_table

WHOLE = SeriesSpec(key=None)

OPERATORS = {
    "row_lags": lambda df, lay, spec: lags.row_lags(df, 4, keep="both", spec=spec, layout=lay),
    "time_lags": lambda df, lay, spec: lags.time_lags(df, 3, period_us=120_000_000, spec=spec, layout=lay),
    "time_lags_join": lambda df, lay, spec: lags.time_lags(df, 2, 2, spec=spec, layout=lay, method="join"),
    "differences": lambda df, lay, spec: lags.time_differences(df, spec, lay),
    "sampling": lambda df, lay, spec: lags.sampling_report(df, spec, lay),
    "split": lambda df, lay, spec: lags.mark_split(df, 0.7, spec, lay),
    "skip": lambda df, lay, spec: lags.skip_rows(df, 5, spec, lay),
    "index": lambda df, lay, spec: row_index(df, lay),
    "batches": lambda df, lay, spec: lags.batch_ids(df, 16, spec=spec, layout=lay),
    "fill": lambda df, lay, spec: clean.fill_by_time(df, spec=spec, layout=lay),
    "runs": lambda df, lay, spec: clean.missing_runs(df, spec=spec, layout=lay),
    "examples": lambda df, lay, spec: examples.examples(df, ["down", "up"], 3, spec=spec, layout=lay),
    "lag_stats": lambda df, lay, spec: examples.lag_statistics(df, ["down"], 5, spec=spec, layout=lay),
    "acf": lambda df, lay, spec: profile.autocorrelation(df, 4, spec=spec, layout=lay),
    "naive": lambda df, lay, spec: forecast.naive_forecast(df, ["down", "up"], spec, lay),
}


@pytest.fixture(scope="module")
def keyed(spark):
    return series_table(spark).cache()


@pytest.fixture(scope="module")
def single(spark):
    return series_table(spark, {"only": 300}, seed=5).drop("District").cache()


def drop_listwise(df, name):
    return df.na.drop("any") if name == "acf" else df


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("per_slot", [3, 40])
def test_cut_series_give_the_same_rows(keyed, name, per_slot):
    run = OPERATORS[name]
    cut = plan_layout(keyed, rows_per_slot=per_slot)
    assert cut.sliced
    df = drop_listwise(keyed, name)
    assert rows_of(run(df, cut, SeriesSpec())) == rows_of(run(df, plan_layout(df), SeriesSpec()))


@pytest.mark.parametrize("name", OPERATORS)
def test_cut_whole_frame_gives_the_same_rows(single, name):
    run = OPERATORS[name]
    cut = plan_layout(single, WHOLE, rows_per_slot=11)
    assert cut.sliced
    df = drop_listwise(single, name)
    assert rows_of(run(df, cut, WHOLE)) == rows_of(run(df, plan_layout(df, WHOLE), WHOLE))


def test_look_back_over_several_slots(keyed, monkeypatch):
    """Slots of fewer rows than the look-back, with slot ends that are broadcast and that are not."""
    cut, whole = plan_layout(keyed, rows_per_slot=2), rows_of(lags.row_lags(keyed, 7))
    assert rows_of(lags.row_lags(keyed, 7, layout=cut)) == whole
    monkeypatch.setattr(params, "MAX_BYTES", 64)
    assert rows_of(lags.row_lags(keyed, 7, layout=cut)) == whole


def test_crowded_slots_are_narrowed(spark):
    burst = [("a", i) for i in range(500)] + [("a", 10**12 + i * 10**9) for i in range(500)]
    df = spark.createDataFrame(burst, "District string, time long").withColumn("down", F.col("time") * 1.0)
    cut = plan_layout(df, rows_per_slot=50)
    assert cut.slots(df).agg(F.max("n")).first()[0] <= 200
    assert rows_of(lags.row_lags(df, 3, layout=cut)) == rows_of(lags.row_lags(df, 3))
    whole = SeriesSpec(key=None)
    cut = plan_layout(df.drop("District"), whole, 50)
    assert cut.slots(df.drop("District")).agg(F.max("n")).first()[0] <= 200


def test_large_parameter_tables_join_the_same(keyed, spark, monkeypatch):
    def results():
        return [rows_of(lags.mark_split(keyed, 0.6)), rows_of(lags.sampling_report(keyed)),
                rows_of(scale.fit_scaler(keyed, "robust", key="District").apply(keyed)),
                rows_of(clean.cap_by_series(keyed, ["down", "up"])),
                rows_of(lags.time_lags(keyed, 2)),
                rows_of(percentiles(keyed, ["down"], [0.1, 0.5], "District")),
                rows_of(lags.row_lags(keyed, 2, layout=plan_layout(keyed, rows_per_slot=20)))]
    expected = results()
    monkeypatch.setattr(params, "MAX_BYTES", 1)
    monkeypatch.setattr(params, "SALTS", 3)
    assert results() == expected


def test_uncut_when_series_are_short(keyed):
    assert not plan_layout(keyed).sliced
    assert plan_layout(keyed).parts == ["District"]


def test_row_count_default_is_bounded():
    assert layouts.ROWS_PER_SLOT <= 1_000_000


def test_a_bursty_series_stays_in_bounds(spark):
    """A third of all rows in two bursts with a long, thin stretch between them: many slots of a few rows."""
    burst = [(0, i) for i in range(300)] + [(0, 10_000_000 + i * 50_000) for i in range(40)] + [(0, 90_000_000 + i) for i in range(300)]
    rows = [(f"s{k}", t, float((k * 7 + t * 13) % 101)) for k, t in burst + [(1 + i % 20, i) for i in range(1280)]]
    spec = SeriesSpec(time="t", key="key")
    df = spark.createDataFrame(rows, "key string, t bigint, v double").repartition(5)
    cut = plan_layout(df, spec, 60)
    assert cut.sliced
    sizes = cut.place(df).groupBy(*cut.parts).count()
    assert sizes.agg(F.max("count")).first()[0] <= 4 * 60
    assert sizes.where("key = 's0' and count < 8").count() >= 4
    for run in (lambda lay: lags.row_lags(df, 8, spec=spec, layout=lay), lambda lay: lags.time_differences(df, spec, lay),
                lambda lay: profile.autocorrelation(df, 5, spec=spec, layout=lay)):
        assert rows_of(run(cut)) == rows_of(run(None))


def test_all_lags_in_one_shuffle(spark):
    """Five lags of series that differ in their periods: the rows are shuffled once."""
    rows = [(k, EPOCH + dt.timedelta(seconds=step * i), float(i)) for k, step in (("a", 60), ("b", 90)) for i in range(50)]
    df = spark.createDataFrame(rows, "District string, time timestamp_ntz, down double")
    layout = layouts.plan_layout(df)
    periods = params.settle(lags.modal_periods(df).withColumnRenamed("period_us", "__period"))
    lagged = lags._lags_by_join(df, layout, [1, 2, 3, 4, 5], ["down"], None, periods)
    plan = lagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    for r in lagged.collect():
        step = 60 if r.District == "a" else 90
        at = (r.time - EPOCH).total_seconds() / step
        assert [r[f"down_lag_{n}"] for n in range(1, 6)] == [at - n if at >= n else None for n in range(1, 6)]
