"""Reading, writing, streaming and model files."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from cellstride.operators import lags, scale
from cellstride.operators.forecast import ForecastConfig, fit_forecaster, load_forecaster
from cellstride.operators.metrics import long_predictions, metrics_overall
from cellstride.session import scratch_root
from cellstride.sources import tables
from cellstride.streaming import downsample as windows
from helpers import EPOCH, rows_of, series_table


def text(tmp_path, content, name="m.csv", encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(content.encode(encoding))
    return str(path)


GOOD = "time,District,down,up\n2018-03-28 15:56:00,north,1.5,2\n2018-03-28 15:58:00,south,,NaN\n"


def test_typed_scan(spark, tmp_path):
    df = tables.read_measurements_csv(spark, text(tmp_path, GOOD))
    assert dict(df.dtypes) == {"time": "timestamp_ntz", "District": "string", "down": "double", "up": "double"}
    rows = df.orderBy("time").collect()
    assert rows[0]["time"] == dt.datetime(2018, 3, 28, 15, 56) and rows[1]["down"] is None and rows[1]["up"] is None
    only = tables.read_measurements_csv(spark, text(tmp_path, GOOD), "north", "float", drop_key=True)
    assert dict(only.dtypes) == {"time": "timestamp_ntz", "down": "float", "up": "float"} and only.count() == 1


@pytest.mark.parametrize("content", ["", "District,down\na,1\n"])
def test_refused_files(spark, tmp_path, content):
    with pytest.raises(ValueError):
        tables.read_measurements_csv(spark, text(tmp_path, content))


def test_missing_path_and_filter_without_key(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.read_measurements_csv(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(ValueError):
        tables.read_measurements(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError):
        tables.read_measurements_csv(spark, text(tmp_path, "time,down\n2018-03-28 15:56:00,1\n"), "north")


def test_malformed_rows(spark, tmp_path):
    path = text(tmp_path, GOOD + "2018-03-28 16:00:00,north,many,2\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        tables.read_measurements_csv(spark, path).collect()
    df = tables.read_measurements_csv(spark, path, bad_rows="quarantine").cache()
    assert df.count() == 3
    assert [r["_corrupt_record"] for r in tables.quarantined(df).collect()] == ["2018-03-28 16:00:00,north,many,2"]


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_encoding_fallback(spark, tmp_path, encoding):
    path = text(tmp_path, GOOD.replace("south", "sür"), encoding=encoding)
    df = tables.read_measurements_csv(spark, path)
    assert {r["District"] for r in df.collect()} == {"north", "sür"}
    assert dict(df.dtypes)["time"] == "timestamp_ntz"


def test_timestamp_format(spark, tmp_path):
    path = text(tmp_path, "time,District,down\n28/03/2018 15:56,north,1\n")
    df = tables.read_measurements_csv(spark, path, timestamp_format="dd/MM/yyyy HH:mm")
    assert df.first()["time"] == dt.datetime(2018, 3, 28, 15, 56)


def test_csv_and_parquet_round_trips(spark, tmp_path):
    df = series_table(spark)
    tables.write_csv(df, str(tmp_path / "csv"))
    back = tables.read_measurements_csv(spark, str(tmp_path / "csv"))
    assert back.columns[0] == "time" and rows_of(back) == rows_of(df)
    tables.write_measurements(df, str(tmp_path / "pq"))
    assert sorted(os.listdir(tmp_path / "pq"))[-1] == "_SUCCESS"
    assert rows_of(tables.read_measurements(spark, str(tmp_path / "pq"))) == rows_of(df)
    one = tables.read_measurements(spark, str(tmp_path / "pq"), "east")
    assert one.count() == 60
    assert "PartitionFilters: [isnotnull(District" in one._jdf.queryExecution().toString()


def test_manifest(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    text(tmp_path / "a" / "b", "12345", "x.CSV")
    text(tmp_path / "a", "1", "noextension")
    got = {r["object_name"]: (r["size_bytes"], r["media_type"]) for r in tables.object_manifest(spark, str(tmp_path)).collect()}
    assert got == {"a/b/x.CSV": (5, "text/csv"), "a/noextension": (1, "application/octet-stream")}
    assert {r["status"] for r in tables.receipt(spark, str(tmp_path), "bucket").collect()} == {"success"}


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_downsample_means_and_variance(spark):
    rows = [("a", EPOCH + dt.timedelta(seconds=s), v, u) for s, v, u in
            ((0, 1.0, "p"), (119, 3.0, "p"), (120, 5.0, "q"), (130, 0.0, "r"), (500, 0.0, "q"))]
    df = spark.createDataFrame(rows, "District string, time timestamp_ntz, down double, user string")
    means = windows.downsample(df, ["down"]).orderBy("time").collect()
    assert [(r["time"], r["down"]) for r in means] == [
        (EPOCH, 2.0), (EPOCH + dt.timedelta(seconds=120), 2.5), (EPOCH + dt.timedelta(seconds=480), 0.0)]
    other = windows.downsample(df, aggregates={
        "var": windows.normalised_variance("down"), "users": windows.user_count("user"),
        "bits": windows.throughput("down", 120)}).orderBy("time").collect()
    assert [r["var"] for r in other] == [0.25, 1.0, None]
    assert [r["users"] for r in other] == [1, 2, 1] and other[0]["bits"] == pytest.approx(4 / 120)
    gaps = windows.dropped_minutes(spark.createDataFrame(other), ["var"], spec=windows.SeriesSpec(key="District")).first()
    assert (gaps["n_windows"], gaps["n_dropped"], gaps["dropped_minutes"]) == (3, 1, 2.0)


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = sorted((int(t), float(v)) for t, v in zip(rng.integers(0, 20_000, 400), rng.normal(size=400)))
    make = lambda part: spark.createDataFrame(
        [("a" if v > 0 else "b", EPOCH + dt.timedelta(seconds=t), v) for t, v in part],
        "District string, time timestamp_ntz, down double")
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    df = make(rows)

    def run():
        stream = spark.readStream.schema(df.schema).parquet(source)
        windows.downsample_stream(stream, out, state, available_now=True).awaitTermination()

    make(rows[:200]).write.mode("append").parquet(source)
    run()
    # The second run continues from the saved offsets; open windows come out as well.
    make(rows[200:]).write.mode("append").parquet(source)
    run()
    got = windows.read_windows(spark, out)
    assert dict(got.dtypes)["time"] == "timestamp_ntz"
    assert rows_of(got) == rows_of(windows.downsample(make(rows), ["down"]))
    # A third run brings rows for closed windows: the windows stay, and each late row is accounted for.
    late = [(5, 1.0), (6, 2.0), (130, -1.0), (19_999, 3.0)]
    make(late).coalesce(1).write.mode("append").parquet(source)
    run()
    assert rows_of(windows.read_windows(spark, out)) == rows_of(windows.downsample(make(rows + late[3:]), ["down"]))
    account = windows.late_by_window(make(rows + late), out).collect()
    assert sum(r.n_late for r in account) == 3 and sum(r.n_rows for r in account) == len(rows) + 4
    assert {(r.District, r.time): r.n_late for r in account if r.n_late} == {("a", EPOCH): 2, ("b", EPOCH + dt.timedelta(seconds=120)): 1}


def test_users_of_a_stream(spark, tmp_path):
    """Users are counted once per window over restarts; late windows stay closed; compacted windows are the same."""
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "District string, time timestamp_ntz, user string, down double"
    make = lambda rows: spark.createDataFrame([(d, EPOCH + dt.timedelta(seconds=t), u, 1.0) for d, t, u in rows], schema)
    parts = [[("a", 10, "x"), ("a", 20, "x"), ("a", 30, "y"), ("b", 30, "x"), ("b", 35, None), ("a", 130, "x")],
             [("a", 40, "x"), ("a", 50, "z"), ("b", 3000, "q")], [("a", 60, "late"), ("b", 3001, "q"), ("b", 2990, "r")]]
    for part in parts:
        make(part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(make(part).schema).parquet(source)
        windows.count_users_stream(stream, out, state, "user", lateness="1 minute", available_now=True).awaitTermination()
    got = windows.read_user_counts(spark, out)
    assert dict(got.dtypes)["time"] == "timestamp_ntz"
    at = lambda s: EPOCH + dt.timedelta(seconds=s)
    found = {(r.District, r.time): r.rnti_count for r in got.collect()}
    assert found == {("a", at(0)): 3, ("b", at(0)): 1, ("a", at(120)): 1, ("b", at(3000)): 1, ("b", at(2880)): 1}
    windows.downsample(make(parts[0])).write.parquet(f"{tmp_path}/v/batch=0")
    windows.downsample(make(parts[0]).withColumn("down", F.lit(3.0))).write.parquet(f"{tmp_path}/v/batch=1")
    whole = rows_of(windows.read_windows(spark, f"{tmp_path}/v"))
    assert rows_of(windows.compact_windows(spark, f"{tmp_path}/v", f"{tmp_path}/w")) == whole
    assert spark.read.parquet(f"{tmp_path}/w").count() == len(whole)


def test_wall_clock_times_pass_no_zone(spark, tmp_path):
    """02:30 does not exist in New York on that day; series there keep it all the same."""
    start = dt.datetime(2018, 3, 11, 1, 0)
    df = spark.createDataFrame([("a", start + dt.timedelta(minutes=10 * i), float(i)) for i in range(20)],
                               "District string, time timestamp_ntz, down double")
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    df.write.parquet(source)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        lagged = lags.time_lags(df, 1).collect()
        assert len(lagged) == 19 and all(r["down_lag_1"] == r["down"] - 1 for r in lagged)
        stream = spark.readStream.schema(df.schema).parquet(source)
        windows.downsample_stream(stream, out, state, "20 minutes", "0 seconds", available_now=True).awaitTermination()
        got = windows.read_windows(spark, out).orderBy("time").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [(r["time"], r["down"]) for r in got] == [
        (start + dt.timedelta(minutes=20 * i), 2 * i + 0.5) for i in range(10)]


def test_fitted_scaler_applies_to_a_stream(spark, tmp_path):
    df = series_table(spark, missing=0.0)
    df.write.parquet(str(tmp_path / "in"))
    fitted = scale.fit_scaler(df, "robust", key="District")
    stream = fitted.apply(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    query = (stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert rows_of(spark.read.parquet(str(tmp_path / "out"))) == rows_of(fitted.apply(df))


@pytest.fixture(scope="module")
def wave(spark):
    """A noiseless autoregression: each value is a fixed combination of the two before it."""
    rows = []
    for key, start in (("a", (1.0, 2.0)), ("b", (3.0, -1.0))):
        values = list(start)
        while len(values) < 80:
            values.append(1.6 * values[-1] - 0.9 * values[-2] + 1)
        rows += [(key, EPOCH + dt.timedelta(minutes=2 * i), v, 10 - v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "District string, time timestamp_ntz, down double, up double").cache()


def test_linear_forecaster_recovers_the_recurrence(spark, wave, tmp_path):
    config = ForecastConfig(targets=("down", "up"), n_lags=2, features=("down",))
    fitted = fit_forecaster(wave, config)
    coefficients = [float(v) for v in fitted.models.stages[1].coefficients]
    np.testing.assert_allclose(coefficients, [-0.9, 1.6], atol=1e-6)
    scored = fitted.score(wave)
    assert scored.count() == 2 * 78
    assert all(len(r["y_pred"]) == len(r["y_true"]) == 2 for r in scored.collect())
    assert metrics_overall(long_predictions(scored)).first()["r2"] == pytest.approx(1.0)
    fitted.save(str(tmp_path / "model"))
    again = load_forecaster(spark, str(tmp_path / "model"))
    assert rows_of(again.score(wave)) == rows_of(scored)
    assert again.config == config


@pytest.mark.parametrize("loss", ["mse", "l1"])
def test_boosted_forecaster(wave, loss):
    config = ForecastConfig(targets=("down",), n_lags=2, kind="gbt", loss=loss, max_iter=8)
    scored = fit_forecaster(wave, config).score(wave)
    assert scored.count() == 2 * 78
    assert metrics_overall(long_predictions(scored)).first()["r2"] > 0.3


def test_penalties_and_unknown_models(wave):
    strong = ForecastConfig(targets=("down",), n_lags=2, features=("down",), l1=1e6)
    assert set(fit_forecaster(wave, strong).models.stages[1].coefficients) == {0.0}
    with pytest.raises(ValueError):
        fit_forecaster(wave, ForecastConfig(kind="linear", loss="l1", l1=0.1))
    with pytest.raises(ValueError):
        fit_forecaster(wave, ForecastConfig(kind="lstm"))
