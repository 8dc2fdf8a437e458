"""The jobs end to end: prepare a table, fit and evaluate a forecaster, profile a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.timefeat import with_time_features
from ..operators import multivar, profile
from ..operators.clean import clean_missing
from ..operators.forecast import ForecastConfig, Forecaster, fit_forecaster
from ..operators.lags import time_lags
from ..operators.metrics import long_predictions, metrics_overall
from ..operators.scale import scale_frame
from ..series import SeriesSpec, select_numeric
from ..sources import tables
from ..sources.staging import stage
from .layout import plan_layout

SPEC = SeriesSpec()


def prepare(df: DataFrame, n_lags: int = 5, scaler: str = "standard", threshold: float = 0.33,
            period_us: int | None = None, spec: SeriesSpec = SPEC) -> DataFrame:
    """Clean, scale, add time lags and cyclical time features.

    The input is written once, so a derived frame such as a downsample is not computed again for every
    fitted value; the rows are shuffled once, for the lags.
    """
    rows = stage(select_numeric(df, spec), "prepare")
    scaled = scale_frame(clean_missing(rows, threshold, spec=spec), scaler, spec)
    return with_time_features(time_lags(scaled, n_lags, period_us=period_us, spec=spec), spec)


def prepare_csv(spark: SparkSession, source: str, target: str, n_lags: int = 5, scaler: str = "standard",
                threshold: float = 0.33, spec: SeriesSpec = SPEC) -> DataFrame:
    """The preprocessing job from CSV to CSV: read, clean, scale, lags at each series' modal period, time features, write.

    Returns the table read back from ``target``.
    """
    rows = tables.read_measurements_csv(spark, source)
    done = prepare(rows, n_lags, scaler, threshold, spec=spec)
    tables.write_csv(done, target)
    written = done.select(spec.time, *[c for c in done.columns if c != spec.time]).schema
    return spark.read.csv(target, header=True, schema=written).select(*done.columns)


def train_and_evaluate(df: DataFrame, config: ForecastConfig = ForecastConfig(),
                       spec: SeriesSpec = SPEC) -> tuple[Forecaster, DataFrame, DataFrame]:
    """Fit on the first part of every series; predictions and metrics over the held-out rest."""
    layout = plan_layout(df, spec)
    forecaster = fit_forecaster(df, config, spec, layout)
    predictions = forecaster.score_held_out(df, layout)
    return forecaster, predictions, metrics_overall(long_predictions(predictions, spec=spec))


def profile_tables(df: DataFrame, max_lag: int = 15, threshold: float = 0.95,
                   spec: SeriesSpec = SPEC, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The tables behind the exploration charts, by name; all of them, or those in ``names``."""
    tables = {
        "quality": lambda: profile.quality_report(df),
        "statistics": lambda: profile.statistics(df, spec=spec),
        "describe": lambda: profile.describe(df, spec=spec),
        "trends": lambda: profile.trends(df, spec=spec),
        "pacf": lambda: profile.partial_autocorrelation(df, max_lag, spec=spec),
        "pearson": lambda: multivar.pearson(df, spec=spec),
        "distance_correlation": lambda: multivar.distance_correlation(df, spec=spec),
        "density": lambda: multivar.density(df, spec=spec),
        "scatter": lambda: multivar.scatter_bins(df, spec=spec),
        "components": lambda: multivar.Components(df, spec=spec).variance(df.sparkSession),
        "component_correlation": lambda: multivar.component_correlation(df, threshold=threshold, spec=spec),
    }
    return {name: tables[name]() for name in names or tables}
