"""Lag-feature forecasters on MLlib: fit, save, load, score, evaluate."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.layout import Layout, plan_layout
from ..series import SeriesSpec, numeric_columns
from .lags import lag_columns, mark_split, row_lags
from .linear import as_model, fit_linear_each
from .metrics import long_predictions

SPEC = SeriesSpec()


@dataclass(frozen=True)
class ForecastConfig:
    targets: tuple[str, ...] = ("down", "up")
    n_lags: int = 10
    features: tuple[str, ...] | None = None
    exogenous: tuple[str, ...] = ()  # columns known at the row itself, such as time features; used without lags
    kind: str = "linear"             # linear or gbt
    loss: str = "mse"                # mse or l1
    l1: float = 0.0                  # elastic-net weights of MLlib: penalties on standardised coefficients,
    l2: float = 0.0                  # l1·|w| + l2·w²/2
    norm1: float = 0.0               # linear: plain norms of the coefficients as they are, added to the mean loss,
    norm2: float = 0.0               # norm1·‖w‖₁ + norm2·‖w‖₂
    train_size: float = 0.8
    max_iter: int = 20
    early_stop: bool = True          # gbt: stop when the validation loss no longer improves
    patience: int | None = None      # gbt: keep the best round, stop after so many rounds in a row without ``delta``
    delta: float = 0.0
    patience_tol: float = 0.01       # gbt without patience: the relative improvement below which MLlib stops
    seed: int = 0

    def estimator(self, target: str):
        if self.kind == "gbt":
            model = GBTRegressor(featuresCol="__x", labelCol=target, predictionCol=f"__p_{target}",
                                 lossType="absolute" if self.loss == "l1" else "squared",
                                 maxIter=self.max_iter, seed=self.seed, validationTol=self.patience_tol)
            return model.setValidationIndicatorCol("__is_val") if self.early_stop and self.patience is None else model
        if self.kind != "linear" or self.loss not in ("mse", "l1"):
            raise ValueError(f"no model for kind={self.kind}, loss={self.loss}")
        total = self.l1 + self.l2
        return LinearRegression(featuresCol="__x", labelCol=target, predictionCol=f"__p_{target}",
                                regParam=total, elasticNetParam=self.l1 / total if total else 0.0)


@dataclass(frozen=True)
class Forecaster:
    config: ForecastConfig
    features: tuple[str, ...]
    models: PipelineModel
    spec: SeriesSpec = field(default=SPEC)
    history: tuple[tuple[str, tuple[float, ...], int], ...] = ()

    def score(self, df: DataFrame, layout: Layout | None = None) -> DataFrame:
        """``(key, time, y_true, y_pred)``, one vector per row that has its lags."""
        return self.score_examples(_design(df, self.config, self.features, self.spec, layout))

    def score_held_out(self, df: DataFrame, layout: Layout | None = None) -> DataFrame:
        """The same for the rows that the fit did not learn from."""
        design = split_design(df, self.config, self.features, self.spec, layout)
        return self.score_examples(design.where("not is_train"))

    def score_examples(self, design: DataFrame) -> DataFrame:
        scored = self.models.transform(design)
        return scored.select(*self.spec.keys, self.spec.time,
                             F.array(*self.config.targets).alias("y_true"),
                             F.array(*[f"__p_{t}" for t in self.config.targets]).alias("y_pred"))

    def rounds(self, spark: SparkSession) -> DataFrame:
        """``(target, round, loss, kept)``: the validation loss after each round up to the stop, of models fitted with patience."""
        rows = [(t, i + 1, float(x), i == best) for t, losses, best in self.history for i, x in enumerate(losses)]
        return spark.createDataFrame(rows, "target string, round int, loss double, kept boolean")

    def save(self, path: str) -> None:
        """Models and settings under ``path``, on any file system Spark writes to."""
        self.models.write().overwrite().save(f"{path}/models")
        spark = SparkSession.active()
        text = json.dumps({"config": self.config.__dict__, "features": self.features,
                           "spec": self.spec.__dict__})
        spark.createDataFrame([(text,)], "value string").write.mode("overwrite").text(f"{path}/settings")


def load_forecaster(spark, path: str) -> Forecaster:
    saved = json.loads(spark.read.text(f"{path}/settings").first()[0])
    config = {k: tuple(v) if isinstance(v, list) else v for k, v in saved["config"].items()}
    spec = {**saved["spec"], "ties": tuple(saved["spec"]["ties"])}
    return Forecaster(ForecastConfig(**config), tuple(saved["features"]),
                      PipelineModel.load(f"{path}/models"), SeriesSpec(**spec))


def _inputs(config: ForecastConfig, features) -> list[str]:
    return [*lag_columns(list(features), config.n_lags), *config.exogenous]


def _design(df: DataFrame, config: ForecastConfig, features, spec: SeriesSpec,
            layout: Layout | None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Targets and the model inputs per row: lags in model input order, then exogenous columns."""
    columns = list(dict.fromkeys([*features, *config.targets]))
    along = tuple(dict.fromkeys([*[c for c in config.exogenous if c not in columns], *carry]))
    rows = df.select(*dict.fromkeys([*spec.keys, spec.time, *spec.ties, *columns, *along]))
    lagged = row_lags(rows, config.n_lags, columns, "both", spec, layout, along)
    return lagged.select(*spec.keys, spec.time, *[F.col(t).cast("double").alias(t) for t in config.targets],
                         *[F.col(c).cast("double").alias(c) for c in config.exogenous if c not in config.targets],
                         *lag_columns(list(features), config.n_lags), *carry)


def split_design(df: DataFrame, config: ForecastConfig, features, spec: SeriesSpec, layout: Layout | None) -> DataFrame:
    """The design with ``is_train``: the first rows of every series, of those that have their lags."""
    marked = mark_split(df, config.train_size, spec, layout, config.n_lags)
    return _design(marked, config, features, spec, layout, ("is_train",))


def stopping_round(losses: list[float], patience: int, delta: float = 0.0) -> tuple[int, int]:
    """Best round and last round (from 0) of a training that watches ``losses``.

    A round is the best so far if its loss is at least ``delta`` below the best before it; training stops after
    ``patience`` rounds in a row that are not.
    """
    best, without = 0, 0
    for i, loss in enumerate(losses):
        if i and loss > losses[best] - delta:
            without += 1
            if without >= patience:
                return best, i
        else:
            best, without = i, 0
    return best, len(losses) - 1


def _with_patience(ready: DataFrame, config: ForecastConfig, target: str) -> tuple[GBTRegressionModel, tuple[str, tuple[float, ...], int]]:
    """The boosted model cut after its best round, and the losses that chose it.

    The loss after every round is that of the validation rows, in one pass over them; without validation rows the last round
    is kept.  Rounds are never refitted: a prefix of the ensemble is the model after that round.
    """
    whole = config.estimator(target).fit(ready.where("not __is_val"))
    held = ready.where("__is_val")
    if held.isEmpty():
        return whole, (target, (), -1)
    losses = list(whole.evaluateEachIteration(held, "absolute" if config.loss == "l1" else "squared"))
    best, last = stopping_round(losses, config.patience, config.delta)
    spark = ready.sparkSession
    types, jvm = spark.sparkContext._gateway.new_array, spark._jvm
    trees = types(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, best + 1)
    weights = types(jvm.double, best + 1)
    for i, (tree, weight) in enumerate(zip(whole._java_obj.trees(), whole.treeWeights)):
        if i <= best:
            trees[i], weights[i] = tree, float(weight)
    cut = GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(whole.uid, trees, weights, whole.numFeatures))
    return (cut.setFeaturesCol("__x").setPredictionCol(f"__p_{target}"), (target, tuple(losses[:last + 1]), best))


def fit_forecaster(df: DataFrame, config: ForecastConfig = ForecastConfig(), spec: SeriesSpec = SPEC,
                   layout: Layout | None = None) -> Forecaster:
    """One model per target on the chronologically first part of every series.

    The rest is the validation part: GBT watches it for early stopping (with ``patience``, round by round), the linear
    model leaves it out.
    """
    features = config.features or tuple(c for c in numeric_columns(df, spec) if c not in config.exogenous)
    layout = layout or plan_layout(df, spec)
    marked = split_design(df, config, features, spec, layout)
    assembler = VectorAssembler(inputCols=_inputs(config, features), outputCol="__x")
    usable = marked.na.drop("any", subset=list(config.targets)).withColumn("__is_val", ~F.col("is_train"))
    patient = config.kind == "gbt" and config.patience is not None
    if config.kind != "gbt" or not (config.early_stop or patient):
        usable = usable.where("is_train")
    ready = assembler.transform(usable).select("__x", "__is_val", *config.targets)
    if _own(config):
        found = fit_linear_each(ready, list(config.targets), config.loss, config.norm1, config.norm2)
        pairs = [(as_model(ready.sparkSession, *model, "__x", f"__p_{t}"), None) for t, model in zip(config.targets, found)]
    else:
        ready.persist()
        try:
            pairs = [_with_patience(ready, config, t) if patient else (config.estimator(t).fit(ready), None) for t in config.targets]
        finally:
            ready.unpersist()
    history = tuple(h for _, h in pairs if h)
    return Forecaster(config, features, PipelineModel([assembler, *[m for m, _ in pairs]]), spec, history)


def _own(config: ForecastConfig) -> bool:
    """Whether the model is one that MLlib does not fit: absolute loss or plain norms, linear."""
    if config.kind != "linear" or not (config.loss == "l1" or config.norm1 or config.norm2):
        return False
    config.estimator(config.targets[0])
    if config.l1 or config.l2:
        raise ValueError("l1 and l2 are MLlib's, for squared loss alone; use norm1 and norm2")
    return True


def naive_forecast(df: DataFrame, targets: list[str], spec: SeriesSpec = SPEC,
                   layout: Layout | None = None) -> DataFrame:
    """``(key, time, dim, y_true, y_pred)`` where the prediction is the previous row."""
    lagged = row_lags(df.select(*dict.fromkeys([*spec.keys, spec.time, *spec.ties, *targets])), 1, list(targets), "both", spec, layout)
    paired = lagged.select(*spec.keys, spec.time,
                           F.array(*[F.col(t).cast("double") for t in targets]).alias("y_true"),
                           F.array(*[F.col(f"{t}_lag_1") for t in targets]).alias("y_pred"))
    return long_predictions(paired, spec=spec)
