"""Every operator as a query over the given tables, each with the SQL that must agree with it.

Derived series (District = event type throughout):

* ``R``  raw events: value as ``down``, user as ``up``; rows of one instant go by the event's number;
* ``M``  two-minute windows of the events: largest and smallest value, number of events;
* ``G``  the same windows split into large, small and medium values, so that cells are missing.

Computed doubles are compared at six decimals, from 1000 on at nine significant digits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .functions import timefeat
from .operators import clean, examples, lags, metrics, multivar, profile, project, scale
from .operators.forecast import (ForecastConfig, Forecaster, fit_forecaster, load_forecaster,
                                 naive_forecast)
from .plans import jobs
from .plans.layout import plan_layout, row_index
from .series import SeriesSpec, nan_to_null
from .session import scratch_path
from .sources import tables
from .sources.staging import stage
from .streaming import downsample as windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SPEC = SeriesSpec()
TIES = SeriesSpec(ties=("event_id",))
LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
G_COLS = ["down", "up", "rb_down", "rnti_count"]
MINUTE_US = 60_000_000

# ------------------------------------------------------------------------------ inputs


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(f"{sf}/{name}.parquet"))


def raw_series(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_type").alias("District"), F.col("ts").alias("time"),
        F.col("value").alias("down"), F.col("user_id").cast("double").alias("up"))


def ordered_series(spark: SparkSession, sf: str) -> DataFrame:
    """The raw series with the event's number, which orders the rows of one instant."""
    return _events(spark, sf).select("District", "time", "event_id", F.col("value").alias("down"),
                                     F.col("user_id").cast("double").alias("up"))


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumnsRenamed({"event_type": "District", "ts": "time"})


def _n_events() -> Column:
    return F.count(F.lit(1)).cast("double")


def grid_series(spark: SparkSession, sf: str) -> DataFrame:
    return windows.downsample(_events(spark, sf), aggregates={
        "down": F.max("value"), "up": F.min("value"), "rnti_count": _n_events()})


def gappy_series(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("value")
    return windows.downsample(_events(spark, sf), aggregates={
        "down": F.max(F.when(v >= 10, v)), "up": F.min(F.when(v < 10, v)),
        "rb_down": F.max(F.when(v.between(5, 30), v)), "rnti_count": _n_events()})


def line_items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(*[(F.col(c) + F.lit(0.0)).alias(c) for c in LINE])


def naive(spark: SparkSession, sf: str) -> DataFrame:
    return naive_forecast(raw_series(spark, sf), ["down", "up"])


R_SQL = """R AS (SELECT event_type AS "District", ts AS time, value AS down,
  CAST(user_id AS DOUBLE) AS up FROM events)"""
M_SQL = """M AS (SELECT event_type AS "District", time_bucket(INTERVAL '2 minutes', ts) AS time,
  max(value) AS down, min(value) AS up, CAST(count(*) AS DOUBLE) AS rnti_count
  FROM events GROUP BY 1, 2)"""
G_SQL = """G AS (SELECT event_type AS "District", time_bucket(INTERVAL '2 minutes', ts) AS time,
  max(value) FILTER (value >= 10) AS down, min(value) FILTER (value < 10) AS up,
  max(value) FILTER (value BETWEEN 5 AND 30) AS rb_down, CAST(count(*) AS DOUBLE) AS rnti_count
  FROM events GROUP BY 1, 2)"""
L_SQL = "L AS (SELECT " + ", ".join(f"{c} + 0.0 AS {c}" for c in LINE) + " FROM lineitem)"
P_SQL = R_SQL + """, N AS (SELECT "District", time, down, up,
  coalesce(lag(down) OVER w, 0) AS pd, coalesce(lag(up) OVER w, 0) AS pu FROM R
  WINDOW w AS (PARTITION BY "District" ORDER BY time) QUALIFY row_number() OVER w > 1),
P AS (SELECT "District", time, 0 AS dim, down AS y_true, pd AS y_pred FROM N
  UNION ALL SELECT "District", time, 1, up, pu FROM N)"""


# The offset keeps values with few decimals, such as means of prices, off the rounding boundary.
NUDGE = 3.1e-8


def tidy(df: DataFrame) -> DataFrame:
    """Doubles below 1000 at six decimals, others at nine significant digits, no negative zero."""
    def one(name: str) -> Column:
        c = F.col(name)
        large = F.when(F.abs(c) >= 1000, c * F.lit(1 + NUDGE / 1000)).otherwise(F.lit(0.0))
        digits = F.format_string("%.8e", large).cast("double")
        return (F.when(F.abs(c) < 1000, F.round(c + F.lit(NUDGE), 6))
                .when(c.isNotNull(), digits) + F.lit(0.0)).alias(name)
    return df.select(*[one(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema])


def r(expression: str, name: str | None = None) -> str:
    """The SQL side of ``tidy`` for one expression."""
    x = f"({expression})"
    return (f"CASE WHEN abs({x}) < 1000 THEN round({x} + 3.1e-8::DOUBLE, 6) ELSE CAST(format('{{:.8e}}', "
            f"CAST({x} * (1 + 3.1e-11::DOUBLE) AS DOUBLE)) AS DOUBLE) END + 0.0 AS {name or expression}")


def rs(*names: str) -> str:
    return ", ".join(r(n) for n in names)


def query(sql: str | None = None, name: str | None = None):
    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return register


KEYTIME = '"District", time'
IN_ORDER = 'PARTITION BY "District" ORDER BY time'

# ------------------------------------------------------------------- sources and sinks


def _written_csv(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "csv")
    tables.write_csv(raw_series(spark, sf), path)
    return path


@query(f"""WITH {R_SQL} SELECT "District", time, round(CAST(CAST(down AS FLOAT) AS DOUBLE), 4) AS down,
  CAST(CAST(up AS FLOAT) AS DOUBLE) AS up FROM R WHERE "District" = 'view'""")
def csv_scan_float(spark, sf):
    scan = tables.read_measurements_csv(spark, _written_csv(spark, sf), "view", numeric_type="float")
    return scan.select("District", "time", F.round(F.col("down").cast("double"), 4).alias("down"),
                       F.col("up").cast("double").alias("up"))


@query(f"""WITH {R_SQL} SELECT time, down, up FROM R WHERE "District" = 'view'""")
def csv_scan_double(spark, sf):
    return tables.read_measurements_csv(spark, _written_csv(spark, sf), "view", drop_key=True)


@query(f"WITH {R_SQL} SELECT {KEYTIME}, down, up FROM R")
def csv_round_trip(spark, sf):
    return tables.read_measurements_csv(spark, _written_csv(spark, sf), bad_rows="quarantine").drop(
        tables.QUARANTINE)


@query(f"""WITH {R_SQL} SELECT {KEYTIME}, down, up FROM R WHERE "District" = 'error'""")
def parquet_by_series(spark, sf):
    path = scratch_path(spark, "measurements")
    tables.write_measurements(raw_series(spark, sf), path)
    return tables.read_measurements(spark, path, "error")


METRICS_SQL = f"""WITH {P_SQL}, D AS (SELECT dim, avg((y_true - y_pred)^2) AS mse,
  avg(abs(y_true - y_pred)) AS mae, avg(y_true) AS my, var_pop(y_true) AS vy FROM P GROUP BY dim)
SELECT {r('avg(mse)', 'mse')}, {r('sqrt(avg(mse))', 'rmse')}, {r('avg(mae)', 'mae')},
  {r('avg(1 - mse / vy)', 'r2')}, {r('coalesce(avg(sqrt(mse) / nullif(my, 0)), 0)', 'nrmse')} FROM D"""


@query(METRICS_SQL)
def metrics_json(spark, sf):
    path = scratch_path(spark, "metrics")
    tables.write_metrics(metrics.metrics_overall(naive(spark, sf)), path)
    return tidy(spark.read.schema("mse double, rmse double, mae double, r2 double, nrmse double").json(path))


@query(f"WITH {P_SQL} SELECT {KEYTIME}, dim, y_true, y_pred FROM P")
def predictions_sink(spark, sf):
    path = scratch_path(spark, "predictions")
    tables.write_predictions(naive(spark, sf), path)
    return spark.read.parquet(path)


# ------------------------------------------------------------- projections and filters


@query(f"""WITH {R_SQL} SELECT {KEYTIME}, down, up FROM R WHERE "District" = 'click'""")
def filter_district(spark, sf):
    return project.only_series(raw_series(spark, sf), "click")


@query("""SELECT event_type AS "District", ts AS time, event_id, user_id, value FROM events""")
def select_numeric(spark, sf):
    return project.select_numeric(_events(spark, sf))


@query(f"WITH {R_SQL} SELECT {KEYTIME}, round(CAST(CAST(down AS FLOAT) AS DOUBLE), 4) AS down, up FROM R")
def cast_features(spark, sf):
    cast = project.cast_features(raw_series(spark, sf), "float")
    return cast.select("District", "time", F.round(F.col("down").cast("double"), 4).alias("down"),
                       F.col("up").cast("double").alias("up"))


@query(f"WITH {G_SQL} SELECT {KEYTIME}, down AS x_down, up AS x_up, rb_down AS x_rb_down, down AS y_down, up AS y_up FROM G")
def to_xy(spark, sf):
    xy = project.split_xy(gappy_series(spark, sf), ["down", "up"], ignore=["rnti_count", "District"])
    return xy.select("District", "time", F.col("X.down").alias("x_down"), F.col("X.up").alias("x_up"),
                     F.col("X.rb_down").alias("x_rb_down"), F.col("y.down").alias("y_down"),
                     F.col("y.up").alias("y_up"))


@query(f"WITH {G_SQL} SELECT time, down, up, rb_down, rnti_count FROM G")
def drop_identifier(spark, sf):
    return project.drop_key(gappy_series(spark, sf))


@query(f"WITH {G_SQL} SELECT * FROM G WHERE down IS NOT NULL AND up IS NOT NULL AND rb_down IS NOT NULL")
def drop_any(spark, sf):
    return project.drop_any_missing(gappy_series(spark, sf))


@query(f"""WITH {G_SQL} SELECT * FROM G WHERE (down IS NOT NULL)::INT + (up IS NOT NULL)::INT
  + (rb_down IS NOT NULL)::INT + (rnti_count IS NOT NULL)::INT >= 3""")
def drop_thresh(spark, sf):
    return project.drop_sparse_rows(gappy_series(spark, sf), 0.33)


@query(f"WITH {G_SQL} SELECT {KEYTIME}, down, up, rb_down, rnti_count FROM G")
def drop_empty_columns(spark, sf):
    never = F.when(F.col("rnti_count") < 0, F.col("down"))
    return project.drop_empty_columns(gappy_series(spark, sf).withColumn("mcs_up", never))


def _users(spark, sf):
    return table(spark, sf, "events").select(F.col("user_id").cast("string").alias("District"), "ts")


def _customers(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("District"), "o_orderdate")


@query("""WITH a AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS "District" FROM events),
b AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS "District" FROM orders)
SELECT "District", 'right' AS missing_in FROM a ANTI JOIN b USING ("District")
UNION ALL SELECT "District", 'left' FROM b ANTI JOIN a USING ("District")""")
def area_check(spark, sf):
    return project.key_mismatch(_users(spark, sf), _customers(spark, sf))


@query("""SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS "District" FROM orders
  WHERE o_custkey NOT IN (SELECT user_id FROM events)""")
def params_check(spark, sf):
    return clean.unknown_series(_customers(spark, sf), _users(spark, sf))


SPLIT_SQL = f"""{R_SQL}, S AS (SELECT *, row_number() OVER ({IN_ORDER})
  <= ceil(0.8::DOUBLE * count(*) OVER (PARTITION BY "District")) AS is_train FROM R)"""


@query(f"""WITH {SPLIT_SQL} SELECT {KEYTIME}, down, up,
  CASE WHEN is_train THEN 'train' ELSE 'val' END AS split FROM S""")
def union_split(spark, sf):
    return project.stack_splits(*lags.split_train_val(ordered_series(spark, sf), spec=TIES)).drop("event_id")


@query(f"""WITH {SPLIT_SQL} SELECT {KEYTIME}, {r('sin(2*pi()*hour(time)/24)', 'sin_hour')},
  {r('cos(2*pi()*hour(time)/24)', 'cos_hour')}, {r('sin(2*pi()*minute(time)/60)', 'sin_minute')},
  {r('cos(2*pi()*minute(time)/60)', 'cos_minute')}, CASE WHEN is_train THEN 'train' ELSE 'val' END AS split FROM S""")
def exogenous_by_area(spark, sf):
    train, val = lags.split_train_val(ordered_series(spark, sf), spec=TIES)
    return tidy(project.exogenous_by_series(timefeat.exogenous_time(train), timefeat.exogenous_time(val)))


# -------------------------------------------------------------- missing values, outliers


@query(f"""WITH {G_SQL} SELECT * FROM (SELECT unnest(['District','time','down','up','rb_down','rnti_count']) AS feature,
  unnest([count(*)-count("District"), count(*)-count(time), count(*)-count(down), count(*)-count(up),
  count(*)-count(rb_down), count(*)-count(rnti_count)]) AS n_missing FROM G)""")
def missing_counts(spark, sf):
    return clean.missing_counts(gappy_series(spark, sf))


@query(f"""WITH {G_SQL} SELECT {KEYTIME}, coalesce(down, 0) AS down, coalesce(up, 0) AS up,
  coalesce(rb_down, 0) AS rb_down, rnti_count FROM G""")
def impute_const(spark, sf):
    return clean.fill_constant(gappy_series(spark, sf), 0)


CLEAN_SQL = f"""{G_SQL}, K AS (SELECT * FROM G WHERE (down IS NOT NULL)::INT + (up IS NOT NULL)::INT
  + (rb_down IS NOT NULL)::INT + (rnti_count IS NOT NULL)::INT >= 3),
C AS (SELECT {KEYTIME}, coalesce(down, (SELECT avg(down) FROM K)) AS down,
  coalesce(up, (SELECT avg(up) FROM K)) AS up, coalesce(rb_down, (SELECT avg(rb_down) FROM K)) AS rb_down,
  rnti_count FROM K)"""


@query(f"WITH {CLEAN_SQL} SELECT {KEYTIME}, {rs('down', 'up', 'rb_down', 'rnti_count')} FROM C")
def impute_mean(spark, sf):
    return tidy(clean.clean_missing(gappy_series(spark, sf)))


def _between_sql(c: str) -> str:
    us = "epoch_us(time)"
    prev, nxt = f"last_value(CASE WHEN {c} IS NOT NULL THEN {{}} END IGNORE NULLS) OVER b", \
                f"first_value(CASE WHEN {c} IS NOT NULL THEN {{}} END IGNORE NULLS) OVER a"
    return (f"{prev.format(us)} AS pu_{c}, {prev.format(c)} AS pv_{c}, "
            f"{nxt.format(us)} AS nu_{c}, {nxt.format(c)} AS nv_{c}")


def _filled_sql(c: str) -> str:
    return r(f"coalesce({c}, (pv_{c}*(nu_{c}-epoch_us(time)) + nv_{c}*(epoch_us(time)-pu_{c}))/(nu_{c}-pu_{c}), "
             f"pv_{c}, nv_{c})", c)


@query(f"""WITH {G_SQL}, F AS (SELECT *, {_between_sql('down')}, {_between_sql('up')}, {_between_sql('rb_down')} FROM G
  WINDOW b AS ({IN_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  a AS ({IN_ORDER} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT {KEYTIME}, {_filled_sql('down')}, {_filled_sql('up')}, {_filled_sql('rb_down')}, rnti_count FROM F""")
def impute_time(spark, sf):
    return tidy(clean.fill_by_time(gappy_series(spark, sf), ["down", "up", "rb_down"]))


@query(f"""WITH {G_SQL}, U AS (SELECT "District", time, 'down' AS feature, down AS v FROM G
  UNION ALL SELECT "District", time, 'up', up FROM G UNION ALL SELECT "District", time, 'rb_down', rb_down FROM G
  UNION ALL SELECT "District", time, 'rnti_count', rnti_count FROM G),
I AS (SELECT *, count(v) OVER (PARTITION BY "District", feature ORDER BY time) AS run FROM U)
SELECT "District", feature, min(time) AS run_start, max(time) AS run_end, count(*) AS n_rows
FROM I WHERE v IS NULL GROUP BY "District", feature, run""")
def missing_runs(spark, sf):
    return clean.missing_runs(gappy_series(spark, sf))


GAP = "(down IS NULL OR up IS NULL OR rb_down IS NULL)"


@query(f"""WITH {G_SQL} SELECT "District", count(*) AS n_rows, count(*) FILTER {GAP} AS n_dropped FROM G GROUP BY 1""")
def load_rule(spark, sf):
    return clean.load_rule(gappy_series(spark, sf))[1]


@query(f"""WITH {L_SQL}, B AS (SELECT """ + ", ".join(
    f"quantile_cont({c}, 0.1) AS lo_{c}, quantile_cont({c}, 0.9) AS hi_{c}" for c in LINE) + " FROM L) SELECT "
    + ", ".join(r(f"greatest(least({c}, hi_{c}), lo_{c})", c) for c in LINE) + " FROM L, B")
def cap_global(spark, sf):
    return tidy(clean.cap(line_items(spark, sf), LINE))


def _case(expr: str, c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN {expr} END"


@query(f"""WITH {G_SQL}, A AS (SELECT unnest([down, up, rb_down]) AS v FROM G),
B AS (SELECT quantile_cont(v, 0.1) AS lo, quantile_cont(v, 0.9) AS hi FROM A)
SELECT {KEYTIME}, """ + ", ".join(r(_case(f"greatest(least({c}, hi), lo)", c), c) for c in ("down", "up", "rb_down"))
    + ", rnti_count FROM G, B")
def cap_all_cells(spark, sf):
    return tidy(clean.cap_all_cells(gappy_series(spark, sf), ["down", "up", "rb_down"]))


@query(f"""WITH {G_SQL}, B AS (SELECT "District", quantile_cont(down, 0.1) AS dl, quantile_cont(down, 0.9) AS dh,
  quantile_cont(up, 0.1) AS ul, quantile_cont(up, 0.9) AS uh, quantile_cont(down, 0.05) AS dl5,
  quantile_cont(down, 0.95) AS dh5, quantile_cont(up, 0.05) AS ul5, quantile_cont(up, 0.95) AS uh5 FROM G GROUP BY 1)
SELECT G."District" AS "District", G.time AS time,
  {r('''CASE WHEN "District" = 'error' OR down IS NULL THEN down WHEN "District" = 'view'
    THEN greatest(least(down, dh5), dl5) ELSE greatest(least(down, dh), dl) END''', 'down')},
  {r('''CASE WHEN "District" = 'error' OR up IS NULL THEN up WHEN "District" = 'view'
    THEN greatest(least(up, uh5), ul5) ELSE greatest(least(up, uh), ul) END''', 'up')}
FROM G JOIN B USING ("District")""")
def cap_by_area(spark, sf):
    pairs = {"click": (10, 90), "error": (10, 90), "purchase": (10, 90), "signup": (10, 90), "view": (5, 95)}
    capped = clean.cap_by_series(gappy_series(spark, sf), ["down", "up"], pairs, exclude=["error"])
    return tidy(capped.select("District", "time", "down", "up"))


@query(f"""WITH {G_SQL} SELECT "District", feature, {r('quantile_cont(v, 0.1)', 'lo')}, {r('quantile_cont(v, 0.9)', 'hi')}
FROM (SELECT "District", 'down' AS feature, down AS v FROM G UNION ALL SELECT "District", 'up', up FROM G) GROUP BY 1, 2""")
def cap_params(spark, sf):
    return tidy(clean.cap_bounds(gappy_series(spark, sf), ["down", "up"], key="District"))


# ------------------------------------------------------------------------------ scaling

CENTERS = {"standard": ("avg({c})", "stddev_pop({c})"), "minmax": ("min({c})", "max({c}) - min({c})"),
           "robust": ("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"),
           "maxabs": ("0.0", "max(abs({c}))")}


def _scaled_sql(kind: str, source: str = "G", fit: str = "G", by_key: bool = False,
                cols=("down", "up"), extra: str = "") -> str:
    center, width = CENTERS[kind]
    fitted = ", ".join(f"{center.format(c=c)} AS m_{c}, coalesce(nullif({width.format(c=c)}, 0), 1) AS s_{c}" for c in cols)
    values = ", ".join(r(f"({c} - m_{c}) / s_{c}", c) for c in cols)
    if by_key:
        return (f'B AS (SELECT "District", {fitted} FROM {fit} GROUP BY 1) SELECT {source}."District" AS "District", '
                f'{source}.time AS time, {values}{extra} FROM {source} JOIN B USING ("District")')
    return f"B AS (SELECT {fitted} FROM {fit}) SELECT {KEYTIME}, {values}{extra} FROM {source}, B"


def _register_scalers():
    for kind in CENTERS:
        def run(spark, sf, kind=kind):
            rows = gappy_series(spark, sf).select("District", "time", "down", "up")
            return tidy(scale.scale_frame(rows, kind))
        query(f"WITH {G_SQL}, " + _scaled_sql(kind), f"scale_{kind}")(run)


_register_scalers()


@query(f"WITH {G_SQL}, " + _scaled_sql("robust", by_key=True))
def scale_by_area(spark, sf):
    rows = gappy_series(spark, sf).select("District", "time", "down", "up")
    return tidy(scale.fit_scaler(rows, "robust", key="District").apply(rows))


@query(f"""WITH {G_SQL} SELECT "District", feature, {r('avg(v)', 'center')}, {r('stddev_pop(v)', 'scale')}
FROM (SELECT "District", 'down' AS feature, down AS v FROM G UNION ALL SELECT "District", 'up', up FROM G) GROUP BY 1, 2""")
def scaler_params(spark, sf):
    rows = gappy_series(spark, sf)
    return tidy(scale.fit_scaler(rows, "standard", ["down", "up"], "District").table())


@query(f"""WITH {SPLIT_SQL}, T AS (SELECT * FROM S WHERE is_train), """ + _scaled_sql(
    "standard", "S", "T", True, extra=", CASE WHEN is_train THEN 'train' ELSE 'val' END AS split"))
def scale_train_val(spark, sf):
    train, val = lags.split_train_val(ordered_series(spark, sf), spec=TIES)
    train, val, _ = scale.scale_train_val(train, val, "standard", per_series=True, spec=TIES)
    return tidy(project.stack_splits(train, val).drop("event_id"))


@query(f"WITH {G_SQL} SELECT {KEYTIME}, {rs('down', 'up')} FROM G")
def scale_inverse(spark, sf):
    rows = gappy_series(spark, sf).select("District", "time", "down", "up")
    fitted = scale.fit_scaler(rows, "standard", key="District")
    return tidy(fitted.invert(fitted.apply(rows)))


# ----------------------------------------------------------------- lags, order, splits


def _row_lags_sql(n_lags: int) -> str:
    return ", ".join(f"coalesce(lag({c}, {n}) OVER w, 0) AS {c}_lag_{n}"
                     for n in range(1, n_lags + 1) for c in ("down", "up"))


@query(f"""WITH {R_SQL} SELECT {KEYTIME}, {_row_lags_sql(3)} FROM R
  WINDOW w AS ({IN_ORDER}) QUALIFY row_number() OVER w > 3""")
def row_lags(spark, sf):
    return lags.row_lags(raw_series(spark, sf), 3)


@query(f"""WITH {R_SQL} SELECT time, down, up, {_row_lags_sql(2)} FROM R
  WINDOW w AS (ORDER BY time) QUALIFY row_number() OVER w > 2""")
def row_lags_whole_frame(spark, sf):
    return lags.row_lags(raw_series(spark, sf).drop("District"), 2, keep="both", spec=SeriesSpec(key=None))


@query(f"""WITH {R_SQL} SELECT {KEYTIME}, down, up FROM R QUALIFY row_number() OVER ({IN_ORDER}) > 3""")
def row_lags_targets(spark, sf):
    return lags.row_lags(raw_series(spark, sf), 3, keep="values")


def _time_lags_sql(steps, drop, source="M", cols=("down", "up", "rnti_count"), minutes=2, wrap=lambda c: c):
    joins = " ".join(f"""LEFT JOIN {source} l{n} ON l{n}."District" = b."District"
  AND l{n}.time = b.time - INTERVAL {n * minutes} MINUTE""" for n in steps)
    picked = ", ".join(wrap(f"l{n}.{c}") + f" AS {c}_lag_{n}" if wrap("x") == "x" else r(f"l{n}.{c}", f"{c}_lag_{n}")
                       for n in steps for c in cols)
    own = ", ".join(f"b.{c} AS {c}" if wrap("x") == "x" else r(f"b.{c}", c) for c in cols)
    return f"""SELECT b."District" AS "District", b.time AS time, {own}, {picked}
FROM (SELECT *, row_number() OVER ({IN_ORDER}) AS rn FROM {source}) b {joins} WHERE b.rn > {drop}"""


@query(f"WITH {M_SQL} " + _time_lags_sql([1, 2, 3], 3))
def time_lags(spark, sf):
    return lags.time_lags(grid_series(spark, sf), 3, period_us=2 * MINUTE_US)


@query(f"WITH {M_SQL} " + _time_lags_sql([2, 4], 2))
def time_lags_step2(spark, sf):
    return lags.time_lags(grid_series(spark, sf), 2, step=2, period_us=2 * MINUTE_US)


@query(f"WITH {M_SQL} " + _time_lags_sql([5, 10], 2))
def time_lags_joined(spark, sf):
    return lags.time_lags(grid_series(spark, sf), 2, step=5, period_us=2 * MINUTE_US, method="join")


DIFF_SQL = f"""{M_SQL}, D AS (SELECT "District", time,
  CAST(epoch_us(time) - lag(epoch_us(time)) OVER ({IN_ORDER}) AS BIGINT) AS diff_us FROM M)"""


@query(f"WITH {DIFF_SQL} SELECT {KEYTIME}, coalesce(diff_us, -1) AS diff_us FROM D")
def time_differences(spark, sf):
    return lags.time_differences(grid_series(spark, sf)).na.fill(-1, ["diff_us"])


@query(f'WITH {DIFF_SQL} SELECT "District", diff_us, count(*) AS n FROM D WHERE diff_us IS NOT NULL GROUP BY 1, 2')
def difference_counts(spark, sf):
    return lags.difference_counts(grid_series(spark, sf))


@query(f"""WITH {DIFF_SQL}, C AS (SELECT "District", diff_us, count(*) AS n FROM D WHERE diff_us IS NOT NULL GROUP BY 1, 2),
P AS (SELECT "District", diff_us AS period_us FROM C QUALIFY row_number() OVER (PARTITION BY "District" ORDER BY n DESC, diff_us) = 1),
J AS (SELECT D."District" AS "District", max(period_us) AS period_us, count(*) AS n_rows,
  count(*) FILTER (abs(diff_us - period_us) <= 10000) AS n_match FROM D JOIN P USING ("District") GROUP BY 1)
SELECT "District", period_us, n_rows, n_match, {r('n_match / n_rows * 100', 'pct')},
  CASE WHEN n_match / n_rows * 100 < 75 THEN 'highly irregular' WHEN n_match / n_rows * 100 < 90
  THEN 'irregular' ELSE 'regular' END AS verdict FROM J""")
def sampling_check(spark, sf):
    return tidy(lags.sampling_report(grid_series(spark, sf)))


@query(f"WITH {SPLIT_SQL} SELECT {KEYTIME}, down, up, is_train FROM S")
def train_val_split(spark, sf):
    return lags.mark_split(ordered_series(spark, sf), spec=TIES).drop("event_id")


@query(f"""WITH {SPLIT_SQL} SELECT "District", count(*) AS n_total, count(*) FILTER (is_train) AS n_train,
  count(*) FILTER (NOT is_train) AS n_val FROM S GROUP BY ROLLUP("District")""")
def split_report(spark, sf):
    return lags.split_report(lags.mark_split(ordered_series(spark, sf), spec=TIES))


@query(f"WITH {R_SQL} SELECT {KEYTIME}, down, up FROM R QUALIFY row_number() OVER ({IN_ORDER}) > 5")
def skip_rows(spark, sf):
    return lags.skip_rows(ordered_series(spark, sf), 5, TIES).drop("event_id")


def tied_series(spark: SparkSession, sf: str) -> DataFrame:
    """Many rows an instant: times cut to the hour, told apart by the event's number."""
    return _events(spark, sf).select("District", F.date_trunc("hour", "time").cast("timestamp_ntz").alias("time"),
                                     "event_id", F.col("value").alias("down"))


T_SQL = """T AS (SELECT event_type AS "District", date_trunc('hour', ts) AS time, event_id, value AS down FROM events)"""
IN_TIES = 'PARTITION BY "District" ORDER BY time, event_id'
TIED_SPLIT = f"""WITH {T_SQL} SELECT *, row_number() OVER ({IN_TIES}) <= ceil(0.8::DOUBLE * count(*) OVER (
  PARTITION BY "District")) AS is_train FROM T"""
TIED_SKIP = f"WITH {T_SQL} SELECT * FROM T QUALIFY row_number() OVER ({IN_TIES}) > 7"


@query(TIED_SPLIT)
def split_with_ties(spark, sf):
    return lags.mark_split(tied_series(spark, sf), spec=TIES)


@query(TIED_SPLIT)
def split_with_ties_cut(spark, sf):
    rows = tied_series(spark, sf)
    return lags.mark_split(rows, spec=TIES, layout=plan_layout(rows, TIES, CUT_ROWS))


@query(TIED_SKIP)
def skip_with_ties(spark, sf):
    return lags.skip_rows(tied_series(spark, sf), 7, TIES)


# The same operators on series cut into slots of a few hundred rows, as long series are.
CUT_ROWS = 300


def _cut(df: DataFrame, spec: SeriesSpec = SPEC):
    return plan_layout(df, spec, CUT_ROWS)


@query(ORACLES["row_lags"])
def row_lags_cut(spark, sf):
    rows = raw_series(spark, sf)
    return lags.row_lags(rows, 3, layout=_cut(rows))


@query(ORACLES["time_lags"])
def time_lags_cut(spark, sf):
    rows = grid_series(spark, sf)
    return lags.time_lags(rows, 3, period_us=2 * MINUTE_US, layout=_cut(rows))


@query(ORACLES["impute_time"])
def impute_time_cut(spark, sf):
    rows = gappy_series(spark, sf)
    return tidy(clean.fill_by_time(rows, ["down", "up", "rb_down"], layout=_cut(rows)))


@query(ORACLES["train_val_split"])
def split_cut(spark, sf):
    rows = ordered_series(spark, sf)
    return lags.mark_split(rows, spec=TIES, layout=_cut(rows, TIES)).drop("event_id")


@query(ORACLES["cap_params"])
def percentiles_bracketed(spark, sf):
    """Percentiles by brackets, as for groups too large to hold."""
    return tidy(clean.cap_bounds(gappy_series(spark, sf), ["down", "up"], key="District", max_group=1))


@query(f"""WITH {R_SQL} SELECT {KEYTIME}, CAST(row_number() OVER ({IN_ORDER}) - 1 AS BIGINT) AS position FROM R""")
def row_positions(spark, sf):
    rows = raw_series(spark, sf).select("District", "time")
    return row_index(rows, plan_layout(rows), "position")


@query(f"WITH {R_SQL} SELECT {KEYTIME}, CAST((row_number() OVER ({IN_ORDER}) - 1) // 32 AS BIGINT) AS batch_id FROM R")
def batch_ids(spark, sf):
    return lags.batch_ids(raw_series(spark, sf).select("District", "time"), 32)


def _permuted_sql(seed: int) -> str:
    """CTEs F0, F1, … that put the positions of the rows of R through the rounds of ``lags.permuted``."""
    mask = (1 << lags.HALF_BITS) - 1
    out = f"""F0 AS (SELECT "District", time, p >> {lags.HALF_BITS} AS l, p & {mask} AS r FROM (
      SELECT *, CAST(row_number() OVER ({IN_ORDER}) - 1 AS BIGINT) AS p FROM R))"""
    for i, (factor, summand) in enumerate(lags.shuffle_keys(seed), 1):
        out += f""", F{i} AS (SELECT "District", time, r AS l, xor(l, ((r * {factor} + {summand}) >> 11) & {mask}) AS r FROM F{i - 1})"""
    return out


@query(f"""WITH {R_SQL}, {_permuted_sql(7)}
SELECT {KEYTIME}, CAST((row_number() OVER (PARTITION BY "District" ORDER BY l, r) - 1) // 32 AS BIGINT) AS batch_id FROM F6""")
def batch_ids_shuffled(spark, sf):
    return lags.batch_ids(raw_series(spark, sf).select("District", "time"), 32, shuffle_seed=7)


@query(f"""WITH {R_SQL}, N AS (SELECT "District", CAST((row_number() OVER ({IN_ORDER}) - 1) // 32 AS BIGINT) AS batch_id FROM R)
SELECT "District", batch_id, count(*) AS n_rows FROM N GROUP BY 1, 2""")
def batch_sizes_shuffled(spark, sf):
    """A shuffle moves rows between batches but leaves the sizes of the batches."""
    shuffled = lags.batch_ids(raw_series(spark, sf).select("District", "time"), 32, shuffle_seed=7)
    return shuffled.groupBy("District", "batch_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"""WITH {R_SQL} SELECT {KEYTIME}, coalesce(lag(up, 2) OVER w, 0) AS x_0_0, coalesce(lag(down, 2) OVER w, 0) AS x_0_1,
  coalesce(lag(up, 1) OVER w, 0) AS x_1_0, coalesce(lag(down, 1) OVER w, 0) AS x_1_1 FROM R
  WINDOW w AS ({IN_ORDER}) QUALIFY row_number() OVER w > 2""")
def sequence_tensor(spark, sf):
    x = examples.sequences(raw_series(spark, sf), 2)
    return x.select("District", "time", *[F.col("x")[i][j].alias(f"x_{i}_{j}") for i in (0, 1) for j in (0, 1)])


def _examples(spark, sf):
    return examples.examples(raw_series(spark, sf), ["down", "up"], 3)


@query(f"""WITH {R_SQL} SELECT {KEYTIME}, """ + ", ".join(
    f"coalesce(lag({c}, {4 - i}) OVER w, 0) AS h_{i}_{c}" for i in range(3) for c in ("down", "up"))
    + f" FROM R WINDOW w AS ({IN_ORDER}) QUALIFY row_number() OVER w > 3")
def y_history(spark, sf):
    return _examples(spark, sf).select("District", "time", *[
        F.col("y_hist")[i][j].alias(f"h_{i}_{c}") for i in range(3) for j, c in enumerate(("down", "up"))])


@query(f"""WITH {R_SQL} SELECT {KEYTIME}, coalesce(lag(down, 3) OVER w, 0) AS oldest, coalesce(lag(up, 1) OVER w, 0) AS newest,
  {r('sin(2*pi()*hour(time)/24)', 'exog_0')}, {r('cos(2*pi()*minute(time)/60)', 'exog_3')}, down AS y_0, up AS y_1,
  CAST(3 AS INT) AS n_lags FROM R WINDOW w AS ({IN_ORDER}) QUALIFY row_number() OVER w > 3""", "examples")
def model_examples(spark, sf):
    return tidy(_examples(spark, sf).select(
        "District", "time", F.col("x")[0][1].alias("oldest"), F.col("x")[2][0].alias("newest"),
        F.col("exog")[0].alias("exog_0"), F.col("exog")[3].alias("exog_3"),
        F.col("y")[0].alias("y_0"), F.col("y")[1].alias("y_1"), F.size("x").alias("n_lags")))


STATS_SQL = {"mean": "list_avg(v)", "median": "list_median(v)", "std": "list_stddev_samp(v)",
             "variance": "list_var_samp(v)", "kurtosis": "list_kurtosis(v)", "skew": "list_skewness(v)",
             "gmean": "CASE WHEN list_min(v) > 0 THEN exp(list_avg(list_transform(v, lambda e: ln(e)))) WHEN list_min(v) = 0 THEN 0 END"}


@query(f"""WITH {R_SQL}, V AS (SELECT {KEYTIME}, [""" + ", ".join(f"coalesce(lag(down, {n}) OVER w, 0)" for n in range(1, 6))
    + f"] AS v FROM R WINDOW w AS ({IN_ORDER}) QUALIFY row_number() OVER w > 5) SELECT {KEYTIME}, "
    + ", ".join(r(e, f"{s}_down") for s, e in STATS_SQL.items()) + " FROM V")
def lag_stats(spark, sf):
    return tidy(examples.lag_statistics(raw_series(spark, sf), ["down"], 5))


# ------------------------------------------------------------------------ time features


def _cyclic_sql(value: str, period, name: str) -> str:
    return f"{r(f'sin(2*pi()*({value})/{period})', f'sin_{name}')}, {r(f'cos(2*pi()*({value})/{period})', f'cos_{name}')}"


@query(f"WITH {R_SQL} SELECT {KEYTIME}, {_cyclic_sql('hour(time)', 24, 'hour')}, {_cyclic_sql('minute(time)', 60, 'minute')} FROM R")
def cyclical_s(spark, sf):
    return tidy(timefeat.exogenous_time(raw_series(spark, sf)))


@query(f"""WITH {R_SQL} SELECT {KEYTIME}, down, up, {_cyclic_sql('hour(time)*60+minute(time)', 1440, 'minute')},
  {_cyclic_sql('isodow(time)-1', 7, 'dayofweek')}, {_cyclic_sql('dayofyear(time)', 365.25, 'dayofyear')} FROM R""")
def cyclical_p(spark, sf):
    return tidy(timefeat.with_time_features(raw_series(spark, sf)))


@query("""SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
  CAST(weekofyear(o_orderdate) AS INT) AS week, CAST(day(o_orderdate) AS INT) AS day,
  CAST(dayofyear(o_orderdate) AS INT) AS dayofyear, CAST(isodow(o_orderdate) - 1 AS INT) AS dayofweek FROM orders""")
def calendar_parts(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", *[timefeat.calendar_part("o_orderdate", p).alias(p) for p in
                                         ("year", "month", "week", "day", "dayofyear", "dayofweek")])


@query(f"""SELECT o_orderkey, {_cyclic_sql('month(o_orderdate)-1', 12, 'month')}, {_cyclic_sql('weekofyear(o_orderdate)', 52, 'week')},
  {_cyclic_sql('day(o_orderdate)-1', 31, 'day')}, {_cyclic_sql('dayofyear(o_orderdate)', 365, 'dayofyear')} FROM orders""")
def cyclical_all(spark, sf):
    orders = table(spark, sf, "orders")
    parts = orders.select("o_orderkey", *[timefeat.calendar_part("o_orderdate", p).alias(p)
                                          for p in ("month", "week", "day", "dayofyear")])
    return tidy(timefeat.to_cyclical(parts))


# --------------------------------------------------------------------------- statistics


@query(f"""WITH {G_SQL}, Q AS (SELECT count(*) AS n_rows, count(*) FILTER {GAP} AS rows_with_missing,
  CAST(3*count(*) - count(down) - count(up) - count(rb_down) AS BIGINT) AS missing_cells FROM G)
SELECT *, {r('rows_with_missing / n_rows * 100', 'pct_rows_missing')}, {r('missing_cells / (n_rows * 6) * 100', 'pct_cells_missing')} FROM Q""")
def quality_report(spark, sf):
    return tidy(profile.quality_report(gappy_series(spark, sf)))


U_SQL = L_SQL + ", U AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS v FROM L" for c in LINE) + ")"


@query(f"""WITH {U_SQL}, C AS (SELECT feature, v, count(*) AS m FROM U GROUP BY 1, 2),
O AS (SELECT feature, v AS mode FROM C QUALIFY row_number() OVER (PARTITION BY feature ORDER BY m DESC, v) = 1)
SELECT U.feature AS feature, {r('avg(v)', 'mean')}, {r('stddev_samp(v)', 'stdev')}, {r('median(v)', 'median')},
  {r('any_value(O.mode)', 'mode')}, {r('min(v)', 'min')}, {r('max(v)', 'max')},
  {r('CASE WHEN min(v) > 0 THEN exp(avg(CASE WHEN v > 0 THEN ln(v) END)) WHEN min(v) = 0 THEN 0 END', 'gmean')},
  {r('var_samp(v)', 'variance')}, {r('skewness(v)', 'skewness')}, {r('kurtosis(v)', 'kurtosis')},
  {r('quantile_cont(v, 0.1)', 'p10')}, {r('quantile_cont(v, 0.9)', 'p90')}
FROM U JOIN O USING (feature) GROUP BY U.feature""")
def stat_table(spark, sf):
    return tidy(profile.statistics(line_items(spark, sf)))


@query("SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY 1")
def value_counts(spark, sf):
    return profile.value_counts(table(spark, sf, "lineitem"), "l_quantity")


@query('SELECT DISTINCT event_type AS "District" FROM events')
def distinct_series(spark, sf):
    return profile.series_keys(raw_series(spark, sf))


@query(f"""WITH {R_SQL} SELECT count(*) AS n_rows, count(DISTINCT "District") AS n_series, min(time) AS first_time, max(time) AS last_time FROM R""")
def date_range(spark, sf):
    return profile.date_range(raw_series(spark, sf))


@query(f"""WITH {U_SQL} SELECT feature, 'double' AS type, count(v) AS count, {r('avg(v)', 'mean')}, {r('stddev_samp(v)', 'stdev')},
  {r('min(v)', 'min')}, {r('max(v)', 'max')}, {r('quantile_cont(v, 0.25)', 'p25')}, {r('quantile_cont(v, 0.5)', 'p50')},
  {r('quantile_cont(v, 0.75)', 'p75')} FROM U GROUP BY 1""")
def describe(spark, sf):
    return tidy(profile.describe(line_items(spark, sf)))


@query(f"""WITH {R_SQL} SELECT "District", count(*) AS n_rows, min(time) AS first_time, max(time) AS last_time,
  {r('quantile_cont(down, 0.25)', 'p25')}, {r('quantile_cont(down, 0.5)', 'p50')}, {r('quantile_cont(down, 0.75)', 'p75')}
FROM R GROUP BY 1""")
def skew_profile(spark, sf):
    return tidy(profile.skew_profile(raw_series(spark, sf), "down"))


ACF_LAGS = 15
ACF_SQL = f"""{R_SQL}, U AS (SELECT "District", time, 'down' AS feature, down AS v FROM R UNION ALL
  SELECT "District", time, 'up', up FROM R),
Z AS (SELECT *, v - avg(v) OVER (PARTITION BY "District", feature) AS z FROM U),
X AS (SELECT "District", feature, z, """ + ", ".join(f"lag(z, {k}) OVER w AS z{k}" for k in range(1, ACF_LAGS + 1)) + """
  FROM Z WINDOW w AS (PARTITION BY "District", feature ORDER BY time)),
A AS (SELECT "District", feature, count(*) AS n, [1.0::DOUBLE, """ + ", ".join(
    f"sum(z * z{k}) / sum(z * z)" for k in range(1, ACF_LAGS + 1)) + """] AS acf FROM X GROUP BY 1, 2)"""


@query(f"""WITH {ACF_SQL}, E AS (SELECT "District", feature, CAST(unnest(range(0, {ACF_LAGS + 1})) AS INT) AS lag,
  unnest(acf) AS v FROM A) SELECT "District", feature, lag, {r('v', 'acf')} FROM E""")
def acf(spark, sf):
    table_ = profile.autocorrelation(raw_series(spark, sf), ACF_LAGS)
    return tidy(table_.select("District", "feature", F.posexplode("acf").alias("lag", "acf")))


@query(ORACLES["acf"])
def acf_cut(spark, sf):
    rows = raw_series(spark, sf)
    table_ = profile.autocorrelation(rows, ACF_LAGS, layout=_cut(rows))
    return tidy(table_.select("District", "feature", F.posexplode("acf").alias("lag", "acf")))


@query(f"""WITH RECURSIVE {ACF_SQL},
D AS (SELECT "District", feature, n, acf, 1 AS k, [acf[2]] AS phi, acf[2] AS last FROM A
  UNION ALL SELECT "District", feature, n, acf, k + 1,
    list_append(list_transform(range(1, k + 1), lambda j: phi[j] - nxt * phi[k + 1 - j]), nxt), nxt
  FROM (SELECT *, (acf[k + 2] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * acf[k + 2 - j])))
    / (1 - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * acf[j + 1]))) AS nxt FROM D WHERE k < {ACF_LAGS}) q)
SELECT "District", feature, CAST(k AS INT) AS lag, {r('acf[k + 1]', 'acf')}, {r('last', 'pacf')},
  {r('1.96 / sqrt(n)', 'band')} FROM D
UNION ALL SELECT "District", feature, 0, 1.0, 1.0, {r('1.96 / sqrt(n)', 'band')} FROM A""")
def pacf(spark, sf):
    return tidy(profile.partial_autocorrelation(raw_series(spark, sf), ACF_LAGS))


@query(f"""WITH {G_SQL} SELECT "District", feature, time, value FROM (SELECT * FROM G)
  UNPIVOT INCLUDE NULLS (value FOR feature IN (down, up, rnti_count))""")
def trend_series(spark, sf):
    return profile.trends(gappy_series(spark, sf), ["down", "up", "rnti_count"])


@query(f"""WITH {R_SQL}, U AS (SELECT "District", time, 'down' AS feature, down AS v FROM R UNION ALL
  SELECT "District", time, 'up', up FROM R)
SELECT "District", feature, time_bucket(INTERVAL '6 hours', time) AS time, {r('avg(v)', 'value')} FROM U GROUP BY 1, 2, 3""")
def trend_downsampled(spark, sf):
    return tidy(profile.trends(raw_series(spark, sf), every="6 hours"))


# -------------------------------------------------------------------------- multivariate

PAIRS = [(a, b) for i, a in enumerate(LINE) for b in LINE[i + 1:]]


@query(f"WITH {L_SQL} " + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, {r(f'corr({a}, {b})', 'corr')} FROM L" for a, b in PAIRS))
def pearson_matrix(spark, sf):
    return tidy(multivar.pearson(line_items(spark, sf)))


def _dcor_sql(a: str, b: str, source: str = "L") -> str:
    return f"""SELECT '{a}' AS feature_x, '{b}' AS feature_y, {r('sqrt(xy / sqrt(xx * yy))', 'dcor')} FROM (
  WITH W AS (SELECT {a} AS x, {b} AS y, count(*)::DOUBLE AS w FROM {source} GROUP BY 1, 2),
  T AS (SELECT sum(w) AS n FROM W),
  I AS (SELECT i.w AS w, sum(j.w * abs(i.x - j.x)) / any_value(n) AS a, sum(j.w * abs(i.y - j.y)) / any_value(n) AS b,
    sum(j.w * abs(i.x - j.x) * abs(i.y - j.y)) / any_value(n) AS ab, sum(j.w * (i.x - j.x)^2) / any_value(n) AS aa,
    sum(j.w * (i.y - j.y)^2) / any_value(n) AS bb FROM W i, W j, T GROUP BY i.x, i.y, i.w),
  E AS (SELECT any_value(n) AS n, sum(w*a)/any_value(n) AS ma, sum(w*b)/any_value(n) AS mb, sum(w*ab)/any_value(n) AS mab,
    sum(w*aa)/any_value(n) AS maa, sum(w*bb)/any_value(n) AS mbb, sum(w*a*b)/any_value(n) AS pab, sum(w*a*a)/any_value(n) AS paa,
    sum(w*b*b)/any_value(n) AS pbb FROM I, T)
  SELECT mab - 2*pab + ma*mb AS xy, maa - 2*paa + ma*ma AS xx, mbb - 2*pbb + mb*mb AS yy FROM E)"""


# Prices in steps of 10,000: the SQL needs all pairs of different points.
@query(f"WITH {L_SQL}, D AS (SELECT * REPLACE (round(l_extendedprice / 10000) * 10000 AS l_extendedprice) FROM L) " + " UNION ALL ".join(
    _dcor_sql(a, b, "D") for a, b in PAIRS))
def dcor_discrete(spark, sf):
    rows = line_items(spark, sf)
    return tidy(multivar.distance_correlation(
        rows.withColumn("l_extendedprice", F.round(F.col("l_extendedprice") / 10000) * 10000)))


@query()
def dcor_matrix(spark, sf):
    return multivar.distance_correlation(line_items(spark, sf))


@query(f"""WITH {U_SQL}, S AS (SELECT feature, count(v) AS n, stddev_samp(v) * pow(count(v), -0.2) AS h, min(v) AS lo, max(v) AS hi
  FROM U GROUP BY 1),
B AS (SELECT feature, n, h, lo - 3*h AS g0, (hi + 3*h - (lo - 3*h)) / 199 AS dx FROM S),
C AS (SELECT feature, v, count(*) AS m FROM U GROUP BY 1, 2),
P AS (SELECT *, CAST(unnest(range(0, 200)) AS INT) AS point FROM B)
SELECT P.feature AS feature, point, {r('any_value(g0 + point*dx)', 'x')},
  {r('sum(m * exp(-0.5 * ((g0 + point*dx - v) / h)^2)) / any_value(n * h * sqrt(2*pi()))', 'density')}
FROM P JOIN C USING (feature) GROUP BY P.feature, point""")
def kde_curve(spark, sf):
    return tidy(multivar.density(line_items(spark, sf)))


def _bin_sql(c: str) -> str:
    return f"CAST(least(floor(({c} - (SELECT min({c}) FROM L)) / (((SELECT max({c}) FROM L) - (SELECT min({c}) FROM L)) / 50)), 49) AS BIGINT)"


@query(f"WITH {L_SQL}, B AS (SELECT " + ", ".join(f"{_bin_sql(c)} AS {c}" for c in LINE) + " FROM L) "
       + " UNION ALL ".join(f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, {a} AS bin_x, {b} AS bin_y, count(*) AS n FROM B GROUP BY {a}, {b}"
                            for a, b in PAIRS))
def scatter_bins(spark, sf):
    return multivar.scatter_bins(line_items(spark, sf))


RU_SQL = R_SQL + ", U AS (SELECT 'down' AS feature, down AS v FROM R UNION ALL SELECT 'up', up FROM R)"
PROFILE_SQL = {
    "statistics": ORACLES["stat_table"].replace(U_SQL, RU_SQL), "describe": ORACLES["describe"].replace(U_SQL, RU_SQL),
    "pearson": f"WITH {R_SQL} SELECT 'down' AS feature_x, 'up' AS feature_y, {r('corr(down, up)', 'corr')} FROM R",
    "pacf": ORACLES["pacf"],
    "trends": f"""WITH {R_SQL} SELECT "District", feature, time, value FROM (SELECT * FROM R) UNPIVOT INCLUDE NULLS (value FOR feature IN (down, up))""",
}


def _register_profile():
    """Tables of the exploration job over the raw series."""
    for name in PROFILE_SQL:
        def run(spark, sf, name=name):
            return tidy(jobs.profile_tables(raw_series(spark, sf), ACF_LAGS, names=[name])[name])
        query(PROFILE_SQL[name], f"profile_job_{name}")(run)


_register_profile()
PCA_COLS = LINE[:3]


@query(f"""WITH {L_SQL}, K AS (SELECT corr({PCA_COLS[0]}, {PCA_COLS[1]}) AS a, corr({PCA_COLS[0]}, {PCA_COLS[2]}) AS b,
  corr({PCA_COLS[1]}, {PCA_COLS[2]}) AS c FROM L), Q AS (SELECT *, sqrt((a*a + b*b + c*c) / 3) AS p FROM K),
F AS (SELECT p, acos(greatest(least(a*b*c / (p*p*p), 1), -1)) / 3 AS f FROM Q),
E AS (SELECT unnest([1, 2, 3]) AS component, unnest([1 + 2*p*cos(f), 1 + 2*p*cos(f + 4*pi()/3), 1 + 2*p*cos(f + 2*pi()/3)]) / 3 AS ratio FROM F)
SELECT CAST(component AS INT) AS component, {r('ratio')}, {r('sum(ratio) OVER (ORDER BY component)', 'cumulative')} FROM E""")
def pca_variance(spark, sf):
    return tidy(multivar.Components(line_items(spark, sf), PCA_COLS).variance(spark))


@query(f"""WITH N AS (SELECT l_extendedprice AS gross, l_extendedprice * (1 - l_discount) AS net FROM lineitem),
B AS (SELECT avg(gross) AS mg, stddev_pop(gross) AS sg, avg(net) AS mn, stddev_pop(net) AS sn, sign(corr(gross, net)) AS s FROM N),
Z AS (SELECT gross, net, (gross - mg) / sg AS g, s * (net - mn) / sn AS n FROM N, B)
SELECT {rs('gross', 'net')}, {r('abs(g + n) / sqrt(2)', 'pc_1')}, {r('abs(g - n) / sqrt(2)', 'pc_2')} FROM Z""")
def pca_project(spark, sf):
    """Two standardised features have the components (1, ±1)/√2; signs are left out."""
    price = F.col("l_extendedprice")
    rows = line_items(spark, sf).select(price.alias("gross"), (price * (1 - F.col("l_discount"))).alias("net"))
    scored = multivar.Components(rows).project(rows, 2)
    return tidy(scored.select("gross", "net", F.abs("PC_1").alias("pc_1"), F.abs("PC_2").alias("pc_2")))


@query(f"""WITH {L_SQL}, B AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_discount) AS md, stddev_pop(l_discount) AS sd,
  sign(corr(l_quantity, l_discount)) AS s FROM L),
D AS (SELECT l_quantity, l_discount, (l_quantity - mq) / sq + s * (l_discount - md) / sd AS "PC_1",
  (l_quantity - mq) / sq - s * (l_discount - md) / sd AS "PC_2" FROM L, B)
""" + " UNION ALL ".join(_dcor_sql(c, f"PC_{i}", "D") for c in ("l_quantity", "l_discount") for i in (1, 2)))
def pca_dcor_discrete(spark, sf):
    """Two features and their two components, which are their standardised sum and difference."""
    return tidy(multivar.component_correlation(line_items(spark, sf), ["l_quantity", "l_discount"]))


@query()
def pca_dcor(spark, sf):
    return multivar.component_correlation(line_items(spark, sf))


# ---------------------------------------------------------------- forecasts and metrics


@query(METRICS_SQL)
def metrics_overall(spark, sf):
    return tidy(metrics.metrics_overall(naive(spark, sf)))


def _dim_metrics(keys: str) -> str:
    return f"""SELECT {keys}, count(*) AS n, {r('avg((y_true - y_pred)^2)', 'mse')}, {r('sqrt(avg((y_true - y_pred)^2))', 'rmse')},
  {r('avg(abs(y_true - y_pred))', 'mae')}, {r('1 - avg((y_true - y_pred)^2) / var_pop(y_true)', 'r2')},
  {r('sqrt(avg((y_true - y_pred)^2)) / avg(y_true)', 'nrmse')} FROM P GROUP BY {keys}"""


@query(f"WITH {P_SQL} " + _dim_metrics("dim"))
def metrics_by_dim(spark, sf):
    return tidy(metrics.metrics_by_dim(naive(spark, sf)))


@query(f"WITH {P_SQL} " + _dim_metrics('"District", dim'))
def metrics_by_series(spark, sf):
    return tidy(metrics.metrics_by_dim(naive(spark, sf), ["District"]))


@query(f"""WITH {P_SQL} SELECT coalesce(dim, -1) AS dim, count(*) AS n, {r('avg((y_true - y_pred)^2)', 'mse')},
  {r('sqrt(avg((y_true - y_pred)^2))', 'rmse')}, {r('avg(abs(y_true - y_pred))', 'mae')} FROM P GROUP BY ROLLUP(dim)""")
def metrics_rollup(spark, sf):
    return tidy(metrics.dim_and_overall(naive(spark, sf)).na.fill(-1, ["dim"]))


@query(f"""WITH {P_SQL} SELECT {r('sqrt(avg((y_true - y_pred)^2)) / avg(y_true)', 'nrmse')} FROM P WHERE dim = 1""")
def nrmse(spark, sf):
    return tidy(metrics.metrics_overall(naive(spark, sf), dims=[1]).select("nrmse"))


@query(f"WITH {P_SQL} SELECT {KEYTIME}, y_true, y_pred, {r('y_true - y_pred', 'residual')} FROM P WHERE dim = 0")
def actual_vs_pred(spark, sf):
    return tidy(metrics.actual_vs_predicted(naive(spark, sf)))


AR1 = ForecastConfig(targets=("down",), features=("down",), n_lags=1)
AR1_SQL = f"""{R_SQL}, X AS (SELECT "District", time, down, coalesce(lag(down) OVER w, 0) AS x FROM R
  WINDOW w AS ({IN_ORDER}) QUALIFY row_number() OVER w > 1),
S AS (SELECT *, row_number() OVER ({IN_ORDER}) <= ceil(0.8::DOUBLE * count(*) OVER (PARTITION BY "District")) AS is_train FROM X),
B AS (SELECT regr_slope(down, x) AS b, regr_intercept(down, x) AS a FROM S WHERE is_train),
Y AS (SELECT {KEYTIME}, down AS y_true, a + b * x AS y_pred, is_train FROM S, B),
V AS (SELECT * FROM Y WHERE NOT is_train)"""


@query(f"WITH {AR1_SQL} SELECT {KEYTIME}, {rs('y_true', 'y_pred')} FROM V")
def fit_score_linear(spark, sf):
    scored = jobs.train_and_evaluate(ordered_series(spark, sf), AR1, TIES)[1]
    return tidy(scored.select("District", "time", F.get("y_true", 0).alias("y_true"), F.get("y_pred", 0).alias("y_pred")))


@query(f"""WITH {AR1_SQL} SELECT {r('avg((y_true - y_pred)^2)', 'mse')}, {r('sqrt(avg((y_true - y_pred)^2))', 'rmse')},
  {r('avg(abs(y_true - y_pred))', 'mae')}, {r('1 - avg((y_true - y_pred)^2) / var_pop(y_true)', 'r2')},
  {r('sqrt(avg((y_true - y_pred)^2)) / avg(y_true)', 'nrmse')} FROM V""")
def train_and_evaluate(spark, sf):
    return tidy(jobs.train_and_evaluate(ordered_series(spark, sf), AR1, TIES)[2])


@query(f"WITH {AR1_SQL}, P AS (SELECT *, 0 AS dim FROM V) " + _dim_metrics('"District", dim'))
def evaluate_by_series(spark, sf):
    """Held-out scores of each series and dimension."""
    scored = jobs.train_and_evaluate(ordered_series(spark, sf), AR1, TIES)[1]
    return tidy(metrics.metrics_by_dim(metrics.long_predictions(scored), ["District"]))


ARX = ForecastConfig(targets=("down",), features=("down",), exogenous=("sin_hour",), n_lags=1)


@query(f"""WITH {R_SQL}, X AS (SELECT "District", time, down, coalesce(lag(down) OVER w, 0) AS x, sin(2*pi()*hour(time)/24) AS z FROM R
  WINDOW w AS ({IN_ORDER}) QUALIFY row_number() OVER w > 1),
S AS (SELECT *, row_number() OVER ({IN_ORDER}) <= ceil(0.8::DOUBLE * count(*) OVER (PARTITION BY "District")) AS is_train FROM X),
C AS (SELECT covar_pop(x, x) AS xx, covar_pop(z, z) AS zz, covar_pop(x, z) AS xz, covar_pop(x, down) AS xy, covar_pop(z, down) AS zy,
  avg(x) AS mx, avg(z) AS mz, avg(down) AS my FROM S WHERE is_train),
B AS (SELECT (xy*zz - zy*xz) / (xx*zz - xz*xz) AS b, (zy*xx - xy*xz) / (xx*zz - xz*xz) AS c, mx, mz, my FROM C)
SELECT {KEYTIME}, {r('down', 'y_true')}, {r('my + b*(x - mx) + c*(z - mz)', 'y_pred')} FROM S, B WHERE NOT is_train""")
def fit_score_exogenous(spark, sf):
    """One lag and one time feature, fitted on the first part of each series and scored on the rest."""
    rows = ordered_series(spark, sf).withColumn("sin_hour", F.sin(2 * F.pi() * F.hour("time") / 24))
    scored = jobs.train_and_evaluate(rows, ARX, TIES)[1]
    return tidy(scored.select("District", "time", F.get("y_true", 0).alias("y_true"), F.get("y_pred", 0).alias("y_pred")))


@query()
def fit_score_gbt(spark, sf):
    config = ForecastConfig(targets=("down",), features=("down", "up"), n_lags=3, kind="gbt", max_iter=5)
    return jobs.train_and_evaluate(ordered_series(spark, sf), config, TIES)[1]


PENALTY = 0.5


@query(f"""WITH {AR1_SQL}, C AS (SELECT covar_pop(x, down) AS xy, var_pop(x) AS xx, avg(x) AS mx, avg(down) AS my FROM S WHERE is_train),
W AS (SELECT sign(xy) * greatest(abs(xy) - {2 * PENALTY} / 2, 0) / xx AS w, mx, my FROM C)
SELECT {KEYTIME}, {r('down', 'y_true')}, {r('my + w * (x - mx)', 'y_pred')} FROM S, W WHERE NOT is_train""")
def fit_score_norms(spark, sf):
    """Both plain norms as penalties; of one coefficient they are the same, and the fit has a closed form."""
    config = replace(AR1, norm1=PENALTY, norm2=PENALTY)
    scored = jobs.train_and_evaluate(ordered_series(spark, sf), config, TIES)[1]
    return tidy(scored.select("District", "time", F.get("y_true", 0).alias("y_true"), F.get("y_pred", 0).alias("y_pred")))


@query()
def fit_score_l1(spark, sf):
    """Absolute loss, two features with three lags each."""
    config = ForecastConfig(targets=("down",), features=("down", "up"), n_lags=3, loss="l1", norm1=0.01)
    return jobs.train_and_evaluate(ordered_series(spark, sf), config, TIES)[1]


@query()
def fit_rounds_patience(spark, sf):
    """Validation loss after each round of boosting up to the stop, and the round that is kept."""
    config = ForecastConfig(targets=("down",), features=("down", "up"), n_lags=3, kind="gbt", max_iter=8, patience=3)
    return fit_forecaster(ordered_series(spark, sf), config, TIES).rounds(spark)


@query(f"WITH {AR1_SQL} SELECT {KEYTIME}, {rs('y_pred')} FROM Y")
def model_round_trip(spark, sf):
    path = scratch_path(spark, "model")
    fit_forecaster(ordered_series(spark, sf), AR1, TIES).save(path)
    loaded: Forecaster = load_forecaster(spark, path)
    return tidy(loaded.score(ordered_series(spark, sf)).select("District", "time", F.get("y_pred", 0).alias("y_pred")))


# ------------------------------------------------------------------- downsampling, jobs


@query(f"WITH {M_SQL} SELECT * FROM M")
def downsample_2min(spark, sf):
    return grid_series(spark, sf)


@query("""SELECT event_type AS "District", date_trunc('hour', ts) AS time, max(value) AS down, min(value) AS up,
  CAST(count(*) AS DOUBLE) AS rnti_count FROM events GROUP BY 1, 2""")
def downsample_hourly(spark, sf):
    return windows.downsample(_events(spark, sf), every="1 hour", aggregates={
        "down": F.max("value"), "up": F.min("value"), "rnti_count": _n_events()})


BUCKET = """event_type AS "District", time_bucket(INTERVAL '1 hour', ts) AS time"""


@query(f"SELECT {BUCKET}, {r('avg(value)', 'value')} FROM events GROUP BY 1, 2")
def downsample_mean(spark, sf):
    return tidy(windows.downsample(_events(spark, sf), ["value"], "1 hour"))


@query(f"SELECT {BUCKET}, {r('var_pop(value) / nullif(avg(value)^2, 0)', 'value_var')} FROM events GROUP BY 1, 2")
def norm_variance(spark, sf):
    return tidy(windows.downsample(_events(spark, sf), every="1 hour",
                                   aggregates={"value_var": windows.normalised_variance("value")}))


@query(f"SELECT {BUCKET}, count(DISTINCT user_id) AS rnti_count FROM events GROUP BY 1, 2")
def user_counter(spark, sf):
    return windows.downsample(_events(spark, sf), every="1 hour", aggregates={"rnti_count": windows.user_count("user_id")})


@query(f"SELECT {BUCKET}, {r('sum(value * 1000) / 3600', 'down')} FROM events GROUP BY 1, 2")
def throughput(spark, sf):
    bits = _events(spark, sf).withColumn("tb_down", F.col("value") * 1000)
    return tidy(windows.downsample(bits, every="1 hour", aggregates={"down": windows.throughput("tb_down", 3600)}))


@query(f"""WITH {G_SQL} SELECT "District", count(*) AS n_windows, count(*) FILTER {GAP} AS n_dropped,
  CAST(2 * count(*) FILTER {GAP} AS DOUBLE) AS dropped_minutes FROM G GROUP BY 1""")
def dropped_minutes(spark, sf):
    return windows.dropped_minutes(gappy_series(spark, sf))


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
            .withColumnsRenamed({"event_type": "District", "ts": "time"}))


@query(f"SELECT {BUCKET}, count(DISTINCT user_id) AS rnti_count FROM events GROUP BY 1, 2")
def user_counter_stream(spark, sf):
    """Distinct users per hour of a stream over the table."""
    out = scratch_path(spark, "users")
    windows.count_users_stream(_event_stream(spark, sf), out, scratch_path(spark, "users-state"), "user_id", every="1 hour",
                               available_now=True).awaitTermination()
    return windows.read_user_counts(spark, out)


LATE_BEFORE = "2024-01-15 00:00:00"


@query(f"""SELECT {BUCKET}, count(*) AS n_rows, count(*) FILTER (ts >= TIMESTAMP '{LATE_BEFORE}') AS n_counted,
  count(*) FILTER (ts < TIMESTAMP '{LATE_BEFORE}') AS n_late FROM events GROUP BY 1, 2""")
def late_rows_stream(spark, sf):
    """A stream that reads the events' later parts first: the windows of the rest are closed by then.

    A batch drops rows by the watermark that the batch before it began with, so the first late rows come third.
    """
    rows = raw_series(spark, sf)
    source, out = scratch_path(spark, "late-source"), scratch_path(spark, "late-windows")
    at = [F.col("time") >= F.lit(t).cast("timestamp_ntz") for t in ("2024-01-20 00:00:00", LATE_BEFORE)]
    for part in (at[0], ~at[0] & at[1], ~at[1]):
        rows.where(part).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    windows.downsample_stream(stream, out, scratch_path(spark, "late-state"), every="1 hour", available_now=True).awaitTermination()
    return windows.late_by_window(rows, out, "1 hour")


@query(f"WITH {M_SQL} SELECT * FROM M")
def downsample_stream(spark, sf):
    """All windows of a stream over the table, the open ones included."""
    stream = _event_stream(spark, sf)
    out = scratch_path(spark, "stream")
    windows.downsample_stream(stream, out, scratch_path(spark, "stream-state"), available_now=True, aggregates={
        "down": F.max("value"), "up": F.min("value"), "rnti_count": _n_events()}).awaitTermination()
    return windows.read_windows(spark, out)


PREPARED_SQL = CLEAN_SQL + ", Z AS (SELECT District, time, " + ", ".join(
    f"({c} - (SELECT avg({c}) FROM C)) / (SELECT stddev_pop({c}) FROM C) AS {c}" for c in G_COLS) + " FROM C), T AS (" \
    + _time_lags_sql(range(1, 6), 5, "Z", G_COLS, wrap=lambda c: f"({c})") + ")"


@query(f"""WITH {PREPARED_SQL} SELECT *, {_cyclic_sql('hour(time)*60+minute(time)', 1440, 'minute')},
  {_cyclic_sql('isodow(time)-1', 7, 'dayofweek')}, {_cyclic_sql('dayofyear(time)', 365.25, 'dayofyear')} FROM T""")
def prepare_job(spark, sf):
    return tidy(jobs.prepare(gappy_series(spark, sf), period_us=2 * MINUTE_US))


MODAL_SQL = PREPARED_SQL[:PREPARED_SQL.index(", T AS (")] + f""",
D AS (SELECT "District", epoch_us(time) - lag(epoch_us(time)) OVER ({IN_ORDER}) AS step FROM Z),
MO AS (SELECT "District", step FROM D WHERE step IS NOT NULL GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY "District" ORDER BY count(*) DESC, step) = 1),
T AS (SELECT b."District" AS "District", b.time AS time, """ + ", ".join(
    [r(f"b.{c}", c) for c in G_COLS] + [r(f"l{n}.{c}", f"{c}_lag_{n}") for n in range(1, 6) for c in G_COLS]) + f"""
FROM (SELECT *, row_number() OVER ({IN_ORDER}) AS rn FROM Z) b LEFT JOIN MO ON MO."District" = b."District" """ + " ".join(
    f"""LEFT JOIN Z l{n} ON l{n}."District" = b."District" AND epoch_us(l{n}.time) = epoch_us(b.time) - {n} * MO.step"""
    for n in range(1, 6)) + " WHERE b.rn > 5)"


@query(f"""WITH {MODAL_SQL} SELECT *, {_cyclic_sql('hour(time)*60+minute(time)', 1440, 'minute')},
  {_cyclic_sql('isodow(time)-1', 7, 'dayofweek')}, {_cyclic_sql('dayofyear(time)', 365.25, 'dayofyear')} FROM T""")
def prepare_csv_job(spark, sf):
    """The preprocessing job from CSV to CSV, lags at each series' own modal period."""
    source = scratch_path(spark, "raw-csv")
    tables.write_csv(gappy_series(spark, sf), source)
    return tidy(jobs.prepare_csv(spark, source, scratch_path(spark, "prepared-csv")))


@query(f"""WITH {M_SQL} SELECT {KEYTIME}, down, up, rnti_count, """ + ", ".join(
    f"coalesce(lag({c}, {n}) OVER w, 0) AS {c}_lag_{n}" for n in (1, 2, 3) for c in ("down", "up", "rnti_count"))
    + f""", {_cyclic_sql('hour(time)*60+minute(time)', 1440, 'minute')}, {_cyclic_sql('isodow(time)-1', 7, 'dayofweek')},
  {_cyclic_sql('dayofyear(time)', 365.25, 'dayofyear')} FROM M
  WINDOW w AS ({IN_ORDER}) QUALIFY row_number() OVER w > 3""")
def flagship(spark, sf):
    """Scan, two-minute downsample, three row lags per series, cyclical time features."""
    lagged = lags.row_lags(stage(grid_series(spark, sf), "downsample"), 3, keep="both")
    return tidy(timefeat.with_time_features(lagged))
