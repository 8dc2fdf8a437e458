"""Calendar parts and cyclical time features."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame, functions as F

from ..series import SeriesSpec

SPEC = SeriesSpec()

# Period of each calendar part, and the parts that count from 1.
PERIODS = {"month": 12, "week": 52, "day": 31, "hour": 24, "minute": 60, "dayofyear": 365, "dayofweek": 7}
FROM_ONE = ("month", "day")
# Periods of the preprocessing job, which counts minutes over the whole day.
JOB_PERIODS = {"minute": 1440, "dayofweek": 7, "dayofyear": 365.25}


def calendar_part(time: str, part: str) -> Column:
    """One calendar part of a time column; Monday is 0, the first of January is day 1."""
    parts = {"year": F.year, "month": F.month, "week": F.weekofyear, "day": F.dayofmonth,
             "hour": F.hour, "minute": F.minute, "dayofyear": F.dayofyear, "dayofweek": F.weekday,
             "minute_of_day": lambda t: F.hour(t) * 60 + F.minute(t)}
    return parts[part](time)


def cyclical(value: Column, period: float, start: int = 0) -> tuple[Column, Column]:
    """Sine and cosine of the position in the period."""
    angle = (value - F.lit(start)) * F.lit(2 * pi / period)
    return F.sin(angle), F.cos(angle)


def to_cyclical(df: DataFrame, periods: dict[str, float] = PERIODS) -> DataFrame:
    """Replace each column named in ``periods`` by its ``sin_``/``cos_`` pair."""
    out = []
    for c in df.columns:
        if c in periods:
            sine, cosine = cyclical(F.col(c), periods[c], 1 if c in FROM_ONE else 0)
            out += [sine.alias(f"sin_{c}"), cosine.alias(f"cos_{c}")]
        else:
            out.append(F.col(c))
    return df.select(*out)


def exogenous_time(df: DataFrame, parts: tuple[str, ...] = ("hour", "minute"),
                   spec: SeriesSpec = SPEC) -> DataFrame:
    """Key, time and the cyclical pairs of the chosen calendar parts; other inputs go."""
    keep = [*spec.keys, spec.time]
    return to_cyclical(df.select(*keep, *[calendar_part(spec.time, p).alias(p) for p in parts]))


def with_time_features(df: DataFrame, spec: SeriesSpec = SPEC) -> DataFrame:
    """Append minute of day, weekday and day of year as cyclical pairs."""
    parts = {"minute": "minute_of_day", "dayofweek": "dayofweek", "dayofyear": "dayofyear"}
    extra = []
    for name, part in parts.items():
        sine, cosine = cyclical(calendar_part(spec.time, part), JOB_PERIODS[name])
        extra += [sine.alias(f"sin_{name}"), cosine.alias(f"cos_{name}")]
    return df.select("*", *extra)
