"""Keyed time series on Spark: load, profile, clean, scale, lag, fit and score."""

from .series import SeriesSpec
from .session import build_session

__all__ = ["SeriesSpec", "build_session"]
