"""Small tables and comparisons for tests."""

from __future__ import annotations

import datetime as dt

import numpy as np

EPOCH = dt.datetime(2018, 3, 28)


def series_table(spark, sizes=None, seed=1, missing=0.2, step_s=120, gaps=0.1):
    """Irregular keyed series with missing cells; one series holds most of the rows."""
    rng = np.random.default_rng(seed)
    rows = []
    for key, n in (sizes or {"north": 400, "east": 60, "south": 7, "west": 1}).items():
        at = 0
        for _ in range(n):
            at += step_s * (1 + int(rng.random() < gaps) * int(rng.integers(1, 6)))
            cells = [None if rng.random() < missing else float(np.round(rng.gamma(2, 10), 2)) for _ in range(3)]
            rows.append((key, EPOCH + dt.timedelta(seconds=at), *cells))
    order = rng.permutation(len(rows))
    return spark.createDataFrame([rows[i] for i in order],
                                 "District string, time timestamp_ntz, down double, up double, rnti_count double")


def rows_of(df, digits=9):
    """Rows as sorted tuples, columns by name, doubles rounded."""
    def plain(v):
        if isinstance(v, float):
            return round(v, digits) + 0.0
        if isinstance(v, list):
            return tuple(plain(x) for x in v)
        return v
    names = sorted(df.columns)
    return sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
