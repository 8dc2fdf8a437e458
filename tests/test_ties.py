"""Queries that go by rows, on events of which several share an instant."""

import duckdb
import pytest

from cellstride import catalog
from helpers import rows_of

COPIES = 3
#: Held-out rows of the fits without SQL, which look three rows back.
HELD_OUT = f"""WITH {catalog.R_SQL}, X AS (SELECT "District", time, event_id, down FROM R QUALIFY row_number() OVER ({catalog.IN_ORDER}) > 3),
S AS (SELECT *, row_number() OVER ({catalog.IN_ORDER}) <= ceil(0.8::DOUBLE * count(*) OVER (PARTITION BY "District")) AS is_train FROM X)
SELECT "District", time, down AS y_true FROM S WHERE NOT is_train"""
NAMES = [
    "fit_score_l1",
    "evaluate_by_series",
    "exogenous_by_area",
    "fit_rounds_patience",
    "fit_score_exogenous",
    "fit_score_gbt",
    "fit_score_linear",
    "fit_score_norms",
    "model_round_trip",
    "scale_train_val",
    "skip_rows",
    "split_cut",
    "split_report",
    "train_and_evaluate",
    "train_val_split",
    "union_split",
]


@pytest.fixture(scope="module")
def tied(small, tmp_path_factory):
    """The events several times over: the same instants, other numbers, users and values, in no order."""
    path = tmp_path_factory.mktemp("tied")
    duckdb.sql(f"""COPY (SELECT * EXCLUDE i REPLACE (event_id * {COPIES} + i AS event_id, user_id + i AS user_id, value * (1 + i) AS value)
      FROM '{small}/events.parquet', (SELECT unnest(range({COPIES})) AS i) ORDER BY hash(event_id, i))
      TO '{path}/events.parquet' (FORMAT parquet)""")
    return str(path)


def definite(sql: str) -> str:
    """The SQL with the event's number behind the time, so that no order is left open."""
    return (sql.replace("AS up FROM events", "AS up, event_id FROM events").replace("ORDER BY time", "ORDER BY time, event_id")
            .replace('X AS (SELECT "District", time, down', 'X AS (SELECT "District", time, event_id, down'))


@pytest.mark.parametrize("name", NAMES)
def test_rows_of_one_instant(spark, tied, name):
    got = catalog.QUERIES[name](spark, tied)
    if name == "fit_rounds_patience":
        assert got.where("kept").count() == 1
        return
    if name not in catalog.ORACLES:
        got = got.selectExpr("District", "time", "y_true[0] AS y_true")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tied}/events.parquet'")
    result = con.execute(definite(catalog.ORACLES.get(name, HELD_OUT)))
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(got.columns)
    at = [columns.index(c) for c in sorted(columns)]

    def plain(v):
        return round(float(v), 6) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    expected = sorted((tuple(plain(row[i]) for i in at) for row in result.fetchall()), key=repr)
    assert sorted((tuple(plain(v) for v in row) for row in rows_of(got, 12)), key=repr) == expected
