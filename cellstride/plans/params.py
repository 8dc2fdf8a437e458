"""Fitted parameters: small tables that are computed once and joined back to the rows.

The number of parameter rows follows the number of series, which nobody has promised to be
small.  ``settle`` therefore measures it: a table of up to ``MAX_BYTES`` becomes a local relation
that is broadcast; beyond that it is checkpointed and joined on (key, salt), so that a series
holding a third of the rows is still spread over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import scratch_root

MAX_BYTES = 32 << 20
SALTS = 64   # at least; as many as the session has shuffle partitions, so that a hot key reaches all tasks


@dataclass(frozen=True)
class Settled:
    """A parameter table whose size is known to be small (``bounded``) or not."""

    df: DataFrame
    bounded: bool
    local: pa.Table | None = None

    @property
    def empty(self) -> bool:
        return self.bounded and self.local.num_rows == 0

    def one(self) -> dict:
        """The only row of a table fitted without a key."""
        return self.local.slice(0, 1).to_pylist()[0]

    def distinct(self, column: str) -> list:
        return self.local[column].unique().to_pylist()


def settle(params: DataFrame, max_bytes: int | None = None) -> Settled:
    """Run a parameter query once and keep its result, locally only if it is provably small."""
    max_bytes = MAX_BYTES if max_bytes is None else max_bytes
    spark = params.sparkSession
    most = max(1, max_bytes // _row_bytes(params.schema))
    head = params.limit(most + 1).toArrow()
    if head.num_rows <= most and head.nbytes <= max_bytes:
        return Settled(spark.createDataFrame(head, schema=params.schema), True, head)
    scratch_root(spark)
    return Settled(params.checkpoint(), False)


def _row_bytes(kind: T.DataType) -> int:
    """A low estimate of a row, so that the row limit does not undercut the byte limit."""
    if isinstance(kind, T.StructType):
        return sum(_row_bytes(f.dataType) for f in kind)
    return 8


def attach(df: DataFrame, params: Settled, keys: list[str], spread_by: list[str],
           how: str = "left") -> DataFrame:
    """Join parameters to rows on ``keys`` without moving rows when the parameters are small.

    ``spread_by`` names row columns whose hash splits a hot key in the large-parameter case.
    """
    if params.bounded:
        return df.join(F.broadcast(params.df), keys, how)
    salts = max(SALTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    salted = params.df.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return df.withColumn("__salt", salt).join(salted, [*keys, "__salt"], how).drop("__salt")
