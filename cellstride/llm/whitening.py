"""Whitening of vectors: leading eigenpairs of the covariance by spectrum slicing and Rayleigh quotient iteration."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sources.staging import stage
from . import common

COMPONENTS = 32
#: Grid of the entries: x = floor(SCALE * c) + OFFSET.  Finite entries beyond LARGEST count as LARGEST.
SCALE, OFFSET, LARGEST = 64, 1_000_000, float(1 << 40)
#: The covariance goes to the driver, so the length of the vectors is bounded.
MAX_DIM = 2048
#: Entries a task works on at a time.
BLOCK = 1 << 20
EPS = float(np.finfo(np.float64).eps)


# ------------------------------------------------------------------- eigenpairs of a small matrix


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues exceed ``shift``: the positive pivots of LDLᵀ of the shifted matrix (Sylvester's law).

    Pivots are chosen as by Bunch and Kaufman, so an indefinite matrix does no harm; a pair of rows taken together
    always has one positive and one negative eigenvalue.
    """
    a = matrix - shift * np.eye(len(matrix))
    bound = (1 + 17 ** 0.5) / 8
    positive = k = 0
    n = len(a)

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j], k:] = a[[j, i], k:]
            a[k:, [i, j]] = a[k:, [j, i]]

    while k < n:
        column = np.abs(a[k + 1:, k])
        here = abs(a[k, k])
        most = float(column.max()) if len(column) else 0.0
        pair = False
        if max(here, most) == 0:  # an eigenvalue equal to the shift is not above it
            k += 1
            continue
        if here < bound * most:
            r = k + 1 + int(column.argmax())
            others = np.abs(a[r, k:])
            others[r - k] = 0
            row = float(others.max())
            if here * row < bound * most * most:
                pair = abs(a[r, r]) < bound * row
                swap(r, k + 1 if pair else k)
        if pair:
            positive += 1
            c = a[k + 2:, k:k + 2]
            a[k + 2:, k + 2:] -= c @ np.linalg.solve(a[k:k + 2, k:k + 2], c.T)
            k += 2
        else:
            positive += a[k, k] > 0
            c = a[k + 1:, k]
            a[k + 1:, k + 1:] -= np.outer(c, c / a[k, k])
            k += 1
    return int(positive)


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray, scale: float) -> np.ndarray:
    shifted = matrix - shift * np.eye(len(matrix))
    try:
        return np.linalg.solve(shifted, right)
    except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last digit
        return np.linalg.solve(shifted + EPS * scale * np.eye(len(matrix)), right)


def _against(v: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """``v`` made orthogonal to the unit vectors found, twice for the rounding of the first time."""
    for _ in range(2 if found else 0):
        q = np.stack(found, 1)
        v = v - q @ (q.T @ v)
    return v


def _rayleigh(matrix: np.ndarray, low: float, high: float, found: list[np.ndarray], scale: float,
              draw: np.random.Generator) -> tuple[float, np.ndarray] | None:
    """The eigenpair of the one eigenvalue in (low, high], or None if the iteration left the interval."""
    v = _against(draw.standard_normal(len(matrix)), found)
    middle = (low + high) / 2
    for _ in range(2):  # inverse iteration turns the start towards the interval's vector
        v = _against(_solve(matrix, middle, v / np.linalg.norm(v), scale), found)
    v /= np.linalg.norm(v)
    value, before = float(v @ matrix @ v), np.inf
    for _ in range(30):
        gap = float(np.linalg.norm(matrix @ v - value * v))
        if gap <= 4 * EPS * scale or gap >= before and gap <= 1e3 * EPS * scale:
            break
        before = min(gap, before)
        v = _solve(matrix, value, v, scale)
        v = v / np.linalg.norm(v)
        value = float(v @ matrix @ v)
    return (value, v) if gap <= 1e3 * EPS * scale and low < value <= high else None


def _cluster(matrix: np.ndarray, middle: float, m: int, found: list[np.ndarray], scale: float,
             draw: np.random.Generator) -> list[tuple[float, np.ndarray]]:
    """``m`` eigenpairs whose values agree to rounding: any basis of their space serves."""
    out: list[tuple[float, np.ndarray]] = []
    for _ in range(m):
        taken = found + [v for _, v in out]
        v = draw.standard_normal(len(matrix))
        for _ in range(4):
            v = _against(v / np.linalg.norm(v), taken)
            v = _against(_solve(matrix, middle + 8 * EPS * scale, v / np.linalg.norm(v), scale), taken)
        v /= np.linalg.norm(v)
        out.append((float(v @ matrix @ v), v))
    return sorted(out, key=lambda p: -p[0])


def leading_eigenpairs(matrix: np.ndarray, k: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a covariance, falling, and their unit vectors as columns.

    Inertia counts halve intervals until each holds one of the k eigenvalues (or several that agree to rounding); Rayleigh
    quotient iteration, started by inverse iteration in the interval, converges cubically; counts on both sides of each
    value found certify its number.  Values at rounding level beside the largest are left out, so fewer may come
    back.  The entry of a vector that is largest by size is positive.
    """
    n = len(matrix)
    scale = float(np.abs(matrix).sum(1).max()) if n else 0.0
    k = min(k, n)
    if not scale or not k:
        return np.zeros(0), np.zeros((n, 0))
    draw = np.random.default_rng(seed)
    floor = n * EPS * scale
    counts: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = count_above(matrix, shift)
        return counts[shift]

    found: list[tuple[float, np.ndarray]] = []
    todo = [(floor, scale * (1 + 4 * EPS) + floor)]
    while todo:  # the upper part of an interval is always done first, so values come falling
        low, high = todo.pop()
        first, last = above(high) + 1, min(above(low), k)
        if first > last:
            continue
        vectors = [v for _, v in found]
        if above(low) == first:
            pair = _rayleigh(matrix, low, high, vectors, scale, draw)
            if pair is not None and np.abs(_against(pair[1], vectors) - pair[1]).max() < 1e-6:
                v = _against(pair[1], vectors)
                v /= np.linalg.norm(v)
                found.append((float(v @ matrix @ v), v))
                continue
        middle = (low + high) / 2
        if high - low <= 64 * EPS * scale or not low < middle < high:
            found += _cluster(matrix, middle, last - first + 1, vectors, scale, draw)
            continue
        todo += [(low, middle), (middle, high)]
    found = found[:k]
    slack = 1e4 * EPS * scale
    for number, (value, _) in enumerate(found, 1):
        if not above(value + slack) < number <= above(value - slack):
            raise ArithmeticError(f"eigenvalue {number} is not certified")
    values = np.array([e for e, _ in found])
    columns = np.stack([v * np.sign(v[np.abs(v).argmax()]) for _, v in found], 1) if found else np.zeros((n, 0))
    return values, columns


# ------------------------------------------------------------------------------- distributed sums


def _rows(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows of a list column that take part (length ``dim``, all entries finite) and their entries."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == dim)
    if not len(at) or not dim:
        return np.zeros(0, np.int64), np.zeros((0, dim))
    values = column.take(pa.array(at)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)
    fine = np.isfinite(values).all(1)  # a null entry arrives as NaN
    return at[fine], values[fine]


def on_grid(values: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(SCALE * np.clip(values, -LARGEST, LARGEST), -LARGEST, LARGEST)).astype(np.int64) + OFFSET


def _blocks(batches: Iterator[pa.RecordBatch], vec_col: str, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches, less the rows that take no part, with the grid values of the rest."""
    step = max(1, BLOCK // max(dim, 1))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            at, values = _rows(part.column(part.schema.get_field_index(vec_col)), dim)
            if len(at):
                yield part.take(pa.array(at)), on_grid(values)


def _grid_sums(df: DataFrame, vec_col: str) -> DataFrame:
    """(dim, pos, n, s): exact sums of the grid values, by the vectors' length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            column = batch.column(0)
            for dim in np.unique(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)):
                if not dim:
                    continue
                held = sums.setdefault(int(dim), [0, np.zeros(dim, object)])
                step = max(1, BLOCK // int(dim))
                for start in range(0, batch.num_rows, step):
                    x = on_grid(_rows(column.slice(start, step), int(dim))[1])
                    held[0] += len(x)
                    held[1] += x.sum(0).astype(object)
        for dim, (n, total) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()),
                 pa.array([Decimal(int(s)) for s in total], pa.decimal128(38, 0))], ["dim", "pos", "n", "s"])

    parts = df.select(F.col(f"`{vec_col}`").alias("v")).mapInArrow(run, "dim int, pos int, n bigint, s decimal(38,0)")
    return parts.groupBy("dim", "pos").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


def _total(df: DataFrame, vec_col: str, dim: int, shape: tuple[int, ...], of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of ``of(grid values of a block)``, an array of ``shape``.

    A task gives one row per matrix row; entries are added by position, so no task holds more than its share of them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for _, x in _blocks(batches, vec_col, dim):
            total += of(x)
        flat = total.reshape(shape[0], -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(shape[0]), pa.int32()), pa.array(list(flat))], ["i", "row"])

    parts = df.select(f"`{vec_col}`").mapInArrow(run, "i int, row array<double>")
    sums = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(shape).reshape(shape[0], -1)
    out[sums["i"].to_numpy(), sums["j"].to_numpy()] = sums["v"].to_numpy()
    return out.reshape(shape)


# ------------------------------------------------------------------------------------- whitening


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: n vectors of length ``dim``, their sums, eigenvalues (falling) and unit vectors (columns)."""

    dim: int
    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else self.values

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - np.array([s / self.n for s in self.sums])

    def apply(self, x: np.ndarray) -> np.ndarray:
        """x-S/n, projected on the components, over the roots of their eigenvalues."""
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Σ (n·x − S)² of each row, exact; None where it exceeds a long."""
        largest = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if largest < 1 << 62:
            y = self.n * x - np.array(self.sums, np.int64)
            if self.dim * int(np.abs(y).max(initial=0)) ** 2 < 1 << 63:
                return (y * y).sum(1).tolist()
        y = self.n * x.astype(object) - np.array(self.sums, object)
        return [d if d < 1 << 63 else None for d in (y * y).sum(1)]


def fit(df: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """The whitening of all usable vectors of ``df``.

    Vectors that are null or hold null or non-finite entries take no part; the length that most of the others share
    (the longer one of a tie) is the dimension, and vectors of another length take no part either.  Three reads: exact sums, then
    products of the centred values; only one dimension x dimension matrix comes to the driver.  Without usable
    vectors, or if all are equal, there are no components.  Repeated rows count each.  A dimension above ``MAX_DIM`` is refused.
    """
    sums = stage(_grid_sums(df, vec_col), "grid-sums")
    most = sums.where("pos = 0 and n > 0").orderBy(F.desc("n"), F.desc("dim")).first()
    if most is None:
        return Whitening(0, 0, (), 0.0, np.zeros(0), np.zeros((0, 0)))
    dim, n = most["dim"], most["n"]
    if dim > MAX_DIM:
        raise ValueError(f"vectors of {dim} entries; at most {MAX_DIM}")
    total = tuple(int(r["s"]) for r in sums.where(F.col("dim") == dim).orderBy("pos").collect())
    mean = np.array([s / n for s in total])

    def products(x: np.ndarray) -> np.ndarray:
        c = x - mean
        return c.T @ c

    covariance = _total(df, vec_col, dim, (dim, dim), products) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_eigenpairs(covariance, components)
    return Whitening(dim, n, total, float(np.trace(covariance)), values, vectors)


def identity_error(df: DataFrame, fitted: Whitening, vec_col: str = "embedding") -> float | None:
    """The largest absolute entry of the whitened vectors' covariance minus the identity; None without components."""
    k = len(fitted.values)
    if not k:
        return None
    mean = _total(df, vec_col, fitted.dim, (1, k), lambda x: fitted.apply(x).sum(0, keepdims=True)) / fitted.n

    def products(x: np.ndarray) -> np.ndarray:
        c = fitted.apply(x) - mean
        return c.T @ c

    return float(np.abs(_total(df, vec_col, fitted.dim, (k, k), products) / fitted.n - np.eye(k)).max())


def transform(df: DataFrame, fitted: Whitening, vec_col: str = "embedding") -> DataFrame:
    """The rows of ``df`` whose vectors take part, with ``deviation`` and ``whitened`` (one entry per component).

    Which rows take part: see ``fit``.  Null ids, ties and repeated rows are rows like others.  Columns of ``df`` named
    deviation or whitened are replaced; an empty table gives an empty result.
    """
    rest = common.without(df, *[c for c in ("deviation", "whitened") if c != vec_col])
    source, target = "vector", [c for c in rest.columns if c not in ("deviation", "whitened")]
    packed = rest.select(F.struct(*[F.col(f"`{c}`") for c in target]).alias("row") if target else F.lit(0).alias("row"),
                         F.col(f"`{vec_col}`").alias(source))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, source, fitted.dim):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(fitted.deviation(x), pa.int64()),
                 pa.array(list(fitted.apply(x)), pa.list_(pa.float64()))], ["row", "deviation", "whitened"])

    schema = T.StructType([packed.schema["row"], T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    done = packed.mapInArrow(run, schema)
    return done.select(*[F.col("row")[c].alias(c) for c in target], "deviation", "whitened")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    fitted = fit(rows)
    error = identity_error(rows, fitted)
    explained = F.array(*[F.lit(float(e)) for e in fitted.explained]).cast("array<double>")
    return transform(rows, fitted).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
