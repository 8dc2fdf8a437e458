"""Exact distance correlation without pairs of rows: dominance sums by divide and conquer on key ranges."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from ..sources.staging import Scratch

BLOCK_ROWS, MOST_BLOCK_ROWS = 50_000, 500_000     # points of a block, for small and for large tables
BLOCKS = 1_024                                    # blocks of a column between these sizes: their grid has a million cells
OWN_BLOCK = 4_096                                 # a value with more than one part in so many of the points is a block of its own
CELLS = 1 << 22                                   # grid cells that one task works on
CHUNK = 1 << 18                                   # points a task looks at together
BUNDLE = 50_000                                   # points of frequent values that travel together
CELL = "pair int, bx bigint, by bigint, w double, wx double, wy double, wxy double"
SUMS = [x.split()[0] for x in CELL.split(", ")]
MEAN, SQUARE, CROSS, MET = range(4)               # what the rows of pair −1 hold, as bx; by is the column or pair


@dataclass(frozen=True)
class Axis:
    """Ranges of one column's values, rising: lowest value, rows and sum of values below it and in it, whether it has one value."""

    low: np.ndarray
    rows_below: np.ndarray
    sum_below: np.ndarray
    rows: np.ndarray
    sums: np.ndarray
    single: np.ndarray

    @property
    def total(self) -> tuple[float, float]:
        return float(self.rows.sum()), float(self.sums.sum())

    def block(self, values: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, values, "right") - 1

    def mean_distance(self, values: np.ndarray, rows_upto: np.ndarray, sum_upto: np.ndarray) -> np.ndarray:
        """Mean distance of values to all rows, given count and sum of the rows up to each."""
        n, total = self.total
        return (values * (2 * rows_upto - n) + total - 2 * sum_upto) / n

    def mean_of_single(self, values: np.ndarray, block: np.ndarray) -> np.ndarray:
        return self.mean_distance(values, (self.rows_below + self.rows)[block], (self.sum_below + self.sums)[block])

    def mean_in_block(self, values: np.ndarray, w: np.ndarray, block: int) -> np.ndarray:
        at = np.argsort(values, kind="stable")
        out = np.empty(len(values))
        out[at] = self.mean_distance(values[at], self.rows_below[block] + np.cumsum(w[at]),
                                     self.sum_below[block] + np.cumsum((w * values)[at]))
        return out


def dominance(order: np.ndarray, y: np.ndarray, terms: np.ndarray, sums: bool = True) -> float:
    """Σ over pairs p, q with order_p < order_q and y_p < y_q of w_p·w_q·(x_q−x_p)·(y_q−y_p).

    ``terms`` are the rows w, w·x, w·y, w·x·y.  Halving by the bits of the rank in ``order``: at each bit, points in
    the upper half of a group meet the prefix sums, along y, of its lower half; points are kept in the order of (group, y).
    Points (not ``sums`` of several) that share y add nothing, so their prefix sums need not stop short of each other.
    """
    n = len(y)
    if not n:
        return 0.0
    rank = np.unique(order, return_inverse=True)[1].astype(np.int32)
    at = np.argsort(y, kind="stable")
    rank, terms = rank[at], terms[:, at]
    if sums:
        y = np.unique(y, return_inverse=True)[1][at]
    lower, total = np.zeros((4, n + 1)), 0.0
    for bit in reversed(range(int(rank.max()).bit_length())):
        group, upper = rank >> (bit + 1), (rank >> bit & 1).astype(bool)
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        here = np.flatnonzero(upper)
        seen = np.searchsorted(here, np.append(starts, n))
        np.cumsum(np.where(upper, 0.0, terms), axis=1, out=lower[:, 1:])
        upto = here
        if sums:
            runs = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (y[1:] != y[:-1])))
            upto = runs[np.searchsorted(runs, here, "right") - 1]
        met = lower[:, upto] - np.repeat(lower[:, starts], np.diff(seen), axis=1)
        own = terms[:, here]
        total += float(met[0] @ own[3] - met[2] @ own[1] - met[1] @ own[2] + met[3] @ own[0])
        if bit:
            moved = np.argsort(rank >> bit, kind="stable")
            rank, terms = rank[moved], terms[:, moved]
            if sums:
                y = y[moved]
    return total


def _point_terms(w: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.stack([w, w * x, w * y, w * x * y])


def _column(table: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    return table.column(name).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table[name].to_numpy()


def _axes(points: DataFrame, cuts: list[np.ndarray], pairs: list[tuple[int, int]]) -> tuple[list[Axis], np.ndarray, np.ndarray]:
    """The ranges between the cuts of every column that hold points, the sum of its squares, and that of each pair's products.

    A task sums up by range, so what is moved follows the ranges.
    """
    sent = points.sparkSession.sparkContext.broadcast(cuts)
    m = len(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts_ = sent.value
        found = [(np.zeros(len(x) + 1), np.zeros(len(x) + 1), np.full(len(x) + 1, np.inf), np.full(len(x) + 1, -np.inf)) for x in cuts_]
        products = np.zeros(m + len(pairs))
        for batch in _chunks(batches):
            w, v = _column(batch, "__w"), [_column(batch, f"__v{i}") for i in range(m)]
            for i, (rows, sums, low, high) in enumerate(found):
                at = np.argsort(v[i])
                x, count = v[i][at], w[at]
                edges = np.concatenate([[0], np.searchsorted(x, cuts_[i]), [len(x)]])
                held = np.flatnonzero(np.diff(edges))
                begins = edges[held]
                rows[held] += np.add.reduceat(count, begins)
                sums[held] += np.add.reduceat(count * x, begins)
                low[held] = np.minimum(low[held], x[begins])
                high[held] = np.maximum(high[held], x[edges[held + 1] - 1])
            products += [*((w * x) @ x for x in v), *((w * v[a]) @ v[b] for a, b in pairs)]
        for i, (rows, sums, low, high) in enumerate(found):
            at = np.flatnonzero(low <= high)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i)), pa.array(at), *(pa.array(x[at]) for x in (rows, sums, low, high))], names)
        zero = pa.array(np.zeros(len(products)))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(products), -1)), pa.array(np.arange(len(products))), pa.array(products), zero, zero, zero], names)

    names = ["c", "range", "rows", "sums", "low", "high"]
    told = points.mapInArrow(run, "c bigint, range bigint, rows double, sums double, low double, high double").groupBy("c", "range").agg(
        F.sum("rows").alias("rows"), F.sum("sums").alias("sums"), F.min("low").alias("low"), F.max("high").alias("high"))
    found = told.toArrow().sort_by([("c", "ascending"), ("range", "ascending")])
    out = []
    for i in range(-1, m):
        mine = found.filter(pa.compute.equal(found["c"], i))
        rows, sums, low = (mine[x].to_numpy() for x in ("rows", "sums", "low"))
        out.append(Axis(low, np.cumsum(rows) - rows, np.cumsum(sums) - sums, rows, sums, low == mine["high"].to_numpy()))
    return out[1:], out[0].rows[:m], out[0].rows[m:]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= CHUNK:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _cuts(quantiles: list[float], every: int) -> np.ndarray:
    """Where ranges begin, but the first: each ``every``-th quantile, and a range for each value that two in a row have."""
    q = np.array(quantiles)
    often = q[1:][q[1:] == q[:-1]]
    return np.unique(np.concatenate([q[every - 1::every], often, np.nextafter(often, np.inf)]))


def _sums(pair: int, bx, by, terms) -> list[np.ndarray]:
    return [np.full(len(bx), pair, np.int32), np.asarray(bx, np.int64), np.asarray(by, np.int64), *terms]


def _pair_cells(p: int, bx: np.ndarray, by: np.ndarray, width: int, terms: np.ndarray) -> list[np.ndarray]:
    cell, at = np.unique(bx * width + by, return_inverse=True)
    return _sums(p, cell // width, cell % width, [np.bincount(at, t, len(cell)) for t in terms])


def _told(numbers: list[tuple[int, int, float]]) -> list[np.ndarray]:
    kinds, at, values = zip(*numbers)
    zero = np.zeros(len(values))
    return _sums(-1, kinds, at, [np.array(values), zero, zero, zero])


def _table(parts: list[list[np.ndarray]]) -> pa.Table:
    return pa.table({name: np.concatenate(x) for name, x in zip(SUMS, zip(*parts))})


def _moved(rows: DataFrame, c: int, axes: list[Axis], pairs: list[tuple[int, int]], done: set[int],
           values: Callable[[DataFrame, list[int]], DataFrame], keep: bool) -> DataFrame:
    """Sums over the points that share a range of column ``c``; with ``keep``, also the points, with ``__m{c}``, their mean
    distance along it.

    Points go to the task of their range; those whose value has a range of its own need no company and stay in small bundles.
    Only what is stored of a point travels, other values are computed where it arrives.  The first of a pair's columns
    to come compares every two points of a range; the second, or the only one with ranges of several values, those in
    different ranges of the other, and gives the pair's sums by grid cell, complete for its ranges.
    """
    sent = rows.sparkSession.sparkContext.broadcast(axes)
    single = {i for i, axis in enumerate(axes) if axis.single.all()}
    mine = [(p, a, b) for p, (a, b) in enumerate(pairs) if c in (a, b)]
    used = sorted({c, *(i for _, a, b in mine for i in (a, b))})
    stored = [f.name for f in rows.schema]
    means = [x for x in stored if x.startswith("__m")]

    def meet(table: pa.Table) -> pa.Table:
        axes_ = sent.value
        axis, block, w = axes_[c], int(table["__block"][0].as_py()), _column(table, "__w")
        v = {i: _column(table, f"__v{i}") for i in used}
        at = {i: axes_[i].block(x) for i, x in v.items()}
        mean = axis.mean_of_single(v[c], at[c]) if block < 0 else axis.mean_in_block(v[c], w, block)
        numbers, parts = [(MEAN, c, w @ mean), (SQUARE, c, (w * mean) @ mean)], []
        for p, a, b in mine:
            other = a if b == c else b
            terms = _point_terms(w, v[a], v[b])
            first = other != c and other not in single and other not in done
            if block >= 0 and (first or other == c):
                numbers.append((MET, p, dominance(v[c], v[other], terms, False)))
            elif block >= 0:
                numbers.append((MET, p, dominance(at[other], v[c], terms, False)))
            if first:
                continue
            met = mean if other == c else axes_[other].mean_of_single(v[other], at[other]) if other in single else _column(table, f"__m{other}")
            numbers.append((CROSS, p, (w * mean) @ met))
            parts.append(_pair_cells(p, at[a], at[b], len(axes_[b].low), terms))
        told = _table([_told(numbers), *parts])
        if not keep:
            return told
        kept = table.select(stored).append_column(f"__m{c}", pa.array(mean))
        return pa.concat_tables([kept, told], promote_options="default").select([*stored, f"__m{c}", *SUMS])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    routed = _routed(values(rows, [c]), f"__v{c}", axes[c]).select(*stored, "__block").repartition("__block")
    read = [*(stored if keep else ["__w", *means]), "__block", *(f"__v{i}" for i in used)]
    return values(routed, used).select(*read).groupBy("__block").applyInArrow(meet, f"{schema}, `__m{c}` double, {CELL}" if keep else CELL)


def _routed(rows: DataFrame, column: str, axis: Axis) -> DataFrame:
    """The rows with ``__block``, the range of their value, or a number below 0 that they share with some of those of single values."""
    if len(axis.low) == 1:
        at = rows.withColumn("__at", F.lit(0))
    else:
        at = Bucketizer(splits=[-np.inf, *axis.low[1:].tolist(), np.inf], inputCol=column, outputCol="__at", handleInvalid="keep").transform(rows)
    block = F.least(F.col("__at").cast("long"), F.lit(len(axis.low) - 1).cast("long"))
    if axis.single.any():
        alone = F.split(F.lit(" ".join("ny"[int(x)] for x in axis.single)), " ").cast("array<boolean>")
        block = F.when(F.get(alone, block.cast("int")), -1 - F.expr(f"monotonically_increasing_id() div {BUNDLE}")).otherwise(block)
    return at.withColumn("__block", block)


def _cells(rows: DataFrame, axes: list[Axis], pairs: list[tuple[int, int]], mine: list[int]) -> DataFrame:
    """Sums by occupied grid cell of the pairs numbered in ``mine``, whose columns have ranges of one value only."""
    sent = rows.sparkSession.sparkContext.broadcast(axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes_, cross = sent.value, np.zeros(len(mine))
        for table in _chunks(batches):
            w, parts = _column(table, "__w"), []
            v = {i: _column(table, f"__v{i}") for p in mine for i in pairs[p]}
            at = {i: axes_[i].block(x) for i, x in v.items()}
            means = {i: axes_[i].mean_of_single(x, at[i]) for i, x in v.items()}
            for k, p in enumerate(mine):
                a, b = pairs[p]
                cross[k] += (w * means[a]) @ means[b]
                parts.append(_pair_cells(p, at[a], at[b], len(axes_[b].low), _point_terms(w, v[a], v[b])))
            yield from _table(parts).to_batches()
        yield from _table([_told([(CROSS, p, x) for p, x in zip(mine, cross)])]).to_batches()

    return rows.mapInArrow(run, CELL)


def _summed(cells: DataFrame) -> DataFrame:
    return cells.groupBy("pair", "bx", "by").agg(*[F.sum(t).alias(t) for t in ("w", "wx", "wy", "wxy")])


def _by_cells(cells: DataFrame, sizes: list[tuple[int, int]], limit: int, scratch: Scratch) -> dict[int, float]:
    """Per pair, the sum over cells that differ in both ranges alike.

    Where a pair's grid exceeds ``limit``, cells meet in strips of neighbouring ranges of either axis, and the strips
    become the ranges of a coarser grid, of occupied cells only; a strip is as narrow as keeps it within ``limit``.
    """
    def meet(table: pa.Table) -> pa.Table:
        terms = np.stack([_column(table, t) for t in ("w", "wx", "wy", "wxy")])
        return pa.table({"pair": pa.array([table["pair"][0].as_py()], pa.int32()),
                         "found": [dominance(_column(table, "o"), _column(table, "by"), terms)]})

    def met(strips: DataFrame) -> None:
        for r in strips.groupBy("pair", "kind", "strip").applyInArrow(meet, "pair int, found double").groupBy("pair").agg(
                F.sum("found").alias("found")).toLocalIterator():
            out[r["pair"]] = out.get(r["pair"], 0.0) + r["found"]

    out: dict[int, float] = {}
    zero = F.lit(0).cast("long")
    while sizes:
        bits = [tuple(max(1, (limit // max(other, 1)).bit_length() - 1) for other in (b, a)) for a, b in sizes]
        whole = [p for p, (a, b) in enumerate(sizes) if a * b <= limit]
        sums = ("w", "wx", "wy", "wxy")
        met(cells.where(F.col("pair").isin(whole)).select("pair", zero.alias("kind"), zero.alias("strip"), F.col("bx").alias("o"), "by", *sums))
        rest = cells.where((F.col("pair") >= 0) & ~F.col("pair").isin(whole))
        if len(whole) == len(sizes):
            break
        shift = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in bits])
        told = rest.withColumn("s", F.get(shift, F.col("pair"))).withColumns({
            "cx": F.expr("shiftright(bx, s.x)"), "cy": F.expr("shiftright(by, s.y)")})
        met(told.select("pair", zero.alias("kind"), F.col("cx").alias("strip"), F.col("bx").alias("o"), "by", *sums).unionByName(
            told.select("pair", (zero + 1).alias("kind"), F.col("cy").alias("strip"), F.col("cx").alias("o"), "by", *sums)))
        cells = scratch.stage(_summed(told.select("pair", F.col("cx").alias("bx"), F.col("cy").alias("by"), *sums)), "coarse-cells")
        sizes = [(0, 0) if p in whole else ((a - 1 >> x) + 1, (b - 1 >> y) + 1) for p, ((a, b), (x, y)) in enumerate(zip(sizes, bits))]
    return out


def pair_distance_correlation(df: DataFrame, pairs: list[tuple[str, str]], block_rows: int | None = None, own_block: int = OWN_BLOCK,
                              cells: int = CELLS, weight: str | None = None,
                              derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Exact distance correlation ``(feature_x, feature_y, dcor)`` of the given column pairs without pairs of rows.

    With a = |xᵢ−xⱼ| and b = |yᵢ−yⱼ|, dCov² = mean(ab) − 2·mean(āᵢ·b̄ᵢ) + ā·b̄.  The mean distances ā of a row come from
    counts and sums up to its value, once per column.  For the cross term, Σab = 2·C − S over unordered row pairs,
    where S is the signed sum (from plain moments) and C sums (xᵢ−xⱼ)(yᵢ−yⱼ) over concordant row pairs.

    Equal rows are one point that counts as often as it occurs; ``weight`` names the column that holds this number where
    the rows have been counted before.  ``derive`` adds columns that follow from the others of their row: they are
    computed in every pass and neither stored nor moved.

    Each column's values are cut into ranges of about ``block_rows`` points; a frequent value is a range of its own,
    in which no pair of rows adds anything.  So points travel only along columns that have ranges of several values, once
    per such column, whatever the number of pairs.  C is the sum over row pairs that meet in a range of either column,
    plus the sum over pairs of occupied grid cells (``_by_cells``).  Mean distances are kept with the points only until
    the last partner of their column has come, and tables and shuffles of a pass go when it is done.
    """
    columns = sorted({c for pair in pairs for c in pair})
    at = {c: i for i, c in enumerate(columns)}
    with Scratch(df.sparkSession) as scratch:
        out = _pairs(df, [(at[x], at[y]) for x, y in pairs], columns, block_rows, own_block, cells, weight, derive, scratch)
    return df.sparkSession.createDataFrame([(*pair, value) for pair, value in zip(pairs, out)], "feature_x string, feature_y string, dcor double")


def _pairs(df: DataFrame, pairs: list[tuple[int, int]], columns: list[str], block_rows: int | None, own_block: int, cells: int,
           weight: str | None, derive: Callable[[DataFrame], DataFrame] | None, scratch: Scratch) -> list[float]:
    if not pairs:
        return []
    if weight:
        points = scratch.stage(df.withColumn("__w", F.col(f"`{weight}`").cast("double")).drop(weight), "points")
    else:
        base = df.columns if derive else columns
        whole = [F.col(f"`{c}`") if derive else (F.col(f"`{c}`").cast("double") + F.lit(0.0)).alias(c) for c in base]
        points = scratch.stage(df.select(*whole).groupBy(*[f"`{c}`" for c in base]).agg(F.count(F.lit(1)).cast("double").alias("__w")), "points")
    raw = [F.col(f"`{c}`").cast("double") + F.lit(0.0) for c in columns]
    told = derive(points) if derive else points
    size = told.agg(F.count(F.lit(1)).alias("points"), F.sum("__w").alias("n"), *[(F.sum(F.col("__w") * x) / F.sum("__w")) for x in raw]).first()
    if not size["points"]:
        return []
    n, means = size["n"], size[2:]
    per_block = block_rows or max(BLOCK_ROWS, min(MOST_BLOCK_ROWS, size["points"] // BLOCKS))
    blocks = -(-size["points"] // per_block)
    every = max(1, 2 * own_block // blocks)
    steps = max(1, min(every * blocks, size["points"] // 2))
    # One string is a light plan; thousands of literals a column are not.
    grid = F.split(F.lit(" ".join(str(i / steps) for i in range(1, max(steps, 2)))), " ").cast("array<double>")
    measured = told.agg(*[F.sqrt(F.sum(F.col("__w") * (x - F.lit(m)) * (x - F.lit(m))) / F.lit(n)) for x, m in zip(raw, means)],
                        *[F.percentile_approx(x, grid, 2 * steps) for x in raw]).first()
    spreads = [d or 1.0 for d in measured[:len(raw)]]
    cuts = [_cuts([(q - m) / d for q in quantiles], every) for quantiles, m, d in zip(measured[len(raw):], means, spreads)]

    def values(rows: DataFrame, which: list[int]) -> DataFrame:
        told = derive(rows) if derive else rows
        scaled = [((raw[i] - F.lit(means[i])) / F.lit(spreads[i]) + F.lit(0.0)).alias(f"__v{i}") for i in which]
        return told.select(*[F.col(f"`{c}`") for c in rows.columns], *scaled)

    axes, squares, products = _axes(values(points, list(range(len(columns)))), cuts, pairs)
    several = {i for i, axis in enumerate(axes) if not axis.single.all()}
    partners = {i: {x for pair in pairs if i in pair for x in pair if x != i} & several for i in several}
    moments = {}
    for i, axis in enumerate(axes):
        if i not in several:
            mean = axis.mean_of_single(axis.low, np.arange(len(axis.low)))
            moments[MEAN, i], moments[SQUARE, i] = axis.rows @ mean, (axis.rows * mean) @ mean
    rows, done, sums = points, set(), []
    for c in sorted(several, key=lambda i: (-len(partners[i]), i)):  # the more partners, the fewer means to keep
        keep = not partners[c] <= done
        found = scratch.stage(_moved(rows, c, axes, pairs, done, values, keep), "moved")
        sums.append(found.where("pair is not null").select(*SUMS))
        done.add(c)
        if keep:
            if len(sums) == 1:
                scratch.drop(points)
            gone = [f"__m{i}" for i in done if partners[i] <= done]
            rows = found.where("pair is null").drop(*SUMS, *gone)
    single = [p for p, pair in enumerate(pairs) if not several & set(pair)]
    if single:
        sums.append(_cells(values(rows, sorted({i for p in single for i in pairs[p]})), axes, pairs, single))
    whole = sums[0]
    for x in sums[1:]:
        whole = whole.unionByName(x)
    grid = scratch.stage(_summed(whole), "cells")
    moments |= {(r["bx"], r["by"]): r["w"] for r in grid.where("pair < 0").collect()}
    crossed = _by_cells(grid, [(len(axes[a].low), len(axes[b].low)) for a, b in pairs], cells, scratch)

    def spread(c: int) -> float:
        a, aa = moments[MEAN, c] / n, moments[SQUARE, c] / n
        return 2 * (squares[c] / n - (axes[c].total[1] / n) ** 2) - 2 * aa + a * a

    out = []
    for p, (a, b) in enumerate(pairs):
        concordant = crossed.get(p, 0.0) + moments.get((MET, p), 0.0)
        signed = n * products[p] - axes[a].total[1] * axes[b].total[1]
        cov = 2 * (2 * concordant - signed) / (n * n) - 2 * moments[CROSS, p] / n + moments[MEAN, a] / n * moments[MEAN, b] / n
        scale = float(np.sqrt(max(spread(a), 0.0) * max(spread(b), 0.0)))
        out.append(min(float(np.sqrt(max(cov, 0.0) / scale)), 1.0) if scale > 0 else 0.0)
    return out
