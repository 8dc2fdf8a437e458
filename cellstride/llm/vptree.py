"""Nearest neighbours by cosine: one vantage-point tree per shard of near vectors, searched by blocks of queries."""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass, replace
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..sources.staging import stage
from . import common

LEAF = 48
#: Vectors of one tree, in bytes.
SHARD_BYTES = 16 << 20
QUERY_BLOCK = 1024
#: Most cells, rows from which their pivots are chosen, bytes of those rows, and pivots that bound every cell.
MAX_CELLS = 1024
SAMPLE = 4096
PIVOT_BYTES = 16 << 20
MARKS = 32
#: Slack for rounding when distances are compared.
EPS = 1e-6
BOUNDS = pa.schema([("width", pa.int32()), ("cell", pa.int32()), ("n", pa.int64()), ("low", pa.list_(pa.float64())),
                    ("high", pa.list_(pa.float64()))])
BLOCK = pa.schema([("width", pa.int32()), ("cell", pa.int32()), ("part", pa.int32()), ("queries", pa.binary())])
ROUTE = pa.schema([("width", pa.int32()), ("cell", pa.int32()), ("salt", pa.int32()), ("queries", pa.binary())])


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as found:
        return {k: found[k] for k in found.files}


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``; equal rows give equal values wherever they stand."""
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def build(ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """A balanced tree over the unit vectors: rows in leaf order, nodes as (begin, end, inner child, outer child, row of
    the vantage point, largest inner distance, smallest outer distance).

    Halves are cut by rank of the distance to the vantage point, so equal vectors do no harm.
    """
    points, order = unit(vectors), np.argsort(ids, kind="stable")
    nodes: list[list[float]] = []
    todo = [(0, len(ids), -1, 0)]
    while todo:
        begin, end, parent, side = todo.pop()
        here = len(nodes)
        nodes.append([begin, end, -1, -1, -1, 0.0, 0.0])
        if parent >= 0:
            nodes[parent][2 + side] = here
        if end - begin > leaf:
            rows = order[begin:end]
            centre = points[rows].mean(0)
            vantage = rows[np.argmax(((points[rows] - centre) ** 2).sum(1))]
            away = np.sqrt(((points[rows] - points[vantage]) ** 2).sum(1))
            by = np.argsort(away, kind="stable")
            order[begin:end] = rows[by]
            half = (end - begin) // 2
            nodes[here][4:] = [vantage, away[by[half - 1]], away[by[half]]]
            todo += [(begin, begin + half, here, 0), (begin + half, end, here, 1)]
    table = np.array(nodes, np.float64)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    inner = table[:, 4] >= 0
    table[inner, 4] = place[table[inner, 4].astype(np.int64)]
    return {"ids": ids[order], "vectors": vectors[order], "nodes": table}


def search(tree: dict[str, np.ndarray], query_ids: np.ndarray, queries: np.ndarray, k: int = 5, factor: float = 1.0,
           within: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The k nearest rows of the tree for each query: (query row, vec id, cosine), and how many distances it took.

    All queries go down together.  A half is left out for the queries whose distance to it, by the triangle
    inequality, is above ``factor`` times the distance of their k-th best so far; with factor one nothing is lost.
    ``within`` is a distance per query inside which k rows are known already; rows beyond it are not returned.
    """
    points, goals, nodes, ids = unit(tree["vectors"]), unit(queries), tree["nodes"], tree["ids"]
    limit = np.full(len(goals), np.inf) if within is None else within
    reach = limit.copy()
    best = np.full((len(goals), k), np.inf)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    work = 0

    def visit(node: int, active: np.ndarray) -> None:
        nonlocal work
        begin, end, inner, outer, vantage = nodes[node, :5].astype(np.int64)
        if not len(active):
            return
        if inner < 0:
            work += len(active) * (end - begin)
            near = np.sqrt(np.maximum(2 - 2 * goals[active] @ points[begin:end].T, 0))
            near[query_ids[active][:, None] == ids[None, begin:end]] = np.inf
            q, row = np.nonzero((near <= reach[active][:, None] + EPS) & (near < np.inf))
            found.append((active[q], begin + row))
            merged = np.concatenate([best[active], near], 1)
            best[active] = np.partition(merged, k - 1, 1)[:, :k]
            reach[active] = np.minimum(limit[active], best[active].max(1))
            return
        work += len(active)
        away = np.sqrt(((goals[active] - points[vantage]) ** 2).sum(1))
        low = (np.maximum(away - nodes[node, 5], 0), np.maximum(nodes[node, 6] - away, 0))
        first = low[0] <= low[1]
        visit(inner, active[first])
        visit(outer, active[~first])
        visit(outer, active[first & (low[1] <= factor * reach[active] + EPS)])
        visit(inner, active[~first & (low[0] <= factor * reach[active] + EPS)])

    visit(0, np.arange(len(goals)))
    q, row = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    near = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", goals[q], points[row]), 0))
    keep = near <= reach[q] + EPS  # all ties of the k-th, rounding aside
    q, row = q[keep], row[keep]
    scores = cosine(queries[q], tree["vectors"][row])
    order = np.lexsort((ids[row], -scores, q))
    q, row, scores = q[order], row[order], scores[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < k], ids[row[rank < k]], scores[rank < k], work


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the vectors that take part: not null, not zero, all components finite."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & fine & F.exists("vector", lambda x: x != 0))


@dataclass(frozen=True)
class Index:
    """Trees by (width, cell, part), and what says which cells a query can leave out.

    A cell holds the vectors nearest to one of the ``pivots`` of their width; ``low`` and ``high`` bound, per cell, the distances of
    its vectors to the first pivots and to its own.  ``parts`` is the number of trees of a cell; widths without pivots
    have one cell of ``spread`` parts that is never left out.
    """

    trees: DataFrame
    pivots: dict[int, np.ndarray]
    low: dict[int, np.ndarray]
    high: dict[int, np.ndarray]
    parts: dict[tuple[int, int], int]
    spread: int


def spread_points(points: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` different points, each the farthest from those before it."""
    chosen, away = [0], np.full(len(points), np.inf)
    while len(chosen) < n:
        away = np.minimum(away, ((points - points[chosen[-1]]) ** 2).sum(1))
        far = int(away.argmax())
        if away[far] <= EPS:
            break
        chosen.append(far)
    return points[chosen]


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * points @ pivots.T, 0))


def to_marks(away: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Distances to the first pivots and, last, to the pivot of the cell."""
    return np.concatenate([away[:, :MARKS], away[np.arange(len(away)), cell][:, None]], 1)


def _choose_pivots(rows: DataFrame, n: int, widest: int, cells: int) -> dict[int, np.ndarray]:
    """Pivots by width from at most ``SAMPLE`` rows of smallest hashes, ``PIVOT_BYTES`` in all: a bound on what the driver holds."""
    most = min(SAMPLE, PIVOT_BYTES // (8 * max(widest, 1)))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(most).collect() if most else []
    by_width: dict[int, list] = {}
    for r in sample:
        by_width.setdefault(len(r["vector"]), []).append(r["vector"])
    return {w: spread_points(unit(np.array(v)), max(1, min(cells, MAX_CELLS) * len(v) // len(sample))) for w, v in by_width.items()}


def in_cells(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """(id, vector) with width and cell, the nearest pivot's number."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths, cells = vector_widths(batch), np.zeros(batch.num_rows, np.int32)
            for width in np.unique(widths):
                if width in shared.value:
                    at = np.flatnonzero(widths == width)
                    cells[at] = distances(unit(matrix(batch, at, width)), shared.value[width]).argmin(1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vector"), pa.array(widths.astype(np.int32)),
                                              pa.array(cells)], ["id", "vector", "width", "cell"])

    return rows.select("id", "vector").mapInArrow(run, "id bigint, vector array<double>, width int, cell int")


def vector_widths(batch: pa.RecordBatch) -> np.ndarray:
    return pc.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False).astype(np.int64)


def matrix(batch: pa.RecordBatch, at: np.ndarray, width: int) -> np.ndarray:
    return batch.column("vector").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), width)


def _cell_bounds(placed: DataFrame, pivots: dict[int, np.ndarray]) -> list:
    """(width, cell, n, low, high) of the cells that have pivots, at most ``SAMPLE`` of them; tasks send partial bounds."""
    shared = placed.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            widths, cells = batch.column("width").to_numpy(), batch.column("cell").to_numpy()
            for width in np.unique(widths):
                if int(width) not in shared.value:
                    continue
                at = np.flatnonzero(widths == width)
                own = cells[at]
                away = to_marks(distances(unit(matrix(batch, at, int(width))), shared.value[int(width)]), own)
                for cell in np.unique(own):
                    part = away[own == cell]
                    n, low, high = held.get((int(width), int(cell)), (0, np.inf, -np.inf))
                    held[int(width), int(cell)] = (n + len(part), np.minimum(low, part.min(0)), np.maximum(high, part.max(0)))
        rows = [(w, c, n, low.tolist(), high.tolist()) for (w, c), (n, low, high) in held.items()]
        yield pa.RecordBatch.from_pylist([dict(zip(BOUNDS.names, r)) for r in rows], schema=BOUNDS)

    partial = placed.mapInArrow(run, "width int, cell int, n bigint, low array<double>, high array<double>")
    return partial.groupBy("width", "cell").agg(
        F.sum("n").alias("n"), *[F.array(*[f(F.get(c, F.lit(i))) for i in range(MARKS + 1)]).alias(c)
                                 for f, c in ((F.min, "low"), (F.max, "high"))]).collect()


def build_index(rows: DataFrame, shard_rows: int | None = None, leaf: int = LEAF) -> Index:
    """Trees over all of (id, vector), a stored table.  Vectors go to the cell of their nearest pivot.

    A cell of more rows than a tree may hold is dealt out over several trees by a hash of the row's number, so neither many
    equal vectors nor a dense region make a tree large.  ``shard_rows`` is the size of a tree, by default
    ``SHARD_BYTES`` of vectors, or less while that keeps all tasks busy.  Vectors of unlike length never meet.
    """
    n, widest = rows.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    shard_rows = shard_rows or max(64, SHARD_BYTES // (8 * (widest or 1)))
    shards = max(1, ceil(n / shard_rows), min(2 * common.partitions(rows.sparkSession), n // 128))
    pivots = _choose_pivots(rows, n, widest or 1, shards)
    placed = stage(in_cells(rows, pivots), "vectors-in-cells")
    low, high, parts = {}, {}, {}
    for w, p in pivots.items():
        marks = min(MARKS, len(p)) + 1
        low[w], high[w] = np.full((len(p), marks), np.inf), np.full((len(p), marks), -np.inf)
    for r in _cell_bounds(placed, pivots):
        found = [[x for x in r[side] if x is not None] for side in ("low", "high")]
        low[r["width"]][r["cell"]], high[r["width"]][r["cell"]] = found
        parts[r["width"], r["cell"]] = ceil(r["n"] / ceil(n / shards))
    index = Index(None, pivots, low, high, parts, shards)
    dealt = _with_parts(common.mark_rows(placed, "mark"), index).select(
        "width", "cell", F.pmod(F.xxhash64("mark"), F.col("parts")).cast("int").alias("part"), "id", "vector")

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        tree = build(part["id"].to_numpy(np.int64), np.stack(part["vector"].to_numpy()).astype(np.float64), leaf)
        return pd.DataFrame({"width": [key[0]], "cell": [key[1]], "part": [key[2]], "tree": [_pack(**tree)]})

    trees = dealt.groupBy("width", "cell", "part").applyInPandas(run, "width int, cell int, part int, tree binary")
    return replace(index, trees=stage(trees, "trees"))


def _with_parts(df: DataFrame, index: Index) -> DataFrame:
    """``df`` (width, cell …) with ``parts``, the number of trees of its cell; the table of cells is bounded by the sample."""
    known = df.sparkSession.createDataFrame([(w, c, p) for (w, c), p in index.parts.items()], "width int, cell int, parts long")
    joined = df.join(F.broadcast(known), ["width", "cell"], "left")
    return joined.withColumn("parts", F.coalesce("parts", F.lit(index.spread).cast("long")))


def _packed_queries(single: DataFrame, index: Index, block: int) -> DataFrame:
    """(width, cell, part, queries): every query at one tree of its own cell, in blocks of about ``block``."""
    placed = stage(in_cells(single, index.pivots), "queries-in-cells")
    counts = placed.groupBy("width", "cell").agg(F.count(F.lit(1)).alias("n"))
    many = stage(counts, "query-counts")
    sized = _with_parts(placed.join(many, ["width", "cell"]), index)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / (F.col("parts") * block)))

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"width": [key[0]], "cell": [key[1]], "part": [key[2]], "queries": [_pack(
            ids=part["id"].to_numpy(np.int64), vectors=np.stack(part["vector"].to_numpy()).astype(np.float64))]})

    return sized.select("width", "cell", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"),
                        F.pmod(F.xxhash64("id", F.lit(1)), blocks).alias("block"), "id", "vector").groupBy(
        "width", "cell", "part", "block").applyInPandas(pack, "width int, cell int, part int, queries binary")


def _found(asked: dict, tree: dict, k: int, factor: float) -> dict[str, np.ndarray]:
    q, ids, scores, _ = search(tree, asked["ids"], asked["vectors"], k, factor, asked.get("within"))
    return {"query": q, "found": ids, "scores": scores}


def search_at_home(index: Index, queries: DataFrame, k: int = 5, factor: float = 1.0, block: int = QUERY_BLOCK) -> DataFrame:
    """(width, cell, part, queries): blocks with the k nearest rows of their own tree and the distance they reach.

    A query id that occurs several times is searched once, with its first vector.
    """
    single = queries.groupBy("id").agg(F.min("vector").alias("vector"))
    packed = _packed_queries(single, index, block)
    trees = index.trees

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asked = _unpack(row["queries"])
                reach = np.full(len(asked["ids"]), np.inf)
                if row["tree"] is not None:
                    asked.update(_found(asked, _unpack(row["tree"]), k, factor))
                    n, last = np.bincount(asked["query"], minlength=len(reach)), np.full(len(reach), np.inf)
                    np.minimum.at(last, asked["query"], asked["scores"])
                    full = n == k
                    reach[full] = np.sqrt(np.maximum(2 - 2 * last[full], 0))
                asked["within"] = reach
                yield pa.RecordBatch.from_pylist([{"width": row["width"], "cell": row["cell"], "part": row["part"],
                                                   "queries": _pack(**asked)}], schema=BLOCK)

    homes = packed.join(trees, ["width", "cell", "part"], "left").select("width", "cell", "part", "queries", "tree")
    return stage(homes.mapInArrow(run, "width int, cell int, part int, queries binary"), "home-blocks")


def routes(index: Index, homes: DataFrame, factor: float = 1.0, block: int = QUERY_BLOCK) -> DataFrame:
    """(width, cell, part, queries): the other trees that queries still have to visit, with the queries that do.

    A query skips a cell whose vectors, by the triangle inequality over the distances to pivots, are farther than ``factor``
    times the distance that the query has reached in its own tree.  What goes to one cell is put together in blocks of
    about ``block`` queries at most, sized for the case that every query goes there.
    """
    shared = homes.sparkSession.sparkContext.broadcast((index.pivots, index.low, index.high))
    asking = homes.mapInArrow(_how_many, "n bigint").agg(F.sum("n")).first()[0] or 0
    salts = max(1, ceil(asking / block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, low, high = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                asked, width = _unpack(row["queries"]), row["width"]
                wanted = np.ones((len(asked["ids"]), 1), bool)
                if width in pivots:
                    away = distances(unit(asked["vectors"]), pivots[width])
                    nearest, last = np.zeros((len(away), len(pivots[width]))), low[width].shape[1] - 1
                    for j in range(last + 1):
                        d = away[:, j:j + 1] if j < last else away
                        np.maximum(nearest, np.maximum(low[width][:, j] - d, d - high[width][:, j]), out=nearest)
                    wanted = nearest <= factor * asked["within"][:, None] + EPS
                    wanted &= np.isfinite(low[width][:, 0])  # cells that hold a vector
                for cell in np.flatnonzero(wanted.any(0)):
                    q = np.flatnonzero(wanted[:, cell])
                    home = np.full(len(q), row["part"] if cell == row["cell"] else -1, np.int32)
                    sent = _pack(ids=asked["ids"][q], vectors=asked["vectors"][q], within=asked["within"][q], home=home)
                    yield pa.RecordBatch.from_pylist([{"width": width, "cell": int(cell), "salt": (int(asked["ids"][0]) * 0x9E3779B97F4A7C15 % 2**64 >> 32) % salts,
                                                       "queries": sent}], schema=ROUTE)

    def together(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        subsets = [_unpack(x) for x in part["queries"]]
        return pd.DataFrame({"width": [key[0]], "cell": [key[1]], "queries": [_pack(
            **{n: np.concatenate([x[n] for x in subsets]) for n in subsets[0]})]})

    sent = homes.mapInArrow(run, "width int, cell int, salt int, queries binary").groupBy("width", "cell", "salt").applyInPandas(
        together, "width int, cell int, queries binary")
    return _with_parts(sent, index).select(
        "width", "cell", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))).alias("part"), "queries")


def _how_many(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([len(_unpack(x)["ids"]) for x in batch.column("queries").to_pylist()], pa.int64())], ["n"])


def search_index(index: Index, queries: DataFrame, k: int = 5, factor: float = 1.0, block: int = QUERY_BLOCK) -> DataFrame:
    """The k nearest indexed rows of each query (id, vector): query_id, rank, vec_id, score.

    Blocks of queries first search the tree at home, then visit the trees that ``routes`` leaves, with the distance reached.
    The best of all are ranked: largest cosine first, ties by smaller id.  Rows with the query's own id are no candidates.
    """
    homes = search_at_home(index, queries, k, factor, block)

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for asked in map(_unpack, batch.column("queries").to_pylist()):
                if "query" in asked:
                    yield _hits(asked["ids"], asked)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, tree, asked in zip(batch.column("part"), batch.column("tree"), batch.column("queries")):
                goal = _unpack(asked.as_py())
                new = goal.pop("home") != part.as_py()  # not what has been searched at home
                if not new.any():
                    continue
                goal = {n: x[new] for n, x in goal.items()}
                yield _hits(goal["ids"], _found(goal, _unpack(tree.as_py()), k, factor))

    def _hits(ids: np.ndarray, hits: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids[hits["query"]]), pa.array(hits["found"]), pa.array(hits["scores"])],
                                          ["query_id", "vec_id", "score"])

    hit = "query_id bigint, vec_id bigint, score double"
    away = routes(index, homes, factor, block).join(index.trees, ["width", "cell", "part"]).select("part", "tree", "queries").mapInArrow(visit, hit)
    found = homes.select("queries").mapInArrow(unpacked, hit).unionAll(away)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.select("query_id", F.row_number().over(best).alias("rank"), "vec_id", "score").where(f"rank <= {k}")


def nearest(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5,
            factor: float = 1.0, shard_rows: int | None = None) -> DataFrame:
    """The k nearest of all rows for each row whose id is divisible by ``every``: query_id, rank, vec_id, score.

    Nearness is the cosine in double precision, ties go to the smaller id.  Vectors that are null, zero or hold
    a null or non-finite component take no part, nor do rows without an id; vectors are compared with those of their
    own length.  Fewer candidates than k are all returned; repeated rows are candidates each.  Other columns
    are not looked at.  ``factor`` below one searches less and may miss neighbours; one is exact.
    """
    rows = stage(usable(df, id_col, vector_col), "vectors")
    index = build_index(rows, shard_rows)
    return search_index(index, rows.where(F.col("id") % every == 0), k, factor)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(common.table(spark, sf_dir, "embeddings"))
