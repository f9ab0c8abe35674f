"""Exact top-k by inner product with pivot-table elimination.

With one more component that makes all rows equally long (queries get a 0 there), a larger inner product is a smaller
distance. Distances of all rows to many pivots are computed once. |d(row, pivot) - d(query, pivot)| never exceeds
d(query, row), so the maximum over the pivots is a lower bound; rows are evaluated in the order of that bound, and once it
passes the k-th best distance no other row can be among the k best. The score itself is exact arithmetic on whole numbers.

Rows lie in the cell of their nearest leading pivot. A first search of one cell gives each query a k-th score to start
with; after that it visits the cells that its bounds can't rule out, in tiles of bounded size. Equal vectors are one
class with its smallest ids, so a vector that is repeated a million times costs no more than another.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import cut
from .whole_vectors import matrix, of_usual_width, whole_vectors

#: Share by which a bound must pass the limit: far more than distances in single precision are off.
SLACK = 1e-5
FOUND = "asked long, score long, members array<long>"


@dataclass(frozen=True)
class PivotSearch:
    """``pivots``: columns of the table of distances, the first of them lead a cell each; ``sample``: vectors they are
    chosen from; ``tile`` and ``block``: classes and queries of one task; ``first``: rows evaluated before the bound is
    looked at again, twice as many each time."""

    k: int = 20
    scale: int = 64
    pivots: int = 64
    sample: int = 2048
    tile: int = 8192
    block: int = 4096
    first: int = 512
    seed: int = 3


@dataclass(frozen=True)
class Pivots:
    """Pivots with their further component, and the length that all rows get."""

    points: np.ndarray
    square: float

    def distances(self, v: np.ndarray, query: bool = False) -> np.ndarray:
        v = v.astype(np.float64)
        own = (v * v).sum(axis=1)
        rest = np.zeros(len(v)) if query else np.sqrt(np.maximum(0, self.square - own))
        full = own + rest**2
        x = np.column_stack([v, rest])
        squares = full[:, None] + (self.points**2).sum(axis=1) - 2 * (x @ self.points.T)
        return np.sqrt(np.maximum(0, squares)).astype(np.float32)


def choose(sample: np.ndarray, square: float, many: int) -> Pivots:
    """Pivots far apart: each next one is the vector farthest from those chosen."""
    x = sample.astype(np.float64)
    x = np.column_stack([x, np.sqrt(np.maximum(0, square - (x * x).sum(axis=1)))])
    far, chosen = np.full(len(x), np.inf), [0]
    while len(chosen) < min(many, len(x)):
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
        if far.max() <= 0:
            break
        chosen.append(int(far.argmax()))
    return Pivots(x[chosen], square)


def _gaps(low: np.ndarray, high: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Least distance of the queries from anything whose pivot distances lie between ``low`` and ``high``."""
    gap = np.zeros((len(asked), len(low)), np.float32)
    for p in range(asked.shape[1]):
        q = asked[:, p, None]
        np.maximum(gap, np.maximum(low[:, p] - q, q - high[:, p]), out=gap)
    return gap


def _limit(square: float, query: np.ndarray, score: float) -> float:
    """The distance that belongs to a score, a little enlarged."""
    q = float((query.astype(np.float64) ** 2).sum())
    return float(np.sqrt(max(0.0, square + q - 2 * score)) * (1 + SLACK) + SLACK * np.sqrt(square + q))


def best_of_tile(v: np.ndarray, table: np.ndarray, many: np.ndarray, query: np.ndarray, asked: np.ndarray, least: int | None, square: float, rule: PivotSearch):
    """Rows with the ``k + 1`` best scores among those of ``least`` or more, their scores, and how many were evaluated.

    ``table`` has a line for each pivot. Rows are evaluated in the order of their bounds, in steps that double, until the
    next bound passes the limit; a step may hold rows that its own scores rule out.
    """
    gap = table - asked[:, None]
    bound = np.abs(gap, out=gap).max(axis=0)
    limit = np.inf if least is None else _limit(square, query, least)
    order = np.flatnonzero(bound <= limit)
    # In steps of 1 / 65,535 of the largest bound: whole numbers of 16 bits sort in one pass over their bytes.
    per = 65535 / float(bound.max(initial=0) or 1)
    level = (bound[order] * per).astype(np.uint16)
    sort = np.argsort(level, kind="stable")
    order, level = order[sort], level[sort]
    want, at, step = rule.k + 1, 0, rule.first
    rows, scores = np.zeros(0, np.int64), np.zeros(0, v.dtype)
    while at < len(order) and level[at] <= limit * per:
        some = order[at : at + step]
        got = v.take(some, axis=0) @ query
        if least is not None:
            hit = np.flatnonzero(got >= least)
            some, got = some[hit], got[hit]
        rows, scores = np.concatenate([rows, some]), np.concatenate([scores, got])
        if len(rows) > 4 * want:
            hit = np.flatnonzero(scores >= np.partition(scores, len(scores) - want)[len(scores) - want])
            rows, scores = rows[hit], scores[hit]
        best = np.lexsort((rows, -scores))[:want]
        rows, scores = rows[best], scores[best]
        at, step = at + step, 2 * step
        enough = np.flatnonzero(np.cumsum(many[rows]) >= want)
        if len(enough):
            least = int(scores[enough[0]])
            limit = min(limit, _limit(square, query, least))
    return rows, scores.astype(np.int64), min(at, len(order))


def _search(pivots: Pivots, width: int, rule: PivotSearch):
    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        asked, score, members = [], [], []
        if rows.num_rows and queries.num_rows:
            rows = rows.sort_by("class_id")  # ties go to the class of the smallest id
            v, q = matrix(rows.column("v"), width), matrix(queries.column("v"), width)
            longest = np.sqrt(float((v.astype(float) ** 2).sum(axis=1).max()) * float((q.astype(float) ** 2).sum(axis=1).max()))
            away = pivots.distances(q, query=True)
            if longest < 1 << 52:  # whole numbers of that size are exact in floating point, which multiplies faster
                v, q = (x.astype(np.float32 if longest < 1 << 23 else np.float64) for x in (v, q))
            table = np.ascontiguousarray(matrix(rows.column("distances"), len(pivots.points), np.float32).T)
            ids = rows.column("ids").to_pylist()
            many = np.array([len(i) for i in ids])
            names, least = queries.column("class_id").to_pylist(), queries.column("least").to_pylist()
            for i, name in enumerate(names):
                found, scores, _ = best_of_tile(v, table, many, q[i], away[i], least[i], pivots.square, rule)
                asked += [name] * len(found)
                score += scores.tolist()
                members += [ids[r] for r in found]
        return pa.table({"asked": pa.array(asked, pa.int64()), "score": pa.array(score, pa.int64()), "members": pa.array(members, pa.list_(pa.int64()))})

    return search


def _best(found: DataFrame, k: int) -> DataFrame:
    """(asked, score, vec_id, place): the ``k + 1`` best rows of each query."""
    rows = found.select("asked", "score", F.explode("members").alias("vec_id"))
    order = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """(class_id, v, ids): each distinct vector with its smallest ``k + 1`` ids; the rank limits rows before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.select("vec_id", "v").withColumn("place", rank).where(F.col("place") <= k + 1)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("class_id"), "v", "ids")


def _tabulated(classes: DataFrame, pivots: Pivots, cells: int, width: int) -> DataFrame:
    def tabulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = pivots.distances(matrix(batch.column("v"), width))
            cell = d[:, :cells].argmin(axis=1) if len(d) else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, d.size + 1, d.shape[1], dtype=np.int32), pa.array(d.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(cell, pa.int32())], names=["class_id", "v", "ids", "distances", "cell"])

    return classes.select("class_id", "v", "ids").mapInArrow(tabulate, "class_id long, v array<int>, ids array<long>, distances array<float>, cell int")


def _visits(asked: DataFrame, pivots: Pivots, low: np.ndarray, high: np.ndarray, cells: np.ndarray, width: int, all: bool) -> DataFrame:
    """(class_id, v, least, cell) for each cell that a query has to see, or only for the cell of the smallest bound."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = matrix(batch.column("v"), width)
            away, least = pivots.distances(q, query=True), batch.column("least").to_pylist()
            gap = _gaps(low, high, away)
            if all:
                limits = np.array([np.inf if s is None else _limit(pivots.square, x, s) for x, s in zip(q, least, strict=True)])
                row, cell = np.nonzero(gap <= limits[:, None])
            else:
                row, cell = np.arange(len(q)), np.lexsort((away[:, cells], gap), axis=1)[:, 0] if len(q) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(pa.array(row)) for c in ("class_id", "v", "least")], pa.array(cells[cell], pa.int32())], names=["class_id", "v", "least", "cell"])

    return asked.select("class_id", "v", "least").mapInArrow(visit, "class_id long, v array<int>, least long, cell int")


def _run(table: DataFrame, visits: DataFrame, sizes: DataFrame, search, rule: PivotSearch, parts: str) -> DataFrame:
    """All visits, by tile of a cell and block of its visitors."""
    visits = cut(visits, "visits")
    blocks = visits.groupBy("cell").agg(F.ceil(F.count("*") / rule.block).cast("long").alias("blocks"))
    sizes = cut(sizes.select("cell", "parts").join(blocks, "cell"), "sizes")
    spread = lambda many, name: F.pmod(F.xxhash64(F.lit(name), "class_id"), F.col(many)).alias(name)
    each = lambda many, name: F.explode(F.sequence(F.lit(0).cast("long"), F.col(many) - 1)).alias(name)
    left = table.join(F.broadcast(sizes), "cell").select("class_id", "v", "ids", "distances", "cell", spread("parts", "t"), each("blocks", "b"))
    left, right = left.where(parts), visits.join(F.broadcast(sizes), "cell").select("class_id", "v", "least", "cell", each("parts", "t"), spread("blocks", "b")).where(parts)
    return left.groupBy("cell", "t", "b").cogroup(right.groupBy("cell", "t", "b")).applyInArrow(search, FOUND)


def top_k(table: DataFrame, queries: DataFrame | None = None, rule: PivotSearch = PivotSearch(), id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``rule.k`` rows of the largest inner product with each query, its own left out.

    ``queries`` has the columns of ``table``; without it, rows whose id is divisible by 20 ask. Components are scaled and
    floored first. Which rows take part, and what holds for repeated ids, says ``whole_vectors``; rows of another width
    than most take no part. Ties go to the smaller id. Other columns aren't looked at; an empty table gives an empty result.
    """
    rows, width = of_usual_width(cut(whole_vectors(table, rule.scale, id, vector), "rows"))
    if not width:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    asking = rows.where("vec_id % 20 = 0") if queries is None else whole_vectors(queries, rule.scale, id, vector).where(F.size("v") == width)
    classes = cut(_classes(rows, rule.k), "classes")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    n, longest = classes.agg(F.count("*"), F.max(square)).first()
    some = classes.orderBy(F.xxhash64(F.lit(rule.seed), "class_id"), "class_id").limit(rule.sample).select("v").collect()
    pivots = choose(np.array([r["v"] for r in some]), float(longest), rule.pivots)
    many = len(pivots.points)
    table = cut(_tabulated(classes, pivots, min(many, -(-n // rule.tile)), width), "distances")

    # One row for each cell, no more than there are pivots.
    ends = [f(F.col("distances")[p]).alias(f"{n}{p}") for n, f in (("low", F.min), ("high", F.max)) for p in range(many)]
    cells = table.groupBy("cell").agg(F.count("*").alias("size"), *ends).orderBy("cell").collect()
    low, high = (np.array([[c[f"{n}{p}"] for p in range(many)] for c in cells], np.float32) for n in ("low", "high"))
    numbers = np.array([c["cell"] for c in cells])
    sizes = table.sparkSession.createDataFrame([(c["cell"], -(-c["size"] // rule.tile)) for c in cells], "cell int, parts long")

    askers = cut(asking.groupBy("v").agg(F.min("vec_id").alias("class_id")), "askers")
    search = _search(pivots, width, rule)
    start = askers.withColumn("least", F.lit(None).cast("long"))
    seeds = _best(_run(table, _visits(start, pivots, low, high, numbers, width, False), sizes, search, rule, "t = 0"), rule.k)
    seeds = seeds.where(F.col("place") == rule.k + 1).select(F.col("asked").alias("class_id"), F.col("score").alias("least"))
    ready = cut(askers.join(seeds, "class_id", "left"), "ready")
    found = _run(table, _visits(ready, pivots, low, high, numbers, width, True), sizes, search, rule, "true")
    nearest = _best(found, rule.k).groupBy("asked").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("nearest"))
    nearest = nearest.join(askers, F.col("asked") == F.col("class_id")).select("v", "nearest")
    others = F.slice(F.filter("nearest", lambda x: x["vec_id"] != F.col("vec_id")), 1, rule.k)
    each = asking.join(nearest, "v").select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("at", "row"))
    return each.select("query_id", (F.col("at") + 1).alias("rank"), "row.vec_id", "row.score")


SQL = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
)
SELECT a.vec_id AS query_id,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY list_inner_product(a.v, b.v) DESC, b.vec_id)::INTEGER AS rank,
  b.vec_id, list_inner_product(a.v, b.v)::BIGINT AS score
FROM rows a JOIN rows b ON a.vec_id <> b.vec_id AND a.vec_id % 20 = 0
QUALIFY rank <= 20
"""
