"""Nearest neighbours by inner product with multi-index hashing.

Vectors get one more component that makes all lengths equal (so that a larger inner product is a smaller angle) and
become binary codes by rotations learned on a bounded sample (public: iterative quantisation, Gong & Lazebnik, 2011).
Codes are split into substrings, each indexed by value. A code within Hamming radius r of the query is within r / m of
it in one of m substrings, so probing the values that near retrieves every code within the radius (public: Norouzi
et al., 2012). Those are ranked by the original vectors. All rows are indexed: in stripes of bounded size, each
searched for blocks of queries of bounded size.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import cut

PART_BITS = 16


@dataclass(frozen=True)
class Search:
    """``bits`` of a code (a multiple of 16); ``sample``: rows that rotations and radius are learned on; ``reach``: share
    of the sample's neighbours that the radius holds; ``stripe`` and ``block``: rows and queries of one task."""

    k: int = 20
    bits: int = 256
    sample: int = 2048
    rounds: int = 15
    reach: float = 0.99
    stripe: int = 8192
    block: int = 8192
    seed: int = 3


@dataclass(frozen=True)
class Codes:
    rotation: np.ndarray
    length: float
    radius: int

    def encode(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Substrings of the codes, one row of 16-bit values for each vector."""
        rest = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(0, self.length**2 - (vectors**2).sum(axis=1)))
        bits = np.column_stack([vectors, rest]) @ self.rotation > 0
        return np.packbits(bits, axis=1).view(np.uint16)


def learn(sample: np.ndarray, length: float, rows: int, rule: Search) -> Codes:
    """Rotations that bring the sample near the corners of the cube, and a radius that holds true neighbours.

    A sample's j-th neighbour stands for the k-th of all rows, j = k * sample / rows, rounded up; so the radius
    shrinks as the table grows, and errs to the large side.
    """
    random = np.random.default_rng(rule.seed)
    x = np.column_stack([sample, np.sqrt(np.maximum(0, length**2 - (sample**2).sum(axis=1)))])
    width = x.shape[1]
    found = []
    while sum(r.shape[1] for r in found) < rule.bits:
        r = np.linalg.qr(random.normal(size=(width, width)))[0]
        for _ in range(rule.rounds):
            u, _, vt = np.linalg.svd(np.sign(x @ r).T @ x, full_matrices=False)
            r = (u @ vt).T
        found.append(r)
    codes = Codes(np.concatenate(found, axis=1)[:, : rule.bits], length, 0)
    asked = np.arange(min(len(sample), 400))
    sims = sample[asked] @ sample.T
    sims[asked, asked] = -np.inf
    j = min(max(1, -(-rule.k * len(sample) // max(1, rows))), max(1, len(sample) - 1))
    near = np.argsort(-sims, axis=1)[:, :j]
    q, c = codes.encode(sample[asked], query=True), codes.encode(sample)
    apart = np.bitwise_count(q[:, None, :] ^ c[near]).sum(axis=2)
    return Codes(codes.rotation, length, int(np.ceil(np.quantile(apart, rule.reach))) if apart.size else rule.bits)


class SubstringIndex:
    """For each substring the codes' rows in order of its value."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []
        for j in range(codes.shape[1]):
            order = np.argsort(codes[:, j], kind="stable")
            values, starts = np.unique(codes[order, j], return_index=True)
            self.tables.append((values, np.append(starts, len(order)), order))

    def within(self, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of all codes within ``radius`` and their distances."""
        near = radius // len(self.tables)
        hit = np.zeros(len(self.codes), bool)
        for (values, starts, order), part in zip(self.tables, query, strict=True):
            if near <= 2:  # fewer values can be that near than a table of any size has
                probes = _masks(near) ^ part
                at = np.searchsorted(values, probes)
                at = at[(at < len(values)) & (values[np.minimum(at, len(values) - 1)] == probes)]
            else:
                at = np.flatnonzero(np.bitwise_count(values ^ part) <= near)
            if len(at) == len(values):
                hit[:] = True
            elif len(at):
                sizes = starts[at + 1] - starts[at]
                first = np.repeat(starts[at] - np.append(0, np.cumsum(sizes)[:-1]), sizes)
                hit[order[first + np.arange(len(first))]] = True
        rows = np.flatnonzero(hit)
        apart = np.bitwise_count(self.codes[rows] ^ query).sum(axis=1)
        keep = apart <= radius
        return rows[keep], apart[keep]


_MASKS: dict[int, np.ndarray] = {}


def _masks(near: int) -> np.ndarray:
    """All 16-bit values with at most ``near`` bits set."""
    if near not in _MASKS:
        _MASKS[near] = np.array([sum(1 << b for b in c) for n in range(near + 1) for c in combinations(range(PART_BITS), n)], np.uint16)
    return _MASKS[near]


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("vec_id").to_numpy()
    flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return ids, flat.reshape(len(ids), -1) if len(ids) else np.zeros((0, 0))


def _search(codes: Codes, rule: Search):
    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        ids, vectors = _matrix(rows)
        asked, asking = _matrix(queries)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(ids) and len(asked):
            index = SubstringIndex(codes.encode(vectors))
            for i, query in enumerate(codes.encode(asking, query=True)):
                found, _ = index.within(query, codes.radius)
                found = found[ids[found] != asked[i]]
                if len(found) < rule.k:  # nothing is lost where the radius holds too little: the whole stripe is ranked
                    found = np.flatnonzero(ids != asked[i])
                score = (vectors[found] * asking[i]).sum(axis=1)
                best = np.lexsort((ids[found], -score))[: rule.k] if len(found) <= 4 * rule.k else _best(score, ids[found], rule.k)
                out.append((np.full(len(best), asked[i]), ids[found][best], score[best]))
        columns = [np.concatenate([o[c] for o in out]) if out else np.zeros(0) for c in range(3)]
        return pa.table({"query_id": pa.array(columns[0].astype(np.int64)), "vec_id": pa.array(columns[1].astype(np.int64)), "score": pa.array(columns[2])})

    return search


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    least = np.partition(score, len(score) - k)[len(score) - k]
    some = np.flatnonzero(score >= least)  # ties at the border included
    return some[np.lexsort((ids[some], -score[some]))[:k]]


def usable(table: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part, one for each id."""
    v = F.col(vector).cast("array<double>")
    sound = F.col(id).isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = table.where(F.col(vector).isNotNull()).where(sound).select(F.col(id).cast("long").alias("vec_id"), v.alias("vector"))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def nearest(table: DataFrame, queries: DataFrame | None = None, rule: Search = Search(), id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest ``rule.k`` found for each query, a query's own id left out.

    ``queries`` has the columns of ``table``; without it, rows whose id is divisible by 20 ask. Vectors that are null,
    empty, zero or hold null or non-finite components take no part, nor do rows without an id or of another width than
    most rows. Of repeated rows of one id the smallest vector counts. Equal scores go to the smaller id. Other columns
    are not looked at; an empty table gives an empty result.
    """
    rows = cut(usable(table, id, vector), "vectors")
    width = rows.groupBy(F.size("vector").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    schema = "query_id long, vec_id long, score double"
    if width is None:
        empty = table.sparkSession.createDataFrame([], schema)
        return empty.select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    rows = rows.where(F.size("vector") == width[0])
    asked = rows.where("vec_id % 20 = 0") if queries is None else usable(queries, id, vector).where(F.size("vector") == width[0])
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    n, longest = rows.agg(F.count("*"), F.max(square)).first()
    sample = rows.orderBy(F.xxhash64(F.lit(rule.seed), "vec_id"), "vec_id").limit(rule.sample).collect()
    codes = learn(np.array([r["vector"] for r in sample]), float(np.sqrt(longest)), n, rule)

    stripes, blocks = -(-n // rule.stripe), max(1, -(-asked.count() // rule.block))
    spread = lambda many, name, salt: F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(many)).alias(name)
    each = lambda many, name: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long"))).alias(name)
    left = rows.select("vec_id", "vector", spread(stripes, "s", "stripe"), each(blocks, "b")).groupBy("s", "b")
    right = asked.select("vec_id", "vector", spread(blocks, "b", "block"), each(stripes, "s")).groupBy("s", "b")
    found = left.cogroup(right).applyInArrow(_search(codes, rule), schema)
    ranks = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", ranks).where(F.col("rank") <= rule.k).select("query_id", "rank", "vec_id", "score")
