"""Hard negatives of anchors by Four-Russians scoring.

Vectors have whole-number components. A candidate is stored as the bit planes of its components, packed to one byte for
eight dimensions. For each anchor and each group of eight dimensions a table holds the sums of all 256 subsets of the
anchor's components. The inner product is then looked up: for each plane, from the highest, double what is there and add
the tables' entries at the candidate's bytes. Every score is full and exact.

Rows are dealt to tiles and anchors to blocks of bounded size. A first pass over rows of the anchor's label finds its
positives, a second over all rows the negatives in each positive's window; a tile returns the best few of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import cut
from .whole_vectors import matrix, of_usual_width, whole_vectors

GROUP = 8
#: Anchors whose tables are held at a time, and rows that are scored at a time.
AT_ONCE, ROWS_AT_ONCE = 128, 1024
POSITIVES = "anchor_id long, positive_id long, positive_score long"
NEGATIVES = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


@dataclass(frozen=True)
class HardNegatives:
    """``least``: a negative's score is at least that many hundredths of the positive's (and at most the positive's);
    ``tile`` and ``block``: rows and anchors of one task."""

    scale: int = 256
    positives: int = 5
    negatives: int = 5
    least: int = 80
    tile: int = 8192
    block: int = 1024


def bit_planes(v: np.ndarray, bits: int) -> np.ndarray:
    """(row, plane, group of eight dimensions) bytes of two's complement; ``bits`` with the sign's."""
    wide = np.pad(v, ((0, 0), (0, -v.shape[1] % GROUP)))
    return np.stack([np.packbits((wide >> plane) & 1, axis=1, bitorder="little") for plane in range(bits)], axis=1)


def subset_sums(anchors: np.ndarray, dtype: type = np.int64) -> np.ndarray:
    """(group, byte, anchor): the sum of the components whose bits are set in the byte."""
    wide = np.pad(anchors, ((0, 0), (0, -anchors.shape[1] % GROUP))).T.reshape(-1, GROUP, len(anchors)).astype(dtype)
    sums = np.zeros((len(wide), 1 << GROUP, len(anchors)), dtype)
    for bit in range(GROUP):
        sums[:, 1 << bit : 2 << bit] = sums[:, : 1 << bit] + wide[:, bit, None]
    return sums


def look_up(planes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """(row, anchor) inner products."""
    score = np.zeros((len(planes), sums.shape[2]), sums.dtype)
    for plane in reversed(range(planes.shape[1])):
        score *= 2
        for group in range(len(sums)):
            found = sums[group][planes[:, plane, group]]
            if plane == planes.shape[1] - 1:  # the sign's
                score -= found
            else:
                score += found
    return score


def _scores(planes: np.ndarray, anchors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(anchor, its scores of all rows)."""
    most = int(np.abs(anchors).sum(axis=1).max(initial=0)) << planes.shape[1]
    dtype = np.int32 if most < 1 << 31 else np.int64
    for at in range(0, len(anchors), AT_ONCE):
        sums = subset_sums(anchors[at : at + AT_ONCE], dtype)
        parts = [look_up(planes[r : r + ROWS_AT_ONCE], sums).T for r in range(0, len(planes), ROWS_AT_ONCE)]
        for i, score in enumerate(np.concatenate(parts, axis=1)):
            yield at + i, score.astype(np.int64)


def _first(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Those of ``rows`` with the ``k`` highest scores, ties to the smaller id."""
    if len(rows) > 8 * k:
        s = score[rows]
        rows = rows[s >= np.partition(s, len(s) - k)[len(s) - k]]
    return rows[np.lexsort((ids[rows], -score[rows]))[:k]]


def _read(rows: pa.Table, anchors: pa.Table, width: int, bits: int) -> tuple[np.ndarray, ...]:
    packed = np.frombuffer(b"".join(rows.column("planes").to_pylist()), np.uint8).reshape(-1, bits, -(-width // GROUP))
    return rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), packed, matrix(anchors.column("v"), width)


def _table(columns: list[list[np.ndarray]], schema: str) -> pa.Table:
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.table({n: pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for n, c in zip(names, columns, strict=True)})


def _positives(rule: HardNegatives, width: int, bits: int):
    def find(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        columns: list[list[np.ndarray]] = [[], [], []]
        if rows.num_rows and anchors.num_rows:
            ids, _, planes, asked = _read(rows, anchors, width, bits)
            names = anchors.column("vec_id").to_numpy()
            for i, score in _scores(planes, asked):
                best = _first(score, ids, np.flatnonzero(ids != names[i]), rule.positives)
                for c, values in zip(columns, (np.full(len(best), names[i]), ids[best], score[best]), strict=True):
                    c.append(values)
        return _table(columns, POSITIVES)

    return find


def _negatives(rule: HardNegatives, width: int, bits: int):
    def find(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        columns: list[list[np.ndarray]] = [[], [], [], [], []]
        if rows.num_rows and anchors.num_rows:
            ids, labels, planes, asked = _read(rows, anchors, width, bits)
            names, of = anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy()
            partners, limits = anchors.column("positive_ids").to_pylist(), anchors.column("positive_scores").to_pylist()
            for i, score in _scores(planes, asked):
                some = np.flatnonzero((labels != of[i]) & (score <= max(limits[i])) & (100 * score >= rule.least * min(limits[i])))
                for partner, limit in zip(partners[i], limits[i], strict=True):
                    s = score[some]
                    best = _first(score, ids, some[(s <= limit) & (100 * s >= rule.least * limit)], rule.negatives)
                    values = (np.full(len(best), names[i]), np.full(len(best), partner), np.full(len(best), limit), ids[best], score[best])
                    for c, v in zip(columns, values, strict=True):
                        c.append(v)
        return _table(columns, NEGATIVES)

    return find


def _dealt(rows: DataFrame, key: str, many: Column, name: str) -> DataFrame:
    return rows.withColumn(name, F.pmod(F.xxhash64(F.lit(name), key), many.cast("long")))


def _each(rows: DataFrame, many: Column, name: str) -> DataFrame:
    return rows.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), many.cast("long") - 1)))


def _pack(rows: DataFrame, width: int, bits: int) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            planes = [p.tobytes() for p in bit_planes(matrix(batch.column("v"), width), bits)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(planes, pa.binary())], names=["vec_id", "label", "planes"])

    return rows.select("vec_id", "label", "v").mapInArrow(pack, "vec_id long, label long, planes binary")


def hard_negatives(
    table: DataFrame, anchors: Column | None = None, rule: HardNegatives = HardNegatives(),
    id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor's positives are its ``rule.positives`` highest other rows of its label; for each, the highest
    ``rule.negatives`` rows of other labels in its window follow, ties to the smaller id. ``anchors`` is a condition on
    vec_id and label (ids divisible by 100 where it is left out). Which rows take part, and what holds for repeated ids,
    says ``whole_vectors``; rows of another width than most take no part. Anchors without positives, and positives without
    negatives, give no rows, as does an empty table. Other columns aren't looked at.
    """
    rows, width = of_usual_width(cut(whole_vectors(table, rule.scale, id, vector, label), "rows"))
    if not width:
        return table.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    asking = rows.where(F.col("vec_id") % 100 == 0 if anchors is None else anchors)
    low, high, n = rows.agg(F.min(F.array_min("v")), F.max(F.array_max("v")), F.count("*")).first()
    bits = max(int(high).bit_length(), (-int(low) - 1).bit_length() if low < 0 else 0) + 1
    packed = cut(_pack(rows, width, bits), "planes")

    # Tiles of a label's rows and blocks of its anchors: a frequent label has more of both.
    share = lambda by, most, name: by.groupBy("label").agg(F.ceil(F.count("*") / most).alias(name))
    sizes = cut(share(packed, rule.tile, "tiles").join(share(asking, rule.block, "blocks"), "label"), "sizes")
    left = _each(_dealt(packed.join(sizes, "label"), "vec_id", F.col("tiles"), "t"), F.col("blocks"), "b").drop("tiles", "blocks").groupBy("label", "t", "b")
    right = _each(_dealt(asking.join(sizes, "label"), "vec_id", F.col("blocks"), "b"), F.col("tiles"), "t").drop("tiles", "blocks").groupBy("label", "t", "b")
    found = left.cogroup(right).applyInArrow(_positives(rule, width, bits), POSITIVES)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    few = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rule.positives)
    few = few.groupBy("anchor_id").agg(F.collect_list("positive_id").alias("positive_ids"), F.collect_list("positive_score").alias("positive_scores"))
    ready = cut(asking.join(few.withColumnRenamed("anchor_id", "vec_id"), "vec_id"), "anchors")

    tiles, blocks = F.lit(-(-n // rule.tile)), F.lit(max(1, -(-ready.count() // rule.block)))
    left = _each(_dealt(packed, "vec_id", tiles, "t"), blocks, "b").groupBy("t", "b")
    right = _each(_dealt(ready, "vec_id", blocks, "b"), tiles, "t").groupBy("t", "b")
    found = left.cogroup(right).applyInArrow(_negatives(rule, width, bits), NEGATIVES)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rule.negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def relabelled(table: DataFrame) -> DataFrame:
    """The rows with the next label of ten where vec_id is divisible by 7."""
    return table.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id AND a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT s.same
WHERE 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""
