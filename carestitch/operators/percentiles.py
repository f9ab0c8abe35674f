"""Exact percentiles per group that never sort more than a fixed number of values in one task.

Values are counted per group and distinct value first. A group is one slice to begin with. As long as a slice that holds
a wanted rank has more than ``MOST`` distinct values, a mergeable sketch over its values yields splitters, totals of
the parts tell which of them hold the ranks, and only those go on. So each round leaves a few hundredths of a large
slice, and what is sorted in the end is bounded, however dominant a group is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sinks.parquet import shared_folder, write_and_reload

#: Distinct values that one task sorts at most.
MOST = 1_000_000
PARTS = 256  # a power of two
#: Slices cut in one round whose splitters (2 KB each) are broadcast.
BROADCAST_SLICES = 5_000


def _with_part(df: DataFrame, out: str) -> DataFrame:
    """How many of the row's sorted ``_cuts`` lie below its value, by halving."""
    df, step = df.withColumn(out, F.lit(0)), PARTS // 2
    while step:
        below = F.get("_cuts", F.col(out) + (step - 1)) < F.col("_v")
        df = df.withColumn(out, F.col(out) + F.when(below, step).otherwise(0))
        step //= 2
    return df


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, _v, _n): how often each value occurs in its group."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))


class _Ranks:
    """Positions of the wanted percentiles in a group of ``_total`` values."""

    def __init__(self, percentiles: Mapping[str, float]):
        self.percentiles = percentiles

    def position(self, name: str) -> Column:
        return F.lit(self.percentiles[name]) * (F.col("_total") - 1)

    def items(self) -> list[tuple[str, Column]]:
        return [(f"_{n}_{edge}", round_(self.position(n))) for n in self.percentiles for edge, round_ in (("lo", F.floor), ("hi", F.ceil))]

    def inside(self, rank: Column, start: str, length: str) -> Column:
        return (rank >= F.col(start)) & (rank < F.col(start) + F.col(length))

    def any_inside(self, start: str, length: str) -> Column:
        found = F.lit(False)
        for _, rank in self.items():
            found = found | self.inside(rank, start, length)
        return found


def wanted_slices(counted: DataFrame, keys: Sequence[str], percentiles: Mapping[str, float], most: int = MOST) -> DataFrame:
    """Rows of ``counted`` in slices that hold wanted ranks, none of more than ``most`` distinct values.

    Adds ``_slice``, ``_before`` (values of the group below the slice) and ``_total`` (values of the group). ``counted`` is
    read several times and should be a written table.
    """
    keys, ranks, folder = list(keys), _Ranks(percentiles), shared_folder(counted.sparkSession)
    size = [F.sum("_n").alias("_in_slice"), F.count(F.lit(1)).alias("_distinct")]
    same = lambda right, names: [F.col(k).eqNullSafe(right[f"_of_{k}"]) for k in names]
    aside = lambda df, names: df.withColumnsRenamed({k: f"_of_{k}" for k in names})

    if counted.count() <= most:  # so is each group
        return counted.select("*", F.lit("").alias("_slice"), F.lit(0).cast("bigint").alias("_before"), F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"))
    groups = aside(counted.groupBy(*keys).agg(*size), keys).withColumnsRenamed({"_in_slice": "_total"}).withColumn("_before", F.lit(0).cast("bigint"))
    groups = write_and_reload(groups, f"{folder}/groups")
    done = None
    if groups.filter(F.col("_distinct") <= most).limit(1).count():
        small = groups.filter(F.col("_distinct") <= most)
        done = counted.join(small, same(small, keys)).select(*counted.columns, F.lit("").alias("_slice"), "_before", "_total")
    large = groups.filter(F.col("_distinct") > most).withColumn("_of__slice", F.lit(""))
    rows, of, turn = counted.withColumn("_slice", F.lit("")), [*keys, "_slice"], 0
    while many := large.count():
        turn += 1
        open_ = rows.join(large, same(large, of)).select(*counted.columns, "_slice", "_before", "_total")
        cuts = aside(open_.groupBy(*of).agg(F.percentile_approx("_v", [i / PARTS for i in range(1, PARTS)], 1000).alias("_cuts")), of)
        cuts = write_and_reload(cuts, f"{folder}/cuts-{turn}")
        cuts = F.broadcast(cuts) if many <= BROADCAST_SLICES else cuts
        part = F.concat("_slice", F.lit("/"), F.col("_part").cast("string"))
        rows_now = _with_part(open_.join(cuts, same(cuts, of)), "_part").select(*counted.columns, part.alias("_slice"), F.col("_slice").alias("_parent"), "_before", "_total")
        parts = rows_now.groupBy(*of, "_parent").agg(*size, F.min("_v").alias("_least"), F.first("_before").alias("_first"), F.first("_total").alias("_total"))
        # At most PARTS rows for each slice enter this window.
        earlier = Window.partitionBy(*keys, "_parent").orderBy("_least").rowsBetween(Window.unboundedPreceding, -1)
        placed = parts.withColumn("_before", F.col("_first") + F.coalesce(F.sum("_in_slice").over(earlier), F.lit(0)))
        hit = aside(placed.filter(ranks.any_inside("_before", "_in_slice")), of).select(*[f"_of_{k}" for k in of], "_before", "_total", "_distinct")
        hit = write_and_reload(hit, f"{folder}/hit-{turn}")
        kept = rows_now.drop("_parent", "_before", "_total")
        few = hit.drop("_distinct")
        rows = write_and_reload(kept.join(few, same(few, of)).select(*counted.columns, "_slice", "_before", "_total"), f"{folder}/rows-{turn}")
        fine = hit.filter(F.col("_distinct") <= most).drop("_before", "_total")
        sorted_now = rows.join(fine, same(fine, of), "left_semi")
        done = sorted_now if done is None else done.unionByName(sorted_now)
        large, rows = hit.filter(F.col("_distinct") > most), rows.drop("_before", "_total")
    return done


def percentiles_of_counts(counted: DataFrame, keys: Sequence[str], percentiles: Mapping[str, float], most: int = MOST) -> DataFrame:
    """One row per group with the linearly interpolated percentiles of counted values (keys, _v, _n)."""
    keys, ranks = list(keys), _Ranks(percentiles)
    smaller = Window.partitionBy(*keys, "_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    located = wanted_slices(counted, keys, percentiles, most).withColumn("_start", F.col("_before") + F.coalesce(F.sum("_n").over(smaller), F.lit(0)))
    picked = located.groupBy(*keys).agg(
        F.max("_total").alias("_total"),
        *[F.max(F.when(ranks.inside(rank, "_start", "_n"), F.col("_v"))).alias(name) for name, rank in ranks.items()],
    )

    def interpolated(name: str) -> Column:
        low, high, at = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), ranks.position(name)
        return low + (high - low) * (at - F.floor(at))

    return picked.select(*keys, *[interpolated(n).alias(n) for n in percentiles])


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, percentiles: Mapping[str, float], most: int = MOST) -> DataFrame:
    """One row per group with the linearly interpolated percentiles of a numeric column.

    percentiles  output column → fraction. Groups without a value are absent.
    """
    counted = write_and_reload(value_counts(df, keys, value), f"{shared_folder(df.sparkSession)}/counts")
    return percentiles_of_counts(counted, keys, percentiles, most)
