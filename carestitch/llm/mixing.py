"""Mixing of sources to target weights by subset-sum budget fitting.

Targets come from the sources' weights by repeated sharing (no source above its cap). Documents are counted by exact
length; per source, whole passes are taken first, then a share of every length by running rounding, and a
bounded-knapsack program over the lengths that are left fits what the rounding misses. Which documents of a length
are taken is decided by a seeded hash, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .scratch import cut
from .words import WORD

#: Words of the budget that the program decides; what exceeds it (texts of greater length only) goes longest first.
_PROGRAM_WORDS = 1 << 16


def word_count(text: str = "text") -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weights repeat over the sources in code point order.

    The budget is ``share`` times all sizes. A source above ``cap`` times its size gets just that, and the excess is
    shared anew among the others by weight until none is above.
    """
    ranged = sizes.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    # The position inside a range is written with the row; ranges are numbered in order and there are few of them.
    placed = cut(ranged.withColumn("at", F.monotonically_increasing_id()).withColumn("range", F.shiftright("at", 33)), "sources")
    counts = placed.groupBy("range").agg(F.count("*").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    position = F.col("before") + F.col("at") - F.shiftleft("range", 33)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (position % len(weights) + 1).cast("int"))
    ready = cut(placed.join(counts, "range").select("source", "source_size", weight.alias("weight")), "weighted")
    most, w = F.col("source_size") * float(cap), F.col("weight")
    budget, level, seen = share * float(ready.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]), 0.0, -1
    while True:
        full, rest, n = ready.agg(
            F.coalesce(F.sum(F.when(most <= level * w, most)), F.lit(0.0)), F.coalesce(F.sum(F.when(most > level * w, w)), F.lit(0.0)),
            F.count(F.when(most <= level * w, 1))).first()
        if n == seen or rest == 0:
            break
        seen, level = n, (budget - full) / rest
    target = F.least(most, F.lit(level) * w) if rest else most
    return ready.select("source", "source_size", target.alias("target"))


def fit_lengths(length: np.ndarray, count: np.ndarray, budget: int) -> tuple[int, np.ndarray]:
    """(whole passes, documents of each length to take once more) whose words come nearest to ``budget`` from below.

    Running rounding over the sorted lengths leaves less than about one length of the budget; the program then finds,
    over all lengths with documents left, the largest sum that fits, as one bit for each reachable sum.
    """
    total = int((length * count).sum())
    if not total or budget <= 0:
        return 0, np.zeros_like(count)
    passes, rest = divmod(budget, total)
    words = length * count
    share = np.floor(np.cumsum(words) * (rest / total))
    take = np.zeros_like(count)
    done = 0
    for i in range(len(length)):
        if length[i]:
            take[i] = min(count[i], max(0, int(share[i] - done) // int(length[i])))
            done += int(take[i] * length[i])
    left = int(rest - done)
    for i in np.argsort(-length, kind="stable").tolist():
        if left <= _PROGRAM_WORDS:
            break
        more = min(int(count[i] - take[i]), left // int(length[i])) if length[i] else 0
        take[i] += more
        left -= more * int(length[i])
    if left > _PROGRAM_WORDS:
        return passes, take
    mask, reach, steps = (1 << (left + 1)) - 1, 1, []
    for i in np.argsort(-length, kind="stable").tolist():
        spare, size, part = int(count[i] - take[i]), int(length[i]), 1
        while spare and size and size <= left and not reach >> left & 1:
            part = min(part, spare)
            if size * part > left:
                if part == 1:
                    break
                spare, part = min(spare, left // size), 1
                continue
            steps.append((i, part, reach))
            reach |= (reach << size * part) & mask
            spare -= part
            part *= 2
    best = reach.bit_length() - 1
    for i, part, before in reversed(steps):
        if not before >> best & 1:
            take[i] += part
            best -= int(length[i]) * part
    return passes, take


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("size", ignore_index=True)
    budget = int(round(float(pdf["target"].iloc[0])))
    passes, take = fit_lengths(pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), budget)
    return pdf.assign(passes=passes, extra=take)[["source", "size", "n", "passes", "extra"]]


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 1,
    size: Column | None = None, id: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """(doc_id, version, size, source_size, target, taken) for each row; ``taken`` is a whole multiple of its size.

    ``version`` is a hash of the text, for joining back. Sources sort by code point, null last, as one more source.
    Null or empty texts have size 0 and take nothing. Repeated rows are documents of their own, but identical ones
    (same id, source and text) can't be told apart: they are ranked in any order. Null ids rank by their text. Targets
    are rounded to whole words. An empty table gives an empty result. No row is dropped: what the mix leaves out has
    ``taken`` 0.
    """
    work = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), F.xxhash64(text).alias("version"),
                       (word_count(text) if size is None else size).alias("size"))
    sized = cut(work.withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "version")), "sized")
    lengths = cut(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    targets = cut(source_targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, cap), "targets")
    keyed = targets.withColumnRenamed("source", "t_source")
    budgets = lengths.join(keyed, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    schema = T.StructType([lengths.schema["source"], lengths.schema["size"], lengths.schema["n"], T.StructField("passes", T.LongType()), T.StructField("extra", T.LongType())])
    plan = cut(budgets.groupBy("source").applyInPandas(_fit, schema), "plan")

    # A length with many documents is drawn by slices of the hash: whole slices go by their counts, one is ranked.
    plan = plan.withColumn("slices", F.greatest(F.lit(1), F.ceil(F.col("n") / 512)).cast("long"))
    left = plan.select(F.col("source").alias("p_source"), F.col("size").alias("p_size"), "passes", "extra", "slices")
    drawn = sized.join(left, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size"))).drop("p_source", "p_size")
    drawn = drawn.withColumn("slice", F.pmod("draw", "slices"))
    counted = drawn.groupBy("source", "size", "slice").agg(F.count("*").alias("in_slice"))
    before = F.sum("in_slice").over(Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    counted = cut(counted.withColumn("before", F.coalesce(before, F.lit(0))), "slices")
    ranks = Window.partitionBy("source", "size", "slice").orderBy("draw", "doc_id", "version")
    ranked = drawn.withColumn("rank", F.row_number().over(ranks))
    at = counted.select(F.col("source").alias("c_source"), F.col("size").alias("c_size"), F.col("slice").alias("c_slice"), "before")
    ranked = ranked.join(at, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("size") == F.col("c_size")) & (F.col("slice") == F.col("c_slice")))
    times = F.col("passes") + F.when(F.col("before") + F.col("rank") <= F.col("extra"), 1).otherwise(0)
    result = ranked.select("doc_id", "version", "source", "size", (times * F.col("size")).alias("taken"), times.alias("times"))
    result = result.join(keyed, F.col("source").eqNullSafe(F.col("t_source")))
    return result.select("doc_id", "version", "size", "source_size", "target", "taken", "times")
