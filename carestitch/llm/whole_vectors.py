"""Vectors with whole-number components, for exact scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Components of this size and beyond take no part, so that the inner product of 8,192 components fits in a long.
MOST = 1 << 25


def whole_vectors(table: DataFrame, scale: int, id: str = "vec_id", vector: str = "embedding", label: str | None = None) -> DataFrame:
    """(vec_id, v[, label]) with v = floor(scale * x), x as double, one row for each id.

    Vectors that are null, empty, or hold null or non-finite components or ones of ``MOST`` or more after scaling take
    no part, nor do rows without an id or (where one is asked for) a label. Of repeated rows of one id the one of the
    smallest v, then label, counts. Zero vectors take part.
    """
    x = F.transform(F.col(vector).cast("array<double>"), lambda c: F.lit(float(scale)) * c)
    rows = table.select(F.col(id).cast("long").alias("vec_id"), x.alias("x"), *([F.col(label).cast("long").alias("label")] if label else []))
    # NaN is larger than any number in comparisons; a null component makes the whole condition null.
    sound = (F.size("x") > 0) & F.forall("x", lambda c: c.isNotNull() & (F.abs(c) < float(MOST)))
    rows = rows.dropna(subset=["vec_id", "x", *(["label"] if label else [])]).where(sound)
    whole = F.transform("x", lambda c: F.floor(c).cast("int"))
    if not label:
        return rows.select("vec_id", whole.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))
    one = rows.select("vec_id", F.struct(whole.alias("v"), "label").alias("row")).groupBy("vec_id").agg(F.min("row").alias("row"))
    return one.select("vec_id", "row.v", "row.label")


def of_usual_width(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows of the width that most have (of the larger one, if two are as frequent), and that width; 0 without rows."""
    width = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    return (rows.where(F.size("v") == width[0]), width[0]) if width else (rows, 0)


def matrix(column: pa.ChunkedArray | pa.Array, width: int, dtype: type = np.int64) -> np.ndarray:
    """A column of lists of one width as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(-1, width)
