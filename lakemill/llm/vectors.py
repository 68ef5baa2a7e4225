"""Vectors of a table for tasks: which rows count, and Arrow batches as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(embeddings: DataFrame, limit: float) -> DataFrame:
    """vec_id, label, vec of the rows whose vector counts: all entries there, finite and below limit in size.

    Empty vectors do not count. Of vectors of several lengths the commonest length counts, of equally common ones the longest.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= limit))
    label = F.col("label") if "label" in embeddings.columns else F.lit(None).cast("int").alias("label")
    rows = embeddings.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad).select("vec_id", label, F.col("embedding").cast("array<double>").alias("vec"))
    top = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("vec") == (top["d"] if top else 0))


def matrix(column: pa.Array, scale: float, shift: int = 0) -> np.ndarray:
    """floor(scale * entry) + shift of a list column without nulls, as a matrix of int64."""
    if not len(column):
        return np.zeros((0, 0), np.int64)
    return np.floor(scale * column.flatten().to_numpy(zero_copy_only=False)).astype(np.int64).reshape(len(column), -1) + shift
