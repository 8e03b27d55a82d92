"""Helpers for columns of embedding vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage


def usable(column: str = "embedding", id_column: str = "vec_id") -> Column:
    """Neither null nor zero, and without null or non-finite components; with an id."""
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return (F.col(id_column).isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False))
            & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(len(column), -1)


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Identical vectors as one class: ``(cid, embedding, low, size)`` and ``(vec_id, cid)``.

    ``low`` is the class's smallest vec_id. Counted partially before the
    shuffle, so thousands of copies of a vector are one row a task.
    """
    good = vectors.where(usable()).select(F.col("vec_id").cast("long"), "embedding")
    grouped = good.groupBy("embedding").agg(F.min("vec_id").alias("low"), F.count("*").alias("size"))
    table = stage(grouped.select(F.monotonically_increasing_id().alias("cid"), "*"), "vectors")
    same = table.withColumnRenamed("embedding", "same")
    members = stage(good.join(same, F.col("embedding") == F.col("same")).select("vec_id", "cid"), "members")
    return table, members


def rotation(d: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([d, number]).standard_normal((d, d)))
    return q * np.sign(np.diag(r))
