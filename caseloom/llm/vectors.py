"""What the vector searches share: usable vectors, arrays out of Arrow lists, and the last ranking."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import cut_lineage


def usable(vectors: DataFrame, zero: bool = True) -> DataFrame:
    """(vec_id, dim, embedding array<double>) of every row that takes part.

    Null ids and vectors that are null, empty or hold null or non-finite components are left out; zero vectors too
    unless `zero`. Rows that share an id all count: each is a candidate of other ids' queries, and where they are
    queries the id gets the best that any of them finds.
    """
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad)
    if not zero:
        v = v.where(F.exists("embedding", lambda x: x != 0))
    return cut_lineage(v.select("vec_id", F.size("embedding").alias("dim"), "embedding"), "vectors")


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of an Arrow list column whose lists have one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def ranked(found: DataFrame, k: int, best_first: str) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each query; best_first orders scores, ties go to the smaller id."""
    order = [F.col("score").desc() if best_first == "high" else F.col("score").asc(), F.col("vec_id")]
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
