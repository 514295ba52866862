"""Numbers and sums of rows inside a key, without a task that holds all rows of the key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import cut_lineage


def _ranged(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """df sorted in ranges over (keys, order) and written, with its range and its place."""
    sort = [*keys, *order]
    return cut_lineage(df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumns(
        {"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ranges")


def _with_ranges(ranged: DataFrame, held: DataFrame, keys: list[str]) -> DataFrame:
    """ranged beside held, which has a row for each key and range; null keys meet as well."""
    named = held.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_range").alias("_of"), *[c for c in held.columns if c not in (*keys, "_range")])
    same = F.col("_range") == F.col("_of")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return ranged.join(named, same).drop("_of", *[f"_key{i}" for i in range(len(keys))])


def numbered(df: DataFrame, keys: list[str], order: list[str], column: str) -> DataFrame:
    """df with the rank of each row inside its key, from 1.

    Rows are sorted in ranges over (keys, order) and written; a row's number is its place in its range plus the rows of
    its key in the ranges before, which are few enough for a window.
    """
    ranged = _ranged(df, keys, order)
    held = ranged.groupBy(*keys, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    joined = _with_ranges(ranged, held, keys)
    return joined.withColumn(column, F.col("_at") - F.col("_first") + F.col("_before") + 1).drop("_range", "_at", "_first", "_n", "_before")


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, column: str) -> DataFrame:
    """df with the sum of a column over the rows of its key up to each row.

    As in `numbered`: sums inside a range, plus those of the key's ranges before.
    """
    ranged = _ranged(df, keys, order)
    held = ranged.groupBy(*keys, "_range").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys, "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return _with_ranges(ranged, held, keys).withColumn(column, F.sum(value).over(inside) + F.col("_before")).drop("_range", "_at", "_before")
