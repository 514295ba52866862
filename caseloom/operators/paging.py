"""Pages of a sorted table that read the range they lie in, however far down they are.

The table is written once in ranges of its order, with each row's place in its range, and a directory of the ranges: the
place of its first row and its number of rows. A page asks the directory, then opens the ranges that overlap it, one or
two. Nothing is sorted or skipped for the rows before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

RANGE_ROWS = 100_000
RANGE, AT = "_range", "_at"


class SortedPages:
    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        """schema: of the rows that are stored there."""
        self.spark, self.path, self.schema = spark, path, schema

    def _stored(self) -> StructType:
        return StructType([*self.schema.fields, StructField(AT, LongType()), StructField(RANGE, IntegerType())])

    def write(self, rows: DataFrame, order: list[Column], range_rows: int = RANGE_ROWS) -> SortedPages:
        """Store rows in an order that no two of them share."""
        ranges = max(1, -(-rows.count() // range_rows))
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # of a row in its task
        dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumns({AT: place, RANGE: F.spark_partition_id()})
        dealt.write.mode("overwrite").partitionBy(RANGE).parquet(f"{self.path}/rows")
        held = self.spark.read.schema(self._stored()).parquet(f"{self.path}/rows").groupBy(RANGE).agg(F.count("*").alias("n"))
        before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)  # a row a range
        held.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/directory")
        return self

    def touched(self, number: int, size: int) -> list[tuple[int, int]]:
        """(range, place of its first row) of the ranges a page lies in."""
        low = (max(1, number) - 1) * size
        held = self.spark.read.parquet(f"{self.path}/directory").where((F.col("first") < low + size) & (F.col("first") + F.col("n") > low))
        return [(r[RANGE], r["first"]) for r in held.orderBy("first").collect()]

    def page(self, number: int = 1, size: int = 20, largest: int = 200) -> DataFrame:
        """The rows of a page, in order; none beyond the last."""
        size = max(1, min(size, largest))
        low, touched = (max(1, number) - 1) * size, self.touched(number, size)
        if not touched:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self._stored()).option("basePath", f"{self.path}/rows").parquet(*[f"{self.path}/rows/{RANGE}={i}" for i, _ in touched])
        first = F.element_at(F.create_map(*[F.lit(x) for pair in touched for x in pair]), F.col(RANGE))
        return rows.withColumn(AT, F.col(AT) + first).where(F.col(AT).between(low, low + size - 1)).orderBy(AT).drop(RANGE, AT)
