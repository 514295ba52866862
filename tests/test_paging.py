"""Pages out of stored ranges against a plain sort."""

import random

from pyspark.sql import functions as F

from caseloom.operators.paging import SortedPages
from caseloom.session import scratch_path


def test_every_page_equals_the_slice_of_a_sort(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice([None, 1.5, 2.5, 7.0])) for i in range(517)]
    order = [F.col("v").desc_nulls_last(), F.asc("i")]
    df = spark.createDataFrame(rows, "i int, v double")
    pages = SortedPages(spark, scratch_path(spark, "pages"), df.schema).write(df.repartition(5), order, range_rows=60)
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    for number in (1, 2, 7, 24, 26, 27, 400):
        assert [tuple(r) for r in pages.page(number, 20).collect()] == want[(number - 1) * 20 : number * 20]
        assert len(pages.touched(number, 20)) <= 2
    assert pages.page(0, 0).columns == ["i", "v"] and pages.page(0, 0).count() == 1
    assert all(f"_range={i}" in "".join(pages.page(7, 20).inputFiles()) for i, _ in pages.touched(7, 20))
    assert len(pages.page(7, 20).inputFiles()) <= 2
    empty = SortedPages(spark, scratch_path(spark, "pages"), df.schema).write(df.limit(0), order)
    assert empty.page(1).count() == 0
