"""Shared tables of a session follow their input; steps and their shuffle files go when they have been used."""

import os

from pyspark.sql import functions as F

from caseloom.session import FREE_SHUFFLES, cut_lineage, forget_kept, kept_table, passing_steps


def test_a_replaced_input_gives_new_rows(spark, tmp_path):
    made = []

    def table():
        made.append(1)
        return spark.read.parquet(f"{tmp_path}/t.parquet")

    def kept():
        return sorted(r.id for r in kept_table(spark, str(tmp_path), "t", table).collect())

    spark.range(3).write.parquet(f"{tmp_path}/t.parquet")
    assert kept() == kept() == [0, 1, 2] and len(made) == 1
    spark.range(5).write.mode("overwrite").parquet(f"{tmp_path}/t.parquet")
    assert kept() == [0, 1, 2, 3, 4] and len(made) == 2
    forget_kept()
    assert kept() == [0, 1, 2, 3, 4] and len(made) == 3


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_when_their_step_is_written(spark):
    before = shuffle_files(spark)
    step = cut_lineage(spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count())
    assert not shuffle_files(spark) - before
    assert step.count() == 7 and spark.conf.get(FREE_SHUFFLES) == "false"


def test_steps_of_a_block_go_with_it_unless_they_last(spark):
    with passing_steps():
        with passing_steps():
            inner = cut_lineage(spark.range(3), "inner")
            lasting = cut_lineage(inner, "lasting", lasting=1)
            places = [f.rsplit("/", 1)[0].removeprefix("file://") for df in (inner, lasting) for f in df.inputFiles()[:1]]
        assert [os.path.exists(p) for p in places] == [False, True] and lasting.count() == 3
    assert not os.path.exists(places[1])
    assert cut_lineage(spark.range(3), "outside").count() == 3
