"""Session set-up and the shared folder for checkpoints and landed files."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "caseloom", **conf) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.default.parallelism", "8")
    )
    defaults = {"spark.sql.shuffle.partitions": 8}
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session may fall back to a temporary folder of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    named = tempfile.mkdtemp(prefix="caseloom-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place in the application's own part of the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder; for the end of a run, when its results are written."""
    delete_path(spark, _scratch_root(spark))
    for key in [k for k in _KEPT if k[0] == spark.sparkContext.applicationId]:
        del _KEPT[key]


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written in the block go when the write is done, not when the driver collects its garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


_OPEN = threading.local()


@contextmanager
def passing_steps() -> Iterator[None]:
    """Steps that the block writes are deleted at its end, unless they are lasting; these go to the block around it, if any.

    Also a decorator. What leaves the block must be read from lasting steps alone.
    """
    scopes = _OPEN.__dict__.setdefault("scopes", [])
    scopes.append([])
    try:
        yield
    finally:
        for spark, path in scopes.pop():
            delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df: DataFrame, name: str = "step", lasting: int = 0) -> DataFrame:
    """Write a step to the shared folder and read it back.

    The plan that follows starts from a table with known size and columns, and a lost executor costs no recomputation
    of what came before. The step's shuffle files are not needed any more; the table itself goes with the innermost block
    of `passing_steps`, or with a block around that one: lasting says how many blocks it outlives.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    scopes = _OPEN.__dict__.get("scopes", [])
    if len(scopes) > lasting:
        scopes[-1 - lasting].append((spark, path))
    with freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_KEPT: dict[tuple[str, str, str, tuple], str] = {}


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the files of the tables in a folder: a replaced table gives another stamp."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/*.parquet")
    files, out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), []
    for table in files.globStatus(place) or []:
        held = [table] if table.isFile() else files.listStatus(table.getPath())
        out += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in held]
    return tuple(sorted(out))


def kept_table(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame], write: bool = True) -> DataFrame:
    """A table that several queries of one session read: written to the shared folder by the first of them.

    It is made anew when the files of sf_dir have changed. A query that reads a few columns of it once does not write it:
    unless another one has, it gets the table as it is made, and what it doesn't read is not made either.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name, _stamp(spark, sf_dir))
    if key not in _KEPT:
        if not write:
            return make()
        path = scratch_path(spark, name)
        made = make()
        with freed_shuffles(spark):
            made.write.parquet(path)
        _KEPT[key] = path
    return spark.read.parquet(_KEPT[key])


def forget_kept() -> None:
    """Let the next query write its shared tables again; the files stay until clear_scratch."""
    _KEPT.clear()


def spread(df: DataFrame) -> DataFrame:
    """Give costly per-row work all cores when the input has too few splits; large inputs have enough and stay as is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
