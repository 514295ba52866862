"""State tables and exports: upserts, snapshots, logs and the files other programs read."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from caseloom.operators.analytics import money
from caseloom.operators.ranking import numbered
from caseloom.session import cut_lineage, freed_shuffles

PARTS = 256


def latest_state(writes: DataFrame, key: str, order: str) -> DataFrame:
    """Last write per key, with the first first_seen kept. An aggregate, so repeated writes combine before the shuffle."""
    rest = [c for c in writes.columns if c not in (key, order, "first_seen")]
    return writes.groupBy(key).agg(
        F.max(F.struct(order, *rest)).alias("s"), F.min("first_seen").alias("first_seen")).select(
        key, *[F.col(f"s.{c}").alias(c) for c in (order, *rest)], "first_seen")


def part_of(key: str, parts: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def append_changes(path: str, changes: DataFrame, key: str, batch_id: int, parts: int = PARTS) -> None:
    """Add the changes of a batch to a state log by key hash and batch.

    No file of another batch is touched; a batch that is written again replaces its own files.
    """
    rows = changes.withColumns({"part": part_of(key, parts), "batch": F.lit(batch_id)})
    overwrite_partitions(rows, path, "part", "batch")


def changes_of(spark: SparkSession, path: str, schema, keys: DataFrame | None = None, key: str = "uid", before: int | None = None,
               parts: int = PARTS) -> DataFrame:
    """Rows of a state log; with keys only those of the keys, read from the partitions that can hold them.

    before: leave out this batch and later ones, so that a batch that runs again sees what it saw first.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, part int, batch int").parquet(path)
    if before is not None:
        rows = rows.where(F.col("batch") < before)
    if keys is not None:
        wanted = keys.select(key).distinct().withColumn("part", part_of(key, parts))
        touched = wanted.select("part").distinct()  # at most `parts` rows: prunes the scan
        rows = rows.join(F.broadcast(touched), "part", "left_semi").join(wanted.select(key), key, "left_semi")
    return rows.drop("part", "batch")


def compacted(spark: SparkSession, path: str, schema, key: str, order: str, to: str, parts: int = PARTS) -> None:
    """The latest state of a log as a log of one batch under another path; `parts` can grow with the data here."""
    state = latest_state(changes_of(spark, path, schema), key, order)
    append_changes(to, state, key, 0, parts)


def overwrite_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replace exactly the partitions present in df; repeating the write changes nothing.

    Rebalancing gives a small partition one file and splits one that holds much of the data.
    """
    with freed_shuffles(df.sparkSession):
        df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def insert_absent(spark: SparkSession, path: str, rows: DataFrame, keys: list[str]) -> None:
    """Append the rows whose key the table lacks."""
    new = rows.dropDuplicates(keys)
    if _exists(spark, path):
        new = cut_lineage(new.join(spark.read.parquet(path).select(*keys), keys, "left_anti"), "absent")
    new.write.mode("append").parquet(path)


def put_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """The rows of a batch in a folder of its own; writing them again changes nothing."""
    with freed_shuffles(rows.sparkSession):
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def batches(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """Rows put by batches, of those before a given one."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, batch int").parquet(path)
    return (rows if before is None else rows.where(F.col("batch") < before)).drop("batch")


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def replace_cards(spark: SparkSession, path: str, cards: DataFrame, addresses: DataFrame) -> None:
    """Store cards and their address rows by collected day; a card stored before is replaced, on whichever day it was.

    The other cards of a day stay. first_seen of an address survives the replacement: rewriting a card is no new
    sighting. A day is written with one row without uid, so that a day left without cards or addresses is empty, not old.
    """
    cards = cut_lineage(cards, "cards")
    fresh = addresses.join(cards.select("uid", "coll_day"), "uid")
    days = cards.select("coll_day").distinct()
    if _exists(spark, f"{path}/cards"):
        stored, held = stored_cards(spark, path), stored_addresses(spark, path)
        moved = stored.select("uid", "coll_day").join(cards.select("uid"), "uid", "left_semi").select("coll_day")
        days = cut_lineage(days.union(moved).distinct(), "days")
        here = held.join(days, "coll_day", "left_semi")
        seen = here.join(cards.select("uid"), "uid", "left_semi").groupBy("uid", "chain", "address").agg(F.min("first_seen").alias("seen"))
        fresh = fresh.join(seen, ["uid", "chain", "address"], "left").withColumn("first_seen", F.least("first_seen", "seen")).drop("seen")
        rest = here.join(cards.select("uid"), "uid", "left_anti")
        fresh = fresh.unionByName(rest.select(*fresh.columns))
        others = stored.join(days, "coll_day", "left_semi").join(cards.select("uid"), "uid", "left_anti")
        cards = cards.unionByName(others.select(*cards.columns))
        # read from the days that are about to be written anew
        cards, fresh = cut_lineage(cards, "cards"), cut_lineage(fresh, "addresses")
    for name, rows in (("cards", cards), ("addresses", fresh)):
        overwrite_partitions(rows.unionByName(_marks(days, rows, "coll_day")), f"{path}/{name}", "coll_day")


def _marks(days: DataFrame, rows: DataFrame, by: str) -> DataFrame:
    """One row of nulls a day, in the columns of rows."""
    return days.select(*[F.col(by) if f.name == by else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields])


def stored_cards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/cards").where("uid is not null")


def stored_addresses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/addresses").where("uid is not null")


def write_jsonl(cards: DataFrame, path: str) -> None:
    """All cards as JSON Lines, newest incident first: ranges of dates in file order, sorted inside."""
    order = [F.desc_nulls_last("incident_date"), F.desc_nulls_last("published_at"), F.asc("uid")]
    cards.repartitionByRange(*order).sortWithinPartitions(*order).write.json(path)


def write_csv(rows: DataFrame, path: str, *order: Column) -> None:
    df = rows.repartitionByRange(*order).sortWithinPartitions(*order) if order else rows
    df.write.option("header", True).option("escape", '"').csv(path)


def write_archive(rows: DataFrame, addresses: DataFrame, path: str, recent_days: int = 90, briefings: DataFrame | None = None,
                  meta: DataFrame | None = None) -> None:
    """The published snapshot: rows per month, recent rows, a slim table of all rows, address rows, briefings and totals."""
    dated = rows.withColumn("month", F.date_format("day", "yyyy-MM"))
    dated.repartition("month", F.pmod(F.xxhash64("uid"), F.lit(8))).write.partitionBy("month").json(f"{path}/archive")
    last = rows.select(F.max("day")).scalar()
    rows.where(F.col("day") >= F.date_sub(last, recent_days)).write.json(f"{path}/recent")
    slim = dated.select("uid", "day", "event_date", "project", "type", "incident_date", "chains", "amount_usd",
                        "amount_text", "source", "followup_uid", "month")
    slim.write.json(f"{path}/all")
    addresses.join(rows.select("uid", "project", "type", "day", "event_date"), "uid").write.json(f"{path}/addresses")
    for name, table in (("briefings", briefings), ("meta", meta)):
        if table is not None:
            table.write.json(f"{path}/{name}")


def write_state(tables: dict[str, DataFrame], path: str) -> None:
    """Portable state: each table in its own folder."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def report_rows(cards: DataFrame, addresses: DataFrame, merged: DataFrame, seen: DataFrame) -> DataFrame:
    """Summary rows of the daily report. merged: (uid, n_merged); seen: (uid, n_seen) addresses known before."""
    n = addresses.groupBy("uid").agg(F.count("*").alias("n_addresses"))
    j = cards.where("relevant").join(n, "uid", "left").join(merged, "uid", "left").join(seen, "uid", "left")
    low = F.lit(-10_000_000)
    j = numbered(j.withColumns({
        "_1": -F.coalesce(F.unix_date(F.coalesce("incident_date", "published_at")), low),
        "_2": -F.coalesce(F.unix_date("published_at"), low)}), ["coll_day"], ["_1", "_2", "uid"], "number")
    name = F.when(F.coalesce("project", F.lit("")) != "", F.col("project")).otherwise(F.col("title"))
    amount = F.coalesce(money(F.col("amount_usd")), F.when(F.col("amount_text") != "", F.col("amount_text")),
                        F.lit("unknown"))
    extra = F.when(F.coalesce("n_merged", F.lit(0)) > 0, F.concat(F.lit(" +"), F.col("n_merged").cast("string"))).otherwise("")
    return j.select(
        F.col("coll_day").alias("day"), "number", "uid", name.alias("name"),
        F.col("incident_type").alias("type"), "incident_date", F.array_join("chains", ", ").alias("chains"),
        amount.alias("amount"), F.coalesce("n_addresses", F.lit(0)).alias("n_addresses"),
        F.concat("source", extra).alias("source"), F.coalesce("n_seen", F.lit(0)).alias("n_seen"))


def union_sources(readers: dict[str, Callable[[], DataFrame]], columns: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """All sources as one table; a source that cannot be read is reported and does not stop the rest."""
    frames, errors = [], {}
    for name, reader in readers.items():
        try:
            frames.append(reader().select(*columns))
        except Exception as error:  # noqa: BLE001 - any failure of one source is isolated
            errors[name] = str(error).splitlines()[0]
    if not frames:
        raise ValueError(f"no source could be read: {errors}")
    return reduce(DataFrame.unionByName, frames), errors
