"""Merkle fixity audit of WARC replicas.

A record's hash covers its header block and payload. Records are leaves of a tree over the byte offsets of their file:
a node of level 0 covers `RANGE` bytes, a node above it `FAN` nodes below, and hashes the (offset or number, hash) list of
what it covers, in order. A file's root is the node that covers its last offset. Replicas are compared from the roots
down: a level is read only under nodes that differ, and only records in ranges that differ are compared one by one.
A range holds few records since a record has at least a header; a node holds at most FAN children; so no group grows.

Defined cases. A record missing in either replica, or at another offset, is reported; so is a record whose hash differs.
Several records at one offset of one file are one leaf, over their hashes in order. Null file or offset: not part of an
archive, left out. Empty tables: no findings. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import cut_lineage

RANGE, FAN = 1 << 16, 16


def record_hash(header: Column, payload: Column) -> Column:
    """Hash of a record's header block and payload; null counts as empty."""
    return F.sha2(F.concat(F.lit("00"), F.sha2(F.coalesce(header, F.lit("")).cast("binary"), 256), F.sha2(F.coalesce(payload, F.lit("")).cast("binary"), 256)), 256)


def archived(pages: DataFrame, per_file: int = 1000) -> DataFrame:
    """(file, offset, length, page_id, hash): pages as response records, `per_file` page ids to a file, in the order of ids.

    A record is its header block, a blank line, the payload and two line ends; offsets are the bytes before it. Pages
    without an id go to files by the hash of their content, after those with one.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    size = F.octet_length(payload)
    header = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
                      size.cast("string"), F.lit("\r\n\r\n"))
    rows = pages.select(
        F.coalesce(F.floor(F.col("page_id") / per_file), F.pmod(F.xxhash64(payload, url), F.lit(1 << 20)) - F.lit(1 << 40)).cast("long").alias("file"),
        F.col("page_id").cast("long").alias("page_id"), (F.octet_length(header) + size + 4).cast("long").alias("length"), record_hash(header, payload).alias("hash"))
    here = Window.partitionBy("file").orderBy("page_id", "hash").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("file", F.coalesce(F.sum("length").over(here), F.lit(0)).cast("long").alias("offset"), "length", "page_id", "hash")


def leaves(records: DataFrame) -> DataFrame:
    """(file, offset, hash), one row an offset."""
    return records.where("file is not null and offset is not null").groupBy("file", "offset").agg(
        F.sha2(F.concat_ws(",", F.array_sort(F.collect_list(F.coalesce("hash", F.lit(""))))), 256).alias("hash"))


def _parents(rows: DataFrame) -> DataFrame:
    """Nodes (file, node, hash) over rows (file, node, at, hash): the hash of what lies in each, in order."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("at", "hash"))), lambda x: F.concat_ws(":", x["at"].cast("string"), x["hash"]))
    return cut_lineage(rows.groupBy("file", "node").agg(F.sha2(F.concat_ws(",", listed), 256).alias("hash")), "nodes")


def _raised(level: DataFrame, fan: int) -> DataFrame:
    return _parents(level.select("file", F.floor(F.col("node") / fan).alias("node"), F.col("node").alias("at"), "hash"))


def tree(records: DataFrame, range_bytes: int = RANGE, fan: int = FAN) -> list[DataFrame]:
    """Levels of nodes (file, node, hash) over leaves, each written once; every file has one node on the last, its root."""
    levels = [_parents(records.select("file", F.floor(F.col("offset") / range_bytes).alias("node"), F.col("offset").alias("at"), "hash"))]
    while (levels[-1].agg(F.max("node").alias("m")).first()["m"] or 0) > 0:
        levels.append(_raised(levels[-1], fan))
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes (file, node) that only one side has, or whose hashes differ."""
    x, y = a.withColumnRenamed("hash", "hash_a"), b.withColumnRenamed("hash", "hash_b")
    return x.join(y, ["file", "node"], "full").where(~F.col("hash_a").eqNullSafe(F.col("hash_b"))).select("file", "node")


def audit(first: DataFrame, second: DataFrame, range_bytes: int = RANGE, fan: int = FAN) -> DataFrame:
    """(file, range_start, offset, status, first_hash, second_hash) of every record that the replicas (file, offset, hash) don't share.

    status: altered, missing (only in first), extra (only in second).
    """
    first, second = cut_lineage(leaves(first), "leaves"), cut_lineage(leaves(second), "leaves")
    x, y = tree(first, range_bytes, fan), tree(second, range_bytes, fan)
    while len(x) < len(y):
        x.append(_raised(x[-1], fan))
    while len(y) < len(x):
        y.append(_raised(y[-1], fan))
    bad = cut_lineage(_differing(x[-1], y[-1]), "roots")
    for a, b in zip(x[-2::-1], y[-2::-1], strict=True):
        under = bad.select("file", F.col("node").alias("above"))

        def inside(level: DataFrame, under: DataFrame = under) -> DataFrame:
            return level.withColumn("above", F.floor(F.col("node") / fan)).join(under, ["file", "above"], "left_semi").drop("above")

        bad = cut_lineage(_differing(inside(a), inside(b)), "branches")
    ranges = bad.select("file", "node")

    def located(records: DataFrame, name: str) -> DataFrame:
        rows = records.withColumn("node", F.floor(F.col("offset") / range_bytes))
        return rows.join(ranges, ["file", "node"], "left_semi").select("file", "node", "offset", F.col("hash").alias(name))

    both = located(first, "first_hash").join(located(second, "second_hash"), ["file", "node", "offset"], "full")
    status = F.when(F.col("second_hash").isNull(), "missing").when(F.col("first_hash").isNull(), "extra").otherwise("altered")
    return both.where(~F.col("first_hash").eqNullSafe(F.col("second_hash"))).select(
        "file", (F.col("node") * range_bytes).alias("range_start"), "offset", status.alias("status"), "first_hash", "second_hash")
