"""All readers by name, so that a configuration can say what to read and where it has landed."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators import tables
from caseloom.sources import readers

Reader = Callable[..., DataFrame]


def _of_pages(reader: Reader) -> Reader:
    """A reader of a landed table of pages (url, html)."""
    def read(spark: SparkSession, path: str, **options: Any) -> DataFrame:
        return reader(spark.read.schema("url string, html string").parquet(path), **options)

    return read


def _notices(spark: SparkSession, path: str) -> DataFrame:
    """Of a landed table of notices (source_id, text)."""
    return readers.notice_addresses(spark.read.schema("source_id string, text string").parquet(path))


def _code_headers(spark: SparkSession, path: str) -> DataFrame:
    """Of a folder of code files, each read whole."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    return readers.header_addresses(readers.code_headers(files))


#: Items come from the first nine; the others give addresses or cards.
READERS: dict[str, Reader] = {
    "json_records": readers.json_records,
    "rss": readers.rss,
    "press_json": readers.press_json,
    "markdown_catalog": readers.markdown_catalog,
    "html_list": _of_pages(readers.html_list),
    "message_feed": _of_pages(readers.message_feed),
    "embedded_json": _of_pages(readers.ranked_list),
    "payload_list": _of_pages(readers.payload_list),
    "article": _of_pages(readers.articles),
    "sanctions_xml": readers.sanctions_xml,
    "sanctions_notice": _notices,
    "poc_header": _code_headers,
    "payload_links": _of_pages(readers.payload_links),
    "flat_list": readers.flat_list,
    "blacklist_csv": readers.blacklist_csv,
    "cards_jsonl": readers.cards_jsonl,
}


def read(spark: SparkSession, name: str, path: str | list[str], **options: Any) -> DataFrame:
    """What the named reader makes of what has landed under path."""
    if name not in READERS:
        raise ValueError(f"no reader {name!r}; there are {', '.join(sorted(READERS))}")
    return READERS[name](spark, path, **options)


def collect_items(spark: SparkSession, configured: Iterable[tuple[str, str, dict[str, Any]]]) -> tuple[DataFrame, dict[str, str]]:
    """Items of all configured sources (reader, path, options); a source that cannot be read is reported, the rest goes on."""
    made = {f"{name} {path}": (lambda n=name, p=path, o=options: read(spark, n, p, **o)) for name, path, options in configured}
    return tables.union_sources(made, list(readers.ITEM))
