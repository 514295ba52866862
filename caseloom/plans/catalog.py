"""All named queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseloom.plans import (  # noqa: F401
    q_index, q_quality, q_repair, q_resolve, q_rows, q_sources, q_stream, q_tables, q_text,
)
from caseloom.plans.registry import QUERIES, composed  # noqa: F401


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New incidents and losses per type, from cards through resolution to statistics."""
    return QUERIES["incident_stats"](spark, sf_dir)
