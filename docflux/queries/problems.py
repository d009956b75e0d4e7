"""Queries of the core's numbered problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docflux.operators.timestamps import TimestampDictionary, event_instants, normalize_timestamps
from docflux.sources.tables import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event whose pub_date names an instant, with that instant."""
    return event_instants(table(spark, sf_dir, "policy_events"), table(spark, sf_dir, "authorities"))


def p1_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivery with the instant that its pub_date names (NULL if none)."""
    rows = table(spark, sf_dir, "policy_events").select("event_id", "authority", "pub_date")
    return normalize_timestamps(rows, "pub_date", table(spark, sf_dir, "authorities"), TimestampDictionary(spark), "pub_utc_us")


QUERIES = {"p1_found": p1_found, "p1_instants": p1_instants}
SQL: dict[str, str] = {}
