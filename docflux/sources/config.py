"""Configuration files as small tables: seeds, source lists, rules, feeds, snapshots. They are bounded by hand-written files."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_config(path: str) -> Any:
    """The content of a JSON file, or of a YAML file where PyYAML is installed; an empty file is an empty dict."""
    with open(path, encoding="utf-8") as f:
        if path.endswith((".yaml", ".yml")):
            import yaml  # optional

            return yaml.safe_load(f) or {}
        return json.loads(f.read() or "{}")


def start_urls(spark: SparkSession, path: str) -> DataFrame:
    """(url, position): the list ``startUrls`` of a seed file."""
    seeds = spark.read.schema("startUrls array<string>").json(path, multiLine=True)
    return seeds.select(F.posexplode("startUrls").alias("position", "url")).select("url", "position")


def source_list(spark: SparkSession, config: dict[str, list[dict[str, Any]]]) -> DataFrame:
    """(section, name, url): every entry of every section; entries that are no mapping are left out."""
    rows = [(section, e.get("name"), e.get("url")) for section, entries in config.items() for e in entries or [] if isinstance(e, dict)]
    return spark.createDataFrame(rows, "section string, name string, url string")


def alert_rules(spark: SparkSession, config: list[dict[str, Any]]) -> DataFrame:
    """(name, authorities, keywords): complete rules only, authorities in capitals, keywords in lower case."""
    rows = spark.createDataFrame([(r.get("name"), r.get("authorities"), r.get("match")) for r in config], "name string, authorities array<string>, keywords array<string>")
    whole = rows.where("coalesce(name, '') <> '' and size(authorities) > 0 and size(keywords) > 0")
    return whole.select("name", F.transform("authorities", lambda a: F.upper(a)).alias("authorities"), F.transform("keywords", lambda k: F.lower(k)).alias("keywords"))


def classifier_rules(spark: SparkSession, config: dict[str, dict[str, list[dict[str, Any]]]]) -> DataFrame:
    """(authority, kind, ord, name, keywords) of rules nested as authority -> kind -> list, in declared order."""
    rows = [(authority, kind, i, r.get("name"), list(r.get("keywords") or [])) for authority, kinds in config.items() for kind, listed in (kinds or {}).items() for i, r in enumerate(listed or [])]
    return spark.createDataFrame(rows, "authority string, kind string, ord int, name string, keywords array<string>")


def feed_overrides(spark: SparkSession, config: list[dict[str, Any]] | dict[str, dict[str, Any]]) -> DataFrame:
    """(authority, feed): enabled entries with a feed, from a list or a mapping by authority; a later entry replaces an earlier one."""
    entries = [(e.get("authority"), e) for e in config if isinstance(e, dict)] if isinstance(config, list) else [(k, e) for k, e in config.items() if isinstance(e, dict)]
    kept = {a: e["feed"] for a, e in entries if a and e.get("feed") and e.get("enabled")}
    return spark.createDataFrame(list(kept.items()), "authority string, feed string")


def snapshot(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON snapshot (one object, a list, or lines) under a declared schema."""
    return spark.read.schema(schema).json(path, multiLine=True)


def newest_file(spark: SparkSession, pattern: str) -> str | None:
    """The file of a pattern that was changed last, ties by path; None if there is none."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime")  # contents are not read
    return files.agg(F.max(F.struct("modificationTime", "path")).getField("path")).head()[0]


def table_columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table, position, column, type) of the given tables: a catalog's view of them."""
    rows = [(name, i, f.name, f.dataType.simpleString()) for name, df in tables.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "`table` string, position int, column string, type string")
