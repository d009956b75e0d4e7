"""Idempotent upserts on plain Parquet: a full outer join on the key decides insert, update or keep, and the outcome is reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row a key, the first in ``order`` (which must be total); NULL keys are left out."""
    return rows.where(F.col(key).isNotNull()).withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def upsert(target: DataFrame, source: DataFrame, key: str, overwrite: list[str], fill: list[str]) -> DataFrame:
    """``target`` after merging ``source`` (one row a key): ``overwrite`` columns take the source's value even if NULL, ``fill`` only if it isn't; ``outcome`` tells inserted, updated or kept."""
    t, s = target.alias("t"), source.alias("s")
    hit, held = F.col(f"s.{key}").isNotNull(), F.col(f"t.{key}").isNotNull()

    def value(c: str) -> Column:
        new, old = F.col(f"s.{c}"), F.col(f"t.{c}")
        if c in overwrite:
            return F.when(hit, new).otherwise(old).alias(c)
        if c in fill:
            return F.coalesce(new, old).alias(c)
        return F.when(held, old).otherwise(new).alias(c)

    outcome = F.when(~held, "inserted").when(hit, "updated").otherwise("kept")
    rest = [c for c in target.columns if c != key]
    return t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full").select(F.coalesce(f"t.{key}", f"s.{key}").alias(key), *map(value, rest), outcome.alias("outcome"))


def insert_missing(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``target`` and the source rows whose key it lacks (first come by key is up to ``latest``)."""
    return target.unionByName(source.join(target.select(key), key, "left_anti").select(*target.columns))


def get_or_create(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., outcome): each key of ``source`` once, 'created' if ``target`` lacks it, else 'found'. Rows with a NULL key are left out."""
    wanted = source.where(" and ".join(f"{k} is not null" for k in keys)).select(*keys).distinct()
    held = target.select(*keys).distinct().withColumn("_held", F.lit(True))
    return wanted.join(held, keys, "left").select(*keys, F.when(F.col("_held"), "found").otherwise("created").alias("outcome"))


def link_backfill(events: DataFrame, docs: DataFrame, least: int = 400) -> DataFrame:
    """(event_id, doc_id): for each event without a document of ``least`` characters, such a document of its url (the latest, then least doc_id)."""
    good = docs.where(F.length("clean_text") >= least)
    poor = events.where("event_id is not null and url is not null").select("event_id", "url").distinct().join(good.select("event_id"), "event_id", "left_anti")
    newest = F.max_by("doc_id", F.struct(F.col("created_at").isNotNull(), "created_at", -F.col("doc_id")))
    by_url = good.where("source_url is not null").groupBy(F.col("source_url").alias("url")).agg(newest.alias("doc_id"))
    return poor.join(by_url, "url").groupBy("event_id").agg(F.min("doc_id").alias("doc_id"))


def insert_variant(target: DataFrame, source: DataFrame) -> DataFrame:
    """Source documents to insert (source_url, event_id): the url itself if free, else url#event=id if that is free, else nothing."""
    taken = target.where("source_url is not null").select(F.col("source_url").alias("u")).distinct()
    rows = source.where("source_url is not null and event_id is not null").select("event_id", "source_url").distinct()
    first = rows.groupBy("source_url").agg(F.min("event_id").alias("first_event"))
    rows = rows.join(first, "source_url").join(taken, F.col("source_url") == F.col("u"), "left")
    free = F.col("u").isNull() & (F.col("event_id") == F.col("first_event"))
    url = F.when(free, F.col("source_url")).otherwise(F.concat("source_url", F.lit("#event="), "event_id"))
    return rows.select("event_id", url.alias("source_url"), (~free).alias("variant")).join(taken, F.col("source_url") == F.col("u"), "left_anti")


def guarded_update(target: DataFrame, source: DataFrame, key: str, value: str, model: str) -> DataFrame:
    """``target`` with ``value`` and ``model`` of source rows of another (or no) model; ``outcome`` tells upserted, skipped or kept."""
    s = source.select(F.col(key).alias("_key"), F.col(value).alias("_value"), F.col(model).alias("_model"))
    rows = target.join(s, F.col(key) == F.col("_key"), "left")
    guard = F.col("_key").isNotNull() & (F.col(model).isNull() | (F.col(model) != F.col("_model")))
    outcome = F.when(guard, "upserted").when(F.col("_key").isNotNull(), "skipped").otherwise("kept")
    out = {value: F.when(guard, F.col("_value")).otherwise(F.col(value)), model: F.when(guard, F.col("_model")).otherwise(F.col(model))}
    return rows.select(*(out[c].alias(c) if c in out else F.col(c) for c in target.columns), outcome.alias("outcome"))


def backfill_model(events: DataFrame, payload: str, model: str, version: str) -> DataFrame:
    """Rows with a payload but no model get model 'legacy-prebatch' and version 'v0'."""
    old = F.col(payload).isNotNull() & F.col(model).isNull()
    return events.withColumn(version, F.when(old, "v0").otherwise(F.col(version))).withColumn(model, F.when(old, "legacy-prebatch").otherwise(F.col(model)))


def page_versions(pages: DataFrame) -> DataFrame:
    """(url, content_hash): each version of a page once, with its first and last sight and its number in time order."""
    seen = pages.groupBy("url", "content_hash").agg(F.min("fetched_at").alias("first_seen"), F.max("fetched_at").alias("last_seen"), F.count(F.lit(1)).alias("fetches"))
    return seen.withColumn("version", F.row_number().over(Window.partitionBy("url").orderBy("first_seen", "content_hash")))
