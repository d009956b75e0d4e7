"""Coverage, completeness and freshness of events and their documents.

Events and documents are joined 1:N on ``event_id`` by shuffle (both sides grow); everything after that combines map-side.
NULL authorities form a group of their own, told apart from the total by ``grouping``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters from which a document counts as usable.
USABLE = 400


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, rounded; NULL for an empty whole."""
    return F.round(F.when(whole != 0, 100.0 * part / whole), digits)


def with_documents(events: DataFrame, docs: DataFrame) -> DataFrame:
    """Each event with each of its documents, events without any once (documents' columns prefixed by ``d_``)."""
    right = docs.select("event_id", F.col("doc_id").alias("d_id"), F.length("clean_text").alias("d_len"), F.col("source_url").alias("d_url"))
    return events.join(right, "event_id", "left")


def completeness(joined: DataFrame, total: bool = False) -> DataFrame:
    """Rows, usable documents, summaries and embeddings of each authority over joined rows; ``total`` adds a GLOBAL row."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("d_len") >= USABLE).alias("docs_ok"), F.count("summary_en").alias("summaries"), F.count("embedding").alias("embeddings")]
    grouped = joined.rollup("authority").agg(F.grouping("authority").alias("g"), *aggs) if total else joined.groupBy("authority").agg(*aggs)
    name = F.when(F.col("g") == 1, "GLOBAL").otherwise(F.col("authority")) if total else F.col("authority")
    cols = ["n_rows", "docs_ok", "summaries", "embeddings"]
    return grouped.select(name.alias("authority"), *cols, *(pct(F.col(c), F.col("n_rows")).alias(f"{c}_pct") for c in cols[1:]))


def distinct_completeness(joined: DataFrame) -> DataFrame:
    """As completeness, but events are counted once however many documents they have; the denominator stays the rows."""
    e = F.col("event_id")
    return joined.groupBy("authority").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(e).alias("events"),
        F.count_distinct(F.when(F.col("d_len") >= USABLE, e)).alias("events_with_doc"),
        F.count_distinct(F.when(F.col("summary_en").isNotNull(), e)).alias("events_with_summary"),
    ).withColumn("doc_pct", pct(F.col("events_with_doc"), F.col("n_rows")))


def freshness(events: DataFrame, as_of: str, days: tuple[int, ...] = (7, 30, 90)) -> DataFrame:
    """Events seen within each of the last ``days`` before ``as_of``, counts and shares, in one pass."""
    within = {d: F.count_if(F.col("access_ts") >= F.lit(as_of).cast("timestamp") - F.make_interval(days=F.lit(d))) for d in days}
    rows = events.groupBy("authority").agg(F.count(F.lit(1)).alias("n"), *(c.alias(f"last_{d}d") for d, c in within.items()))
    return rows.select("authority", "n", *(f"last_{d}d" for d in days), *(pct(F.col(f"last_{d}d"), F.col("n"), 1).alias(f"pct_{d}d") for d in days))


def windowed_completeness(joined: DataFrame, as_of: str, days: tuple[int, ...] = (7, 30, 90)) -> DataFrame:
    """Completeness of the rows of each window before ``as_of``, one row a window."""
    stamp = F.lit(as_of).cast("timestamp")
    inside = joined.withColumn("days", F.explode(F.filter(F.array(*map(F.lit, days)), lambda d: F.col("access_ts") >= stamp - F.make_interval(days=d))))
    return inside.groupBy("days").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("d_len") >= USABLE).alias("docs_ok"), F.count("summary_en").alias("summaries"))


def by_authority(events: DataFrame, docs: DataFrame, as_of: str) -> DataFrame:
    """Distinct events and documents, latest sight and its age in days."""
    rows = with_documents(events, docs).groupBy("authority").agg(F.count_distinct("event_id").alias("events"), F.count_distinct("d_id").alias("docs"), F.max("access_ts").alias("latest"))
    return rows.select("authority", "events", "docs", F.unix_micros("latest").alias("latest_us"), F.floor((F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("latest")) / 86_400_000_000).alias("age_days"))


def status_label(age: Column) -> Column:
    """Active below 30 days, else Stale; an age of 0 or NULL is Stale."""
    return F.when(age.isNotNull() & (age != 0) & (age < 30), "Active").otherwise("Stale")


def enrichment(events: DataFrame, column: str, model: str) -> DataFrame:
    """Rows with ``column`` and with its ``model``, and the distinct models, of each authority and in total."""
    rows = events.rollup("authority").agg(F.grouping("authority").alias("g"), F.count(F.lit(1)).alias("n"), F.count(column).alias("filled"), F.count(model).alias("with_model"), F.count_distinct(model).alias("models"))
    return rows.select(F.when(F.col("g") == 1, "GLOBAL").otherwise(F.col("authority")).alias("authority"), "n", "filled", "with_model", "models", pct(F.col("filled"), F.col("n"), 1).alias("filled_pct"))


def zero_and_short(events: DataFrame, docs: DataFrame) -> DataFrame:
    """Events whose longest document is missing or short, of each authority: an aggregate of an aggregate."""
    longest = with_documents(events, docs).groupBy("authority", "event_id").agg(F.coalesce(F.max("d_len"), F.lit(0)).alias("longest"))
    return longest.groupBy("authority").agg(F.count_if(F.col("longest") == 0).alias("zero"), F.count_if((F.col("longest") > 0) & (F.col("longest") < USABLE)).alias("short"), F.count(F.lit(1)).alias("events"))


def laggards(done: DataFrame, least: float) -> DataFrame:
    """Authorities whose document or summary share is under ``least`` percent, the largest first."""
    return done.where((F.col("docs_ok_pct") < least) | (F.col("summaries_pct") < least)).orderBy(F.desc("n_rows"), F.asc_nulls_first("authority"))


def delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Change of completeness between two snapshots; an authority that one of them lacks counts 0 there."""
    cols = ["n_rows", "docs_ok", "summaries"]
    b = before.select("authority", *(F.col(c).alias(f"b_{c}") for c in cols))
    a = after.select(F.col("authority").alias("a_authority"), *(F.col(c).alias(f"a_{c}") for c in cols))
    both = b.join(a, b["authority"].eqNullSafe(a["a_authority"]), "full")
    return both.select(F.coalesce("authority", "a_authority").alias("authority"), *(F.coalesce(f"a_{c}", F.lit(0)).alias(f"{c}_after") for c in cols), *((F.coalesce(f"a_{c}", F.lit(0)) - F.coalesce(f"b_{c}", F.lit(0))).alias(f"{c}_delta") for c in cols))


def activity_by_day(events: DataFrame, stamp: str) -> DataFrame:
    """Tumbling daily counts."""
    return events.where(F.col(stamp).isNotNull()).groupBy(F.date_format(stamp, "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def embedded_documents(events: DataFrame, docs: DataFrame) -> DataFrame:
    """Documents of events, those of embedded events and of events with a model, by authority and in all (GLOBAL).

    Documents meet an event's deliveries, so they are counted once each.
    """
    rows = docs.select("event_id", "doc_id").join(events.select("event_id", "authority", "embedding_model", F.col("embedding").isNotNull().alias("embedded")), "event_id")
    once = rows.groupBy("authority", "doc_id", "embedding_model").agg(F.max("embedded").alias("embedded"))
    counts = [F.count_distinct("doc_id").alias("docs"), F.count_distinct(F.when(F.col("embedded"), F.col("doc_id"))).alias("embedded"), F.count_distinct(F.when(F.col("embedding_model").isNotNull(), F.col("doc_id"))).alias("with_model"), F.count_distinct("embedding_model").alias("models")]
    sets = once.rollup("authority").agg(F.grouping("authority").alias("g"), *counts)
    return sets.select(F.when(F.col("g") == 1, "GLOBAL").otherwise(F.col("authority")).alias("authority"), "docs", "embedded", "with_model", "models", pct(F.col("embedded"), F.col("docs"), 1).alias("embedded_pct"))


def global_counts(events: DataFrame, docs: DataFrame) -> DataFrame:
    """(metric, value): events, summaries, embeddings, models, documents, joined documents and events without any."""
    own = events.agg(F.count(F.lit(1)).alias("events"), *(F.count(c).alias(f"with_{c}") for c in ("summary_en", "summary_model", "embedding", "embedding_model")))
    total = docs.agg(F.count(F.lit(1)).alias("documents"))
    joined = docs.select("event_id").join(events.select("event_id", F.col("embedding").isNotNull().alias("v"), F.col("embedding_model").isNotNull().alias("m")), "event_id").agg(F.count_if("v").alias("joined_embedded"), F.count_if("m").alias("joined_with_model"))
    without = events.join(docs.select("event_id"), "event_id", "left_anti").agg(F.count(F.lit(1)).alias("events_without_docs"))
    parts = [one.unpivot([], one.columns, "metric", "value") for one in (own, total, joined, without)]
    return reduce(DataFrame.unionByName, parts)


def enrichment_since(events: DataFrame, since: str, payload: str, model: str, name: str) -> DataFrame:
    """Events since a day, those with ``payload``, and those whose ``model`` is ``name``, by authority, with shares."""
    rows = events.where(F.col("access_ts") >= F.lit(since).cast("timestamp")).groupBy("authority").agg(F.count(F.lit(1)).alias("n"), F.count(payload).alias("filled"), F.count_if(F.col(model) == name).alias("with_new"), F.count_distinct(model).alias("models"))
    return rows.select("*", pct(F.col("filled"), F.col("n"), 1).alias("filled_pct"), pct(F.col("with_new"), F.col("n"), 1).alias("new_pct"))


def sliding_counts(rows: DataFrame, stamp: str, days: int = 7) -> DataFrame:
    """(authority, last_day, n): rows of the ``days`` days that end with each day, for every day on which a window holds any.

    Rows are counted by day first, so that only counts are spread over windows.
    """
    daily = rows.where(F.col(stamp).isNotNull()).groupBy("authority", F.to_date(stamp).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    spread = daily.select("authority", "n", F.explode(F.sequence("day", F.date_add("day", days - 1))).alias("last_day"))
    return spread.groupBy("authority", "last_day").agg(F.sum("n").alias("n"))
