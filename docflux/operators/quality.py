"""Data-quality checks, profiles, and the gates of fetched pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflux.functions import text as T
from docflux.operators.coverage import pct


def duplicate_groups(rows: DataFrame, *keys: str) -> DataFrame:
    """Groups of more than one row."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def surplus(rows: DataFrame, key: str) -> DataFrame:
    """How many rows there are beyond one a distinct value of ``key``."""
    return rows.agg((F.count(F.lit(1)) - F.count_distinct(key)).alias("surplus"))


def null_profile(rows: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs of each column, in one pass, one row a column."""
    one = rows.agg(F.count(F.lit(1)).alias("_n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return one.unpivot(["_n"], columns, "column_name", "nulls").select("column_name", "nulls", pct(F.col("nulls"), F.col("_n")).alias("null_pct"))


def length_profile(docs: DataFrame, column: str) -> DataFrame:
    """Count, mean, median, and share of texts of 1000 characters or more."""
    n = F.length(column)
    return docs.where(F.col(column).isNotNull()).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(n), 4).alias("mean_len"), F.expr(f"percentile_cont(0.5) within group (order by length({column}))").alias("median_len"), F.count_if(n >= 1000).alias("long_docs")).withColumn("long_pct", pct(F.col("long_docs"), F.col("n")))


def upper_median(rows: DataFrame, group: str, value: Column) -> DataFrame:
    """The element at n div 2 (from 0) of each group's sorted values, by exact counts of the distinct values.

    Values are counted first, so that a hot group costs one row a distinct value, not a row an element.
    """
    counts = rows.where(value.isNotNull()).groupBy(group, value.alias("v")).agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy(group).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = counts.withColumn("upto", F.sum("c").over(upto)).withColumn("n", F.sum("c").over(Window.partitionBy(group)))
    return run.where(F.col("upto") > F.floor(F.col("n") / 2)).groupBy(group).agg(F.min("v").alias("upper_median"), F.first("n").alias("n"))


def bad_scheme(url: Column) -> Column:
    """Whether a url is neither http nor https (NULL counts as bad)."""
    return F.coalesce(~url.rlike("^https?://"), F.lit(True))


def dq_report(events: DataFrame, docs: DataFrame, as_of: str) -> DataFrame:
    """(check, value, ok): the named checks over both tables, each its own aggregate, then one union."""
    e = events.agg(
        F.count_if(F.col("authority").isNull() | F.col("title").isNull() | F.col("url").isNull() | F.col("access_ts").isNull()).alias("required_nulls"),
        F.count_if(bad_scheme(F.col("url"))).alias("bad_event_urls"),
        F.count_if(F.coalesce(F.col("url"), F.lit("")) == "").alias("empty_urls"),
        F.count_if(F.col("access_ts") >= F.lit(as_of).cast("timestamp") - F.make_interval(days=F.lit(90))).alias("recent_events"),
        (F.count("event_hash") - F.count_distinct("event_hash")).alias("dup_event_hash"),
    )
    d = docs.agg(F.count_if(bad_scheme(F.col("source_url"))).alias("bad_document_urls"), (F.count("source_url") - F.count_distinct("source_url")).alias("dup_source_urls"))
    rows = e.unpivot([], e.columns, "check", "value").unionByName(d.unpivot([], d.columns, "check", "value"))
    return rows.withColumn("ok", F.when(F.col("check") == "recent_events", F.col("value") >= 10).otherwise(F.col("value") == 0))


def gate_reasons(pages: DataFrame, text: str = "raw_text", least: int = 700, most_links: float = 0.65, least_ascii: float = 0.60, english: Column | None = None) -> DataFrame:
    """(doc_id, reasons): why a fetched page is dropped, joined by ';' (empty: it is kept).

    dup_hash marks later pages (by doc_id) of one title, url and first 400 characters of text: the reference's formula, so
    versions of a page that differ only later count as repeated. No text is shuffled: equal rows are counted map-side,
    and the first of each key is an aggregate that is joined back.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    key = F.sha2(F.concat(F.lower(F.trim(F.coalesce("title", F.lit("")))), F.lit("|"), F.coalesce("source_url", F.lit("")), F.lit("|"), F.substring(body, 1, 400)), 256)
    english = F.lit(True) if english is None else english
    reasons = F.array_compact(
        F.array(
            F.when(F.length(body) < least, F.lit("thin")),
            F.when(T.not_found(F.col("title"), body), F.lit("not_found")),
            F.when(T.markdown_link_share(body) > most_links, F.lit("link_farm")),
            F.when(english & (T.ascii_ratio(body) < least_ascii), F.lit("non_english")),
        )
    )
    alike = pages.select(key.alias("key"), F.struct("doc_id", F.array_join(reasons, ";").alias("reasons")).alias("page")).groupBy("key", "page").agg(F.count(F.lit(1)).alias("n"))
    firsts = alike.groupBy("key").agg(F.min("page").alias("first"))  # NULL ids come first
    each = alike.join(firsts, "key").select("page.*", (F.col("page") == F.col("first")).alias("first"), F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("at"))
    repeated = F.when(~(F.col("first") & (F.col("at") == 1)), F.lit("dup_hash"))
    return each.select("doc_id", F.concat_ws(";", F.when(F.col("reasons") != "", F.col("reasons")), repeated).alias("reasons"))


def markdown_gate(pages: DataFrame, text: str = "raw_text", least: int = 700, most_links: float = 0.65, least_ascii: float = 0.60) -> DataFrame:
    """(doc_id, reasons): why the markdown of a page is dropped, joined by ';' (empty: it is kept)."""
    body = F.coalesce(F.col(text), F.lit(""))
    reasons = F.array_compact(
        F.array(
            F.when(body == "", F.lit("no_markdown")),
            F.when(F.length(body) < least, F.lit("too_short")),
            F.when(F.coalesce("source_url", F.lit("")) == "", F.lit("no_url")),
            F.when(T.not_found(F.col("title"), body), F.lit("not_found")),
            F.when(T.markdown_link_share(body) > most_links, F.lit("link_farm")),
            F.when(T.ascii_ratio(body) < least_ascii, F.lit("non_english")),
        )
    )
    return pages.select("doc_id", F.array_join(reasons, ";").alias("reasons"))


def overall(checks: DataFrame) -> DataFrame:
    """(checks, failed, passed): one row on all rows of (check, value, ok)."""
    return checks.agg(F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("ok")).alias("failed"), F.coalesce(F.min("ok"), F.lit(True)).alias("passed"))


def reason_breakdown(drops: DataFrame) -> DataFrame:
    """How often each reason occurs in ';'-joined lists."""
    return drops.where(F.col("reason").isNotNull()).select(F.explode(F.split("reason", ";")).alias("reason")).where("reason <> ''").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
