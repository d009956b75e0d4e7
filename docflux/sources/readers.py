"""Readers of the harvest's inputs: request and result lines, delimited logs, feeds, sitemaps, rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflux.operators.selection import parse_custom_id

RESULT = "custom_id string, response struct<body: struct<data: array<struct<embedding: array<float>>>, choices: array<struct<message: struct<content: string>>>>>"


def batch_results(spark: SparkSession, path: str) -> DataFrame:
    """(kind, key, part, embedding, content, error) of JSON result lines; a malformed line is a row with ``error``."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    rows = lines.select(F.from_json("value", RESULT, {"mode": "PERMISSIVE"}).alias("r")).select(F.col("r.custom_id").alias("custom_id"), F.col("r.response.body").alias("body"))
    kind, key, part = parse_custom_id(F.col("custom_id"))
    rows = rows.select(kind.alias("kind"), key.alias("key"), part.alias("part"), F.try_element_at("body.data", F.lit(1)).getField("embedding").alias("embedding"), F.try_element_at("body.choices", F.lit(1)).getField("message").getField("content").alias("content"))
    return rows.withColumn("error", F.when(F.col("kind").isNull(), "bad_id").when((F.col("kind") == "emb") & (F.coalesce(F.size("embedding"), F.lit(0)) <= 0), "no_embedding").when((F.col("kind") == "sum") & F.col("content").isNull(), "no_content"))


def delimited(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """A delimited log with a header and a declared schema; malformed fields are NULL."""
    return spark.read.csv(path, schema=schema, header=True, sep=sep, mode="PERMISSIVE", multiLine=True, escape='"')


def sitemap_urls(xml: Column) -> Column:
    """array<struct<url, lastmod>> of a sitemap's entries, with or without a namespace."""
    entries = F.regexp_extract_all(xml, F.lit(r"(?is)<(?:\w+:)?url>(.*?)</(?:\w+:)?url>"), F.lit(1))
    return F.transform(entries, lambda e: F.struct(F.trim(F.regexp_extract(e, r"(?is)<(?:\w+:)?loc>\s*(.*?)\s*</", 1)).alias("url"), F.try_to_timestamp(F.nullif(F.regexp_extract(e, r"(?is)<(?:\w+:)?lastmod>\s*(.*?)\s*</", 1), F.lit(""))).alias("lastmod")))


def feed_links(feed: Column) -> Column:
    """Links of a feed in order: RSS items, else Atom entries, else a JSON list's ``link``."""
    rss = F.regexp_extract_all(feed, F.lit(r"(?is)<item\b.*?<link>\s*(.*?)\s*</link>.*?</item>"), F.lit(1))
    atom = F.regexp_extract_all(feed, F.lit(r"(?is)<entry\b.*?<link\b[^>]*href=[\"']([^\"']+)[\"'].*?</entry>"), F.lit(1))
    json = F.filter(F.transform(F.coalesce(F.from_json(feed, "array<struct<link:string,url:string>>"), F.array().cast("array<struct<link:string,url:string>>")), lambda x: F.coalesce(x["link"], x["url"])), lambda x: x.isNotNull())
    return F.array_distinct(F.when(F.size(rss) > 0, rss).when(F.size(atom) > 0, atom).otherwise(json))


def page_links(html: Column) -> Column:
    """Targets of a page's anchors in order, without fragments and scripts, each once."""
    found = F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*href\s*=\s*[\"']([^\"'>]+)[\"']"), F.lit(1))
    return F.array_distinct(F.filter(F.transform(found, lambda h: F.trim(h)), lambda x: ~x.startswith("#") & ~F.lower(x).startswith("javascript:") & (x != "")))


def robots_allowed(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (domain, path) with ``allowed``: the longest matching prefix of the domain's rules (domain, prefix, allow) decides; no rule allows."""
    u = urls.select(*urls.columns)
    hit = u.join(rules.select(F.col("domain").alias("_domain"), "prefix", "allow"), (F.col("domain") == F.col("_domain")) & F.col("path").startswith(F.col("prefix")))
    best = hit.groupBy("domain", "path").agg(F.max_by("allow", F.struct(F.length("prefix"), F.col("allow"))).alias("allow"))
    return u.join(best, ["domain", "path"], "left").select(*u.columns, F.coalesce("allow", F.lit(True)).alias("allowed"))
