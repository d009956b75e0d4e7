"""Choosing rows: enrichment candidates, request batches under running caps, samplers, rules and alerts."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflux.functions.text import preview
from docflux.session import broadcast_if_small

#: Bytes of query vectors that one block of a search holds.
QUERY_BLOCK = 8 * 1024 * 1024


def pending_embeddings(events: DataFrame, docs: DataFrame, model: str, least: int = 100) -> DataFrame:
    """(event_id, doc_id): documents longer than ``least`` whose event has no embedding, or one of another model."""
    need = F.col("embedding").isNull() | F.col("embedding_model").isNull() | (F.col("embedding_model") != model)
    return events.where(need).select("event_id").distinct().join(docs.where(F.length("clean_text") > least).select("event_id", "doc_id"), "event_id")


def pending_summaries(events: DataFrame, model: str) -> DataFrame:
    """(event_id): events without a summary, or with one of another model."""
    return events.where(F.col("summary_en").isNull() | F.col("summary_model").isNull() | (F.col("summary_model") != model)).select("event_id").distinct()


def capped_prefix(rows: DataFrame, order: str, size: Column, max_rows: int, max_bytes: int) -> DataFrame:
    """The rows in ``order`` (a unique bigint key) up to the one that reaches ``max_rows`` or ``max_bytes``: a request batch.

    Sizes are summed in ranges of 1,024 keys and in ranges of 1,024 such ranges. The running sum over the coarse totals
    (a millionth of the keys) finds the coarse ranges that begin below both caps, the sum inside each of them the fine
    ranges, and only fine ranges that begin below the caps are numbered row by row. No task sorts the whole table.
    """
    sized = rows.withColumn("_size", size).withColumn("_fine", F.floor(F.col(order) / 1024))
    fine = sized.groupBy("_fine").agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_b")).withColumn("_coarse", F.floor(F.col("_fine") / 1024))
    coarse = fine.groupBy("_coarse").agg(F.sum("_n").alias("_n"), F.sum("_b").alias("_b"))
    earlier = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    below = (F.col("_n0") < max_rows) & (F.col("_b0") < max_bytes)
    whole = Window.orderBy("_coarse")
    coarse = coarse.select("_coarse", earlier("_n", whole).alias("_cn"), earlier("_b", whole).alias("_cb")).where((F.col("_cn") < max_rows) & (F.col("_cb") < max_bytes))
    part = Window.partitionBy("_coarse").orderBy("_fine")
    fine = fine.join(coarse, "_coarse").select("_fine", (F.col("_cn") + earlier("_n", part)).alias("_n0"), (F.col("_cb") + earlier("_b", part)).alias("_b0")).where(below)
    inside = Window.partitionBy("_fine").orderBy(order)
    ahead = F.row_number().over(inside) - 1
    kept = sized.join(fine, "_fine").withColumn("_n", F.col("_n0") + ahead).withColumn("_b", F.col("_b0") + earlier("_size", inside))
    return kept.where((F.col("_n") < max_rows) & (F.col("_b") < max_bytes)).drop("_fine", "_size", "_n0", "_b0", "_n", "_b")


def requests(chunks: DataFrame, kind: str, key: Column, part: Column, body: Column, model: str) -> DataFrame:
    """Batch requests as JSON lines: custom_id, method, url and a body of model and input."""
    return chunks.select(F.to_json(F.struct(F.concat_ws(":", F.lit(kind), key, part).alias("custom_id"), F.lit("POST").alias("method"), F.lit("/v1/embeddings").alias("url"), F.struct(F.lit(model).alias("model"), body.alias("input")).alias("body"))).alias("line"))


def summary_requests(rows: DataFrame, key: Column, text: Column, model: str, system: str, answer: int = 180, least: int = 50) -> DataFrame:
    """Summary requests as JSON lines with a list of messages; texts below ``least`` characters get none."""
    messages = F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")), F.struct(F.lit("user").alias("role"), text.alias("content")))
    body = F.struct(F.lit(model).alias("model"), F.lit(0).alias("temperature"), F.lit(answer).alias("max_tokens"), messages.alias("messages"))
    line = F.struct(F.concat(F.lit("sum:"), key).alias("custom_id"), F.lit("POST").alias("method"), F.lit("/v1/chat/completions").alias("url"), body.alias("body"))
    return rows.where(F.length(text) >= least).select(F.to_json(line).alias("line"))


def filter_events(events: DataFrame, authorities: list[str] | None = None, since: str | None = None, until: str | None = None, areas: list[str] | None = None) -> DataFrame:
    """Events that meet every filter that is given; all of them if none is."""
    given = [
        F.col("authority").isin(*authorities) if authorities else None,
        F.col("access_ts") >= F.lit(since).cast("timestamp") if since else None,
        F.col("access_ts") < F.lit(until).cast("timestamp") if until else None,
        F.col("policy_area").isin(*areas) if areas else None,
    ]
    for condition in given:
        events = events if condition is None else events.where(condition)
    return events


def lookback(hours: int | None = None, days: int | None = None) -> int:
    """A window in seconds, given as exactly one of hours and days."""
    if (hours is None) == (days is None):
        raise ValueError("give either hours or days")
    return hours * 3600 if days is None else days * 86400


def classify(rows: DataFrame, authority: str, text: Column, rules: DataFrame, keys: list[str], default: str = "other") -> DataFrame:
    """(keys..., kind, name): for each kind of ``rules`` the first rule of a row's authority one of whose keywords its text mentions, else ``default``.

    ``rules`` (authority, kind, ord, name, keywords) is joined on the authority; keywords are a residual predicate inside the
    JVM. The text itself isn't shuffled: a row's hits are found before they are grouped. ``keys`` must be unique and not NULL.
    """
    by = rules.select(F.upper("authority").alias("_by"), "kind", "ord", "name", "keywords")
    per = by.groupBy("_by", "kind").agg(F.sort_array(F.collect_list(F.struct("ord", "name", "keywords"))).alias("_rules"))  # a configuration's few rules
    kinds = [r["kind"] for r in rules.select("kind").distinct().orderBy("kind").collect()]
    out = rows.select(*keys, F.upper(authority).alias("_by"), F.lower(text).alias("_text"))
    for i, kind in enumerate(kinds):
        side = per.where(F.col("kind") == kind).select("_by", F.col("_rules").alias(f"_{i}"))
        out = out.join(broadcast_if_small(side), "_by", "left")
    hit = lambda c: F.filter(c, lambda r: F.exists(r["keywords"], lambda k: F.col("_text").contains(F.lower(k))))
    named = [F.struct(F.lit(kind).alias("kind"), F.coalesce(F.try_element_at(hit(F.col(f"_{i}")), F.lit(1)).getField("name"), F.lit(default)).alias("name")) for i, kind in enumerate(kinds)]
    return out.select(*keys, F.inline(F.array(*named)))


def parse_custom_id(custom_id: Column) -> tuple[Column, Column, Column]:
    """(kind, key, part) of 'emb:key:part' or 'sum:key'; all NULL if malformed."""
    bits = F.split(custom_id, ":")
    part = F.expr("try_cast(try_element_at(split(custom_id, ':'), 3) as int)")
    good = ((bits[0] == "emb") & (F.size(bits) == 3) & part.isNotNull()) | ((bits[0] == "sum") & (F.size(bits) == 2))
    return F.when(good, bits[0]), F.when(good, bits[1]), F.when(good & (bits[0] == "emb"), part)


def match_alerts(events: DataFrame, rules: DataFrame) -> DataFrame:
    """(rule, event_id): events of a rule's authorities that mention one of its keywords, each pair once.

    Rules are exploded to authorities and joined on equality; keywords are a residual predicate inside the JVM. ``rules``
    (name, authorities, keywords) is a configuration table.
    """
    by = rules.select("name", "keywords", F.explode("authorities").alias("rule_authority"))
    hay = F.lower(F.concat_ws(" ", "title", "summary_en"))
    joined = events.join(broadcast_if_small(by), F.upper("authority") == F.upper("rule_authority"))
    return joined.where(F.exists("keywords", lambda k: hay.contains(F.lower(k)))).select(F.col("name").alias("rule"), "event_id").distinct()


def classify_first(rows: DataFrame, text: Column, rules: list[tuple[str, list[str]]], default: str) -> Column:
    """The first rule in order one of whose keywords occurs in ``text``."""
    out = F.lit(default)
    for name, words in reversed(rules):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.lower(text).contains(w.lower())
        out = F.when(hit, name).otherwise(out)
    return out


def first_bodies(events: DataFrame, docs: DataFrame, size: int = 200) -> DataFrame:
    """(event_id, body, doc_url): the beginning of the first text and the first url among the documents of ``events``, by doc_id.

    Documents are semi-joined to the (few) events and texts cut before anything is grouped, so no whole text is shuffled.
    """
    wanted = events.where("event_id is not null").select("event_id").distinct()
    near = docs.join(broadcast_if_small(wanted), "event_id", "left_semi").select("event_id", "doc_id", F.left("clean_text", F.lit(size)).alias("_text"), "source_url")
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct("doc_id", c))).getField(c)
    return near.groupBy("event_id").agg(first("_text").alias("body"), first("source_url").alias("doc_url"))


def sampler(events: DataFrame, docs: DataFrame, as_of: str, seconds: int, limit: int) -> DataFrame:
    """The latest events of a window with a preview of their text, by time and id: a sampler, so the limit is the feature.

    Events are picked first; only their documents are then read on.
    """
    since = F.lit(as_of).cast("timestamp") - F.make_interval(hours=F.lit(seconds // 3600), secs=F.lit(seconds % 3600))
    recent = events.where((F.col("access_ts") >= since) & (F.col("access_ts") <= F.lit(as_of).cast("timestamp")))
    picked = recent.select("event_id", "authority", "access_ts", "pub_date", "url", "summary_en", "title").orderBy(F.desc("access_ts"), F.desc("event_id"), F.asc_nulls_first("pub_date")).limit(limit)
    rows = picked.join(first_bodies(picked, docs), "event_id", "left")
    return rows.select("event_id", "authority", F.unix_micros("access_ts").alias("ts_us"), F.coalesce("doc_url", "url").alias("url"), preview(F.col("body"), F.col("summary_en"), F.col("title")).alias("preview"))


def knn(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(query, neighbour, rank, score): the k vectors of greatest cosine to each query vector, the query itself left out.

    Queries are a stated set, taken in as many blocks as their size needs (one for a small set); every block meets every
    vector once. A top-k of each query and salt is kept before the final ranking, so no task ranks all rows of a query.
    """
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    held = queries.agg(F.coalesce(F.sum(F.size(vector).cast("bigint") * 4 + 64), F.lit(0))).head()[0]  # measured, not estimated
    blocks = max(1, math.ceil(held / QUERY_BLOCK))
    a = queries.select(F.pmod(F.xxhash64(key), F.lit(blocks)).alias("_block"), F.col(key).alias("query"), F.col(vector).alias("_q"), norm(F.col(vector)).alias("_qn"))
    b = vectors.select(F.col(key).alias("neighbour"), F.col(vector).alias("_v"), norm(F.col(vector)).alias("_vn"), F.pmod(F.xxhash64(key), F.lit(64)).alias("_salt"))
    dot = F.aggregate(F.zip_with("_q", "_v", lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    order = [F.desc("score"), F.asc("neighbour")]
    parts = []
    for i in range(blocks):  # a block's vectors are at most about QUERY_BLOCK bytes, so each is broadcast and no vector is shuffled
        pairs = b.withColumn("_block", F.explode(F.array(F.lit(i).cast("bigint")))).join(F.broadcast(a.where(F.col("_block") == i)), "_block").where(F.col("query") != F.col("neighbour"))
        scored = pairs.select("query", "neighbour", "_salt", (dot / (F.col("_qn") * F.col("_vn"))).alias("score"))
        parts.append(scored.withColumn("r", F.row_number().over(Window.partitionBy("query", "_salt").orderBy(*order))).where(F.col("r") <= k).drop("r", "_salt"))
    best = reduce(DataFrame.unionByName, parts)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k).select("query", "neighbour", "rank", F.round("score", 6).alias("score"))
