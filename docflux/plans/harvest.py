"""The harvest's flow as plans over tables: gate, classify, chunk, price; each step is declarative and lazy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflux.functions import text as T
from docflux.operators import quality, selection


def accepted_pages(docs: DataFrame, **gates: float) -> DataFrame:
    """Fetched pages that no gate drops."""
    reasons = quality.gate_reasons(docs.where(F.col("raw_text").isNotNull()), **gates)
    return docs.join(reasons.where("reasons = ''").select("doc_id"), "doc_id", "left_semi")


def request_lines(events: DataFrame, docs: DataFrame, model: str, size: int = 1200, overlap: int = 200) -> DataFrame:
    """Embedding requests (one JSON line a chunk) of the documents that still need one."""
    need = selection.pending_embeddings(events, docs, model).select("doc_id")
    chunks = docs.join(need, "doc_id", "left_semi").select("doc_id", F.inline(T.char_chunks(F.col("clean_text"), size, overlap)))
    return selection.requests(chunks, "emb", F.col("doc_id").cast("string"), F.col("chunk_index").cast("string"), F.col("chunk"), model)


def request_bill(lines: DataFrame, usd_per_million: float) -> DataFrame:
    """Requests, estimated tokens and cost of request lines."""
    tokens = F.sum(T.token_estimate(F.get_json_object("line", "$.body.input")))
    return lines.agg(F.count(F.lit(1)).alias("requests"), F.coalesce(tokens, F.lit(0)).alias("tokens")).withColumn("usd", F.round(F.col("tokens") / 1e6 * usd_per_million, 6))


def retrieval(hits: DataFrame) -> DataFrame:
    """Retrieved chunks (url, title, position) rolled up by url: snippets, the first title that isn't empty, first position."""
    titled = F.when(F.coalesce(F.col("title"), F.lit("")) != "", F.struct("position", "title"))
    return hits.groupBy("url").agg(F.count(F.lit(1)).alias("snippets"), F.min(titled).getField("title").alias("title"), F.min("position").alias("first_position"))
