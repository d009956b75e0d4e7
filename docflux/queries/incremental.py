"""Queries of streaming jobs, request plans and discovery over the given tables."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflux.functions import text as T
from docflux.plans import harvest
from docflux.sources.tables import table
from docflux.streaming import telemetry as S


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """provider_events as a stream of files: the folder's table is one file or a folder of them."""
    batch = table(spark, sf_dir, "provider_events")
    files = [f for f in batch.inputFiles()]
    folder = files[0].rsplit("/", 1)[0]
    stream = spark.readStream.schema(batch.schema).option("pathGlobFilter", "*.parquet")
    if folder.endswith("provider_events.parquet"):
        return stream.parquet(folder)
    return stream.option("pathGlobFilter", "provider_events.parquet").parquet(folder)


def stream_daily_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling daily counts by Structured Streaming, drained once."""
    rows = S.run_once(S.daily_calls(_calls(spark, sf_dir)), "daily-calls", "update")
    last = rows.groupBy("authority", "day").agg(F.max_by(F.struct("calls", "limited"), "batch").alias("last"))  # a window's newest update
    return last.select("authority", F.unix_micros("day").alias("day_us"), "last.calls", "last.limited")


def stream_first_sight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines without their repetitions, by streaming deduplication within the watermark."""
    rows = S.first_sight(_calls(spark, sf_dir), ["authority", "url", "provider", "status_code_or_error", "ts"])
    return S.run_once(rows, "first-sight").select("authority", "url", "provider", "status_code_or_error", F.unix_micros("ts").alias("ts_us"))


def stream_rate_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running streak of 429 answers of each authority, folded batch by batch."""
    return S.run_once(S.rate_guard(_calls(spark, sf_dir)), "rate-guard", "update").select("authority", "run", "longest", "action")


def request_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding requests of the documents that need one, as ids and sizes of their JSON lines."""
    lines = harvest.request_lines(table(spark, sf_dir, "policy_events"), table(spark, sf_dir, "documents"), "embed-small-a")
    return lines.select(F.get_json_object("line", "$.custom_id").alias("custom_id"), F.length(F.get_json_object("line", "$.body.input")).alias("input_len"))


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, slug of the path and absolute neighbour of every event's url."""
    url = F.col("url")
    return table(spark, sf_dir, "policy_events").where("url is not null").select("event_id", "pub_date", T.netloc(url).alias("host"), T.slug(F.regexp_extract(url, r"^[^:]+://[^/]+/([^?#]*)", 1)).alias("slug"), T.absolute(url, F.lit("../feed")).alias("feed"))


def retrieval_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks rolled up by the url of their page, as retrieved snippets are."""
    pages = table(spark, sf_dir, "pages").select(F.col("id").alias("page_id"), "url", "title")
    hits = table(spark, sf_dir, "chunks").join(pages, "page_id").select("url", "title", F.col("id").alias("position"))
    return harvest.retrieval(hits)


QUERIES = {f.__name__: f for f in (stream_daily_calls, stream_first_sight, stream_rate_guard, request_batch, url_parts, retrieval_rollup)}
SQL = {
    "stream_daily_calls": "select authority, epoch_us(date_trunc('day', ts at time zone 'UTC')::timestamp) day_us, count(*) calls, count(*) filter (status_code_or_error = '429') limited from provider_events where ts is not null group by 1, 2",
    "stream_first_sight": "select distinct authority, url, provider, status_code_or_error, epoch_us(ts) ts_us from provider_events where ts is not null",
    "stream_rate_guard": "with w as (select authority, hit, sum(1 - hit) over (partition by authority order by ts, u, hit rows between unbounded preceding and current row) misses from (select authority, ts, coalesce(url, '') u, case when status_code_or_error = '429' then 1 else 0 end hit from provider_events where ts is not null and status_code_or_error is not null)), i as (select authority, misses, sum(hit) run from w group by 1, 2) select authority, max_by(run, misses)::bigint run, max(run)::bigint longest, case when max(run) >= 6 then 'trip' when max(run) >= 3 then 'pause' else 'go' end as action from i group by 1",
    "request_batch": "select 'emb:' || doc_id || ':' || (start // 1000) custom_id, length(substr(clean_text, start + 1, 1200))::int input_len from (select doc_id, clean_text, unnest(range(0, greatest(length(clean_text), 1), 1000)) as start from documents d where length(clean_text) > 100 and exists (select 1 from policy_events e where e.event_id = d.event_id and (e.embedding is null or e.embedding_model is null or e.embedding_model <> 'embed-small-a')))",
    "retrieval_rollup": "select p.url, count(*) snippets, min_by(p.title, c.id) filter (coalesce(p.title, '') <> '') title, min(c.id) first_position from chunks c join pages p on p.id = c.page_id group by 1",
    "url_parts": "select event_id, pub_date, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]+)', 1)), '') host, regexp_replace(regexp_replace(lower(regexp_extract(url, '^[^:]+://[^/]+/([^?#]*)', 1)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') slug, regexp_replace(regexp_replace(url, '[?#].*$', ''), '([^/])/[^/]*$', '\\1/') || '../feed' feed from policy_events where url is not null",
}
