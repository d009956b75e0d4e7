"""Queries of the reference's operators over the given tables, each with SQL that gives the same rows.

``AS_OF`` stands for "now"; timestamps come out as microseconds, so that both engines print them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docflux.functions import text as T
from docflux.operators import coverage as C
from docflux.operators import merge as M
from docflux.operators import quality as Q
from docflux.operators import selection as S
from docflux.operators import telemetry as L
from docflux.queries.registry import registry
from docflux.session import broadcast_if_small

AS_OF = "2025-10-01 00:00:00"
MODEL, SUMMARY_MODEL = "embed-small-a", "sum-mini"
query, QUERIES, SQL = registry()

# The alert rules, classifier rules and prices that the queries below use.
ALERT_RULES = [("payments", ["HFSB", "OPKN", "NDIC", "OCPF"], ["payment", "pembayaran", "paiement"]), ("data", ["PDOB", "BPDW", "CEDN"], ["data", "données"]), ("nothing", ["TPRA"], ["zzzz-not-there"])]
AREAS = [("payments", ["payment", "pembayaran", "paiement", "thanh toán"]), ("lending", ["lending", "credit", "kredit", "crédit"]), ("data_protection", ["data", "données", "dữ liệu"]), ("telecom", ["spectrum", "tower", "spektrum"])]
PRICES = [("embed-small-a", 0.02), ("embed-large-b", 0.13)]

_E = "(select * from policy_events)"
_J = "(select e.*, d.doc_id as d_id, length(d.clean_text) as d_len, d.source_url as d_url from policy_events e left join documents d on e.event_id = d.event_id)"
_ASOF = f"timestamptz '{AS_OF}+00'"


def _pct(a: str, b: str, digits: int = 2) -> str:
    return f"round(case when {b} <> 0 then 100.0::double * {a} / {b} end, {digits})"


def _joined(t: Callable) -> DataFrame:
    return C.with_documents(t("policy_events"), t("documents"))


# ------------------------------------------------------------------ coverage
_ROWWISE = f"count(*) n_rows, count(*) filter (d_len >= 400) docs_ok, count(summary_en) summaries, count(embedding) embeddings, {_pct('count(*) filter (d_len >= 400)', 'count(*)')} docs_ok_pct, {_pct('count(summary_en)', 'count(*)')} summaries_pct, {_pct('count(embedding)', 'count(*)')} embeddings_pct"


@query(f"select authority, {_ROWWISE} from {_J} group by authority")
def coverage_rowwise(t, _):
    return C.completeness(_joined(t))


@query(f"select case when grouping(authority) = 1 then 'GLOBAL' else authority end authority, {_ROWWISE} from {_J} group by rollup(authority)")
def coverage_rowwise_rollup(t, _):
    return C.completeness(_joined(t), total=True)


@query(f"select authority, count(*) n_rows, count(distinct event_id) events, count(distinct case when d_len >= 400 then event_id end) events_with_doc, count(distinct case when summary_en is not null then event_id end) events_with_summary, {_pct('count(distinct case when d_len >= 400 then event_id end)', 'count(*)')} doc_pct from {_J} group by authority")
def coverage_distinct(t, _):
    return C.distinct_completeness(_joined(t))


@query(f"select authority, count(distinct event_id) events, count(distinct d_id) docs, epoch_us(max(access_ts)) latest_us, floor((epoch_us({_ASOF}) - epoch_us(max(access_ts))) / 86400000000)::bigint age_days from {_J} group by authority")
def coverage_by_authority(t, _):
    return C.by_authority(t("policy_events"), t("documents"), AS_OF)


@query("select authority, n, last_7d, last_30d, last_90d, " + ", ".join(f"{_pct(f'last_{d}d', 'n', 1)} pct_{d}d" for d in (7, 30, 90)) + " from (select authority, count(*) n, " + ", ".join(f"count(*) filter (access_ts >= {_ASOF} - interval {d} day) last_{d}d" for d in (7, 30, 90)) + " from policy_events group by authority)")
def freshness_counts(t, _):
    return C.freshness(t("policy_events"), AS_OF)


@query(f"select w.days, count(*) n_rows, count(*) filter (d_len >= 400) docs_ok, count(summary_en) summaries from {_J} j join (values (7), (30), (90)) w(days) on j.access_ts >= {_ASOF} - to_days(w.days) group by w.days")
def freshness_completeness(t, _):
    return C.windowed_completeness(_joined(t), AS_OF)


def _enrichment_sql(c: str, m: str) -> str:
    return f"select case when grouping(authority) = 1 then 'GLOBAL' else authority end authority, count(*) n, count({c}) filled, count({m}) with_model, count(distinct {m}) models, {_pct(f'count({c})', 'count(*)', 1)} filled_pct from policy_events group by rollup(authority)"


@query(_enrichment_sql("summary_en", "summary_model"))
def summary_coverage(t, _):
    return C.enrichment(t("policy_events"), "summary_en", "summary_model")


_DOCS_OF = "documents d join policy_events e on e.event_id = d.event_id"


@query(f"select case when grouping(authority) = 1 then 'GLOBAL' else authority end authority, count(distinct doc_id) docs, count(distinct case when embedding is not null then doc_id end) embedded, count(distinct case when embedding_model is not null then doc_id end) with_model, count(distinct embedding_model) models, {_pct('count(distinct case when embedding is not null then doc_id end)', 'count(distinct doc_id)', 1)} embedded_pct from {_DOCS_OF} group by rollup(authority)")
def embedding_coverage(t, _):
    return C.embedded_documents(t("policy_events"), t("documents"))


@query("select count(*) n, count(distinct event_id) events, count(distinct authority) authorities, epoch_us(min(access_ts)) first_us, epoch_us(max(access_ts)) last_us from policy_events")
def overall_stats(t, _):
    return t("policy_events").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("events"), F.count_distinct("authority").alias("authorities"), F.unix_micros(F.min("access_ts")).alias("first_us"), F.unix_micros(F.max("access_ts")).alias("last_us"))


@query("select strftime(access_ts at time zone 'UTC', '%Y-%m-%d') as day, count(*) n from policy_events where access_ts is not null group by 1")
def activity_by_day(t, _):
    return C.activity_by_day(t("policy_events"), "access_ts")


@query(f"select authority, count(*) filter (summary_en is not null) summaries, count(*) filter (summary_en is not null and summary_model is not null) with_model, {_pct('count(*) filter (summary_en is not null and summary_model is not null)', 'count(*) filter (summary_en is not null)', 1)} model_pct, coalesce(100.0 * count(*) filter (summary_en is not null and summary_model is not null) >= 90 * count(*) filter (summary_en is not null), false) ok from policy_events group by authority")
def model_backfill_check(t, _):
    has = F.col("summary_en").isNotNull()
    rows = t("policy_events").groupBy("authority").agg(F.count_if(has).alias("summaries"), F.count_if(has & F.col("summary_model").isNotNull()).alias("with_model"))
    return rows.select("*", C.pct(F.col("with_model"), F.col("summaries"), 1).alias("model_pct"), (100 * F.col("with_model") >= 90 * F.col("summaries")).alias("ok"))


@query("select e.authority, count(*) events, count(*) filter (d.event_id is null) without_doc, count(*) filter (e.has_summary) with_summary from (select authority, event_id, bool_or(summary_en is not null) has_summary from policy_events group by 1, 2) e left join (select distinct event_id from documents) d on e.event_id = d.event_id group by e.authority")
def authority_scorecard(t, _):
    e = t("policy_events").groupBy("authority", "event_id").agg(F.max(F.col("summary_en").isNotNull()).alias("has_summary"))
    d = t("documents").where("event_id is not null").select("event_id").distinct().withColumn("hit", F.lit(True))
    return e.join(d, "event_id", "left").groupBy("authority").agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("hit").isNull()).alias("without_doc"), F.count_if("has_summary").alias("with_summary"))


@query("select authority, count(*) filter (longest = 0) zero, count(*) filter (longest > 0 and longest < 400) short, count(*) events from (select authority, event_id, coalesce(max(d_len), 0) longest from " + _J + " group by 1, 2) group by authority")
def zero_short_docs(t, _):
    return C.zero_and_short(t("policy_events"), t("documents"))


@query(f"select * from (select authority, {_ROWWISE} from {_J} group by authority) where docs_ok_pct < 60 or summaries_pct < 60")
def lagging_having(t, _):
    return C.laggards(C.completeness(_joined(t)), 60)


_SNAP = "(select authority, count(*) n_rows, count(*) filter (d_len >= 400) docs_ok, count(summary_en) summaries from {j} where access_ts < {at} group by authority)"


@query(f"select coalesce(b.authority, a.authority) authority, coalesce(a.n_rows, 0) n_rows_after, coalesce(a.docs_ok, 0) docs_ok_after, coalesce(a.summaries, 0) summaries_after, coalesce(a.n_rows, 0) - coalesce(b.n_rows, 0) n_rows_delta, coalesce(a.docs_ok, 0) - coalesce(b.docs_ok, 0) docs_ok_delta, coalesce(a.summaries, 0) - coalesce(b.summaries, 0) summaries_delta from {_SNAP.format(j=_J, at='timestamptz ' + repr('2024-01-01 00:00:00+00'))} b full join {_SNAP.format(j=_J, at=_ASOF)} a on a.authority is not distinct from b.authority")
def coverage_delta(t, _):
    j = _joined(t)
    return C.delta(C.completeness(j.where("access_ts < timestamp '2024-01-01'")), C.completeness(j.where(F.col("access_ts") < F.lit(AS_OF).cast("timestamp"))))


# ------------------------------------------------------------------ joins that look for what is missing
@query("select distinct e.event_id from policy_events e where not exists (select 1 from documents d where d.event_id = e.event_id)")
def events_without_docs(t, _):
    return t("policy_events").join(t("documents"), "event_id", "left_anti").select("event_id").distinct()


@query("select e.authority, count(distinct e.event_id) events from policy_events e where not exists (select 1 from documents d where d.event_id = e.event_id) group by 1")
def events_without_docs_by_authority(t, _):
    return t("policy_events").join(t("documents"), "event_id", "left_anti").groupBy("authority").agg(F.count_distinct("event_id").alias("events"))


@query("select distinct e.event_id from policy_events e where not exists (select 1 from documents d where d.event_id = e.event_id and length(d.clean_text) >= 400)")
def events_without_qualifying_doc(t, _):
    return t("policy_events").join(t("documents").where(F.length("clean_text") >= 400), "event_id", "left_anti").select("event_id").distinct()


@query("select doc_id, event_id from documents d where not exists (select 1 from policy_events e where e.event_id = d.event_id)")
def orphan_docs(t, _):
    return t("documents").join(t("policy_events"), "event_id", "left_anti").select("doc_id", "event_id")


@query("select source_url, count(*) n from documents group by 1 having count(*) > 1")
def duplicate_source_urls(t, _):
    return Q.duplicate_groups(t("documents"), "source_url")


@query("select authority, event_hash, count(*) n from policy_events group by 1, 2 having count(*) > 1")
def dup_hash_groups(t, _):
    return Q.duplicate_groups(t("policy_events"), "authority", "event_hash")


@query("select count(*) - count(distinct source_url) surplus from documents")
def source_url_surplus(t, _):
    return Q.surplus(t("documents"), "source_url")


# ------------------------------------------------------------------ profiles and checks
@query(f"select count(*) n, round(avg(length(clean_text)), 4) mean_len, quantile_cont(length(clean_text), 0.5)::double median_len, count(*) filter (length(clean_text) >= 1000) long_docs, {_pct('count(*) filter (length(clean_text) >= 1000)', 'count(*)')} long_pct from documents where clean_text is not null")
def doc_length_profile(t, _):
    return Q.length_profile(t("documents"), "clean_text")


@query("select source, list_sort(list(length(clean_text)))[count(*) // 2 + 1] upper_median, count(*) n from documents where clean_text is not null group by source")
def upper_median_len(t, _):
    return Q.upper_median(t("documents"), "source", F.length("clean_text"))


_COLS = ["pub_date", "access_ts", "policy_area", "action_type", "title", "url", "lang", "summary_en", "summary_model", "embedding", "embedding_model"]


@query(" union all ".join(f"select '{c}' column_name, count(*) filter ({c} is null) nulls, {_pct(f'count(*) filter ({c} is null)', 'count(*)')} null_pct from policy_events" for c in _COLS))
def null_profile(t, _):
    return Q.null_profile(t("policy_events"), _COLS)


_BAD = "coalesce(not regexp_matches({c}, '^https?://'), true)"


@query(
    f'select \'required_nulls\' "check", count(*) filter (authority is null or title is null or url is null or access_ts is null) "value", count(*) filter (authority is null or title is null or url is null or access_ts is null) = 0 ok from policy_events union all '
    f"select 'bad_event_urls', count(*) filter ({_BAD.format(c='url')}), count(*) filter ({_BAD.format(c='url')}) = 0 from policy_events union all "
    "select 'empty_urls', count(*) filter (coalesce(url, '') = ''), count(*) filter (coalesce(url, '') = '') = 0 from policy_events union all "
    f"select 'recent_events', count(*) filter (access_ts >= {_ASOF} - interval 90 day), count(*) filter (access_ts >= {_ASOF} - interval 90 day) >= 10 from policy_events union all "
    "select 'dup_event_hash', count(event_hash) - count(distinct event_hash), count(event_hash) = count(distinct event_hash) from policy_events union all "
    f"select 'bad_document_urls', count(*) filter ({_BAD.format(c='source_url')}), count(*) filter ({_BAD.format(c='source_url')}) = 0 from documents union all "
    "select 'dup_source_urls', count(source_url) - count(distinct source_url), count(source_url) = count(distinct source_url) from documents"
)
def dq_report(t, _):
    return Q.dq_report(t("policy_events"), t("documents"), AS_OF)


_NF = " or ".join(f"contains(lower(concat_ws(' ', title, raw_text)), '{p}')" for p in T.NOT_FOUND)


@query(f"select doc_id, length(regexp_replace(raw_text, '\\s', '', 'g')) solid, round(case when length(regexp_replace(raw_text, '\\s', '', 'g')) > 0 then length(regexp_replace(regexp_replace(raw_text, '\\s', '', 'g'), '[^\\x00-\\x7F]', '', 'g'))::double / length(regexp_replace(raw_text, '\\s', '', 'g')) else 0 end, 6) ascii_share, {_NF} not_found from documents where raw_text is not null")
def page_measures(t, _):
    x = F.col("raw_text")
    return t("documents").where(x.isNotNull()).select("doc_id", F.length(F.regexp_replace(x, r"\s", "")).alias("solid"), F.round(T.ascii_ratio(x), 6).alias("ascii_share"), T.not_found(F.col("title"), x).alias("not_found"))


@query("select reason, count(*) n from (select unnest(string_split(reason, ';')) reason from quality_drops where reason is not null) where reason <> '' group by 1")
def drop_breakdown(t, _):
    return Q.reason_breakdown(t("quality_drops"))


# ------------------------------------------------------------------ enrichment (PF4, PF5, PF14, J2, J3, A29-A32, W7, F14-F17)
@query(f"select distinct d.event_id, d.doc_id from documents d join policy_events e on e.event_id = d.event_id where length(d.clean_text) > 100 and (e.embedding is null or e.embedding_model is null or e.embedding_model <> '{MODEL}')")
def pending_embeddings(t, _):
    return S.pending_embeddings(t("policy_events"), t("documents"), MODEL)


@query(f"select distinct event_id from policy_events where summary_en is null or summary_model is null or summary_model <> '{SUMMARY_MODEL}'")
def pending_summaries(t, _):
    return S.pending_summaries(t("policy_events"), SUMMARY_MODEL)


@query("select doc_id from (select doc_id, count(*) over w - 1 n, coalesce(sum(strlen(clean_text)) over (order by doc_id rows between unbounded preceding and 1 preceding), 0) b from documents where clean_text is not null window w as (order by doc_id rows between unbounded preceding and current row)) where n < 100000 and b < 1500000")
def requests_capped(t, _):
    docs = t("documents").where("clean_text is not null").select("doc_id", F.octet_length("clean_text").cast("bigint").alias("size"))
    return S.capped_prefix(docs, "doc_id", F.col("size"), 100_000, 1_500_000).select("doc_id")


_STARTS = "unnest(range(0, greatest(length(clean_text), 1), 1000))"


@query(f"select doc_id, (start // 1000)::int chunk_index, length(substr(clean_text, start + 1, 1200))::int text_len, md5(substr(clean_text, start + 1, 1200)) chunk_md5 from (select doc_id, clean_text, {_STARTS} as start from documents where clean_text is not null)")
def chunk_rows(t, _):
    rows = t("documents").where("clean_text is not null").select("doc_id", F.inline(T.char_chunks(F.col("clean_text"))))
    return rows.select("doc_id", "chunk_index", F.length("chunk").alias("text_len"), F.md5("chunk").alias("chunk_md5"))


@query(f"select doc_id, count(*) chunks, sum(length(substr(clean_text, start + 1, 1200)) // 4)::bigint tokens from (select doc_id, clean_text, {_STARTS} as start from documents where clean_text is not null) group by doc_id")
def chunk_tokens(t, _):
    rows = t("documents").where("clean_text is not null").select("doc_id", F.inline(T.char_chunks(F.col("clean_text"))))
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunks"), F.sum(T.token_estimate(F.col("chunk"))).alias("tokens"))


_STAGE = "case when chunk_index = 0 then 'lead' else 'rest' end"


@query(f"select model, stage, sum(token_estimate)::bigint tokens from (select coalesce(embedding_model, '(none)') model, {_STAGE} stage, token_estimate from chunks) group by grouping sets ((model), (stage), ()) union all select model, stage, sum(token_estimate)::bigint from (select coalesce(embedding_model, '(none)') model, {_STAGE} stage, token_estimate from chunks) where false group by 1, 2")
def token_totals(t, _):
    return L.token_totals(t("chunks"), F.when(F.col("chunk_index") == 0, "lead").otherwise("rest"))


@query("select u.model, tokens::bigint tokens, round(coalesce(tokens / 1e6 * p.usd, 0), 6) cost, p.usd is null unpriced from (select coalesce(embedding_model, '(none)') model, sum(token_estimate) tokens from chunks group by 1) u left join (values " + ", ".join(f"('{m}', {p}::double)" for m, p in PRICES) + ") p(model, usd) on p.model = u.model")
def usage_costs(t, spark):
    return L.costs(t("chunks"), spark.createDataFrame(PRICES, "model string, usd_per_million double"))


@query("select embedding_model, count(*) n, sum(text_len)::bigint text_len, count(distinct page_id) pages from chunks group by 1")
def chunks_by_model(t, _):
    return t("chunks").groupBy("embedding_model").agg(F.count(F.lit(1)).alias("n"), F.sum("text_len").alias("text_len"), F.count_distinct("page_id").alias("pages"))


# ------------------------------------------------------------------ samplers, top-k, rules
def _sampler_sql(days: int, limit: int) -> str:
    return f"select s.event_id, s.authority, epoch_us(s.access_ts) ts_us, coalesce(b.doc_url, s.url) url, left(coalesce(b.body, s.summary_en, s.title, ''), 200) preview from (select * from policy_events where access_ts >= {_ASOF} - interval {days} day and access_ts <= {_ASOF} order by access_ts desc, event_id desc, pub_date nulls first limit {limit}) s left join (select event_id, min_by(clean_text, doc_id) filter (clean_text is not null) body, min_by(source_url, doc_id) filter (source_url is not null) doc_url from documents group by 1) b on b.event_id = s.event_id"


@query(_sampler_sql(7, 200))
def sampler_7d(t, _):
    return S.sampler(t("policy_events"), t("documents"), AS_OF, S.lookback(days=7), 200)


@query(_sampler_sql(1, 50))
def sampler_24h(t, _):
    return S.sampler(t("policy_events"), t("documents"), AS_OF, S.lookback(hours=24), 50)


@query(_sampler_sql(90, 12))
def sampler_executive(t, _):
    return S.sampler(t("policy_events"), t("documents"), AS_OF, S.lookback(days=90), 12)


@query(
    f"with k as (select event_id, epoch_us({_ASOF}) - epoch_us(access_ts) age from policy_events where access_ts is not null), w as (select case when count(*) filter (age between 0 and 14 * 86400000000) > 0 then 14 "
    "when count(*) filter (age between 0 and 30 * 86400000000) > 0 then 30 when count(*) filter (age between 0 and 90 * 86400000000) > 0 then 90 end d from k) select event_id, d window_days from k, w where age between 0 and d * 86400000000"
)
def sampler_adaptive(t, _):
    return L.adaptive_window(t("policy_events"), "access_ts", AS_OF, (14, 30, 90)).select("event_id", "window_days")


@query("select doc_id, length(clean_text) as len from documents order by len desc nulls last, doc_id limit 10")
def longest_docs(t, _):
    return t("documents").select("doc_id", F.length("clean_text").alias("len")).orderBy(F.desc_nulls_last("len"), "doc_id").limit(10)


@query("select authority, event_id, epoch_us(access_ts) ts_us from (select *, row_number() over (partition by authority order by access_ts desc nulls last, event_id, pub_date nulls first, url nulls first) r from policy_events) where r <= 3")
def candidate_cap_per_authority(t, _):
    order = [F.desc_nulls_last("access_ts"), F.asc("event_id"), F.asc_nulls_first("pub_date"), F.asc_nulls_first("url")]
    return L.per_group_cap(t("policy_events").select("authority", "event_id", "access_ts", "pub_date", "url"), "authority", order, 3).select("authority", "event_id", F.unix_micros("access_ts").alias("ts_us"))


_ALERTS = " union ".join(f"select '{n}' as rule, event_id from policy_events where upper(authority) in ({', '.join(repr(a) for a in au)}) and ({' or '.join(f'contains(lower(concat_ws(chr(32), title, summary_en)), {k!r})' for k in kw)})" for n, au, kw in ALERT_RULES)


@query(_ALERTS)
def alerts(t, spark):
    return S.match_alerts(t("policy_events"), spark.createDataFrame(ALERT_RULES, "name string, authorities array<string>, keywords array<string>"))


@query(f"select r.rule, count(a.event_id) n from (values {', '.join(f'({n!r})' for n, *_ in ALERT_RULES)}) r(rule) left join ({_ALERTS}) a on a.rule = r.rule group by 1")
def alerts_by_rule(t, spark):
    rules = spark.createDataFrame(ALERT_RULES, "name string, authorities array<string>, keywords array<string>")
    found = S.match_alerts(t("policy_events"), rules)
    return rules.select(F.col("name").alias("rule")).join(found, "rule", "left").groupBy("rule").agg(F.count("event_id").alias("n"))


_AREA = "case " + " ".join("when " + " or ".join(f"contains(lower(title), '{w}')" for w in ws) + f" then '{n}'" for n, ws in AREAS) + " else 'other' end"


@query(f"select event_id, pub_date, {_AREA} area from policy_events")
def classify_first_match(t, _):
    return t("policy_events").select("event_id", "pub_date", S.classify_first(t("policy_events"), F.coalesce("title", F.lit("")), AREAS, "other").alias("area"))


@query("select d.doc_id, a.authority, coalesce(a.country, 'SG') country from documents d left join authorities a on a.domain = d.source")
def authority_from_domain(t, _):
    return t("documents").join(broadcast_if_small(t("authorities").select("domain", "authority", "country")), F.col("source") == F.col("domain"), "left").select("doc_id", "authority", F.coalesce("country", F.lit("SG")).alias("country"))


@query("select vec_id query, n neighbour, r \"rank\", score from (select a.vec_id, b.vec_id n, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 6) score, row_number() over (partition by a.vec_id order by list_cosine_similarity(a.embedding::double[], b.embedding::double[]) desc, b.vec_id) r from embeddings a, embeddings b where a.vec_id % 100 = 0 and a.vec_id <> b.vec_id) where r <= 8")
def knn_topk(t, _):
    v = t("embeddings")
    return S.knn(v, v.where("vec_id % 100 = 0"), "vec_id", "embedding", 8)


# ------------------------------------------------------------------ telemetry
_HOST = "nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]+)', 1)), '')"
_FINE = "('ok', '200', 'fallback')"
_FAIL = f"(select {_HOST} as domain, url, coalesce(notes, status_code_or_error) error, 1 log, n from (select *, row_number() over () n from provider_events) where status_code_or_error is not null and status_code_or_error <> '' and status_code_or_error not in {_FINE} union all select domain, url, error, 0 log, n from (select *, row_number() over () n from fc_errors) where status is not null and status not in {_FINE})"


@query(f"select domain, failures, first.error error, first.url error_url from (select domain, count(*) failures, min({{'log': log, 'n': n}}) seen, min(case when coalesce(left(error, 100), '') <> '' then {{'log': log, 'n': n, 'error': left(error, 100), 'url': url}} end) first from {_FAIL} where domain is not null group by 1) order by failures desc, seen limit 20")
def failures_top_domains(t, _):
    return L.top_failing_domains(L.failures(t.arrival("provider_events"), t.arrival("fc_errors")), 20)


_STREAK = "(select authority, ts, url, case when status_code_or_error = '429' then 1 else 0 end hit from provider_events where ts is not null and status_code_or_error is not null)"


@query(f"select authority, coalesce(max(run), 0)::bigint longest_run, coalesce(max(run), 0) >= 3 pauses, coalesce(max(run), 0) >= 6 trips from (select authority, misses, sum(hit) run from (select *, sum(1 - hit) over (partition by authority order by ts, coalesce(url, ''), hit rows between unbounded preceding and current row) misses from {_STREAK}) group by 1, 2) group by 1")
def streak_429(t, _):
    return L.longest_streaks(t("provider_events"), "429")


@query("select authority, count(*) filter (provider = 'crawler') crawler, count(*) filter (provider = 'http') http, count(*) filter (provider = 'crawler_v1') crawler_v1, count(*) filter (provider is null or provider not in ('crawler', 'http', 'crawler_v1')) other, sum(wait_ms)::bigint wait_ms from provider_events group by 1")
def provider_usage(t, _):
    return L.usage(t("provider_events"), ["crawler", "http", "crawler_v1"])


@query("select case when contains(x, 'captcha') then 'captcha' when regexp_matches(x, 'rate|429') then 'rate' when regexp_matches(x, 'timeout|timed out') then 'timeout' when contains(x, 'proxy') then 'proxy' else 'other' end as class, count(*) n from (select lower(coalesce(error, '')) x from fc_errors) group by 1")
def error_classes(t, _):
    return L.error_classes(t("fc_errors"))


@query(f"select provider, proxy_mode, count(*) calls, count(*) filter (coalesce(status_code_or_error, 'ok') not in {_FINE}) failed, {_pct('count(*) filter (coalesce(status_code_or_error, ' + repr('ok') + ') not in ' + _FINE + ')', 'count(*)')} failed_pct from provider_events group by 1, 2")
def failure_rates(t, _):
    return L.failure_rates(t("provider_events"))


@query("select authority, epoch_us(date_trunc('day', ts at time zone 'UTC')::timestamp) day_us, count(*) calls, count(*) filter (status_code_or_error = '429') limited from provider_events where ts is not null group by 1, 2")
def calls_per_day(t, _):
    day = F.window("ts", "1 day").getField("start")
    return t("provider_events").where("ts is not null").groupBy("authority", F.unix_micros(day).alias("day_us")).agg(F.count(F.lit(1)).alias("calls"), F.count_if(F.col("status_code_or_error") == "429").alias("limited"))


# ------------------------------------------------------------------ merges, versions, sets (SK1-SK9, W1, W12, U1-U6)
_LATEST = "(select * exclude (r) from (select *, row_number() over (partition by event_id order by access_ts desc nulls last, pub_date nulls first, url nulls first) r from policy_events where event_id is not null) where r = 1)"


def _latest(t):
    return M.latest(t("policy_events"), "event_id", F.desc_nulls_last("access_ts"), F.asc_nulls_first("pub_date"), F.asc_nulls_first("url"))


@query(f"select event_id, authority, pub_date, epoch_us(access_ts) ts_us from {_LATEST}")
def latest_deliveries(t, _):
    return _latest(t).select("event_id", "authority", "pub_date", F.unix_micros("access_ts").alias("ts_us"))


_CUT = "timestamptz '2024-06-01 00:00:00+00'"


@query(f"select coalesce(t.event_id, s.event_id) event_id, coalesce(s.title, t.title) title, case when s.event_id is not null then s.policy_area else t.policy_area end policy_area, case when s.event_id is not null then s.summary_en else t.summary_en end summary_en, case when t.event_id is null then 'inserted' when s.event_id is not null then 'updated' else 'kept' end outcome from (select * from {_LATEST} where access_ts < {_CUT}) t full join (select event_id, case when contains(title, 'Notice') then null else upper(title) end title, policy_area, null::varchar summary_en from {_LATEST} where access_ts >= {_CUT} - interval 30 day) s on s.event_id = t.event_id")
def merge_events(t, _):
    e = _latest(t).select("event_id", "title", "policy_area", "summary_en", "access_ts")
    target = e.where("access_ts < timestamp '2024-06-01'").drop("access_ts")
    source = e.where("access_ts >= timestamp '2024-06-01' - interval 30 days").select("event_id", F.when(~F.col("title").contains("Notice"), F.upper("title")).alias("title"), "policy_area", F.lit(None).cast("string").alias("summary_en"))
    return M.upsert(target, source, "event_id", overwrite=["policy_area", "summary_en"], fill=["title"])


@query(f"with taken as (select distinct source_url u from documents where created_at < {_CUT} and source_url is not null), src as (select distinct event_id, source_url from documents where created_at >= {_CUT} and source_url is not null and event_id is not null), ranked as (select *, row_number() over (partition by source_url order by event_id) r from src), made as (select event_id, case when r = 1 and source_url not in (select u from taken) then source_url else source_url || '#event=' || event_id end source_url, not (r = 1 and source_url not in (select u from taken)) variant from ranked) select * from made where source_url not in (select u from taken)")
def insert_variant(t, _):
    d = t("documents").select("event_id", "source_url", "created_at")
    return M.insert_variant(d.where("created_at < timestamp '2024-06-01'"), d.where("created_at >= timestamp '2024-06-01'"))


@query(f"select event_id, case when s.k is not null and (embedding_model is null or embedding_model <> '{MODEL}') then '{MODEL}' else embedding_model end embedding_model, case when s.k is not null and (embedding_model is null or embedding_model <> '{MODEL}') then 'upserted' when s.k is not null then 'skipped' else 'kept' end outcome from {_LATEST} e left join (select distinct event_id k from documents where event_id is not null) s on s.k = e.event_id")
def guarded_embed(t, _):
    results = t("documents").where("event_id is not null").select("event_id").distinct().select("event_id", F.array(F.lit(0.0).cast("float")).alias("embedding"), F.lit(MODEL).alias("embedding_model"))
    return M.guarded_update(_latest(t).select("event_id", "embedding", "embedding_model"), results, "event_id", "embedding", "embedding_model").select("event_id", "embedding_model", "outcome")


@query("select event_id, pub_date, case when summary_en is not null and summary_model is null then 'legacy-prebatch' else summary_model end summary_model, case when summary_en is not null and summary_model is null then 'v0' else summary_version end summary_version from policy_events")
def backfill_models(t, _):
    return M.backfill_model(t("policy_events"), "summary_en", "summary_model", "summary_version").select("event_id", "pub_date", "summary_model", "summary_version")


@query("select url, content_hash, epoch_us(first_seen) first_us, epoch_us(last_seen) last_us, fetches, row_number() over (partition by url order by first_seen, content_hash) \"version\" from (select url, content_hash, min(fetched_at) first_seen, max(fetched_at) last_seen, count(*) fetches from pages group by 1, 2)")
def page_versions(t, _):
    return M.page_versions(t("pages")).select("url", "content_hash", F.unix_micros("first_seen").alias("first_us"), F.unix_micros("last_seen").alias("last_us"), "fetches", F.col("version"))


@query(f"select distinct source_url url from documents where source_url is not null and source_url not in (select url from pages where url is not null and fetched_at < {_CUT})")
def new_urls(t, _):
    crawled = t("pages").where("fetched_at < timestamp '2024-06-01'").select("url")
    return t("documents").where("source_url is not null").select(F.col("source_url").alias("url")).distinct().join(crawled, "url", "left_anti")


@query("select distinct url from (select url from pages union all select url from provider_events union all select url from policy_events) where url is not null")
def discovered_urls(t, _):
    return t("pages").select("url").unionByName(t("provider_events").select("url")).unionByName(t("policy_events").select("url")).where("url is not null").distinct()


@query("select s.domain, count(distinct p.id) pages, count(c.id) chunks, coalesce(sum(c.token_estimate), 0)::bigint tokens from sources s left join pages p on p.source_id = s.id left join chunks c on c.page_id = p.id group by 1")
def source_page_chunk(t, _):
    by_page = t("chunks").groupBy(F.col("page_id").alias("id")).agg(F.count(F.lit(1)).alias("chunks"), F.sum("token_estimate").alias("tokens"))
    pages = t("pages").groupBy("id", "source_id").agg(F.count(F.lit(1)).alias("repeats"))  # repeated rows meet each chunk once more
    by_source = pages.join(by_page, "id", "left").groupBy("source_id").agg(F.count(F.lit(1)).alias("pages"), F.sum(F.col("chunks") * F.col("repeats")).alias("chunks"), F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"))
    rows = t("sources").select("domain", F.col("id").alias("source_id")).join(by_source, "source_id", "left")
    return rows.groupBy("domain").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pages", "chunks", "tokens")))


@query("select event_id, sha256(concat_ws('|', url, strftime(access_ts at time zone 'UTC', '%Y-%m-%d'), coalesce(title, ''))) event_key, pub_date from policy_events where url is not null and access_ts is not null")
def event_hashes(t, _):
    return t("policy_events").where("url is not null and access_ts is not null").select("event_id", T.event_hash(F.col("url"), F.date_format("access_ts", "yyyy-MM-dd"), F.col("title")).alias("event_key"), "pub_date")
