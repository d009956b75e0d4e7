"""Further operators of the reference's inventory over the given tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflux.functions import text as T
from docflux.operators import coverage as C
from docflux.operators import discovery as D
from docflux.operators import merge as M
from docflux.operators import quality as Q
from docflux.operators import selection as S
from docflux.operators import telemetry as L
from docflux.queries import reference as R
from docflux.queries.reference import AS_OF, MODEL
from docflux.queries.registry import registry

query, QUERIES, SQL = registry()
_ASOF = R._ASOF
_J = R._J
_pct = R._pct
_RULES = R.ALERT_RULES
_HOST = R._HOST


@query("select event_id, pub_date, url from policy_events where not coalesce(regexp_matches(url, '^https?://'), false)")
def bad_scheme_urls(t, _):
    return t("policy_events").where(Q.bad_scheme(F.col("url"))).select("event_id", "pub_date", "url")


_DAY = "try_strptime(regexp_extract(pub_date, '^(\\d{4}-\\d{2}-\\d{2})', 1), '%Y-%m-%d')::date"


@query(f"select authority, count(*) n, count(access_ts) with_access, {_pct('count(access_ts)', 'count(*)')} pct, coalesce(100 * count(access_ts) >= 80 * count(*), false) ok from policy_events where {_DAY} >= date '{AS_OF[:10]}' - 90 group by 1")
def timeliness(t, _):
    day = F.to_date(F.try_to_timestamp(F.nullif(F.regexp_extract("pub_date", r"^(\d{4}-\d{2}-\d{2})", 1), F.lit("")), F.lit("yyyy-MM-dd")))
    rows = t("policy_events").where(day >= F.date_sub(F.lit(AS_OF[:10]).cast("date"), 90)).groupBy("authority").agg(F.count(F.lit(1)).alias("n"), F.count("access_ts").alias("with_access"))
    return rows.select("*", C.pct(F.col("with_access"), F.col("n")).alias("pct"), (100 * F.col("with_access") >= 80 * F.col("n")).alias("ok"))


@query("select url from policy_events where ends_with(lower(regexp_extract(url, '^([^?#]*)', 1)), '.pdf')")
def pdf_urls(t, _):
    return t("policy_events").where(D.is_pdf(F.col("url"))).select("url")


_VARIANTS = "unnest([2023, 2024, 2025]) a(y), unnest(range(1, 13)) b(m), unnest([0, 1, 2]) c(f)"
_SPELT = "base || case f when 0 then y || '/' || lpad(m::varchar, 2, '0') || '/' when 1 then y || '-' || lpad(m::varchar, 2, '0') || '/' else y || lpad(m::varchar, 2, '0') || '/' end"


@query(f"with recent as (select authority, url from (select *, row_number() over (partition by authority order by access_ts desc nulls last, event_id, pub_date nulls first, url) r from policy_events where url is not null) where r <= 50), bases as (select distinct authority, array_to_string(string_split(url, '/')[1:4], '/') || '/' base from recent where len(string_split(url, '/')) >= 4), made as (select authority, base, y, m, f, {_SPELT} url from bases, {_VARIANTS}) select authority, url from (select *, row_number() over (partition by authority order by base, y, m, f) r from made where url not in (select url from policy_events where url is not null)) where r <= 100")
def pattern_urls(t, _):
    return D.pattern_urls(t("policy_events"))


@query(f"select host, url from (select *, row_number() over (partition by host order by url) r from (select distinct {_HOST} host, url from pages where url is not null)) where r <= 2")
def urls_per_domain_cap2(t, _):
    urls = t("pages").where("url is not null").select(T.netloc(F.col("url")).alias("host"), "url").distinct()
    return D.first_of_each(urls, F.col("host"), [F.asc("url")], 2)


@query(f"select rule, event_id from (select a.rule, a.event_id, row_number() over (partition by a.rule order by e.ts desc nulls last, a.event_id) r from ({R._ALERTS}) a join (select event_id, max(access_ts) ts from policy_events group by 1) e on e.event_id = a.event_id) where r <= 10")
def alerts_digest_top10(t, spark):
    found = S.match_alerts(t("policy_events"), spark.createDataFrame(_RULES, "name string, authorities array<string>, keywords array<string>"))
    seen = t("policy_events").groupBy("event_id").agg(F.max("access_ts").alias("ts"))
    return D.first_of_each(found.join(seen, "event_id"), F.col("rule"), [F.desc_nulls_last("ts"), F.asc("event_id")], 10).select("rule", "event_id")


@query("select event_id, authority, pub_date, strftime(access_ts at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ') seen, coalesce(nullif(title, ''), authority || ': Document') title, coalesce(nullif(lang, ''), 'en') lang, coalesce(policy_area, 'other') area from policy_events")
def export_events(t, _):
    title = F.coalesce(F.nullif(F.col("title"), F.lit("")), F.concat("authority", F.lit(": Document")))
    return t("policy_events").select("event_id", "authority", "pub_date", F.date_format("access_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("seen"), title.alias("title"), F.coalesce(F.nullif(F.col("lang"), F.lit("")), F.lit("en")).alias("lang"), F.coalesce("policy_area", F.lit("other")).alias("area"))


@query("select doc_id, document_id, event_id, coalesce(length(clean_text), 0) clean_len, coalesce(length(raw_text), 0) raw_len, rendered from documents")
def export_documents(t, _):
    return t("documents").select("doc_id", "document_id", "event_id", F.coalesce(F.length("clean_text"), F.lit(0)).alias("clean_len"), F.coalesce(F.length("raw_text"), F.lit(0)).alias("raw_len"), "rendered")


@query("select event_id, left(title, 120) title from policy_events order by access_ts desc nulls last, event_id desc, pub_date nulls first limit 10")
def recent_events(t, _):
    return t("policy_events").orderBy(F.desc_nulls_last("access_ts"), F.desc("event_id"), F.asc_nulls_first("pub_date")).limit(10).select("event_id", F.left("title", F.lit(120)).alias("title"))


@query(f"select event_id, url from policy_events order by case when access_ts >= {_ASOF} - interval 30 day then 0 else 1 end, access_ts desc nulls last, event_id, pub_date nulls first limit 60")
def exec_sampler(t, _):
    recent = F.when(F.col("access_ts") >= F.lit(AS_OF).cast("timestamp") - F.make_interval(days=F.lit(30)), 0).otherwise(1)
    return t("policy_events").orderBy(recent, F.desc_nulls_last("access_ts"), F.asc("event_id"), F.asc_nulls_first("pub_date")).limit(60).select("event_id", "url")


@query(f"select (select count(*) from (select distinct d.doc_id from documents d join policy_events e on e.event_id = d.event_id where length(d.clean_text) > 100 and (e.embedding is null or e.embedding_model is null or e.embedding_model <> '{MODEL}'))) eligible, (select count(*) from documents d where length(d.clean_text) > 100 and d.event_id in (select event_id from policy_events where embedding is null or embedding_model is null or embedding_model <> '{MODEL}')) built")
def builder_parity(t, _):
    e, d = t("policy_events"), t("documents")
    need = e.where(F.col("embedding").isNull() | F.col("embedding_model").isNull() | (F.col("embedding_model") != MODEL))
    one = S.pending_embeddings(e, d, MODEL).agg(F.count_distinct("doc_id").alias("eligible"))
    two = d.where(F.length("clean_text") > 100).join(need, "event_id", "left_semi").agg(F.count(F.lit(1)).alias("built"))
    return one.withColumn("k", F.lit(1)).join(two.withColumn("k", F.lit(1)), "k").drop("k")


@query(f"select authority, count(*) cohort, count(*) filter (embedding is not null and embedding_model = '{MODEL}') embedded, count(*) filter (summary_en is not null) summarised, {_pct(f'count(*) filter (embedding is not null and embedding_model = {MODEL!r})', 'count(*)')} embedded_pct from policy_events e where event_id in (select event_id from documents where length(clean_text) >= 500) group by 1")
def cohort_coverage(t, _):
    cohort = t("documents").where(F.length("clean_text") >= 500).select("event_id").distinct()
    done = F.count_if(F.col("embedding").isNotNull() & (F.col("embedding_model") == MODEL))
    rows = t("policy_events").join(cohort, "event_id", "left_semi").groupBy("authority").agg(F.count(F.lit(1)).alias("cohort"), done.alias("embedded"), F.count("summary_en").alias("summarised"))
    return rows.withColumn("embedded_pct", C.pct(F.col("embedded"), F.col("cohort")))


@query("select event_id, pub_date, case when embedding is null then 1 else 0 end needs_embedding, case when summary_en is null then 1 else 0 end needs_summary from policy_events where event_id in (select event_id from documents where length(clean_text) >= 500)")
def cohort_flags(t, _):
    cohort = t("documents").where(F.length("clean_text") >= 500).select("event_id").distinct()
    return t("policy_events").join(cohort, "event_id", "left_semi").select("event_id", "pub_date", F.when(F.col("embedding").isNull(), 1).otherwise(0).alias("needs_embedding"), F.when(F.col("summary_en").isNull(), 1).otherwise(0).alias("needs_summary"))


@query(f"select b.authority, b.pct before_pct, coalesce(a.pct, 0) after_pct, coalesce(a.pct, 0) >= 75 or coalesce(a.pct, 0) - b.pct >= 30 improved from (select authority, {_pct('count(summary_en)', 'count(*)')} pct from policy_events where access_ts < timestamptz '2024-01-01 00:00:00+00' group by 1 having {_pct('count(summary_en)', 'count(*)')} < 75) b left join (select authority, {_pct('count(summary_en)', 'count(*)')} pct from policy_events where access_ts < {_ASOF} group by 1) a on a.authority = b.authority")
def laggard_progress(t, _):
    share = lambda df: df.groupBy("authority").agg(C.pct(F.count("summary_en"), F.count(F.lit(1))).alias("pct"))
    e = t("policy_events")
    before = share(e.where("access_ts < timestamp '2024-01-01'")).where("pct < 75").select("authority", F.col("pct").alias("before_pct"))
    after = share(e.where(F.col("access_ts") < F.lit(AS_OF).cast("timestamp"))).select("authority", F.col("pct").alias("after_pct"))
    rows = before.join(after, "authority", "left").fillna(0, ["after_pct"])
    return rows.withColumn("improved", (F.col("after_pct") >= 75) | (F.col("after_pct") - F.col("before_pct") >= 30))


_ORDER = ["HFSB", "NDIC", "KTIT", "VPTB"]


@query(f"select event_id, pub_date, coalesce(list_position({_ORDER!r}, authority), 0)::bigint priority from policy_events")
def authority_rank(t, _):
    return t("policy_events").select("event_id", "pub_date", F.coalesce(F.array_position(F.array(*map(F.lit, _ORDER)), F.col("authority")), F.lit(0)).alias("priority"))


@query("select p.url, '[Citation: ' || coalesce(p.title, 'Untitled') || ' | ' || strftime(p.at at time zone 'UTC', '%Y-%m-%d') || ' | ' || p.url || ' | accessed 2025-10-01 | snippets ' || c.n || ']' line from (select url, max(title) title, min(fetched_at) as at from pages where fetched_at is not null group by 1) p join (select p.url, count(*) n from chunks c join pages p on p.id = c.page_id group by 1) c on c.url = p.url")
def citation_lines(t, _):
    pages = t("pages").where("fetched_at is not null").groupBy("url").agg(F.max("title").alias("title"), F.min("fetched_at").alias("at"))
    counts = t("chunks").join(t("pages").select(F.col("id").alias("page_id"), "url"), "page_id").groupBy("url").agg(F.count(F.lit(1)).alias("n"))
    return pages.join(counts, "url").select("url", D.citation(F.col("title"), F.date_format("at", "yyyy-MM-dd"), F.col("url"), F.lit("2025-10-01"), F.col("n")).alias("line"))


_SLUG = "regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


@query(f"select event_id, pub_date, 'NB-' || year(access_ts at time zone 'UTC') || 'Q' || quarter(access_ts at time zone 'UTC') || '-' || {_SLUG} || '-001' brief from policy_events where access_ts is not null and title is not null")
def brief_ids(t, _):
    return t("policy_events").where("access_ts is not null and title is not null").select("event_id", "pub_date", D.brief_id("NB", F.col("access_ts"), F.col("title")).alias("brief"))


@query(f"select authority, age_days, case when age_days is not null and age_days <> 0 and age_days < 30 then 'Active' else 'Stale' end status from (select authority, floor((epoch_us({_ASOF}) - epoch_us(max(access_ts))) / 86400000000)::bigint age_days from policy_events group by 1)")
def status_labels(t, _):
    age = F.floor((F.unix_micros(F.lit(AS_OF).cast("timestamp")) - F.unix_micros(F.max("access_ts"))) / 86_400_000_000)
    return t("policy_events").groupBy("authority").agg(age.alias("age_days")).select("authority", "age_days", C.status_label(F.col("age_days")).alias("status"))


@query("select event_id, case when n = 0 then 'no_doc' else 'short_doc' end reason from (select event_id, coalesce(max(d_len), 0) n from " + _J + " where event_id is not null group by 1) where n < 400")
def target_reasons(t, _):
    longest = C.with_documents(t("policy_events"), t("documents")).where("event_id is not null").groupBy("event_id").agg(F.coalesce(F.max("d_len"), F.lit(0)).alias("n"))
    return longest.where("n < 400").select("event_id", F.when(F.col("n") == 0, "no_doc").otherwise("short_doc").alias("reason"))


@query("select url, c.id chunk, count(*) over (partition by url) snippets from chunks c join pages p on p.id = c.page_id")
def snippet_counts(t, _):
    # an url's count is summed map-side and joined back: no task holds an url's hits
    hits = t("chunks").select(F.col("id").alias("chunk"), "page_id").join(t("pages").select(F.col("id").alias("page_id"), "url"), "page_id")
    counts = hits.groupBy("url").agg(F.count(F.lit(1)).alias("snippets"))
    return hits.join(counts.withColumnRenamed("url", "_url"), F.col("url").eqNullSafe(F.col("_url"))).select("url", "chunk", "snippets")


@query("select doc_id, source_url from documents where created_at < timestamptz '2024-06-01 00:00:00+00' union all select min(doc_id), source_url from documents where created_at >= timestamptz '2024-06-01 00:00:00+00' and source_url is not null and source_url not in (select source_url from documents where created_at < timestamptz '2024-06-01 00:00:00+00' and source_url is not null) group by source_url")
def insert_ignore(t, _):
    d = t("documents").select("doc_id", "source_url", "created_at")
    target = d.where("created_at < timestamp '2024-06-01'").select("doc_id", "source_url")
    source = M.latest(d.where("created_at >= timestamp '2024-06-01'").select("doc_id", "source_url"), "source_url", F.asc("doc_id"))
    return M.insert_missing(target, source, "source_url")


@query("select domain, base_url from sources where contains(lower(domain), 'gov') or contains(lower(domain), 'news') or contains(lower(base_url), 'gov') or contains(lower(base_url), 'news')")
def source_filter(t, _):
    return D.name_filter(t("sources"), ["GOV", "news"], "domain", "base_url").select("domain", "base_url")


@query("select upper(authority) authority, count(*) drops, count(metric) with_metric, count(distinct url) urls from quality_drops group by 1")
def drops_by_authority(t, _):
    return t("quality_drops").groupBy(F.upper("authority").alias("authority")).agg(F.count(F.lit(1)).alias("drops"), F.count("metric").alias("with_metric"), F.count_distinct("url").alias("urls"))


@query("select domain, min_by(error, n) filter (coalesce(error, '') <> '') first_error, count(*) n from (select *, row_number() over () n from fc_errors) group by 1")
def first_error_per_domain(t, _):
    rows = t.arrival("fc_errors").withColumnRenamed("arrival", "seq")
    return rows.groupBy("domain").agg(L.first_told(F.col("error")).getField("error").alias("first_error"), F.count(F.lit(1)).alias("n"))


@query("select coalesce(a.authority, b.authority) authority, coalesce(events, 0) events, coalesce(calls, 0) calls from (select authority, count(*) events from policy_events group by 1) a full join (select authority, count(*) calls from provider_events group by 1) b on a.authority is not distinct from b.authority")
def events_and_calls(t, _):
    a = t("policy_events").groupBy("authority").agg(F.count(F.lit(1)).alias("events"))
    b = t("provider_events").groupBy(F.col("authority").alias("b_authority")).agg(F.count(F.lit(1)).alias("calls"))
    rows = a.join(b, a["authority"].eqNullSafe(b["b_authority"]), "full")
    return rows.select(F.coalesce("authority", "b_authority").alias("authority"), F.coalesce("events", F.lit(0)).alias("events"), F.coalesce("calls", F.lit(0)).alias("calls"))


@query("select meta['authority'] authority, meta['lang'] lang, count(*) chunks, sum(text_len)::bigint text_len from chunks group by 1, 2")
def chunk_meta(t, _):
    return t("chunks").groupBy(F.col("meta")["authority"].alias("authority"), F.col("meta")["lang"].alias("lang")).agg(F.count(F.lit(1)).alias("chunks"), F.sum("text_len").alias("text_len"))


@query("select event_id, pub_date, substr(coalesce(nullif(d.body, ''), nullif(e.title, ''), ''), 1, 2000) input from policy_events e left join (select event_id, min_by(clean_text, doc_id) filter (clean_text is not null) body from documents group by 1) d using (event_id)")
def summary_inputs(t, _):
    body = t("documents").where("clean_text is not null and event_id is not null").groupBy("event_id").agg(F.min(F.struct("doc_id", F.left("clean_text", F.lit(2000)).alias("body"))).getField("body").alias("body"))  # cut before the shuffle
    text = F.coalesce(F.nullif(F.col("body"), F.lit("")), F.nullif(F.col("title"), F.lit("")), F.lit(""))
    return t("policy_events").join(body, "event_id", "left").select("event_id", "pub_date", F.substring(text, 1, 2000).alias("input"))
