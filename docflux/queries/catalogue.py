"""Queries of chunking, request building, ingestion chains, discovery, gates, rules and reports, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflux.functions import text as T
from docflux.operators import coverage as C
from docflux.operators import discovery as D
from docflux.operators import merge as M
from docflux.operators import quality as Q
from docflux.operators import selection as S
from docflux.queries import reference as R
from docflux.queries.reference import AS_OF, MODEL, SUMMARY_MODEL
from docflux.queries.registry import registry
from docflux.sources import readers

query, QUERIES, SQL = registry()

_ASOF, _J, _HOST, _LATEST, _CUT = R._ASOF, R._J, R._HOST, R._LATEST, R._CUT
_pct = R._pct
CUT = "timestamp '2024-06-01'"
SINCE = "2024-06-01"

# The system message of summary requests, and what requests cost in dollars a million tokens, less the batch discount.
SYSTEM = "Summarize in 2 sentences. English only."
EMBED_IN, SUMMARY_IN, SUMMARY_OUT, DISCOUNT, ANSWER = 0.02, 0.150, 0.600, 0.5, 180
# Rules of the classifier by authority and kind, markers of hosts, fetch policies.
CLASSES = {
    "HFSB": {"policy_area": [("payments", ["payment", "stored value"]), ("lending", ["lending", "credit"])], "action_type": [("consultation", ["consultation", "seeking views"]), ("enforcement", ["penalty", "weaknesses"])]},
    "NDIC": {"policy_area": [("data_protection", ["data", "consent"]), ("payments", ["payment"])], "action_type": [("circular", ["circular"])]},
    "KTIT": {"policy_area": [("telecom", ["spectrum", "spektrum", "tower"])], "action_type": [("consultation", ["perundingan", "konsultasi", "consultation"])]},
}
MARKERS = [("HFSB", ["hfsb", "harbour"]), ("NDIC", ["ndic"]), ("KTIT", ["ktit", "kominfo"]), ("VPTB", ["vptb", "bank"])]
POLICIES = [(["HFSB", "NDIC"], "stealth", 12000), (["KTIT", "VPTB", "OPKN"], "stealth", 5000)]


# ------------------------------------------------------------------ chunks, requests, their cost
_WORDS = "regexp_extract_all(clean_text, '[^ \\t\\n\\f\\r]+[ \\t\\n\\f\\r]*')"


def _token_sql(most: int) -> str:
    step = most - most // 10
    return (
        f"with w as (select doc_id, clean_text, {_WORDS} words from documents where clean_text is not null), s as (select doc_id, clean_text, words, unnest(range(0, 1 + greatest(ceil((len(words) - {most}) / {step}), 0)::bigint)) i from w) "
        f"select doc_id, i::int chunk_index, md5(case when len(words) <= {most} then clean_text else array_to_string(words[i * {step} + 1 : i * {step} + {most}], '') end) chunk_md5 from s"
    )


def _token_chunks(t, most):
    rows = t("documents").where("clean_text is not null").select("doc_id", F.inline(T.token_chunks(F.col("clean_text"), most)))
    return rows.select("doc_id", "chunk_index", F.md5("chunk").alias("chunk_md5"))


@query(_token_sql(1500))
def token_chunks(t, _):
    return _token_chunks(t, 1500)


@query(_token_sql(200))
def token_chunks_short(t, _):
    return _token_chunks(t, 200)


_NEEDS = f"length(clean_text) > 100 and event_id in (select event_id from policy_events where embedding is null or embedding_model is null or embedding_model <> '{MODEL}')"
_FIRST_BODY = "(select event_id, min_by(substr(clean_text, 1, 2000), doc_id) filter (clean_text is not null) body from documents where event_id is not null group by 1)"
_SUMMARY_INPUT = f"(select e.event_id, e.summary_model, e.summary_en, substr(coalesce(nullif(d.body, ''), nullif(e.title, ''), ''), 1, 2000) input from {_LATEST} e left join {_FIRST_BODY} d on d.event_id = e.event_id where e.summary_en is null or e.summary_model is null or e.summary_model <> '{SUMMARY_MODEL}')"


def _summary_inputs(t):
    body = t("documents").where("clean_text is not null and event_id is not null").groupBy("event_id").agg(F.min(F.struct("doc_id", F.left("clean_text", F.lit(2000)).alias("body"))).getField("body").alias("body"))
    events = R._latest(t).where(F.col("summary_en").isNull() | F.col("summary_model").isNull() | (F.col("summary_model") != SUMMARY_MODEL)).select("event_id", "title")
    text = F.coalesce(F.nullif(F.col("body"), F.lit("")), F.nullif(F.col("title"), F.lit("")), F.lit(""))
    return events.join(body, "event_id", "left").select("event_id", F.substring(text, 1, 2000).alias("input"))


@query(f"select 'sum:' || event_id custom_id, '{SUMMARY_MODEL}' model, '{SYSTEM}' \"system\", md5(input) input_md5, {ANSWER} max_tokens from {_SUMMARY_INPUT} where length(input) >= 50")
def summary_requests(t, _):
    lines = S.summary_requests(_summary_inputs(t), F.col("event_id"), F.col("input"), SUMMARY_MODEL, SYSTEM, ANSWER)
    field = lambda p: F.get_json_object("line", p)
    return lines.select(field("$.custom_id").alias("custom_id"), field("$.body.model").alias("model"), field("$.body.messages[0].content").alias("system"), F.md5(field("$.body.messages[1].content")).alias("input_md5"), field("$.body.max_tokens").cast("int").alias("max_tokens"))


@query(
    f"select 'embedding' kind, count(*) requests, coalesce(sum(length(substr(clean_text, start + 1, 1200)) // 4), 0)::bigint tokens_in, 0::bigint tokens_out, round(coalesce(sum(length(substr(clean_text, start + 1, 1200)) // 4), 0) / 1e6 * {EMBED_IN} * {DISCOUNT}, 4) usd from (select clean_text, unnest(range(0, greatest(length(clean_text), 1), 1000)) as start from documents where {_NEEDS}) "
    f"union all select 'summary', count(*), coalesce(sum(length(input) // 4), 0)::bigint, count(*) * {ANSWER}, round((coalesce(sum(length(input) // 4), 0) / 1e6 * {SUMMARY_IN} + count(*) * {ANSWER} / 1e6 * {SUMMARY_OUT}) * {DISCOUNT}, 4) from {_SUMMARY_INPUT} where length(input) >= 50"
)
def batch_costs(t, _):
    need = S.pending_embeddings(t("policy_events"), t("documents"), MODEL).select("doc_id")
    chunks = t("documents").join(need, "doc_id", "left_semi").select(F.inline(T.char_chunks(F.col("clean_text"))))
    count, tokens = F.count(F.lit(1)), lambda c: F.coalesce(F.sum(T.token_estimate(F.col(c))), F.lit(0))
    one = chunks.agg(F.lit("embedding").alias("kind"), count.alias("requests"), tokens("chunk").alias("tokens_in"), F.lit(0).cast("bigint").alias("tokens_out"))
    one = one.withColumn("usd", F.round(F.col("tokens_in") / 1e6 * EMBED_IN * DISCOUNT, 4))
    two = _summary_inputs(t).where(F.length("input") >= 50).agg(F.lit("summary").alias("kind"), count.alias("requests"), tokens("input").alias("tokens_in"), (count * ANSWER).alias("tokens_out"))
    return one.unionByName(two.withColumn("usd", F.round((F.col("tokens_in") / 1e6 * SUMMARY_IN + F.col("tokens_out") / 1e6 * SUMMARY_OUT) * DISCOUNT, 4)))


_IDS = "(select 'emb:' || doc_id || ':' || (n_chars // 1000) cid from documents union all select 'sum:' || coalesce(event_id, '') from documents union all select 'emb:' || coalesce(source, '') from documents)"


@query(f"select case when regexp_full_match(cid, 'emb:[^:]*:[+-]?[0-9]+') then 'emb' when regexp_full_match(cid, 'sum:[^:]*') then 'sum' else 'invalid' end kind, count(*) n from {_IDS} group by 1")
def custom_id_kinds(t, _):
    d = t("documents")
    ids = d.select(F.concat(F.lit("emb:"), "doc_id", F.lit(":"), F.floor(F.col("n_chars") / 1000)).alias("custom_id")).where("custom_id is not null")
    blank = d.where("n_chars is null").select(F.lit(None).cast("string").alias("custom_id"))
    ids = ids.unionByName(blank).unionByName(d.select(F.concat(F.lit("sum:"), F.coalesce("event_id", F.lit(""))).alias("custom_id"))).unionByName(d.select(F.concat(F.lit("emb:"), F.coalesce("source", F.lit(""))).alias("custom_id")))
    kind, _key, _part = S.parse_custom_id(F.col("custom_id"))
    return ids.groupBy(F.coalesce(kind, F.lit("invalid")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


_SENTENCES = "regexp_extract_all(substr(clean_text, 1, 8000), '[^.!?]+[.!?]?')"


@query(f"select doc_id, md5(trim(array_to_string({_SENTENCES}[1 : case when starts_with(lower(coalesce(lang, 'en')), 'en') then 3 else 5 end], ''), ' ')) lead_md5 from documents where clean_text is not null")
def lead_summaries(t, _):
    return t("documents").where("clean_text is not null").select("doc_id", F.md5(T.lead_sentences(F.col("clean_text"), F.col("lang"))).alias("lead_md5"))


@query("select vec_id, len(embedding) dims, round(list_sum(embedding::double[]), 4) total from embeddings")
def vector_round_trip(t, _):
    back = T.vector_of(T.vector_text(F.col("embedding")))
    return t("embeddings").select("vec_id", F.size(back).cast("bigint").alias("dims"), F.round(F.aggregate(back, F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("total"))


@query("select page_id, id chunk, text_len from chunks where chunk_index = 0")
def lead_chunks(t, _):
    return t("chunks").where("chunk_index = 0").select("page_id", F.col("id").alias("chunk"), "text_len")


# ------------------------------------------------------------------ merges and chains (SK2, SK3, SK6, SK8, J16, I2)
_DOC_LATEST = "(select * exclude (r) from (select *, row_number() over (partition by {k} order by created_at desc nulls last, doc_id) r from documents where {k} is not null and {w}) where r = 1)"


def _doc_sides(t, key):
    d = t("documents").select("doc_id", "event_id", "source_url", "title", "lang", "n_chars", "rendered", "created_at")
    newest = [F.desc_nulls_last("created_at"), F.asc("doc_id")]
    return M.latest(d.where(f"created_at < {CUT}"), key, *newest), M.latest(d.where(f"created_at >= {CUT}"), key, *newest)


def _merged_docs(key: str, fill: list[str], over: list[str]) -> str:
    new, old = _DOC_LATEST.format(k=key, w=f"created_at >= {_CUT}"), _DOC_LATEST.format(k=key, w=f"created_at < {_CUT}")
    cols = ", ".join([f"coalesce(s.{c}, t.{c}) {c}" for c in fill] + [f"case when s.{key} is not null then s.{c} else t.{c} end {c}" for c in over])
    return f"select coalesce(t.{key}, s.{key}) {key}, {cols}, case when t.{key} is null then 'inserted' when s.{key} is not null then 'updated' else 'kept' end outcome from {old} t full join {new} s on s.{key} = t.{key}"


@query(_merged_docs("source_url", ["title"], ["lang", "n_chars"]))
def merge_documents(t, _):
    target, source = _doc_sides(t, "source_url")
    cols = ["source_url", "title", "lang", "n_chars"]
    return M.upsert(target.select(*cols), source.select(*cols), "source_url", overwrite=["lang", "n_chars"], fill=["title"])


@query(_merged_docs("event_id", [], ["n_chars", "rendered"]))
def canonical_documents(t, _):
    target, source = _doc_sides(t, "event_id")
    cols = ["event_id", "n_chars", "rendered"]
    return M.upsert(target.select(*cols), source.select(*cols), "event_id", overwrite=["n_chars", "rendered"], fill=[])


@query(f"select event_id, case when s.k is not null and (summary_model is null or summary_model <> '{SUMMARY_MODEL}') then '{SUMMARY_MODEL}' else summary_model end summary_model, case when s.k is not null and (summary_model is null or summary_model <> '{SUMMARY_MODEL}') then 'upserted' when s.k is not null then 'skipped' else 'kept' end outcome from {_LATEST} e left join (select distinct event_id k from documents where event_id is not null and length(clean_text) >= 400) s on s.k = e.event_id")
def guarded_summary(t, _):
    results = t("documents").where("event_id is not null and length(clean_text) >= 400").select("event_id").distinct().select("event_id", F.lit("new").alias("summary_en"), F.lit(SUMMARY_MODEL).alias("summary_model"))
    return M.guarded_update(R._latest(t).select("event_id", "summary_en", "summary_model"), results, "event_id", "summary_en", "summary_model").select("event_id", "summary_model", "outcome")


_PAGE_HOST = _HOST.replace("url", "p.url")


@query(
    f"with t as (select * from pages where fetched_at < {_CUT}), s as (select * from pages where fetched_at >= {_CUT}), "
    f"tc as (select p.url, p.content_hash, c.chunk_index from chunks c join t p on p.id = c.page_id), sc as (select p.url, p.content_hash, c.chunk_index from chunks c join s p on p.id = c.page_id) "
    f"select 'source' kind, count(*) filter (held) \"found\", count(*) filter (not held) created from (select h, h in (select {_PAGE_HOST} from t p where {_PAGE_HOST} is not null) held from (select distinct {_PAGE_HOST} h from s p) where h is not null) "
    "union all select 'page', count(*) filter (held), count(*) filter (not held) from (select k.*, exists (select 1 from t where t.url = k.url and t.content_hash = k.content_hash) held from (select distinct url, content_hash from s where url is not null and content_hash is not null) k) "
    "union all select 'chunk', count(*) filter (held), count(*) filter (not held) from (select k.*, exists (select 1 from tc where tc.url = k.url and tc.content_hash = k.content_hash and tc.chunk_index = k.chunk_index) held from (select distinct * from sc where url is not null and content_hash is not null and chunk_index is not null) k)"
)
def ingest_chain(t, _):
    pages = t("pages").select("id", "url", "content_hash", "fetched_at", T.netloc(F.col("url")).alias("host"))
    old, new = pages.where(f"fetched_at < {CUT}"), pages.where(f"fetched_at >= {CUT}")
    pieces = lambda p: t("chunks").select("page_id", "chunk_index").join(p.select(F.col("id").alias("page_id"), "url", "content_hash"), "page_id")
    levels = [("source", old, new, ["host"]), ("page", old, new, ["url", "content_hash"]), ("chunk", pieces(old), pieces(new), ["url", "content_hash", "chunk_index"])]
    out = None
    for kind, target, source, keys in levels:
        made = M.get_or_create(target, source, keys).agg(F.count_if(F.col("outcome") == "found").alias("found"), F.count_if(F.col("outcome") == "created").alias("created")).select(F.lit(kind).alias("kind"), "found", "created")
        out = made if out is None else out.unionByName(made)
    return out


@query(f"select url, content_hash, exists (select 1 from pages o where o.url = n.url and o.content_hash = n.content_hash and o.fetched_at < {_CUT}) unchanged from (select distinct url, content_hash from pages where fetched_at >= {_CUT} and url is not null and content_hash is not null) n")
def unchanged_pages(t, _):
    p = t("pages").select("url", "content_hash", "fetched_at")
    rows = M.get_or_create(p.where(f"fetched_at < {CUT}"), p.where(f"fetched_at >= {CUT}"), ["url", "content_hash"])
    return rows.select("url", "content_hash", (F.col("outcome") == "found").alias("unchanged"))


@query("with good as (select * from documents where length(clean_text) >= 400), poor as (select distinct event_id, url from policy_events where event_id is not null and url is not null and event_id not in (select event_id from good where event_id is not null)), by_url as (select source_url url, doc_id from (select *, row_number() over (partition by source_url order by created_at desc nulls last, doc_id) r from good where source_url is not null) where r = 1) select event_id, min(doc_id) doc_id from poor join by_url using (url) group by 1")
def link_backfill(t, _):
    return M.link_backfill(t("policy_events"), t("documents").select("doc_id", "event_id", "source_url", "created_at", "clean_text"))


# ------------------------------------------------------------------ discovery, links, metadata (SC10-SC13, PF21, F5, F20, F31, F33, J13, F30)
_URLS = "list_concat(case when coalesce(trim(source_url, ' '), '') <> '' then [trim(source_url, ' ')] else []::varchar[] end, regexp_extract_all(raw_text, 'https?://[^\\s)\\]>\"'']+'))"


def _as_html(t):
    """Raw texts with a link to their own url and their bare urls made anchors: pages as a fetcher would deliver them."""
    own = F.concat(F.lit('<a href="'), F.coalesce("source_url", F.lit("")), F.lit('">this page</a> '))
    return t("documents").where("raw_text is not null").select("doc_id", "source_url", F.concat(own, F.regexp_replace("raw_text", r"""(https?://[^\s)\]>"']+)""", '<a href="$1">link</a>')).alias("html"))


@query(f"select doc_id, url from (select doc_id, url, row_number() over (partition by doc_id order by pos) r from (select doc_id, url, min(pos) pos from (select doc_id, unnest(l) url, generate_subscripts(l, 1) pos from (select doc_id, {_URLS} l from documents where raw_text is not null)) where starts_with(url, 'http') and regexp_matches(lower(url), '{'|'.join(T.LISTING_WORDS)}') group by 1, 2)) where r <= 50")
def listing_links(t, _):
    return _as_html(t).select("doc_id", F.explode(D.listing_links(F.col("source_url"), F.col("html"))).alias("url"))


@query(f"select distinct doc_id, url from (select doc_id, url, row_number() over (partition by doc_id order by pos) r from (select doc_id, unnest(l) url, generate_subscripts(l, 1) pos from (select doc_id, {_URLS} l from documents where raw_text is not null)) where starts_with(url, 'http') and regexp_matches(lower(url), '{'|'.join(T.LANDING_WORDS)}')) where r <= 8")
def landing_links(t, _):
    return _as_html(t).select("doc_id", F.explode(D.landing_links(F.col("source_url"), F.col("html"))).alias("url"))


@query("select distinct doc_id, url from (select doc_id, unnest(regexp_extract_all(raw_text, '\\[[^\\]\\n]*\\]\\((https?://[^)\\s]+)\\)', 1)) url from documents where raw_text is not null union all select doc_id, unnest(regexp_extract_all(raw_text, 'https?://[^\\s)\\]>\"'']+')) from documents where raw_text is not null)")
def text_links(t, _):
    return t("documents").where("raw_text is not null").select("doc_id", F.explode(T.text_links(F.col("raw_text"))).alias("url"))


@query(f"select distinct url, epoch_us(date_trunc('second', fetched_at)) lastmod_us, 'sitemap' source, true in_sitemap from pages where url is not null and (fetched_at is null or date_trunc('second', fetched_at) >= {_ASOF} - interval 365 day)")
def sitemap_entries(t, _):
    stamp = F.coalesce(F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(""))
    xml = t("pages").where("url is not null").select(F.concat(F.lit("<urlset><url><loc>"), "url", F.lit("</loc><lastmod>"), stamp, F.lit("</lastmod></url></urlset>")).alias("xml")).distinct()
    rows = xml.select(F.inline(readers.sitemap_urls(F.col("xml"))))
    return D.since_lastmod(rows, "lastmod", AS_OF, 365).select("url", F.unix_micros("lastmod").alias("lastmod_us"), F.lit("sitemap").alias("source"), F.lit(True).alias("in_sitemap")).distinct()


@query("select event_id, pub_date, trim(url, ' ') url from policy_events where coalesce(trim(url, ' '), '') <> ''")
def feed_items(t, _):
    feed = F.concat(F.lit("<rss><channel><item><title>t</title><link> "), "url", F.lit(" </link></item></channel></rss>"))
    return t("policy_events").where("coalesce(trim(url), '') <> ''").select("event_id", "pub_date", F.explode(readers.feed_links(feed)).alias("url"))


@query("select event_id, pub_date, case when pub_date is not null and regexp_full_match(upper(pub_date), '\\d{4}-\\d{2}-\\d{2}([T ]\\d{2}:\\d{2}:\\d{2})?|\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}(Z|[+-]\\d{2}:?\\d{2})') then epoch_us(try_cast(regexp_replace(upper(pub_date), '([+-]\\d{2})(\\d{2})$', '\\1:\\2') as timestamptz)) end meta_us from policy_events")
def metadata_times(t, _):
    return t("policy_events").select("event_id", "pub_date", F.unix_micros(T.metadata_time(F.col("pub_date"))).alias("meta_us"))


@query("select id, coalesce(nullif(case when from_cache then url end, ''), nullif(title, ''), nullif(content_hash, ''), nullif(url, '')) url from pages")
def metadata_urls(t, _):
    meta = F.struct(F.when(F.col("from_cache"), F.col("url")).alias("sourceURL"), F.col("title").alias("ogUrl"), F.col("content_hash").alias("url"))
    return t("pages").select("id", T.metadata_url(F.to_json(F.struct(meta.alias("metadata"), "url"))).alias("url"))


@query("select distinct nullif(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]+)', 1), '') base from provider_events where url is not null")
def base_urls(t, _):
    return t("provider_events").where("url is not null").select(T.base_url(F.col("url")).alias("base")).distinct()


def _marker_sql(column: str) -> str:
    return "case " + " ".join(f"when {' or '.join(f'contains(lower({column}), {n!r})' for n in needles)} then '{name}'" for name, needles in MARKERS) + " end"


@query(f"select doc_id, {_marker_sql('coalesce(' + _HOST.replace('url', 'source_url') + ', source)')} authority from documents")
def authority_markers(t, _):
    return t("documents").select("doc_id", D.first_marker(F.coalesce(T.netloc(F.col("source_url")), "source"), MARKERS).alias("authority"))


def _policy_sql(i: int, default: str) -> str:
    value = lambda p: f"'{p[1]}'" if i == 1 else str(p[2])
    return "case " + " ".join(f"when upper(coalesce(authority, '')) in ({', '.join(map(repr, p[0]))}) then {value(p)}" for p in POLICIES) + f" else {default} end"


@query(f"select authority, {_policy_sql(1, repr('auto'))} proxy, {_policy_sql(2, '2000')} wait_ms, count(*) calls, count(*) filter (proxy_mode = {_policy_sql(1, repr('auto'))}) as_planned from provider_events group by authority")
def fetch_policies(t, _):
    mode, wait = D.fetch_policy(F.col("authority"), POLICIES, ("auto", 2000))
    rows = t("provider_events").groupBy("authority", "proxy_mode").agg(F.count(F.lit(1)).alias("n"))
    return rows.groupBy("authority", mode.alias("proxy"), wait.alias("wait_ms")).agg(F.sum("n").alias("calls"), F.coalesce(F.sum(F.when(F.col("proxy_mode") == mode, F.col("n"))), F.lit(0)).alias("as_planned"))


# ------------------------------------------------------------------ gates and classifiers
_SOLID = "length(regexp_replace(coalesce(raw_text, ''), '\\s', '', 'g'))"
_LINKCH = "coalesce(list_sum([length(x) for x in regexp_extract_all(raw_text, '(?i)\\[([^\\]]{1,200})\\]\\(http[^)]+\\)', 1)]), 0)"
_BULLETCH = "coalesce(list_sum([length(regexp_replace(x, '\\s', '', 'g')) for x in string_split_regex(raw_text, '\\r?\\n') if regexp_matches(trim(x, ' '), '^[\\-*•]')]), 0)"
_MDSHARE = f"(case when {_SOLID} > 0 then least(1.0, ({_LINKCH} + {_BULLETCH})::double / {_SOLID}) else 0 end)"


@query(f"select doc_id, round({_MDSHARE}, 6) md_share, round(case when {_SOLID} > 0 then least(1.0, {_BULLETCH}::double / {_SOLID}) else 0 end, 6) li_share from documents where raw_text is not null")
def link_shares(t, _):
    x = F.col("raw_text")
    items = F.transform(F.filter(F.split(x, r"\r?\n"), lambda l: F.trim(l).rlike(r"^[\-*•]")), lambda l: F.concat(F.lit("<li>"), l, F.lit("</li>")))  # noqa: E741
    html = F.concat(F.array_join(items, ""), F.lit(" "))
    solid = F.length(F.regexp_replace(x, r"\s", ""))
    # the share of listed items in markup, measured with their tags and set against the page's characters
    inside = F.length(F.regexp_replace(html, r"\s", "")) * T.html_link_share(html) - 9 * F.size(items)
    return t("documents").where(x.isNotNull()).select("doc_id", F.round(T.markdown_link_share(x), 6).alias("md_share"), F.round(F.when(solid > 0, F.least(F.lit(1.0), inside / solid)).otherwise(0.0), 6).alias("li_share"))


_ASCII = f"(case when {_SOLID} > 0 then length(regexp_replace(regexp_replace(raw_text, '\\s', '', 'g'), '[^\\x00-\\x7F]', '', 'g'))::double / {_SOLID} else 0 end)"
_MISSING = " or ".join(f"contains(lower(concat_ws(' ', title, raw_text)), '{p}')" for p in T.NOT_FOUND)


@query(f"select doc_id, concat_ws(';', case when raw_text = '' then 'no_markdown' end, case when length(raw_text) < 700 then 'too_short' end, case when coalesce(source_url, '') = '' then 'no_url' end, case when {_MISSING} then 'not_found' end, case when {_MDSHARE} > 0.65 then 'link_farm' end, case when {_ASCII} < 0.6 then 'non_english' end) reasons from documents where raw_text is not null")
def markdown_gate(t, _):
    return Q.markdown_gate(t("documents").where("raw_text is not null"))


_QKEY = "sha256(lower(trim(coalesce(title, ''), ' ')) || '|' || coalesce(source_url, '') || '|' || substr(raw_text, 1, 400))"


@query(f"select doc_id, concat_ws(';', nullif(r, ''), case when row_number() over (partition by k order by doc_id nulls first, r) > 1 then 'dup_hash' end) reasons from (select doc_id, {_QKEY} k, concat_ws(';', case when length(raw_text) < 700 then 'thin' end, case when {_MISSING} then 'not_found' end, case when {_MDSHARE} > 0.65 then 'link_farm' end, case when {_ASCII} < 0.6 then 'non_english' end) r from documents where raw_text is not null)")
def gate_reasons(t, _):
    return Q.gate_reasons(t("documents").where("raw_text is not null"))


def _class_sql(kind: str) -> str:
    arms = [f"when upper(authority) = '{a}' and ({' or '.join(f'contains(hay, {k!r})' for k in words)}) then '{name}'" for a, kinds in CLASSES.items() for name, words in kinds.get(kind, [])]
    return "case " + " ".join(arms) + " else 'other' end"


@query(
    f"with j as (select d.doc_id, e.authority, lower(coalesce(d.title, '') || chr(10) || coalesce(d.clean_text, '')) hay from documents d join {_LATEST} e on e.event_id = d.event_id) "
    f"select doc_id, 'action_type' kind, {_class_sql('action_type')} name from j union all select doc_id, 'policy_area', {_class_sql('policy_area')} from j"
)
def classify_documents(t, spark):
    rules = [(a, kind, i, name, words) for a, kinds in CLASSES.items() for kind, listed in kinds.items() for i, (name, words) in enumerate(listed)]
    rules = spark.createDataFrame(rules, "authority string, kind string, ord int, name string, keywords array<string>")
    rows = t("documents").select("doc_id", "event_id", "title", "clean_text").join(R._latest(t).select("event_id", "authority"), "event_id")
    return S.classify(rows, F.col("authority"), F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("clean_text", F.lit(""))), rules, ["doc_id"])


# ------------------------------------------------------------------ coverage and reports (A3, A11, A14, A23, I5, PF2, PF3, PF14, Q10, T7-T13, W4, F35)
_FILTERED = "count(*) n_rows, count(*) filter (d_len >= 400) docs_ok, count(*) filter (summary_en is not null) summaries, 100.0::double * count(*) filter (d_len >= 400) / count(*) docs_ok_pct, 100.0::double * count(*) filter (summary_en is not null) / count(*) summaries_pct"


@query(f"select authority, {_FILTERED} from {_J} group by authority")
def coverage_filter(t, _):
    j = C.with_documents(t("policy_events"), t("documents"))
    n, ok, s = F.count(F.lit(1)), F.count_if(F.col("d_len") >= C.USABLE), F.count_if(F.col("summary_en").isNotNull())
    return j.groupBy("authority").agg(n.alias("n_rows"), ok.alias("docs_ok"), s.alias("summaries"), (100.0 * ok / n).alias("docs_ok_pct"), (100.0 * s / n).alias("summaries_pct"))


@query(
    "select 'events' metric, count(*) \"value\" from policy_events union all select 'with_summary_en', count(summary_en) from policy_events union all select 'with_summary_model', count(summary_model) from policy_events union all select 'with_embedding', count(embedding) from policy_events union all select 'with_embedding_model', count(embedding_model) from policy_events union all select 'documents', count(*) from documents "
    "union all select 'joined_embedded', count(*) from documents d join policy_events e on e.event_id = d.event_id where e.embedding is not null union all select 'joined_with_model', count(*) from documents d join policy_events e on e.event_id = d.event_id where e.embedding_model is not null "
    "union all select 'events_without_docs', count(*) from policy_events e where not exists (select 1 from documents d where d.event_id = e.event_id)"
)
def global_counts(t, _):
    return C.global_counts(t("policy_events"), t("documents"))


def _since_sql(c: str, m: str, name: str) -> str:
    new = f"count(*) filter ({m} = '{name}')"
    return f"select authority, count(*) n, count({c}) filled, {new} with_new, count(distinct {m}) models, {_pct(f'count({c})', 'count(*)', 1)} filled_pct, {_pct(new, 'count(*)', 1)} new_pct from policy_events where access_ts >= {_CUT} group by authority"


@query(_since_sql("summary_en", "summary_model", SUMMARY_MODEL))
def summary_deltas(t, _):
    return C.enrichment_since(t("policy_events"), SINCE, "summary_en", "summary_model", SUMMARY_MODEL)


@query(_since_sql("embedding", "embedding_model", MODEL))
def embedding_deltas(t, _):
    return C.enrichment_since(t("policy_events"), SINCE, "embedding", "embedding_model", MODEL)


@query(f"select authority, n_rows, docs_ok, {_pct('docs_ok', 'n_rows')} docs_ok_pct, row_number() over (order by n_rows desc, authority nulls first) place from (select authority, count(*) n_rows, count(*) filter (d_len >= 400) docs_ok from {_J} group by 1) where {_pct('docs_ok', 'n_rows')} < 75 order by place limit 20")
def laggards_by_volume(t, _):
    low = C.completeness(C.with_documents(t("policy_events"), t("documents"))).where("docs_ok_pct < 75").select("authority", "n_rows", "docs_ok", "docs_ok_pct")
    top = low.orderBy(F.desc("n_rows"), F.asc_nulls_first("authority")).limit(20)  # a report; what is numbered is these rows
    return top.withColumn("place", F.row_number().over(R.Window.orderBy(F.desc("n_rows"), F.asc_nulls_first("authority"))))


@query("select authority, (day + k::int)::date last_day, sum(n)::bigint n from (select authority, (access_ts at time zone 'UTC')::date as day, count(*) n from policy_events where access_ts is not null group by 1, 2), range(0, 7) r(k) group by 1, 2")
def sliding_week(t, _):
    return C.sliding_counts(t("policy_events"), "access_ts")


@query(f"select event_id, pub_date, url from policy_events where authority in ('HFSB', 'NDIC') and access_ts >= {_CUT} and access_ts < {_ASOF}")
def filtered_events(t, _):
    return S.filter_events(t("policy_events"), ["HFSB", "NDIC"], "2024-06-01", AS_OF).select("event_id", "pub_date", "url")


_PARITY = f"(select e.title, d.clean_text from {_LATEST} e left join documents d on d.event_id = e.event_id)"


@query(f"select eligible, built, abs(eligible - built) * 100.0::double / greatest(eligible, 1) <= 1 ok from (select count(*) filter ((clean_text is not null and length(clean_text) >= 50) or (clean_text is null and title is not null and length(title) >= 50)) eligible, count(*) filter (length(substr(coalesce(nullif(clean_text, ''), nullif(title, ''), ''), 1, 2000)) >= 50) built from {_PARITY})")
def summary_parity(t, _):
    rows = R._latest(t).select("event_id", "title").join(t("documents").select("event_id", F.col("clean_text").alias("body")), "event_id", "left")
    body, title = F.length("body"), F.length("title")
    eligible = F.when(F.col("body").isNotNull(), body >= 50).otherwise(title >= 50)
    text = F.coalesce(F.nullif(F.col("body"), F.lit("")), F.nullif(F.col("title"), F.lit("")), F.lit(""))
    one = rows.agg(F.count_if(eligible).alias("eligible"), F.count_if(F.length(F.left(text, F.lit(2000))) >= 50).alias("built"))
    return one.withColumn("ok", F.abs(F.col("eligible") - F.col("built")) * 100.0 / F.greatest("eligible", F.lit(1)) <= 1)


@query(f"select count(*) checks, count(*) filter (not ok) failed, bool_and(ok) passed from ({R.SQL['dq_report']})")
def dq_overall(t, _):
    return Q.overall(Q.dq_report(t("policy_events"), t("documents"), AS_OF))


@query("select event_id, url, access_ts is not null seen from policy_events where not coalesce(regexp_matches(url, '^https?://'), false) order by event_id, url nulls first, access_ts nulls first limit 10")
def failure_samples(t, _):
    return t("policy_events").where(Q.bad_scheme(F.col("url"))).orderBy("event_id", F.asc_nulls_first("url"), F.asc_nulls_first("access_ts")).limit(10).select("event_id", "url", F.col("access_ts").isNotNull().alias("seen"))


def _short_sql(limit: int, listed: list[str] | None) -> str:
    where = f"where authority in ({', '.join(map(repr, listed))})" if listed else ""
    first = f"list_position({listed!r}, authority), " if listed else ""
    return f"select event_id, authority, longest from (select event_id, authority, max(access_ts) seen, coalesce(max(d_len), 0) longest from {_J} {where} group by 1, 2) where longest < 400 order by {first}seen desc nulls last, event_id limit {limit}"


def _short_events(t, limit, listed=None):
    events = S.filter_events(t("policy_events"), listed)
    rows = C.with_documents(events, t("documents")).groupBy("event_id", "authority").agg(F.max("access_ts").alias("seen"), F.coalesce(F.max("d_len"), F.lit(0)).alias("longest")).where("longest < 400")
    first = [F.array_position(F.array(*map(F.lit, listed)), F.col("authority"))] if listed else []
    return rows.orderBy(*first, F.desc_nulls_last("seen"), "event_id").limit(limit).select("event_id", "authority", "longest")


@query(_short_sql(72, None))
def latest_candidates(t, _):
    return _short_events(t, 72)


_LAGGING = ["HFSB", "NDIC", "KTIT", "VPTB", "OPKN"]


@query(_short_sql(250, _LAGGING))
def canonical_targets(t, _):
    return _short_events(t, 250, _LAGGING)


@query(f"select rule, event_id, epoch_us(ts) ts_us from (select a.rule, a.event_id, e.ts from ({R._ALERTS}) a join (select event_id, max(access_ts) ts from policy_events group by 1) e on e.event_id = a.event_id) order by ts desc nulls last, rule desc, event_id desc limit 100")
def alerts_latest(t, spark):
    found = S.match_alerts(t("policy_events"), spark.createDataFrame(R.ALERT_RULES, "name string, authorities array<string>, keywords array<string>"))
    seen = t("policy_events").groupBy("event_id").agg(F.max("access_ts").alias("ts"))
    return found.join(seen, "event_id").orderBy(F.desc_nulls_last("ts"), F.desc("rule"), F.desc("event_id")).limit(100).select("rule", "event_id", F.unix_micros("ts").alias("ts_us"))


@query("select authority, count(*) n from policy_events group by 1 order by n desc, authority nulls first limit 5")
def top_authorities(t, _):
    return t("policy_events").groupBy("authority").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("authority")).limit(5)


_SHARE = "select authority, {p} pct from policy_events where access_ts < {at} group by 1"
_BEFORE, _AFTER = (_SHARE.format(p=_pct("count(summary_en)", "count(*)"), at=at) for at in (_CUT, _ASOF))


@query(f"select authority, printf('%+.2f', after_pct - before_pct) delta from (select b.authority, b.pct before_pct, a.pct after_pct from ({_BEFORE}) b join ({_AFTER}) a on a.authority = b.authority) order by round(after_pct - before_pct, 2) desc, authority limit 3")
def top_deltas(t, _):
    share = lambda df, name: df.groupBy("authority").agg(C.pct(F.count("summary_en"), F.count(F.lit(1))).alias(name))
    e = t("policy_events")
    rows = share(e.where(f"access_ts < {CUT}"), "before_pct").join(share(e.where(F.col("access_ts") < F.lit(AS_OF).cast("timestamp")), "after_pct"), "authority")
    top = rows.orderBy(F.desc(F.round(F.col("after_pct") - F.col("before_pct"), 2)), "authority").limit(3)
    return top.select("authority", T.percentage_points(F.col("after_pct"), F.col("before_pct")).alias("delta"))


@query("select distinct domain, title from (select s.domain, p.title from pages p join sources s on s.id = p.source_id where p.title is not null) order by domain, title limit 100")
def sources_appendix(t, _):
    cited = t("pages").where("title is not null").select("source_id", "title").distinct().join(t("sources").select(F.col("id").alias("source_id"), "domain"), "source_id")
    return cited.select("domain", "title").distinct().orderBy("domain", "title").limit(100)


@query("with e as (select event_id, authority, max(access_ts) seen from policy_events where event_id is not null group by 1, 2), n as (select count(*) g from (select distinct authority from e)), r as (select *, row_number() over (partition by authority order by seen desc nulls last, event_id) k from e) select event_id, authority from r, n where k <= least(30, 250 // g) order by authority nulls first, k limit 250")
def diverse_candidates(t, _):
    rows = t("policy_events").where("event_id is not null").groupBy("event_id", "authority").agg(F.max("access_ts").alias("seen"))
    return D.diverse(rows, "authority", [F.desc_nulls_last("seen"), F.asc("event_id")]).select("event_id", "authority")


@query("select distinct event_id from policy_events where event_id in (select event_id from documents where length(clean_text) >= 500) order by event_id")
def cohort_ids(t, _):
    cohort = t("documents").where(F.length("clean_text") >= 500).select("event_id")
    return t("policy_events").select("event_id").join(cohort, "event_id", "left_semi").distinct().orderBy("event_id")


@query("select authority, count(*) n from policy_events where access_ts >= timestamptz '2024-06-01 00:00:00+00' group by 1")
def sql_passthrough(t, spark):
    return spark.sql("select authority, count(*) n from {events} where access_ts >= timestamp '2024-06-01' group by 1", events=t("policy_events"))
