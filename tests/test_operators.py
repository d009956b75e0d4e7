import json
import random
from datetime import datetime, timedelta, timezone
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from docflux.functions import text as T
from docflux.operators import merge, quality, selection, telemetry
from docflux.plans import harvest
from docflux.sources import readers, writers
from docflux.streaming import telemetry as streaming


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'bigint'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column).head()[0]


# ------------------------------------------------------------------ text
@pytest.mark.parametrize("length, starts", [(0, [0]), (1, [0]), (1000, [0]), (1200, [0, 1000]), (3000, [0, 1000, 2000])])
def test_char_chunks(spark, length, starts):
    got = one(spark, T.char_chunks(F.col("t")), t="a" * length)
    assert [c["chunk_index"] for c in got] == list(range(len(starts)))
    assert [len(c["chunk"]) for c in got] == [min(1200, length - s) for s in starts]


def test_char_chunks_limits(spark):
    assert one(spark, T.char_chunks(F.col("t"), 2400, 400, keep_empty=False), t="") == []
    assert one(spark, T.char_chunks(F.col("t")), t=None) is None
    with pytest.raises(ValueError):
        T.char_chunks(F.col("t"), 100, 100)


@pytest.mark.parametrize("base, link, want", [("https://a.example/x/y", "/z", "https://a.example/z"), ("https://a.example/x/y", "z", "https://a.example/x/z"), ("https://a.example/x/", "//b.example/q", "https://b.example/q"), ("https://a.example/x", "https://c.example", "https://c.example"), ("https://a.example/x?q=1#f", "z", "https://a.example/z")])
def test_absolute(spark, base, link, want):
    assert one(spark, T.absolute(F.col("b"), F.col("l")), b=base, l=link) == want


def test_markup(spark):
    html = "<html><head><title> A title </title><style>p{}</style></head><body><script>x('</p>')</script><p>One co-\noperative  <b>step</b></p></body>"
    assert one(spark, T.strip_html(F.col("h")), h=html) == "A title One cooperative step"
    assert one(spark, T.title_of(F.col("h")), h=html) == "A title"
    assert one(spark, T.title_of(F.col("h")), h="no title") is None
    assert one(spark, T.ascii_ratio(F.col("h")), h="") == 0.0
    assert one(spark, T.not_found(F.col("a"), F.col("b")), a="404 Not Found", b="x") is True


# ------------------------------------------------------------------ merges
def test_upsert_is_idempotent_and_null_wins_only_where_told(spark):
    schema = "event_id string, title string, summary string"
    target = spark.createDataFrame([("a", "A", "s"), ("b", "B", "s")], schema)
    source = spark.createDataFrame([("b", None, None), ("c", "C", "t")], schema)
    once = merge.upsert(target, source, "event_id", ["summary"], ["title"])
    assert sorted(map(tuple, once.collect())) == [("a", "A", "s", "kept"), ("b", "B", None, "updated"), ("c", "C", "t", "inserted")]
    twice = merge.upsert(once.drop("outcome"), source, "event_id", ["summary"], ["title"])
    assert sorted(map(tuple, twice.drop("outcome").collect())) == sorted(map(tuple, once.drop("outcome").collect()))
    assert twice.where("outcome = 'inserted'").count() == 0


def test_insert_variant(spark):
    schema = "event_id string, source_url string"
    target = spark.createDataFrame([("x", "u1"), ("x", "u2#event=c")], schema)
    source = spark.createDataFrame([("a", "u1"), ("b", "u2"), ("c", "u2"), ("d", "u3"), (None, "u4"), ("e", None)], schema)
    assert sorted(map(tuple, merge.insert_variant(target, source).collect())) == [("a", "u1#event=a", True), ("b", "u2", False), ("d", "u3", False)]


def test_guarded_update(spark):
    target = spark.createDataFrame([("a", "v", None), ("b", "v", "m"), ("c", "v", "old"), ("d", "v", "m")], "k string, v string, model string")
    source = spark.createDataFrame([(k, "new", "m") for k in "abcz"], "k string, v string, model string")
    got = {r["k"]: (r["v"], r["outcome"]) for r in merge.guarded_update(target, source, "k", "v", "model").collect()}
    assert got == {"a": ("new", "upserted"), "b": ("v", "skipped"), "c": ("new", "upserted"), "d": ("v", "kept")}


# ------------------------------------------------------------------ windows against brute force
def test_longest_streaks(spark):
    rng = random.Random(3)
    begin = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(a, begin + timedelta(hours=i * 7), f"u{i}", rng.choice(["429", "429", "200"]) if rng.random() < 0.95 else None) for a in ("A", "B", None) for i in range(60)]
    df = spark.createDataFrame(rows, "authority string, ts timestamp, url string, status_code_or_error string")
    got = {r["authority"]: r["longest_run"] for r in telemetry.longest_streaks(df, "429").collect()}
    for a in ("A", "B", None):
        calls = [s for x, _, _, s in rows if x == a and s is not None]
        assert got[a] == max((len(list(g)) for s, g in groupby(calls) if s == "429"), default=0)


@pytest.mark.parametrize("max_rows, max_bytes", [(10, 10**9), (10**6, 3000), (1500, 60000), (1, 1), (10**6, 10**9)])
def test_capped_prefix(spark, max_rows, max_bytes):
    rng = random.Random(5)
    rows = [(i * 3, rng.randint(1, 90)) for i in range(2500)]
    want, n, b = [], 0, 0
    for k, size in rows:
        if n >= max_rows or b >= max_bytes:
            break
        want.append(k)
        n, b = n + 1, b + size
    df = spark.createDataFrame(rows, "k bigint, size bigint").repartition(4)
    assert sorted(r["k"] for r in selection.capped_prefix(df, "k", F.col("size"), max_rows, max_bytes).collect()) == want


def test_upper_median(spark):
    rng = random.Random(7)
    rows = [(g, rng.randint(0, 9)) for g in "ab" for _ in range(21 if g == "a" else 30)] + [("c", None)]
    got = {r["g"]: r["upper_median"] for r in quality.upper_median(spark.createDataFrame(rows, "g string, v bigint"), "g", F.col("v")).collect()}
    assert got == {g: sorted(v for x, v in rows if x == g)[len([1 for x, _ in rows if x == g]) // 2] for g in "ab"}


def test_adaptive_window(spark):
    rows = [(i, datetime(2024, 1, 31, tzinfo=timezone.utc) - timedelta(days=d)) for i, d in enumerate((5, 10, 20, 40))]
    df = spark.createDataFrame(rows, "id bigint, ts timestamp")
    got = telemetry.adaptive_window(df, "ts", "2024-01-31 00:00:00", (3, 7, 30))
    assert [tuple(r) for r in got.select("id", "window_days").collect()] == [(0, 7)]


def test_gate_reasons(spark):
    long = "Plain words of a notice. " * 40
    rows = [(1, "t", "u", long), (2, "t", "u", long), (3, None, "v", "short"), (4, "404 Not Found", "w", long), (5, "t", "x", "กขค " * 400), (6, "t", "y", ("- item of a list\n" * 60))]
    df = spark.createDataFrame(rows, "doc_id bigint, title string, source_url string, raw_text string")
    got = {r["doc_id"]: r["reasons"] for r in quality.gate_reasons(df).collect()}
    assert got == {1: "", 2: "dup_hash", 3: "thin", 4: "not_found", 5: "non_english", 6: "link_farm"}
    assert {r["doc_id"] for r in harvest.accepted_pages(df).collect()} == {1}


def test_gate_reasons_shuffles_no_text(spark):
    long = "Plain words of a notice. " * 40
    rows = [(3, "t", "u", long), (None, "t", "u", long), (2, "t", "u", long), (2, "t", "u", long), (2, "t", "u", long[:500]), (7, "T ", "u", long + "later"), (9, "t", None, long), (9, "t", None, long)]
    got = quality.gate_reasons(spark.createDataFrame(rows, "doc_id bigint, title string, source_url string, raw_text string"))
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    want = [(2, "dup_hash"), (2, "dup_hash"), (2, "thin;dup_hash"), (3, "dup_hash"), (7, "dup_hash"), (9, ""), (9, "dup_hash"), (None, "")]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


# ------------------------------------------------------------------ readers and writers
def test_batch_results(spark, tmp_path):
    body = lambda b: {"response": {"body": b}}
    lines = [json.dumps({"custom_id": "emb:d1:0"} | body({"data": [{"embedding": [1.0, 2.0]}]})), json.dumps({"custom_id": "emb:d2"} | body({})), json.dumps({"custom_id": "emb:d3:x"} | body({})), json.dumps({"custom_id": "emb:d4:1"} | body({"data": []})), json.dumps({"custom_id": "sum:e1"} | body({"choices": [{"message": {"content": "s"}}]})), "{broken", ""]
    (tmp_path / "r.jsonl").write_text("\n".join(lines))
    rows = readers.batch_results(spark, str(tmp_path)).collect()
    assert [(r["kind"], r["key"], r["error"]) for r in rows] == [("emb", "d1", None), (None, None, "bad_id"), (None, None, "bad_id"), ("emb", "d4", "no_embedding"), ("sum", "e1", None), (None, None, "bad_id")]


def test_feeds_and_sitemaps(spark):
    rss = "<rss><item><title>a</title><link>http://x/1</link></item><item><link>http://x/1</link></item></rss>"
    atom = "<feed><entry><link rel='alternate' href='http://x/2'/></entry></feed>"
    assert one(spark, readers.feed_links(F.col("f")), f=rss) == ["http://x/1"]
    assert one(spark, readers.feed_links(F.col("f")), f=atom) == ["http://x/2"]
    assert one(spark, readers.feed_links(F.col("f")), f='[{"link": "http://x/3"}, {"url": "http://x/4"}]') == ["http://x/3", "http://x/4"]
    assert one(spark, readers.feed_links(F.col("f")), f="none") == []
    got = one(spark, readers.sitemap_urls(F.col("x")), x="<urlset><url><loc> http://x/1 </loc><lastmod>2024-05-01</lastmod></url><ns:url><ns:loc>http://x/2</ns:loc><ns:lastmod>bad</ns:lastmod></ns:url></urlset>")
    assert [(g["url"], g["lastmod"] and g["lastmod"].day) for g in got] == [("http://x/1", 1), ("http://x/2", None)]
    assert one(spark, readers.page_links(F.col("h")), h="<a href='/a'>x</a><a class=c href=\"/b\">y</a><a href='#t'>z</a><a href='javascript:1'>q</a><a href='/a'>x</a>") == ["/a", "/b"]


def test_robots(spark):
    rules = spark.createDataFrame([("d", "/", True), ("d", "/private", False), ("d", "/private/open", True)], "domain string, prefix string, allow boolean")
    urls = spark.createDataFrame([("d", "/x"), ("d", "/private/y"), ("d", "/private/open/z"), ("e", "/private")], "domain string, path string")
    got = {(r["domain"], r["path"]): r["allowed"] for r in readers.robots_allowed(urls, rules).collect()}
    assert got == {("d", "/x"): True, ("d", "/private/y"): False, ("d", "/private/open/z"): True, ("e", "/private"): True}


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([("a|b", 1), (None, 2)], "x string, n bigint")
    writers.export_delimited(rows, str(tmp_path / "c"), sep="|")
    assert sorted(map(tuple, readers.delimited(spark, str(tmp_path / "c"), "x string, n bigint", sep="|").collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    writers.export_dataset(rows, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    assert writers.markdown(rows.orderBy("n")) == "| x | n |\n| --- | --- |\n| a\\|b | 1 |\n|  | 2 |"


# ------------------------------------------------------------------ streaming
def test_stream_restart_adds_nothing(spark, tmp_path):
    begin = datetime(2024, 1, 1, tzinfo=timezone.utc)
    schema = "authority string, url string, provider string, status_code_or_error string, ts timestamp"
    rows = [("A", f"u{i}", "p", "429" if i % 5 else "200", begin + timedelta(minutes=i)) for i in range(40)] * 2
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    read = lambda: streaming.read_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
    keys = ["authority", "url", "ts"]
    first = streaming.run_once(streaming.first_sight(read(), keys), "t", checkpoint=str(tmp_path / "out"))
    assert first.count() == 40
    assert streaming.run_once(streaming.first_sight(read(), keys), "t", checkpoint=str(tmp_path / "out")).count() == 40
    guard = streaming.run_once(streaming.rate_guard(read()), "g", "update", str(tmp_path / "guard")).collect()
    assert guard[0]["authority"] == "A" and guard[0]["longest"] >= 4 and guard[0]["action"] in ("pause", "trip")


def test_rate_guard_is_the_longest_streak(spark, tmp_path):
    rng = random.Random(11)
    begin = datetime(2024, 1, 1, tzinfo=timezone.utc)
    schema = "authority string, url string, provider string, status_code_or_error string, ts timestamp"
    rows = [(a, f"u{i}", "p", rng.choice(["429", "429", "429", "200", None]), begin + timedelta(hours=i * 5)) for i in range(90) for a in ("A", "B", None)]
    rows += [("late", "u", "p", "429", begin), (None, "u", "p", "429", None)]
    read = lambda: streaming.read_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
    for k, part in enumerate((rows[:100], rows[100:101], rows[101:])):  # days and runs go on across batches
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        got = {r["authority"]: r for r in streaming.run_once(streaming.rate_guard(read()), "g", "update", str(tmp_path / "out")).collect()}
    assert set(got) == {"A", "B", None, "late"}
    for a in got:
        calls = [s for x, _, _, s, t in rows if x == a and s is not None and t is not None]
        runs = [(s, len(list(g))) for s, g in groupby(calls)]
        assert got[a]["longest"] == max((n for s, n in runs if s == "429"), default=0)
        assert got[a]["run"] == (runs[-1][1] if runs[-1][0] == "429" else 0)
    again = streaming.run_once(streaming.rate_guard(read()), "g", "update", str(tmp_path / "out"))
    assert {r["authority"]: r for r in again.collect()} == got
