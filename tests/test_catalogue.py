"""Chunkers, markup measures, discovery, chains, samplers, searches and configuration against small fixtures and brute force."""

import json
import math
import random
import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from docflux.functions import text as T
from docflux.operators import coverage, discovery, merge, quality, selection, telemetry
from docflux.queries import incremental, inventory, reference
from docflux.session import shared_dir
from docflux.sources import config, tables, writers
from tests.oracle import DATA
from tests.test_operators import one


# ------------------------------------------------------------------ text
@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 18, 19, 20, 28, 29, 100])
def test_token_chunks(spark, n):
    words = [f"w{i} " for i in range(n)]
    want, i = [], 0
    while True:
        want.append("".join(words[i : i + 10]))
        if i + 10 >= n:
            break
        i += 9
    got = one(spark, T.token_chunks(F.col("t"), 10, 0.1), t="".join(words))
    assert [c["chunk"] for c in got] == want and [c["chunk_index"] for c in got] == list(range(len(want)))


def test_token_chunks_limits(spark):
    assert one(spark, T.token_chunks(F.col("t")), t=None) is None
    assert one(spark, T.token_chunks(F.col("t")), t=" \n ")[0]["chunk"] == " \n "
    with pytest.raises(ValueError):
        T.token_chunks(F.col("t"), 1, 1.0)


def test_published_time(spark):
    meta = "<meta property='article:published_time' content='2024-05-01T10:00:00+07:00'>"
    pub, stamp = '<meta name="pubdate" content="2024-04-01T00:00:00Z">', '<time class="x" datetime="2024-03-01T00:00:00Z">'
    us = lambda h: one(spark, F.unix_micros(T.published_time(F.col("h"))), h=h)
    at = lambda *x: int(datetime(*x, tzinfo=timezone.utc).timestamp() * 1e6)
    assert us(stamp + pub + meta) == at(2024, 5, 1, 3)
    assert us(stamp + pub) == at(2024, 4, 1) and us(stamp) == at(2024, 3, 1)
    assert us(meta.replace("2024-05-01T", "soon ") + pub) is None and us("") is None and us(None) is None


@pytest.mark.parametrize("raw, want", [("2024-05-01T10:00:00+07:00", (2024, 5, 1, 3)), ("2024-05-01T10:00:00+0700", (2024, 5, 1, 3)), ("2024-05-01T10:00:00Z", (2024, 5, 1, 10)), ("2024-05-01T10:00:00", (2024, 5, 1, 10)), ("2024-05-01 10:00:00", (2024, 5, 1, 10)), ("2024-05-01", (2024, 5, 1)), ("1 May 2024", None), ("2024-13-01", None), (None, None)])
def test_metadata_time(spark, raw, want):
    assert one(spark, F.unix_micros(T.metadata_time(F.col("t"))), t=raw) == (want and int(datetime(*want, tzinfo=timezone.utc).timestamp() * 1e6))


def test_metadata_url(spark):
    url = lambda item: one(spark, T.metadata_url(F.col("j")), j=json.dumps(item))
    assert url({"metadata": {"sourceURL": "a", "ogUrl": "b"}, "url": "d"}) == "a"
    assert url({"metadata": {"sourceURL": "", "url": "c"}, "url": "d"}) == "c"
    assert url({"url": "d"}) == "d" and url({}) is None


def test_shares(spark):
    html = "<p>abcd</p><ul><li>one</li></ul><a href='x'>link text</a>"
    solid = len(re.sub(r"\s", "", html))
    assert one(spark, T.html_link_share(F.col("h")), h=html) == pytest.approx((len("<li>one</li>") + len("linktext")) / solid)
    md = "- a b\n[text](http://x)\nplain words"
    assert one(spark, T.markdown_link_share(F.col("m")), m=md) == pytest.approx((len("-ab") + len("text")) / len(re.sub(r"\s", "", md)))
    assert [one(spark, f(F.col("m")), m=" \n") for f in (T.html_link_share, T.markdown_link_share)] == [0.0, 0.0]


def test_small_functions(spark):
    assert one(spark, T.strip_markup(F.col("h")), h="<style>x</style><p>co-\noperative <b>step</b></p>") == "co- operative step"
    assert one(spark, T.text_links(F.col("t")), t="[a](https://x/1) and https://x/2, [b](https://x/1)") == ["https://x/1", "https://x/2,"]
    assert one(spark, T.base_url(F.col("u")), u="https://a.example/x?y") == "https://a.example" and one(spark, T.base_url(F.col("u")), u="no url") is None
    assert one(spark, T.lead_sentences(F.col("t"), F.col("l")), t="A. B! C? D. E. F.", l="en-SG") == "A. B! C?"
    assert one(spark, T.lead_sentences(F.col("t"), F.col("l")), t="A. B! C? D. E. F.", l="th") == "A. B! C? D. E."
    assert one(spark, T.percentage_points(F.lit(80.0), F.lit(76.8)), x="") == "+3.20"
    back = spark.sql("select array(cast(0.1 as float), cast(-2 as float)) v").select("v", T.vector_of(T.vector_text(F.col("v"))).alias("b")).head()
    assert back["v"] == back["b"]


# ------------------------------------------------------------------ discovery
def test_links(spark):
    html = "<a href='/news/1'>x</a><a class=c href=\"/news/1\">y</a><a href='news/2'>rel</a><a href='https://o/press'>z</a><a href='/about'>q</a><a href='#news'>q</a><a href='javascript:news()'>q</a>"
    both = lambda f, **k: one(spark, f(F.col("b"), F.col("h"), **k), b="https://a.example/x/y", h=html)
    assert both(discovery.listing_links) == ["https://a.example/news/1", "https://o/press"]
    assert both(discovery.listing_links, most=1) == ["https://a.example/news/1"]
    assert both(discovery.landing_links) == ["https://a.example/news/1", "https://a.example/x/news/2", "https://o/press"]
    assert both(discovery.landing_links, most=2) == ["https://a.example/news/1"]  # repeats count before they are dropped


def test_markers_policies_and_lastmod(spark):
    assert one(spark, discovery.first_marker(F.col("x"), [("A", ["aa"]), ("B", ["a", "b"])]), x="BaA") == "A"
    assert one(spark, discovery.first_marker(F.col("x"), [("A", ["aa"])]), x=None) is None
    mode, wait = discovery.fetch_policy(F.col("x"), [(["a"], "stealth", 9)], ("auto", 2))
    assert [(one(spark, mode, x=v), one(spark, wait, x=v)) for v in ("A", "b", None)] == [("stealth", 9), ("auto", 2), ("auto", 2)]
    rows = spark.createDataFrame([(1, None), (2, datetime(2024, 1, 30)), (3, datetime(2023, 1, 1))], "id int, at timestamp")
    assert [r["id"] for r in discovery.since_lastmod(rows, "at", "2024-02-01 00:00:00", 7).orderBy("id").collect()] == [1, 2]
    assert discovery.since_lastmod(rows, "at", "2024-02-01 00:00:00", 0).count() == 3


def test_diverse(spark):
    rows = spark.createDataFrame([(g, i) for g in "abc" for i in range(10)] + [(None, 1)], "g string, n int")
    got = [tuple(r) for r in discovery.diverse(rows, "g", [F.asc("n")], each=4, most=10).collect()]
    assert got == [(None, 1)] + [(g, i) for g in "abc" for i in range(2)]
    assert discovery.diverse(rows.limit(0), "g", [F.asc("n")]).count() == 0


# ------------------------------------------------------------------ merges
def test_get_or_create_and_backfill(spark):
    target = spark.createDataFrame([("u", "h1"), ("u", None)], "url string, hash string")
    source = spark.createDataFrame([("u", "h1"), ("u", "h1"), ("u", "h2"), (None, "h")], "url string, hash string")
    once = merge.get_or_create(target, source, ["url", "hash"])
    assert sorted(map(tuple, once.collect())) == [("u", "h1", "found"), ("u", "h2", "created")]
    again = merge.get_or_create(target.unionByName(once.where("outcome = 'created'").drop("outcome")), source, ["url", "hash"])
    assert again.where("outcome = 'created'").count() == 0
    events = spark.createDataFrame([("a", "u1"), ("b", "u2"), ("c", "u1"), (None, "u1"), ("d", None)], "event_id string, url string")
    day = datetime(2024, 1, 1)
    docs = spark.createDataFrame([(1, "a", "u9", day, "x" * 400), (2, "z", "u1", day, "y" * 400), (3, "z", "u1", day + timedelta(1), "y" * 399), (4, "z", "u1", None, "y" * 500), (5, "z", "u1", day, "y" * 400)], "doc_id bigint, event_id string, source_url string, created_at timestamp, clean_text string")
    assert sorted(map(tuple, merge.link_backfill(events, docs).collect())) == [("c", 2)]


# ------------------------------------------------------------------ selection
def test_sampler_reads_few_texts(spark):
    plan = selection.sampler(tables.table(spark, f"{DATA}/sf0.001", "policy_events"), tables.table(spark, f"{DATA}/sf0.001", "documents"), "2025-10-01 00:00:00", 604800, 200)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("GlobalLimit") < plan.rindex("LeftSemi") or "LeftSemi" in plan
    assert "min_by(clean_text" not in plan and "left(clean_text" in plan or "substring(clean_text" in plan


def test_only_coarse_totals_meet_in_one_task(spark):
    df = spark.range(5000).withColumn("size", F.lit(1))
    plan = selection.capped_prefix(df, "id", F.col("size"), 10, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1


def test_summary_requests(spark):
    rows = spark.createDataFrame([("e1", "x" * 60), ("e2", "short")], "k string, t string")
    lines = [json.loads(r["line"]) for r in selection.summary_requests(rows, F.col("k"), F.col("t"), "m", "Be brief.").collect()]
    assert lines == [{"custom_id": "sum:e1", "method": "POST", "url": "/v1/chat/completions", "body": {"model": "m", "temperature": 0, "max_tokens": 180, "messages": [{"role": "system", "content": "Be brief."}, {"role": "user", "content": "x" * 60}]}}]


def test_filters_and_lookback(spark):
    rows = spark.createDataFrame([("A", "x", datetime(2024, 1, 1)), ("B", "y", datetime(2024, 2, 1)), (None, None, None)], "authority string, policy_area string, access_ts timestamp")
    assert selection.filter_events(rows).count() == 3
    assert selection.filter_events(rows, ["A"]).count() == 1 and selection.filter_events(rows, since="2024-01-15", areas=["y"]).count() == 1
    assert selection.lookback(hours=2) == 7200 and selection.lookback(days=1) == 86400
    for wrong in ({}, {"hours": 1, "days": 1}):
        with pytest.raises(ValueError):
            selection.lookback(**wrong)


def test_classify(spark):
    rules = [("A", "area", 0, "first", ["zz"]), ("A", "area", 1, "second", ["Bank"]), ("A", "area", 2, "third", ["bank"]), ("A", "act", 0, "told", ["notice"])]
    rules = spark.createDataFrame(rules, "authority string, kind string, ord int, name string, keywords array<string>")
    rows = spark.createDataFrame([(1, "a", "a BANK notice"), (2, "A", "nothing"), (3, "B", "bank"), (4, None, None)], "id int, authority string, t string")
    got = {(r["id"], r["kind"]): r["name"] for r in selection.classify(rows, F.col("authority"), F.col("t"), rules, ["id"]).collect()}
    assert got == {(1, "area"): "second", (1, "act"): "told"} | {(i, k): "other" for i in (2, 3, 4) for k in ("area", "act")}


@pytest.mark.parametrize("block", [selection.QUERY_BLOCK, 200])
def test_knn_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(selection, "QUERY_BLOCK", block)
    rng = random.Random(2)
    vectors = {i: [rng.gauss(0, 1) for _ in range(4)] for i in range(60)}
    df = spark.createDataFrame(list(vectors.items()), "id bigint, v array<float>")
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / math.hypot(*a) / math.hypot(*b)
    got = {(r["query"], r["rank"]): r["neighbour"] for r in selection.knn(df, df.where("id % 10 = 0"), "id", "v", 3).collect()}
    for q in range(0, 60, 10):
        best = sorted((i for i in vectors if i != q), key=lambda i: -cos(vectors[q], vectors[i]))[:3]
        assert [got[q, r] for r in (1, 2, 3)] == best


# ------------------------------------------------------------------ telemetry, coverage, quality
def test_failures_in_order_of_arrival(spark, tmp_path):
    errors = [("d", "u1", "500", ""), ("d", "u2", "500", "second"), ("e", "u3", "500", "other"), ("d", "u4", "ok", "fine")]
    calls = [("A", "https://e/x", "http", "429", 1, "auto", None, "later"), ("A", "https://f/x", "http", "200", 1, "auto", None, "n")]
    spark.createDataFrame(errors, "domain string, url string, status string, error string").coalesce(1).write.parquet(str(tmp_path / "fc_errors.parquet"))
    spark.createDataFrame(calls, "authority string, url string, provider string, status_code_or_error string, wait_ms int, proxy_mode string, ts timestamp, notes string").coalesce(1).write.parquet(str(tmp_path / "provider_events.parquet"))
    logs = [tables.arrival(spark, str(tmp_path), n) for n in ("provider_events", "fc_errors")]
    got = [tuple(r) for r in telemetry.top_failing_domains(telemetry.failures(*logs), 5).collect()]
    assert got == [("d", 2, "second", "u2"), ("e", 2, "other", "u3")]


def test_sliding_counts(spark):
    rows = spark.createDataFrame([("A", datetime(2024, 1, d)) for d in (1, 1, 3)] + [("A", None)], "authority string, ts timestamp")
    got = {r["last_day"].day: r["n"] for r in coverage.sliding_counts(rows, "ts", 2).collect()}
    assert got == {1: 2, 2: 2, 3: 1, 4: 1}


def test_overall(spark):
    checks = spark.createDataFrame([("a", 0, True), ("b", 2, False)], "check string, value int, ok boolean")
    assert tuple(quality.overall(checks).head()) == (2, 1, False)
    assert tuple(quality.overall(checks.limit(0)).head()) == (0, 0, True)


def test_markdown_gate(spark):
    long = "Plain words of a notice. " * 40
    rows = [(1, "t", "u", long), (2, "t", None, ""), (3, "404", "u", "- item of a list\n" * 60), (4, "t", "u", "กขค " * 400), (5, "t", "u", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, title string, source_url string, raw_text string")
    got = {r["doc_id"]: r["reasons"] for r in quality.markdown_gate(df).collect()}
    assert got == {1: "", 2: "no_markdown;too_short;no_url;non_english", 3: "not_found;link_farm", 4: "non_english", 5: "no_markdown;too_short;non_english"}


# ------------------------------------------------------------------ configuration, snapshots, logs
def test_config(spark, tmp_path):
    (tmp_path / "seed.json").write_text(json.dumps({"startUrls": ["https://b", "https://a"]}))
    assert [tuple(r) for r in config.start_urls(spark, str(tmp_path / "seed.json")).orderBy("position").collect()] == [("https://b", 0), ("https://a", 1)]
    assert config.read_config(str(tmp_path / "seed.json"))["startUrls"][0] == "https://b"
    listed = config.source_list(spark, {"one": [{"name": "n", "url": "u"}, "odd"], "two": None})
    assert [tuple(r) for r in listed.collect()] == [("one", "n", "u")]
    rules = config.alert_rules(spark, [{"name": "r", "authorities": ["ab"], "match": ["Key"]}, {"name": "q", "authorities": [], "match": ["x"]}, {"authorities": ["a"], "match": ["x"]}])
    assert [tuple(r) for r in rules.collect()] == [("r", ["AB"], ["key"])]
    classes = config.classifier_rules(spark, {"A": {"area": [{"name": "x", "keywords": ["k"]}, {"name": "y"}]}, "B": None})
    assert sorted(map(tuple, classes.collect())) == [("A", "area", 0, "x", ["k"]), ("A", "area", 1, "y", [])]
    feeds = [{"authority": "A", "feed": "f", "enabled": True}, {"authority": "B", "feed": "g"}, {"feed": "h", "enabled": True}]
    assert [tuple(r) for r in config.feed_overrides(spark, feeds).collect()] == [("A", "f")]
    assert [tuple(r) for r in config.feed_overrides(spark, {"C": {"feed": "i", "enabled": True}, "D": 1}).collect()] == [("C", "i")]
    assert config.table_columns(spark, {"f": listed}).where("position = 1").head()["column"] == "name"


def test_snapshots_logs_and_reports(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), (None, 2)], "x string, n bigint")
    writers.export_snapshot(rows, str(tmp_path / "s"))
    assert sorted(map(tuple, config.snapshot(spark, str(tmp_path / "s"), "x string, n bigint").collect()), key=repr) == [("a", 1), (None, 2)] or spark.read.schema("x string, n bigint").json(str(tmp_path / "s")).count() == 2
    for kind in ("csv", "json", "parquet"):
        for _ in range(2):
            writers.append_log(rows, str(tmp_path / kind), kind)
        read = spark.read.schema("x string, n bigint")
        assert (read.option("header", True) if kind == "csv" else read).format(kind).load(str(tmp_path / kind)).count() == 4
    (tmp_path / "old.txt").write_text("1")
    (tmp_path / "new.txt").write_text("2")
    import os

    os.utime(tmp_path / "old.txt", (1, 1))
    assert config.newest_file(spark, f"{tmp_path}/*.txt").endswith("new.txt")
    with pytest.raises(ValueError):
        writers.markdown(spark.range(5), most=4)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Elsewhere:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(lambda: Elsewhere.conf)

    with pytest.raises(ValueError):
        shared_dir(Elsewhere, "x")


def test_runs_can_be_cleared(spark):
    from docflux.session import clear_runs, materialize

    df = materialize(spark.range(3).toDF("id"), "t")
    assert df.count() == 3
    clear_runs(spark)
    with pytest.raises(Exception, match="(?i)does ?n.t exist|not.exist|FILE_NOT_EXIST"):
        spark.read.schema("id bigint").parquet(df.inputFiles()[0]).count()


def test_registered_once():
    names = [n for m in (reference, inventory, incremental) for n in m.QUERIES]
    assert len(names) == len(set(names))
