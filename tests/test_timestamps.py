from docflux.functions.instants import parse_instant
from docflux.operators.timestamps import TimestampDictionary, event_instants, normalize_timestamps

ZONES = [("A", "Asia/Singapore", "dmy", "SGT"), ("B", "America/New_York", "mdy", "EST/EDT")]


def authorities(spark):
    return spark.createDataFrame(ZONES, "authority string, zone_id string, date_order string, zone_abbr string")


def test_rows_keep_their_number_and_columns(spark, tmp_path):
    rows = [("A", "8-3-2024", "x"), ("B", "8-3-2024", None), ("A", "8-3-2024", "x"), (None, "2024-01-01T00:00:00Z", "y"), ("C", "2024-01-01", "z"), ("A", None, "n"), ("A", "TBA", "t")]
    df = spark.createDataFrame(rows, "authority string, pub_date string, raw string")  # raw clashes with the dictionary's column
    out = normalize_timestamps(df, "pub_date", authorities(spark), TimestampDictionary(spark, str(tmp_path)))
    zones = {a: z for a, *z in ZONES}
    got = sorted(map(tuple, out.collect()), key=repr)
    assert got == sorted([(a, d, r, parse_instant(d, *zones.get(a, (None, None, None)))) for a, d, r in rows], key=repr)
    assert out.columns == ["authority", "pub_date", "raw", "utc_us"]


def test_dictionary_grows_by_new_values_only(spark, tmp_path):
    book = TimestampDictionary(spark, str(tmp_path))
    values = lambda *raw: spark.createDataFrame([(r, "Asia/Singapore", "dmy", None) for r in raw], "raw string, zone_id string, date_order string, zone_abbr string")
    assert book.update(values("2024-01-01", "2024-01-01", "TBA", None)).count() == 2
    assert book.update(values("2024-01-01", "TBA", "2024-01-02")).count() == 3
    assert book.update(values("2024-01-01")).count() == 3


def test_events_are_reported_once(spark):
    rows = [("e1", "A", "8-3-2024"), ("e1", "A", "8 March 2024"), ("e2", "A", None), ("e3", "A", "n.d."), (None, "A", "8-3-2024"), ("e4", "A", "2024-03-08T00:00:00+08:00")]
    events = spark.createDataFrame(rows, "event_id string, authority string, pub_date string")
    at = parse_instant("8-3-2024", *ZONES[0][1:])
    assert sorted(map(tuple, event_instants(events, authorities(spark)).collect())) == [("e1", at), ("e4", at)]


def test_empty_tables(spark):
    events = spark.createDataFrame([], "event_id string, authority string, pub_date string")
    assert event_instants(events, authorities(spark)).count() == 0
    assert event_instants(spark.createDataFrame([("e", "A", "2024-01-01")], events.schema), authorities(spark).limit(0)).count() == 0


def test_later_runs_find_the_dictionary(spark):
    first, raw = TimestampDictionary(spark), "1999-12-31 23:59:41"
    values = spark.createDataFrame([(raw, "Asia/Singapore", "dmy", None)], "raw string, zone_id string, date_order string, zone_abbr string")
    first.update(values)
    again = TimestampDictionary(spark)
    assert again.read().where(f"raw = '{raw}'").count() == 1
    first.read().where(f"raw = '{raw}'").write.mode("append").parquet(str(again.path))  # as two runs at once may
    rows = spark.createDataFrame([("A", raw)], "authority string, pub_date string")
    zones = spark.createDataFrame([("A", "Asia/Singapore", "dmy", None)], "authority string, zone_id string, date_order string, zone_abbr string")
    assert normalize_timestamps(rows, "pub_date", zones, again).count() == 1


def test_a_second_run_parses_nothing(spark, tmp_path):
    book = TimestampDictionary(spark, str(tmp_path / "book"))
    rows = [("2024-01-01", *ZONES[0][1:]), ("1 May 2024", *ZONES[0][1:]), ("TBA", *ZONES[0][1:])]
    df = spark.createDataFrame(rows, "raw string, zone_id string, date_order string, zone_abbr string")
    book.update(df)
    parsed = spark.read.parquet(book.path).count()
    book.update(df)
    assert parsed == 3 and spark.read.parquet(book.path).count() == parsed
