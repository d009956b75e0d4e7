from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docflux.functions.instants import parse_instant

SG = ("Asia/Singapore", "dmy", "SGT")
NY = ("America/New_York", "mdy", "EST/EDT")
BE = ("Europe/Brussels", "dmy", "CET/CEST")


def us(*args):
    return (datetime(*args, tzinfo=timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


@pytest.mark.parametrize(
    "raw, where, want",
    [
        ("2024-05-06T01:51:59Z", SG, us(2024, 5, 6, 1, 51, 59)),
        ("2024-05-06t01:51:59z", SG, us(2024, 5, 6, 1, 51, 59)),
        ("2023-03-01T10:42:30.663939213Z", SG, us(2023, 3, 1, 10, 42, 30, 663939)),
        ("8-3-2024", SG, us(2024, 3, 7, 16)),
        ("8-3-2024", NY, us(2024, 8, 3, 4)),
        ("January 20, 2024", SG, us(2024, 1, 19, 16)),
        ("Tue, 05 Sep 2023 00:02:40 GMT", SG, us(2023, 9, 5, 0, 2, 40)),
        ("Posted on 4 May 2023 - 22:08", SG, us(2023, 5, 4, 14, 8)),
        ("13 Jul 2025, 5:01am", SG, us(2025, 7, 12, 21, 1)),
        ("14 Jun 2024, 12.20 a.m.", BE, us(2024, 6, 13, 22, 20)),
        ("26 Mar 2022, 23:35 GMT+1", BE, us(2022, 3, 26, 22, 35)),
        ("22 May 2025, 15:12 GMT+6:30", SG, us(2025, 5, 22, 8, 42)),
        ("๑๔ ตุลาคม พ.ศ. ๒๕๖๗, 01:50", ("Asia/Bangkok", "dmy", "ICT"), us(2024, 10, 13, 18, 50)),
        ("10 tháng 9 năm 2022", ("Asia/Ho_Chi_Minh", "dmy", "ICT"), us(2022, 9, 9, 17)),
        ("Ika-3 ng Marso 2024", ("Asia/Manila", "mdy", "PHT"), us(2024, 3, 2, 16)),
        ("1712635433", SG, 1712635433 * 10**6),
        ("1757205914.25", SG, 1757205914_250000),
        ("1672335247000", SG, 1672335247 * 10**6),
        ("1683455321048108", SG, 1683455321048108),
        ("20240302", SG, us(2024, 3, 1, 16)),
        ("20220711T135932Z", SG, us(2022, 7, 11, 13, 59, 32)),
        ("2024-09-19 14:31:41 America/Los_Angeles", SG, us(2024, 9, 19, 21, 31, 41)),
        ("2022-04-03T17:38:45+01:00[Europe/London]", SG, us(2022, 4, 3, 16, 38, 45)),
        ("2023-10-29 02:30:00", BE, us(2023, 10, 29, 0, 30)),  # twice: the earlier
        ("2023-03-26 02:30:00", BE, us(2023, 3, 26, 1, 30)),  # skipped: the offset before
        ("2023-07-01 10:00 CET", BE, us(2023, 7, 1, 9)),
        ("2023-07-01 10:00 CEST", BE, us(2023, 7, 1, 8)),
    ],
)
def test_spellings(raw, where, want):
    assert parse_instant(raw, *where) == want


@pytest.mark.parametrize("raw", [None, "", "TBA", "2025", "Q4 2023", "mid-July", "3 hours ago", "30 February 2025", "2025-06-31T08:15:00Z", "2025-04-17T25:10:00+08:00", "2025-00-14", "31/11/2025", "October 2022", "see document", "2024-01-01 10:00 XYZ", "3-5 May 2023", "13:05 PM"])
def test_no_instant(raw):
    assert parse_instant(raw, *SG) is None


def test_without_a_zone_only_zoned_values_count():
    assert parse_instant("2024-01-01 10:00") is None
    assert parse_instant("2024-01-01 10:00+08") == us(2024, 1, 1, 2)


@settings(max_examples=150, deadline=None)
@given(st.datetimes(datetime(2001, 1, 1), datetime(2039, 1, 1)), st.sampled_from(["Asia/Singapore", "Europe/Berlin", "America/New_York", "Australia/Sydney", "Asia/Yangon"]), st.sampled_from(["%Y-%m-%dT%H:%M:%S", "%Y/%m/%d %H:%M:%S", "%d %B %Y %H:%M:%S", "%B %d, %Y, %H:%M:%S", "%a, %d %b %Y %H:%M:%S"]))
def test_local_times_round_trip(moment, zone, form):
    moment = moment.replace(microsecond=0)
    local = moment.replace(tzinfo=ZoneInfo(zone))
    want = (local - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    assert parse_instant(moment.strftime(form), zone, "dmy", None) == want
    offset = local.strftime("%z")
    assert parse_instant(moment.strftime(form) + " " + offset, "Asia/Tokyo", "dmy", None) == want
