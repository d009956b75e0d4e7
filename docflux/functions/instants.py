"""Reading the many spellings of a publication time as one UTC instant.

``parse_instant`` is the helper that the timestamp dictionary applies once to each distinct spelling. It is strict: a
value counts only if the whole of it, but for a leading label, is one date with an optional time and zone.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

# Month names by language (en, id/ms, tl, fr, de, th, vi uses numbers), lower case.
MONTHS: dict[str, int] = {}
for _names in (
    "january february march april may june july august september october november december",
    "jan feb mar apr may jun jul aug sep oct nov dec",
    "januari februari maret april mei juni juli agustus september oktober november desember",
    "januari februari mac april mei jun julai ogos september oktober november disember",
    "jan peb mac apr mei jun jul ogos sept okt nop dis",
    "jan feb mar apr mei jun jul agt sep okt nov des",
    "jan feb mar apr mei jun jul agu sep okt nov dis",
    "jan feb mar apr mei jun jul ags sep okt nov des",
    "enero pebrero marso abril mayo hunyo hulyo agosto setyembre oktubre nobyembre disyembre",
    "ene peb mar abr may hun hul ago set okt nob dis",
    "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "janv févr mars avr mai juin juil août sept oct nov déc",
    "janvier fevrier mars avril mai juin juillet aout septembre octobre novembre decembre",
    "jan fév mar avr mai jui juil aoû sep oct nov déc",
    "januar februar märz april mai juni juli august september oktober november dezember",
    "jänner feber mrz apr mai jun jul aug sep okt nov dez",
    "jan feb mär apr mai juni juli aug sept okt nov dez",
    "januar februar maerz april mai juni juli august september oktober november dezember",
    "มกราคม กุมภาพันธ์ มีนาคม เมษายน พฤษภาคม มิถุนายน กรกฎาคม สิงหาคม กันยายน ตุลาคม พฤศจิกายน ธันวาคม",
    "ม.ค. ก.พ. มี.ค. เม.ย. พ.ค. มิ.ย. ก.ค. ส.ค. ก.ย. ต.ค. พ.ย. ธ.ค.",
):
    for _i, _n in enumerate(_names.split()):
        MONTHS.setdefault(_n, _i + 1)

# Hours east of UTC of zone abbreviations in general use; an authority's own abbreviations go first.
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "wet": 0, "bst": 1, "west": 1, "cet": 1, "cest": 2, "mez": 1, "mesz": 2, "eet": 2, "eest": 3, "msk": 3,
    "mmt": 6.5, "ict": 7, "wib": 7, "wita": 8, "sgt": 8, "myt": 8, "pht": 8, "pst8": 8, "bnt": 8, "hkt": 8, "awst": 8, "wit": 9, "jst": 9, "kst": 9,
    "acst": 9.5, "acdt": 10.5, "aest": 10, "aedt": 11, "nzst": 12, "nzdt": 13,
    "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7, "akst": -9, "akdt": -8, "hst": -10,
}

# Words that may stand before a date without changing it.
LABELS = (
    "published on|published at|published|posted on|posted at|posted|updated on|updated at|updated|last updated on|last updated|release date|released on|released|issued on|issued|"
    "date of issue|publication date|date published|date|dated|"
    "diterbitkan pada|diterbitkan|dipublikasikan pada|dipublikasikan|diunggah pada|diperbarui pada|diperbarui|tanggal|tarikh terbit|tarikh|dikemas kini pada|dikemas kini|disiarkan pada|disiarkan|dimuat naik pada|"
    "publié le|publie le|mis en ligne le|mis à jour le|mise à jour le|date de publication|le|veröffentlicht am|aktualisiert am|stand|datum|den|am|vom|"
    "ngày đăng|đăng ngày|cập nhật ngày|ngày|nai-post noong|inilathala noong|na-update noong|petsa|noong|เผยแพร่เมื่อ|เผยแพร่|ประกาศเมื่อ|ประกาศ|อัปเดต|ปรับปรุงเมื่อ|วันที่|เมื่อวันที่"
)
WEEKDAYS = (
    "monday|tuesday|wednesday|thursday|friday|saturday|sunday|mon|tues|tue|weds|wed|thurs|thur|thu|fri|sat|sun|"
    "senin|selasa|rabu|kamis|jumat|jum'at|sabtu|minggu|isnin|khamis|jumaat|ahad|lunes|martes|miyerkules|huwebes|biyernes|sabado|linggo|"
    "lundi|mardi|mercredi|jeudi|vendredi|samedi|dimanche|montag|dienstag|mittwoch|donnerstag|freitag|samstag|sonntag|mo|di|mi|do|fr|sa|so|"
    "วันจันทร์|วันอังคาร|วันพุธ|วันพฤหัสบดี|วันศุกร์|วันเสาร์|วันอาทิตย์|จันทร์|อังคาร|พุธ|พฤหัสบดี|ศุกร์|เสาร์|อาทิตย์|"
    "thứ hai|thứ ba|thứ tư|thứ năm|thứ sáu|thứ bảy|chủ nhật"
)
_THAI_DIGITS = str.maketrans("๐๑๒๓๔๕๖๗๘๙", "0123456789")
_MONTH = "|".join(sorted(map(re.escape, MONTHS), key=len, reverse=True))
_LEAD = re.compile(rf"\A(?:(?:{LABELS})(?:\s*:\s*|\s+))+", re.I)
_WEEKDAY = re.compile(rf"\A(?:{WEEKDAYS})\.?\s*,?\s+(?=\S)", re.I)

_DATES = [
    ("ymd", re.compile(r"(?P<y>\d{4})([-/.])(?P<m>\d{1,2})\2(?P<d>\d{1,2})")),
    ("ymd", re.compile(r"(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})(?=$|[t\s,])", re.I)),
    ("num", re.compile(r"(?P<a>\d{1,2})([-/.])(?P<b>\d{1,2})\2(?P<y>\d{4}|\d{2})(?!\d)")),
    ("dmy", re.compile(rf"(?:ika-?\s*)?(?P<d>\d{{1,2}})(?:st|nd|rd|th|er|\.)?(?:\s+(?:ng|of|de)\s+|[\s\-/]+)(?P<mon>{_MONTH})\.?[\s\-/,]+(?:พ\.\s?ศ\.\s*|ค\.\s?ศ\.\s*)?(?P<y>\d{{4}}|\d{{2}})(?!\d)", re.I)),
    ("mdy", re.compile(rf"(?P<mon>{_MONTH})\.?\s+(?P<d>\d{{1,2}})(?:st|nd|rd|th)?\s*,?\s+(?P<y>\d{{4}})(?!\d)", re.I)),
    ("dmy", re.compile(r"(?P<d>\d{1,2})\s+tháng\s+(?P<m>\d{1,2})\s*,?\s+(?:năm\s+)?(?P<y>\d{4})(?!\d)", re.I)),
    ("ymd", re.compile(rf"(?P<y>\d{{4}})[\s\-](?P<mon>{_MONTH})[\s\-](?P<d>\d{{1,2}})(?!\d)", re.I)),
]
_TIME = re.compile(
    r"(?:t|\s*,?\s+(?:at|à|um|pukul|jam|pada|lúc|alas|เวลา|-|–)\s+|\s*,\s*|\s+)"
    r"(?:(?P<h>\d{1,2})(?:(?P<sep>[:.h])(?P<mi>\d{2})(?:(?::|(?<=\.\d\d)\.)(?P<s>\d{2})(?:[.,](?P<f>\d+))?)?)?\s*(?P<ap>[ap]\.?\s?m(?![a-z])\.?)?"
    r"|(?P<ch>\d{2})(?P<cm>\d{2})(?P<cs>\d{2})?)"
    r"(?:\s*(?:uhr|น\.|hrs?\b))?(?![\d:])",
    re.I,
)
_ZONE = re.compile(
    r"\s*(?P<open>\()?(?P<name>(?:gmt|utc)(?=\s*[+\-−]\d))?\s*(?:(?P<sign>[+\-−])(?P<oh>\d{1,2})(?::?(?P<om>\d{2}))?(?::?\d{2})?|(?P<region>[a-z]+(?:/[a-z0-9_+\-]+)+)|(?P<abbr>[a-z]{1,5}))(?(open)\))"
    r"(?:\s*\[(?P<bracket>[a-z0-9_/+\-]+)\]|\s*\((?P<note>[a-z]{1,5})\))?",
    re.I,
)
_EPOCH = re.compile(r"(?P<i>\d{9,10}|\d{13}|\d{16}|\d{19})(?:\.(?P<f>\d+))?")
_UNIT = {9: 1_000_000, 10: 1_000_000, 13: 1_000, 16: 1, 19: 0}
_UTC0 = datetime(1970, 1, 1, tzinfo=timezone.utc)


@lru_cache(maxsize=512)
def _zone(name: str) -> ZoneInfo | None:
    try:
        return ZoneInfo(name)
    except (KeyError, ValueError, OSError):
        for known in _zone_names():
            if known.lower() == name.lower():
                return ZoneInfo(known)
        return None


@lru_cache(maxsize=1)
def _zone_names() -> frozenset[str]:
    from zoneinfo import available_timezones

    return frozenset(available_timezones())


def _abbreviation(abbr: str, zone_id: str | None, own: str | None, year: int) -> float | None:
    """Hours east of UTC; the authority's own pair (standard/summer) is read with the offsets of its zone in that year."""
    names = [x.strip().lower() for x in (own or "").split("/")]
    zone = _zone(zone_id) if zone_id else None
    if abbr in names and zone:
        both = sorted(datetime(year, m, 1, 12, tzinfo=zone).utcoffset() for m in (1, 7))
        return both[names.index(abbr) and -1].total_seconds() / 3600
    return ABBREVIATIONS.get(abbr)


def parse_instant(raw: str | None, zone_id: str | None = None, date_order: str | None = None, zone_abbr: str | None = None) -> int | None:
    """Microseconds since the epoch (UTC) of the instant that ``raw`` names, or None.

    A missing time is local midnight; without a zone the local time is one of ``zone_id`` (none without that either); a
    time that occurs twice is the earlier instant, a skipped one is read with the offset before the change. Digits beyond
    microseconds are dropped. Two-digit years are 20xx; years of the Buddhist era (from 2400) are put back by 543.
    """
    if raw is None:
        return None
    s = re.sub(r"[\s\u200b\u200e\u200f\ufeff]+", " ", raw.translate(_THAI_DIGITS)).strip()
    s = _LEAD.sub("", _WEEKDAY.sub("", _LEAD.sub("", s)))
    if m := _EPOCH.fullmatch(s):
        i, f = m["i"], m["f"] or ""
        unit = _UNIT[len(i)]
        return int(i) // 1000 if not unit else int(i) * unit + (int((f + "0" * 6)[:6]) * unit // 1_000_000 if f else 0)
    if re.fullmatch(r"\d{14}|\d{12}", s):
        s = f"{s[:8]}T{s[8:]}"
    for kind, pattern in _DATES:
        if not (m := pattern.match(s)):
            continue
        if kind == "num":
            if date_order == "mdy":
                month, day = int(m["a"]), int(m["b"])
            elif date_order in ("dmy", "ymd"):
                month, day = int(m["b"]), int(m["a"])
            else:
                continue
            if date_order == "ymd" and len(m["y"]) == 2:
                continue
        else:
            month = MONTHS[m["mon"].lower()] if "mon" in pattern.groupindex else int(m["m"])
            day = int(m["d"])
        year = int(m["y"]) + (2000 if len(m["y"]) == 2 else 0)
        year -= 543 if year >= 2400 else 0
        if (got := _finish(year, month, day, s[m.end():], zone_id, zone_abbr)) is not None:
            return got
    return None


def _finish(year: int, month: int, day: int, rest: str, zone_id: str | None, own: str | None) -> int | None:
    hour = minute = second = micro = 0
    if m := _TIME.match(rest):
        bare = m["h"] and not m["mi"] and not m["ap"]
        if not bare:
            rest = rest[m.end():]
            hour, minute, second = int(m["h"] or m["ch"]), int(m["mi"] or m["cm"] or 0), int(m["s"] or m["cs"] or 0)
            micro = int(((m["f"] or "") + "000000")[:6])
            if m["ap"]:
                if not 1 <= hour <= 12:
                    return None
                hour = hour % 12 + (12 if m["ap"][0] in "pP" else 0)
    rest = rest.rstrip(" .")
    offset, zone = None, zone_id
    if rest:
        if not (m := _ZONE.fullmatch(rest)):
            return None
        if m["sign"]:
            oh, om = int(m["oh"]), int(m["om"] or 0)
            if oh > 18 or om > 59:
                return None
            offset = (oh + om / 60) * (1 if m["sign"] == "+" else -1)
        elif m["region"]:
            zone = m["region"]
            if _zone(zone) is None:
                return None
        else:
            offset = _abbreviation(m["abbr"].lower(), zone_id, own, year)
            if offset is None:
                return None
    try:
        naive = datetime(year, month, day, hour, minute, second, micro)
    except ValueError:
        return None
    if offset is not None:
        moment = naive.replace(tzinfo=timezone(timedelta(hours=offset)))
    elif zone and (info := _zone(zone)):
        moment = naive.replace(tzinfo=info)
    else:
        return None
    return (moment - _UTC0) // timedelta(microseconds=1)
