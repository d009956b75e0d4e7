"""Personal information in free text: found as spans, scored, and replaced by typed placeholders.

Regular expressions propose spans of a kind with a base score. Validators (check letters, Luhn, mod 97, mod 11, dates
inside numbers) raise or lower it, and so do words shortly before and after; a span counts from THRESHOLD on. Of spans
that overlap the one of the higher score stays, then the longer, then the first. All else in the text is unchanged.

NULL and empty texts have no spans. Texts are read whole, one at a time; repeated rows give repeated results in
``redact`` and one row a distinct string in ``find_pii``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import date

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflux.session import spread

THRESHOLD = 2.0
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "person": "[PERSON]"}

# ---------------------------------------------------------------- e-mail
_AT = r"(?:\s?[@＠]\s?|\s*[\[(]\s*(?:at|AT)\s*[\])]\s*)"
_DOT = r"(?:\.|\s*[\[(]\s*(?:dot|DOT)\s*[\])]\s*)"
EMAIL = regex.compile(rf"(?<![\w.+%\-])[\p{{L}}\d](?:[\p{{L}}\d._%+\-]*[\p{{L}}\d_%+\-])?{_AT}[\p{{L}}\d](?:[\p{{L}}\d\-]*[\p{{L}}\d])?(?:{_DOT}[\p{{L}}\d](?:[\p{{L}}\d\-]*[\p{{L}}\d])?)*{_DOT}[\p{{L}}]{{2,}}(?![\p{{L}}\d])")

_EMAIL_HINT = re.compile(r"[@＠]|[\[(]\s*(?:at|AT)\s*[\])]")

# ---------------------------------------------------------------- phone
_EXT = r"(?:,?\s*(?:x|ext\.?|extn\.?|extension|ต่อ|poste|samb(?:ungan|\.)?|durchwahl|máy lẻ|loc(?:al|\.)?|ramal)\s*\d{1,5}(?!\d))?"
PHONE = regex.compile(
    rf"(?<![\w/.\-+@#])(?:\+\d{{1,3}}[ \-.]?(?:\(0\) ?)?(?:\(\d{{1,4}}\)[ \-.]?)?|\(\+?\d{{1,4}}\)[ \-.]?)?\d{{1,14}}(?:[ \-.]\d{{1,6}}){{0,5}}(?![\w]|[\-/.]\d){_EXT}",
    regex.I,
)
_PHONE_CUE = regex.compile(r"(?:tel|fax|phone|mobile|cell|call(?:er)?|ring|dial|hotline|hubungi|telepon|telefon|talian|nomor|telp|hp|điện thoại|số|โทร(?:ศัพท์)?|anschluss|fon|téléphone|joindre|numéro|tumawag|tawagan|telepono|contact|\bon|\bat|\bau|\bsa|\bdi|/|le)\b?[^\n\d]{0,42}$", regex.I)
_PHONE_NOT = regex.compile(r"(?:circular|licen[cs]e|reference|référence|psn|no\.|numbered|nombor rujukan|nomor registrasi|bernombor|surat nomor|công văn số|mit der nummer|aktenzeichen|numéro psn|avis numéro|bilang|ประกาศเลขที่|account|series|replaces|batch|form|version|isbn|page|fee of|cms-|nik|card)\W*$", regex.I)

# ---------------------------------------------------------------- identity numbers
_ID_FORMS = [
    ("sg", r"[STFGM]\d{7}[A-Z]", 2.0),
    ("passport", r"[A-Z]\d{8}", 1.0),
    ("de", r"[A-Z]\d{2}[A-Z0-9]\d{5}", 1.0),
    ("my", r"\d{6}-\d{2}-\d{4}", 2.0),
    ("card16", r"\d{4}-\d{4}-\d{4}-\d{4}|\d{4} \d{4} \d{4} \d{4}", 1.0),
    ("nik", r"\d{16}", 0.5),
    ("us", r"\d{3}-\d{2}-\d{4}", 2.0),
    ("th", r"\d-\d{4}-\d{5}-\d{2}-\d", 2.0),
    ("fr", r"[1-4] \d{2} \d{2} (?:\d{2}|2[AB]) \d{3} \d{3} \d{2}", 2.0),
    ("uk", r"[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D]", 2.0),
    ("digits", r"\d{12,13}", 0.0),
]
ID = regex.compile(r"(?<![\w.\-+/@])(?:" + "|".join(f"(?P<{n}>{p})" for n, p, _ in _ID_FORMS) + r")(?![\w@]|[\-/.]\d| ?\d)")
_ID_BASE = {n: s for n, _, s in _ID_FORMS}
_ID_CUE = regex.compile(r"(?:identi(?:ty|fication|té)|\bid\b|nric|passport|paspor|holder of|kad pengenalan|\bnik\b|ktp|căn cước|cccd|cmnd|ausweis|pagkakakilanlan|the file of|national insurance|social security|บัตรประชาชน|ประจำตัวประชาชน|ประจำตัว|หนังสือเดินทาง|berkas|fail bagi|dossier|hồ sơ|akte)\P{L}*(?:(?:number|no\.?|document|nummer|nombor|nomor|numéro|số|de|of)\P{L}*){0,2}$", regex.I)
_ID_NOT = regex.compile(r"(?:account|series|circular|licen[cs]e|reference|notice|company|registration|rekening|konto|compte|psn|invoice|batch)\P{L}*(?:(?:number|no\.?|series|of)\P{L}*){0,2}$", regex.I)


def luhn(digits: str) -> bool:
    """Whether the last digit is the Luhn check digit of the others."""
    d = [int(x) for x in reversed(digits)]
    return sum(d[0::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0


def sg_letter(s: str) -> bool:
    """The check letter of a Singapore identity or work-permit number."""
    total = sum(int(d) * w for d, w in zip(s[1:8], (2, 7, 6, 5, 4, 3, 2))) + {"S": 0, "F": 0, "T": 4, "G": 4, "M": 3}[s[0]]
    if s[0] == "M":
        return "KLJNPQRTUWX"[10 - total % 11] == s[8]
    return ("JZIHGFEDCBA" if s[0] in "ST" else "XWUTRQPNMLK")[total % 11] == s[8]


def mod97(s: str) -> bool:
    """The key of a French social-security number: 97 less the number modulo 97."""
    body = s.replace(" ", "").replace("2A", "19").replace("2B", "18")
    return body.isdigit() and 97 - int(body[:13]) % 97 == int(body[13:])


def mod11(digits: str) -> bool:
    """The check digit of a Thai identity number."""
    return (11 - sum(int(d) * (13 - i) for i, d in enumerate(digits[:12])) % 11) % 10 == int(digits[12])


def _is_date(day: str, month: str, year: str) -> bool:
    for century in (1900, 2000):
        try:
            date(century + int(year), int(month), int(day))
            return True
        except ValueError:
            pass
    return False


def valid_id(form: str, s: str) -> bool | None:
    """Whether a number of that form passes its check; None if the form has none."""
    digits = "".join(c for c in s if c.isdigit())
    if form == "sg":
        return sg_letter(s)
    if form == "my":
        return _is_date(digits[4:6], digits[2:4], digits[:2])
    if form == "nik" or (form == "card16" and digits[0] in "123"):
        day = int(digits[6:8])
        return _is_date(f"{day - 40 if day > 40 else day:02d}", digits[8:10], digits[10:12]) or None
    if form == "fr":
        return mod97(s)
    if form == "th":
        return mod11(digits)
    if form == "digits":
        return mod11(digits) if len(digits) == 13 else _is_date(digits[4:6], digits[2:4], digits[:2]) or None
    if form == "card16":
        return True if luhn(digits) else None
    return None


# ---------------------------------------------------------------- addresses
_W = r"\p{Lu}[\p{L}\p{M}'’\-]*"
_N = rf"{_W}(?: {_W}){{0,3}}"
_STREET = r"(?:Street|Road|Avenue|Drive|Lane|Terrace|Quay|Boulevard|Blvd\.?|Close|Crescent|Way|Row|Place|Square|Court|Walk|Hill|Park|Rise|View|Link|Grove|Parade|Highway|St\.|Rd\.?|Ave\.?|Dr\.|Ln\.?|STREET|ROAD|AVENUE|DRIVE|LANE|TERRACE|QUAY|BOULEVARD|BLVD\.?|CLOSE|CRESCENT|WAY|ROW|PLACE|SQUARE|COURT)"
_UNIT = r"(?:(?:Level|Unit|Suite|Floor|Apt\.?|Room|Flat|Lot|LEVEL|UNIT|SUITE|FLOOR|APT|FLAT|LOT) \w{1,5},? |(?:Blk|Block|BLK|BLOCK) )"
ADDRESSES = [
    # number, street, unit, town and code
    rf"{_UNIT}?\d{{1,5}}[A-Z]? {_N}? ?{_STREET}(?: #\d{{1,3}}-\d{{1,4}}[A-Z]?)?(?:, (?:#\d{{1,3}}-\d{{1,4}}[A-Z]?|(?:Suite|Apt\.?|Unit|Floor|Level|SUITE|APT\.?|UNIT) \w{{1,5}}))?, (?:S\(\d{{6}}\)|(?:Singapore|SINGAPORE) \d{{6}}|{_N}, [A-Z]{{2}} \d{{5}}(?:-\d{{4}})?|{_N},? [A-Z]{{1,2}}\d[A-Z\d]? ?\d[A-Z]{{2}}|{_N} \d{{4,6}})(?!\d)",
    rf"(?:Jl\.|Jalan|Jln\.?|Gang|Gg\.|JL\.|JALAN) {_N}(?: (?:No\.|Nomor|NO\.) ?\d{{1,4}}[A-Z]?)(?:, RT ?\d{{1,3}}/RW ?\d{{1,3}})?, {_N} \d{{5}}(?!\d)",
    rf"(?:(?:Lot|No\.?|LOT|NO\.?) )?\d{{1,4}}[A-Z]?, (?:Jalan|Lorong|Persiaran|Lebuh|Lebuhraya|Jln\.?|JALAN|LORONG|PERSIARAN|LEBUH) {_N}(?: \d{{1,2}}[A-Z]?(?:/\d{{1,2}}[A-Z]?)?)?, \d{{5}} {_N}",
    rf"(?:(?:Số|số|SỐ) )?\d{{1,4}}[A-Z]?(?:/\d{{1,4}})* (?:đường|phố|ĐƯỜNG|PHỐ) {_N}(?:, (?:phường|quận|huyện|xã|PHƯỜNG|QUẬN|HUYỆN|XÃ) (?:\d{{1,2}}|{_N}))*, (?:thành phố|tỉnh|TP\.?|THÀNH PHỐ|TỈNH) {_N}",
    r"\d{1,4}(?:/\d{1,4})? (?:ซอย[\p{L}\p{M}\d]+ )?ถนน[\p{L}\p{M}]+(?: [\p{L}\p{M}.ฯ]+){1,4} \d{5}(?!\d)",
    rf"\d{{1,4}}(?: ?(?:bis|ter|quater|BIS|TER))?,? (?:rue|avenue|boulevard|quai|place|impasse|chemin|allée|route|cours|square|RUE|AVENUE|BOULEVARD|QUAI|PLACE|IMPASSE|CHEMIN|ALLÉE) (?:(?:de la|de l['’]|du|des|de|d['’]|DE LA|DU|DES|DE) ?)?{_N}, \d{{5}} {_N}",
    rf"(?:{_W} )?\p{{Lu}}[\p{{L}}\-]*(?:straße|strasse|str\.|weg|gasse|platz|allee|ufer|damm|ring|steig|markt|graben|STRASSE|WEG|GASSE|PLATZ|ALLEE|UFER) \d{{1,4}}[a-z]?, \d{{5}} {_N}",
    rf"\d{{1,5}} {_N} (?:St\.|Street|Ave\.|Avenue|Rd\.|ST\.|AVE\.),? (?:Brgy\.|Barangay|BRGY\.) {_N}, (?:(?:Bayan|Lungsod|BAYAN|LUNGSOD) (?:ng|NG) )?{_N}(?: \d{{4}})?",
]
ADDRESS = regex.compile(r"(?<![\w/#\-])(?:" + "|".join(ADDRESSES) + r")")
_ADDRESS_HINT = re.compile(r"\d{4}|\d[A-Z\d]? ?\d[A-Z]{2}|thành phố|tỉnh|TỈNH|TP|Bayan|Lungsod|Brgy|Barangay|THÀNH PHỐ|BAYAN|LUNGSOD|BRGY")

# ---------------------------------------------------------------- persons
_T = r"(?:(?:[DdOL]['’])?\p{Lu}[\p{L}\p{M}'’]+(?:-\p{Lu}[\p{L}\p{M}'’]+)*|\p{Lu}\.)"
_PART = r"(?:bin|binti|bte|de los|de las|de la|del|dela|de|von|van|van der|zu|al|el|BIN|BINTI|DE LOS|DE LAS|DE LA|DEL|DELA|DE|VON|VAN)"
_LATIN = rf"(?:(?:{_PART} )?{_T}(?: {_T}){{0,2}}, {_T}(?: {_T}){{0,1}}|{_T}(?: (?:{_PART} )?{_T}){{1,4}}?)"
_THAI = r"[ก-๛]{2,} [ก-๛]{2,}"
_NAME = rf"(?P<name>{_LATIN}|{_THAI})"
# Titles that stand before a name, without being part of it.
_TITLES = r"Mr|Mrs|Ms|Miss|Mx|Dr|Prof|Professor|Sir|Madam|Dame|Datuk|Dato['’]|Datin|Tan Sri|Encik|Puan|Cik|Tuan|Tn|Ny|Bapak|Bpk|Ibu|Sdr|Saudara|Herr|Frau|Monsieur|Madame|Mme|Mlle|M|Maître|ông|bà|anh|chị|Ông|Bà|Ginoong|Ginang|Gng|G|Bb|Hon|Atty|Engr|MR|MRS|MS|DR|ENCIK|PUAN|CIK|HERR|FRAU|MME|ÔNG|BÀ"
# Frames: words before a name, and what must follow it.
_END = r"(?=\s*(?:[,.;:()<\[\n/|]|$)|\s+(?:\p{Ll}|(?:OF|GAVE|WAS|WHO|YANG|DENGAN|NOMBOR|DI|LAG|UNTER)\b|\+?\(?\d))"
_THAI_END = r"(?=\s+(?:โทร|อีเมล|เลข|ให้|ไม่|กล่าว)|\s*,)"
FRAMES = [
    (rf"\b(?:{_TITLES})\.? {_NAME}{_END}", 2.0),
    (rf"(?:คุณ|นาย|นางสาว|นาง|ดร\.|น\.ส\.) ?{_NAME}(?=\s|$|[,.(])", 2.0),
    (rf"(?i:according to|interview with|(?:witness )?statement (?:of|by)|testimony of|evidence of|letter (?:from|to)|meeting with) {_NAME}(?=\s*[,(])", 2.0),
    (rf"(?i:neither) {_NAME}(?=\s+(?i:nor)\b)", 2.0),
    (rf"(?i:held|lodged|filed|made|signed|submitted|sent|written|represented|drawn up) (?i:by) {_NAME}(?=\s*[,(<])", 2.0),
    (rf"(?i:shows?|states?|confirms?) (?i:that) {_NAME}(?=\s*\()", 2.0),
    (rf"\b(?i:contact|call|reach|ask for) {_NAME}(?=\s+(?i:on|at|via|by|under)\b)", 2.0),
    (rf"\b(?i:contact|attention|attn|kontak|kontakt|ansprechpartner|liên hệ)\s?: {_NAME}(?=\s*,)", 2.0),
    (rf"\b(?i:sent|posted|addressed|written|given|delivered) (?i:to) {_NAME}(?=\s+(?i:at|on|via)\b|\s*[,(])", 2.0),
    (rf"\b(?i:not from|came from) {_NAME}(?=\s*[.,])", 2.0),
    (rf"\b(?i:menurut|selon|theo|ayon kay|gemäß) {_NAME}(?=\s*,)", 2.0),
    (rf"\b(?i:oleh|kepada|hubungi|lanjut:) {_NAME}(?=\s*,|\s+(?i:dengan|melalui|di|yang|pada|nombor|nomor|telepon)\b)", 2.0),
    (rf"\b(?i:saudari|bernama|atas nama) {_NAME}{_END}", 2.0),
    (rf"\b(?i:ni|kay|kina|si|nina) {_NAME}(?=\s+(?i:na|sa|ng|ay)\b|\s*[,.])", 2.0),
    (rf"\b(?i:joindre|contacter|adressées? à|par|auprès de) {_NAME}(?=\s+(?i:au|à|par)\b|\s*[,(])", 2.0),
    (rf"\b(?i:laut) {_NAME}(?=\s+(?i:lag|liegt|hat|war|ist|wurde)\b|\s*,)", 2.0),
    (rf"\b(?i:beantwortet|erteilt|stammt von|an|von) {_NAME}(?=\s+(?i:unter|per|über)\b|\s*,)", 2.0),
    (rf"\b(?i:gửi tới|liên hệ|do|của) {_NAME}(?=\s+(?i:qua|tại|theo)\b|\s*,)", 2.0),
    (rf"(?:ผู้ร้องเรียนคือ|คำให้การของ|ตามที่|ติดต่อ|ส่งถึง|ที่) ?{_NAME}{_THAI_END}", 2.0),
]
_FRAMES = [(regex.compile(p), s) for p, s in FRAMES]
_NEAR = regex.compile(rf"(?:^|(?<=[\n;:(/]\s?)|(?<=[.!?] )){_NAME}(?=\s*[(</]|\s+(?:at|on|di|sa|au|unter|qua|via)\b)", regex.M)
# One quick look at a line decides whether its names are looked for: a word of some frame before what a name begins with.
_CAPITAL = rf"(?:[^\W\d_a-z]|d['’]|{_PART} (?:[^\W\d_a-z]|d['’]))"
_PERSON_HINT = re.compile(
    r"\b(?:" + _TITLES + r"|(?i:to|with|of|by|from|neither|that|contact|call|reach|for|attention|attn|kontakt?|ansprechpartner|menurut|selon|theo|kay|gemäß|oleh|kepada|hubungi|lanjut|saudari|bernama|nama|ni|kina|si|nina|joindre|contacter|à|par|de|laut|beantwortet|erteilt|von|an|tới|hệ|do|của))[.:]? :? ?"
    rf"{_CAPITAL}|คุณ|นาย|นาง|ดร\.|น\.ส\.|ผู้ร้องเรียนคือ|คำให้การของ|ตามที่|ติดต่อ|ส่งถึง|ที่ ?(?:{_THAI}{_THAI_END}|(?![ก-๛]){_CAPITAL})"
)
_DIGITS = re.compile(r"\d(?:\D{0,4}\d){3}")
# Words that make a capitalised name one of a firm, body, law, place or thing.
ORGANISATION = frozenset(
    "securities services service house co company pte ltd limited llp llc inc corp plc bank group holdings partners trust fund board agency authority bureau commission council committee office ministry department division unit team panel secretariat institute association forum society union centre center conseil amt autoriteit "
    "office bundesamt reichweitenamt cuc uy ban badan otoritas komisi kementerian direktorat lembaga suruhanjaya tabung jabatan lupon kagawaran act bill law code regulation accord agreement treaty convention circular notice licence license annex schedule bridge road street avenue management guidance circular "
    "payments remittance custody lending media relations the this our each every however data privacy consumer consumers industry review inspection policy licensing supervision a an in on at for of and is to from as firms operators responses members yang karena itu demikian urus setia sekretariat secretariat secrétariat kalihiman thư".split()
)


_LEADING_TITLE = regex.compile(rf"^(?:(?:{_TITLES})\.? +)+")
# Capitalised words that may follow a name and a comma.
AFTER_NAME = frozenset("telefon telephone telepon tel media ausweisnummer identity nombor nomor personalausweis geboren holder contact fax mobile".split())


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """The span of a name without a title before it or a noun after its comma."""
    name = text[start:end]
    if m := _LEADING_TITLE.match(name):
        start += m.end()
        name = text[start:end]
    head, comma, tail = name.partition(",")
    if comma and (not tail.split() or tail.split()[0].lower().strip(".") in AFTER_NAME):
        end = start + len(head)
    return start, end


def _person(line: str, start: int, end: int, base: float) -> tuple[int, int, str, float]:
    start, end = _trimmed(line, start, end)
    return start, end, "person", _person_score(line[start:end], base)


def _person_score(name: str, base: float) -> float:
    tokens = [t.strip(".,").lower() for t in name.split()]
    full = [t for t in tokens if len(t) > 1 and t not in ("bin", "binti", "de", "los", "la", "del", "von", "van", "zu")]
    if any(t in ORGANISATION for t in tokens) or not full or len(tokens) < 2:
        return base - 3
    return base


def spans(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) of the personal information in ``text``, in order and without overlaps."""
    found: list[tuple[int, int, str, float]] = []
    text = text.replace("\u00a0", " ")  # of the same length
    for m in EMAIL.finditer(text) if _EMAIL_HINT.search(text) else ():
        found.append((m.start(), m.end(), "email", 4.0))
    emails = [(a, b) for a, b, *_ in found]
    at = 0
    for s in text.split("\n"):
        digits = _DIGITS.search(s) is not None
        own: list[tuple[int, int, str, float]] = []
        if digits:
            for m in ID.finditer(s):
                before = s[max(0, m.start() - 60) : m.start()]
                form = m.lastgroup
                ok = valid_id(form, m.group())
                score = _ID_BASE[form] + (1.0 if ok else -1.0 if ok is False else 0.0) + (2.0 if _ID_CUE.search(before) else 0.0) - (3.0 if _ID_NOT.search(before) else 0.0)
                own.append((m.start(), m.end(), "id_number", score + 0.5))
            for m in PHONE.finditer(s):
                score = _phone_score(m.group(), s[max(0, m.start() - 60) : m.start()])
                if score > 0:
                    own.append((m.start(), m.end(), "phone", score))
        if _ADDRESS_HINT.search(s):
            own += [(m.start(), m.end(), "address", 4.5) for m in ADDRESS.finditer(s)]
        if _PERSON_HINT.search(s):
            for pattern, base in _FRAMES:
                own += [_person(s, m.start("name"), m.end("name"), base) for m in pattern.finditer(s)]
        sure = [x for x in own if x[3] >= THRESHOLD and x[2] != "person"]
        sure += [(a - at, b - at, "email", 4.0) for a, b in emails if at <= a <= at + len(s)]
        if sure:
            for m in _NEAR.finditer(s):
                gap = min((a - m.end("name") for a, *_ in sure if a >= m.end("name")), default=99)
                own.append(_person(s, m.start("name"), m.end("name"), 2.0 if gap <= 4 else 1.0))
        found += [(a + at, b + at, k, v) for a, b, k, v in own if v >= THRESHOLD]
        at += len(s) + 1
    found.sort(key=lambda x: (-x[3], x[0] - x[1], x[0]))
    kept: list[tuple[int, int, str, float]] = []
    for x in found:
        if all(x[1] <= y[0] or x[0] >= y[1] for y in kept):
            kept.append(x)
    return sorted(kept)


def _phone_score(s: str, before: str) -> float:
    head = regex.split(r"(?i),?\s*(?:x|ext|ต่อ|poste|samb|durchwahl|máy|loc|ramal)", s)[0]
    digits = "".join(c for c in head if c.isdigit())
    groups = regex.findall(r"\d+", head)
    if not 8 <= len(digits) <= 15 or _PHONE_NOT.search(before):
        return 0
    if s[0] == "+" or s[:2] == "00" and 10 <= len(digits) and digits[2] != "0":
        return 3.0
    if s[0] == "(" and len(digits) >= 9:
        return 3.0
    if regex.fullmatch(r"(?:1[ \-.])?[2-9]\d{2}[ \-.]\d{3}[ \-.]\d{4}", head):
        return 3.0
    cue = 1.5 if _PHONE_CUE.search(before) else 0.0
    if digits[0] == "0" and 9 <= len(digits) <= 13 and (len(groups) > 1 or len(digits) in (10, 11)):
        return 2.0 + cue
    if len(digits) == 8 and regex.fullmatch(r"[3689]\d{3}[ \-]?\d{4}|\d{4}[ \-]\d{4}", head):
        return 1.0 + cue
    return 0.0


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, kinds, strings = [], [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for kind, string in dict.fromkeys((k, text[a:b]) for a, b, k, _ in spans(text)) if text else ():
                keys.append(key), kinds.append(kind), strings.append(string)
        yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.types[0]), pa.array(kinds, pa.string()), pa.array(strings, pa.string())], names=["doc_id", "kind", "found"])


def replace_spans(text: str | None) -> str | None:
    """``text`` with each span replaced by the placeholder of its kind."""
    if not text:
        return text
    out, at = [], 0
    for a, b, kind, _ in spans(text):
        out += [text[at:a], PLACEHOLDERS[kind]]
        at = b
    return "".join([*out, text[at:]])


def _replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([replace_spans(x) for x in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, kind, found): each distinct string of personal information, exactly as it stands."""
    rows = spread(docs.where(F.col(text).isNotNull()).select("doc_id", F.col(text).alias("text")))
    return rows.mapInArrow(_found, f"doc_id {dict(rows.dtypes)['doc_id']}, kind string, found string")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, text): every text with its personal information replaced by typed placeholders, all else unchanged."""
    rows = spread(docs.select("doc_id", F.col(text).alias("text")))
    return rows.mapInArrow(_replaced, f"doc_id {dict(rows.dtypes)['doc_id']}, text string")
