import pytest

from docflux.llm import pii as P

CASES = [
    ("For further details, contact Sunniva Tarrowby on 0900-629-9385 or write to sunniva.tarrowby@team.hartwell.example.", {("person", "Sunniva Tarrowby"), ("phone", "0900-629-9385"), ("email", "sunniva.tarrowby@team.hartwell.example")}),
    ("Submitted by Rufus Venstrom <rufus+case306 [at] courrier.example.org>", {("person", "Rufus Venstrom"), ("email", "rufus+case306 [at] courrier.example.org")}),
    ("Write to kl88 (at) mailbox (dot) example or abasrizal＠kantor.example.net.", {("email", "kl88 (at) mailbox (dot) example"), ("email", "abasrizal＠kantor.example.net")}),
    ("Please ring 1-310-555-0113 x91 or +49 (0)30 23125-146 or (02) 5550 1049.", {("phone", "1-310-555-0113 x91"), ("phone", "+49 (0)30 23125-146"), ("phone", "(02) 5550 1049")}),
    ("The complaint was lodged by McSorran, Garrick, holder of S3105534T, and concerns an unpaid claim.", {("person", "McSorran, Garrick"), ("id_number", "S3105534T")}),
    ("Pengaduan diajukan oleh Bagus Wulandri Kusumarta dengan NIK 3725870401825006 terkait klaim.", {("person", "Bagus Wulandri Kusumarta"), ("id_number", "3725870401825006")}),
    ("Aduan itu dibuat oleh Encik Faizura binti Kasmuri, nombor kad pengenalan 970422-14-7588.", {("person", "Faizura binti Kasmuri"), ("id_number", "970422-14-7588")}),
    ("La plainte a été déposée par Mme Delacourtine, Solène, numéro d'identité 1 26 04 92 137 299 52.", {("person", "Delacourtine, Solène"), ("id_number", "1 26 04 92 137 299 52")}),
    ("Auskunft erteilt Herr Uta Krählinger, Telefon 030 23125 636.", {("person", "Uta Krählinger"), ("phone", "030 23125 636")}),
    ("Đơn khiếu nại do bà Phùng Minh Tuệ, số căn cước 010022203010, nộp.", {("person", "Phùng Minh Tuệ"), ("id_number", "010022203010")}),
    ("สอบถามเพิ่มเติมได้ที่คุณ ณัฐกานดา แก้วมณีรัตน์ อีเมล office21@team.hartwell.example", {("person", "ณัฐกานดา แก้วมณีรัตน์"), ("email", "office21@team.hartwell.example")}),
    ("Tumawag kay Lorenzo de los Palmas sa +855 20 710 559.", {("person", "Lorenzo de los Palmas"), ("phone", "+855 20 710 559")}),
    ("A copy was posted to Dr Teoh Siew Lan, Level 10, 99 Kestrel Drive, Lorne Bay 4069.", {("person", "Teoh Siew Lan"), ("address", "Level 10, 99 Kestrel Drive, Lorne Bay 4069")}),
    ("Harbour Board, +65-5149-8384 - 119 Tidewater Avenue, #03-40, S(208409)", {("phone", "+65-5149-8384"), ("address", "119 Tidewater Avenue, #03-40, S(208409)")}),
    ("La convocation a été remise au 109 bis, boulevard du Vieux Bac, 20573 Valmorey le 7 juin 2026.", {("address", "109 bis, boulevard du Vieux Bac, 20573 Valmorey")}),
    ("Die Ladung ging am 26. Mai 2025 an Salzgasse 154, 22782 Ostbrück.", {("address", "Salzgasse 154, 22782 Ostbrück")}),
    ("Ipinadala ang patawag sa 65 Sampaguita St., Brgy. San Lirio, Bayan ng Silangan.", {("address", "65 Sampaguita St., Brgy. San Lirio, Bayan ng Silangan")}),
    ("Circular 8812 3345 replaces Circular 8812 3301. Account series 4000-1200-0000-0000 is reserved for tests of the return.", set()),
    ("The Tarrowby Bridge Accord remains in force until January 20, 2022. Quellmont Partners LLP acted for the applicant. The Saint Orlan Road Transport Bill was read twice.", set()),
    ("Licence 20257901000812025 was varied; the notice numbered 2021-5174-33, PSN 8995 2021 and 3758.2022.03 apply. The unit price was quoted @ 5.20 per licence.", set()),
    ("Ashcombley Lending House, 2021-3715-29\nFollow @harbourboard for updates. A fee of 4,569 applies to 6,555,012 entries.", set()),
]


@pytest.mark.parametrize("text, want", CASES)
def test_spans(text, want):
    assert {(k, text[a:b]) for a, b, k, _ in P.spans(text)} == want


def test_validators():
    assert P.luhn("4539578763621486") and not P.luhn("4539578763621487")
    assert P.sg_letter("S1234567D") and not P.sg_letter("S1234567A")
    assert P.mod97("1 84 12 76 451 089 46") == (97 - 1841276451089 % 97 == 46)
    assert P.mod11("1101700230708") == ((11 - sum(int(d) * (13 - i) for i, d in enumerate("110170023070")) % 11) % 10 == 8)
    assert P.valid_id("my", "810528-12-2240") and not P.valid_id("my", "811328-12-2240")


def test_placeholders_leave_all_else_as_it_was():
    text = "x\r\n Enquiries may be sent to Tobin Pell-Harrow at t@inbox.example.net.\n\ty "
    assert P.replace_spans(text) == "x\r\n Enquiries may be sent to [PERSON] at [EMAIL].\n\ty "
    assert P.replace_spans(None) is None and P.replace_spans("") == ""
    plain = "Nothing here.\n" * 3
    assert P.replace_spans(plain) == plain


def test_frames(spark):
    rows = [(1, CASES[0][0], "a"), (1, CASES[0][0] + " " + CASES[0][0], "b"), (2, None, "c"), (3, "", "d"), (4, "Plain.\n" * 20000 + CASES[3][0], "e")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kind string")
    got = P.find_pii(df).collect()
    assert len(got) == 2 * 3 + 3 and {(r["kind"], r["found"]) for r in got if r["doc_id"] == 4} == CASES[3][1]
    assert P.redact(df).count() == 5 and P.find_pii(df.limit(0)).count() == 0


HINTED = [
    ("address", "45 Mabini Street, Barangay Poblacion, Makati"),
    ("address", "45 MABINI ST. BRGY. POBLACION, MAKATI"),
    *(("person", f"An interview with {p} Cruz, Maria, was held.") for p in ("bin", "binti", "bte", "de los", "de las", "de la", "del", "dela", "de", "von", "van", "van der", "zu", "al", "el")),
    *(("person", f"เอกสารที่ สมชาย ใจดี{end}") for end in (" โทร 1", " อีเมล", " เลข", " ให้การ", " ไม่มา", " กล่าว", ", พยาน")),
    ("person", "เอกสารที่ Maria Cruz ให้การ"),
]


@pytest.mark.parametrize("kind, line", HINTED)
def test_no_line_with_a_span_fails_its_hint(kind, line):
    patterns, hint = ([P.ADDRESS], P._ADDRESS_HINT) if kind == "address" else ([p for p, _ in P._FRAMES], P._PERSON_HINT)
    assert any(p.search(line) for p in patterns)
    assert hint.search(line)
    assert kind in {k for _, _, k, _ in P.spans(line)}
