import os
import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docflux.llm import language as L

PHRASES = {
    "en": ["the board has opened a consultation", "firms must keep a register of complaints", "responses should reach the secretariat", "this circular takes effect next year", "every operator shall publish the report"],
    "id": ["otoritas menemukan kelemahan dalam pelaporan", "perusahaan wajib menyampaikan laporan tahunan", "tanggapan harus diterima paling lambat", "surat edaran ini mulai berlaku", "kelompok kerja meminta masukan publik"],
    "ms": ["suruhanjaya mengetatkan keperluan bagi pelesen", "syarikat hendaklah mengemukakan penyata", "maklum balas hendaklah sampai kepada urus setia", "pekeliling ini berkuat kuasa", "penalti boleh dikenakan bagi setiap pelanggaran"],
    "vi": ["cơ quan quản lý đang lấy ý kiến", "doanh nghiệp phải nộp báo cáo hằng năm", "thông tư này có hiệu lực từ ngày", "ban thư ký nhận góp ý bằng văn bản", "mức phạt áp dụng cho mỗi vi phạm"],
    "th": ["สำนักงานกำหนดให้รายงานประจำปี", "คณะกรรมการพบข้อบกพร่องในการเปิดเผยข้อมูล", "ประกาศนี้มีผลใช้บังคับ", "ผู้รับใบอนุญาตต้องปฏิบัติตาม", "ค่าปรับสูงสุดต่อการฝ่าฝืน"],
    "tl": ["ang ahensya ay humihingi ng puna", "ang mga kompanya ay dapat magsumite ng ulat", "ang sirkular na ito ay magkakabisa", "maaaring magmulta ang bawat paglabag", "ang mga puna ay dapat matanggap"],
    "fr": ["le conseil recueille des avis sur la question", "les entreprises doivent remettre un rapport", "la circulaire entre en vigueur le mois prochain", "une amende s'applique à chaque manquement", "le groupe de travail publiera des précisions"],
    "de": ["die aufsicht verlangt einen jahresbericht", "stellungnahmen müssen bis zum ende eingehen", "das rundschreiben gilt ab dem nächsten jahr", "je verstoß droht ein bußgeld", "der ausschuss berät derzeit über die frage"],
}


def text(rng, lang, lines=3):
    return "\n".join(" ".join(rng.choice(PHRASES[lang]) for _ in range(4)) + "." for _ in range(lines))


@pytest.fixture(scope="module")
def tagger():
    rng = random.Random(1)
    rows = [(text(rng, k), k if rng.random() < 0.9 else rng.choice(list(PHRASES))) for k in PHRASES for _ in range(40)]
    return L.train(rows, steps=(70, 60))


def test_gradients():
    rng = np.random.default_rng(0)
    t = L.ByteTagger(seed=3)
    x = rng.integers(0, 256, (7, 4)).astype(np.uint8)
    mask = np.ones((7, 4), np.float32)
    mask[5:, 2] = 0
    y = np.array([0, 3, 5, 7])
    _, grads = t.step(x, mask, y)
    for key in ("Ef", "Eb", "Uf", "Ub", "Wf", "Wb", "b"):
        at = np.unravel_index(np.abs(grads[key]).argmax(), grads[key].shape)
        losses = []
        for eps in (1e-2, -1e-2):
            old = t.w[key][at]
            t.w[key][at] = old + eps
            losses.append(t.step(x, mask, y)[0].sum())
            t.w[key][at] = old
        assert abs((losses[0] - losses[1]) / 2e-2 - grads[key][at]) < 0.05 * abs(grads[key][at]) + 1e-4, key


def test_held_out_accuracy(spark):
    """Lines of documents that the tagger never saw; about a tenth of the labels are wrong or of mixed texts."""
    docs = spark.read.parquet(os.environ.get("DOCFLUX_TESTDATA", "/root/testdata") + "/sf0.01/documents.parquet").where("clean_text is not null and length(clean_text) > 200")
    rows = docs.select("clean_text", L.label_code(F.col("lang")).alias("label")).where(F.col("label").isin(*L.LANGUAGES)).distinct().orderBy("clean_text").collect()
    seen = [(r[0], r[1]) for i, r in enumerate(rows) if i % 4]
    unseen = [(r[0], r[1]) for i, r in enumerate(rows) if i % 4 == 0]
    tagger = L.train(seen, steps=(250, 250))
    right = []
    for t, label in unseen:
        spoken = [x for x in t.split("\n") if x.strip()]
        lang, sure, _ = L.label_text(t.split("\n"), tagger.evidence([L.normal_bytes(x) for x in spoken]), *tagger.calibration)
        right.append(lang == label)
        assert 0 <= sure <= 1
    assert len(right) > 80 and np.mean(right) >= 0.85
    fresh = {"en": "members of the public may write to the office by friday", "vi": "người dân có thể gửi thư đến văn phòng trước thứ sáu", "th": "ประชาชนสามารถส่งจดหมายถึงสำนักงานก่อนวันศุกร์", "fr": "les habitants peuvent écrire au bureau avant vendredi prochain", "de": "bürger können bis freitag schriftlich antworten und sich beschweren", "tl": "maaaring sumulat ang mga mamamayan sa tanggapan bago ang biyernes"}
    got = tagger.evidence([L.normal_bytes(x) for x in fresh.values()]).argmax(axis=1)
    assert [L.LANGUAGES[g] for g in got] == list(fresh)


TRAIN = """
import hashlib, random, sys
sys.path.insert(0, {root!r})
from docflux.llm import language as L
rng = random.Random(3)
words = {{k: ["".join(rng.choice("abcdefghij" + k) for _ in range(6)) for _ in range(30)] for k in L.LANGUAGES}}
sample = [(" ".join(rng.choice(words[k]) for _ in range(40)), k) for k in L.LANGUAGES for _ in range(12)]
print(hashlib.md5(b"".join(v.tobytes() for _, v in sorted(L.train(sample, steps=(12, 12)).w.items()))).hexdigest())
"""


def test_same_weights_on_any_number_of_threads():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    told = {subprocess.run([sys.executable, "-c", TRAIN.format(root=root)], env=os.environ | {"OMP_NUM_THREADS": n, "OPENBLAS_NUM_THREADS": n}, capture_output=True, text=True, check=True).stdout for n in ("1", "4")}
    assert len(told) == 1


def test_a_tagger_is_trained_once_a_sample(spark, monkeypatch, tmp_path):
    rng = random.Random(11)
    sample = [(text(rng, k) + str(rng.random()), k) for k in PHRASES for _ in range(3)]
    monkeypatch.setattr(L, "STEPS", (3, 3))
    once = L.train
    monkeypatch.setattr(L, "train", lambda s: once(s, steps=L.STEPS))
    first = L.trained(spark, sample)
    monkeypatch.setattr(L, "train", lambda *_: pytest.fail("trained again"))
    again = L.trained(spark, sample)
    assert all((first.w[k] == again.w[k]).all() for k in first.w) and first.calibration == again.calibration


def test_blocks_and_parts_change_nothing(tagger, monkeypatch):
    rng = random.Random(5)
    lines = [L.normal_bytes(text(rng, k, n)) for k in PHRASES for n in (1, 2)] + [b"  ", b""]
    whole = tagger.evidence(lines)
    monkeypatch.setattr(L, "POSITIONS", 700)
    assert np.allclose(tagger.evidence(lines), whole, atol=1e-2)
    x = np.frombuffer(lines[0], np.uint8)[:, None]
    _, hf = tagger._forward(x, "f")
    _, hb = tagger._forward(x[::-1], "b")
    y = hf[1:] @ tagger.w["Wf"] + hb[1:][::-1] @ tagger.w["Wb"] + tagger.w["b"]
    y -= np.log(np.exp(y).sum(axis=2, keepdims=True))
    assert np.allclose(y.sum(axis=(0, 1)), whole[0], rtol=1e-3, atol=0.1)


@pytest.mark.parametrize("at", [0, 2, 4])
def test_best_path_ignores_short_islands(at):
    k = len(L.LANGUAGES)
    e = np.full((5, k), -200.0)
    e[:, 0] = 0
    e[at] = -200
    e[at, 3] = 0
    sizes = np.full(5, 90)
    want = [0] * 5
    want[at] = 3
    assert list(L.best_path(e, sizes, 0.15, 5.0)) == want
    sizes[at] = 12
    assert list(L.best_path(e, sizes, 0.15, 5.0)) == [0] * 5


def test_plain_length():
    assert L.plain_length("Contact: Azrul bin Sulongan, tel. (02) 0438 6972, azrul@firma.example.com") < 30
    assert L.plain_length("THE BOARD HAS OPENED") == L.plain_length("the board has opened") == 17
    assert L.plain_length("ประชาชนสามารถส่งจดหมาย") > 15 and L.plain_length("12 345") == 0


def test_context_joins_parts(tagger):
    """A line of many parts counts every byte once, and differs little from one that is read in one go."""
    rng = random.Random(6)
    line = L.normal_bytes(text(rng, "ms", 70).replace("\n", " "))
    assert len(line) > 5 * L.PART
    whole = tagger._block([line], np.array([0]), np.array([len(line)]))[0]
    got = tagger.evidence([line])[0]
    assert np.allclose(got, whole, rtol=0.01)


def test_found(spark, tagger):
    rng = random.Random(7)
    mixed = text(rng, "en", 2) + "\n\n" + text(rng, "de", 1)
    rows = [("1", text(rng, "fr"), "fr"), ("2", text(rng, "fr"), "EN-sg"), ("3", text(rng, "th"), None), ("4", mixed, "en"), ("5", "", "en"), ("6", " \n ", None), ("7", None, "en"), ("8", text(rng, "id"), "und"), ("9", text(rng, "vi", 300), "VI")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "rec_id string, text string, raw string, lang string").withColumn("label", L.label_code(F.col("raw"))).withColumn("rec_type", F.lit("document"))
    labelled = L.label_languages(df, tagger, "text", ["rec_type", "rec_id", "label"])
    got = sorted((r["rec_id"], r["seg_no"], r["lang"]) for r in L.find_mislabelled(labelled).collect())
    assert got == [("2", -1, "fr"), ("3", -1, "th"), ("4", 0, "en"), ("4", 1, "en"), ("4", 3, "de"), ("8", -1, "id")]
    for r in labelled.collect():
        assert 0 <= r["confidence"] <= 1 and all(0 <= s["confidence"] <= 1 for s in r["segments"])
    assert L.label_languages(df.limit(0), tagger, "text", ["rec_id"]).count() == 0


def test_a_line_that_recurs_is_read_once(tagger, monkeypatch):
    rng = random.Random(9)
    shared, own = text(rng, "en", 1), [text(rng, "en", 2) for _ in range(5)]
    rows = pa.record_batch({"id": list("abcde"), "_text": [f"{shared}\n{t}\n{shared}" for t in own]})
    read, evidence = [], L.ByteTagger.evidence
    monkeypatch.setattr(L.ByteTagger, "evidence", lambda self, lines, *a: (read.extend(lines), evidence(self, lines, *a))[1])
    monkeypatch.setattr(L, "plain_length", lambda _: pytest.fail("the lines are all of one language"))
    (got,) = L._labels(tagger.w, 1)(iter([rows]))
    assert len(read) == len(set(read)) == len({x for t in own for x in t.split("\n")}) + 1
    assert got.column("lang").to_pylist() == ["en"] * 5 and all([x["seg_no"] for x in s] == [0, 1, 2, 3] for s in got.column("segments").to_pylist())


def test_one_language_needs_no_path():
    """label_text takes what best_path would give also where it doesn't ask for it."""
    rng, pick = np.random.default_rng(4), random.Random(4)
    for _ in range(500):
        lines = [pick.choice(["123", "Ab", "hello world this is text", "— 5", "ประชาชนสามารถ", "X"]) for _ in range(pick.randrange(1, 6))]
        e = (-rng.exponential(50, (len(lines), 8)) * rng.integers(0, 2, (len(lines), 8))).astype(np.float32)
        if pick.random() < 0.7:
            e[:, pick.randrange(8)] = 1
        path = L.best_path(e, np.array([L.plain_length(x) for x in lines]), 0.15, 4.5)
        assert [k for _, k, _ in L.label_text(lines, e, 0.15, 4.5)[2]] == [L.LANGUAGES[k] for k in path]


def test_products_in_training_stay_on_one_thread(monkeypatch):
    """OpenBLAS splits products of more than 2 ** 18 multiplications among threads."""
    rng, rows, evidence = random.Random(10), [], L.ByteTagger.evidence
    monkeypatch.setattr(L.ByteTagger, "evidence", lambda self, lines, n=L.ROWS: (rows.append(n), evidence(self, lines, n))[1])
    L.train([(text(rng, k) + str(i), k) for k in PHRASES for i in range(6)], steps=(2, 2))
    assert len(rows) == 2 and max(rows) * L.UNITS * L.UNITS <= 1 << 18


@pytest.mark.parametrize("label, want", [("en", "en"), ("EN", "en"), ("en-SG", "en"), ("ms_MY", "ms"), ("fil", "tl"), ("und", None), ("", None), (None, None), (" th ", "th")])
def test_label_code(spark, label, want):
    assert spark.createDataFrame([(label,)], "x string").select(L.label_code(F.col("x"))).head()[0] == want


def test_training_sample_is_bounded(spark):
    rng = random.Random(8)
    df = spark.createDataFrame([(text(rng, "en", 2) + str(i), "en") for i in range(600)] + [(text(rng, "de", 2), "de"), ("short", "fr"), (None, "th")], "t string, lang string")
    rows = L.training_sample(df, "t", F.col("lang"), rows=100)
    assert 60 <= sum(k == "en" for _, k in rows) <= 140 and sum(k == "de" for _, k in rows) == 1
    assert L.training_sample(df.limit(0), "t", F.col("lang")) == []
    assert L.train([]).evidence([b" x "]).shape == (1, len(L.LANGUAGES))
