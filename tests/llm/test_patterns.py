import random
import time

from pyspark.sql import functions as F

from docflux.functions.instants import MONTHS
from docflux.llm import boilerplate as B
from docflux.llm import spam as S

LETTERS = r"[\p{L}\p{M}]"
WORDS = sorted((m for m in MONTHS if m.isalpha() and len(m) > 2), key=len, reverse=True)
#: The patterns of the page operators beside their plain forms, which give the same and look at every character several times.
MONTH = (rf"(?<!{LETTERS}){B._MONTHS}(?!{LETTERS})", rf"(?<!{LETTERS})(?:{'|'.join(WORDS)})(?!{LETTERS})")
SPLIT = (B._SENTENCES, r"(?<=[.?!…][\"'”’)]{0,2})\s+")
END = (S._END, r"[\p{L}\p{M}\d)\"'”’%][.?…][\"'”’)]*$|[\p{L}\p{M}]{2}[.?]\s+\p{Lu}")


def odd_lines(n=4000):
    rng = random.Random(7)
    bits = [*WORDS, *". ? ! … \" ' ” ’ ) ( | · - / > % 3 27 é ก ั 𐐀 𝟙 Ab ab A http:// www. WWW.x # •".split(), " ", "  ", "\t", " ", " "]
    return [("".join(rng.choice(bits) for _ in range(rng.randint(1, 24))),) for _ in range(n)] + [("",), (" ",), (None,)]


def test_patterns_give_the_same_as_plain_ones(spark):
    line = F.col("line")
    df = spark.createDataFrame(odd_lines(), "line string")
    month, split, end = ([f(p) for p in pair] for f, pair in ((lambda p: F.regexp_replace(line, p, "<m>"), MONTH), (lambda p: F.split(line, p), SPLIT), (lambda p: line.rlike(p), END)))
    plain = (line.rlike(END[1]) & (F.size(F.split(line, r"\s+")) >= 5)) | line.rlike(r"[฀-๿]{24}")
    for new, old in (month, split, end, (S.is_running_text(line), plain)):
        assert df.where(~new.eqNullSafe(old)).count() == 0
        assert df.select(old).distinct().count() > 1


def test_patterns_cost_less_than_plain_ones(spark):
    text = " ".join(random.Random(1).choices("the board of each firm has adopted stated measures for no data and outsourced judgment".split(), k=40000))
    pattern = spark._jvm.java.util.regex.Pattern

    def seconds(p):
        matcher, took = pattern.compile(p).matcher(text), []
        for _ in range(9):
            matcher.reset()
            began = time.perf_counter()
            assert not matcher.find()
            took.append(time.perf_counter() - began)
        return min(took)

    for new, old in (MONTH, SPLIT, END):
        assert seconds(new) < 0.8 * seconds(old)


def test_lines_without_separators_have_no_parts(spark):
    docs = spark.createDataFrame([(1, "h", 1, "Home\n- Contact\nHome | Terms - Help"), (2, "h", 2, "Notice on 3 May 2024 (12 May)")], "doc_id bigint, host string, content bigint, raw_text string")
    rows = {(r["doc_id"], r["line_no"]): r for r in B.style_nodes(docs, "raw_text", True).collect()}
    assert {k: r["parts"] and len(r["parts"]) for k, r in rows.items()} == {(1, 0): None, (1, 1): None, (1, 2): 3, (2, 0): None}
    key = lambda t: spark.createDataFrame([(t,)], "t string").select(B.node(F.col("t"))).head()[0]
    assert [rows[1, 0][c] for c in ("key", "bare")] == [key("home")] * 2
    assert [rows[2, 0][c] for c in ("key", "bare")] == [key("notice on 3 may 2024 (12 may)"), key("notice on 1 june 2025")]
