import random

from docflux.llm import boilerplate as B
from docflux.llm import spam as S

SENTENCES = ["The Board has opened a public consultation on {}.", "The licensing unit found weaknesses in {} under the existing conditions.", "Every payment operator will publish further details on {}.", "Our supervision team reminds firms of their duties under {}."]
TOPICS = ["anti-scam controls", "cloud hosting", "broker conduct", "green bonds", "data breach reporting", "tower sharing", "retail funds", "open banking"]
MENU = {h: ["Home", "About us", "Licensing", "Contact", f"Site {h} | Terms of use | Privacy statement"] for h in ("a.example", "b.example", "c.example", "d.example")}
SCHEMA = "doc_id bigint, source string, source_url string, title string, raw_text string, clean_text string, host string, line string"


def page(rng, host, title, body):
    menu = MENU[host]
    return "\n".join([*menu[:4], title, *body, "We use cookies to improve your experience on this site.", "Related articles", f"Notice on {rng.choice(TOPICS)} ...", menu[4]])


def corpus(n=160):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        host = rng.choice(list(MENU))
        # sentences of the page's own: no two pages share a line
        body = [" ".join(s.format(f"{rng.choice(TOPICS)} of case {chr(97 + j)}{chr(97 + i % 26)}{chr(97 + i // 26)}") for s in rng.sample(SENTENCES, 2)) for j in range(4)]
        body.insert(2, "Background")
        title = f"Notice on {rng.choice(TOPICS)}"
        if i % 2:
            rows.append((i, host, f"https://{host}/{i}", title, page(rng, host, title, body), None, "h", "l"))
        else:
            rows.append((i, host, f"https://{host}/{i}", title, None, "\n".join(body), "h", "l"))
    return rows


def spam_rows(at):
    words = ["cheap broker", "visa agent", "best loan", "forex signal"]
    rng = random.Random(9)
    out = []
    for k, host in enumerate(list(MENU) * 3):
        kind = (k + k // 4) % 4  # each kind on three hosts
        if kind == 0:
            lines = ["; ".join(rng.choice(words) for _ in range(12)) for _ in range(6)]
        elif kind == 1:
            lines = [f"{rng.choice(words)} - https://spam{rng.randint(1, 9)}.test/{rng.randint(1, 999)}" for _ in range(9)]
        elif kind == 2:
            lines = [" ".join("#" + rng.choice(words).replace(" ", "") for _ in range(8)) for _ in range(5)]
        else:
            lines = [f"{rng.choice(words).title()} B{rng.randint(1, 99)}  {rng.randint(1, 99)}.50  in stock  {rng.choice(words)}" for _ in range(8)]
        out.append((at + k, host, f"https://{host}/s{k}", "Notice", "\n".join([*MENU[host][:4], *lines, MENU[host][4]]), None, "h", "l"))
    return out


def register(at):
    lines = [f"{i}. Firm {chr(65 + i)} Lending House, 20{i:02d}-4719-{i}" for i in range(1, 20)]
    return [(at, "a.example", "https://a.example/r", "Register", "\n".join([*MENU["a.example"][:4], "The register of licensed firms as of today is given below.", *lines, MENU["a.example"][4]]), None, "h", "l")]


def test_spam(spark):
    rows = corpus() + spam_rows(1000) + register(2000) + [(3000, None, None, None, None, None, None, None), (3001, None, None, None, "", None, "h", "l"), (3002, "a.example", None, None, "\n \n", None, "h", "l")]
    got = sorted(r["doc_id"] for r in S.find_spam(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [r[0] for r in spam_rows(1000)]


def test_density_alone_is_no_case(spark):
    # a list of links that nobody else has, and phrases that other hosts have in running text
    links = "\n".join([*MENU["a.example"][:4], *(f"Alder{chr(97 + i)} Birch{chr(97 + i)} - https://h{i}.library{i}.test/entry{i}" for i in range(9))])
    rows = corpus() + spam_rows(1000) + [(5000, "a.example", "https://a.example/l", "Library", links, None, "h", "l")]
    assert sorted(r["doc_id"] for r in S.find_spam(spark.createDataFrame(rows, SCHEMA)).collect()) == [r[0] for r in spam_rows(1000)]


def test_long_lines_are_tested_as_short_ones(spark):
    words = ["cheap broker", "visa agent", "best loan", "forex signal"]
    rng = random.Random(12)
    long = "; ".join(rng.choice(words) for _ in range(900))
    rows = corpus() + spam_rows(1000) + [(5001, "b.example", "https://b.example/k", "t", "\n".join([*MENU["b.example"][:4], long]), None, "h", "l")]
    assert 5001 in [r["doc_id"] for r in S.find_spam(spark.createDataFrame(rows, SCHEMA)).collect()]


def test_spam_of_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame(corpus() + spam_rows(1000) * 2, SCHEMA)
    assert sorted(r["doc_id"] for r in S.find_spam(df).collect()) == [r[0] for r in spam_rows(1000)]
    assert S.find_spam(df.limit(0)).count() == 0


def test_copies_of_a_page_are_one_page(spark):
    body = [" ".join(s.format(f"{t} of the copied case {k}") for s, t in zip(SENTENCES, TOPICS)) for k in "wxyz"]
    links = [f"{n} - https://other{n.lower()}.test/{i}" for i, n in enumerate(("Annex", "Report", "Minutes"))]  # a notice's references
    text = "\n".join([*MENU["a.example"][:4], *body, *links, MENU["a.example"][4]])
    copies = [(4000 + k, "a.example", f"https://a.example/c{k}", "Notice", text, None, "h", "l") for k in range(90)]
    df = spark.createDataFrame(corpus() + spam_rows(1000) + copies, SCHEMA)
    assert sorted(r["doc_id"] for r in S.find_spam(df).collect()) == [r[0] for r in spam_rows(1000)]


def test_copies_stuff_no_phrase(spark):
    # two pages without evidence hold the phrase; copies of one with evidence don't outvote them
    rows = [(c, h, e, [7]) for h in "abc" for c, e in [(1, True), *[(1, True)] * 9, (2, False), (3, False)]]
    assert S.stuffed_phrases(spark.createDataFrame([(10 * i + c, h, e, p, c) for i, (c, h, e, p) in enumerate(rows)], "doc_id bigint, host string, evident boolean, phrases array<bigint>, content bigint")).count() == 0


def test_long_text_is_no_stuffing(spark):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(700)]
    line = " ".join(rng.choice(vocabulary) for _ in range(20000)) + "."
    df = spark.createDataFrame([(1, "a.example", None, "t", line, None, "h", "l")], SCHEMA)
    assert S.find_spam(df).count() == 0


def test_boilerplate(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["doc_id"], r["line_no"]) for r in B.find_boilerplate(df).collect()}
    want = set()
    for i, host, _, title, raw, *_ in rows:
        for n, line in enumerate(raw.split("\n")) if raw else ():
            if line in MENU[host] or line.startswith("We use cookies") or line == "Related articles" or line.endswith("..."):
                want.add((i, n))
    assert got == want
    bodies = {r["doc_id"]: r["clean_text"] for r in B.main_content(df).collect()}
    for i, _, _, title, raw, *_ in rows:
        assert (i in bodies) == (raw is not None)
        if raw:
            assert bodies[i] == "\n".join(x for n, x in enumerate(raw.split("\n")) if (i, n) not in want)


def test_boilerplate_edges(spark):
    extra = [(900, None, None, None, None, None, None, None), (901, "a.example", None, None, "", None, "h", "l"), (902, "a.example", None, None, "\n\n", None, "h", "l")]
    df = spark.createDataFrame(corpus(40) + extra, SCHEMA)
    once = sorted(map(tuple, B.find_boilerplate(df).collect()))
    assert sorted(map(tuple, B.find_boilerplate(df.unionByName(df.where("doc_id = 7"))).collect())) == once
    assert not [r for r in B.find_boilerplate(df).collect() if r["doc_id"] >= 900]
    assert B.find_boilerplate(df.limit(0)).count() == 0
    some = df.where("raw_text is not null").select("doc_id").limit(5)
    assert B.find_boilerplate(df, leave_out=some).join(some, "doc_id").count() == 0
