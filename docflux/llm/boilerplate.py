"""Main content of web pages: a site style tree over the lines that the pages of one host share.

The pages of a host are merged into one tree: host, style of line, content (numbers and month names masked), with the
parts of a separated line (menus, breadcrumbs, contact lines) as the children of its node. A node's importance is 1 less
the entropy of its spread over the host's pages, log k / log m for a node in k of m pages: 1 for what one page alone
has, 0 for what all have. A line of parts has the mean importance of its parts. Lines of low importance are removed, and
with them the branches that hang on them: lists of other pages' titles, cut-off teasers, and listed lines outside the
span of the body. Two kinds of nodes stay although pages share them: those that bodies kept by an earlier harvest
(clean_text) hold as well, such as headings, duties and set sentences (for rare lines: whose style they hold), and the page's own title above the body.

Nulls give no rows, repeated rows of a document give its lines once; empty and blank texts have no lines. Lines are split at line feeds, numbered from 0, blank ones too.
Texts are read whole. Hosts of a few pages are judged by the tree of all hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflux.functions.instants import MONTHS
from docflux.llm.residue import document_lines
from docflux.llm.spam import is_running_text, page_host
from docflux.session import broadcast_if_small, materialize, spread

#: A node is of low importance up to this value; it must stand in LEAST_PAGES pages (of a host, or of all hosts) at least.
IMPORTANCE, LEAST_PAGES = 0.6, 3
#: Least hosts of a node that is judged by the tree of all hosts, and least ratio of harvested bodies to raw pages with it.
LEAST_HOSTS, BODY_SHARE = 3, 0.2
#: A node that no harvested body holds is the sites' (but for rows of numbered lists, such as registers) if this many bodies should hold it, were it content (listed lines, running text).
EXPECTED, EXPECTED_TEXT = 4, 6


def any_of(words: list[str]) -> str:
    """A pattern of the words as a prefix tree, so that each letter of a text is tried once, not once a word."""
    tails = {k: [w[1:] for w in words if w[:1] == k] for k in sorted({w[:1] for w in words})}
    ends = tails.pop("", None) is not None
    found = "|".join(k + any_of(rest) for k, rest in tails.items())
    return f"(?:{found})" + "?" * ends if found and (ends or len(tails) > 1) else found


_MONTHS = any_of([m for m in MONTHS if m.isalpha() and len(m) > 2])
_DATED = r"\s*\((?:[^()]{0,24}\d[^()]{0,24})\)\s*$|\s*(?:\.\.\.|…)\s*$"
_BULLET = r"^(?:[\-*•·–]+\s+|\(?[0-9]{1,3}[.)]\s+|\(?[a-z]\)\s+)"
_PARTS = r"\s+[|·•»›>/\-–—]\s+|\s{2,}|(?<=\S)\s*\|\s*"
_SENTENCES = r"\s(?<=[.?!…][\"'”’)]{0,2}\s)\s*"  # white space first: looking back from every character is slow


def node(text: Column) -> Column:
    """The hash of a line's content node: case, bullets, numbers and month names don't count."""
    x = F.regexp_replace(F.lower(F.trim(text)), _BULLET, "")
    dated = F.regexp_replace(F.regexp_replace(x, rf"(?<![\p{{L}}\p{{M}}]){_MONTHS}(?![\p{{L}}\p{{M}}])", "<m>"), r"\d+(?:[.,:/\-]\d+)*", "<*>")
    return F.xxhash64(F.when(text.rlike(r"\d"), dated).otherwise(x))  # months count as numbers only beside one


def shape(line: Column) -> Column:
    """The hash of a line's style node: runs of words and numbers are folded, marks are kept. NULL for lines of words alone."""
    x = F.regexp_replace(F.regexp_replace(line, r"[\p{L}\p{M}][\p{L}\p{M}'’\-]*", "w"), r"\d+(?:[ .,/\-]*\d+)*", "9")
    x = F.regexp_replace(F.regexp_replace(x, r"(?:w[ .]*){2,}", "w "), r"\s+", " ")
    return F.when(line.rlike(r"\d|@|/|:"), F.xxhash64(F.trim(x)))


def sentences(line: Column) -> Column:
    """Hashes of the sentences of a line."""
    return F.array_distinct(F.transform(F.filter(F.split(line, _SENTENCES), lambda s: s != ""), node))


def parts(line: Column) -> Column:
    """Hashes of the parts of a separated line; NULL for a line without separators."""
    found = F.filter(F.split(F.regexp_replace(line, r"^[*•·\-]\s+", ""), _PARTS), lambda s: F.trim(s) != "")
    return F.when(line.rlike(_PARTS), F.transform(found, node))


def style_nodes(docs: DataFrame, text: str, with_host: bool) -> DataFrame:
    """One row a non-blank line: doc_id, (host, content), line_no, key, bare (title key), running, cut, parts, sentences."""
    lines = document_lines(docs, text, "host", "content") if with_host else document_lines(docs, text)
    line = F.col("line")
    dated = line.endswith(")") & line.rlike(r"\(\d{1,2}\.? \p{L}{3,9}\.?\)$")  # as teasers are
    lines = lines.withColumn("cut", line.endswith(" ...") | line.endswith(" …") | dated).withColumn("running", is_running_text(line) & ~F.col("cut")).withColumn("key", node(line))
    running, cut = F.col("running"), F.col("cut")
    keep = ["doc_id", "host", "content", "line_no"] if with_host else ["doc_id", "line_no"]
    bare = F.when(line.endswith(")") | cut, node(F.regexp_replace(line, _DATED, ""))).otherwise(F.col("key"))
    return lines.select(*keep, "key", F.when(~running | ~line.rlike(r"[.?!…][\"'”’)]*$"), bare).alias("bare"), running, cut, F.when(~running & ~cut, shape(line)).alias("shape"), F.when(~running & ~cut, parts(line)).alias("parts"), F.when(running, sentences(line)).alias("sentences"), line.rlike(r"^\(?\d{1,3}[.)]\s").alias("numbered"))


def importance(counts: DataFrame, by: list[str], total: Column) -> DataFrame:
    """(by..., pages, importance) from rows (by..., content, c): 1 less the entropy of a node's spread over pages, relative to ``total`` pages.

    A node that stands c times on a page has the share c / n of its n occurrences there; the entropy of these shares is
    log n - sum(c log c) / n, which is log k for k pages with one occurrence each. It combines map-side.
    """
    sums = counts.groupBy(*by).agg(F.count(F.lit(1)).alias("pages"), F.sum("c").alias("n"), F.sum(F.col("c") * F.log("c")).alias("clogc"))
    entropy = F.log("n") - F.col("clogc") / F.col("n")
    return sums.select(*by, "pages", F.when(total > 1, 1 - entropy / F.log(total)).otherwise(1.0).alias("importance"))


def site_tree(raw: DataFrame) -> DataFrame:
    """(host, key): nodes of low importance on their host; raw holds one row a line. Copies of a page count once."""
    own = raw.dropDuplicates(["host", "content", "line_no"])
    sizes = own.groupBy("host").agg(F.count_distinct("content").alias("m"))
    inner = own.where("size(parts) > 1").select("host", "content", F.explode("parts").alias("key"))
    counts = own.select("host", "content", "key").unionByName(inner).groupBy("host", "key", "content").agg(F.count(F.lit(1)).alias("c"))
    counts = counts.join(broadcast_if_small(sizes), "host")
    nodes = importance(counts, ["host", "key", "m"], F.col("m"))
    return nodes.where((F.col("pages") >= LEAST_PAGES) & (F.col("importance") <= IMPORTANCE)).select("host", "key")


def corpus_nodes(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """(key, common, body, missing): nodes that many pages of several hosts share; nodes that harvested bodies hold as well; how many bodies should hold a node that none holds."""
    pages = raw.agg(F.count_distinct("content")).head()[0]
    ratio = clean.select("doc_id").distinct().count() / max(pages, 1)
    # a harvested body holds a node if it has the line, or the sentence inside a line
    bodies = clean.select("doc_id", F.explode(F.array_distinct(F.concat(F.array("key"), F.coalesce("sentences", F.expr("cast(array() as array<bigint>)"))))).alias("key")).distinct().groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    inner = raw.where("size(parts) > 1").select("host", "content", F.explode("parts").alias("key"))
    inner = inner.unionByName(raw.where("size(sentences) > 1").select("host", "content", F.explode("sentences").alias("key")))
    hosts = raw.select("host", "content", "key").unionByName(inner).distinct().groupBy("key", "host").agg(F.count(F.lit(1)).alias("k")).groupBy("key").agg(F.sum("k").alias("k"), F.count(F.lit(1)).alias("hosts"))
    both = hosts.join(bodies, "key", "left").fillna(0, ["c"])
    common = (F.col("hosts") >= LEAST_HOSTS) & (F.col("k") >= LEAST_PAGES) & (1 - F.log("k") / F.log(F.lit(float(max(pages, 2)))) <= IMPORTANCE)
    missing = F.when(F.col("c") == 0, F.col("k") * F.lit(float(ratio))).otherwise(0.0)
    return both.select("key", common.alias("common"), (F.col("c") >= BODY_SHARE * F.col("k")).alias("body"), missing.alias("missing")).where(F.col("common") | F.col("body") | (F.col("missing") >= EXPECTED))


def body_shapes(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """(shape): styles of listed lines that harvested bodies hold about as often as raw pages do (contacts, addresses)."""
    k = raw.where("shape is not null").groupBy("shape").agg(F.count(F.lit(1)).alias("k"))
    c = clean.where("shape is not null").groupBy("shape").agg(F.count(F.lit(1)).alias("c"))
    return k.join(c, "shape").where(F.col("c") >= BODY_SHARE * F.col("k")).select("shape")


def mark_lines(docs: DataFrame, raw_text: str = "raw_text", clean_text: str = "clean_text", title: str = "title") -> DataFrame:
    """(doc_id, line_no, main): every non-blank line of every non-NULL raw text, and whether it is main content."""
    docs = spread(docs.select("doc_id", "source", "source_url", title, raw_text, clean_text))
    pages = docs.withColumn("host", page_host(docs)).where(F.col("doc_id").isNotNull())
    raw = materialize(style_nodes(pages.select("doc_id", "host", F.xxhash64(raw_text).alias("content"), raw_text), raw_text, True), "tree-raw")
    clean = materialize(style_nodes(docs.select("doc_id", clean_text), clean_text, False).select("doc_id", "key", "shape", "sentences"), "tree-clean")
    low = materialize(site_tree(raw), "tree-low").withColumn("low", F.lit(True))
    known = materialize(corpus_nodes(raw, clean), "tree-corpus")
    shapes = materialize(body_shapes(raw, clean), "tree-shapes").withColumn("shaped", F.lit(True))
    heads = materialize(pages.where(F.col(title).isNotNull() & (F.trim(title) != "")).groupBy("doc_id").agg(F.min(node(F.col(title))).alias("own")), "tree-titles")
    titles = heads.select(F.col("own").alias("bare")).distinct().withColumn("titled", F.lit(True))

    rows = raw.join(broadcast_if_small(low), ["host", "key"], "left").join(broadcast_if_small(known), "key", "left").join(broadcast_if_small(titles), "bare", "left").join(broadcast_if_small(shapes), "shape", "left").join(heads, "doc_id", "left")
    rows = rows.select("doc_id", "host", "line_no", "key", "running", "cut", "parts", "sentences", "numbered", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("low", "common", "body", "titled", "shaped")), F.coalesce("missing", F.lit(0.0)).alias("missing"), (F.col("key") == F.coalesce("own", F.lit(0))).alias("own"))

    rows = materialize(rows, "tree-lines")  # three plans read it

    # importance of separated lines: the mean over their parts
    several = rows.where("size(parts) > 1").select("doc_id", "host", "line_no", F.explode("parts").alias("key"))
    weights = several.join(broadcast_if_small(low), ["host", "key"], "left").join(broadcast_if_small(known.select("key", F.col("common").alias("shared"))), "key", "left").join(broadcast_if_small(titles.select(F.col("bare").alias("key"), "titled")), "key", "left")
    noise = F.coalesce("low", F.lit(False)) | F.coalesce("shared", F.lit(False)) | F.coalesce("titled", F.lit(False))
    menus = weights.groupBy("doc_id", "line_no").agg((F.avg(noise.cast("int")) >= 0.5).alias("menu"))
    # shared lines of running text: set sentences of bodies, or notices of the site
    rows = rows.withColumn("common", F.col("common") | (~F.col("numbered") & (F.col("missing") >= F.when(F.col("running"), EXPECTED_TEXT).otherwise(EXPECTED))))
    set_lines = rows.where("running and (low or common) and not body and size(sentences) > 1").select("doc_id", "line_no", F.explode("sentences").alias("key"))
    set_lines = set_lines.join(broadcast_if_small(known.where("body").select("key")), "key", "left_semi").select("doc_id", "line_no").distinct().withColumn("set", F.lit(True))
    rows = rows.join(menus, ["doc_id", "line_no"], "left").join(set_lines, ["doc_id", "line_no"], "left")

    shared = F.col("low") | F.col("common")
    code = (
        F.when(F.col("own"), "own")
        .when(F.col("cut") | F.col("titled"), "noise")
        .when(F.col("body"), F.when(F.col("running"), "text").otherwise("item"))
        .when(F.col("running"), F.when(shared & F.col("set").isNull(), "noise").otherwise("text"))
        .when(shared | F.coalesce("menu", F.lit(False)), "noise")
        .when(F.col("shaped"), "item")
        .otherwise("rare")
    )
    rows = rows.select("doc_id", "line_no", code.alias("code"))
    page = Window.partitionBy("doc_id")
    rows = rows.withColumn("first", F.min(F.when(F.col("code").isin("text", "item"), F.col("line_no"))).over(page)).withColumn("last", F.max(F.when(F.col("code").isin("text", "item"), F.col("line_no"))).over(page))
    above = F.col("first").isNull() | (F.col("line_no") < F.col("first"))
    inside = (F.col("line_no") > F.col("first")) & (F.col("line_no") < F.col("last"))
    main = F.when(F.col("code") == "own", above).otherwise(F.col("code").isin("text", "item") | ((F.col("code") == "rare") & F.coalesce(inside, F.lit(False))))
    return rows.select("doc_id", "line_no", main.alias("main"), "code").dropDuplicates(["doc_id", "line_no"])


def find_boilerplate(docs: DataFrame, leave_out: DataFrame | None = None, **columns: str) -> DataFrame:
    """(doc_id, line_no): non-blank lines that aren't main content; pages of ``leave_out`` (doc_id) are left out."""
    rows = mark_lines(docs, **columns).where("not main").select("doc_id", F.col("line_no").cast("int").alias("line_no"))
    return rows if leave_out is None else rows.join(broadcast_if_small(leave_out.select("doc_id")), "doc_id", "left_anti")


def main_content(docs: DataFrame, raw_text: str = "raw_text") -> DataFrame:
    """(doc_id, clean_text): each non-NULL raw text without the lines that aren't main content; blank lines go as well."""
    lines = document_lines_raw(docs, raw_text).join(mark_lines(docs, raw_text).where("main").select("doc_id", "line_no"), ["doc_id", "line_no"])
    bodies = lines.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda s: s["line"]), "\n").alias("clean_text"))
    return docs.where(F.col(raw_text).isNotNull()).select("doc_id").join(bodies, "doc_id", "left").fillna("", ["clean_text"])


def document_lines_raw(docs: DataFrame, text: str) -> DataFrame:
    """(doc_id, line_no, line): the lines as they stand, without a final carriage return."""
    rows = docs.where(F.col(text).isNotNull()).select("doc_id", F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))
    return rows.withColumn("line", F.regexp_replace("line", r"\r$", ""))
