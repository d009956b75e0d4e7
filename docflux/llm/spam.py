"""Keyword-stuffed pages, link lists and tag pages, by replicated phrases and list density.

Each line is a list line or running text. List density: lines of four shapes count as dense (links to other hosts, runs
of hash tags, runs of few words again and again, priced rows of tags). Phrase shingles (two words; single words for
scripts without spaces and for tags) of all list lines are exploded and counted over pages and distinct hosts: a phrase
of SPAM_HOSTS hosts or more that stands mostly in dense pages is a stuffed phrase, and list lines stitched from stuffed
phrases count as spam as well. The two are joined: a page is a case if its spam lines are stitched in good part from
phrases that other hosts replicate, and outweigh the running text that is its own, which leaves out lines that other
pages of its host repeat (menus, notices, footers). Neither alone makes a case. Copies of a page (one text) count as one
page wherever pages are counted.

Nulls, empty and blank texts are no case. Texts are read whole. Repeated doc_ids give one row. A NULL url leaves the
host to ``source``, and a NULL source too to the empty host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflux.llm.residue import document_lines
from docflux.session import broadcast_if_small, materialize, spread

#: Hosts on which a stuffed phrase must stand in pages with evidence, and the least share of its pages that have some.
SPAM_HOSTS, SPAM_SHARE = 2, 0.5
#: Pages of a host that repeat a line of running text before it counts as the site's, not the page's.
SITE_PAGES = 3
#: Words back in which a word counts as said again, and share of a line's words that must be for it to be stuffed.
NEAR, AGAIN = 24, 0.5
#: Least share of a list line's shingles that are stuffed for it to be stitched, and of a page's spam lines' shingles.
STITCHED, REPLICATED = 0.25, 0.2
#: Lines or characters of spam that a page needs.
LEAST_LINES, LEAST_CHARS = 3, 160

_BULLET = r"^(?:[\-*•·–>»]+|\(?[0-9]{1,3}[.)]|\(?[a-z]\))\s*"
_URL = r"(?i)\b(?:https?://|www\.)[^\s<>\]\)\"']+"
# The end of a sentence: the mark is tried first, then what stands before it. (?!) never matches: it lets the look back reach letters of two code units.
_END = r"[.?…](?:(?<=[\p{L}\p{M}\d)\"'”’%].(?:(?!).)?)[\"'”’)]*$|(?<=[\p{L}\p{M}]{2}[.?](?:(?!)..)?)\s+\p{Lu})"
_FIVE_WORDS = r"\s\S++\s++\S++\s++\S++\s"


def page_host(docs: DataFrame) -> Column:
    """The host of a page: of its url, else its source."""
    return F.lower(F.coalesce(F.expr("try_parse_url(source_url, 'HOST')"), docs["source"], F.lit("")))


def words(text: Column) -> Column:
    """Lower-case words of letters (with their marks), of any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}][\p{L}\p{M}'’]*"), F.lit(0))


def is_running_text(line: Column) -> Column:
    """Whether a line reads as a sentence: five words or more with an end, or a long run of a script without spaces."""
    return (line.rlike(_END) & line.rlike(_FIVE_WORDS)) | line.rlike(r"[฀-๿]{24}")


def with_evidence(lines: DataFrame) -> DataFrame:
    """Adds ``strong`` (evidence by shape) and ``list`` (a list line) to lines with ``host``."""
    raw = F.col("line")
    line = F.regexp_replace("line", _BULLET, "")
    url = F.lower(F.regexp_extract(line, r"(?i)\bhttps?://([^/\s:<>\]\)\"']+)", 1))
    rest = F.regexp_replace(F.regexp_replace(line, _URL, " "), r"</?\w+[^>]*>|[\[\]()<>|]", " ")
    own = (url == F.col("host")) | url.endswith(F.concat(F.lit("."), F.col("host"))) | F.col("host").endswith(F.concat(F.lit("."), url))
    link = F.when(F.lower(raw).contains("http"), (url != "") & ~own & (F.size(words(rest)) <= 8))
    tags = F.size(F.regexp_extract_all(line, F.lit(r"#[\p{L}\p{M}\d_]{3,}"), F.lit(0)))
    tagged = F.when(raw.contains("#"), (tags >= 3) & (tags >= 0.8 * F.size(F.split(line, r"\s+"))))
    # a word counts as said again if one of the NEAR words before it is the same: as many in a long line as in a short one
    again = lambda w: F.size(F.filter(F.transform(w, lambda x, i: F.array_contains(F.slice(w, F.greatest(i - NEAR + 1, F.lit(1)), F.least(i, F.lit(NEAR))), x)), lambda hit: hit))
    repeats = lambda w: F.size(F.array_distinct(w)) <= (1 - AGAIN) * F.size(w)  # noqa: E731 - necessary whatever the distance, and cheap
    stuffed = F.when(F.length(raw) >= 16, F.element_at(F.transform(F.array(words(line)), lambda w: F.when((F.size(w) >= 8) & repeats(w), again(w) >= AGAIN * F.size(w))), 1))
    priced = raw.rlike(r"\S\s{2,}\p{Sc}?\d+[.,]\d{2}\s{2,}\S")
    link, tagged, stuffed = (F.coalesce(x, F.lit(False)) for x in (link, tagged, stuffed))
    strong = link | tagged | stuffed | priced
    return lines.withColumn("strong", F.coalesce(strong, F.lit(False))).withColumn("list", F.col("strong") | ~is_running_text(F.col("line")))


def phrase_shingles(line: Column) -> Column:
    """Distinct hashes of the phrases of a list line.

    These are the pairs of words inside its parts, single words of scripts without spaces and of tags, and of links the
    host and the pairs of words of the path.
    """
    plain = F.when(F.lower(line).rlike(r"http|www\."), F.regexp_replace(line, _URL, " ; ")).otherwise(line)
    text = F.replace(plain, F.lit("#"), F.lit(" ; "))
    links = F.when(line.contains("://"), F.regexp_extract_all(line, F.lit(r"https?://([^\s<>\]\)\"'?]+)"), F.lit(1)))
    path = F.coalesce(F.array_join(F.transform(links, lambda u: F.regexp_replace(F.regexp_replace(u, r"^[^/]*/?", ""), r"[\-_+]", " ")), " ; "), F.lit(""))
    parts = F.split(F.concat(text, F.lit(" ; "), path), r"[;,|/>\n!:.]+|\s[\-–·»]\s|\s{2,}|[\[\]()]")
    pairs = F.transform(F.transform(parts, words), lambda w: F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 2, F.lit(0))), lambda i: F.concat_ws(" ", F.slice(w, i + 1, 2))))
    phrases = F.filter(F.flatten(pairs), lambda s: s.contains(" ") | (F.length(s) >= 8))
    unspaced = F.coalesce(F.when(line.rlike(r"[฀-๿]{4}"), F.regexp_extract_all(line, F.lit(r"[฀-๿]{4,}"), F.lit(0))), F.array().cast("array<string>"))
    hosts = F.coalesce(F.transform(links, lambda u: F.concat(F.lit("//"), F.lower(F.regexp_extract(u, r"^[^/:]+", 0)))), F.array().cast("array<string>"))
    return F.array_distinct(F.transform(F.concat(phrases, unspaced, hosts), lambda s: F.xxhash64(s)))


def stuffed_phrases(listed: DataFrame) -> DataFrame:
    """(phrase): phrases of rows (content, host, evident, phrases) that SPAM_HOSTS hosts or more replicate in evidence pages."""
    exploded = listed.select("content", "host", "evident", F.explode("phrases").alias("phrase"))
    pages = exploded.groupBy("phrase", "host", "content").agg(F.max(F.col("evident").cast("int")).alias("evident"))
    hosts = pages.groupBy("phrase", "host").agg(F.count(F.lit(1)).alias("pages"), F.sum("evident").alias("evident"))
    return hosts.groupBy("phrase").agg(F.sum("pages").alias("pages"), F.sum("evident").alias("evident"), F.count_if(F.col("evident") > 0).alias("hosts")).where((F.col("hosts") >= SPAM_HOSTS) & (F.col("evident") >= SPAM_SHARE * F.col("pages"))).select("phrase")


def page_evidence(docs: DataFrame, text: str = "raw_text", title: str = "title") -> DataFrame:
    """(doc_id, spam_lines, spam_chars, replicated, own_chars, stuffed_title) of each page that has some evidence."""
    docs = spread(docs.select("doc_id", "source", "source_url", title, text))
    pages = docs.withColumn("host", page_host(docs)).where(F.col("doc_id").isNotNull())
    heads = pages.where(F.col(text).isNotNull()).select("doc_id", F.coalesce(F.col(title), F.lit("")).alias("title"))
    hosts = pages.select("doc_id", "host", F.xxhash64(text).alias("content"), text)
    lines = with_evidence(document_lines(hosts, text, "host", "content"))
    kept = lines.select("doc_id", "line_no", "host", "content", "strong", "list", F.length("line").alias("chars"), F.when(F.col("list"), phrase_shingles(F.col("line"))).alias("phrases"), F.when(~F.col("list"), F.xxhash64(F.regexp_replace("line", r"\d+", "9"))).alias("key"))
    kept = materialize(kept, "spam-lines")
    evident = kept.groupBy("doc_id").agg((F.count_if("strong") >= LEAST_LINES).alias("evident")).where("evident")
    listed = kept.where("list").join(broadcast_if_small(materialize(evident, "spam-evident")), "doc_id", "left").fillna(False, ["evident"])
    phrases = materialize(stuffed_phrases(listed.select("content", "host", "evident", "phrases")), "spam-phrases")

    shingles = kept.where("list and size(phrases) > 0").select("doc_id", "line_no", "chars", F.size("phrases").alias("all"), "strong", F.explode("phrases").alias("phrase"))
    hits = shingles.join(broadcast_if_small(phrases), "phrase", "left_semi").select("doc_id", "line_no", "chars", "all", "strong", "phrase")
    dense = kept.where("strong").select("doc_id", "line_no", "chars", F.coalesce(F.size("phrases"), F.lit(0)).alias("all"), "strong", F.lit(None).cast("bigint").alias("phrase"))
    lines = hits.unionByName(dense).groupBy("doc_id", "line_no").agg(F.first("chars").alias("chars"), F.max("all").alias("all"), F.max("strong").alias("strong"), F.size(F.collect_set("phrase")).alias("hits"))  # one line's phrases
    spam = lines.where(F.col("strong") | (F.col("hits") >= STITCHED * F.col("all"))).groupBy("doc_id").agg(F.count(F.lit(1)).alias("spam_lines"), F.sum("chars").alias("spam_chars"), (F.sum("hits") / F.greatest(F.sum("all"), F.lit(1))).alias("replicated"))
    spam = materialize(spam, "spam-pages")

    running = kept.where("not list").select("doc_id", "host", "content", "key", "chars")
    site = running.select("content", "host", "key").distinct().groupBy("host", "key").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= SITE_PAGES).select("host", "key")
    own = running.join(broadcast_if_small(spam.select("doc_id")), "doc_id", "left_semi").join(site, ["host", "key"], "left_anti").groupBy("doc_id").agg(F.sum("chars").alias("own_chars"))
    titles = heads.join(broadcast_if_small(spam.select("doc_id")), "doc_id", "left_semi").select("doc_id", F.explode(phrase_shingles(F.col("title"))).alias("phrase")).join(broadcast_if_small(phrases), "phrase", "left_semi").select("doc_id").distinct().withColumn("stuffed_title", F.lit(True))
    return spam.join(own, "doc_id", "left").join(titles, "doc_id", "left").fillna(0, ["own_chars"]).fillna(False, ["stuffed_title"])


def find_spam(docs: DataFrame, text: str = "raw_text", title: str = "title") -> DataFrame:
    """(doc_id): pages that are mostly keywords, links or product tags. A stuffed title halves the evidence that is needed."""
    e = page_evidence(docs, text, title)
    enough = (F.col("spam_lines") >= LEAST_LINES) | (F.col("spam_chars") >= LEAST_CHARS) | F.col("stuffed_title")
    return e.where(enough & (F.col("replicated") >= REPLICATED) & (F.col("spam_chars") * F.when(F.col("stuffed_title"), 2).otherwise(1) > F.col("own_chars"))).select("doc_id")
