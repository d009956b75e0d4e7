"""Scalar text functions as column expressions, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases of pages that weren't found; words of urls that lead to publications (listings, landing pages).
NOT_FOUND = ("not found", "404", "page no longer exists", "this page no longer exists")
LISTING_WORDS = ("news", "press", "release", "announcement", "circular", "regulation", "guideline", "speech", "statement")
LANDING_WORDS = ("news", "press", "release", "media", "publication", "policy", "guideline", "notice", "consult")
# Formats of publication times in metadata.
META_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss[XXX][XX]", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


def strip_html(html: Column) -> Column:
    """Text of markup: scripts, styles and tags dropped, hyphens at line ends joined, white space folded."""
    x = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>", " ")
    x = F.regexp_replace(F.regexp_replace(x, r"<[^>]+>", " "), r"-[ \t\r\f]*\n", "")
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def title_of(html: Column) -> Column:
    """The content of the title element, NULL if there is none."""
    return F.nullif(F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def published_time(html: Column) -> Column:
    """The publication time that a page's markup states (article property, else pubdate, else time element); NULL if it can't be read."""
    quoted = r"[\"']([^\"']+)[\"']"
    found = [F.nullif(F.regexp_extract(html, p + quoted, 1), F.lit("")) for p in (r"(?i)property=[\"']article:published_time[\"']\s+content=", r"(?i)name=[\"']pubdate[\"']\s+content=", r"(?i)<time[^>]+datetime=")]
    return F.try_to_timestamp(F.coalesce(*found))


def strip_markup(html: Column) -> Column:
    """Text of markup as fetched without a browser: as ``strip_html``, but hyphens at line ends stay."""
    x = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"<[^>]+>", " "), r"(?U)\s+", " "))


def metadata_time(raw: Column) -> Column:
    """The instant of a metadata field in one of four formats, without a zone as UTC; NULL if it has none of them."""
    return F.coalesce(*(F.try_to_timestamp(raw, F.lit(f)) for f in META_FORMATS))


def metadata_url(json: Column) -> Column:
    """The url of a crawled item: the first that isn't empty of sourceURL, ogUrl and url of its metadata, else its own."""
    return F.coalesce(*(F.nullif(F.get_json_object(json, p), F.lit("")) for p in ("$.metadata.sourceURL", "$.metadata.ogUrl", "$.metadata.url", "$.url")))


def ascii_ratio(text: Column) -> Column:
    """Share of ASCII among the characters that aren't white space; 0 for none."""
    solid = F.regexp_replace(text, r"\s", "")
    return F.when(F.length(solid) > 0, F.length(F.regexp_replace(solid, r"[^\x00-\x7F]", "")) / F.length(solid)).otherwise(F.lit(0.0))


def _solid(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"\s", ""))


def _share(part: Column, text: Column) -> Column:
    return F.when(_solid(text) > 0, F.least(F.lit(1.0), part / _solid(text))).otherwise(F.lit(0.0))


def _total(texts: Column, size=_solid) -> Column:
    return F.aggregate(texts, F.lit(0), lambda n, x: n + size(x))


def html_link_share(html: Column) -> Column:
    """Characters inside anchors and inside list items over all that aren't white space, at most 1; 0 for none."""
    anchors = F.regexp_extract_all(html, F.lit(r"(?is)<a\b.*?>(.*?)</a>"), F.lit(1))
    items = F.regexp_extract_all(html, F.lit(r"(?is)<li\b.*?</li>"), F.lit(0))
    return _share(_total(anchors) + _total(items), html)


def markdown_link_share(text: Column) -> Column:
    """Characters of link texts and of bulleted lines over all that aren't white space, at most 1; 0 for none."""
    links = F.regexp_extract_all(text, F.lit(r"(?i)\[([^\]]{1,200})\]\(http[^)]+\)"), F.lit(1))
    bullets = F.filter(F.split(text, r"\r?\n"), lambda x: F.trim(x).rlike(r"^[\-*•]"))
    return _share(_total(links, F.length) + _total(bullets), text)


def text_links(text: Column) -> Column:
    """Urls of markdown links, then bare urls, each once in that order."""
    marked = F.regexp_extract_all(text, F.lit(r"\[[^\]\n]*\]\((https?://[^)\s]+)\)"), F.lit(1))
    bare = F.regexp_extract_all(text, F.lit(r"https?://[^\s)\]>\"']+"), F.lit(0))
    return F.array_distinct(F.concat(marked, bare))


def not_found(title: Column, body: Column) -> Column:
    """Whether title or body says that the page wasn't found."""
    both = F.lower(F.concat_ws(" ", title, body))
    hit = F.lit(False)
    for phrase in NOT_FOUND:
        hit = hit | both.contains(phrase)
    return hit


def netloc(url: Column) -> Column:
    """Host and port of a url; NULL if it has none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]+)", 1)), F.lit(""))


def base_url(url: Column) -> Column:
    """Scheme and host of a url; NULL if it lacks either."""
    return F.nullif(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+)", 1), F.lit(""))


def absolute(base: Column, link: Column) -> Column:
    """A link made absolute against the page it stands on."""
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"(?<!/)/[^/]*$", "/")
    return F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link).when(link.startswith("//"), F.concat(F.regexp_extract(base, r"^([A-Za-z]+:)", 1), link)).when(link.startswith("/"), F.concat(root, link)).otherwise(F.concat(folder, link))


def event_hash(url: Column, day: Column, title: Column) -> Column:
    """Identity of an event: hash of url, day and title."""
    return F.sha2(F.concat_ws("|", url, day, F.coalesce(title, F.lit(""))), 256)


def char_chunks(text: Column, size: int = 1200, overlap: int = 200, keep_empty: bool = True) -> Column:
    """Overlapping pieces of a text as array<struct<chunk_index, chunk>>, no Python needed.

    An empty text gives one empty chunk (``keep_empty``) or none; NULL gives NULL.
    """
    if size <= overlap:
        raise ValueError("size must exceed overlap")
    starts = F.sequence(F.lit(0), F.greatest(F.length(text), F.lit(1)) - 1, F.lit(size - overlap))
    pieces = F.transform(starts, lambda at, i: F.struct(i.cast("int").alias("chunk_index"), F.substring(text, at + 1, F.lit(size)).alias("chunk")))
    return F.when(text.isNotNull(), pieces if keep_empty else F.when(F.length(text) > 0, pieces).otherwise(F.slice(pieces, 1, 0)))


def token_chunks(text: Column, most: int = 1500, overlap: float = 0.10) -> Column:
    """Overlapping pieces of at most ``most`` words as array<struct<chunk_index, chunk>>; a text of no more words is one piece, unchanged.

    Words (with the white space after them) stand in for the tokens of a vocabulary, so that the work stays in the JVM.
    The last piece is the first that reaches the end. An empty text is one empty piece; NULL gives NULL.
    """
    step = most - int(most * overlap)
    if step <= 0:
        raise ValueError("overlap must leave a step")
    words = F.regexp_extract_all(text, F.lit(r"[^ \t\n\f\r]+[ \t\n\f\r]*"), F.lit(0))
    last = F.ceil((F.size(words) - most) / step)
    pieces = F.transform(F.sequence(F.lit(0).cast("bigint"), F.greatest(last, F.lit(0))), lambda i: F.struct(i.cast("int").alias("chunk_index"), F.array_join(F.slice(words, (i * step).cast("int") + 1, most), "").alias("chunk")))
    return F.when(F.size(words) <= most, F.array(F.struct(F.lit(0).alias("chunk_index"), text.alias("chunk")))).when(text.isNotNull(), pieces)


def lead_sentences(text: Column, lang: Column, most: int = 8000) -> Column:
    """The first three sentences of an English text, five of any other: what stands in for a remote summary.

    ``most`` characters are read, the summary's input limit.
    """
    found = F.regexp_extract_all(F.left(text, F.lit(most)), F.lit(r"[^.!?]+[.!?]?"), F.lit(0))
    count = F.when(F.lower(F.coalesce(lang, F.lit("en"))).startswith("en"), 3).otherwise(5)
    return F.trim(F.array_join(F.slice(found, F.lit(1), count), ""))


def vector_text(vector: Column) -> Column:
    """A vector as '[v1,v2,...]', as vector columns are written."""
    return F.concat(F.lit("["), F.array_join(F.transform(vector, lambda v: v.cast("string")), ","), F.lit("]"))


def vector_of(text: Column) -> Column:
    """The vector of a text that ``vector_text`` wrote."""
    return F.from_json(text, "array<float>")


def percentage_points(after: Column, before: Column) -> Column:
    """A difference of shares with its sign and two digits, such as +3.20."""
    return F.format_string("%+.2f", after - before)


def token_estimate(text: Column) -> Column:
    """A quarter of the characters, rounded down."""
    return F.floor(F.length(text) / 4)


def slug(text: Column) -> Column:
    """Lower-case words joined by hyphens."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def error_class(note: Column) -> Column:
    """captcha, rate, timeout, proxy or other, from the text of an error."""
    x = F.lower(F.coalesce(note, F.lit("")))
    return F.when(x.contains("captcha"), "captcha").when(x.rlike("rate|429"), "rate").when(x.rlike("timeout|timed out"), "timeout").when(x.contains("proxy"), "proxy").otherwise("other")


def preview(*texts: Column, size: int = 200) -> Column:
    """The first characters of the first text that isn't NULL."""
    return F.left(F.coalesce(*texts, F.lit("")), F.lit(size))
