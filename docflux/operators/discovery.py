"""Discovery of urls: patterns of known paths, per-domain caps, names and citations of what was found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflux.functions.text import LANDING_WORDS, LISTING_WORDS, absolute, slug


def pattern_urls(events: DataFrame, years: tuple[int, ...] = (2023, 2024, 2025), latest: int = 50, most: int = 100) -> DataFrame:
    """(authority, url): candidate listing pages of each authority, at most ``most`` in order of base, month and spelling.

    The first four parts of its ``latest`` urls are the bases; each gets the months of ``years`` in three spellings, and
    urls that are known already are left out. ``latest`` and ``most`` are the operator's own: candidates are to be tried.
    """
    known = events.where(F.col("url").isNotNull())
    order = [F.desc_nulls_last("access_ts"), F.asc("event_id"), F.asc_nulls_first("pub_date"), F.asc("url")]
    recent = first_of_each(known.select("authority", "url", "access_ts", "event_id", "pub_date"), F.col("authority"), order, latest)
    parts = F.split("url", "/")
    bases = recent.where(F.size(parts) >= 4).select("authority", F.concat(F.array_join(F.slice(parts, 1, 4), "/"), F.lit("/")).alias("base")).distinct()
    spans = bases.withColumn("year", F.explode(F.array(*map(F.lit, years)))).withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    spelt = F.array(*(F.format_string(f, "base", "year", "month") for f in ("%s%d/%02d/", "%s%d-%02d/", "%s%d%02d/")))
    made = spans.select("authority", "base", "year", "month", F.posexplode(spelt).alias("spelling", "url"))
    fresh = made.join(known.select("url").distinct(), "url", "left_anti")
    return first_of_each(fresh, F.col("authority"), [F.asc(c) for c in ("base", "year", "month", "spelling")], most).select("authority", "url")


def _hrefs(html: Column) -> Column:
    return F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*href\s*=\s*[\"']([^\"'>]+)[\"']"), F.lit(1)), lambda h: F.trim(h))


def _mentions(url: Column, words: tuple[str, ...]) -> Column:
    return F.lower(url).rlike("|".join(words))


def listing_links(base: Column, html: Column, most: int = 50) -> Column:
    """Publications that a listing page links to, each once, at most ``most``: rooted links are made absolute, other relative ones left out."""
    full = F.transform(F.filter(_hrefs(html), lambda h: h.startswith("/") | h.startswith("http")), lambda h: absolute(base, h))
    return F.slice(F.array_distinct(F.filter(full, lambda u: _mentions(u, LISTING_WORDS))), 1, most)


def landing_links(base: Column, html: Column, most: int = 8) -> Column:
    """The first ``most`` publications that a landing page links to, repeated links once (counted before)."""
    sound = F.filter(_hrefs(html), lambda h: ~h.startswith("#") & ~F.lower(h).startswith("javascript:"))
    full = F.transform(sound, lambda h: absolute(base, h))
    return F.array_distinct(F.slice(F.filter(full, lambda u: u.startswith("http") & _mentions(u, LANDING_WORDS)), 1, most))


def since_lastmod(rows: DataFrame, lastmod: str, as_of: str, days: int) -> DataFrame:
    """Rows whose ``lastmod`` is unknown or at most ``days`` before ``as_of``; all rows if ``days`` isn't positive."""
    if days <= 0:
        return rows
    return rows.where(F.col(lastmod).isNull() | (F.col(lastmod) >= F.lit(as_of).cast("timestamp") - F.make_interval(days=F.lit(days))))


def first_marker(text: Column, markers: list[tuple[str, list[str]]], default: str | None = None) -> Column:
    """The first name, in declared order, one of whose markers occurs in ``text``, whatever the case."""
    out = F.lit(default)
    for name, needles in reversed(markers):
        hit = F.lit(False)
        for n in needles:
            hit = hit | F.coalesce(F.lower(text).contains(n.lower()), F.lit(False))
        out = F.when(hit, name).otherwise(out)
    return out


def fetch_policy(authority: Column, policies: list[tuple[list[str], str, int]], default: tuple[str, int]) -> tuple[Column, Column]:
    """(proxy mode, wait in ms) of an authority: the first policy that names it, whatever the case."""
    mode, wait = F.lit(default[0]), F.lit(default[1])
    for names, m, w in reversed(policies):
        hit = F.upper(F.coalesce(authority, F.lit(""))).isin(*(n.upper() for n in names))
        mode, wait = F.when(hit, m).otherwise(mode), F.when(hit, w).otherwise(wait)
    return mode, wait


def diverse(rows: DataFrame, group: str, order: list[Column], each: int = 30, most: int = 250) -> DataFrame:
    """At most min(``each``, ``most`` // groups) rows of each group in ``order``, and ``most`` in all by group: a sampler's feature."""
    groups = rows.select(group).distinct().agg(F.count(F.lit(1)).alias("_groups"))  # one row
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_rank") <= each)
    kept = ranked.join(F.broadcast(groups)).where(F.col("_rank") <= F.floor(F.lit(most) / F.col("_groups")))
    return kept.orderBy(F.asc_nulls_first(group), "_rank").limit(most).drop("_rank", "_groups")


def first_of_each(rows: DataFrame, group: Column, order: list[Column], cap: int) -> DataFrame:
    """At most ``cap`` rows of each group in a total order."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_r") <= cap).drop("_r")


def is_pdf(url: Column) -> Column:
    """Whether a url's path ends in .pdf, whatever query follows."""
    return F.lower(F.regexp_extract(url, r"^([^?#]*)", 1)).endswith(".pdf")


def brief_id(prefix: str, stamp: Column, title: Column, number: int = 1) -> Column:
    """prefix-YEARQn-slug-001 of a date and a title."""
    return F.format_string(f"{prefix}-%dQ%d-%s-%03d", F.year(stamp), F.quarter(stamp), slug(title), F.lit(number))


def citation(title: Column, day: Column, url: Column, accessed: Column, snippets: Column) -> Column:
    """The line by which a report cites a page."""
    return F.format_string("[Citation: %s | %s | %s | accessed %s | snippets %d]", F.coalesce(title, F.lit("Untitled")), F.coalesce(day, F.lit("n.d.")), url, accessed, snippets)


def name_filter(rows: DataFrame, needles: list[str], *columns: str) -> DataFrame:
    """Rows one of whose columns contains one of the needles, whatever the case; all rows if there are no needles."""
    hit = F.lit(not needles)
    for c in columns:
        for n in needles:
            hit = hit | F.coalesce(F.lower(c).contains(n.lower()), F.lit(False))
    return rows.where(hit)
