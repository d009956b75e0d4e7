"""Fetch telemetry: failures, streaks of failing calls, usage and cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflux.functions.text import error_class, netloc
from docflux.operators.coverage import pct
from docflux.session import broadcast_if_small

#: Statuses that are no failure.
FINE = ("ok", "200", "fallback")


def failures(events: DataFrame, errors: DataFrame) -> DataFrame:
    """One row a failure of either log: domain, url, error, seq. Both logs carry ``arrival`` (see ``sources.tables.arrival``).

    ``seq`` is the order in which failures are seen: first the error log, then the calls, each in its order of arrival.
    """
    a = events.where(F.col("status_code_or_error").isNotNull() & ~F.col("status_code_or_error").isin(*FINE) & (F.col("status_code_or_error") != ""))
    a = a.select(netloc(F.col("url")).alias("domain"), "url", F.coalesce("notes", "status_code_or_error").alias("error"), F.struct(F.lit(1).alias("log"), "arrival").alias("seq"))
    b = errors.where(F.col("status").isNotNull() & ~F.col("status").isin(*FINE)).select("domain", "url", "error", F.struct(F.lit(0).alias("log"), "arrival").alias("seq"))
    return a.unionByName(b)


def first_told(value: Column, *more: Column) -> Column:
    """Aggregate: the struct (seq, value, more...) of the first row, by ``seq``, whose ``value`` isn't empty."""
    return F.min(F.when(F.coalesce(value, F.lit("")) != "", F.struct(F.col("seq"), value, *more)))


def top_failing_domains(rows: DataFrame, k: int) -> DataFrame:
    """The k domains of most failures with the error text that was seen first and its url; ties by first appearance."""
    told = first_told(F.left("error", F.lit(100)).alias("error"), F.col("url"))
    top = rows.where("domain is not null").groupBy("domain").agg(F.count(F.lit(1)).alias("failures"), F.min("seq").alias("seen"), told.alias("first"))
    return top.orderBy(F.desc("failures"), "seen").limit(k).select("domain", "failures", F.col("first.error").alias("error"), F.col("first.url").alias("error_url"))


def day_slices(events: DataFrame, status: str) -> DataFrame:
    """(authority, day, longest, lead, trail, misses): the longest, leading and trailing run of ``status`` in each authority's calls of a day, in time order."""
    hit = (F.col("status_code_or_error") == status).cast("int")
    calls = events.where(F.col("ts").isNotNull() & F.col("status_code_or_error").isNotNull()).select("authority", F.to_date("ts").alias("day"), "ts", F.coalesce("url", F.lit("")).alias("url"), F.coalesce(hit, F.lit(0)).alias("hit"))
    day = Window.partitionBy("authority", "day").orderBy("ts", "url", "hit")
    calls = calls.withColumn("misses", F.sum(1 - F.col("hit")).over(day.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    islands = calls.groupBy("authority", "day", "misses").agg(F.sum("hit").alias("run"))
    return islands.groupBy("authority", "day").agg(F.max("run").alias("longest"), F.max(F.when(F.col("misses") == 0, F.col("run"))).alias("lead"), F.max_by("run", "misses").alias("trail"), F.max("misses").alias("misses"))


def folded_slices(days: DataFrame) -> DataFrame:
    """(authority, run, longest): slices of ``day_slices`` joined in order of their day (NULL first): the run that is open at the end, and the longest."""
    # an unbroken day carries the run on, any other day ends it with its lead and begins one with its trail
    whole = F.col("misses") == 0
    order = Window.partitionBy("authority").orderBy("day")
    days = days.withColumn("epoch", F.sum(F.when(whole, 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    start = F.when(whole, F.col("longest")).otherwise(F.col("trail"))
    carried = F.sum(start).over(Window.partitionBy("authority", "epoch").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    days = days.withColumn("open", carried)
    before = F.coalesce(F.lag("open").over(order), F.lit(0))
    days = days.withColumn("joined", F.when(whole, F.col("open")).otherwise(before + F.coalesce("lead", F.lit(0))))
    last = F.max_by("open", F.struct(F.col("day").isNotNull(), F.col("day")))
    return days.groupBy("authority").agg(last.alias("run"), F.max(F.greatest("longest", "joined", "open")).alias("longest"))


def longest_streaks(events: DataFrame, status: str, seconds: int = 60, least: int = 3) -> DataFrame:
    """The longest run of ``status`` in each authority's calls in time order, and whether it pauses (>= least) or trips (>= 2 least).

    Runs are islands: calls of one authority are ordered by time once, in slices of a day that are then joined at their
    borders, so that an authority with a third of all rows isn't one task: a slice gives its leading, trailing and longest
    run, and slices (a few thousand a decade) are folded in order.
    """
    best = folded_slices(day_slices(events, status)).select("authority", F.col("longest").alias("longest_run"))
    return best.select("authority", "longest_run", (F.col("longest_run") >= least).alias("pauses"), (F.col("longest_run") >= 2 * least).alias("trips"))


def usage(events: DataFrame, providers: list[str]) -> DataFrame:
    """Calls and mean wait of each authority by provider, pivoted over the named providers."""
    counts = [F.count_if(F.col("provider") == p).alias(p) for p in providers]
    return events.groupBy("authority").agg(*counts, F.count_if(F.col("provider").isNull() | ~F.col("provider").isin(*providers)).alias("other"), F.sum("wait_ms").alias("wait_ms"))


def error_classes(errors: DataFrame) -> DataFrame:
    """Errors by class of their text."""
    return errors.groupBy(error_class(F.col("error")).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def failure_rates(events: DataFrame) -> DataFrame:
    """Share of failing calls of each provider and proxy mode."""
    bad = ~F.coalesce(F.col("status_code_or_error"), F.lit("ok")).isin(*FINE)
    return events.groupBy("provider", "proxy_mode").agg(F.count(F.lit(1)).alias("calls"), F.count_if(bad).alias("failed")).withColumn("failed_pct", pct(F.col("failed"), F.col("calls")))


def token_totals(chunks: DataFrame, stage: Column) -> DataFrame:
    """Tokens by model, by stage, and in total: one pass over grouping sets."""
    rows = chunks.select(F.coalesce("embedding_model", F.lit("(none)")).alias("model"), stage.alias("stage"), "token_estimate")
    sets = rows.cube("model", "stage").agg(F.grouping_id().alias("g"), F.sum("token_estimate").alias("tokens"))
    return sets.where(F.col("g") != 0).select("model", "stage", "tokens")


def costs(chunks: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost of each model's tokens at ``prices`` (model, usd_per_million); models without a price cost 0 and are marked."""
    used = chunks.groupBy(F.coalesce("embedding_model", F.lit("(none)")).alias("model")).agg(F.sum("token_estimate").alias("tokens"))
    priced = used.join(broadcast_if_small(prices), "model", "left")
    return priced.select("model", "tokens", F.round(F.coalesce(F.col("tokens") / 1e6 * F.col("usd_per_million"), F.lit(0.0)), 6).alias("cost"), F.col("usd_per_million").isNull().alias("unpriced"))


def adaptive_window(rows: DataFrame, stamp: str, as_of: str, days: tuple[int, ...]) -> DataFrame:
    """Rows of the first of the windows (in days before ``as_of``) that has any, with ``window_days``.

    One aggregate finds the window; it is joined back as a single row.
    """
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(stamp)) / 86_400_000_000
    known = rows.where(F.col(stamp).isNotNull() & (age >= 0) & (age <= max(days))).withColumn("_age", age)
    first = F.coalesce(*(F.when(F.count_if(F.col("_age") <= d) > 0, d) for d in sorted(days)))
    chosen = known.agg(first.alias("window_days"))
    return known.join(F.broadcast(chosen), F.col("_age") <= F.col("window_days")).drop("_age")


def per_group_cap(rows: DataFrame, group: str, order: list[Column], cap: int) -> DataFrame:
    """At most ``cap`` rows of each group, in ``order`` (which must be total): a feature of samplers, not a safeguard."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_rank") <= cap).drop("_rank")
