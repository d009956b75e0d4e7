"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed position in its source, the hash of its id. A plan draws, for each source, whole passes over
the source and a last partial pass of the documents below a hash threshold. The threshold is found without sorting
documents: tokens are summed by source and hash bucket, the bucket in which the budget ends is refined by the next bits
of the hash, and so on; only documents of boundary buckets are read again. As positions are fixed, the selections of
plans of different budgets are nested.

A plan's total is the largest for which no listed source that has tokens is used more than ``max_repeats`` times. Sources
without documents give nothing; the others keep their proportions, and the report shows the shares reached. A source
misses its budget by half a document at most (documents of equal hash stand or fall together).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docflux.llm.tokenize import TOKENIZER_DIR, VOCABULARY, count_tokens
from docflux.session import broadcast_if_small, materialize

#: Bits of the position hash that each histogram resolves, and how many histograms: 48 bits in all.
BITS, LEVELS = 12, 4


def sized_documents(docs: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY, folder: str = TOKENIZER_DIR, seed: int = 0) -> DataFrame:
    """(doc_id, source, n_tokens, position) of the documents of sources that some plan lists, written to the shared folder.

    NULL and empty texts count 0 tokens; a NULL source is never listed.
    """
    listed = targets.where(F.col("source").isNotNull()).select("source").distinct()
    rows = docs.select("doc_id", "source", "text").join(broadcast_if_small(listed), "source", "left_semi")
    sized = count_tokens(rows, "text", ["doc_id", "source"], vocabulary, folder)
    position = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 64 - BITS * LEVELS)
    return materialize(sized.withColumn("position", position), "mix-sizes")


def budgets(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """One row a plan and source: tokens available, whole passes and the tokens left for the partial pass.

    Repeated rows of a plan and source are taken once (largest share and repeats); NULL or non-positive shares and
    repeats below 1 draw nothing.
    """
    plan = targets.where("mix_plan is not null and source is not null").groupBy("mix_plan", "source").agg(F.max(F.coalesce("target_share", F.lit(0.0))).alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(0))).alias("max_repeats"))
    have = sized.groupBy("source").agg(F.sum("n_tokens").alias("available"), F.count(F.lit(1)).alias("available_docs"))
    rows = plan.join(have, "source", "left").fillna(0, ["available", "available_docs"])
    most = F.when((F.col("available") > 0) & (F.col("target_share") > 0), F.col("available") * F.col("max_repeats") / F.col("target_share"))
    rows = rows.withColumn("plan_tokens", F.coalesce(F.min(most).over(Window.partitionBy("mix_plan")), F.lit(0.0)))
    rows = rows.withColumn("budget", F.when(F.col("available") > 0, F.least(F.greatest("target_share", F.lit(0.0)) * F.col("plan_tokens"), F.col("available") * F.col("max_repeats"))).otherwise(0.0))
    rows = rows.withColumn("passes", F.when(F.col("available") > 0, F.least(F.floor(F.col("budget") / F.col("available") + 1e-9), F.col("max_repeats").cast("bigint"))).otherwise(0))
    return materialize(rows.withColumn("rest", F.greatest(F.col("budget") - F.col("passes") * F.col("available"), F.lit(0.0))), "mix-budgets")


def thresholds(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` plus ``threshold``: documents of the source below it are in the partial pass (NULL: all positions are)."""
    state = plan.select("mix_plan", "source", "rest").withColumn("prefix", F.lit(0).cast("bigint")).withColumn("below", F.lit(0).cast("bigint"))
    inside = sized.select("source", "n_tokens", "position")
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        bucket = F.shiftright("position", shift).alias("bucket")
        if level == 1:  # one histogram a source serves all plans
            sums = inside.groupBy("source", bucket).agg(F.sum("n_tokens").alias("tokens"))
            hist = sums.join(broadcast_if_small(state), "source")
        else:
            at = broadcast_if_small(state.select(F.col("mix_plan"), F.col("source"), "prefix"))
            rows = inside.select("source", "n_tokens", "position", F.shiftright("position", shift + BITS).alias("prefix")).join(at, ["source", "prefix"])
            hist = rows.groupBy("mix_plan", "source", bucket).agg(F.sum("n_tokens").alias("tokens")).join(broadcast_if_small(state), ["mix_plan", "source"])
        order = Window.partitionBy("mix_plan", "source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = hist.withColumn("upto", F.col("below") + F.sum("tokens").over(order))
        over = F.col("upto") > F.col("rest")
        ends = run.where(over).groupBy("mix_plan", "source").agg(F.min("bucket").alias("prefix"), F.min_by(F.col("upto") - F.col("tokens"), "bucket").alias("below"), F.min("upto").alias("reached"), F.first("rest").alias("rest"))
        if level == LEVELS:  # the document in which the budget ends is taken if that comes closer to it
            closer = F.col("reached") - F.col("rest") < F.col("rest") - F.col("below")
            ends = ends.withColumn("prefix", F.col("prefix") + F.when(closer, 1).otherwise(0))
        state = materialize(ends.select("mix_plan", "source", "rest", "prefix", "below"), f"mix-level{level}")
    return plan.join(state.select("mix_plan", "source", F.col("prefix").alias("threshold")), ["mix_plan", "source"], "left")


def draw(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """(mix_plan, source, doc_id, n_tokens, repeats): every document that a plan uses, by one filter over the sizes."""
    cut = materialize(thresholds(sized, plan), "mix-thresholds").select("mix_plan", "source", "passes", "threshold", "rest", "max_repeats")
    rows = sized.join(broadcast_if_small(cut), "source")
    partial = (F.col("rest") > 0) & (F.col("passes") < F.col("max_repeats")) & (F.col("threshold").isNull() | (F.col("position") < F.col("threshold")))
    return rows.withColumn("repeats", (F.col("passes") + F.when(partial, 1).otherwise(0)).cast("int")).where("repeats > 0").select("mix_plan", "source", "doc_id", "n_tokens", "repeats")


def report(drawn: DataFrame, plan: DataFrame) -> DataFrame:
    """One row a plan and listed source: target and actual share of the tokens, documents and the most repeats used."""
    got = drawn.groupBy("mix_plan", "source").agg(F.count(F.lit(1)).alias("docs_used"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.max("repeats").alias("repeats_used"))
    rows = plan.select("mix_plan", "source", "target_share", "max_repeats", "available", "available_docs").join(got, ["mix_plan", "source"], "left").fillna(0, ["docs_used", "tokens", "repeats_used"])
    total = F.sum("tokens").over(Window.partitionBy("mix_plan"))
    return rows.withColumn("actual_share", F.when(total > 0, F.col("tokens") / total).otherwise(0.0))
