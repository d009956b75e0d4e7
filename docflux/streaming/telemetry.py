"""Structured Streaming forms of the incremental jobs: windowed counts, deduplicated arrivals, upserts, a rate-limit guard."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docflux.operators.telemetry import day_slices, folded_slices
from docflux.session import shared_dir


def read_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1) -> DataFrame:
    """Parquet files of ``folder`` as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def daily_calls(stream: DataFrame, late: str = "45 days") -> DataFrame:
    """Calls and limited calls of each authority and day; rows later than ``late`` behind the newest are left out."""
    rows = stream.where("ts is not null").withWatermark("ts", late)
    day = F.window("ts", "1 day")
    return rows.groupBy(day.alias("w"), "authority").agg(F.count(F.lit(1)).alias("calls"), F.count_if(F.col("status_code_or_error") == "429").alias("limited")).select("authority", F.col("w.start").alias("day"), "calls", "limited")


def first_sight(stream: DataFrame, keys: list[str], late: str = "45 days") -> DataFrame:
    """Rows whose key wasn't seen within the watermark: repeated log lines are dropped with bounded state."""
    return stream.where("ts is not null").withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def sessions(stream: DataFrame, gap: str = "30 minutes", late: str = "45 days") -> DataFrame:
    """Calls of an authority without a pause longer than ``gap``."""
    rows = stream.where("ts is not null").withWatermark("ts", late)
    return rows.groupBy(F.session_window("ts", gap).alias("w"), "authority").agg(F.count(F.lit(1)).alias("calls")).select("authority", F.col("w.start").alias("begun"), F.col("w.end").alias("ended"), "calls")


@dataclass(frozen=True)
class Folded:
    """A stream of which each micro-batch is reduced and folded into one small table: ``step(batch, table so far or None)`` gives the next."""

    rows: DataFrame
    step: Callable[[DataFrame, DataFrame | None], DataFrame]


def _guard(batch: DataFrame, before: DataFrame | None) -> DataFrame:
    slices = day_slices(batch, "429")
    if before is not None:  # what is known of an authority is its first slice: a broken one, so that only its run goes on
        known = before.select("authority", F.lit(None).cast("date").alias("day"), "longest", F.lit(0).cast("bigint").alias("lead"), F.col("run").alias("trail"), F.lit(1).cast("bigint").alias("misses"))
        slices = known.unionByName(slices)
    action = F.when(F.col("longest") >= 6, "trip").when(F.col("longest") >= 3, "pause").otherwise("go")
    return folded_slices(slices).select("authority", "run", "longest", action.alias("action"))


def rate_guard(stream: DataFrame) -> Folded:
    """The running and longest streak of 429 answers of each authority, kept across batches.

    Batches count in the order of their arrival, the calls of a batch by time. Rows never reach Python or the state: a
    batch is reduced to slices of an authority and day (as ``longest_streaks`` does), and these are folded into the
    table of authorities. Calls without a time or an answer don't count; a NULL authority is one of its own.
    """
    return Folded(stream.select("authority", "url", "ts", "status_code_or_error"), _guard)


def run_once(stream: DataFrame | Folded, name: str, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Drain what has arrived into a table in the shared folder and read it; a second run over the same checkpoint adds only news.

    Of a ``Folded`` stream the table after the last batch is read; each batch begins with the one that the batch before it left.
    """
    rows = stream.rows if isinstance(stream, Folded) else stream
    spark = rows.sparkSession
    out = f"{checkpoint or shared_dir(spark, name)}"

    def write(batch: DataFrame, number: int) -> None:
        if isinstance(stream, Folded):
            batch = stream.step(batch, batch.sparkSession.read.parquet(f"{out}/batch={number - 1:09d}") if number else None)
        batch.write.mode("overwrite").parquet(f"{out}/batch={number:09d}")  # a replayed batch replaces itself

    query = rows.writeStream.outputMode(mode).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    done = spark.read.option("basePath", out).parquet(f"{out}/batch=*")
    return done.where(F.col("batch") == done.agg(F.max("batch")).head()[0]) if isinstance(stream, Folded) else done
