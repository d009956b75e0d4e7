"""Mixed timestamp formats and zones, normalised to UTC instants through a persistent dictionary of distinct values.

The raw strings are de-duplicated together with what decides their reading (zone, date order, abbreviations). Only
values that the dictionary doesn't hold yet are parsed, by an Arrow-batched helper, and appended to it; the instants are
then joined back to the rows. The dictionary only grows, so a second delivery costs a scan and an anti-join.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflux.functions.instants import parse_instant
from docflux.session import broadcast_if_small, shared_dir

#: Raised whenever parse_instant reads a spelling differently, so that old dictionaries aren't used again.
PARSER_VERSION = 1
KEY = ["raw", "zone_id", "date_order", "zone_abbr"]
SCHEMA = T.StructType([*(T.StructField(k, T.StringType()) for k in KEY), T.StructField("utc_us", T.LongType())])


@F.pandas_udf(T.LongType())
def _parse(raw: pd.Series, zone: pd.Series, order: pd.Series, abbr: pd.Series) -> pd.Series:
    return pd.Series([parse_instant(*(None if v is None or v != v else v for v in x)) for x in zip(raw, zone, order, abbr)], dtype="Int64")


def _same(left: DataFrame, right: DataFrame) -> Column:
    cond = left["raw"] == right["raw"]
    for k in KEY[1:]:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


class TimestampDictionary:
    """Distinct (spelling, zone, order, abbreviations) -> microseconds since the epoch, kept as Parquet under ``path``.

    Without a path it is the one dictionary under ``spark.checkpoint.dir``, which later runs find and append to. Runs at
    the same time may append a value twice; it is read once.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = f"{path or shared_dir(spark, 'timestamps', new=False)}/v{PARSER_VERSION}"

    def _exists(self) -> bool:
        jvm, p = self.spark._jvm, self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p) and jvm is not None

    def read(self) -> DataFrame:
        """The dictionary so far; empty before the first update."""
        if not self._exists():
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path).groupBy(*KEY).agg(F.min("utc_us").alias("utc_us"))

    def update(self, values: DataFrame) -> DataFrame:
        """Parse and append the values (columns of KEY) that aren't held yet; the whole dictionary comes back.

        NULL strings are no value. Repeated rows are parsed once: ``distinct`` combines map-side, so a string that a
        third of the rows share costs one row a partition in the shuffle.
        """
        fresh = values.select(*KEY).where(F.col("raw").isNotNull()).distinct()
        if self._exists():
            held = self.read().select(*KEY)
            fresh = fresh.join(held, _same(fresh, held), "left_anti")
        fresh.withColumn("utc_us", _parse(*KEY)).write.mode("append").parquet(self.path)
        return self.read()


def normalize_timestamps(rows: DataFrame, column: str, authorities: DataFrame, dictionary: TimestampDictionary, out: str = "utc_us") -> DataFrame:
    """``rows`` (with ``authority``) plus ``out``: the instant that ``column`` names, NULL if it names none.

    Rows keep their number and order is not defined. NULL or unknown authorities leave only values that carry their own
    zone. ``authorities`` must have one row an authority; the first by zone_id is taken if not. Columns of ``rows`` keep
    their names, also if they clash with those of the dictionary or ``authorities``.
    """
    zones = authorities.where(F.col("authority").isNotNull()).groupBy(F.col("authority").alias("_authority")).agg(*(F.min(k).alias(f"_{k}") for k in KEY[1:]))
    keyed = rows.join(broadcast_if_small(zones), F.col("authority") == F.col("_authority"), "left").withColumn("_raw", F.col(column))
    held = dictionary.update(keyed.select(*(F.col(f"_{k}").alias(k) for k in KEY))).select(*(F.col(k).alias(f"_held_{k}") for k in KEY), F.col("utc_us").alias("_utc_us"))
    cond = F.col("_raw") == F.col("_held_raw")
    for k in KEY[1:]:
        cond = cond & F.col(f"_{k}").eqNullSafe(F.col(f"_held_{k}"))
    return keyed.join(held, cond, "left").select(*(rows[c] for c in rows.columns if c != out), F.col("_utc_us").alias(out))


def event_instants(events: DataFrame, authorities: DataFrame, dictionary: TimestampDictionary | None = None) -> DataFrame:
    """(event_id, pub_utc_us): each distinct event whose ``pub_date`` names an instant in any of its deliveries.

    NULL event_ids are left out. If deliveries should disagree against the rule, the earliest instant is taken.
    """
    dictionary = dictionary or TimestampDictionary(events.sparkSession)
    rows = normalize_timestamps(events.select("event_id", "authority", "pub_date"), "pub_date", authorities, dictionary)
    return rows.where(F.col("utc_us").isNotNull() & F.col("event_id").isNotNull()).groupBy("event_id").agg(F.min("utc_us").alias("pub_utc_us"))
