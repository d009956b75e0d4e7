"""Sinks: delimited and Parquet exports, JSON lines, append-only logs, small Markdown tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export_delimited(rows: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """A header and quoted fields; ``sep`` is '|' for samplers and a tab for proofs. Partitions are written side by side."""
    plain = [F.to_json(c).alias(c) if kind.startswith(("array", "map", "struct")) else F.col(c) for c, kind in rows.dtypes]
    rows.select(*plain).write.mode(mode).option("header", True).option("escape", '"').option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss'Z'").csv(path, sep=sep)


def export_dataset(rows: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Parquet, by partition columns of few values."""
    writer = rows.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def export_lines(rows: DataFrame, path: str, column: str = "line", mode: str = "overwrite") -> None:
    """One text line a row (request batches)."""
    rows.select(column).write.mode(mode).text(path)


def append_log(rows: DataFrame, path: str, kind: str = "parquet") -> None:
    """Rows added to a log: parquet, csv (each part with its header) or json (one line a row)."""
    writer = rows.write.mode("append")
    (writer.option("header", True).option("escape", '"') if kind == "csv" else writer).format(kind).save(path)


def export_snapshot(rows: DataFrame, path: str) -> None:
    """JSON lines of a result, NULL fields kept."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def markdown(rows: DataFrame, most: int = 200) -> str:
    """A table for a report. Reports are small: a result of more than ``most`` rows is refused (nothing else here brings rows to the driver)."""
    held = rows.limit(most + 1).collect()
    if len(held) > most:
        raise ValueError(f"a report's table has at most {most} rows")
    head = "| " + " | ".join(rows.columns) + " |\n|" + " --- |" * len(rows.columns)
    return head + "".join("\n| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in held)
