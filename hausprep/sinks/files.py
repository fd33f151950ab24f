"""Sinks (W1-W4): dated CSV, Parquet, JDBC and table export."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from hausprep.sources.catalog import qualified, table_exists
from hausprep.sources.files import CSV_OPTIONS, empty_guard


def dated_name(prefix: str, date: _dt.date | None = None, suffix: str = ".csv") -> str:
    d = date or _dt.date.today()
    return f"{prefix}_{d.strftime('%Y%m%d')}{suffix}"


def write_csv_dated(df: DataFrame, directory: str, *, prefix: str = "cleaned_canada",
                    date: _dt.date | None = None, single_file: bool = False) -> str:
    """CSV with a header, named ``<prefix>_YYYYMMDD.csv`` (a directory of
    part files, written in parallel).  ``single_file`` funnels the rows into
    one task and is meant for small outputs only."""
    path = f"{directory.rstrip('/')}/{dated_name(prefix, date)}"
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None, options: Mapping[str, str] | None = None) -> str:
    """Parquet (column names with spaces round-trip); ``options`` are those of Spark's writer."""
    w = df.write.mode(mode).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], *,
               mode: str = "append", batch_size: int = 10_000) -> None:
    """Append rows to a database table; every partition inserts in
    batches over its own connection."""
    props = {**dict(properties), "batchsize": str(batch_size)}
    df.write.jdbc(url, table, mode=mode, properties=props)


def export_table_csv(spark: SparkSession, table: str, directory: str, *, database: str | None = None,
                     prefix: str | None = None, date: _dt.date | None = None) -> dict:
    """Existence check, non-empty check, then all rows to a dated CSV.
    Returns a report ``{table, status, path}``."""
    if not table_exists(spark, table, database):
        return {"table": table, "status": "missing", "path": None}
    df = spark.table(qualified(database, table))
    frame, status = empty_guard(df, policy="stop", name=table)
    if frame is None:
        return {"table": table, "status": "empty", "path": None}
    path = write_csv_dated(frame, directory, prefix=prefix or table, date=date)
    return {"table": table, "status": "exported", "path": path}
