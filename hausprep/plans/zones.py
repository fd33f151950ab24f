"""Moving tables: files -> Parquet with deduplication (P3), a CSV directory
-> typed catalog tables (P4), and every table of one zone -> another (P5).

The driver loops over *names* (files, tables) only; every table is its own
distributed read -> write job, several run concurrently.  A failing item
does not stop the others: the result is a report frame
``(item, table_name, status, rows, message)``.
"""

from __future__ import annotations

import re
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hausprep.operators.common import qcol
from hausprep.operators.schema import apply_types, inferred_schema, na_tokens, nan_to_null
from hausprep.operators.setops import column_fingerprints, distinct_columns, distinct_rows
from hausprep.session import materialize, read_parquet_with, scratch_scope
from hausprep.sinks.files import write_parquet
from hausprep.sources import fs
from hausprep.sources.catalog import append_load, create_if_not_exists, list_tables, qualified
from hausprep.sources.files import csv_names, empty_guard, read_csv_text, scan_csv_dir
from hausprep.vocabularies import CLEANED_FILE_MARKER

PARQUET_OPTIONS = {"compression": "zstd"}
#: Small row groups: a task reads whole ones.
RAW_OPTIONS = PARQUET_OPTIONS | {"parquet.block.size": str(16 << 20)}
TASK_TEXT = 128 << 20
LEAST_SPLIT = 1 << 20
#: More reduce tasks than these only if the session asks for them.
MOST_PARTITIONS = 2000

REPORT_SCHEMA = "item string, table_name string, status string, rows bigint, message string"


def _report(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def table_name_for(file_name: str) -> str:
    """File name -> table name: extension removed, lower case, every run of
    other characters than letters, digits and ``_`` replaced by ``_``."""
    stem = file_name.rsplit(".", 1)[0]
    return re.sub(r"[^0-9a-zA-Z_]+", "_", stem).strip("_").lower() or "table"


def _read_in_small_tasks(spark: SparkSession, path: str, text_bytes: int) -> DataFrame:
    """The Parquet table at ``path``, which holds so much text.  A task that reads it gets about ``TASK_TEXT`` bytes of that,
    and a reduce task no more than twice as much before rows meet, so that neither spills its hash table.  Parquet packs
    repetitive text tightly: by the size of the files alone, a task could get gigabytes of rows."""
    as_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    split = max(sum(fs.sizes(spark, path)) * TASK_TEXT // max(text_bytes, 1), LEAST_SPLIT)
    partitions = min(text_bytes // (2 * TASK_TEXT) + 1, MOST_PARTITIONS)
    return read_parquet_with(spark, path, {
        "spark.sql.files.maxPartitionBytes": str(min(split, as_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))),
        "spark.sql.shuffle.partitions": str(max(partitions, int(spark.conf.get("spark.sql.shuffle.partitions"))))})


def dedupe_files(spark: SparkSession, source_dir: str, work_dir: str, *, multi_line: bool = True) -> DataFrame:
    """All CSVs of a directory, missing-value markers made null (C1) ->
    one raw Parquet table -> duplicate rows and columns removed -> clean
    Parquet table (returned, read back).  ``multi_line=False`` lets large
    files without line breaks inside cells be read by many tasks.

    All cells are text here, so columns are equal on the raw rows if and only if they are on the distinct ones.  The
    copies go first: they are not shuffled, and no table of distinct rows stands between.  The fingerprints of U3 have a
    scan of the raw table of their own: observed in its write, they took more than twice the time."""
    raw_path = f"{work_dir.rstrip('/')}/raw_data.parquet"
    clean_path = f"{work_dir.rstrip('/')}/cleaned_data.parquet"
    write_parquet(na_tokens(scan_csv_dir(spark, source_dir, source_column=None, multi_line=multi_line)), raw_path, options=RAW_OPTIONS)
    raw = spark.read.parquet(raw_path)
    text = reduce(Column.__add__, [F.coalesce(F.octet_length(qcol(c)), F.lit(0)) for c in raw.columns])
    found = column_fingerprints(raw, F.sum(text.cast("bigint")).alias("text_bytes"))
    raw = _read_in_small_tasks(spark, raw_path, found["text_bytes"] or 0)
    write_parquet(distinct_rows(distinct_columns(raw, fingerprints=found), packed=True), clean_path, options=PARQUET_OPTIONS)
    return spark.read.parquet(clean_path)


def load_typed(df: DataFrame, table: str, database: str, *, from_text: bool = True, run_id: str | None = None) -> int:
    """C3 -> C5 -> C4 -> C6 for one frame; returns rows written (with ``run_id``, none if that run was complete).

    ``from_text=False``: the frame has types of its own, so text stays text
    but for the dates that C3 finds by name and value."""
    types = inferred_schema(df)
    if not from_text:
        types = {c: t if t == "timestamp" or t.startswith("date") or kind != "string" else "string"
                 for (c, t), (_, kind) in zip(types.items(), df.dtypes)}
    typed = nan_to_null(apply_types(df, types))
    create_if_not_exists(df.sparkSession, table, typed.schema, database)
    return append_load(typed, table, database, run_id=run_id)


def _run_isolated(items: list, work, parallelism: int) -> list[tuple]:
    """Run ``work(item) -> report row`` for every item; a failure becomes a
    ``failed`` row.  Up to ``parallelism`` items run at once: each is its own
    Spark job, and concurrent jobs keep a large cluster busy when single
    tables are small.  Report rows keep the input order."""

    def guarded(item):
        try:
            return work(item)
        except Exception as e:  # noqa: BLE001 - isolate failures per item
            name, table = item
            return (name, table, "failed", None, f"{type(e).__name__}: {str(e)[:500]}")

    if parallelism <= 1 or len(items) <= 1:
        return [guarded(i) for i in items]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(guarded, items))


def import_directory(spark: SparkSession, directory: str, database: str,
                     marker: str = CLEANED_FILE_MARKER, *, parallelism: int = 4,
                     multi_line: bool = True, run_id: str | None = None) -> DataFrame:
    """Every CSV of a directory (except files named with ``marker``),
    missing-value markers made null (C1), into a typed table of
    ``database``; one report row per file.  Files whose names give the same
    table name are not loaded but reported as failed.

    With ``run_id`` a failed run can be repeated: what it had loaded is not loaded again."""
    included, excluded = csv_names(spark, directory, marker)
    base = directory.rstrip("/")
    rows = [(name, None, "excluded", None, f"name contains {marker}") for name in excluded]
    per_table = Counter(map(table_name_for, included))

    def load(item):
        name, table = item
        if per_table[table] > 1:
            raise ValueError(f"{per_table[table]} files give the table name {table}")
        with scratch_scope(spark):      # the file is parsed once; inference and load read the parsed rows
            rows = materialize(na_tokens(read_csv_text(spark, f"{base}/{name}", multi_line=multi_line)), "import")
            n = load_typed(rows, table, database, run_id=run_id)
        return (name, table, "loaded", n, None)

    rows += _run_isolated([(n, table_name_for(n)) for n in included], load, parallelism)
    return _report(spark, rows)


def transfer_zone(spark: SparkSession, source_db: str, target_db: str, *,
                  parallelism: int = 4, run_id: str | None = None) -> DataFrame:
    """P5: every table of ``source_db`` -> typed table of ``target_db``;
    empty tables are skipped, failures reported.  With ``run_id`` a failed
    run can be repeated: what it had moved is not moved again."""

    def move(item):
        table, _ = item
        src = spark.table(qualified(source_db, table))
        frame, _status = empty_guard(src, policy="skip", name=table)
        if frame is None:
            return (table, table, "skipped", 0, "empty table")
        return (table, table, "transferred", load_typed(frame, table, target_db, from_text=False, run_id=run_id), None)

    tables = [r[0] for r in list_tables(spark, source_db).collect()]
    return _report(spark, _run_isolated([(t, t) for t in tables], move, parallelism))
