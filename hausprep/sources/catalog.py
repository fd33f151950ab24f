"""Table sources: catalog zones (S6, S7), JDBC (S5) and table creation /
loading (C4, C6).

A "zone" is a catalog database (for example ``landing`` and ``formatted``);
its tables are regular Spark tables in the session's catalog.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hausprep.operators.common import quote
from hausprep.sources import fs


def qualified(database: str | None, table: str) -> str:
    return f"{quote(database)}.{quote(table)}" if database else quote(table)


def create_zone(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create a catalog database if it does not exist."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(database)}{loc}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """S6 + K3: names of the tables of a zone, sorted."""
    return (spark.sql(f"SHOW TABLES IN {quote(database)}")
            .where(~F.col("isTemporary"))
            .select(F.col("tableName").alias("name"))
            .orderBy("name"))


def table_exists(spark: SparkSession, table: str, database: str | None = None) -> bool:
    """S7."""
    return spark.catalog.tableExists(qualified(database, table))


def scan_table(spark: SparkSession, table: str, database: str | None = None) -> tuple[DataFrame, str]:
    """Read a whole table; a missing table yields an empty frame and a message."""
    if not table_exists(spark, table, database):
        return spark.createDataFrame([], T.StructType([])), f"table {table} not found"
    return spark.table(qualified(database, table)), "ok"


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Read a database table.  With a numeric ``partition_column`` and
    bounds the read is split into ``num_partitions`` parallel range
    queries; filters on the result are pushed into the database's SQL.
    Use :func:`scan_jdbc_or_empty` when a missing table is not an error."""
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions,
                               properties=dict(properties))
    return spark.read.jdbc(url, table, properties=dict(properties))


#: How databases say that a table is not there.
_MISSING_TABLE = re.compile(
    r"(relation|table|object|view)\b.{0,200}(does ?n[o']t exist|not found|doesn't exist)|no such table|"
    r"unknown table|invalid object name|ORA-00942", re.IGNORECASE | re.DOTALL)


def scan_jdbc_or_empty(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
                       **kw) -> tuple[DataFrame, str]:
    """S5 where a missing table is not an error: it gives an empty frame and
    a message.  Any other failure (no connection, bad driver, password) is
    raised.  The schema is resolved when the reader is created, so the check
    costs no data read."""
    try:
        return scan_jdbc(spark, url, table, properties, **kw), "ok"
    except Exception as e:  # noqa: BLE001 - the driver's message varies per database
        if not _MISSING_TABLE.search(str(e)):
            raise
        return spark.createDataFrame([], T.StructType([])), f"table {table} not readable: {str(e)[:300]}"


def create_if_not_exists(spark: SparkSession, table: str, schema: T.StructType, database: str | None = None,
                         *, fmt: str = "parquet") -> bool:
    """C4: create an empty table with ``schema`` unless it exists.
    Returns True when the table was created."""
    if table_exists(spark, table, database):
        return False
    cols = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified(database, table)} ({cols}) USING {fmt}")
    return True


def _aligned(df: DataFrame, table: str, database: str | None) -> DataFrame:
    """The columns of the table, by name and in its types."""
    target = df.sparkSession.table(qualified(database, table)).schema
    given = {c.lower() for c in df.columns}
    extra = sorted(given - {f.name.lower() for f in target.fields})
    if extra:
        raise ValueError(f"table {table} has no columns {extra}")
    return df.select(*[(F.col(quote(f.name)) if f.name.lower() in given else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in target.fields])


def append_load(df: DataFrame, table: str, database: str | None = None, *, mode: str = "append",
                run_id: str | None = None) -> int:
    """Insert all rows into an existing table (columns matched by name,
    cast to the table's types).  Returns the number of rows written,
    counted during the write itself (no second pass).

    A column that the table lacks raises; one that the frame lacks is null.
    Spark commits a file-based table write as one job: a single writer's
    rows appear together.

    With ``run_id`` the load can be repeated: see :func:`load_once`."""
    if run_id is not None:
        if mode != "append":
            raise ValueError("a load with a run id appends")
        return load_once(df, table, run_id, database)
    spark = df.sparkSession
    obs = Observation(f"load_{table}")
    _aligned(df, table, database).observe(obs, F.count(F.lit(1)).alias("rows")).write.insertInto(
        qualified(database, table), overwrite=(mode == "overwrite"))
    return int(obs.get["rows"])


def _file_table(spark: SparkSession, table: str, database: str | None) -> tuple[str, str]:
    """Location and format of an unpartitioned table of files."""
    described = {r["col_name"]: r["data_type"] for r in
                 spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(database, table)}").collect()}
    if "# Partition Information" in described:
        raise ValueError(f"table {table} is partitioned: a load with a run id writes to unpartitioned tables")
    return described["Location"], described["Provider"].lower()


def load_once(df: DataFrame, table: str, run_id: str, database: str | None = None) -> int:
    """C6 as often as needed: the rows of a run are in the table once, however often the
    run failed on the way or is repeated.  Returns the rows added, 0 if the run was complete before.

    1. The rows are written to a staging folder of the run inside the table's folder (readers pass
       over names that begin with ``_``).  A run that fails here leaves the table as it was, and
       the next attempt writes the folder anew.
    2. Its files, complete and closed, move to the table under names that begin with the run id.
       An attempt that fails between two moves is taken up by the next one with the same files.
    3. An empty marker ends the run; a run with a marker adds nothing.

    Only file names pass through the driver.  One writer per run id at a time."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", run_id):
        raise ValueError(f"a run id is of letters, digits, dots, dashes and underscores: {run_id!r}")
    spark = df.sparkSession
    rows = _aligned(df, table, database)
    location, fmt = _file_table(spark, table, database)
    run = f"{location}/_loads/{run_id}"
    staged, closed = f"{run}/staged", f"{run}/closed"
    if fs.exists(spark, closed):
        return 0
    if not fs.exists(spark, f"{staged}/_SUCCESS"):
        rows.write.mode("overwrite").format(fmt).save(staged)
    moved = [p for n, p in fs.list_names(spark, location) if n.startswith(f"{run_id}-part-")]
    for name, path in fs.list_names(spark, staged):
        target = f"{location}/{run_id}-{name}"
        fs.rename(spark, path, target)
        moved.append(target)
    spark.catalog.refreshTable(qualified(database, table))
    added = spark.read.schema(rows.schema).format(fmt).load(moved).count() if moved else 0
    fs.touch(spark, closed)
    return added
