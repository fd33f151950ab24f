"""Registered sources, sinks, load preparation and zone moves (S*, C*, W*,
P3-P5).  Each query writes data derived from the supplied tables to a
fresh folder under the session's shared checkpoint directory and reads it
back through the operator under test."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hausprep.operators.schema import dedupe_columns, infer_types, na_tokens, nan_to_null
from hausprep.plans.zones import dedupe_files, import_directory, transfer_zone
from hausprep.registry.core import register
from hausprep.registry.fixtures import LISTING_COLUMN_NAMES, LISTING_CTE, listing_view, sql_str, table
from hausprep.session import scratch_path
from hausprep.sinks.files import export_table_csv, write_csv_dated, write_parquet
from hausprep.sources import fs
from hausprep.sources.catalog import (
    append_load,
    create_if_not_exists,
    create_zone,
    list_tables,
    table_exists,
)
from hausprep.sources.files import (
    CSV_OPTIONS,
    empty_guard,
    read_csv_text,
    scan_csv_dir,
    scan_csv_excluding,
    scan_csv_files,
    scan_parquet,
    scan_regions,
)
from hausprep.vocabularies import NA_TOKENS, REGION_CODES

W = f"WITH {LISTING_CTE}"
FIXED_DATE = _dt.date(2024, 1, 1)


def write_csv(df: DataFrame, path: str, **options: str) -> str:
    df.write.mode("overwrite").options(**CSV_OPTIONS, **options).csv(path)
    return path


#: For large CSV inputs: compressed (quickly), in parts that one task reads whole.
COMPRESSED_PARTS = {"compression": "gzip", "zlib.compress.level": "THREE", "maxRecordsPerFile": "1000000"}


def zone(spark: SparkSession, name: str) -> str:
    """A fresh catalog database located in the shared scratch folder."""
    db = f"{name}_{uuid.uuid4().hex[:10]}"
    create_zone(spark, db, scratch_path(spark, db))
    return db


CUSTOMER_TYPES = [("c_custkey", "bigint"), ("c_name", None), ("c_nationkey", "int"),
                  ("c_acctbal", "double"), ("c_mktsegment", None)]


def typed_customer(df: DataFrame, *extra: str) -> DataFrame:
    """Text columns of a customer CSV back to the table's types."""
    cols = [F.col(c).cast(t).alias(c) if t else F.col(c) for c, t in CUSTOMER_TYPES]
    return df.select(*cols, *extra)


# ---- S1 - S4 -------------------------------------------------------------------------

REGION_LIST_SQL = "[" + ", ".join(sql_str(c) for c in REGION_CODES) + "]"


@register("scan_regions", f"""{W}
SELECT {', '.join('CAST(listing_id AS VARCHAR) AS listing_id' if c == 'listing_id' else c
                  for c in LISTING_COLUMN_NAMES)},
       {REGION_LIST_SQL}[listing_id % 11 + 1] AS source
FROM listings""")
def q_scan_regions(spark, sf):
    """The listing view written as one CSV per region code, scanned back."""
    v = listing_view(spark, sf)
    code = F.element_at(F.array(*[F.lit(c) for c in REGION_CODES]), (F.col("listing_id") % 11 + 1).cast("int"))
    staging = scratch_path(spark, "regions_staging")
    v.withColumn("__file", F.concat(F.lit("data_"), code, F.lit(".csv"))).write.partitionBy("__file") \
        .options(**CSV_OPTIONS).csv(staging)
    regions = scratch_path(spark, "regions")
    for c in REGION_CODES:
        src = f"{staging}/__file=data_{c}.csv"
        if fs.exists(spark, src):
            fs.rename(spark, src, f"{regions}/data_{c}.csv")
    return scan_regions(spark, regions).frame


CUSTOMER_AB_SQL = """
SELECT c_custkey, c_name, c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment,
       '{a}' AS source FROM {t}
UNION ALL
SELECT c_custkey, NULL, NULL, c_acctbal, c_mktsegment, '{b}' AS source FROM {t}"""


def _two_customer_files(spark, sf, directory, a, b):
    c = table(spark, sf, "customer")
    write_csv(c.select("c_custkey", "c_name", "c_nationkey"), f"{directory}/{a}")
    write_csv(c.select("c_custkey", "c_acctbal", "c_mktsegment"), f"{directory}/{b}")


@register("scan_csv_dir", CUSTOMER_AB_SQL.format(a="customer_a.csv", b="customer_b.csv", t="customer"))
def q_scan_csv_dir(spark, sf):
    """Two CSV files with different column sets, unioned by name."""
    d = scratch_path(spark, "csv_dir")
    _two_customer_files(spark, sf, d, "customer_a.csv", "customer_b.csv")
    return typed_customer(scan_csv_dir(spark, d), "source")


@register("scan_csv_excluding", CUSTOMER_AB_SQL.format(a="customer_a.csv", b="customer_b.csv", t="customer"))
def q_scan_csv_excluding(spark, sf):
    """S3: as S2 plus a file named with the excluded marker (a full copy of
    the table) that must not be read."""
    d = scratch_path(spark, "csv_excl")
    _two_customer_files(spark, sf, d, "customer_a.csv", "customer_b.csv")
    write_csv(table(spark, sf, "customer"), f"{d}/Cleaned_Canada_20240101.csv")
    res = scan_csv_excluding(spark, d)
    return typed_customer(res.frame, "source")


@register("scan_parquet", "SELECT * FROM orders")
def q_scan_parquet(spark, sf):
    """S4 over a Parquet copy of ``orders``."""
    path = write_parquet(table(spark, sf, "orders"), scratch_path(spark, "orders_parquet"))
    return scan_parquet(spark, path)


# ---- S6 - S8 -------------------------------------------------------------------------

ZONE_TABLES = ["customer", "orders", "supplier"]


@register("list_tables", " UNION ALL ".join(
    f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in ZONE_TABLES))
def q_list_tables(spark, sf):
    """S6 + K3: tables of a zone, sorted by name, with their row counts."""
    db = zone(spark, "landing")
    for t in ZONE_TABLES:
        table(spark, sf, t).write.saveAsTable(f"{db}.{t}")
    names = [r["name"] for r in list_tables(spark, db).collect()]
    parts = [spark.table(f"{db}.{n}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows")
             for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("table_exists", """
SELECT 'orders' AS name, true AS found, count(*) AS rows FROM orders
UNION ALL SELECT 'no_such_table', false, CAST(0 AS BIGINT)""")
def q_table_exists(spark, sf):
    """One present and one absent table; rows of the present one."""
    db = zone(spark, "landing")
    table(spark, sf, "orders").write.saveAsTable(f"{db}.orders")
    parts = []
    for name in ["orders", "no_such_table"]:
        if table_exists(spark, name, db):
            parts.append(spark.table(f"{db}.{name}").agg(F.count(F.lit(1)).alias("rows"))
                         .select(F.lit(name).alias("name"), F.lit(True).alias("found"), "rows"))
        else:
            parts.append(spark.range(1).select(F.lit(name).alias("name"), F.lit(False).alias("found"),
                                               F.lit(0).cast("bigint").alias("rows")))
    return parts[0].unionByName(parts[1])


@register("empty_guard", """
SELECT 'lineitem' AS name, 'ok' AS status, count(*) AS rows FROM lineitem
UNION ALL SELECT 'lineitem_negative_qty', 'skipped', CAST(0 AS BIGINT)""")
def q_empty_guard(spark, sf):
    """The whole table passes, an empty selection is skipped."""
    li = table(spark, sf, "lineitem")
    parts = []
    for name, df in [("lineitem", li), ("lineitem_negative_qty", li.where(F.col("l_quantity") < 0))]:
        frame, status = empty_guard(df, policy="skip", name=name)
        if frame is None:
            parts.append(spark.range(1).select(F.lit(name).alias("name"), F.lit(status).alias("status"),
                                               F.lit(0).cast("bigint").alias("rows")))
        else:
            parts.append(frame.agg(F.count(F.lit(1)).alias("rows"))
                         .select(F.lit(name).alias("name"), F.lit(status).alias("status"), "rows"))
    return parts[0].unionByName(parts[1])


# ---- C1 - C6 -------------------------------------------------------------------------

NA_CHOICES = NA_TOKENS + ["none", " NA"]
NA_SQL_LIST = "[" + ", ".join(sql_str(t) for t in NA_CHOICES) + "]"
N_CHOICES = len(NA_CHOICES)


@register("na_tokens", f"""
SELECT c_custkey,
  CASE WHEN c_custkey % 25 < {len(NA_TOKENS)} THEN NULL
       WHEN c_custkey % 25 < {N_CHOICES} THEN {NA_SQL_LIST}[c_custkey % 25 + 1]
       ELSE c_mktsegment END AS segment
FROM customer""")
def q_na_tokens(spark, sf):
    """NA markers injected into a text column become null; lower-case
    and padded spellings stay."""
    c = table(spark, sf, "customer")
    slot = (F.col("c_custkey") % 25).cast("int")
    text = F.when(slot < N_CHOICES, F.element_at(F.array(*[F.lit(t) for t in NA_CHOICES]), slot + 1)) \
        .otherwise(F.col("c_mktsegment"))
    return na_tokens(c.select("c_custkey", text.alias("segment")), ["segment"])


@register("dedupe_column_names", """
SELECT o_orderkey AS key, o_custkey AS customer, o_totalprice AS price, o_orderkey AS key_2, o_custkey AS key_1
FROM orders""")
def q_dedupe_column_names(spark, sf):
    """Repeated names become name_n, bumped past names already taken."""
    o = table(spark, sf, "orders")
    dup = o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderkey", "o_custkey") \
        .toDF("key", "customer", "price", "key", "key_1")
    return dedupe_columns(dup)


#: The date columns that the query adds to ``orders``: DuckDB's format for writing each, two where values differ.
WRITTEN_DATES = {"us_date": ["%m/%d/%Y"], "european_date": ["%d/%m/%Y"], "spelled_date": ["%B %d, %Y"], "short_date": ["%d %b %Y"],
                 "mixed_date": ["%Y-%m-%d", "%m/%d/%Y"], "dotted_date": ["%d.%m.%Y"]}
SPARK_FORMAT = {"%m/%d/%Y": "MM/dd/yyyy", "%d/%m/%Y": "dd/MM/yyyy", "%B %d, %Y": "MMMM dd, yyyy", "%d %b %Y": "dd MMM yyyy",
                "%Y-%m-%d": "yyyy-MM-dd", "%d.%m.%Y": "dd.MM.yyyy"}
READ_DATES = [("M/d/yyyy", "%m/%d/%Y"), ("d/M/yyyy", "%d/%m/%Y"), ("d.M.yyyy", "%d.%m.%Y"), ("MMMM d, yyyy", "%B %d, %Y"),
              ("d MMM yyyy", "%d %b %Y")]


def _infer_sql():
    cols = {
        "o_orderkey": "o_orderkey", "o_custkey": "o_custkey", "o_orderstatus": "o_orderstatus",
        "o_totalprice": "o_totalprice", "o_orderdate": "o_orderdate", "o_orderpriority": "o_orderpriority",
        "custkey_gappy": "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey END",
        "is_finished": "o_orderstatus = 'F'",
        "all_missing": "CAST(NULL AS VARCHAR)",
    }
    for name, formats in WRITTEN_DATES.items():
        even, odd = (f"strftime(o_orderdate, '{f}')" for f in (formats[0], formats[-1]))
        cols[name] = f"CASE WHEN o_orderkey % 2 = 0 THEN {even} ELSE {odd} END"
    parts = []
    for i, (name, expr) in enumerate(cols.items()):
        x = f"CAST({expr} AS VARCHAR)"
        none_of = f"count_if({x} IS NOT NULL AND {{}} IS NULL) = 0"
        date_rule, format_rule = "", "NULL"
        if "date" in name:
            iso = none_of.format(f"TRY_CAST({x} AS TIMESTAMP)")
            read = [(spark_format, none_of.format(f"try_strptime({x}, '{f}')")) for spark_format, f in READ_DATES]
            date_rule = f"WHEN {iso} OR {' OR '.join(r for _, r in read)} THEN 'date' "
            format_rule = f"CASE WHEN {iso} THEN NULL {' '.join(f'WHEN {r} THEN {sql_str(f)}' for f, r in read)} END"
        parts.append(f"""SELECT {i} AS ordinal, '{name}' AS column_name, CASE
  WHEN count({x}) = 0 THEN 'double'
  WHEN count_if({x} IS NOT NULL AND NOT regexp_full_match({x}, '[+-]?[0-9]+')) = 0
       THEN (CASE WHEN count({x}) = count(*) THEN 'bigint' ELSE 'double' END)
  WHEN count_if({x} IS NOT NULL AND TRY_CAST({x} AS DOUBLE) IS NULL) = 0 THEN 'double'
  WHEN count_if({x} IS NOT NULL AND lower({x}) NOT IN ('true', 'false')) = 0 AND count({x}) = count(*) THEN 'boolean'
  {date_rule}ELSE 'string' END AS inferred_type, CAST({format_rule} AS VARCHAR) AS date_format FROM orders""")
    return " UNION ALL ".join(parts)


@register("infer_types", _infer_sql())
def q_infer_types(spark, sf):
    """``orders`` plus a gappy integer, a true/false, an all-missing column and dates
    in several formats, written as CSV and read back as text."""
    o = table(spark, sf, "orders")
    written = {name: F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", SPARK_FORMAT[formats[0]]))
               .otherwise(F.date_format("o_orderdate", SPARK_FORMAT[formats[-1]])) for name, formats in WRITTEN_DATES.items()}
    o = o.select("*", F.when(F.col("o_orderkey") % 10 == 0, F.lit(None)).otherwise(F.col("o_custkey"))
                 .alias("custkey_gappy"),
                 (F.col("o_orderstatus") == "F").alias("is_finished"),
                 F.lit(None).cast("string").alias("all_missing"), *[c.alias(name) for name, c in written.items()])
    path = write_csv(o, scratch_path(spark, "infer_csv"))
    return infer_types(read_csv_text(spark, path, multi_line=False))


@register("scan_malformed", """
SELECT CASE c_custkey % 10 WHEN 0 THEN 'too_long' WHEN 1 THEN 'too_short' ELSE 'row' END AS kind,
       c_custkey || ',"' || c_name || chr(10) || 'x"' || CASE c_custkey % 10 WHEN 0 THEN ',' || c_nationkey || ',extra' WHEN 1 THEN ''
         ELSE ',' || c_nationkey END AS record FROM customer""")
def q_scan_malformed(spark, sf):
    """S2 with malformed records in quarantine: a file in which every tenth record has a cell too many and
    every tenth one too few, and a line break in every second cell."""
    c = table(spark, sf, "customer")
    rest = F.when(F.col("c_custkey") % 10 == 0, F.concat(F.lit(","), "c_nationkey", F.lit(",extra"))) \
        .when(F.col("c_custkey") % 10 == 1, F.lit("")).otherwise(F.concat(F.lit(","), "c_nationkey"))
    record = F.concat(F.col("c_custkey").cast("string"), F.lit(',"'), "c_name", F.lit('\nx"'), rest)
    d = scratch_path(spark, "malformed")
    lines = c.select(F.explode(F.split(record, "\n")).alias("id,name,nation"))
    lines.write.options(header="true", quote="\x02", escapeQuotes="false", sep="\x01").csv(f"{d}/customer.csv")     # as they are
    scan = scan_csv_files(spark, d, malformed="quarantine")
    good = scan.frame.select(F.lit("row").alias("kind"), F.concat("id", F.lit(',"'), "name", F.lit('",'), "nation").alias("record"))
    return good.unionByName(scan.rejected.select(F.col("reason").alias("kind"), "record"))


@register("nan_to_null", "SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS value FROM events")
def q_nan_to_null(spark, sf):
    """NaN injected into a double column -> null."""
    e = table(spark, sf, "events")
    v = F.when(F.col("event_id") % 9 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return nan_to_null(e.select("event_id", v.alias("value")))


@register("create_if_not_exists", "SELECT *, true AS created_first, false AS created_again FROM customer")
def q_create_if_not_exists(spark, sf):
    """C4: created once (a second call finds it), then loaded."""
    db = zone(spark, "formatted")
    c = table(spark, sf, "customer")
    first = create_if_not_exists(spark, "customer", c.schema, db)
    again = create_if_not_exists(spark, "customer", c.schema, db)
    append_load(c, "customer", db)
    return spark.table(f"{db}.customer").select("*", F.lit(first).alias("created_first"),
                                                F.lit(again).alias("created_again"))


@register("append_load", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def q_append_load(spark, sf):
    """Appending the same load twice keeps both copies."""
    db = zone(spark, "formatted")
    c = table(spark, sf, "customer")
    create_if_not_exists(spark, "customer", c.schema, db)
    append_load(c, "customer", db)
    append_load(c.select(*reversed(c.columns)), "customer", db)
    return spark.table(f"{db}.customer")


# ---- W1, W2, W4 ------------------------------------------------------------------------

@register("write_csv_dated", "SELECT * FROM customer")
def q_write_csv_dated(spark, sf):
    """Dated CSV round trip."""
    path = write_csv_dated(table(spark, sf, "customer"), scratch_path(spark, "out"), date=FIXED_DATE)
    assert path.endswith("cleaned_canada_20240101.csv"), path
    return typed_customer(read_csv_text(spark, path))


@register("write_parquet", "SELECT * FROM lineitem")
def q_write_parquet(spark, sf):
    """Parquet round trip, partitioned by return flag."""
    path = write_parquet(table(spark, sf, "lineitem"), scratch_path(spark, "lineitem_pq"),
                         partition_by=["l_returnflag"])
    return spark.read.parquet(path)


@register("export_table_csv", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'exported' AS status FROM supplier")
def q_export_table_csv(spark, sf):
    """A catalog table exported to a dated CSV and read back."""
    db = zone(spark, "formatted")
    table(spark, sf, "supplier").write.saveAsTable(f"{db}.supplier")
    report = export_table_csv(spark, "supplier", scratch_path(spark, "export"), database=db, date=FIXED_DATE)
    back = read_csv_text(spark, report["path"])
    return back.select(F.col("s_suppkey").cast("bigint").alias("s_suppkey"), "s_name",
                       F.col("s_nationkey").cast("int").alias("s_nationkey"),
                       F.col("s_acctbal").cast("double").alias("s_acctbal"),
                       F.lit(report["status"]).alias("status"))


# ---- P3 - P5 ---------------------------------------------------------------------------

@register("dedupe_files", f"""{W}
SELECT DISTINCT {', '.join('CAST(listing_id AS VARCHAR) AS listing_id' if c == 'listing_id' else c
                           for c in LISTING_COLUMN_NAMES)} FROM listings""")
def q_dedupe_files(spark, sf):
    """Two CSV loads of the listing view (each with a copied price
    column) -> raw Parquet -> duplicate rows and columns removed."""
    d = scratch_path(spark, "dedupe_src")
    v = listing_view(spark, sf)
    v = v.withColumn("price_copy", F.col("price"))
    write_csv(v, f"{d}/listings_monday.csv", **COMPRESSED_PARTS)
    write_csv(v, f"{d}/listings_tuesday.csv", **COMPRESSED_PARTS)
    return dedupe_files(spark, d, scratch_path(spark, "dedupe_work"))


@register("import_directory", """
SELECT 'Cleaned_Canada_20240101.csv' AS item, CAST(NULL AS VARCHAR) AS table_name, 'excluded' AS status,
       CAST(NULL AS BIGINT) AS rows, 'name contains cleaned_canada' AS message
UNION ALL SELECT 'customer.csv', 'customer', 'loaded', count(*), NULL FROM customer
UNION ALL SELECT 'orders.csv', 'orders', 'loaded', count(*), NULL FROM orders""")
def q_import_directory(spark, sf):
    """A CSV directory -> typed tables; the marker file is skipped."""
    d = scratch_path(spark, "import_src")
    write_csv(table(spark, sf, "customer"), f"{d}/customer.csv")
    write_csv(table(spark, sf, "orders"), f"{d}/orders.csv")
    write_csv(table(spark, sf, "supplier"), f"{d}/Cleaned_Canada_20240101.csv")
    return import_directory(spark, d, zone(spark, "landing"))


@register("transfer_zone", """
SELECT 'customer' AS item, 'customer' AS table_name, 'transferred' AS status, count(*) AS rows,
       CAST(NULL AS VARCHAR) AS message FROM customer
UNION ALL SELECT 'customer_none', 'customer_none', 'skipped', CAST(0 AS BIGINT), 'empty table'
UNION ALL SELECT 'orders_text', 'orders_text', 'transferred', count(*), NULL FROM orders""")
def q_transfer_zone(spark, sf):
    """P5: every table of a landing zone -> formatted zone; the empty
    table is skipped, the all-text table keeps its text."""
    src, dst = zone(spark, "landing"), zone(spark, "formatted")
    c = table(spark, sf, "customer")
    c.write.saveAsTable(f"{src}.customer")
    c.where(F.col("c_custkey") < 0).write.saveAsTable(f"{src}.customer_none")
    o = table(spark, sf, "orders")
    o.select(*[F.col(x).cast("string").alias(x) for x in o.columns]).write.saveAsTable(f"{src}.orders_text")
    report = transfer_zone(spark, src, dst)
    # what a zone holds as text stays text
    types = dict(spark.table(f"{dst}.orders_text").dtypes)
    assert types["o_orderkey"] == "string" and types["o_totalprice"] == "string", types
    return report


def _loaded(spark, db, tables: dict[str, list[str]]) -> DataFrame:
    """Rows of loaded tables as text, with the types of their columns: ``table_name, types, cells``."""
    out = None
    for name, columns in tables.items():
        t = spark.table(f"{db}.{name}")
        kinds = ",".join(f"{c}:{k}" for c, k in t.dtypes)
        cells = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])
        rows = t.select(F.lit(name).alias("table_name"), F.lit(kinds).alias("types"), cells.alias("cells"))
        out = rows if out is None else out.unionByName(rows)
    return out


LOADED_CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
LOADED_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


def _loaded_sql(name: str, columns: list[str], types: str) -> str:
    text = lambda c: f"CAST(CAST({c} AS DATE) AS VARCHAR)" if c.endswith("date") else f"CAST({c} AS VARCHAR)"
    cells = " || '|' || ".join(f"coalesce({text(c)}, '-')" for c in columns)
    return f"SELECT '{name}' AS table_name, '{types}' AS types, {cells} AS cells FROM {name.removesuffix('_text')}"


IMPORTED_TYPES = {
    "customer": "c_custkey:bigint,c_name:string,c_nationkey:bigint,c_acctbal:double,c_mktsegment:string",
    "orders": "o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:date,o_orderpriority:string"}


@register("import_directory_tables", " UNION ALL ".join([
    _loaded_sql("customer", LOADED_CUSTOMER, IMPORTED_TYPES["customer"]), _loaded_sql("orders", LOADED_ORDERS, IMPORTED_TYPES["orders"])]))
def q_import_directory_tables(spark, sf):
    """The tables it loads, rows and types; the run is repeated with the same run id and adds nothing."""
    d, db = scratch_path(spark, "import_src"), zone(spark, "landing")
    write_csv(table(spark, sf, "customer"), f"{d}/customer.csv")
    write_csv(table(spark, sf, "orders"), f"{d}/orders.csv")
    for _ in range(2):
        import_directory(spark, d, db, run_id="monday")
    return _loaded(spark, db, {"customer": LOADED_CUSTOMER, "orders": LOADED_ORDERS})


TRANSFERRED_TYPES = {
    "customer": "c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double,c_mktsegment:string",
    "orders_text": "o_orderkey:string,o_custkey:string,o_orderstatus:string,o_totalprice:string,o_orderdate:date,o_orderpriority:string"}


@register("transfer_zone_tables", " UNION ALL ".join([
    _loaded_sql("customer", LOADED_CUSTOMER, TRANSFERRED_TYPES["customer"]),
    _loaded_sql("orders_text", LOADED_ORDERS, TRANSFERRED_TYPES["orders_text"])]))
def q_transfer_zone_tables(spark, sf):
    """P5: the tables it loads, rows and types; the run is repeated with the same run id and adds nothing."""
    src, dst = zone(spark, "landing"), zone(spark, "formatted")
    table(spark, sf, "customer").write.saveAsTable(f"{src}.customer")
    o = table(spark, sf, "orders")
    o.select(*[F.col(x).cast("string").alias(x) for x in o.columns]).write.saveAsTable(f"{src}.orders_text")
    for _ in range(2):
        transfer_zone(spark, src, dst, run_id="monday")
    return _loaded(spark, dst, {"customer": LOADED_CUSTOMER, "orders_text": LOADED_ORDERS})


@register("order_by_name", """
SELECT row_number() OVER (ORDER BY name) AS position, name, rows FROM (
""" + " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in reversed(ZONE_TABLES)) + ")")
def q_order_by_name(spark, sf):
    """K3: table names of a zone in name order (the position is part of
    the result, so the order itself is checked)."""
    db = zone(spark, "landing")
    for t in reversed(ZONE_TABLES):
        table(spark, sf, t).write.saveAsTable(f"{db}.{t}")
    names = list_tables(spark, db).collect()
    parts = [spark.table(f"{db}.{r['name']}").agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(i + 1).cast("bigint").alias("position"), F.lit(r["name"]).alias("name"), "rows")
             for i, r in enumerate(names)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
