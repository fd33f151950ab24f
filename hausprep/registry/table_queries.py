"""Registered table operators: filters (F1-F8), set operations (U1-U4),
vocabularies (V1, V2), profiles (A1-A12) and top-k (K1, K2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hausprep import vocabularies as V
from hausprep.operators import filters as FL
from hausprep.operators import profile as P
from hausprep.operators import setops as S
from hausprep.operators.vocab import garage_vocab, vocab
from hausprep.registry.core import register
from hausprep.registry.fixtures import (
    LISTING_COLUMN_NAMES,
    LISTING_CTE,
    listing_view,
    sql_str,
    sql_vocab_tokens,
    table,
)

W = f"WITH {LISTING_CTE}"
REQUIRED = ["street_address", "address_locality", "address_region", "price"]


def r6(c):
    return F.round(c, 6)


# ---- F1 - F8 ------------------------------------------------------------------------------

@register("drop_incomplete", f"{W} SELECT * FROM listings WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED))
def q_drop_incomplete(spark, sf):
    return FL.drop_incomplete(listing_view(spark, sf), REQUIRED)


@register("range_filter", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
WHERE l_extendedprice >= 50000 AND l_quantity > 12""")
def q_range_filter(spark, sf):
    li = table(spark, sf, "lineitem")
    out = FL.range_filter(li, "l_extendedprice", lower=50000, lower_inclusive=True)
    out = FL.range_filter(out, "l_quantity", lower=12, lower_inclusive=False)
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@register("eq_filter_project", f"{W} SELECT listing_id, street_address, price FROM listings WHERE address_region = 'R3'")
def q_eq_filter_project(spark, sf):
    return FL.eq_filter_project(listing_view(spark, sf), "address_region", "R3",
                                ["listing_id", "street_address", "price"])


DROPPED = ["street_address", "features", "garage", "parking", "basement", "exterior", "fireplace",
           "heating", "flooring", "roof", "waterfront", "sewer"]


@register("drop_columns", f"{W} SELECT * EXCLUDE ({', '.join(DROPPED)}) FROM listings")
def q_drop_columns(spark, sf):
    return FL.drop_columns(listing_view(spark, sf), DROPPED)


RENAMES = {"address_locality": "City", "address_region": "Province", "beds": "Bedrooms",
           "baths": "Bathrooms", "price": "Price"}


@register("rename_columns", f"{W} SELECT " + ", ".join(
    f'{c} AS "{RENAMES[c]}"' if c in RENAMES else c for c in LISTING_COLUMN_NAMES) + " FROM listings")
def q_rename_columns(spark, sf):
    return FL.rename_columns(listing_view(spark, sf), RENAMES)


CAST_COLS = ["price", "beds", "baths", "acreage", "sqft_fallback"]


@register("cast_numeric", f"""{W}
SELECT listing_id, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in CAST_COLS)},
  CAST(replace(replace(sqft_primary, ' SQFT', ''), ',', '') AS DOUBLE) AS sqft FROM listings""")
def q_cast_numeric(spark, sf):
    v = listing_view(spark, sf)
    v = v.select("listing_id", *CAST_COLS, F.replace("sqft_primary", F.lit(" SQFT"), F.lit("")).alias("sqft"))
    return FL.cast_numeric(v, CAST_COLS + ["sqft"], strip_commas=["sqft"])


@register("select_columns", f"{W} SELECT listing_id, address_locality, price FROM listings")
def q_select_columns(spark, sf):
    return FL.select_columns(listing_view(spark, sf), ["listing_id", "address_locality", "price"])


@register("predicates", f"""{W}
SELECT CAST(count_if(garage IS NULL) AS BIGINT) AS garage_missing,
       CAST(count_if(features IS NOT NULL) AS BIGINT) AS features_present,
       CAST(count_if(address_region IN ('R1', 'R2')) AS BIGINT) AS region_r1_r2,
       CAST(count_if(garage IS NULL OR address_region IN ('R1', 'R2')) AS BIGINT) AS either
FROM listings""")
def q_predicates(spark, sf):
    v = listing_view(spark, sf)
    r12 = FL.in_list("address_region", ["R1", "R2"])
    return v.agg(F.count_if(FL.is_missing("garage")).alias("garage_missing"),
                 F.count_if(FL.is_present("features")).alias("features_present"),
                 F.count_if(r12).alias("region_r1_r2"),
                 F.count_if(FL.any_of(FL.is_missing("garage"), r12)).alias("either"))


# ---- U1 - U4 -------------------------------------------------------------------------------

@register("union_by_name", """
SELECT * FROM lineitem WHERE l_returnflag = 'R'
UNION ALL BY NAME
SELECT * EXCLUDE (l_tax) FROM lineitem WHERE l_returnflag <> 'R'""")
def q_union_by_name(spark, sf):
    li = table(spark, sf, "lineitem")
    first = li.where(F.col("l_returnflag") == "R")
    # the second part lacks a column and lists the others in another order
    second = li.where(F.col("l_returnflag") != "R").drop("l_tax")
    second = second.select(*reversed(second.columns))
    return S.union_by_name([first, second])


@register("distinct_rows", f"{W} SELECT DISTINCT * FROM (SELECT * FROM listings UNION ALL SELECT * FROM listings)")
def q_distinct_rows(spark, sf):
    v = listing_view(spark, sf)
    return S.distinct_rows(S.union_by_name([v, v]))


@register("distinct_columns", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CASE WHEN o_orderkey % 1000 = 7 THEN 'X' ELSE o_orderstatus END AS status_near_copy
FROM orders""")
def q_distinct_columns(spark, sf):
    o = table(spark, sf, "orders")
    o = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                 F.col("o_totalprice").alias("totalprice_copy"), "o_orderdate", "o_orderpriority",
                 F.when(F.col("o_orderkey") % 1000 == 7, F.lit("X")).otherwise(F.col("o_orderstatus"))
                 .alias("status_near_copy"),
                 F.col("o_orderstatus").alias("status_copy"))
    return S.distinct_columns(o)


@register("vocab_union", f"""{W}
SELECT DISTINCT token FROM (
  SELECT unnest({sql_vocab_tokens('features')}) AS token FROM listings WHERE features IS NOT NULL
  UNION ALL
  SELECT unnest({sql_vocab_tokens('parking')}) AS token FROM listings WHERE parking IS NOT NULL)""")
def q_vocab_union(spark, sf):
    v = listing_view(spark, sf)
    return S.vocab_union(vocab(v, "features"), vocab(v, "parking"))


# ---- V1 / V2 -------------------------------------------------------------------------------

@register("vocab", f"SELECT DISTINCT unnest({sql_vocab_tokens('text')}) AS token FROM documents WHERE text IS NOT NULL")
def q_vocab(spark, sf):
    return vocab(table(spark, sf, "documents"), "text")


@register("garage_vocab", f"""{W}
SELECT DISTINCT term FROM (
  SELECT lower(unnest({sql_vocab_tokens('features')})) AS term FROM listings WHERE features IS NOT NULL
  UNION ALL
  SELECT lower(unnest({sql_vocab_tokens('parking')})) AS term FROM listings WHERE parking IS NOT NULL)
WHERE ({' OR '.join(f"contains(term, {sql_str(k)})" for k in V.GARAGE_KEYWORDS)}) AND term <> 'no garage'""")
def q_garage_vocab(spark, sf):
    return garage_vocab(listing_view(spark, sf), ["features", "parking"], V.GARAGE_KEYWORDS,
                        V.GARAGE_EXCLUDED_TERM)


# ---- A1 - A12, K1, K2 ----------------------------------------------------------------------

@register("row_count", f"{W} SELECT count(*) AS rows, {len(LISTING_COLUMN_NAMES)} AS columns FROM listings")
def q_row_count(spark, sf):
    return P.row_count(listing_view(spark, sf))


@register("value_counts", """
SELECT l_quantity, count(*) AS count FROM lineitem WHERE l_quantity IS NOT NULL AND NOT isnan(l_quantity)
GROUP BY l_quantity""")
def q_value_counts(spark, sf):
    return P.value_counts(table(spark, sf, "lineitem"), "l_quantity")


@register("value_counts_multi", f"""{W}
SELECT address_region, garage, count(*) AS count FROM listings
WHERE address_region IS NOT NULL AND garage IS NOT NULL GROUP BY address_region, garage""")
def q_value_counts_multi(spark, sf):
    return P.value_counts_multi(listing_view(spark, sf), ["address_region", "garage"])


@register("aligned_counts", f"""{W},
a AS (SELECT beds AS value, count(*) AS n FROM listings WHERE beds IS NOT NULL GROUP BY beds),
b AS (SELECT baths AS value, count(*) AS n FROM listings WHERE baths IS NOT NULL GROUP BY baths)
SELECT coalesce(a.value, b.value) AS value, coalesce(a.n, 0) AS beds_count, coalesce(b.n, 0) AS baths_count
FROM a FULL OUTER JOIN b ON a.value = b.value""")
def q_aligned_counts(spark, sf):
    return P.aligned_counts(listing_view(spark, sf), "beds", "baths")


ND_COLS = ["garage", "address_region", "basement", "features", "street_address"]


@register("n_distinct", f"{W} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_distinct FROM listings"
    for c in ND_COLS))
def q_n_distinct(spark, sf):
    return P.n_distinct(listing_view(spark, sf), ND_COLS)


@register("null_counts", f"{W} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS nulls FROM listings" for c in LISTING_COLUMN_NAMES))
def q_null_counts(spark, sf):
    return P.null_counts(listing_view(spark, sf))


DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@register("describe_numeric", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, min({c}) AS min,
       round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, max({c}) AS max FROM lineitem""" for c in DESC_COLS))
def q_describe_numeric(spark, sf):
    d = P.describe_numeric(table(spark, sf, "lineitem"), DESC_COLS)
    return d.select("column_name", "count", r6(F.col("mean")).alias("mean"), r6(F.col("std")).alias("std"),
                    "min", r6(F.col("p25")).alias("p25"), r6(F.col("p50")).alias("p50"),
                    r6(F.col("p75")).alias("p75"), "max")


CAT_COLS = ["address_locality", "garage", "basement", "heating"]


@register("describe_categorical", f"{W} " + " UNION ALL ".join(
    f"""(SELECT '{c}' AS column_name, (SELECT count({c}) FROM listings) AS count,
        (SELECT count(DISTINCT {c}) FROM listings) AS "unique", {c} AS top, count(*) AS freq
     FROM listings WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY freq DESC, {c} LIMIT 1)""" for c in CAT_COLS))
def q_describe_categorical(spark, sf):
    return P.describe_categorical(listing_view(spark, sf), CAT_COLS)


@register("schema_info", f"{W} " + " UNION ALL ".join(
    f"SELECT {i} AS ordinal, '{c}' AS column_name, count({c}) AS non_null, "
    f"'{'bigint' if c == 'listing_id' else 'string'}' AS data_type FROM listings"
    for i, c in enumerate(LISTING_COLUMN_NAMES)))
def q_schema_info(spark, sf):
    return P.schema_info(listing_view(spark, sf))


@register("quantile", """
SELECT round(quantile_cont(l_extendedprice, 0.25), 6) AS q1, round(quantile_cont(l_extendedprice, 0.75), 6) AS q3
FROM lineitem""")
def q_quantile(spark, sf):
    q = P.quantiles(table(spark, sf, "lineitem"), "l_extendedprice", [0.25, 0.75], names=["q1", "q3"])
    return q.select(r6(F.col("q1")).alias("q1"), r6(F.col("q3")).alias("q3"))


@register("iqr_outliers", """
WITH b AS (SELECT quantile_cont(c_acctbal, 0.25) AS q1, quantile_cont(c_acctbal, 0.75) AS q3 FROM customer),
f AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM b)
SELECT round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr, round(lower, 6) AS lower,
       round(upper, 6) AS upper,
       (SELECT count(*) FROM customer, f WHERE c_acctbal < f.lower OR c_acctbal > f.upper) AS outliers
FROM f""")
def q_iqr_outliers(spark, sf):
    o = P.iqr_outliers(table(spark, sf, "customer"), "c_acctbal")
    return o.select(*[r6(F.col(c)).alias(c) for c in ["q1", "q3", "iqr", "lower", "upper"]], "outliers")


@register("rows_per_source", f"{W} SELECT address_region AS source, count(*) AS rows FROM listings GROUP BY address_region")
def q_rows_per_source(spark, sf):
    v = listing_view(spark, sf).withColumnRenamed("address_region", "source")
    return P.rows_per_source(v, "source")


@register("top_k_values", f"""{W}
SELECT address_locality, count(*) AS count FROM listings WHERE address_locality IS NOT NULL
GROUP BY address_locality ORDER BY count DESC, address_locality LIMIT 10""")
def q_top_k_values(spark, sf):
    return P.top_k_values(listing_view(spark, sf), "address_locality", 10)


@register("head", """
SELECT * FROM lineitem ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate LIMIT 5""")
def q_head(spark, sf):
    return P.head(table(spark, sf, "lineitem"), 5)
