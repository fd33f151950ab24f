"""Registered run-time checks: P6 ``quality_report``, P7 ``stage_metrics``,
P8 ``profile_table``."""

from __future__ import annotations

from pyspark.sql import functions as F

from hausprep.operators.filters import cast_numeric
from hausprep.plans.listings import clean_listings
from hausprep.plans.quality import profile_table, quality_report, stage_metrics
from hausprep.registry.core import register
from hausprep.registry.fixtures import (
    LISTING_CTE,
    VIEW_COLUMNS,
    VIEW_OUTPUT,
    listing_raw_frames,
    listing_view,
)
from hausprep.registry.listing_queries import cleaned_listing_sql
from hausprep.registry.table_queries import CAST_COLS

FINAL = ["listing_id", "city", "province", "price", "bedrooms", "bathrooms", "acreage", "square_footage", "garage",
         "parking", "basement", "exterior", "fireplace", "heating", "flooring", "roof", "waterfront", "sewer", "pool",
         "garden", "balcony"]
CRITICAL = ["price", "bedrooms", "bathrooms", "square_footage"]


def _r6(name):
    return F.round(F.col(name), 6).alias(name)


@register("quality_report", f"""
WITH p1 AS ({cleaned_listing_sql(final_filter=True)}),
b AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM p1),
f AS (SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM b)
SELECT {', '.join(f'CAST(count_if({c} IS NULL) AS BIGINT) AS nulls_{c}' for c in CRITICAL)},
       round(any_value(f.q1), 6) AS q1, round(any_value(f.q3), 6) AS q3,
       round(any_value(f.lower), 6) AS lower, round(any_value(f.upper), 6) AS upper,
       CAST(count_if(price < f.lower OR price > f.upper) AS BIGINT) AS outliers,
       ({' OR '.join(f'count_if({c} IS NULL) > 0' for c in CRITICAL)}
        OR count_if(price < f.lower OR price > f.upper) > 0) AS warning
FROM p1, f""")
def q_quality_report(spark, sf):
    """P6 on the cleaned listings."""
    cleaned = clean_listings(listing_raw_frames(spark, sf), VIEW_COLUMNS, VIEW_OUTPUT)
    r = quality_report(cleaned, CRITICAL, "price")
    return r.select(*[f"nulls_{c}" for c in CRITICAL], _r6("q1"), _r6("q3"), _r6("lower"), _r6("upper"),
                    "outliers", "warning")


def _stage_sql():
    body = cleaned_listing_sql(final_filter=True)
    # reuse the CTE chain of the cleaner, then count each stage
    head, _, _tail = body.rpartition("SELECT * FROM cleaned")
    return head + """
SELECT 'raw' AS stage, count(*) AS rows FROM raw
UNION ALL SELECT 'after_dedup', count(*) FROM dedup
UNION ALL SELECT 'after_dropna', count(*) FROM base
UNION ALL SELECT 'raw:first', count(*) FROM listings
UNION ALL SELECT 'raw:second', count(*) FROM listings
""" + "".join(f"""
UNION ALL SELECT '{stage}', {value} FROM cleaned
  WHERE bedrooms IS NOT NULL AND bathrooms IS NOT NULL AND square_footage IS NOT NULL
    AND square_footage > 120 AND price >= 50000""" for stage, value in [
        ("final", "count(*)"), *((f"nulls:{c}", f"CAST(count_if({c} IS NULL) AS BIGINT)") for c in FINAL)])


@register("stage_metrics", _stage_sql())
def q_stage_metrics(spark, sf):
    """Rows at each stage of the cleaner, per source, and missing values of the result."""
    frames = [f.withColumn("source", F.lit(name)) for f, name in zip(listing_raw_frames(spark, sf), ("first", "second"))]
    return stage_metrics(frames, VIEW_COLUMNS, VIEW_OUTPUT, source_column="source")


PROFILED = ["listing_id", "address_locality", "garage", "basement", "features", *CAST_COLS]
TOP_N = 5


def _profile_sql():
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in CAST_COLS else c for c in PROFILED)
    parts = []
    for i, c in enumerate(PROFILED):
        number = c in CAST_COLS or c == "listing_id"
        dtype = "bigint" if c == "listing_id" else "double" if number else "string"
        x = f"CAST({c} AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)"
        parts.append(f"""
SELECT {i} AS ordinal, '{c}' AS column_name, '{dtype}' AS data_type, count({c}) AS non_null,
       CAST(count_if({c} IS NULL) AS BIGINT) AS nulls,
       CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_distinct,
       (SELECT value FROM top_{c} WHERE rank = 1) AS top, (SELECT freq FROM top_{c} WHERE rank = 1) AS freq,
       (SELECT string_agg(value || ' x' || freq, ' | ' ORDER BY rank) FROM top_{c}) AS top_values,
       round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std, min({x}) AS min, round(quantile_cont({x}, 0.25), 6) AS p25,
       round(quantile_cont({x}, 0.5), 6) AS p50, round(quantile_cont({x}, 0.75), 6) AS p75, max({x}) AS max
FROM profiled""")
    tops = ", ".join(f"""top_{c} AS (
  SELECT CAST({c} AS VARCHAR) AS value, count(*) AS freq, row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS rank
  FROM profiled WHERE {c} IS NOT NULL GROUP BY {c} QUALIFY rank <= {TOP_N})""" for c in PROFILED)
    return f"WITH {LISTING_CTE}, profiled AS (SELECT {casts} FROM listings), {tops} " + " UNION ALL ".join(parts)


@register("profile_table", _profile_sql())
def q_profile_table(spark, sf):
    """Profile of text and numeric columns of the listing view."""
    profile = profile_table(cast_numeric(listing_view(spark, sf).select(*PROFILED), CAST_COLS), top_n=TOP_N)
    top = F.concat_ws(" | ", F.transform("top_values", lambda s: F.concat_ws(" x", s["value"], s["freq"].cast("string"))))
    return profile.withColumn("top_values", F.when(F.col("top_values").isNotNull(), top)) \
        .withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")})
