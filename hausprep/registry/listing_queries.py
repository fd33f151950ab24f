"""Registered listing pipelines: P1 ``clean_listings`` and P2 ``finalize_only``."""

from __future__ import annotations

from hausprep import vocabularies as V
from hausprep.plans.listings import clean_listings, finalize_only
from hausprep.registry.core import register
from hausprep.registry.fixtures import (
    LISTING_CTE,
    VIEW_COLUMNS,
    VIEW_OUTPUT,
    listing_raw_frames,
    sql_classify,
    sql_flag,
    sql_list,
    sql_match_tokens,
    sql_str,
    sql_vocab_tokens,
)


def _garage_vocab_cte(source: str) -> str:
    contains = " OR ".join(f"contains(term, {sql_str(k)})" for k in V.GARAGE_KEYWORDS)
    return f"""
gvocab_tokens AS (
  SELECT lower(unnest({sql_vocab_tokens('features')})) AS term FROM {source} WHERE features IS NOT NULL
  UNION ALL
  SELECT lower(unnest({sql_vocab_tokens('parking')})) AS term FROM {source} WHERE parking IS NOT NULL
),
gvocab AS (
  SELECT list(DISTINCT term) AS terms FROM gvocab_tokens
  WHERE ({contains}) AND term <> {sql_str(V.GARAGE_EXCLUDED_TERM)}
)"""


def cleaned_listing_sql(final_filter: bool) -> str:
    """The whole listing cleaner as one DuckDB statement."""
    tok = {k: sql_match_tokens(k) for k in
           ["features", "parking", "basement", "exterior", "heating", "flooring", "roof", "sewer"]}
    tok["combined"] = sql_match_tokens(
        "concat_ws(',', basement, exterior, features, fireplace, garage, heating, parking)")
    view_case = sql_classify("tc", V.view_vocabulary())
    select_view = "" if final_filter else f", {view_case} AS view"
    where = ("WHERE bedrooms IS NOT NULL AND bathrooms IS NOT NULL AND square_footage IS NOT NULL "
             f"AND square_footage > {V.MIN_SQUARE_FOOTAGE_EXCLUSIVE} AND price >= {V.MIN_PRICE_INCLUSIVE}"
             if final_filter else "")
    return f"""
WITH {LISTING_CTE},
raw AS (
  SELECT *, price AS price_copy FROM listings
  UNION ALL
  SELECT *, price AS price_copy FROM listings
),
dedup AS (SELECT DISTINCT * FROM raw),
base AS (
  SELECT * EXCLUDE (price_copy) FROM dedup
  WHERE street_address IS NOT NULL AND address_locality IS NOT NULL
    AND address_region IS NOT NULL AND price IS NOT NULL
),
{_garage_vocab_cte('base')},
tok AS (
  SELECT base.*,
    {tok['features']} AS tf, {tok['parking']} AS tp, {tok['basement']} AS tb,
    {tok['exterior']} AS te, {tok['heating']} AS th, {tok['flooring']} AS tfl,
    {tok['roof']} AS tr, {tok['sewer']} AS ts, {tok['combined']} AS tc
  FROM base
),
cleaned AS (
  SELECT
    listing_id,
    address_locality AS city,
    address_region AS province,
    CAST(price AS DOUBLE) AS price,
    CAST(beds AS DOUBLE) AS bedrooms,
    CAST(CASE WHEN TRY_CAST(baths AS DOUBLE) = {V.BATHS_BAD_VALUE} THEN {sql_str(V.BATHS_FIXED_VALUE)} ELSE baths END AS DOUBLE) AS bathrooms,
    CAST(coalesce(acreage, '0') AS DOUBLE) AS acreage,
    CAST(replace(coalesce(replace(sqft_primary, ' SQFT', ''), sqft_fallback), ',', '') AS DOUBLE) AS square_footage,
    CASE WHEN garage IS NULL THEN (CASE WHEN list_has_any(tf, (SELECT terms FROM gvocab)) THEN 'Yes' ELSE 'No' END)
         WHEN garage = 'No' THEN (CASE WHEN list_has_any(tp, (SELECT terms FROM gvocab)) THEN 'Yes' ELSE 'No' END)
         ELSE garage END AS garage,
    CASE WHEN list_has_any(tp, {sql_list(V.PARKING_TERMS)}) OR list_has_any(tf, {sql_list(V.PARKING_TERMS)})
         THEN 'Yes' ELSE 'No' END AS parking,
    {sql_classify('tb', V.BASEMENT)} AS basement,
    {sql_classify('te', V.EXTERIOR)} AS exterior,
    CASE WHEN fireplace IS NOT NULL AND fireplace NOT IN ({', '.join(sql_str(v) for v in V.FIREPLACE_ABSENT)})
         THEN 'Yes' ELSE 'No' END AS fireplace,
    {sql_classify('th', V.HEATING)} AS heating,
    {sql_classify('tfl', V.FLOORING)} AS flooring,
    {sql_classify('tr', V.ROOF)} AS roof,
    coalesce(waterfront, 'No') AS waterfront,
    coalesce({sql_classify('ts', V.SEWER)}, 'none') AS sewer,
    {sql_flag('tc', V.POOL_TERMS)} AS pool,
    {sql_flag('tc', V.GARDEN_TERMS)} AS garden,
    {sql_flag('tc', V.BALCONY_TERMS)} AS balcony
    {select_view}
  FROM tok
)
SELECT * FROM cleaned {where}
"""


@register("clean_listings", cleaned_listing_sql(final_filter=True))
def q_clean_listings(spark, sf_dir):
    """P1 (flagship): two full loads of the listing view -> clean listings."""
    return clean_listings(listing_raw_frames(spark, sf_dir), VIEW_COLUMNS, VIEW_OUTPUT)


@register("finalize_only", cleaned_listing_sql(final_filter=False))
def q_finalize_only(spark, sf_dir):
    """Cleaned and cast, before the final consistency filter."""
    return finalize_only(listing_raw_frames(spark, sf_dir), VIEW_COLUMNS, VIEW_OUTPUT)
