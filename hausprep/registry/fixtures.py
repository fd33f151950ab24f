"""Inputs of the registered queries, derived from the supplied tables.

The listing view turns every ``lineitem`` row into one raw listing with
list-like text cells, missing values and the quirks the cleaner must
handle.  It is written in SQL accepted identically by Spark and DuckDB, so
the oracle starts from exactly the same rows.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from hausprep.functions.tokens import whitespace_chars
from hausprep.plans.listings import ListingColumns, ListingOutput

LISTING_VIEW_SELECT = """
SELECT
  l_orderkey AS listing_id,
  CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE concat(cast(l_orderkey AS varchar(20)), ' Main St') END AS street_address,
  concat('City ', cast(l_suppkey % 50 AS varchar(20))) AS address_locality,
  concat('R', cast(l_orderkey % 11 AS varchar(20))) AS address_region,
  CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE cast(cast(floor(l_extendedprice * 5) AS bigint) AS varchar(20)) END AS price,
  CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE cast(l_linenumber AS varchar(20)) END AS beds,
  CASE WHEN l_partkey % 17 = 0 THEN '803' WHEN l_partkey % 19 = 0 THEN NULL ELSE cast(l_linenumber % 4 + 1 AS varchar(20)) END AS baths,
  CASE WHEN l_suppkey % 3 = 0 THEN NULL WHEN l_suppkey % 3 = 1 THEN concat('1,', cast(100 + l_partkey % 900 AS varchar(20)), ' SQFT')
       ELSE concat(cast(90 + l_partkey % 900 AS varchar(20)), ' SQFT') END AS sqft_primary,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE cast(cast(floor(l_quantity) AS bigint) * 50 AS varchar(20)) END AS sqft_fallback,
  CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE cast(l_partkey % 7 AS varchar(20)) END AS acreage,
  CASE l_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '["Attached Garage", "Swimming Pool"]' WHEN 2 THEN '[" No Garage ", "Lake View"]'
       WHEN 3 THEN 'RV Parking; Landscaped' WHEN 4 THEN '["Carpet", "Balcony/Deck", "River View"]' ELSE '[]' END AS features,
  CASE l_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Yes' ELSE 'No' END AS garage,
  CASE l_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '["Carport; Single"]' WHEN 2 THEN '["Double Garage", "Stall"]' ELSE '["Street"]' END AS parking,
  CASE l_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '["Partial", "Walkout"]' WHEN 2 THEN '["Crawl Space"]' WHEN 3 THEN 'Cellar' ELSE '["Mystery"]' END AS basement,
  CASE l_orderkey % 4 WHEN 0 THEN '["Vinyl Siding", "Brick"]' WHEN 1 THEN 'Stucco' WHEN 2 THEN '["Shingles"]' ELSE NULL END AS exterior,
  CASE l_orderkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '[]' WHEN 2 THEN '["0"]' WHEN 3 THEN NULL ELSE '["Gas"]' END AS fireplace,
  CASE l_partkey % 8 WHEN 0 THEN '["Baseboard", "Forced Air"]' WHEN 1 THEN 'Heat Pump' WHEN 2 THEN 'Propane' WHEN 3 THEN 'None ' WHEN 4 THEN NULL ELSE '["Furnace"]' END AS heating,
  CASE l_partkey % 5 WHEN 0 THEN '["Hardwood", "Carpet"]' WHEN 1 THEN 'Ceramic Tile' WHEN 2 THEN 'Marble' ELSE NULL END AS flooring,
  CASE l_suppkey % 5 WHEN 0 THEN 'Tar &amp; Gravel' WHEN 1 THEN '["Asphalt Shingle"]' WHEN 2 THEN 'Steel' WHEN 3 THEN '["Membrane", "Tile"]' ELSE NULL END AS roof,
  CASE WHEN l_orderkey % 9 = 0 THEN 'Yes' ELSE NULL END AS waterfront,
  CASE l_suppkey % 6 WHEN 0 THEN 'Septic Tank' WHEN 1 THEN '["Public Sewer", "Lagoon"]' WHEN 2 THEN 'Outhouse' WHEN 3 THEN 'Unknown' ELSE NULL END AS sewer
FROM {lineitem}
"""

LISTING_COLUMN_NAMES = [
    "listing_id", "street_address", "address_locality", "address_region", "price", "beds", "baths",
    "sqft_primary", "sqft_fallback", "acreage", "features", "garage", "parking", "basement",
    "exterior", "fireplace", "heating", "flooring", "roof", "waterfront", "sewer",
]

# Raw-name mapping of the listing view, and snake_case output names.
VIEW_COLUMNS = ListingColumns(
    street_address="street_address", locality="address_locality", region="address_region",
    price="price", beds="beds", baths="baths", sqft="sqft_primary", sqft_fallback="sqft_fallback",
    acreage="acreage", features="features", garage="garage", parking="parking",
    basement="basement", exterior="exterior", fireplace="fireplace", heating="heating",
    flooring="flooring", roof="roof", waterfront="waterfront", sewer="sewer",
    latitude=None, longitude=None, unused=(),
)
VIEW_OUTPUT = ListingOutput(
    city="city", province="province", price="price", bathrooms="bathrooms", bedrooms="bedrooms",
    acreage="acreage", square_footage="square_footage", garage="garage", parking="parking",
    basement="basement", exterior="exterior", fireplace="fireplace", heating="heating",
    flooring="flooring", roof="roof", waterfront="waterfront", sewer="sewer", pool="pool",
    garden="garden", view="view", balcony="balcony",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def listing_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw listing view over the whole ``lineitem`` table (all text)."""
    return spark.sql(LISTING_VIEW_SELECT, lineitem=table(spark, sf_dir, "lineitem"))


def listing_raw_frames(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two full loads of the listing view, as the daily job sees repeated
    listings; each carries a copied price column for the duplicate-column
    step."""
    view = listing_view(spark, sf_dir)
    with_copy = view.withColumn("price_copy", view["price"])
    return [with_copy, with_copy]


# ---- SQL helpers for the DuckDB oracle ----------------------------------------------

LISTING_CTE = "listings AS (" + LISTING_VIEW_SELECT.replace("{lineitem}", "lineitem") + ")"


@lru_cache(maxsize=1)
def sql_ws() -> str:
    """Python's strip() whitespace set as a DuckDB string expression."""
    return "(" + " || ".join(f"chr({ord(c)})" for c in whitespace_chars()) + ")"


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(sql_str(v) for v in values) + "]"


def sql_match_tokens(expr: str) -> str:
    """T4 in DuckDB: clean, ';' -> ',', split, strip, lower."""
    return (f"list_transform(string_split(replace(translate({expr}, '[]\"''', ''), ';', ','), ','), "
            f"lambda t: lower(trim(t, {sql_ws()})))")


def sql_vocab_tokens(expr: str) -> str:
    """T3 in DuckDB: clean, split on ',', strip (case kept)."""
    return (f"list_transform(string_split(translate({expr}, '[]\"''', ''), ','), "
            f"lambda t: trim(t, {sql_ws()}))")


def sql_flag(tokens: str, terms) -> str:
    return f"CASE WHEN list_has_any({tokens}, {sql_list(terms)}) THEN 'Yes' ELSE 'No' END"


def sql_classify(tokens: str, vocabulary) -> str:
    whens = " ".join(f"WHEN list_has_any({tokens}, {sql_list(terms)}) THEN {sql_str(label)}"
                     for label, terms in vocabulary)
    return f"CASE {whens} END"
