"""Registered token functions, classifiers, flags (T1-T10) and imputations
(I1-I7) over the whole listing view / part table."""

from __future__ import annotations

from pyspark.sql import functions as F

from hausprep import vocabularies as V
from hausprep.functions import imputation as I
from hausprep.functions import tokens as T
from hausprep.operators.vocab import flag_membership, garage_vocab, vocab
from hausprep.registry.core import register
from hausprep.registry.fixtures import (
    LISTING_CTE,
    listing_view,
    sql_classify,
    sql_flag,
    sql_list,
    sql_match_tokens,
    sql_str,
    sql_vocab_tokens,
    sql_ws,
    table,
)

W = f"WITH {LISTING_CTE}"
COMBINED_COLS = ["basement", "exterior", "features", "fireplace", "garage", "heating", "parking"]
COMBINED_SQL = "concat_ws(',', " + ", ".join(COMBINED_COLS) + ")"

# Part names as list-like text, e.g. "['small', 'ring']".
PART_LIST_SQL = "concat('[''', replace(p_name, ' ', ''', '''), ''']')"
PART_TERMS = ["ring", "gear", "widget"]
PART_VOCAB = [("device", ["widget", "gizmo", "gear"]), ("fastener", ["bolt", "ring", "nut"]),
              ("colour", ["red", "blue", "green"])]


def _part_list(spark, sf):
    p = table(spark, sf, "part")
    text = F.concat(F.lit("['"), F.replace(F.col("p_name"), F.lit(" "), F.lit("', '")), F.lit("']"))
    return p.select("p_partkey", text.alias("p_list"))


def _combined(df):
    return T.concat_columns([F.col(c) for c in COMBINED_COLS])


# ---- T1 - T5 -------------------------------------------------------------------------

@register("replace_literal", f"{W} SELECT listing_id, sqft_primary, replace(sqft_primary, ' SQFT', '') AS sqft FROM listings")
def q_replace_literal(spark, sf):
    v = listing_view(spark, sf)
    return v.select("listing_id", "sqft_primary", T.replace_literal("sqft_primary", " SQFT").alias("sqft"))


@register("clean_list_text", f"{W} SELECT listing_id, translate(features, '[]\"''', '') AS features_clean FROM listings")
def q_clean_list_text(spark, sf):
    v = listing_view(spark, sf)
    return v.select("listing_id", T.clean_list_text("features").alias("features_clean"))


@register("tokens_vocab", f"""{W}
SELECT token, count(*) AS n FROM (
  SELECT unnest({sql_vocab_tokens('features')}) AS token FROM listings WHERE features IS NOT NULL
  UNION ALL
  SELECT unnest({sql_vocab_tokens('parking')}) AS token FROM listings WHERE parking IS NOT NULL
) GROUP BY token""")
def q_tokens_vocab(spark, sf):
    v = listing_view(spark, sf)
    toks = (v.where(F.col("features").isNotNull()).select(F.explode(T.tokens_vocab("features")).alias("token"))
            .unionByName(v.where(F.col("parking").isNotNull())
                         .select(F.explode(T.tokens_vocab("parking")).alias("token"))))
    return toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@register("tokens_match", f"""{W}
SELECT token, count(*) AS n FROM (
  SELECT unnest({sql_match_tokens('parking')}) AS token FROM listings WHERE parking IS NOT NULL
  UNION ALL
  SELECT unnest({sql_match_tokens('features')}) AS token FROM listings WHERE features IS NOT NULL
) GROUP BY token""")
def q_tokens_match(spark, sf):
    v = listing_view(spark, sf)
    toks = (v.where(F.col("parking").isNotNull()).select(F.explode(T.tokens_match("parking")).alias("token"))
            .unionByName(v.where(F.col("features").isNotNull())
                         .select(F.explode(T.tokens_match("features")).alias("token"))))
    return toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@register("strip", f"""
SELECT doc_id, length(trim(text, {sql_ws()})) AS stripped_chars, md5(trim(text, {sql_ws()})) AS stripped_md5
FROM documents""")
def q_strip(spark, sf):
    d = table(spark, sf, "documents")
    s = T.py_strip("text")
    return d.select("doc_id", F.length(s).cast("bigint").alias("stripped_chars"), F.md5(s).alias("stripped_md5"))


# ---- T6 - T10 on part names and the listing view ------------------------------------------

@register("keyword_flag", f"""
SELECT p_partkey, {sql_flag(sql_match_tokens(PART_LIST_SQL), PART_TERMS)} AS flag FROM part""")
def q_keyword_flag(spark, sf):
    p = _part_list(spark, sf)
    return p.select("p_partkey", T.keyword_flag("p_list", PART_TERMS).alias("flag"))


@register("classify_first", f"""
SELECT p_partkey, {sql_classify(sql_match_tokens(PART_LIST_SQL), PART_VOCAB)} AS label FROM part""")
def q_classify_first(spark, sf):
    p = _part_list(spark, sf)
    return p.select("p_partkey", T.classify_first("p_list", PART_VOCAB).alias("label"))


@register("first_match_term", f"""{W}
SELECT listing_id, {sql_classify(sql_match_tokens(COMBINED_SQL), [(t, [t]) for t in V.VIEW_TERMS])} AS term
FROM listings""")
def q_first_match_term(spark, sf):
    v = listing_view(spark, sf)
    return v.select("listing_id", T.first_match_term(_combined(v), V.VIEW_TERMS).alias("term"))


@register("concat_columns", f"{W} SELECT listing_id, {COMBINED_SQL} AS combined FROM listings")
def q_concat_columns(spark, sf):
    v = listing_view(spark, sf)
    return v.select("listing_id", _combined(v).alias("combined"))


@register("contains_any", f"""{W}
SELECT token, ({' OR '.join(f"contains(token, {sql_str(k)})" for k in V.GARAGE_KEYWORDS)}) AS has_keyword
FROM (SELECT DISTINCT lower(unnest({sql_vocab_tokens('features')})) AS token FROM listings WHERE features IS NOT NULL)""")
def q_contains_any(spark, sf):
    v = listing_view(spark, sf)
    toks = vocab(v, "features").select(F.lower("token").alias("token")).distinct()
    return toks.select("token", T.contains_any("token", V.GARAGE_KEYWORDS).alias("has_keyword"))


# ---- T7 instances ------------------------------------------------------------------------

def _classifier(key, column, vocabulary, fill=None):
    sql_expr = sql_classify(sql_match_tokens(column), vocabulary)
    if fill is not None:
        sql_expr = f"coalesce({sql_expr}, {sql_str(fill)})"

    @register(key, f"{W} SELECT listing_id, {column}, {sql_expr} AS label FROM listings")
    def q(spark, sf):
        v = listing_view(spark, sf)
        label = T.classify_first(column, vocabulary)
        if fill is not None:
            label = I.fill_constant(label, fill)
        return v.select("listing_id", column, label.alias("label"))

    return q


_classifier("classify_basement", "basement", V.BASEMENT)
_classifier("classify_exterior", "exterior", V.EXTERIOR)
_classifier("classify_heating", "heating", V.HEATING)
_classifier("classify_flooring", "flooring", V.FLOORING)
_classifier("classify_roof", "roof", V.ROOF)
_classifier("classify_sewer", "sewer", V.SEWER, fill="none")


@register("classify_view", f"""{W}
SELECT listing_id, {sql_classify(sql_match_tokens(COMBINED_SQL), V.view_vocabulary())} AS view FROM listings""")
def q_classify_view(spark, sf):
    v = listing_view(spark, sf)
    return v.select("listing_id", T.classify_first(_combined(v), V.view_vocabulary()).alias("view"))


# ---- T6 instances ------------------------------------------------------------------------

def _combined_flag(key, terms):
    @register(key, f"{W} SELECT listing_id, {sql_flag(sql_match_tokens(COMBINED_SQL), terms)} AS flag FROM listings")
    def q(spark, sf):
        v = listing_view(spark, sf)
        return v.select("listing_id", T.keyword_flag(_combined(v), terms).alias("flag"))

    return q


_combined_flag("flag_pool", V.POOL_TERMS)
_combined_flag("flag_garden", V.GARDEN_TERMS)
_combined_flag("flag_balcony", V.BALCONY_TERMS)


@register("flag_parking", f"{W} SELECT listing_id, parking, {sql_flag(sql_match_tokens('parking'), V.PARKING_TERMS)} AS flag FROM listings")
def q_flag_parking(spark, sf):
    v = listing_view(spark, sf)
    return v.select("listing_id", "parking", T.keyword_flag("parking", V.PARKING_TERMS).alias("flag"))


def _gvocab_sql(source="listings"):
    contains = " OR ".join(f"contains(term, {sql_str(k)})" for k in V.GARAGE_KEYWORDS)
    return f"""
gvocab_tokens AS (
  SELECT lower(unnest({sql_vocab_tokens('features')})) AS term FROM {source} WHERE features IS NOT NULL
  UNION ALL
  SELECT lower(unnest({sql_vocab_tokens('parking')})) AS term FROM {source} WHERE parking IS NOT NULL
),
gvocab_terms AS (
  SELECT DISTINCT term FROM gvocab_tokens WHERE ({contains}) AND term <> {sql_str(V.GARAGE_EXCLUDED_TERM)}
),
gvocab AS (SELECT list(term) AS terms FROM gvocab_terms)"""


@register("flag_garage", f"""{W}, {_gvocab_sql()}
SELECT listing_id, features,
  CASE WHEN list_has_any({sql_match_tokens('features')}, (SELECT terms FROM gvocab)) THEN 'Yes' ELSE 'No' END AS flag
FROM listings""")
def q_flag_garage(spark, sf):
    v = listing_view(spark, sf)
    terms = garage_vocab(v, ["features", "parking"], V.GARAGE_KEYWORDS, V.GARAGE_EXCLUDED_TERM)
    flagged = flag_membership(v, {"hit": T.tokens_match("features")}, terms)
    return flagged.select("listing_id", "features", T.yes_no(F.col("hit")).alias("flag"))


# ---- I1 - I7 ---------------------------------------------------------------------------------

@register("fill_constant", f"""{W}
SELECT listing_id, coalesce(acreage, '0') AS acreage, coalesce(waterfront, 'No') AS waterfront FROM listings""")
def q_fill_constant(spark, sf):
    v = listing_view(spark, sf)
    return v.select("listing_id", I.fill_constant("acreage", "0").alias("acreage"),
                    I.fill_constant("waterfront", "No").alias("waterfront"))


@register("fill_from_column", f"""{W}
SELECT listing_id, coalesce(replace(sqft_primary, ' SQFT', ''), sqft_fallback) AS sqft FROM listings""")
def q_fill_from_column(spark, sf):
    v = listing_view(spark, sf)
    return v.select("listing_id", I.fill_from_column("sqft_primary", "sqft_fallback", remove=" SQFT").alias("sqft"))


@register("correct_value", f"""{W}
SELECT listing_id, baths AS baths_raw,
  CASE WHEN TRY_CAST(baths AS DOUBLE) = 803 THEN '1' ELSE baths END AS baths FROM listings""")
def q_correct_value(spark, sf):
    v = listing_view(spark, sf)
    return v.select("listing_id", F.col("baths").alias("baths_raw"),
                    I.correct_value("baths", V.BATHS_BAD_VALUE, V.BATHS_FIXED_VALUE).alias("baths"))


@register("presence_flag", f"""{W}
SELECT listing_id, fireplace AS fireplace_raw,
  CASE WHEN fireplace IS NOT NULL AND fireplace NOT IN ({', '.join(sql_str(x) for x in V.FIREPLACE_ABSENT)})
       THEN 'Yes' ELSE 'No' END AS fireplace FROM listings""")
def q_presence_flag(spark, sf):
    v = listing_view(spark, sf)
    return v.select("listing_id", F.col("fireplace").alias("fireplace_raw"),
                    I.presence_flag("fireplace", V.FIREPLACE_ABSENT).alias("fireplace"))


@register("garage_fill", f"""{W}, {_gvocab_sql()}
SELECT listing_id, garage AS garage_raw,
  CASE WHEN garage IS NULL THEN (CASE WHEN list_has_any({sql_match_tokens('features')}, (SELECT terms FROM gvocab)) THEN 'Yes' ELSE 'No' END)
       WHEN garage = 'No' THEN (CASE WHEN list_has_any({sql_match_tokens('parking')}, (SELECT terms FROM gvocab)) THEN 'Yes' ELSE 'No' END)
       ELSE garage END AS garage
FROM listings""")
def q_garage_fill(spark, sf):
    v = listing_view(spark, sf)
    terms = garage_vocab(v, ["features", "parking"], V.GARAGE_KEYWORDS, V.GARAGE_EXCLUDED_TERM)
    flagged = flag_membership(v, {"hf": T.tokens_match("features"), "hp": T.tokens_match("parking")}, terms)
    return flagged.select("listing_id", F.col("garage").alias("garage_raw"),
                          I.garage_fill("garage", "features", "parking", F.col("hf"), F.col("hp")).alias("garage"))


@register("parking_fill", f"""{W}
SELECT listing_id,
  CASE WHEN list_has_any({sql_match_tokens('parking')}, {sql_list(V.PARKING_TERMS)})
         OR list_has_any({sql_match_tokens('features')}, {sql_list(V.PARKING_TERMS)}) THEN 'Yes' ELSE 'No' END AS parking
FROM listings""")
def q_parking_fill(spark, sf):
    v = listing_view(spark, sf)
    return v.select("listing_id", I.parking_fill("parking", "features", V.PARKING_TERMS).alias("parking"))


def _remap_sql(expr):
    whens = " ".join(f"WHEN {expr} = {sql_str(k)} THEN {sql_str(lbl)}" for k, lbl in V.VIEW_LABELS.items())
    return f"CASE {whens} ELSE {expr} END"


@register("remap_values", f"""{W}
SELECT listing_id, {_remap_sql(sql_classify(sql_match_tokens(COMBINED_SQL), [(t, [t]) for t in V.VIEW_TERMS]))} AS view
FROM listings""")
def q_remap_values(spark, sf):
    v = listing_view(spark, sf)
    term = T.first_match_term(_combined(v), V.VIEW_TERMS)
    return v.select("listing_id", I.remap_values(term, V.VIEW_LABELS).alias("view"))
