"""The listing cleaner (P1 ``clean_listings``, P2 ``finalize_only``) built
from the package's operators.

Stages:

1. load     - textual NA markers -> null (C1), union by name (U1);
2. dedupe   - duplicate rows (U2), written once as a Parquet table in the
              shared checkpoint folder, duplicate columns (U3), rows
              missing an address or price dropped (F1);
3. clean    - one projection deriving every cleaned column from token
              arrays computed once per source
              column (I1-I7, T4-T9), with the data-derived garage
              vocabulary (V2) applied by :func:`flag_membership`;
4. finalize - drop consumed columns (F4), rename (F5), cast (F6);
5. filter   - sizes/beds/baths present, size > 120, price >= 50000 (F1, F2).

Only the dedupe stage shuffles (U2); the U3 fingerprint and the V2
vocabulary are aggregates over the materialised deduplicated rows, and the
final projection is one scan of them with the required-field filters
pushed into it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hausprep import vocabularies as V
from hausprep.functions.imputation import (
    correct_value,
    fill_constant,
    fill_from_column,
    garage_fill,
    presence_flag,
)
from hausprep.functions.tokens import (
    classify_first,
    concat_columns,
    has_any,
    keyword_flag,
    tokens_match,
    yes_no,
)
from hausprep.operators.common import qcol
from hausprep.operators.filters import cast_numeric, drop_columns, drop_incomplete, range_filter
from hausprep.operators.schema import na_tokens
from hausprep.operators.setops import (
    distinct_columns,
    distinct_rows,
    fingerprint_exprs,
    merge_spellings,
    spelled_otherwise,
    union_by_name,
)
from hausprep.operators.vocab import flag_membership, garage_vocab
from hausprep.session import materialize_observed


@dataclass(frozen=True)
class ListingColumns:
    """Raw column names of a listing table (defaults: the scraped files)."""

    street_address: str = "streetAddress"
    locality: str = "addressLocality"
    region: str = "addressRegion"
    price: str = "price"
    beds: str = "property-beds"
    baths: str = "property-baths"
    sqft: str = "Square Footage"
    sqft_fallback: str = "property-sqft"
    acreage: str = "Acreage"
    features: str = "Features"
    garage: str = "Garage"
    parking: str = "Parking"
    basement: str = "Basement"
    exterior: str = "Exterior"
    fireplace: str = "Fireplace"
    heating: str = "Heating"
    flooring: str = "Flooring"
    roof: str = "Roof"
    waterfront: str = "Waterfront"
    sewer: str = "Sewer"
    latitude: str | None = "latitude"
    longitude: str | None = "longitude"
    # Raw columns that are not used but dropped from the result.
    unused: tuple[str, ...] = ("postalCode", "description", "priceCurrency", "Air Conditioning",
                               "MLS® #", "Fireplace Features", "Subdivision", "Bath", "Property Tax")

    def roles(self) -> dict[str, str]:
        return {f.name: getattr(self, f.name) for f in fields(self)
                if f.name != "unused" and getattr(self, f.name) is not None}

    def numeric(self) -> list[str]:
        names = (self.latitude, self.longitude, self.price, self.beds, self.baths, self.acreage, self.sqft_fallback)
        return [n for n in names if n is not None]

    def required_for_address(self) -> list[str]:
        return [self.street_address, self.locality, self.region, self.price]


@dataclass(frozen=True)
class ListingOutput:
    """Names of the cleaned columns."""

    city: str = "City"
    province: str = "Province"
    latitude: str = "Latitude"
    longitude: str = "Longitude"
    price: str = "Price"
    bathrooms: str = "Bathrooms"
    bedrooms: str = "Bedrooms"
    acreage: str = "Acreage"
    square_footage: str = "Square Footage"
    garage: str = "Garage"
    parking: str = "Parking"
    basement: str = "Basement"
    exterior: str = "Exterior"
    fireplace: str = "Fireplace"
    heating: str = "Heating"
    flooring: str = "Flooring"
    roof: str = "Roof"
    waterfront: str = "Waterfront"
    sewer: str = "Sewer"
    pool: str = "Pool"
    garden: str = "Garden"
    view: str = "View"
    balcony: str = "Balcony"


# ---- stage 1 / 2 ----------------------------------------------------------------

def load_stage(frames: Sequence[DataFrame] | DataFrame) -> DataFrame:
    """C1 on every input, then U1."""
    if isinstance(frames, DataFrame):
        frames = [frames]
    return union_by_name([na_tokens(f) for f in frames])


def numeric_text(raw: DataFrame, cols: ListingColumns, chosen: Sequence[str] | None = None) -> list[str]:
    """The text columns of ``raw`` that hold numbers."""
    names = cols.numeric() if chosen is None else chosen
    return [f.name for f in raw.schema.fields if f.name in names and f.dataType.simpleString() == "string"]


def dedupe_stage(raw: DataFrame, cols: ListingColumns, *, checkpoint: bool = True,
                 canonical_numeric: Sequence[str] | None = None) -> DataFrame:
    """U2 -> materialise -> U3 (listing columns protected) -> F1.

    ``canonical_numeric`` names text columns whose numeric spelling must not
    matter for duplicate detection (``3`` and ``3.0`` from two files); the
    numeric listing columns unless given."""
    numeric = numeric_text(raw, cols, canonical_numeric)
    if not checkpoint:
        deduped, prints = distinct_rows(raw, canonical_numeric=numeric, packed=True), None
    else:
        # U3's fingerprint pass rides along the write that materialises U2, and the number of rows that spell
        # numbers in an unusual way: without any, equal numbers are equal texts and the rows need no second pass.
        deduped = distinct_rows(raw, packed=True)
        odd = F.count_if(spelled_otherwise(deduped, numeric)).alias("odd_spelling")
        deduped, prints = materialize_observed(deduped, [*fingerprint_exprs(deduped), odd], "dedup")
        if prints["odd_spelling"]:
            deduped = merge_spellings(deduped, numeric)
            deduped, prints = materialize_observed(deduped, fingerprint_exprs(deduped), "dedup")
    present = [c for c in [*cols.roles().values(), *cols.unused] if c in deduped.columns]
    deduped = distinct_columns(deduped, protect=present, fingerprints=prints)
    return drop_incomplete(deduped, cols.required_for_address())


# ---- stage 3 ---------------------------------------------------------------------

_TOK = "__tok_"
_HELPERS = frozenset(f"__{n}" for n in (
    "hit_gf hit_gp sqft acreage baths garage parking basement exterior fireplace heating flooring roof "
    "waterfront sewer pool garden view balcony").split())


def clean_stage(df: DataFrame, cols: ListingColumns, out: ListingOutput, *,
                vocab_strategy: str = "auto") -> DataFrame:
    """Derive every cleaned column in one projection.

    Token arrays (``__tok_*``) are computed once per list column and reused by every
    classifier reading that column, which looks each token up in hashed sets."""
    c = cols
    taken = [n for n in df.columns if n in _HELPERS or n.startswith(_TOK)]
    if taken:
        raise ValueError(f"these column names are used inside the cleaner; rename them: {taken}")
    list_cols = {"features": c.features, "parking": c.parking, "basement": c.basement,
                 "exterior": c.exterior, "heating": c.heating, "flooring": c.flooring,
                 "roof": c.roof, "sewer": c.sewer}
    combined = concat_columns([qcol(c.basement), qcol(c.exterior), qcol(c.features),
                               qcol(c.fireplace), qcol(c.garage), qcol(c.heating), qcol(c.parking)])
    tok = {k: F.col(f"{_TOK}{k}") for k in list_cols}
    tok["combined"] = F.col(f"{_TOK}combined")
    staged = df.withColumns({f"{_TOK}{k}": tokens_match(qcol(v)) for k, v in list_cols.items()}
                            | {f"{_TOK}combined": tokens_match(combined)})

    # V2: the garage vocabulary is derived from the deduplicated rows.
    terms = garage_vocab(df, [c.features, c.parking], V.GARAGE_KEYWORDS, V.GARAGE_EXCLUDED_TERM)
    staged = flag_membership(staged, {"__hit_gf": tok["features"], "__hit_gp": tok["parking"]},
                             terms, strategy=vocab_strategy)

    derived = {
        "__sqft": fill_from_column(qcol(c.sqft), qcol(c.sqft_fallback), remove=" SQFT"),
        "__acreage": fill_constant(qcol(c.acreage), "0"),
        "__baths": correct_value(qcol(c.baths), V.BATHS_BAD_VALUE, V.BATHS_FIXED_VALUE),
        "__garage": garage_fill(qcol(c.garage), qcol(c.features), qcol(c.parking),
                                F.col("__hit_gf"), F.col("__hit_gp")),
        "__parking": yes_no(has_any(tok["parking"], V.PARKING_TERMS)
                            | has_any(tok["features"], V.PARKING_TERMS)),
        "__basement": classify_first(None, V.BASEMENT, tokens=tok["basement"]),
        "__exterior": classify_first(None, V.EXTERIOR, tokens=tok["exterior"]),
        "__fireplace": presence_flag(qcol(c.fireplace), V.FIREPLACE_ABSENT),
        "__heating": classify_first(None, V.HEATING, tokens=tok["heating"]),
        "__flooring": classify_first(None, V.FLOORING, tokens=tok["flooring"]),
        "__roof": classify_first(None, V.ROOF, tokens=tok["roof"]),
        "__waterfront": fill_constant(qcol(c.waterfront), "No"),
        "__sewer": fill_constant(classify_first(None, V.SEWER, tokens=tok["sewer"]), "none"),
        "__pool": keyword_flag(None, V.POOL_TERMS, tokens=tok["combined"]),
        "__garden": keyword_flag(None, V.GARDEN_TERMS, tokens=tok["combined"]),
        "__view": classify_first(None, V.view_vocabulary(), tokens=tok["combined"]),
        "__balcony": keyword_flag(None, V.BALCONY_TERMS, tokens=tok["combined"]),
    }
    return staged.withColumns(derived)


# ---- stage 4 / 5 -------------------------------------------------------------------

def finalize_stage(df: DataFrame, cols: ListingColumns, out: ListingOutput, *,
                   raw_columns: Sequence[str], cast_mode: str = "strict") -> DataFrame:
    """F4 + F5 + F6: keep pass-through columns (those of ``raw_columns`` that
    nothing consumed, renamed) and derived ones, cast the seven numeric
    columns to double.  ``cast_mode="strict"``
    fails the job on a malformed number (as the original run does);
    ``"null"`` turns it into a missing value, after which the consistency
    filter drops the row (find such rows with ``quarantine_rows``)."""
    c = cols
    consumed = [c.street_address, c.features, c.garage, c.parking, c.basement, c.exterior,
                c.fireplace, c.heating, c.flooring, c.roof, c.waterfront, c.sewer, c.sqft,
                c.sqft_fallback]
    # Strict drop: every named raw column must exist (raises otherwise).
    drop_columns(df, consumed + list(c.unused))
    renames = {c.locality: out.city, c.region: out.province, c.price: out.price,
               c.beds: out.bedrooms}
    if c.latitude:
        renames[c.latitude] = out.latitude
    if c.longitude:
        renames[c.longitude] = out.longitude
    replaced = {c.baths: ("__baths", out.bathrooms), c.acreage: ("__acreage", out.acreage)}
    gone = set(consumed) | set(c.unused)
    passthrough = []
    for name in raw_columns:
        if name in gone:
            continue
        if name in replaced:
            src, dst = replaced[name]
            passthrough.append(F.col(src).alias(dst))
        else:
            passthrough.append(qcol(name).alias(renames.get(name, name)))
    derived = [("__sqft", out.square_footage), ("__garage", out.garage), ("__parking", out.parking),
               ("__basement", out.basement), ("__exterior", out.exterior),
               ("__fireplace", out.fireplace), ("__heating", out.heating),
               ("__flooring", out.flooring), ("__roof", out.roof),
               ("__waterfront", out.waterfront), ("__sewer", out.sewer), ("__pool", out.pool),
               ("__garden", out.garden), ("__view", out.view), ("__balcony", out.balcony)]
    shaped = df.select(*passthrough, *[F.col(s).alias(d) for s, d in derived])
    numeric = [out.latitude if c.latitude else None, out.longitude if c.longitude else None,
               out.price, out.bedrooms, out.bathrooms, out.acreage, out.square_footage]
    return cast_numeric(shaped, [n for n in numeric if n], strip_commas=[out.square_footage], mode=cast_mode)


def consistency_stage(df: DataFrame, out: ListingOutput) -> DataFrame:
    """F1 on sizes, F2 on size and price, then the view column is dropped."""
    df = drop_incomplete(df, [out.bedrooms, out.bathrooms, out.square_footage])
    df = range_filter(df, out.square_footage, lower=V.MIN_SQUARE_FOOTAGE_EXCLUSIVE, lower_inclusive=False)
    df = range_filter(df, out.price, lower=V.MIN_PRICE_INCLUSIVE, lower_inclusive=True)
    return df.drop(out.view)


# ---- P1 / P2 ---------------------------------------------------------------------

def clean_listings(
    frames: Sequence[DataFrame] | DataFrame,
    cols: ListingColumns = ListingColumns(),
    out: ListingOutput = ListingOutput(),
    *,
    finalize_only: bool = False,
    vocab_strategy: str = "auto",
    checkpoint: bool = True,
    cast_mode: str = "strict",
    canonical_numeric: Sequence[str] | None = None,
) -> DataFrame:
    """Raw regional listing frames (all text) -> clean listing table.

    With ``finalize_only=True`` (P2) the result stops before the final
    consistency filter and keeps the view column."""
    raw = load_stage(frames)
    deduped = dedupe_stage(raw, cols, checkpoint=checkpoint, canonical_numeric=canonical_numeric)
    cleaned = clean_stage(deduped, cols, out, vocab_strategy=vocab_strategy)
    final = finalize_stage(cleaned, cols, out, raw_columns=deduped.columns, cast_mode=cast_mode)
    return final if finalize_only else consistency_stage(final, out)


def finalize_only(frames, cols: ListingColumns = ListingColumns(), out: ListingOutput = ListingOutput(),
                  **kw) -> DataFrame:
    """What the exploratory runs saved - cleaned and cast, not filtered."""
    return clean_listings(frames, cols, out, finalize_only=True, **kw)
