"""Vocabularies of the listing cleaner.

FIXED VALUES: every term, label and label order below must equal the
cleaning rules being reproduced, otherwise classifications change.  They
are stated as plain text, in their natural order.  Repeated terms were
removed; the order of first appearance is kept.  Matching is on whole,
lower-cased, stripped tokens and the first label with a hit wins.
"""

from __future__ import annotations

Vocabulary = list[tuple[str, list[str]]]

# ---- FIXED VALUES: ordered label -> terms -------------------------------------

BASEMENT: Vocabulary = [
    ("Finished", ["full basement", "full", "dugout", "fully finished", "finished",
                  "remodeled basement", "apartment in basement", "suite", "walk-out access",
                  "walk-out to grade", "walk-up to grade", "walk-out", "walkout", "walk-up",
                  "with windows", "separate/exterior entry", "separate entrance"]),
    ("Partial", ["partially finished", "partial", "partial basement", "not full height", "cellar"]),
    ("No basement", ["unfinished", "no basement", "slab", "crawl space", "crawl", "none",
                     "not applicable", "n/a"]),
]

EXTERIOR: Vocabulary = [
    ("Metal", ["aluminum", "aluminum siding", "aluminum/vinyl", "colour loc", "metal", "steel"]),
    ("Brick", ["brick", "brick facing", "brick imitation", "brick veneer"]),
    ("Concrete", ["concrete", "concrete siding", "concrete/stucco", "concrete block", "insul brick",
                  "stucco"]),
    ("Wood", ["cedar", "cedar shingles", "cedar siding", "wood", "wood siding", "wood shingles"]),
    ("Composite", ["composite siding", "hardboard", "masonite", "shingles"]),
    ("Vinyl", ["vinyl", "vinyl siding", "asbestos", "siding"]),
]

HEATING: Vocabulary = [
    ("forced air", ["forced air", "forced air-1", "forced air-2", "furnace"]),
    ("boiler", ["boiler", "hot water", "hot water radiator heat", "steam", "steam radiator"]),
    ("heat pump", ["central heat pump", "heat pump", "wall mounted heat pump"]),
    ("radiant", ["radiant", "radiant heat", "radiant ceiling", "radiant floor",
                 "radiant/infra-red heat", "baseboard", "baseboard heaters",
                 "electric baseboard units"]),
    ("fireplace", ["fireplace(s)", "fireplace insert", "wood stove", "pellet stove", "coal stove",
                   "stove"]),
    ("space heat", ["space heater", "space heaters", "wall furnace", "floor furnace",
                    "floor model furnace", "overhead heaters", "overhead unit heater", "ductless"]),
    ("alt heat", ["geo thermal", "geothermal", "solar", "gravity", "gravity heat system", "oil",
                  "propane", "propane gas", "coal"]),
    ("no heat", ["no heat", "none"]),
    ("other", ["mixed", "combination", "sep. hvac units"]),
]

FLOORING: Vocabulary = [
    ("carpet", ["carpet", "carpet over softwood", "carpet over hardwood", "carpeted",
                "wall to wall carpet", "wall-to-wall carpet"]),
    ("wood", ["bamboo", "engineered wood", "engineered hardwood", "hardwood", "parquet", "softwood",
              "wood"]),
    ("tile", ["ceramic", "ceramic tile", "ceramic/porcelain", "porcelain tile", "non-ceramic tile",
              "slate", "stone", "tile"]),
    ("vinyl", ["cushion/lino/vinyl", "vinyl", "vinyl plank"]),
    ("laminate", ["laminate", "laminate flooring"]),
    ("concrete", ["concrete", "concrete slab"]),
    ("other", ["basement slab", "basement sub-floor", "granite", "heavy loading", "linoleum",
               "marble", "mixed", "mixed flooring", "see remarks", "subfloor", "other"]),
]

ROOF: Vocabulary = [
    ("asphalt", ["asphalt", "asphalt & gravel", "asphalt rolled", "asphalt shingle",
                 "asphalt shingles", "asphalt torch on", "asphalt/gravel"]),
    ("cedar shake", ["cedar shake", "cedar shakes"]),
    ("clay", ["clay tile"]),
    ("concrete", ["concrete", "concrete tiles"]),
    ("fiberglass", ["fiberglass", "fiberglass shingles", "fibreglass shingle"]),
    ("flat", ["flat", "flat torch membrane", "membrane", "epdm membrane"]),
    ("metal", ["metal", "metal shingles", "steel", "tin"]),
    ("pine shake", ["pine shake", "pine shakes"]),
    ("rubber", ["rubber"]),
    ("sbs", ["sbs roofing system"]),
    ("shake", ["shake"]),
    ("shingle", ["shingle", "vinyl shingles"]),
    ("slate", ["slate"]),
    ("tar", ["tar & gravel", "tar &amp; gravel", "tar/gravel"]),
    ("tile", ["tile"]),
    ("wood", ["wood", "wood shingle", "wood shingles"]),
    ("other", ["conventional", "mixed", "other"]),
]

SEWER: Vocabulary = [
    ("municipal", ["municipal/community", "municipal sewage system", "sanitary sewer", "sewer",
                   "sewer connected", "sewer to lot", "sewer available", "public sewer",
                   "attached to municipal"]),
    ("septic", ["septic tank", "septic system", "septic system: common", "septic field",
                "septic tank and field", "septic tank & mound", "mound septic",
                "septic tank & field", "septic needed", "engineered septic"]),
    ("private", ["private sewer", "holding tank", "low pressure sewage sys", "shared septic"]),
    ("alternative", ["aerobic treatment system", "facultative lagoon", "lagoon", "outflow tank",
                     "open discharge", "liquid surface dis", "pump", "tank & straight discharge"]),
    ("none", ["no sewage system", "outhouse", "none"]),
]

# ---- FIXED VALUES: flat term lists ---------------------------------------------

GARAGE_KEYWORDS = ["garage", "carport", "grge", "attached", "detached", "tandem", "car"]
GARAGE_EXCLUDED_TERM = "no garage"

PARKING_TERMS = [
    "2 outdoor stalls", "add. parking avail.", "additional parking", "assigned", "carport",
    "carport & garage", "carport double", "carport quad+", "carport triple", "carport; multiple",
    "carport; single", "multiple driveways", "parkade", "parking lot", "parking pad",
    "parking pad cement/paved", "parking space(s)", "parking spaces", "rv", "rv access/parking",
    "rv gated", "rv hookup", "rv parking", "rv parking avail.", "shared driveway", "stall",
    "tandem parking", "underground", "underground parking", "visitor parking",
]

POOL_TERMS = ["swimming pool", "public swimming pool"]

GARDEN_TERMS = ["vegetable garden", "garden", "fruit trees/shrubs", "private yard",
                "partially landscaped", "landscaped"]

BALCONY_TERMS = ["balcony", "balcony/deck", "balcony/patio"]

VIEW_TERMS = ["view downtown", "river view", "view city", "view lake", "lake view", "ravine view",
              "river valley view"]

# view phrase -> label
VIEW_LABELS = {
    "view lake": "Lake",
    "lake view": "Lake",
    "view downtown": "Downtown",
    "view city": "City",
    "river view": "River",
    "ravine view": "Valley",
    "river valley view": "Valley",
}

# Fireplace cells that mean "none".
FIREPLACE_ABSENT = ["0", "[]", '["0"]']

# Known bad bathroom count and its correction.
BATHS_BAD_VALUE = 803
BATHS_FIXED_VALUE = "1"

# Textual missing-value markers recognised by a default pandas CSV read
# (exact, case-sensitive, untrimmed).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Region codes of the daily load.
REGION_CODES = ["ab", "bc", "mb", "nb", "nl", "ns", "nt", "on", "pe", "sk", "yt"]

# Size and price bounds of the final consistency filter.
MIN_SQUARE_FOOTAGE_EXCLUSIVE = 120
MIN_PRICE_INCLUSIVE = 50000

# File name marker excluded by the directory importer (case-insensitive).
CLEANED_FILE_MARKER = "cleaned_canada"


def view_vocabulary() -> Vocabulary:
    """View phrases as an ordered vocabulary: the first phrase in term
    order decides the label (a deterministic choice for the original's
    arbitrary pick among several hits)."""
    labels: Vocabulary = []
    for term in VIEW_TERMS:
        label = VIEW_LABELS[term]
        for existing, terms in labels:
            if existing == label:
                terms.append(term)
                break
        else:
            labels.append((label, [term]))
    return labels
