"""Data that drives the operators; no logic here.

Everything in this file is a fixed value: results match the expected ones only
if these lists, patterns and labels stay as they are. All of them can be
replaced by passing your own to the operators.
"""

from __future__ import annotations

# --- Fixed values: contamination rules, most important first -----------------
# (flag suffix, label, Java regular expression found anywhere in the text).
# The rules are deliberately loose: "may help the colic" counts as E. coli,
# "gluten free" as wheat and "glass jars" as a foreign object.
CONTAMINATION_RULES = (
    ("salmonella", "Salmonella", r"(?i)salmonella"),
    ("listeria", "Listeria", r"(?i)listeria|l\.\s*monocytogenes"),
    ("ecoli", "E. coli", r"(?i)e\.?\s*coli|escherichia"),
    (
        "undeclared_milk",
        "Undeclared Allergen - Milk",
        r"(?i)undeclared.*milk|milk.*undeclared|contains\s+milk",
    ),
    (
        "undeclared_peanut",
        "Undeclared Allergen - Peanut",
        r"(?i)undeclared.*peanut|peanut.*undeclared",
    ),
    (
        "undeclared_soy",
        "Undeclared Allergen - Soy",
        r"(?i)undeclared.*soy|soy.*undeclared",
    ),
    (
        "undeclared_egg",
        "Undeclared Allergen - Egg",
        r"(?i)undeclared.*egg|egg.*undeclared",
    ),
    (
        "undeclared_wheat",
        "Undeclared Allergen - Wheat",
        r"(?i)undeclared.*wheat|wheat.*undeclared|gluten",
    ),
    (
        "undeclared_tree_nuts",
        "Undeclared Allergen - Tree Nuts",
        r"(?i)undeclared.*(almond|cashew|walnut|pecan|tree.?nut|pistachio|macadamia)",
    ),
    (
        "undeclared_allergen_other",
        "Undeclared Allergen - Other",
        r"(?i)undeclared.*allergen|allergen.*undeclared",
    ),
    (
        "foreign_object",
        "Foreign Object",
        r"(?i)foreign (object|material|body|matter)|glass|metal.*fragment"
        r"|plastic.*fragment|plastic.*piece",
    ),
    (
        "mislabeling",
        "Mislabeling",
        r"(?i)mislabel|misbranded|incorrect.*label|wrong.*label",
    ),
)
DEFAULT_CATEGORY = "Other"

# Lower-case literals per rule, at least one of which is in every text that the
# rule's pattern matches. A rule without literals is searched in every text.
CONTAMINATION_LITERALS = {
    "salmonella": ("salmonella",),
    "listeria": ("listeria", "monocytogenes"),
    "ecoli": ("coli", "escherichia"),
    "undeclared_milk": ("milk",),
    "undeclared_peanut": ("peanut",),
    "undeclared_soy": ("soy",),
    "undeclared_egg": ("egg",),
    "undeclared_wheat": ("wheat", "gluten"),
    "undeclared_tree_nuts": ("undeclared",),
    "undeclared_allergen_other": ("allergen",),
    "foreign_object": ("foreign ", "glass", "fragment", "plastic"),
    "mislabeling": ("mislabel", "misbranded", "incorrect", "wrong"),
}
FLAG_PREFIX = "contam_"

# --- Fixed values: category groups ------------------------------------------
BIOLOGICAL_CATEGORIES = ("Salmonella", "Listeria", "E. coli")
ALLERGEN_PREFIX = "Undeclared Allergen"
PHYSICAL_CATEGORY = "Foreign Object"
LABELING_CATEGORY = "Mislabeling"

# --- Fixed values: the 50 states and the federal district --------------------
STATE_CODES = {
    "alabama": "AL",
    "alaska": "AK",
    "arizona": "AZ",
    "arkansas": "AR",
    "california": "CA",
    "colorado": "CO",
    "connecticut": "CT",
    "delaware": "DE",
    "district of columbia": "DC",
    "florida": "FL",
    "georgia": "GA",
    "hawaii": "HI",
    "idaho": "ID",
    "illinois": "IL",
    "indiana": "IN",
    "iowa": "IA",
    "kansas": "KS",
    "kentucky": "KY",
    "louisiana": "LA",
    "maine": "ME",
    "maryland": "MD",
    "massachusetts": "MA",
    "michigan": "MI",
    "minnesota": "MN",
    "mississippi": "MS",
    "missouri": "MO",
    "montana": "MT",
    "nebraska": "NE",
    "nevada": "NV",
    "new hampshire": "NH",
    "new jersey": "NJ",
    "new mexico": "NM",
    "new york": "NY",
    "north carolina": "NC",
    "north dakota": "ND",
    "ohio": "OH",
    "oklahoma": "OK",
    "oregon": "OR",
    "pennsylvania": "PA",
    "rhode island": "RI",
    "south carolina": "SC",
    "south dakota": "SD",
    "tennessee": "TN",
    "texas": "TX",
    "utah": "UT",
    "vermont": "VT",
    "virginia": "VA",
    "washington": "WA",
    "west virginia": "WV",
    "wisconsin": "WI",
    "wyoming": "WY",
}

# --- Fixed values: accepted values, minimum sizes and required fields --------
CLASSIFICATIONS = (
    "Class I",
    "Class II",
    "Class III",
    "Public Health Alert",
    "Not Yet Classified",
)
MOST_SERIOUS_CLASS = "Class I"
AGENCIES = ("FDA", "FSIS")

MIN_ROWS = {"fda": 10_000, "fsis": 50}
REQUIRED_FIELDS = {
    "fda": ("recall_number", "classification", "report_date", "reason_for_recall"),
    "fsis": ("field_title", "field_recall_classification", "field_recall_date"),
}

# --- Fixed values: how the firm key spells nulls -----------------------------
KEY_NULL_MARKER = "_dbt_utils_surrogate_key_null_"
UNKNOWN_STATE = "UNKNOWN"
