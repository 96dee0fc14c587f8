"""Thresholds, patterns, keyword lists and identifiers that results depend on."""

from __future__ import annotations

from stratakit.operators.units import MISSING_CODES

# Header cells that name a parameter, exactly or by a part of the name.
EXACT_NAMES = {"depth": ["m", "w", "h", "r", "cf"], "qc": ["q", "mpa"], "fs": ["mpa"], "u": ["u", "mpa"]}
PART_NAMES = {
    "depth": ["depth", "length", "top", "h "],
    "qc": ["qc", "q_c", "cone", "resistance", "res", "tip"],
    "fs": ["fs", "sleeve", "friction", "local"],
    "u": ["u2", "u ", "pore", "water", "dynamic"],
}
PARAMETERS = ["depth", "qc", "fs", "u"]

# Words that turn a header cell down for a parameter.
NEGATING = {
    "depth": ["drilled", "target", "start", "end", "water", "max", "initial", "final"],
    "qc": ["_id", "saturation", "method", "zero", "before", "after", "reducer", "pressure", "initial", "final"],
    "fs": ["reducer", "zero", "before", "after", "initial", "final"],
    "u": ["depth", "before", "after", "initial", "final"],
}

# Thresholds of the conditioning steps.
PLACEHOLDERS = MISSING_CODES
MIN_POINTS, MIN_ROW_SURPLUS, MAX_BLANKS = 3, 3, 4
TYPICAL_STEP, SMALLEST_STEP = 0.01, 0.001
CM_LIMIT, MM_LIMIT, QC_LIMIT, FS_LIMIT, U_LIMIT = 99.0, 999.0, 100.0, 10.0, 5.0
PERCENT_LIMIT = 75.0
GWL_RANGE, RATIO_RANGE = (0.0, 40.0), (0.2, 1.0)
MAX_SPT_DEPTH, MAX_BOREHOLE_DEPTH = 60.0, 70.0

# Identifiers of the dimension tables.
SOIL_TYPES = {"BOULDERS": 1, "CLAY": 2, "COBBLES": 3, "GRAVEL": 4, "SAND": 5, "SILT": 6}
TERMINATION_REASONS = {"refusal": 1, "target_depth": 2}
GWL_METHODS = {"assumed": 1, "collapsed": 2, "derived": 3, "dipper": 4, "estimated": 5, "measured": 6}
INVESTIGATION_TYPES = {"CPT": 1, "BH": 2}
HAMMER_TYPES = {"Auto": 1, "Safety": 2, "Standard": 3}
CPT_TO_VS = {
    "andrus_2007_holocene": 1, "andrus_2007_pleistocene": 2, "andrus_2007_tertiary_age_cooper_marl": 3, "hegazy_2006": 4,
    "mcgann_2015": 5, "mcgann_2018": 6, "robertson_2009": 7,
}
SPT_TO_VS = {"brandenberg_2010": 1, "kwak_2015": 2}
VS_TO_VS30 = {"boore_2004": 1, "boore_2011": 2}

# Records whose files are known to be corrupt, with category and details.
SPECIAL_CASES = {
    "CPT_59414": ("corrupt_file", "all data in first column"),
    "CPT_73271": ("corrupt_file", "data columns are not recognized"),
}

# File kinds by lower-case suffix.
FILE_KINDS = {".xlsx": "spreadsheet", ".xls": "spreadsheet", ".csv": "spreadsheet", ".txt": "spreadsheet", ".ags": "ags", ".pdf": "nondata", ".cpt": "nondata"}

# Patterns of the text miners.
NUMBER = r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"
DIGITS = r"\d+\.?\d*"
SPT_VALUE = r"\bNc?\s*(=|>)\s*(\d+)"
PERCENTAGE = r"(\d{1,3}(?:\.\d+)?)\s*%"
RATIO_LABEL = r"(?i)\b(ratio|efficien(t|cy)|hammer\s+energy)\b"
DEPTH_LABEL = r"^(depth|length)\s*(\(m\))?"

# Words that show how a sounding ended or a level was found.
TARGET_REACHED = [
    "target depth reached", "target depth reach", "reached target depth", "target reached", "reached_target",
    "reason for ending test:;;;target depth",
]
TARGET_MISSED = ["not", "prevent", "unable", "failed", "before"]
TARGET_FIELDS = ["remark", "remarks", "comment", "reason", "refusal factor", "termination", "resusal factor", "factor"]
REFUSED = [
    "refuse", "refusal", "limit of reaction force", "inclination (tilt) limit exceeded", "high", "buckling", "danger", "stop",
    "lifting", "max", "bending", "obstacle", "high qc", "effective refusal.", "danger of buckling rods",
]
MAX_THRUST = "termination critera: max thrust"
DEPTH_VALUES = [r"\d+\.?\d* c?m", r"\d+\.?\d*c?m", r"\d+\.?\d*c?m\.", r"\d+\.?\d*", "yes"]
LEVEL_WORDS = ["no", "not", "collapse", "assume", "estimate", "unavailable", "unable"]

# Search terms by the quantity they lead to.
TERMINATION_TERMS = ["target", "termination", "refusal", "reason", "reasons", "comment", "comments", "remark", "remarks"]
LEVEL_TERMS = ["gwl", "swl", "ground water", "waterlevel", "water level", "groundwater level", "water table", "water depth"]
RATIO_TERMS = [
    "alpha factor", "area ratio", "arearatio", "conearearatio", "conetipnetarearatio", "cone tip net area ratio",
    "net surface area quotient of cone tip", "a factor", "alphafactor",
]
TERM_QUANTITY = {
    **{t: "termination_reason" for t in TERMINATION_TERMS},
    **{t: "ground_water_level" for t in LEVEL_TERMS},
    **{t: "tip_net_area_ratio" for t in RATIO_TERMS},
}


def search_patterns() -> dict[str, dict[str, list[str]]]:
    """Per term the patterns under each assumption: ``standalone``, ``value`` (needs a field name), ``field`` (needs a value)."""
    ended = [*TARGET_REACHED, *REFUSED]
    reason = {"standalone": [*TARGET_REACHED, "REASON FOR ENDING TEST:;;;TRAGET DEPTH", *REFUSED, MAX_THRUST, "REASON FOR ENDING TEST:;;;GRAVELS"], "field": ended}
    remark = {"standalone": [*TARGET_REACHED, "target", *REFUSED, MAX_THRUST, "REASON FOR ENDING TEST:;;;GRAVELS"], "field": ended}
    out: dict[str, dict[str, list[str]]] = {
        "target": {"standalone": [*TARGET_REACHED, *TARGET_MISSED], "value": TARGET_FIELDS, "field": [*DEPTH_VALUES, "no"]},
        "termination": {"standalone": [MAX_THRUST], "field": ended},
        "refusal": {"field": ["no", *DEPTH_VALUES]},
    }
    out |= {t: reason for t in ("reason", "reasons")} | {t: remark for t in ("comment", "comments", "remark", "remarks")}
    out |= {t: {"standalone": [NUMBER, *LEVEL_WORDS], "field": [NUMBER, *LEVEL_WORDS]} for t in LEVEL_TERMS}
    return out | {t: {"standalone": [NUMBER], "field": [NUMBER]} for t in RATIO_TERMS}
