"""Fixed values that results depend on."""

# Treatment arms in report order, with their numeric codes.
ARM_CODES = {
    "Placebo": 0,
    "Xanomeline Low Dose": 54,
    "Xanomeline High Dose": 81,
}

# Age groups in report order (also the codes 1, 2, 3).
AGE_GROUPS = ["<65", "65-80", ">80"]

# Race levels in report order.
RACE_LEVELS = [
    "WHITE",
    "BLACK OR AFRICAN AMERICAN",
    "AMERICAN INDIAN OR ALASKA NATIVE",
]

# Sites pooled into site group 900.
POOLED_SITES = ["702", "706", "707", "711", "714", "715", "717"]
POOLED_SITE_GROUP = "900"

# Terms and class of the dermatologic custom query.
CUSTOM_QUERY_NAME = "DERMATOLOGIC EVENTS"
CUSTOM_QUERY_TERMS = ["APPLICATION", "DERMATITIS", "ERYTHEMA", "BLISTER"]
CUSTOM_QUERY_CLASS = "SKIN AND SUBCUTANEOUS TISSUE DISORDERS"
CUSTOM_QUERY_EXCLUDED = ["COLD SWEAT", "HYPERHIDROSIS", "ALOPECIA"]

# Analysis visit windows (label, number, range text, first day,
# last day, target day).
SCORE_WINDOWS = [
    ("Baseline", 0, "<=1", None, 1, 1),
    ("Week 8", 8, "2-84", 2, 84, 56),
    ("Week 16", 16, "85-140", 85, 140, 112),
    ("Week 24", 24, ">140", 141, None, 168),
]

# Event and censor descriptions of the time-to-event record
# (spelling as in the published data).
EVENT_TEXT = "Dematologic Event Occured"
CENSOR_TEXT = "Study Completion Date"
