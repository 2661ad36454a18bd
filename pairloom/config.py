"""Fixed values of the linkage rules.

Everything here must equal the published rules for results to agree, so it is
kept together as plain data: codes, word lists, key numbers and thresholds.
"""

# --- missing codes, per raw column ---------------------------------------------
CODES_TO_NULL = {
    "sex": ("-9", "-7"),
    "address": ("-9", "-8"),
    "estimate_age": ("-8", "-4"),
    "left_accommodation": ("-9", "-7", "-3"),
    "left_tenure": ("-9", "-7"),
    "left_residents": ("-9", "-5"),
    "right_accommodation": ("-9", "-8", "-7"),
    "right_tenure": ("-9", "-8", "-7"),
    "right_residents": ("-9", "-5", "-4"),
}
CODES_TO_BLANK = {
    "name": ("-9",),
    "resident_name": ("-9", "-4"),
    "age": ("-9",),
    "age_last_birthday": ("-9", "-8", "-5", "-4"),
}
NO_HOUSEHOLD = ("-9", "-8", "")
NO_ADDRESS_GIVEN = "-8"

# --- dummies: a missing left value never equals a missing right value --------------
DATE_MASK = {"left": "X", "right": "Y"}
SET_DUMMY = {
    "left": {"name": "XXXXX", "dob": "1800-08-08", "age": 888},
    "right": {"name": "YYYYY", "dob": "1700-07-07", "age": 777},
}

# --- address terms removed, in this order, before a house number is read ------------
FLOOR_TERMS = (
    "FIRST FLOOR FLAT",
    "FLAT 1ST FLOOR",
    "SECOND FLOOR FLAT",
    "FLAT 2ND FLOOR",
    "FLAT 1ST AND 2ND FLOOR",
    "FLAT 1ST 2ND AND 3RD FLOOR",
    "THIRD FLOOR FLAT",
    "FLAT 2ND AND 3RD FLOOR",
    "FLAT 3RD AND 4TH FLOOR",
    "FLAT 4TH AND 5TH FLOOR",
    "GROUND FLOOR FLAT",
)
UNIT_WORDS = ("FLAT", "APARTMENT", "UNIT", "ROOM")
FLAT_WORDS = ("FLAT", "APARTMENT")

# --- students away from their term-time address ----------------------------------
FULL_TIME = 1
AWAY_AT_TERM = {"left": (2, 3), "right": (2,)}

# --- person keys ---------------------------------------------------------------
CLERICAL_KEYS = (14, 31, 32)

# --- scoring -------------------------------------------------------------------
SCORE_VARIABLES = ("fn1", "sn1", "sex", "dob")
NAME_CUTOFF = 0.45
DOB_CUTOFF = 0.50
NAME_FULL_AGREEMENT = 0.90
RESCUE_NAME_FLOOR = 0.65
RESCUE_DOB = ((2, 0.70), (4, 0.55))
PARTIAL_SLOPE = 2
MAX_AGE_GAP = 5
ACCEPT_ABOVE = 40
CLERICAL_FROM = 8.5
BAND_STEP = 0.5
REVIEWED_SCORE = 99
