"""Fixed values.

Everything in this module is a value that must equal the published
match-result column codes and the run settings this library reproduces:
column codes, exclusion families, the result-category table, label columns,
label expressions, trainer defaults and override lists. They are written
plainly, in their natural order, and nothing else lives here.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: column catalogue (the 100 known column codes of a match file)
# ---------------------------------------------------------------------------
CATALOGUE = [
    "Div", "Date", "HomeTeam", "AwayTeam",
    "FTHG", "FTAG", "FTR", "HTHG", "HTAG", "HTR",
    "Attendance", "Referee",
    "HS", "AS", "HST", "AST", "HHW", "AHW", "HC", "AC", "HF", "AF",
    "HO", "AO", "HY", "AY", "HR", "AR", "HBP", "ABP",
    "B365H", "B365D", "B365A",
    "BSH", "BSD", "BSA",
    "BWH", "BWD", "BWA",
    "GBH", "GBD", "GBA",
    "IWH", "IWD", "IWA",
    "LBH", "LBD", "LBA",
    "PSH", "PSD", "PSA",
    "SOH", "SOD", "SOA",
    "SBH", "SBD", "SBA",
    "SJH", "SJD", "SJA",
    "SYH", "SYD", "SYA",
    "VCH", "VCD", "VCA",
    "WHH", "WHD", "WHA",
    "Bb1X2", "BbMxH", "BbAvH", "BbMxD", "BbAvD", "BbMxA", "BbAvA",
    "BbOU", "BbMx>2.5", "BbAv>2.5", "BbMx<2.5", "BbAv<2.5",
    "GB>2.5", "GB<2.5", "B365>2.5", "B365<2.5",
    "BbAH", "BbAHh", "BbMxAHH", "BbAvAHH", "BbMxAHA", "BbAvAHA",
    "GBAHH", "GBAHA", "GBAH",
    "LBAHH", "LBAHA", "LBAH",
    "B365AHH", "B365AHA", "B365AH",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: exclusion families
# ---------------------------------------------------------------------------
# Always dropped: identity, in-match facts, plus three names that are not in
# the catalogue (HT, AT, LB).
BASE_EXCLUDES = [
    "Div", "Date", "HomeTeam", "AwayTeam", "Attendance", "Referee",
    "HS", "AS", "HST", "AST", "HHW", "AHW", "HC", "AC", "HF", "AF",
    "HO", "AO", "HY", "AY", "HR", "AR", "HBP", "ABP",
    "HT", "AT", "LB",
]
ASIAN_HANDICAP = [
    "BbAH", "BbAHh", "BbMxAHH", "BbAvAHH", "BbMxAHA", "BbAvAHA",
    "GBAHH", "GBAHA", "GBAH", "LBAHH", "LBAHA", "LBAH",
    "B365AHH", "B365AHA", "B365AH",
]
OVER_UNDER_2_5 = [
    "BbOU", "BbMx>2.5", "BbAv>2.5", "BbMx<2.5", "BbAv<2.5",
    "GB>2.5", "GB<2.5", "B365>2.5", "B365<2.5",
]
AVERAGES_MAXIMUMS = [
    "Bb1X2", "BbMxH", "BbAvH", "BbMxD", "BbAvD", "BbMxA", "BbAvA",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: result categories (text cell -> number)
# ---------------------------------------------------------------------------
RESULT_CATEGORIES = {"H": 1.0, "D": 0.0, "A": -1.0}

# ---------------------------------------------------------------------------
# FIXED VALUES: label block and label expressions
# ---------------------------------------------------------------------------
LABELS = ["FTHG", "FTAG", "FTR", "HTHG", "HTAG", "HTR"]
LABEL_EXPRESSIONS = ["FTR", "FTAG - FTHG", "HTR", "HTAG - HTHG"]

# ---------------------------------------------------------------------------
# FIXED VALUES: seasons of the main run, components, split, accepted number pattern
# ---------------------------------------------------------------------------
MAIN_RUN_START_YEAR = 2000
MAIN_RUN_END_YEAR = 2015
PCA_COMPONENTS = 9
PCA_NORM_P = 2.0
PCA_CONFIDENCE = 0.999
TRAIN_SHARE = 0.7
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# ---------------------------------------------------------------------------
# FIXED VALUES: trainer defaults, in the reference's own parameter names
# (iterations, step, miniBatchFraction, regParam, regType, intercept,
# convergenceTol / tolerance, numClasses, corrections, lambda_, isotonic)
# ---------------------------------------------------------------------------
TRAINER_DEFAULTS = {
    "linear": {"iterations": 10, "step": 1.0, "miniBatchFraction": 1.0,
               "regParam": 0.0, "regType": None, "intercept": False,
               "convergenceTol": 0.0001},
    "ridge": {"iterations": 100, "step": 1.0, "miniBatchFraction": 1.0,
              "regParam": 0.01, "intercept": False, "convergenceTol": 0.0001},
    "lasso": {"iterations": 100, "step": 1.0, "miniBatchFraction": 1.0,
              "regParam": 0.01, "intercept": False, "convergenceTol": 0.0001},
    "isotonic": {"isotonic": True},
    "logistic": {"iterations": 1000, "step": 1.0, "miniBatchFraction": 1.0,
                 "regParam": 0.01, "regType": "l2", "intercept": False,
                 "convergenceTol": 0.0001},
    "multinomial": {"iterations": 1000, "numClasses": 3, "corrections": 10,
                    "regParam": 0.01, "regType": "l2", "intercept": False,
                    "tolerance": 0.0001},
    "svm": {"iterations": 1000, "step": 1.0, "miniBatchFraction": 1.0,
            "regParam": 0.01, "regType": "l2", "intercept": False,
            "convergenceTol": 0.0001},
    "naive_bayes": {"lambda_": 1.0},
}

# ---------------------------------------------------------------------------
# FIXED VALUES: override lists of the main sweep ({} = the defaults)
# ---------------------------------------------------------------------------
TRAINER_OVERRIDES = {
    "logistic": [
        {},
        {"step": 0.5, "regParam": 0.005},
        {"step": 1.0, "regParam": 0.005},
        {"step": 0.5, "regParam": 0.01},
    ],
    "svm": [
        {},
        {"step": 0.5, "regParam": 0.005},
        {"step": 1.0, "regParam": 0.005},
        {"step": 0.5, "regParam": 0.01},
    ],
    "naive_bayes": [
        {},
        {"lambda_": 1e-3},
        {"lambda_": 5e-3},
        {"lambda_": 1e-5},
        {"lambda_": 5e-5},
        {"lambda_": 1e-6},
        {"lambda_": 5e-6},
        {"lambda_": 1e-7},
        {"lambda_": 10000.0},
        {"lambda_": 50000.0},
        {"lambda_": 1e5},
        {"lambda_": 5e5},
        {"lambda_": 1e6},
        {"lambda_": 5e6},
        {"lambda_": 1e7},
    ],
}

# Trainers of the main run, in order.
MAIN_RUN_TRAINERS = ["logistic", "naive_bayes", "svm"]
