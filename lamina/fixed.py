"""Fixed values.

These numbers must equal the reference's for the same results; they are
stated here once, in natural order, and imported where used.
"""

# --- Fixed values (must match the reference) ---------------------------------------

# rounding of published measures and percentages
DECIMALS = 2

# label 1 when the measurement reaches 743
LABEL_THRESHOLD = 743

# smoothed group rate (sum(y) + 5) / (count(y) + 10)
RATE_PRIOR_POSITIVES = 5.0
RATE_PRIOR_COUNT = 10.0

# training-sample target and seed
SAMPLE_TARGET_ROWS = 250_000
SEED = 42

# split: 70 % train, 15 % validation, 15 % test; 5 target-encoding folds
TRAIN_PCT = 70
VALIDATION_PCT = 15
ENCODER_FOLDS = 5

# decision threshold sweep: 36 points 0.40, 0.41, ..., 0.75; default 0.50
SWEEP_START_PCT = 40
SWEEP_POINTS = 36
SWEEP_DIVISOR = 100
DEFAULT_THRESHOLD = 0.5

# risk tiers on the class-1 probability in percent: < 45 high, < 70 medium, else low
RISK_HIGH_BELOW = 45.0
RISK_LOW_FROM = 70.0

# benchmark candidates: logistic (1000 iterations, C = 1, tolerance 1e-4 -- the
# reference library's default), forest (120 trees, depth 14, 75 % rows per tree),
# boosted trees (160 rounds, rate 0.06, depth 6)
LOGISTIC_PARAMS = {"maxIter": 1000, "C": 1.0, "tol": 1e-4}
FOREST_PARAMS = {"trees": 120, "depth": 14, "share": 0.75}
BOOSTED_PARAMS = {"rounds": 160, "step": 0.06, "depth": 6}

# random search: 3 draws, 3 folds, scored by ROC-AUC
SEARCH_DRAWS = 3
SEARCH_FOLDS = 3
BOOSTED_GRID = {"rounds": [120, 200], "depth": [5, 7, 9], "step": [0.03, 0.06],
                "subsample": [0.8, 1.0], "colsample": [0.7, 0.9]}
FOREST_GRID = {"trees": [100, 160], "depth": [12, 18], "min_split": [5, 10]}
LOGISTIC_GRID = {"C": [0.1, 1.0, 5.0]}
