"""Fixed values shared by schemas, training, skew checks and scoring.

These must equal the reference's values for results to agree; they are stated
here once, in their natural order.
"""

# --- fixed values: ranker feature vocabulary, in vector order ---------------
FEATURE_COLS = [
    "rent", "walk_min", "age_years", "area_m2",
    "ctr", "fav_rate", "inquiry_rate",
    "me5_score", "lexical_rank", "semantic_rank",
]
# the seven listing-side features (skew check, null -> 0.0 at scoring)
LISTING_FEATURES = FEATURE_COLS[:7]

# --- fixed values: label gains per feedback action ---------------------------
ACTION_GAIN = {"inquiry": 3, "favorite": 2, "click": 1}
VALID_ACTIONS = ["click", "favorite", "inquiry"]

# --- fixed values: retrieval and fusion -----------------------------------------
RRF_K = 60
POOL_PER_RETRIEVER = 200
MIN_FUSED_POOL = 100
MISSING_RANK = 10000
DEFAULT_TOP_K = 20
MAX_TOP_K = 100
MAX_QUERY_CHARS = 512

# --- fixed values: monitoring thresholds ----------------------------------------
SKEW_WARN = 0.25
SKEW_FAIL = 0.5
VOLUME_MIN = 100
ME5_MEAN_LOW = 0.3
ME5_MEAN_HIGH = 0.95
DRIFT_THRESHOLD = 0.3
NEW_FEEDBACK_ROWS_THRESHOLD = 10000
NDCG_DEGRADATION = 0.03
STALE_DAYS = 7
PROMOTION_METRIC = "ndcg_at_10"
PROMOTION_THRESHOLD = 0.6

# --- fixed values: windows (days) -------------------------------------------------
BEHAVIOUR_WINDOW_DAYS = 28
TRAINING_WINDOW_DAYS = 90
FRESHNESS_DAYS = 2
LOCAL_TZ = "Asia/Tokyo"

# --- fixed values: LambdaRank hyper-parameters ------------------------------------
LAMBDARANK_PARAMS = {
    "num_leaves": 31,
    "learning_rate": 0.05,
    "feature_fraction": 0.9,
    "bagging_fraction": 0.8,
    "bagging_freq": 5,
    "min_data_in_leaf": 50,
    "num_iterations": 500,
    "early_stopping_rounds": 30,
    "lambdarank_truncation_level": 20,
}
EVAL_AT = [5, 10, 20]

# --- fixed values: encoder prompt prefixes and hash separator ----------------------
QUERY_PREFIX = "query: "
PASSAGE_PREFIX = "passage: "
HASH_SEPARATOR = "\x1f"
TITLE_DESCRIPTION_JOINER = "。"  # ideographic full stop
EMBEDDING_DIM_DECLARED = 768

# --- fixed values: latency histogram (exponential buckets) --------------------------
LATENCY_BUCKETS = 24
LATENCY_GROWTH = 2.0
LATENCY_SCALE = 1.0
LATENCY_P95_ALERT_MS = 500.0
ALERT_SUSTAIN_WINDOWS = 10

# --- fixed values: retrain trigger sources --------------------------------------------
TRIGGER_SOURCES = ["monitoring", "scheduler", "manual", "eventarc"]

# severities at or above ERROR in a request log
ERROR_SEVERITIES = ["ERROR", "CRITICAL", "ALERT", "EMERGENCY"]

# lifetime of a cached search result
CACHE_TTL_SECONDS = 120
