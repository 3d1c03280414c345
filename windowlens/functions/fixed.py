"""Fixed values.

These values must stay exactly as they are for results to agree with the
original log-anomaly job (line format, thresholds, report buckets, traffic
bands, published model coefficients, training settings).  They are stated
once here, in their natural order; every other module takes them as default
arguments so they can be overridden per call.
"""

# --- FIXED VALUES (must equal the original job) -----------------------------

# Access-log line: "<yyyy-MM-dd HH:mm:ss> <endpoint> <status> <bytes>",
# anchored so that a line either conforms fully or is rejected.
LOG_LINE_PATTERN = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) (/\S+) (\d{3}) (\d+)$"

# Text format of timestamps in log lines and label files.
TIMESTAMP_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_TEXT_FORMAT = "yyyy-MM-dd"

# Feature windows: 5-minute tumbling windows; a status at or above 400 is an
# error; response-size percentile 0.95.
WINDOW_WIDTH = "5 minutes"
ERROR_STATUS_MIN = 400
SIZE_PERCENTILE = 0.95

# Feature columns in model order, and the label column.
FEATURE_COLUMNS = ["total_requests", "error_rate", "avg_response_size", "p95_response_size"]
LABEL_COLUMN = "is_anomalous"

# Error-rate report: quantiles and histogram buckets [0,5%) [5,15%) [15,40%) [40%,..].
ERROR_RATE_QUANTILES = [0.25, 0.5, 0.75, 0.95]
ERROR_RATE_BUCKETS = [(0.05, "0-5%"), (0.15, "5-15%"), (0.40, "15-40%"), (None, "40-100%")]

# Example windows shown per label class: 3 error, 2 size, 2 normal.
SAMPLES_PER_CLASS = {"error": 3, "size": 2, "none": 2}

# Traffic profile: hour-of-day bands [from, to) with their factor, the factor
# for hours after the last band, and the weekend (Saturday, Sunday) factor.
DAYPART_BANDS = [(0, 5, 0.15), (5, 8, 0.5), (8, 12, 1.5), (12, 14, 1.3), (14, 18, 1.6), (18, 22, 1.2)]
DAYPART_LATE_FACTOR = 0.6
WEEKEND_FACTOR = 0.8

# Share of windows that are labelled anomalous; label types alternate
# error, size, error, ... in time order.
ANOMALY_WINDOW_FRACTION = 0.04
ANOMALY_TYPES = ["error", "size"]

# Published coefficients of the best logistic-regression model (feature order
# as FEATURE_COLUMNS) and its intercept; decision threshold 0.5.
PUBLISHED_COEFFICIENTS = {
    "total_requests": -0.000076,
    "error_rate": 20.283957,
    "avg_response_size": 0.000549,
    "p95_response_size": 0.000173,
}
PUBLISHED_INTERCEPT = -7.309759
DECISION_THRESHOLD = 0.5

# Training: chronological 80/20 split; grid search over regParam x
# elasticNetParam with 3-fold cross-validation, seed 42.
TRAIN_FRACTION = 0.8
GRID_REG_PARAM = [0.01, 0.1, 1.0]
GRID_ELASTIC_NET = [0.0, 0.5, 1.0]
CV_FOLDS = 3
CV_SEED = 42

# --- end of fixed values ------------------------------------------------------
