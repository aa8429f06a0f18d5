"""Labels, thresholds and tables that results must match."""

# order states
DELIVERED = "delivered"
LOST_STATUSES = ("canceled", "unavailable")

# seller lead time
LEAD_RISK_LEVEL = ("HIGH", "MEDIUM", "LOW")
LEAD_RISK_CATEGORY = ("High Risk", "Medium Risk", "Low Risk")

# product velocity
VELOCITY = ("FAST_MOVER", "REGULAR", "SLOW_MOVER")

# delay severity
SEVERITY = ("SEVERE", "MODERATE", "MINOR")

# season labels
SEASON = ("HIGH_SEASON", "LOW_SEASON", "NORMAL")

# ABC classes
ABC_POLICY_A = "Maintain high safety stock - weekly monitoring"
ABC_POLICY_B = "Moderate inventory - monthly review"
ABC_POLICY_C = "Minimal stock - reorder on demand"
ABC_PRIORITY = (100, 60, 20)

# fulfilment stages
STAGE_APPROVAL = "Purchase → Approval"
STAGE_PICKUP = "Approval → Carrier Pickup"
STAGE_DELIVERY = "Carrier → Customer Delivery"
BOTTLENECK = "⚠ BOTTLENECK"

# review early warning
SENTIMENT_TREND = ("Strong Negative", "Negative", "Neutral", "Positive")
WARNING_LEVEL = ("CRITICAL", "WARNING", "NORMAL")

# supplier risk
SUPPLIER_RISK = ("CRITICAL", "HIGH", "MEDIUM", "LOW")

# monthly report
REPORT_TITLE = "MONTHLY SUPPLY CHAIN REPORT"
SECTION_DELAYED = "TOP 5 DELAYED SELLERS"
SECTION_STOCKOUT = "STOCKOUT ALERTS"
SECTION_REVENUE = "REVENUE AT RISK SUMMARY"
SECTION_REORDER = "REORDER ALERTS"
REORDER_CRITICAL = "CRITICAL — Reorder now"
REORDER_LOW = "LOW STOCK — Review needed"
REORDER_ADEQUATE = "ADEQUATE"

# demand features
FEATURES = (
    "units_sold",
    "lag_1", "lag_7", "lag_14", "lag_30",
    "rolling_mean_7", "rolling_mean_30",
    "rolling_std_7", "rolling_std_30",
    "seasonality_index",
    "month_sin", "month_cos",
    "dow_sin", "dow_cos",
    "is_weekend", "is_holiday", "days_to_holiday",
    "trend_strength", "acceleration",
)
SCALED_FEATURES = (
    "lag_1", "lag_7", "lag_14", "lag_30",
    "rolling_mean_7", "rolling_mean_30",
    "rolling_std_7", "rolling_std_30",
    "seasonality_index",
    "trend_strength", "acceleration",
)

# service level -> z
SERVICE_LEVEL_Z = (
    (0.50, 0.00), (0.80, 0.84), (0.85, 1.04), (0.90, 1.28), (0.95, 1.65),
    (0.975, 1.96), (0.99, 2.33), (0.995, 2.58), (0.999, 3.09),
)
SERVICE_LEVELS = (0.80, 0.85, 0.90, 0.95, 0.975, 0.99)
LEAD_TIMES = (1, 3, 5, 7, 9, 11, 13, 15, 17, 19, 21)

# model routing
MODEL_FAMILIES = ("baseline", "lstm", "gbm")
NO_CLEAR_WINNER = "no_clear_winner"
INSUFFICIENT_DATA = "insufficient_data"

# lift labels
LIFT = ("genuine_beat", "loses", "no_signal", "unknown")

# interval coverage labels
COVERAGE_LOW = "OVERCONFIDENT — intervals too narrow"
COVERAGE_HIGH = "CONSERVATIVE — intervals too wide"
COVERAGE_OK = "WELL-CALIBRATED"
COVERAGE_NONE = "N/A"

# published sentiment-scoring constants
SENTIMENT_NORMALISER = 15
SENTIMENT_NEGATION_FACTOR = -0.74
