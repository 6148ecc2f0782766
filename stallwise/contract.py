"""Column lists, vocabularies and thresholds that results depend on."""

# Model columns, in model order.
NUMERIC_FEATURES = [
    "order_day_of_week",
    "order_hour",
    "order_month",
    "total_payment_value",
    "payment_installments",
    "payment_type_count",
    "product_weight_g",
    "product_volume_cm3",
    "customer_seller_same_state",
    "seller_avg_delivery_days_historical",
    "freight_value",
    "freight_ratio",
    "estimated_delivery_days",
]
CATEGORICAL_FEATURES = ["product_category", "customer_state", "seller_state"]
IDENTIFIER_COLUMNS = ["order_id", "order_purchase_timestamp", "seller_id"]
LABEL = "is_delayed"

# Vocabularies.
ORDER_STATUSES = [
    "delivered", "shipped", "invoiced", "processing", "canceled", "unavailable", "created", "approved",
]
VALID_STATUSES = ["delivered", "shipped", "invoiced", "processing"]
STATUS_GROUPS = {
    "placed": ["created", "approved"],
    "in_transit": ["invoiced", "shipped"],
    "delivered": ["delivered"],
    "canceled": ["canceled"],
}
OTHER_STATUS = "other"
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
NO_CATEGORY = "uncategorized"
MISSING_CATEGORY = "missing"
NULL_CATEGORY = "__NULL__"
# a null part of a surrogate key is hashed as this text
KEY_NULL_MARKER = "_dbt_utils_surrogate_key_null_"

# Thresholds.
CLASS_THRESHOLD = 0.5
FALSE_POSITIVE_COST = 10.0
FALSE_NEGATIVE_COST = 50.0
AUC_ALERT_DELTA = 0.05
TOP_FRACTION = 0.10
PSI_BINS = 10
PSI_MIN_CURRENT_ROWS = 10
PSI_MIN_EDGES = 3
PSI_FLOOR = 1e-6
PSI_WARNING = 0.1
PSI_ALERT = 0.2
SHARE_WARNING = 0.1
SHARE_ALERT = 0.2
TOP_SHIFTS = 5
MAX_CATEGORIES = 40
MAX_ITERATIONS = 2000
RETRAIN_MONTHS = 3
RETRAIN_ALERT_MONTHS = 2
RETRAIN_PSI = 0.2
RETRAIN_PSI_FEATURES = 3
