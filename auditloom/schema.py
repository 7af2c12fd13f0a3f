"""Fixed values of the transaction model: columns, weights, tiers, lookup texts."""

from pyspark.sql import types as T

# The time of step 0.
BASE_TIMESTAMP = "2024-01-01 00:00:00"

# Names and types of the raw columns.
RAW_SCHEMA = T.StructType([
    T.StructField("step", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("nameOrig", T.StringType()),
    T.StructField("oldbalanceOrg", T.DoubleType()),
    T.StructField("newbalanceOrig", T.DoubleType()),
    T.StructField("nameDest", T.StringType()),
    T.StructField("oldbalanceDest", T.DoubleType()),
    T.StructField("newbalanceDest", T.DoubleType()),
    T.StructField("isFraud", T.IntegerType()),
    T.StructField("isFlaggedFraud", T.IntegerType()),
])
RAW_COLUMNS = RAW_SCHEMA.fieldNames()

# Columns of the clean table.
CLEAN_COLUMNS = RAW_COLUMNS + [
    "is_missing_amount", "is_missing_orig_balance", "timestamp", "hour_of_day",
    "day_of_week", "is_weekend", "is_night", "vendor_id", "category",
    "is_merchant_dest", "is_exact_duplicate", "is_near_duplicate",
]

# The seven signals.
SIGNALS = [
    "flag_duplicate", "flag_large_transaction", "flag_unusual_timing",
    "flag_vendor_spike", "flag_velocity", "flag_multivariate_outlier",
    "flag_concentration",
]

# Columns of the flagged table.
FLAGGED_COLUMNS = CLEAN_COLUMNS + [
    "flag_exact_duplicate", "flag_near_duplicate", "flag_duplicate",
    "flag_large_transaction", "flag_unusual_timing", "flag_vendor_spike",
    "flag_velocity", "balance_delta_orig", "flag_multivariate_outlier",
    "user_hhi", "flag_concentration", "anomaly_score", "flag_reasons",
    "is_flagged", "risk_level",
]

# Score weight and reason text of each signal, in reason order.
SCORE_RULES = [
    ("flag_duplicate", 25, "Duplicate Transaction"),
    ("flag_large_transaction", 20, "High Amount vs Category"),
    ("flag_vendor_spike", 20, "Abnormal Vendor Spike"),
    ("flag_velocity", 15, "High Velocity Burst"),
    ("flag_multivariate_outlier", 15, "Multivariate Outlier"),
    ("flag_unusual_timing", 10, "Unusual Timing / Night"),
    ("flag_concentration", 10, "High Spend Concentration"),
    ("isFraud", 50, "Reported Fraud Ground Truth"),
]

# The highest score, the score from which a row is flagged, the floor of each level.
MAX_SCORE = 100
FLAG_SCORE = 35
RISK_LEVELS = [(75, "CRITICAL"), (45, "HIGH"), (20, "MEDIUM")]

# Score at which each review action starts.
ACTION_TIERS = [
    (75, "Immediate Freeze"),
    (50, "Queue for Tier-1 Auditor"),
    (20, "Step-Up Auth"),
    (0, "Auto-Approve"),
]

# Display colour of each risk level.
RISK_COLORS = {
    "CRITICAL": "#D32F2F",
    "HIGH": "#F57C00",
    "MEDIUM": "#FBC02D",
    "LOW": "#388E3C",
}
OTHER_COLOR = "#9E9E9E"

# Category id, name, description, risk profile.
CATEGORY_INFO = [
    ("PAYMENT", "Retail & Merchant Payment",
     "Consumer point-of-sale and online merchant checkout transactions", "Low"),
    ("TRANSFER", "Wire & P2P Transfer",
     "Direct electronic account-to-account funds transfers", "High"),
    ("CASH_OUT", "Cash Withdrawal",
     "Disbursement of physical currency via agent or ATM", "High"),
    ("DEBIT", "Debit / POS Card",
     "Direct debit from bank account or debit card processing", "Low"),
    ("CASH_IN", "Deposit & Funding",
     "Inflow of funds into customer wallet or bank account", "Low"),
]

# Merchant names a vendor id is mapped to.
MERCHANT_BRANDS = [
    "Amazon Web Store", "Starbucks Coffee", "Shell Oil Station", "Walmart Supercenter",
    "Target Retail", "Apple Services", "Uber Technologies", "Delta Air Lines",
    "Costco Wholesale", "Home Depot", "Netflix Streaming", "McDonald's Global",
    "Best Buy Electronics", "CVS Pharmacy", "Walgreens Health", "Chevron Gas",
    "Kroger Groceries", "Nike Direct", "FedEx Freight", "Stripe Online Merchant",
]

# Share of flagged rows, in percent, at which each vendor tier starts.
VENDOR_TIERS = [(15.0, "HIGH_RISK"), (5.0, "MEDIUM_RISK")]

# Raw columns that have another name in the fact.
FACT_RENAMES = {
    "nameOrig": "user_orig_id",
    "oldbalanceOrg": "old_balance_orig",
    "newbalanceOrig": "new_balance_orig",
    "oldbalanceDest": "old_balance_dest",
    "newbalanceDest": "new_balance_dest",
    "isFraud": "is_fraud_ground_truth",
}

# Columns of the report of suspicious transactions.
SUSPICIOUS_COLUMNS = [
    "transaction_id", "timestamp", "amount", "category", "vendor_name", "vendor_id", "user_orig_id", "anomaly_score",
    "risk_level", "flag_reasons", *SIGNALS, "is_fraud_ground_truth",
]

# Columns of the vendor report, and the vendor columns they show.
VENDOR_REPORT = {
    "vendor_id": "vendor_id",
    "vendor_name": "vendor_name",
    "vendor_risk_tier": "vendor_risk_tier",
    "total_transactions": "total_transactions",
    "total_volume": "total_volume",
    "avg_transaction_size": "avg_transaction_amount",
    "flagged_transaction_count": "flagged_count",
    "flagged_ratio_pct": "flagged_rate_pct",
}
