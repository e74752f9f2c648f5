"""Table schemas and the fixed values shared by all jobs."""

from pyspark.sql import types as T

# Column names of the card-transaction data set.
V_COLUMNS = [f"V{i}" for i in range(1, 29)]
LABEL = "Class"
RAW_COLUMNS = ["Time", *V_COLUMNS, "Amount", LABEL]

# Engineered features and the order in which a model sees its inputs.
ENGINEERED = ["hour_of_day", "sin_hour", "cos_hour", "log_amount", "amount_ratio"]
FEATURES = [*V_COLUMNS, "Amount", *ENGINEERED]

# Scoring defaults.
SEED = 42
TEST_SHARE = 0.20
LOW_MAX = 30.0
MEDIUM_MAX = 70.0
DECISION_THRESHOLD = 0.35
FALLBACK_MEDIAN_AMOUNT = 22.0
TRADEOFF_THRESHOLDS = [0.20, 0.30, 0.35, 0.40, 0.50, 0.60, 0.70]

# Domains of the audit table.
RISK_LEVELS = ["HIGH", "MEDIUM", "LOW"]
PREDICTIONS = ["LEGITIMATE", "FRAUD"]

RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in RAW_COLUMNS[:-1]]
    + [T.StructField(LABEL, T.IntegerType())]
)

PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("Time", T.DoubleType()),
        T.StructField("Amount", T.DoubleType()),
        T.StructField("actual_class", T.IntegerType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in V_COLUMNS]
)

TRANSACTIONS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("transaction_time", T.DoubleType(), False),
        T.StructField("amount", T.DoubleType(), False),
        T.StructField("actual_class", T.IntegerType()),
        T.StructField("predicted_class", T.StringType(), False),
        T.StructField("fraud_probability", T.DoubleType(), False),
        T.StructField("risk_score", T.DoubleType(), False),
        T.StructField("risk_level", T.StringType(), False),
        T.StructField("created_at", T.TimestampType(), False),
    ]
)

FACTORS_TYPE = "array<struct<feature: string, impact: string, weight: double>>"
