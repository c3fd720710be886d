"""Fixed schemas, column contracts and label tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Source column names, country spellings, windows, label cuts and
# the export contract. They define the results and must not be changed alone.
# ---------------------------------------------------------------------------
SOURCE_COLUMNS = {
    "Invoice": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "Country": "country",
}
COUNTRY_SPELLINGS = {
    "EIRE": "Ireland",
    "Korea": "South Korea",
    "RSA": "South Africa",
    "USA": "United States",
}
MERCHANDISE_PATTERN = r"^[0-9]{5}[A-Z]?\z"
UNKNOWN_PRODUCT = "Unknown Product"
TIMESTAMP_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
OBSERVATION_DAYS = 180
PREDICTION_DAYS = 90
SNAPSHOT_DATES = (
    dt.date(2010, 6, 1),
    dt.date(2010, 9, 1),
    dt.date(2010, 12, 1),
    dt.date(2011, 3, 1),
    dt.date(2011, 6, 1),
    dt.date(2011, 9, 1),
)
FEATURES = (
    "recency_days",
    "frequency",
    "monetary",
    "average_order_value",
    "unique_products",
    "active_days",
    "tenure_days",
    "avg_days_between_orders",
)
INACTIVE_PROBABILITY = 0.99
INACTIVE_METHOD = "Rule: no purchase in observation window"
MODEL_METHOD = "Selected classification model"
LOW_RISK_UP_TO = 0.40
MEDIUM_RISK_UP_TO = 0.70
LOGISTIC_NAME = "Logistic Regression"
FOREST_NAME = "Random Forest"
VALUE_MODEL_NAME = "Gradient Boosting (log target)"
EXPORT_COLUMNS = (
    "record_type",
    "record_id",
    "transaction_id",
    "invoice_no",
    "invoice_date",
    "transaction_year",
    "transaction_month",
    "source_period",
    "stock_code",
    "description",
    "quantity",
    "unit_price",
    "customer_id",
    "country",
    "revenue",
    "is_merchandise",
    "primary_country",
    "first_purchase_date",
    "last_purchase_date",
    "recency_days",
    "frequency",
    "monetary",
    "average_order_value",
    "total_items",
    "unique_products",
    "active_months",
    "tenure_days",
    "avg_days_between_orders",
    "rfm_score",
    "rfm_segment",
    "rule_based_churn_status",
    "rfm_cluster",
    "churn_probability",
    "churn_risk_band",
    "predicted_90d_value",
    "churn_score_method",
)
# ---------------------------------------------------------------------------

CLEAN_LINES = T.StructType(
    [
        T.StructField("invoice_no", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("invoice_date", T.TimestampNTZType()),
        T.StructField("unit_price", T.DecimalType(12, 3)),
        T.StructField("customer_id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("source_period", T.StringType()),
        T.StructField("revenue", T.DecimalType(14, 3)),
    ]
)
TRANSACTIONS = T.StructType([T.StructField("transaction_id", T.LongType()), *CLEAN_LINES.fields])

CUSTOMER_ANALYTICS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("rfm_cluster", T.IntegerType()),
        T.StructField("churn_probability", T.DecimalType(6, 4)),
        T.StructField("churn_risk_band", T.StringType()),
        T.StructField("predicted_90d_value", T.DecimalType(16, 2)),
        T.StructField("churn_score_method", T.StringType()),
    ]
)
MODEL_METRICS = T.StructType(
    [
        T.StructField("model_type", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("evaluation_split", T.StringType()),
        T.StructField("evaluation_snapshot", T.DateType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("selected_model", T.BooleanType()),
    ]
)

# Types of the export columns that only one of the two grains fills.
TRANSACTION_ONLY = {
    "transaction_id": "bigint",
    "invoice_no": "string",
    "invoice_date": "timestamp_ntz",
    "transaction_year": "int",
    "transaction_month": "date",
    "source_period": "string",
    "stock_code": "string",
    "description": "string",
    "quantity": "int",
    "unit_price": "decimal(12,3)",
    "revenue": "decimal(14,3)",
    "is_merchandise": "boolean",
}
CUSTOMER_ONLY = {
    "primary_country": "string",
    "first_purchase_date": "date",
    "last_purchase_date": "date",
    "recency_days": "int",
    "frequency": "bigint",
    "monetary": "decimal(22,2)",
    "average_order_value": "decimal(22,2)",
    "total_items": "bigint",
    "unique_products": "bigint",
    "active_months": "bigint",
    "tenure_days": "int",
    "avg_days_between_orders": "decimal(10,2)",
    "rfm_score": "int",
    "rfm_segment": "string",
    "rule_based_churn_status": "string",
    "rfm_cluster": "int",
    "churn_probability": "decimal(6,4)",
    "churn_risk_band": "string",
    "predicted_90d_value": "decimal(16,2)",
    "churn_score_method": "string",
}
