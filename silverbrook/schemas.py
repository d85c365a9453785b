"""Explicit schemas of every stored table."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def struct(text: str) -> T.StructType:
    """``"a string, b int"`` as a StructType, without needing a session."""
    fields = (part.split() for part in text.replace("\n", " ").split(",") if part.strip())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


EVENT_MESSAGE = struct(
    "event_id string, session_id string, user_id string, event_type string, "
    "timestamp string, device string, properties string"
)
EVENT_PROPERTIES = struct(
    "product_id string, category string, price double, state string, "
    "query string, city string, reason string"
)
CHANGE_ROW = struct(
    "order_id string, session_id string, customer_id string, product_id string, "
    "seller_id string, category string, price string, freight_value string, "
    "purchase_timestamp bigint, state string"
)

BRONZE = {
    "clickstream": struct(
        "event_id string, session_id string, user_id string, event_type string, timestamp string, "
        "device string, properties string, ingested_at string, source string"
    ),
    "orders": struct(
        "order_id string, session_id string, customer_id string, product_id string, "
        "seller_id string, category string, price string, freight_value string, "
        "purchase_timestamp bigint, state string, cdc_operation string, cdc_ts_ms bigint, "
        "ingested_at string, source string"
    ),
    "reviews": struct(
        "file_path string, review_id string, order_id string, customer_id string, rating string, "
        "title string, raw_content string, ingested_at string, source string"
    ),
}

SILVER = {
    "clickstream": struct(
        "event_id string, session_id string, user_id string, event_type string, "
        "event_ts timestamp, device string, category string, product_id string, price double, "
        "location string, ingested_at timestamp"
    ),
    "orders": struct(
        "order_id string, session_id string, customer_id string, product_id string, "
        "seller_id string, category string, price double, freight_value double, "
        "total_value double, purchase_ts timestamp, state string, region string, "
        "ingested_at timestamp"
    ),
    "reviews": struct(
        "review_id string, order_id string, customer_id string, rating int, title string, "
        "message string, text_length int, ingested_at timestamp"
    ),
}

# Silver tables as streams store them: with the columns that say which of two rows is newer.
VERSIONED = {
    "orders": T.StructType([*SILVER["orders"].fields, T.StructField("cdc_ts_ms", T.LongType())]),
    "reviews": SILVER["reviews"],
}

GOLD = {
    "dim_date": struct(
        "date_id int, date_actual date, year int, quarter int, month int, week int, "
        "day_of_week int, day_name string, month_name string, is_weekend boolean"
    ),
    "dim_category": struct("category_en string, category_id bigint"),
    "dim_geography": struct("state string, state_name string, region string, geo_id bigint"),
    "fact_sales": struct(
        "order_id string, session_id string, customer_id string, product_id string, "
        "seller_id string, date_id int, category_id bigint, geo_id bigint, price double, "
        "freight_value double, total_value double, purchase_ts timestamp, purchase_date date"
    ),
    "fact_clickstream": struct(
        "event_id string, session_id string, user_id string, event_type string, "
        "event_ts timestamp, event_date date, device string, date_id int, category_id bigint, "
        "product_id string, price double, location string"
    ),
    "fact_reviews": struct(
        "review_id string, order_id string, customer_id string, rating int, sentiment string, "
        "title string, message string, text_length int, date_id int, review_date date"
    ),
    "ml_churn_scores": struct(
        "customer_id string, churn_probability double, risk_label string, recency int, "
        "frequency bigint, monetary double, model_f1 double, model_auc double, "
        "scored_at timestamp"
    ),
    "ml_demand_forecast": struct(
        "category_id bigint, category_en string, forecast_date date, predicted_orders double, "
        "model_rmse double, model_mae double, scored_at timestamp"
    ),
}

AUDIT = struct(
    "run_id string, step string, status string, records bigint, seconds double, "
    "finished_at timestamp"
)
