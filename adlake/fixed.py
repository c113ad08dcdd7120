"""Names, labels and formats that results must carry exactly."""

from __future__ import annotations

# --- fixed values: canonical performance columns and their types ------------
CANONICAL_COLUMNS = {
    "event_date": "date",
    "source_system": "string",
    "channel": "string",
    "campaign_id": "bigint",
    "campaign_name": "string",
    "campaign_objective": "string",
    "product_id": "bigint",
    "product_name": "string",
    "brand": "string",
    "category": "string",
    "region": "string",
    "device_category": "string",
    "impressions": "bigint",
    "clicks": "bigint",
    "sessions": "bigint",
    "spend": "double",
    "conversions": "bigint",
    "leads": "bigint",
    "revenue": "double",
    "video_views": "bigint",
    "engagements": "bigint",
    "ingestion_utc": "timestamp_ntz",
    "batch_id": "string",
}

# --- fixed values: grain, statuses, retired and declared names --------------
GRAIN = ["event_date", "source_system", "campaign_id", "product_id", "region"]
VALID = "Valid"
NOT_SOURCED = "Not sourced"
MONEY = ["spend", "revenue"]
ADDITIVE = ["impressions", "clicks", "sessions", "spend", "conversions", "leads", "revenue"]
SILVER_SCHEMAS = ["conformed", "audit"]
GOLD_SCHEMAS = ["dimensions", "facts", "data_products"]
RETIRED_BRONZE = [
    "src_google_analytics_raw",
    "src_product_catalog_raw",
    "digital_marketing_signals_raw",
    "api_products_raw",
]
RETIRED_SILVER = ["conformed.marketing_performance_enriched", "reference.product_catalog"]
ATTRIBUTE_SUFFIXES = ("model", "make", "brand", "manufacturer", "category", "class", "segment")
MAX_FEED_WIDTH = 17

# --- fixed values: catalog record fields, types and load labels -------------
CATALOG_TYPES = {
    "id": "bigint",
    "title": "string",
    "description": "string",
    "category": "string",
    "brand": "string",
    "price": "decimal(19,4)",
    "discountPercentage": "double",
    "rating": "double",
    "stock": "bigint",
    "sku": "string",
    "availabilityStatus": "string",
}
CATALOG_SOURCE = "DummyJSON Products API"
CATALOG_TABLE = "src_api_product_df"
BATCH_STAMP_FORMAT = "yyyyMMddHHmmss"

# --- fixed values: scoring signature (name, type), in order -----------------
SCORING_SIGNATURE = [
    ("event_date", "date"),
    ("ingestion_utc", "timestamp_ntz"),
    ("campaign_id", "double"),
    ("product_id", "double"),
    ("impressions", "double"),
    ("clicks", "double"),
    ("sessions", "double"),
    ("video_views", "double"),
    ("engagements", "double"),
    ("conversions", "double"),
    ("leads", "double"),
    ("revenue", "double"),
    ("source_system", "string"),
    ("channel", "string"),
    ("campaign_name", "string"),
    ("campaign_objective", "string"),
    ("product_name", "string"),
    ("brand", "string"),
    ("category", "string"),
    ("region", "string"),
    ("device_category", "string"),
    ("batch_id", "string"),
    ("quality_status", "string"),
]
PREDICTION = "predicted_spend"
TRAINING_SEED = 41
