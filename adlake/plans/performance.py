"""The marketing performance model: governed names bound to the gold tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from adlake.functions.columns import DOLLARS, MULTIPLE, PERCENT, WHOLE
from adlake.plans.semantic import Dimension, Measure, Model

# --- fixed values: table, column and measure names, with display formats -----
FACT = "Marketing Performance"
FACT_COLUMNS = {
    "Region": "region",
    "Device Category": "device_category",
}
DATE_COLUMNS = {
    "Date": "date",
    "Year": "year",
    "Quarter": "quarter",
    "Month Number": "month_number",
    "Month Name": "month_name",
    "Week of Year": "week_of_year",
    "Day of Week": "day_of_week",
}
CALENDAR = ["Year", "Quarter", "Month Name", "Date"]
CHANNEL_COLUMNS = {"Platform": "source_system", "Channel": "channel"}
CAMPAIGN_COLUMNS = {"Campaign": "campaign_name", "Campaign Objective": "campaign_objective"}
PRODUCT_COLUMNS = {
    "Product": "product_name",
    "Brand": "brand",
    "Category": "category",
    "List Price": "list_price",
    "Rating": "rating",
    "Availability Status": "availability_status",
}
MEASURES = [
    Measure("Total Impressions", column="impressions", pattern=WHOLE),
    Measure("Total Clicks", column="clicks", pattern=WHOLE),
    Measure("Total Sessions", column="sessions", pattern=WHOLE),
    Measure("Total Spend", column="spend", pattern=DOLLARS),
    Measure("Total Revenue", column="revenue", pattern=DOLLARS),
    Measure("Total Conversions", column="conversions", pattern=WHOLE),
    Measure("Total Leads", column="leads", pattern=WHOLE),
    Measure("Video Views", column="video_views", pattern=WHOLE),
    Measure("Engagements", column="engagements", pattern=WHOLE),
    Measure("Click-Through Rate", ratio=("Total Clicks", "Total Impressions"), pattern=PERCENT),
    Measure("Conversion Rate", ratio=("Total Conversions", "Total Sessions"), pattern=PERCENT),
    Measure("Cost per Click", ratio=("Total Spend", "Total Clicks"), pattern=DOLLARS),
    Measure("Cost per Lead", ratio=("Total Spend", "Total Leads"), pattern=DOLLARS),
    Measure("Return on Ad Spend", ratio=("Total Revenue", "Total Spend"), pattern=MULTIPLE),
]


def performance_model(gold: Mapping[str, DataFrame]) -> Model:
    """Bind the model to gold tables: ``fact``, ``date``, ``channel``, ``campaign``, ``product``."""
    return Model(
        name=FACT,
        fact=gold["fact"],
        fact_columns=FACT_COLUMNS,
        dimensions={
            "Date": Dimension(
                "Date", gold["date"], "date_key", "date_key", DATE_COLUMNS,
                sort_by={"Month Name": "Month Number"}, monotone="Date", hierarchies={"Calendar": CALENDAR},
            ),
            "Channel": Dimension("Channel", gold["channel"], "channel_key", "channel_key", CHANNEL_COLUMNS),
            "Campaign": Dimension("Campaign", gold["campaign"], "campaign_key", "campaign_key", CAMPAIGN_COLUMNS),
            "Product": Dimension("Product", gold["product"], "product_key", "product_key", PRODUCT_COLUMNS),
        },
        measures={m.name: m for m in MEASURES},
    )
