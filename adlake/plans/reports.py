"""Ready report and question queries. Each is one call of the governed model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.plans.semantic import Model, share_of_total

CAMPAIGN = "Campaign.Campaign"
OBJECTIVE = "Campaign.Campaign Objective"
PLATFORM = "Channel.Platform"
CHANNEL = "Channel.Channel"
REGION = "Marketing Performance.Region"
BRAND = "Product.Brand"
DAY = "Date.Date"
YEAR = "Date.Year"
MONTH_NUMBER = "Date.Month Number"
MONTH = "Date.Month Name"
KPIS = [
    "Total Spend", "Total Revenue", "Return on Ad Spend", "Total Conversions",
    "Conversion Rate", "Total Sessions", "Total Impressions",
]
TREE_PATH = [CAMPAIGN, PLATFORM, REGION]


def top_campaigns(m: Model, n: int = 10) -> DataFrame:
    return m.query(
        [CAMPAIGN], ["Total Revenue", "Total Spend", "Return on Ad Spend"],
        top=(n, "Total Revenue"), order_by=[("Total Revenue", "desc")],
    )


def platform_efficiency(m: Model) -> DataFrame:
    return m.query(
        [PLATFORM], ["Total Spend", "Total Leads", "Cost per Lead", "Conversion Rate"],
        order_by=[("Total Spend", "desc")],
    )


def monthly_funnel(m: Model) -> DataFrame:
    return m.query(
        [YEAR, MONTH_NUMBER, MONTH],
        ["Total Impressions", "Total Clicks", "Click-Through Rate", "Cost per Click", "Total Revenue"],
        order_by=[(YEAR, "asc"), (MONTH_NUMBER, "asc")],
    )


def kpi_totals(m: Model) -> DataFrame:
    return m.query(measures=KPIS)


def daily_trend(m: Model) -> DataFrame:
    return m.query([DAY], ["Total Spend", "Total Revenue"], order_by=[(DAY, "asc")])


def platform_revenue(m: Model) -> DataFrame:
    return m.query([PLATFORM], ["Total Revenue"], order_by=[("Total Revenue", "desc")])


def campaign_scorecard(m: Model) -> DataFrame:
    return m.query(
        [CAMPAIGN, OBJECTIVE], ["Total Spend", "Total Revenue", "Return on Ad Spend", "Total Conversions"],
        order_by=[("Total Revenue", "desc")],
    )


def campaign_investment(m: Model) -> DataFrame:
    return m.query([CAMPAIGN], ["Total Spend", "Total Revenue"], order_by=[("Total Spend", "desc")])


def campaign_roas(m: Model) -> DataFrame:
    return m.query([CAMPAIGN], ["Return on Ad Spend"], order_by=[("Return on Ad Spend", "desc")])


def channel_detail(m: Model) -> DataFrame:
    return m.query(
        [PLATFORM, CHANNEL, CAMPAIGN],
        ["Total Impressions", "Click-Through Rate", "Total Leads", "Cost per Lead", "Return on Ad Spend"],
        order_by=[("Return on Ad Spend", "desc")],
    )


def ctr_month_campaign(m: Model) -> DataFrame:
    return m.query([MONTH, CAMPAIGN], ["Click-Through Rate"], order_by=[("Total Impressions", "desc")])


def month_combo(m: Model) -> DataFrame:
    return m.query([MONTH], ["Total Spend", "Total Revenue", "Return on Ad Spend"], order_by=[(MONTH, "asc")])


def region_platform(m: Model) -> DataFrame:
    return m.query([REGION, PLATFORM], ["Total Revenue"])


def brand_traffic(m: Model) -> DataFrame:
    return m.query([BRAND], ["Total Clicks", "Total Impressions", "Total Sessions"], order_by=[(BRAND, "asc")])


def brand_roas_share(m: Model) -> DataFrame:
    roas = m.query([BRAND], ["Return on Ad Spend"])
    return share_of_total(roas, "Return on Ad Spend").orderBy(F.desc_nulls_last("return_on_ad_spend"))


def brand_leads(m: Model) -> DataFrame:
    return m.query([BRAND], ["Total Leads"], order_by=[("Total Leads", "desc")])


def brand_lookup(m: Model) -> DataFrame:
    """Promoted products with their attributes and performance."""
    columns = ["Product.Brand", "Product.Category", "Product.Product", "Product.Availability Status"]
    return m.query(
        columns, ["Total Spend", "Total Revenue", "Return on Ad Spend"],
        order_by=[(BRAND, "asc"), ("Product.Product", "asc")],
    )


def decomposition_tree(m: Model) -> DataFrame:
    return m.decompose("Total Spend", TREE_PATH)


REPORTS = {
    "top_campaigns": top_campaigns,
    "platform_efficiency": platform_efficiency,
    "monthly_funnel": monthly_funnel,
    "kpi_totals": kpi_totals,
    "rpt_daily_trend": daily_trend,
    "rpt_platform_revenue": platform_revenue,
    "rpt_campaign_scorecard": campaign_scorecard,
    "rpt_campaign_investment": campaign_investment,
    "rpt_campaign_roas": campaign_roas,
    "rpt_channel_detail": channel_detail,
    "rpt_ctr_month_campaign": ctr_month_campaign,
    "rpt_month_combo": month_combo,
    "rpt_region_platform": region_platform,
    "rpt_brand_traffic": brand_traffic,
    "brand_roas_share": brand_roas_share,
    "rpt_brand_leads": brand_leads,
    "brand_lookup": brand_lookup,
    "decomposition_tree": decomposition_tree,
}
