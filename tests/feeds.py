"""Literal feeds for unit tests, written down in SQL: three platforms of 720 rows each, without a clock or chance.

Row n of a platform is of day n div 4 and of the campaign n mod 4; everything else follows from n by
small remainders, chosen so that every product, region and device occurs.
"""

GOOGLE = """
select {day} as gads_date, {campaign} as gads_campaign_id, {name} as gads_campaign_name, {goal} as gads_objective,
  {product} as gads_product_id, {model} as gads_vehicle_model, {brand} as gads_vehicle_brand, {body} as gads_vehicle_category,
  {region} as gads_region, {device} as gads_device, {seen} as gads_impressions, {clicks} as gads_clicks, {spend} as gads_spend,
  {clicks} div 16 as gads_conversions, {revenue} as gads_revenue, {loaded} as gads_ingested_utc, 'b1' as gads_batch_id
from range(720)"""
META = """
select {day} as meta_date, {campaign} as meta_campaign_id, {name} as meta_campaign_name, {product} as meta_product_id,
  {model} as meta_auto_model, {brand} as meta_auto_make, {body} as meta_vehicle_class, {region} as meta_region,
  {seen} as meta_impressions, {clicks} as meta_clicks, {spend} as meta_spend, {clicks} div 8 as meta_leads,
  {seen} div 3 as meta_video_views, {seen} div 11 as meta_engagements, {revenue} as meta_revenue,
  {loaded} as meta_ingested_utc, 'b1' as meta_batch_id
from range(720)"""
LINKEDIN = """
select {day} as li_date, {campaign} as li_campaign_id, {name} as li_campaign_name, {goal} as li_objective,
  {product} as li_product_id, {model} as li_promoted_model, {brand} as li_manufacturer, {body} as li_segment, {region} as li_region,
  {seen} as li_impressions, {clicks} as li_clicks, {spend} as li_spend, {clicks} div 9 as li_leads,
  {clicks} div 25 as li_conversions, {revenue} as li_revenue, {loaded} as li_ingested_utc, 'b1' as li_batch_id
from range(720)"""
COLUMNS = {
    "day": "date_add(date '2024-01-01', cast(id div 4 as int))",
    "campaign": "101 + id % 4",
    "name": "concat('Campaign ', id % 4)",
    "goal": "element_at(array('reach', 'trial', 'sales', 'loyalty'), cast(id % 4 + 1 as int))",
    # 30 products; the remainders by 6 and by 5 name each one's brand and body once
    "product": "id % 30 + 1",
    "model": "concat('Model ', id % 30 + 1)",
    "brand": "concat('Make ', id % 6)",
    "body": "concat('Body ', id % 5)",
    "region": "element_at(array('north', 'south', 'west'), cast(id % 7 % 3 + 1 as int))",
    "device": "element_at(array('phone', 'laptop', 'tv'), cast(id % 11 % 3 + 1 as int))",
    "clicks": "(40 + id * 17 % 260)",
    "seen": "(9000 + id * 13)",
    "spend": "cast(id % 97 + 0.125 as double)",
    "revenue": "cast(id % 89 * 4 + 0.375 as double)",
    "loaded": "timestamp_ntz '2024-07-01 00:00:00'",
}


def literal_feeds(spark):
    texts = {"src_google_ads_raw": GOOGLE, "src_meta_ads_raw": META, "src_linkedin_ads_raw": LINKEDIN}
    return {name: spark.sql(text.format(**COLUMNS)) for name, text in texts.items()}
