"""SQL twins of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

# Chain of views from the input tables to silver and gold.
CHAIN = """
base0 as (
  select
    case when l_quantity = 50 and l_linenumber = 1 then null else cast(l_shipdate as date) end as event_date,
    case l_returnflag when 'A' then 'Google Ads' when 'N' then 'Meta Ads' else 'LinkedIn Ads' end as source_system,
    case l_returnflag when 'A' then 'Paid Search' when 'N' then 'Paid Social' else 'Paid Social B2B' end as channel,
    cast(substr(o_orderpriority, 1, 1) as bigint) + 100 as campaign_id,
    substr(o_orderpriority, 3) as campaign_name,
    case when l_returnflag = 'N' then 'Social Engagement' else c_mktsegment end as campaign_objective,
    l_partkey as product_id, p_name as product_name, p_brand as brand, p_type as category, r_name as region,
    case when l_returnflag = 'A' then case when l_linestatus = 'F' then 'Desktop' else 'Mobile' end end as device_category,
    case when l_linenumber = 7 then cast(0 as bigint) else cast(l_quantity * 100 as bigint) end as impressions,
    cast(l_quantity as bigint) * cast(floor(l_discount * 100 + 0.5) as bigint) as clicks,
    cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(18,2)) as spend_raw,
    (case when l_quantity = 1 then -1 else 1 end)
      * cast(l_extendedprice as decimal(18,2)) * cast(1 + l_tax as decimal(4,2)) as revenue_raw
  from lineitem
  join orders on l_orderkey = o_orderkey
  join part on l_partkey = p_partkey
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey
),
canon0 as (
  select b.*, clicks as sessions,
    cast(floor(clicks / case source_system when 'Google Ads' then 10 when 'Meta Ads' then 5 else 20 end) as bigint) as conversions,
    cast(floor(clicks / case source_system when 'Google Ads' then 10 when 'Meta Ads' then 5 else 5 end) as bigint) as leads,
    case when source_system = 'Meta Ads' then cast(floor(impressions / 4) as bigint) end as video_views,
    case when source_system = 'Meta Ads' then cast(floor(impressions / 40) as bigint) end as engagements,
    timestamp '2024-01-01 00:00:00' as ingestion_utc, 'fixture' as batch_id
  from base0 b
),
placed as (
  select c.*, row_number() over (
    partition by event_date, source_system, campaign_id, product_id, region
    order by campaign_objective nulls first, device_category nulls first, impressions nulls first,
      clicks nulls first, spend_raw nulls first, revenue_raw nulls first
  ) as place
  from canon0 c
),
deduped as (select * exclude (place) from placed where place = 1),
silver as (
  select * exclude (spend_raw, revenue_raw),
    cast(round_even(spend_raw, 2) as decimal(18,2)) as spend,
    cast(round_even(revenue_raw, 2) as decimal(18,2)) as revenue,
    'Valid' as quality_status
  from deduped
  where event_date is not null and campaign_id is not null
    and coalesce(spend_raw, 0) >= 0 and coalesce(revenue_raw, 0) >= 0
    and (clicks is null or impressions is null or clicks <= impressions)
),
dim_date as (
  select event_date as date, cast(strftime(event_date, '%Y%m%d') as integer) as date_key,
    cast(year(event_date) as integer) as year, 'Q' || quarter(event_date) as quarter,
    cast(month(event_date) as integer) as month_number, strftime(event_date, '%B') as month_name,
    cast(week(event_date) as integer) as week_of_year, strftime(event_date, '%A') as day_of_week
  from (select distinct event_date from silver)
),
dim_channel as (
  select *, cast(row_number() over (order by channel, source_system) as integer) as channel_key
  from (select distinct channel, source_system from silver)
),
dim_campaign as (
  select *, cast(row_number() over (order by campaign_id, campaign_name, campaign_objective) as integer) as campaign_key
  from (select distinct campaign_id, campaign_name, campaign_objective from silver)
),
dim_product as (
  select distinct product_id as product_key, product_name, brand, category,
    cast(null as double) as list_price, cast(null as double) as rating, 'Not sourced' as availability_status
  from silver
),
fact as (
  select cast(strftime(event_date, '%Y%m%d') as integer) as date_key, channel_key, campaign_key,
    product_id as product_key, region, device_category, impressions, clicks, sessions, spend,
    conversions, leads, revenue, video_views, engagements,
    case when impressions > 0 then
      cast((2000000 * clicks + impressions) // (2 * impressions) as double) / 1000000 end as click_through_rate,
    case when clicks > 0 then
      cast((20000 * cast(spend * 100 as hugeint) + clicks) // (2 * clicks) as double) / 1000000 end as cost_per_click,
    case when spend > 0 then cast((2000000 * cast(revenue * 100 as hugeint) + cast(spend * 100 as hugeint))
      // (2 * cast(spend * 100 as hugeint)) as double) / 1000000 end as return_on_ad_spend,
    batch_id, ingestion_utc
  from silver join dim_channel using (channel, source_system)
  join dim_campaign using (campaign_id, campaign_name, campaign_objective)
),
gold as (
  select f.*, d.date, d.year, d.quarter, d.month_number, d.month_name,
    ch.source_system as platform, ch.channel, ca.campaign_name as campaign, ca.campaign_objective,
    p.product_name as product, p.brand, p.category, p.availability_status
  from fact f left join dim_date d using (date_key) left join dim_channel ch using (channel_key)
  left join dim_campaign ca using (campaign_key) left join dim_product p using (product_key)
)
"""


def chained(sql: str, extra: str = "") -> str:
    return f"with {CHAIN}{extra}\n{sql}"


def total(column: str) -> str:
    return f"cast(sum({column}) as {'double' if column in ('spend', 'revenue') else 'bigint'})"


def share(top: str, bottom: str) -> str:
    return f"cast(sum({top}) as double) / nullif(cast(sum({bottom}) as double), 0)"


MEASURES = {
    "total_impressions": total("impressions"),
    "total_clicks": total("clicks"),
    "total_sessions": total("sessions"),
    "total_spend": total("spend"),
    "total_revenue": total("revenue"),
    "total_conversions": total("conversions"),
    "total_leads": total("leads"),
    "video_views": total("video_views"),
    "engagements": total("engagements"),
    "click_through_rate": share("clicks", "impressions"),
    "conversion_rate": share("conversions", "sessions"),
    "cost_per_click": share("spend", "clicks"),
    "cost_per_lead": share("spend", "leads"),
    "return_on_ad_spend": share("revenue", "spend"),
}


def measured(groups: str, names: str, rest: str = "", source: str = "gold", where: str = "") -> str:
    """A measure query: group columns, measure names, then HAVING and the like."""
    shown = ", ".join(f"{MEASURES[n]} as {n}" for n in names.split())
    keys = f"{groups}, " if groups else ""
    group = f" group by {groups}" if groups else ""
    return f"select {keys}{shown} from {source} {where}{group} {rest}"


def cents(amount: str) -> str:
    return f"cast({amount} * 100 as hugeint)"


def half_up(top: str, bottom: str) -> str:
    """Positive ratio of two whole numbers, rounded half up to six digits without a float error."""
    return f"case when {bottom} > 0 then cast((2000000 * {top} + {bottom}) // (2 * {bottom}) as double) / 1000000 end"


def two_steps(top: str, bottom: str) -> str:
    """As half_up, after a first rounding to ten digits: the scale at which sums of money divide."""
    ten = f"(20000000000 * {top} + {bottom}) // (2 * {bottom})"
    return f"case when {bottom} > 0 then cast(({ten} + 5000) // 10000 as double) / 1000000 end"


GRAIN = "event_date, source_system, campaign_id, product_id, region"
CANON = """event_date, source_system, channel, campaign_id, campaign_name, campaign_objective, product_id,
  product_name, brand, category, region, device_category, impressions, clicks, sessions,
  cast(spend_raw as double) as spend, conversions, leads, cast(revenue_raw as double) as revenue,
  video_views, engagements, ingestion_utc, batch_id"""
FACT = """date_key, channel_key, campaign_key, product_key, region, device_category, impressions, clicks,
  sessions, cast(spend as double) as spend, conversions, leads, cast(revenue as double) as revenue,
  video_views, engagements, click_through_rate, cost_per_click, return_on_ad_spend, batch_id, ingestion_utc"""
INVALID = {
    "missing event_date": "event_date is null",
    "missing campaign_id": "campaign_id is null",
    "negative spend": "coalesce(spend_raw, 0) < 0",
    "negative revenue": "coalesce(revenue_raw, 0) < 0",
    "clicks above impressions": "coalesce(clicks > impressions, false)",
}
REASONS = "concat_ws('; ', " + ", ".join(f"case when {c} then '{r}' end" for r, c in INVALID.items()) + ")"
# The what-if row: date, channel, campaign and product key, spend, revenue, impressions, clicks, conversions.
MOVED = (
    "moved as (select date_key, channel_key, campaign_key, product_key from fact union all select 20991231, 1, 1, 1), "
    "moved_gold as (select year, platform, spend, revenue, clicks, impressions, conversions from gold union all "
    "select null, (select source_system from dim_channel where channel_key = 1), 2011.0, 4022.0, 50, 1000, 1)"
)
NUMERIC = "impressions clicks sessions spend conversions leads revenue video_views engagements".split()
# Clicks are null and sessions not a number there, which is the same to the operators.
HOLES = {"clicks": "case when impressions <> 300 then clicks end", "sessions": "case when impressions <> 500 then sessions end"}
GAPPED = (
    ", gapped as (select " + GRAIN + ", "
    + ", ".join(
        f"cast({HOLES.get(c, c)} as double) as {c}"
        for c in NUMERIC
    )
    + " from silver)"
)
RECORDS = """(select cast(event_id as varchar) as id, event_type as title,
  case when event_type = 'error' then 'n/a' else regexp_extract(props, '"k": *"?([^",}]*)', 1) end as price,
  cast(user_id as varchar) as stock from events)"""
PERFORMANCE_KEY = "date_key channel_key campaign_key product_key region device_category".split()
KEY_TEXT = "concat_ws(chr(31), " + ", ".join(f"coalesce(cast({k} as varchar), '∅')" for k in PERFORMANCE_KEY) + ")"


def strategy(column: str) -> str:
    return f"case when skewness({column}) <= 1 then 'mean' when skewness({column}) > 1 then 'median' else 'most_frequent' end"


def per_column(select: str, extra: str = GAPPED) -> str:
    return chained(" union all ".join(select.format(c=c) for c in NUMERIC), extra)


def conformed(system: str) -> str:
    return chained(f"select {CANON} from canon0 where source_system = '{system}'")


def edge(target: str, dim: str) -> str:
    parts = ", ".join(f"f.{k} as source_{k}" for k in PERFORMANCE_KEY)
    return chained(
        f"select {parts}, f.{target} as target_key from fact f where exists "
        f"(select 1 from {dim} d where d.{target} = f.{target})"
    )


def orphans(label: str, dim: str, key: str, columns: str) -> str:
    keys, rows = columns.split()
    name = f"'{label}'"
    first = "dimension" if keys == "orphan_keys" else "relationship"
    return (
        f"select {name} as {first}, count(distinct f.{key}) as {keys}, count(*) as {rows} "
        f"from moved f where not exists (select 1 from {dim} d where d.{key} = f.{key})"
    )


GRAIN_TEXT = "concat_ws(chr(31), " + ", ".join(f"coalesce(cast({k} as varchar), '∅')" for k in GRAIN.split(", ")) + "{seed})"
SPLIT = (
    "select case when share < 8000 then 'train' else 'test' end as split, cast(spend as double) as spend, clicks from (select *, "
    f"cast('0x' || substr(md5({GRAIN_TEXT.format(seed=", '41'")}), 1, 8) as bigint) % 10000 as share from silver)"
)
DIMS = [
    ("Date", "dim_date", "date_key"),
    ("Channel", "dim_channel", "channel_key"),
    ("Campaign", "dim_campaign", "campaign_key"),
    ("Product", "dim_product", "product_key"),
]


def tree(level: int, within: str) -> str:
    """Bars of one level, with rank and share of the parent."""
    names = ["campaign", "platform", "region"]
    parents = ", ".join(names[: level - 1])
    over = f"partition by {parents}" if parents else ""
    shown = ", ".join(n if i < level else f"cast(null as varchar) as {n}" for i, n in enumerate(names))
    return (
        f"select {level} as level, {shown}, place, value, share from (select {', '.join(names[:level])}, "
        f"rank() over ({over} order by sum(spend) desc) as place, cast(sum(spend) as double) as value, "
        f"cast(sum(spend) as double) / nullif(cast(sum(sum(spend)) over ({over}) as double), 0) as share "
        f"from gold {within} group by {', '.join(names[:level])}) where place <= 3"
    )


ORACLES = {
    "scan_feed": chained(
        "select event_date as gads_date, campaign_id as gads_campaign_id, product_id as gads_product_id, "
        "clicks as gads_clicks, cast(spend_raw as double) as gads_spend from canon0 where source_system = 'Google Ads'"
    ),
    "json_records": """select event_id, cast(regexp_extract(props, '"k": *([0-9-]+)', 1) as bigint) as k from events""",
    "typed_catalog": f"""select try_cast(id as bigint) as id, title, cast(null as varchar) as description,
        cast(null as varchar) as category, cast(null as varchar) as brand,
        cast(try_cast(price as decimal(19,4)) as double) as price, cast(null as double) as "discountPercentage",
        cast(null as double) as rating, try_cast(stock as bigint) as stock, cast(null as varchar) as sku,
        cast(null as varchar) as "availabilityStatus" from {RECORDS}""",
    "typed_rejects": f"""select id, price, 'price' as bad_columns from {RECORDS}
        where price is not null and try_cast(price as decimal(19,4)) is null""",
    "select_or_null": "select event_id, event_type, cast(null as varchar) as session_id, cast(null as double) as score from events",
    "batch_stamp": "select o_orderkey, o_custkey, timestamp '2024-09-01 12:30:05' as ingestion_utc, '20240901123005' as batch_id from orders",
    "append_aligned": chained(
        f"select {FACT} from fact union all select 20991231, 1, 1, 1, null, null, 1000, 50, null, 2011.0, 1, null, "
        "4022.0, null, null, null, null, 2.0, 'manual', null"
    ),
    "zorder_layout": chained(f"select {FACT} from fact"),
    "table_roundtrip": """select o_orderpriority, count(*) as rows, count(priced) as priced from (
        select o_orderpriority, o_totalprice as priced from orders union all select null, null from lineitem) group by 1""",
    "catalog_ingest": """select conv_id * 1000 + turn as id, role as title, text as description, cast(null as varchar) as category,
        cast(null as varchar) as brand, case when turn <> 3 then cast(length(text) as double) end as price,
        cast(null as double) as "discountPercentage", cast(null as double) as rating, turn as stock, cast(null as varchar) as sku,
        cast(null as varchar) as "availabilityStatus", 'DummyJSON Products API' as source_system,
        timestamp '2024-09-01 12:30:05' as ingestion_utc, '20240901123005' as batch_id from conversations""",
    "load_summary": chained(
        " union all ".join(
            f"select '{t}' as bronze_table, count(*) as row_count, {w} as column_count, '{p}' as source_prefix "
            f"from canon0 where source_system = '{s}'"
            for t, s, p, w in [
                ("src_google_ads_raw", "Google Ads", "gads_", 17),
                ("src_meta_ads_raw", "Meta Ads", "meta_", 17),
                ("src_linkedin_ads_raw", "LinkedIn Ads", "li_", 17),
            ]
        )
    ),
    "conform_google": conformed("Google Ads"),
    "conform_meta": conformed("Meta Ads"),
    "conform_linkedin": conformed("LinkedIn Ads"),
    "union_feeds": chained(f"select {CANON} from canon0"),
    "dedupe_grain": chained(f"select {CANON} from deduped"),
    "valid_rows": chained(f"select {CANON} from canon0 where not ({' or '.join(INVALID.values())})"),
    "rejected_rows": chained(
        f"select {CANON}, {REASONS} as reasons from deduped where {' or '.join(INVALID.values())}"
    ),
    "rejected_table": chained(
        f"select {CANON}, {REASONS} as reasons from deduped where {' or '.join(INVALID.values())}"
    ),
    "money_round": chained(
        f"select {GRAIN}, impressions, cast(round_even(spend_raw, 2) as double) as spend, "
        "cast(round_even(revenue_raw, 2) as double) as revenue from canon0"
    ),
    "silver_table": chained(
        "select * replace (cast(spend as double) as spend, cast(revenue as double) as revenue) from silver"
    ),
    "silver_summary": chained(
        f"select source_system, channel, count(*) as rows, {total('spend')} as spend, {total('revenue')} as revenue, "
        f"{total('conversions')} as conversions from silver group by 1, 2"
    ),
    "audit_source_counts": chained("select source_system, count(*) as count from silver group by 1"),
    "dim_date": chained("select * from dim_date"),
    "dim_channel": chained("select * from dim_channel"),
    "dim_campaign": chained("select * from dim_campaign"),
    "dim_product": chained("select * from dim_product"),
    "surrogate_key_large": "select o_custkey, o_orderkey, cast(row_number() over (order by o_custkey, o_orderkey) as integer) "
    "as order_key from (select distinct o_custkey, o_orderkey from orders)",
    "fact_build": chained(f"select {FACT} from fact"),
    "fact_null_keys": chained(
        "select s.null_safe, campaign_key, campaign_id, campaign_name, campaign_objective, rows from keyed, (values (false), (true)) s(null_safe) "
        "where s.null_safe or (campaign_id is not null and campaign_name is not null and campaign_objective is not null)",
        ", gaps as (select campaign_id, case when sessions % 11 <> 0 then campaign_name end as campaign_name, "
        "case when clicks % 7 <> 0 then campaign_objective end as campaign_objective from silver), "
        "keyed as (select *, cast(row_number() over (order by campaign_id nulls first, campaign_name nulls first, campaign_objective nulls first) "
        "as integer) as campaign_key from (select campaign_id, campaign_name, campaign_objective, count(*) as rows from gaps group by all))",
    ),
    "fact_ratios": chained(
        f"select {GRAIN}, {half_up('clicks', 'impressions')} as click_through_rate, "
        f"{half_up(cents('spend'), '(100 * clicks)')} as cost_per_click, "
        f"{half_up(cents('revenue'), cents('spend'))} as return_on_ad_spend from silver"
    ),
    "campaign_daily": chained(
        "select date_key, campaign_key, campaign_name, campaign_objective, channel_key, channel, source_system, "
        + ", ".join(f"{total('f.' + c) if c not in ('spend', 'revenue') else f'cast(sum(f.{c}) as double)'} as {c}"
                    for c in NUMERIC[:7])
        + f", {two_steps(cents('sum(f.revenue)'), cents('sum(f.spend)'))} as roas "
        "from fact f join dim_campaign using (campaign_key) join dim_channel using (channel_key) "
        "group by date_key, campaign_key, campaign_name, campaign_objective, channel_key, channel, source_system"
    ),
    "campaign_daily_sorted": chained(
        "select date_key, campaign_name, source_system, campaign_objective, cast(sum(spend) as double) as spend, "
        "cast(sum(revenue) as double) as revenue from fact join dim_campaign using (campaign_key) "
        "join dim_channel using (channel_key) group by date_key, campaign_key, channel_key, 2, 3, 4 "
        "order by date_key desc, campaign_name, source_system, campaign_objective"
    ),
    "fact_latest_100": chained(
        f"select {FACT} from (select * from fact order by date_key desc, channel_key, campaign_key, product_key, region limit 100)"
    ),
    "fk_orphans": chained(
        " union all ".join(orphans(n.lower(), d, k, "orphan_keys orphan_rows") for n, d, k in DIMS), ", " + MOVED
    ),
    "dq_duplicate_keys": chained(f"select {GRAIN}, count(*) as rows from canon0 group by {GRAIN} having count(*) > 1"),
    "dq_distinct_counts": chained(
        "select " + ", ".join(f"count(distinct {c}) as distinct_{c}" for c in ("brand", "category", "source_system", "product_id"))
        + " from silver"
    ),
    "distinct_products": chained(
        "select cast(year(event_date) as integer) as year, cast(month(event_date) as integer) as month, count(distinct product_id) as products "
        "from silver group by grouping sets ((1, 2), (1), ())"
    ),
    "dq_complete_attrs": chained(
        "select " + ", ".join(
            f"count(*) - count({c}) as null_{c}" for c in ("product_name", "brand", "category", "device_category", "video_views")
        )
        + ", count(*) filter (where product_name is null or brand is null or category is null or device_category is null "
        "or video_views is null) as incomplete_rows from silver"
    ),
    "dq_report": chained(
        "select check_name, cast(expected as bigint) as expected, cast(actual as bigint) as actual, "
        "expected is null or expected = actual as passed from ("
        + " union all ".join(
            f"select '{name}' as check_name, {expected} as expected, {actual} as actual from {table}"
            for name, table, actual, expected in [
                ("silver rows", "silver", "count(*)", "(select count(*) from silver)"),
                ("silver sources", "silver", "count(distinct source_system)", 3),
                ("silver categories", "silver", "count(distinct category)", 6),
                ("silver rows without attributes", "silver",
                 "count(*) filter (where product_name is null or brand is null or category is null)", 0),
                ("silver rows not valid", "silver", "count(*) filter (where quality_status <> 'Valid')", 0),
                ("fact rows", "fact", "count(*)", "(select count(*) from silver)"),
                ("campaign rows per key", "dim_campaign", "count(*) - count(distinct campaign_key)", 0),
                ("product rows per key", "dim_product", "count(*) - count(distinct product_key)", 0),
                ("channel rows", "dim_channel", "count(*)", 3),
                ("channel rows per key", "dim_channel", "count(*) - count(distinct channel_key)", 0),
                ("date rows per key", "dim_date", "count(*) - count(distinct date_key)", 0),
                ("daily sources", "gold", "count(distinct platform)", 3),
            ]
        )
        + ")"
    ),
    "feed_contract": chained(
        " union all ".join(
            f"select '{t}' as feed, count(*) filter (where product_name is not null and brand is not null "
            f"and category is not null) as complete_rows, 3 as attribute_columns, 0 as breaches "
            f"from canon0 where source_system = '{s}'"
            for t, s in [
                ("src_google_ads_raw", "Google Ads"),
                ("src_meta_ads_raw", "Meta Ads"),
                ("src_linkedin_ads_raw", "LinkedIn Ads"),
            ]
        )
    ),
    "measure_query": chained(measured("year, platform, region", " ".join(MEASURES))),
    "sliced_query": chained(
        measured(
            "campaign, brand", "total_spend total_clicks click_through_rate",
            where="where platform in ('Google Ads', 'Meta Ads') and date between date '1996-01-01' and date '1997-12-31' "
            "and brand in ('Brand#1', 'Brand#2', 'Brand#3') and region in ('ASIA', 'EUROPE')",
        )
    ),
    "having_query": chained(
        measured(
            "platform, campaign, campaign_objective", "total_impressions total_leads cost_per_lead",
            rest=f"having sum(leads) > 100 and {share('revenue', 'spend')} >= 21",
            where="where platform in ('Google Ads', 'LinkedIn Ads')",
        )
    ),
    "slicer_members": chained("select distinct month_name from dim_date"),
    "blank_member": chained(
        measured("year", "total_spend total_clicks return_on_ad_spend", source="moved_gold"), ", " + MOVED
    ),
    "blank_selected": chained(
        measured("platform", "total_spend", where="where year = 1995 or year is null", source="moved_gold"), ", " + MOVED
    ),
    "movement_insert": chained(
        measured("year", "total_spend total_revenue total_impressions total_conversions", source="moved_gold"), ", " + MOVED
    ),
    "load_job": chained(
        " union all ".join(
            f"select '{name}' as table_name, count(*) as rows from {table}"
            for name, table in [
                ("src_google_ads_raw", "canon0 where source_system = 'Google Ads'"),
                ("src_meta_ads_raw", "canon0 where source_system = 'Meta Ads'"),
                ("src_linkedin_ads_raw", "canon0 where source_system = 'LinkedIn Ads'"),
                ("silver", "silver"), ("rejected", f"deduped where {' or '.join(INVALID.values())}"), ("date", "dim_date"), ("channel", "dim_channel"), ("campaign", "dim_campaign"),
                ("product", "dim_product"), ("fact", "fact"),
                ("daily", "(select distinct date_key, campaign_key, channel_key from fact)"),
            ]
        )
        + " union all select 'audit ' || source_system, count(*) from silver group by 1"
    ),
    "calendar_rollup": chained(
        f"select year, quarter, month_name, date, grouping(year, quarter, month_name, date) as grouping_id, "
        f"{MEASURES['total_spend']} as total_spend, {MEASURES['total_clicks']} as total_clicks, "
        f"{MEASURES['click_through_rate']} as click_through_rate from gold group by rollup (year, quarter, month_name, date)"
    ),
    "top_campaigns": chained(
        f"select campaign, total_revenue, total_spend, return_on_ad_spend from (select *, rank() over (order by total_revenue desc) "
        f"as place from ({measured('campaign', 'total_revenue total_spend return_on_ad_spend')})) where place <= 10"
    ),
    "platform_efficiency": chained(measured("platform", "total_spend total_leads cost_per_lead conversion_rate")),
    "monthly_funnel": chained(
        measured(
            "year, month_number, month_name",
            "total_impressions total_clicks click_through_rate cost_per_click total_revenue",
        )
    ),
    "kpi_totals": chained(
        measured(
            "", "total_spend total_revenue return_on_ad_spend total_conversions conversion_rate total_sessions total_impressions"
        )
    ),
    "rpt_daily_trend": chained(measured("date", "total_spend total_revenue")),
    "rpt_platform_revenue": chained(measured("platform", "total_revenue")),
    "rpt_campaign_scorecard": chained(
        measured("campaign, campaign_objective", "total_spend total_revenue return_on_ad_spend total_conversions")
    ),
    "rpt_campaign_investment": chained(measured("campaign", "total_spend total_revenue")),
    "rpt_campaign_roas": chained(measured("campaign", "return_on_ad_spend")),
    "rpt_channel_detail": chained(
        measured(
            "platform, channel, campaign",
            "total_impressions click_through_rate total_leads cost_per_lead return_on_ad_spend",
        )
    ),
    "rpt_ctr_month_campaign": chained(measured("month_name, campaign", "click_through_rate")),
    "rpt_month_combo": chained(measured("month_name", "total_spend total_revenue return_on_ad_spend")),
    "rpt_region_platform": chained(measured("region, platform", "total_revenue")),
    "rpt_brand_traffic": chained(measured("brand", "total_clicks total_impressions total_sessions")),
    "brand_roas_share": chained(
        f"select brand, return_on_ad_spend, round(return_on_ad_spend / sum(return_on_ad_spend) over (), 9) as share "
        f"from ({measured('brand', 'return_on_ad_spend')})"
    ),
    "rpt_brand_leads": chained(measured("brand", "total_leads")),
    "brand_lookup": chained(
        measured("brand, category, product, availability_status", "total_spend total_revenue return_on_ad_spend")
    ),
    "decomposition_tree": chained(
        tree(1, "")
        + " union all " + tree(2, "where campaign in (select campaign from l1)")
        + " union all " + tree(3, "where (campaign, platform) in (select (campaign, platform) from l2)"),
        f", l1 as ({tree(1, '')}), l2 as ({tree(2, 'where campaign in (select campaign from l1)')})",
    ),
    "decomposition_drill": chained(
        tree(1, "") + " union all " + tree(2, "where campaign = 'LOW'")
        + " union all " + tree(3, "where campaign = 'LOW' and platform = 'Google Ads'")
    ),
    "formatted_scorecard": chained(
        "select campaign, campaign_objective, '$' || format('{:,.2f}', total_spend) as total_spend, "
        "'$' || format('{:,.2f}', total_revenue) as total_revenue, format('{:.2f}', return_on_ad_spend) || 'x' as return_on_ad_spend, "
        "format('{:,}', total_conversions) as total_conversions from ("
        + measured("campaign, campaign_objective", "total_spend total_revenue return_on_ad_spend total_conversions") + ")"
    ),
    "entity_product": chained(
        'select product_key as entity_key, product_name as "Product", brand as "Brand", category as "Category", '
        'list_price as "List_Price", rating as "Rating", availability_status as "Availability_Status", product_key, '
        'product_name as "Product_Name" from dim_product'
    ),
    "entity_date": chained(
        'select date_key as entity_key, cast(date as timestamp) as "Date", cast(date_key as bigint) as date_key, '
        'cast(year as bigint) as "Year", quarter as "Quarter", month_name as "Month_Name", '
        'cast(month_number as bigint) as "Month_Number", cast(week_of_year as bigint) as "Week_of_Year", '
        'day_of_week as "Day_of_Week" from dim_date'
    ),
    "entity_channel": chained(
        'select channel_key as entity_key, source_system as "Platform", channel as "Channel", '
        "cast(channel_key as bigint) as channel_key, source_system from dim_channel"
    ),
    "entity_campaign": chained(
        'select campaign_key as entity_key, campaign_name as "Campaign", campaign_objective as "Campaign_Objective", '
        "campaign_id, campaign_name, cast(campaign_key as bigint) as campaign_key from dim_campaign"
    ),
    "entity_performance": chained(
        f'select {KEY_TEXT} as entity_key, region as "Region", device_category as "Device_Category", '
        'video_views as "Video_Views", engagements as "Engagements", impressions as "Total_Impressions", '
        'clicks as "Total_Clicks", sessions as "Total_Sessions", cast(spend as double) as "Total_Spend", '
        'cast(revenue as double) as "Total_Revenue", conversions as "Total_Conversions", leads as "Total_Leads", '
        'click_through_rate as "Click_Through_Rate", cost_per_click as "Cost_per_Click", '
        'return_on_ad_spend as "Return_on_Ad_Spend", cast(date_key as bigint) as date_key, '
        "cast(channel_key as bigint) as channel_key, cast(campaign_key as bigint) as campaign_key, product_key, "
        f"{half_up('conversions', 'sessions')} as \"Conversion_Rate\", "
        f"{half_up(cents('spend'), '(100 * leads)')} as \"Cost_per_Lead\" from fact"
    ),
    "edges_date": edge("date_key", "dim_date"),
    "edges_channel": edge("channel_key", "dim_channel"),
    "edges_campaign": edge("campaign_key", "dim_campaign"),
    "edges_product": edge("product_key", "dim_product"),
    "edges_dangling": chained(
        " union all ".join(
            orphans(f"Marketing_Performance_has_{n}", d, k, "missing_targets dangling_edges") for n, d, k in DIMS
        ),
        ", " + MOVED,
    ),
    "related_performance": chained(
        "select " + ", ".join(f"{k} as source_{k}" for k in PERFORMANCE_KEY)
        + ", campaign_key as target_key from fact where campaign_key in "
        "(select campaign_key from dim_campaign where campaign_name = 'HIGH')"
    ),
    "traverse_brand_campaigns": chained(
        'select brand as "Brand", campaign as "Campaign", count(*) as paths from gold group by 1, 2'
    ),
    "traverse_path": chained(
        "select distinct a.brand as start, b.brand as \"end\" from (select distinct brand, campaign_key from gold where brand like '%1') a "
        "join (select distinct brand, campaign_key from gold) b using (campaign_key)"
    ),
    "walk_path": chained(
        "select distinct date_key from fact where product_key in (select product_key from fact where date_key between 19960101 and 19960107)"
    ),
    "reachable_members": f"with recursive {CHAIN}" + """, link as materialized (select distinct product_key, date_key from fact),
        rows as materialized (select product_key, date_key, count(*) as n from
          (select distinct date_key, channel_key, campaign_key, product_key, region, device_category from fact) group by all),
        walk as (
          select 'Product' as entity, 1 as key, 0 as hops from dim_product where product_key = 1
          union
          select case when entity = 'Product' then 'Date' else 'Product' end, case when entity = 'Product' then date_key else product_key end, hops + 2
          from walk join link on case when entity = 'Product' then product_key else date_key end = key where hops < 4),
        least as (select entity, key, min(hops) as hops from walk group by all)
        select entity, cast(key as varchar) as entity_key, cast(hops as integer) as hops, cast(1 as bigint) as members from least
        union all
        select 'Marketing_Performance', 'all', cast(1 + least(coalesce(p.hops, 99), coalesce(d.hops, 99)) as integer) as far, cast(sum(n) as bigint)
        from rows left join (select * from least where entity = 'Product') p on p.key = product_key
        left join (select * from least where entity = 'Date') d on d.key = date_key
        where least(coalesce(p.hops, 99), coalesce(d.hops, 99)) <= 4 group by far""",
    "bounded_sample": chained(
        f"select {GRAIN}, cast(spend as double) as spend from (select *, md5({GRAIN_TEXT.format(seed='')}) as digest "
        f"from silver) order by digest, {GRAIN} limit 10000"
    ),
    "pick_member": chained(
        "select product_key from dim_product order by md5(concat_ws(chr(31), cast(product_key as varchar), '41')), "
        "product_key limit 1"
    ),
    "train_test_split": chained(f"select split, count(*) as rows from ({SPLIT}) group by 1"),
    "drop_null_columns": chained(
        f"select * exclude (device_category) from (select {CANON} from canon0 where source_system = 'Meta Ads')"
    ),
    "feature_frame": chained(
        "select event_date, campaign_id, product_id, region, impressions, clicks, sessions, cast(spend as double) as spend, "
        "conversions, leads, cast(revenue as double) as revenue, video_views, engagements, ingestion_utc from silver"
    ),
    "skew_profile": per_column(
        "select '{c}' as column_name, count({c}) as value_count, round(avg({c}), 6) as mean, "
        "round(skewness({c}), 6) as skewness from gapped"
    ),
    "impute_plan": chained(
        " union all ".join(
            f"select '{c}' as column_name, count({c}) as value_count, {strategy(c)} as strategy from gapped" for c in NUMERIC
        ),
        GAPPED,
    ),
    "impute_stats": per_column(
        "select '{c}' as column_name, round(avg({c}), 6) as mean, round(median({c}), 6) as median, "
        "(select {c} from gapped where {c} is not null group by {c} order by count(*) desc, {c} limit 1) as mode from gapped"
    ),
    "impute_apply": chained(
        f"select {GRAIN}, "
        + ", ".join(
            f"round(coalesce({c}, (select case when skewness({c}) <= 1 then avg({c}) else median({c}) end "
            f"from gapped where event_date < date '1998-01-01')), 6) as {c}"
            for c in NUMERIC
        )
        + " from gapped",
        GAPPED,
    ),
    "natural_key_gaps": chained(
        "select event_date, count(*) as rows from canon0 c where not exists "
        "(select 1 from dim_date d where d.date = c.event_date) group by 1"
    ),
    "scored_rows": chained(f"select split, count(*) as rows, count(*) as predicted from ({SPLIT}) group by 1"),
    "least_squares": chained(
        "select count(*) as rows, round(any_value(a), 4) as slope, round(any_value(b), 4) as intercept, "
        "round(sqrt(avg((spend - a * clicks - b) * (spend - a * clicks - b))), 4) as rmse from split, line where split = 'test'",
        f", split as materialized ({SPLIT}), line as (select regr_slope(spend, clicks) as a, regr_intercept(spend, clicks) as b "
        "from split where split = 'train')",
    ),
    "ridge_folds": chained(
        "select 'clicks' as inputs, strength, k as fold, count(*) as rows, round(sqrt(avg((spend - a - b * clicks) * (spend - a - b * clicks))), 4) as rmse "
        "from folded join (select *, my - b * mx as a from (select *, cxy / (vx * (1 + strength / sy)) as b from line, "
        "(values (0.0::double), (10.0), (1000.0)) s(strength))) on fold = k group by strength, k union all "
        "select 'clicks impressions', 0.0, k, count(*), round(sqrt(avg((spend - a - b * clicks - c * impressions) * (spend - a - b * clicks - c * impressions))), 4) "
        "from folded join (select *, my - b * mx - c * mz as a from (select *, (cxy * vz - czy * cxz) / (vx * vz - cxz * cxz) as b, "
        "(czy * vx - cxy * cxz) / (vx * vz - cxz * cxz) as c from line)) on fold = k group by k",
        f", folded as materialized (select clicks::double as clicks, impressions::double as impressions, cast(spend as double) as spend, "
        f"cast(cast('0x' || substr(md5({GRAIN_TEXT.format(seed=chr(44) + ' ' + chr(39) + '41' + chr(39))}), 1, 8) as bigint) % 3 as integer) as fold from silver), "
        "line as materialized (select k, avg(clicks) as mx, avg(impressions) as mz, avg(spend) as my, covar_pop(spend, clicks) as cxy, covar_pop(spend, impressions) as czy, "
        "covar_pop(clicks, impressions) as cxz, var_pop(clicks) as vx, var_pop(impressions) as vz, stddev_pop(spend) as sy "
        "from folded, (values (0), (1), (2)) t(k) where fold <> k group by k)",
    ),
    "fill_datetimes": """with days as (select user_id, event_id, case when event_type <> 'error' then cast(ts as date) end as day
        from events) select user_id, event_id, coalesce(last_value(day ignore nulls) over (partition by user_id order by event_id
        rows between unbounded preceding and current row), (select day from days where day is not null group by day
        order by count(*) desc, day limit 1)) as day from days""",
    "fitted_dates": """with days as (select user_id, ts, event_id, case when event_type <> 'error' then cast(ts as date) end as day,
        case when cast('0x' || substr(md5(concat_ws(chr(31), cast(event_id as varchar), '41')), 1, 8) as bigint) % 10000 < 8000
        then 'train' else 'test' end as split from events),
        train as (select event_id, last_value(day ignore nulls) over (partition by user_id order by ts, event_id
        rows between unbounded preceding and current row) as day from days where split = 'train'),
        every as (select event_id, last_value(day ignore nulls) over (partition by user_id order by ts, event_id
        rows between unbounded preceding and current row) as day from days)
        select d.user_id, d.event_id, d.split, coalesce(case when d.split = 'train' then t.day else e.day end,
        (select day from train where day is not null group by day order by count(*) desc, day limit 1)) as day
        from days d join every e on e.event_id = d.event_id left join train t on t.event_id = d.event_id""",
    "ffill": """select user_id, ts, event_id, last_value(case when event_type <> 'error' then value end ignore nulls)
        over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as value
        from events""",
}
