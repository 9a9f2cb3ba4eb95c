"""The registered queries in SQL, over the same tables.

`PARTS` holds the derived tables; every query names the ones it needs and they are put in front of it.
"""

import re

# Fixed values, spelled out apart from the library's own lists.
FUEL_TYPES = [
    "Biomass", "Fossil Brown coal/Lignite", "Fossil Coal-derived gas", "Fossil Gas", "Fossil Hard coal",
    "Fossil Oil", "Fossil Oil shale", "Fossil Peat", "Geothermal", "Hydro Pumped Storage",
    "Hydro Run-of-river and poundage", "Hydro Water Reservoir", "Marine", "Nuclear", "Other",
    "Other renewable", "Solar", "Waste", "Wind Offshore", "Wind Onshore",
]
RENEWABLE_FUELS = {"Biomass", "Geothermal", "Hydro Pumped Storage", "Hydro Run-of-river and poundage", "Hydro Water Reservoir", "Marine", "Solar", "Wind Offshore", "Wind Onshore"}
FOSSIL_FUELS = {"Fossil Brown coal/Lignite", "Fossil Coal-derived gas", "Fossil Gas", "Fossil Hard coal", "Fossil Oil", "Fossil Oil shale", "Fossil Peat"}


def normalize_name(name):
    return re.sub("[^a-z0-9]+", "_", name.lower()).strip("_")


COLS = [normalize_name(f) for f in FUEL_TYPES]
FUEL_LIST = "[" + ", ".join(f"'{f}'" for f in FUEL_TYPES) + "]"


def exact_sum(x):
    return f"cast(sum(cast({x} as decimal(18,2))) as double)"


def exact_avg(x, over=""):
    return f"cast(sum(cast({x} as decimal(18,2))){over} as double) / nullif(count({x}){over}, 0)"


def zero_sum(columns):
    return " + ".join(f"coalesce({c}, 0.0)" for c in columns)


def of(fuels):
    return [normalize_name(f) for f in FUEL_TYPES if f in fuels]


PIVOT = ", ".join(
    f"cast(sum(cast(generation_mw as decimal(18,2))) filter (where fuel_type = '{f}') as double) as {c}"
    for f, c in zip(FUEL_TYPES, COLS)) + f""", cast(sum(cast(generation_mw as decimal(18,2)))
    filter (where fuel_type is null or not list_contains({FUEL_LIST}, fuel_type)) as double) as unlisted"""
COLS = [*COLS, "unlisted"]
MIX = f"""*, case when total_mw > 0 then renewable_mw / total_mw end as renewable_share,
    case when total_mw > 0 then fossil_mw / total_mw end as fossil_share,
    total_mw - ({zero_sum(of(['Wind Offshore', 'Wind Onshore']))}) - ({zero_sum(['solar'])}) as residual_load_mw"""
SUMS = f"""*, {zero_sum(COLS)} as total_mw, {zero_sum(of(RENEWABLE_FUELS))} as renewable_mw,
    {zero_sum(of(FOSSIL_FUELS))} as fossil_mw"""
WEEK = " over (partition by zone order by timestamp range between interval 168 hours preceding and current row)"
WEEK_ROWS = " over (partition by zone order by timestamp rows between 167 preceding and current row)"
INTERVAL = "coalesce(nullif((hour(ts) * 60 + minute(ts)) // 15, 0), 96)"


def read_in_order(rows, series):
    """Instants of local stamps of 2024, in the repeated hour by the order of the rows."""
    return f"""select * replace (case when not twice then utc when coalesce(bool_or(back) over (partition by {series}
            twice order by place, tie), false) then local - interval 1 hour else local - interval 2 hours end as utc)
        from (select *, local <= lag(local) over (partition by {series} twice order by place, tie) as back
        from (select *, local >= timestamp '2024-10-27 02:00' and local < timestamp '2024-10-27 03:00' as twice
        from (select *, epoch_us(utc) as place, utc + case when utc >= timestamp '2024-03-31 01:00'
            and utc < timestamp '2024-10-27 01:00' then interval 2 hours else interval 1 hour end as local
        from ({rows}))))"""


PARTS = {
    "local_prices": read_in_order("""select timestamp + case when cast(zone as integer) % 2 = 0 then interval 85 days
        else interval 295 days end as utc, zone, price_eur_mwh, 0 as tie from (
        select date_trunc('hour', ts) as timestamp, cast(user_id // 5 % 30 as varchar) as zone,
            max(value) - 40 as price_eur_mwh from events group by all)""", "zone,"),
    "local_records": read_in_order("""select ts + case when user_id % 2 = 0 then interval 85 days
        else interval 295 days end as utc, value as demand_mw, event_id as tie from events""", ""),
    "gen": f"""select cast(ts as date) as date, date_trunc('hour', ts) as timestamp,
        cast(user_id % 30 as varchar) as zone,
        list_extract({FUEL_LIST}, cast(regexp_extract(props, '[0-9]+') as integer) % 20 + 1) as fuel_type,
        value as generation_mw from events""",
    "bulk": f"""select cast(l_shipdate as date) as date, l_shipdate as timestamp,
        cast(l_suppkey % 30 as varchar) as zone,
        list_extract({FUEL_LIST}, cast(l_partkey % 20 + 1 as integer)) as fuel_type,
        l_quantity as generation_mw from lineitem""",
    "prices": """select cast(ts as date) as date, date_trunc('hour', ts) as timestamp,
        cast(user_id // 5 % 30 as varchar) as zone, max(value) - 40 as price_eur_mwh
        from events group by all""",
    "zones": """select cast(n_nationkey as varchar) as zone_code, n_name as country, r_name as region,
        'UTC' as timezone, lower(r_name) as primary_fuel, r_name || ' - ' || n_name as zone_name
        from nation left join region on n_regionkey = r_regionkey""",
    "demand": f"""select ts as event_ts, cast(ts as date) as demand_date,
        cast({INTERVAL} as bigint) as interval_id, value as demand_mw, ts as ingested_at, event_id
        from events""",
    "latest": """select event_ts, demand_date, interval_id, demand_mw, ingested_at from (
        select *, row_number() over (partition by demand_date, interval_id
            order by ingested_at desc, event_id desc) as rn from demand) where rn = 1""",
    "intraday": f"""select demand_date, interval_id, event_ts, demand_mw,
        {exact_avg('demand_mw', ' over (partition by demand_date order by interval_id rows between 3 preceding and current row)')}
        as demand_mw_1h_avg from latest""",
    "quotes": f"""select cast(o_orderdate as date) as date, o_orderpriority as ticker,
        arg_min(o_totalprice, o_orderkey) as open, max(o_totalprice) as high, min(o_totalprice) as low,
        arg_max(o_totalprice, o_orderkey) as close, {exact_sum('o_totalprice')} as volume
        from orders group by all""",
    "drivers": """select date as price_date, ticker, close as close_price,
        close / nullif(lag(close, 5) over w, 0) - 1 as return_5d,
        close / nullif(lag(close, 20) over w, 0) - 1 as return_20d
        from quotes window w as (partition by ticker order by date)""",
    "raw_country": """select l_shipdate as timestamp,
        case when l_tax <> 0 then l_extendedprice end as price_eur_mwh,
        l_returnflag as country, l_shipdate as ingested_at from lineitem""",
    "country_daily": f"""select cast(timestamp as date) as price_date, country,
        {exact_avg('price_eur_mwh')} as avg_price_eur_mwh, min(price_eur_mwh) as min_price_eur_mwh,
        max(price_eur_mwh) as max_price_eur_mwh, count(*) as hours_observed
        from raw_country where price_eur_mwh is not null group by all""",
    "pivoted": f"select date, timestamp, zone, {PIVOT} from gen group by all",
    "mix": f"select {MIX} from (select {SUMS} from pivoted)",
    "wide": f"""select *, {exact_avg('price_eur_mwh', WEEK)} as price_7d_mean
        from mix left join prices using (date, timestamp, zone)""",
    "wide_full": f"""select *, {exact_avg('price_eur_mwh', WEEK)} as price_7d_mean
        from mix full join prices using (date, timestamp, zone)""",
    "with_region": """select date, timestamp as ts_utc, zone as zone_code, country, region, primary_fuel,
        zone_name, timezone, price_eur_mwh, price_7d_mean, total_mw, renewable_mw, fossil_mw,
        renewable_share, fossil_share, residual_load_mw
        from wide_full left join zones on zone = zone_code""",
    "daily": f"""select date, region, country, zone_code, zone_name, primary_fuel,
        {exact_avg('price_eur_mwh')} as avg_price_eur_mwh, min(price_eur_mwh) as min_price_eur_mwh,
        max(price_eur_mwh) as max_price_eur_mwh, stddev_samp(price_eur_mwh) as price_std,
        count(*) filter (where price_eur_mwh < 0) as negative_price_hours, avg(renewable_share) as avg_renewable_share,
        avg(fossil_share) as avg_fossil_share, {exact_sum('total_mw')} as total_generation_mwh,
        {exact_avg('residual_load_mw')} as avg_residual_load_mw from with_region group by all""",
    "summary": f"""select date, region, count(distinct zone_code) as zones_reporting,
        avg(avg_price_eur_mwh) as regional_avg_price_eur_mwh, avg(price_std) as regional_avg_price_std,
        cast(sum(negative_price_hours) as bigint) as regional_negative_price_hours,
        avg(avg_renewable_share) as regional_renewable_share, avg(avg_fossil_share) as regional_fossil_share,
        {exact_sum('total_generation_mwh')} as regional_generation_mwh from daily group by all""",
    "curve": f"""select date, hour(ts_utc) as hour_utc, region, country, zone_code,
        {exact_avg('price_eur_mwh')} as avg_price_eur_mwh, avg(renewable_share) as avg_renewable_share
        from with_region where price_eur_mwh is not null group by all""",
    "landed": """select distinct cast(c_nationkey as varchar) as zone, cast(year(o_orderdate) as integer) as year
        from orders join customer on o_custkey = c_custkey""",
    "newest": "select cast(max(ts) as date) as day from events",
}

# Two months of generation and prices, the second with other fuels; columns as the fuels' names sort.
_LATER = """select * replace (case when odd then cast(date + 31 as date) else date end as date,
    case when odd then timestamp + interval 31 days else timestamp end as timestamp)
    from (select *, cast(zone as integer) % 2 = 1 as odd from {})"""
_NAMES = sorted([(normalize_name(f), f) for f in [*FUEL_TYPES, "Energy storage"]])
_DYNAMIC = {name: f"cast(sum(cast(generation_mw as decimal(18,2))) filter (where fuel = '{f}') as double) as {name}"
            for name, f in _NAMES}
_ALL = list(_DYNAMIC)
DYNAMIC = f"""select * exclude (odd), {exact_avg('price_eur_mwh', WEEK)} as price_7d_mean from (
    select *, case when total_mw > 0 then renewable_mw / total_mw end as renewable_share,
        case when total_mw > 0 then fossil_mw / total_mw end as fossil_share,
        total_mw - ({zero_sum(['wind_offshore', 'wind_onshore'])}) - ({zero_sum(['solar'])}) as residual_load_mw
    from (select *, {zero_sum(_ALL)} as total_mw,
            {zero_sum([n for n in _ALL if n in of(RENEWABLE_FUELS)])} as renewable_mw,
            {zero_sum([n for n in _ALL if n in of(FOSSIL_FUELS)])} as fossil_mw
        from (select date, timestamp, zone, {", ".join(_DYNAMIC.values())} from (
            select *, case when odd and fuel_type = 'Waste' then 'Energy storage' else fuel_type end as fuel
            from ({_LATER.format("gen")}) where odd or fuel_type not in ('Solar', 'Wind Onshore')) group by all)))
    left join ({_LATER.format("prices")}) using (date, timestamp, zone)"""

# What a derived table needs.
NEEDS = {
    "latest": ["demand"], "intraday": ["latest"], "drivers": ["quotes"], "country_daily": ["raw_country"],
    "pivoted": ["gen"], "mix": ["pivoted"], "wide": ["mix", "prices"], "wide_full": ["mix", "prices"],
    "with_region": ["wide_full", "zones"], "daily": ["with_region"], "summary": ["daily"],
    "curve": ["with_region"],
}


def with_parts(needs: str, body: str) -> str:
    order: list[str] = []

    def add(name):
        for inner in NEEDS.get(name, []):
            add(inner)
        if name not in order:
            order.append(name)

    for name in needs.split():
        add(name)
    if not order:
        return body
    return "with " + ",\n".join(f"{n} as ({PARTS[n]})" for n in order) + ("" if body.startswith(",") else "\n") + body


def check_rows(name, rules):
    """Failure counts in the shape of the quality report; `rules` are (check, column, condition)."""
    return " union all ".join(
        f"select '{name}' as table_name, '{check}' as check_name, '{column}' as column_name, "
        f"count(*) filter (where {condition}) as failures from {name}" for check, column, condition in rules)


def not_null(*columns):
    return [("not_null", c, f"{c} is null") for c in columns]


DAILY_ROUNDED = """select * replace (round(price_std, 6) as price_std,
    round(avg_renewable_share, 6) as avg_renewable_share, round(avg_fossil_share, 6) as avg_fossil_share)
    from daily"""
SUMMARY_ROUNDED = """select * replace (round(regional_avg_price_eur_mwh, 6) as regional_avg_price_eur_mwh,
    round(regional_avg_price_std, 6) as regional_avg_price_std,
    round(regional_renewable_share, 6) as regional_renewable_share,
    round(regional_fossil_share, 6) as regional_fossil_share) from summary"""
LAST_10 = "date > (select day from newest) - 10 and date <= (select day from newest)"
EMPTY_MIX = ", ".join(f"cast(null as double) as {c}" for c in (
    "total_mw", "renewable_mw", "fossil_mw", "renewable_share", "fossil_share", "residual_load_mw"))
DIRECTION = " union all ".join(
    f"""select timestamp - interval 1 hour as timestamp, 'PL' as zone, '{fuel}' as fuel_type, {exact_sum(f"case when event_type = '{kind}' and k % 2 = 0 then value end")}
    as generation_mw from hours group by timestamp"""
    for fuel, kind in (("Solar", "click"), ("Wind Onshore", "view"), ("Fossil Gas", "purchase")))
TICKERS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
RAW_PRICES = "select date, timestamp, zone, price_eur_mwh from prices"
SLIDING = """select bucket_start, bucket_start + interval 60 minutes as bucket_end, count(*) as n_rows,
    {avg} as avg_mw from (select value, unnest([time_bucket(interval 15 minutes, ts) - interval 45 minutes,
        time_bucket(interval 15 minutes, ts) - interval 30 minutes,
        time_bucket(interval 15 minutes, ts) - interval 15 minutes,
        time_bucket(interval 15 minutes, ts)]) as bucket_start from events) group by all"""

_SOURCES = {
    "hourly_wide": ("wide", "select * from wide"),
    "hourly_wide_full": ("wide_full", "select * from wide_full"),
    "hourly_wide_day": ("wide", "select * from wide where date = date '2024-01-15'"),
    "pivot_generation": ("pivoted", "select * from pivoted"),
    "pivot_bulk": ("bulk", f"""select {MIX} from (select {SUMS} from
        (select date, timestamp, zone, {PIVOT} from bulk group by all))"""),
    "unpivot_generation": ("pivoted", " union all ".join(
        f"select date, timestamp, zone, '{c}' as fuel_type, {c} as generation_mw from pivoted" for c in COLS)),
    "generation_direction": ("", f"""with hours as (select date_trunc('hour', ts) as timestamp, event_type, value,
        cast(regexp_extract(props, '[0-9]+') as integer) as k from events) {DIRECTION}"""),
    "energy_mix": ("mix", "select * from mix"),
    "stg_prices": ("raw_country", """select cast(timestamp as date) as price_date,
        timestamp as price_timestamp, country, price_eur_mwh, ingested_at
        from raw_country where price_eur_mwh is not null"""),
    "stg_demand": ("", """select cast(ts as date) as demand_date, ts as demand_timestamp, value as demand_mw,
        ts as ingested_at from events where event_type <> 'error'"""),
    "stg_quotes": ("quotes", """select date as price_date, ticker, open as open_price, high as high_price,
        low as low_price, close as close_price, cast(round(volume) as bigint) as volume from quotes
        where close is not null"""),
    "demand_events": ("demand", """select event_ts, demand_date, interval_id, demand_mw, 'PSE' as source,
        cast(null as timestamp) as ingested_at, demand_date || '-' || interval_id as key from demand"""),
    "demand_events_local": ("demand", """select event_ts - interval 1 hour as event_ts,
        cast(event_ts - interval 15 minutes as date) as demand_date, interval_id, demand_mw,
        'PSE' as source, cast(null as timestamp) as ingested_at from demand"""),
    "prices_to_utc": ("prices", """select date, timestamp - interval 1 hour as timestamp, zone, price_eur_mwh
        from prices"""),
    "prices_to_utc_dst": ("local_prices", "select utc as timestamp, zone, price_eur_mwh from local_prices"),
    "demand_intervals_dst": ("local_records", """select utc as event_ts, day as demand_date, cast(floor((epoch_us(utc)
        - epoch_us(day - case when day > date '2024-03-31' and day <= date '2024-10-27' then interval 2 hours
            else interval 1 hour end)) / 900000000) as bigint) as interval_id,
        demand_mw, 'PSE' as source, cast(null as timestamp) as ingested_at
        from (select *, cast(utc - interval 15 minutes + case when utc - interval 15 minutes >= timestamp '2024-03-31 01:00'
            and utc - interval 15 minutes < timestamp '2024-10-27 01:00' then interval 2 hours else interval 1 hour end
            as date) as day from local_records)"""),
    "hourly_resample": ("", f"""select cast(ts as date) as date, date_trunc('hour', ts) as timestamp,
        cast(user_id % 30 as varchar) as zone, {exact_avg('value')} as price_eur_mwh from events group by all"""),
    "price_7d_range": ("prices", f"select *, {exact_avg('price_eur_mwh', WEEK)} as price_7d_mean from prices"),
    "price_7d_rows": ("prices", f"""select date, timestamp as ts_utc, zone as zone_code, price_eur_mwh,
        {exact_avg('price_eur_mwh', WEEK_ROWS)} as price_7d_mean, {EMPTY_MIX} from prices"""),
    "demand_dedup": ("latest", "select * from latest"),
    "demand_1h_avg": ("intraday", "select * from intraday"),
    "hourly_with_region": ("with_region", "select * from with_region"),
    "daily_by_region": ("daily", DAILY_ROUNDED),
    "regional_summary": ("summary", SUMMARY_ROUNDED),
    "duck_curve": ("curve", """select * replace (round(avg_renewable_share, 6) as avg_renewable_share)
        from curve"""),
    "daily_prices": ("country_daily", "select * from country_daily"),
    "commodity_returns": ("drivers", "select * from drivers"),
    "zone_spread": ("prices", """select p.*, r.price_eur_mwh as reference_price_eur_mwh,
        p.price_eur_mwh - r.price_eur_mwh as price_spread_eur_mwh from prices p
        left join (select * from prices where zone = '3') r using (date, timestamp)"""),
    "incremental_filter": ("", """select event_id, ts, value from events where ts > (
        select coalesce(max(ts), timestamp '1970-01-01') from events where ts < timestamp '2024-01-20')"""),
    "merge_demand": ("demand", """, ranked as (select *, row_number() over (
            partition by demand_date, interval_id order by ingested_at desc, event_id desc) as rn from demand),
        new as (select * from ranked where rn = 1 and demand_date >= date '2024-01-20'),
        old as (select * replace (demand_mw / 2 as demand_mw) from ranked where rn = 1)
        select event_ts, demand_date, interval_id, demand_mw, ingested_at from old anti join new
            using (demand_date, interval_id)
        union all select event_ts, demand_date, interval_id, demand_mw, ingested_at from new"""),
    "pending_chunks": ("zones landed", """select zone_code as zone, cast(y.year as integer) as year from zones,
        (select unnest(range(1993, 2004)) as year) y
        where not exists (select 1 from landed l where l.zone = zone_code and l.year = y.year)"""),
    "landed_chunks": ("landed bulk", """select zone, year from landed l where exists (
        select 1 from bulk b where b.zone = l.zone and year(b.timestamp) = l.year)"""),
    "complete_pairs": ("prices gen", """select zone, timestamp, price_eur_mwh as value,
            'price_eur_mwh' as measure from prices p where exists (
            select 1 from gen g where g.zone = p.zone and g.timestamp = p.timestamp)
        union all select zone, timestamp, generation_mw, 'generation_mw' from gen g where exists (
            select 1 from prices p where g.zone = p.zone and g.timestamp = p.timestamp)"""),
    "missing_days": ("", """select cast(d as date) as date from (select unnest(generate_series(
        date '2023-12-20', date '2024-02-10', interval 1 day)) as d)
        where cast(d as date) not in (select cast(ts as date) from events where event_type <> 'error')"""),
    "batch_dates": ("", """select cast(l_shipdate as date) as date, count(*) as n_rows from lineitem
        group by all"""),
    "union_tickers": ("", """select cast(o_orderdate as date) as date, o_totalprice as close,
        o_orderpriority as ticker from orders"""),
    "scorecard_10d": ("summary newest", f"""select region,
        round(avg(regional_avg_price_eur_mwh), 6) as avg_price_eur_mwh from summary
        where {LAST_10} group by region"""),
    "region_spread": ("summary", """select date, round(l, 6) as left_price_eur_mwh,
        round(r, 6) as right_price_eur_mwh, round(l - r, 6) as spread_eur_mwh from (select date,
        avg(regional_avg_price_eur_mwh) filter (where region = 'AFRICA') as l,
        avg(regional_avg_price_eur_mwh) filter (where region = 'ASIA') as r
        from summary where region in ('AFRICA', 'ASIA') group by date)"""),
    "neg_hours_10d": ("summary newest", f"""select region,
        cast(sum(regional_negative_price_hours) as bigint) as negative_price_hours from summary
        where {LAST_10} group by region"""),
    "country_10d": ("daily newest", f"""select country, date, round(avg(avg_price_eur_mwh), 6)
        as avg_price_eur_mwh from daily where {LAST_10} group by country, date"""),
    "zone_date_heatmap": ("daily", """select zone_code, date, round(avg(avg_price_eur_mwh), 6)
        as avg_price_eur_mwh from daily group by zone_code, date"""),
    "zone_date_matrix": ("daily", "select zone_code, " + ", ".join(
        f"round(avg(avg_price_eur_mwh) filter (where date = date '2024-01-{i:02}'), 6) as d{i}"
        for i in range(1, 32)) + " from daily group by zone_code"),
    "seasonal_profile": ("curve", """select region, hour_utc, round(avg(avg_price_eur_mwh), 6)
        as avg_price_eur_mwh from curve where month(date) in (12, 1, 2) group by region, hour_utc"""),
    "price_vs_driver": ("country_daily drivers", """select price_date, avg_price_eur_mwh, close_price
        from (select * from country_daily where country = 'N')
        left join (select price_date, close_price from drivers where ticker = '3-MEDIUM') using (price_date)"""),
    "driver_series": ("drivers", """select price_date, ticker, close_price from drivers
        where ticker in ('1-URGENT', '2-HIGH', '3-MEDIUM')"""),
    "ticker_corr": ("drivers", """select a.ticker as ticker_a, b.ticker as ticker_b,
        round(corr(a.close_price, b.close_price), 6) as correlation, count(*) as n_days
        from drivers a join drivers b on a.price_date = b.price_date and a.ticker < b.ticker group by all"""),
    "intraday_line": ("intraday", "select event_ts, demand_mw from intraday"),
    "dq_not_null": ("with_region", check_rows("with_region", not_null(
        "price_eur_mwh", "region", "total_mw", "zone_code")).replace("'with_region'", "'hourly_with_region'")),
    "dq_unique": ("", """select l_orderkey, l_linenumber, count(*) as n_rows from lineitem
        group by all having count(*) > 1"""),
    "dq_accepted_values": ("", check_rows("events", [
        ("accepted_values", "event_type", "event_type not in ('click', 'view', 'purchase')"),
        ("accepted_values", "user_id", "user_id not between 0 and 9")])),
    "dq_range": ("", check_rows("lineitem", [
        ("accepted_range", "l_quantity", "l_quantity not between 1 and 49"),
        ("accepted_range", "l_discount", "l_discount not between cast(0.02 as double) and cast(0.08 as double)")])),
    "dq_failing_rows": ("raw_country", """select timestamp, country, price_eur_mwh,
        case when price_eur_mwh is null then 'not_null:price_eur_mwh'
        else 'accepted_range:price_eur_mwh' end as failed from raw_country
        where price_eur_mwh is null or price_eur_mwh not between 1000 and 90000"""),
    "dq_contracts": ("zones country_daily intraday curve", " union all ".join([
        check_rows("zones", [
            *not_null("zone_code", "region"),
            ("accepted_values", "region", "region not in ('AFRICA', 'ASIA')")]),
        """select 'zones', 'unique', 'zone_code', count(*) from (
            select zone_code from zones group by all having count(*) > 1)""",
        check_rows("country_daily", not_null("price_date", "country", "avg_price_eur_mwh")),
        check_rows("intraday", [
            *not_null("demand_date", "interval_id", "demand_mw"),
            ("accepted_range", "interval_id", "interval_id not between 1 and 96")]),
        check_rows("curve", [
            *not_null("date", "hour_utc", "region"),
            ("accepted_range", "hour_utc", "hour_utc not between 0 and 23")]),
    ]).replace("'zones'", "'dim_region_mapping'").replace("'country_daily'", "'fct_daily_prices'")
        .replace("'intraday'", "'fct_intraday_demand'").replace("'curve'", "'fct_eu_duck_curve'")),
    "zones_json": ("zones", "select * from zones"),
    "zones_csv": ("zones", "select * from zones"),
    "zones_by_region": ("zones", "select * from zones where region = 'ASIA'"),
    "only_zones": ("prices", f"{RAW_PRICES} where zone in ('3', '7', '28')"),
    "demand_envelopes": ("", f"""select cast(cast(ts as date) as varchar) as doba, cast(ts as varchar) as udtczas,
        value as zap_kse, cast({INTERVAL} as bigint) as znacznik from events"""),
    "quotes_landed": ("quotes", "select * replace (replace(ticker, ' ', '_') as ticker) from quotes"),
    "month_table": ("wide", "select * from wide"),
    "table_day": ("prices", "select * from prices where date = date '2024-01-15'"),
    "append_rows": ("prices", "select * from prices union all select * from prices"),
    "rows_written": ("prices", "select count(*) as n_rows from prices"),
    "load_partial_day": ("prices", """select date, timestamp, zone, case when zone = '3' and timestamp between
        timestamp '2024-01-15 00:00:00' and timestamp '2024-01-16 00:00:00' then price_eur_mwh + 1
        else price_eur_mwh end as price_eur_mwh from prices"""),
    "reload_null_days": ("", """select case when event_type <> 'error' then cast(ts as date) end as date, event_id,
        -value as value from events"""),
    "pivot_unlisted_fuel": ("", f"""select date, timestamp, zone, {PIVOT} from (select cast(ts as date) as date,
        date_trunc('hour', ts) as timestamp, cast(user_id % 30 as varchar) as zone, value as generation_mw,
        case event_type when 'click' then 'Solar' when 'view' then 'Energy storage' when 'error' then null
        else 'Fossil Gas' end as fuel_type from events) group by all"""),
    "default_source": ("", """select event_id, coalesce(case when event_type <> 'error' then event_type end, 'PSE')
        as source from events"""),
    "ordered_zones": ("zones", "select zone_code, country, region from zones order by region, zone_code"),
    "land_and_scan": ("prices", """select timestamp, price_eur_mwh, zone, 'EU' as country,
        cast(date as varchar) as dt from prices where date between date '2024-01-10' and date '2024-01-19'"""),
    "load_prices": ("prices", """select date, timestamp, zone, case when date >= date '2024-01-20'
        then price_eur_mwh + 1 else price_eur_mwh end as price_eur_mwh from prices"""),
    "load_generation": ("gen", "select date, timestamp, zone, fuel_type, generation_mw from gen"),
    "reload_dates": ("", """with rows as (select cast(l_shipdate as date) as date, l_orderkey, l_linenumber,
        l_quantity from lineitem), batch as (select * replace (-l_quantity as l_quantity) from rows
        where date between date '1996-03-10' and date '1996-05-02')
        select * from rows where date not in (select date from batch) union all select * from batch"""),
    "reload_zone_days": ("prices", """select date, timestamp, zone, case when zone = '3'
        and date >= date '2024-01-20' then 0.0 else price_eur_mwh end as price_eur_mwh from prices"""),
    "upsert_demand": ("demand", """select event_ts, demand_date, interval_id, demand_mw, ingested_at, event_id
        from (select *, row_number() over (partition by demand_date, interval_id
            order by ingested_at desc, event_id desc) as rn from demand) where rn = 1"""),
    "stream_dedup": ("demand", "select distinct demand_date, interval_id from demand"),
    "stream_window_15m": ("", f"""select time_bucket(interval 15 minutes, ts) as bucket_start,
        time_bucket(interval 15 minutes, ts) + interval 15 minutes as bucket_end, count(*) as n_rows,
        {exact_avg('value')} as avg_mw from events group by all"""),
    "stream_window_1h": ("", SLIDING.format(avg=exact_avg("value"))),
    "stream_upsert": ("intraday", "select * from intraday"),
    "stream_resume": ("intraday", "select * from intraday"),
    "stream_late": ("", """with rows as (select event_id, ts, least((day(ts) - 1) // 6, 4)
        + case event_id % 10 when 0 then 2 when 5 then 1 else 0 end as arrival from events),
        newest as (select a.arrival, max(b.newest) as newest
            from (select distinct arrival from rows) a
            left join (select arrival, max(ts) as newest from rows group by all) b on b.arrival < a.arrival - 1 group by all),
        judged as (select event_id, coalesce(ts <= date_trunc('millisecond', newest) - interval 2 days, false) as late
            from rows join newest using (arrival))
        select event_id, late, (select count(*) from judged where late) as n_dropped from judged"""),
    "stream_rejects": ("demand", """select
        case when event_id % 20 not between 1 and 6 then date_trunc('millisecond', event_ts) end as event_ts,
        case when event_id % 20 not between 1 and 6 then demand_date end as demand_date,
        case when event_id % 20 not between 1 and 6 then interval_id end as interval_id,
        case when event_id % 20 not between 1 and 6 then demand_mw end as demand_mw,
        case when event_id % 20 not between 1 and 6 then 'PSE' end as source,
        case when event_id % 20 not between 1 and 6 then date_trunc('millisecond', ingested_at) end as ingested_at,
        case event_id % 20 when 1 then '{"event_ts": 1, "demand_date": "' || event_id
            when 2 then '{"event_ts": 5, "interval_id": ' || event_id || '}'
            when 3 then '{"event_ts": 5, "demand_date": "2024-01-01", "interval_id": 97, "demand_mw": ' || event_id || '.5}'
            when 4 then '' when 5 then 'no json ' || event_id
            when 6 then '{"event_ts": "x", "demand_date": "2024-01-01", "interval_id": 1, "demand_mw": ' || event_id || '}'
            end as raw,
        case event_id % 20 when 1 then 'malformed' when 2 then 'missing demand_date,demand_mw' when 3 then 'interval'
            when 4 then 'empty' when 5 then 'malformed' when 6 then 'malformed' end as reason
        from demand"""),
    "hourly_wide_dynamic": ("gen prices", DYNAMIC),
    "demand_stamped": ("demand", """select event_ts, demand_date, interval_id, demand_mw, 'PSE' as source,
        timestamp '2024-02-01 12:30:00' as ingested_at from demand"""),
    "lower_names": ("", "select event_id, event_type, value from events"),
    "stored_marts": ("country_daily", """select * replace (round(avg_price_eur_mwh, 6) as avg_price_eur_mwh)
        from country_daily"""),
    "mart_views": ("raw_country quotes", """select price_date, count(distinct country) as countries,
        max(close) as best_close from (select cast(timestamp as date) as price_date, country from raw_country
            where price_eur_mwh is not null)
        join (select date as price_date, close from quotes where close is not null) using (price_date)
        group by price_date"""),
    "raw_registry": ("prices gen", """select p.zone, p.date, count(distinct fuel_type) as fuels,
        max(price_eur_mwh) as best from prices p join gen g on p.zone = g.zone and p.timestamp = g.timestamp
        group by p.zone, p.date"""),
    "typed_table": ("demand", """select event_ts, demand_date, interval_id, demand_mw, 'PSE' as source, ingested_at
        from demand where demand_date >= date '2024-01-20'"""),
    "bucketed_join": ("pivoted prices", "select * from pivoted full join prices using (date, timestamp, zone)"),
    "write_checked": ("country_daily", """select *, (select count(*) from country_daily where country = 'R')
        as n_refused from country_daily"""),
    "day_refreshed": ("prices", """select timestamp, zone, cast(date as varchar) as dt, case when zone in ('3', '7')
        and date = date '2024-01-15' then -1.0 else price_eur_mwh end as price_eur_mwh
        from prices where date between date '2024-01-14' and date '2024-01-16'"""),
    "range_refreshed": ("", f"""select cast(cast(ts as date) as varchar) as doba, cast(ts as varchar) as udtczas,
        case when event_type <> 'error' then value end as zap_kse, cast({INTERVAL} as bigint) as znacznik
        from events where cast(ts as date) between date '2024-01-05' and date '2024-03-01'"""),
    "stream_messages": ("demand", """select date_trunc('millisecond', event_ts) as event_ts, demand_date,
        interval_id, demand_mw, 'PSE' as source, date_trunc('millisecond', ingested_at) as ingested_at
        from demand"""),
}

# Reports from stored months give what they give from all history.
_SOURCES |= {f"{name}_stored": _SOURCES[f"{name}_10d"] for name in ("scorecard", "neg_hours", "country")}

ORACLE = {name: with_parts(*parts) for name, parts in _SOURCES.items()}
