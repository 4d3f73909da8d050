"""SQL twins of the registered queries, for DuckDB over the same tables.

Written from the definition of each table and not from the Spark code: sums go
through exact decimals, quantiles use the built-in, features use plain joins.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_TX = """
tx as (
  select cast(l_shipdate as timestamp) as transaction_date, l_suppkey as vendor_id, o_custkey as meter_number,
    c_name as account_number, l_orderkey * 10 + l_linenumber as receipt_number,
    l_extendedprice as purchase_amount, l_quantity as electricity_units, l_extendedprice * l_tax as tax_amount,
    l_discount as tariff_charge, cast(0 as double) as fixed_charge, cast(0 as double) as arrears_paid,
    c_name as consumer_surname, c_mktsegment as consumer_first_name,
    cast(o_orderdate as timestamp) as customer_connectdate, c_mktsegment as vending_category,
    {town}.n_name as town, c_acctbal as outstanding_amount
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    join supplier on l_suppkey = s_suppkey
    join nation cn on c_nationkey = cn.n_nationkey join nation sn on s_nationkey = sn.n_nationkey
)"""
TX = _TX.format(town="cn")
BRANCH_TX = _TX.format(town="sn")

COLUMNS = (
    "transaction_date, vendor_id, meter_number, account_number, receipt_number, purchase_amount, "
    "electricity_units, tax_amount, tariff_charge, fixed_charge, arrears_paid, consumer_surname, "
    "consumer_first_name, customer_connectdate, vending_category, town, outstanding_amount"
).split(", ")

RAW = """
raw as (
  select case when receipt_number % 19 = 0 then 'xx' else strftime(transaction_date, '%Y-%m-%d %H:%M:%S') end as transaction_date,
    case when vendor_id % 23 = 0 then 'n/a' else ' ' || cast(vendor_id as varchar) end as vendor_id,
    cast(meter_number as varchar) || '.0' as meter_number,
    '  ' || account_number || ' ' as account_number,
    case when receipt_number % 17 = 0 then 'bad' else cast(receipt_number as varchar) end as receipt_number,
    case when vendor_id % 13 = 0 then 'abc' else cast(purchase_amount as varchar) end as purchase_amount,
    case when receipt_number % 11 = 0 then '' else cast(electricity_units as varchar) end as electricity_units,
    cast(cast(tax_amount as decimal(18,4)) as varchar) as "Tax_amount",
    cast(tariff_charge as varchar) as tariff_charge, cast(fixed_charge as varchar) as fixed_charge,
    cast(arrears_paid as varchar) as arrears_paid, ' ' || lower(consumer_surname) as consumer_surname,
    lower(consumer_first_name) || ' ' as consumer_first_name,
    strftime(customer_connectdate, '%Y-%m-%d %H:%M:%S') as customer_connectedate,
    vending_category || ' ' as vending_category, ' ' || lower(town) || '  ' as town,
    cast(outstanding_amount as varchar) as outstanding_amount
  from tx
)"""

SIGNED = """
signed as (
  select * replace (
    case when receipt_number % 13 = 0 then -purchase_amount when receipt_number % 29 = 0 then 0
         when vendor_id % 31 = 0 then null else purchase_amount end as purchase_amount,
    case when receipt_number % 7 = 0 then 0 else electricity_units end as electricity_units)
  from tx
)"""


def money(x: str) -> str:
    """Exact sum of amounts with up to four decimals."""
    return f"cast(sum(cast({x} as decimal(18,4))) as double)"


def mean(x: str) -> str:
    return f"({money(x)} / count({x}))"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def first_per_receipt(source: str, columns: list[str] = COLUMNS) -> str:
    order = ", ".join(f"{c} asc nulls first" for c in columns if c != "receipt_number")
    return (
        f"(select * exclude (place) from (select *, row_number() over (partition by receipt_number order by {order}) "
        f"as place from {source}) where place = 1)"
    )


# --- sources and sinks ----------------------------------------------------

ORACLES["bronze_roundtrip"] = f"with {TX}, {RAW} select * from raw"
# CSV has no empty text: it reads back as NULL.
ORACLES["csv_scan"] = (
    f"with {TX}, {RAW} select * replace (nullif(electricity_units, '') as electricity_units) from raw"
)

ORACLES["csv_infer"] = f"""with {TX} select * replace ({stamp("transaction_date")} as transaction_date,
  {stamp("customer_connectdate")} as customer_connectdate, cast(vendor_id as integer) as vendor_id,
  cast(meter_number as integer) as meter_number, cast(receipt_number as integer) as receipt_number) from tx"""

ORACLES["parquet_scan"] = "select o_orderkey, o_custkey, o_totalprice from orders"
ORACLES["pushed_filter"] = "select o_orderkey, o_custkey, o_totalprice from orders where o_totalprice > 100000"

ORACLES["append_merge_schema"] = f"""with {TX} select receipt_number, {stamp("transaction_date")} as transaction_date,
  purchase_amount, electricity_units, case when transaction_date >= timestamp '1998-01-01' then
  case when electricity_units > 0 then purchase_amount / electricity_units else 0 end end as price_per_unit from tx"""

ORACLES["to_messages"] = f"""with {TX} select cast(receipt_number as varchar) as key,
  cast(receipt_number as varchar) as transaction_id, cast(meter_number as varchar) as meter_id,
  'T' || cast(receipt_number as varchar) as token_id, purchase_amount, electricity_units as units_purchased,
  cast(vendor_id as varchar) as vendor_id, 'VP_' || cast(vendor_id as varchar) as vending_point_id,
  {stamp("transaction_date")} as transaction_date, vending_category as payment_method,
  account_number as customer_id, town as region from tx"""

_TYPES = {
    **dict.fromkeys(COLUMNS, "double"),
    **dict.fromkeys(("vendor_id", "meter_number", "receipt_number"), "bigint"),
    **dict.fromkeys(("transaction_date", "customer_connectdate"), "timestamp"),
    **dict.fromkeys(
        ("account_number", "consumer_surname", "consumer_first_name", "vending_category", "town"), "string"
    ),
}
ORACLES["table_report"] = f"with {TX}, {SIGNED} " + " union all ".join(
    f"select '{c}' as column_name, '{_TYPES[c]}' as data_type, count(*) as row_count, "
    f"count(*) - count({c}) as null_count from signed"
    for c in COLUMNS
)

# --- cleaning -------------------------------------------------------------

_CLEANED = """
cleaned as (
  select try_cast(transaction_date as timestamp) as transaction_date, try_cast(trim(vendor_id) as integer) as vendor_id,
    cast(try_cast(meter_number as decimal(38,4)) as bigint) as meter_number, trim(account_number) as account_number,
    try_cast(receipt_number as bigint) as receipt_number, try_cast(purchase_amount as double) as purchase_amount,
    try_cast(electricity_units as double) as electricity_units, try_cast("Tax_amount" as double) as tax_amount,
    try_cast(tariff_charge as double) as tariff_charge, try_cast(fixed_charge as double) as fixed_charge,
    try_cast(arrears_paid as double) as arrears_paid, upper(trim(consumer_surname)) as consumer_surname,
    upper(trim(consumer_first_name)) as consumer_first_name,
    try_cast(customer_connectedate as timestamp) as customer_connectdate,
    trim(vending_category) as vending_category, upper(trim(town)) as town,
    try_cast(outstanding_amount as double) as outstanding_amount
  from raw
)"""
ORACLES["silver_clean"] = f"""with {TX}, {RAW}, {_CLEANED}
select * replace ({stamp("transaction_date")} as transaction_date, {stamp("customer_connectdate")} as customer_connectdate)
from {first_per_receipt("cleaned")}"""

ORACLES["reversals"] = f"""with {TX}, {SIGNED} select receipt_number, vendor_id, purchase_amount,
  coalesce(purchase_amount < 0, false) as is_reversal from signed"""

ORACLES["silver_sales"] = f"""with {TX}, {SIGNED}
select * replace ({stamp("transaction_date")} as transaction_date, {stamp("customer_connectdate")} as customer_connectdate),
  'silver' as layer, cast(year(transaction_date) as integer) as year, cast(month(transaction_date) as integer) as month,
  cast(dayofweek(transaction_date) + 1 as integer) as day_of_week,
  case when dayofweek(transaction_date) in (0, 6) then 1 else 0 end as is_weekend,
  case when electricity_units > 0 then purchase_amount / electricity_units else 0 end as price_per_unit
from {first_per_receipt("signed")} where purchase_amount > 0"""

ORACLES["dedup_receipts"] = f"""with {TX}
select * replace ({stamp("transaction_date")} as transaction_date, {stamp("customer_connectdate")} as customer_connectdate)
from {first_per_receipt("tx")}"""

ORACLES["cleaning_report"] = f"""with {TX}, {SIGNED}, kept as (select * from {first_per_receipt("signed")})
select (select count(*) from signed) as bronze_rows,
  (select count(*) from signed) - (select count(*) from kept) as duplicates_removed,
  (select count(*) from kept where purchase_amount > 0) as rows_after_cleaning"""

# --- messages and streams -------------------------------------------------

_BROKEN = "receipt_number % 19 = 0"
ORACLES["parse_messages"] = f"""with {TX} select cast(receipt_number as varchar) as transaction_id,
  cast(meter_number as varchar) as meter_id, 'T' || cast(receipt_number as varchar) as token_id, purchase_amount,
  electricity_units as units_purchased, cast(vendor_id as varchar) as vendor_id,
  'VP_' || cast(vendor_id as varchar) as vending_point_id,
  case when receipt_number % 7 <> 0 then {stamp("transaction_date")} end as transaction_date,
  vending_category as payment_method, account_number as customer_id, town as region
from tx where not ({_BROKEN})"""

ORACLES["normalize_messages"] = f"""with {TX} select
  case when receipt_number % 5 <> 0 then 'R' || cast(receipt_number as varchar)
    else 'TXN_' || cast(receipt_number as varchar) || '_1009843200' end as transaction_id,
  case when vendor_id % 6 <> 0 then cast(meter_number as varchar)
    else 'METER_' || cast(receipt_number as varchar) end as meter_id,
  'TOKEN_' || cast(receipt_number as varchar) as token_id,
  case when receipt_number % 3 = 0 then purchase_amount when receipt_number % 7 = 0 then 0
    else purchase_amount / 2 end as purchase_amount,
  case when receipt_number % 11 <> 0 then electricity_units else 0 end as units_purchased,
  case when vendor_id % 4 <> 0 then cast(vendor_id as varchar) else 'VENDOR_001' end as vendor_id,
  case when vendor_id % 3 <> 0 then 'P' || cast(vendor_id as varchar) else 'VP_001' end as vending_point_id,
  case when receipt_number % 9 = 0 then '2002-01-01 00:00:00.000000' else {stamp("transaction_date")} end as transaction_date,
  case when vendor_id % 10 <> 0 then vending_category else 'CASH' end as payment_method,
  'CUST_' || cast(receipt_number as varchar) as customer_id, 'UNKNOWN' as region
from tx"""

ORACLES["to_canonical"] = f"""with {TX} select {stamp("transaction_date")} as transaction_date,
  cast(vendor_id as varchar) as vendor_id, cast(meter_number as varchar) as meter_number, account_number,
  cast(receipt_number as varchar) as receipt_number, purchase_amount, electricity_units, town from tx"""

ORACLES["stream_ingest"] = f"""select cast(event_id as varchar) as transaction_id, cast(user_id as varchar) as meter_id,
  cast(null as varchar) as token_id, value * 1000 as purchase_amount, value as units_purchased,
  cast(null as varchar) as vendor_id, cast(null as varchar) as vending_point_id,
  {stamp("ts")} as transaction_date,
  cast(null as varchar) as payment_method, cast(user_id as varchar) as customer_id, event_type as region,
  'kafka' as source_file, 'PENDING' as data_quality_status from events"""

_LIVE = "live as (select user_id as meter_number, user_id as account_number, event_type as town, value * 1000 as purchase_amount, value as electricity_units from events)"
ORACLES["live_kpis"] = f"""with {_LIVE} select {money("purchase_amount")} as live_revenue,
  {money("electricity_units")} as live_units_sold, count(*) as live_transactions from live"""
ORACLES["live_town_activity"] = f"""with {_LIVE} select town, {money("purchase_amount")} as live_town_revenue,
  count(*) as live_town_transactions from live group by town order by live_town_revenue desc, town limit 20"""
ORACLES["live_alerts"] = f"""with {_LIVE} select * from live where purchase_amount > 100000
  order by purchase_amount desc, meter_number, account_number, town, electricity_units limit 50"""
ORACLES["live_alert_count"] = f"with {_LIVE} select count(*) as live_alerts from live where purchase_amount > 100000"

ORACLES["ingest_progress"] = """select n as rows_ingested, n / 43000000.0 * 100 as progress_pct, 43000000 - n as remaining,
  case when n > 10 then (43000000 - n) / (n / 10.0) else 0 end as eta_minutes from
  (select cast(count(*) as bigint) as n from lineitem) replace_me"""

ORACLES["live_report_alerts"] = f"with {_LIVE} select least(count(*), 50) as live_alerts from live where purchase_amount > 100000"

_CANON = ["transaction_date", "vendor_id", "meter_number", "account_number", "purchase_amount", "electricity_units", "town"]
ORACLES["silver_from_messages"] = f"""with {TX}, canon as (select transaction_date, cast(vendor_id as varchar) as vendor_id,
  cast(meter_number as varchar) as meter_number, account_number, cast(receipt_number as varchar) as receipt_number,
  purchase_amount, electricity_units, town from tx)
select * replace ({stamp("transaction_date")} as transaction_date),
  'silver' as layer, cast(year(transaction_date) as integer) as year, cast(month(transaction_date) as integer) as month,
  cast(dayofweek(transaction_date) + 1 as integer) as day_of_week,
  case when dayofweek(transaction_date) in (0, 6) then 1 else 0 end as is_weekend,
  case when electricity_units > 0 then purchase_amount / electricity_units else 0 end as price_per_unit
from {first_per_receipt("canon", _CANON)} where purchase_amount > 0"""

# --- gold -----------------------------------------------------------------

_MONTHLY = f"""monthly as (select cast(year(transaction_date) as integer) as year, cast(month(transaction_date) as integer) as month,
  {money("purchase_amount")} as total_revenue, {money("electricity_units")} as total_units_sold,
  count(*) as total_transactions, {mean("purchase_amount")} as avg_purchase_amount from tx group by 1, 2)"""
ORACLES["monthly_revenue"] = ORACLES["catalog_table"] = f"with {TX}, {_MONTHLY} select * from monthly"

ORACLES["medallion_gold"] = f"""with {TX.replace("tx as", "sold as", 1)}, {RAW.replace("from tx", "from sold")}, {_CLEANED},
tx as (select * from {first_per_receipt("cleaned")}), {_MONTHLY} select * from monthly"""

_TOWNS = f"""towns as (select town, {money("purchase_amount")} as total_revenue,
  {money("electricity_units")} as total_units_sold, count(*) as total_transactions,
  {mean("purchase_amount")} as avg_purchase_amount from tx group by town)"""
ORACLES["town_summary"] = ORACLES["csv_sink_roundtrip"] = f"with {TX}, {_TOWNS} select * from towns"

_CUSTOMERS = f"""customers as (select meter_number, account_number, {money("purchase_amount")} as customer_total_spent,
  {money("electricity_units")} as customer_total_units, count(*) as customer_transactions,
  {mean("purchase_amount")} as customer_avg_purchase, {stamp("max(transaction_date)")} as last_purchase_date,
  {stamp("min(transaction_date)")} as first_purchase_date from tx group by 1, 2)"""
ORACLES["customer_summary"] = f"with {TX}, {_CUSTOMERS} select * from customers"

_TRENDS = f"""trends as (select cast(year(transaction_date) as integer) as year, cast(month(transaction_date) as integer) as month, town,
  {money("purchase_amount")} as monthly_town_revenue, count(*) as monthly_town_transactions,
  {mean("purchase_amount")} as avg_payment_value from tx group by 1, 2, 3)"""
ORACLES["payment_trends"] = f"with {TX}, {_TRENDS} select * from trends"

_FRAUD = f"""fraud as (select meter_number, account_number, town, count(*) as transaction_count,
  {money("purchase_amount")} as total_spent, {mean("purchase_amount")} as avg_purchase,
  round(stddev_samp(purchase_amount), 4) as std_purchase, max(purchase_amount) as max_purchase,
  min(purchase_amount) as min_purchase, {money("electricity_units")} as total_units,
  max(transaction_date) as last_transaction_date from tx group by 1, 2, 3)"""
_SHOW_LAST = f"select * replace ({stamp('last_transaction_date')} as last_transaction_date)"
ORACLES["fraud_base"] = f"with {BRANCH_TX}, {_FRAUD} {_SHOW_LAST} from fraud"

_RULES = f"""{_FRAUD}, rules as (select fraud.*, case when max_purchase > 100000 then 1 else 0 end as high_value_flag,
  case when transaction_count > (select quantile_cont(transaction_count, 0.95) from fraud) then 1 else 0 end as frequent_transaction_flag,
  case when date_diff('day', cast(last_transaction_date as date), (select cast(max(transaction_date) as date) from tx)) > 90
    then 1 else 0 end as inactive_customer_flag from fraud),
ruled as (select *, high_value_flag + frequent_transaction_flag as anomaly_score from rules)"""
ORACLES["anomaly_rules"] = f"with {BRANCH_TX}, {_RULES} {_SHOW_LAST} from ruled"

_DAILY = f"""daily as (select cast(transaction_date as date) as date, {money("purchase_amount")} as daily_revenue,
  {money("electricity_units")} as daily_units_sold, count(*) as daily_transactions,
  {mean("purchase_amount")} as avg_purchase_amount from tx where transaction_date is not null group by 1)"""
ORACLES["daily_features"] = f"with {TX}, {_DAILY} select * replace ({day('date')} as date) from daily"

# --- features -------------------------------------------------------------

_BASE = f"""last_day as (select cast(max(transaction_date) as date) as d from tx),
base as (select *, date_diff('day', first_purchase_date, last_transaction_date) + 1 as customer_lifetime_days,
    (date_diff('day', first_purchase_date, last_transaction_date) + 1) / transaction_count as avg_depletion_interval_days,
    date_diff('day', last_transaction_date, (select d from last_day)) as inactive_days
  from (select meter_number, account_number, town, count(*) as transaction_count,
    {money("purchase_amount")} as total_spent, {mean("purchase_amount")} as avg_purchase,
    max(purchase_amount) as max_purchase, round(stddev_samp(purchase_amount), 4) as std_purchase,
    {money("electricity_units")} as total_units, {mean("electricity_units")} as avg_units,
    max(electricity_units) as max_units, round(stddev_samp(electricity_units), 4) as std_units,
    min(cast(transaction_date as date)) as first_purchase_date,
    max(cast(transaction_date as date)) as last_transaction_date
  from tx group by 1, 2, 3))"""
_INTS = """cast(customer_lifetime_days as integer) as customer_lifetime_days, cast(inactive_days as integer) as inactive_days"""
_SHOW_BASE = f"""select * replace ({day("first_purchase_date")} as first_purchase_date,
  {day("last_transaction_date")} as last_transaction_date, {_INTS})"""
ORACLES["risk_base"] = f"with {BRANCH_TX}, {_BASE} {_SHOW_BASE} from base"


def _behaviour(name: str, condition: str) -> str:
    return f"""{name} as (select meter_number, {mean("electricity_units")} as {name}_avg_units,
  {mean("purchase_amount")} as {name}_avg_purchase, count(*) as {name}_transaction_count
  from tx, last_day where date_diff('day', cast(transaction_date as date), d) {condition} group by 1)"""


_WINDOWS = f'{_behaviour("recent", "<= 30")}, {_behaviour("historical", "> 30")}'
_MEASURED = ("avg_units", "avg_purchase")
ORACLES["recent_history"] = f"""with {TX}, last_day as (select cast(max(transaction_date) as date) as d from tx), {_WINDOWS}
select m.meter_number, recent_avg_units, recent_avg_purchase, coalesce(recent_transaction_count, 0) as recent_transaction_count,
  historical_avg_units, historical_avg_purchase, coalesce(historical_transaction_count, 0) as historical_transaction_count
from (select distinct meter_number from tx) m left join recent using (meter_number) left join historical using (meter_number)"""

_FILLED = ", ".join(
    f"coalesce({w}_{m}, 0) as {w}_{m}"
    for w in ("recent", "historical")
    for m in ("avg_units", "avg_purchase", "transaction_count")
)
_FEATURES = f"""{_BASE}, {_WINDOWS},
joined as (select base.* replace (coalesce(std_purchase, 0) as std_purchase, coalesce(std_units, 0) as std_units), {_FILLED}
  from base left join recent using (meter_number) left join historical using (meter_number)),
features as (select *,
  case when historical_avg_units > 0 then recent_avg_units / historical_avg_units else 1 end as consumption_drop_ratio,
  case when avg_purchase > 0 then max_purchase / avg_purchase else 1 end as purchase_spike_ratio,
  case when avg_units > 0 then max_units / avg_units else 1 end as unit_spike_ratio from joined)"""
ORACLES["risk_features"] = f"with {BRANCH_TX}, {_FEATURES} {_SHOW_BASE} from features"

_NUMERIC = (
    "transaction_count, total_spent, avg_purchase, max_purchase, std_purchase, total_units, avg_units, max_units, "
    "std_units, customer_lifetime_days, avg_depletion_interval_days, inactive_days, recent_avg_units, "
    "recent_avg_purchase, recent_transaction_count, historical_avg_units, historical_avg_purchase, "
    "historical_transaction_count, consumption_drop_ratio, purchase_spike_ratio, unit_spike_ratio"
).split(", ")
_KEYS = "meter_number, account_number, town"
ORACLES["risk_matrix"] = f"with {BRANCH_TX}, {_FEATURES} select {_KEYS}, " + ", ".join(
    f"cast({c} as double) as {c}" for c in _NUMERIC
) + " from features"
ORACLES["standardize"] = f"with {BRANCH_TX}, {_FEATURES} select {_KEYS}, " + ", ".join(
    f"round(coalesce(({c} - avg({c}) over ()) / nullif(stddev_pop({c}) over (), 0), 0), 6) as {c}" for c in _NUMERIC
) + " from features"

ORACLES["token_depletion"] = f"""with {BRANCH_TX}, {_BASE}
select {_KEYS}, transaction_count as total_purchases, total_units as total_units_purchased,
  total_spent as total_amount_paid, avg_units as avg_units_per_purchase, avg_purchase as avg_purchase_amount,
  {day("first_purchase_date")} as first_purchase_date, {day("last_transaction_date")} as last_purchase_date,
  cast(customer_lifetime_days as integer) as customer_lifetime_days,
  total_units / customer_lifetime_days as avg_daily_units,
  customer_lifetime_days / transaction_count as purchase_frequency_days,
  avg_units / nullif(total_units / customer_lifetime_days, 0) as estimated_days_to_depletion
from base"""

_TOP = "top as (select meter_number, count(*) as txn_count from tx group by 1 order by 2 desc, 1 limit 10)"
ORACLES["top_meters"] = f"with {TX}, {_TOP} select * from top"
ORACLES["meter_daily"] = f"""with {TX}, {_TOP} select meter_number, {day("cast(transaction_date as date)")} as ds,
  {money("electricity_units")} as y from tx where meter_number in (select meter_number from top)
  and transaction_date is not null group by 1, cast(transaction_date as date)"""

# --- risk -----------------------------------------------------------------

_FLAGS = (
    "irregular_vending_volume_flag, frequent_transaction_flag, unusual_depletion_interval_flag, "
    "sudden_consumption_drop_flag, purchase_spike_flag, unit_spike_flag, inactive_customer_flag, high_variability_flag"
).split(", ")
_SCORES = f"""{_FEATURES}, cuts as (select quantile_cont(max_purchase, 0.95) as volume,
  quantile_cont(transaction_count, 0.95) as frequent, quantile_cont(avg_depletion_interval_days, 0.05) as gap,
  quantile_cont(std_purchase, 0.95) as variable, quantile_cont(max_purchase, 0.90) as p90,
  quantile_cont(max_purchase, 0.98) as p98 from features),
flagged as (select features.*, max_purchase as risk_score,
  case when max_purchase >= p98 then 2 when max_purchase >= p90 then 1 else 0 end as anomaly_score,
  case when max_purchase >= volume then 1 else 0 end as irregular_vending_volume_flag,
  case when transaction_count >= frequent then 1 else 0 end as frequent_transaction_flag,
  case when avg_depletion_interval_days <= gap then 1 else 0 end as unusual_depletion_interval_flag,
  case when consumption_drop_ratio < 0.30 then 1 else 0 end as sudden_consumption_drop_flag,
  case when purchase_spike_ratio >= 3 then 1 else 0 end as purchase_spike_flag,
  case when unit_spike_ratio >= 3 then 1 else 0 end as unit_spike_flag,
  case when inactive_days > 90 then 1 else 0 end as inactive_customer_flag,
  case when std_purchase >= variable then 1 else 0 end as high_variability_flag from features, cuts),
scores as (select *, irregular_vending_volume_flag as high_value_flag, {" + ".join(_FLAGS)} as fraud_scenario_score from flagged)"""
ORACLES["scenario_flags"] = f"""with {BRANCH_TX}, {_SCORES}
select {_KEYS}, {", ".join(_FLAGS)}, high_value_flag, fraud_scenario_score from scores"""
ORACLES["risk_tiers"] = f"with {BRANCH_TX}, {_SCORES} select {_KEYS}, risk_score, anomaly_score from scores"

ORACLES["documented_rules"] = f"""with {BRANCH_TX}, {_FEATURES} select {_KEYS},
  case when total_units = 0 or transaction_count = 0 then 1 else 0 end as rule_never_bought,
  case when recent_avg_units < 0.5 * historical_avg_units then 1 else 0 end as rule_sharp_decline,
  case when inactive_days > 180 then 1 else 0 end as rule_inactive_6months,
  case when max_purchase / 105000 > 0.7 then 'HIGH' when max_purchase / 105000 > 0.4 then 'MEDIUM' else 'LOW' end as risk_category
from features"""

ORACLES["transaction_risk"] = f"""with {TX}, records as (select receipt_number, town, vendor_id,
    purchase_amount / 10 as amount, electricity_units as units, outstanding_amount * 6 as owed from tx),
levels as (select *, case when owed > 50000 or amount < 1000 or units < 2 then 'HIGH'
    when owed > 10000 or amount < 3000 then 'MEDIUM' else 'LOW' end as risk_level from records)
select receipt_number, town, vendor_id, risk_level,
  case risk_level when 'HIGH' then 0.85::double when 'MEDIUM' then 0.55::double else 0.15::double end as risk_score,
  cast(round(cast(amount as decimal(24,6)) * case risk_level when 'LOW' then 1.08 else 0.85 end, 2) as double) as predicted_next_purchase
from levels"""

# --- reports --------------------------------------------------------------

ORACLES["revenue_trend"] = f"""with {TX}, {_MONTHLY} select *, {day("make_date(year, month, 1)")} as period from monthly
  where make_date(year, month, 1) <> (select max(make_date(year, month, 1)) from monthly)"""
ORACLES["top_towns_revenue"] = f"""with {TX}, {_TOWNS} select * from towns where town is not null and town <> 'NULL'
  order by total_revenue desc, town limit 20"""
ORACLES["top_towns_units"] = f"""with {TX}, {_TOWNS} select * from towns where town is not null and town <> 'NULL'
  order by total_units_sold desc, town limit 15"""
ORACLES["top_customers"] = f"""with {TX}, {_CUSTOMERS} select * from customers
  order by customer_total_spent desc, meter_number, account_number limit 20"""
ORACLES["payment_ranking"] = f"""with {TX}, {_TRENDS} select town, {money("monthly_town_revenue")} as monthly_town_revenue,
  cast(sum(monthly_town_transactions) as bigint) as monthly_town_transactions from trends where town is not null
  group by town order by 2 desc, 1 limit 15"""

ORACLES["anomaly_summary"] = f"""with {BRANCH_TX}, {_RULES} select anomaly_score, count(*) as customers,
  (select count(*) from ruled) as total_records, (select count(*) from ruled where anomaly_score > 0) as anomaly_cases
  from ruled group by anomaly_score"""
ORACLES["top_anomalies"] = f"""with {BRANCH_TX}, {_RULES} {_SHOW_LAST} from ruled where anomaly_score > 0
  order by anomaly_score desc, meter_number, account_number, town limit 100"""

ORACLES["kpi_overview"] = f"""with {BRANCH_TX}, {_MONTHLY}, {_SCORES} select {money("total_revenue")} as total_revenue,
  cast(sum(total_transactions) as bigint) as total_transactions, {money("total_units_sold")} as total_units,
  (select count(*) from scores where anomaly_score > 0) as anomaly_cases,
  (select count(*) from scores where anomaly_score = 2) as high_risk_cases,
  (select {money("total_spent")} from scores where anomaly_score > 0) as revenue_at_risk from monthly"""
ORACLES["high_risk_count"] = f"with {BRANCH_TX}, {_SCORES} select count(*) as high_risk_cases from scores where anomaly_score = 2"
ORACLES["score_distribution"] = f"with {BRANCH_TX}, {_SCORES} select anomaly_score, count(*) as count from scores group by 1"
ORACLES["scenario_counts"] = f"with {BRANCH_TX}, {_SCORES} " + " union all ".join(
    f"select '{c}' as scenario, cast(sum({c}) as bigint) as count from scores" for c in _FLAGS
)
ORACLES["anomalies_by_town"] = f"""with {BRANCH_TX}, {_SCORES} select town, count(*) as fraud_cases from scores
  where anomaly_score > 0 and town is not null group by town order by 2 desc, 1 limit 15"""
ORACLES["suspicious_by_rule"] = f"""with {BRANCH_TX}, {_SCORES} select {_KEYS}, risk_score, anomaly_score,
  fraud_scenario_score, transaction_count, total_spent, max_purchase, sudden_consumption_drop_flag,
  purchase_spike_flag, inactive_customer_flag from scores where anomaly_score > 0
  order by risk_score desc, {_KEYS} limit 50"""

# --- models ---------------------------------------------------------------


def _chance(*parts: str) -> str:
    """52 bits of the md5 of parts joined by bars, as a whole number."""
    return f"('0x' || substr(md5({" || '|' || ".join(parts)}), 1, 13))::bigint"


def _split(source: str) -> str:
    """Nodes (t, node, depth, levels, m) with the feature and threshold that split their members, both NULL in leaves."""
    k = f"range(1, {len(_NUMERIC) + 1})"
    share = lambda kind: f"{_chance('42', 't::varchar', 'node::varchar', kind)} / 4503599627370496::double"
    return f"""select t, node, depth, levels, m, feature, case when lows[feature] + share * (highs[feature] - lows[feature]) >= highs[feature]
        then lows[feature] else lows[feature] + share * (highs[feature] - lows[feature]) end as threshold
    from (select *, case when depth < levels and len(m) > 1 and len(varying) > 0
        then varying[1 + floor({share("'feature'")} * len(varying))::int] end as feature, {share("'threshold'")} as share
      from (select *, list_filter({k}, lambda i: highs[i] > lows[i]) as varying
        from (select *, list_transform({k}, lambda i: list_min(list_transform(m, lambda r: r[i]))) as lows,
            list_transform({k}, lambda i: list_max(list_transform(m, lambda r: r[i]))) as highs
          from {source})))"""


_PRIME = "2147483647"
#: The rows of every tree, its growth and every customer's walk through it, by recursive queries.
_FOREST = f"""numbered as (select {_KEYS}, row_number() over () as id, [{", ".join(f"{c}::double" for c in _NUMERIC)}] as x,
    {_chance("'42'", *[f"coalesce({c}::varchar, '')" for c in _KEYS.split(", ")])} as h from features),
trees as (select t, 1 + {_chance("'42'", "t::varchar", "'factor'")} % ({_PRIME} - 1) as a,
    {_chance("'42'", "t::varchar", "'shift'")} % {_PRIME} as b from range(200) as r(t)),
drawn as (select t, x, row_number() over (partition by t order by (a * (h % {_PRIME}) + b) % {_PRIME}, h, x) as place
  from numbered, trees qualify place <= 256),
roots as (select t, 1::bigint as node, 0 as depth, greatest(1, ceil(log2(greatest(count(*), 2))))::int as levels,
    list(x order by place) as m from drawn group by t),
grown as (
  {_split("roots")}
  union all
  {_split("""(select t, 2 * node + side as node, depth + 1 as depth, levels,
            list_filter(m, lambda r: (r[feature] > threshold) = (side = 1)) as m
          from grown, (values (0), (1)) as sides(side) where feature is not null)""")}),
nodes as (select t, node, feature, threshold, case when feature is null then round(1000000 * (depth + case when len(m) <= 1 then 0
    when len(m) = 2 then 1 else 2 * (ln(len(m) - 1) + 0.5772156649015329) - 2 * (len(m) - 1)::double / len(m) end))::bigint end as path
  from grown),
walked as (
  select id, t, 1::bigint as node, feature, threshold, path from numbered, nodes where node = 1
  union all
  select w.id, w.t, n.node, n.feature, n.threshold, n.path
  from walked w join numbered r on r.id = w.id
    join nodes n on n.t = w.t and n.node = 2 * w.node + case when r.x[w.feature] > w.threshold then 1 else 0 end
  where w.path is null),
size as (select least(256, count(*)) as n from features),
paths as (select id, sum(path)::bigint as total from walked group by id),
outliers as (select id, round(pow(2, -(total / (200 * 1000000)::double) / case when n <= 2 then 1
    else 2 * (ln(n - 1) + 0.5772156649015329) - 2 * (n - 1)::double / n end), 9) as outlier_score from paths, size),
stats as (select quantile_cont(-outlier_score, 0.08) as shift, quantile_cont(outlier_score, 0.90) as p90,
  quantile_cont(outlier_score, 0.98) as p98 from outliers),
judged as (select {_KEYS}, -outlier_score - shift as isolation_score,
    cast(case when -outlier_score - shift < 0 then -1 else 1 end as integer) as isolation_prediction, -(-outlier_score - shift) as risk_score,
    cast(case when outlier_score >= p98 then 2 when outlier_score >= p90 then 1 else 0 end as integer) as anomaly_score
  from outliers join numbered using (id), stats)"""
_JUDGED = f"""{_SCORES}, {_FOREST}, judged_scores as (select scores.* exclude (risk_score, anomaly_score), isolation_score,
    isolation_prediction, judged.risk_score, judged.anomaly_score
  from scores join judged on scores.meter_number is not distinct from judged.meter_number
    and scores.account_number is not distinct from judged.account_number and scores.town is not distinct from judged.town)"""
ORACLES["forest_scores"] = f"""with recursive {BRANCH_TX}, {_FEATURES}, {_FOREST}
select {_KEYS}, isolation_prediction, isolation_score, risk_score from judged"""
ORACLES["anomaly_scores"] = f"with recursive {BRANCH_TX}, {_JUDGED} {_SHOW_BASE} from judged_scores"
ORACLES["suspicious_customers"] = f"""with recursive {BRANCH_TX}, {_JUDGED} select {_KEYS}, risk_score, anomaly_score,
  fraud_scenario_score, transaction_count, total_spent, max_purchase, sudden_consumption_drop_flag,
  purchase_spike_flag, inactive_customer_flag from judged_scores where anomaly_score > 0
  order by risk_score desc, {_KEYS} limit 50"""

_SERIES = f"{_DAILY}, series as (select 'all' as series_key, date as ds, daily_revenue as y from daily)"
_SPLIT = f"""{_SERIES}, split as (select *, case when row_number() over (partition by series_key order by ds desc) <= 30
  then 'test' else 'train' end as split, lag(y, 7) over (partition by series_key order by ds) as forecast from series)"""
ORACLES["holdout_split"] = f"with {TX}, {_SPLIT} select series_key, {day('ds')} as ds, y, split from split"
ORACLES["forecast_errors"] = f"""with {TX}, {_SPLIT} select series_key, round(avg(abs(y - forecast)), 6) as mae,
  round(sqrt(avg((y - forecast) * (y - forecast))), 6) as rmse,
  round(avg(abs((y - forecast) / nullif(y, 0))) * 100, 6) as mape from split where split = 'test' group by 1"""
ORACLES["future_dates"] = f"""with {TX}, last as (select meter_number, max(cast(transaction_date as date)) as last from tx group by 1)
select cast(meter_number as varchar) as series_key, {day("last + cast(n as integer)")} as ds from last, range(1, 31) r(n)"""
ORACLES["filled_series"] = f"""with {TX}, {_SERIES}, days as (select unnest(generate_series(min(ds), max(ds), interval 1 day)) as ds from series)
select 'all' as series_key, {day("days.ds")} as ds, coalesce(y, 0) as y from days left join series on series.ds = cast(days.ds as date)"""

# An order (1, 1, 0) is one least-squares coefficient over the daily changes from the tenth on, with a ridge of 1e-8.
_CHANGES = f"""town_days as (select town as series_key, cast(transaction_date as date) as ds, {money("purchase_amount")} as y
  from tx where transaction_date is not null group by 1, 2),
placed as (select *, row_number() over (partition by series_key order by ds desc) as back from town_days),
changes as (select series_key, ds, y, y - lag(y) over w as x, row_number() over w - 2 as t from placed where back > {{skip}}
  window w as (partition by series_key order by ds)),
pairs as (select *, lag(x) over (partition by series_key order by ds) as before from changes),
fits as (select series_key, max(t) + 1 as n, max_by(y, t) as last_y, max_by(x, t) as last_x, max(ds) as last_ds,
    sum(x * before) filter (t >= 9) / (sum(before * before) filter (t >= 9) * (1 + 1e-8)) as b
  from pairs group by 1)"""
ORACLES["forecast_towns"] = f"""with {TX}, {_CHANGES.format(skip=0)}
select series_key, {day("last_ds + cast(h as integer)")} as ds,
  case when n >= 15 then round(last_y + last_x * b * (1 - pow(b, h)) / (1 - b), 2) end as forecast,
  1::integer as p, 1::integer as d, 0::integer as q,
  case when n >= 15 then 'fitted' else (n + 1) || ' points are too few for order (1, 1, 0)' end as status
from fits, range(1, 31) r(h)"""
ORACLES["order_errors"] = f"""with {TX}, {_CHANGES.format(skip=30)},
orders as (select unnest([0, 1]) as p),
shocks as (select pairs.series_key, p, f.n - p as n, avg(pow(x - case when p = 1 then b * coalesce(before, 0) else 0 end, 2)) as v
  from pairs join fits f using (series_key), orders where t >= p group by 1, 2, 3),
tests as (select placed.series_key, p, y,
    last_y + case when p = 1 then last_x * b * (1 - pow(b, h)) / (1 - b) else 0 end as yhat
  from (select *, row_number() over (partition by series_key order by ds) as h from placed where back <= 30) placed
    join fits using (series_key), orders),
errors as (select series_key, p, avg(abs(y - yhat)) as mae, sqrt(avg(pow(y - yhat, 2))) as rmse,
  avg(abs((y - yhat) / nullif(y, 0))) * 100 as mape from tests group by 1, 2)
select series_key, p::integer as p, 1::integer as d, 0::integer as q, round(n * ln(v) + 2 * (p + 1), 4) as aic,
  round(n * ln(v) + (p + 1) * ln(n), 4) as bic, round(mae, 4) as mae, round(rmse, 4) as rmse, round(mape, 4) as mape,
  'fitted' as status, row_number() over (partition by series_key order by errors.rmse, p)::integer as place
from errors join shocks using (series_key, p)"""
ORACLES["walk_criteria"] = f"""with {TX}, {_CHANGES.format(skip=30)},
walks as (select series_key, count(x) as n, avg(x * x) as v from changes group by 1),
logs as (select *, -n / 2 * (ln(2 * pi() * v) + 1) as loglik from walks)
select series_key, case when n >= 12 then round(-2 * loglik + 2, 4) end as aic, case when n >= 12 then round(-2 * loglik + ln(n), 4) end as bic,
  case when n >= 12 then 'fitted' else (n + 1) || ' points are too few for order (0, 1, 0)' end as status from logs"""
# Level and slope are solved out of the values and of the one possible turn; the penalty, by the errors left, shrinks its height towards zero.
ORACLES["forecast_trend"] = f"""with {TX},
town_days as (select town as series_key, cast(transaction_date as date) as ds, {money("purchase_amount")} as y
  from tx where transaction_date is not null group by 1, 2),
ends as (select series_key, min(ds) as start, max(ds) as stop, greatest(date_diff('day', min(ds), max(ds)), 1)::double as span,
    avg(y) as level, case when stddev_pop(y) > 0 then stddev_pop(y) else 1 end as scale from town_days group by 1),
points as (select series_key, date_diff('day', start, ds) / span as t, greatest(0, date_diff('day', start, ds) / span - 0.4::double) as h,
    (y - level) / scale as u from town_days join ends using (series_key)),
lines as (select series_key, count(*) as n, coalesce(regr_slope(u, t), 0) as ub, coalesce(regr_intercept(u, t), avg(u)) as ua,
    coalesce(regr_slope(h, t), 0) as hb, coalesce(regr_intercept(h, t), avg(h)) as ha from points group by 1),
beyond as (select series_key, sum(pow(h - ha - hb * t, 2)) as g, sum((h - ha - hb * t) * u) as c, sum(pow(u - ua - ub * t, 2)) as r
  from points join lines using (series_key) group by 1),
free as (select *, c / (g + 1e-6 * n) as d from lines join beyond using (series_key)),
costs as (select *, case when n > 6 then (r - 2 * d * c + d * d * g) / (n - 3) else r / n end / 0.25::double as cost from free),
turned as (select *, case when g > 1e-9 * n then sign(c) * greatest(abs(c) - cost, 0) / g else 0 end as turn from costs)
select series_key, {day("stop + cast(k as integer)")} as ds,
  round(((ua - turn * ha) + (ub - turn * hb) * (1 + k / span) + turn * (1 + k / span - 0.4::double)) * scale + level, 2) as yhat
from turned join ends using (series_key), range(1, 31) r(k)"""
ORACLES["forecast_unit_days"] = f"""with {TX}, last as (
  select meter_number, max(cast(transaction_date as date)) as last from tx group by 1)
select cast(meter_number as varchar) as meter_number, {day("last + cast(n as integer)")} as ds, true as inside
from last, range(1, 31) r(n)"""
