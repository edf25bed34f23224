"""The same queries in DuckDB SQL, written independently of the Spark plans.

Lookbacks are self-joins here, averages are folds over lists, as-of joins are
ASOF joins: plain definitions instead of the prefix sums the library uses.
"""

from __future__ import annotations

SQL: dict[str, str] = {}


PSI_COLUMNS = [
    "amount", "amount_log", "tx_count_10m", "tx_count_1h", "tx_count_24h", "total_amount_24h",
    "unique_merchants_24h", "time_since_last_tx", "hour_of_day", "merchant_fraud_rate",
]


def r(expression: str, digits: int = 6) -> str:
    """Half-up rounding through nine decimals, as the Spark side does it."""
    return (
        f"cast(cast(cast({expression} as decimal(28,9)) as decimal(28,{digits})) as double)"
    )


TX = """tx as (
  select cast(event_id as varchar) transaction_id, cast(user_id as varchar) card_id,
    'm' || json_extract_string(props, '$.k') merchant_id, event_type merchant_category,
    cast(value * (case when event_id % 7 = 0 then 25 else 1 end) as decimal(18,2)) amount,
    case when user_id % 5 = 0 then (us // 345600000000) * 345600000000
      + (us % 345600000000) // 288 else us end ts_us,
    case when event_id % 20 = 0 then null else 25 + ((event_id * 37) % 200) / 10.0::double end lat,
    case when event_id % 20 = 0 then null else -120 + ((event_id * 53) % 400) / 10.0::double end lon,
    cast((event_id * 7919) % 100 < 2 + least(85, floor(value
      * (case when event_id % 7 = 0 then 25 else 1 end) / 12)) as int) is_fraud, event_id, user_id
  from (select *, epoch_us(ts) us from events))"""

TIES = """ties as (
  select cast(o_orderkey as varchar) transaction_id, cast(o_custkey as varchar) card_id,
    'm' || (o_orderkey % 97) merchant_id, o_orderpriority merchant_category,
    cast(o_totalprice as decimal(18,2)) amount,
    epoch_us(date_trunc('month', o_orderdate)::timestamp) ts_us
  from orders)"""

RAW = (
    TX
    + """, raw0 as (
  select *, event_id % 40 res, strftime(make_timestamp(ts_us), '%Y-%m-%d %H:%M:%S') txt,
    cast(amount as varchar) money from tx),
raw as (
  select event_id, transaction_id,
    case when res = 0 then null else card_id end card_id,
    case when res = 14 then null else merchant_id end merchant_id,
    case res when 1 then 'not_a_number' when 2 then '-' || money when 3 then '0.004'
      when 8 then 'NaN' when 13 then '999999999.99' when 14 then null else money end amount,
    case res when 4 then '1999-12-31 00:00:00' when 5 then 'invalid_timestamp'
      when 9 then replace(txt, ' ', 'T') || 'Z'
      when 10 then cast(ts_us // 1000000 as varchar)
      when 19 then strftime(make_timestamp(ts_us), '%Y%m%dT%H%M%S')
      when 21 then strftime(make_timestamp(ts_us + 19800000000), '%Y-%m-%dT%H:%M:%S') || '+0530' when 15 then '12:00:00' else txt end "timestamp",
    case res when 11 then null when 12 then '' else merchant_category end merchant_category,
    case when res = 6 then '91.0' when res = 17 then 'inf' else cast(lat as varchar) end location_lat,
    case when res = 7 then '-181.0' when res = 18 then 'NaN' else cast(lon as varchar) end location_lon
  from raw0, range(case when res = 16 then 2 else 1 end) copies)"""
)

CLEAN = (
    RAW
    + """, typed as (
  select *, try_cast(amount as double) d,
    try_cast(location_lat as double) lat_d, try_cast(location_lon as double) lon_d,
    concat_ws(', ', case when transaction_id is null then 'transaction_id' end,
      case when card_id is null then 'card_id' end, case when amount is null then 'amount' end,
      case when merchant_id is null then 'merchant_id' end,
      case when "timestamp" is null then 'timestamp' end) missing,
    case when regexp_matches("timestamp", '^[0-9]+$') then cast("timestamp" as bigint)
      when regexp_matches("timestamp", '^[0-9]{8}T[0-9]{6}$')
      then epoch_us(strptime("timestamp", '%Y%m%dT%H%M%S')) // 1000000
      when regexp_matches("timestamp", '[+]0530$')
      then epoch_us(try_cast(replace("timestamp"[1:19], 'T', ' ') as timestamp)) // 1000000 - 19800
      when regexp_matches("timestamp", '^[0-9]{4}-')
      then epoch_us(try_cast(replace(replace("timestamp", 'T', ' '), 'Z', '') as timestamp)) // 1000000
      end secs
  from raw),
valued as (
  select *, case when d is null or isnan(d) then null when abs(d) > 10000 then 10000.00
    else abs(cast(amount as decimal(18,2))) end amt from typed),
clean as (
  select *, case when missing <> '' then 'Missing required fields: ' || missing
    when amt is null then 'Type casting error'
    when secs is null then 'Unable to parse timestamp'
    when amt <= 0 then 'Amount must be positive'
    when secs not between 946684800 and 4102444800 then 'Timestamp out of range'
    when lat_d not between -90 and 90 then 'Invalid latitude'
    when lon_d not between -180 and 180 then 'Invalid longitude' end reason
  from valued)"""
)


def lookback(table: str) -> str:
    """Self-join: the rows a transaction could see."""
    earlier = "(b.ts_us < a.ts_us or (b.ts_us = a.ts_us and b.transaction_id < a.transaction_id))"
    columns = ", ".join(
        f"count(b.ts_us) filter (b.ts_us >= a.ts_us - {s}000000) tx_count_{w}, "
        f"coalesce(sum(b.amount) filter (b.ts_us >= a.ts_us - {s}000000), 0)::double total_amount_{w}"
        for w, s in {"10m": 600, "1h": 3600, "24h": 86400}.items()
    )
    return f"""seen as (
  select a.transaction_id, {columns}, count(distinct b.merchant_id) unique_merchants_24h
  from {table} a left join {table} b on a.card_id = b.card_id
    and b.ts_us >= a.ts_us - 86400000000 and {earlier}
  group by a.transaction_id)"""


def idle(table: str) -> str:
    return f"""gaps as (
  select *, ts_us - lag(ts_us) over (partition by card_id order by ts_us, transaction_id) gap
  from {table}),
epochs as (
  select *, sum(case when gap > 86400000000 then 1 else 0 end)
    over (partition by card_id order by ts_us, transaction_id) epoch from gaps),
idle as (
  select a.transaction_id, count(distinct b.merchant_id) unique_merchants_since_idle
  from epochs a left join epochs b on a.card_id = b.card_id and a.epoch = b.epoch
    and (b.ts_us < a.ts_us or (b.ts_us = a.ts_us and b.transaction_id < a.transaction_id))
  group by a.transaction_id)"""


def ema(table: str) -> str:
    return f"""egaps as (
  select *, ts_us - lag(ts_us) over (partition by card_id order by ts_us, transaction_id) gap
  from {table}),
eepochs as (
  select *, sum(case when gap > 2592000000000 then 1 else 0 end)
    over (partition by card_id order by ts_us, transaction_id) epoch from egaps),
lists as (
  select *, list(amount::double) over (partition by card_id, epoch order by ts_us, transaction_id
    rows between unbounded preceding and 1 preceding) xs from eepochs),
ema as (
  select *, list_reduce(list_prepend(75.0::double, coalesce(xs, []::double[])),
    lambda a, v: 0.1::double * v + 0.9::double * a) avg0 from lists)"""


def since(table: str) -> str:
    return f"""lags as (
  select transaction_id, ts_us, lag(ts_us) over (partition by card_id order by ts_us, transaction_id) p
  from {table}),
since as (
  select transaction_id, p0 // 1000000 prev_ts,
    coalesce(ts_us // 1000000 - p0 // 1000000, 0) time_since_last_tx
  from (select *, case when ts_us - p <= 2592000000000 then p end p0 from lags))"""


ROLLING = f"""{r('avg0', 2)} avg_tx_amount_30d,
  {r('(amount::double - avg0) / avg0', 3)} amount_deviation,
  {r('amount::double / avg0', 3)} amount_vs_avg_ratio"""

MERCHANTS = """risk as (
  select merchant_id, count(*) total_transactions, sum(is_fraud) n_fraud,
    (select avg(is_fraud::double) from tx) g from tx group by merchant_id),
risks as (
  select merchant_id, total_transactions, n_fraud::double / total_transactions fraud_rate,
    ((n_fraud + 10 * g) / (total_transactions + 10)) s, g from risk),
merchants as (
  select merchant_id, total_transactions, fraud_rate, s / (s + g) risk_score from risks)"""

MERCHANT_COLUMNS = """coalesce(m.risk_score, 0.5) merchant_risk_score,
  coalesce(m.fraud_rate, 0.002) merchant_fraud_rate,
  coalesce(m.total_transactions, 100) merchant_total_transactions"""

TIME_COLUMNS = """extract(hour from make_timestamp(ts_us))::bigint hour_of_day,
  (extract(isodow from make_timestamp(ts_us)) - 1)::bigint day_of_week,
  (extract(isodow from make_timestamp(ts_us)) >= 6)::int is_weekend,
  (extract(hour from make_timestamp(ts_us)) >= 22 or extract(hour from make_timestamp(ts_us)) < 6)::int is_night"""

FEATURES = f"""{TX}, {lookback('tx')}, {idle('tx')}, {since('tx')}, {ema('tx')}, {MERCHANTS},
features as (
  select e.transaction_id, e.card_id, e.merchant_id, e.ts_us, e.amount::double amount,
    ln(1 + e.amount::double) amount_log, e.merchant_category, (e.lat is not null)::int has_location,
    s.* exclude (transaction_id), i.unique_merchants_since_idle, n.time_since_last_tx, n.prev_ts,
    e.avg0, {ROLLING}, {TIME_COLUMNS}, {MERCHANT_COLUMNS}, e.is_fraud
  from ema e join seen s using (transaction_id) join idle i using (transaction_id)
    join since n using (transaction_id) left join merchants m on m.merchant_id = e.merchant_id)"""

SCORED = f"""{FEATURES}, inputs as (
  select *, (prev_ts is null)::int is_new_card, amount / avg0 ratio,
    case when prev_ts > 0 then ts_us // 1000000 - prev_ts else 86400 end since_model,
    case when tx_count_1h > 0 then total_amount_1h / tx_count_1h else 0 end per_tx
  from features),
scored0 as (
  select *, (least(1, (case when amount > 1000 then 0.30 else 0 end)
    + (case when tx_count_10m > 5 then 0.25 else 0 end) + (case when ratio > 3 then 0.20 else 0 end)
    + (case when merchant_risk_score > 0.7 then 0.15 else 0 end)
    + (case when is_new_card = 1 then 0.10 else 0 end)))::decimal(5,2)::double fraud_probability
  from inputs),
scored as (
  select *, case when fraud_probability >= 0.7 then 'HIGH' when fraud_probability >= 0.3
      then 'MEDIUM' else 'LOW' end risk_level,
    case when fraud_probability >= 0.7 then 'BLOCK'
      when fraud_probability >= 0.3 and amount > 5000 then 'REVIEW' else 'APPROVE' end decision
  from scored0)"""


def km(a: str, b: str, c: str, d: str) -> str:
    return (
        f"2 * 6371 * asin(sqrt(least(1.0, pow(sin((radians({c}) - radians({a})) / 2), 2) "
        f"+ cos(radians({a})) * cos(radians({c})) * pow(sin((radians({d}) - radians({b})) / 2), 2))))"
    )


def km_or(a: str, b: str, c: str, d: str, other: str) -> str:
    return (
        f"case when {a} is null or {b} is null or {c} is null or {d} is null then {other} "
        f"else {km(a, b, c, d)} end"
    )


OFFLINE = f"""{TX}, firsts as (
  select *, row_number() over (partition by card_id, merchant_id order by ts_us, transaction_id) = 1 f
  from tx),
off0 as (
  select *, sum(f::int) over k uniq, row_number() over k n,
    lag(lat) over k plat, lag(lon) over k plon,
    first_value(lat ignore nulls) over (partition by card_id order by ts_us, transaction_id
      rows between unbounded preceding and unbounded following) hlat,
    first_value(lon ignore nulls) over (partition by card_id order by ts_us, transaction_id
      rows between unbounded preceding and unbounded following) hlon
  from firsts window k as (partition by card_id order by ts_us, transaction_id)),
off as (
  select *, {km_or('lat', 'lon', 'hlat', 'hlon', '0')} km_home,
    {km_or('lat', 'lon', 'plat', 'plon', '0')} km_last,
    (sum(amount) over (partition by card_id order by ts_us, transaction_id
      rows between 6 preceding and current row))::double / least(n, 7) avg_amt_7d from off0)"""
LATEST = """latest as (
  select * from off qualify row_number() over (partition by card_id
    order by ts_us desc, transaction_id desc) = 1)"""

SERVICE = f"""{OFFLINE}, {LATEST}, service as (
  select t.transaction_id, coalesce(case when l.avg_amt_7d > 0 then t.amount::double / l.avg_amt_7d end, 1) ratio,
    (t.amount > 500)::int high, (t.merchant_id = l.merchant_id)::int same, l.n / 24.0::double velocity,
    l.km_home::float km_home, extract(hour from make_timestamp(l.ts_us)) h
  from tx t join latest l using (card_id)),
service_scored as (
  select transaction_id, least(1, (case when ratio > 5 then 0.30 when ratio > 3 then 0.15 else 0 end)
    + (case when velocity > 5 then 0.25 when velocity > 3 then 0.15 else 0 end)
    + (case when high = 1 then 0.20 else 0 end)
    + (case when km_home > 1000 then 0.15 when km_home > 500 then 0.08 else 0 end)
    + (case when h < 6 then 0.10 else 0 end))::decimal(5,2)::double fraud_probability from service)"""


def put(name: str, ctes: str, select: str) -> None:
    SQL[name] = f"with {ctes} {select}" if ctes else select


# --- sources and sinks ------------------------------------------------------------------

put("src_csv", TX, f"""select transaction_id trans_num, user_id cc_num, amount::double amt,
  merchant_id merchant, merchant_category category, {r('lat')} lat,
  case when user_id % 11 = 0 then 'unknown' else strftime(date '1950-01-01'
    + (user_id % 15000)::int, '%Y-%m-%d') end dob, is_fraud from tx""")
put("sink_parquet", TX, """select strftime(make_timestamp(ts_us), '%Y-%m-%d') event_date,
  count(*) n_rows, sum(amount)::double total from tx group by 1""")
put("src_parquet", OFFLINE, """select transaction_id, user_id cc_num, amount::double amt, n tx_count_24h
  from off where ts_us >= epoch_us(timestamp '2024-01-08 12:00:00')
  and ts_us < epoch_us(timestamp '2024-01-15 12:00:00')""")
put("to_message", TX, f"""select transaction_id, card_id, card_id user_id, merchant_id,
  merchant_category, cast(10000 + user_id as varchar) zip,
  case when user_id % 2 = 0 then 'M' else 'F' end gender,
  case when user_id % 11 = 0 then 'unknown' else strftime(date '1950-01-01'
    + (user_id % 15000)::int, '%Y-%m-%d') end dob,
  amount::double amount, ts_us // 1000000 "timestamp", {r('lat')} location_lat,
  {r('lon')} location_lon, {r('lat + 0.1')} merchant_lat, is_fraud, user_id * 100 city_pop from tx""")
put("encode_messages", TX, """select card_id "key", transaction_id, amount::double amount,
  ts_us // 1000000 "timestamp", cast(10000 + user_id as varchar) zip, is_fraud from tx""")
put("decode_messages", CLEAN, """select case when event_id % 41 > 0 then transaction_id end transaction_id,
  case when event_id % 41 > 0 then card_id end card_id,
  case when event_id % 41 > 0 then amt::double end amount,
  case when event_id % 41 > 0 then secs end "timestamp",
  case when event_id % 41 > 0 then coalesce(merchant_category, 'UNKNOWN') else 'UNKNOWN' end merchant_category,
  case when event_id % 41 > 0 then reason else 'Transaction must be a dictionary' end reject_reason
  from clean""")

# --- validation and cleaning -----------------------------------------------------------------

put("validate_required", CLEAN, "select transaction_id, missing missing_fields from clean")
put("fill_optional", RAW, """select transaction_id, coalesce(merchant_category, 'UNKNOWN') merchant_category,
  '' city, '' state, '' user_id from raw""")
put("cast_types", CLEAN, f"""select transaction_id, (amt is null)::int amount_failed,
  {r('case when abs(lat_d) < 1e6 then lat_d end')} lat,
  {r('case when abs(lon_d) < 1e6 then lon_d end')} lon from clean""")
put("normalize_amount", f"{CLEAN}, {TIES}", """select 'e' || transaction_id id, amt::double amount from clean
  union all select 'o' || transaction_id, least(amount, 10000)::double from ties""")
put("clip_percentile", TIES, """select transaction_id, amount::double amount,
  least(amount, (select quantile_disc(amount, 0.99) from ties))::double amount_clipped from ties""")
put("parse_timestamp", CLEAN, "select transaction_id, secs epoch_seconds from clean")
ARRIVED = f"""{CLEAN}, arrived as (
  select distinct transaction_id, card_id, merchant_id, amt amount, secs * 1000000 ts_us
  from clean where reason is null and event_id % 41 > 0),
{lookback('arrived')}, {since('arrived')}, {ema('arrived')}, {MERCHANTS}, scored0 as (
  select e.transaction_id, e.amount, (least(1, (case when e.amount > 1000 then 0.30 else 0 end)
    + (case when tx_count_10m > 5 then 0.25 else 0 end)
    + (case when e.amount::double / avg0 > 3 then 0.20 else 0 end)
    + (case when risk_score > 0.7 then 0.15 else 0 end)
    + (case when prev_ts is null then 0.10 else 0 end)))::decimal(5,2)::double p
  from ema e join seen using (transaction_id) join since using (transaction_id)
    left join merchants using (merchant_id))"""
put("pipeline_batch", ARRIVED, """select transaction_id, p fraud_probability,
    case when p >= 0.7 then 'HIGH' when p >= 0.3 then 'MEDIUM' else 'LOW' end risk_level,
    case when p >= 0.7 then 'BLOCK' when p >= 0.3 and amount > 5000 then 'REVIEW' else 'APPROVE' end decision,
    null::varchar reject_reason from scored0
  union all select case when event_id % 41 > 0 then transaction_id end, null, null, null,
    case when event_id % 41 > 0 then reason else 'Transaction must be a dictionary' end
  from clean where event_id % 41 = 0 or reason is not null""")
put("validate_ranges", CLEAN, """select transaction_id, amt::double amount, secs "timestamp",
  reason reject_reason from clean""")
put("reject_report", CLEAN, """select coalesce(reason, 'accepted') outcome, count(*) n_rows
  from clean group by 1""")
put("dedup_transactions", CLEAN, """select distinct transaction_id, card_id, amt::double amount,
  secs "timestamp" from clean where reason is null""")

# --- scalar features -----------------------------------------------------------------------------

put("tx_features", TX, f"""select transaction_id, {r('ln(1 + amount::double)')} amount_log,
  (lat is not null)::int has_location, merchant_category from tx""")
put("temporal_features", TX, f"select transaction_id, {TIME_COLUMNS} from tx")
put("age_at_tx", "", """select o_orderkey, case when o_custkey % 13 = 0 then 30 else
  date_diff('day', date '1950-01-01' + (o_custkey % 15000)::int, o_orderdate::date) // 365 end age
  from orders""")
put("haversine", TX, f"""select transaction_id,
  {r(km_or('lat', 'lon', '40.0', '-100.0', 'null'))} km from tx""")
put("category_bucket", TX, """select transaction_id,
  cast('0x' || substr(md5(merchant_category || '-' || merchant_id), 1, 8) as bigint) % 1000 bucket from tx""")
put("json_roundtrip", TX, """select card_id, transaction_id, ts_us // 1000000 score,
  amount::double amount, merchant_id, ts_us // 1000000 "timestamp" from tx where event_id % 17 > 0""")

# --- lookback features -----------------------------------------------------------------------------

SEEN = f"{TX}, {lookback('tx')}"
put("velocity_counts", SEEN, "select transaction_id, tx_count_10m, tx_count_1h, tx_count_24h from seen")
put("velocity_amounts", SEEN, """select transaction_id, total_amount_10m, total_amount_1h,
  total_amount_24h from seen""")
put("unique_merchants_24h", SEEN, "select transaction_id, unique_merchants_24h from seen")
put("unique_merchants_idle", f"{TX}, {idle('tx')}", "select * from idle")
put("time_since_last", f"{TX}, {since('tx')}", "select transaction_id, time_since_last_tx from since")
put("ema_amount", f"{TX}, {ema('tx')}", f"select transaction_id, {r('avg0', 2)} avg_tx_amount_30d from ema")
put("rolling_features", f"{TX}, {ema('tx')}", f"""select transaction_id, amount_deviation,
  amount_vs_avg_ratio from (select transaction_id, {ROLLING} from ema)""")
put(
    "velocity_ties",
    f"{TIES}, {lookback('ties')}, {idle('ties')}, {since('ties')}, {ema('ties')}",
    f"""select transaction_id, tx_count_10m, tx_count_24h, total_amount_24h, unique_merchants_24h,
  unique_merchants_since_idle, time_since_last_tx, {r('avg0', 4)} ema_before
  from seen join idle using (transaction_id) join since using (transaction_id)
  join ema using (transaction_id)""",
)
put(
    "velocity_hot_cards",
    f"{TX}, {lookback('tx')}, {idle('tx')}, {since('tx')}, {ema('tx')}",
    SQL["velocity_ties"][SQL["velocity_ties"].rindex("select transaction_id, tx_count_10m"):],
)
put(
    "velocity_hot_moment",
    f"""{TX}, moment as (select * replace (cast(user_id % 4 as varchar) as card_id,
      ts_us - ts_us % 864000000000 as ts_us) from tx),
    {lookback('moment')}, {idle('moment')}, {since('moment')}, {ema('moment')}""",
    SQL["velocity_ties"][SQL["velocity_ties"].rindex("select transaction_id, tx_count_10m"):],
)
put("realtime_features", FEATURES, f"""select transaction_id, amount, {r('amount_log')} amount_log,
  merchant_category, has_location, tx_count_10m, tx_count_1h, tx_count_24h,
  total_amount_10m, total_amount_1h, total_amount_24h, unique_merchants_24h, time_since_last_tx,
  avg_tx_amount_30d, amount_deviation, amount_vs_avg_ratio, hour_of_day, day_of_week, is_weekend,
  is_night, {r('merchant_risk_score')} merchant_risk_score,
  {r('merchant_fraud_rate')} merchant_fraud_rate, merchant_total_transactions,
  unique_merchants_since_idle from features""")

# --- offline features ----------------------------------------------------------------------------------

put("avg_last7", OFFLINE, f"select transaction_id, {r('avg_amt_7d')} avg_amt_7d from off")
put("running_count", OFFLINE, "select transaction_id, n tx_count_24h from off")
put("running_distinct", OFFLINE, "select transaction_id, uniq::bigint unique_merchants_7d from off")
put("offline_time_true", TX, f"""select a.transaction_id,
  {r('sum(b.amount)::double / count(*)')} avg_amt_7d,
  count(*) filter (b.ts_us >= a.ts_us - 86400000000) tx_count_24h,
  count(distinct b.merchant_id) unique_merchants_7d
  from tx a join tx b on a.card_id = b.card_id and b.ts_us between a.ts_us - 604800000000 and a.ts_us
  group by a.transaction_id""")
SQL["time_true_hot_cards"] = SQL["offline_time_true"]
put("distance_from_home", OFFLINE, f"select transaction_id, {r('km_home')} km from off")
put("distance_from_last", OFFLINE, f"select transaction_id, {r('km_last')} km from off")
put("offline_features", OFFLINE, f"""select user_id cc_num, ts_us event_us, amount::double amt,
  merchant_category category, 10000 + user_id zip, user_id * 100 city_pop, merchant_id merchant,
  case when user_id % 2 = 0 then 'M' else 'F' end gender,
  (case when user_id % 11 = 0 then 30 else date_diff('day', date '1950-01-01'
    + (user_id % 15000)::int, make_timestamp(ts_us)::date) // 365 end)::bigint age,
  {r('avg_amt_7d')} avg_amt_7d, n tx_count_24h, uniq::bigint unique_merchants_7d,
  extract(hour from make_timestamp(ts_us))::bigint hour_of_day,
  (extract(isodow from make_timestamp(ts_us)) - 1)::bigint day_of_week,
  {r('lat::float::double', 2)} lat, {r('lon::float::double', 2)} long,
  {r('(lat + 0.1)::float::double', 2)} merch_lat, {r('(lon + 0.1)::float::double', 2)} merch_long,
  {r('km_home::float::double', 2)} distance_from_home,
  {r('km_last::float::double', 2)} distance_from_last_tx from off""")
SQL["offline_hot_cards"] = SQL["offline_features"]
put("sample_n", OFFLINE, """select transaction_id, card_id, n tx_count_24h from off
  order by md5('42:' || transaction_id), transaction_id limit 5000""")

put("sample_half", "", """select "order", count(*) n from (
  select cast(l_orderkey as varchar) "order" from lineitem
  order by md5('42:' || l_orderkey) limit (select count(*) // 2 from lineitem)) group by 1""")

# --- feature store -----------------------------------------------------------------------------------------

put("feature_view_check", "", """select count(*) n_rows, 0::bigint null_keys, 0::bigint null_event_times,
  0::bigint schema_differences from events""")
ASOF = """hits as (
  select p.event_id, p.user_id, epoch_us(p.ts) us, epoch_us(v.ts) vus, v.value vv, v.event_id vid
  from (select * from events where event_type = 'purchase') p
  asof left join (select * from events where event_type = 'view') v
    on p.user_id = v.user_id and p.ts >= v.ts),
joined as (
  select event_id, user_id, us, case when us - vus <= 86400000000 then vus end feature_time,
    case when us - vus <= 86400000000 then vv end "value",
    case when us - vus <= 86400000000 then vid end view_id from hits)"""
put("asof_join", ASOF, "select * from joined")
SQL["asof_join_hot_keys"] = SQL["asof_join"]
put("asof_join_null_keys", """events as (
  select * replace (case when event_id % 5 = 0 then null else user_id end as user_id) from events), """
    + ASOF, "select * from joined")
put("historical_features", OFFLINE, """select a.transaction_id, b.amount::double amt, b.n tx_count_24h
  from off a left join off b on a.card_id = b.card_id and b.ts_us < a.ts_us
  qualify row_number() over (partition by a.transaction_id
    order by b.ts_us desc, b.transaction_id desc) = 1""")
KEYED = """events as (select * replace (case when event_id % 5 = 0 then null else user_id end as user_id),
  cast(json_extract_string(props, '$.k') as bigint) code from events)"""


def chained(*views: tuple[str, str, int]) -> str:
    """One ASOF join per view, each on what the one before it gave."""
    ctes, before = [KEYED, "v as (select event_id, user_id, code, ts from events where event_type = 'purchase')"], "v"
    for kind, key, seconds in views:
        fresh = f"epoch_us(s.ts) - epoch_us(f.ts) <= {seconds}000000"
        ctes.append(f"""v_{kind} as (select s.*, case when {fresh} then f.value end {kind}__value,
          case when {fresh} then f.event_id end {kind}__row_id from {before} s
          asof left join (select * from events where event_type = '{kind}') f on s.{key} = f.{key} and s.ts >= f.ts)""")
        before = f"v_{kind}"
    return ", ".join(ctes)


for name in ("historical_views", "historical_views_hot_keys"):
    views = chained(("view", "user_id", 86400), ("click", "user_id", 21600), ("signup", "user_id", 2592000),
                    ("error", "code", 172800))
    put(name, views, """select event_id, user_id, code, view__value, click__value, signup__row_id, view__row_id,
      error__value from v_error""")
MATERIAL = "select card_id, ts_us, transaction_id, merchant_id, amount::double amount, n tx_count_24h"
HALF = "(select min(ts_us) + (max(ts_us) - min(ts_us)) // 2 from tx)"
put("materialize", OFFLINE, f"""{MATERIAL} from off where ts_us < {HALF}
  qualify row_number() over (partition by card_id order by ts_us desc, transaction_id desc) = 1""")
for name in ("materialize_incremental", "upsert_card_features"):
    put(name, OFFLINE, f"""{MATERIAL} from off
  qualify row_number() over (partition by card_id order by ts_us desc, transaction_id desc) = 1""")
put("lookup_merchant", f"""{TX}, {MERCHANTS},
asked as (select transaction_id,
  case when event_id % 9 = 0 then 'x' || merchant_id else merchant_id end merchant_id from tx)""",
    f"""select transaction_id,
  {r('coalesce(m.risk_score, 0.5)')} merchant_risk_score,
  {r('coalesce(m.fraud_rate, 0.002)')} merchant_fraud_rate,
  coalesce(m.total_transactions, 100) merchant_total_transactions
  from asked left join merchants m using (merchant_id)""")
CARDS = f"""{FEATURES}, cards as (
  select *, 0.9::double * avg0 + 0.1::double * amount next_avg from features
  qualify row_number() over (partition by card_id order by ts_us desc, transaction_id desc) = 1),
looked as (
  select c_custkey, cast(c_custkey as varchar) card_id,
    coalesce(tx_count_10m + 1, 0) card_tx_count_10m, coalesce(tx_count_1h + 1, 0) card_tx_count_1h,
    coalesce(tx_count_24h + 1, 0) card_tx_count_24h,
    coalesce((select count(distinct t.merchant_id) from tx t
      where t.card_id = k.card_id and t.ts_us >= k.ts_us - 86400000000), 0) card_unique_merchants_24h,
    coalesce(ts_us // 1000000, 0) card_last_tx_timestamp,
    (case when ts_us is null then 1 else 0 end)::bigint card_is_new_card,
    coalesce(total_amount_24h + amount, 0) card_total_amount_24h,
    coalesce(next_avg, 75) card_avg_tx_amount_30d
  from customer c left join cards k on k.card_id = cast(c_custkey as varchar))"""
CARD_COLUMNS = f"""card_id, card_tx_count_10m, card_tx_count_1h, card_tx_count_24h,
  card_unique_merchants_24h, card_last_tx_timestamp, card_is_new_card,
  {r('card_total_amount_24h')} card_total_amount_24h"""
put("lookup_card", CARDS, f"""select {CARD_COLUMNS}, {r('card_avg_tx_amount_30d', 4)} card_avg_tx_amount_30d
  from looked""")
put("lookup_all", CARDS, f"""select {CARD_COLUMNS},
  {r('coalesce(m.risk_score, 0.5)')} merchant_risk_score,
  coalesce(m.total_transactions, 100) merchant_total_transactions
  from looked left join merchants m on m.merchant_id = 'm' || (c_custkey % 120)""")
put("online_features", f"{OFFLINE}, {LATEST}", """select c_custkey cc_num,
  case when fresh then l.amount::double end amt, case when fresh then l.merchant_id end merchant,
  case when fresh then l.n end tx_count_24h, 600.0::double current_amt, 'm1' current_merchant
  from customer left join (select *, epoch_us(timestamp '2024-02-09') - ts_us <= 864000000000 fresh
    from latest) l on l.user_id = c_custkey""")
put("training_set", f"""{TX}, snap as (
  select card_id, count(*) tx_count, sum(amount)::double / count(*) avg_amount,
    max(ts_us) // 1000000 last_tx_timestamp, count(distinct merchant_id) unique_merchants
  from tx group by card_id)""", f"""select transaction_id, card_id, is_fraud, tx_count,
  {r('avg_amount')} avg_amount, last_tx_timestamp, unique_merchants from tx join snap using (card_id)""")
put("request_features", SERVICE, f"""select transaction_id, {r('ratio')} amt_ratio_to_avg,
  high is_high_value, same is_same_merchant, {r('velocity')} velocity_score from service""")

# --- scoring and prediction log ------------------------------------------------------------------------------

put("model_features", SCORED, f"""select transaction_id, {r('amount', 4)} amount, hour_of_day, day_of_week,
  is_weekend::bigint is_weekend,
  cast('0x' || substr(md5(merchant_category), 1, 8) as bigint) % 1000 merchant_category_hash,
  tx_count_10m, tx_count_1h, tx_count_24h, {r('total_amount_10m', 4)} total_amount_10m,
  {r('total_amount_1h', 4)} total_amount_1h, {r('total_amount_24h', 4)} total_amount_24h,
  unique_merchants_24h, {r('avg0', 4)} avg_tx_amount_30d, {r('ratio', 4)} amount_vs_avg_ratio,
  is_new_card::bigint is_new_card, {r('merchant_risk_score', 4)} merchant_risk_score,
  {r('merchant_fraud_rate', 4)} merchant_fraud_rate, since_model time_since_last_tx,
  {r('per_tx', 4)} amount_per_tx_1h from scored""")
MODELLED = f"""{SCORED}, modelled as (
  select *, 1 / (1 + exp(-(0.002::double * amount + 0.3::double * tx_count_10m
    + 0.5::double * is_new_card - 2))) mp from scored)"""
put("model_score", MODELLED, f"""select transaction_id, {r('mp')} model_probability,
  'model' model_probability_source,
  case when round(mp, 6) >= 0.7 then 'HIGH' when round(mp, 6) >= 0.3 then 'MEDIUM' else 'LOW' end risk_level,
  case when round(mp, 6) >= 0.7 then 'BLOCK' when round(mp, 6) >= 0.3 and amount > 5000 then 'REVIEW'
    else 'APPROVE' end decision from modelled""")
put("model_fallback", SCORED, """select transaction_id, fraud_probability model_probability,
  'rules' model_probability_source from scored""")
put("label_predictions", SCORED, """select transaction_id, decision,
  case when transaction_id::bigint % 3 <> 0 then is_fraud end actual_label from scored""")
put("recent_by_card", SCORED, """select transaction_id, card_id, amount, risk_level from scored
  where card_id = '1' order by ts_us desc, transaction_id desc limit 10""")
put("training_leakage", TX, """select count(*) n_rows,
  count(*) filter (ts_us >= (first_day + 1) * 86400000000) n_hits, 0::bigint n_leaks
  from tx join (select merchant_id, min(ts_us // 86400000000) first_day from tx group by 1) using (merchant_id)""")
put("rule_score_a", SCORED, "select transaction_id, fraud_probability from scored")
put("rule_score_b", SERVICE, "select transaction_id, fraud_probability from service_scored")
put("rule_score_c", TX, """select transaction_id,
  (case when amount > 1000 then 0.75 else 0.12 end)::double fraud_probability from tx""")
put("decisions", SCORED, "select transaction_id, risk_level, decision from scored")
put("binary_decision", SERVICE, """select case when fraud_probability > 0.5 then 'BLOCK' else 'APPROVE' end decision,
  count(*) n_transactions, max(fraud_probability) max_score from service_scored group by 1""")
put("score_summary", SCORED, f"""select count(*) n_transactions,
  count(*) filter (decision = 'BLOCK') n_blocked, count(*) filter (decision = 'REVIEW') n_review,
  {r('avg(fraud_probability)')} avg_probability from scored""")
put("store_predictions", SCORED, """select transaction_id, card_id, amount, merchant_id, merchant_category,
  fraud_probability, risk_level, decision, 'v1.0.0' model_version, null::int actual_label,
  ts_us created_us, tx_count_10m from scored""")
put("get_prediction", SCORED, """select transaction_id, card_id, amount, decision, tx_count_10m, is_new_card
  from scored where transaction_id = '77'""")
put("recent_predictions", SCORED, """select transaction_id, card_id, amount, risk_level from scored
  order by ts_us desc, transaction_id desc limit 100""")
put("prediction_stats", SCORED, f"""select 'total' kind, 'all' "value", count(*) n_predictions,
  {r('avg(fraud_probability)')} avg_probability from scored
  union all select 'risk_level', risk_level, count(*), {r('avg(fraud_probability)')} from scored group by 2
  union all select 'decision', decision, count(*), {r('avg(fraud_probability)')} from scored group by 2""")

# --- data quality ---------------------------------------------------------------------------------------------------

put("dq_report", TX + """, bad as (
  select card_id, count(*) members, count(*) filter (event_id % 1000 between 1 and 4 or amount <= 0) issues
  from tx group by card_id),
uniq as (select card_id, count(distinct merchant_id) members from tx group by card_id)""",
    """select 'tx_history' kind, count(*) n_keys, sum(members)::bigint n_members,
  count(*) filter (issues = 0) passed, count(*) filter (issues > 0) failed from bad
union all select 'merchants', count(*), sum(members)::bigint, count(*), 0 from uniq
union all select 'stats', count(*), count(*), count(*) filter (card_id::bigint % 10 not between 3 and 6),
  count(*) filter (card_id::bigint % 10 between 3 and 6) from uniq""")
SANE = [
    "amount", "amount_log", "tx_count_10m", "tx_count_1h", "tx_count_24h",
    "total_amount_10m", "total_amount_1h", "total_amount_24h", "unique_merchants_24h",
    "time_since_last_tx", "avg_tx_amount_30d", "amount_vs_avg_ratio",
    "merchant_total_transactions", "amount_deviation", "hour_of_day", "day_of_week",
    "merchant_risk_score", "merchant_fraud_rate", "has_location", "is_weekend", "is_night",
]


def _sanity(c: str) -> str:
    limits = {
        "hour_of_day": (0, 23), "day_of_week": (0, 6),
        "merchant_risk_score": (0, 1), "merchant_fraud_rate": (0, 1),
    }
    if c in limits:
        wrong = f"{c} not between {limits[c][0]} and {limits[c][1]}"
    elif c in ("has_location", "is_weekend", "is_night"):
        wrong = f"{c} not in (0, 1)"
    elif c == "amount_deviation":
        wrong = "false"
    else:
        wrong = f"{c} < 0"
    return (
        f"select '{c}' feature, count(*) filter ({c} is null) n_null, "
        f"count(*) filter (isnan({c}::double)) n_nan, count(*) filter (isinf({c}::double)) n_infinite, "
        f"count(*) filter ({wrong}) n_out_of_range from features"
    )


put("feature_sanity", FEATURES, " union all ".join(_sanity(c) for c in SANE))
put("parity_report", f"{OFFLINE}, {lookback('tx')}, t as (select a.transaction_id, count(*) c from tx a join tx b on a.card_id = b.card_id and b.ts_us between a.ts_us - 86400000000 and a.ts_us group by 1)",
    """select 'count_true' feature, count(*) n_compared, 0::bigint n_unmatched,
  count(*) filter (c <> tx_count_24h + 1) n_different from t join seen using (transaction_id)
  union all select 'count_coded', count(*), 0, count(*) filter (n <> tx_count_24h + 1)
  from off join seen using (transaction_id)""")
put("leakage_check", ASOF, """select count(*) n_rows, count(feature_time) n_hits,
  count(*) filter (feature_time > us) n_leaks from joined""")
put("run_metrics", CLEAN, f"""select count(*) filter (reason is null) n_processed,
  count(*) filter (reason is not null) n_failed,
  {r('count(*) filter (reason is null) * 100.0::double / count(*)')} success_percent,
  {r('(sum(amt) filter (reason is null))::double / count(*) filter (reason is null)')} avg_amount from clean""")

# --- profiles and monitoring --------------------------------------------------------------------------------------------

put("merchant_risk", f"{TX}, {MERCHANTS}", f"""select merchant_id, total_transactions,
  {r('fraud_rate')} fraud_rate, {r('s / (s + g)')} risk_score from risks""")
put("user_history", f"""{TX}, visits as (select card_id, merchant_id, count(*) n from tx group by 1, 2),
ranked as (select *, row_number() over (partition by card_id order by n desc, merchant_id) k from visits),
fav as (select card_id, string_agg(merchant_id, ',' order by k) favourite_merchants from ranked
  where k <= 3 group by 1)""", f"""select card_id, {r('sum(amount)::double / count(*)')} avg_amount,
  count(*) n_transactions, any_value(favourite_merchants) favourite_merchants
  from tx join fav using (card_id) group by card_id""")
put("geo_patterns", TX, f"""select (floor(lat / 5) * 5)::bigint lat_cell, (floor(lon / 5) * 5)::bigint lon_cell,
  count(*) n_transactions, {r('avg(is_fraud::double)')} fraud_rate from tx group by 1, 2""")
PSI = f"""sides as (select amount::double x, ts_us < {HALF} e from tx),
edges as (select min(x) lo, max(x) hi from sides where e),
bins as (select greatest(0, least(9, floor((x - lo) / ((hi - lo) / 10.0::double)))) bin,
  count(*) filter (e) ne, count(*) filter (not e) na from sides, edges group by 1),
shares as (select greatest(ne / sum(ne) over (), 1e-6) pe, greatest(na / sum(na) over (), 1e-6) pa from bins),
psi as (select sum((pa - pe) * ln(pa / pe)) psi from shares)"""
put("psi", f"{TX}, {PSI}", f"select {r('psi')} psi from psi")
put("confusion_metrics", f"""{SCORED}, c as (
  select count(*) filter (fraud_probability > 0.15 and is_fraud = 1) tp,
    count(*) filter (fraud_probability > 0.15 and is_fraud = 0) fp,
    count(*) filter (fraud_probability <= 0.15 and is_fraud = 1) fn,
    count(*) filter (fraud_probability <= 0.15 and is_fraud = 0) tn from scored)""",
    f"""select tp true_positives, fp false_positives, fn false_negatives, tn true_negatives,
  {r('tp::double / (tp + fp)')} "precision", {r('tp::double / (tp + fn)')} recall,
  {r('fp::double / (fp + tn)')} false_positive_rate from c""")
SQL["log_metrics"] = SQL["confusion_metrics"].replace(
    "tn from scored)", "tn from scored where transaction_id::bigint % 3 <> 0)"
)
put("psi_features", f"""{FEATURES}, sides as (
  select *, ts_us < {HALF} e from features),
long as (unpivot (select e, {', '.join(f'{c}::double {c}' for c in PSI_COLUMNS)} from sides)
  on {', '.join(PSI_COLUMNS)} into name feature value x),
edges as (select feature, min(x) lo, max(x) hi from long where e group by 1),
bins as (select feature, case when hi > lo
    then greatest(0, least(9, floor((x - lo) / ((hi - lo) / 10.0::double)))) else 0 end bin,
  count(*) filter (e) ne, count(*) filter (not e) na from long join edges using (feature) group by 1, 2),
shares as (select feature, greatest(ne / sum(ne) over (partition by feature), 1e-6) pe,
  greatest(na / sum(na) over (partition by feature), 1e-6) pa from bins)""",
    f"select feature, {r('sum((pa - pe) * ln(pa / pe))')} psi from shares group by feature")
put("windowed_metrics", f"""{SCORED}, hours as (
  select ts_us // 3600000000 * 3600000000 window_us,
    count(*) filter (is_fraud = 0 and fraud_probability > 0.15) fp, count(*) filter (is_fraud = 0) neg
  from scored group by 1),
days as (select ts_us // 86400000000 * 86400000000 d, fraud_probability s, sum(is_fraud) pos, count(*) n
  from scored group by 1, 2),
curves as (select d, (sum(pos) over w)::double / sum(n) over w p,
    case when sum(pos) over (partition by d) > 0
      then (sum(pos) over w)::double / sum(pos) over (partition by d) end rc
  from days window w as (partition by d order by s desc)),
daily as (select d window_us, max(p) filter (rc >= 0.95) v from curves group by 1),
both_kinds as (
  select 'false_positive_rate' metric, window_us, case when neg > 0 then fp::double / neg else 0 end v from hours
  union all select 'precision_at_95_recall', window_us, v from daily)""",
    f"""select metric, window_us, {r('v')} "value",
  (case when metric = 'false_positive_rate' then v > 0.05 else v < 0.85 end)::int alert from both_kinds""")
PR = """per as (select fraud_probability s, sum(is_fraud) pos, count(*) n from scored group by 1),
curve as (select s, pos, (sum(pos) over w)::double / sum(n) over w pr,
  (sum(pos) over w)::double / sum(pos) over () rc, pos::double / sum(pos) over () st
  from per window w as (order by s desc)),
auc as (select sum(st * pr) pr_auc, max(pr) filter (rc >= 0.95) p95 from curve)"""
put("pr_auc", f"{SCORED}, {PR}", f"select {r('pr_auc')} pr_auc, {r('p95')} precision_at_95_recall from auc")
for name in ("pr_auc", "windowed_metrics"):
    # the same on the scores of the model: continuous, not rounded
    put(f"{name}_model", MODELLED, SQL[name][len("with ") + len(SCORED) + 2:].replace("fraud_probability", "mp").replace("from scored", "from modelled"))
    SQL[f"{name}_model"] = SQL[f"{name}_model"].replace(f"{MODELLED} ", f"{MODELLED}, ", 1)
put("business_metrics", f"""{SCORED}, per_card as (
  select card_id, max((is_fraud = 0)::int) legit,
    max((is_fraud = 0 and fraud_probability > 0.15)::int) declined from scored group by 1),
money as (select sum(amount::decimal(18,2)) filter (is_fraud = 1 and fraud_probability > 0.15) prevented,
  sum(amount::decimal(18,2)) filter (is_fraud = 1) lost from scored)""",
    f"""select (select {r('sum(declined)::double / sum(legit)')} from per_card) customer_friction_rate,
  prevented::double prevented_loss, lost::double fraud_loss from money""")
put("alerts", f"{SCORED}, {PSI}, {PR}", f"""select {r('psi')} psi, {r('pr_auc')} pr_auc,
  (psi > 0.25)::int drift_alert, (pr_auc < 0.62 * 0.95)::int pr_auc_alert from psi, auc""")
put("class_weight", TX, f"""select count(*) filter (is_fraud = 0) n_negative,
  count(*) filter (is_fraud = 1) n_positive,
  {r('(count(*) filter (is_fraud = 0))::double / count(*) filter (is_fraud = 1)')} positive_weight from tx""")
put("audit_log", SCORED, """select transaction_id, card_id, amount, fraud_probability, risk_level, decision,
  concat_ws(',', case when amount > 1000 then 'high_amount:0.30' end,
    case when tx_count_10m > 5 then 'high_velocity:0.25' end,
    case when ratio > 3 then 'high_ratio:0.20' end,
    case when merchant_risk_score > 0.7 then 'risky_merchant:0.15' end,
    case when is_new_card = 1 then 'new_card:0.10' end) top_rules from scored""")

# --- streams: the same rows as the batch definitions ------------------------------------------

SQL["src_csv_stream"] = SQL["src_csv"]
SQL["stream_clean"] = SQL["validate_ranges"]
SQL["stream_features"] = SQL["realtime_features"]
SQL["archive"] = SQL["sink_parquet"]
put("stream_dedup", TX, "select transaction_id, card_id from tx")
put("stream_late", f"""{TX}, edge as (select min(ts_us) + (max(ts_us) - min(ts_us)) // 2 e from tx)""",
    """select count(*) filter (ts_us >= e) n_emitted, count(*) filter (ts_us < e) n_dropped from tx, edge""")
ON_TIME = f"""{CLEAN}, edge as (select min(ts_us) + (max(ts_us) - min(ts_us)) // 2 e from tx),
single as (select distinct event_id, transaction_id, card_id, merchant_id, amt, secs, reason from clean),
halves as (select single.*, t.ts_us < e early, event_id % 41 = 0 broken
  from single join tx t using (event_id), edge),
kept as (select transaction_id, card_id, merchant_id, amt amount, secs * 1000000 ts_us
  from halves where not early and not broken and reason is null),
{lookback('kept')}"""
put("stream_late_rows", ON_TIME, """select case when not broken then transaction_id end transaction_id,
  case when broken then 'Transaction must be a dictionary' when reason is not null then reason
    when early then 'late' end reject_reason, tx_count_24h
  from halves left join seen using (transaction_id)""")
EXPIRY = f"{TX}, {lookback('tx')}, {idle('tx')}, {since('tx')}, {ema('tx')}"
put("stream_expiry", EXPIRY, f"""select prefix || transaction_id transaction_id, tx_count_24h,
  unique_merchants_since_idle, time_since_last_tx, {r('avg0', 4)} ema_before
  from seen join idle using (transaction_id) join since using (transaction_id)
  join ema using (transaction_id), (values (''), ('again-')) copies(prefix)""")
put("stream_publish", FEATURES, """select card_id, transaction_id, ts_us, tx_count_10m + 1 tx_count_10m,
  tx_count_24h + 1 tx_count_24h,
  (select count(distinct t.merchant_id) from tx t
    where t.card_id = f.card_id and t.ts_us >= f.ts_us - 86400000000) unique_merchants_24h from features f
  qualify row_number() over (partition by card_id order by ts_us desc, transaction_id desc) = 1""")
SQL["stream_pipeline"] = SQL["pipeline_batch"]
put("stream_score", SCORED, "select transaction_id, fraud_probability, risk_level, decision from scored")
put("model_score_trained", "", """select count(*) n_scored, 0::bigint n_different, 0::bigint n_by_rules,
  0::bigint n_out_of_range from events""")
put("psi_daily", f"""{TX}, sides as (select ts_us < {HALF} e, strftime(make_timestamp(ts_us), '%Y-%m-%d') "day",
  amount::double amount, lat::double lat, lon::double lon from tx),
long as (unpivot (select * from sides) on amount, lat, lon into name feature value x),
edges as (select feature, min(x) lo, max(x) hi from long where e group by 1),
binned as (select l.feature, e, "day", greatest(0, least(9,
  case when (hi - lo) / 10 > 0 then floor((x - lo) / ((hi - lo) / 10)) else 0 end)) bin
  from long l join edges using (feature)),
expected as (select feature, bin, count(*) ne, sum(count(*)) over (partition by feature) se
  from binned where e group by 1, 2),
days as (select feature, "day", count(*) n from binned where not e group by 1, 2),
actual as (select feature, "day", bin, count(*) na from binned where not e group by 1, 2, 3),
bins as (select distinct feature, bin from binned),
shares as (select d.feature, d."day", d.n, greatest(coalesce(ne, 0)::double / (select max(se) from expected x
    where x.feature = d.feature), 1e-6) pe, greatest(coalesce(na, 0)::double / d.n, 1e-6) pa
  from days d join bins b using (feature) left join expected using (feature, bin)
  left join actual a on a.feature = d.feature and a."day" = d."day" and a.bin = b.bin)""",
    f"""select feature, "day", n, {r('sum((pa - pe) * ln(pa / pe))')} psi from shares group by 1, 2, 3""")
SQL["stream_run_metrics"] = SQL["run_metrics"].replace("avg_amount from clean", "avg_amount, 3::bigint n_batches from clean")
put("stream_clip", TX, """select strftime(make_timestamp(ts_us), '%Y-%m-%d') "day", count(*) n_rows, 0::bigint n_wrong
  from tx group by 1""")
