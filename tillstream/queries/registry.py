"""Query registry and the SQL fragments the counterparts share."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillstream.schemas import CURRENCIES, MERCHANT_CATEGORIES, PAYMENT_METHODS, STATUSES
from tillstream.session import apply_settings
from tillstream.sources.datasets import EVENTS_AS_OF, HISTORY_AS_OF

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without `sql` only its rows are checked."""

    def register(build):
        @functools.wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(apply_settings(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register


# ---- SQL fragments -------------------------------------------------------------------------


def pick(values: list[str], position: str) -> str:
    cases = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"(case ({position}) % {len(values)} {cases} end)"


def padded(prefix: str, number: str, digits: int) -> str:
    text = f"cast({number} as varchar)"
    return f"('{prefix}' || lpad({text}, cast(greatest({digits}, length({text})) as int), '0'))"


def cents(x: str) -> str:
    return f"cast(round_even(({x}) * 100, 0) as bigint)"


def money_sum(x: str) -> str:
    return f"(cast(sum({cents(x)}) as double) / 100)"


def money_avg(x: str) -> str:
    return f"({money_sum(x)} / nullif(count({x}), 0))"


def rounded(x: str, places: int) -> str:
    return f"round(cast({x} as double), {places})"


def steady(x: str, places: int) -> str:
    scale = 10**places
    return f"(sign({x}) * floor(abs({x}) * {scale} + cast(0.5 + 1e-7 as double)) / {scale})"


K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"

#: live transactions
LIVE = f"""live as (
  select substr(sha256(user_id || '|' || epoch_us(ts) || '|' || {cents("value")} || '|' || event_id), 1, 24) as txn_id,
         {padded("user_", "user_id", 6)} as user_id,
         value as amount,
         {pick(CURRENCIES, "event_id // 5")} as currency,
         ts as "timestamp",
         {padded("merchant_", K, 4)} as merchant_id,
         {pick(MERCHANT_CATEGORIES, K)} as merchant_category,
         {pick(PAYMENT_METHODS, "event_id")} as payment_method,
         case when event_id % 20 < 18 then '{STATUSES[0]}' when event_id % 20 = 18 then '{STATUSES[1]}'
              else '{STATUSES[2]}' end as status,
         cast(({K} * 7) % 181 - 90 as double) as location_lat,
         cast(({K} * 13) % 361 - 180 as double) as location_lon
  from events)"""

#: live transactions with running statistics per user
SCORED = f"""{LIVE}, moments as (
  select *, count(*) over w as n, avg(amount) over w as mean, stddev_samp(amount) over w as sd
  from live
  window w as (partition by user_id order by "timestamp", txn_id rows between unbounded preceding and current row)
), scored as (
  select * exclude (n, mean, sd), n as user_txn_count, {steady("mean", 2)} as user_running_mean,
         {steady("(case when sd > 0 then (amount - mean) / sd else 0 end)", 4)} as z_score,
         coalesce(abs(case when sd > 0 then (amount - mean) / sd else 0 end) > 3, false) as is_anomaly
  from moments)"""

#: staged anomalies
ANOMALIES = f"""{SCORED}, anomalies as (
  select txn_id, user_id, amount, currency, "timestamp", merchant_id, merchant_category, payment_method,
         z_score, user_running_mean, cast(user_txn_count as int) as user_txn_count,
         date_trunc('day', "timestamp") as anomaly_date, abs(z_score) as abs_z_score
  from scored where is_anomaly)"""

#: stored transactions with repeated ids
HISTORY = f"""history as (
  select l_orderkey || '-' || l_linenumber as txn_id,
         {padded("user_", "l_partkey", 6)} as user_id,
         l_extendedprice as amount,
         {pick(CURRENCIES, "l_linenumber")} as currency,
         l_shipdate + to_seconds((l_partkey * 37 + l_suppkey * 11) % 86400) as "timestamp",
         {padded("merchant_", "l_suppkey", 4)} as merchant_id,
         {pick(MERCHANT_CATEGORIES, "l_suppkey")} as merchant_category,
         {pick(PAYMENT_METHODS, "cast(l_quantity as int)")} as payment_method,
         case when l_returnflag <> 'R' then '{STATUSES[0]}' when l_linestatus = 'F' then '{STATUSES[1]}'
              else '{STATUSES[2]}' end as status,
         l_discount * 100 as location_lat,
         l_tax * 100 as location_lon,
         cast(l_quantity as bigint) as user_txn_count,
         l_extendedprice / l_quantity as user_running_mean,
         l_discount * 100 - 5 as z_score,
         l_tax > 0.07 as is_anomaly
  from lineitem)"""

#: staged transactions
STAGED = f"""{HISTORY}, staged as (
  select txn_id, user_id, amount, currency, "timestamp", merchant_id, merchant_category, payment_method, status,
         location_lat, location_lon, cast(user_txn_count as int) as user_txn_count, user_running_mean, z_score,
         is_anomaly, date_trunc('day', "timestamp") as txn_date, date_trunc('hour', "timestamp") as txn_hour,
         cast(extract(dow from "timestamp") as int) as day_of_week,
         cast(extract(hour from "timestamp") as int) as hour_of_day
  from history
  qualify row_number() over (partition by txn_id order by "timestamp" desc, amount desc, user_id desc,
    merchant_id desc, payment_method desc, location_lat desc, location_lon desc, status desc) = 1
), approved as (select * from staged where status = 'approved')"""

EVENTS_NOW = f"timestamp '{EVENTS_AS_OF}'"
HISTORY_NOW = f"timestamp '{HISTORY_AS_OF}'"
