"""Aggregations, joins, rolling windows, marts and serving queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.operators import joins, quality, reshape
from tillstream.plans import marts, serving
from tillstream.plans.staging import approved_only
from tillstream.queries.registry import (
    ANOMALIES,
    EVENTS_NOW,
    HISTORY_NOW,
    LIVE,
    SCORED,
    STAGED,
    money_avg,
    money_sum,
    query,
    rounded,
)
from tillstream.queries.rows import staged_anomalies, staged_history
from tillstream.sources.datasets import (
    EVENTS_AS_OF,
    HISTORY_AS_OF,
    live_transactions,
    raw_anomalies,
    table,
)

DAILY = f"""daily as (
  select txn_date, merchant_category, currency, count(*) as txn_count, {money_sum("amount")} as total_revenue,
         {money_avg("amount")} as avg_txn_amount, min(amount) as min_txn_amount, max(amount) as max_txn_amount,
         count(distinct user_id) as unique_users, count(distinct merchant_id) as unique_merchants
  from approved group by 1, 2, 3)"""

DAY_WINDOW = "(partition by merchant_category, currency order by txn_date {frame})"
WEEK = DAY_WINDOW.format(frame="rows between 6 preceding and current row")
MONTH = DAY_WINDOW.format(frame="rows between 29 preceding and current row")
DAY = DAY_WINDOW.format(frame="")
UNITS = "cast(round_even(total_revenue * 100, 0) as bigint)"
ROLLED = f"""rolled as (
  select *, cast(sum({UNITS}) over {WEEK} as double) / 100 as rolling_7d_revenue,
         cast(sum({UNITS}) over {MONTH} as double) / 100 / count(*) over {MONTH} as rolling_30d_avg_revenue,
         lag(total_revenue) over {DAY} as prev_day_revenue
  from daily)"""
GROWTH = f"""case when prev_day_revenue > 0
  then {rounded("(total_revenue - prev_day_revenue) / prev_day_revenue * 100", 2)} end as dod_growth_pct"""

MERCHANTS = f"""merchants as (
  select merchant_id, merchant_category, count(*) as lifetime_txn_count, {money_sum("amount")} as lifetime_revenue,
         {money_avg("amount")} as avg_txn_amount, min(amount) as min_txn_amount, max(amount) as max_txn_amount,
         count(distinct user_id) as unique_customers, count(distinct currency) as currency_count,
         min("timestamp") as first_txn_at, max("timestamp") as last_txn_at
  from approved group by 1, 2)"""

RECENT = f"""recent as (
  select merchant_id, merchant_category, count(*) as recent_txn_count, {money_sum("amount")} as recent_revenue,
         {money_avg("amount")} as recent_avg_amount, count(distinct user_id) as recent_unique_users
  from approved where txn_date >= {HISTORY_NOW} - interval 30 day group by 1, 2)"""

LIFETIME = f"""lifetime as (
  select merchant_id, count(*) as lifetime_txn_count, {money_sum("amount")} as lifetime_revenue
  from approved group by 1)"""

ANOMALY_DAILY = f"""anomaly_daily as (
  select anomaly_date, merchant_category, count(*) as anomaly_count, count(distinct user_id) as affected_users,
         count(distinct merchant_id) as affected_merchants,
         cast(sum(cast(round_even(abs_z_score * 10000, 0) as bigint)) as double) / 10000 / count(abs_z_score) as avg_z_score,
         max(abs_z_score) as max_z_score, {money_sum("amount")} as flagged_amount,
         count(*) filter (where abs_z_score between 3 and 4) as mild_count,
         count(*) filter (where abs_z_score between 4 and 6) as moderate_count,
         count(*) filter (where abs_z_score > 6) as severe_count
  from anomalies group by 1, 2)"""

ANOMALY_WEEK = """avg(anomaly_count) over (partition by merchant_category order by anomaly_date
  rows between 6 preceding and current row) as rolling_7d_avg_anomalies"""


# ---- marts ---------------------------------------------------------------------------------


@query("a1_daily_revenue", f"with {STAGED}, {DAILY} select * from daily")
def _(spark, sf):
    return marts.daily_revenue(approved_only(staged_history(spark, sf)))


@query("fct_daily_revenue", f"with {STAGED}, {DAILY}, {ROLLED} select *, {GROWTH} from rolled")
def fct_daily_revenue(spark, sf):
    return marts.fct_daily_revenue(staged_history(spark, sf))


def _rolled_columns(name: str, *columns: str):
    keys = ["txn_date", "merchant_category", "currency"]
    sql = f"""with {STAGED}, {DAILY}, {ROLLED}, grown as (select *, {GROWTH} from rolled)
              select {", ".join([*keys, *columns])} from grown"""

    @query(name, sql)
    def _(spark, sf):
        return marts.fct_daily_revenue(staged_history(spark, sf)).select(*keys, *columns)


_rolled_columns("w3_rolling_7d", "rolling_7d_revenue")
_rolled_columns("w4_rolling_30d_avg", "rolling_30d_avg_revenue")
_rolled_columns("w5_dod_growth", "prev_day_revenue", "dod_growth_pct")


@query("a2_merchant_stats", f"with {STAGED}, {MERCHANTS} select * from merchants")
def _(spark, sf):
    return marts.merchant_stats(approved_only(staged_history(spark, sf)))


@query("a3_anomaly_counts", f"with {ANOMALIES} select merchant_id, count(*) as anomaly_count from anomalies group by 1")
def _(spark, sf):
    return marts.anomaly_counts(staged_anomalies(spark, sf))


_DIM = f"""with {STAGED}, {MERCHANTS}, {ANOMALIES},
  counts as (select merchant_id, count(*) as anomaly_count from anomalies group by 1)
  select m.*, coalesce(anomaly_count, 0) as anomaly_count,
         case when lifetime_txn_count > 0
              then {rounded("coalesce(anomaly_count, 0) * 100.0 / lifetime_txn_count", 4)} else 0 end as anomaly_rate_pct
  from merchants m left join counts using (merchant_id)"""


@query("dim_merchants", _DIM)
def dim_merchants(spark, sf):
    return marts.dim_merchants(staged_history(spark, sf), staged_anomalies(spark, sf))


@query("j1_left_join", f"select merchant_id, lifetime_txn_count, anomaly_count from ({_DIM})")
def _(spark, sf):
    return dim_merchants(spark, sf).select("merchant_id", "lifetime_txn_count", "anomaly_count")


@query("a5_recent_merchant", f"with {STAGED}, {RECENT} select * from recent")
def _(spark, sf):
    return marts.recent_merchants(approved_only(staged_history(spark, sf)), HISTORY_AS_OF)


@query("a6_lifetime_merchant", f"with {STAGED}, {LIFETIME} select * from lifetime")
def _(spark, sf):
    return marts.lifetime_merchants(approved_only(staged_history(spark, sf)))


_ROLLUP = f"""with {STAGED}, {RECENT}, {LIFETIME}
  select merchant_id, merchant_category, recent_txn_count, recent_revenue,
         {rounded("recent_avg_amount", 2)} as recent_avg_amount, recent_unique_users, lifetime_txn_count,
         lifetime_revenue, case when lifetime_revenue > 0
           then {rounded("recent_revenue / lifetime_revenue * 100", 2)} else 0 end as pct_revenue_last_30d
  from recent join lifetime using (merchant_id)"""


@query("fct_merchant_rollup", _ROLLUP)
def fct_merchant_rollup(spark, sf):
    return marts.fct_merchant_rollup(staged_history(spark, sf), HISTORY_AS_OF)


@query("j2_inner_join", f"select merchant_id, recent_txn_count, lifetime_txn_count from ({_ROLLUP})")
def _(spark, sf):
    return fct_merchant_rollup(spark, sf).select("merchant_id", "recent_txn_count", "lifetime_txn_count")


@query("a4_anomaly_daily", f"with {ANOMALIES}, {ANOMALY_DAILY} select * from anomaly_daily")
def _(spark, sf):
    return marts.anomaly_daily(staged_anomalies(spark, sf))


@query("fct_anomaly_summary", f"with {ANOMALIES}, {ANOMALY_DAILY} select *, {ANOMALY_WEEK} from anomaly_daily")
def fct_anomaly_summary(spark, sf):
    return marts.fct_anomaly_summary(staged_anomalies(spark, sf))


@query(
    "w6_rolling_anomalies",
    f"""with {ANOMALIES}, {ANOMALY_DAILY}
        select anomaly_date, merchant_category, {ANOMALY_WEEK} from anomaly_daily""",
)
def _(spark, sf):
    columns = ["anomaly_date", "merchant_category", "rolling_7d_avg_anomalies"]
    return fct_anomaly_summary(spark, sf).select(*columns)


@query(
    "t5_mart_ordering",
    f"with {STAGED}, {MERCHANTS} select * from merchants order by lifetime_revenue desc, merchant_id",
)
def _(spark, sf):
    """The whole mart in presentation order."""
    stats = marts.merchant_stats(approved_only(staged_history(spark, sf)))
    return stats.orderBy(F.col("lifetime_revenue").desc(), "merchant_id")


# ---- serving -------------------------------------------------------------------------------

_USER = "user_000007"
_USER_ROWS = f"""{LIVE}, mine as (select * from live where user_id = '{_USER}'
  and "timestamp" >= {EVENTS_NOW} - interval 30 day)"""


def _mine(spark, sf):
    return serving.user_rows(live_transactions(spark, sf), _USER, EVENTS_AS_OF)


@query(
    "a11_user_stats",
    f"""with {_USER_ROWS} select count(*) as total_transactions, coalesce({money_sum("amount")}, 0) as total_spend,
               coalesce({rounded(f"{money_sum('amount')} / nullif(count(*), 0)", 2)}, 0) as avg_transaction,
               coalesce(array_to_string(list_sort(list(distinct currency)), ','), '') as currencies from mine""",
)
def _(spark, sf):
    return serving.user_stats(_mine(spark, sf)).withColumn("currencies", F.array_join("currencies", ","))


_CATEGORIES = f"""select merchant_category as category, {money_sum("amount")} as spend, count(*) as count from mine
  group by 1 order by 2 desc, 1 limit 5"""


@query("a12_user_categories", f"with {_USER_ROWS} {_CATEGORIES}")
def _(spark, sf):
    return serving.user_categories(_mine(spark, sf))


@query(
    "t2_recent_user_txns",
    f"""with {_USER_ROWS} select txn_id, "timestamp", amount, status from mine order by "timestamp" desc, txn_id limit 20""",
)
def _(spark, sf):
    return serving.recent_user_transactions(_mine(spark, sf)).select("txn_id", "timestamp", "amount", "status")


@query(
    "a20_facet_user_trends",
    f"""with {LIVE}, mine as (select * from live where "timestamp" >= {EVENTS_NOW} - interval 30 day and "timestamp" <= {EVENTS_NOW}),
          by_category as (select user_id, merchant_category, {money_sum("amount")} as spend, count(*) as n from mine group by 1, 2),
          ranked as (select *, row_number() over (partition by user_id order by spend desc, merchant_category) as place from by_category),
          newest as (select *, row_number() over (partition by user_id order by "timestamp" desc, txn_id) as place from mine)
        select user_id, 30 as period_days, 'stats' as part, 0 as place, string_agg(distinct currency, ',' order by currency) as name,
               count(*) as n, {money_sum("amount")} as amount, {rounded(f"{money_sum('amount')} / count(*)", 2)} as average,
               null as "timestamp", null as details from mine group by 1
        union all select user_id, 30, 'category', place, merchant_category, n, spend, null, null, null from ranked where place <= 5
        union all select user_id, 30, 'recent', place, txn_id, null, amount, null, "timestamp",
               concat_ws('|', currency, merchant_id, merchant_category, payment_method, status, cast(cast(location_lat as int) as varchar),
                         cast(cast(location_lon as int) as varchar)) from newest where place <= 20""",
)
def _(spark, sf):
    """The nested answers for all users, with every field of every part as a row."""
    answers = serving.trends_of_users(live_transactions(spark, sf), EVENTS_AS_OF)
    details = lambda r: F.concat_ws(
        "|", *[r[c] for c in ("currency", "merchant_id", "merchant_category", "payment_method", "status")],
        r["location"]["lat"].cast("int").cast("string"), r["location"]["lon"].cast("int").cast("string"),
    )
    nothing = lambda kind, name: F.lit(None).cast(kind).alias(name)
    stats = answers.select(
        "user_id", "period_days", F.lit("stats").alias("part"), F.lit(0).alias("place"), F.array_join("currencies", ",").alias("name"),
        F.col("total_transactions").alias("n"), F.col("total_spend").alias("amount"), F.col("avg_transaction").alias("average"),
        nothing("timestamp_ntz", "timestamp"), nothing("string", "details"),
    )
    categories = answers.select("user_id", "period_days", F.posexplode("top_categories").alias("place", "c"))
    categories = categories.select(
        "user_id", "period_days", F.lit("category").alias("part"), (F.col("place") + 1).alias("place"), F.col("c.category").alias("name"),
        F.col("c.count").alias("n"), F.col("c.spend").alias("amount"), nothing("double", "average"),
        nothing("timestamp_ntz", "timestamp"), nothing("string", "details"),
    )
    recent = answers.select("user_id", "period_days", F.posexplode("recent_transactions").alias("place", "r"))
    recent = recent.select(
        "user_id", "period_days", F.lit("recent").alias("part"), (F.col("place") + 1).alias("place"), F.col("r.txn_id").alias("name"),
        nothing("bigint", "n"), F.col("r.amount").alias("amount"), nothing("double", "average"),
        F.col("r.timestamp").alias("timestamp"), details(F.col("r")).alias("details"),
    )
    return stats.unionByName(categories).unionByName(recent)


@query(
    "t1_top_merchants",
    f"""with {LIVE} select merchant_id, merchant_category, {money_sum("amount")} as total_revenue,
               count(*) as transaction_count, {rounded(money_avg("amount"), 2)} as avg_transaction
        from live where "timestamp" >= {EVENTS_NOW} - interval 30 day
        group by 1, 2 order by 3 desc, 1, 2 limit 10""",
)
def _(spark, sf):
    return serving.top_merchants(live_transactions(spark, sf), EVENTS_AS_OF)


@query(
    "t1_dashboard_top_merchants",
    f"""with {LIVE} select merchant_id, merchant_category as category, {money_sum("amount")} as revenue,
               count(*) as txn_count
        from live where "timestamp" >= {EVENTS_NOW} - interval 7 day
        group by 1, 2 order by 3 desc, 1, 2 limit 10""",
)
def _(spark, sf):
    return serving.dashboard_top_merchants(live_transactions(spark, sf), EVENTS_AS_OF, days=7)


@query(
    "t3_recent_anomalies",
    f"""with {ANOMALIES} select txn_id, user_id, amount, "timestamp", z_score from anomalies
        where "timestamp" >= {EVENTS_NOW} - interval 7 day order by "timestamp" desc, txn_id limit 50""",
)
def _(spark, sf):
    newest = serving.anomalies(raw_anomalies(spark, sf), EVENTS_AS_OF)
    return newest.select("txn_id", "user_id", "amount", "timestamp", "z_score")


@query(
    "t3_dashboard_recent_anomalies",
    f"""with {ANOMALIES} select "timestamp", txn_id, user_id, amount, currency, merchant_category,
               {rounded("z_score", 2)} as z_score from anomalies
        where "timestamp" >= {EVENTS_NOW} - interval 30 day order by "timestamp" desc, txn_id limit 20""",
)
def _(spark, sf):
    return serving.dashboard_recent_anomalies(raw_anomalies(spark, sf), EVENTS_AS_OF, days=30)


@query(
    "a7_kpis",
    f"""with {ANOMALIES} select count(*) as total_txns, coalesce({money_sum("amount")}, 0) as total_revenue,
               coalesce({rounded(money_avg("amount"), 2)}, 0) as avg_amount,
               (select count(*) from anomalies where "timestamp" >= {EVENTS_NOW} - interval 7 day) as anomaly_count
        from live where "timestamp" >= {EVENTS_NOW} - interval 7 day""",
)
def _(spark, sf):
    return serving.kpis(live_transactions(spark, sf), raw_anomalies(spark, sf), EVENTS_AS_OF, 7)


@query(
    "a8_hourly_volume",
    f"""with {LIVE} select date_trunc('hour', "timestamp") as "timestamp", count(*) as transactions,
               {money_sum("amount")} as revenue
        from live where "timestamp" >= {EVENTS_NOW} - interval 30 day group by 1""",
)
def _(spark, sf):
    return serving.hourly_volume(live_transactions(spark, sf), EVENTS_AS_OF, 30)


@query(
    "a9_category_breakdown",
    f"""with {LIVE} select merchant_category as category, {money_sum("amount")} as spend, count(*) as count
        from live where "timestamp" >= {EVENTS_NOW} - interval 30 day group by 1""",
)
def _(spark, sf):
    return serving.category_breakdown(live_transactions(spark, sf), EVENTS_AS_OF, 30)


@query(
    "a10_status_distribution",
    f"""with {LIVE} select status, count(*) as count
        from live where "timestamp" >= {EVENTS_NOW} - interval 30 day group by 1""",
)
def _(spark, sf):
    return serving.status_distribution(live_transactions(spark, sf), EVENTS_AS_OF, 30)


# ---- operational aggregates ----------------------------------------------------------------

_REPEATED = "select l_orderkey, count(*) as n_rows from lineitem group by 1 having count(*) > 1"


def _repeated(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("timestamp", F.col("l_shipdate"))
    return quality.duplicate_ids(items, HISTORY_AS_OF, hours=24 * 3650, key="l_orderkey")


@query("a13_duplicate_ids", _REPEATED)
def _(spark, sf):
    return _repeated(spark, sf)


@query(
    "a13_duplicate_top",
    f"""with repeated as ({_REPEATED})
        select * from (select 'top' as part, l_orderkey, n_rows from repeated order by n_rows desc, l_orderkey limit 10)
        union all select 'ids', null, count(*) from repeated
        union all select 'surplus rows', null, coalesce(sum(n_rows - 1), 0)::bigint from repeated""",
)
def _(spark, sf):
    """The ten most repeated ids, and the totals over all of them."""
    found = _repeated(spark, sf)
    top = quality.top_duplicates(found, key="l_orderkey").select(F.lit("top").alias("part"), "l_orderkey", "n_rows")
    totals = quality.surplus_rows(found).withColumnsRenamed({"n_ids": "ids", "surplus_rows": "surplus rows"})
    totals = totals.unpivot([], ["ids", "surplus rows"], "part", "n_rows")
    return top.unionAll(totals.select("part", F.lit(None).cast("bigint").alias("l_orderkey"), "n_rows"))


@query(
    "a14_approved_rate",
    f"""with {LIVE} select count(*) as total, count(*) filter (where status = 'approved') as approved,
               count(*) filter (where status not in ('approved', 'declined', 'pending')) as unknown,
               count(*) filter (where status = 'approved') / count(*) as approved_rate, 'pass' as status
        from live where "timestamp" >= {EVENTS_NOW} - interval 720 hour""",
)
def _(spark, sf):
    return quality.status_drift(live_transactions(spark, sf), EVENTS_AS_OF, hours=720)


@query("a15_distinct_values", "select distinct p_brand as value from part")
def _(spark, sf):
    return table(spark, sf, "part").select(F.col("p_brand").alias("value")).distinct()


@query(
    "a16_group_by_first",
    """select o_orderkey % 10 as bucket, o_orderstatus, count(*) as n_orders from orders group by 1, 2""",
)
def _(spark, sf):
    rows = table(spark, sf, "orders").select((F.col("o_orderkey") % 10).alias("bucket"), "o_orderstatus")
    return reshape.group_by_first(rows, 2).agg(F.count("*").alias("n_orders"))


@query(
    "a17_pivot",
    """select o_orderpriority,
              sum(case when o_orderstatus = 'F' then 1 else 0 end)::bigint as "n_F",
              sum(case when o_orderstatus = 'O' then 1 else 0 end)::bigint as "n_O",
              sum(case when o_orderstatus = 'none' then 1 else 0 end)::bigint as n_none,
              count(distinct case when o_orderstatus >= 'O' then o_custkey else -1 end) as customers_from_o,
              max(case when o_orderstatus <> 'P' then o_totalprice else 0 end) as "top_not_P"
       from orders group by 1""",
)
def _(spark, sf):
    """Counts per status, a value that never occurs, and other comparisons and measures."""
    counts = reshape.pivot_columns("o_orderstatus", ["F", "O", "none"], prefix="n_")
    from_o = {"agg": "count", "cmp": ">=", "distinct": True, "quote_identifiers": False}
    customers = reshape.pivot_columns(
        "o_orderstatus", ["O"], prefix="Customers from ", then_value=F.col("o_custkey"), else_value=-1, **from_o
    )
    prices = {"then_value": F.col("o_totalprice"), "else_value": 0.0}
    top = reshape.pivot_columns("o_orderstatus", ["P"], agg="max", cmp="<>", prefix="top_not_", **prices)
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(*counts, *customers, *top)


@query(
    "a18_column_values",
    """select p_type as value, count(*) as n_rows from part where p_size > 10 group by 1
       order by 2 desc, 1 limit 4""",
)
def _(spark, sf):
    return reshape.column_values(table(spark, sf, "part"), "p_type", max_records=4, where="p_size > 10")


@query(
    "a19_single_value",
    "select o_orderkey, o_totalprice from orders where o_totalprice > (select avg(o_totalprice) * 1.5 from orders)",
)
def _(spark, sf):
    """A looked-up value used as a constant in a further query."""
    orders = table(spark, sf, "orders")
    average = reshape.single_value(orders.agg(F.avg("o_totalprice")), default=0.0)
    return orders.where(F.col("o_totalprice") > average * 1.5).select("o_orderkey", "o_totalprice")


@query("a19_results_as_dict", "select o_orderpriority, count(*) as n_orders from orders group by 1")
def _(spark, sf):
    """All looked-up values, used as a filter."""
    orders = table(spark, sf, "orders")
    found = reshape.results_as_dict(reshape.column_values(orders, "o_orderpriority"))
    kept = orders.where(F.col("o_orderpriority").isin(*found["value"]))
    return kept.groupBy("o_orderpriority").agg(F.count("*").alias("n_orders"))


# ---- joins ---------------------------------------------------------------------------------


@query(
    "j3_orphans",
    f"""with {SCORED} select txn_id from scored
        where is_anomaly and txn_id not in (select txn_id from live where status <> 'declined')""",
)
def _(spark, sf):
    """Anomalies whose transaction is not among the ones kept."""
    kept = live_transactions(spark, sf).where("status <> 'declined'")
    return joins.orphans(raw_anomalies(spark, sf).select("txn_id"), kept, "txn_id")


@query(
    "j4_anti_with_conditions",
    """select l_partkey as id, count(*) as n_rows from lineitem
       where l_quantity > 25 and l_partkey not in (select p_partkey from part where p_size <= 40) group by 1""",
)
def _(spark, sf):
    items, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    return joins.unmatched_keys(items, part, "l_partkey", "p_partkey", "l_quantity > 25", "p_size <= 40")


@query(
    "j5_full_outer_counts",
    """select coalesce(a.k, b.k) as nation, count_a, count_b
       from (select c_nationkey as k, count(*) as count_a from customer where c_nationkey < 20 group by 1) a
       full join (select s_nationkey as k, count(*) as count_b from supplier where s_nationkey > 3 group by 1) b
         on a.k = b.k""",
)
def _(spark, sf):
    customers = table(spark, sf, "customer").where("c_nationkey < 20").select(F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, sf, "supplier").where("s_nationkey > 3").select(F.col("s_nationkey").alias("nation"))
    return joins.group_counts(customers, suppliers, ["nation"])
