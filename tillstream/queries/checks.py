"""Data checks over whole tables; each query returns the failing rows, or counts of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.operators import checks, quality
from tillstream.plans import build
from tillstream.queries.aggregates import (
    ANOMALY_DAILY,
    DAILY,
    LIFETIME,
    MERCHANTS,
    RECENT,
)
from tillstream.queries.registry import (
    ANOMALIES,
    EVENTS_NOW,
    HISTORY_NOW,
    LIVE,
    STAGED,
    query,
)
from tillstream.schemas import STATUSES
from tillstream.session import scratch_path
from tillstream.sources.datasets import (
    EVENTS_AS_OF,
    HISTORY_AS_OF,
    HISTORY_TIEBREAK,
    live_transactions,
    raw_anomalies,
    raw_history,
    table,
)


# ---- rules ---------------------------------------------------------------------------------


@query(
    "q1_unique",
    "select l_orderkey as unique_field, count(*) as n_records from lineitem group by 1 having count(*) > 1",
)
def _(spark, sf):
    return checks.unique(table(spark, sf, "lineitem"), "l_orderkey")


@query("q2_not_null", "select o_orderkey from orders where nullif(o_orderstatus, 'P') is null")
def _(spark, sf):
    status = F.nullif("o_orderstatus", F.lit("P")).alias("status")
    return checks.not_null(table(spark, sf, "orders").select("o_orderkey", status), "status").select("o_orderkey")


@query(
    "q3_accepted_values",
    """select event_type as value_field, count(*) as n_records from events
       where event_type not in ('click', 'view', 'purchase') group by 1""",
)
def _(spark, sf):
    return checks.accepted_values(table(spark, sf, "events"), "event_type", ["click", "view", "purchase"])


@query(
    "q4_accepted_range",
    "select l_orderkey, l_linenumber, l_quantity from lineitem where not (l_quantity >= 3 and l_quantity <= 48)",
)
def _(spark, sf):
    bad = checks.accepted_range(table(spark, sf, "lineitem"), "l_quantity", 3, 48)
    return bad.select("l_orderkey", "l_linenumber", "l_quantity")


@query("q4_accepted_range_exclusive", "select event_id from events where not (value > 0.02 and value < 300)")
def _(spark, sf):
    return checks.accepted_range(table(spark, sf, "events"), "value", 0.02, 300, inclusive=False).select("event_id")


@query(
    "q5_at_least_one",
    """select c_nationkey, c_mktsegment, count(rich) as n_values
       from (select *, case when c_acctbal > 9000 then c_custkey end as rich from customer)
       group by 1, 2 having count(rich) = 0""",
)
def _(spark, sf):
    rich = F.when(F.col("c_acctbal") > 9000, F.col("c_custkey"))
    rows = table(spark, sf, "customer").withColumn("rich", rich)
    return checks.at_least_one(rows, "rich", ["c_nationkey", "c_mktsegment"])


@query(
    "q6_cardinality_equality",
    """with a as (select c_nationkey as value, count(*) as num_rows from customer group by 1),
            b as (select s_nationkey as value, count(*) as num_rows from supplier group by 1)
       select 'a_minus_b' as which_diff, * from (select * from a except select * from b)
       union all select 'b_minus_a', * from (select * from b except select * from a)""",
)
def _(spark, sf):
    customer, supplier = table(spark, sf, "customer"), table(spark, sf, "supplier")
    return checks.cardinality_equality(customer, "c_nationkey", supplier, "s_nationkey")


_COUNTS = """(select l_returnflag as flag, count(*) as count_a from lineitem where l_quantity > 10 group by 1) a
  full join (select l_returnflag as flag, count(*) as count_b from lineitem where l_quantity > 10 and l_returnflag <> 'R'
             and l_discount < 0.05 group by 1) b using (flag)"""


def _two_sides(spark, sf):
    a = table(spark, sf, "lineitem").where("l_quantity > 10").withColumnRenamed("l_returnflag", "flag")
    return a, a.where("flag <> 'R' and l_discount < 0.05")


@query(
    "q7_equal_rowcount",
    f"select flag, count_a, count_b, abs(count_a - count_b) as diff_count from {_COUNTS} where abs(count_a - count_b) > 0",
)
def _(spark, sf):
    return checks.equal_rowcount(*_two_sides(spark, sf), ["flag"])


@query(
    "q7_equal_rowcount_strict",
    f"""select flag, count_a, count_b, coalesce(abs(count_a - count_b), count_a, count_b) as diff_count from {_COUNTS}
        where coalesce(abs(count_a - count_b), count_a, count_b) > 0""",
)
def _(spark, sf):
    return checks.equal_rowcount(*_two_sides(spark, sf), ["flag"], strict=True)


_PRICES = "select o_custkey, o_orderstatus, round(cast(o_totalprice {f} as decimal(38,12)), 0) as price from orders"


@query(
    "q8_equality",
    f"""with a as ({_PRICES.format(f="")}), b as ({_PRICES.format(f="* 1.000001")})
        select 'a_minus_b' as which_diff, o_custkey, o_orderstatus, cast(price as double) as price
        from (select * from a except select * from b)
        union all select 'b_minus_a', o_custkey, o_orderstatus, cast(price as double)
        from (select * from b except select * from a)""",
)
def _(spark, sf):
    """Orders against slightly shifted prices, compared after rounding."""
    a = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", F.col("o_totalprice").alias("price"), "o_orderkey")
    b = a.withColumn("price", F.col("price") * 1.000001)
    found = checks.equality(a, b, exclude_columns=["O_ORDERKEY"], precision=0)
    return found.withColumn("price", F.col("price").cast("double"))


@query("q9_expression_is_true", "select p_partkey from part where not (p_size + 3 < p_retailprice / 25)")
def _(spark, sf):
    bad = checks.expression_is_true(table(spark, sf, "part"), "+ 3 < p_retailprice / 25", column="p_size")
    return bad.select("p_partkey")


@query(
    "q10_fewer_rows_than",
    """select k, count_a, count_b, case when count_a > count_b then count_a - count_b else 1 end as row_count_delta
       from (select c_nationkey as k, count(*) as count_a from customer where c_acctbal < 900 group by 1)
       join (select s_nationkey as k, count(*) as count_b from supplier group by 1) using (k)
       where count_a >= count_b""",
)
def _(spark, sf):
    few = table(spark, sf, "customer").where("c_acctbal < 900").select(F.col("c_nationkey").alias("k"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"))
    return checks.fewer_rows_than(few, suppliers, ["k"])


@query(
    "q11_not_accepted_values",
    "select distinct p_type as value_field from part where p_type in ('SMALL', 'ECONOMY', 'UNKNOWN')",
)
def _(spark, sf):
    return checks.not_accepted_values(table(spark, sf, "part"), "p_type", ["SMALL", "ECONOMY", "UNKNOWN"])


@query(
    "q12_not_constant",
    "select o_custkey, 1 as n_values from orders group by 1 having count(distinct o_orderstatus) = 1",
)
def _(spark, sf):
    return checks.not_constant(table(spark, sf, "orders"), "o_orderstatus", ["o_custkey"])


@query(
    "q13_not_empty_string",
    "select event_id from events where event_type in ('error', 'signup')",
)
def _(spark, sf):
    text = F.when(F.col("event_type") == "error", "").when(F.col("event_type") == "signup", "  ").otherwise("x")
    rows = table(spark, sf, "events").select("event_id", text.alias("note"))
    return checks.not_empty_string(rows, "note").select("event_id")


_RANGES = """with ranges as (select o_custkey as owner, o_orderkey % 97 as lo,
    case when o_orderstatus = 'P' then null else o_orderkey % 97 + o_orderkey % 7 end as hi, o_orderkey from orders),
  neighbours as (select *, lead(lo) over w as next_lo from ranges
    window w as ({partition} order by lo, hi nulls last, o_orderkey))
  select {key} lo as lower_bound, hi as upper_bound, next_lo as next_lower_bound, count(*) as n_rows from neighbours
  where not (coalesce({proper}, false) and coalesce({apart}, next_lo is null)) group by all"""


def _ranges(spark, sf):
    low = F.col("o_orderkey") % 97
    high = F.when(F.col("o_orderstatus") != "P", low + F.col("o_orderkey") % 7)
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("owner"), low.alias("lo"), high.alias("hi"))


@query(
    "q14_mutually_exclusive_ranges",
    _RANGES.format(partition="partition by owner", key="owner,", proper="lo < hi", apart="hi <= next_lo"),
)
def _(spark, sf):
    return checks.mutually_exclusive_ranges(_ranges(spark, sf), "lo", "hi", ["owner"])


@query(
    "q14_mutually_exclusive_ranges_sliced",
    _RANGES.format(partition="", key="", proper="lo <= hi", apart="hi = next_lo"),
)
def _(spark, sf):
    """Without a partition: the order of the whole table."""
    rows = _ranges(spark, sf)
    return checks.mutually_exclusive_ranges(
        rows, "lo", "hi", gaps="not_allowed", zero_length_range_allowed=True, slices=16
    )


@query(
    "q15_not_null_proportion",
    f"""select o_custkey, count(nullif(o_orderstatus, 'P')) / count(*) as not_null_proportion from orders
        group by 1 having count(nullif(o_orderstatus, 'P')) / count(*) < 0.4
          or count(nullif(o_orderstatus, 'P')) / count(*) > 0.9""",
)
def _(spark, sf):
    rows = table(spark, sf, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return checks.not_null_proportion(rows, "status", 0.4, 0.9, ["o_custkey"])


@query(
    "q16_recency",
    f"""select user_id, max(ts) as most_recent, {EVENTS_NOW} - interval 12 hour as threshold from events
        group by 1 having max(ts) < {EVENTS_NOW} - interval 12 hour""",
)
def _(spark, sf):
    return checks.recency(table(spark, sf, "events"), "ts", "hour", 12, EVENTS_AS_OF, group_by=["user_id"])


@query(
    "q16_recency_dates",
    f"""select l_suppkey, cast(max(l_shipdate) as date) as most_recent,
               cast({HISTORY_NOW} - interval 7 day as date) as threshold from lineitem
        group by 1 having cast(max(l_shipdate) as date) < cast({HISTORY_NOW} - interval 7 day as date)""",
)
def _(spark, sf):
    items = table(spark, sf, "lineitem")
    return checks.recency(items, "l_shipdate", "day", 7, HISTORY_AS_OF, True, ["l_suppkey"])


@query(
    "q17_relationships_where",
    """select o_custkey as id, count(*) as n_rows from orders where o_totalprice > 100000
         and o_custkey not in (select c_custkey from customer where c_acctbal >= 0) group by 1""",
)
def _(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    return checks.relationships_where(
        orders, "o_custkey", customer, "c_custkey", "o_totalprice > 100000", "c_acctbal >= 0"
    )


@query(
    "q18_sequential_values",
    """select l_orderkey, l_linenumber, previous as previous_l_linenumber, count(*) as n_rows from
         (select l_orderkey, l_linenumber,
                 lag(l_linenumber) over (partition by l_orderkey order by l_linenumber) as previous from lineitem)
       where not (l_linenumber = previous + 1) group by 1, 2, 3""",
)
def _(spark, sf):
    return checks.sequential_values(table(spark, sf, "lineitem"), "l_linenumber", group_by=["l_orderkey"])


@query(
    "q18_sequential_values_sliced",
    """select hour, previous as previous_hour, count(*) as n_rows from
         (select hour, lag(hour) over (order by hour) as previous
          from (select date_trunc('hour', ts) as hour from events))
       where not (hour = previous + interval 1 hour) group by 1, 2""",
)
def _(spark, sf):
    """By hour and without groups: the order of the whole table."""
    hours = table(spark, sf, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
    return checks.sequential_values(hours, "hour", datepart="hour", slices=16)


@query(
    "q19_unique_combination",
    "select l_orderkey, l_linenumber, count(*) as n_records from lineitem group by 1, 2 having count(*) > 1",
)
def _(spark, sf):
    return checks.unique_combination(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "q20_check_results",
    """select 'lineitem_quantity' as check_name, count(*) as failures, 'fail' as status from lineitem where l_quantity > 45
       union all select 'rare_discount', count(*), case when count(*) > 1000000000 then 'fail'
         when count(*) > 0 then 'warn' else 'pass' end from lineitem where l_discount > 0.09
       union all select 'grouped_relationships', count(*), case when count(*) > 10 then 'fail' else 'pass' end
         from lineitem where l_suppkey not in (select s_suppkey from supplier where s_acctbal > 0)
       union all select 'big_orders_only', count(*), case when count(*) = 0 then 'pass' else 'fail' end
         from orders where o_totalprice > 400000 and o_totalprice <= 400000
       union all select 'order_sets', n, case when n = 0 then 'pass' else 'fail' end from (
         select (a + b + abs(a - b))::bigint as n from (select
           (select count(*) from (select o_custkey from orders except select c_custkey from customer where c_acctbal > 0)) as a,
           (select count(*) from (select c_custkey from customer where c_acctbal > 0 except select o_custkey from orders)) as b))""",
)
def _(spark, sf):
    """Thresholds, a pre-filter and a custom fail value."""
    items, orders, customer, supplier = (table(spark, sf, n) for n in ("lineitem", "orders", "customer", "supplier"))
    big = checks.filtered(orders, "o_totalprice > 400000")
    a = orders.select(F.col("o_custkey").alias("key"))
    b = customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("key"))
    return checks.run_checks(
        [
            checks.Check(
                "grouped_relationships",
                checks.relationships_where(items, "l_suppkey", supplier, "s_suppkey", to_condition="s_acctbal > 0"),
                error_if="> 10",
            ),
            checks.Check("lineitem_quantity", checks.accepted_range(items, "l_quantity", max_value=45)),
            checks.Check(
                "rare_discount",
                checks.expression_is_true(items, "l_discount <= 0.09"),
                warn_if="> 0",
                error_if="> 1000000000",
            ),
            checks.Check("big_orders_only", checks.expression_is_true(big, "o_totalprice > 400000")),
            checks.Check("order_sets", checks.equality(a, b), checks.equality_failures()),
        ]
    )


@query(
    "q22_assert_equal",
    "select o_orderkey from orders where o_orderkey % 100 <> o_custkey % 100",
)
def _(spark, sf):
    ends = {"a": F.col("o_orderkey") % 100, "b": F.col("o_custkey") % 100}
    return checks.assert_equal(table(spark, sf, "orders").withColumns(ends), "a", "b").select("o_orderkey")


@query(
    "q23_columns_match_set",
    """select c.column_name as relation_column, i.name as input_column
       from (select upper(column_name) as column_name from (describe orders)) c
       full join (select unnest(['O_ORDERKEY', 'O_CUSTKEY', 'O_CLERK', 'O_COMMENT']) as name) i on c.column_name = i.name
       where c.column_name is null or i.name is null""",
)
def _(spark, sf):
    wanted = ["o_orderkey", "O_CUSTKEY", "o_clerk", "o_comment"]
    return checks.columns_match_set(table(spark, sf, "orders"), wanted)


# ---- declared tests of the models ----------------------------------------------------------


_MODEL_TABLES = {
    "stg_transactions": "staged",
    "stg_anomalies": "anomalies",
    "fct_daily_revenue": "daily",
    "dim_merchants": "merchants",
    "fct_merchant_rollup": "(select * from recent join lifetime using (merchant_id))",
    "fct_anomaly_summary": "anomaly_daily",
}


def _model_checks_sql() -> str:
    failures = {"accepted_values_stg_transactions_status": "(select status from staged where status not in "
                f"{tuple(STATUSES)} group by 1)"}
    for model, columns in build.NOT_NULL.items():
        for c in columns:
            failures[f"not_null_{model}_{c}"] = f'(select 1 from {_MODEL_TABLES[model]} where "{c}" is null)'
    for model, c in build.UNIQUE.items():
        failures[f"unique_{model}_{c}"] = (
            f"(select {c} from {_MODEL_TABLES[model]} where {c} is not null group by 1 having count(*) > 1)"
        )
    parts = " union all ".join(f"select '{n}' as check_name, count(*) as failures from {t}" for n, t in failures.items())
    return f"""with {STAGED}, {DAILY}, {MERCHANTS}, {RECENT}, {LIFETIME}, {ANOMALIES}, {ANOMALY_DAILY}
        select check_name, failures, case when failures = 0 then 'pass' else 'fail' end as status from ({parts})"""


@query("model_checks", _model_checks_sql())
def model_checks(spark, sf):
    """The daily batch, then the 24 tests declared for its models."""
    raw = raw_history(spark, sf), raw_anomalies(spark, sf)
    models = build.build_models(*raw, scratch_path(spark, "models"), HISTORY_AS_OF, HISTORY_TIEBREAK)
    return build.check_models(models)


# ---- hourly checks -------------------------------------------------------------------------

_HOUR = f"""with {LIVE}, recent as (select * from live where "timestamp" >= {EVENTS_NOW} - interval {{n}} hour)"""
_LAST = _HOUR.format(n=24)


@query(
    "d1_schema_violations",
    f"""{_HOUR.format(n=1)} select violation, count(*) as n_rows from (
          select unnest([case when currency = 'USD' then 'currency: value' end,
                         case when payment_method in ('credit_card', 'apple_pay') then 'user_id: pattern' end,
                         case when amount < 20 then 'amount: below minimum' end,
                         case when not regexp_matches(merchant_id, '^merchant_[0-9]{{4}}$') then 'merchant_id: pattern' end]) as violation
          from recent) where violation is not null group by 1""",
)
def _(spark, sf):
    """Rows that break three rules: a currency nobody knows, users without their prefix, negative amounts."""
    rows = live_transactions(spark, sf).withColumns(
        {
            "currency": F.when(F.col("currency") == "USD", "XXX").otherwise(F.col("currency")),
            "user_id": F.when(F.col("payment_method").isin("credit_card", "apple_pay"), F.substring("user_id", 6, 9)).otherwise(F.col("user_id")),
            "amount": F.when(F.col("amount") < 20, -F.col("amount")).otherwise(F.col("amount")),
        }
    )
    return quality.schema_violations(rows, EVENTS_AS_OF)


@query(
    "d2_volume",
    f"""{_LAST}, counts as (select count(*) filter (where "timestamp" >= {EVENTS_NOW} - interval 1 hour) as last_hour,
          count(*) as last_day from recent), ratios as (select *, last_hour / nullif(last_day / 24.0::double, 0) as ratio from counts)
        select *, case when ratio is null then 'skip' when ratio > 3 then 'spike' when ratio < 1 / 3.0::double then 'drop'
          else 'pass' end as status from ratios""",
)
def _(spark, sf):
    return quality.volume(live_transactions(spark, sf), EVENTS_AS_OF)


@query(
    "d3_null_fields",
    f"""{_HOUR.format(n=1)} select field, n_rows from (
          select 'status' as field, count(*) filter (where status = 'pending') as n_rows from recent
          union all select 'currency', count(*) filter (where currency = 'GBP') from recent) where n_rows > 0""",
)
def _(spark, sf):
    """Pending statuses read as empty and one currency as missing."""
    live = live_transactions(spark, sf).withColumns(
        {
            "status": F.when(F.col("status") == "pending", "").otherwise(F.col("status")),
            "currency": F.nullif("currency", F.lit("GBP")),
        }
    )
    return quality.null_fields(live, EVENTS_AS_OF)


@query(
    "d4_status_drift",
    f"""{_HOUR.format(n=6)}, counts as (select count(*) as total, count(*) filter (where status = 'approved') as approved,
          count(*) filter (where status not in ('approved', 'declined', 'pending')) as unknown from recent),
        rates as (select *, approved / nullif(total, 0) as approved_rate from counts)
        select *, case when total = 0 then 'skip' when unknown > 0 then 'invalid_status'
          when approved_rate < 0.8 or approved_rate > 0.96 then 'drift' else 'pass' end as status from rates""",
)
def _(spark, sf):
    return quality.status_drift(live_transactions(spark, sf), EVENTS_AS_OF)


@query(
    "d5_staleness",
    f"""select count(*) as fresh_rows, case when count(*) > 0 then 'pass' else 'stale' end as status
        from events where ts >= {EVENTS_NOW} - interval 15 minute""",
)
def _(spark, sf):
    return quality.staleness(live_transactions(spark, sf), EVENTS_AS_OF)


@query(
    "d6_duplicates",
    f"""with {LIVE}, seen as (select txn_id, status, merchant_category from live where "timestamp" >= {EVENTS_NOW} - interval 24 hour),
        times as (select txn_id, 1 + (status <> 'approved')::int + 2 * (merchant_category in ('grocery', 'travel'))::int as n from seen)
        select count(*) as n_ids, coalesce(sum(n - 1), 0)::bigint as surplus_rows from times where n > 1""",
)
def _(spark, sf):
    """The last day with some transactions sent twice, three or four times."""
    live = live_transactions(spark, sf)
    trips = live.where(F.col("merchant_category").isin("grocery", "travel"))
    sent = live.unionAll(live.where("status <> 'approved'")).unionAll(trips).unionAll(trips)
    return quality.surplus_rows(quality.duplicate_ids(sent, EVENTS_AS_OF, 24))


@query(
    "d7_amount_outliers",
    f"""{_HOUR.format(n=1)} select count(*) filter (where amount <= 0) as not_positive,
          count(*) filter (where amount > 40) as over_max, count(*) filter (where amount > 0 and amount < 5) as under_min
        from recent""",
)
def _(spark, sf):
    return quality.amount_outliers(live_transactions(spark, sf), EVENTS_AS_OF, limits=(5.0, 40.0))


@query(
    "d8_accepted_values",
    f"""{_HOUR.format(n=24)} select 'currency' as field, nullif(currency, 'GBP') as value, count(*) as n_rows from recent
          where currency = 'GBP' group by 1, 2
        union all select 'status', status, count(*) from recent where status = 'pending' group by 1, 2""",
)
def _(spark, sf):
    """A NULL currency and a status outside the set."""
    live = live_transactions(spark, sf).withColumn("currency", F.nullif("currency", F.lit("GBP")))
    accepted = {"currency": ["CAD", "USD", "EUR", "GBP"], "status": ["approved", "declined"]}
    return quality.unexpected_values(live, EVENTS_AS_OF, accepted, hours=24)


_REPORT = f"""{_LAST}, hour as (select * from recent where "timestamp" >= {EVENTS_NOW} - interval 1 hour),
  six as (select * from recent where "timestamp" >= {EVENTS_NOW} - interval 6 hour),
  n as (select (select count(*) from recent) as day, (select count(*) from hour) as hour, (select count(*) from six) as six,
    (select count(*) from recent where "timestamp" >= {EVENTS_NOW} - interval 15 minute) as fresh,
    (select count(*) from six where status = 'approved') as approved,
    (select coalesce(sum(c - 1), 0)::bigint from (select count(*) as c from hour group by txn_id)) as repeated,
    (select count(*) from hour where not regexp_matches(merchant_id, '^merchant_[0-9]{{4}}$')
       or not regexp_matches(user_id, '^user_[0-9]{{6}}$') or amount < 0.01 or amount > 15000) as broken,
    (select count(*) from hour where amount <= 0 or amount > 50000 or (amount > 0 and amount < 0.01)) as outliers),
  results as (
    select 'schema_violations' as check_name, broken as failures, hour = 0 as skipped from n
    union all select 'volume', coalesce((hour / nullif(day / 24.0::double, 0) > 3
      or hour / nullif(day / 24.0::double, 0) < 1 / 3.0::double)::bigint, 0), day = 0 from n
    union all select 'null_fields', 0, false from n
    union all select 'status_drift', coalesce((approved / nullif(six, 0) < 0.8 or approved / nullif(six, 0) > 0.96)::bigint, 0),
      six = 0 from n
    union all select 'staleness', (fresh = 0)::bigint, false from n
    union all select 'amount_outliers', outliers, false from n
    union all select 'accepted_values', 0, false from n
    union all select 'duplicates', repeated, false from n)
  select check_name, failures, case when skipped then 'skip' when failures > 0 then 'fail' else 'pass' end as status
  from results"""


@query("d9_quality_report", _REPORT)
def quality_report(spark, sf):
    return quality.quality_report(live_transactions(spark, sf), EVENTS_AS_OF)
