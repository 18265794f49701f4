"""Projections, filters, scalar functions, reshaping, de-duplication and ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.functions import money, scalars, times, urls
from tillstream.operators import dedup, joins, ordered, reshape, running
from tillstream.operators.contract import json_failures, violations
from tillstream.plans import serving, staging
from tillstream.queries.registry import (
    ANOMALIES,
    EVENTS_NOW,
    HISTORY,
    LIVE,
    SCORED,
    STAGED,
    money_sum,
    query,
    rounded,
)
from tillstream.schemas import TRANSACTION_CONTRACT
from tillstream.sources import codecs
from tillstream.sources.datasets import (
    EVENTS_AS_OF,
    HISTORY_TIEBREAK,
    live_transactions,
    raw_anomalies,
    raw_history,
    scored_transactions,
    table,
    transactions_from_events,
)
from tillstream.streaming.windows import spend_windows


def staged_history(spark, sf):
    return staging.stg_transactions(raw_history(spark, sf), HISTORY_TIEBREAK)


def staged_anomalies(spark, sf):
    return staging.stg_anomalies(raw_anomalies(spark, sf))


# ---- text and JSON -------------------------------------------------------------------------


def _event_texts(spark, sf):
    """Events as topic text; error events arrive cut off and signups without a user."""
    txns = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("txn_id"),
        F.when(F.col("event_type") != "signup", F.col("user_id").cast("string")).alias("user_id"),
        F.col("value").alias("amount"),
        codecs.iso_text("ts").alias("timestamp"),
        F.col("event_type"),
    )
    text = F.to_json(F.struct("txn_id", "user_id", "amount", "timestamp"))
    cut = F.when(F.col("event_type") == "error", F.substring(text, 1, 25)).otherwise(text)
    return txns.select(cut.alias("value"), "txn_id")


@query(
    "s2_parse_json",
    """select cast(event_id as varchar) as txn_id, cast(user_id as varchar) as user_id, value as amount,
              ts as "timestamp"
       from events where event_type not in ('error', 'signup')""",
)
def _(spark, sf):
    good, _bad = codecs.parse_transactions(_event_texts(spark, sf))
    return good.select("txn_id", "user_id", "amount", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


@query(
    "s2_parse_json_quarantine",
    """select event_type = 'error' as cut_off, count(*) as n_rows
       from events where event_type in ('error', 'signup') group by 1""",
)
def _(spark, sf):
    _good, bad = codecs.parse_transactions(_event_texts(spark, sf))
    return bad.groupBy((~F.col("value").endswith("}")).alias("cut_off")).agg(F.count("*").alias("n_rows"))


@query(
    "s3_event_time",
    """select event_id, case event_type when 'view' then date_trunc('second', ts)
              when 'error' then timestamp '1970-01-01' when 'signup' then timestamp '1970-01-01' else ts end as event_time
       from events""",
)
def _(spark, sf):
    """ISO text, seconds as a number, unreadable text and missing values."""
    kind = F.col("event_type")
    raw = (
        F.when(kind == "view", F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
        .when(kind == "error", "not-a-date")
        .when(kind != "signup", codecs.iso_text("ts"))
    )
    events = table(spark, sf, "events")
    return events.select("event_id", times.event_time(raw).cast("timestamp_ntz").alias("event_time"))


@query(
    "s4_to_json",
    """select cast(o_custkey as varchar) as key, '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey
              || ',"o_orderstatus":"' || o_orderstatus || '","note":null}' as value from orders""",
)
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    rows = rows.withColumn("note", F.lit(None).cast("string"))
    return codecs.encode_json(rows, "o_custkey").withColumn("key", F.col("key").cast("string"))


@query(
    "s9_decode_daily",
    f"""with {LIVE} select user_id, date_trunc('day', "timestamp") as window_start,
               date_trunc('day', "timestamp") + interval 1 day as window_end, count(*) as txn_count
        from live group by 1, 2, 3""",
)
def _(spark, sf):
    live = live_transactions(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    rows, _bad = codecs.decode_daily(codecs.encode_daily(spend_windows(live)))
    bounds = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")]
    return rows.select("user_id", *bounds, "txn_count")


@query("s10_decode_enriched", f'with {SCORED} select txn_id, user_id, "timestamp", z_score, is_anomaly from scored')
def _(spark, sf):
    rows, _bad = codecs.decode_enriched(codecs.encode_transactions(scored_transactions(spark, sf)))
    ts = F.col("timestamp").cast("timestamp_ntz").alias("timestamp")
    return rows.select("txn_id", "user_id", ts, "z_score", "is_anomaly")


@query("s12_scan_parquet", "select l_orderkey, l_linenumber, l_shipdate, l_extendedprice from lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")


@query(
    "s14_hashed_id",
    """select o_orderkey, substr(sha256(o_orderkey || '|' || o_custkey || '|' || o_orderpriority), 1, 24) as hashed_id
       from orders""",
)
def _(spark, sf):
    key = scalars.hashed_id(["o_orderkey", "o_custkey", "o_orderpriority"]).alias("hashed_id")
    return table(spark, sf, "orders").select("o_orderkey", key)


@query(
    "f12_json_fields",
    "select event_id, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k from events",
)
def _(spark, sf):
    record = F.from_json("props", "k bigint")
    return table(spark, sf, "events").select("event_id", record["k"].alias("k"))


# ---- projections and filters ---------------------------------------------------------------


@query("p1_stg_transactions", f"with {STAGED} select * from staged")
def _(spark, sf):
    return staged_history(spark, sf)


@query("p2_stg_anomalies", f"with {ANOMALIES} select * from anomalies")
def _(spark, sf):
    return staged_anomalies(spark, sf)


@query("p3_approved_only", f"with {STAGED} select txn_id, status, amount from approved")
def _(spark, sf):
    return staging.approved_only(staged_history(spark, sf)).select("txn_id", "status", "amount")


@query(
    "p4_lookback",
    f"""with {LIVE} select txn_id, "timestamp", amount from live
        where "timestamp" >= {EVENTS_NOW} - interval 7 day""",
)
def _(spark, sf):
    return serving.lookback(live_transactions(spark, sf), EVENTS_AS_OF, 7).select("txn_id", "timestamp", "amount")


@query(
    "p4_lookback_replay",
    f"""with {LIVE}, bounds as (select {EVENTS_NOW} - interval 20 day as now)
        select txn_id, "timestamp", amount from live, bounds
        where "timestamp" >= now - interval 7 day and "timestamp" <= now""",
)
def _(spark, sf):
    """As of a day in the middle of the data: later rows do not count."""
    now = times.shift(times.as_of_column(EVENTS_AS_OF), "day", -20)
    return serving.lookback(live_transactions(spark, sf), now, 7).select("txn_id", "timestamp", "amount")


@query(
    "p5_star",
    """select o_orderkey as old_o_orderkey_v1, o_custkey as old_o_custkey_v1, o_orderstatus as old_o_orderstatus_v1,
              o_orderdate as old_o_orderdate_v1 from orders""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    columns = reshape.star(orders, ["O_TotalPrice", "o_orderpriority"], "old_", "_v1", alias="o")
    return orders.alias("o").select(*columns)


@query("p6_filtered_columns", "select c_custkey, c_nationkey, c_acctbal from customer")
def _(spark, sf):
    customer = table(spark, sf, "customer")
    return customer.select(*reshape.filtered_columns(customer, ["C_NAME", "c_mktsegment"]))


@query(
    "p7_nullcheck_table",
    "select event_id, nullif(case when event_type = 'error' then '' else event_type end, '') as label, value from events",
)
def _(spark, sf):
    label = F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("label")
    return reshape.nullcheck_table(table(spark, sf, "events").select("event_id", label, "value"))


@query("p8_flatten", f"with {LIVE} select txn_id, location_lat, location_lon from live")
def _(spark, sf):
    flat = codecs.flatten_location(live_transactions(spark, sf))
    return flat.select("txn_id", "location_lat", "location_lon")


@query(
    "p9_ratio_pct",
    f"""select p_partkey, {rounded("p_size / nullif(p_size - 25, 0) * 100", 2)} as unguarded,
               case when p_size > 25 then {rounded("p_retailprice / (p_size - 25) * 100", 2)} end as or_null,
               case when p_size > 25 then {rounded("p_retailprice / (p_size - 25) * 100", 4)} else 0 end as or_zero
        from part""",
)
def _(spark, sf):
    surplus = F.col("p_size") - 25
    return table(spark, sf, "part").select(
        "p_partkey",
        money.round_away(scalars.safe_divide("p_size", surplus) * 100, 2).alias("unguarded"),
        money.ratio_pct("p_retailprice", surplus).alias("or_null"),
        money.ratio_pct("p_retailprice", surplus, 4, otherwise=0).alias("or_zero"),
    )


@query(
    "p10_optional_predicates",
    f"""with {ANOMALIES} select txn_id, user_id, z_score from anomalies
        where "timestamp" >= {EVENTS_NOW} - interval 90 day and z_score >= 3.5
        order by "timestamp" desc, txn_id limit 500""",
)
def _(spark, sf):
    found = serving.anomalies(raw_anomalies(spark, sf), EVENTS_AS_OF, days=90, limit=500, min_z=3.5)
    return found.select("txn_id", "user_id", "z_score")


@query(
    "p11_bounds",
    f"""with {LIVE} select merchant_id, {money_sum("amount")} as total_revenue from live
        where "timestamp" >= {EVENTS_NOW} - interval 365 day
        group by merchant_id, merchant_category order by 2 desc, 1 limit 50""",
)
def _(spark, sf):
    """The widest window and list the bounds allow; values beyond raise."""
    top = serving.top_merchants(live_transactions(spark, sf), EVENTS_AS_OF, days=365, limit=50)
    return top.select("merchant_id", "total_revenue")


# ---- de-duplication and running windows ----------------------------------------------------


@query(
    "w1_dedup_latest",
    f"""with {STAGED} select txn_id, "timestamp", amount, user_id, merchant_id from staged""",
)
def _(spark, sf):
    latest = dedup.dedup_latest(raw_history(spark, sf), tiebreak=HISTORY_TIEBREAK)
    return latest.select("txn_id", "timestamp", "amount", "user_id", "merchant_id")


@query(
    "w2_deduplicate",
    """select l_orderkey, l_partkey, l_suppkey, l_shipdate from lineitem
       qualify row_number() over (partition by l_orderkey
         order by l_shipdate, l_partkey desc, l_suppkey, l_extendedprice) = 1""",
)
def _(spark, sf):
    items = table(spark, sf, "lineitem")
    order = ["l_shipdate", F.col("l_partkey").desc(), "l_suppkey", "l_extendedprice"]
    kept = dedup.deduplicate(items, "l_orderkey", order)
    return kept.select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")


@query(
    "j6_natural_join_dedup",
    """with tagged as (select c_nationkey, c_custkey, case when c_acctbal > 9000 then null else c_mktsegment end as segment
                       from customer),
            ranked as (select *, row_number() over (partition by c_nationkey order by c_custkey) as rn from tagged)
       select distinct t.c_nationkey, t.c_custkey, t.segment
       from tagged t join ranked r using (c_nationkey, c_custkey, segment) where rn = 1""",
)
def _(spark, sf):
    segment = F.when(~(F.col("c_acctbal") > 9000), F.col("c_mktsegment")).alias("segment")
    tagged = table(spark, sf, "customer").select("c_nationkey", "c_custkey", segment)
    return dedup.deduplicate(tagged, "c_nationkey", ["c_custkey"], drop_null_rows=True)


_SCORES = "txn_id, user_txn_count, user_running_mean, z_score, is_anomaly"


@query("w7_running_zscore", f"with {SCORED} select {_SCORES} from scored")
def _(spark, sf):
    return scored_transactions(spark, sf).select(*_SCORES.split(", "))


@query("w7_running_zscore_sliced", f"with {SCORED} select {_SCORES} from scored")
def _(spark, sf):
    """The form for keys too large for one task, forced on every key."""
    scored = running.running_zscore(live_transactions(spark, sf), hot_rows=0)
    return scored.select(*_SCORES.split(", "))


_NEIGHBOUR = """select user_id, ts, event_id, {side}(event_id) over w as {side}_event,
  {side}(event_id) over w is null as at_edge from events window w as (partition by user_id order by ts, event_id)"""


def _neighbour(spark, sf, offset: int, side: str, slices: int | None = None):
    events = table(spark, sf, "events").select("user_id", "ts", "event_id")
    found = ordered.with_neighbour(events, ["user_id", "ts", "event_id"], offset, "near", ["user_id"], slices)
    near = F.col("near.event_id")
    return found.select("user_id", "ts", "event_id", near.alias(f"{side}_event"), near.isNull().alias("at_edge"))


@query("w8_lead", _NEIGHBOUR.format(side="lead"))
def _(spark, sf):
    return _neighbour(spark, sf, 1, "lead")


@query("w9_lag", _NEIGHBOUR.format(side="lag"))
def _(spark, sf):
    return _neighbour(spark, sf, -1, "lag")


@query("w8_lead_sliced", _NEIGHBOUR.format(side="lead"))
def _(spark, sf):
    """More slices than users: the rows of a user lie in several."""
    return _neighbour(spark, sf, 1, "lead", slices=64)


# ---- scalar functions ----------------------------------------------------------------------


@query(
    "f1_date_parts",
    """select event_id, date_trunc('day', ts) as txn_date, date_trunc('hour', ts) as txn_hour,
              cast(extract(dow from ts) as int) as day_of_week, cast(extract(hour from ts) as int) as hour_of_day
       from events""",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    return events.select("event_id", *times.date_parts(events, "ts"))


@query(
    "f2_round",
    f"""select event_id, {rounded("value / 7", 2)} as to_cents, {rounded("-value / 7", 4)} as to_four from events""",
)
def _(spark, sf):
    v = F.col("value") / 7
    rounds = [money.round_away(v, 2).alias("to_cents"), money.round_away(-v, 4).alias("to_four")]
    return table(spark, sf, "events").select("event_id", *rounds)


@query(
    "f3_cast_abs_case",
    """select o_orderkey, cast(o_custkey as int) as custkey, abs(o_totalprice - 250000) as gap,
              coalesce(nullif(o_orderstatus, 'P'), 'pending') as status,
              case when o_totalprice > 250000 then 'high' else 'low' end as band from orders""",
)
def _(spark, sf):
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("int").alias("custkey"),
        F.abs(price - 250000).alias("gap"),
        F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("pending")).alias("status"),
        F.when(price > 250000, "high").otherwise("low").alias("band"),
    )


_GAPPED = "(select p_partkey, p_size, nullif(p_size % 7, 0) as a, nullif(p_size % 5, 0) as b from part)"


def _gapped(spark, sf):
    size = F.col("p_size")
    a, b = F.nullif(size % 7, F.lit(0)).alias("a"), F.nullif(size % 5, F.lit(0)).alias("b")
    return table(spark, sf, "part").select("p_partkey", "p_size", a, b)


@query("f4_safe_add", f"select p_partkey, p_size + coalesce(a, 0) + coalesce(b, 0) as total from {_GAPPED}")
def _(spark, sf):
    return _gapped(spark, sf).select("p_partkey", scalars.safe_add(["p_size", "a", "b"]).alias("total"))


@query("f4_safe_subtract", f"select p_partkey, p_size - coalesce(a, 0) - coalesce(b, 0) as rest from {_GAPPED}")
def _(spark, sf):
    return _gapped(spark, sf).select("p_partkey", scalars.safe_subtract(["p_size", "a", "b"]).alias("rest"))


@query(
    "f5_safe_divide",
    "select p_partkey, p_retailprice / nullif(p_size % 7, 0) as quotient from part",
)
def _(spark, sf):
    quotient = scalars.safe_divide("p_retailprice", F.col("p_size") % 7).alias("quotient")
    return table(spark, sf, "part").select("p_partkey", quotient)


@query(
    "f6_width_bucket",
    """select o_orderkey, cast(case when o_totalprice < 100000 then 0 when o_totalprice >= 400000 then 6
         else floor(5 * (o_totalprice - 100000) / 300000) + 1 end as bigint) as bucket from orders""",
)
def _(spark, sf):
    bucket = scalars.width_bucket("o_totalprice", 100000, 400000, 5).alias("bucket")
    return table(spark, sf, "orders").select("o_orderkey", bucket)


def _haversine_sql(rate: str) -> str:
    half_lat, half_lon = "sin(radians((52.379189 - lat) / 2))", "sin(radians((4.899431 - lon) / 2))"
    chord = f"power({half_lat}, 2) + cos(radians(lat)) * cos(radians(52.379189)) * power({half_lon}, 2)"
    return f"round(2 * 3961 * asin(sqrt({chord})) * {rate}, 4)"


@query(
    "f7_haversine_distance",
    f"""select txn_id, {_haversine_sql("1")} as miles, {_haversine_sql("1.60934")} as km
        from (with {LIVE} select txn_id, location_lat as lat, location_lon as lon from live)""",
)
def _(spark, sf):
    """Distance of each transaction from one place."""
    place = ("location.lat", "location.lon", F.lit(52.379189), F.lit(4.899431))
    distances = [
        money.round_away(scalars.haversine_distance(*place, unit=unit), 4).alias(name)
        for unit, name in (("mi", "miles"), ("km", "km"))
    ]
    return live_transactions(spark, sf).select("txn_id", *distances)


@query(
    "f8_generate_surrogate_key",
    f"""select o_orderkey,
          md5(o_orderkey || '-' || coalesce(nullif(o_orderstatus, 'P'), '{scalars.NULL_KEY_TEXT}')) as key_text,
          md5(o_orderkey || '-' || coalesce(nullif(o_orderstatus, 'P'), '')) as key_empty
        from orders""",
)
def _(spark, sf):
    fields = ["o_orderkey", F.nullif("o_orderstatus", F.lit("P"))]
    keys = [
        scalars.surrogate_key(fields).alias("key_text"),
        scalars.surrogate_key(fields, null_as_empty=True).alias("key_empty"),
    ]
    return table(spark, sf, "orders").select("o_orderkey", *keys)


@query(
    "f9_url_host",
    "select page_id, regexp_extract(url, '^(?:https?://|android-app://)?([^/?]*)', 1) as host from pages",
)
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.url_host("url").alias("host"))


@query(
    "f10_url_path",
    "select page_id, regexp_extract(url, '^(?:https?://)?[^/?]*/?([^?]*)', 1) as path from pages",
)
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.url_path("url").alias("path"))


@query(
    "f11_url_parameter",
    """select page_id, nullif(regexp_extract(url, '[?&]utm_source=([^&]*)', 1), '') as utm_source,
              nullif(regexp_extract(url, '[?&]page=([^&]*)', 1), '') as page from pages""",
)
def _(spark, sf):
    names = ("utm_source", "page")
    return table(spark, sf, "pages").select("page_id", *[urls.url_parameter("url", n).alias(n) for n in names])


@query(
    "f13_compact_text",
    """select c_custkey, case when n >= 1e6 then printf('%.1fM', round(n / 1e6, 1))
                when n >= 1e3 then printf('%.1fK', round(n / 1e3, 1))
                else format('{:,}', cast(round_even(n, 0) as bigint)) end as number_text,
              case when n >= 1e6 then printf('$%.2fM', round(n / 1e6, 2))
                when n >= 1e3 then printf('$%.1fK', round(n / 1e3, 1)) else printf('$%.2f', n) end as currency_text
       from (select o_custkey as c_custkey, cast(sum(cast(round_even(o_totalprice * 100, 0) as bigint)) as double) / 100 as n
             from orders group by 1)""",
)
def _(spark, sf):
    spend = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    texts = [money.compact_number("n").alias("number_text"), money.compact_currency("n").alias("currency_text")]
    return spend.agg(money.money_sum("o_totalprice").alias("n")).select("c_custkey", *texts)


# ---- reshaping -----------------------------------------------------------------------------


@query(
    "u1_union_relations",
    """select 'customer' as source_relation, c_custkey as account, c_acctbal as balance, c_mktsegment as segment,
              null as name from customer where c_acctbal > 0
       union all
       select 'supplier', s_suppkey, s_acctbal, null, s_name from supplier where s_acctbal > 0""",
)
def _(spark, sf):
    customer = table(spark, sf, "customer").selectExpr(
        "c_custkey as account", "c_acctbal as balance", "c_mktsegment as segment", "c_nationkey as nation"
    )
    supplier = table(spark, sf, "supplier").selectExpr(
        "s_suppkey as account", "s_acctbal as balance", "s_nationkey as nation", "s_name as name"
    )
    both = {"customer": customer, "supplier": supplier}
    return reshape.union_relations(both, exclude=["NATION"], where="balance > 0")


@query(
    "u2_union_by_prefix",
    """select event_type as kind, count(*) as n_rows, sum(event_id)::bigint as ids
       from events where event_type in ('click', 'view') group by 1""",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    for kind in ("click", "view", "purchase"):
        rows = events.where(F.col("event_type") == kind).select("event_id")
        rows.createOrReplaceTempView(f"tillstream_part_{kind}")
    both = reshape.union_by_prefix(spark, "TILLSTREAM_PART_", exclude="%purchase", source_column_name="source")
    kind = F.replace("source", F.lit("tillstream_part_"), F.lit("")).alias("kind")
    return both.groupBy(kind).agg(F.count("*").alias("n_rows"), F.sum("event_id").alias("ids"))


@query(
    "u3_symmetric_except",
    """with a as (select o_custkey, nullif(o_orderstatus, 'P') as s from orders where o_orderstatus <> 'O'),
            b as (select o_custkey, nullif(o_orderstatus, 'P') as s from orders where o_orderstatus <> 'F')
       select 'a_minus_b' as which_diff, * from (select * from a except select * from b)
       union all select 'b_minus_a', * from (select * from b except select * from a)""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    rows = orders.select("o_orderstatus", "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("s"))
    a, b = rows.where("o_orderstatus <> 'O'"), rows.where("o_orderstatus <> 'F'")
    return reshape.symmetric_except(a, b, ["o_custkey", "s"])


@query(
    "u4_unpivot",
    """select c_custkey, 'c_name' as prop, c_name as val from customer
       union all select c_custkey, 'in_credit', cast(c_acctbal > 0 as varchar) from customer
       union all select c_custkey, 'segment', nullif(c_mktsegment, 'MACHINERY') from customer""",
)
def _(spark, sf):
    customer = table(spark, sf, "customer").select(
        "c_custkey",
        "c_name",
        (F.col("c_acctbal") > 0).alias("in_credit"),
        F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment"),
        "c_nationkey",
    )
    return reshape.unpivot(
        customer, exclude=["C_CUSTKEY"], remove=["c_nationkey"], field_name="prop", value_name="val"
    )


@query(
    "u5_generate_series",
    "select unnest(generate_series(1, (select count(*) from orders))) as generated_number",
)
def _(spark, sf):
    return reshape.generate_series(spark, table(spark, sf, "orders").count())


@query(
    "j7_cross_series",
    "select g as generated_number, o_custkey from (select unnest(generate_series(1, (select count(*) from orders))) as g) join orders on o_orderkey = g",
)
def _(spark, sf):
    """The series as a side of a join (a range needs no cross joins)."""
    orders = table(spark, sf, "orders")
    series = reshape.generate_series(spark, orders.count())
    joined = series.join(orders, series["generated_number"] == orders["o_orderkey"])
    return joined.select("generated_number", "o_custkey")


@query(
    "u6_date_spine",
    """with bounds as (select date_trunc('day', min(ts)) as lo, date_trunc('day', max(ts)) as hi from events),
            spine as (select unnest(generate_series(lo, hi - interval 1 day, interval 1 day)) as date_day from bounds)
       select date_day, count(event_id) as n_events
       from spine left join events on date_trunc('day', ts) = date_day group by 1""",
)
def _(spark, sf):
    """Events per calendar day, days without events included."""
    events = table(spark, sf, "events")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    midnight = dict(hour=0, minute=0, second=0, microsecond=0)
    spine = reshape.date_spine(spark, "day", low.replace(**midnight), high.replace(**midnight))
    per_day = events.groupBy(times.truncated(events, "day", "ts").alias("date_day")).agg(F.count("*").alias("n_events"))
    return joins.left_with_default(spine, per_day, ["date_day"], {"n_events": 0})


# ---- ordering ------------------------------------------------------------------------------


@query(
    "t4_slow_ops",
    f"""select event_id, user_id, value from events
        where value >= 200 and ts >= {EVENTS_NOW} - interval 720 hour order by value desc, event_id limit 20""",
)
def _(spark, sf):
    """Slowest operations: the event value read as milliseconds."""
    slow = serving.slow_ops(table(spark, sf, "events"), EVENTS_AS_OF, "value", "ts", "event_id", 200, hours=720)
    return slow.select("event_id", "user_id", "value")


@query(
    "q21_schema_contract",
    f"""with {HISTORY}, flagged as (
          select txn_id, list_filter([
              case when not regexp_matches(txn_id, '^[a-f0-9]{{24}}$') then 'txn_id: pattern' end,
              case when not regexp_matches(user_id, '^user_[0-9]{{6}}$') then 'user_id: pattern' end,
              case when amount < 0.01 then 'amount: below minimum' end,
              case when amount > 15000 then 'amount: above maximum' end,
              case when not regexp_matches(merchant_id, '^merchant_[0-9]{{4}}$') then 'merchant_id: pattern' end
            ], lambda x: x is not null) as v from history)
        select violation, count(*) as n_rows from (select unnest(v) as violation from flagged) group by 1""",
)
def _(spark, sf):
    """How often each rule is broken in the history."""
    rows = raw_history(spark, sf)
    located = rows.withColumn("location", F.struct(F.col("location_lat").alias("lat"), F.col("location_lon").alias("lon")))
    extra = ["location_lat", "location_lon", "user_txn_count", "user_running_mean", "z_score", "is_anomaly"]
    broken = located.select(F.explode(violations(located, TRANSACTION_CONTRACT, extra)).alias("violation"))
    return broken.groupBy("violation").agg(F.count("*").alias("n_rows"))


#: what is wrong with the JSON text of an event, by event_id % 20; 0 and the numbers left out are sound
_BROKEN = {
    1: "txn_id: missing",
    2: "amount: type",
    3: "amount: below minimum",
    4: "amount: above maximum",
    5: "currency: value",
    6: "timestamp: format",
    7: "merchant_id: pattern",
    8: "note: unexpected",
    9: "location.lat: missing",
    10: "location.lat: above maximum",
    11: "location: type",
    12: "user_id: type",
    13: "malformed",
    14: "malformed",
    15: "location.alt: unexpected",
    16: "status: type",
    17: "txn_id: type",
    18: "malformed",
    19: "a,b: unexpected;currency: value",
}


def _raw_texts(spark, sf):
    """event_id and the JSON text of every event, most of them with something wrong."""
    rows = transactions_from_events(table(spark, sf, "events"), "event_id")
    kind = F.col("event_id") % 20
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))

    def part(name: str, value, **instead):
        for number, text in instead.items():
            value = F.when(kind == int(number[1:]), F.lit(text)).otherwise(value)
        return F.concat(F.lit(f'"{name}":'), value)

    lat, lon = (F.col(f"location.{c}").cast("string") for c in ("lat", "lon"))
    extra = F.when(kind == 15, F.lit('"alt":1.5'))
    location = F.concat(F.lit("{"), F.concat_ws(",", part("lat", lat, k9=None, k10="95"), part("lon", lon), extra), F.lit("}"))
    parts = [
        part("txn_id", quoted(F.col("txn_id")), k1=None, k17="17"),
        part("user_id", quoted(F.col("user_id")), k12="null"),
        part("amount", F.col("amount").cast("string"), k2='"12.5"', k3="0.001", k4="20000"),
        part("currency", quoted(F.col("currency")), k5='"XXX"', k19='"xxx"'),
        part("timestamp", quoted(codecs.iso_text("timestamp")), k6='"yesterday"'),
        part("merchant_id", quoted(F.col("merchant_id")), k7='"m1"'),
        *[part(c, quoted(F.col(c))) for c in ("merchant_category", "payment_method")],
        part("status", quoted(F.col("status")), k16="true"),
        part("location", location, k11='"here"'),
        F.when(kind == 8, F.lit('"note":{"x":[1]}')).when(kind == 19, F.lit('"b":1,"a":null')),
    ]
    text = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    text = F.when(kind == 13, F.substring(text, 1, 60)).when(kind == 14, F.lit("[1,2]")).when(kind == 18, F.lit("")).otherwise(text)
    return rows.select("event_id", text.alias("value"))


@query(
    "q21_json_contract",
    f"""select event_id, case event_id % 20 {" ".join(f"when {k} then '{v}'" for k, v in _BROKEN.items())}
               end as planted,
               event_id % 20 not in (2, 3, 4, 13, 14, 18) and value < 0.01 as small from events
        where event_id % 20 <> 0 or value < 0.01""",
)
def _(spark, sf):
    """Unparsed texts that break every rule: what each breaks, as it was planted, and amounts that are too
    small by themselves."""
    small = F.lit("amount: below minimum")
    found = json_failures(_raw_texts(spark, sf), TRANSACTION_CONTRACT, "event_id").withColumnRenamed("violations", "v")
    own = F.array_contains("v", small) & (F.col("event_id") % 20 != 3)
    planted = F.when(own, F.array_remove("v", small)).otherwise(F.col("v"))
    text = F.nullif(F.array_join(F.array_sort(planted), ";"), F.lit(""))
    return found.select("event_id", text.alias("planted"), own.alias("small"))
