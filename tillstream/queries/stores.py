"""Table jobs: each writes to the shared scratch folder and reads the stored rows back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.plans import marts
from tillstream.plans.staging import approved_only
from tillstream.queries.registry import EVENTS_NOW, LIVE, SCORED, STAGED, money_sum, query
from tillstream.queries.rows import staged_history
from tillstream.schemas import SNAPSHOT_TRANSACTIONS
from tillstream.session import scratch_path
from tillstream.sources import stores
from tillstream.sources.datasets import EVENTS_AS_OF, live_transactions, raw_anomalies, scored_transactions
from tillstream.sources.versions import VersionedTable
from tillstream.streaming.windows import spend_windows

_SPEND = f"""(select user_id, date_trunc('day', "timestamp") as window_start, count(*) as txn_count,
    {money_sum("amount")} as total_spend from live {{where}} group by 1, 2)"""


@query(
    "s6_append_dedup",
    f"""with {LIVE} select txn_id, case when status = 'approved' then "timestamp"
          else "timestamp" - interval 1 hour end as "timestamp" from live""",
)
def _(spark, sf):
    """Some rows arrive early, then all of them twice over: the first stored row of an id stays."""
    path, rows = scratch_path(spark, "append"), live_transactions(spark, sf).select("txn_id", "timestamp", "status")
    earlier = rows.withColumn("timestamp", F.timestamp_add("HOUR", F.lit(-1), "timestamp"))
    later = rows.withColumn("timestamp", F.timestamp_add("HOUR", F.lit(1), "timestamp"))
    for batch in (earlier.where("status <> 'approved'"), rows.unionAll(later), rows):
        stores.append_dedup(batch.drop("status"), path)
    return stores.read_by_day(spark, path)


_UPSERTED = f"""with {LIVE} select user_id, window_start, coalesce(n.txn_count, o.txn_count) as txn_count,
               coalesce(n.total_spend, o.total_spend) as total_spend, case when n.user_id is null then 'old' else 'new' end as note
        from {_SPEND.format(where="where amount > 20")} o
        full join {_SPEND.format(where="where status = 'approved'")} n using (user_id, window_start)"""


@query("s8_upsert_by_key", _UPSERTED)
def _(spark, sf):
    """Daily spend stored twice: a later record wins, its NULL fields keep the stored value."""
    path = scratch_path(spark, "upsert")
    for rows in _spend_batches(spark, sf):
        stores.upsert_by_key(rows, path, ["user_id", "window_start"], "window_start", "_arrival")
    return stores.read_by_day(spark, path)


def _spend_batches(spark, sf):
    live = live_transactions(spark, sf)

    def batch(rows, note: str):
        spend = spend_windows(rows).select("user_id", "window_start", "txn_count", "total_spend")
        return spend.withColumns({"note": F.lit(note), "_arrival": F.lit(1)})

    newer = batch(live.where("status = 'approved'"), "new")
    return [batch(live.where("amount > 20"), "old"), newer, newer.withColumn("total_spend", F.lit(None).cast("double"))]


@query("s8_versioned_upsert", _UPSERTED)
def _(spark, sf):
    """The same in a versioned table: each batch is one step for readers, and what one of them read stays."""
    held = VersionedTable(spark, scratch_path(spark, "versioned"), "window_start")
    for rows in _spend_batches(spark, sf):
        held.upsert(rows, ["user_id", "window_start"], "_arrival")
    return held.read()


@query(
    "s11_export_snapshot",
    f"""with {SCORED} select txn_id, user_id, amount, currency, "timestamp", merchant_id, merchant_category, payment_method, status,
               location_lat, location_lon, user_txn_count, user_running_mean, z_score, is_anomaly
        from scored where "timestamp" >= {EVENTS_NOW} - interval 10 day""",
)
def _(spark, sf):
    """All columns of the snapshot of scored transactions."""
    path = scratch_path(spark, "snapshot")
    stores.export_snapshot(scored_transactions(spark, sf), SNAPSHOT_TRANSACTIONS, path, EVENTS_AS_OF, lookback_days=10)
    stored = spark.read.schema(SNAPSHOT_TRANSACTIONS).parquet(path)
    return stored.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query(
    "s13_materialize",
    f"""with {STAGED} select merchant_id, count(*) as lifetime_txn_count, {money_sum("amount")} as lifetime_revenue
        from approved group by 1""",
)
def _(spark, sf):
    """Staging as a view, the mart over it as stored files."""
    stores.materialize(staged_history(spark, sf), "tillstream_stg_transactions")
    mart = marts.lifetime_merchants(approved_only(spark.table("tillstream_stg_transactions")))
    stores.materialize(mart, "tillstream_lifetime_merchants", scratch_path(spark, "mart"))
    return spark.table("tillstream_lifetime_merchants")


@query(
    "m1_purge",
    f"""with {LIVE}, cut as (select {EVENTS_NOW} - interval 10 day + interval 9 hour as t)
        select 'kept' as part, count(*) as n_rows, min("timestamp") as oldest from live, cut where "timestamp" >= t
        union all select 'purged', count(*), null from live, cut where "timestamp" < t""",
)
def _(spark, sf):
    """The cut falls inside a day, so that day is rewritten and the older ones are dropped."""
    path = scratch_path(spark, "purge")
    rows = live_transactions(spark, sf).select("txn_id", "timestamp")
    stores.write_by_day(rows.withColumn("event_date", F.to_date("timestamp")), path)
    purged = stores.purge(spark, path, f"{EVENTS_AS_OF} 09:00:00", days=10)
    kept = stores.read_by_day(spark, path)
    oldest = F.min("timestamp").alias("oldest")
    counts = kept.agg(F.lit("kept").alias("part"), F.count("*").alias("n_rows"), oldest)
    report = kept.limit(0).agg(F.lit("purged").alias("part"), F.lit(purged).cast("bigint").alias("n_rows"), oldest)
    return counts.unionAll(report)


@query(
    "m2_remove_orphans",
    f"""with {SCORED} select txn_id, "timestamp" from scored
        where is_anomaly and txn_id in (select txn_id from live where status <> 'declined')""",
)
def _(spark, sf):
    path = scratch_path(spark, "orphans")
    stores.append_dedup(raw_anomalies(spark, sf).select("txn_id", "timestamp"), path)
    stores.remove_orphans(spark, path, live_transactions(spark, sf).where("status <> 'declined'"))
    return stores.read_by_day(spark, path)


@query(
    "m2_versioned_table",
    f"""with {SCORED} select txn_id, "timestamp" from scored
        where is_anomaly and txn_id in (select txn_id from live where status <> 'declined')
          and "timestamp" >= {EVENTS_NOW} - interval 20 day + interval 9 hour""",
)
def _(spark, sf):
    """Orphans and old rows leave a versioned table, which is then compacted and rid of its old folders."""
    held = VersionedTable(spark, scratch_path(spark, "versioned"))
    rows = raw_anomalies(spark, sf).select("txn_id", "timestamp").withColumn("event_date", F.to_date("timestamp"))
    held.replace(rows, [r[0].isoformat() for r in rows.select("event_date").distinct().collect()])
    held.remove_orphans(live_transactions(spark, sf).where("status <> 'declined'"))
    held.purge(f"{EVENTS_AS_OF} 09:00:00", days=20)
    held.compact()
    held.expire()
    return held.read()


@query(
    "m3_table_stats",
    """select 'orders' as table_name, count(*) as row_count, 1 as file_count from orders
       union all select 'customer', count(*), 1 from customer""",
)
def _(spark, sf):
    stats = stores.table_stats({n: f"{sf}/{n}.parquet" for n in ("orders", "customer")})
    return stats.select("table_name", "row_count", F.col("file_count").cast("int").alias("file_count"))


@query(
    "m4_compact",
    f"""with {LIVE} select cast(date_trunc('day', "timestamp") as date) as event_date, count(*) as n_rows, 1 as n_files
        from live group by 1""",
)
def _(spark, sf):
    """Two appends leave several files per day; compaction leaves one."""
    path, rows = scratch_path(spark, "compact"), live_transactions(spark, sf).select("txn_id", "timestamp", "status")
    days = rows.withColumn("event_date", F.to_date("timestamp"))
    for part in ("status = 'approved'", "status <> 'approved'"):
        stores.write_by_day(days.where(part), path)
    stores.compact(spark, path)
    files = spark.read.parquet(path).groupBy("event_date", "_metadata.file_path").agg(F.count("*").alias("n"))
    return files.groupBy("event_date").agg(
        F.sum("n").alias("n_rows"), F.count("*").cast("int").alias("n_files")
    )
