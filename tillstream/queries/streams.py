"""Streaming jobs drained over the given events; the stored output is compared with the batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.functions.money import round_steady
from tillstream.queries.registry import LIVE, SCORED, money_sum, query, rounded, steady
from tillstream.session import scratch_path
from tillstream.sources import codecs
from tillstream.sources.datasets import (
    live_transactions,
    raw_anomalies,
    scored_transactions,
    spread,
    table,
    transactions_from_events,
)
from tillstream.streaming import fanout, feeds, gate, hot_scoring, jobs
from tillstream.streaming.recovery import stored_moments
from tillstream.streaming.windows import spend_windows


def event_feed(spark, sf):
    """The events table as a stream of its own rows."""
    schema = table(spark, sf, "events").schema
    feed = feeds.parquet_feed(spark, sf, schema, pattern="events.parquet")
    return spread(feed, f"{sf}/events.parquet", "event_id")


def topic_feed(spark, sf):
    """The events as the JSON text their producers would send."""
    return codecs.encode_transactions(transactions_from_events(event_feed(spark, sf))).select("value")


def run_scoring(spark, sf) -> str:
    """Drain the scoring job and return the folder it wrote."""
    root = scratch_path(spark, "scoring")
    enriched, flagged, checkpoint = (f"{root}/{n}" for n in ("enriched", "anomalies", "checkpoint"))
    jobs.score_transactions(topic_feed(spark, sf), enriched, flagged, checkpoint).awaitTermination()
    return root


def _stored(spark, path, *columns):
    rows = spark.read.parquet(path)
    ntz = {c: F.col(c).cast("timestamp_ntz") for c, t in rows.dtypes if t == "timestamp"}
    return rows.withColumns(ntz).select(*columns) if columns else rows.withColumns(ntz)


@query("s1_stream_source", "select event_id, ts, user_id, event_type, value, props from events")
def _(spark, sf):
    path, checkpoint = scratch_path(spark, "source"), scratch_path(spark, "checkpoint")
    jobs.write_batches(event_feed(spark, sf), path, checkpoint).awaitTermination()
    return _stored(spark, path, "event_id", "ts", "user_id", "event_type", "value", "props")


_SCORED_COLUMNS = ["txn_id", "user_id", "amount", "timestamp", "user_txn_count", "user_running_mean", "z_score", "is_anomaly"]
_SCORED_LIST = ", ".join(f'"{c}"' for c in _SCORED_COLUMNS)


@query("x3_zscore_anomaly", f"with {SCORED} select {_SCORED_LIST} from scored")
def stream_scores(spark, sf):
    return _stored(spark, f"{run_scoring(spark, sf)}/enriched", *_SCORED_COLUMNS)


@query("x4_anomaly_branch", f"with {SCORED} select txn_id, user_id, z_score from scored where is_anomaly")
def _(spark, sf):
    return _stored(spark, f"{run_scoring(spark, sf)}/anomalies", "txn_id", "user_id", "z_score")


_CLOSED = f"""with {LIVE}, spend as (
    select user_id, date_trunc('day', "timestamp") as window_start,
           date_trunc('day', "timestamp") + interval 1 day as window_end, count(*) as txn_count,
           {money_sum("amount")} as total_spend, {rounded(f"{money_sum('amount')} / count(*)", 2)} as avg_spend
    from live group by 1, 2, 3)
  select * from spend where window_end <= (select max("timestamp") - interval 5 second from live)"""


def run_daily(spark, sf) -> str:
    root = scratch_path(spark, "daily")
    jobs.roll_up_spend(topic_feed(spark, sf), f"{root}/spend", f"{root}/checkpoint").awaitTermination()
    return root


@query("x2_daily_spend", _CLOSED)
def stream_daily(spark, sf):
    """Windows the watermark has closed; the last day stays open in the state."""
    return _stored(spark, f"{run_daily(spark, sf)}/spend").drop("batch_id")


@query(
    "x6_partition_by_key",
    f"with {SCORED} select user_id, max(user_txn_count) as n_rows, count(*) as n_seen from scored group by 1",
)
def _(spark, sf):
    """All rows of a key meet one state: its last count is its number of rows."""
    rows = _stored(spark, f"{run_scoring(spark, sf)}/enriched")
    return rows.groupBy("user_id").agg(F.max("user_txn_count").alias("n_rows"), F.count("*").alias("n_seen"))


@query(
    "s7_route_by_topic",
    f"""with {SCORED} select 'transactions_enriched' as topic, txn_id, z_score, "timestamp" from scored
        union all select 'anomalies', txn_id, z_score, "timestamp" from scored where is_anomaly""",
)
def _(spark, sf):
    """Two topics of scored JSON in one feed, stored apart; the second run of the feed adds nothing."""
    root = scratch_path(spark, "routed")
    routes = {t: f"{root}/{t}" for t in ("transactions_enriched", "anomalies")}
    scored = scored_transactions(spark, sf)
    for topic, rows in (("transactions_enriched", scored), ("anomalies", raw_anomalies(spark, sf))):
        text = codecs.encode_transactions(rows).select(F.lit(topic).alias("topic"), "value")
        text.write.mode("append").parquet(f"{root}/feed")
    schema = spark.read.parquet(f"{root}/feed").schema
    for run in range(2):
        feed = feeds.parquet_feed(spark, f"{root}/feed", schema)
        jobs.store_scored(feed, routes, f"{root}/checkpoint-{run}").awaitTermination()
    sides = [
        _stored(spark, path, "txn_id", "z_score", "timestamp").select(F.lit(topic).alias("topic"), "*")
        for topic, path in routes.items()
    ]
    return sides[0].unionAll(sides[1])


@query(
    "s8_store_daily",
    f"""with {LIVE} select user_id, date_trunc('day', "timestamp") as window_start, count(*) as txn_count,
               {money_sum("amount")} as total_spend from live group by 1, 2""",
)
def _(spark, sf):
    """Daily-spend JSON through its sink, sent twice."""
    root = scratch_path(spark, "spend")
    live = live_transactions(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    text = codecs.encode_daily(spend_windows(live)).select("value")
    for _copy in range(2):
        text.write.mode("append").text(f"{root}/feed")
    jobs.store_daily(feeds.text_feed(spark, f"{root}/feed"), f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return _stored(spark, f"{root}/table", "user_id", "window_start", "txn_count", "total_spend")


# ---- three micro-batches, with impossible times and late rows ------------------------------

#: days at which a slice of the events ends
_SLICE_ENDS = ("2024-01-11", "2024-01-21")
#: a slice is one micro-batch, however large
_SLICE_BYTES = 1 << 60

#: the events in three slices: one in 50 arrives a slice late, one in 97 with its time in milliseconds
SLICED = LIVE.replace("as location_lon\n", "as location_lon, event_id\n") + f""", cut as (
  select *, case when "timestamp" < timestamp '{_SLICE_ENDS[0]}' then 0 when "timestamp" < timestamp '{_SLICE_ENDS[1]}' then 1 else 2 end as slice
  from live
), arrived as (
  select * exclude (slice), case when event_id % 50 = 0 then least(slice + 1, 2) else slice end as arrival from cut
), good as (
  select * from arrived where event_id % 97 <> 0
), highs as (
  select b.arrival, max(a."timestamp") as high from good a join (select distinct arrival from good) b on a.arrival < b.arrival group by 1
), judged as (
  select good.*, coalesce(date_trunc('day', "timestamp") + interval 1 day <= high - interval 5 second, false) as is_late
  from good left join highs using (arrival)
), moments as (
  select *, count(*) over w as n, avg(amount) over w as mean, stddev_samp(amount) over w as sd
  from judged
  window w as (partition by user_id order by arrival, "timestamp", txn_id rows between unbounded preceding and current row)
), scored as (
  select * exclude (n, mean, sd), n as user_txn_count, {steady("mean", 2)} as user_running_mean,
         {steady("(case when sd > 0 then (amount - mean) / sd else 0 end)", 4)} as z_score,
         coalesce(abs(case when sd > 0 then (amount - mean) / sd else 0 end) > 3, false) as is_anomaly
  from moments
), spend as (
  select user_id, date_trunc('day', "timestamp") as window_start, date_trunc('day', "timestamp") + interval 1 day as window_end,
         count(*) as txn_count, {money_sum("amount")} as total_spend, {rounded(f"{money_sum('amount')} / count(*)", 2)} as avg_spend
  from judged where not is_late group by 1, 2, 3
), closed as (
  select * from spend where window_end <= (select max("timestamp") - interval 5 second from good)
)"""


def arrivals(spark, sf):
    """value (the JSON text of an event) and arrival (the slice it comes with)."""
    events = spread(table(spark, sf, "events"), f"{sf}/events.parquet", "event_id")
    events = events.select("*", F.col("ts").alias("timestamp"))
    ends = [F.lit(day).cast("timestamp_ntz") for day in _SLICE_ENDS]
    part = F.when(F.col("ts") < ends[0], 0).when(F.col("ts") < ends[1], 1).otherwise(2)
    arrival = F.when(F.col("event_id") % 50 == 0, F.least(part + 1, F.lit(2))).otherwise(part)
    event_id = F.col("event_id")
    rows = transactions_from_events(events.select("*", arrival.alias("arrival")), "arrival", "event_id")
    millis = F.unix_millis(F.col("timestamp").cast("timestamp")).cast("string")
    text = F.when(event_id % 97 == 0, millis).otherwise(codecs.iso_text("timestamp"))
    rows = rows.withColumn("timestamp", text)
    fields = [c for c in rows.columns if c not in ("arrival", "event_id")]
    return rows.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"), "arrival")


def run_slices(spark, sf, after_slice=None) -> str:
    """Let the slices arrive one by one; the gate is stopped and started again between them, as is what
    follows it. Returns the folder of the gate."""
    root = scratch_path(spark, "slices")
    texts = arrivals(spark, sf)
    # Made in one pass over the events; each slice is then copied when it is due.
    texts.write.partitionBy("arrival").parquet(f"{root}/arrivals")
    texts = spark.read.schema(texts.schema).parquet(f"{root}/arrivals")
    for number in range(len(_SLICE_ENDS) + 1):
        texts.where(F.col("arrival") == number).select("value").write.mode("append").text(f"{root}/feed")
        feed = feeds.text_feed(spark, f"{root}/feed", max_bytes=_SLICE_BYTES)
        gate.clean_transactions(feed, f"{root}/gate", f"{root}/gate-checkpoint").awaitTermination()
        if after_slice:
            schema = spark.read.parquet(f"{root}/gate/clean").drop(gate.BATCH).schema
            after_slice(feeds.parquet_feed(spark, f"{root}/gate/clean", schema, max_bytes=_SLICE_BYTES), root, number)
    return root


@query(
    "s3_time_gate",
    f"""with {SLICED} select arrival as batch_id, txn_id, "timestamp", is_late from judged""",
)
def _(spark, sf):
    """What the gate lets through of three slices, with what it finds late."""
    clean = _stored(spark, f"{run_slices(spark, sf)}/gate/clean")
    return clean.select(F.col("batch_id").cast("int").alias("batch_id"), "txn_id", "timestamp", "is_late")


@query(
    "s3_quarantine",
    f"""with {SLICED} select arrival as batch_id, 'impossible time' as reason, txn_id from arrived where event_id % 97 = 0""",
)
def _(spark, sf):
    """The texts whose time is in milliseconds."""
    bad = _stored(spark, f"{run_slices(spark, sf)}/gate/quarantine")
    txn = F.get_json_object("value", "$.txn_id").alias("txn_id")
    return bad.select(F.col("batch_id").cast("int").alias("batch_id"), "reason", txn)


def _closed_windows(spark, sf):
    def roll_up(clean, root, _number):
        jobs.roll_up_clean(clean, f"{root}/spend", f"{root}/spend-checkpoint").awaitTermination()

    return run_slices(spark, sf, roll_up)


@query("x2_daily_slices", f"with {SLICED} select * from closed")
def _(spark, sf):
    """Closed windows of three slices with impossible times and late rows among them."""
    return _stored(spark, f"{_closed_windows(spark, sf)}/spend").drop("batch_id")


@query(
    "x1_watermark",
    f"""with {SLICED} select 'closed' as part, cast(window_start as date) as day, count(*) as n_rows, sum(txn_count) as n_txns from closed group by 2
        union all select 'late', cast("timestamp" as date), count(*), count(*) from judged where is_late group by 2""",
)
def _(spark, sf):
    """Rows that came after their window had closed are counted apart; the closed windows do not change."""
    root = _closed_windows(spark, sf)
    closed = _stored(spark, f"{root}/spend").groupBy(F.to_date("window_start").alias("day"))
    closed = closed.agg(F.count("*").alias("n_rows"), F.sum("txn_count").alias("n_txns"))
    late = _stored(spark, f"{root}/gate/late").groupBy(F.to_date("timestamp").alias("day")).agg(F.count("*").alias("n_rows"))
    late = late.withColumn("n_txns", F.col("n_rows"))
    return closed.select(F.lit("closed").alias("part"), "*").unionByName(late.select(F.lit("late").alias("part"), "*"))


def _scored_slices(spark, sf, crash_at=None) -> str:
    """Score the slices; with `crash_at` the write of that slice's first micro-batch fails once, after the
    rows were scored and before they were committed."""

    def score(clean, root, number):
        job = jobs.score_clean
        paths = [f"{root}/{n}" for n in ("enriched", "anomalies", "score-checkpoint")]
        if number == crash_at:
            failing = jobs.score_clean(clean.drop("is_late"), *paths, before_commit=_crash)
            try:
                failing.awaitTermination()
            except Exception as error:  # the job's own failure
                if "stopped in the middle" not in str(error):
                    raise
        job(clean.drop("is_late"), *paths).awaitTermination()

    return run_slices(spark, sf, score)


def _crash(batch_id: int) -> None:
    raise RuntimeError(f"stopped in the middle of micro-batch {batch_id}")


_SLICED_SCORES = [*_SCORED_COLUMNS]


@query("x3_score_slices", f"with {SLICED} select {_SCORED_LIST} from scored")
def _(spark, sf):
    """Scores of three slices: the statistics go on from one to the next, late rows are scored on arrival."""
    return _stored(spark, f"{_scored_slices(spark, sf)}/enriched", *_SLICED_SCORES)


@query(
    "x3_hot_key",
    f"""with {SLICED}, by_currency as (
          select *, count(*) over w as k, avg(amount) over w as m, stddev_samp(amount) over w as s from judged
          window w as (partition by currency order by arrival, "timestamp", txn_id rows between unbounded preceding and current row))
        select txn_id, currency, k as user_txn_count, {steady("m", 2)} as user_running_mean,
               {steady("(case when s > 0 then (amount - m) / s else 0 end)", 4)} as z_score from by_currency""",
)
def _(spark, sf):
    """Scores by currency, four keys for all rows: each is spread over slices of a micro-batch, and the
    stored moments carry it into the next."""

    def score(clean, root, _number):
        rows = clean.drop("is_late")
        job = hot_scoring.score_hot(rows, f"{root}/hot", f"{root}/hot-checkpoint", key="currency", hot_rows=500)
        job.awaitTermination()

    stored = _stored(spark, f"{run_slices(spark, sf, score)}/hot/scored")
    return stored.select("txn_id", "currency", "user_txn_count", "user_running_mean", "z_score")


@query("x5_checkpoint_recovery", f"with {SLICED} select {_SCORED_LIST} from scored")
def _(spark, sf):
    """The job fails in the middle of its second slice and goes on from its checkpoint: no row is missing, none twice."""
    return _stored(spark, f"{_scored_slices(spark, sf, crash_at=1)}/enriched", *_SLICED_SCORES)


@query(
    "x5_stored_moments",
    f"""with {SLICED} select user_id, count(*) as n, {steady("avg(amount)", 2)} as mean,
               {steady("var_pop(amount) * count(*)", 2)} as m2 from good group by 1""",
)
def _(spark, sf):
    """The state that the job holds after a failure and a restart, read from its checkpoint."""
    moments = stored_moments(spark, f"{_scored_slices(spark, sf, crash_at=1)}/score-checkpoint")
    return moments.select("user_id", "n", round_steady(F.col("mean"), 2).alias("mean"), round_steady(F.col("m2"), 2).alias("m2"))


@query(
    "s5_fan_out",
    f"""with {SLICED}
        select 'transactions_enriched' as topic, user_id, txn_id as ref, "timestamp", user_txn_count as n, amount,
               user_running_mean as mean, z_score, is_anomaly from scored
        union all select 'anomalies', user_id, txn_id, "timestamp", user_txn_count, amount, user_running_mean, z_score, null
          from scored where is_anomaly
        union all select 'daily_spend', user_id, cast(epoch_ms(window_end) as varchar), window_start, txn_count, total_spend, avg_spend, null, null
          from closed""",
)
def _(spark, sf):
    """All rows of the three topics, sent over three slices; between two topics of the second slice the job
    fails once and is started again."""

    def send_all(clean, root, number):
        sink, crashed = fanout.folder_sink(f"{root}/topics"), []

        def send(rows, topic, batch_id):
            if number == 1 and topic == fanout.ANOMALIES and not crashed:
                crashed.append(batch_id)
                _crash(batch_id)
            sink(rows, topic, batch_id)

        for _attempt in range(2):
            try:
                fanout.fan_out(clean, send, f"{root}/fan-checkpoint").awaitTermination()
                break
            except Exception as error:
                if "stopped in the middle" not in str(error):
                    raise

    root = run_slices(spark, sf, send_all)
    out = None
    for topic in (fanout.ENRICHED, fanout.ANOMALIES):
        rows, _bad = codecs.decode_enriched(spark.read.parquet(f"{root}/topics/{topic}").select("value"))
        rows = rows.select(
            F.lit(topic).alias("topic"), "user_id", F.col("txn_id").alias("ref"), F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
            F.col("user_txn_count").alias("n"), "amount", F.col("user_running_mean").alias("mean"), "z_score", "is_anomaly",
        )
        out = rows if out is None else out.unionByName(rows)
    daily, _bad = codecs.decode_daily(spark.read.parquet(f"{root}/topics/{fanout.DAILY}").select("value"))
    daily = daily.select(
        F.lit(fanout.DAILY).alias("topic"), "user_id", F.unix_millis("window_end").cast("string").alias("ref"),
        F.col("window_start").cast("timestamp_ntz").alias("timestamp"), F.col("txn_count").alias("n"), F.col("total_spend").alias("amount"),
        F.col("avg_spend").alias("mean"), F.lit(None).cast("double").alias("z_score"), F.lit(None).cast("boolean").alias("is_anomaly"),
    )
    return out.unionByName(daily)
