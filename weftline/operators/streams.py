"""Stateful operators (X) and labelled extensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.plans.registry import query, sql_query, table
from weftline.streaming import ledger, state


@query("X1_batch_ledger", "SELECT event_type, count(*) AS requests, round(sum(value), 4) AS tokens FROM $events GROUP BY event_type")
def batch_ledger(spark, sf_dir):
    base = ledger.shared_path(spark)
    ledger.run_ledger(spark, sf_dir, "events.parquet", ledger.EVENTS, f"{base}/ledger", f"{base}/state")
    kept = spark.read.parquet(f"{base}/ledger")
    return kept.groupBy("event_type").agg(F.sum("requests").alias("requests"), F.round(F.sum("tokens"), 4).alias("tokens"))


sql_query("X2_resume_pending", "SELECT d.doc_id FROM $documents d LEFT ANTI JOIN (SELECT e.vec_id FROM $embeddings e WHERE e.label IS NOT NULL) c ON c.vec_id = d.doc_id", "SELECT d.doc_id FROM $documents d WHERE NOT EXISTS (SELECT 1 FROM $embeddings e WHERE e.vec_id = d.doc_id AND e.label IS NOT NULL)")
@query(
    "X3_retry_at",
    """SELECT event_id, strftime(CASE event_id % 6 WHEN 0 THEN ts + to_seconds(event_id % 120) WHEN 1 THEN ts WHEN 2 THEN ts + INTERVAL 2 DAY WHEN 3 THEN ts ELSE ts + INTERVAL 1 HOUR END, '%Y-%m-%d %H:%M:%S') AS retry_at FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM $events) t""",
)
def retry_at(spark, sf_dir):
    """When a refused request may run again, by a Retry-After header of seconds or of an HTTP date; dates lie two days ahead
    or behind, and what is missing or no such value means an hour."""
    e = table(spark, sf_dir, "events").select("event_id", F.date_trunc("SECOND", "ts").cast("timestamp_ntz").alias("now"))
    date = lambda days: F.concat(F.date_format(F.col("now") + F.expr(f"INTERVAL '{days}' DAY"), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    k = F.col("event_id") % 6
    header = F.when(k == 0, (F.col("event_id") % 120).cast("string")).when(k == 1, "-5").when(k == 2, date(2)).when(k == 3, date(-2)).when(k == 4, "soon")
    return e.select("event_id", ledger.retry_at(header, F.col("now")).cast("string").alias("retry_at"))


@query(
    "X4_rate_limit_slots",
    "WITH k AS (SELECT event_id, event_type, epoch_us(ts) AS us, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS k FROM $events) SELECT event_id, max(us - 30000000 * k) OVER (PARTITION BY event_type ORDER BY k ROWS UNBOUNDED PRECEDING) + 30000000 * k AS slot_us FROM k",
)
def rate_limit(spark, sf_dir):
    return ledger.slots(table(spark, sf_dir, "events"), "event_type", "ts", 30).select("event_id", "slot_us")


@query(
    "X4_keyed_slots",
    "WITH k AS (SELECT event_id, event_type, epoch_us(ts) AS us, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS k FROM $events) SELECT event_id, max(us - 30000000 * k) OVER (PARTITION BY event_type ORDER BY k ROWS UNBOUNDED PRECEDING) + 30000000 * k AS slot_us FROM k",
)
def keyed_slots(spark, sf_dir):
    """The same slots from a stream, whose state is each provider's next free time."""
    base = ledger.shared_path(spark)
    state.run_slots(spark, sf_dir, "events.parquet", ledger.EVENTS, f"{base}/slots", f"{base}/state", 30_000_000)
    return spark.read.parquet(f"{base}/slots").select("event_id", "slot_us")


@query(
    "X5_keyed_progress",
    f"""WITH a AS (SELECT (event_id // 4) % 50 AS unit, event_id // 4 AS item, epoch_us(ts) AS us, event_type <> 'error' AS ok, value FROM $events),
    i AS (SELECT unit, item, bool_or(ok) AS done, max(us) AS last, sum(CASE WHEN ok THEN value ELSE 0 END) AS used, sum(CASE WHEN ok THEN 0 ELSE value END) AS failed, count(*) AS n FROM a GROUP BY unit, item),
    w AS (SELECT max(us) // 1000 * 1000 AS mark FROM a)
    SELECT unit, coalesce(sha256(string_agg(item::VARCHAR, ',' ORDER BY item) FILTER (WHERE done)), sha256('')) AS completed_sha256, count(*) FILTER (WHERE done) AS n_completed, count(*) FILTER (WHERE NOT done AND last + {state.WAIT_US} > mark) AS n_retry, round(sum(used), 4) AS used, round(sum(failed), 4) AS failed, sum(n)::BIGINT AS attempts FROM i, w GROUP BY unit""",
)
def keyed_progress(spark, sf_dir):
    """Units of declared items, advanced attempt by attempt; failed items wait for a timer."""
    base = ledger.shared_path(spark)
    state.run_progress(spark, sf_dir, "events.parquet", ledger.EVENTS, f"{base}/progress", f"{base}/state")
    found = state.latest(spark, f"{base}/progress")
    return found.select("unit", F.sha2("completed", 256).alias("completed_sha256"), "n_completed", "n_retry", F.round("used", 4).alias("used"), F.round("failed", 4).alias("failed"), "attempts")


sql_query("X5_state_machine", "SELECT user_id, CASE WHEN count(*) FILTER (WHERE event_type = 'purchase') = 0 THEN 'pending' WHEN max(CASE WHEN event_type = 'error' THEN ts END) > max(CASE WHEN event_type = 'purchase' THEN ts END) THEN 'retry' ELSE 'completed' END AS state, count(*) AS steps, round(sum(value), 4) AS used FROM $events GROUP BY user_id")
sql_query("X6_atomic_units", "SELECT d.source, bool_and(l.doc_id IS NOT NULL) AS complete FROM $documents d LEFT JOIN $labels l ON l.doc_id = d.doc_id GROUP BY d.source")


@query("EXT_tumbling_windows", "SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start_us, event_type, count(*) AS n, round(sum(value), 4) AS total FROM $events GROUP BY time_bucket(INTERVAL 1 HOUR, ts), event_type")
def tumbling(spark, sf_dir):
    return ledger.windowed(table(spark, sf_dir, "events"), "1 hour")


@query("EXT_sessions", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM $events), s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g) SELECT user_id, epoch_us(min(ts)) AS start_us, count(*) AS n FROM s GROUP BY user_id, s")
def sessions(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    found = rows.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return found.select("user_id", F.unix_micros("w.start").alias("start_us"), "n")
