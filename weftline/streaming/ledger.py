"""A replayable batch ledger and other stateful work on streams.

Each micro-batch is written under its own number before anything derived from it, so that a batch run again after a
failure replaces itself and a restart reads what is there.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def run_ledger(spark: SparkSession, folder: str, name: str, schema: str, ledger: str, state: str) -> None:
    """Reads all files of a name once as a stream and appends their usage to the ledger, by batch and type."""

    def write(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy("event_type").agg(F.count(F.lit(1)).alias("requests"), F.sum("value").alias("tokens"))
        sums.write.mode("overwrite").parquet(f"{ledger}/batch_id={number}")

    stream = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def shared_path(spark: SparkSession) -> str:
    """A fresh folder that the driver and all executors reach, below spark.checkpoint.dir; it goes when the application ends.
    Only in one process, where that setting is missing, is it a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="weftline-")
    path = f"{base}/stream-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def retry_at(header: Column, now: Column) -> Column:
    """The time from which a request may be sent again, never before now: a Retry-After header gives seconds or an HTTP
    date; without one that can be read it is an hour later."""
    seconds = F.when(header.rlike(r"^\s*[+-]?\d{1,9}\s*$"), F.greatest(F.lit(0), F.trim(header).cast("int")))
    after = F.when(seconds.isNotNull(), now + F.make_dt_interval(secs=seconds))
    date = F.try_to_timestamp(F.regexp_replace(header, r"^\s*[A-Za-z]{3}, | GMT\s*$", ""), F.lit("dd MMM yyyy HH:mm:ss")).cast("timestamp_ntz")
    return F.greatest(now, F.coalesce(after, F.when(header.rlike(r"GMT\s*$"), date), now + F.expr("INTERVAL '1' HOUR")))


def slots(requests: DataFrame, provider: str, at: str, gap_seconds: float, bucket_seconds: int = 3600) -> DataFrame:
    """The time each request may run, per provider: not before it comes, nor before the last slot plus the gap.

    slot(k) = max(at(k), slot(k - 1) + gap) is gap * k + the running maximum of at(j) - gap * j. Numbers and maxima are
    taken within buckets of time, and from the buckets before by one row each, so that no task sorts a provider whole.
    """
    gap = int(gap_seconds * 1_000_000)
    timed = requests.withColumn("__at", F.unix_micros(F.col(at).cast("timestamp"))).withColumn("__b", F.floor(F.col("__at") / (bucket_seconds * 1_000_000)))
    inside = Window.partitionBy(provider, "__b").orderBy(at, "event_id")
    local = timed.withColumn("__k", F.row_number().over(inside).cast("long"))
    local = local.withColumn("__top", F.max(F.col("__at") - gap * F.col("__k")).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    sums = local.groupBy(provider, "__b").agg(F.max("__k").alias("__n"), F.max("__top").alias("__best"))
    by = Window.partitionBy(provider).orderBy("__b")
    counted = sums.withColumn("__before", F.sum("__n").over(by) - F.col("__n"))
    # What a bucket's numbers lack is the count of rows before it.
    lead = F.max(F.col("__best") - gap * F.col("__before")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    known = counted.select(F.col(provider).alias("__p"), F.col("__b").alias("__c"), "__before", lead.alias("__lead"))
    made = local.join(known, F.col(provider).eqNullSafe(F.col("__p")) & (F.col("__b") == F.col("__c")))
    number = F.col("__k") + F.col("__before")
    slot = F.greatest(F.col("__top") - gap * F.col("__before"), F.coalesce("__lead", F.col("__top") - gap * F.col("__before"))) + gap * number
    return made.withColumn("slot_us", slot).select(*requests.columns, "slot_us")


def windowed(events: DataFrame, size: str, late: str | None = None) -> DataFrame:
    """Counts and sums per type in tumbling windows; on a stream, with a watermark. Beyond the surveyed operators."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    rows = rows.withWatermark("ts", late) if late else rows
    out = rows.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return out.select(F.unix_micros("w.start").alias("start_us"), "event_type", "n", "total")
