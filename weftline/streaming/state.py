"""Keyed state on streams (X4, X5): reserved slots per provider, and the progress of declared work with retries.

State lives in the stream's checkpoint under its key, so that a restart goes on where the stream stopped, and a batch that
is run again starts from the state before it. What a micro-batch brings for one key is held together; the trigger's
options bound micro-batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How long a failed attempt waits before its item is pending again.
WAIT_US = 3_600_000_000
#: Numbers of items whose completed ones are one value of the state.
CHUNK = 1 << 16


class Slots(StatefulProcessor):
    """Rows (event_id, us) of a provider get slots in order of time: none before it comes, none before the last plus a gap."""

    def __init__(self, gap_us: int):
        self.gap = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.free = handle.getValueState("free", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["us", "event_id"])
        step = self.gap * pd.RangeIndex(len(batch)).to_series(index=batch.index)
        held = self.free.get()
        ahead = (batch["us"] - step).clip(lower=held[0] if held else None).cummax()
        slot = ahead + step
        self.free.update((int(slot.iloc[-1]) + self.gap,))
        yield pd.DataFrame({"event_id": batch["event_id"], "slot_us": slot.astype("int64")})


class Progress(StatefulProcessor):
    """Attempts (item, us, ok, used) of a unit. An item is pending until an attempt succeeds; after one that fails it waits
    for retry, and a timer makes it pending again. Completed items stay completed and are listed in declared order. They are
    held by chunks of CHUNK numbers: each call to the state is a message, so there is none for each item."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.done = handle.getMapState("done", "chunk long", "items binary, used binary")
        self.waiting = handle.getMapState("waiting", "item long", "until long")
        self.totals = handle.getValueState("totals", "used double, failed double, attempts long")
        self.swept = handle.getValueState("swept", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        used, failed, attempts = self.totals.get() or (0.0, 0.0, 0)
        before = {k[0]: v[0] for k, v in self.waiting.iterator()}
        waiting, chunks, changed = dict(before), {}, set()
        for batch in rows:
            attempts += len(batch)
            used += float(batch.loc[batch["ok"], "used"].sum())
            failed += float(batch.loc[~batch["ok"], "used"].sum())
            for chunk, g in batch.groupby(batch["item"] // CHUNK):
                held = chunks[chunk] if chunk in chunks else self._chunk(int(chunk))
                done = g.loc[g["ok"]].groupby("item")["used"].sum()
                if len(done):
                    held = held.add(done, fill_value=0.0)
                    changed.add(chunk)
                chunks[chunk] = held
                for item, us in g.loc[~g["ok"] & ~g["item"].isin(held.index)].groupby("item")["us"].max().items():
                    waiting[item] = max(us + WAIT_US, waiting.get(item, us + WAIT_US))
        for chunk in changed:
            self.done.updateValue((int(chunk),), (chunks[chunk].index.to_numpy(np.int64).tobytes(), chunks[chunk].to_numpy(np.float64).tobytes()))
        for item in [i for i in waiting if (i // CHUNK) in changed and i in chunks[i // CHUNK].index]:
            del waiting[item]
        for item in before.keys() - waiting.keys():
            self.waiting.removeKey((int(item),))
        late = [(item, until) for item, until in waiting.items() if before.get(item) != until]
        for item, until in late:
            self.waiting.updateValue((int(item),), (int(until),))
        for at in {-(-int(until) // 1000) for _, until in late}:
            self.handle.registerTimer(at)
        if late:
            self.swept.clear()
        self.totals.update((used, failed, attempts))
        yield self._row(key)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The first of the timers that expire together ends the waiting of all items whose time has come."""
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        swept = self.swept.get()
        if swept and swept[0] >= now:
            return
        self.swept.update((now,))
        over = [k[0] for k, v in self.waiting.iterator() if v[0] <= now * 1000]
        for item in over:
            self.waiting.removeKey((item,))
        if over:
            yield self._row(key)

    def _chunk(self, chunk: int) -> pd.Series:
        """What the completed items of a chunk have used."""
        held = self.done.getValue((chunk,)) if self.done.containsKey((chunk,)) else (b"", b"")
        return pd.Series(np.frombuffer(held[1], np.float64), np.frombuffer(held[0], np.int64))

    def _row(self, key) -> pd.DataFrame:
        used, failed, attempts = self.totals.get()
        done = np.sort(np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(v[0], np.int64) for v in self.done.values())])).tolist()
        return pd.DataFrame({"unit": [key[0]], "completed": [",".join(map(str, done))], "n_completed": [len(done)], "n_retry": [sum(1 for _ in self.waiting.keys())], "used": [used], "failed": [failed], "attempts": [attempts]})


def _run(made: DataFrame, out: str, state: str) -> None:
    """Writes each micro-batch of a stream under its own number, until all that is there has been read."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={number}")

    made.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def _stream(spark: SparkSession, folder: str, name: str, schema: str, files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(folder)


def run_slots(spark: SparkSession, folder: str, name: str, schema: str, out: str, state: str, gap_us: int, files: int | None = None) -> None:
    """Appends (event_id, slot_us) of the events not seen yet to out; a provider is an event type."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    rows = _stream(spark, folder, name, schema, files).select("event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    _run(rows.groupBy("event_type").transformWithStateInPandas(Slots(gap_us), "event_id long, slot_us long", "Update", "None"), out, state)


_PROGRESS = "unit long, completed string, n_completed long, n_retry long, used double, failed double, attempts long"


def run_progress(spark: SparkSession, folder: str, name: str, schema: str, out: str, state: str, files: int | None = None) -> None:
    """Appends the progress of the units that change to out, from rows (unit, item, ts, ok, used)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    rows = attempts(_stream(spark, folder, name, schema, files)).withWatermark("ts", "0 seconds")
    _run(rows.groupBy("unit").transformWithStateInPandas(Progress(), _PROGRESS, "Update", "EventTime"), out, state)


def attempts(events: DataFrame) -> DataFrame:
    """Events as attempts: four in a row are of one item, fifty units take turns, errors are failures."""
    item = F.floor(F.col("event_id") / 4)
    return events.select((item % 50).alias("unit"), item.alias("item"), F.col("ts").cast("timestamp").alias("ts"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), (F.col("event_type") != "error").alias("ok"), F.col("value").alias("used"))


def latest(spark: SparkSession, out: str) -> DataFrame:
    """The last row of each unit: of its last batch, the one after most attempts and fewest that wait."""
    by = Window.partitionBy("unit").orderBy(F.desc("batch_id"), F.desc("attempts"), "n_retry")
    return spark.read.parquet(out).withColumn("r", F.row_number().over(by)).where("r = 1").drop("r", "batch_id")
