"""Closed windows and late rows as two tables, by a stateful operator with event-time timers.

A window goes out once, when the watermark passes its end, and its state is cleared then. A row that comes after
its window went out is late: it goes to the table of late rows, so that whoever keeps the counts can add it
where it belongs, and changes no window. Spark itself would drop such rows before the operator sees them; it
is therefore told a watermark that stands `GRACE` behind ours, and timers are set that much earlier. Rows even
later than that are dropped, and counted in the progress of the query.

A key of many rows is dealt into `salts`, each counted by itself; all salts of a window close in the same
batch, where the counts are added up.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from newsloom.sources.stages import scratch
from newsloom.streaming.parts import exists

GRACE_DAYS = 3650
DAY_MS = 86_400_000
OUT = "key string, kind string, period string, n long, cents long, ts timestamp, value double"
CLOSED = "key string, period string, n long, cents long"
LATE_ROWS = "key string, period string, ts timestamp, value double"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def end_of(period: pd.Period) -> int:
    """The first millisecond after a period, in UTC."""
    return (period + 1).start_time.value // 1_000_000


class ClosedPeriods(StatefulProcessor):
    """Counts and sums of each period (a month, a day: freq as pandas names it) of a key, held until it is closed."""

    def __init__(self, freq: str):
        self.freq = freq

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "period string", "n long, cents long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() + GRACE_DAYS * DAY_MS
        for pdf in rows:
            for period, part in pdf.groupby(pdf["ts"].dt.to_period(self.freq)):
                if end_of(period) <= now:
                    yield pd.DataFrame({"key": key[0], "kind": "late", "period": str(period), "n": None, "cents": None, "ts": part["ts"], "value": part["value"]}).astype({"n": "Int64", "cents": "Int64"})
                    continue
                name = (str(period),)
                n, cents = self.held.getValue(name) if self.held.containsKey(name) else (0, 0)
                if not n:
                    self.handle.registerTimer(end_of(period) - GRACE_DAYS * DAY_MS)
                self.held.updateValue(name, (n + len(part), cents + int((part["value"].fillna(0) * 100).round().sum())))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        end = pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs() + GRACE_DAYS * DAY_MS, unit="ms")
        name = (str((end - pd.Timedelta(milliseconds=1)).to_period(self.freq)),)
        if self.held.containsKey(name):
            n, cents = self.held.getValue(name)
            self.held.removeKey(name)
            yield pd.DataFrame({"key": [key[0]], "kind": ["closed"], "period": [name[0]], "n": [n], "cents": [cents], "ts": [pd.NaT], "value": [None]}).astype({"ts": "datetime64[ns]", "value": float})

    def close(self) -> None:
        pass


def closed_periods(events: DataFrame, key: str, freq: str = "M", ts="ts", value="value", late="1 hour", salts: int = 8) -> DataFrame:
    """A stream of closed periods (kind "closed") and of late rows (kind "late") of a stream of events."""
    rows = events.select(F.col(key).cast("string").alias("key"), F.col(ts).cast("timestamp").alias("ts"), F.col(value).cast("double").alias("value")).where("key is not null and ts is not null")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("ts", "value"), F.lit(salts)).cast("int")).withWatermark("ts", f"{GRACE_DAYS} days {late}")
    return rows.groupBy("key", "salt").transformWithStateInPandas(ClosedPeriods(freq), OUT, "append", "eventTime")


def keep_periods(stream: DataFrame, path: str):
    """Run a stream of closed_periods() over what there is; returns the query. Its tables are closed_table() and late_rows()."""

    def each(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        closed = rows.where("kind = 'closed'").groupBy("key", "period").agg(F.sum("n").alias("n"), F.sum("cents").alias("cents"))
        closed.write.mode("overwrite").parquet(f"{path}/closed/batch={number}")  # a batch that runs again writes the same folder
        rows.where("kind = 'late'").select("key", "period", "ts", "value").write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        rows.unpersist()

    # Map state needs this store; other streams of the session keep theirs.
    conf, setting = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(setting)
    conf.set(setting, PROVIDER)
    try:
        return stream.writeStream.foreachBatch(each).outputMode("append").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    finally:
        conf.set(setting, before)


def _table(spark, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def closed_table(spark, path: str) -> DataFrame:
    return _table(spark, f"{path}/closed", CLOSED)


def late_rows(spark, path: str) -> DataFrame:
    return _table(spark, f"{path}/late", LATE_ROWS)


def run_periods(stream: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(closed periods, late rows) of a stream of closed_periods(), over what there is."""
    spark, path = stream.sparkSession, scratch(stream.sparkSession, "periods")
    keep_periods(stream, path).awaitTermination()
    return closed_table(spark, path), late_rows(spark, path)
