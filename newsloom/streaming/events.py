"""Streaming forms: windowed counts, sessions, deduplicated ingestion.

Each takes a streaming or a static frame, so that results can be held against batch ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.sources.stages import scratch
from newsloom.streaming.parts import Parts, delete, exists, read_version

LATE = "1 hour"


def read_events(spark: SparkSession, path: str, schema, max_files: int = 1) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def stamped(events: DataFrame, ts="ts", late=LATE) -> DataFrame:
    df = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, late) if df.isStreaming else df


def tumbling(events: DataFrame, width="1 day", key="event_type", ts="ts", late=LATE) -> DataFrame:
    """Count and sum of values of each key and window; in append mode a window comes when it is closed."""
    w = stamped(events, ts, late).groupBy(F.window(ts, width), key).agg(F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))
    return w.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), key, "n", "cents")


def sliding(events: DataFrame, width="2 days", step="1 day", key="event_type", ts="ts", late=LATE) -> DataFrame:
    w = stamped(events, ts, late).groupBy(F.window(ts, width, step), key).agg(F.count("*").alias("n"))
    return w.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), key, "n")


def sessions(events: DataFrame, gap="6 hours", key="user_id", ts="ts", late=LATE) -> DataFrame:
    w = stamped(events, ts, late).groupBy(F.session_window(ts, gap), key).agg(F.count("*").alias("n"))
    return w.select(key, F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss").alias("session_start"), "n")


def deduplicated(articles: DataFrame, key: str, ts="ts", late="7 days") -> DataFrame:
    """Each key once within the watermark."""
    df = stamped(articles, ts, late)
    return df.dropDuplicatesWithinWatermark([key]) if df.isStreaming else df.dropDuplicates([key])


def to_table(stream: DataFrame, mode="append") -> DataFrame:
    """Run a stream over what there is into a Parquet table and read that; nothing is gathered on the driver.

    In complete mode each batch replaces the table, open windows included; in append mode each adds its rows.
    """
    spark, path = stream.sparkSession, scratch(stream.sparkSession, "stream")

    def each(batch: DataFrame, number: int) -> None:
        # A batch that runs again writes the same folder.
        batch.write.mode("overwrite").parquet(f"{path}/out/all" if mode == "complete" else f"{path}/out/n={number}")

    stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    found = spark.read.schema(stream.schema).option("recursiveFileLookup", True)
    return found.parquet(f"{path}/out") if exists(spark, f"{path}/out") else spark.createDataFrame([], stream.schema)


def upsert_each_batch(stream: DataFrame, path: str, merge: Callable[[DataFrame, DataFrame], DataFrame], checkpoint: str):
    """Merge every micro-batch into the versioned table at `path`; returns the query.

    Versions are folders named by batch number, so a batch that is run again writes the same one. Every
    batch but the first needs the version before it, and stops with an error where that is missing; the
    versions before that one are deleted. Each batch writes the whole table: see upsert_parts().
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = f"{path}/v{number - 1}"
        if number and not exists(spark, before):
            raise FileNotFoundError(f"batch {number} needs the version before it, {before}")
        old = spark.read.parquet(before) if number else batch.limit(0)
        merge(old, batch).write.mode("overwrite").parquet(f"{path}/v{number}")
        delete(spark, f"{path}/v{number - 2}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_parts(spark: SparkSession, path: str, number: int, schema) -> DataFrame:
    """Version `number` of a table that upsert_parts() writes."""
    return read_version(spark, path, number, "parts", schema)


def upsert_parts(stream: DataFrame, path: str, merge: Callable[[DataFrame, DataFrame], DataFrame], key: Column, checkpoint: str, parts: int = 64):
    """Merge every micro-batch into a table dealt into `parts` by a hash of the key; returns the query.

    A batch reads and writes only the parts that its rows fall into (see parts.py); a part of which merge leaves
    nothing is gone. Rows of one key must have one value of `key`, and merge must not need rows of other keys.
    """

    def each(batch: DataFrame, number: int) -> None:
        table = Parts(batch.sparkSession, path, number, parts)
        rows = batch.persist()
        touched = table.touched(rows, key)
        table.write("parts", merge(table.read("parts", batch.schema, touched), rows), key, touched)
        table.commit()
        rows.unpersist()

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_end(stream: DataFrame, name: str, mode="append") -> DataFrame:
    """Run a stream over what there is into a memory table; for tests and small queries."""
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)
