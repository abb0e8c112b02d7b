"""What fetching needs of an engine: request plans, and a transport that the user supplies.

The library opens no connection itself. A transport takes a URL and returns (status, body); it runs
on executors, a bounded number of requests in each task, and its failures become rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions.text import date_windows
from newsloom.sources.cache import read_cache

FETCHED = "url string, status int, body binary"
Transport = Callable[[str], tuple[int, bytes]]
PERMANENT = (404,)  # regulators also answer 403 to clients that only ask too fast


def plans(scans: DataFrame, categories: DataFrame, days: int, pages: int, cap: int) -> DataFrame:
    """Requests of archive scans: of each scan, date windows by categories by pages, the first `cap` of them.

    scans: scan, start, end (dates); categories: scan, category_no, category. Adds window_start, window_end, page.
    """
    windows = scans.select("scan", F.explode(date_windows("start", "end", days)).alias("w")).select("scan", "w.*")
    every = windows.join(categories, "scan").withColumn("page", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(pages).cast("bigint"))))
    place = F.row_number().over(Window.partitionBy("scan").orderBy("window_start", "category_no", "page"))
    return every.withColumn("place", place).where(F.col("place") <= cap)


def plan(spark: SparkSession, start: str, end: str, days: int, categories: list[str], pages: int, cap: int) -> DataFrame:
    """Requests of one archive scan, in order."""
    scans = spark.range(1).select(F.col("id").alias("scan"), F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))
    wanted = spark.createDataFrame([(0, i, c) for i, c in enumerate(categories)], "scan long, category_no int, category string")
    return plans(scans, wanted, days, pages, cap).orderBy("place").drop("scan", "place")


def with_retries(transport: Transport, url: str, tries=3, wait=2.0, sleep=time.sleep, permanent=PERMANENT) -> tuple[int, bytes]:
    """Up to `tries` requests, waiting twice as long each time; permanent statuses end it at once, an empty answer does not."""
    status, body = 0, b""
    for k in range(tries):
        try:
            status, body = transport(url)
        except OSError as error:
            status, body = 0, str(error).encode()
        if status == 200 and body or status in permanent:
            break
        if k + 1 < tries:
            sleep(wait * 2**k)
    return status, body


def fetched(urls: DataFrame, transport: Transport, url="url", tries=3, wait=2.0) -> DataFrame:
    """url, status, body of each distinct URL."""

    def run(frames):
        for pdf in frames:
            got = [with_retries(transport, u, tries, wait) for u in pdf[url]]
            yield pd.DataFrame({"url": pdf[url], "status": [s for s, _ in got], "body": [b for _, b in got]})

    return urls.select(url).distinct().mapInPandas(run, FETCHED)


def fetched_once(urls: DataFrame, transport: Transport, path: str, slices: int = 20, url="url", tries=3) -> DataFrame:
    """fetched() through a cache at `path`: addresses it lacks are fetched slice by slice, each appended when done.

    A run that is stopped and started again asks only for what is missing. Failures are not kept.
    """
    spark = urls.sparkSession
    wanted = urls.select(F.col(url).alias("url")).distinct()
    for k in range(slices):
        have = read_cache(spark, path, FETCHED)
        part = wanted.where(F.pmod(F.xxhash64("url"), F.lit(slices)) == k).join(have.select("url"), "url", "left_anti")
        fetched(part, transport, "url", tries).where("status = 200 and length(body) > 0").write.mode("append").parquet(path)
    return wanted.join(read_cache(spark, path, FETCHED), "url")


def phrase_lane(df: DataFrame, phrases: list[str], text: str) -> DataFrame:
    """The local form of phrase queries: rows that hold a phrase, with the first one as their category."""
    low = F.lower(F.col(text))
    hit = F.filter(F.array(*[F.lit(p) for p in phrases]), lambda p: F.contains(low, F.lower(p)))
    return df.withColumn("CATEGORY", F.concat(F.lit("lex:"), F.try_element_at(hit, F.lit(1)))).where("CATEGORY IS NOT NULL")
