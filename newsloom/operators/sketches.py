"""Distinct counts that merge: stored sketches for each topic and month, united without reading the articles again.

A sketch takes a fixed number of bytes whatever it counts. Sketches of months unite to those of quarters, of all
time, or of several topics; new articles unite with what is stored. The relative error is about
1.04 / sqrt(2 ** precision) for one standard deviation: 1.6 % at 12.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRECISION = 12


def monthly(articles: DataFrame, value: Column | str = "DUP_GROUP", keys: tuple[str, ...] = ("TOPIC_ID",), month="month", precision: int = PRECISION) -> DataFrame:
    """keys, month, sketch of the distinct values; nulls are not counted."""
    v = F.col(value) if isinstance(value, str) else value
    rows = articles.select(*keys, F.col(month).alias("month"), v.cast("string").alias("_v")).where("_v is not null")
    return rows.groupBy(*keys, "month").agg(F.hll_sketch_agg("_v", precision).alias("sketch"))


def merged(stored: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("TOPIC_ID",)) -> DataFrame:
    """Stored sketches united with those of new articles."""
    return stored.unionByName(new).groupBy(*keys, "month").agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_counts(stored: DataFrame, *keys: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """keys, n: about how many distinct values the months from `first` to `last` have together."""
    rows = stored
    if first is not None:
        rows = rows.where(F.col("month") >= first)
    if last is not None:
        rows = rows.where(F.col("month") <= last)
    return rows.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"))


def error(precision: int = PRECISION, deviations: float = 4.0) -> float:
    """The relative error that a count exceeds hardly ever."""
    return deviations * 1.04 / 2 ** (precision / 2)
