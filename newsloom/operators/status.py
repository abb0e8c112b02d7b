"""Status of each risk against its own robust baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.trends import calendar, dense, exact_mean, with_length

STATUS_ORDER = ["Escalating", "Elevated", "Stable", "Cooling", "Quiet"]
MIN_VOLUME = 10.0
BAND = 1.5
ESCALATING, ESCALATING_ABOVE, COOLING = 0.5, 0.15, -0.3


def complete_months(months: DataFrame, as_of: str | None = None) -> DataFrame:
    """Without the last month if it is that of `as_of` (yyyy-MM), which is then still running."""
    if as_of is None:
        return months
    last = F.max("month").over(Window.partitionBy())
    return months.withColumn("_last", last).where((F.col("month") != F.col("_last")) | (F.col("month") != as_of)).drop("_last")


def risk_months(by_risk: DataFrame) -> DataFrame:
    """Summed intensity of each risk and month, one decimal."""
    return by_risk.groupBy("RISK_ID", "month").agg(F.round(F.sum(F.col("intensity").cast("decimal(18,4)")).cast("double"), 1).alias("intensity"))


def classify(by_risk: DataFrame, as_of: str | None = None, min_volume: float = MIN_VOLUME) -> DataFrame:
    """RISK_ID, status, latest, median, band_hi, mom_pct. by_risk: RISK_ID, TOPIC_ID, month, intensity."""
    months = calendar(complete_months(by_risk.select("month").where("month IS NOT NULL").distinct(), as_of))
    every = by_risk.select("RISK_ID").distinct()
    series = every.select("RISK_ID").crossJoin(F.broadcast(with_length(months))).join(risk_months(by_risk), ["RISK_ID", "month"], "left").withColumn("x", F.coalesce("intensity", F.lit(0.0)))
    rank = F.col("n_months") - F.col("idx")
    first = series.groupBy("RISK_ID").agg(
        F.first("n_months").alias("n"),
        F.max("x").alias("top"),
        F.max(F.when(rank == 1, F.col("x"))).alias("latest"),
        F.median(F.when(rank > 1, F.col("x"))).alias("median"),
        F.stddev_pop(F.when(rank > 1, F.col("x"))).alias("std"),
        exact_mean(F.when(rank <= 3, F.col("x"))).alias("recent"),
        exact_mean(F.when(rank.between(4, 6), F.col("x"))).alias("mid"),
        exact_mean(F.when(rank > 3, F.col("x"))).alias("older"),
    )
    away = series.join(first.select("RISK_ID", "median"), "RISK_ID").where(rank > 1).groupBy("RISK_ID").agg(F.median(F.abs(F.col("x") - F.col("median"))).alias("mad"))
    base = every.join(first, "RISK_ID", "left").join(away, "RISK_ID", "left")
    spread = F.coalesce(F.when(F.col("mad") > 0, F.col("mad")), F.when(F.col("std") > 0, F.col("std")), F.lit(1.0))
    prior = F.when(F.col("n") >= 6, F.col("mid")).when(F.col("n") > 3, F.col("older")).otherwise(F.col("median"))
    base = base.withColumns({"band_hi": F.col("median") + BAND * spread, "prior": prior})
    base = base.withColumn("mom", (F.col("recent") - F.col("prior")) / F.when(F.col("prior") > 0, F.col("prior")).otherwise(1.0))
    above, material = F.col("latest") > F.col("band_hi"), F.col("latest") >= min_volume
    status = (
        F.when(F.coalesce(F.col("n") < 2, F.lit(True)) | (F.col("top") <= 0), "Quiet")
        .when(material & ((F.col("mom") >= ESCALATING) | (above & (F.col("mom") >= ESCALATING_ABOVE))), "Escalating")
        .when(material & above, "Elevated")
        .when((F.col("mom") <= COOLING) & (F.col("median") > 0), "Cooling")
        .otherwise("Stable")
    )
    shown = lambda c, d: F.when(F.col("status") != "Quiet", F.round(c, d))
    return base.withColumn("status", status).select("RISK_ID", "status", shown(F.col("latest"), 1).alias("latest"), shown(F.col("median"), 1).alias("median"), shown(F.col("band_hi"), 1).alias("band_hi"), shown(F.col("mom") * 100, 0).alias("mom_pct"))


def status_order(column="status"):
    return F.array_position(F.array(*[F.lit(s) for s in STATUS_ORDER]), F.col(column))


def tiles(classified: DataFrame) -> DataFrame:
    """In order of urgency, then of the latest value."""
    return classified.orderBy(status_order(), F.desc(F.coalesce("latest", F.lit(0.0))), "RISK_ID")


def status_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("status").agg(F.count("*").alias("n"))


def drivers(by_risk: DataFrame, as_of: str | None = None, n: int = 3) -> DataFrame:
    """The n topics of most intensity of each risk in the last complete month; only those above 0."""
    months = complete_months(by_risk.select("month").distinct(), as_of).agg(F.max("month").alias("month"))
    last = by_risk.join(F.broadcast(months), "month")
    rank = F.row_number().over(Window.partitionBy("RISK_ID").orderBy(F.desc("intensity"), "TOPIC_ID"))
    return last.withColumn("rank", rank).where(F.col("rank") <= n).where("intensity > 0").select("RISK_ID", "rank", "TOPIC_ID", "intensity")


def series_by_risk(by_risk: DataFrame) -> DataFrame:
    """Each risk's dense monthly series, as an array in the order of the months."""
    full = dense(risk_months(by_risk), ["RISK_ID"], with_length(calendar(by_risk)), "intensity")
    return full.groupBy("RISK_ID").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "intensity"))), lambda s: s["intensity"]).alias("series"))
