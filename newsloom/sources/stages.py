"""Reading and writing the tables between stages."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.schemas import ARTICLE, with_defaults


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared folder, deleted when the application ends."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = "/tmp/newsloom-checkpoints"
    path = f"{where.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(at)
    system.deleteOnExit(at)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_articles(spark: SparkSession, path: str, schema: T.StructType = ARTICLE) -> DataFrame:
    """Article rows of a CSV or Parquet path; columns the file lacks are typed nulls."""
    if path.rstrip("/").endswith(".csv"):
        raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
        known = {f.name.lower(): f for f in schema}
        typed = [F.col(f"`{c}`").try_cast(known[c.lower()].dataType).alias(c) if c.lower() in known and isinstance(known[c.lower()].dataType, T.NumericType) else F.col(f"`{c}`") for c in raw.columns]
        return with_defaults(raw.select(*typed), schema)
    return with_defaults(spark.read.parquet(path), schema)


def write_stage(df: DataFrame, path: str, by_month: str | None = None, csv: bool = False) -> None:
    """Parquet, laid out by month where a month column is named; CSV with arrays joined by ", "."""
    if csv:
        flat = [F.array_join(F.transform(c, lambda x: x.cast("string")), ", ").alias(c) if isinstance(df.schema[c].dataType, T.ArrayType) else F.col(c) for c in df.columns]
        # Quotes are doubled, as read_articles and other readers of CSV expect; white space at the ends of texts stays.
        kept = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        df.select(*flat).write.mode("overwrite").options(**kept).csv(path)
    elif by_month:
        df.repartition(by_month).write.mode("overwrite").partitionBy(by_month).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_version(df: DataFrame, path: str) -> int:
    """Write the next version of a table beside the others; the one before stays readable until this one is whole."""
    number = (versions(df.sparkSession, path) or [-1])[-1] + 1
    df.write.mode("overwrite").parquet(f"{path}/v={number}")
    return number


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that were written to their end."""
    whole = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v=*/_SUCCESS")
    found = whole.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(whole) or []
    return sorted(int(f.getPath().getParent().getName()[2:]) for f in found)


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """A version of a table, the newest whole one unless a number is given."""
    known = versions(spark, path)
    if not known or (number is not None and number not in known):
        raise FileNotFoundError(f"no such version under {path}")
    return spark.read.parquet(f"{path}/v={known[-1] if number is None else number}")


def read_files(spark: SparkSession, path: str, extract: Callable[[bytes], str], pattern: str = "*") -> DataFrame:
    """name, text of binary files (such as PDF); the extractor is the user's, its errors give empty texts."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for content in pdf["content"]:
                try:
                    out.append(extract(bytes(content)) or "")
                except Exception:  # a broken file must not end the scan
                    out.append("")
            yield pd.DataFrame({"name": pdf["path"].str.rsplit("/", n=1).str[-1], "text": out})

    return files.mapInPandas(run, "name string, text string")
