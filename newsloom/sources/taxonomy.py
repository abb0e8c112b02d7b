"""The encoded taxonomy: terms are decimal numbers whose little-endian bytes are UTF-8 text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.schemas import TAXONOMY_FILE


def decode_number(value: str | None) -> str | None:
    """The text of one encoded term; None where it is no whole number or no UTF-8."""
    try:
        n = int(str(value).strip())
        return n.to_bytes((n.bit_length() + 7) // 8, "little").decode("utf-8")
    except (ValueError, OverflowError):
        return None


def encode_text(text: str) -> str:
    """The number that decodes to a text."""
    return str(int.from_bytes(text.encode(), "little"))


@F.pandas_udf(T.StringType())
def decoded(values: pd.Series) -> pd.Series:
    """Numbers of a hundred digits fit no SQL type, so this goes through pandas."""
    return values.map(decode_number)


def read_taxonomy(spark: SparkSession, path: str, namespace: str | None = None) -> DataFrame:
    """RISK_ID, term_no, term of a taxonomy file; undecodable terms go, quotes and edge spaces too."""
    rows = spark.read.schema(TAXONOMY_FILE).option("header", True).option("enforceSchema", True).csv(path)
    return decode_taxonomy(rows, namespace)


def decode_taxonomy(rows: DataFrame, namespace: str | None = None) -> DataFrame:
    term = F.trim(F.btrim(F.trim(decoded("ENCODED_TERMS")), F.lit('"')))
    out = rows.select(F.col("RISK_ID").try_cast("double").cast("int").alias("RISK_ID"), F.col("SEARCH_TERM_ID").try_cast("int").alias("term_no"), term.alias("term"))
    out = out.where("term IS NOT NULL AND term != '' AND RISK_ID IS NOT NULL")
    return out.withColumn("namespace", F.lit(namespace)) if namespace else out


def risk_map(terms: DataFrame) -> DataFrame:
    """RISK_ID, label (its first term), terms in the order of the file. A risk has a handful of terms."""
    keys = [c for c in ("namespace", "RISK_ID") if c in terms.columns]
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("term_no", "term"))), lambda s: s["term"])
    return terms.groupBy(*keys).agg(ordered.alias("terms")).withColumn("label", F.element_at("terms", 1))


def undecodable(rows: DataFrame) -> DataFrame:
    """How many rows of the file have no text."""
    return rows.agg(F.count_if(decoded("ENCODED_TERMS").isNull()).alias("undecodable"))


def both(first: DataFrame, second: DataFrame, names=("ENT", "EMG")) -> DataFrame:
    """The union of two taxonomies, ids told apart by a namespace."""
    return first.withColumn("namespace", F.lit(names[0])).unionByName(second.withColumn("namespace", F.lit(names[1])))


