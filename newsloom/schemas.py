"""Declared schemas; nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The article table, the fact table every lane is normalised to.
ARTICLE = T.StructType(
    [
        T.StructField("RISK_ID", T.IntegerType()),
        T.StructField("SEARCH_TERM_ID", T.StringType()),
        T.StructField("GOOGLE_INDEX", T.IntegerType()),
        T.StructField("TITLE", T.StringType()),
        T.StructField("LINK", T.StringType()),
        T.StructField("PUBLISHED_DATE", T.StringType()),
        T.StructField("SUMMARY", T.StringType()),
        T.StructField("KEYWORDS", T.StringType()),
        T.StructField("SENTIMENT_COMPOUND", T.DoubleType()),
        T.StructField("SENTIMENT", T.StringType()),
        T.StructField("SOURCE", T.StringType()),
        T.StructField("CATEGORY", T.StringType()),
        T.StructField("QUALITY_SCORE", T.DoubleType()),
    ]
)

# What enrichment, deduplication and clustering add.
TOPIC_COLUMNS = T.StructType(
    [
        T.StructField("ENTITIES", T.ArrayType(T.StringType())),
        T.StructField("NLP_KEYWORDS", T.ArrayType(T.StringType())),
        T.StructField("DUP_GROUP", T.LongType()),
        T.StructField("IS_DUPLICATE", T.BooleanType()),
        T.StructField("TOPIC_ID", T.IntegerType()),
        T.StructField("TOPIC_LABEL", T.StringType()),
        T.StructField("TOPIC_DESCRIPTION", T.StringType()),
        T.StructField("TOPIC_TITLE", T.StringType()),
    ]
)

TAXONOMY_FILE = T.StructType([T.StructField("RISK_ID", T.StringType()), T.StructField("SEARCH_TERM_ID", T.StringType()), T.StructField("ENCODED_TERMS", T.StringType())])


def with_defaults(df: DataFrame, schema: T.StructType = ARTICLE) -> DataFrame:
    """Add the schema's missing columns as typed nulls and cast the others; further columns stay behind them."""
    own = {c.lower(): c for c in df.columns}
    named = [(F.col(own[f.name.lower()]) if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    names = {f.name.lower() for f in schema}
    return df.select(*named, *[c for c in df.columns if c.lower() not in names])
