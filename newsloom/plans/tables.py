"""Article-shaped views of the test tables, in Spark and, for the oracle, in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# What a task of a join takes of its larger side, in bytes as stored.
TASK_BYTES = 3_000_000


def stored_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def joined(left: DataFrame, right: DataFrame, left_key: str, right_key: str, parts: int) -> DataFrame:
    """The inner join in `parts` tasks, so that a task doesn't grow with the tables; as Spark has it if the right side is small or parts is 0."""
    small = int(left.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    if parts and stored_bytes(right) > small:
        left, right = left.repartition(parts, left_key), right.repartition(parts, right_key)
    return left.join(right, F.col(left_key) == F.col(right_key))


def signal_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article for each order line: the brand is its topic (Brand#25 the outliers), the customer's nation its risk."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_quantity")
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    parts = -(-stored_bytes(line) // TASK_BYTES)
    parts = parts if parts > spark.sparkContext.defaultParallelism else 0
    # The join by order comes last, so that what groups by order (DUP_GROUP) needs no further shuffle.
    df = joined(joined(line, part, "l_partkey", "p_partkey", parts), joined(order, customer, "o_custkey", "c_custkey", parts), "l_orderkey", "o_orderkey", parts)
    k = F.round(F.col("l_discount") * 100).cast("int") - 5
    return df.select(
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey") % 1_000_000).alias("seq"),
        F.when(F.col("p_brand") == "Brand#25", -1).otherwise(F.substring("p_brand", 7, 2).cast("int")).alias("TOPIC_ID"),
        F.col("c_nationkey").alias("RISK_ID"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("PUBLISHED_DATE"),
        (k / F.lit(5.0)).alias("SENTIMENT_COMPOUND"),
        F.when(k > 0, "Positive").when(k < 0, "Negative").otherwise("Neutral").alias("SENTIMENT"),
        F.col("l_orderkey").alias("DUP_GROUP"),
        F.concat(F.lit("supplier"), F.col("l_suppkey").cast("string")).alias("SOURCE"),
        F.col("p_name").alias("TITLE"),
        F.concat(F.lit("http://x/"), F.col("l_partkey").cast("string")).alias("LINK"),
        (F.col("l_quantity").cast("int") / F.lit(50.0)).alias("QUALITY_SCORE"),
    )


SIGNAL = """signal AS (
  SELECT (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey % 1000000 AS seq,
         CASE WHEN p_brand = 'Brand#25' THEN -1 ELSE CAST(substr(p_brand, 7, 2) AS INTEGER) END AS topic,
         c_nationkey AS risk, strftime(o_orderdate, '%Y-%m') AS month, strftime(o_orderdate, '%Y-%m-%d') AS day,
         CAST(o_orderdate AS TIMESTAMP) AS ts,
         CAST(round(l_discount * 100) AS INTEGER) - 5 AS k, l_orderkey AS grp, 'supplier' || l_suppkey AS source,
         p_name AS title, 'http://x/' || l_partkey AS link, CAST(l_quantity AS INTEGER) / 50.0 AS quality
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey)"""
# Volume, tone and intensity by any keys.
VOLUMES = """{name} AS (
  SELECT {keys}, month, count(*) AS volume, CAST(sum(CASE WHEN k < 0 THEN 1 ELSE 0 END) AS BIGINT) AS neg_articles,
         CAST(sum(CAST(k / 5.0 AS DECIMAL(18,8))) AS DOUBLE) AS total
  FROM signal WHERE topic <> -1 GROUP BY {keys}, month),
{name}_i AS (
  SELECT *, neg_articles / CAST(volume AS DOUBLE) AS share, total / volume AS mean,
         1.0::DOUBLE + neg_articles / CAST(volume AS DOUBLE) + greatest(0.0::DOUBLE, -(total / volume)) AS severity FROM {name}),
{name}_s AS (SELECT *, round(volume * severity, 2) AS intensity FROM {name}_i)"""
CALENDAR = "calendar AS (SELECT month, row_number() OVER (ORDER BY month) - 1 AS idx, count(*) OVER () AS n FROM (SELECT DISTINCT month FROM {of}))"


def dense_sql(keys: str, of: str, name: str = "dense") -> str:
    cols = [k.strip() for k in keys.split(",")]
    on = " AND ".join(f"k.{c} = s.{c}" for c in cols)
    return f"{name} AS (SELECT {', '.join('k.' + c for c in cols)}, c.month, c.idx, c.n, coalesce(s.intensity, 0.0::DOUBLE) AS x FROM (SELECT DISTINCT {keys} FROM {of}) k CROSS JOIN calendar c LEFT JOIN {of} s ON {on} AND s.month = c.month)"


def mean_sql(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,4))) AS DOUBLE) / count({x})"


MOMENTUM = f"""{mean_sql('CASE WHEN n - idx <= 3 THEN x END')} - coalesce(CASE WHEN max(n) >= 6 THEN {mean_sql('CASE WHEN n - idx BETWEEN 4 AND 6 THEN x END')} ELSE {mean_sql('CASE WHEN n - idx > 3 THEN x END')} END, 0.0::DOUBLE)"""


def vec_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as articles: the label is the topic, labels modulo 7 its assigned risk."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("seq"), F.col("label").cast("int").alias("TOPIC_ID"), (F.col("label") % 7).cast("int").alias("RISK_ID"), F.col("embedding").alias("vector"))


def vec_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as taxonomy terms: every one belongs to the risk of its id modulo 7."""
    e = table(spark, sf_dir, "embeddings")
    return e.select((F.col("vec_id") % 7).cast("int").alias("RISK_ID"), F.col("embedding").alias("vector"))


def doc_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles: the first line is the title, the rest the summary; labels give their quality."""
    d, q = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    first = F.substring_index("text", "\n", 1)
    return d.join(q, "doc_id", "left").select(
        F.col("doc_id").alias("seq"),
        first.alias("TITLE"),
        F.substring(F.col("text"), F.length(first) + 2, F.length("text")).alias("SUMMARY"),
        F.col("source").alias("SOURCE"),
        F.col("lang"),
        F.col("text"),
        F.col("quality").alias("QUALITY"),
    )


DOCS = """docs AS (
  SELECT doc_id AS seq, split_part(text, chr(10), 1) AS title, substr(text, length(split_part(text, chr(10), 1)) + 2) AS summary, source, lang, text, quality
  FROM documents LEFT JOIN labels USING (doc_id))"""
