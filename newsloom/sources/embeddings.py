"""Embeddings by the statistics of the corpus: hashed words weighed by how rare they are, projected to unit vectors.

Document frequencies are a table that is kept and added to, so what is rare is learnt from all texts seen so far,
not from those of one run. Every addition is a new version; the version is part of the key that embeddings are
cached under, so vectors of older statistics are not mixed with new ones.

A word's share of a vector is (1 + ln n) * ln((1 + N) / (1 + df)), spread over all positions by signs drawn from a hash of the
word: a random projection, which keeps cosines about as they are among the words themselves. All SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.sources.cache import encode_cached, read_cache

FREQUENCIES = "word string, df long"
VERSIONS = "version int, documents long"
SIZE = 64


def word_counts(texts: DataFrame, key="key", text="text") -> DataFrame:
    """key, word, n: words of letters and digits in lower case."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return texts.select(F.col(key).alias("key"), F.explode(words).alias("word")).groupBy("key", "word").agg(F.count("*").alias("n"))


def _versions(spark: SparkSession, path: str) -> list:
    return sorted((r["version"], r["documents"]) for r in read_cache(spark, f"{path}/versions", VERSIONS).collect())  # a row an addition


def latest(spark: SparkSession, path: str) -> tuple[int, int]:
    """(version, documents it has seen); (0, 0) before the first addition."""
    return max(_versions(spark, path), default=(0, 0))


def frequencies(spark: SparkSession, path: str, version: int) -> DataFrame:
    return read_cache(spark, f"{path}/df/v{version}", FREQUENCIES)


def add_documents(texts: DataFrame, path: str, key="key", text="text") -> int:
    """Add the texts to the statistics at `path`; returns the new version. Texts are counted once for each call."""
    spark = texts.sparkSession
    version, seen = latest(spark, path)
    own = word_counts(texts, key, text).groupBy("word").agg(F.count("*").alias("df"))
    both = frequencies(spark, path, version).unionByName(own).groupBy("word").agg(F.sum("df").alias("df"))
    both.write.mode("overwrite").parquet(f"{path}/df/v{version + 1}")
    n = texts.select(key).distinct().count()
    # The version is noted last: an addition that stops before counts for nothing.
    spark.createDataFrame([(version + 1, seen + n)], VERSIONS).coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return version + 1


def weights(texts: DataFrame, path: str, version: int, key="key", text="text") -> DataFrame:
    """key, word, weight, by the statistics of a version."""
    spark = texts.sparkSession
    seen = dict(_versions(spark, path)).get(version, 0)
    known = frequencies(spark, path, version)
    counted = word_counts(texts, key, text).join(known, "word", "left")
    rare = F.log((F.lit(seen) + 1) / (F.coalesce("df", F.lit(0)) + 1))
    return counted.select("key", "word", ((1 + F.log("n")) * F.greatest(rare, F.lit(0.0))).alias("weight"))


def projected(weighted: DataFrame, size: int = SIZE) -> DataFrame:
    """key, vector: unit vectors of `size`; a key whose words all weigh nothing has a zero vector."""
    # Bit k of a word's hash is its sign at position k; more than 64 positions take further hashes.
    seeds = [F.xxhash64(F.lit(s), F.col("word")) for s in range(-(-size // 64))]
    signs = [(F.shiftrightunsigned(seeds[k // 64], k % 64).bitwiseAND(F.lit(1)) * 2 - 1).cast("int") for k in range(size)]
    # Sums of decimals: the order of the words does not show.
    sums = weighted.groupBy("key").agg(*[F.sum((F.col("weight") * s).cast("decimal(20,10)")).cast("double").alias(f"_{k}") for k, s in enumerate(signs)])
    row = sums.select("key", F.array(*[f"_{k}" for k in range(size)]).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    sized = row.select("key", "v", F.inline(F.array(F.struct(norm.alias("norm")))))
    return sized.select("key", F.transform("v", lambda x: F.when(F.col("norm") > 0, x / F.col("norm")).otherwise(0.0).cast("float")).alias("vector"))


def encode(texts: DataFrame, statistics: str, version: int, size: int = SIZE) -> DataFrame:
    """key, vector of texts (key, text); a text without words has a zero vector."""
    made = projected(weights(texts, statistics, version), size)
    zero = F.array_repeat(F.lit(0.0).cast("float"), size)
    return texts.select("key").distinct().join(made, "key", "left").select("key", F.coalesce("vector", zero).alias("vector"))


def embedded(texts: DataFrame, statistics: str, cache: str, text="text", size: int = SIZE) -> DataFrame:
    """texts with `vector`, through the cache: by the latest statistics, whose version is part of the cached key."""
    version, _ = latest(texts.sparkSession, statistics)
    filled = texts.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    made = encode_cached(filled, lambda fresh: encode(fresh, statistics, version, size), cache, f"tfidf-{size}-v{version}", "_text")
    return made.drop("_text")
