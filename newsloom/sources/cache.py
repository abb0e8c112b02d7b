"""Keyed caches as Parquet tables: misses are an anti-join, results are appended."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.text import cache_key


def read_cache(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The cache, or an empty one of the schema."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def model_place(name: str, candidates: list[str], there) -> tuple[str, bool]:
    """(model to load, whether it is local): the name if it is a model folder, else the first candidate that is, else the name.

    there(path) tells whether a path exists; a model folder holds modules.json.
    """
    for place in (name, *candidates):
        if place and there(f"{place.rstrip('/')}/modules.json"):
            return place, True
    return name, False


def model_places(models: DataFrame, folders: DataFrame) -> DataFrame:
    """model_place() of each row: name, place, local. models: name, candidates (array); folders: path of the folders that hold a model."""
    there = folders.select(F.regexp_replace("path", "/+$", "").alias("_at")).distinct().withColumn("_there", F.lit(True))
    tried = models.select("name", F.posexplode(F.concat(F.array("name"), "candidates")).alias("_n", "_place")).where("_place != ''")
    found = tried.withColumn("_at", F.regexp_replace("_place", "/+$", "")).join(there, "_at").groupBy("name").agg(F.min_by("_place", "_n").alias("place"))
    return models.select("name").join(found, "name", "left").select("name", F.coalesce("place", "name").alias("place"), F.col("place").isNotNull().alias("local"))


def misses(df: DataFrame, cache: DataFrame, key: str = "key") -> DataFrame:
    """Distinct keys that the cache lacks."""
    return df.join(cache.select(key), key, "left_anti").dropDuplicates([key])


def encode_cached(texts: DataFrame, encode: Callable[[DataFrame], DataFrame], path: str, model: str, text="text") -> DataFrame:
    """texts with `vector`; only texts new to the cache are encoded. encode: frame of (key, text) to (key, vector)."""
    keyed = texts.withColumn("key", cache_key(model, F.col(text)))
    spark, schema = texts.sparkSession, "key string, vector array<float>"
    fresh = misses(keyed.select("key", F.col(text).alias("text")), read_cache(spark, path, schema))
    encode(fresh).select("key", F.col("vector").cast("array<float>").alias("vector")).write.mode("append").parquet(path)
    return keyed.join(read_cache(spark, path, schema), "key", "left")


def _slot_counts(size: int):
    """How many words of a list fall to each slot, by the first eight hex digits of their MD5; empty words to none."""

    @F.arrow_udf("array<long>")
    def counts(words: pa.Array) -> pa.Array:
        each = words.flatten().dictionary_encode()
        known = each.dictionary.to_pylist()  # a word is hashed once a batch
        slot = np.array([int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % size if w else -1 for w in known], np.int64)[each.indices.to_numpy()]
        row = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
        n = np.bincount((row * size + slot)[slot >= 0], minlength=len(words) * size)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1, dtype=np.int32) * size), pa.array(n.astype(np.int64)))

    return counts


def hashed_embedding(df: DataFrame, text="text", size=64) -> DataFrame:
    """A stand-in embedder without a model: hashed word counts, damped, of unit length."""
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")
    counts = F.transform(_slot_counts(size)(words), lambda n: F.log1p(n))
    norm = F.sqrt(F.aggregate("_c", F.lit(0.0), lambda a, x: a + x * x)) + F.lit(1e-9)
    return df.withColumn("_c", counts).withColumn("vector", F.transform("_c", lambda x: (x / norm).cast("float"))).drop("_c")
