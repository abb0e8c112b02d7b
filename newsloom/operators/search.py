"""Search of cards by substring, through a stored index of trigrams.

The index has three tables: the cards' searchable texts; postings: for each three characters in a row the
cards that have them, in lists of what a task met together; and how many cards have each trigram. A query of
three letters or more reads the postings of the RAREST rarest of its own trigrams and intersects them; what is
left is looked at itself, so the result is that of a scan. Postings are dealt by trigram into sorted files, so a
query reads little of them. Shorter queries have no trigram and scan the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAREST = 6
TEXTS = "TOPIC_ID long, blob string"
POSTINGS = "gram string, first long, cards array<long>"
# Postings that a task packs into lists at a time.
PACKED = 2_000_000


def blob(columns: list[str], key="TOPIC_ID"):
    """What a card is searched by: its columns and "topic <id>", in lower case, as the scan has it."""
    return F.lower(F.concat_ws(" ", *columns, F.concat(F.lit("topic "), F.col(key).cast("string"))))


def trigrams(text: str) -> np.ndarray:
    """The distinct runs of three characters of a text, each as one number of 21 bits a character."""
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.unique(c[:-2] << 42 | c[1:-1] << 21 | c[2:])


def _spelled(gram: int) -> str:
    return chr(gram >> 42) + chr(gram >> 21 & 0x1FFFFF) + chr(gram & 0x1FFFFF)


def _packed(batches):
    """Batches of (TOPIC_ID, blob) as postings; a list holds the cards of PACKED postings that have its trigram."""
    ids, grams, n = [], [], 0

    def lists():
        gram, card = np.concatenate(grams), np.repeat(np.array(ids, np.int64), [len(g) for g in grams])
        by = np.lexsort((card, gram))
        gram, card = gram[by], card[by]
        start = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        cards = pa.ListArray.from_arrays(pa.array(np.r_[start, len(card)].astype(np.int32)), pa.array(card))
        return pa.RecordBatch.from_arrays([pa.array([_spelled(g) for g in gram[start].tolist()], pa.string()), pa.array(card[start]), cards], ["gram", "first", "cards"])

    for batch in batches:
        for card, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            found = trigrams(text.as_py())
            if len(found):
                ids.append(card)
                grams.append(found)
                n += len(found)
            if n >= PACKED:
                yield lists()
                ids, grams, n = [], [], 0
    if n:
        yield lists()


def write_index(cards: DataFrame, path: str, columns: list[str], key="TOPIC_ID") -> None:
    """Write the index of the cards at `path`, in place of what is there."""
    spark = cards.sparkSession
    texts = cards.select(F.col(key).cast("long").alias("TOPIC_ID"), blob(columns, key).alias("blob"))
    texts.write.mode("overwrite").parquet(f"{path}/texts")
    # The lists are written before they are dealt out, as ranges are drawn from them first.
    spark.read.schema(TEXTS).parquet(f"{path}/texts").mapInArrow(_packed, POSTINGS).write.mode("overwrite").parquet(f"{path}/lists")
    lists = spark.read.schema(POSTINGS).parquet(f"{path}/lists")
    # A frequent trigram is spread over several files: its postings are dealt by range of (gram, card).
    lists.repartitionByRange("gram", "first").sortWithinPartitions("gram", "first").write.mode("overwrite").parquet(f"{path}/postings")
    often = lists.groupBy("gram").agg(F.sum(F.size("cards")).alias("cards"))
    often.repartitionByRange("gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}/grams")


def query_grams(query: str) -> list[str]:
    low = query.strip().lower()
    return sorted({low[i : i + 3] for i in range(len(low) - 2)})


def find(spark: SparkSession, path: str, query: str) -> DataFrame:
    """TOPIC_ID of the cards that hold the query, in any case."""
    low, grams = query.strip().lower(), query_grams(query)
    texts = spark.read.schema(TEXTS).parquet(f"{path}/texts")
    if not grams:
        return texts.where(F.contains("blob", F.lit(low))).select("TOPIC_ID")
    known = spark.read.schema("gram string, cards long").parquet(f"{path}/grams").where(F.col("gram").isin(grams)).collect()  # a row a trigram of the query
    if len(known) < len(grams):
        return texts.limit(0).select("TOPIC_ID")
    rare = [r["gram"] for r in sorted(known, key=lambda r: (r["cards"], r["gram"]))[:RAREST]]
    hits = spark.read.schema(POSTINGS).parquet(f"{path}/postings").where(F.col("gram").isin(rare)).select("gram", F.explode("cards").alias("TOPIC_ID"))
    some = hits.distinct().groupBy("TOPIC_ID").agg(F.count("*").alias("n")).where(F.col("n") == len(rare))
    return texts.join(some.select("TOPIC_ID"), "TOPIC_ID", "left_semi").where(F.contains("blob", F.lit(low))).select("TOPIC_ID")


def find_cards(cards: DataFrame, path: str, query: str, key="TOPIC_ID") -> DataFrame:
    """The cards that hold the query, by the index at `path`."""
    found = find(cards.sparkSession, path, query)
    return cards.join(found.select(F.col("TOPIC_ID").alias("_found")), F.col(key).cast("long") == F.col("_found"), "left_semi")

