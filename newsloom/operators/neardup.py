"""Near-duplicate stories and risk factors, by greedy grouping within blocks."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.text import block_key
from newsloom.functions.vectors import dot, keyed
from newsloom.operators import neighbours
from newsloom.sources.stages import scratch

SIMILARITY = 0.93
# Tokens of a filing that is worked through in one task; larger ones are by links.
FILING_TOKENS = 200_000

# Words that don't tell factors apart, fixed values.
STOP_WORDS = "the a an and or of to in on for with our we us may could would that this these those as is are be by it its from at which such any".split()


def exact_copies(df: DataFrame, text="text", seq="seq") -> DataFrame:
    """Each text's first row and number of rows, for texts that occur more than once."""
    return df.groupBy(F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("sha")).agg(F.min(seq).alias("first"), F.count("*").alias("n")).where("n > 1")


def blocks(df: DataFrame, text="text") -> DataFrame:
    """Rows of each block key."""
    return df.groupBy(block_key(text).alias("block")).agg(F.count("*").alias("n"))


# Rows that are placed together, and representatives that they are multiplied with at a time.
RUN, TILE = 256, 8192


class _Block:
    """Groups of one block so far: only representatives are held."""

    def __init__(self):
        self.vectors = None
        self.heads: list[int] = []
        self.reps: list[tuple[int, float, int]] = []

    def place(self, seqs, qualities, lengths, vectors, threshold) -> list[int]:
        """The first seq of the group that each row joins in turn: the first whose representative is similar enough.

        A run of rows is multiplied with the representatives before it, and with itself for those that change within it.
        """
        old, n = len(self.reps), len(seqs)
        near: list[list] = [[] for _ in range(n)]
        for lo in range(0, old, TILE):
            for row, g in zip(*(x.tolist() for x in np.nonzero(vectors @ self.vectors[lo : min(lo + TILE, old)].T >= threshold)), strict=True):
                near[row].append(lo + g)
        alike = vectors @ vectors.T >= threshold
        stands, by = np.full(n, -1), {}  # the group that a row of the run stands for, and the row for each group that changed
        out = []
        for i in range(n):
            g = next((g for g in near[i] if g not in by), -1)
            among = stands[:i][alike[i, :i] & (stands[:i] >= 0)]
            if len(among) and (g < 0 or among.min() < g):
                g = int(among.min())
            mine = (seqs[i], qualities[i], lengths[i])
            if g < 0:
                g = len(self.reps)
                self.heads.append(seqs[i])
                self.reps.append(mine)
            elif mine[1:] > self.reps[g][1:]:
                self.reps[g] = mine
                if g in by:
                    stands[by[g]] = -1
            else:
                out.append(self.heads[g])
                continue
            stands[i], by[g] = g, i
            out.append(self.heads[g])
        if self.vectors is None:
            self.vectors = np.empty((16, vectors.shape[1]))
        while len(self.vectors) < len(self.reps):
            self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
        self.vectors[list(by)] = vectors[list(by.values())]
        return out


def _groups(frames, threshold):
    """Rows sorted by block and seq: (seq, group, 0) of each, and (seq, group, 1) of the representatives."""
    block, state = None, None

    def closed():
        return pd.DataFrame({"seq": [r[0] for r in state.reps], "DUP_GROUP": state.heads, "is_rep": 1})

    for pdf in frames:
        out, (key, seq, quality, length, vector) = [], (pdf[c].tolist() for c in pdf.columns)
        lo = 0
        while lo < len(pdf):
            if state is None or key[lo] != block:
                if state is not None:
                    yield closed()
                block, state = key[lo], _Block()
            hi = lo + 1
            while hi < min(lo + RUN, len(pdf)) and key[hi] == block:
                hi += 1
            out += state.place(seq[lo:hi], quality[lo:hi], length[lo:hi], np.stack(vector[lo:hi]).astype(float), threshold)
            lo = hi
        yield pd.DataFrame({"seq": pdf["seq"], "DUP_GROUP": out, "is_rep": 0})
    if state is not None:
        yield closed()


def near_duplicates(df: DataFrame, block: Column, threshold: float = SIMILARITY) -> DataFrame:
    """df: seq, quality, length, vector (unit). Returns seq, DUP_GROUP (first seq of the group), IS_DUPLICATE.

    In the order of seq, a row joins the first group of its block whose representative is similar
    enough, and replaces it if its quality, then its length, is larger. What a row is compared with
    depends on all earlier ones, so a block runs in one task; it streams through it and only
    representatives are held. Rows equal in vector, quality and length are merged before that.
    """
    rows = df.select(block.alias("block"), "seq", F.coalesce("quality", F.lit(0.0)).cast("double").alias("quality"), F.col("length").cast("long").alias("length"), "vector")
    alike = ["block", "quality", "length", "vector"]
    firsts = rows.groupBy(*alike).agg(F.min("seq").alias("first"))
    ordered = firsts.select("block", F.col("first").alias("seq"), "quality", "length", "vector").repartition("block").sortWithinPartitions("block", "seq")
    placed = ordered.mapInPandas(lambda it: _groups(it, threshold), "seq long, DUP_GROUP long, is_rep int")
    placed = placed.groupBy("seq").agg(F.max("DUP_GROUP").alias("DUP_GROUP"), F.max("is_rep").alias("is_rep")).withColumnRenamed("seq", "first")
    members = rows.join(firsts, alike).select("seq", "first")
    # A copy never replaces the row it equals, so it is a duplicate.
    return members.join(placed, "first").select("seq", "DUP_GROUP", ((F.col("is_rep") == 0) | (F.col("seq") != F.col("first"))).alias("IS_DUPLICATE"))


def spread_duplicates(df: DataFrame, block: Column, threshold: float = SIMILARITY, cell_rows: int = neighbours.CELL_ROWS) -> DataFrame:
    """near_duplicates() for blocks of any size, with the same result: seq, DUP_GROUP, IS_DUPLICATE.

    A row only ever meets representatives it is similar to, so what becomes of it depends on the rows that
    links of similar rows connect it to, and on no others. Those links come from an exact join; each
    connected component is then worked through in the order of seq, whatever block it lies in. A task
    holds the representatives of one component.
    """
    if threshold <= 0:
        raise ValueError("the threshold must be above 0")
    folder = scratch(df.sparkSession, "spread")
    rows = df.select(block.alias("block"), "seq", F.coalesce("quality", F.lit(0.0)).cast("double").alias("quality"), F.col("length").cast("long").alias("length"), F.col("vector").cast("array<double>").alias("vector"))
    rows = neighbours.kept(keyed(rows), folder, "rows")
    alike = ["block", "quality", "length", "same"]
    firsts = neighbours.kept(rows.groupBy(*alike).agg(F.min("seq").alias("first"), F.min_by("vector", "seq").alias("vector")), folder, "firsts")
    vectors = neighbours.kept(firsts.groupBy("block", "same").agg(F.min("first").alias("seq"), F.min_by("vector", "first").alias("vector")), folder, "vectors")
    # A little below the threshold: what is connected too much is told apart when the component is worked through.
    links = neighbours.similar_links(vectors, threshold - neighbours.SLACK, F.col("block"), folder, cell_rows)
    label = neighbours.components(vectors, links, folder).withColumn("component", F.col("component").cast("string"))
    placed = firsts.join(vectors.select("block", "same", "seq").join(label, "seq").select("block", "same", "component"), ["block", "same"])
    ordered = placed.select("component", F.col("first").alias("seq"), "quality", "length", "vector").repartition("component").sortWithinPartitions("component", "seq")
    placed = ordered.mapInPandas(lambda it: _groups(it, threshold), "seq long, DUP_GROUP long, is_rep int")
    placed = placed.groupBy("seq").agg(F.max("DUP_GROUP").alias("DUP_GROUP"), F.max("is_rep").alias("is_rep")).withColumnRenamed("seq", "first")
    members = rows.select(*alike, "seq").join(firsts.select(*alike, "first"), alike).select("seq", "first")
    return members.join(placed, "first").select("seq", "DUP_GROUP", ((F.col("is_rep") == 0) | (F.col("seq") != F.col("first"))).alias("IS_DUPLICATE"))


RECALL = 0.95


def table_shape(rows: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(tables, planes): planes enough for buckets of a row or so in a block of so many rows, and tables enough
    for two rows at the threshold to share a bucket with this chance."""
    planes = max(8, rows.bit_length() + 1)
    alike = (1 - np.arccos(min(threshold, 1.0)) / np.pi) ** planes
    return max(1, int(np.ceil(np.log(1 - recall) / np.log(1 - min(alike, 0.999))))), planes


# Tables that a row is put into at most: a row of a table takes some fifty bytes of disk, written and shuffled, and the exact
# join takes some sixteen times a vector. Where the recall asks for more tables, the exact join takes less.
MAX_TABLES = 128
BUCKET_CELLS = 4_000_000


def _buckets(first: DataFrame, tables: int, planes: int, seed: int) -> DataFrame:
    """block, t, b, seq: for each table the sides of random planes that a vector (block, vector, first) lies on, as one number.

    Rows and tables are taken in slices of BUCKET_CELLS sides, so a task's memory doesn't grow with the tables.
    """
    power = (1 << np.arange(planes)).astype(np.int64)
    step = max(1, min(tables, BUCKET_CELLS // (64 * planes)))
    size = max(1, BUCKET_CELLS // (step * planes))

    def run(batches):
        normal = None
        for batch in batches:
            for lo in range(0, batch.num_rows, size):
                part = batch.slice(lo, size)
                v = np.asarray(part.column(1).flatten().to_numpy(zero_copy_only=False), float).reshape(part.num_rows, -1)
                if normal is None:
                    normal = np.random.default_rng(seed).normal(size=(v.shape[1], tables * planes))
                for t in range(0, tables, step):
                    sides = v @ normal[:, t * planes : (t + step) * planes] > 0
                    number = sides.reshape(len(v), -1, planes) @ power
                    row = pa.array(np.repeat(np.arange(len(v)), number.shape[1]))
                    nr = np.tile(np.arange(t, t + number.shape[1], dtype=np.int32), len(v))
                    yield pa.RecordBatch.from_arrays([part.column(0).take(row), pa.array(nr), pa.array(number.ravel()), part.column(2).take(row)], ["block", "t", "b", "seq"])

    return first.select("block", "vector", F.col("first").cast("long").alias("seq")).mapInArrow(run, f"block {first.schema['block'].dataType.simpleString()}, t int, b long, seq long")


def _bucket_links(first: DataFrame, tables: int, planes: int, threshold: float, seed: int, folder: str) -> DataFrame:
    """a, b: the rows of first that are similar enough to the first or the last row of one of their buckets."""
    placed = neighbours.kept(_buckets(first, tables, planes, seed), folder, "buckets")
    ends = placed.groupBy("block", "t", "b").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi")).where("lo < hi")
    pairs = placed.join(ends, ["block", "t", "b"]).select("seq", F.explode(F.array("lo", "hi")).alias("other")).where("seq != other")
    pairs = pairs.select(F.greatest("seq", "other").alias("a"), F.least("seq", "other").alias("b")).distinct()
    of = lambda c: first.select(F.col("first").alias(c), F.col("vector").alias(f"v{c}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").where(dot(F.col("va"), F.col("vb")) >= threshold).select("a", "b")


def similar_groups(df: DataFrame, block: Column, threshold: float = SIMILARITY, recall: float = RECALL, seed: int = 42) -> DataFrame:
    """near_duplicates() for blocks too large for one task, approximately: seq, DUP_GROUP, IS_DUPLICATE.

    Groups are what links of similar rows connect, named by the smallest seq; the row of highest quality,
    then length, then lowest seq stands for its group. Rows equal in vector are merged before.
    Links are found in some tables: rows of a block on the same sides of random planes share a bucket, and
    each row is compared with the first and the last row of its buckets. How many tables follows from the
    largest block, the threshold and the recall (table_shape). Firsts and lasts are minima and maxima, so a
    hot block or bucket is never in one task. The number of tables grows with a power of the rows, the faster
    the lower the threshold; beyond MAX_TABLES the links are those of the exact join, which misses none (it needs
    a threshold above 0).
    """
    folder = scratch(df.sparkSession, "near")
    rows = df.select(block.alias("block"), "seq", F.coalesce("quality", F.lit(0.0)).cast("double").alias("quality"), F.col("length").cast("long").alias("length"), "vector")
    rows = neighbours.kept(keyed(rows), folder, "rows")
    first = neighbours.kept(rows.groupBy("block", "same").agg(F.min("seq").alias("first"), F.min_by("vector", "seq").alias("vector")), folder, "vectors")
    largest = first.groupBy("block").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    tables, planes = table_shape(largest, threshold, recall)
    vertices = first.select("block", F.col("first").alias("seq"), "vector")
    if tables <= MAX_TABLES or threshold <= 0:
        links = _bucket_links(first, tables, planes, threshold, seed, folder)
    else:
        links = neighbours.similar_links(vertices, threshold, F.col("block"), folder)
    label = neighbours.components(vertices, links, folder).withColumnRenamed("seq", "first").withColumnRenamed("component", "group")
    members = rows.drop("vector").join(first.drop("vector"), ["block", "same"]).drop("same")
    grouped = members.join(label, "first")
    best = grouped.groupBy("group").agg(F.max_by("seq", F.struct("quality", "length", -F.col("seq"))).alias("best"))
    return grouped.join(best, "group").select("seq", F.col("group").alias("DUP_GROUP"), (F.col("seq") != F.col("best")).alias("IS_DUPLICATE"))


def content_tokens(x: Column) -> Column:
    """The distinct words of three letters or more that are no stop words."""
    found = F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit("[a-z]{3,}"), F.lit(0))
    return F.array_except(F.array_distinct(found), F.array(*[F.lit(w) for w in STOP_WORDS]))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


def containment(a: Column, b: Column) -> Column:
    """The share of a's tokens that b has too."""
    return F.when(F.size(a) == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def distinct_factors(pdf: pd.DataFrame, threshold=0.6, contained=0.8) -> pd.DataFrame:
    """One filing, all pairs: longest first, a factor is dropped if a kept one is similar or holds most of its tokens."""
    order = sorted(range(len(pdf)), key=lambda i: (-pdf["length"].iloc[i], pdf["seq"].iloc[i]))
    sets = [set(t) for t in pdf["tokens"]]
    kept: list[int] = []
    for i in order:
        own = sets[i]
        if not any(own and sets[k] and (len(own & sets[k]) >= threshold * len(own | sets[k]) or len(own & sets[k]) >= contained * len(own)) for k in kept):
            kept.append(i)
    return pdf.iloc[sorted(kept, key=lambda i: pdf["seq"].iloc[i])][["filing", "seq"]]


def staying_factors(factors, threshold=0.6, contained=0.8) -> list[int]:
    """Places of the factors (token lists, the longest factor first) that stay: one goes if a kept one is similar or holds most of its tokens.

    Either takes a share of its tokens, so a kept factor that could make it go holds one of its first few, rarest first.
    """
    often = Counter(t for tokens in factors for t in tokens)
    least = min(threshold, contained)
    held: dict[str, list[int]] = {}
    sets: dict[int, set] = {}
    for i, tokens in enumerate(factors):
        own = set(tokens)
        first = sorted(own, key=lambda t: (often[t], t))[: len(own) - math.ceil(len(own) * least - 1e-9) + 1]
        met = {k for t in first for k in held.get(t, ())}
        both = ((len(own & sets[k]), len(sets[k])) for k in met)
        if not any(n >= threshold * (len(own) + size - n) or n >= contained * len(own) for n, size in both):
            sets[i] = own
            for t in own:
                held.setdefault(t, []).append(i)
    return list(sets)


def _staying(batches, threshold, contained):
    """Rows (grp, filing, seq, tokens) in the order of groups, the longest factor first: filing and seq of those that stay. Holds one group and a batch."""
    group, rows = None, []

    def closed():
        stay = [rows[i] for i in staying_factors([r[2] for r in rows], threshold, contained)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in stay], pa.string()), pa.array([r[1] for r in stay], pa.int64())], ["filing", "seq"])

    for batch in batches:
        out = []
        for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != group:
                if rows:
                    out.append(closed())
                group, rows = key, []
            rows.append(row)
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if rows:
        yield closed()


def _greedy(rows: DataFrame, group: str, threshold, contained) -> DataFrame:
    """filing, seq of what stays of rows (group, filing, seq, length, tokens), group by group."""
    ordered = rows.repartition(group).sortWithinPartitions(group, F.desc("length"), "seq").select(F.col(group).cast("string").alias("grp"), "filing", F.col("seq").cast("long").alias("seq"), "tokens")
    return ordered.mapInArrow(lambda it: _staying(it, threshold, contained), "filing string, seq long")


def factor_links(rows: DataFrame, threshold=0.6, contained=0.8) -> DataFrame:
    """a, b: the pairs of a filing's distinct token sets that are similar, or of which one holds most of the other. rows: id, filing, tokens.

    Tokens are ordered from the rarest of the filing on. A pair that shares enough tokens shares one of the first few of
    each, so only those are looked up: frequent tokens, which most rows have, are hardly ever among them.
    """
    each = rows.select("id", "filing", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    often = each.groupBy("filing", "token").agg(F.count("*").alias("often"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("often", "token"))
    least = min(threshold, contained)
    first = each.join(often, ["filing", "token"]).withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1)
    met = first.select("filing", "token", F.col("id").alias("x")).join(each.select("filing", "token", F.col("id").alias("y")), ["filing", "token"]).where("x != y")
    pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    sets = rows.select("id", "tokens")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta")), "a").join(sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb")), "b")
    shared, small = F.size(F.array_intersect("ta", "tb")), F.least(F.size("ta"), F.size("tb"))
    return both.where((shared >= (F.size("ta") + F.size("tb") - shared) * threshold - 1e-9) | (shared >= small * contained - 1e-9)).select("a", "b")


def dedup_factors(df: DataFrame, text="text", filing_tokens: int = FILING_TOKENS) -> DataFrame:
    """df: filing, seq, text. The rows of each filing that stay.

    Filings are dealt out and streamed through, the longest factor first; a task holds one of them. Filings of more than
    `filing_tokens` tokens are never in one task: whether a factor stays depends on those it is similar to, so there what
    links connect is worked through by itself, and what has no link stays. Factors of the same tokens are merged before:
    the longest of them stands for all. Factors without tokens stay.
    """
    folder = scratch(df.sparkSession, "factors")
    rows = df.select(F.col("filing").cast("string").alias("filing"), "seq", F.coalesce(F.length(text), F.lit(0)).alias("length"), F.array_sort(content_tokens(F.col(text))).alias("tokens"))
    rows = neighbours.kept(rows.withColumn("id", F.monotonically_increasing_id()), folder, "rows")
    some = rows.where(F.size("tokens") > 0)
    large = neighbours.kept(some.groupBy("filing").agg(F.sum(F.size("tokens")).alias("n")).where(F.col("n") > filing_tokens).select("filing"), folder, "large")
    stay = rows.where(F.size("tokens") == 0).select("filing", F.col("seq").cast("long").alias("seq"))
    if large.isEmpty():
        return stay.unionByName(_greedy(some, "filing", 0.6, 0.8))
    stay = stay.unionByName(_greedy(some.join(large, "filing", "left_anti"), "filing", 0.6, 0.8))
    best = F.struct((-F.col("length")).alias("by"), "seq", "id")
    firsts = some.join(large, "filing", "left_semi").groupBy("filing", "tokens").agg(F.min(best).alias("f"))
    firsts = neighbours.kept(firsts.select("f.id", "filing", "f.seq", (-F.col("f.by")).alias("length"), "tokens"), folder, "firsts")
    links = neighbours.kept(factor_links(firsts), folder, "links")
    linked = links.select(F.col("a").alias("seq")).union(links.select("b")).distinct()
    label = neighbours.components(linked, links, folder).withColumnRenamed("seq", "id")
    placed = firsts.join(label, "id", "left")
    alone = placed.where("component is null").select("filing", F.col("seq").cast("long").alias("seq"))
    return stay.unionByName(alone).unionByName(_greedy(placed.where("component is not null"), "component", 0.6, 0.8))


def factor_pairs(df: DataFrame, group: str, text="text", threshold=0.6, contained=0.8) -> DataFrame:
    """Pairs within a group that share tokens and are similar or contained: a, b, jaccard, containment.

    Candidates come from an equi-join on (group, token) with counted overlaps, not from all pairs.
    """
    tokens = df.select(group, "seq", content_tokens(F.col(text)).alias("tokens")).where(F.size("tokens") > 0)
    each = tokens.select(group, "seq", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    left = each.select(group, "token", F.col("seq").alias("a"), F.col("n").alias("na"))
    right = each.select(group, "token", F.col("seq").alias("b"), F.col("n").alias("nb"))
    both = left.join(right, [group, "token"]).where("a < b").groupBy(group, "a", "b", "na", "nb").agg(F.count("*").alias("both"))
    scored = both.withColumns({"jaccard": F.round(F.col("both") / (F.col("na") + F.col("nb") - F.col("both")), 4), "containment": F.round(F.col("both") / F.least("na", "nb"), 4)})
    return scored.where((F.col("jaccard") >= threshold) | (F.col("containment") >= contained)).select("a", "b", "jaccard", "containment")
