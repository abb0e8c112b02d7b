"""The trie of conversation prefixes by partition refinement (operator 12).

All conversations start in one class, the root. Each round splits every active class by the next turn
of its conversations: each part is a node, one turn deeper. A part that holds one distinct conversation
retires: what is left of it is a chain of nodes without a branch, which is written out at once, whatever its
length. When no class is active the counts of leaves and the saved tokens are folded back, level by level,
from the deepest to the root.

Conversations of equal turns are one distinct conversation with a number of members, so copies retire
together and a round is only needed where different conversations share a turn. Turns are compared by
128 bits of hash, classes by 128 bits chained from turn to turn; texts are read once.

A conversation is rebuilt before: the first turns of its block's first conversation, then its own. No
conversation, however many turns it has, is in one task: turns are numbered by range partitions and the
counts of those, and only the first LENT turns, which a conversation can lend, are ever gathered.
The digest of a node's members is taken over sorted pieces of their list.

Null turns come first; turns of equal number are ordered by role, then text; null role or text is
empty. Rows without conv_id belong to no conversation and are left out. Repeated rows are repeated turns. An
empty table has no members, so not even a root: it gives an empty result. Texts of any length are taken
whole; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.frames import delete, recorded, stored

BLOCK = 5
# A conversation lends, and drops, less than this many turns.
LENT = 9
PIECE = 1 << 16
EMPTY = hashlib.sha256(b"").hexdigest()


def numbered_turns(table: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """A row a turn: c, part, at (its place in the order of all turns), k1, k2 (hashes of role and text), bytes."""
    filled = [F.coalesce(F.col(x).cast("string"), F.lit("")).alias(y) for x, y in ((role, "r"), (text, "t"))]
    rows = table.select(F.col(conv_id).cast("bigint").alias("c"), F.col(turn).alias("n"), *filled).where("c is not null")
    order = [F.col("c"), F.col("n").asc_nulls_first(), F.col("r"), F.col("t")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(
        rows.select("c", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), F.xxhash64("r", "t").alias("k1"), F.xxhash64(F.lit(1), "t", "r").alias("k2"), F.octet_length("t").cast("bigint").alias("bytes")),
        "trie-turns",
    )


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns of the rebuilt conversations: c, pos, k1, k2, bytes, suffix; one row for each conversation: c).

    suffix is the sum of bytes from this turn to the end of its conversation.
    """
    runs = turns.groupBy("part", "c").agg(F.min("at").alias("first"), F.count("*").alias("n"), F.sum("bytes").alias("b"))
    runs = stored(runs, "trie-runs")
    sizes = runs.groupBy("c").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    sizes = sizes.withColumns({"base": F.expr(f"c - c % {BLOCK}"), "h": F.crc32(F.col("c").cast("string")) % LENT})
    lenders = sizes.select(F.col("c").alias("base"), F.col("n").alias("has"))
    sizes = stored(sizes.join(lenders.hint("merge"), "base", "left").select("c", "base", "n", "b", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("lent")), "trie-sizes")

    # A row for each range a conversation lies in: what of it comes in earlier ranges.
    earlier = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = runs.select("part", "c", "first", *[F.coalesce(F.sum(x).over(earlier), F.lit(0)).alias(f"{x}_before") for x in ("n", "b")])
    before = before.join(sizes.drop("base").hint("merge"), "c")
    so_far = Window.partitionBy("part", "c").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = turns.join(before.hint("merge"), ["part", "c"])
    placed = placed.withColumn("done", F.col("b_before") + F.sum("bytes").over(so_far) - F.col("bytes"))
    placed = stored(placed.select("c", (F.col("n_before") + F.col("at") - F.col("first")).alias("pos"), "k1", "k2", "bytes", (F.col("b") - F.col("done")).alias("suffix"), "h", "lent"), "trie-placed")

    heads = placed.where(F.col("pos") < LENT - 1).groupBy("c").agg(F.sort_array(F.collect_list(F.struct("pos", "k1", "k2", "bytes"))).alias("head"))
    heads = stored(heads, "trie-heads")
    size_of = lambda turns_: F.aggregate(turns_, F.lit(0).cast("bigint"), lambda a, t: a + t["bytes"])
    own = sizes.join(heads.hint("merge"), "c")
    borrowed = own.join(heads.select(F.col("c").alias("base"), F.col("head").alias("theirs")).hint("merge"), "base").where("lent > 0")
    borrowed = borrowed.select("c", (F.col("b") - size_of(F.slice("head", F.lit(1), F.col("h").cast("int")))).alias("rest"), F.slice("theirs", F.lit(1), F.col("lent").cast("int")).alias("start"))
    fronts = borrowed.select("c", "rest", "start", F.inline("start"))
    fronts = fronts.select("c", F.col("pos"), "k1", "k2", "bytes", (F.col("rest") + size_of(F.filter("start", lambda t: t["pos"] >= F.col("pos")))).alias("suffix"))
    tails = placed.where("pos >= h").select("c", F.expr("pos - h + lent").alias("pos"), "k1", "k2", "bytes", "suffix")
    return stored(fronts.unionByName(tails), "trie-rebuilt"), sizes.select("c")


def _pieces(it):
    """Sorted members (length, f1, f2, c) to pieces of their list: length, f1, f2, c (the first), n, ids."""
    names = ["length", "f1", "f2", "c", "n", "ids"]
    key, first, ids, size, out = None, None, [], 0, []

    def close():
        nonlocal ids, size
        if ids:
            out.append((*key, first, len(ids), ",".join(ids)))
        ids, size = [], 0

    def batch():
        made = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), [pa.int64()] * 5 + [pa.string()], strict=True)], names)
        out.clear()
        return made

    for rows in it:
        for *k, c in zip(*(rows.column(x).to_pylist() for x in range(4)), strict=True):
            if k != key or size > PIECE:
                close()
                key, first = k, c
            ids.append(str(c))
            size += len(ids[-1]) + 1
        if len(out) > 1000:
            yield batch()
    close()
    if out:
        yield batch()


def _digests(it):
    """Pieces sorted by (length, f1, f2, c) to a row for each distinct conversation: length, f1, f2, g (smallest member), k, sha."""
    names = ["length", "f1", "f2", "g", "k", "sha"]
    key, first, n, digest, out = None, None, 0, None, []

    def batch():
        made = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), [pa.int64()] * 5 + [pa.string()], strict=True)], names)
        out.clear()
        return made

    for rows in it:
        for *k, c, count, ids in zip(*(rows.column(x).to_pylist() for x in range(6)), strict=True):
            if k != key:
                if key:
                    out.append((*key, first, n, digest.hexdigest()))
                key, first, n, digest = k, c, 0, hashlib.sha256()
            elif n:
                digest.update(b",")
            digest.update(ids.encode())
            n += count
        if len(out) > 1000:
            yield batch()
    if key:
        out.append((*key, first, n, digest.hexdigest()))
    if out:
        yield batch()


def distinct_conversations(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each distinct sequence of turns: g (its smallest conv_id), length, k (members), sha (digest of their list)."""
    marks = turns.groupBy("c").agg(F.count("*").alias("length"), F.expr("bit_xor(xxhash64(pos, k1, k2))").alias("f1"), F.expr("bit_xor(xxhash64(k2, pos, k1))").alias("f2"))
    zero = F.lit(0).cast("bigint")
    members = convs.join(marks.hint("merge"), "c", "left").select(*[F.coalesce(x, zero).alias(x) for x in ("length", "f1", "f2")], "c")
    order = ["length", "f1", "f2", "c"]
    members = members.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = members.mapInArrow(_pieces, "length bigint, f1 bigint, f2 bigint, c bigint, n bigint, ids string")
    pieces = pieces.repartition("length", "f1", "f2").sortWithinPartitions(*order)
    return stored(pieces.mapInArrow(_digests, "length bigint, f1 bigint, f2 bigint, g bigint, k bigint, sha string").select("g", "length", "k", "sha"), "trie-distinct")


def refine(groups: DataFrame, turns: DataFrame, root) -> list[DataFrame]:
    """The classes of each depth from 1 on: m (distinct conversations), n_convs, conv, parent, ended (the one that ends there) and the sums to fold.

    A class of one distinct conversation is retired: no later round splits it.
    """
    spark, zero = groups.sparkSession, F.lit(0).cast("bigint")
    active = groups.where("length > 0").select("g", "length", "k", zero.alias("p1"), zero.alias("p2"), F.lit(root["conv"]).alias("parent"))
    levels, depth, split = [], 0, None
    while root["longest"] > 0:
        turn = turns.where(F.col("pos") == depth).drop("pos")
        depth += 1
        before = split
        split = active.join(turn.hint("merge"), "g").withColumns({"c1": F.xxhash64("p1", "k1", "k2"), "c2": F.xxhash64("k2", "p2", "k1")})
        split = stored(split.drop("k1", "k2"), "trie-split")
        if before is not None:
            delete(spark, [before.stored_at])
        classes = split.groupBy("c1", "c2").agg(
            F.count("*").alias("m"),
            F.sum("k").alias("n_convs"),
            *[F.min(x).alias(y) for x, y in (("g", "conv"), ("parent", "parent"), ("p1", "p1"), ("p2", "p2"), ("bytes", "bytes"), ("suffix", "suffix"))],
            F.max(F.when(F.col("length") == depth, F.col("g"))).alias("ended"),
            F.max("length").alias("longest"),
        )
        levels.append(stored(classes, "trie-classes"))
        on = levels[-1].where("m > 1").select("c1", "c2", F.col("conv").alias("above"))
        if levels[-1].where((F.col("m") > 1) & (F.col("longest") > depth)).isEmpty():
            break
        kept = split.where(F.col("length") > depth).join(on.hint("merge"), ["c1", "c2"])
        active = kept.select("g", "length", "k", F.col("c1").alias("p1"), F.col("c2").alias("p2"), F.col("above").alias("parent"))
    return levels


def _sums(level: DataFrame) -> DataFrame:
    return level.groupBy(F.col("p1").alias("c1"), F.col("p2").alias("c2")).agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))


def fold(levels: list[DataFrame]) -> list[DataFrame]:
    """The levels with n_children, n_leaves and saved_tokens, from the deepest up: those of a retired class's first node are known."""
    out: list[DataFrame] = []
    for level in reversed(levels):
        level = level.withColumn("own", F.col("n_convs") - 1)
        if out:
            level = level.join(_sums(out[-1]).hint("merge"), ["c1", "c2"], "left")
        else:
            level = level.withColumns({x: F.lit(None).cast("bigint") for x in ("n_children", "leaves", "saved")})
        one = F.col("m") == 1
        level = level.withColumns({
            "n_leaves": F.when(one, 1).otherwise(F.coalesce("leaves", F.lit(1))).cast("bigint"),
            "saved_tokens": F.when(one, F.col("own") * F.col("suffix")).otherwise(F.col("own") * F.col("bytes") + F.coalesce("saved", F.lit(0))),
            "n_children": F.coalesce("n_children", F.lit(0)),
        })
        out.append(stored(level.drop("own", "leaves", "saved"), "trie-folded"))
    return out[::-1]


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(table: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = table.sparkSession
    with recorded() as made:
        turns, convs = rebuilt_turns(numbered_turns(table, conv_id, turn, role, text))
        groups = distinct_conversations(turns, convs)
        mine = turns.join(groups.select(F.col("g").alias("c")).hint("merge"), "c", "left_semi").withColumnRenamed("c", "g")
        mine = stored(mine.repartitionByRange("pos", "g").sortWithinPartitions("pos", "g"), "trie-distinct-turns")
        root = groups.agg(F.min("g").alias("conv"), F.sum("k").alias("n_convs"), F.max(F.when(F.col("length") == 0, F.col("g"))).alias("ended"), F.coalesce(F.max("length"), F.lit(0)).alias("longest")).first()
        levels = fold(refine(groups, mine, root))
    delete(spark, made, (mine, groups, *levels))
    top = tuple(levels[0].agg(F.count("*"), F.sum("n_leaves"), F.sum("saved_tokens")).first()) if levels else (0, 1, 0)
    kinds = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ended bigint"
    nodes = spark.createDataFrame([] if root["conv"] is None else [(root["conv"], 0, None, root["n_convs"], *top, root["ended"])], kinds)
    alone = spark.createDataFrame([], "g bigint, top bigint, parent bigint")
    for depth, level in enumerate(levels, 1):
        at = F.lit(depth).cast("bigint")
        nodes = nodes.unionByName(level.where("m > 1").select(F.col("conv").alias("conv_id"), at.alias("depth"), F.col("parent").alias("parent_conv_id"), *COLUMNS[3:7], "ended"))
        alone = alone.unionByName(level.where("m = 1").select(F.col("conv").alias("g"), at.alias("top"), "parent"))
    ends = groups.select(F.col("g").alias("ended"), "sha")
    nodes = nodes.join(ends.hint("merge"), "ended", "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(EMPTY)))
    # The chains of all retired classes, from the node at `top` down.
    here = F.col("pos") + 1
    chains = alone.join(groups.hint("merge"), "g").join(mine.select("g", "pos", "suffix").hint("merge"), "g").where(here >= F.col("top"))
    chains = chains.select(
        F.col("g").alias("conv_id"),
        here.alias("depth"),
        F.when(here == F.col("top"), F.col("parent")).otherwise(F.col("g")).alias("parent_conv_id"),
        F.col("k").alias("n_convs"),
        F.when(here < F.col("length"), 1).otherwise(0).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"),
        ((F.col("k") - 1) * F.col("suffix")).alias("saved_tokens"),
        F.when(here == F.col("length"), F.col("sha")).otherwise(EMPTY).alias("ends_sha256"),
    )
    return nodes.select(*COLUMNS).unionByName(chains)
