"""N-gram Jaccard self-join by a MinHash LSH forest, verified exactly (operator 3).

Each distinct text has a label in each of `trees` trees: `depth` minima over its shingles (`n` words;
a text of fewer words is one shingle). The labels of a tree, sorted, are a prefix trie: the texts
that share their first p minima are a run of the sorted leaves, a node of level p.

The join goes up from the leaves. It takes the nodes of the deepest level, verifies their texts on
whole shingle sets and measures how alike the links are. A link of similarity s is in a node of
level p with chance 1 - (1 - s**p)**trees, so the links found tell how many there are of each
similarity, and how many every shorter prefix would find. While the recall estimated this way is
below `target`, prefixes are shortened to the longest that is expected to reach it, and nodes that
have gained texts are verified again, for the pairs that no longer prefix had brought together.
Links that cannot be seen yet count as PRIOR more at the threshold itself, where recall is least.

Nodes with the same members, as close copies give in most trees, are verified once. A large node is
dealt out in blocks of bounded rows and bytes, every two blocks meeting in one task; a pair is
counted in the first node both share, so no pairs are stored. Tasks return counts of links, their
similarities in bins, and one edge per text to the smallest text it is connected with in that task;
stars over those edges give the classes.

Copies of one text are one node with its smallest doc_id. Null texts count as empty; a text
without words links to nothing but its copies. Texts of any length are taken whole; a node's blocks
are made smaller by the bytes of its texts. Rows with a null doc_id, and texts whose smallest doc_id
another text has too, are numbered by their text, after all others. Repeated rows are copies; an empty table
gives an empty one. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.components import connected_components
from newsloom.llm.frames import batches, delete, free, recorded, runs, stored, texts
from newsloom.llm.kernels import SPACE_WORDS, buffer, doc_of, mix, signed, slices, window_hashes, word_hashes, words

SHINGLE = 5
THRESHOLD = 0.8
TREES = 16
DEPTH = 8
TARGET_RECALL = 0.9999
PRIOR = 0.01
BLOCK = 256
BLOCK_BYTES = 32_000_000
COLUMNS = 4096
BINS = 20
KEY = ["k", "t1", "t2"]


def recall(similarity: float, prefix: int, trees: int = TREES) -> float:
    """The chance that two texts share a prefix of this length in one tree at least."""
    return 1 - (1 - similarity**prefix) ** trees


def prefix_length(threshold: float, trees: int, depth: int, target: float) -> int:
    """The longest prefix that reaches the target recall at the threshold; 1 if none does."""
    return shortened(depth + 1, np.zeros(0), 0, threshold, trees, target)


def expected_recall(prefix, found, level, threshold, trees):
    """The share of all links that prefixes of this length bring together, told from the links found so far at `level`.

    found: links by similarity, in bins of equal width from the threshold up; each counts as lying at its bin's lower edge.
    """
    edges = threshold + (1 - threshold) * np.arange(len(found)) / max(len(found), 1)
    there = np.array([f / recall(s, level, trees) for f, s in zip(found, edges, strict=True)])
    more = max(1.0, PRIOR * there.sum())
    caught = sum(n * recall(s, prefix, trees) for n, s in zip(there, edges, strict=True))
    return (caught + more * recall(threshold, prefix, trees)) / (there.sum() + more)


def shortened(level: int, found, at: int, threshold: float, trees: int, target: float) -> int:
    """The longest prefix below `level` that is expected to reach the target recall; 1 if none does."""
    prefix = level - 1
    while prefix > 1 and expected_recall(prefix, found, at, threshold, trees) < target:
        prefix -= 1
    return prefix


def shingles(column, n=SHINGLE):
    """Hashes of all shingles, and the index of each document's first."""
    raw, offsets = buffer(column)
    starts, ends, first = words(raw, offsets, SPACE_WORDS)
    h = word_hashes(raw, starts, ends)
    count = np.diff(first)
    sizes = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(begin[-1]), np.uint64)
    if len(h) >= n:
        doc = doc_of(first, len(h))
        w = window_hashes(h, n)
        at = np.flatnonzero(doc[: len(w)] == doc[n - 1 :])
        out[at - first[doc[at]] + begin[doc[at]]] = w[at]
    for d in np.flatnonzero((count > 0) & (count < n)):
        out[begin[d]] = window_hashes(h[first[d] : first[d + 1]], int(count[d]))[0] ^ np.uint64(count[d])
    return out, begin


RUN_SHINGLES = 1 << 15


def signatures(h, begin, size, seed=0xA5):
    """size minima (32 bits) of each document; documents without shingles get zeros."""
    rng = np.random.default_rng(seed)
    flip, one, two = (rng.integers(0, 2**31, size, dtype=np.uint32) for _ in range(3))
    one, two = one * np.uint32(2) + np.uint32(1), two * np.uint32(2) + np.uint32(1)
    has = np.flatnonzero(np.diff(begin))
    out = np.zeros((len(begin) - 1, size), np.uint32)
    short = (h >> np.uint64(32)).astype(np.uint32)
    lo = 0
    while lo < len(has):  # runs of documents that stay in the processor's cache
        hi = max(int(np.searchsorted(begin[has + 1], begin[has[lo]] + RUN_SHINGLES, "right")), lo + 1)
        docs = has[lo:hi]
        from_, to = begin[docs[0]], begin[docs[-1] + 1]
        part, heads = short[from_:to], begin[docs] - from_
        x, y = np.empty_like(part), np.empty_like(part)
        for k in range(size):
            np.bitwise_xor(part, flip[k], out=x)
            np.multiply(x, one[k], out=x)
            np.right_shift(x, np.uint32(15), out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, two[k], out=x)
            out[docs, k] = np.minimum.reduceat(x, heads)
        lo = hi
    return out


LABEL = np.dtype(">u2")


def labels(minima):
    """Sixteen bits of each minimum, as one row of bytes per text; the labels of its trees, one after the other."""
    return (mix(minima.astype(np.uint64)) >> np.uint64(48)).astype(LABEL)


def node_of(tree, label, level):
    """The node that each label lies in at this level. label: 16-bit numbers, one row each."""
    key = mix(np.asarray(tree).astype(np.uint64) + np.uint64(1 + 1000 * level))
    for p in range(level):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) ^ (label[:, p].astype(np.uint64) + np.uint64(1)))
    return key | np.uint64(1)  # never 0, which stands for no node


def late(t1, t2):
    """A number beyond all doc_ids that are in use, from a text's hashes."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(2), t1, t2), 2) + F.lit(1 << 62)


def keyed(docs: DataFrame, doc_id, text) -> DataFrame:
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), F.col(text).alias("text"))
    return rows.select("doc_id", F.coalesce("doc_id", late("t1", "t2")).alias("k"), "t1", "t2", "text")


SIGNED = "doc_id bigint, k bigint, t1 bigint, t2 bigint, size int, labels binary"


def forest(rows: DataFrame, n, trees, depth) -> DataFrame:
    """Per document the number of its shingles and its labels, all trees in one; null for a text without words."""

    def run(batch):
        for part in slices(batch, 4):
            h, begin = shingles(part.column(4), n)
            made = labels(signatures(h, begin, trees * depth))
            size = np.diff(begin)
            rows_ = [row.tobytes() if has else None for row, has in zip(made, size > 0, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(size, pa.int32()), pa.array(rows_, pa.binary())], [c.split()[0] for c in SIGNED.split(", ")])

    return batches(rows, run, SIGNED)


def trie(reps: DataFrame, trees, depth) -> DataFrame:
    """The leaves of all trees, sorted by tree and label: tree, label, id, size. reps: id, size, labels."""
    wide = 2 * depth
    each = reps.where("labels IS NOT NULL").select("id", "size", "labels", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    leaves = each.select("tree", F.substring("labels", F.col("tree") * wide + 1, F.lit(wide)).alias("label"), "id", "size")
    # By ranges of (tree, label, id), so that a prefix which very many texts share is spread over tasks.
    return leaves.repartitionByRange("tree", "label", "id").sortWithinPartitions("tree", "label", "id")


def _label_rows(column, depth):
    return np.frombuffer(b"".join(column.to_pylist()), LABEL).reshape(-1, depth)


def nodes_at(leaves: DataFrame, level, depth) -> DataFrame:
    """The nodes of a level that hold two texts or more: node, n, bytes, and what tells sets of members apart.

    Runs of equal prefixes are added up where the sorted leaves are read; only their sums are shuffled.
    """

    def run(batch):
        node = node_of(batch.column(0), _label_rows(batch.column(1), depth), level)
        key = np.asarray(batch.column(2))
        head = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        n = np.diff(np.append(head, len(node)))
        mark = signed(np.bitwise_xor.reduceat(mix(key.view(np.uint64)), head))
        size = np.add.reduceat(np.asarray(batch.column(3)).astype(np.int64), head) * 8
        columns = [signed(node[head]), n.astype(np.int64), size, mark, np.minimum.reduceat(key, head), np.maximum.reduceat(key, head)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "n", "bytes", "mark", "lo", "hi"])

    parts = batches(leaves, run, "node bigint, n bigint, bytes bigint, mark bigint, lo bigint, hi bigint")
    return parts.groupBy("node").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.bit_xor("mark").alias("mark"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("n > 1")


def placed(leaves: DataFrame, level, depth) -> DataFrame:
    """The node of each leaf at a level: id, tree, node."""

    def run(batch):
        node = node_of(batch.column(0), _label_rows(batch.column(1), depth), level)
        yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0), pa.array(signed(node))], ["id", "tree", "node"])

    return batches(leaves, run, "id bigint, tree int, node bigint")


def intersections(sets):
    """Sizes of the intersections of all two sets, as a matrix."""
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]], float)
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = count > 1
    number = np.cumsum(shared) - 1
    pick = shared[code]
    row, code = row[pick], number[code[pick]]
    out = np.diag(np.array([len(s) for s in sets], float))
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    total = np.zeros((n, n), np.float32)
    for lo in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(code, [lo, lo + COLUMNS])
        m = np.zeros((n, COLUMNS), np.float32)
        m[row[a:b], code[a:b] - lo] = 1
        total += m @ m.T
    np.fill_diagonal(total, 0)
    return out + total


def _smallest_connected(linked, keys):
    """For each row the smallest key it is connected with."""
    label = keys.copy()
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (new == label).all():
            return label
        label = new


FOUND = "k bigint, parent bigint, links bigint, alike array<bigint>"


def verify(block, threshold, trees, depth, before):
    """Links among the texts of one task: per text with a link, their number and the smallest connected text; then their similarities.

    Pairs that share a prefix of `before` minima are left out: a longer prefix had brought them together.
    """
    node, lo, hi = (block.column(c)[0].as_py() for c in range(3))
    keys = np.asarray(block.column("id"))
    own = np.asarray(block.column("own"))
    sets = [np.frombuffer(s, "<u8") for s in block.column("sh").to_pylist()]
    inter = intersections(sets)
    size = np.array([len(s) for s in sets], float)
    union = size[:, None] + size[None, :] - inter
    # The same comparison a brute-force check makes, on whole numbers.
    linked = inter >= threshold * union - 1e-9
    linked &= keys[:, None] != keys[None, :]
    if lo != hi:
        linked &= own[:, None] != own[None, :]
    if not linked.any():
        return
    a, b = np.nonzero(np.triu(linked))
    nodes = np.array(block.column("nodes").to_pylist())
    same = (nodes[a] == nodes[b]) & (nodes[a] != 0)
    mine = nodes[a, same.argmax(axis=1)] == node
    if before:
        label = _label_rows(block.column("labels"), trees * depth).reshape(-1, trees, depth)[:, :, :before]
        mine &= ~(label[a] == label[b]).all(axis=2).any(axis=1)
    a, b = a[mine], b[mine]
    if not len(a):
        return
    linked = np.zeros_like(linked)
    linked[a, b] = linked[b, a] = True
    links = linked.sum(axis=1)
    has = np.flatnonzero(links)
    parent = _smallest_connected(linked, keys)
    alike = np.clip((inter[a, b] / union[a, b] - threshold) / max(1 - threshold, 1e-9) * BINS, 0, BINS - 1).astype(np.int64)
    none = pa.nulls(len(has), pa.list_(pa.int64()))
    names = [c.split()[0] for c in FOUND.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array(keys[has]), pa.array(parent[has]), pa.array(links[has].astype(np.int64)), none], names)
    gap = pa.nulls(1, pa.int64())
    yield pa.RecordBatch.from_arrays([gap, gap, gap, pa.array([np.bincount(alike, minlength=BINS).tolist()], pa.list_(pa.int64()))], names)


def candidates(rows: DataFrame, reps: DataFrame, mine: DataFrame, n, trees) -> DataFrame:
    """Texts that share a node with another: id, the nodes to verify (0 where none), their sizes, labels, shingles."""

    def run(batch):
        for part in slices(batch, 1):
            h, begin = shingles(part.column(1), n)
            sets = [np.unique(h[begin[d] : begin[d + 1]]).astype("<u8").tobytes() for d in range(part.num_rows)]
            lists = []
            for at in part.column(2).to_pylist():
                line = [0] * trees
                for x in at:
                    line[x["tree"]] = x["node"]
                lists.append(line)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lists, pa.list_(pa.int64())), part.column(2), part.column(3), pa.array(sets, pa.binary())], ["id", "nodes", "at", "labels", "sh"])

    # Merge joins at every size: a broadcast of the members would end at some size of the corpus.
    wanted = stored(reps.join(mine.hint("merge"), "id").select(*KEY, "id", "labels", "at"), "members")
    wanted = rows.drop("doc_id").join(wanted.hint("merge"), KEY).dropDuplicates(KEY).select("id", "text", "at", "labels")
    return stored(batches(wanted, run, "id bigint, nodes array<bigint>, at array<struct<tree:int,node:bigint,parts:int>>, labels binary, sh binary"), "shingles")


def verified(found: DataFrame, threshold, trees, depth, before) -> DataFrame:
    """FOUND of all tasks. A node is dealt into as many blocks as it has parts; every two meet once."""
    each = found.select("id", "nodes", "labels", "sh", F.explode("at").alias("x")).select("id", "nodes", "labels", "sh", F.col("x.node").alias("node"), F.col("x.parts").alias("parts"))
    each = each.withColumn("own", F.pmod(F.xxhash64("id", "node"), "parts").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = each.select("node", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "id", "nodes", "labels", "sh")
    dealt = dealt.repartition("node", "lo", "hi").sortWithinPartitions("node", "lo", "hi", "id")

    def run(it):
        for part in runs(it, 3):
            yield from verify(part, threshold, trees, depth, before)

    return dealt.mapInArrow(run, FOUND)


def linked(rows: DataFrame, reps: DataFrame, threshold, n, trees, depth, target, block) -> DataFrame:
    """FOUND of all levels of the forest, the prefixes shortened until the target recall."""
    leaves = stored(trie(reps, trees, depth), "trie")
    level, before, found, every, done = depth, 0, np.zeros(BINS), None, None
    while True:
        sets = nodes_at(leaves, level, depth)
        if done is not None:  # what has gained no text since it was verified
            sets = sets.join(done, ["n", "mark", "lo", "hi"], "left_anti")
        parts = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.max("bytes") / BLOCK_BYTES)).cast("int")
        kept = stored(sets.groupBy("n", "mark", "lo", "hi").agg(F.min("node").alias("node"), parts.alias("parts")), "nodes")
        mine = placed(leaves, level, depth).join(kept.select("node", "parts"), "node").groupBy("id").agg(F.collect_list(F.struct("tree", "node", "parts")).alias("at"))
        here = stored(verified(candidates(rows, reps, mine, n, trees), threshold, trees, depth, before), "links")
        every = here if every is None else every.unionByName(here)
        for row in here.where("alike IS NOT NULL").select(F.posexplode("alike").alias("bin", "n")).groupBy("bin").agg(F.sum("n").alias("n")).collect():
            found[row["bin"]] += row["n"]
        if level == 1 or expected_recall(level, found, level, threshold, trees) >= target:
            return every.where("k IS NOT NULL").drop("alike")
        done = kept.select("n", "mark", "lo", "hi") if done is None else done.unionByName(kept.select("n", "mark", "lo", "hi"))
        level, before = shortened(level, found, level, threshold, trees, target), level


def classed(docs: DataFrame, doc_id="doc_id", text="text", threshold=THRESHOLD, n=SHINGLE, trees=TREES, depth=DEPTH, target=TARGET_RECALL, block=BLOCK) -> DataFrame:
    """One row per document row: doc_id, k, t1, t2 and what jaccard_join() says of its text."""
    rows = texts(keyed(docs, doc_id, text), "doc_id", *KEY, "text")
    with recorded() as made:
        signed_ = stored(forest(rows, n, trees, depth), "signatures")
        classes = signed_.groupBy("t1", "t2").agg(F.min("k").alias("k"), F.count("*").alias("n_copies"))
        other = F.row_number().over(Window.partitionBy("k").orderBy("t1", "t2")) > 1
        classes = stored(classes.withColumn("id", F.when(other, late("t1", "t2")).otherwise(F.col("k"))), "classes")
        reps = stored(signed_.select(*KEY, "size", "labels").join(classes.select(*KEY, "id"), KEY).dropDuplicates(KEY), "representatives")
        found = linked(rows, reps, threshold, n, trees, depth, target, block)
        joined = connected_components(found.select(F.col("k").alias("u"), F.col("parent").alias("v")))
        links = found.groupBy(F.col("k").alias("id")).agg(F.sum("links").alias("n_links"))
        named = classes.join(links, "id", "left").join(joined.select(F.col("node").alias("id"), "component"), "id", "left")
        named = stored(named.select("t1", "t2", F.coalesce("component", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.col("id").alias("text_id"), "n_copies", F.col("k").alias("first")), "classes")
    delete(docs.sparkSession, made, (signed_, named))
    return signed_.select("doc_id", *KEY).join(named, ["t1", "t2"])


def jaccard_join(docs: DataFrame, doc_id="doc_id", text="text", **options) -> DataFrame:
    """One row per document row: doc_id, class_id (smallest doc_id it is connected with), n_links
    (other texts of at least this similarity), text_id (smallest doc_id of its copies), n_copies."""
    return classed(docs, doc_id, text, **options).select("doc_id", "k", "class_id", "n_links", "text_id", "n_copies")


def one_of_each(docs: DataFrame, doc_id="doc_id", text="text", **options) -> DataFrame:
    """The documents, with all their columns, less those that are copies or near copies: of each class one text stays.

    It is the text of the smallest doc_id, and of its copies the one with that doc_id; rows equal in both are copies.
    """
    first = classed(docs, doc_id, text, **options).where("text_id = class_id AND k = first").groupBy(*KEY).agg(F.count("*").alias("rows"))
    *keys, n = names = free(docs, "_k", "_t1", "_t2", "_rows")
    first = stored(first.select(*[F.col(c).alias(name) for c, name in zip((*KEY, "rows"), names, strict=True)]), "first")
    t1, t2 = F.xxhash64(text), F.xxhash64(F.lit(1), text)
    made = [F.coalesce(F.col(doc_id).cast("bigint"), late(t1, t2)), t1, t2]
    kept = docs.select("*", *[e.alias(name) for e, name in zip(made, keys, strict=True)]).join(first.hint("merge"), keys)
    if not first.where(F.col(n) > 1).isEmpty():
        kept = kept.dropDuplicates(keys)
    return kept.select(*docs.columns)
