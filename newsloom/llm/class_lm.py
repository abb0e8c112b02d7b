"""LM scoring with a Brown class-based bigram model (operator 8).

Texts become shards: rows of a stored table that hold the documents' words as numbers into the
shard's own sorted vocabulary of word hashes. All counts are taken from those, over all training
documents:

1. Word counts: one row per shard and word, summed by word.
2. Frequent words: those that make up at least 1 / `max_words` of the training tokens (so there are
   at most `max_words` of them, whatever the corpus) are exchanged between classes; meanwhile every
   other word stands for its shape (length, last character), the end of a text for itself. Bigram
   counts between these symbols are summed in Spark; each sweep brings together, by word, how often
   it stands before and after each class, and moves it to the class with the highest likelihood.
   The driver holds the classes and the table of class bigrams, nothing else.
3. Rarer words: the classes before and after each of them, in all shards, are brought together by
   ranges of word hashes, and each word goes to the class that the exchange likelihood names for
   these counts. So every trained word has a learnt class. Class and count go back to the shards, so
   that no vocabulary is ever sent whole. The class bigrams are then counted again, with all words
   in place. Both ways, what one shard and one range share is one row; there are as many ranges as
   shards, so no task grows with the corpus.
4. Scoring: shard by shard, from its words' classes and counts.

There are as many classes as the cube root of the number of trained words, or `n_classes` if that is given. Of
equal gains a word takes the class of the lowest number.

P(word | previous) = P(class | previous class) * P(word | class). Transitions are smoothed towards
the class's own frequency; emissions add DELTA, and words never seen share one place in their class,
which is the one that holds most of the rarer words of their shape.

Null and empty texts are one token, the end; texts of any length are taken whole, as one shard if need be; an
empty table gives an empty one. A null doc_id is held out of nothing and scored with the
rest. Repeated rows count as often as they stand; extra columns are ignored. With no training
tokens at all every word is unknown.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.frames import batches, delete, recorded, runs, stored, texts
from newsloom.llm.kernels import LOWER, SPACE_WORDS, buffer, slices, word_hashes, words

MAX_WORDS = 20_000
SWEEPS = 6
SHARD_BYTES = 16_000_000
N_SHAPES = 16
DELTA = 0.5
KAPPA = 50.0


def pack(x) -> bytes:
    """Numbers from 0 up, below 2**32, as compressed byte planes."""
    if len(x) and int(x.max()) >= 1 << 32:
        raise ValueError("a count or place of 2**32 or more")
    planes = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(b: bytes):
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


SHARD = "shard bigint, ids binary, train binary, first binary, codes binary, vocab binary, shapes binary, counts binary"


def _shard(number, parts):
    """One row of the table from the tokens of some batches."""
    ids = pa.concat_arrays([p[0] for p in parts])
    train = np.concatenate([p[1] for p in parts])
    h = np.concatenate([p[2] for p in parts])
    shape = np.concatenate([p[3] for p in parts])
    n = np.concatenate([p[4] for p in parts])
    vocab, at, codes = np.unique(h, return_index=True, return_inverse=True)
    known = np.asarray(ids.is_valid())
    learned = codes[np.repeat(train, n)]
    blobs = (
        np.concatenate([np.asarray(ids.fill_null(0)), known]).astype("<i8").tobytes(),
        train.astype(np.uint8).tobytes(),
        np.concatenate([[0], np.cumsum(n)]).astype("<i8").tobytes(),
        pack(codes),
        vocab.astype("<u8").tobytes(),
        shape[at].astype(np.uint8).tobytes(),
        np.bincount(learned, minlength=len(vocab)).astype("<i4").tobytes(),
    )
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *[pa.array([b], pa.binary()) for b in blobs]], [c.split()[0] for c in SHARD.split(", ")])


def tokenize(column):
    raw, offsets = buffer(column)
    raw = LOWER[raw]
    starts, ends, first = words(raw, offsets, SPACE_WORDS)
    h = word_hashes(raw, starts, ends)
    last = raw[ends - 1] if len(ends) else raw[:0]
    letter = ((last >= 97) & (last <= 122)) | (last >= 128)
    shape = np.minimum((ends - starts - 1) // 2, N_SHAPES // 2 - 1) * 2 + letter
    return h, shape.astype(np.uint8), np.diff(first)


def shard_table(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), (F.coalesce(F.crc32(F.col(doc_id).cast("string")), F.lit(0)) % 5 != 1).alias("train"))

    def run(it):
        base, k, parts, size = TaskContext.get().partitionId() << 32, 0, [], 0
        for batch in it:
            for part in slices(batch, 1):
                h, shape, n = tokenize(part.column(1))
                parts.append((part.column(0), np.asarray(part.column(2)), h, shape, n))
                size += part.column(1).nbytes
                if size >= SHARD_BYTES:
                    yield _shard(base + k, parts)
                    k, parts, size = k + 1, [], 0
        if parts:
            yield _shard(base + k, parts)

    return texts(rows, "doc_id", "text", "train").mapInArrow(run, SHARD)


def word_counts(shards: DataFrame, n_shards: int) -> DataFrame:
    """Training count of every word of the training documents. A shard has a word once, so there is little to add up before the shuffle."""

    def run(it):
        for batch in it:
            for vocab, counts in zip(*[batch.column(k).to_pylist() for k in range(2)], strict=True):
                n = np.frombuffer(counts, "<i4").astype(np.int64)
                learned = n > 0
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(vocab, "<i8")[learned]), pa.array(n[learned])], ["h", "n"])

    return shards.select("vocab", "counts").mapInArrow(run, "h bigint, n bigint").repartition(n_shards, "h").groupBy("h").agg(F.sum("n").alias("n"))


class Frequent:
    """The words in the exchange: sorted hashes and their counts. Symbols: these, then the shapes, then the end."""

    def __init__(self, hashes, counts):
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order]
        self.n = len(self.hashes)
        self.end = self.n + N_SHAPES

    def symbols(self, vocab, shapes):
        if not self.n:
            return self.n + shapes.astype(np.int64)
        at = np.minimum(np.searchsorted(self.hashes, vocab), self.n - 1)
        return np.where(self.hashes[at] == vocab, at, self.n + shapes.astype(np.int64))


def with_ends(symbols, first, end):
    """The symbols of all documents, each document's followed by the end, and each document's first place."""
    return np.insert(symbols, first[1:], end), first + np.arange(len(first))


def bigrams(shards: DataFrame, frequent: Frequent, n_shards: int) -> DataFrame:
    """Counts of neighbouring symbols in the training documents; a text begins after an end."""

    def run(it):
        for batch in it:
            for train, first, codes, vocab, shapes in zip(*[batch.column(k).to_pylist() for k in range(5)], strict=True):
                sym = frequent.symbols(np.frombuffer(vocab, "<u8"), np.frombuffer(shapes, np.uint8))[unpack(codes)]
                seq, begin = with_ends(sym, np.frombuffer(first, "<i8"), frequent.end)
                learned = np.repeat(np.frombuffer(train, np.uint8).astype(bool), np.diff(begin))
                before = np.concatenate([[frequent.end], seq[:-1]])
                pairs, n = np.unique((before * (frequent.end + 1) + seq)[learned], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array((pairs // (frequent.end + 1)).astype(np.int32)), pa.array((pairs % (frequent.end + 1)).astype(np.int32)), pa.array(n.astype(np.int64))], ["a", "b", "n"])

    return shards.select("train", "first", "codes", "vocab", "shapes").mapInArrow(run, "a int, b int, n bigint").repartition(n_shards, "a", "b").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _summed(it, pairs_of, names):
    """Batches (*keys, n) with equal keys of one batch added up; pairs_of gives (keys as one number, n, how to split them)."""
    for batch in it:
        key, n, split = pairs_of(*(np.asarray(batch.column(c)).astype(np.int64) for c in range(3)))
        keys, back = np.unique(key, return_inverse=True)
        total = np.bincount(back, n, len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([*map(pa.array, split(keys)), pa.array(total)], names)


def class_table(pairs: DataFrame, classes):
    """How often each class follows each."""
    k = int(classes.max()) + 1

    def run(it):
        yield from _summed(it, lambda a, b, n: (classes[a] * k + classes[b], n, lambda x: (x,)), ["key", "n"])

    got = pairs.select("a", "b", "n").mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    flat = np.zeros(k * k)
    flat[np.asarray(got.column("key"))] = np.asarray(got.column("n"))
    return flat.reshape(k, k)


def moves(pairs: DataFrame, classes, table, movable, n_free) -> DataFrame:
    """w, class: the likeliest class of each word for which `movable` holds, given the classes of all others."""
    k = len(table)
    wide = 2 * k + 1  # of a word: classes after it, classes before it, itself

    def gather(it):
        def keys(a, b, n):
            own = a == b
            word = np.concatenate([a, b, a[own]])
            place = np.concatenate([classes[b], k + classes[a], np.full(int(own.sum()), 2 * k)])
            pick = movable[word]
            return (word * wide + place)[pick], np.concatenate([n, n, n[own]])[pick], lambda x: (x // wide, x % wide)

        yield from _summed(it, keys, ["w", "at", "n"])

    def move(it):
        for batch in it:
            words_, places, counts = (batch.column(c) for c in range(3))
            out = []
            for w, at, n in zip(words_.to_pylist(), places, counts, strict=True):
                x = np.zeros(wide)
                x[np.asarray(at.values)] = np.asarray(n.values)
                out.append(best_class(0, classes[w : w + 1], table, x[None, :k], x[None, k : 2 * k], x[2 * k :], n_free)[0])
            yield pa.RecordBatch.from_arrays([words_, pa.array(out, pa.int64())], ["w", "class"])

    seen = pairs.select("a", "b", "n").mapInArrow(gather, "w bigint, at bigint, n bigint").groupBy("w", "at").agg(F.sum("n").alias("n"))
    lists = seen.groupBy("w").agg(F.collect_list(F.struct("at", "n")).alias("x")).select("w", "x.at", "x.n")
    return lists.mapInArrow(move, "w bigint, class bigint")


def _xlogx(x):
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def _likelihood(table):
    return _xlogx(table).sum() - _xlogx(table.sum(1)).sum() - _xlogx(table.sum(0)).sum()


def _tables(after, classes):
    table = np.zeros((after.shape[1],) * 2)
    np.add.at(table, classes, after)
    return table


def best_class(w, classes, table, after, before, own, n_free):
    """The class of the exchange among the first n_free that word w makes likeliest, and the gain."""
    g = classes[w]
    s, p, o = after[w].copy(), before[w].copy(), own[w]
    rest = table.copy()
    # Take w out of its class; its own pair lies in the corner once, not twice.
    rest[g] -= s
    rest[:, g] -= p
    rest[g, g] += o
    s[g] -= o
    p[g] -= o
    rows, cols = rest.sum(1) + p, rest.sum(0) + s  # of the other words, w as their neighbour included
    cand = np.arange(n_free)
    out, into = s.sum() + o, p.sum() + o
    gain = (_xlogx(rest[:n_free] + s) - _xlogx(rest[:n_free])).sum(1)
    gain += (_xlogx(rest[:, :n_free] + p[:, None]) - _xlogx(rest[:, :n_free])).sum(0)
    corner = rest[cand, cand]
    gain += _xlogx(corner + s[cand] + p[cand] + o) + _xlogx(corner) - _xlogx(corner + s[cand]) - _xlogx(corner + p[cand])
    gain -= _xlogx(rows[:n_free] + out) - _xlogx(rows[:n_free]) + _xlogx(cols[:n_free] + into) - _xlogx(cols[:n_free])
    best = int(np.argmax(gain))
    return (best, gain[best] - gain[g]) if gain[best] > gain[g] + 1e-9 else (int(g), 0.0)


def exchange(pairs: DataFrame, frequent: Frequent, n_classes: int, sweeps=SWEEPS):
    """(class of every symbol, class bigram table): the likeliest of all sweeps."""
    fixed = n_classes + np.arange(N_SHAPES + 1)
    rank = np.empty(frequent.n, np.int64)
    rank[np.lexsort((frequent.hashes, -frequent.counts))] = np.arange(frequent.n)
    classes = np.concatenate([rank % n_classes, fixed])
    best = None
    for sweep in range(sweeps + 1):
        table = class_table(pairs, classes)
        value = _likelihood(table)
        if best is None or value > best[0]:
            best = (value, classes, table)
        if sweep == sweeps:
            break
        # Words move at once, given the others' classes; half of them a sweep, so that pairs don't swap.
        movable = np.arange(len(classes)) < frequent.n
        if sweep:
            movable &= np.arange(len(classes)) % 2 == sweep % 2
        got = moves(pairs, classes, table, movable, n_classes).toArrow()
        moved = classes.copy()
        moved[np.asarray(got.column("w"))] = np.asarray(got.column("class"))
        if (moved == classes).all():
            break
        classes = moved
    return best[1], best[2]


CONTEXTS = "bucket int, shard bigint, h binary, slots binary, sizes binary, near binary"
ASSIGNED = "shard bigint, slots binary, counts binary, classes binary, firsts binary"
GAIN_ROWS = 16_384


def _names(schema):
    return [c.split()[0] for c in schema.split(", ")]


def _blobs(x, edges):
    """The parts of x between the edges, as binaries."""
    offsets = (np.asarray(edges) * x.itemsize).astype("<i4")
    return pa.BinaryArray.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(x).tobytes())])


def contexts(shards: DataFrame, frequent: Frequent, classes, n_buckets) -> DataFrame:
    """The rarer words of each shard, by ranges of their hashes (buckets): hash, slot, and the classes before (c) and after (k + c) all training occurrences."""
    k = int(classes.max()) + 1

    def run(it):
        for batch in it:
            for shard, train, first, codes, vocab, shapes in zip(*[batch.column(c).to_pylist() for c in range(6)], strict=True):
                h, shapes = np.frombuffer(vocab, "<u8"), np.frombuffer(shapes, np.uint8)
                sym = np.append(frequent.symbols(h, shapes), frequent.end)
                # Narrow types: these arrays hold every token of the shard.
                seq, begin = with_ends(unpack(codes).astype(np.int32), np.frombuffer(first, "<i8"), len(h))
                learned = np.repeat(np.frombuffer(train, np.uint8).astype(bool), np.diff(begin))
                cls = classes.astype(np.uint16)[sym][seq]
                rare = (sym >= frequent.n) & (sym < frequent.end)
                at = np.flatnonzero(learned & rare[seq])
                before = np.where(at > 0, cls[at - 1], np.uint16(classes[frequent.end]))
                slot = seq[at]
                order = np.argsort(slot, kind="stable")
                near = np.stack([before[order], (np.uint16(k) + cls[at + 1])[order]], 1).ravel()
                slots = np.flatnonzero(rare[:-1])  # held-out places too: they need the word's class and count
                n = 2 * np.bincount(slot, minlength=len(h))[slots]
                # The vocabulary is sorted, so a bucket is a run of slots.
                bucket = ((h[slots] >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
                edges = np.searchsorted(bucket, np.arange(n_buckets + 1, dtype=np.uint64))
                filled = np.flatnonzero(np.diff(edges))
                edges = np.append(edges[filled], len(slots))
                ends = np.concatenate([[0], np.cumsum(n)])[edges]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(filled, pa.int32()), pa.array(np.full(len(filled), shard, np.int64)), _blobs(h[slots], edges), _blobs(slots.astype("<i4"), edges), _blobs(n.astype("<i4"), edges), _blobs(near, ends)], _names(CONTEXTS)
                )

    return shards.select("shard", "train", "first", "codes", "vocab", "shapes").mapInArrow(run, CONTEXTS)


def likeliest(word, event, table, n_free):
    """The class among the first n_free that each word 0, 1, ... makes likeliest, from its events (contexts()), and its count.

    Words are placed by the table as it is; classes without a word are no choice, as one would draw in all words that occur once.
    """
    k = len(table)
    size = int(word.max(initial=-1)) + 1
    n = np.bincount(word, minlength=size) // 2
    key, times = np.unique(word * (2 * k) + event, return_counts=True)
    of, event = key // (2 * k), key % (2 * k)
    heads = np.searchsorted(of, np.arange(size + 1))
    # Words that occur once, between the same two classes, go to the same class: one of them stands for all.
    once = np.flatnonzero(n == 1)
    _, some, alike = np.unique(event[heads[once]] * (2 * k) + event[heads[once] + 1], return_index=True, return_inverse=True)
    chosen = n > 1
    chosen[once[some]] = True
    pick = np.repeat(chosen, np.diff(heads))
    best = np.zeros(size, np.int64)
    best[chosen] = _best(event[pick], times[pick], np.concatenate([[0], np.cumsum(np.diff(heads)[chosen])]), n[chosen], table, n_free)
    best[once] = best[once[some]][alike]
    return best, n


def _best(event, times, heads, n, table, n_free):
    """The likeliest class of each word; its events are those from its head to the next."""
    # Row e: how often each class stands beside the neighbour of event e. Before a word: column; after it: row.
    beside = np.concatenate([table[:, :n_free], table[:n_free].T])
    now = _xlogx(beside)
    once = _xlogx(beside + 1) - now
    rows, cols = table.sum(1)[:n_free], table.sum(0)[:n_free]
    shut = np.where(rows + cols > 0, 0.0, -np.inf)
    if not np.isfinite(shut).any():
        shut[:] = 0
    size = len(n)
    best = np.empty(size, np.int64)
    a = 0
    while a < size:
        b = max(int(np.searchsorted(heads, heads[a] + GAIN_ROWS, "right")) - 1, a + 1)
        e, m = event[heads[a] : heads[b]], times[heads[a] : heads[b]]
        gain = once[e]
        more = np.flatnonzero(m > 1)
        gain[more] = _xlogx(beside[e[more]] + m[more, None]) - now[e[more]]
        gain = np.add.reduceat(gain, heads[a:b] - heads[a], axis=0)
        many, back = np.unique(n[a:b], return_inverse=True)
        gain -= (_xlogx(rows + many[:, None]) - _xlogx(rows) + _xlogx(cols + many[:, None]) - _xlogx(cols))[back]
        best[a:b] = np.argmax(gain + shut, axis=1)
        a = b
    return best


def assigned(rows: DataFrame, table, n_free, n_buckets) -> DataFrame:
    """Class and training count of each rarer word, at every place it has, a row for each shard and bucket; first: one of its places."""

    def place(part):
        shard = np.asarray(part.column("shard"))
        h, slots, sizes, near = (np.frombuffer(b"".join(part.column(c).to_pylist()), kind) for c, kind in (("h", "<u8"), ("slots", "<i4"), ("sizes", "<i4"), ("near", "<u2")))
        ends = np.concatenate([[0], np.cumsum([len(x) // 8 for x in part.column("h").to_pylist()])])
        _, at, word = np.unique(h, return_index=True, return_inverse=True)
        first = np.zeros(len(h), np.uint8)
        first[at] = 1
        times = np.bincount(word, sizes, len(at)).astype(np.int64)
        trained = times > 0
        best, n = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        best[trained], n[trained] = likeliest((np.cumsum(trained) - 1)[np.repeat(word, sizes)], near.astype(np.int64), table, n_free)
        keep = trained[word]
        for s, lo, hi in zip(shard, ends[:-1], ends[1:], strict=True):
            own = lo + np.flatnonzero(keep[lo:hi])
            yield s, pack(slots[own]), pack(n[word[own]]), pack(best[word[own]]), first[own].tobytes()

    def run(it):
        for part in runs(it, 1):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if k else pa.int64()) for k, c in enumerate(zip(*place(part), strict=True))], _names(ASSIGNED))

    return rows.repartition(n_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(run, ASSIGNED)


KNOWN = "ids binary, train binary, first binary, codes binary, classes binary, counts binary, sorts binary"


def known(shards: DataFrame, found: DataFrame, frequent: Frequent, classes, n_shards) -> DataFrame:
    """The shards with class and training count of each word in place of its hash; a word without is class -1 - shape.

    sorts: by class and shape, the rarer words whose first place is in the shard.
    """
    sizes = (int(classes.max()) + 1) * N_SHAPES

    def often(it):
        for batch in it:
            rows = batch.to_pylist()
            for row in rows:
                sym = frequent.symbols(np.frombuffer(row.pop("vocab"), "<u8"), np.frombuffer(row["shapes"], np.uint8))
                slots = np.flatnonzero(sym < frequent.n)
                row["slots"], row["symbols"] = slots.astype("<i4").tobytes(), sym[slots].astype("<i4").tobytes()
                yield pa.RecordBatch.from_pylist([row], schema=OFTEN_SCHEMA)

    def place(left, right):
        for row in left.to_pylist():
            cls = -1 - np.frombuffer(row["shapes"], np.uint8).astype(np.int16)
            n = np.zeros(len(cls), np.int64)
            slots, sym = np.frombuffer(row["slots"], "<i4"), np.frombuffer(row["symbols"], "<i4")
            cls[slots], n[slots] = classes[sym], frequent.counts[sym]
            sorts = np.zeros(sizes, np.int64)
            shapes = np.frombuffer(row["shapes"], np.uint8)
            for part in right.to_pylist():
                slots, new = unpack(part["slots"]), unpack(part["classes"])
                cls[slots], n[slots] = new, unpack(part["counts"])
                first = np.frombuffer(part["firsts"], np.uint8) > 0
                sorts += np.bincount(new[first] * N_SHAPES + shapes[slots[first]], minlength=sizes)
            yield {**{c: row[c] for c in ("ids", "train", "first", "codes")}, "classes": squeeze(cls.astype("<i2")), "counts": squeeze(n.astype("<i8")), "sorts": squeeze(sorts.astype("<i8"))}

    def run(left, right):
        return pa.Table.from_pylist(list(place(left, right)), schema=KNOWN_SCHEMA)

    rows = shards.select("shard", "ids", "train", "first", "codes", "vocab", "shapes").mapInArrow(often, OFTEN)
    # A shard, not a partition of some size, is what a task takes, so that tasks stay as large as they are.
    left, right = (x.repartition(n_shards, "shard").groupBy("shard") for x in (rows, found))
    return left.cogroup(right).applyInArrow(run, KNOWN)


def squeeze(x) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def stretch(b: bytes, kind):
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


OFTEN = "shard bigint, ids binary, train binary, first binary, codes binary, shapes binary, slots binary, symbols binary"
OFTEN_SCHEMA = pa.schema([(c.split()[0], pa.int64() if c == "shard bigint" else pa.binary()) for c in OFTEN.split(", ")])
KNOWN_SCHEMA = pa.schema([(c.split()[0], pa.binary()) for c in KNOWN.split(", ")])


def class_counts(rows: DataFrame, k):
    """How often each class follows each in the training documents, the end being the last class; rarer words by class and shape."""

    def run(it):
        total, sorts = np.zeros(k * k, np.int64), np.zeros(k * N_SHAPES, np.int64)
        for batch in it:
            for train, first, codes, classes, new in zip(*[batch.column(c).to_pylist() for c in range(5)], strict=True):
                cls = stretch(classes, "<i2").astype(np.int64)
                seq, begin = with_ends(unpack(codes), np.frombuffer(first, "<i8"), len(cls))
                here = np.append(cls, k - 1)[seq]
                learned = np.repeat(np.frombuffer(train, np.uint8).astype(bool), np.diff(begin))
                before = np.concatenate([[k - 1], here[:-1]])
                total += np.bincount((before * k + here)[learned], minlength=k * k)
                sorts += stretch(new, "<i8")
        every = np.concatenate([total, sorts])
        at = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(every[at])], ["key", "n"])

    got = rows.select("train", "first", "codes", "classes", "sorts").mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    every = np.zeros(k * k + k * N_SHAPES)
    every[np.asarray(got.column("key"))] = np.asarray(got.column("n"))
    return every[: k * k].reshape(k, k), every[k * k :].reshape(k, N_SHAPES)


SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


class Model:
    """What scoring needs, of bounded size: transitions, sizes of the classes, the class of the unseen words of each shape."""

    def __init__(self, table, sorts, frequent_kinds, total, distinct, end_count):
        self.total, self.distinct, self.end_count = total, distinct, end_count
        k, mass, kinds = len(table), table.sum(0), sorts.sum(1) + frequent_kinds
        kinds[-1] = min(end_count, 1)
        self.unseen = k - 1 - N_SHAPES + np.arange(N_SHAPES)
        if sorts.any():
            self.unseen = np.where(sorts.any(axis=0), sorts.argmax(axis=0), sorts.sum(axis=1).argmax())
        self.room = np.log10(mass + DELTA * (kinds + 1))
        share = (mass + DELTA) / (mass.sum() + DELTA * k)
        self.move = np.log10((table + KAPPA * share) / (table.sum(1, keepdims=True) + KAPPA))

    def score(self, shard):
        """The columns of SCORES for one shard."""
        ids = np.frombuffer(shard["ids"], "<i8")
        n = len(ids) // 2
        cls, c = stretch(shard["classes"], "<i2").astype(np.int64), stretch(shard["counts"], "<i8")
        cls = np.where(cls < 0, self.unseen[np.maximum(-1 - cls, 0)], cls)
        emit = np.append(np.log10(c + DELTA) - self.room[cls], np.log10(self.end_count + DELTA) - self.room[-1])
        base = np.log10(np.append(c, self.end_count) + 0.5) - np.log10(self.total + 0.5 * (self.distinct + 1))
        known = np.append(c, self.end_count) > 0
        cls = np.append(cls, len(self.room) - 1)
        seq, begin = with_ends(unpack(shard["codes"]), np.frombuffer(shard["first"], "<i8"), len(c))
        here = cls[seq]
        before = np.concatenate([[len(self.room) - 1], here[:-1]])
        doc = np.repeat(np.arange(n), np.diff(begin))
        add = lambda x: np.bincount(doc, x, n)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids[:n], pa.int64(), mask=ids[n:] == 0),
                pa.array(np.frombuffer(shard["train"], np.uint8) == 0),
                pa.array(np.diff(begin), pa.int64()),
                pa.array(add(known[seq]).astype(np.int64)),
                pa.array(np.full(n, self.total), pa.int64()),
                pa.array(add(base[seq])),
                pa.array(add(emit[seq] + self.move[before, here])),
            ],
            [x.split()[0] for x in SCORES.split(", ")],
        )


def score_corpus(docs: DataFrame, doc_id="doc_id", text="text", max_words=MAX_WORDS, n_classes: int | None = None, sweeps=SWEEPS) -> DataFrame:
    """One row per document: SCORES. Perplexity is 10 ** (-score / n_tokens)."""
    shards = stored(shard_table(docs, doc_id, text), "lm-shards")
    n_shards = max(shards.count(), 1)
    counts = stored(word_counts(shards, n_shards), "lm-counts")
    n_train = docs.where(F.coalesce(F.crc32(F.col(doc_id).cast("string")), F.lit(0)) % 5 != 1).count()
    n, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = n + n_train, kinds + (n_train > 0)
    n_classes = n_classes or max(round(kinds ** (1 / 3)), 2)
    least = total / max_words
    top = counts.where(F.col("n") >= least).select("h", "n").toArrow()  # at most max_words rows
    frequent = Frequent(np.asarray(top.column("h")).view(np.uint64), np.asarray(top.column("n")))
    with recorded() as made:
        classes, table = exchange(stored(bigrams(shards, frequent, n_shards), "lm-bigrams"), frequent, n_classes, sweeps)
    delete(docs.sparkSession, [*made, counts.stored_at])
    k = n_classes + N_SHAPES + 1
    full = np.zeros((k, k))
    full[: table.shape[0], : table.shape[1]] = table
    found = assigned(contexts(shards, frequent, classes, n_shards), full, n_classes, n_shards)
    rows = stored(known(shards, found, frequent, classes, n_shards), "lm-known")
    delete(docs.sparkSession, [shards.stored_at])
    model = Model(*class_counts(rows, k), np.bincount(classes[: frequent.n], minlength=k), total, distinct, n_train)

    def run(batch):
        for row in batch.to_pylist():
            yield model.score(row)

    return batches(rows, run, SCORES)
