"""Benchmark decontamination by a distributed positional inverted index (operator 4).

The index is partitioned by documents: each shard holds the postings (token positions) of all its
terms, sorted by term, with the shard's document table. Shards are rows of a stored table, so the
index is written once and searched without a shuffle, and a lost executor only costs its shards.
A phrase is searched from its rarest term in the shard: that term's postings, shifted by its
offset, are intersected with the shifted lists of the other terms, rarest first.

Benchmark items are searched in blocks of a fixed number of words. A block travels as a hash a word and a
number or two, and what it hits is written before the next block is read, so the driver and the tasks hold one block at
a time however large the benchmark is; the index is read once a block.

Null texts have no words and are never hit; benchmark rows with a null item_id are left out.
Rows with the same item_id are one item; repeated document rows are searched one by one. Empty
tables give empty results or no hits. Extra columns are ignored. Texts of any length are taken
whole, as one shard if need be.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.frames import batches, delete, stored, texts
from newsloom.llm.kernels import LOWER, PLAIN_WORDS, buffer, slices, word_hashes, words

WINDOW = 10
BLOCK_WORDS = 2_000_000
LOWER_WORDS = PLAIN_WORDS[LOWER]


def tokens(column):
    """Hashes of all lower-cased words, and the index of each document's first word."""
    raw, offsets = buffer(column)
    raw = LOWER[raw]
    starts, ends, first = words(raw, offsets, PLAIN_WORDS)
    return word_hashes(raw, starts, ends), first


INDEX = "shard bigint, doc_ids binary, first binary, terms binary, lists binary, positions binary"


def shard_blobs(ids, column) -> tuple[bytes, ...]:
    """The columns of one shard: ids with their validity, first words, terms, lists, positions."""
    h, first = tokens(column)
    order = np.argsort(h, kind="stable")
    s = h[order]
    heads = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    parts = (
        np.concatenate([np.asarray(ids.fill_null(0)), np.asarray(ids.is_valid())]).astype("<i8"),
        first.astype("<i4"),
        s[heads].astype("<u8"),
        np.append(heads, len(s)).astype("<i4"),
        order.astype("<i4"),
    )
    return tuple(p.tobytes() for p in parts)


def build_index(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """The index, one row per shard: its number, documents, first word of each, terms, start of each list, positions."""

    def run(it):
        number = TaskContext.get().partitionId() << 32
        for batch in it:
            for part in slices(batch, 1):
                blobs = shard_blobs(part.column(0).cast(pa.int64()), part.column(1))
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *[pa.array([b], pa.binary()) for b in blobs]], [c.split()[0] for c in INDEX.split(", ")])
                number += 1

    return texts(docs, doc_id, text).mapInArrow(run, INDEX)


class Shard:
    """One row of the index, opened."""

    def __init__(self, doc_ids, first, terms, lists, positions, shard=0):
        self.number = shard
        ids = np.frombuffer(doc_ids, "<i8")
        self.n = len(ids) // 2
        self.ids = pa.array(ids[: self.n], pa.int64(), mask=ids[self.n :] == 0)
        self.first = np.frombuffer(first, "<i4")
        self.terms = np.frombuffer(terms, "<u8")
        self.lists = np.frombuffer(lists, "<i4")
        self.positions = np.frombuffer(positions, "<i4")

    def slots(self, wanted):
        """For each wanted term its slot, or -1."""
        if not len(self.terms):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(self.terms, wanted), len(self.terms) - 1)
        return np.where(self.terms[at] == wanted, at, -1)

    def postings(self, slot):
        return self.positions[self.lists[slot] : self.lists[slot + 1]]

    def counts(self, slots):
        return np.where(slots >= 0, self.lists[slots + 1] - self.lists[slots], 0)

    def doc(self, positions):
        return np.searchsorted(self.first, positions, "right") - 1

    def phrase(self, slots, counts):
        """Starts of all occurrences of the phrase whose terms have these slots."""
        order = np.argsort(counts, kind="stable")
        found = self.postings(slots[order[0]]).astype(np.int64) - order[0]
        for k in order[1:]:
            if not len(found):
                return found
            want, have = found + k, self.postings(slots[k])
            at = np.minimum(np.searchsorted(have, want), len(have) - 1)
            found = found[have[at] == want]
        found = found[(found >= 0) & (found + len(slots) <= self.first[-1])]
        return found[self.doc(found) == self.doc(found + len(slots) - 1)]

    def near(self, slots, slop):
        """(start, end) of the spans of at most `slop` words that hold all these terms, in any order: for each last word the shortest."""
        lists = [self.postings(s).astype(np.int64) for s in dict.fromkeys(slots.tolist())]
        if not lists or min(slots) < 0:
            return []
        at = np.concatenate(lists)
        order = np.argsort(at)
        at, of = at[order], np.repeat(np.arange(len(lists)), [len(x) for x in lists])[order]
        out, last, doc = [], {}, -1
        for p, term, d in zip(at.tolist(), of.tolist(), self.doc(at).tolist(), strict=True):
            if d != doc:  # a span lies in one document
                last, doc = {}, d
            last[term] = p
            lo = min(last.values()) if len(last) == len(lists) else p - slop
            if p - lo < slop and not (out and out[-1][0] == lo):
                out.append((lo, p + 1))
        return out


def phrases_of(items: list[tuple[str, str | None]], window=WINDOW):
    """The items' words by length of window: {length: (distinct hashes, place of each word among them, item of each word)}.

    An item of fewer words than the window is one window of its own length. Windows are runs of words of one item.
    """
    h, first = tokens(pa.array([t for _, t in items], pa.string()))
    sizes = np.diff(first)
    lengths = np.minimum(sizes, window)
    item = np.repeat(np.arange(len(items), dtype=np.int32), sizes)
    out = {}
    for n in np.unique(lengths[lengths > 0]).tolist():
        own = lengths[item] == n
        distinct, place = np.unique(h[own], return_inverse=True)
        out[n] = (distinct, place.astype(np.int32), item[own])
    return out


def search(shard: Shard, phrases):
    """All occurrences in one shard: starts, lengths, items."""
    starts, sizes, of = [], [], []
    for n, (distinct, place, item) in phrases.items():
        slots = shard.slots(distinct)
        counts = shard.counts(slots)
        there = np.zeros(len(place) + 1, np.int64)
        np.cumsum(counts[place] > 0, out=there[1:])
        # Windows of one item all of whose words the shard has.
        last = len(place) - n + 1
        rows = np.flatnonzero((there[n:] - there[:last] == n) & (item[:last] == item[n - 1 :]))
        seen: dict[bytes, np.ndarray] = {}
        for row in rows.tolist():
            pick = place[row : row + n]
            key = pick.tobytes()
            if key not in seen:
                seen[key] = shard.phrase(slots[pick], counts[pick])
            if len(found := seen[key]):
                starts.append(found)
                sizes.append(np.full(len(found), n))
                of.append(np.full(len(found), item[row]))
    if not starts:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(starts), np.concatenate(sizes), np.concatenate(of)


HITS = "doc_id bigint, n_words bigint, starts array<int>, ends array<int>, items array<string>"
PLACED = "shard bigint, place int, " + HITS


def find_phrases(index: DataFrame, items: list[tuple[str, str | None]], window=WINDOW) -> DataFrame:
    """One row per document: its shard and place there, its words, the merged spans hit, the items with an occurring window."""
    phrases = phrases_of(items, window)
    names = [i for i, _ in items]

    def run(batch):
        for row in batch.to_pylist():
            shard = Shard(**row)
            starts, sizes, of = search(shard, phrases)
            doc = shard.doc(starts)
            spans: list[tuple[list, list]] = [([], []) for _ in range(shard.n)]
            found: list[set] = [set() for _ in range(shard.n)]
            order = np.lexsort((starts, doc))
            for k in order:
                d, lo = doc[k], int(starts[k] - shard.first[doc[k]])
                s, e = spans[d]
                if e and lo <= e[-1]:
                    e[-1] = max(e[-1], lo + int(sizes[k]))
                else:
                    s.append(lo)
                    e.append(lo + int(sizes[k]))
                found[d].add(names[of[k]])
            ints, texts_ = pa.list_(pa.int32()), pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(shard.n, shard.number, np.int64)),
                    pa.array(np.arange(shard.n, dtype=np.int32)),
                    shard.ids,
                    pa.array(np.diff(shard.first), pa.int64()),
                    pa.array([s for s, _ in spans], ints),
                    pa.array([e for _, e in spans], ints),
                    pa.array([sorted(f) for f in found], texts_),
                ],
                [c.split()[0] for c in PLACED.split(", ")],
            )

    return batches(index, run, PLACED)


def find_near(index: DataFrame, query: str, slop: int) -> DataFrame:
    """Proximity matches: doc_id, start, end of the spans of at most `slop` words that hold all words of the query, in any order.

    A word that the query has twice counts once; a query without words matches nothing. Rows that
    share a doc_id are searched one by one, so each gives its own spans.
    """
    wanted, _ = tokens(pa.array([query]))

    def run(batch):
        rows = []
        for row in batch.to_pylist():
            shard = Shard(**row)
            slots = shard.slots(wanted)
            for lo, hi in shard.near(slots, slop) if len(wanted) and (slots >= 0).all() else []:
                d = int(shard.doc(np.array([lo]))[0])
                rows.append((shard.ids[d].as_py(), lo - int(shard.first[d]), hi - int(shard.first[d])))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "start", "end"])

    return batches(index, run, "doc_id bigint, start bigint, end bigint")


def item_blocks(items: DataFrame, item_id="item_id", text="text", block_words=BLOCK_WORDS):
    """The benchmark's items as lists of bounded size, each read when the one before is done with."""
    rows = items.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).where("i is not null")
    size = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    n = int(size // (6 * block_words)) + 1
    for k in range(n):
        block = rows if n == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [(r["i"], r["t"]) for r in block.collect()]


def contaminated(docs: DataFrame, items: DataFrame, doc_id="doc_id", text="text", item_id="item_id", item_text="text", window=WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, the spans hit by benchmark windows (starts, ends), the items."""
    index = stored(build_index(docs, doc_id, text), "postings")
    blocks = item_blocks(items, item_id, item_text)
    every = stored(find_phrases(index, next(blocks), window), "hits")
    more = [stored(find_phrases(index, block, window).where(F.size("items") > 0), "hits") for block in blocks]
    if not more:
        return every.drop("shard", "place")
    # The spans of one document row come in several rows then. Its shard and place tell it from others of the same id.
    for one in more:
        every = every.unionByName(one)
    merged = every.groupBy("shard", "place").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("starts")).alias("starts"),
        F.flatten(F.collect_list("ends")).alias("ends"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    ).drop("shard", "place")

    def tidy(batch):
        starts, ends = [], []
        for s, e in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            a, b = [], []
            for lo, hi in sorted(zip(s, e, strict=True)):
                if b and lo <= b[-1]:
                    b[-1] = max(b[-1], hi)
                else:
                    a.append(lo)
                    b.append(hi)
            starts.append(a)
            ends.append(b)
        ints = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(starts, ints), pa.array(ends, ints), batch.column(4)], [c.split()[0] for c in HITS.split(", ")])

    return batches(merged, tidy, HITS)


def _cleaner(phrases, at):
    """Keeps the rows of a batch whose text, the column at this place, no window hits."""

    def run(batch):
        for part in slices(batch, at):
            shard = Shard(*shard_blobs(pa.nulls(part.num_rows, pa.int64()), part.column(at)))
            keep = np.ones(part.num_rows, bool)
            keep[shard.doc(search(shard, phrases)[0])] = False
            yield part.filter(pa.array(keep))

    return run


def clean_only(docs: DataFrame, items: DataFrame, text="text", item_id="item_id", item_text="text", window=WINDOW) -> DataFrame:
    """The documents, with all their columns, that no benchmark window hits.

    Each batch is indexed, searched and filtered where it is read, so nothing is shuffled. With more than one
    block of items, what a block leaves is written before the next is read.
    """
    at, out, written = docs.columns.index(text), texts(docs, *docs.columns), []
    for n, block in enumerate(item_blocks(items, item_id, item_text)):
        if n:
            out = stored(out, "clean")
            delete(docs.sparkSession, written)
            written = [out.stored_at]
        out = batches(out, _cleaner(phrases_of(block, window), at), docs.schema)
    return out


def digest(hits: DataFrame) -> DataFrame:
    """The per-document counts of contaminated()."""
    hit = F.aggregate(F.arrays_zip("starts", "ends"), F.lit(0).cast("bigint"), lambda a, x: a + x["ends"] - x["starts"])
    return hits.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
