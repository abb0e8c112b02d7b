"""Substring dedup by level-wise doubling (operator 2).

Level 1 takes windows of a quarter of the final length, thinned by winnowing: of the windows that
start in any run of neighbouring words as long as the final length has room for, the one of smallest
hash is an anchor, so every window of the final length holds an anchor that depends on its words
alone. Anchors found in one text only die.

Each further level takes those that are left to twice the length. At half the final length an anchor
is extended to the left and to the right: a window of the final length that holds it holds one of the
two. An anchor stays if one of its extensions is found in two texts. At the final length every window
that holds a surviving anchor is made. So it goes on in longest_repeats(), window by window, until no
candidate survives.

What is removed is decided at the length `window`: a word goes if a window that covers it also
starts in a document with a smaller doc_id. Longer windows lie inside those, so they add nothing
to the removal; `longest_repeats` reports them.

Exact copies of a whole text need no windows: of all but the first document of each such class
everything goes, if it has a window at all. Windows are compared by 128 bits of hash.

Null or empty texts have no words. Texts of any length are taken whole; one text is held at a time
beyond a batch of 4 MB. A null doc_id counts as the largest. Repeated rows (same doc_id and text) are
one document and get the same result; an empty table gives an empty one; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.frames import batches, delete, free, recorded, stored, texts
from newsloom.llm.kernels import SPACE_WORDS, buffer, doc_of, signed, slices, window_hashes, word_hashes, words

WINDOW = 50
LAST = (1 << 63) - 1
KEY = ["k", "t1", "t2"]


def _sliding(x, n, op):
    """op over each run of n values."""
    done = 1
    while done * 2 <= n:
        x = op(x[:-done], x[done:])
        done *= 2
    rest = n - done
    return op(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(h, first, n, span):
    """Starts of the winnowed n-word windows of documents with `span` words or more, and their hashes."""
    if len(h) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    w = window_hashes(h, n)
    doc = doc_of(first, len(h))
    ok = (doc[: len(w)] == doc[n - 1 :]) & (np.diff(first)[doc[: len(w)]] >= span)
    top = np.uint64(2**64 - 1)
    w = np.where(ok, np.minimum(w, top - np.uint64(1)), top)
    run = span - n + 1
    low = _sliding(w, run, np.minimum)
    padded = np.concatenate([np.zeros(run - 1, np.uint64), low, np.zeros(run - 1, np.uint64)])
    pick = np.flatnonzero((_sliding(padded, run, np.maximum) == w) & ok)
    pick = _thin(pick, w[pick], doc[pick], run)
    return pick, w[pick]


def _thin(pick, value, doc, run):
    """Of neighbouring anchors of equal hash, as repeated words give, only so many that each run still has one."""
    same = (value[1:] == value[:-1]) & (np.diff(pick) < run) & (doc[1:] == doc[:-1])
    if not same.any():
        return pick
    keep = np.ones(len(pick), bool)
    heads = np.flatnonzero(np.concatenate([[True], ~same, [True]]))  # of chains of such neighbours
    for c in np.flatnonzero(np.diff(heads) > 2):
        last = heads[c]
        for k in range(heads[c] + 1, heads[c + 1] - 1):
            if pick[k + 1] - pick[last] > run:
                last = k
            else:
                keep[k] = False
    return pick[keep]


def keyed(docs: DataFrame, doc_id, text) -> DataFrame:
    """Key columns: k orders documents, t1 and t2 are hashes of the whole text."""
    return docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST)).alias("k"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit(1), text).alias("t2"),
        F.col(text).alias("text"),
    )


def _list(values, sizes, kind):
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, kind))


def _tokens(column, which=0):
    raw, offsets = buffer(column)
    starts, ends, first = words(raw, offsets, SPACE_WORDS)
    return raw, starts, ends, first, word_hashes(raw, starts, ends, which)



BASE = "doc_id bigint, k bigint, t1 bigint, t2 bigint, n_words bigint, sha string, hs array<bigint>, ls array<bigint>, rs array<bigint>, ps array<int>"


def levels(window: int) -> tuple[int, int]:
    """The lengths before the final one: each at least half of the next."""
    if window < 4:
        raise ValueError("a window has four words at least")
    return -(-window // 4), -(-window // 2)


def extensions(h, first, pick, doc, short, long):
    """Hashes of the windows of `long` words that end, and that start, with the `short` words at each place; 0 where the text is too short."""
    w = window_hashes(h, long)
    out = []
    for start in (pick + short - long, pick):
        inside = (start >= first[doc]) & (start + long <= first[doc + 1])
        made = np.zeros(len(pick), np.uint64)
        made[inside] = w[start[inside]] | np.uint64(1)
        out.append(made)
    return out


def base_table(docs: DataFrame, window: int) -> DataFrame:
    """Per document: words, digest of the whole text's words, anchors with both extensions."""
    short, long = levels(window)

    def run(batch):
        for part in slices(batch, 4):
            raw, starts, ends, first, h = _tokens(part.column(4))
            pick, hashes = anchors(h, first, short, window)
            doc = doc_of(first, len(h))[pick] if len(pick) else pick
            left, right = extensions(h, first, pick, doc, short, long)
            sizes = np.bincount(doc, minlength=part.num_rows)
            shas = [hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest() for t in part.column(4).to_pylist()]
            lists = [_list(signed(x), sizes, pa.int64()) for x in (hashes, left, right)]
            yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(np.diff(first), pa.int64()), pa.array(shas), *lists, _list(pick - first[doc], sizes, pa.int32())], [c.split()[0] for c in BASE.split(", ")])

    return batches(docs, run, BASE)


def windows(candidates: DataFrame, length: int, reach: int) -> DataFrame:
    """All windows of `length` words that start up to `reach` words before a place in ps: w1, w2, key, p.

    candidates: key columns, text, ps.
    """

    def run(batch):
        for part in slices(batch, 3):
            _, _, _, first, h = _tokens(part.column(3))
            h2 = _tokens(part.column(3), 1)[4]
            ps = part.column(4)
            doc = np.repeat(np.arange(part.num_rows), ps.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            at = ps.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + first[doc]
            mark = np.zeros(len(h) + 1, np.int32)
            np.add.at(mark, np.maximum(at - reach, first[doc]), 1)
            np.add.at(mark, at + 1, -1)
            start = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
            of = doc_of(first, len(h))[start]
            fits = start + length <= first[of + 1]
            start, of = start[fits], of[fits]
            if len(start):
                w1, w2 = window_hashes(h, length)[start], window_hashes(h2, length, 1)[start]
                take = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(w1)), pa.array(signed(w2)), *[part.column(c).take(take) for c in range(3)], pa.array((start - first[of]).astype(np.int32))],
                    ["w1", "w2", *KEY, "p"],
                )

    return batches(candidates, run, "w1 bigint, w2 bigint, k bigint, t1 bigint, t2 bigint, p int")


def in_two_texts(found: DataFrame, *key: str) -> DataFrame:
    """The keys that rows of different texts have."""
    return found.groupBy(*key).agg(F.min("t1").alias("a"), F.max("t1").alias("b")).where("a != b").select(*key)


class Levels:
    """The tables of one run, made level by level."""

    def __init__(self, docs: DataFrame, doc_id="doc_id", text="text", window=WINDOW):
        self.window, self.short = window, levels(window)[0]
        self.rows = texts(keyed(docs, doc_id, text), "doc_id", *KEY, "text")
        self.base = stored(base_table(self.rows, window), "substring-base")
        self.classes = stored(self.base.groupBy("t1", "t2").agg(F.min("k").alias("rep"), F.max("k").alias("last")), "substring-texts-seen")
        found = self.base.where(F.size("hs") > 0).select(*KEY, F.explode(F.arrays_zip("hs", "ls", "rs", "ps")).alias("a")).select(*KEY, F.col("a.hs").alias("h"), F.col("a.ls").alias("l"), F.col("a.rs").alias("r"), F.col("a.ps").alias("p"))
        live = stored(in_two_texts(found, "h"), "substring-live")
        found = stored(found.join(live, "h", "left_semi").select(*KEY, "l", "r", "p"), "substring-anchors")
        # The next level: 1 for the extension to the left, 2 to the right.
        sides = F.array(F.struct(F.lit(1).alias("side"), F.col("l").alias("w")), F.struct(F.lit(2).alias("side"), F.col("r").alias("w")))
        each = found.select(*KEY, "p", F.explode(sides).alias("x")).select(*KEY, "p", "x.side", "x.w").where("w != 0")
        live = stored(in_two_texts(each, "side", "w"), "substring-live")
        places = each.join(live, ["side", "w"], "left_semi")
        firsts = self.classes.select("t1", "t2", F.col("rep").alias("k"))
        wanted = places.groupBy(*KEY).agg(F.collect_set("p").alias("ps")).join(firsts, KEY, "left_semi")
        self.candidates = stored(self.rows.drop("doc_id").join(wanted.hint("merge"), KEY), "substring-texts").select(*KEY, "text", "ps")

    def first_owner(self) -> DataFrame:
        """Windows of the final length that a smaller document also has: key, p."""
        made = windows(self.candidates, self.window, self.window - self.short)
        owners = made.groupBy("w1", "w2").agg(F.min("k").alias("least"), F.max("k").alias("most")).where("least < most").select("w1", "w2", "least")
        owners = stored(owners, "substring-owners")
        return made.join(owners, ["w1", "w2"]).where("k > least").select(*KEY, "p")

    def repeated(self, texts_: DataFrame, length: int, reach: int) -> DataFrame:
        """Windows of this length found in two documents or more: key, p."""
        made = windows(texts_, length, reach)
        live = made.groupBy("w1", "w2").agg(F.min("k").alias("a"), F.max("k").alias("b")).where("a < b").select("w1", "w2")
        return made.join(live, ["w1", "w2"], "left_semi").select(*KEY, "p")


CUT = "k bigint, t1 bigint, t2 bigint, n_removed bigint, cut_sha string, text string"


def _cut(window: int, with_text: bool):
    def run(batch):
        for part in slices(batch, 3):
            raw, starts, ends, first, _ = _tokens(part.column(3))
            out = []
            for d, ps in enumerate(part.column(4).to_pylist()):
                lo, hi = first[d], first[d + 1]
                gone = np.zeros(hi - lo + 1, np.int32)
                at = np.unique(np.array(ps, np.int64))
                gone[at] += 1
                gone[at + window] -= 1
                keep = np.cumsum(gone[:-1]) == 0
                pick = lo + np.flatnonzero(keep)
                kept = b" ".join([raw[starts[i] : ends[i]].tobytes() for i in pick])
                out.append((int(hi - lo - len(pick)), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
            cols = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *[pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string()), strict=True)]], [c.split()[0] for c in CUT.split(", ")])

    return run


def substring_dedup(docs: DataFrame, doc_id="doc_id", text="text", window=WINDOW, with_text=False) -> DataFrame:
    """One row per document row: doc_id, k, t1, t2, n_words, n_removed, kept_sha256 and, if asked for, the kept text.

    The kept text is null where nothing was removed: the document's own text stands.
    """
    with recorded() as made:
        levels = Levels(docs, doc_id, text, window)
        covered = stored(levels.first_owner(), "substring-covered").groupBy(*KEY).agg(F.collect_list("p").alias("qs"))
        cut = batches(levels.candidates.select(*KEY, "text").join(covered, KEY).select(*KEY, "text", "qs"), _cut(window, with_text), CUT).dropDuplicates(KEY)
        cut = stored(cut, "substring-cut")
        copy = (F.col("k") > F.col("rep")) & (F.col("n_words") >= window)
        rows = levels.base.select("doc_id", *KEY, "n_words", "sha").join(levels.classes, ["t1", "t2"]).withColumn("copy", copy)
        rows = stored(rows.drop("rep", "last"), "substring-rows")
    delete(docs.sparkSession, made, (cut, rows))
    rows = rows.join(cut, KEY, "left")
    out = rows.select(
        "doc_id",
        *KEY,
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(F.col("copy"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
        *([F.when(F.col("copy"), F.lit("")).otherwise(F.col("text")).alias("kept_text")] if with_text else []),
    )
    return out


def cut_repeats(docs: DataFrame, doc_id="doc_id", text="text", window=WINDOW) -> DataFrame:
    """The documents, with all their columns, without the words that substring_dedup removes.

    Texts that lose nothing stay as they are, byte by byte; documents that lose every word go. What is
    left of a text that loses words is its kept words joined by one space each, so its line breaks go,
    and its n_chars, if there is such a column, is counted anew.
    """
    found = substring_dedup(docs, doc_id, text, window, with_text=True).where("n_removed > 0")
    *keys, kept = names = free(docs, "_k", "_t1", "_t2", "_kept")
    cut = stored(found.dropDuplicates(KEY).select(*[F.col(c).alias(n) for c, n in zip((*KEY, "kept_text"), names, strict=True)]), "substring-kept")
    made = [F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST)), F.xxhash64(text), F.xxhash64(F.lit(1), text)]
    rows = docs.select("*", *[e.alias(n) for e, n in zip(made, keys, strict=True)]).join(cut.hint("merge"), keys, "left").where(F.col(kept).isNull() | (F.col(kept) != ""))
    changed = {text: F.coalesce(kept, text)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(kept).isNull(), F.col("n_chars")).otherwise(F.length(kept).cast(docs.schema["n_chars"].dataType))
    return rows.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])


def longest_repeats(docs: DataFrame, doc_id="doc_id", text="text", window=WINDOW, max_window: int | None = None) -> DataFrame:
    """doc_id, longest: the longest window length, window * 2**i, at which a document still repeats another; a row for each document row that repeats any.

    A text that is the whole of two documents repeats at the longest such length that it has room for.
    Up to max_window, or until no candidate survives.
    """
    run = Levels(docs, doc_id, text, window)
    length, reach, texts_ = window, window - run.short, run.candidates
    out = texts_.select(*KEY, F.lit(0).alias("length")).limit(0)
    while max_window is None or length <= max_window:
        places = stored(run.repeated(texts_, length, reach).groupBy(*KEY).agg(F.collect_set("p").alias("ps")), "substring-level")
        if places.isEmpty():
            break
        out = out.unionByName(places.select(*KEY, F.lit(length).alias("length")))
        texts_ = texts_.drop("ps").join(places, KEY)
        length, reach = length * 2, 0
    best = out.groupBy("t1", "t2").agg(F.max("length").alias("found"))
    copied = run.classes.where("rep < last").select("t1", "t2", F.lit(True).alias("copied"))
    rows = run.base.select("doc_id", "t1", "t2", "n_words").join(best, ["t1", "t2"], "left").join(copied, ["t1", "t2"], "left")
    room = f"least(n_words, {max_window}L)" if max_window else "n_words"
    doubled = F.expr(f"{window} * shiftleft(1, length(bin({room} div {window})) - 1)")
    whole = F.when(F.col("copied") & (F.expr(room) >= window), doubled)
    return rows.select("doc_id", F.greatest("found", whole).cast("int").alias("longest")).where("longest IS NOT NULL")
