"""Document fingerprints from closed syncmers (operator 13), in DataFrame operations only.

A k-mer is K consecutive code points. Of the S-mers inside it, each ranked by its hash, the smallest
must be the first or the last: then the k-mer is an anchor. Whether it is one depends on its own code
points alone, so two texts that share a passage share its anchors, wherever the passage stands, and
an edited text keeps the anchors of all it keeps. The edited text's anchors are therefore those of its
front part, as found in the whole text, and those of the k-mers that touch its new end.

A fingerprint is the ANCHORS distinct anchors of smallest hash, each with its first place, written in
the order of the text as `hash@place`. A text without an anchor has one for its whole text at place 0;
an empty text has none.

The likeness of two fingerprints: of the ANCHORS smallest hashes of both together, the share that both
have at matching places. Places match if their shift is within a band around the median shift, so
passages that both texts have by chance at unrelated places do not count. Equal fingerprints give 1, as
do two empty ones; an empty one and another give 0.

A null text counts as empty and a null doc_id as the largest. Documents stand in the order of doc_id;
those that share one are ordered by a hash of their text, and repeated rows (same doc_id and text) are
one document and give one row. A document alone in its table is its own next one. Texts of any length are
taken whole; an empty table gives an empty one; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.frames import delete, recorded, settled, stored

K = 20
S = 8
ANCHORS = 48
# Shifts may differ from their median by an eighth of the longer text, or this many code points.
BAND = 64
LAST = (1 << 63) - 1
KEY = ["k", "t"]
NEXT = ["next_k", "next_t"]
PREV = ["prev_k", "prev_t"]
LOW = 0xFFFFFFFF


def keyed(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """doc_id, text (never null) and the key columns: k orders documents, t tells those of one doc_id apart."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("k"), F.xxhash64("text").alias("t"), "text")


def neighbours(rows: DataFrame) -> DataFrame:
    """Each document's doc_id and key, the keys of the next and the one before, in a circle, and prev_n, the length of the one before.

    The order comes from range partitions and, for the rows at their edges, from a row a partition:
    no task sees more than its range, and what is windowed over all ranges is a row a range.
    """
    places = rows.select("doc_id", *KEY, F.length("text").alias("n")).dropDuplicates(KEY).repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    places = stored(places.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()), "syncmer-order")
    here = F.struct("at", *KEY, "n")
    edges = places.groupBy("part").agg(F.min(here).alias("low"), F.max(here).alias("high"))
    whole = Window.orderBy("part")
    around = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = edges.select(
        "part",
        F.col("low.at").alias("first_at"),
        F.col("high.at").alias("last_at"),
        F.coalesce(F.lag("high").over(whole), F.last("high").over(around)).alias("before"),
        F.coalesce(F.lead("low").over(whole), F.first("low").over(around)).alias("after"),
    )
    own = Window.partitionBy("part").orderBy("at")
    out = places.withColumn("b", F.lag(here).over(own)).withColumn("a", F.lead(here).over(own)).join(F.broadcast(edges), "part")
    b, a = F.coalesce("b", "before"), F.coalesce("a", "after")
    return out.select("doc_id", *KEY, *[a[c].alias(f"next_{c}") for c in KEY], *[b[c].alias(f"prev_{c}") for c in KEY], b["n"].alias("prev_n"))


def edited(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """Each document with `cut`, the length of the front that its edit keeps, and `head`, what of the next document follows it."""
    rows = keyed(docs, doc_id, text)
    order = stored(neighbours(rows), "syncmer-neighbours")
    # The same frame on both sides: its shuffle is done once.
    placed = rows.select(*KEY, "text").dropDuplicates(KEY).join(order.hint("merge"), KEY)
    heads = placed.select(*[F.col(c).alias(k) for c, k in zip(PREV, KEY, strict=True)], F.expr("substring(text, 1, cast(prev_n div 4 as int))").alias("head"))
    own = placed.select("doc_id", *KEY, *NEXT, "text", F.length("text").alias("n"), F.expr("cast(length(text) - length(text) div 4 as int)").alias("cut"))
    return own.join(heads.hint("merge"), KEY)


def _smer(j):
    return f"xxhash64(substring(code, 4 * i + {4 * j + 1}, {4 * S}))"


CLOSED = f"least({_smer(0)}, {_smer(K - S)}) <= least({', '.join(_smer(j) for j in range(1, K - S))})"


def anchors(segments: DataFrame) -> DataFrame:
    """The anchors of each row's `s`: its other columns, i (the place in s), x (the hash). Code points are four bytes each here."""
    coded = segments.where(F.length("s") >= K).withColumn("code", F.encode("s", "UTF-32")).withColumn("s", F.length("s"))
    places = coded.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("s") - K)))
    found = places.where(F.expr(CLOSED))
    return found.withColumn("x", F.expr(f"cast(shiftright(xxhash64(substring(code, 4 * i + 1, {4 * K})), 32) as int)")).drop("code", "s")


def fingerprints(rows: DataFrame) -> DataFrame:
    """Key, own and new: the smallest anchors, with places, of each document that edited() gives and of its edited text."""
    segments = F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("s"), F.lit(0).alias("shift")),
        F.struct(F.lit(1).alias("side"), F.expr(f"concat(substring(text, greatest(cut - {K} + 2, 1), cut - greatest(cut - {K} + 2, 1) + 1), head)").alias("s"), F.expr(f"greatest(cut - {K} + 1, 0)").alias("shift")),
    )
    found = anchors(rows.select(*KEY, "cut", F.inline(segments)))
    place = F.col("i") + F.col("shift")
    kept = (F.col("side") == 1) | (place + K <= F.col("cut"))
    each = found.groupBy(*KEY, "x").agg(F.min(F.when(F.col("side") == 0, place)).alias("own"), F.min(F.when(kept, place)).alias("new"))
    so_far = Window.partitionBy(*KEY).orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = each.withColumns({f"n_{c}": F.count(c).over(so_far) for c in ("own", "new")})
    sides = {c: F.when(F.col(f"n_{c}") <= ANCHORS, packed("x", c)) for c in ("own", "new")}
    few = ranked.select(*KEY, *[v.alias(c) for c, v in sides.items()]).where("own is not null or new is not null")
    return few.groupBy(*KEY).agg(*[F.sort_array(F.collect_list(c)).alias(c) for c in ("own", "new")])


def packed(x, place):
    """An anchor as one number, in the order of hashes; null if the place is."""
    return F.shiftleft(F.col(x).cast("bigint"), 32).bitwiseOR(F.col(place).cast("bigint"))


def hash_of(anchor):
    return F.shiftright(anchor, 32).cast("int")


def place_of(anchor):
    return anchor.bitwiseAND(F.lit(LOW)).cast("int")


def written(anchors_):
    """A fingerprint as text."""
    by_place = F.array_sort(F.transform(anchors_, lambda a: F.struct(place_of(a).alias("p"), hash_of(a).alias("x"))))
    return F.array_join(F.transform(by_place, lambda a: F.concat_ws("@", F.lower(F.lpad(F.hex(a["x"].cast("bigint").bitwiseAND(F.lit(LOW))), 8, "0")), a["p"].cast("string"))), " ")


def with_likeness(df: DataFrame, name: str, a: str, b: str, longer) -> DataFrame:
    """The likeness of two fingerprints, sorted arrays of anchors, for texts of which the longer has so many code points."""
    hashes = [F.transform(side, hash_of) for side in (a, b)]
    df = settled(df, _both=F.slice(F.array_sort(F.array_union(*hashes)), 1, ANCHORS), _shared=F.array_intersect(*hashes))
    df = settled(df, _seen=F.array_intersect("_both", "_shared"))
    # Each side's anchors of the shared hashes come in the order of the hashes.
    at = [F.filter(side, lambda e: F.array_contains("_seen", hash_of(e))) for side in (a, b)]
    df = settled(df, _shifts=F.zip_with(*at, lambda e, f: place_of(f) - place_of(e)))
    df = settled(df, _middle=F.get(F.array_sort("_shifts"), F.expr("cast(size(_shifts) div 2 as int)")), _band=F.greatest(F.lit(BAND), longer / 8))
    matching = F.size(F.filter("_shifts", lambda d: F.abs(d - F.col("_middle")) <= F.col("_band")))
    value = F.when(F.size("_both") == 0, 1.0).otherwise(matching / F.greatest(F.size("_both"), F.lit(1)))
    return df.withColumn(name, value).drop("_both", "_shared", "_seen", "_shifts", "_middle", "_band")


def whole(text):
    """The anchor of a text that has no other: its whole text."""
    one = F.array(F.xxhash64(text).bitwiseAND(F.lit(-LOW - 1)))
    return F.when(text != "", one).otherwise(F.slice(one, 1, 0))


def document_fingerprints(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: a row a document."""
    with recorded() as made:
        rows = edited(docs, doc_id, text)
        new_text = F.concat(F.expr("substring(text, 1, cut)"), F.col("head"))
        facts = rows.select("doc_id", *KEY, *NEXT, F.col("n").alias("n_chars"), F.sha2(new_text, 256).alias("edited_sha256"), F.length(new_text).alias("new_n"), whole(F.col("text")).alias("all_own"), whole(new_text).alias("all_new"))
        found = facts.join(fingerprints(rows).hint("merge"), KEY, "left")
        some = {c: F.when(F.size(c) > 0, F.col(c)).otherwise(F.col(f"all_{c}")) for c in ("own", "new")}
        found = stored(found.select("doc_id", *KEY, *NEXT, "n_chars", "edited_sha256", "new_n", *[v.alias(c) for c, v in some.items()]), "syncmer-prints")
    delete(docs.sparkSession, made, (found,))
    after = found.select(*[F.col(c).alias(n) for c, n in zip(KEY, NEXT, strict=True)], F.col("own").alias("after"), F.col("n_chars").alias("after_n"))
    out = found.join(after.hint("merge"), NEXT)
    out = with_likeness(out, "near_edited", "own", "new", F.greatest("n_chars", "new_n"))
    out = with_likeness(out, "near_next", "own", "after", F.greatest("n_chars", "after_n"))
    prints = [written(F.col("own")).alias("fingerprint"), written(F.col("new")).alias("edited_fingerprint")]
    return out.select("doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), "edited_sha256", *prints, "near_edited", "near_next")
