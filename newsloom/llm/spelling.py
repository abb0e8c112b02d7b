"""Spelling variants by anagram hashing (operator 11).

A word's anagram key is the sum of the fifth powers of its letters' code points: words of the same
letters, in whatever order, have the same key, and taking a letter off takes its power off the key. Two
words can differ by one added letter only if the longer one's key less one of its letters is the
shorter one's key; by one exchanged letter only if both keys less one letter each are the same. So
each word is listed under its key and under its key less each of its distinct letters, and equal keys
are joined.

One edit leaves the half of a word before it, or the half after it, as it is. The join asks for one of
those halves too, so that words of many anagrams do not meet all of them. The letter order of what
meets is then checked: the edit distance must be one.

Words come from maximal runs of letters, A-Z lower-cased. Where 199 divides the checksum of
`<doc_id>:<run>`, a letter of the run is left out. A word's form is its near word of largest n (the
smallest of several), if that n is at least RATIO times its own; its root is the last of the forms after
it. As n grows along the forms, there is no circle.

A null text has no words; a null doc_id stands as an empty one in the checksum. Repeated rows count each time;
texts and runs of any length are taken whole; an empty table gives an empty one; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.frames import delete, recorded, settled, stored, texts
from newsloom.llm.kernels import LOWER_TRANSLATE, slices

RUN = re.compile("[a-zÀ-ÿ]+")
EVERY = 199
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
# Keys are sums of fifth powers, modulo a prime, so that words of any length have one.
MODULUS = (1 << 61) - 1
HELD_WORDS = 200_000


def word_counts(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """word, n: the words of at least MIN_LENGTH letters, counted in each task before they are shuffled."""

    def run(it):
        held: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in it:
            for part in slices(batch, 1) if batch.num_rows else ():
                for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    start = zlib.crc32(b"%s:" % (b"" if i is None else b"%d" % i))
                    for word, n in Counter(RUN.findall((t or "").encode().translate(LOWER_TRANSLATE).decode())).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % EVERY == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                        if len(word) >= MIN_LENGTH:
                            held[word] += n
                if len(held) > HELD_WORDS:
                    yield flush()
        if held:
            yield flush()

    rows = texts(docs, doc_id, text).select(F.col(doc_id).cast("bigint"), F.col(text))
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def power(letter):
    """The fifth power of a letter's code point."""
    code = F.ascii(letter).cast("bigint")
    return code * code * code * code * code


def anagram_keys(words: DataFrame) -> DataFrame:
    """The words with length, `key`, and `less`: for each distinct letter, the letter and the key less its power."""
    letters = F.filter(F.split("word", ""), lambda c: c != "")
    keyed = settled(words, length=F.length("word"), letters=F.array_distinct(letters), key=F.aggregate(letters, F.lit(0).cast("bigint"), lambda a, c: (a + power(c)) % F.lit(MODULUS)))
    less = F.transform("letters", lambda c: F.struct(c.alias("letter"), F.pmod(F.col("key") - power(c), F.lit(MODULUS)).alias("key")))
    return keyed.select("word", "n", "length", "key", less.alias("less"))


def _halves(keyed: DataFrame, length, *columns):
    """A row for each half: `side` and the hash of the letters before, or after, the middle of a word of this length."""
    middle = F.floor(length / 2).cast("int")
    word, whole = F.col("word"), F.length("word")
    half = F.array(
        F.struct(F.lit(0).alias("side"), F.xxhash64(F.substr(word, F.lit(1), middle)).alias("half")),
        F.struct(F.lit(1).alias("side"), F.xxhash64(F.substr(word, whole - (length - middle) + 1, length - middle)).alias("half")),
    )
    return keyed.select(*columns, length.alias("shorter"), F.inline(half))


def near_pairs(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n: the pairs of words at edit distance one, each once. words: word, n."""
    keyed = stored(anagram_keys(words), "spelling-keys")
    each = keyed.select("word", "n", "length", F.inline("less"))
    on = ["key", "shorter", "side", "half"]

    def named(df, name, *more):
        return df.select(*on, F.col("word").alias(name), F.col("n").alias(f"{name}_n"), *more)

    full = _halves(keyed, F.col("length"), "word", "n", "key")
    swap = _halves(each, F.col("length"), "word", "n", "key", "letter")
    longer = _halves(each, F.col("length") - 1, "word", "n", "key")
    exchanged = named(swap, "a", F.col("letter").alias("x")).join(named(swap, "b", F.col("letter").alias("y")).hint("merge"), on).where("x < y")
    added = named(longer, "a").join(named(full, "b").hint("merge"), on)
    met = exchanged.drop("x", "y").unionByName(added)
    # Words with both halves alike meet on both sides: they are taken on the first.
    middle = "cast(floor(shorter / 2) as int)"
    once = met.where(f"side = 0 or substring(a, 1, {middle}) != substring(b, 1, {middle})")
    return once.where("levenshtein(a, b, 1) = 1").select("a", "a_n", "b", "b_n")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last of the forms after each word that has one, by doubling the steps. forms: word, form."""
    spark = forms.sparkSession
    with recorded() as made:
        hops = stored(forms.select("word", F.col("form").alias("root")), "spelling-hops")
        while True:
            ahead = hops.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
            moved = stored(hops.join(ahead.hint("merge"), "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "spelling-hops")
            hops = moved.select("word", "root")
            done = moved.where("moved").isEmpty()
            delete(spark, made[:-1])
            del made[:-1]
            if done:
                return hops


def spelling_variants(docs: DataFrame, doc_id="doc_id", text="text", min_count=MIN_COUNT) -> DataFrame:
    """word, form, root, n, n_near, form_n: a row a word that occurs min_count times or more."""
    with recorded() as made:
        words = stored(word_counts(docs, doc_id, text).where(F.col("n") >= min_count), "spelling-words")
        pairs = stored(near_pairs(words), "spelling-pairs")
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
        best = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("m"), F.col("b").alias("b"))).alias("best"))
        known = words.join(best.hint("merge"), "word", "left")
        strong = -F.col("best.m") >= RATIO * F.col("n")
        found = stored(
            known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(strong, F.col("best.b")).alias("form"), F.when(strong, -F.col("best.m")).alias("form_n")),
            "spelling-forms",
        )
    last = roots(found.where("form is not null"))
    delete(docs.sparkSession, made, (found,))
    return found.join(last.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
