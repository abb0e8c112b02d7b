"""Topics: clustering, propagation, keywords and the per-topic summary."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions.vectors import dot, mean_vectors

OUTLIER = -1
SMALL_CORPUS = 200
SMALL_BYTES = 64_000_000
# Words that a task counts at a time.
COUNTED_WORDS = 1_000_000


def spread(df: DataFrame) -> DataFrame:
    """Rows of a small input dealt out to all cores. It is one row group, so one task would read it and do all that follows;
    larger inputs come in splits and stay as they are."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size < SMALL_BYTES else df


def most_common(df: DataFrame, key: str, value: Column | str, n: int = 1, seq: str = "seq", out: str = "value") -> DataFrame:
    """The n most common non-null values of each key with their counts; of equal counts the first seen."""
    v = F.col(value) if isinstance(value, str) else value
    counts = df.select(key, v.alias("_v"), F.col(seq).alias("_s")).where("_v IS NOT NULL").groupBy(key, "_v").agg(F.count("*").alias("n"), F.min("_s").alias("_first"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "_first", "_v"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= n).select(key, "rank", F.col("_v").alias(out), "n")


def joined(ranked: DataFrame, key: str, value: str = "value", out: str = "joined") -> DataFrame:
    """Ranked values of each key as one ", "-joined string."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("rank", value))), lambda s: s[value])
    return ranked.groupBy(key).agg(F.array_join(parts, ", ").alias(out))


def dominant(df: DataFrame, key="TOPIC_ID", value="SENTIMENT", seq="seq") -> DataFrame:
    return most_common(df, key, value, 1, seq).select(key, F.col("value").alias("DOMINANT_SENTIMENT"))


def first_filled(df: DataFrame, key: str, value: str, seq="seq") -> DataFrame:
    """The first value of each key that is not blank, in input order; "" without any."""
    filled = F.when(F.trim(F.col(value)) != "", F.col(value))
    return df.groupBy(key).agg(F.coalesce(F.min_by(filled, F.when(filled.isNotNull(), F.col(seq))), F.lit("")).alias(value))


def _words(text: str, stop: list[str]) -> Column:
    return F.filter(F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0)), lambda w: ~w.isin(stop))


def terms_of(df: DataFrame, key: str, text: str, stop: list[str], bigrams=True) -> DataFrame:
    """key, term, n: words of two characters or more without stop words, and neighbouring pairs of them; n counts what a
    task met together, so a term of a key may have several rows."""

    def counted(keys: pa.Array, lists: pa.ListArray) -> pa.RecordBatch:
        words, topic = lists.flatten().dictionary_encode(), keys.dictionary_encode()
        code, many = words.indices.to_numpy().astype(np.int64), max(len(words.dictionary), 1)
        sizes = np.diff(lists.offsets.to_numpy())
        at = np.repeat(topic.indices.to_numpy().astype(np.int64), sizes) * (many * (many + 1))
        each = [at + code]
        if bigrams and len(code):
            inside = np.ones(len(code), bool)
            ends = np.cumsum(sizes)[sizes > 0] - 1
            inside[ends] = False
            first = np.flatnonzero(inside)
            each.append(at[first] + (code[first] + 1) * many + code[first + 1])
        found, n = np.unique(np.concatenate(each), return_counts=True)
        of, term = np.divmod(found, many * (many + 1))
        left, right = np.divmod(term, many)
        last = words.dictionary.take(pa.array(right))
        before = words.dictionary.take(pa.array(left - 1, mask=left == 0))
        term = pc.coalesce(pc.binary_join_element_wise(before, last, " "), last)
        return pa.RecordBatch.from_arrays([topic.dictionary.take(pa.array(of)), term, pa.array(n.astype(np.int64))], [key, "term", "n"])

    def count(it):
        for batch in it:
            ends = np.cumsum(pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False))
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + COUNTED_WORDS, "right")))
                part = batch.slice(lo, hi - lo)
                # Without the offset of the slice, as lists are taken apart.
                yield counted(part.column(0), pa.concat_arrays([part.column(1)]).take(pa.array(np.arange(hi - lo))))
                lo = hi

    return df.select(key, _words(text, stop).alias("w")).mapInArrow(count, f"`{key}` {df.schema[key].dataType.simpleString()}, term string, n long")


def class_tfidf(df: DataFrame, key="TOPIC_ID", text="text", stop: list[str] | None = None, n: int = 10, bigrams=True) -> DataFrame:
    """The n best terms of each topic by tf * ln(1 + mean terms a topic / frequency of the term)."""
    real = spread(df.where(F.col(key).cast("string") != str(OUTLIER)).select(key, text))
    # The sizes of the topics come from the lengths of the word lists, not from counting the terms again.
    words = F.size(_words(text, stop or []))
    size = real.groupBy(key).agg(F.sum(words + F.greatest(words - 1, F.lit(0)) if bigrams else words).alias("size")).where("size > 0")
    sizes = {str(r[key]): r["size"] for r in size.select(F.col(key).cast("string").alias(key), "size").collect()}  # a row a topic
    mean = sum(sizes.values()) / max(len(sizes), 1)

    def likely(it):
        """Counts (h, key, term, n) in the order of the terms' hashes h: key, term, n, f of those that can be among the n best of their topic."""
        least, rest = {}, None

        def best(rows: pa.Table) -> pa.RecordBatch:
            topic, term = (rows.column(c).combine_chunks().dictionary_encode() for c in (1, 2))
            many = len(topic.dictionary)
            pair = term.indices.to_numpy().astype(np.int64) * many + topic.indices.to_numpy()
            by = np.argsort(pair)
            pair = pair[by]
            first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
            count = np.add.reduceat(rows.column(3).to_numpy()[by], first)
            word, of = np.divmod(pair[first], many)
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            f = np.repeat(np.add.reduceat(count, start), np.diff(np.r_[start, len(word)]))
            value, ok = count * np.log1p(mean / f), np.zeros(len(count), bool)
            for k, name in enumerate(pc.cast(topic.dictionary, pa.string()).to_pylist()):
                own = np.flatnonzero(of == k)
                if len(own) >= n:
                    least[name] = max(least.get(name, 0.0), np.partition(value[own], len(own) - n)[len(own) - n])
                # Scores are rounded to eight digits, so what is less by this much may be equal.
                ok[own] = value[own] >= least.get(name, 0.0) * (1 - 1e-9) - 2e-8 * sizes[name]
            of, word = pa.array(of[ok]), pa.array(word[ok])
            return pa.RecordBatch.from_arrays([topic.dictionary.take(of), term.dictionary.take(word), pa.array(count[ok]), pa.array(f[ok])], [key, "term", "n", "f"])

        for batch in it:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if rest is not None:
                rows = pa.concat_tables([rest, rows])
            # The last term may go on in the next batch.
            h = rows.column(0).to_numpy()
            cut = int(np.argmax(h == h[-1]))
            if cut:
                yield best(rows.slice(0, cut))
            rest = rows.slice(cut)
        if rest is not None:
            yield best(rest)

    # Dealt by term alone: a term's frequency and its counts by topic need one shuffle. Sorting by a hash costs less than by terms.
    counts = terms_of(real, key, text, stop or [], bigrams).repartition("term").select(F.xxhash64("term").alias("_h"), key, "term", "n").sortWithinPartitions("_h")
    tf = counts.mapInArrow(likely, f"`{key}` {df.schema[key].dataType.simpleString()}, term string, n long, f long")
    scored = tf.join(F.broadcast(size), key).withColumn("score", F.round(F.col("n") / F.col("size") * F.log1p(F.lit(mean) / F.col("f")), 8))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "term"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= n).select(key, "rank", "term", "score")


def topic_label(words: Column | str) -> Column:
    """The first four keywords."""
    w = F.col(words) if isinstance(words, str) else words
    return F.when(F.size(w) > 0, F.array_join(F.slice(w, 1, 4), " / "))


def cluster(df: DataFrame, k: int, vector="vector", cut: float | None = None, seed: int = 42) -> DataFrame:
    """TOPIC_ID by spherical k-means of unit vectors; rows further than `cut` from their centre are outliers (-1).

    The centres are k vectors; rows are never gathered.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = df.withColumn("_features", array_to_vector(F.col(vector).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="TOPIC_ID", distanceMeasure="cosine").fit(rows)
    out = model.transform(rows).drop("_features")
    if cut is None:
        return out
    # k rows, a table beside the data: as literals they would make the plan grow with k.
    centres = df.sparkSession.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(model.clusterCenters())], "TOPIC_ID int, _centre array<double>")
    far = out.join(F.broadcast(centres), "TOPIC_ID").withColumn("_cosine", dot(F.col(vector), F.col("_centre")) / (F.sqrt(dot(F.col("_centre"), F.col("_centre"))) + F.lit(1e-12)))
    return far.withColumn("TOPIC_ID", F.when(1 - F.col("_cosine") > cut, OUTLIER).otherwise(F.col("TOPIC_ID"))).select(*out.columns)


def large_enough(df: DataFrame, least: int) -> DataFrame:
    """Topics of fewer than `least` rows become outliers."""
    small = df.where(F.col("TOPIC_ID") != OUTLIER).groupBy("TOPIC_ID").agg(F.count("*").alias("_n")).where(F.col("_n") < least).select("TOPIC_ID", F.lit(True).alias("_small"))
    return df.join(small, "TOPIC_ID", "left").withColumn("TOPIC_ID", F.when(F.col("_small"), OUTLIER).otherwise(F.col("TOPIC_ID"))).select(*df.columns)


def merged(df: DataFrame, nr_topics: int, vector="vector") -> DataFrame:
    """At most nr_topics topics beside the outliers: the smallest is merged into the one most alike, again and again.

    The driver holds a centroid and a size for each topic, no rows.
    """
    real = df.where(F.col("TOPIC_ID") != OUTLIER)
    sizes = real.groupBy("TOPIC_ID").agg(F.count("*").alias("n"))
    rows = mean_vectors(real, ["TOPIC_ID"], vector).join(sizes, "TOPIC_ID").orderBy("TOPIC_ID").collect()
    n = {r["TOPIC_ID"]: r["n"] for r in rows}
    centre = {r["TOPIC_ID"]: [x * r["n"] for x in r["centroid"]] for r in rows}
    into = {t: t for t in n}

    def alike(a, b):
        both = sum(x * y for x, y in zip(centre[a], centre[b], strict=True))
        return both / ((sum(x * x for x in centre[a]) * sum(x * x for x in centre[b])) ** 0.5 + 1e-12)

    while len(n) > max(nr_topics, 1):
        small = min(n, key=lambda t: (n[t], -t))
        near = max((t for t in n if t != small), key=lambda t: (alike(small, t), -t))
        centre[near] = [x + y for x, y in zip(centre[near], centre.pop(small), strict=True)]
        n[near] += n.pop(small)
        into = {t: near if to == small else to for t, to in into.items()}
    table = df.sparkSession.createDataFrame(sorted(into.items()) or [(OUTLIER, OUTLIER)], "TOPIC_ID int, _into int")
    return df.join(F.broadcast(table), "TOPIC_ID", "left").withColumn("TOPIC_ID", F.coalesce("_into", "TOPIC_ID")).select(*df.columns)


def labelled(df: DataFrame, labels: DataFrame, key: str, label: str, default: str = "") -> DataFrame:
    """Each row with the label of its id; `default` for ids without one. labels has a row an id at most."""
    return df.join(labels.select(key, label), key, "left").withColumn(label, F.coalesce(label, F.lit(default)))


def best_headlines(df: DataFrame, key: str, title: str, keywords: list[str], seq="seq") -> DataFrame:
    """key, headline: the first title of 15 to 140 characters that holds a keyword, else the first of that length,
    else the start of the first one; "" without any. Minima, so a topic is never gathered."""
    t = F.col(title)
    fit = F.length(t).between(15, 140)
    hit = fit & F.exists(F.array(*[F.lit(k.lower()) for k in keywords]).cast("array<string>"), lambda k: F.contains(F.lower(t), k))
    first = lambda when: F.min_by(title, F.when(when & t.isNotNull(), F.col(seq)))
    return df.groupBy(key).agg(F.coalesce(first(hit), first(fit), F.substring(first(F.lit(True)), 1, 140), F.lit("")).alias("headline"))


def topic_parameters(n_docs: int) -> dict[str, int]:
    """Granularity that follows the size of the corpus: the smallest topic, and the neighbours to look at."""
    small = n_docs < SMALL_CORPUS
    return {"min_topic_size": max(2, min(10, n_docs // 20)), "n_neighbors": max(2, min(15, n_docs - 1)) if small else 15, "enough": int(n_docs >= 3)}


def topic_shape(n: Column) -> Column:
    """topic_parameters() and min_samples() of a column of corpus sizes, as one struct."""
    least = F.greatest(F.lit(2), F.least(F.lit(10), F.floor(n / 20).cast("int")))
    near = F.when(n < SMALL_CORPUS, F.greatest(F.lit(2), F.least(F.lit(15), n.cast("int") - 1))).otherwise(15)
    dense = F.when(n < SMALL_CORPUS, 1).otherwise(least)
    return F.struct(least.alias("min_topic_size"), near.alias("n_neighbors"), dense.alias("min_samples"), (n >= 3).cast("int").alias("enough"))


def min_samples(n_docs: int, min_topic_size: int) -> int:
    """How many neighbours make a row's surroundings dense: one in a small corpus, else as many as the smallest topic has."""
    return 1 if n_docs < SMALL_CORPUS else min_topic_size


def representatives(df: DataFrame, vector="vector", n: int = 3, seq="seq") -> DataFrame:
    """The n rows of each topic nearest to its centroid."""
    centre = mean_vectors(df.where("TOPIC_ID != -1"), ["TOPIC_ID"], vector)
    near = df.join(centre, "TOPIC_ID").withColumn("sim", F.round(dot(F.col(vector), F.col("centroid")), 6))
    rank = F.row_number().over(Window.partitionBy("TOPIC_ID").orderBy(F.desc("sim"), seq))
    return near.withColumn("rank", rank).where(F.col("rank") <= n).select("TOPIC_ID", "rank", seq, "sim")


def propagate(articles: DataFrame, reps: DataFrame) -> DataFrame:
    """Each article gets the topic of its duplicate group's representative. reps: DUP_GROUP, TOPIC_ID."""
    return articles.join(reps.select("DUP_GROUP", "TOPIC_ID"), "DUP_GROUP", "left").withColumn("TOPIC_ID", F.coalesce("TOPIC_ID", F.lit(OUTLIER)))


def with_topic_text(articles: DataFrame, topics: DataFrame) -> DataFrame:
    """Title and description of each article's topic; "" for unknown topics."""
    named = articles.join(topics.select("TOPIC_ID", "TOPIC_TITLE", "TOPIC_DESCRIPTION"), "TOPIC_ID", "left")
    return named.withColumns({c: F.coalesce(c, F.lit("")) for c in ("TOPIC_TITLE", "TOPIC_DESCRIPTION")})


def summary(articles: DataFrame, seq="seq") -> DataFrame:
    """One row for each topic, largest first, outliers last. articles: TOPIC_ID, DUP_GROUP, RISK_ID,
    SENTIMENT, SENTIMENT_COMPOUND, QUALITY_SCORE, ENTITIES (array)."""
    exact = lambda c: F.sum(F.col(c).cast("decimal(18,8)")).cast("double") / F.count(c)
    base = articles.groupBy("TOPIC_ID").agg(
        F.count("*").alias("ARTICLE_COUNT"),
        F.count_distinct("DUP_GROUP").alias("DISTINCT_STORIES"),
        F.array_sort(F.collect_set("RISK_ID")).alias("RISK_IDS"),
        F.round(exact("SENTIMENT_COMPOUND"), 4).alias("AVG_SENTIMENT_COMPOUND"),
        F.round(exact("QUALITY_SCORE"), 4).alias("AVG_QUALITY"),
    )
    base = base.withColumn("DISTINCT_RISK_COUNT", F.size("RISK_IDS")).join(dominant(articles, seq=seq), "TOPIC_ID", "left")
    if "ENTITIES" in articles.columns:
        each = articles.select("TOPIC_ID", seq, F.explode("ENTITIES").alias("entity"))
        base = base.join(joined(most_common(each, "TOPIC_ID", "entity", 8, seq), "TOPIC_ID", out="TOP_ENTITIES"), "TOPIC_ID", "left")
    return base.orderBy(F.col("TOPIC_ID") == OUTLIER, F.desc("ARTICLE_COUNT"), "TOPIC_ID")


def description(theme: Column, sentiment: Column, n: Column, example: Column, risks: Column) -> Column:
    """The one-line description. risks: labels of the topic's risks, in order."""
    mood = F.lower(F.coalesce(X.blank_to_null(sentiment), F.lit("mixed")))
    tone = F.when(mood != "mixed", F.concat(F.lit(", with mostly "), mood, F.lit(" sentiment"))).otherwise("")
    quoted = F.when(example != "", F.concat(F.lit(' For example: "'), example, F.lit('."'))).otherwise("")
    more = F.when(F.size(risks) > 3, F.concat(F.lit("; +"), (F.size(risks) - 3).cast("string"), F.lit(" more"))).otherwise("")
    linked = F.when(F.size(risks) > 0, F.concat(F.lit(" Linked to "), F.array_join(F.slice(risks, 1, 3), "; "), more, F.lit("."))).otherwise("")
    return F.concat(F.lit("Coverage of "), theme, tone, F.lit(" ("), n.cast("string"), F.lit(" articles)."), quoted, linked)


def unique_titles(topics: list[tuple[int, list[str]]]) -> dict[int, str]:
    """Titles of topics in the given order (largest first), on the driver: each takes three of its
    keywords, and more until no earlier topic has that title."""
    used: set[str] = set()
    out = {}
    for topic, words in topics:
        if topic == OUTLIER or not words:
            out[topic] = "Outlier / Unclustered" if topic == OUTLIER else f"Topic {topic}"
            continue
        spelled = [" ".join(X.ACRONYMS.get(w.lower()) or (w if any(c.isdigit() for c in w) else w[:1].upper() + w[1:]) for w in term.split()) for term in words]
        sizes = range(min(3, len(spelled)), len(spelled) + 1)
        titles = [" & ".join(x for x in (", ".join(spelled[: n - 1]), spelled[n - 1]) if x) for n in sizes]
        title = next((t for t in titles if t not in used), f"{titles[-1]} (topic {topic})")
        used.add(title)
        out[topic] = title
    return out
