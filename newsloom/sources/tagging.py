"""A sequence model for entities and parts of speech: fitted on labelled sentences of the user's, decoded in batches.

Tags follow one another with the chances counted in the labelled sentences; a tag gives a word with the chance
counted for that word, backed by that of the word's form (its case, digits and last letters), so unseen words are
tagged by how they look and where they stand. The most likely tags of a sentence come from the Viterbi recursion;
of equal ones the tag that sorts first. Entities carry B- and I- tags; names of a gazetteer are entities whatever
the model says. Noun phrases are cut from parts of speech by a small automaton.

The model is counts of at most MAX_ROWS labelled rows (those of smallest hash), which is what the driver and the tasks hold;
texts are decoded where they are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.sources.enrich import Tagger

MAX_ROWS = 100_000
OUTSIDE = "O"
# How many sightings of a word its form is worth.
BACKING = 1.0
ALPHA = 0.5
TOKEN = re.compile(r"\w+(?:[#&.'’-]\w+)*|[^\w\s]")
SENTENCE_ENDS = frozenset(".!?")
COUNTS = "kind string, a string, b string, n long"


def shape(word: str) -> str:
    """What a word looks like: its case and digits, and its last three letters."""
    if word.isalpha():
        kind = "X" if word.isupper() and len(word) > 1 else "Xx" if word[0].isupper() else "x"
    else:
        kind = "9" if word.isdigit() else "x9" if any(c.isdigit() for c in word) else "."
    return f"{kind}:{word[-3:].lower() if word[-1:].isalpha() else ''}"


@dataclass
class SequenceModel:
    """Log chances: start and transitions by tag, emissions of known words and of forms."""

    tags: list[str]
    start: np.ndarray
    step: np.ndarray
    words: dict[str, np.ndarray]
    forms: dict[str, np.ndarray]
    other_form: np.ndarray
    gazetteer: dict[str, str] = field(default_factory=dict)

    def emission(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        return known if known is not None else self.forms.get(shape(word), self.other_form)

    def decode(self, words: list[str]) -> list[str]:
        """The most likely tags of a sentence."""
        if not words or not self.tags:
            return [OUTSIDE] * len(words)
        score = self.start + self.emission(words[0])
        back = []
        for word in words[1:]:
            each = score[:, None] + self.step
            best = each.argmax(0)
            back.append(best)
            score = each[best, np.arange(len(self.tags))] + self.emission(word)
        at = int(score.argmax())
        out = [at]
        for best in reversed(back):
            at = int(best[at])
            out.append(at)
        return [self.tags[k] for k in reversed(out)]


def counted(labelled: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The counts a model is made of (kind, a, b, n). labelled: tokens, tags (arrays of one length; other rows are left out)."""
    rows = labelled.select("tokens", "tags").where("size(tokens) = size(tags) and size(tokens) > 0 and not array_contains(transform(tags, t -> t is null), true)")
    rows = rows.orderBy(F.xxhash64("tokens", "tags")).limit(max_rows)

    @F.pandas_udf("string")
    def form(words: pd.Series) -> pd.Series:
        return words.map(shape)

    pairs = rows.select(F.explode(F.arrays_zip("tokens", "tags")).alias("p")).select(F.coalesce("p.tokens", F.lit("")).alias("w"), F.col("p.tags").alias("t"))
    pairs = pairs.groupBy("w", "t").agg(F.count("*").alias("n"))
    steps = rows.select(F.explode(F.zip_with(F.concat(F.array(F.lit("")), "tags"), "tags", lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("s")).where("s.b is not null")
    out = pairs.select(F.lit("word").alias("kind"), F.col("w").alias("a"), F.col("t").alias("b"), "n")
    out = out.unionByName(pairs.groupBy(form("w").alias("a"), F.col("t").alias("b")).agg(F.sum("n").alias("n")).select(F.lit("form").alias("kind"), "a", "b", "n"))
    return out.unionByName(steps.groupBy(F.col("s.a").alias("a"), F.col("s.b").alias("b")).agg(F.count("*").alias("n")).select(F.lit("step").alias("kind"), "a", "b", "n"))


def model_of(counts: DataFrame, gazetteer: DataFrame | None = None) -> SequenceModel:
    """The model of counted(); gazetteer: name, label."""
    rows = [tuple(r) for r in counts.collect()]  # bounded by the labelled rows
    tags = sorted({b for kind, _, b, _ in rows})
    at = {t: k for k, t in enumerate(tags)}
    start, step = np.full(len(tags), ALPHA), np.full((len(tags), len(tags)), ALPHA)
    seen: dict[str, dict[str, np.ndarray]] = {"word": {}, "form": {}}
    for kind, a, b, n in rows:
        if kind != "step":
            seen[kind].setdefault(a, np.zeros(len(tags)))[at[b]] += n
        elif a:
            step[at[a], at[b]] += n
        else:
            start[at[b]] += n
    total = sum(seen["word"].values(), np.zeros(len(tags)))
    share = lambda n: (n + ALPHA) / (total + ALPHA * (len(seen["form"]) + 1))
    unseen = math.log(BACKING) - np.log(total + BACKING)
    forms = {s: unseen + np.log(share(n)) for s, n in seen["form"].items()}
    words = {w: np.log(n + BACKING * share(seen["form"][shape(w)])) - np.log(total + BACKING) for w, n in seen["word"].items()}
    names = {r["name"]: r["label"] for r in gazetteer.select("name", "label").collect()} if gazetteer is not None else {}
    return SequenceModel(tags, np.log(start / start.sum()), np.log(step / step.sum(1, keepdims=True)), words, forms, unseen + np.log(share(np.zeros(len(tags)))), names) if tags else SequenceModel([], start, step, {}, {}, start, names)


def fit(labelled: DataFrame, gazetteer: DataFrame | None = None, max_rows: int = MAX_ROWS) -> SequenceModel:
    return model_of(counted(labelled, max_rows), gazetteer)


def save(labelled: DataFrame, path: str, max_rows: int = MAX_ROWS) -> None:
    """Write the counts of the model at `path`."""
    counted(labelled, max_rows).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str, gazetteer: DataFrame | None = None) -> SequenceModel:
    return model_of(spark.read.schema(COUNTS).parquet(path), gazetteer)


def sentences(text: str) -> list[list[tuple[str, int, int]]]:
    """Words with their places, by sentence."""
    out: list[list[tuple[str, int, int]]] = [[]]
    for m in TOKEN.finditer(text):
        out[-1].append((m[0], m.start(), m.end()))
        if m[0] in SENTENCE_ENDS:
            out.append([])
    return [s for s in out if s]


def tagged_spans(model: SequenceModel, text: str) -> list[tuple[str, str]]:
    """(name, label) of the entities of a text, in order."""
    out = []
    for words in sentences(text):
        tags = model.decode([w for w, _, _ in words])
        start = label = None
        for k, tag in enumerate([*tags, OUTSIDE]):
            kind, _, name = tag.partition("-")
            if start is not None and (kind != "I" or name != label):
                out.append((text[words[start][1] : words[k - 1][2]], label))
                start = None
            if kind == "B" or (kind == "I" and start is None):
                start, label = k, name
    return out


def listed_names(model: SequenceModel, text: str) -> list[tuple[str, str]]:
    """(name, label) of the gazetteer's names in a text: the longest at each word."""
    longest = max((len(TOKEN.findall(n)) for n in model.gazetteer), default=0)
    words = [(m.start(), m.end()) for m in TOKEN.finditer(text)] if longest else []
    out, k = [], 0
    while k < len(words):
        for size in range(min(longest, len(words) - k), 0, -1):
            name = text[words[k][0] : words[k + size - 1][1]]
            if name in model.gazetteer:
                out.append((name, model.gazetteer[name]))
                k += size - 1
                break
        k += 1
    return out


def model_tagger(model: SequenceModel) -> Tagger:
    """A tagger for enrich.with_entities(): the model's entities and the gazetteer's names."""
    return lambda text: tagged_spans(model, text) + listed_names(model, text)


# What a part of speech does in a noun phrase: begins one, goes on in one, is its noun, or stands before it and is left off.
CHUNK = {"DET": "before", "PRON": "out", "ADJ": "begins", "NUM": "begins", "NOUN": "noun", "PROPN": "noun"}


def noun_phrases(words: list[str], tags: list[str]) -> list[str]:
    """Runs of adjectives and nouns that end in a noun, in lower case, without determiners."""
    out, run, last = [], [], 0
    for word, tag in [*zip(words, tags, strict=True), ("", "END")]:
        role = CHUNK.get(tag, "out")
        if role in ("noun", "begins") and not (role == "begins" and last):
            run.append(word)
            last = len(run) if role == "noun" else last
            continue
        if last:
            out.append(" ".join(run[:last]).lower())
        run, last = ([word], 0) if role == "begins" else ([], 0)
    return out


def with_noun_phrases(df: DataFrame, text: str, model: SequenceModel, out="NLP_KEYWORDS") -> DataFrame:
    """Distinct noun phrases of three characters or more with a letter, in the order of the text, by a model of parts of speech."""

    @F.pandas_udf("array<string>")
    def phrases(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = []
            for t in batch:
                all_ = [p for s in sentences(t or "") for p in noun_phrases([w for w, _, _ in s], model.decode([w for w, _, _ in s]))]
                found.append(list(dict.fromkeys(p for p in all_ if len(p) >= 3 and re.search("[a-z]", p))))
            yield pd.Series(found, dtype=object)

    return df.withColumn(out, phrases(F.col(text)))


