"""Quality classifier: regularised quadratic discriminant (operator 10).

Statistics of each whole text (shares of character classes, of repeated, common and distinct
words, lengths, entropy) are transformed to be roughly normal: logarithms of counts, log-odds of
shares. For each class of labelled training rows, mean and covariance are sums over all of them, of
whole numbers (features in steps of 1 / GRID), so that they do not depend on the order of the rows. A class covariance is shrunk towards the pooled one (POOL) and the unit matrix (UNIT), in
units of the pooled standard deviations; its Cholesky factor is inverted once and travels with the
task. The score is the chance of class 1 from the difference of the Mahalanobis log-densities and
the logarithm of the classes' sizes.

Null texts count as empty and are scored like any other; texts are read whole, whatever their length. Rows with a null doc_id are never learned
from. Labels that are null or neither 0 nor 1 are left out; repeated labels count as often as they
stand. With a class that has no labelled row at all, the score is the share of class 1 (0.5 without
any label). Repeated rows are scored one by one; an empty table gives an empty one. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.frames import batches, stored, texts
from newsloom.llm.kernels import SPACE_WORDS, buffer, doc_of, mix, slices, strings, word_hashes, words
from newsloom.llm.quality_rules import COMMON_HASHES, N_CLASSES, duplicate_lines, repeated_words
from newsloom.llm.quality_rules import _CLASS as CHAR_CLASS

THRESHOLD = 0.3
POOL = 0.1
UNIT = 0.02
FLATTEN = 0.5
GRID = 1 << 16
# Character classes: lower, upper, digit, space, punctuation, symbol, non-ASCII, other.
FEATURES = ["log_words", "log_mean_word", *[f"odds_class_{k}" for k in range(N_CLASSES)], "odds_bar", "odds_repeat", "odds_distinct", "odds_common", "odds_dup_lines", "log_line", "odds_capital"]


def _odds(part, whole):
    p = (part + 0.5) / (whole + 1.0)
    return np.log(p / (1 - p + 1e-9))


def distinct_words(h, first):
    doc = doc_of(first, len(h))
    key = h ^ mix(doc.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    return np.bincount(doc[order[new]], minlength=len(first) - 1)


def features(column):
    """One row of FEATURES for each text."""
    column = strings(column)
    raw, offsets = buffer(column)
    starts, ends, first = words(raw, offsets, SPACE_WORDS)
    h = word_hashes(raw, starts, ends)
    n_docs = len(offsets) - 1
    size, n = np.diff(offsets), np.diff(first)
    doc = np.repeat(np.arange(n_docs, dtype=np.int64), size)
    chars = np.bincount(doc * N_CLASSES + CHAR_CLASS[raw], minlength=n_docs * N_CLASSES).reshape(n_docs, N_CLASSES)
    bars = np.bincount(doc, raw == ord("|"), n_docs)
    lines = np.bincount(doc, raw == 10, n_docs)
    of = doc_of(first, len(h))
    length = np.bincount(of, ends - starts, n_docs)
    capital = np.bincount(of, (raw[starts] >= 65) & (raw[starts] <= 90), n_docs) if len(h) else np.zeros(n_docs)
    place = np.minimum(np.searchsorted(COMMON_HASHES, h), len(COMMON_HASHES) - 1)
    common = np.bincount(of, COMMON_HASHES[place] == h, n_docs) if len(h) else np.zeros(n_docs)
    columns = [np.log1p(n), np.log1p(length / np.maximum(n, 1))]
    columns += [_odds(chars[:, k], size) for k in range(N_CLASSES)]
    columns += [
        _odds(bars, n),
        _odds(repeated_words(h, first), n),
        _odds(distinct_words(h, first), n),
        _odds(common, n),
        _odds(duplicate_lines(column, n_docs), lines + 1),
        np.log1p(size / (lines + 1)),
        _odds(capital, n),
    ]
    return np.stack(columns, 1)


def feature_table(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def run(batch):
        for part in slices(batch, 1):
            x = features(part.column(1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], ["doc_id", "x"])

    return batches(texts(rows, "doc_id", "text"), run, "doc_id bigint, x array<double>")


def moments(rows: DataFrame, width: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per label: rows, sum of x, sum of x x'. rows: label, x."""

    def run(batch):
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        y = batch.column(0).to_numpy(zero_copy_only=False)
        for label in np.unique(y):
            own = np.round(x[y == label] * GRID).astype(np.int64)
            flat = np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
            yield pa.RecordBatch.from_arrays([pa.array([label], pa.int32()), pa.array([flat], pa.list_(pa.int64()))], ["label", "m"])

    parts = batches(rows, run, "label int, m array<bigint>").select("label", F.posexplode("m").alias("k", "v")).groupBy("label", "k").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("v"))
    out = {}
    for label, got in parts.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("k", "v"))).alias("m")).collect():
        flat = np.array([float(g["v"]) for g in got])
        out[label] = (flat[0], flat[1 : width + 1] / GRID, flat[width + 1 :].reshape(width, width) / GRID**2)
    return out


class Discriminant:
    """Means of both classes and their Cholesky factors, inverted."""

    def __init__(self, sums, pool=POOL, unit=UNIT, flatten=FLATTEN):
        sizes = {k: sums[k][0] if k in sums else 0.0 for k in (0, 1)}
        total = sum(sizes.values())
        self.share = sizes[1] / total if total else 0.5
        self.fitted = min(sizes.values()) > 0
        self.flatten = flatten
        if not self.fitted:
            return
        means = {k: sums[k][1] / sizes[k] for k in (0, 1)}
        spread = {k: sums[k][2] / sizes[k] - np.outer(means[k], means[k]) for k in (0, 1)}
        pooled = sum(sizes[k] * spread[k] for k in (0, 1)) / total
        self.scale = np.sqrt(np.maximum(np.diag(pooled), 1e-9))
        corr = {k: c / np.outer(self.scale, self.scale) for k, c in (*spread.items(), ("pooled", pooled))}
        self.means = {k: means[k] / self.scale for k in (0, 1)}
        self.whiten, self.log_size = {}, {}
        for k in (0, 1):
            shrunk = (1 - pool) * corr[k] + pool * corr["pooled"]
            factor = np.linalg.cholesky((1 - unit) * shrunk + unit * np.eye(len(self.scale)))
            self.whiten[k], self.log_size[k] = np.linalg.inv(factor), np.log(np.diag(factor)).sum()

    def log_density(self, x, k):
        z = (x / self.scale - self.means[k]) @ self.whiten[k].T
        return -0.5 * (z**2).sum(1) - self.log_size[k]

    def score(self, x):
        """Chance of class 1; the log-density difference counts by `flatten`, as the features are not independent draws."""
        if not self.fitted:
            return np.full(len(x), self.share)
        odds = self.flatten * (self.log_density(x, 1) - self.log_density(x, 0)) + np.log(self.share / (1 - self.share))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def is_held_out(doc_id):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")), F.lit(0)) % 5 == 0


def quality_classifier(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="quality", threshold=THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    table = stored(feature_table(docs, doc_id, text), "quality-features")
    known = labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1))
    rows = table.where(~is_held_out("doc_id")).join(known, "doc_id").select("label", "x")
    model = Discriminant(moments(rows, len(FEATURES)))

    def run(batch):
        x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
        score = model.score(x)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return batches(table.select("doc_id", is_held_out("doc_id").alias("held_out"), "x"), run, "doc_id bigint, held_out boolean, score double, predicted int")
