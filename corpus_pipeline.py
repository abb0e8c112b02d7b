"""The corpus pipeline: STAGES applied to documents in order, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and returns a frame. All but the last return the columns of
documents; the last returns doc_id, n_pieces, ids, lossless. Tables that a stage keeps in the
shared folder while it works are deleted when the next one starts, its result being written by then.
"""

from __future__ import annotations

import contextvars

from newsloom.llm import decontaminate, frames, jaccard_join, quality_rules, sampling, substring_dedup

# What the last stage of this thread stored.
_left: contextvars.ContextVar[tuple[str, ...]] = contextvars.ContextVar("left", default=())


def _stage(work):
    def stage(spark, docs, sf_dir):
        frames.delete(spark, _left.get())
        with frames.recorded() as made:
            out = work(spark, docs, sf_dir)
        _left.set(tuple(made))
        return out

    return stage


STAGES = [
    ("quality_rules", _stage(lambda spark, docs, sf_dir: quality_rules.quality_filter(docs))),
    ("ngram_jaccard_join", _stage(lambda spark, docs, sf_dir: jaccard_join.one_of_each(docs))),
    ("substring_dedup", _stage(lambda spark, docs, sf_dir: substring_dedup.cut_repeats(docs))),
    ("benchmark_decontamination", _stage(lambda spark, docs, sf_dir: decontaminate.clean_only(docs, frames.table(spark, sf_dir, "benchmark")))),
    ("sentencepiece_coding", _stage(lambda spark, docs, sf_dir: sampling.encode(docs, check=True))),
]

# Sampling segmentations can't be said in SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs, before = frames.table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with frames.recorded() as made:
            docs = frames.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        frames.delete(spark, before)
        before = made[-1:]
    return docs
