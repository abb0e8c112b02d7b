"""Token counts by count-only Viterbi (operator 9).

Counts the ids a unigram tokenizer with this vocabulary gives each whole text, without making
them. Tie rules are the tokenizer's: a path replaces another of the same score only if it is
strictly better, paths being tried from the earliest start, so the longer last piece wins.

Null and empty texts have no tokens and score 0. Repeated rows are counted one by one; an empty table
gives an empty one; extra columns are ignored. Texts are counted whole, whatever their length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from newsloom.llm.frames import batches, texts
from newsloom.llm.kernels import slices, strings
from newsloom.llm.pieces import MODEL, Lattice, Vocabulary

SCHEMA = "doc_id bigint, n_chars bigint, n_tokens bigint, score double"


def count_column(column, lattice: Lattice):
    """(tokens, score) of each text."""
    units = lattice.units(column)
    n, inverse = len(units.first) - 1, units.inverse
    score, count = lattice.best_of(units)
    tokens = np.concatenate([[0], np.cumsum(count[inverse])])
    doc = np.repeat(np.arange(n), np.diff(units.first))
    return tokens[units.first[1:]] - tokens[units.first[:-1]], np.bincount(doc, score[inverse], n)


def token_counts(docs: DataFrame, doc_id="doc_id", text="text", model: str = MODEL, vocabulary: Vocabulary | None = None) -> DataFrame:
    """One row per document: code points, tokens, score of the best segmentation."""
    known = vocabulary or Vocabulary.load(model)

    def run(batch, lattice):
        for part in slices(batch, 1):
            tokens, score = count_column(part.column(1), lattice)
            chars = pc.utf8_length(strings(part.column(1))).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), chars, pa.array(tokens, pa.int64()), pa.array(score)], [c.split()[0] for c in SCHEMA.split(", ")])

    return batches(texts(docs, doc_id, text), run, SCHEMA, setup=lambda: Lattice(known, known.scores))
