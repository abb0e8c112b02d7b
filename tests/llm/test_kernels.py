import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm import kernels as K

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\nAé.1日", max_size=30)), max_size=12)


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_patterns(docs):
    raw, offsets = K.buffer(pa.array(docs, pa.string()))
    for table, pattern in ((K.SPACE_WORDS, rb"[^\x20\x09-\x0D]+"), (K.PLAIN_WORDS, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        starts, ends, first = K.words(raw, offsets, table)
        expected = [re.findall(pattern, (d or "").encode()) for d in docs]
        assert [raw[a:b].tobytes() for a, b in zip(starts, ends, strict=True)] == [w for d in expected for w in d]
        assert np.diff(first).tolist() == [len(d) for d in expected]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=120), st.integers(1, 60))
def test_window_hashes_are_equal_exactly_for_equal_windows(values, n):
    h = np.array(values, np.uint64)
    w = K.window_hashes(h, n)
    assert len(w) == max(len(h) - n + 1, 0)
    seen = {}
    for i, x in enumerate(w.tolist()):
        assert seen.setdefault(tuple(values[i : i + n]), x) == x
    assert len(set(seen.values())) == len(seen)


def test_slices_hold_every_row_once():
    batch = pa.RecordBatch.from_pydict({"t": ["x" * n for n in (0, 5, 100, 1, 1, 0, 60)]})
    parts = list(K.slices(batch, 0, 50))
    assert sum(p.num_rows for p in parts) == 7
    assert pa.Table.from_batches(parts).column("t").to_pylist() == batch.column("t").to_pylist()
