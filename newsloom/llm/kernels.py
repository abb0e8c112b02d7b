"""Vectorised text kernels over Arrow buffers, shared by the operators of this subpackage.

A batch of texts is one byte array plus offsets; words are (start, end) pairs in it.
Nulls count as empty texts everywhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BATCH_BYTES = 4_000_000


def _table(pairs):
    t = np.ones(256, bool)
    for lo, hi in pairs:
        t[lo : hi + 1] = False
    return t


# Byte tables: the two word patterns of the contracts. Bytes from 0x80 on belong to words in both.
SPACE_WORDS = _table([(0x20, 0x20), (0x09, 0x0D)])
PLAIN_WORDS = _table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE_BYTES = b" \t\n\x0b\x0c\r"
# For bytes.translate: A-Z to a-z, and what is no word byte to a space.
PLAIN_TRANSLATE = bytes(LOWER[b] if PLAIN_WORDS[LOWER[b]] else 32 for b in range(256))
LOWER_TRANSLATE = bytes(LOWER.tolist())

_rng = np.random.default_rng(0x5EED)
BYTE_KEYS = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WORD_BASE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
WINDOW_BASE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mix(x):
    """A 64-bit finaliser, in place where it can."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def strings(column):
    """An Arrow string column as one large_string array without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def buffer(column):
    """(bytes, offsets) of an Arrow string column; offsets start at 0."""
    column = strings(column)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def slices(batch, column, limit=BATCH_BYTES):
    """Parts of a record batch whose texts hold about `limit` bytes, or one row."""
    _, offsets = buffer(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi


def words(raw, offsets, table):
    """Starts, ends of all words, and for each document the index of its first word (n + 1 entries)."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = table[raw]
    edge = np.empty(len(raw) + 1, bool)
    edge[0], edge[-1] = inside[0], inside[-1]
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    cuts = np.unique(cuts[inside[cuts] & inside[cuts - 1]])
    flips = np.flatnonzero(edge)
    if len(cuts):  # a word that runs over a document's end is two words
        flips = np.sort(np.concatenate([flips, cuts, cuts]), kind="stable")
    starts, ends = flips[0::2], flips[1::2]
    return starts, ends, np.searchsorted(starts, offsets)


def powers(base, n):
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(raw, starts, ends, which=0):
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64)
    within = place - np.repeat(first, lengths)
    at = within + np.repeat(starts, lengths)
    keys = BYTE_KEYS[which][raw[at]]
    keys *= powers(WORD_BASE[which], int(lengths.max()))[within]
    return mix(np.add.reduceat(keys, first) + lengths.astype(np.uint64))


def window_hashes(h, n, which=0):
    """Hash of each run of n consecutive values; runs may span documents, the caller masks those."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    if n <= 12:
        for k in range(n):
            out *= WINDOW_BASE[which]
            out += h[k : len(h) - n + 1 + k]
        return mix(out)
    # Doubling: the hash of 2m values from two of m.
    base, have, done = WINDOW_BASE[which], h, 1
    acc, acc_n = None, 0
    while True:
        if n & done:
            if acc is None:
                acc, acc_n = have, done
            else:
                shift = powers(base, acc_n + 1)[acc_n]
                size = len(h) - acc_n - done + 1
                acc = have[:size] * shift + acc[done : done + size]
                acc_n += done
        if done * 2 > n:
            break
        size = len(h) - 2 * done + 1
        have = have[:size] * powers(base, done + 1)[done] + have[done : done + size]
        done *= 2
    return mix(acc + np.uint64(n))


def doc_of(first, n_words):
    """The document index of every word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first)) if n_words else np.zeros(0, np.int64)


def signed(h):
    return h.view(np.int64)
