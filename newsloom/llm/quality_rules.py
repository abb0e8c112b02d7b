"""Quality rules by distribution divergence (operator 6).

Each document's character-class histogram and common-word histogram are compared, by
Jensen-Shannon distance (base 2, 0 to 1), with a reference gathered from all documents of its
language and script. A reference is the mean of the documents' normalised histograms, summed as
integers, so that it does not depend on the order of the rows. Length guards keep short texts, whose
histograms are noise, from being judged; and where fewer than REFERENCE_DOCS documents of a language and
script are long enough, there is no reference and no verdict by distance: a language is never held
against another one.

The script is that of most of a text's letters (Latin without any). Null or empty texts have no words, so
they fail the base rule; null is a language of its own. Repeated rows are judged one by one; an empty table gives an empty
result; texts are read whole, whatever their length. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.frames import batches, texts
from newsloom.llm.kernels import (
    SPACE_BYTES,
    SPACE_WORDS,
    buffer,
    doc_of,
    mix,
    slices,
    strings,
    window_hashes,
    word_hashes,
    words,
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Length guards: below these many words the histogram is not judged.
CHAR_MIN_WORDS = 50
WORD_MIN_WORDS = 100
# A character distance above MAX_CHAR_DISTANCE rejects alone; a smaller one, above ODD_CHAR_DISTANCE,
# only together with a word distance above ODD_WORD_DISTANCE.
MAX_CHAR_DISTANCE = 0.30
ODD_CHAR_DISTANCE = 0.17
ODD_WORD_DISTANCE = 0.32

# With fewer documents to judge by, a language and script has no reference.
REFERENCE_DOCS = 100

SYMBOLS = b"#*$%&|<>"
# Function words of each language, fixed values.
COMMON = {
    "en": "the of and to in a is that for it was on be with as by this are from at or an not have he his but they which you".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si".split(),
    "fr": "de la le et les des en un une du est que dans qui par pour au il sur ne se pas plus avec son ce sont aux ou mais".split(),
}
# Blocks of letters by script, fixed values; those of three bytes and more begin at multiples of 64.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "indic": [(0x900, 0xDFF)],
    "thai": [(0xE00, 0xE7F)],
    "ethiopic": [(0x1200, 0x137F)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7BF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)],
}
N_CLASSES = 8
SCALE = 1_000_000

_CLASS = np.full(256, 7, np.uint8)
_CLASS[97:123] = 0  # a-z
_CLASS[65:91] = 1  # A-Z
_CLASS[48:58] = 2  # 0-9
_CLASS[list(SPACE_BYTES)] = 3
_CLASS[list(b"!\"'(),-./:;?@[\\]^_`{}~+=")] = 4
_CLASS[list(SYMBOLS)] = 5
_CLASS[128:] = 6
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _scripts():
    """For the first two bytes of each code point its script; len(SCRIPTS) for what is no letter of one."""
    out = np.full((256, 256), len(SCRIPTS), np.uint8)
    for k, blocks in enumerate(SCRIPTS.values()):
        for lo, hi in blocks:
            for c in range(lo, hi + 1) if hi < 0x800 else range(lo, hi + 1, 64):
                raw = chr(c).encode()
                out[raw[0], raw[1] if len(raw) > 1 else slice(None)] = k
    return out


SCRIPT_OF = _scripts()


def _common_hashes():
    """Sorted hashes of the common words, plain and capitalised, and each one's bin."""
    names = sorted({w for ws in COMMON.values() for w in ws})
    forms = [(f, k) for k, w in enumerate(names) for f in dict.fromkeys((w, w.capitalize()))]
    raw, offs = buffer(pa.array([f for f, _ in forms]))
    h = word_hashes(raw, offs[:-1], offs[1:])
    order = np.argsort(h)
    return h[order], np.array([k for _, k in forms])[order], len(names)


COMMON_HASHES, COMMON_BINS, N_COMMON = _common_hashes()


def _per_doc(flags, offsets):
    """Sums of a byte-long array over each document."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_words(h, first, n=3):
    """Words of each document that lie in an n-word window found twice or more in it."""
    n_docs = len(first) - 1
    doc = doc_of(first, len(h))
    if len(h) < n:
        return np.zeros(n_docs, np.int64)
    w = window_hashes(h, n)
    at = np.flatnonzero(doc[: len(w)] == doc[n - 1 :])
    key = w[at] ^ mix(doc[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key)
    s = key[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(len(s), bool)
    twice[1:] |= same
    twice[:-1] |= same
    starts = at[order[twice]]
    cover = np.zeros(len(h) + 1, np.int32)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + n, -1)
    return _per_doc(np.cumsum(cover[:-1]) > 0, first)


def duplicate_lines(column, n_docs):
    out = np.zeros(n_docs, np.int64)
    for k, text in enumerate(column.to_pylist()):
        if "\n" in text:
            lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
            out[k] = len(lines) - len(set(lines))
    return out


def scripts(raw, offsets):
    """The script of each document, as its place in SCRIPTS."""
    if not len(raw):
        return np.zeros(len(offsets) - 1, np.int64)
    kind = SCRIPT_OF[raw, np.append(raw[1:], np.uint8(0))]
    kind[(raw & 0xC0) == 0x80] = len(SCRIPTS)  # counted at the first byte
    found = np.zeros((len(SCRIPTS), len(offsets) - 1), np.int64)
    for k in np.flatnonzero(np.bincount(kind, minlength=len(SCRIPTS) + 1)[:-1]):
        found[k] = _per_doc(kind == k, offsets)
    return found.argmax(0)


def profiles(column, full=True):
    """What the rules read of each text: counts, and both histograms (counts per bin)."""
    column = strings(column)
    raw, offsets = buffer(column)
    starts, ends, first = words(raw, offsets, SPACE_WORDS)
    h = word_hashes(raw, starts, ends)
    n = len(offsets) - 1
    out = {"n_words": np.diff(first)}
    kind = np.repeat(np.arange(n, dtype=np.int64) * N_CLASSES, np.diff(offsets))
    kind += _CLASS[raw]
    out["chars"] = np.bincount(kind, minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    del kind
    place = np.minimum(np.searchsorted(COMMON_HASHES, h), len(COMMON_HASHES) - 1)
    bins = np.where(COMMON_HASHES[place] == h, COMMON_BINS[place], N_COMMON) if len(h) else np.zeros(0, np.int64)
    out["common"] = np.bincount(doc_of(first, len(h)) * (N_COMMON + 1) + bins, minlength=n * (N_COMMON + 1)).reshape(n, N_COMMON + 1)
    out["script"] = scripts(raw, offsets)
    if full:
        out["word_chars"] = _per_doc(SPACE_WORDS[raw] & ((raw & 0xC0) != 0x80), offsets)
        out["n_symbols"] = _per_doc(_SYMBOL[raw], offsets)
        out["n_dup_lines"] = duplicate_lines(column, n)
        out["n_repeat_words"] = repeated_words(h, first)
    return out


def _shares(counts):
    return counts / np.maximum(counts.sum(1, keepdims=True), 1)


def js_distance(p, q):
    """Jensen-Shannon distance, base 2, of the rows of p from q; 0 for an empty histogram."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    return np.where(p.sum(1) > 0, np.sqrt(np.clip((left + right) / 2, 0, 1)), 0)


def _groups(column, script):
    """(language, script) of each document, as row numbers of the distinct ones."""
    names = list(zip(column.to_pylist(), script.tolist(), strict=True))
    known = {g: k for k, g in enumerate(dict.fromkeys(names))}
    return list(known), np.array([known[g] for g in names], np.int64)


def references(docs: DataFrame, text="text", lang="lang") -> dict[tuple[str | None, int], tuple[list[float], list[float]]]:
    """Mean histograms of every language and script, over all its documents long enough to be judged."""

    def gather(batch):
        for part in slices(batch, 0):
            p = profiles(part.column(0), full=False)
            long = p["n_words"] >= WORD_MIN_WORDS
            both = np.concatenate([_shares(p["chars"]), _shares(p["common"])], axis=1)
            whole = np.round(both * SCALE).astype(np.int64)
            names, of = _groups(part.column(1), p["script"])
            rows = [(name, script, int(pick.sum()), whole[pick].sum(0).tolist()) for k, (name, script) in enumerate(names) if (pick := long & (of == k)).any()]
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], ["lang", "script", "n", "sums"])

    parts = batches(texts(docs, text, lang), gather, "lang string, script int, n bigint, sums array<bigint>")
    sums = parts.select("lang", "script", "n", F.posexplode("sums").alias("bin", "v")).groupBy("lang", "script", "bin").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    out = {}
    for name, script, got in sums.where(F.col("n") >= REFERENCE_DOCS).groupBy("lang", "script").agg(F.array_sort(F.collect_list(F.struct("bin", "v"))).alias("x")).collect():
        v = np.array([y["v"] for y in got], float)
        out[name, script] = tuple((x / max(x.sum(), 1)).tolist() for x in (v[:N_CLASSES], v[N_CLASSES:]))
    return out


SCHEMA = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, char_distance double, word_distance double"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def verdicts(text_column, lang_column, known):
    """(counts, base_failed, kept, character distance, word distance) of each text."""
    p = profiles(text_column)
    n = p["n_words"]
    names, of = _groups(lang_column, p["script"])
    chars, common = _shares(p["chars"]), _shares(p["common"])
    dc, dw = np.zeros(len(n)), np.zeros(len(n))
    for k, name in enumerate(names):
        if ref := known.get(name):
            pick = of == k
            dc[pick] = js_distance(chars[pick], np.array(ref[0]))
            dw[pick] = js_distance(common[pick], np.array(ref[1]))
    failed = (n < MIN_WORDS) | (100 * p["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
    odd = ((n >= CHAR_MIN_WORDS) & (dc > MAX_CHAR_DISTANCE)) | ((n >= WORD_MIN_WORDS) & (dc > ODD_CHAR_DISTANCE) & (dw > ODD_WORD_DISTANCE))
    return p, failed, ~failed & ~odd, dc, dw


def quality_rules(docs: DataFrame, doc_id="doc_id", text="text", lang="lang") -> DataFrame:
    """One row per document: the base counts, both distances, and the verdict `kept`."""
    known = references(docs, text, lang)

    def judge(batch):
        for part in slices(batch, 1):
            p, failed, kept, dc, dw = verdicts(part.column(1), part.column(2), known)
            counts = [pa.array(p[k], pa.int64()) for k in COUNTS]
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), *counts, pa.array(failed), pa.array(kept), pa.array(dc), pa.array(dw)], [c.split()[0] for c in SCHEMA.split(", ")])

    return batches(texts(docs, doc_id, text, lang), judge, SCHEMA)


def quality_filter(docs: DataFrame, text="text", lang="lang") -> DataFrame:
    """The documents, with all their columns, that the rules keep."""
    known = references(docs, text, lang)
    at = [docs.columns.index(text), docs.columns.index(lang)]

    def judge(batch):
        for part in slices(batch, at[0]):
            kept = verdicts(part.column(at[0]), part.column(at[1]), known)[2]
            yield part.filter(pa.array(kept))

    return batches(texts(docs, *docs.columns), judge, docs.schema)
