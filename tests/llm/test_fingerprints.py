"""Operator 13 against plain Python."""

import hashlib
import random

import xxhash

from newsloom.llm.syncmers import ANCHORS, BAND, K, S, document_fingerprints


def signed(x, bits):
    return x - (1 << bits) if x >> (bits - 1) else x


def h64(data):
    return signed(xxhash.xxh64(data, seed=42).intdigest(), 64)


def anchors(text):
    """The smallest anchors, (hash, first place), of a text."""
    found = {}
    for i in range(len(text) - K + 1):
        inner = [h64(text[i + j : i + j + S].encode("utf-32-be")) for j in range(K - S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            found.setdefault(h64(text[i : i + K].encode("utf-32-be")) >> 32, i)
    if not found and text:
        found = {h64(text.encode()) >> 32: 0}
    return dict(sorted(found.items())[:ANCHORS])


def written(a):
    return " ".join(f"{x & 0xFFFFFFFF:08x}@{p}" for p, x in sorted((p, x) for x, p in a.items()))


def likeness(a, b, longer):
    both = sorted(set(a) | set(b))[:ANCHORS]
    if not both:
        return 1.0
    shifts = sorted(b[x] - a[x] for x in both if x in a and x in b)
    if not shifts:
        return 0.0
    middle = shifts[len(shifts) // 2]
    return sum(abs(s - middle) <= max(BAND, longer / 8) for s in shifts) / len(both)


def brute(rows):
    last = (1 << 63) - 1
    docs = sorted({(last if i is None else i, h64((t or "").encode()), t or ""): i for i, t in rows}.items(), key=lambda x: x[0])
    out = []
    for (key, i), (after, _) in zip(docs, docs[1:] + docs[:1], strict=True):
        text, head = key[2], after[2]
        m = len(text) // 4
        new = text[: len(text) - m] + head[:m]
        a, b, c = anchors(text), anchors(new), anchors(head)
        near = (likeness(a, b, max(len(text), len(new))), likeness(a, c, max(len(text), len(head))))
        out.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), written(a), written(b), *near))
    return sorted(out, key=str)


def got(df):
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted((tuple(r) for r in document_fingerprints(df).select(*columns).collect()), key=str)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 120")
    assert got(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_odd_rows(make, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect() if len(r["text"] or "") < 20_000]
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    moved = " ".join(words[200:] + words[:200])
    rows += [(20, " ".join(words)), (21, moved), (22, " ".join(words)), (22, moved), (-5, "🎉" * 200), (23, "".join(rng.choices("ab", k=3000))), (24, "x" * (K - 1)), (25, "y" * K)]
    assert got(make(rows)) == brute(rows)


def test_very_long_text(make):
    rng = random.Random(8)
    rows = [(1, "".join(rng.choices("abcdefgh é", k=120_000))), (2, "z" * 100_000), (3, "short")]
    assert got(make(rows)) == brute(rows)


def test_nothing_and_one(make):
    assert got(make([], clash=False)) == []
    assert got(make([(1, None)])) == brute([(1, None)])
    assert got(make([(1, "one document that is its own next one, of some length")])) == brute([(1, "one document that is its own next one, of some length")])


def test_what_the_likeness_tells(make):
    """Equal texts 1, an edit about the share it keeps, a shared passage elsewhere little, unrelated texts nothing."""
    rng = random.Random(1)
    prose = lambda: " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(600))
    a, b = prose(), prose()
    rows = {r["doc_id"]: r for r in document_fingerprints(make([(1, a), (2, a), (3, b), (4, b[len(b) // 2 :] + a)])).collect()}
    assert rows[1]["near_next"] == 1.0 and rows[1]["fingerprint"] == rows[2]["fingerprint"]
    assert rows[2]["near_next"] == 0.0
    assert all(0.4 < r["near_edited"] < 0.85 for r in rows.values() if r["doc_id"] != 1)
