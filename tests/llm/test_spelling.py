"""Operator 11 against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from newsloom.llm.spelling import anagram_keys, near_pairs, roots, spelling_variants


def brute(rows, least=5):
    n = Counter()
    for i, t in rows:
        low = re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= least}
    near = edits(n)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o))
        if n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near.get(w, ())), n[form[w]] if w in form else None))
    return sorted(out)


def edits(words):
    near, gaps = defaultdict(set), defaultdict(set)
    for w in words:
        for p in range(len(w)):
            rest = w[:p] + w[p + 1 :]
            gaps[p, rest].add(w)
            if rest in words:
                near[w].add(rest)
                near[rest].add(w)
    for group in gaps.values():
        for w in group:
            if len(group) > 1:
                near[w] |= group - {w}
    return near


def got(df):
    return sorted(tuple(r) for r in spelling_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.fixture(scope="module")
def chains(make):
    """Words with variants of variants, anagrams, doubled letters, ties and letters beyond ASCII."""
    rng = random.Random(4)
    counts = {"abcdefg": 1300, "abcdefh": 200, "abcdeh": 30, "abdceh": 5, "zabcdeh": 6, "aaaaaa": 6, "aaaaaaa": 31, "aaaaaaaa": 200, "ébäcüd": 7, "ébäcüdé": 50, "gfedcba": 9, "tieone": 5, "tietwo": 25, "tieowo": 5, "tiexwo": 25, "short": 90, "rarely": 4, "×÷×÷×÷": 6}
    words = [w if k % 3 else w.upper() if w.isascii() else w for w, c in counts.items() for k in range(c)]
    rng.shuffle(words)
    return [(i if i % 7 else None, " ".join(words[k : k + 23]) + ("-x9" if i % 2 else "")) for i, k in enumerate(range(0, len(words), 23))]


def test_against_plain_python(make, chains):
    assert got(make(chains)) == brute(chains)
    assert any(f and r != f for _, f, r, *_ in brute(chains))


def test_documents_and_odd_rows(spark, sf, make, odd):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert got(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()] + [(50, "ä" * 70_000 + " repeated word " * 9)] * 6
    assert got(make(rows)) == brute(rows)


def test_nothing(make):
    assert got(make([], clash=False)) == []
    assert got(make([(1, None), (2, "")])) == []


def test_keys_are_sums_of_powers(spark):
    row = anagram_keys(spark.createDataFrame([("abcaé", 9)], "word string, n long")).first()
    assert row["key"] == sum(ord(c) ** 5 for c in "abcaé")
    assert {(x["letter"], x["key"]) for x in row["less"]} == {(c, row["key"] - ord(c) ** 5) for c in "abcé"}


def test_all_pairs_of_a_large_family(spark):
    """Many words of the same letters: each near pair once, nothing else."""
    rng = random.Random(9)
    words = set()
    while len(words) < 3000:
        w = list("abcdabcd")
        rng.shuffle(w)
        words.add("".join(w)[: rng.choice((7, 8))] + rng.choice("xyz"))
    pairs = near_pairs(spark.createDataFrame([(w, 5) for w in words], "word string, n long")).collect()
    found = [frozenset((r["a"], r["b"])) for r in pairs]
    assert len(found) == len(set(found))
    assert set(found) == {frozenset((a, b)) for a, bs in edits(words).items() for b in bs}


def test_roots_of_long_chains(spark):
    hops = [(f"w{k}", f"w{k + 1}") for k in range(37)] + [(f"v{k}", "w5") for k in range(50)]
    assert all(r["root"] == "w37" for r in roots(spark.createDataFrame(hops, "word string, form string")).collect())
