"""Each operator against a brute-force version, on ordinary and on odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from newsloom.llm.class_lm import best_class, score_corpus
from newsloom.llm.decontaminate import build_index, clean_only, contaminated, digest, find_near
from newsloom.llm.jaccard_join import jaccard_join, one_of_each, prefix_length, recall
from newsloom.llm.licenses import evaluate, license_scan
from newsloom.llm.quality_classifier import quality_classifier
from newsloom.llm.quality_rules import quality_filter, quality_rules
from newsloom.llm.substring_dedup import anchors, cut_repeats, longest_repeats, substring_dedup

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
lower = lambda s: re.sub("[A-Z]+", lambda m: m[0].lower(), s or "")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def corpus(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def near(make):
    """Groups of copies and near copies, with ties."""
    rng = np.random.default_rng(5)
    rows, i = [], 0
    for _ in range(12):
        words = [f"v{x}" for x in rng.integers(0, 4000, 160)]
        for copy in range(int(rng.integers(1, 9))):
            own = list(words)
            for p in rng.integers(0, 160, int(rng.integers(0, 7))) if copy else []:
                own[p] = f"n{i}"
            rows.append((i * 3 % 101 + 200 * (i // 101), " ".join(own)))
            i += 1
    return make(rows)


# Operator 2


def removed(rows, window=50):
    owner, out = {}, []
    split = [(math.inf if i is None else i, SPACE.findall(t or "")) for i, t in rows]
    for i, w in split:
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            owner[key] = min(owner.get(key, math.inf), i)
    for (i, w), (own, _) in zip(split, rows, strict=True):
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if owner[tuple(w[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        out.append((own, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return sorted(out, key=str)


@pytest.mark.parametrize("which", ["corpus", "odd", "near"])
def test_substring_dedup(which, request):
    df = request.getfixturevalue(which)
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows_of(substring_dedup(df))), key=str)
    assert got == removed(texts_of(df))


def test_substring_of_nothing(make):
    assert substring_dedup(make([])).count() == 0


def test_cut_repeats_keeps_columns_and_leaves_the_first(near, spark):
    out = cut_repeats(near)
    assert out.columns == near.columns
    kept = {r["doc_id"]: r["text"] for r in rows_of(out)}
    brute = {i: (n, gone) for i, n, gone, _ in removed(texts_of(near))}
    assert set(kept) == {i for i, (n, gone) in brute.items() if gone < n}
    assert all(len(SPACE.findall(kept[i])) == brute[i][0] - brute[i][1] for i in kept)
    assert all(r["k"] == "clash" for r in rows_of(out))


def test_every_run_of_windows_has_an_anchor():
    from newsloom.llm.kernels import window_hashes

    rng = np.random.default_rng(1)
    for _ in range(100):
        w = np.repeat(rng.integers(0, 3, 30), rng.integers(1, 30, 30))[:160].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        pick, _ = anchors(w, np.array([0, len(w)]), 25, 50)
        h, have = window_hashes(w, 25), set(pick.tolist())
        for p in range(len(w) - 49):
            least = h[p : p + 26].min()
            assert any(j in have and h[j] == least for j in range(p, p + 26))


def test_longest_repeats_double(make):
    long = " ".join(f"q{i}" for i in range(230))
    df = make([(1, long), (2, "x " + long + " y"), (3, " ".join(f"q{i}" for i in range(60)) + " z")])
    assert {r["doc_id"]: r["longest"] for r in rows_of(longest_repeats(df))} == {1: 200, 2: 200, 3: 50}


def longest(rows, window=50):
    """Brute force: of each document row the longest window * 2**i that another document has too."""
    split = [(math.inf if i is None else i, SPACE.findall(t or "")) for i, t in rows]
    out, n = {}, window
    while True:
        owners = {}
        for i, w in split:
            for p in range(len(w) - n + 1):
                owners.setdefault(tuple(w[p : p + n]), set()).add(i)
        more = {k: n for k, (_, w) in enumerate(split) if any(len(owners[tuple(w[p : p + n])]) > 1 for p in range(len(w) - n + 1))}
        if not more:
            return sorted(((rows[k][0], v) for k, v in out.items()), key=str)
        out |= more
        n *= 2


def test_longest_repeats(make, near):
    long = " ".join(f"q{i}" for i in range(230))
    more = make([(1, long), (2, "x " + long + " y"), (3, " ".join(f"q{i}" for i in range(60)) + " z"), (4, long), (5, "short"), (5, "short"), (6, None), (None, long), (8, "a " * 51), (9, "a " * 51)])
    copies = make([(1, long), (2, long), (3, "none of this")])
    for df in (more, near, copies):
        assert sorted(((r["doc_id"], r["longest"]) for r in rows_of(longest_repeats(df))), key=str) == longest(texts_of(df))
    assert longest_repeats(make([])).count() == 0
    assert {r["longest"] for r in rows_of(longest_repeats(copies, max_window=150))} == {100}


@pytest.mark.parametrize("window", [4, 7, 10, 21])
def test_substring_dedup_at_other_lengths(make, window):
    rng = np.random.default_rng(window)
    parts = [" ".join(f"p{x}" for x in rng.integers(0, 9, 30)) for _ in range(6)]
    df = make([(i, " ".join(str(rng.integers(0, 50)) if rng.random() < 0.5 else parts[rng.integers(0, 6)][: int(rng.integers(5, 80))] for _ in range(8))) for i in range(40)])
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows_of(substring_dedup(df, window=window))), key=str)
    assert got == removed(texts_of(df), window)


# Operator 3


def classes(rows, threshold=0.8):
    rep, sets = {}, {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        t = t or ""
        if t not in rep:
            rep[t] = i
            w = SPACE.findall(t)
            sets[i] = {tuple(w[p : p + 5]) for p in range(max(1, len(w) - 4))} if w else set()
    parent, links = {i: i for i in sets}, Counter()

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both >= threshold * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return sorted((i, find(rep[t or ""]), links[rep[t or ""]], rep[t or ""]) for i, t in rows)


@pytest.mark.parametrize("block", [256, 2])
def test_jaccard_join(near, block):
    got = sorted((r["doc_id"], r["class_id"], r["n_links"], r["text_id"]) for r in rows_of(jaccard_join(near, block=block)))
    assert got == classes(texts_of(near))


def test_jaccard_join_of_odd_rows(odd):
    got = rows_of(jaccard_join(odd))
    assert len(got) == odd.count()
    known = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert known[3]["class_id"] == 1 and known[3]["text_id"] == 1 and known[2]["n_copies"] == 2
    assert known[12]["class_id"] == 7 and known[12]["n_links"] == 0
    assert all(known[i]["n_links"] == 0 for i in (4, 5, 6, 9, 10, 11))


def test_one_of_each(near, odd, make):
    expected = sorted(i for i, c, _, t in classes(texts_of(near)) if i == c == t)
    out = one_of_each(near)
    assert out.columns == near.columns and sorted(r["doc_id"] for r in rows_of(out)) == expected
    # Unlike texts that share a doc_id stay, each once; so do those without a doc_id.
    other = make([(5, "one two three four five six seven"), (5, "un deux trois quatre cinq six sept"), (5, "one two three four five six seven"), (None, "eins zwei drei vier fünf sechs"), (None, "uno dos tres cuatro cinco seis"), (7, "un deux trois quatre cinq six sept")])
    out = Counter((r["doc_id"], r["text"][:3]) for r in rows_of(one_of_each(other)))
    assert out == Counter({(5, "one"): 1, (5, "un "): 1, (None, "ein"): 1, (None, "uno"): 1})
    kept = [r["doc_id"] for r in rows_of(one_of_each(odd))]
    assert kept.count(2) <= 1 and 3 not in kept and 12 not in kept
    assert one_of_each(make([])).count() == 0


def test_recall_at_the_threshold_and_above(make):
    """Pairs of a known similarity: the share that the forest finds."""
    rng = np.random.default_rng(11)
    rows, pairs = [], 0
    for similarity in (0.8, 0.85, 0.9):
        for _ in range(60):
            n = 200
            w = [f"r{x}" for x in rng.integers(0, 10**9, n + 4)]
            both = round(similarity * (n + n) / (1 + similarity))  # shingles shared so that the Jaccard similarity is right
            tail = [f"t{x}" for x in rng.integers(0, 10**9, n - both)]
            rows += [(2 * pairs, " ".join(w)), (2 * pairs + 1, " ".join(w[: both + 4] + tail))]
            pairs += 1
    want = {i: n for i, _, n, _ in classes(rows)}
    got = {r["doc_id"]: r["n_links"] for r in rows_of(jaccard_join(make(rows)))}
    linked = [i for i, n in want.items() if n]
    assert len(linked) > 280 and sum(got[i] == want[i] for i in linked) >= 0.995 * len(linked)
    assert all(got[i] == 0 for i, n in want.items() if not n)


def test_prefixes_are_shortened_by_what_was_found():
    from newsloom.llm.jaccard_join import expected_recall, shortened

    close, far = np.zeros(20), np.zeros(20)
    close[19], far[0] = 1000, 1000  # links of similarity 0.99, of 0.8
    assert shortened(8, close, 8, 0.8, 16, 0.999) > shortened(8, far, 8, 0.8, 16, 0.999)
    for found in (close, far, close * 0):
        k = shortened(8, found, 8, 0.8, 16, 0.999)
        assert expected_recall(k, found, 8, 0.8, 16) >= 0.999 and (k == 7 or expected_recall(k + 1, found, 8, 0.8, 16) < 0.999)


def test_prefixes_reach_the_recall():
    for target in (0.9, 0.99, 0.9995):
        k = prefix_length(0.8, 16, 12, target)
        assert recall(0.8, k) >= target > recall(0.8, k + 1)


# Operator 4


def hits(docs, items, window=10):
    places = {}
    for i, t in items:
        if i is not None:
            w = PLAIN.findall(lower(t))
            n = min(window, len(w))
            for p in range(len(w) - n + 1) if n else []:
                places.setdefault(tuple(w[p : p + n]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = PLAIN.findall(lower(t)), set(), set()
        for n in {len(k) for k in places}:
            for p in range(len(w) - n + 1):
                if own := places.get(tuple(w[p : p + n])):
                    found |= own
                    hit |= set(range(p, p + n))
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, "W1 w2 w3"), (2, " ".join(f"w{i}" for i in range(20, 45))), (3, None), (4, ""), (None, "one"), (10, "one two"), (10, "same same same same"), (11, "absent words here")]


def as_tuples(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in rows_of(df)), key=str)


def test_decontamination_of_odd_rows(odd, spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    expected = hits(texts_of(odd), ITEMS)
    assert as_tuples(digest(contaminated(odd, items))) == expected
    assert contaminated(odd.limit(0), items).count() == 0


def test_decontamination_in_blocks_keeps_every_row(odd, spark, monkeypatch):
    from newsloom.llm import decontaminate as D

    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(D.item_blocks, "__defaults__", ("item_id", "text", 5))
    assert as_tuples(digest(contaminated(odd, items))) == hits(texts_of(odd), ITEMS)


def test_decontamination(corpus, spark, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    got = as_tuples(digest(contaminated(corpus, items)))
    assert got == hits(texts_of(corpus), [(r["item_id"], r["text"]) for r in items.collect()])


def test_clean_only(odd, spark, make):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = clean_only(odd, items)
    expected = Counter(i for i, *_, hit in hits(texts_of(odd), ITEMS) if not hit)
    assert out.columns == odd.columns and Counter(r["doc_id"] for r in rows_of(out)) == expected
    assert clean_only(make([]), items).count() == 0
    assert clean_only(odd, items.limit(0)).count() == odd.count()


def test_proximity(make):
    index = build_index(make([(1, "a b x y c z"), (2, "c b q q q q q a"), (3, "B! a, c")]))
    assert sorted((r["doc_id"], r["start"], r["end"]) for r in rows_of(find_near(index, "a b c", 5))) == [(1, 0, 5), (3, 0, 3)]


def test_proximity_of_repeated_terms(make):
    rng = np.random.default_rng(4)
    rows = [(1, "x b x a x x b c"), (2, "a b"), (3, "c b a")] + [(k, " ".join(rng.choice(list("abcxyz"), 40))) for k in range(4, 30)]
    want = []
    for i, t in rows:
        w = t.split()
        spans = [(lo, hi) for lo in range(len(w)) for hi in range(lo + 1, min(lo + 5, len(w)) + 1) if set("abc") <= set(w[lo:hi])]
        want += [(i, lo, hi) for lo, hi in spans if not any(lo <= a and b <= hi and (a, b) != (lo, hi) for a, b in spans)]
    got = sorted((r["doc_id"], r["start"], r["end"]) for r in rows_of(find_near(build_index(make(rows)), "a b c", 5)))
    assert got == want and (1, 3, 8) in got


def test_the_driver_holds_one_block_of_items(make, spark, monkeypatch):
    """A benchmark of many blocks: what a block's search needs is gone when the next is made."""
    import gc
    import weakref

    from newsloom.llm import decontaminate as D

    rng = np.random.default_rng(4)
    texts = [" ".join(f"b{x}" for x in rng.integers(0, 30, rng.integers(3, 40))) for _ in range(60)]
    rows = [(k, " ".join(t.split()[2:14]) + " and more of it") for k, t in enumerate(texts[::3])] + [(99, "nothing of that"), (100, None)]
    items = spark.createDataFrame([(f"i{k}", t) for k, t in enumerate(texts)], "item_id string, text string")
    alive, most, made, real = [], [], [], D.phrases_of

    class Held(dict):
        pass

    def counted(*args):
        gc.collect()
        alive[:] = [r for r in alive if r() is not None]
        out = Held(real(*args))
        alive.append(weakref.ref(out))
        most.append(len(alive))
        made.append(sum(a.nbytes for x in out.values() for a in x))
        return out

    monkeypatch.setattr(D.item_blocks, "__defaults__", ("item_id", "text", 30))
    monkeypatch.setattr(D, "phrases_of", counted)
    found = as_tuples(digest(contaminated(make(rows), items)))
    kept = {r["doc_id"] for r in rows_of(clean_only(make(rows), items))}
    assert len(made) >= 40 and max(most) <= 2 and max(made) < sum(made) / 5
    want = hits(rows, [(f"i{k}", t) for k, t in enumerate(texts)])
    assert found == want and kept == {i for i, *_, hit in want if not hit}


# Operator 5


def test_license_expressions():
    assert evaluate("MIT OR GPL-3.0-only") == ({"mit", "gpl"}, 0.1)
    assert evaluate("MIT AND GPL-3.0-only") == ({"mit", "gpl"}, 0.7)
    assert evaluate("GPL-2.0-or-later WITH Classpath-exception-2.0") == ({"gpl"}, 0.35)
    assert evaluate("MIT OR GPL-3.0 AND Apache-2.0") == ({"mit", "gpl", "apache"}, 0.1)
    assert evaluate("(MIT OR GPL-3.0) AND Apache-2.0") == ({"mit", "gpl", "apache"}, 0.15)
    assert evaluate("MIT AND (") == ({"mit"}, 0.1)
    assert evaluate("") == (set(), 0.0)


def base_places(text):
    w = PLAIN.findall(lower(text))
    found = []
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        found += [(k, label) for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
    at = [k for k, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_license_scan(corpus, make, odd):
    more = make([(1, "CC-BY cc by CC BY, all rights\nreserved! GENERAL public License"), (2, "x\nSPDX-License-Identifier: MIT OR Apache-2.0\ny"), (3, "cc bye all rights not reserved")])
    for df in (corpus, more, odd):
        known = {}
        for r in rows_of(license_scan(df)):
            known.setdefault((r["doc_id"], r["n_words"]), r)
        for i, t in texts_of(df):
            n, places, first, last, labels = base_places(t)
            r = known[i, n]
            assert (r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (places, first, last, labels)
            assert 0 <= r["score"] <= 1 and set(filter(None, labels.split(","))) <= set(r["labels"].split(","))
    assert rows_of(license_scan(more.where("doc_id = 2")))[0]["labels"] == "apache,mit"


def labels_and_score(text):
    """Brute force of the method's own columns: phrases word by word, expressions by recursive descent."""
    from newsloom.llm.licenses import BASE, PHRASES, UNKNOWN_WEIGHT, WEIGHTS, family

    w = PLAIN.findall(lower(text))
    found = {label for phrase, label in (BASE | PHRASES).items() if any(w[k : k + len(phrase.split())] == phrase.split() for k in range(len(w)))}
    scores = [WEIGHTS[x] for x in found]

    def parse(parts, level):
        """(labels, weight) of an expression from the left: or binds least, with most."""
        if level == 3:
            head = parts.pop(0)
            if head == "(":
                out = parse(parts, 0)
                assert parts.pop(0) == ")"
                return out
            assert head not in ("and", "or", "with", ")")
            return {family(head)}, WEIGHTS.get(family(head), UNKNOWN_WEIGHT)
        out = parse(parts, level + 1)
        while parts and parts[0].lower() == ("or", "and", "with")[level]:
            parts.pop(0)
            right = parse(parts, level + 1)
            out = (out[0], out[1] / 2) if level == 2 else (out[0] | right[0], (min, max)[level](out[1], right[1]))
        return out

    for m in re.finditer(r"(?i)(?:spdx-license-identifier|license-expression)\s*:[ \t]*([^\r\n]*)", text or ""):
        parts = re.findall(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*", m[1])
        try:
            names, weight = parse([p.lower() if p.lower() in ("and", "or", "with") else p for p in parts], 0) if parts else (set(), 0.0)
            left = list(parts)
            parse(left, 0) if parts else None
            assert not left
        except (AssertionError, IndexError):
            known = {family(p) for p in parts if p.lower() not in ("and", "or", "with")} & set(WEIGHTS)
            names, weight = known, max((WEIGHTS[x] for x in known), default=0.0)
        found |= names
        scores.append(weight)
    return ",".join(sorted(found)), max(scores, default=0.0)


def test_license_labels(corpus, odd, make):
    more = make(
        [
            (1, "SPDX-License-Identifier: MIT AND GPL-2.0 WITH MIT\nspdx-license-identifier : (Apache-2.0 OR GPL-3.0) and bsd-3-clause"),
            (2, "License-Expression: MIT OR\nPublic Domain, and the MIT license"),
            (3, "spdx license identifier: MIT"),
            (4, "cc by nc cc by " * 20_000 + "end"),
            (5, "x SPDX-License-Identifier:\nMIT"),
            (6, "SPDX-License-Identifier: Unheard-Of-1.0 WITH Some-exception OR 0BSD"),
        ]
    )
    for df in (corpus, odd, more):
        want = Counter((i, *labels_and_score(t)) for i, t in texts_of(df))
        assert Counter((r["doc_id"], r["labels"], r["score"]) for r in rows_of(license_scan(df))) == want
    assert license_scan(make([])).count() == 0


# Operator 6


def counts(text):
    t = text or ""
    w = SPACE.findall(t)
    lines = [x for x in t.split("\n") if SPACE.search(x)]
    windows = Counter(tuple(w[p : p + 3]) for p in range(len(w) - 2))
    hit = {q for p in range(len(w) - 2) if windows[tuple(w[p : p + 3])] > 1 for q in range(p, p + 3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


def test_quality_rules(corpus, odd, make):
    for df in (corpus, odd):
        got = Counter(tuple(r[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in rows_of(quality_rules(df)))
        assert got == Counter((i, *counts(t)) for i, t in texts_of(df))
    assert quality_rules(make([])).count() == 0


def verdicts_by_hand(rows):
    """(doc_id, kept, character distance, word distance) of each row, from the texts alone."""
    from newsloom.llm import quality_rules as R

    common = sorted({w for ws in R.COMMON.values() for w in ws})
    forms = {f: k for k, w in enumerate(common) for f in (w.capitalize(), w)}
    punctuation, symbols = set(b"!\"'(),-./:;?@[\\]^_`{}~+="), set(b"#*$%&|<>")

    def kind(b):
        return 0 if 97 <= b < 123 else 1 if 65 <= b < 91 else 2 if 48 <= b < 58 else 3 if b in b" \t\n\x0b\x0c\r" else 4 if b in punctuation else 5 if b in symbols else 6 if b >= 128 else 7

    def shares(text):
        raw, w = (text or "").encode(), SPACE.findall(text or "")
        chars, words = Counter(map(kind, raw)), Counter(forms.get(x, len(common)) for x in w)
        return [chars[k] / max(len(raw), 1) for k in range(8)], [words[k] / max(len(w), 1) for k in range(len(common) + 1)], len(w)

    def distance(p, q):
        if not any(p):
            return 0.0
        part = lambda x, m: sum(a * math.log2(a / b) for a, b in zip(x, m, strict=True) if a > 0)
        m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
        return math.sqrt(min(max((part(p, m) + part(q, m)) / 2, 0), 1))

    def script(text):
        found = Counter(name for c in text or "" for name, blocks in R.SCRIPTS.items() if any(lo <= ord(c) <= hi for lo, hi in blocks))
        return max(R.SCRIPTS, key=lambda name: found[name])

    sums, many = {}, Counter()
    made = [(i, t, (lang, script(t)), *shares(t)) for i, t, lang in rows]
    for _, _, name, chars, words, n in made:
        if n >= 100:
            many[name] += 1
            old = sums.setdefault(name, ([0] * 8, [0] * len(words)))
            for total, x in zip(old, (chars, words), strict=True):
                for k, v in enumerate(x):
                    total[k] += round(v * 1_000_000)
    refs = {name: tuple([v / max(sum(x), 1) for v in x] for x in both) for name, both in sums.items() if many[name] >= R.REFERENCE_DOCS}
    out = []
    for i, t, lang, chars, words, n in made:
        ref = refs.get(lang)
        dc, dw = (distance(chars, ref[0]), distance(words, ref[1])) if ref else (0.0, 0.0)
        odd = (n >= 50 and dc > 0.30) or (n >= 100 and dc > 0.17 and dw > 0.32)
        out.append((i, not counts(t)[-1] and not odd, round(dc, 6), round(dw, 6)))
    return out


def test_quality_verdicts(corpus, odd, spark, sf):
    for df in (corpus, odd, spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")):
        rows = [(r["doc_id"], r["text"], r["lang"]) for r in df.select("doc_id", "text", "lang").collect()]
        key = lambda r: (str(r[0]), r[2], r[3])
        want = sorted(verdicts_by_hand(rows), key=key)
        got = sorted(((r["doc_id"], r["kept"], round(r["char_distance"], 6), round(r["word_distance"], 6)) for r in rows_of(quality_rules(df))), key=key)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2:] for g in got], [w[2:] for w in want], atol=2e-6)


def foreign(n_english=300, n_other=30):
    """English texts and clean ones in other scripts and languages, of 200 random common words each."""
    rng = np.random.default_rng(7)
    common = {
        "en": "the of and to in is that for it was house tree water people government during under small market".split(),
        "ru": "и в не на я быть он с что а по это она этот к но они мы весь который".split(),
        "zh": "的 一 是 在 不了 有 和 人 这 中 大 为 上 个 国 我 以 要 他".split(),
        "ar": "في من على أن إلى هذا مع التي كان عن لا هو ما بعد كل قد بين".split(),
        "el": "και το να του η της με που την από για είναι οι στο θα δεν".split(),
    }
    rows, langs = [], {}
    for lang, n in (("en", n_english), ("ru", n_other), ("zh", n_other), ("ar", n_other), ("el", n_other), (None, n_other), ("xx", n_other)):
        for _ in range(n):
            langs[len(rows)] = lang
            rows.append((len(rows), " ".join(rng.choice(common[lang if lang in common else "ru"], 200))))
    return rows, langs


def test_no_language_is_held_against_another(make):
    rows, langs = foreign()
    df = make(rows, langs)
    assert quality_rules(df).where("base_failed or not kept").count() == 0
    assert quality_filter(df).count() == len(rows)
    # With references of their own, texts of another kind under their name are still told apart.
    rows, langs = foreign(120, 120)
    junk = [(10_000 + k, " ".join(f"{k}#{x}$$%%||<{x * 7}>" for x in range(200))) for k in range(3)]
    out = {r["doc_id"]: r["kept"] for r in rows_of(quality_rules(make(rows + junk, langs)))}
    assert not any(out[i] for i, _ in junk) and all(out[i] for i, _ in rows)
    assert sorted((i, v) for i, v, *_ in verdicts_by_hand([(i, t, langs.get(i, "en")) for i, t in rows + junk])) == sorted(out.items())


def test_quality_filter_takes_the_verdict(corpus, odd):
    for df in (corpus, odd):
        kept = Counter(r["doc_id"] for r in rows_of(quality_rules(df)) if r["kept"])
        out = quality_filter(df)
        assert out.columns == df.columns and Counter(r["doc_id"] for r in rows_of(out)) == kept


def test_quality_rules_keep_clean_documents(spark, sf):
    d = sf.replace("0.001", "0.01")
    verdict = quality_rules(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    clean = verdict.where("quality = 1 and not base_failed")
    junk = verdict.where("quality = 0 and not base_failed")
    assert clean.where("kept").count() >= 0.98 * clean.count()
    assert junk.where("not kept").count() >= 0.6 * junk.count()


# Operator 8


def test_lm_base_scores(corpus, odd):
    for df in (corpus.limit(150), odd):
        df = df.persist()
        held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
        rows = [(i, [*SPACE.findall(lower(t)), "\0end"]) for i, t in texts_of(df)]
        c = Counter(w for i, ws in rows if not held(i) for w in ws)
        n, v = sum(c.values()), len(c)
        expected = sorted((str(i), held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 3)) for i, ws in rows)
        out = rows_of(score_corpus(df, sweeps=1))
        got = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 3)) for r in out)
        assert [g[:5] for g in got] == [e[:5] for e in expected]
        assert np.allclose([g[5] for g in got], [e[5] for e in expected], atol=2e-3)
        assert all(r["score"] < 0 for r in out)
        df.unpersist()


def test_lm_beats_the_unigram_model(spark, sf):
    d = sf.replace("0.001", "0.01")
    out = score_corpus(spark.read.parquet(f"{d}/documents.parquet")).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert out["s"] > out["b"]


def class_bigrams(rows, n_classes, sweeps):
    """Brute force: exchange clustering move by move on whole likelihoods, then smoothed scores. Every word is in the exchange."""
    from newsloom.llm.kernels import word_hashes

    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    split = [(i, SPACE.findall(lower(t))) for i, t in rows]
    pairs, c = Counter(), Counter()
    for i, w in split:
        if not held(i):
            pairs.update(zip(["\0end", *w], [*w, "\0end"], strict=True))
            c.update(w)
    hashed = {}
    for w in c:
        raw = np.frombuffer(w.encode(), np.uint8)
        hashed[w] = int(word_hashes(raw, np.array([0]), np.array([len(raw)]))[0])
    rank = {w: k for k, w in enumerate(sorted(c, key=lambda w: (-c[w], hashed[w])))}
    number = {w: k for k, w in enumerate(sorted(c, key=hashed.get))}
    end, size = n_classes + 16, n_classes + 17
    of = {w: rank[w] % n_classes for w in c} | {"\0end": end}

    def table_of(cls):
        table = np.zeros((size, size))
        for (a, b), n in pairs.items():
            table[cls[a], cls[b]] += n
        return table

    def likelihood(cls):
        f = lambda x: sum(v * math.log(v) for v in np.ravel(x) if v > 0)
        t = table_of(cls)
        return f(t) - f(t.sum(0)) - f(t.sum(1))

    best = (likelihood(of), of)
    for sweep in range(sweeps):
        moved = dict(of)
        for w in c:
            if not sweep or number[w] % 2 == sweep % 2:
                gains = [likelihood(of | {w: k}) for k in range(n_classes)]
                top = max(range(n_classes), key=lambda k: round(gains[k], 9))
                if gains[top] > gains[of[w]] + 1e-9:
                    moved[w] = top
        if moved == of:
            break
        of = moved
        if likelihood(of) > best[0]:
            best = (likelihood(of), of)
    of, table = best[1], table_of(best[1])
    ends = sum(not held(i) for i, _ in rows)
    mass, kinds = table.sum(0), Counter(of[w] for w in c) + Counter({end: min(ends, 1)})
    share = [(mass[k] + 0.5) / (mass.sum() + 0.5 * size) for k in range(size)]
    out = []
    for i, w in split:
        score, before = 0.0, end
        for x in [*w, "\0end"]:
            if x in of:
                cls, n = of[x], ends if x == "\0end" else c[x]
            else:  # words never seen stand in the class of their shape, which has no other word here
                last = x.encode()[-1]
                cls, n = n_classes + min((len(x.encode()) - 1) // 2, 7) * 2 + (97 <= last <= 122 or last >= 128), 0
            score += math.log10((table[before, cls] + 50 * share[cls]) / (table[before].sum() + 50))
            score += math.log10((n + 0.5) / (mass[cls] + 0.5 * (kinds[cls] + 1)))
            before = cls
        out.append((str(i), round(score, 6)))
    return sorted(out)


def test_lm_scores(make):
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(14)]
    rows = [(i, " ".join(rng.choice(words, int(rng.integers(0, 12)), p=np.arange(1, 15) / 105))) for i in range(40)] + [(None, "w1 W2"), (3, "unseen w3 é 42")]
    got = sorted((str(r["doc_id"]), round(r["score"], 6)) for r in rows_of(score_corpus(make(rows), max_words=10**6, n_classes=4, sweeps=3)))
    want = class_bigrams(rows, 4, 3)
    assert [g[0] for g in got] == [w[0] for w in want] and np.allclose([g[1] for g in got], [w[1] for w in want], atol=1e-5)


def test_lm_of_nothing(make):
    assert score_corpus(make([])).count() == 0


def test_exchange_gain_is_the_likelihoods():
    from newsloom.llm.class_lm import _likelihood, _tables

    rng = np.random.default_rng(2)
    words, k = 9, 4
    pairs = rng.integers(0, 6, (words + 1, words + 1)).astype(float)  # the last symbol is the end
    classes = np.append(rng.integers(0, k, words), k)

    def views(cls):
        hot = np.eye(k + 1)[cls]
        return pairs @ hot, (pairs.T @ hot), np.diag(pairs).copy()

    for w in range(words):
        after, before, own = views(classes)
        table = _tables(after, classes)
        value = []
        for c in range(k):
            moved = classes.copy()
            moved[w] = c
            value.append(_likelihood(_tables(views(moved)[0], moved)))
        best, gain = best_class(w, classes, table, after, before, own, k)
        assert math.isclose(value[best], max(value), abs_tol=1e-6)
        assert math.isclose(gain, max(value) - value[classes[w]], abs_tol=1e-6)


def test_lm_rare_words_take_the_class_of_their_neighbours(make):
    from newsloom.llm.class_lm import _xlogx, likeliest

    # Against the likelihood itself, with a table that the words are no part of.
    rng = np.random.default_rng(3)
    k, free, size = 7, 4, 30
    table = rng.integers(0, 9, (k, k)).astype(float)
    word = np.concatenate([np.arange(size), rng.integers(0, size, 80)])
    before, after = rng.integers(free, k, len(word)), rng.integers(free, k, len(word))
    best, n = likeliest(np.concatenate([word, word]), np.concatenate([before, k + after]), table, free)
    assert (n == np.bincount(word)).all()
    for w in range(size):
        value = []
        for c in range(free):
            t = table.copy()
            np.add.at(t, (before[word == w], c), 1)
            np.add.at(t, (c, after[word == w]), 1)
            value.append(_xlogx(t).sum() - _xlogx(t.sum(1)).sum() - _xlogx(t.sum(0)).sum())
        assert math.isclose(value[best[w]], max(value), abs_tol=1e-6)
    # Rarer words of one shape, after "aa" or after "bb": a held-out text scores more where they stand as in training.
    texts = [(i, " ".join(f"aa mm cc bb nn dd aa {i:04d}x cc bb {i:04d}y dd" for _ in range(6))) for i in range(1, 900)]
    held = [i for i, _ in texts if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    learned = [(i, t) for i, t in texts if zlib.crc32(str(i).encode()) % 5 != 1]
    some = [i for i, _ in learned][::20]
    right, wrong = (" ".join(f"{a} {i:04d}x {b} {c} {i:04d}y {d}" for i in some) for a, b, c, d in (("aa", "cc", "bb", "dd"), ("bb", "dd", "aa", "cc")))
    out = {r["doc_id"]: r for r in rows_of(score_corpus(make([*learned, (held[0], right), (held[1], wrong)]), max_words=1000, n_classes=8))}
    assert math.isclose(out[held[0]]["base_score"], out[held[1]]["base_score"])
    assert out[held[0]]["score"] > out[held[1]]["score"] + len(some)


# Operator 10


def test_quality_classifier(spark, sf):
    d = sf.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = quality_classifier(docs, labels)
    assert out.count() == docs.count()
    held = rows_of(out.join(labels, "doc_id").where("held_out"))
    right = sum(r["predicted"] == r["quality"] for r in held)
    assert right >= 0.95 * len(held)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in held)


def test_quality_classifier_of_odd_rows(odd, spark, make):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (7, 0), (8, 1), (9, None), (11, 0), (None, 1), (1, 1)], "doc_id long, quality int")
    out = rows_of(quality_classifier(odd, labels))
    assert len(out) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)
    assert {r["score"] for r in rows_of(quality_classifier(odd, labels.limit(0)))} == {0.5}
    assert quality_classifier(make([]), labels).count() == 0


def features_by_hand(text):
    from newsloom.llm.quality_rules import COMMON

    raw, w = (text or "").encode(), SPACE.findall(text or "")
    n, size = len(w), len(raw)
    odds = lambda part, whole: (lambda p: math.log(p / (1 - p + 1e-9)))((part + 0.5) / (whole + 1.0))
    punctuation, symbols = set(b"!\"'(),-./:;?@[\\]^_`{}~+="), set(b"#*$%&|<>")
    kinds = Counter(0 if 97 <= b < 123 else 1 if 65 <= b < 91 else 2 if 48 <= b < 58 else 3 if b in b" \t\n\x0b\x0c\r" else 4 if b in punctuation else 5 if b in symbols else 6 if b >= 128 else 7 for b in raw)
    common = {f for ws in COMMON.values() for x in ws for f in (x, x.capitalize())}
    _, _, _, dup, repeat, _ = counts(text)
    lines = raw.count(b"\n") + 1
    return [
        math.log1p(n),
        math.log1p(sum(len(x.encode()) for x in w) / max(n, 1)),
        *[odds(kinds[k], size) for k in range(8)],
        odds(raw.count(b"|"), n),
        odds(repeat, n),
        odds(len(set(w)), n),
        odds(sum(x in common for x in w), n),
        odds(dup, lines),
        math.log1p(size / lines),
        odds(sum("A" <= x[0] <= "Z" for x in w), n),
    ]


def test_quality_scores(spark, corpus, odd):
    """The discriminant by the textbook: inverse covariances and determinants."""
    labels = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality").collect()]
    some = [(1, 1), (2, 0), (3, 1), (7, 0), (8, 1), (9, None), (11, 0), (None, 1), (1, 1), (12, 0), (4, 1)]
    for df, known in ((corpus, labels), (odd, some)):
        rows = [(i, np.array(features_by_hand(t))) for i, t in texts_of(df)]
        held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        learned = {y: np.array([x for i, x in rows for j, q in known if i is not None and i == j and q == y and not held(i)]) for y in (0, 1)}
        n = {y: len(x) for y, x in learned.items()}
        cov = {y: np.cov(x.T, bias=True) for y, x in learned.items()}
        pooled = sum(n[y] * cov[y] for y in (0, 1)) / sum(n.values())
        scale = np.sqrt(np.maximum(np.diag(pooled), 1e-9))
        density = {}
        for y in (0, 1):
            own = (0.98 * (0.9 * cov[y] + 0.1 * pooled)) / np.outer(scale, scale) + 0.02 * np.eye(len(scale))
            inverse, size = np.linalg.inv(own), np.linalg.slogdet(own)[1]
            mean = learned[y].mean(0)
            density[y] = lambda x, m=mean, a=inverse, s=size, d=scale: -0.5 * ((x - m) / d) @ a @ ((x - m) / d) - 0.5 * s
        want = sorted((str(i), float(1 / (1 + np.exp(-np.clip(0.5 * (density[1](x) - density[0](x)) + math.log(n[1] / n[0]), -500, 500))))) for i, x in rows)
        out = rows_of(quality_classifier(df, spark.createDataFrame(known, "doc_id long, quality int")))
        got = sorted((str(r["doc_id"]), r["score"]) for r in out)
        assert [g[0] for g in got] == [w[0] for w in want] and np.allclose([g[1] for g in got], [w[1] for w in want], atol=5e-3)
        assert all(r["predicted"] == (r["score"] >= 0.3) for r in out)


# Stored tables


def test_two_threads_keep_their_tables(near, spark):
    from concurrent.futures import ThreadPoolExecutor

    from newsloom.llm import frames

    def run(op):
        with frames.recorded() as made:
            n = len(rows_of(op(near)))
        return n, made

    with ThreadPoolExecutor(2) as pool:
        (a, left), (b, right) = pool.map(run, (substring_dedup, jaccard_join))
    assert a == b == near.count() and left and right and not set(left) & set(right)
    frames.delete(spark, [*left, *right])


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from newsloom.llm import frames

    class Context:
        master = "yarn"

    class Session:
        conf = {}
        sparkContext = Context()

    with pytest.raises(ValueError, match="checkpoint"):
        frames.shared_folder(Session())
