"""The sequence model against enumeration and held-out sentences."""

import itertools
import random

import numpy as np
import pytest

from newsloom.sources import tagging as T
from newsloom.sources.enrich import with_entities

SCHEMA = "tokens array<string>, tags array<string>"
ORGS = ["Acme Bank", "Zentra Group", "Orbit", "First Harbor Trust", "Nordlys Capital", "Vexon Labs"]
PEOPLE = ["Ann Weber", "Omar Diaz", "Li Chen", "Kofi Mensah", "Eva Novak"]


def sentence(rng, orgs=ORGS, people=PEOPLE):
    """Words and BIO tags."""
    form = rng.choice(["{P} of {O} was charged with fraud .", "Regulators fined {O} and {O} last week .", "The board of {O} named {P} as chair .", "{O} paid 5000 dollars , said {P} ."])
    words, tags = [], []
    for part in form.split():
        name, label = (rng.choice(orgs), "ORG") if part == "{O}" else (rng.choice(people), "PERSON") if part == "{P}" else (part, None)
        for k, w in enumerate(name.split()):
            words.append(w)
            tags.append("O" if label is None else f"{'I' if k else 'B'}-{label}")
    return words, tags


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    return spark.createDataFrame([sentence(rng) for _ in range(300)] + [(["odd"], ["O", "O"]), ([], []), (None, None), (["x"], [None])], SCHEMA)


def likelihood(m, words, tags):
    at = [m.tags.index(t) for t in tags]
    return m.start[at[0]] + sum(m.step[a, b] for a, b in itertools.pairwise(at)) + sum(m.emission(w)[k] for w, k in zip(words, at, strict=True))


def test_viterbi_is_the_best_of_all(labelled):
    model = T.fit(labelled)
    rng = random.Random(2)
    for _ in range(12):
        words = rng.choices(["Acme", "Bank", "fined", "Unseen", "of", ".", "Ann", "42"], k=rng.randint(1, 5))
        best = max(likelihood(model, words, tags) for tags in itertools.product(model.tags, repeat=len(words)))
        assert abs(likelihood(model, words, model.decode(words)) - best) < 1e-9
    assert model.decode([]) == []


def test_held_out_names(labelled):
    """Sentences with names the model has never seen."""
    model = T.fit(labelled)
    rng = random.Random(3)
    right = total = 0
    for _ in range(200):
        words, tags = sentence(rng, [*ORGS, "Kestrel Bank", "Umbra"], [*PEOPLE, "Ida Roth", "Juan Perez"])
        got = model.decode(words)
        right += sum(g == t for g, t in zip(got, tags, strict=True))
        total += len(tags)
    assert right / total > 0.95


def test_chances_are_chances(labelled):
    model = T.fit(labelled)
    assert np.allclose(np.exp(model.step).sum(1), 1) and np.isclose(np.exp(model.start).sum(), 1)


def test_saved_and_loaded(spark, labelled, tmp_path):
    T.save(labelled, str(tmp_path / "m"))
    a, b = T.fit(labelled), T.load(spark, str(tmp_path / "m"))
    assert a.tags == b.tags and np.array_equal(a.step, b.step) and set(a.words) == set(b.words) and all(np.array_equal(a.words[w], b.words[w]) for w in a.words)


def test_entities_of_texts(spark, labelled):
    names = spark.createDataFrame([("New York", "GPE"), ("New York City", "GPE"), ("Oslo", "GPE")], "name string, label string")
    model = T.fit(labelled, names)
    rows = [(1, "Ann Weber of Acme Bank was charged with fraud.  Regulators fined Orbit and Zentra Group last week."), (2, "It moved to New York City, not Oslo."), (3, None), (4, ""), (5, "x " * 20_000)]
    out = {r["k"]: r["ENTITIES"] for r in with_entities(spark.createDataFrame(rows, "k int, t string"), "t", T.model_tagger(model)).collect()}
    assert out[1] == ["Acme Bank", "Orbit", "Zentra Group", "Ann Weber"]
    assert out[2][:2] == ["New York City", "Oslo"] and out[3] == [] and out[4] == []


def test_nothing_to_learn_from(spark, labelled):
    model = T.fit(labelled.limit(0))
    assert model.decode(["a", "b"]) == ["O", "O"] and T.tagged_spans(model, "Acme Bank.") == []


def automaton(tags):
    """Brute force: a phrase is (adjective or number)* noun+ as far as it reaches."""
    import re

    code = "".join({"ADJ": "a", "NUM": "a", "NOUN": "n", "PROPN": "n"}.get(t, "x") for t in tags)
    return [m.span() for m in re.finditer("a*n+", code)]


def test_noun_phrases():
    rng = random.Random(4)
    for _ in range(300):
        tags = rng.choices(["DET", "ADJ", "NUM", "NOUN", "PROPN", "VERB", "PRON", "ADP"], k=rng.randint(0, 12))
        words = [f"W{k}" for k in range(len(tags))]
        assert T.noun_phrases(words, tags) == [" ".join(words[a:b]).lower() for a, b in automaton(tags)]


def test_noun_phrases_of_texts(spark):
    rows = [("the new rule hurts small banks .".split(), "DET ADJ NOUN VERB ADJ NOUN PUNCT".split()), ("banks fear a big fine .".split(), "NOUN VERB DET ADJ NOUN PUNCT".split()), ("it fined Acme Bank .".split(), "PRON VERB PROPN PROPN PUNCT".split())] * 5
    model = T.fit(spark.createDataFrame(rows, SCHEMA))
    df = spark.createDataFrame([("The small banks fear a new rule. the new rule hurts Acme Bank.",), (None,)], "t string")
    out = [r["NLP_KEYWORDS"] for r in T.with_noun_phrases(df, "t", model).collect()]
    assert out == [["small banks", "new rule", "acme bank"], []]


def test_every_token_is_kept(spark):
    assert [[w for w, _, _ in s] for s in T.sentences("A b-c d's, 3.5! Next?  ")] == [["A", "b-c", "d's", ",", "3.5", "!"], ["Next", "?"]]
