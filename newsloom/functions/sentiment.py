"""Lexicon sentiment with a pluggable lexicon.

The rule is the published one for valence lexicons. A word's valence is raised by capitals in a text of mixed
case, by degree words among the three words before it (less the further off they are), and flipped by a
negation there; idioms have a valence of their own. Before a "but" everything weighs half, after it half as
much again. The sum gets what exclamation and question marks add and is squashed to -1..1 by
x / sqrt(x * x + 15). The lexicon is a table of the user's (word, valence); none ships with this package beyond a
few dozen words.
"""

from __future__ import annotations

import string
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the rule.
CAPITALS, FLIP, DEGREE = 0.733, -0.74, 0.293
FADING = (1.0, 0.95, 0.9)
NEGATIONS = frozenset(
    "aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't hadn't hasn't haven't isn't mightn't mustn't "
    "neednt needn't never none nope nor not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent oughtn't shan't shouldn't uh-uh wasn't weren't without wont wouldnt won't wouldn't rarely seldom despite".split()
)
MORE = (
    "absolutely amazingly awfully completely considerable considerably decidedly deeply enormous enormously entirely especially exceptional exceptionally extreme extremely fabulously fully greatly hella highly hugely "
    "incredible incredibly intensely major majorly more most particularly purely quite really remarkably so substantially thoroughly total totally tremendous tremendously uber unbelievably unusually utter utterly very"
)
LESS = "almost barely hardly kinda kindof kind-of less little marginal marginally occasional occasionally partly scarce scarcely slight slightly somewhat sorta sortof sort-of"
LESS_PAIRS = ("just enough", "kind of", "sort of")
BOOSTERS = dict.fromkeys(MORE.split(), DEGREE) | dict.fromkeys(LESS.split(), -DEGREE)
IDIOMS = {
    "the bomb": 3.0, "bus stop": 0.0, "yeah right": -2.0, "kiss of death": -1.5, "to die for": 3.0, "beating heart": 3.1, "broken heart": -2.9, "cut the mustard": 2.0, "hand to mouth": -2.0, "back handed": -2.0,
    "blow smoke": -2.0, "upper hand": 1.0, "break a leg": 2.0, "cooking with gas": 2.0, "in the black": 2.0, "in the red": -2.0, "on the ball": 2.0, "under the weather": -2.0,
}
MAX_WORDS = 200_000


def _word(token: str) -> str:
    """Without punctuation around it, unless next to nothing would be left."""
    bare = token.strip(string.punctuation)
    return bare if len(bare) > 2 else token


@dataclass
class Lexicon:
    valences: dict[str, float] = field(default_factory=lambda: dict(DEFAULT))
    idioms: dict[str, float] = field(default_factory=lambda: dict(IDIOMS))

    def _degree(self, word: str, valence: float, mixed: bool) -> float:
        step = BOOSTERS.get(word.lower(), 0.0)
        if step and valence < 0:
            step = -step
        if step and mixed and word.isupper():
            step += CAPITALS if valence > 0 else -CAPITALS
        return step

    def _flipped(self, lows: list[str], i: int, back: int) -> float:
        """What the word `back` places before word i does to its sign and size."""
        word, between = lows[i - back], lows[i - back + 1 : i]
        if back > 1 and word == "never" and any(w in ("so", "this") for w in between):
            return 1.25
        if back > 1 and word == "without" and between[0] == "doubt":
            return 1.0
        return FLIP if word in NEGATIONS or "n't" in word else 1.0

    def _idiom(self, lows: list[str], i: int) -> float | None:
        """The valence of an idiom of two or three words that begins with word i, or lies in it and the three before it."""
        spans = [(i, i + 3), (i, i + 2), *[(j, j + n) for j in range(i - 3, i) for n in (2, 3) if j + n <= i + 1]]
        found = [self.idioms.get(" ".join(lows[a:b])) for a, b in spans if b <= len(lows)]
        return next((v for v in found if v is not None), None)

    def _valence(self, words: list[str], lows: list[str], i: int, mixed: bool) -> float:
        v = self.valences.get(lows[i], 0.0)
        if not v or lows[i] in BOOSTERS or " ".join(lows[i : i + 2]) == "kind of":
            return 0.0
        if lows[i] == "no" and i + 1 < len(lows) and lows[i + 1] in self.valences:
            return 0.0  # it only flips the word after it
        if "no" in lows[max(i - 2, 0) : i] or (i > 2 and lows[i - 3] == "no" and lows[i - 1] in ("or", "nor")):
            v *= FLIP
        if mixed and words[i].isupper():
            v += CAPITALS if v > 0 else -CAPITALS
        for back, fade in enumerate(FADING, 1):
            if i < back or lows[i - back] in self.valences:
                continue
            v = (v + self._degree(words[i - back], v, mixed) * fade) * self._flipped(lows, i, back)
        if i > 2 and lows[i - 3] not in self.valences:
            idiom = self._idiom(lows, i)
            v = v if idiom is None else idiom
            v -= DEGREE * sum(" ".join(lows[j : j + 2]) in LESS_PAIRS for j in (i - 3, i - 2))
        if i and lows[i - 1] == "least" and "least" not in self.valences and (i < 2 or lows[i - 2] not in ("at", "very")):
            v *= FLIP
        return v

    def compound(self, text: str | None) -> float:
        text = text or ""
        words = [_word(t) for t in text.split()]
        lows = [w.lower() for w in words]
        loud = sum(w.isupper() for w in words)
        each = [self._valence(words, lows, i, 0 < loud < len(words)) for i in range(len(words))]
        if "but" in lows:
            turn = lows.index("but")
            each = [v * (0.5 if i < turn else 1.5 if i > turn else 1.0) for i, v in enumerate(each)]
        total = sum(each)
        asked = text.count("?")
        marks = min(text.count("!"), 4) * 0.292 + (0 if asked < 2 else asked * 0.18 if asked < 4 else 0.96)
        if not total:
            return 0.0
        total += marks if total > 0 else -marks
        return max(-1.0, min(1.0, total / (total * total + 15) ** 0.5))


DEFAULT = {
    "good": 1.9, "great": 3.1, "gain": 1.4, "gains": 1.4, "growth": 1.6, "strong": 2.3, "win": 2.8, "success": 2.7, "improve": 1.9, "improved": 2.1, "benefit": 2.0, "safe": 1.9, "profit": 1.9, "positive": 2.6,
    "bad": -2.5, "loss": -1.3, "losses": -1.7, "fraud": -2.8, "risk": -1.1, "crisis": -3.1, "fail": -2.5, "failed": -2.3, "failure": -2.3, "threat": -2.4, "warn": -0.4, "warns": -0.4, "weak": -1.9, "decline": -1.4, "negative": -2.7, "scheme": -1.0, "penalty": -2.0, "breach": -1.8,
}


def read_lexicon(table: DataFrame, word="word", valence="valence") -> Lexicon:
    """The lexicon of a table; of a word given twice the valence of smallest size. It travels to the tasks, so its size is checked."""
    rows = table.groupBy(F.lower(F.col(word)).alias("w")).agg(F.min_by(F.col(valence).cast("double"), F.abs(valence)).alias("v")).where("w is not null and v is not null").limit(MAX_WORDS + 1).collect()
    if len(rows) > MAX_WORDS:
        raise ValueError(f"a lexicon has {MAX_WORDS} words at most")
    return Lexicon({r["w"]: r["v"] for r in rows})


def compound(text: Column, lexicon: Lexicon | None = None) -> Column:
    """Through a pandas UDF; the lexicon travels with it, so keep it small."""
    known = lexicon or Lexicon()

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(known.compound).astype(float).round(4)

    return score(text)
