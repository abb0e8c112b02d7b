"""The rule of valence lexicons against its published examples, with the published valences of their words."""

import pytest
from pyspark.sql import functions as F

from newsloom.functions.sentiment import Lexicon, compound, read_lexicon

WORDS = {"smart": 1.7, "handsome": 2.2, "funny": 1.9, "good": 1.9, "horrible": -2.5, "great": 3.1, "sux": -1.5, "lol": 1.8, "uncompelling": -0.9}

PUBLISHED = [
    ("VADER is smart, handsome, and funny.", 0.8316),
    ("VADER is smart, handsome, and funny!", 0.8439),
    ("VADER is very smart, handsome, and funny.", 0.8545),
    ("VADER is VERY SMART, handsome, and FUNNY.", 0.9227),
    ("VADER is VERY SMART, handsome, and FUNNY!!!", 0.9342),
    ("VADER is not smart, handsome, nor funny.", -0.7424),
    ("The book was good.", 0.4404),
    ("At least it isn't a horrible book.", 0.431),
    ("The book was only kind of good.", 0.3832),
    ("The plot was good, but the characters are uncompelling and the dialog is not great.", -0.7042),
    ("Today SUX!", -0.5461),
    ("Today only kinda sux! But I'll get by, lol", 0.5249),
]


@pytest.mark.parametrize(("text", "score"), PUBLISHED)
def test_published_examples(text, score):
    assert round(Lexicon(WORDS).compound(text), 4) == score


@pytest.mark.parametrize(
    ("text", "total"),
    [
        ("no good", 1.9 * -0.74),
        ("without doubt good", 1.9),
        ("never so good", (1.9 + 0.293) * 1.25),
        ("least good", 1.9 * -0.74),
        ("at least good", 1.9),
        ("that is the bomb good", 3.0),
        ("good?? really??", 1.9 + 0.96),
        ("good? good??", 3.8 + 3 * 0.18),
        ("hardly good", 1.9 - 0.293),
        ("isn't very good", (1.9 + 0.293) * -0.74),
        ("good good but horrible", 1.9 + -2.5 * 1.5),
        ("nothing here", 0.0),
    ],
)
def test_rules_one_by_one(text, total):
    assert Lexicon(WORDS).compound(text) == pytest.approx(total / (total * total + 15) ** 0.5 if total else 0.0)


def test_lexicon_from_a_table(spark):
    table = spark.createDataFrame([("Good", 1.9), ("good", 3.0), ("SUX", -1.5), (None, 2.0), ("null", None)], "word string, valence double")
    lexicon = read_lexicon(table)
    assert lexicon.valences == {"good": 1.9, "sux": -1.5}
    df = spark.createDataFrame([("The book was good.",), ("Today SUX!",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(compound(F.col("t"), lexicon)).collect()] == [0.4404, -0.5461, 0.0, 0.0]
