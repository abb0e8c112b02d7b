import pytest
from pyspark.sql import functions as F

# Names that the operators use inside; documents may have columns of the same names.
CLASHING = ["k", "t1", "t2", "_key", "_k", "_kept", "node", "h", "n", "x", "rows", "shard", "part", "label", "ps"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """make([(doc_id, text), ...]): a documents frame with extra columns of clashing names."""

    def build(rows, langs=None, clash=True):
        data = [(i, t, (langs or {}).get(i, "en"), "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(data, SCHEMA)
        return df.withColumns({c: F.lit("clash") for c in CLASHING}) if clash else df

    return build


def odd_rows():
    """Nulls, empty and very long texts, repeated rows, ties."""
    prose = " ".join(f"w{i}" for i in range(70))
    return [
        (1, prose + " alpha beta gamma"),
        (2, prose + " delta"),
        (3, prose + " alpha beta gamma"),
        (4, None),
        (5, ""),
        (6, "  \t\n "),
        (7, "one two"),
        (8, "ünïcode ▁ 日本 \x00 🎉 " + prose),
        (9, " ".join(f"long{i % 997} x{i}" for i in range(20_000))),
        (10, "z" * 100_000),
        (11, "same same " * 300),
        (None, prose + " null id"),
        (None, None),
        (2, prose + " delta"),
        (12, "one two"),
    ]


@pytest.fixture(scope="session")
def odd(make):
    return make(odd_rows())
