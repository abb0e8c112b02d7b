import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.functions.quality import quality_score, with_quality
from newsloom.functions.sentiment import Lexicon, compound
from newsloom.functions.vectors import mean_vectors
from newsloom.schemas import ARTICLE, with_defaults


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) if v is not None else F.lit(None).cast("string").alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


LONG = "x" * 130


@pytest.mark.parametrize(
    ("title", "summary", "source", "expected"),
    [
        ("SEC charges firm in $50M fraud scheme", LONG, "reuters", 1.0),
        ("AP Trending SummaryBrief at 9:24 p.m. EDT", "", "menafn", 0.0),
        ("PW Consulting: Metal Aerosol Can Market Hits $132.08M in 2025, Forecast 3.9% CAGR", "", "globenewswire", 0.0),
        ("Coda Octopus (CODA) Q3 2026 Earnings Call Transcript", "Operator: Welcome to the call.", "fool", 0.35),
        (None, None, None, 0.7),
        ("A title", "A legal disclaimer of some kind", "Reuters", 0.6),
    ],
)
def test_quality(spark, title, summary, source, expected):
    assert one(spark, F.round(quality_score(), 3), TITLE=title, SUMMARY=summary, SOURCE=source) == expected


def test_quality_is_recomputed_when_it_says_nothing(spark):
    df = spark.createDataFrame([("t", "", "fool", 0.0), ("t", LONG, "reuters", 0.0)], "TITLE string, SUMMARY string, SOURCE string, QUALITY_SCORE double")
    assert sorted(r["QUALITY_SCORE"] for r in with_quality(df).collect()) == [0.55, 1.0]
    some = df.withColumn("QUALITY_SCORE", F.when(F.col("SOURCE") == "fool", 0.2))
    assert sorted(r["QUALITY_SCORE"] for r in with_quality(some).collect()) == [0.0, 0.2]


@pytest.mark.parametrize(("url", "slug"), [("https://www.x.com/a", "x.com"), ("https://news.x.com/a", "x"), ("http://a.b.co.uk/", "co"), ("http://x.com:80/", "x.com:80")])
def test_source_slug(spark, url, slug):
    assert one(spark, X.source_slug("u"), u=url) == slug


@pytest.mark.parametrize(("text", "day"), [("March 5, 2024", "2024-03-05"), ("Mar 5, 2024", "2024-03-05"), ("2024-03-05", "2024-03-05"), ("soon", None), ("", None)])
def test_dates(spark, text, day):
    got = one(spark, X.parse_date("t"), t=text)
    assert (got and str(got)) == day


def test_text_functions(spark):
    assert one(spark, X.document_text("a", "b"), a=" A  b", b=None) == "A b."
    assert one(spark, X.normal_title("t"), t="  Big News - The Daily | x ") == "big news"
    assert one(spark, X.normal_phrase("t"), t="The SEC ") == "sec"
    assert one(spark, X.clean_string("t"), t=" NaN ") == ""
    assert one(spark, X.page_title("h"), h="<title>Firm fined | SEC.gov</title><h1>Release Number 8-24</h1>") == "Firm fined"
    assert one(spark, X.page_title("h"), h="<h1>A <b>&amp; B</b></h1>") == "A & B"
    assert one(spark, X.title_case("t"), t="ai risk in 5g us") == "AI Risk In 5g US"
    assert one(spark, X.relevance_band(F.lit(0.15))) == "moderate"
    assert one(spark, X.json_safe("t"), t="</script>") == "<\\/script>"
    assert one(spark, X.mapped("t", X.MOJIBAKE), t="SECÕs Ò\x89x") == "SEC's \"x"
    assert one(spark, X.slug_title("t"), t="https://a.b/news/firm-fined_again.html") == "Firm Fined Again"
    assert one(spark, X.spoken_list(F.array(*map(F.lit, "abc")))) == "a, b and c"
    words = spark.createDataFrame([([],), (["a"],), (["a", "b"],)], "w array<string>")
    assert [r[0] for r in words.select(X.spoken_list("w")).collect()] == ["", "a", "a and b"]
    assert one(spark, X.unescape(F.lit("&eacute;&amp;"))) == "é&"
    assert X.last_days_path("out/a.csv", 30) == "out/a_last30d.csv" and X.look_back_days(6) == 182


def subsumed(words, limit=5):
    kept = []
    for w in (w.strip() for w in words):
        if not w or any(w.lower() == k.lower() for k in kept):
            continue
        if any(w.lower() in k.lower() or k.lower() in w.lower() for k in kept):
            kept = [w if k.lower() in w.lower() and len(w) > len(k) else k for k in kept]
            continue
        kept.append(w)
        if len(kept) >= limit:
            break
    out = []
    for k in kept:
        if k.lower() not in [o.lower() for o in out]:
            out.append(k)
    return out


def test_distinct_keywords(spark, sf):
    cases = [["ponzi", "ponzi scheme", "scheme", "Bank"], ["a b", "b", "c", "C", "d", "e", "f", "g"], [], ["x", "", "xy", "xyz"]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, w array<string>")
    assert [r["x"] for r in df.select("i", X.distinct_keywords("w").alias("x")).orderBy("i").collect()] == [subsumed(c) for c in cases]
    from newsloom.plans.queries import QUERIES, doc_articles

    words = F.split(F.regexp_replace(F.lower("text"), "[^a-z ]", ""), " +")
    want = {r["seq"]: ",".join(subsumed(r["w"])) for r in doc_articles(spark, sf).select("seq", words.alias("w")).collect()}
    assert {r["seq"]: r["keywords"] for r in QUERIES["distinct_keywords"](spark, sf).collect()} == want


def test_sentiment(spark):
    lexicon = Lexicon()
    assert lexicon.compound("great growth") > 0.05 > -0.05 > lexicon.compound("a fraud and a loss")
    assert lexicon.compound("great but a loss") < lexicon.compound("great, a loss") < lexicon.compound("loss but great")
    assert lexicon.compound("not good") < 0 and lexicon.compound(None) == 0.0
    assert one(spark, X.sentiment_label(compound(F.lit("great growth")))) == "Positive"


@settings(max_examples=50, deadline=None)
@given(st.text())
def test_compound_is_bounded(text):
    assert -1 <= Lexicon().compound(text + " great fraud") <= 1


def test_defaults(spark):
    df = with_defaults(spark.createDataFrame([("t", "7", 1)], "title string, risk_id string, more int"))
    assert df.schema.fieldNames() == [*ARTICLE.fieldNames(), "more"]
    assert df.first()["RISK_ID"] == 7 and df.first()["LINK"] is None


def test_mean_vectors_are_unit(spark):
    df = spark.createDataFrame([(1, [3.0, 0.0]), (1, [0.0, 4.0]), (2, [0.0, 0.0])], "g int, v array<double>")
    got = {r["g"]: r["centroid"] for r in mean_vectors(df, ["g"], "v").collect()}
    assert got[1] == pytest.approx([0.6, 0.8], abs=1e-6) and got[2] == [0.0, 0.0]


def test_title_keywords_need_no_shuffle(spark):
    rows = [(1, "beta Alpha beta gamma, alpha delta-beta"), (2, None), (3, ""), (4, "abc one éclair zwölf"), (5, "aaaa bbbb cccc dddd eeee ffff ffff")]
    out = X.title_keywords(spark.createDataFrame(rows, "seq long, text string"), "seq", "text", 3)
    want = {1: ["beta", "alpha", "gamma"], 2: [], 3: [], 4: ["clair"], 5: ["ffff", "aaaa", "bbbb"]}
    assert {r["seq"]: r["keywords"] for r in out.collect()} == want
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
