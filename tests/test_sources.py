import random
import re

import pytest
from pyspark.sql import functions as F

from newsloom.plans.queries import QUERIES
from newsloom.sources import cache, digest, documents, enrich, fetch, taxonomy


def test_taxonomy_terms(spark, tmp_path):
    rows = [(3, 1, taxonomy.encode_text('"cyber attack"')), (3, 2, taxonomy.encode_text(" ransomware")), (4, 1, "1.15897E+14"), (5, 1, "")]
    path = tmp_path / "t.csv"
    path.write_text("ANY_ID,SEARCH_TERM_ID,ENCODED_TERMS\n" + "\n".join(",".join(map(str, r)) for r in rows))
    terms = taxonomy.read_taxonomy(spark, str(path))
    got = {r["RISK_ID"]: (r["label"], r["terms"]) for r in taxonomy.risk_map(terms).collect()}
    assert got == {3: ("cyber attack", ["cyber attack", "ransomware"])}
    assert taxonomy.undecodable(spark.read.option("header", True).csv(str(path))).first()[0] == 2


DIGEST = """FINRA in the News

JDSupra, September 30, 2026

Firm fined for lapses (Paywalled)
By Jane Roe
The firm paid.
It agreed.
Read article online

Also:
Firm pays – Barron’s (By A B) (Paywalled)
Second item - Wire
Related:
Third item
Markets
Reuters, Oct 1, 2026
Stocks rise
Back to index
Stray line
Reuters, Oct 2, 2026
"""


def test_digest(spark):
    got = digest.parse_digests(spark.createDataFrame([(DIGEST,), (None,), ("",)], "text string")).collect()
    assert [(r["title"], r["source"], r["date"], r["section"], r["paywalled"], r["primary"]) for r in got] == [
        ("Firm fined for lapses", "JDSupra", "2026-09-30", "FINRA in the News", True, True),
        ("Firm pays", "Barron’s", "2026-09-30", "FINRA in the News", True, False),
        ("Second item", "Wire", "2026-09-30", "FINRA in the News", False, False),
        ("Third item", "", "2026-09-30", "FINRA in the News", False, False),
        ("Stocks rise", "Reuters", "2026-10-01", "Markets", False, True),
    ]
    assert got[0]["summary"] == "The firm paid. It agreed." and got[0]["byline"] == "Jane Roe"


def test_structured_rows(spark, tmp_path):
    (tmp_path / "s.csv").write_text('Headline,Publication,DATE,url,Paywalled\n"A, b",Wire,"Mar 5, 2024",http://x,Yes\n,Wire,,,\nC,,soon,,0\n')
    got = digest.read_structured(spark, str(tmp_path / "s.csv")).orderBy("title").collect()
    assert [(r["title"], r["source"], r["date"], r["link"], r["paywalled"]) for r in got] == [("A, b", "Wire", "2024-03-05", "http://x", True), ("C", "", "", "", False)]


def test_listing_dates(spark):
    html = '<a href="/a">x</a><time datetime="2024-01-02T">..</time><a href="/b">x</a><a href="/a">x</a><time class="y" datetime="2024-03-04"><a href="/c">'
    df = spark.createDataFrame([(1, html), (2, ""), (3, None)], "doc int, html string")
    got = documents.dated_links(df, r'<a href="(/[^"]*)"').orderBy("pos").collect()
    assert [(r["link"], r["date"]) for r in got] == [("/a", ""), ("/b", "2024-01-02"), ("/c", "2024-03-04")]


def actions(text):
    heads = list(re.finditer(documents.CASE_HEADER, text))
    out = []
    for h, end in zip(heads, [*(m.start() for m in heads[1:]), len(text)], strict=True):
        body = " ".join(text[h.start() : end].split())
        sections = re.findall(documents.SECTION_HEADER, text[: h.start()])
        if len(body) >= documents.MIN_ACTION:
            out.append((" ".join(h[1].split()), len(body), sections[-1] if sections else "disciplinary action"))
    return out


def test_actions(spark, sf):
    text = "Intro\nFirms Fined\nAcme Co (CRD #12, Rome) " + "did bad things. " * 10 + "\nIndividuals Barred\nJohn Roe (CRD #3,456, NY) " + "lied. " * 30 + "Tiny Co (CRD #9, X) short"
    got = documents.split_actions(spark.createDataFrame([(1, text)], "doc int, text string")).orderBy("pos").collect()
    assert [(r["name"], len(r["body"]), r["section"]) for r in got] == actions(text)
    out = QUERIES["action_split"](spark, sf).collect()
    assert out and all(r["title"].startswith(r["name"][:50]) and len(r["title"]) <= 180 for r in out)
    assert {r["section"] for r in out} <= {"Firms Fined", "disciplinary action"}


def test_action_split_reads_every_customer(spark, sf):
    d = sf.replace("0.001", "0.01")
    n = spark.read.parquet(f"{d}/customer.parquet").count()
    assert n > 1200 and len(QUERIES["action_split"](spark, d).collect()) > n / 2


def factors(text):
    parts = re.split(r"\n\s*\n+", text)
    if len(parts) < 3:
        parts = re.split(documents.FACTOR_START, text)
    clean = [" ".join(p.split()) for p in parts]
    return [(k, len(p[:4000])) for k, p in enumerate(clean) if len(p) >= 200]


def test_factors(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {(r["doc_id"], k, n) for r in docs for k, n in factors(r["text"].replace("\n", "\n\n"))}
    assert {(r["filing"], r["seq"], r["n"]) for r in QUERIES["factor_split"](spark, sf).collect()} == want


def test_factors_start_where_a_repeated_group_would(spark):
    """The same places as with a group for each word, and a run of 30,000 words without a stop."""
    nested = r"(?<=[.])\s+(?=[A-Z][a-z]+(?:\s+\w+){2,}\s+(?:could|may|would|risk|adversely|our|we|the))"
    draw = random.Random(5)
    for _ in range(20000):
        text = "".join(draw.choice([". ", ".  The", "Firm", " a", " bc", "  ", " may", " risks", "the ", "\n", ",", "X", " we1"]) for _ in range(draw.randint(2, 14)))
        assert re.split(documents.FACTOR_START, text, flags=re.ASCII) == re.split(nested, text, flags=re.ASCII)
    text = "It is so. The" + " word" * 30000 + " may fail. Our plan is one that could fail."
    rows = documents.factors(spark.createDataFrame([("a", text)], "filing string, text string")).collect()
    assert [(r["seq"], len(r["text"])) for r in rows] == [(1, documents.MAX_FACTOR)]


def test_factors_are_whole(spark):
    """However long: paragraphs, a run of sentences, and a first sentence that is the whole factor."""
    long = " ".join(f"Word{k} may fail." for k in range(2000))
    rows = documents.factors(spark.createDataFrame([(1, f"{long}\n\nShort.\n\n  {'x' * 9000}\n{'y' * 300} "), (2, "z" * 5000)], "filing int, text string")).collect()
    assert {(r["filing"], r["seq"]): r["text"] for r in rows} == {(1, 0): long, (1, 2): "x" * 9000 + " " + "y" * 300, (2, 0): "z" * 5000}
    run = "The" + " word" * 30000 + " may fail."
    rows = documents.factors(spark.createDataFrame([(1, f"It is so. {run} Our plan is one that could fail.")], "filing int, text string")).collect()
    assert [(r["seq"], r["text"]) for r in rows] == [(1, run)]


def test_factor_split_measures_whole_factors(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {}
    for r in docs:
        parts = re.split(r"\n\s*\n+", r["text"].replace("\n", "\n\n"))
        parts = parts if len(parts) >= 3 else re.split(documents.FACTOR_START, r["text"].replace("\n", "\n\n"))
        want |= {(r["doc_id"], k): len(" ".join(p.split())) for k, p in enumerate(parts) if len(" ".join(p.split())) >= 200}
    assert {(r["filing"], r["seq"]): r["n"] for r in QUERIES["factor_split"](spark, sf).collect()} == want and max(want.values()) > 4000


def test_release_texts(spark):
    get = lambda c, t: spark.createDataFrame([(t,)], "t string").select(c(F.col("t")).alias("x")).first()["x"]
    facts = "The respondent sold notes. " * 20
    assert get(documents.order_body, "UNITED STATES ORDER x I. a II. b III. " + facts) == facts.strip()
    assert get(documents.order_body, "UNITED STATES ORDER x I. " + facts[:260]) == facts[:260].strip()
    assert get(documents.order_body, "short") == "short"
    assert get(documents.release_body, "Roe Litigation Release No. 25 / May 1, 2024 SEC v. Roe, filed (D.N.J. 2024) SEC Charges Roe. On") == "SEC Charges Roe. On"
    assert spark.range(1).select(documents.release_title(F.lit("x SEC Charges Roe with fraud. On"), F.lit("Roe"))).first()[0] == "SEC Charges Roe with fraud"
    assert get(documents.scrubbed, "The Commission finds , that defendants paid disgorgement .") == ", that paid."


def test_fetch_retries_and_permanent_errors(spark):
    calls, waits = [], []

    def transport(url):
        calls.append(url)
        if url == "gone":
            return 404, b""
        if len(calls) < 3:
            raise OSError("down")
        return 200, b"ok"

    assert fetch.with_retries(transport, "gone", sleep=waits.append) == (404, b"") and len(calls) == 1
    calls.clear()
    assert fetch.with_retries(transport, "x", sleep=waits.append) == (200, b"ok") and waits == [2.0, 4.0]
    got = fetch.fetched(spark.createDataFrame([("a",), ("a",), ("b",)], "url string"), lambda u: (200, u.encode()))
    assert sorted((r["url"], bytes(r["body"])) for r in got.collect()) == [("a", b"a"), ("b", b"b")]


def test_vectors_are_encoded_once(spark, tmp_path):
    path, seen = str(tmp_path / "cache"), []

    def encode(df):
        seen.append(df.count())
        return cache.hashed_embedding(df)

    one = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c")], "i int, text string")
    two = spark.createDataFrame([(4, "c"), (5, "d")], "i int, text string")
    assert cache.encode_cached(one, encode, path, "m").where("vector IS NULL").count() == 0
    assert cache.encode_cached(two, encode, path, "m").count() == 2
    assert seen == [2, 1]


def test_enrichment(spark):
    df = spark.createDataFrame([("The Securities and Exchange Commission cited the Exchange Act of 1934.",), (None,)], "t string")
    got = enrich.with_keywords(enrich.with_entities(df, "t"), "t", ["the", "and", "of"]).collect()
    assert "Exchange Act of 1934" in got[0]["ENTITIES"] and got[1]["ENTITIES"] == []
    assert "securities" in got[0]["NLP_KEYWORDS"]


def test_lane_rows(spark):
    from newsloom.operators.corpus import normalise
    from newsloom.schemas import ARTICLE

    items = spark.createDataFrame([("T", "x" * 5000, "reuters", "2024-01-01", "http://a", None)], "title string, text string, source string, date string, link string, category string")
    row = normalise(items, "EMAIL", "email:", F.lit(-0.2)).first()
    assert list(row.asDict()) == ARTICLE.fieldNames()
    assert (row["RISK_ID"], row["CATEGORY"], row["SENTIMENT"], len(row["SUMMARY"]), row["QUALITY_SCORE"]) == (-1, "email:general", "Negative", 4000, 1.0)


@pytest.mark.parametrize("bad", ["x", "", None, "-5", "255"])
def test_undecodable_numbers(bad):
    assert taxonomy.decode_number(bad) is None


def test_a_digest_of_many_stories_is_streamed(spark):
    """Stories leave in runs, however many one digest has; no batch of digests becomes one pandas table."""
    text = "Markets\nReuters, May 6, 2024\nHead\nAlso:\n" + "\n".join(f"Item {k} - Barron" for k in range(2 * digest.RUN_STORIES + 1))
    out = digest.parse_digests(spark.createDataFrame([(text,), (None,), ("",)], "text string"))
    assert out.count() == out.select("title").distinct().count() == 2 * digest.RUN_STORIES + 2
    assert "Pandas" not in out._jdf.queryExecution().executedPlan().toString()


def test_hashed_embedding_counts_words_in_batches(spark):
    import hashlib
    import math

    rows = [(1, "Ünï one  two-one"), (2, None), (3, ""), (4, " - "), (5, "three 3 three")]
    out = cache.hashed_embedding(spark.createDataFrame(rows, "i int, text string"), size=4)
    for r in out.collect():
        n = [0] * 4
        for w in (r["text"] or "").lower().replace("-", " ").split():
            n[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 4] += 1
        c = [math.log1p(x) for x in n]
        size = math.sqrt(sum(x * x for x in c)) + 1e-9
        assert all(abs(a - b / size) < 1e-6 for a, b in zip(r["vector"], c, strict=True))
    # A word is not hashed place by place in the plan, once for each slot.
    assert "md5" not in out._jdf.queryExecution().optimizedPlan().toString()
