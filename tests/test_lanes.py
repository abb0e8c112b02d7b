"""Lanes, versions, resumable fetching, merged topics: what no query over the test tables can show."""

import os
import re
import shutil

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from newsloom.functions.vectors import against, nearest
from newsloom.operators import corpus, gaps, topics
from newsloom.plans.queries import QUERIES
from newsloom.sources import cache, fetch, lanes, stages
from newsloom.sources.documents import report_pages
from newsloom.sources.enrich import entity_lists, pattern_tagger
from newsloom.streaming import events as S


def test_scan_stops_at_errors_pages_and_short_pages():
    def transport(url):
        return (200, b'{"results": [{"link": "a"}, {"link": "b"}], "nextPage": "x"}') if "page" not in url else (200, b"no json")

    assert lanes.pages_of("u?q=1", transport, None, 10, 2, 1) == ([{"link": "a"}, {"link": "b"}], 2)
    assert lanes.pages_of("u?q=1", transport, None, 10, 3, 1)[1] == 1  # fewer than a page: the last one
    assert lanes.pages_of("u?q=1", transport, 1, None, None, 1)[1] == 1
    assert lanes.pages_of("u?q=1", transport, None, 1, 2, 1) == ([{"link": "a"}], 1)
    assert lanes.pages_of("u", lambda u: (404, b""), None, 10, 2, 1) == ([], 1)


@pytest.mark.parametrize(("pages", "rows", "size"), [(None, 10, 3), (2, None, None), (None, None, 2), (None, 4, None)])
def test_stored_answers_give_what_requests_give(spark, tmp_path, pages, rows, size):
    """Pages by token, short pages, pages that fail or are no JSON, scans without an answer; taken up again after a stop."""
    import json
    import random

    rng = random.Random(3)
    answers = {}
    for q in range(12):
        url = f"http://api?q={q}"
        for page in range(rng.randint(0, 5)):
            items = [{"title": f"{q}.{page}.{k}", "link": f"http://l/{q}/{page}/{k}", "description": rng.choice([None, "", "text"]), "content": rng.choice([None, "more"]), "source_id": rng.choice([None, "wire"])} for k in range(rng.choice([0, 1, 2, 3, 3, 3]))]
            body = json.dumps({"results": items, "nextPage": f"t{page + 1}"}) if rng.random() < 0.9 else "no json"
            answers[url, "" if page == 0 else f"t{page}"] = (rng.choice([200] * 9 + [500]), body)

    def transport(url):
        base, _, token = url.partition("&page=")
        return (lambda a: (a[0], a[1].encode()))(answers.get((base, token), (404, "")))

    plan = spark.createDataFrame([(q, f"http://api?q={q}") for q in range(13)], "term int, url string")
    stored = spark.createDataFrame([(*k, *v) for k, v in answers.items()], "url string, token string, status int, body string")
    first = lanes.scan_stored(plan, stored, str(tmp_path / "s"), pages, rows, size, rounds=1)
    assert {r["GOOGLE_INDEX"] for r in first.collect()} <= {1, 2, 3}
    begun = os.stat(tmp_path / "s" / "round=0" / "_SUCCESS").st_mtime_ns
    got = lanes.scan_stored(plan, stored, str(tmp_path / "s"), pages, rows, size)
    want = lanes.scanned(plan, transport, pages, rows, size, tries=1)
    order = sorted(want.columns)
    assert sorted(map(str, got.select(order).collect())) == sorted(map(str, want.select(order).collect())) and want.count() > 20
    assert os.stat(tmp_path / "s" / "round=0" / "_SUCCESS").st_mtime_ns == begun  # nothing was asked for again


def test_fetching_is_taken_up_again(spark, tmp_path):
    log, path = tmp_path / "log", str(tmp_path / "cache")

    def transport(url):
        with open(log, "a") as f:
            f.write(url + "\n")
        if url == "bad":
            return 404, b""
        return 200, url.encode()

    first = spark.createDataFrame([("a",), ("b",), ("bad",)], "url string")
    assert {r["url"] for r in fetch.fetched_once(first, transport, path, 3, tries=1).collect()} == {"a", "b"}
    log.unlink()
    second = spark.createDataFrame([("a",), ("c",), ("c",)], "url string")
    assert {(r["url"], bytes(r["body"])) for r in fetch.fetched_once(second, transport, path, 3, tries=1).collect()} == {("a", b"a"), ("c", b"c")}
    assert log.read_text().split() == ["c"]


def test_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        stages.read_version(spark, path)
    assert [stages.write_version(spark.range(n), path) for n in (2, 3)] == [0, 1]
    assert stages.read_version(spark, path).count() == 3 and stages.read_version(spark, path, 0).count() == 2
    (tmp_path / "t" / "v=1" / "_SUCCESS").unlink()  # a version that was not finished
    assert stages.read_version(spark, path).count() == 2


def _batches(spark, tmp_path, rows, schema):
    (tmp_path / "in").mkdir(exist_ok=True)
    for k, r in rows:
        spark.createDataFrame(r, schema).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "one"))
        shutil.copy(next((tmp_path / "one").glob("part-*")), tmp_path / "in" / f"{k}.parquet")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


SCHEMA = "seq long, LINK string, TITLE string, SOURCE string"
merge = lambda old, new: corpus.upsert(old, new, corpus.link_or_title_key()).drop("_gen")


def test_upsert_needs_the_version_before(spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "cp")
    S.upsert_each_batch(_batches(spark, tmp_path, [(0, [(1, "http://a", "A", "s")])], SCHEMA), out, merge, state).awaitTermination()
    shutil.rmtree(tmp_path / "out" / "v0")
    with pytest.raises(StreamingQueryException, match="version before"):
        S.upsert_each_batch(_batches(spark, tmp_path, [(1, [(2, "http://b", "B", "s")])], SCHEMA), out, merge, state).awaitTermination()


def test_upsert_of_parts(spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "cp")
    run = lambda rows: S.upsert_parts(_batches(spark, tmp_path, rows, SCHEMA), out, merge, corpus.link_or_title_key(), state, parts=8).awaitTermination()
    run([(0, [(k, f"http://{k}", f"T{k}", "s") for k in range(20)])])
    whole = {p.name for p in (tmp_path / "out" / "parts").iterdir()}
    run([(1, [(30, "HTTP://3", "again", "s"), (31, "http://31", "new", "s")])])
    rows = S.read_parts(spark, out, 1, SCHEMA).collect()
    assert sorted(r["TITLE"] for r in rows) == sorted([f"T{k}" for k in range(20)] + ["new"])
    rewritten = [p for p in (tmp_path / "out" / "parts").glob("*/v1")]
    assert 1 <= len(rewritten) <= 2 and len(whole) > 2
    assert S.read_parts(spark, out, 0, SCHEMA).count() == 20
    shutil.rmtree(tmp_path / "out" / "versions" / "1")
    with pytest.raises(StreamingQueryException, match="version before"):
        run([(2, [(40, "http://40", "x", "s")])])


def test_topics_are_merged_smallest_first(spark):
    rows = [(1, [1.0, 0.0])] * 5 + [(2, [0.0, 1.0])] * 4 + [(3, [0.9, 0.1])] * 2 + [(4, [0.1, 0.9])] * 3 + [(-1, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "TOPIC_ID int, vector array<double>")
    count = lambda d: {r["TOPIC_ID"]: r["count"] for r in d.groupBy("TOPIC_ID").count().collect()}
    assert count(topics.merged(df, 2)) == {1: 7, 2: 7, -1: 1}
    assert count(topics.merged(df, 9)) == count(df) and count(topics.merged(df, 1)) == {1: 14, -1: 1}
    assert topics.merged(df.limit(0), 3).count() == 0
    assert count(topics.large_enough(df, 4)) == {1: 5, 2: 4, -1: 6}


def test_gaps_of_topics_without_risks_or_dates(spark):
    rows = [(1, 0, None, "2024-01", 1), (2, 0, None, None, 2), (3, 1, 7, "2024-01", 3), (4, 1, 7, "2024-02", 4)] + [(10 + k, 1, 7, None, 50 + k) for k in range(50)] + [(90, 2, 0, None, 9), (91, 2, 0, None, 9)]
    df = spark.createDataFrame([(*r, 0.5, [1.0, 0.0]) for r in rows], "seq long, TOPIC_ID int, RISK_ID int, month string, DUP_GROUP long, QUALITY_SCORE double, vector array<double>")
    terms = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "RISK_ID int, vector array<double>")
    out = {r["TOPIC_ID"]: r for r in gaps.build_gaps(df, terms).collect()}
    assert (out[0]["FIT_PERCENTILE"], out[0]["GAP"], out[0]["BETTER_FIT_RISK"], out[0]["EMERGING_GAP_SCORE"], out[0]["PEAK_VOLUME"]) == (1.0, 0.0, None, 0.0, 1)
    assert out[1]["PEAK_VOLUME"] == 1 and out[1]["BETTER_FIT_RISK"] == 0  # undated rows are in no month
    assert out[2]["PEAK_VOLUME"] == 2 and out[2]["FIRST_SEEN"] is None and not out[2]["IS_NEW"]


def test_queries_in_blocks(spark, sf):
    v = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("seq"), F.col("embedding").alias("vector"))
    q = v.where("seq % 20 = 0").select(F.col("seq").alias("q"), F.col("vector").alias("qv"))
    one, many = ({tuple(r) for r in nearest(v, q, 3, limit).collect()} for limit in (10**9, 3000))
    assert one == many and len(one) == 3 * q.count()
    assert against(v, q, "q", "qv", 3000)._jdf.queryExecution().optimizedPlan().toString().count("Union") == 1
    assert nearest(v, q.limit(0), 3).count() == 0


def test_model_place():
    have = {"m/modules.json", "b/modules.json"}
    assert cache.model_place("m/", ["b"], have.__contains__) == ("m/", True)
    assert cache.model_place("hub-name", ["a", "b"], have.__contains__) == ("b", True)
    assert cache.model_place("hub-name", ["a"], have.__contains__) == ("hub-name", False)


def test_tagger_labels():
    text = "Senator Jane Q. Doe told Acme Bank in New York that German firms broke the Exchange Act of 1934."
    assert {label for _, label in pattern_tagger(text)} == {"GPE", "LAW", "NORP", "ORG", "PERSON"}
    assert entity_lists(text, pattern_tagger) == ["New York", "Exchange Act of 1934", "German", "Acme Bank", "Jane Q. Doe"]


def test_titles_of_enforcement_come_from_the_whole_release(spark):
    long = "The firm did so again and again. " * 20
    release = "SEC Charges Roe With Fraud\nLitigation Release No. 12 / January 5, 2024 \n" + long
    order = "ORDER I. In it SEC Charges Others too III. " + long
    df = spark.createDataFrame([("a", "litigation_release", "Roe", release), ("b", "administrative_proceeding", "Doe", order), ("c", "litigation_release", " ", long), ("d", "litigation_release", "Poe", None)], "url string, kind string, name string, text string")
    got = {r["url"]: r for r in lanes.enforcement(df).collect()}
    assert [got[k]["title"] for k in "abcd"] == ["SEC Charges Roe With Fraud", "Doe", "SEC enforcement action", "Poe"]
    assert got["a"]["text"].startswith("The firm did") and got["b"]["text"].startswith("The firm did")


def test_regulator_lane_lists_a_nation_on_a_page(spark, tmp_path):
    """The date of a release is the nearest one before it on its nation's page, however far."""
    rows = [(3, "Dated firm", 1), (1000, "Late firm", 1), (1001, "Other nation", 2)]
    names = [(k, name + " of a name that is long enough to make a release whole" * 3, nation) for k, name, nation in rows]
    spark.createDataFrame(names, "c_custkey long, c_name string, c_nationkey int").write.parquet(str(tmp_path / "customer.parquet"))
    got = {(r["source"], r["title"][11:16]): r["date"] for r in QUERIES["regulator_lane"](spark, str(tmp_path)).collect()}
    assert got == {(s, k): v for s in ("SEC", "CFTC") for k, v in (("Dated", "2024-02-03"), ("Late ", "2024-02-03"), ("Other", ""))}


def test_categories_of_lanes(spark):
    links = spark.createDataFrame([("SEC", "press release", "https://www.sec.gov/newsroom/press-releases/2024-17-firm-fined", "2024-02-03")], "agency string, category string, url string, date string")
    bodies = spark.createDataFrame([(links.first()["url"], "<p>" + "word " * 60 + "</p>")], "url string, html string")
    row = lanes.releases(links, bodies).first()
    assert (row["category"], row["title"]) == ("sec:press_release", "Firm Fined")
    article = corpus.normalise(lanes.releases(links, bodies), F.col("source"), "reg:", F.lit(0.0)).first()
    assert (article["SEARCH_TERM_ID"], article["CATEGORY"]) == ("SEC", "reg:sec:press_release")


def test_empty_and_forbidden_answers_are_asked_again():
    answers = iter([(403, b""), (200, b""), (200, b"x")])
    assert fetch.with_retries(lambda url: next(answers), "u", sleep=lambda s: None) == (200, b"x")
    answers = iter([(403, b"no"), (200, b"x")])
    assert fetch.with_retries(lambda url: next(answers), "u", sleep=lambda s: None, permanent=lanes.REFUSED) == (403, b"no")


def test_filings_are_parsed_once(spark):
    """What is read twice is written first, and no filter on it runs the parsing again."""
    text = "Item 1A. Risk Factors\n\n" + "\n\n".join(f"The firm&rsquo;s {w} may fail. " * 12 for w in ("plan", "caf\u00e9")) + "\n\nShort.\n\nItem 1B. Unresolved"
    out = lanes.filing_factors(spark.createDataFrame([(1, text), (2, None)], "filing long, text string"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "unescape" not in plan and "_without_marks" not in plan
    assert [(r["filing"], r["title"]) for r in out.orderBy("seq").collect()] == [(1, "The firm's plan may fail."), (1, "The firm's cafe may fail.")]


def test_report_pages(spark):
    page = '<title> R </title><script type="application/json">{"stats": {"totalArticles": 5, "topicCount": 2}}</script>'
    row = report_pages(spark.createDataFrame([(page,), ("x",), (None,)], "html string")).collect()
    assert (row[0]["title"], row[0]["articles"], row[0]["topics"]) == ("R", 5, 2) and row[1]["articles"] is None


def test_nearest_in_blocks_of_rows(spark):
    """Blocks of rows and of queries give what all pairs give; copies go by seq, short vectors end in zeros, null ones have no pairs."""
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.normal(size=6)]) for k in range(120)]
    rows += [(200 + k, rows[k % 3][1]) for k in range(40)] + [(300, [1.0, -2.0]), (301, None), (302, [])]
    v = spark.createDataFrame(rows, "seq long, vector array<double>")
    q = v.where("seq % 20 = 0 or seq > 299").select(F.col("seq").alias("q"), F.col("vector").alias("qv"))
    whole = {k: np.array(x + [0.0] * (6 - len(x))) for k, x in rows if x}
    want = set()
    for a in (k for k in whole if k % 20 == 0 or k > 299):
        best = sorted((-round(float(whole[a] @ whole[b]), 4), b) for b in whole if b != a)[:4]
        want |= {(a, b, -s, k) for k, (s, b) in enumerate(best, 1)}
    out = nearest(v, q, 4, 600, held_rows=30)
    assert {tuple(r) for r in out.collect()} == want
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


def test_enforcement_deals_texts_by_length(spark, monkeypatch):
    monkeypatch.setattr(lanes, "TASK_TEXT", 1000)
    links = spark.createDataFrame([(k, "litigation_release", f"u{k}", f"n{k}", day) for k in range(40) for day in ("", "2024-03-01")], "doc long, kind string, url string, name string, date string")
    bodies = spark.createDataFrame([(f"u{k}", "Litigation Release No. 1 / January 5, 2024 \nSEC Charges Firm With Fraud\n" + "The firm did so. " * 30) for k in range(40)], "url string, text string")
    out = lanes.enforcement_articles(links, bodies)
    assert sorted((r["link"], r["date"]) for r in out.collect()) == sorted((f"u{k}", "2024-03-01") for k in range(40))
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    length = bodies.agg(F.sum(F.length("text"))).first()[0]
    dealt = {int(n) for n in re.findall(r"hashpartitioning\(url#\d+, (\d+)\)", plan)}
    assert dealt == {-(-length // 1000)} and plan.count("Join") == 1
