"""The lanes that articles come in by: keyed and un-keyed news scans, regulator listings, monthly files, filings.

Plans and parsing are here; requests go through a transport of the user's (fetch.py).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import urlencode

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.operators import corpus, neardup, neighbours
from newsloom.operators.report import RISK_PHRASES
from newsloom.sources import documents
from newsloom.sources.fetch import Transport, with_retries
from newsloom.sources.stages import exists, scratch

PER_TERM = 10
OLDEST_DAYS = 45
MIN_RELEASE = 150
# What a task of a join of texts takes, in characters: such texts shrink so much in a shuffle that its bytes don't tell.
TASK_TEXT = 16_000_000
REFUSED = (401, 403, 404, 422)  # a scan that is refused is not asked again: every request counts

# Listings of each agency: address of the site, the listing's path, the kind of release, the form of its links. Fixed values.
LISTINGS = [
    ("SEC", "https://www.sec.gov", "/newsroom/press-releases", "press release", r'(/newsroom/press-releases/20\d{2}-\d+[^"#?]*)'),
    ("SEC", "https://www.sec.gov", "/newsroom/speeches-statements", "statement", r'(/newsroom/speeches-statements/[a-z0-9][^"#?]*-\d{6})'),
    ("FINRA", "https://www.finra.org", "/media-center/newsreleases", "news release", r'(/media-center/newsreleases/20\d{2}/[^"#?]+)'),
    ("FINRA", "https://www.finra.org", "/rules-guidance/notices", "notice", r'(/rules-guidance/notices/(?:\d{2}-\d{2}|[a-z-]*notice-?\d+)[^"#?]*)'),
    ("CFTC", "https://www.cftc.gov", "/PressRoom/PressReleases", "press release", r"(/PressRoom/PressReleases/\d{4}-\d{2})"),
    ("CFPB", "https://www.consumerfinance.gov", "/about-us/newsroom/?categories=press-release", "press release", r"(/about-us/newsroom/[a-z0-9][a-z0-9-]{15,}/)"),
    ("NASAA", "https://www.nasaa.org", "/category/newsroom/current-headlines/", "news release", r'(https://www\.nasaa\.org/\d+/[a-z0-9][^"#?]*)'),
]
# Streams of enforcement releases: the listing's path, the kind, whether releases are PDF. Fixed values.
STREAMS = [
    ("litigation", "/enforcement-litigation/litigation-releases", "litigation_release", False),
    ("admin", "/enforcement-litigation/administrative-proceedings", "administrative_proceeding", True),
]
# The link of a row, up to the end of the name it bears.
RESPONDENT_LINK = r"""(?s)release-view__respondents'><a href=['"]([^'"#?]+['"][^>]*>.*?)</a>"""
MONTHLY_FILE = r"(?i)disciplinary[-_]actions[-_]([a-z]+)[-_](\d{4})"


# News scans.


def address(endpoint: str, **parameters) -> str:
    return f"{endpoint}?{urlencode({k: v for k, v in parameters.items() if v is not None})}"


def keyword_plan(terms: DataFrame, endpoint: str, size: int = PER_TERM, term="term") -> DataFrame:
    """terms with `url`: the first request of each search term."""
    asked = F.concat(F.lit(f"{endpoint}?q="), F.url_encode(F.trim(term)), F.lit(f"&language=en&country=us&size={size}"))
    return terms.withColumn("url", asked)


def _scans(rows: DataFrame, lane: str, category: Column, url: Column) -> DataFrame:
    return rows.select(F.lit(lane).alias("lane"), category.alias("CATEGORY"), url.alias("url"))


def _fixed(country, language, priority) -> str:
    return "&" + urlencode({k: v for k, v in (("country", country), ("language", language), ("prioritydomain", priority)) if v is not None})


def latest_scans(categories: DataFrame, endpoint: str, category="category", country="us", language="en", priority: str | None = "top") -> DataFrame:
    """lane, CATEGORY, url: one un-keyed scan of the last two days for each category."""
    return _scans(categories, "DISCOVERY", F.col(category), F.concat(F.lit(f"{endpoint}?category="), F.url_encode(category), F.lit(_fixed(country, language, priority))))


def phrase_scans(phrases: DataFrame, endpoint: str, phrase="phrase", country="us", language="en", priority: str | None = "top") -> DataFrame:
    """lane, CATEGORY, url: one scan for each phrase, as a whole."""
    asked = F.url_encode(F.concat(F.lit('"'), F.col(phrase), F.lit('"')))
    return _scans(phrases, "LEXICON", F.concat(F.lit("lex:"), F.col(phrase)), F.concat(F.lit(f"{endpoint}?q="), asked, F.lit(_fixed(country, language, priority))))


def latest_plan(spark: SparkSession, endpoint: str, categories: list[str], country="us", language="en", priority: str | None = "top") -> DataFrame:
    return latest_scans(spark.createDataFrame([(c,) for c in categories], "category string"), endpoint, "category", country, language, priority)


def lexicon_plan(spark: SparkSession, endpoint: str, phrases: list[str] | None = None, country="us", language="en", priority: str | None = "top") -> DataFrame:
    """One scan for each phrase of the language of risk."""
    return phrase_scans(spark.createDataFrame([(p,) for p in phrases or RISK_PHRASES], "phrase string"), endpoint, "phrase", country, language, priority)


SCANNED = "GOOGLE_INDEX int, TITLE string, LINK string, PUBLISHED_DATE string, SUMMARY string, SOURCE string, requests int"


def pages_of(url: str, transport: Transport, pages: int | None, rows: int | None, size: int | None, tries: int) -> tuple[list[dict], int]:
    """Results of a scan and the requests it took: page after page, up to the caps, a short page or the last one."""
    found: list[dict] = []
    token, asked = None, 0
    while (pages is None or asked < pages) and (rows is None or len(found) < rows):
        status, body = with_retries(transport, url if token is None else f"{url}&{urlencode({'page': token})}", tries, permanent=REFUSED)
        asked += 1
        try:
            answer = json.loads(body) if status == 200 else {}
        except ValueError:
            answer = {}
        results = answer.get("results") or []
        found += results
        token = answer.get("nextPage")
        if not token or (size is not None and len(results) < size):
            break
    return found[:rows], asked


def scanned(plan: DataFrame, transport: Transport, pages: int | None = None, rows: int | None = PER_TERM, size: int | None = PER_TERM, tries: int = 3) -> DataFrame:
    """The plan's columns beside each article its requests bring. A scan is one plan row, so plan rows are the parallelism.

    A scan without results, or whose first request fails, gives no row.
    """
    kept = [f for f in plan.schema if f.name != "url"]
    names = [f.name for f in kept]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for row in pdf.to_dict("records"):
                items, asked = pages_of(row["url"], transport, pages, rows, size, tries)
                for n, item in enumerate(items, 1):
                    text = item.get("description") or item.get("content") or ""
                    out.append([*[row[c] for c in names], n, item.get("title") or "", item.get("link") or "", item.get("pubDate") or "", text, item.get("source_id"), asked])
            yield pd.DataFrame(out, columns=[*names, *[c.split()[0] for c in SCANNED.split(", ")]])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], SCANNED])
    got = plan.select(*names, "url").mapInPandas(run, schema)
    return got.withColumn("SOURCE", F.coalesce("SOURCE", X.source_slug("LINK")))


ANSWER = "results array<struct<title:string,link:string,pubDate:string,description:string,content:string,source_id:string>>, nextPage string"


def scan_stored(plan: DataFrame, answers: DataFrame, path: str, pages: int | None = None, rows: int | None = PER_TERM, size: int | None = PER_TERM, rounds: int | None = None) -> DataFrame:
    """scanned() over stored answers: url, token ("" for a scan's first page), status, body.

    All scans take one page a round: a join of the addresses and tokens asked for with the answers. What a round brings is
    kept below `path` before the next begins, so a scan that is stopped goes on from its last round, and `rounds` bounds how
    many are taken at once. Many scans are many rows of the join; no page is asked for twice.
    """
    spark = plan.sparkSession
    ask = plan.select("url").distinct().select("url", F.lit("").alias("token"), F.lit(0).alias("had"), F.lit(0).alias("asked"))
    done, n = [], 0
    while True:
        folder = f"{path}/round={n}"
        if not exists(spark, f"{folder}/_SUCCESS"):
            if rounds is not None and n >= max(rounds, 1):
                break
            hit = ask.join(answers.select("url", "token", "status", "body"), ["url", "token"], "left")
            hit = hit.withColumn("answer", F.from_json(F.when(F.col("status") == 200, F.col("body").cast("string")), ANSWER))
            items = F.coalesce("answer.results", F.array().cast("array<struct<title:string,link:string,pubDate:string,description:string,content:string,source_id:string>>"))
            got = hit.select("url", "token", "had", (F.col("asked") + 1).alias("asked"), items.alias("items"), F.col("answer.nextPage").alias("next"))
            got = got.withColumn("have", F.col("had") + F.size("items"))
            more = (F.coalesce("next", F.lit("")) != "") & (F.lit(True) if size is None else F.size("items") >= size)
            for cap, at in ((pages, "asked"), (rows, "have")):
                more = more if cap is None else more & (F.col(at) < cap)
            got.withColumn("next", F.when(more, F.col("next"))).write.mode("overwrite").parquet(folder)
        page = spark.read.parquet(folder)
        done.append(page)
        ask = page.where("next is not null").select("url", F.col("next").alias("token"), F.col("have").alias("had"), "asked")
        n += 1
        if ask.isEmpty():
            break
    every = done[0]
    for page in done[1:]:
        every = every.unionByName(page)
    total = every.groupBy("url").agg(F.max("asked").cast("int").alias("requests"))
    each = every.select("url", "had", F.posexplode("items").alias("k", "i")).withColumn("GOOGLE_INDEX", (F.col("had") + F.col("k") + 1).cast("int"))
    each = each if rows is None else each.where(F.col("GOOGLE_INDEX") <= rows)
    text = F.coalesce(F.when(F.col("i.description") != "", F.col("i.description")), F.col("i.content"), F.lit(""))
    filled = lambda c: F.coalesce(c, F.lit(""))
    out = each.select("url", "GOOGLE_INDEX", filled("i.title").alias("TITLE"), filled("i.link").alias("LINK"), filled("i.pubDate").alias("PUBLISHED_DATE"), text.alias("SUMMARY"), F.col("i.source_id").alias("SOURCE"))
    out = out.withColumn("SOURCE", F.coalesce("SOURCE", X.source_slug("LINK"))).join(total, "url")
    return plan.join(out, "url").drop("url")


def fresh(articles: DataFrame, known: DataFrame, *order: str) -> DataFrame:
    """Scanned articles with a link that neither the corpus nor an earlier row of the scan has."""
    link = F.lower(X.blank_to_null("LINK"))
    rows = articles.where(link.isNotNull()).withColumn("_link", link)
    rows = rows.join(known.select(link.alias("_link")).where("_link IS NOT NULL"), "_link", "left_anti")
    return corpus.first_of(rows, "_link", *order, "GOOGLE_INDEX").drop("_link")


# Regulators.


def listed(pages: DataFrame, keys=("doc",)) -> DataFrame:
    """Releases on listing pages (keys, agency, category, html): keys, agency, category, url, date, pos; each link of a page once."""
    pages = neighbours.kept(pages, scratch(pages.sparkSession, "listings"), "pages")  # read twice for each listing
    out = None
    for agency, site, _, category, pattern in LISTINGS:
        own = pages.where((F.col("agency") == agency) & (F.col("category") == category))
        links = documents.dated_links(own, pattern, "html", keys)
        url = F.when(F.startswith("link", F.lit("http")), F.col("link")).otherwise(F.concat(F.lit(site), F.col("link")))
        one = links.select(*keys, F.lit(agency).alias("agency"), F.lit(category).alias("category"), url.alias("url"), "date", "pos")
        out = one if out is None else out.unionByName(one)
    return out


def releases(links: DataFrame, bodies: DataFrame, cutoff: str | None = None, body: Column | None = None) -> DataFrame:
    """Articles of listed releases: title, text, source, date, link, category. bodies: url, html.

    The listing's date goes before the page's own; releases older than the cutoff, and thin ones, go.
    """
    page = links.join(bodies.select("url", "html"), "url")
    text = X.repaired(X.html_text("html")) if body is None else body
    date = F.coalesce(X.blank_to_null("date"), F.date_format(X.page_date("html"), "yyyy-MM-dd"), F.lit(""))
    category = F.concat(F.lower("agency"), F.lit(":"), F.replace("category", F.lit(" "), F.lit("_")))
    rows = page.select(
        X.page_title("html", X.slug_title(F.col("url"))).alias("title"), text.alias("text"), F.col("agency").alias("source"), date.alias("date"), F.col("url").alias("link"), category.alias("category")
    )
    rows = corpus.not_older(rows, cutoff, "date") if cutoff else rows
    return corpus.thick(rows, "text", MIN_RELEASE)


def enforcement(bodies: DataFrame, keep=()) -> DataFrame:
    """Releases of both enforcement streams: bodies (url, kind, name, text) with title and the text without captions and legal phrases,
    and the columns to keep.

    Orders are titled with the name; litigation releases with the headline of the whole text, as the
    caption that goes may hold it.
    """
    order, text, name = F.col("kind") == "administrative_proceeding", F.col("text"), F.col("name")
    own = F.when(order, documents.order_body(text)).otherwise(documents.release_body(text))
    title = documents.release_title(F.when(~order, text), name)
    return bodies.select("url", "kind", title.alias("title"), documents.scrubbed(own).alias("text"), *keep)


def enforcement_listed(pages: DataFrame, keys=("doc",), site="https://www.sec.gov") -> DataFrame:
    """Rows of the listings of both streams (keys, stream, html): keys, kind, url, name of the respondent, date; each link of a page once."""
    out = None
    for stream, _, kind, _ in STREAMS:
        links = documents.dated_links(pages.where(F.col("stream") == stream), RESPONDENT_LINK, "html", keys)
        link = F.regexp_extract("link", r"""^([^'"]+)""", 1)
        url = F.when(F.startswith(link, F.lit("http")), link).otherwise(F.concat(F.lit(site), link))
        name = X.collapse(F.regexp_replace(F.regexp_extract("link", r"(?s)^[^>]*>(.*)$", 1), "<[^>]+>", " "))
        rows = links.select(*keys, F.lit(kind).alias("kind"), url.alias("url"), name.alias("name"), "date", "pos")
        first = F.row_number().over(Window.partitionBy(*keys, "url").orderBy("pos"))
        one = rows.withColumn("_n", first).where("_n = 1").drop("_n", "pos")
        out = one if out is None else out.unionByName(one)
    return out


def enforcement_articles(links: DataFrame, bodies: DataFrame) -> DataFrame:
    """Articles of listed enforcement releases: title, text, source, date, link, category. bodies: url, text. A link that several pages list is one article."""
    n = bodies.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(bodies.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_TEXT))
    once = corpus.first_of(links.repartition(parts, "url"), "url", F.desc("date"), "name")
    named = once.join(bodies.select("url", "text").repartition(parts, "url"), "url")
    made = enforcement(named.select("url", "kind", "name", "text", "date"), keep=("date",))
    return made.select("title", "text", F.lit("SEC").alias("source"), "date", F.col("url").alias("link"), F.concat(F.lit("sec:"), F.col("kind")).alias("category"))


def actions(files: DataFrame) -> DataFrame:
    """Articles of monthly compilations (url, text): title, text, source, date, link, category. The month is the address's."""
    each = documents.split_actions(files.select("url", "text"), keys=("url",))
    date = F.concat(file_month("url"), F.lit("-01"))
    category = F.regexp_replace(F.lower("section"), r"\s+", "_")
    return each.select(documents.action_title(F.col("name"), F.col("body")).alias("title"), F.col("body").alias("text"), F.lit("FINRA Disciplinary Actions").alias("source"), date.alias("date"), F.col("url").alias("link"), category.alias("category"))


# Files and filings.


def file_month(url: Column | str) -> Column:
    """YYYY-MM of a monthly file: from its folder, else from its name; null without either."""
    u = F.col(url) if isinstance(url, str) else url
    folder = F.regexp_extract(u, r"/(\d{4}-\d{2})/", 1)
    spelled = F.concat(F.initcap(F.regexp_extract(u, MONTHLY_FILE, 1)), F.lit(" "), F.regexp_extract(u, MONTHLY_FILE, 2))
    return F.coalesce(X.blank_to_null(folder), F.date_format(F.try_to_timestamp(spelled, F.lit("MMMM yyyy")), "yyyy-MM"))


def newest_files(files: DataFrame, n: int, url="url") -> DataFrame:
    """The n newest monthly files by the dates in their paths, each address once; files without one go."""
    dated = files.select(F.col(url).alias("url")).distinct().withColumn("month", file_month("url")).where("month IS NOT NULL")
    return dated.orderBy(F.desc("month"), "url").limit(n)


def latest_filings(filings: DataFrame, tickers: list[str], forms: list[str], n: int) -> DataFrame:
    """The n newest filings of each ticker and form, without amendments. filings: ticker, form, date, link."""
    wanted = filings.where(F.col("ticker").isin(tickers) & F.col("form").isin(forms))
    rank = F.row_number().over(Window.partitionBy("ticker", "form").orderBy(F.desc("date"), "link"))
    return wanted.withColumn("rank", rank).where(F.col("rank") <= n)


def risk_section(text: Column | str) -> Column:
    """Item 1A of a filing: the longest stretch from that heading to the next item's, as the table of contents has them too; "" without one."""
    t = F.col(text) if isinstance(text, str) else text
    found = F.regexp_extract_all(t, F.lit(r"(?is)\bitem\s+1a\b[.:\s]*(?:risk\s+factors)?[.:\s]*(.*?)(?=\bitem\s+(?:1b|1c|2)\b|\z)"), F.lit(1))
    longest = F.aggregate(found, F.lit(""), lambda a, x: F.when(F.length(F.trim(x)) > F.length(a), F.trim(x)).otherwise(a))
    return longest


def filing_factors(filings: DataFrame, key="filing", text="text") -> DataFrame:
    """key, seq, title, text: the distinct risk factors of each filing, from its text with character references and marks."""
    # Filters on what is parsed would parse it twice, and before the rows are dealt out; so null texts go first and thin factors after the write.
    sections = filings.where(F.col(text).isNotNull()).select(F.col(key).alias("filing"), risk_section(X.unescape(F.col(text))).alias("text"))
    each = documents.factors(sections).withColumn("text", X.transliterated("text"))
    each = neighbours.kept(each, scratch(filings.sparkSession, "filings"), "each").where(F.length("text") >= documents.MIN_FACTOR)
    stay = neardup.dedup_factors(each.withColumn("filing", F.col("filing").cast("string")))
    named = each.withColumn("_filing", F.col("filing").cast("string")).join(stay.select(F.col("filing").alias("_filing"), "seq"), ["_filing", "seq"], "left_semi")
    return named.select(F.col("filing").alias(key), "seq", documents.factor_title(F.col("text")).alias("title"), "text")
