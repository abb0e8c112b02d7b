"""Text, date and URL functions on columns."""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSITIVE, NEGATIVE = 0.05, -0.05


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_to_null(x) -> Column:
    """Trimmed text; null where nothing, or the word nan, is left."""
    t = F.trim(_c(x))
    return F.when((t != "") & (F.lower(t) != "nan"), t)


def clean_string(x) -> Column:
    return F.coalesce(blank_to_null(x), F.lit(""))


def clean_number(x, default=0.0) -> Column:
    v = _c(x).try_cast("double")
    return F.when(v.isNull() | F.isnan(v), F.lit(default)).otherwise(v)


def collapse(x) -> Column:
    """Runs of white space become one space; trimmed."""
    return F.trim(F.regexp_replace(_c(x), r"\s+", " "))


def document_text(title="TITLE", summary="SUMMARY") -> Column:
    return collapse(F.concat(F.coalesce(_c(title), F.lit("")), F.lit(". "), F.coalesce(_c(summary), F.lit(""))))


def block_key(x) -> Column:
    """First 40 characters of the text in lower case, without what is no ASCII letter, digit or space."""
    plain = F.regexp_replace(F.lower(F.coalesce(_c(x), F.lit(""))), "[^a-z0-9 ]", "")
    return F.substring(F.trim(F.regexp_replace(plain, r"\s+", " ")), 1, 40)


def sentiment_label(compound) -> Column:
    c = _c(compound)
    return F.when(c >= POSITIVE, "Positive").when(c <= NEGATIVE, "Negative").otherwise("Neutral")


def source_slug(url) -> Column:
    """Host without www.; of more than two labels the last but one."""
    host = F.replace(F.parse_url(_c(url), F.lit("AUTHORITY")), F.lit("www."), F.lit(""))
    parts = F.split(host, r"\.")
    return F.when(F.size(parts) > 2, F.element_at(parts, -2)).otherwise(host)


def edges_trimmed(x) -> Column:
    """Without white space of any kind at the ends; inside it stays."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")


def month(x) -> Column:
    return F.date_format(_c(x), "yyyy-MM")


def risk_number(x) -> Column:
    """1, "1" and "1.0" are all 1."""
    return _c(x).cast("string").try_cast("double").cast("int")


def normal_title(x) -> Column:
    """Lower case, cut at the first source separator, without edge punctuation."""
    t = F.trim(F.lower(F.coalesce(_c(x), F.lit(""))))
    for sep in (" - ", " | ", " — "):
        t = F.trim(F.substring_index(t, sep, 1))
    return F.btrim(t, F.lit(" .:-—|"))


def normal_phrase(x) -> Column:
    """Lower case, without one leading determiner."""
    return F.trim(F.regexp_replace(F.trim(F.lower(_c(x))), r"^(the|a|an|this|that|these|those)\s+", ""))


# Pronouns and stock phrases that are no keywords, fixed values.
STOP_PHRASES = ["it", "he", "she", "they", "we", "i", "you", "this", "that", "these", "those", "who", "which", "what", "one", "some", "any", "all", "more", "the article", "the report", "the company", "the news"]


def keyword_filter(phrases) -> Column:
    """Normalised phrases in order, each once: with a letter, three characters or more, no stop phrase."""
    normal = F.transform(_c(phrases), normal_phrase)
    return F.array_distinct(F.filter(normal, lambda p: (F.length(p) >= 3) & p.rlike("[a-z]") & ~p.isin(STOP_PHRASES)))


def distinct_keywords(words, limit=5) -> Column:
    """At most `limit` of the words: of those that contain one another the longer stays, in the first one's place."""
    none = F.array().cast("array<string>")

    def step(kept, raw):
        w = F.trim(raw)
        low = F.lower(w)
        inside = F.exists(kept, lambda k: F.contains(F.lower(k), low) | F.contains(low, F.lower(k)))
        same = F.exists(kept, lambda k: F.lower(k) == low)
        longer = F.transform(kept, lambda k: F.when(F.contains(low, F.lower(k)) & (F.length(w) > F.length(k)), w).otherwise(k))
        return F.when((F.size(kept) >= limit) | (w == "") | w.isNull() | same, kept).when(inside, longer).otherwise(F.array_append(kept, w))

    kept = F.aggregate(_c(words), none, step)
    return F.aggregate(kept, none, lambda a, w: F.when(F.exists(a, lambda k: F.lower(k) == F.lower(w)), a).otherwise(F.array_append(a, w)))


def spoken_list(words, last=" and ") -> Column:
    """a, b and c."""
    w = _c(words)
    n = F.size(w)
    head, tail = F.array_join(F.slice(w, F.lit(1), n - 1), ", "), F.array_join(F.slice(w, n, F.lit(1)), "")
    return F.when(n == 0, "").when(n == 1, tail).otherwise(F.concat(head, F.lit(last), tail))


# Spelling of words that title case would break, fixed values.
ACRONYMS = {
    "ai": "AI", "us": "US", "uk": "UK", "eu": "EU", "sec": "SEC", "finra": "FINRA", "nato": "NATO", "epa": "EPA", "usd": "USD", "gdp": "GDP", "ipo": "IPO",
    "etf": "ETF", "crypto": "Crypto", "genai": "GenAI", "llm": "LLM", "ceo": "CEO", "cfo": "CFO", "doj": "DOJ", "fbi": "FBI", "cia": "CIA", "un": "UN", "cagr": "CAGR",
    "q1": "Q1", "q2": "Q2", "q3": "Q3", "q4": "Q4", "esg": "ESG", "ev": "EV", "ml": "ML", "it": "IT", "pw": "PW", "ftnt": "FTNT", "crwd": "CRWD",
}


def title_case(x) -> Column:
    """Words with a capital; acronyms as listed; words with a digit as they are."""
    known = F.create_map(*[F.lit(v) for kv in ACRONYMS.items() for v in kv])
    word = lambda w: F.when(F.map_contains_key(known, F.lower(w)), F.element_at(known, F.lower(w))).when(w.rlike(r"\d"), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w))))
    return F.array_join(F.transform(F.filter(F.split(_c(x), r"\s+"), lambda w: w != ""), word), " ")


def parse_date(x) -> Column:
    """Month DD, YYYY in three spellings, else an ISO date; null if neither."""
    t = F.trim(_c(x))
    formats = ("MMMM d, yyyy", "MMM d, yyyy", "MMM. d, yyyy", "yyyy-MM-dd")
    return F.coalesce(*[F.to_date(F.try_to_timestamp(t, F.lit(f))) for f in formats], t.try_cast("date"))


# Where pages state their date, in order of trust; fixed values.
PAGE_DATES = [r'"datePublished"\s*:\s*"(\d{4}-\d{2}-\d{2})', r"\b(20\d{2}-\d{2}-\d{2})\b", r"\b((?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?\s+\d{1,2},\s+20\d{2})\b"]


def page_date(html) -> Column:
    """datePublished, else the first ISO date from 2000 on, else the first Month DD, YYYY."""
    h = _c(html)
    return F.coalesce(*[parse_date(F.regexp_extract(h, p, 1)) for p in PAGE_DATES])


# Named references that plain replacement decodes, & last; fixed values.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def plain_entities(x) -> Column:
    t = _c(x)
    for name, char in ENTITIES:
        t = F.replace(t, F.lit(name), F.lit(char))
    return t


@F.pandas_udf(T.StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """All character references, through a pandas UDF; for texts where plain_entities is not enough."""
    return texts.map(html_lib.unescape, na_action="ignore")


# Names of sites at the end of their page titles, fixed values.
SITE_SUFFIX = r"\s*[|–—]\s*(?:SEC\.gov|FINRA\.org|CFTC|Consumer Financial Protection Bureau|NASAA|U\.S\. Securities).*$"


def page_title(html, fallback="") -> Column:
    """The h1, unless it only numbers a release; else the title; without tags and site name."""

    def inside(tag):
        raw = F.regexp_extract(_c(html), rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1)
        return F.trim(F.regexp_replace(collapse(plain_entities(F.regexp_replace(raw, "<[^>]+>", ""))), SITE_SUFFIX, ""))

    h1, title = inside("h1"), inside("title")
    return F.when((h1 != "") & ~h1.rlike(r"(?i)^release number\s"), h1).when(title != "", title).when(h1 != "", h1).otherwise(F.initcap(_c(fallback) if not isinstance(fallback, str) else F.lit(fallback)))


# Mis-decoded characters and what they stand for, fixed values.
MOJIBAKE = {"Æ": "'", "Õ": "'", "Ô": "'", "Ò": '"', "Ó": '"', "ù": "—", "Ñ": "–", "«": "®", "\x89": "", "\x92": "'", "\x93": '"', "\x94": '"', "\x96": "-"}
PDF_PUNCTUATION = {"ô": '"', "ö": '"', "Õ": "'", "Ô": "'", "\x92": "'", "\x93": '"', "\x94": '"', "ñ": "-", "Ñ": "-", "®": "(R)"}


def mapped(x, table: dict[str, str]) -> Column:
    """Characters replaced by a table: one translate() for single ones, replace() for the rest."""
    one = {k: v for k, v in table.items() if len(v) <= 1}
    out = F.translate(_c(x), "".join([k for k, v in one.items() if v] + [k for k, v in one.items() if not v]), "".join(v for v in one.values() if v))
    for k, v in table.items():
        if len(v) > 1:
            out = F.replace(out, F.lit(k), F.lit(v))
    return out


def repaired(x, table: dict[str, str] | None = None) -> Column:
    """Text whose UTF-8 was read as Latin-1, decoded anew where a character of the table shows it; then the table.

    What has no place in Latin-1, and bytes that are no UTF-8, go in the decoding; all SQL.
    """
    known = MOJIBAKE if table is None else table
    t = _c(x)
    odd = F.regexp_like(t, F.lit("[" + "".join(known) + "]"))
    latin = F.encode(F.regexp_replace(t, r"[^\x00-\xFF]", ""), "ISO-8859-1")
    decoded = F.replace(F.make_valid_utf8(latin.cast("string")), F.lit("\ufffd"), F.lit(""))
    return mapped(F.when(odd & (decoded != ""), decoded).otherwise(t), known)


# Punctuation beyond ASCII and its nearest spelling, fixed values.
PLAIN_PUNCTUATION = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "--", "…": "...", "•": "*", "®": "(r)", "™": "(tm)", "©": "(c)", "§": "SS", "\xa0": " "}


@F.pandas_udf(T.StringType())
def _without_marks(texts: pd.Series) -> pd.Series:
    return texts.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")


def transliterated(x) -> Column:
    """ASCII spelling: plain punctuation, letters without their marks; other characters go. Collapsed."""
    return collapse(_without_marks(mapped(x, PLAIN_PUNCTUATION)))


# The number of a release, before its words; a fixed value of the format.
SLUG_NUMBER = r"^20\d{2}-\d+-"


def slug_title(x) -> Column:
    """The last part of a path as a title: words for hyphens and underscores, without year and number before them."""
    last = F.regexp_replace(F.regexp_extract(_c(x), r"([^/]+?)(?:\.\w+)?/?(?:[?#].*)?$", 1), SLUG_NUMBER, "")
    return F.initcap(F.trim(F.regexp_replace(last, "[-_]+", " ")))


def title_keywords(df: DataFrame, key: str, text: str, n=5) -> DataFrame:
    """key, keywords of each row: the n most common words of four letters or more, first seen first among equals."""

    def common(it):
        for batch in it:
            words = [[w for w, _ in Counter(re.findall("[a-z]{4,}", x.as_py())).most_common(n)] for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], [key, "keywords"])

    rows = df.select(key, F.lower(F.coalesce(_c(text), F.lit(""))).alias("_text"))
    return rows.mapInArrow(common, f"`{key}` {df.schema[key].dataType.simpleString()}, keywords array<string>")


def best_headline(titles, keywords) -> Column:
    """First headline of 15 to 140 characters that holds a keyword, else the first of that length."""
    fit = F.filter(_c(titles), lambda t: F.length(t).between(15, 140))
    hit = F.filter(fit, lambda t: F.exists(_c(keywords), lambda k: F.contains(F.lower(t), F.lower(k))))
    return F.coalesce(F.try_element_at(hit, F.lit(1)), F.try_element_at(fit, F.lit(1)), F.substring(F.try_element_at(_c(titles), F.lit(1)), 1, 140), F.lit(""))


def clean_description(x) -> Column:
    """Without the sentence on linked risks and the number of articles."""
    t = F.trim(F.regexp_replace(_c(x), r"\s*Linked to risk[^.]*\.\s*$", ""))
    return F.trim(F.regexp_replace(t, r"\s*\(\d[\d,]*\s+articles\)", ""))


def relevance_band(x) -> Column:
    return F.when(_c(x) >= 0.30, "high").when(_c(x) >= 0.15, "moderate").otherwise("low")


def display_count(x) -> Column:
    """Counts from 1000 on to the nearest 100."""
    return F.when(_c(x) >= 1000, F.round(_c(x), -2)).otherwise(_c(x))


def json_safe(x) -> Column:
    """JSON that can stand in a script element."""
    return F.replace(_c(x), F.lit("</"), F.lit("<\\/"))


def highlight(x, query: str) -> Column:
    """Search hits in <mark>."""
    if not query:
        return _c(x)
    quoted = "".join(c if c.isalnum() or c == " " else "\\" + c for c in query)
    return F.regexp_replace(_c(x), f"(?i)({quoted})", "<mark>$1</mark>")


# Elements whose text belongs to no article, fixed values.
PAGE_PARTS = ["script", "style", "head", "nav", "header", "footer", "aside", "form"]


def html_text(html) -> Column:
    """The text of a page without markup and without the usual parts around an article; all SQL."""
    t = F.coalesce(_c(html), F.lit(""))
    for tag in PAGE_PARTS:
        t = F.regexp_replace(t, rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}>", " ")
    t = F.regexp_replace(F.regexp_replace(t, r"(?s)<!--.*?-->", " "), r"<[^>]+>", " ")
    return collapse(plain_entities(t))


def natural_order(x) -> list[Column]:
    """Sort keys of ids as text: by length, then by value."""
    return [F.length(_c(x)), _c(x)]


def full_text_or(extracted, description, least=200, cap=6000) -> Column:
    """The extracted text if it is long enough, else the description."""
    text = F.substring(collapse(extracted), 1, cap)
    return F.when(F.length(text) >= least, text).otherwise(_c(description))


def cache_key(model: str, text) -> Column:
    """SHA-1 of model, NUL and text."""
    return F.sha1(F.concat(F.lit(model), F.lit("\x00"), _c(text)))


def date_windows(start, end, days: int) -> Column:
    """Array of (start, end) of windows of `days` days that cover the dates, the last one cut."""
    first = F.sequence(_c(start), _c(end), F.expr(f"interval {days} days"))
    return F.transform(first, lambda d: F.struct(d.alias("window_start"), F.least(F.date_add(d, days - 1), _c(end)).alias("window_end")))


def look_back_days(months: int) -> int:
    return int(months * 30.44)


def look_back(months) -> Column:
    """look_back_days() of a column."""
    return F.floor(_c(months) * F.lit(30.44)).cast("int")


def windowed_path(path, days) -> Column:
    """last_days_path() of columns: the suffix goes before a file's ending."""
    suffix = F.concat(F.lit("_last"), _c(days).cast("string"), F.lit("d"))
    ending = F.regexp_extract(_c(path), r"\.[^.]*$", 0)
    stem = F.substring(_c(path), F.lit(1), F.length(_c(path)) - F.length(ending))
    return F.when(F.coalesce(_c(days), F.lit(0)) == 0, _c(path)).otherwise(F.concat(stem, suffix, ending))


def last_days_path(path: str, days: int | None) -> str:
    """The output path of a windowed run."""
    if not days:
        return path
    stem, dot, ext = path.rpartition(".")
    return f"{stem}_last{days}d.{ext}" if dot else f"{path}_last{days}d"
