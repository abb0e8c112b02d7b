"""Long documents cut into articles: listings, monthly compilations, filings, releases.

Fetched files are read as rows of (url or name, text); how they are fetched is fetch.py's business.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import text as X

MIN_ACTION, MIN_FACTOR = 120, 200
# Fixed patterns of the formats.
LISTING_DATE = r'<time[^>]*datetime="(\d{4}-\d{2}-\d{2})'
CASE_HEADER = r"([A-Z][^()\n]{2,90}?\(CRD[^)]*#\s*\d[\d,]*[^)]*\))"
SECTION_HEADER = r"(?i)\b(Firms?\s+(?:Fined|Expelled|Suspended|Sanctioned|Cancelled)|Individuals?\s+(?:Barred|Suspended|Fined|Sanctioned|Revoked)|Complaints?\s+Filed|Decisions?\s+Issued)\b"
RELEASE_HEADLINE = r"(?i)(SEC\s+(?:Charges|Obtains|Files|Settles|Announces)[^.\n]{5,160})"
# Two words or more between the first and the one that tells; a run of any length is one loop, where a repeated group would nest once a word.
FACTOR_START = r"(?<=[.])\s+(?=[A-Z][a-z]+\s+\w+\s+\w[\w\s]*?\s(?:could|may|would|risk|adversely|our|we|the))"
# Legal phrases that say nothing of the case, longer ones first; fixed values.
LEGAL_PHRASES = [
    "the findings herein are made pursuant to", "on the basis of this order and", "on the basis of this order", "the securities and exchange commission", "securities and exchange commission",
    "united states district court", "the commission deems it appropriate", "in the public interest", "without admitting or denying", "offers of settlement", "offer of settlement",
    "cease-and-desist", "cease and desist", "securities exchange act of 1934", "exchange act of 1934", "securities act of 1933", "administrative proceeding", "pursuant to section", "pursuant to rule",
    "the commission finds", "the commission further finds", "it is hereby ordered", "remedial sanctions", "final consent judgment", "consent judgment", "final judgment", "the complaint alleges",
    "the sec's complaint", "prejudgment interest", "civil penalty", "civil penalties", "permanently enjoin", "permanently enjoining", "disgorgement", "respondents", "respondent", "defendants", "defendant",
]


def pieces(df: DataFrame, pattern: str, kind: str, text="text", keys=("doc",)) -> DataFrame:
    """One row for each match: keys, kind, pos (characters before it), value (first group).

    The text is cut at the matches, so positions come from the lengths of what stands between.
    """
    bare = pattern.replace("(?i)", "")
    flag = "(?i)" if pattern.startswith("(?i)") else ""
    whole = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))
    between = F.split(F.col(text), f"{flag}{bare}", -1)
    rows = df.select(*keys, between.alias("_between"), whole.alias("_whole"), value.alias("_value")).where(F.size("_whole") > 0)
    lengths = F.transform(F.sequence(F.lit(1), F.size("_whole")), lambda i: F.length(F.element_at("_between", i)) + F.when(i > 1, F.length(F.get("_whole", i - 2))).otherwise(0))
    each = rows.select(*keys, F.posexplode(F.arrays_zip(lengths.alias("step"), F.col("_value").alias("value"))).alias("nr", "m"))
    w = Window.partitionBy(*keys).orderBy("nr").rowsBetween(Window.unboundedPreceding, 0)
    return each.select(*keys, F.lit(kind).alias("kind"), F.sum("m.step").over(w).alias("pos"), F.col("m.value").alias("value"))


def as_of(events: DataFrame, keys: list[str], order: str, carried: Column, out: str) -> DataFrame:
    """Each row with the last non-null `carried` at or before it, by order within the keys."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return events.withColumn(out, F.last(carried, ignorenulls=True).over(w))


def dated_links(pages: DataFrame, link_pattern: str, html="html", keys=("doc",)) -> DataFrame:
    """Links of listing pages with the nearest date before them; each link once, in page order."""
    events = pieces(pages, LISTING_DATE, "date", html, keys).unionByName(pieces(pages, link_pattern, "link", html, keys))
    dated = as_of(events, list(keys), "pos", F.when(F.col("kind") == "date", F.col("value")), "date").where("kind = 'link'")
    first = F.row_number().over(Window.partitionBy(*keys, "value").orderBy("pos"))
    return dated.withColumn("_n", first).where("_n = 1").select(*keys, "pos", F.col("value").alias("link"), F.coalesce("date", F.lit("")).alias("date"))


def split_actions(df: DataFrame, text="text", keys=("doc",)) -> DataFrame:
    """Actions of monthly compilations: name, text up to the next case header, the section header before it."""
    heads = pieces(df, CASE_HEADER, "case", text, keys)
    sections = pieces(df, SECTION_HEADER, "section", text, keys)
    events = as_of(heads.unionByName(sections), list(keys), "pos", F.when(F.col("kind") == "section", F.col("value")), "section").where("kind = 'case'")
    following = F.lead("pos").over(Window.partitionBy(*keys).orderBy("pos"))
    cut = events.withColumn("_end", following).join(df.select(*keys, F.col(text).alias("_text")), list(keys))
    body = X.collapse(F.substring(F.col("_text"), F.col("pos") + 1, F.coalesce("_end", F.length("_text")) - F.col("pos")))
    out = cut.select(*keys, "pos", X.collapse("value").alias("name"), body.alias("body"), F.coalesce(X.collapse("section"), F.lit("disciplinary action")).alias("section"))
    return out.where(F.length("body") >= MIN_ACTION)


def first_sentence(x: Column) -> Column:
    return F.element_at(F.split(x, r"(?<=[.])\s", 2), 1)


def action_title(name: Column, body: Column) -> Column:
    clause = F.btrim(F.replace(first_sentence(body), name, F.lit("")), F.lit(" -–"))
    return F.substring(F.when(clause != "", F.concat(name, F.lit(" - "), clause)).otherwise(name), 1, 180)


def factors(df: DataFrame, text="text", keys=("filing",)) -> DataFrame:
    """Risk factors of a section, each whole: its paragraphs, or runs of sentences where it has fewer than three."""
    by_line = F.split(F.col(text), r"\n\s*\n+")
    parts = F.when(F.size(by_line) >= 3, by_line).otherwise(F.split(F.col(text), FACTOR_START))
    each = df.select(*keys, F.posexplode(parts).alias("seq", "part")).withColumn("text", X.collapse(F.replace("part", F.lit("\xa0"), F.lit(" "))))
    return each.where(F.length("text") >= MIN_FACTOR).select(*keys, "seq", "text")


def factor_title(x: Column) -> Column:
    first = F.trim(first_sentence(x))
    return F.when(F.length(first) > 140, F.concat(F.substring(first, 1, 140), F.lit("..."))).otherwise(first)


def scrubbed(x: Column) -> Column:
    """Without legal phrases; spaces and stray punctuation tidied."""
    phrases = "|".join(p.replace("-", r"\-") for p in LEGAL_PHRASES)
    out = F.regexp_replace(x, rf"(?i)\b(?:{phrases})\b", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(out, r"\s{2,}", " "), r"\s+([,.;:])", "$1"))


def _after(x: Column, pattern: str, least: int) -> Column:
    """What follows the first match, if more than `least` characters do."""
    rest = F.regexp_extract(x, rf"(?s)^.*?{pattern}(.*)$", 1)
    return F.when(x.rlike(pattern) & (F.length(rest) > least), F.trim(rest))


# Where the text of an order begins, with the least that must follow; captions of litigation releases. Fixed values of the formats.
ORDER_STARTS = [(r"\bIII\.\s", 300), (r"\bORDER\b(?s:.*?)\bI\.\s", 200)]
ORDER_MARKERS, AFTER_MARKER = ("deems it appropriate", "In the Matter of"), 200
RELEASE_CAPTION = r"(?s)^.*?Litigation Release No\.\s*\d+\s*/\s*[^\n]*?\d{4}\s*"
RELEASE_CASE = r"(?:Securities and Exchange Commission|SEC)\s+v\.\s+.*?\bfiled\b[^)]*\)\s*"


def order_body(x: Column) -> Column:
    """An order from its section III on; else from I after the title; else from a marker; guarded by what remains."""
    marked = [F.when((F.instr(x, m) > 0) & (F.length(x) - F.instr(x, m) + 1 > AFTER_MARKER), F.trim(F.substring(x, F.instr(x, m), F.length(x)))) for m in ORDER_MARKERS]
    return F.coalesce(*[_after(x, pattern, least) for pattern, least in ORDER_STARTS], *marked, x)


def release_body(x: Column) -> Column:
    """A litigation release without its caption and the line that names the case."""

    def without_first(t, pattern):
        whole = F.regexp_extract(t, f"(?s)^(.*?)(?:{pattern})(.*)$", 1)
        return F.when(t.rlike(f"(?s){pattern}"), F.concat(whole, F.regexp_extract(t, f"(?s)^(.*?)(?:{pattern})(.*)$", 2))).otherwise(t)

    out = F.trim(without_first(F.regexp_replace(x, RELEASE_CAPTION, ""), RELEASE_CASE))
    return F.when(out != "", out).otherwise(x)


def release_title(body: Column, name: Column) -> Column:
    found = X.collapse(F.regexp_extract(body, RELEASE_HEADLINE, 1))
    return F.when(found != "", found).otherwise(F.coalesce(X.blank_to_null(name), F.lit("SEC enforcement action")))


# Where report pages embed their data: a line of script, or an element of its own; fixed values of the format.
REPORT_DATA = [r"(?m)^const DATA = (.*?);*$", r"(?is)<script[^>]*type=\"application/json\"[^>]*>(.*?)</script>"]


def report_pages(df: DataFrame, html="html") -> DataFrame:
    """Title, embedded statistics and months of generated report pages; what a page lacks, or spells as no JSON, is null."""
    title = X.edges_trimmed(F.regexp_extract(html, r"(?is)<title>(.*?)</title>", 1))
    data = F.coalesce(*[F.nullif(F.regexp_extract(html, p, 1), F.lit("")) for p in REPORT_DATA])
    count = lambda name: F.get_json_object(data, f"$.stats.{name}").try_cast("long")
    months = F.from_json(F.get_json_object(data, "$.trends.months"), "array<string>")
    return df.select("*", title.alias("title"), count("totalArticles").alias("articles"), count("topicCount").alias("topics"), months.alias("months"))
