"""E-mail digests and structured story files."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import text as X

# Section names and lines without a story, fixed values.
SECTIONS = frozenset(["finra in the news", "sec", "financial regulation", "enforcement", "markets", "cryptocurrency", "crypto", "fintech", "banking"])
SUB_LISTS = frozenset(["also:", "related:", "without finra mention:"])
READ_LINES = frozenset(["read article online", "read full text here"])
CHROME = SUB_LISTS | READ_LINES | {"back to index"}
# Fixed patterns: the source line of a story, and the source of a sub-list item.
SOURCE_LINE = re.compile(r"^(?P<source>[A-Z0-9][\w .&'’/-]{1,60}),\s+(?P<date>(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?\s+\d{1,2},\s+\d{4})\s*$")
ITEM_SOURCE = re.compile(r"\s[–—-]\s([^–—-]+?)(?:\s*\(By [^)]+\))?(?:\s*\(Paywalled\))?\s*$")
PAYWALL = re.compile(r"\s*\(Paywalled\)\s*$")

RUN_STORIES = 5000
STORY = "title string, source string, date string, summary string, byline string, section string, paywalled boolean, primary boolean"


def kind_of(line: str) -> str:
    """What a stripped line is: blank, section, sub (a sub-list's head), chrome, source or text."""
    low = line.lower()
    if not line:
        return "blank"
    if len(line) <= 40 and low in SECTIONS:
        return "section"
    if low in SUB_LISTS:
        return "sub"
    if low in CHROME:
        return "chrome"
    return "source" if SOURCE_LINE.match(line) else "text"


def stories(digest: str) -> Iterator[dict]:
    """All stories of one digest, as a small machine over its lines.

    States: idle, headline (after a source line), body, gap (after the body), items (in a sub-list).
    """
    state, section, story = "idle", "", None

    def finished():
        summary = " ".join(story.pop("_body")).strip()
        marked = "(paywalled)" in (story["title"] + summary).lower()
        return story | {"title": PAYWALL.sub("", story["title"]).strip(), "summary": summary, "paywalled": marked}

    last_date = ""
    for line in [*(x.strip() for x in (digest or "").splitlines()), None]:
        kind = "end" if line is None else kind_of(line)
        if state == "headline":
            if kind == "end":
                return
            if kind != "blank":
                story = {"title": line, "source": story["source"], "date": last_date, "byline": "", "section": section, "primary": True, "_body": []}
                state = "byline"
            continue
        if state in ("byline", "body"):
            if kind == "text":
                if state == "byline" and line.startswith("By "):
                    story["byline"] = line[3:].strip()
                else:
                    story["_body"].append(line)
                state = "body"
                continue
            yield finished()
            state = "gap"
        if state == "gap" and kind in ("blank", "chrome") and line.lower() in READ_LINES | {""}:
            continue
        if kind == "sub" and state in ("gap", "items"):
            state = "items"
            continue
        if state == "items" and kind == "blank":
            continue
        if state == "items" and kind == "text":
            found = ITEM_SOURCE.search(line)
            title = PAYWALL.sub("", ITEM_SOURCE.sub("", line).strip()).strip()
            if title:
                source = PAYWALL.sub("", found[1].strip()).strip() if found else ""
                yield {"title": title, "source": source, "date": last_date, "summary": "", "byline": "", "section": section, "paywalled": "(paywalled)" in line.lower(), "primary": False}
            continue
        state = "idle"
        if kind == "section":
            section = line
        elif kind == "source":
            m = SOURCE_LINE.match(line)
            last_date, story, state = m["date"], {"source": m["source"].strip()}, "headline"


def parse_digests(texts: DataFrame, text="text") -> DataFrame:
    """Stories of digests, one text a row; dates as yyyy-MM-dd, empty where they don't parse."""

    def run(batches):
        schema = pa.schema([(c.split()[0], pa.bool_() if c.endswith("boolean") else pa.string()) for c in STORY.split(", ")])
        for batch in batches:
            # Texts one by one and stories in runs: a batch of digests has any number of stories.
            found = (s for t in batch.column(0) for s in stories(t.as_py()))
            while some := list(islice(found, RUN_STORIES)):
                yield pa.RecordBatch.from_pylist(some, schema)

    out = texts.select(text).mapInArrow(run, STORY)
    return out.withColumn("date", F.coalesce(F.date_format(X.parse_date("date"), "yyyy-MM-dd"), F.lit("")))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    return parse_digests(spark.read.text(path, wholetext=True).withColumnRenamed("value", "text"))


# Accepted names of each column of a structured file, fixed values.
ALIASES = {
    "title": ["title", "headline"], "source": ["source", "publication"], "date": ["published_date", "date"], "summary": ["summary", "snippet", "description"],
    "byline": ["byline", "author"], "section": ["section", "category"], "paywalled": ["paywalled"], "link": ["link", "url"],
}


def structured_stories(df: DataFrame) -> DataFrame:
    """Stories of a table whose columns have any of the accepted names, in any case; rows without title go."""
    own = {c.strip().lower(): c for c in df.columns}
    pick = lambda names: next((F.coalesce(F.trim(F.col(f"`{own[n]}`").cast("string")), F.lit("")) for n in names if n in own), F.lit(""))
    out = df.select(*[pick(names).alias(c) for c, names in ALIASES.items()]).where("title != ''")
    return out.withColumns({"paywalled": F.lower("paywalled").isin("1", "true", "yes", "y"), "date": F.coalesce(F.date_format(X.parse_date("date"), "yyyy-MM-dd"), F.lit("")), "primary": F.lit(True)})


def read_structured(spark: SparkSession, path: str) -> DataFrame:
    return structured_stories(spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path))
