"""The article quality score, from 0 to 1, as one expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sources matched as part of the name, and sources matched whole.
LOW_SOURCES = (
    "einpresswire globenewswire prnewswire businesswire accesswire cision menafn webpronews bundle_app newspub_live headtopics financialcontent insidermonkey "
    "baseballnewssource completeaitraining defenseworld analyticsinsight investingnews beforeitsnews postregister hastingstribune kdhnews mankatofreepress"
).split()
MID_SOURCES = "fool benzinga investing_us forexlive yahoo zerohedge".split()
# Patterns of titles that are no stories.
BOILERPLATE = (
    r"(?i)(daily summary|summarybrief|summary brief|trending summary|news summary|earnings call (transcript|highlights)|q\d\s*\d{4}\s*earnings|eps forecast|price forecast|forecast:?\s"
    r"|market (hits|to hit|size)|\bcagr\b|weekly recap|threatsday|est state|puerto ap|winds|cloudy|mph|forecast:)"
)
MARKET_REPORT = r"(?i)market.*(\$|\bUSD\b|billion|million|cagr|20\d\d)"
DISCLAIMERS = ("legal disclaimer", "provides this news content")
# Penalties, in thousandths.
LOW, MID, TEMPLATE, REPORT, EMPTY, THIN, LEGAL = 500, 150, 400, 250, 300, 100, 300
THIN_CHARS = 120


def _text(x) -> Column:
    return F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit(""))


def quality_score(title="TITLE", summary="SUMMARY", source="SOURCE") -> Column:
    """Starts at 1 and loses a penalty for each rule; nulls count as empty."""
    t, s, slug = _text(title), F.trim(_text(summary)), F.lower(F.trim(_text(source)))
    low = slug.rlike("|".join(LOW_SOURCES))
    lost = (
        F.when(low, LOW).when(slug.isin(MID_SOURCES), MID).otherwise(0)
        + F.when(t.rlike(BOILERPLATE), TEMPLATE).otherwise(0)
        + F.when(t.rlike(MARKET_REPORT), REPORT).otherwise(0)
        + F.when(s == "", EMPTY).when(F.length(s) < THIN_CHARS, THIN).otherwise(0)
        + F.when(F.lower(s).rlike("|".join(DISCLAIMERS)), LEGAL).otherwise(0)
    )
    return F.greatest(F.lit(0), F.lit(1000) - lost) / F.lit(1000.0)


def with_quality(df, column="QUALITY_SCORE"):
    """The score of every row, replacing a column that is missing or says nothing (one value or less)."""
    if column in df.columns:
        seen = df.agg(F.count_distinct(F.coalesce(F.col(column).try_cast("double"), F.lit(0.0)))).first()[0]
        if seen > 1:
            return df.withColumn(column, F.coalesce(F.col(column).try_cast("double"), F.lit(0.0)))
    return df.withColumn(column, quality_score())
