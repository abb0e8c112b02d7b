"""Entities and keywords, with a pluggable tagger."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text as X

LABELS = ("GPE", "LAW", "NORP", "ORG", "PERSON")
Tagger = Callable[[str], list[tuple[str, str]]]

_ORG = re.compile(r"\b(?:[A-Z][\w&.-]+\s+)+(?:Inc|Corp|LLC|Ltd|Commission|Authority|Bank|Agency|Group|Department)\b\.?")
_LAW = re.compile(r"\b(?:[A-Z]\w+\s+)+Act(?:\s+of\s+\d{4})?\b")


# Places and peoples that the tagger knows by name.
PLACES = "United States|United Kingdom|European Union|Argentina|Australia|Austria|Belgium|Brazil|Britain|California|Canada|Chile|China|Delaware|Denmark|Egypt|Europe|Finland|Florida|France|Germany|Greece|Hong Kong|India|Indonesia|Iran|Iraq|Ireland|Israel|Italy|Japan|Kenya|London|Mexico|Netherlands|New Jersey|New York|Nigeria|Norway|Paris|Poland|Portugal|Russia|Saudi Arabia|Singapore|South Africa|South Korea|Spain|Sweden|Switzerland|Taiwan|Texas|Tokyo|Turkey|Ukraine|Vietnam|Washington"
PEOPLES = "American|Australian|Brazilian|British|Canadian|Chinese|Democrat|Democratic|Dutch|European|French|German|Indian|Iranian|Irish|Israeli|Italian|Japanese|Korean|Mexican|Republican|Russian|Spanish|Swiss|Ukrainian"
_GPE = re.compile(rf"\b(?:{PLACES})\b")
_NORP = re.compile(rf"\b(?:{PEOPLES})s?\b")
_PERSON = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|President|Senator|Chair|Chairman|Commissioner|Judge|Director|Secretary)\.?\s+((?:[A-Z][a-z]+|[A-Z]\.)(?:\s+(?:[A-Z][a-z]+|[A-Z]\.)){0,2})")


def pattern_tagger(text: str) -> list[tuple[str, str]]:
    """A tagger without a model: organisations and acts by their form, persons by their title, places and peoples by name."""
    found = [(m[0].strip(), "ORG") for m in _ORG.finditer(text)] + [(m[0].strip(), "LAW") for m in _LAW.finditer(text)]
    found += [(m[1], "PERSON") for m in _PERSON.finditer(text)]
    return found + [(m[0], "GPE") for m in _GPE.finditer(text)] + [(m[0], "NORP") for m in _NORP.finditer(text)]


def entity_lists(text: str | None, tagger: Tagger) -> list[str]:
    """Distinct entities of two characters or more of the known labels, by label and then name."""
    clean = " ".join((text or "").split())
    return [name for _, name in sorted({(label, name) for name, label in tagger(clean) if label in LABELS and len(name) >= 2})]


def with_entities(df: DataFrame, text: str, tagger: Tagger = pattern_tagger, out="ENTITIES") -> DataFrame:
    @F.pandas_udf("array<string>")
    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: entity_lists(t, tagger))

    return df.withColumn(out, tag(F.col(text)))


def with_keywords(df: DataFrame, text: str, stop: list[str], out="NLP_KEYWORDS") -> DataFrame:
    """Runs of words between stop words and punctuation, as noun phrases without a parser; all SQL."""
    marked = F.regexp_replace(F.lower(X.collapse(F.col(text))), rf"\b(?:{'|'.join(stop)})\b|[^\p{{L}}\p{{N}}' -]+", "|") if stop else F.lower(X.collapse(F.col(text)))
    return df.withColumn(out, X.keyword_filter(F.filter(F.transform(F.split(marked, r"\s*\|\s*"), lambda p: F.trim(p)), lambda p: p != "")))
