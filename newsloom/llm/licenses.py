"""License scans (operator 5).

An Aho-Corasick automaton finds notice phrases, and words of identifier tags, over the words of a
text; in texts that have such words a second one finds the tags where they stand, and what follows a
tag on its line is a licence expression, which a shunting-yard parser evaluates.

Restrictiveness of a licence is a number from 0 (public domain) to 1 (all rights reserved).
AND takes the larger of two, OR the smaller, WITH an exception halves what stands before it.
All notices and expressions of one document hold together (AND); without any, the score is 0.

Null texts count as empty. An expression that does not parse labels nothing by its structure, but
the licences it names still count, joined by AND. The exception after a WITH is no label. Repeated
rows are scanned one by one; an empty table gives an empty result; extra columns are ignored. Texts
are scanned whole, in time that grows with their length alone.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from newsloom.llm.frames import batches, texts
from newsloom.llm.kernels import PLAIN_TRANSLATE, strings

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notice phrases beyond the base ones and the label of each, fixed values.
PHRASES = {
    "apache license": "apache",
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0": "cc0",
    "public domain": "public-domain",
    "unlicense": "public-domain",
    "creative commons attribution": "cc-by",
    "proprietary and confidential": "proprietary",
}
TAGS = ("spdx-license-identifier", "license-expression")
AFTER_TAG = re.compile(r"\s*:[ \t]*([^\r\n]*)")
LOWER_CASE = {c: c + 32 for c in range(65, 91)}
# Restrictiveness of each label, fixed values.
WEIGHTS = {
    "public-domain": 0.0, "cc0": 0.0, "unlicense": 0.0, "0bsd": 0.05, "mit": 0.1, "isc": 0.1, "bsd": 0.1, "zlib": 0.1,
    "apache": 0.15, "cc-by": 0.2, "cc-by-sa": 0.4, "mpl": 0.5, "epl": 0.5, "lgpl": 0.5, "gpl": 0.7, "agpl": 0.8,
    "cc-by-nd": 0.8, "cc-by-nc": 0.85, "proprietary": 1.0, "reserved": 1.0,
}
UNKNOWN_WEIGHT = 0.6
FAMILIES = ("cc-by-nc", "cc-by-nd", "cc-by-sa", "cc-by", "cc0", "agpl", "lgpl", "gpl", "apache", "mpl", "epl", "0bsd", "bsd", "mit", "isc", "zlib", "unlicense")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def family(identifier: str) -> str:
    """The family of an SPDX identifier: GPL-2.0-or-later is gpl, BSD-3-Clause is bsd."""
    low = identifier.lower().rstrip("+")
    return next((f for f in FAMILIES if low == f or low.startswith(f + "-")), low)


def tokens(expression: str) -> list[str]:
    return re.findall(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*", expression)


def to_postfix(parts: list[str]) -> list[str]:
    """Shunting-yard: operators in lower case; raises ValueError where the expression is malformed."""
    out, stack, want_operand = [], [], True
    for t in parts:
        low = t.lower()
        if low in PRECEDENCE:
            if want_operand:
                raise ValueError("operator without a left side")
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[low]:
                out.append(stack.pop())
            stack.append(low)
            want_operand = True
        elif t == "(":
            if not want_operand:
                raise ValueError("( after an operand")
            stack.append(t)
        elif t == ")":
            if want_operand:
                raise ValueError(") without an operand")
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                raise ValueError("unmatched )")
            stack.pop()
        else:
            if not want_operand:
                raise ValueError("two operands")
            out.append(t)
            want_operand = False
    if want_operand or "(" in stack:
        raise ValueError("unfinished expression")
    return out + stack[::-1]


def evaluate(expression: str) -> tuple[set[str], float]:
    """The families an expression names and its restrictiveness; (empty set, 0) for an empty one."""
    parts = tokens(expression)
    if not parts:
        return set(), 0.0
    stack: list[tuple[set[str], float]] = []
    try:
        for t in to_postfix(parts):
            if t not in PRECEDENCE:
                name = family(t)
                stack.append(({name}, WEIGHTS.get(name, UNKNOWN_WEIGHT)))
                continue
            (right, r), (left, w) = stack.pop(), stack.pop()
            if t == "with":
                stack.append((left, w / 2))
            else:
                stack.append((left | right, max(w, r) if t == "and" else min(w, r)))
        return stack[0]
    except (ValueError, IndexError):
        named = {f for t in parts if t.lower() not in PRECEDENCE and (f := family(t)) in WEIGHTS}
        return named, max((WEIGHTS[f] for f in named), default=0.0)


def automaton(phrases: dict[str, str]):
    """Over texts whose words are joined, started and ended by one space, so matches are whole words; and one over texts as they are, for tags."""
    words, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase, label in phrases.items():
        words.add_word(f" {phrase} ", (len(phrase) + 2, label, phrase in BASE))
    for tag in TAGS:
        words.add_word(f" {tag.replace('-', ' ')} ", (0, None, False))
        tags.add_word(tag, tag)
    words.make_automaton()
    tags.make_automaton()
    return words, tags


def expressions_in(text: str, tags) -> list[str]:
    """What stands after each identifier tag, up to the end of its line."""
    low = text.translate(LOWER_CASE)
    return [m[1].strip() for end, _ in tags.iter(low) if (m := AFTER_TAG.match(text, end + 1))]


def scan(text: str, finder) -> tuple:
    """(n_words, places, first, last, base labels, all labels, score, expressions) of one text."""
    words, tags = finder
    split = text.encode().translate(PLAIN_TRANSLATE).split()
    flat = f" {b' '.join(split).decode()} "
    at, base, found, tagged = [], set(), set(), False
    for end, (size, label, is_base) in words.iter(flat):
        if label is None:
            tagged = True
            continue
        found.add(label)
        if is_base:
            base.add(label)
            at.append(end - size + 1)
    first = last = None
    if at:  # the word that starts after the k-th space is word k
        spaces = [k for k, c in enumerate(flat) if c == " "]
        first, last = bisect_left(spaces, min(at)), bisect_left(spaces, max(at))
    score = max((WEIGHTS.get(x, UNKNOWN_WEIGHT) for x in found), default=0.0)
    expressions = expressions_in(text, tags) if tagged else []
    for e in expressions:
        names, weight = evaluate(e)
        found |= names
        score = max(score, weight)
    return len(split), len(at), first, last, ",".join(sorted(base)), ",".join(sorted(found)), score, expressions


SCHEMA = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, expressions array<string>"


def license_scan(docs: DataFrame, doc_id="doc_id", text="text", phrases: dict[str, str] | None = None) -> DataFrame:
    """One row per document: places of the base phrases, labels, restrictiveness, expressions found."""
    wanted = BASE | (PHRASES if phrases is None else phrases)

    def run(batch, finder):
        rows = [scan(t, finder) for t in strings(batch.column(1)).to_pylist()]
        columns = [batch.column(0).cast(pa.int64())]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]
        columns += [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCHEMA.split(", ")])

    return batches(texts(docs, doc_id, text), run, SCHEMA, setup=lambda: automaton(wanted))
