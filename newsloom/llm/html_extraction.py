"""HTML extraction: boosted trees over DOM nodes, decoded over the hierarchy (operator 1).

Every block element is a node with features of its subtree (text, tags, links, density), its
attribute tokens and those of its ancestors, its depth and its siblings. The trees give each node
the log-odds of being article content. Decoding then picks, for each subtree, the better of
keeping it whole, dropping it whole, or deciding child by child at a cost; so a node that is
dropped never has a kept descendant, and a single odd node does not cut a hole into an article.
Of equal choices a node is decided child by child before it is kept whole, and kept before it is dropped.

A name is only a hint. That of an element that holds a headline and a good part of the page's text is not
heard against it, nor against what it holds: an article whose element is called `ad-hoc-story` or
`contact` stays one. Within an article a part that bears such a name goes if it is a few sentences, and stays if it
is longer. Names that are not only of role words are features of their own.

The trees are trained, once a process, on pages that this module composes from named parts whose
role is known (the generator below); nothing is sampled from the input.

Null, empty and unparseable html give an empty text; so does a page without content, and an empty table
an empty one. Blocks keep the page's order. Repeated rows are extracted one by one; extra columns are ignored. Pages are read
whole, in time that grows with their length, however deep they nest.
"""

from __future__ import annotations

import functools
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.boosting import Trees, fit
from newsloom.llm.dom import Page, attribute_text, is_hidden
from newsloom.llm.frames import batches, texts
from newsloom.llm.kernels import slices, strings

# What attribute tokens and tags say of an element's role, fixed values.
ROLES = {
    "content": "article content entry post story body main articlebody text prose",
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs toc pagination pager sitemap skip toolbar tabs",
    "header": "header masthead topbar banner brand logo",
    "footer": "footer foot colophon copyright contentinfo imprint",
    "side": "sidebar aside rail widget widgets related recommended recommendations trending popular complementary secondary more teaser",
    "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion outbrain taboola adsense doubleclick",
    "notice": "cookie cookies consent notice notices gdpr popup modal overlay alert subscribe subscription newsletter paywall disclaimer announcement dialog privacy toast",
    "form": "form search login signup signin register contact searchbox",
    "comment": "comment comments disqus replies reply respond discussion commentlist feedback reader readers",
    "share": "share sharing social follow like tweet tags taglist byline author meta",
}
ROLE_NAMES = list(ROLES)
TOKEN_ROLE = {t: k for k, r in enumerate(ROLE_NAMES) for t in ROLES[r].split()}
TAG_ROLE = {"article": "content", "main": "content", "nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "side", "form": "form", "dialog": "notice", "fieldset": "form"}
TAG_GROUPS = {**{t: 0 for t in ("p", "blockquote", "pre")}, **{f"h{k}": 1 for k in range(1, 7)}, **{t: 2 for t in ("ul", "ol", "dl", "li", "dt", "dd")}, **{t: 3 for t in ("table", "tr", "td", "th", "tbody", "thead")}, **{t: 4 for t in ("div", "section", "center")}, **{t: 5 for t in ("article", "main")}, **{t: 6 for t in ("body", "html", "root")}}
N_GROUPS = 8
CONTENT = ROLE_NAMES.index("content")
N_ROLES = len(ROLE_NAMES)
SWITCH_COST = 1.0


# What the element of a headline must hold, as a share of the page's text, for its name not to count.
MAIN_SHARE = 0.34


@functools.lru_cache(maxsize=4096)
def roles_of(tag: str, raw: str) -> tuple[int, int, int]:
    """Bits of the roles that the tag names, bits of those that its attributes name, and how many of their words name none."""
    said = 1 << ROLE_NAMES.index(TAG_ROLE[tag]) if tag in TAG_ROLE else 0
    word, bits, other = "", 0, 0
    for c in attribute_text(raw) + " ":
        if c.isalnum():
            word += c
        elif word:
            for w in (word, word.rstrip("0123456789")):
                if w in TOKEN_ROLE:
                    bits |= 1 << TOKEN_ROLE[w]
                    break
            else:
                other += 1
            word = ""
    return said, bits, other


N_FEATURES = 19 + N_GROUPS + 2 * N_ROLES


def node_features(page: Page):
    """One row for each node: own and subtree text, links, density, depth, siblings, roles."""
    n = len(page.tags)
    parent = page.parents
    own, link, blocks, stops = [0] * n, [0] * n, [0] * n, [0] * n
    before = [-1] * n
    seen = 0
    for node, text, links in page.blocks:
        own[node] += len(text)
        link[node] += links
        blocks[node] += 1
        stops[node] += text.count(".") + text.count(",")
        if before[node] < 0:
            before[node] = seen
        seen += len(text)
    sub, sub_link, sub_tags, sub_p, kids, longest = own[:], link[:], [1] * n, [0] * n, [0] * n, own[:]
    headed = [t == "h1" or t == "h2" for t in page.tags]
    for k in range(n - 1, 0, -1):
        p = parent[k]
        sub[p] += sub[k]
        sub_link[p] += sub_link[k]
        sub_tags[p] += sub_tags[k]
        sub_p[p] += sub_p[k] + (page.tags[k] == "p")
        kids[p] += 1
        headed[p] = headed[p] or headed[k]
        if longest[k] > longest[p]:
            longest[p] = longest[k]
        if before[k] >= 0 and (before[p] < 0 or before[k] < before[p]):
            before[p] = before[k]
    total = max(seen, 1)
    depth, place, bits, above = [0] * n, [0] * n, [0] * n, [0] * n
    given, words = [0] * n, [0] * n
    # 1 for what lies outside the page's article or main element, if one holds a good part of the text.
    around, within = [False] * n, [False] * n
    for k in range(1, n):
        within[k] = within[parent[k]] or (page.tags[k] in ("article", "main") and sub[k] >= MAIN_SHARE * total)
    for k in range(n - 1, 0, -1):
        around[parent[k]] = around[parent[k]] or around[k] or within[k]
    outside = [int(around[0] and not within[k] and not around[k]) for k in range(n)]
    x = np.zeros((n, N_FEATURES))
    rows = []
    for k in range(n):
        p = parent[k]
        said, named, other = roles_of(page.tags[k], page.attributes[k])
        if headed[k] and sub[k] >= MAIN_SHARE * total:
            named &= 1 << CONTENT
        bits[k] = said | named
        words[k] = min(other, 3) if named else 0
        if p >= 0:
            depth[k] = depth[p] + 1
            place[k] = given[p]
            given[p] += 1
            above[k] = above[p] | bits[p]
        up = max(p, 0)
        rows.append((own[k], sub[k], sub_link[k], sub_tags[k], sub_p[k], kids[k], depth[k], place[k], kids[up], sub[up] - sub[k], blocks[k], stops[k], longest[k], max(before[k], 0), total, TAG_GROUPS.get(page.tags[k], N_GROUPS - 1), bits[k], above[k], words[k], outside[k]))
    r = np.array(rows, float)
    x[:, 0] = np.log1p(r[:, 0])
    x[:, 1] = np.log1p(r[:, 1])
    x[:, 2] = r[:, 2] / np.maximum(r[:, 1], 1)
    x[:, 3] = np.log1p(r[:, 3])
    x[:, 4] = r[:, 1] / r[:, 3]
    x[:, 5] = np.log1p(r[:, 4])
    x[:, 6] = np.log1p(r[:, 5])
    x[:, 7] = r[:, 6]
    x[:, 8] = r[:, 7] / np.maximum(r[:, 8] - 1, 1)
    x[:, 9] = np.log1p(r[:, 8])
    x[:, 10] = np.log1p(r[:, 9])
    x[:, 11] = np.log1p(r[:, 10])
    x[:, 12] = r[:, 11] / np.maximum(r[:, 0], 1)
    x[:, 13] = np.log1p(r[:, 12])
    x[:, 14] = r[:, 13] / r[:, 14]
    x[:, 15] = r[:, 1] / r[:, 14]
    x[:, 16] = np.log1p(r[:, 14])
    x[:, -2:] = r[:, 18:20]
    x[np.arange(n), 17 + r[:, 15].astype(int)] = 1
    for j in range(N_ROLES):
        x[:, 17 + N_GROUPS + j] = (r[:, 16].astype(int) >> j) & 1
        x[:, 17 + N_GROUPS + N_ROLES + j] = (r[:, 17].astype(int) >> j) & 1
    return x, own


def decode(page: Page, logit, own, cost=SWITCH_COST):
    """Which nodes are kept: the best labelling in which dropped nodes have no kept descendants."""
    n = len(page.tags)
    gain = [float(g) * (0.5 + np.log1p(o)) for g, o in zip(logit, own, strict=True)]
    keep_all, mixed = gain[:], [0.0] * n
    best = [0.0] * n
    for k in range(n - 1, -1, -1):
        # Own text of a mixed node goes by its own sign; -keep_all drops the subtree.
        own_gain = abs(gain[k]) if own[k] else 0.0
        best[k] = max(keep_all[k], -keep_all[k], mixed[k] + own_gain - cost)
        if k:
            p = page.parents[k]
            keep_all[p] += keep_all[k]
            mixed[p] += best[k]
    kept = np.zeros(n, bool)
    state = [""] * n
    for k in range(n):
        p = page.parents[k]
        if p >= 0 and state[p] != "mixed":
            state[k] = state[p]
        else:
            own_gain = abs(gain[k]) if own[k] else 0.0
            state[k] = max((keep_all[k], "keep"), (-keep_all[k], "drop"), (mixed[k] + own_gain - cost, "mixed"))[1]
        kept[k] = state[k] == "keep" or state[k] == "mixed" and gain[k] > 0
    return kept


def without_hidden(page: Page):
    """Blocks outside elements that are never shown."""
    hidden = [False] * len(page.tags)
    for k in range(1, len(page.tags)):
        a = page.attributes[k].lower()
        hidden[k] = hidden[page.parents[k]] or ("hidden" in a or "display" in a) and is_hidden(a)
    if any(hidden):
        page.blocks = [b for b in page.blocks if not hidden[b[0]]]


# The generator of training pages. Each part is (html, is content); words are invented.
_SYLLABLES = "ka lo mi ter en sa ru vel do pin ar que sol tam ber ino ché für ña".split()


def _words(r: random.Random, lo, hi):
    return " ".join("".join(r.choices(_SYLLABLES, k=r.randint(1, 4))) + r.choice(["", "", "", "", ",", ".", "###", "%%%"]) for _ in range(r.randint(lo, hi)))


def _links(r, lo, hi, tag="li", shortest=1, longest=3):
    return "".join(f'<{tag}><a href="/{i}">{_words(r, shortest, longest)}</a></{tag}>' for i in range(r.randint(lo, hi)))


def _boilerplate(r: random.Random, outside=False) -> str:
    """One part that is not content, in one of the ways pages mark it; outside an article element it may bear a name that tells nothing."""
    kind = r.choice(["menu", "header", "footer", "side", "ad", "notice", "form", "comment", "share"])
    tag = r.choice(["div", "section", "div"])
    token = r.choice(ROLES[kind].split())
    name = r.choice([f'class="{token}"', f'id="{token}"', f'class="{token}-box x{r.randint(1, 9)}"', f'class="site-{token}"', f'role="{token}"'])
    if (kind in ("menu", "header", "footer") or outside and kind in ("side", "comment")) and r.random() < (0.35 if kind == "footer" else 0.2):  # only place and structure tell
        name = r.choice(['class="top"', 'class="bottom"', f'class="c{r.randint(1, 9)}"', 'class="row"', f'class="{"".join(r.choices(_SYLLABLES, k=3))}"', ""])
    if kind == "menu":
        return r.choice([f"<nav><ul>{_links(r, 3, 9)}</ul></nav>", f"<{tag} {name}><ul>{_links(r, 2, 9)}</ul></{tag}>", f"<nav {name}>{_links(r, 2, 6, 'span')}</nav>"])
    if kind == "header":
        return r.choice([f'<header><a href="/">{_words(r, 1, 3)}</a><p>{_words(r, 2, 9)}</p></header>', f"<{tag} {name}><h2>{_words(r, 1, 5)}</h2></{tag}>", f"<header {name}><h1>{_words(r, 1, 4)}</h1><ul>{_links(r, 1, 5)}</ul></header>"])
    if kind == "footer":
        return r.choice([f"<footer>&copy; {_words(r, 2, 12)}</footer>", f"<footer><p>{_words(r, 3, 25)}</p><ul>{_links(r, 0, 5)}</ul></footer>", f"<{tag} {name}><p>{_words(r, 3, 20)}</p></{tag}>"])
    if kind == "side":
        inner = r.choice([f"<ul>{_links(r, 2, 8)}</ul>", f"<h3>{_words(r, 1, 4)}</h3><p>{_words(r, 4, 40)}</p>", f"<p>{_words(r, 3, 30)}</p>" * r.randint(1, 3)])
        return r.choice([f"<aside>{inner}</aside>", f"<aside {name}>{inner}</aside>", f"<{tag} {name}>{inner}</{tag}>"])
    if kind == "form":
        inner = f"<label>{_words(r, 1, 3)}</label><input name=q><p>{_words(r, 1, 8)}</p>"
        return r.choice([f"<form>{inner}</form>", f"<form {name}>{inner}<button>{_words(r, 1, 2)}</button></form>", f"<{tag} {name}><form>{inner}</form></{tag}>"])
    if kind == "comment":
        each = r.choice(["<li>{}</li>", "<div class=\"comment\"><p>{}</p></div>", "<p>{}</p>", "<article><h4>{}</h4><p>{}</p></article>"])
        inner = "".join(each.replace("{}", _words(r, 3, 60)) for _ in range(r.randint(1, 6)))
        head = r.choice(["", f"<h3>{_words(r, 1, 2)}</h3>"])
        if outside and r.random() < 0.3:
            return f"<{tag} {name}>{head}{inner}</{tag}>"
        return r.choice([f"<{tag} {name}>{head}{inner}</{tag}>", f'<section id="comments">{head}<ol>{inner}</ol></section>', f'<div class="comments">{head}{inner}</div>'])
    inner = r.choice([_words(r, 2, 25), f"<p>{_words(r, 2, 40)}</p>", f'<p>{_words(r, 2, 12)} <a href="/x">{_words(r, 1, 3)}</a></p>'])
    return f"<{tag} {name}>{inner}</{tag}>"


def _named(r: random.Random) -> str:
    """A class or id as content may have it: with a role's word by chance, beside words of its own."""
    token, own = r.choice(list(TOKEN_ROLE)), "".join(r.choices(_SYLLABLES, k=2))
    return r.choice(["class", "id"]) + '="' + r.choice([f"{token}-{own}", f"{own}-{token}", f"{own} {token}-{own}", own, f"{token}-content", token]) + '"'


def _content(r: random.Random) -> list[str]:
    """The parts inside an article."""
    out = [r.choice([f"<h1>{_words(r, 1, 12)}</h1>", f"<h1>{_words(r, 1, 12)}</h1>", f"<header><h1>{_words(r, 2, 9)}</h1></header>", f"<h2>{_words(r, 1, 8)}</h2>", ""])]
    for _ in range(0 if r.random() < 0.08 else r.choice([r.randint(1, 4), r.randint(3, 25)])):
        size = r.choice([(1, 2), (3, 12), (10, 60), (30, 160)])
        out.append(
            r.choice(
                [
                    *[f"<p>{_words(r, *size)}</p>"] * 6,
                    f"<p><b>{_words(r, *size)}<br>",
                    f'<p>{_words(r, *size)} <a href="/y">{_words(r, 1, 4)}</a> {_words(r, 1, 9)}</p>',
                    f"<h{r.randint(2, 4)}>{_words(r, 1, 8)}</h{r.randint(2, 4)}>",
                    f"<ul>{''.join(f'<li>{_words(r, 2, 14)}</li>' for _ in range(r.randint(1, 5)))}</ul>",
                    f"<ul>{_links(r, 1, 4, 'li', 3, 9)}</ul>",
                    f"<blockquote><p>{_words(r, *size)}</p></blockquote>",
                    f"<table><tr><td>{_words(r, 1, 4)}</td><td>{_words(r, 1, 4)}</td></tr></table>",
                    f"<figure><img src=a><figcaption>{_words(r, 2, 12)}</figcaption></figure>",
                    f"<pre>{_words(r, 4, 30)}</pre>",
                    f"<div>{_words(r, *size)}</div>",
                    f"<section><h2>{_words(r, 1, 6)}</h2><p>{_words(r, *size)}</p></section>",
                ]
            )
        )
    for k, part in enumerate(out):
        if r.random() < 0.08 and part:
            out[k] = f'<{(tag := r.choice(["div", "section", "div"]))} {_named(r)}>{part}<p>{_words(r, 12, 70)}</p></{tag}>'
    return out if any(out) else [f"<p>{_words(r, 5, 50)}</p>"]


def training_page(seed: int):
    """Html in which U+E003 and U+E004 enclose the content, U+E001 and U+E002 what is odd inside it."""
    r = random.Random(seed)
    parts = _content(r)
    for _ in range(r.choice([0, 0, 1, 2])):  # something odd in the middle of the article
        parts.insert(r.randint(1, len(parts)), f"\ue001{_boilerplate(r)}\ue002")
    content = "".join(parts)
    wrap = r.choice(["<article>{}</article>"] * 4 + ["<main>{}</main>", "<main><article>{}</article></main>", '<div class="c1">{}</div>', '<div class="post-content">{}</div>', '<div id="content"><div class="entry">{}</div></div>', '<div class="story-body">{}</div>', '<section class="article-text">{}</section>', "<div>{}</div>", "{}"])
    if r.random() < 0.2:  # an article's own element may be called anything
        tag = r.choice(["article", "main", "div", "section"])
        wrap = f"<{tag} {_named(r)}>{{}}</{tag}>"
    if r.random() < 0.05:  # a page that is nothing but its content
        return f"<html><body>\ue003{content}\ue004</body></html>"
    marked = wrap.startswith(("<article", "<main"))
    after = [_boilerplate(r, marked) for _ in range(r.randint(0, 3))]
    inside = [f"\ue001{_boilerplate(r)}\ue002" for _ in range(r.choice([0, 0, 1]))]
    body = "".join([*[_boilerplate(r, marked) for _ in range(r.randint(0, 4))], "\ue003", wrap.replace("{}", content + "".join(inside)), "\ue004", *after])
    return f"<html><head><title>{_words(r, 2, 6)}</title></head><body>{r.choice(['{}', '<div class=wrapper>{}</div>', '<div id=page><div class=row>{}</div></div>']).replace('{}', body)}</body></html>"


def labelled(source: str):
    """Features and labels of the nodes of a training page that are all content or all not."""
    parts = re.split("([\ue001-\ue004])", source)
    plain, inside, odd = "", False, False
    spans = []
    for p in parts:
        if p in ("\ue003", "\ue004"):
            inside = p == "\ue003"
        elif p in ("\ue001", "\ue002"):
            odd = p == "\ue001"
        else:
            # Every text of a content part is marked, so that the blocks tell where they come from.
            spans.append(re.sub(r">([^<\s])", lambda m: ">\ue000" + m[1], p) if inside and not odd else p)
    plain = "".join(spans)
    marked = Page(plain)
    page = Page(plain.replace("\ue000", ""))
    n = len(page.tags)
    if n != len(marked.tags) or len(page.blocks) != len(marked.blocks):
        return None
    good, bad = [0] * n, [0] * n
    for (node, _, _), (_, text, _) in zip(page.blocks, marked.blocks, strict=True):
        if "\ue000" in text:
            good[node] += 1
        else:
            bad[node] += 1
    for k in range(n - 1, 0, -1):
        good[page.parents[k]] += good[k]
        bad[page.parents[k]] += bad[k]
    x, _ = node_features(page)
    pick = [k for k in range(1, n) if (good[k] > 0) != (bad[k] > 0)]
    return x[pick], np.array([good[k] > 0 for k in pick], float)


@functools.lru_cache(maxsize=2)
def trained(n_pages=1500, n_trees=60, depth=5) -> Trees:
    rows = [r for s in range(n_pages) if (r := labelled(training_page(s))) is not None and len(r[1])]
    return fit(np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), n_trees, depth)


def extract_many(sources: list[str], trees: Trees, cost=SWITCH_COST) -> list[list[str]]:
    """The kept blocks of every page, in page order."""
    pages = []
    for s in sources:
        page = Page(s)
        without_hidden(page)
        pages.append(page)
    made = [node_features(p) for p in pages]
    logits = trees.logit(np.concatenate([x for x, _ in made])) if made else np.zeros(0)
    out, at = [], 0
    for page, (x, own) in zip(pages, made, strict=True):
        kept = decode(page, logits[at : at + len(x)], own, cost)
        at += len(x)
        out.append([text for node, text, _ in page.blocks if kept[node]])
    return out


SCHEMA = "page_id bigint, url string, text string, n_chars bigint, n_blocks bigint"


def extract_pages(pages: DataFrame, page_id="page_id", url="url", html="html", trees: Trees | None = None) -> DataFrame:
    """One row per page: its main text, blocks joined by an empty line."""
    model = trees or trained()
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))

    def run(batch):
        for part in slices(batch, 2):
            blocks = extract_many(strings(part.column(2)).to_pylist(), model)
            joined = ["\n\n".join(b) for b in blocks]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(joined, pa.string()), pa.array(list(map(len, joined)), pa.int64()), pa.array(list(map(len, blocks)), pa.int64())],
                [c.split()[0] for c in SCHEMA.split(", ")],
            )

    return batches(texts(rows, "page_id", "url", "html"), run, SCHEMA)
