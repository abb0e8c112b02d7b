"""A tolerant HTML reader: block elements as a tree, with the text that stands in each."""

from __future__ import annotations

import html as html_lib
import re

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var nobr ruby rb rp rt output picture object"
    " math mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle merror mpadded mphantom menclose msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mtd maction semantics annotation annotation-xml".split()
)
# A drawing ends with its end tag or, as in browsers, where one of these HTML elements starts.
DRAWING_END = re.compile(
    r"</svg(?=[\s/>])[^>]*+>|(?=<(?:b|big|blockquote|body|br|center|code|dd|div|dl|dt|em|embed|h[1-6]|head|hr|i|img|li|listing|menu|meta|nobr|ol|p|pre|ruby|s|small|span|strong|strike|sub|sup|table|tt|u|ul|var)[\s/>])",
    re.IGNORECASE,
)
# Start tags that end an open paragraph, fixed values of the HTML standard.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul dd dt tr td th tbody thead tfoot body".split()
)
# An open element of the key's list ends where the key starts, looked for up to one of the stops.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select", "datalist")),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
}
SCOPE = ("table", "td", "th", "body", "html")
# End tags that may close an element beyond such a scope.
STRUCTURE = frozenset("body html table tr tbody thead tfoot".split())

TAG = re.compile(
    r"""<(?:!--(?:>|->|.*?(?:-->|--!>|\Z))|[!?][^>]*+(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>)""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""(?:^|[\s/])(class|id|role|itemprop|aria-label)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.IGNORECASE)
ANY_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
NOT_SHOWN = re.compile(r"display\s*:\s*none", re.IGNORECASE)


class Page:
    """tag, parent, attributes (raw) of each node in page order; blocks: (node, text, link characters)."""

    __slots__ = ("tags", "parents", "attributes", "blocks")

    def __init__(self, source: str):
        self.tags, self.parents, self.attributes = ["root"], [-1], [""]
        self.blocks: list[tuple[int, str, int]] = []
        stack, parts, links, in_link = [0], [], 0, False
        places: dict[str, list[int]] = {}  # by tag, where in the stack its open elements are
        at, n, tags = 0, len(source), self.tags

        def flush():
            nonlocal parts, links
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    self.blocks.append((stack[-1], text, min(links, len(text))))
                parts, links = [], 0

        def last(names):
            """Where in the stack the innermost open element of these names is, or 0."""
            return max((places[t][-1] for t in names if places.get(t)), default=0)

        def close(k):
            """Close the open elements from place k of the stack on."""
            for node in stack[k:]:
                places[tags[node]].pop()
            del stack[k:]

        while at < n:
            lt = source.find("<", at)
            if lt < 0:
                lt = n
            m = TAG.match(source, lt) if lt < n else None
            while lt < n and m is None:  # a < that starts no tag is text
                lt = source.find("<", lt + 1)
                lt = n if lt < 0 else lt
                m = TAG.match(source, lt) if lt < n else None
            if lt > at:
                # Each piece for itself: a reference does not run over a tag.
                piece = html_lib.unescape(source[at:lt])
                parts.append(piece)
                if in_link:
                    links += len(piece)
            if m is None:
                break
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name = name.lower()
            if m[1] or m[4]:
                if name == "a":
                    in_link = False
                if name in INLINE or name in VOID:
                    if name == "br":
                        parts.append(" ")
                    continue
                k = last((name,))
                if k and (name in STRUCTURE or k >= last(SCOPE)):
                    flush()
                    close(k)
                continue
            if name == "svg":
                if not (m[3] or m[6] or "").endswith("/"):
                    end = DRAWING_END.search(source, at)
                    at = end.end() if end else at
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(source, at)
                after = source.find(">", end.end()) if end else -1
                at = after + 1 if after >= 0 else n
                continue
            if name in INLINE:
                if name == "a":
                    in_link = True
                continue
            if name in VOID:
                if name in ("br", "wbr", "img", "hr", "input"):
                    if name == "hr":
                        flush()
                    elif name != "wbr":
                        parts.append(" ")
                continue
            flush()
            if name in ENDS_P and (k := last(("p",))) > last(SCOPE):
                close(k)
            if name in SIBLINGS:
                closes, stops = SIBLINGS[name]
                if (k := last(closes)) > last(stops):
                    close(k)
            if name in ("html", "body") and name in tags[:4]:
                continue
            tags.append(name)
            self.parents.append(stack[-1])
            self.attributes.append(m[3] or m[6] or "")
            places.setdefault(name, []).append(len(stack))
            stack.append(len(tags) - 1)
        flush()


def is_hidden(raw: str) -> bool:
    """Whether the attributes hide an element: by the attribute hidden, or by its style."""
    for m in ANY_ATTRIBUTE.finditer(raw):
        name = m[1].lower()
        if name == "hidden" or name == "style" and NOT_SHOWN.search(m[2] or m[3] or m[4] or ""):
            return True
    return False


def attribute_text(raw: str) -> str:
    """Values of the attributes that say what an element is for, in lower case."""
    if not raw:
        return ""
    values = " ".join(m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw))
    return re.sub(r"(?<=[a-z])(?=[A-Z])", " ", values).lower()
