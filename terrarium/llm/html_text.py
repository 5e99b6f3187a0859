"""Main text of HTML pages by a linear-chain conditional random field.

A page is read once into its leaf blocks: stretches of text between block
elements, each with the elements it stands in.  A two-label chain (article or
not) over the blocks uses features of the ancestors (element names, words of
class, id and role) and of the text (length, links, punctuation), and
is decoded by Viterbi.  It is trained on labelled pages (``html_pages``) by
gradient steps on the exact conditional likelihood (forward-backward).

Scripts, styles, templates, comments and the head never give text; the head
ends with its end tag or where something begins that it cannot hold.  Embedded
formulas, drawings and objects give their text like any other.  Character
references are decoded; white space inside a block becomes one space; a line
break element is white space.  Unclosed comments and raw elements reach to the
end of the page, as in browsers; unclosed paragraphs, list items, cells and
the like end where the next one starts.

Rows: null, empty and markup-free empty pages give an empty text; text outside
any element is a block; repeated rows get equal texts; an empty table gives an
empty result.  Pages of any length are read in one pass.  Ties in decoding
count as article.  Columns that are not asked for are ignored, whatever their
names.
"""

from __future__ import annotations

import functools
import html as entities
import math
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from terrarium.llm.common import map_texts
from terrarium.llm.html_pages import labelled_pages

TRAIN_PAGES, EPOCHS, RATE = 1000, 16, 0.4
#: Elements of HTML by the way they are read.
RAW = {"script", "style", "template", "iframe", "head", "title", "textarea", "select", "noframes", "noembed", "xmp"}
#: Elements that a head holds; any other ends it, and so does text.
HEAD = {"base", "basefont", "bgsound", "head", "link", "meta", "noscript", "script", "style", "template", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
          "tt", "u", "var", "wbr", "ruby", "rt", "rp", "nobr", "br", "link", "meta",
          # embedded content, whose text is part of the block around it
          "noscript", "object", "canvas", "audio", "video", "svg", "g", "text", "tspan", "path", "defs", "use", "desc",
          "math", "mi", "mn", "mo", "ms", "mtext", "mrow", "msup", "msub", "msubsup", "mfrac", "msqrt", "mroot",
          "mover", "munder", "munderover", "mfenced", "mspace", "mstyle", "semantics", "annotation"}
#: An element of the key ends open ones of the values, up to a boundary.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
BOUNDARY = {"ul", "ol", "dl", "table", "select", "body"}
#: Content of these is not parsed; the others of RAW nest and are skipped as elements.
UNPARSED = "script|style|textarea|title|iframe|noembed|noframes|xmp"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + UNPARSED + r")\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<[/!?][^>]*>"
    r"|<[a-zA-Z][^>]*>", re.S | re.I)
ATTR = re.compile(r"(class|id|role|hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
NAME = re.compile(r"[a-z]+")
ADDED = T.StructType([T.StructField("main_text", T.StringType())])


@dataclass
class Block:
    text: str
    tag: str                       # the innermost block element
    inside: tuple[str, ...]        # features of all elements around, outermost first
    linked: int                    # characters inside links


@functools.lru_cache(maxsize=20_000)
def _element(tag: str, attrs: str) -> tuple[str, ...]:
    """Features of an element: its name and the words of its attributes."""
    found = ["e=" + tag]
    if attrs:
        for m in ATTR.finditer(attrs):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name == "hidden" or name == "style":
                if name == "hidden" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                    found.append("hidden")
            else:
                found += ["n=" + w for w in NAME.findall(value)]
    return tuple(dict.fromkeys(found))


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page, in order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    text: list[str] = []
    linked = links = skipped = 0

    def flush() -> None:
        nonlocal linked
        joined = " ".join("".join(text).split())
        if joined:
            tag = next((t for t, _ in reversed(stack) if t not in INLINE), "")
            inside = tuple(dict.fromkeys(f for _, own in stack for f in own))
            out.append(Block(joined, tag, inside, min(linked, len(joined))))
        text.clear()
        linked = 0

    def add(part: str) -> None:
        nonlocal linked
        if part and not skipped:
            part = entities.unescape(part) if "&" in part else part
            text.append(part)
            if links:
                linked += len(part)

    def close(to: int) -> None:
        """Closes all elements from the place ``to`` of the stack on."""
        nonlocal links, skipped
        if any(t not in INLINE for t, _ in stack[to:]):
            flush()
        for t, _ in stack[to:]:
            links -= t == "a"
            skipped -= t in RAW
        del stack[to:]

    def leave_head() -> None:
        place = next((k for k, (t, _) in enumerate(stack) if t == "head"), -1)
        if place >= 0:
            close(place)

    at, page = 0, page or ""
    for m in TOKEN.finditer(page):
        if stack and stack[-1][0] == "head" and page[at:m.start()].strip():
            leave_head()
        add(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"]:
            place = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), -1)
            if place >= 0:
                close(place)
            elif tag == "p":
                flush()
            continue
        if tag not in HEAD:
            leave_head()
        if tag == "br":
            add(" ")
            continue
        if tag not in INLINE:
            # an open paragraph ends before any block, and items end before their like
            ended = {"p"} | ENDS.get(tag, set())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ended:
                    close(k)
                    if not ENDS.get(tag):
                        break
                elif stack[k][0] in BOUNDARY or (stack[k][0] not in INLINE and tag not in ENDS):
                    break
            flush()
        if tag in VOID or m["attrs"].endswith("/") and tag in RAW:
            continue
        stack.append((tag, _element(tag, m["attrs"])))
        links += tag == "a"
        skipped += tag in RAW
    if stack and stack[-1][0] == "head":
        leave_head()
    add(page[at:])
    flush()
    return out


def block_features(found: list[Block]) -> list[list[str]]:
    """Features of every block of a page."""
    out = []
    has_body = any(f in MAIN for b in found for f in b.inside)
    for b in found:
        words = b.text.count(" ") + 1
        size = min(6, int(math.log2(words)))
        share = min(3, 4 * b.linked // max(1, len(b.text)))
        feats = ["bias", "tag=" + b.tag, f"size={size}", f"links={share}", *b.inside]
        feats.append("ends" if b.text[-1] in ".!?…。\"'”»" else "open")
        feats.append(f"size={size} links={share}")
        if "©" in b.text:
            feats.append("copyright")
        if has_body and not any(f in MAIN for f in b.inside):
            feats.append("outside")          # of the element that holds the article
        # the nearest element that says what this part of the page is
        near = [f for f in b.inside if f in SECTIONS]
        inner = near[-1] if near else "none"
        feats += ["section=" + inner, f"section={inner} tag={b.tag}", "sections=" + ">".join(near[-2:])]
        out.append(feats)
    return out


#: Elements that name a part of a page.
SECTIONS = {"e=article", "e=main", "e=nav", "e=header", "e=footer", "e=aside", "e=form", "e=button"}
#: Elements that hold an article.
MAIN = {"e=article", "e=main"}


@dataclass
class Model:
    """Weights of the features for label 1, moves between labels, and the
    first label's scores."""

    weights: dict[str, float] = field(default_factory=dict)
    moves: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])
    start: list[float] = field(default_factory=lambda: [0.0, 0.0])


def _add(a: float, b: float) -> float:
    top = max(a, b)
    return top + math.log1p(math.exp(min(a, b) - top))


def marginals(model: Model, scores: list[float]) -> tuple[list[float], list[list[list[float]]], float]:
    """P(label 1) of every block, P(both labels) of neighbours, and the log of
    the normaliser, by forward-backward."""
    n, a = len(scores), model.moves
    node = [[0.0, s] for s in scores]
    ahead = [[model.start[0] + node[0][0], model.start[1] + node[0][1]]]
    for k in range(1, n):
        ahead.append([_add(ahead[-1][0] + a[0][y], ahead[-1][1] + a[1][y]) + node[k][y] for y in (0, 1)])
    back = [[0.0, 0.0]]
    for k in range(n - 1, 0, -1):
        back.append([_add(a[y][0] + node[k][0] + back[-1][0], a[y][1] + node[k][1] + back[-1][1]) for y in (0, 1)])
    back.reverse()
    total = _add(ahead[-1][0], ahead[-1][1])
    ones = [math.exp(ahead[k][1] + back[k][1] - total) for k in range(n)]
    pairs = [[[math.exp(ahead[k][y] + a[y][z] + node[k + 1][z] + back[k + 1][z] - total) for z in (0, 1)]
              for y in (0, 1)] for k in range(n - 1)]
    return ones, pairs, total


def viterbi(model: Model, scores: list[float]) -> list[int]:
    """The likeliest labels; ties count as 1."""
    if not scores:
        return []
    a = model.moves
    best = [model.start[0], model.start[1] + scores[0]]
    came: list[tuple[int, int]] = []
    for s in scores[1:]:
        step = tuple(int(best[1] + a[1][y] >= best[0] + a[0][y]) for y in (0, 1))
        best = [best[step[0]] + a[step[0]][0], best[step[1]] + a[step[1]][1] + s]
        came.append(step)
    y = int(best[1] >= best[0])
    out = [y]
    for step in reversed(came):
        y = step[y]
        out.append(y)
    return out[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS, rate: float = RATE,
          penalty: float = 1e-4) -> Model:
    """Gradient steps, a page at a time, with a rate for each weight that
    falls with its squared gradients."""
    model = Model()
    seen: dict = {}

    def move(key, value: float, gradient: float) -> float:
        gradient -= penalty * value
        seen[key] = seen.get(key, 1e-6) + gradient * gradient
        return value + rate * gradient / math.sqrt(seen[key])

    for _ in range(epochs):
        for feats, labels in pages:
            if not feats:
                continue
            w = model.weights
            scores = [sum(w.get(f, 0.0) for f in own) for own in feats]
            ones, pairs, _ = marginals(model, scores)
            gradient: dict[str, float] = {}
            for own, y, p in zip(feats, labels, ones):
                for f in own:
                    gradient[f] = gradient.get(f, 0.0) + y - p
            for f, g in gradient.items():
                w[f] = move(f, w.get(f, 0.0), g)
            for y in (0, 1):
                first = (labels[0] == y) - (ones[0] if y else 1 - ones[0])
                model.start[y] = move(("start", y), model.start[y], first)
                for z in (0, 1):
                    g = sum((u == y and v == z) - p[y][z] for u, v, p in zip(labels, labels[1:], pairs))
                    model.moves[y][z] = move((y, z), model.moves[y][z], g)
    return model


def labelled(pages) -> list[tuple[list[list[str]], list[int]]]:
    """Features and labels of pages with labelled block texts."""
    out = []
    for page, known in pages:
        found = blocks(page)
        texts = [" ".join(entities.unescape(t).split()) for t, _ in known]
        if [b.text for b in found] != texts:
            raise ValueError("the labelled blocks are not those of the page")
        out.append((block_features(found), [y for _, y in known]))
    return out


def fit(pages: int = TRAIN_PAGES) -> Model:
    return train(labelled(labelled_pages(pages)))


def main_text(model: Model, page: str | None) -> str:
    found = blocks(page)
    w = model.weights
    scores = [sum(w.get(f, 0.0) for f in own) for own in block_features(found)]
    return "\n\n".join(b.text for b, y in zip(found, viterbi(model, scores)) if y)


def extract(pages: DataFrame, model: Model, keep: list[str], html: str = "html") -> DataFrame:
    """``keep`` columns plus ``main_text`` of every page."""
    return map_texts(pages, html, keep, ADDED, lambda values: {"main_text": [main_text(model, v) for v in values]})
