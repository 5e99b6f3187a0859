"""Labelled pages the block model is trained on.

Pages of many layouts are composed from invented words; every block is
written with its label, so labels never depend on the model or on data.  The
layouts vary container elements, class and id names, roles, nesting, closing
tags, block lengths and links, for the article as well as for menus, headers,
footers, sidebars, notices, adverts, forms and reader comments.
"""

from __future__ import annotations

import random

SYLLABLES = ["ka", "lor", "mi", "ten", "sa", "ru", "vel", "do", "an", "er", "is", "qua", "po", "ne", "tri", "ul"]
#: Usual class and id names of each part of a page.
MAIN = ["content", "article", "article-body", "post", "post-content", "entry", "entry-content", "story",
        "story-body", "main", "main-content", "text", "body-text", "page-content", "post-body", "blog-post", "prose",
        "news-article", "rich-text", "single"]
NAV = ["nav", "menu", "navbar", "main-menu", "navigation", "breadcrumb", "breadcrumbs", "topnav", "links", "toc-menu",
       "pagination", "pager", "submenu", "skip-link", "tabs"]
HEADER = ["header", "site-header", "masthead", "top", "topbar", "banner", "branding", "logo", "tagline",
          "page-header", "brand"]
FOOTER = ["footer", "site-footer", "bottom", "copyright", "legal", "colophon", "imprint",
          "page-footer", "credits"]
SIDE = ["sidebar", "side", "aside", "widget", "related", "recommended", "rail", "popular", "more-stories", "teaser",
        "secondary", "see-also", "trending", "latest", "widget-area"]
AD = ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "banner-ad", "sponsor",
      "commercial", "leaderboard", "promo-box", "adsbox"]
NOTICE = ["cookie", "cookie-notice", "notice", "consent", "gdpr", "alert", "popup", "modal", "newsletter", "subscribe",
          "cookie-banner", "overlay", "privacy-notice", "announcement", "paywall", "disclaimer", "toast", "cookie-bar"]
FORM = ["form", "search", "search-form", "login", "signup", "contact-form", "comment-form"]
COMMENT = ["comments", "comment", "comment-list", "discussion", "replies", "reader-comments", "respond", "reviews",
           "user-comments", "comment-section", "responses", "thread", "feedback"]
SHARE = ["share", "social", "sharing", "share-buttons", "tags", "meta-links"]


class Page:
    """Composes one page; ``blocks`` gets (text, label) in page order."""

    def __init__(self, rng: random.Random):
        self.rng = rng
        self.blocks: list[tuple[str, int]] = []

    def words(self, low: int, high: int) -> str:
        r = self.rng
        n = r.randint(low, high)
        out = []
        for k in range(n):
            w = "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 3)))
            out.append(w.capitalize() if k == 0 or out[-1].endswith(".") else w)
            if k < n - 1 and r.random() < 0.12:
                out[-1] += r.choice([",", ".", ","])
        return " ".join(out) + (r.choice([".", ".", "!", "", "?"]) if n > 3 else r.choice(["", "", "."]))

    def block(self, tag: str, low: int, high: int, label: int, links: float = 0.0) -> str:
        text = self.words(low, high)
        self.blocks.append((text, label))
        r = self.rng
        if r.random() < links:
            inner = f'<a href="/{r.randint(1, 999)}">{text}</a>'
        elif r.random() < 0.15:
            inner = f"<{(t := r.choice(['b', 'em', 'span', 'strong']))}>{text}</{t}>"
        else:
            inner = text
        close = "" if tag in ("p", "li") and r.random() < 0.15 else f"</{tag}>"
        return f"<{tag}>{inner}{close}"

    def holder(self, tags: list[str], names: list[str], inner: str, named: float = 0.8, role: str = "") -> str:
        r = self.rng
        tag = r.choice(tags)
        plain = tag not in ("div", "section", "ul", "span", "p")
        attr = ""
        if not plain or r.random() < 0.4:
            if r.random() < named or not plain:
                attr += f' {r.choice(["class", "class", "id"])}="{r.choice(names)}"'
        if role and r.random() < 0.2:
            attr += f' role="{role}"'
        return f"<{tag}{attr}>{inner}</{tag}>"

    def menu(self) -> str:
        r = self.rng
        items = "".join(self.block("li", 1, 3, 0, 0.95) for _ in range(r.randint(2, 7)))
        return self.holder(["nav", "nav", "div", "ul"], NAV, f"<ul>{items}</ul>", role="navigation")

    def header(self) -> str:
        r = self.rng
        inner = self.block(r.choice(["div", "p", "h1", "h2", "span"]), 1, 6, 0, 0.4)
        if r.random() < 0.5:
            inner += self.block("p", 2, 12, 0)
        return self.holder(["header", "header", "div"], HEADER, inner, role="banner")

    def footer(self) -> str:
        r = self.rng
        inner = ""
        if r.random() < 0.3:
            inner = "&copy; " + self.words(1, 20)
            self.blocks.append((inner, 0))
        inner += "".join(self.block(r.choice(["p", "div", "li"]), 1, 25, 0, 0.3) for _ in range(r.randint(0, 3)))
        return self.holder(["footer", "footer", "div"], FOOTER, inner, role="contentinfo")

    def side(self) -> str:
        r = self.rng
        inner = self.block(r.choice(["h2", "h3", "h4"]), 1, 5, 0) if r.random() < 0.6 else ""
        inner += "".join(self.block(r.choice(["li", "p", "div"]), 2, 40, 0, 0.5) for _ in range(r.randint(1, 5)))
        return self.holder(["aside", "aside", "div", "section"], SIDE, inner, role="complementary")

    def advert(self) -> str:
        r = self.rng
        if r.random() < 0.6:
            text = self.words(1, 40)
            self.blocks.append((text, 0))
            return self.holder(["div", "div", "section", "p"], AD, text)
        return self.holder(["div", "aside"], AD, self.block("p", 1, 40, 0, 0.4))

    def notice(self) -> str:
        r = self.rng
        inner = self.block("p", 4, 40, 0)
        if r.random() < 0.6:
            inner += self.block("button", 1, 2, 0)
        return self.holder(["div", "section", "aside"], NOTICE, inner, role="dialog")

    def form(self) -> str:
        r = self.rng
        inner = self.block("p", 3, 25, 0) if r.random() < 0.5 else ""
        inner += "".join(self.block("label", 1, 4, 0) + "<input type=text>" for _ in range(r.randint(1, 3)))
        inner += self.block("button", 1, 2, 0)
        attr = f' class="{r.choice(FORM)}"' if r.random() < 0.5 else ""
        return f"<form{attr}>{inner}</form>"

    def comments(self) -> str:
        r = self.rng
        inner = self.block(r.choice(["h2", "h3"]), 1, 3, 0) if r.random() < 0.6 else ""
        for _ in range(r.randint(1, 5)):
            own = self.block("div", 1, 3, 0) if r.random() < 0.4 else ""
            own += self.block(r.choice(["p", "p", "div"]), 2, 70, 0)
            inner += self.holder(["div", "li", "article"], COMMENT, own)
        return self.holder(["div", "section", "ul"], COMMENT, inner, named=1.0)

    def share(self) -> str:
        inner = "".join(self.block("li", 1, 2, 0, 0.9) for _ in range(self.rng.randint(2, 4)))
        return self.holder(["div", "ul"], SHARE, inner)

    def article(self) -> str:
        r = self.rng
        parts = []
        holder = r.random()
        if r.random() < 0.8:
            title = self.block(r.choice(["h1", "h1", "h2"]), 1 if r.random() < 0.2 else 2, 12, 1)
            # a header element is the article's own only inside an article or main element
            parts.append(f"<header>{title}</header>" if holder < 0.58 and r.random() < 0.25 else title)
        for _ in range(r.randint(1, 9)):
            kind = r.random()
            if kind < 0.58:
                parts.append(self.block("p", 1, 14, 1) if r.random() < 0.3 else self.block("p", 10, 110, 1, 0.03))
            elif kind < 0.66:
                parts.append(self.block(r.choice(["h2", "h3"]), 1, 8, 1))
            elif kind < 0.74:
                items = "".join(self.block("li", 2, 25, 1) for _ in range(r.randint(1, 4)))
                parts.append(f"<ul>{items}</ul>")
            elif kind < 0.78:
                parts.append(f"<blockquote>{self.block('p', 6, 50, 1)}</blockquote>")
            elif kind < 0.81:
                parts.append(self.block("pre", 3, 30, 1))
            elif kind < 0.84:
                parts.append("<table><tr>" + "".join(self.block("td", 1, 6, 1) for _ in range(3)) + "</tr></table>")
            elif kind < 0.88:
                parts.append(f"<figure><img src=i.png>{self.block('figcaption', 2, 20, 1)}</figure>")
            else:
                parts.append(r.choice([self.advert, self.share, self.side, self.notice, self.form])())
        inner = "".join(parts)
        if holder < 0.38:
            return f"<article>{inner}</article>"
        if holder < 0.58:
            return f"<main>{inner}</main>" if r.random() < 0.6 else f"<main><article>{inner}</article></main>"
        if holder < 0.86:
            return self.holder(["div", "section"], MAIN, inner, named=1.0)
        return f"<div>{inner}</div>" if holder < 0.92 else inner

    def compose(self) -> str:
        r = self.rng
        parts = []
        bare = r.random() < 0.15                # hardly anything beside the article
        for part, share in ((self.notice, 0.25), (self.header, 0.5), (self.menu, 0.8), (self.advert, 0.4),
                            (self.side, 0.15)):
            if r.random() < share and not bare:
                parts.append(part())
        parts.append(self.article())
        for part, share in ((self.share, 0.2), (self.advert, 0.25), (self.comments, 0.4), (self.side, 0.35),
                            (self.form, 0.3), (self.notice, 0.15), (self.footer, 0.8)):
            if r.random() < (share / 2 if bare else share):
                parts.append(part())
        head = "<head><title>" + self.words(2, 8) + "</title><style>p{margin:0}</style></head>"
        wrap = r.random()
        body = "".join(parts)
        if wrap < 0.25:
            body = f'<div id="{r.choice(["page", "wrapper", "container", "site"])}">{body}</div>'
        return f"<!DOCTYPE html><html>{head}<body>{body}</body></html>"


def labelled_pages(count: int, seed: int = 5) -> list[tuple[str, list[tuple[str, int]]]]:
    """(html, [(block text, label)]) of ``count`` pages."""
    out = []
    for k in range(count):
        page = Page(random.Random(seed * 1_000_003 + k))
        html = page.compose()
        out.append((html, page.blocks))
    return out
