"""Labelled pages for the extraction model, built by rule.

No labelled pages come with the data, so pages are composed from parts whose
role is known: an article, and around and inside it menus, headers, footers,
sidebars, notices, adverts, forms, share bars and reader comments, each under
tags and names usual for its role, with invented words as text.
"""

from __future__ import annotations

import random

PAGES = 1000
_SYLLABLES = "an be chi do el fa go hu is ja ka le mo ne or pu ra si ta un ve wo xi yo zu tion ing er ou".split()
#: Names under which roles usually appear as class or id.
_NAMES = {
    "menu": "nav navbar menu topnav breadcrumb breadcrumbs navigation pagination toc tabs",
    "header": "header masthead site-header top-bar logo branding banner-top",
    "footer": "footer site-footer copyright bottom legal colophon imprint",
    "sidebar": "sidebar side-bar widget related related-posts recommended popular trending tags more-stories rail",
    "notice": "cookie cookie-banner consent gdpr notice alert popup modal newsletter subscribe paywall disclaimer",
    "advert": "ad ads advert advertisement sponsored promo promotion ad-slot banner adsbygoogle",
    "share": "share social share-buttons follow-us author-links",
    "comments": "comments comment-list discussion replies disqus responses comment-section reader-comments",
    "content": "content post entry entry-content article article-body story story-body post-content main-text text "
               "page-content body-text",
}


class _Page:
    def __init__(self, rng: random.Random):
        self.rng, self.html, self.ranges, self.kept = rng, "", [], False

    def raw(self, s: str) -> None:
        self.html += s

    def text(self, s: str) -> None:
        if self.kept:
            self.ranges.append((len(self.html), len(self.html) + len(s)))
        self.html += s

    def name(self, role: str) -> str:
        pick = self.rng.choice(_NAMES[role].split())
        return self.rng.choice([f' class="{pick}"', f' id="{pick}"', f' class="block {pick}"'])


def _words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


def _prose(rng: random.Random, sentences: int) -> str:
    out = []
    for _ in range(sentences):
        s = _words(rng, rng.choice([1, 3, 6, 9, 14, 20]))
        out.append(s[:1].upper() + s[1:] + rng.choice([".", ".", ".", "!", "?"]))
    return " ".join(out)


def _links(p: _Page, n: int, listed: bool) -> None:
    for _ in range(n):
        p.raw("<li>" if listed else "")
        p.raw('<a href="/x">')
        p.text(_words(p.rng, p.rng.choice([1, 1, 2, 5])))
        p.raw("</a>" + ("</li>" if listed else " "))


def _menu(p: _Page, role: str = "menu") -> None:
    tag = p.rng.choice(["nav", "nav", "div", "ul"])
    p.raw(f"<{tag}{p.name(role) if tag != 'nav' or p.rng.random() < 0.4 else ''}>")
    listed = p.rng.random() < 0.7
    p.raw("<ul>" if listed and tag != "ul" else "")
    _links(p, p.rng.randint(2, 9), listed or tag == "ul")
    p.raw("</ul>" if listed and tag != "ul" else "")
    p.raw(f"</{tag}>")


def _header(p: _Page) -> None:
    tag = p.rng.choice(["header", "header", "div"])
    p.raw(f"<{tag}{p.name('header') if tag == 'div' or p.rng.random() < 0.4 else ''}>")
    inner = p.rng.choice(["div", "p", "h1", "h2", "span"])
    p.raw(f"<{inner}>")
    p.text(_words(p.rng, p.rng.randint(1, 6)))
    p.raw(f"</{inner}>")
    if p.rng.random() < 0.5:
        _menu(p)
    p.raw(f"</{tag}>")


def _footer(p: _Page) -> None:
    tag = p.rng.choice(["footer", "footer", "div"])
    p.raw(f"<{tag}{p.name('footer') if tag == 'div' or p.rng.random() < 0.3 else ''}>")
    inner = p.rng.choice(["", "p", "div"])
    p.raw(f"<{inner}>" if inner else "")
    p.text(p.rng.choice(["&copy; ", "Copyright 2024 ", ""]) + _words(p.rng, 2) + p.rng.choice([" &middot; ", ". "])
           + _prose(p.rng, p.rng.randint(1, 3)))
    p.raw(f"</{inner}>" if inner else "")
    if p.rng.random() < 0.3:
        _menu(p, "footer")
    p.raw(f"</{tag}>")


def _sidebar(p: _Page) -> None:
    tag = p.rng.choice(["aside", "aside", "div", "section"])
    p.raw(f"<{tag}{p.name('sidebar') if tag != 'aside' or p.rng.random() < 0.4 else ''}>")
    if p.rng.random() < 0.6:
        p.raw("<h3>")
        p.text(_words(p.rng, 2))
        p.raw("</h3>")
    if p.rng.random() < 0.6:
        p.raw("<ul>")
        _links(p, p.rng.randint(2, 6), True)
        p.raw("</ul>")
    else:
        p.raw("<p>")
        p.text(_prose(p.rng, p.rng.randint(1, 4)))
        p.raw("</p>")
    p.raw(f"</{tag}>")


def _boxed(p: _Page, role: str) -> None:
    """Notices, adverts and share bars: a named box with a little text."""
    tag = p.rng.choice(["div", "div", "div", "section", "p", "aside"])
    p.raw(f"<{tag}{p.name(role)}>")
    inner = p.rng.choice(["", "", "p", "div", "span"]) if tag != "p" else ""
    p.raw(f"<{inner}>" if inner else "")
    if role == "share" or p.rng.random() < 0.2:
        _links(p, p.rng.randint(1, 4), False)
    else:
        p.text(_prose(p.rng, p.rng.randint(1, 4)))
    p.raw(f"</{inner}>" if inner else "")
    if role == "notice" and p.rng.random() < 0.4:
        p.raw("<button>")
        p.text(_words(p.rng, 1))
        p.raw("</button>")
    p.raw(f"</{tag}>")


def _form(p: _Page) -> None:
    p.raw("<form action='/go'>")
    for _ in range(p.rng.randint(1, 4)):
        p.raw(p.rng.choice(["<label>", "<p>", "<div>"]))
        p.text(_words(p.rng, p.rng.randint(1, 8)))
        p.raw("<input name='q'>")
    p.raw("<button>")
    p.text(_words(p.rng, 1))
    p.raw("</button></form>")


def _comments(p: _Page) -> None:
    tag = p.rng.choice(["section", "div", "ol", "ul"])
    p.raw(f"<{tag}{p.name('comments')}>")
    if p.rng.random() < 0.5 and tag in ("section", "div"):
        p.raw("<h3>")
        p.text(_words(p.rng, 2))
        p.raw("</h3>")
    item = "li" if tag in ("ol", "ul") else p.rng.choice(["div", "article", "blockquote"])
    for _ in range(p.rng.randint(1, 5)):
        p.raw(f'<{item} class="{p.rng.choice(["comment", "comment-body", "reply", "user-comment"])}">')
        if p.rng.random() < 0.6:
            p.raw("<b>")
            p.text(_words(p.rng, 1) + " ")
            p.raw("</b>")
        inner = p.rng.choice(["p", "div", ""])
        p.raw(f"<{inner}>" if inner else "")
        p.text(_prose(p.rng, p.rng.randint(1, 5)))
        p.raw(f"</{inner}>" if inner else "")
        p.raw(f"</{item}>")
    p.raw(f"</{tag}>")


def _article(p: _Page) -> None:
    rng = p.rng
    tag = rng.choice(["article", "article", "main", "div", "div", "section"])
    p.raw(f"<{tag}{p.name('content') if tag not in ('article', 'main') or rng.random() < 0.4 else ''}>")
    inner = rng.random() < 0.25
    p.raw(f"<div{p.name('content') if rng.random() < 0.6 else ''}>" if inner else "")
    p.kept = True
    if rng.random() < 0.85:
        level = rng.choice(["h1", "h1", "h2"])
        boxed = rng.random() < 0.15
        p.raw(("<header>" if boxed else "") + f"<{level}>")
        title = _words(rng, rng.randint(1, 12))
        p.text(rng.choice([title, title[:1].upper() + title[1:] + ".", " ".join([title.split()[0]] * 12)]))
        p.raw(f"</{level}>" + ("</header>" if boxed else ""))
    for _ in range(rng.choice([0, 1, 1, 2, 4, 8, 14])):
        kind = rng.random()
        if kind < 0.72:
            p.raw(rng.choice(["<p>", "<p>", '<p class="lead">', "<p><b>"]))
            if rng.random() < 0.05:  # running text without sentences, repeated words
                p.text(" ".join([_words(rng, rng.randint(1, 4))] * rng.choice([3, 20, 200])))
            p.text(_prose(rng, rng.choice([1, 1, 2, 4, 9, 9, 30])))
            p.raw(rng.choice(["</p>", "</p>", "</p>", "<br>"]))
        elif kind < 0.80:
            p.raw("<h2>")
            p.text(_words(rng, rng.randint(1, 6)))
            p.raw("</h2>")
        elif kind < 0.88:
            p.raw("<ul>")
            for _ in range(rng.randint(1, 5)):
                p.raw("<li>")
                p.text(_words(rng, rng.randint(1, 12)))
                p.raw("</li>")
            p.raw("</ul>")
        elif kind < 0.92:
            p.raw("<blockquote>")
            p.text(_prose(rng, 2))
            p.raw("</blockquote>")
        elif kind < 0.95:
            p.raw("<table><tr>")
            for _ in range(4):
                p.raw("<td>")
                p.text(_words(rng, 2))
                p.raw("</td>")
            p.raw("</tr></table>")
        elif kind < 0.97:
            p.raw("<p>")
            p.text(_prose(rng, 1) + " ")
            p.raw('<a href="/y">')
            p.text(_words(rng, 3))
            p.raw("</a>")
            p.text(" " + _prose(rng, 2))
            p.raw("</p>")
        else:
            p.kept = False
            rng.choice([lambda: _boxed(p, "advert"), lambda: _boxed(p, "share"), lambda: _sidebar(p),
                        lambda: _boxed(p, "notice")])()
            p.kept = True
    p.kept = False
    if rng.random() < 0.15:
        _comments(p)
    p.raw("</div>" if inner else "")
    p.raw(f"</{tag}>")


def _page(rng: random.Random) -> tuple[str, list[tuple[int, int]]]:
    p = _Page(rng)
    p.raw("<!DOCTYPE html><html><head><title>x</title></head><body>")
    wrapped = rng.random() < 0.3
    p.raw('<div id="page">' if wrapped else "")
    around = [lambda: _menu(p), lambda: _boxed(p, "notice"), lambda: _boxed(p, "advert"), lambda: _sidebar(p),
              lambda: _form(p), lambda: _boxed(p, "share")]
    if rng.random() < 0.6:
        _header(p)
    for part in rng.sample(around, rng.randint(0, 4)):
        part()
    _article(p)
    if rng.random() < 0.45:
        _comments(p)
    for part in rng.sample(around, rng.randint(0, 4)):
        part()
    if rng.random() < 0.8:
        _footer(p)
    p.raw("</div>" if wrapped else "")
    p.raw("</body></html>")
    return p.html, p.ranges


def labelled_pages(pages: int = PAGES, seed: int = 17) -> list[tuple[str, list[tuple[int, int]]]]:
    """(html, ranges of main text) of ``pages`` composed pages."""
    rng = random.Random(seed)
    return [_page(rng) for _ in range(pages)]
