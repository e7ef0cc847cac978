"""Labelled pages to learn from: made-up sites of many layouts whose main blocks are marked.

Elements of the article bear ``data-main="1"`` and what is not of it inside
``data-main="0"``; the marks are labels only, never features.  Texts are invented words,
the same for the article and for the rest, so that structure must tell them apart; cue
words occur only at times.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

SYLLABLES = "ba ko ri ten sha lu vor mi na sch ing tion ar de ou é ü ñ ça my zo pel gra st".split()
#: Common words, which tell nothing of a block's part.
COMMON = "the of and to in a is that it was for on with as this from have your our page by all more no not le la de des et les que un une pour der die und das ein mit den nicht el los una con para por".split()
OTHER_SCRIPTS = ["абвгдежзиклмнопрст", "αβγδεζηθικλμνο", "အကခဂဃငစဆဇညတထ", "日本語文章記事内容社会", "אבגדהוזחטי"]
#: Names that sites use for parts of a page (class, id or role).
NAMES = {
    "header": ["header", "site-header", "masthead", "top-bar", "page-header", "banner", "branding", "head", "topbar", "siteHeader"],
    "menu": ["nav", "menu", "navbar", "main-menu", "navigation", "breadcrumb", "breadcrumbs", "topnav", "tabs", "nav-links", "pagination", "pager", "toc", "skip-link"],
    "notice": ["notice", "cookie-notice", "cookie", "cookies", "consent", "gdpr", "alert", "banner", "message", "warning", "popup", "modal", "overlay", "announcement", "disclaimer", "paywall", "newsletter", "infobar", "toast", "hidden"],
    "ad": ["ad", "ads", "advert", "advertisement", "ad-slot", "sponsored", "sponsor", "promo", "promotion", "adsbygoogle", "banner-ad", "ad-container", "adbox", "ad-box", "ad-banner", "commercial", "partner", "outbrain", "taboola"],
    "sidebar": ["sidebar", "side", "aside", "widget", "related", "related-posts", "recommended", "more-stories", "trending", "popular", "right-column", "rail", "complementary", "tags", "tagcloud", "archive", "author-box", "social", "share", "sharing", "share-buttons", "see-also"],
    "footer": ["footer", "site-footer", "bottom", "page-footer", "copyright", "contentinfo", "legal", "credits", "foot", "colophon", "siteFooter"],
    "comments": ["comments", "comment", "comment-list", "commentlist", "discussion", "responses", "replies", "disqus_thread", "reader-comments", "comment-section", "feedback", "reactions", "user-comments"],
    "form": ["form", "search", "search-form", "login", "subscribe", "signup", "newsletter-form", "contact-form", "searchform"],
    "article": ["content", "article", "post", "entry", "entry-content", "article-body", "story", "story-body", "main", "main-content", "post-content", "body-text", "text", "page-content", "articleBody", "prose", "mw-parser-output", "single"],
    "wrapper": ["wrapper", "container", "page", "row", "col", "layout", "site", "inner", "grid", "outer", "app", "root"],
}
CUES = {
    "notice": ["We use cookies to improve your experience.", "Please enable JavaScript.", "You have read your last free article.", "Cette page utilise des cookies.", "Diese Seite verwendet Cookies."],
    "ad": ["Advertisement", "Sponsored content", "Buy now and save", "Anzeige", "Publicité"],
    "footer": ["© 2024 All rights reserved.", "Terms of use", "Privacy policy", "Contact us"],
    "comments": ["Reply", "3 comments", "Leave a comment", "Log in to reply", "Report"],
    "sidebar": ["Related articles", "Most read", "Share this", "Follow us", "Tags"],
    "menu": ["Home", "News", "Sports", "About", "Contact", "Next", "Previous"],
    "header": ["The Daily Page", "Your source of news"],
}


class Site:
    """One made-up page; ``r`` decides everything."""

    def __init__(self, r: random.Random):
        self.r = r
        other = r.random() < 0.15
        self.letters = list(r.choice(OTHER_SCRIPTS)) if other else SYLLABLES
        self.noise = r.choice(["", "", "", "%%%", "***", "&amp;", "$$$"])
        self.named = r.random() < 0.85  # whether the site names its parts at all
        self.semantic = r.random() < 0.6  # whether it uses the elements of HTML for them

    def word(self) -> str:
        if self.letters is SYLLABLES and self.r.random() < 0.2:
            return self.r.choice(COMMON)
        w = "".join(self.r.choice(self.letters) for _ in range(self.r.randint(1, 4)))
        return w + (self.noise if self.noise and self.r.random() < 0.5 else "")

    def sentence(self, low: int = 3, high: int = 18) -> str:
        words = [self.word() for _ in range(self.r.randint(low, high))]
        if self.r.random() < 0.3 and len(words) > 4:
            words[2] += ","
        return words[0].capitalize() + " " + " ".join(words[1:]) + self.r.choice([".", ".", ".", "!", "?", ""])

    def prose(self) -> str:
        n = self.r.choice([1, 1, 1, 2, 3, 6])
        out = []
        for _ in range(n):
            s = self.sentence(1, 16)
            k = self.r.random()
            if k < 0.1:
                s = f"<b>{s}</b>"
            elif k < 0.15:
                s = f"<b>{s}"
            elif k < 0.25:
                s = f'<a href="/x">{self.word()}</a> {s}'
            elif k < 0.3:
                s = f"{s}<br>"
            out.append(s)
        return " ".join(out)

    def some(self, kind: str) -> str:
        """A text of a part that is not the article: a cue at times, else like any prose."""
        if kind in CUES and self.r.random() < 0.35:
            return self.r.choice(CUES[kind])
        return self.sentence(1, 14)

    def element(self, kind: str, tags: list[str]) -> tuple[str, str]:
        """(start tag, name) of a part: named, or of its own element, or both."""
        tag = self.r.choice(tags) if self.semantic else "div"
        if self.named and (tag == "div" or self.r.random() < 0.6):
            name = self.r.choice(NAMES[kind])
            return f'<{tag} {self.r.choice(["class", "class", "id"])}="{name}">', tag
        return f"<{tag}>", tag

    def links(self, kind: str) -> str:
        items = [f'<a href="/{i}">{self.r.choice(CUES.get(kind, ["x"])) if self.r.random() < 0.3 else self.word()}</a>' for i in range(self.r.randint(2, 7))]
        if self.r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}{'</li>' if self.r.random() < 0.8 else ''}" for x in items) + "</ul>"
        return self.r.choice([" ", " | "]).join(items)

    def part(self, kind: str) -> str:
        r = self.r
        if kind == "menu":
            start, tag = self.element(kind, ["nav", "nav", "div", "ul"])
            if tag == "ul":
                start, tag = "<nav>", "nav"
            body = self.links(kind)
        elif kind == "header":
            start, tag = self.element(kind, ["header"])
            name = r.choice(["div", "div", "h1", "h2", "p", "span"])
            body = f"<{name}>{self.some(kind)}</{name}>" + (f"<p>{self.sentence()}</p>" if r.random() < 0.5 else "") + (self.part("menu") if r.random() < 0.4 else "")
        elif kind == "footer":
            start, tag = self.element(kind, ["footer"])
            body = r.choice([f"&copy; {self.word()}.example &middot; {self.sentence()}", f"<p>{self.some(kind)}</p>" + self.links(kind), f"<p>{self.sentence()}</p><p>{self.some(kind)}</p>"])
        elif kind == "form":
            start, tag = r.choice(["<form>", f'<form class="{r.choice(NAMES[kind])}">', '<form action="/s">']), "form"
            body = f'<label>{self.some("notice")}</label><input type="text"><p>{self.sentence()}</p><button>{self.word()}</button>'
            if r.random() < 0.3:
                body += f"<select><option>{self.word()}<option>{self.word()}</select><textarea>{self.sentence()}</textarea>"
        elif kind == "comments":
            start, tag = f'<{"section" if self.semantic else "div"} {r.choice(["class", "id"])}="{r.choice(NAMES[kind])}">', "section" if self.semantic else "div"
            one = lambda: f"<{x}><b>{self.word()}</b><p>{self.prose()}</p><a href='#'>{self.some(kind)}</a></{x}>"
            x = r.choice(["div", "li", "article", "div"])
            body = (f"<h3>{self.some(kind)}</h3>" if r.random() < 0.7 else "") + "".join(one() for _ in range(r.randint(1, 4))) + (self.part("form") if r.random() < 0.3 else "")
            if x == "li":
                body = f"<ol>{body}</ol>"
        elif kind == "sidebar":
            start, tag = self.element(kind, ["aside"])
            body = (f"<h3>{self.some(kind)}</h3>" if r.random() < 0.6 else "") + r.choice([self.links(kind), f"<p>{self.sentence()}</p>", f"<p>{self.prose()}</p>" + self.links(kind), self.sentence()])
        elif kind == "ad":
            start, tag = f'<{r.choice(["div", "div", "aside", "section"])} class="{r.choice(NAMES[kind])}">', ""
            tag = start[1:].split(" ")[0]
            body = r.choice([self.some(kind), f"<p>{self.sentence()}</p>", f'<a href="/ad">{self.sentence()}</a>'])
        else:
            start, tag = f'<{r.choice(["div", "section", "aside", "p"])} {r.choice(["class", "class", "id"])}="{r.choice(NAMES["notice"])}">', ""
            tag = start[1:].split(" ")[0]
            body = self.some("notice") if tag == "p" or r.random() < 0.6 else f"<p>{self.some('notice')}</p><button>OK</button>"
        return f"{start}{body}</{tag}>"

    def content(self) -> str:
        """Blocks of the article."""
        r = self.r
        out = []
        for _ in range(r.choice([1, 2, 3, 5, 8, 12])):
            k = r.random()
            if k < 0.68:
                out.append(f"<p>{self.prose()}" + ("</p>" if r.random() < 0.85 else ""))
            elif k < 0.76:
                n = r.randint(2, 4)
                out.append(f"<h{n}>{self.sentence(1, 7)}</h{n}>")
            elif k < 0.83:
                out.append("<ul>" + "".join(f"<li>{self.sentence(1, 12)}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif k < 0.88:
                out.append(f"<blockquote>{r.choice(['<p>{}</p>', '{}']).format(self.sentence())}</blockquote>")
            elif k < 0.91:
                out.append(f"<pre>{self.sentence()}\n{self.sentence()}</pre>")
            elif k < 0.95:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{self.word()}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 3))) + "</table>")
            elif k < 0.98:
                out.append(f'<figure><img src="/i"><figcaption>{self.sentence()}</figcaption></figure>')
            else:
                out.append(f"<div>{self.sentence(6, 18)}</div>")
            if r.random() < 0.22:
                out.append(self.inserted(r.choice(["ad", "ad", "notice", "sidebar", "sidebar", "form"])))
        if r.random() < 0.2 and len(out) > 1:  # a part of the article in an element of its own
            half = len(out) // 2
            tag = r.choice(["section", "div"])
            out[half:] = [f"<{tag}>", *out[half:], f"</{tag}>"]
        return "".join(out)

    def inserted(self, kind: str) -> str:
        """A part inside the article that is not of it."""
        html = self.part(kind)
        cut = html.index(">")
        return f'{html[:cut]} data-main="0"{html[cut:]}'

    def page(self) -> str:
        r = self.r
        title = self.sentence(2, r.choice([6, 10, 18]))
        body = (f"<h1>{title}</h1>" if r.random() < 0.8 else "") + self.content()
        if r.random() < 0.2:
            body = body.replace("<h1>", "<header><h1>", 1).replace("</h1>", "</h1></header>", 1)
        if r.random() < 0.15:
            body += self.inserted("comments")
        if self.semantic and r.random() < 0.8:
            tag = r.choice(["article", "article", "main"])
            name = f' class="{r.choice(NAMES["article"])}"' if r.random() < 0.4 else ""
        else:
            tag, name = "div", f' {r.choice(["class", "id"])}="{r.choice(NAMES["article"])}"' if self.named else ""
        article = f'<{tag}{name} data-main="1">{body}</{tag}>'
        if tag == "article" and r.random() < 0.3:
            article = f"<main>{article}</main>"
        before = [k for k, p in (("notice", 0.3), ("header", 0.6), ("menu", 0.7), ("ad", 0.4), ("form", 0.15), ("sidebar", 0.2)) if r.random() < p]
        after = [k for k, p in (("comments", 0.35), ("sidebar", 0.4), ("ad", 0.25), ("form", 0.15), ("menu", 0.15), ("notice", 0.1)) if r.random() < p]
        if r.random() < 0.2:
            r.shuffle(before)
        bare = r.random() < 0.12  # nothing but the article, at times a single block
        if bare:
            before, after = [], []
            if r.random() < 0.4:
                body = f"<p>{self.prose()}</p>"
                article = f'<{tag}{name} data-main="1">{body}</{tag}>'
        parts = [*(self.part(k) for k in before), article, *(self.part(k) for k in after)]
        if not bare and r.random() < 0.85:
            parts.append(self.part("footer"))
        inner = r.choice(["", "", "\n"]).join(parts)
        for _ in range(r.choice([0, 0, 1, 2])):
            inner = f'<div class="{r.choice(NAMES["wrapper"])}">{inner}</div>'
        return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{margin:0}}</style></head><body>{inner}<!-- x --><script>f('</p>')</script></body></html>"


def labelled_pages(n: int, seed: int = 7) -> Iterator[str]:
    """So many pages with marked main blocks; the same for the same seed."""
    r = random.Random(seed)
    for _ in range(n):
        yield Site(r).page()
