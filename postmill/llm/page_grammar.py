"""Training pages for the block labeller, drawn from a grammar of layouts.

Content blocks begin with MARK, all others do not; the labeller removes it. The words are mostly
invented, so that a label follows from tags, names, measures and neighbours, with the usual words
of menus, notices and footers in between.
"""

from __future__ import annotations

import numpy as np

MARK = ""

# Names under which pages keep their parts, and words such parts use.
NAMES = {
    "content": "content main-content post post-content entry entry-content article article-body article-content story "
    "story-body text page-content body-text blog-post news-text main primary",
    "menu": "menu nav navbar navigation main-menu top-menu site-nav breadcrumb breadcrumbs topbar tabs pagination pager toc",
    "header": "header site-header page-header masthead top banner-top logo branding",
    "footer": "footer site-footer page-footer bottom copyright colophon legal",
    "side": "sidebar side side-bar widget widgets right-column left-column related related-posts recommended trending popular tags",
    "ad": "ad ads advert advertisement sponsored sponsor promo banner ad-slot adsbox commercial",
    "notice": "notice cookie cookie-banner cookie-consent consent gdpr alert popup modal overlay warning newsletter-popup info-bar",
    "form": "form search search-form newsletter subscribe signup login contact-form",
    "comments": "comments comment comment-list reader-comments discussion responses replies disqus user-comments",
    "share": "share social share-buttons social-links follow",
}
USUAL = {
    "menu": "home about contact news blog products services help login shop start inicio accueil startseite",
    "header": "welcome official site your daily the portal online",
    "footer": "© copyright all rights reserved privacy policy terms imprint impressum 2024 inc contact",
    "side": "related popular latest recommended more stories read also tags archive",
    "ad": "advertisement sponsored buy now offer sale discount free click here",
    "notice": "we use cookies accept to improve your experience agree privacy settings warning please note",
    "form": "name email subscribe search send password submit message your sign up",
    "comments": "reply says posted comment thanks great agree ago likes report",
    "share": "share tweet facebook like follow us print",
}
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve au ge ß é ción qu pf ment".split()


class Page:
    def __init__(self, random: np.random.Generator):
        self.random = random
        self.plain_names = random.random() < 0.15  # names that say nothing
        self.words_usual = random.random() < 0.7

    def chance(self, p: float) -> bool:
        return self.random.random() < p

    def pick(self, options: list):
        return options[int(self.random.integers(len(options)))]

    def word(self) -> str:
        return "".join(self.pick(SYLLABLES) for _ in range(int(self.random.integers(1, 5))))

    def words(self, low: int, high: int, kind: str = "") -> str:
        usual = USUAL[kind].split() if kind and self.words_usual else []
        n = int(self.random.integers(low, high + 1))
        return " ".join(self.pick(usual) if usual and self.chance(0.5) else self.word() for _ in range(n))

    def prose(self, mark: bool) -> str:
        n = int(self.pick([1, 1, 2, 4, 8, 15, 30, 60, 100]))
        text = self.words(n, n + 4).capitalize()
        if self.chance(0.1):
            odd = self.pick(["###", "***", "!!", "&amp;&amp;", " |", "$$$"])
            text = " ".join(w + odd for w in text.split())
        if self.chance(0.15):
            words = text.split(" ")
            at = int(self.random.integers(len(words)))
            words[at] = f"<{self.pick(['a href=/x', 'b', 'em', 'strong'])}>{words[at]}"
            words[at] += "</" + words[at][1:].split(">")[0].split(" ")[0] + ">"
            text = " ".join(words)
        return (MARK if mark else "") + text + ("." if self.chance(0.85) else "")

    def name(self, kind: str) -> str:
        if self.plain_names and self.chance(0.8):
            return self.pick(["", f' class="{self.word()}"', f' class="c{int(self.random.integers(99))}"'])
        value = self.pick(NAMES[kind].split())
        if self.chance(0.3):
            value += " " + self.pick([self.word(), "wide", "box", "container", "wrapper", "inner"])
        return f' {self.pick(["class", "class", "class", "id"])}="{value}"'

    def element(self, kind: str, tags: list[str], inside: str) -> str:
        tag = self.pick(tags)
        named = "" if tag not in ("div", "section", "ul", "p", "td") and self.chance(0.6) else self.name(kind)
        return f"<{tag}{named}>{inside}</{tag}>"

    def links(self, kind: str) -> str:
        own = [f'<a href="/{self.word()}">{self.words(1, 3, kind)}</a>' for _ in range(int(self.random.integers(2, 9)))]
        form = self.pick(["ul", "ul", "div", "bare"])
        if form == "ul":
            end = "" if self.chance(0.1) else "</li>"
            return "<ul>" + "".join(f"<li>{x}{end}" for x in own) + "</ul>"
        return self.pick([" ", " | ", "", "</div><div>"]).join(own).join(["<div>", "</div>"])

    def said(self, kind: str) -> str:
        """A few blocks of running text that are not content."""
        out = ""
        for _ in range(int(self.random.integers(1, 4))):
            text = self.words(2, 14, kind) if self.chance(0.5) else self.prose(False)
            out += self.pick(["<p>{}</p>", "<p>{}</p>", "<div>{}</div>", "<h3>{}</h3>", "<span>{}</span> "]).format(text)
        return out

    def other(self, kind: str) -> str:
        if self.plain_names and kind in ("ad", "notice", "comments", "share", "side"):
            # without names only the tag can say that this is beside the text
            return f"<aside>{self.links(kind) if self.chance(0.5) else self.said(kind)}</aside>" if kind == "side" else ""
        if kind == "menu":
            return self.element(kind, ["nav", "nav", "div", "ul"], self.links(kind))
        if kind == "header":
            inside = self.pick(["<h1>{}</h1>", "<div>{}</div>", "<p>{}</p>", "<a href=/>{}</a>"]).format(self.words(1, 8, kind))
            return self.element(kind, ["header", "header", "div"], inside + (self.links("menu") if self.chance(0.5) else ""))
        if kind == "footer":
            inside = self.words(2, 12, kind) if self.chance(0.6) else self.said(kind)
            inside = self.pick(["&copy; ", "", "© "]) + inside + (self.links(kind) if self.chance(0.4) else "")
            return self.element(kind, ["footer", "footer", "div"], inside)
        if kind == "ad":
            inside = self.prose(False) if self.chance(0.5) else self.said(kind)
            return self.element(kind, ["div", "div", "aside", "ins", "section"], inside)
        if kind == "side":
            inside = f"<h3>{self.words(1, 4, kind)}</h3>" * self.chance(0.7) + (self.links(kind) if self.chance(0.6) else self.said(kind))
            return self.element(kind, ["aside", "aside", "div", "section"], inside)
        if kind == "form":
            inside = f"<label>{self.words(1, 3, kind)}</label><input name=q><p>{self.words(2, 10, kind)}</p><button>{self.words(1, 2, kind)}</button>"
            form = f"<form action=/s{self.name(kind) if self.chance(0.4) else ''}>{inside}</form>"
            return self.element(kind, ["div", "section"], form) if self.chance(0.4) else form
        if kind == "comments":
            inside = f"<h3>{self.words(1, 3, kind)}</h3>" * self.chance(0.7)
            for _ in range(int(self.random.integers(1, 6))):
                one = (f"<b>{self.word()}</b> " * self.chance(0.5)) + f"<p>{self.prose(False)}</p>" * int(self.random.integers(1, 3))
                inside += self.pick([f"<div class=comment>{one}</div>", f"<li>{one}</li>", f"<article>{one}</article>", one])
            return self.element(kind, ["section", "div", "div", "ol", "aside"], inside)
        return self.element(kind, ["div", "div", "section", "p"], self.said(kind) if kind == "notice" else self.links(kind))

    def article(self) -> str:
        parts = []
        if self.chance(0.8):
            parts.append(f"<{(h := self.pick(['h1', 'h1', 'h2']))}>{MARK}{self.words(2, 14)}</{h}>")
        for _ in range(int(self.pick([1, 2, 4, 8, 14, 24, 60]))):
            kind = self.random.random()
            if kind < 0.74:
                p = self.pick(["<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<p>{}", "<div>{}</div>", "<p><b>{}<br>"]).format(self.prose(True))
                parts.append(p)
            elif kind < 0.82:
                parts.append(f"<h2>{MARK}{self.words(1, 8)}</h2>")
            elif kind < 0.9:
                own = "".join(f"<li>{self.prose(True)}</li>" for _ in range(int(self.random.integers(1, 5))))
                parts.append(self.pick(["<ul>{}</ul>", "<ol>{}</ol>"]).format(own))
            elif kind < 0.94:
                parts.append(f"<blockquote><p>{self.prose(True)}</p></blockquote>")
            elif kind < 0.97:
                row = "".join(f"<td>{self.prose(True)}</td>" for _ in range(2))
                parts.append(f"<table><tr>{row}</tr></table>")
            else:
                parts.append(f"<pre>{self.prose(True)}</pre>")
        for kind, p in (("ad", 0.25), ("form", 0.2), ("side", 0.2), ("share", 0.15), ("notice", 0.15)):
            if self.chance(p):
                parts.insert(int(self.random.integers(1, len(parts) + 1)), self.other(kind))
        if self.chance(0.15):
            parts.append(self.other("comments"))
        inside = "".join(parts)
        form = self.random.random()
        if form < 0.45:
            return f"<article{self.name('content') if self.chance(0.3) else ''}>{inside}</article>"
        if form < 0.6:
            return f"<main{self.name('content') if self.chance(0.3) else ''}>{inside}</main>"
        if form < 0.7:
            return f"<main><article>{inside}</article></main>"
        if form < 0.95:
            return self.element("content", ["div", "div", "section", "td"], inside)
        return inside

    def draw(self) -> str:
        before = [k for k, p in (("notice", 0.3), ("header", 0.45), ("menu", 0.75), ("ad", 0.35), ("form", 0.2), ("side", 0.15)) if self.chance(p)]
        after = [k for k, p in (("share", 0.15), ("comments", 0.3), ("side", 0.35), ("ad", 0.25), ("form", 0.2), ("menu", 0.15), ("footer", 0.8), ("notice", 0.15)) if self.chance(p)]
        if self.chance(0.2):
            self.random.shuffle(before)
        body = "".join(map(self.other, before)) + self.article() + "".join(map(self.other, after))
        if self.chance(0.25):
            body = f"<div{self.pick(['', ' id=page', ' class=wrapper', ' class=container'])}>{body}</div>"
        page = f"<!DOCTYPE html><html><head><title>{self.words(2, 9)}</title><style>p{{}}</style></head><body>{body}</body></html>"
        return page[: int(len(page) * self.random.uniform(0.6, 1))] if self.chance(0.08) else page


def labelled_page(random: np.random.Generator) -> str:
    return Page(random).draw()
