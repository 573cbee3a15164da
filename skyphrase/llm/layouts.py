"""Labelled pages for the main-text field: seeded layouts that hold texts of given pages.

A layout is dealt from ways to mark up an article and what stands around it: menus, headers, footers, sidebars, notices,
adverts, forms and reader comments.  Half of the layouts name their elements by class or id, a quarter by element names
alone, and the rest by names that say nothing, so that no one kind of evidence is enough.  Texts are the blocks of the
given pages: prose goes into articles as into comments and sidebars, short ones into headings and menus.  What stands
around an article also has the usual wording.  Each page comes with its main text, as that was put in.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from html import escape

from .html_blocks import blocks

#: Ways to name the elements of each kind: element and class words, then elements that say it by themselves.
KINDS = {
    "main": (
        ["article", "post", "entry-content", "article-body", "content", "story", "postContent", "main-content", "blog-post", "text-body", "page-content", "primary"],
        ["article", "main", 'div role="main"', 'div itemprop="articleBody"'],
    ),
    "menu": (["menu", "navbar", "navigation", "topnav", "breadcrumbs", "nav-links", "site-nav", "main-menu", "pagination", "social-share", "tags"], ["nav", 'div role="navigation"', "menu"]),
    "header": (["header", "masthead", "site-header", "page-header", "logo", "top-bar", "branding"], ["header", 'div role="banner"']),
    "footer": (["footer", "site-footer", "copyright", "colophon", "bottom-links", "legal"], ["footer", 'div role="contentinfo"']),
    "side": (["sidebar", "related", "widget", "right-rail", "recommended", "popular-posts", "trending", "more-stories", "latest", "teaser"], ["aside", 'div role="complementary"']),
    "notice": (["cookie-notice", "consent", "gdpr", "alert", "notice", "popup", "modal", "newsletter", "paywall", "banner", "cookie-banner"], ['div role="alert"', 'div role="dialog"', "dialog"]),
    "advert": (["ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad", "ad-slot", "adsbox", "partner-content"], ["aside"]),
    "form": (["search-form", "login", "subscribe", "signup", "contact-form", "comment-form"], ["form", 'div role="search"']),
    "comments": (["comments", "comment-list", "disqus", "responses", "reader-comments", "discussion", "replies"], ['section id="comments"', 'div id="comments"', 'ol class="commentlist"']),
}
SAYS = {
    "header": ["Home", "Welcome", "Your daily source", "Edition", "Log in", "Est. 1998", "Accueil", "Startseite", "Inicio"],
    "footer": ["© 2024 {} All rights reserved.", "© {} · {}", "Privacy policy", "Terms of use", "Imprint", "Contact us", "Copyright {}. Tous droits réservés.", "Powered by {}", "Impressum | Datenschutz", "Aviso legal"],
    "side": ["Related articles", "Most read", "Popular posts", "Read more", "You may also like", "À lire aussi", "Mehr zum Thema", "Lo más leído", "About the author"],
    "notice": [
        "We use cookies to improve your experience.", "This site uses cookies. By continuing you accept our policy.", "Accept all", "Subscribe to our newsletter for updates!", "You have 2 free articles left.",
        "Nous utilisons des cookies.", "Diese Website verwendet Cookies.", "Este sitio usa cookies.", "Please enable JavaScript.", "Notice: {}",
    ],
    "advert": ["Advertisement", "Sponsored", "Buy now and save 20%!", "Anzeige", "Publicité", "Publicidad", "Limited offer: {}", "{} Order today!"],
    "form": ["Search", "Your email", "Name", "Password", "Submit", "Subscribe", "Leave a reply", "Post comment", "Log in", "Suche", "Rechercher", "Buscar"],
    "comments": ["Comments (3)", "12 comments", "Reply", "Leave a comment", "User {} says:", "Posted by {} on 12 May", "Kommentare", "Commentaires", "Comentarios", "Like · Reply · 3h"],
    "menu": ["Home", "About", "News", "Sport", "Contact", "Next", "Previous", "Share", "Tweet", "Kontakt", "Accueil"],
}
_LETTERS = "aeioubcdlmnrst"


class Texts:
    """Prose and short texts of the given pages; invented words where these have too few."""

    def __init__(self, pages: list[str], rng: random.Random):
        found = [b.text for html in pages for b in blocks(html)]
        invent = lambda n: " ".join("".join(rng.choice(_LETTERS) for _ in range(rng.randint(2, 9))) for _ in range(n)).capitalize() + "."
        self.prose = [t[:3000] for t in found if t.count(" ") >= 12] or []
        self.prose += [invent(rng.randint(13, 90)) for _ in range(max(0, 60 - len(self.prose)))]
        self.words = [w for t in self.prose[:400] for w in t.split(" ")]
        self.rng = rng

    def long(self) -> str:
        text = self.rng.choice(self.prose)
        cut = self.rng.randint(5, 120)
        return " ".join(text.split(" ")[:cut]) if self.rng.random() < 0.5 else text

    def some(self, low: int, high: int) -> str:
        at = self.rng.randrange(len(self.words))
        return " ".join(self.words[at : at + self.rng.randint(low, high)]).strip() or "a"

    def said(self, kind: str) -> str:
        return self.rng.choice(SAYS[kind]).replace("{}", self.some(1, 4))


class Page:
    """One page in the making: its pieces of html, and the blocks of its main text."""

    def __init__(self, texts: Texts, rng: random.Random):
        self.texts, self.rng, self.html, self.main = texts, rng, [], []
        self.style = rng.choices(["named", "plain", "odd"], [2, 1, 1])[0]
        self.cells = rng.random() < 0.1  # regions are the cells of a table
        self.closed = rng.random() < 0.7  # whether paragraphs are closed

    def opened(self, kind: str, top: bool) -> tuple[str, str]:
        names, own = KINDS[kind]
        rng = self.rng
        if self.cells and top:
            word = rng.choice(names) if self.style == "named" else f"{rng.choice('xqzvk')}{rng.randint(10, 999)}"
            return f'<td class="{word}">' if rng.random() < 0.8 else f'<tr><td class="{word}">', "</td>"
        if self.style == "plain" or rng.random() < 0.3:
            tag = rng.choice(own)
        else:
            word = rng.choice(names) if self.style == "named" else f"{rng.choice('xqzvk')}{rng.randint(10, 999)}"
            tag = f'{rng.choice(["div", "div", "section"])} {rng.choice(["class", "class", "id"])}="{word}{rng.choice(["", "", f" c{rng.randint(1, 9)}", "-inner"])}"'
        return f"<{tag}>", f"</{tag.split(' ')[0]}>"

    def add(self, tag: str, text: str, main: bool = False, close: bool = True) -> None:
        marked = escape(text, quote=False)
        if self.rng.random() < 0.2:
            words = marked.split(" ")
            k = self.rng.randrange(len(words))
            words[k] = f"<{self.rng.choice(['b', 'em', 'i', 'span'])}>{words[k]}</b>" if self.rng.random() < 0.5 else f'<a href="/{k}">{words[k]}</a>'
            marked = " ".join(words)
        self.html.append(f"<{tag}>{marked}" + (f"</{tag.split(' ')[0]}>" if close else ""))
        if main:
            self.main.append(" ".join(text.split()))

    def links(self, many: int) -> None:
        tag = self.rng.choice(["li", "li", "div", "span", "p"])
        self.html.append("<ul>" * (tag == "li"))
        for _ in range(many):
            said = self.texts.said("menu") if self.rng.random() < 0.3 else self.texts.some(1, 5)
            self.html.append(f'<{tag}><a href="/x">{escape(said, quote=False)}</a></{tag}>' + " " * (tag == "span"))
        self.html.append("</ul>" * (tag == "li"))

    def region(self, kind: str, top: bool = False) -> None:
        a, b = self.opened(kind, top)
        rng, texts = self.rng, self.texts
        self.html.append(a)
        if kind == "menu":
            self.links(rng.randint(2, 12))
        elif kind == "header":
            self.add(rng.choice(["h1", "div", "p", "h2"]), texts.some(1, 4))
            if rng.random() < 0.5:
                self.add("p", texts.said(kind))
            if rng.random() < 0.4:
                self.links(rng.randint(2, 6))
        elif kind == "footer":
            for _ in range(rng.randint(1, 3)):
                self.add(rng.choice(["p", "div", "small", "span"]), texts.said(kind))
            if rng.random() < 0.3:
                self.add("p", texts.long())
            if rng.random() < 0.4:
                self.links(rng.randint(2, 8))
            if rng.random() < 0.5:
                self.html.append(f"&copy; {texts.some(1, 2)} &middot; {texts.some(2, 12)}")
        elif kind == "side":
            self.add(rng.choice(["h2", "h3", "h4", "p"]), texts.said(kind) if rng.random() < 0.7 else texts.some(1, 4))
            for _ in range(rng.randint(0, 3)):
                self.add("p", texts.long() if rng.random() < 0.6 else texts.some(4, 15))
            if rng.random() < 0.6:
                self.links(rng.randint(2, 7))
        elif kind in ("notice", "advert"):
            tag = rng.choice(["p", "p", "div", "span", "", ""])
            for _ in range(rng.randint(1, 2)):
                said = texts.said(kind) if rng.random() < 0.5 else texts.some(4, 30) if rng.random() < 0.7 else texts.long()
                self.add(tag, said) if tag else self.html.append(escape(said, quote=False))
            if kind == "notice" and rng.random() < 0.6:
                self.add("button", texts.said(kind))
        elif kind == "form":
            inner = rng.random() < 0.5
            self.html.append("<form>" * inner)
            for _ in range(rng.randint(1, 4)):
                self.html.append(f"<label>{texts.said(kind)}</label><input name=q>")
            if rng.random() < 0.4:
                self.html.append("<select>" + "".join(f"<option>{texts.some(1, 2)}" for _ in range(3)) + "</select>")
            if rng.random() < 0.4:
                self.add("p", texts.some(5, 25))
            self.html.append(f"<button>{texts.said(kind)}</button>" + "</form>" * inner)
        elif kind == "comments":
            self.add(rng.choice(["h2", "h3", "p"]), texts.said(kind))
            for _ in range(rng.randint(1, 5)):
                c, d = rng.choice([("<div class=comment>", "</div>"), ("<article class='comment'>", "</article>"), ("<li>", "</li>"), ("<div>", "</div>"), ("", "")])
                self.html.append(c)
                if rng.random() < 0.7:
                    self.add(rng.choice(["p", "div", "span", "h4"]), texts.said(kind))
                self.add("p", texts.long() if rng.random() < 0.7 else texts.some(2, 20))
                if rng.random() < 0.3:
                    self.html.append("<p><a href=#>Reply</a></p>")
                self.html.append(d)
            if rng.random() < 0.3:
                self.region("form")
        self.html.append(b)

    def article(self) -> None:
        a, b = self.opened("main", True)
        rng, texts = self.rng, self.texts
        self.html.append(a)
        if rng.random() < 0.25:  # a container within
            self.html.append("<div>")
        if rng.random() < 0.85:
            self.add(rng.choice(["h1", "h1", "h2"]), texts.some(2, 14), True)
        for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 13, 25])):
            roll = rng.random()
            if roll < 0.06:
                self.add(rng.choice(["h2", "h3"]), texts.some(1, 8), True)
            elif roll < 0.1:
                self.html.append("<ul>")
                for _ in range(rng.randint(2, 5)):
                    self.add("li", texts.some(1, 14), True, close=self.closed)
                self.html.append("</ul>")
            elif roll < 0.13:
                self.add(rng.choice(["blockquote", "pre"]), texts.some(5, 40), True)
            elif roll < 0.15:
                self.html.append("<table><tr>")
                for _ in range(4):
                    self.add("td", texts.some(1, 4), True, close=self.closed)
                self.html.append("</table>")
            elif roll < 0.21:
                self.region(rng.choice(["advert", "side", "notice", "form"]))
            elif roll < 0.36:
                self.add("p", texts.some(1, 6), True, close=self.closed)
            else:
                self.html.append("<p><b>" * (rng.random() < 0.1))
                self.add("p", texts.long(), True, close=self.closed)
        self.html.append("</div>" * 1 if rng.random() < 0.05 else "")
        self.html.append(b)

    def whole(self) -> tuple[str, str]:
        rng = self.rng
        before = [k for k, share in (("notice", 0.3), ("header", 0.5), ("menu", 0.8), ("form", 0.2), ("advert", 0.4), ("side", 0.2)) if rng.random() < share]
        after = [k for k, share in (("menu", 0.2), ("advert", 0.3), ("comments", 0.4), ("side", 0.5), ("form", 0.2), ("footer", 0.85), ("notice", 0.2)) if rng.random() < share]
        if rng.random() < 0.15:
            before = []
        if rng.random() < 0.15:
            after = []
        if rng.random() < 0.5:
            rng.shuffle(before)
            rng.shuffle(after)
        wrap = rng.random() < 0.4
        self.html.append("<!DOCTYPE html><html><head><title>T</title></head><body>" + "<div class=wrapper>" * wrap + "<table><tr>" * self.cells)
        for kind in before:
            self.region(kind, True)
        if rng.random() < 0.97:
            self.article()
        for kind in after:
            self.region(kind, True)
        self.html.append("</table>" * self.cells + "</div>" * wrap + "</body></html>")
        return "\n".join(self.html) if rng.random() < 0.5 else "".join(self.html), " ".join(self.main)


def composed(pages: list[str], many: int, seed: int = 12) -> Iterator[tuple[str, str]]:
    """``many`` labelled pages, (html, text), of the texts of ``pages``."""
    rng = random.Random(seed)
    texts = Texts(pages, rng)
    for _ in range(many):
        yield Page(texts, rng).whole()
