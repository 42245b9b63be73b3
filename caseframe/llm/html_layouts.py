"""Invented pages in many layouts, to teach a labeller what given pages do not show.

A page has a body of content blocks and, around or inside it, regions that are no
part of the article. The blocks of content, and those beside it, are taken from
given pages as far as there are any.
"""

import random

import numpy as np

from caseframe.llm.html_blocks import Block, blocks

_CONTENT = (
    ("article", ""), ("main", ""), ("div", "content"), ("div", "post"), ("div", "entry-content"),
    ("div", "article-body"), ("section", "story"), ("div", "post-content"), ("div", "main"),
    ("div", "text"), ("section", ""), ("div", ""),
)
_PHRASES = {
    "menu": "Home|About us|Contact|News|Blog|Products|Services|FAQ|Start|Kontakt|Accueil|Inicio|Archive",
    "header": "Welcome to our site|Skip to content|My account|The daily news|Search|Log in",
    "footer": "© 2024 All rights reserved.|Copyright 2023 Example Ltd|Terms of use|Privacy policy|"
    "Imprint|Powered by our own system|Impressum|Mentions légales|Aviso legal",
    "sidebar": "Related articles|Most read|Popular posts|Recent posts|You may also like|Tags|Categories",
    "notice": "We use cookies to improve your experience. Accept all|This site uses cookies.|"
    "By using this site you agree to our privacy policy.|Accept|Decline|Please enable JavaScript.",
    "advert": "Advertisement|Sponsored|Buy now and save 50%!|Click here for a special offer|Ad|Anzeige",
    "form": "Subscribe to our newsletter|Your email address|Sign up|Search this site|Username|Password|"
    "Send|Submit|Leave a comment|Your name",
    "comments": "Comments|3 replies|Reply|Posted by anna on 3 May|Great post, thanks for sharing!|"
    "I do not agree with this at all.|Report|Load more comments",
    "share": "Share this|Tweet|Facebook|Print|Email|Follow us",
}
_REGIONS = {
    "menu": (("nav", ""), ("nav", "main-nav"), ("div", "menu"), ("div", "navbar"), ("ul", "menu"),
             ("div", "navigation"), ("div", "breadcrumb"), ("ul", ""), ("div", "")),
    "header": (("header", ""), ("div", "header"), ("header", "site-header"), ("div", "top-bar")),
    "footer": (("footer", ""), ("div", "footer"), ("footer", "site-footer"), ("div", "copyright"),
               ("div", "")),
    "sidebar": (("aside", ""), ("div", "sidebar"), ("aside", "widget"), ("div", "related-posts"),
                ("section", "recommended")),
    "notice": (("div", "cookie-notice"), ("div", "alert"), ("div", "consent-banner"),
               ("div", "notice"), ("p", "cookies"), ("div", "gdpr"), ("noscript", "")),
    "advert": (("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"),
               ("aside", "promo"), ("div", "sponsored"), ("div", "ad-banner"), ("ins", "adsbygoogle")),
    "form": (("form", ""), ("form", "search"), ("form", "newsletter"), ("form", "login"),
             ("div", "subscribe-form"), ("form", "comment-form")),
    "comments": (("section", "comments"), ("div", "comments"), ("div", "comment-list"),
                 ("ol", "comment-list"), ("div", "reader-comments"), ("section", "discussion"),
                 ("div", "replies")),
    "share": (("div", "share"), ("div", "social"), ("ul", "social-links")),
}
_AROUND = ("menu", "notice", "header", "advert"), ("share", "comments", "sidebar", "form", "advert", "menu", "footer")
_MARK = "\x02"


def _made_up(rng: random.Random, n: int) -> str:
    words = ("".join(rng.choice("aeinorstlmdu") for _ in range(rng.randint(2, 9))) for _ in range(n))
    return " ".join(words).capitalize() + "."


class _Texts:
    """Texts of content and of what stands beside it."""

    def __init__(self, rng: random.Random, given: list[tuple[list[Block], np.ndarray]]):
        self.rng = rng
        told = {(b.text, bool(w)) for page, own in given for b, w in zip(page, own, strict=True)}
        self.content = sorted(text for text, wanted in told if wanted)
        self.beside = sorted(text for text, wanted in told if not wanted)

    def sentence(self) -> str:
        if self.content and self.rng.random() < 0.8:
            return self.rng.choice(self.content)[: self.rng.choice([60, 300, 2000])]
        return _made_up(self.rng, self.rng.randint(3, 80))

    def short(self) -> str:
        return " ".join(self.sentence().split()[: self.rng.randint(1, 7)])

    def of(self, kind: str) -> str:
        if self.beside and kind not in ("comments", "form") and self.rng.random() < 0.3:
            return self.rng.choice(self.beside)[:300]
        if kind in ("comments", "sidebar", "advert", "notice") and self.rng.random() < 0.5:
            return self.sentence()
        if kind == "footer" and self.rng.random() < 0.4:
            return f"© {self.rng.randint(1995, 2030)} {self.short()}"
        return self.rng.choice(_PHRASES[kind].split("|"))


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;")


def _open(rng: random.Random, tag: str, name: str) -> str:
    if not name:
        return f"<{tag}>"
    return f'<{tag} {rng.choice(["class", "class", "id"])}="{name}">'


def _region(rng: random.Random, texts: _Texts, kind: str) -> str:
    tag, name = rng.choice(_REGIONS[kind])
    parts = [_escaped(texts.of(kind)) for _ in range(rng.randint(1, 7))]
    if kind in ("menu", "share") or (kind in ("sidebar", "footer") and rng.random() < 0.5):
        item = "<li><a href='/x'>{}</a></li>" if tag in ("ul", "ol") or rng.random() < 0.7 else "<a href='/x'>{}</a> "
        inner = "".join(item.format(part[:60]) for part in parts)
        if "<li>" in item and tag not in ("ul", "ol"):
            inner = f"<ul>{inner}</ul>"
    elif kind == "form":
        inner = "".join(
            rng.choice(["<label>{}</label>", "<button>{}</button>", "<p>{}</p>"]).format(part)
            for part in parts
        )
    elif kind == "comments":
        item = rng.choice(['<div class="comment"><p>{}</p></div>', "<li><p>{}</p></li>", "<p>{}</p>"])
        inner = "<h3>Comments</h3>" * rng.randint(0, 1) + "".join(map(item.format, parts))
    elif kind in ("sidebar", "header"):
        inner = "".join(rng.choice(["<h3>{}</h3>", "<p>{}</p>", "<div>{}</div>"]).format(p) for p in parts)
    else:
        inner = " ".join(rng.choice(["{}", "<p>{}</p>", "<span>{}</span>"]).format(p) for p in parts[:3])
    return f"{_open(rng, tag, name)}{inner}</{tag}>"


def _content(rng: random.Random, texts: _Texts, named: bool) -> str:
    """Blocks of an article, each marked, with regions in between now and then.

    Where the article's element has a name, what its blocks say tells little: some
    say what is said beside articles elsewhere.
    """
    parts = []
    if rng.random() < 0.8:
        title = f"<h{rng.randint(1, 2)}>{_MARK}{_escaped(texts.short())}</h1>"
        parts.append(f"<header>{title}</header>" if named and rng.random() < 0.15 else title)
    for _ in range(rng.randint(1, 14)):
        draw = rng.random() * 1.04
        astray = named and rng.random() < 0.1
        text = _MARK + _escaped(
            texts.of(rng.choice(list(_PHRASES))) if astray else rng.choice([texts.sentence, texts.sentence, texts.short])()
        )
        if draw < 0.62:
            parts.append(f"<p>{text}</p>" if rng.random() < 0.9 else f"<p><b>{text}<br>")
        elif draw < 0.70:
            parts.append(f"<h{rng.randint(2, 4)}>{_MARK}{_escaped(texts.short())}</h2>")
        elif draw < 0.77:
            items = "".join(f"<li>{_MARK}{_escaped(texts.short())}</li>" for _ in range(rng.randint(2, 5)))
            parts.append(f"<ul>{items}</ul>")
        elif draw < 0.81:
            parts.append(f"<blockquote>{text}</blockquote>")
        elif draw < 0.85:
            parts.append(f"<div>{text}</div>")
        elif draw < 0.89:
            cells = "".join(f"<td>{_MARK}{_escaped(texts.short())}</td>" for _ in range(rng.randint(2, 4)))
            parts.append(f"<table><tr>{cells}</tr></table>")
        elif draw < 0.93:
            parts.append(f"<p>{text} <a href='/y'>{_escaped(texts.short())}</a> {_escaped(texts.short())}</p>")
        elif draw < 0.95:
            parts.append(f"<figure><figcaption>{_MARK}{_escaped(texts.short())}</figcaption></figure>")
        else:
            parts.append(_region(rng, texts, rng.choice(["advert", "sidebar", "share", "form", "form", "notice", "menu"])))
    return "".join(parts)


def _page(rng: random.Random, texts: _Texts) -> str:
    tag, name = rng.choice(_CONTENT)
    inner = f"{_open(rng, tag, name)}{_content(rng, texts, tag in ('article', 'main') or name != '')}</{tag}>"
    if rng.random() < 0.03:
        return _MARK + _escaped(texts.sentence())
    if tag == "article" and rng.random() < 0.4:
        inner = f"<main>{inner}</main>"
    if rng.random() < 0.3:
        inner = f'<div class="{rng.choice(["wrapper", "container", "page", "layout"])}">{inner}</div>'
    before, after = (
        "".join(_region(rng, texts, kind) for kind in kinds if rng.random() < share)
        for kinds, share in zip(_AROUND, (0.6, 0.5), strict=True)
    )
    title = f"<head><title>{_escaped(texts.short())}</title></head>"
    return f"<html>{title}<body>{before}{inner}{after}</body></html>"


def _with_text(block: Block, text: str) -> Block:
    return Block(text, block.path, len(text) if block.linked else 0)


def reworded(
    given: list[tuple[list[Block], np.ndarray]], seed: int
) -> list[tuple[list[Block], np.ndarray]]:
    """The pages with the texts of their blocks dealt anew, and a block now and then repeated.

    Some blocks say what is said beside articles elsewhere, some what no page says.

    Where markup says what a block is, its words must not outweigh that.
    """
    rng, made = random.Random(seed), []
    stock = "|".join(_PHRASES.values()).split("|")
    for page, labels in given:
        texts = [block.text for block in page]
        rng.shuffle(texts)
        for at in range(len(texts)):
            draw = rng.random()
            if draw < 0.1:
                texts[at] = rng.choice(stock)
            elif draw < 0.3:
                texts[at] = _made_up(rng, rng.randint(1, 12))
        dealt = [_with_text(block, text) for block, text in zip(page, texts, strict=True)]
        if rng.random() < 0.35 and labels.any():
            at = rng.choice(np.flatnonzero(labels).tolist())
            times = rng.choice([3, 10, 20, 40, 120])
            said = rng.choice([page[at].text, rng.choice(texts), " ".join(rng.choice(texts).split()[:3])])
            same = _with_text(page[at], said)
            dealt[at : at + 1] = [same] * times
            labels = np.insert(labels, at, [True] * (times - 1))
        made.append((dealt, labels))
    return made


def invented(
    given: list[tuple[list[Block], np.ndarray]], n: int, seed: int
) -> list[tuple[list[Block], np.ndarray]]:
    """``n`` pages as blocks, and which of these are content."""
    rng = random.Random(seed)
    texts, made = _Texts(rng, given), []
    while len(made) < n:
        page = list(blocks(_page(rng, texts)))
        labels = np.array([_MARK in block.text for block in page], bool)
        for block in page:
            block.text = " ".join(block.text.replace(_MARK, "").split())
        kept = [at for at, block in enumerate(page) if block.text]
        if kept:
            made.append(([page[at] for at in kept], labels[kept]))
    return made
