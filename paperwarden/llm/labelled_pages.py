"""Labelled pages for the main-text model, made by rule: layouts of main text and everything around it.

Every element with ``data-main`` marks its texts: 1 is main text, 0 isn't. The attribute is never a feature.
"""

from __future__ import annotations

import random

#: Elements that hold the main text, and attributes seen on them.
MAIN = ("article", "main", "div class=content", "div id=main-content", "div class=post-body", "div class=entry-content",
        "section class=story", "div class=article-body", "div", "section", "div role=main", "div class=page")
#: What stands before, beside, inside and after it, by kind.
MENUS = ("nav", "div class=menu", "ul class=nav", "div id=navigation", "div class=breadcrumbs", "nav class=topbar",
         "div class=tags", "div class=pagination", "div class=toc")
HEADERS = ("header", "div class=header", "div id=masthead", "header class=site-header", "div class=logo")
FOOTERS = ("footer", "div class=footer", "div id=site-footer", "p class=copyright", "div class=legal")
SIDEBARS = ("aside", "div class=sidebar", "div id=side", "div class=related", "div class=widget", "div class=popular",
            "div class=recommended", "section class=related-posts")
NOTICES = ("div class=cookie-notice", "div class=notice", "div id=consent", "div class=popup", "div class=modal",
           "div role=dialog", "div class=banner", "div class=alert", "div class=newsletter")
ADVERTS = ("div class=ad", "div class=advert", "div class=ads", "div class=sponsored", "aside class=promo",
           "div class=promotion", "div id=ad-top", "ins class=adsbygoogle")
FORMS = ("form", "form class=search", "form class=login", "div class=subscribe", "form id=contact")
COMMENTS = ("section class=comments", "div id=comments", "ol class=comment-list", "div class=discussion",
            "section id=respond", "div class=reader-comments", "div class=replies")
SHARES = ("div class=share", "ul class=social", "div class=byline", "div class=meta")

_SYLLABLES = "ba co de fi gu la me no pi ra se ti vo un er al in on es it".split()


def _words(rng: random.Random, count: int) -> str:
    return " ".join("".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4))) for _ in range(count))


def _sentences(rng: random.Random, count: int) -> str:
    return " ".join(_words(rng, rng.randint(3, 18)).capitalize() + rng.choice([".", ".", ".", "!", "?", ", and so."])
                    for _ in range(count))


def _wrap(kind: str, inner: str, main: int | None = None) -> str:
    tag, _, attribute = kind.partition(" ")
    name, _, value = attribute.partition("=")
    given = f' {name}="{value}"' if name else ""
    mark = "" if main is None else f' data-main="{main}"'
    return f"<{tag}{given}{mark}>{inner}</{tag}>"


def _links(rng: random.Random, count: int) -> str:
    items = [f'<a href="/{_words(rng, 1)}">{_words(rng, rng.randint(1, 3))}</a>' for _ in range(count)]
    return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if rng.random() < 0.7 else " | ".join(items)


def _aside(rng: random.Random) -> str:
    """Something that isn't main text; much of it reads like prose."""
    kind = rng.choice([MENUS, HEADERS, FOOTERS, SIDEBARS, NOTICES, ADVERTS, FORMS, COMMENTS, SHARES])
    if kind in (MENUS, SHARES):
        inner = _links(rng, rng.randint(2, 8))
    elif kind is COMMENTS:
        one = rng.choice(["article", "li", "div class=comment", "div"])
        inner = "".join(_wrap(one, f"<b>{_words(rng, 1)}</b><p>{_sentences(rng, rng.randint(1, 4))}</p>")
                        for _ in range(rng.randint(1, 5)))
        inner = f"<h3>{_words(rng, 2)}</h3>{inner}" if rng.random() < 0.5 else inner
    elif kind is FORMS:
        inner = f"<label>{_words(rng, 2)}</label><input name=q><button>{_words(rng, 1)}</button><p>{_words(rng, 6)}</p>"
    elif kind is FOOTERS:
        inner = f"&copy; {_words(rng, 3)} &middot; {_sentences(rng, rng.randint(1, 3))}"
    else:
        said = _sentences(rng, rng.randint(1, 4))
        inner = rng.choice([said, f"<p>{said}</p>", f"<h4>{_words(rng, 3)}</h4><p>{said}</p>",
                            f"<h3>{_words(rng, 2)}</h3>{_links(rng, 4)}"])
    return _wrap(rng.choice(kind), inner, 0)


def _main(rng: random.Random) -> str:
    parts = [f"<h1>{_words(rng, rng.randint(2, 9))}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.randint(1, 8)):
        said = _sentences(rng, rng.randint(1, 6))
        parts.append(rng.choices([
            f"<p>{said}</p>", f"<p><b>{said}<br><p>{_sentences(rng, 2)}</p>", f"<p>{said}", f"<h2>{_words(rng, 3)}</h2>",
            f"<ul><li>{_sentences(rng, 1)}</li><li>{_words(rng, 5)}</li></ul>", f"<blockquote>{said}</blockquote>",
            f'<p>{said} <a href="/x">{_words(rng, 2)}</a> {_words(rng, 4)}.</p>', f"<div>{said}</div>",
            f"<pre>{_words(rng, 6)}</pre>", f"<table><tr><td>{_words(rng, 2)}</td><td>{_words(rng, 3)}</td></tr></table>",
            f"<p>{_words(rng, rng.randint(1, 3))}</p>", f"<figure><figcaption>{said}</figcaption></figure>"],
            [12, 4, 3, 2, 2, 1, 2, 1, 0.5, 0.5, 2, 0.5])[0])
        if rng.random() < 0.12:
            parts.append(_aside(rng))
    return "".join(parts)


def labelled_pages(count: int = 240, seed: int = 11) -> list[str]:
    rng = random.Random(seed)
    pages = []
    for _ in range(count):
        body = [_aside(rng) for _ in range(rng.randint(0, 4))]
        body.append(_wrap(rng.choice(MAIN[:2] if rng.random() < 0.4 else MAIN), _main(rng), 1))
        body += [_aside(rng) for _ in range(rng.randint(0, 4))]
        inner = "".join(body)
        if rng.random() < 0.3:
            inner = _wrap(rng.choice(["div id=wrapper", "div class=container", "main", "div"]), inner, 0)
        head = f"<head><title>{_words(rng, 4)}</title><style>p{{margin:0}}</style><script>var t=1;</script></head>"
        pages.append(f'<!DOCTYPE html><html lang="en">{head}<body data-main="0">{inner}</body></html>')
    return pages
