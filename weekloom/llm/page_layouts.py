"""Labelled pages for the extractor: articles set in many layouts, so that no single element or name tells all.

A layout wraps the same paragraphs as publishers do, in different elements and under different class names, and puts the
usual surroundings before, between and after them: menus, headers, notices, adverts, sidebars, forms, reader comments and
footers. Their texts are short phrases, or prose like the article's own, so that prose alone doesn't tell either.
"""

from __future__ import annotations

from html import escape
from random import Random

BODIES = ("article", "main", 'div class="article-body"', 'div class="entry-content"', 'div class="post"', 'div id="content"', 'section class="story"', 'div class="post-content"', 'div itemprop="articleBody"', 'div role="main"', "div", "td", 'div class="text"', 'div class="page-content"', "", "?", "?")
OUTER = ("", "", "main", 'div class="container"', 'div id="wrapper"', 'div class="row"', "table", 'div class="layout"', "?")
PHRASES = {
    "menu": "home|news|about us|contact|products|blog|archive|sports|politics|login|register|help|search|shop|english|next|previous|skip to content|subscribe".split("|"),
    "header": "daily news|welcome back, reader|the city paper|today's edition|sign in|my account|latest headlines|est. 1998".split("|"),
    "notice": "we use cookies to improve your experience.|this site uses cookies. accept all|please enable javascript.|by continuing you agree to our privacy policy.|javascript is disabled in your browser|you have read 3 of 5 free articles".split("|"),
    "ad": "advertisement|sponsored content|buy now and save 50%|limited offer: click here|promoted by our partners|ads by our network".split("|"),
    "side": "related articles|most read|popular posts|recent comments|tags|categories|follow us on social media|you may also like|trending now|share this".split("|"),
    "form": "your email|subscribe to our newsletter|submit|name|password|send|search|leave a reply|post comment|sign up".split("|"),
    "footer": "© 2024 all rights reserved.|copyright|terms of service|privacy policy|contact us|imprint|powered by|sitemap|back to top".split("|"),
    "comment": "great article, thanks!|i disagree with this.|reply|3 days ago|anonymous said:|first!|report abuse|likes 12|guest wrote:|thank you for sharing".split("|"),
}
WRAPS = {
    "menu": ("nav", 'ul class="menu"', 'div class="navbar"', 'div id="nav"', 'div class="breadcrumbs"', 'div role="navigation"', 'ol class="breadcrumb"', 'td class="menu"'),
    "header": ("header", 'div id="header"', 'div class="masthead"', 'div class="site-header"', 'div role="banner"', 'div class="topbar"'),
    "notice": ('div class="cookie-notice"', 'div id="gdpr"', 'div class="alert"', 'div class="notice"', 'div role="alert"', "noscript", 'div class="cookie-banner"', 'div class="popup modal"', 'p class="notice"', 'div style="display:none"'),
    "ad": ('div class="ad"', 'div class="advert"', 'div class="sponsored"', 'div class="banner-ad"', 'div id="ad-top"', 'aside class="promo"', 'div class="advertisement"', 'section class="ads"'),
    "side": ("aside", 'div class="sidebar"', 'div id="secondary"', 'div class="widget"', 'div class="related"', 'div class="share social"', 'ul class="tags"', 'div role="complementary"', 'td class="sidebar"'),
    "form": ("form", 'form class="newsletter"', 'form id="search"', 'div class="subscribe"', 'fieldset class="login"'),
    "footer": ("footer", 'div id="footer"', 'div class="site-footer"', 'div class="copyright"', 'div role="contentinfo"', 'p class="footer"'),
    "comment": ('section class="comments"', 'div id="comments"', 'ol class="commentlist"', 'div class="comment"', 'div id="disqus_thread"', 'ul class="comment-list replies"', 'div class="user-comments"', 'div class="responses"'),
}


def _named(rng: Random, wrap: str) -> str:
    """An element as its start tag says it; `?` is a div whose name tells nothing."""
    return f'div class="{"".join(rng.choice("bcdfgklmnprstvz") + rng.choice("aeiou") for _ in range(rng.randint(1, 3)))}"' if wrap == "?" else wrap


def _inside(rng: Random, text: str) -> str:
    """A text as markup: escaped, with an element around some of its words."""
    words = [escape(w) for w in text.split(" ")]
    if len(words) > 6 and rng.random() < 0.3:
        k = rng.randrange(len(words) - 2)
        tag = rng.choice(("b", "em", "a", "span", "strong"))
        words[k] = f'<{tag} href="/{k}">{words[k]}' if tag == "a" else f"<{tag}>{words[k]}"
        words[k + 1] += f"</{tag}>"
    return " ".join(words)


def _around(rng: Random, kind: str, prose: list[str]) -> list[tuple[str, bool]]:
    """The surroundings of one kind as (markup, False) pieces."""
    wordy = rng.random() < {"comment": 0.6, "ad": 0.5, "side": 0.5, "footer": 0.4, "header": 0.2, "notice": 0.4}.get(kind, 0.1)
    wrap = _named(rng, "?" if not wordy and rng.random() < 0.15 else rng.choice(WRAPS[kind]))
    tag = wrap.split(" ")[0]
    texts = [rng.choice(prose) if wordy and rng.random() < 0.7 else rng.choice(PHRASES[kind] if rng.random() < 0.8 else PHRASES["menu"]) for _ in range(rng.randint(1, 7 if kind in ("menu", "comment", "side") else 3))]
    item = "li" if tag in ("ul", "ol") else rng.choice({"menu": ("li", "a", "div", "span"), "form": ("label", "button", "p", "option"), "comment": ("p", "div", "li"), "side": ("li", "p", "div", "h3")}.get(kind, ("p", "div", "span", "small")))
    links = rng.random() < {"menu": 0.95, "side": 0.7, "footer": 0.4}.get(kind, 0.2)
    lists = item == "li" and tag not in ("ul", "ol")
    out = [f"<{wrap}>" + ("<ul>" if lists else "")]
    for text in texts:
        shown = escape(text.capitalize() if rng.random() < 0.6 else text)
        out.append(f'<{item}><a href="/x">{shown}</a></{item}>' if links else f"<{item}>{shown}</{item}>")
        out += [" "] if item in ("a", "span", "label", "button", "small") else []
    out.append(("</ul>" if lists else "") + f"</{tag}>")
    return [("".join(out), False)]


def page(rng: Random, title: str, paragraphs: list[str], prose: list[str]) -> list[tuple[str, bool]]:
    """A page as pieces of markup, each with whether its text belongs to the article. prose: texts for surroundings."""
    bare = rng.random() < 0.15  # a page with hardly any surroundings
    out: list[tuple[str, bool]] = [(f"<!DOCTYPE html><html><head><title>{escape(title)}</title><style>p {{}}</style></head><body>" if rng.random() < 0.8 else "", False)]
    for kind in ("notice", "header", "menu", "form", "ad", "side"):
        if rng.random() < ({"menu": 0.9, "header": 0.6}.get(kind, 0.35) if not bare else 0.07):
            out += _around(rng, kind, prose)
    outer, body = _named(rng, rng.choice(OUTER)), _named(rng, rng.choice(BODIES))
    if body == "td":
        outer = "table"
    out.append((f"<{outer}>" + ("<tr>" if outer == "table" else "") if outer else "", False))
    if outer == "table" and body != "td":
        out.append(("<td>", False))
    out.append((f"<{body}>" if body else "", False))
    level = rng.choice(("h1", "h1", "h1", "h2"))
    if rng.random() < 0.85:
        out.append((f"<{level}>{_inside(rng, title)}</{level}>", True))
    style = rng.choice(("p", "p", "p", "div", "br", "section", "" if len(paragraphs) == 1 and body else "p"))
    for k, text in enumerate(paragraphs):
        roll = rng.random()
        if k and roll < 0.07:
            out.append((f"<h3>{_inside(rng, ' '.join(text.split(' ')[:4]))}</h3>", True))
        if k and roll > 0.93:
            out += _around(rng, rng.choice(("ad", "ad", "side", "form", "notice")), prose)
        if 0.07 <= roll < 0.13:
            out.append(("<ul>" + "".join(f"<li>{_inside(rng, x)}" for x in text.split(". ") if x.strip()) + "</ul>", True))
        elif roll < 0.17:
            out.append((f"<blockquote>{_inside(rng, text)}</blockquote>", True))
        elif roll < 0.19:
            out.append((f"<table><tr><td>{_inside(rng, text)}<td>{_inside(rng, ' '.join(text.split(' ')[:3]))}</table>", True))
        elif roll < 0.21:
            out.append((f"<pre>{escape(text)}</pre>", True))
        elif not style:
            out.append((_inside(rng, text), True))
        elif style == "br":
            out.append((f"<p>{_inside(rng, text)}<br>", True))
        else:
            shown = f'{style} class="{rng.choice(("lead", "text", "intro", "x1", "para"))}"' if rng.random() < 0.1 else style
            out.append((f"<{shown}>{_inside(rng, text)}" + (f"</{style}>" if style != "p" or rng.random() < 0.9 else ""), True))
    after = [k for k in ("ad", "side", "comment", "comment", "form") if rng.random() < (0.35 if not bare else 0.05)]
    for kind in [k for k in after if rng.random() < 0.4]:  # some publishers keep these within the article's element
        out += _around(rng, kind, prose)
        after.remove(kind)
    out.append(((f"</{body.split(' ')[0]}>" if body else "") + ("</table>" if outer == "table" else f"</{outer.split(' ')[0]}>" if outer else ""), False))
    for kind in after + ["menu"] * (rng.random() < 0.2 and not bare) + ["footer"] * (rng.random() < (0.9 if not bare else 0.2)):
        out += _around(rng, kind, prose)
    out.append(("</body></html>", False))
    return out
