"""Labelled pages that the content model learns from.

The layouts are written for this library. ``data-label="main"`` marks content, ``data-label="not"`` what is no content
inside it. {t} stands for a title, {p} for a paragraph, {q} for a sentence, {s} for a few words, {m} for many
paragraphs; [a|b|c] for one of several names. Sections between << and >> are left out of some pages.
"""

from __future__ import annotations

import random
import re

#: Pages made from each layout.
COPIES = 10

_NAV = '<nav><ul><li><a href="/a">{s}</a></li><li><a href="/b">{s}</a></li><li><a href="/c">{s}</a></li><li><a href="/d">{s}</a></li></ul></nav>'
_DIV_NAV = '<div class="[menu|main-menu|navigation|navbar|site-nav|topnav]"><ul><li><a href="/a">{s}</a><li><a href="/b">{s}</a><li><a href="/c">{s}</a></ul></div>'
_TOP = '<header class="[site-header|top|masthead|header]"><div class="[logo|brand|site-title]"><a href="/">{s}</a></div><p>{q}</p></header>'
_FOOT = '<footer>&copy; {s} &middot; {q}</footer>'
_LONG_FOOT = '<footer class="[site-footer|page-footer]"><div><h3>{s}</h3><p>{q}</p></div><div><h3>{s}</h3><ul><li><a href="/x">{s}</a></li><li><a href="/y">{s}</a></li></ul></div><p>&copy; {q}</p></footer>'
_AD = '<div class="[ad|ads|advert|advertisement|ad-slot|sponsored|promo]">{q}</div>'
_LONG_AD = '<div class="[ad|advert|banner|promo-box|sponsor]"><p>{q} {q}</p><a href="/buy">{s}</a></div>'
_SIDE = '<aside><h2>{s}</h2><ul><li><a href="/1">{t}</a></li><li><a href="/2">{t}</a></li><li><a href="/3">{t}</a></li></ul><p>{q}</p></aside>'
_DIV_SIDE = '<div id="[sidebar|side|right-rail|secondary]" class="[widget-area|column|side]"><div class="widget"><h3>{s}</h3><p>{q} {q}</p></div><div class="widget"><h3>{s}</h3><ul><li><a href="/1">{t}</a></li><li><a href="/2">{t}</a></li></ul></div></div>'
_COOKIE = '<div class="[cookie-banner|cookie|consent|gdpr-notice|notice|cookie-notice]"><p>{q} {q}</p><button>{s}</button></div>'
_NOTICE = '<div role="alert" class="[notice|alert|message|popup]">{q}</div>'
_FORM = '<form action="/go"><label>{s}</label><input name="e"><p>{q}</p><button>{s}</button></form>'
_NEWS = '<div class="[newsletter|subscribe|signup|login-box]"><h3>{s}</h3><p>{q}</p><form><input name="m"><button>{s}</button></form></div>'
_COMMENTS = '<section class="[comments|comment-list|discussion|replies|responses]" id="[comments|respond|disqus_thread]"><h2>{s}</h2><div class="comment"><p class="[author|comment-meta]">{s}</p><p>{p}</p></div><div class="comment"><p>{s}</p><p>{p}</p><p>{p}</p></div><div class="comment"><p>{p}</p></div></section>'
_LIST_COMMENTS = '<div id="comments"><h3>{s}</h3><ol class="[comment-list|commentlist]"><li><b>{s}</b><p>{p}</p></li><li><b>{s}</b><p>{p}</p></li></ol></div>'
_SHARE = '<div class="[share|social|share-buttons|social-links]"><a href="/f">{s}</a> <a href="/t">{s}</a></div>'
_RELATED = '<div class="[related|related-posts|recommended|more-stories|read-more]"><h3>{s}</h3><ul><li><a href="/1">{t}</a></li><li><a href="/2">{t}</a></li></ul></div>'
_CRUMBS = '<div class="[breadcrumb|breadcrumbs|crumbs]"><a href="/">{s}</a> &gt; <a href="/x">{s}</a> &gt; {s}</div>'
_PS = '<p>{p}</p><p>{p}</p><p>{p}</p>'
_LOOSE = '<p>{p}<p>{p}<p><b>{s}.<br><p>{p}'
_SHORT = '<p><b>{q}<br><p>{p}</p>'
_MIXED = '<p>{p}</p><h2>{t}</h2><p>{p}</p><ul><li>{q}</li><li>{q}</li><li>{q}</li></ul><p>{q}</p><blockquote><p>{q}</p></blockquote><p>{s}.</p>'
_RICH = '<p>{p}</p><h2>{t}</h2><pre>{q}</pre><p>{q}</p><table><tr><th>{s}</th><th>{s}</th></tr><tr><td>{s}</td><td>{q}</td></tr></table><figure><img src="x"><figcaption>{q}</figcaption></figure><ol><li>{q}</li><li>{p}</li></ol>'

LAYOUTS = (
    f'<<{_NAV}>><<{_AD}>><article data-label="main"><h1>{{t}}</h1>{_LOOSE}</article><<{_FOOT}>>',
    f'{_NAV}{_AD}<article data-label="main"><h1>{{t}}</h1>{_SHORT}</article>{_FOOT}',
    f'{_NAV}<<{_AD}>><article data-label="main"><h1>{{t}}</h1>{_PS}</article><<{_FOOT}>>',
    f'<<{_TOP}>><<{_NAV}>><<{_COOKIE}>><main><article data-label="main"><h1>{{t}}</h1>{_PS}<<{_PS}>></article></main><<{_SIDE}>>{_LONG_FOOT}',
    f'{_TOP}{_DIV_NAV}<div class="[content|main|main-content|page]"><div class="[post|entry|story]" data-label="main"><h1 class="[title|headline]">{{t}}</h1>{_MIXED}</div><<{_COMMENTS}>></div><<{_DIV_SIDE}>>{_LONG_FOOT}',
    f'<<{_COOKIE}>>{_TOP}<main data-label="main"><h1>{{t}}</h1>{_PS}<<{_RICH}>></main><<{_SIDE}>><<{_NEWS}>>{_FOOT}',
    f'{_DIV_NAV}<<{_CRUMBS}>><div id="[wrapper|page|container]"><div id="[content|main|article]" data-label="main"><h1>{{t}}</h1>{_RICH}{_SHARE.replace("<div", "<div", 1).replace(">", " data-label=not>", 1)}</div>{_DIV_SIDE}</div><<{_FOOT}>>',
    f'{_NAV}<article data-label="main"><header><h1>{{t}}</h1></header>{_PS}<aside data-label="not"><h3>{{s}}</h3><p>{{q}}</p></aside>{_PS}{_AD.replace(">", " data-label=not>", 1)}{_PS}{_COMMENTS.replace(">", " data-label=not>", 1)}</article>{_LONG_FOOT}',
    f'<<{_NOTICE}>>{_TOP}{_NAV}<section><article data-label="main"><h1>{{t}}</h1>{_MIXED}{_FORM.replace(">", " data-label=not>", 1)}<<{_PS}>></article><<{_RELATED}>><<{_LIST_COMMENTS}>></section>{_LONG_FOOT}',
    f'<div class="[header|top|banner]"><h2>{{s}}</h2><p>{{q}}</p></div>{_DIV_NAV}<div class="[article-body|post-content|entry-content|story-body|text]" data-label="main">{_PS}{_PS}</div><<{_RELATED}>><<{_LIST_COMMENTS}>><div class="[footer|foot|bottom]">{{q}} {{s}}</div>',
    f'<table><tr><td><a href="/1">{{s}}</a><br><a href="/2">{{s}}</a><br><a href="/3">{{s}}</a></td><td data-label="main"><h1>{{t}}</h1>{_PS}</td></tr></table>{_FOOT}',
    f'{_NAV}<div><div data-label="main"><h1>{{t}}</h1>{_PS}{_PS}</div></div><<{_LONG_AD}>><<{_SIDE}>>{_FOOT}',
    f'{_TOP}<<{_NEWS}>><div class="[layout|row|grid]"><div class="[col|left]"><article data-label="main"><h1>{{t}}</h1><p>{{q}}</p>{_RICH}{_RELATED.replace(">", " data-label=not>", 1)}</article>{_COMMENTS}</div>{_DIV_SIDE}</div>{_LONG_FOOT}',
    f'<<{_COOKIE}>><<{_LONG_AD}>>{_NAV}<article class="[post|h-entry|article]" data-label="main"><h1>{{t}}</h1>{_MIXED}{_NEWS.replace(">", " data-label=not>", 1)}{_PS}{_LIST_COMMENTS.replace(">", " data-label=not>", 1)}</article><<{_AD}>>{_FOOT}',
    f'{_TOP}{_NAV}<<{_NOTICE}>><div class="[blog|posts|wrap]"><section class="[article|reading]" data-label="main"><h2>{{t}}</h2>{_MIXED}</section></div><<{_FORM}>><<{_COMMENTS}>>{_LONG_FOOT}',
    f'{_NAV}{_AD}<article data-label="main"><h1>{{t}}</h1><p>{{s}}.</p><p>{{q}}</p></article><<{_SIDE}>>{_FOOT}',
    f'{_TOP}{_NAV}<main data-label="main"><p>{{q}}</p></main><<{_COOKIE}>>{_FOOT}',
    f'<<{_NAV}>><<{_AD}>><article data-label="main"><h1>{{t}}</h1>{{m}}</article><<{_SIDE}>><<{_FOOT}>>',
    f'{_TOP}<<{_DIV_NAV}>><div class="[content|post|text|story]" data-label="main"><h1>{{t}}</h1>{{m}}</div><<{_COMMENTS}>><<{_DIV_SIDE}>>{_LONG_FOOT}',
)


def _fill(layout: str, rng: random.Random) -> str:
    def words(n: int) -> str:
        return " ".join("".join(rng.choice("aeinorst") for _ in range(rng.randint(2, 9))) for _ in range(n))

    def sentence(n: int) -> str:
        text = words(n).capitalize()
        return (text.replace(" ", ", ", 1) if rng.random() < 0.4 else text) + "."

    makers = {
        "t": lambda: words(rng.randint(3, 12)).capitalize() + rng.choice(["", "."]),
        "s": lambda: words(rng.randint(1, 3)),
        "q": lambda: sentence(rng.randint(4, 16)),
        "p": lambda: " ".join(sentence(rng.randint(3, 18)) for _ in range(rng.randint(1, 9))),
    }

    def many() -> str:
        short = rng.random() < 0.5
        return "".join(f"<p>{sentence(rng.randint(4, 9)) if short else makers['p']()}</p>" for _ in range(rng.randint(15, 250)))

    makers["m"] = many
    layout = re.sub(r"<<(.*?)>>", lambda m: m[1] if rng.random() < 0.6 else "", layout)
    layout = re.sub(r"\[([^\]]*\|[^\]]*)\]", lambda m: rng.choice(m[1].split("|")), layout)
    return re.sub(r"\{([tsqpm])\}", lambda m: makers[m[1]](), layout)


def pages(copies: int = COPIES, seed: int = 3) -> list[str]:
    """The layouts filled in ``copies`` times; a seed gives the same pages again."""
    rng = random.Random(seed)
    head = '<!DOCTYPE html><html><head><meta charset="utf-8"><title>x</title><style>p{margin:0}</style></head><body>'
    return [head + _fill(layout, rng) + "</body></html>" for _ in range(copies) for layout in LAYOUTS]
