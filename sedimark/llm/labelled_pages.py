"""Labelled pages for training the block tagger: layouts written by hand, filled with drawn words.

Each page is a list of (html, label) pieces, so the label of each block is known by construction: 1 for the article,
0 for menus, headers, footers, sidebars, notices, adverts, forms and reader comments.
"""

from __future__ import annotations

import random

_SYLLABLES = "ba co den er fi gra ha il jo ka lu men no or pe qui ra so ta un ve wi xa yo zu".split()
#: Names of what holds readers' comments, and of one comment.
_COMMENTS = "comments comment-list responses discussion replies reactions discuss thread feedback respond disqus user-comments reader-comments conversation opinions talkback".split()
_COMMENT = "comment reply response reaction post-reply message remark".split()
_MENU = "Home News Sport About Contact Archive Shop Login Register Help Blog Media Careers Topics Search".split()


class _Words:
    def __init__(self, pick: random.Random):
        self.pick = pick

    def word(self) -> str:
        return "".join(self.pick.choice(_SYLLABLES) for _ in range(self.pick.randrange(1, 4)))

    def some(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.pick.randrange(low, high)))

    def sentence(self, low: int = 4, high: int = 18) -> str:
        noise = self.pick.random() < 0.15
        mark = self.pick.choice(["###", "***", "!!", "|"]) if noise else ""
        return " ".join(w + (mark if self.pick.random() < 0.6 else "") for w in self.some(low, high).split()).capitalize() + self.pick.choice([".", ".", ".", "?", "!"])

    def paragraph(self) -> str:
        return " ".join(self.sentence() for _ in range(self.pick.choice([1, 1, 2, 4, 7])))


def _menu(w: _Words) -> str:
    p = w.pick
    items = [p.choice([p.choice(_MENU), w.word()]) for _ in range(p.randrange(3, 9))]
    if p.random() < 0.7:
        return "<ul>" + "".join(f'<li><a href="/{x}">{x}</a></li>' for x in items) + "</ul>"
    return "".join(f'<a href="/{x}">{x}</a>{p.choice([" ", " | "])}' for x in items)


def _notice(w: _Words) -> str:
    p = w.pick
    kind = p.choice(["ad", "ads", "advert", "sponsored", "promo", "banner", "cookie-notice", "newsletter", "share", "social", "popup"])
    text = p.choice([w.sentence(), w.paragraph(), f"<p>{w.sentence()}</p>", f'<a href="/x">{w.sentence()}</a>'])
    return f'<{(t := p.choice(["div", "div", "section", "aside"]))} {p.choice(["class", "id"])}="{kind}">{text}</{t}>'


def _before(w: _Words) -> list[str]:
    p = w.pick
    out = []
    if p.random() < 0.4:
        out.append(f"<header><div class=\"logo\">{w.some(1, 3).title()}</div>{p.choice(['', '<p>' + w.sentence() + '</p>'])}</header>")
    if p.random() < 0.85:
        out.append(p.choice([f"<nav>{_menu(w)}</nav>", f'<div class="{p.choice(["menu", "nav", "navbar", "breadcrumb"])}">{_menu(w)}</div>']))
    if p.random() < 0.6:
        out.append(_notice(w))
    return out


def _comments_title(w: _Words) -> str:
    p = w.pick
    tag = p.choice(["h2", "h3", "h4", "p"])
    return f"<{tag}>{p.choice(['Comments', f'{p.randrange(2, 90)} comments', w.some(1, 4).capitalize(), w.sentence()])}</{tag}>"


def _aside(w: _Words) -> str:
    """What stands inside an article without being part of it."""
    p = w.pick
    inner = p.choice([f"<p>{w.paragraph()}</p>", f"<h4>{w.some(1, 4)}</h4><p>{w.sentence()}</p>", _menu(w)])
    return p.choice([f"<aside>{inner}</aside>", f"<aside>{inner}</aside>", f'<div class="related">{inner}</div>', f'<form><label>{w.some(1, 3)}</label><input><button>{w.some(1, 3)}</button></form>', _notice(w)])


def _after(w: _Words) -> list[str]:
    p = w.pick
    out = []
    if p.random() < 0.4:
        one = lambda: p.choice([
            f"<li>{w.paragraph()}</li>", f"<p>{w.paragraph()}</p>", f'<div class="{p.choice(_COMMENT)}"><b>{w.word()}</b><p>{w.paragraph()}</p></div>',
            f'<div class="{p.choice(_COMMENT)}"><p>{w.paragraph()}</p></div>', f'<article class="{p.choice(_COMMENT)}"><h4>{w.word()}</h4><p>{w.paragraph()}</p></article>',
        ])
        each = "".join(one() for _ in range(p.randrange(1, 4)))
        title = p.choice([_comments_title(w), _comments_title(w), ""])
        out.append(f'<{(t := p.choice(["div", "div", "section", "ol", "ul"]))} {p.choice(["id", "class"])}="{p.choice(_COMMENTS)}">{title}{each}</{t}>')
    if p.random() < 0.1:  # under a name that says nothing
        out.append(f'<div {p.choice(["id", "class"])}="{w.word()}"><p>{w.paragraph()}</p></div>')
    if p.random() < 0.35:
        out.append(f'<{(t := p.choice(["aside", "div"]))} class="{p.choice(["sidebar", "related", "widget"])}"><h4>{w.some(1, 4)}</h4>{p.choice([_menu(w), "<p>" + w.paragraph() + "</p>"])}</{t}>')
    if p.random() < 0.3:
        out.append(f'<form action="/s"><label>{w.some(1, 4)}</label><input name="q"><select><option>{w.word()}<option>{w.word()}</select><button>{w.word()}</button><p>{w.sentence()}</p></form>')
    if p.random() < 0.25:
        out.append(_notice(w))
    if p.random() < 0.9:
        end = p.choice([f"&copy; {w.word()}.example &middot; {w.sentence()}", f"<p>&copy; {p.randrange(1999, 2026)} {w.some(1, 5)}</p>", f"<p>{w.sentence()}</p>{_menu(w)}", w.paragraph()])
        out.append(p.choice([f"<footer>{end}</footer>", f"<footer>{end}</footer>", f'<div class="footer">{end}</div>', f'<div id="copyright">{end}</div>']))
    return out


def _article(w: _Words) -> list[str]:
    p = w.pick
    out = [f"<h1>{w.some(2, 10).capitalize()}{p.choice(['', '.', '&amp;'])}</h1>"]
    for _ in range(p.randrange(0, 9)):
        kind = p.random()
        if kind < 0.6:
            out.append(f"<p>{w.paragraph()}{p.choice(['</p>', '</p>', ''])}")
        elif kind < 0.7:
            out.append(f"<p><b>{w.sentence()}<br><p>{w.paragraph()}</p>")
        elif kind < 0.78:
            out.append(f"<h2>{w.some(1, 6).capitalize()}</h2>")
        elif kind < 0.84:
            out.append("<ul>" + "".join(f"<li>{w.some(1, 9)}{p.choice(['', '</li>'])}" for _ in range(p.randrange(2, 5))) + "</ul>")
        elif kind < 0.88:
            out.append(f"<blockquote>{w.paragraph()}</blockquote>")
        elif kind < 0.92:
            out.append(f'<p>{w.some(2, 9)} <a href="/y">{w.some(1, 4)}</a> {w.sentence()}</p>')
        elif kind < 0.95:
            out.append(f"<table><tr><th>{w.word()}<th>{w.word()}<tr><td>{w.some(1, 3)}<td>{w.some(1, 3)}</table>")
        elif kind < 0.98:
            out.append(f"<pre>{w.some(2, 12)}</pre>")
        else:
            out.append(f"<figure><img src=\"a.png\"><figcaption>{w.sentence()}</figcaption></figure>")
    return out


def pages(n: int, seed: int = 11) -> list[list[tuple[str, int]]]:
    """``n`` pages as (html, label) pieces in order; label is the label of every block that begins in the piece."""
    out = []
    for k in range(n):
        w = _Words(random.Random(seed * 1_000_003 + k))
        p = w.pick
        start, end = p.choice([("<article>", "</article>")] * 4 + [("<main>", "</main>"), ('<div class="content">', "</div>"), ('<div id="article-body">', "</div>"), ("<main><article>", "</article></main>"), ('<section class="post">', "</section>")])
        page = [(f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{w.sentence()}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>', 0)]
        page += [(x, 0) for x in _before(w)] + [(start, 0)]
        for x in _article(w):
            page.append((x, 1))
            if p.random() < 0.08:
                page.append((_aside(w), 0))
        page += [(end, 0)] + [(x, 0) for x in _after(w)] + [("</body></html>", 0)]
        out.append(page)
    return out
