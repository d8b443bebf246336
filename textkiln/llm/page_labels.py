"""A small table of labelled pages: ``data-label`` says of an element and all
below it whether it is the page's main text."""

from __future__ import annotations

import random

_LONG = [
    "The river rose slowly through the night, and by morning the lower fields were under water.",
    "Farmers moved their animals to the hill, while the council opened the old school as a shelter.",
    "Nobody was hurt, but several roads stayed closed, and the railway ran only as far as the bridge.",
    "A new survey of the harbour, the first in thirty years, found more birds than anyone had expected.",
    "Its authors walked the shore each week, counted nests, and compared the numbers with old notebooks.",
    "They ask for calm in spring; visitors with dogs should keep to the marked paths until July.",
]


def _paras(k: int, tag: str = "p") -> str:
    return "".join(f"<{tag}>{_LONG[(k + i) % 6]} {_LONG[(k + i + 2) % 6]}</{tag}>" for i in range(3))


_NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">Contact</a></li></ul></nav>'
_MENU = '<div class="menu"><ul><li><a href="/a">Start</a></li><li><a href="/b">Topics</a></li><li><a href="/c">About us</a></li></ul></div>'
_SIDE = f'<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Harbour survey</a></li><li><a href="/2">Floods</a></li></ul><p>{_LONG[1]}</p></aside>'
_SIDE_DIV = f'<div id="sidebar"><div class="widget"><h4>Related stories</h4><p><a href="/3">Birds of the coast</a></p><p>{_LONG[4]}</p></div></div>'
_AD = f'<div class="ad">{_LONG[2]}</div>'
_AD_LONG = f'<div class="advertisement"><p>{_LONG[0]}</p><p>{_LONG[5]} {_LONG[3]}</p></div>'
_SPONSOR = f'<section class="sponsored"><h2>Sponsored</h2><p>{_LONG[3]}</p></section>'
_COOKIE = '<div class="cookie-notice"><p>We use cookies to improve your visit, to measure traffic and to show adverts.</p><button>Accept</button></div>'
_NOTICE = '<div class="notice" role="alert"><p>This site will be down for maintenance on Sunday, from two to four in the morning.</p></div>'
_POPUP = f'<div id="newsletter-popup"><h2>Subscribe</h2><p>{_LONG[5]}</p><form><label>Mail</label><input name="m"><button>Go</button></form></div>'
_FORM = '<form action="/search"><p>Search the archive by word, place or year.</p><label>Word</label><input name="q"></form>'
_COMMENTS = f'<section id="comments"><h2>Comments</h2><div class="comment"><p>{_LONG[1]} {_LONG[2]}</p></div><div class="comment"><p>I saw it too, and it was worse than this says.</p></div></section>'
_COMMENTS_LIST = f'<ol class="commentlist"><li class="reply"><p>{_LONG[0]} {_LONG[4]}</p></li><li class="reply"><p>{_LONG[3]} {_LONG[5]}</p></li></ol>'
_SHARE = '<div class="share"><a href="#">Share</a> <a href="#">Print</a></div>'
_FOOT = f'<footer>&copy; example.com &middot; {_LONG[4]}</footer>'
_FOOT_DIV = '<div class="footer"><p>Copyright 2020, all rights reserved.</p><p><a href="/i">Imprint</a></p></div>'
_HEADER = '<header><h1>The Daily Shore</h1><p>News from the coast, every morning.</p></header>'
_HEADER_DIV = '<div id="header" class="site-header"><p>The Daily Shore, founded 1901, independent and local.</p></div>'
_HEAD = '<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>Floods</title><style>p{margin:0}</style><script>var a="</p>";</script></head><body>'


def _article(k: int, more: str = "") -> str:
    return f'<article data-label="content"><h1>Water in the lower fields</h1>{_paras(k)}{more}</article>'


def _plain(title: str, *paragraphs: str) -> str:
    return f'<article data-label="content"><h1>{title}</h1>' + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>"


def labelled_pages() -> list[str]:
    after_area = f'<div class="comments-area"><h3>2 replies</h3><p>{_LONG[4]}</p><p>{_LONG[2]} {_LONG[0]}</p></div>'
    other = "data-label=\"other\""
    inside = {name: part.replace(" ", f" {other} ", 1) if part.index(" ") < part.index(">") else part.replace(">", f" {other}>", 1) for name, part in {
        "ad": _AD, "share": _SHARE, "comments": _COMMENTS, "aside": _SIDE, "cookie": _COOKIE, "form": _FORM, "popup": _POPUP, "nav": _NAV, "sponsor": _SPONSOR,
        "adlong": _AD_LONG, "replies": _COMMENTS_LIST, "footer": _FOOT, "sidediv": _SIDE_DIV, "area": after_area, "notice": _NOTICE, "header": _HEADER}.items()}
    lists = "<h2>What helps</h2><ul><li>Keep boots dry.</li><li>Move tools upstairs, and the car uphill.</li><li>Call your neighbours.</li></ul>"
    quote = f"<blockquote><p>{_LONG[2]}</p></blockquote><pre>level = 3.2 m</pre><table><tr><th>Day</th><th>Level</th></tr><tr><td>Monday</td><td>3.2</td></tr></table>"
    short = '<article data-label="content"><h1>Closed</h1><p>Closed today.</p></article>'
    one = f'<article data-label="content"><h1>{_LONG[0][:60]}</h1><p><b>{_LONG[0]}</b></p></article>'
    many = f'<article data-label="content"><h1>{_LONG[3]}</h1>{_paras(0)}{_paras(3)}{_paras(1)}<p>Yes.</p><p>{_LONG[2]}<br>{_LONG[1]}<p>{_LONG[5]}</article>'
    linked = f'<article data-label="content"><h1>Links</h1><p>{_LONG[0]} <a href="/x">{_LONG[1]}</a></p><p><a href="/y">The whole survey, with tables.</a></p></article>'
    written = [
        _HEAD + _NAV + _AD + _article(0) + _FOOT + "</body></html>",
        _HEAD + _NAV + "<!-- ad 1 -->" + _AD + many + _FOOT,
        _HEAD + _NAV + _AD + one + _FOOT + "</body></html>",
        _HEAD + _NAV + _AD + short + _FOOT + "</body></html>",
        _HEAD + _HEADER + _NAV + '<main data-label="content">' + _article(1, lists) + "</main>" + _SIDE + _FOOT + "</body></html>",
        _HEAD + _COOKIE + _HEADER_DIV + _MENU + _article(2, quote) + _COMMENTS + _FOOT_DIV,
        _HEAD + _NAV + _article(3, inside["ad"] + "<p>" + _LONG[1] + "</p>" + inside["share"]) + _COMMENTS_LIST + _FOOT,
        _HEAD + _MENU + f'<div class="content" data-label="content"><h1>Birds</h1>{_paras(4)}{inside["aside"]}</div>' + _SIDE_DIV + _FOOT_DIV,
        _HEAD + _HEADER_DIV + f'<div id="main"><div class="post" data-label="content"><h2>Nests</h2><div class="entry">{_paras(5)}</div>{inside["comments"]}</div></div>' + _POPUP + _FOOT_DIV,
        _HEAD + _NAV + '<main data-label="content"><h1>Harbour</h1>' + _paras(2) + "<section><h2>Counts</h2>" + _paras(0) + lists + "</section>" + inside["form"] + "</main>" + _AD_LONG + _FOOT,
        _HEAD + _NOTICE + _HEADER + '<div class="page"><article data-label="content"><header><h1>Tides</h1></header>' + _paras(1) + inside["popup"] + f"<div>{_LONG[3]}</div></article>" + _SPONSOR + "</div>" + _FOOT,
        _HEAD + f'<div><div>{_NAV}</div><div><section data-label="content"><h1>Walks</h1>{_paras(3)}{quote}{inside["adlong"]}</section></div></div>' + _FORM + _FOOT_DIV,
        _HEAD + _HEADER + _article(4, inside["nav"] + inside["cookie"] + "<p>" + _LONG[4] + "</p>" + inside["replies"]) + _SIDE + _FOOT,
        _HEAD + _NAV + linked + _SIDE_DIV + _AD + _FOOT,
        _HEAD + _article(5, f"<figure><figcaption>{_LONG[5][:40]}</figcaption></figure>" + inside["sponsor"] + inside["footer"]) + _COOKIE + _FOOT,
        _HEAD + '<div id="content" data-label="content"><p>' + _LONG[2] + "</p><p>" + _LONG[3] + "</p><p>So it goes.</p></div>" + _MENU + _NOTICE + _FOOT_DIV,
        "<p data-label=\"content\">" + _LONG[0] + "</p><p data-label=\"content\">" + _LONG[1] + " " + _LONG[2] + "</p>" + _FOOT_DIV,
        _HEAD + _NAV + '<article data-label="content">' + inside["header"].replace("The Daily Shore", "Shore notes") + _paras(0) + inside["sidediv"] + inside["notice"] + _paras(2) + "</article>" + _FOOT,
        # Odd articles: no sentences, few words, shouting, tables in a row, links only.
        _HEAD + _NAV + _AD + _plain("Reed reed reed", "reed reed reed reed " * 30) + _FOOT + "</body></html>",
        _HEAD + _NAV + _AD + _plain("Reed", "Reed.", "Mud.") + _FOOT,
        _HEAD + _NAV + _AD_LONG + _plain("", "level | tide | wind | " * 20, "mud $$$ reed ### " * 10) + _FOOT + "</body></html>",
        _HEAD + _NAV + _AD + _plain("WATER!! RISES!!", "WATER!! IN!! THE!! FIELDS!! " * 12) + _FOOT,
        _HEAD + _NAV + _AD + _plain("Sources", '<a href="/1">The survey</a>', '<a href="/2">The notebooks, volume two</a>') + _FOOT,
        _HEAD + _NAV + _AD + _plain(_LONG[0], _LONG[0] + "<br>" + _LONG[1]) + _FOOT + "</body></html>",
        _HEAD + _NAV + _AD + _plain("3.2", "3.2 3.4 3.9 4.1 4.0 3.7", "2.9") + _COMMENTS + _FOOT,
        _HEAD + _MENU + "<main data-label=\"content\"><h1>Tide</h1><p>high low high low high low</p></main>" + _SIDE_DIV + _FOOT_DIV,
        # No container at all.
        "<html><body>" + f'<h1 data-label="content">Water</h1><p data-label="content">{_LONG[0]}</p><p data-label="content">{_LONG[3]} {_LONG[4]}</p>' + _FOOT,
        f'<p data-label="content">{_LONG[1]}</p><p data-label="content">{_LONG[2]}</p><ul data-label="content"><li>Boots and a lamp.</li><li>A long rope.</li></ul>',
        _NAV + f'<h2 data-label="content">Nests</h2><p data-label="content">{_LONG[5]}</p>' + _AD + f'<p data-label="content">{_LONG[4]}</p>' + _FOOT_DIV,
    ]
    return written + _combined(list(inside.values()))


def _combined(inside: list[str], pages: int = 140, seed: int = 5) -> list[str]:
    """Further pages: the parts above in other orders and layouts."""
    rng = random.Random(seed)
    before = [_NAV, _MENU, _HEADER, _HEADER_DIV, _COOKIE, _NOTICE, _AD, _AD_LONG, _FORM, _POPUP, '<div id="nav"><ul><li>Start</li><li>Topics</li></ul></div>',
              f'<div class="cookie-banner"><p>{_LONG[3]} {_LONG[1]}</p></div>', f'<div class="top-banner">{_LONG[5]}</div>']
    after = [_SIDE, _SIDE_DIV, _AD, _AD_LONG, _SPONSOR, _POPUP, _FORM, _COMMENTS, _COMMENTS_LIST, _SHARE, _FOOT_DIV,
             f'<div class="comments-area"><h3>2 replies</h3><p>{_LONG[4]}</p><p>{_LONG[2]} {_LONG[0]}</p></div>',
             f'<div class="related-posts"><h3>More</h3><p>{_LONG[1]}</p></div>', f'<aside><p>{_LONG[2]}</p><p>{_LONG[3]} {_LONG[4]}</p></aside>']

    feet = [f"<footer><p>{_LONG[2]} {_LONG[0]}</p></footer>", f'<footer><div><h3>About</h3><p>{_LONG[1]}</p></div><ul><li><a href="/i">Imprint</a></li></ul></footer>']
    before += [f'<header><a href="/">Shore</a><h1>Daily</h1><p>{_LONG[5]}</p></header>', f"<nav><p>{_LONG[0]}</p></nav>", f"<form><p>{_LONG[1]}</p></form>"]
    after += [f"<aside><h2>Also</h2><p>{_LONG[0]}</p></aside>", f"<form><p>{_LONG[4]}</p></form>"]

    def block() -> str:
        words = " ".join(rng.choice(_LONG).split()[: rng.randint(1, 14)])
        return rng.choice([
            lambda: f"<p>{rng.choice(_LONG)} {rng.choice(_LONG)}</p>", lambda: f"<p>{rng.choice(_LONG)}</p>", lambda: f"<p>{words}</p>",
            lambda: f"<p>{words.split()[0]} " + f"{words.split()[0]} " * 20 + "</p>", lambda: f"<h2>{words}</h2><p>{rng.choice(_LONG)}</p>",
            lambda: f"<ul><li>{words}</li><li>{rng.choice(_LONG)}</li></ul>", lambda: f"<p><b>{rng.choice(_LONG)}</b><br><p>{words}</p>",
            lambda: f"<blockquote>{rng.choice(_LONG)}</blockquote>", lambda: f'<p><a href="/s">{words}</a></p>', lambda: f"<div><p>{rng.choice(_LONG)}</p></div>",
            lambda: f"<section><h3>{words}</h3><p>{rng.choice(_LONG)}</p></section>", lambda: f"<table><tr><th>{words}</th><td>3.2</td></tr></table>",
        ])()

    inside = [*inside, *(part.replace(">", ' data-label="other">', 1) for part in (
        f'<aside class="related"><p>{_LONG[1]} {_LONG[3]}</p></aside>', f"<aside><p>{_LONG[5]}</p></aside>", f'<div class="promo">{_LONG[0]}</div>',
        f'<div class="ad-slot"><p>{_LONG[4]} {_LONG[2]}</p></div>', f"<footer><p>{_LONG[1]}</p></footer>", f"<form><p>{_LONG[2]}</p></form>"))]
    out = []
    for _ in range(pages):
        body = f"<h1>{' '.join(rng.choice(_LONG).split()[: rng.randint(1, 12)])}</h1>" + "".join(
            rng.choice(inside) if rng.random() < 0.25 else block() for _ in range(rng.randint(1, 9)))
        text = rng.choice([
            f'<article data-label="content">{body}</article>', f'<article data-label="content">{body}</article>', f'<main data-label="content"><article>{body}</article></main>',
            f'<main data-label="content"><article>{body}</article>{rng.choice(inside)}{rng.choice(inside)}</main>',
            f'<main data-label="content">{body}</main>', f'<div class="post" data-label="content"><div class="entry-content">{body}</div></div>',
            f'<article class="story" data-label="content"><header>{body[: body.index("</h1>")]}</h1></header>{body[body.index("</h1>") + 5 :]}</article>',
            f'<div id="main"><div class="article-body" data-label="content">{body}</div></div>', f'<section id="content" data-label="content">{body}</section>',
        ])
        wrap = rng.choice(["{}", "{}", "<div>{}</div>", '<div class="container">{}</div>', '<div id="page"><div class="row">{}</div></div>'])
        page = "".join(rng.sample(before, rng.randint(0, 4))) + text + "".join(rng.sample(after, rng.randint(0, 4)))
        out.append(_HEAD + wrap.format(page) + rng.choice([_FOOT, _FOOT_DIV, "", *feet]) + rng.choice(["</body></html>", ""]))
    return out
