"""The small labelled table of :mod:`ledgerline.llm.html_text`: pages as fragments, 1 where a fragment is main text.

Only numbers of words, links and marks are learnt, so texts are made of a few words in turn.
"""

from itertools import cycle, islice

_WORDS = "the committee met on Tuesday to hear of harbour and agreed a second survey".split()


def _t(n: int) -> str:
    """A text of ``n`` words."""
    return " ".join(islice(cycle(_WORDS), n))


def _p(*sizes: int, tag: str = "p") -> str:
    return "".join(f"<{tag}>{_t(n)}</{tag}>" for n in sizes)


def _linked(n: int, of: int) -> str:
    """A paragraph of ``of`` words, the first ``n`` of them a link."""
    return f"<p><a href='/l'>{_t(n)}</a> {_t(of - n)}</p>"


def _list(*sizes: int) -> str:
    """A list whose items are links."""
    return "<ul>" + "".join(f"<li><a href='/i'>{_t(n)}</a></li>" for n in sizes) + "</ul>"


_MENU = _list(1, 1, 2, 3)
_LINE = "<p><a href='/'>Home</a> <a href='/a'>Archive</a> <a href='/b'>About us</a></p>"
_OLDER = "<p><a href='/1'>Older</a> | <a href='/2'>Newer</a></p>"

#: Marked furniture, before and after the text of a page.
_BEFORE = (
    f"<nav>{_MENU}</nav><div class='ad'>{_t(3)}</div>",
    f"<header><div>{_t(3)}</div>{_MENU}</header><div id='cookie-notice'>{_t(17)}</div>",
    f"<div class='navbar'>{_MENU}</div><div class='header'>{_t(2)}</div><div class='notice'>{_p(70)}</div>",
    f"<header><h1>{_t(3)}</h1><p>{_t(17)}</p></header><div class='alert-box'>{_t(25)}</div>",
    f"<div role='navigation'>{_LINE}</div><aside><h3>{_t(1)}</h3>{_p(60, 4)}{_list(5, 6)}</aside>",
)
_AFTER = (
    f"<footer>&copy; {_t(6)}</footer>",
    f"<section id='comments'><h3>Comments</h3>{_p(70, 1, 12)}</section><footer><p>Imprint</p>{_p(40)}</footer>",
    f"<div class='sidebar'>{_p(18, 50)}</div><div class='comment-list'>{_p(65, 3)}</div><div id='footer'>{_t(4)}</div>",
    f"<form><label>{_t(2)}</label>{_p(20)}</form><div class='newsletter'><h3>{_t(4)}</h3>{_p(17)}</div>",
    f"<aside class='related'><h2>{_t(2)}</h2>{_list(8, 30, 12)}{_p(40)}</aside>",
)
#: Unmarked furniture: lists and lines of links, a site's name, comments under their heading.
_BARE_BEFORE = (_MENU, _LINE, f"<div>{_MENU}</div><div>Town</div>", _LINE + _MENU, _list(30, 28, 33, 30, 31), "")
_BARE_AFTER = (
    _OLDER + f"<p><a href='/t'>Terms</a></p>",
    _list(30, 30, 31, 29, 30),
    f"<h3>Comments</h3>{_p(40, 3, 22)}",
    f"<div>{_list(7, 9, 12)}</div>{_OLDER}",
    f"<h2>Related articles</h2>{_list(9, 14, 20)}",
    f"<h4>Leave a reply</h4>{_p(9, 16)}{_linked(14, 16)}{_linked(40, 44)}",
    f"<h3>{_t(1)}</h3>{_list(8, 6, 11)}",
    "",
)
#: Main text: long and short paragraphs, headings of any length, lists, tables, links among words.
_TEXT = (
    f"<h1>{_t(2)}</h1>{_p(70)}<p>Agreed.</p>{_p(17)}",
    f"<h1>T</h1>{_p(12)}<h2>{_t(1)}</h2><ul><li>One</li><li>{_t(4)}</li></ul>{_p(45, 20)}",
    f"<h1>{_t(9)}</h1>{_p(68, 72, 15)}{_linked(8, 40)}<blockquote>{_t(3)}</blockquote>{_p(64)}",
    f"<h1>{_t(4)}</h1>{_p(6, 30)}{_linked(3, 9)}{_p(55)}<h3>{_t(2)}</h3>{_p(33, 8, 41)}",
    f"<h2>{_t(1)}</h2>{_linked(10, 30)}{_linked(12, 44)}{_p(25)}<p>So it did.</p>{_p(90)}",
    f"{_p(32, 40)}<table><tr><td>Apples</td><td>12</td></tr></table>{_p(28)}{_linked(2, 31)}",
)
#: Inside a main element any text is main text, linked and short text too.
_INSIDE = (
    f"<p><a href='/x'>{_t(3)}</a></p><p>So it did.</p>",
    f"<ul><li><a href='/m'>Mill</a></li><li><a href='/p'>Pond</a></li></ul><p>No.</p>",
    f"<p><b>That it.<br>",
    f"<div class='legal-news'>{_p(30, 5)}</div><section class='search-history'>{_p(12)}</section>",
    f"{_p(5)}{_linked(9, 9)}{_p(12)}{_list(4, 9)}{_p(3)}{_linked(20, 21)}{_p(38)}{_list(12)}<p>{_t(2)}</p>{_list(2, 3)}",
)

#: Outside of it none is.
_OUTSIDE = (
    f"<div>{_t(4)}</div>{_MENU}",
    f"<p>{_t(68)}</p><div>{_t(17)}</div>",
    f"<h3>{_t(2)}</h3>{_p(33, 41)}{_list(8, 9)}",
    f"<div class='story-alert'>{_t(9)}</div>{_p(5, 24)}",
)

_PAGES: list[tuple[tuple[int, str], ...]] = []
# With a main element: between marked furniture, with furniture inside, and text outside that is none.
for _i, _open in enumerate(
    ("<article>", "<main>", "<div class='content'>", "<div id='main-content'>", "<div class='post legal-news'>",
     "<div class='story-alert'>", "<main class='search-page'>", "<article>", "<main role='main'>", "<section class='story'>", "<article class='post has-sidebar'>", "<td class='entry'>")
):
    _PAGES.append(
        (
            (0, f"<html><head><title>{_t(3)}</title></head><body>{_BEFORE[_i % 5]}"),
            (1, _open + _TEXT[_i % 6]),
            (0, (f"<div class='share'>{_t(3)}</div>", f"<aside>{_p(17)}</aside>", f"<div class='advert'>{_t(9)}</div>")[_i % 3]),
            (1, _INSIDE[_i % 5] + f"{_p(17)}</{_open[1:].split()[0].rstrip('>')}>"),
            (0, _OUTSIDE[_i % 4]),
            (0, _AFTER[_i % 5] + "</body></html>"),
        )
    )
# Without one: marked furniture, then unmarked furniture.
for _i, _text in enumerate(_TEXT):
    _PAGES.append(((0, "<body>" + _BEFORE[_i % 5]), (1, _text), (0, _AFTER[_i % 5])))
    _PAGES.append(((0, "<body>" + _BEFORE[(_i + 2) % 5]), (1, f"<div>{_text}</div>"), (0, _AFTER[(_i + 3) % 5])))
for _i in range(12):
    _PAGES.append(
        ((0, "<body>" + _BARE_BEFORE[_i % 6]), (1, _TEXT[(_i + _i // 6) % 6]), (0, _BARE_AFTER[_i % 8] + "</body>"))
    )
# Names that only sound like furniture.
for _i, _class in enumerate(("legal-news", "search-history", "social-science", "alert-levels")):
    _PAGES.append(((0, _LINE), (1, f"<div class='{_class}'>{_TEXT[_i]}</div>"), (0, _AFTER[_i])))
# Menus, lists of links and a short text alone.
_PAGES += [
    ((0, f"<body>{_MENU}{_list(6, 9, 12)}{_OLDER}"),),
    ((0, f"<body><h2>{_t(2)}</h2>{_list(30, 31, 30, 29, 30)}<h2>{_t(2)}</h2>{_list(6, 9, 8, 7)}"),),
    ((1, f"<body><h1>{_t(1)}</h1><p>{_t(14)}</p>"),),
    ((1, f"<p>{_t(30)}</p>"),),
    ((0, _MENU), (1, _p(35, 50, 18)), (0, _OLDER)),
    ((0, _LINE + _list(6, 9)), (1, _p(60) + _linked(6, 45) + _p(22)), (0, _list(9, 12))),
    ((0, _LINE), (1, f"<div>{_p(26, 70)}</div>"), (0, _MENU + _OLDER)),
    ((0, f"<aside>{_p(30)}</aside><footer>{_p(20, 2)}</footer>"),),
]

PAGES = tuple(_PAGES)
