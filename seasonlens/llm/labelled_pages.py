"""Pages written to train the content model: ``data-content`` labels an element and what is in it."""

_LONG = (
    "The harbour was quiet when the first boats came back, and the crews spoke in low voices about the weather they "
    "had met. Nobody had expected the wind to turn so early in the year."
)
_MORE = "Later the mayor said that the pier would be mended before winter, although the money has yet to be found."
_SHORT = "A short remark."

_LINKS = '<ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">Contact us</a></li></ul>'
_NAV = f"<nav>{_LINKS}</nav>"
_HEADER = '<header><a href="/">The Daily Boat</a><p>News since 1901</p></header>'
_FOOTER = '<footer><p>&copy; 2020 The Daily Boat. All rights reserved.</p><a href="/legal">Legal</a></footer>'
_ASIDE = f'<aside><h3>Related</h3>{_LINKS}<p>Most read this week: {_MORE}</p></aside>'
_SIDEBAR = f'<div class="sidebar"><h3>Popular</h3>{_LINKS}<p>{_MORE}</p></div>'
_COOKIES = f'<div class="cookie-notice"><p>We use cookies. {_MORE}</p><button>Accept</button></div>'
_ADVERT = f'<div class="ad">{_LONG}</div>'
_BANNER = f'<div id="banner" class="sponsored"><p>{_LONG}</p><p>{_MORE}</p></div>'
_FORM = '<form action="/s"><p>Sign up for our letters.</p><label>Name <input name="q"></label><button>Send</button></form>'
_COMMENTS = f'<section class="comments" data-content="0"><h2>Comments</h2><div class="comment"><p>{_LONG}</p></div><div class="comment"><p>{_SHORT}</p></div></section>'
_BODY = f"<h1>Boats return</h1><p>{_LONG}</p><p>{_MORE}</p><h2>What next</h2><p>{_SHORT}</p><p>{_LONG} <a href='/x'>See here.</a></p>"
_LIST = f"<p>{_LONG}</p><ul><li>{_MORE}</li><li>{_SHORT}</li></ul><blockquote><p>{_LONG}</p></blockquote><table><tr><td>One</td><td>{_MORE}</td></tr></table>"


def _page(*parts: str) -> str:
    return f"<html><head><title>Boats</title><style>p{{}}</style></head><body>{''.join(parts)}<script>track()</script></body></html>"


PAGES = [
    _page(_NAV, _ADVERT, f'<article data-content="1">{_BODY}</article>', _FOOTER),
    _page(_HEADER, _NAV, _COOKIES, f'<main><article data-content="1">{_BODY}{_LIST}</article>{_ASIDE}</main>', _FOOTER),
    _page(_HEADER, f'<div id="content" data-content="1">{_BODY}</div>', _SIDEBAR, _FOOTER),
    _page(_COOKIES, _HEADER, _NAV, f'<div class="post"><div class="entry-content" data-content="1">{_BODY}{_LIST}</div>{_COMMENTS}</div>', _SIDEBAR, _FOOTER),
    _page(_NAV, f'<article data-content="1">{_BODY}<div class="ad" data-content="0">{_MORE}</div><p>{_MORE}</p>{_COMMENTS}</article>', _FORM, _FOOTER),
    _page(_BANNER, f'<article data-content="1">{_LIST}{_BODY}<aside data-content="0"><p>{_LONG}</p></aside><p>{_LONG}</p></article>', _ASIDE, _FOOTER),
    _page(_HEADER, f'<main data-content="1">{_BODY}<form data-content="0"><p>{_SHORT}</p></form></main>', _SIDEBAR, _COMMENTS, _FOOTER),
    _page(f'<div class="header"><p>{_SHORT}</p>{_LINKS}</div>', f'<div class="article-body" data-content="1">{_BODY}</div>', f'<div class="footer"><p>{_MORE}</p>{_LINKS}</div>'),
    _page(_NAV, f'<section data-content="1">{_BODY}<nav data-content="0">{_LINKS}</nav>{_LIST}</section>', f'<div class="newsletter"><p>{_LONG}</p></div>', _FOOTER),
    _page(_ADVERT, f'<article data-content="1"><h1>Short</h1><p>{_SHORT}</p></article>', _COMMENTS, _FOOTER),
    _page(_NAV, f'<article data-content="1"><header data-content="0"><p>{_SHORT}</p>{_LINKS}</header>{_BODY}<footer data-content="0"><p>{_MORE}</p></footer></article>', _BANNER),
    _page(_NAV, f'<article data-content="1">{_BODY}<section class="comments" data-content="0"><h2>Readers say</h2><p>{_LONG}</p><p>{_SHORT}</p></section></article>', _FOOTER),
    _page(_HEADER, f'<article data-content="1">{_LIST}<div id="comments" data-content="0"><h3>Comments</h3><ol><li><p>{_MORE}</p></li><li><p>{_LONG}</p></li></ol></div></article>', _FOOTER),
    _page(_NAV, f'<main><article data-content="1">{_BODY}<ul class="replies" data-content="0"><li>{_LONG}</li><li>{_SHORT}</li></ul></article></main>', _SIDEBAR, _FOOTER),
    _page(_HEADER, f'<article data-content="1"><div class="notice" data-content="0"><p>{_MORE}</p></div>{_BODY}<div class="related" data-content="0"><p>{_LONG}</p>{_LINKS}</div></article>', _FOOTER),
    _page(_NAV, f'<article data-content="1">{_BODY}<div class="share" data-content="0"><p>{_SHORT}</p></div><div class="newsletter" data-content="0"><p>{_LONG}</p></div><p>{_LONG}</p></article>', _COMMENTS, _FOOTER),
    _page(f'<div class="topbar">{_MORE}</div>', f'<div class="menu">{_LINKS}</div>', f'<article data-content="1">{_BODY}</article>', f'<div class="comments"><h2>Comments</h2><p>{_LONG}</p><p>{_MORE}</p></div>', f'<div class="popup"><p>{_LONG}</p></div>'),
]
