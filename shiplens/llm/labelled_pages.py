"""Labelled pages that the main-text model is fitted on.

``data-main="1"`` starts main text and ``data-main="0"`` ends it, each for the whole element unless
one further in says otherwise; what has no mark above it is not main text. ``data-text="1"`` says
that text which stands in the element itself is main text, and nothing about the element.
"""

_P = (
    "The council met on Tuesday evening to discuss the new bridge, which has been planned for years.",
    "Several residents spoke against it. They fear noise, they said, and the loss of the old trees.",
    "Engineers explained how the foundations would be laid; the work should take eighteen months.",
    "In the end the members voted for the plan by a narrow margin, and building starts in spring.",
)
_SHORT = "A small note closes the piece."

PAGES = (
    f"""<html><head><title>Bridge</title></head><body>
    <header><a href="/">Daily</a><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">Sport</a></li></ul></nav></header>
    <main><article data-main="1"><h1>A new bridge</h1><p>{_P[0]}</p><p>{_P[1]} <a href="/x">Read the plan</a> for more.</p>
    <div data-main="0" class="ad">Buy one and get one free today.</div><h2>How it is built</h2><p>{_P[2]}</p><ul><li>Piers of stone</li><li>A deck of steel</li></ul><p>{_SHORT}</p></article></main>
    <aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Storm hits coast</a></li><li><a href="/2">Team wins again</a></li></ul></aside>
    <footer>&copy; 2020 Daily. <a href="/privacy">Privacy</a> <a href="/terms">Terms</a></footer></body></html>""",
    f"""<html><body><div id="header" class="site-header"><div class="logo">Town Post</div><div id="nav" class="menu navbar"><a href="/">Home</a> <a href="/local">Local</a> <a href="/world">World</a></div></div>
    <div id="container" class="wrapper"><div class="breadcrumb"><a href="/">Home</a> &gt; <a href="/local">Local</a></div>
    <div id="content" class="post entry-content" data-main="1"><h1 class="title">Bridge plan passes</h1><p>{_P[3]}</p><p>{_P[0]}</p><blockquote><p>{_P[1]}</p></blockquote><p>{_SHORT}</p>
    <div data-main="0" class="share social"><a href="/f">Share</a> <a href="/t">Tweet</a></div></div>
    <div id="sidebar" class="side column widget"><div class="widget promo">Subscribe to our paper and save half the price this month.</div><div class="widget tags"><a href="/k">bridge</a> <a href="/l">council</a></div></div>
    <div id="comments" class="comments comment-list"><h3>Comments</h3><div class="comment"><p>I think this is a great idea, and I hope that it will be built soon.</p></div><div class="comment reply"><p>Not everyone agrees with you. The trees were there before any of us.</p></div>
    <form action="/c"><label>Your name</label><input name="n"><textarea></textarea><button>Send</button></form></div></div>
    <div id="footer" class="footer"><p>All rights reserved. Town Post is a local paper for local people.</p></div></body></html>""",
    f"""<html><body><div class="cookie-notice banner notice"><p>We use cookies to make this site better. By going on you agree to this.</p><button>Accept</button></div>
    <nav class="top-nav"><a href="/">Start</a><a href="/m">Magazine</a></nav>
    <section class="article-body story" data-main="1"><h1>Stone and steel</h1><p class="lead">{_P[2]}</p><figure><img src="a.jpg"><figcaption>The bridge seen from the north bank.</figcaption></figure><p>{_P[3]}</p><pre>span = 120 m</pre>
    <table><tr><th>Part</th><th>Weight</th></tr><tr><td>Deck</td><td>800 t</td></tr></table><ol><li>First the piers are set.</li><li>Then the deck is laid.</li></ol><p>{_P[1]}</p></section>
    <section class="related recommended"><h3>You may also like</h3><ul><li><a href="/r1">Ten great bridges</a></li><li><a href="/r2">Why stone lasts</a></li></ul></section>
    <section class="newsletter signup"><form><p>Get our letter every week, it is free and you can leave at any time.</p><input type="email"><button>Join</button></form></section>
    <footer class="page-footer"><ul><li><a href="/i">Imprint</a></li><li><a href="/p">Privacy</a></li></ul><p>Made in our town since 1990.</p></footer></body></html>""",
    f"""<html><body><table><tr><td class="menu left"><a href="/1">One</a><br><a href="/2">Two</a><br><a href="/3">Three</a></td>
    <td class="content main" data-main="1"><h2>Notes on a bridge</h2><p>{_P[0]}<p>{_P[2]} See <a href="/s">the sketch</a>.<p>{_SHORT}</td>
    <td class="right ads advert sponsor"><div class="ad-box">Cheap flights to the sun. Book now and save.</div></td></tr></table><div class="copyright">Copyright 1999 by the author.</div></body></html>""",
    f"""<html><body><div><div data-main="1"><h1>Plain page</h1><p>{_P[1]}</p><p>{_P[3]}</p><p>{_P[0]}</p></div></div><div><a href="/prev">Previous</a> <a href="/next">Next</a></div></body></html>""",
    f"""<html><body><h1 data-main="1">Bare page</h1><p data-main="1">{_P[0]}</p><p data-main="1">{_P[2]}</p><div data-main="1">{_P[3]}</div><p data-main="1">{_SHORT}</p><div class="alert notification">This page was archived and is no longer kept up to date.</div></body></html>""",
    f"""<html><body><center><a href="/">Index</a></center><h2 data-main="1">Old page</h2><p data-main="1">{_P[1]}<p data-main="1">{_P[3]}<div data-main="1">{_P[0]}</div><div data-main="1">{_P[2]}</div><hr><address>Write to the keeper of this page.</address></body></html>""",
    f"""<html><body><div role="banner"><h1>The Chronicle</h1><p>News for the whole valley, every day of the year.</p></div><div role="navigation"><ul><li><a href="/n1">News</a></li><li><a href="/n2">Views</a></li></ul></div>
    <div role="main" class="page"><div class="text" data-main="1"><h2>Valley gets its bridge</h2><div class="paragraph">{_P[0]}</div><div class="paragraph">{_P[1]}</div><div class="paragraph">{_P[3]}</div></div>
    <div class="author-bio meta"><span class="byline">By A. Writer</span> <span class="date">3 May</span></div></div>
    <div role="complementary" class="popular trending"><p>Trending now: what to do with the old ferry, and who will pay for it?</p></div>
    <div role="search"><form><input><button>Search</button></form></div><div role="contentinfo"><p>Contact us by letter or phone. We answer within a week.</p></div></body></html>""",
    f"""<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>Old ferry</title></head><body><nav><ul><li><a href="/a">Old</a></li><li><a href="/b">ferry,</a></li><li><a href="/c">new.</a></li></ul></nav><!-- ad 1 --><div class="ad">Few words about a thing for sale.</div>
    <article data-main="1"><h1>The old ferry</h1><p><b>{_P[2]}<br><p>{_P[0]}</p><p>{_SHORT}</p><p>Yes.</p></article><footer>&copy; ferry.example &middot; Some words of a footer.</footer></body></html>""",
    f"""<html><body><div class="overlay popup modal"><p>Sign in to read on. It takes a minute only.</p></div><div class="header top"><span>Weekly Review</span></div><ul class="tabs menu"><li>Home</li><li>Books</li><li>Films</li></ul>
    <article class="post" data-main="1"><h1>On bridges</h1><p>{_P[1]}</p><h3>Why now?</h3><p>Because.</p><p>{_P[2]}</p><dl><dt>Span</dt><dd>The length between two piers.</dd></dl><aside data-main="0" class="pullquote related">Read also: <a href="/o">ten old ferries</a></aside><p>{_P[3]}</p></article>
    <section id="disqus_thread" class="responses discussion"><h4>Responses</h4><ul><li><p>Well said. I crossed it last year, and it was worth the wait.</p></li><li><p>My uncle built one of the piers, as he never tires of telling us.</p></li></ul></section>
    <div class="sponsored advertisement"><p>Advertisement: the best boots for a long walk by the river.</p></div><div class="bottom legal"><p>Terms of use apply to all pages of this review.</p></div></body></html>""",
)

#: Pages whose text stands bare in the body, between blocks, in old layouts or in no element.
BARE_PAGES = (
    f"""<html><body data-text="1">{_P[0]} {_P[1]}<br><br>{_P[2]}<br><br>{_P[3]}</body></html>""",
    f"""<html data-text="1">{_P[0]}<br>{_P[2]}</html>""",
    f"""<html data-text="1">{_P[1]} {_P[3]}</html>""",
    f"""<html data-text="1">{_SHORT}</html>""",
    """<html data-text="1">Hello</html>""",
    f"""<div id="root"><div class="bar"><a href="/">Mark</a><a href="/in">Enter</a></div><div class="grid"><div class="west"><a href="/1">One</a><a href="/2">Two</a><a href="/3">Three</a></div><div class="pane" data-main="1"><h1>Divisions only</h1><div class="unit">{_P[0]}</div><div class="unit">{_P[2]}</div><div class="unit">{_SHORT}</div></div></div><div class="base">No part may be used without leave. We keep all rights.</div></div>""",
    f"""<body><div class="x1"><span>Mark</span></div><div class="x2"><div class="x3" data-main="1"><div class="x4">{_P[1]}</div><div class="x5">{_P[3]}</div></div><div class="x6"><a href="/1">One</a> <a href="/2">Two</a></div></div></body>""",
    """<html><body data-text="1">Closed</body></html>""",
    f"""<html><body data-text="1"><font size="3">{_P[1]} {_P[3]}<p data-main="1">{_P[0]}</p>{_P[2]}</font></body></html>""",
    f"""<html><body data-text="1"><h1 data-main="1">Bare text</h1>{_P[2]} {_P[0]}<p data-main="1">{_P[1]}</p>{_P[3]}<div class="footer">All rights reserved.</div></body></html>""",
    f"""<html><body data-text="1"><center><a href="/">Home</a> <a href="/l">Letters</a></center><hr>{_P[3]}<br>{_P[1]}<br>{_P[0]}<hr><a href="/n">Next letter</a></body></html>""",
    f"""<html><body><a href="/a">Home</a> | <a href="/b">News</a> | <a href="/c">Sport</a><h2 data-main="1">Menu in the open</h2><p data-main="1">{_P[0]}</p><p data-main="1">{_P[2]}</p><hr>Copyright 2001</body></html>""",
    f"""<html><body>Town Post<div><a href="/a">One</a> <a href="/b">Two</a></div><div data-main="1"><h1>With a head</h1>{_P[3]}<br><br>{_P[1]}<ul><li>First point</li></ul>{_P[0]}</div>&copy; Town Post <a href="/i">Imprint</a></body></html>""",
    f"""<html><body><div id="page"><div class="menu"><ul><li><a href="/1">Start</a></li></ul></div><div class="text" data-main="1">{_P[2]}<p>{_P[0]}</p>{_P[1]}<div data-main="0" class="ad">Cheap boats.</div>{_P[3]}</div></div></body></html>""",
    f"""<html><body><table><tr><td><a href="/1">One</a><br><a href="/2">Two</a></td><td data-main="1"><h3>In a cell</h3>{_P[1]}<br>{_P[3]}<p>{_SHORT}</p></td></tr></table></body></html>""",
    f"""<html><body><div data-text="1"><h1 data-main="1">Loose</h1>{_P[0]}<p data-main="1">{_P[1]}</p>{_P[2]}<div class="share"><a href="/s">Share</a></div></div><div>Page 1 of 2 <a href="/2">Next</a></div></body></html>""",
)

#: Names that sites give to what stands beside a text, and to the text.
BESIDE_NAMES = (
    "comments", "comment", "replies", "respond", "discussion", "cookie", "consent", "gdpr", "notice", "alert", "banner",
    "promo", "sponsored", "sponsor", "ad", "ads", "advert", "advertisement", "sidebar", "rail", "widget", "related",
    "recommended", "newsletter", "subscribe", "signup", "login", "search", "toolbar", "breadcrumb", "breadcrumbs",
    "pagination", "pager", "tags", "share", "social", "footer", "colophon", "copyright", "header", "masthead", "nav",
    "navbar", "navigation", "menu", "popup", "modal", "form", "contact", "meta", "trending", "popular",
)
MAIN_NAMES = ("content", "article", "post", "entry", "story", "main", "text", "body", "post-content", "article-content")

_LISTS = "<ul><li>{0}</li><li>{1}</li><li>Short point</li></ul>", "<ol><li>Set the piers.</li><li>{0}</li></ol>", "<p>{0}</p><p>{1}</p>"
_BESIDE = (
    "<p>{0}</p>", "<h3>More</h3><ul><li><a href='/1'>Ten ferries</a></li><li><a href='/2'>Old stone</a></li></ul>",
    "<span>A few words only</span>", "<ul><li><p>{1}</p></li><li><p>{0}</p></li></ul>", "<div><p>{1}</p><p>{0}</p></div>",
    "<form><label>Name</label><input><p>{0}</p><button>Send</button></form>",
)
_TAGS = ("div", "section", "aside", "div", "div", "ul")


def named_pages() -> list[str]:
    """Plain pages in which each name is used in turn: two things beside the text, one within it."""
    out = []
    for k in range(0, len(BESIDE_NAMES), 3):
        names = [BESIDE_NAMES[(k + i) % len(BESIDE_NAMES)] for i in range(3)]
        part = [
            f"<{_TAGS[(k + i) % 6]} {('class', 'id')[i % 2]}='{n}'>{_BESIDE[(k + 2 * i) % 6].format(_P[i], _P[i + 1])}</{_TAGS[(k + i) % 6]}>"
            for i, n in enumerate(names)
        ]
        main = MAIN_NAMES[(k // 3) % len(MAIN_NAMES)]
        lists = _LISTS[k % 3].format(_P[(k + 1) % 4], _SHORT)
        tag = ("div", "article", "section")[k // 3 % 3]
        if k // 3 % 4 == 3:  # no element of its own holds the text
            blocks = "".join(f"<{t} data-main='1'>{x}</{t}>" for t, x in (("h1", "Head"), ("p", _P[k % 4]), ("p", _P[(k + 1) % 4]), ("div", _P[(k + 2) % 4]), ("p", _SHORT)))
            out.append(f"<html><body>{part[0]}{blocks}{part[1]}{part[2]}</body></html>")
            continue
        inner = part[2].replace(" ", " data-main='0' ", 1)
        out.append(
            f"<html><body>{part[0]}<div><{tag} class='{main}' data-main='1'><h1>Head</h1><p>{_P[k % 4]}</p>{lists}{inner if k % 2 else ''}"
            f"<p>{_P[(k + 2) % 4]} <a href='/q'>A link</a></p><p>{_SHORT}</p></{tag}></div>{part[1]}{'' if k % 2 else part[2]}</body></html>"
        )
    return out
