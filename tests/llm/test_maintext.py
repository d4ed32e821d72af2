import itertools
import random

import numpy as np
from riverbed.llm import maintext
from tests.llm.fixtures import prose

P = [" ".join(prose(i, 60).split()) for i in range(8)]

FULL = f"""<!doctype html><html><head><title>Title &amp; more</title><style>p {{ margin: 0 }}</style><script>if (a < b) document.write("<p>no</p>");</script></head>
<body class="home"><header><a href="/">Site</a><form action="/find"><input name="q"><button>Go</button></form></header>
<nav><ul><li><a href="/a">Alpha</a><li><a href="/b">Beta</a></ul></nav>
<div id="cookie-notice"><p>We use cookies on this site. By staying here you agree to all of them, every one.</p></div>
<main><article class="post"><h1>The &quot;main&quot;   head&nbsp;line</h1>
<p>{P[0]}<p>{P[1]} caf&eacute; &#8364;5 &lt;b&gt;<br>next</p>
<div class="ad"><p>Buy this now. It is the best thing that you can buy, and it is cheap. Buy two of them today.</p></div>
<blockquote>{P[2]}</blockquote><!-- a comment <p>no</p> --><figure><img src="x"><figcaption>A caption of a picture in the text.</figcaption></figure>
<ul><li>first point of the list<li>second point of the list</ul><table><tr><td>cell one<td>cell two</table>
<aside class="related"><a href="/c">Read this as well</a></aside><p>{P[3]}</p></article>
<section id="comments"><h2>Comments</h2><article class="comment"><p>{P[4]}</p></article></section></main>
<div class="sidebar widget"><p>{P[5]}</p></div><footer><p>&copy; 2024 Site. All rights reserved, and so on.</p></footer>
<div style="display: none"><p>{P[6]}</p></div><noscript><p>{P[7]}</p></noscript></body></html>"""


def text(page, w=maintext.DEFAULT):
    return maintext.extract(page, w)[0]


def test_article_without_furniture():
    want = ['The "main" head line', P[0], f"{P[1]} café €5 <b> next", P[2], "A caption of a picture in the text.", "first point of the list",
            "second point of the list", "cell one", "cell two", P[3]]
    assert text(FULL).split("\n\n") == want


def test_shape_decides_where_nothing_is_marked():
    links = "".join(f'<div><a href="/{i}">Topic {i}</a></div>' for i in range(8))
    page = f"<body><div>{links}</div><div><div>{P[0]}</div><div>{P[1]}</div><div>Short but inside.</div><div>{P[2]}</div></div><div>© 2023 Example</div></body>"
    assert text(page).split("\n\n") == [P[0], P[1], "Short but inside.", P[2]]


def test_broken_pages():
    assert text(None) == text("") == text("   ") == text("<html><body></body></html>") == ""
    assert text(f"<article><p>{P[0]}") == P[0]
    assert text(f"<article><p>{P[0]}</p><p title='>' class=x>{P[1]}<") == f"{P[0]}\n\n{P[1]}<"
    assert text(f"<article><p>{P[0]}</div></b></p><p>{P[1]}</p><a href=\"unclosed>") == f"{P[0]}\n\n{P[1]}"
    assert text(f"<article><p>{P[0]}</p><!-- never closed <p>{P[1]}</p>") == P[0]
    assert text(f"<article><p>{P[0]}</p><script>var x = '<p>{P[1]}</p>'") == P[0]
    assert text(f"<article><p>a<b>b</b>c &amp;amp; {P[0]}</p></article>") == f"abc &amp; {P[0]}"
    assert text(P[0]) == P[0]
    assert text(f"<article><p>3 < 4 and 5 > 2. {P[0]}</p></article>") == f"3 < 4 and 5 > 2. {P[0]}"


def test_long_pages_stay_linear():
    import time
    page = "<article>" + f"<p>{P[0]}</p>" * 3000 + "</article>" + "<nav>" + "<a href=x>y</a><br>" * 5000 + "</nav>" + "<" * 20000 + '<a "' * 3000
    began = time.process_time()
    assert text(page).count("\n\n") >= 2999
    assert time.process_time() - began < 60


def test_names_on_wrappers_and_names_that_only_sound_like_furniture():
    body = f"<h1>Title</h1><p>{P[0]}</p><p class='lead share-price'>{P[1]}</p><p>{P[2]}</p>"
    want = ["Title", P[0], P[1], P[2]]
    for page in (f'<body class="single-post has-sidebar">{body}</body>', f'<body class="single-post has-sidebar"><main><article>{body}</article></main></body>',
                 f'<div id=page class="site header-fixed"><article>{body}</article></div>', f'<article class="post-social">{body}</article>',
                 f'<form action="/x"><div class="header"><main>{body}</main></div></form>', f'<div class="widget"><article>{body}</article></div>',
                 f'<body class="sidebar"><div>{body}</div></body>'):
        assert text(page).split("\n\n") == want, page
    for name in ("sidebar", "site-footer", "cookie-notice", "commentList", "page-header ad"):
        assert text(f'<article>{body}</article><div class="{name}"><p>{P[3]}</p></div>').split("\n\n") == want, name
    long_talk = "".join(f"<article><p>{P[i % 8]} {i}</p></article>" for i in range(40))
    assert text(f'<main><article>{body}</article></main><section id="comments">{long_talk}</section>').split("\n\n") == want


def test_hidden_inline_text_and_long_attributes():
    assert text(f"<article><p>{P[0]} <span hidden>not shown</span>end</p></article>") == f"{P[0]} end"
    assert text(f"<article><p>{P[0]}</p><p style='display:none'>{P[1]}</p></article>") == P[0]
    for n in (8_000, 8_192, 8_193, 100_000):
        assert text(f'<article><p data-x="{"<b>" * (n // 3)}" title=\'a>b\'>{P[0]}</p></article>') == P[0]
    assert text(f"<article><p>{P[0]} <math><mi>x</mi><mo>=</mo><mn>1</mn></math>.</p><xmp>a <b> &amp; c</xmp></article>") == f"{P[0]} x=1.\n\na <b> &amp; c"


def test_deep_nesting_stays_linear():
    import time
    for tag in ("div", "span", "ul><li", "b"):
        page = f"<article><p>{P[0]}</p></article>" + f"<{tag}>x" * 100_000 + "</i></p>" * 50_000
        began = time.process_time()
        assert text(page).startswith(P[0])
        assert time.process_time() - began < 60, tag


def test_minimum_cut_equals_enumeration():
    r = random.Random(6)
    for _ in range(150):
        n = r.randrange(1, 9)
        score = np.array([r.uniform(-3, 3) for _ in range(n)])
        edges = [(i, j, r.uniform(0.1, 3)) for i in range(n) for j in range(i + 1, n) if r.random() < 0.45]

        def cost(label, score=score, edges=edges):
            return sum(max(0.0, s) if not x else max(0.0, -s) for x, s in zip(label, score)) + sum(c for i, j, c in edges if label[i] != label[j])

        best = min(cost(label) for label in itertools.product((0, 1), repeat=n))
        assert abs(cost(maintext.minimum_cut(score, edges).astype(int).tolist()) - best) < 1e-6


def test_cut_prefers_agreement_with_neighbours():
    """A block that the classifier takes for boilerplate, narrowly, between two that it takes for content."""
    assert maintext.minimum_cut(np.array([3.0, -0.5, 3.0]), [(0, 1, 1.0), (1, 2, 1.0)]).all()
    assert maintext.minimum_cut(np.array([3.0, -2.5, 3.0]), [(0, 1, 1.0), (1, 2, 1.0)]).tolist() == [True, False, True]


def test_whole_table(spark):
    pages = [(i, f"u{i}", FULL) for i in range(30)] + [(100, None, None), (None, "u", ""), (5, "u5", FULL), (101, "x", f"<p>{P[0]}</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'clash' AS text", "1 AS n_blocks", "'x' AS x")
    got = maintext.main_text(df).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.n_chars == len(r.text)
        if r.page_id is not None and r.page_id < 100:
            assert r.text == text(FULL)
    assert {r.text for r in got if r.page_id in (100, None)} == {""}
    assert maintext.main_text(df.limit(0)).count() == 0


def test_model_is_fitted_on_marked_blocks():
    x = np.vstack([maintext.shape(maintext.blocks(FULL))] * 5)
    y = np.array([0.0 if b.kind or b.named else 1.0 for b in maintext.blocks(FULL)] * 5)
    w = maintext.fit(x, y)
    assert ((x @ w > 0) == (y == 1)).mean() >= ((x @ maintext.DEFAULT > 0) == (y == 1)).mean()
    assert (maintext.fit(x, np.ones(len(x))) == maintext.DEFAULT).all()
