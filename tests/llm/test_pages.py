"""Main text of web pages: the block reader, the field against enumeration, and held-out layouts."""

import itertools
import time

import numpy as np
import pytest

from cohortspan.llm import html_crf as crf
from cohortspan.llm.html_blocks import blocks

PROSE = [
    "The committee met on Tuesday and agreed, after a long debate, to open the bridge in spring.",
    "Nobody had expected the river to rise so quickly; by noon the lower road was under water.",
    "Die Stadt hat im letzten Jahr mehr Bäume gepflanzt als in den zehn Jahren davor.",
    "Les habitants du quartier ont demandé une réunion, mais la mairie n'a pas encore répondu.",
    "Los vecinos celebraron la noticia con música, comida y una larga noche de baile.",
    "A second survey, carried out in May, confirmed what the first one had suggested already.",
    "She wrote three letters, none of which was ever answered, and then she left the country.",
    "It is cheaper to repair the old machines than to buy new ones, the report says.",
]
SHORT = ["Bridge opens in spring", "River rises", "Bäume für alle", "Une réunion", "Noche de baile", "Second survey", "Three letters", "Old machines"]


@pytest.fixture(scope="module")
def sources():
    return [f"<html><body><nav><a href=/>{SHORT[i % 8]}</a></nav><article><h1>{SHORT[(i + 1) % 8]}</h1>" + "".join(f"<p>{PROSE[(i + j) % 8]}" for j in range(1 + i % 6)) + f"</article><footer>&copy; {SHORT[(i + 2) % 8]}</footer>" for i in range(40)]


@pytest.fixture(scope="module")
def field(sources):
    return crf.train(crf.labelled(sources, 800))


def texts(html):
    return [b.text for b in blocks(html)]


def test_reader():
    assert texts("<p>a &amp; b&nbsp; c<p>d<br>e <b>f</b>g<div>h</div>i") == ["a & b c", "d e fg", "h", "i"]
    assert texts("<style>p{}</style><script>var t='</p>';</script><!-- x --><p>y<!-- <p>no</p> --></p>") == ["y"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><dl><dt>e<dd>f<dt>g</dl>") == list("abcdefg")
    assert texts("<table><tr><td>a<td>b<tr><th>c</table>") == ["a", "b", "c"]
    assert texts("<select><option>x</select><noscript><p>n</p></noscript><svg><text>t</text></svg>k") == ["k"]
    assert texts("1 < 2 <p title='a>b'>c</p><p>cut <a hre") == ["1 < 2", "c", "cut"]
    assert texts('<p title="never ends>one</p><p>two</p>') == ["one", "two"]
    assert texts("<script>never ends <p>a</p>") == [] and texts("") == [] and texts("plain") == ["plain"]
    assert texts("</div></p><p>a</b></section>b&#x41;&#66;&unknown;") == ["a", "bAB&unknown;"]
    assert [b.linked for b in blocks("<li><a href=x>abcd</a><li>ab<a>cd</a>")] == [4, 2]
    assert texts("<TITLE>t</TITLE><P>A</P><!doctype html><?xml?>") == ["A"]
    (block,) = blocks('<body class="comments"><div class="postBody"><article><p>x')
    assert block.above & 1 and block.nearest >> crf.GROUPS.index("content") & 1 and not block.nearest >> crf.GROUPS.index("comment") & 1


def test_reader_takes_time_in_proportion():
    for html in ("<div>" * 100_000 + "x", "<a " * 100_000, '<p a="' * 100_000, "<p>x" * 100_000, "<" * 200_000, "<script>" * 50_000, "<!--" * 50_000, "</p>" * 100_000, "<li>" * 100_000, "&am" * 100_000, 'x="<a y="<b' * 50_000 + ">"):
        start = time.time()
        found = blocks(html)
        crf.features(found)
        assert time.time() - start < 20, html[:20]


def test_viterbi_and_gradient_by_enumeration():
    rng = np.random.default_rng(0)
    n, dims = 5, len(crf.NAMES)
    x, y = rng.normal(size=(2, n, dims)), rng.integers(0, 2, (2, n))
    mask = np.array([[True] * n, [True] * 3 + [False] * 2])
    joint = rng.integers(0, 2, (2, n - 1))
    field = crf.Field(rng.normal(size=(dims, 2)) * 0.3, rng.normal(size=(2, 2, 2)))

    def total(field, i, labels):
        return sum(x[i, t] @ field.own[:, k] for t, k in enumerate(labels)) + sum(field.pair[joint[i, t], a, b] for t, (a, b) in enumerate(itertools.pairwise(labels)))

    def likelihood(field):
        out = 0.0
        for i, length in enumerate((n, 3)):
            every = [total(field, i, z) for z in itertools.product((0, 1), repeat=length)]
            out += total(field, i, y[i, :length]) - np.logaddexp.reduce(every)
        return out

    value, d_own, d_pair = crf.gradient(field, x, joint, y, mask)
    assert np.isclose(value, likelihood(field))
    for weights, grad in ((field.own, d_own), (field.pair, d_pair)):
        for at in [tuple(rng.integers(0, k) for k in weights.shape) for _ in range(12)]:
            old = weights[at]
            weights[at] = old + 1e-5
            up = likelihood(field)
            weights[at] = old - 1e-5
            down = likelihood(field)
            weights[at] = old
            assert np.isclose(grad[at], (up - down) / 2e-5, atol=1e-4)
    best = max(itertools.product((0, 1), repeat=n), key=lambda z: total(field, 0, z))
    assert tuple(crf.viterbi(x[0] @ field.own, field.pair[joint[0]])) == best


def test_labels_of_layouts_match_their_blocks(sources):
    made = crf.compose([blocks(h) for h in sources], 300)
    assert all(len(blocks(h)) == len(y) for h, y in made)
    assert 0.2 < np.concatenate([y for _, y in made]).mean() < 0.8


def test_held_out_layouts(field, sources):
    other = [f"<article><p>{a} {b}</p><p>{c}</p></article>" for a, b, c in itertools.permutations(PROSE[:5], 3)]
    hit = wrong = missed = 0
    for html, y in crf.compose([blocks(h) for h in sources + other], 300, seed=77):
        page = blocks(html)
        z, size = field.label(page), np.array([len(b.text) for b in page])
        hit, wrong, missed = hit + size[(z == 1) & (y == 1)].sum(), wrong + size[(z == 1) & (y == 0)].sum(), missed + size[(z == 0) & (y == 1)].sum()
    assert hit / (hit + wrong) > 0.97 and hit / (hit + missed) > 0.97


PARTS = {
    "nav": '<nav class="main"><ul><li><a href="/">Home</a></li><li><a href="/a">About</a></li><li><a href="/n">News</a></li></ul></nav>',
    "notice": f'<div class="cookie-banner"><p>We use cookies. {PROSE[5]}</p></div>',
    "aside": f'<aside><h3>Related</h3><p>{PROSE[6]}</p><ul><li><a href="/x">{SHORT[1]}</a></li></ul></aside>',
    "comments": f'<section id="comments"><h2>2 comments</h2><div class="comment"><p>Anna</p><p>{PROSE[4]}</p></div><div class="comment"><p>Ben</p><p>{PROSE[0]}</p></div></section>',
    "footer": "<footer><p>&copy; 2024 The Paper. All rights reserved.</p></footer>",
    "form": '<form class="newsletter"><p>Subscribe to our newsletter</p><input name="m"><button>Go</button></form>',
}


@pytest.mark.parametrize("around", ["<article>{}</article>", '<main><div class="entry-content">{}</div></main>', '<div id="content"><div class="post">{}</div></div>'])
def test_pages_by_hand(field, around):
    body = f"<h1>{SHORT[0]}</h1><p>{PROSE[0]}</p><p>{PROSE[1]} <a href='/s'>See</a> more, he said.</p><ul><li>{PROSE[7]}</li><li>{PROSE[3]}</li></ul><p>{PROSE[2]}</p>"
    wanted = "\n".join([SHORT[0], PROSE[0], f"{PROSE[1]} See more, he said.", PROSE[7], PROSE[3], PROSE[2]])
    html = f"<!doctype html><html><head><title>t</title></head><body>{PARTS['nav']}{PARTS['notice']}{around.format(body)}{PARTS['aside']}{PARTS['comments']}{PARTS['form']}{PARTS['footer']}</body></html>"
    assert crf.main_text(html, field) == wanted


def test_extract(spark, sources):
    rows = [(i, f"u{i}", h, "x") for i, h in enumerate(sources)] + [(None, None, None, None), (90, "u", "", "x"), (91, "u", "<p>", "x"), (0, "u0", sources[0], "x"), (92, "long", "<article>" + f"<p>{PROSE[0]}</p>" * 3000 + "</article>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    field = crf.learn(pages, max_pages=30, layouts=400)
    found = crf.extract(pages, field, ["page_id", "url"]).collect()
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    assert [r.text for r in found if r.page_id in (None, 90, 91)] == ["", "", ""]
    by_id = {r.page_id: r.text for r in found}
    assert by_id[92] == "\n".join([PROSE[0]] * 3000)
    right = sum(by_id[i] == "\n".join([SHORT[(i + 1) % 8]] + [PROSE[(i + j) % 8] for j in range(1 + i % 6)]) for i in range(40))
    assert right >= 39
    again = {r.page_id: r.text for r in crf.extract(pages.repartition(3), crf.learn(pages.repartition(3), max_pages=30, layouts=400), ["page_id"]).collect()}
    assert again == by_id  # the order of rows and partitions changes nothing


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, html string")
    assert crf.extract(empty, crf.learn(empty, layouts=20), ["page_id"]).collect() == []
