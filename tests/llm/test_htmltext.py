import itertools

import numpy as np

from sedimark.llm import htmltext, labelled_pages
from sedimark.llm.dom import blocks

PAGE = """<!DOCTYPE html><html><head><title>No &amp; no</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav><!-- no <p>no</p> --><div class="ad">Buy things now.</div>
<article><h1>A   title&amp;</h1><p><b>Lead &lt;here&gt; it is.<br><p>First  <i>part</i>icle &eacute;t&#233;.</p><p>Second one
goes on.</article><div id="comments"><p>I like this very much.</p></div><footer>&copy; x.example &middot; Words here.</footer></body></html>"""


def test_blocks():
    got = [b.text for b in blocks(PAGE)]
    assert got[:3] == ["One", "Two", "Buy things now."]
    assert got[3:7] == ["A title&", "Lead <here> it is.", "First particle été.", "Second one goes on."]
    assert [b.text for b in blocks("a < b <c")] == ["a < b <c"]
    assert [b.text for b in blocks("<script>never closed <p>x")] == []


def test_self_closed_svg_and_noscript(spark):
    page = PAGE.replace("<p>First", '<p><svg class="icon"/>First').replace("<p>Second", "<noscript><p>Without scripts.</p></noscript><p>Second")
    assert [b.text for b in blocks(page)][5:8] == ["First particle été.", "Without scripts.", "Second one goes on."]
    assert [b.text for b in blocks("<p>a<svg/>b<svg><text>no</text></svg>c<svg width=1>d<p>e")] == ["abcd", "e"]
    kept = blocks("<p>a<noscript>b</noscript>c</p>")
    assert [b.text for b in kept] == ["a", "b", "c"] and "in=p" in kept[2].path
    got = htmltext.extract(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")).first().text
    assert "First particle été." in got and "Second one goes on." in got


def test_held_out_pages():
    field = htmltext.trained()
    right = whole = same = 0
    pages = labelled_pages.pages(150, seed=99)
    for page in pages:
        found, labels = htmltext.labelled(page)
        got = field.viterbi(field.scores(htmltext.block_features(found)).tolist())
        right += sum(np.array(got) == labels)
        whole += len(labels)
        same += list(labels) == got
    assert right / whole > 0.99 and same / len(pages) > 0.93


def test_viterbi_and_marginals_against_all_paths():
    pick = np.random.default_rng(1)
    field = htmltext.Field({})
    for n in (1, 2, 6):
        field.step, field.begin, score = pick.normal(size=(2, 2)), pick.normal(size=2), pick.normal(size=n)
        value = {y: field.begin[y[0]] + sum(s for s, k in zip(score, y) if k) + sum(field.step[a, b] for a, b in zip(y, y[1:])) for y in itertools.product((0, 1), repeat=n)}
        assert tuple(field.viterbi(score.tolist())) == max(value, key=value.get)
        p, pairs = field.expected(score)
        z = sum(np.exp(v) for v in value.values())
        assert np.allclose(p, [sum(np.exp(v) for y, v in value.items() if y[t]) / z for t in range(n)])
        assert np.isclose(pairs.sum(), n - 1)


def test_extract(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (None, "v", "", "x"), (3, "w", "<article><p>" + "word " * 30000 + "</p></article>", "x")]
    got = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    want = "A title& Lead <here> it is. First particle été. Second one goes on."
    assert sorted((r.page_id or 0, r.text[:70], r.n_chars) for r in got) == [(0, "", 0), (1, want, len(want)), (1, want, len(want)), (2, "", 0), (3, ("word " * 14), 149999)]
    assert htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string").limit(0)).count() == 0


def test_readers_comments_under_many_names():
    field, kept, pages = htmltext.trained(), 0, []
    for start, end in (("<article>", "</article>"), ('<div class="content">', "</div>"), ("<main>", "</main>")):
        for name in ("replies", "reactions", "discuss", "thread", "comments", "feedback", "responses"):
            for one in ('<div class="reply"><p>Great post, thank you very much.</p></div>', "<p>Great post! I like it.</p>", "<li>Great post.</li>", '<article class="comment"><p>Great post, I would say.</p></article>'):
                pages.append(f'<html><body><nav><a href="/">Home</a> <a href="/n">News</a></nav>{start}<h1>A title here</h1><p>Some text of the page stands here.</p><p>More of it follows now, and ends.</p>{end}<div class="{name}">{one}{one}</div><footer>&copy; x.example</footer></body></html>')
    for page in pages:
        got = htmltext.main_text(page, field)
        assert got.startswith("A title here Some text of the page stands here. More of it follows now, and ends.")
        kept += "Great post" in got
    assert kept <= 0.02 * len(pages), kept


def test_extraction_on_labelled_pages_equals_the_labels():
    """Whole results against the labels that pages were made with."""
    field, same = htmltext.trained(), 0
    pages = labelled_pages.pages(120, seed=123)
    for page in pages:
        found, labels = htmltext.labelled(page)
        same += htmltext.main_text("".join(x for x, _ in page), field) == " ".join(b.text for b, y in zip(found, labels) if y)
    assert same >= 0.93 * len(pages), same
