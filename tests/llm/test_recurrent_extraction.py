import html
import re

import numpy as np
import pytest

from learnsilver.llm import recurrent_extraction as rec
from learnsilver.llm.queries import op6_recurrent_extraction
from learnsilver.llm.shared import read

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def network(spark):
    return rec.fit_on(read(spark, FOLDER, "pages"))


def article_of(page):
    """The article of the test pages, by their one template."""
    inside = page.split("<article>", 1)[1].split("</article>", 1)[0]
    pieces = (html.unescape(re.sub("<[^>]*>", "", p)) for p in re.split(r"</?(?:p|h\d)>", inside))
    return "\n".join(text for text in (" ".join(p.split()) for p in pieces) if text)


def main_text(network, page):
    some = rec.blocks(page)
    marks = rec.probabilities(network, [rec.numbers(some)])[0]
    return "\n".join(block.text for block, p in zip(some, marks) if p >= 0.5)


def test_blocks_of_broken_markup():
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p><b>';</script></head>"
        "<body><!-- <p>no</p> --><div class='a b'>One &amp;  two<br>three <b>x<i>y</b> z<p>first<p>second"
        "<ul><li>a<li><a href='q>r'>bcd</a></ul><table><tr><td>c1<td>c2</table>a &lt; b 3<4 <![CDATA[no]]>"
    )
    found = rec.blocks(page)
    assert [b.text for b in found] == [
        "One & two three xy z", "first", "second", "a", "bcd", "c1", "c2", "a < b 3<4",
    ]
    assert found[0].path == ("<html", "<body", "<div", "a", "b")
    assert found[4].path[-2:] == ("<ul", "<li") and found[4].linked == 3
    assert rec.blocks("") == [] and rec.blocks("<p> \n </p>") == []
    assert [b.text for b in rec.blocks("plain words")] == ["plain words"]


@pytest.mark.parametrize("inside", [
    "<svg class='i'/>", "<svg-icon name=x></svg-icon>", "<video-player src=y></video-player>", "<SELECT-box>\n</SELECT-box>",
    "<object data=z />", "<iframe src='/a'/>", "<video src=a>", "<svg><svg/><title>no</title><g>no</g></svg>",
    "<svg><svg>no</svg>no</svg>", "<select><option>no<option>no</select>", "<video>no</VIDEO >", "</svg>", "<script-x></script-x>",
    "<noscript><script>'</noscript>'</script>no</noscript>", "<title-bar/>", "<canvas><!-- </canvas> -->no</canvas>",
])
def test_hidden_elements_end_where_they_do(inside):
    rest = "<p>third</p><svg>no</svg><video>no</video><object>no</object><iframe>no</iframe><p>fourth</p>"
    found = rec.blocks(f"<article><p>first</p>{inside}<p>second {inside}words</p>{rest}</article>")
    assert " ".join(b.text for b in found) == "first second words third fourth"


def test_formulas_are_text():
    page = (
        "<p>So <math display='inline'><semantics><mrow><mi>a</mi><mo>=</mo><mfrac><mn>1</mn><mi>b</mi></mfrac></mrow>"
        "<annotation encoding='TeX'>a=\\frac1b</annotation></semantics></math> holds.</p>"
    )
    assert [b.text for b in rec.blocks(page)] == ["So a=1b holds."]


def test_many_hidden_elements_take_no_more_than_a_look_each():
    for page in ("<svg>" * 50_000, "<svg>" * 50_000 + "</svg>" * 50_000, "<video/>" * 50_000, "<svg-x>" * 3_000):
        assert rec.blocks(page + "<p>end</p>")[-1].text == "end"


def test_deep_long_and_hostile_pages_are_read():
    assert len(rec.blocks("<div>" * 3_000 + "x" + "</div>" * 3_000)) == 1
    assert len(rec.blocks("<p>word " * 20_000)) == 20_000
    for page in ("<a href=\"" * 3_000, "<" * 100_000, "<!--" * 50_000, "<script>" * 20_000, "</p>" * 50_000):
        rec.blocks(page)


def test_gradients_against_differences(spark):
    pages = [rec.labelled(rec.blocks(r.html)) for r in read(spark, FOLDER, "pages").limit(3).collect()]
    pages = [some for some in pages if some]
    read_pages = [rec.numbers(some) for some in pages]
    labels = [np.array([b.main for b in some], dtype=float) for some in pages]
    weights = rec._start()

    def loss():
        total = n = 0
        for p, own in zip(rec.probabilities(weights, read_pages), labels):
            total -= (own * np.log(p) + (1 - own) * np.log(1 - p)).sum()
            n += len(own)
        return total / n

    for name, slope in rec._gradients(weights, read_pages, labels).items():
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        middle = weights[name][at]
        weights[name][at] = middle + 1e-5
        above = loss()
        weights[name][at] = middle - 1e-5
        below = loss()
        weights[name][at] = middle
        assert (above - below) / 2e-5 == pytest.approx(slope[at], rel=1e-3)


def test_pages_side_by_side_are_read_as_alone(network):
    pages = [rec.numbers(rec.blocks(p)) for p in ("<p>a", "<div><p>b c<p>d</div>e", "<ul>" + "<li>x" * 30)]
    together = rec.probabilities(network, pages)
    for page, own in zip(pages, together):
        assert rec.probabilities(network, [page])[0] == pytest.approx(own)


def test_articles_of_the_whole_table(spark):
    pages = {r.page_id: r for r in read(spark, FOLDER, "pages").collect()}
    found = op6_recurrent_extraction(spark, FOLDER).collect()
    assert len(found) == len(pages)
    right = 0
    for row in found:
        assert row.url == pages[row.page_id].url and row.n_chars == len(row.text)
        right += row.text == article_of(pages[row.page_id].html)
    assert right >= 0.99 * len(pages)


def test_other_templates(network):
    story = [f"<p>Sentence number {k} of the story, with some more words in it, is here.</p>" for k in range(8)]
    body = "".join(story)
    wanted = "\n".join(re.sub("<[^>]*>", "", p) for p in story)
    before = "<html><body><header><p>Site name</p></header><nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav>"
    for page in (
        f"{before}<main>{body}</main><aside><p>Most read this week</p></aside><footer><p>Imprint</p></footer>",
        f"{before}<article>{body}</article><section class='comments'><p>I do not agree.</p><p>Me too!</p></section>",
        f"{before}<div class='cookie notice'><p>We use cookies.</p></div><article>{body}</article><form><label>Mail</label></form>",
        f"{before}<article>{body}</article><div class='sidebar'><p>Weather today</p></div>",
    ):
        assert main_text(network, page) == wanted


def test_held_out_variations(spark, network):
    rows = read(spark, FOLDER, "pages").orderBy("page_id").limit(80).collect()
    pages = rec.varied([some for some in (rec.labelled(rec.blocks(r.html)) for r in rows) if some], 99)
    right = [
        ((p >= 0.5) == (np.array([b.main for b in some]) == 1)).mean()
        for some, p in zip(pages, rec.probabilities(network, [rec.numbers(some) for some in pages]))
    ]
    assert np.mean(right) > 0.98


def test_nulls_repeated_rows_and_clashing_columns(spark, network):
    page = "<body><nav><a>Menu</a></nav><article><p>Some text.<p>More &eacute; text.</article>"
    schema = "page_id long, url string, html string, text int, n_chars string, id long"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (None, "v", ""), (3, "w", " \n")]
    frame = spark.createDataFrame([(*row, 1, "x", 2) for row in rows], schema)
    found = sorted(map(tuple, rec.extract(frame, network).collect()), key=str)
    text = "Some text.\nMore é text."
    assert found == sorted(
        [(1, "u", text, len(text))] * 2 + [(2, None, "", 0), (None, "v", "", 0), (3, "w", "", 0)], key=str
    )
    empty = frame.limit(0)
    assert rec.extract(empty, rec.fit_on(empty)).count() == 0


STORY = [f"Sentence number {k} of the story, with some more words in it, is here." for k in range(8)]
POINTS = [f"Point {k} of the list says something short." for k in range(5)]
CELLS = ["Year", "Share", *(cell for k in range(4) for cell in (str(2000 + k), f"{k} per cent"))]
COMMENTS = "<p>I do not agree with this at all.</p><p>Me too! Thanks for writing.</p><p>Great read.</p>"


def paragraphs(texts, tag="p"):
    return "".join(f"<{tag}>{text}</{tag}>" for text in texts)


@pytest.mark.parametrize("inside, wanted", [
    (f"<article><h2>Title of it</h2>{paragraphs(STORY)}<ul>{paragraphs(POINTS, 'li')}</ul>{paragraphs(STORY)}</article>",
     ["Title of it", *STORY, *POINTS, *STORY]),
    (f"<article>{paragraphs(STORY)}<table><tr>{paragraphs(CELLS[:2], 'th')}</tr><tr>"
     + "</tr><tr>".join(paragraphs(CELLS[k : k + 2], "td") for k in range(2, 10, 2))
     + f"</tr></table>{paragraphs(STORY)}</article>", [*STORY, *CELLS, *STORY]),
    (f"<article><header><h1>The title of the story</h1></header>{paragraphs(STORY)}</article>",
     ["The title of the story", *STORY]),
    (f"<div id='page'><h1>The title</h1>{paragraphs(STORY)}</div><div id='comments'>{COMMENTS}</div>", ["The title", *STORY]),
    (f"<table><tr><td><h1>The title</h1>{paragraphs(STORY)}</td></tr></table>", ["The title", *STORY]),
    (f"<article>{paragraphs(STORY)}</article><div id='respond'>{COMMENTS}</div>", STORY),
    ("<div class='gdpr-overlay'><p>We and our partners use cookies to improve your visit.</p><button>Accept</button></div>"
     f"<article>{paragraphs(STORY)}</article>", STORY),
])
def test_articles_of_other_shapes(network, inside, wanted):
    page = (
        "<html><body><header><p>Site name</p></header><nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav>"
        f"{inside}<footer><p>Imprint</p></footer></body></html>"
    )
    assert main_text(network, page) == "\n".join(wanted)
