import numpy as np
import pytest

from temblor.llm import htmlcrf
from temblor.llm.htmlblocks import leaf_blocks


def test_blocks_follow_the_page():
    page = (
        "<html><head><title>no</title></head><body>a <b>b</b>\n c<br>d<p>one &amp; two&nbsp;three<p>x<div>y</div>"
        "<!-- <p>no</p> --><script>if (a < b) '</p>'</script><ul><li>i<li>j</ul><a href='a>b'>link</a> 1 < 2 &lt;p&gt;"
        "<style>p{}</style><textarea>no</textarea></body>"
    )
    texts = [b.text for b in leaf_blocks(page)]
    assert texts == ["a b c d", "one & two three", "x", "y", "i", "j", "link 1 < 2 <p>"]
    for empty in (None, "", "   ", "<p></p>", "<", "<p", "<!--", "<script>", "</p>"):
        assert [b.text for b in leaf_blocks(empty)] in ([], ["<"], ["<p"])


def test_depth_and_length_are_cheap():
    assert leaf_blocks("<div>" * 50_000 + "x" + "</div>" * 50_000)[0].text == "x"
    assert len(leaf_blocks("<p>word" * 50_000)) == 50_000
    leaf_blocks("<a b='" * 20_000)
    leaf_blocks("<" * 50_000)


def test_viterbi_equals_all_labelings():
    model = htmlcrf.trained(60)
    for seed in range(30):
        blocks = leaf_blocks(htmlcrf.labelled_page(10_000 + seed)[0])[:9]
        own = model.scores(blocks)
        best = max(
            (sum(own[t, y[t]] for t in range(len(y))) + sum(model.step[y[t], y[t + 1]] for t in range(len(y) - 1)), y)
            for y in ([n >> t & 1 for t in range(len(blocks))] for n in range(2 ** len(blocks)))
        )
        assert model.decode(blocks).tolist() == best[1]


def test_held_out_pages():
    model, right, total = htmlcrf.trained(), 0, 0
    for seed in range(5_000_000, 5_000_300):
        page, labels = htmlcrf.labelled_page(seed)
        blocks = leaf_blocks(page)
        assert len(blocks) == len(labels)
        right += int((model.decode(blocks) == np.array(labels)).sum())
        total += len(labels)
    assert right / total > 0.99


@pytest.fixture
def pages(spark):
    article = "<nav><a href=/>Home</a></nav><article><h1>Title</h1><p>First of the long paragraphs, it says so.</p><p>Second &eacute; one.</p></article><footer>&copy; us</footer>"
    rows = [(1, "u", article, "t", 1), (1, "u", article, "t", 1), (2, None, None, None, None), (None, "u", "", "t", 1), (3, "u", "<p>" + "long text here. " * 50_000, "t", 1)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")


def test_hard_rows(pages):
    out = sorted(map(tuple, htmlcrf.extract(pages).collect()), key=str)
    text = "Title\nFirst of the long paragraphs, it says so.\nSecond é one."
    assert out[:2] == [(1, "u", text, len(text))] * 2
    assert (2, None, "", 0) in out and (None, "u", "", 0) in out
    assert len(out) == 5 and htmlcrf.extract(pages.limit(0)).count() == 0
