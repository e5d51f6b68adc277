"""Main text against the supplied template's article, other templates with known text, and broken markup."""

import html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from scorelab.llm.extraction import extract, main_text, path_ratios


def article_of(page):
    """The supplied template's article: its tags off, blocks apart, references decoded."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: " " if re.match(r"</?(p|h1|br)", m[0]) else "", inner)).split())


def test_supplied_pages(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    made = {r.page_id: r for r in extract(pages).collect()}
    rows = pages.collect()
    assert len(made) == len(rows)
    for r in rows:
        assert tuple(made[r.page_id]) == (r.page_id, r.url, article_of(r.html), len(article_of(r.html)))


WORDS = "the of river stone walks under light many years ago people found small houses near old bridges".split()


def prose(draw, sentences):
    return " ".join(" ".join(draw.choices(WORDS, k=draw.randint(4, 18))).capitalize() + "." for _ in range(sentences))


OPENERS = ["<article>{}</article>", "<main>{}</main>", '<div class="post-content">{}</div>', '<div itemprop="articleBody">{}</div>',
           '<main><article class="post">{}</article></main>', '<div id="wrap" class="with-sidebar"><article>{}</article></div>', "<div class=x7>{}</div>"]


@pytest.mark.parametrize("opener", OPENERS)
def test_templates(opener):
    draw = random.Random(opener)
    for _ in range(30):
        title, parts = prose(draw, 1), [prose(draw, draw.randint(1, 6)) for _ in range(draw.randint(2, 6))]
        body = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in parts)
        comment = "".join(f'<div class="comment"><p>{prose(draw, 4)}</p></div>' for _ in range(3))
        page = f"""<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body class="has-sidebar no-header">
<header><a href="/">Home of the <b>site</b></a><p>{prose(draw, 1)}</p></header><nav><ul>{"".join(f"<li><a href=x>{w}</a>" for w in WORDS)}</ul></nav>
<div class="cookie-notice">{prose(draw, 2)}</div><div id="ad-top">{prose(draw, 2)}</div>
{opener.format(body)}
<aside><h2>More</h2><p>{prose(draw, 3)}</p></aside><section id="comments"><h3>Comments</h3>{comment}</section>
<form action="/s"><label>Search these many pages.</label><input name=q><button>Go</button></form>
<div hidden>{prose(draw, 3)}</div><script>var a = "<p>{prose(draw, 3)}</p>";</script><footer>&copy; {prose(draw, 1)}</footer></body></html>"""
        assert main_text(page) == " ".join([title, *parts])


def test_blocks_and_references():
    assert main_text("<article><p>a<b>b</b>c  d\n e&nbsp;f<br>g<p>x &lt;y&gt; &amp;amp; &#233;<ul><li>one<li>two</ul><table><tr><td>1<td>2</table></article>") == "abc d e f g x <y> &amp; é one two 1 2"
    assert main_text("<article><header><h1>Title</h1></header><p>Text 1 < 2, a<3.</p><nav>Menu</nav></article>") == "Title Text 1 < 2, a<3."
    assert main_text('<article><p title="a>b">Shown.<!-- <p>not</p> --></p><span class="ad">Buy.</span> more</article>') == "Shown. more"
    assert main_text("plain words only, with no tag at all.") == "plain words only, with no tag at all."


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<!--", "<script>x", "</p>", "<a href='", "&", "<>", "</>", "<!", "<\x00>", "<div><nav>menu</nav></div>"])
def test_pages_without_text(page):
    assert main_text(page) in ("", "&", "<", "<>", "<\x00>")


@pytest.mark.parametrize("page", ["<p>a" * 100_000, "<div>" * 100_000 + "word.", "<!--" * 100_000, '<a b="' * 100_001, "<p><table>" + "<div>" * 100_000, "<li>x" * 100_000,
                                  "<script>" * 100_000, "</div>" * 100_000, "<b" * 100_000, "<a b='" * 100_000 + '"' * 100_000, "&amp" * 200_000, "<x =" * 100_000, "<ul><li>" * 50_000,
                                  '<p style="' + "display " * 100_000 + '">x'])
def test_hostile_pages(page):
    start = time.time()
    main_text(page)
    assert time.time() - start < 10


def test_paths(spark, small):
    found = path_ratios(spark.read.parquet(f"{small}/pages.parquet"))
    chosen = {r.path for r in found.where("chosen").select("path").distinct().collect()}
    assert chosen == {"html/body/article/h1", "html/body/article/p"}
    assert found.where("kind = 'out' AND chosen").count() == 0


def test_odd_rows(spark):
    page = "<article><p>Some words here.</p></article>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (None, "v", ""), (None, None, "<p>" + "x " * 500_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({n: F.lit(n) for n in ("text", "n_chars", "path")})
    made = sorted(map(tuple, extract(pages).collect()), key=str)
    long = ("x " * 500_000).strip()
    assert made == sorted([(1, "u", "Some words here.", 16)] * 2 + [(2, None, "", 0), (None, "v", "", 0), (None, None, long, len(long))], key=str)
    assert extract(pages.where("false")).count() == 0
