import html as entities
import re

import pytest
from pyspark.sql import functions as F

from padron.llm import wrappers

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><article>";</script></head><body>'
    '<header class="site"><h1>Site</h1></header><nav><ul>{nav}</ul></nav><div class="cookie-notice">We use cookies</div>'
    '<div class="layout has-sidebar"><div class="sidebar"><p>Side text that is rather long, longer than the article</p></div>'
    "{open}<h1>Head &amp; line {i}</h1>{body}<aside>aside</aside><form><input><p>mail</p></form>"
    '<div class="share-buttons">Share</div>{close}<section id="comments"><article class="comment"><p>Reader says {i} and a lot more words'
    " than anyone else on the page ever did</p></article></section></div><!-- x --><footer>&copy; {i}</footer></body></html>"
)


def page(i, tag="article", paragraphs=None):
    paragraphs = [f"Text <b>{i}</b>\n and {j}  more&nbsp;of it." for j in range(i % 4 + 1)] if paragraphs is None else paragraphs
    opening, closing = (f"<{tag}>", f"</{tag}>") if tag in ("article", "main") else ('<div class="content">', "</div>")
    nav = "".join(f"<li><a href='/{j}'>menu {j}</a></li>" for j in range(i % 5 + 2))
    return PAGE.format(nav=nav, i=i, open=opening, close=closing, body="".join(f"<p>{p}</p>" for p in paragraphs))


def want(i):
    return " ".join([f"Head & line {i}", *(f"Text {i} and {j} more of it." for j in range(i % 4 + 1))])


@pytest.mark.parametrize("tag", ["article", "main"])
def test_wrapper_cuts_out_the_article(tag):
    pages = [page(i, tag) for i in range(12)]
    expression, forms = wrappers.infer(pages)
    pattern = re.compile(expression)
    for i in range(30):
        text, fits = wrappers.extract(page(i, tag), pattern, forms)
        assert text == want(i)
        assert fits or i >= 12


def test_without_a_wrapper_and_cut_off_pages():
    full = page(3)
    assert wrappers.extract(full, None, [])[0] == want(3)
    cut = full[: full.index("and 1  more")]
    assert wrappers.extract(cut, None, [])[0] == "Head & line 3 Text 3 and 0 more of it. Text 3"
    assert wrappers.extract("", None, []) == ("", False)
    assert wrappers.extract("no markup at all &lt;here&gt; < 5", None, [])[0] == "no markup at all <here> < 5"


def test_repeats_become_groups():
    units = {}
    folded = wrappers.folded("abcbcbcd" + "xyxyzxyxyz", units)
    assert "bc" in units and wrappers._unfolded(folded, units) == "abcd" + "xyz"


def test_optional_parts_and_repeats_in_the_expression():
    short = "<article><h1>a</h1><p>b</p></article>"
    long = "<article><h1>a</h1><img src=x><p>b</p><p>c</p><p>d</p></article>"
    expression, forms = wrappers.infer([f"<html><body>{x}</body></html>" for x in (short, long)])
    assert ")?+" in expression and ")++" in expression
    other = "<html><body><article><h1>q</h1><p>1</p><p>2</p><p>3</p><p>4</p></article></body></html>"
    assert wrappers.extract(other, re.compile(expression), forms) == ("q 1 2 3 4", True)


def test_over_spark(spark):
    rows = [(i, f"https://a.example/{i}", page(i)) for i in range(8)]
    rows += [(100, "https://lonely.example/", page(1)), (101, None, page(2)), (102, "https://a.example/n", None), (103, "x", ""), (None, "https://a.example/0", page(0))]
    docs = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", F.lit("clash")).withColumn("text", F.lit(1))
    found = wrappers.main_texts(docs).collect()
    assert len(found) == len(rows)
    by_id = {r["page_id"]: r for r in found}
    for i in range(8):
        assert by_id[i]["text"] == want(i) and by_id[i]["n_chars"] == len(want(i)) and by_id[i]["wrapped"]
    assert by_id[100]["text"] == want(1) and by_id[101]["text"] == want(2) and by_id[101]["url"] is None
    assert by_id[102]["text"] == by_id[103]["text"] == "" and by_id[None]["text"] == want(0)
    assert wrappers.main_texts(docs.limit(0)).collect() == []


def test_whole_articles_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = {r["page_id"]: r["text"] for r in wrappers.main_texts(pages).collect()}
    for r in pages.collect():
        body = re.split(r"</article>", r["html"].split("<article>")[1])[0]
        body = re.sub(r"<[^>]*$", "", re.sub(r"</?b>", "", body))
        assert found[r["page_id"]] == " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", body)).split())


def nameless(i):
    """A page whose parts have names that say nothing: a menu, a slogan and a long legal text around what it is about."""
    menu = "".join(f'<span class="q1"><a href="/{j}">choice {j}</a></span>' for j in range(6))
    body = "".join(f'<div class="z9">About {i} there is {j} to say, in words of its own.</div>' for j in range(i % 3 + 1))
    legal = "All that is said here is said without warranty, and may not be copied, lent or sold. " * 6
    return (
        f'<html><body><div class="k3"><div class="a7">{menu}</div><div class="b2">The best there is</div>'
        f'<div class="c4"><h1>Story {i}</h1>{body}</div><div class="d5">{legal}</div><div class="e8">Page {i % 2}</div></div></body></html>'
    )


def test_template_texts_are_told_by_the_alignment_of_pages(spark):
    pages = [nameless(i) for i in range(12)]
    want = [" ".join([f"Story {i}", *(f"About {i} there is {j} to say, in words of its own." for j in range(i % 3 + 1))]) for i in range(12)]
    alone = wrappers.extract(pages[5], None, [])[0]
    assert "warranty" in alone  # the rule for containers alone takes the whole page
    rows = [(i, f"https://plain.example/{i}", h) for i, h in enumerate(pages)]
    found = {r["page_id"]: r["text"] for r in wrappers.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for i in range(12):
        assert found[i] == want[i]


def test_template_needs_several_different_pages():
    alphabet = wrappers.Alphabet()
    same = [wrappers.stream(nameless(1), alphabet, grow=True) for _ in range(9)]
    assert wrappers.template(same, alphabet) == []
    few = [wrappers.stream(nameless(i), alphabet, grow=True) for i in range(3)]
    assert wrappers.template(few, alphabet) == []


def test_articles_keep_what_all_pages_say():
    pages = [f"<html><body><article><h1>T {i}</h1><p>Said on every page.</p></article></body></html>" for i in range(9)]
    expression, forms, known = wrappers.infer_all(pages)
    assert known and wrappers.extract(pages[2], re.compile(expression), forms, frozenset(known))[0] == "T 2 Said on every page."


def _found(spark, pages):
    rows = [(i, f"https://many.example/{i}", h) for i, h in enumerate(pages)]
    return {r["page_id"]: r for r in wrappers.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}


def test_every_page_of_a_host_is_in_its_wrapper(spark):
    pages = [
        f"<html><body><div class='{chr(97 + i // 26)}{chr(97 + i % 26)}'>menu</div><article><h1>T {i}</h1><p>Own {i}</p></article></body></html>"
        for i in range(60)
    ]
    found = _found(spark, pages)
    assert all(found[i]["wrapped"] and found[i]["text"] == f"T {i} Own {i}" for i in range(60))


@pytest.mark.parametrize("often", [35, 36])
def test_template_texts_are_counted_over_all_pages_of_a_host(spark, often):
    """36 of 60 pages are the share from which a text is template; each of 12 texts stands on as many, not the same ones."""
    lines = [[f"Line {k} of some pages" if (i * 7 + k * 5) % 60 < often else f"Line {k} of page {i}" for k in range(12)] for i in range(60)]
    pages = [f"<html><body><div>{''.join(f'<p>{x}</p>' for x in own)}<h1>Story {i}</h1></div></body></html>" for i, own in enumerate(lines)]
    found = _found(spark, pages)
    for i, own in enumerate(lines):
        kept = [x for x in own if often < 36 or not x.endswith("pages")]
        assert found[i]["text"] == " ".join([*kept, f"Story {i}"])


def test_joined_wrappers_keep_what_both_need():
    one, two = ("a", ("?", ("x",)), "b", "c"), ("a", ("?", ("x",)), ("?", ("y",)), "c", "d")
    assert wrappers.joined(one, two) == ("a", ("?", ("x",)), ("?", ("y",)), ("?", ("b",)), "c", ("?", ("d",)))
    assert wrappers.joined(one, one) == one
