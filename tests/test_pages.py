"""The page reader: odd markup, what is cut off, one pass in the plan, and no page that stops a job."""

import random
import time

import pytest

from larkspur.operators import extract
from larkspur.plans import registry  # noqa: F401

DATA = "/root/testdata/sf0.001"


def read(html, *schemas):
    return extract.Reader(schemas or (extract.CARDS,)).read(html)


def test_marked_sections_and_cut_tags_give_rows():
    card = "<li class=property__component><a href=/x><b class=title>T &amp; U</b></a><![CDATA[ x ]]><ul><li class='price'>5</ul></li>"
    whole = read(card + "<![foo bar>")
    assert not whole["cut"] and [(c["title"], c["link"], c["price"]) for c in whole["cards"]] == [("T & U", "/x", "5")]
    for tail in ("<div class='x", "<!-- never", "<!DOCTYPE", "</li", "<a href="):
        cut = read(card + tail)
        assert cut["cut"] and cut["cards"] == whole["cards"]
    assert read(None) == read("") == {"cards": [], "cut": False}
    assert read("<li class=property__component title=it's><i class=title>a < b</i>")["cards"][0]["title"] == "a < b"


def test_scripts_quotes_and_stray_ends():
    schema = extract.Schema("r", "div", (extract.Field("own", ""), extract.Field("a", "p a", ("href",), many=True), extract.Field("t", ".t")))
    html = "</p></div><div>x<script>if (a<b) '<p><a href=no></a>'</script><p title='a>b'><a href='1>2'></a></i></p><a href=3></a><p/><b class='s t'>u</b>"
    assert read(html, schema)["r"] == [{"own": "xif (a<b) '<p><a href=no></a>'u", "a": ["1>2"], "t": "u"}]
    nested = read("<div class=t>1<div>2</div></div>", schema)["r"]
    assert [(r["own"], r["t"]) for r in nested] == [("12", None), ("2", None)]


def test_any_text_is_read_in_linear_time():
    rng = random.Random(2)
    pieces = ["<", ">", "a", "<a ", "</a>", "<li class=property__component>", "='", '="', "<!--", "-->", "<![", "&amp;", "é", " ", "<script>", "</script>", "/", "<b class=title>"]
    for _ in range(400):
        read("".join(rng.choices(pieces, k=rng.randint(0, 60))))
    for piece in pieces + ["<a ='", '<a b="', "<a b=c", "<!-", "<div>"]:
        start = time.time()
        read(piece * 50_000)
        assert time.time() - start < 5, piece


def nodes(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(plan.count(x) for x in ("MapInArrow", "PythonMapInArrow", "ArrowEvalPython", "BatchEvalPython")) - plan.count("PythonMapInArrow")


@pytest.mark.parametrize(("name", "most"), [("html_cards", 1), ("manifest_cards", 1), ("staging_rows", 1), ("site_cards", 1), ("detail_records", 1), ("detail_overlay", 2)])
def test_pages_are_read_once(spark, name, most):
    assert nodes(registry.QUERIES[name](spark, DATA)) == most


def test_bad_pages_stop_no_job(spark):
    pages = spark.createDataFrame([(1, "u", "<![foo bar>"), (2, "u", None), (3, "u", "<li class=property__component><a href=/x><b class=title>T</b></a><div"), (4, "u", "\x00<<>>")], "page_id long, url string, html string")
    rows = {r.page_id: r for r in extract.records(pages, extract.CARDS).collect()}
    assert [rows[i].cut for i in (1, 2, 3, 4)] == [False, False, True, False] and [len(rows[i].cards) for i in (1, 2, 3, 4)] == [0, 0, 1, 0]
    assert [r.page_id for r in extract.listing_cards(pages).collect()] == [3]
