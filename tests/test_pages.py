"""Page reading and the spread of the work on pages and models."""

import re

import pytest
from pyspark.sql import functions as F

from offerwell.operators import extract as B
from offerwell.operators import features as M
from offerwell.plans import models, pages
from offerwell.sources.views import Tables

PAGES = [
    '<html><body><ul><li>menu<li>two</ul><p>a<p>b<br>c<img alt="x" src="y"></p>tail</body></html>',
    '<div class="a  b" class="c"><a href="/x.html?y=1">T</a></span> 5 < 6 </div>',
    "<p>fish &amp; chips &euro;</p><P CLASS='big'>x</P><input disabled>",
    "<title>a <b>no tag</b></title><script>if (a < b) { '<p>' }</script><p>x</p>",
    '<!doctype html><!-- <p>no</p> --><p a="1"/><b a="&lt;">t</b>',
    '<td>1<td>2<tr><td>3</table>é \u00a0 \r\n z', "", "text only", "<", "a<b", '<p a="x>y">z</p>', "<p", "</p", "x</p >y", '<a href="1"href="2">q</a>',
]


def tree(node):
    return (node.tag, node.attrs, [tree(c) if isinstance(c, B._Node) else c for c in node.children])


@pytest.mark.parametrize("html", PAGES)
def test_quick_reader_builds_the_tree_of_the_full_parser(html, monkeypatch):
    found = tree(B._Page(html).root)
    monkeypatch.setattr(B._Page, "_quick", lambda self, html: False)
    assert found == tree(B._Page(html).root)


def test_plain_pages_need_no_full_parser(monkeypatch):
    monkeypatch.setattr(B._Page, "feed", lambda self, html: pytest.fail("full parser"))
    assert [n.tag for n in B._Page(PAGES[0]).root.walk()] == ["html", "body", "ul", "li", "li", "p", "p", "br", "img"]


STAR = {
    "lineitem": [(i, i % 5, i % 3, 1 + i % 7, 1.0, 100.0 + i, 0.05, 0.02, "A", "F", None) for i in range(4000)] + [(None,) * 11] * 2,
    "part": [(i, f"part {i}", "b", "SMALL", 1, 1.0) for i in range(5)],
    "supplier": [(i, f"s{i}", i, 0.0) for i in range(3)],
    "nation": [(i, f"n{i}", i) for i in range(3)],
    "region": [(i, n) for i, n in enumerate(["AFRICA", "EUROPE", None])],
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of one file and one row group each."""
    from offerwell.sources.views import STORED

    base = tmp_path_factory.mktemp("star")
    for name, rows in STAR.items():
        spark.createDataFrame(rows, STORED[name]).coalesce(1).write.parquet(f"{base}/{name}.parquet")
    return str(base)


def test_listings_of_one_split_are_dealt_to_several_tasks(spark, folder):
    t = Tables(spark, folder)
    plain = [tuple(r) for r in t.raw_listings.collect()]
    for other in (t.dealt(), t.written()):
        assert sorted(map(str, plain)) == sorted(str(tuple(r)) for r in other.raw_listings.collect())
    assert "Exchange hashpartitioning(l_orderkey" in plan(pages.shop_pages(t))


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_class_weights_leave_the_rows_where_they_are(spark):
    rows = spark.createDataFrame([(i, None if i == 0 else i % 3) for i in range(30)], "id long, y int")
    found = M.class_weights(rows.hint("merge"), "y")
    assert "SortMergeJoin" not in plan(found) and "BroadcastHashJoin" in plan(found)
    assert {r["y"]: round(r["weight"], 4) for r in found.collect()} == {None: 7.5, 0: round(30 / 36, 4), 1: 0.75, 2: 0.75}


def test_features_hold_only_what_a_fit_reads(spark, folder):
    rows = models.dataset(Tables(spark, folder))
    assert set(rows.columns) == {*models.USED, "is_test"}
    # The listings are read from the join that was written, not joined again for medians and features.
    assert not re.search("Join|lineitem", plan(rows))


def test_accents_fold_as_before(spark):
    rows = spark.createDataFrame([("Été",), ("plain A-1",), ("e\u0301a",), ("",), (None,)], "t string")
    from offerwell.functions.text import strip_accents

    assert [r[0] for r in rows.select(strip_accents(F.col("t"))).collect()] == ["Ete", "plain A-1", "ea", "", None]


def test_read_raw_stores_packed_files(spark, tmp_path, monkeypatch):
    from offerwell.plans import pages as P
    from offerwell.plans.catalogue import callables

    monkeypatch.setattr(P, "work_dir", lambda spark, name: str(tmp_path / name))
    read, parsed = (callables()[q](spark, "/root/testdata/sf0.001") for q in ("read_raw", "normalise"))
    assert read.exceptAll(parsed).count() == 0 and read.count() == parsed.count()
    files = [f for f in (tmp_path / "raw").rglob("part-*")]
    assert {f.parent.name for f in files} == {"amazon", "cdiscount", "avito", "jumia", "steam"}
    assert all(f.name.endswith(".json.gz") for f in files)


def test_a_subtree_is_the_run_of_elements_that_follow_it():
    html = "<div><p>a<p>b<b>c</b><ul><li>1<li>2<i>x</i></ul></div><article><img src='q'><h1>t &amp; u</h1></article></b><s></s>"
    for text in (html, html.replace(" &amp;", "").replace("'", '"')):
        root = B._Page(text).root

        def below(node):
            return [x for c in node.children if isinstance(c, B._Node) for x in (c, *below(c))]

        assert len(root.walk()) > 10 and all(n.walk() == below(n) for n in (root, *root.walk()))


def test_heuristic_prices_read_every_text_once(spark):
    """The old price was a filter that read all texts again for each of them: its plan held their pattern several times."""
    from offerwell.functions import offers as O

    rows = spark.createDataFrame([(["a", "5 €", None, "5  €", " 7 EUR", "9 €"],), (["5 €", "5 €"],), ([],), (None,)], "nodes array<string>")
    prices = O.pick_prices(F.col("nodes"))
    found = rows.select(prices["price_new"], prices["price_old"])
    assert [tuple(r) for r in found.collect()] == [("5 €", "7 EUR"), ("5 €", ""), (None, ""), (None, "")]
    old = rows.select(prices["price_old"])._jdf.queryExecution().optimizedPlan().toString()
    assert old.count("regexp_replace") <= 2  # 4 before
    rated = rows.select(O.pick_rating(F.array(F.lit("4,5/5"), F.lit(None), F.lit("3 étoiles")), F.lit("")).alias("r")).first()[0]
    assert rated == "4.5"
