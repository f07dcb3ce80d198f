import time

import pytest
from pyspark.sql import functions as F

from jsonstrata.llm.lines import drop_site_lines
from samples import CLASHES


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumns({c: F.lit("clash") for c in CLASHES}).withColumn("dropped", F.lit(1))


def test_lines_above_the_ratio_go(spark):
    rows = [(i, f"http://A.example/{i}", f"<p>menu</p><p>own {i}</p><p>menu</p><script>x</script>") for i in range(4)]
    rows += [(10 + i, f"https://b.example:80/{i}", "<li>rare</li>" if i < 2 else f"<b>page</b> {i}<br>x") for i in range(20)]
    rows += [(40, None, "<p>menu</p>"), (41, "no host", "<p>menu</p>"), (42, "http://a.example/", None), (43, "http://a.example", "")]
    got = {r["page_id"]: r for r in drop_site_lines(pages(spark, rows)).collect()}
    assert [(got[i]["kept"], got[i]["n_lines"], got[i]["n_removed"]) for i in range(4)] == [(f"own {i}", 3, 2) for i in range(4)]
    assert got[10]["kept"] == "rare"  # on two pages only
    assert (got[15]["kept"], got[15]["host"]) == ("page 5", "b.example")  # "x" stands on nine tenths
    assert got[40]["host"] == got[41]["host"] == "" and got[40]["kept"] == "menu"
    assert (got[42]["kept"], got[42]["n_lines"]) == ("", 0) and got[43]["host"] == "a.example"


def test_ratio_is_by_host(spark):
    rows = [(i, "http://small.example/", "<p>line</p>") for i in range(3)] * 2
    rows += [(100 + i, "http://big.example/", "<p>line</p>" if i < 5 else f"<p>{i}</p>") for i in range(100)]
    got = drop_site_lines(pages(spark, rows)).groupBy("host").agg(F.sum("n_removed").alias("n"), F.count("*").alias("pages")).collect()
    assert {r["host"]: (r["n"], r["pages"]) for r in got} == {"small.example": (6, 6), "big.example": (0, 100)}
    assert drop_site_lines(pages(spark, [])).count() == 0


@pytest.mark.parametrize("mark", ["<", "<p ", "<!--", "<script>", "<script", "<a <b>", "</", "<div a='<'>"])
def test_a_long_page_of_marks_takes_linear_time(spark, mark):
    start = time.monotonic()
    row = drop_site_lines(pages(spark, [(1, "http://a.example/", "<p>first</p>" + mark * (1_000_000 // len(mark)))])).first()
    assert time.monotonic() - start < 30 and row["kept"].startswith("first") and row["n_removed"] == 0


def test_markup_that_is_not_closed_and_hosts(spark):
    urls = {"http://user:pw@site.org/a": "site.org", "//site.org/b": "site.org", "https://me@h:8080?x@y": "h", "ftp:/x": "", "mailto:a@b": ""}
    rows = [(i, url, f"<p>one</p><b>two</b><!-- no {i} end <p>three</p>") for i, url in enumerate(urls)]
    got = {r["page_id"]: r for r in drop_site_lines(pages(spark, rows), min_pages=99).collect()}
    assert [got[i]["host"] for i in range(len(urls))] == list(urls.values())
    assert {r["kept"] for r in got.values()} == {"one\ntwo"}
    odd = [(1, None, "a < b <p>x</p><style>h</style>y<script src='a'>z"), (2, None, "<scripted>shown"), (2, None, "<scripted>shown")]
    assert sorted(r["kept"] for r in drop_site_lines(pages(spark, odd)).collect()) == ["a < b\nx\ny", "shown", "shown"]
