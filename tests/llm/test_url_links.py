"""Links between pages are resolved against the page's url."""
from urllib.parse import urldefrag, urljoin

import pytest
from pyspark.sql import functions as F

from scorecraft.llm.url_filter import resolved, url_filter


def test_resolved_like_the_library(spark):
    pages = ["http://a.com/b/c/d.html?q=1#top", "https://a.com", "http://a.com/", "http://a.com/b/?x=/../y"]
    refs = ["page.html", "../x", "../../../x/", "./", ".", "..", "?id=1", "#top", "/r/../s", "//o.net/p/./q", "e/../f?g=/./h", "http://o.net/a/../b#z", "?a=1&amp;b=2", ".."]
    got = spark.createDataFrame([(p, r) for p in pages for r in refs], "p string, r string").select("p", "r", resolved(F.col("r"), F.col("p")).alias("u")).collect()
    want = {(p, r): urldefrag(urljoin(p, r.replace("&amp;", "&")))[0] for p in pages for r in refs}
    for p in pages:  # the library leaves dots in references with a host
        want[p, "//o.net/p/./q"], want[p, "http://o.net/a/../b#z"] = p.split(":")[0] + "://o.net/p/q", "http://o.net/b"
    assert {(x.p, x.r): x.u for x in got} == want
    none = spark.createDataFrame([("no scheme", "x"), ("http://a.com/", "javascript:void(0)"), ("http://a.com/", "mailto:x")], "p string, r string")
    assert [x.u for x in none.select(resolved(F.col("r"), F.col("p")).alias("u")).collect()] == [None] * 3


@pytest.mark.parametrize("ref", ["page.html", "./page.html", "../x/page.html#top", "page.html?a=1&amp;b=2"])
def test_sites_with_the_same_relative_link_stay_apart(spark, ref):
    link = f'<link rel="canonical" href="{ref}">'
    end = "?a=1&b=2" if "?" in ref else ""
    rows = [(1, "http://bad.net/x/1", link), (2, "http://clean.com/x/1#part", link), (3, f"http://clean.com/x/page.html{end}", None), (4, "http://clean.com/x/2", link)]
    got = {r.page_id: r for r in url_filter(spark.createDataFrame(rows, "page_id long, url string, html string"), [("bad.net/", "block")]).collect()}
    assert [got[k].verdict for k in (1, 2, 3, 4)] == ["block", "allow", "allow", "allow"]
    assert got[2].component == got[3].component == got[4].component != got[1].component
