"""Links that op10_redirects must find: each page is an alias of the blocked one only by its link."""

from tidyloom.llm import redirects

BAD = "http://bad.net/dir/page?a=1&b=2"
LINKS = {
    "http://a1.com/x": '<link rel="Canonical" href="http://bad.net/dir/page?a=1&b=2">',
    "http://a2.com/x": f'<link {"data-x=y " * 500} rel="canonical" href="{BAD}">',
    "http://a3.com/x": f'<link rel="canonical" href="http://other.com/"><link rel="canonical" href="{BAD}">',
    "http://a4.com/x": f'<meta http-equiv="refresh" content="300"><META HTTP-EQUIV=refresh content="0; url={BAD}">',
    "http://a5.com/x": '<link rel="canonical" href="http://bad.net/dir/page?a=1&amp;b=2">',
    "http://bad.net.org/dir/page": "<link rel=canonical href='?id=3'>",
    "http://bad.net.org/dir/page?id=3": f'<link href="{BAD}" rel="alternate canonical">',
    "http://b1.org/d/one.html": '<link rel="canonical" href="two.html">',
    "http://b1.org/d/two.html": '<link rel="canonical" href="../e/./three.html">',
    "http://b1.org/e/three.html": f'<link rel="canonical" href="{BAD}#part">',
    "http://b2.org": '<link rel="canonical" href="sub">',
    "http://b2.org/sub": '<link rel="canonical" href="//bad.net/dir/page?a=1&#38;b=2">',
}
OTHERS = {
    "http://c1.org/x": f'<link rel="noncanonical" href="{BAD}"><link data-rel="canonical" href="{BAD}">',
    "http://c2.org/x": '<link rel="canonical" href="mailto:a@bad.net"><link rel="canonical" href="#top">',
    "http://c3.org/x": f'<link rel="canonical" href="/go?to={BAD}">',
}


def test_every_link_of_a_page_is_an_edge(spark):
    pages = [(url, url, html) for url, html in {BAD: "", **LINKS, **OTHERS}.items()]
    frame = spark.createDataFrame(pages, "page_id string, url string, html string").coalesce(2)
    found = {r["page_id"]: r["verdict"] for r in redirects.judged(frame, [("block", "bad.net", "/")]).collect()}
    assert found == {BAD: "block"} | dict.fromkeys(LINKS, "block") | dict.fromkeys(OTHERS, "allow")
