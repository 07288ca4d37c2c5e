from urllib.parse import urljoin, urlparse

from pyspark.sql import functions as F

from pageglean.functions import urls as U
from pageglean.operators import links as L

BASES = ["http://h.com/d/e/f.html?q=1", "https://h.com", "http://u:p@h_x.com:80/a/b/", "http://h.com/a//b/c;p=1"]
HREFS = [
    "x", "/x", "../x", "../../../x", "./x", ".", "..", "/..", "/a/./b/../c", "?z=1", "#f", "//o.com/p", "http://o.com/../p",
    "https://o.com", "mailto:a@b.c", "javascript:void(0)", "x/../../y/", "a//b", "", "x;y=1", "b/.", "b/..", "HTTP://UP.com/X",
]


def test_resolve_is_like_the_standard_join(spark):
    pairs = [(b, h) for b in BASES for h in HREFS]
    got = spark.createDataFrame(pairs, "b string, h string").select("b", "h", U.resolve(F.col("b"), F.col("h"))).collect()
    # The last link form differs by design in the case of its scheme, which the standard function lowers.
    wrong = [(b, h, u, urljoin(b, h)) for b, h, u in got if u.lower() != urljoin(b, h).lower()]
    assert wrong == []


def test_parts_are_like_the_standard_parser(spark):
    urls = BASES + ["foo.com/x", "//h/p", "http://x_y.net/é?a#b", "http://h", "a b", "", "mailto:a@b.c", "/p;v/q;w?x", "1http://x"]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(
        "u", U.scheme(F.col("u")), U.authority(F.col("u")), U.path(F.col("u"))).collect()
    # Schemes without parameters keep the semicolon there; the pages' schemes do not.
    for u, scheme, host, path in rows:
        p = urlparse(u)
        assert (scheme, host, path) == (p.scheme, p.netloc, p.path), u


def test_default_scheme_and_validity(spark):
    urls = ["foo.com/x", "http://a/b", "mailto:x@y", "//h/p", ""]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(U.default_scheme(F.col("u")), U.is_valid(F.col("u"))).collect()
    assert [tuple(r) for r in rows] == [
        ("http://foo.com/x", False), ("http://a/b", True), ("mailto:x@y", False), ("http:////h/p", False), ("http://", False)]


def test_link_rules(spark):
    hrefs = [None, "", "x y", "/a?b#c", "../a", "//h/p", "?q", "#f", "mailto:a@b.c", "javascript:void(0)", "/forums/x",
             "/x/forums", "https://www.seed.com/p/", "http://notseed.com", "/new\nline", " /lead"]
    df = spark.createDataFrame([("http://seed.com/d/p.html", hrefs)], "src_url string, hrefs array<string>")
    links = L.add_kind(L.skip_paths(L.resolve_links(df)), "seed.com")
    got = {(r.dst_url, r.kind) for r in links.collect()}
    assert got == {
        ("http://seed.com/a", "internal"), ("http://h/p", "external"), ("http://seed.com/d/p.html", "internal"),
        ("http://seed.com/x/forums", "internal"), ("https://www.seed.com/p", "internal"), ("http://notseed.com", "internal"),
        ("http://seed.com/newline", "internal"), ("http://seed.com/lead", "internal")}
    strict = {r.dst_url: r.kind for r in L.add_kind(links.drop("kind"), "seed.com", strict=True).collect()}
    assert strict["http://notseed.com"] == "external" and strict["https://www.seed.com/p"] == "internal"


def test_extract_links_puts_internal_pages_under_the_seed(spark):
    pages = spark.createDataFrame([
        ("https://www.seed.com/a/?x=1", '<a href="b">1</a><a href="/a/b">2</a><a href="http://o.org/a.seed.com/">3</a><a href="/skip/me">4</a>'),
    ], "url string, html string")
    got = {tuple(r) for r in L.extract_links(pages, "http://seed.com/", "'skip'").collect()}
    assert got == {("http://seed.com/a", "http://seed.com/a/b", "internal"), ("http://seed.com/a", "http://o.org/a.seed.com", "external")}


def test_seed_parts():
    assert U.seed_parts("http://shop.com?x=1") == ("http", "shop.com")
    assert U.seed_parts("shop.com/a") == ("http", "shop.com")
    assert U.seed_parts("HTTPS://www.shop.com/#a") == ("https", "www.shop.com")
