import time

import pytest
from pyspark.sql import functions as F

from pageglean.functions import html as H


def texts(spark, expression, *pages):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("html"))).collect()]


def test_visible_text_leaves_out_what_is_not_shown(spark):
    assert texts(
        spark, H.visible_text,
        "<html><head><title>T</title>x<style>p{}</style></head><body><p>one</p><!-- <p>no</p> -->two</body></html>",
        '<p>a</p><script>var t="</p>";</script><noscript><b>n</b></noscript><header>h</header>',
        "loose <p>in</p>", "<p>x</p></html> tail", "no markup at all", "<p>1 < 2</p>",
        '<a title="x > y" href=\'/p\'>link</a>end', "<p>cut <b", "<p>open<script>never closed <p>x",
        "<p>\nline starts a node\n</p>", "<p>foo<b>bar</b></p>", "", "<!-- open comment <p>x",
    ) == ["one two", "a h", "in", "x", "", "1 < 2", "link end", "cut", "open", "line starts a node", "foo bar", "", ""]


def test_entities_are_decoded_once(spark):
    assert texts(
        spark, H.decode_entities,
        "&amp;lt;", "&lt;b&gt;", "a &copy; b", "&#65;&#x42;&#X43;", "&amp", "&am", "a & b", "&unknown;", "&#0;", "&#128;",
        "&#99999999;", "&#x1F600;", "&eacute;t&eacute;", "none",
    ) == ["&lt;", "<b>", "a © b", "ABC", "&", "&am", "a & b", "&unknown;", "�", "€", "�", "\U0001F600", "été", "none"]


def test_title(spark):
    assert texts(
        spark, H.title_text,
        "<title>A <b>B</b></title>", "<TITLE lang=en>\n x \n</TITLE ><title>second</title>", "<p>none</p>",
        "<title>&lt;i&gt;kept&lt;/i&gt;</title>", "<title>R&amp;D</title>",
    ) == ["A B", "x", "", "kept", "R&D"]


def test_meta_reads_content_then_value(spark):
    def keywords(html):
        return H.meta_text(H.meta_tags(html), "keywords")

    assert texts(
        spark, keywords,
        '<meta name="keywords" content="a, b">', "<meta value='v' name=keywords>", '<meta charset="utf-8">',
        '<meta name="Keywords" content="other case">', '<meta content="x > y" name="keywords"/>',
        '<meta name="keywords"><meta name="description" content="d">', '<META NAME="keywords" CONTENT="up &amp; down">',
        '<meta name="description" content="d"><meta name="keywords" content="k1"><meta name="keywords" content="k2">',
    ) == ["a, b", "v", "", "", "x > y", "", "up & down", "k1"]


def test_anchors(spark):
    assert texts(
        spark, H.anchor_hrefs,
        '<a href="/a">1</a><A class=x HREF=\'/b\'>2</A><a href=/c>3</a><a name="n">4</a><a href="">5</a>',
        '<!-- <a href="/no"> --><script>"<a href=\'/no\'>"</script><a data-href="/no" href="/yes?a=1&amp;b=2">',
        "<area href='/no'><abbr>x</abbr>",
    ) == [["/a", "/b", "/c", ""], ["/yes?a=1&b=2"], []]


def test_long_page_is_read_whole(spark):
    page = "<p>" + "word <i a='1' b=\"2\">x</i> & " * 200_000 + "<p>last"
    text = texts(spark, H.visible_text, page)[0]
    assert text.count("word") == 200_000 and text.endswith("last")


def test_many_attributes_do_not_overflow(spark):
    assert texts(spark, H.visible_text, "<p " + 'a="1" ' * 100_000 + ">end", "<p " + 'a="1" ' * 100_000) == ["end", ""]


def test_valid_text_drops_bad_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb\xc3\xa9"),)], "raw binary")
    assert df.select(H.valid_text(F.col("raw"))).first()[0] == "abé"


HOSTILE = ("<title>", "<TITLE >x", "<head>", "<noscript>", "<a b ", '<a x=">"', "<a x='>'", "<meta ", '<meta x=">" ', "<!--", "<!-- x", "<script>", "<style",
           "</title", "<html", "</html>", "<p a=", "<title>&lt;", "&lt;", "&", "&#", "<", "<!", "<title></head>", "<a href=", "<a href='", "</head><head>")


@pytest.mark.parametrize("piece", HOSTILE)
def test_hostile_pages_take_linear_time(spark, piece):
    """Twice the page takes about twice the time; a quadratic scan of the longer one would take minutes."""
    def seconds(n):
        df = spark.createDataFrame([(piece * n,)], "html string").select(
            F.length(H.title_text(F.col("html"))), F.length(H.visible_text(F.col("html"))), F.size(H.anchor_hrefs(F.col("html"))), F.size(H.meta_tags(F.col("html"))))
        begin = time.perf_counter()
        df.collect()
        return time.perf_counter() - begin

    short = seconds(8_000)
    assert seconds(16_000) < 2.5 * short + 1


def test_unclosed_elements_and_tags(spark):
    assert texts(
        spark, H.visible_text,
        "<title>a<p>b", "<title>a</title>b<title>c", "<head>x<p>y</head>z<head>w", "<NOSCRIPT>a</noscript>b<NoScript>c",
        "<head><!-- </head> -->in<script>'</head>'</script></head>out", "<p>a<b x='1' y=\"><i>rest", "<p>a <> b <3 c", "<title>a</TITLE ><p>b</p>",
        "<p>a</title>b", "<p>x<title>y</title>",
    ) == ["a b", "b c", "z w", "b c", "out", "a rest", "a <> b <3 c", "b", "a b", "x"]
    assert texts(
        spark, H.title_text, "<title>a<p>b", "<!-- <title>no</title> --><title>yes</title>", "<title>a<title>b</title>c</title>", "<Title>A <!--x--> b</tItLe>",
        "<title>&lt;b&gt;c &lt; d\n&gt;e</title>",
    ) == ["", "yes", "a b", "A b", "c < d >e"]
