"""Column expressions that read HTML source text.

All of them are built-in Spark functions, so a page is parsed inside the scan stage and its HTML never crosses a shuffle.

A page is read in two steps, both linear in its length whatever it holds. ``marked`` goes over the source once: every tag,
comment and script becomes a short mark, and the marks of title, noscript and head keep their name. No alternative of its
pattern can look far ahead and then fail, as what is never closed reaches to the end of the page. An opening mark that no
closing mark of its name follows is then turned into a plain one, so that each search from an opening to a closing mark ends
at one, and what was passed over is not looked at again.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageglean.functions.bind import let

# The rest of a tag, with quoted attribute values allowed to hold ">". One that is never closed reaches to the end.
_TAG_REST = r"""[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+>"""
_COMMENT_OR_SCRIPT = r"!--.*?(?:-->|\z)|(script|style)(?:\s[^>]*+)?+>.*?(?:</\1\s*+>|\z)"

# Elements whose text is not part of the body where they are closed.
_KEPT = ("title", "noscript", "head")
_NAMES = "|".join(_KEPT)

# Comments and raw-text elements come first, then the tags of kept elements, text after the root element, and other tags.
# The common first character stands outside the alternatives, so that plain text is passed over quickly.
_MARKUP = (
    rf"(?is)<(?:{_COMMENT_OR_SCRIPT}"
    rf"|({_NAMES})(?:\s[^>]*+)?+>"
    rf"|(/(?:{_NAMES}))\s*+>"
    r"|/html\s*+>[^<]*+\z"
    rf"|[/!?a-z]{_TAG_REST}"
    r"|[/!?a-z].*+\z)"
)
# "<!" always opens markup, so no text holds a mark.
_MARK = " <!$2$3>"
_UPPER_MARK = rf"<!/?+(?=[a-z]*+[A-Z])(?i:{_NAMES})>"
_HIDDEN = rf"(?s)<!(?:({_NAMES})>.*?<!/\1>|/?+[a-z]*+>)"

# Only the group is of interest; comments and scripts are consumed so that what they hold does not count.
_ANCHORS = rf"(?is)<(?:{_COMMENT_OR_SCRIPT}|(a\s{_TAG_REST})|a\s.*+\z)"
_METAS = rf"(?is)<(?:{_COMMENT_OR_SCRIPT}|(meta(?=[\s/>]){_TAG_REST})|meta[\s/].*+\z)"
_HREF = r"""(?is)\shref\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)"""

# Code points 128-159 written as numeric references mean the Windows-1252 characters.
_C1 = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
_C1_FROM = "".join(chr(b) for b in _C1)
_C1_TO = "".join(bytes([b]).decode("cp1252") for b in _C1)

_NAMED = json.dumps({name.rstrip(";"): text for name, text in html5.items()})
# A number of more digits than this, leading zeros aside, is no code point.
_MOST_DIGITS = 9


def valid_text(raw: Column) -> Column:
    """Bytes as text, with the bytes that are not UTF-8 dropped."""
    return F.replace(F.make_valid_utf8(raw.cast("string")), F.lit("\ufffd"), F.lit(""))


def _code_point(number: Column) -> Column:
    usable = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    big_endian = F.unhex(F.lpad(F.hex(F.when(usable, number).otherwise(0xFFFD)), 8, "0"))
    return F.translate(F.decode(big_endian, "UTF-32"), _C1_FROM, _C1_TO)


def _number(digits: Column, base: int) -> Column:
    """Digits as a number, 0 (which is no character) if there are too many of them."""
    return let(F.ltrim(digits, F.lit("0")), lambda d: F.when(F.length(d) <= _MOST_DIGITS, F.conv(F.concat(F.lit("0"), d), base, 10).cast("bigint")).otherwise(0))


def _character(reference: Column) -> Column:
    named = F.try_element_at(F.from_json(F.lit(_NAMED), "map<string,string>"), reference)
    return (
        F.when(reference == "", F.lit(None))
        .when(F.substr(reference, F.lit(1), F.lit(2)).isin("#x", "#X"),
              let(_number(F.substr(reference, F.lit(3)), 16), _code_point))
        .when(F.startswith(reference, F.lit("#")),
              let(_number(F.substr(reference, F.lit(2)), 10), _code_point))
        .otherwise(named)
    )


def _decode_after_ampersand(piece: Column) -> Column:
    reference = F.regexp_extract(piece, r"\A(?:#[0-9]++|#[xX][0-9a-fA-F]++|[a-zA-Z][a-zA-Z0-9]*)", 0)

    def joined(r: Column) -> Column:
        rest = F.regexp_replace(F.substr(piece, F.length(r) + 1), r"\A;", "")
        return F.coalesce(F.concat(_character(r), rest), F.concat(F.lit("&"), piece))

    return let(reference, joined)


def decode_entities(text: Column) -> Column:
    """Character references replaced once: ``&amp;lt;`` becomes ``&lt;``."""
    decoded = F.transform(F.split(text, "&"), lambda p, i: F.when(i == 0, p).otherwise(_decode_after_ampersand(p)))
    return F.array_join(decoded, "")


def squeeze(text: Column) -> Column:
    """Runs of whitespace as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"[\s\x85\xa0]+", " "))


def _lower_marks(text: Column) -> Column:
    for name in _KEPT:
        text = F.regexp_replace(text, f"<!(/?+)(?i:{name})>", f"<!$1{name}>")
    return text


def _without_unclosed(text: Column, name: str) -> Column:
    """Opening marks behind the last closing mark of their name become plain ones."""
    def joined(whole: Column) -> Column:
        tail = F.substring_index(whole, f"<!/{name}>", -1)
        return F.concat(F.left(whole, F.length(whole) - F.length(tail)), F.replace(tail, F.lit(f"<!{name}>"), F.lit("<!>")))

    return let(text, lambda t: F.when(F.contains(t, F.lit(f"<!{name}>")), joined(t)).otherwise(t))


def marked(html: Column) -> Column:
    """The page's text with a mark for each piece of markup.

    Text ahead of the first tag belongs to the document node, which is not shown.
    """
    page = F.when(F.contains(html, F.lit("<")), F.substr(html, F.instr(html, "<"))).otherwise("")
    text = let(F.regexp_replace(page, _MARKUP, _MARK), lambda t: F.when(t.rlike(_UPPER_MARK), _lower_marks(t)).otherwise(t))
    for name in _KEPT:
        text = _without_unclosed(text, name)
    return text


def shown_marked(text: Column) -> Column:
    """Of a marked page: text nodes a reader sees, set apart by blanks, with character references as they are."""
    return F.regexp_replace(text, _HIDDEN, " ")


def shown_source(html: Column) -> Column:
    return shown_marked(marked(html))


def visible_text(html: Column) -> Column:
    """Body text with single blanks."""
    return squeeze(decode_entities(shown_source(html)))


def title_marked(text: Column) -> Column:
    """Of a marked page: text of the first title element with character references as they are, or the empty string."""
    return F.regexp_replace(F.regexp_extract(text, "(?s)<!title>(.*?)<!/title>", 1), "<!/?+[a-z]*+>", " ")


def title_source(html: Column) -> Column:
    return title_marked(marked(html))


def without_decoded_tags(text: Column) -> Column:
    """Text without what looks like a tag only after decoding, which does not go over the end of a line."""
    return F.regexp_replace(text, r"<[^>\n]*+>|(<[^>\n]*+)", "$1")


def title_text(html: Column) -> Column:
    """Text of the first title element, or the empty string."""
    return squeeze(without_decoded_tags(decode_entities(title_source(html))))


def attribute(tag: Column, name: str) -> Column:
    """Value of one attribute of a tag, or the empty string."""
    value = rf"""(?is)\s{name}\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))"""
    return F.concat(*[F.regexp_extract(tag, value, group) for group in (1, 2, 3)])


def _pieces(html: Column, pattern: str) -> Column:
    return F.filter(F.regexp_extract_all(html, F.lit(pattern), F.lit(2)), lambda t: t != "")


def meta_tags(html: Column) -> Column:
    """Array of all meta tags of a page."""
    return _pieces(html, _METAS)


def meta_source(tags: Column, name: str) -> Column:
    """Content of the first of these meta tags that has this name, or the empty string.

    It is taken from ``content``, else from ``value``, with character references as they are.
    """
    tag = F.get(F.filter(tags, lambda t: attribute(t, "name") == name), F.lit(0))
    text = let(tag, lambda t: let(attribute(t, "content"), lambda c: F.when(c != "", c).otherwise(attribute(t, "value"))))
    return F.coalesce(text, F.lit(""))


def meta_text(tags: Column, name: str) -> Column:
    """Content of a meta tag as text with single blanks."""
    return squeeze(decode_entities(meta_source(tags, name)))


def anchor_hrefs(html: Column) -> Column:
    """Array of the href values of all anchors, in page order; anchors without one give no entry."""
    found = F.filter(F.transform(_pieces(html, _ANCHORS), lambda t: F.regexp_extract(t, _HREF, 1)), lambda h: h != "")
    return F.transform(found, lambda h: decode_entities(F.regexp_replace(h, r"""\A["']|["']\z""", "")))
