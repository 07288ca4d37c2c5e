"""Column expressions over URL text.

Parts are cut with the generic URI grammar, not with a validating parser: links found on pages often hold characters
that a validating parser refuses, and a refused link would be lost.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageglean.functions.bind import let

_SCHEME = r"[a-zA-Z][a-zA-Z0-9+.\-]*"

# Blanks and control characters, which do not count at the start of a link.
_BLANKS = "".join(map(chr, range(0x21)))

# The URL schemes that name web pages, and the path segments never followed.
WEB_SCHEMES = ("http", "https")
SKIPPED_SEGMENTS = ("forums", "newsletter")


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, rf"\A({_SCHEME}):", 1))


def authority(url: Column) -> Column:
    """Host with user and port, as written."""
    return F.regexp_extract(url, rf"\A(?:{_SCHEME}:)?//([^/?#]*)", 1)


def path(url: Column) -> Column:
    """Path without the parameters of its last segment."""
    return F.regexp_replace(full_path(url), r";[^/]*\z", "")


def full_path(url: Column) -> Column:
    return F.regexp_extract(url, rf"\A(?:{_SCHEME}:)?(?://[^/?#]*)?([^?#]*)", 1)


def default_scheme(url: Column, wanted: str = "http") -> Column:
    """URL with a scheme put in front where it has none."""
    return F.when(scheme(url) == "", F.concat(F.lit(f"{wanted}://"), url)).otherwise(url)


def seed_parts(seed: str) -> tuple[str, str]:
    """Scheme and host of a seed URL; the scheme is http where it has none."""
    found = re.match(rf"(?:({_SCHEME})://|//)?([^/?#]*)", seed)
    return (found[1] or "http").lower(), found[2]


def is_valid(url: Column) -> Column:
    """Has both a scheme and a host."""
    return (scheme(url) != "") & (authority(url) != "")


def rebuild(scheme_: Column, authority_: Column, path_: Column) -> Column:
    """URL of these parts without slashes at its ends."""
    return F.btrim(F.concat(scheme_, F.lit("://"), authority_, path_), F.lit("/"))


def normalize(url: Column) -> Column:
    """``scheme://host/path`` without parameters, query, fragment and outer slashes."""
    return rebuild(scheme(url), authority(url), path(url))


def query(url: Column) -> Column:
    """Query without its mark, empty where there is none."""
    return F.regexp_extract(url, r"\A[^?#]*\?([^#]*)", 1)


def page_key(url: Column) -> Column:
    """What pages are told apart by: host without ``www.``, and path without parameters and outer slashes."""
    def key(full: Column) -> Column:
        return F.btrim(F.concat(F.regexp_replace(F.lower(authority(full)), r"\Awww\.", ""), path(full)), F.lit("/"))

    return let(default_scheme(F.trim(url)), key)


def unify_host(url: Column, seed_scheme: str, seed_host: str) -> Column:
    """The same page under the scheme and host of the seed."""
    return rebuild(F.lit(seed_scheme), F.lit(seed_host), path(url))


# Scheme, host, path, query with its mark and fragment with its mark, cut by one match and put on lines of their own.
_URL = rf"(?s)\A(?:({_SCHEME}):)?(?://([^/?#]*+))?([^?#]*+)(\?[^#]++)?\??(#.++)?#?\z"
_LINES = "$1\n$2\n$3\n$4\n$5"


def _with_parts(url: Column, use) -> Column:
    """``use`` of a URL's parts: an array of scheme, host, path, query and fragment, the last two with their marks.

    Line breaks and tabs inside a URL do not count.
    """
    return let(F.split(F.regexp_replace(F.translate(url, "\t\r\n", ""), _URL, _LINES), "\n"), use)


def _without_dot_segments(path_: Column) -> Column:
    def folded(segments: Column) -> Column:
        kept = F.aggregate(
            segments,
            F.array().cast("array<string>"),
            lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
            .when(s == ".", done)
            .otherwise(F.concat(done, F.array(s))),
        )
        ends_in_dots = F.element_at(segments, -1).isin(".", "..")
        return F.concat(F.array_join(kept, "/"), F.when(ends_in_dots & (F.size(kept) > 0), "/").otherwise(""))

    dotted = F.contains(path_, F.lit("/.")) | F.startswith(path_, F.lit("."))
    return F.when(dotted, let(F.split(path_, "/"), folded)).otherwise(path_)


def _target(base: Column, folder: Column, link: Column) -> Column:
    """Where a link on a page leads, in parts; page and link are given in parts too."""
    scheme_, host, path_, query, fragment = (link[i] for i in range(5))
    elsewhere = (scheme_ != "") & (F.lower(scheme_) != F.lower(base[0]))
    own_host = elsewhere | (host != "")
    beside = F.regexp_replace(F.concat(folder, path_), "/{2,}", "/")
    place = F.when(F.startswith(path_, F.lit("/")), path_).otherwise(beside)
    merged = let(let(place, _without_dot_segments),
                 lambda p: F.when(F.startswith(p, F.lit("/")), p).otherwise(F.concat(F.lit("/"), p)))
    same_page = (path_ == "") & ~own_host
    return F.struct(
        F.lower(F.when(scheme_ != "", scheme_).otherwise(base[0])).alias("scheme"),
        F.when(own_host, host).otherwise(base[1]).alias("host"),
        F.when(own_host, path_).when(same_page, base[2]).otherwise(merged).alias("path"),
        F.when(same_page & (query == ""), base[3]).otherwise(query).alias("query"),
        fragment.alias("fragment"),
    )


def targets(base: Column, hrefs: Column) -> Column:
    """Where the links of one page lead: an array of scheme, host, path, query and fragment, in the links' order.

    A link with a host keeps its path as written. A path relative to the page loses doubled slashes and dot segments. The
    page's own URL is cut up once, and each link once.
    """
    def on_page(page: Column) -> Column:
        return let(F.regexp_replace(page[2], r"[^/]*+\z", ""), lambda folder: F.transform(
            hrefs, lambda h: _with_parts(F.ltrim(h, F.lit(_BLANKS)), lambda link: _target(page, folder, link))))

    return _with_parts(base, on_page)


def target_text(target: Column) -> Column:
    """A target as URL text."""
    host = F.when(target["host"] != "", F.concat(F.lit("//"), target["host"])).otherwise("")
    return F.concat(target["scheme"], F.lit(":"), host, target["path"], target["query"], target["fragment"])


def target_page(target: Column) -> Column:
    """A target without parameters, query, fragment and outer slashes."""
    plain = F.when(F.contains(target["path"], F.lit(";")), F.regexp_replace(target["path"], r";[^/]*\z", ""))
    return rebuild(target["scheme"], target["host"], F.coalesce(plain, target["path"]))


def resolve(base: Column, href: Column) -> Column:
    """One link of a page as an absolute URL; an empty link is the page itself."""
    found = let(F.get(targets(base, F.array(href)), F.lit(0)), target_text)
    return F.when(href == "", base).otherwise(found)


def has_whitespace(url: Column) -> Column:
    return url.rlike(r"\s")


def in_skipped_path(url: Column, skipped: Sequence[str] = SKIPPED_SEGMENTS) -> Column:
    """One of the path segments other than the last is on the skip list."""
    segments = F.split(path(url), "/")
    folders = F.slice(segments, F.lit(1), F.size(segments) - 1)
    return F.coalesce(F.arrays_overlap(folders, F.array(*[F.lit(s) for s in skipped])), F.lit(False))


def link_kind(host: Column, seed_host: str, strict: bool = False) -> Column:
    """``internal`` or ``external``, by host.

    The default takes either host being part of the other as the same site; ``strict`` takes only the seed host and
    its subdomains.
    """
    seed = F.lit(seed_host)
    if strict:
        same_site = (host == seed) | F.endswith(host, F.lit("." + seed_host))
    else:
        same_site = F.contains(host, seed) | F.contains(seed, host)
    return F.when(same_site, "internal").otherwise("external")


def domain_label(domain: Column) -> Column:
    """Domain as it appears in file names."""
    return F.replace(domain, F.lit("."), F.lit("_"))
