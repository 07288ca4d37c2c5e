"""Links of pages and what can be reached through them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pageglean.functions import html as H
from pageglean.functions import urls as U
from pageglean.operators.keywords import spread
from pageglean.operators.numbering import numbered
from pageglean.session import materialize, shared_folder

# The answers that make a page worth following.
FOLLOWED_STATUS = (200, 301, 302, 403)


def page_links(pages: DataFrame) -> DataFrame:
    """Pages with the array of their links: ``src_url``, ``hrefs``."""
    return spread(pages.select("url", "html")).select(
        F.col("url").alias("src_url"), H.anchor_hrefs(F.col("html")).alias("hrefs"))


def resolve_links(links: DataFrame) -> DataFrame:
    """The links in the array ``hrefs`` as rows with ``dst_url``, an absolute URL without query and fragment.

    Left out: empty links, links with whitespace, and links that do not lead to a web page on some host. All of it
    happens inside the array, so a link is resolved once and only kept links become rows.
    """
    present = F.filter("hrefs", lambda h: h.isNotNull() & (h != ""))
    on_web = F.filter(U.targets(F.col("src_url"), present),
                      lambda t: t["scheme"].isin(*U.WEB_SCHEMES) & (t["host"] != ""))
    found = F.filter(F.transform(on_web, U.target_page), lambda u: ~U.has_whitespace(u))
    others = [c for c in links.columns if c != "hrefs"]
    return links.select(*others, F.explode(found).alias("dst_url"))


def skip_paths(links: DataFrame, extra: str = "", column: str = "dst_url") -> DataFrame:
    """Without links below the skipped path segments; ``extra`` is a comma list of further segments."""
    more = [s for s in extra.replace("'", "").split(",") if s]
    return links.filter(~U.in_skipped_path(F.col(column), [*U.SKIPPED_SEGMENTS, *more]))


def add_kind(links: DataFrame, seed_host: str, strict: bool = False, column: str = "dst_url") -> DataFrame:
    """Adds ``kind``: whether the link stays on the seed's site."""
    return links.withColumn("kind", U.link_kind(U.authority(F.col(column)), seed_host, strict))


def extract_links(pages: DataFrame, seed_url: str, extra_skipped: str = "", strict: bool = False) -> DataFrame:
    """Distinct links of the pages, ready to follow: ``src_url``, ``dst_url``, ``kind``.

    Internal links are put under the scheme and host of the seed, and so are the pages they stand on.
    """
    seed_scheme, seed_host = U.seed_parts(seed_url)
    links = add_kind(skip_paths(resolve_links(page_links(pages)), extra_skipped), seed_host, strict)
    unified = F.when(F.col("kind") == "internal", U.unify_host(F.col("dst_url"), seed_scheme, seed_host))
    source = U.normalize(F.col("src_url"))
    own = F.when(U.link_kind(U.authority(source), seed_host, strict) == "internal",
                 U.unify_host(source, seed_scheme, seed_host)).otherwise(source)
    return links.select(own.alias("src_url"), F.coalesce(unified, F.col("dst_url")).alias("dst_url"), "kind").distinct()


def link_totals(links: DataFrame) -> DataFrame:
    """Number of distinct linked URLs, by kind and in all."""
    kinds = links.select("dst_url", "kind").distinct().groupBy("kind").agg(F.count(F.lit(1)).alias("links"))
    return kinds.unionByName(kinds.agg(F.lit("total").alias("kind"),
                                       F.coalesce(F.sum("links"), F.lit(0)).alias("links")))


def fetchable(fetch_log: DataFrame, statuses: Sequence[int] = FOLLOWED_STATUS) -> DataFrame:
    """Fetched URLs that answered with a page."""
    return fetch_log.filter(F.col("status").isin(*statuses) & F.contains(F.col("content_type"), F.lit("html")))


def _append(rows: DataFrame, table: str, buckets: int, column: str) -> int:
    """Adds rows to a table in the shared folder that is stored in buckets; how many there were comes from the write itself."""
    written = Observation()
    path = f"{shared_folder(rows.sparkSession)}/{table}"
    counted = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("append").bucketBy(buckets, column).option("path", path).saveAsTable(table)
    return written.get["rows"]


def site_closure(links: DataFrame, seeds: DataFrame, max_depth: int | None = None, buckets: int | None = None) -> DataFrame:
    """URLs reachable from the seeds over ``src_url`` → ``dst_url``, with the number of steps: ``url``, ``depth``.

    A seed is in the result only where a link leads back to it. The links are stored once, bucketed by the page they stand
    on, and the URLs reached so far in a table bucketed alike by URL, where a file holds URLs of one depth. A round joins the
    newest URLs with the edges bucket by bucket, shuffles the targets (reduced to one row each on the map side), takes out
    what is known bucket by bucket, and adds the rest. How many there are comes from that write. So the shuffle of the
    targets and the write are the jobs of a round, and it moves neither edges nor known URLs.

    The tables lie in the shared folder and stay for as long as the result is in use.
    """
    spark = links.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"closure_{uuid.uuid4().hex}"
    edges, urls = f"{name}_edges", f"{name}_urls"
    _append(links.select("src_url", "dst_url").distinct().repartition(buckets, "src_url"), edges, buckets, "src_url")
    rows = _append(seeds.select("url", F.lit(0).alias("depth")).distinct().repartition(buckets, "url"), urls, buckets, "url")
    depth = 0
    while rows and (max_depth is None or depth < max_depth):
        depth += 1
        newest = spark.table(urls).filter(F.col("depth") == depth - 1).select(F.col("url").alias("src_url"))
        known = spark.table(urls).filter(F.col("depth") > 0).select("url")
        # Both sides of either join are dealt by the URL already, so they are merged where they lie.
        found = spark.table(edges).join(newest.hint("merge"), "src_url", "left_semi").select(F.col("dst_url").alias("url")).distinct()
        fresh = found.join(known.hint("merge"), "url", "left_anti")
        rows = _append(fresh.select("url", F.lit(depth).alias("depth")), urls, buckets, "url")
    return spark.table(urls).filter(F.col("depth") > 0)


def distinct_urls(urls: DataFrame, column: str = "page_url") -> DataFrame:
    """URL list without missing values and repeats."""
    return urls.select(column).na.drop(subset=[column]).distinct()


def url_parts(urls: DataFrame, rows: int = 2500, column: str = "page_url") -> DataFrame:
    """Distinct URLs in order with the number of the part they belong to, ``rows`` URLs to a part.

    A URL's number is its place in its range of URLs plus the sizes of the ranges before, so a task sees one range, and there
    are as many ranges as the data need.
    """
    # Ranges are sampled from the table first, so it is stored.
    stored = materialize(distinct_urls(urls, column))
    return numbered(stored, column).select(column, F.floor(F.col("number") / rows).alias("part"))


def part_sizes(parts: DataFrame) -> DataFrame:
    """Number of URLs in each part."""
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("urls"))
