"""The five jobs, from the pages of a site to the published files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pageglean.functions import text as X
from pageglean.functions import urls as U
from pageglean.operators import keywords as K
from pageglean.operators import links as L
from pageglean.operators import mart as M
from pageglean.operators import segments as G
from pageglean.operators.joins import fits_broadcast
from pageglean.sources import files
from pageglean.sources.store import Change, Snapshot, Store
from pageglean.session import materialize


def site_urls(pages: DataFrame, seed_url: str, skipped: str = "", fetch_log: DataFrame | None = None,
              strict: bool = False, max_depth: int | None = None) -> DataFrame:
    """Internal URLs that can be reached from the seed, with the number of steps: ``page_url``, ``depth``."""
    seed_scheme, seed_host = U.seed_parts(seed_url)
    links = L.extract_links(pages, seed_url, skipped, strict).filter("kind = 'internal'")
    if fetch_log is not None:
        answered = L.fetchable(fetch_log).select(
            U.unify_host(F.col("url"), seed_scheme, seed_host).alias("dst_url")).distinct()
        links = links.join(answered, "dst_url", "left_semi")
    seed = pages.sparkSession.range(1).select(U.unify_host(U.default_scheme(F.lit(seed_url)), seed_scheme, seed_host).alias("url"))
    return L.site_closure(links, seed, max_depth).select(F.col("url").alias("page_url"), "depth")


def crawl(pages: DataFrame, seed_url: str, out: str, run_date: str, **options) -> str:
    """Job 1: the site's URL list as numbered parts below ``out/<run date>``."""
    folder = f"{out}/{run_date}"
    files.write_url_parts(site_urls(pages, seed_url, **options), folder)
    return folder


MART = ("contains", "site", "site_category")


def purge(store: Store, urls: DataFrame | None, domain: str, run: str) -> dict[str, int]:
    """Job 2: forgets the keywords of these URLs and everything the mart has on the domain; gives the rows removed.

    The keyword store and the mart's tables change together. What is removed is what was read less what was written, both
    counted by the rewrite itself.
    """
    before, changes = store.snapshot(), {}
    if urls is not None:
        keys = urls.select("page_url", store.bucket_of_url(F.col("page_url")).alias("bucket"))
        touched = store.touched(keys)
        if touched:
            changes["keyword_store"] = Change(M.store_purge(store.read("keyword_store", touched, at=before), keys), touched)
    buckets = _domain_buckets(store, domain, before)
    read = {table: Observation() for table in MART}
    if buckets:
        changes |= _without_domain(store, domain, buckets, before, read)
    written = store.change(run, changes, before) if changes else {}
    return {table: read[table].get["rows"] - written[table] if table in written else 0 for table in MART}


def _domain_buckets(store: Store, domain: str, at: Snapshot) -> list[int]:
    """Buckets that hold rows of the domain. The facts of a page are in the bucket of its site."""
    named = store.read("site_category", at=at).filter(F.col("domain") == domain)
    return store.touched(M.sites_of(store.read("site", at=at), domain).select("bucket").unionByName(named.select("bucket")))


def _without_domain(store: Store, domain: str, buckets: list[int], at: Snapshot, read: Mapping[str, Observation] | None = None,
                    new: Mapping[str, DataFrame] | None = None) -> dict[str, Change]:
    """The three mart tables without the domain's rows, and with the new ones; ``read`` counts what they hold now."""
    tables = {table: store.read(table, buckets, at=at) for table in MART}
    site = tables["site"]
    if read is not None:
        tables = {table: rows.observe(read[table], F.count(F.lit(1)).alias("rows")) for table, rows in tables.items()}
    kept = {
        "contains": M.purge_contains(tables["contains"], site, domain),
        "site": M.purge_site(tables["site"], domain),
        "site_category": M.purge_site_category(tables["site_category"], domain),
    }
    return {table: Change(M.replace_slice(rows, new[table]) if new else rows, buckets) for table, rows in kept.items()}


def classify(store: Store, urls: DataFrame, pages: DataFrame, keywords: DataFrame, segment: DataFrame,
             custom_segments: DataFrame, run_date: str, run: str, channels: DataFrame | None = None,
             stop_words: Sequence[str] = X.STOP_WORDS) -> dict[str, int]:
    """Job 3: counts keywords on the listed pages, keeps them in the keyword store and enters them into the mart.

    Gives the rows written to each table.

    With ``channels`` only pages that pass the channel gate are classified. A listed URL means the page of ``M.listed_pages``,
    whose counts are kept under the URL as listed.
    """
    listed = L.distinct_urls(urls)
    wanted = listed.select(U.default_scheme(F.col("page_url")).alias("url")).distinct()
    if channels is not None:
        gate = M.gated_urls(channels).select(U.page_key(F.col("url")).alias("page_key"))
        wanted = wanted.withColumn("page_key", U.page_key(F.col("url"))).join(gate, "page_key", "left_semi").select("url")
    # One page may be meant by several listed URLs; it is parsed once. Used three times, so stored once.
    chosen = materialize(M.listed_pages(pages, wanted))
    vocab = materialize(K.vocabulary(keywords))
    # Pages that are not chosen but pass the filter are dropped by the join below, which moves counts and no page.
    shown = M.likely_pages(pages, chosen, "url", "page_id")
    counted = K.classify_pages(shown, vocab, stop_words, small=fits_broadcast(vocab))
    # The counts feed the store and the mart, so they are stored once instead of parsing the pages for each.
    counts = materialize(counted.join(chosen, ["url", "page_id"]).select(F.col("listed").alias("page_url"), "keyword", "points"))

    scraped = chosen.select(F.col("listed").alias("page_url"))
    maps = scraped.join(K.keyword_map(counts, ("page_url",)), "page_url", "left")
    fresh = maps.select(
        "page_url", F.coalesce("keywords", F.create_map().cast("map<string,bigint>")).alias("keywords"),
        store.bucket_of_url(F.col("page_url")).alias("bucket"))
    # All tables are changed together, from one state to the next.
    before = store.snapshot()
    stored = store.touched(fresh)
    listed_sites = M.build_site(listed, run_date).withColumn("bucket", store.bucket_of_url(F.col("page_url")))
    buckets = store.touched(listed_sites)
    known = store.read("site", buckets, at=before)
    # Written, and looked up for facts and categories.
    added = materialize(M.new_rows(known, listed_sites, M.SITE_KEY))

    # A page listed both with and without a scheme is two sites; the counts carry the full URL.
    site = known.unionByName(added).select("site_id", U.default_scheme(F.col("page_url")).alias("page_url"), "bucket")
    facts = M.build_contains(counts, keywords, site, carried=["bucket"]).withColumns({
        "fact_id": M.surrogate("site_id", "keyword_id"), "current_dates": F.lit(run_date).cast("date")})
    pairs = M.first_segment(M.keyword_segments(keywords, segment, custom_segments))
    categories = M.build_site_category(counts, pairs, site, run_date).withColumns({
        "s_c_id": M.surrogate("site_id", "custom_segment_name"), "bucket": store.bucket_of(F.col("domain"))})
    old = store.read("site_category", buckets, at=before)
    changes = {
        "site": Change(added),
        "contains": Change(M.new_rows(store.read("contains", buckets, at=before), facts, M.CONTAINS_KEY)),
        "site_category": Change(M.upsert_date(old, categories.select(*old.columns), M.CATEGORY_KEY), buckets),
    }
    if stored:
        changes["keyword_store"] = Change(M.store_upsert(store.read("keyword_store", stored, at=before), fresh), stored)
    return store.change(run, changes, before)


def refresh_warehouse(store: Store, warehouse: Store, exports: str, domain: str, run_date: str, run: str) -> dict[str, int]:
    """Job 4: exports one domain and day of the mart and replaces the domain in the warehouse; gives the rows exported.

    Nothing is replaced, and nothing given, when the day has no pages of the domain. Sites and categories of other months are
    not read.
    """
    spark, at = store.spark, store.snapshot()
    day_sites = store.read("site", day=run_date, at=at)
    buckets = store.touched(M.sites_of(day_sites, domain))
    site = store.read("site", buckets, run_date, at)
    # The facts of a page may be older than its last day.
    contains, category = store.read("contains", buckets, at=at), store.read("site_category", day=run_date, at=at)
    tables = {
        "site": M.export_site(site, domain, run_date),
        "contains": M.export_contains(contains, site, domain, run_date),
        "site_category": M.export_site_category(category, domain, run_date),
    }
    exported = {name: files.write_export(rows, f"{exports}/{name}") for name, rows in tables.items()}
    if not exported["site"]:
        return {}
    new_site = files.read_export(spark, f"{exports}/site", "site_id bigint, page_url string, last_scrapped_date date")
    day = F.lit(run_date).cast("date").alias("current_dates")
    new_site = new_site.select("*", day, warehouse.bucket_of_url(F.col("page_url")).alias("bucket"))
    new_contains = files.read_export(
        spark, f"{exports}/contains", "fact_id bigint, site_id bigint, keyword_id bigint, points int").select("*", day)
    new_category = files.read_export(
        spark, f"{exports}/site_category", "s_c_id bigint, site_id bigint, domain string, custom_segment_name string")
    new = {
        "contains": new_contains.join(new_site.select("site_id", "bucket"), "site_id"),
        "site": new_site,
        "site_category": new_category.select("*", day, warehouse.bucket_of(F.col("domain")).alias("bucket")),
    }
    before = warehouse.snapshot()
    touched = {*_domain_buckets(warehouse, domain, before), *warehouse.touched(new_site), *warehouse.touched(new["site_category"])}
    warehouse.change(run, _without_domain(warehouse, domain, sorted(touched), before, new=new), before)
    return exported


def publish_flags(warehouse: Store, keywords: DataFrame, segment: DataFrame, custom_segments: DataFrame, out: str,
                  domain: str, run_date: str, id_list: str = "[]") -> None:
    """Job 5: segment results of the domain, and from them the checked rollup and the page-to-categories file.

    All segments are computed at once. The results of this run are stored and read back for the two files.
    """
    spark = warehouse.spark
    label = files.label_of(domain)
    wanted = G.only_ids(custom_segments, id_list)
    at = warehouse.snapshot()
    buckets = warehouse.touched(M.sites_of(warehouse.read("site", at=at), domain))
    site = M.sites_of(warehouse.read("site", buckets, at=at), domain)
    facts = M.contains_of(warehouse.read("contains", buckets, at=at), site)
    rows = G.segment_rows(facts.drop("bucket", "current_dates"), site.drop("bucket"), keywords, segment, wanted)
    files.drop_expired(spark, f"{out}/results", run_date)
    results = f"{out}/results/run_date={run_date}/{label}"
    files.write_results(rows, results)
    qa = G.qa_filter(G.qa_rollup(files.read_results(spark, results)))
    files.publish(qa, f"{out}/flag_cust_segment_{label}_qa")
    published = files.read_published(spark, f"{out}/flag_cust_segment_{label}_qa", files.QA_SCHEMA)
    files.publish(G.final_rollup(published), f"{out}/flag_cust_segment_{label}_final")
