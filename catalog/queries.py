"""The registered queries: each one runs an operator over whole tables and gives plain columns back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import inputs as I
from pageglean.functions import html as H
from pageglean.functions import segments as S
from pageglean.functions import urls as U
from pageglean.operators import keywords as K
from pageglean.operators import links as L
from pageglean.operators import mart as M
from pageglean.operators import segments as G
from pageglean.sources import files


def _day(column: str):
    return F.col(column).cast("string").alias(column)


def _odd(df: DataFrame, column: str = "site_id") -> DataFrame:
    """What a table held before a change, so that the change meets known keys and new ones."""
    return df.filter(F.col(column) % 2 == 1)


def _map_text(column: str):
    return F.array_join(F.transform(F.map_entries(column), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


# ---- page text and keywords -----------------------------------------------------------------------------------------

def title_text(spark, sf):
    return I.pages(spark, sf).select("page_id", H.title_text(F.col("html")).alias("title"))


def visible_text(spark, sf):
    return K.spread(I.pages(spark, sf)).select("page_id", H.visible_text(F.col("html")).alias("body"))


def meta_text(spark, sf):
    tags = I.described_pages(spark, sf).select("page_id", H.meta_tags(F.col("html")).alias("tags"))
    return tags.select("page_id", H.meta_text(F.col("tags"), "keywords").alias("keywords"),
                       H.meta_text(F.col("tags"), "description").alias("description"))


def valid_text(spark, sf):
    return I.broken_text(spark, sf).select("doc_id", H.valid_text(F.col("raw")).alias("text"))


def decode_references(spark, sf):
    """Texts behind a decimal, two named, a hexadecimal, an impossible and an unknown reference."""
    letter = F.col("doc_id") % 26
    references = F.concat(F.lit("&#"), F.lpad((letter + 65).cast("string"), 13, "0"), F.lit(";&apos;&check;&#x"),
                          F.lpad(F.hex(letter + 97), 12, "0"), F.lit(";&#99999999999999999999;&none;"))
    known = I.table(spark, sf, "documents").filter("text IS NOT NULL")
    return known.select("doc_id", F.concat(H.decode_entities(references), H.decode_entities(F.replace("text", F.lit("&"), F.lit("&amp;")))).alias("text"))


def _tokens(spark, sf):
    return K.field_tokens(K.page_fields(I.described_pages(spark, sf)))


def _vocabulary(spark, sf):
    return K.vocabulary(I.text_keywords(spark, sf))


def _matches(spark, sf):
    return K.phrase_matches(_tokens(spark, sf), _vocabulary(spark, sf))


def _counts(spark, sf):
    return K.keyword_counts(_matches(spark, sf))


def tokens(spark, sf):
    return K.token_rows(_tokens(spark, sf)).select("page_id", "field", F.col("pos").cast("bigint").alias("pos"), "token")


def vocabulary(spark, sf):
    return _vocabulary(spark, sf)


def phrase_match(spark, sf):
    return _matches(spark, sf).select("page_id", "field", F.col("pos").cast("bigint").alias("pos"), "keyword")


def keyword_counts(spark, sf):
    return _counts(spark, sf).select("url", "keyword", "points")


def keyword_counts_min(spark, sf):
    return K.keyword_counts(_matches(spark, sf), at_least=5).select("url", "keyword", "points")


def keyword_map(spark, sf):
    return K.keyword_map(_counts(spark, sf), ("page_id", "url")).select("url", _map_text("keywords").alias("keywords"))


def explode_keyword_map(spark, sf):
    return K.explode_keyword_map(I.keyword_store(spark, sf)).select("page_url", "keyword", "points")


def terms_not_in_vocabulary(spark, sf):
    return K.terms_not_in_vocabulary(_tokens(spark, sf), _vocabulary(spark, sf)).select("page_id", "term")


# ---- URLs and links -------------------------------------------------------------------------------------------------

def url_parts_of(spark, sf):
    url = F.col("url")
    return I.pages(spark, sf).select("url", U.scheme(url).alias("scheme"), U.authority(url).alias("host"), U.path(url).alias("path"))


def normalize_url(spark, sf):
    return I.pages(spark, sf).select("url", U.normalize(F.col("url")).alias("normalized"))


def default_scheme(spark, sf):
    bare = F.when(F.col("page_id") % 2 == 0, F.regexp_replace("url", "^[a-z]+://", "")).otherwise(F.col("url"))
    return I.pages(spark, sf).select(bare.alias("given")).select("given", U.default_scheme(F.col("given")).alias("url"))


def valid_urls(spark, sf):
    return I.hrefs(spark, sf).filter(U.is_valid(F.col("href"))).select("o_orderkey", "href")


def _href_lists(spark, sf):
    return K.spread(I.hrefs(spark, sf)).select("o_orderkey", "src_url", F.array("href").alias("hrefs"))


def resolve_links(spark, sf):
    return L.resolve_links(_href_lists(spark, sf)).select("o_orderkey", "dst_url")


def join_urls(spark, sf):
    joined = U.resolve(F.col("src_url"), F.coalesce("href", F.lit("")))
    return I.hrefs(spark, sf).select("o_orderkey", joined.alias("url"))


def skip_path_filter(spark, sf):
    links = L.resolve_links(_href_lists(spark, sf))
    return L.skip_paths(links, extra="'a',p").select("o_orderkey", "dst_url")


def extract_links(spark, sf):
    return L.extract_links(I.pages(spark, sf), I.SEED)


def link_kind(spark, sf):
    hosts = I.pages(spark, sf).select(U.authority(F.col("url")).alias("host")).distinct()
    return hosts.select("host", U.link_kind(F.col("host"), I.SEED_HOST).alias("kind"),
                        U.link_kind(F.col("host"), I.SEED_HOST, strict=True).alias("strict_kind"))


def unify_host(spark, sf):
    return I.pages(spark, sf).select("url", U.unify_host(F.col("url"), "https", "www.example.net").alias("unified"))


def link_totals(spark, sf):
    return L.link_totals(L.extract_links(I.pages(spark, sf), I.SEED))


def fetchable_pages(spark, sf):
    return L.fetchable(I.fetch_log(spark, sf))


def site_closure(spark, sf):
    start = I.pages(spark, sf).agg(F.min_by("url", "page_id").alias("url"))
    return L.site_closure(I.page_graph(spark, sf), start)


def url_dedup(spark, sf):
    return L.distinct_urls(I.url_list(spark, sf))


def url_parts(spark, sf):
    return L.url_parts(I.url_list(spark, sf)).select("page_url", F.col("part").cast("bigint").alias("part"))


def url_part_sizes(spark, sf):
    return L.part_sizes(url_parts(spark, sf))


def url_file_report(spark, sf):
    """Good and bad lines of each URL file."""
    folder = I.url_files(spark, sf)
    # A file of the list 3 lies below "list=3".
    lines = files.scan_urls(spark, folder).withColumn("list", F.regexp_extract("file", "/list=([0-9]+)/", 1).cast("int"))
    return files.scan_report(lines, "list")


def domain_label(spark, sf):
    hosts = I.pages(spark, sf).select(U.authority(F.col("url")).alias("host")).distinct()
    return hosts.select("host", U.domain_label(F.col("host")).alias("label"))


# ---- mart -----------------------------------------------------------------------------------------------------------

def keyword_segments(spark, sf):
    return M.keyword_segments(I.named_keywords(spark, sf), I.segment(spark, sf), I.custom_segments(spark, sf))


def keyword_first_segment(spark, sf):
    return M.first_segment(keyword_segments(spark, sf))


def segment_clean_name(spark, sf):
    kinds = [*S.NAME_PREFIXES, S.NAME_PREFIXES[-1] + "DTC ", S.NAME_PREFIXES[-1] + "MF ", ""]
    prefixes = F.array(*[F.lit(p) for p in kinds])
    raw = F.concat(F.get(prefixes, (F.col("p_partkey") % 6).cast("int")), "p_name", F.lit(", "), "p_type")
    return I.table(spark, sf, "part").select("p_partkey", S.clean_name(raw).alias("name"))


def _page_counts(spark, sf):
    return _counts(spark, sf).select(F.col("url").alias("page_url"), "keyword", "points")


def build_contains(spark, sf):
    return M.build_contains(_page_counts(spark, sf), I.text_keywords(spark, sf), I.page_site(spark, sf))


def build_site_category(spark, sf):
    pairs = M.keyword_segments(I.text_keywords(spark, sf), I.text_segment(spark, sf), I.custom_segments(spark, sf))
    lowered = pairs.select(F.trim(F.lower("keyword")).alias("keyword"), "name")
    rows = M.build_site_category(_page_counts(spark, sf), M.first_segment(lowered), I.page_site(spark, sf), I.RUN_DATE)
    return rows.select("site_id", "domain", "custom_segment_name", _day("current_dates"))


def page_flags(spark, sf):
    """From pages to the published categories of each page."""
    keywords = M.keyword_ids(I.text_keywords(spark, sf)).select(F.col("keyword_id").alias("id"), "keyword")
    site = I.page_site(spark, sf)
    facts = M.build_contains(_page_counts(spark, sf), keywords, site)
    rows = G.segment_rows(facts, site, keywords, I.text_segment(spark, sf), I.custom_segments(spark, sf))
    return G.publishable(G.final_rollup(G.qa_filter(G.qa_rollup(rows))))


def page_keyword_map_lookup(spark, sf):
    found = M.page_lookup(I.listed_sites(spark, sf), I.keyword_store(spark, sf))
    return found.select("page_url", "state", F.coalesce(_map_text("keywords"), F.lit("")).alias("keywords"))


def unclassified_pages(spark, sf):
    return M.unclassified(I.listed_sites(spark, sf), I.keyword_store(spark, sf))


def channel_gate(spark, sf):
    pages = I.pages(spark, sf).select("page_id", "url")
    return M.restrict_pages(pages, M.gated_urls(I.channels(spark, sf)))


def _later(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.lit(I.NEXT_DATE).cast("date") for c in columns})


def insert_ignore_site(spark, sf):
    site = I.site(spark, sf)
    after = M.insert_ignore(_odd(site), _later(site, "last_scrapped_date", "current_dates"), M.SITE_KEY)
    return after.select("site_id", "page_url", _day("last_scrapped_date"), _day("current_dates"))


def insert_ignore_contains(spark, sf):
    facts = I.contains(spark, sf)
    after = M.insert_ignore(_odd(facts), _later(facts, "current_dates").withColumn("points", F.col("points") + 1), M.CONTAINS_KEY)
    return after.select("site_id", "keyword_id", "points", _day("current_dates"))


def upsert_site_category(spark, sf):
    rows = I.site_category(spark, sf)
    later = _later(rows.filter(F.col("site_id") % 3 != 0), "current_dates").withColumn("domain", F.lit("new.example.com"))
    after = M.upsert_date(_odd(rows), later, M.CATEGORY_KEY)
    return after.select("site_id", "domain", "custom_segment_name", _day("current_dates"))


def _store_rows(spark, sf):
    return K.explode_keyword_map(I.keyword_store(spark, sf)).select("page_url", "keyword", "points")


def _even_page(column: str = "page_url"):
    """Pages of a new run, told by the end of their URL."""
    return F.substring(F.col(column), -1, 1).isin("0", "2", "4", "6", "8")


def keyword_store_upsert(spark, sf):
    store = I.keyword_store(spark, sf)
    fresh = store.filter(_even_page()).withColumn("keywords", F.transform_values("keywords", lambda k, v: v * 10))
    after = M.store_upsert(store.filter(~F.endswith("page_url", F.lit("8"))), fresh)
    return K.explode_keyword_map(after).select("page_url", "keyword", "points")


def keyword_store_purge(spark, sf):
    store = I.keyword_store(spark, sf)
    return K.explode_keyword_map(M.store_purge(store, I.site(spark, sf).filter(_even_page()))).select("page_url", "keyword", "points")


# ---- segment results ------------------------------------------------------------------------------------------------

def active_segments(spark, sf):
    return G.active_segments(I.segment(spark, sf), I.custom_segments(spark, sf))


def segment_lookup(spark, sf):
    return G.segment_lookup(active_segments(spark, sf), I.custom_segments(spark, sf)).select(
        F.col("id"), F.col("threshold").cast("bigint").alias("threshold"), "name")


def id_list_filter(spark, sf):
    bridged = I.segment(spark, sf)
    wanted = G.only_ids(I.custom_segments(spark, sf), "[2, 4]").select(F.col("id").alias("custom_segment_id"))
    return bridged.join(F.broadcast(wanted), "custom_segment_id").select("keyword_id", "custom_segment_id")


def _result_inputs(spark, sf):
    return (I.contains(spark, sf), I.site(spark, sf), I.keywords(spark, sf), I.segment(spark, sf), I.custom_segments(spark, sf))


def segment_scores(spark, sf):
    return G.segment_scores(*_result_inputs(spark, sf))


def segment_union(spark, sf):
    rows = G.segment_rows(*_result_inputs(spark, sf))
    by_audience = [rows.filter(S.value_type(F.col("category")) == kind) for kind in S.KEYWORDS_NEEDED]
    return G.stack([by_audience[0], by_audience[1].drop("flag")])


def _qa(spark, sf):
    return G.qa_rollup(G.segment_rows(*_result_inputs(spark, sf)))


def qa_rollup(spark, sf):
    return _qa(spark, sf)


def qa_filter(spark, sf):
    return G.qa_filter(_qa(spark, sf))


def final_rollup(spark, sf):
    return G.final_rollup(G.qa_filter(_qa(spark, sf)))


def publish_qa(spark, sf):
    return G.publishable(G.qa_filter(_qa(spark, sf)))


def publish_final(spark, sf):
    return G.publishable(G.final_rollup(G.qa_filter(_qa(spark, sf))))


# ---- maintenance ----------------------------------------------------------------------------------------------------

def domain_filter(spark, sf):
    return M.sites_of(I.site(spark, sf), I.DOMAIN).select("site_id", "page_url")


def purge_contains(spark, sf):
    return M.purge_contains(I.contains(spark, sf), I.site(spark, sf), I.DOMAIN).select("site_id", "keyword_id", "points")


def purge_site(spark, sf):
    return M.purge_site(I.site(spark, sf), I.DOMAIN).select("site_id", "page_url")


def purge_site_category(spark, sf):
    return M.purge_site_category(I.site_category(spark, sf), I.WHOLE_DOMAIN).select("site_id", "domain", "custom_segment_name")


def purge_counts(spark, sf):
    return M.purge_counts(I.site(spark, sf), I.contains(spark, sf), I.site_category(spark, sf), I.WHOLE_DOMAIN)


def export_site(spark, sf):
    return M.export_site(I.site(spark, sf), I.DOMAIN, I.RUN_DATE).select("site_id", "page_url", _day("last_scrapped_date"))


def export_contains(spark, sf):
    return M.export_contains(I.contains(spark, sf), I.site(spark, sf), I.DOMAIN, I.RUN_DATE)


def export_site_category(spark, sf):
    return M.export_site_category(I.site_category(spark, sf), I.DOMAIN, I.RUN_DATE)


def replace_domain_slice(spark, sf):
    facts, site = I.contains(spark, sf), I.site(spark, sf)
    extract = M.export_contains(facts, site, I.DOMAIN, I.RUN_DATE).withColumn("points", F.col("points") + 1)
    kept = M.purge_contains(facts, site, I.DOMAIN).drop("current_dates")
    return M.replace_slice(kept, extract)


def retention_filter(spark, sf):
    results = I.table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("run_date"))
    return M.retained(results, I.RETENTION_DATE).select("o_orderkey", _day("run_date"))


ALL = {
    f.__name__: f for f in (
        title_text, visible_text, meta_text, valid_text, decode_references, tokens, vocabulary, phrase_match, keyword_counts, keyword_counts_min,
        keyword_map, explode_keyword_map, terms_not_in_vocabulary,
        url_parts_of, normalize_url, default_scheme, valid_urls, resolve_links, join_urls, skip_path_filter, extract_links,
        link_kind, unify_host, link_totals, fetchable_pages, site_closure, url_dedup, url_parts,
        url_part_sizes, url_file_report, domain_label,
        keyword_segments, keyword_first_segment, segment_clean_name, build_contains, build_site_category,
        page_flags, page_keyword_map_lookup, unclassified_pages, channel_gate, insert_ignore_site, insert_ignore_contains, upsert_site_category,
        keyword_store_upsert, keyword_store_purge,
        active_segments, segment_lookup, id_list_filter, segment_scores, segment_union, qa_rollup, qa_filter, final_rollup,
        publish_qa, publish_final,
        domain_filter, purge_contains, purge_site, purge_site_category, purge_counts, export_site, export_contains,
        export_site_category, replace_domain_slice, retention_filter,
    )
}
