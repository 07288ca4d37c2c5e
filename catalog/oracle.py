"""For each registered query, SQL over the same tables that says what must come out."""

from __future__ import annotations

from catalog import inputs as I
from pageglean.functions.text import STOP_WORDS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


# ---- inputs ---------------------------------------------------------------------------------------------------------

DESCRIBED = """described AS (
  SELECT page_id, url, replace(html, '<meta charset="utf-8">', '<meta charset="utf-8">' || CASE page_id % 4
    WHEN 0 THEN '<meta name="keywords" content="' || title || '">'
    WHEN 1 THEN '<meta name="keywords" value="' || title || '">'
    WHEN 2 THEN '<meta name="description" content="' || title || '">' ELSE '' END) AS html
  FROM (SELECT *, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title FROM pages))"""

TEXT_KEYWORDS = f"""whole_words AS (
  SELECT doc_id, list_filter(string_split(text, ' '), lambda w: w <> '') AS words FROM documents),
text_keywords AS (
  SELECT id, translate(keyword, '.,', '') AS keyword FROM (
    SELECT i - 1 AS id, ({_list(I.CHOSEN_KEYWORDS)})[i] AS keyword FROM range(1, {len(I.CHOSEN_KEYWORDS) + 1}) t(i)
    UNION ALL SELECT doc_id * 2 + 100, substr(list_min(list_transform(
        list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]), lambda w: md5(w) || w)), 33) FROM whole_words
    UNION ALL SELECT doc_id * 2 + 101, substr(list_min(list_transform(words, lambda w: md5(w) || w)), 33) FROM whole_words)),
vocab AS (
  SELECT DISTINCT trim(lower(keyword), ' ') AS keyword FROM text_keywords
  WHERE NOT contains(keyword, chr(10)) AND trim(keyword, ' ') <> '')"""


def _entities(text: str) -> str:
    for name, char in (("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("nbsp", " ")):
        text = f"replace({text}, '&{name};', '{char}')"
    return f"regexp_replace({text}, '&amp;?', '&', 'g')"


def _squeezed(text: str) -> str:
    return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'), ' ')"


def _body(html: str) -> str:
    text = f"substr({html}, instr({html}, '<'))"
    for pattern in (
        r"(?is)<!--.*?(-->|\z)", r"(?is)<script[^>]*>.*?(</script\s*>|\z)", r"(?is)<style[^>]*>.*?(</style\s*>|\z)",
        r"(?is)<title[^>]*>.*?</title\s*>", r"(?is)<noscript[^>]*>.*?</noscript\s*>", r"(?is)<head(\s[^>]*)?>.*?</head\s*>",
        r"(?is)</html\s*>[^<]*\z", r"(?is)<[/!?a-z][^>]*>", r"(?is)<[/!?a-z][^>]*\z",
    ):
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    return _squeezed(_entities(text))


TITLE = _squeezed(_entities("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"))


def _meta(name: str, attribute: str) -> str:
    return _squeezed(_entities(f"""regexp_extract(html, '<meta name="{name}" {attribute}="([^"]*)"', 1)"""))


FIELDS = f"""{DESCRIBED},
fields AS (
  SELECT page_id, url, 'title' AS field, {TITLE} AS text FROM described
  UNION ALL SELECT page_id, url, 'body', {_body('html')} FROM described
  UNION ALL SELECT page_id, url, 'keywords', {_meta('keywords', '(?:content|value)')} FROM described
  UNION ALL SELECT page_id, url, 'description', {_meta('description', 'content')} FROM described)"""

TOKENS = rf"""{FIELDS},
token_lists AS (
  SELECT page_id, url, field, list_filter(
    regexp_split_to_array(lower(text), '[!@#%$&)(+*?,/\\\]\[^}}{{_~.;=:|\s]+'),
    lambda w: w <> '' AND NOT list_contains({_list(STOP_WORDS)}, w)) AS words
  FROM fields),
tokens AS (
  SELECT page_id, url, field, unnest(words) AS token, unnest(range(len(words))) AS pos FROM token_lists)"""

MATCHES = f"""{TOKENS},
{TEXT_KEYWORDS},
ahead AS (
  SELECT *, lead(token, 1) OVER w AS t2, lead(token, 2) OVER w AS t3 FROM tokens
  WINDOW w AS (PARTITION BY page_id, field ORDER BY pos)),
grams AS (
  SELECT page_id, url, field, pos, 1 AS n, token AS keyword FROM ahead
  UNION ALL SELECT page_id, url, field, pos, 2, token || ' ' || t2 FROM ahead WHERE t2 IS NOT NULL
  UNION ALL SELECT page_id, url, field, pos, 3, token || ' ' || t2 || ' ' || t3 FROM ahead WHERE t3 IS NOT NULL),
best AS (
  SELECT page_id, url, field, pos, max(n) AS n, arg_max(keyword, n) AS keyword FROM grams SEMI JOIN vocab USING (keyword)
  GROUP BY ALL),
chain AS (
  SELECT b.*, c.pos AS next_pos FROM best b ASOF LEFT JOIN best c
  ON b.page_id = c.page_id AND b.field = c.field AND b.pos + b.n <= c.pos),
walk AS (
  SELECT c.* FROM chain c JOIN (SELECT page_id, field, min(pos) AS pos FROM chain GROUP BY ALL) USING (page_id, field, pos)
  UNION ALL
  SELECT c.* FROM walk w JOIN chain c ON c.page_id = w.page_id AND c.field = w.field AND c.pos = w.next_pos),
matches AS (SELECT page_id, url, field, pos, n, keyword FROM walk),
counts AS (SELECT page_id, url, keyword, count(*) AS points FROM matches GROUP BY ALL)"""

HREFS = """hrefs AS (
  SELECT o_orderkey, o_orderkey % 19 AS shape, o_orderkey::VARCHAR AS k, 's' || (o_custkey % 50) || '.example.com' AS host
  FROM orders)"""

# What each shape of link must become, seen from http://<host>/d/e/<k>.html?from=1.
JOINED = """CASE shape
  WHEN 0 THEN 'http://' || host || '/d/e/' || k WHEN 1 THEN 'http://' || host || '/a/' || k
  WHEN 2 THEN 'http://' || host || '/d/' || k WHEN 3 THEN 'http://' || host || '/d/e/' || k
  WHEN 4 THEN 'http://' || host || '/d/e/' || k || '.html?q=' || k
  WHEN 5 THEN 'http://' || host || '/d/e/' || k || '.html?from=1#' || k
  WHEN 6 THEN 'http://h' || k || '.org/p' WHEN 7 THEN 'https://www.example.net/p/' || k || '/?x=1#y'
  WHEN 8 THEN 'mailto:' || k || '@b.c' WHEN 11 THEN 'http://' || host || '/d/e/x ' || k
  WHEN 12 THEN 'http://' || host || '/forums/' || k WHEN 13 THEN 'http://' || host || '/x' || k || '/forums'
  WHEN 14 THEN 'http://' || host || '/' || k WHEN 15 THEN 'http://' || host || '/d/e/b/' || k
  WHEN 16 THEN 'http://' || host || '/p/' || k || ';v=1?z' WHEN 17 THEN 'javascript:void(0)'
  WHEN 18 THEN 'http://' || host || '/x/newsletter/' || k
  ELSE 'http://' || host || '/d/e/' || k || '.html?from=1' END"""

RESOLVED = f"""{HREFS},
resolved AS (
  SELECT o_orderkey, shape, regexp_replace(regexp_replace({JOINED}, '[?#;].*$', ''), '/+$', '') AS dst_url
  FROM hrefs WHERE shape NOT IN (8, 9, 10, 11, 17))"""

HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"

LINKS = f"""anchors AS (
  SELECT url, {HOST} AS host, regexp_extract(url, '^([a-z]+)://', 1) AS scheme,
    regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
    unnest(regexp_extract_all(html, '<a href="([^"]+)"', 1)) AS href FROM pages),
links AS (
  SELECT DISTINCT
    rtrim(CASE WHEN contains(host, 'example.net') THEN 'http://example.net' ELSE scheme || '://' || host END || path, '/') AS src_url,
    rtrim(CASE WHEN contains(host, 'example.net') THEN 'http://example.net' ELSE scheme || '://' || host END || href, '/') AS dst_url,
    CASE WHEN contains(host, 'example.net') THEN 'internal' ELSE 'external' END AS kind
  FROM anchors)"""

SITE = """site AS (
  SELECT o_orderkey AS site_id, 'http://s' || (o_custkey % 50) || '.example.com/p/' || o_orderkey AS page_url,
    's' || (o_custkey % 50) || '.example.com' AS host,
    o_orderdate::DATE AS last_scrapped_date, date_trunc('year', o_orderdate)::DATE AS current_dates FROM orders)"""

FACTS = """facts AS (
  SELECT l_orderkey AS site_id, l_partkey AS keyword_id, max(l_quantity::INT) AS points, max(l_shipdate)::DATE AS current_dates
  FROM lineitem GROUP BY ALL)"""

SEGMENTS = """custom_segments AS (
  SELECT p_type, i AS id, i * 10 + 40 AS threshold,
    CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'HCP' ELSE 'DTC' END || ' "' || p_type || '"' AS name
  FROM (SELECT p_type, row_number() OVER (ORDER BY p_type) AS i FROM (SELECT DISTINCT p_type FROM part))),
segment AS (SELECT p_partkey AS keyword_id, id AS custom_segment_id FROM part JOIN custom_segments USING (p_type))"""

CATEGORY = f"""{SITE}, {SEGMENTS},
site_category AS MATERIALIZED (
  SELECT DISTINCT s.site_id, s.host AS domain, c.name AS custom_segment_name, s.current_dates
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN custom_segments c USING (p_type)
  JOIN site s ON s.site_id = l.l_orderkey)"""

STORE = f"""{SITE}, {FACTS},
store_pages AS (
  SELECT DISTINCT site_id, page_url FROM facts JOIN site USING (site_id)),
listed_sites AS (SELECT page_url FROM site UNION ALL SELECT page_url || '/new' FROM site),
store AS (
  SELECT page_url, 'k' || keyword_id AS keyword, points::BIGINT AS points FROM facts JOIN site USING (site_id)
  WHERE site_id % 7 <> 0)"""

RESULTS = f"""{SITE}, {FACTS}, {SEGMENTS},
hits AS (
  SELECT c.id AS custom_segment_id, s.page_url AS url, c.name AS category, 'k' || f.keyword_id AS keyword, f.points, c.threshold
  FROM facts f JOIN segment g USING (keyword_id) JOIN custom_segments c ON c.id = g.custom_segment_id JOIN site s USING (site_id)),
sums AS (SELECT url, custom_segment_id, sum(points)::BIGINT AS total FROM hits GROUP BY ALL),
results AS (
  SELECT custom_segment_id, url, category, keyword, CASE WHEN total >= threshold THEN '1' ELSE '0' END AS flag,
    points::VARCHAR AS listpoints, total::VARCHAR AS sumofpoints
  FROM hits JOIN sums USING (url, custom_segment_id))"""

QA = f"""{RESULTS},
qa AS (
  SELECT url, category, string_agg(keyword, ' | ' ORDER BY keyword) AS keyword, string_agg(flag, ' | ' ORDER BY keyword) AS flag,
    string_agg(listpoints, ' | ' ORDER BY keyword) AS listpoints, string_agg(sumofpoints, ' | ' ORDER BY keyword) AS sumofpoints,
    count(*)::INT AS numberofkeywords
  FROM results GROUP BY url, category),
passed AS (
  SELECT * FROM qa WHERE (contains(category, 'DTC') AND numberofkeywords >= 3)
  OR (contains(category, 'HCP') AND NOT contains(category, 'DTC') AND numberofkeywords >= 5)),
final AS (SELECT url, string_agg(category, ' | ' ORDER BY category) AS category FROM passed GROUP BY url)"""

TEXT_SEGMENT = """text_segment AS (
  SELECT DISTINCT keyword_id, custom_segment_id FROM (
    SELECT id AS keyword_id, id % 6 + 1 AS custom_segment_id FROM text_keywords
    UNION ALL SELECT id, id % 5 + 1 FROM text_keywords WHERE id % 3 = 0))"""

FLAGS = f"""{MATCHES}, {SEGMENTS}, {TEXT_SEGMENT},
ids AS (SELECT trim(lower(keyword), ' ') AS keyword, min(id) AS keyword_id FROM text_keywords GROUP BY 1),
per_category AS (
  SELECT url, c.name AS category, count(*) AS n FROM counts JOIN ids USING (keyword) JOIN text_segment USING (keyword_id)
  JOIN custom_segments c ON c.id = custom_segment_id GROUP BY ALL)"""

SUBDOMAIN = f"contains(page_url, '{I.DOMAIN}')"
EVEN_PAGE = "right(page_url, 1) IN ('0', '2', '4', '6', '8')"
WANTED = f"site_id IN (SELECT site_id FROM site WHERE {SUBDOMAIN} AND current_dates = DATE '{I.RUN_DATE}')"
GONE = f"site_id IN (SELECT site_id FROM site WHERE {SUBDOMAIN})"


def _with(parts: str, select: str) -> str:
    recursive = "RECURSIVE " if "walk AS" in parts or "reach AS" in parts else ""
    return f"WITH {recursive}{parts}{select if select.startswith(',') else chr(10) + select}"


def statements() -> dict[str, str]:
    pages_path = "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
    scheme = "regexp_extract(url, '^([a-z]+)://', 1)"
    url_list = "SELECT 'http://s' || (l_orderkey % 50) || '.example.com/c/' || l_orderkey AS page_url FROM lineitem WHERE l_orderkey % 97 <> 0"
    return {
        "title_text": f"SELECT page_id, {TITLE} AS title FROM pages",
        "visible_text": f"SELECT page_id, {_body('html')} AS body FROM pages",
        "meta_text": _with(FIELDS, "SELECT page_id, max(text) FILTER (field = 'keywords') AS keywords, "
                                   "max(text) FILTER (field = 'description') AS description FROM fields GROUP BY page_id"),
        "valid_text": "SELECT doc_id, text FROM documents",
        "decode_references": """SELECT doc_id, chr((65 + doc_id % 26)::INT) || chr(39) || chr(10003) || chr((97 + doc_id % 26)::INT) || chr(65533)
  || '&none;' || text AS text FROM documents WHERE text IS NOT NULL""",
        "tokens": _with(TOKENS, "SELECT page_id, field, pos, token FROM tokens"),
        "vocabulary": _with(TEXT_KEYWORDS, "SELECT keyword FROM vocab"),
        "phrase_match": _with(MATCHES, "SELECT page_id, field, pos, keyword FROM matches"),
        "keyword_counts": _with(MATCHES, "SELECT url, keyword, points FROM counts"),
        "keyword_counts_min": _with(MATCHES, "SELECT url, keyword, points FROM counts WHERE points >= 5"),
        "keyword_map": _with(MATCHES, "SELECT url, string_agg(keyword || '=' || points, ',' ORDER BY keyword) AS keywords "
                                      "FROM counts GROUP BY page_id, url"),
        "explode_keyword_map": _with(STORE, "SELECT page_url, keyword, points FROM store"),
        "terms_not_in_vocabulary": _with(MATCHES, """, covered AS (
  SELECT page_id, field, pos + unnest(range(n)) AS pos FROM matches)
SELECT DISTINCT page_id, token AS term FROM tokens ANTI JOIN covered USING (page_id, field, pos)"""),
        "url_parts_of": f"SELECT url, {scheme} AS scheme, {HOST} AS host, {pages_path} AS path FROM pages",
        "normalize_url": "SELECT url, trim(regexp_replace(url, '[?#].*$', ''), '/') AS normalized FROM pages",
        "default_scheme": """SELECT given, CASE WHEN contains(given, '://') THEN given ELSE 'http://' || given END AS url FROM (
  SELECT CASE WHEN page_id % 2 = 0 THEN substr(url, instr(url, '://') + 3) ELSE url END AS given FROM pages)""",
        "valid_urls": _with(HREFS, "SELECT o_orderkey, 'https://www.example.net/p/' || k || '/?x=1#y' AS href FROM hrefs WHERE shape = 7"),
        "resolve_links": _with(RESOLVED, "SELECT o_orderkey, dst_url FROM resolved"),
        "join_urls": _with(HREFS, f"SELECT o_orderkey, {JOINED} AS url FROM hrefs"),
        "skip_path_filter": _with(RESOLVED, "SELECT o_orderkey, dst_url FROM resolved WHERE shape NOT IN (1, 7, 12, 16, 18)"),
        "extract_links": _with(LINKS, "SELECT src_url, dst_url, kind FROM links"),
        "link_kind": f"""SELECT host, CASE WHEN contains(host, 'example.net') OR contains('example.net', host) THEN 'internal' ELSE 'external' END AS kind,
  CASE WHEN host = 'example.net' OR host LIKE '%.example.net' THEN 'internal' ELSE 'external' END AS strict_kind
FROM (SELECT DISTINCT {HOST} AS host FROM pages)""",
        "unify_host": f"SELECT url, rtrim('https://www.example.net' || {pages_path}, '/') AS unified FROM pages",
        "link_totals": _with(LINKS, """, kinds AS (SELECT kind, count(DISTINCT dst_url) AS links FROM links GROUP BY kind)
SELECT kind, links FROM kinds UNION ALL SELECT 'total', sum(links)::BIGINT FROM kinds"""),
        "fetchable_pages": """SELECT url, status, content_type FROM (
  SELECT url, ([200, 301, 302, 403, 404, 500])[page_id % 6 + 1] AS status,
    (['text/html', 'text/html; charset=utf-8', 'application/pdf', 'application/xhtml+xml'])[page_id % 4 + 1] AS content_type FROM pages)
WHERE status IN (200, 301, 302, 403) AND contains(content_type, 'html')""",
        "site_closure": _with("""held AS (
  SELECT DISTINCT url, 'link:' || unnest(regexp_extract_all(html, '<a href="([^"]+)"', 1)) AS link FROM pages),
edges AS (SELECT url AS src, link AS dst FROM held UNION ALL SELECT link, url FROM held),
reach AS (
  SELECT dst AS url, 1 AS depth FROM edges WHERE src = (SELECT arg_min(url, page_id) FROM pages)
  UNION SELECT e.dst, r.depth + 1 FROM reach r JOIN edges e ON e.src = r.url WHERE r.depth < 30)""",
                              "SELECT url, min(depth)::INT AS depth FROM reach GROUP BY url"),
        "url_dedup": f"SELECT DISTINCT page_url FROM ({url_list})",
        "url_parts": f"""SELECT page_url, (row_number() OVER (ORDER BY page_url) - 1) // 2500 AS part
FROM (SELECT DISTINCT page_url FROM ({url_list}))""",
        "url_part_sizes": f"""SELECT (i - 1) // 2500 AS part, count(*) AS urls FROM (
  SELECT row_number() OVER () AS i FROM (SELECT DISTINCT page_url FROM ({url_list}))) GROUP BY 1""",
        "url_file_report": """SELECT l_linenumber::INT AS list, count(*) FILTER (l_partkey % 89 <> 0) AS good, count(*) FILTER (l_partkey % 89 = 0) AS bad,
  count(*) FILTER (l_partkey % 89 <> 0 AND l_partkey % 97 <> 0) AS urls FROM lineitem GROUP BY 1""",
        "domain_label": f"SELECT DISTINCT {HOST} AS host, replace({HOST}, '.', '_') AS label FROM pages",
        "keyword_segments": _with(SEGMENTS, "SELECT DISTINCT p_name AS keyword, name FROM part JOIN custom_segments USING (p_type)"),
        "keyword_first_segment": _with(SEGMENTS, "SELECT p_name AS keyword, min(name) AS name FROM part JOIN custom_segments USING (p_type) GROUP BY p_name"),
        "segment_clean_name": """SELECT p_partkey, CASE p_partkey % 6 WHEN 3 THEN 'DTC ' WHEN 4 THEN 'MF ' ELSE '' END || p_name || ' ' || p_type AS name FROM part""",
        "build_contains": _with(MATCHES, """, ids AS (SELECT trim(lower(keyword), ' ') AS keyword, min(id) AS keyword_id FROM text_keywords GROUP BY 1)
SELECT page_id AS site_id, keyword_id, points FROM counts JOIN ids USING (keyword)"""),
        "build_site_category": _with(f"{MATCHES}, {SEGMENTS}, {TEXT_SEGMENT}", f""", firsts AS (
  SELECT trim(lower(keyword), ' ') AS keyword, min(name) AS name FROM text_keywords JOIN text_segment ON keyword_id = text_keywords.id
  JOIN custom_segments c ON c.id = custom_segment_id GROUP BY 1)
SELECT DISTINCT page_id AS site_id, {HOST} AS domain, name AS custom_segment_name, '{I.RUN_DATE}' AS current_dates
FROM counts JOIN firsts USING (keyword)"""),
        "page_flags": _with(FLAGS, """SELECT url, replace(string_agg(category, ' | ' ORDER BY category), '"', '') AS category FROM per_category
WHERE n >= CASE WHEN contains(category, 'DTC') THEN 3 ELSE 5 END GROUP BY url"""),
        "page_keyword_map_lookup": _with(STORE, """, texts AS (SELECT page_url, string_agg(keyword || '=' || points, ',' ORDER BY keyword) AS keywords FROM store GROUP BY 1)
SELECT s.page_url, CASE WHEN p.page_url IS NULL THEN 'missing' WHEN t.keywords IS NULL THEN 'empty' ELSE 'found' END AS state,
  coalesce(t.keywords, '') AS keywords
FROM listed_sites s LEFT JOIN store_pages p USING (page_url) LEFT JOIN texts t USING (page_url)"""),
        "unclassified_pages": _with(STORE, "SELECT page_url FROM listed_sites ANTI JOIN store_pages USING (page_url)"),
        "channel_gate": "SELECT page_id, url FROM pages WHERE page_id % 6 < 4 AND page_id % 11 <> 0",
        "insert_ignore_site": _with(SITE, f"""SELECT site_id, page_url,
  CASE WHEN site_id % 2 = 1 THEN last_scrapped_date::VARCHAR ELSE '{I.NEXT_DATE}' END AS last_scrapped_date,
  CASE WHEN site_id % 2 = 1 THEN current_dates::VARCHAR ELSE '{I.NEXT_DATE}' END AS current_dates FROM site"""),
        "insert_ignore_contains": _with(FACTS, f"""SELECT site_id, keyword_id, points, current_dates::VARCHAR AS current_dates FROM facts WHERE site_id % 2 = 1
UNION ALL SELECT site_id, keyword_id, points + 1, '{I.NEXT_DATE}' FROM facts f WHERE NOT EXISTS (
  SELECT 1 FROM facts o WHERE o.site_id % 2 = 1 AND o.site_id = f.site_id AND o.keyword_id = f.keyword_id)"""),
        "upsert_site_category": _with(CATEGORY, f"""SELECT site_id, coalesce(o.domain, 'new.example.com') AS domain, custom_segment_name,
  CASE WHEN site_id % 3 <> 0 THEN '{I.NEXT_DATE}' ELSE o.current_dates::VARCHAR END AS current_dates
FROM (SELECT * FROM site_category WHERE site_id % 2 = 1) o
FULL OUTER JOIN (SELECT site_id, custom_segment_name FROM site_category WHERE site_id % 3 <> 0) n USING (site_id, custom_segment_name)"""),
        "keyword_store_upsert": _with(STORE, f"""SELECT page_url, keyword, points * 10 AS points FROM store WHERE {EVEN_PAGE}
UNION ALL SELECT page_url, keyword, points FROM store WHERE NOT {EVEN_PAGE}"""),
        "keyword_store_purge": _with(STORE, f"SELECT page_url, keyword, points FROM store WHERE NOT {EVEN_PAGE}"),
        "active_segments": _with(SEGMENTS, "SELECT DISTINCT custom_segment_id AS id FROM segment ORDER BY id"),
        "segment_lookup": _with(SEGMENTS, "SELECT id, threshold, name FROM custom_segments"),
        "id_list_filter": _with(SEGMENTS, "SELECT keyword_id, custom_segment_id FROM segment WHERE custom_segment_id IN (2, 4)"),
        "segment_scores": _with(RESULTS, """SELECT custom_segment_id, url, category, string_agg(keyword, ' | ' ORDER BY keyword) AS keyword,
  any_value(flag) AS flag, string_agg(listpoints, ' | ' ORDER BY keyword) AS listpoints, any_value(sumofpoints) AS sumofpoints
FROM results GROUP BY custom_segment_id, url, category"""),
        "segment_union": _with(RESULTS, """SELECT custom_segment_id, url, category, keyword, flag, listpoints, sumofpoints FROM results WHERE contains(category, 'DTC')
UNION ALL SELECT custom_segment_id, url, category, keyword, NULL, listpoints, sumofpoints FROM results WHERE contains(category, 'HCP')"""),
        "qa_rollup": _with(QA, "SELECT * FROM qa"),
        "qa_filter": _with(QA, "SELECT * FROM passed"),
        "final_rollup": _with(QA, "SELECT * FROM final"),
        "publish_qa": _with(QA, """SELECT url, replace(category, '"', '') AS category, keyword, flag, listpoints, sumofpoints, numberofkeywords FROM passed"""),
        "publish_final": _with(QA, """SELECT url, replace(category, '"', '') AS category FROM final"""),
        "domain_filter": _with(SITE, f"SELECT site_id, page_url FROM site WHERE {SUBDOMAIN}"),
        "purge_contains": _with(f"{SITE}, {FACTS}", f"SELECT site_id, keyword_id, points FROM facts WHERE NOT {GONE}"),
        "purge_site": _with(SITE, f"SELECT site_id, page_url FROM site WHERE NOT {SUBDOMAIN}"),
        "purge_site_category": _with(CATEGORY, f"SELECT site_id, domain, custom_segment_name FROM site_category WHERE domain <> '{I.WHOLE_DOMAIN}'"),
        "purge_counts": _with(f"{CATEGORY}, {FACTS}", f"""SELECT 'contains' AS table_name, count(*) AS removed FROM facts
  WHERE site_id IN (SELECT site_id FROM site WHERE contains(page_url, '{I.WHOLE_DOMAIN}'))
UNION ALL SELECT 'site', count(*) FROM site WHERE contains(page_url, '{I.WHOLE_DOMAIN}')
UNION ALL SELECT 'site_category', count(*) FROM site_category WHERE domain = '{I.WHOLE_DOMAIN}'"""),
        "export_site": _with(SITE, f"SELECT site_id, page_url, last_scrapped_date::VARCHAR AS last_scrapped_date FROM site "
                                   f"WHERE {SUBDOMAIN} AND current_dates = DATE '{I.RUN_DATE}'"),
        "export_contains": _with(f"{SITE}, {FACTS}", f"SELECT site_id, keyword_id, points FROM facts WHERE {WANTED}"),
        "export_site_category": _with(CATEGORY, f"SELECT site_id, domain, custom_segment_name FROM site_category "
                                                f"WHERE contains(domain, '{I.DOMAIN}') AND current_dates = DATE '{I.RUN_DATE}'"),
        "replace_domain_slice": _with(f"{SITE}, {FACTS}", f"""SELECT site_id, keyword_id, points FROM facts WHERE NOT {GONE}
UNION ALL SELECT site_id, keyword_id, points + 1 FROM facts WHERE {WANTED}"""),
        "retention_filter": f"SELECT o_orderkey, (o_orderdate::DATE)::VARCHAR AS run_date FROM orders "
                            f"WHERE o_orderdate::DATE > DATE '{I.RETENTION_DATE}' - 7",
    }
