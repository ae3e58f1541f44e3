"""Discovery queries: companies, fan-out, page text, links, typing, scores."""

from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions import text
from ledgerloom.operators import discovery as d
from ledgerloom.plans import check_sql as c
from ledgerloom.plans.catalog import query


def _decoded(x):
    for entity, char in d.ENTITIES:
        x = f"replace({x}, {c.quoted([entity])}, {c.quoted([char])})"
    return x


def inner(x):
    return c.clean(_decoded(f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')"))


def page_text_sql(html="html"):
    hidden = d.HIDDEN.replace("\\b", "\\b")
    shown = f"regexp_replace(regexp_replace({html}, '(?is)<title[^>]*>.*?</title>', ' ', 'g'), '{hidden}', ' ', 'g')"
    return {
        "title": inner(f"regexp_extract({html}, '(?is)<title[^>]*>(.*?)</title>', 1)"),
        "h1": inner(f"regexp_extract({shown}, '(?is)<h1[^>]*>(.*?)</h1>', 1)"),
        "visible_text": inner(shown),
    }


_P = page_text_sql()
query("t15_page_text", f"SELECT page_id, {_P['title']} AS title, {_P['h1']} AS h1, {_P['visible_text']} AS visible_text, substr({_P['visible_text']}, 1, 500) AS snippet FROM @pages")(
    lambda t: d.page_text(t.pages.select("page_id", "html")).drop("html")
)

_ANCHOR = d.ANCHOR.replace("'", "''")
LINKS = f"""
    WITH raw AS (SELECT page_id, url, unnest(regexp_extract_all(html, '{_ANCHOR}', 1)) AS href, unnest(regexp_extract_all(html, '{_ANCHOR}', 2)) AS label,
                        generate_subscripts(regexp_extract_all(html, '{_ANCHOR}', 1), 1) - 1 AS link_position FROM @pages),
    links AS (SELECT page_id, url, link_position, {inner('label')} AS link_text,
                     CASE WHEN regexp_matches(href, '^[a-z]+:') THEN href ELSE regexp_extract(url, '^[a-z]+://[^/?#]*') || href END AS link_url FROM raw WHERE href <> '')"""
query("t16_page_links", LINKS + "SELECT page_id, link_position, link_text, link_url FROM links")(
    lambda t: d.page_links(t.pages.select("page_id", "url", "html")).drop("url")
)

_KEYS = d.keyword_pattern()
_XML = "concat('<urlset><url><loc> ', url, ' </loc></url><url><loc>https://x.example/supplier-list/', cast(page_id % 9 AS string), '</loc></url><url><LOC>https://x.example/csr-report/', cast(page_id AS string), '</LOC></url></urlset>')"
query("t17_sitemap_urls", f"""
    WITH m AS (SELECT page_id, {_XML} AS xml FROM @pages), u AS (SELECT page_id, unnest(regexp_extract_all(xml, '(?i)<loc>\\s*(.*?)\\s*</loc>', 1)) AS url,
               generate_subscripts(regexp_extract_all(xml, '(?i)<loc>\\s*(.*?)\\s*</loc>', 1), 1) - 1 AS position FROM m)
    SELECT page_id, position, url FROM u WHERE regexp_matches({c.key('url')}, '{_KEYS}')""")(
    lambda t: d.sitemap_urls(t.pages.select("page_id", F.expr(_XML).alias("xml")), "page_id")
)
query("t16_source_links", LINKS + f"""
    , x AS (SELECT page_id, link_position, link_text || CASE WHEN page_id % 2 = 0 THEN ' suppliers' ELSE '' END AS link_text, link_url FROM links),
    k AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY link_position) AS rn FROM x WHERE regexp_matches({c.key("link_text || ' ' || link_url")}, '{_KEYS}')),
    f AS (SELECT *, row_number() OVER (PARTITION BY page_id, link_url ORDER BY link_position) AS again FROM k WHERE rn <= 35)
    SELECT page_id, link_position, link_text, link_url FROM f WHERE again = 1""")(
    lambda t: d.source_links(d.page_links(t.pages.select("page_id", "url", "html")).drop("url").withColumn(
        "link_text", F.when(F.col("page_id") % 2 == 0, F.concat("link_text", F.lit(" suppliers"))).otherwise(F.col("link_text"))), "page_id")
)

query("t10_reported_totals", f"""
    WITH x AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN text || ' 1,2' || cast(doc_id AS string) || ' certified partners' WHEN 1 THEN '77 Results in ' || text ELSE text END AS t FROM @documents)
    SELECT doc_id, coalesce(try_cast(replace(coalesce({', '.join(f"nullif(regexp_extract(t, '(?i){p}', 1), '')" for p in d.PARTNER_TOTALS)}), ',', '') AS bigint), -1) AS total FROM x""")(
    lambda t: t.documents.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" 1,2"), "doc_id", F.lit(" certified partners")))
                                 .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("77 Results in "), "text")).otherwise(F.col("text")).alias("x"))
    .select("doc_id", F.coalesce(d.reported_total("x", d.PARTNER_TOTALS), F.lit(-1)).alias("total"))
)

_B_CORP = "CASE doc_id % 4 WHEN 0 THEN concat('Showing all 1,', cast(100 + doc_id AS string), ' B Corps') WHEN 1 THEN concat('showing 1 - 20 of 2,', cast(doc_id AS string)) WHEN 2 THEN concat(cast(doc_id AS string), ' b corps') ELSE concat('one of  7', cast(doc_id AS string)) END"
_EWG = "CASE doc_id % 3 WHEN 0 THEN concat('We found 3,', cast(100 + doc_id AS string), ' items, we') WHEN 1 THEN concat('it found ', cast(doc_id AS string), '  items') ELSE concat(cast(doc_id AS string), ' items that are EWG verified') END"
for _name, _text, _patterns, _want in (
    ("b_corp", _B_CORP, d.B_CORP_TOTALS, "CASE doc_id % 4 WHEN 0 THEN '1' || (100 + doc_id) WHEN 1 THEN '2' || doc_id WHEN 2 THEN doc_id || '' ELSE '7' || doc_id END"),
    ("ewg", _EWG, d.EWG_TOTALS, "CASE doc_id % 3 WHEN 0 THEN '3' || (100 + doc_id) ELSE doc_id || '' END"),
):
    query(f"t10_{_name}_totals", f"SELECT doc_id, cast({_want} AS bigint) AS total FROM @documents")(
        lambda t, x=_text, p=_patterns: t.documents.select("doc_id", F.concat(F.expr(x), F.lit(" "), F.regexp_replace("text", "[0-9]", "")).alias("x")).select("doc_id", d.reported_total("x", p).alias("total")))

# --- companies ------------------------------------------------------------------------------------
_U1, _U2 = c.clean("configurator_url"), c.clean("alternative_url")
COMPANIES = f"""
    WITH cr AS (SELECT src_ordinal + 2 AS row_number, {c.clean('company')} AS company_name, {c.key('company')} AS company_name_normalized, {c.clean('product')} AS product,
                       {c.clean('industry')} AS industry, {c.clean('country')} AS country, {_U1} AS u1, {_U2} AS u2, {c.domain('configurator_url')} AS d1, {c.domain('alternative_url')} AS d2
                FROM a_configurators WHERE {c.clean('company')} <> ''),
    un AS (SELECT company_name, company_name_normalized, u1 AS u, d1 AS dm FROM cr UNION ALL SELECT company_name, company_name_normalized, u2, d2 FROM cr),
    own AS (SELECT company_name, company_name_normalized, {c.first_n('dm')} AS company_domains, {c.first_n('u')} AS company_urls FROM un
            WHERE dm <> '' AND NOT {c.within('dm', fixed.UNHELPFUL_DOMAINS)} GROUP BY 1, 2),
    companies AS (SELECT company_name, company_name_normalized, count(*) AS configurator_rows, {c.first_n('product', 80, "product <> ''")} AS configurator_products,
                  {c.first_n('industry', 30, "industry <> ''")} AS industries, {c.first_n('country', 30, "country <> ''")} AS countries,
                  array_to_string(list_sort(list(DISTINCT row_number)), ' | ') AS configurator_row_numbers FROM cr GROUP BY 1, 2),
    uc AS (SELECT companies.*, coalesce(company_domains, '') AS company_domains, coalesce(company_urls, '') AS company_urls FROM companies LEFT JOIN own USING (company_name, company_name_normalized))"""


def companies(t):
    return d.unique_companies(d.company_rows(t.a_configurators))


query("a26_unique_companies", COMPANIES + "SELECT * FROM uc")(companies)

_TEMPLATES = ", ".join(f"({i}, {c.quoted([x])})" for i, x in enumerate(fixed.SEARCH_TEMPLATES[:4]))
query("t11_search_queries", COMPANIES + f"""
    , n AS (SELECT company_name, trim(regexp_replace(replace(regexp_replace(company_name, '(?i)\\.(com|de|it|fr|co|uk|nl|ch|eu)$', ''), '+', ' '), '\\s+', ' ', 'g')) AS nm FROM uc)
    SELECT company_name, i AS query_number, replace(q, '{{company}}', nm) AS query FROM n CROSS JOIN (VALUES {_TEMPLATES}) v(i, q)""")(
    lambda t: d.search_queries(companies(t).select("company_name"))
)

_SEARCH_WORDS = "configurator|customizer|product builder|design your own|configurateur|personnaliser|configurador|personalizar|konfigurator"
query("t11_catalogue_queries", f"""
    WITH i AS (SELECT p_partkey AS id, p_brand AS company, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name END AS product, CASE WHEN p_partkey % 2 = 0 THEN 'Italy' ELSE '' END AS country FROM @part),
    w AS (SELECT unnest(string_split('{_SEARCH_WORDS}', '|')) AS word, generate_subscripts(string_split('{_SEARCH_WORDS}', '|'), 1) AS n),
    q AS (SELECT i.*, n AS place, trim(regexp_replace(product || ' ' || company || ' ' || country || ' ' || word, ' +', ' ', 'g')) AS query FROM i, w
          UNION ALL SELECT i.*, 9 + n, trim(regexp_replace(product || ' ' || company || ' ' || word, ' +', ' ', 'g')) FROM i, w
          UNION ALL SELECT i.*, 19, trim(regexp_replace(company || ' ' || product || ' ' || country, ' +', ' ', 'g')) FROM i),
    f AS (SELECT *, row_number() OVER (PARTITION BY id, lower(query) ORDER BY place) AS rn FROM q)
    SELECT id, company, product, country, row_number() OVER (PARTITION BY id ORDER BY place) AS query_number, query FROM f WHERE rn = 1""")(
    lambda t: d.catalogue_queries(t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("company"), F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_name")).alias("product"),
        F.when(F.col("p_partkey") % 2 == 0, "Italy").otherwise("").alias("country")))
)

_PATHS = ", ".join(f"({c.quoted([m])}, {c.quoted([a])}, {c.quoted([b])})" for m, a, b in
                   [("official_homepage", p, "/") for p in ("https://", "https://www.", "http://", "http://www.")]
                   + [("official_common_path", "https://", p) for p in fixed.COMMON_PATHS[:35]] + [("official_sitemap", "https://", p) for p in ("/sitemap.xml", "/sitemap_index.xml")])
query("t12_candidate_urls", f"""
    WITH h AS (SELECT DISTINCT {c.domain('url')} AS host FROM @pages)
    SELECT host, m AS discovery_method, a || host || b AS url FROM h CROSS JOIN (VALUES {_PATHS}) v(m, a, b)""")(
    lambda t: d.candidate_urls(t.pages.select(text.domain_of("url").alias("host")).distinct())
)

# --- evidence and scores --------------------------------------------------------------------------
_TYPES = list(fixed.SOURCE_TYPE_KEYWORDS)


def evidence_sql(source):
    hits = ", ".join(f"{c.hits('haystack', ks)} AS h_{n}" for n, ks in fixed.SOURCE_TYPE_KEYWORDS.items())
    best = f"greatest({', '.join('h_' + n for n in _TYPES)})"
    chain = " ".join(f"WHEN h_{n} = {best} THEN '{n}'" for n in _TYPES)
    return f"""SELECT * EXCLUDE ({', '.join('h_' + n for n in _TYPES)}), CASE WHEN {best} = 0 THEN '{fixed.SOURCE_TYPE_DEFAULT}' {chain} END AS source_type,
               {c.any_hit('haystack', fixed.HIGH_VALUE_KEYWORDS)} AS high_value FROM (SELECT *, {hits} FROM {source})"""


_NOTE = "CASE doc_id % 5 WHEN 0 THEN ' Supplier-list & factory list' WHEN 1 THEN ' ESG report, suppliers' WHEN 2 THEN ' Traceability' ELSE '' END"
query("t13_keyword_evidence", f"""
    WITH x AS (SELECT doc_id, {c.key(f"text || {_NOTE}")} AS haystack FROM @documents), e AS ({evidence_sql('x')})
    SELECT doc_id, source_type, high_value::int AS high_value FROM e""")(
    lambda t: d.keyword_evidence(t.documents.select("doc_id", text.match_key(F.concat("text", F.expr(_NOTE))).alias("haystack")), "haystack")
    .select("doc_id", "source_type", F.col("high_value").cast("int").alias("high_value"))
)

_TERMS = [
    ("starts_with(discovery_method, 'official')", 30, "official_domain_discovery"),
    ("company_key <> '' AND contains(haystack, company_key)", 18, "company_name_found_in_source"),
    ("ratio >= 0.8", 12, "most_company_tokens_found"), ("ratio >= 0.5 AND ratio < 0.8", 7, "some_company_tokens_found"),
    ("result_domain = host OR ends_with(result_domain, '.' || host)", 35, "official_or_company_domain_match"),
    (c.within("result_domain", fixed.NEGATIVE_DOMAINS), -35, "negative_domain"), ("contains(lower(url), '.pdf')", 12, "pdf_source"),
    ("high_value", 24, "high_value_supplier_keyword"),
    *[(f"source_type = '{x}'", 22, f"strong_source_type_{x}") for x in ("supplier_list", "factory_list", "modern_slavery_statement")],
    *[(f"source_type = '{x}'", 14, f"useful_source_type_{x}") for x in ("sustainability_report", "responsible_sourcing", "open_supply_hub")],
    ("source_type = 'supply_chain_page'", 12, "supply_chain_page"),
    *[(f"contains(haystack, '{k}')", -8, f"negative_keyword_{k}") for k in fixed.NEGATIVE_KEYWORDS],
    ("http_status = '200'", 5, "url_fetch_success"), ("http_status = '404'", -12, "http_status_404"),
    ("contains(result_domain, 'opensupplyhub')", 18, "open_supply_hub_result"),
]
SCORED = f"""
    WITH s0 AS (SELECT source_candidate_id, company_name, host, discovery_method, url, http_status, lead || ' ' || {_P['title']} AS title, substr({_P['visible_text']}, 1, 500) AS snippet FROM a_sources),
    s1 AS MATERIALIZED (SELECT *, {c.key("title || ' ' || url || ' ' || snippet")} AS haystack, {c.key('company_name')} AS company_key, {c.domain('url')} AS result_domain,
                  regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS result_path FROM s0),
    s2 AS (SELECT *, list_filter(string_split(company_key, ' '), lambda w: length(w) >= 4) AS toks FROM s1),
    s3 AS (SELECT *, CASE WHEN len(toks) = 0 THEN 0.0 ELSE len(list_filter(toks, lambda w: contains(haystack, w)))::double / len(toks) END AS ratio FROM s2),
    s4 AS MATERIALIZED ({evidence_sql('s3')}),
    s5 AS MATERIALIZED (SELECT *, greatest(0, least(100, {c.total([(a, b) for a, b, _ in _TERMS])})) AS source_score, {c.reasons([(a, r) for a, _, r in _TERMS])} AS score_reasons FROM s4),
    scored AS MATERIALIZED (SELECT *, CASE WHEN source_score >= 75 THEN 'High' WHEN source_score >= 50 THEN 'Medium' WHEN source_score >= 30 THEN 'Low' ELSE 'Very Low' END AS source_confidence FROM s5),
    kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_name, url ORDER BY source_candidate_id) AS rn FROM scored WHERE source_score >= 35) WHERE rn = 1)"""


def scored(t):
    found = d.page_text(t.a_sources.withColumn("company_domains", F.array("host"))).drop("html", "h1", "visible_text")
    return d.score_sources(found.withColumn("title", F.concat_ws(" ", "lead", "title")).drop("lead"))


_OUT = ["source_candidate_id", "company_name", "url", "source_type", "source_score", "source_confidence", "score_reasons", "result_domain", "result_path"]
query("t14_source_scores", SCORED + f"SELECT {', '.join(_OUT)} FROM scored")(lambda t: scored(t).select(*_OUT))
query("w1_kept_sources", SCORED + "SELECT source_candidate_id, company_name, url, source_score FROM kept")(
    lambda t: d.kept_sources(scored(t)).select("source_candidate_id", "company_name", "url", "source_score")
)
_STATS = """SELECT company_name, count(*) AS source_count, count(*) FILTER (WHERE source_confidence = 'High') AS high_sources, count(*) FILTER (WHERE source_confidence = 'Medium') AS medium_sources,
            max(source_score) AS max_source_score FROM scored GROUP BY 1"""
_BEST = """SELECT company_name, arg_min(url, rk) AS best_source_url, arg_min(title, rk) AS best_source_title, arg_min(source_type, rk) AS best_source_type
           FROM (SELECT *, row_number() OVER (PARTITION BY company_name ORDER BY source_score DESC, source_candidate_id) AS rk FROM scored) GROUP BY 1"""
query("a27_source_statistics", SCORED + _STATS)(lambda t: d.source_statistics(scored(t)))
query("w5_best_sources", SCORED + _BEST)(lambda t: d.best_sources(scored(t)))
query("j12_company_summary", COMPANIES + ", " + SCORED.strip()[5:] + f"""
    , named AS (SELECT * REPLACE ({c.clean('company_name')} AS company_name) FROM scored), st AS ({_STATS.replace('FROM scored', 'FROM named')}), bs AS ({_BEST.replace('FROM scored', 'FROM named')})
    SELECT company_name, configurator_rows, industries, company_domains, coalesce(source_count, 0) AS source_count, coalesce(high_sources, 0) AS high_sources, coalesce(medium_sources, 0) AS medium_sources,
           coalesce(max_source_score, 0) AS max_source_score, coalesce(best_source_url, '') AS best_source_url, coalesce(best_source_title, '') AS best_source_title, coalesce(best_source_type, '') AS best_source_type
    FROM uc LEFT JOIN st USING (company_name) LEFT JOIN bs USING (company_name)""")(
    lambda t: d.company_summary(companies(t), scored(t).withColumn("company_name", text.clean("company_name"))).select(
        "company_name", "configurator_rows", "industries", "company_domains", "source_count", "high_sources", "medium_sources", "max_source_score",
        "best_source_url", "best_source_title", "best_source_type")
)
