"""Typed import, classification and hub queries over the catalogue adapter."""

from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.operators import hub
from ledgerloom.plans import check_sql as c
from ledgerloom.plans.catalog import query


def _blank(x):
    return f"nullif(trim({x}), '')"


def _score(x):
    return f"CASE WHEN floor(try_cast({x} AS double) + 0.5) BETWEEN 1 AND 5 THEN cast(floor(try_cast({x} AS double) + 0.5) AS int) END"


ITEMS = f"""
    WITH raw_items AS (
        SELECT src_ordinal, id, {_blank('industry')} AS industry, {_blank('country')} AS country, {_blank('company')} AS company,
               {_blank('product')} AS product, {_blank('configurator_url')} AS configurator_url,
               CASE WHEN upper(trim(active_text)) IN ('SI', 'SÌ', 'YES', 'TRUE', '1') THEN true
                    WHEN upper(trim(active_text)) IN ('NO', 'FALSE', '0') THEN false END AS is_active,
               {_blank('alternative_url')} AS alternative_url, {_blank('visualization_text')} AS visualization_type,
               {_score('mobile_text')} AS mobile_score, {_score('compatibility_text')} AS compatibility_score,
               {_score('complexity_text')} AS complexity_score, {_blank('database_detail_url')} AS database_detail_url
        FROM a_configurators),
    valued AS (
        SELECT *, CASE visualization_type WHEN 'Interactive 3D' THEN 5 WHEN 'Static 2D' THEN 3 END AS points
        FROM raw_items WHERE company IS NOT NULL),
    items AS (
        SELECT * EXCLUDE (points),
               round((coalesce(mobile_score, 0) + coalesce(compatibility_score, 0) + coalesce(complexity_score, 0) + coalesce(points, 0)) * 1.0 /
                     nullif((mobile_score IS NOT NULL)::int + (compatibility_score IS NOT NULL)::int + (complexity_score IS NOT NULL)::int + (points IS NOT NULL)::int, 0), 2) AS intelligence_score
        FROM valued)
"""


def items(t):
    return hub.typed_import(t.a_configurators)


query("p13_typed_import", ITEMS + "SELECT * EXCLUDE (intelligence_score), coalesce(cast(is_active AS varchar), '') AS active_word FROM items".replace("* EXCLUDE (intelligence_score)", "* EXCLUDE (intelligence_score, is_active)"))(
    lambda t: items(t).withColumn("active_word", F.coalesce(F.col("is_active").cast("string"), F.lit(""))).drop("is_active", "intelligence_score")
)

query("p13_import_counts", """
    SELECT count(*) AS rows_found, count(*) FILTER (WHERE trim(company) <> '') AS imported,
           count(*) FILTER (WHERE trim(company) = '') AS skipped FROM a_configurators""")(
    lambda t: hub.import_counts(t.a_configurators)
)

query("p14_composite_score", ITEMS + "SELECT id, intelligence_score FROM items")(
    lambda t: items(t).select("id", "intelligence_score")
)

query("w6_slugs", ITEMS + """
    , based AS (SELECT id, src_ordinal, substr(trim(regexp_replace(strip_accents(lower(concat(company, '-', coalesce(product, 'configurator')))), '[^a-z0-9]+', '-', 'g'), '-'), 1, 80) AS base FROM items),
    ranked AS (SELECT id, base, row_number() OVER (PARTITION BY base ORDER BY src_ordinal) AS n FROM based)
    SELECT id, CASE WHEN n = 1 THEN base ELSE concat(base, '-', n) END AS slug FROM ranked""")(
    lambda t: hub.assign_slugs(items(t)).select("id", "slug")
)

query("p12_source_class", f"""
    WITH k AS (SELECT src_ordinal, src_tie, certification, trim(regexp_replace(lower(certification), '[^a-z0-9]+', ' ', 'g')) AS x FROM a_registry)
    SELECT src_ordinal, src_tie, certification, {c.first_match('x', fixed.SOURCE_CLASSES, fixed.SOURCE_CLASS_DEFAULT[0], lambda r: r[0])} AS source_key,
           {c.first_match('x', fixed.SOURCE_CLASSES, fixed.SOURCE_CLASS_DEFAULT[1], lambda r: r[1])} AS registry_type,
           {c.first_match('x', fixed.SOURCE_CLASSES, fixed.SOURCE_CLASS_DEFAULT[2], lambda r: r[2])} AS availability FROM k""")(
    lambda t: hub.classify_sources(t.a_registry.select("src_ordinal", "src_tie", "certification"))
)

query("p12_source_availability", f"""
    WITH k AS (SELECT trim(regexp_replace(lower(certification), '[^a-z0-9]+', ' ', 'g')) AS x FROM a_registry),
    v AS (SELECT {c.first_match('x', fixed.SOURCE_CLASSES, fixed.SOURCE_CLASS_DEFAULT[2], lambda r: r[2])} AS availability FROM k)
    SELECT availability, count(*) AS certifications FROM v GROUP BY 1""")(
    lambda t: hub.classify_sources(t.a_registry.select("certification")).groupBy("availability").agg(F.count("*").alias("certifications"))
)

_codes = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fixed.COUNTRY_CODES.items())
query("p12_item_classes", ITEMS + f"""
    SELECT id, {c.first_match("lower(trim(coalesce(industry, '')))", fixed.INDUSTRY_KEYS, fixed.INDUSTRY_DEFAULT)} AS industry_key,
           {c.first_match("lower(trim(coalesce(product, '')))", fixed.PRODUCT_GROUPS, fixed.PRODUCT_DEFAULT)} AS product_group,
           CASE WHEN coalesce(visualization_type, '') ILIKE '%3d%' THEN '3d' WHEN coalesce(visualization_type, '') ILIKE '%2d%' THEN '2d' ELSE 'other' END AS visual_group,
           CASE lower(trim(coalesce(country, ''))) {_codes} ELSE '' END AS country_code FROM items""")(
    lambda t: hub.classify_items(items(t)).select("id", "industry_key", "product_group", "visual_group", "country_code")
)

query("p12_visualisation_class", f"""
    WITH x AS (SELECT doc_id, lower({c.clean('text')}) AS t FROM @documents),
    i AS (SELECT id, lower(trim(visualization_text)) AS v FROM a_configurators)
    SELECT 'document' AS origin, doc_id AS row_id, {c.first_match('t', fixed.VISUALISATION_TEXT_SIGNALS, '')} AS visualisation FROM x
    UNION ALL SELECT 'item', id, CASE WHEN v = '' THEN '' ELSE {c.first_match('v', fixed.VISUALISATION_WORDS, '')} END FROM i""")(
    lambda t: hub.visualisation(t.documents.select(F.lit("document").alias("origin"), F.col("doc_id").alias("row_id"), "text"), "text", free_text=True).drop("text")
    .unionByName(hub.visualisation(t.a_configurators.select(F.lit("item").alias("origin"), F.col("id").alias("row_id"), "visualization_text"), "visualization_text").drop("visualization_text"))
)

_filter = "(contains(lower(coalesce(company, '')), 'in') OR contains(lower(coalesce(product, '')), 'in') OR contains(lower(coalesce(industry, '')), 'in') OR contains(lower(coalesce(country, '')), 'in'))"
query("p15_explorer_filter", ITEMS + f"SELECT id, company, product FROM items WHERE {_filter} AND is_active AND visualization_type = 'Interactive 3D'")(
    lambda t: items(t).filter(hub.explorer_predicate(q="IN", active="active", visualization="Interactive 3D")).select("id", "company", "product")
)


def _band(x, *words):
    return f"CASE WHEN {x} IS NULL THEN '{words[0]}' WHEN {x} >= 4 THEN '{words[1]}' WHEN {x} = 3 THEN '{words[2]}' ELSE '{words[3]}' END"


query("p16_score_labels", ITEMS + f"""
    SELECT id, coalesce(round(greatest(0, least(100, intelligence_score / 5 * 100)), 2), 0) AS percent,
           CASE WHEN intelligence_score IS NULL THEN 'Not evaluated' WHEN intelligence_score >= 4 THEN 'Strong' WHEN intelligence_score >= 3 THEN 'Moderate' ELSE 'Weak' END AS band,
           CASE WHEN is_active THEN 'Active' WHEN NOT is_active THEN 'Inactive' ELSE 'Unknown' END AS status,
           {_band('mobile_score', 'missing', 'strong', 'acceptable', 'attention')} AS mobile_insight,
           {_band('complexity_score', 'missing', 'rich', 'moderate', 'simple')} AS depth_insight,
           {_band('compatibility_score', 'missing', 'structured', 'some', 'limited')} AS rules_insight FROM items""")(
    lambda t: hub.score_labels(items(t))
)

for _mode, _column in hub.SORT_MODES.items():
    _by = f"{_column} DESC NULLS LAST, " if _column else ""
    query(f"l1_explorer_page_{_mode}", ITEMS + f"SELECT id, company, product, intelligence_score FROM items WHERE is_active ORDER BY {_by}company, id LIMIT 120")(
        lambda t, mode=_mode: hub.explorer_page(items(t), sort=mode, active="active").select("id", "company", "product", "intelligence_score")
    )

query("a29_hub_counters", ITEMS + f"""
    SELECT count(*) AS total, count(*) FILTER (WHERE {_filter}) AS filtered, count(*) FILTER (WHERE is_active) AS active,
           count(*) FILTER (WHERE NOT is_active) AS inactive, count(DISTINCT nullif(industry, '')) AS industries,
           count(DISTINCT nullif(country, '')) AS countries FROM items""")(
    lambda t: hub.hub_counters(items(t), q="in")
)

query("a30_facets", ITEMS + """
    SELECT DISTINCT 'industry' AS facet, industry AS value FROM items WHERE industry <> ''
    UNION ALL SELECT DISTINCT 'country', country FROM items WHERE country <> ''
    UNION ALL SELECT DISTINCT 'visualization_type', visualization_type FROM items WHERE visualization_type <> ''""")(
    lambda t: hub.facets(items(t))
)

_ranked = "ORDER BY intelligence_score DESC, company, id"
query("w4_top_per_industry", ITEMS + f"""
    , r AS (SELECT trim(industry) AS industry, id, company, product, country, intelligence_score,
                   row_number() OVER (PARTITION BY trim(industry) {_ranked}) AS rank
            FROM items WHERE is_active AND intelligence_score IS NOT NULL AND trim(industry) <> '')
    SELECT * FROM r WHERE rank <= 3""")(
    lambda t: hub.top_per_industry(items(t)).select("industry", "id", "company", "product", "country", "intelligence_score", "rank")
)

query("w4_overall_top", ITEMS + f"SELECT id, company, product, intelligence_score FROM items WHERE is_active AND intelligence_score IS NOT NULL {_ranked} LIMIT 20")(
    lambda t: hub.overall_top(items(t)).select("id", "company", "product", "intelligence_score")
)

query("j9_similar_items", ITEMS + """
    , best AS (SELECT industry, id, company, intelligence_score, row_number() OVER (PARTITION BY industry ORDER BY intelligence_score DESC, company, id) AS rk
               FROM items WHERE is_active AND intelligence_score IS NOT NULL AND industry IS NOT NULL),
    pairs AS (SELECT i.id, b.id AS similar_id, b.company AS similar_company, b.intelligence_score AS similar_score,
                     row_number() OVER (PARTITION BY i.id ORDER BY b.rk) AS position
              FROM items i JOIN best b ON b.industry = i.industry AND b.id <> i.id AND b.rk <= 10)
    SELECT * FROM pairs WHERE position <= 3""")(
    lambda t: hub.similar_items(items(t))
)
