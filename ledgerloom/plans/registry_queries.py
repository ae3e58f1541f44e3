"""Registry queries: resolution, standardisation, dedup, grouped summaries."""

import re

from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions import text
from ledgerloom.operators import registry, registry_keys, summaries
from ledgerloom.operators.ordered import keep_first
from ledgerloom.plans import check_sql as c
from ledgerloom.plans.catalog import query
from ledgerloom.sources.sinks import written

ORDER = ("src_ordinal", "src_tie")
AS_OF = "1998-06-01"

_MESSY = {"p_brand": "Brand Name", "p_name": " PRODUCT-NAME ", "p_type": "Type / Utilisation", "p_size": "Certificate Id (new)", "p_retailprice": "Evidence Text"}
query("p1_schema_resolver", f"""
    SELECT p_partkey, '' AS certified_company, {c.clean('p_brand')} AS certified_brand, {c.clean('p_name')} AS certified_product,
           {c.clean('p_type')} AS product_category, '' AS country_or_scope, '' AS certification_claim_or_standard,
           {c.clean('p_size')} AS certificate_identifier, '' AS source_url, {c.clean('p_retailprice')} AS evidence_text, '' AS match_level FROM @part""")(
    lambda t: registry.resolve_schema(t.part.select("p_partkey", *[F.col(k).alias(v) for k, v in _MESSY.items()]),
                                      fixed.REGISTRY_COLUMN_CANDIDATES, keep=["p_partkey"])
)

# --- standardised registry, written once for the checks ------------------------------------------
_NAME_TEXT = "lower(split_part(source_file, '/', 2) || ' ' || split_part(source_file, '/', 1) || ' ' || source_sheet)"
_LEVEL = f"""CASE WHEN match_level <> '' THEN match_level WHEN {c.any_hit(_NAME_TEXT, ['product', 'epd', 'declaration'])} THEN 'product'
    WHEN contains({_NAME_TEXT}, 'brand') THEN 'brand' WHEN contains({_NAME_TEXT}, 'supplier') THEN 'supplier'
    WHEN {c.any_hit(_NAME_TEXT, ['partner', 'company', 'companies'])} THEN 'company' ELSE 'unknown' END"""
_EVIDENCE = """CASE WHEN contains(lower(lv), 'product') OR contains(lower(lv), 'declaration') OR product <> '' THEN 'product'
    WHEN contains(lower(lv), 'brand') OR brand <> '' THEN 'brand' WHEN contains(lower(lv), 'supplier') THEN 'supplier' ELSE 'company' END"""
MASTER = f"""
    WITH cleaned AS (
        SELECT *, {c.clean('certified_company')} AS company, {c.clean('certified_brand')} AS brand, {c.clean('certified_product')} AS product, {_LEVEL} AS lv FROM a_registry),
    leveled AS (SELECT *, {_EVIDENCE} AS ev, CASE WHEN company <> '' THEN company WHEN brand <> '' THEN brand ELSE product END AS entity FROM cleaned),
    master AS (
        SELECT src_ordinal, src_tie, certification, ev AS evidence_level, lv AS registry_match_level_raw,
               CASE WHEN ev = 'product' THEN 'product_or_product_plus_company_match' ELSE 'company_or_brand_match' END AS applies_to_configurator_product_by,
               entity AS certified_entity_name, CASE WHEN company <> '' THEN 'company' WHEN brand <> '' THEN 'brand' WHEN product <> '' THEN 'product' ELSE '' END AS certified_entity_type,
               {c.strict('entity')} AS certified_entity_name_normalized_strict, company AS certified_company,
               {c.key('company')} AS certified_company_normalized, {c.strict('company')} AS certified_company_normalized_strict,
               brand AS certified_brand, {c.strict('brand')} AS certified_brand_normalized_strict,
               product AS certified_product, {c.strict('product')} AS certified_product_normalized_strict,
               product_category, {c.key('product_category')} AS product_category_normalized, country_or_scope, certification_claim_or_standard,
               certificate_identifier, source_url, source_file, source_sheet, src_ordinal + 2 AS source_row_number, {c.clean('evidence_text')} AS evidence_text
        FROM leveled)"""
_DROPPED = ["master_record_id", "certification_full_name", "certified_entity_name_normalized", "certified_brand_normalized",
            "certified_product_normalized", "country_or_scope_normalized", "created_at_utc"]


def master(t):
    return registry.standardise(t.a_registry, ORDER)


query("p8_standardised_registry", MASTER + "SELECT * FROM master")(lambda t: master(t).drop(*_DROPPED))

query("p9_levels", MASTER + "SELECT src_ordinal, src_tie, registry_match_level_raw, evidence_level, applies_to_configurator_product_by FROM master")(
    lambda t: master(t).select(*ORDER, "registry_match_level_raw", "evidence_level", "applies_to_configurator_product_by")
)

query("p10_certification_by_file", """
    WITH r AS (SELECT source_file, CASE WHEN certification = 'Mystery Label' THEN 'Certification Claim' ELSE certification END AS v,
                      row_number() OVER (PARTITION BY source_file ORDER BY src_ordinal, src_tie) AS rn FROM a_registry)
    SELECT source_file, CASE WHEN arg_min(v, rn) = 'Certification Claim' THEN 'N' ELSE arg_min(v, rn) END AS certification FROM r WHERE rn <= 20 GROUP BY 1""")(
    lambda t: registry.infer_certification(
        t.a_registry.select("source_file", *ORDER, F.when(F.col("certification") == "Mystery Label", "Certification Claim").otherwise(F.col("certification")).alias("Certification Name")), ORDER)
)

query("p11_special_case_filter", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM @lineitem
    WHERE l_linenumber % 3 <> 1 AND (l_linenumber % 3 <> 0 OR l_returnflag = 'R')""")(
    lambda t: registry.special_case_rows(t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        F.when(F.col("l_returnflag") == "R", " Yes ").otherwise("no").alias("has_made_in_green"), F.lit("csv").alias("source_sheet"),
        F.when(F.col("l_linenumber") % 3 == 0, "x/oeko_made_in_green.csv").when(F.col("l_linenumber") % 3 == 1, "x/Standard100.csv").otherwise("x/gots.csv").alias("source_file"),
    )).drop("has_made_in_green", "source_sheet", "source_file")
)

query("p17_certificate_validity", f"""
    WITH d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'soon' ELSE substr(cast(o_orderdate AS varchar), 1, 10) END AS x FROM @orders)
    SELECT o_orderkey, coalesce(cast(try_cast(x AS date) AS varchar), '') AS expiry, coalesce(try_cast(x AS date) >= DATE '{AS_OF}', false)::int AS is_active,
           coalesce(try_cast(x AS date) - DATE '{AS_OF}', -99999) AS days_left FROM d""")(
    lambda t: registry.certificate_validity(
        t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 10 == 0, "soon").otherwise(F.substring(F.col("o_orderdate").cast("string"), 1, 10)).alias("x")), "x", "x", AS_OF)
    .select("o_orderkey", F.coalesce(F.col("expiration_date_parsed").cast("string"), F.lit("")).alias("expiry"),
            F.col("is_certificate_active").cast("int").alias("is_active"), F.coalesce("days_until_expiration", F.lit(-99999)).alias("days_left"))
)

# --- union and dedup ----------------------------------------------------------------------------
query("u1_union_registries", """
    SELECT src_ordinal, src_tie, source_file, certified_company, certified_product FROM a_registry WHERE source_file LIKE '%product%'
    UNION ALL SELECT src_ordinal, src_tie, source_file, certified_company, '' FROM a_registry WHERE source_file NOT LIKE '%product%'""")(
    lambda t: registry.union_registries([
        t.a_registry.filter("source_file LIKE '%product%'").select(*ORDER, "source_file", "certified_company", "certified_product"),
        t.a_registry.filter("source_file NOT LIKE '%product%'").select(*ORDER, "source_file", "certified_company"),
    ])
)


def _first_of(keys):
    return f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY src_ordinal, src_tie) AS rn"


query("w1_dedup_master", MASTER + f", r AS (SELECT *, {_first_of(registry.MASTER_DEDUP)} FROM master) SELECT src_ordinal, src_tie, certification, evidence_level, certified_entity_name, certificate_identifier FROM r WHERE rn = 1")(
    lambda t: registry.master_registry([master(t)], ORDER).select(*ORDER, "certification", "evidence_level", "certified_entity_name", "certificate_identifier")
)

# Key sets of the single registries.
DEDUP_KEYS = {
    "eu_products": ["product_norm", "company_norm", "licence", "status", "claim"],
    "oeko_brands": ["brand", "url", "claim", "country"],
    "bluesign_brands": ["company_norm", "country"],
    "blue_angel_products": ["url", "category"],
    "product_pages": ["url"],
    "partner_labels": ["company", "country", "claim"],
}

ROWS = f"""
    WITH rows_view AS (
        SELECT src_ordinal, src_tie, certification, {c.clean("CASE WHEN certified_company <> '' THEN certified_company ELSE certified_brand END")} AS company,
               country_or_scope AS country, {c.clean('certified_product')} AS product, product_category AS category, certificate_identifier AS licence,
               certification_claim_or_standard AS claim, match_level AS level, source_sheet || ' ' || match_level AS status, quantity AS page, date_text,
               CASE WHEN quantity % 7 = 0 THEN '' ELSE date_text END AS revised, date_text AS expiry_text, date_text AS expiry, date_text >= '{AS_OF}' AS active,
               source_url AS url, {c.domain('source_url')} AS domain, source_file AS file, certified_brand AS brand, country_id,
               concat('V', cast(country_id AS string)) AS vat, quantity % 2 = 0 AS linked FROM a_registry),
    reg AS (SELECT *, {c.key('company')} AS company_norm, {c.key('country')} AS country_norm, {c.key('product')} AS product_norm, {c.key('category')} AS category_norm,
               {c.key('licence')} AS licence_norm, {c.key('claim')} AS claim_norm, {c.key('brand')} AS brand_norm FROM rows_view)"""


NORMALISED = ("company", "country", "product", "category", "licence", "claim", "brand")


def rows_view(t):
    rows = t.a_registry.select(
        *ORDER, "certification",
        text.clean(F.when(F.col("certified_company") != "", F.col("certified_company")).otherwise(F.col("certified_brand"))).alias("company"),
        F.col("country_or_scope").alias("country"), text.clean("certified_product").alias("product"), F.col("product_category").alias("category"),
        F.col("certificate_identifier").alias("licence"), F.col("certification_claim_or_standard").alias("claim"), F.col("match_level").alias("level"),
        F.concat_ws(" ", "source_sheet", "match_level").alias("status"), F.col("quantity").alias("page"), "date_text",
        F.when(F.col("quantity") % 7 == 0, "").otherwise(F.col("date_text")).alias("revised"), F.col("date_text").alias("expiry_text"),
        F.col("date_text").alias("expiry"), (F.col("date_text") >= AS_OF).alias("active"), F.col("source_url").alias("url"),
        text.domain_of("source_url").alias("domain"), F.col("source_file").alias("file"), F.col("certified_brand").alias("brand"), "country_id",
        F.concat(F.lit("V"), F.col("country_id")).alias("vat"), (F.col("quantity") % 2 == 0).alias("linked"),
    )
    return rows.withColumns({f"{n}_norm": text.match_key(n) for n in NORMALISED})


for _name, _keys in DEDUP_KEYS.items():
    query(f"w1_dedup_{_name}", ROWS + f", r AS (SELECT *, {_first_of(_keys)} FROM reg) SELECT src_ordinal, src_tie, company, product, licence FROM r WHERE rn = 1")(
        lambda t, keys=_keys: keep_first(rows_view(t).select(*ORDER, *dict.fromkeys(["company", "product", "licence", *keys])), keys, list(ORDER)).select(*ORDER, "company", "product", "licence")
    )

# --- keys of the single registries ---------------------------------------------------------------
# Where each key column comes from in the registry rows; repeated values are wanted, so that rows fall together.
KEY_COLUMNS = {
    "company_name": "company", "organization_name": "company", "partner_name": "company", "brand_name": "brand", "product_name": "product", "product_category_raw": "category", "product_category": "category",
    "product_process_description": "product", "country": "country", "country_area": "country", "state_province": "level", "location": "country", "location_text": "country", "certificate_number": "licence", "licence": "licence",
    "certificate_code": "licence", "certificate_id": "licence", "epd_number": "licence", "role": "level", "site_status": "status", "product_type": "category", "certification_claim": "claim", "standards_raw": "claim", "source_page": "page",
    "effective_date": "date_text", "expiration_date": "expiry", "certified_since": "date_text", "product_url": "url", "detail_url": "url", "profile_url": "url", "website_url": "url", "partner_url": "url", "more_info_url": "url",
    "compliance_code": "level", "country_id": "country_id", "source_file": "file",
}


def _key_columns(registry):
    return [n.removeprefix("normalised ") for n in fixed.REGISTRY_KEYS[registry][1]]


def _key_sql(registry):
    return "sha256(" + " || '|' || ".join(c.key(n.removeprefix("normalised ")) if n.startswith("normalised ") else c.clean(n) for n in fixed.REGISTRY_KEYS[registry][1]) + ")"


# a third of the rows come with a key of their own, that several rows share, and a third without any
GIVEN = "CASE src_ordinal % 3 WHEN 0 THEN concat(' k', page, ' ') WHEN 1 THEN '' ELSE NULL END"


def _keyed_rows(t, registry):
    own = [F.col(KEY_COLUMNS[n]).alias(n) for n in dict.fromkeys(_key_columns(registry))]
    return rows_view(t).select(*ORDER, *own, F.expr(GIVEN).alias(fixed.REGISTRY_KEYS[registry][0]))


def _keyed_sql(registry):
    own = ", ".join(f"{KEY_COLUMNS[n]} AS {n}" for n in dict.fromkeys(_key_columns(registry)))
    return ROWS + f", kr AS (SELECT {', '.join(ORDER)}, {own}, {GIVEN} AS {fixed.REGISTRY_KEYS[registry][0]} FROM reg)"


for _name in fixed.REGISTRY_KEYS:
    query(f"p5_key_{_name}", _keyed_sql(_name) + f" SELECT {', '.join(ORDER)}, {_key_sql(_name)} AS computed_key FROM kr")(
        lambda t, r=_name: registry_keys.with_key(_keyed_rows(t, r), r).select(*ORDER, F.col(fixed.REGISTRY_KEYS[r][0]).alias("computed_key"))
    )
for _name, _given in (("grs", False), ("fsc", True), ("gots", True), ("green_circle", True), ("epd", True)):
    _column = fixed.REGISTRY_KEYS[_name][0]
    _anew = "sha256(" + " || '|' || ".join(c.clean(n) for n in [*dict.fromkeys(_key_columns(_name)), _column]) + ")" if _name in fixed.WHOLE_ROW_KEYS else _key_sql(_name)
    _own = f"coalesce(nullif({c.clean(_column)}, ''), {_anew})" if _given else _key_sql(_name)
    query(f"w1_dedup_{_name}_records", _keyed_sql(_name) + f", d AS (SELECT *, {_own} AS whole_key FROM kr), r AS (SELECT *, {_first_of(['whole_key'])} FROM d) SELECT {', '.join(ORDER)}, coalesce({_column}, '') AS given_key FROM r WHERE rn = 1")(
        lambda t, r=_name, g=_given, k=_column: registry_keys.deduplicated(_keyed_rows(t, r), r, ORDER, g).select(*ORDER, F.coalesce(k, F.lit("")).alias("given_key"))
    )

# --- grouped summaries --------------------------------------------------------------------------


def _evidence_sql(template):
    return " || ".join(f"cast({p} AS varchar)" if i % 2 else c.quoted([p]) for i, p in enumerate(re.split(r"\{(\w+)\}", template)) if p)


def summary_sql(spec, source):
    parts = [f"{s} AS {o}" for o, s in spec.keys.items()] + [f"count(*) AS {spec.rows}"]
    parts += [f"count(DISTINCT {s}) AS {o}" for o, s in spec.unique.items()]
    parts += [f"{c.first_n(s, n, s + chr(60) + chr(62) + chr(39) + chr(39))} AS {o}" for o, (s, n) in spec.lists.items()]
    parts += [f"min({s}) AS {o}" for o, s in spec.least.items()] + [f"max({s}) AS {o}" for o, s in spec.greatest.items()]
    parts += [f"count(*) FILTER (WHERE {s}) AS {o}" for o, s in spec.flags.items()]
    parts += [f"arg_min({s}, (src_ordinal, src_tie)) AS {o}" for o, s in spec.first.items()]
    where = f"WHERE {spec.where_filled} <> ''" if spec.where_filled else ""
    inner = f"SELECT {', '.join(parts)} FROM {source} {where} GROUP BY {', '.join(spec.keys.values())}"
    if spec.derived:
        inner = f"SELECT *, {', '.join(f'({e})::int AS {o}' for o, e in spec.derived.items())} FROM ({inner})"
    return f"SELECT *, {_evidence_sql(spec.evidence)} AS evidence_text FROM ({inner})" if spec.evidence else inner


def following():
    """Columns of the registry rows that follow from another one."""
    return {f"{n}_norm": (n, text.match_key(n)) for n in NORMALISED} | {
        "expiry": ("date_text", F.col("date_text")), "expiry_text": ("date_text", F.col("date_text")), "active": ("date_text", F.col("date_text") >= AS_OF)}


def stored(rows, spec, late=None):
    """The columns a summary reads, with their keys computed once."""
    return written(rows.select(*summaries.source_columns(spec, ORDER, late)))


for _name, _spec in summaries.SUMMARIES.items():
    query(_name, ROWS + summary_sql(_spec, "reg"))(
        lambda t, spec=_spec: summaries.summarise(stored(rows_view(t), spec, following()), spec, ORDER, following()).withColumns({o: F.col(o).cast("int") for o in spec.derived})
    )

query("a23_flag_groups", ROWS + """
    SELECT code AS standard_code, label AS standard_label, count(*) FILTER (WHERE flag) AS brand_rows, count(DISTINCT company_norm) FILTER (WHERE flag) AS unique_brand_names,
           coalesce(array_to_string(list_sort(list(DISTINCT country) FILTER (WHERE flag)), ' | '), '') AS countries,
           label || ' has ' || cast(count(*) FILTER (WHERE flag) AS varchar) || ' brand row(s) in the directory.' AS evidence_text
    FROM (SELECT 'mig' AS code, 'MADE IN GREEN' AS label, linked AS flag, company_norm, country FROM reg
          UNION ALL SELECT 'std100', 'STANDARD 100', active, company_norm, country FROM reg) GROUP BY 1, 2""")(
    lambda t: summaries.flag_summary(rows_view(t), {("mig", "MADE IN GREEN"): "linked", ("std100", "STANDARD 100"): "active"}, "company_norm", "country")
)

query("a24_master_summary", MASTER + summary_sql(summaries.MASTER_SUMMARY, "master"))(
    lambda t: summaries.summarise(stored(master(t), summaries.MASTER_SUMMARY), summaries.MASTER_SUMMARY, ORDER)
)

query("a28_run_metadata", ROWS + """
    SELECT 'GOTS' AS certification, count(*) AS rows_extracted, count(DISTINCT company_norm) AS unique_entities, count(*) FILTER (WHERE active) AS active_rows,
           count(*) FILTER (WHERE linked) AS linked_rows, 20000 AS reported_total, round(count(*) * 100.0 / 20000, 2) AS coverage_percent FROM reg WHERE certification = 'GOTS'
    UNION ALL SELECT 'Bluesign', count(*), count(DISTINCT company_norm), count(*) FILTER (WHERE active), count(*) FILTER (WHERE linked), 15000, round(count(*) * 100.0 / 15000, 2)
    FROM reg WHERE certification = 'Bluesign'""")(
    lambda t: summaries.run_metadata(rows_view(t).filter("certification = 'GOTS'"), "GOTS", "company_norm", ("active", "linked"), 20000)
    .unionByName(summaries.run_metadata(rows_view(t).filter("certification = 'Bluesign'"), "Bluesign", "company_norm", ("active", "linked"), 15000))
)
