"""Matching queries: blocking, features, decisions, best rows, summaries, the whole audit."""

from pyspark.sql import functions as F

from ledgerloom.functions import text
from ledgerloom.operators import blocking, decisions, matching
from ledgerloom.operators import registry as reg
from ledgerloom.plans import check_sql as c
from ledgerloom.plans.catalog import query

ORDER = ("src_ordinal", "src_tie")
CERTIFICATIONS = ["B Corp", "Bluesign", "EU Ecolabel", "Fair for Life", "GOTS", "Mystery Label"]


def items(t):
    return matching.prepare_items(t.a_configurators)


def registry(t):
    return matching.prepare_registry(reg.standardise(t.a_registry, ORDER, stamp="-"))


_ENTITY = f"CASE WHEN {c.clean('certified_company')} <> '' THEN certified_company WHEN {c.clean('certified_brand')} <> '' THEN certified_brand ELSE certified_product END"
SIDES = f"""
    WITH cat AS (SELECT id, {c.strict('company')} AS company_strict, {c.strict('product')} AS product_strict,
                        list_distinct(list_filter([{c.domain('configurator_url')}, {c.domain('alternative_url')}, {c.domain('database_detail_url')}], lambda h: h <> '')) AS domains FROM a_configurators),
    r0 AS (SELECT src_ordinal, src_tie, certification, {c.strict(_ENTITY)} AS entity_strict, {c.strict('certified_product')} AS registry_product_strict, {c.domain('source_url')} AS registry_domain FROM a_registry),
    r AS (SELECT *, {c.matchable('registry_domain')} AS domain_matchable FROM r0)"""

query("j1_exact_name_blocks", SIDES + """
    , j AS (SELECT id, certification, src_ordinal, src_tie FROM cat JOIN r ON company_strict = entity_strict WHERE company_strict <> '')
    SELECT id, certification, count(*) AS registry_rows, (min((src_ordinal, src_tie)))[1] AS first_ordinal, (min((src_ordinal, src_tie)))[2] AS first_tie FROM j GROUP BY 1, 2""")(
    lambda t: matching.exact_blocks(items(t), registry(t), "company_strict", "entity_strict")
)

query("j2_domain_blocks", SIDES + """
    , d AS (SELECT id, unnest(domains) AS h FROM cat),
    j AS (SELECT id, certification, src_ordinal, src_tie FROM d JOIN r ON h = registry_domain WHERE domain_matchable)
    SELECT id, certification, count(*) AS registry_rows, (min((src_ordinal, src_tie)))[1] AS first_ordinal, (min((src_ordinal, src_tie)))[2] AS first_tie FROM j GROUP BY 1, 2""")(
    lambda t: matching.exact_blocks(items(t).select("id", F.explode("domains").alias("domain")), registry(t), "domain", "registry_domain", text.is_matchable_domain)
)


def _names(t, item_key, registry_key, cutoff):
    choices = registry(t).filter(F.col(registry_key) != "").select("certification", F.col(registry_key).alias("name")).distinct()
    left = items(t).filter(F.col(item_key) != "").select(F.col(item_key).alias("name")).distinct()
    pairs = blocking.similar_names(left, choices.select("name").distinct())
    return blocking.best_names(pairs, choices, cutoff).withColumn("score", F.round("score", 2))


query("j3_fuzzy_company_names")(lambda t: _names(t, "company_strict", "entity_strict", 80))
query("j4_fuzzy_product_names")(lambda t: _names(t, "product_strict", "registry_product_strict", 82))

query("j5_merged_candidates", """
    WITH x AS (SELECT l_partkey AS item, l_orderkey AS record, l_linenumber % 4 + 1 AS stage, cast(l_quantity AS int) AS stage_rank,
               CASE l_linenumber % 4 WHEN 0 THEN 'company_or_brand_exact_normalized' WHEN 1 THEN 'domain_exact' WHEN 2 THEN 'company_or_brand_fuzzy_candidate' ELSE 'product_fuzzy_candidate' END AS hint,
               CASE l_linenumber % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 4 END AS strength FROM @lineitem)
    SELECT item, record, arg_min(hint, strength) AS hint, (min((stage, stage_rank)))[1] AS stage, (min((stage, stage_rank)))[2] AS stage_rank FROM x GROUP BY 1, 2""")(
    lambda t: matching.merge_candidates(t.lineitem.select(
        F.col("l_partkey").alias("item"), F.col("l_orderkey").alias("record"), (F.col("l_linenumber") % 4 + 1).alias("stage"), F.col("l_quantity").cast("int").alias("stage_rank"),
        F.element_at(F.array(*[F.lit(matching.HINTS[i]) for i in (1, 0, 2, 3)]), F.col("l_linenumber") % 4 + 1).alias("hint")), ["item", "record"], [])
)

_SHORT = c.short_name
query("e1_exact_features", SIDES + f"""
    , p AS (SELECT *, list_sort(domains) AS ds FROM cat), pairs AS (SELECT DISTINCT company_strict, product_strict, ds, certification, entity_strict, registry_product_strict, registry_domain, domain_matchable
            FROM p JOIN r ON company_strict = entity_strict WHERE company_strict <> '')
    SELECT company_strict, product_strict, array_to_string(ds, ' | ') AS domain_list, certification, registry_product_strict, registry_domain,
           true AS entity_exact_match, product_strict <> '' AND product_strict = registry_product_strict AS product_exact_match,
           CASE WHEN domain_matchable AND list_contains(ds, registry_domain) THEN 100.0 ELSE 0.0 END AS domain_score,
           {_SHORT('company_strict')} AS short_name FROM pairs""")(
    lambda t: matching.pair_features(
        matching.exact_candidates(matching.item_profiles(items(t).withColumn("domains", F.array_sort("domains"))),
                                  registry(t).select("certification", "entity_strict", "registry_product_strict", "registry_domain", "domain_matchable", "entity_short").distinct()),
        score=lambda a, b: F.when(F.col(a) == F.col(b), 100.0).otherwise(0.0))
    .select("company_strict", "product_strict", text.encode_list("domains").alias("domain_list"), "certification", "registry_product_strict", "registry_domain",
            "entity_exact_match", "product_exact_match", "domain_score", "short_name")
)

# Pairs of representatives; the two queries after it tell whom they represent.
query("e1_pair_scores")(lambda t: matching.class_pairs(items(t), registry(t)).select(
    "profile", "certification", "master_record_id", "hint", "company_strict", "entity_strict", "product_strict", "registry_product_strict",
    "company_score", "product_score", "domain_score", "entity_exact_match", "product_exact_match", "short_name", "profile_items", "evidence_rows"))
query("e1_item_members")(lambda t: matching.item_members(items(t)))
query("e1_evidence_members")(lambda t: matching.evidence_members(registry(t)))

_MODE = """CASE WHEN certification IN ('GOTS', 'Bluesign', 'Fair for Life') THEN 'supplier_oriented_registry'
    WHEN certification IN ('B Corp', 'EU Ecolabel') THEN 'direct_registry' WHEN evidence_level = 'supplier' THEN 'supplier_oriented_registry' ELSE 'direct_registry' END"""
query("e2_usage_mode", f"SELECT src_ordinal, src_tie, {_MODE} AS registry_usage_mode FROM a_scored")(
    lambda t: t.a_scored.select(*ORDER, decisions.usage_mode("certification", "evidence_level").alias("registry_usage_mode"))
)


def _arms(arms):
    """(condition, decision, claim, confidence, score, method, reason) rows as one CASE per column."""
    columns = ["decision", "site_claim_type", "confidence", "final_score", "match_method", "review_reason"]
    return {n: [(a[0], a[i + 1]) for a in arms] for i, n in enumerate(columns)}


_B1, _B2, _B3 = "c * 0.55 + p * 0.45", "c * 0.65 + p * 0.35", "c * 0.45 + p * 0.55"
_PR, _CO, _MP, _MC, _MS = "product_certified", "company_or_brand_certified", "possible_product_certification", "possible_company_or_brand_certification", "possible_certified_supplier_entity"
_S = "supplier_oriented_registry_"
_RULES = [
    ("sup AND d = 100", "Direct Yes", _CO, "High", "100", _S + "domain_exact", ""),
    ("sup AND ee", "Direct Yes", _CO, "High", "100", _S + "company_exact", ""),
    ("sup AND c >= 98 AND NOT s", "Direct Yes", _CO, "Medium", "c", _S + "very_high_company_fuzzy", ""),
    ("sup AND c >= 93", "Supplier Candidate", _MS, "Medium", "c", _S + "company_candidate", decisions.REASON_SUPPLIER),
    ("sup AND c >= 88", "Supplier Candidate", _MS, "Low", "c", _S + "company_candidate", decisions.REASON_SUPPLIER),
    ("sup AND pe AND c >= 70", "Supplier Candidate", _MS, "Low", _B3, _S + "product_candidate", decisions.REASON_SUPPLIER_PRODUCT),
    ("sup AND p >= 88 AND c >= 60", "Supplier Candidate", _MS, "Low", _B3, _S + "product_fuzzy_candidate", decisions.REASON_SUPPLIER_FUZZY),
    ("NOT sup AND pl AND d = 100 AND pe", "Direct Yes", _PR, "High", "100", "domain_and_product_exact", ""),
    ("NOT sup AND pl AND ee AND pe", "Direct Yes", _PR, "High", "98", "company_exact_and_product_exact", ""),
    ("NOT sup AND pl AND c >= 95 AND p >= 85", "Direct Yes", _PR, "High", _B1, "company_high_fuzzy_and_product_high_fuzzy", ""),
    ("NOT sup AND pl AND c >= 90 AND p >= 75", "Direct Yes", _PR, "Medium", _B1, "company_medium_fuzzy_and_product_medium_fuzzy", ""),
    ("NOT sup AND pl AND c >= 95 AND hp", "Direct Review", _MP, "Medium", _B2, "company_high_but_product_uncertain", decisions.REASON_PRODUCT_UNSURE),
    ("NOT sup AND pl AND p >= 90 AND c >= 75", "Direct Review", _MP, "Medium", _B3, "product_high_but_company_uncertain", decisions.REASON_COMPANY_UNSURE),
    ("NOT sup AND NOT pl AND d = 100", "Direct Yes", _CO, "High", "100", "domain_exact", ""),
    ("NOT sup AND NOT pl AND ee", "Direct Yes", _CO, "High", "100", "company_or_brand_exact_normalized", ""),
    ("NOT sup AND NOT pl AND c >= 97 AND s", "Direct Yes", _CO, "Medium", "c", "company_or_brand_very_high_fuzzy", decisions.REASON_SHORT),
    ("NOT sup AND NOT pl AND c >= 97", "Direct Yes", _CO, "High", "c", "company_or_brand_very_high_fuzzy", ""),
    ("NOT sup AND NOT pl AND c >= 93 AND s", "Direct Review", _MC, "Low", "c", "company_or_brand_high_fuzzy", decisions.REASON_SHORT_FUZZY),
    ("NOT sup AND NOT pl AND c >= 93", "Direct Yes", _CO, "Medium", "c", "company_or_brand_high_fuzzy", ""),
    ("NOT sup AND NOT pl AND c >= 86", "Direct Review", _MC, "Medium", "c", "company_or_brand_possible_fuzzy", decisions.REASON_POSSIBLE),
]
_DEFAULTS = {"decision": "'No'", "site_claim_type": "'none'", "confidence": "''", "final_score": "greatest(c, p, d)", "match_method": "hint", "review_reason": "''"}


def _cases():
    out = []
    for name, arms in _arms(_RULES).items():
        value = (lambda v: v) if name == "final_score" else (lambda v: c.quoted([v]))
        chain = " ".join(f"WHEN {test} THEN {value(v)}" for test, v in arms)
        text_ = f"CASE {chain} ELSE {_DEFAULTS[name]} END"
        out.append(f"round({text_}, 2) AS {name}" if name == "final_score" else f"{text_} AS {name}")
    return ", ".join(out)


DECIDED = f"""
    WITH short_names AS (SELECT *, {_MODE} AS registry_usage_mode, company_score AS c, product_score AS p, domain_score AS d, entity_exact_match AS ee, product_exact_match AS pe,
                  short_name AS s, has_product AS hp, evidence_level = 'product' AS pl FROM a_scored),
    flagged AS (SELECT *, registry_usage_mode = 'supplier_oriented_registry' AS sup FROM short_names),
    every AS (SELECT *, {_cases()} FROM flagged),
    decided AS (SELECT * FROM every WHERE decision <> 'No' OR final_score >= 80),
    ranked AS (SELECT *, CASE decision WHEN 'Direct Yes' THEN 5 WHEN 'Direct Review' THEN 4 WHEN 'Supplier Candidate' THEN 3 ELSE 1 END AS dr,
                      CASE confidence WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 WHEN 'Low' THEN 1 ELSE 0 END AS cr FROM decided),
    b AS (SELECT *, row_number() OVER (PARTITION BY configurator_id, certification ORDER BY dr DESC, cr DESC, final_score DESC, c DESC, p DESC, d DESC, stage, src_ordinal, src_tie) AS best_rank,
                 row_number() OVER (PARTITION BY configurator_id, certification ORDER BY dr DESC, cr DESC, final_score DESC, stage, src_ordinal, src_tie) AS candidate_rank FROM ranked),
    ids AS (SELECT p_partkey + 1 AS configurator_id, unnest(['{"', '".join(CERTIFICATIONS)}']) AS certification FROM @part),
    best AS (SELECT ids.configurator_id, ids.certification, coalesce(registry_usage_mode, '') AS registry_usage_mode, coalesce(decision, 'No') AS decision, coalesce(site_claim_type, 'none') AS site_claim_type,
                    coalesce(confidence, '') AS confidence, coalesce(final_score, 0) AS final_score, coalesce(match_method, 'no_candidate_found') AS match_method, coalesce(review_reason, '') AS review_reason,
                    coalesce(evidence_level, '') AS matched_evidence_level, coalesce(matched_registry_entity, '') AS matched_registry_entity, coalesce(matched_registry_product, '') AS matched_registry_product
             FROM ids LEFT JOIN b ON b.configurator_id = ids.configurator_id AND b.certification = ids.certification AND best_rank = 1)"""
_OUT = "decision, site_claim_type, confidence, final_score, match_method, review_reason"


def decided(t, keep=80.0):
    return decisions.decide(t.a_scored.withColumn("registry_usage_mode", decisions.usage_mode("certification", "evidence_level")), keep)


_POS = ["stage", "src_ordinal", "src_tie"]
_KEYS = ["configurator_id", "certification"]


def best(t):
    chosen = decisions.best_candidates(decided(t), _KEYS, _POS).withColumnRenamed("evidence_level", "matched_evidence_level")
    full = decisions.with_no_match_rows(chosen, t.part.select((F.col("p_partkey") + 1).alias("configurator_id")), "configurator_id", CERTIFICATIONS)
    return full.fillna("", subset=["matched_evidence_level", "matched_registry_entity", "matched_registry_product"])


query("e3_direct_decision", DECIDED + f"SELECT src_ordinal, src_tie, {_OUT} FROM every WHERE NOT sup")(
    lambda t: decided(t, -1.0).filter("registry_usage_mode = 'direct_registry'").select(*ORDER, *_OUT.split(", "))
)
query("e4_supplier_decision", DECIDED + f"SELECT src_ordinal, src_tie, {_OUT} FROM every WHERE sup")(
    lambda t: decided(t, -1.0).filter("registry_usage_mode = 'supplier_oriented_registry'").select(*ORDER, *_OUT.split(", "))
)
query("e5_kept_candidates", DECIDED + "SELECT src_ordinal, src_tie, decision, final_score FROM decided")(
    lambda t: decided(t).select(*ORDER, "decision", "final_score")
)
query("w2_best_candidate", DECIDED + f"SELECT configurator_id, certification, src_ordinal, src_tie, {_OUT} FROM b WHERE best_rank = 1")(
    lambda t: decisions.best_candidates(decided(t), _KEYS, _POS).select(*_KEYS, *ORDER, *_OUT.split(", "))
)
query("w3_top_candidates", DECIDED + "SELECT configurator_id, certification, candidate_rank, src_ordinal, src_tie, decision, final_score FROM b WHERE candidate_rank <= 5")(
    lambda t: decisions.top_candidates(decided(t), _KEYS, _POS).select(*_KEYS, "candidate_rank", *ORDER, "decision", "final_score")
)
query("j6_no_match_rows", DECIDED + f"SELECT configurator_id, certification, registry_usage_mode, {_OUT} FROM best")(
    lambda t: best(t).select(*_KEYS, "registry_usage_mode", *_OUT.split(", "))
)
query("a25_matching_summary", DECIDED + """
    SELECT certification, registry_usage_mode, decision, confidence, count(*) AS rows, count(DISTINCT configurator_id) AS unique_configurators, round(avg(final_score), 2) AS average_final_score
    FROM best GROUP BY 1, 2, 3, 4""")(lambda t: decisions.matching_summary(best(t)))


def _wide_sql():
    direct, sup = "decision IN ('Direct Yes', 'Direct Review')", "decision = 'Supplier Candidate'"
    fields = {
        "Direct Certification Status": ("CASE decision WHEN 'Direct Yes' THEN 'Yes' WHEN 'Direct Review' THEN 'Review' ELSE 'No' END"),
        "Direct Claim Type": f"CASE WHEN {direct} THEN site_claim_type ELSE '' END", "Direct Evidence Level": f"CASE WHEN {direct} THEN matched_evidence_level ELSE '' END",
        "Direct Confidence": f"CASE WHEN {direct} THEN confidence ELSE '' END", "Direct Match Method": f"CASE WHEN {direct} THEN match_method ELSE '' END",
        "Direct Matched Entity": f"CASE WHEN {direct} THEN matched_registry_entity ELSE '' END", "Direct Matched Product": f"CASE WHEN {direct} THEN matched_registry_product ELSE '' END",
        "Direct Match Score": f"CASE WHEN {direct} THEN final_score ELSE 0 END", "Direct Evidence": f"CASE WHEN {direct} THEN concat(matched_registry_entity, ' ', matched_registry_product) ELSE '' END",
        "Supplier Candidate": f"CASE WHEN {sup} THEN 'Yes' ELSE 'No' END", "Supplier Candidate Entity": f"CASE WHEN {sup} THEN matched_registry_entity ELSE '' END",
        "Supplier Candidate Score": f"CASE WHEN {sup} THEN final_score ELSE 0 END", "Supplier Candidate Reason": f"CASE WHEN {sup} THEN review_reason ELSE '' END",
    }
    picks = [f"max({v}) FILTER (WHERE certification = '{cert}') AS \"{cert} {n}\"" for cert in CERTIFICATIONS for n, v in fields.items()]
    wide = f"SELECT configurator_id, {', '.join(picks)} FROM best GROUP BY 1"
    return DECIDED + f"SELECT p_name, p_brand, p_type, w.* FROM @part JOIN ({wide}) w ON p_partkey + 1 = configurator_id"


query("a31_enriched_wide", _wide_sql())(
    lambda t: decisions.enriched_wide(best(t).withColumn("evidence_text", F.concat_ws(" ", "matched_registry_entity", "matched_registry_product"))
                                      .withColumn("evidence_text", F.when(F.col("decision").isin("Direct Yes", "Direct Review"), F.col("evidence_text")).otherwise("")), CERTIFICATIONS,
                                      catalogue=t.part.select((F.col("p_partkey") + 1).alias("configurator_id"), "p_name", "p_brand", "p_type"))
)

query("e6_best_match_audit")(lambda t: matching.best_matches(items(t), registry(t), CERTIFICATIONS, stamp="-"))
query("e6_candidate_audit")(lambda t: matching.candidate_matches(items(t), registry(t), stamp="-"))
