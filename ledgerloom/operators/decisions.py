"""Usage mode, direct and supplier decisions, keep rule, best and top candidates, no-match rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions import text
from ledgerloom.operators.ordered import top_n

# Review texts.
REASON_PRODUCT_UNSURE = "Registry is product-level. Company is strong, but product name is not strong enough."
REASON_COMPANY_UNSURE = "Product looks similar, but company/entity match is not strong enough."
REASON_SHORT = "Name is short or potentially ambiguous; confidence reduced."
REASON_SHORT_FUZZY = "High fuzzy match, but one of the names is short/ambiguous."
REASON_POSSIBLE = "Possible company/brand match. Manual review recommended."
REASON_SUPPLIER = (
    "This is a supplier-oriented registry. This row should not be treated as direct product/company certification "
    "unless a buyer-supplier relationship is later verified."
)
REASON_SUPPLIER_PRODUCT = "Product/entity looks potentially related in a supplier-oriented registry. Supplier relationship must be verified."
REASON_SUPPLIER_FUZZY = "Possible supplier-side product/entity candidate. Not a direct certification match."


def _strict_keys(names):
    """Strict forms of the fixed certification names (ASCII, driver side)."""
    legal = set(text.suffix_tokens())
    keys = set()
    for name in names:
        words = "".join(ch if ch.isalnum() else " " for ch in name.lower()).split()
        keys.add(" ".join(w for w in words if w not in legal))
    return sorted(keys)


def usage_mode(certification, level) -> Column:
    by_level = (
        F.when(text.match_key(level).isin("supplier", "organization", "organization certificate"), "supplier_oriented_registry")
        .otherwise("direct_registry")
    )
    return text.bound(text.strict_key(certification), lambda key: (
        F.when(key.isin(_strict_keys(fixed.SUPPLIER_ORIENTED_CERTIFICATIONS)), "supplier_oriented_registry")
        .when(key.isin(_strict_keys(fixed.DIRECT_ORIENTED_CERTIFICATIONS)), "direct_registry")
        .otherwise(by_level)))


def _outcome(decision, claim, confidence, score, method, reason="") -> Column:
    as_text = lambda v: v if isinstance(v, Column) else F.lit(v)
    score = score if isinstance(score, Column) else F.lit(float(score))
    return F.struct(
        as_text(decision).alias("decision"), as_text(claim).alias("site_claim_type"),
        as_text(confidence).alias("confidence"), F.round(score, 2).alias("final_score"),
        as_text(method).alias("match_method"), as_text(reason).alias("review_reason"),
    )


YES, REVIEW, SUPPLIER, NO = "Direct Yes", "Direct Review", "Supplier Candidate", "No"
PRODUCT, COMPANY = "product_certified", "company_or_brand_certified"
MAYBE_PRODUCT, MAYBE_COMPANY = "possible_product_certification", "possible_company_or_brand_certification"
MAYBE_SUPPLIER = "possible_certified_supplier_entity"


def _none():
    best = F.greatest("company_score", "product_score", "domain_score")
    return _outcome(NO, "none", "", best, F.col("hint"))


def direct_decision() -> Column:
    """Outcome for direct registries over company_score, product_score, domain_score, the exact
    flags, short_name, evidence_level, has_product and hint."""
    c, p, d = F.col("company_score"), F.col("product_score"), F.col("domain_score")
    entity, product, short = F.col("entity_exact_match"), F.col("product_exact_match"), F.col("short_name")
    by_product = (
        F.when((d == 100) & product, _outcome(YES, PRODUCT, "High", 100, "domain_and_product_exact"))
        .when(entity & product, _outcome(YES, PRODUCT, "High", 98, "company_exact_and_product_exact"))
        .when((c >= 95) & (p >= 85), _outcome(YES, PRODUCT, "High", c * 0.55 + p * 0.45, "company_high_fuzzy_and_product_high_fuzzy"))
        .when((c >= 90) & (p >= 75), _outcome(YES, PRODUCT, "Medium", c * 0.55 + p * 0.45, "company_medium_fuzzy_and_product_medium_fuzzy"))
        .when((c >= 95) & F.col("has_product"), _outcome(REVIEW, MAYBE_PRODUCT, "Medium", c * 0.65 + p * 0.35, "company_high_but_product_uncertain", REASON_PRODUCT_UNSURE))
        .when((p >= 90) & (c >= 75), _outcome(REVIEW, MAYBE_PRODUCT, "Medium", c * 0.45 + p * 0.55, "product_high_but_company_uncertain", REASON_COMPANY_UNSURE))
        .otherwise(_none())
    )
    by_company = (
        F.when(d == 100, _outcome(YES, COMPANY, "High", 100, "domain_exact"))
        .when(entity, _outcome(YES, COMPANY, "High", 100, "company_or_brand_exact_normalized"))
        .when((c >= 97) & ~short, _outcome(YES, COMPANY, "High", c, "company_or_brand_very_high_fuzzy"))
        .when(c >= 97, _outcome(YES, COMPANY, "Medium", c, "company_or_brand_very_high_fuzzy", REASON_SHORT))
        .when((c >= 93) & short, _outcome(REVIEW, MAYBE_COMPANY, "Low", c, "company_or_brand_high_fuzzy", REASON_SHORT_FUZZY))
        .when(c >= 93, _outcome(YES, COMPANY, "Medium", c, "company_or_brand_high_fuzzy"))
        .when(c >= 86, _outcome(REVIEW, MAYBE_COMPANY, "Medium", c, "company_or_brand_possible_fuzzy", REASON_POSSIBLE))
        .otherwise(_none())
    )
    return F.when(F.lower("evidence_level") == "product", by_product).otherwise(by_company)


def supplier_decision() -> Column:
    """Outcome for supplier-oriented registries over the same columns."""
    c, p, d = F.col("company_score"), F.col("product_score"), F.col("domain_score")
    method = lambda name: f"supplier_oriented_registry_{name}"
    blend = c * 0.45 + p * 0.55
    return (
        F.when(d == 100, _outcome(YES, COMPANY, "High", 100, method("domain_exact")))
        .when(F.col("entity_exact_match"), _outcome(YES, COMPANY, "High", 100, method("company_exact")))
        .when((c >= 98) & ~F.col("short_name"), _outcome(YES, COMPANY, "Medium", c, method("very_high_company_fuzzy")))
        .when(c >= 88, _outcome(SUPPLIER, MAYBE_SUPPLIER, F.when(c >= 93, "Medium").otherwise("Low"), c, method("company_candidate"), REASON_SUPPLIER))
        .when(F.col("product_exact_match") & (c >= 70), _outcome(SUPPLIER, MAYBE_SUPPLIER, "Low", blend, method("product_candidate"), REASON_SUPPLIER_PRODUCT))
        .when((p >= 88) & (c >= 60), _outcome(SUPPLIER, MAYBE_SUPPLIER, "Low", blend, method("product_fuzzy_candidate"), REASON_SUPPLIER_FUZZY))
        .otherwise(_none())
    )


#: Company score below which a product row's decision depends on equal products alone, once domains match.
LEAST_COMPANY = 75


def open_by_domain() -> Column:
    """Whether a row's decision depends on names though the domains match: product rows of direct registries. All others then
    have one outcome."""
    return (F.col("registry_usage_mode") != "supplier_oriented_registry") & (F.lower("evidence_level") == "product")


def decide(pairs: DataFrame, keep_no_from=80.0) -> DataFrame:
    """Add the outcome columns; "No" rows stay only from ``keep_no_from`` up."""
    is_supplier = F.col("registry_usage_mode") == "supplier_oriented_registry"
    outcome = F.when(is_supplier, supplier_decision()).otherwise(direct_decision())
    # A generator keeps the optimiser from copying the whole cascade into every use of its columns.
    decided = pairs.select(*pairs.columns, F.inline(F.array(outcome)))
    return decided.filter((F.col("decision") != NO) | (F.col("final_score") >= keep_no_from))


def _priority(column, values) -> Column:
    chain = F.when(F.col(column) == values[0][0], values[0][1])
    for name, rank in values[1:]:
        chain = chain.when(F.col(column) == name, rank)
    return chain.otherwise(0)


def decision_rank():
    return _priority("decision", [(YES, 5), (REVIEW, 4), (SUPPLIER, 3), (NO, 1)])


def confidence_rank():
    return _priority("confidence", [("High", 3), ("Medium", 2), ("Low", 1)])


def best_candidates(decided: DataFrame, keys, position) -> DataFrame:
    """Best candidate per key; ties keep the insertion position."""
    order = [F.desc(decision_rank()), F.desc(confidence_rank()), F.desc("final_score"), F.desc("company_score"),
             F.desc("product_score"), F.desc("domain_score"), *[F.asc(p) for p in position]]
    return top_n(decided, keys, order, 1, "_rank").drop("_rank")


def top_candidates(decided: DataFrame, keys, position, n=5) -> DataFrame:
    order = [F.desc(decision_rank()), F.desc(confidence_rank()), F.desc("final_score"), *[F.asc(p) for p in position]]
    return top_n(decided, keys, order, n, "candidate_rank")


NO_MATCH = {
    "registry_usage_mode": "", "decision": NO, "site_claim_type": "none", "confidence": "",
    "final_score": 0.0, "match_method": "no_candidate_found", "review_reason": "",
    "company_score": 0.0, "product_score": 0.0, "domain_score": 0.0,
    "entity_exact_match": False, "product_exact_match": False,
}


def complete_pairs(items: DataFrame, key, certifications) -> DataFrame:
    """Every (item, certification): the certification list is spread on each row, no join."""
    names = F.array(*[F.lit(c) for c in certifications])
    return items.select(key).distinct().select(key, F.explode(names).alias("certification"))


def with_no_match_rows(best: DataFrame, items: DataFrame, key, certifications) -> DataFrame:
    """One row per item and certification; pairs without a kept candidate say so."""
    full = complete_pairs(items, key, certifications).join(best, [key, "certification"], "left")
    return full.fillna({n: v for n, v in NO_MATCH.items() if n in best.columns})


def certification_names(registry: DataFrame):
    """Sorted certification names: one for each scheme, whatever the number of rows."""
    return sorted(r[0] for r in registry.select("certification").filter("certification <> ''").distinct().collect())


def matching_summary(best: DataFrame, key="configurator_id") -> DataFrame:
    return best.groupBy("certification", "registry_usage_mode", "decision", "confidence").agg(
        F.count("*").alias("rows"),
        F.count_distinct(F.col(key)).alias("unique_configurators"),
        F.round(F.avg("final_score"), 2).alias("average_final_score"),
    )


#: Columns of a best match from which the wide fields are made.
CELL = ["decision", "site_claim_type", "matched_evidence_level", "confidence", "match_method", "matched_registry_entity",
        "matched_registry_product", "final_score", "evidence_text", "review_reason"]


def _wide_fields(cell):
    value = lambda n: cell.getField(n)
    decision = value("decision")
    direct, supplier = decision.isin(YES, REVIEW), decision == SUPPLIER
    keep = lambda test, name, default="": F.when(test, value(name)).otherwise(default)
    return {
        "Direct Certification Status": F.when(decision == YES, "Yes").when(decision == REVIEW, "Review").otherwise("No"),
        "Direct Claim Type": keep(direct, "site_claim_type"),
        "Direct Evidence Level": keep(direct, "matched_evidence_level"),
        "Direct Confidence": keep(direct, "confidence"),
        "Direct Match Method": keep(direct, "match_method"),
        "Direct Matched Entity": keep(direct, "matched_registry_entity"),
        "Direct Matched Product": keep(direct, "matched_registry_product"),
        "Direct Match Score": keep(direct, "final_score", 0.0),
        "Direct Evidence": keep(direct, "evidence_text"),
        "Supplier Candidate": F.when(supplier, "Yes").otherwise("No"),
        "Supplier Candidate Entity": keep(supplier, "matched_registry_entity"),
        "Supplier Candidate Score": keep(supplier, "final_score", 0.0),
        "Supplier Candidate Reason": keep(supplier, "review_reason"),
    }


def enriched_wide(best: DataFrame, certifications, key="configurator_id", catalogue=None) -> DataFrame:
    """The catalogue's columns (``catalogue``, with the same key), or the key alone, and 13 columns per certification.

    One narrow struct per certification is pivoted, and its fields are made afterwards; the pivot values
    are given, so Spark needs no extra pass to find them. Without a best match a cell says "No".
    """
    packed = best.select(key, "certification", F.struct(*CELL).alias("cell"))
    pivoted = packed.groupBy(key).pivot("certification", list(certifications)).agg(F.first("cell"))
    if catalogue is not None:
        pivoted = catalogue.join(pivoted, key, "left")
    kept = catalogue.columns if catalogue is not None else [key]
    return pivoted.select(*kept, *[v.alias(f"{cert} {name}") for cert in certifications for name, v in _wide_fields(F.col(f"`{cert}`")).items()])
