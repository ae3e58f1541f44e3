"""Grouped registry summaries: one operator, one specification per summary."""

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import LIST_SEPARATOR
from ledgerloom.operators.ordered import top_n
from ledgerloom.sources.sinks import written


@dataclass(frozen=True)
class Summary:
    """``keys`` and measures map output names to input columns; lists also carry their limit."""

    keys: dict
    rows: str
    unique: dict = field(default_factory=dict)
    lists: dict = field(default_factory=dict)
    least: dict = field(default_factory=dict)
    greatest: dict = field(default_factory=dict)
    flags: dict = field(default_factory=dict)
    first: dict = field(default_factory=dict)
    where_filled: str = ""
    evidence: str = ""
    #: Further columns by SQL expressions over the summary's own.
    derived: dict = field(default_factory=dict)


def fill(template):
    """``{column}`` placeholders to a concatenation."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.col(p).cast("string") if i % 2 else F.lit(p) for i, p in enumerate(parts) if p or i % 2])


def group_key(columns):
    """128 bits for the values of some columns; null is a value of its own."""
    parts = [F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string"))) for c in columns]
    return F.unhex(F.md5(F.concat(*parts)))


#: Buckets of groups that are counted first; a group in one with more rows goes the way of huge groups.
BUCKETS, HUGE = 1 << 16, 20_000


def summarise(df: DataFrame, spec: Summary, order, late=None, huge=HUGE) -> DataFrame:
    """Group rows by the keys. ``df`` is read three times, so it should be a written table.

    Groups in buckets of at most ``huge`` rows are shuffled once as they are, and each is summed up
    where it lies. The others aggregate map-side, and their distinct counts and value lists work on one
    de-duplicated (group, measure, value) table, so the values of a huge group spread over the cluster,
    and a limited list never brings more than its limit per group and task together.

    ``late`` maps key columns to (column, expression): what follows from another key column is left out of
    the grouping and of ``df``, and worked out once for each group.
    """
    late = _late(spec, order, late)
    rows = df.filter(F.col(spec.where_filled) != "") if spec.where_filled else df
    grouped = [c for c in dict.fromkeys(spec.keys.values()) if c not in late]
    measures = [c for c in _inputs(spec, order) if c not in grouped]
    base = rows.select(*[F.col(c).alias(f"_k_{c}") for c in grouped], *[F.col(c).alias(f"_in_{c}") for c in measures])
    both = {f"_in_{c}": F.col(f"_k_{c}") for c in _inputs(spec, order) if c in grouped}
    keys = [f"_k_{c}" for c in grouped]
    if spec.unique or spec.lists:
        bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("_bucket")
        crowded = written(base.groupBy(bucket).count().filter(F.col("count") > huge).select("_bucket"))
        dealt = base.select("*", bucket)
        small = dealt.join(crowded, "_bucket", "left_anti").drop("_bucket")
        large = dealt.join(crowded, "_bucket", "left_semi").drop("_bucket")
        result = _in_place(small, keys, both, spec, order).unionByName(_spread(large, keys, both, spec, order))
    else:
        result = _spread(base, keys, both, spec, order)
    named = result.withColumnsRenamed({f"_k_{c}": c for c in grouped})
    whole = named.select(*[(late[c] if c in late else F.col(c)).alias(o) for o, c in spec.keys.items()], *[c for c in result.columns if c not in keys])
    whole = whole.select("*", *[F.expr(e).alias(o) for o, e in spec.derived.items()])
    if spec.evidence:
        whole = whole.withColumn("evidence_text", fill(spec.evidence))
    return whole


def _late(spec, order, late):
    """The expressions of key columns that nothing else uses and that follow from another key column."""
    used = {*_inputs(spec, order), spec.where_filled}
    return {c: e for c, (source, e) in (late or {}).items() if c in spec.keys.values() and source in spec.keys.values() and c not in used}


def _plain(spec, order):
    """Counts, bounds, flags and firsts."""
    return [
        F.count("*").alias(spec.rows),
        *[F.min(f"_in_{c}").alias(o) for o, c in spec.least.items()],
        *[F.max(f"_in_{c}").alias(o) for o, c in spec.greatest.items()],
        *[F.count_if(f"_in_{c}").alias(o) for o, c in spec.flags.items()],
        *[F.min_by(f"_in_{c}", F.struct(*[f"_in_{o}" for o in order])).alias(o_) for o_, c in spec.first.items()],
    ]


def _measured(spec):
    """Columns whose distinct values are counted or listed."""
    return list(dict.fromkeys([*spec.unique.values(), *[c for c, _ in spec.lists.values()]]))


def _lists(spec, limited):
    return {o: (c, n) for o, (c, n) in spec.lists.items() if bool(n) == limited}


def _in_place(base, keys, both, spec, order):
    """Groups of bounded size: one shuffle of the rows, then sets of values."""
    moved = base.repartition(*keys).withColumns({"_hash": F.xxhash64(*keys), **both})  # the hash first, so that sorting compares numbers
    sets = [F.collect_set(F.col(f"_in_{c}").cast("string")).alias(f"_set_{c}") for c in _measured(spec)]
    plain = moved.groupBy("_hash", *keys).agg(*_plain(spec, order), *sets)

    def listed(c, n):
        values = F.array_sort(F.filter(f"_set_{c}", lambda x: x != ""))
        return F.array_join(F.slice(values, 1, n) if n else values, LIST_SEPARATOR)

    return plain.select("*", *[F.size(f"_set_{c}").cast("long").alias(o) for o, c in spec.unique.items()],
                        *[listed(c, n).alias(o) for limited in (False, True) for o, (c, n) in _lists(spec, limited).items()]
                        ).drop("_hash", *[f"_set_{c}" for c in _measured(spec)])


def _spread(base, keys, both, spec, order):
    """Groups of any size, by one short key; the keys themselves are shuffled once."""
    base = base.select(group_key([F.col(k) for k in keys]).alias("_g"), "*").withColumns(both)
    result = base.groupBy("_g").agg(*[F.first(k).alias(k) for k in keys], *_plain(spec, order))
    return (_with_distincts(base, result, spec) if spec.unique or spec.lists else result).drop("_g")


def _inputs(spec, order):
    used = [*_measured(spec), *spec.least.values(), *spec.greatest.values(), *spec.flags.values(), *spec.first.values(), *(order if spec.first else ())]
    return list(dict.fromkeys(used))


def source_columns(spec, order, late=None):
    """Input columns a summary needs."""
    late = _late(spec, order, late)
    filled = [spec.where_filled] if spec.where_filled else []
    return list(dict.fromkeys([*[c for c in spec.keys.values() if c not in late], *_inputs(spec, order), *filled]))


def _with_distincts(base, plain, spec):
    sources = _measured(spec)
    code = {c: i for i, c in enumerate(sources)}
    pairs = F.array(*[F.struct(F.lit(code[c]).alias("_m"), F.col(f"_in_{c}").cast("string").alias("_v")) for c in sources])
    distinct = base.select("_g", F.inline(pairs)).filter("_v IS NOT NULL").distinct()
    result = plain
    limited = _lists(spec, True)
    unlimited = {o: c for o, (c, _) in _lists(spec, False).items()}
    filled = F.when(F.col("_v") != "", F.col("_v"))
    whole = [F.count_if(F.col("_m") == code[c]).alias(o) for o, c in spec.unique.items()]
    whole += [_list(F.when(F.col("_m") == code[c], filled)).alias(o) for o, c in unlimited.items()]
    if whole:
        result = result.join(distinct.groupBy("_g").agg(*whole), "_g", "left").fillna(0, subset=list(spec.unique))
    if limited:
        ids = [code[c] for c, _ in limited.values()]
        most = max(n for _, n in limited.values())
        head = top_n(distinct.filter((F.col("_v") != "") & F.col("_m").isin(ids)), ["_g", "_m"], [F.asc("_v")], most, "_rank")
        lists = head.groupBy("_g").agg(*[
            _list(F.when((F.col("_m") == code[c]) & (F.col("_rank") <= n), F.col("_v"))).alias(o)
            for o, (c, n) in limited.items()
        ])
        result = result.join(lists, "_g", "left")
    return result.fillna("", subset=list(spec.lists)) if spec.lists else result


def _list(value):
    return F.array_join(F.array_sort(F.collect_list(value)), LIST_SEPARATOR)


def flag_summary(df: DataFrame, flags, name, country) -> DataFrame:
    """Long form of boolean columns: rows, unique names and countries per flag; empty flags stay.

    ``flags`` maps (code, label) to a boolean column.
    """
    spark = df.sparkSession
    listed = spark.range(1).select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("standard_code"), F.lit(l).alias("standard_label")) for c, l in flags]))
    )
    long = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("standard_code"), F.col(f).alias("_on")) for (c, _), f in flags.items()])),
        F.col(name).alias("_name"), F.col(country).alias("_country"),
    ).filter("_on").drop("_on")
    spec = Summary(keys={"standard_code": "standard_code"}, rows="brand_rows",
                   unique={"unique_brand_names": "_name"}, lists={"countries": ("_country", None)})
    counted = summarise(written(long), spec, ["_name"])
    joined = listed.join(counted, "standard_code", "left").fillna(0).fillna("", subset=["countries"])
    return joined.withColumn(
        "evidence_text", fill("{standard_label} has {brand_rows} brand row(s) in the directory."))


def run_metadata(df: DataFrame, label, entity, flags=(), reported_total=None) -> DataFrame:
    """One row about one registry: extracted rows, unique entities, coverage of a reported total."""
    total = F.lit(reported_total).cast("bigint")
    return df.agg(
        F.count("*").alias("rows_extracted"),
        F.count_distinct(F.col(entity)).alias("unique_entities"),
        *[F.count_if(f).alias(f"{f}_rows") for f in flags],
    ).select(
        F.lit(label).alias("certification"), "*", total.alias("reported_total"),
        F.round(F.try_divide(F.col("rows_extracted") * 100.0, total), 2).alias("coverage_percent"),
    )


MASTER_SUMMARY = Summary(
    keys={"certification": "certification", "evidence_level": "evidence_level"},
    rows="rows",
    unique={
        "unique_entities": "certified_entity_name_normalized_strict",
        "unique_companies": "certified_company_normalized_strict",
        "unique_brands": "certified_brand_normalized_strict",
        "unique_products": "certified_product_normalized_strict",
    },
    lists={"source_files": ("source_file", 20)},
)

_ORG = {"organization_name": "company", "organization_name_normalized": "company_norm"}
_COMPANY = {"company_name": "company", "company_name_normalized": "company_norm"}
_COUNTRY = {"country": "country", "country_normalized": "country_norm"}
_PAGES = {"least": {"first_source_page": "page"}, "greatest": {"last_source_page": "page"}}
_URL = {"source_url": "url"}

# One specification per registry summary, over the columns of the registry row view.
SUMMARIES = {
    "a2_eu_companies": Summary(
        keys={**_COMPANY, "company_country": "country", "vat_number": "vat"}, rows="certified_product_rows",
        unique={"unique_product_names": "product_norm", "unique_licences": "licence"},
        lists={"product_groups": ("category", None), "licence_numbers": ("licence", None)},
        least={"earliest_expiration": "expiry"}, greatest={"latest_expiration": "expiry"},
        flags={"active_certificates": "active"}, first={**_URL, "source_file": "file"}, derived={"is_company_currently_active": "active_certificates > 0"},
        evidence="{company_name} has {certified_product_rows} EU Ecolabel product rows across {unique_licences} licence(s). Groups: {product_groups}",
    ),
    "a3_eu_licences": Summary(
        keys={"licence_number": "licence", "licence_number_normalized": "licence_norm", **_COMPANY,
              "company_country": "country", "vat_number": "vat", "group_name": "category",
              "group_name_normalized": "category_norm", "decision": "level", "expiration_date": "date_text",
              "expiration_date_parsed": "expiry", "is_certificate_active": "active"},
        rows="certified_product_rows", unique={"unique_product_names": "product_norm"},
        lists={"code_types": ("status", None), "code_values": ("claim", 50)},
        first={"extract_date": "date_text", **_URL, "source_file": "file"},
        evidence="Licence {licence_number} for {company_name} covers {certified_product_rows} product rows in {group_name}.",
    ),
    "a4_eu_product_groups": Summary(
        keys={"group_name": "category", "group_name_normalized": "category_norm"}, rows="certified_product_rows",
        unique={"unique_product_names": "product_norm", "unique_companies": "company_norm", "unique_licences": "licence"},
        lists={"countries": ("country", None)}, flags={"active_product_rows": "active"}, first={**_URL, "source_file": "file"},
        evidence="{group_name} contains {certified_product_rows} EU Ecolabel product rows, {unique_companies} companies and {unique_licences} licences.",
    ),
    "a5_grs_companies": Summary(
        keys={**_COMPANY, **_COUNTRY, "web": "domain"}, rows="grs_rows",
        unique={"unique_certificates": "licence_norm"},
        lists={"product_categories": ("category", None), "certificate_numbers": ("licence", None)},
        first={"source_file_name": "file"}, **_PAGES,
        evidence="{company_name} appears in {grs_rows} GRS row(s), with {unique_certificates} unique certificate(s). Product categories: {product_categories}",
    ),
    "a6_grs_certificates": Summary(
        keys={"certificate_number": "licence", "certificate_number_normalized": "licence_norm", **_COMPANY, **_COUNTRY},
        rows="grs_rows",
        lists={"product_categories": ("category", None), "first_issue_dates": ("date_text", None),
               "revision_dates": ("revised", None), "expiring_dates": ("expiry_text", None), "grs_versions": ("claim", None)},
        first={"source_file_name": "file"}, **_PAGES,
        evidence="{certificate_number} for {company_name} appears in {grs_rows} row(s). Product categories: {product_categories}",
    ),
    "a7_grs_categories": Summary(
        keys={"product_category_raw": "category", "product_category_it": "category_norm", "product_category_en": "claim"},
        rows="grs_rows", unique={"unique_companies": "company_norm", "unique_certificates": "licence_norm"},
        lists={"countries": ("country", None)}, first={"source_file_name": "file"}, **_PAGES,
        evidence="{product_category_raw} contains {grs_rows} GRS row(s), {unique_companies} unique companies and {unique_certificates} unique certificates.",
    ),
    "a8_epd_organizations": Summary(
        keys={**_ORG, "geographical_scope": "country", "geographical_scope_normalized": "country_norm"}, rows="epd_rows",
        unique={"unique_epd_numbers": "licence_norm"},
        lists={"products": ("product", 120), "product_categories": ("category", 80), "epd_types": ("claim", 40), "epd_numbers": ("licence", 120)},
        first=_URL,
        evidence="{organization_name} appears in {epd_rows} EPD row(s), with {unique_epd_numbers} unique EPD number(s).",
    ),
    "a9_epd_categories": Summary(
        keys={"product_category": "category", "product_category_normalized": "category_norm"}, rows="epd_rows",
        unique={"unique_organizations": "company_norm", "unique_epd_numbers": "licence_norm"},
        lists={"organization_names": ("company", 150)}, first=_URL,
        evidence="{product_category} appears in {epd_rows} EPD row(s), with {unique_organizations} unique organization(s).",
    ),
    "a10_epd_types": Summary(
        keys={"epd_type": "claim", "epd_type_normalized": "claim_norm"}, rows="epd_rows",
        unique={"unique_organizations": "company_norm", "unique_epd_numbers": "licence_norm"}, first=_URL,
        evidence="{epd_type} appears in {epd_rows} EPD row(s), with {unique_organizations} unique organization(s).",
    ),
    "a11_fsc_organizations": Summary(
        keys={**_ORG, "country_area": "country", "country_area_normalized": "country_norm"}, rows="fsc_rows",
        unique={"unique_licences": "licence_norm", "unique_certificate_codes": "claim_norm"},
        lists={"licence_codes": ("licence", 80), "certificate_codes": ("claim", 80), "roles": ("level", 30),
               "site_statuses": ("status", 30), "states_provinces": ("domain", 80), "valid_to_values": ("date_text", 80)},
        first=_URL,
        evidence="{organization_name} appears in {fsc_rows} FSC row(s), with {unique_licences} licence(s) and {unique_certificate_codes} certificate code(s).",
    ),
    "a12_fsc_countries": Summary(
        keys={"country_area": "country", "country_area_normalized": "country_norm"}, rows="fsc_rows",
        unique={"unique_organizations": "company_norm", "unique_licences": "licence_norm"},
        lists={"organization_names": ("company", 100)}, first=_URL,
        evidence="{country_area} has {fsc_rows} FSC row(s), {unique_organizations} organization(s) and {unique_licences} licence(s).",
    ),
    "a13_green_circle_companies": Summary(
        keys={**_COMPANY, "location": "country", "location_normalized": "country_norm"}, rows="green_circle_rows",
        unique={"unique_certificates": "licence_norm"},
        lists={"products": ("product", 120), "product_types": ("category", 80), "certification_claims": ("claim", 80), "certificate_ids": ("licence", 80)},
        first=_URL,
        evidence="{company_name} appears in {green_circle_rows} GreenCircle product row(s), with {unique_certificates} unique certificate id(s).",
    ),
    "a14_green_circle_claims": Summary(
        keys={"certification_claim": "claim", "certification_claim_normalized": "claim_norm"}, rows="product_rows",
        unique={"unique_companies": "company_norm", "unique_certificates": "licence_norm"},
        lists={"product_types": ("category", 100), "company_names": ("company", 120)}, first=_URL,
        evidence="{certification_claim} appears in {product_rows} GreenCircle product row(s), covering {unique_companies} unique company name(s).",
    ),
    "a15_green_circle_types": Summary(
        keys={"product_type": "category", "product_type_normalized": "category_norm"}, rows="product_rows",
        unique={"unique_companies": "company_norm"},
        lists={"certification_claims": ("claim", 80), "company_names": ("company", 120)}, first=_URL,
        evidence="{product_type} appears in {product_rows} GreenCircle product row(s), covering {unique_companies} unique company name(s).",
    ),
    "a16_gots_suppliers": Summary(
        keys={**_COMPANY, **_COUNTRY}, rows="supplier_rows",
        lists={"product_categories": ("category", 100), "brand_names": ("brand", 100), "detail_urls": ("url", 30)}, first=_URL,
        evidence="{company_name} appears in {supplier_rows} GOTS certified supplier row(s). Product categories: {product_categories}",
    ),
    "a17_b_corp_since": Summary(
        keys={"certified_since": "date_text"}, rows="company_rows", lists={"company_names": ("company", 80)}, first=_URL,
        evidence="{company_rows} B Corp company row(s) have certified_since='{certified_since}'.",
    ),
    "a18_peta_compliance": Summary(
        keys={"compliance_code": "level", "compliance_label": "status"}, rows="company_rows",
        unique={"unique_company_names": "company_norm"}, lists={"company_names": ("company", 150)},
        flags={"linked_companies": "linked"}, first=_URL,
        evidence="{company_rows} company row(s) have compliance_code='{compliance_code}' and compliance_label='{compliance_label}'.",
    ),
    "a19_peta_domains": Summary(
        keys={"website_domain": "domain"}, rows="company_rows", unique={"unique_company_names": "company_norm"},
        lists={"company_names": ("company", 80)}, first=_URL, where_filled="domain",
        evidence="{website_domain} appears for {company_rows} company row(s).",
    ),
    "a20_fair_for_life_countries": Summary(
        keys={"country_or_region": "country"}, rows="partner_rows", unique={"unique_partners": "company_norm"},
        lists={"labels": ("claim", None), "partner_names": ("company", 50)}, first=_URL,
        evidence="{country_or_region} has {partner_rows} Fair for Life / For Life partner row(s).",
    ),
    "a21_ewg_brands": Summary(
        keys={"brand_guess": "brand", "brand_guess_normalized": "brand_norm"}, rows="certified_product_rows",
        lists={"product_names": ("product", 30), "product_urls": ("url", 30)}, first=_URL, where_filled="brand_norm",
        evidence="{brand_guess} appears in {certified_product_rows} EWG Verified product row(s).",
    ),
    "a22_oeko_countries": Summary(
        keys={"country_id": "country_id", "country_name": "country", "country_name_normalized": "country_norm"},
        rows="total_brand_rows", unique={"unique_brand_names": "company_norm"},
        flags={"made_in_green_brand_rows": "linked", "standard100_brand_rows": "active"},
        lists={"brand_names": ("company", 80)}, first=_URL,
        evidence="{country_name} has {total_brand_rows} OEKO-TEX brand row(s), including {made_in_green_brand_rows} MADE IN GREEN brand row(s).",
    ),
}
