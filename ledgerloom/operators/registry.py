"""Registry tables: header resolution, keys, standardisation to the master schema, dedup."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions import rules, text
from ledgerloom.functions.text import clean, col
from ledgerloom.operators.ordered import keep_first, top_n, union_all


def with_match_keys(df: DataFrame, names, strict=False, is_clean=False) -> DataFrame:
    """Add ``<name>_normalized`` and, if asked, ``<name>_normalized_strict``."""
    keyed = df.withColumns({f"{n}_normalized": text.match_key(n, is_clean) for n in names})
    if strict:
        keyed = keyed.withColumns(
            {f"{n}_normalized_strict": text.drop_legal_tokens(f"{n}_normalized") for n in names}
        )
    return keyed


def resolve_columns(headers, candidates):
    """Canonical name -> source header or None. Headers only; no data is read.

    An exact match of folded names wins in candidate order; failing that, the first candidate that
    is contained in a header. The first header keeps a folded name.
    """
    known = {}
    for header in headers:
        known.setdefault(text.column_key(header), header)
    known.pop("", None)
    chosen = {}
    for canonical, names in candidates.items():
        keys = [k for k in map(text.column_key, names) if k]
        exact = next((known[k] for k in keys if k in known), None)
        partial = next((h for k in keys for folded, h in known.items() if k in folded), None)
        chosen[canonical] = exact or partial
    return chosen


def _quoted(header):
    return F.col("`" + header.replace("`", "``") + "`")


def resolve_schema(df: DataFrame, candidates, keep=()) -> DataFrame:
    """One select into canonical columns; those without a source become empty text."""
    chosen = resolve_columns([c for c in df.columns if c not in keep], candidates)
    return df.select(
        *keep, *[(clean(_quoted(h)) if h else F.lit("")).alias(n) for n, h in chosen.items()]
    )


def source_names(file, sheet) -> Column:
    """File, folder and sheet name in lower case."""
    parts = F.split(col(file), "/")
    folder = F.coalesce(F.get(parts, F.size(parts) - 2), F.lit(""))
    return F.lower(F.concat_ws(" ", F.element_at(parts, -1), folder, col(sheet)))


def level_from_names(names) -> Column:
    """Match level told by the source names."""
    return rules.first_match(
        names,
        [
            (["product", "epd", "declaration"], "product"),
            (["brand"], "brand"),
            (["supplier"], "supplier"),
            (["partner", "company", "companies"], "company"),
            (["organization", "organisation"], "organization"),
            (["certificate_rows", "certificate row"], "organization_certificate"),
            (["made_in_green"], "brand"),
        ],
        "unknown",
    )


def evidence_level(level, product, brand) -> Column:
    name = F.lower(col(level))
    return (
        F.when(rules.contains_any(name, ["product", "declaration"]) | (col(product) != ""), "product")
        .when(F.contains(name, F.lit("brand")) | (col(brand) != ""), "brand")
        .when(F.contains(name, F.lit("supplier")), "supplier")
        .otherwise("company")
    )


def applies_by(level) -> Column:
    return F.when(col(level) == "product", "product_or_product_plus_company_match").otherwise("company_or_brand_match")


def path_certification(file) -> Column:
    """First path keyword found; else the folder name in title case."""
    path = F.lower(col(file))
    parts = F.split(col(file), "/")
    folder = F.initcap(F.translate(F.coalesce(F.get(parts, F.size(parts) - 2), F.lit("")), "_-", "  "))
    return rules.first_match(path, [([k], v) for k, v in fixed.PATH_CERTIFICATIONS.items()], folder)


def infer_certification(df: DataFrame, order, file="source_file") -> DataFrame:
    """Certification per source file: a name column's first filled value among the first 20 rows,
    unless it is a header word; else the path."""
    files = df.select(file).distinct().withColumn("_by_path", path_certification(file))
    result, guesses = files, []
    for number, name in enumerate(fixed.CERTIFICATION_NAME_COLUMNS):
        source = resolve_columns(df.columns, {"c": [name]})["c"]
        if source is None:
            continue
        # Only 20 rows per file reach the shuffle.
        head = top_n(
            df.select(file, *order, _quoted(source).alias("_value")).filter("_value IS NOT NULL"), file,
            [F.asc(o) for o in order], 20,
        ).withColumn("_value", clean("_value")).filter("_value <> ''")
        first = head.groupBy(file).agg(F.min_by("_value", "rank").alias(f"_g{number}"))
        result = result.join(first, file, "left")
        guess = F.col(f"_g{number}")
        guesses.append(F.when(~F.lower(guess).isin(fixed.CERTIFICATION_HEADER_WORDS), guess))
    return result.select(file, F.coalesce(*guesses, F.col("_by_path")).alias("certification"))


def special_case_rows(df: DataFrame, file="source_file", sheet="source_sheet") -> DataFrame:
    """Label-check tables keep only made-in-green rows; tables named standard100 are emptied."""
    path, tab = F.lower(col(file)), F.lower(col(sheet))
    keep = ~(F.contains(path, F.lit("standard100")) | F.contains(tab, F.lit("standard100")))
    flag = resolve_columns(df.columns, {"flag": ["has_made_in_green"]})["flag"]
    if flag:
        is_label_table = F.contains(path, F.lit("oeko")) & F.contains(path, F.lit("made"))
        yes = F.coalesce(F.lower(F.trim(_quoted(flag))).isin("true", "1", "yes", "y"), F.lit(False))
        keep = keep & (~is_label_table | yes)
    return df.filter(keep)


def standardise(df: DataFrame, order=("src_ordinal",), stamp=None) -> DataFrame:
    """Any registry table with certification, source_file, source_sheet and order columns to the
    master schema. The order columns are kept after the master columns."""
    keep = ["certification", "source_file", "source_sheet", *order]
    rows = resolve_schema(special_case_rows(df), fixed.REGISTRY_COLUMN_CANDIDATES, keep)
    has_any = rules.any_of([
        F.col(c) != "" for c in ("certified_company", "certified_brand", "certified_product", "certificate_identifier", "source_url")
    ])
    rows = rows.filter(has_any).withColumn("certification", clean("certification"))
    rows = rows.withColumn("_names", source_names("source_file", "source_sheet"))
    level = F.when(F.col("match_level") != "", F.col("match_level")).otherwise(level_from_names("_names"))
    rows = rows.withColumn("registry_match_level_raw", level)
    rows = rows.withColumns({
        "evidence_level": evidence_level("registry_match_level_raw", "certified_product", "certified_brand"),
        "certified_entity_name": F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("certified_company", "certified_brand", "certified_product")], F.lit("")),
        "certified_entity_type": F.when(F.col("certified_company") != "", "company").when(F.col("certified_brand") != "", "brand").when(F.col("certified_product") != "", "product").otherwise(""),
    })
    rows = with_match_keys(rows, ["certified_entity_name", "certified_company", "certified_brand", "certified_product"], strict=True, is_clean=True)
    rows = with_match_keys(rows, ["product_category", "country_or_scope"], is_clean=True)
    rows = rows.withColumns({
        "master_record_id": text.record_key(
            "certification", "evidence_level", "certified_company", "certified_brand", "certified_product",
            "certificate_identifier", "source_url", "source_file", "source_sheet", F.concat_ws("-", *order), is_clean=True),
        "certification_full_name": F.col("certification"),
        "applies_to_configurator_product_by": applies_by("evidence_level"),
        "source_row_number": F.col(order[0]) + 2,
        "created_at_utc": F.lit(stamp) if stamp else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"),
    })
    return rows.select(*fixed.MASTER_COLUMNS, *order)


MASTER_DEDUP = [
    "certification", "evidence_level", "certified_company_normalized_strict",
    "certified_brand_normalized_strict", "certified_product_normalized_strict",
    "certificate_identifier", "source_url",
]


def union_registries(frames) -> DataFrame:
    """Union by name; text columns a table lacks become empty."""
    merged = union_all(frames)
    return merged.fillna("", subset=[n for n, kind in merged.dtypes if kind == "string"])


def master_registry(frames, order=("src_ordinal",)) -> DataFrame:
    return keep_first(union_registries(frames), MASTER_DEDUP, list(order))


def certificate_validity(df: DataFrame, expiry, extracted, as_of) -> DataFrame:
    """Parsed dates, whether the certificate is valid on ``as_of``, and the days it has left."""
    day = F.lit(as_of).cast("date")
    parsed = df.withColumns({
        "expiration_date_parsed": F.try_to_date(clean(expiry), "yyyy-MM-dd"),
        "extract_date_parsed": F.try_to_date(clean(extracted), "yyyy-MM-dd"),
    })
    return parsed.withColumns({
        "is_certificate_active": F.coalesce(F.col("expiration_date_parsed") >= day, F.lit(False)),
        "days_until_expiration": F.date_diff("expiration_date_parsed", day),
    })
