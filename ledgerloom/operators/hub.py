"""Typed catalogue import and the benchmark hub's filter, facet, ranking and similarity queries."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions import rules
from ledgerloom.functions.text import col
from ledgerloom.operators.ordered import numbered, top_n
from ledgerloom.sources.sinks import written

NUMBER = "^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$"


def blank_to_null(value) -> Column:
    trimmed = F.regexp_replace(col(value), "(?U)^\\s+|\\s+$", "")
    return F.when(trimmed != "", trimmed)


def yes_no(value) -> Column:
    text = F.upper(blank_to_null(value))
    return (
        F.when(text.isin("SI", "SÌ", "YES", "TRUE", "1"), True).when(text.isin("NO", "FALSE", "0"), False)
    )


def score_1_5(value) -> Column:
    text = blank_to_null(value)
    number = F.when(text.rlike(NUMBER), text.try_cast("double"))
    rounded = F.floor(number + 0.5)
    return F.when(rounded.between(1, 5), rounded.cast("int"))


def composite_score(mobile, compatibility, complexity, visualization) -> Column:
    points = F.when(col(visualization) == "Interactive 3D", 5).when(col(visualization) == "Static 2D", 3)
    values = F.array_compact(F.array(col(mobile), col(compatibility), col(complexity), points))
    total = F.aggregate(values, F.lit(0), lambda acc, v: acc + v)
    return F.when(F.size(values) > 0, F.round(total / F.size(values), 2))


def typed_import(raw: DataFrame) -> DataFrame:
    """Raw text catalogue to typed rows; rows without a company are dropped."""
    typed = raw.select(
        "src_ordinal", "id",
        blank_to_null("industry").alias("industry"),
        blank_to_null("country").alias("country"),
        blank_to_null("company").alias("company"),
        blank_to_null("product").alias("product"),
        blank_to_null("configurator_url").alias("configurator_url"),
        yes_no("active_text").alias("is_active"),
        blank_to_null("alternative_url").alias("alternative_url"),
        blank_to_null("visualization_text").alias("visualization_type"),
        score_1_5("mobile_text").alias("mobile_score"),
        score_1_5("compatibility_text").alias("compatibility_score"),
        score_1_5("complexity_text").alias("complexity_score"),
        blank_to_null("database_detail_url").alias("database_detail_url"),
    ).filter(F.col("company").isNotNull())
    return typed.withColumn(
        "intelligence_score",
        composite_score("mobile_score", "compatibility_score", "complexity_score", "visualization_type"),
    )


def import_counts(raw: DataFrame) -> DataFrame:
    kept = blank_to_null("company").isNotNull()
    return raw.agg(
        F.count("*").alias("rows_found"),
        F.count_if(kept).alias("imported"),
        F.count_if(~kept).alias("skipped"),
    )


# --- slugs --------------------------------------------------------------------------------------


def slugify(value) -> Column:
    """Lower case, accents removed, other runs to '-', at most 80 characters."""
    accented = "".join(_ACCENTS)
    text = F.translate(F.lower(col(value)), accented + _MARKS, "".join(_ACCENTS.values()))
    dashed = F.regexp_replace(F.regexp_replace(text, "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.substring(dashed, 1, 80)


def _canonical_accents():
    """Letters whose canonical decomposition is an ASCII letter plus marks U+0300..U+036F."""
    import unicodedata

    table = {}
    for code in range(0xC0, 0x2000):
        parts = unicodedata.normalize("NFD", chr(code).lower())
        base = "".join(c for c in parts if not "̀" <= c <= "ͯ")
        if len(base) == 1 and base.isascii() and base.isalpha():
            table[chr(code)] = base
    return table


_ACCENTS = _canonical_accents()
_MARKS = "".join(chr(c) for c in range(0x300, 0x370))


def assign_slugs(rows: DataFrame, order="src_ordinal") -> DataFrame:
    """Unique slug per row, handed out in source order: base, base-2, base-3, ...

    Numbering alone settles everything unless a numbered slug equals another row's own base
    (``ring`` twice next to ``ring-2``). Each pass gives one contested slug per base to the earlier
    row and shifts the later base past it; passes end when no slug is held twice.
    """
    base = slugify(F.concat_ws("-", F.col("company"), F.coalesce(F.col("product"), F.lit("configurator"))))
    based = rows.withColumn("_base", base)
    if not based.filter("_base = ''").isEmpty():
        based = numbered(based.withColumn("_all", F.lit(1)), "_all", order, "_position")
        stand_in = F.concat(F.lit("configurator-"), F.col("_position"))
        based = based.withColumn("_base", F.when(F.col("_base") == "", stand_in).otherwise(F.col("_base"))).drop("_all", "_position")
    ranked = numbered(based, "_base", order, "_number")
    lost = None
    while True:
        slugged = _with_slug(ranked, lost, order)
        held_twice = slugged.groupBy("slug").agg(
            F.count("*").alias("_n"), F.min(order).alias("_owner")
        ).filter("_n > 1")
        losers = slugged.join(held_twice, "slug").filter(F.col(order) > F.col("_owner"))
        contested = losers.groupBy("_base").agg(F.min("_suffix").alias("_lost"))
        if contested.isEmpty():
            return slugged.drop("_base", "_number", "_suffix")
        lost = contested if lost is None else lost.unionByName(contested)
        lost = written(lost)  # each pass settles slugs for good, so passes end; none repeats earlier ones


def _with_slug(ranked, lost, order):
    if lost is None:
        slugged = ranked.withColumn("_suffix", F.col("_number"))
    else:
        lists = lost.groupBy("_base").agg(F.array_sort(F.collect_set("_lost")).alias("_losses"))
        # Walk the contested suffixes in order: each one at or below the current suffix moves it up.
        suffix = F.aggregate(
            F.coalesce("_losses", F.array().cast("array<bigint>")),
            F.col("_number").cast("bigint"),
            lambda acc, n: F.when(n <= acc, acc + 1).otherwise(acc),
        )
        slugged = ranked.join(lists, "_base", "left").withColumn("_suffix", suffix).drop("_losses")
    slug = F.when(F.col("_suffix") == 1, F.col("_base")).otherwise(F.concat_ws("-", "_base", "_suffix"))
    return slugged.withColumn("slug", slug)


# --- classification -----------------------------------------------------------------------------


def hub_key(value) -> Column:
    return F.lower(F.trim(F.coalesce(col(value), F.lit(""))))


def source_class_key(value) -> Column:
    text = F.lower(F.translate(F.coalesce(col(value), F.lit("")), "®™", ""))
    text = F.replace(text, F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


def classify_sources(df: DataFrame, name="certification") -> DataFrame:
    """Certification name to (source key, registry type, availability)."""
    as_struct = lambda r: F.struct(*[F.lit(v).alias(n) for v, n in zip(r, ("source_key", "registry_type", "availability"))])
    chosen = rules.first_match(
        "_key", [(k, as_struct(r)) for k, r in fixed.SOURCE_CLASSES], as_struct(fixed.SOURCE_CLASS_DEFAULT)
    )
    return (
        df.withColumn("_key", source_class_key(name)).withColumn("_class", chosen)
        .select(*df.columns, "_class.*")
    )


def classify_items(df: DataFrame) -> DataFrame:
    """Industry key, product pictogram group, visualisation class and ISO country per item."""
    keyed = df.withColumns({f"_{n}": hub_key(n) for n in ("industry", "product", "visualization_type", "country")})
    return keyed.select(
        *df.columns,
        rules.first_match("_industry", fixed.INDUSTRY_KEYS, fixed.INDUSTRY_DEFAULT).alias("industry_key"),
        rules.first_match("_product", fixed.PRODUCT_GROUPS, fixed.PRODUCT_DEFAULT).alias("product_group"),
        rules.first_match("_visualization_type", [(["3d"], "3d"), (["2d"], "2d")], "other").alias("visual_group"),
        rules.lookup("_country", fixed.COUNTRY_CODES, "").alias("country_code"),
    )


def squeezed(value) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.coalesce(col(value), F.lit("")), "(?U)\\s+", " ")))


def visualisation(df: DataFrame, value, free_text=False, name="visualisation") -> DataFrame:
    """Visualisation class from a class word or, if asked, from free text."""
    signals = fixed.VISUALISATION_TEXT_SIGNALS if free_text else fixed.VISUALISATION_WORDS
    return df.withColumn("_v", squeezed(value)).withColumn(name, rules.first_match("_v", signals, "")).drop("_v")


# --- explorer -----------------------------------------------------------------------------------

SORT_MODES = {
    "company": None,
    "score": "intelligence_score",
    "mobile": "mobile_score",
    "complexity": "complexity_score",
    "compatibility": "compatibility_score",
}


def explorer_predicate(q="", industry="", country="", active="", visualization="") -> Column:
    tests = [F.lit(True)]
    if q:
        needle = F.lit(q.lower())
        tests.append(rules.any_of(
            [F.coalesce(F.contains(F.lower(c), needle), F.lit(False)) for c in ("company", "product", "industry", "country")]
        ))
    if industry:
        tests.append(F.col("industry") == industry)
    if country:
        tests.append(F.col("country") == country)
    if active == "active":
        tests.append(F.col("is_active"))
    if active == "inactive":
        tests.append(~F.col("is_active"))
    if visualization:
        tests.append(F.col("visualization_type") == visualization)
    combined = tests[0]
    for test in tests[1:]:
        combined = combined & test
    return combined


def explorer_page(items: DataFrame, sort="company", limit=120, **filters) -> DataFrame:
    """Filtered, sorted result page; Spark runs it as one top-k without a full sort."""
    order = [F.asc("company"), F.asc("id")]
    if SORT_MODES.get(sort):
        order.insert(0, F.desc_nulls_last(SORT_MODES[sort]))
    return items.filter(explorer_predicate(**filters)).orderBy(*order).limit(limit)


def hub_counters(items: DataFrame, **filters) -> DataFrame:
    """All page counters in one scan."""
    return items.agg(
        F.count("*").alias("total"),
        F.count_if(explorer_predicate(**filters)).alias("filtered"),
        F.count_if("is_active").alias("active"),
        F.count_if(~F.col("is_active")).alias("inactive"),
        F.count_distinct(F.nullif(F.col("industry"), F.lit(""))).alias("industries"),
        F.count_distinct(F.nullif(F.col("country"), F.lit(""))).alias("countries"),
    )


def facets(items: DataFrame, names=("industry", "country", "visualization_type")) -> DataFrame:
    """Distinct non-empty facet values, one row each."""
    pairs = F.array(*[F.struct(F.lit(n).alias("facet"), F.col(n).alias("value")) for n in names])
    return items.select(F.inline(pairs)).filter("value <> ''").distinct().select("facet", "value")


def _ranking():
    return [F.desc("intelligence_score"), F.asc("company"), F.asc("id")]


def ranked_items(items: DataFrame) -> DataFrame:
    return items.filter(F.col("is_active") & F.col("intelligence_score").isNotNull())


def top_per_industry(items: DataFrame, n=3) -> DataFrame:
    active = ranked_items(items).withColumn("industry", F.trim("industry")).filter("industry <> ''")
    return top_n(active, "industry", _ranking(), n)


def overall_top(items: DataFrame, n=20) -> DataFrame:
    return ranked_items(items).orderBy(*_ranking()).limit(n)


def similar_items(items: DataFrame, n=3) -> DataFrame:
    """For every item the n best other active items of its industry.

    The best n+1 of each industry are ranked once; every item meets only those, so the work is
    linear in the items whatever the size of an industry.
    """
    best = top_n(ranked_items(items).filter("industry IS NOT NULL"), "industry", _ranking(), n + 1, "_rank").select(
        "industry",
        F.col("id").alias("similar_id"),
        F.col("company").alias("similar_company"),
        F.col("intelligence_score").alias("similar_score"),
        "_rank",
    )
    lists = best.groupBy("industry").agg(F.array_sort(F.collect_list(F.struct("_rank", "similar_id", "similar_company", "similar_score"))).alias("_best"))
    mine = items.select("id", "industry").join(lists, "industry")
    others = F.slice(F.filter("_best", lambda s: s["similar_id"] != F.col("id")), 1, n)
    return mine.select("id", F.posexplode(others).alias("position", "s")).select(
        "id", (F.col("position") + 1).alias("position"), "s.similar_id", "s.similar_company", "s.similar_score"
    )


# --- bands and labels ---------------------------------------------------------------------------


def score_labels(items: DataFrame) -> DataFrame:
    score = F.col("intelligence_score")
    mobile, depth, rule = F.col("mobile_score"), F.col("complexity_score"), F.col("compatibility_score")

    def band(value, missing, high, middle, low):
        return F.when(value.isNull(), missing).when(value >= 4, high).when(value == 3, middle).otherwise(low)

    return items.select(
        "id",
        F.when(score.isNull(), 0.0).otherwise(F.round(rules.clamp(score / 5 * 100, 0.0, 100.0), 2)).alias("percent"),
        F.when(score.isNull(), "Not evaluated").when(score >= 4, "Strong").when(score >= 3, "Moderate").otherwise("Weak").alias("band"),
        F.when(F.col("is_active"), "Active").when(~F.col("is_active"), "Inactive").otherwise("Unknown").alias("status"),
        band(mobile, "missing", "strong", "acceptable", "attention").alias("mobile_insight"),
        band(depth, "missing", "rich", "moderate", "simple").alias("depth_insight"),
        band(rule, "missing", "structured", "some", "limited").alias("rules_insight"),
    )
