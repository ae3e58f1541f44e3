"""Catalogue to registry matching: exact, domain and fuzzy candidates, scores, audit."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions import text
from ledgerloom.functions.fuzzy import name_score
from ledgerloom.operators import blocking, decisions
from ledgerloom.operators.ordered import salted_join, top_n, union_all
from ledgerloom.sources.sinks import written

# What a candidate row's scores and decision depend on.
EVIDENCE = ["certification", "entity_strict", "registry_product_strict", "registry_domain", "domain_matchable",
            "registry_usage_mode", "evidence_level", "has_product", "entity_short"]
PROFILE = ["company_strict", "product_strict", "domains"]
HINTS = ["domain_exact", "company_or_brand_exact_normalized", "company_or_brand_fuzzy_candidate", "product_fuzzy_candidate"]
POSITION = ["stage", "stage_rank", "src_ordinal", "src_tie"]


def prepare_items(raw: DataFrame) -> DataFrame:
    """Catalogue rows with strict keys and domains."""
    fields = ["company", "product", "industry", "country", "configurator_url", "alternative_url", "database_detail_url"]
    rows = raw.select("id", "src_ordinal", *[text.clean(f).alias(f) for f in fields])
    return rows.withColumns({
        "company_strict": text.strict_key("company"),
        "product_strict": text.strict_key("product"),
        "domains": text.distinct_domains("configurator_url", "alternative_url", "database_detail_url"),
    })


def item_profiles(items: DataFrame) -> DataFrame:
    """Items that match alike are matched once; ``profile`` is the lowest id among them."""
    return items.groupBy(*PROFILE).agg(F.min("id").alias("profile"))


def prepare_registry(master: DataFrame) -> DataFrame:
    """Master registry rows with the columns matching needs."""
    entity = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("certified_company", "certified_brand", "certified_entity_name")], F.lit(""))
    rows = master.withColumn("candidate_entity", entity).withColumns({
        "entity_strict": text.strict_key("candidate_entity"),
        "registry_product_strict": F.col("certified_product_normalized_strict"),
        "registry_domain": text.domain_of("source_url"),
        "registry_usage_mode": decisions.usage_mode("certification", "evidence_level"),
        "has_product": F.col("certified_product") != "",
    })
    return rows.withColumns({
        "domain_matchable": text.is_matchable_domain("registry_domain"),
        "entity_short": text.is_short_name("entity_strict"),
    })


def exact_blocks(items: DataFrame, registry: DataFrame, item_key, registry_key, usable=None) -> DataFrame:
    """Block sizes: per item and certification the registry rows that share the key, and the first.

    The registry is aggregated before the join, so a name with very many rows meets each item once. ``usable`` tells of a key whether it may match; blocks
    are chosen after the aggregate, since a filter of the rows would work out their keys once more.
    """
    blocks = written(registry.groupBy("certification", F.col(registry_key).alias(item_key)).agg(
        F.count("*").alias("registry_rows"), F.min(F.struct("src_ordinal", "src_tie")).alias("_first")
    )).filter(F.col(item_key) != "")
    if usable is not None:
        blocks = blocks.filter(usable(item_key))
    # The salted join reads both sides twice; their keys are computed once.
    joined = salted_join(written(items.select("id", item_key).filter(F.col(item_key) != "")), blocks, item_key, "id")
    return joined.groupBy("id", "certification").agg(
        F.sum("registry_rows").alias("registry_rows"), F.min("_first").alias("_first")
    ).select("id", "certification", "registry_rows", F.col("_first.src_ordinal").alias("first_ordinal"), F.col("_first.src_tie").alias("first_tie"))


def _rows(registry):
    return registry.select(*EVIDENCE, "master_record_id", "src_ordinal", "src_tie")


#: Rows alike in these are candidates of the same items, by the same stages, with the same scores.
CLASS = [*EVIDENCE, "company_head", "product_head"]


def _heads(rows, key, flag, rows_per_name):
    """Places of the first ``rows_per_name`` rows of every name of a certification."""
    filled = rows.filter(F.col(key) != "").select("certification", key, "master_record_id", "src_ordinal", "src_tie")
    first = top_n(filled, ["certification", key], [F.asc("src_ordinal"), F.asc("src_tie")], rows_per_name, "_rank")
    return first.select("master_record_id", F.lit(True).alias(flag))


def classed_rows(registry: DataFrame, rows_per_name=5) -> DataFrame:
    """Registry rows with what their class is made of: evidence, and whether they are among the first of their names."""
    rows = _rows(registry)
    rows = rows.join(_heads(rows, "entity_strict", "company_head", rows_per_name), "master_record_id", "left")
    rows = rows.join(_heads(rows, "registry_product_strict", "product_head", rows_per_name), "master_record_id", "left")
    return rows.fillna(False, subset=["company_head", "product_head"])


def evidence_classes(rows: DataFrame, keep=1) -> DataFrame:
    """One row per class of registry rows: ``class_id``, and its first ``keep`` rows as ``first_rows``.

    Rows of one class rank by source order, so a result of at most ``keep`` rows per item and certification never shows
    later ones. With ``keep`` 1 there is also the number of rows, ``evidence_rows``.
    """
    place = F.struct("src_ordinal", "src_tie", "master_record_id")
    if keep == 1:
        classes = rows.groupBy(*CLASS).agg(F.count("*").alias("evidence_rows"), F.array(F.min(place)).alias("first_rows"))
    else:
        first = top_n(rows, CLASS, [F.asc("src_ordinal"), F.asc("src_tie")], keep, "_rank")
        classes = first.groupBy(*CLASS).agg(F.array_sort(F.collect_list(place)).alias("first_rows"))
    return classes.withColumn("class_id", F.monotonically_increasing_id())


# A pair's stages as numbers, so that merging stays a hash aggregate: the earliest position, the strongest hint.
_RANKS = 1_000_000


def _stage(pairs, number, rank, hint):
    return pairs.select("profile", "class_id", (F.lit(number * _RANKS) + rank).cast("long").alias("_at"), F.lit(HINTS.index(hint)).alias("_hint"))


def exact_candidates(profiles: DataFrame, rows: DataFrame) -> DataFrame:
    left = profiles.filter("company_strict <> ''").withColumn("k", F.col("company_strict"))
    right = rows.filter("entity_strict <> ''").withColumn("k", F.col("entity_strict"))
    return salted_join(left, right, "k", "profile").drop("k")


def domain_candidates(profiles: DataFrame, classes: DataFrame) -> DataFrame:
    left = profiles.select("profile", F.posexplode("domains").alias("_place", "k"))
    right = classes.filter("domain_matchable").select("class_id", F.col("registry_domain").alias("k"))
    return _stage(salted_join(left, right, "k", "profile"), 2, F.col("_place"), HINTS[0])


def leading_domain_candidates(left, right, names, keep) -> DataFrame:
    """Those pairs of ``domain_candidates`` that may be among the ``keep`` best of an item and certification; with ``keep`` 1 by
    the order of ``decisions.best_candidates``, else of ``top_candidates``. ``left`` and ``right`` have name ids.

    A domain match leaves the decision open only for product rows of direct registries, and there a different product counts
    only next to a company score from ``decisions.LEAST_COMPANY`` up. All other pairs of a domain, certification and kind are
    decided alike, so their order is that of the rows (of company scores first, where one is kept), whatever the item.
    """
    lefts = written(left.select("profile", "_c", "_p", F.posexplode("domains").alias("_place", "k")))
    rights = written(right.filter("domain_matchable").select(
        "class_id", "certification", "_e", "_q", F.col("registry_domain").alias("k"), decisions.open_by_domain().alias("_open"),
        F.col("first_rows")[0]["src_ordinal"].alias("_ordinal"), F.col("first_rows")[0]["src_tie"].alias("_tie")))
    opened, kind, pair = rights.filter("_open"), ["k", "certification", "_open"], ["profile", "class_id", "_place"]
    # names of a domain meet once, however many products and rows have them
    met = written(salted_join(lefts.select("k", "_c").distinct(), (rights if keep == 1 else opened).select("k", "_e").distinct(), "k", "_c"))
    scored = written(met.join(_pair_scores(met, names, "_c", "_e", "_score"), ["_c", "_e"]).withColumn("_score", F.round("_score", 2)))
    near = F.col("_score") >= decisions.LEAST_COMPANY
    if keep == 1:
        first = lambda rows, keys: rows.withColumn("_rank", F.rank().over(Window.partitionBy(*keys).orderBy(F.desc("_score"))))
        kinds = first(scored.join(rights.select(*kind, "_e").distinct(), ["k", "_e"]), [*kind, "_c"]).filter((F.col("_rank") == 1) | (F.col("_open") & near))
        found = [kinds.join(rights, [*kind, "_e"]).join(lefts, ["k", "_c"])]
        same = lefts.select("k", "_c", "_p").distinct().join(opened.withColumn("_p", F.col("_q")), ["k", "_p"]).join(scored, ["k", "_c", "_e"])
        found.append(first(same, ["k", "_c", "_p", "certification"]).filter("_rank = 1").join(lefts, ["k", "_c", "_p"]))
    else:
        heads = lambda rows, keys: top_n(rows, keys, [F.asc("_ordinal"), F.asc("_tie")], keep, "_rank")
        found = [lefts.join(heads(rights, kind), "k"), lefts.join(heads(opened, ["k", "certification", "_q"]).withColumn("_p", F.col("_q")), ["k", "_p"]),
                 scored.filter(near).join(opened, ["k", "_e"]).join(lefts, ["k", "_c"])]
    return _stage(union_all([f.select(*pair) for f in found]), 2, F.col("_place"), HINTS[0])


def fuzzy_candidates(profiles, classes, item_key, registry_key, head, cutoff, stage, hint, names=8) -> DataFrame:
    """Up to ``names`` similar registry names per item and certification, the first registry rows of each."""
    filled = classes.filter(F.col(registry_key) != "")
    choices = filled.select("certification", F.col(registry_key).alias("name")).distinct()
    pairs = blocking.similar_names(
        profiles.select(F.col(item_key).alias("name")).distinct(), choices.select("name").distinct())
    best = blocking.best_names(pairs, choices, cutoff, names).select("left_name", "right_name", "certification", "name_rank")
    heads = filled.filter(head).select("class_id", "certification", F.col(registry_key).alias("right_name"))
    named = best.join(heads, ["certification", "right_name"]).drop("right_name")
    left = profiles.filter(F.col(item_key) != "").select("profile", F.col(item_key).alias("left_name"))
    return _stage(salted_join(left, named, "left_name", "profile"), stage, F.col("name_rank"), hint)


def merge_candidates(candidates: DataFrame, keys, carried) -> DataFrame:
    """One row per pair: the strongest hint, the earliest insertion position."""
    order = F.array_position(F.array(*[F.lit(h) for h in HINTS]), F.col("hint"))
    return candidates.groupBy(*keys).agg(
        F.min_by("hint", order).alias("hint"),
        F.min(F.struct("stage", "stage_rank")).alias("_at"),
        *[F.first(c).alias(c) for c in carried],
    ).select("*", "_at.stage", "_at.stage_rank").drop("_at")


def pair_features(pairs: DataFrame, score=name_score) -> DataFrame:
    """Exact flags, scores rounded to two places, domain score, short-name flag."""
    same = lambda a, b: (F.col(a) != "") & (F.col(a) == F.col(b))
    in_domains = F.col("domain_matchable") & F.array_contains("domains", F.col("registry_domain"))
    return pairs.withColumns({
        "entity_exact_match": same("company_strict", "entity_strict"),
        "product_exact_match": same("product_strict", "registry_product_strict"),
        "company_score": F.round(score("company_strict", "entity_strict"), 2),
        "product_score": F.round(score("product_strict", "registry_product_strict"), 2),
        "domain_score": F.when(in_domains, 100.0).otherwise(0.0),
        "short_name": text.is_short_name("company_strict") | F.col("entity_short"),
    })


def _name_ids(names, table, column, output):
    return table.join(names.select(F.col("name").alias(column), F.col("name_id").alias(output)), column)


def _pair_scores(pairs, names, left, right, output):
    """Score of every different pair of names, by their ids."""
    named = lambda column, text_: names.select(F.col("name_id").alias(column), F.col("name").alias(text_))
    distinct = pairs.select(left, right).distinct().join(named(left, "_l"), left).join(named(right, "_r"), right)
    # Few pairs, each of them work: dealt out over all tasks.
    dealt = distinct.repartition(4 * pairs.sparkSession.sparkContext.defaultParallelism, left, right)
    return written(dealt.select(left, right, name_score("_l", "_r").alias(output)))


def scored_classes(profiles: DataFrame, classes: DataFrame, company_cutoff=80, product_cutoff=82, names=8, keep=None) -> DataFrame:
    """Pairs of an item profile and a class of registry rows that one of the four blocking stages brings
    together, with features, hint and insertion position.

    Pairs are ids until they are merged, and each different pair of names is scored once, however many pairs hold it. With
    ``keep``, pairs of a domain that can't be among the ``keep`` best are left out.
    """
    words = [profiles.select(F.col(c).alias("name")) for c in ("company_strict", "product_strict")]
    words += [classes.select(F.col(c).alias("name")) for c in ("entity_strict", "registry_product_strict")]
    known = written(union_all(words).distinct().withColumn("name_id", F.monotonically_increasing_id()))
    left = _name_ids(known, _name_ids(known, profiles, "company_strict", "_c"), "product_strict", "_p")
    right = _name_ids(known, _name_ids(known, classes, "entity_strict", "_e"), "registry_product_strict", "_q")
    stages = [
        _stage(exact_candidates(profiles.select("profile", "company_strict"), classes.select("class_id", "entity_strict")), 1, F.lit(0), HINTS[1]),
        domain_candidates(profiles, classes) if keep is None else leading_domain_candidates(left, right, known, keep),
        fuzzy_candidates(profiles, classes, "company_strict", "entity_strict", "company_head", company_cutoff, 3, HINTS[2], names),
        fuzzy_candidates(profiles, classes, "product_strict", "registry_product_strict", "product_head", product_cutoff, 4, HINTS[3], names),
    ]
    merged = union_all(stages).groupBy("profile", "class_id").agg(F.min("_at").alias("_at"), F.min("_hint").alias("_hint"))
    pairs = written(merged.join(left.select("profile", "_c", "_p"), "profile").join(right.select("class_id", "_e", "_q"), "class_id"))
    for sides, output in ((("_c", "_e"), "_score_company_strict"), (("_p", "_q"), "_score_product_strict")):
        pairs = pairs.join(_pair_scores(pairs, known, *sides, output), list(sides))
    full = pairs.drop("_c", "_e", "_p", "_q").join(profiles, "profile").join(classes.drop("company_head", "product_head"), "class_id")
    placed = full.withColumns({
        "stage": F.floor(F.col("_at") / _RANKS).cast("int"), "stage_rank": (F.col("_at") % _RANKS).cast("int"),
        "hint": F.element_at(F.array(*[F.lit(h) for h in HINTS]), F.col("_hint") + 1),
    }).drop("_at", "_hint")
    featured = pair_features(placed, score=lambda name, _: F.col(f"_score_{name}"))
    # names are alike as well in pairs of a domain that were left out
    of_domain = F.col("domain_score") == 100
    return featured if keep is None else featured.filter(~of_domain | (F.col("stage") < 3)).withColumn("hint", F.when(of_domain, HINTS[0]).otherwise(F.col("hint")))


def class_pairs(items: DataFrame, registry: DataFrame, rows_per_name=5, **limits) -> DataFrame:
    """All candidates, as pairs of representatives: ``profile`` is the lowest id of ``profile_items`` items that match
    alike, ``master_record_id`` the first of ``evidence_rows`` registry rows that do. Members are told by
    ``item_members`` and ``evidence_members``."""
    profiles = written(items.groupBy(*PROFILE).agg(F.min("id").alias("profile"), F.count("*").alias("profile_items")))
    classes = written(evidence_classes(classed_rows(written(_rows(registry)), rows_per_name)))
    return scored_classes(profiles, classes, **limits).withColumn("master_record_id", F.col("first_rows")[0]["master_record_id"])


def item_members(items: DataFrame) -> DataFrame:
    """(id, profile): the representative of every item."""
    stored = written(items.select("id", *PROFILE))
    return stored.join(item_profiles(stored), PROFILE).select("id", "profile")


def evidence_members(registry: DataFrame, rows_per_name=5) -> DataFrame:
    """(member_record_id, master_record_id): the representative of every registry row.

    Classes are those of ``evidence_classes``. Rows travel as hashes (128 bits for a class), positions and ids, once, to the other rows of
    their name, which hold all of their class.
    """
    told = lambda columns, *salt: F.xxhash64(*salt, *[x for c in columns for x in (F.col(c), F.col(c).isNull())])
    named, sold = F.col("entity_strict") != "", F.col("registry_product_strict") != ""
    # an id of hexadecimal digits takes half its length
    hexed = F.col("master_record_id").rlike("^([0-9a-f]{2})+$")
    packed = F.when(hexed, F.concat(F.lit(bytes([1])), F.unhex("master_record_id"))).otherwise(F.concat(F.lit(bytes([0])), F.encode("master_record_id", "UTF-8")))
    rows = written(registry.select(
        F.when(named, told(["certification", "entity_strict"])).otherwise(told(EVIDENCE)).alias("_name"), F.coalesce(named, F.lit(False)).alias("_named"),
        F.when(sold, told(["certification", "registry_product_strict"])).otherwise(F.xxhash64("master_record_id")).alias("_product"), F.coalesce(sold, F.lit(False)).alias("_sold"),
        told(EVIDENCE).alias("_h1"), told(EVIDENCE, F.lit(1)).alias("_h2"), "src_ordinal", "src_tie", packed.alias("_id")))
    place = ["src_ordinal", "src_tie", "_id"]
    at = F.struct(*place)
    first = top_n(rows.filter("_sold").select("_product", *place), "_product", [F.asc(c) for c in place], rows_per_name, "_rank")
    last = written(first.groupBy("_product").agg(F.max(at).alias("_last")))
    placed = rows.join(last, "_product", "left").withColumn("product_head", F.col("_sold") & F.coalesce(at <= F.col("_last"), F.lit(False))).drop("_product", "_sold", "_last")
    rank = F.row_number().over(Window.partitionBy("_name").orderBy(*place))
    placed = placed.withColumn("company_head", F.col("_named") & (rank <= rows_per_name))
    alike = Window.partitionBy("_name", "_h1", "_h2", "company_head", "product_head").orderBy(*place)
    plain = lambda c: F.when(F.substring(c, 1, 1) == F.lit(bytes([1])), F.lower(F.hex(F.substring(c, 2, 1 << 30)))).otherwise(F.decode(F.substring(c, 2, 1 << 30), "UTF-8"))
    found = placed.select("_id", F.first("_id").over(alike).alias("_first"))
    return found.select(plain(F.col("_id")).alias("member_record_id"), plain(F.col("_first")).alias("master_record_id"))


def match(items: DataFrame, registry: DataFrame, keep, keep_no_from=80.0, rows_per_name=5, **limits):
    """(decided pairs of item profiles and classes of registry rows, profile of each item) for results of ``keep`` rows
    each; ``limits`` are the cutoffs and limits of ``scored_classes``."""
    members = written(item_members(items))
    profiles = written(item_profiles(items))
    classes = written(evidence_classes(classed_rows(registry, rows_per_name), keep))
    pairs = scored_classes(profiles, classes, keep=keep, **limits)
    first = F.col("first_rows")[0]
    decided = decisions.decide(pairs, keep_no_from).withColumns({"src_ordinal": first["src_ordinal"], "src_tie": first["src_tie"]})
    return decided.select("profile", "certification", "class_id", "first_rows", *OUTCOME, *POSITION), members


OUTCOME = ["decision", "site_claim_type", "confidence", "final_score", "match_method", "review_reason",
           "company_score", "product_score", "domain_score", "entity_exact_match", "product_exact_match"]


#: Registry columns that an audit row shows.
AUDITED = ["registry_usage_mode", "evidence_level", "certified_entity_name", "certified_company", "certified_brand", "certified_product", "product_category",
           "country_or_scope", "certificate_identifier", "source_file", "source_sheet", "source_row_number", "source_url", "evidence_text"]


def audit_rows(chosen: DataFrame, items: DataFrame, registry: DataFrame, stamp=None) -> DataFrame:
    """The 35 audit columns for chosen (id, certification, outcome) rows; missing evidence is empty."""
    details = registry.select(
        "master_record_id",
        F.col("registry_usage_mode").alias("_mode"), F.col("evidence_level").alias("matched_evidence_level"),
        F.col("certified_entity_name").alias("matched_registry_entity"), F.col("certified_company").alias("matched_registry_company"),
        F.col("certified_brand").alias("matched_registry_brand"), F.col("certified_product").alias("matched_registry_product"),
        F.col("product_category").alias("matched_product_category"), F.col("country_or_scope").alias("matched_country_or_scope"),
        "certificate_identifier", "source_file", "source_sheet", F.col("source_row_number").cast("string").alias("source_row_number"),
        "source_url", text.truncate("evidence_text").alias("evidence_text"),
    )
    owners = items.select(
        "id", (F.col("src_ordinal") + 2).alias("configurator_row_number"), F.col("company").alias("configurator_company"),
        F.col("product").alias("configurator_product"), F.col("industry").alias("configurator_industry"),
        F.col("country").alias("configurator_country"), text.encode_list("domains").alias("configurator_domains"))
    full = (
        chosen.select("id", "certification", "master_record_id", *OUTCOME)
        .join(details, "master_record_id", "left").join(owners, "id")
        .withColumn("registry_usage_mode", F.coalesce("_mode", F.lit("")))
        .withColumn("configurator_id", F.col("id"))
        .withColumn("created_at_utc", F.lit(stamp) if stamp else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))
    )
    strings = [n for n, kind in full.dtypes if kind == "string"]
    return full.fillna("", subset=strings).select(*fixed.AUDIT_COLUMNS)


def _stored(items, registry):
    """Both sides with the columns of matching and audit; their keys are worked out once."""
    return written(items), written(registry.select(*dict.fromkeys([*EVIDENCE, *AUDITED, "master_record_id", "src_ordinal", "src_tie"])))


def best_matches(items: DataFrame, registry: DataFrame, certifications=None, stamp=None, **limits) -> DataFrame:
    """One audit row per item and certification."""
    items, registry = _stored(items, registry)
    certifications = certifications or decisions.certification_names(registry)
    decided, members = match(items, registry, 1, **limits)
    best = decisions.best_candidates(decided, ["profile", "certification"], POSITION)
    best = best.select("profile", "certification", F.col("first_rows")[0]["master_record_id"].alias("master_record_id"), *OUTCOME)
    full = decisions.with_no_match_rows(best, members, "profile", certifications)
    return audit_rows(members.join(full, "profile"), items, registry, stamp)


def candidate_matches(items: DataFrame, registry: DataFrame, stamp=None, n=5, **limits) -> DataFrame:
    """The ``n`` best candidates per item and certification.

    The ``n`` best rows lie in the ``n`` best classes, ranked by their first rows, and are among the first ``n`` of each.
    """
    items, registry = _stored(items, registry)
    decided, members = match(items, registry, n, **limits)
    classes = decisions.top_candidates(decided, ["profile", "certification"], POSITION, n).drop("candidate_rank", "src_ordinal", "src_tie")
    rows = classes.select("*", F.inline("first_rows")).drop("first_rows")
    top = decisions.top_candidates(rows, ["profile", "certification"], POSITION, n)
    return audit_rows(members.join(top, "profile"), items, registry, stamp)
