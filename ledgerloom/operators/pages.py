"""Page judgements: static signals, verdict, visualisation, mobile, dependency and complexity
scores, model answers, probes, links."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import page_values as v
from ledgerloom.functions import rules, text
from ledgerloom.functions.text import clean, col
from ledgerloom.operators import dom
from ledgerloom.operators.discovery import page_text
from ledgerloom.operators.ordered import keep_first, top_n

# --- static signals ---------------------------------------------------------------------------

# Layout and script facts that only a browser can see; taken from the table where it has them.
BROWSER_COLUMNS = {"large_image_count": 0, "webgl_canvas_count": 0, "large_iframe_count": 0, "visible_large_iframe_count": 0,
                   "three_global": False, "babylon_global": False, "blend4web_global": False, "model_viewer_global": False}


def dom_signals(pages: DataFrame, html="html", page="page_id") -> DataFrame:
    """Element counts, text lists, sources and meta texts of every page; ``page`` tells the rows apart."""
    found = page_text(dom.element_texts(dom.tag_facts(pages, html), page, html), html).drop(html)
    missing = {n: F.lit(d) for n, d in BROWSER_COLUMNS.items() if n not in pages.columns}
    return found.withColumns({**missing, "visible_text_length": F.length("visible_text")})


def control_terms():
    c = F.col
    return [
        (c("form_count") >= 1, 1), (c("input_count") >= 6, 2), (c("checkbox_count") + c("radio_count") >= 3, 2), (c("range_count") >= 1, 2),
        (c("number_input_count") >= 1, 1), ((c("select_count") >= 1) | (c("option_count") >= 6), 1), (c("button_count") >= 2, 1), (c("svg_count") >= 5, 1),
    ]


def _choice_count() -> Column:
    """Distinct short choice-like texts among links, buttons and headings."""
    lowered = F.transform(F.concat("link_texts", "button_texts", "heading_texts"), F.lower)
    fits = lambda t: (
        ~t.isin(v.IGNORED_CHOICES) & ~rules.contains_any(t, v.IGNORED_CHOICE_PARTS) & (F.length(t) <= 28)
        & (F.size(F.split(t, " ")) <= 4) & t.rlike("[a-zA-Z]")
    )
    return F.size(F.array_distinct(F.filter(lowered, fits)))


def page_verdict(signals: DataFrame, url="url") -> DataFrame:
    """Active or not, with reason, confidence and source; pages no rule settles stay open."""
    joined = lambda *cols: F.lower(F.concat_ws(" ", *cols))
    listed = {n: F.array_join(n, " ") for n in ("heading_texts", "button_texts", "link_texts", "label_texts")}
    seen = list(listed.values())[:3]  # what the entry, teaser and home tests read
    rows = signals.withColumns({
        "_url": F.lower(url), "_page": joined("title", url, "visible_text"),
        "_body": F.lower("visible_text"),
        "_all": joined("title", url, "visible_text", *listed.values()), "_seen": joined("title", url, "visible_text", *seen), "_home": joined("title", "visible_text", *seen),
        "_score": rules.total(control_terms()), "_choices": _choice_count(),
        "_steps": F.size(F.filter(F.concat("heading_texts", "label_texts", "button_texts"), lambda t: F.lower(t).rlike(v.STEP_PATTERN))) >= 2,
        "_host": text.domain_of(url),
    })
    rows = rows.withColumns({
        "_sales": rules.count_hits("_page", v.SALE_PHRASES), "_provider": rules.contains_any("_page", v.SALE_PROVIDERS),
        "_error": rules.contains_any("_page", v.ERROR_PHRASES),
        "_blocked": rules.any_of([F.contains(F.col("_body"), F.lit(a)) & rules.contains_any("_body", b) for a, b in v.BLOCKED_PAIRS]),
        "_market": rules.count_hits("_page", v.MARKETPLACE_WORDS), "_editorial": rules.count_hits("_page", v.EDITORIAL_WORDS),
        "_custom_path": rules.contains_any("_url", v.CUSTOM_PATHS), "_custom_copy": rules.contains_any("_seen", v.CUSTOM_COPY),
        "_entry_copy": rules.contains_any("_seen", v.ENTRY_COPY), "_actions": rules.count_hits("_all", v.ACTION_WORDS), "_options": rules.count_hits("_all", v.OPTION_WORDS),
        "_config_path": rules.contains_any("_url", v.CONFIG_PATHS), "_teaser": rules.contains_any("_seen", v.TEASER_WORDS),
        "_nav": rules.count_hits("_home", v.NAV_WORDS), "_home_copy": rules.count_hits("_home", v.HOME_COPY),
        "_home_exempt": rules.contains_any("_url", v.HOME_EXEMPT_PATHS),
        "_rootish": F.size(F.filter(F.split(F.regexp_extract("_url", "^[a-z]+://[^/?#]*([^?#]*)", 1), "/"), lambda s: (s != "") & ~s.rlike("^[a-z]{2}(-[a-z]{2})?$"))) == 0,
        "_static": F.size(F.filter("img_src_hints", lambda s: F.lower(s).rlike("\\.(jpg|jpeg|png|webp)"))),
    })
    c = F.col
    sizable = c("range_count") + c("number_input_count") >= 1
    strong = (c("_score") >= 5) | ((c("checkbox_count") + c("radio_count") >= 4) & sizable) | ((c("input_count") >= 8) & (c("button_count") >= 2))
    entry = (
        (c("_custom_path") & (c("_choices") >= 3) & (c("img_count") >= 3) & (c("_custom_copy") | c("_entry_copy") | (F.size("link_texts") >= 4)))
        | (c("_entry_copy") & (c("_choices") >= 3) & (c("img_count") >= 3) & (c("_custom_path") | c("_custom_copy")))
        | (c("_custom_path") & (c("img_count") >= 4) & (c("_choices") >= 4) & (c("button_count") <= 3))
    )
    rows = rows.withColumns({"_strong": strong, "_entry": entry})
    no_canvas = c("canvas_count") + c("webgl_canvas_count") + c("model_viewer_count") == 0
    single = (
        (c("img_count") == 1) & (c("large_image_count") >= 1) & (c("visible_text_length") <= 140) & (c("text_block_count") <= 2) & (c("anchor_count") <= 3)
        & (c("button_count") <= 2) & (c("form_count") + c("input_count") + c("select_count") + c("iframe_count") == 0) & no_canvas & (c("_choices") <= 2)
    )
    banner = (
        (c("img_count") <= 2) & (c("large_image_count") >= 1) & (c("_static") >= 1) & (c("visible_text_length") <= 220) & (c("text_block_count") <= 3)
        & (c("anchor_count") <= 4) & (c("_choices") <= 2) & no_canvas
    )
    teaser = c("_teaser") & (c("img_count") <= 2) & (c("text_block_count") <= 3)
    image_only = ~c("_strong") & ~c("_entry") & (single | banner | teaser)
    generic = ~c("_home_exempt") & ~c("_strong") & c("_rootish") & (
        ((c("_nav") >= 4) & (c("_score") <= 2) & (c("anchor_count") >= 8) & (c("text_block_count") <= 10) & (c("_home_copy") <= 2))
        | ((c("_nav") >= 5) & (c("button_count") <= 6) & (c("_score") <= 1) & (c("_home_copy") <= 1)))
    out = lambda active, reason, confidence, source: F.struct(
        F.lit(active).alias("active"), F.lit(reason).alias("reason"), F.lit(confidence).alias("confidence"), F.lit(source).alias("source"))
    no = lambda reason: out("NO", reason, 100, "hard_rule")
    yes = lambda reason: out("SI", reason, 90, "hard_positive")
    verdict = (
        F.when(c("_provider") & ((c("_sales") > 0) | F.contains(c("_page"), F.lit("domain"))), no("parked_domain"))
        .when(c("_sales") >= 2, no("domain_sale")).when(c("_error"), no("error_page")).when(c("_blocked"), no("blocked_page"))
        .when(image_only, no("image_only")).when(text.host_within("_host", v.JOB_DOMAINS), no("job_platform"))
        .when(~c("_strong") & (c("_market") >= 2), no("marketplace")).when(~c("_strong") & (c("_editorial") >= 2), no("editorial"))
        .when(c("_entry"), yes("entry_page")).when(generic, out("", "generic_home_page", 0, "model"))
        .when(c("_config_path") & (c("_score") >= 3) & ((c("_actions") >= 1) | (c("_options") >= 3) | c("_steps")), yes("url_and_controls"))
        .when((c("_actions") >= 1) & (c("_score") >= 3) & (c("_options") >= 2), yes("explicit_customiser"))
        .when(c("_steps") & (c("_score") >= 4) & (c("_options") >= 3), yes("multi_step"))
        .when((c("checkbox_count") + c("radio_count") >= 4) & sizable & (c("_options") >= 4), yes("options_and_dimensions"))
        .otherwise(out("", "unresolved", 0, "model"))
    )
    return rows.withColumn("_v", verdict).select(*signals.columns, F.col("_score").alias("control_score"), "_v.*")


def visualisation_points(rows: DataFrame) -> DataFrame:
    """Static 2D or Interactive 3D from page and resource signals, with points and confidence."""
    c = F.col
    hint = F.exists("script_hints", lambda s: rules.contains_any(F.lower(s), v.ENGINE_HINTS))
    named = rows.withColumns({"_hint": hint, "_semantic": rules.contains_any("semantic_text", v.SEMANTIC_3D) & rules.contains_any("semantic_text", v.SEMANTIC_TOOL)})
    webgl, viewer, asset = c("webgl_canvas_count") > 0, c("viewer_platform_count") > 0, c("asset_3d_count") > 0
    engine = c("three_global") | c("babylon_global") | c("blend4web_global")
    points = rules.total([
        (c("model_viewer_count") > 0, 7), (asset, 6), (c("asset_3d_count") >= 2, 1), (c("model_content_type_count") > 0, 4), (webgl, 3), (viewer, 2),
        ((c("iframe_count") > 0) & viewer, 2), ((c("visible_large_iframe_count") > 0) & (c("iframe_configurator_count") > 0), 2),
        ((c("large_iframe_count") > 0) & (asset | viewer | webgl), 3), (engine | c("model_viewer_global"), 2), (c("blend4web_global"), 3), (c("_hint"), 1),
        (webgl & (c("_hint") | engine | viewer), 4), (c("_semantic") & (webgl | c("_hint") | viewer | (c("large_iframe_count") > 0)), 3), (c("rotate_hint_count") > 0, 1),
    ])
    strong = (
        (c("model_viewer_count") > 0) | asset | (c("model_content_type_count") > 0)
        | (webgl & (viewer | c("_hint") | engine) & (c("_semantic") | (c("canvas_count") > 0)))
        | ((c("visible_large_iframe_count") > 0) & (viewer | asset | (c("model_content_type_count") > 0)))
    )
    controls_2d = (c("img_count") >= 1) & ((c("radio_count") >= 2) | (c("checkbox_count") >= 2) | (c("range_count") >= 1) | (c("option_count") >= 4) | (c("svg_count") >= 4))
    pointed = named.withColumns({"interactive_points": points, "strong_evidence": strong})
    is_3d = c("strong_evidence") & (c("interactive_points") >= 8)
    return pointed.withColumns({
        "visualization_type": F.when((c("model_viewer_count") > 0) | is_3d, "Interactive 3D").otherwise("Static 2D"),
        "visualization_confidence": F.when(c("model_viewer_count") > 0, 100).when(is_3d, 96).when(controls_2d, 90).otherwise(82),
    }).drop("_hint", "_semantic")


# --- scores 1 to 5 ----------------------------------------------------------------------------


def _share(part, whole) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


def mobile_score(metrics: DataFrame) -> DataFrame:
    """5 minus layout penalties, with reasons. A missing or zero overflow ratio counts as the worst.

    Touch is a touch point, a coarse pointer or no hovering; the latter two, and the greatest ratios seen while
    scrolling (``max_small_tap_ratio``, ``max_offscreen_ratio``, ``max_tiny_text_ratio``), are taken where the table
    has them, else the ratios follow from the counts.
    """
    c = F.col
    given = lambda n, otherwise: F.coalesce(F.col(n), F.lit(0.0)) if n in metrics.columns else otherwise
    has = lambda n: F.coalesce(F.col(n), F.lit(False)) if n in metrics.columns else F.lit(False)
    rows = metrics.withColumns({
        "_over": F.when(F.coalesce(c("overflow_ratio"), F.lit(0.0)) == 0, 999.0).otherwise(c("overflow_ratio")),
        "_small": given("max_small_tap_ratio", _share("small_tap_targets", "total_controls")), "_off": given("max_offscreen_ratio", _share("offscreen_controls", "total_controls")),
        "_tiny": given("max_tiny_text_ratio", _share("tiny_text_elements", "text_elements")),
    })
    many, texts = c("total_controls") >= 4, c("text_elements") >= 8
    terms = [
        (~c("viewport_meta_present"), 1, "no viewport meta"), (~c("mobile_user_agent_detected"), 1, "no mobile agent"), ((c("max_touch_points") <= 0) & ~has("coarse_pointer") & ~has("hover_none"), 1, "no touch"),
        (c("_over") > 1.20, 4, "severe overflow"), ((c("_over") > 1.08) & (c("_over") <= 1.20), 2, "overflow"), ((c("_over") > 1.03) & (c("_over") <= 1.08), 1, "slight overflow"),
        (many & (c("_small") > 0.60), 2, "most tap targets small"), (many & (c("_small") > 0.30) & (c("_small") <= 0.60), 1, "many tap targets small"),
        (~many & (c("small_tap_targets") >= 3), 1, "small tap targets"),
        (many & (c("_off") > 0.25), 2, "controls off screen"), (many & (c("_off") > 0.10) & (c("_off") <= 0.25), 1, "some controls off screen"),
        (texts & (c("_tiny") > 0.45), 2, "mostly tiny text"), (texts & (c("_tiny") > 0.20) & (c("_tiny") <= 0.45), 1, "tiny text"),
        (~texts & (c("tiny_text_elements") >= 5), 1, "some tiny text"), (c("large_fixed_overlays") >= 2, 1, "fixed overlays"),
    ]
    return rows.select(*metrics.columns, rules.clamp(5 - rules.total([(a, p) for a, p, _ in terms]), 1, 5).alias("mobile_score"), rules.reasons([(a, r) for a, _, r in terms]).alias("mobile_reasons"))


def dependency_score(metrics: DataFrame) -> DataFrame:
    """Option dependency from probe events, hints and disabled options."""
    c = F.col
    events, external, delta = c("dependency_events"), c("max_external_changes"), c("max_disabled_delta")
    base = (
        F.when((events >= 3) | (external >= 3) | (delta >= 4), 5).when((events >= 2) | (external >= 2) | (delta >= 2), 4).when(events >= 1, 2).otherwise(0))
    points = base + rules.total([
        ((c("max_text_changes") >= 2) | (c("max_selected_changes") >= 2) | (c("max_total_delta") >= 3), 1), (c("hint_count") >= 4, 2),
        ((c("hint_count") >= 1) & (c("hint_count") < 4), 1), (c("validation_hint_count") >= 3, 1),
        (((c("disabled_total") >= 12) & (c("density") >= 6)) | ((c("disabled_total") >= 4) & (c("density") >= 4) & (events >= 1)), 1),
        ((c("stepper_count") >= 2) & (events >= 1), 1),
    ])
    pointed = metrics.withColumn("dependency_points", points)
    p = c("dependency_points")
    return pointed.withColumn("dependency_score", F.when(p <= 0, 1).when(p <= 2, 2).when(p <= 4, 3).when(p <= 6, 4).otherwise(5))


def complexity_score(metrics: DataFrame) -> DataFrame:
    """Complexity from option groups, options, steps, layers and probes."""
    c = F.col
    groups, options, steps, layers = c("group_count"), c("option_total"), c("step_count"), c("layer_count")
    probes, probed = c("probe_actions"), c("probe_groups")
    base = (
        F.when((groups >= 8) | (options >= 45) | (layers >= 3) | (probed >= 6) | ((c("input_total") >= 2) & (groups >= 4)), 5)
        .when((groups >= 6) | (options >= 28) | (layers >= 2) | (probed >= 4) | c("has_dialog"), 4)
        .when((groups >= 4) | (options >= 14) | (steps >= 2) | (probed >= 3), 3)
        .when((groups >= 2) | (options >= 6) | (probes >= 2), 2).otherwise(1))
    extra = rules.total([(c("max_options") >= 10, 1), (c("tab_count") >= 4, 1), ((probes >= 3) & (c("advance_count") >= 1), 1)])
    return metrics.withColumn("complexity_score", F.least(base + extra, F.lit(5)))


# --- model answers ----------------------------------------------------------------------------

FIELDS = ["answer", "confidence", "score", "reason"]


def _json_candidates(raw) -> Column:
    """Texts to try as JSON, best first: whole, outermost braces, braces balanced, then the same
    with stray backslashes escaped."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(raw, "(?i)^\\s*```(?:json)?\\s*", ""), "\\s*```\\s*$", ""))
    outer = F.regexp_extract(plain, "(?s)(\\{.*\\})", 1)
    partial = F.regexp_extract(plain, "(?s)(\\{.*)$", 1)
    missing = F.regexp_count(partial, F.lit("\\{")) - F.regexp_count(partial, F.lit("\\}"))
    balanced = F.concat(partial, F.repeat(F.lit("}"), F.greatest(missing, F.lit(0))))
    tries = F.array(plain, outer, balanced)
    fixed = F.transform(tries, lambda t: F.regexp_replace(t, "\\\\(?![\"\\\\/bfnrtu])", "\\\\\\\\"))
    return F.filter(F.concat(tries, fixed), lambda t: t != "")


def recover_answers(answers: DataFrame, raw="raw_output") -> DataFrame:
    """Typed fields of model answers: JSON if it can be repaired, else fields by pattern, else a
    keyword guess, else nulls and an error mark."""
    schema = ", ".join(f"{f} string" for f in FIELDS)
    parsed = F.transform(_json_candidates(F.coalesce(raw, F.lit(""))), lambda t: F.when(F.is_valid_utf8(t) & F.get_json_object(t, "$").isNotNull(), F.from_json(t, schema)))
    first = F.get(F.filter(parsed, lambda p: p.isNotNull() & p["answer"].isNotNull() | p["score"].isNotNull() | p["confidence"].isNotNull() | p["reason"].isNotNull()), F.lit(0))
    pattern = lambda f: F.coalesce(
        F.nullif(F.regexp_extract(raw, f'(?is)"?{f}"?\\s*:\\s*"((?:[^"\\\\]|\\\\.)*)"', 1), F.lit("")),
        F.nullif(F.trim(F.regexp_replace(F.regexp_extract(raw, f'(?i)"?{f}"?\\s*:\\s*([^\\n,}}"]+)', 1), '^"|"$', "")), F.lit("")))
    rows = answers.withColumn("_p", first).withColumns({f"_{f}": F.coalesce(F.col("_p").getField(f), pattern(f)) for f in FIELDS})
    word = F.upper(F.trim("_answer"))
    said = F.when(word.isin("SI", "SÌ", "YES", "TRUE", "1"), "SI").when(word.isin("NO", "FALSE", "0"), "NO")
    weak = F.when(F.col(raw).rlike("(?i)\\b(yes|si|sì|active)\\b") & ~F.col(raw).rlike("(?i)\\b(no|not|inactive)\\b"), "SI").when(F.col(raw).rlike("(?i)\\b(no|not|inactive)\\b"), "NO")
    level = F.regexp_extract("_confidence", "([0-9]+(?:\\.[0-9]+)?)", 1).try_cast("double")
    score = F.regexp_extract("_score", "([1-5])", 1).try_cast("int")
    return rows.select(
        *answers.columns,
        F.coalesce(said, F.when(F.col("_answer").isNull() & F.col("_score").isNull(), weak)).alias("answer"),
        F.when(level <= 1, F.round(level * 100)).when(level <= 100, F.round(level)).when(level > 100, 100.0).cast("int").alias("confidence"),
        score.alias("score"), F.coalesce("_reason", F.lit("")).alias("reason"),
        F.when(F.col("_p").isNotNull(), "json").when(F.col("_answer").isNotNull() | F.col("_score").isNotNull(), "pattern").when(weak.isNotNull(), "keyword").otherwise("error").alias("recovered_by"),
    )


def hybrid_scores(rows: DataFrame) -> DataFrame:
    """Review routing and final scores of rules and model. A missing confidence counts as low."""
    c = F.col
    sure = F.coalesce(c("model_confidence") >= 70, F.lit(False)) & c("model_score").isNotNull()
    mixed = (c("positive_count") >= 2) & (c("negative_count") >= 2)
    mobile_review = (c("mobile_score") == 3) | (c("mobile_score").isin(2, 4) & mixed) | (c("has_dialog") & mixed)
    complexity_review = c("complexity_score").between(2, 4) | (c("layer_count") >= 2) | (c("group_count") >= 4)
    near = F.greatest(c("mobile_score") - 1, F.least(c("mobile_score") + 1, c("model_score")))
    return rows.withColumns({
        "mobile_review": mobile_review, "complexity_review": complexity_review,
        "mobile_final": F.when(mobile_review & sure, near).otherwise(c("mobile_score")),
        "dependency_final": F.when(sure, c("model_score")).otherwise(c("dependency_score")),
        "complexity_final": F.when(complexity_review & sure, c("model_score")).otherwise(c("complexity_score")),
    })


# --- gateway and candidate pages ----------------------------------------------------------------


def gateway_scores(signals: DataFrame, url="url") -> DataFrame:
    """Scores for working tools and for pages that lead to one."""
    c = F.col
    joined = lambda *lists: F.lower(F.concat_ws(" ", *[F.array_join(n, " ") for n in lists], "meta_description", "meta_og_description", url))
    rows = signals.withColumns({
        "_blob": joined("heading_texts", "button_texts", "link_texts", "label_texts", "cta_texts"), "_gate_blob": joined("heading_texts", "button_texts", "link_texts", "cta_texts"), "_url": F.lower(url),
        "_primary": c("select_count") + c("radio_count") + c("checkbox_count") + c("range_count") + c("number_input_count"),
    }).withColumn("_total", c("_primary") + c("option_count") + c("button_count"))
    tool_url = c("_url").rlike("custom|customi[sz]e|configurator|builder|unique|configure")
    grid = (c("product_card_count") >= 6) & (c("_primary") == 0) & ~rules.contains_any("_blob", ["apply", "finish"])
    effective = rules.total([
        (tool_url, 2), (rules.contains_any("_blob", v.EFFECTIVE_WORDS), 3), (c("_primary") >= 2, 3), (c("_primary") == 1, 1), (c("_total") >= 6, 2),
        (c("canvas_count") + c("model_viewer_count") + c("webgl_canvas_count") > 0, 1), (rules.contains_any("_blob", v.FINISH_WORDS), 2), (grid, -3)])
    gateway = rules.total([
        (rules.contains_any("_gate_blob", v.GATEWAY_PRIMARY_WORDS), 4), (rules.contains_any("_gate_blob", v.GATEWAY_CHOICE_WORDS), 2), (c("dialog_count") > 0, 3),
        (c("product_card_count") >= 3, 2), (c("clickable_count") >= 6, 1), (tool_url, 2), (c("_primary") >= 2, -2)])
    scored = rows.withColumns({"effective_score": effective, "_gateway": gateway, "_penalty": rules.contains_any("_gate_blob", v.GATEWAY_PENALTY_WORDS)})
    gate = F.when(c("_penalty") & (c("_gateway") > 0), c("_gateway") - 1).otherwise(c("_gateway"))
    return scored.select(
        *signals.columns, "effective_score", (c("effective_score") >= 5).alias("is_effective"), gate.alias("gateway_score"),
        ((c("effective_score") < 5) & (gate >= 4)).alias("is_gateway"))


def candidate_page(seeds: DataFrame, item, order) -> DataFrame:
    """First page per item, in seed order, that names both the company and the product."""
    full = F.lower(F.concat_ws(" ", "title", "url", "visible_text"))
    named = lambda n: (F.trim(n) != "") & F.contains(full, F.lower(F.trim(n)))
    return keep_first(seeds.filter(named("company") & named("product")).drop("visible_text"), item, order)


# --- links --------------------------------------------------------------------------------------


def compatible_domains(a, b) -> Column:
    """Same host, or one below the other."""
    a, b = col(a), col(b)
    return (a != "") & (b != "") & ((a == b) | F.endswith(a, F.concat(F.lit("."), b)) | F.endswith(b, F.concat(F.lit("."), a)))


def split_links(links: DataFrame, url="url") -> DataFrame:
    rows = links.withColumns({"page_host": text.domain_of(url), "link_host": text.domain_of("link_url")})
    return rows.withColumn("is_internal", compatible_domains("link_host", "page_host"))


def rank_internal_links(links: DataFrame, key, limit=8) -> DataFrame:
    """Best internal links per page by path and text signals."""
    rows = split_links(links).withColumn("link_url", text.canonical_url("link_url"))
    rows = rows.withColumn("_full", F.lower(F.concat_ws(" ", "link_url", "link_text")))
    kept = rows.filter(F.col("is_internal") & F.lower("link_url").rlike("^https?://") & ~rules.contains_any(F.lower("link_url"), v.EXCLUDED_LINK_PARTS) & ~rules.contains_any("_full", v.NEGATIVE_LINK_WORDS))
    promising = rules.contains_any("_full", v.PROMISING_LINK_WORDS) & ~rules.contains_any("_full", v.UNPROMISING_LINK_WORDS)
    score = F.when(promising, 8).otherwise(0) + rules.count_hits("_full", v.POSITIVE_PATH_WORDS) * 2 + F.when(F.col("link_host") == F.col("page_host"), 2).otherwise(0) + F.when(F.col("link_text") != "", 1).otherwise(0)
    scored = kept.withColumn("link_score", score).select(key, "link_position", "link_url", "link_text", "link_score")
    scored = keep_first(scored, [key, "link_url"], "link_position", where=F.col("link_score") > 0)
    return top_n(scored, key, [F.desc("link_score"), F.asc("link_url")], limit, "link_rank").select(key, "link_rank", "link_url", "link_text", "link_score")


def company_tokens(name) -> Column:
    """Words of a company's name that can stand in its domain: three or more letters or digits, no legal forms."""
    return F.filter(F.regexp_extract_all(F.lower(clean(name)), F.lit("[a-z0-9]+"), 0), lambda t: (F.length(t) > 2) & ~t.isin(v.COMPANY_STOP_WORDS))


def rank_external_links(links: DataFrame, key, company="company", limit=8, links_read=250) -> DataFrame:
    """Best external links per page as seeds of a search: official-looking ones, and those with the company's words in their host.

    The first ``links_read`` different links of a page are looked at; of one address the first that scores.
    """
    rows = split_links(links).withColumns({"_href": F.lower("link_url"), "_said": F.lower("link_text")})
    first = top_n(keep_first(rows, [key, "_href", "_said"], "link_position"), key, [F.asc("link_position")], links_read, "_place")
    seen = first.withColumn("link_url", text.canonical_url("link_url")).withColumns({"_url": F.lower("link_url"), "_tokens": company_tokens(company)})
    seen = seen.filter(seen._url.rlike("^https?://") & ~rules.contains_any("_url", v.EXCLUDED_LINK_PARTS) & ~F.col("is_internal")).withColumns({
        "_full": F.concat_ws(" ", "_url", F.lower("link_text")), "_host": text.domain_of("link_url")})
    named = F.size(F.filter("_tokens", lambda t: F.contains("_host", t)))
    official = ~rules.contains_any("_full", v.NO_SITE_WORDS) & (rules.contains_any("_full", v.SITE_WORDS) | (named > 0))
    score = F.when(official, 6).otherwise(0) + F.least(named * 3, F.lit(6)) + F.when(rules.contains_any("_full", v.SEED_WORDS), 2).otherwise(0) + F.when(F.col("link_text") != "", 1).otherwise(0)
    scored = keep_first(seen.withColumn("link_score", score).select(key, "link_position", "link_url", "link_text", "link_score"), [key, "link_url"], "link_position", where=F.col("link_score") > 0)
    return top_n(scored, key, [F.desc("link_score"), F.asc("link_url")], limit, "link_rank").select(key, "link_rank", "link_url", "link_text", "link_score")


def unprocessed(inputs: DataFrame, done: DataFrame, url="url") -> DataFrame:
    """Distinct input addresses that have no output yet."""
    return inputs.select(url).distinct().join(done.select(url).distinct(), url, "left_anti")


# --- resources, snapshots, probes -----------------------------------------------------------------


def resource_signals(resources: DataFrame, key, list_size=8, cap=50) -> DataFrame:
    """Counts (at most ``cap``) and first lists of 3D assets, AR assets, viewers, model types, frames.

    A resource is an address with its content type, whatever their case; counts and lists are of different
    addresses (for model types of addresses with their type).
    """
    rows = resources.withColumns({"_u": F.lower(clean("url")), "_t": F.lower(clean("content_type"))}).filter("_u <> ''")
    rows = keep_first(rows, [key, "_u", "_t"], "position")
    u, t = F.col("_u"), F.col("_t")
    model_type = t.startswith("model/") | F.contains(t, F.lit("gltf"))
    flags = {
        "asset_3d": rules.contains_any(u, v.MODEL_FILES) | model_type | (F.contains(t, F.lit("octet-stream")) & rules.contains_any(u, [f.removeprefix(".") for f in v.MODEL_FILES])),
        "ar_asset": F.contains(u, F.lit(".usdz")) | F.contains(t, F.lit("model/vnd.usdz")), "viewer_platform": rules.contains_any(u, v.VIEWER_WORDS),
        "model_content_type": model_type | (F.contains(t, F.lit("model")) & rules.contains_any(t, ["obj", "usdz"])),
        "iframe_configurator": F.contains(t, F.lit("frame")) & rules.contains_any(u, v.FRAME_WORDS),
    }
    named = lambda n: F.concat(clean("url"), F.lit(" ["), clean("content_type"), F.lit("]")) if n == "model_content_type" else clean("url")
    long = rows.select(key, "position", F.inline(F.array_compact(F.array(*[F.when(f, F.struct(F.lit(n).alias("signal"), named(n).alias("said"))) for n, f in flags.items()]))))
    once = keep_first(long.withColumn("_said", F.lower("said")), [key, "signal", "_said"], "position").drop("_said")
    counts = rows.groupBy(key).agg(F.count("*").alias("resource_count"))
    per = once.groupBy(key).agg(*[F.least(F.count_if(F.col("signal") == n), F.lit(cap)).cast("int").alias(f"{n}_count") for n in flags])
    head = top_n(once, [key, "signal"], [F.asc("position"), F.asc("said")], list_size, "_r")
    lists = head.groupBy(key).agg(*[F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("signal") == n, F.struct("_r", "said")))), lambda s: s["said"]), " | ").alias(f"{n}_urls") for n in flags])
    return counts.join(per, key, "left").join(lists, key, "left").fillna(0).fillna("")


def merge_snapshots(snapshots: DataFrame, key, order, numbers=(), flags=(), texts=(), lists=()) -> DataFrame:
    """One row per page: numbers by maximum, flags by or, texts by first filled, lists as the union of
    first-seen entries regardless of case."""
    filled = lambda t: F.min_by(F.nullif(F.col(t), F.lit("")), F.when(F.col(t) != "", F.col(order)))
    base = snapshots.groupBy(key).agg(
        *[F.max(n).alias(n) for n in numbers], *[F.bool_or(f).alias(f) for f in flags], *[F.coalesce(filled(t), F.lit("")).alias(t) for t in texts])
    for name in lists:
        entries = snapshots.select(key, order, F.posexplode(name).alias("_i", "_e")).withColumn("_k", F.lower("_e"))
        firsts = keep_first(entries, [key, "_k"], [order, "_i"])
        joined = firsts.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "_i", "_e"))), lambda s: s["_e"]), " | ").alias(name))
        base = base.join(joined, key, "left").fillna("", subset=[name])
    return base


STATE = ["total", "disabled", "selected_count", "text_fingerprint", "selected_fingerprint"]


def option_changes(groups: DataFrame, keys, totals=None) -> DataFrame:
    """Before/after comparison of option groups per action: one aggregation, both phases side by side.

    Groups without a key do not count. ``totals`` holds (keys, phase, disabled_total, option_like_total)
    of whole pages; a change of the disabled total is a change even where no group shows it.
    """
    side = lambda phase, n, default: F.coalesce(F.max(F.when(F.col("phase") == phase, F.col(n))), F.lit(default))
    defaults = {"total": 0, "disabled": 0, "selected_count": 0, "text_fingerprint": "", "selected_fingerprint": ""}
    named = groups.filter("group_key <> ''")
    both = named.groupBy(*keys, "acted_group", "group_key").agg(*[side(p, n, defaults[n]).alias(f"{p[0]}_{n}") for p in ("before", "after") for n in STATE])
    differs = lambda n: F.col(f"a_{n}") != F.col(f"b_{n}")
    changed = rules.any_of([differs(n) for n in STATE])
    other = changed & (F.col("group_key") != F.col("acted_group"))
    gain = lambda n: F.col(f"a_{n}") - F.col(f"b_{n}")
    sums = both.groupBy(*keys).agg(
        F.bool_or(changed).alias("any_change"), F.count_if(other).alias("external_group_changes"),
        F.sum(F.when(other, F.greatest(gain("disabled"), F.lit(0))).otherwise(0)).alias("disabled_delta_other"),
        F.count_if(other & differs("text_fingerprint")).alias("text_changes_other"),
        F.count_if(other & (differs("selected_fingerprint") | differs("selected_count"))).alias("selected_changes_other"),
        F.sum(F.when(other, F.abs(gain("total"))).otherwise(0)).alias("total_delta_other"))
    parts = ["external_group_changes", "disabled_delta_other", "text_changes_other", "selected_changes_other", "total_delta_other"]
    if totals is not None:
        signed = lambda n: F.sum(F.when(F.col("phase") == "after", F.coalesce(n, F.lit(0))).otherwise(-F.coalesce(n, F.lit(0))))
        deltas = totals.groupBy(*keys).agg(signed("disabled_total").alias("global_disabled_delta"), signed("option_like_total").alias("global_option_like_delta"))
        sums = deltas.join(sums, list(keys), "left").fillna(0, subset=parts)
        sums = sums.withColumn("any_change", F.coalesce("any_change", F.lit(False)) | (F.col("global_disabled_delta") != 0))
    return sums.withColumn("dependency_like", rules.any_of([F.col(p) >= 1 for p in parts]))


# Reasons of probe results.
NO_CANDIDATES = "no safe interactive candidates found for compatibility probing"
PROBE_REASONS = [
    "multiple probes changed other option groups after a selection",
    "at least one probe changed options outside the selected group",
    "probes changed local selection state but not later options",
    "interactive probes did not reveal visible cross-option dependencies",
]


def probe_statistics(changes: DataFrame, page, actions: DataFrame) -> DataFrame:
    """Per page of ``actions`` (page, action, success, null for a page without candidates): actions attempted
    and successful, events among the compared ones, greatest changes, reason."""
    count = lambda c, n: F.count_if(c).alias(n)
    sizes = ("external_group_changes", "disabled_delta_other", "text_changes_other", "selected_changes_other", "total_delta_other")
    events = ["any_change_events", "dependency_events", "disabled_increase_events", *[f"max_{n}" for n in sizes]]
    stats = changes.groupBy(page).agg(
        count(F.col("any_change"), events[0]), count(F.col("dependency_like"), events[1]), count(F.col("disabled_delta_other") > 0, events[2]),
        *[F.max(n).alias(f"max_{n}") for n in sizes])
    tried = actions.groupBy(page).agg(count(F.col("success").isNotNull(), "actions_attempted"), count(F.col("success"), "actions_successful"))
    full = tried.join(stats, page, "left").fillna(0, subset=events)
    return full.withColumn("probe_reason", F.when(F.col("actions_attempted") == 0, NO_CANDIDATES)
                           .when((F.col("dependency_events") >= 3) | (F.col("max_external_group_changes") >= 3), PROBE_REASONS[0])
                           .when(F.col("dependency_events") >= 1, PROBE_REASONS[1]).when(F.col("any_change_events") >= 1, PROBE_REASONS[2]).otherwise(PROBE_REASONS[3]))


def throughput(log: DataFrame, seconds, total_rows) -> DataFrame:
    """Rows done, mean seconds per row, estimated seconds left."""
    return log.agg(F.count("*").alias("rows_done"), F.round(F.avg(seconds), 4).alias("mean_seconds")).withColumn(
        "seconds_left", F.round(F.greatest(F.lit(total_rows) - F.col("rows_done"), F.lit(0)) * F.col("mean_seconds"), 2))


def with_details(rows: DataFrame, details: DataFrame, url="url") -> DataFrame:
    """List rows with the details of their address; an address is looked up once."""
    first = keep_first(details, url, [c for c in details.columns if c != url])
    return rows.join(first, url, "left")


def labels_of_codes(codes, labels) -> Column:
    """"a,b" to the labels of its codes; an unknown code is shown in capitals."""
    parts = F.filter(F.transform(F.split(col(codes), "[,;|\\s]+"), lambda t: F.lower(F.trim(t))), lambda t: t != "")
    return F.array_join(F.transform(parts, lambda t: F.coalesce(rules.lookup(t, labels), F.upper(t))), " | ")


# Brand-directory markup: one element per brand, facts in data attributes.
def brand_rows(pages: DataFrame, key, html="html") -> DataFrame:
    tags = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit("(?is)<[a-z]+\\s[^>]*class=[\"'][^\"']*\\bbrand\\b[^>]*>"), 0)).alias("position", "_tag"))
    fact = lambda n: clean(F.regexp_extract("_tag", f"(?i)data-{n}=[\"']([^\"']*)[\"']", 1))
    rows = tags.select(key, "position", fact("name").alias("brand_name"), fact("website").alias("website_url"), fact("standards").alias("standards_raw"), fact("country").alias("country_id"))
    codes = F.split(F.lower("standards_raw"), "[,;|\\s]+")
    return rows.filter("brand_name <> ''").withColumns({
        "has_made_in_green": F.array_contains(codes, "mig"), "has_standard_100": F.array_contains(codes, "std100"), "letter_group": F.upper(F.substring("brand_name", 1, 1))})
