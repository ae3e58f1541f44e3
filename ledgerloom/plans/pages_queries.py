"""Page, probe, answer and streaming-form queries."""

from pyspark.sql import functions as F

from ledgerloom.functions import page_values as v
from ledgerloom.functions import text
from ledgerloom.operators import discovery, pages
from ledgerloom.plans import check_sql as c
from ledgerloom.plans import dom_sql
from ledgerloom.plans.catalog import query
from ledgerloom.plans.discovery_queries import _P as PAGE
from ledgerloom.plans.discovery_queries import COMPANIES, LINKS, SCORED, companies, scored
from ledgerloom.plans.matching_queries import DECIDED, decided
from ledgerloom.plans.registry_queries import MASTER, master
from ledgerloom.sources import registry_files, sinks
from ledgerloom.streaming import jobs

# Pages as given, with controls and copy appended by position (the given pages have none).
_CONTROLS = """concat(html, CASE page_id % 10
    WHEN 0 THEN '<form><label>Select size</label><label>Choose colour</label><input type="radio"><input type="radio"><input type=checkbox><input type="checkbox"><input type="range"><select><option>A</option></select><button>Apply</button><button>Customize</button></form>'
    WHEN 1 THEN '<p>This domain is for sale. Buy this domain at Sedo</p>' WHEN 2 THEN '<p>404 Not Found</p>'
    WHEN 3 THEN '<article>Interview with the author. Published reviews</article>' WHEN 4 THEN '<img src="a.jpg"><img src="b.png"><model-viewer src="x.glb"></model-viewer><script src="three.min.js"></script>'
    WHEN 5 THEN '<div class="card"><a href="/one"><img src="A.JPG"></a><span>Nested <b>bold</b> text here</span><div>deeper block of text</div></div><div role="button">View in your space</div><input type=submit value="Send it"><button aria-label="Drag to rotate"></button><a>no address</a><a href="x.usdz" rel="ar">AR</a>'
    WHEN 6 THEN '<div class="popup big"><h2>Choose product</h2><h2>CHOOSE PRODUCT</h2></div><dialog>shut</dialog><div style="display: none" class="modal">unseen</div><meta property="og:description" content="Build yours"><meta name="description" content="Pick a model"><video></video><textarea></textarea><input type="text">'
    WHEN 7 THEN '<p>Coming soon' WHEN 8 THEN concat('<div class="tile"><img src="', page_id % 3, '.png"><span>Model one</span></div><div class="tile"><img src="2.png"><span>Model two</span></div><div class="tile"><img src="3.webp"><a href="#">Model three</a></div><a href="/custom">Design your own</a><button>Choose your bag</button>')
    ELSE '' END)"""
_URL = "CASE WHEN page_id % 10 = 8 THEN url || '/custom' WHEN page_id % 40 = 9 THEN 'https://jobs.upwork.com/x' WHEN page_id % 40 = 19 THEN regexp_extract(url, '^(https?://[^/]+)', 1) || '/en/' ELSE url END"


def a_pages(t):
    return t.pages.select("page_id", F.expr(_URL).alias("url"), F.expr(_CONTROLS).alias("html"))


def signals(t):
    return pages.dom_signals(a_pages(t))


_PAGES = f"WITH p AS (SELECT page_id, {_URL} AS url, {_CONTROLS} AS html FROM @pages), "
_SUMS = ["text_block_count", "dialog_count", "clickable_count", "product_card_count"]
query("t18_dom_signals", _PAGES + dom_sql.SIGNALS + f" SELECT page_id, {', '.join([*dom_sql.COUNTS, *_SUMS])} FROM sig")(
    lambda t: signals(t).select("page_id", *dom_sql.COUNTS, *_SUMS)
)
query("t18_dom_texts", _PAGES + dom_sql.SIGNALS + f" SELECT page_id, {', '.join([*dom_sql.TEXTS, 'meta_description', 'meta_og_description'])} FROM sig")(
    lambda t: signals(t).select("page_id", *[F.array_join(n, " | ").alias(n) for n in dom_sql.TEXTS], "meta_description", "meta_og_description")
)

query("t20_page_verdict", _PAGES + dom_sql.VERDICTS + " SELECT * FROM verdicts")(
    lambda t: pages.page_verdict(signals(t)).select("page_id", "control_score", "active", "reason", "confidence", "source"))

_W = lambda ws: c.any_hit("body", ws)
query("t20_keyword_negatives", f"""
    WITH x AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN lower(text) || ' this domain is for sale, make an offer' WHEN 1 THEN 'access denied ' || lower(text) WHEN 2 THEN lower(text) || ' site suspended' ELSE lower(text) END AS body FROM @documents)
    SELECT doc_id, {c.hits('body', v.SALE_PHRASES)} AS sale_hits, ({_W(v.ERROR_PHRASES)})::int AS error_page, {c.hits('body', v.EDITORIAL_WORDS)} AS editorial_hits, {c.hits('body', v.MARKETPLACE_WORDS)} AS marketplace_hits FROM x""")(
    lambda t: t.documents.select("doc_id", F.expr("CASE doc_id % 4 WHEN 0 THEN lower(text) || ' this domain is for sale, make an offer' WHEN 1 THEN 'access denied ' || lower(text) WHEN 2 THEN lower(text) || ' site suspended' ELSE lower(text) END").alias("body"))
    .select("doc_id", pages.rules.count_hits("body", v.SALE_PHRASES).alias("sale_hits"), pages.rules.contains_any("body", v.ERROR_PHRASES).cast("int").alias("error_page"),
            pages.rules.count_hits("body", v.EDITORIAL_WORDS).alias("editorial_hits"), pages.rules.count_hits("body", v.MARKETPLACE_WORDS).alias("marketplace_hits"))
)

query("t26_gateway_scores", _PAGES + dom_sql.GATEWAYS)(
    lambda t: pages.gateway_scores(signals(t)).select("page_id", "effective_score", F.col("is_effective").cast("int").alias("is_effective"), "gateway_score", F.col("is_gateway").cast("int").alias("is_gateway"))
)

# --- metrics from events --------------------------------------------------------------------------
_VIS = {"model_viewer_count": "event_id % 13 = 0", "asset_3d_count": "event_id % 5 = 0", "model_content_type_count": "event_id % 7 = 0", "webgl_canvas_count": "event_id % 3 = 0",
        "viewer_platform_count": "event_id % 4 = 0", "iframe_count": "event_id % 2 = 0", "visible_large_iframe_count": "event_id % 6 = 0", "iframe_configurator_count": "event_id % 9 = 0",
        "large_iframe_count": "event_id % 8 = 0", "rotate_hint_count": "event_id % 10 = 0", "canvas_count": "event_id % 3 = 0", "img_count": "true", "radio_count": "event_id % 11 = 0",
        "checkbox_count": "event_id % 17 = 0", "range_count": "event_id % 19 = 0", "option_count": "false", "svg_count": "false"}
_VIS_SQL = ", ".join(f"CASE WHEN {t} THEN 2 ELSE 0 END AS {n}" for n, t in _VIS.items()) + """, event_id % 21 = 0 AS three_global, false AS babylon_global, event_id % 23 = 0 AS blend4web_global,
    false AS model_viewer_global, CASE WHEN user_id % 2 = 0 THEN '3d viewer' ELSE event_type END AS semantic_text"""
query("t21_visualisation_points", f"""
    WITH m AS (SELECT event_id, {_VIS_SQL}, user_id % 5 = 0 AS hint FROM @events),
    s AS (SELECT *, semantic_text = '3d viewer' AS sem, webgl_canvas_count > 0 AS gl, viewer_platform_count > 0 AS vw, asset_3d_count > 0 AS a3, three_global OR blend4web_global AS eng FROM m),
    p AS (SELECT *, {c.total([("model_viewer_count > 0", 7), ("a3", 6), ("asset_3d_count >= 2", 1), ("model_content_type_count > 0", 4), ("gl", 3), ("vw", 2), ("iframe_count > 0 AND vw", 2),
          ("visible_large_iframe_count > 0 AND iframe_configurator_count > 0", 2), ("large_iframe_count > 0 AND (a3 OR vw OR gl)", 3), ("eng", 2), ("blend4web_global", 3), ("hint", 1),
          ("gl AND (hint OR eng OR vw)", 4), ("sem AND (gl OR hint OR vw OR large_iframe_count > 0)", 3), ("rotate_hint_count > 0", 1)])} AS interactive_points,
          model_viewer_count > 0 OR a3 OR model_content_type_count > 0 OR (gl AND (vw OR hint OR eng) AND (sem OR canvas_count > 0)) OR (visible_large_iframe_count > 0 AND (vw OR a3 OR model_content_type_count > 0)) AS strong FROM s)
    SELECT event_id, interactive_points, CASE WHEN model_viewer_count > 0 OR (strong AND interactive_points >= 8) THEN 'Interactive 3D' ELSE 'Static 2D' END AS visualization_type,
           CASE WHEN model_viewer_count > 0 THEN 100 WHEN strong AND interactive_points >= 8 THEN 96 WHEN radio_count >= 2 OR checkbox_count >= 2 OR range_count >= 1 THEN 90 ELSE 82 END AS visualization_confidence FROM p""")(
    lambda t: pages.visualisation_points(t.events.selectExpr("event_id", *_VIS_EXPRS, "if(user_id % 5 = 0, array('lib/three.min.js'), array('app.js')) AS script_hints"))
    .select("event_id", "interactive_points", "visualization_type", "visualization_confidence")
)
_VIS_EXPRS = [f"CASE WHEN {t} THEN 2 ELSE 0 END AS {n}" for n, t in _VIS.items()] + [
    "event_id % 21 = 0 AS three_global", "false AS babylon_global", "event_id % 23 = 0 AS blend4web_global", "false AS model_viewer_global",
    "CASE WHEN user_id % 2 = 0 THEN '3d viewer' ELSE event_type END AS semantic_text"]

_MOBILE = [
    "event_id", "CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 0.0e0 WHEN 2 THEN 1.0e0 WHEN 3 THEN 1.05e0 WHEN 4 THEN 1.15e0 ELSE 1.5e0 END AS overflow_ratio", "event_id % 11 AS total_controls",
    "event_id % 5 AS small_tap_targets", "event_id % 3 AS offscreen_controls", "event_id % 17 AS text_elements", "event_id % 7 AS tiny_text_elements", "event_id % 4 AS large_fixed_overlays",
    "user_id % 2 = 0 AS viewport_meta_present", "user_id % 3 <> 0 AS mobile_user_agent_detected", "user_id % 5 AS max_touch_points"]
_M_TERMS = [
    ("NOT viewport_meta_present", 1, "no viewport meta"), ("NOT mobile_user_agent_detected", 1, "no mobile agent"), ("max_touch_points <= 0", 1, "no touch"),
    ("o > 1.20", 4, "severe overflow"), ("o > 1.08 AND o <= 1.20", 2, "overflow"), ("o > 1.03 AND o <= 1.08", 1, "slight overflow"),
    ("total_controls >= 4 AND st > 0.6", 2, "most tap targets small"), ("total_controls >= 4 AND st > 0.3 AND st <= 0.6", 1, "many tap targets small"), ("total_controls < 4 AND small_tap_targets >= 3", 1, "small tap targets"),
    ("total_controls >= 4 AND os > 0.25", 2, "controls off screen"), ("total_controls >= 4 AND os > 0.1 AND os <= 0.25", 1, "some controls off screen"),
    ("text_elements >= 8 AND tt > 0.45", 2, "mostly tiny text"), ("text_elements >= 8 AND tt > 0.2 AND tt <= 0.45", 1, "tiny text"), ("text_elements < 8 AND tiny_text_elements >= 5", 1, "some tiny text"),
    ("large_fixed_overlays >= 2", 1, "fixed overlays")]
query("t22_mobile_score", f"""
    WITH m AS (SELECT {', '.join(_MOBILE)} FROM @events), s AS (SELECT *, CASE WHEN coalesce(overflow_ratio, 0) = 0 THEN 999 ELSE overflow_ratio END AS o, small_tap_targets / nullif(total_controls, 0)::double AS st,
         offscreen_controls / nullif(total_controls, 0)::double AS os, tiny_text_elements / nullif(text_elements, 0)::double AS tt FROM m)
    SELECT event_id, greatest(1, least(5, 5 - {c.total([(a, p) for a, p, _ in _M_TERMS])})) AS mobile_score, {c.reasons([(a, r) for a, _, r in _M_TERMS])} AS mobile_reasons FROM s""")(
    lambda t: pages.mobile_score(t.events.selectExpr(*_MOBILE)).select("event_id", "mobile_score", "mobile_reasons")
)

_SCROLLED = [*_MOBILE, "CASE WHEN event_id % 8 = 0 THEN NULL ELSE (event_id % 10) / 10.0e0 END AS max_small_tap_ratio", "(event_id % 7) / 14.0e0 AS max_offscreen_ratio", "(event_id % 9) / 12.0e0 AS max_tiny_text_ratio",
             "event_id % 5 = 0 AS coarse_pointer", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 7 = 0 END AS hover_none"]
_S_TERMS = [(f"{a} AND NOT coalesce(coarse_pointer, false) AND NOT coalesce(hover_none, false)" if r == "no touch" else a, p, r) for a, p, r in _M_TERMS]
query("t22_scrolled_mobile_score", f"""
    WITH m AS (SELECT {', '.join(_SCROLLED)} FROM @events), s AS (SELECT *, CASE WHEN coalesce(overflow_ratio, 0) = 0 THEN 999 ELSE overflow_ratio END AS o, coalesce(max_small_tap_ratio, 0) AS st, max_offscreen_ratio AS os, max_tiny_text_ratio AS tt FROM m)
    SELECT event_id, greatest(1, least(5, 5 - {c.total([(a, p) for a, p, _ in _S_TERMS])})) AS mobile_score, {c.reasons([(a, r) for a, _, r in _S_TERMS])} AS mobile_reasons FROM s""")(
    lambda t: pages.mobile_score(t.events.selectExpr(*_SCROLLED)).select("event_id", "mobile_score", "mobile_reasons")
)

_DEP = ["event_id", *[f"(event_id * {k} + user_id) % {m} AS {n}" for n, k, m in (
    ("dependency_events", 7, 5), ("max_external_changes", 3, 5), ("max_disabled_delta", 11, 6), ("max_text_changes", 5, 4), ("max_selected_changes", 13, 3), ("max_total_delta", 17, 5),
    ("hint_count", 19, 6), ("validation_hint_count", 23, 4), ("disabled_total", 29, 15), ("density", 31, 8), ("stepper_count", 37, 3))]]
query("t23_dependency_score", f"""
    WITH m AS (SELECT {', '.join(_DEP)} FROM @events), p AS (SELECT *, CASE WHEN dependency_events >= 3 OR max_external_changes >= 3 OR max_disabled_delta >= 4 THEN 5
         WHEN dependency_events >= 2 OR max_external_changes >= 2 OR max_disabled_delta >= 2 THEN 4 WHEN dependency_events >= 1 THEN 2 ELSE 0 END
         + (max_text_changes >= 2 OR max_selected_changes >= 2 OR max_total_delta >= 3)::int + CASE WHEN hint_count >= 4 THEN 2 WHEN hint_count >= 1 THEN 1 ELSE 0 END + (validation_hint_count >= 3)::int
         + ((disabled_total >= 12 AND density >= 6) OR (disabled_total >= 4 AND density >= 4 AND dependency_events >= 1))::int + (stepper_count >= 2 AND dependency_events >= 1)::int AS dependency_points FROM m)
    SELECT event_id, dependency_points, CASE WHEN dependency_points <= 0 THEN 1 WHEN dependency_points <= 2 THEN 2 WHEN dependency_points <= 4 THEN 3 WHEN dependency_points <= 6 THEN 4 ELSE 5 END AS dependency_score FROM p""")(
    lambda t: pages.dependency_score(t.events.selectExpr(*_DEP)).select("event_id", "dependency_points", "dependency_score")
)

_CPX = ["event_id", *[f"(event_id * {k} + user_id) % {m} AS {n}" for n, k, m in (
    ("group_count", 7, 10), ("option_total", 3, 50), ("step_count", 11, 4), ("layer_count", 5, 4), ("probe_actions", 13, 5), ("probe_groups", 17, 8), ("input_total", 19, 4), ("max_options", 23, 14), ("tab_count", 29, 6), ("advance_count", 31, 3))],
    "user_id % 9 = 0 AS has_dialog"]
query("t23_complexity_score", f"""
    WITH m AS (SELECT {', '.join(_CPX)} FROM @events)
    SELECT event_id, least(5, CASE WHEN group_count >= 8 OR option_total >= 45 OR layer_count >= 3 OR probe_groups >= 6 OR (input_total >= 2 AND group_count >= 4) THEN 5
           WHEN group_count >= 6 OR option_total >= 28 OR layer_count >= 2 OR probe_groups >= 4 OR has_dialog THEN 4 WHEN group_count >= 4 OR option_total >= 14 OR step_count >= 2 OR probe_groups >= 3 THEN 3
           WHEN group_count >= 2 OR option_total >= 6 OR probe_actions >= 2 THEN 2 ELSE 1 END + (max_options >= 10)::int + (tab_count >= 4)::int + (probe_actions >= 3 AND advance_count >= 1)::int) AS complexity_score FROM m""")(
    lambda t: pages.complexity_score(t.events.selectExpr(*_CPX)).select("event_id", "complexity_score")
)

_ANSWER = """CASE event_id % 6 WHEN 0 THEN concat('```json{"answer": "Yes", "confidence": 0.9, "score": 4, "reason": "', event_type, '"}```') WHEN 1 THEN concat('Sure: {"answer": "NO", "confidence": "85%", "score": "2/5", "reason": "', event_type, '"} done')
    WHEN 2 THEN concat('{"answer": "si", "confidence": 70, "score": 3, "reason": "', event_type, '"') WHEN 3 THEN concat('answer: NO, confidence: 55, score: 1, reason: ', event_type) WHEN 4 THEN concat('This page is active, ', event_type) ELSE '???' END"""
query("t24_recovered_answers", """
    SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'SI' WHEN 1 THEN 'NO' WHEN 2 THEN 'SI' WHEN 3 THEN 'NO' WHEN 4 THEN 'SI' ELSE '' END AS answer,
           CASE event_id % 6 WHEN 0 THEN 90 WHEN 1 THEN 85 WHEN 2 THEN 70 WHEN 3 THEN 55 ELSE -1 END AS confidence, CASE event_id % 6 WHEN 0 THEN 4 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 1 ELSE -1 END AS score,
           CASE WHEN event_id % 6 <= 3 THEN event_type ELSE '' END AS reason, CASE event_id % 6 WHEN 3 THEN 'pattern' WHEN 4 THEN 'keyword' WHEN 5 THEN 'error' ELSE 'json' END AS recovered_by FROM @events""")(
    lambda t: pages.recover_answers(t.events.select("event_id", F.expr(_ANSWER).alias("raw_output"))).select(
        "event_id", F.coalesce("answer", F.lit("")).alias("answer"), F.coalesce("confidence", F.lit(-1)).alias("confidence"), F.coalesce("score", F.lit(-1)).alias("score"), "reason", "recovered_by")
)
query("t24_conversation_answers")(
    lambda t: pages.recover_answers(t.conversations.filter("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("raw_output"))).select("conv_id", "turn", "answer", "confidence", "score", "recovered_by")
)

_HYB = ["event_id", *[f"cast((event_id * {k} + user_id) % 5 + 1 AS int) AS {n}" for n, k in (("mobile_score", 7), ("dependency_score", 11), ("complexity_score", 13))],
        "CASE WHEN event_id % 4 = 0 THEN NULL ELSE cast(event_id % 5 + 1 AS int) END AS model_score", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE cast(event_id % 100 AS int) END AS model_confidence",
        "user_id % 4 AS positive_count", "user_id % 3 AS negative_count", "user_id % 7 = 0 AS has_dialog", "user_id % 3 AS layer_count", "user_id % 6 AS group_count"]
query("t25_hybrid_scores", f"""
    WITH m AS (SELECT {', '.join(_HYB)} FROM @events), s AS (SELECT *, coalesce(model_confidence >= 70, false) AND model_score IS NOT NULL AS sure, positive_count >= 2 AND negative_count >= 2 AS mixed FROM m),
    r AS (SELECT *, mobile_score = 3 OR (mobile_score IN (2, 4) AND mixed) OR (has_dialog AND mixed) AS mr, complexity_score BETWEEN 2 AND 4 OR layer_count >= 2 OR group_count >= 4 AS cr FROM s)
    SELECT event_id, mr::int AS mobile_review, cr::int AS complexity_review, CASE WHEN mr AND sure THEN greatest(mobile_score - 1, least(mobile_score + 1, model_score)) ELSE mobile_score END AS mobile_final,
           CASE WHEN sure THEN model_score ELSE dependency_score END AS dependency_final, CASE WHEN cr AND sure THEN model_score ELSE complexity_score END AS complexity_final FROM r""")(
    lambda t: pages.hybrid_scores(t.events.selectExpr(*_HYB)).select("event_id", F.col("mobile_review").cast("int").alias("mobile_review"), F.col("complexity_review").cast("int").alias("complexity_review"),
                                                                 "mobile_final", "dependency_final", "complexity_final")
)

# --- candidate pages, links -------------------------------------------------------------------------
query("t27_candidate_pages", f"""
    WITH p AS (SELECT page_id, url, {PAGE['visible_text']} AS body FROM @pages),
    s AS (SELECT p_partkey, page_id, CASE WHEN p_partkey % 3 = 1 THEN split_part(body, ' ', 9) ELSE p_brand END AS company, p_name AS product,
                 CASE WHEN p_partkey % 3 = 0 THEN p_brand || ' ' ELSE '' END || p_name || ' studio' AS title, url, body FROM a_parts JOIN p ON page_id = page_ref)
    SELECT p_partkey, page_id, title FROM s WHERE company <> '' AND contains(lower(title || ' ' || url || ' ' || body), lower(company)) AND contains(lower(title || ' ' || url || ' ' || body), lower(product))""")(
    lambda t: pages.candidate_page(t.a_parts.join(discovery.page_text(t.pages).select("page_id", "url", "visible_text"), F.col("page_id") == F.col("page_ref")).select(
        "p_partkey", "page_id", F.when(F.col("p_partkey") % 3 == 1, F.split_part("visible_text", F.lit(" "), F.lit(9))).otherwise(F.col("p_brand")).alias("company"), F.col("p_name").alias("product"),
        F.expr("CASE WHEN p_partkey % 3 = 0 THEN p_brand || ' ' ELSE '' END || p_name || ' studio'").alias("title"), "url", "visible_text"), "p_partkey", "page_id").select("p_partkey", "page_id", "title")
)


def links(t):
    found = discovery.page_links(t.pages.select("page_id", "url", "html"))
    return found.withColumn("link_text", F.when(F.col("link_position") % 3 == 0, F.concat(F.lit("Custom builder "), "link_text")).otherwise(F.col("link_text"))).withColumn(
        "link_url", F.when(F.col("link_position") % 5 == 4, "https://other.example.org/blog").otherwise(F.col("link_url")))


_L = LINKS + f""", x AS (SELECT page_id, url, link_position, CASE WHEN link_position % 3 = 0 THEN 'Custom builder ' || link_text ELSE link_text END AS link_text,
    CASE WHEN link_position % 5 = 4 THEN 'https://other.example.org/blog' ELSE link_url END AS link_url FROM links),
    sp AS (SELECT *, {c.domain('url')} AS page_host, {c.domain('link_url')} AS link_host FROM x),
    split AS (SELECT *, page_host = link_host OR ends_with(link_host, '.' || page_host) OR ends_with(page_host, '.' || link_host) AS is_internal FROM sp)"""
query("j11_internal_links", _L + "SELECT page_id, link_position, link_url, page_host, link_host, is_internal::int AS is_internal FROM split")(
    lambda t: pages.split_links(links(t)).select("page_id", "link_position", "link_url", "page_host", "link_host", F.col("is_internal").cast("int").alias("is_internal"))
)
_F = "lower(lu || ' ' || link_text)"
query("w11_ranked_links", _L + f"""
    , cn AS (SELECT *, CASE WHEN regexp_matches(link_url, '^[a-z]+://[^/]*/?$') THEN rtrim(link_url, '/') || '/' ELSE rtrim(split_part(split_part(link_url, '#', 1), '?', 1), '/') END AS lu FROM split WHERE is_internal),
    k AS (SELECT *, CASE WHEN {c.any_hit(_F, v.PROMISING_LINK_WORDS)} AND NOT {c.any_hit(_F, v.UNPROMISING_LINK_WORDS)} THEN 8 ELSE 0 END + 2 * {c.hits(_F, v.POSITIVE_PATH_WORDS)} + CASE WHEN link_host = page_host THEN 2 ELSE 0 END
          + CASE WHEN link_text <> '' THEN 1 ELSE 0 END AS link_score FROM cn WHERE NOT {c.any_hit(_F, v.NEGATIVE_LINK_WORDS)} AND NOT {c.any_hit('lower(lu)', v.EXCLUDED_LINK_PARTS)}),
    f AS (SELECT *, row_number() OVER (PARTITION BY page_id, lu ORDER BY link_position) AS again FROM k WHERE link_score > 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY link_score DESC, lu) AS link_rank FROM f WHERE again = 1)
    SELECT page_id, link_rank, lu AS link_url, link_text, link_score FROM r WHERE link_rank <= 8""")(
    lambda t: pages.rank_internal_links(links(t), "page_id")
)
_SEED_URL = """CASE link_position % 6 WHEN 0 THEN 'https://www.acme-tools.example.org/x?y=' || page_id WHEN 1 THEN 'https://cdn.acme.example.net/blog/' WHEN 2 THEN 'https://amazon.de/acme' WHEN 3 THEN 'https://plain.example.net/p/' || link_position
    WHEN 4 THEN 'https://www.facebook.com/acme' ELSE link_url END"""
_SEED_TEXT = "CASE WHEN link_position % 6 = 3 AND page_id % 2 = 0 THEN '' WHEN link_position % 6 = 0 THEN 'Official site' ELSE link_text END"
_COMPANY = "CASE page_id % 3 WHEN 0 THEN 'The ACME Tools GmbH' WHEN 1 THEN 'Plain & Co' ELSE '' END"
query("w11_external_seeds", LINKS + f""", x AS (SELECT page_id, url, link_position, {_SEED_TEXT} AS link_text, {_SEED_URL} AS link_url, {_COMPANY} AS company FROM links),
    sp AS (SELECT *, {c.domain('url')} AS page_host, {c.domain('link_url')} AS link_host, row_number() OVER (PARTITION BY page_id, lower(link_url), lower(link_text) ORDER BY link_position) AS again FROM x),
    f AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY link_position) AS place FROM sp WHERE again = 1),
    cn AS (SELECT *, CASE WHEN regexp_matches(link_url, '^[a-z]+://[^/]*/?$') THEN rtrim(link_url, '/') || '/' ELSE rtrim(split_part(split_part(link_url, '#', 1), '?', 1), '/') END AS lu FROM f
           WHERE place <= 250 AND NOT (page_host = link_host OR ends_with(link_host, '.' || page_host) OR ends_with(page_host, '.' || link_host))),
    t AS (SELECT *, lower(lu || ' ' || link_text) AS ful, len(list_filter(regexp_extract_all(lower(company), '[a-z0-9]+'), lambda w: length(w) > 2 AND w NOT IN ({c.quoted(v.COMPANY_STOP_WORDS)}) AND contains(link_host, w))) AS named FROM cn
          WHERE NOT {c.any_hit('lower(lu)', v.EXCLUDED_LINK_PARTS)}),
    k AS (SELECT *, CASE WHEN NOT {c.any_hit('ful', v.NO_SITE_WORDS)} AND ({c.any_hit('ful', v.SITE_WORDS)} OR named > 0) THEN 6 ELSE 0 END + least(named * 3, 6) + CASE WHEN {c.any_hit('ful', v.SEED_WORDS)} THEN 2 ELSE 0 END + CASE WHEN link_text <> '' THEN 1 ELSE 0 END AS link_score FROM t),
    g AS (SELECT *, row_number() OVER (PARTITION BY page_id, lu ORDER BY link_position) AS first_ FROM k WHERE link_score > 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY link_score DESC, lu) AS link_rank FROM g WHERE first_ = 1)
    SELECT page_id, link_rank, lu AS link_url, link_text, link_score FROM r WHERE link_rank <= 8""")(
    lambda t: pages.rank_external_links(
        discovery.page_links(t.pages.select("page_id", "url", "html")).select("page_id", "url", "link_position", F.expr(_SEED_TEXT).alias("link_text"), F.expr(_SEED_URL).alias("link_url"), F.expr(_COMPANY).alias("company")), "page_id")
)
query("u2_unprocessed_urls", "SELECT DISTINCT url FROM @pages WHERE url NOT IN (SELECT url FROM @pages WHERE page_id % 3 = 0)")(
    lambda t: pages.unprocessed(t.pages, t.pages.filter("page_id % 3 = 0"))
)
query("j7_detail_enrichment", """
    WITH d AS (SELECT url, lang, doc_id, row_number() OVER (PARTITION BY url ORDER BY lang, doc_id) AS rn FROM @documents JOIN @pages ON page_id = doc_id WHERE page_id % 4 <> 0)
    SELECT p.page_id, p.url, coalesce(d.lang, '') AS lang, coalesce(d.doc_id, -1) AS doc_id FROM @pages p LEFT JOIN d ON d.url = p.url AND d.rn = 1""")(
    lambda t: pages.with_details(t.pages.select("page_id", "url"), t.pages.filter("page_id % 4 <> 0").join(t.documents, F.col("doc_id") == F.col("page_id")).select("url", "lang", "doc_id"))
    .fillna("", subset=["lang"]).fillna(-1, subset=["doc_id"])
)
query("j8_code_lookup", """
    SELECT c_custkey, coalesce(n_name, '') AS country_name, CASE c_custkey % 3 WHEN 0 THEN 'MADE IN GREEN | STANDARD 100' WHEN 1 THEN 'STANDARD 100' ELSE 'XYZ' END AS standards
    FROM @customer LEFT JOIN (SELECT * FROM @nation WHERE n_nationkey <> 7) ON n_nationkey = c_nationkey""")(
    lambda t: t.customer.join(t.nation.filter("n_nationkey <> 7"), F.col("n_nationkey") == F.col("c_nationkey"), "left").select(
        "c_custkey", F.coalesce("n_name", F.lit("")).alias("country_name"),
        pages.labels_of_codes(F.expr("CASE c_custkey % 3 WHEN 0 THEN 'mig, STD100' WHEN 1 THEN 'std100' ELSE 'xyz' END"), {"mig": "MADE IN GREEN", "std100": "STANDARD 100"}).alias("standards"))
)

# --- snapshots, resources, probes --------------------------------------------------------------------
_GROUP_COLUMNS = [
    "user_id % 500 AS page", "cast(floor(event_id / 40) AS bigint) AS action", "CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS group_key", "'click' AS acted_group",
    "CASE WHEN event_id % 2 = 0 THEN 'before' ELSE 'after' END AS phase", "cast(event_id % 7 AS int) AS total",
    "cast(event_id % 3 AS int) AS disabled", "cast(event_id % 2 AS int) AS selected_count",
    "cast(event_id % 5 AS string) AS text_fingerprint", "cast(user_id % 2 AS string) AS selected_fingerprint"]
CHANGES = f"""
    WITH g AS (SELECT {', '.join(_GROUP_COLUMNS)} FROM @events), b AS (SELECT page, action, acted_group, group_key, {', '.join(f"coalesce(max({n}) FILTER (WHERE phase = '{p}'), {d}) AS {p[0]}_{n}" for p in ('before', 'after')
                     for n, d in (('total', 0), ('disabled', 0), ('selected_count', 0), ('text_fingerprint', "''"), ('selected_fingerprint', "''")))} FROM g WHERE group_key <> '' GROUP BY 1, 2, 3, 4),
    d AS (SELECT *, {' OR '.join(f'a_{n} <> b_{n}' for n in pages.STATE)} AS ch FROM b), e AS (SELECT *, ch AND group_key <> acted_group AS ot FROM d),
    s AS (SELECT page, action, bool_or(ch) AS any_change, count(*) FILTER (WHERE ot) AS external_group_changes, coalesce(sum(greatest(a_disabled - b_disabled, 0)) FILTER (WHERE ot), 0) AS disabled_delta_other,
                 count(*) FILTER (WHERE ot AND a_text_fingerprint <> b_text_fingerprint) AS text_changes_other, count(*) FILTER (WHERE ot AND (a_selected_fingerprint <> b_selected_fingerprint OR a_selected_count <> b_selected_count)) AS selected_changes_other,
                 coalesce(sum(abs(a_total - b_total)) FILTER (WHERE ot), 0) AS total_delta_other FROM e GROUP BY 1, 2),
    w AS (SELECT page, action, cast(sum(CASE WHEN phase = 'after' THEN disabled ELSE -disabled END) AS bigint) AS global_disabled_delta, cast(sum(CASE WHEN phase = 'after' THEN total ELSE -total END) AS bigint) AS global_option_like_delta FROM g GROUP BY 1, 2),
    sw AS (SELECT w.page, w.action, coalesce(any_change, false) OR global_disabled_delta <> 0 AS any_change, global_disabled_delta, global_option_like_delta,
                  {', '.join(f'coalesce({n}, 0) AS {n}' for n in ('external_group_changes', 'disabled_delta_other', 'text_changes_other', 'selected_changes_other', 'total_delta_other'))} FROM w LEFT JOIN s USING (page, action)),
    changes AS (SELECT *, external_group_changes >= 1 OR disabled_delta_other >= 1 OR text_changes_other >= 1 OR selected_changes_other >= 1 OR total_delta_other >= 1 AS dependency_like FROM sw)"""


def changes(t):
    groups = t.events.selectExpr(*_GROUP_COLUMNS)
    totals = groups.groupBy("page", "action", "phase").agg(F.sum("disabled").alias("disabled_total"), F.sum("total").alias("option_like_total"))
    return pages.option_changes(groups, ["page", "action"], totals)


_ACTIONS = ["user_id % 500 AS page", "event_id AS action", "CASE WHEN user_id % 500 = 3 THEN NULL ELSE event_id % 4 <> 0 END AS success"]


query("j10_option_changes", CHANGES + "SELECT * REPLACE (any_change::int AS any_change, dependency_like::int AS dependency_like) FROM changes")(
    lambda t: changes(t).withColumns({n: F.col(n).cast("int") for n in ("any_change", "dependency_like")})
)
query("a34_probe_statistics", CHANGES + f"""
    , p AS (SELECT page, count(*) FILTER (WHERE any_change) AS any_change_events, count(*) FILTER (WHERE dependency_like) AS dependency_events, count(*) FILTER (WHERE disabled_delta_other > 0) AS disabled_increase_events,
            max(external_group_changes) AS max_external_group_changes, max(disabled_delta_other) AS max_disabled_delta_other, max(text_changes_other) AS max_text_changes_other, max(selected_changes_other) AS max_selected_changes_other,
            max(total_delta_other) AS max_total_delta_other FROM changes GROUP BY 1),
    t AS (SELECT page, count(success) AS actions_attempted, count(*) FILTER (WHERE success) AS actions_successful FROM (SELECT {', '.join(_ACTIONS)} FROM @events) GROUP BY 1)
    SELECT *, CASE WHEN actions_attempted = 0 THEN 'no safe interactive candidates found for compatibility probing' WHEN dependency_events >= 3 OR max_external_group_changes >= 3 THEN 'multiple probes changed other option groups after a selection'
                   WHEN dependency_events >= 1 THEN 'at least one probe changed options outside the selected group' WHEN any_change_events >= 1 THEN 'probes changed local selection state but not later options'
                   ELSE 'interactive probes did not reveal visible cross-option dependencies' END AS probe_reason FROM t JOIN p USING (page)""")(
    lambda t: pages.probe_statistics(changes(t), "page", t.events.selectExpr(*_ACTIONS))
)
query("a32_merged_snapshots", """
    WITH s AS (SELECT user_id AS page, event_id, cast(floor(value) AS int) AS button_count, event_type = 'click' AS has_canvas, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS title, [event_type, upper(event_type), props] AS l FROM @events),
    e AS (SELECT page, event_id, unnest(l) AS v, generate_subscripts(l, 1) AS i FROM s), f AS (SELECT *, row_number() OVER (PARTITION BY page, lower(v) ORDER BY event_id, i) AS rn FROM e),
    ls AS (SELECT page, string_agg(v, ' | ' ORDER BY event_id, i) AS texts FROM f WHERE rn = 1 GROUP BY 1)
    SELECT page, max(button_count) AS button_count, bool_or(has_canvas)::int AS has_canvas, coalesce(arg_min(title, event_id) FILTER (WHERE title <> ''), '') AS title, any_value(texts) AS texts FROM s JOIN ls USING (page) GROUP BY 1""")(
    lambda t: pages.merge_snapshots(t.events.select(
        F.col("user_id").alias("page"), "event_id", F.floor("value").cast("int").alias("button_count"), (F.col("event_type") == "click").alias("has_canvas"),
        F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_type")).alias("title"), F.array("event_type", F.upper("event_type"), "props").alias("texts")),
        "page", "event_id", ["button_count"], ["has_canvas"], ["title"], ["texts"]).withColumn("has_canvas", F.col("has_canvas").cast("int"))
)


_RESOURCE_URL = """CASE position % 9 WHEN 0 THEN concat(link_url, '.glb') WHEN 1 THEN concat(link_url, '/three.min.js') WHEN 2 THEN concat(link_url, '.usdz') WHEN 3 THEN ' https://x.example/configurator' WHEN 4 THEN concat(link_url, '/objfile')
    WHEN 5 THEN concat(link_url, '/scene') WHEN 6 THEN 'HTTPS://X.example/Configurator' WHEN 7 THEN concat(link_url, '/a.bin') ELSE '' END"""
_RESOURCE_TYPE = "CASE position % 9 WHEN 0 THEN 'model/gltf-binary' WHEN 3 THEN 'frame' WHEN 4 THEN 'application/octet-stream' WHEN 5 THEN 'x-model-obj' WHEN 6 THEN CASE WHEN page_id % 2 = 0 THEN 'Frame' ELSE 'iframe' END WHEN 7 THEN 'model/vnd.usdz+zip' ELSE NULL END"


def all_resources(t):
    found = discovery.page_links(t.pages.select("page_id", "url", "html")).select("page_id", F.col("link_position").alias("position"), "link_url")
    return found.select("page_id", "position", F.expr(_RESOURCE_URL).alias("url"), F.expr(_RESOURCE_TYPE).alias("content_type"))


def _listed(flag, value, name):
    return f"""(SELECT page_id, '{name}' AS signal, said, position FROM (SELECT page_id, {value} AS said, position, row_number() OVER (PARTITION BY page_id, lower({value}) ORDER BY position) AS again FROM d WHERE rn = 1 AND {flag}) WHERE again = 1)"""


_MODEL_TYPE = "(starts_with(t, 'model/') OR contains(t, 'gltf'))"
_SIGNALS = {
    "asset_3d": (f"({c.any_hit('u', v.MODEL_FILES)} OR {_MODEL_TYPE} OR (contains(t, 'octet-stream') AND {c.any_hit('u', [x[1:] for x in v.MODEL_FILES])}))", "cu"), "ar_asset": ("(contains(u, '.usdz') OR contains(t, 'model/vnd.usdz'))", "cu"),
    "viewer_platform": (c.any_hit("u", v.VIEWER_WORDS), "cu"), "model_content_type": (f"({_MODEL_TYPE} OR (contains(t, 'model') AND (contains(t, 'obj') OR contains(t, 'usdz'))))", "cu || ' [' || ct || ']'"),
    "iframe_configurator": (f"(contains(t, 'frame') AND {c.any_hit('u', v.FRAME_WORDS)})", "cu")}
query("a33_resource_signals", LINKS + f"""
    , r AS (SELECT page_id, position, {c.clean(_RESOURCE_URL)} AS cu, {c.clean(_RESOURCE_TYPE)} AS ct FROM (SELECT page_id, link_position AS position, link_url FROM links)),
    d AS (SELECT *, lower(cu) AS u, lower(ct) AS t, row_number() OVER (PARTITION BY page_id, lower(cu), lower(ct) ORDER BY position) AS rn FROM r WHERE cu <> ''),
    l AS ({' UNION ALL '.join(_listed(flag, value, n) for n, (flag, value) in _SIGNALS.items())}), p AS (SELECT *, row_number() OVER (PARTITION BY page_id, signal ORDER BY position, said) AS place FROM l)
    SELECT page_id, resource_count, {', '.join(f"coalesce({n}_count, 0) AS {n}_count, coalesce({n}_urls, '') AS {n}_urls" for n in _SIGNALS)} FROM (SELECT page_id, count(*) AS resource_count FROM d WHERE rn = 1 GROUP BY 1)
    LEFT JOIN (SELECT page_id, {', '.join(f"least(50, count(*) FILTER (WHERE signal = '{n}')) AS {n}_count, string_agg(said, ' | ' ORDER BY place) FILTER (WHERE signal = '{n}' AND place <= 8) AS {n}_urls" for n in _SIGNALS)} FROM p GROUP BY 1) USING (page_id)""")(
    lambda t: pages.resource_signals(all_resources(t), "page_id")
)
query("a35_throughput", "SELECT count(*) AS rows_done, round(avg(value), 4) AS mean_seconds, round(greatest(200000 - count(*), 0) * round(avg(value), 4), 2) AS seconds_left FROM @events")(
    lambda t: pages.throughput(t.events, "value", 200000)
)
query("r2_scrape_monitor", """
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS bucket_start, event_type, count(*) AS rounds, sum(cast(floor(value) AS bigint)) AS new_rows, round(avg(value), 4) AS mean_seconds FROM @events GROUP BY 1, 2""")(
    lambda t: jobs.monitor(t.events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", F.floor("value").cast("bigint").alias("new_rows"), F.col("value").alias("seconds")))
    .withColumn("bucket_start", F.date_format("bucket_start", "yyyy-MM-dd"))
)


def _audit_counts(t):
    path = sinks.shared_folder(t.spark)
    sinks.write_by_decision(sinks.truncate_strings(decided(t)), path)
    return t.spark.read.parquet(path).groupBy("decision", "confidence").agg(F.count("*").alias("rows"))

query("s5_decision_partitions", DECIDED + "SELECT decision, confidence, count(*) AS rows FROM decided GROUP BY 1, 2")(_audit_counts)


def _reread(t):
    """Registry rows written as CSV files per certification folder, found, read and standardised again."""
    folder = f"{sinks.shared_folder(t.spark)}/csv"
    rows = t.a_registry.select("certification", F.col("certified_company").alias("Company Name"), F.col("certified_brand").alias("Brand"), F.col("certified_product").alias("Product"),
                               F.col("certificate_identifier").alias("Licence"), F.col("source_url").alias("Profile URL"), F.col("certification").alias("certification_name"))
    rows.write.partitionBy("certification").option("header", True).option("quoteAll", True).option("escape", '"').csv(folder)
    return registry_files.read_csv_registry(t.spark, folder, quoted_lines=True).groupBy("certification").agg(
        F.count("*").alias("rows"), F.count_distinct("certified_company").alias("companies"), F.count_if(F.col("certificate_identifier") != "").alias("identified"))


query("s2_registry_files", f"""
    SELECT certification, count(*) AS rows, count(DISTINCT {c.clean('certified_company')}) AS companies, count(*) AS identified FROM a_registry GROUP BY 1""")(_reread)




def _appended(t):
    """Order lines appended in three batches with keys in common, the second one twice."""
    target = f"{sinks.shared_folder(t.spark)}/appended"
    rows = t.lineitem.select(F.concat_ws("-", "l_partkey", "l_suppkey").alias("record_key"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("src_ordinal"), (F.col("l_linenumber") % 3).alias("batch_number"))
    for number in (0, 1, 1, 2):
        jobs.append_batch(rows.filter(F.col("batch_number") == number).drop("batch_number"), number, target)
    return t.spark.read.parquet(target).select("record_key", "src_ordinal", F.col("batch").cast("bigint").alias("batch"))


query("r1_append_batches", """
    WITH r AS (SELECT l_partkey || '-' || l_suppkey AS record_key, l_orderkey * 10 + l_linenumber AS src_ordinal, l_linenumber % 3 AS batch FROM @lineitem),
    f AS (SELECT *, row_number() OVER (PARTITION BY record_key ORDER BY batch, src_ordinal) AS rn FROM r)
    SELECT record_key, src_ordinal, cast(batch AS bigint) AS batch FROM f WHERE rn = 1""")(_appended)

# Registry folders with their expected names; each holds several CSV files with brands of their own.
_FOLDERS = {"B Corp": "b_corp", "Bluesign": "bluesign", "EU Ecolabel": "eu_ecolabel", "GOTS": "gots"}


def _folders(t):
    folder = f"{sinks.shared_folder(t.spark)}/registries"
    rows = t.lineitem.select(
        F.element_at(F.array(*[F.lit(f) for f in _FOLDERS.values()]), (F.col("l_orderkey") % 4 + 1).cast("int")).alias("at"),
        F.format_string("companies_%d.csv", F.col("l_linenumber")).alias("file"),
        F.concat(F.lit("Company "), F.col("l_suppkey")).alias("Company Name"), F.concat(F.lit("Product "), F.col("l_partkey") % 50).alias("Product"),
        F.concat(F.lit("L-"), "l_orderkey").alias("Licence"))
    rows.repartition("at", "file").sortWithinPartitions("Licence").write.partitionBy("at", "file").option("header", True).csv(folder)
    return folder


def _master(t):
    """Folders are read where Spark wrote them: a folder's name holds the registry's, a file's is Spark's."""
    folder = _folders(t)
    rows = registry_files.read_csv_registry(t.spark, folder)
    return rows.groupBy("source_file").agg(
        F.count("*").alias("rows"), F.min("source_row_number").alias("first_row"), F.max("source_row_number").alias("last_row"),
        F.count_distinct("source_row_number").alias("places")).groupBy("first_row").agg(
        F.count("*").alias("files"), F.sum("rows").alias("rows"), F.sum(F.col("last_row") - 1).alias("last_places"), F.sum("places").alias("places"))


query("s2_row_numbers", """
    SELECT cast(2 AS bigint) AS first_row, count(DISTINCT (l_orderkey % 4, l_linenumber)) AS files, count(*) AS rows, count(*) AS last_places, count(*) AS places FROM @lineitem""")(_master)
def _written_in_order(t, rows, table):
    """Writes a table in its canonical order and reports on the files, as many as Spark's shuffles have partitions."""
    spark = rows.sparkSession
    path = f"{sinks.shared_folder(spark)}/{table}"
    sinks.write_ordered(rows, path, *sinks.ordered_by(table))
    return sinks.order_report(spark, path, table)


_IN_ORDER = "SELECT count(*) AS rows, 0 AS breaks_in_files, 0 AS breaks_between_files FROM "
query("l2_master_order", MASTER + _IN_ORDER + "master")(lambda t: _written_in_order(t, master(t), "master"))
query("l2_source_order", SCORED + _IN_ORDER + "scored")(lambda t: _written_in_order(t, scored(t).withColumn("company_name_normalized", text.match_key("company_name")), "sources"))
query("l2_summary_order", COMPANIES + _IN_ORDER + "uc")(
    lambda t: _written_in_order(t, discovery.company_summary(companies(t), scored(t)).withColumn("company_name_normalized", text.match_key("company_name")), "summary"))
query("l2_ordered_output", "SELECT certification, certificate_identifier, src_ordinal, src_tie FROM a_registry")(
    lambda t: t.a_registry.select("certification", "certificate_identifier", "src_ordinal", "src_tie").orderBy("certification", "certificate_identifier", "src_ordinal", "src_tie")
)
