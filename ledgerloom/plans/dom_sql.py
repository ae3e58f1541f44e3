"""Checking SQL of page elements and of the verdict cascade. Written for the checking engine only."""

from ledgerloom.functions import page_values as v
from ledgerloom.plans import check_sql as c
from ledgerloom.plans.discovery_queries import _P as PAGE

_Q = lambda text: text.replace("'", "''")
_HIDDEN = "(?is)<(script|style|noscript)\\b[^>]*>.*?</(script|style|noscript)>|<!--.*?-->"
_ENTITIES = [("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")]


def _decoded(x):
    for entity, char in _ENTITIES:
        x = f"replace({x}, '{entity}', '{char}')"
    return x


def _attr(x, name):
    pattern = _Q(f"""(?is)[\\s"'/]{name}\\s*=\\s*(?:"([^"]*)"|'([^']*)'|([^\\s"'>]+))""")
    return _decoded("(" + " || ".join(f"regexp_extract({x}, '{pattern}', {i})" for i in (1, 2, 3)) + ")")


def _match(x, pattern):
    return f"regexp_matches({x}, '{_Q(pattern)}')"


_VOID = "('area','base','br','col','embed','hr','img','input','link','meta','param','source','track','wbr')"
_TYPE = f"lower({_attr('inside', 'type')})"
_ROLE = f"lower({_attr('inside', 'role')})"
_CLASS = f"regexp_split_to_array(lower({_attr('inside', 'class')}), '\\s+')"
_CLICK = f"((tag = 'a' AND trim({_attr('inside', 'href')}) <> '') OR tag IN ('button', 'input') OR {_ROLE} = 'button')"
_UNSEEN = f"""({_match('inside', '(?is)[\\s"\'/]hidden(\\s|=|/|$)')} OR {_match(_attr('inside', 'style'), v.HIDDEN_STYLE)} OR (tag = 'dialog' AND NOT {_match('inside', '(?is)[\\s"\'/]open(\\s|=|/|$)')}))"""

#: From CTE p (page_id, url, html): tokens, elements with their texts, and counts of tags.
ELEMENTS = f"""
    shown AS (SELECT page_id, '<>' || regexp_replace(regexp_replace(html, '(?is)<title[^>]*>.*?</title>', ' ', 'g'), '{_HIDDEN}', ' ', 'g') AS s FROM p),
    tok AS (SELECT page_id, unnest(regexp_extract_all(s, '<([^>]*)>([^<]*)', 1)) AS inside, unnest(regexp_extract_all(s, '<([^>]*)>([^<]*)', 2)) AS piece, generate_subscripts(regexp_extract_all(s, '<([^>]*)>([^<]*)', 1), 1) AS pos FROM shown),
    named AS (SELECT *, lower(regexp_extract(inside, '^(/?)\\s*([A-Za-z][A-Za-z0-9-]*)', 2)) AS tag, regexp_extract(inside, '^(/?)\\s*([A-Za-z][A-Za-z0-9-]*)', 1) = '/' AS closing FROM tok),
    el0 AS (SELECT *, tag IN {_VOID} OR ends_with(rtrim(inside), '/') AS void FROM named WHERE tag <> '' AND (tag NOT IN {_VOID} OR (tag = 'input' AND {_TYPE} IN ('button', 'submit')))),
    el1 AS (SELECT *, sum(CASE WHEN void THEN 0 WHEN closing THEN -1 ELSE 1 END) OVER (PARTITION BY page_id, tag ORDER BY pos) AS depth FROM el0),
    el2 AS (SELECT *, CASE WHEN void THEN NULL WHEN tag = 'p' THEN 1 WHEN closing THEN depth + 1 ELSE depth END AS level FROM el1),
    el3 AS (SELECT *, lead(pos) OVER (PARTITION BY page_id, tag, level ORDER BY pos) AS nxt FROM el2),
    el4 AS (SELECT *, CASE WHEN void THEN pos ELSE coalesce(nxt, 1 << 30) END AS fin FROM el3 WHERE NOT closing),
    body AS (SELECT e.page_id, e.pos, string_agg(t.piece, ' ' ORDER BY t.pos) AS own FROM el4 e JOIN tok t ON t.page_id = e.page_id AND t.pos >= e.pos AND t.pos < e.fin GROUP BY 1, 2),
    media AS (SELECT DISTINCT e.page_id, e.pos FROM el4 e JOIN tok t ON t.page_id = e.page_id AND t.pos > e.pos AND t.pos < e.fin AND regexp_matches(t.inside, '^(?i)(img|picture|svg|canvas)\\b')),
    el AS (SELECT e.page_id, e.pos, e.tag, {_ROLE} = 'button' AS role_button, coalesce(nullif({c.clean(_decoded('own'))}, ''), {c.clean(f"coalesce(nullif(CASE WHEN tag IN ('button', 'input') THEN {_attr('inside', 'value')} ELSE '' END, ''), {_attr('inside', 'aria-label')})")}) AS txt,
           {_CLICK} AND NOT {_UNSEEN} AS clickable, ({_CLICK} OR {_match('inside', v.PRODUCT_ATTRIBUTE)} OR list_has_any({_CLASS}, [{c.quoted(v.CARD_CLASSES)}])) AND NOT {_UNSEEN} AND m.pos IS NOT NULL AS card,
           (tag = 'dialog' OR {_ROLE} = 'dialog' OR lower({_attr('inside', 'aria-modal')}) = 'true' OR list_has_any({_CLASS}, [{c.quoted(v.DIALOG_CLASSES)}])) AND NOT {_UNSEEN} AS dialog
           FROM el4 e LEFT JOIN body b USING (page_id, pos) LEFT JOIN media m USING (page_id, pos))"""

_LISTS = {
    "heading_texts": ("tag IN ('h1', 'h2', 'h3')", 20), "button_texts": ("tag IN ('button', 'input')", 30), "link_texts": ("tag = 'a'", 30), "label_texts": ("tag = 'label'", 20),
    "ar_text_hints": (f"(tag IN ('a', 'button', 'span', 'div') OR role_button) AND {_match('txt', v.AR_PATTERN)}", 20),
    "rotate_text_hints": (f"(tag IN ('a', 'button', 'span', 'div') OR role_button) AND {_match('txt', v.ROTATE_PATTERN)}", 20),
}
_BLOCK = "tag IN ('h1', 'h2', 'h3', 'p', 'li', 'label', 'button', 'a', 'span', 'div') AND length(txt) >= 12"


def _count(tags, test="true"):
    return f"count(*) FILTER (WHERE tag IN ({c.quoted(tags)}) AND {test})"


_TAGS = {
    "form_count": _count(["form"]), "input_count": _count(["input"]), "checkbox_count": _count(["input"], f"{_TYPE} = 'checkbox'"), "radio_count": _count(["input"], f"{_TYPE} = 'radio'"),
    "range_count": _count(["input"], f"{_TYPE} = 'range'"), "number_input_count": _count(["input"], f"{_TYPE} = 'number'"), "select_count": _count(["select"]), "option_count": _count(["option"]),
    "button_count": _count(["button", "input"], f"(tag = 'button' OR {_TYPE} IN ('button', 'submit'))"), "text_input_count": _count(["textarea", "input"], f"(tag = 'textarea' OR {_TYPE} = 'text')"),
    "img_count": _count(["img"]), "svg_count": _count(["svg"]), "canvas_count": _count(["canvas"]), "iframe_count": _count(["iframe"]), "video_count": _count(["video"]), "model_viewer_count": _count(["model-viewer"]),
    "anchor_count": _count(["a"], f"trim({_attr('inside', 'href')}) <> ''"), "ar_rel_link_count": _count(["a"], f"contains(lower({_attr('inside', 'rel')}), 'ar')"),
    "image_extension_src_count": _count(["img"], f"regexp_matches(lower({_attr('inside', 'src')}), '\\.(jpg|jpeg|png|webp)')"),
    "usdz_link_count": _count(["a", "source", "model-viewer"], f"regexp_matches(lower(coalesce(nullif({_attr('inside', 'href')}, ''), {_attr('inside', 'src')})), '\\.usdz|scene-viewer|quick-look')"),
}
COUNTS, TEXTS = list(_TAGS), [*_LISTS, "cta_texts", "img_src_hints"]
_ROWS = ", ".join(f"coalesce(max(CASE WHEN kind = '{n}' THEN texts END), '') AS {n}" for n in TEXTS)


def _distinct(kind, source, text, where, limit):
    return f"""SELECT page_id, '{kind}' AS kind, string_agg(txt, ' | ' ORDER BY pos) AS texts FROM (
        SELECT page_id, pos, txt, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS place FROM (
            SELECT page_id, pos, {text} AS txt, row_number() OVER (PARTITION BY page_id, lower({text}) ORDER BY pos) AS again FROM {source} WHERE {where} AND {text} <> '') WHERE again = 1) WHERE place <= {limit} GROUP BY 1"""


#: One row for each page: all counts, and the lists as encoded texts.
SIGNALS = ELEMENTS + f""",
    counts AS (SELECT page_id, {', '.join(f'{x} AS {n}' for n, x in _TAGS.items())} FROM (SELECT * FROM named WHERE NOT closing) GROUP BY 1),
    lists AS ({' UNION ALL '.join(_distinct(n, 'el', 'txt', where, limit) for n, (where, limit) in _LISTS.items())}
        UNION ALL {_distinct('img_src_hints', 'named', f"trim({_attr('inside', 'src')})", "tag = 'img' AND NOT closing", 12)}
        UNION ALL SELECT page_id, 'cta_texts', string_agg(txt, ' | ' ORDER BY pos) FROM (SELECT page_id, pos, txt, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS place FROM el WHERE clickable AND txt <> '') WHERE place <= 30 GROUP BY 1),
    texts AS (SELECT page_id, {_ROWS} FROM lists GROUP BY 1),
    sums AS (SELECT page_id, least(count(DISTINCT lower(txt)) FILTER (WHERE {_BLOCK}), 40) AS text_block_count, count(*) FILTER (WHERE dialog) AS dialog_count, count(*) FILTER (WHERE clickable) AS clickable_count,
             count(*) FILTER (WHERE card AND length(txt) >= 3) AS product_card_count FROM el GROUP BY 1),
    metas AS (SELECT page_id, coalesce(arg_min(CASE WHEN lower({_attr('inside', 'name')}) = 'description' THEN trim({_attr('inside', 'content')}) END, CASE WHEN lower({_attr('inside', 'name')}) = 'description' THEN pos END), '') AS meta_description,
              coalesce(arg_min(CASE WHEN lower({_attr('inside', 'property')}) = 'og:description' THEN trim({_attr('inside', 'content')}) END, CASE WHEN lower({_attr('inside', 'property')}) = 'og:description' THEN pos END), '') AS meta_og_description
              FROM named WHERE tag = 'meta' GROUP BY 1),
    sig AS (SELECT p.page_id, p.url, {PAGE['title']} AS title, {PAGE['visible_text']} AS visible_text, {', '.join(f'coalesce({n}, 0)::int AS {n}' for n in [*COUNTS, 'text_block_count', 'dialog_count', 'clickable_count', 'product_card_count'])},
            {', '.join(f"coalesce({n}, '') AS {n}" for n in [*TEXTS, 'meta_description', 'meta_og_description'])}
            FROM p LEFT JOIN counts USING (page_id) LEFT JOIN texts USING (page_id) LEFT JOIN sums USING (page_id) LEFT JOIN metas USING (page_id))"""

_L = lambda *names: ", ' ', ".join(f"replace({n}, ' | ', ' ')" for n in names)
_list = lambda n: f"CASE WHEN {n} = '' THEN [] ELSE string_split({n}, ' | ') END"
_any, _hits = c.any_hit, c.hits
_IMG_STATIC = f"len(list_filter({_list('img_src_hints')}, lambda s: regexp_matches(lower(s), '\\.(jpg|jpeg|png|webp)')))"
_CHOICE = f"""len(list_distinct(list_filter(list_transform(list_concat({_list('link_texts')}, {_list('button_texts')}, {_list('heading_texts')}), lambda t: lower(t)), lambda t: t NOT IN ({c.quoted(v.IGNORED_CHOICES)})
    AND NOT {_any('t', v.IGNORED_CHOICE_PARTS)} AND length(t) <= 28 AND len(string_split(t, ' ')) <= 4 AND regexp_matches(t, '[a-zA-Z]'))))"""
_STEPS = f"len(list_filter(list_concat({_list('heading_texts')}, {_list('label_texts')}, {_list('button_texts')}), lambda t: regexp_matches(lower(t), '{_Q(v.STEP_PATTERN)}'))) >= 2"
_SCORE = c.total([("form_count >= 1", 1), ("input_count >= 6", 2), ("checkbox_count + radio_count >= 3", 2), ("range_count >= 1", 2), ("number_input_count >= 1", 1), ("select_count >= 1 OR option_count >= 6", 1), ("button_count >= 2", 1), ("svg_count >= 5", 1)])
_BLOCKED = " OR ".join(f"(contains(body, '{a}') AND {_any('body', b)})" for a, b in v.BLOCKED_PAIRS)

#: From SIGNALS: score, verdict, reason, confidence and source of every page.
VERDICTS = SIGNALS + f""",
    w AS (SELECT *, lower(url) AS u, lower(visible_text) AS body, lower(concat(title, ' ', url, ' ', visible_text)) AS pg, {_SCORE} AS score, {_CHOICE} AS choices, {_STEPS} AS steps, {_IMG_STATIC} AS static_images, {c.domain('url')} AS host,
          lower(concat(title, ' ', url, ' ', visible_text, ' ', {_L('heading_texts', 'button_texts', 'link_texts', 'label_texts')})) AS everything, lower(concat(title, ' ', url, ' ', visible_text, ' ', {_L('heading_texts', 'button_texts', 'link_texts')})) AS seen,
          lower(concat(title, ' ', visible_text, ' ', {_L('heading_texts', 'button_texts', 'link_texts')})) AS home, len({_list('link_texts')}) AS links, length(visible_text) AS size, range_count + number_input_count >= 1 AS sizable, 0 AS large_images FROM sig),
    k AS (SELECT *, {_hits('pg', v.SALE_PHRASES)} AS sales, {_any('pg', v.SALE_PROVIDERS)} AS provider, {_any('pg', v.ERROR_PHRASES)} AS err, {_BLOCKED} AS blocked, {_hits('pg', v.MARKETPLACE_WORDS)} AS market, {_hits('pg', v.EDITORIAL_WORDS)} AS editorial,
          {_any('u', v.CUSTOM_PATHS)} AS custom_path, {_any('seen', v.CUSTOM_COPY)} AS custom_copy, {_any('seen', v.ENTRY_COPY)} AS entry_copy, {_hits('everything', v.ACTION_WORDS)} AS actions, {_hits('everything', v.OPTION_WORDS)} AS options,
          {_any('u', v.CONFIG_PATHS)} AS config_path, {_any('seen', v.TEASER_WORDS)} AS teaser_copy, {_hits('home', v.NAV_WORDS)} AS nav, {_hits('home', v.HOME_COPY)} AS home_copy, {_any('u', v.HOME_EXEMPT_PATHS)} AS exempt,
          len(list_filter(string_split(regexp_extract(u, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '' AND NOT regexp_matches(s, '^[a-z]{{2}}(-[a-z]{{2}})?$'))) = 0 AS rootish,
          score >= 5 OR (checkbox_count + radio_count >= 4 AND sizable) OR (input_count >= 8 AND button_count >= 2) AS strong FROM w),
    e AS (SELECT *, (custom_path AND choices >= 3 AND img_count >= 3 AND (custom_copy OR entry_copy OR links >= 4)) OR (entry_copy AND choices >= 3 AND img_count >= 3 AND (custom_path OR custom_copy))
          OR (custom_path AND img_count >= 4 AND choices >= 4 AND button_count <= 3) AS entry FROM k),
    r AS (SELECT page_id, score, strong, CASE WHEN provider AND (sales > 0 OR contains(pg, 'domain')) THEN 'parked_domain' WHEN sales >= 2 THEN 'domain_sale' WHEN err THEN 'error_page' WHEN blocked THEN 'blocked_page'
          WHEN NOT strong AND NOT entry AND teaser_copy AND img_count <= 2 AND text_block_count <= 3 THEN 'image_only' WHEN {c.within('host', v.JOB_DOMAINS)} THEN 'job_platform'
          WHEN NOT strong AND market >= 2 THEN 'marketplace' WHEN NOT strong AND editorial >= 2 THEN 'editorial' WHEN entry THEN '+entry_page'
          WHEN NOT exempt AND NOT strong AND rootish AND ((nav >= 4 AND score <= 2 AND anchor_count >= 8 AND text_block_count <= 10 AND home_copy <= 2) OR (nav >= 5 AND button_count <= 6 AND score <= 1 AND home_copy <= 1)) THEN '?generic_home_page'
          WHEN config_path AND score >= 3 AND (actions >= 1 OR options >= 3 OR steps) THEN '+url_and_controls' WHEN actions >= 1 AND score >= 3 AND options >= 2 THEN '+explicit_customiser'
          WHEN steps AND score >= 4 AND options >= 3 THEN '+multi_step' WHEN checkbox_count + radio_count >= 4 AND sizable AND options >= 4 THEN '+options_and_dimensions' ELSE '?unresolved' END AS rule FROM e),
    verdicts AS (SELECT page_id, score AS control_score, CASE left(rule, 1) WHEN '+' THEN 'SI' WHEN '?' THEN '' ELSE 'NO' END AS active, ltrim(rule, '+?') AS reason, CASE left(rule, 1) WHEN '+' THEN 90 WHEN '?' THEN 0 ELSE 100 END AS confidence,
          CASE left(rule, 1) WHEN '+' THEN 'hard_positive' WHEN '?' THEN 'model' ELSE 'hard_rule' END AS source FROM r)"""

_TOOL = "regexp_matches(lower(url), 'custom|customi[sz]e|configurator|builder|unique|configure')"
#: From SIGNALS: scores of working tools and of pages that lead to one.
GATEWAYS = SIGNALS + f""",
    b AS (SELECT *, lower(concat({_L('heading_texts', 'button_texts', 'link_texts', 'label_texts', 'cta_texts')}, ' ', meta_description, ' ', meta_og_description, ' ', url)) AS blob,
          lower(concat({_L('heading_texts', 'button_texts', 'link_texts', 'cta_texts')}, ' ', meta_description, ' ', meta_og_description, ' ', url)) AS gate_blob, select_count + radio_count + checkbox_count + range_count + number_input_count AS prim FROM sig),
    g AS (SELECT *, {c.total([(_TOOL, 2), (_any('blob', v.EFFECTIVE_WORDS), 3), ('prim >= 2', 3), ('prim = 1', 1), ('prim + option_count + button_count >= 6', 2), ('canvas_count + model_viewer_count > 0', 1), (_any('blob', v.FINISH_WORDS), 2),
          ("product_card_count >= 6 AND prim = 0 AND NOT contains(blob, 'apply') AND NOT contains(blob, 'finish')", -3)])} AS effective_score,
          {c.total([(_any('gate_blob', v.GATEWAY_PRIMARY_WORDS), 4), (_any('gate_blob', v.GATEWAY_CHOICE_WORDS), 2), ('dialog_count > 0', 3), ('product_card_count >= 3', 2), ('clickable_count >= 6', 1), (_TOOL, 2), ('prim >= 2', -2)])} AS raw,
          {_any('gate_blob', v.GATEWAY_PENALTY_WORDS)} AS penalty FROM b)
    SELECT page_id, effective_score, (effective_score >= 5)::int AS is_effective, CASE WHEN penalty AND raw > 0 THEN raw - 1 ELSE raw END AS gateway_score,
           (effective_score < 5 AND CASE WHEN penalty AND raw > 0 THEN raw - 1 ELSE raw END >= 4)::int AS is_gateway FROM g"""
