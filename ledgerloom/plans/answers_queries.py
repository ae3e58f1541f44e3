"""Model answers: every question over answers made of events, and verdicts completed by them."""

from pyspark.sql import functions as F

from ledgerloom.functions import page_values as v
from ledgerloom.operators import answers, pages
from ledgerloom.plans import check_sql as c
from ledgerloom.plans import dom_sql
from ledgerloom.plans.catalog import query
from ledgerloom.plans.pages_queries import _PAGES, signals

# Answers as models write them: fenced, wrapped, cut off, with stray backslashes, as lines, as prose, not at all.
_ACTIVE = """CASE event_id % 15 WHEN 0 THEN concat('```json{"active": "Yes", "confidence": 0.9, "reason": "', event_type, '"}```') WHEN 1 THEN concat('Sure: {"attivo": "NO", "confidence": "85%", "motivo": "  seen ', event_type, '"} done')
    WHEN 2 THEN concat('{"active": "si", "confidence": 70, "reason": "', event_type, '"') WHEN 3 THEN concat('active: NO, confidence: 55, reason: ', event_type) WHEN 4 THEN 'The page is active: yes it is' WHEN 5 THEN concat('is the tool active or not: TRUE\n', event_type)
    WHEN 6 THEN concat('I would say YES, ', event_type) WHEN 7 THEN '???' WHEN 8 THEN concat('{"active": "FALSE", "reason": "a', chr(92), 'd ', event_type, '"}') WHEN 9 THEN '{"active": 1, "confidence": 1, "reason": ""}' WHEN 10 THEN '{"active": "INACTIVE", "confidence": 12.5}'
    WHEN 11 THEN '{"active": true, "confidence": 150, "motivo": null, "reason": "r"}' WHEN 12 THEN concat('{"a": "x"} and "ACTIVE" {', event_type, '} "YES"') WHEN 13 THEN '{"active": "perhaps", "confidence": -3}' ELSE NULL END"""
_TYPE = """CASE event_id % 11 WHEN 0 THEN '{"visualization_type": "interactive 3d", "confidence": 0.5}' WHEN 1 THEN '{"tipo": "immagini", "motivo": "solo"}' WHEN 2 THEN concat('visualization_type: 2D, ', event_type) WHEN 3 THEN 'One can drag to rotate the model'
    WHEN 4 THEN concat('The gallery image of ', event_type) WHEN 5 THEN 'AR' WHEN 6 THEN '{"type": "AR"}' WHEN 7 THEN 'a 3D thing' WHEN 8 THEN concat('{"type": "', event_type, '", "reason": "webgl"}') WHEN 9 THEN 'STATIC' ELSE '' END"""
_SCORE = """CASE event_id % 12 WHEN 0 THEN '{"mobile_score": 4.6, "confidence": 80}' WHEN 1 THEN '{"mobile_score": "4.6", "reason": "r"}' WHEN 2 THEN '{"score": "2/5"' WHEN 3 THEN concat('rating: 3, summary: ', event_type) WHEN 4 THEN '{"rating": 9}' WHEN 5 THEN '{"mobile_score": null, "score": 1, "summary": "s"}'
    WHEN 6 THEN 'mobile_score: "12", rating: 5' WHEN 7 THEN event_type WHEN 8 THEN '```{"mobile_rating": "five 5"}```' WHEN 9 THEN '{"score": 2.5}' WHEN 10 THEN concat('{"mobile_score": "x", "reason": "', event_type, ' mobile_score: 3"}') ELSE 'score: 4' END"""
_MATCH = """CASE event_id % 7 WHEN 0 THEN '{"match_prodotto": "SI", "attivo": "NO", "confidence": 0.25}' WHEN 1 THEN '{"product_match": "y", "active": "n", "reason": "r"}' WHEN 2 THEN concat('match: yes, active: no, reason: ', event_type) WHEN 3 THEN '{"match": "yes"}'
    WHEN 4 THEN 'product_match: "TRUE", active: "FALSE"' WHEN 5 THEN '{"match": "unsure", "active": "YES"} match: NO' ELSE event_type END"""


def _q(text):
    return text.replace("'", "''")


def _read(raw):
    plain = f"trim(regexp_replace(regexp_replace(regexp_replace(trim(coalesce(raw_output, '')), '^(?i)```json\\s*', ''), '^```\\s*', ''), '\\s*```$', ''))"
    return f"""WITH e AS (SELECT event_id, event_type, {raw} AS raw_output FROM @events), pl AS (SELECT *, {plain} AS plain FROM e),
    pt AS (SELECT *, regexp_extract(plain, '(?s)(\\{{.*\\}})', 1) AS outr, regexp_extract(plain, '(?s)(\\{{.*)$', 1) AS part FROM pl),
    cd AS (SELECT *, [plain, outr, part || repeat('}}', greatest(0, (length(part) - length(replace(part, '{{', ''))) - (length(part) - length(replace(part, '}}', '')))))] AS tries FROM pt),
    ca AS (SELECT *, list_filter(list_concat(tries, list_transform(tries, lambda t: regexp_replace(t, '\\\\([^"\\\\/bfnrtu]|$)', '\\\\\\\\\\1', 'g'))), lambda t: CASE WHEN json_valid(t) THEN json_type(t) = 'OBJECT' ELSE false END)[1] AS js FROM cd),
    x AS (SELECT *, upper(plain) AS up, lower({c.clean('plain')}) AS low FROM ca)"""


def _field(name):
    return f"coalesce(js->>'$.{name}', '')"


def _first(values):
    return "coalesce(" + ", ".join(f"nullif({x}, '')" for x in values) + ", '')"


def _pattern(name):
    quoted = f"""trim(replace(replace(replace(replace(regexp_extract(plain, '(?is)"?{name}"?\\s*:\\s*"((?:[^"\\\\]|\\\\.)*)"', 1), '\\"', '"'), '\\n', chr(10)), '\\t', chr(9)), '\\\\', '\\'))"""
    return _first([quoted, f"""trim(trim(trim(regexp_extract(plain, '(?i)"?{name}"?\\s*:\\s*([^\\n,}}]+)', 1)), '"'))"""])


def _yes_no(x):
    return f"CASE WHEN upper({c.clean(x)}) IN ({c.quoted(v.YES_WORDS)}) THEN 'SI' WHEN upper({c.clean(x)}) IN ({c.quoted(v.NO_WORDS)}) THEN 'NO' ELSE '' END"


def _confidence(x):
    number = f"CASE WHEN regexp_full_match(trim({x}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN try_cast(trim({x}) AS double) END"
    return f"greatest(0, least(100, round_even(CASE WHEN {number} BETWEEN 0 AND 1 THEN {number} * 100 ELSE {number} END, 0)))::int"


def _score(x, numeric=None):
    # the checking engine has no look-around: a digit of 1 to 5 between ends or other characters
    stated = f"regexp_extract({c.clean(x)}, '(?:^|[^0-9])([1-5])(?:[^0-9]|$)', 1)"
    return stated if numeric is None else f"CASE WHEN {numeric} THEN CASE WHEN round_even(try_cast({x} AS double), 0) BETWEEN 1 AND 5 THEN round_even(try_cast({x} AS double), 0)::int::varchar ELSE '' END ELSE {stated} END"


def _kind(x):
    up = f"upper({c.clean(x)})"
    return f"CASE WHEN {up} = 'AR' OR {c.any_hit(up, v.AR_TYPE_WORDS)} OR {c.any_hit(up, v.TYPE_3D_WORDS)} THEN 'Interactive 3D' WHEN {c.any_hit(up, v.TYPE_2D_WORDS)} THEN 'Static 2D' ELSE '' END"


_ACTIVE_PATTERN = _first([_yes_no(f"regexp_extract(plain, '{_q(p)}', 1)") for p in v.ACTIVE_PATTERNS] + [
    f"CASE WHEN {c.any_hit('up', ['ATTIVO', 'ACTIVE'])} THEN CASE WHEN {c.any_hit('up', v.LOOSE_YES)} THEN 'SI' WHEN {c.any_hit('up', v.LOOSE_NO)} THEN 'NO' ELSE '' END ELSE '' END"])
_KINDS = [_kind(f"""regexp_extract(plain, '(?i)"?{n}"?\\s*:\\s*{x}', 1)""") for n in v.TYPE_PATTERN_FIELDS for x in ('"([^"]+)"', "([^\\n,}]+)")]
_TYPE_PATTERN = _first([*_KINDS, f"CASE WHEN {c.any_hit('low', v.FREE_AR_WORDS + v.FREE_3D_WORDS)} THEN 'Interactive 3D' WHEN {c.any_hit('low', v.FREE_2D_WORDS)} THEN 'Static 2D' ELSE '' END",
    """CASE WHEN contains(up, 'INTERACTIVE 3D') OR (NOT contains(up, '"AR"') AND (contains(up, ' 3D') OR contains(up, '360'))) THEN 'Interactive 3D' WHEN contains(up, '"AR"') OR regexp_matches(up, '\\bAR\\b') THEN ''
       WHEN contains(up, 'STATIC 2D') OR contains(up, ' 2D') OR contains(up, 'STATIC') THEN 'Static 2D' ELSE '' END"""])
_WEAK = """CASE WHEN (contains(ru, 'SI') OR contains(ru, 'YES')) AND NOT contains(ru, 'NO') THEN 'SI' WHEN contains(ru, 'NO') AND NOT contains(ru, 'SI') AND NOT contains(ru, 'YES') THEN 'NO' ELSE '' END"""


def _told(raw, name, by_json, by_pattern, reasons, guess="''"):
    reason, told = _first([c.clean(_field(r)) for r in reasons]), _first([_pattern(r) for r in reasons])
    return _read(raw) + f""",
    a AS (SELECT *, upper(coalesce(raw_output, '')) AS ru, js IS NOT NULL AS obj, {by_json} AS bj, {by_pattern} AS bp, {_first([reason, told])} AS rs, {told} AS tl FROM x),
    b AS (SELECT *, bj <> '' AND obj OR bp <> '' AS rd, {_first(["CASE WHEN obj THEN bj END", "bp", guess])} AS ans FROM a)
    SELECT event_id, ans AS {name}, coalesce(CASE WHEN obj AND rd THEN {_confidence(_field('confidence'))} WHEN ans <> '' THEN {_confidence(_pattern('confidence'))} END, -1) AS confidence,
           CASE WHEN obj AND rd THEN {_first(['rs', f"'{answers.NO_REASON}'"])} WHEN rd THEN {_first(['tl', f"'{answers.SOME_REASON}'"])} WHEN ans <> '' THEN {_first(['tl', f"'{answers.GUESSED}'"])} ELSE '' END AS reason,
           CASE WHEN obj AND rd THEN '' WHEN rd THEN 'recovered' WHEN ans <> '' THEN 'weak' ELSE 'error' END AS warning FROM b"""


def _given(t, raw):
    return t.events.select("event_id", F.expr(raw).alias("raw_output"))


def _shown(found):
    return found.drop("raw_output").withColumn("confidence", F.coalesce("confidence", F.lit(-1)))


_A = v.ANSWER_FIELDS
_ACTIVE_SQL = _told(_ACTIVE, "active", _first([_yes_no(_field(f)) for f in _A["active"]]), _ACTIVE_PATTERN, _A["reason"], _WEAK)
query("t24_active_answers", _ACTIVE_SQL)(lambda t: _shown(answers.active_answers(_given(t, _ACTIVE))))
query("t24_type_answers", _told(_TYPE, "visualization_type", _first([_kind(_field(f)) for f in _A["type"]]), _TYPE_PATTERN, _A["reason"]))(lambda t: _shown(answers.type_answers(_given(t, _TYPE))))
_NUMERIC = lambda f: f"""coalesce(regexp_matches(js, '"{f}"\\s*:\\s*-?[0-9]'), false)"""
query("t24_score_answers", _told(_SCORE, "score", _first([_score(_field(f), _NUMERIC(f)) for f in _A["mobile"]]), _first([_score(_pattern(f)) for f in _A["mobile"]]), _A["score_reason"]))(
    lambda t: _shown(answers.score_answers(_given(t, _SCORE))))
_YN = lambda f: _yes_no(_first([f"""regexp_extract(plain, '(?i)"?{f}"?\\s*:\\s*"(SI|NO|YES|TRUE|FALSE)"', 1)""", f"""regexp_extract(plain, '(?i)"?{f}"?\\s*:\\s*(SI|NO|YES|TRUE|FALSE)', 1)"""]))
_MATCHED = _first([*[_yes_no(_field(f)) for f in _A["match"]], *[_YN(f) for f in _A["match"]]])
_BOTH = f"CASE WHEN {_MATCHED} <> '' AND {_first([*[_yes_no(_field(f)) for f in _A['active']], _ACTIVE_PATTERN])} <> '' THEN {_MATCHED} || '|' || {_first([*[_yes_no(_field(f)) for f in _A['active']], _ACTIVE_PATTERN])} ELSE '' END"
query("t24_match_answers", f"SELECT event_id, split_part(both_, '|', 1) AS product_match, split_part(both_, '|', 2) AS active, confidence, reason, warning FROM ({_told(_MATCH, 'both_', _BOTH, _BOTH, _A['reason'])})")(
    lambda t: _shown(answers.match_answers(_given(t, _MATCH))))
_URLS = """CASE page_id % 4 WHEN 0 THEN concat('{"selected_urls": ["', url, '", " https://b.example.org/x ", "https://none.example.org"]}') WHEN 1 THEN concat('I take https://b.example.org/x and then ', url) WHEN 2 THEN '{"selected_urls": "none"}' ELSE NULL END"""
query("t24_selected_urls", """SELECT page_id, CASE page_id % 4 WHEN 0 THEN url || ' | https://b.example.org/x' WHEN 1 THEN url || ' | https://b.example.org/x' ELSE '' END AS selected_urls FROM @pages""")(
    lambda t: answers.selected_urls(t.pages.select("page_id", F.expr(_URLS).alias("raw_output"), F.array("url", F.lit("https://a.example.org"), F.lit("https://b.example.org/x")).alias("available_urls")))
    .select("page_id", F.array_join("selected_urls", " | ").alias("selected_urls")))

# the answer of event n is the answer about page n
query("t20_resolved_verdicts", f"""{_PAGES} {dom_sql.VERDICTS}, told AS ({_ACTIVE_SQL})
    SELECT page_id, control_score, CASE WHEN d.active <> '' THEN d.active WHEN t.active <> '' THEN t.active ELSE 'NO' END AS active, CASE WHEN d.active <> '' THEN d.reason WHEN t.active <> '' THEN t.reason ELSE 'no readable answer' END AS reason,
           CASE WHEN d.active <> '' THEN d.confidence WHEN t.active <> '' THEN t.confidence ELSE 0 END AS confidence, CASE WHEN d.active <> '' THEN d.source WHEN t.active <> '' THEN 'model' ELSE 'unread' END AS source,
           CASE WHEN d.active <> '' THEN '' WHEN t.active <> '' THEN t.warning ELSE 'error' END AS warning FROM verdicts d LEFT JOIN told t ON t.event_id = d.page_id""")(
    lambda t: answers.resolved_verdicts(
        pages.page_verdict(signals(t)).select("page_id", "control_score", "active", "reason", "confidence", "source"),
        answers.active_answers(_given(t, _ACTIVE).withColumnRenamed("event_id", "page_id"))).withColumn("confidence", F.coalesce("confidence", F.lit(-1))))
