"""Typed answers from what a language model wrote: JSON where it can be repaired, else fields by pattern, else key words.

Every question has its own field names (``page_values.ANSWER_FIELDS``). An answer that cannot be read stays empty and
is marked, so that rules can step in (``resolved_verdicts``).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import page_values as v
from ledgerloom.functions import rules
from ledgerloom.functions.text import bound, clean

RECOVERED, PARTIAL, WEAK = "", "recovered", "weak"
NO_REASON, SOME_REASON, GUESSED = "Reason not provided by the model", "Reason partially recovered", "Classification inferred from model text"


def _without_fences(raw) -> Column:
    opened = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(raw, F.lit(""))), "(?i)^```json\\s*", ""), "^```\\s*", "")
    return F.trim(F.regexp_replace(opened, "\\s*```$", ""))


def _candidates(plain) -> Column:
    """Texts to try as JSON, best first: whole, between the outermost braces, from the first brace with the missing
    ones added; then the same with stray backslashes doubled."""
    outer, partial = F.regexp_extract(plain, "(?s)(\\{.*\\})", 1), F.regexp_extract(plain, "(?s)(\\{.*)$", 1)
    missing = F.regexp_count(partial, F.lit("\\{")) - F.regexp_count(partial, F.lit("\\}"))
    tries = F.array(plain, outer, F.concat(partial, F.repeat(F.lit("}"), F.greatest(missing, F.lit(0)))))
    fixed = F.transform(tries, lambda t: F.regexp_replace(t, "\\\\(?![\"\\\\/bfnrtu])", "\\\\\\\\"))
    return F.filter(F.concat(tries, fixed), lambda t: F.ltrim(t).startswith("{"))


def _parsed(plain) -> Column:
    """(json, fields) of the first text that is one JSON object and nothing else; null if none is."""
    read = lambda t: F.from_json(F.concat(F.lit("["), t, F.lit("]")), "array<map<string,string>>", {"allowSingleQuotes": "false", "mode": "PERMISSIVE"})
    whole = lambda t: F.when(F.get_json_object(F.concat(F.lit("["), t, F.lit("]")), "$").isNotNull(), read(t))
    tried = F.transform(_candidates(plain), lambda t: F.struct(t.alias("json"), whole(t).alias("objects")))
    return F.get(F.filter(tried, lambda x: F.size(x["objects"]) == 1), F.lit(0))


def _field(name) -> Column:
    return F.coalesce(F.try_element_at(F.col("_fields"), F.lit(name)), F.lit(""))


def _first(values) -> Column:
    """First value that is not empty."""
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in values], F.lit(""))


def _by_pattern(name) -> Column:
    """A field in text that is no JSON: quoted with escapes, else up to the end of the line, a comma or a brace."""
    quoted = F.regexp_extract("_plain", f'(?is)"?{name}"?\\s*:\\s*"((?:[^"\\\\]|\\\\.)*+)"', 1)
    for escape, char in (('\\"', '"'), ("\\n", "\n"), ("\\t", "\t"), ("\\\\", "\\")):
        quoted = F.replace(quoted, F.lit(escape), F.lit(char))
    bare = F.trim(F.btrim(F.trim(F.regexp_extract("_plain", f'(?i)"?{name}"?\\s*:\\s*([^\\n,}}]+)', 1)), F.lit('"')))
    return _first([F.trim(quoted), bare])


def yes_no(value) -> Column:
    return bound(F.upper(clean(value)), lambda w: F.when(w.isin(v.YES_WORDS), "SI").when(w.isin(v.NO_WORDS), "NO").otherwise(""))


def confidence(value) -> Column:
    """0 to 100, shares up to 1 scaled; null if it is no plain number, such as ``85%``."""
    number = lambda x: F.when(x.rlike("^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$"), x).try_cast("double")
    scaled = lambda n: F.greatest(F.lit(0), F.least(F.lit(100), F.bround(F.when(n.between(0, 1), n * 100).otherwise(n), 0))).cast("int")
    return bound(F.trim(value), lambda x: bound(number(x), scaled))


def score(value, is_number=None) -> Column:
    """1 to 5: the first such digit that stands alone; a JSON number is rounded."""
    stated = F.regexp_extract(clean(value), "(?<![0-9])([1-5])(?![0-9])", 1)
    if is_number is None:
        return stated
    rounded = F.bround(F.trim(value).try_cast("double"), 0).cast("int")
    return F.when(is_number, F.when(rounded.between(1, 5), rounded.cast("string")).otherwise("")).otherwise(stated)


def visualisation_type(value) -> Column:
    return bound(F.upper(clean(value)), lambda t: F.when((t == "AR") | rules.contains_any(t, v.AR_TYPE_WORDS + v.TYPE_3D_WORDS), "Interactive 3D").when(rules.contains_any(t, v.TYPE_2D_WORDS), "Static 2D").otherwise(""))


def _active_by_pattern() -> Column:
    word = lambda pattern: yes_no(F.regexp_extract("_plain", pattern, 1))
    found = [word(p) for p in v.ACTIVE_PATTERNS]
    loose = bound(F.upper("_plain"), lambda u: F.when(rules.contains_any(u, ["ATTIVO", "ACTIVE"]), F.when(rules.contains_any(u, v.LOOSE_YES), "SI").when(rules.contains_any(u, v.LOOSE_NO), "NO").otherwise("")).otherwise(""))
    return _first([*found, loose])


def _type_by_pattern() -> Column:
    named = [visualisation_type(F.regexp_extract("_plain", f"(?i)\"?{name}\"?\\s*:\\s*{value}", 1)) for name in v.TYPE_PATTERN_FIELDS for value in ('"([^"]+)"', "([^\\n,}]+)")]
    lower, upper = F.lower(clean("_plain")), F.upper("_plain")
    free = F.when(rules.contains_any(lower, v.FREE_AR_WORDS) | rules.contains_any(lower, v.FREE_3D_WORDS), "Interactive 3D").when(rules.contains_any(lower, v.FREE_2D_WORDS), "Static 2D").otherwise("")
    ar = F.contains(upper, F.lit('"AR"'))
    last = (F.when(F.contains(upper, F.lit("INTERACTIVE 3D")) | (~ar & rules.contains_any(upper, [" 3D", "360"])), "Interactive 3D")
            .when(ar | upper.rlike("\\bAR\\b"), "").when(rules.contains_any(upper, ["STATIC 2D", " 2D", "STATIC"]), "Static 2D").otherwise(""))
    return _first([*named, free, last])


def _with(rows, **columns) -> DataFrame:
    """Columns computed once, behind a generator: the optimiser would copy them into every use."""
    return rows.select("*", F.inline(F.array(F.struct(*[x.alias(n) for n, x in columns.items()]))))


def _opened(answers, raw):
    rows = _with(_with(answers, _plain=_without_fences(F.col(raw))), _json=_parsed(F.col("_plain")))
    return _with(rows, _fields=F.get(F.col("_json.objects"), F.lit(0)))


def _told(answers, opened, name, by_json, by_pattern, reasons, guess=None) -> DataFrame:
    """Answer, confidence, reason and warning from what JSON, patterns and the guess say. An object that does not
    answer is asked by pattern first; its confidence then counts, if it has been read."""
    rows = _with(opened, _by_json=by_json, _by_pattern=by_pattern, _by_guess=guess if guess is not None else F.lit(""))
    rows = _with(rows, _told=_first([_by_pattern(r) for r in reasons]), _stated=_first([clean(_field(r)) for r in reasons]), _sure=_by_pattern("confidence"),
                 _object=F.col("_fields").isNotNull(), _answer=_first([F.when(F.col("_fields").isNotNull(), F.col("_by_json")), F.col("_by_pattern"), F.col("_by_guess")]))
    answer, has_object, read = F.col("_answer"), F.col("_object"), (F.col("_object") & (F.col("_by_json") != "")) | (F.col("_by_pattern") != "")
    return rows.select(
        *answers.columns, answer.alias(name),
        F.when(has_object & read, confidence(_field("confidence"))).when(answer != "", confidence(F.col("_sure"))).alias("confidence"),
        F.when(has_object & read, _first([F.col("_stated"), F.col("_told"), F.lit(NO_REASON)])).when(read, _first([F.col("_told"), F.lit(SOME_REASON)])).when(answer != "", _first([F.col("_told"), F.lit(GUESSED)])).otherwise("").alias("reason"),
        F.when(has_object & read, RECOVERED).when(read, PARTIAL).when(answer != "", WEAK).otherwise("error").alias("warning"))


def active_answers(answers: DataFrame, raw="raw_output") -> DataFrame:
    """Whether a page is an active tool: ``active`` SI, NO or empty, with confidence, reason and warning."""
    upper = F.upper(F.coalesce(F.col(raw), F.lit("")))
    has = lambda word: F.contains(upper, F.lit(word))
    guess = F.when((has("SI") | has("YES")) & ~has("NO"), "SI").when(has("NO") & ~has("SI") & ~has("YES"), "NO").otherwise("")
    return _told(answers, _opened(answers, raw), "active", _first([yes_no(_field(f)) for f in v.ANSWER_FIELDS["active"]]), _active_by_pattern(), v.ANSWER_FIELDS["reason"], guess)


def type_answers(answers: DataFrame, raw="raw_output") -> DataFrame:
    """How a page shows its product: ``visualization_type`` Static 2D, Interactive 3D or empty."""
    return _told(answers, _opened(answers, raw), "visualization_type", _first([visualisation_type(_field(f)) for f in v.ANSWER_FIELDS["type"]]), _type_by_pattern(), v.ANSWER_FIELDS["reason"])


def score_answers(answers: DataFrame, question="mobile", raw="raw_output") -> DataFrame:
    """A score of 1 to 5 as text, empty if there is none; ``question`` is mobile or compatibility."""
    fields = v.ANSWER_FIELDS[question]
    plain_number = lambda f: F.coalesce(F.col("_json.json").rlike(f'"{f}"\\s*:\\s*-?[0-9]'), F.lit(False))
    return _told(answers, _opened(answers, raw), "score", _first([score(_field(f), plain_number(f)) for f in fields]), _first([score(_by_pattern(f)) for f in fields]), v.ANSWER_FIELDS["score_reason"])


def match_answers(answers: DataFrame, raw="raw_output") -> DataFrame:
    """Whether a candidate page shows the product and is active; both empty unless both can be read."""
    opened = _opened(answers, raw)
    fields = v.ANSWER_FIELDS["match"]
    pattern = lambda f: yes_no(_first([F.regexp_extract("_plain", f'(?i)"?{f}"?\\s*:\\s*"(SI|NO|YES|TRUE|FALSE)"', 1), F.regexp_extract("_plain", f'(?i)"?{f}"?\\s*:\\s*(SI|NO|YES|TRUE|FALSE)', 1)]))
    match = _first([*[yes_no(_field(f)) for f in fields], *[pattern(f) for f in fields]])
    active = _first([*[yes_no(_field(f)) for f in v.ANSWER_FIELDS["active"]], _active_by_pattern()])
    both = _with(opened, _match=match, _active=active)
    told = F.when((F.col("_match") != "") & (F.col("_active") != ""), F.concat("_match", F.lit("|"), "_active")).otherwise("")
    rows = _told(answers, both, "_both", F.when(F.col("_fields").isNotNull(), told).otherwise(""), told, v.ANSWER_FIELDS["reason"])
    return rows.select(*answers.columns, F.split_part("_both", F.lit("|"), F.lit(1)).alias("product_match"), F.split_part("_both", F.lit("|"), F.lit(2)).alias("active"), "confidence", "reason", "warning")


def selected_urls(answers: DataFrame, raw="raw_output", available="available_urls", most=12) -> DataFrame:
    """``selected_urls``: the offered addresses that the answer lists, in its order; else those it names, in the order offered."""
    opened = _opened(answers, raw)
    listed = F.transform(F.coalesce(F.from_json(_field("selected_urls"), "array<string>"), F.array().cast("array<string>")), clean)
    chosen = F.array_distinct(F.filter(listed, lambda u: (u != "") & F.array_contains(available, u)))
    named = F.array_distinct(F.filter(available, lambda u: F.contains(F.coalesce(F.col(raw), F.lit("")), u)))
    return opened.withColumn("_chosen", chosen).select(*answers.columns, F.slice(F.when(F.size("_chosen") > 0, F.col("_chosen")).otherwise(named), 1, most).alias("selected_urls"))


def resolved_verdicts(verdicts: DataFrame, answers: DataFrame, page="page_id") -> DataFrame:
    """Rule verdicts, completed by the model's answers where no rule decides; no page stays open.

    ``answers`` has one row of ``active_answers`` for a page. A page without a readable answer falls back to NO, with
    confidence 0 and source ``unread``: the rules have already been asked and have nothing to say.
    """
    told = answers.select(page, F.col("active").alias("_active"), F.col("confidence").alias("_confidence"), F.col("reason").alias("_reason"), F.col("warning").alias("_warning"))
    rows = verdicts.join(told, page, "left")
    open_, read = F.col("active") == "", F.coalesce(F.col("_active") != "", F.lit(False))
    pick = lambda rule, model, neither: F.when(~open_, rule).when(read, model).otherwise(neither)
    return rows.select(
        *[c for c in verdicts.columns if c not in ("active", "reason", "confidence", "source")],
        pick(F.col("active"), F.col("_active"), F.lit("NO")).alias("active"), pick(F.col("reason"), F.col("_reason"), F.lit("no readable answer")).alias("reason"),
        pick(F.col("confidence"), F.col("_confidence"), F.lit(0)).alias("confidence"), pick(F.col("source"), F.lit("model"), F.lit("unread")).alias("source"),
        pick(F.lit(""), F.col("_warning"), F.lit("error")).alias("warning"))
