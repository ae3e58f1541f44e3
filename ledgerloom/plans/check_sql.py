"""Fragments of checking SQL. Written for the checking engine only, apart from the Spark code."""

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions.text import generic_domains, suffix_tokens

BLANKS = "[\\s\\x{0b}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"


def quoted(values):
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def clean(x):
    base = f"regexp_replace(coalesce(cast({x} AS varchar), ''), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g')"
    return f"trim(regexp_replace(replace(replace({base}, chr(65279), ''), chr(9787), ' '), '{BLANKS}', ' ', 'g'))"


def key(x):
    folded = f"strip_accents(lower(replace(replace({clean(x)}, 'ß', 'ss'), '&', ' and ')))"
    return f"trim(regexp_replace({folded}, '[^a-z0-9]+', ' ', 'g'))"


def drop_legal(k):
    return (
        f"array_to_string(list_filter(string_split({k}, ' '), "
        f"lambda t: NOT list_contains([{quoted(suffix_tokens())}], t)), ' ')"
    )


def strict(x):
    return drop_legal(key(x))


def domain(x):
    rest = f"regexp_replace({clean(x)}, '^(?i)https?://', '')"
    host = f"lower(regexp_extract({rest}, '^([^/?#]*)', 1))"
    return f"split_part(regexp_replace({host}, '^www\\.', ''), ':', 1)"


def within(host, domains):
    return "(" + " OR ".join(f"{host} = '{d}' OR ends_with({host}, '.{d}')" for d in domains) + ")"


def matchable(host):
    return f"({host} <> '' AND NOT {within(host, generic_domains())})"


def hits(text, keywords):
    return "(" + " + ".join(f"cast(contains({text}, {quoted([k])}) AS int)" for k in keywords) + ")"


def any_hit(text, keywords):
    return "(" + " OR ".join(f"contains({text}, {quoted([k])})" for k in keywords) + ")"


def first_match(text, rules, default, pick=lambda r: r):
    arms = []
    for keywords, result in rules:
        tests = [
            f"{text} = {quoted([k[1:]])}" if k.startswith("=") else f"contains({text}, {quoted([k])})"
            for k in keywords
        ]
        arms.append(f"WHEN {' OR '.join(tests)} THEN {quoted([pick(result)])}")
    return f"CASE {' '.join(arms)} ELSE {quoted([default])} END"


def short_name(k):
    return f"(length({k}) <= 3 OR (length({k}) <= 5 AND NOT contains({k}, ' ')))"


def total(terms):
    return "(" + " + ".join(f"CASE WHEN {c} THEN {p} ELSE 0 END" for c, p in terms) + ")"


def reasons(terms):
    parts = ", ".join(f"CASE WHEN {c} THEN '{t}' END" for c, t in terms)
    return f"array_to_string(list_filter([{parts}], lambda r: r IS NOT NULL), ' | ')"


def first_n(x, n=None, where="true"):
    """Sorted distinct values as one encoded list, cut at n."""
    values = f"list_sort(list(DISTINCT {x}) FILTER (WHERE {where}))"
    if n:
        values = f"list_slice({values}, 1, {n})"
    return f"coalesce(array_to_string({values}, ' | '), '')"
