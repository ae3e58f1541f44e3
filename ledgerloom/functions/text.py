"""Text, key and URL expressions, without Python."""

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed

LIST_SEPARATOR = " | "


def col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


# Every Unicode blank, the smiley that stands for one, and what is dropped.
BLANKS = "\t\n\x0b\x0c\r\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000☻"
DROPPED = "".join(chr(c) for c in range(0x20) if c not in (0x09, 0x0A, 0x0D)).replace("\x0b", "").replace("\x0c", "") + "\x0b\x0c\ufeff"


def clean(value) -> Column:
    """Null to empty; control characters and BOM out; every Unicode blank run to one space.

    One character translation does the dropping and the blanks; patterns see plain spaces only. Printable
    ASCII without double spaces, which most values are, needs neither. The rest is behind a higher-order
    function, which also keeps these columns out of whole-stage methods: those grew past the size that the
    JVM compiles, and ran interpreted.
    """
    blanks = "".join(c for c in BLANKS if c not in DROPPED)
    raw = F.coalesce(col(value).cast("string"), F.lit(""))
    spaced = lambda x: F.trim(F.regexp_replace(F.translate(x, blanks + DROPPED, " " * len(blanks)), " {2,}", " "))
    plain = raw.rlike(r"^[ -~]*+\z") & ~F.contains(raw, F.lit("  "))
    return F.when(plain, F.trim(raw)).otherwise(bound(raw, spaced))


@functools.lru_cache(maxsize=None)
def _ascii_folds():
    """Derive BMP folding tables from Unicode data: casefold, NFKD, drop combining marks."""
    singles, removed, multi = {}, [], {}
    for code in range(0x80, 0x10000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        if char == "☻":
            continue
        folded = unicodedata.normalize("NFKD", char.casefold())
        folded = "".join(c for c in folded if not unicodedata.combining(c))
        # Folding case comes before decomposition, so capitals it brings out do not survive.
        kept = "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789&" else " " for c in folded)
        if folded == "":
            removed.append(char)
        elif kept.strip() == "":
            continue
        elif len(kept) == 1:
            singles[char] = kept
        else:
            multi[char] = kept
    return singles, removed, multi


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _expand_ligatures(text: Column) -> Column:
    """Characters that fold to several letters (sharp s, ligatures, fractions), letter by letter."""
    multi = _ascii_folds()[2]
    # One literal text instead of hundreds of map entries keeps the plan small; Spark folds it.
    table = F.str_to_map(F.lit("\x02".join(f"{k}\x03{v}" for k, v in sorted(multi.items()))), F.lit("\x02"), F.lit("\x03"))
    letters = F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(table, c), c))
    return F.when(F.translate(text, "".join(multi), "") == text, text).otherwise(F.array_join(letters, ""))


def fold(value) -> Column:
    """Case and accent folding by character translation; plain ASCII takes the short way."""
    singles, removed, _ = _ascii_folds()
    source, target = "".join(singles) + "".join(removed), "".join(singles.values())
    return bound(col(value), lambda x: F.when(x.rlike("^\\p{ASCII}*$"), F.lower(x)).otherwise(
        F.lower(F.translate(_expand_ligatures(x), source, target))))


def match_key(value, is_clean=False) -> Column:
    """Comparable form: folded letters and digits separated by single spaces.

    Printable ASCII has nothing to drop and folds by its case alone; plain words need no pattern either.
    """
    given = col(value) if is_clean else F.coalesce(col(value).cast("string"), F.lit(""))
    raw = given if is_clean else F.translate(given, DROPPED, "")
    spaced = lambda folded: F.trim(F.regexp_replace(F.replace(folded, F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))
    words = given.rlike(r"^[A-Za-z0-9 ]*+\z") & ~F.contains(given, F.lit("  "))
    return (F.when(words, F.trim(F.lower(given))).when(given.rlike(r"^[ -~]*+\z"), spaced(F.lower(given)))
            .otherwise(spaced(fold(raw))))


@functools.lru_cache(maxsize=None)
def suffix_tokens():
    tokens = set()
    for phrase in fixed.LEGAL_SUFFIXES:
        tokens.update("".join(c if c.isalnum() else " " for c in phrase).split())
    return tuple(sorted(tokens))


def drop_legal_tokens(key) -> Column:
    """Remove legal-form tokens from a match key, wherever they stand; repeats are kept."""
    words = "|".join(suffix_tokens())
    return F.ltrim(F.regexp_replace(col(key), f"(?:^| )(?:{words})(?= |$)", ""))


def strict_key(value) -> Column:
    return drop_legal_tokens(match_key(value))


def column_key(name: str) -> str:
    """Comparable form of a column header (driver side, headers only)."""
    text = unicodedata.normalize("NFKD", " ".join(str(name).split()).casefold())
    text = "".join(c for c in text if not unicodedata.combining(c)).replace("&", " and ")
    return "".join(c for c in text if c.isascii() and c.isalnum())


def record_key(*values, is_clean=False) -> Column:
    return F.sha2(F.concat_ws("|", *[col(v) if is_clean else clean(v) for v in values]), 256)


def is_short_name(strict) -> Column:
    """Names too short to be trusted: empty, at most 3 characters, or one token of at most 5."""
    key = col(strict)
    size = F.length(key)
    return (size <= 3) | ((size <= 5) & ~F.contains(key, F.lit(" ")))


def truncate(value, limit=2800) -> Column:
    text = clean(value)
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(" [...]"))).otherwise(text)


# --- URLs -------------------------------------------------------------------------------------


def domain_of(url) -> Column:
    """Host in lower case without scheme, leading www. and port; empty when there is none."""
    text = clean(url)
    rest = F.regexp_replace(text, "(?i)^https?://", "")
    host = F.lower(F.regexp_extract(rest, "^([^/?#]*)", 1))
    host = F.regexp_replace(host, "^www\\.", "")
    return F.substring_index(host, ":", 1)


def host_within(host, domains) -> Column:
    """True when the host is one of the domains or below one of them."""
    names = "|".join(d.replace(".", "\\.") for d in domains)
    return col(host).rlike(f"(^|\\.)({names})$")


def generic_domains():
    return sorted({d.removeprefix("www.") for d in fixed.GENERIC_REGISTRY_DOMAINS})


def is_matchable_domain(host) -> Column:
    # One pattern, so that a pushed-down filter holds the host expression once.
    names = "|".join(d.replace(".", "\\.") for d in generic_domains())
    return ~col(host).rlike(f"^$|(^|\\.)({names})$")


def distinct_domains(*urls) -> Column:
    hosts = F.array(*[domain_of(u) for u in urls])
    return F.array_distinct(F.filter(hosts, lambda h: h != ""))


def domain_suffixes(host) -> Column:
    """The host and each of its parent domains: a.b.c gives [a.b.c, b.c, c]."""
    parts = F.split(col(host), "\\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
    )


def canonical_url(url) -> Column:
    """Without query, fragment and trailing slashes; a bare root keeps its slash."""
    text = F.regexp_replace(clean(url), "[?#].*$", "")
    stripped = F.regexp_replace(text, "(?<!/)/+$", "")
    return F.regexp_replace(stripped, "^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)$", "$1/")


def site_root(url) -> Column:
    return F.concat(F.regexp_extract(clean(url), "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1), F.lit("/"))


# --- encoded lists ----------------------------------------------------------------------------


def encode_list(values) -> Column:
    return F.array_join(col(values), LIST_SEPARATOR)


def decode_list(text) -> Column:
    parts = F.transform(F.split(F.coalesce(col(text), F.lit("")), "\\|"), lambda t: F.trim(t))
    return F.filter(parts, lambda t: t != "")
