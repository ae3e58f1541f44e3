"""Compilers from rule data to column expressions."""

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import col


def any_of(tests) -> Column:
    return functools.reduce(lambda a, b: a | b, tests)


def literal(keyword) -> str:
    """A keyword as a pattern that matches just itself."""
    return "".join("\\" + c if c in "\\.[]{}()*+-?^$|&/" else c for c in keyword)


def contains_any(text, keywords) -> Column:
    """One pattern pass, naming the text once, so that pushed-down filters stay small."""
    return col(text).rlike("|".join(literal(k) for k in keywords))


def count_hits(text, keywords) -> Column:
    """How many different keywords the text contains."""
    value = col(text)
    return functools.reduce(
        lambda a, b: a + b, [F.contains(value, F.lit(k)).cast("int") for k in keywords]
    )


def first_match(text, rules, default) -> Column:
    """First rule whose keyword is contained in the text; '=x' asks for the whole text."""
    value = col(text)
    chain = None
    for keywords, result in rules:
        tests = [value == k[1:] if k.startswith("=") else F.contains(value, F.lit(k)) for k in keywords]
        if chain is None:
            chain = F.when(any_of(tests), result)
        else:
            chain = chain.when(any_of(tests), result)
    return chain.otherwise(default)


def lookup(value, mapping, default=None) -> Column:
    """Literal map lookup for small code tables."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, col(value)), F.lit(default))


def total(terms) -> Column:
    """Sum of (condition, points) pairs."""
    return functools.reduce(lambda a, b: a + b, [F.when(c, p).otherwise(0) for c, p in terms])


def reasons(terms) -> Column:
    """Texts of the conditions that hold, in order, as one encoded list."""
    texts = F.array_compact(F.array(*[F.when(c, F.lit(t)) for c, t in terms]))
    return F.array_join(texts, " | ")


def clamp(value, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))
