"""Record keys of the single registries, and deduplication by a given key or else a recomputed one."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_values as fixed
from ledgerloom.functions import text
from ledgerloom.functions.text import clean
from ledgerloom.operators.ordered import keep_first


def key_of(registry: str) -> Column:
    """SHA-256 of the registry's key columns, cleaned (normalised where their name says so) and joined by bars."""
    _, columns = fixed.REGISTRY_KEYS[registry]
    values = [text.match_key(c.removeprefix("normalised ")) if c.startswith("normalised ") else clean(c) for c in columns]
    return text.record_key(*values, is_clean=True)


def with_key(rows: DataFrame, registry: str) -> DataFrame:
    """``rows`` with the registry's key column, computed anew."""
    return rows.withColumn(fixed.REGISTRY_KEYS[registry][0], key_of(registry))


def deduplicated(rows: DataFrame, registry: str, order, given=True) -> DataFrame:
    """The first row of every key in source order. A given key counts as it is, once cleaned; a missing one is
    recomputed, from the key columns or, where the registry has it so, from all columns of the row.

    One aggregation: given and recomputed keys are one key column. With ``given`` off all keys are computed anew.
    """
    name, _ = fixed.REGISTRY_KEYS[registry]
    order = [order] if isinstance(order, str) else list(order)
    own = clean(F.col(name)) if given and name in rows.columns else F.lit("")
    whole = text.record_key(*[c for c in rows.columns if c not in order])
    anew = whole if registry in fixed.WHOLE_ROW_KEYS and given else key_of(registry)
    keyed = rows.withColumn("_key", F.coalesce(F.nullif(own, F.lit("")), anew))
    return keep_first(keyed, "_key", order).select(*rows.columns)
