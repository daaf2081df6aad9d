"""Containment join (JN7) by subset keys.

An item holds few tokens (a student has at most three), so it has few subsets:
a set is contained in an item if and only if it equals one of them.  The join is
then one equi-join on the coarse key and the subset, the empty subset included;
nothing is counted per pair.

Keys such as ``(city, grade)`` are coarse: one value can hold a third of all
students.  Both inputs meet the join through their own exchange, so adaptive
execution splits the partition of a hot key by measured bytes and copies only
the other side's part of it (``spark.sql.adaptive.skewJoin``), without a bound
on the number of splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TOKENS = 3          # tokens of an item: 2 ** 3 subsets


def set_key(tokens) -> Column:
    """The set of a token list as a key: distinct tokens in order; null for a null list or a null token."""
    c = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.when(~F.exists(c, lambda x: x.isNull()), F.array_sort(F.array_distinct(c)))


def subset_keys(tokens, max_tokens: int = MAX_TOKENS) -> Column:
    """The keys of all sets contained in a token list: 2 ** n for its n distinct tokens.

    Null tokens are in no set; a null list has no subsets.  A list of more than
    ``max_tokens`` distinct tokens fails, as its subsets would be too many.
    """
    c = F.col(tokens) if isinstance(tokens, str) else tokens
    t = F.array_sort(F.array_compact(F.array_distinct(c)))
    masks = F.sequence(F.lit(0), F.pow(F.lit(2), F.size(t)).cast("int") - 1)
    subsets = F.transform(masks, lambda m: F.filter(t, lambda x, i: (F.floor(m / F.pow(F.lit(2), i)) % 2) == 1))
    return F.when(F.size(t) > max_tokens, F.raise_error(F.lit(f"more than {max_tokens} tokens in a list"))) \
        .when(c.isNotNull(), subsets)


def containment_join(items: DataFrame, item_key: list[str], item_tokens: str,
                     sets: DataFrame, set_key_cols: list[str], set_tokens: str, on: list[str],
                     max_tokens: int = MAX_TOKENS) -> DataFrame:
    """JN7 relational division: pairs (item, set) with ``set_tokens`` a subset of ``item_tokens``
    inside the same ``on`` group.

    Empty sets are contained in every item, null sets in none.  Returns
    ``item_key + set_key_cols``, one row per matching pair of rows: repeated
    items or sets pair as often as they are repeated.
    """
    key = "_subset"
    it = items.select(*item_key, *[c for c in on if c not in item_key], F.explode(subset_keys(item_tokens, max_tokens)).alias(key))
    st = sets.select(*set_key_cols, *[c for c in on if c not in set_key_cols], set_key(set_tokens).alias(key)) \
        .filter(F.col(key).isNotNull() & (F.size(key) <= max_tokens))
    return it.join(st, [*on, key]).select(*item_key, *set_key_cols)
