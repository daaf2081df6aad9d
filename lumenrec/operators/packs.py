"""Result packs (NS7, NS8, AG8-AG10) in long form.

A pack is the set of entries of one key (a student, or a city/grade/subject
group): one row ``(key, section, cla_id, entry)`` per class, ``entry`` the
class's attributes as JSON.  Nothing is gathered per key, so a key may have any
number of entries; ``render`` builds the one JSON value of keys that are asked
for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: the pack layout of the original export -----------------------------
# Attribute map of one class, in this field order; the score is named getScore.
INFO_FIELDS = [
    "cla_id", "city_id", "cla_subject_ids", "cla_class_type", "cla_subject_names",
    "cla_term_id", "cla_grade_id", "cla_level_name", "cla_classtime_names",
    "cla_classdate_name", "getScore",
]
ONLINE_KEY = "online_recom"
OFFLINE_KEY = "offine_recom"   # spelling is part of the output format
ONLINE_TYPE = 1
# ------------------------------------------------------------------------------------------

LIST_SECTION = "list"          # the one section of a fallback list
_JSON_OPTS = {"ignoreNullFields": "false"}


def entry_json() -> Column:
    """NS7, NS8: the 11 attributes as text, in the fixed order (SC13 casts), as JSON."""
    fields = []
    for name in INFO_FIELDS:
        c = F.col("fin_score").cast("float") if name == "getScore" else F.col(name)
        fields.append(c.cast("string").alias(name))
    return F.to_json(F.struct(*fields), _JSON_OPTS)


def section() -> Column:
    """Class type 1 goes online, every other type (null too) offline."""
    online = F.coalesce(F.col("cla_class_type").cast("int") == ONLINE_TYPE, F.lit(False))
    return F.when(online, F.lit(ONLINE_KEY)).otherwise(F.lit(OFFLINE_KEY))


def list_entries(rows: DataFrame, key: list[str]) -> DataFrame:
    """AG10: the entries of a list per key; a class that is scored twice is listed twice."""
    return rows.select(*key, F.lit(LIST_SECTION).alias("section"), "cla_id", entry_json().alias("entry"))


def online_offline_entries(rows: DataFrame, key: list[str], keyed: bool = False) -> DataFrame:
    """AG8 (``keyed=False``): the entries of the online and the offline list;
    AG9 (``keyed=True``): the same with one entry per class id.

    Of repeated classes the keyed form keeps the entry with the highest score,
    of equal scores the one whose JSON is the greatest text.
    """
    out = rows.select(*key, section().alias("section"), "cla_id", entry_json().alias("entry"), "fin_score")
    if keyed:
        best = F.max(F.struct("fin_score", "entry", "section")).alias("b")
        out = out.groupBy(*key, "cla_id").agg(best).select(*key, "b.section", "cla_id", "b.entry")
    return out.select(*key, "section", "cla_id", "entry")


def _list(section_name: str, keyed: bool) -> Column:
    """The section's entries in order of class id as JSON, without brackets."""
    item = F.col("entry")
    if keyed:
        name = F.to_json(F.array("cla_id"))
        item = F.concat(F.substring(name, F.lit(2), F.char_length(name) - 2), F.lit(":"), item)
    pair = F.when(F.col("section") == section_name, F.struct(F.col("cla_id").alias("k"), item.alias("v")))
    return F.array_join(F.transform(F.array_sort(F.collect_list(pair)), lambda p: p["v"]), ",")


def render(entries: DataFrame, key: str, keyed: bool = False, *more: Column) -> DataFrame:
    """``(key, value)``: the JSON value of each key of ``entries``, and ``more`` aggregates of it.

    For requested keys: the value of a key holds all its entries, so its size
    is the reader's choice.  A key of a list section renders as a JSON list.
    """
    lo, hi = ("{", "}") if keyed else ("[", "]")
    parts = entries.groupBy(key).agg(
        *more, F.max(F.col("section") == LIST_SECTION).alias("_plain"), _list(LIST_SECTION, False).alias("_l"),
        _list(ONLINE_KEY, keyed).alias("_on"), _list(OFFLINE_KEY, keyed).alias("_off"))
    both = F.concat(F.lit(f'{{"{ONLINE_KEY}":{lo}'), "_on", F.lit(f'{hi},"{OFFLINE_KEY}":{lo}'), "_off", F.lit(f"{hi}}}"))
    named = [c for c in parts.columns if c not in (key, "_plain", "_l", "_on", "_off")]
    return parts.select(key, *named, F.when(F.col("_plain"), F.concat(F.lit("["), "_l", F.lit("]")))
                        .otherwise(both).alias("value"))
