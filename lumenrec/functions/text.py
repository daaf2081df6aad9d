"""Text classification functions (SC1-SC3, SC6, SC11-SC13).

The keyword tests are "the whole text matches ``.*kw.*``" in the original
jobs.  ``.`` there does not match a line terminator, so a text holding a line
break never matches any keyword.
Null texts fall through to the default value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenrec.functions._col import col

# ---- fixed values (must equal the original jobs' tables) -------------------
# Class level keywords, first hit wins, and their tags.
LEVEL_TAGS = [
    ("启航", "_lev_1"),
    ("勤思", "_lev_2"),
    ("勤学", "_lev_2"),
    ("敏学", "_lev_3"),
    ("博学", "_lev_4"),
    ("创新", "_lev_5"),
    ("兴趣", "_lev_6"),
]
LEVEL_DEFAULT = "0"
# Subject keywords, first hit wins: (keyword, feature code).
SUBJECT_CODES = [
    ("语文", "chn"),
    ("数学", "math"),
    ("英语", "eng"),
    ("物理", "phy"),
    ("化学", "chem"),
    ("综合", "comp"),
]
SUBJECT_DEFAULT = "other"
# The rule-token form keeps the Chinese subject name; everything else is 其他.
SUBJECT_RULE_DEFAULT = "其他"
# Class types that keep their number in the tag; all others become _tp_0.
CLASS_TYPES = ["1", "2", "3"]
CLASS_TYPE_PREFIX = "_tp_"
# ---------------------------------------------------------------------------

# Java regex line terminators ('.' does not match them).
_LINE_TERMINATORS = "[\\n\\r\\u0085\\u2028\\u2029]"


def _first_keyword(c: Column, pairs, default: str) -> Column:
    expr = F.when(c.rlike(_LINE_TERMINATORS), F.lit(default))    # tested once, first
    for kw, out in pairs:
        expr = expr.when(c.contains(kw), F.lit(out))
    return F.coalesce(expr.otherwise(F.lit(default)), F.lit(default))


def level_tag(c) -> Column:
    """SC1 ``match_level``: 启航 -> _lev_1 ... 兴趣 -> _lev_6, else "0"."""
    return _first_keyword(col(c), LEVEL_TAGS, LEVEL_DEFAULT)


def subject_code(c) -> Column:
    """SC2 ``match_subject``: 语文 chn, 数学 math, ... else other."""
    return _first_keyword(col(c), SUBJECT_CODES, SUBJECT_DEFAULT)


def subject_rule_name(c) -> Column:
    """SC3 ``match_subject_forRule``: the six subjects kept in Chinese, else 其他."""
    return _first_keyword(col(c), [(kw, kw) for kw, _ in SUBJECT_CODES], SUBJECT_RULE_DEFAULT)


def class_type_tag(c) -> Column:
    """SC6 ``wash_cla_type``: "1"/"2"/"3" -> _tp_<n>, anything else (null too) -> _tp_0."""
    c = col(c)
    return F.when(c.isin(*CLASS_TYPES), F.concat(F.lit(CLASS_TYPE_PREFIX), c)) \
        .otherwise(F.lit(CLASS_TYPE_PREFIX + "0"))


def token(subject, term) -> Column:
    """SC11 rule token ``<rule subject>_<term>``."""
    return F.concat(subject_rule_name(subject), F.lit("_"), col(term))


def group_key(*cols, sep: str = "_") -> Column:
    """SC12 composite key; a null part renders as the text ``null`` like string concatenation."""
    return F.concat_ws(sep, *[F.coalesce(col(c).cast("string"), F.lit("null")) for c in cols])
