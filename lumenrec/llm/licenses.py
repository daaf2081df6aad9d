"""Licence scans: known licence sentences, and ordered rules over their sequence."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_CLASS, ascii_lower

# ---- fixed values: known licence sentences (identifier, sentence) --------------------------
# Each is one sentence by the rules of :func:`sentences` in both views, so a longer one stands here
# as its parts.  Where the standard text has an empty line but no full stop, both the parts and
# the whole are listed: behind comment marks the line is not empty.
SENTENCES = [
    ("apache-notice", "Licensed under the Apache License, Version 2.0."),
    ("apache-1", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                 "except in compliance with the License."),
    ("apache-2", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-at", "You may obtain a copy of the License at"),
    ("apache-url", "http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-url", "https://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-3", "Unless required by applicable law or agreed to in writing, software distributed under the License "
                 "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
                 "or implied."),
    *[("apache-2-3", f"You may obtain a copy of the License at {scheme}://www.apache.org/licenses/LICENSE-2.0 Unless "
                     "required by applicable law or agreed to in writing, software distributed under the License is "
                     "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
                     "or implied.") for scheme in ("http", "https")],
    ("apache-4", "See the License for the specific language governing permissions and limitations under the License."),
    ("mit-title", "MIT License"),
    ("mit-title", "The MIT License (MIT)"),
    ("mit-notice", "Released under the MIT License."),
    ("mit-notice", "Licensed under the MIT License."),
    ("mit-1", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
              "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
              "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
              "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
              "subject to the following conditions:"),
    ("mit-2", "The above copyright notice and this permission notice shall be included in all copies or substantial "
              "portions of the Software."),
    ("as-is-mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
                  "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
                  "NONINFRINGEMENT."),
    ("bsd-1", "Redistribution and use in source and binary forms, with or without modification, are permitted "
              "provided that the following conditions are met:"),
    ("bsd-source", "Redistributions of source code must retain the above copyright notice, this list of conditions "
                   "and the following disclaimer."),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
                   "and the following disclaimer in the documentation and/or other materials provided with the "
                   "distribution."),
    ("bsd-names", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                  "or promote products derived from this software without specific prior written permission."),
    ("bsd-notice", "Released under the BSD License."),
    ("gpl3-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("free-software", "This program is free software:"),
    *[(sid, f"you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free "
            "Software Foundation, either version 3 of the License, or (at your option) any later version.")
      for sid, name in (("gpl3-or-later", "General Public License"), ("lgpl3-or-later", "Lesser General Public License"),
                        ("agpl3-or-later", "Affero General Public License"))],
    *[(sid, f"This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} "
            f"as published by the Free Software Foundation; either version {version} of the License, or (at your "
            "option) any later version.")
      for what in ("program", "library", "software")
      for sid, name, version in (("gpl2-or-later", "General Public License", "2"),
                                 ("gpl3-or-later-2", "General Public License", "3"),
                                 ("lgpl2-or-later", "Library General Public License", "2"),
                                 ("lgpl21-or-later", "Lesser General Public License", "2.1"),
                                 ("lgpl3-or-later-2", "Lesser General Public License", "3"))],
    *[("gpl2-only", f"This program is free software; you can redistribute it and/or modify it under the terms of the "
                    f"GNU General Public License{comma} version 2{comma} as published by the Free Software Foundation.")
      for comma in ("", ",")],
    ("gpl-hope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
                 "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    *[("gpl-hope", f"This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
                   "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.")
      for what in ("library", "software")],
    ("lgpl-see", "See the GNU Lesser General Public License for more details."),
    ("agpl-see", "See the GNU Affero General Public License for more details."),
    ("gpl-see", "See the GNU General Public License for more details."),
    ("mpl2-form", "This Source Code Form is subject to the terms of the Mozilla Public License, v."),
    ("mpl2-copy", "If a copy of the MPL was not distributed with this file, You can obtain one at "
                  "http://mozilla.org/MPL/2.0/."),
    ("mpl2-copy", "If a copy of the MPL was not distributed with this file, You can obtain one at "
                  "https://mozilla.org/MPL/2.0/."),
    *[("isc-1", f"Permission to use, copy, modify, and{alt} distribute this software for any purpose with or without fee "
                "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
                "copies.") for alt in ("", "/or")],
    ("isc-2", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
              "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("unlicense-1", "This is free and unencumbered software released into the public domain."),
    ("unlicense-2", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
                    "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
                    "means."),
    ("zlib-1", "This software is provided 'as-is', without any express or implied warranty."),
    ("zlib-2", "In no event will the authors be held liable for any damages arising from the use of this software."),
    ("zlib-3", "Permission is granted to anyone to use this software for any purpose, including commercial applications, "
               "and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("bsl1-notice", "Distributed under the Boost Software License, Version 1.0."),
    *[("epl2-notice", "This program and the accompanying materials are made available under the terms of the Eclipse "
                      f"Public License {version} which is available at {scheme}://www.eclipse.org/legal/epl-2.0")
      for version in ("2.0", "v2.0") for scheme in ("http", "https")],
    ("ccby4-notice", "Licensed under CC BY 4.0."),
    ("ccbysa4-notice", "Licensed under CC BY-SA 4.0."),
    ("ccbync4-notice", "Licensed under CC BY-NC 4.0."),
    ("cc0-notice", "Released under CC0 1.0."),
    ("spdx-tag", "SPDX-License-Identifier:"),
]
# ---- fixed values: licences with the names that notices give them --------------------------
NAMES = {
    "Apache-2.0": ["Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0 License", "Apache-2.0 License"],
    "MIT": ["MIT License", "MIT license (MIT)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License", "2-Clause BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License", "3-Clause BSD License"],
    "GPL-2.0-only": ["GNU General Public License v2.0", "GNU General Public License, version 2", "GPL v2", "GPLv2", "GPLv2 license"],
    "GPL-3.0-only": ["GNU General Public License v3.0", "GNU General Public License, version 3", "GPL v3", "GPLv3", "GPLv3 license"],
    "LGPL-2.1-only": ["GNU Lesser General Public License v2.1", "LGPL v2.1", "LGPLv2.1"],
    "LGPL-3.0-only": ["GNU Lesser General Public License v3.0", "LGPL v3", "LGPLv3"],
    "AGPL-3.0-only": ["GNU Affero General Public License v3.0", "AGPL v3", "AGPLv3"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL 2.0"],
    "ISC": ["ISC License"], "Zlib": ["zlib License"], "Unlicense": ["Unlicense"], "BSL-1.0": ["Boost Software License 1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0"], "CC0-1.0": ["CC0 1.0 Universal license"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International License"],
}
OR_LATER = ["GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later"]
SUBJECTS = ["", "It is", *[f"This {x} is" for x in ("project", "software", "program", "library", "package", "work", "code", "file", "repository")]]
VERBS = ["licensed under", "released under", "distributed under", "available under"]
ENDINGS = ["", " - see the LICENSE file for details", " - see the [LICENSE](LICENSE) file for details", ", see LICENSE for details"]
DUAL = [("MIT", "GPL"), ("MIT", "Apache 2.0"), ("MIT", "Apache-2.0"), ("MIT", "BSD"), ("GPL", "MIT"), ("Apache 2.0", "MIT"), ("Apache-2.0", "MIT")]
DUAL_NAMES = {"Apache 2.0": "Apache-2.0"}
# ---------------------------------------------------------------------------------------------
# short notices, tags and expressions follow from the names by rule
_TAGS = [*NAMES, *OR_LATER]
_KNOWN = {tuple(re.findall("[a-z0-9]+", text.lower())) for _, text in SENTENCES}
SENTENCES += [(f"notice-{name}", text)
              for name, longs in NAMES.items() for long in longs for subject in SUBJECTS for verb in VERBS for ending in ENDINGS
              if tuple(re.findall("[a-z0-9]+", (text := f"{subject} {verb} the {long}{ending}.").lower())) not in _KNOWN]
SENTENCES += [(f"id-{name}", name) for name in _TAGS]
SENTENCES += [(f"expr-{a}-{op}-{b}", f"{a} {op} {b}") for a in _TAGS for b in _TAGS if a != b for op in ("OR", "AND")]
SENTENCES += [(f"dual-{DUAL_NAMES.get(a, a)}-{DUAL_NAMES.get(b, b)}", f"{start} {verb} the {a} and {b} licenses.")
              for a, b in DUAL for verb in ("licensed under", "released under") for start in ("Dual", "Dually")]
# ---- fixed values: ordered rules (rule, licence, sentence identifiers), the longer ones first --
RULES = [
    ("apache-header", "Apache-2.0", ["apache-1", "apache-2", "apache-3", "apache-4"]),
    ("apache-header-split", "Apache-2.0", ["apache-1", "apache-at", "apache-url", "apache-3", "apache-4"]),
    ("apache-commented", "Apache-2.0", ["apache-2-3", "apache-4"]),
    ("bsd-3", "BSD-3-Clause", ["bsd-1", "bsd-source", "bsd-binary", "bsd-names"]),
    ("bsd-2", "BSD-2-Clause", ["bsd-1", "bsd-source", "bsd-binary"]),
    ("mit-text", "MIT", ["mit-1", "as-is-mit"]),
    ("mit-text-split", "MIT", ["mit-1", "mit-2", "as-is-mit"]),
    ("mit-end", "MIT", ["mit-2", "as-is-mit"]),
    ("gpl3-header", "GPL-3.0-or-later", ["gpl3-or-later", "gpl-hope", "gpl-see"]),
    ("gpl2-header", "GPL-2.0-or-later", ["gpl2-or-later", "gpl-hope", "gpl-see"]),
    ("gpl3-statement-2", "GPL-3.0-or-later", ["gpl3-or-later-2"]),
    ("gpl3-statement", "GPL-3.0-or-later", ["gpl3-or-later"]),
    ("gpl2-statement", "GPL-2.0-or-later", ["gpl2-or-later"]),
    ("gpl2-only", "GPL-2.0-only", ["gpl2-only"]),
    ("lgpl2-statement", "LGPL-2.0-or-later", ["lgpl2-or-later"]),
    ("lgpl21-statement", "LGPL-2.1-or-later", ["lgpl21-or-later"]),
    ("lgpl3-statement", "LGPL-3.0-or-later", ["lgpl3-or-later"]),
    ("lgpl3-statement-2", "LGPL-3.0-or-later", ["lgpl3-or-later-2"]),
    ("agpl3-statement", "AGPL-3.0-or-later", ["agpl3-or-later"]),
    ("isc-text", "ISC", ["isc-1", "isc-2"]),
    ("unlicense-text", "Unlicense", ["unlicense-1", "unlicense-2"]),
    ("zlib-text", "Zlib", ["zlib-1", "zlib-2", "zlib-3"]),
    ("bsl1-notice", "BSL-1.0", ["bsl1-notice"]),
    ("epl2-notice", "EPL-2.0", ["epl2-notice"]),
    ("apache-notice", "Apache-2.0", ["apache-notice"]),
    ("mit-title", "MIT", ["mit-title", "mit-1"]),
    ("mit-notice", "MIT", ["mit-notice"]),
    ("bsd-notice", "BSD", ["bsd-notice"]),
    ("gpl3-notice", "GPL-3.0-only", ["gpl3-notice"]),
    ("mpl2-notice", "MPL-2.0", ["mpl2-form"]),
    ("ccby-notice", "CC-BY-4.0", ["ccby4-notice"]),
    ("ccbysa-notice", "CC-BY-SA-4.0", ["ccbysa4-notice"]),
    ("ccbync-notice", "CC-BY-NC-4.0", ["ccbync4-notice"]),
    ("cc0-notice", "CC0-1.0", ["cc0-notice"]),
]
RULES += [(f"notice-{name}", name, [f"notice-{name}"]) for name in NAMES]
RULES += [(f"tag-{name}", name, ["spdx-tag", f"id-{name}"]) for name in _TAGS]
RULES += [(f"expr-{a}-{op}-{b}", f"{a} {op} {b}", [f"expr-{a}-{op}-{b}"]) for a in _TAGS for b in _TAGS if a != b for op in ("OR", "AND")]
RULES += [(f"dual-{a}-{b}", f"{a} OR {b}", [f"dual-{a}-{b}"]) for a, b in dict.fromkeys(tuple(DUAL_NAMES.get(x, x) for x in p) for p in DUAL)]

_END = "\x1e"
VIEWS = ("line", "paragraph")


def normalised(sentence: Column) -> Column:
    """Lower-case ASCII letters and digits, anything else one space."""
    return F.btrim(F.regexp_replace(ascii_lower(sentence), "[^a-z0-9]+", " "))


def _ends(text: Column) -> Column:
    return F.regexp_replace(text, rf"([.!?:]){WS_CLASS}+", f"$1{_END}")


def sentences(text: Column, view: str) -> Column:
    """Sentences of a text.

    ``line``: a line break ends a sentence too.  ``paragraph``: only an empty line does, so that
    a sentence may be wrapped.
    """
    if view == "line":
        return F.split(F.regexp_replace(_ends(text), r"\n+", _END), _END)
    return F.split(_ends(F.regexp_replace(F.regexp_replace(text, r"\n[\x20\x09\x0B-\x0D]*\n", _END), r"\n", " ")), _END)


def _rule_pattern(ids: list[str]) -> str:
    """The identifiers in order, each between spaces of its own; between two of them one run of
    unknown sentences may stand."""
    return "( ~ )?".join(f" {re.escape(i)} " for i in ids)


def _longer(ids: list[str], rules: list[tuple[str, str, list[str]]]) -> list[str]:
    """The patterns of the rules that hold the identifiers in a row and more, the longest first."""
    def holds(other: list[str]) -> bool:
        return len(other) > len(ids) and any(other[k:k + len(ids)] == ids for k in range(len(other)))

    return [_rule_pattern(r[2]) for r in sorted(rules, key=lambda r: -len(r[2])) if holds(r[2])]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  known: list[tuple[str, str]] = SENTENCES,
                  rules: list[tuple[str, str, list[str]]] = RULES) -> DataFrame:
    """Per row: ``id_col``, n_known (known sentences in the line view), line_ids and paragraph_ids
    (identifier sequences; ``~`` stands for unknown sentences in between), rules and licenses
    (arrays, in the order of ``rules``; a licence once).  A rule whose matches all lie inside those
    of longer rules is dropped.

    Null or empty text has no sentences.  Rows with the same id and text share one result; null
    ids are kept; an empty table gives an empty result; other columns are ignored.

    ``known`` is a constant table and is broadcast; only known sentences (identifier, position)
    are shuffled and gathered per text.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tk"), text.alias("text"))
    table = spark.createDataFrame(known, "sid string, raw string").select(
        "sid", normalised(F.col("raw")).alias("sentence")).dropDuplicates(["sentence"])
    hits = None
    for view in VIEWS:
        found = (rows.select("id", "tk", F.posexplode(sentences(F.col("text"), view)).alias("pos", "raw"))
                 .select("id", "tk", "pos", normalised(F.col("raw")).alias("sentence"))
                 .join(F.broadcast(table), "sentence")
                 .select("id", "tk", F.lit(view).alias("view"), "pos", "sid"))
        hits = found if hits is None else hits.unionByName(found)

    def sequence(view: str) -> Column:
        seq = F.array_sort(F.collect_set(F.when(F.col("view") == view, F.struct("pos", "sid"))))
        return seq.alias(view)

    def rendered(view: str) -> Column:
        gap = F.aggregate(
            F.col(view), F.struct(F.lit(-1).alias("last"), F.lit("").alias("out")),
            lambda a, s: F.struct(s["pos"].alias("last"), F.concat(
                a["out"], F.when((a["last"] >= 0) & (s["pos"] > a["last"] + 1), F.lit("~ ")).otherwise(F.lit("")),
                s["sid"], F.lit(" ")).alias("out")))
        return gap["out"].alias(f"{view}_ids")

    per = hits.groupBy("id", "tk").agg(*[sequence(v) for v in VIEWS], F.collect_set("sid").alias("sids"))
    per = per.select("id", "tk", "sids", F.size("line").cast("long").alias("n_known"), *[rendered(v) for v in VIEWS])
    book = spark.createDataFrame([(i, rule, name, ids[0], _rule_pattern(ids), _longer(ids, rules)) for i, (rule, name, ids) in enumerate(rules)],
                                 "ord int, rule string, license string, sid string, pattern string, longer array<string>")
    # a text meets the rules that begin with one of its identifiers
    own = ["id", "tk", "n_known", "line_ids", "paragraph_ids"]
    tried = per.select(*own, F.explode("sids").alias("sid")).join(F.broadcast(book), "sid", "left")
    for v in VIEWS:
        spaced = F.regexp_replace(f"{v}_ids", r"(\S+) ", " $1 ")
        free = F.aggregate("longer", spaced, lambda seq, p: F.regexp_replace(seq, p, F.lit(" # ")))
        tried = tried.withColumns({f"{v}_all": F.regexp_count(spaced, F.col("pattern")), f"{v}_free": F.regexp_count(free, F.col("pattern"))})
    # the view that shows the rule most often decides whether it stands outside longer matches
    first, second = VIEWS
    by_first = (F.col(f"{first}_all") > F.col(f"{second}_all")) | (
        (F.col(f"{first}_all") == F.col(f"{second}_all")) & (F.col(f"{first}_free") <= F.col(f"{second}_free")))
    stands = F.when(by_first, F.col(f"{first}_free")).otherwise(F.col(f"{second}_free")) > 0
    per = tried.groupBy(*own).agg(F.array_sort(F.collect_set(F.when(stands, F.struct("ord", "rule", "license")))).alias("m"))
    per = per.select(F.col("id").alias("p_id"), F.col("tk").alias("p_tk"), "n_known", "line_ids", "paragraph_ids",
                     F.col("m.rule").alias("rules"), F.array_distinct(F.col("m.license")).alias("licenses"))
    out = rows.select("id", "tk").join(per, F.col("id").eqNullSafe(F.col("p_id")) & (F.col("tk") == F.col("p_tk")), "left")
    none = F.array().cast("array<string>")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_known", F.lit(0).cast("long")).alias("n_known"),
                      F.rtrim(F.coalesce("line_ids", F.lit(""))).alias("line_ids"),
                      F.rtrim(F.coalesce("paragraph_ids", F.lit(""))).alias("paragraph_ids"),
                      F.coalesce("rules", none).alias("rules"), F.coalesce("licenses", none).alias("licenses"))


# ---------------------------------------------------------------- the same in DuckDB SQL

def oracle_sql() -> str:
    def lit(s):
        return "'" + s.replace("'", "''") + "'"

    def norm(e):
        return (f"trim(regexp_replace(translate({e}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                "'[^a-z0-9]+', ' ', 'g'))")

    def ends(e):
        return rf"regexp_replace({e}, '([.!?:])[\x20\x09-\x0D]+', '\1' || chr(30), 'g')"

    line = f"string_split(regexp_replace({ends('text')}, '\\n+', chr(30), 'g'), chr(30))"
    para = ("string_split(" + ends("replace(regexp_replace(text, '\\n[\\x20\\x09\\x0B-\\x0D]*\\n', chr(30), 'g'), "
                                   "chr(10), ' ')") + ", chr(30))")
    known = ", ".join(f"({lit(i)}, {lit(s)})" for i, s in SENTENCES)
    rules = ", ".join(f"({i}, {lit(r)}, {lit(n)}, {lit(ids[0])}, {lit(_rule_pattern(ids))}, [{', '.join(map(lit, _longer(ids, RULES)))}]::VARCHAR[])"
                      for i, (r, n, ids) in enumerate(RULES))

    def spaced(v):
        return rf"regexp_replace({v}_ids, '(\S+) ', ' \1 ', 'g')"

    def count(e):
        return f"len(regexp_extract_all({e}, pattern))"

    def free(v):
        return f"list_reduce(list_prepend({spaced(v)}, longer), lambda seq, p: regexp_replace(seq, p, ' # ', 'g'))"

    view = "SELECT doc_id, '{v}' AS view, unnest({s}) AS raw, unnest(range(len({s}))) AS pos FROM documents"
    return f"""
WITH known AS (SELECT DISTINCT sid, {norm('raw')} AS sentence FROM (VALUES {known}) v(sid, raw)),
s AS ({view.format(v='line', s=line)} UNION ALL {view.format(v='paragraph', s=para)}),
h AS (SELECT doc_id, view, pos, sid,
             pos - lag(pos) OVER (PARTITION BY doc_id, view ORDER BY pos) AS step
      FROM s JOIN known ON known.sentence = {norm('s.raw')}),
q AS (SELECT doc_id, count(*) FILTER (WHERE view = 'line') AS n_known,
             coalesce(string_agg(CASE WHEN step > 1 THEN '~ ' ELSE '' END || sid || ' ', '' ORDER BY pos)
                      FILTER (WHERE view = 'line'), '') AS line_ids,
             coalesce(string_agg(CASE WHEN step > 1 THEN '~ ' ELSE '' END || sid || ' ', '' ORDER BY pos)
                      FILTER (WHERE view = 'paragraph'), '') AS paragraph_ids
      FROM h GROUP BY doc_id),
rules(ord, rule, license, sid, pattern, longer) AS (VALUES {rules}),
c AS (SELECT DISTINCT doc_id, sid FROM h),
x AS (SELECT q.doc_id, ord, rule, license, {count(spaced('line'))} AS la, {count(spaced('paragraph'))} AS pa,
             {count(free('line'))} AS lf, {count(free('paragraph'))} AS pf
      FROM c JOIN rules USING (sid) JOIN q ON q.doc_id = c.doc_id),
m AS (SELECT DISTINCT doc_id, ord, rule, license FROM x
      WHERE CASE WHEN la > pa OR (la = pa AND lf <= pf) THEN lf ELSE pf END > 0),
l AS (SELECT doc_id, license, min(ord) AS ord FROM m GROUP BY doc_id, license),
r AS (SELECT doc_id, string_agg(rule, ',' ORDER BY ord) AS rules FROM m GROUP BY doc_id),
n AS (SELECT doc_id, string_agg(license, ',' ORDER BY ord) AS licenses FROM l GROUP BY doc_id)
SELECT d.doc_id, coalesce(q.n_known, 0) AS n_known, rtrim(coalesce(line_ids, '')) AS line_ids,
       rtrim(coalesce(paragraph_ids, '')) AS paragraph_ids, coalesce(r.rules, '') AS rules,
       coalesce(n.licenses, '') AS licenses
FROM documents d LEFT JOIN q USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN n USING (doc_id)"""
