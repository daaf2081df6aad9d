from lumenrec.llm import licenses
from tests.llm.helpers import docs, edge_rows

BY_ID = {}
for sid, text in licenses.SENTENCES:
    BY_ID.setdefault(sid, text)


def scan(spark, rows):
    return {r.doc_id: r for r in licenses.scan_licenses(docs(spark, rows)).collect()}


def test_rules_in_order(spark):
    header = " ".join(BY_ID[f"apache-{i}"] for i in (1, 2, 3, 4)).replace("LICENSE-2.0 Unless", "LICENSE-2.0\n\nUnless")
    wrapped = header.replace(" you ", "\nyou ").replace(" is distributed", "\n  is distributed")
    rows = [(1, "Some text.\n" + BY_ID["mit-notice"] + "\nmore text"), (2, header), (3, wrapped),
            (4, "\n".join(BY_ID[s] for s in ("bsd-1", "bsd-source", "bsd-binary", "bsd-names"))),
            (5, "\n".join(BY_ID[s] for s in ("bsd-binary", "bsd-source", "bsd-1"))),          # wrong order: no rule
            (6, "LICENSED   under the *MIT* license!"), (7, BY_ID["ccbync4-notice"] + "\nx\n" + BY_ID["gpl3-notice"]),
            (8, "the license is a fine word and MIT is a school")]
    got = scan(spark, rows)
    assert got[1].licenses == ["MIT"] and got[1].line_ids == "mit-notice"
    assert got[2].rules[0] == "apache-header" and got[2].licenses == ["Apache-2.0"]
    assert got[3].licenses == ["Apache-2.0"]
    assert got[4].rules == ["bsd-3"] and got[4].licenses == ["BSD-3-Clause"]      # the shorter rule lies inside
    assert got[5].rules == [] and got[5].n_known == 3
    assert got[6].licenses == ["MIT"]
    assert got[7].licenses == ["GPL-3.0-only", "CC-BY-NC-4.0"] and got[7].line_ids == "ccbync4-notice ~ gpl3-notice"
    assert got[8].licenses == []


def test_gap_of_unknown_sentences(spark):
    text = "\n".join([BY_ID["mit-title"], "Copyright (c) 2020 Somebody", BY_ID["mit-1"].split(" The above")[0], BY_ID["mit-2"],
                      BY_ID["as-is-mit"]])
    assert "mit-text-split" in scan(spark, [(1, text)])[1].rules


def test_edges(spark):
    out = licenses.scan_licenses(docs(spark, [*edge_rows(), (1, BY_ID["mit-notice"]), (None, BY_ID["mit-notice"])]))
    assert sorted(str(r.doc_id) for r in out.collect() if r.licenses) == ["1", "None"]
    assert out.count() == len(edge_rows()) + 2
    assert licenses.scan_licenses(docs(spark, [])).count() == 0


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE."""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:"""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means."""
EPL = """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0

SPDX"""
STANDARD = [("Apache-2.0", APACHE), ("GPL-3.0-or-later", GPL), ("GPL-3.0-or-later", GPL.replace(": you", "; you").replace("n, e", "n; e")),
            ("AGPL-3.0-or-later", GPL.replace("GNU General", "GNU Affero General")),
            ("LGPL-3.0-or-later", GPL.replace("GNU General", "GNU Lesser General")), ("LGPL-2.1-or-later", LGPL), ("MPL-2.0", MPL),
            ("ISC", ISC), ("Zlib", ZLIB), ("Unlicense", UNLICENSE),
            ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0.\n(See accompanying file LICENSE_1_0.txt)")]
PLAIN_ONLY = [("EPL-2.0", EPL)]


def commented(text, mark):
    return "\n".join(f"{mark} {line}".rstrip() for line in text.split("\n"))


def test_standard_headers_plain_and_commented(spark):
    texts = [(name, form) for name, text in STANDARD for form in
             (text, commented(text, " *"), commented(text, "#"), commented(text, "//"), f"/*\n{commented(text, ' *')}\n */")]
    texts += PLAIN_ONLY + [("Apache-2.0", commented("Copyright 2020 Somebody\n\n" + APACHE, " *"))]
    got = scan(spark, [(i, text) for i, (_, text) in enumerate(texts)])
    assert [(name, got[i].licenses) for i, (name, _) in enumerate(texts)] == [(name, [name]) for name, _ in texts]


def test_no_known_sentence_or_rule_is_dead(spark):
    from pyspark.sql import functions as F
    table = spark.createDataFrame(licenses.SENTENCES, "sid string, raw string")
    for view in licenses.VIEWS:
        parts = F.filter(licenses.sentences(F.col("raw"), view), lambda s: licenses.normalised(s) != "")
        assert [r.sid for r in table.filter(F.size(parts) != 1).collect()] == []
    assert {i for _, _, ids in licenses.RULES for i in ids} <= {sid for sid, _ in licenses.SENTENCES}
    by_sentence = {}
    for r in table.select("sid", licenses.normalised(F.col("raw")).alias("s")).collect():
        assert by_sentence.setdefault(r.s, r.sid) == r.sid


def test_tags_expressions_and_short_notices(spark):
    cases = [("SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]), ("// SPDX-License-Identifier: MIT\nint x;", ["MIT"]),
             ("# SPDX-License-Identifier: GPL-2.0-or-later", ["GPL-2.0-or-later"]), ("MIT OR Apache-2.0", ["MIT OR Apache-2.0"]),
             ("/* SPDX-License-Identifier: MIT OR Apache-2.0 */", ["MIT OR Apache-2.0"]),
             ("This project is licensed under the MIT License - see the LICENSE file for details.", ["MIT"]),
             ("This project is licensed under the MIT License - see the [LICENSE](LICENSE) file for details", ["MIT"]),
             ("This file is licensed under the Mozilla Public License 2.0.", ["MPL-2.0"]),
             ("Dual licensed under the MIT and GPL licenses.", ["MIT OR GPL"]),
             ("It is distributed under the GNU General Public License v3.0.", ["GPL-3.0-only"]),
             ("This software is released under the BSD 3-Clause License.", ["BSD-3-Clause"]),
             ("MIT", []), ("The Apache-2.0 was a rocket", []), ("SPDX-License-Identifier: unheard-of", []),
             ("SPDX-License-Identifier:\n\nOther words.\nMIT", ["MIT"])]         # one run of unknown sentences may stand between
    got = scan(spark, [(i, t) for i, (t, _) in enumerate(cases)])
    assert [(t, got[i].licenses) for i, (t, _) in enumerate(cases)] == cases


def test_a_rule_inside_a_longer_one_is_dropped_only_there(spark):
    three = [BY_ID[s] for s in ("bsd-1", "bsd-source", "bsd-binary", "bsd-names")]
    rows = [(1, "\n".join(three)), (2, "\n".join(three[:3])), (3, "\n".join([*three, "Another part.", *three[:3]])),
            (4, "\n".join([*three[:3], "Another part.", *three])), (5, "\n".join(three * 2)),
            (6, "\n".join([BY_ID["mit-title"], BY_ID["mit-1"], BY_ID["mit-2"], BY_ID["as-is-mit"]]))]
    got = scan(spark, rows)
    assert [got[i].rules for i in (1, 2, 3, 4, 5)] == [["bsd-3"], ["bsd-2"], ["bsd-3", "bsd-2"], ["bsd-3", "bsd-2"], ["bsd-3"]]
    assert got[6].rules == ["mit-text-split", "mit-title"]         # overlaps, but lies in none; mit-end lies inside


def brute_rules(line, paragraph):
    """Occurrences as intervals of the sequences; a rule stays if one of the deciding view's lies in no longer rule's."""
    def spans(seq, ids):
        out, i = [], 0
        while i < len(seq):
            j, k = i, 0
            while j < len(seq) and k < len(ids):
                if seq[j] == ids[k]:
                    k, j = k + 1, j + 1
                elif seq[j] == "~" and 0 < k:
                    j += 1
                else:
                    break
            if k == len(ids):
                out.append((i, j))
                i = j
            else:
                i += 1
        return out
    found = []
    for rule, _, ids in licenses.RULES:
        longer = sorted((r[2] for r in licenses.RULES if len(r[2]) > len(ids) and any(r[2][k:k + len(ids)] == ids for k in range(len(r[2])))), key=len, reverse=True)
        views = []
        for seq in (line, paragraph):
            rest = list(seq)
            for other in longer:
                for a, b in spans(rest, other):
                    rest[a:b] = ["#"] + [""] * (b - a - 1)
                rest = [x for x in rest if x]
            views.append((len(spans(seq, ids)), -len(spans(rest, ids))))
        if -max(views)[1] > 0 and max(views)[0]:
            found.append(rule)
    return found


def test_rules_against_brute_force(spark):
    import random
    rnd = random.Random(5)
    bits = [BY_ID[s] for s in ("bsd-1", "bsd-source", "bsd-binary", "bsd-names", "mit-title", "mit-1", "mit-2", "as-is-mit", "apache-at", "apache-url",
                               "apache-3", "apache-4", "apache-1", "spdx-tag", "id-MIT", "gpl3-or-later", "gpl-hope", "gpl-see")] + ["Other words.", "And more."]
    rows = [(i, "\n".join(rnd.choice(bits) if rnd.random() < 0.5 else " ".join(bits[a:a + rnd.randrange(1, 5)])
                          for a in [rnd.randrange(len(bits)) for _ in range(rnd.randrange(1, 9))])) for i in range(150)]
    for r in scan(spark, rows).values():
        assert r.rules == brute_rules(r.line_ids.split(), r.paragraph_ids.split()), r
