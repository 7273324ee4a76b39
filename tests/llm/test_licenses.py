import random
import re
import textwrap

from lexiforge.llm import licenses as M
from lexiforge.llm.registry import oracle_sql
from tests.compare import check, connect
from tests.llm.fixtures import documents, odd_rows

APACHE = """Copyright 2020 Somebody

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
BSD2 = """Copyright (c) 2020, Somebody
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
MIT = "MIT License\n\nCopyright (c) 2020 Somebody\n\n" + textwrap.fill(M.KNOWN["mit-grant"], 70) + "\n\n" + textwrap.fill(M.KNOWN["mit-condition"], 70) + "\n\n" + textwrap.fill(M.KNOWN["mit-asis"] + " " + M.KNOWN["mit-liability"], 70)
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.
"""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.
"""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
GPL2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.
"""
AGPL = GPL3.replace("GNU General", "GNU Affero General")
SHARP, SLASH = (lambda t: "".join(f"# {x}".rstrip() + "\n" for x in t.split("\n"))), (lambda t: "/*\n" + "".join(f" * {x}\n" for x in t.split("\n")) + " */")
CASES = [
    (APACHE, "Apache-2.0"), (SHARP(APACHE), "Apache-2.0"), (SLASH(APACHE), "Apache-2.0"), (BSD2, "BSD-2-Clause"), (BSD3, "BSD-3-Clause"), (SLASH(BSD3), "BSD-3-Clause"), (MIT, "MIT"),
    (MPL, "MPL-2.0"), (SHARP(MPL), "MPL-2.0"), (UNLICENSE, "Unlicense"), (GPL3, "GPL-3.0-or-later"), (GPL2, "GPL-2.0-or-later"), (AGPL, "AGPL-3.0-or-later"), (SHARP(GPL2), "GPL-2.0-or-later"),
    ("Notes\nReleased under the MIT License.\n" + GPL3, "GPL-3.0-or-later MIT"), ("A heading\n" + GPL2, "GPL-2.0-or-later"), ("// SPDX-License-Identifier: MPL-2.0\ncode", "MPL-2.0"),
    ("It is good. Licensed under CC BY-NC 4.0. Really.", "CC-BY-NC-4.0"), ("This work is licensed under a Creative Commons\nAttribution 4.0 International License.", "CC-BY-4.0"),
    ("This work is licensed under the GNU General Public License, version 3.\nReleased under the MIT License.", "GPL-3.0-only MIT"), (BSD2 + "\n" + BSD3, "BSD-2-Clause BSD-3-Clause"),
    ("MIT", ""), ("we have no license to speak of", ""), ("Permission is hereby granted.", ""), (None, ""), ("", ""), ("\n \n", ""),
]


def slow(text, table, rules):
    """Sentence by sentence, in plain Python."""
    lines = [re.sub(M.COMMENT, "", x) for x in (text or "").split("\n")]
    sentences = re.sub(M.EMPTY, M.CUT, re.sub(M.STOP, M.CUT + r"\1", "\n".join(lines))).split(M.CUT)
    ids = []
    for s in sentences:
        whole, own = M.normal(s), [x for x in map(M.normal, s.split("\n")) if x][-M.LINES :]
        if whole in table:
            ids.append(table[whole])
        elif "\n" in s.strip(" "):
            ids += [table[x] for x in own if x in table]
            ids += [table[x] for k in range(1, len(own) - 1) if (x := " ".join(own[k:])) in table][:1]
    found, used = set(), [False] * len(ids)
    for licence, sequence in rules:
        n, k = len(sequence), 0
        while k + n <= len(ids):
            if tuple(ids[k : k + n]) == sequence and not any(used[k : k + n]):
                found.add(licence)
                used[k : k + n] = [True] * n
                k += n
            else:
                k += 1
    return " ".join(ids), " ".join(sorted(found)), len(ids)


def test_whole_licences(spark):
    rows = [(k, t, "en", "a", 1) for k, (t, _) in enumerate(CASES)]
    got = {r.doc_id: r for r in M.scan(documents(spark, rows)).collect()}
    assert {k: got[k].licenses for k in got} == {k: want for k, (_, want) in enumerate(CASES)}


def test_equals_brute_force(spark):
    table, rules = M.known()
    assert len(table) > 900
    rows = odd_rows() + [(1000 + k, t, "en", "a", 1) for k, (t, _) in enumerate(CASES)]
    rows += [(2000, "\n".join(["x"] * 300 + APACHE.split("\n")), "en", "a", 1), (2001, "Heading\nReleased under the\nMIT License. " * 30, "en", "a", 1)]
    got = M.scan(documents(spark, rows)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(((r.doc_id, r.sentence_ids, r.licenses, r.n_sentences) for r in got), key=key) == sorted(((d, *slow(t, table, rules)) for d, t, *_ in rows), key=key)
    assert M.scan(documents(spark, [])).count() == 0


# (text, identifiers, licences): known lines and runs of lines at any place of a sentence
ANYWHERE = [
    ("Released under the MIT License\n" + "x\n" * 200, "MIT-notice", "MIT"),
    ("x\n" * 200 + "Released under the MIT License\n" + "x\n" * 200, "MIT-notice", "MIT"),
    ("Released under the\nMIT License\na line without a stop", "MIT-notice", "MIT"),
    ("x\n" * 300 + "Released under the\nMIT\nLicense\n" + "x\n" * 300, "spdx:MIT MIT-notice", "MIT"),
    ("Heading\nReleased under the\nMIT License\nDistributed under\nthe ISC License\nand more", "MIT-notice ISC-notice", "ISC MIT"),
    ("Heading\nPermission to use, copy, modify,\nand/or distribute this software for any purpose\nwith or without fee is hereby granted,\nprovided that the above copyright notice and this\npermission notice appear in all copies\nfooter", "isc-grant", "ISC"),
    ("Licensed under the Apache\nLicense, Version 2.0 (the \"License\")\nfooter", "apache2-header", "Apache-2.0"),
    ("Released under the\nMIT License\nheading\nThis work is licensed under\nthe ISC License", "MIT-notice ISC-notice", "ISC MIT"),
    ("\n".join(M.normal(M.KNOWN["mit-grant"]).split()) + "\nx", "mit-grant", ""),
    ("Released under\n" * 400 + "the MIT License\n" + "Released under the\n" * 400, "MIT-notice", "MIT"),
    ("x\nReleased under the\nMIT License\n" * 150 + "x", " ".join(["MIT-notice"] * 150), "MIT"),
]


def every_run(text, table):
    """Every line and every run of lines of each sentence, in plain Python: lines, and runs in no longer one, by their ends."""
    lines = [re.sub(M.COMMENT, "", x) for x in (text or "").split("\n")]
    ids = []
    for s in re.sub(M.EMPTY, M.CUT, re.sub(M.STOP, M.CUT + r"\1", "\n".join(lines))).split(M.CUT):
        whole, own = M.normal(s), [x for x in map(M.normal, s.split("\n")) if x]
        if whole in table:
            ids.append(table[whole])
            continue
        n, most = len(own), max(len(x.split()) for x in table)
        runs = [(k, e) for k in range(n) for e in range(k + 2, min(n, k + most) + 1) if " ".join(own[k:e]) in table]
        outer = [r for r in runs if not any(q != r and q[0] <= r[0] and r[1] <= q[1] for q in runs)]
        hits = [(k + 1, 0, own[k]) for k in range(n) if own[k] in table] if "\n" in s else []
        ids += [table[x] for *_, x in sorted(hits + [(e, 1, " ".join(own[k:e])) for k, e in outer])]
    return " ".join(ids)


def test_known_lines_at_any_place(spark):
    table, _ = M.known()
    got = {r.doc_id: r for r in M.scan(documents(spark, [(k, t, "en", "a", 1) for k, (t, *_) in enumerate(ANYWHERE)])).collect()}
    assert {k: (got[k].sentence_ids, got[k].licenses) for k in got} == {k: tuple(want) for k, (_, *want) in enumerate(ANYWHERE)}
    assert [every_run(t, table) for t, *_ in ANYWHERE] == [ids for _, ids, _ in ANYWHERE]


def test_equals_every_run(spark):
    table, _ = M.known()
    rng, names = random.Random(3), sorted(table)
    rows = []
    for k in range(150):  # known sentences wrapped anywhere, other lines and parts of sentences between them, hardly a stop
        lines = []
        for _ in range(rng.choice([1, 3, 8, 60])):
            words = rng.choice([rng.choice(names), M.normal(rng.choice(list(M.KNOWN.values())))]).split()
            words = words[: rng.choice([len(words), len(words), rng.randrange(len(words)) + 1])]
            while words:
                n = rng.choice([1, 2, 3, 5, 9, 99])
                lines.append(" ".join(words[:n]))
                words = words[n:]
            lines += ["x"] * rng.choice([0, 0, 1, 2, 150])
            lines[-1] += rng.choice(["", "", "", "."])
        rows.append((k, "\n".join(lines), "en", "a", 1))
    got = {r.doc_id: r.sentence_ids for r in M.scan(documents(spark, rows)).collect()}
    assert got == {k: every_run(t, table) for k, t, *_ in rows}


def test_passages_are_cut_like_texts():
    table, _ = M.known()
    assert table["you may obtain a copy of the license at"] == "apache2-copy"
    assert table["licensed under the apache license version 2 0"] == "Apache-2.0-notice"
    assert [table[x] for x in M.cut(M.KNOWN["mpl2-form"])] == ["mpl2-form.0", "mpl2-form.1"]


def test_sql(spark, sf_dir):
    check(M.op5_license_scan(spark, sf_dir), connect(sf_dir), oracle_sql()["op5_license_scan"])
