"""Licence scans by sentence rules.

A text loses the comment signs at the starts of its lines and is cut into sentences at stops (before white space) and at empty
lines.  A sentence is normalised (lower case, other signs than letters and digits become one space) and looked up among the
known licence sentences.  One that isn't known and spans several lines may hold known ones among other lines: all its single lines
are looked up too, and all runs of its lines, wherever they start and end; of runs within runs the longest counts.  The
identifiers found, in the order of their ends, are matched against
ordered rules, the longest first; what a rule has matched counts for no other rule, so that a licence whose text holds that of
another is reported alone.

Known sentences are the real ones: KNOWN holds passages as they stand in licences and notices, cut by the same cut as the texts.
Notices that only name a licence come from templates and names; they and SPDX tags make some 1,350 sentences.

Defined results: null text counts as empty and has no licence; texts of any length are read whole; a licence named twice is
reported once, licences are sorted; one row per input row, repeated ones too; an empty table gives an empty result; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.llm._shared import let, read_table, text_or_empty

# Passages of public licences and their usual notices, and SPDX licence identifiers.
_GPL = "you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published by the Free Software Foundation"
_HOPE = "This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"
KNOWN = {
    "apache2-header": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache2-use": "you may not use this file except in compliance with the License.",
    "apache2-copy": "You may obtain a copy of the License at",
    "apache2-url": "http://www.apache.org/licenses/LICENSE-2.0",
    "apache2-urls": "https://www.apache.org/licenses/LICENSE-2.0",
    "apache2-basis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache2-see": "See the License for the specific language governing permissions and limitations under the License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-asis": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-name-university": "Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-advertising": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-grant-old": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "zero-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "zlib-asis": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "boost-grant": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:',
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "mpl2-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "mpl2-copys": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "epl2-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "wtfpl-0": "You just DO WHAT THE FUCK YOU WANT TO.",
    "gnu-program-free": "This program is free software;",
    "gnu-library-free": "This library is free software;",
    "gpl": _GPL.format("") + ";",
    "lgpl": _GPL.format("Lesser ") + ";",
    "agpl": _GPL.format("Affero ") + ";",
    "gnu-hope-program": _HOPE.format("program"),
    "gnu-hope-library": _HOPE.format("library"),
    "gnu-fitness": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gnu-either-2": "either version 2 of the License, or (at your option) any later version.",
    "gnu-either-2.1": "either version 2.1 of the License, or (at your option) any later version.",
    "gnu-either-3": "either version 3 of the License, or (at your option) any later version.",
    "spdx-tag": "SPDX-License-Identifier:",
}
for _name, _kind, _versions in (("gpl", "", ("2", "3")), ("lgpl", "Lesser ", ("2.1", "3")), ("agpl", "Affero ", ("3",))):
    for _v in _versions:
        KNOWN[f"{_name}-{_v}-later"] = _GPL.format(_kind) + f", either version {_v} of the License, or (at your option) any later version."
        KNOWN[f"{_name}-{_v}-only"] = "you can redistribute it and/or modify it under the terms of the GNU {0}General Public License version {1} as published by the Free Software Foundation.".format(_kind, _v)
        KNOWN[f"{_name}-{_v}-only-comma"] = _GPL.format(_kind) + f", version {_v} of the License."
#: (licence, passages in order); other known sentences may not stand between them.
RULES = [
    ("Apache-2.0", ("apache2-header", "apache2-use", "apache2-copy", "apache2-url", "apache2-basis", "apache2-see")),
    ("Apache-2.0", ("apache2-header", "apache2-use", "apache2-copy", "apache2-urls", "apache2-basis", "apache2-see")),
    ("Apache-2.0", ("apache2-use", "apache2-copy", "apache2-url")), ("Apache-2.0", ("apache2-use", "apache2-copy", "apache2-urls")),
    ("Apache-2.0", ("apache2-header",)),
    ("MIT", ("mit-grant", "mit-condition", "mit-asis", "mit-liability")), ("MIT", ("mit-grant", "mit-condition")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-name-university")),
    ("BSD-4-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-name")),
    ("BSD-4-Clause-UC", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-name-university")),
    ("ISC", ("isc-grant",)), ("ISC", ("isc-grant-old",)), ("0BSD", ("zero-grant",)), ("Zlib", ("zlib-asis", "zlib-grant")), ("Zlib", ("zlib-grant",)),
    ("BSL-1.0", ("boost-grant",)), ("Unlicense", ("unlicense-free", "unlicense-anyone")), ("Unlicense", ("unlicense-free",)),
    ("MPL-2.0", ("mpl2-form", "mpl2-copy")), ("MPL-2.0", ("mpl2-form", "mpl2-copys")), ("MPL-2.0", ("mpl2-form",)), ("EPL-2.0", ("epl2-terms",)), ("WTFPL", ("wtfpl-0",)),
    ("GPL-2.0-or-later", ("gpl", "gnu-either-2")), ("GPL-3.0-or-later", ("gpl", "gnu-either-3")),
    ("LGPL-2.1-or-later", ("lgpl", "gnu-either-2.1")), ("LGPL-3.0-or-later", ("lgpl", "gnu-either-3")), ("AGPL-3.0-or-later", ("agpl", "gnu-either-3")),
]
for _name, _spdx in (("gpl-2", "GPL-2.0"), ("gpl-3", "GPL-3.0"), ("lgpl-2.1", "LGPL-2.1"), ("lgpl-3", "LGPL-3.0"), ("agpl-3", "AGPL-3.0")):
    RULES += [(f"{_spdx}-or-later", (f"{_name}-later",)), (f"{_spdx}-only", (f"{_name}-only",)), (f"{_spdx}-only", (f"{_name}-only-comma",))]
#: SPDX identifier -> names that notices use.
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 License", "Apache 2.0 License"),
    "MIT": ("MIT License", "MIT", "Expat License"), "ISC": ("ISC License",), "Unlicense": ("Unlicense",), "Zlib": ("zlib License",), "0BSD": ("Zero-Clause BSD License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "EPL-1.0": ("Eclipse Public License 1.0", "Eclipse Public License v1.0"), "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v2.0"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"), "Artistic-2.0": ("Artistic License 2.0",), "PostgreSQL": ("PostgreSQL License",),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"), "WTFPL": ("WTFPL",), "OFL-1.1": ("SIL Open Font License, Version 1.1", "SIL Open Font License 1.1"),
}
for _kind, _short, _versions in (("", "GPL", ("2", "3")), ("Lesser ", "LGPL", ("2.1", "3")), ("Affero ", "AGPL", ("3",))):
    for _v in _versions:
        _long = f"GNU {_kind}General Public License"
        _full = _v if "." in _v else f"{_v}.0"
        NAMES[f"{_short}-{_full}-only"] = tuple(dict.fromkeys((f"{_long}, version {_v}", f"{_long}, version {_full}", f"{_long} v{_v}", f"{_long} v{_full}", f"GNU {_short} version {_v}", f"GNU {_short} v{_v}", f"{_short}v{_v}", f"{_short}-{_full}")))
for _letters, _words in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    for _v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        _area = {"3.0": "Unported", "4.0": "International"}.get(_v, "Generic")
        NAMES[f"CC-{_letters}-{_v}"] = (f"CC {_letters} {_v}", f"Creative Commons {_words} {_v} License", f"Creative Commons {_words} {_v} {_area} License")
TEMPLATES = ("Licensed under {}", "Licensed under the {}", "Released under the {}", "Distributed under the {}", "This work is licensed under {}", "This work is licensed under the {}", "This work is licensed under a {}", "This project is licensed under the {}")
#: Words of a known sentence at most; OP5_SQL also looks at so many last lines of a sentence only.
LINES = 128

COMMENT = r"^[\x20\x09]*(//+|#+|/?\*+/?|;+|--+|%+|<!--)[\x20\x09]*"
STOP = r"""[.;:!?]+[)"']*([\x20\x09-\x0D])"""
EMPTY = r"\n[\x20\x09\x0B-\x0D]*\n"
CUT = "\u0002"


def normal(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def cut(passage: str) -> list[str]:
    """The normalised sentences of a passage without empty lines or comment signs."""
    return [x for x in map(normal, re.sub(STOP, CUT + r"\1", passage).split(CUT)) if x]


def known(passages: dict = KNOWN, names: dict = NAMES, rules=RULES) -> tuple[dict[str, str], list[tuple[str, tuple]]]:
    """Normalised sentence -> identifier, and the rules over identifiers, the longest first."""
    table, parts = {}, {}
    for name, passage in passages.items():
        pieces = cut(passage)
        parts[name] = [table.setdefault(p, name if len(pieces) == 1 else f"{name}.{k}") for k, p in enumerate(pieces)]
        if any(len(p.split()) > LINES for p in pieces):
            raise ValueError(f"a sentence of {name} has over {LINES} words")
    out = [(licence, tuple(p for name in sequence for p in parts[name])) for licence, sequence in rules]
    for spdx, own in names.items():
        for name in own:
            for template in TEMPLATES:
                pieces = cut(template.format(name))
                if len(pieces) != 1:
                    raise ValueError(f"the notice of {name} is cut")
                table.setdefault(pieces[0], f"{spdx}-notice")
        out.append((spdx, (f"{spdx}-notice",)))
        if "spdx-tag" in parts:
            tag = table.setdefault(normal(spdx), f"spdx:{spdx}")
            out.append((spdx, (parts["spdx-tag"][0], tag)))
    return table, sorted(dict.fromkeys(out), key=lambda r: (-len(r[1]), r))


def _in_jvm(values: list[str]):
    """The strings as a list of the JVM: Column.isin would send each of them again wherever it is used."""
    from py4j.java_collections import ListConverter
    from pyspark import SparkContext

    return ListConverter().convert(values, SparkContext._active_spark_context._gateway._gateway_client)


def _sentences(text: Column, table: dict[str, str]) -> Column:
    """The known sentences of a text, in order."""
    bare = F.regexp_replace(text, "(?md)" + COMMENT, "")
    marked = F.regexp_replace(F.regexp_replace(bare, STOP, CUT + "$1"), EMPTY, CUT)
    clean = lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))
    words = [x.split() for x in table]
    most = max([2, *map(len, words)])  # no run of more lines is known: each has a word
    known_ones, begun = _in_jvm(list(table)), _in_jvm(sorted({" ".join(x[:n]) for x in words for n in range(1, len(x) + 1)}))
    is_known = lambda s: type(s)(s._jc.isInCollection(known_ones))
    begins = lambda s: type(s)(s._jc.isInCollection(begun))
    none = F.array().cast("array<string>")
    hit = lambda at, run, s: F.struct(at.cast("int").alias("at"), F.lit(run).alias("run"), s.alias("s"))

    def of_lines(lines):
        line = lambda k: F.element_at(lines, k)
        two = lambda a, b: F.concat(a, F.lit(" "), b)

        def longest(k):
            """The longest known run of lines from line k on; null if there is none."""

            def step(a, x):
                at = a["at"] + 1
                more = lambda s: F.struct(F.when(begins(s), s).alias("s"), at.alias("at"), F.when(is_known(s), hit(at, 1, s)).otherwise(a["hit"]).alias("hit"))
                return F.when(a["s"].isNull(), a).otherwise(let(two(a["s"], x), more))

            start = F.struct(line(k).alias("s"), k.alias("at"), F.lit(None).cast("struct<at:int,run:int,s:string>").alias("hit"))
            return F.aggregate(F.slice(lines, k + 1, most - 1), start, step, lambda a: a["hit"])

        def outermost(runs):
            """Runs in no longer one, which would start at one of the most - 2 lines before."""
            before = lambda k: F.slice(runs, F.greatest(F.lit(1), k - most + 3), F.least(k, F.lit(most - 2)))
            return F.filter(runs, lambda r, k: ~F.exists(before(k), lambda x: x["at"] >= r["at"]))

        def merged(runs):
            single = F.filter(F.transform(lines, lambda s, k: F.when(is_known(s), hit(k + 1, 0, s))), lambda x: x.isNotNull())
            return F.transform(F.array_sort(F.concat(single, outermost(runs))), lambda x: x["s"])

        starts = F.filter(F.sequence(F.lit(1), F.size(lines) - 1), lambda k: begins(line(k)) & begins(two(line(k), line(k + 1))))
        runs = F.filter(F.transform(starts, longest), lambda x: x.isNotNull())
        some = lambda found: F.when(F.size(found) > 0, merged(found)).otherwise(F.filter(lines, is_known))
        return F.when(F.size(lines) > 2, let(runs, some)).otherwise(F.filter(lines, is_known))

    def of(s):
        lines = F.filter(F.transform(F.split(s, "\n"), clean), lambda x: x != "")
        one = lambda c: F.when(is_known(c), F.array(c)).when(F.contains(F.trim(s), F.lit("\n")), let(lines, of_lines)).otherwise(none)
        return let(clean(s), one)

    return F.flatten(F.transform(F.split(marked, CUT), of))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passages: dict = KNOWN, names: dict = NAMES, rules=RULES) -> DataFrame:
    """One row per document: (doc_id, sentence_ids, licenses, n_sentences); lists joined by a space, licences sorted."""
    table, ordered = known(passages, names, rules)
    of = F.expr("map(" + ", ".join(f"'{x}'" for pair in table.items() for x in pair) + ")")  # letters, digits and -.: only
    ids = F.transform(_sentences(text_or_empty(text_col), table), lambda s: of[s])
    found = docs.select(F.col(id_col).alias("doc_id"), ids.alias("ids"))
    # identifiers stand between spaces of their own; what a rule matches becomes =licence
    row = F.concat(F.lit(" "), F.array_join("ids", "  "), F.lit(" "))
    for licence, sequence in ordered:
        row = F.replace(row, F.lit(f" {'  '.join(sequence)} "), F.lit(f" ={licence} "))
    marks = F.when(F.size("ids") > 0, F.filter(F.split(row, " +"), lambda x: x.startswith("="))).otherwise(F.array().cast("array<string>"))
    licenses = F.array_sort(F.array_distinct(F.transform(marks, lambda x: F.substr(x, F.lit(2)))))
    return found.select("doc_id", F.array_join("ids", " ").alias("sentence_ids"), F.array_join(licenses, " ").alias("licenses"), F.size("ids").cast("long").alias("n_sentences"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """Narrower than scan(): of an unknown sentence it looks at the last LINES lines, and only at runs that end with the last."""
    table, ordered = known()
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    words = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in table.items())
    row = "' ' || array_to_string(ids, '  ') || ' '"
    for licence, sequence in ordered:
        row = f"replace({row}, {quote(' ' + '  '.join(sequence) + ' ')}, ' ={licence} ')"
    clean = lambda s: f"trim(regexp_replace(lower({s}), '[^a-z0-9]+', ' ', 'g'))"
    return f"""
WITH k(sentence, id) AS (VALUES {words}),
t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '(?m){COMMENT}', '', 'g') AS t FROM documents),
m AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(t, {quote(STOP)}, chr(2) || '\\1', 'g'), '{EMPTY}', chr(2), 'g'), chr(2)) AS s FROM t),
s AS (SELECT doc_id, unnest(s) AS s, generate_subscripts(s, 1) AS i FROM m),
c AS (SELECT doc_id, i, {clean('s')} AS whole, list_filter(list_transform(string_split(s, chr(10)), lambda x: {clean('x')}), lambda x: x <> '') AS l, contains(trim(s, ' '), chr(10)) AS many FROM s),
l AS (SELECT * REPLACE (l[greatest(1, len(l) - {LINES - 1}):] AS l) FROM c),
w AS (SELECT doc_id, i, 0 AS j, id FROM l JOIN k ON whole = sentence),
o AS (SELECT l.* FROM l ANTI JOIN w USING (doc_id, i) WHERE many),
p AS (SELECT doc_id, i, unnest(l) AS x, generate_subscripts(l, 1) AS j FROM o),
e AS (SELECT doc_id, i, unnest(list_transform(range(2, len(l)), lambda n: array_to_string(l[n:], ' '))) AS x, unnest(range(2, len(l))) AS j FROM o),
h AS (SELECT * FROM w UNION ALL SELECT doc_id, i, j, id FROM p JOIN k ON x = sentence
      UNION ALL SELECT doc_id, i, {LINES + 1} + min(j), arg_min(id, j) FROM e JOIN k ON x = sentence GROUP BY doc_id, i),
g AS (SELECT doc_id, list(id ORDER BY i, j) AS ids FROM h GROUP BY doc_id),
r AS (SELECT doc_id, ids, {row} AS row FROM g)
SELECT d.doc_id, coalesce(array_to_string(ids, ' '), '') AS sentence_ids, coalesce(array_to_string(list_sort(list_distinct(list_transform(list_filter(string_split_regex(row, ' +'), lambda x: starts_with(x, '=')), lambda x: substr(x, 2)))), ' '), '') AS licenses, coalesce(len(ids), 0)::BIGINT AS n_sentences
FROM documents d LEFT JOIN r USING (doc_id)"""


OP5_SQL = _oracle()
