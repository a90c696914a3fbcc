"""Licence scans: normalised text against licence templates by the Dice coefficient over word bigrams.

Notices of one line are compared with the lines of a text and, when it has several, with the text itself. A unit's number of
words gives its greatest possible number of bigrams, which rules out templates by size before any bigram is built: with a
and b bigrams, Dice is at most 2 min(a, b) / (a + b). Prose lines thus cost one word count.

Notices broken over lines or within a paragraph, and full licence texts, are found in windows of as many words as the
template has, wherever they start and whatever line breaks they hold. The same bound prunes: Dice of d needs at least
d / (2 - d) of the template's bigrams, so a text that holds fewer of them anywhere has no window to look at.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpulse.llm.common import query, table

# Short notices by which texts state their licence.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Use of this source code is governed by the BSD 2-Clause License.",
    "BSD-3-Clause": "Use of this source code is governed by the BSD 3-Clause License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
# Licence texts, without names and years, and the notices that files carry at their head.
TEXTS = {
    "Apache-2.0": """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
        law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
    "BSD-2-Clause": """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
        ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
        LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
        CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
        SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE
        COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
        HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
        (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
        INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
        NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
        DAMAGE.""",
    "GPL-2.0": """
        This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License
        as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "GPL-3.0": """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
        as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "ISC": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
        AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
        AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
        DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
        TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
        shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
        WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
        WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MPL-2.0": """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "Zlib": """
        This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
        for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
        purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but
        is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
        original software. 3. This notice may not be removed or altered from any source distribution.""",
}
LEAST = 0.8


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _bigrams(text: str) -> list[str]:
    w = _words(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def normalised(text: Column) -> Column:
    """Letters A to Z in lower case; what is neither letter nor digit becomes one space."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(lower, r"[^\p{L}\p{N}]+", " "))


def _pairs(words: Column) -> Column:
    """Neighbouring words of an array of two at least, in their order."""
    return F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1)))


def _some(test: Column, value: Column) -> Column:
    """A generator of one row or none, which the planner does not fold into the next step: its value is built once."""
    return F.explode(F.when(test, F.array(value)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None,
         least: float = LEAST, texts: dict[str, str] | None = None) -> DataFrame:
    """One row per document and licence with a Dice of ``least`` or more: doc_id, licence, dice, n_units, n_windows.

    ``dice`` is the best of all units and windows, ``n_units`` the number of lines (and whole texts of several lines) that reach
    ``least`` against the notices ``templates``, ``n_windows`` that of windows against ``templates`` and ``texts``, overlapping
    ones included. A window starts at a word pair of the template and has as many words as the template, fewer only at the
    text's end. NULL and empty texts and units of fewer than two words
    match nothing; documents without a match have no row. A unit may match several licences, ties included. Rows that
    repeat an id count together, NULL ids too. Other columns are not read. ``templates`` and ``texts`` are parameters of a few
    hundred entries at most, sent with the plan; a name may be in both.
    """
    notices = [(name, text) for name, text in sorted((TEMPLATES if templates is None else templates).items()) if _bigrams(text)]
    more = TEXTS if texts is None and templates is None else texts or {}
    known = notices + [(name, text) for name, text in sorted(more.items()) if _bigrams(text)]
    if not known:
        return docs.select(F.col(id_col), F.lit("").alias("licence"), F.lit(0.0).alias("dice"), F.lit(0).cast("long").alias("n_units"),
                           F.lit(0).cast("long").alias("n_windows")).filter("false")
    found = _windows(docs, id_col, text_col, known, least)
    if notices:
        found = found.unionByName(_units(docs, id_col, text_col, notices, least))
    return (found.groupBy(F.col("id").alias(id_col), "licence")
            .agg(F.max("dice").alias("dice"), F.sum("n_units").alias("n_units"), F.sum("n_windows").alias("n_windows")))


def _windows(docs: DataFrame, id_col: str, text_col: str, known: list[tuple[str, str]], least: float) -> DataFrame:
    """id, licence, dice, n_units (0), n_windows of documents with windows that reach ``least``."""
    fits = least / (2 - least)
    sets = [(name, _bigrams(text), len(_words(text))) for name, text in known]
    every = F.array(*map(F.lit, sorted({g for _, grams, _ in sets for g in grams})))
    templates = F.array(*[F.struct(F.lit(name).alias("licence"), F.array(*map(F.lit, grams)).alias("grams"), F.lit(n).alias("n"))
                          for name, grams, n in sets])
    fewest = min(len(grams) for _, grams, _ in sets) * fits
    text = docs.select(F.col(id_col).alias("id"), _some(F.length(text_col) > 2 * fewest, F.split(normalised(F.col(text_col)), " ")).alias("w"))
    pairs = text.select("id", _some(F.size("w") > 1, _pairs(F.col("w"))).alias("pairs"))
    pairs = pairs.select("id", "pairs", _some(F.lit(True), F.array_intersect("pairs", every)).alias("seen"))
    held = F.filter(templates, lambda t: F.size(F.array_intersect(t["grams"], F.col("seen"))) >= F.size(t["grams"]) * fits - 1e-9)
    asked = pairs.filter(F.size("seen") >= fewest - 1e-9).select("id", "pairs", F.explode(held).alias("t"))
    grams = F.col("t.grams")
    starts = F.filter(F.sequence(F.lit(1), F.size("pairs")), lambda i: F.array_contains(grams, F.element_at("pairs", i)))
    asked = asked.select("id", "t", "pairs", _some(F.lit(True), starts).alias("starts"))

    def dice(i):
        window = F.slice("pairs", i, F.col("t.n") - 1)
        return 2.0 * F.size(F.array_intersect(window, grams)) / (F.size(F.array_distinct(window)) + F.size(grams))

    good = F.filter(F.transform("starts", dice), lambda d: d >= least)
    return (asked.select("id", "t.licence", _some(F.lit(True), good).alias("good")).filter(F.size("good") > 0)
            .select("id", "licence", F.array_max("good").alias("dice"), F.lit(0).cast("long").alias("n_units"),
                    F.size("good").cast("long").alias("n_windows")))


def _units(docs: DataFrame, id_col: str, text_col: str, notices: list[tuple[str, str]], least: float) -> DataFrame:
    """id, licence, dice, n_units, n_windows (0) of lines, and texts of several lines, that reach ``least``."""
    sets = {name: _bigrams(text) for name, text in notices}
    fits = least / (2 - least)
    shortest = min(map(len, sets.values())) * fits
    known = F.array(*[F.struct(F.lit(name).alias("licence"), F.array(*map(F.lit, grams)).alias("grams")) for name, grams in sets.items()])
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), r"\n")
    whole = F.when(F.size(lines) > 1, F.array(F.col(text_col))).otherwise(F.array().cast("array<string>"))
    unit = docs.select(F.col(id_col).alias("id"), F.explode(F.concat(lines, whole)).alias("unit"))
    # Bigrams are fewer than half the characters; n distinct words make n - 1 distinct bigrams at least.
    longest = max(map(len, sets.values())) / fits
    unit = unit.select("id", _some(F.length("unit") > 2 * shortest, F.split(normalised(F.col("unit")), " ")).alias("w"))
    few = F.when(F.size("w") <= longest + 1, True).otherwise(F.size(F.array_distinct("w")) <= longest + 1)
    unit = unit.select("id", _some((F.size("w") > max(1, shortest)) & few, F.array_distinct(_pairs(F.col("w")))).alias("grams"))
    size = F.size("grams")
    near = F.filter(known, lambda t: (F.size(t["grams"]) >= size * fits) & (F.size(t["grams"]) * fits <= size))
    scored = F.transform(near, lambda t: F.struct(t["licence"].alias("licence"), (
        2.0 * F.size(F.array_intersect(t["grams"], F.col("grams"))) / (F.size(t["grams"]) + size)).alias("dice")))
    found = unit.select("id", F.explode(F.filter(scored, lambda s: s["dice"] >= least)).alias("s"))
    return found.select("id", "s.licence", "s.dice", F.lit(1).cast("long").alias("n_units"), F.lit(0).cast("long").alias("n_windows"))


def _oracle() -> str:
    def listed(pairs):
        return ", ".join(f"('{n}', [{', '.join(repr(g) for g in _bigrams(t))}], {len(_words(t))})" for n, t in pairs)

    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    split = rf"string_split(trim(regexp_replace({lower}, '[^\p{{{{L}}}}\p{{{{N}}}}]+', ' ', 'g')), ' ')"
    return rf"""
    WITH known(licence, k, n) AS (VALUES {listed(sorted(TEMPLATES.items()))}),
    texts(licence, k, n) AS (SELECT * FROM known UNION ALL VALUES {listed(sorted(TEXTS.items()))}),
    lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS unit FROM documents
        UNION ALL SELECT doc_id, text FROM documents WHERE contains(text, chr(10))),
    w AS (SELECT doc_id, {split.format('unit')} AS w FROM lines),
    g AS (
        SELECT doc_id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
        FROM w WHERE len(w) > 1),
    u AS (SELECT doc_id, licence, 2.0::DOUBLE * len(list_intersect(g, k)) / (len(g) + len(k)) AS dice, 1 AS n_units, 0 AS n_windows
        FROM g, known),
    d AS (SELECT doc_id, {split.format('text')} AS w FROM documents),
    p AS (SELECT doc_id, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS p FROM d WHERE len(w) > 1),
    a AS (SELECT doc_id, licence, k, n, p FROM p, texts WHERE 2 * len(list_intersect(p, k)) >= len(k)),
    v AS (
        SELECT doc_id, licence, k, unnest(list_transform(list_filter(range(1, len(p) + 1), lambda i: list_contains(k, p[i])),
            lambda i: p[i:i + n - 2])) AS p FROM a),
    x AS (
        SELECT doc_id, licence, 2.0::DOUBLE * len(list_intersect(p, k)) / (len(list_distinct(p)) + len(k)) AS dice,
            0 AS n_units, 1 AS n_windows FROM v)
    SELECT doc_id, licence, max(dice) AS dice, sum(n_units)::BIGINT AS n_units, sum(n_windows)::BIGINT AS n_windows
    FROM (SELECT * FROM u UNION ALL SELECT * FROM x) WHERE dice >= {LEAST} GROUP BY ALL
    """


@query(_oracle())
def op7_licence_scan(spark, sf_dir):
    """Licence notices and texts in all documents."""
    return scan(table(spark, sf_dir, "documents"))
