"""License scans: the Dice coefficient over word bigrams (operator 2), in DataFrame functions only.

Units of a text are its lines, its paragraphs (lines between empty ones) and the whole.
Each is normalised (lower case; runs of what is neither letter nor digit are one blank)
and becomes the set of its word bigrams. Dice with a template is twice the common bigrams
over the sum of both sizes. At a Dice of t or more the smaller set has at least t / (2 - t)
of the larger: a unit with too few words for every template makes no bigrams, one with
too few or too many bigrams meets no template, and the others meet the templates within
their bounds.

All is one expression over a document; the templates are literals in it, and nothing is
shuffled.

Defined results: null and empty texts, and texts without a match, have no licences. Of a
unit the best template counts, of ties the first by name; of a text each licence once,
with its best Dice. Repeated rows are each answered; rows with a null id too. Very long
lines are units like others. Other columns are passed through; ``licenses`` is replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_DICE = 0.8

# Notices, bodies and headers by which texts name their licence, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is licensed under the GNU General Public License v3.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright (CC0 1.0 Universal)."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    # Bodies of short licences and standard headers, as one text each.
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software '
        'and associated documentation files (the "Software"), to deal in the Software without '
        'restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        'distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the '
        'Software is furnished to do so, subject to the following conditions: The above copyright notice '
        'and this permission notice shall be included in all copies or substantial portions of the '
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
        'INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE'
        ' AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY '
        'CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING '
        'FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ),
    (
        "BSD-2-Clause",
        'Redistribution and use in source and binary forms, with or without modification, are permitted '
        'provided that the following conditions are met: 1. Redistributions of source code must retain '
        'the above copyright notice, this list of conditions and the following disclaimer. 2. '
        'Redistributions in binary form must reproduce the above copyright notice, this list of '
        'conditions and the following disclaimer in the documentation and/or other materials provided '
        'with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS '
        'IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES'
        ' OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE '
        'COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, '
        'EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE '
        'GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND '
        'ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE'
        ' OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE '
        'POSSIBILITY OF SUCH DAMAGE.',
    ),
    (
        "BSD-3-Clause",
        'Redistribution and use in source and binary forms, with or without modification, are permitted '
        'provided that the following conditions are met: 1. Redistributions of source code must retain '
        'the above copyright notice, this list of conditions and the following disclaimer. 2. '
        'Redistributions in binary form must reproduce the above copyright notice, this list of '
        'conditions and the following disclaimer in the documentation and/or other materials provided '
        'with the distribution. 3. Neither the name of the copyright holder nor the names of its '
        'contributors may be used to endorse or promote products derived from this software without '
        'specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND '
        'CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
        'IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO'
        ' EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, '
        'INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, '
        'PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS '
        'INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT '
        'LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS'
        ' SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    ),
    (
        "ISC",
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without'
        ' fee is hereby granted, provided that the above copyright notice and this permission notice '
        'appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES '
        'WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN'
        ' NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES'
        ' OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF '
        'CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR '
        'PERFORMANCE OF THIS SOFTWARE.',
    ),
    (
        "GPL-3.0",
        'This program is free software: you can redistribute it and/or modify it under the terms of the '
        'GNU General Public License as published by the Free Software Foundation, either version 3 of the'
        ' License, or (at your option) any later version. This program is distributed in the hope that it'
        ' will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY '
        'or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You '
        'should have received a copy of the GNU General Public License along with this program. If not, '
        'see <https://www.gnu.org/licenses/>.',
    ),
    (
        "GPL-2.0",
        'This program is free software: you can redistribute it and/or modify it under the terms of the '
        'GNU General Public License as published by the Free Software Foundation, either version 2 of the'
        ' License, or (at your option) any later version. This program is distributed in the hope that it'
        ' will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY '
        'or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You '
        'should have received a copy of the GNU General Public License along with this program. If not, '
        'see <https://www.gnu.org/licenses/>.',
    ),
    (
        "AGPL-3.0",
        'This program is free software: you can redistribute it and/or modify it under the terms of the '
        'GNU Affero General Public License as published by the Free Software Foundation, either version 3'
        ' of the License, or (at your option) any later version. This program is distributed in the hope '
        'that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of '
        'MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License '
        'for more details. You should have received a copy of the GNU Affero General Public License along'
        ' with this program. If not, see <https://www.gnu.org/licenses/>.',
    ),
    (
        "LGPL-3.0",
        'This program is free software: you can redistribute it and/or modify it under the terms of the '
        'GNU Lesser General Public License as published by the Free Software Foundation, either version 3'
        ' of the License, or (at your option) any later version. This program is distributed in the hope '
        'that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of '
        'MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License '
        'for more details. You should have received a copy of the GNU Lesser General Public License along'
        ' with this program. If not, see <https://www.gnu.org/licenses/>.',
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except'
        ' in compliance with the License. You may obtain a copy of the License at '
        'http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in '
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        'WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        'specific language governing permissions and limitations under the License.',
    ),
    (
        "MPL-2.0",
        'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy '
        'of the MPL was not distributed with this file, You can obtain one at '
        'https://mozilla.org/MPL/2.0/.',
    ),
)


def normal(text: Column) -> Column:
    """Lower case; what is neither letter nor digit is one blank, and none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def template_bigrams(listed=TEMPLATES) -> list[tuple[str, int, list[str]]]:
    """(license, number, bigrams) of the templates with two words or more; ASCII text."""
    out = []
    for number, (name, text) in enumerate(listed):
        words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
        if bigrams := sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}):
            out.append((name, number, bigrams))
    return out


def _bigrams(words: Column) -> Column:
    rest = F.size(words) - 1
    return F.array_distinct(
        F.zip_with(F.slice(words, F.lit(1), rest), F.slice(words, F.lit(2), rest), lambda a, b: F.concat_ws(" ", a, b))
    )


def _units(text: Column) -> Column:
    """Array of (kind, number, text); what would be the same unit again is left out."""

    def unit(kind: str, number: Column, part: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), number.cast("int").alias("number"), part.alias("text"))

    lines = F.split(text, "\n")
    paragraphs = F.split(text, "\n[ \t\r]*\n")
    none = F.array().cast("array<struct<kind: string, number: int, text: string>>")
    return F.concat(
        F.transform(lines, lambda x, i: unit("line", i, x)),
        F.when(F.size(paragraphs) > 1, F.transform(paragraphs, lambda x, i: unit("paragraph", i, x))).otherwise(none),
        F.when(F.size(lines) > 1, F.array(unit("text", F.lit(0), text))).otherwise(none),
    )


def licenses_of(text: Column, listed=TEMPLATES, least_dice: float = LEAST_DICE) -> Column:
    """Array of (license, permille, template, kind, number) by name, each licence once.

    ``permille`` is a thousand times Dice, rounded down.
    """
    entries = template_bigrams(listed)
    ratio = least_dice / (2 - least_dice)
    low = min(len(b) for *_, b in entries) * ratio
    high = max(len(b) for *_, b in entries) / ratio
    templates = F.array(
        *(
            F.struct(
                F.lit(name).alias("license"),
                F.lit(number).alias("template"),
                F.lit(len(bigrams)).alias("size"),
                F.array(*map(F.lit, bigrams)).alias("bigrams"),
            )
            for name, number, bigrams in entries
        )
    )
    all_bigrams = F.array(*map(F.lit, sorted({b for *_, bigrams in entries for b in bigrams})))

    def with_field(unit: Column, name: str, value: Column) -> Column:
        return F.struct(unit["kind"].alias("kind"), unit["number"].alias("number"), value.alias(name))

    split = F.transform(_units(F.coalesce(text, F.lit(""))), lambda u: with_field(u, "words", F.split(normal(u["text"]), " ")))
    large = F.filter(split, lambda u: F.size(u["words"]) - 1 >= F.lit(max(low, 1.0)))
    sets = F.transform(large, lambda u: with_field(u, "bigrams", _bigrams(u["words"])))
    near = F.filter(
        sets,
        lambda u: F.size(u["bigrams"]).between(F.lit(low), F.lit(high)) & F.arrays_overlap(u["bigrams"], all_bigrams),
    )

    def met(unit: Column) -> Column:
        """(license, permille, …) of the templates within the unit's bounds."""
        n = F.size(unit["bigrams"])
        within = F.filter(templates, lambda t: (n >= t["size"] * ratio) & (n <= t["size"] / ratio))
        return F.transform(
            within,
            lambda t: F.struct(
                t["license"].alias("license"),
                F.floor(F.lit(2000) * F.size(F.array_intersect(unit["bigrams"], t["bigrams"])) / (n + t["size"])).cast("int").alias("permille"),
                t["template"].alias("template"),
                unit["kind"].alias("kind"),
                unit["number"].alias("number"),
            ),
        )

    matches = F.filter(F.flatten(F.transform(near, met)), lambda m: m["permille"] >= F.lit(least_dice * 1000))
    # A unit's best template, and of a licence's units the best and first.
    def better(a: Column, b: Column) -> Column:
        return (a["permille"] > b["permille"]) | (
            (a["permille"] == b["permille"]) & ((a["license"] < b["license"]) | ((a["license"] == b["license"]) & (a["template"] < b["template"])))
        )

    best = F.filter(
        matches,
        lambda m: ~F.exists(matches, lambda o: (o["kind"] == m["kind"]) & (o["number"] == m["number"]) & better(o, m)),
    )
    once = F.filter(
        best,
        lambda m: ~F.exists(
            best,
            lambda o: (o["license"] == m["license"])
            & (
                (o["permille"] > m["permille"])
                | ((o["permille"] == m["permille"]) & (F.struct(o["kind"], o["number"], o["template"]) < F.struct(m["kind"], m["number"], m["template"])))
            ),
        ),
    )
    return F.array_sort(once)


def scan_licenses(docs: DataFrame, listed=TEMPLATES, least_dice: float = LEAST_DICE) -> DataFrame:
    """Documents with ``licenses``, as ``licenses_of`` gives them for ``text``."""
    return docs.drop("licenses").withColumn("licenses", licenses_of(F.col("text"), listed, least_dice))


def oracle(listed=TEMPLATES, least_dice: float = LEAST_DICE) -> str:
    """DuckDB SQL for (doc_id, licenses, n_licenses, best_permille) of ``documents``."""
    values = ", ".join(f"('{name}', {number}, '{text.replace(chr(39), chr(39) * 2)}')" for number, (name, text) in enumerate(listed))
    bigrams = "list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))])"
    normal_sql = "trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))".replace("\\\\", "\\")
    return f"""
WITH listed (license, template, notice) AS (VALUES {values}),
templates AS (
  SELECT license, template, {bigrams} AS b
  FROM (SELECT license, template, string_split({normal_sql.format('notice')}, ' ') AS w FROM listed)),
numbered AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT r, string_split(text, chr(10)) AS l, text FROM numbered),
units AS (
  SELECT r, 'line' AS kind, unnest(range(0, len(l))) AS number, unnest(l) AS u FROM lines
  UNION ALL
  SELECT r, 'paragraph', unnest(range(0, len(p))), unnest(p)
  FROM (SELECT r, string_split_regex(text, '\n[ \t\r]*\n') AS p FROM numbered) WHERE len(p) > 1
  UNION ALL
  SELECT r, 'text', 0, text FROM lines WHERE len(l) > 1),
sets AS (
  SELECT r, kind, number, {bigrams} AS b
  FROM (SELECT r, kind, number, string_split({normal_sql.format('u')}, ' ') AS w FROM units)
  WHERE len(w) >= 2),
met AS (
  SELECT r, kind, number, license, template,
    (2000 * len(list_intersect(sets.b, templates.b))) // (len(sets.b) + len(templates.b)) AS permille
  FROM sets JOIN templates ON len(sets.b) <= 3 * len(templates.b) AND list_has_any(sets.b, templates.b)),
best AS (
  SELECT *, row_number() OVER (PARTITION BY r, kind, number ORDER BY permille DESC, license, template) AS place
  FROM met WHERE permille >= {round(least_dice * 1000)}),
once AS (SELECT r, license, max(permille) AS permille FROM best WHERE place = 1 GROUP BY r, license)
SELECT doc_id, coalesce(string_agg(license, ',' ORDER BY license), '') AS licenses,
  count(license) AS n_licenses, coalesce(max(permille), 0)::BIGINT AS best_permille
FROM numbered LEFT JOIN once USING (r) GROUP BY r, doc_id"""
