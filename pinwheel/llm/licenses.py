"""License scans: Dice coefficient over word bigrams against license templates, in DataFrame
and SQL expressions only.

A text is normalised (lower case, every run of other characters than a-z and 0-9 one blank).
A template of m words is compared with windows of m words of the text, wherever one begins
with a bigram of the template; the best window counts if its Dice coefficient
2 |A & B| / (|A| + |B|) over sets of word bigrams is at least ``THRESHOLD``. So a notice is found
inside a line, wrapped over lines, or in the middle of prose. Of windows that overlap, the
better one names the license (a notice of the LGPL is near that of the GPL, but not nearest).

Size bounds prune: A has at most as many bigrams as it shares with B, so a match shares at
least |B| t / (2 - t) of B's bigrams (``needed``). A text without any of the template's anchors
(words, longest first, that are in more of its bigrams than a match may miss) can't match; a
text that shares too few bigrams as a whole can't; a window with too few hits can't.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

#: Usual notices, short license texts and the openings of long ones.
_AS_IS_MIT = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
              "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
              "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
              "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_MIT_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
              "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
              "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
              "Software is furnished to do so, subject to the following conditions:")
_MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_BSD_GRANT = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
              "conditions are met:")
_BSD_TWO = ("1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
            "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
            "disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_THREE = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
              "derived from this software without specific prior written permission.")
_BSD_AS_IS = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
              "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
              "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
              "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
              "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
              "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC_GRANT = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted")
_ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
              "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
              "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
              "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_FREE = ("This {0} is free software: you can redistribute it and/or modify it under the terms of the {1} as published by the Free Software "
         "Foundation, either version {2} of the License, or (at your option) any later version.")
_HOPE = ("This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
         "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {1} for more details.")
_GPL, _LGPL, _AGPL = "GNU General Public License", "GNU Lesser General Public License", "GNU Affero General Public License"
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                   "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                   "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
                   "specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND "
                   "DISTRIBUTION"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "licensed under the MIT License"),
    ("MIT", _MIT_GRANT),
    ("MIT", _MIT_NOTICE),
    ("MIT", _AS_IS_MIT),
    ("MIT", " ".join((_MIT_GRANT, _MIT_NOTICE, _AS_IS_MIT))),
    ("BSD", _BSD_GRANT),
    ("BSD", "licensed under the BSD License"),
    ("BSD", _BSD_AS_IS),
    ("BSD-2-Clause", " ".join((_BSD_GRANT, _BSD_TWO, _BSD_AS_IS))),
    ("BSD-3-Clause", _BSD_THREE),
    ("BSD-3-Clause", " ".join((_BSD_GRANT, _BSD_TWO, _BSD_THREE, _BSD_AS_IS))),
    ("BSD-2-Clause", "licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause", "licensed under the BSD 3-Clause License"),
    ("ISC", _ISC_GRANT + _ISC_NOTICE),
    ("ISC", _ISC_AS_IS),
    ("ISC", " ".join((_ISC_GRANT + _ISC_NOTICE, _ISC_AS_IS))),
    ("0BSD", " ".join((_ISC_GRANT, _ISC_AS_IS))),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL", _FREE.format("program", _GPL, "3")),
    ("GPL", _FREE.format("program", _GPL, "2").replace(":", ";")),
    ("GPL", _HOPE.format("program", _GPL)),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL", _FREE.format("library", _LGPL, "2.1")),
    ("LGPL", _FREE.format("program", _LGPL, "3")),
    ("LGPL", _HOPE.format("library", _LGPL)),
    ("LGPL", "licensed under the GNU Lesser General Public License"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("AGPL-3.0", _FREE.format("program", _AGPL, "3")),
    ("AGPL-3.0", _HOPE.format("program", _AGPL)),
    ("AGPL-3.0", "licensed under the GNU Affero General Public License"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
                "available at https://www.eclipse.org/legal/epl-2.0/"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
             "any damages arising from the use of this software."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def template_bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a template, normalised as texts are."""
    words = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def needed(size: int, threshold: float) -> int:
    """How many of a template's ``size`` bigrams a window must have to reach the threshold."""
    return max(1, math.ceil(size * threshold / (2 - threshold) - 1e-9))


def anchors(text: str, threshold: float) -> list[str]:
    """Words of a template, one of which every matching window has: together they are in more of
    its bigrams than a match can do without. Longer words, which are rarer, come first."""
    grams = template_bigrams(text)
    missing, chosen = len(grams) - needed(len(grams), threshold), []
    for word in sorted({w for g in grams for w in g.split()}, key=lambda w: (-len(w), w)):
        if sum(any(w in chosen for w in g.split()) for g in grams) > missing:
            break
        chosen.append(word)
    return chosen


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _let(value: str, name: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def license_matches(df: DataFrame, text_col: str = "text", out_col: str = "matches", templates=TEMPLATES,
                    threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``out_col`` array<struct<license, dice, at, len>>: the best window (first word,
    words) of every template that matches and isn't overlapped by a better one, in the order of
    ``templates`` (a column of that name is replaced). Better is a higher Dice coefficient, then
    more words, then the earlier template.

    A null or empty text matches nothing. Rows are treated alone; no shuffle.
    """
    listed, first = [], set()
    for k, (name, text) in enumerate(templates):
        grams = template_bigrams(text)
        if grams:
            first.update(anchors(text, threshold))
            listed.append(f"named_struct('license', {_text(name)}, 'k', {k}, 'grams', array({', '.join(map(_text, grams))}), 'n', {len(grams)}, "
                          f"'need', {needed(len(grams), threshold)}, 'len', {len(words_of(text))})")
    none = "CAST(array() AS array<struct<license:string,k:int,dice:double,at:int,len:int>>)"
    window = _let("array_distinct(slice(g, p[j] + 1, t.len - 1))", "x",
                  "named_struct('d', -2.0D * size(array_intersect(x, t.grams)) / (size(x) + t.n), 'at', p[j])")
    full = "filter(sequence(0, size(p) - t.need), j -> p[j + t.need - 1] - p[j] < t.len - 1)"
    best = _let("filter(sequence(0, size(g) - 1), i -> array_contains(t.grams, g[i]))", "p",
                f"CASE WHEN size(p) >= t.need THEN array_min(transform({full}, j -> {window})) END")
    found = (f"filter(transform(filter(array({', '.join(listed)}), t -> size(array_intersect(d, t.grams)) >= t.need), "
             f"t -> {_let(best, 'b', 'named_struct(' + chr(39) + 'license' + chr(39) + ', t.license, ' + chr(39) + 'k' + chr(39) + ', t.k, ' + chr(39) + 'dice' + chr(39) + ', -b.d, ' + chr(39) + 'at' + chr(39) + ', b.at, ' + chr(39) + 'len' + chr(39) + ', t.len)')}), "
             f"m -> m.dice >= {threshold!r}D)")
    better = "o.dice > m.dice OR (o.dice = m.dice AND (o.len > m.len OR (o.len = m.len AND o.k < m.k)))"
    kept = f"filter(f, m -> NOT exists(f, o -> o.at < m.at + m.len AND m.at < o.at + o.len AND ({better})))"
    bigrams = "transform(sequence(1, size(w) - 1), i -> concat(w[i - 1], ' ', w[i]))"
    scan = _let(bigrams, "g", _let("array_distinct(g)", "d", _let(found, "f", kept)))
    names = [c for c in df.columns if c != out_col]
    normal = F.regexp_replace(F.lower(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))), "[^a-z0-9]+", " ")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.split(F.trim(normal), " ").alias("w"))
    maybe = f"arrays_overlap(w, array({', '.join(map(_text, sorted(first)))}))"
    matches = F.expr(f"CASE WHEN size(w) > 1 AND {maybe} THEN {scan} ELSE {none} END" if listed else none)
    shown = F.transform(matches, lambda m: F.struct(m["license"].alias("license"), m["dice"].alias("dice"), m["at"].alias("at"), m["len"].alias("len")))
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in names], shown.alias(out_col))


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_matches, license and dice of the best match (null and 0 without one; ties: the
    first name), licenses (all names found, sorted, joined by commas)."""
    out = license_matches(docs.select("doc_id", "text"))
    best = F.expr("CASE WHEN size(matches) > 0 THEN array_min(transform(matches, m -> named_struct('d', -m.dice, 'license', m.license))) END")
    out = out.withColumn("best", best)
    return out.select("doc_id", F.size("matches").cast("long").alias("n_matches"), F.col("best.license").alias("license"),
                      F.coalesce(-F.col("best.d"), F.lit(0.0)).alias("dice"),
                      F.expr("array_join(array_sort(array_distinct(transform(matches, m -> m.license))), ',')").alias("licenses"))


def oracle_sql() -> str:
    """The rows of ``license_scan`` over ``documents``, for DuckDB."""
    grams = [(k, name, template_bigrams(t), len(words_of(t))) for k, (name, t) in enumerate(TEMPLATES)]
    values = ", ".join(f"({k}, {_text(n)}, {len(g)}, {needed(len(g), THRESHOLD)}, {m}, [{', '.join(map(_text, g))}])" for k, n, g, m in grams)
    return f"""
WITH tpl(tid, license, n, need, len, grams) AS (VALUES {values}),
tg AS (SELECT tid, unnest(grams) AS gram FROM tpl),
d AS (SELECT row_number() OVER () AS rid, doc_id,
      string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM documents),
g AS (SELECT rid, i - 1 AS pos, w[i] || ' ' || w[i + 1] AS gram FROM (SELECT rid, w, unnest(range(1, len(w))) AS i FROM d)),
h AS (SELECT g.rid, tg.tid, g.pos, g.gram FROM g JOIN tg ON tg.gram = g.gram),
c AS (SELECT rid, tid FROM h JOIN tpl USING (tid) GROUP BY rid, tid, need HAVING count(DISTINCT gram) >= need),
v AS (SELECT h.rid, h.tid, h.pos AS first, count(DISTINCT g.gram) AS size, count(DISTINCT g.gram) FILTER (list_contains(tpl.grams, g.gram)) AS shared
      FROM c JOIN h USING (rid, tid) JOIN tpl USING (tid) JOIN g ON g.rid = h.rid AND g.pos BETWEEN h.pos AND h.pos + tpl.len - 2
      GROUP BY h.rid, h.tid, h.pos),
s AS (SELECT rid, tid, license, len, first, 2.0::DOUBLE * shared / (size + n) AS dice FROM v JOIN tpl USING (tid)
      QUALIFY row_number() OVER (PARTITION BY rid, tid ORDER BY 2.0::DOUBLE * shared / (size + n) DESC, first) = 1),
m AS (SELECT * FROM s WHERE dice >= {THRESHOLD!r}::DOUBLE),
z AS (SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.rid = m.rid AND o.first < m.first + m.len AND m.first < o.first + o.len
      AND (o.dice > m.dice OR (o.dice = m.dice AND (o.len > m.len OR (o.len = m.len AND o.tid < m.tid)))))),
k AS (SELECT rid, count(*) AS n, max(dice) AS dice, min_by(license, struct_pack(d := -dice, l := license)) AS license,
      string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM z GROUP BY rid)
SELECT doc_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_matches, k.license, coalesce(k.dice, 0.0)::DOUBLE AS dice, coalesce(k.licenses, '') AS licenses
FROM d LEFT JOIN k USING (rid)"""
