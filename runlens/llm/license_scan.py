"""License scan: a positional rare-token index over licence templates.

Built-in DataFrame functions only.  The index posts, for every template, the
highest-IDF words of its mandatory key phrase (IDF over the template collection):
one map from a word to (template, place in the key phrase) for the rarest word of
each key phrase, one for the next.  A file is scanned in one pass and without a
shuffle:

1. its words are cut out and the positions of indexed words looked up (one hash
   set test a word);
2. the postings of its rarest words, each position less the posted place, give
   (template, relative start); those of the next words are intersected with them,
   all templates at once, and what is left are starts where the postings agree;
3. a start counts when the template's key phrase stands there, word by word,
   whatever stands around it;
4. the share of the template's words found in place gives the coverage; words that
   would stand before the text's first word or after its last are not found.

The phrases of the base contract are templates whose key phrase is the whole
phrase.  The places of all templates are complete.  Templates are short notices
and whole licence texts; a file scores by its best covered one.

Defined results: NULL and empty texts have no words, no labels (empty strings),
score 0 and NULL first/last word; repeated rows give repeated rows; every input
row gives one output row.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Word rule of the contract, after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Its complement: splitting there is about ten times cheaper than extracting.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrase and label of the base contract.
BASE = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: Label, notice text, mandatory key phrase.  Public licence notices.
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache license version 2 0"),
    ("mit", "Released under the MIT License", "mit license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
     "permission is hereby granted free of charge"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3",
     "gnu general public license version 3"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2",
     "gnu general public license version 2"),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License",
     "lesser general public license"),
    ("agpl", "This program is licensed under the GNU Affero General Public License",
     "affero general public license"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc by sa"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0", "cc by nd"),
    ("cc-by-4.0", "Licensed under the Creative Commons Attribution 4.0 International License",
     "creative commons attribution 4 0"),
    ("cc0", "To the extent possible under law the author has waived all copyright and related rights to this work",
     "waived all copyright and related"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted",
     "source and binary forms with or without modification"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     "mozilla public license v 2 0"),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""", "apache license version 2 0"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
     "permission is hereby granted free of charge"),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
     "distribute this software for any purpose with or without fee"),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""", "source and binary forms with or without modification"),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the
following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software. 3. This notice may not be removed or altered from any source
distribution.""", "altered source versions must be plainly marked as such"),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details. You should have received a copy of the GNU General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>.""", "under the terms of the gnu general public license"),
)

#: Highest-IDF words of a key phrase that the index holds.
RARE_WORDS = 2
#: Score of a bare base phrase; a notice scores by its coverage.
BASE_SCORE = 0.5


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]
    key_at: int
    posted: tuple[tuple[str, int], ...]   # (word, its place in the key phrase)
    base: bool


def build_index(notices=NOTICES, base=BASE, rare_words: int = RARE_WORDS) -> list[Template]:
    """Templates with their postings; IDF counts templates, ties go to the
    earlier place."""
    texts = [(label, words_of(p), words_of(p), True) for p, label in base]
    texts += [(label, words_of(text), words_of(key), False) for label, text, key in notices]
    df: dict[str, int] = {}
    for _, ws, _, _ in texts:
        for w in set(ws):
            df[w] = df.get(w, 0) + 1

    def rarest(ws: list[str]) -> tuple[tuple[str, int], ...]:
        first = {w: i for i, w in reversed(list(enumerate(ws)))}
        ranked = sorted(first, key=lambda w: (-math.log(len(texts) / df[w]), first[w]))
        return tuple((w, first[w]) for w in ranked[:rare_words])

    out = []
    for label, ws, key, is_base in texts:
        at = next(i for i in range(len(ws)) if ws[i:i + len(key)] == key)
        out.append(Template(label, tuple(ws), tuple(key), at, rarest(key), is_base))
    return out


def _strings(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _starts(index: list[Template], rank: int) -> Column:
    """(template, start) of every hit of the ``rank``-th rarest words; a key phrase
    of fewer different words is posted by its last one."""
    postings: dict[str, list[Column]] = {}
    for k, t in enumerate(index):
        word, place = t.posted[min(rank, len(t.posted) - 1)]
        postings.setdefault(word, []).append(F.struct(F.lit(k).alias("t"), F.lit(place).alias("place")))
    posted = F.create_map(*[x for w in sorted(postings) for x in (F.lit(w), F.array(*postings[w]))])
    return F.flatten(F.array_compact(F.transform("__hits", lambda i: F.transform(
        F.element_at(posted, F.get("__words", i)),
        lambda e: F.struct(e["t"].alias("t"), (i - e["place"]).alias("s"))))))


def _coverage(index: list[Template]) -> Column:
    """Share of the words of the best covered template among the found notices."""
    texts, at = F.array(*[_strings(t.words) for t in index]), F.array(*[F.lit(t.key_at) for t in index])

    def share(x: Column) -> Column:
        words = F.get(texts, x["t"])
        in_place = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda k: F.coalesce(
            F.get("__words", x["s"] - F.get(at, x["t"]) + k) == F.get(words, k), F.lit(False)))
        return F.size(in_place) / F.size(words)
    notices = F.filter("__found", lambda x: ~F.get(F.array(*[F.lit(t.base) for t in index]), x["t"]))
    return F.coalesce(F.array_max(F.transform(notices, share)), F.lit(0.0))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  index: list[Template] | None = None) -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word,
    base_labels, labels, score."""
    index = index or build_index()
    posted = sorted({w for t in index for w, _ in t.posted})
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    df = docs.select(F.col(id_col), F.array_remove(F.split(text, GAP), "").alias("__words"))
    df = df.select(id_col, "__words", F.filter(
        F.when(F.size("__words") > 0, F.sequence(F.lit(0), F.size("__words") - 1)).otherwise(
            F.array().cast("array<int>")),
        lambda i: F.get("__words", i).isin(posted)).alias("__hits"))
    both = _starts(index, 0)
    for rank in range(1, max(len(t.posted) for t in index)):
        both = F.array_intersect(both, _starts(index, rank))
    keys = F.array(*[_strings(t.key) for t in index])
    df = df.select(id_col, "__words", F.filter(both, lambda x: F.when(x["s"] >= 0, F.slice(
        "__words", x["s"] + 1, F.size(F.get(keys, x["t"]))) == F.get(keys, x["t"])).otherwise(False)).alias("__found"))

    is_base = F.array(*[F.lit(t.base) for t in index])
    df = df.select(id_col, "__words", "__found", F.filter("__found", lambda x: F.get(is_base, x["t"])).alias("__base"))
    places = F.transform("__base", lambda x: x["s"])
    names = _strings(t.label for t in index)

    def labels(found: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: F.get(names, x["t"])))), ",")
    score = F.greatest(F.when(F.size("__base") > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0)), _coverage(index))
    return df.select(
        F.col(id_col),
        F.size("__words").cast("long").alias("n_words"),
        F.size("__base").cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        labels("__base").alias("base_labels"),
        labels("__found").alias("labels"),
        score.cast("double").alias("score"))


def license_sql(table: str = "documents", index: list[Template] | None = None) -> str:
    """The same result in DuckDB SQL: every place is held against the key phrase of
    every template."""
    index = index or build_index()
    rx = WORD.replace("'", "''")

    def at(t: Template) -> str:
        return " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(t.key))

    cols = ",\n".join(f"list_filter(range(len(w)), lambda i: coalesce({at(t)}, false)) AS t{k}"
                      for k, t in enumerate(index))
    base = [k for k, t in enumerate(index) if t.base]
    cat = "list_concat(" * (len(base) - 1) + f"t{base[0]}" + "".join(f", t{k})" for k in base[1:])

    def labels(ks) -> str:
        one = ", ".join(f"CASE WHEN len(t{k}) > 0 THEN '{index[k].label}' END" for k in ks)
        return f"array_to_string(list_sort(list_distinct(list_filter([{one}], lambda x: x IS NOT NULL))), ',')"

    def coverage(k: int, t: Template) -> str:
        words = "[" + ", ".join(f"'{x}'" for x in t.words) + "]"
        hit = (f"len(list_filter(range({len(t.words)}), lambda j: s - {t.key_at} + j >= 0 "
               f"AND coalesce(w[s - {t.key_at - 1} + j] = ({words})[j + 1], false)))")
        return f"coalesce(list_max(list_transform(t{k}, lambda s: {hit} / {len(t.words)}.0::DOUBLE)), 0.0)"

    scores = ", ".join(coverage(k, t) for k, t in enumerate(index) if not t.base)
    return f"""
WITH a AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{rx}') AS w
           FROM {table}),
b AS (SELECT doc_id, w,
{cols}
FROM a),
c AS (SELECT *, {cat} AS p FROM b)
SELECT doc_id, len(w)::BIGINT AS n_words, len(p)::BIGINT AS n_base, list_min(p)::BIGINT AS first_word,
  list_max(p)::BIGINT AS last_word, {labels(base)} AS base_labels, {labels(range(len(index)))} AS labels,
  greatest(CASE WHEN len(p) > 0 THEN {BASE_SCORE}::DOUBLE ELSE 0.0::DOUBLE END, {scores})::DOUBLE AS score
FROM c"""
