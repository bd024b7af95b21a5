"""Licence scan: lines, paragraphs, whole texts and passages against licence templates, by Dice coefficient over word bigrams.

A unit is normalised to small letters and digits; its distinct word bigrams are compared with those of the templates.
Two sets can only reach the threshold t if their sizes differ by a factor of (2 - t) / t at most, so the number of
bigrams decides which templates are candidates, and a unit that no template's bounds admit is not looked at further.
A unit that passes must also share so many bigrams with the templates as the smallest candidate asks for. Before words are
cut, units that hold none of the words a match cannot do without are left aside.

A passage is a run of words anywhere in a text: a licence of several paragraphs in a longer document, or a notice that shares
its line with other words. It begins and ends with bigrams of its template, and its length follows the template's size bounds.
The passages of a text do not overlap, and one inside a line, paragraph or text that is itself
given under the same licence is not given again.

Only column expressions; rows are neither shuffled nor joined. The templates are literals of the plan: their number is
fixed by the caller, not by the data.

A NULL or empty text has no units. Several units of a document may match, each gives a row. Repeated rows give repeated
rows, an empty table gives an empty result, NULL ids and further columns do not matter.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .license_texts import APACHE_2

THRESHOLD = 0.8

# Notices and texts as the licences' publishers give them.
TEMPLATES = {
    "mit-notice": ("MIT", "Released under the MIT License."),
    "mit-notice-2": ("MIT", "Licensed under the MIT License."),
    "mit-notice-3": ("MIT", "This project is licensed under the terms of the MIT license."),
    "mit-text": (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    "apache-2-notice": ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    "apache-2-notice-2": ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    "apache-2-header": (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    ),
    "gpl-3-notice": ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    "gpl-2-notice": ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    "gpl-3-header": (
        "GPL-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program. If not, see
        https://www.gnu.org/licenses/.""",
    ),
    "cc-by-nc-4-notice": ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    "cc-by-4-notice": ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    "cc-by-sa-4-notice": ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    "cc-by-4-sentence": ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa-4-sentence": (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc-4-sentence": (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "mpl-2-header": (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ),
    "isc-text": (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    ),
    "bsd-2-text": (
        "BSD-2-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
        PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
        INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
        GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
        LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF
        THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    "unlicense-notice": ("Unlicense", "This is free and unencumbered software released into the public domain."),
}
# End of fixed values.


def _gnu_header(name: str, version: str, work: str = "program") -> str:
    return f"""This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {name}Public
        License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any
        later version. This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name}Public License for more
        details. You should have received a copy of the GNU {name}Public License along with this {work}. If not, see
        https://www.gnu.org/licenses/."""


# Notices and texts that the first templates lack; LICENSE_SQL does not hold these.
MORE_TEMPLATES = {
    "gpl-2-header": ("GPL-2.0", _gnu_header("General ", "2")),
    "lgpl-2.1-notice": ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    "lgpl-3-notice": ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    "agpl-3-notice": ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    "lgpl-2.1-header": ("LGPL-2.1", _gnu_header("Lesser General ", "2.1", "library")),
    "lgpl-3-header": ("LGPL-3.0", _gnu_header("Lesser General ", "3")),
    "agpl-3-header": ("AGPL-3.0", _gnu_header("Affero General ", "3")),
    "bsd-3-text": (
        "BSD-3-Clause",
        TEMPLATES["bsd-2-text"][1].replace(
            "THIS SOFTWARE IS PROVIDED BY",
            """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY""",
        ),
    ),
    "apache-2-text": ("Apache-2.0", APACHE_2),
}
# End of fixed values.
ALL_TEMPLATES = TEMPLATES | MORE_TEMPLATES

# Bigrams that tell a licence from its siblings: a text that gets its name holds one of each tuple ...
TELLING = {
    "GPL-2.0": [("gnu general",), ("version 2", "license v2")],
    "GPL-3.0": [("gnu general",), ("version 3", "license v3")],
    "LGPL-2.1": [("lesser general",), ("version 2", "license v2")],
    "LGPL-3.0": [("lesser general",), ("version 3", "license v3")],
    "AGPL-3.0": [("affero general",), ("version 3", "license v3")],
    "Apache-2.0": [("version 2", "license 2")],
    "MPL-2.0": [("version 2", "v 2", "mpl 2")],
    "BSD-2-Clause": [("binary form",)],
    "BSD-3-Clause": [("binary form",), ("endorse or",)],
    "CC-BY-4.0": [("by 4", "attribution 4")],
    "CC-BY-SA-4.0": [("by sa", "attribution sharealike"), ("sa 4", "sharealike 4")],
    "CC-BY-NC-4.0": [("by nc", "attribution noncommercial"), ("nc 4", "noncommercial 4")],
}
# ... and none of these.
BARRED = {"BSD-2-Clause": ("endorse or",)}

# Letters of the scripts the templates are written in, and digits; everything else separates words.
SEPARATOR = r"[^\p{L}\p{N}]+"
BLANK_LINE = r"\n[\x20\x09\r]*\n"


def template_bigrams(text: str) -> list[str]:
    words = re.findall(r"[^\W_]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def bounds(size: int, threshold: float) -> tuple[int, int]:
    """Smallest and largest number of bigrams with which a unit can reach the threshold against ``size`` bigrams."""
    return math.ceil(size * threshold / (2 - threshold) - 1e-9), math.floor(size * (2 - threshold) / threshold + 1e-9)


# What a search for a word costs, by its length: short words are in most texts.
_COMMON = {1: 10_000, 2: 3_000, 3: 1_000, 4: 200, 5: 40, 6: 4}
_EVERYDAY = set("a an and any are as at be by for from have if in is it may no not of on or other shall that the this to under use with you your".split())
_STEM = 7


def _price(word: str) -> int:
    return _COMMON.get(len(word), 1) * (20 if word in _EVERYDAY else 1)


def _touching(word: str, grams) -> set[str]:
    return {gram for gram in grams if any(word in part for part in gram.split())}


def anchors(sets: dict[str, list[str]], licences: dict[str, str], threshold: float) -> list[str]:
    """Words or beginnings of words of which a unit must hold one to match any of the templates, as few as are found.

    A unit must share ``bounds(n)[0]`` of a template's n bigrams. So it holds one of some words if fewer bigrams than that
    are without any of them, or if each of some telling bigrams has one. Words that count for many templates come first.
    """
    chosen: list[str] = []
    for licence in dict.fromkeys(licences.values()):
        tuples = [[max(gram.split(), key=lambda word: (len(word), word)) for gram in grams] for grams in TELLING.get(licence, [])]
        rare = [words for words in tuples if min(map(len, words)) > max(_COMMON)]
        if rare:
            chosen += [word for word in min(rare, key=lambda words: (len(words), words)) if word not in chosen]

    every = {(name, gram) for name, grams in sets.items() for gram in grams}
    stems = {part[: max(i, 1)] for _, gram in every for part in gram.split() for i in (_STEM, len(part))}
    held = {stem: {(name, gram) for name, gram in every if _touching(stem, [gram])} for stem in sorted(stems | set(chosen))}
    needed = {name: len(grams) - bounds(len(grams), threshold)[0] + 1 for name, grams in sets.items()}

    def missing(words: list[str]) -> dict[str, int]:
        """How many bigrams the words lack to be anchors of each template."""
        held_by = set().union(*[held[word] for word in words])
        lacking = {}
        for name in sets:
            told = any(all(any(_touching(word, [gram]) for word in words) for gram in grams) for grams in TELLING.get(licences[name], []))
            lacking[name] = 0 if told else max(0, needed[name] - sum(1 for other, _ in held_by if other == name))
        return lacking

    while any((lacking := missing(chosen)).values()):
        held_by = set().union(*[held[word] for word in chosen])

        def worth(stem: str) -> float:
            more: dict[str, int] = {}
            for name, _ in held[stem] - held_by:
                more[name] = more.get(name, 0) + 1
            return sum(min(n, lacking[name]) / needed[name] for name, n in more.items()) / _price(stem)

        chosen.append(max((stem for stem in held if stem not in chosen), key=worth))
    for word in sorted(chosen, key=lambda word: (-_price(word), word)):
        rest = [other for other in chosen if other != word]
        if rest and not any(missing(rest).values()):
            chosen = rest
    return chosen


def _holds(part: Column, holding: set[str]) -> Column:
    """Whether the part holds one of the words; true if there are none."""
    wanted = sorted(word for word in holding if not any(other != word and other in word for other in holding))
    return reduce(or_, [part.contains(word) for word in wanted]) if wanted else F.lit(True)


def _exploded(table: DataFrame, kept: list[str], values: Column, name: str) -> DataFrame:
    """A row per value, none of which is NULL. Of the plain form Spark would test the size of the array in a filter below,
    with a second copy of the expression."""
    return table.select(*kept, F.explode_outer(values).alias(name)).filter(F.col(name).isNotNull())


def texts_holding(documents: DataFrame, holding: set[str] = frozenset()) -> DataFrame:
    """doc_id, part: the texts in small letters that hold a word of ``holding``; each is lowered once."""
    lowered = F.filter(F.array(F.lower(text_or_empty())), lambda text: _holds(text, holding))
    return _exploded(documents, ["doc_id"], lowered, "part")


def units(documents: DataFrame, holding: set[str] = frozenset()) -> DataFrame:
    """doc_id, unit, unit_no, part: lines, paragraphs of several lines, texts of several paragraphs; of ``holding``, if
    given, they hold at least one word."""
    text = F.col("part")

    def numbered(parts: Column, unit: str, several=lambda part: F.lit(True)) -> Column:
        structs = F.transform(parts, lambda part, i: F.struct(F.lit(unit).alias("unit"), (i + 1).alias("unit_no"), part.alias("part")))
        return F.filter(structs, lambda x: several(x["part"]) & _holds(x["part"], holding))

    every = F.concat(
        numbered(F.split(text, "\n"), "line"),
        numbered(F.split(text, BLANK_LINE), "paragraph", lambda part: part.contains("\n")),
        F.when(text.rlike(BLANK_LINE), numbered(F.array(text), "text")).otherwise(F.array()),
    )
    table = texts_holding(documents, holding)
    return _exploded(table, ["doc_id"], every, "u").select("doc_id", "u.unit", "u.unit_no", "u.part")


def _words(part: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(part, SEPARATOR, " ")), " ")


def _pairs(words: Column) -> Column:
    """The bigrams of the words, in order."""
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, pairs), F.slice(words, 2, pairs), lambda a, b: F.concat(a, F.lit(" "), b))


def _in(gram: str, grams: list[str] | tuple[str, ...]) -> str:
    return f"{gram} IN ({', '.join(map(_quoted, grams))})"


def _with(value: str, name: str, result: str) -> str:
    """``result``, in which the name stands for the value, which is computed once."""
    return f"transform(array({value}), {name} -> {result})[0]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _wanted(table: DataFrame, value: Column, name: str, condition) -> DataFrame:
    """The rows whose ``value`` meets the condition, with it as their last column.

    A filter above a projection would be moved below it with a second copy of the expression; this one computes it once.
    """
    kept = [column for column in ("doc_id", "unit", "unit_no", "part", "grams") if column in table.columns and column != name]
    return _exploded(table, kept, F.filter(F.array(value), condition), name)


class _Templates:
    """The templates as sets of bigrams, with what follows from the threshold."""

    def __init__(self, templates: dict[str, tuple[str, str]], threshold: float):
        self.licences = {name: licence for name, (licence, _) in templates.items()}
        self.threshold = threshold
        self.sets = {name: template_bigrams(text) for name, (_, text) in templates.items()}
        self.limits = {name: bounds(len(grams), threshold) for name, grams in self.sets.items()}
        self.lengths = {name: window_lengths(text, threshold) for name, (_, text) in templates.items()}
        telling = {gram for sets in TELLING.values() for grams in sets for gram in grams}
        self.every = sorted(telling.union(*self.sets.values(), *BARRED.values()))
        self.least, self.most = min(low for low, _ in self.limits.values()), max(high for _, high in self.limits.values())
        self.anchors = set(anchors(self.sets, self.licences, threshold))

    def told(self, name: str, grams: str) -> str:
        """Whether the bigrams tell the template's licence from its siblings."""
        licence = self.licences[name]
        needed = [f"exists({grams}, t -> {_in('t', one_of)})" for one_of in TELLING.get(licence, [])]
        barred = [f"NOT exists({grams}, t -> {_in('t', BARRED[licence])})"] if licence in BARRED else []
        return " AND ".join([*needed, *barred]) or "true"

    def best(self, size: str, grams: str) -> str:
        """The best template for a unit of ``size`` distinct bigrams, ``grams`` of which are in templates; NULL if none."""
        scores = []
        for name, members in self.sets.items():
            low, high = self.limits[name]
            dice = f"2.0D * size(filter({grams}, g -> {_in('g', members)})) / ({size} + {len(members)})"
            score = f"struct({dice} AS dice, {_quoted(name)} AS template, {_quoted(self.licences[name])} AS licence)"
            scores.append(f"CASE WHEN {size} BETWEEN {low} AND {high} AND {self.told(name, grams)} THEN {score} END")
        matching = f"filter(array({', '.join(scores)}), x -> x IS NOT NULL AND x.dice >= {self.threshold}D)"
        return f"array_min(transform({matching}, x -> struct(-x.dice AS least, x.template AS template, x.licence AS licence, x.dice AS dice)))"

    def licence(self, grams: str) -> str:
        """The licence that a part with these distinct bigrams gets as a unit; NULL if none."""
        known = f"filter({grams}, g -> {_in('g', self.every)})"
        found = _with(known, "known", f"{self.best(f'size({grams})', 'known')}.licence")
        return f"CASE WHEN size({grams}) BETWEEN {self.least} AND {self.most} THEN {found} END"

    def windows(self, name: str) -> str:
        """The best window from each bigram of the template; ``hits`` are places and bigrams, ``grams`` all of the text."""
        members, (low, _), lengths = self.sets[name], self.limits[name], self.lengths[name]
        score = f"""struct(
            -dice AS least, -shared AS fewest, s.hit.at AS first, last AS last,
            {_quoted(name)} AS template, {_quoted(self.licences[name])} AS licence, dice AS dice)"""
        scored = _with(f"2.0D * shared / (size(span) + {len(members)})", "dice", score)
        scored = f"CASE WHEN {self.told(name, 'span')} THEN {scored} END"
        scored = _with("array_distinct(slice(grams, s.hit.at + 1, last - s.hit.at + 1))", "span", scored)
        scored = _with("element_at(inside, -1).at", "last", scored)
        scored = _with("size(array_distinct(inside.gram))", "shared", f"CASE WHEN shared >= {low} THEN {scored} END")
        window = _with("filter(slice(own, s.k + 1, n), x -> x.at < s.hit.at + n)", "inside", scored)
        # Fewer than ``low`` bigrams of the template within the longest window: nothing begins here.
        near = f"transform(own, (hit, k) -> struct(hit AS hit, k AS k, get(own, k + {low - 1}).at AS `end`))"
        starts = f"filter({near}, s -> s.`end` < s.hit.at + {lengths[-1]})"
        each = f"transform({starts}, s -> array_min(transform(array({', '.join(map(str, lengths))}), n -> {window})))"
        found = f"filter({each}, w -> w IS NOT NULL AND w.dice >= {self.threshold}D)"
        return _with(f"filter(hits, h -> {_in('h.gram', members)})", "own", found)


def window_lengths(text: str, threshold: float, steps: int = 12) -> list[int]:
    """Numbers of bigrams, repeated ones too, of the windows for a template: all that its bounds admit, or ``steps`` of them."""
    words, distinct = re.findall(r"[^\W_]+", text.lower()), len(template_bigrams(text))
    low, high = bounds(distinct, threshold)
    high = max(low, math.ceil(high * (len(words) - 1) / distinct))
    if high - low < steps:
        return list(range(low, high + 1))
    return sorted({round(low + (high - low) * i / (steps - 1)) for i in range(steps)})


def _holding(parts: Column, first: Column, last: Column) -> Column:
    """The part that holds the words ``first`` to ``last`` of the text, in an array; empty if they are in several."""
    counts = F.transform(parts, lambda part: F.size(F.filter(_words(part), lambda word: word != "")))
    ends = F.aggregate(counts, F.array(F.lit(0)), lambda ends, n: F.concat(ends, F.array(F.element_at(ends, -1) + n)))
    return F.flatten(
        F.transform(F.array(ends), lambda ends: F.filter(parts, lambda _, i: (F.get(ends, i) <= first) & (last < F.get(ends, i + 1))))
    )


def passages(documents: DataFrame, known: _Templates) -> DataFrame:
    """doc_id, unit, unit_no (number of the first word), best: runs of words that match, in no unit of that licence."""
    table = texts_holding(documents, known.anchors)
    table = _wanted(table, _pairs(_words(F.col("part"))), "grams", lambda grams: F.size(grams) >= known.least)
    places = F.expr(f"filter(transform(grams, (g, i) -> struct(i AS at, g AS gram)), h -> {_in('h.gram', known.every)})")
    table = _wanted(table, places, "hits", lambda hits: F.size(hits) >= known.least)
    found = F.expr(f"concat({', '.join(known.windows(name) for name in known.sets)})")
    table = _wanted(table, found, "found", lambda found: F.size(found) > 0)
    # What shares more with its template comes first; what overlaps it is left out.
    kind = "array<struct<fewest:int,least:double,first:int,last:int,template:string,licence:string,dice:double>>"
    ranked = "array_sort(transform(found, x -> struct(x.fewest, x.least, x.first, x.last, x.template, x.licence, x.dice)))"
    apart = f"""aggregate({ranked}, CAST(array() AS {kind}), (kept, x) -> CASE
        WHEN exists(kept, other -> other.first <= x.last + 1 AND x.first <= other.last + 1) THEN kept
        ELSE concat(kept, CAST(array(x) AS {kind})) END)"""
    table = _exploded(table, ["doc_id", "part"], F.expr(apart), "best")
    first, last, text = F.col("best.first"), F.col("best.last") + 1, F.col("part")
    holders = F.concat(_holding(F.split(text, "\n"), first, last), _holding(F.split(text, BLANK_LINE), first, last), F.array(text))
    grams = F.transform(holders, lambda part: F.array_distinct(_pairs(_words(part))))
    table = table.select("doc_id", "best", F.filter(F.array(grams), lambda grams: F.size(grams) > 0)[0].alias("holders"))
    alone = F.expr(f"NOT exists(holders, grams -> coalesce({known.licence('grams')} = best.licence, false))")
    return table.filter(alone).select("doc_id", F.lit("passage").alias("unit"), (F.col("best.first") + 1).alias("unit_no"), "best")


def license_scan(documents: DataFrame, templates: dict[str, tuple[str, str]] = ALL_TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, unit, unit_no, licence, template, dice: the best template of every unit and passage that reaches the threshold."""
    known = _Templates(templates, threshold)
    table = units(documents, known.anchors)
    table = _wanted(table, _words(F.col("part")), "words", lambda words: F.size(words) > known.least)
    table = _wanted(table, F.array_distinct(_pairs(F.col("words"))), "grams", lambda grams: F.size(grams).between(known.least, known.most))
    shared = F.struct(F.size("grams").alias("size"), F.expr(f"filter(grams, g -> {_in('g', known.every)})").alias("grams"))
    table = _wanted(table, shared, "shared", lambda shared: F.size(shared["grams"]) >= known.least)
    table = _wanted(table, F.expr(known.best("shared.size", "shared.grams")), "best", lambda best: best.isNotNull())
    columns = ["doc_id", "unit", "unit_no", "best.licence", "best.template", "best.dice"]
    return table.select(*columns).unionAll(passages(documents, known).select(*columns))


_TEMPLATE_ROWS = ", ".join(
    f"({_quoted(name)}, {_quoted(licence)}, [{', '.join(_quoted(g) for g in template_bigrams(text))}])"
    for name, (licence, text) in TEMPLATES.items()
)

LICENSE_SQL = rf"""
WITH templates(template, licence, grams) AS (VALUES {_TEMPLATE_ROWS}),
texts AS (SELECT doc_id, lower(coalesce(text, '')) AS body FROM documents),
parts AS (
  SELECT doc_id, 'line' AS unit, i::INT AS unit_no, string_split(body, chr(10))[i] AS part
  FROM (SELECT doc_id, body, unnest(range(1, len(string_split(body, chr(10))) + 1)) AS i FROM texts)
  UNION ALL
  SELECT doc_id, 'paragraph', i::INT, string_split_regex(body, '\n[\x20\x09\r]*\n')[i]
  FROM (SELECT doc_id, body, unnest(range(1, len(string_split_regex(body, '\n[\x20\x09\r]*\n')) + 1)) AS i FROM texts)
  WHERE contains(string_split_regex(body, '\n[\x20\x09\r]*\n')[i], chr(10))
  UNION ALL
  SELECT doc_id, 'text', 1, body FROM texts WHERE regexp_matches(body, '\n[\x20\x09\r]*\n')),
worded AS (
  SELECT doc_id, unit, unit_no, string_split(trim(regexp_replace(part, '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM parts),
grammed AS (
  SELECT doc_id, unit, unit_no,
    list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM worded WHERE len(w) > 1),
scored AS (
  SELECT doc_id, unit, unit_no, licence, template,
    2.0::DOUBLE * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS dice
  FROM grammed JOIN templates ON len(g) * {2 - THRESHOLD} >= len(grams) * {THRESHOLD} - 1e-9
    AND len(g) * {THRESHOLD} <= len(grams) * {2 - THRESHOLD} + 1e-9
    AND list_has_any(g, grams))
SELECT doc_id, unit, unit_no, licence, template, dice FROM scored WHERE dice >= {THRESHOLD}
QUALIFY row_number() OVER (PARTITION BY doc_id, unit, unit_no ORDER BY dice DESC, template) = 1
"""
