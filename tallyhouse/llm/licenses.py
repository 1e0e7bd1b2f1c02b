"""Licence notices, headers and bodies by Dice's coefficient over word bigrams, in DataFrame
functions only.

A text is normalised to words (letters and digits, lower case), so line ends, comment signs
and punctuation do not matter. For a template of m distinct bigrams and a threshold t, a
window of the text can only match with m * t / (2 - t) bigrams of the template, and only with
at most m * (2 - t) / t of its own. So, of all windows, these are compared: those that start
at a bigram of the template, end at the last one within the template's own length or within
the greatest length, and hold enough of its bigrams. A window must also hold the template's
marks: the words that tell it from its near relatives, such as its version. Marks prune first:
a text that cannot hold those of any template is not looked at again.

Of the windows of one template the best counts (ties: the first, then the shortest), and of
templates that match overlapping places those with the greatest coefficient.
"""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _gnu(kind: str, version: int) -> str:
    """Fixed value: the header that the GNU licences ask for."""
    return (f"This program is free software: you can redistribute it and/or modify it under the "
            f"terms of the GNU {kind} Public License as published by the Free Software "
            f"Foundation, either version {version} of the License, or (at your option) any later "
            f"version. This program is distributed in the hope that it will be useful, but "
            f"WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
            f"FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License for more "
            f"details.")


# Fixed value: the disclaimer that the BSD licences end with.
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
    "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
    "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: 1. Redistributions of source code "
    "must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. ")
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used "
    "to endorse or promote products derived from this software without specific prior written "
    "permission. ")

# Fixed values: (licence, marks, text). Notices by which works are placed under a licence,
# file headers, and the texts of short licences.
TEMPLATES = (
    ("MIT", ("MIT License",), "Released under the MIT License."),
    ("MIT", ("MIT License",), "Licensed under the MIT License."),
    ("MIT", ("identifier MIT",), "SPDX-License-Identifier: MIT"),
    ("MIT", ("is hereby granted", "distribute sublicense"),
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
     "to whom the Software is furnished to do so, subject to the following conditions: The above "
     "copyright notice and this permission notice shall be included in all copies or substantial "
     "portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
     "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
     "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
     "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
     "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
     "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Apache-2.0", ("Apache License",), "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", ("Apache License",), "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", ("identifier Apache 2 0",), "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", ("Apache License", "Version 2 0"),
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
     "file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
     "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
     "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
     "for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", ("GNU General", "version 3"),
     "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", ("GNU General", "version 3"),
     "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", ("GNU General", "version 3"), _gnu("General", 3)),
    ("GPL-2.0", ("GNU General", "version 2"),
     "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", ("GNU General", "version 2"), _gnu("General", 2)),
    ("LGPL-3.0", ("Lesser General", "version 3"),
     "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", ("Lesser General", "version 3"), _gnu("Lesser General", 3)),
    ("AGPL-3.0", ("Affero General", "version 3"),
     "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", ("Affero General", "version 3"), _gnu("Affero General", 3)),
    ("BSD-3-Clause", ("3 Clause",), "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", ("endorse or promote",), _BSD_START + _BSD_THIRD + _BSD_END),
    ("BSD-2-Clause", ("2 Clause",), "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", ("Redistributions in binary",), _BSD_START + _BSD_END),
    ("MPL-2.0", ("Mozilla Public", "v 2 0"),
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", ("CC BY 4 0",), "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", ("CC BY NC 4 0",), "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", ("CC BY SA 4 0",), "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", ("Attribution 4 0",),
     "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", ("CC0 1 0",), "This work is dedicated to the public domain under CC0 1.0."),
    ("ISC", ("ISC License",), "Released under the ISC License."),
    ("ISC", ("Permission to use",),
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission "
     "notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS "
     "ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
     "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
     "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
     "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
     "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Unlicense", ("unencumbered software",),
     "This is free and unencumbered software released into the public domain."),
    ("Zlib", ("altered source versions",),
     "This software is provided 'as-is', without any express or implied warranty. In no event "
     "will the authors be held liable for any damages arising from the use of this software. "
     "Permission is granted to anyone to use this software for any purpose, including commercial "
     "applications, and to alter it and redistribute it freely, subject to the following "
     "restrictions: 1. The origin of this software must not be misrepresented; you must not claim "
     "that you wrote the original software. If you use this software in a product, an "
     "acknowledgment in the product documentation would be appreciated but is not required. 2. "
     "Altered source versions must be plainly marked as such, and must not be misrepresented as "
     "being the original software. 3. This notice may not be removed or altered from any source "
     "distribution."),
)
THRESHOLD = 0.8


def split_words(text: str) -> list[str]:
    return "".join(c.lower() if c.isascii() and c.isalnum() else " " for c in text).split()


def pairs(found: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(found, found[1:])]


def profile(text: str, marks: tuple[str, ...], threshold: float) -> dict:
    """What a template is compared by: its distinct bigrams; the marks' bigrams; how many
    shared bigrams a match needs; the lengths of windows, in bigrams."""
    found = pairs(split_words(text))
    distinct = list(dict.fromkeys(found))
    m = len(distinct)
    marked = [b for mark in marks for b in pairs(split_words(mark))]
    return {"bigrams": distinct, "marks": list(dict.fromkeys(marked)),
            "need": math.ceil(m * threshold / (2 - threshold) - 1e-9),
            "sizes": sorted({len(found), math.floor(m * (2 - threshold) / threshold + 1e-9)})}


def words(text: Column) -> Column:
    """Words of ASCII letters and digits, in lower case."""
    return F.filter(F.split(F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", " ")), " "),
                    lambda w: w != "")


def bigrams(found: Column) -> Column:
    """Pairs of neighbouring words, in order; none of fewer than two words."""
    return F.zip_with(
        F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0))),
        F.slice(found, 2, F.greatest(F.size(found) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b))


def _with(value: Column, use) -> Column:
    """use(value), with value computed once a row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _strings(values: list[str]) -> Column:
    """A constant array, in one literal (words and bigrams hold no bar)."""
    return F.split(F.lit("|".join(values)), "[|]")


def _may_hold(text: Column, marks: list[str]) -> Column:
    """Whether a text may hold these bigrams: it has their longest word somewhere, or the first
    of them if all words are very short."""
    longest = max((w for b in marks for w in b.split()), key=len)
    if len(longest) > 3:
        return F.contains(text, F.lit(longest))
    return text.rlike(marks[0].replace(" ", "[^a-z0-9]+"))


def _templates(forms: list[tuple[str, dict]]) -> Column:
    """The templates as one constant array of structs."""
    return F.array(*[F.struct(
        F.lit(name).alias("license"), _strings(form["bigrams"]).alias("bigrams"),
        _strings(form["marks"]).alias("marks"), F.lit(form["need"]).alias("need"),
        F.transform(_strings([str(s) for s in form["sizes"]]), lambda s: s.cast("int"))
        .alias("sizes")) for name, form in forms])


def _windows(text: Column, hits: Column, template: Column, threshold: float) -> Column:
    """The best matching window of a template: an array of at most one
    struct(dice, -first, -last, license)."""
    need = template["need"]

    def of_size(h: Column, size: Column) -> Column:
        # h[k + need - 1] is the need-th hit from h[k] on: is it within the window?
        starts = F.filter(F.sequence(F.lit(0), F.size(h) - need),
                          lambda k: h[k + need - 1] - h[k] < size)
        return F.transform(starts, lambda k: F.struct(
            h[k].alias("first"), F.array_max(F.filter(
                F.slice(h, k + 1, size), lambda p: p < h[k] + size)).alias("last")))

    def judged(span: Column) -> Column:
        return _with(
            F.array_distinct(F.slice(text, span["first"] + 1, span["last"] - span["first"] + 1)),
            lambda u: F.struct(
                F.when(F.size(F.array_intersect(template["marks"], u))
                       == F.size(template["marks"]),
                       2 * F.size(F.array_intersect(template["bigrams"], u)).cast("double")
                       / (F.size(u) + F.size(template["bigrams"])))
                .otherwise(F.lit(0.0)).alias("dice"),
                (-span["first"]).alias("first"), (-span["last"]).alias("last"),
                template["license"].alias("license")))

    mine = F.transform(
        F.filter(hits, lambda x: F.array_contains(template["bigrams"], x["bigram"])),
        lambda x: x["at"])
    best = _with(mine, lambda h: F.when(F.size(h) >= need, F.array_max(F.transform(
        F.array_distinct(F.flatten(F.transform(template["sizes"], lambda s: of_size(h, s)))),
        judged))))
    return F.filter(F.array(best), lambda x: x["dice"] >= threshold)


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, licenses array<struct<license, dice, first_word, last_word>>) of each row: every
    licence of which a template matches a place in the text, with its best place, by name.
    Places count words from 0, both ends included.

    A null or empty text has none; repeated rows are judged each; other columns are ignored;
    an empty table gives no rows.
    """
    forms = [(name, profile(text, marks, threshold)) for name, marks, text in TEMPLATES]
    templates = _templates(forms)
    known = sorted({b for _, form in forms for b in form["bigrams"]})
    # A window holds all marks of its template, so a text that cannot hold any is done.
    text = F.coalesce("text", F.lit(""))
    maybe = [_may_hold(F.lower(text), list(marks)) for marks in sorted(
        {tuple(form["marks"]) for _, form in forms})]

    def places(found: Column) -> Column:
        hits = F.filter(F.transform(found, lambda b, k: F.struct(
            k.alias("at"), b.alias("bigram"))), lambda x: x["bigram"].isin(known))
        return _with(hits, lambda h: F.flatten(F.transform(
            templates, lambda t: _windows(found, h, t, threshold))))

    def best(found: Column) -> Column:
        kept = F.filter(found, lambda x: ~F.exists(found, lambda y: (
            (y["dice"] > x["dice"]) & (y["first"] >= x["last"]) & (x["first"] >= y["last"]))))
        names = F.array_sort(F.array_distinct(F.transform(kept, lambda x: x["license"])))
        return _with(kept, lambda k: F.transform(names, lambda name: _with(
            F.array_max(F.filter(k, lambda x: x["license"] == name)), lambda x: F.struct(
                name.alias("license"), x["dice"].alias("dice"),
                (-x["first"]).alias("first_word"), (1 - x["last"]).alias("last_word")))))

    none = "array<struct<license:string,dice:double,first_word:int,last_word:int>>"
    found = F.when(functools.reduce(operator.or_, maybe), _with(
        _with(words(text), bigrams), lambda b: _with(places(b), best)))
    return docs.select("doc_id", F.coalesce(found.cast(none), F.array().cast(none))
                       .alias("licenses"))


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_licenses, licenses (names, comma-joined), best_dice (0 without any)."""
    return found.select(
        "doc_id", F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join(F.transform("licenses", lambda x: x["license"]), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("licenses", lambda x: x["dice"])), F.lit(0.0))
        .alias("best_dice"))
