"""Licence recognition by sentences and rules, with DataFrame functions only.

A text is brought into a plain form: A-Z lowered, every run of anything but
letters, digits and ``+`` one space, or a bar where the run has a line break or a
mark that may end a sentence.  A known sentence begins and ends at a bar and may
run over any bars inside, as notices are wrapped, set in comments and follow
titles and copyright lines that have no full stop; of several that begin at one
bar the longest counts, and the next one is looked for behind it.  The sentences
found, normalised, are looked up among the known ones, which gives one sequence of
identifiers in text order; SPDX lines add one for each licence they name.
Ordered rules then consume runs of identifiers: a rule that matches first takes
its sentences, later rules see the rest.  Identifiers that no rule takes are
reported as unmatched.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_GPL = "you can redistribute it and/or modify it under the terms of the GNU {}General Public License "
_FSF = "as published by the Free Software Foundation"
_LATER = "either version {} of the License, or (at your option) any later version."

# Well-known sentences of licence files and notices, with
# identifiers.  ``{}`` stands for one to eight words.
SENTENCES: list[tuple[str, str]] = [
    ("MITtitle", "MIT License"),
    ("MITtitle", "The MIT License"),
    ("MITtitle", "The MIT License (MIT)"),
    ("MITref", "Released under the MIT License."),
    ("MITref", "Licensed under the MIT License."),
    ("MITref", "This project is licensed under the MIT License."),
    ("MITref", "This project is licensed under the terms of the MIT License."),
    ("MITgrant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MITnotice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MITnotice", "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software."),
    ("MITwarranty", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("MITliability", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISCgrant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ApacheTitle", "Apache License Version 2.0, January 2004"),
    ("ApacheRef", "Licensed under the Apache License, Version 2.0."),
    ("ApacheRef", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("ApacheComply", "you may not use this file except in compliance with the License."),
    ("ApacheCopy", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("ApacheCopy", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"),
    ("ApacheBasis", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("ApacheSee", "See the License for the specific language governing permissions and limitations under the License."),
    ("GPLtitle2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPLtitle3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPLtitle2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPLtitle3", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPLtitle3", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("GPLfree", "This program is free software"),
    ("GPLfree", "This file is free software"),
    ("GPLfree", "This software is free software"),
    ("GPLfree", "This library is free software"),
    ("GPLgrant", _GPL.format("") + _FSF),
    ("LGPLgrant", _GPL.format("Lesser ") + _FSF),
    ("AGPLgrant", _GPL.format("Affero ") + _FSF),
    ("GPLkernel2", _GPL.format("") + "version 2 " + _FSF),
    ("GPLkernel2", "you can redistribute it and/or modify it under the terms of version 2 of the GNU General Public License " + _FSF),
    ("LGPLkernel2.1", "you can redistribute it and/or modify it under the terms of version 2.1 of the GNU Lesser General Public License " + _FSF),
    *[(f"later{v}", _LATER.format(v)) for v in ("2", "2.1", "3")],
    *[(f"only{v}", f"version {v} of the License.") for v in ("2", "2.1", "3")],
    ("GPLhope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("GPLhope", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    *[("GPLsee", f"See the GNU {kind}General Public License for more details.") for kind in ("", "Lesser ", "Affero ")],
    *[("GPLcopy", f"You should have received a copy of the GNU {kind}General Public License along with this {what}") for kind in ("", "Lesser ", "Affero ") for what in ("program", "library")],
    ("BSDpre", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSDsource", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSDbinary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSDendorse", "Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSDasis", "THIS SOFTWARE IS PROVIDED BY {} \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("BSDliable", "IN NO EVENT SHALL {} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("MPLtitle2", "Mozilla Public License Version 2.0"),
    ("MPLref2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPLref", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    *[("MPLcopy", f"If a copy of the MPL was not distributed with this file, You can obtain one at {at}mozilla.org/MPL/2.0/.") for at in ("http://", "https://")],
    ("PublicDomain", "This work is in the public domain."),
    ("AllRights", "All rights reserved."),
]
#: References by version, made from a rule: identifier, sentence, versions.
VERSIONED: list[tuple[str, str, tuple[str, ...]]] = [
    ("GPLref{}", "This work is licensed under the GNU General Public License, version {}.", ("1", "2", "3")),
    ("LGPLref{}", "This work is licensed under the GNU Lesser General Public License, version {}.", ("2.1", "3")),
    ("AGPLref{}", "This work is licensed under the GNU Affero General Public License, version {}.", ("3",)),
    ("CCBYref{}", "Licensed under CC BY {}.", ("2.0", "3.0", "4.0")),
    ("CCBYSAref{}", "Licensed under CC BY-SA {}.", ("2.0", "3.0", "4.0")),
    ("CCBYNCref{}", "Licensed under CC BY-NC {}.", ("2.0", "3.0", "4.0")),
    ("CCBYNDref{}", "Licensed under CC BY-ND {}.", ("2.0", "3.0", "4.0")),
]
_REST = ["GPLhope?", "GPLsee?", "GPLcopy?"]
#: Ordered rules: licence and the identifiers it takes (``?``: where it's there);
#: the first that fits wins.
RULES: list[tuple[str, list[str]]] = [
    ("MIT", ["MITtitle?", "MITgrant", "MITnotice", "MITwarranty?", "MITliability?"]),
    ("ISC", ["ISCgrant"]),
    ("Apache-2.0", ["ApacheRef", "ApacheComply", "ApacheCopy?", "ApacheBasis?", "ApacheSee?"]),
    ("Apache-2.0", ["ApacheTitle"]),
    ("GPL-2.0-or-later", ["GPLfree?", "GPLgrant", "later2", *_REST]),
    ("GPL-3.0-or-later", ["GPLfree?", "GPLgrant", "later3", *_REST]),
    ("GPL-2.0-only", ["GPLfree?", "GPLgrant", "only2", *_REST]),
    ("GPL-3.0-only", ["GPLfree?", "GPLgrant", "only3", *_REST]),
    ("GPL-2.0-only", ["GPLfree?", "GPLkernel2", *_REST]),
    ("LGPL-2.1-only", ["GPLfree?", "LGPLkernel2.1", *_REST]),
    *[(f"LGPL-{name}-or-later", ["GPLfree?", "LGPLgrant", f"later{v}", *_REST]) for name, v in (("2.1", "2.1"), ("3.0", "3"))],
    *[(f"LGPL-{name}-only", ["GPLfree?", "LGPLgrant", f"only{v}", *_REST]) for name, v in (("2.1", "2.1"), ("3.0", "3"))],
    ("AGPL-3.0-or-later", ["GPLfree?", "AGPLgrant", "later3", *_REST]),
    ("AGPL-3.0-only", ["GPLfree?", "AGPLgrant", "only3", *_REST]),
    ("BSD-3-Clause", ["BSDpre", "BSDsource", "BSDbinary", "BSDendorse", "BSDasis?", "BSDliable?"]),
    ("BSD-2-Clause", ["BSDpre", "BSDsource", "BSDbinary", "BSDasis?", "BSDliable?"]),
    ("Apache-2.0", ["ApacheRef"]),
    ("MIT", ["MITref"]),
    ("MPL-2.0", ["MPLref2", "MPLcopy?"]),
    ("MPL-2.0", ["MPLtitle2"]),
    ("Public-Domain", ["PublicDomain"]),
    *[(f"GPL-{v}.0", [f"GPLtitle{v}"]) for v in ("2", "3")],
    *[(f"LGPL-{v}", [f"LGPLtitle{v}"]) for v in ("2.1", "3")],
    ("AGPL-3", ["AGPLtitle3"]),
    *[(f"GPL-{v}.0", [f"GPLref{v}"]) for v in ("1", "2", "3")],
    *[(f"LGPL-{v}", [f"LGPLref{v}"]) for v in ("2.1", "3")],
    ("AGPL-3", ["AGPLref3"]),
    *[(f"CC-{kind}-{v}", [f"CC{kind.replace('-', '')}ref{v}"]) for kind in ("BY", "BY-SA", "BY-NC", "BY-ND") for v in ("2.0", "3.0", "4.0")],
]
#: A text without any of these words holds no known sentence; what normalising
#: makes one space may stand between two words.
CRITICAL = r"(?i)licen[sc]e|redistribut|permission|public[^a-zA-Z0-9+]+domain|rights[^a-zA-Z0-9+]+reserved|free[^a-zA-Z0-9+]+software|warrant|damages|mpl"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Line breaks and the marks that may end a sentence or a part of one.
MARKS = r"\n\r.!?;:,"
BETWEEN = r"(?: |\|\|)"
SOME_WORDS = rf"[a-z0-9+]+(?:{BETWEEN}[a-z0-9+]+){{0,7}}?"
SPDX = r"(?i)SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]+)"


def known_sentences() -> dict[str, str]:
    """Normalised sentence to identifier; ``{}`` for some words stays."""
    made = [(i.format(v), s.format(v)) for i, s, versions in VERSIONED for v in versions]
    out: dict[str, str] = {}
    for name, sentence in [*SENTENCES, *made]:
        out.setdefault(re.sub("[^a-z0-9+{}]+", " ", sentence.lower()).strip(), name)
    return out


def _pattern(known: dict[str, str]) -> str:
    """A known sentence between bars, behind the number of a list at most."""
    longest_first = sorted(known, key=lambda s: (-len(s), s))
    words = [BETWEEN.join(SOME_WORDS if w == "{}" else re.escape(w) for w in s.split()) for s in longest_first]
    return rf"\|(?:[0-9a-z]{{1,2}}{BETWEEN})?({'|'.join(words)})\|"


def plain_form(text: Column) -> Column:
    """The text between double bars; one bar is a sentence's end, the other the
    next one's begin."""
    low = F.translate(text, UPPER, LOWER)
    spaced = F.regexp_replace(low, rf"[^a-z0-9+{MARKS}]+", " ")
    barred = F.regexp_replace(spaced, rf"[ {MARKS}]*[{MARKS}][ {MARKS}]*", "||")
    return F.concat(F.lit("||"), F.trim(barred), F.lit("||"))


def _identified(text: Column, known: dict[str, str]) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    def identifier(sentence: Column) -> Column:
        flat = F.replace(sentence, F.lit("||"), F.lit(" "))
        for s in known:
            if "{}" in s:
                before, after = s.split("{}")
                flat = F.when(flat.startswith(before) & flat.endswith(after), F.lit(s)).otherwise(flat)
        return F.try_element_at(table, flat)

    return F.transform(F.regexp_extract_all(plain_form(text), F.lit(_pattern(known)), F.lit(1)), identifier)


def _named(text: Column) -> Column:
    """``SPDX:`` and the licence, for each licence that an SPDX line names."""
    lines = F.regexp_extract_all(text, F.lit(SPDX), F.lit(1))
    names = F.flatten(F.transform(lines, lambda x: F.split(F.regexp_replace(x, r"(?i)[ \t]+with[ \t]+[^ \t()]+", ""), r"[() \t]+")))
    kept = F.filter(names, lambda n: n.rlike("^[A-Za-z0-9]") & ~F.lower(n).isin("and", "or"))
    return F.transform(kept, lambda n: F.concat(F.lit("SPDX:"), n))


def _matched(identifiers: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """The sequence with each run that a rule takes replaced by ``=licence=``."""
    out = F.array_join(F.transform(identifiers, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")
    out = F.regexp_replace(out, "<SPDX:([^>]+)>", "=$1=")
    for licence, parts in rules:
        run = "".join(f"(?:<{re.escape(p[:-1])}>)?" if p.endswith("?") else f"<{re.escape(p)}>" for p in parts)
        out = F.regexp_replace(out, run, f"={licence}=")
    return out


def scan_licences(docs: DataFrame, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, licences (names in
    order, without repeats, separated by commas), identifiers (the sentences
    found in text order, then those of SPDX lines, separated by spaces),
    n_sentences and unmatched (identifiers that no rule took, without repeats).

    Null and empty texts, and texts without known sentences, give empty strings
    and 0.  Repeated rows are judged each.  An empty table gives no rows; further
    columns are ignored.  No row is shuffled.
    """
    rules = RULES if rules is None else rules
    none = F.array().cast("array<string>")
    some = F.col("text").rlike(CRITICAL)
    found = F.when(some, F.concat(_identified(F.col("text"), known_sentences()), _named(F.col("text")))).otherwise(none)
    found = docs.select(F.col("doc_id").alias("doc_id"), found.alias("found"))
    found = found.withColumn("seen", _matched(F.col("found"), rules))
    names = F.array_sort(F.array_distinct(F.regexp_extract_all("seen", F.lit("=([^=]+)="), F.lit(1))))
    rest = F.array_sort(F.array_distinct(F.regexp_extract_all("seen", F.lit("<([^>]+)>"), F.lit(1))))
    return found.select(
        "doc_id",
        F.array_join(names, ",").alias("licences"),
        F.array_join("found", " ").alias("identifiers"),
        F.size("found").cast("long").alias("n_sentences"),
        F.array_join(rest, ",").alias("unmatched"),
    )
