"""Licence scan: whole licence files and notices as they stand in real sources,
and every result against the SQL, which has tables and a method of its own."""

import re
import textwrap

import duckdb
import pandas as pd
import pytest

from odometer.llm.license_scan import CRITICAL, known_sentences, scan_licences
from odometer.llm.oracle_sql import ORACLES

MIT_BODY = '''Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
'''
MIT = "MIT License\n\nCopyright (c) 2021 Some Body\n\n" + MIT_BODY
BSD_LIST = '''Copyright (c) 2019, Some Body
{rights}
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

{one} Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

{two} Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
'''
BSD_THIRD = '''
{three} Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
'''
BSD_END = '''
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
'''


def bsd(third, rights="", marks=("1.", "2.", "3.")):
    parts = BSD_LIST + (BSD_THIRD if third else "") + BSD_END
    return parts.format(rights=rights, one=marks[0], two=marks[1], three=marks[2])


APACHE = '''Copyright 2020 The Authors. All rights reserved.

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    {scheme}://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
'''
GPL = '''some-tool: it does something
Copyright (C) 2020 Some Body

This {what} is free software; you can redistribute it and/or modify
it under the terms of the GNU {kind}General Public License as published by
the Free Software Foundation; {version}

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {kind}General Public License for more details.

You should have received a copy of the GNU {kind}General Public License along
with this {what}. If not, see <https://www.gnu.org/licenses/>.
'''
LATER = "either version {} of the License, or\n(at your option) any later version."
KERNEL = '''linux/kernel/thing.c
Copyright (C) 1991, 1992 Some Body

This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License version 2 as
published by the Free Software Foundation.
'''
MPL = '''This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at {scheme}://mozilla.org/MPL/2.0/.
'''
ISC = '''Copyright (c) 2004 Some Body

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
'''


def gpl(version, kind="", what="program"):
    return GPL.format(version=version, kind=kind, what=what)


WHOLE = [
    (MIT, "MIT"),
    ("The MIT License (MIT)\n" + MIT[len("MIT License") :], "MIT"),
    (MIT_BODY, "MIT"),
    (bsd(False), "BSD-2-Clause"),
    (bsd(False, "All rights reserved.\n"), "BSD-2-Clause"),
    (bsd(True), "BSD-3-Clause"),
    (bsd(True, marks=("*", "*", "*")), "BSD-3-Clause"),
    (bsd(True, marks=("(1)", "(2)", "(3)")), "BSD-3-Clause"),
    (bsd(True, marks=("a)", "b)", "c)")).replace("the copyright holder nor", "Some Body, Inc. nor").replace("THE COPYRIGHT HOLDER OR", "SOME BODY OR"), "BSD-3-Clause"),
    (APACHE.format(scheme="http"), "Apache-2.0"),
    (APACHE.format(scheme="https"), "Apache-2.0"),
    (gpl(LATER.format(2)), "GPL-2.0-or-later"),
    (gpl(LATER.format(3)), "GPL-3.0-or-later"),
    (gpl(LATER.format(3)).replace("free software;", "free software:").replace("Foundation;", "Foundation,"), "GPL-3.0-or-later"),
    (gpl("version 2 of the License."), "GPL-2.0-only"),
    (gpl("version 3 of the License."), "GPL-3.0-only"),
    (gpl(LATER.format("2.1"), "Lesser ", "library"), "LGPL-2.1-or-later"),
    (gpl("version 2.1 of the License.", "Lesser ", "library"), "LGPL-2.1-only"),
    (gpl(LATER.format(3), "Lesser "), "LGPL-3.0-or-later"),
    (gpl(LATER.format(3), "Affero "), "AGPL-3.0-or-later"),
    (KERNEL, "GPL-2.0-only"),
    (MPL.format(scheme="http"), "MPL-2.0"),
    (MPL.format(scheme="https"), "MPL-2.0"),
    (ISC, "ISC"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007", "GPL-3.0"),
    ("                                 Apache License\n                           Version 2.0, January 2004\n", "Apache-2.0"),
    ("Mozilla Public License Version 2.0\n==================================\n", "MPL-2.0"),
]
#: What may be left over beside the licence.
EXTRA = {"AllRights", ""}
COMMENTS = {
    "bare": lambda t: t,
    "hashes": lambda t: "#!/bin/sh\n" + textwrap.indent(t, "# ", lambda line: True) + "\nexit 0\n",
    "slashes": lambda t: textwrap.indent(t, "// ", lambda line: True) + "int main() {}\n",
    "stars": lambda t: "/*\n" + textwrap.indent(t, " * ", lambda line: True) + " */\nint x;\n",
    "one paragraph a line": lambda t: "\n\n".join(re.sub(r"\s+", " ", p) for p in t.split("\n\n")),
    "one word a line": lambda t: "\n".join(t.split()),
    "carriage returns": lambda t: t.replace("\n", "\r\n"),
    "in a page of prose": lambda t: "Some prose, that says little\n\n" + t + "\nand more prose. " * 50,
}


def by_sql(texts):
    con = duckdb.connect()
    documents = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})  # noqa: F841 - read by name
    con.register("documents", documents)
    rel = con.sql(ORACLES["op4_license_scan"])
    names = rel.columns
    return {r["doc_id"]: tuple(r[c] for c in ("licences", "identifiers", "n_sentences", "unmatched")) for r in (dict(zip(names, x)) for x in rel.fetchall())}


def scanned(docs_of, texts, **more):
    rows = scan_licences(docs_of(list(enumerate(texts))), **more).collect()
    return {r.doc_id: (r.licences, r.identifiers, r.n_sentences, r.unmatched) for r in rows}


def test_whole_files_in_every_dress(docs_of):
    cases = [(dress(text), name) for dress in COMMENTS.values() for text, name in WHOLE]
    found = scanned(docs_of, [t for t, _ in cases])
    wrong = [(name, found[i], text[:80]) for i, (text, name) in enumerate(cases) if found[i][0] != name or found[i][3] not in EXTRA]
    assert wrong == []
    assert by_sql([t for t, _ in cases]) == found


TEXTS = [
    None, "", " ", "no such thing", "Nothing here. Released under the MIT License.", "junk### end\nLicensed under CC BY-NC 4.0.\nmore",
    "This work is licensed under the GNU General Public License, version 3.", "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0.", "licence license licensed",
    "Released under the MIT License. " * 3 + "Licensed under CC BY 4.0.", "x " * 200_000 + "\nReleased under the MIT License.", "." * 200_000 + "Released under the MIT License",
    "\n , " * 60_000 + "All rights reserved.", "This work is licensed under the GNU General Public License, version 9.", "Not Released under the MIT License.",
    "Released under the MIT License agreement.", "é Released under the MIT License. ü", "All rights reserved. " + MIT + bsd(True) + MIT, "GNU General Public License\n" + gpl(LATER.format(4)),
    gpl("as you like."), MPL.format(scheme="http").replace("v. 2.0", "v. 1.1"), "Neither the name of a b c d e f g h i nor the names of its contributors may be used.",
    "This work is in the public\ndomain.", "This work is in the public\t — domain.", "All rights\n * reserved.", "This program is free\n# software;", "All rights + reserved.",
]


def test_odd_texts_against_the_sql(docs_of):
    found = scanned(docs_of, TEXTS)
    assert found == by_sql(TEXTS)
    names = [found[i][0] for i in range(len(TEXTS))]
    assert names[:11] == ["", "", "", "", "MIT", "CC-BY-NC-4.0", "GPL-3.0", "Apache-2.0", "", "CC-BY-4.0,MIT", "MIT"]
    assert names[11:18] == ["MIT", "", "", "", "", "MIT", "BSD-3-Clause,MIT"]
    assert found[18][0] == found[19][0] == "" and "GPLgrant" in found[18][3] and found[20] == ("", "MPLref MPLcopy", 2, "MPLcopy,MPLref")
    assert [found[i][0] for i in (22, 23)] == ["Public-Domain"] * 2 and found[24][3] == "AllRights" and found[25][3] == "GPLfree" and found[26][1] == ""


SPDX = [
    ("// SPDX-License-Identifier: MIT\nint x;", "MIT"), ("# SPDX-License-Identifier: (GPL-2.0-only OR Apache-2.0)\n", "Apache-2.0,GPL-2.0-only"),
    ("/* SPDX-License-Identifier: GPL-2.0-or-later WITH Linux-syscall-note */", "GPL-2.0-or-later"), ("<!-- spdx-license-identifier: BSD-3-Clause -->", "BSD-3-Clause"),
    ("SPDX-License-Identifier:", ""), ("SPDX-License-Identifier: MIT AND GPL-2.0+\n" + MIT, "GPL-2.0+,MIT"), ("spdx license identifier MIT", ""),
]


def test_spdx_lines(docs_of):
    found = scanned(docs_of, [t for t, _ in SPDX])
    assert [found[i][0] for i in range(len(SPDX))] == [n for _, n in SPDX]
    assert found == by_sql([t for t, _ in SPDX])


def test_order_of_rules_decides(docs_of):
    rules = [("short", ["MITgrant"]), ("long", ["MITgrant", "MITnotice"])]
    assert scanned(docs_of, [MIT_BODY], rules=rules)[0][::3] == ("short", "MITliability,MITnotice,MITwarranty")
    assert scanned(docs_of, [MIT_BODY], rules=rules[::-1])[0][0] == "long"


def test_rows_and_plan(docs_of):
    rows = [(0, MIT), (0, MIT), (None, MIT), (3, None)]
    got = sorted(((r.doc_id, r.licences) for r in scan_licences(docs_of(rows)).collect()), key=str)
    assert got == [(0, "MIT"), (0, "MIT"), (3, ""), (None, "MIT")]
    plan = scan_licences(docs_of(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert scan_licences(docs_of([])).count() == 0


@pytest.mark.parametrize("sentence", sorted(known_sentences()))
def test_every_known_sentence_passes_the_prefilter(sentence):
    assert re.search(CRITICAL, sentence)
