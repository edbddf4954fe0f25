"""DuckDB SQL for the contract queries that SQL can express."""

import re

EXACT_DEDUP = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""

URL_FILTER = r"""
WITH rules(r_host, r_path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), m AS (
  SELECT page_id, host, path, r_host || r_path AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(r_host || r_path) DESC NULLS LAST) AS n
  FROM u LEFT JOIN rules
    ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE n = 1
"""


def crc32_sql(text: str) -> str:
    """CRC-32 of a text, bit by bit: a byte is mixed in, then eight shifts."""
    steps = f"flatten(list_transform(range(1, strlen({text}) + 1), lambda p: [ascii(substr({text}, p, 1)), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN b >= 0 THEN xor(c, b::BIGINT) ELSE xor(c >> 1, 3988292384 * (c & 1)) END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}::BIGINT[]), lambda c, b: {step}), 4294967295)"


def _manifest() -> str:
    """Trees level by level, then each row's way up, three siblings a run."""

    def digest(text: str) -> str:
        values = ["doc_id", "source", "lang", "n_chars", text]
        parts = [f"coalesce(strlen({v}::VARCHAR)::VARCHAR || ':' || {v}::VARCHAR, '-')" for v in values]
        return f"sha256({' || '.join(parts)})"

    def tree(name: str, leaves: str) -> str:
        return f"""
{name}_nodes(tree, lvl, i, h, n) AS (
  SELECT tree, 0, i, h, count(*) OVER (PARTITION BY tree) FROM {leaves}
  UNION ALL
  SELECT tree, lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3
  FROM {name}_nodes WHERE n > 1 GROUP BY tree, lvl, i // 3, n
), {name}_beside AS (
  SELECT a.tree, a.lvl, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM {name}_nodes a JOIN {name}_nodes b ON a.tree = b.tree AND a.lvl = b.lvl AND a.i // 3 = b.i // 3
  WHERE a.n > 1 GROUP BY ALL
)"""

    def way(name: str, start: str) -> str:
        return f"""
{name}_way(doc, tree, lvl, i, fold, proof) AS (
  {start}
  UNION ALL
  SELECT doc, tree, lvl + 1, i // 3, sha256(l || fold || r), proof || l || r
  FROM {name}_way JOIN {name}_beside USING (tree, lvl, i)
), {name}_end AS (
  SELECT * FROM {name}_way WHERE (tree, lvl) IN (SELECT (tree, lvl) FROM {name}_nodes WHERE n = 1)
)"""

    return f"""
WITH RECURSIVE t AS (
  SELECT *, CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS seen FROM documents
), d AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS tree, {digest('text')} AS h, {digest('seen')} AS f FROM t
), leaf AS (
  SELECT *, row_number() OVER (ORDER BY doc_id, h, f) AS doc,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h, f) - 1 AS i FROM d
), {tree('one', 'leaf')}, {way('one', 'SELECT doc, tree, 0, i, f, repeat(h, 0) FROM leaf')},
tops AS (
  SELECT '' AS tree, tree AS source, row_number() OVER (ORDER BY tree) - 1 AS i, h FROM one_nodes WHERE n = 1
), {tree('all', 'tops')}, {way('all', "SELECT e.doc, '', 0, o.i, e.fold, e.proof FROM one_end e JOIN tops o ON e.tree = o.source")}
SELECT leaf.doc_id, leaf.h AS leaf, tops.h AS subroot, root.h AS root, sha256(e.proof) AS proof_sha256,
       e.fold AS folded_root, e.fold = root.h AS verified
FROM leaf JOIN tops ON leaf.tree = tops.source JOIN all_end e USING (doc) CROSS JOIN (SELECT h FROM all_nodes WHERE n = 1) root
"""


#: Licence sentences in plain words, one a line, and rules; the query's own are
#: written elsewhere.  ``*`` stands for one to eight words, ``a|b`` for either.
LICENCE_WORDS = """
MITtitle: mit license
MITtitle: the mit license
MITtitle: the mit license mit
MITref: released under the mit license
MITref: licensed under the mit license
MITref: this project is licensed under the mit license
MITref: this project is licensed under the terms of the mit license
MITgrant: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions
MITnotice: the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
MITnotice: the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software
MITwarranty: the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
MITliability: in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software
ISCgrant: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
ApacheTitle: apache license version 2 0 january 2004
ApacheRef: licensed under the apache license version 2 0
ApacheRef: licensed under the apache license version 2 0 the license
ApacheComply: you may not use this file except in compliance with the license
ApacheCopy: you may obtain a copy of the license at http|https www apache org licenses license 2 0
ApacheBasis: unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied
ApacheSee: see the license for the specific language governing permissions and limitations under the license
GPLtitle2: gnu general public license version 2 june 1991
GPLtitle3: gnu general public license version 3 29 june 2007
LGPLtitle2.1: gnu lesser general public license version 2 1 february 1999
LGPLtitle3: gnu lesser general public license version 3 29 june 2007
AGPLtitle3: gnu affero general public license version 3 19 november 2007
GPLfree: this program|file|software is free software
GPLfree: this library is free software
GPLgrant: you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation
LGPLgrant: you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation
AGPLgrant: you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation
GPLkernel2: you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation
GPLkernel2: you can redistribute it and or modify it under the terms of version 2 of the gnu general public license as published by the free software foundation
LGPLkernel2.1: you can redistribute it and or modify it under the terms of version 2 1 of the gnu lesser general public license as published by the free software foundation
later2: either version 2 of the license or at your option any later version
later2.1: either version 2 1 of the license or at your option any later version
later3: either version 3 of the license or at your option any later version
only2: version 2 of the license
only2.1: version 2 1 of the license
only3: version 3 of the license
GPLhope: this program|library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose
GPLsee: see the gnu general public license for more details
GPLsee: see the gnu lesser|affero general public license for more details
GPLcopy: you should have received a copy of the gnu general public license along with this program|library
GPLcopy: you should have received a copy of the gnu lesser|affero general public license along with this program|library
BSDpre: redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
BSDsource: redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
BSDbinary: redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution
BSDendorse: neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission
BSDasis: this software is provided by * as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed
BSDliable: in no event shall * be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage
MPLtitle2: mozilla public license version 2 0
MPLref2: this source code form is subject to the terms of the mozilla public license v 2 0
MPLref: this source code form is subject to the terms of the mozilla public license
MPLcopy: if a copy of the mpl was not distributed with this file you can obtain one at http|https mozilla org mpl 2 0
PublicDomain: this work is in the public domain
AllRights: all rights reserved
GPLref1: this work is licensed under the gnu general public license version 1
GPLref2: this work is licensed under the gnu general public license version 2
GPLref3: this work is licensed under the gnu general public license version 3
LGPLref2.1: this work is licensed under the gnu lesser general public license version 2 1
LGPLref3: this work is licensed under the gnu lesser general public license version 3
AGPLref3: this work is licensed under the gnu affero general public license version 3
"""
LICENCE_RULES = """
MIT = MITtitle? MITgrant MITnotice MITwarranty? MITliability?
ISC = ISCgrant
Apache-2.0 = ApacheRef ApacheComply ApacheCopy? ApacheBasis? ApacheSee?
Apache-2.0 = ApacheTitle
GPL-2.0-or-later = GPLfree? GPLgrant later2 GPLhope? GPLsee? GPLcopy?
GPL-3.0-or-later = GPLfree? GPLgrant later3 GPLhope? GPLsee? GPLcopy?
GPL-2.0-only = GPLfree? GPLgrant only2 GPLhope? GPLsee? GPLcopy?
GPL-3.0-only = GPLfree? GPLgrant only3 GPLhope? GPLsee? GPLcopy?
GPL-2.0-only = GPLfree? GPLkernel2 GPLhope? GPLsee? GPLcopy?
LGPL-2.1-only = GPLfree? LGPLkernel2.1 GPLhope? GPLsee? GPLcopy?
LGPL-2.1-or-later = GPLfree? LGPLgrant later2.1 GPLhope? GPLsee? GPLcopy?
LGPL-3.0-or-later = GPLfree? LGPLgrant later3 GPLhope? GPLsee? GPLcopy?
LGPL-2.1-only = GPLfree? LGPLgrant only2.1 GPLhope? GPLsee? GPLcopy?
LGPL-3.0-only = GPLfree? LGPLgrant only3 GPLhope? GPLsee? GPLcopy?
AGPL-3.0-or-later = GPLfree? AGPLgrant later3 GPLhope? GPLsee? GPLcopy?
AGPL-3.0-only = GPLfree? AGPLgrant only3 GPLhope? GPLsee? GPLcopy?
BSD-3-Clause = BSDpre BSDsource BSDbinary BSDendorse BSDasis? BSDliable?
BSD-2-Clause = BSDpre BSDsource BSDbinary BSDasis? BSDliable?
Apache-2.0 = ApacheRef
MIT = MITref
MPL-2.0 = MPLref2 MPLcopy?
MPL-2.0 = MPLtitle2
Public-Domain = PublicDomain
GPL-2.0 = GPLtitle2
GPL-3.0 = GPLtitle3
LGPL-2.1 = LGPLtitle2.1
LGPL-3 = LGPLtitle3
AGPL-3 = AGPLtitle3
GPL-1.0 = GPLref1
GPL-2.0 = GPLref2
GPL-3.0 = GPLref3
LGPL-2.1 = LGPLref2.1
LGPL-3 = LGPLref3
AGPL-3 = AGPLref3
"""


def _license_scan() -> str:
    """Each known sentence is sought at every place where a part of the text
    (between line breaks and marks) begins, and must end where one ends."""
    lines = [line.split(": ", 1) for line in LICENCE_WORDS.strip().split("\n")]
    rules = [line.split(" = ") for line in LICENCE_RULES.strip().split("\n")]
    for kind in ("by", "by-sa", "by-nc", "by-nd"):
        for v in ("2.0", "3.0", "4.0"):
            name = f"CC{kind.replace('-', '').upper()}ref{v}"
            lines.append([name, f"licensed under cc {kind.replace('-', ' ')} {v.replace('.', ' ')}"])
            rules.append([f"CC-{kind.upper()}-{v}", name])

    def regex(words: str) -> str:
        return " ".join("(?:[a-z0-9+]+ ){0,7}?[a-z0-9+]+" if w == "*" else f"(?:{w})" if "|" in w else w for w in words.split())

    # The first words, as they are, find the texts worth looking at.
    known = ", ".join(f"('{name}', '{re.split(r'[*|]', words)[0].rpartition(' ')[0] if re.search(r'[*|]', words) else words}', '^{regex(words)}( |$)')" for name, words in lines)
    marks = r"\n\r.!?;:,"
    seen = "coalesce(array_to_string(list_transform(ids, lambda i: '<' || i || '>'), ''), '')"
    seen = f"regexp_replace({seen}, '<SPDX:([^>]+)>', '=\\1=', 'g')"
    for licence, parts in rules:
        run = "".join(f"(?:<{re.escape(p[:-1])}>)?" if p.endswith("?") else f"<{re.escape(p)}>" for p in parts.split())
        seen = f"regexp_replace({seen}, '{run}', '={licence}=', 'g')"
    return f"""
WITH known(id, head, pattern) AS (VALUES {known}),
d AS (SELECT row_number() OVER () AS r, * FROM documents),
u AS (
  SELECT r, list_filter(string_split(regexp_replace(regexp_replace(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9+{marks}]+', ' ', 'g'),
           '[ {marks}]*[{marks}][ {marks}]*', '|', 'g'), '|'), lambda x: trim(x) <> '') AS parts
  FROM d
), flat AS (SELECT r, list_transform(parts, lambda x: trim(x)) AS parts, array_to_string(list_transform(parts, lambda x: trim(x)), ' ') AS f FROM u),
hit AS (SELECT r, f, parts, id, pattern FROM flat JOIN known ON contains(f, head)),
part AS (
  SELECT r, p, n, sum(strlen(p) + 1) OVER (PARTITION BY r ORDER BY n) - strlen(p) AS pos
  FROM (SELECT r, unnest(parts) AS p, generate_subscripts(parts, 1) AS n FROM flat WHERE r IN (SELECT r FROM hit))
), start AS (
  SELECT r, pos FROM part
  UNION SELECT r, pos + strlen(regexp_extract(p, '^[0-9a-z]{{1,2}} ')) FROM part
), ending AS (SELECT r, pos + strlen(p) AS past FROM part),
m AS (
  SELECT DISTINCT r, pos, id, pos + strlen(rtrim(regexp_extract(substr(f, pos::BIGINT), pattern))) AS past
  FROM hit JOIN start USING (r) WHERE regexp_matches(substr(f, pos::BIGINT), pattern)
), whole AS (
  SELECT r, pos, max(past) AS past, arg_max(id, past) AS id FROM m SEMI JOIN ending USING (r, past) GROUP BY r, pos
), alone AS (
  SELECT * FROM whole w WHERE NOT EXISTS (SELECT 1 FROM whole o WHERE o.r = w.r AND o.pos < w.pos AND w.pos < o.past)
), sentences AS (SELECT r, list(id ORDER BY pos) AS ids FROM alone GROUP BY r),
spdx AS (
  SELECT r, list_transform(list_filter(flatten(list_transform(
           regexp_extract_all(text, '(?i)SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]+)', 1),
           lambda x: regexp_split_to_array(regexp_replace(x, '(?i)[ \t]+with[ \t]+[^ \t()]+', '', 'g'), '[() \t]+'))),
           lambda n: regexp_matches(n, '^[A-Za-z0-9]') AND lower(n) NOT IN ('and', 'or')), lambda n: 'SPDX:' || n) AS ids
  FROM d WHERE contains(lower(text), 'spdx-license-identifier:')
), f AS (
  SELECT doc_id, list_concat(coalesce(sentences.ids, []), coalesce(spdx.ids, [])) AS ids
  FROM d LEFT JOIN sentences USING (r) LEFT JOIN spdx USING (r)
), s AS (SELECT *, {seen} AS seen FROM f)
SELECT doc_id,
       coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all(seen, '=([^=]+)=', 1))), ','), '') AS licences,
       coalesce(array_to_string(ids, ' '), '') AS identifiers,
       len(ids) AS n_sentences,
       coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all(seen, '<([^>]+)>', 1))), ','), '') AS unmatched
FROM s
"""


ORACLES: dict[str, str] = {
    "op4_license_scan": _license_scan(),
    "op5_exact_dedup": EXACT_DEDUP,
    "op7_url_filter": URL_FILTER,
    "op12_manifest": _manifest(),
}
