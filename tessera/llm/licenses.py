r"""License scan by canonical digest.

A text is brought to a canonical form and hashed; the digest of the entire
text is joined with the digests of known licences. The form is built line by
line: lower case, copyright lines dropped, punctuation and space turned into
single spaces, equivalent spellings replaced, the lines that remain joined by
a space. Lines are also compared, each as an entire text of its own, with
known one-line notices.

Known are LICENSES and NOTICES here, which the SQL has too; the digests of
``known_licenses.tsv``, made by :func:`text_digests` of the files in
``known_licenses`` (id, ``@``, where the copy is from); and the usual notice
wordings of NAMES, by :func:`usual_notices`.

Only DataFrame functions are used and nothing is shuffled: the known texts are
a reference table, broadcast after its number of rows is checked against
``BROADCAST_ROWS`` and joined by a shuffle beyond that.

Defined results: a null or empty text, or one of copyright lines only, has the
empty form and matches nothing. Rows with equal texts get equal results, one
row out for each row in. Columns named like the results are replaced.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.native import documents, literal_table, text_or_empty

#: Known texts up to this many rows are broadcast.
BROADCAST_ROWS = 20_000

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_TOP = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAME = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

#: Whole licence texts. Their copyright lines are left out, as the form drops them.
LICENSES = {
    "MIT": "MIT License\n" + _MIT,
    "MIT-untitled": _MIT,
    "ISC": f"ISC License\n{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n{_ISC_END}",
    "ISC-untitled": f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n{_ISC_END}",
    "0BSD": f"{_ISC_GRANT}.\n{_ISC_END}",
    "BSD-2-Clause": f"{_BSD_TOP}\n{_BSD_END}",
    "BSD-3-Clause": f"{_BSD_TOP}\n{_BSD_NAME}\n{_BSD_END}",
    "Zlib": _ZLIB,
}

#: One-line notices.
NOTICES = {
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
}

#: What notices call a licence, after "the" or not. Each id also stands in an SPDX line.
NAMES = {
    "0BSD": ["BSD Zero Clause License", "0BSD License"],
    "AFL-3.0": ["Academic Free License version 3.0"],
    "AGPL-3.0": ["GNU Affero General Public License v3.0", "GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPLv3", "AGPL-3.0 License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License", "Apache 2.0"],
    "Artistic-2.0": ["Artistic License 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-clause BSD License", "Simplified BSD License", "FreeBSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-clause BSD License", "New BSD License", "Modified BSD License"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "CC0-1.0": ["CC0 1.0 Universal License", "Creative Commons CC0 License", "Creative Commons Zero v1.0 Universal License", "CC0 1.0 Universal", "CC0 1.0", "CC0"],
    "CDDL-1.0": ["Common Development and Distribution License 1.0"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License v1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License v. 2.0", "EPL 2.0"],
    "EUPL-1.2": ["European Union Public License 1.2", "EUPL v1.2"],
    "GFDL-1.3": ["GNU Free Documentation License, Version 1.3", "GNU Free Documentation License 1.3"],
    "GPL-2.0": ["GNU General Public License v2.0", "GNU General Public License, version 2", "GNU GPL v2", "GPL v2", "GPLv2", "GPL-2.0 License"],
    "GPL-3.0": ["GNU General Public License v3.0", "GNU General Public License, version 3", "GNU GPL v3", "GPL v3", "GPLv3", "GPL-3.0 License"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License v2.1", "GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1", "LGPLv2.1", "LGPL-2.1 License"],
    "LGPL-3.0": ["GNU Lesser General Public License v3.0", "GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPLv3", "LGPL-3.0 License"],
    "MIT": ["MIT License", "MIT/X11 License", "MIT-License", "Expat License"],
    "MPL-1.1": ["Mozilla Public License, version 1.1", "Mozilla Public License 1.1"],
    "MPL-2.0": ["Mozilla Public License, v. 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "NCSA": ["University of Illinois/NCSA Open Source License", "NCSA License"],
    "OFL-1.1": ["SIL Open Font License, Version 1.1", "SIL Open Font License 1.1"],
    "Unlicense": ["Unlicense", "The Unlicense"],
    "WTFPL": ["WTFPL"],
    "Zlib": ["zlib License", "zlib/libpng License"],
}
for _code, _words in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    for _version, _place in (("4.0", "International"), ("3.0", "Unported")):
        _full = f"Creative Commons {_words} {_version}"
        NAMES[f"CC-{_code}-{_version}"] = [f"CC {_code} {_version}", f"CC {_code} {_version} License", f"CC-{_code}", f"{_full} License", f"{_full} {_place} License", f"{_full} {_place}"][:: 1 if _version == "4.0" else -1][: 6 if _version == "4.0" else 3]
_GRANTS = ("Licensed", "Released", "Distributed", "Published", "Available", "Provided", *(f"{x} licensed" for x in ("This work is", "This project is", "This software is", "This program is", "This file is", "This document is", "This code is", "This source code is", "This content is", "This package is", "This library is")))
_FORMS = ("{grant} under {name}.", "{grant} under the {name}.", "{grant} under the terms of the {name}.")


def usual_notices() -> list[tuple[str, str]]:
    """(id, sentence) of NOTICES, of the wordings of NAMES, and of SPDX lines; GNU ids also as -only, -or-later and +."""
    out = list(NOTICES.items())
    for license_id, names in sorted(NAMES.items()):
        out += [(license_id, form.format(grant=grant, name=name)) for name in names for grant in _GRANTS for form in _FORMS]
        out += [(license_id, f"License: {name}") for name in names]
        gnu = "GPL" in license_id or "GFDL" in license_id
        out += [(license_id, f"SPDX-License-Identifier: {license_id}{end}") for end in (("", "-only", "-or-later") if gnu else ("",))]
    return out


_COPYRIGHT = r"^\W*(?:copyright\W*(?:\(c\)|©|\d{4}|by\b)|\(c\)\s*\d|©|all rights reserved\W*$).*"
#: Equivalent spellings, applied to words parted by single spaces.
_SPELLINGS = [
    (r"\b(licen|offen|defen)ce(s|d|e|es)?\b", "{1}se{2}"),
    (r"\b(author|organ|real|recogn|optim|util|initial|custom|maxim|minim)is(e|ed|es|ing|ation|ations)\b", "{1}iz{2}"),
    (r"\b(fav|hon|lab|col|behavi)our(s|ed|able|ing|s)?\b", "{1}or{2}"),
    (r"\bsub licens(e|ed|es|ing|able)\b", "sublicens{1}"),
    (r"\b(acknowledg|judg)ements?\b", "{1}ment"),
    (r"\b(?:owner|owners) of copyright\b|\bcopyright owner(s)?\b", "copyright holder{1}"),
    (r"\bnon (infringement|commercial)\b", "non{1}"),
]


def _canonical_line(line: Column) -> Column:
    """``regexp_replace`` in Java's dialect; see _sql_line for the same in RE2's."""
    low = F.lower(line)
    c = F.when(low.rlike(r"copyright|\(c\)|©|all rights"), F.regexp_replace(low, _COPYRIGHT, "")).otherwise(low)
    c = F.trim(F.regexp_replace(c, r"[^\p{L}\p{N}]+", " "))
    for pattern, to in _SPELLINGS:
        c = F.regexp_replace(c, pattern, to.replace("{", "$").replace("}", ""))
    return c


def canonical_lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n", -1), _canonical_line), lambda x: x != "")


def known_table(spark: SparkSession, texts: dict[str, str]) -> DataFrame:
    """(license_id, digest) of known texts."""
    rows = literal_table(spark, sorted(texts.items()), ["license_id", "known_text"])
    return rows.select("license_id", F.sha2(F.array_join(canonical_lines(F.col("known_text")), " "), 256).alias("digest"))


def text_digests(spark: SparkSession) -> DataFrame:
    """(license_id, digest) of the files in known_licenses: what known_licenses.tsv holds."""
    files = sorted(Path(__file__).with_name("known_licenses").glob("*.txt"))
    return known_table(spark, {p.stem: p.read_text() for p in files}).select(F.substring_index("license_id", "@", 1).alias("license_id"), "digest")


def known_digests(spark: SparkSession) -> DataFrame:
    """(license_id, digest) of all known texts."""
    rows = [tuple(line.split("\t")) for line in Path(__file__).with_name("known_licenses.tsv").read_text().splitlines()]
    return known_table(spark, LICENSES).union(literal_table(spark, rows, ["license_id", "digest"]))


def _notice_forms(spark: SparkSession, notices: list[tuple[str, str]]) -> dict[str, str]:
    """Canonical form to id; of two ids with one form, the first. The sentences travel as one literal."""
    lines = F.split(F.lit("\n".join(t.replace("\n", " ") for _, t in notices)), "\n", -1)
    rows = spark.range(1, numPartitions=1).select(F.posexplode(lines).alias("i", "t")).select("i", _canonical_line(F.col("t")).alias("c")).collect()
    out: dict[str, str] = {}
    for r in sorted(rows):
        out.setdefault(r.c, notices[r.i][0])
    out.pop("", None)
    return out


def scan(docs: DataFrame, text_col: str = "text", known: DataFrame | None = None, notices: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with canonical_digest, n_words, license_id and notice_ids.

    ``known`` has (license_id, digest); of several ids with one digest, the
    smallest is taken.
    """
    spark = docs.sparkSession
    known = known_digests(spark) if known is None else known
    known = known.groupBy(F.col("digest").alias("_digest")).agg(F.min("license_id").alias("_license_id"))
    if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    forms = _notice_forms(spark, usual_notices() if notices is None else list(notices.items()))
    texts = F.split(F.lit("\n".join(forms)), "\n", -1)
    by_form = F.map_from_arrays(texts, F.split(F.lit("\n".join(forms.values())), "\n", -1))
    longest = max(map(len, forms), default=0)
    hints = [h for h in ("licens", " under ") if any(h in c for c in forms)]
    sure = all(any(h in c for h in hints) for c in forms)
    # The row travels as one column, so that its names meet none of ours.
    kept = [c for c in docs.columns if c not in ("canonical_digest", "n_words", "license_id", "notice_ids")]
    row = F.struct(*[F.col(f"`{c}`") for c in kept])
    out = docs.select(row.alias("_row"), canonical_lines(text_or_empty(F.col(f"`{text_col}`"))).alias("_lines"))
    form = F.array_join("_lines", " ")
    # Few lines can be a notice; without one the set of notices need not be made for the row.
    short = F.filter("_lines", lambda x: (F.char_length(x) <= longest) & (reduce(or_, [x.contains(h) for h in hints]) if sure and hints else F.lit(True)))
    found = F.when(F.size(short) > 0, F.array_intersect(short, texts)).otherwise(F.array().cast("array<string>"))
    out = out.select(
        "_row",
        F.sha2(form, 256).alias("canonical_digest"),
        F.when(form == "", F.lit(0)).otherwise(F.char_length(form) - F.char_length(F.replace(form, F.lit(" "), F.lit(""))) + 1).cast("long").alias("n_words"),
        F.array_join(F.sort_array(F.array_distinct(F.transform(found, lambda x: F.element_at(by_form, x)))), ",").alias("notice_ids"),
    )
    joined = out.join(known, (F.col("canonical_digest") == F.col("_digest")) & (F.col("n_words") > 0), "left")
    return joined.select("_row.*", "canonical_digest", "n_words", F.col("_license_id").alias("license_id"), "notice_ids")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


def _sql_line(line: str) -> str:
    c = f"regexp_replace(lower({line}), '{_COPYRIGHT}', '')"
    c = rf"trim(regexp_replace({c}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    for pattern, to in _SPELLINGS:
        c = f"regexp_replace({c}, '{pattern}', '{to.replace('{', chr(92)).replace('}', '')}', 'g')"
    return c


def _sql_values(texts: dict[str, str]) -> str:
    return ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(texts.items()))


OP10_SQL = f"""
WITH given AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, coalesce(text, '') AS t FROM documents
  UNION ALL SELECT 'k', * FROM (VALUES {_sql_values(LICENSES)})
  UNION ALL SELECT 'n', * FROM (VALUES {_sql_values(NOTICES)})),
forms AS (
  SELECT kind, id, pos, {_sql_line("line")} AS c
  FROM (SELECT kind, id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM given)),
whole AS (
  SELECT kind, id, coalesce(string_agg(c, ' ' ORDER BY pos) FILTER (c <> ''), '') AS form, coalesce(list(DISTINCT c) FILTER (c <> ''), []) AS lines
  FROM forms GROUP BY kind, id),
known AS (SELECT form, min(id) AS license_id FROM whole WHERE kind = 'k' GROUP BY form),
noted AS (
  SELECT f.id, string_agg(DISTINCT n.id, ',' ORDER BY n.id) AS notice_ids
  FROM forms f JOIN whole n ON n.kind = 'n' AND f.kind = 'd' AND f.c = n.form GROUP BY f.id)
SELECT CAST(w.id AS BIGINT) AS doc_id, sha256(w.form) AS canonical_digest,
       CASE WHEN w.form = '' THEN 0 ELSE length(w.form) - length(replace(w.form, ' ', '')) + 1 END AS n_words,
       k.license_id, coalesce(d.notice_ids, '') AS notice_ids
FROM whole w LEFT JOIN known k ON w.form = k.form AND w.form <> '' LEFT JOIN noted d ON d.id = w.id
WHERE w.kind = 'd'
"""
