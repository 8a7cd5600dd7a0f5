"""Licence scans by canonical digest lookup.

A text is made canonical: lower case, copyright lines dropped, equivalent
spellings unified, punctuation and white space reduced to single blanks. Its
SHA-256 is joined to the digests of known licences, made by the same rule. Both
the whole text and each of its lines are units, so a licence file and a one-line
notice inside a longer text are found alike; a unit matches only in its entirety.

Known are the short texts below, the files of the folder ``licenses`` in their
usual forms (with and without heading and appendix, wrapped or a paragraph a
line), each body under its usual title lines where asked, and one-line notices.

The join is on equal digests; Spark broadcasts the known side where it is below
its own threshold and shuffles otherwise. The result has a row per match.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Equivalent spellings, applied in this order to lower-case text.
SPELLINGS = (
    ("licence", "license"), ("sub-license", "sublicense"), ("non-commercial", "noncommercial"),
    ("non-infringement", "noninfringement"), ("copyright holder", "copyright owner"),
    ("favour", "favor"), ("organisation", "organization"), ("merchantibility", "merchantability"),
    ("https://", "http://"), ("per cent", "percent"), ("wilful", "willful"), ("&", " and "),
    ("fulfil ", "fulfill "), ("acknowledgement", "acknowledgment"), ("whilst", "while"),
    ("version v", "version "),
)
# Short licence texts as published.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
}
# Names a notice may give a licence, and how notices begin.
NAMES = {
    "MIT": ("MIT License", "MIT"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPLv2", "GPL-2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPLv3", "GPL-3.0"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPLv3", "LGPL-3.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPLv3", "AGPL-3.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "BSD-3-Clause", "BSD License"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL-2.0"),
    "ISC": ("ISC License", "ISC"),
    "Unlicense": ("Unlicense",),
    "CC0-1.0": ("CC0 1.0", "CC0-1.0", "CC0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0",),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0",),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0",),
}
# Title lines that licence files put over the body.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "BSD Zero Clause License (0BSD)",
             "BSD 0-Clause License", "0BSD"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License", "zlib"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License",
                     'BSD 2-Clause "Simplified" License', "The 2-Clause BSD License", "FreeBSD License",
                     "BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "Modified BSD License",
                     'BSD 3-Clause "New" or "Revised" License', "The 3-Clause BSD License", "The BSD License",
                     "BSD License", "BSD-3-Clause"),
    "Unlicense": ("The Unlicense", "Unlicense", "The Unlicense (Unlicense)"),
    "Apache-2.0": ("Apache License 2.0", "Apache License, Version 2.0", "Apache License Version 2.0, January 2004"),
    "GPL-2.0": ("GNU General Public License Version 2", "GNU General Public License Version 2, June 1991"),
    "GPL-3.0": ("GNU General Public License Version 3", "GNU General Public License Version 3, 29 June 2007"),
    "LGPL-3.0": ("GNU Lesser General Public License Version 3",
                 "GNU Lesser General Public License Version 3, 29 June 2007"),
    "MPL-2.0": ("Mozilla Public License Version 2.0", "Mozilla Public License 2.0 (MPL-2.0)", "MPL-2.0"),
    "CC0-1.0": ("CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal", "Creative Commons Legal Code CC0 1.0 Universal"),
    "CC-BY-SA-4.0": ("Attribution-ShareAlike 4.0 International",
                     "Creative Commons Attribution-ShareAlike 4.0 International"),
}
# Where the body of a long text may begin, and where it may end.
STARTS = {
    "Apache-2.0": ("TERMS AND CONDITIONS FOR USE",), "MPL-2.0": ("1. Definitions\n",),
    "GPL-2.0": ("Everyone is permitted", "Preamble\n"), "GPL-3.0": ("Everyone is permitted", "Preamble\n"),
    "LGPL-3.0": ("Everyone is permitted", "This version of the GNU Lesser"),
    "CC0-1.0": ("CREATIVE COMMONS CORPORATION", "Statement of Purpose\n"),
    "CC-BY-SA-4.0": ('Creative Commons Corporation ("Creative Commons")',
                     "Creative Commons Attribution-ShareAlike 4.0 International Public\nLicense\n",
                     "By exercising the Licensed Rights"),
}
ENDS = {
    "Apache-2.0": ("END OF TERMS AND CONDITIONS", "APPENDIX: How to apply"), "MPL-2.0": ("Exhibit A - Source",),
    "GPL-2.0": ("END OF TERMS AND CONDITIONS", "How to Apply These"),
    "GPL-3.0": ("END OF TERMS AND CONDITIONS", "How to Apply These"),
    "CC-BY-SA-4.0": ("Creative Commons is not a party",), "Unlicense": ("For more information",),
}
# Passages that published editions of a text have differently.
EDITIONS = {
    "Apache-2.0": (("Copyright [yyyy] [name of copyright owner]", ""),),
    "GPL-2.0": (("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
                 "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA"),),
    "BSD-2-Clause": (("1. Redis", "Redis"), ("2. Redis", "Redis")),
    "BSD-3-Clause": (("1. Redis", "Redis"), ("2. Redis", "Redis"), ("3. Neither", "Neither")),
}
OPENINGS = ("{0}", "Licensed under {0}", "Licensed under the {0}", "Released under {0}",
            "Released under the {0}", "This work is licensed under {0}",
            "This work is licensed under the {0}", "This software is licensed under the {0}",
            "This project is licensed under the {0}", "Distributed under the {0}",
            "Available under the {0}", "SPDX-License-Identifier: {0}")


def canonical_lines(text: Column) -> Column:
    """Canonical text, line by line (empty lines stay empty)."""
    c = F.lower(F.regexp_replace(text, r"\r\n?", "\n"))
    c = F.regexp_replace(c, r"(?m)^[^\p{L}\p{N}\n©]*(?:copyright(?=[ \t]*(?:©|\(c\)|[0-9:]))|©|\(c\)(?![ \t]*(?:you must retain|under patent claims)))[^\n]*$", "")
    c = F.regexp_replace(c, r"(?m)^[ \t]*all rights reserved\.?[ \t]*$", "")
    for old, new in SPELLINGS:
        c = F.replace(c, F.lit(old), F.lit(new))
    c = F.regexp_replace(c, r"[^\p{L}\p{N}\n]+", " ")
    return F.regexp_replace(c, r" ?\n ?", "\n")


def _whole(lines: Column) -> Column:
    c = F.trim(F.regexp_replace(lines, r"[ \n]+", " "))
    for old, new in SPELLINGS:                           # phrases that a line break parted
        if " " in old.strip():
            c = F.replace(c, F.lit(old), F.lit(new))
    return c


def license_texts() -> dict[str, list[str]]:
    """Usual forms of every known text: whole, without heading, without appendix,
    by edition, each as wrapped and with a paragraph a line."""
    whole = dict(TEXTS)
    for f in sorted((Path(__file__).parent / "licenses").glob("*.txt")):
        whole[f.stem] = f.read_text(encoding="utf-8")
    out = {}
    for k, text in whole.items():
        other = text
        for old, new in EDITIONS.get(k, ()):
            other = other.replace(old, new)
        forms = []
        for t in dict.fromkeys((text, other)):
            starts = [0, *(t.index(x) for x in STARTS.get(k, ()))]
            ends = [len(t), *(t.rindex(x) for x in ENDS.get(k, ()))]
            forms += [t[a:e] for a in starts for e in ends]
            if "END OF TERMS AND CONDITIONS" in ENDS.get(k, ()):
                end = t.rindex("END OF TERMS AND CONDITIONS") + len("END OF TERMS AND CONDITIONS")
                forms += [t[a:end] for a in starts]
        forms += ["\n\n".join(" ".join(p.split()) for p in re.split(r"\n[ \t]*\n", t)) for t in forms]
        out[k] = list(dict.fromkeys(t.strip("\n") for t in forms))
    return out


def known_licenses(spark: SparkSession) -> DataFrame:
    """``(license_id, text)``: the known texts, bare and under each of their title
    lines, and notices by rule."""
    texts = license_texts()
    rows = [(k, t) for k, forms in texts.items() for t in forms]
    rows += [(k, f"{title}\n\n{t}") for k, forms in texts.items() for t in forms
             if k not in STARTS or t.startswith(tuple(" ".join(x.split()) for x in STARTS[k]) + STARTS[k])
             for title in TITLES[k]]
    rows += [(k, o.format(n)) for k, names in NAMES.items() for n in names for o in OPENINGS]
    return spark.createDataFrame(rows, "license_id string, text string")


def digests(licenses: DataFrame) -> DataFrame:
    """``(digest, license_id)`` of ``licenses(license_id, text)``: one id for each
    digest (the smallest, where texts coincide); empty texts have none."""
    c = _whole(canonical_lines(F.col("text").cast("string")))
    return (licenses.select(F.col("license_id").cast("string"), c.alias("c")).where("c <> ''")
            .groupBy(F.sha2("c", 256).alias("digest")).agg(F.min("license_id").alias("license_id")))


def scan(docs: DataFrame, licenses: DataFrame | None = None) -> DataFrame:
    """``(doc_id, unit, line_no, license_id)``: a row per match.

    ``unit`` is "text" (line_no null) or "line" (line_no from 1). A line that is
    the whole text matches as both. Null, empty and punctuation-only units match
    nothing; repeated rows give repeated matches; extra columns are not read; an
    empty licence table gives no rows.
    """
    known = digests(licenses if licenses is not None else known_licenses(docs.sparkSession))
    lines = docs.select(F.col("doc_id").cast("long"),
                        canonical_lines(F.col("text").cast("string")).alias("c"))
    whole = F.struct(F.lit(0).alias("no"), _whole(F.col("c")).alias("u"))
    parts = F.transform(F.split("c", "\n", -1), lambda u, i: F.struct(
        (i + 1).alias("no"), F.trim(u).alias("u")))
    units = lines.select("doc_id", F.explode(F.filter(
        F.concat(F.array(whole), parts), lambda x: x["u"] != "")).alias("x"))
    return (units.select("doc_id", F.col("x.no").alias("no"), F.sha2("x.u", 256).alias("digest"))
            .join(known, "digest")
            .select("doc_id", F.when(F.col("no") == 0, "text").otherwise("line").alias("unit"),
                    F.when(F.col("no") > 0, F.col("no")).cast("long").alias("line_no"), "license_id"))
