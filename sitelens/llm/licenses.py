"""Licence texts found by canonical digest (DataFrame functions only)."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.scale import staged
from sitelens.llm.keys import keyed

# One-line notices in common use (the four of the given test documents, no SPDX texts), and two
# short texts by SPDX identifier; the other published texts are the files in ``spdx``.
KNOWN = [
    ("Apache-2.0 notice", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0 notice", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0-only notice", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT notice", "Released under the MIT License."),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        'hereby granted.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO '
        "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR "
        "BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING "
        "FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
]
TEXTS = Path(__file__).with_name("spdx")
# Titles that a text may bear or lack.
_OFL = "SIL OPEN FONT LICENSE Version 1.1 - 26 February 2007"
_CC = "Creative Commons Legal Code\n"
TITLES = {
    "0BSD": ["Zero-Clause BSD", "BSD Zero Clause License", "Zero Clause BSD License", "BSD 0-Clause License"],
    "Apache-2.0": ["Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/", "Apache License\nVersion 2.0, January 2004"],
    "Artistic-1.0-Perl": ['The "Artistic License"'],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License", "BSD License"],
    "BSD-3-Clause": [
        "BSD 3-Clause License",
        "The 3-Clause BSD License",
        'BSD 3-Clause "New" or "Revised" License',
        "BSD-3-Clause",
        "New BSD License",
        "BSD License",
    ],
    "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003"],
    "CC-BY-3.0-US": [_CC + "Attribution 3.0 United States", "Attribution 3.0 United States"],
    "CC-BY-SA-3.0": [_CC + "Attribution-ShareAlike 3.0 Unported", "Attribution-ShareAlike 3.0 Unported"],
    "CC-BY-SA-3.0-US": [_CC + "Attribution-ShareAlike 3.0 United States", "Attribution-ShareAlike 3.0 United States"],
    "CC-BY-SA-4.0": [_CC + "Attribution-ShareAlike 4.0 International", "Attribution-ShareAlike 4.0 International"],
    "CC0-1.0": [_CC + "CC0 1.0 Universal", "CC0 1.0 Universal"],
    "CDLA-Permissive-2.0": ["Community Data License Agreement - Permissive - Version 2.0"],
    "GFDL-1.2-only": ["GNU Free Documentation License\nVersion 1.2, November 2002"],
    "GFDL-1.3-only": ["GNU Free Documentation License\nVersion 1.3, 3 November 2008"],
    "GPL-1.0-only": ["GNU GENERAL PUBLIC LICENSE\nVersion 1, February 1989"],
    "GPL-2.0-only": ["GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991"],
    "GPL-3.0-only": ["GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"],
    "LGPL-2.0-only": ["GNU LIBRARY GENERAL PUBLIC LICENSE\nVersion 2, June 1991"],
    "LGPL-2.1-only": ["GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999"],
    "LGPL-3.0-only": ["GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"],
    "MIT": ["MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)"],
    "MPL-1.1": ["MOZILLA PUBLIC LICENSE\nVersion 1.1"],
    "MPL-2.0": ["Mozilla Public License Version 2.0", "Mozilla Public License, version 2.0"],
    "OFL-1.1": [_OFL, "This Font Software is licensed under the SIL Open Font License, Version 1.1.\nThis license is copied below, "
                "and is also available with a FAQ at:\nhttp://scripts.sil.org/OFL\n" + _OFL],
    "Unicode-3.0": ["UNICODE LICENSE V3"],
    "Unlicense": ["The Unlicense", "Unlicense"],
    "WTFPL": ["DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\nVersion 2, December 2004"],
    "Zlib": ["zlib License", "The zlib License", "The zlib/libpng License"],
}
TITLES["Apache-2.0 WITH LLVM-exception"] = TITLES["Apache-2.0"]
# An appendix from one of these lines on may be missing.
APPENDICES = ["END OF TERMS AND CONDITIONS", "APPENDIX: How to apply", "How to Apply These Terms", "ADDENDUM: How to use this License"]
# texts whose list marks may be numbers or signs
BULLETED = ["BSD-2-Clause", "BSD-3-Clause"]
# Spellings that count as equal, in texts whose marks are blanks.
SPELLINGS = [
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("copyright owner", "copyright holder"),
    ("whilst", "while"),
    ("favour", "favor"),
    ("http ", "https "),
]
_YEAR = "((19|20)[0-9]{2}|[<{\\\\[](year|yyyy))"
#: lines that name a holder: they start with a copyright mark, and a word or (c) alone needs a year
_HOLDER = (
    "(?m)^[^\\\\p{L}\\\\p{N}\\\\n©(]*"
    f"((copyright[ \\\\t:]*)?©|copyright[ \\\\t:]*\\\\(c\\\\)|(copyright\\\\b|\\\\(c\\\\))[^\\\\n]*{_YEAR}|all rights reserved[. \\\\t]*$)[^\\\\n]*$"
)


def published() -> list[tuple[str, str]]:
    """(license_id, text) of every form of the published texts: with each title and none, with and without appendix."""
    bodies = [(name, text) for name, text in KNOWN if name in TITLES]
    bodies += [(p.name.removesuffix(".txt"), p.read_text(encoding="utf-8")) for p in sorted(TEXTS.glob("*.txt"))]
    forms = [x for x in KNOWN if x[0] not in TITLES]
    for name, text in bodies:
        cuts = [text]
        for mark in [] if " WITH " in name else APPENDICES:
            if (at := text.rfind(mark)) >= 0:
                cuts += [text[:at], text[: at + len(mark)]] if mark == APPENDICES[0] else [text[:at]]
        if name in BULLETED:
            cuts += [re.sub(r"(?m)^( *)[0-9]\.", r"\1*", cut) for cut in cuts]
        forms += [(name, f"{title}\n\n{cut}") for cut in cuts for title in ("", *TITLES[name])]
    return forms


def _spelled(text: str) -> str:
    for old, new in SPELLINGS:
        text = f"replace({text}, '{old}', '{new}')"
    return text


def _plain(text: str) -> str:
    """SQL for a text in lower case without holders' lines, marks as blanks, in one spelling; lines stay."""
    out = f"regexp_replace(translate(lower({text}), '\\r', '\\n'), '{_HOLDER}', '')"
    return _spelled(f"regexp_replace({out}, '[^\\\\p{{L}}\\\\p{{N}}\\n]+', ' ')")


def _digest(text: str) -> str:
    """SQL for the digest of a plain text as one line, in which spellings that were wrapped meet too."""
    return f"sha2(trim({_spelled(f"regexp_replace({text}, '[ \\\\n]+', ' ')")}), 256)"


def known_digests(known: DataFrame) -> DataFrame:
    """(license_id, digest) of ``known(license_id, text)``; of texts with one digest the first id stays."""
    plain = known.withColumn("_p", F.expr(_plain("text")))
    return plain.withColumn("digest", F.expr(_digest("_p"))).groupBy("digest").agg(F.min("license_id").alias("license_id"))


def license_scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, digest of the whole canonical text, its licence, and licences that are a whole line of it.

    The whole text and each of its distinct lines are looked up by digest; only matches go
    further than the join, and the table of licences is whatever the caller gives (Spark
    broadcasts it if small); without one it is ``published()``.  ``license_id`` is null where the whole text is no known licence;
    ``line_licenses`` is sorted, and empty without matches.  A null text counts as empty; empty
    canonical texts match nothing; rows that repeat a doc_id are scanned each on its own.
    """
    spark = docs.sparkSession
    known = known if known is not None else spark.createDataFrame(published(), "license_id string, text string")
    empty = F.sha2(F.lit(""), 256)
    digests = staged(known_digests(known).filter(F.col("digest") != empty))
    plain = keyed(docs).select("_key", "doc_id", F.expr(_plain("coalesce(text, '')")).alias("_p"))
    lines = "array_distinct(filter(transform(split(_p, '\\\\n'), x -> trim(x)), x -> x <> ''))"
    hashed = staged(
        plain.select(
            "_key", "doc_id", F.expr(_digest("_p")).alias("digest"), F.expr(f"transform({lines}, x -> sha2(x, 256))").alias("_lines")
        )
    )
    hits = (
        hashed.select("_key", F.explode("_lines").alias("digest"))
        .join(digests, "digest")
        .groupBy("_key")
        .agg(F.sort_array(F.collect_set("license_id")).alias("line_licenses"))
    )
    return (
        hashed.drop("_lines")
        .join(digests, "digest", "left")
        .join(hits, "_key", "left")
        .select(
            "doc_id",
            "digest",
            "license_id",
            F.array_join(F.coalesce("line_licenses", F.array().cast("array<string>")), ", ").alias("line_licenses"),
        )
    )
