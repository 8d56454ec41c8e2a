"""License scans by canonical digests.

A text's canonical form has no copyright lines, one spelling for words that are spelt in several ways, no punctuation and
no case; letters and digits of all scripts count. Its digest is looked up among the digests of known licence texts with a hash
join, whole text by whole text. The units are the whole document and, from every line on, runs of lines and of paragraphs
as long as the longest known text has lines, since licences stand among other text in scraped documents. Everything is
done with DataFrame operations.

A unit can only be a known text if it begins with the first word of one, in any of its spellings. So units that do not are left
before their canonical form is made, which loses nothing and leaves few.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.text import let
from broadsheet.session import broadcast_if_small

# Equivalent spellings, as whole words of the lower-cased text.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"),
    ("catalogue", "catalog"),
    ("categorise", "categorize"),
    ("centre", "center"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("organisation", "organization"),
    ("owner", "holder"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("sublicence", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
)

# Spellings in two words, and the one word they are.
PAIRS = (("non", "commercial", "noncommercial"), ("per", "cent", "percent"))

# Known licence notices and texts.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions:\n"
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
            "Software.\n"
            "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
            "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
            "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies.\n"
            "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
            "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
            "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
            "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
            "THIS SOFTWARE."),
)

COPYRIGHT_LINE = r"(?m)^[^\n]*(copyright[ \t]+(\(c\)|©|[0-9])|\(c\)[ \t]*[0-9]|©|all rights reserved)[^\n]*$"


MARKS = ("copyright", "(c)", "©", "all rights reserved")
WORD = r"[\p{L}\p{N}]+"
FIRST_WORDS = 10_000  # first words of known texts that units are held against; more known texts are looked up without


def _marked(lower: Column) -> Column:
    return reduce(Column.__or__, (F.contains(lower, F.lit(m)) for m in MARKS))


def canonical(text: Column) -> Column:
    """The canonical form; a null text stays null. Copyright lines are those with `copyright` before a year or sign, with
    a sign before a year, or with `all rights reserved`."""
    spelt = F.create_map(*[F.lit(x) for pair in SPELLINGS for x in pair])
    lower = F.lower(text)
    kept = F.when(_marked(lower), F.regexp_replace(lower, COPYRIGHT_LINE, " ")).otherwise(lower)
    words = F.split(F.trim(F.regexp_replace(kept, r"[^\p{L}\p{N}]+", " ")), " ")
    out = F.concat(F.lit(" "), F.array_join(F.transform(words, lambda w: F.coalesce(spelt[w], w)), " "), F.lit(" "))
    for first, second, one in PAIRS:
        out = F.regexp_replace(out, f"(?<= ){first} {second}(?= )", one)
    return F.trim(out)


def digest(text: Column) -> Column:
    return F.md5(canonical(text).cast("binary"))


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, license) of the known texts (license, text), one row a digest; of two licences with one text the first by name."""
    return known.filter(canonical(F.col("text")) != "").groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license").alias("license"))


def _bounds(known: DataFrame) -> tuple[list[str] | None, int]:
    """The words with which a unit may begin (None: too many to list), and the most lines of a known text."""
    made = known.select(canonical(F.col("text")).alias("c"), F.col("text")).filter("c <> ''")
    lines = made.agg(F.max(F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))))).first()[0]
    firsts = [r.w for r in made.select(F.split_part("c", F.lit(" "), F.lit(1)).alias("w")).distinct().limit(FIRST_WORDS + 1).collect()]
    if len(firsts) > FIRST_WORDS:
        return None, lines or 1
    ways = {*firsts, *(a for a, b in SPELLINGS if b in firsts), *(first for first, _, one in PAIRS if one in firsts)}
    return sorted(ways), lines or 1


def scan(docs: DataFrame, known=KNOWN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, license, whole, first_line) of every document and licence it carries: whole says that the entire text is the
    licence, first_line is the number of the first line that is it (0 for a whole text). `known` is a table (license, text), or a
    short list of such pairs; its digests are broadcast only behind a check of their number.

    Null texts and texts without letters or digits carry none. Rows of one id, or without one, count as one document.
    """
    if not isinstance(known, DataFrame):
        known = docs.sparkSession.createDataFrame([*known], "license string, text string")
    firsts, most = _bounds(known)

    def may_begin(text: Column) -> Column:
        return F.lit(True) if firsts is None else F.lower(F.regexp_extract(text, WORD, 0)).isin(*firsts) if firsts else F.lit(False)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null").withColumn("marked", _marked(F.lower("text")))

    def solid(x: Column) -> Column:
        return x["text"].rlike(WORD) & ~(F.col("marked") & F.lower(x["text"]).rlike(COPYRIGHT_LINE))

    def runs(lines: Column) -> Column:
        """The units that begin at a line, for all lines of a text; lines without words and of copyright are passed over."""
        places = F.transform(lines, lambda x, k: F.struct((k + 1).alias("at"), x["line"].alias("line"), x["text"].alias("text")))
        # a paragraph ends where the next line has a greater number than the following one
        ends = F.transform(F.filter(F.transform(lines, lambda x, k: F.struct((k + 1).alias("at"), (F.get(lines, k + 1)["line"] - x["line"]).alias("gap"))),
                                    lambda e: e["gap"].isNull() | (e["gap"] > 1)), lambda e: e["at"])

        def begun(starts: Column, ends: Column) -> Column:
            def units(s: Column) -> Column:
                near = F.sequence(s["at"], F.least(s["at"] + most - 1, F.size(lines)))
                lasts = F.array_union(near, F.slice(F.filter(ends, lambda e: e >= s["at"]), 1, most))
                return F.transform(lasts, lambda last: F.struct(s["line"].alias("line"), F.array_join(
                    F.transform(F.slice(lines, s["at"], last - s["at"] + 1), lambda x: x["text"]), "\n").alias("unit")))

            return F.flatten(F.transform(starts, units))

        found = F.transform(F.filter(places, lambda x: may_begin(x["text"])), lambda x: F.struct(x["at"].alias("at"), x["line"].alias("line")))
        return let(found, lambda starts: F.when(F.size(starts) > 0, let(ends, lambda stops: begun(starts, stops))))

    numbered = F.filter(F.transform(F.split("text", "\n"), lambda x, k: F.struct((k + 1).alias("line"), x.alias("text"))), solid)
    whole = F.when(F.col("marked") | may_begin(F.col("text")), F.array(F.struct(F.lit(0).alias("line"), F.col("text").alias("unit"))))
    parts = F.concat(F.coalesce(whole, F.array().cast("array<struct<line:int,unit:string>>")),
                     F.coalesce(let(numbered, runs), F.array().cast("array<struct<line:int,unit:string>>")))
    units = rows.select("id", F.explode(parts).alias("u")).select("id", "u.line", "u.unit")
    return (units.select("id", "line", digest(F.col("unit")).alias("digest")).join(broadcast_if_small(known_digests(known)), "digest").groupBy("id", "license")
            .agg((F.min("line") == 0).alias("whole"), F.min("line").alias("first_line")).withColumnRenamed("id", id_col))
