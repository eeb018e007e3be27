"""Licence scans: whole texts looked up by the digest of their canonical form, and so their blocks and lines."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendloom.llm.common import literal_table

#: The full texts of licences as they are published, a file each, named by identifier.
TEXTS = Path(__file__).parent / "licence_texts"
#: What follows this line in a licence is advice on how to use it, which most copies leave out.
END = "END OF TERMS AND CONDITIONS"
#: A first block of so many words or fewer is a heading; copies have their own or none.
HEADING = 12
#: Licence notices as they are published, by identifier.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)
#: Spellings that count as the same, after lower-casing and with white space as single spaces.
SPELLINGS = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("organisation", "organization"),
    ("merchantibility", "merchantability"),
    ("non infringement", "noninfringement"),
    ("non commercial", "noncommercial"),
    ("third parties", "thirdparties"),
    ("favour", "favor"),
    ("neighbouring", "neighboring"),
    ("acknowledgement", "acknowledgment"),
    ("copyright owner", "copyright holder"),
    ("https", "http"),
)
_LINE = r"^[^\S\n]*[#*/;%-]*[^\S\n]*"
_YEARS = r"(?:[^\S\n]*[-–,]?[^\S\n]*(?:[0-9]{4}|present)\b)*,?"
#: A copyright claim with its years. "(c)" alone needs a year, as lists have it too.
_CLAIM = rf"(?:copyright[^\S\n]*(?:(?:\(c\)|©|:|by\b)(?:[^\S\n]*by\b)?|[0-9]{{4}}|[<\[{{])|©|\(c\)[^\S\n]*[0-9]{{4}}){_YEARS}"
#: Words that the name of a holder has at most.
HOLDER = 12
_WORD = r"[^\s]+[^\S\n]+"
#: Patterns and what is put in their place, in order, for lines that begin with a claim: what goes are the claim and its
#: years, and the holder up to a licence that follows, or else up to the end of the sentence, or of the line. A claim that is
#: followed by more words than a holder has, without an end, loses its years only.
COPYRIGHT = (
    (rf"(?m){_LINE}{_CLAIM}[^\S\n]*(?:{_WORD}){{0,{HOLDER}}}?(licen[sc]ed under|released under|permission is|permission to|redistribution and|this program|this file|this work)\b", "$1"),
    (rf"(?m){_LINE}{_CLAIM}[^\S\n]*(?:{_WORD}){{0,{HOLDER - 1}}}?[^\s]*[.!?]([^\S\n]|$)", "$1"),
    (rf"(?m){_LINE}{_CLAIM}[^\S\n]*(?:{_WORD}){{0,{HOLDER - 1}}}[^\s]*[^\S\n]*$", ""),
    (rf"(?m){_LINE}{_CLAIM}", ""),
    (rf"(?m){_LINE}all rights reserved\b[.]?", ""),
)
LIST_MARK = rf"(?m){_LINE}\(?[0-9a-z][0-9]?[.)][^\S\n]+"
NOT_WORD = "[^\\p{L}\\p{N}\\n]+"


def canonical_lines(text: Column) -> Column:
    """A text in lower case without claims of copyright, list marks and punctuation (typographic too), in common spelling;
    its line breaks stay, and so does what follows a claim in its line."""
    out = F.lower(text)
    claims = out.contains("copyright") | out.contains("(c)") | out.contains("©") | out.contains("all rights reserved")
    without = out
    for pattern, by in COPYRIGHT:
        without = F.regexp_replace(without, pattern, by)
    out = F.when(claims, without).otherwise(out)
    for pattern, by in ((LIST_MARK, ""), (NOT_WORD, " ")):
        out = F.regexp_replace(out, pattern, by)
    other = out
    for spelling, common in SPELLINGS:
        other = F.regexp_replace(other, rf"\b{spelling}\b", common)
    out = F.when(out.rlike(rf"\b({'|'.join(a for a, _ in SPELLINGS)})\b"), other).otherwise(out)
    return F.replace(F.replace(out, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))


def digest(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def blocks_of(lines: Column) -> Column:
    """The blocks of canonical lines, which lines without words divide, each as one text."""
    return F.filter(F.transform(F.split(lines, "\n\n+"), lambda b: F.trim(F.replace(b, F.lit("\n"), F.lit(" ")))), lambda b: b != "")


def headless(blocks: Column) -> Column:
    """The blocks without a heading."""
    short = (F.size(blocks) > 1) & (F.size(F.split(blocks[0], " ")) <= HEADING)
    return F.when(short, F.slice(blocks, 2, 1 << 20)).otherwise(blocks)


def published_texts() -> tuple[tuple[str, str], ...]:
    """(licence, text) of the full texts; those with advice at their end come again without it."""
    out = []
    for path in sorted(TEXTS.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        out += [(path.stem, text.split(END)[0]), (path.stem, text)] if END in text else [(path.stem, text)]
    return tuple(out)


def _known(spark: SparkSession, texts: tuple[tuple[str, str], ...]) -> DataFrame:
    """(licence, whole, bare, blocks) of known texts: digests with and without heading, and of the blocks without it."""
    rows = literal_table(spark, json.dumps([{"licence": a, "text": b} for a, b in texts]), "licence: string, text: string")
    rows = rows.select("licence", blocks_of(canonical_lines(F.col("text"))).alias("all")).withColumn("own", headless(F.col("all")))
    return rows.select("licence", digest(F.array_join("all", " ")).alias("whole"), digest(F.array_join("own", " ")).alias("bare"), F.transform("own", digest).alias("blocks"), F.transform("own", F.length).alias("lengths"))


def known_digests(spark: SparkSession, texts: tuple[tuple[str, str], ...]) -> DataFrame:
    """(digest, licence) of the known texts, with and without heading; one row a digest."""
    return _known(spark, texts).select("licence", F.explode(F.array("whole", "bare")).alias("digest")).groupBy("digest").agg(F.min("licence").alias("licence"))


def _lookup(pairs: dict[str, Column], kind: str) -> Column:
    if not pairs:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast(f"array<{kind}>"))
    return F.create_map(*(x for key, value in sorted(pairs.items()) for x in (F.lit(key), value)))


def scan_licences(docs: DataFrame, notices: tuple[tuple[str, str], ...] = NOTICES, texts: tuple[tuple[str, str], ...] | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_digest, text_licence, n_licence_lines, line_licences, block_licences) of each document.

    The canonical form of the whole text, and that without its heading, are hash-joined to the digests of the known texts:
    `texts` (the published licences if not given) and `notices`. As licences are mostly part of a longer text, notices are
    also looked up among its lines, and among its blocks, which blank lines divide, so that one that is wrapped or stands in
    a comment is found; a licence of several blocks is found where a text holds them all. line_licences and block_licences
    have each licence once, in order, joined by commas.

    The known texts are few and fit a broadcast and maps; documents aren't shuffled. Null, empty and blank texts have the
    digest of the empty text, which no licence has; a long text is looked at whole. Repeated rows are scanned each, an empty
    table gives none; other columns are not carried.
    """
    spark, texts = docs.sparkSession, published_texts() if texts is None else texts
    known = F.broadcast(known_digests(spark, (*notices, *texts)))
    of_notice = {r.bare: F.lit(r.licence) for r in _known(spark, tuple(sorted(notices, reverse=True))).collect()}
    by_longest: dict[str, list[Column]] = {}
    for r in _known(spark, texts).orderBy("licence", "whole").collect():
        longest = max(zip(r.lengths, r.blocks, strict=True))[1]
        by_longest.setdefault(longest, []).append(F.struct(F.lit(r.licence).alias("licence"), F.array(*map(F.lit, r.blocks)).alias("blocks")))
    notice_of, text_of = _lookup(of_notice, "string"), _lookup({k: F.array(*v) for k, v in by_longest.items()}, "array<struct<licence: string, blocks: array<string>>>")

    lines = canonical_lines(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(id).alias("id"), lines.alias("lines")).select("id", "lines", blocks_of(F.col("lines")).alias("blocks"))
    rows = rows.select("id", digest(F.array_join("blocks", " ")).alias("text_digest"), digest(F.array_join(headless(F.col("blocks")), " ")).alias("bare"), F.transform(F.split("lines", "\n"), lambda x: digest(F.trim(x))).alias("lines"), F.transform("blocks", digest).alias("blocks"))
    in_lines = F.filter(F.transform("lines", lambda x: F.try_element_at(notice_of, x)), lambda x: x.isNotNull())
    in_blocks = F.filter(F.transform("blocks", lambda x: F.try_element_at(notice_of, x)), lambda x: x.isNotNull())
    may_hold = F.flatten(F.filter(F.transform("blocks", lambda x: F.try_element_at(text_of, x)), lambda x: x.isNotNull()))
    held = F.transform(F.filter(may_hold, lambda k: F.size(F.array_except(k["blocks"], F.col("blocks"))) == 0), lambda k: k["licence"])
    found = rows.select("id", "text_digest", "bare", in_lines.alias("in_lines"), F.concat(in_blocks, held).alias("in_blocks"))
    for column, name in (("text_digest", "whole_licence"), ("bare", "bare_licence")):
        found = found.join(known.withColumnsRenamed({"digest": column, "licence": name}), column, "left")

    def names(found: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(found)), ",")

    return found.select(F.col("id").alias(id), "text_digest", F.coalesce("whole_licence", "bare_licence").alias("text_licence"), F.size("in_lines").cast("long").alias("n_licence_lines"), names("in_lines").alias("line_licences"), names("in_blocks").alias("block_licences"))
