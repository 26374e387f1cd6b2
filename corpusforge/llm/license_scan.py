"""Licences of files: TF-IDF cosine of headers and licence files to templates,
then inheritance from the nearest directory above. SQL functions only.

A text is looked at where it has a licence word: the line around it, also with
the comment lines that go on with it, in windows of some words for long lines,
its first words, and the text as a whole. Each such segment is a sparse TF-IDF
vector; the templates are a fixed, small set, so the join on terms is against a
table of known size. A file whose whole text is like the text of a licence, or
that has a licence file's name and a licence in it, is its directory's licence
file. A file without a licence of its own has that of the nearest directory
above it that has one.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusforge.llm.common import require, written

#: Short licences in full, and notices and opening words of
#: well-known ones, by SPDX identifier.
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. ")
_BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
              "software without specific prior written permission. ")
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
            "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
            "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
            "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
            "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal "
        "in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
        "notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": ("Released under the MIT License", "Licensed under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction", _MIT),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0",
                   "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at",
                   "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License version 2 as published by the Free Software Foundation",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
                "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) Free Software Foundation, Inc."),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License",
                "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    "LGPL-2.1": ("This library is licensed under the GNU Lesser General Public License, version 2.1",
                 "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
                 "by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
                 "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    "LGPL-3.0": ("This library is licensed under the GNU Lesser General Public License, version 3",
                 "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
                 "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
                 "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    "AGPL-3.0": ("Licensed under the GNU Affero General Public License, version 3", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License", "Use of this source code is governed by the simplified BSD license",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted", _BSD + _BSD_END),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted",
                     "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file", _BSD + _BSD_NAMES + _BSD_END),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
                "Licensed under the Mozilla Public License 2.0"),
    "ISC": ("Licensed under the ISC License", "Permission to use, copy, modify, and/or distribute this software for any "
            "purpose with or without fee is hereby granted", _ISC),
    "CC0-1.0": ("Released under CC0 1.0, public domain dedication",
                "To the extent possible under law, the author has waived all copyright and related rights to this work"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "Licensed under the Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0",
                     "Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0",
                     "Licensed under the Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0",),
    "Unlicense": ("This is free and unencumbered software released into the public domain",),
    "Proprietary": ("All rights reserved", "Copyright, all rights reserved, no part may be reproduced without permission"),
}
#: Only where no other licence fits: these words stand in most licences.
LAST = "Proprietary"
for _licence in TEMPLATES:
    if _licence != LAST:
        # Copyleft licences are tagged with what follows the identifier.
        _tags = ("", "-only", "-or-later") if "GPL" in _licence else ("",)
        TEMPLATES[_licence] += tuple(f"SPDX-License-Identifier: {_licence}{tag}" for tag in _tags)
#: Words that a template has at least if it is more than a notice.
FULL = 60
CUE = (r"(?i)licen[sc]|copyright|\bspdx-|public domain|rights reserved|redistribut|permission (?:is hereby|to use)"
       r"|creative commons|mozilla public|\bgpl")
FILE_NAME = r"(?i)^(?:licen[sc]e|copying|unlicense|notice)(?:[._-].*)?$"
#: Words on both sides of a licence word that belong to a segment.
AROUND = 12


def terms(text: Column) -> Column:
    """Words in lower case; versions ("2.0") and names ("by-nc") stay whole."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]++(?:[.-][\p{L}\p{N}]++)*"), F.lit(0))


def _python_terms(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", text.lower())


def segments(text: Column) -> Column:
    """The places of a text that speak of a licence, its first words, then the whole text."""
    # A comment line goes on with the one before it.
    joined = F.regexp_replace(text, r"\n[ \t]*(?:#+|//+|\*+|--+|;+|%+)[ \t]+(?=\S)", " ")
    lines = F.filter(F.array_distinct(F.concat(F.split(text, r"\n"), F.split(joined, r"\n"))), lambda line: line.rlike(CUE))
    head = F.array_join(F.slice(F.split(F.trim(F.left(text, F.lit(4000))), r"\s+"), 1, 2 * AROUND), " ")

    def windows(line: Column) -> Column:
        words = F.split(F.trim(line), r"\s+")
        at = F.filter(F.transform(words, lambda w, i: F.when(w.rlike(r"(?i)licen[sc]|copyright|spdx-|rights|domain|commons|redistribut|permission|public|gpl"), i)),
                      lambda i: i.isNotNull())
        first = F.greatest(F.array_min(at) - AROUND, F.lit(0))
        near = F.transform(at, lambda i: F.array_join(F.slice(words, F.greatest(i - AROUND, F.lit(0)) + 1, F.lit(2 * AROUND + 1)), " "))
        return F.when(F.size(words) <= 2 * AROUND, F.array(line)).when(
            F.array_max(at) - first <= 2 * AROUND, F.array(F.array_join(F.slice(words, first + 1, F.lit(3 * AROUND)), " "))).otherwise(near)

    return F.array_distinct(F.concat(F.flatten(F.transform(lines, windows)), F.array(head, text)))


def _templates(spark, idf: dict[str, float], unknown: float) -> DataFrame:
    """(template, licence, full, term, w): unit vectors of the templates."""
    rows, number = [], 0
    for licence, texts in TEMPLATES.items():
        for text in texts:
            words = _python_terms(text)
            weights = {t: words.count(t) * idf.get(t, unknown) for t in set(words)}
            length = sum(w * w for w in weights.values()) ** 0.5
            rows += [(number, licence, len(words) >= FULL, t, w / length) for t, w in weights.items()]
            number += 1
    return spark.createDataFrame(rows, "template int, licence string, full boolean, term string, w double")


def match(docs: DataFrame, id_column: str, text: str, at_least: float = 0.55) -> DataFrame:
    """(id, licence, score, whole): the best template of each text that has one.

    Document frequencies of the templates' terms count all documents; a term that
    no template has counts as the rarest. `whole` tells whether the text as a
    whole is like the full text of that licence. A reserved right is a licence
    only where no other one fits; ties go to the licence that sorts first.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cut = rows.filter(F.col("text").rlike(CUE)).select("id", segments(F.col("text")).alias("parts"))
    tokens = cut.select("id", F.size("parts").alias("n"), F.posexplode("parts").alias("part", "text")).select(
        "id", (F.col("part") == F.col("n") - 1).alias("whole"), F.xxhash64("text").alias("segment"), F.explode(terms(F.col("text"))).alias("term"))
    # Rows with equal id and text are one document here.
    counted = written(tokens.groupBy("id", "whole", "segment", "term").agg(F.count("*").alias("tf")), "license-terms")

    known = sorted({t for texts in TEMPLATES.values() for text in texts for t in _python_terms(text)})
    total = rows.count()
    # One pass over all texts; at most one row a term of the templates comes back.
    listed = F.lit(known)
    held = rows.select(F.explode(F.array_intersect(terms(F.col("text")), listed)).alias("term"))
    seen = {r["term"]: r["n"] for r in held.groupBy("term").agg(F.count("*").alias("n")).collect()}
    # The templates themselves count too, so that no term is without weight.
    idf = {t: float(math.log((total + 2) / (seen.get(t, 0) + 1)) + 0.1) for t in known}
    unknown = float(math.log(total + 2) + 0.1)
    rarity = spark.createDataFrame(list(idf.items()), "term string, idf double")
    weighed = counted.join(F.broadcast(rarity), "term", "left").withColumn("x", F.col("tf") * F.coalesce("idf", F.lit(unknown)))
    length = weighed.groupBy("id", "whole", "segment").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
    dot = (weighed.join(F.broadcast(_templates(spark, idf, unknown)), "term").groupBy("id", "whole", "segment", "template", "licence", "full")
           .agg(F.sum(F.col("x") * F.col("w")).alias("dot")))
    scored = dot.join(length, ["id", "whole", "segment"]).withColumn("score", F.round(F.col("dot") / F.col("length"), 9))
    reserved = F.col("licence") == LAST
    best = F.row_number().over(Window.partitionBy("id").orderBy(reserved, F.desc("score"), "licence", F.desc("whole")))
    # The full text of a licence, alone in a file, is that file's licence, whatever lines of it are like.
    full = F.when(F.col("whole") & F.col("full"), F.struct("score", "licence"))
    chosen = scored.filter(F.col("score") >= at_least).withColumn("place", best).withColumn("text", F.max(full).over(Window.partitionBy("id")))
    return chosen.filter("place = 1").select(
        "id", F.coalesce("text.licence", "licence").alias("licence"), F.coalesce("text.score", "score").alias("score"), F.col("text").isNotNull().alias("whole"))


def scan(docs: DataFrame, id_column: str = "doc_id", path: str = "path", text: str = "text",
         at_least: float = 0.55) -> DataFrame:
    """One row per row of `docs`: id, licence, origin, score, licensed_at.

    origin is "file" (the text is a licence), "header" (it names one),
    "inherited" (from `licensed_at`, the nearest directory with a licence file;
    score is the file's) or "none". A directory with several licence files has
    the one with the best score, then the smallest path. A NULL path has no
    directory; NULL and empty texts can only inherit; repeated rows are kept;
    equal ids share their texts' best licence.
    """
    require(docs, [id_column, path, text])
    own = written(match(docs, id_column, text, at_least), "licences")
    files = docs.select(F.col(id_column).alias("id"), F.col(path).alias("path")).join(own, "id", "left")
    name, folder = F.substring_index("path", "/", -1), F.regexp_replace("path", r"/?[^/]*$", "")
    files = files.withColumns({"folder": folder, "file": F.col("whole") | (F.col("licence").isNotNull() & name.rlike(FILE_NAME))})
    best = F.min_by(F.struct("licence", "score"), F.struct(-F.col("score"), F.col("path")))
    licensed = files.filter(F.col("file") & F.col("folder").isNotNull()).groupBy("folder").agg(best.alias("best"))
    licensed = licensed.select(F.col("folder").alias("above"), F.col("best.licence").alias("given"), F.col("best.score").alias("given_score"))

    # Directories first: a directory with a third of all files is one row here.
    folders = files.filter(F.col("licence").isNull() & F.col("folder").isNotNull()).select("folder").distinct()
    steps = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    nearest = (folders.withColumn("above", F.explode(F.array_distinct(above))).join(licensed, "above")
               .groupBy("folder").agg(F.max_by(F.struct("above", "given", "given_score"), F.length("above")).alias("from"))
               .select("folder", "from.*"))
    done = files.join(nearest, "folder", "left")
    inherits = F.col("licence").isNull() & F.col("given").isNotNull()
    origin = (F.when(F.col("file"), "file").when(F.col("licence").isNotNull(), "header")
              .when(inherits, "inherited").otherwise("none"))
    return done.select(F.col("id").alias(id_column), F.coalesce("licence", "given").alias("licence"), origin.alias("origin"),
                       F.when(F.col("licence").isNotNull(), F.col("score")).otherwise(F.col("given_score")).alias("score"),
                       F.when(inherits, F.col("above")).alias("licensed_at"))
