"""Licence scan: licence statements, headers and texts matched to templates by TF-IDF cosine, then inheritance along directories.

Candidates are the lines of a text that name a licence or a copyright, the sentences of such lines, the blocks of
lines around them up to an empty line (headers), and the whole text (licence files), wherever it names a licence.
Templates are usual statements, titles, SPDX tags, standard headers, and full licence texts. A whole text that reaches the
limit goes before blocks, a block before lines and sentences, which may hold for several licences. A candidate is called line below. Its words, and those of the templates, are
weighted by frequency and inverse frequency over all candidates and templates, and the closest template from the limit
on is the line's licence; the closest line is the document's. A document that opens or closes
with its licence line, or is a full licence text, speaks for its directory, as a licence file does. A document without a licence of its own inherits that of the nearest
ancestor directory that has a licence file, found by joining the document's ancestors with the directories.

Built-in functions only. A candidate's text is shuffled once, to be read for its terms; all else knows it by 128 bits. So
with rows: one is known by its path, id and text, so rows that share a path keep licences of their own.

Cases: null and empty texts have no lines and may inherit; very long ones are read whole. Null path parts are written
`none`; a row without an id has a directory of its own. Among equally close lines and templates the first by template name and line is taken, among a
directory's licence files that of the smallest path. Repeated rows each get a row. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import kept

#: Usual statements of well-known licences: fixed texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This program is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "Subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "Proprietary": "Copyright. All rights reserved.",
}
_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details. You should have received a copy of the GNU {0} along with this program. If not, see <https://www.gnu.org/licenses/>."
#: Titles and standard headers.
HEADERS = [
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("Apache-2.0", "Apache License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("GPL-3.0", _GNU.format("General Public License", "3")),
    ("GPL-2.0", _GNU.format("General Public License", "2")),
    ("LGPL-3.0", _GNU.format("Lesser General Public License", "3")),
    ("AGPL-3.0", _GNU.format("Affero General Public License", "3")),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC0-1.0", "CC0 1.0 Universal"),
]
_TAGGED = [k for k in TEMPLATES if k != "Proprietary"] + ["BSD-2-Clause"]
TAGS = [(k, f"SPDX-License-Identifier: {k}{end}") for k in _TAGGED for end in ["", *(("-only", "-or-later") if "GPL" in k else ())]]


FULL = [(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))]


def templates() -> list[tuple[str, str]]:
    """(licence, text) of all templates; full texts are the files of `licence_texts`."""
    return [*TEMPLATES.items(), *HEADERS, *TAGS, *FULL]


#: Least cosine of a match.
COSINE = 0.7

_NAMES = "licen[sc]|copyright|rights reserved|public domain|redistribution|creative commons|permission is hereby"
_TERMS = "filter(split(lower(line), '[^a-z0-9.+-]+'), w -> w rlike '[a-z0-9]')"


def _id(*parts: str) -> Column:
    """128 bits that stand for a text, or for the parts of a row."""
    return F.unhex(F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(p).cast("string"), F.lit("\u0002")) for p in parts])))


def _terms(lines: DataFrame, *keys: str) -> DataFrame:
    """One row per key and term with its count; a stop at a word's end is no part of it."""
    words = lines.select(*keys, F.explode(F.expr(_TERMS)).alias("term"))
    return words.withColumn("term", F.regexp_replace("term", "[.-]+$", "")).where("term <> ''").groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def matched_lines(lines: DataFrame) -> DataFrame:
    """line_id, licence, full (a full text), cosine: the closest template of each text that reaches the limit.

    `lines` holds (line_id, line). A text is read once, for its terms; what follows knows it by its id.
    """
    spark = lines.sparkSession
    texts = templates()
    rows = F.array(*[F.struct(F.lit(k).alias("licence"), F.lit(i).alias("template"), F.lit(v).alias("line")) for i, (k, v) in enumerate(texts)])
    given = spark.range(1).select(F.explode(rows).alias("t")).select("t.*")
    distinct = lines.groupBy("line_id").agg(F.first("line").alias("line"))
    terms = kept(_terms(distinct, "line_id"), "licence-terms")
    known = kept(_terms(given, "licence", "template"), "licence-templates")
    every = terms.select("term").unionAll(known.select("term"))
    count = terms.select("line_id").distinct().count() + len(texts)
    idf = kept(every.groupBy("term").agg(F.log(1 + F.lit(count) / F.count("*")).alias("idf")), "licence-idf")

    def weighted(x: DataFrame) -> DataFrame:
        return x.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))

    def length(x: DataFrame, *keys: str) -> DataFrame:
        return x.groupBy(*keys).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))

    of_lines, of_templates = kept(weighted(terms), "licence-weights"), weighted(known)
    of_templates = of_templates.join(length(of_templates, "licence", "template"), ["licence", "template"])
    # The templates are fixed and few, so their terms may go to every task.
    of_templates = F.broadcast(of_templates.select("licence", "template", "term", (F.col("w") / F.col("length")).alias("b")))
    common = of_lines.join(of_templates, "term").groupBy("line_id", "licence", "template").agg(F.sum(F.col("w") * F.col("b")).alias("common"))
    cosine = common.join(length(of_lines, "line_id"), "line_id").withColumn("cosine", F.round(F.col("common") / F.col("length"), 6))
    best = cosine.groupBy("line_id").agg(F.max_by(F.struct("licence", "template"), F.struct("cosine", "licence")).alias("t"), F.max("cosine").alias("cosine"))
    best = best.select("line_id", "t.licence", (F.col("t.template") >= len(texts) - len(FULL)).alias("full"), "cosine")
    return best.where(F.col("cosine") >= COSINE)


def _unit(kind: int):
    return lambda line: F.struct(F.lit(kind).alias("kind"), line.alias("line"), F.coalesce(F.array_contains("ends", line), F.lit(False)).alias("at_end"))


def scan(files: DataFrame, path: str = "path") -> DataFrame:
    """path, doc_id, licence, origin (own, inherited, none), cosine, licence_path, a row per row of `files`."""
    lines = "filter(split(coalesce(text, ''), '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    parts = "filter(split(coalesce(text, ''), '\\n[\\\\x20\\\\x09\\\\x0D]*\\n'), b -> b rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    files = files.select(F.col(path).alias("path"), "doc_id", "text").withColumn("row_id", _id("path", "doc_id", "text"))
    # Only texts that name a licence have candidates.
    read = files.where(F.lower("text").rlike(_NAMES))
    read = read.select("path", "row_id", F.expr(lines).alias("lines"), F.expr(parts).alias("blocks"))
    named = F.expr(f"filter(lines, l -> lower(l) rlike '{_NAMES}')")
    ends = F.expr("array(get(lines, 0), get(lines, size(lines) - 1))")
    read = read.withColumns({"named": named, "ends": ends})
    sentences = F.expr(f"filter(flatten(transform(named, l -> split(l, '(?<=[.;!?])\\\\s+'))), l -> lower(l) rlike '{_NAMES}')")
    # Blocks of several lines, and the whole text.
    blocks = F.expr(f"filter(blocks, b -> lower(b) rlike '{_NAMES}' and trim(b) like '%\\n%')")
    whole = F.expr("if(size(lines) > 1, array(array_join(lines, '\\n')), array())")
    kinds = [(0, F.array_union("named", sentences)), (1, blocks), (2, whole)]
    units = F.explode(F.flatten(F.array(*[F.transform(found, _unit(k)) for k, found in kinds])))
    found = kept(read.select("path", "row_id", units.alias("unit")).select("path", "row_id", "unit.*").withColumn("line_id", _id("line")), "licence-candidates")
    best = kept(matched_lines(found.select("line_id", "line")), "licence-lines")
    per_line = found.select("path", "row_id", "kind", "at_end", "line_id").join(best, "line_id")
    own = per_line.groupBy("row_id", "path").agg(
        F.max_by(F.struct("licence", "cosine"), F.struct("kind", "cosine", "licence", "line_id")).alias("own"),
        F.max((F.col("at_end") & (F.col("kind") == 0)) | ((F.col("kind") == 2) & F.col("full"))).alias("is_file"),
    )
    own = kept(own, "licence-own")
    directory = F.regexp_replace("path", "/[^/]*$", "")
    folders = own.where("is_file").groupBy(directory.alias("folder")).agg(
        F.min_by(F.struct("path", "own.licence"), F.struct("path", "own.licence")).alias("file")
    )
    folders = kept(folders, "licence-folders")
    # Ancestors of a path: its directory, the one above, and so on; the deepest that has a licence file counts.
    folder = directory.alias("folder")
    places = kept(files.select(folder).distinct(), "folders")
    steps = F.expr("transform(sequence(1, size(split(folder, '/'))), n -> array_join(slice(split(folder, '/'), 1, n), '/'))")
    up = places.select("folder", F.posexplode(steps).alias("depth", "ancestor"))
    nearest = up.join(folders.withColumnRenamed("folder", "ancestor"), "ancestor").groupBy("folder").agg(F.max_by("file", F.col("depth")).alias("file"))
    rows = files.select("path", "doc_id", "row_id", folder)
    out = rows.join(own.select("row_id", "own"), "row_id", "left").join(kept(nearest, "licence-nearest"), "folder", "left")
    origin = F.when(F.col("own").isNotNull(), "own").when(F.col("file").isNotNull(), "inherited").otherwise("none")
    return out.select(
        "path",
        "doc_id",
        F.coalesce("own.licence", "file.licence").alias("licence"),
        origin.alias("origin"),
        F.col("own.cosine").alias("cosine"),
        F.when(F.col("own").isNotNull(), F.col("path")).otherwise(F.col("file.path")).alias("licence_path"),
    )


def with_paths(docs: DataFrame) -> DataFrame:
    """doc_id, text and a path: source, language, a folder per 64 ids, a file per id. Without an id, a folder per text."""
    part = [F.coalesce(F.col(c), F.lit("none")) for c in ("source", "lang")]
    alone = F.concat(F.lit("none/"), F.md5(F.coalesce("text", F.lit(""))))
    number = F.coalesce(F.expr("cast(doc_id div 64 as string)"), alone)
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(".txt"))
    return docs.select("doc_id", "text", F.concat_ws("/", *part, number, name).alias("path"))
