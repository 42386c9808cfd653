"""Operator 2 [native]: licence of every file by header, licence file or directory.

A file is compared with the templates in units: every line, every two adjacent
lines (a statement wrapped once), every paragraph, the leading comment lines
joined (the header) and the whole text (the licence file).  Units and templates
are sparse TF-IDF vectors; document frequencies count all files and templates.
A file's own licence is the best cosine of its units at ``LEAST`` or more.

Units that cannot reach ``least`` never leave the scan, by two exact bounds on
the template's unit vector v: terms missing in the unit add nothing, so the
squares of the shared v sum to ``least`` squared or more.  The unit therefore
holds one of the template's rarest terms (the shortest prefix by weight whose
rest falls under the bound), and at least as many of its terms as the largest
squares need to reach the bound.  Remaining units are joined with the templates
on their shared terms.

A licence file is one in which a unit at ``least`` or more holds at least half
of its terms (or whose name says so); the best one of a directory is the
directory's licence.  Files without their own take that of the nearest ancestor
directory that has one, found by joining the directory's prefixes with the
licensed directories.  ``statements`` may be any table of templates, whole
licence texts included; it is a stated table, its terms pass the driver.

Term weights are rounded to 9 decimals before they are summed as decimals, so
results do not depend on the order of summation.

Defined results: a null or empty text has no units; a null path is a file of
its own without directory; ties go to the licence (then the path) that sorts
first; repeated rows give repeated rows; very long texts are read whole; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import written

LEAST = 0.5
NAMES = r"(?i)(^|/)(licen[sc]e|copying|notice)([.][a-z]+)?$"
#: Leading lines that begin so are the header of a file.
COMMENT = r"^[ \t]*(#|//|/[*]|[*]|--|;|%|<!--)"
#: Lines without a letter or digit part paragraphs.
PARAGRAPH = "\n[^A-Za-z0-9\n]*\n"
#: Licence identifiers, header statements and licence texts.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under the CC0 1.0 license."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
     "compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
     'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
     "either express or implied. See the License for the specific language governing permissions and limitations "
     "under the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR "
     'USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. "License" shall mean the terms and conditions for use, '
     "reproduction, and distribution as defined by Sections 1 through 9 of this document. \"Licensor\" shall mean the "
     "copyright owner or entity authorized by the copyright owner that is granting the License. \"Legal Entity\" shall "
     "mean the union of the acting entity and all other entities that control, are controlled by, or are under common "
     'control with that entity. "You" (or "Your") shall mean an individual or Legal Entity exercising permissions '
     'granted by this License. "Source" form shall mean the preferred form for making modifications, including but not '
     'limited to software source code, documentation source, and configuration files. "Object" form shall mean any '
     "form resulting from mechanical transformation or translation of a Source form, including but not limited to "
     'compiled object code, generated documentation, and conversions to other media types. "Derivative Works" shall '
     "mean any work, whether in Source or Object form, that is based on (or derived from) the Work and for which the "
     "editorial revisions, annotations, elaborations, or other modifications represent, as a whole, an original work "
     'of authorship. "Contribution" shall mean any work of authorship that is intentionally submitted to Licensor for '
     'inclusion in the Work by the copyright owner. "Contributor" shall mean Licensor and any individual or Legal '
     "Entity on behalf of whom a Contribution has been received by Licensor and subsequently incorporated within the "
     "Work. 2. Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor "
     "hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright "
     "license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and "
     "distribute the Work and such Derivative Works in Source or Object form. 3. Grant of Patent License. to make, "
     "have made, use, offer to sell, sell, import, and otherwise transfer the Work. If You institute patent litigation "
     "against any entity alleging that the Work constitutes direct or contributory patent infringement, then any "
     "patent licenses granted to You under this License for that Work shall terminate as of the date such litigation "
     "is filed. 4. Redistribution. You must cause any modified files to carry prominent notices stating that You "
     "changed the files; You must retain all copyright, patent, trademark, and attribution notices; a readable copy "
     "of the attribution notices contained within such NOTICE file. 5. Submission of Contributions. 6. Trademarks. "
     "7. Disclaimer of Warranty. TITLE, NON-INFRINGEMENT, MERCHANTABILITY, or FITNESS FOR A PARTICULAR PURPOSE. "
     "8. Limitation of Liability. In no event and under no legal theory, whether in tort (including negligence), "
     "contract, or otherwise, shall any Contributor be liable to You for damages, including any direct, indirect, "
     "special, incidental, or consequential damages. 9. Accepting Warranty or Additional Liability. You may choose to "
     "offer, and charge a fee for, acceptance of support, warranty, indemnity, or other liability obligations."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
     "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
     'the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
     "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
     "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
     "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
     "OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met: 1. Redistributions of source code must retain the above "
     "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
     "reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
     "and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met: 1. Redistributions of source code must retain the above "
     "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
     "reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
     "and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names "
     "of its contributors may be used to endorse or promote products derived from this software without specific prior "
     "written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
     "your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at "
     "your option) any later version."),
)


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *t) for i, t in enumerate(TEMPLATES)],
                                 "template int, licence string, statement string")


def _terms(text: str | Column) -> Column:
    """Lower-case words.  A dotted capital I ends a word: engines lower it differently."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(F.replace(c, F.lit("\u0130"), F.lit(" "))), F.lit("[a-z0-9]+"), F.lit(0))


def _fixed(c: Column) -> Column:
    return F.round(c, 9).cast("decimal(20,9)")


def _vectors(counts: DataFrame, idf: DataFrame, keys: list[str]) -> DataFrame:
    """keys, term, w: unit vectors from keys, term, tf."""
    v = counts.join(idf, "term").withColumn("x", (F.lit(1.0) + F.log(F.col("tf").cast("double"))) * F.col("idf"))
    norm = F.sqrt(F.sum(_fixed(F.col("x") * F.col("x"))).over(Window.partitionBy(*keys)).cast("double"))
    return v.select(*keys, "term", (F.col("x") / norm).alias("w"))


def frequencies(files: DataFrame, statements: DataFrame) -> DataFrame:
    """term, idf over all files and templates."""
    distinct = lambda df, c: df.select(F.explode(F.array_distinct(_terms(c))).alias("term"))
    df = (distinct(files, "text").groupBy("term").agg(F.count("*").alias("n"))
          .union(distinct(statements, "statement").groupBy("term").agg(F.count("*")))
          .groupBy("term").agg(F.sum("n").alias("df")))
    total = float(files.count() + statements.count())
    return written(df.select("term", (F.log(F.lit(1.0 + total) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf")))


def reaches(vectors: DataFrame, least: float):
    """A condition on an array of terms: can a unit of them reach ``least`` with some template?"""
    bound = (least - 1e-5) ** 2        # cosines are rounded to 6 decimals
    by: dict[int, list] = {}
    for r in vectors.collect():        # the terms of the stated templates
        by.setdefault(r.template, []).append((-r.w * r.w, r.term))
    limits = []
    for terms in by.values():
        terms.sort()
        upto = list(accumulate(-x for x, _ in terms))
        limits.append({"terms": [t for _, t in terms],
                       "prefix": [t for (x, t), s in zip(terms, upto) if upto[-1] - s - x >= bound],
                       "need": 1 + sum(s < bound for s in upto)})
    vocabulary = F.lit(sorted({t for x in limits for t in x["terms"]}) or [""])
    limits = F.from_json(F.lit(json.dumps(limits)), "array<struct<terms:array<string>,prefix:array<string>,need:int>>")

    def condition(terms: Column) -> Column:
        # the outer lambda keeps the terms from being cut once for each template
        return F.exists(F.array(F.array_intersect(terms, vocabulary)), lambda held: F.exists(
            limits, lambda t: F.arrays_overlap(held, t["prefix"])
            & (F.size(F.array_intersect(held, t["terms"])) >= t["need"])))
    return condition


def _units(text: str) -> Column:
    """Lines, adjacent lines, paragraphs, header and whole text as space-joined terms, each once."""
    lines = F.split(text, "\n")
    rest = F.size(lines) - 1
    pairs = F.zip_with(F.slice(lines, 1, rest), F.slice(lines, 2, rest), lambda a, b: F.concat(a, F.lit("\n"), b))
    code = F.array_position(F.transform(lines, lambda x: ~x.rlike(COMMENT)), True)
    header = F.array_join(F.slice(lines, 1, F.when(code == 0, F.size(lines)).otherwise(code - 1).cast("int")), "\n")
    texts = F.concat(lines, pairs, F.split(text, PARAGRAPH), F.array(header, F.col(text)))
    return F.array_distinct(F.transform(texts, lambda x: F.array_join(_terms(x), " ")))


def unit_matches(units: DataFrame, vectors: DataFrame, idf: DataFrame, least: float) -> DataFrame:
    """u, licence, cosine: the best template of each distinct unit, at ``least`` or more."""
    counts = (units.dropDuplicates(["u"]).select("u", F.explode(F.split("unit", " ")).alias("term"))
              .groupBy("u", "term").agg(F.count("*").alias("tf")))
    cosine = (_vectors(counts, idf, ["u"]).join(vectors.withColumnRenamed("w", "v"), "term")
              .groupBy("u", "template", "licence")
              .agg(F.sum(_fixed(F.col("w") * F.col("v"))).cast("double").alias("cosine")))
    best = Window.partitionBy("u").orderBy(F.desc("cosine"), "licence", "template")
    return (cosine.withColumn("r", F.row_number().over(best)).where("r = 1")
            .select("u", "licence", F.round("cosine", 6).alias("cosine")).where(F.col("cosine") >= least))


def scan(files: DataFrame, statements: DataFrame | None = None, file: str = "doc_id", path: str = "path",
         text: str = "text", least: float = LEAST) -> DataFrame:
    """file, path, licence, how (own, inherited, none), cosine, from_dir of every row of ``files``."""
    spark = files.sparkSession
    statements = templates(spark) if statements is None else statements
    files = files.select(files[file].alias("file"), files[path].alias("path"), files[text].alias("text"))
    idf = frequencies(files, statements)
    tmpl = (statements.select("template", "licence", F.explode(_terms("statement")).alias("term"))
            .groupBy("template", "licence", "term").agg(F.count("*").alias("tf")))
    vectors = written(_vectors(tmpl, idf, ["template", "licence"]))
    possible = reaches(vectors, least)
    # rows are told apart by (path, hash of the text)
    units = written(
        files.where(possible(_terms("text"))).select("path", F.xxhash64("text").alias("h"), "text").distinct()
        .select("path", "h", F.size(_terms("text")).alias("size"), F.explode(_units("text")).alias("unit"))
        .where(possible(F.split("unit", " ")))
        .select("path", "h", "size", "unit", F.sha2("unit", 256).alias("u")))
    found = (units.select("path", "h", "u", (F.size(F.split("unit", " ")) * 2 >= F.col("size")).alias("whole"))
             .join(unit_matches(units, vectors, idf, least), "u"))
    best = F.struct((-F.col("cosine")).alias("c"), "licence")
    own = written(found.groupBy("path", "h").agg(F.min(best).alias("best"), F.max("whole").alias("whole"))
                  .select("path", "h", "best.licence", (-F.col("best.c")).alias("cosine"),
                          (F.col("whole") | F.col("path").rlike(NAMES)).alias("is_file")))
    top = Window.partitionBy("dir").orderBy(F.desc("cosine"), "licence", "path")
    licensed = written(own.where("is_file and path is not null").withColumn("dir", directory("path"))
                       .withColumn("r", F.row_number().over(top)).where("r = 1")
                       .select("dir", F.col("licence").alias("dir_licence")))
    dirs = files.where("path is not null").select(directory("path").alias("dir")).distinct()
    parts = F.split("dir", "/")
    above = dirs.select("dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth")).select(
        F.col("dir").alias("of"), "depth", F.array_join(F.slice(parts, 1, F.col("depth")), "/").alias("dir"))
    nearest = written(above.join(licensed, "dir").groupBy("of")
               .agg(F.max(F.struct("depth", "dir", "dir_licence")).alias("n"))
               .select(F.col("of").alias("dir"), F.col("n.dir").alias("from_dir"),
                       F.col("n.dir_licence").alias("dir_licence")))
    rows = files.select("file", "path", F.xxhash64("text").alias("h"), directory("path").alias("dir"))
    out = (rows.join(own.drop("is_file").withColumnRenamed("path", "p").withColumnRenamed("h", "hh"),
                     F.col("path").eqNullSafe(F.col("p")) & (F.col("h") == F.col("hh")), "left")
           .join(nearest, "dir", "left"))
    mine = F.col("licence").isNotNull()
    return out.select(
        F.col("file").alias(file), "path", F.coalesce("licence", "dir_licence").alias("licence"),
        F.when(mine, "own").when(F.col("dir_licence").isNotNull(), "inherited").otherwise("none").alias("how"),
        "cosine", F.when(~mine, F.col("from_dir")).alias("from_dir"))


def directory(path: str) -> Column:
    """Everything before the last slash; '' at the top."""
    return F.regexp_replace(F.col(path), "/?[^/]*$", "")


#: Texts of fewer characters lie in their language's directory, others one below.
SHORT = 600


def document_path() -> Column:
    """The registered query's paths: source/lang[/block]/doc_id.txt."""
    block = F.when(F.length("text") >= SHORT, F.concat(F.lit("/"), F.expr("doc_id div 100").cast("string")))
    return F.concat(F.coalesce("source", F.lit("none")), F.lit("/"), F.coalesce("lang", F.lit("none")),
                    F.coalesce(block, F.lit("")), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))


def oracle_sql() -> str:
    """DuckDB SQL of the registered query."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({i}, {quoted(a)}, {quoted(b)})" for i, (a, b) in enumerate(TEMPLATES))
    terms = lambda c: f"regexp_extract_all(lower(replace({c}, chr(304), ' ')), '[a-z0-9]+')"
    unit = lambda src, keys: f"""  # noqa: E731
      SELECT {keys}, term, x / sqrt(CAST(sum(CAST(round(x * x, 9) AS DECIMAL(20,9))) OVER (PARTITION BY {keys})
        AS DOUBLE)) AS w FROM (SELECT {keys}, term, (1.0::DOUBLE + ln(tf::DOUBLE)) * idf AS x
        FROM {src} JOIN idf USING (term))""".replace("  # noqa: E731", "")
    return f"""
WITH files AS (
  SELECT doc_id, text, coalesce(source, 'none') || '/' || coalesce(lang, 'none') ||
    CASE WHEN length(text) >= {SHORT} THEN '/' || (doc_id // 100) ELSE '' END || '/' || doc_id || '.txt' AS path
  FROM documents),
tmpl(template, licence, statement) AS (VALUES {rows}),
cut AS (
  SELECT doc_id, text, len({terms("text")}) AS size, string_split(text, chr(10)) AS lines,
    list_position([NOT regexp_matches(x, {quoted(COMMENT)}) FOR x IN string_split(text, chr(10))], true)
      AS code FROM files WHERE text IS NOT NULL),
units AS (
  SELECT doc_id, size, unnest(list_distinct([array_to_string({terms("x")}, ' ') FOR x IN list_concat(
      lines, [lines[i] || chr(10) || lines[i + 1] FOR i IN range(1, len(lines))],
      string_split_regex(text, '\n[^A-Za-z0-9\n]*\n'),
      [array_to_string(lines[1:CASE WHEN coalesce(code, 0) = 0 THEN len(lines) ELSE code - 1 END], chr(10)), text])])) AS unit
  FROM cut),
lt AS (SELECT unit, term, count(*) AS tf FROM (
  SELECT unit, unnest(string_split(unit, ' ')) AS term FROM (SELECT DISTINCT unit FROM units)) GROUP BY ALL),
tt AS (SELECT template, licence, term, count(*) AS tf
  FROM (SELECT template, licence, unnest({terms("statement")}) AS term FROM tmpl) GROUP BY ALL),
df AS (
  SELECT term, count(*) AS df FROM (
    SELECT unnest(list_distinct({terms("text")})) AS term FROM files
    UNION ALL SELECT unnest(list_distinct({terms("statement")})) FROM tmpl) GROUP BY term),
idf AS (
  SELECT term, ln((1.0::DOUBLE + ((SELECT count(*) FROM files) + (SELECT count(*) FROM tmpl))::DOUBLE)
    / (1.0::DOUBLE + df::DOUBLE)) + 1.0 AS idf FROM df),
a AS ({unit("lt", "unit")}),
b AS ({unit("tt", "template, licence")}),
cosines AS (
  SELECT unit, template, licence, CAST(sum(CAST(round(a.w * b.w, 9) AS DECIMAL(20,9))) AS DOUBLE) AS cosine
  FROM a JOIN b USING (term) GROUP BY ALL),
matches AS (
  SELECT unit, licence, round(cosine, 6) AS cosine FROM cosines
  QUALIFY row_number() OVER (PARTITION BY unit ORDER BY cosine DESC, licence, template) = 1),
own AS (
  SELECT doc_id, path, licence, cosine, whole AS is_file FROM (
    SELECT doc_id, licence, cosine, bool_or(2 * len(string_split(unit, ' ')) >= size) OVER (PARTITION BY doc_id)
      AS whole, row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, licence) AS r
    FROM units JOIN matches USING (unit) WHERE cosine >= {LEAST}) JOIN files USING (doc_id) WHERE r = 1),
licensed AS (
  SELECT regexp_replace(path, '/?[^/]*$', '') AS dir, licence FROM own WHERE is_file
  QUALIFY row_number() OVER (PARTITION BY regexp_replace(path, '/?[^/]*$', '')
    ORDER BY cosine DESC, licence, path) = 1),
up AS (
  SELECT doc_id, l.dir, l.licence FROM files f JOIN licensed l ON starts_with(path, l.dir || '/')
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(l.dir) DESC) = 1)
SELECT f.doc_id, f.path, coalesce(own.licence, up.licence) AS licence,
  CASE WHEN own.licence IS NOT NULL THEN 'own' WHEN up.licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS how,
  own.cosine, CASE WHEN own.licence IS NULL THEN up.dir END AS from_dir
FROM files f LEFT JOIN own USING (doc_id) LEFT JOIN up USING (doc_id)
"""
