"""Licences of files: cosine of notices to templates, and inheritance by directory.

Terms are runs of ASCII letters and digits and of all else beyond ASCII, A-Z in lower
case. A term weighs (1 + ln count) * ln(1 + N / templates that have it), with N the number
of templates; terms that no template has weigh as those of one do, so words beside a
notice count against it.

Notices may stand anywhere. Of every text each line, each paragraph (between blank lines)
and the whole are compared with every template, and the best template of a unit counts if
the cosine is at least `threshold`. Only units with a key term are compared, which loses
none: key terms are chosen so that what a template has besides is shorter than
`threshold` times the template, so a unit without a key term can't reach it. Of the others, those with too little
of every template or too much besides go by a bound (`may_reach`) that loses none either.

A file named like a licence (LICENSE, LICENCE, COPYING, UNLICENSE, COPYRIGHT or NOTICE,
with any ending) gives its licence to all files of its directory and those below that have
none of their own; the deepest such directory counts, and in one directory the best score,
then the least name. Paths are parted by slashes; a null path inherits nothing. Null and
empty texts have no licence of their own. Of equal cosines the least licence counts.
Rows with the same id and text get the same licence of their own.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import ascii_lower

#: Licence and text of a notice.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
     "to whom the Software is furnished to do so, subject to the following conditions: The above "
     "copyright notice and this permission notice shall be included in all copies or substantial "
     "portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
     "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
     "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
     "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
     "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
     "USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
     "this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
     "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
     "specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation, either "
     "version 3 of the License, or (at your option) any later version. This program is distributed "
     "in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
     "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
     "License for more details."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, "
     "are permitted provided that the following conditions are met: Redistributions of source code "
     "must retain the above copyright notice, this list of conditions and the following disclaimer. "
     "Redistributions in binary form must reproduce the above copyright notice, this list of "
     "conditions and the following disclaimer in the documentation and/or other materials provided "
     "with the distribution. Neither the name of the copyright holder nor the names of its "
     "contributors may be used to endorse or promote products derived from this software without "
     "specific prior written permission."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
     "copy of the MPL was not distributed with this file, You can obtain one at "
     "http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
]

_NOT_TERM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|copyright|notice)([._-].*)?$"
_SALTS = 64


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """license, text; numbered as `template`."""
    quoted = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(templates))
    return spark.sql(f"SELECT * FROM VALUES {quoted} AS t(template, license, text)")


def terms(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _NOT_TERM), "")


def _tf(count: Column) -> Column:
    return 1 + F.log(count.cast("double"))


def term_weights(templates: DataFrame) -> DataFrame:
    """term, its `idf`, and `found`: template, license and weight in vectors of length 1."""
    counts = (
        templates.select("template", "license", F.explode(terms(F.col("text"))).alias("term"))
        .groupBy("template", "license", "term")
        .count()
    )
    n = templates.count()
    idf = counts.groupBy("term").agg(F.log(1 + n / F.count("*")).alias("idf"))
    weighted = counts.join(idf, "term").withColumn("weight", _tf(F.col("count")) * F.col("idf"))
    lengths = weighted.groupBy("template").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("length"))
    unit = F.struct("template", "license", (F.col("weight") / F.col("length")).alias("weight"))
    return weighted.join(lengths, "template").groupBy("term", "idf").agg(
        F.collect_list(unit).alias("found")
    )


def key_terms(weights: DataFrame, threshold: float) -> list[str]:
    """Terms one of which every text has that comes to `threshold` with a template."""
    vectors = defaultdict(list)
    for row in weights.collect():
        for t in row.found:
            vectors[t.template].append((t.weight**2, row.term))
    keys = set()
    for vector in vectors.values():
        rest = 0.0
        for square, term in sorted(vector):
            rest += square
            if rest >= threshold**2 - 1e-6:
                keys.add(term)
    return sorted(keys)


def may_reach(words: Column, weights: DataFrame, n: int, threshold: float) -> Column:
    """False only where no template can come to a cosine of `threshold`.

    With K the part of the unit's vector on known terms, U that on others, and T the part
    of a template on terms of the unit, the cosine is at most |T| |K| / |(K, U)|. |U| is
    counted from below, each term once, and |K| from above, as if every other word were
    each of the known terms.
    """
    rows = sorted(weights.collect(), key=lambda row: row.term)
    at = {t: i for i, t in enumerate(sorted({t.template for row in rows for t in row.found}))}
    if not at:
        return F.lit(False)
    squares = []
    for row in rows:
        found = [0.0] * len(at)
        for t in row.found:
            found[at[t.template]] += t.weight**2
        squares += [F.lit(row.term), F.array(*map(F.lit, [row.idf**2, *found]))]
    square = F.create_map(*squares)
    vocabulary = F.array(*(F.lit(row.term) for row in rows))
    unknown = F.size(F.array_except(words, vocabulary))
    sums = F.aggregate(
        F.array_intersect(words, vocabulary),
        F.array(*[F.lit(0.0)] * (1 + len(at))),
        lambda total, w: F.zip_with(total, square[w], lambda x, y: x + y),
    )
    most = F.array_max(F.slice(sums, 2, len(at)))
    known = sums[0] * _tf(F.greatest(F.size(words) - unknown, F.lit(1))) ** 2
    whole = known + unknown * math.log(1 + n) ** 2
    return most * known + 1e-6 * whole >= threshold**2 * whole


def _key(text: str) -> Column:
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def notices(
    docs: DataFrame,
    templates: DataFrame,
    threshold: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per id and text with a notice: best `license`, its `score`, and all `licenses`."""
    weights = term_weights(templates)
    n = templates.count()
    keys = key_terms(weights, threshold)
    edge = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
    pattern = f"(?:^|{edge})(?:{'|'.join(keys)})(?:$|{edge})" if keys else "(?!)"
    has_key = lambda c: ascii_lower(c).rlike(pattern)
    text = F.col("text")
    rows = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .where(has_key(text))
        .withColumn("key", _key("text"))
    )
    units = F.array_distinct(
        F.concat(
            F.split(text, r"\r\n|\n|\r"),
            F.split(text, r"(?:\r\n|\n|\r)[ \t]*(?:\r\n|\n|\r)\s*"),
            F.array(text),
        )
    )
    unit = ["id", "key", "unit"]
    # The same row read twice is one; else its counts would be doubled.
    kept = (
        rows.select("id", "key", F.posexplode(F.filter(units, has_key)).alias("unit", "part"))
        .withColumn("part", terms(F.col("part")))
        .where(may_reach(F.col("part"), weights, n, threshold))
        .dropDuplicates(unit)
    )
    counts = (
        kept.select(*unit, F.explode("part").alias("term"))
        .groupBy(*unit, "term")
        .agg(F.count("*").alias("count"))
    )
    value = _tf(F.col("count")) * F.coalesce("idf", F.lit(math.log(1 + n)))
    # The unit's own square length is gathered with the dot products, as template -1.
    own = F.struct(F.lit(-1).alias("template"), F.lit("").alias("license"), F.col("w").alias("weight"))
    dots = (
        counts.join(weights, "term", "left")
        .withColumn("w", value)
        .select(*unit, "w", F.explode(F.concat(F.array(own), F.coalesce("found", F.array()))).alias("t"))
        .groupBy(*unit, "t.template", "t.license")
        .agg(F.sum(F.col("w") * F.col("t.weight")).alias("dot"))
    )
    cosine = F.round(F.col("best.dot") / F.sqrt("square"), 6)
    best = (
        dots.groupBy(*unit)
        .agg(
            F.max(F.when(F.col("template") == -1, F.col("dot"))).alias("square"),
            F.min(
                F.when(
                    F.col("template") != -1,
                    F.struct((-F.round("dot", 9)).alias("minus"), "license", "dot"),
                )
            ).alias("best"),
        )
        .select("id", "key", "best.license", cosine.alias("score"))
        .where(F.col("score") >= threshold)
    )
    return best.groupBy("id", "key").agg(
        F.min(F.struct(-F.col("score"), "license"))["license"].alias("license"),
        F.max("score").alias("score"),
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
    )


def directory(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """The folder and all above it; the root is the empty string."""
    parts = F.split(folder, "/")
    return F.array_distinct(
        F.transform(
            F.sequence(F.lit(0), F.size(parts)),
            lambda n: F.array_join(F.slice(parts, 1, n), "/"),
        )
    )


def inherited(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Of folders at or below a licence file: `given`, the nearest license, and where from.

    `files` are the `rows`, which have a path, with license and score of their own.
    """
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    givers = (
        files.where(F.col("license").isNotNull() & name.rlike(_LICENCE_FILE))
        .groupBy(directory(F.col("path")).alias("above"))
        .agg(F.min(F.struct(-F.col("score"), "path", "license")).alias("giver"))
    )
    folders = rows.select(directory(F.col("path")).alias("folder")).where("folder is not null")
    above = folders.distinct().select("folder", F.explode(ancestors(F.col("folder"))).alias("above"))
    return (
        above.join(givers, "above")
        .groupBy("folder")
        .agg(F.max(F.struct(F.length("above").alias("depth"), "giver")).alias("found"))
        .select(
            "folder",
            F.col("found.giver.license").alias("given"),
            F.col("found.giver.path").alias("given_by"),
        )
    )


def scan(
    docs: DataFrame,
    templates: DataFrame,
    path: Column,
    threshold: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, path, license, `score` and `licenses` of its own notices, `license_from`.

    `license_from` is the file's own path or that of the licence file it inherits from.
    """
    own = notices(docs, templates, threshold, id_col, text_col).withColumnsRenamed(
        {"id": "own_id", "key": "own_key"}
    )
    rows = docs.select(F.col(id_col).alias("id"), path.alias("path"), _key(text_col).alias("key"))
    on = rows["id"].eqNullSafe(own["own_id"]) & (rows["key"] == own["own_key"])
    files = rows.join(own, on, "left").drop("own_id", "own_key")
    # One folder may hold most files: its row is dealt to as many places as salts.
    given = inherited(rows, files).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    folder = F.when(F.col("license").isNull(), directory(F.col("path")))
    salted = files.withColumns(
        {"folder": folder, "salt": F.pmod(F.xxhash64("key", "id"), F.lit(_SALTS)).cast("int")}
    )
    return salted.join(given, ["folder", "salt"], "left").select(
        F.col("id").alias(id_col),
        "path",
        F.coalesce("license", "given").alias("license"),
        "score",
        "licenses",
        F.when(F.col("license").isNotNull(), F.col("path"))
        .otherwise(F.col("given_by"))
        .alias("license_from"),
    )
