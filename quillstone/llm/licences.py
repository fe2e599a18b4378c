"""Licence scans: normalised text compared to licence templates by Dice over word bigrams.

Native: DataFrame and SQL functions only. A text is compared line by line and, if it
is short enough, as a whole. Lines become lower-case words of letters, digits and dots
within numbers; a unit's bigrams are its distinct pairs of neighbouring words. By the
bounds of the Dice coefficient, a unit of a bigrams can reach threshold t against a
template of b only if t / (2 - t) <= a / b <= (2 - t) / t, so units without a template
in bounds are left out before any bigram is made, as are units without a word that every
match of a template must have one of. The rest meet the templates in an
equi-join on bigrams, and shared bigrams are counted by unit and template.

A notice that is wrapped over lines, or stands within a longer line, is no such unit.
So windows of words are compared too: they begin and end with a bigram of the template
and have at most (2 - t) / t times its bigrams. Of windows that overlap the one that shares most is kept,
and of what the units have found already, none.

Templates are a constant of this module, so their broadcast has a fixed size.
"""

from __future__ import annotations

import re
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.common import stash

THRESHOLD = 0.8
#: Notices by which works name their licence, and short licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Apache-2.0-header-2": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MIT-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSD-licensed": "Licensed under the BSD 3-Clause License.",
    "ISC-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "all-rights-reserved": "All rights reserved.",
}
#: One word of the normal form: letters and digits, with dots between digits.
WORD = r"[0-9]+(?:\.[0-9]+)+|[\p{L}\p{N}]+"


def bigrams_of(text: str) -> list[str]:
    """The templates' side of ``bigrams``."""
    words = re.findall(r"[0-9]+(?:\.[0-9]+)+|[^\W_]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}) or words[:1]


def templates(spark: SparkSession, texts: dict[str, str]) -> DataFrame:
    """(licence, size, bigram), a row for each bigram of each template."""
    return spark.createDataFrame([(name, len(b), x) for name, t in texts.items() for b in [bigrams_of(t)] for x in b], "licence string, size int, bigram string")


def words(low: Column) -> Column:
    """The words of a text in lower case."""
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def bigrams(w: Column) -> Column:
    """Distinct neighbouring words; a single word for itself."""
    pairs = F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(w) > 1, F.array_distinct(pairs)).otherwise(w)


def ratio(threshold: float) -> tuple[int, int]:
    """The threshold as a fraction, so that what lies on it is compared in integers."""
    t = Fraction(threshold).limit_denominator(10_000)
    return t.numerator, t.denominator


def bounds(size: int, threshold: float) -> tuple[int, int]:
    """The smallest and the largest number that can reach the threshold against ``size``: t / (2 - t) times it and (2 - t) / t times it."""
    p, q = ratio(threshold)
    return -(-p * size // (2 * q - p)), (2 * q - p) * size // p


def reaches(shared: Column, size: Column, template_size: Column, threshold: float) -> Column:
    """Whether the Dice coefficient 2 shared / (size + template_size) is at least the threshold."""
    p, q = ratio(threshold)
    return shared.cast("long") * (2 * q) >= (size + template_size).cast("long") * p


def anchors(texts: dict[str, str], threshold: float) -> list[str]:
    """Strings of which a unit holds one if it reaches the threshold against any template.

    It then shares at least t / (2 - t) of the template's bigrams, so of any larger number
    of bigrams than it may miss it has one; the words here, long ones first, are such that
    more of each template's bigrams hold one of them.
    """
    out = set()
    for text in texts.values():
        grams = bigrams_of(text)
        miss = len(grams) - bounds(len(grams), threshold)[0]
        words = sorted({w for b in grams for w in b.split(" ")}, key=lambda w: (-len(w), w))
        covered: set[str] = set()
        for w in words:
            if len(covered) > miss:
                break
            out.add(w)
            covered |= {b for b in grams if w in b.split(" ")}
    return sorted(w for w in out if not any(v != w and v in w for v in out))


def holds_any(text: Column, strings: list[str]) -> Column:
    """Whether the text holds one of the strings. The text is an element of an array here, so that it is made once and not for each string."""

    def any_of(t: Column) -> Column:
        found = F.lit(False)
        for x in strings:
            found = found | F.contains(t, F.lit(x))
        return found

    return F.exists(F.array(text), any_of)


def windows(held: DataFrame, texts: dict[str, str], threshold: float) -> DataFrame:
    """(row, line, last, licence, shared, size, template_size, dice) of the best windows of each text (row, low) that don't overlap.

    ``line`` and ``last`` are the lines in which a window begins and ends. A text meets
    only the templates of which it has as many bigrams as a match needs.
    """
    spark = held.sparkSession
    sets = [(name, b, len(re.findall(r"[0-9]+(?:\.[0-9]+)+|[^\W_]+", t.lower())) - 1) for name, t in texts.items() for b in [bigrams_of(t)] if " " in b[0]]
    if not sets:
        return spark.createDataFrame([], "row long, line int, last int, licence string, shared int, size int, template_size int, dice double")
    known = F.array(*[F.struct(F.lit(name).alias("licence"), F.array(*map(F.lit, b)).alias("grams"), F.lit(len(b)).alias("template_size"), F.lit(bounds(len(b), threshold)[0]).alias("need"), F.lit(bounds(n, threshold)[1]).alias("span")) for name, b, n in sets])
    every = sorted({x for _, b, _ in sets for x in b})
    w = F.flatten(F.transform(F.split("low", "\n"), lambda x, i: F.transform(words(x), lambda y: F.struct(y.alias("w"), (i + 1).alias("line")))))
    each = held.select("row", w.alias("w")).where(F.size("w") > 1)
    each = each.select("row", "w.line", F.zip_with(F.expr("slice(w, 1, size(w) - 1)"), F.expr("slice(w, 2, size(w) - 1)"), lambda a, b: F.concat_ws(" ", a["w"], b["w"])).alias("g"))
    each = each.withColumn("hits", F.filter(F.transform("g", lambda x, i: F.when(x.isin(every), F.struct((i + 1).alias("i"), x.alias("g")))), lambda x: x.isNotNull()))
    each = each.where(F.size("hits") >= min(bounds(len(b), threshold)[0] for _, b, _ in sets))
    of = lambda k: F.filter("hits", lambda x: F.array_contains(k["grams"], x["g"]))
    each = each.withColumn("k", F.explode(F.filter(known, lambda k: F.size(of(k)) >= k["need"]))).select("row", "line", "g", "hits", "k.*")
    each = each.withColumn("hits", F.transform(F.filter("hits", lambda x: F.array_contains(F.col("grams"), x["g"])), lambda x: x["i"]))
    each = each.select("*", F.explode("hits").alias("at")).withColumn("ends", F.expr("filter(hits, q -> q >= at and q < at + span)")).where(F.size("ends") >= F.col("need"))
    # only a window with the hits that a match needs is looked at
    each = each.withColumn("ends", F.expr("slice(ends, need, size(ends))"))
    scored = F.expr("transform(transform(ends, q -> struct(q, array_distinct(slice(g, at, q - at + 1)) as own)), x -> struct(x.q as q, size(array_intersect(x.own, grams)) as shared, size(x.own) as size))")
    each = each.withColumn("x", F.array_min(F.transform(scored, lambda x: F.struct((-2.0 * x["shared"] / (x["size"] + F.col("template_size"))).alias("d"), x["q"].alias("q"), x["shared"].alias("shared"), x["size"].alias("size")))))
    each = each.where(reaches(F.col("x.shared"), F.col("x.size"), F.col("template_size"), threshold))
    found = each.select("row", F.struct((-F.col("x.shared")).alias("most"), F.col("x.d").alias("d"), "licence", "at", F.col("x.q").alias("q"), F.element_at("line", F.col("at")).cast("int").alias("line"), F.element_at("line", F.col("x.q") + 1).cast("int").alias("last"), F.col("x.shared").alias("shared"), F.col("x.size").alias("size"), "template_size").alias("x"))
    # most shared bigrams first, as a long notice may begin with a short one; each that overlaps none before it; a window of q bigrams has a word more
    kept = F.expr("aggregate(slice(xs, 2, size(xs)), slice(xs, 1, 1), (got, x) -> if(exists(got, y -> x.at <= y.q and y.at <= x.q), got, concat(got, array(x))))")
    out = found.groupBy("row").agg(F.array_sort(F.collect_list("x")).alias("xs")).select("row", F.explode(kept).alias("x"))
    return out.select("row", "x.line", "x.last", "x.licence", "x.shared", "x.size", "x.template_size", (-F.col("x.d")).alias("dice"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, line, licence, shared, size, template_size, dice) of each unit's best template at ``threshold`` or more.

    ``line`` counts from 1; 0 is a text of several lines as a whole. A window of words has
    the line in which it begins; it is left out within a line that matches by itself, and
    where a line of it, or the whole text, matches the same licence. Ties go to the
    template of smaller name. A null or empty text has no units; null ids and repeated
    rows are scanned like others, and repeated rows give repeated results. No rows give no
    rows. Only the named columns are read.
    """
    spark = docs.sparkSession
    sizes = sorted({len(bigrams_of(t)) for t in texts.values()})
    low, high = bounds(sizes[0], threshold)[0], bounds(sizes[-1], threshold)[1]
    some = anchors(texts, threshold)

    held = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null and text <> ''")
    # written, as the units and the windows both read what is left of the texts
    held = stash(held.where(holds_any(F.lower("text"), some)).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.lower("text").alias("low")), "licence-texts")
    lines = F.split("low", "\n")
    units = held.select("row", "doc_id", F.posexplode(F.when(F.size(lines) > 1, F.concat(F.array("low"), lines)).otherwise(F.concat(F.array(F.lit("")), lines))).alias("line", "unit"))
    units = units.where("unit <> ''").where(holds_any(F.col("unit"), some))
    units = units.withColumn("w", words(F.col("unit"))).where(F.size("w") > 0)
    units = units.where(F.size(F.array_distinct("w")) <= 2 * high + 2)
    units = units.select("row", "doc_id", "line", bigrams(F.col("w")).alias("b")).withColumn("size", F.size("b")).where(F.col("size").between(low, high))
    near = F.lit(False)
    for n in sizes:
        near = near | F.col("size").between(*bounds(n, threshold))
    # rows of equal ids and texts stay apart: a unit's number is its own
    units = units.where(near).withColumn("unit", F.monotonically_increasing_id())
    pairs = units.select("row", "doc_id", "line", "unit", "size", F.explode("b").alias("bigram")).join(F.broadcast(templates(spark, texts).withColumnRenamed("size", "template_size")), "bigram")
    p, q = ratio(threshold)
    pairs = pairs.where((F.col("size") * (2 * q - p) >= F.col("template_size") * p) & (F.col("size") * p <= F.col("template_size") * (2 * q - p)))
    shared = pairs.groupBy("unit", "row", "doc_id", "line", "size", "licence", "template_size").agg(F.count(F.lit(1)).alias("shared"))
    scored = shared.withColumn("dice", 2 * F.col("shared") / (F.col("size") + F.col("template_size"))).where(reaches(F.col("shared"), F.col("size"), F.col("template_size"), threshold))
    best = scored.groupBy("unit", "row", "doc_id", "line", "size").agg(F.min(F.struct((-F.col("dice")).alias("d"), "licence", "shared", "template_size")).alias("x"))
    best = best.select("row", "doc_id", F.col("line").cast("int").alias("line"), "x.licence", "x.shared", F.col("size").cast("int").alias("size"), F.col("x.template_size").cast("int").alias("template_size"), (-F.col("x.d")).alias("dice"))
    best = stash(best, "licence-units")
    more = windows(held.select("row", "low"), texts, threshold).join(held.select("row", "doc_id"), "row").alias("m")
    same = F.col("m.licence") == F.col("b.licence")
    found = same & ((F.col("b.line") == 0) | F.col("b.line").between(F.col("m.line"), F.col("m.last"))) | (F.col("b.line") == F.col("m.line")) & (F.col("m.line") == F.col("m.last"))
    more = more.join(best.alias("b"), (F.col("m.row") == F.col("b.row")) & found, "left_anti")
    return best.drop("row").unionByName(more.select("doc_id", "line", "licence", F.col("shared").cast("long").alias("shared"), "size", "template_size", "dice"))


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices found in all documents; nulls, empty texts, ties, repeated rows and an empty table as in ``scan``."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    p, q = ratio(THRESHOLD)
    rows = ", ".join("('{}', {}, '{}')".format(name, len(bigrams_of(t)), x) for name, t in TEMPLATES.items() for x in bigrams_of(t))
    return rf"""
WITH t(licence, template_size, bigram) AS (VALUES {rows}),
l AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents WHERE text <> ''),
u AS (SELECT doc_id, unnest(range(1, len(parts) + 1)) AS line, unnest(parts) AS unit FROM l UNION ALL SELECT doc_id, 0, text FROM l WHERE len(parts) > 1),
w AS (SELECT doc_id, line, regexp_extract_all(lower(unit), '[0-9]+(?:\.[0-9]+)+|[\p{{L}}\p{{N}}]+') AS w FROM u),
b AS (SELECT row_number() OVER () AS unit, doc_id, line, CASE WHEN len(w) > 1 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END AS b FROM w WHERE len(w) > 0),
e AS (SELECT unit, doc_id, line, len(b) AS size, unnest(b) AS bigram FROM b),
s AS (SELECT unit, doc_id, line, size, licence, template_size, count(*) AS shared, 2 * count(*) / (size + template_size)::DOUBLE AS dice FROM e JOIN t USING (bigram) GROUP BY unit, doc_id, line, size, licence, template_size),
r AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY dice DESC, licence) AS rn FROM s WHERE {2 * q} * shared >= {p} * (size + template_size))
SELECT doc_id, line::INTEGER AS line, licence, shared, size::INTEGER AS size, template_size::INTEGER AS template_size, dice FROM r WHERE rn = 1
"""


OP7_SQL = _sql()
