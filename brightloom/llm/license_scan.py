"""Licence scan: lines, whole texts and runs of words against licence templates by the Dice coefficient of their word bigrams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.llm.common import let

# Public licence notices and texts, by identifier.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "MIT-2": "Licensed under the MIT License.",
    "MIT-3": "This project is licensed under the terms of the MIT license.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-2": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-2": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0-2": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0-2": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-2": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "reserved": "All rights reserved.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
}


def word_pairs(c: Column) -> Column:
    """Hashes of neighbouring words in order, after normalising: lower case, anything but a-z and 0-9 separates words."""
    w = F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+"), lambda x: x != "")
    return let(w, lambda w: F.transform(F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda x, i: F.xxhash64(F.get(w, i), x)))


def bigrams(c: Column) -> Column:
    """Distinct hashes of neighbouring words."""
    return F.array_distinct(word_pairs(c))


def _runs(pairs: Column, t: Column, threshold: float) -> Column:
    """Runs of words with a coefficient of at least ``threshold`` with template ``t``: ``(shared, dice, first, last, licence)``.

    ``pairs`` are the hashes of the text in order; ``first`` and ``last`` number the words. A run that begins or ends with a pair
    that is not the template's does not get worse without it, so runs lie between two of its pairs. A run shares at least
    ``least`` pairs with the template and has ``most`` at most, which leaves few starts.
    """
    ratio = threshold / (2 - threshold)
    least, most = F.ceil(t["n"] * ratio - 1e-9), F.floor(t["n"] / ratio + 1e-9)
    hits = F.filter(F.transform(pairs, lambda h, i: F.when(F.array_contains(t["h"], h), i)), lambda i: i.isNotNull())

    def from_start(hits: Column, a: Column, i: Column) -> Column:
        ends = F.filter(F.slice(hits, i + least.cast("int"), most.cast("int")), lambda b: b - a < most)

        def run(b: Column) -> Column:
            own = F.array_distinct(F.slice(pairs, a + 1, b - a + 1))
            return let(
                own,
                lambda own: let(
                    F.size(F.array_intersect(t["h"], own)),
                    lambda c: F.struct(c.alias("shared"), (F.lit(2.0) * c / (t["n"] + F.size(own))).alias("dice"), (-a).alias("from"), (a - b).alias("size"), t["licence"].alias("licence")),
                ),
            )

        return F.filter(F.transform(ends, run), lambda r: r["dice"] >= threshold)

    return let(hits, lambda hits: F.flatten(F.transform(hits, lambda a, i: from_start(hits, a, i))))


def _spans(text: Column, known: Column, hashes: Column, matches, threshold: float) -> Column:
    """Notices inside a text that are neither a line nor the whole: ``(unit, position, licence, dice)``.

    Of the runs that overlap, the one that shares most pairs with its template counts (then the higher coefficient, the
    earlier and the shorter one). Left out is what lies inside a line that matches, or overlaps a line with the same licence.
    """
    ratio = threshold / (2 - threshold)

    def near(pairs: Column) -> Column:
        own = F.array_intersect(hashes, pairs)
        return let(own, lambda own: F.filter(known, lambda t: F.size(F.array_intersect(t["h"], own)) >= t["n"] * ratio - 1e-9))

    def place(s: Column, licence: Column, first: Column, last: Column) -> Column:
        """Does the run lie inside the line ``s``, or overlap it under the same licence?"""
        return ((s["first"] <= first) & (last <= s["last"])) | (F.exists(s["found"], lambda m: m["licence"] == licence) & (s["first"] <= last) & (first <= s["last"]))

    def lines() -> Column:
        """Matching lines with their first and last word."""
        empty = F.array().cast("array<struct<first:int,last:int,found:array<struct<licence:string,dice:double>>>>")
        start = F.struct(F.lit(0).alias("at"), empty.alias("lines"))

        def step(acc: Column, line: Column) -> Column:
            size = F.size(F.filter(F.split(F.lower(line), "[^a-z0-9]+"), lambda x: x != ""))
            found = let(bigrams(line), matches)
            row = F.struct(acc["at"].alias("first"), (acc["at"] + size - 1).alias("last"), found.alias("found"))
            return let(row, lambda row: F.struct((row["last"] + 1).alias("at"), F.when(F.size(row["found"]) > 0, F.concat(acc["lines"], F.array(row))).otherwise(acc["lines"]).alias("lines")))

        return F.aggregate(F.split(text, "\n"), start, step)["lines"]

    def choose(runs: Column) -> Column:
        none = F.array().cast("array<struct<shared:int,dice:double,from:int,size:int,licence:string>>")
        apart = lambda c, r: (-c["from"] - c["size"] + 1 < -r["from"]) | (-r["from"] - r["size"] + 1 < -c["from"])
        return F.aggregate(F.reverse(F.array_sort(runs)), none, lambda acc, r: F.when(F.forall(acc, lambda c: apart(c, r)), F.concat(acc, F.array(r))).otherwise(acc))

    def outside(runs: Column, whole: Column) -> Column:
        free = lambda ls: F.filter(runs, lambda r: ~F.exists(ls, lambda s: place(s, r["licence"], -r["from"], 1 - r["from"] - r["size"])))
        return F.when((F.size(runs) == 0) | whole, F.slice(runs, 1, 0)).otherwise(let(lines(), free))

    def found(pairs: Column) -> Column:
        runs = let(near(pairs), lambda near: F.flatten(F.transform(near, lambda t: _runs(pairs, t, threshold))))
        whole = F.size(let(F.array_distinct(pairs), matches)) > 0
        return let(let(runs, lambda runs: outside(runs, whole)), choose)

    return F.transform(let(word_pairs(text), found), lambda r: F.struct(F.lit("run").alias("unit"), (-r["from"]).alias("position"), r["licence"].alias("licence"), r["dice"].alias("dice")))


def scan_licences(docs: DataFrame, templates: Mapping[str, str] = NOTICES, threshold: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, unit, position, licence, dice)`` of every unit and template with a coefficient of at least ``threshold``.

    Units are the lines (``position`` from 0), where there are several lines, the whole text (position -1), and runs of words
    (position of the first word, from 0) where a notice is wrapped over lines or shares its line; see ``_spans``. Two sets of
    sizes a and b can reach the threshold t only if t / (2 - t) <= a / b <= (2 - t) / t, so templates of other
    sizes are not compared. Templates are literals of the plan: no join, no shuffle. Null and empty texts and
    single words have no bigrams and match nothing; repeated rows are reported alike.
    """
    spark = docs.sparkSession
    names = list(templates)
    # the templates go through the same expression as the texts, once
    sets = spark.range(1).select(*[bigrams(F.lit(templates[n])).alias(str(i)) for i, n in enumerate(names)]).first()
    ratio = threshold / (2 - threshold)
    known = F.array(*[
        F.struct(F.lit(n).alias("licence"), F.lit(len(s)).alias("n"), F.array(*[F.lit(int(v)).cast("long") for v in s]).alias("h")) for n, s in zip(names, sets) if s
    ])
    lines = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x, i: F.struct(F.lit("line").alias("unit"), i.alias("position"), x.alias("body")))
    whole = F.array(F.struct(F.lit("text").alias("unit"), F.lit(-1).alias("position"), F.col(text).alias("body")))
    units = docs.select(F.col(key).alias("doc_id"), F.inline(F.when(F.instr(text, "\n") > 0, F.concat(lines, whole)).otherwise(lines)))

    def matches(own: Column) -> Column:
        near = F.filter(known, lambda t: (F.size(own) >= t["n"] * ratio) & (F.size(own) <= t["n"] / ratio))
        dice = F.transform(
            near,
            lambda t: F.struct(
                t["licence"].alias("licence"), (F.lit(2.0) * F.size(F.array_intersect(t["h"], own)) / (t["n"] + F.size(own))).alias("dice")
            ),
        )
        return F.filter(dice, lambda m: m["dice"] >= threshold)

    hashes = F.array(*[F.lit(int(v)).cast("long") for v in sorted({v for s in sets for v in s})])
    inside = docs.select(F.col(key).alias("doc_id"), F.inline(_spans(F.col(text), known, hashes, matches, threshold)))
    return units.select("doc_id", "unit", "position", F.inline(let(bigrams(F.col("body")), matches))).unionByName(inside)
