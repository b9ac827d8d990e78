"""License scans by Dice coefficient over word bigrams (operator 4), DataFrame functions only.

The words of the whole text (ASCII lower case, letters and digits) are numbered, and runs of
words are compared with licence templates wherever they begin, so a notice is found inside a
longer line, in a comment block or over several lines: Dice = 2 |A and B| / (|A| + |B|) over
bags of word bigrams (A and B: the places of the run that hold a bigram of the template, the
template's length at most). A best run begins and ends with a bigram of the template; a template is
looked at only in texts that hold as many of its bigrams as the threshold needs, and only where
so many of them lie within the longest run that the threshold allows.

Sibling licences: a run must hold the words of its template that tell licences apart (names,
numbers, variants) and no variant that the template lacks; the opening of the BSD licences goes
by the clause on endorsement that follows it, and stands for both where no clause follows. Of
runs that overlap, a template keeps those of the largest Dice, and of different licences the one
with most common bigrams (then Dice) stays, ties both.

"All rights reserved." says nothing beside a licence: ``proprietary`` is reported only where
nothing else is found.

The templates are a parameter of fixed size. A text's bigrams are gone through once, each hit
looking no further than the longest run; choosing among overlapping runs and finding their lines is
done on rows of finds, sorted by place, so the work grows with the text and its finds.

Defined cases: a null or empty text has no licence; a text of any length is scanned whole; repeated rows and ids give their rows again;
of equal finds of a licence in a document the earliest unit is reported; a text of one word has
no bigram and matches nothing; a run is at most (2 - t) / t times as long as its template, counted
in words; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketspark.llm.text import pinned

THRESHOLD = 0.8

#: Licence statements as their publishers ask them to be written.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("proprietary", "All rights reserved."),
)

#: Sibling licences of those above.
SIBLINGS = (
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.0", "This work is licensed under the GNU Library General Public License, version 2."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-2.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    *((f"CC-{short}-4.0", f"Licensed under CC {short} 4.0.") for short in ("BY", "BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND")),
    *((f"CC-{short}-4.0", f"This work is licensed under a Creative Commons Attribution-{long} 4.0 International License.") for short, long in (("BY-ND", "NoDerivatives"), ("BY-NC-SA", "NonCommercial-ShareAlike"), ("BY-NC-ND", "NonCommercial-NoDerivatives"))),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("EPL-1.0", "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    *((name, f"SPDX-License-Identifier: {name}") for name in (
        "MIT", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
        "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "ISC", "Zlib", "Unlicense", "BSL-1.0", "EPL-1.0", "EPL-2.0",
        "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "OFL-1.1",
    )),
)
PROPRIETARY = "proprietary"
#: Words that tell licences apart, besides numbers: a run holds those of its template, and no
#: variant that the template does not have.
NAMES = ("mit", "apache", "gnu", "mozilla", "creative", "cc", "reserved", "zlib", "boost", "eclipse", "cc0", "isc", "bsd", "bsl", "epl", "mpl", "ofl", "gpl", "lgpl", "agpl", "unlicense", "only", "later")
VARIANTS = ("lesser", "library", "affero", "noncommercial", "nc", "sharealike", "sa", "noderivatives", "noderivs", "nd")
#: The BSD licences begin alike: three clauses have the second word within so many words, two
#: only the first.
CLAUSES = ("disclaimer", "endorse")
CLAUSE_WORDS = 160


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _known(templates, threshold: float) -> list[dict]:
    """What is asked of a run for each template that has a bigram."""
    out = []
    for license_, body in templates:
        words = re.findall("[a-z0-9]+", body.lower())
        b = list(dict.fromkeys(f"{x} {y}" for x, y in zip(words, words[1:])))
        if b:
            # Dice >= t needs |A and B| >= t / (2 - t) |B|, and |A| <= (2 - t) / t |B|.
            need = math.ceil(threshold / (2 - threshold) * (len(words) - 1) - 1e-9)
            longest = int((2 - threshold) / threshold * (len(words) - 1) + 1e-9)
            tell = sorted({w for w in words if w.isdigit() or w in NAMES + VARIANTS})
            clauses = {"BSD-2-Clause": 2, "BSD-3-Clause": 3}.get(license_, 0) if "redistribution" in words else 0
            others = [w for w in VARIANTS if w not in words]
            out.append({"license": license_, "b": b, "size": len(words) - 1, "least": math.ceil(threshold / (2 - threshold) * len(b) - 1e-9), "need": max(need, 1), "longest": longest, "tell": tell, "others": others, "clauses": clauses})
    return out


def _literal(value) -> Column:
    if isinstance(value, dict):
        return F.struct(*[_literal(v).alias(k) for k, v in value.items()])
    if isinstance(value, list):
        return F.array(*map(_literal, value)) if value else F.array().cast("array<string>")
    return F.lit(value)


def _let(value: Column, use) -> Column:
    """``use(value)``, the value being worked out once."""
    return F.transform(F.array(value), use)[0]


def _once(df: DataFrame, **made: Column) -> DataFrame:
    """Adds columns behind a generator, so that no later step works them out again."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))))


def _overlap(a: Column, b: Column) -> Column:
    return (a["begin"] <= b["stop"]) & (b["begin"] <= a["stop"])


def _runs(text: Column, k: Column, hits: Column, threshold: float) -> Column:
    """The finds of the template ``k`` in a text (its ``words`` and ``pairs``), whose pairs of words
    at ``hits`` are the template's. All arrays are bound, so a slice costs its own length."""
    pairs, words = text["pairs"], text["words"]

    def right(a, b):
        held = F.slice(words, a + 1, b - a + 2)
        ahead = F.slice(words, b + 3, F.lit(CLAUSE_WORDS))
        two, three = (F.array_contains(ahead, w) for w in CLAUSES)
        clauses = F.when(k["clauses"] == 3, three | ~two).when(k["clauses"] == 2, ~three).otherwise(F.lit(True))
        return (F.size(F.array_except(k["tell"], held)) == 0) & ~F.arrays_overlap(held, k["others"]) & clauses

    def scored(a, i, b, j):
        shared = F.least(k["need"] + j, k["size"])  # hits from the i-th on
        dice = 2.0 * shared / (b - a + 1 + k["size"])
        found = F.struct(dice.alias("dice"), (-a).alias("early"), (-b).alias("short"), shared.alias("shared"), a.alias("begin"), b.alias("stop"), k["license"].alias("license"))
        return F.when((b - a < k["longest"]) & (dice >= threshold), found)

    def best(a, i):
        ends = F.transform(F.slice(hits, i + k["need"], k["longest"]), lambda b, j: scored(a, i, b, j))
        return F.array_max(F.filter(ends, lambda x: x.isNotNull() & right(a, x["stop"])))

    found = F.transform(hits, lambda a, i: F.when(F.get(hits, i + k["need"] - 1) - a < k["longest"], best(a, i)))

    def apart(runs):
        near = lambda i: F.slice(runs, F.greatest(i + 1 - k["longest"], F.lit(1)), 2 * k["longest"])  # one run a begin
        return F.filter(runs, lambda r, i: ~F.exists(near(i), lambda o: _overlap(o, r) & (o > r)))

    return _let(F.filter(found, lambda r: r.isNotNull()), apart)


def _best_licenses(runs: Column) -> Column:
    """The runs that no better run of another licence overlaps, taken from the best on."""
    ranked = F.transform(runs, lambda r: F.struct(r["shared"].alias("shared"), r["dice"].alias("dice"), r["begin"].alias("begin"), r["stop"].alias("stop"), r["license"].alias("license")))
    better = lambda o, r: (o["license"] != r["license"]) & ((o["shared"] > r["shared"]) | (o["dice"] > r["dice"]))
    add = lambda kept, r: F.when(F.exists(kept, lambda o: _overlap(o, r) & better(o, r)), kept).otherwise(F.concat(kept, F.array(r)))
    taken = _let(F.sort_array(ranked, asc=False), lambda x: F.aggregate(x, F.slice(x, 1, 0), add))
    several = F.size(F.array_distinct(F.transform(runs, lambda r: r["license"]))) > 1
    return F.when(several, taken).otherwise(ranked)


def _places(found: DataFrame) -> DataFrame:
    """(row, pos, line, before, several, lines): where each line of a text begins, in words; the
    paragraphs of several lines before its own, and whether its own is one; lines in all."""
    parts = found.select("row", F.posexplode(F.split("t", "\n[ \t\r]*\n", -1)).alias("p", "part")).select("row", "p", F.split("part", "\n", -1).alias("lines"))
    so_far = Window.partitionBy("row").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("row")
    several = F.size("lines") > 1
    parts = parts.select(
        "row", "lines", several.alias("several"), F.coalesce(F.sum(several.cast("int")).over(so_far), F.lit(0)).alias("before"),
        F.coalesce(F.sum(F.size("lines") + 1).over(so_far), F.lit(0)).alias("first"), (F.sum(F.size("lines") + 1).over(whole) - 1).alias("all"),
    )
    lines = parts.select("row", "several", "before", "first", "all", F.posexplode("lines").alias("i", "line")).select(
        "row", "several", "before", "all", (F.col("first") + F.col("i")).alias("line"), F.size(_words(F.col("line"))).alias("n"))
    until = Window.partitionBy("row").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    return lines.select("row", F.coalesce(F.sum("n").over(until), F.lit(0)).alias("pos"), F.struct("line", "before", "several", "all").alias("place"))


def _kept_runs(found: DataFrame) -> DataFrame:
    """(row, shared, dice, begin, stop, license): of overlapping runs the best licence's. Runs
    that don't overlap, directly or through others, are chosen apart from each other."""
    each = found.select("row", F.explode("runs").alias("r")).select("row", "r.*")
    order = Window.partitionBy("row").orderBy("begin", "stop")
    reached = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum((F.col("begin") > F.coalesce(reached, F.lit(-1))).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = each.withColumn("island", island).groupBy("row", "island").agg(F.collect_list(F.struct("dice", "early", "short", "shared", "begin", "stop", "license")).alias("runs"))
    return met.select("row", F.explode(_best_licenses(F.col("runs"))).alias("f")).select("row", "f.*")


def scan_licenses(docs: DataFrame, templates=TEMPLATES + SIBLINGS, threshold: float = THRESHOLD, doc_id="doc_id", text="text") -> DataFrame:
    """One row per document row and licence found: doc_id, license, unit, dice. The unit is the
    number of the line; of a find over several lines, that of the blank-line-separated paragraph
    it begins in, of those with several lines and counted on from the lines (or the line it
    begins in, where that paragraph is one line)."""
    known = _known(templates, threshold)
    every = sorted({b for k in known for b in k["b"]})
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = _once(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), t.alias("t")), words=_words(F.col("t")))
    rows = _once(rows, pairs=F.transform("words", lambda w, i: F.concat(w, F.lit(" "), F.get(F.col("words"), i + 1))))
    rows = _once(rows, at=F.filter(F.transform("pairs", lambda p, i: F.when(p.isin(every), i)), lambda i: i.isNotNull()))
    rows = _once(rows.where(F.size("at") > 0), held=F.array_distinct(F.transform("at", lambda i: F.get(F.col("pairs"), i))))
    able = F.filter(_literal(known), lambda k: F.size(F.array_intersect(k["b"], F.col("held"))) >= k["least"])
    rows = _once(rows, able=able).where(F.size("able") > 0)
    plain = lambda c: F.transform(c, lambda x: x)
    of = lambda x, k: F.filter(x["at"], lambda i: F.array_contains(k["b"], F.get(x["pairs"], i)))
    bound = F.struct(plain("words").alias("words"), plain("pairs").alias("pairs"), plain("at").alias("at"))
    runs = _let(bound, lambda x: F.flatten(F.transform("able", lambda k: _let(of(x, k), lambda h: _runs(x, k, h, threshold)))))
    rows = _once(rows.select("doc_id", "t", "words", "pairs", "at", "able"), runs=runs).where(F.size("runs") > 0)
    found = pinned(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "t", "runs"), "license-runs")
    finds = _kept_runs(found).withColumn("find", F.struct("license", "dice", "begin", "stop"))
    # Lines and finds in the order of their words: a word is on the last line that began before it.
    asked = finds.select("row", "find", F.explode(F.array(F.struct(F.col("begin").alias("pos"), F.lit(1).alias("end")), F.struct((F.col("stop") + 1).alias("pos"), F.lit(2).alias("end")))).alias("a"))
    asked = asked.select("row", F.col("a.pos").cast("long").alias("pos"), F.lit(None).alias("place"), F.col("a.end").alias("end"), "find")
    places = _places(found).select("row", F.col("pos").cast("long").alias("pos"), "place", F.lit(0).alias("end"), F.lit(None).alias("find"))
    order = Window.partitionBy("row").orderBy("pos", F.col("end") > 0, "place.line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = places.unionByName(asked).withColumn("at", F.last("place", ignorenulls=True).over(order)).where("end > 0")
    ends = told.groupBy("row", "find").agg(F.max(F.when(F.col("end") == 1, F.col("at"))).alias("a"), F.max(F.when(F.col("end") == 2, F.col("at.line"))).alias("last"))
    unit = F.when((F.col("a.line") < F.col("last")) & F.col("a.several"), F.col("a.all") + F.col("a.before")).otherwise(F.col("a.line"))
    best = ends.groupBy("row", F.col("find.license").alias("license")).agg(F.max(F.struct(F.col("find.dice").alias("dice"), (-unit).alias("u"))).alias("m"))
    others = Window.partitionBy("row")
    best = best.withColumn("open", F.max(F.col("license") != PROPRIETARY).over(others)).where((F.col("license") != PROPRIETARY) | ~F.col("open"))
    named = best.join(found.select("row", "doc_id"), "row")
    return named.select("doc_id", "license", (-F.col("m.u")).cast("int").alias("unit"), F.col("m.dice").alias("dice"))
