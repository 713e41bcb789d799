"""Licence scans: Dice coefficient over word bigrams; DataFrame functions only.

Segments of a document are normalised (lowered, every run of other characters than a-z and 0-9 one
space) and compared to licence templates. With A and B the sets of distinct word bigrams, Dice is
2|A n B| / (|A| + |B|). For a Dice of t the sizes must satisfy
|A| t / (2 - t) <= |B| <= |A| (2 - t) / t, so most templates are never compared; a segment that
shares no bigram with any template isn't compared at all, as its Dice is 0.

Segments are a document's lines, its whole text, and, for notices that are wrapped over lines or
stand within longer ones, windows: a template's anchors are its ANCHORS longest bigrams, and wherever
the text has one of them, the words around it are a window of the template's length, laid as the
anchor lies in the template. A window is compared to its own template. The windows of one template
that begin at the same word are one.

Null and empty texts and texts without licence text have no licence (null) and Dice 0. Of equal
Dice the template that comes first by name wins. Texts of any length are handled whole; repeated
rows give repeated rows. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least Dice for a match.
LEAST = 0.75
#: Bigrams of a template at which windows are laid.
ANCHORS = 3
# Well-known licence notices and short licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-2-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def words_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def bigrams_of(text: str) -> list[str]:
    w = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def anchors_of(text: str, most: int = ANCHORS) -> list[tuple[str, int]]:
    """A template's longest distinct bigrams, ties by text, each with the place of its first word."""
    w = words_of(text)
    pairs = [f"{a} {b}" for a, b in zip(w, w[1:])]
    return [(p, pairs.index(p)) for p in sorted(set(pairs), key=lambda p: (-len(p), p))[:most]]


def bounds(n: int, least: float = LEAST) -> tuple[int, int]:
    """Least and most bigrams of a segment that can match a template of n."""
    sizes = [k for k in range(1, int(n * 2 / least) + 2) if 2 * min(k, n) >= least * (k + n)]
    return (min(sizes), max(sizes)) if sizes else (1, 0)


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """Per document: best licence, its Dice, the names of all licences found, segments compared and matched."""
    parts = sorted((name, bigrams_of(text)) for name, text in templates.items())
    parts = [p for p in parts if p[1]]
    low = min(bounds(len(b), least)[0] for _, b in parts)
    high = max(bounds(len(b), least)[1] for _, b in parts)
    vocabulary = F.array(*[F.lit(x) for x in sorted({x for _, b in parts for x in b})])

    def clean(text: Column) -> Column:
        return F.trim(F.regexp_replace(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "[^a-z0-9]+", " "))

    def bigrams(w: Column) -> Column:
        pairs = F.zip_with(w, F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.array_distinct(F.filter(pairs, lambda p: p.isNotNull()))

    def dice(b: Column, template: list[str]) -> Column:
        lo, hi = bounds(len(template), least)
        both = F.size(F.array_intersect(b, F.array(*[F.lit(x) for x in template])))
        return F.when((F.size(b) >= lo) & (F.size(b) <= hi), 2.0 * both / (F.size(b) + len(template)))

    none = F.array().cast("array<struct<d:double,name:string>>")

    def hits(b: Column, candidates) -> Column:
        found = F.array(*[F.struct((-dice(b, t)).alias("d"), F.lit(name).alias("name")) for name, t in candidates])
        return F.filter(found, lambda x: x["d"] <= -least)

    text = F.coalesce(F.col("text"), F.lit(""))
    segments = F.transform(F.split(text, "\n"), clean)
    # distinct bigrams can't outnumber words, so too short a segment is out before its bigrams are made;
    # one of repeated words can be long, so only the whole text's own line breaks bound it from above
    whole = F.col("lic_whole")
    segments = F.filter(F.concat(segments, F.when(F.instr(text, "\n") > 0, F.array(whole)).otherwise(F.array().cast("array<string>"))), lambda s: F.length(s) - F.length(F.translate(s, " ", "")) >= low)
    # a segment without a template's bigram has Dice 0 whatever its size
    sets = F.filter(F.transform(segments, lambda s: bigrams(F.split(s, " "))), lambda b: (F.size(b) >= low) & (F.size(b) <= high) & F.arrays_overlap(b, vocabulary))
    in_segments = F.flatten(F.transform(sets, lambda b: hits(b, parts)))

    # windows: most texts have none of the anchors, which is seen without taking them apart
    by_name = dict(parts)
    marks = [(name, anchors_of(templates[name]), len(words_of(templates[name]))) for name, _ in parts]
    every = sorted({a for _, found, _ in marks for a, _ in found})
    words = F.split(whole, " ")
    at = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(place).alias("place"), F.lit(k).alias("k")) for k, (_, found, _) in enumerate(marks) for a, place in found])

    def windows(w: Column) -> Column:
        """Distinct (template, first word) of a text's windows."""
        pairs = F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b))
        seen = F.filter(F.transform(pairs, lambda p, i: F.struct(p.alias("p"), i.alias("i"))), lambda x: x["p"].isin(*every))
        laid = F.flatten(F.transform(seen, lambda x: F.transform(F.filter(at, lambda m: m["a"] == x["p"]), lambda m: F.struct(m["k"].alias("k"), F.greatest(x["i"] - m["place"], F.lit(0)).alias("s")))))
        return F.array_distinct(laid)

    def in_window(w: Column, x: Column) -> Column:
        out = none
        for k, (name, _, n) in enumerate(marks):
            out = F.when(x["k"] == k, _let(bigrams(F.slice(w, x["s"] + 1, F.lit(n))), lambda b: hits(b, [(name, by_name[name])]))).otherwise(out)  # noqa: B023
        return out

    anchored = F.lit(False)
    for a in every:
        anchored = anchored | F.contains(whole, F.lit(a))
    in_windows = F.when(anchored, _let(words, lambda w: F.flatten(F.transform(windows(w), lambda x: in_window(w, x))))).otherwise(none)
    rows = docs.select("doc_id", F.col("text")).withColumn("lic_whole", clean(text)).select("doc_id", F.concat(in_segments, in_windows).alias("found"))
    return rows.select(
        "doc_id",
        F.array_min("found")["name"].alias("license"),
        F.coalesce(-F.array_min("found")["d"], F.lit(0.0)).alias("dice"),
        F.array_join(F.array_sort(F.array_distinct("found.name")), ",").alias("licenses"),
        F.size("found").alias("n_matches"),
    )


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)
