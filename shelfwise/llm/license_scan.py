"""License scan (native): phrases, and an exact set-similarity join with license templates.

A text's words are lower-cased runs of letters, digits and non-ASCII
characters. Base labels come from phrases whose words stand consecutively.
Further labels come from notices and whole license texts: a text is covered by
overlapping blocks of words, and a block matches a template if it holds at
least ``threshold`` of the template's distinct words. Templates are classed by
length, in powers of two; the blocks of a class are twice its length, one length
apart, so that any passage as long as a template lies whole in some block.

The join orders template words by the number of documents that hold them,
rarest first, and finds every match by

* length: a text, then a block, with too few template words is out;
* prefix: of a template with n words that must share k, one of the n-k+1
  rarest is in the block (a text without any of these words is not looked at
  further), and likewise one of the block's own prefix;
* position: words that stand after a first shared word bound the overlap.

What is left is verified on the whole sets.

Scale: texts are read twice, to count template words and to scan. What goes on
is a few numbers of each text, and the words of those texts that hold a prefix
word of some template. Of these only template words are dealt to blocks, each
to two blocks of every class that has the word. Templates are tables (a row for
each word, prefix word and template), so the plan does not grow with their
number; the driver holds them and a count for each of their words.

Nulls and edge cases: a null text is empty and has no words (0 places, empty
labels, score 0). Ids are carried only: null and repeated ids are rows of
their own. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import col, cut_lineage

# Phrases with their labels.
PHRASES = {
    "the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Notices as they commonly stand in texts, and whole texts of short licenses; any number for a label.
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
          "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
          "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
          "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
          "IN THE SOFTWARE.")
_BSD_TWO = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
            "of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
            "notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
            "provided with the distribution.")
_BSD_THREE = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission.")
_BSD_AS_IS = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
              "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
              "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
              "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
              "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
              "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
              "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
TEMPLATES = {
    "mit": ["Released under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
            "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
            "Software. " + _AS_IS],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
            "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
            "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
            "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
            "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
            "PERFORMANCE OF THIS SOFTWARE."],
    "apache-2": ["Licensed under the Apache License, Version 2.0",
                 "you may not use this file except in compliance with the License",
                 "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                 "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
                 "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                 "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See "
                 "the License for the specific language governing permissions and limitations under the License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0",
                 "licensed under a Creative Commons Attribution-NonCommercial license"],
    "gpl": ["This work is licensed under the GNU General Public License",
            "redistribute it and/or modify it under the terms of the GNU General Public License",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
            "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
            "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
            "License for more details. You should have received a copy of the GNU General Public License along with this "
            "program. If not, see https://www.gnu.org/licenses/."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met",
            _BSD_TWO + " " + _BSD_AS_IS, _BSD_TWO + " " + _BSD_THREE + " " + _BSD_AS_IS],
    "mpl-2": ["subject to the terms of the Mozilla Public License, v. 2.0",
              "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
              "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
}
THRESHOLD = 0.85
SHORTEST = 8   # words of the shortest class of templates

# What separates words once A-Z are lower-cased: ASCII but for a-z and 0-9.
# Single characters, not ranges: Java's regex tests them in one bitmap.
_SEPARATORS = "".join(f"\\x{i:02x}" for i in range(0x80) if not chr(i).isalnum())
# The one character outside ASCII that lower() turns into an ASCII letter.
_KELVIN = "\u212a"


def template_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def class_of(text: str) -> int:
    """The length of a template's class: a power of two, at least its number of words."""
    n = SHORTEST
    while n < len(template_words(text)):
        n *= 2
    return n


def _spaced(text: str) -> Column:
    """The words of a text with one blank between; empty if there is none."""
    c = F.replace(F.coalesce(col(text).cast("string"), F.lit("")), F.lit(_KELVIN), F.lit("\u0138"))
    return F.trim(F.lower(F.regexp_replace(c, f"[{_SEPARATORS}]+", " ")))


def _phrase(padded: Column, n_words: Column, phrase: str) -> tuple[Column, Column, Column]:
    """Number of places, first and last start of ``phrase`` in blank-padded words."""
    parts = F.split(padded, f" {phrase}(?= )", -1)
    found = F.contains(padded, F.lit(f" {phrase} "))

    def blanks(c: Column) -> Column:
        return F.char_length(c) - F.char_length(F.replace(c, F.lit(" "), F.lit("")))

    k = len(phrase.split())
    return (F.when(found, F.size(parts) - 1).otherwise(0),
            F.when(found, blanks(parts[0])),
            F.when(found, n_words - (blanks(F.element_at(parts, -1)) - 1) - k))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         phrases: dict[str, str] | None = None, templates: dict[str, list[str]] | None = None,
         threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels``, ``score`` and ``matches``, an array of
    (``label``, ``containment``, ``start``): the best block of each label found by the join."""
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    notices = [(label, class_of(t), sorted(set(template_words(t)))) for label, ts in templates.items() for t in ts]
    notices = [(label, step, words, math.ceil(threshold * len(words) - 1e-9)) for label, step, words in notices if words]
    vocabulary = sorted({w for _, _, words, _ in notices for w in words})
    order, first = [], []        # template words, rarest first, and those that stand in some prefix
    if notices:
        held = docs.select(F.explode(F.array_distinct(F.filter(F.split(_spaced(text_col), " "), lambda w: w.isin(vocabulary)))).alias("w"))
        # Bounded by the templates' words: each is one row here.
        known = {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
        order = sorted(vocabulary, key=lambda w: (known.get(w, 0), w))
        rank = {w: i for i, w in enumerate(order)}
        first = sorted({w for _, _, words, k in notices for w in sorted(words, key=rank.get)[:len(words) - k + 1]})

    rows = docs.select(col(id_col).alias("id"), _spaced(text_col).alias("spaced"))
    rows = rows.select("id", F.concat(F.lit(" "), "spaced", F.lit(" ")).alias("padded"),
                       F.when(F.col("spaced") == "", F.array().cast("array<string>"))
                       .otherwise(F.split("spaced", " ")).alias("words"))
    n_words = F.size("words").cast("long")
    places = [_phrase(F.col("padded"), n_words, p) for p in phrases]
    none = F.lit(None).cast("long")
    base = sorted(set(phrases.values()))
    rows = rows.select(
        "id", "words", n_words.alias("n_words"),
        sum((n for n, _, _ in places), F.lit(0)).cast("long").alias("n_base"),
        F.least(*[f for _, f, _ in places], none, none).cast("long").alias("first_word"),
        F.greatest(*[x for _, _, x in places], none, none).cast("long").alias("last_word"),
        F.filter(F.array(*[F.when(F.greatest(*[places[i][0] for i, p in enumerate(phrases)
                                               if phrases[p] == label], F.lit(0)) > 0, F.lit(label))
                           for label in base]).cast("array<string>"),
                 lambda x: x.isNotNull()).alias("base"))
    may = F.exists("words", lambda w: w.isin(first)) if first else F.lit(False)
    rows = rows.withColumn("words", F.when(may, F.col("words")))
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))
    if notices:
        matches = _join(rows.where("words is not null").select("row", "words"), notices, order)
        per_doc = matches.groupBy("row").agg(F.sort_array(F.collect_list("m")).alias("matches"))
        rows = rows.drop("words").join(per_doc, "row", "left")
    else:
        rows = rows.withColumn("matches", F.lit(None).cast("array<struct<label:string,containment:double,start:long>>"))
    found = F.coalesce("matches", F.array().cast("array<struct<label:string,containment:double,start:long>>"))
    labels = F.array_sort(F.array_union("base", F.transform(found, lambda m: m["label"])))
    return rows.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0)
        .otherwise(F.coalesce(F.array_max(F.transform(found, lambda m: m["containment"])), F.lit(0.0)))
        .alias("score"), found.alias("matches"))


def _join(texts: DataFrame, notices: list, order: list[str]) -> DataFrame:
    """(row, m): the best block of each label that reaches the threshold, for ``texts``
    (row, words)."""
    spark = texts.sparkSession
    rank = {w: i + 1 for i, w in enumerate(order)}
    prefixes, whole, steps, least = [], [], {}, {}
    for n, (label, step, words, k) in enumerate(notices):
        ranks = sorted(rank[w] for w in words)
        prefixes += [(step, r, n, k, len(ranks), at) for at, r in enumerate(ranks[:len(ranks) - k + 1])]
        whole.append((n, label, ranks))
        least[step] = min(k, least.get(step, k))
        for w in words:
            steps.setdefault(w, set()).add(step)
    prefixes = spark.createDataFrame(prefixes, "step int, rank int, template int, needed int, theirs_n int, their_at int")
    whole = spark.createDataFrame(whole, "template int, label string, theirs array<int>")
    known = spark.createDataFrame([(w, r, sorted(steps[w])) for w, r in rank.items()], "word string, rank int, steps array<int>")
    classes = spark.createDataFrame(sorted(least.items()), "step int, least int")

    # Every template word, in the two blocks of each of its classes that hold its place.
    placed = texts.select("row", F.posexplode("words").alias("pos", "word")).join(known, "word")
    placed = placed.select("row", "pos", "rank", F.explode("steps").alias("step"))
    start = F.floor(F.col("pos") / F.col("step")) * F.col("step")
    placed = placed.select("row", "rank", "step", F.explode(F.array(start, start - F.col("step"))).alias("start")).where("start >= 0")
    blocks = (placed.groupBy("row", "step", "start").agg(F.sort_array(F.collect_set("rank")).alias("ours"))
              .join(classes, "step").where(F.size("ours") >= F.col("least")))
    ours = blocks.select("row", "step", "start", "ours", F.posexplode(
        F.slice("ours", F.lit(1), F.size("ours") - F.col("least") + 1)).alias("our_at", "rank"))
    after = F.least(F.col("theirs_n") - F.col("their_at"), F.size("ours") - F.col("our_at"))
    pairs = (ours.join(prefixes, ["step", "rank"]).where((F.size("ours") >= F.col("needed")) & (after >= F.col("needed")))
             .select("row", "start", "ours", "template", "needed").join(whole, "template"))
    overlap = F.size(F.array_intersect("ours", "theirs"))
    good = pairs.where(overlap >= F.col("needed")).select(
        "row", "label", (overlap / F.size("theirs")).alias("containment"), "start")
    best = good.groupBy("row", "label").agg(F.max(F.struct("containment", (-F.col("start")).alias("back"))).alias("x"))
    return best.select("row", F.struct("label", F.col("x.containment").alias("containment"),
                                       (-F.col("x.back")).alias("start")).alias("m"))
