"""Operator 7, license scans: MinHash bands over overlapping windows, in native expressions only.

Templates and documents are sequences of word shingles. A template with t
shingles is cut into windows of s shingles at every offset, s being the
largest power of two that leaves room for half a window more; documents are
cut into windows of the same sizes that overlap by half, so a verbatim copy
of a template holds a document window that equals a template window, and its
MinHash values do too. ``BANDS`` bands of ``ROWS`` MinHash values retrieve
templates: windows of similarity J meet with probability
1 - (1 - J^ROWS)^BANDS, above 0.99999 at 0.8. Exact shingle containment in
the text around the window then verifies each candidate.

Document windows without any template shingle share no MinHash value with a
template and are skipped before hashing. The templates are a parameter of
bounded size (``MAX_TEMPLATE_WORDS``), so their bands are broadcast;
documents are not shuffled but for one short row each.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from smartmaint.llm.common import ascii_lower, table

SHINGLE = 5
BANDS, ROWS = 12, 2
SIMILARITY = 0.8
MAX_TEMPLATE_WORDS = 100_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of lower-cased text: all ASCII but digits and letters

# The bodies of short licenses, whole.
_BODIES = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included
in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""),
    ("BSD", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software."""),
]

# Titles and first clauses by which the bodies of long licenses show (the GNU titles are among _FORMS).
_PASSAGES = [
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 "
                   "through 9 of this document."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "\"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered "
                "Software."),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("EUPL-1.2", "European Union Public Licence v. 1.2"),
    ("BSL-1.0", "Boost Software License - Version 1.0"),
]

# General short forms: each name with each lead of _LEADS.
_NAMES = [("MIT", "MIT License"), ("ISC", "ISC License"), ("Zlib", "zlib License"), ("BSD", "BSD License")]
_LEADS = ["Licensed under the", "Released under the", "Distributed under the", "Available under the", "Published under the",
          "Provided under the", "The terms of the"]

# A version or kind at the end must change more than a fifth of a form's shingles, or its neighbours match too.
_FORMS = [
    ("Apache-2.0", "the Apache License, Version 2.0"), ("Apache-2.0", "the Apache License 2.0"), ("Apache-2.0", "the Apache 2.0 License"),
    ("BSD", "the BSD 2-Clause License"), ("BSD", "the BSD 3-Clause License"), ("CC0-1.0", "the CC0 1.0 Universal"),
    ("Unlicense", "the terms of the Unlicense"),
    *[(f"{k}-{v}", f"{name} {word}{v.removesuffix('.0')}") for k, name, versions in (
        ("GPL", "GNU General Public License", ("2.0", "3.0")), ("LGPL", "GNU Lesser General Public License", ("2.1", "3.0")),
        ("AGPL", "GNU Affero General Public License", ("3.0",))) for v in versions for word in ("version ", "v")],
    *[(f"{k}-{v}", f"under the terms of the {name} as published by the Free Software Foundation, either version {v.removesuffix('.0')} of the "
       "License") for k, name, versions in (
        ("GPL", "GNU General Public License", ("2.0", "3.0")), ("LGPL", "GNU Lesser General Public License", ("2.1", "3.0")),
        ("AGPL", "GNU Affero General Public License", ("3.0",))) for v in versions],
    *[(f"CC-BY-{v}", f"{lead} CC BY {v}") for v in ("3.0", "4.0") for lead in ("Licensed under", "Released under", "Available under",
                                                                             "Distributed under")],
    *[(f"CC-{k}-{v}", f"CC {k.replace('-', ' ')} {v}") for k in ("BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND") for v in ("3.0", "4.0")],
    *[(f"CC-{k}-{v}", f"Creative Commons {name} {v} {scope}") for k, name in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
        ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")) for v, scope in (("3.0", "Unported"), ("4.0", "International"))],
]

# Statements, passages and bodies by which texts state their license.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    *_BODIES, *_PASSAGES, *_FORMS,
    *[(k, f"{lead} {name}") for k, name in _NAMES for lead in _LEADS],
]


def window_size(shingles: int) -> int:
    """The largest power of two s with s + max(1, s / 2) - 1 <= shingles."""
    s = 1
    while 2 * s + s - 1 <= shingles:
        s *= 2
    return s


def _words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def _shingles(words: Column, k: int) -> Column:
    """64-bit hashes of the k-word shingles, in order (fewer words: none)."""
    at = F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))


def _bands(window: Column) -> Column:
    """One key for each band: its number and its MinHash values."""
    def least(k: int) -> Column:
        return F.array_min(F.transform(window, lambda x: F.xxhash64(F.lit(k), x)))
    return F.array(*[F.xxhash64(F.lit(b), *[least(b * ROWS + r) for r in range(ROWS)]) for b in range(BANDS)])


def _plain(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]


def template_bands(spark: SparkSession, templates: list[tuple[str, str]], shingle: int) -> tuple[DataFrame, DataFrame]:
    """(size, band, tid) for every window of every template of at least ``shingle`` words, and once for each
    template (tid, name, size, parts); ``parts`` are its distinct shingles."""
    usable = [(n, t) for n, t in templates if len(_plain(t)) >= shingle]
    if sum(len(_plain(t)) for _, t in templates) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates exceed {MAX_TEMPLATE_WORDS} words")
    df = spark.createDataFrame([(i, n, t, window_size(len(_plain(t)) - shingle + 1)) for i, (n, t) in enumerate(usable)],
                               "tid int, name string, text string, size int")
    h = df.select("tid", "name", "size", _shingles(_words(F.col("text")), shingle).alias("h"))
    starts = F.sequence(F.lit(0), F.size("h") - F.col("size"))
    wins = h.select("tid", "size", F.explode(F.transform(starts, lambda i: F.slice(F.col("h"), i + 1, F.col("size")))).alias("w"))
    return wins.select("tid", "size", F.explode(_bands(F.col("w"))).alias("band")).distinct(), \
        h.select("tid", "name", "size", F.array_distinct("h").alias("parts"))


def _short_matches(words: Column, short: list[tuple[str, str]]) -> Column:
    """Structs (name, c, at) of the templates under a shingle's length whose whole word sequence is in the text."""
    line = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    each = []
    for name, text in short:
        at = F.instr(line, " " + " ".join(_plain(text)) + " ")
        before = F.substring(line, F.lit(1), at)
        each.append(F.when(at > 0, F.struct(F.lit(name).alias("name"), F.lit(-1.0).alias("c"),
                                            (F.length(before) - F.length(F.translate(before, " ", "")) - 1).cast("int").alias("at"))))
    return F.array_compact(F.array(*each))


def scan_licenses(docs: DataFrame, templates: DataFrame | list[tuple[str, str]] | None = None, keep: list[str] | None = None,
                  shingle: int = SHINGLE, similarity: float = SIMILARITY, text_col: str = "text") -> DataFrame:
    """The ``keep`` columns (default: all but the text) and ``licenses`` of every row.

    ``licenses`` is an array of (name, word, containment): the templates' names in
    order, the first word of the window of the best match, and the share of the template's distinct shingles in the text around it,
    at least ``similarity``. Words are runs of digits, letters a-z after
    lower-casing A-Z, and non-ASCII characters.

    ``templates`` is a list or a table of (name, text), of whole license texts
    or of statements, ``MAX_TEMPLATE_WORDS`` words in all. Templates under
    ``shingle`` words match by their whole word sequence; those without any
    word match nothing.

    Null and empty texts have no match. Whole texts are scanned. Repeated rows and null ids give rows
    like others; an empty table gives no rows.
    """
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    if isinstance(templates, DataFrame):
        templates = [(n, t) for n, t in templates.select("name", "text").limit(MAX_TEMPLATE_WORDS + 1).collect() if t]
    short = [(n, t) for n, t in templates if 0 < len(_plain(t)) < shingle]
    bands, whole = template_bands(spark, templates, shingle)
    info = whole.collect()  # bounded by MAX_TEMPLATE_WORDS
    known = sorted({x for r in info for x in r["parts"]})
    sizes = sorted({r["size"] for r in info})
    reach = F.lit(0)
    for s in sizes:
        # a template is as long as its shingles, repeated ones included: below three windows
        reach = F.when(F.col("x.s") == s, 3 * s).otherwise(reach)

    row = [F.col(f"c{i}") for i in range(len(keep))]
    src = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(keep)], docs[text_col].cast("string").alias("text")) \
        .withColumn("row", F.monotonically_increasing_id())
    words = src.select("row", *row, _words(F.coalesce("text", F.lit(""))).alias("w"))
    if short:  # then one more column of each row
        words = words.withColumn("short", _short_matches(F.col("w"), short))
        row.append(F.col("short"))
    hashed = words.select("row", *row, _shingles(F.col("w"), shingle).alias("h"))
    hits = F.filter(F.transform("h", lambda x, i: F.when(x.isin(known), i)), lambda i: i.isNotNull())
    hit = hashed.select("row", *row, "h", hits.alias("hits"))

    def starts(s: int) -> Column:
        step = max(1, s // 2)
        near = F.flatten(F.transform("hits", lambda p: F.array(*[F.floor(p / step) * step - j * step for j in range(s // step)])))
        return F.transform(F.array_distinct(F.filter(near, lambda g: g >= 0)), lambda g: F.struct(F.lit(s).alias("s"), g.cast("int").alias("at")))

    windows = F.concat(*[starts(s) for s in sizes]) if sizes else F.array().cast("array<struct<s:int,at:int>>")
    cut = hit.select("row", *row, "h", F.explode_outer(windows).alias("x"))
    around = F.greatest(F.lit(0), F.col("x.at") - reach)
    cut = cut.select("row", *row, F.col("x.s").alias("size"), F.col("x.at").alias("at"), F.slice("h", F.col("x.at") + 1, F.col("x.s")).alias("win"),
                     F.slice("h", around + 1, F.col("x.at") - around + F.col("x.s") + reach).alias("region"))
    probes = cut.select("row", *row, "size", "at", "region", F.explode_outer(F.when(F.col("size").isNotNull(), _bands(F.col("win")))).alias("band"))
    met = probes.join(F.broadcast(bands), ["size", "band"], "left").join(F.broadcast(whole.select("tid", "name", "parts")), "tid", "left")
    share = F.size(F.array_intersect("region", "parts")) / F.size("parts")
    found = met.select("row", *row, F.when(share >= similarity, F.struct("name", (-share).alias("c"), F.col("at"))).alias("m"))
    lists = found.groupBy("row", *row).agg(F.array_sort(F.collect_set("m")).alias("m"))
    if short:
        lists = lists.withColumn("m", F.array_sort(F.concat("m", "short")))
    names = F.array_distinct(F.transform("m", lambda x: x["name"]))
    best = F.transform(names, lambda n: F.get(F.filter("m", lambda x: x["name"] == n), 0))
    return lists.select(*[c.alias(k) for c, k in zip(row, keep)], F.transform(best, lambda x: F.struct(
        x["name"].alias("name"), x["at"].alias("word"), (-x["c"]).alias("containment"))).alias("licenses"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the licenses whose notices it holds."""
    found = scan_licenses(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"),
                        F.array_join(F.transform("licenses", lambda x: x["name"]), ",").alias("licenses"))


def _oracle() -> str:
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = "list_filter(regexp_split_to_array(" + lower + ", '" + SEPARATORS + "'), lambda x: x <> '')"
    values = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(TEMPLATES))
    cut = "SELECT DISTINCT {0}, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT {0}, w, unnest(range(1, len(w) - 3)) AS i FROM {1})"
    return f"""
WITH t AS (SELECT tid, name, {words.format('text')} AS w FROM (VALUES {values}) AS v(tid, name, text)),
d AS (SELECT doc_id, {words.format("coalesce(text, '')")} AS w FROM documents),
ts AS ({cut.format('tid, name', 't')}),
ds AS ({cut.format('doc_id', 'd')}),
n AS (SELECT tid, name, count(*) AS total FROM ts GROUP BY ALL),
m AS (SELECT doc_id, tid, count(*) AS shared FROM ds JOIN ts USING (s) GROUP BY ALL),
f AS (SELECT DISTINCT doc_id, name FROM m JOIN n USING (tid) WHERE shared >= 0.8 * total)
SELECT doc_id, count(name) AS n_licenses, coalesce(string_agg(name, ',' ORDER BY name), '') AS licenses
FROM documents LEFT JOIN f USING (doc_id) GROUP BY doc_id
"""


ORACLE = _oracle()
