"""Operator 2, line dedup by a deletion-neighbourhood join.

Lines are sequences of words (split at ASCII white space). A line goes if an
equal line comes earlier, or, from ``min_words`` words on, a line within one
word edit (a word replaced, inserted or left out); the earliest stays.

1. Equal lines meet in one aggregate: 128 hash bits, first place, count.
2. A line within one edit of another shares its first or last half with it.
   Lines that share no half with a different line cannot have a partner and
   emit no variants (keys of the halves, aggregated).
3. Every other line emits its deletion neighbourhood as hashed keys: the line
   without word i, for all i, keyed by i for replacements; and keyed alone,
   to meet whole lines that are one word shorter.
4. Equal variants join. All lines of a replacement key differ in that one word,
   so each needs only the key's earliest line; likewise the whole line and the
   longer ones of an insertion key. No pairs within a group are listed.
5. Candidate pairs are verified by their word edit distance.

Decisions go back to the documents as line numbers. Very common lines are
combined before any shuffle and met by equi-joins that can be split.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from smartmaint.llm.common import bounded_batches, materialize, row_slices, table

MIN_WORDS = 8
BROADCAST_ROWS = 500_000  # a counted side of up to so many short rows is broadcast, a larger one is shuffled

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def small(side: DataFrame) -> DataFrame:
    """Mark a written side for broadcast if its counted rows are few."""
    return F.broadcast(side) if side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else side


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, line_no, place, words, h1, h2) of every line that has a word; ``place`` orders the lines of all documents."""
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.xxhash64(docs[text_col]).alias("th"),
                       F.posexplode(F.split(docs[text_col].cast("string"), "\n")).alias("line_no", "line"))
    # byte searches first: few lines need the pattern
    uneven = reduce(Column.__or__, [F.contains("line", F.lit(x)) for x in ("  ", "\t", "\v", "\f", "\r")])
    spaced = F.when(uneven, F.regexp_replace("line", r"[\x20\x09-\x0D]+", " ")).otherwise(F.col("line"))
    # id (null: last), 30 bits of the text's hash, line number in one number below 10^38
    row = F.coalesce(F.col("id").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)"), F.lit(str(1 << 64)).cast("decimal(20,0)"))
    low = F.shiftleft(F.col("th").bitwiseAND(F.lit((1 << 30) - 1)), 32) + F.col("line_no")
    place = row.cast("decimal(38,0)") * F.lit(str(1 << 62)).cast("decimal(19,0)") + low.cast("decimal(20,0)")
    return rows.select("id", "th", "line_no", place.cast("decimal(38,0)").alias("place"), F.trim(spaced).alias("words")) \
        .filter("words != ''") \
        .withColumns({"h1": F.xxhash64("words"), "h2": F.xxhash64(F.lit(7), "words")})


def _halves(n: Column, words: Column, min_words: int) -> list[Column]:
    """Keys of the first and last q words, for q of the line's own length and of a partner one word shorter."""
    out = []
    for q, when in ((F.floor(n / 2), n >= min_words), (F.floor((n - 1) / 2), (n >= min_words) & (n % 2 == 0))):
        q = q.cast("int")
        for side, count in (("first", q), ("last", -q)):
            out.append(F.when(when, F.xxhash64(F.lit(side), q, F.call_function("substring_index", words, F.lit(" "), count))))
    return out


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, kind, h1, h2, place): kind 0 whole line, 1 one word left out, 2 word i left out at place i."""
    import xxhash
    u64 = np.uint64
    mix, salt = u64(0xD6E8FEB86659FD93), u64(0xC2B2AE3D27D4EB4F)
    with np.errstate(over="ignore"):
        for b in row_slices(batches, "words", 1 << 18):
            keys, kinds, counts = [np.empty(0, u64)], [np.empty(0, np.int8)], []
            for words in b.column(b.schema.get_field_index("words")).to_pylist():
                w = words.split(" ")
                n = len(w)
                h = np.fromiter(map(xxhash.xxh64_intdigest, w), u64, n)
                terms = h * np.cumprod(np.full(n, _ODD, u64))
                upto = np.cumsum(terms)
                left_out = (upto - terms) + (upto[-1] - upto) * u64(_INVERSE)
                at = np.arange(1, n + 1, dtype=u64) * salt + u64(n)
                alone = np.unique(left_out)
                keys += [(upto[-1:] ^ u64(n)) * mix, (alone ^ u64(n - 1)) * mix, (left_out ^ at) * mix + u64(1)]
                kinds.append(np.repeat(np.array([0, 1, 2], np.int8), [1, len(alone), n]))
                counts.append(1 + len(alone) + n)
            line = b.select(["h1", "h2", "place"]).take(pa.array(np.repeat(np.arange(len(counts)), counts)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(kinds)), *line.columns],
                names=["key", "kind", "h1", "h2", "place"])


def within_one_edit(a: list[str], b: list[str]) -> bool:
    """Whether the word edit distance of two sequences is at most one."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    p = 0
    while p < len(a) and a[p] == b[p]:
        p += 1
    return a[p + (len(a) == len(b)):] == b[p + 1:]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        near = [within_one_edit(x.split(" "), y.split(" ")) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["h1", "h2"]).filter(pa.array(near, pa.bool_()))


def near_lines(lines: DataFrame, distinct: DataFrame) -> DataFrame:
    """(h1, h2) of the distinct lines that have an earlier line within one word edit."""
    halves = distinct.select("h1", F.explode(F.array("k1", "k2", "k3", "k4")).alias("k")).filter("k IS NOT NULL")
    shared = halves.groupBy("k").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).filter("a != b").select("k")
    able = halves.join(shared, "k", "left_semi").select("h1").distinct()
    able = materialize(distinct.join(able, "h1", "left_semi").select("h1", "h2", "place"))
    texts = materialize(lines.join(small(able), ["h1", "h2", "place"], "left_semi").select("h1", "h2", "place", "words")
                        .dropDuplicates(["h1", "h2"]))
    variants = bounded_batches(texts).mapInArrow(_variants, "key long, kind byte, h1 long, h2 long, place decimal(38,0)")
    met = variants.groupBy("key").agg(F.count("*").alias("n"), F.min(F.when(F.col("kind") != 1, F.col("place"))).alias("whole"),
                                      F.min(F.when(F.col("kind") == 1, F.col("place"))).alias("longer")).filter("n > 1")
    pairs = variants.join(small(materialize(met)), "key").select(
        "h1", "h2", "place", F.when(F.col("kind") == 0, F.col("longer")).otherwise(F.col("whole")).alias("earlier")) \
        .filter("earlier < place").select("h1", "h2", "earlier").distinct()
    early = texts.select(F.col("place").alias("earlier"), F.col("words").alias("early"))
    pairs = pairs.join(texts.select("h1", "h2", "words"), ["h1", "h2"]).join(early, "earlier").select("h1", "h2", "words", "early")
    return pairs.mapInArrow(_verified, "h1 long, h2 long").distinct()


def removed_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, removed): for each document that loses lines, their numbers; ``th`` is the hash of its text."""
    lines = lines_of(docs, id_col, text_col)
    n = F.length("words") - F.length(F.replace(F.col("words"), F.lit(" "), F.lit(""))) + 1
    keyed = lines.withColumn("n", n)
    # lines as short rows, written once: who has which, and the keys of its halves
    keyed = materialize(keyed.select("id", "th", "line_no", "h1", "h2", "place",
                                     *[k.alias(f"k{i}") for i, k in enumerate(_halves(F.col("n"), F.col("words"), min_words), 1)]))
    # the halves follow from the line, so they may be grouping keys
    distinct = materialize(keyed.groupBy("h1", "h2", "k1", "k2", "k3", "k4").agg(F.min("place").alias("place"), F.count("*").alias("n")))
    near = near_lines(lines, distinct).withColumn("near", F.lit(True))
    repeated = distinct.select("h1", "h2", F.col("place").alias("first"), "n").join(near, ["h1", "h2"], "left") \
        .filter("n > 1 OR near").select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    gone = keyed.select("id", "th", "line_no", "place", "h1", "h2").join(small(materialize(repeated)), ["h1", "h2"]) \
        .filter("near OR place != first")
    return gone.groupBy("id", "th").agg(F.collect_set("line_no").alias("removed"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated and nearly repeated lines taken out, and a last column of their numbers.

    The last column is ``__removed``, with more underscores in front if
    ``docs`` has that name. A line goes if an equal line, or from ``min_words``
    words on a line within one word edit, comes earlier in the order (id, hash
    of the text, line number); null ids come last. Every row stays, if need be
    with an empty text, and lines without a
    word stay where they are. Rows equal in id and text count as one document
    and lose the same lines. Null texts stay null. An empty table gives no
    rows. All other columns pass, whatever their names.
    """
    taken = {c.lower() for c in docs.columns}

    def free(name: str) -> str:
        while name in taken:
            name = "_" + name
        return name

    i, t, removed = free("__id"), free("__th"), free("__removed")
    gone = removed_lines(docs, min_words, id_col, text_col).select(F.col("id").alias(i), F.col("th").alias(t), F.col("removed").alias(removed))
    lines = F.split(docs[text_col], "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone[removed])
    kept = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    out = docs.join(gone, docs[id_col].cast("long").eqNullSafe(gone[i]) & (F.xxhash64(docs[text_col]) == gone[t]), "left")
    return out.select(*[F.when(gone[removed].isNull(), docs[c]).otherwise(kept).alias(c) if c == text_col else docs[c]
                        for c in docs.columns], F.coalesce(gone[removed], F.array().cast("array<int>")).alias(removed))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines removed and the hash of the text that stays."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.size("__removed").cast("long").alias("n_removed"),
                      F.length(F.coalesce("text", F.lit(""))).cast("long").alias("kept_chars"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


# Equal lines by text, one-edit neighbours by text with one word left out.
ORACLE = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents),
w AS (SELECT doc_id, no, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM l),
d AS (SELECT array_to_string(ws, ' ') AS line, any_value(ws) AS ws, min({'d': doc_id, 'n': no}) AS place FROM w WHERE len(ws) > 0 GROUP BY 1),
b AS (SELECT * FROM d WHERE len(ws) >= 8),
v AS (SELECT line, place, len(ws) AS n, i, array_to_string(list_concat(ws[1 : i - 1], ws[i + 1 :]), ' ') AS rest
      FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM b)),
near AS (SELECT x.line FROM v x JOIN v y ON x.rest = y.rest AND x.i = y.i AND x.n = y.n AND y.place < x.place
         UNION SELECT x.line FROM v x JOIN b y ON x.rest = y.line AND y.place < x.place
         UNION SELECT y.line FROM v x JOIN b y ON x.rest = y.line AND x.place < y.place),
k AS (SELECT w.doc_id, w.no, len(w.ws) > 0 AND (d.place <> {'d': doc_id, 'n': no} OR near.line IS NOT NULL) AS gone
      FROM w LEFT JOIN d ON d.line = array_to_string(w.ws, ' ') LEFT JOIN near ON near.line = d.line),
o AS (SELECT doc_id, count(*) FILTER (coalesce(gone, false)) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT coalesce(gone, false)), '') AS kept
      FROM k JOIN l USING (doc_id, no) GROUP BY doc_id)
SELECT doc_id, n_removed, length(kept) AS kept_chars, sha256(kept) AS kept_sha256 FROM o
UNION ALL SELECT doc_id, 0, 0, sha256('') FROM documents WHERE text IS NULL
"""
