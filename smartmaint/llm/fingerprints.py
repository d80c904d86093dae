"""Operator 13, document fingerprints by one-permutation MinHash (DataFrame functions only).

1. Words (lower-cased A-Z, cut at ASCII white space) give 5-word shingles;
   each is hashed once. The hash's top bits name one of ``BINS`` bins, and a
   bin keeps its least hash: one sort of the hashes, in which a sentinel for
   each bin stands last, leaves the first of each bin.
2. Optimal densification: an empty bin visits the bins in an order of its own
   (a fixed pseudo-random walk that meets each bin once) and takes the value
   of the first filled one. So two texts that fill the same bins fill the
   others alike, and each filled bin is equally likely to be the donor.
3. The low ``BITS`` bits of each bin are packed, eight bins to a long.

Likeness: unrelated values agree in ``BITS`` bits with probability 2^-BITS, so
the share of equal bins s estimates (s - 2^-BITS) / (1 - 2^-BITS), cut to 0..1.
Equal bytes are counted on the packed longs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from smartmaint.llm.common import ascii_lower, materialize, table
from smartmaint.operators.windows import dense_sequence

SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
BITS = 8
_LOW = (1 << (64 - BIN_BITS)) - 1  # the part of a hash below its bin
_LONGS = BINS * BITS // 64


def _walks() -> list[int]:
    """Start and odd step of each bin's walk, packed as step * BINS + start, by a fixed mixing rule."""
    out = []
    for j in range(BINS):
        x = (j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % (1 << 64)
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB % (1 << 64)
        out.append(((x >> 40) % BINS | 1) * BINS + (x >> 20) % BINS)
    return out


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _bin(h: Column) -> Column:
    return F.shiftright(h, 64 - BIN_BITS)


def with_fingerprint(df: DataFrame, text: Column, out: str) -> DataFrame:
    """``df`` and the packed fingerprint of a non-null text (array of longs).

    Repeated shingles count once. Texts of fewer words than a shingle are one
    shingle, also those without a word. Whole texts are read.
    """
    words, hashes, bins = (f"__{out}_{x}" for x in ("w", "h", "b"))
    each = F.array_remove(F.split(ascii_lower(text), r"[\x20\x09-\x0D]+"), "")
    df = df.withColumn(words, F.transform(each, lambda w: F.xxhash64(w)))
    at = F.sequence(F.lit(0), F.size(words) - SHINGLE)
    shingles = F.when(F.size(words) < SHINGLE, F.array(F.xxhash64(words))).otherwise(
        F.transform(at, lambda i: F.xxhash64(*[F.get(F.col(words), i + j) for j in range(SHINGLE)])))
    # the largest hash of each bin stands last in it, so every bin has a first entry
    last = _longs([(j << (64 - BIN_BITS)) | _LOW for j in range(-BINS // 2, BINS // 2)])
    df = df.withColumn(hashes, F.sort_array(F.concat(shingles, last))).drop(words)
    h = F.col(hashes)
    first = F.filter(h, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(h, i - 1))))
    low = F.transform(first, lambda x: F.nullif(x.bitwiseAND(F.lit(_LOW)), F.lit(_LOW)))
    df = df.withColumn(bins, low).drop(hashes)
    b = F.col(bins)

    def filled(own: Column, walk: Column) -> Column:
        # evaluated from left to right, up to the first filled bin
        step = F.shiftright(walk, BIN_BITS)
        return F.coalesce(own, *[F.get(b, (walk + step * t).bitwiseAND(F.lit(BINS - 1)).cast("int")) for t in range(BINS)])

    dense = f"__{out}_d"
    df = df.withColumn(dense, F.zip_with(b, _longs(_walks()), filled)).drop(bins)
    d, per = F.col(dense), 64 // BITS

    def packed(i: Column) -> Column:
        long = F.lit(0).cast("long")
        for j in range(per):
            value = F.get(d, i * per + j).bitwiseAND(F.lit((1 << BITS) - 1))
            long = long.bitwiseOR(F.shiftleft(value, 64 - BITS * (j + 1)))
        return long

    return df.withColumn(out, F.transform(F.sequence(F.lit(0), F.lit(_LONGS - 1)), packed)).drop(dense)


def as_text(fingerprint: Column) -> Column:
    """Hexadecimal digits, ``BITS`` / 4 for each bin in order."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity (0 to 1) of the shingle sets behind two fingerprints."""
    def unequal(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        for shift in (4, 2, 1):  # every byte's lowest bit becomes 1 if any of its bits is
            z = z.bitwiseOR(F.shiftrightunsigned(z, shift))
        return F.bit_count(z.bitwiseAND(F.lit(0x0101010101010101)))

    differ = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda n, x: n + x.cast("int"))
    chance = 2.0 ** -BITS
    share = F.lit(1.0) - differ / F.lit(float(BINS))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (share - chance) / (1 - chance)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row; null texts count as empty; other columns play no part; an empty table gives no rows."""
    src = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    return with_fingerprint(src, F.col("text"), "fingerprint").select("id", "fingerprint")


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's text beside the next document's: (id, text, next_text) without text beyond what ``edited`` needs.

    Documents go by descending id (null ids last), ties by two text hashes;
    after the last comes the first. Rows equal in id and text are one document
    of the order, and every one of them is returned. ``next_head`` are the next
    text's first code points, as many as a third of the own text's; ``next_fp``
    is its fingerprint.

    Only short rows are sorted. Texts are shuffled once, by hash, and meet the
    short rows twice on that partitioning: as a next text, which hands its head
    on, and as an own one.
    """
    src = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    src = src.select("id", "text", F.xxhash64("id", "text").alias("h1"), F.xxhash64(F.lit(7), "id", "text").alias("h2"))
    short = src.select("id", "h1", "h2", F.floor(F.length("text") / 3).cast("int").alias("need")).distinct()
    order = dense_sequence(short.orderBy("id", "h1", "h2").withColumn("_o", F.monotonically_increasing_id()), "_o", "i")
    order = materialize(order)
    n = max(1, order.count())
    after = order.select(((F.col("i") + 1) % n).alias("i"), F.col("h1").alias("x1"), F.col("h2").alias("x2"))
    links = materialize(order.join(after, "i").select("id", "h1", "h2", "need", "x1", "x2"))
    texts = src.select("h1", "h2", "text")
    heads = texts.join(links.select(F.col("x1").alias("h1"), F.col("x2").alias("h2"), "need", F.col("id").alias("own_id"),
                                    F.col("h1").alias("own_1"), F.col("h2").alias("own_2")), ["h1", "h2"])
    heads = with_fingerprint(heads.dropDuplicates(["h1", "h2"]), F.col("text"), "next_fp").select(
        F.col("own_1").alias("h1"), F.col("own_2").alias("h2"), F.col("own_id").alias("id"),
        F.expr("substring(text, 1, need)").alias("next_head"), "next_fp")
    return texts.join(heads, ["h1", "h2"]).select("id", "text", "next_head", "next_fp")


def edited(text: Column, next_head: Column) -> Column:
    """``text`` with its last third replaced by the head of the next text."""
    n = F.length(text)
    return F.concat(F.substring(text, F.lit(1), (n - F.floor(n / 3)).cast("int")), next_head)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness; likeness to the next document."""
    rows = neighbours(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next_head"))).drop("next_head")
    rows = with_fingerprint(with_fingerprint(rows, F.col("text"), "fp"), F.col("edited"), "edited_fp")
    return rows.select(F.col("id").alias("doc_id"), F.length("text").cast("long").alias("n_chars"),
                       F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("fp")).alias("fingerprint"),
                       as_text(F.col("edited_fp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
