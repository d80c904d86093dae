"""Operator 9, toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (with edge marks), each of which
hashes to a row of an embedding table, so an unseen misspelling shares
vectors with the words it resembles. A window of ``WINDOW`` words is the
average of its words' bags; a linear softmax over the average gives the
window's probability, and a document is toxic if any window is:
p = 1 - prod(1 - p_window). Beyond ``SPAN`` windows the product is that of
``SPAN`` average ones, so that a text does not look worse for being long. Table and softmax are trained jointly, in numpy,
by gradient descent with momentum on the documents' labels.

The fit uses a bounded sample of labelled rows (``SAMPLE_ROWS`` rows and
``SAMPLE_BYTES`` of text, taken in the order of a hash of the id, without
texts above ``LONGEST_SHARE`` of those bytes). Each label gets its share of
the rows, a rare one up to ``RARE_SHARE``; weights make up for that. Scoring
reads every whole text in its own task; by linearity the averages need one
number for each table row, so 4 * BUCKETS bytes are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from smartmaint.llm.common import bounded_batches, release, row_slices, table
from smartmaint.llm.words import LOWER, text_bytes, word_bounds, word_hashes

BUCKETS = 1 << 18
DIM = 8
GRAMS = (3, 6)
WINDOW = 16
SPAN = 64  # windows
RARE_SHARE = 0.1
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 24 << 20
LONGEST_SHARE = 1 / 64  # of the sample's bytes, for a single text
SHORT_BYTES = 4096  # never too long
STEPS = 100
THRESHOLD = 0.3
SLICE_BYTES = 1 << 19
WORD_BYTES_AT_ONCE = 1 << 16
ROWS_AT_ONCE = 1 << 18  # table rows
_SCALE = 4.0  # of the averaged window vector


@dataclass
class Model:
    """The linear part folded into one number for each table row, and the bias difference."""
    weight: np.ndarray
    bias: float


def subwords(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of the character n-grams of each word, and where each word's rows begin (length: words + 1)."""
    low, parts, bounds, i = LOWER[raw], [], [np.zeros(1, np.int64)], 0
    upto = np.cumsum(ends - starts)
    while i < len(starts):  # some words at a time: the sort below takes many times their rows
        j = max(i + 1, int(np.searchsorted(upto, upto[i] + WORD_BYTES_AT_ONCE, "right")))
        rows, at = _some_subwords(low, starts[i:j], ends[i:j])
        parts.append(rows)
        bounds.append(at[1:] + bounds[-1][-1])
        i = j
    return np.concatenate(parts) if parts else np.empty(0, np.int32), np.concatenate(bounds)


def _some_subwords(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    text = b"".join([b"<" + low[a:b].tobytes() + b">" for a, b in zip(starts.tolist(), ends.tolist())])
    cp = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    first, after = np.flatnonzero(cp == 60), np.flatnonzero(cp == 62) + 1
    word = np.repeat(np.arange(len(first), dtype=np.int32), after - first)
    room = np.repeat(after, after - first) - np.arange(len(cp))
    h, rows, owner = np.zeros(len(cp), np.uint64), [], []
    for n in range(1, GRAMS[1] + 1):
        h[:len(cp) - n + 1] ^= cp[n - 1:]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if n >= GRAMS[0]:
            fits = room >= n
            rows.append(((h[fits] >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int32))
            owner.append(word[fits])
    rows, owner = np.concatenate(rows), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return rows[order], np.searchsorted(owner[order], np.arange(len(starts) + 1))


def _sums(table_: np.ndarray, rows: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the table's values at ``rows``, word by word; running sums of some rows at a time."""
    at, carry = np.zeros(len(bounds)), 0.0
    for i in range(0, len(rows), ROWS_AT_ONCE):
        total = np.cumsum(np.concatenate(([carry], table_[rows[i:i + ROWS_AT_ONCE]])), dtype=np.float64)
        first, after = np.searchsorted(bounds, [i, i + len(total)])
        at[first:after] = total[bounds[first:after] - i]
        carry = total[-1]
    return np.diff(at)


@dataclass
class Bags:
    """Documents as windows of distinct words, and the words as table rows."""
    rows: np.ndarray      # table rows, word by word
    bounds: np.ndarray
    window: np.ndarray    # (window, word) pairs
    word: np.ndarray
    doc: np.ndarray       # document of each window
    words_in: np.ndarray  # distinct words of each window, at least 1
    docs: int

    @property
    def share(self) -> np.ndarray:
        """What a window of each document counts: less in texts of more than ``SPAN`` windows."""
        return np.minimum(1.0, SPAN / np.maximum(np.bincount(self.doc, minlength=self.docs), 1))

    def logits(self, weight: np.ndarray, per_word: np.ndarray, bias: float) -> np.ndarray:
        s = _sums(weight, self.rows, self.bounds) / per_word
        return np.bincount(self.window, s[self.word], minlength=len(self.doc)) / self.words_in * _SCALE + bias


def bags(texts: pa.Array) -> Bags:
    raw, at = text_bytes(texts)
    starts, ends, first = word_bounds(raw, at)
    _, sample, word = np.unique(word_hashes(raw, starts, ends), return_index=True, return_inverse=True)
    word = word.astype(np.int32)
    rows, bounds = subwords(raw, starts[sample], ends[sample]) if len(sample) else (np.empty(0, int), np.zeros(1, int))
    del raw, starts, ends
    n = np.diff(first)
    row = np.repeat(np.arange(len(n), dtype=np.int32), n)
    windows = np.maximum(-(-n // WINDOW), 1)  # a text without words is one empty window
    pair = np.arange(len(row))
    pair -= first[row]
    pair //= WINDOW
    pair += (np.cumsum(windows) - windows)[row]
    del row
    pair *= max(1, len(sample))
    pair += word
    del word
    pair.sort()
    pair = pair[np.diff(pair, prepend=-1) > 0]
    window = (pair // max(1, len(sample))).astype(np.int32)
    pair %= max(1, len(sample))
    word = pair.astype(np.int32)
    del pair
    doc = np.repeat(np.arange(len(n), dtype=np.int32), windows)
    return Bags(rows, bounds, window, word, doc, np.maximum(np.bincount(window, minlength=len(doc)), 1), len(n))


def _slices(n: int) -> list[slice]:
    return [slice(i, i + ROWS_AT_ONCE) for i in range(0, n, ROWS_AT_ONCE)]


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def fit(texts: pa.Array, labels: np.ndarray, weights: np.ndarray | None = None, steps: int = STEPS, seed: int = 0) -> Model:
    """Joint gradient descent on the embedding table and the softmax; ``weights`` count rows more or less.

    Without both labels the score is the share of label 1, smoothed so that
    no labels at all give 0.1 and nothing is rejected.
    """
    y = np.asarray(labels, float)
    of_row = np.ones(len(y)) if weights is None else np.asarray(weights, float) * len(y) / np.sum(weights)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.1) / (len(y) + 1)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    b = bags(texts)
    # rows seen in a few documents only would learn those documents by heart
    seen = np.zeros(BUCKETS)
    in_docs = np.bincount(np.unique(b.doc[b.window].astype(np.int64) * len(b.bounds) + b.word) % len(b.bounds), minlength=len(b.bounds) - 1)
    owner = np.repeat(np.arange(len(b.bounds) - 1, dtype=np.int32), np.diff(b.bounds))
    for part in _slices(len(b.rows)):
        np.add.at(seen, b.rows[part], in_docs[owner[part]].astype(float))
    often = seen >= max(5, min(20, len(y) // 200))
    left, kept, met = np.zeros(len(b.bounds) - 1, np.int64), [np.empty(0, np.int32)], np.zeros(BUCKETS, bool)
    for part in _slices(len(b.rows)):
        known = often[b.rows[part]]
        left += np.bincount(owner[part][known], minlength=len(left))
        kept.append(b.rows[part][known])
        met[kept[-1]] = True
    used = np.flatnonzero(met)
    place = np.zeros(BUCKETS, np.int32)
    place[used] = np.arange(len(used))
    b.rows, b.bounds = place[np.concatenate(kept)], np.concatenate(([0], np.cumsum(left)))
    owner, kept = np.repeat(np.arange(len(left), dtype=np.int32), left), []
    per_word = np.sqrt(np.maximum(np.diff(b.bounds), 1))
    rng = np.random.default_rng(seed)
    table_ = np.zeros((len(used), DIM), np.float32)  # the other rows stay zero
    softmax = rng.normal(0, 1, (DIM, 2))
    softmax /= np.linalg.norm(softmax[:, 1] - softmax[:, 0])
    # so that an average document starts at the share of label 1
    bias = np.array([0.0, np.log((y * of_row).mean() / (len(b.doc) / len(y)))])
    share = b.share[b.doc].astype(np.float32)
    speed = np.zeros(len(used))
    for _ in range(steps):
        diff = softmax[:, 1] - softmax[:, 0]
        weight = table_ @ diff.astype(np.float32)
        z = b.logits(weight, per_word, bias[1] - bias[0])
        total = np.maximum(np.bincount(b.doc, share * _softplus(z), minlength=len(y)), 1e-9)  # -log(1 - p)
        per_doc = np.where(y == 1, -1 / np.expm1(np.minimum(total, 50)), 1.0) * of_row / len(y)
        d = share * per_doc[b.doc] / (1 + np.exp(-np.clip(z, -50, 50)))
        g_word = np.bincount(b.word, (d / b.words_in * _SCALE)[b.window], minlength=len(per_word)) / per_word
        g_row = np.zeros(len(used))
        for part in _slices(len(owner)):
            np.add.at(g_row, b.rows[part], g_word[owner[part]])
        speed = 0.9 * speed + g_row
        top = np.abs(speed).max(initial=0)
        if not top:
            break
        # slower once most positive documents are found, so that the rest is not learnt by heart
        step = 0.5 / top * min(1.0, 3 * float((total[y == 1] < 1).mean()) + 1e-3)
        pull = table_.T @ speed.astype(np.float32)
        table_ -= (step * speed)[:, None].astype(np.float32) * diff.astype(np.float32)
        softmax -= 1e-3 * step * np.stack([-pull, pull], 1)
        bias += np.array([d.sum(), -d.sum()]) * 2.5
    diff = softmax[:, 1] - softmax[:, 0]
    weight = np.zeros(BUCKETS, np.float32)
    weight[used] = table_ @ diff.astype(np.float32)
    return Model(weight, float(bias[1] - bias[0]))


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    if not model.weight.any():  # nothing was learnt: the share of label 1, whatever the length
        return np.full(len(texts), 1 / (1 + np.exp(-model.bias)))
    b = bags(texts)
    # rows that the fit left out carry no weight and do not count in a word's bag
    per_word = np.sqrt(np.maximum(_sums(model.weight != 0, b.rows, b.bounds), 1))
    z = b.logits(model.weight, per_word, model.bias)
    return -np.expm1(-b.share * np.bincount(b.doc, _softplus(z), minlength=b.docs))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES):
    """(texts, labels, weights): at most ``rows`` labelled texts of at most ``size`` bytes, in the order of a hash of the id.

    ``docs`` (doc_id, text), ``labels`` (doc_id, label 0/1); null ids and
    labels take no part, of several labels of an id the largest counts, rows
    equal in id and text count once. Each label is given rows by its share,
    but a rare one up to ``RARE_SHARE`` of them; a row weighs what it stands
    for. Texts above ``size * LONGEST_SHARE`` bytes (but not those up to
    ``SHORT_BYTES``) are left out, unless a label has no other: then its
    shortest are taken. A text that does not fit into what is left is passed
    over, and each label has its part of the bytes. Lengths are measured in
    Spark, so only chosen texts reach the driver.
    """
    spark, longest = docs.sparkSession, max(int(size * LONGEST_SHARE), SHORT_BYTES)
    one = labels.dropna().groupBy("doc_id").agg(F.max("label").alias("label"))
    src = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = src.withColumn("th", F.xxhash64("text"))
    sized = keyed.select("doc_id", "th", F.octet_length("text").alias("bytes")).join(one, "doc_id").distinct()
    sized = sized.withColumn("fits", F.col("bytes") <= longest)
    counts = {r["label"]: r for r in sized.groupBy("label").agg(F.count("*").alias("n"), F.count_if("fits").alias("fit")).collect()}  # two labels
    whole = sum(r["n"] for r in counts.values())
    rare = {y: min(r["n"], int(rows * RARE_SHARE)) for y, r in counts.items()}
    quota = {y: max(rare[y], min(round(rows * r["n"] / whole), rows - sum(v for z, v in rare.items() if z != y))) for y, r in counts.items()}
    quota = {y: min(q, counts[y]["n"]) for y, q in quota.items()}
    part = {y: max(q / max(1, sum(quota.values())), RARE_SHARE / 2 if counts[y]["fit"] else 0.25) for y, q in quota.items()}
    chosen, weight = [], {}
    for y, r in sorted(counts.items()):
        of_label = sized.filter(F.col("label") == y)
        by = [F.xxhash64("doc_id"), "doc_id", "th"]
        found = of_label.filter("fits").orderBy(*by).limit(quota[y]) if r["fit"] else of_label.orderBy("bytes", *by).limit(quota[y])
        left, before = int(size * part[y] / sum(part.values())), len(chosen)
        for x in found.collect():  # bounded: short rows
            if x["bytes"] <= left:
                left -= x["bytes"]
                chosen.append(x)
        if len(chosen) > before:
            weight[y] = r["n"] / (len(chosen) - before)
    if not chosen:
        return pa.array([], pa.large_string()), np.array([], float), np.array([], float)
    schema = StructType([StructField("at", IntegerType()), *[sized.schema[c] for c in ("doc_id", "th", "label")]])
    picked = spark.createDataFrame([(i, r["doc_id"], r["th"], r["label"]) for i, r in enumerate(chosen)], schema)
    found = keyed.join(F.broadcast(picked), ["doc_id", "th"]).select("at", "label", "text").dropDuplicates(["at"]).orderBy("at")
    texts, ys = [], []
    for _, y, text in found.toLocalIterator():
        texts.append(text)
        ys.append(y)
    return pa.array(texts, pa.large_string()), np.array(ys, float), np.array([weight[y] for y in ys])


def score_documents(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns as c0, c1, … and ``score`` (0 to 1) of every whole text.

    Null and empty texts get the score of an empty window; repeated rows get
    equal scores; an empty table gives no rows. Only the text goes through
    Python; the other columns stay where they are.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        rows = pa.RecordBatch.from_arrays([text], names=["t"])
        parts = [scores(shipped.value, part.column(0)) for part in row_slices(iter([rows]), "t", SLICE_BYTES)]
        return pa.array(np.concatenate(parts) if parts else np.empty(0), pa.float64())

    src = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(keep)], docs[text_col].cast("string").alias("__text"))
    return bounded_batches(src).select(*[f"c{i}" for i in range(len(keep))], score("__text").alias("score"))


def is_held_out(doc_id):
    """Rows whose labels are never learnt: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trained_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    sample = labelled_sample(docs.select("doc_id", "text"), labels.filter(~is_held_out(F.col("doc_id"))))
    release()  # the driver's copies of the texts, before the fit needs the room
    model = fit(*sample)
    release()
    return model


def remove_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all its columns, whatever their names."""
    scored = score_documents(docs, model, docs.columns)
    return scored.filter(F.col("score") < threshold).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, trained_model(spark, docs, sf_dir), ["doc_id"])
    return scored.select(F.col("c0").alias("doc_id"), is_held_out(F.col("c0")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
