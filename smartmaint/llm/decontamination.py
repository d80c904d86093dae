"""Operator 6, benchmark decontamination with suffix arrays of the training text.

The documents are the training text. Each task cuts its documents into
shards of bounded size and builds, for each shard, the suffix array of its
words: the positions sorted by the words that follow them, coded by the
benchmark's vocabulary. Every suffix of every benchmark item is then binary
searched in every shard's array; the range found for its first ``window``
words are the verbatim matches, and neighbouring matches on one diagonal
(document position minus item position) join to the longest ones. Positions
whose next words leave the benchmark's vocabulary cannot match and are left
out of the array.

The benchmark comes to the tasks in blocks of bounded size; more than one
block means one more pass over the documents for each, with the matches so
far carried along in a written table. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from smartmaint.llm.common import bounded_batches, materialize, release, table
from smartmaint.llm.words import text_bytes, word_bounds, word_hashes

WINDOW = 13
BLOCK_BYTES = 16 << 20   # of benchmark text in one pass
SHARD_BYTES = 4 << 20    # of document text in one suffix array
ITEM_SHARE = 20          # contaminated: n_hit * ITEM_SHARE >= n_words

MATCH = "array<struct<item_id:string,item_start:bigint,doc_start:bigint,words:bigint>>"


@dataclass
class Block:
    """Windows of some benchmark items, coded by their own vocabulary."""
    vocabulary: np.ndarray            # sorted word hashes; code = place + 1
    seen: np.ndarray                  # bitmap over the hashes' top bits
    by_length: dict                   # window length -> (sorted distinct keys, first owner, owners' item, owners' offset)
    item_ids: pa.Array
    sets: dict                        # window length -> number of each distinct key's set of items
    members: list                     # the items of each set


def _keys(codes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` codes from each position as one byte string that sorts like the codes."""
    rows = np.empty((len(at), n), ">u4")
    for j in range(n):
        rows[:, j] = codes[at + j]
    return rows.view(f"S{4 * n}").ravel()


def code_block(items: list[tuple[str, str]], window: int) -> Block:
    raw, rows = text_bytes(pa.array([t for _, t in items], pa.large_string()))
    starts, ends, first = word_bounds(raw, rows)
    hashes = word_hashes(raw, starts, ends)
    vocabulary = np.unique(hashes)
    codes = (np.searchsorted(vocabulary, hashes) + 1).astype(np.uint32)
    seen = np.zeros(1 << 22, bool)
    seen[(vocabulary >> np.uint64(42)).astype(np.int64)] = True
    by_length: dict[int, list] = {}
    for i in range(len(items)):
        n = int(first[i + 1] - first[i])
        if n:
            w = min(window, n)
            by_length.setdefault(w, []).append((i, first[i] + np.arange(n - w + 1)))
    out, sets, numbers = {}, {}, {}
    for w, parts in by_length.items():
        at = np.concatenate([p for _, p in parts])
        item = np.concatenate([np.full(len(p), i) for i, p in parts])
        keys = _keys(codes, at, w)
        order = np.argsort(keys, kind="stable")
        distinct, owner = np.unique(keys[order], return_index=True)
        out[w] = (distinct, np.append(owner, len(order)), item[order], (at - first[item])[order])
        owners = np.split(item[order], owner[1:])
        sets[w] = np.array([numbers.setdefault(np.unique(o).tobytes(), len(numbers)) for o in owners])
    members = [np.frombuffer(b, np.int64) for b in numbers]
    return Block(vocabulary, seen, out, pa.array([i for i, _ in items], pa.string()), sets, members)


def _code(block: Block, hashes: np.ndarray) -> np.ndarray:
    codes = np.zeros(len(hashes) + 1, np.uint32)
    maybe = np.flatnonzero(block.seen[(hashes >> np.uint64(42)).astype(np.int64)])
    place = np.searchsorted(block.vocabulary, hashes[maybe])
    place[place == len(block.vocabulary)] = 0
    same = block.vocabulary[place] == hashes[maybe]
    codes[maybe[same]] = place[same] + 1
    return codes


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [lo, hi), and the range each comes from."""
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    return np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n), which


def search_shard(block: Block, hashes: np.ndarray, first: np.ndarray):
    """Occurrences of the block's windows in one shard of documents.

    Yields (window length, row of each occurrence, its place in the row, its
    window). Owners of a window are not spread here.
    """
    codes = _code(block, hashes)
    known = np.concatenate(([0], np.cumsum(codes[:-1] > 0)))
    row_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for w, (windows, _, _, _) in block.by_length.items():
        if len(hashes) < w:
            continue
        at = np.flatnonzero(known[w:] - known[:-w] == w)
        at = at[row_of[at] == row_of[at + w - 1]]
        keys = _keys(codes, at, w)
        order = np.argsort(keys, kind="stable")  # the suffix array, to the depth that decides
        keys, at = keys[order], at[order]
        found, which = _spread(np.searchsorted(keys, windows, "left"), np.searchsorted(keys, windows, "right"))
        at = at[found]
        row = row_of[at]
        yield w, row, at - first[row], which


def _items_of(block: Block, w: int, row: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, item), each set of items spread once for a row, however many of its windows share it."""
    pairs = np.unique(row * (len(block.members) + 1) + block.sets[w][which])
    row, number = np.divmod(pairs, len(block.members) + 1)
    sizes = np.array([len(m) for m in block.members])[number]
    return np.repeat(row, sizes), np.concatenate([block.members[k] for k in number.tolist()] or [np.empty(0, np.int64)])


def _lists(row: np.ndarray, values: pa.Array, n: int) -> pa.Array:
    """Sorted distinct values of each of ``n`` rows."""
    coded = values.dictionary_encode()
    sorted_ = pa.compute.array_sort_indices(coded.dictionary)
    rank = np.empty(len(sorted_), np.int64)
    rank[sorted_.to_numpy()] = np.arange(len(sorted_))
    key = np.unique(row * (len(rank) + 1) + rank[coded.indices.to_numpy()] if len(row) else np.empty(0, np.int64))
    row, at = np.divmod(key, len(rank) + 1)
    offsets = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), coded.dictionary.take(sorted_).take(pa.array(at)))


def longest_matches(w: int, row, place, item, offset) -> tuple[np.ndarray, ...]:
    """Join occurrences that follow each other in a document and an item: (row, item, item start, place, words)."""
    diagonal = place - offset
    order = np.lexsort((offset, diagonal, item, row))
    row, place, item, offset, diagonal = (x[order] for x in (row, place, item, offset, diagonal))
    new = np.ones(len(row), bool)
    new[1:] = ((np.diff(row) != 0) | (np.diff(item) != 0) | (np.diff(diagonal) != 0) | (np.diff(offset) != 1))
    start = np.flatnonzero(new)
    runs = np.diff(np.append(start, len(row)))
    return row[start], item[start], offset[start], place[start], runs + w - 1


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def _search(text: pa.Array, state: pa.Array | None, block: Block, kind: pa.StructType, with_items: bool, with_matches: bool) -> pa.Array:
    """The state (words, spans, items, matches) of some whole texts after this block."""
    raw, rows = text_bytes(text)
    starts, ends, first = word_bounds(raw, rows)
    hashes = word_hashes(raw, starts, ends)
    n, spans, matches = len(text), {}, {}
    item_rows, item_values = [np.empty(0, np.int64)], [pa.array([], pa.string())]
    if state is not None:
        spans = {i: [(s["s"], s["e"]) for s in v] for i, v in enumerate(state.field("spans").to_pylist()) if v}
        matches = {i: v for i, v in enumerate(state.field("matches").to_pylist()) if v}
        before = state.field("items")
        item_rows.append(pa.compute.list_parent_indices(before).to_numpy())
        item_values.append(before.flatten())
    for w, row, place, which in search_shard(block, hashes, first):
        # spans of hit words: sorted occurrences merge where they touch
        flat = np.unique(row * (1 << 40) + place)
        cut = np.flatnonzero(np.diff(flat) > w) + 1
        for s, e in zip(flat[np.concatenate(([0], cut))] if len(flat) else [], flat[np.append(cut, len(flat)) - 1] if len(flat) else []):
            spans.setdefault(int(s) >> 40, []).append((int(s) & ((1 << 40) - 1), (int(e) & ((1 << 40) - 1)) + w))
        if with_items:
            r, i = _items_of(block, w, row, which)
            item_rows.append(r)
            item_values.append(block.item_ids.take(pa.array(i)))
        if with_matches:
            _, owner, item, offset = block.by_length[w]
            pair, occurrence = _spread(owner[which], owner[which + 1])
            for r, i, o, p, k in zip(*longest_matches(w, row[occurrence], place[occurrence], item[pair], offset[pair])):
                matches.setdefault(int(r), []).append(
                    {"item_id": block.item_ids[int(i)].as_py(), "item_start": int(o), "doc_start": int(p), "words": int(k)})
    spans = {i: _union(v) for i, v in spans.items()}
    cols = [pa.array(np.diff(first), pa.int64()),
            pa.array([[{"s": s, "e": e} for s, e in spans.get(i, [])] for i in range(n)], kind.field("spans").type),
            _lists(np.concatenate(item_rows), pa.concat_arrays(item_values), n).cast(kind.field("items").type),
            pa.array([matches.get(i, []) for i in range(n)], kind.field("matches").type)]
    return pa.StructArray.from_arrays(cols, fields=list(kind))


def _slices(text: pa.Array) -> list[tuple[int, int]]:
    """Row ranges that hold about ``SHARD_BYTES`` of text each."""
    lens = pa.compute.fill_null(pa.compute.binary_length(text), 0).to_numpy(zero_copy_only=False)
    cuts, size = [0], 0
    for i, x in enumerate(lens.tolist()):
        if size and size + x > SHARD_BYTES:
            cuts.append(i)
            size = 0
        size += x
    return list(zip(cuts, [*cuts[1:], len(text)]))


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The benchmark's items in blocks of bounded size (items without an id or a text take no part)."""
    block, size = [], 0
    rows = benchmark.select(F.col(benchmark.columns[0]).cast("string"), F.col(benchmark.columns[1]).cast("string")).dropna()
    for item_id, text in rows.toLocalIterator():
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text)
    yield block


STATE = "struct<words:bigint,spans:array<struct<s:bigint,e:bigint>>,items:array<string>,matches:" + MATCH + ">"


def _scan(docs: DataFrame, benchmark: DataFrame, window: int, kept: list[str], text_col: str, block_bytes: int,
          with_items: bool = True, with_matches: bool = True) -> DataFrame:
    """The kept columns as c0, c1, … (so that no name can clash) and __words, __spans, __items, __matches.

    Only the text (and, with several blocks, what the blocks before found)
    goes through Python; the other columns stay where they are.
    """
    cur = bounded_batches(docs).select(*[docs[c].alias(f"c{i}") for i, c in enumerate(kept)], docs[text_col].cast("string").alias("__text"))
    kind = to_arrow_schema(T.StructType([T.StructField("s", T._parse_datatype_string(STATE))])).field(0).type
    blocks = _blocks(benchmark, block_bytes)
    block, first_pass = next(blocks), True
    while block is not None:
        after = next(blocks, None)
        shipped = docs.sparkSession.sparkContext.broadcast(code_block(block, window))

        def searched(text: pa.Array, state: pa.Array | None, s=shipped) -> pa.Array:
            parts = [_search(text.slice(a, b - a), None if state is None else state.slice(a, b - a), s.value, kind, with_items, with_matches)
                     for a, b in _slices(text)]
            release()
            return pa.concat_arrays(parts) if parts else pa.array([], kind)

        if first_pass:
            @F.arrow_udf(STATE)
            def search(text: pa.Array) -> pa.Array:
                return searched(text, None)
            cur = cur.withColumn("__state", search("__text"))
        else:
            @F.arrow_udf(STATE)
            def search_on(text: pa.Array, state: pa.Array) -> pa.Array:
                return searched(text, state)
            cur = cur.withColumn("__state", search_on("__text", "__state"))
        if after is not None:
            cur = materialize(cur)
        block, first_pass = after, False
    return cur.select(*[f"c{i}" for i in range(len(kept))], *[F.col(f"__state.{x}").alias(f"__{x}") for x in ("words", "spans", "items", "matches")])


def _decision(share: int):
    n_hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    return n_hit, (n_hit > 0) & (n_hit * share >= F.col("__words"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: list[str] | None = None,
                       text_col: str = "text", block_bytes: int = BLOCK_BYTES, share: int = ITEM_SHARE, matches: bool = True) -> DataFrame:
    """Verbatim benchmark passages in whole documents.

    ``benchmark`` has the columns (item id, text). Returns the ``keep``
    columns (default: all) and ``n_words, n_hit, n_items, item_ids, matches,
    contaminated`` for every row of ``docs``: words inside any occurrence of
    ``window`` consecutive item words (a shorter item is one window), the
    items (sorted as strings), the longest matches with their places, and
    whether a 1/``share`` part of the words is hit. A ``keep`` column that
    bears one of these names is replaced. Without ``matches`` that list is
    empty, and passages that many items share cost no entry for each of them.

    Null or empty texts have no words and are clean. Repeated rows and null
    ids are rows like others. An empty benchmark leaves everything clean; an
    empty ``docs`` gives no rows. Words are told apart by a 64-bit hash.
    """
    made = ["n_words", "n_hit", "n_items", "item_ids", "matches", "contaminated"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in made]
    n_hit, contaminated = _decision(share)
    return _scan(docs, benchmark, window, kept, text_col, block_bytes, with_matches=matches).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)],
        F.col("__words").alias("n_words"), n_hit.alias("n_hit"), F.size("__items").cast("long").alias("n_items"),
        F.col("__items").alias("item_ids"), F.col("__matches").alias("matches"), contaminated.alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = ITEM_SHARE) -> DataFrame:
    """``docs`` without the contaminated rows; all its columns, whatever their names."""
    found = _scan(docs, benchmark, window, docs.columns, "text", BLOCK_BYTES, with_items=False, with_matches=False)
    return found.filter(~_decision(share)[1]).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, hit words and items of ``benchmark`` windows, contaminated or not."""
    found = find_contamination(table(spark, sf_dir, "documents"),
                               table(spark, sf_dir, "benchmark").select("item_id", "text"), keep=["doc_id"], matches=False)
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


# Windows by item, occurrences by equal word sequences; words hit by any occurrence.
ORACLE = """
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item_id,
                  list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
           FROM benchmark),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
      FROM documents),
iw AS (SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[s : s + least(13, len(w)) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT doc_id, s, k, array_to_string(w[s : s + k - 1], ' ') AS win
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, ks WHERE len(w) >= k)),
occ AS (SELECT dw.doc_id, dw.s, dw.k, iw.item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.win = iw.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
       FROM occ GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
